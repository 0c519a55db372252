"""Small fixtures with known results for functions, operators, sources and streams."""

import uuid

import pytest
from pyspark.sql import functions as F

from weft.functions import extract, text, urls
from weft.operators import edges, hetero, merge, stats, tree, vector
from weft.sources import io
from weft.streaming import ingest, windows


def one(spark, column, *values):
    names = "abcdef"[: len(values)]
    row = spark.createDataFrame([values], ", ".join(f"{n} string" for n in names)).select(column.alias("r")).first()
    return row.r


@pytest.mark.parametrize(
    "url,expected",
    [
        ("https://www.facebook.com/x?id=1&utm=2#frag", "https://www.facebook.com/x?id=1"),
        ("https://f.com/p?story_fbid=5&id=7&x=", "https://f.com/p?story_fbid=5&id=7"),
        ("https://f.com/p?v=", "https://f.com/p"),
        ("", ""),
        ("not-a-url", "not-a-url"),
        (None, None),
    ],
)
def test_normalize(spark, url, expected):
    assert one(spark, urls.normalize_url(F.col("a")), url) == expected


@pytest.mark.parametrize(
    "url,expected",
    [("/posts/12", "12"), ("/permalink/3/", "3"), ("?story_fbid=4&id=1", "4"), ("/p/Ab_-9", "Ab_-9"), ("/reel/5", "5"), ("watch?v=6", "6"), ("/posts/pfbid0aZ", "pfbid0aZ"), ("?fbid=8", "8"), ("/photo/9", "9"), ("nothing", None), (None, None)],
)
def test_post_id(spark, url, expected):
    assert one(spark, urls.post_id(F.col("a")), url) == expected


@pytest.mark.parametrize(
    "url,expected",
    [("https://www.facebook.com/profile.php?id=77", "77"), ("https://facebook.com/some.name/x", "some.name"), ("https://www.facebook.com/groups/1", None), ("https://m.facebook.com/a", None), (None, None)],
)
def test_user_id(spark, url, expected):
    assert one(spark, urls.user_id(F.col("a")), url) == expected


@pytest.mark.parametrize("t,n", [("1234", 1234), ("1,234", 1234), ("1k", 1000), ("2M", 2_000_000), ("1b", 10**9), ("1.234", 1234), ("1.2K", 12000), ("abc", 0), ("xk", 0), (None, 0), ("", 0), ("9t", 0)])
def test_parse_count(spark, t, n):
    assert one(spark, text.parse_count(F.col("a")), t) == n


@pytest.mark.parametrize("t,n,kind", [("1,234 Thích", 1234, "like"), ("yêu thích 3", 3, "like"), ("5K HAHA", 5000, "haha"), ("2 phẫn nộ", 2, "angry"), ("thương thương", 0, "care"), ("7 views", 0, "unknown")])
def test_reaction(spark, t, n, kind):
    count, name = text.reaction(F.col("a"))
    assert (one(spark, count, t), one(spark, name, t)) == (n, kind)


@pytest.mark.parametrize("t,seconds", [("5 giây", 5), ("12 phút trước", 720), ("3 giờ", 10800), ("2ngày", 172800), ("1 tuần", 604800), ("1 tháng", 2592000), ("1 năm", 31536000), ("now", None)])
def test_relative_time(spark, t, seconds):
    at = F.timestamp_seconds(F.lit(10**9))
    got = one(spark, F.unix_seconds(text.relative_time(F.col("a"), at)), t)
    assert got == (None if seconds is None else 10**9 - seconds)


def test_tags_mentions_links_emojis(spark):
    t = "#Việt_Nam #a #a @x.y. @é https://u.v/w, www.z.q \U0001f600\U0001f601 x \U0001f600 漢"
    assert one(spark, text.hashtags(F.col("a")), t) == ["Việt_Nam", "a"] or sorted(one(spark, text.hashtags(F.col("a")), t)) == sorted(["Việt_Nam", "a"])
    assert set(one(spark, text.mentions(F.col("a")), t)) == {"x.y.", "é"}
    assert one(spark, text.external_links(F.col("a")), t) == ["https://u.v/w,", "www.z.q"]
    assert one(spark, text.emojis(F.col("a")), t) == ["\U0001f600\U0001f601", "\U0001f600", "漢"]
    assert one(spark, text.hashtags(F.col("a")), None) == []


def test_clean_text(spark):
    assert one(spark, text.clean_text(F.col("a")), " é​ \n\t x\xa0y ") == "é x y"
    assert one(spark, text.clean_text(F.col("a")), None) is None


def test_small_text_functions(spark):
    assert one(spark, text.title_excerpt(F.col("a")), "(3) Page - the start | Site") == "the start"
    assert one(spark, text.content_key(F.col("a"), F.col("b"), F.col("c")), "", "Ann", " hi ") == "Ann:hi"
    assert one(spark, text.heading_author(F.col("a")), "Posts by  Some Page") == "Some Page"
    assert one(spark, text.parent_names(F.col("a")), "Replied to Bo's comment 3 giờ")[0] == "Bo"
    assert one(spark, text.follower_count(F.col("a")), "2K followers") == 2000
    assert one(spark, text.like_label(F.col("a")), "1.2K reactions") == 1200
    assert one(spark, text.media_extension(F.col("a"), F.col("b")), "http://x/y.PNG", "") == ".png"
    assert one(spark, text.media_extension(F.col("a"), F.col("b")), "http://x/y.png", "video/mp4") == ".mp4"
    assert one(spark, text.page_class(F.col("a"), F.col("b"), F.col("c")), "http://x/login/", "", "captcha") == "login_wall"
    assert one(spark, text.page_class(F.col("a"), F.col("b"), F.col("c")), "http://x/", "", "Please try again later") == "rate_limit"
    assert one(spark, text.is_post_noise(F.col("a"), F.col("b")), "6/247 - 3", "x") and not one(spark, text.is_post_noise(F.col("a"), F.col("b")), "a real line of text", "x")
    assert one(spark, text.is_comment_noise(F.col("a"), F.col("b"), F.col("c"), urls.SITE), "Find friends", "x", None)
    assert one(spark, text.is_truncated(F.col("a")), "some words… Xem thêm")
    assert one(spark, text.comment_id(F.col("a"), F.col("b"), F.col("c"), F.col("d")), "", "x", "y", "z") == "cmt_" + __import__("hashlib").md5(b"x|y|z").hexdigest()[:8]
    assert one(spark, text.epoch_iso(F.col("a").cast("long")), "0") == "1970-01-01T00:00:00+00:00"
    assert one(spark, text.uuid5_hex(F.col("a")), "u1|u2|réply") == uuid.uuid5(uuid.NAMESPACE_URL, "u1|u2|réply").hex
    assert one(spark, urls.canonical_permalink(F.col("a")), "https://x/permalink.php?a=1&story_fbid=5&id=6") == "https://www.facebook.com/permalink.php?story_fbid=5&id=6"
    assert one(spark, urls.local_media_path(F.col("a"), "/m"), "/old/data/media/p/1.jpg") == "/m/p/1.jpg"
    assert one(spark, urls.rest_base(F.col("a")), "http://h/") == "http://h/rest/v1"
    assert one(spark, urls.absolute_href(F.col("a")), "/me") == "https://www.facebook.com/me"
    assert one(spark, urls.feed_link(F.col("a"), F.col("b")), "http://x/Slug/posts/1", "slug") and not one(spark, urls.feed_link(F.col("a"), F.col("b")), "http://x/groups/slug/posts/1", "slug")
    words = F.array(F.struct(F.lit("a").alias("text"), F.lit(90).alias("conf")), F.struct(F.lit("b").alias("text"), F.lit(10).alias("conf")))
    assert [one(spark, c, "x") for c in text.confident_text(words)] == ["a", 50.0]


def test_embedded_counts(spark):
    html = 'x "99" {"reaction_type":"LIKE","count":3} {"reaction_type":"LIKE","count":8} {"reaction_type":"PRIDE","count":2} {"share_count":{"count":4}}'
    got = one(spark, extract.reactions(F.col("a")), html)
    assert (got["like"], got["care"], got["love"]) == (3, 2, 0) and one(spark, extract.share_count(F.col("a")), html) == 4
    assert one(spark, extract.reactions(F.col("a")), '{"reaction_count": {"count": 7}}')["like"] == 7
    assert one(spark, extract.share_count(F.col("a")), '"reshare_count":6') == 6
    assert one(spark, extract.window(F.col("a"), F.col("b"), 2, 6), 'abc"77"defgh', "77") == 'bc"77"de'
    assert one(spark, extract.og_story_id(F.col("a")), '<meta property="og:url" content="https://x/y/posts/12">') == "12"
    assert one(spark, extract.html_text(F.col("a")), "<p>a<img alt='\U0001f600'>b</p><script>x</script>&amp;") == "a\U0001f600b&"


COMMENTS = [
    ("p", "c1", None, "u1", "Ann", "hi", "t1", 0), ("p", "c2", "c1", "u2", "Bo", "re", "t2", 1), ("p", "c3", "c2", "u1", "Ann", "re2", "t3", 2),
    ("p", "c4", "c1", "u2", "Bob", "again", "t4", 3), ("p", "c5", "gone", "u3", "Cy", "orphan", "t5", 4),
]


@pytest.fixture(scope="module")
def comments(spark):
    return spark.createDataFrame(COMMENTS, "post_id string, comment_id string, parent_id string, author_id string, author_name string, raw_text string, timestamp string, ordinal long")


def test_tree(spark, comments):
    walked = tree.walk(comments)
    got = {r.comment_id: (r.depth, r.pre) for r in tree.preorder(walked).collect()}
    assert got == {"c1": (0, 0), "c2": (1, 1), "c3": (2, 2), "c4": (1, 3)}
    assert tree.subtree_counts(walked).first()[1:] == (4, 3)
    assert {r.comment_id: r.n_below for r in tree.descendants(walked).collect()} == {"c1": 3, "c2": 1, "c3": 0, "c4": 0}
    nested = tree.nested_json(walked, comments.select("post_id", "comment_id", F.to_json(F.struct("comment_id")).alias("body"))).first().comment_tree
    assert nested == '[{"comment_id":"c1","replies":[{"comment_id":"c2","replies":[{"comment_id":"c3","replies":[]}]},{"comment_id":"c4","replies":[]}]}]'


def test_edges(spark, comments):
    got = {(r.source, r.target, r.relation, r.timestamp) for r in edges.with_reverse(edges.reply_edges(comments)).collect()}
    assert got == {("u2", "u1", "reply", "t2"), ("u1", "u2", "reply_rev", "t2"), ("u1", "u2", "reply", "t3"), ("u2", "u1", "reply_rev", "t3")}
    assert edges.comment_reply_edges(comments).count() == 1 + 2 * 4
    assert {(r.author_id, r.display_name) for r in edges.commenters(comments).collect()} == {("u1", "Ann"), ("u2", "Bo"), ("u3", "Cy")}
    names = comments.withColumn("names", F.array(F.lit("Nobody"), F.lit("Bo")))
    assert {r.comment_id: r.parent_id for r in edges.parents_by_name(names).collect()} == {"c1": None, "c2": None, "c3": "c2", "c4": "c2", "c5": "c2"}
    tags = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (2, "c"), (3, "x")], "post_id int, tag string")
    assert [tuple(r) for r in edges.similar_posts(tags).collect()] == [(1, 2, 1, 0.3333)]
    rows = spark.createDataFrame([("u", "p", "share", 1.0), ("u", "p", "share", 99.0), ("u", "p", "odd", 1.0)], "user_id string, post_id string, interaction_type string, weight double")
    assert sorted(r.weight for r in edges.interaction_edges(rows).collect()) == [1.0, 5.0, 99.0]
    content = spark.createDataFrame([("s", "post", ["u1", "u2", "u3"], ["l1", "l2"])], "source_id string, source_type string, image_urls array<string>, local_images array<string>")
    assert edges.image_edges(edges.image_nodes(content)).count() == 4


def test_dense_numbers_keep_orphans_with_an_author_edge(spark, comments):
    posts = spark.createDataFrame([("p", "u9")], "post_id string, author_id string")
    walked = tree.walk(comments).join(comments.select("comment_id", "author_id"), "comment_id")
    user_user = spark.createDataFrame([("p", "", "u1", 0)], "post_id string, source string, target string, ordinal int")
    none = comments.limit(0)
    user_comment = comments.select("post_id", F.col("author_id").alias("user_id"), "comment_id", "ordinal")
    ids = hetero.node_ids(hetero.registrations(posts, walked, none.select("post_id", F.lit("").alias("hashtag"), "ordinal"), none.select("post_id", F.lit("").alias("image_id"), "ordinal"), user_user, none.select("post_id", F.lit("").alias("user_id"), "ordinal"), user_comment))
    got = {(r.kind, r.node): r.idx for r in ids.collect()}
    assert [got["user", u] for u in ("u9", "u1", "u2", "", "u3")] == [0, 1, 2, 3, 4]
    assert got["comment", "c5"] == 4 and got["post", "p"] == 0
    links = edges.comment_reply_edges(comments).select("post_id", F.lit("comment").alias("src_kind"), F.col("comment_id").alias("src"), F.col("direction").alias("relation"), F.col("target_type").alias("dst_kind"), F.col("target_id").alias("dst"))
    index = hetero.edge_index(ids, links)
    assert index.count() == 1 + 2 * 3 and hetero.edge_arrays(index).count() == 3
    assert {r.kind: r.num_nodes for r in hetero.num_nodes(ids).collect()} == {"post": 1, "user": 5, "comment": 5}


def test_merges(spark):
    old = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k int, v string, seq int")
    new = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (3, "z", 1)], "k int, v string, seq int")
    for _ in range(2):  # the same again changes nothing
        old = merge.upsert_last(old, new, ["k"], "seq")
        assert sorted((r.k, r.v) for r in old.collect()) == [(1, "a"), (2, "y"), (3, "z")]
    assert sorted((r.k, r.v) for r in merge.merge_first([old.drop("seq"), new.where("k = 3").select("k", F.lit("no").alias("v"))], ["k"]).collect())[-1] == (3, "z")
    pending = spark.createDataFrame([("u1", None), ("u2", "q"), (None, "r")], "url string, query string")
    assert [tuple(r) for r in merge.drop_pending(pending, F.lit("u1"), F.lit("zz")).collect()] == [("u2", "q"), (None, "r")]
    ordered = merge.dense_ordinal(spark.range(0, 100, 3), "id", 4).orderBy("id").collect()
    assert [r.ordinal for r in ordered] == list(range(34))
    feed = spark.createDataFrame([("p", "short", 5, 1, 0, 2, 3, 9, ["a"])], "post_id string, raw_text string, like_count int, love_count int, haha_count int, comment_count int, share_count int, wow_count int, image_urls array<string>")
    full = spark.createDataFrame([("p", "longer text", 4, 2, 1, 2, 4, 99, ["b", "a"])], feed.schema)
    assert tuple(merge.merge_versions(feed, full).first()) == ("p", "longer text", 5, 2, 1, 2, 4, 9, ["a", "b"])


def test_statistics(spark):
    rows = spark.createDataFrame([("k", i, e) for i, e in enumerate(["ban", "success", "throttle", "success", "success"])], "k string, i int, e string")
    assert tuple(stats.backoff(rows, "k", "i", "e").first()) == ("k", 1, 8.0)
    bad = spark.createDataFrame([("k", i, c) for i, c in enumerate("xxx.xx.xxxx")], "k string, i int, c string")
    assert sorted((r["first"], r["last"], r.length) for r in stats.failure_streaks(bad, "k", "i", F.col("c") == "x").collect()) == [(0, 2, 3), (7, 10, 4)]
    assert stats.ewma(spark.createDataFrame([("k", 0, 10.0), ("k", 1, 20.0)], "k string, i int, v double"), "k", "i", "v").first().ewma == 5.6


def test_vectors(spark):
    rows = spark.createDataFrame([(1, 0, [1.0, 2.0], 0.25), (1, 1, [3.0, 6.0], 0.75)], "k int, o int, v array<double>, w double")
    assert vector.pooled(rows, "k", "v").first().pooled == [2.0, 4.0] and vector.pooled(rows, "k", "v", "w").first().pooled == [2.5, 5.0]
    pairs = spark.createDataFrame([(0, 0, [1.0, 0.0], [1.0, 0.0]), (0, 1, [0.0, 1.0], [0.0, 2.0]), (0, 2, [0.0, 0.0], [1.0, 1.0])], "b int, r int, x array<double>, y array<double>")
    got = vector.ntxent(vector.batch_logits(pairs, "b", "r", "x", "y"), "b").first()
    assert got.n == 2 and got.accuracy == 1.0 and got.loss < 1e-5


def _pages(offset, limit):
    return [{"id": i, "url": f"u{i}"} for i in range(offset, min(offset + limit, 25))]


def test_sources(spark, tmp_path):
    docs = tmp_path / "docs" / "deep"
    docs.mkdir(parents=True)
    (docs / "b.json").write_text('{"post_id":"2","graph_structure":{"edges_user_user":[{"source_user_id":"a","target_user_id":"b"}]}}')
    (docs / "a.json").write_text('{\n "post_id": "1"\n}')
    (docs / "c.json").write_text("{broken")
    read = io.read_sorted(spark, str(tmp_path / "docs"))
    assert [r.post_id for r in read.collect()] == ["1", "2"] and io.list_documents(spark, str(tmp_path / "docs")).count() == 3
    tables = io.explode_document(read)
    assert tables["edges_user_user"].select("post_id", "source_user_id").first() == ("2", "a")
    io.write_documents(read.select("post_id", "sample_id"), str(tmp_path / "out"))
    io.write_documents(read.select("post_id", "sample_id").where("post_id = '1'"), str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 2
    io.write_jsonl(read.select("post_id", "platform"), str(tmp_path / "lines"))
    assert {r.value for r in spark.read.text(str(tmp_path / "lines")).collect()} == {'{"post_id":"1","platform":null}', '{"post_id":"2","platform":null}'}
    new = spark.createDataFrame([(1, "a", 1)], "k int, v string, seq int")
    for _ in range(2):
        io.upsert_table(spark, str(tmp_path / "t"), new, ["k"], "seq")
    assert io.read_table(spark, str(tmp_path / "t")).count() == 1
    assert io.parse_targets("# list\n- type: post\n  url: 'u1' # x\n- url: u2\n  category: c\n") == [{"type": "post", "url": "u1"}, {"url": "u2", "category": "c"}]
    (tmp_path / "w.log").write_text("start\nitem 1\nitem 2\nend\n")
    assert io.last_log_lines(spark, str(tmp_path), "item").first().line == "item 2"
    assert io.folder_size(spark, str(tmp_path / "docs")).first().files == 3
    spark.dataSource.register(io.PagedSource)
    paged = spark.read.format("weft_pages").schema("id int, url string").options(pages="tests.test_library:_pages", total=25, limit=10).load()
    assert paged.count() == 25
    assert io.patched({"a": {"b": 1}}, {"a.b": 2}) == {"a.b": 2}
    done = io.DoneSet(spark, str(tmp_path / "done"))
    done.add(spark.createDataFrame([("1",), ("1",)], "id string"))
    assert [r.post_id for r in done.pending(read, "post_id").collect()] == ["2"]


def test_stream_ingest_is_idempotent(spark, tmp_path):
    source, seen = tmp_path / "in", []
    source.mkdir()
    done = io.DoneSet(spark, str(tmp_path / "done"))
    for k, ids in enumerate((["1", "2", "2"], ["2", "3"])):
        (source / f"{k}.json").write_text("\n".join('{"post_id":"%s"}' % i for i in ids))
        stream = ingest.sample_stream(spark, str(source), "post_id string")
        ingest.ingest(stream, done, lambda rows, n: seen.extend(r.post_id for r in rows.collect()), "post_id", str(tmp_path / "ck")).awaitTermination()
    assert sorted(seen) == ["1", "2", "3"]


def test_stream_windows_equal_batch(spark, tmp_path):
    rows = spark.range(200).select(F.timestamp_seconds(F.col("id") * 37).alias("ts"), F.concat(F.lit("e"), F.col("id") % 3).alias("event_type"), F.col("id").cast("double").alias("value"))
    rows.write.parquet(str(tmp_path / "events"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "events"))
    q = windows.tumbling(stream, "10 minutes").writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(map(tuple, spark.table("w").collect())) == sorted(map(tuple, windows.tumbling(rows, "10 minutes").collect()))


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_entry_and_registry(spark, sf):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_list_functions(spark):
    from weft.functions import lists

    row = spark.createDataFrame([("p", ["l0", "l1"], ["a"], [("Bo", "https://www.facebook.com/bo"), ("Bo", "https://www.facebook.com/bo"), ("Me", "https://www.facebook.com/me"), ("X", "http://x")])], "id string, local array<string>, tags array<string>, links array<struct<name:string,href:string>>")
    none = F.expr("cast(null as array<struct<image_id:string,local_path:string,image_url:string,source_type:string,source_id:string>>)")
    got = row.select(
        lists.legacy_images(F.col("id"), F.col("local"), none).alias("images"), lists.with_tag(F.col("tags"), F.lit("b")).alias("tags"), lists.with_tag(F.col("tags"), F.lit("a")).alias("same"),
        lists.mention_links(F.col("links"), F.lit("https://www.facebook.com/me")).alias("m"), lists.user_flags(F.lit(0), F.lit(True)).alias("flags"), lists.is_empty_post(F.lit(" "), F.array()).alias("empty"),
        lists.first_non_empty(F.slice("tags", F.lit(1), F.lit(0)), F.col("tags")).alias("first"), lists.source_tag("hashtag", F.lit("t")).alias("tag"), lists.text_or(F.lit(""), "-").alias("text"), lists.has_media(F.array(F.lit("http://scontent.x"))).alias("media"),
    ).first()
    assert [i.image_id for i in got.images] == ["p_img_000", "p_img_001"] and got.tags == ["a", "b"] and got.same == ["a"]
    assert [m.name for m in got.m] == ["Bo"] and got.flags == [1.0, 0.0, 0.0] and got.empty and got.first == ["a"] and got.tag == "hashtag:#t" and got.text == "-" and got.media


def test_comments_from_a_captured_page(spark):
    from weft.functions import elements

    page = """<div role="article" aria-label="Comment by Ann"><a href="https://www.facebook.com/ann?comment_id=77">Ann</a><div dir="auto">hi #tag <img alt="\U0001f600"></div><span aria-label="3 reactions"></span></div>
    <div role="article" aria-label="Bo replied to Ann's comment. Replied to Ann's comment"><a href="https://www.facebook.com/bo">Bo</a><div dir="auto"><a href="https://www.facebook.com/ann">Ann</a> yes</div><img src="http://scontent.x/1.jpg"></div>
    <div role="article"><a href="https://www.facebook.com/s">Suggested for you</a><div dir="auto">join</div></div>"""
    rows = elements.comment_rows(spark.createDataFrame([("p", page), ("q", None)], "post string, html string"), "post", "html").orderBy("ordinal").collect()
    assert [(r.comment_id if k == 0 else None, r.author_id, r.raw_text, r.like_count) for k, r in enumerate(rows)] == [("77", "ann", "hi #tag \U0001f600", 3), (None, "bo", "yes", 0)]
    assert rows[0].hashtags == ["tag"] and rows[1].mentioned_users[0].name == "Ann" and rows[1].names[0] == "Ann" and rows[1].image_urls == ["http://scontent.x/1.jpg"]


def test_upserts_that_fail_leave_the_old_version(spark, tmp_path):
    path = str(tmp_path / "t")
    assert io.current_version(spark, path) is None
    for k in range(4):
        io.upsert_table(spark, path, spark.createDataFrame([(1, k), (k, k)], "k int, seq int"), ["k"], "seq")
    bad = spark.createDataFrame([(9, 9)], "k int, seq int").withColumn("k", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        io.upsert_table(spark, path, bad, ["k"], "seq")
    assert sorted((r.k, r.seq) for r in io.read_table(spark, path).collect()) == [(0, 0), (1, 3), (2, 2), (3, 3)]
    assert len([d for d in (tmp_path / "t").iterdir() if d.is_dir()]) <= 3


def test_deep_trees_cycles_and_long_ordinals(spark):
    chain = [("p", f"c{i}", f"c{i - 1}" if i else None, i) for i in range(300)]
    lost = [("p", "x", "unknown", 900), ("p", "y", "x", 901), ("p", "a", "b", 902), ("p", "b", "a", 903), ("q", "c0", None, 0)]
    rows = spark.createDataFrame(chain + lost, "post_id string, comment_id string, parent_id string, ordinal long")
    got = {(r.post_id, r.comment_id): (r.depth, r.path) for r in tree.walk(rows).collect()}
    assert len(got) == 301 and all(got["p", f"c{i}"][0] == i for i in range(300))
    assert got["p", "c299"][1] == ".".join(f"{i:010d}" for i in range(300))
    nested = tree.nested_json(tree.walk(rows), rows.select("post_id", "comment_id", F.to_json(F.struct("comment_id")).alias("body"))).where("post_id = 'p'").first().comment_tree
    assert nested.startswith('[{"comment_id":"c0","replies":[{"comment_id":"c1","replies":[') and nested.endswith("]}" * 300 + "]")
    with pytest.raises(Exception, match="more than 10 digits"):
        tree.walk(rows.limit(1).withColumn("ordinal", F.lit(10**11)))


def test_ordinals_over_many_ranges(spark):
    rows = spark.range(0, 9000, 3).withColumn("k", F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 6, "0"))).repartition(5)
    assert [r.ordinal for r in merge.dense_ordinal(rows, "k").orderBy("k").collect()] == list(range(3000))
    assert merge.dense_ordinal(rows.limit(0), "k").count() == 0


def test_windows_in_spans(spark):
    times = [0, 30, 59, 60, 61, 3599, 3600, 3601, 3658, 3659, 7300]
    rows = spark.createDataFrame([("k", i, t) for i, t in enumerate(times)], "k string, user int, t long").withColumn("ts", F.timestamp_seconds("t"))
    got = {r.t: r.recent for r in stats.rolling_count(rows, "k", "ts").collect()}
    assert got == {t: sum(t - 60 < s <= t for s in times) for t in times}
    decay = {r.t: r.weight for r in edges.time_decay(rows.withColumnRenamed("k", "key"), 100.0).collect()}
    assert decay[0] is None and all(abs(decay[b] - 2.718281828459045 ** (-(b - a) / 100)) < 1e-6 for a, b in zip(times, times[1:]))


def test_session_zone_does_not_matter(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert one(spark, text.epoch_iso(F.col("a").cast("long")), "-1") == "1969-12-31T23:59:59+00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("t,n", [("\t3K", 3000), ("\n12\u00a0", 12), ("\u2003 4,5 ", 45)])
def test_white_space_around_counts(spark, t, n):
    assert one(spark, text.parse_count(F.col("a")), t) == n


@pytest.mark.parametrize("url,expected", [("https://f.com/x?id=%zz", "https://f.com/x?id=%25zz"), ("https://f.com/x?v=1&id=2&v=3", "https://f.com/x?v=1&v=3&id=2"), ("https://f.com/x?id=%E9", "https://f.com/x?id=%EF%BF%BD")])
def test_odd_urls(spark, url, expected):
    assert one(spark, urls.normalize_url(F.col("a")), url) == expected
