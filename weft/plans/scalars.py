"""Queries of single-row functions: links, texts, counts, times, lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft.functions import extract, lists, text, urls
from weft.operators import edges, merge
from weft.plans.catalog import query
from weft.plans.registry import BLANKS, SHAPES_SQL, found_sql
from weft.plans.standins import RICH_SQL, interactions, rich_text, table
from weft.sources import io

def strip_sql(c: str) -> str:
    return f"regexp_replace({c}, '^{BLANKS}+|{BLANKS}+$', '', 'g')"


# Links.
FEED_SQL = """CASE page_id % 9 WHEN 0 THEN 'https://www.facebook.com/Slug/posts/' || page_id WHEN 1 THEN '/slug/photos/' || page_id WHEN 2 THEN '/other/posts/' || page_id WHEN 3 THEN '/x?story_fbid=' || page_id
  WHEN 4 THEN '/groups/slug/posts/' || page_id WHEN 5 THEN '/reel/pfbid' || page_id WHEN 6 THEN '/pfbid0' || page_id WHEN 7 THEN '/SLUG/permalink/' || page_id ELSE '/slug/videos/' || page_id END"""


@query(
    "u_feed_links",
    f"""WITH s AS (SELECT page_id, {FEED_SQL} AS h, CASE WHEN page_id % 2 = 0 THEN 'Slug' ELSE '' END AS slug FROM pages), w AS (SELECT *, contains(h, 'story_fbid=') OR contains(h, 'pfbid') AS by_id, NOT regexp_matches(h, '/reel/|/videos/|/groups/') AS ok FROM s)
SELECT page_id, ok AND CASE WHEN slug <> '' THEN by_id OR contains(lower(h), '/slug/posts/') OR contains(lower(h), '/slug/permalink/') OR contains(lower(h), '/slug/photos/') ELSE by_id OR contains(h, '/posts/') END AS wanted,
 CASE WHEN starts_with(h, '/') THEN 'https://www.facebook.com' || h ELSE h END AS absolute FROM w""",
)
def u_feed_links(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select("page_id", F.expr(FEED_SQL).alias("h"), F.when(F.col("page_id") % 2 == 0, "Slug").otherwise("").alias("slug"))
    return rows.select("page_id", urls.feed_link(F.col("h"), F.col("slug")).alias("wanted"), urls.absolute_href(F.col("h")).alias("absolute"))


@query("u_links_or_photos", "SELECT page_id, CASE WHEN page_id % 5 < 3 THEN list_concat(list_transform(range(page_id % 5), lambda x: 'p' || x), CASE WHEN page_id % 5 > 0 THEN ['f0'] ELSE ['f0', 'p0'] END) ELSE list_transform(range(page_id % 5), lambda x: 'p' || x) END AS links FROM pages")
def u_links_or_photos(spark, sf_dir):
    own = F.slice(F.array(*[F.lit(f"p{k}") for k in range(4)]), F.lit(1), (F.col("page_id") % 5).cast("int"))
    return table(spark, sf_dir, "pages").select("page_id", urls.links_or_photos(own, F.array(F.lit("f0"), F.lit("p0"))).alias("links"))


@query(
    "u_paths",
    """WITH s AS (SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'http://h' || page_id || '/' WHEN 1 THEN 'http://h/rest/v1/' ELSE 'http://h' END AS base, CASE page_id % 4 WHEN 0 THEN '/old/data/media/p/' || page_id WHEN 1 THEN 'data/media/x' ELSE '/else/' || page_id END AS path FROM pages)
SELECT page_id, CASE WHEN ends_with(rtrim(base, '/'), '/rest/v1') THEN rtrim(base, '/') ELSE rtrim(base, '/') || '/rest/v1' END AS rest, CASE WHEN contains(path, 'data/media/') THEN '/m/' || string_split(path, 'data/media/')[-1] ELSE path END AS local FROM s""",
)
def u_paths(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select("page_id", F.expr("CASE page_id % 3 WHEN 0 THEN 'http://h' || page_id || '/' WHEN 1 THEN 'http://h/rest/v1/' ELSE 'http://h' END").alias("base"), F.expr("CASE page_id % 4 WHEN 0 THEN '/old/data/media/p/' || page_id WHEN 1 THEN 'data/media/x' ELSE '/else/' || page_id END").alias("path"))
    return rows.select("page_id", urls.rest_base(F.col("base")).alias("rest"), urls.local_media_path(F.col("path"), "/m/").alias("local"))


# Texts.
@query("t_epoch_iso", "SELECT event_id, strftime(make_timestamp((epoch_us(ts) // 1000000 - CASE WHEN event_id % 2 = 0 THEN 0 ELSE 3000000000 END) * 1000000), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS iso FROM events")
def t_epoch_iso(spark, sf_dir):
    return interactions(spark, sf_dir).select("event_id", text.epoch_iso(F.unix_seconds("ts") - F.when(F.col("event_id") % 2 == 0, 0).otherwise(F.lit(3000000000))).alias("iso"))


MATCH_SQL = "coalesce(text, '') || ' é☀ ' || lang || '‼️  😀 x'"


@query("t_match_norm", rf"SELECT doc_id, trim(regexp_replace(nfc_normalize(regexp_replace({MATCH_SQL}, '[\x{{10000}}-\x{{10FFFF}}\x{{2600}}-\x{{27BF}}\x{{2B50}}\x{{2B55}}\x{{FE00}}-\x{{FE0F}}\x{{203C}}\x{{2049}}]', '', 'g')), '{BLANKS}+', ' ', 'g')) AS norm FROM documents")
def t_match_norm(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.match_norm(F.expr(MATCH_SQL)).alias("norm"))


TITLE_SQL = "CASE page_id % 4 WHEN 0 THEN '(' || page_id || ') Some Page - start of ' || page_id || ' | Site' WHEN 1 THEN 'Page - a - b | c' WHEN 2 THEN 'plain ' || page_id ELSE '(2)  X -' || chr(9) || 'tail  ' END"


@query("t_title_excerpt", f"SELECT page_id, {strip_sql(f'''regexp_replace(regexp_replace({TITLE_SQL}, '^[(][0-9]+[)]\\s*[^-]+-\\s*', ''), '\\s*[|].*$', '')''')} AS excerpt FROM pages")
def t_title_excerpt(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.title_excerpt(F.expr(TITLE_SQL)).alias("excerpt"))


NOISE_SQL = "CASE event_id % 10 WHEN 0 THEN 'Đóng' WHEN 1 THEN ' abc ' WHEN 2 THEN '12/24 - ' || event_id WHEN 3 THEN 'Ann says ' || event_id WHEN 4 THEN 'site.org here' WHEN 5 THEN 'a' || chr(10) || 'b' || chr(10) || 'c' || chr(10) || 'd' || chr(10) || 'long line' WHEN 6 THEN chr(9) || 'Trang chủ' || chr(10) WHEN 7 THEN 'one.two but with many more words' WHEN 8 THEN 'Be the first to comment.' ELSE 'a real text ' || event_id END"


@query(
    "t_post_noise",
    f"""WITH s AS (SELECT event_id, {strip_sql(NOISE_SQL)} AS t, CASE WHEN event_id % 2 = 1 THEN 'Ann' ELSE '' END AS a FROM events), w AS (SELECT *, list_filter(regexp_split_to_array(t, '{BLANKS}+'), lambda x: x <> '') AS words, list_filter(string_split(t, chr(10)), lambda x: {strip_sql('x')} <> '') AS lines FROM s)
SELECT event_id, length(t) < 5 OR lower(t) IN ({', '.join(f"'{x}'" for x in text.POST_NOISE)}) OR regexp_matches(t, '^[0-9\\s/.,-]+$') OR (a <> '' AND starts_with(t, a)) OR (len(words) <= 2 AND contains(t, '.') AND length(t) < 30)
 OR (len(lines) > 4 AND len(list_filter(lines, lambda x: length({strip_sql('x')}) <= 1)) / len(lines) > 0.5) AS noise FROM w""",
)
def t_post_noise(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", text.is_post_noise(F.expr(NOISE_SQL), F.when(F.col("event_id") % 2 == 1, "Ann")).alias("noise"))


@query(
    "t_comment_noise",
    """SELECT event_id, event_id % 5 = 0 OR event_id % 7 = 0 OR event_id % 3 = 1 AS noise, event_id % 4 < 2 AS truncated FROM events""",
)
def t_comment_noise(spark, sf_dir):
    e = F.col("event_id")
    author, said = F.when(e % 5 == 0, "Gợi ý cho bạn").otherwise(F.concat(F.lit("A"), e)), F.when(e % 7 == 0, "No more posts").otherwise("text")
    href = F.when(e % 3 == 1, "https://elsewhere.org/x").when(e % 3 == 2, F.concat(F.lit("https://www.facebook.com/u"), e))
    cut = F.when(e % 4 == 0, "some words… Xem thêm \n").when(e % 4 == 1, "words See more").otherwise("See more words")
    return table(spark, sf_dir, "events").select("event_id", text.is_comment_noise(author, said, href, urls.SITE).alias("noise"), text.is_truncated(cut).alias("truncated"))


HEADING_SQL = "CASE event_id % 5 WHEN 0 THEN 'Bài viết của  Trang ' || event_id WHEN 1 THEN ' Posts by' || chr(10) || 'Page ' || event_id WHEN 2 THEN 'Post by X' WHEN 3 THEN 'Something by Y' ELSE 'Post by Zoë' END"


@query("t_heading_author", f"SELECT event_id, nullif(regexp_extract(trim(regexp_replace({HEADING_SQL}, '{BLANKS}+', ' ', 'g')), '^(?:Bài viết của |Posts by |Post by )(.{{2,}})$', 1), '') AS author FROM events")
def t_heading_author(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", text.heading_author(F.expr(HEADING_SQL)).alias("author"))


LABEL_SQL = "CASE event_id % 5 WHEN 0 THEN 'Phản hồi bình luận của Ann ' || event_id || ' dưới tên Bo vào 2 giờ' WHEN 1 THEN 'x ĐÁP lại phản hồi của Cy' || event_id || ' vào lúc' WHEN 2 THEN 'Replied to Dee''s comment' WHEN 3 THEN 'replied to Em ' || event_id ELSE 'nothing' END"


@query(
    "t_parent_names",
    f"""WITH s AS (SELECT event_id, {LABEL_SQL} AS t FROM events), n AS (SELECT event_id, [nullif(trim(regexp_extract(t, '(?i)Phản hồi bình luận của (.+?)\\s+dưới tên', 1)), ''), nullif(trim(regexp_extract(t, '(?i)đáp lại phản hồi của (.+?)\\s+vào', 1)), ''),
 nullif(trim(regexp_extract(t, '(?i)Replied to (.+?)''s comment', 1)), ''), nullif(trim(regexp_extract(t, '(?i)replied to (.+?)$', 1)), '')] AS n FROM s) SELECT event_id, list_filter(n, lambda x: x IS NOT NULL) AS names FROM n""",
)
def t_parent_names(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", text.parent_names(F.expr(LABEL_SQL)).alias("names"))


LIKES_SQL = "CASE event_id % 6 WHEN 0 THEN event_id || ' reactions' WHEN 1 THEN (event_id % 90) || '.' || (event_id % 10) || 'K cảm xúc' WHEN 2 THEN '1,' || lpad((event_id % 1000)::VARCHAR, 3, '0') || ' likes' WHEN 3 THEN 'no count' WHEN 4 THEN (event_id % 7) || 'k x' ELSE event_id || '' END"


@query(
    "t_like_label",
    f"""WITH s AS (SELECT event_id, replace(regexp_extract({LIKES_SQL}, '^([0-9,.]+[kKmM]?) ', 1), ',', '') AS n FROM events)
SELECT event_id, coalesce(CASE WHEN ends_with(lower(n), 'k') THEN round(regexp_extract(n, '^([0-9.]*)', 1)::DOUBLE * 1000)::BIGINT ELSE try_cast(regexp_extract(n, '^([0-9]*)', 1) AS BIGINT) END, 0) AS likes FROM s""",
)
def t_like_label(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", text.like_label(F.expr(LIKES_SQL.replace("::VARCHAR", "::STRING"))).alias("likes"))


@query("t_comment_id", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'n' || event_id ELSE 'cmt_' || md5('label' || event_id || '|' || CASE WHEN event_id % 2 = 0 THEN 'h' ELSE '' END || '|' || event_type)[:8] END AS id FROM events")
def t_comment_id(spark, sf_dir):
    e = F.col("event_id")
    return table(spark, sf_dir, "events").select("event_id", text.comment_id(F.when(e % 3 == 0, F.concat(F.lit("n"), e)).when(e % 3 == 1, ""), F.concat(F.lit("label"), e), F.when(e % 2 == 0, "h"), F.col("event_type")).alias("id"))


FOLLOW_SQL = "CASE event_id % 4 WHEN 0 THEN chr(10) || event_id || chr(9) || 'followers' WHEN 1 THEN (event_id % 40) || 'K people' WHEN 2 THEN 'none' ELSE '0 x' END"


@query("t_follower_count", "SELECT event_id, CASE event_id % 4 WHEN 0 THEN nullif(event_id, 0) WHEN 1 THEN nullif((event_id % 40) * 1000, 0) END AS n FROM events")
def t_follower_count(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", text.follower_count(F.expr(FOLLOW_SQL)).alias("n"))


@query("t_json_list", "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'null' WHEN 1 THEN '[]' ELSE '[\"é' || doc_id || '\",\"' || lang || '\"]' END AS j, '{\"user_id\":\"u' || doc_id || '\"' || CASE WHEN doc_id % 2 = 0 THEN ',\"bio\":\"' || lang || '\"' ELSE '' END || '}' AS dropped, '{\"user_id\":\"u' || doc_id || '\",\"bio\":' || CASE WHEN doc_id % 2 = 0 THEN '\"' || lang || '\"' ELSE 'null' END || '}' AS kept FROM documents")
def t_json_list(spark, sf_dir):
    d = F.col("doc_id")
    items = F.when(d % 3 == 1, F.expr("cast(array() as array<string>)")).when(d % 3 == 2, F.array(F.concat(F.lit("é"), d), "lang"))
    user = F.struct(F.concat(F.lit("u"), d).alias("user_id"), F.when(d % 2 == 0, F.col("lang")).alias("bio"))
    return table(spark, sf_dir, "documents").select("doc_id", io.json_list(items).alias("j"), F.to_json(user).alias("dropped"), F.to_json(user, {"ignoreNullFields": "false"}).alias("kept"))


@query("t_ocr_words", "SELECT event_id, 'w' || event_id || CASE WHEN event_id % 100 > 60 THEN ' b' ELSE '' END AS text, round_even(CASE WHEN event_id % 100 > 0 THEN (90.0::DOUBLE + event_id % 100) / 2 ELSE 90.0 END, 1) AS confidence FROM events")
def t_ocr_words(spark, sf_dir):
    word = lambda t, c: F.struct(t.alias("text"), c.cast("double").alias("conf"))
    words = F.array(word(F.concat(F.lit("w"), "event_id"), F.lit(90.0)), word(F.lit("b"), F.col("event_id") % 100), word(F.lit("c"), F.lit(-1.0)))
    said, confidence = text.confident_text(words)
    return table(spark, sf_dir, "events").select("event_id", said.alias("text"), confidence.alias("confidence"))


@query("m_extension", "SELECT event_id, CASE event_id % 6 WHEN 0 THEN '.png' WHEN 1 THEN '.mp4' WHEN 2 THEN '.jpeg' WHEN 3 THEN '.bin' WHEN 4 THEN '.webp' ELSE '.jpg' END AS ext FROM events")
def m_extension(spark, sf_dir):
    url = F.expr("'http://x/' || event_id || CASE event_id % 6 WHEN 0 THEN '.jpg' WHEN 2 THEN '.JPEG?x' WHEN 4 THEN '.webp' WHEN 5 THEN '.jpg' ELSE '' END")
    kind = F.expr("CASE event_id % 6 WHEN 0 THEN 'image/png; q' WHEN 1 THEN 'video/mp4' WHEN 5 THEN 'image/jpeg' ELSE 'text/html' END")
    return table(spark, sf_dir, "events").select("event_id", text.media_extension(url, kind).alias("ext"))


# Lists and filters.
@query("f_non_empty", "SELECT page_id FROM pages WHERE NOT (page_id % 3 = 0 AND page_id % 2 = 0)")
def f_non_empty(spark, sf_dir):
    p = F.col("page_id")
    empty = lists.is_empty_post(F.when(p % 3 == 0, "\t\n ").otherwise("t"), F.when(p % 2 == 0, F.expr("cast(array() as array<string>)")).otherwise(F.array(F.lit("i"))))
    return table(spark, sf_dir, "pages").where(~empty).select("page_id")


@query("f_media_urls", "SELECT page_id, list_distinct(['https://scontent.x/' || (page_id % 3) || '.jpg']) || CASE WHEN page_id % 2 = 0 THEN ['https://a.fbcdn.net/p' || page_id] ELSE [] END AS media, page_id % 2 = 0 AS gate FROM pages")
def f_media_urls(spark, sf_dir):
    p = F.col("page_id")
    one = F.concat(F.lit("https://scontent.x/"), p % 3, F.lit(".jpg"))
    given = F.array(one, F.lit("https://scontent.x/emoji.png"), one, F.when(p % 2 == 0, F.concat(F.lit("https://a.fbcdn.net/p"), p)).otherwise("https://other.org/i.jpg"))
    return table(spark, sf_dir, "pages").select("page_id", extract.media_urls(given, ("scontent", "fbcdn"), ("emoji", "rsrc")).alias("media"), lists.has_media(F.slice(given, F.lit(4), F.lit(1)), "fbcdn").alias("gate"))


@query("f_first_seen", "SELECT l_partkey, arg_min(l_orderkey, (l_orderkey, l_linenumber)) AS l_orderkey, arg_min(l_suppkey, (l_orderkey, l_linenumber)) AS l_suppkey FROM lineitem GROUP BY 1")
def f_first_seen(spark, sf_dir):
    # lines under one number are told apart by their place in the table
    place = F.struct("l_orderkey", "l_linenumber", F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_suppkey", place.alias("place"))
    return edges.first_wins(rows, ["l_partkey"], "place").select("l_partkey", "l_orderkey", "l_suppkey")


@query("f_global_distinct", f"SELECT DISTINCT split_part({SHAPES_SQL}, '?', 1) AS url FROM pages")
def f_global_distinct(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(urls.drop_query(F.expr(SHAPES_SQL)).alias("url")).dropDuplicates(["url"])


@query("f_exclude_scraped", f"WITH s AS (SELECT page_id, {SHAPES_SQL} AS u FROM pages), i AS (SELECT page_id, coalesce({', '.join(found_sql(p) for p in urls.POST_ID_PATTERNS)}) AS id FROM s) SELECT page_id FROM i WHERE id IS NULL OR id NOT IN (SELECT doc_id::VARCHAR FROM labels)")
def f_exclude_scraped(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select("page_id", urls.post_id(F.expr(SHAPES_SQL)).alias("id"))
    done = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("id"))
    return merge.not_done(rows, done, "id").select("page_id")


@query("f_array_distinct", f"WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{BLANKS}+'), lambda x: x <> '') AS w FROM documents) SELECT doc_id, len(list_distinct(w)) AS n FROM d")
def f_array_distinct(spark, sf_dir):
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"(?U)[\s\x1C-\x1F]+"), lambda x: x != "")
    return table(spark, sf_dir, "documents").select("doc_id", F.size(F.array_distinct(words)).cast("long").alias("n"))


@query("f_unique_links", "SELECT page_id, CASE WHEN page_id % 2 = 0 THEN ['u' || page_id, '77'] ELSE ['b'] END AS ids FROM pages")
def f_unique_links(spark, sf_dir):
    p = F.col("page_id")
    first = F.when(p % 2 == 0, F.array(F.concat(F.lit("https://www.facebook.com/u"), p), F.lit("https://www.facebook.com/home"), F.lit("https://facebook.com/profile.php?id=77"), F.concat(F.lit("https://www.facebook.com/u"), p), F.lit("https://m.org/x"))).otherwise(F.expr("cast(array() as array<string>)"))
    ids = lists.first_non_empty(lists.unique_links(first, ("home",)), lists.unique_links(F.array(F.lit("https://www.facebook.com/b")), ("home",)))
    return table(spark, sf_dir, "pages").select("page_id", ids.alias("ids"))


@query("f_mention_links", "SELECT page_id, CASE WHEN page_id % 2 = 0 THEN ['A'] ELSE ['A', 'S'] END AS names FROM pages")
def f_mention_links(spark, sf_dir):
    link = lambda name, href: F.struct(F.lit(name).alias("name"), F.lit(href).alias("href"))
    links = F.array(link("A", "https://www.facebook.com/a"), link("B", "https://x.org/b"), link("A2", "https://www.facebook.com/a"), link("S", "https://www.facebook.com/self"))
    own = F.when(F.col("page_id") % 2 == 0, "https://www.facebook.com/self")
    return table(spark, sf_dir, "pages").select("page_id", F.transform(lists.mention_links(links, own), lambda x: x["name"]).alias("names"))


@query("f_empty_comments", "SELECT conv_id, turn FROM conversations WHERE coalesce(text, '') <> '' OR turn % 2 = 1")
def f_empty_comments(spark, sf_dir):
    from weft.plans.standins import comments

    c = comments(spark, sf_dir)
    kept = c.where((F.coalesce("raw_text", F.lit("")) != "") | (F.size("mentioned_users") > 0))
    return kept.select(F.col("post_id").cast("long").alias("conv_id"), F.col("ordinal").alias("turn"))


@query("f_post_type", f"WITH s AS (SELECT page_id, {SHAPES_SQL} AS u FROM pages) SELECT page_id, CASE WHEN (contains(u, '/photo/') OR contains(u, 'fbid=')) AND NOT contains(u, '/posts/') THEN 'photo' ELSE 'post' END AS post_type FROM s")
def f_post_type(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", lists.post_type(F.expr(SHAPES_SQL)).alias("post_type"))


@query("f_tags", "SELECT doc_id, 'search:' || lang AS a, 'hashtag:#' || lang AS b, lang AS c, CASE WHEN lang = 'en' THEN ['en', 'x'] ELSE ['en', 'x', lang] END AS tags FROM documents")
def f_tags(spark, sf_dir):
    tag = lambda kind: lists.source_tag(kind, F.col("lang"))
    return table(spark, sf_dir, "documents").select("doc_id", tag("search").alias("a"), tag("hashtag").alias("b"), tag("group").alias("c"), lists.with_tag(F.array(F.lit("en"), F.lit("x")), F.col("lang")).alias("tags"))


@query("e_total_reactions", "SELECT c_custkey, coalesce(c_nationkey, 0) + CASE WHEN c_custkey % 2 = 0 THEN c_custkey ELSE 0 END + 3 AS n FROM customer")
def e_total_reactions(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", lists.total_reactions(F.col("c_nationkey"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey")), F.lit(3)).cast("long").alias("n"))


@query("t_mentions", f"SELECT doc_id, list_sort(list_distinct(regexp_extract_all({RICH_SQL} || ' @x.y. @', '@([\\p{{L}}\\p{{N}}_.]+)', 1))) AS mentions FROM documents")
def t_mentions(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.mentions(F.concat(rich_text(), F.lit(" @x.y. @"))).alias("mentions"))
