"""Registered queries of the graph library and their DuckDB statements."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft.functions import extract, text, urls
from weft.operators import edges, merge, stats, tree, vector
from weft.plans.catalog import query
from weft.plans.standins import COMMENTS_SQL, INTERACTION_SQL, RICH_SQL, TREE_SQL, comments, interactions, posts, rich_text, table
from weft.streaming import windows


# URL functions over pages. SHAPES deals each page one of the link shapes.
SHAPES_SQL = """CASE page_id % 10 WHEN 0 THEN 'https://www.facebook.com/p' || page_id || '/posts/' || (page_id + 1000) || '?utm=1#c'
  WHEN 1 THEN 'https://facebook.com/permalink.php?story_fbid=' || page_id || '&id=' || (page_id * 7) || '&ref=x' WHEN 2 THEN 'https://www.facebook.com/reel/' || page_id
  WHEN 3 THEN 'https://www.facebook.com/watch?v=' || page_id || '&t=' WHEN 4 THEN 'https://www.facebook.com/a.b/posts/pfbid0' || page_id || 'Xyz'
  WHEN 5 THEN 'https://www.facebook.com/photo/?fbid=' || page_id || '&set=q' WHEN 6 THEN 'https://www.facebook.com/groups/g' || page_id || '/permalink/' || page_id || '/'
  WHEN 7 THEN 'https://www.facebook.com/profile.php?id=' || page_id WHEN 8 THEN 'https://www.facebook.com/p/Ab-' || page_id ELSE url END"""


def _shapes(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.expr(SHAPES_SQL).alias("u"), "url", "html")


ODD_SQL = f"""CASE page_id % 17 WHEN 10 THEN 'https://f.com/x?id=%zz' || page_id || '&v=1%2' WHEN 11 THEN 'HTTPS://F.com/x?v=a&id=' || page_id || '&v=b#f'
  WHEN 12 THEN 'https://f.com/x?id=a+b&fbid=%C3%A9*~-_.' || page_id WHEN 13 THEN 'https://f.com/x?id=&story_fbid=x%20y&id=' || page_id || '&id=0'
  WHEN 14 THEN '  https://f.com/p;q?%69d=' || page_id || '&x=1' WHEN 15 THEN 'not a url ' || page_id WHEN 16 THEN 'https://f.com/x?' ELSE {SHAPES_SQL} END"""


@query(
    "u_normalize_url",
    f"""WITH s AS (SELECT page_id, regexp_replace(regexp_replace({ODD_SQL}, '[\\t\\r\\n]', '', 'g'), '^[\\x00-\\x20]+', '') AS u FROM pages), p AS (SELECT page_id, split_part(u, '#', 1) AS u FROM s),
q AS (SELECT page_id, split_part(u, '?', 1) AS base, CASE WHEN contains(u, '?') THEN substring(u, instr(u, '?') + 1) ELSE '' END AS q FROM p),
g AS (SELECT page_id, base, list_transform(list_filter(string_split(q, '&'), lambda x: substring(x, length(split_part(x, '=', 1)) + 2) <> ''),
  lambda x: {{'k': url_decode(replace(split_part(x, '=', 1), '+', ' ')), 'v': url_decode(replace(substring(x, length(split_part(x, '=', 1)) + 2), '+', ' '))}}) AS g FROM q),
k AS (SELECT page_id, base, list_filter(g, lambda x: x.k IN ('id', 'story_fbid', 'v', 'fbid')) AS k FROM g),
n AS (SELECT *, list_filter(list_transform(k, lambda x: x.k), lambda x, i: list_position(list_transform(k, lambda y: y.k), x) = i) AS names FROM k)
SELECT page_id, lower(regexp_extract(base, '^([a-zA-Z][a-zA-Z0-9+.-]*:)', 1)) || substring(base, length(regexp_extract(base, '^([a-zA-Z][a-zA-Z0-9+.-]*:)', 1)) + 1)
 || CASE WHEN len(k) > 0 THEN '?' || array_to_string(list_transform(flatten(list_transform(names, lambda m: list_filter(k, lambda x: x.k = m))), lambda x: x.k || '=' || replace(url_encode(x.v), '%20', '+')), '&') ELSE '' END AS url FROM n""",
)
def u_normalize_url(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", urls.normalize_url(F.expr(ODD_SQL)).alias("url"))


found_sql = lambda p: f"nullif(regexp_extract(u, '{p}', 1), '')"


@query("u_post_id", f"WITH s AS (SELECT page_id, {SHAPES_SQL} AS u FROM pages) SELECT page_id, coalesce({', '.join(found_sql(p) for p in urls.POST_ID_PATTERNS)}) AS post_id FROM s")
def u_post_id(spark, sf_dir):
    return _shapes(spark, sf_dir).select("page_id", urls.post_id(F.col("u")).alias("post_id"))


@query(
    "u_user_id",
    f"""WITH s AS (SELECT page_id, {SHAPES_SQL} AS u FROM pages), t AS (SELECT *, {found_sql('^https?://(?:www[.])?facebook[.]com/([^/?#]+)')} AS slug FROM s)
SELECT page_id, coalesce({found_sql('[?&]id=([0-9]+)')}, CASE WHEN slug NOT IN ('pages', 'groups', 'events', 'marketplace', 'watch') THEN slug END) AS user_id FROM t""",
)
def u_user_id(spark, sf_dir):
    return _shapes(spark, sf_dir).select("page_id", urls.user_id(F.col("u")).alias("user_id"))


@query(
    "u_link_kinds",
    f"""WITH s AS (SELECT page_id, {SHAPES_SQL} AS u FROM pages)
SELECT page_id, regexp_matches(u, 'facebook[.]com/(?:{urls.POST_URL})') AS is_post, split_part(u, '?', 1) AS bare,
 (contains(u, '/photo/') OR contains(u, 'fbid=')) AND NOT contains(u, '/posts/') AS is_photo,
 coalesce({found_sql('^[a-zA-Z]+://[^/?#]*/+([^/?#]+)')}, '') AS slug, {found_sql('^[a-zA-Z]+://[^/?#]*/([^/?#]+)/(?:posts|permalink|photos|videos)(?:[/?#]|$)')} AS author_slug,
 string_split(rtrim(u, '/'), '/')[-1] AS last_segment,
 coalesce('https://www.facebook.com/permalink.php?story_fbid=' || {found_sql('[?&]story_fbid=([^&#]+)')} || coalesce('&id=' || {found_sql('[?&]id=([^&#]+)')}, ''), split_part(u, '?', 1)) AS permalink FROM s""",
)
def u_link_kinds(spark, sf_dir):
    u = F.col("u")
    return _shapes(spark, sf_dir).select(
        "page_id", urls.is_post_url(u).alias("is_post"), urls.drop_query(u).alias("bare"), urls.is_photo_url(u).alias("is_photo"), urls.page_slug(u).alias("slug"),
        urls.author_slug(u).alias("author_slug"), urls.last_segment(u).alias("last_segment"), urls.canonical_permalink(u).alias("permalink"),
    )


# Text functions over documents.
@query("t_clean_text", r"SELECT doc_id, trim(regexp_replace(regexp_replace(nfc_normalize(text), '[\x{200B}\x{200C}\x{200D}\x{FEFF}]', '', 'g'), '[\s\x0B\x1C-\x1F\x85\p{Z}]+', ' ', 'g')) AS cleaned FROM documents")
def t_clean_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.clean_text(F.col("text")).alias("cleaned"))


@query(
    "t_tags_links",
    f"""WITH d AS (SELECT doc_id, {RICH_SQL} AS t FROM documents)
SELECT doc_id, list_sort(list_distinct(regexp_extract_all(t, '#([\\p{{L}}\\p{{N}}_]+)', 1))) AS hashtags, list_sort(list_distinct(regexp_extract_all(t, '@([\\p{{L}}\\p{{N}}_.]+)', 1))) AS mentions,
 regexp_extract_all(t, '[\\x{{10000}}-\\x{{10FFFF}}\\x{{24C2}}-\\x{{D7FF}}\\x{{E000}}-\\x{{FFFF}}]+') AS emojis, regexp_extract_all(t, '(https?://[^\\s]+|www[.][^\\s]+)', 1) AS links FROM d""",
)
def t_tags_links(spark, sf_dir):
    t = F.col("t")
    return table(spark, sf_dir, "documents").select("doc_id", rich_text().alias("t")).select("doc_id", text.hashtags(t).alias("hashtags"), text.mentions(t).alias("mentions"), text.emojis(t).alias("emojis"), text.external_links(t).alias("links"))


COUNTS_SQL = "CASE event_id % 6 WHEN 0 THEN event_id || 'K' WHEN 1 THEN (event_id // 1000) || ',' || (event_id % 1000) WHEN 2 THEN chr(9) || ' ' || (event_id % 50) || '.5m ' || chr(10) WHEN 3 THEN event_id || 'b' WHEN 4 THEN 'x' || event_id ELSE '' || event_id END"


@query(
    "t_parse_count",
    f"""WITH e AS (SELECT event_id, lower(regexp_replace(regexp_replace({COUNTS_SQL}, '^\\s+|\\s+$', '', 'g'), '[,.]', '', 'g')) AS t FROM events)
SELECT event_id, coalesce(CASE WHEN regexp_matches(t, '^[0-9]+k$') THEN t[:-2]::BIGINT * 1000 WHEN regexp_matches(t, '^[0-9]+m$') THEN t[:-2]::BIGINT * 1000000
 WHEN regexp_matches(t, '^[0-9]+b$') THEN t[:-2]::BIGINT * 1000000000 WHEN regexp_matches(t, '^[0-9]+$') THEN t::BIGINT END, 0) AS n FROM e""",
)
def t_parse_count(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", text.parse_count(F.expr(COUNTS_SQL.replace("//", "div"))).alias("n"))


REACTION_SQL = "(event_id % 900) || CASE event_id % 7 WHEN 0 THEN ' Thích' WHEN 1 THEN ' yêu thích' WHEN 2 THEN ' HAHA' WHEN 3 THEN 'K buồn' WHEN 4 THEN ' phẫn nộ' WHEN 5 THEN ' thương thương' ELSE ' views' END"


@query(
    "t_reaction",
    f"""WITH e AS (SELECT event_id, {REACTION_SQL} AS t FROM events), k AS (SELECT *, CASE {' '.join(f"WHEN contains(lower(t), '{w}') THEN '{r}'" for w, r in text.REACTIONS.items())} ELSE 'unknown' END AS kind FROM e)
SELECT event_id, kind, CASE WHEN kind = 'unknown' THEN 0 ELSE regexp_extract(t, '^([0-9]+)', 1)::BIGINT * CASE WHEN regexp_matches(t, '^[0-9]+K') THEN 1000 ELSE 1 END END AS n FROM k""",
)
def t_reaction(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", F.expr(REACTION_SQL).alias("t"))
    n, kind = text.reaction(F.col("t"))
    return rows.select("event_id", kind.alias("kind"), n.alias("n"))


AGO_SQL = "CASE event_id % 8 WHEN 0 THEN '5 giây' WHEN 1 THEN 'x 12 phút' WHEN 2 THEN '3 giờ' WHEN 3 THEN '2ngày' WHEN 4 THEN '1 tuần' WHEN 5 THEN '4 tháng' WHEN 6 THEN '1 năm' ELSE 'now' END"


@query(
    "t_relative_time",
    f"""WITH e AS (SELECT event_id, ts, {AGO_SQL} AS t FROM events)
SELECT event_id, epoch_us(ts) - try_cast(regexp_extract(t, '([0-9]+)', 1) AS BIGINT) * CASE regexp_extract(t, '[0-9]+\\s*(\\S+)', 1) {' '.join(f"WHEN '{u}' THEN {s}" for u, s in text.UNITS.items())} END * 1000000 AS at_us FROM e""",
)
def t_relative_time(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.unix_micros(text.relative_time(F.expr(AGO_SQL), F.col("ts").cast("timestamp"))).alias("at_us"))


PAGE_URL_SQL = "url || CASE page_id % 11 WHEN 0 THEN '/login/' WHEN 1 THEN '/checkpoint/' WHEN 2 THEN '/challenge/' WHEN 3 THEN '?checkpoint?next' ELSE '' END"
PAGE_TITLE_SQL = "regexp_extract(html, '<title>([^<]*)</title>', 1) || CASE page_id % 13 WHEN 0 THEN ' Security Check' WHEN 1 THEN ' | Access Denied' ELSE '' END"
PAGE_BODY_SQL = "html || CASE page_id % 7 WHEN 0 THEN ' Vui lòng thử lại sau' WHEN 1 THEN ' Temporarily Blocked' WHEN 2 THEN ' your account has been DISABLED' WHEN 3 THEN ' hoạt động đáng ngờ' ELSE '' END"


@query(
    "t_page_class",
    f"""WITH p AS (SELECT page_id, lower({PAGE_URL_SQL}) AS u, lower({PAGE_TITLE_SQL}) AS t, lower({PAGE_BODY_SQL}) AS b FROM pages)
SELECT page_id, CASE WHEN contains(u, '/checkpoint/') THEN 'checkpoint' WHEN contains(u, '/login/') OR contains(u, 'login?next') THEN 'login_wall' WHEN contains(u, '/challenge/') OR contains(u, '/security/') THEN 'captcha'
 WHEN contains(u, 'checkpoint?next') THEN 'none' {' '.join("WHEN " + " OR ".join(f"contains({c}, '" + s.replace("'", "''") + "')" for s in signs for c in "bt") + f" THEN '{name}'" for name, signs in text.PAGE_CLASSES.items())} ELSE 'none' END AS class FROM p""",
)
def t_page_class(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.page_class(F.expr(PAGE_URL_SQL), F.expr(PAGE_TITLE_SQL), F.expr(PAGE_BODY_SQL)).alias("class"))


UUID_SQL = "substr(h, 1, 12) || '5' || substr(h, 14, 3) || printf('%02x', (('0x' || substr(h, 17, 2))::INT & 63) | 128) || substr(h, 19, 14)"


@query("e_uuid5", f"WITH e AS (SELECT event_id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(user_id || '|' || (event_id % 500) || '|' || {INTERACTION_SQL})) AS h FROM events) SELECT event_id, {UUID_SQL} AS edge_id FROM e")
def e_uuid5(spark, sf_dir):
    key = F.concat_ws("|", "user_id", "post_id", "interaction_type")
    return interactions(spark, sf_dir).select("event_id", text.uuid5_hex(key).alias("edge_id"))


# Trees.
@query("r_reply_depth", TREE_SQL + " SELECT post_id, comment_id, parent_id, depth FROM tree WHERE parent_id IS NOT NULL")
def r_reply_depth(spark, sf_dir):
    return tree.walk(comments(spark, sf_dir)).where("parent_id is not null").select("post_id", "comment_id", "parent_id", "depth")


@query("r_tree", TREE_SQL + " SELECT post_id, comment_id, depth, path, row_number() OVER (PARTITION BY post_id ORDER BY path) - 1 AS pre FROM tree")
def r_tree(spark, sf_dir):
    return tree.preorder(tree.walk(comments(spark, sf_dir))).select("post_id", "comment_id", "depth", "path", F.col("pre").cast("long").alias("pre"))


@query("r_depth_hist", TREE_SQL + " SELECT depth, least(depth, 2) AS label, count(*) AS n FROM tree GROUP BY 1, 2")
def r_depth_hist(spark, sf_dir):
    return tree.depth_histogram(tree.walk(comments(spark, sf_dir)))


@query("r_subtree_count", TREE_SQL + " SELECT post_id, count(*) AS n_all, count(*) FILTER (depth <= 1) AS n_two_levels FROM tree GROUP BY 1")
def r_subtree_count(spark, sf_dir):
    return tree.subtree_counts(tree.walk(comments(spark, sf_dir)))


@query("r_descendants", TREE_SQL + " SELECT a.post_id, a.comment_id, count(*) - 1 AS n_below FROM tree a JOIN tree b ON a.post_id = b.post_id AND (b.path = a.path OR starts_with(b.path, a.path || '.')) GROUP BY 1, 2")
def r_descendants(spark, sf_dir):
    return tree.descendants(tree.walk(comments(spark, sf_dir)))


def nested_sql(body: str) -> str:
    """CTEs behind ``tree`` that write its comments as nested JSON; ``body`` is the text of one comment."""
    return f""", spread AS (SELECT post_id, path, depth, {body} AS body, coalesce(lead(depth) OVER (PARTITION BY post_id ORDER BY path), 0) AS nxt, lag(depth) OVER (PARTITION BY post_id ORDER BY path) AS prv FROM tree),
 nested AS (SELECT post_id, '[' || string_agg(CASE WHEN prv >= depth THEN ',' ELSE '' END || body[:-2] || ',"replies":[' || repeat(']}}', greatest(depth - nxt + 1, 0)), '' ORDER BY path) || ']' AS comment_tree FROM spread GROUP BY 1)"""


@query("r_json_tree", TREE_SQL + nested_sql("to_json({'comment_id': comment_id, 'author_id': author_id})::VARCHAR") + " SELECT post_id, comment_tree FROM nested")
def r_json_tree(spark, sf_dir):
    rows = comments(spark, sf_dir)
    return tree.nested_json(tree.walk(rows), rows.select("post_id", "comment_id", F.to_json(F.struct("comment_id", "author_id")).alias("body")))


@query("r_maps", TREE_SQL + " SELECT t.post_id, t.comment_id, coalesce(c.raw_text, '') AS raw_text, CASE WHEN c.ordinal % 2 = 0 THEN 'i' || c.ordinal END AS image FROM tree t JOIN comments c USING (post_id, comment_id)")
def r_maps(spark, sf_dir):
    rows = comments(spark, sf_dir).withColumn("images", F.when(F.col("ordinal") % 2 == 0, F.array(F.concat(F.lit("i"), "ordinal"), F.lit("other"))).otherwise(F.array()))
    return tree.child_texts(tree.walk(rows), rows.select("post_id", "comment_id", "raw_text", "images"), "images")


# Edges.
_WEIGHT_SQL = f"CASE {INTERACTION_SQL} WHEN 'author' THEN 10.0 WHEN 'share' THEN 5.0 WHEN 'comment' THEN 3.0 WHEN 'angry' THEN 1.5 ELSE 1.0 END::DOUBLE"


@query("e_interaction", f"SELECT user_id::VARCHAR AS user_id, {INTERACTION_SQL} AS interaction_type, count(*) AS n, sum({_WEIGHT_SQL}) AS weight FROM events GROUP BY 1, 2")
def e_interaction(spark, sf_dir):
    return edges.interaction_edges(interactions(spark, sf_dir)).groupBy("user_id", "interaction_type").agg(F.count("*").alias("n"), F.sum("weight").alias("weight"))


@query("e_user_post", "SELECT source AS user_id, doc_id::VARCHAR AS post_id, 'author' AS interaction_type, 10.0::DOUBLE AS weight FROM documents WHERE coalesce(source, '') <> ''")
def e_user_post(spark, sf_dir):
    return edges.author_edges(posts(spark, sf_dir)).drop("edge_id")


REPLIES_SQL = f"""WITH {COMMENTS_SQL}, r AS (SELECT c.post_id, c.author_id AS source, p.author_id AS target, c.timestamp, c.ordinal FROM comments c JOIN comments p ON c.post_id = p.post_id AND c.parent_id = p.comment_id WHERE c.author_id <> p.author_id),
f AS (SELECT post_id, source, target, arg_min(timestamp, ordinal) AS timestamp FROM r GROUP BY 1, 2, 3)"""


@query("e_reply", REPLIES_SQL + " SELECT post_id, source, target, 'reply' AS relation, timestamp FROM f UNION ALL SELECT post_id, target, source, 'reply_rev', timestamp FROM f")
def e_reply(spark, sf_dir):
    return edges.with_reverse(edges.reply_edges(comments(spark, sf_dir)))


@query(
    "e_mention",
    f"""WITH {COMMENTS_SQL}, m AS (SELECT post_id, author_id AS source, post_id AS target, timestamp, ordinal FROM comments WHERE ordinal % 2 = 1),
d AS (SELECT doc_id::VARCHAR AS post_id, source, unnest(list_distinct(regexp_extract_all({RICH_SQL}, '@([\\p{{L}}\\p{{N}}_.]+)', 1))) AS target FROM documents WHERE coalesce(source, '') <> ''),
a AS (SELECT *, 0 AS late FROM m UNION ALL SELECT post_id, source, target, NULL, 0, 1 FROM d)
SELECT post_id, source, target, 'mention' AS relation, first(timestamp ORDER BY late, ordinal) AS timestamp FROM a GROUP BY 1, 2, 3""",
)
def e_mention(spark, sf_dir):
    return edges.mention_edges(comments(spark, sf_dir), posts(spark, sf_dir)).drop("ordinal")


@query(
    "e_comment_reply",
    f"""WITH {COMMENTS_SQL} SELECT post_id, comment_id, coalesce(parent_id, post_id) AS target_id, CASE WHEN parent_id IS NULL THEN 'post' ELSE 'comment' END AS target_type, 'reply_to' AS direction FROM comments
UNION ALL SELECT post_id, parent_id, comment_id, 'comment', 'reply_to_rev' FROM comments WHERE parent_id IS NOT NULL""",
)
def e_comment_reply(spark, sf_dir):
    return edges.comment_reply_edges(comments(spark, sf_dir))


@query(
    "e_image",
    """WITH p AS (SELECT page_id::VARCHAR AS source_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS u FROM pages), x AS (SELECT source_id, unnest(u) AS u FROM p)
SELECT source_id, 'img_' || md5(source_id || '|' || 'm/' || u)[:8] AS image_id, 'post' AS source_type, unnest(['contains', 'contained_by']) AS direction FROM x""",
)
def e_image(spark, sf_dir):
    links = extract.hrefs(F.col("html"))
    content = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("source_id"), F.lit("post").alias("source_type"), links.alias("image_urls"), F.transform(links, lambda x: F.concat(F.lit("m/"), x)).alias("local_images"))
    return edges.image_edges(edges.image_nodes(content))


_TAGS_SQL = f"WITH t AS (SELECT DISTINCT doc_id::VARCHAR AS post_id, unnest(regexp_extract_all({RICH_SQL}, '#([\\p{{L}}\\p{{N}}_]+)', 1)) AS hashtag FROM documents)"


@query("e_hashtag", _TAGS_SQL + " SELECT post_id, hashtag, unnest(['has_hashtag', 'in_post']) AS direction FROM t")
def e_hashtag(spark, sf_dir):
    return edges.hashtag_edges(posts(spark, sf_dir).select("post_id", text.hashtags(F.col("raw_text")).alias("hashtags")))


@query("e_hashtag_frequency", _TAGS_SQL + " SELECT hashtag, count(*) AS n_posts FROM t GROUP BY 1")
def e_hashtag_frequency(spark, sf_dir):
    return edges.hashtag_frequency(posts(spark, sf_dir).select("post_id", text.hashtags(F.col("raw_text")).alias("hashtags")))


@query(
    "e_post_post",
    """WITH t AS (SELECT DISTINCT l_orderkey AS p, l_partkey AS tag FROM lineitem), s AS (SELECT p, count(*) AS n FROM t GROUP BY 1),
x AS (SELECT a.p AS post_a, b.p AS post_b, count(*) AS n FROM t a JOIN t b ON a.tag = b.tag AND a.p < b.p GROUP BY 1, 2)
SELECT post_a, post_b, x.n AS n_shared, round_even(x.n::DOUBLE / (sa.n + sb.n - x.n), 4) AS score FROM x JOIN s sa ON sa.p = post_a JOIN s sb ON sb.p = post_b""",
)
def e_post_post(spark, sf_dir):
    tags = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("post_id"), F.col("l_partkey").alias("tag")).distinct()
    return edges.similar_posts(tags)


@query("e_commenters", f"WITH {COMMENTS_SQL} SELECT post_id, author_id, arg_min(author_name, ordinal) AS display_name FROM comments GROUP BY 1, 2")
def e_commenters(spark, sf_dir):
    return edges.commenters(comments(spark, sf_dir))


@query(
    "e_neighbours",
    f"""WITH {COMMENTS_SQL}, u AS (SELECT DISTINCT conv_id::VARCHAR AS post_id, role || '_1' AS user_id FROM conversations), c AS (SELECT post_id, author_id, arg_min(comment_id, ordinal) AS comment_id FROM comments GROUP BY 1, 2)
SELECT u.post_id, u.user_id, 'like' AS interaction_type, c.comment_id FROM u LEFT JOIN c ON c.post_id = u.post_id AND c.author_id = u.user_id""",
)
def e_neighbours(spark, sf_dir):
    users = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("post_id"), F.concat("role", F.lit("_1")).alias("user_id"), F.lit("like").alias("interaction_type")).distinct()
    return edges.neighbours(users, comments(spark, sf_dir)).drop("raw_text")


@query(
    "e_parent_by_name",
    f"""WITH {COMMENTS_SQL}, h AS (SELECT post_id, author_name, arg_min(comment_id, ordinal) AS p, min(ordinal) AS at FROM comments GROUP BY 1, 2)
SELECT c.post_id, c.comment_id, c.ordinal, coalesce(a.p, b.p) AS parent_id FROM comments c LEFT JOIN h a ON a.post_id = c.post_id AND a.author_name = 'USER 2' AND a.at < c.ordinal LEFT JOIN h b ON b.post_id = c.post_id AND b.author_name = 'USER 0' AND b.at < c.ordinal""",
)
def e_parent_by_name(spark, sf_dir):
    return edges.parents_by_name(comments(spark, sf_dir).withColumn("names", F.array(F.lit("USER 2"), F.lit("USER 0"))))


@query(
    "e_time_decay",
    """SELECT event_id, round(exp(-(epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY event_type ORDER BY ts, event_id)) / 1e6 / 3600), 6) AS weight FROM events""",
)
def e_time_decay(spark, sf_dir):
    rows = interactions(spark, sf_dir).select(F.col("event_type").alias("key"), F.col("event_id").alias("user"), "ts")
    return edges.time_decay(rows, 3600.0).select(F.col("user").alias("event_id"), "weight")


# Page sources.
@query("m_links", """WITH h AS (SELECT unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS href FROM pages) SELECT href, count(*) AS n FROM h GROUP BY 1""")
def m_links(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(F.explode(extract.hrefs(F.col("html"))).alias("href")).groupBy("href").agg(F.count("*").alias("n"))


BODY_SQL = """'{"post_id":"' || (page_id + 10000000000) || '"} {"reaction_type":"LOVE","count":' || (page_id % 4) || '} {"reaction_type":"LIKE","x":1,"count":' || page_id || '} {"share_count":{"count":' || (page_id % 9) || '}} {"count":1,"page_size":2,"total_count":' || (page_id % 5) || ',"is_not_behind_the_fold":1} pfbid' || md5('' || page_id)"""


@query(
    "m_embedded_counts",
    f"""WITH b AS (SELECT page_id, {BODY_SQL} AS b FROM pages)
SELECT page_id, page_id AS likes, (page_id % 4)::BIGINT AS loves, (page_id % 9)::BIGINT AS shares, (page_id % 5)::BIGINT AS n_comments, ['https://www.facebook.com/s/posts/pfbid' || md5('' || page_id), 'https://www.facebook.com/s/posts/' || (page_id + 10000000000)] AS links FROM b""",
)
def m_embedded_counts(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select("page_id", F.expr(BODY_SQL).alias("b"))
    b, r = F.col("b"), extract.reactions(F.col("b"))
    return rows.select("page_id", r["like"].alias("likes"), r["love"].alias("loves"), extract.share_count(b).alias("shares"), extract.comment_count(b, F.col("page_id").cast("string")).alias("n_comments"), extract.post_links(b, F.lit("s")).alias("links"))


BLANKS = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"


@query(
    "m_html_text",
    rf"""WITH a AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?s)<!--.*?-->|<![^>]*>', '', 'g'), '(?is)<(script|style)\b[^>]*>.*?</(script|style)\s*>', '', 'g') AS h FROM pages),
b AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(h, '(?i)<img\b[^>]*?\balt="([^"]*)"[^>]*>', '\1', 'g'), '(?i)<(br|p|div|li|h1|h2|h3|tr)(\s[^>]*)?/?>', chr(10), 'g'), '<[a-zA-Z/][^>]*>', '', 'g') AS h FROM a),
c AS (SELECT page_id, replace(replace(replace(replace(replace(replace(replace(replace(h, '&copy;', '©'), '&middot;', '·'), '&nbsp;', chr(160)), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&') AS h FROM b)
SELECT page_id, array_to_string(list_filter(list_transform(string_split(h, chr(10)), lambda x: trim(regexp_replace(x, '{BLANKS}+', ' ', 'g'))), lambda x: x <> ''), chr(10)) AS text FROM c""",
)
def m_html_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", extract.html_text(F.col("html")).alias("text"))


# Merges.
@query("s_upsert_last", "SELECT c_custkey, CASE WHEN c_nationkey < 12 THEN 'new' ELSE 'old' END AS state, c_acctbal + CASE WHEN c_nationkey < 12 THEN 2 ELSE 0 END AS balance FROM customer")
def s_upsert_last(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    old = c.select("c_custkey", F.lit("old").alias("state"), F.col("c_acctbal").alias("balance"), F.lit(0).alias("seq"))
    changes = F.when(F.col("c_nationkey") < 12, F.array(F.lit(1), F.lit(2))).otherwise(F.expr("cast(array() as array<int>)"))
    new = c.select("c_custkey", F.lit("new").alias("state"), F.explode(changes).alias("seq"), "c_acctbal").select("c_custkey", "state", (F.col("c_acctbal") + F.col("seq")).alias("balance"), "seq")
    return merge.upsert_last(old, new, ["c_custkey"], "seq").drop("seq")


@query("s_merge_first", "SELECT c_custkey, CASE WHEN c_acctbal >= 5000 THEN 'main' WHEN c_nationkey < 15 THEN 'w0' ELSE 'w1' END AS origin, c_name FROM customer")
def s_merge_first(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    part = lambda rows, name: rows.select("c_custkey", F.lit(name).alias("origin"), "c_name")
    return merge.merge_first([part(c.where("c_acctbal >= 5000"), "main"), part(c.where("c_nationkey < 15"), "w0"), part(c, "w1")], ["c_custkey"])


@query("f_anti_done", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def f_anti_done(spark, sf_dir):
    return merge.not_done(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels"), "doc_id")


@query("f_append_new", "SELECT c_custkey AS k, 'old' AS origin FROM customer WHERE c_acctbal >= 0 UNION ALL SELECT unnest([c_custkey, c_custkey]), 'new' FROM customer WHERE NOT coalesce(c_acctbal >= 0, false)")
def f_append_new(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    new = c.select(F.explode(F.array("c_custkey", "c_custkey")).alias("k"), F.lit("new").alias("origin"))
    return merge.append_new(c.where("c_acctbal >= 0").select(F.col("c_custkey").alias("k"), F.lit("old").alias("origin")), new, "k")


@query("f_pending", "WITH p AS (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN NULL ELSE url END AS url, CASE WHEN page_id % 2 = 0 THEN NULL ELSE 'q' || (page_id % 5) END AS query FROM pages) SELECT page_id FROM p WHERE url IS NOT NULL AND query IS DISTINCT FROM 'q1'")
def f_pending(spark, sf_dir):
    pending = table(spark, sf_dir, "pages").select("page_id", F.when(F.col("page_id") % 3 != 0, F.col("url")).alias("url"), F.when(F.col("page_id") % 2 != 0, F.concat(F.lit("q"), F.col("page_id") % 5)).alias("query"))
    return merge.drop_pending(pending, F.lit(None).cast("string"), F.lit("q1")).select("page_id")


@query("f_content_dedup", f"WITH {COMMENTS_SQL} SELECT post_id, arg_min(comment_id, ordinal) AS comment_id, min(ordinal) AS ordinal FROM comments GROUP BY post_id, author_id || ':' || substring(trim(raw_text), 1, 60)")
def f_content_dedup(spark, sf_dir):
    rows = comments(spark, sf_dir).select("post_id", "comment_id", "author_id", "author_name", "raw_text", "ordinal")
    return merge.dedup_content(rows, text.content_key(F.col("author_id"), F.col("author_name"), F.col("raw_text"))).select("post_id", "comment_id", "ordinal")


@query(
    "a_version_merge",
    """SELECT c_custkey AS post_id, CASE WHEN length(c_name || 'x') > length(c_name) AND c_custkey % 2 = 0 THEN c_name || 'x' ELSE c_name END AS raw_text, greatest(c_custkey % 7, c_custkey % 5) AS like_count, greatest(c_custkey % 3, 1) AS love_count, 0::BIGINT AS haha_count,
 greatest(c_nationkey, 9)::BIGINT AS comment_count, 1::BIGINT AS share_count, c_custkey % 4 AS wow_count, list_sort(list_distinct(['a', c_mktsegment, 'b'])) AS image_urls FROM customer""",
)
def a_version_merge(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    long = lambda x: F.lit(x).cast("long")
    feed = c.select(k.alias("post_id"), F.col("c_name").alias("raw_text"), (k % 7).alias("like_count"), (k % 3).alias("love_count"), long(0).alias("haha_count"), F.col("c_nationkey").cast("long").alias("comment_count"), long(1).alias("share_count"), (k % 4).alias("wow_count"), F.array(F.lit("a"), "c_mktsegment").alias("image_urls"))
    full = c.select(k.alias("post_id"), F.when(k % 2 == 0, F.concat("c_name", F.lit("x"))).otherwise("").alias("raw_text"), (k % 5).alias("like_count"), long(1).alias("love_count"), long(0).alias("haha_count"), long(9).alias("comment_count"), long(0).alias("share_count"), (k % 2).alias("wow_count"), F.array("c_mktsegment", F.lit("b")).alias("image_urls"))
    return merge.merge_versions(feed, full)


@query("a_chunks", "WITH c AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS o, count(*) OVER () AS n FROM customer) SELECT c_custkey, o AS ordinal, o // ((n + 6) // 7) AS chunk FROM c")
def a_chunks(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey")
    n = rows.count()
    return merge.dense_ordinal(rows, "c_custkey").select("c_custkey", F.col("ordinal").cast("long").alias("ordinal"), merge.split_chunks(n, 7, F.col("ordinal")).alias("chunk"))


@query("a_set_ops", "SELECT 'union' AS op, count(*) AS n FROM (SELECT doc_id FROM documents UNION SELECT doc_id FROM labels) UNION ALL SELECT 'intersect', count(*) FROM (SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels) UNION ALL SELECT 'except', count(*) FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)")
def a_set_ops(spark, sf_dir):
    a, b = (table(spark, sf_dir, t).select("doc_id") for t in ("documents", "labels"))
    return stats.table_counts({"union": a.union(b).distinct(), "intersect": a.intersect(b), "except": a.subtract(b)}).withColumnRenamed("name", "op")


# Statistics.
_NAMES = ("documents", "conversations", "pages", "events", "customer", "orders", "labels")


@query("a_stats", " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n FROM {t}" for t in _NAMES))
def a_stats(spark, sf_dir):
    return stats.table_counts({t: table(spark, sf_dir, t) for t in _NAMES})


@query("a_category", "SELECT coalesce(source, 'unknown') AS category, count(*) AS n, round_even(count(*) / 65000.0::DOUBLE * 100, 1) AS percent FROM documents GROUP BY 1")
def a_category(spark, sf_dir):
    return stats.by_category(table(spark, sf_dir, "documents"), "source", 65000)


@query("a_post_stats", "WITH c AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1) SELECT round(avg(n), 6) AS mean, max(n) AS largest, sum(n)::BIGINT AS total FROM c")
def a_post_stats(spark, sf_dir):
    return stats.spread_per_post(table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("n")), "n")


@query("a_topk_rich", "WITH c AS (SELECT conv_id, count(*) AS comments, count(*) FILTER (role = 'system') AS images, count(*) FILTER (turn % 3 = 0) AS w FROM conversations GROUP BY 1) SELECT conv_id, 10 * images + comments + 5 * w + 5 AS score FROM c ORDER BY score DESC, conv_id::VARCHAR DESC LIMIT 5")
def a_topk_rich(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    rows = c.groupBy("conv_id").agg(F.count("*").alias("comments"), F.count_if(F.col("role") == "system").alias("images"), F.count_if(F.col("turn") % 3 == 0).alias("comments_with_image")).withColumn("has_text", F.lit(True)).withColumn("path", F.col("conv_id").cast("string"))
    return stats.richest(rows, 5).select("conv_id", "score")


@query("a_rolling60", "SELECT event_id, least(count(*) OVER (PARTITION BY event_type ORDER BY epoch_us(ts) RANGE BETWEEN 59999999 PRECEDING AND CURRENT ROW), 100) AS recent FROM events")
def a_rolling60(spark, sf_dir):
    return stats.rolling_count(interactions(spark, sf_dir), "event_type", "ts").select("event_id", F.col("recent").cast("long").alias("recent"))


@query("a_ewma", "WITH e AS (SELECT user_id, list(value ORDER BY event_id) AS v FROM events GROUP BY 1) SELECT user_id, round(list_reduce(v, lambda a, x: a * 0.8::DOUBLE + x * 0.2::DOUBLE, 0.0::DOUBLE), 6) AS ewma, len(v) AS n FROM e")
def a_ewma(spark, sf_dir):
    return stats.ewma(table(spark, sf_dir, "events").select("user_id", "event_id", "value"), "user_id", "event_id", "value")


@query(
    "a_backoff",
    """WITH m AS (SELECT user_id, list_prepend(0, list(CASE event_type WHEN 'error' THEN 1 WHEN 'signup' THEN 3 ELSE -1 END ORDER BY event_id)) AS m FROM events GROUP BY 1), l AS (SELECT user_id, list_reduce(m, lambda a, x: greatest(0, a + x))::INT AS level FROM m)
SELECT user_id, level, CASE WHEN level > 0 THEN least(300.0::DOUBLE, 4.0::DOUBLE * pow(2.0, level)) END AS delay FROM l""",
)
def a_backoff(spark, sf_dir):
    kind = F.expr("CASE event_type WHEN 'error' THEN 'throttle' WHEN 'signup' THEN 'ban' ELSE 'success' END")
    return stats.backoff(table(spark, sf_dir, "events").select("user_id", "event_id", kind.alias("kind")), "user_id", "event_id", "kind")


@query(
    "a_streak",
    """WITH e AS (SELECT user_id, event_id, event_type IN ('error', 'view') AS bad FROM events), r AS (SELECT *, sum(CASE WHEN bad THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM e)
SELECT user_id, min(event_id) AS first, max(event_id) AS last, count(*) AS length FROM r WHERE bad GROUP BY user_id, run HAVING count(*) >= 3""",
)
def a_streak(spark, sf_dir):
    return stats.failure_streaks(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), "user_id", "event_id", F.col("event_type").isin("error", "view"))


@query("a_conditional_counts", "SELECT event_type, count(*) FILTER (value > 50) AS n_high, count(*) FILTER (value <= 50) AS n_low, arg_min(event_id, (value, event_id)) AS least FROM events GROUP BY 1")
def a_conditional_counts(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count_if(F.col("value") > 50).alias("n_high"), F.count_if(F.col("value") <= 50).alias("n_low"), F.min_by("event_id", F.struct("value", "event_id")).alias("least"))


@query("a_run_counters", "SELECT count(*) FILTER (event_type <> 'error') AS total_done, count(*) FILTER (event_type = 'error') AS total_failed, count(DISTINCT user_id) FILTER (event_type <> 'error') AS distinct_done FROM events")
def a_run_counters(spark, sf_dir):
    return stats.run_counters(table(spark, sf_dir, "events").select(F.col("user_id").alias("id"), F.when(F.col("event_type") == "error", "failed").otherwise("done").alias("status")))


# Vectors.
@query("v_log1p", "SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: round(ln(1 + abs(x)), 6)) AS v FROM embeddings")
def v_log1p(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.transform(vector.log1p(F.transform(vector.as_double(F.col("embedding")), F.abs)), lambda x: vector.rounded(x, 6)).alias("v"))


@query("v_meanpool", "WITH x AS (SELECT label, vec_id, unnest(embedding::DOUBLE[]) AS v, generate_subscripts(embedding, 1) AS d FROM embeddings), m AS (SELECT label, d, avg(v) AS v FROM x GROUP BY 1, 2) SELECT label, list(round(v, 5) ORDER BY d) AS pooled FROM m GROUP BY 1")
def v_meanpool(spark, sf_dir):
    out = vector.pooled(table(spark, sf_dir, "embeddings"), "label", "embedding")
    return out.select("label", F.transform("pooled", lambda x: vector.rounded(x, 5)).alias("pooled"))


@query(
    "v_topo_weight",
    f"WITH {COMMENTS_SQL}, d AS (SELECT post_id, parent_id AS comment_id, count(*) AS d FROM comments WHERE parent_id IS NOT NULL GROUP BY 1, 2), x AS (SELECT c.post_id, c.comment_id, coalesce(d.d, 0) AS d FROM comments c LEFT JOIN d USING (post_id, comment_id)) SELECT post_id, comment_id, d, round((1 + d) / sum(1 + d) OVER (PARTITION BY post_id), 6) AS alpha FROM x",
)
def v_topo_weight(spark, sf_dir):
    return vector.topology_weights(comments(spark, sf_dir)).withColumn("alpha", vector.rounded(F.col("alpha"), 6))


_PAIRS_SQL = """WITH p AS (SELECT a.vec_id // 32 AS batch, a.vec_id // 2 AS i, a.embedding::DOUBLE[] AS a, b.embedding::DOUBLE[] AS b FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1 WHERE a.vec_id % 2 = 0),
l AS (SELECT x.batch, x.i, y.i AS j, list_dot_product(x.a, y.b) / sqrt(list_dot_product(x.a, x.a)) / sqrt(list_dot_product(y.b, y.b)) / 0.07 AS l FROM p x JOIN p y ON x.batch = y.batch)"""


def _pairs(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    a = e.where("vec_id % 2 = 0").select(F.expr("vec_id div 32").alias("batch"), F.expr("vec_id div 2").alias("row"), F.col("embedding").alias("a"))
    b = e.where("vec_id % 2 = 1").select(F.expr("(vec_id - 1) div 2").alias("row"), F.col("embedding").alias("b"))
    return vector.batch_logits(a.join(b, "row"), "batch", "row", "a", "b")


@query("v_cosine", _PAIRS_SQL + " SELECT batch, i, j, round(l * 0.07, 5) AS cosine FROM l")
def v_cosine(spark, sf_dir):
    return _pairs(spark, sf_dir).select("batch", "i", "j", vector.rounded(F.col("logit") * vector.TEMPERATURE, 5).alias("cosine"))


@query("v_ntxent", _PAIRS_SQL + ", m AS (SELECT batch, i, max(l) AS m, arg_max(j, l) AS best, max(l) FILTER (i = j) AS own FROM l GROUP BY 1, 2), s AS (SELECT l.batch, l.i, ln(sum(exp(l - m))) + any_value(m) - any_value(own) AS loss, any_value(best) = l.i AS hit FROM l JOIN m ON l.batch = m.batch AND l.i = m.i GROUP BY 1, 2) SELECT batch, round(avg(loss), 5) AS loss, round(avg(hit::INT::DOUBLE), 6) AS accuracy, count(*) AS n FROM s GROUP BY 1")
def v_ntxent(spark, sf_dir):
    return vector.ntxent(_pairs(spark, sf_dir), "batch")


# Streams.
@query("st_tumbling", "SELECT epoch_us(time_bucket(INTERVAL 10 MINUTE, ts)) AS start_us, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def st_tumbling(spark, sf_dir):
    return windows.tumbling(interactions(spark, sf_dir), "10 minutes")


@query("st_sliding", "WITH s AS (SELECT event_type, unnest([epoch_us(time_bucket(INTERVAL 5 MINUTE, ts)), epoch_us(time_bucket(INTERVAL 5 MINUTE, ts)) - 300000000]) AS start_us FROM events) SELECT start_us, event_type, count(*) AS n FROM s GROUP BY 1, 2")
def st_sliding(spark, sf_dir):
    return windows.sliding(interactions(spark, sf_dir), "10 minutes", "5 minutes")


@query("st_session", "WITH e AS (SELECT user_id, epoch_us(ts) AS t FROM events), g AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY user_id ORDER BY t) < 1800000000 THEN 0 ELSE 1 END AS fresh FROM e), r AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS s FROM g) SELECT user_id::VARCHAR AS user_id, min(t) AS start_us, count(*) AS n FROM r GROUP BY user_id, s")
def st_session(spark, sf_dir):
    return windows.sessions(interactions(spark, sf_dir), "30 minutes")


@query("st_dedup", "SELECT user_id::VARCHAR AS user_id, event_type, min(event_id) AS event_id FROM events GROUP BY 1, 2")
def st_dedup(spark, sf_dir):
    return edges.first_wins(interactions(spark, sf_dir).select("user_id", "event_type", "event_id"), ["user_id", "event_type"], "event_id").select("user_id", "event_type", "event_id")
