"""Queries of captured pages: embedded data, labels, elements, whole posts and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft.functions import elements, extract
from weft.operators import edges, posts
from weft.plans.catalog import query
from weft.plans.standins import table

OG_SQL = "CASE page_id % 4 WHEN 0 THEN '<meta property=\"og:url\" content=\"https://f.com/x?story_fbid=' || page_id || '&id=2\">' WHEN 1 THEN '<meta name=\"a\" property=\"og:url\" content=\"https://f.com/p/posts/' || page_id || '/\">' WHEN 2 THEN '<meta property=\"og:title\" content=\"/posts/1\">' ELSE '' END || html"


@query("m_og_story_id", "SELECT page_id, CASE WHEN page_id % 4 < 2 THEN page_id::VARCHAR END AS id FROM pages")
def m_og_story_id(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", extract.og_story_id(F.expr(OG_SQL)).alias("id"))


WINDOW_SQL = "repeat('x', CAST(page_id % 3 * 4000 AS INT)) || CASE page_id % 4 WHEN 0 THEN 'id' || page_id || ' \"id' || page_id || '\"' WHEN 1 THEN 'bare id' || page_id ELSE 'absent' END || repeat('y', 40000)"


@query(
    "m_window",
    f"""WITH s AS (SELECT page_id, 'id' || page_id AS a, {WINDOW_SQL} AS h FROM pages), p AS (SELECT *, CASE WHEN instr(h, '"' || a || '"') > 0 THEN instr(h, '"' || a || '"') ELSE instr(h, a) END - 1 AS place FROM s)
SELECT page_id, length(CASE WHEN place > 0 THEN h[greatest(place - 5000, 0) + 1 : place + 30000] ELSE h END) AS n, md5(CASE WHEN place > 0 THEN h[greatest(place - 5000, 0) + 1 : place + 30000] ELSE h END) AS digest FROM p""",
)
def m_window(spark, sf_dir):
    cut = extract.window(F.expr(WINDOW_SQL), F.concat(F.lit("id"), "page_id"))
    return table(spark, sf_dir, "pages").select("page_id", F.length(cut).cast("long").alias("n"), F.md5(cut).alias("digest"))


@query(
    "m_label_reactions",
    """SELECT page_id, CASE page_id % 4 WHEN 0 THEN 1000 + page_id % 1000 WHEN 1 THEN 3 WHEN 2 THEN page_id ELSE 0 END AS likes, CASE WHEN page_id % 4 = 0 THEN 2000::BIGINT WHEN page_id % 4 = 1 THEN 1 ELSE 0 END AS loves, CASE WHEN page_id % 4 = 1 THEN page_id ELSE 0 END AS angry,
 CASE WHEN page_id % 4 = 2 THEN 1200::BIGINT ELSE 0 END AS comments, CASE WHEN page_id % 4 = 2 THEN 4000::BIGINT ELSE 0 END AS shares FROM pages""",
)
def m_label_reactions(spark, sf_dir):
    p = F.col("page_id")
    text = lambda *parts: F.concat(*[x if isinstance(x, type(p)) else F.lit(x) for x in parts])
    labels = F.when(p % 4 == 0, F.array(text("Yêu thích: 2k NGƯỜI"), text("Thích: 1.", F.lpad((p % 1000).cast("string"), 3, "0"), " người"), text("Like: 5 people"))).when(p % 4 == 1, F.array(text("Like: 3 people"), text("Love: 1 people"), text("Angry: ", p, " people"))).otherwise(F.array(F.lit("Wow: none")))
    body = F.when(p % 4 == 2, text("x ", p, " lượt thích\n1,200 Comments 4 k chia sẻ")).otherwise("nothing")
    r = extract.label_reactions(labels, body)
    return table(spark, sf_dir, "pages").select("page_id", r["like"].alias("likes"), r["love"].alias("loves"), r["angry"].alias("angry"), r["comment_count"].alias("comments"), r["share_count"].alias("shares"))


@query("m_select_text", "SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'the start of text ' || page_id WHEN 1 THEN 'described here and more' WHEN 2 THEN 'only described ' || page_id ELSE 'first' END AS text FROM pages")
def m_select_text(spark, sf_dir):
    p = F.col("page_id")
    title = F.when(p % 4 == 0, F.concat(F.lit("the start of text "), p)).otherwise("")
    description = F.when(p % 4 == 1, "described here").when(p % 4 == 2, F.concat(F.lit("only described "), p)).otherwise("")
    candidates = F.array(F.lit("first"), F.lit("described here and more"), F.concat(F.lit("the start of text "), p))
    return table(spark, sf_dir, "pages").select("page_id", extract.select_text(title, description, candidates).alias("text"))


@query(
    "m_author",
    """SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'owner' || page_id WHEN 1 THEN 'slug' || page_id END AS user_id, CASE page_id % 4 WHEN 0 THEN 'Named ' || page_id WHEN 1 THEN 'The Page' WHEN 2 THEN 'Head ' || page_id END AS name,
 CASE WHEN page_id % 3 = 0 THEN strftime(make_timestamp(page_id * 1000000), '%Y-%m-%dT%H:%M:%S') || '+00:00' WHEN page_id % 3 = 1 THEN '2 giờ trước' END AS at FROM pages""",
)
def m_author(spark, sf_dir):
    p = F.col("page_id")
    link = lambda name, href: F.struct(name.alias("name"), href.alias("href"))
    c = lambda *parts: F.concat(*[x if isinstance(x, type(p)) else F.lit(x) for x in parts])
    named = F.array(link(F.lit(" "), F.lit("/x")), link(c("Named ", p, "\n"), c("/owner", p, "?r=1")))
    # nameless ones first: the owner of the path is found among the links of its own page only
    slugs = F.array(link(F.lit(""), c("https://www.facebook.com/slug", p, "/posts/1")), link(F.lit("\t"), c("https://www.facebook.com/slug", p)))
    links = F.when(p % 4 == 0, named).when(p % 4 == 1, F.array(link(F.lit("The  Page"), c("https://www.facebook.com/Slug", p, "/")))).otherwise(slugs)
    url = c("https://www.facebook.com/slug", p, "/posts/9")
    heading = F.when(p % 4 == 2, c("Posts by Head ", p)).otherwise("no heading")
    at = elements.timestamp(F.when(p % 3 == 0, p.cast("string")), F.when(p % 3 == 1, "2 giờ trước").otherwise(""))
    found = elements.author(links, url, heading)
    by_slug = elements.author_by_slug(links, url)
    rows = table(spark, sf_dir, "pages").select("page_id", found.alias("a"), by_slug.alias("s"), at.alias("at"))
    return rows.select("page_id", F.when(p % 4 == 1, F.lower(F.coalesce("s.user_id", "a.user_id"))).otherwise(F.col("a.user_id")).alias("user_id"), F.when(p % 4 == 1, F.col("s.name")).otherwise(F.col("a.name")).alias("name"), "at")


PROFILE_SQL = """'<meta property="og:title" content=" N' || page_id || ' "><meta property="og:description" content="  a' || chr(9) || 'bio ' || page_id || '"><b>' || page_id || ' followers</b><b>2K friends</b>' || CASE WHEN page_id % 2 = 0 THEN '<i aria-label="Verified account"></i>Lives in Town ' || page_id || '</span>' ELSE '' END"""


@query("m_profile", "SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'unknown' ELSE 'p' || page_id END AS user_id, 'N' || page_id AS display_name, 'a bio ' || page_id AS bio, nullif(page_id, 0) AS followers, 2000::BIGINT AS friends, page_id % 2 = 0 AS verified, page_id % 3 = 0 AS is_page, CASE WHEN page_id % 2 = 0 THEN 'Town ' || page_id END AS location FROM pages")
def m_profile(spark, sf_dir):
    p = F.col("page_id")
    url = F.when(p % 3 == 0, "https://www.facebook.com/pages").otherwise(F.concat(F.lit("https://www.facebook.com/p"), p))
    r = elements.profile(F.expr(PROFILE_SQL), url)
    rows = table(spark, sf_dir, "pages").select("page_id", r.alias("r"))
    return rows.select("page_id", "r.user_id", "r.display_name", "r.bio", F.col("r.follower_count").alias("followers"), F.col("r.friend_count").alias("friends"), F.col("r.is_verified").alias("verified"), F.col("r.is_page").alias("is_page"), "r.location")


CAPTURED_SQL = """'<div role="article" aria-label="Replied to Ann''s comment"><a href="https://www.facebook.com/u' || page_id || '?comment_id=' || page_id || '1">Bo ' || page_id || '</a><div dir="auto">said #tag' || (page_id % 3) || ' <img alt="☺"> @x</div><img src="https://scontent.x/' || page_id || '.jpg"><a href="https://www.facebook.com/c">Cy</a></div>'
 || '<div role="article"><a href="https://www.facebook.com/ann">Ann</a><div dir="auto">' || CASE WHEN page_id % 2 = 0 THEN 'text ' || page_id ELSE '' END || '</div></div><div role="article"><a href="https://www.facebook.com/z">Find friends</a><div dir="auto">noise</div></div>'"""


@query(
    "m_comments",
    """SELECT page_id::VARCHAR AS post_id, page_id || '1' AS comment_id, 'u' || page_id AS author_id, 'Bo ' || page_id AS author_name, 'said #tag' || (page_id % 3) || ' ☺ @x' AS raw_text, ['tag' || (page_id % 3)] AS hashtags, ['x'] AS mentions, ['Cy'] AS links, ['https://scontent.x/' || page_id || '.jpg'] AS images, 0 AS ordinal FROM pages
UNION ALL SELECT page_id::VARCHAR, 'cmt_' || md5('|https://www.facebook.com/ann|text ' || page_id)[:8], 'ann', 'Ann', 'text ' || page_id, [], [], [], [], 1 FROM pages WHERE page_id % 2 = 0""",
)
def m_comments(spark, sf_dir):
    captured = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("post_id"), F.expr(CAPTURED_SQL.replace("''s", "\\'s")).alias("html"))
    rows = elements.comment_rows(captured, "post_id", "html")
    return rows.select("post_id", "comment_id", "author_id", "author_name", "raw_text", "hashtags", "mentions", F.transform("mentioned_users", lambda x: x["name"]).alias("links"), F.col("image_urls").alias("images"), F.col("ordinal").cast("int").alias("ordinal"))


@query(
    "m_comment_parents",
    """SELECT page_id::VARCHAR AS post_id, 1 AS ordinal, 'first' || page_id AS parent_id FROM pages WHERE page_id % 2 = 0 UNION ALL SELECT page_id::VARCHAR, 0, NULL FROM pages UNION ALL SELECT page_id::VARCHAR, 1, NULL FROM pages WHERE page_id % 2 = 1""",
)
def m_comment_parents(spark, sf_dir):
    from weft.functions.text import parent_names

    p = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("post_id"), "page_id")
    rows = p.select("post_id", F.explode(F.array(F.struct(F.concat(F.lit("first"), "page_id").alias("comment_id"), F.lit("Ann").alias("author_name"), F.lit("").alias("label"), F.lit(0).alias("ordinal")), F.struct(F.concat(F.lit("second"), "page_id").alias("comment_id"), F.lit("Bo").alias("author_name"), F.when(F.col("page_id") % 2 == 0, "Replied to Ann's comment").otherwise("Replied to Nobody's comment").alias("label"), F.lit(1).alias("ordinal")))).alias("r")).select("post_id", "r.*")
    return edges.parents_by_name(rows.withColumn("names", parent_names(F.col("label")))).select("post_id", "ordinal", "parent_id")


@query(
    "m_posts",
    """SELECT CASE WHEN page_id % 5 = 4 THEN 'unknown_' || md5('https://www.facebook.com/x' || page_id)[:8] ELSE page_id::VARCHAR END AS post_id, CASE WHEN page_id % 5 = 4 THEN 'https://www.facebook.com/x' || page_id WHEN page_id % 5 = 3 THEN 'https://www.facebook.com/photo/?fbid=' || page_id ELSE 'https://www.facebook.com/page' || page_id || '/posts/' || page_id END AS post_url,
 'Hello  #tag' || page_id || ' @ann https://l.org' AS raw_text, 'Hello #tag' || page_id || ' @ann https://l.org' AS cleaned_text, ['tag' || page_id] AS hashtags, ['ann'] AS mentions, ['https://l.org'] AS external_links, 'owner' || page_id AS author_id, 'Owner' AS author_name, '1970-01-01T00:01:40+00:00' AS timestamp,
 ['https://scontent.x/' || page_id || '.jpg'] AS image_urls, CASE WHEN page_id % 2 = 0 THEN 7 ELSE page_id END AS like_count, 0::BIGINT AS love_count, 9::BIGINT AS comment_count, 4::BIGINT AS share_count, CASE WHEN page_id % 2 = 0 THEN 7 ELSE page_id END AS total_reactions, 'Town' AS location, ['tagged'] AS tagged_users, CASE WHEN page_id % 5 = 3 THEN 'photo' ELSE 'post' END AS post_type FROM pages""",
)
def m_posts(spark, sf_dir):
    p = F.col("page_id")
    c = lambda *parts: F.concat(*[x if isinstance(x, type(p)) else F.lit(x) for x in parts])
    said = c("Hello  #tag", p, " @ann https://l.org")
    captures = table(spark, sf_dir, "pages").select(
        F.when(p % 5 == 4, c("https://www.facebook.com/x", p, "?utm=1")).when(p % 5 == 3, c("https://www.facebook.com/photo/?fbid=", p, "&set=a")).otherwise(c("https://www.facebook.com/page", p, "/posts/", p, "#c")).alias("url"),
        c("(2) Page - ", F.left(said, F.lit(12)), " | Site").alias("title"),
        F.lit("").alias("description"),
        F.array(F.lit("another text"), said).alias("candidates"),
        F.when(p % 2 == 0, F.array(F.lit("Like: 7 people"))).otherwise(F.array(F.lit("x"))).alias("labels"),
        F.lit("no counts").alias("body"),
        c('{"reaction_type":"LIKE","count":', p, '} {"share_count":{"count":4}} {"count":1,"page_size":2,"total_count":9,"is_not_behind_the_fold":1}').alias("html"),
        F.array(F.struct(F.lit("Owner").alias("name"), c("/owner", p).alias("href"))).alias("links"),
        F.lit("").alias("heading"),
        F.lit("100").alias("utime"),
        F.lit("").alias("time_label"),
        F.array(c("https://scontent.x/", p, ".jpg"), F.lit("https://scontent.x/emoji.png")).alias("images"),
        F.lit(None).cast("array<string>").alias("videos"),
        F.lit("Town").alias("location"),
        F.array(F.lit("https://www.facebook.com/tagged"), F.lit("https://www.facebook.com/groups")).alias("tagged"),
    )
    out = posts.assemble_posts(captures)
    unknown = F.col("post_id").startswith("unknown_")
    # the made-up id stands for the whole link, the statement for the one without its query
    return out.select(
        F.when(unknown, F.concat(F.lit("unknown_"), F.substring(F.md5("post_url"), 1, 8))).otherwise(F.col("post_id")).alias("post_id"), "post_url", "raw_text", "cleaned_text", "hashtags", "mentions", "external_links", "author_id", "author_name", "timestamp", "image_urls",
        "like_count", "love_count", "comment_count", "share_count", "total_reactions", "location", "tagged_users", "post_type",
    )
