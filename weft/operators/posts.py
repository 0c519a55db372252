"""Posts put together from what a captured page holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.functions import elements, extract, lists, text, urls
from weft.operators.merge import fill_missing

# Parts of image links of posts, and of those that are none.
IMAGE_PARTS, OTHER_PARTS = ("scontent", "fbcdn"), ("emoji", "rsrc.php", "static")
COUNTS = ("like", "love", "haha", "wow", "sad", "angry", "care")


def known_id(url: Column) -> Column:
    """Id of a link, else a stable one made from the link."""
    return F.coalesce(urls.post_id(url), F.concat(F.lit("unknown_"), F.substring(F.md5(url), 1, 8)))


def assemble_posts(captures: DataFrame) -> DataFrame:
    """A row with all fields of a post for each capture.

    From url, title, description, candidates (texts), labels (of elements), body (text of the page), html, links (array of
    name and href), heading, utime, time_label, images, videos, location, tagged. Counts: labels first, what is 0 there from
    the embedded data, comments and shares of which have patterns of their own. A photo's page is a post of type ``photo``."""
    u, html = F.col("url"), F.coalesce("html", F.lit(""))
    chosen = captures.withColumn("raw_text", extract.select_text(F.left(text.title_excerpt(F.coalesce("title", F.lit(""))), F.lit(25)), F.coalesce("description", F.lit("")), F.coalesce("candidates", F.expr("cast(array() as array<string>)"))))
    seen = extract.label_reactions(F.coalesce("labels", F.expr("cast(array() as array<string>)")), F.coalesce("body", F.lit("")))
    rows = chosen.withColumn("post_id", known_id(u)).withColumn("__seen", seen).withColumn("__data", extract.reactions(html)).withColumn("__author", elements.author(F.coalesce("links", F.expr("cast(array() as array<struct<name:string,href:string>>)")), u, F.coalesce("heading", F.lit(""))))
    raw = F.col("raw_text")
    counts = {f"{c}_count": fill_missing(F.col(f"__seen.{c}"), F.col(f"__data.{c}")) for c in COUNTS}
    counts["comment_count"] = fill_missing(F.col("__seen.comment_count"), extract.comment_count(html, F.col("post_id")))
    counts["share_count"] = fill_missing(F.col("__seen.share_count"), extract.share_count(html))
    return rows.select(
        "post_id",
        urls.normalize_url(u).alias("post_url"),
        "raw_text",
        text.clean_text(raw).alias("cleaned_text"),
        text.hashtags(raw).alias("hashtags"),
        text.mentions(raw).alias("mentions"),
        text.emojis(raw).alias("emojis"),
        text.external_links(raw).alias("external_links"),
        F.col("__author.user_id").alias("author_id"),
        F.col("__author.name").alias("author_name"),
        elements.timestamp(F.col("utime"), F.col("time_label")).alias("timestamp"),
        extract.media_urls(F.coalesce("images", F.expr("cast(array() as array<string>)")), IMAGE_PARTS, OTHER_PARTS).alias("image_urls"),
        F.array_distinct(F.coalesce("videos", F.expr("cast(array() as array<string>)"))).alias("video_urls"),
        *[c.alias(n) for n, c in counts.items()],
        lists.total_reactions(*[counts[f"{c}_count"] for c in COUNTS]).alias("total_reactions"),
        "location",
        lists.unique_links(F.coalesce("tagged", F.expr("cast(array() as array<string>)")), urls.RESERVED_SLUGS).alias("tagged_users"),
        u.alias("source_page"),
        lists.post_type(u).alias("post_type"),
    )
