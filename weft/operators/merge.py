"""Ordered upserts, merges, anti-joins and version merging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.operators.edges import first_wins


def upsert_last(old: DataFrame, new: DataFrame, key: list[str], seq: str) -> DataFrame:
    """Whole rows replaced by key; among equal keys the highest ``seq`` of the new rows stays."""
    both = old.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
    rest = [c for c in both.columns if c not in key]
    best = both.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct("__new", seq)).alias("r"))
    return best.select(*key, *[F.col(f"r.{c}").alias(c) for c in rest if c != "__new"])


def merge_first(tables: list[DataFrame], key: list[str]) -> DataFrame:
    """Rows of all tables; for a key the row of the first table that has it."""
    ranked = None
    for rank, table in enumerate(tables):
        part = table.withColumn("__rank", F.lit(rank))
        ranked = part if ranked is None else ranked.unionByName(part)
    return first_wins(ranked, key, "__rank").drop("__rank")


def not_done(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return rows.join(done.select(key).distinct(), key, "left_anti")


def append_new(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Old rows and the new ones whose key is unknown; new rows aren't compared with each other."""
    return old.unionByName(new.join(old.select(key).distinct(), key, "left_anti").select(*old.columns))


def drop_pending(pending: DataFrame, url: Column, query: Column) -> DataFrame:
    """Rows that differ in both url and query; null equals null."""
    return pending.where(~F.col("url").eqNullSafe(url) & ~F.col("query").eqNullSafe(query))


def dedup_content(rows: DataFrame, content_key: Column) -> DataFrame:
    """First row of each post and content, then of each comment id."""
    one = first_wins(rows.withColumn("__key", content_key), ["post_id", "__key"]).drop("__key")
    return first_wins(one, ["post_id", "comment_id"])


def merge_versions(feed: DataFrame, full: DataFrame) -> DataFrame:
    """Two versions of posts: longer text, larger counts of five kinds, union of lists, place if none.

    Counts of the other kinds stay those of the feed."""
    f = full.select("post_id", *[F.col(c).alias(f"{c}_full") for c in full.columns if c != "post_id"])
    both = feed.join(f, "post_id", "left")
    longer = F.length(F.coalesce("raw_text_full", F.lit(""))) > F.length(F.coalesce("raw_text", F.lit("")))
    out = both.withColumn("raw_text", F.when(longer, F.col("raw_text_full")).otherwise(F.col("raw_text")))
    for c in ("like_count", "love_count", "haha_count", "comment_count", "share_count"):
        out = out.withColumn(c, F.greatest(c, f"{c}_full"))
    for c in ("image_urls", "video_urls", "tagged_users"):
        if c in feed.columns:
            out = out.withColumn(c, F.array_sort(F.array_union(F.coalesce(c, F.array()), F.coalesce(f"{c}_full", F.array()))))
    if "location" in feed.columns:
        out = out.withColumn("location", F.coalesce(F.nullif("location", F.lit("")), "location_full"))
    return out.select(*feed.columns)


def fill_missing(first: Column, second: Column) -> Column:
    """The first count unless it is 0."""
    return F.when(F.coalesce(first, F.lit(0)) == 0, second).otherwise(first)


def split_chunks(n_rows: int, k: int, ordinal: Column) -> Column:
    """Number of the contiguous chunk, at most ``k``, each of ceil(n / k) rows but the last."""
    return F.floor(ordinal / max(1, -(-n_rows // k)))


def dense_ordinal(rows: DataFrame, order: str, parts: int = 32) -> DataFrame:
    """``ordinal`` from 0 by a unique ``order`` (not null) without one task for all rows: ranges, then ranks inside them.

    The ranges are cut at stated values, a hashed sample of at most some thousand, so a row's range follows
    from the row alone, however often a stage runs."""
    every = max(1, rows.count() // (64 * parts))
    sample = sorted(r[0] for r in rows.where(F.pmod(F.xxhash64(order), F.lit(every)) == 0).select(order).collect())
    cuts = sorted({sample[len(sample) * j // parts] for j in range(1, parts)}) if sample else []
    part = sum((F.when(F.col(order) >= F.lit(c), 1).otherwise(0) for c in cuts), F.lit(0))
    ranged = rows.withColumn("__part", part)
    counts = ranged.groupBy("__part").agg(F.count("*").alias("n"))
    base = counts.select("__part", F.coalesce(F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy("__part").orderBy(order)) - 1
    return ranged.withColumn("__in", inside).join(base, "__part").withColumn("ordinal", F.col("__in") + F.col("base")).drop("__part", "__in", "base")
