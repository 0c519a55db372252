"""Domain tables built from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as a branching tree: turn t replies to turn (t - 1) div 2."""
    parent = F.when(F.col("turn") > 0, F.concat_ws("-", "conv_id", F.expr("(turn - 1) div 2")))
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("post_id"),
        F.concat_ws("-", "conv_id", "turn").alias("comment_id"),
        parent.alias("parent_id"),
        F.concat_ws("_", "role", F.expr("turn % 3")).alias("author_id"),
        F.concat(F.upper("role"), F.lit(" "), F.expr("turn % 3")).alias("author_name"),
        F.col("text").alias("raw_text"),
        F.concat(F.lit("t"), F.col("turn")).alias("timestamp"),
        F.col("turn").alias("ordinal"),
        F.when(F.col("turn") % 2 == 1, F.array(F.struct(F.lit("User 0").alias("name"), F.concat(F.lit("https://x.org/?id="), F.col("conv_id")).alias("href")))).otherwise(F.expr("cast(array() as array<struct<name:string,href:string>>)")).alias("mentioned_users"),
    )


COMMENTS_SQL = """comments AS (SELECT conv_id::VARCHAR AS post_id, conv_id || '-' || turn AS comment_id,
  CASE WHEN turn > 0 THEN conv_id || '-' || ((turn - 1) // 2) END AS parent_id, role || '_' || (turn % 3) AS author_id,
  upper(role) || ' ' || (turn % 3) AS author_name, text AS raw_text, 't' || turn AS timestamp, turn AS ordinal, conv_id FROM conversations)"""

TREE_SQL = (
    "WITH RECURSIVE "
    + COMMENTS_SQL
    + """, tree AS (SELECT post_id, comment_id, parent_id, author_id, 0 AS depth, lpad(ordinal::VARCHAR, 10, '0') AS path FROM comments WHERE parent_id IS NULL
  UNION ALL SELECT c.post_id, c.comment_id, c.parent_id, c.author_id, t.depth + 1, t.path || '.' || lpad(c.ordinal::VARCHAR, 10, '0')
  FROM comments c JOIN tree t ON c.post_id = t.post_id AND c.parent_id = t.comment_id)"""
)


def rich_text():
    """Text with tags, a mention and a link, built from the columns of ``documents``."""
    return F.concat(F.coalesce("text", F.lit("")), F.lit(" #"), "lang", F.lit(" #"), "source", F.lit(" @"), "source", F.lit(" https://ex.org/"), F.col("doc_id").cast("string"))


RICH_SQL = "coalesce(text, '') || ' #' || lang || ' #' || source || ' @' || source || ' https://ex.org/' || doc_id"


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("post_id"), F.col("source").alias("author_id"), rich_text().alias("raw_text"), "lang")


INTERACTION_SQL = "CASE event_type WHEN 'view' THEN 'like' WHEN 'click' THEN 'comment' WHEN 'purchase' THEN 'share' WHEN 'signup' THEN 'author' ELSE 'angry' END"


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.expr(INTERACTION_SQL)
    return table(spark, sf_dir, "events").select("event_id", F.col("user_id").cast("string").alias("user_id"), (F.col("event_id") % 500).cast("string").alias("post_id"), kind.alias("interaction_type"), F.lit(1.0).alias("weight"), F.col("ts").cast("timestamp").alias("ts"), "value", "event_type")
