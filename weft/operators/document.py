"""The whole document of a sample, as JSON text, out of the tables of a corpus."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALL_FIELDS = {"ignoreNullFields": "false"}


def sample_id(post_id):
    return F.concat(F.lit("g_"), F.substring(F.md5(post_id), 1, 8))


def _gathered(rows: DataFrame, name: str, order: list[str]) -> DataFrame:
    """post_id and an array of the other columns as structs, in order; a post's document is one row by definition."""
    fields = [c for c in rows.columns if c not in ("post_id", *order)]
    packed = rows.select("post_id", F.struct(*order, F.struct(*fields).alias("__r")).alias("__s"))
    return packed.groupBy("post_id").agg(F.sort_array(F.collect_list("__s")).alias("__s")).select("post_id", F.transform("__s", lambda x: x["__r"]).alias(name))


def neighbours(user_post: DataFrame, comments: DataFrame) -> DataFrame:
    """Interactions but authorship, with the first comment of the same user on the post where there is one."""
    first = comments.groupBy("post_id", F.col("author_id").alias("user_id")).agg(F.min_by(F.struct("raw_text", "comment_id"), "ordinal").alias("c"))
    rows = user_post.where("interaction_type <> 'author'").join(first, ["post_id", "user_id"], "left")
    return rows.select("post_id", "user_id", F.col("interaction_type").alias("type"), "timestamp", "weight", F.col("c.raw_text").alias("content"), F.col("c.comment_id").alias("comment_id"))


def training_documents(posts: DataFrame, trees: DataFrame, lists: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """post_id, document.

    ``posts``: post_id and the structs node_features, engagement, metadata, and author_id, author_name, post_url, platform;
    ``trees``: post_id, comment_tree (JSON text); ``lists``: rows and their order by the name of the list in the graph.
    A post without rows has empty lists."""
    gathered = {name: _gathered(rows, name, order) for name, (rows, order) in lists.items()}
    joined = reduce(lambda a, b: a.join(b, "post_id", "left"), gathered.values(), posts.join(trees, "post_id", "left"))
    shown = lambda c: F.coalesce(F.to_json(c, ALL_FIELDS), F.lit("[]"))
    graph = F.concat(
        F.expr("substring(__head, 1, length(__head) - 1)"),
        F.lit(',"comment_tree":'),
        F.coalesce("comment_tree", F.lit("[]")),
        *[x for name in gathered for x in (F.lit(f',"{name}":'), shown(name))],
        F.lit("}"),
    )
    rows = joined.withColumn("__head", F.to_json(F.struct("author_id", "author_name"), ALL_FIELDS)).withColumn("__graph", graph)
    top = F.to_json(F.struct(sample_id("post_id").alias("sample_id"), "post_id", "post_url", "platform", "node_features", "engagement"), ALL_FIELDS)
    rows = rows.withColumn("__top", top)
    text = F.concat(F.expr("substring(__top, 1, length(__top) - 1)"), F.lit(',"graph_structure":'), F.col("__graph"), F.lit(',"metadata":'), F.to_json("metadata", ALL_FIELDS), F.lit("}"))
    return rows.select("post_id", text.alias("document"))
