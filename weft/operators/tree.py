"""Reply trees: depth, preorder, subtree sizes, nested documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.scratch import Scratch

DIGITS = 10


def padded(ordinal: Column, digits: int = DIGITS) -> Column:
    """An ordinal as text that sorts like a number; one of more digits is an error, not cut."""
    text = ordinal.cast("string")
    return F.when(F.length(text) <= digits, F.lpad(text, digits, "0")).when(text.isNotNull(), F.raise_error(F.concat(F.lit(f"ordinal of more than {digits} digits: "), text)))


def walk(comments: DataFrame) -> DataFrame:
    """Every comment that a root reaches: post_id, comment_id, parent_id, depth, path.

    ``path`` joins zero-padded ordinals, so its order is preorder. Comments with an unknown parent vanish, with
    their replies; cycles have no root. Each round lets a comment look twice as far up, so a tree of depth d takes
    log2(d) joins; no round beyond what the largest post can be deep."""
    scratch = Scratch(comments.sparkSession, "walk")
    own = comments.select("post_id", "comment_id", "parent_id", padded(F.col("ordinal")).alias("path")).dropDuplicates(["post_id", "comment_id"])
    nodes = scratch.save(own.withColumn("up", F.col("parent_id")).withColumn("depth", F.when(F.col("up").isNull(), 0).otherwise(1)), "nodes")
    largest = nodes.groupBy("post_id").agg(F.count("*").alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    for _ in range(int(largest).bit_length() + 1):
        if nodes.where("up is not null").isEmpty():
            break
        above = nodes.select("post_id", F.col("comment_id").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"), F.col("path").alias("above"))
        joined = nodes.join(above, ["post_id", "up"], "left").where("up is null or above is not null")
        nodes = scratch.save(joined.select("post_id", "comment_id", "parent_id", F.col("next").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.concat_ws(".", "above", "path").alias("path")), "nodes")
    return scratch.bind(nodes.where("up is null").select("post_id", "comment_id", "parent_id", "depth", "path"))


def child_texts(tree: DataFrame, fields: DataFrame, image: str | None = None) -> DataFrame:
    """post_id, comment_id, raw_text and first image of every comment of the tree: the maps that a walk collects."""
    first = F.get(F.col(image), F.lit(0)) if image else F.lit(None).cast("string")
    return tree.select("post_id", "comment_id").join(fields, ["post_id", "comment_id"]).select("post_id", "comment_id", F.coalesce("raw_text", F.lit("")).alias("raw_text"), first.alias("image"))


def preorder(tree: DataFrame) -> DataFrame:
    """``walk`` rows with their place in the post's preorder, from 0."""
    from pyspark.sql import Window

    return tree.withColumn("pre", F.row_number().over(Window.partitionBy("post_id").orderBy("path")) - 1)


def depth_histogram(tree: DataFrame) -> DataFrame:
    """Comments by depth, with the label that stops at 2."""
    return tree.groupBy("depth", F.least("depth", F.lit(2)).alias("label")).agg(F.count("*").alias("n"))


def subtree_counts(tree: DataFrame) -> DataFrame:
    """Comments of each post, replies of any depth included, and the count of two levels only."""
    return tree.groupBy("post_id").agg(F.count("*").alias("n_all"), F.count_if(F.col("depth") <= 1).alias("n_two_levels"))


def descendants(tree: DataFrame) -> DataFrame:
    """Number of comments below each one: every comment counts for each prefix of its path."""
    steps = F.split("path", "[.]")
    above = tree.select("post_id", F.explode(F.transform(F.sequence(F.lit(1), F.size(steps)), lambda k: F.array_join(F.slice(steps, F.lit(1), k), "."))).alias("path"))
    counts = above.groupBy("post_id", "path").agg((F.count("*") - 1).alias("n_below"))
    return tree.join(counts, ["post_id", "path"]).select("post_id", "comment_id", "n_below")


def nested_json(tree: DataFrame, fields: DataFrame) -> DataFrame:
    """post_id, comment_tree: JSON text of the nested comments.

    ``fields``: post_id, comment_id, ``body`` (JSON object text without replies). In preorder, a comment opens its own
    object and closes as many as its successor's depth tells, so one pass over a post's rows writes its tree."""
    from pyspark.sql import Window

    rows = tree.join(fields, ["post_id", "comment_id"]).select("post_id", "depth", "path", "body")
    order = Window.partitionBy("post_id").orderBy("path")
    following, before = F.coalesce(F.lead("depth").over(order), F.lit(0)), F.lag("depth").over(order)
    comma = F.when(before >= F.col("depth"), ",").otherwise("")
    opened = F.concat(F.expr("substring(body, 1, length(body) - 1)"), F.lit(',"replies":['))
    piece = F.concat(comma, opened, F.repeat(F.lit("]}"), F.greatest(F.col("depth") - following + 1, F.lit(0))))
    pieces = rows.select("post_id", "path", piece.alias("piece")).groupBy("post_id").agg(F.array_sort(F.collect_list(F.struct("path", "piece"))).alias("p"))
    return pieces.select("post_id", F.concat(F.lit("["), F.array_join("p.piece", ""), F.lit("]")).alias("comment_tree"))
