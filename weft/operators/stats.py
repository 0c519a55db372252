"""Corpus statistics and small state machines over ordered events."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.operators.vector import rounded


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def by_category(rows: DataFrame, category: str, target: int) -> DataFrame:
    """Count and share of a target (percent, one place) of each category; null is ``unknown``."""
    n = F.count("*")
    return rows.groupBy(F.coalesce(category, F.lit("unknown")).alias("category")).agg(n.alias("n"), F.bround(n / target * 100, 1).alias("percent"))


def spread_per_post(counts: DataFrame, value: str) -> DataFrame:
    return counts.agg(rounded(F.avg(value), 6).alias("mean"), F.max(value).alias("largest"), F.sum(value).alias("total"))


def rolling_count(rows: DataFrame, key: str, ts: str, seconds: int = 60, last: int = 100) -> DataFrame:
    """Events of the last ``seconds`` (exclusive), of at most ``last`` kept.

    A key's rows are dealt into spans of time: each row counts in its own span and, as context, in the next,
    so a key of any size is spread over many tasks."""
    span = max(seconds, 3600) * 1_000_000
    at = F.unix_micros(ts)
    own = F.floor(at / span)
    both = rows.withColumn("__span", F.explode(F.array(own, own + 1))).withColumn("__own", F.col("__span") == own)
    near = both.where(F.col("__own") | (at > F.col("__span") * span - seconds * 1_000_000))
    w = Window.partitionBy(key, "__span").orderBy(at).rangeBetween(-(seconds * 1_000_000 - 1), 0)
    return near.withColumn("recent", F.least(F.count("*").over(w), F.lit(last))).where("__own").drop("__span", "__own")


def ewma(rows: DataFrame, key: str, order: str, value: str, keep: float = 0.8) -> DataFrame:
    """Smoothed value by key, from 0, in order: a row r places before the last weighs ``keep`` to the power of r."""
    back = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order))) - 1
    weighed = rows.select(key, (F.col(value) * (1 - keep) * F.pow(F.lit(keep), back)).alias("__x"))
    return weighed.groupBy(key).agg(rounded(F.coalesce(F.sum("__x"), F.lit(0.0)), 6).alias("ewma"), F.count("*").alias("n"))


def backoff(rows: DataFrame, key: str, order: str, event: str, max_delay: float = 4.0, factor: float = 2.0, most: float = 300.0) -> DataFrame:
    """Last level and delay: success -1 (not below 0), throttle +1, ban +3; delay grows with the level up to a limit.

    A sum held at 0 from below is the plain sum less its lowest value so far, if that is negative."""
    e = F.col(event)
    move = F.when(e == "throttle", 1).when(e == "ban", 3).when(e == "success", -1).otherwise(0)
    running = F.sum(move).over(Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    sums = rows.select(key, order, running.alias("__s")).groupBy(key).agg(F.max_by("__s", order).alias("last"), F.min("__s").alias("low"))
    out = sums.select(key, (F.col("last") - F.least(F.col("low"), F.lit(0))).cast("int").alias("level"))
    return out.withColumn("delay", F.when(F.col("level") > 0, F.least(F.lit(most), F.lit(max_delay) * F.pow(F.lit(factor), F.col("level")))))


def failure_streaks(rows: DataFrame, key: str, order: str, failed: Column, at_least: int = 3) -> DataFrame:
    """Runs of failures: first and last place and length, of at least ``at_least``."""
    w = Window.partitionBy(key).orderBy(order)
    marked = rows.withColumn("__bad", failed).withColumn("__run", F.sum(F.when(F.col("__bad"), 0).otherwise(1)).over(w))
    runs = marked.where("__bad").groupBy(key, "__run").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("length"))
    return runs.where(F.col("length") >= at_least).drop("__run")


def richest(rows: DataFrame, k: int = 1) -> DataFrame:
    """Top rows by 10 for an image, 1 for a comment, 5 for a comment with an image, 5 for any text; ties by path downwards."""
    score = 10 * F.col("images") + F.col("comments") + 5 * F.col("comments_with_image") + 5 * F.col("has_text").cast("int")
    return rows.withColumn("score", score).orderBy(F.desc("score"), F.desc("path")).limit(k)


def first_per_group(rows: DataFrame, key: str, order: str, most: int) -> DataFrame:
    """At most ``most`` rows of each key, in order: a limit on comments, replies or targets."""
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(order))).where(F.col("__n") <= most).drop("__n")


def share_with(rows: DataFrame, what: Column) -> DataFrame:
    """Rows, those for which ``what`` holds, and their share (0 without rows)."""
    n, hits = F.count("*"), F.count_if(what)
    return rows.agg(n.alias("total"), hits.alias("n_with"), F.when(n > 0, hits / n).otherwise(0.0).alias("share"))


def edge_summary(edges: DataFrame, key: str, kind: str) -> DataFrame:
    """Number of edges of each kind by key, and under ``TOTAL`` their sum."""
    counted = edges.groupBy(key, kind).agg(F.count("*").alias("n"))
    total = counted.groupBy(key).agg(F.sum("n").alias("n")).select(key, F.lit("TOTAL").alias(kind), "n")
    return counted.unionByName(total)


def distinct_types(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Node and edge types of a whole corpus: what a model has to know beforehand."""
    a = nodes.select(F.lit("node").alias("part"), F.col("kind").alias("type")).distinct()
    b = edges.select(F.lit("edge").alias("part"), F.concat_ws("|", "src_kind", "relation", "dst_kind").alias("type")).distinct()
    return a.unionByName(b)


def no_new_stop(steps: DataFrame, key: str, order: str, is_new: Column, patience: int = 8) -> DataFrame:
    """Where collecting stops for each key: at the first step that ends ``patience`` steps in a row without anything new
    (else at the last step), and what was new up to there."""
    by = Window.partitionBy(key).orderBy(order)
    rows = steps.withColumn("__new", is_new.cast("int"))
    rows = rows.withColumn("__n", F.row_number().over(by)).withColumn("__seen", F.coalesce(F.max(F.when(F.col("__new") == 1, F.col("__n"))).over(by.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)))
    rows = rows.withColumn("__over", F.col("__n") - F.col("__seen") >= patience)
    stop = rows.groupBy(key).agg(F.min(F.when(F.col("__over"), F.col("__n"))).alias("__stop"), F.max("__n").alias("__last"))
    until = F.coalesce("__stop", "__last")
    done = rows.join(stop, key).where(F.col("__n") <= until)
    return done.groupBy(key).agg(F.max(order).alias("stopped_at"), F.sum("__new").alias("n_new"), F.max(F.col("__stop").isNotNull()).alias("stopped"))


def least_used(rows: DataFrame, value: str, *order: str) -> DataFrame:
    """The value of the smallest order, with its count of rows."""
    return rows.agg(F.min_by(value, F.struct(*order)).alias(value), F.count("*").alias("n"))


def run_counters(marks: DataFrame) -> DataFrame:
    """From id, status: marks, failures, distinct ids done."""
    return marks.agg(F.count_if(F.col("status") == "done").alias("total_done"), F.count_if(F.col("status") == "failed").alias("total_failed"), F.count_distinct(F.when(F.col("status") == "done", F.col("id"))).alias("distinct_done"))
