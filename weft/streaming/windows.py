"""Windows over event time; the same expressions serve batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.operators.vector import rounded


def _start(w: str = "w"):
    return F.unix_micros(F.col(f"{w}.start")).alias("start_us")


def tumbling(events: DataFrame, size: str) -> DataFrame:
    grouped = events.groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count("*").alias("n"), rounded(F.sum("value"), 4).alias("total"))
    return grouped.select(_start(), "event_type", "n", "total")


def sliding(events: DataFrame, size: str, step: str) -> DataFrame:
    return events.groupBy(F.window("ts", size, step).alias("w"), "event_type").agg(F.count("*").alias("n")).select(_start(), "event_type", "n")


def sessions(events: DataFrame, gap: str) -> DataFrame:
    return events.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n")).select("user_id", _start(), "n")
