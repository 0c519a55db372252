"""Feature vectors and contrastive metrics; sums in double precision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NEAR_ZERO, TEMPERATURE = 1e-6, 0.07


def as_double(v: Column) -> Column:
    return v.cast("array<double>")


def rounded(x: Column, places: int) -> Column:
    """Rounded half away from zero in double arithmetic, as SQL engines do; the sign of a value that becomes zero stays.

    ``F.round`` goes over the decimal text of a number: it has no negative zero and other halves."""
    scale = float(10**places)
    # nan, infinity and what would overflow stay as they are
    return F.when(F.abs(x) * scale < float("inf"), F.signum(x) * F.round(F.abs(x) * scale) / scale).otherwise(x)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def log1p(v: Column) -> Column:
    return F.transform(v, lambda x: F.log1p(x))


def padded_concat(a: Column, b: Column, size: int) -> Column:
    """b behind a; zeros where b is null."""
    return F.concat(a, F.coalesce(b, F.array_repeat(F.lit(0.0), size)))


def vector_sum(vectors: Column, size: int) -> Column:
    """Sum of an array of equally long vectors."""
    return F.aggregate(vectors, F.array_repeat(F.lit(0.0), size), lambda s, v: F.zip_with(s, v, lambda x, y: x + y))


def pooled(rows: DataFrame, key: str, vector: str, weight: str | None = None) -> DataFrame:
    """Weighted sum (mean without weights) of the vectors of a key, element by element: sums meet, not vectors."""
    one = rows.select(key, (F.col(weight) if weight else F.lit(1.0)).alias("__w"), F.posexplode(as_double(F.col(vector))).alias("__i", "__x"))
    total = F.sum(F.col("__x") * F.col("__w"))
    parts = one.groupBy(key, "__i").agg((total if weight else total / F.count("*")).alias("__s"))
    return parts.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("__i", "__s"))), lambda x: x["__s"]).alias("pooled"))


def with_missing(nodes: DataFrame, vectors: DataFrame, key: str, size: int) -> DataFrame:
    """All nodes with their vector; zeros where there is none."""
    return nodes.join(vectors, key, "left").withColumn("vector", F.coalesce(F.col("vector"), F.array_repeat(F.lit(0.0), size)))


def embed_texts(rows: DataFrame, text: str, encode, batch: int = 32, most_words: int = 128) -> DataFrame:
    """``vector`` from ``encode``, a function of a list of texts that gives a row for each, called with ``batch`` texts
    of at most ``most_words`` words at a time; a model is loaded once a task, in its closure."""
    from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

    def run(frames):
        import pandas as pd

        for frame in frames:
            short = [" ".join((t or "").split()[:most_words]) for t in frame[text]]
            vectors = [list(map(float, v)) for lo in range(0, len(short), batch) for v in encode(short[lo : lo + batch])]
            yield frame.assign(vector=pd.Series(vectors, index=frame.index, dtype=object))

    return rows.mapInPandas(run, StructType([*rows.schema.fields, StructField("vector", ArrayType(DoubleType()))]))


def training_batches(graphs: DataFrame, key: str, most: int = 600, size: int = 16, seed: int = 0) -> DataFrame:
    """The first ``most`` graphs by key, dealt into batches of ``size`` in an order that follows from the seed."""
    from pyspark.sql import Window

    first = graphs.select(key).orderBy(key).limit(most)
    shuffled = F.row_number().over(Window.orderBy(F.md5(F.concat_ws("|", F.lit(seed), F.col(key).cast("string")))))
    return first.withColumn("place", shuffled - 1).withColumn("batch", F.floor(F.col("place") / size))


def topology_weights(comments: DataFrame) -> DataFrame:
    """(1 + in-degree) over the post's sum: softmax of log1p of the number of replies."""
    from pyspark.sql import Window

    degree = comments.where("parent_id is not null").groupBy("post_id", F.col("parent_id").alias("comment_id")).agg(F.count("*").alias("d"))
    rows = comments.select("post_id", "comment_id").join(degree, ["post_id", "comment_id"], "left").withColumn("d", F.coalesce("d", F.lit(0)))
    return rows.withColumn("alpha", (1 + F.col("d")) / F.sum(1 + F.col("d")).over(Window.partitionBy("post_id")))


def batch_logits(pairs: DataFrame, batch: str, row: str, left: str, right: str) -> DataFrame:
    """batch, i, j, logit: cosine over temperature of each left with each right vector of its own batch.

    Rows whose vectors are near zero take no part. Batches are of a fixed small size, so this join is linear."""
    unit = lambda c: F.transform(as_double(F.col(c)), lambda x: x / norm(as_double(F.col(c))))
    valid = pairs.where((norm(as_double(F.col(left))) > NEAR_ZERO) & (norm(as_double(F.col(right))) > NEAR_ZERO))
    a = valid.select(batch, F.col(row).alias("i"), unit(left).alias("__a"))
    b = valid.select(batch, F.col(row).alias("j"), unit(right).alias("__b"))
    return a.join(b, batch).select(batch, "i", "j", (dot(F.col("__a"), F.col("__b")) / TEMPERATURE).alias("logit"))


def ntxent(logits: DataFrame, batch: str) -> DataFrame:
    """Mean cross-entropy of the diagonal and share of rows whose largest logit is on it; batches of one row give 0."""
    top = logits.groupBy(batch, "i").agg(F.max("logit").alias("m"), F.max_by("j", F.struct("logit", -F.col("j"))).alias("best"), F.max(F.when(F.col("i") == F.col("j"), F.col("logit"))).alias("own"), F.collect_list("logit").alias("all"))
    spread = F.log(F.aggregate(F.sort_array("all"), F.lit(0.0), lambda s, x: s + F.exp(x - F.col("m")))) + F.col("m")
    rows = top.select(batch, (spread - F.col("own")).alias("loss"), (F.col("best") == F.col("i")).alias("hit"))
    return rows.groupBy(batch).agg(rounded(F.when(F.count("*") > 1, F.avg("loss")).otherwise(0.0), 5).alias("loss"), rounded(F.avg(F.col("hit").cast("double")), 6).alias("accuracy"), F.count("*").alias("n"))
