"""URL filter: host and path rules, and a ratio of two character language models for the rest.

The rules accept some URLs and reject others. From those, two variable-order Markov models are
counted: for every order up to ``ORDER`` each context and each context with its next sign has
a row of its own, under an exact key, in one grouped table that grows with the input; nothing
of it is broadcast or kept on the driver. An order's estimate is smoothed with the next shorter
one's. What a sign adds to a URL's score follows from the sign and the ``ORDER`` before it, so
the distinct such grams of the URLs are joined to the table, and each bucket of URLs reads those
it holds. A URL's score is the log-likelihood difference per sign; the threshold is the one that
best separates labelled URLs that were held out from counting; for the scores, all labelled
URLs are counted.

Edge cases. A null url or one without ``://`` has empty host and path, fits no rule and is
scored as it is (null: as empty text). Without labelled URLs of both kinds every score is 0
and the method allows; where the held-out ones are of one kind, the threshold is 0. Repeated rows
count and stay. An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from weft.scratch import Scratch

ORDER, SMOOTH = 5, 2.0
#: URLs that are scored with one set of grams.
BUCKET_URLS = 4096
#: One in so many labelled URLs calibrates the threshold; scores are binned finely for it.
HOLD_EVERY, BINS_PER_NAT, MAX_NATS = 5, 500, 8


@dataclass(frozen=True)
class UrlRule:
    """``pattern``: host, ``/``, start of the path behind its first slash."""

    pattern: str
    allow: bool

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]


RULES = (
    UrlRule("com/en/", False),
    UrlRule("example.com/en/7", True),
    UrlRule("net/de/", True),
    UrlRule("example.net/de/8", False),
    UrlRule("org/es/", False),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z in lower case, and path; both empty without ``://``."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_for(host: Column, path: Column, rules: tuple[UrlRule, ...] = RULES) -> Column:
    """The longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.pattern)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.lit(rule.pattern)).otherwise(out)
    return out


def _signs(urls: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All signs (start marks, bytes, end mark) of the URLs, and the positions to predict."""
    pad = b"\x02" * ORDER
    blobs = [pad + u.encode() + b"\x03" for u in urls]
    signs = np.frombuffer(b"".join(blobs), np.uint8).astype(np.uint64)
    sizes = np.fromiter(map(len, blobs), np.int64, len(blobs))
    starts = np.cumsum(sizes) - sizes
    keep = np.ones(len(signs), bool)
    keep[(starts[:, None] + np.arange(ORDER)).ravel()] = False
    return signs, np.flatnonzero(keep)


def _grams(urls: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Each sign and the ``ORDER`` before it as one number, the sign in the lowest byte; and the signs of each URL."""
    signs, at = _signs(urls)
    gram = np.zeros(len(at), np.uint64)
    for k in range(ORDER + 1):
        gram |= signs[at - k] << np.uint64(8 * k)
    return gram.astype(np.int64), np.fromiter((len(u.encode()) + 1 for u in urls), np.int64, len(urls))


def _parts(gram: Column) -> Column:
    """(order, is_context, key) of the gram and of its context at every order; keys are exact."""
    out = []
    for k in range(ORDER + 1):
        for is_context in (0, 1):
            low = gram.bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1))
            value = F.shiftright(low, 8) if is_context else low
            out.append(F.struct(F.lit(k).alias("k"), F.lit(is_context).alias("is_context"), value.bitwiseOR(F.lit(k << 49 | is_context << 48)).alias("key")))
    return F.array(*out)


class UrlModels:
    """Counts of both models: ``counts`` has (key, n0 rejected, n1 accepted) for every context and gram."""

    def __init__(self, counts: DataFrame):
        self.counts = counts

    def scores(self, urls: list[str]) -> np.ndarray:
        """Log-likelihood of the accepted less the rejected model, per sign."""
        rows = self.counts.sparkSession.createDataFrame(list(enumerate(urls)), "n long, url string")
        return np.array([r.llr for r in score_urls(rows, self, "url").orderBy("n").select("llr").collect()])


def count_models(labelled: DataFrame, scratch: Scratch | None = None) -> UrlModels:
    """Models of (url string, label int: 1 accepted, 0 rejected); saved where ``scratch`` is given."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            urls, labels = [u or "" for u in batch.column(0).to_pylist()], np.array(batch.column(1).to_pylist())
            for label in (0, 1):
                own = [urls[i] for i in np.flatnonzero(labels == label)]
                if own:
                    gram, n = np.unique(_grams(own)[0], return_counts=True)
                    none = np.zeros(len(gram), np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(none if label else n), pa.array(n if label else none)], ["gram", "n0", "n1"])

    sums = [F.sum(n).alias(n) for n in ("n0", "n1")]
    whole = labelled.select("url", "label").mapInArrow(count, "gram long, n0 long, n1 long").groupBy("gram").agg(*sums)
    counts = whole.select(F.explode(_parts(F.col("gram"))["key"]).alias("key"), "n0", "n1").groupBy("key").agg(*sums)
    return UrlModels(scratch.save(counts, "models") if scratch else counts)


def gram_scores(grams: DataFrame, models: UrlModels) -> DataFrame:
    """(gram, delta) of distinct grams: log-likelihood of the sign in the accepted less the rejected model."""
    parts = grams.select("gram", F.inline(_parts(F.col("gram")))).join(models.counts, "key")
    at = lambda label, k, is_context: F.coalesce(F.sum(F.when((F.col("k") == k) & (F.col("is_context") == is_context), F.col(f"n{label}"))), F.lit(0))
    known = parts.groupBy("gram").agg(*(at(label, k, c).alias(f"n{label}_{k}_{c}") for label in (0, 1) for k in range(ORDER + 1) for c in (0, 1)))
    p = [F.lit(1 / 256), F.lit(1 / 256)]
    for k in range(ORDER + 1):
        p = [(F.col(f"n{label}_{k}_0") + F.lit(SMOOTH) * p[label]) / (F.col(f"n{label}_{k}_1") + F.lit(SMOOTH)) for label in (0, 1)]
    return known.select("gram", (F.log(p[1]) - F.log(p[0])).alias("delta"))


def score_urls(urls: DataFrame, models: UrlModels, url_col: str) -> DataFrame:
    """All columns and ``llr``."""
    n_buckets = -(-urls.count() // BUCKET_URLS) or 1
    fields, position = urls.schema.fields, urls.columns.index(url_col)
    inner = [f"c{i}" for i in range(len(fields))]
    names = [*urls.columns, "llr"]
    # the columns may be of any name and kind; equal URLs are dealt over buckets by the other columns
    plain = urls.toDF(*inner)
    dealt = plain.select(F.pmod(F.xxhash64(F.to_json(F.struct(*inner))), F.lit(n_buckets)).alias("bucket"), *inner)

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            gram, sizes = _grams([u or "" for u in batch.column(1).to_pylist()])
            bucket = np.repeat(batch.column(0).to_numpy(), sizes)
            order = np.lexsort((gram, bucket))
            gram, bucket = gram[order], bucket[order]
            first = np.flatnonzero(np.append(True, (gram[1:] != gram[:-1]) | (bucket[1:] != bucket[:-1])))
            yield pa.RecordBatch.from_arrays([pa.array(bucket[first]), pa.array(gram[first])], ["bucket", "gram"])

    held = dealt.select("bucket", inner[position]).mapInArrow(spell, "bucket long, gram long").distinct()
    deltas = held.join(gram_scores(held.select("gram").distinct(), models), "gram", "left").select("bucket", "gram", F.coalesce("delta", F.lit(0.0)).alias("delta"))
    both = deltas.unionByName(dealt, allowMissingColumns=True).select("bucket", "gram", "delta", *inner)
    both = both.repartition("bucket").sortWithinPartitions("bucket", F.col("gram").asc_nulls_last())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, keys, values = None, [], []
        for batch in batches:
            bucket, is_url = batch.column(0).to_numpy(), batch.column(1).is_null().to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((bucket[1:] != bucket[:-1]) | (is_url[1:] != is_url[:-1])) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(bucket)]):
                if lo == hi:
                    continue
                part = batch.slice(lo, hi - lo)
                if bucket[lo] != current:
                    current, keys, values = bucket[lo], [], []
                if not is_url[lo]:
                    keys.append(part.column(1).to_numpy())
                    values.append(part.column(2).to_numpy())
                    continue
                keys, values = [np.concatenate(keys)], [np.concatenate(values)]
                gram, sizes = _grams([u or "" for u in part.column(3 + position).to_pylist()])
                logs = values[0][np.searchsorted(keys[0], gram)]
                llr = np.add.reduceat(logs, np.cumsum(sizes) - sizes) / sizes
                yield pa.RecordBatch.from_arrays([*part.columns[3:], pa.array(llr, pa.float64())], names)

    return both.mapInArrow(score, StructType([*(StructField(f.name, f.dataType) for f in fields), StructField("llr", DoubleType())]))


def calibrate(scored: DataFrame) -> float:
    """Threshold with the best balanced accuracy over (label, llr), from a histogram of bounded size."""
    edge = MAX_NATS * BINS_PER_NAT
    bin_ = F.greatest(F.lit(-edge), F.least(F.lit(edge), F.floor(F.col("llr") * BINS_PER_NAT)))
    rows = scored.groupBy(bin_.alias("bin")).agg(F.sum(F.col("label")).alias("good"), F.sum(1 - F.col("label")).alias("bad")).collect()
    good, bad = sum(r.good for r in rows), sum(r.bad for r in rows)
    if not good or not bad:
        return 0.0
    best, cut, kept_good, kept_bad = -1.0, 0.0, good, bad
    for r in sorted(rows, key=lambda r: r.bin):
        if (value := kept_good / good - kept_bad / bad) > best:
            best, cut = value, r.bin / BINS_PER_NAT
        kept_good, kept_bad = kept_good - r.good, kept_bad - r.bad
    return cut


def judge_urls(spark: SparkSession, pages: DataFrame, scratch: Scratch, rules: tuple[UrlRule, ...] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``llr`` (score of the models)."""
    host, path = host_and_path(F.col(url_col))
    split = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host.alias("host"), path.alias("path"))
    ruled = split.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules))
    allowed = F.col("rule").isin(*[r.pattern for r in rules if r.allow])
    labelled = ruled.where("rule is not null").select("url", F.when(allowed, 1).otherwise(0).alias("label"))
    by_rule = F.when(F.col("rule").isNotNull(), F.when(allowed, "allow").otherwise("block"))
    if labelled.agg(F.count_distinct("label")).first()[0] < 2:
        return ruled.select("page_id", "host", "path", "rule", F.coalesce(by_rule, F.lit("allow")).alias("verdict"), F.lit(0.0).alias("llr"))
    held = F.pmod(F.crc32("url"), F.lit(HOLD_EVERY)) == 0
    cut = calibrate(score_urls(labelled.where(held), count_models(labelled.where(~held), scratch), "url"))
    scored = score_urls(ruled, count_models(labelled, scratch), "url")
    verdict = F.coalesce(by_rule, F.when(F.col("llr") >= cut, "allow").otherwise("block"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "llr")
