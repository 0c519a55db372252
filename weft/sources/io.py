"""Sources and sinks: JSON documents, tables, logs, media listings, paged services, done-sets."""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from weft.functions.text import media_extension
from weft.operators import merge
from weft.operators.edges import first_wins
from weft.sources.schema import DOCUMENT, TABLES


def list_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Paths of all JSON files below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").load(folder)
    return files.select("path")


def read_documents(spark: SparkSession, folder: str, schema: str = DOCUMENT) -> DataFrame:
    """One row for each JSON file, with its path; files that don't parse are left out."""
    reader = spark.read.schema(schema + ", _corrupt string").option("multiLine", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json")
    docs = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(folder)
    return docs.withColumn("path", F.col("_metadata.file_path")).where("_corrupt is null").drop("_corrupt")


def read_sorted(spark: SparkSession, folder: str, schema: str = DOCUMENT) -> DataFrame:
    """Documents in the order of their paths."""
    return read_documents(spark, folder, schema).orderBy("path")


def write_documents(docs: DataFrame, folder: str, key: str = "post_id") -> None:
    """One partition for each key; only the keys of ``docs`` are replaced, whole, on commit."""
    name = docs.withColumn("key", F.coalesce(key, "sample_id")) if "sample_id" in docs.columns else docs.withColumn("key", F.col(key))
    name.write.option("partitionOverwriteMode", "dynamic").partitionBy("key").mode("overwrite").json(folder)


def write_jsonl(rows: DataFrame, folder: str) -> None:
    """One document a line, nulls kept."""
    rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(folder)


def explode_document(docs: DataFrame) -> dict[str, DataFrame]:
    """A table for each array of the document, with post_id."""
    out = {}
    for name in TABLES:
        rows = docs.select("post_id", F.explode(f"graph_structure.{name}").alias("r"))
        own = [f.name for f in rows.schema["r"].dataType.fields if f.name != "post_id"]
        out[name] = rows.select("post_id", *[F.col(f"r.{c}").alias(c) for c in own])
    return out


def save_samples(docs: DataFrame, folder: str) -> dict[str, str]:
    """Every table of the documents as Parquet; no table for nothing."""
    paths = {}
    for name, rows in {"samples": docs, **explode_document(docs)}.items():
        paths[name] = os.path.join(folder, name)
        rows.write.mode("append").parquet(paths[name])
    return paths


def create_tables(spark: SparkSession, database: str, schemas: dict[str, str], location: str | None = None) -> None:
    """Parquet tables in a database; sorted files and statistics stand in for indexes."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}" + (f" LOCATION '{location}'" if location else ""))
    for name, schema in schemas.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({schema}) USING parquet")


_POINTER = "_current"


def _store(spark: SparkSession, path: str):
    here = spark._jvm.org.apache.hadoop.fs.Path(path)
    return here, here.getFileSystem(spark._jsc.hadoopConfiguration())


def current_version(spark: SparkSession, path: str) -> str | None:
    """Folder of the table's rows that its pointer names; None for no table."""
    pointer, store = _store(spark, f"{path}/{_POINTER}")
    if not store.exists(pointer):
        return None
    stream = store.open(pointer)
    try:
        return f"{path}/{bytes(stream.readAllBytes()).decode()}"
    finally:
        stream.close()


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(current_version(spark, path))


def upsert_table(spark: SparkSession, path: str, new: DataFrame, key: list[str], seq: str) -> None:
    """Replace rows by key in a table of Parquet versions: a new version is written beside the old one, then the
    pointer is replaced in one step. Whatever fails before leaves the old version current; the version before it is
    kept for readers that are under way, older ones go."""
    old = current_version(spark, path)
    rows = merge.upsert_last(spark.read.parquet(old) if old else new.limit(0), new, key, seq)
    name = f"v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    rows.write.parquet(f"{path}/{name}")
    pointer, store = _store(spark, f"{path}/{_POINTER}")
    fresh, _ = _store(spark, f"{path}/{_POINTER}.{name}")
    stream = store.create(fresh)
    stream.write(bytearray(name.encode()))
    stream.close()
    jvm = spark._jvm
    overwrite = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    overwrite[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri() if fresh.toUri().getScheme() else store.getUri(), spark._jsc.hadoopConfiguration()).rename(fresh, pointer, overwrite)
    for status in store.listStatus(jvm.org.apache.hadoop.fs.Path(path)):
        if status.isDirectory() and status.getPath().getName() not in (name, (old or "").rpartition("/")[2]):
            store.delete(status.getPath(), True)


def parse_targets(text: str) -> list[dict[str, str]]:
    """A flat list of mappings as in ``- type: post`` blocks; comments and quotes go."""
    rows: list[dict[str, str]] = []
    for line in text.splitlines():
        bare = line.split(" #")[0].rstrip()
        body = bare.strip()
        if not body or body.startswith("#"):
            continue
        if body.startswith("- "):
            rows.append({})
            body = body[2:]
        if ":" in body and rows:
            k, v = body.split(":", 1)
            if v.strip():
                rows[-1][k.strip()] = v.strip().strip("'\"")
    return rows


def read_targets(spark: SparkSession, path: str) -> DataFrame:
    text = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    return spark.createDataFrame([(r.get("type"), r.get("url"), r.get("query"), r.get("category")) for r in parse_targets(text)], "type string, url string, query string, category string")


def write_targets(targets: DataFrame, path: str) -> None:
    """The flat list that :func:`read_targets` reads, as one file; targets are a short list, made by hand or by a run."""
    shown = F.array_join(F.array_compact(F.array(*[F.concat(F.lit(f"  {c}: '"), F.col(c), F.lit("'")) for c in ("type", "url", "query", "category")])), "\n")
    targets.select(F.concat(F.lit("- "), F.substring(shown, 3, 1 << 30))).coalesce(1).write.mode("overwrite").text(path)


def local_or_remote(spark: SparkSession, path: str, remote: Callable[[], DataFrame]) -> DataFrame:
    """The local table where it exists, else the remote scan."""
    here = spark._jvm.org.apache.hadoop.fs.Path(path)
    return spark.read.parquet(path) if here.getFileSystem(spark._jsc.hadoopConfiguration()).exists(here) else remote()


def flat_config(config: dict, prefix: str = "") -> dict:
    """Nested settings under dotted names."""
    out = {}
    for k, v in config.items():
        out.update(flat_config(v, f"{prefix}{k}.") if isinstance(v, dict) else {f"{prefix}{k}": v})
    return out


def patched(config: dict, changes: dict) -> dict:
    """A copy with dotted names replaced."""
    return {**flat_config(config), **changes}


def last_log_lines(spark: SparkSession, folder: str, marker: str) -> DataFrame:
    """path, line: the last line of each log that holds the marker.

    Logs are split like any text: a line's place is its split's start and its number among the lines of the task."""
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.log").text(folder)
    placed = lines.select("value", F.col("_metadata.file_path").alias("path"), F.struct(F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("n")).alias("place"))
    return placed.where(F.contains("value", F.lit(marker))).groupBy("path").agg(F.max_by("value", "place").alias("line"))


def folder_size(spark: SparkSession, folder: str) -> DataFrame:
    """files, bytes, newest path; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length", "modificationTime")
    return files.agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), F.max_by("path", "modificationTime").alias("newest"))


def save_media(files: DataFrame, folder: str, most_bytes: int) -> DataFrame:
    """From name, url, content_type, content: one file each below ``folder``, named with the extension of its type or
    link; files over ``most_bytes`` are skipped. Gives name, path (null: skipped) and bytes.

    A file is written under a name of its own and moved, so a task that runs again replaces it whole."""
    named = files.select("name", F.concat(F.regexp_replace("name", "[^A-Za-z0-9._-]", "_"), media_extension(F.col("url"), F.coalesce("content_type", F.lit("")))).alias("file"), F.coalesce("content", F.lit(b"")).alias("content"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        for batch in batches:
            paths = []
            for file, content in zip(batch.column(1).to_pylist(), batch.column(2)):
                data = content.as_buffer()
                if data.size > most_bytes:
                    paths.append(None)
                    continue
                own = f"{root}/.{file}.{uuid.uuid4().hex}"
                with store.open_output_stream(own, compression=None) as out:
                    out.write(data)
                store.move(own, f"{root}/{file}")
                paths.append(f"{root}/{file}")
            sizes = [len(c.as_buffer()) for c in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], ["name", "path", "bytes"])

    return named.mapInArrow(write, "name string, path string, bytes long")


def range_total(content_range: str | None) -> int:
    """Number of rows that a ``Content-Range`` header states (``0-0/1234``); 0 where it states none."""
    total = (content_range or "").rpartition("/")[2].strip()
    return int(total) if total.isdigit() else 0


def remote_count(options: dict) -> int:
    """Rows of the service: the option ``total``, else what its ``count`` (module:function that gives the header) states."""
    return int(options["total"]) if "total" in options else range_total(_named(options["count"])())


class PagedSource(DataSource):
    """Rows of a service that gives pages by offset. Options: ``pages`` (module:function of offset
    and limit), ``total`` or ``count`` (module:function that gives a Content-Range), ``limit``; a partition for each
    page, so a page is fetched again if lost."""

    @classmethod
    def name(cls) -> str:
        return "weft_pages"

    def schema(self) -> str:
        return self.options.get("schema", "value string")

    def reader(self, schema) -> DataSourceReader:
        return _PagedReader(self.options, [f.name for f in schema.fields])

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _BatchWriter(self.options)


def _named(spec: str) -> Callable:
    import importlib

    module, _, function = spec.partition(":")
    return getattr(importlib.import_module(module), function)


class _PagedReader(DataSourceReader):
    def __init__(self, options: dict, names: list[str]):
        self.options, self.names = dict(options), names

    def partitions(self) -> list[InputPartition]:
        total, limit = remote_count(self.options), int(self.options.get("limit", 1000))
        return [InputPartition(offset) for offset in range(0, total, limit)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for row in _named(self.options["pages"])(partition.value, int(self.options.get("limit", 1000))):
            yield tuple(row.get(n) for n in self.names)


class _BatchWriter(DataSourceWriter):
    """Sends batches of ``batch`` rows; the receiver ignores keys it has, so a task may run again."""

    def __init__(self, options: dict):
        self.options = dict(options)

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        send, size, batch = _named(self.options["send"]), int(self.options.get("batch", 500)), []
        for row in iterator:
            batch.append(row.asDict(True))
            if len(batch) == size:
                send(batch)
                batch = []
        if batch:
            send(batch)
        return WriterCommitMessage()


class DoneSet:
    """Ids that are done, as appended Parquet; distinct on reading."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self) -> DataFrame:
        here = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not here.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(here):
            return self.spark.createDataFrame([], "id string")
        return self.spark.read.schema("id string").parquet(self.path).distinct()

    def add(self, ids: DataFrame) -> None:
        ids.select(F.col(ids.columns[0]).cast("string").alias("id")).distinct().write.mode("append").parquet(self.path)

    def merge_remote(self, remote: DataFrame) -> DataFrame:
        return self.read().union(remote.select(F.col(remote.columns[0]).cast("string"))).distinct()

    def pending(self, rows: DataFrame, key: str) -> DataFrame:
        return rows.join(self.read(), F.col(key).cast("string") == F.col("id"), "left_anti")


def unsent(rows: DataFrame, there: DataFrame, key: str, order: str, batch: int = 500) -> DataFrame:
    """Rows whose key the target doesn't have, once each (the first in order), with the number of the batch that takes them."""
    new = first_wins(rows.join(there.select(key).distinct(), key, "left_anti"), [key], order)
    return merge.dense_ordinal(new, order).withColumn("batch", F.floor(F.col("ordinal") / batch)).drop("ordinal")


def flushes(marks: DataFrame, order: str, every: int) -> DataFrame:
    """``flush``: number of the write that makes a mark durable, one after each ``every`` marks; null for those that
    wait for the end of the run, so what a crash would lose."""
    total = marks.count()
    numbered = merge.dense_ordinal(marks, order)
    number = F.floor(F.col("ordinal") / every)
    return numbered.withColumn("flush", F.when(number < total // every, number)).drop("ordinal")


def due_checks(marks: DataFrame, order: str, every: int = 10) -> DataFrame:
    """The marks after which a check is due: each ``every``-th, in order."""
    return merge.dense_ordinal(marks, order).where((F.col("ordinal") + 1) % every == 0).drop("ordinal")


def json_list(column: Column) -> Column:
    """A list column as JSON text: null as ``null``, empty as ``[]``."""
    return F.coalesce(F.to_json(column), F.lit("null"))


def ranked_lines(rows: DataFrame, key: str, order: str) -> DataFrame:
    return rows.withColumn("line", F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1)


def dump(path: str, value: dict) -> None:
    """A small driver-side state file, replaced in one step."""
    with open(path + ".tmp", "w", encoding="utf-8") as f:
        json.dump(value, f, ensure_ascii=False)
    os.replace(path + ".tmp", path)
