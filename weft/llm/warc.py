"""WARC archives and an external merge of their capture index.

Captures are written as gzip members, one a record, to archives in the shared folder. Equal
payloads are stored once: the capture with the largest id is the response, the others revisit
it. Reading an archive gives a run of index entries sorted by URL key, timestamp and id; runs
are cut at sampled splitters, exchanged by range, and merged by a loser tree, which gives
capture histories in global order (``range_id``, ``seq``).

Capture times come from a timestamp column (``time_col``). Without one, or where it is null, a capture's
time follows from its id: one second an id after ``EPOCH``, over again after 10^9 ids; a null id counts as 0.

Edge cases. A null payload is empty; a null url has the empty key; a null id is written as
empty, reads back as null, and counts as smaller than any other. Captures that tie for the
largest id of a payload are all responses. Repeated rows stay. An empty table gives an empty
result. Further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm.runs import cut_keys, front_code, front_decode, loser_tree_merge
from weft.scratch import Scratch

ARCHIVE_BYTES = 64 << 20
#: Rows that one merge task holds about, and sampled keys for each range.
RANGE_ROWS, RANGE_SAMPLES = 200_000, 32
#: Payloads that more captures share are joined apart from the others.
HOT_COPIES = 1000
EPOCH = datetime(2020, 1, 1, tzinfo=timezone.utc)
INDEX_SCHEMA = "range_id int, seq long, urlkey string, timestamp string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, position long, size long"
_FIELDS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "archive", "position", "size")


def url_key(url: str) -> str:
    """Host labels reversed, then the rest: ``com,example)/path``."""
    _, sep, rest = url.partition("://")
    rest = (rest if sep else url).partition("#")[0]
    host, _, path = rest.partition("/")
    return ",".join(reversed(host.lower().split("."))) + ")/" + path


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _stamp(seconds: int) -> str:
    return (datetime.fromtimestamp(0, timezone.utc) + timedelta(seconds=seconds)).strftime("%Y-%m-%dT%H:%M:%SZ")


def record(url: str, page_id: int | None, when: str, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit holds the HTTP head only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {url.encode('unicode_escape').decode()}",
        f"WARC-Date: {when}",
        f"WARC-Payload-Digest: sha1:{_digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head[6:6] = [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict, int, bytes]:
    """Headers, length of the full payload, stored payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    length = int(http.rpartition(b"Content-Length: ")[2])
    if fields["WARC-Type"] == "response" and (len(payload) != length or f"sha1:{_digest(payload)}" != fields["WARC-Payload-Digest"]):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return fields, length, payload


def read_archive(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Position, size and bytes of each gzip member."""
    at, step = 0, 1 << 14
    while at < len(data):
        member, parts, here = zlib.decompressobj(31), [], at
        while not member.eof:
            if here >= len(data):
                raise ValueError("archive ends inside a record")
            parts.append(member.decompress(data[here : here + step]))
            here += step
        size = min(here, len(data)) - at - len(member.unused_data)
        yield at, size, b"".join(parts)
        at += size


def _id(urn: str) -> int | None:
    text = urn[len("<urn:page:") : -1]
    return int(text) if text else None


def _captures(pages: DataFrame, id_col: str, url_col: str, payload_col: str, time_col: str | None) -> DataFrame:
    """page_id, url, payload, at (seconds)."""
    number = F.col(id_col).cast("long")
    by_id = F.lit(int(EPOCH.timestamp())) + F.pmod(F.coalesce(number, F.lit(0)), F.lit(1_000_000_000))
    at = F.coalesce(F.unix_seconds(F.col(time_col).cast("timestamp")), by_id) if time_col else by_id
    empty = F.lit("")
    return pages.select(number.alias("page_id"), F.coalesce(F.col(url_col), empty).alias("url"), F.coalesce(F.col(payload_col), empty).alias("payload"), at.cast("long").alias("at"))


def _with_references(captures: DataFrame, scratch: Scratch, min_revisit_bytes: int) -> DataFrame:
    """Captures and the id that each refers to, null for responses; a payload that very many share lies in no one task."""
    key = captures.withColumn("digest", F.sha1(F.encode("payload", "utf-8"))).withColumn("payload_bytes", F.octet_length("payload"))
    last = key.where(F.col("payload_bytes") >= min_revisit_bytes).groupBy("digest").agg(F.max("page_id").alias("last_id"), F.count("*").alias("copies"))
    shared = scratch.save(last.where("copies > 1 and last_id is not null"), "shared")
    hot = scratch.save(shared.where(F.col("copies") > HOT_COPIES).select("digest", F.col("last_id").alias("hot_id")), "hot")
    cold = shared.where(F.col("copies") <= HOT_COPIES).select(F.col("digest").alias("k"), "last_id")
    # a row whose payload is hot knows its response by now and goes on under a key of its own
    marked = key.join(hot, "digest", "left").withColumn("k", F.when(F.col("hot_id").isNull(), F.col("digest")).otherwise(F.xxhash64("page_id", "url").cast("string")))
    response = F.coalesce("hot_id", "last_id")
    return marked.join(cold, "k", "left").select("page_id", "url", "payload", "at", F.when(F.col("page_id").eqNullSafe(response), None).otherwise(response).alias("refers_to"))


def write_archives(pages: DataFrame, scratch: Scratch, min_revisit_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", time_col: str | None = None) -> DataFrame:
    """Write all captures; the saved manifest names the archives of tasks that were committed."""
    linked = _with_references(_captures(pages, id_col, url_col, payload_col, time_col), scratch, min_revisit_bytes)
    folder = scratch.path("archives")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out, size, count, name, done = None, 0, 0, "", []

        def close():
            out.close()
            store.move(f"{root}/{name}.open", f"{root}/{name}")
            done.append((f"{root}/{name}", count, size))

        for batch in batches:
            for page_id, url, payload, at, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name, size, count = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{root}/{name}.open", compression=None)
                packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                member = packer.compress(record(url, page_id, _stamp(at), payload.encode(), refers_to)) + packer.flush()
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= ARCHIVE_BYTES:
                    close()
                    out = None
        if out is not None:
            close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*done)], ["archive", "records", "bytes"])

    manifest = scratch.save(linked.mapInArrow(write, "archive string, records long, bytes long"), "manifest")
    manifest._weft_folder = folder
    return manifest


def _entry_key(url: str, when: str, page_id: int | None) -> bytes:
    return url_key(url).encode() + b"\0" + when.encode() + b"\0" + (b"" if page_id is None else b"%020d" % (page_id + (1 << 63)))


def splitters(pages: DataFrame, ranges: int, rows: int, scratch: Scratch, id_col: str = "page_id", url_col: str = "url", time_col: str | None = None) -> list[bytes]:
    """Keys that cut the captures into about ``ranges`` parts, from a hashed sample of ``RANGE_SAMPLES`` rows a part."""
    if ranges < 2:
        return []
    every = max(1, rows // (ranges * RANGE_SAMPLES))
    captures = _captures(pages, id_col, url_col, url_col, time_col)
    few = captures.where(F.pmod(F.xxhash64("page_id", "url"), F.lit(every)) == 0)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([_entry_key(u, _stamp(at), i) for i, u, at in zip(*(c.to_pylist() for c in batch.columns))], pa.binary())], ["key"])

    return sorted(set(cut_keys(scratch.save(few.select("page_id", "url", "at").mapInArrow(keys, "key binary"), "keys"), ranges)))


def capture_index(manifest: DataFrame, cuts: list[bytes], archives: int) -> DataFrame:
    """Read the archives back and merge their runs; rows of ``INDEX_SCHEMA``."""
    folder = manifest._weft_folder

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with store.open_input_file(path) as f:
                    data = f.readall()
                entries = []
                for at, size, raw in read_archive(data):
                    fields, length, _ = parse_record(raw)
                    page_id = _id(fields["WARC-Record-ID"])
                    url = fields["WARC-Target-URI"].encode().decode("unicode_escape")
                    refers = fields.get("WARC-Refers-To")
                    row = (page_id, length, fields["WARC-Payload-Digest"][5:], fields["WARC-Type"], refers and _id(refers), path, at, size)
                    entries.append((_entry_key(url, fields["WARC-Date"], page_id), row))
                entries.sort(key=lambda e: e[0])
                start = 0
                for j in range(len(cuts) + 1):
                    end = bisect_left(entries, cuts[j], key=lambda e: e[0]) if j < len(cuts) else len(entries)
                    if end > start:
                        part = entries[start:end]
                        rows = pa.RecordBatch.from_pylist([dict(zip(_FIELDS, r)) for _, r in part], pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("archive", pa.string()), ("position", pa.int64()), ("size", pa.int64())]))
                        sink = pa.BufferOutputStream()
                        with pa.ipc.new_stream(sink, rows.schema) as w:
                            w.write_batch(rows)
                        yield pa.RecordBatch.from_arrays([pa.array([j], pa.int32()), pa.array([f"{path}"]), pa.array([front_code([k for k, _ in part])], pa.binary()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["range_id", "run", "keys", "entries"])
                    start = end

    def merge(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("run", kind="stable")
        tables = [pa.ipc.open_stream(b).read_all() for b in pdf["entries"]]
        base, total = [], 0
        for t in tables:
            base.append(total)
            total += t.num_rows
        seen = [0] * len(tables)
        order, keys = [], []
        for run, k, _ in loser_tree_merge([front_decode(b) for b in pdf["keys"]]):
            order.append(base[run] + seen[run])
            seen[run] += 1
            keys.append(k)
        out = pa.concat_tables(tables).take(pa.array(order)).to_pandas(integer_object_nulls=True)
        parts = [k.split(b"\0") for k in keys]
        out.insert(0, "range_id", int(key[0]))
        out.insert(1, "seq", range(len(out)))
        out.insert(2, "urlkey", [p[0].decode() for p in parts])
        out.insert(3, "timestamp", [p[-2].decode() for p in parts])
        for c in ("page_id", "refers_to"):
            out[c] = out[c].astype("Int64")
        return out

    spread = manifest.select("archive").repartition(max(1, archives))  # a stated number: tiny rows, large files
    runs = spread.mapInArrow(read, "range_id int, run string, keys binary, entries binary")
    return runs.groupBy("range_id").applyInPandas(merge, INDEX_SCHEMA)


def archive_pages(spark: SparkSession, pages: DataFrame, scratch: Scratch, min_revisit_bytes: int = 0, time_col: str | None = None) -> DataFrame:
    """Write all pages, read the archives back: the merged capture index."""
    manifest = write_archives(pages, scratch, min_revisit_bytes, time_col=time_col)
    rows, archives = manifest.agg(F.coalesce(F.sum("records"), F.lit(0)), F.count("*")).first()
    ranges = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // 1000), -(-rows // RANGE_ROWS))
    return capture_index(manifest, splitters(pages, ranges, rows, scratch, time_col=time_col), archives)
