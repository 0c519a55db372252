"""Queries of sources, sinks and streams: what was written is read back."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import functions as F

from weft.operators import merge
from weft.plans.catalog import query
from weft.plans.standins import table
from weft.scratch import Scratch
from weft.sources import io
from weft.streaming import ingest

NATION = "post_id string, region long, name string"


def _nation_docs(spark, sf_dir):
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("post_id"), F.col("n_regionkey").cast("long").alias("region"), F.col("n_name").alias("name"))


def _written(spark, sf_dir, scratch):
    """Documents of all nations, a few of them replaced, beside a file that isn't JSON."""
    folder = scratch.path("documents")
    docs = _nation_docs(spark, sf_dir)
    io.write_documents(docs, folder)
    io.write_documents(docs.where("region = 1").withColumn("name", F.lower("name")), folder)
    spark.createDataFrame([('{"post_id": ',)], "value string").coalesce(1).write.text(f"{folder}/key=broken")
    return folder


def _as_json_files(spark, folder):
    """The broken file under a name that the readers look for."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/key=broken")
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in store.listStatus(path):
        if status.getPath().getName().endswith(".txt"):
            store.rename(status.getPath(), spark._jvm.org.apache.hadoop.fs.Path(path, "broken.json"))


@query("s_json_documents", "SELECT n_nationkey::VARCHAR AS post_id, n_regionkey::BIGINT AS region, CASE WHEN n_regionkey = 1 THEN lower(n_name) ELSE n_name END AS name FROM nation")
def s_json_documents(spark, sf_dir):
    scratch = Scratch(spark, "stores")
    folder = _written(spark, sf_dir, scratch)
    _as_json_files(spark, folder)
    return scratch.bind(io.read_documents(spark, folder, NATION).select("post_id", "region", "name"))


@query("s_list_documents", "SELECT count(*) + 1 AS files FROM nation")
def s_list_documents(spark, sf_dir):
    scratch = Scratch(spark, "stores")
    folder = _written(spark, sf_dir, scratch)
    _as_json_files(spark, folder)
    return scratch.bind(io.list_documents(spark, folder).agg(F.count("*").alias("files")))


@query("s_sorted", "SELECT n_nationkey::VARCHAR AS post_id, row_number() OVER (ORDER BY n_nationkey::VARCHAR || '/') - 1 AS place FROM nation")
def s_sorted(spark, sf_dir):
    scratch = Scratch(spark, "stores")
    folder = scratch.path("documents")
    io.write_documents(_nation_docs(spark, sf_dir), folder)
    from pyspark.sql import Window

    read = io.read_sorted(spark, folder, NATION)
    place = F.row_number().over(Window.orderBy(F.monotonically_increasing_id())) - 1
    return scratch.bind(read.select("post_id", place.cast("long").alias("place")))


@query("s_jsonl", "SELECT c_custkey, c_name, CASE WHEN c_nationkey > 5 THEN c_mktsegment END AS segment, '{\"c_custkey\":' || c_custkey || ',\"c_name\":\"' || c_name || '\",\"segment\":' || CASE WHEN c_nationkey > 5 THEN '\"' || c_mktsegment || '\"' ELSE 'null' END || '}' AS line FROM customer")
def s_jsonl(spark, sf_dir):
    scratch = Scratch(spark, "stores")
    folder = scratch.path("lines")
    io.write_jsonl(table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.when(F.col("c_nationkey") > 5, F.col("c_mktsegment")).alias("segment")), folder)
    lines = spark.read.text(folder)
    return scratch.bind(lines.select(F.from_json("value", "c_custkey long, c_name string, segment string").alias("r"), F.col("value").alias("line")).select("r.*", "line"))


@query("s_tables", "SELECT 'users' AS name, count(*) AS n FROM customer UNION ALL SELECT 'posts', 0")
def s_tables(spark, sf_dir):
    scratch = Scratch(spark, "stores")
    database = "weft_" + uuid.uuid4().hex[:12]
    schemas = {"users": "user_id long, name string", "posts": "post_id string"}
    io.create_tables(spark, database, schemas, scratch.path("database"))
    io.create_tables(spark, database, schemas)
    try:
        table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name")).write.mode("append").insertInto(f"{database}.users")
        counts = [(name, spark.table(f"{database}.{name}").count()) for name in schemas]
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")
    return spark.createDataFrame(counts, "name string, n long")


@query("s_upsert_table", "SELECT c_custkey AS k, CASE WHEN c_acctbal < 0 THEN 'third' WHEN c_nationkey < 10 THEN 'second' ELSE 'first' END AS version FROM customer")
def s_upsert_table(spark, sf_dir):
    scratch = Scratch(spark, "stores")
    path = scratch.path("table")
    c = table(spark, sf_dir, "customer")
    for seq, (version, rows) in enumerate({"first": c, "second": c.where("c_nationkey < 10"), "third": c.where("c_acctbal < 0")}.items()):
        io.upsert_table(spark, path, rows.select(F.col("c_custkey").alias("k"), F.lit(version).alias("version"), F.lit(seq).alias("seq")), ["k"], "seq")
    return scratch.bind(io.read_table(spark, path).select("k", "version"))


@query("s_save_samples", "SELECT 'samples' AS name, count(*) AS n FROM nation UNION ALL SELECT 'edges_user_post', count(*) FROM nation UNION ALL SELECT 'hashtag_nodes', 2 * count(*) FROM nation")
def s_save_samples(spark, sf_dir):
    from weft.sources.schema import DOCUMENT

    scratch = Scratch(spark, "stores")
    one = F.concat(
        F.lit('{"sample_id":"g","post_id":"'), F.col("post_id"), F.lit('","graph_structure":{"edges_user_post":[{"edge_id":"e","user_id":"u","post_id":"'), F.col("post_id"), F.lit('","interaction_type":"author","weight":10.0}],"hashtag_nodes":[{"hashtag":"a","frequency":1,"post_ids":["'), F.col("post_id"), F.lit('"]},{"hashtag":"b","frequency":1,"post_ids":[]}]}}')
    )
    docs = _nation_docs(spark, sf_dir).select(F.from_json(one, DOCUMENT).alias("d")).select("d.*")
    paths = io.save_samples(docs, scratch.path("samples"))
    read = lambda n: spark.read.parquet(paths[n]).agg(F.count("*").alias("n")).select(F.lit(n).alias("name"), "n")
    return scratch.bind(read("samples").unionByName(read("edges_user_post")).unionByName(read("hashtag_nodes")))


@query("s_targets", "SELECT 'post' AS type, 'https://x.org/' || n_nationkey AS url, CASE WHEN n_regionkey = 2 THEN NULL ELSE n_name END AS category FROM nation")
def s_targets(spark, sf_dir):
    scratch = Scratch(spark, "stores")
    path = scratch.path("targets")
    n = table(spark, sf_dir, "nation")
    io.write_targets(n.select(F.lit("post").alias("type"), F.concat(F.lit("https://x.org/"), "n_nationkey").alias("url"), F.lit(None).cast("string").alias("query"), F.when(F.col("n_regionkey") != 2, F.col("n_name")).alias("category")), path)
    return scratch.bind(io.read_targets(spark, path).select("type", "url", "category"))


SERVICE_ROWS = 2345


def service_page(offset: int, limit: int) -> list[dict]:
    """Stand-in for a service that gives rows by offset."""
    return [{"id": i, "name": f"row {i}"} for i in range(offset, min(offset + limit, SERVICE_ROWS))]


def service_range() -> str:
    return f"0-0/{SERVICE_ROWS}"


@query("s_paged", f"SELECT i AS id, 'row ' || i AS name FROM range({SERVICE_ROWS}) t(i)")
def s_paged(spark, sf_dir):
    spark.dataSource.register(io.PagedSource)
    here = "weft.plans.stores"
    return spark.read.format("weft_pages").option("pages", f"{here}:service_page").option("count", f"{here}:service_range").option("limit", 500).option("schema", "id long, name string").schema("id long, name string").load()


@query("s_remote_count", "SELECT * FROM (VALUES ('0-0/1234', 1234), ('0-9/*', 0), ('', 0), ('10', 10)) t(header, n)")
def s_remote_count(spark, sf_dir):
    return spark.createDataFrame([(h, io.range_total(h)) for h in ("0-0/1234", "0-9/*", "", "10")], "header string, n int")


@query("s_unsent", "WITH n AS (SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 500 AS batch FROM n")
def s_unsent(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").alias("place"))
    return io.unsent(d.unionByName(d), table(spark, sf_dir, "labels"), "doc_id", "place").select("doc_id", "batch")


@query("s_local_or_remote", "SELECT r_name AS name, 'local' AS origin FROM region UNION ALL SELECT n_name, 'remote' FROM nation")
def s_local_or_remote(spark, sf_dir):
    scratch = Scratch(spark, "stores")
    path = scratch.path("local")
    table(spark, sf_dir, "region").select(F.col("r_name").alias("name"), F.lit("local").alias("origin")).write.parquet(path)
    remote = lambda: table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), F.lit("remote").alias("origin"))
    return scratch.bind(io.local_or_remote(spark, path, remote).unionByName(io.local_or_remote(spark, f"{path}-absent", remote)))


@query("s_config", "SELECT * FROM (VALUES ('a.b', '2'), ('a.c.d', 'x'), ('e', '3'), ('f.g', 'new')) t(k, v)")
def s_config(spark, sf_dir):
    config = io.patched({"a": {"b": 1, "c": {"d": "x"}}, "e": 3}, {"a.b": 2, "f.g": "new"})
    return spark.createDataFrame([(k, str(v)) for k, v in config.items()], "k string, v string")


@query("s_log_lines", "SELECT user_id % 7 AS worker, max(event_id) AS last FROM events WHERE event_type = 'error' GROUP BY 1")
def s_log_lines(spark, sf_dir):
    scratch = Scratch(spark, "stores")
    folder = scratch.path("logs")
    e = table(spark, sf_dir, "events")
    lines = e.select((F.col("user_id") % 7).alias("worker"), "event_id", F.concat("event_type", F.lit(" item "), "event_id").alias("value"))
    # a worker's log is rolled over: each task writes one range of it, numbered in the order of the lines
    lines.repartitionByRange("worker", "event_id").sortWithinPartitions("worker", "event_id").select("worker", "value").write.partitionBy("worker").text(folder)
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    store = fs_path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for worker in store.listStatus(fs_path(folder)):
        for status in store.listStatus(worker.getPath()) if worker.isDirectory() else ():
            part = re.match(r"part-([0-9]+)-.*[.-]c([0-9]+)[.]txt$", status.getPath().getName())
            if part:
                store.rename(status.getPath(), fs_path(worker.getPath(), f"run-{int(part[1]):08d}-{int(part[2]):08d}.log"))
    found = io.last_log_lines(spark, folder, "error item")
    # the last line of a worker stands in the last of its files that has one
    last = found.groupBy(F.regexp_extract("path", "worker=(-?[0-9]*)", 1).try_cast("long").alias("worker")).agg(F.max_by("line", "path").alias("line"))
    return scratch.bind(last.select("worker", F.regexp_extract("line", "(-?[0-9]+)$", 1).cast("long").alias("last")))


@query("s_folder_size", "SELECT count(*) AS files, sum(length(n_name) + 1)::BIGINT AS bytes FROM nation")
def s_folder_size(spark, sf_dir):
    scratch = Scratch(spark, "stores")
    folder = scratch.path("folder")
    table(spark, sf_dir, "nation").select(F.col("n_name").alias("value"), F.col("n_nationkey").alias("k")).repartition(3).write.partitionBy("k").text(folder)
    return scratch.bind(io.folder_size(spark, folder).select("files", "bytes"))


@query("s_save_media", "SELECT page_id, octet_length(encode(html)) AS bytes, octet_length(encode(html)) <= 6000 AS saved, CASE WHEN octet_length(encode(html)) <= 6000 THEN page_id || CASE WHEN page_id % 2 = 0 THEN '.png' ELSE '.mp4' END END AS file FROM pages")
def s_save_media(spark, sf_dir):
    scratch = Scratch(spark, "stores")
    folder = scratch.path("media")
    p = F.col("page_id")
    media = table(spark, sf_dir, "pages").select(p.cast("string").alias("name"), F.when(p % 2 == 0, "http://x/y.jpg").otherwise("http://x/z.MP4").alias("url"), F.when(p % 2 == 0, "image/png").alias("content_type"), F.encode("html", "utf-8").alias("content"))
    manifest = scratch.save(io.save_media(media, folder, 6000), "manifest")
    files = spark.read.format("binaryFile").load(folder).select(F.regexp_extract("path", "([^/]+)$", 1).alias("file"), "length")
    both = manifest.withColumn("file", F.regexp_extract("path", "([^/]+)$", 1)).join(files, "file", "left")
    return scratch.bind(both.select(F.col("name").cast("long").alias("page_id"), "bytes", (F.col("length") == F.col("bytes")).eqNullSafe(True).alias("saved"), "file"))


@query("s_done_set", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND NOT (lang = 'en')")
def s_done_set(spark, sf_dir):
    scratch = Scratch(spark, "stores")
    d = table(spark, sf_dir, "documents")
    done = io.DoneSet(spark, scratch.path("done"))
    done.add(table(spark, sf_dir, "labels").select("doc_id"))
    done.add(d.where("lang = 'en'").select("doc_id"))
    done.add(d.where("lang = 'en'").select("doc_id"))
    return scratch.bind(done.pending(d, "doc_id").select("doc_id"))


@query("f_remote_done", "SELECT doc_id::VARCHAR AS id FROM labels UNION SELECT doc_id::VARCHAR FROM documents WHERE lang = 'de'")
def f_remote_done(spark, sf_dir):
    scratch = Scratch(spark, "stores")
    done = io.DoneSet(spark, scratch.path("done"))
    done.add(table(spark, sf_dir, "labels").select("doc_id"))
    return scratch.bind(done.merge_remote(table(spark, sf_dir, "documents").where("lang = 'de'").select("doc_id")))


@query("s_flushes", "SELECT event_id, CASE WHEN (row_number() OVER (ORDER BY event_id) - 1) // 64 < (SELECT count(*) FROM events) // 64 THEN (row_number() OVER (ORDER BY event_id) - 1) // 64 END AS flush FROM events")
def s_flushes(spark, sf_dir):
    return io.flushes(table(spark, sf_dir, "events").select("event_id"), "event_id", 64).select("event_id", F.col("flush").cast("long").alias("flush"))


@query("st_due_checks", "WITH r AS (SELECT event_id, row_number() OVER (ORDER BY event_id) AS n FROM events) SELECT event_id FROM r WHERE n % 10 = 0")
def st_due_checks(spark, sf_dir):
    return io.due_checks(table(spark, sf_dir, "events").select("event_id"), "event_id")


# Streams: files that arrive are taken over in micro-batches until nothing is left.
def _arrived(spark, sf_dir, scratch):
    """Events as JSON files of one folder, every event twice."""
    folder = scratch.path("arrived")
    e = table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("post_id"), "user_id", "event_type", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"))
    e.unionByName(e).repartition(6).write.json(folder)
    return ingest.sample_stream(spark, folder, "post_id string, user_id long, event_type string, ts timestamp", 2)


@query("st_ingest", "SELECT event_id::VARCHAR AS post_id, user_id FROM events WHERE event_type <> 'error'")
def st_ingest(spark, sf_dir):
    scratch = Scratch(spark, "stores")
    done = io.DoneSet(spark, scratch.path("done"))
    done.add(table(spark, sf_dir, "events").where("event_type = 'error'").select("event_id"))
    sink = scratch.path("sink")
    stream = _arrived(spark, sf_dir, scratch)
    ingest.ingest(stream, done, lambda rows, n: rows.write.mode("overwrite").parquet(f"{sink}/batch={n}"), "post_id", scratch.path("checkpoint")).awaitTermination()
    return scratch.bind(spark.read.parquet(sink).select("post_id", "user_id"))


@query("st_drain", "SELECT event_type, 2 * count(*) AS n FROM events GROUP BY 1")
def st_drain(spark, sf_dir):
    scratch = Scratch(spark, "stores")
    drained = scratch.path("drained")
    ingest.drain(_arrived(spark, sf_dir, scratch), drained, scratch.path("checkpoint")).awaitTermination()
    return scratch.bind(spark.read.parquet(drained).groupBy("event_type").agg(F.count("*").alias("n")))


@query("st_once", "SELECT event_id::VARCHAR AS post_id FROM events")
def st_once(spark, sf_dir):
    scratch = Scratch(spark, "stores")
    out = scratch.path("once")
    events = ingest.once(_arrived(spark, sf_dir, scratch), "post_id", "ts", "4000 days").select("post_id")
    events.writeStream.format("parquet").option("checkpointLocation", scratch.path("checkpoint")).trigger(availableNow=True).start(out).awaitTermination()
    return scratch.bind(spark.read.parquet(out))


@query("st_recent", "WITH w AS (SELECT user_id, unnest(list_transform(range(1, 7), lambda k: (epoch_us(ts) // 10000000 + k) * 10000000)) AS at_us FROM events) SELECT at_us, user_id, count(*) AS n FROM w GROUP BY 1, 2")
def st_recent(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    return ingest.recent_counts(e, "user_id").select(F.unix_micros("at").alias("at_us"), "user_id", "n")


@query("st_backoff", "WITH m AS (SELECT user_id, list_prepend(0, list(CASE event_type WHEN 'error' THEN 1 WHEN 'signup' THEN 3 ELSE 0 END ORDER BY event_id)) AS m FROM events GROUP BY 1) SELECT user_id::VARCHAR AS key, list_sum(m)::BIGINT AS level FROM m")
def st_backoff(spark, sf_dir):
    scratch = Scratch(spark, "stores")
    folder, out = scratch.path("marks"), scratch.path("levels")
    table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("key"), F.expr("CASE event_type WHEN 'error' THEN 'throttle' WHEN 'signup' THEN 'ban' ELSE 'other' END").alias("event")).repartition(4).write.json(folder)
    levels = ingest.backoff_levels(ingest.sample_stream(spark, folder, "key string, event string", 2))
    keep = lambda rows, n: rows.withColumn("n", F.lit(n)).write.mode("overwrite").parquet(f"{out}/part={n}")
    levels.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", scratch.path("checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return scratch.bind(spark.read.parquet(out).groupBy("key").agg(F.max_by("level", "n").alias("level")))


@query("f_pending_all", "SELECT n_nationkey FROM nation WHERE n_name <> 'NATION_3' AND n_regionkey <> 2")
def f_pending_all(spark, sf_dir):
    pending = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("url"), F.col("n_regionkey").cast("string").alias("query"))
    return merge.drop_pending(pending, F.lit("NATION_3"), F.lit("2")).select("n_nationkey")
