"""Small odd tables on which a query once differed from its statement, compared value by value with the sign of zero."""

import glob
import os

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from weft.functions import extract
from weft.operators import edges
from weft.plans import catalog
from weft.sources import io


def shown(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(repr([tuple(r[k]) if isinstance(r[k], list) else r[k] for k in order]) for r in rows)


def assert_same(spark, folder, name, **tables):
    """``name`` on Spark and on DuckDB over ``tables``, one row group for each few rows."""
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    con.execute("SET threads = 1")
    for table, rows in tables.items():
        path = os.path.join(folder, f"{table}.parquet")
        pq.write_table(rows, path, row_group_size=64)
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    got = entry.queries()[name](spark, str(folder))
    cursor = con.execute(catalog.ORACLES[name])
    assert shown(got.columns, got.collect()) == shown([d[0] for d in cursor.description], cursor.fetchall())


def test_html_text_keeps_references_that_were_cut(spark, tmp_path):
    html = ["<p>a &amp; b &amp</p>c", "<p>x &quot</p>&copy;&am", "&&&amp;&quo<br>&amp;amp; &amp;lt; &amp", "<b>&lt;&gt;&#39;</b>&nosuch; &", None]
    assert_same(spark, tmp_path, "m_html_text", pages=pa.table({"page_id": range(len(html)), "html": html}))
    texts = spark.createDataFrame([(h,) for h in ("&eacute;&#8217;&#x41;", "&ampb &notit;")], "h string").select(extract.html_text(F.col("h")).alias("t")).collect()
    assert [r.t for r in texts] == ["é’A", "&ampb &notit;"]


def test_first_seen_takes_the_first_of_equal_places(spark, tmp_path):
    n = 400
    rows = {"l_orderkey": [k % 3 for k in range(n)], "l_partkey": [k % 7 for k in range(n)], "l_suppkey": list(range(n)), "l_linenumber": [1 + k % 2 for k in range(n)]}
    types = pa.schema([("l_orderkey", pa.int64()), ("l_partkey", pa.int64()), ("l_suppkey", pa.int64()), ("l_linenumber", pa.int32())])
    assert_same(spark, tmp_path, "f_first_seen", lineitem=pa.table(rows, schema=types))


#: Values that a rounding takes to zero from below, halves, and others.
NEAR_ZERO = [-1e-6, 1e-6, -4e-6, -6e-6, 0.000015, 0.000025, -0.000035, -0.0, 0.0, 0.25, -0.125, 1.000005]


def _embeddings(n=12, size=64):
    rows = [[NEAR_ZERO[(i + k) % len(NEAR_ZERO)] for k in range(size)] for i in range(n)]
    return pa.table({"vec_id": range(n), "embedding": pa.array(rows, pa.list_(pa.float32())), "label": pa.array(range(n), pa.int32())})


def test_concat_keeps_the_sign_of_zero(spark, tmp_path):
    assert_same(spark, tmp_path, "v_concat", embeddings=_embeddings())


def test_missing_images_keep_the_sign_of_zero(spark, tmp_path):
    assert_same(spark, tmp_path, "v_missing_images", embeddings=_embeddings(), pages=pa.table({"page_id": range(6)}))


def test_pooled_vectors_keep_the_sign_of_zero(spark, tmp_path):
    assert_same(spark, tmp_path, "v_meanpool", embeddings=_embeddings())
    assert_same(spark, tmp_path, "v_weighted_pool", embeddings=_embeddings())


def test_similar_posts_of_many_tags_shuffle_no_pairs(spark, monkeypatch):
    monkeypatch.setattr(edges, "CARRIED", 4, raising=False)
    sets = {p: {(p * 7 + k * (1 + p % 3)) % 23 for k in range(1 + p % 9)} for p in range(40)}
    rows = [(p, t) for p, s in sets.items() for t in s] + [(p, None) for p in (3, 5)]
    got = edges.similar_posts(spark.createDataFrame(rows, "post_id long, tag long"))
    size = {p: len(s) + (p in (3, 5)) for p, s in sets.items()}
    pairs = [(a, b, len(sets[a] & sets[b])) for a in sets for b in sets if a < b and sets[a] & sets[b]]
    want = {(a, b, n): n / (size[a] + size[b] - n) for a, b, n in pairs}
    found = {(r.post_a, r.post_b, r.n_shared): r.score for r in got.collect()}
    assert len(found) == got.count() and found.keys() == want.keys()
    assert all(abs(found[k] - v) <= 0.00005 + 1e-9 for k, v in want.items())
    # with few tags each, no exchange is dealt by a pair of posts
    plan = edges.similar_posts(spark.createDataFrame([(1, 1), (2, 1)], "post_id long, tag long"))._jdf.queryExecution().optimizedPlan().toString()
    near = plan.split("Union")[1].split("\n:- ")[-1] if "Union" in plan else plan
    assert "array_intersect" in near and "Aggregate [post_a" not in near


def test_log_lines_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    n, folders, read = 3000, [], io.last_log_lines
    monkeypatch.setattr(io, "last_log_lines", lambda session, folder, marker: folders.append(folder) or read(session, folder, marker))
    kinds = ["error" if k % 3 == 0 and k < 2900 else "view" for k in range(n)]
    users = [None if k % 50 == 0 else (-3, 2, 5)[k % 4 % 3] for k in range(n)]
    rows = pa.table({"event_id": [k * 7919 % n for k in range(n)], "user_id": pa.array(users, pa.int64()), "event_type": kinds})
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert_same(spark, tmp_path, "s_log_lines", events=rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    files = glob.glob(f"{folders[0].removeprefix('file://')}/worker=*/*.log")
    assert len({f.rpartition("/")[0] for f in files}) == 4 and len(files) > 4
