"""The pipeline's stages on odd tables: no rows, clashing columns, repeated ids, nulls."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

CLASHING = ("root", "rep", "key", "part", "tag", "seed", "queue", "score", "__weft", "size", "n", "a", "b")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng, out = random.Random(11), str(tmp_path_factory.mktemp("stages"))
    prose = lambda n: " ".join(f"w{rng.randrange(900)}" for _ in range(n))
    item = prose(30)
    base = prose(120)
    texts = {0: None, 1: "", 2: base, 3: base, 4: base + " more", 5: prose(40) + " " + item, 6: "mail me at ann@example.org or +49 30 1234567 now " + prose(20), 7: prose(90_000)}
    texts |= {i: prose(60) + (" idiot moron" if i % 5 == 0 else "") for i in range(10, 160)}
    rows = [(i, t, "en", None if i == 6 else "ab"[i % 2], len(t or ""), *["x"] * len(CLASHING)) for i, t in texts.items()]
    rows += [(None, base, "en", "a", 3, *["y"] * len(CLASHING)), (20, prose(50), "en", "a", None, *["z"] * len(CLASHING)), rows[-1]]
    schema = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", {c} string" for c in CLASHING)
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(10, 160)] + [(None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return out


def test_stages_keep_columns_and_clean_rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id is null or doc_id % 5 <> 0 or doc_id < 10")
    stages = dict(corpus_pipeline.STAGES)
    for name in ("toxicity", "near_duplicates", "decontamination", "personal_data"):
        assert stages[name](spark, docs, folder).columns == docs.columns
    ids = lambda df: sorted((r.doc_id if r.doc_id is not None else -1) for r in df.select("doc_id").collect())
    every = ids(docs)
    assert set(every) - set(ids(stages["near_duplicates"](spark, docs, folder))) == {3, 4}  # the row without an id links with nothing
    assert [i for i in every if i != 5] == ids(stages["decontamination"](spark, docs, folder))
    clean = stages["personal_data"](spark, docs, folder)
    assert ids(clean) == every
    changed = clean.where("doc_id = 6").first()
    assert "ann@example.org" not in changed.text and changed.n_chars == len(changed.text)
    assert clean.where("text is not null and n_chars <> length(text)").count() == 0


def test_the_whole_run(spark, folder):
    got = corpus_pipeline.run(spark, folder)
    pieces = got.groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("all")).collect()
    kept = {r.doc_id for r in pieces}
    assert not kept & {3, 4, 5} and {None, 0, 1, 2, 6, 7} <= kept
    assert all(r.n % r.all == 0 for r in pieces if r.doc_id != 20)


def test_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
