"""Toxicity, url filter, quality forest, decontamination, archives: brute force, held-out accuracy, round trips."""

import base64
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from weft.llm import decontam, quality, queries, runs, toxicity, urlfilter, warc
from weft.scratch import Scratch


def prose(rng, n, extra=()):
    return " ".join([rng.choice(["the", "of", "w%d" % rng.randrange(400), "x%d" % rng.randrange(4000)]) for _ in range(n)] + list(extra))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng, folder = random.Random(1), str(tmp_path_factory.mktemp("corpus"))
    docs, labels, items = [(None, None, "a"), (0, None, "a"), (1, "", None), (2, " \n ", "b")], [(None, 1, 1), (0, None, None)], []
    items = [(i, prose(rng, rng.randrange(14, 60)) + f" key{i} val{i}") for i in range(12)] + [(99, None), (98, "too short")]
    leaks = {}
    for i in range(3, 700):
        bad, junk = rng.random() < 0.2, rng.random() < 0.1
        words = prose(rng, rng.randrange(30, 200)).split()
        if bad:
            for _ in range(2 + len(words) // 60):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "moron", "scum", "réeuxpa", "réeuxch"]))
        if junk:
            words = [w + rng.choice(["###", "$$$", "|"]) for w in words]
        elif i % 25 == 0:
            k = rng.randrange(12)
            at = rng.randrange(len(words))
            words[at:at] = items[k][1].split()
            leaks[i] = k
        docs.append((i, " ".join(words), "s%d" % (i % 3)))
        if rng.random() < 0.7:
            labels.append((i, int(not junk), int(bad)))
    docs.append(docs[-1])
    spark.createDataFrame([(*d, "clash") for d in docs], "doc_id long, text string, source string, score string").repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, docs, labels, leaks


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    for name, schema in (("documents", "doc_id long, text string, source string"), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string"), ("pages", "page_id long, url string, html string")):
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_toxicity_on_held_out_labels(spark, corpus):
    folder, docs, labels, _ = corpus
    got = queries.op1_toxicity(spark, folder).collect()
    assert len(got) == len(docs)
    truth = {i: t for i, _, t in labels}
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    held = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out and truth.get(r.doc_id) is not None]
    assert len(held) > 60 and np.mean([p == t for p, t in held]) > 0.9


def test_toxicity_without_labels(spark, corpus, empty):
    docs, none = spark.read.parquet(f"{corpus[0]}/documents.parquet"), spark.read.parquet(f"{empty}/labels.parquet")
    assert {r.score for r in toxicity.score_toxicity(spark, docs, none).collect()} == {0.0}


def test_one_row_an_id_is_learnt_from(spark, corpus, monkeypatch):
    docs, labels = (spark.read.parquet(f"{corpus[0]}/{t}.parquet") for t in ("documents", "labels"))
    sampled, seen = toxicity._sampled, []
    monkeypatch.setattr(toxicity, "_sampled", lambda d, ids: seen.append(sampled(d, ids)) or seen[-1])
    toxic = docs.join(labels.where("toxic = 1 and doc_id is not null"), "doc_id", "left_semi").where("doc_id is not null").limit(1)
    copies = toxic.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(300)))).drop("k")
    other = copies.withColumn("text", F.concat("text", F.lit(" more")))
    plain, crowded = toxicity.fit_toxicity(spark, docs, labels), toxicity.fit_toxicity(spark, docs.unionByName(copies).unionByName(other), labels)
    assert len(seen[0]) == len(seen[1]) <= docs.select("doc_id").distinct().count()
    assert np.isclose(plain.prior, crowded.prior) and plain.weights.any()
    monkeypatch.setattr(toxicity, "MAX_SAMPLE_BYTES", 20_000)
    long = docs.withColumn("text", F.when(F.col("doc_id") % 2 == 0, F.repeat("text", 500)).otherwise(F.col("text")))
    assert toxicity.fit_toxicity(spark, long, labels) is not None and 0 < len(seen[2]) < len(seen[0])


@pytest.mark.parametrize("shift,negative", [(0.0, False), (4.0, True)])
def test_risk_and_its_slope(shift, negative):
    rng = np.random.default_rng(5)
    z, positive = rng.normal(size=40), np.arange(40) < 15
    z[positive] += shift
    z[~positive] -= shift
    confirmed, rest, slope = toxicity.nn_risk(z, positive, 0.4)
    assert (rest < 0) == negative
    followed = lambda v: (lambda c, r, _: -r if negative else c + r)(*toxicity.nn_risk(v, positive, 0.4))
    for k in range(0, 40, 3):
        step = np.eye(40)[k] * 1e-5
        assert np.isclose(slope[k], (followed(z + step) - followed(z - step)) / 2e-5, atol=1e-6)


def test_quality_statistics_equal_brute_force(spark, corpus):
    folder, docs, labels, _ = corpus
    texts = {i: t for i, t, _ in docs}
    got = queries.op5_quality_rules(spark, folder).collect()
    assert len(got) == len(docs)
    for r in got:
        text = texts[r.doc_id] or ""
        words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", text) if w]
        grams = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
        marked = {k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(5)}
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(words), sum(map(len, words)), len(marked))
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in text)
        assert r.base_failed == (len(words) < 10 or 100 * len(marked) > 20 * len(words))
        assert not (r.base_failed and r.kept)
    good = {i for i, q, _ in labels if q == 1}
    kept = [r.kept for r in got if r.doc_id in good and not r.base_failed]
    junk = [r.kept for r in got if r.doc_id in {i for i, q, _ in labels if q == 0} and not r.base_failed]
    assert np.mean(kept) > 0.97 and np.mean(junk) < 0.85


def test_path_lengths_equal_a_walk():
    rng = np.random.default_rng(1)
    parts = [rng.normal(size=(n, 5)) for n in (1, 2, 40, 256, 256)]
    parts[2][:, 1] = 0  # a statistic without a spread
    forest, points = quality.IsolationForest(3).fit(parts), rng.normal(size=(60, 5)) * 3

    def walk(x, k):
        feature, value, child = forest.nodes[k]
        at = 0
        while feature[at] >= 0:
            at = child[at] + int(x[feature[at]] > value[at])
        return value[at]

    def depth(points, x, k, at=0, level=0):  # how many of the subsample go the same way
        feature, value, child = forest.nodes[k]
        if feature[at] < 0:
            n, size = len(points), len(parts[k])
            mean = lambda m: 0.0 if m < 2 else 1.0 if m == 2 else 2 * (np.log(m - 1) + 0.5772156649) - 2 * (m - 1) / m
            return (level + mean(n)) / (mean(size) or 1.0)
        right = x[feature[at]] > value[at]
        side = points[(points[:, feature[at]] > value[at]) == right]
        return depth(side, x, k, child[at] + int(right), level + 1)

    for x, got in zip(points, forest.score(points)):
        assert np.isclose(got, 2 ** -np.mean([walk(x, k) for k in range(5)]))
        assert all(np.isclose(walk(x, k), depth(parts[k], x, k)) for k in range(5))


def test_cut_needs_both_kinds():
    assert quality.best_cut([(500, 0, 10), (450, 0, 5)]) == float("inf") == quality.best_cut([(500, 3, 0)]) == quality.best_cut([])
    assert quality.best_cut([(500, 1, 10), (450, 9, 5)]) == 500
    bins = [(k, (k * 7) % 3, (k * k) % 23) for k in range(40)]
    gain = lambda cut: sum(bad - quality.GOOD_COST * good for b, good, bad in bins if b >= cut)
    assert gain(quality.best_cut(bins)) == max(0, *(gain(b) for b, _, _ in bins))


def test_trees_draw_from_all_documents(spark, monkeypatch):
    monkeypatch.setattr(quality, "SUBSAMPLE", 40)
    rows = [(i, 10 + i, 50 + i, 0, 0, 0) for i in range(3000)] + [(5, 15, 55, 0, 0, 0)] * 500 + [(9000 + i, 0, 0, 0, 0, 0) for i in range(50)]
    parts = quality.subsamples(spark.createDataFrame(rows, f"doc_id long, {quality.STATS}").repartition(3))
    assert len(parts) == quality.TREES and all(20 <= len(p) <= 40 and len(np.unique(p[:, 0])) == len(p) for p in parts)
    assert len(np.unique(np.concatenate(parts)[:, 0])) > 2000


@pytest.mark.parametrize("text", ["a b c d e a b c d e x", "a " * 50, "l1 x\nl2\nl1 x\n\n \n \nl2", "\x1c\xa0\u2003 w \x85", "é # | <"])
def test_statistics_of_single_texts(text):
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", text) if w]
    grams = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if line.strip(" \t\n\r\x0b\x0c"):
            dup += line in seen
            seen.add(line)
    marked = {k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(5)}
    assert quality.text_stats(text) == (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(marked))


def test_leaks_are_found_and_others_left(spark, corpus):
    folder, docs, _, leaks = corpus
    got = queries.op7_decontamination(spark, folder).collect()
    assert {(r.doc_id, r.item_id) for r in got} == set(leaks.items())
    left = decontam.drop_leaks(spark, spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet"), Scratch(spark, "test"))
    assert left.count() == len([d for d in docs if d[0] not in leaks]) and left.columns[-1] == "score"


def test_short_and_reworded_items_are_found(spark, tmp_path):
    rng = random.Random(4)
    items, docs, leaks = [(900, "Zwei, drei vier!"), (901, "fünf")], [], set()
    for i in range(60):
        words = prose(rng, rng.randrange(9, 24)).split()
        for k in range(len(words) // 2):
            words.insert(rng.randrange(len(words) + 1), f"key{i}x{k}")
        items.append((i, " ".join(words)))
        for share in (0, 4):  # as it is, and with a quarter of the words exchanged
            own = list(words)
            for at in rng.sample(range(len(own)), len(own) // share if share else 0):
                own[at] = "y%d" % rng.randrange(9000)
            text = prose(rng, rng.randrange(40, 90)).split()
            at = rng.randrange(len(text))
            keys = [w for w in words if w.startswith("key")]
            if sum(w in own for w in keys) >= 0.75 * len(keys):
                leaks.add((len(docs), i))
                docs.append((len(docs), " ".join(text[:at] + own + text[at:])))
    for text, found in (("a zwei drei (vier) b", {900}), ("zwei drei b vier", set()), ("x fünf.", {901}), ("fünfzig", set())):
        leaks |= {(len(docs), i) for i in found}
        docs.append((len(docs), text))
    docs += [(1000 + i, prose(rng, 90)) for i in range(300)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in queries.op7_decontamination(spark, str(tmp_path)).collect()}
    assert len(leaks) > 80 and {x for x in leaks if x[1] >= 900} <= got
    assert got <= leaks and len(leaks - got) <= 1


def test_words_not_terms_decide(spark, monkeypatch):
    rng = random.Random(7)
    vocabulary = [f"v{k}" for k in range(40_000)]
    by_term = {}
    for w in vocabulary:
        by_term.setdefault(int(decontam.term_numbers(decontam.word_hashes(w))[0]), []).append(w)
    twins = [ws for ws in by_term.values() if len(ws) > 1]
    item = [ws[0] for ws in rng.sample(twins, 20)]
    other = [next(w for w in by_term[int(decontam.term_numbers(decontam.word_hashes(x))[0])] if w != x) for x in item]
    docs = [(1, " ".join(item)), (2, " ".join(other)), (None, "x y " + " ".join(item)), (4, " ".join(item) + " z"), (4, "clean " * 30)]
    docs += [(10 + i, " ".join(rng.choice(vocabulary) for _ in range(60))) for i in range(60)]
    table = spark.createDataFrame([(*d, "c") for d in docs], "doc_id long, text string, tag string")
    items = spark.createDataFrame([(7, " ".join(item)), (None, " ".join(other)), (8, None)], "item_id long, text string")
    assert sorted((r.doc_id or 0, r.item_id) for r in decontam.find_leaks(spark, table, items, Scratch(spark, "test")).collect()) == [(0, 7), (1, 7), (4, 7)]
    left = decontam.drop_leaks(spark, table, items, Scratch(spark, "test")).collect()
    assert len(left) == len(docs) - 3 and {(r.doc_id, r.text[:5]) for r in left} >= {(4, "clean"), (2, " ".join(other)[:5])}


def test_answers_blocks_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 40)
    rng = random.Random(8)
    items = [(i, prose(rng, 20), f"answer{i} is{i} here{i}") for i in range(9)]
    long = prose(rng, 30_000).split()
    for k, (_, text, answer) in enumerate(items[:4]):
        long[7000 * k : 7000 * k] = (text + " " + answer).split()
    docs = [(1, " ".join(long)), (2, items[5][1]), (3, items[6][1] + " " + items[6][2]), (4, ""), (5, None)] + [(10 + i, prose(rng, 80)) for i in range(100)]
    got = decontam.find_leaks(spark, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string, answer string"), Scratch(spark, "test"), "answer").collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1, 0), (1, 1), (1, 2), (1, 3), (3, 6)}  # item 5 stands there without its answer


def test_lcs_equals_the_table():
    rng = np.random.default_rng(3)
    for _ in range(30):
        a, b = rng.integers(0, 6, rng.integers(1, 80)), rng.integers(0, 6, rng.integers(1, 90))
        row = np.zeros(len(b) + 1, int)
        for x in a:
            new = row.copy()
            for k, y in enumerate(b):
                new[k + 1] = row[k] + 1 if x == y else max(new[k], row[k + 1])
            row = new
        assert decontam.lcs_length(a.tolist(), b.tolist()) == row[-1]


URLS = [None, "", "no scheme", "http://", "HTTP://A.Example.COM:80/en/1?x#y", "https://com/en/", "x://example.com/en/71", "x://notexample.com/en/71", "x://b.example.net/de/81", "x://b.example.net/de/91#://q", "x://ÀB.org/es/", "x://org?/es/"] + [f"https://h{i % 9}.example.{t}/{p}/{i}" for i in range(200) for t, p in (("com", "en"), ("net", "de"), ("org", "fr"))]


def test_url_rules(spark, tmp_path):
    spark.createDataFrame([(i, u, "c") for i, u in enumerate(URLS)], "page_id long, url string, host string").write.parquet(f"{tmp_path}/pages.parquet")
    got = queries.op2_url_filter(spark, str(tmp_path)).collect()
    assert len(got) == len(URLS)
    for r in got:
        url = URLS[r.page_id] or ""
        rest = url.split("://", 1)[1] if "://" in url else ""
        cut = min([k for k in (rest.find(c) for c in "/?#") if k >= 0], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
        fits = [x for x in urlfilter.RULES if (host == x.host or host.endswith("." + x.host)) and path.startswith(x.path)]
        rule = max(fits, key=lambda x: len(x.pattern), default=None)
        assert (r.host, r.path, r.rule) == (host, path, rule.pattern if rule else None)
        assert r.verdict in ("allow", "block") and (rule is None or r.verdict == ("allow" if rule.allow else "block"))
    by = {URLS[r.page_id]: r.verdict for r in got}
    assert by["https://h1.example.org/fr/1"] in ("allow", "block")


def test_one_sided_urls_allow(spark):
    rows = [(i, f"https://h{i}.example.net/de/a{i}") for i in range(80)] + [(100, "https://foreign.info/x"), (101, None), (102, "y" * 30_000), (102, "y" * 30_000)]
    got = urlfilter.judge_urls(spark, spark.createDataFrame(rows, "page_id long, url string"), Scratch(spark, "test")).collect()
    assert len(got) == len(rows) and {(r.llr, r.verdict) for r in got if r.page_id >= 100} == {(0.0, "allow")}


def markov(labelled):
    """Scores of both models, counted in dictionaries."""
    counts = {}
    for url, label in labelled:
        signs = b"\x02" * 5 + (url or "").encode() + b"\x03"
        for at in range(5, len(signs)):
            for k in range(6):
                for key in ((label, k, signs[at - k : at]), (label, k, signs[at - k : at], signs[at])):
                    counts[key] = counts.get(key, 0) + 1

    def chance(label, context, sign):
        p = 1 / 256
        for k in range(6):
            own = context[5 - k :]
            p = (counts.get((label, k, own, sign), 0) + 2 * p) / (counts.get((label, k, own), 0) + 2)
        return p

    def score(url):
        signs = b"\x02" * 5 + (url or "").encode() + b"\x03"
        return sum(np.log(chance(1, signs[at - 5 : at], signs[at])) - np.log(chance(0, signs[at - 5 : at], signs[at])) for at in range(5, len(signs))) / (len(signs) - 5)

    return chance, score


def test_chances_after_a_context_sum_to_one():
    chance, _ = markov([("https://a.example.net/de/1", 1), ("https://a.example.com/en/1", 0)])
    for context in (b"\x02" * 5, b"a.exa", b"https", b"zzzzz"):
        assert all(np.isclose(sum(chance(label, context, s) for s in range(256)), 1.0) for label in (0, 1))


def test_verdicts_equal_brute_force_models(spark):
    rng = random.Random(6)
    urls = URLS + [f"https://{rng.choice(['news', 'spam', 'x'])}{rng.randrange(99)}.{rng.choice(['example.net/de', 'example.com/en', 'foreign.info/de', 'other.info/en'])}/{rng.randrange(10**5)}" for _ in range(300)]
    got = sorted(urlfilter.judge_urls(spark, spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(3), Scratch(spark, "test")).collect(), key=lambda r: r.page_id)
    allow = {x.pattern: x.allow for x in urlfilter.RULES}
    labelled = [(urls[r.page_id], int(allow[r.rule])) for r in got if r.rule]
    held = [x for x in labelled if zlib.crc32(x[0].encode()) % urlfilter.HOLD_EVERY == 0]
    part = markov([x for x in labelled if x not in held])[1]
    bins = [(int(np.floor(part(u) * urlfilter.BINS_PER_NAT)), label) for u, label in held]
    gain = lambda cut: sum(b >= cut for b, x in bins if x) / max(1, sum(x for _, x in bins)) - sum(b >= cut for b, x in bins if not x) / max(1, sum(1 - x for _, x in bins))
    cut = max(sorted({b for b, _ in bins}), key=gain) / urlfilter.BINS_PER_NAT
    score = markov(labelled)[1]
    for r in got:
        assert np.isclose(r.llr, score(urls[r.page_id]), atol=1e-9)
        assert r.verdict == ("allow" if (allow[r.rule] if r.rule else r.llr >= cut) else "block")


def test_url_models_tell_the_sides_apart(spark):
    rows = [(f"https://spam{i}.bad.com/win/{i}", 0) for i in range(300)] + [(f"https://news{i}.good.net/text/{i}", 1) for i in range(300)]
    models = urlfilter.count_models(spark.createDataFrame(rows, "url string, label int").repartition(3))
    scores = models.scores(["https://spam999.bad.com/win/7", "https://news999.good.net/text/7", ""])
    assert scores[0] < 0 < scores[1]


def test_url_models_count_every_context_by_itself(spark):
    rng = random.Random(5)
    rows = [("x://" + "".join(rng.choice("abcdefghijklmnop") for _ in range(20)), i % 2) for i in range(6000)]
    counts = {}
    for url, label in rows:
        signs = b"\x02" * 5 + url.encode() + b"\x03"
        for at in range(5, len(signs)):
            for k in range(6):
                for key in ((label, k, signs[at - k : at]), (label, k, signs[at - k : at], signs[at])):
                    counts[key] = counts.get(key, 0) + 1
    assert len([key for key in counts if len(key) == 4 and key[1] == 5]) > 1 << 16  # more grams than any small table has slots

    def expected(url):
        signs, total = b"\x02" * 5 + url.encode() + b"\x03", 0.0
        for at in range(5, len(signs)):
            p = [1 / 256, 1 / 256]
            for k in range(6):
                p = [(counts.get((label, k, signs[at - k : at], signs[at]), 0) + 2 * p[label]) / (counts.get((label, k, signs[at - k : at]), 0) + 2) for label in (0, 1)]
            total += np.log(p[1]) - np.log(p[0])
        return total / (len(signs) - 5)

    asked = [rows[0][0], rows[1][0], "x://never/seen?é", "", rows[2][0][:12] + rows[3][0][12:]] * 2
    got = urlfilter.count_models(spark.createDataFrame(rows, "url string, label int").repartition(3)).scores(asked)
    assert np.allclose(got, [expected(u) for u in asked], atol=1e-9)


def test_scores_count_all_labelled_urls(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    got = urlfilter.judge_urls(spark, pages, Scratch(spark, "test")).collect()
    allow = {x.pattern: x.allow for x in urlfilter.RULES}
    labelled = [(URLS[r.page_id], int(allow[r.rule])) for r in got if r.rule]
    assert any(zlib.crc32(u.encode()) % urlfilter.HOLD_EVERY == 0 for u, _ in labelled)
    expected = urlfilter.count_models(spark.createDataFrame(labelled, "url string, label int")).scores(URLS)
    assert np.allclose([r.llr for r in sorted(got, key=lambda r: r.page_id)], expected, atol=1e-9)


PAGES = [(i, f"http://h{i % 3}.ex.com/{i % 7}", [None, "", "same", f"own {i}\r\n\r\nWARC/1.1\r\n"][i % 4]) for i in range(60)] + [(None, "http://z/", "same"), (5, None, "ü" * 70000), (3, "http://h0.ex.com/3", "own 3\r\n\r\nWARC/1.1\r\n")]


def test_archives_round_trip(spark, tmp_path):
    spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    got = queries.op9_warc_index(spark, str(tmp_path)).collect()
    largest = {}
    for i, _, html in PAGES:
        largest[html or ""] = max(largest.get(html or "", -1), -1 if i is None else i)
    expected = []
    for i, _, html in PAGES:
        raw = (html or "").encode()
        revisit = i is None or i < largest[html or ""]
        expected.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", largest[html or ""] if revisit else None))
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)


def test_index_is_in_global_order(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(5)
    manifest = warc.write_archives(pages, scratch := Scratch(spark, "test"))
    rows = warc.capture_index(manifest, warc.splitters(pages, 4, len(PAGES), scratch), 5).orderBy("range_id", "seq").collect()
    keys = [(r.urlkey, r.timestamp) for r in rows]
    assert len(keys) == len(PAGES) and keys == sorted(keys) and len({r.range_id for r in rows}) > 1
    assert scratch.root


def test_capture_times_and_hot_payloads(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "HOT_COPIES", 5)
    rows = [(i, f"http://h/{i % 4}", "same" if i % 3 else f"own{i % 6}", f"2024-01-{1 + i % 28:02d} 10:00:00" if i % 5 else None, "clash") for i in range(90)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, seen string, digest string").withColumn("seen", F.col("seen").cast("timestamp"))
    got = {r.page_id: r for r in warc.archive_pages(spark, pages, Scratch(spark, "test"), time_col="seen").collect()}
    last = {}
    for i, _, html, _, _ in rows:
        last[html] = i
    for i, _, html, seen, _ in rows:
        assert got[i].timestamp == (seen.replace(" ", "T") + "Z" if seen else f"2020-01-01T00:{i // 60:02d}:{i % 60:02d}Z")
        assert got[i].refers_to == (None if last[html] == i else last[html])
    order = sorted(got.values(), key=lambda r: (r.range_id, r.seq))
    assert [(r.urlkey, r.timestamp) for r in order] == sorted((r.urlkey, r.timestamp) for r in order)


def test_cut_keys_by_sorting(spark, monkeypatch):
    keys = spark.createDataFrame([(bytes([i % 256, i // 256]),) for i in range(1000)], "k binary").repartition(3)
    few = runs.cut_keys(keys, 7)
    monkeypatch.setattr(runs, "FEW_KEYS", 10)
    assert runs.cut_keys(keys, 7) == few and len(few) == 6 and runs.cut_keys(keys.limit(0), 7) == [] == runs.cut_keys(keys, 1)


def test_loser_tree_merges_and_knows_prefixes():
    rng = random.Random(2)
    parts = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randrange(12))) for _ in range(n)) for n in (0, 1, 40, 7, 90)]
    out = list(runs.loser_tree_merge([runs.front_decode(runs.front_code(p)) for p in parts]))
    assert [k for _, k, _ in out] == sorted(k for p in parts for k in p)
    assert all(out[i][2] == runs.common_prefix(out[i - 1][1], out[i][1]) for i in range(1, len(out)))


@pytest.mark.parametrize("name", ["op1_toxicity", "op2_url_filter", "op5_quality_rules", "op7_decontamination", "op9_warc_index"])
def test_empty_tables(spark, empty, name):
    assert queries.QUERIES[name](spark, empty).count() == 0


def test_pipeline_equals_its_stages_rules(spark, corpus):
    import corpus_pipeline

    folder, docs, labels, leaks = corpus
    got = corpus_pipeline.run(spark, folder).select("doc_id", "start", "length").collect()
    ids = {r.doc_id for r in got}
    assert not ids & set(leaks) and {None, 1} <= ids | {1}
    toxic = {i for i, _, t in labels if t == 1}
    clean = {i for i, _, t in labels if t == 0} - set(leaks)
    assert len(ids & toxic) < 0.2 * len(toxic) and len(ids & clean) > 0.9 * len(clean)
