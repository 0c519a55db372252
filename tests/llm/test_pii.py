import hashlib
import re

from weft.llm import pii


def luhn(d):
    t = 0
    for k, c in enumerate(reversed(d)):
        x = int(c)
        if k % 2:
            x = x * 2 - 9 * (x > 4)
        t += x
    return t % 10 == 0


def brute(text):
    text = text or ""
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


TEXTS = [
    None, "", "plain words only", "a@b.c-d@e.f a@b@c.de x.y@z.w_q@r.st", "ü 1.2.3.4.5.6.7.8 300.1.1.1 007.008.009.0010",
    "4845168114407329 4845 1681 1440 7329 123 4845168114407328 1 2 3", "+1 (017) 555-7713. call +49 30 1234567 + 5 +1", "x" * 30000 + "@", "1." * 5000 + "@a" + ".b" * 8000,
    "IBAN DE89 3704 0044 0532 0130 00. nope DE88370400440532013000", 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" and 04dbebab91ab85687d33eeaaf9ac699e1188f962' + "z",
    "pay by card 378282246310005 or 378282246310005", "\U0001f600 mail me: é.a@b.co",
]


def test_base_spans_match_brute_force(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] * 2
    got = pii.find_spans(spark.createDataFrame(rows, "doc_id long, text string, spans string")).collect()
    assert len(got) == len(rows)
    for r in got:
        base = [(s.kind, s.start, s.end) for s in r.spans if s.kind in ("email", "ip", "card", "phone")]
        assert base == brute(TEXTS[r.doc_id]), TEXTS[r.doc_id][:80]


def test_added_kinds_need_validator_or_context(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    got = {r.doc_id: [s.kind for s in r.spans] for r in pii.find_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[9].count("iban") == 1
    assert got[10].count("secret") == 1
    assert got[11].count("card_short") >= 1


def test_redact_keeps_rows_columns_and_other_text(spark):
    rows = [(i, t, 5) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    out = pii.redact(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert got[0] is None and got[1] == "" and got[2] == TEXTS[2]
    assert got[12] == "\U0001f600 mail me: é[EMAIL]"
    assert "555" not in got[6]


def test_empty_table(spark):
    assert pii.find_spans(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_digest(spark, tmp_path):
    from weft.llm import queries

    spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for r in queries.op8_personal_data(spark, str(tmp_path)).collect():
        b = brute(TEXTS[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in b).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(x[0] == k for x in b) for k in ("email", "ip", "card", "phone"))
