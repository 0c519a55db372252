"""The registered queries: thin wrappers that turn operator outputs into digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm import chat, decontam, exactdup, neardup, packing, pii, quality, toxicity, urlfilter, warc
from weft.scratch import Scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score for every document; labels of the held-out fold are not seen."""
    return toxicity.score_toxicity(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's url."""
    scratch = Scratch(spark, "op2")
    return scratch.bind(urlfilter.judge_urls(spark, _table(spark, sf_dir, "pages"), scratch))


def vocabulary() -> str:
    """The tokenizer file that op3 states."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of 2048 tokens, sources in proportion."""
    scratch = Scratch(spark, "op3")
    pieces = packing.pack(spark, _table(spark, sf_dir, "documents"), scratch, vocabulary())
    return scratch.bind(pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "padded_to"))


TRICKY_CHAT = "\\### Assistant: </turn> ok"


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and -7 whose texts look like the template's own marks."""
    chats = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(TRICKY_CHAT).alias("text"),
    )
    out = chat.format_chats(chats.unionByName(tricky))
    turns = chat.read_turns(F.col("formatted"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learnt = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: chat.unescape(s["text"])), "")
    return (
        out.select("conv_id", "valid", "bad_turn", "formatted", turns.alias("turns"), learnt.alias("learnt"))
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(said, 256).alias("turns_sha256"),
            F.length("learnt").cast("long").alias("loss_chars"),
            F.sha2("learnt", 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
            "valid",
        )
    )


OP4_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn::BIGINT AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
marked AS (
  SELECT *, length('### ' || upper(role[1]) || role[2:] || ': </turn>' || chr(10))
    + length(replace(replace(replace(text, '\', '\\'), '### ', '#\## '), '</turn>', '<\/turn>')) AS n,
    lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS prev
  FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(n)::BIGINT AS formatted_chars,
  bool_and(coalesce(prev, 'start') || '|' || role IN
    ('start|system', 'start|user', 'system|user', 'user|assistant', 'assistant|user', 'assistant|tool', 'tool|assistant'))
    AND arg_max(role, coalesce(turn, -1)) = 'assistant' AS valid
FROM marked GROUP BY conv_id
"""


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule statistics and verdict of every document."""
    scratch = Scratch(spark, "op5")
    return scratch.bind(quality.judge_quality(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), scratch))


def op6_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without byte strings that start earlier elsewhere."""
    scratch = Scratch(spark, "op6")
    out = exactdup.remove_repeats(_table(spark, sf_dir, "documents"), scratch)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return scratch.bind(out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item and how it was found."""
    scratch = Scratch(spark, "op7")
    return scratch.bind(decontam.find_leaks(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), scratch))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the base spans, and all spans, of every document."""
    found = pii.find_spans(_table(spark, sf_dir, "documents"))
    base = [r.kind for r in pii.RULES if r.base]
    shown = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(kind) for kind in base],
        F.sha2(F.array_join(F.transform(F.filter("spans", lambda s: s["kind"].isin(*base)), shown), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", shown), ",").alias("spans"),
    )


def _op8_sql() -> str:
    """The same proposals, checks and context scores over DuckDB's lists."""
    edge = r"\b"
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
        "iban": edge + r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}" + edge,
        "card_short": edge + r"[0-9](?:[\x20-]?[0-9]){12,14}" + edge,
        "secret": edge + r"[0-9a-f]{32,}" + edge,
    }
    digits = "regexp_replace(x.hit, '[^0-9]', '', 'g')"
    luhn = f"(list_sum(list_transform(range(length({digits})), lambda k: CASE WHEN k % 2 = 0 THEN reverse({digits})[k + 1]::INT ELSE '0246813579'[reverse({digits})[k + 1]::INT + 1]::INT END)) % 10 = 0)"
    packed = "replace(x.hit, ' ', '')"
    mod97 = f"(list_reduce(list_prepend(0, list_transform(string_split({packed}[5:] || {packed}[:4], ''), lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END)), lambda a, b: CASE WHEN b > 9 THEN (a * 100 + b) % 97 ELSE (a * 10 + b) % 97 END) = 1)"
    good = {
        "email": "true",
        "ip": "len(list_filter(string_split(x.hit, '.'), lambda o: length(ltrim(o, '0')) > 3 OR coalesce(try_cast(nullif(ltrim(o, '0'), '') AS BIGINT), 0) > 255)) = 0",
        "card": f"(CASE WHEN length({digits}) BETWEEN 16 AND 19 THEN {luhn} ELSE false END)",
        "phone": f"length({digits}) BETWEEN 8 AND 15",
        "iban": f"length({packed}) BETWEEN 15 AND 34 AND {mod97}",
        "card_short": luhn,
        "secret": "true",
    }
    ctes, lists = [], []
    for rule in pii.RULES:
        kind, pattern = rule.kind, patterns[rule.kind].replace("'", "''")
        check = good[kind]
        if not rule.base:
            check = f"({check}) AND {rule.score + rule.checked} + CASE WHEN regexp_matches(lower(right(x.gap, {pii.CONTEXT_SIGNS})), '\\b(?:{rule.words})') THEN {pii.CONTEXT_BONUS} ELSE 0 END >= {pii.THRESHOLD}"
        ctes.append(
            f"""{kind}_raw AS (SELECT rid, string_split_regex(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}') AS hits FROM d WHERE regexp_matches(t, '{pattern}')),
{kind} AS (SELECT rid, list_transform(list_filter(list_transform(range(1, len(hits) + 1), lambda i: {{'gap': gaps[i], 'hit': hits[i], 's': coalesce(list_sum(list_transform(gaps[:i], lambda g: length(g))), 0) + coalesce(list_sum(list_transform(hits[:i - 1], lambda h: length(h))), 0)}}),
 lambda x: {check}), lambda x: '{kind}:' || x.s || ':' || (x.s + length(x.hit))) AS l FROM {kind}_raw)"""
        )
        lists.append(kind)
    base = [r.kind for r in pii.RULES if r.base]
    all_ = lambda kinds: "array_to_string(" + " || ".join(f"coalesce({k}.l, []::VARCHAR[])" for k in kinds) + ", ',')"
    return (
        "WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents), "
        + ",\n".join(ctes)
        + " SELECT doc_id, "
        + ", ".join(f"coalesce(len({k}.l), 0)::BIGINT AS n_{k}" for k in base)
        + f", sha256({all_(base)}) AS base_sha256, {all_(lists)} AS spans FROM d "
        + " ".join(f"LEFT JOIN {k} ON {k}.rid = d.rid" for k in lists)
    )


OP8_SQL = _op8_sql()


def op9_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back through the merged capture index."""
    scratch = Scratch(spark, "op9")
    index = warc.archive_pages(spark, _table(spark, sf_dir, "pages").select("page_id", "url", "html"), scratch, min_revisit_bytes=0)
    return scratch.bind(index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document by word shingles."""
    scratch = Scratch(spark, "op10")
    return scratch.bind(neardup.near_duplicates(spark, _table(spark, sf_dir, "documents"), scratch))


OP10_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
items AS (SELECT doc_id, unnest(s) AS x FROM sets),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * shared.n >= 75 * (p.n + q.n - shared.n)),
arcs AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM arcs UNION SELECT r.a, e.b FROM reach r JOIN arcs e ON e.a = r.b)
SELECT z.doc_id, n AS n_shingles, least(z.doc_id, coalesce(min(r.b), z.doc_id)) AS component_id, z.doc_id <= coalesce(min(r.b), z.doc_id) AS kept
FROM sizes z LEFT JOIN reach r ON r.a = z.doc_id GROUP BY z.doc_id, n
"""


#: Windows of 100 bytes as 200 hex digits; the first place of each keeps it, runs of the others are cut out.
OP6_SQL = r"""
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id, coalesce(text, '')) AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT rid, s, h[2 * s + 1 : 2 * s + 200] AS w FROM d, unnest(range(0, length(h) // 2 - 99)) u(s)),
f AS (SELECT rid, s, row_number() OVER (PARTITION BY w ORDER BY rid, s) AS k FROM w),
r AS (SELECT rid, s, CASE WHEN s - lag(s) OVER (PARTITION BY rid ORDER BY s) <= 100 THEN 0 ELSE 1 END AS fresh FROM f WHERE k > 1),
g AS (SELECT rid, s, sum(fresh) OVER (PARTITION BY rid ORDER BY s) AS g FROM r),
spans AS (SELECT rid, min(s) AS a, max(s) + 100 AS b FROM g GROUP BY rid, g),
gaps AS (SELECT rid, a, b, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS before FROM spans),
cut AS (SELECT d.rid, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, string_agg(h[2 * before + 1 : 2 * a], '' ORDER BY a) || any_value(h)[2 * max(b) + 1 :] AS kept FROM gaps JOIN d USING (rid) GROUP BY d.rid)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256 FROM d LEFT JOIN cut USING (rid)
"""

#: Five hex digits of a digest are four of its base32 digits.
OP9_SQL = r"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, upper(sha1(coalesce(html, ''))) AS h FROM pages),
b AS (SELECT *, array_to_string(list_transform(range(8), lambda j: array_to_string(list_transform([32768, 1024, 32, 1], lambda m: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(('0x' || h[5 * j + 1 : 5 * j + 5])::BIGINT // m) % 32 + 1]), '')), '') AS payload_digest FROM p),
l AS (SELECT h, max(page_id) AS last_id FROM p GROUP BY h)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id IS DISTINCT FROM last_id AND last_id IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id IS DISTINCT FROM last_id THEN last_id END AS refers_to FROM b JOIN l USING (h)
"""


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_url_filter": op2_url_filter,
    "op3_packing": op3_packing,
    "op4_chat_format": op4_chat_format,
    "op5_quality_rules": op5_quality_rules,
    "op6_repeated_bytes": op6_repeated_bytes,
    "op7_decontamination": op7_decontamination,
    "op8_personal_data": op8_personal_data,
    "op9_warc_index": op9_warc_index,
    "op10_near_duplicates": op10_near_duplicates,
}

ORACLES = {
    "op8_personal_data": OP8_SQL,
    "op10_near_duplicates": OP10_SQL,
    "op4_chat_format": OP4_SQL,
    "op6_repeated_bytes": OP6_SQL,
    "op9_warc_index": OP9_SQL,
}
