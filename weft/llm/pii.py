"""Personal data: regular expressions propose, validators confirm, nearby words adjust a score.

Only built-in column expressions run. ``split`` and ``regexp_extract_all`` with one pattern walk
the same leftmost matches, so the lengths of the gaps and of the matches give each span's place
in code points. Patterns are possessive and never start inside a run that has already failed:
they stay linear and need no deep stack on very long texts.

Edge cases. Null text is empty text and has no spans; repeated rows stay; an empty table gives
an empty result; further columns are ignored by :func:`find_spans` and kept by :func:`redact`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPANS = "__weft_spans"
SPAN = "struct<kind:string,start:int,end:int,score:double>"


@dataclass(frozen=True)
class Rule:
    """``guard``: a cheap test of the whole text without which there can be no match."""

    kind: str
    pattern: str
    guard: str
    base: bool
    score: float
    words: str
    checked: float = 0.0


_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
RULES = (
    Rule("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", r"@", True, 0.9, "mail|contact|write"),
    Rule("ip", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]", True, 0.7, "ip|host|server|address"),
    Rule("card", r"[0-9](?:[\x20-]?[0-9])++", r"(?:[0-9][\x20-]?){15}[0-9]", True, 0.9, "card|visa|pay|credit"),
    Rule("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", True, 0.7, "tel|phone|call|fax|mobile"),
    Rule("iban", r"(?<![A-Za-z0-9_])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9_])", r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]", False, 0.1, "iban|bank|account|konto|compte", 0.6),
    Rule("card_short", r"(?<![A-Za-z0-9_])[0-9](?:[\x20-]?[0-9]){12,14}(?![A-Za-z0-9_])", r"(?:[0-9][\x20-]?){12}[0-9]", False, 0.1, "card|visa|amex|pay|credit", 0.2),
    Rule("secret", r"(?<![A-Za-z0-9_])[0-9a-f]{32,}+(?![A-Za-z0-9_])", r"[0-9a-f]{32}", False, 0.3, "token|secret|key|password|passwd|auth"),
)
#: Added spans need this score; a context word gives CONTEXT_BONUS and stands at most CONTEXT_SIGNS before the span.
THRESHOLD, CONTEXT_BONUS, CONTEXT_SIGNS = 0.5, 0.3, 40


def _mod97(iban: Column) -> Column:
    """Rest of an IBAN by 97: four signs moved to the end, A=10 ... Z=35."""
    packed = F.replace(iban, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(packed, F.lit(5)), F.left(packed, F.lit(4)))

    def step(rest: Column, sign: Column) -> Column:
        code = F.ascii(sign)
        return F.when(code < 58, (rest * 10 + (code - 48)) % 97).otherwise((rest * 100 + (code - 55)) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), lambda rest, sign: F.when(sign == "", rest).otherwise(step(rest, sign)))


def _valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    if kind == "ip":
        return match.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.when(n.between(16, 19), F.call_function("luhn_check", digits)).otherwise(False)
    if kind == "card_short":
        return F.call_function("luhn_check", digits)
    if kind == "phone":
        return n.between(8, 15)
    if kind == "iban":
        return F.length(F.replace(match, F.lit(" "), F.lit(""))).between(15, 34) & (_mod97(match) == 1)
    return F.lit(True)


def _spans(text: Column, rule: Rule) -> Column:
    none = F.expr(f"cast(array() as array<{SPAN}>)")
    pairs = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)).alias("hit"),
    )

    def step(acc: Column, pair: Column) -> Column:
        gap, hit = pair["gap"], pair["hit"]
        start = acc["at"] + F.length(gap)
        end = start + F.coalesce(F.length(hit), F.lit(0))
        near = F.lower(F.right(gap, F.lit(CONTEXT_SIGNS))).rlike(rf"(?<![A-Za-z0-9_])(?:{rule.words})")
        score = F.least(F.lit(1.0), F.lit(rule.score + rule.checked) + F.when(near, CONTEXT_BONUS).otherwise(0.0))
        good = hit.isNotNull() & F.coalesce(_valid(rule.kind, hit), F.lit(False))
        if not rule.base:
            good = good & (score >= THRESHOLD)
        span = F.struct(F.lit(rule.kind).alias("kind"), start.alias("start"), end.alias("end"), score.alias("score"))
        return F.struct(end.alias("at"), F.when(good, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), none.alias("out"))
    found = F.aggregate(pairs, zero, step, lambda acc: acc["out"])
    return F.when(text.rlike(rule.guard), found).otherwise(none)


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id`` and ``spans``: array of kind, start, end (exclusive, code points) and score, by
    kind in the order of ``rules``, then start. Base kinds always stay; the others need ``THRESHOLD``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.concat(*[_spans(text, r) for r in rules]).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The same rows and columns; each span of personal data in the text reads ``[KIND]``.

    Overlapping spans are one, named by the first. A null text stays null."""
    text, spans = F.col(text_col), F.col(_SPANS)
    found = F.concat(*[_spans(F.coalesce(text, F.lit("")), r) for r in rules])
    ordered = F.array_sort(F.transform(found, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind"))))

    def step(acc: Column, s: Column) -> Column:
        start, end = s["start"], -s["back"]
        piece = F.concat(F.substr(text, acc["at"] + 1, start - acc["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        covered = start < acc["at"]
        return F.struct(
            F.greatest(acc["at"], end).alias("at"),
            F.when(covered, acc["out"]).otherwise(F.concat(acc["out"], F.array(piece))).alias("out"),
        )

    zero = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("out"))
    clean = F.aggregate(spans, zero, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substr(text, acc["at"] + 1)))
    out = docs.withColumn(_SPANS, ordered)
    return out.withColumn(text_col, F.when(F.size(spans) > 0, clean).otherwise(text)).select(*docs.columns)
