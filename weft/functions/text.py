"""Text, count and time functions as column expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from weft.functions.urls import first_match

# Reaction words in order of precedence, units of relative times in seconds, noise lines,
# emoji ranges, page classes with their signs in order.
REACTIONS = {
    "thích": "like",
    "like": "like",
    "yêu": "love",
    "love": "love",
    "haha": "haha",
    "wow": "wow",
    "buồn": "sad",
    "sad": "sad",
    "phẫn nộ": "angry",
    "angry": "angry",
    "thương thương": "care",
    "care": "care",
}
UNITS = {"giây": 1, "phút": 60, "giờ": 3600, "ngày": 86400, "tuần": 604800, "tháng": 2592000, "năm": 31536000}
POST_NOISE = ("đóng", "close", "trang chủ", "notification", "hãy là người đầu tiên bình luận.", "be the first to comment.")
COMMENT_NOISE_AUTHORS = ("Tìm bạn bè", "Find friends", "Gợi ý cho bạn", "Suggested for you", "Bạn có thể biết", "People you may know")
COMMENT_NOISE_TEXTS = ("Không còn bài viết nào", "No more posts", "No more content")
PARENT_PATTERNS = (r"Phản hồi bình luận của (.+?)\s+dưới tên", r"đáp lại phản hồi của (.+?)\s+vào", r"Replied to (.+?)'s comment", r"replied to (.+?)$")
HEADING_PREFIXES = ("Bài viết của ", "Posts by ", "Post by ")
PAGE_CLASSES = {
    "checkpoint": ("confirm your identity", "xác nhận danh tính", "checkpoint", "suspicious activity", "hoạt động đáng ngờ", "we noticed unusual activity"),
    "rate_limit": ("you're doing that too often", "bạn đang làm điều đó quá thường xuyên", "please try again later", "vui lòng thử lại sau", "try again in a few minutes", "thử lại sau vài phút"),
    "captcha": ("captcha", "robot", "security check", "kiểm tra bảo mật", "verify you're human"),
    "account_disabled": ("your account has been disabled", "tài khoản của bạn đã bị vô hiệu hóa", "account disabled"),
    "ip_block": ("access denied", "403", "this page isn't available", "trang này không khả dụng"),
    "temp_block": ("temporarily blocked", "tạm thời bị chặn", "you've been blocked", "temporarily restricted", "bị hạn chế tạm thời"),
}
CONTENT_TYPES = {"image/jpeg": ".jpg", "image/png": ".png", "image/gif": ".gif", "image/webp": ".webp", "video/mp4": ".mp4", "video/webm": ".webm"}
URL_EXTENSIONS = (".jpg", ".jpeg", ".png", ".gif", ".webp", ".mp4", ".webm")
# U+24C2 to U+1F251 takes in everything from there to the end of the first plane.
EMOJI = "[\\x{10000}-\\x{10FFFF}\\x{24C2}-\\x{D7FF}\\x{E000}-\\x{FFFF}]+"


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, r"(?U)^[\s\x1C-\x1F]+|[\s\x1C-\x1F]+$", "")


def _all(text: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(group))


def hashtags(text: Column) -> Column:
    """Distinct tags, sorted."""
    return F.array_sort(F.array_distinct(_all(text, r"#([\p{L}\p{N}_]+)")))


def mentions(text: Column) -> Column:
    """Distinct mentions, sorted; a dot at the end belongs to them."""
    return F.array_sort(F.array_distinct(_all(text, r"@([\p{L}\p{N}_.]+)")))


def emojis(text: Column) -> Column:
    """Runs in order, repeated ones too; the widest range also takes in CJK and Hangul."""
    return _all(text, EMOJI, 0)


def external_links(text: Column) -> Column:
    return _all(text, r"(?U)(https?://\S+|www\.\S+)")


@F.pandas_udf(StringType())
def nfc(text: pd.Series) -> pd.Series:
    """Canonical composition, which Spark has no function for."""
    return text.str.normalize("NFC")


def clean_text(text: Column) -> Column:
    """NFC, no zero-width signs, single spaces, trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(nfc(text), r"[\x{200B}\x{200C}\x{200D}\x{FEFF}]", ""), r"(?U)[\s\x1C-\x1F]+", " "))


def parse_count(text: Column) -> Column:
    """``1,234`` and ``1.234`` are 1234; k, m and b multiply what is left without signs (``1.2K``: 12000)."""
    plain = F.lower(F.regexp_replace(strip(F.coalesce(text, F.lit(""))), "[,.]", ""))
    number = lambda t: F.when(t.rlike("^[0-9]+$"), t.try_cast("bigint"))
    head, out = F.substr(plain, F.lit(1), F.greatest(F.length(plain) - 1, F.lit(0))), number(plain)
    for sign, factor in (("k", 1_000), ("m", 1_000_000), ("b", 1_000_000_000)):
        out = F.when(plain.endswith(sign), number(head) * F.lit(factor).cast("bigint")).otherwise(out)
    return F.coalesce(out, F.lit(0).cast("bigint"))


def reaction(text: Column) -> tuple[Column, Column]:
    """Count and kind; the first word of ``REACTIONS`` that the text holds decides."""
    low, kind = F.lower(text), F.lit("unknown")
    for word, name in reversed(REACTIONS.items()):
        kind = F.when(F.contains(low, F.lit(word)), name).otherwise(kind)
    count = parse_count(first_match(text, r"([0-9,.]+[kKmMbB]?)"))
    return F.when(kind == "unknown", F.lit(0).cast("bigint")).otherwise(count), kind


def relative_time(text: Column, captured_at: Column) -> Column:
    """``3 giờ`` and the like before ``captured_at`` (timestamp); null without a unit."""
    pattern = r"([0-9]+)\s*(" + "|".join(UNITS) + ")"
    seconds = F.create_map(*[F.lit(x) for unit in UNITS.items() for x in unit])[first_match(text, pattern, 2)]
    return F.timestamp_micros(F.unix_micros(captured_at) - first_match(text, pattern).try_cast("bigint") * seconds * F.lit(1_000_000).cast("bigint"))


def epoch_iso(seconds: Column) -> Column:
    """ISO 8601 in UTC, whatever the session's zone is."""
    rest = F.pmod(seconds, F.lit(86400))
    part = lambda size, of: F.lpad(F.floor(rest / size % of).cast("string"), 2, "0")
    day = F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86400).cast("int")), "yyyy-MM-dd")
    return F.concat(day, F.lit("T"), part(3600, 24), F.lit(":"), part(60, 60), F.lit(":"), part(1, 60), F.lit("+00:00"))


def match_norm(text: Column) -> Column:
    """For comparing titles: no symbols, NFC, single spaces."""
    plain = F.regexp_replace(text, r"[\x{10000}-\x{10FFFF}\x{2600}-\x{27BF}\x{2B50}\x{2B55}\x{FE00}-\x{FE0F}\x{203C}\x{2049}]", "")
    return F.trim(F.regexp_replace(nfc(plain), r"(?U)[\s\x1C-\x1F]+", " "))


def title_excerpt(title: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(title, r"^\([0-9]+\)\s*[^-]+-\s*", ""), r"\s*\|.*$", ""))


def is_post_noise(text: Column, author: Column) -> Column:
    """Lines of the interface rather than of a post."""
    t = strip(text)
    words = F.filter(F.split(t, r"(?U)\s+"), lambda w: w != "")
    lines = F.filter(F.split(t, "\n"), lambda x: strip(x) != "")
    singles = F.size(F.filter(lines, lambda x: F.length(strip(x)) <= 1))
    name = F.coalesce(author, F.lit(""))
    return (
        (F.length(t) < 5)
        | F.lower(t).isin(*POST_NOISE)
        | t.rlike(r"^[0-9\s/.,-]+$")
        | ((name != "") & t.startswith(name))
        | ((F.size(words) <= 2) & F.contains(t, F.lit(".")) & (F.length(t) < 30))
        | ((F.size(lines) > 4) & (singles / F.size(lines) > 0.5))
    )


def is_comment_noise(author: Column, text: Column, href: Column, site: str) -> Column:
    away = (F.coalesce(href, F.lit("")) != "") & ~F.contains(href, F.lit(site + "/"))
    return F.coalesce(author.isin(*COMMENT_NOISE_AUTHORS), F.lit(False)) | F.coalesce(text.isin(*COMMENT_NOISE_TEXTS), F.lit(False)) | F.coalesce(away, F.lit(False))


def is_truncated(text: Column, marks: tuple[str, ...] = ("Xem thêm", "See more", "…")) -> Column:
    out = F.lit(False)
    for mark in marks:
        out = out | strip(text).endswith(mark)
    return out


def content_key(author_id: Column, author_name: Column, text: Column) -> Column:
    """Key of a comment's content: author and first sixty signs."""
    return F.concat(F.coalesce(F.nullif(author_id, F.lit("")), author_name, F.lit("")), F.lit(":"), F.substring(strip(text), 1, 60))


def heading_author(heading: Column) -> Column:
    plain = F.trim(F.regexp_replace(heading, r"(?U)\s+", " "))
    return F.nullif(first_match(plain, "^(?:" + "|".join(HEADING_PREFIXES) + ")(.{2,})$"), F.lit(""))


def parent_names(label: Column) -> Column:
    """Names that the ordered patterns find in a label; a join takes the first that is known."""
    return F.array_compact(F.array(*[strip(first_match(label, "(?iu)" + p)) for p in PARENT_PATTERNS]))


def follower_count(text: Column) -> Column:
    """First word as a count; null unless positive."""
    n = parse_count(F.element_at(F.split(strip(text), r"(?U)\s+"), 1))
    return F.when(n > 0, n)


def comment_id(numeric: Column, aria: Column, href: Column, text: Column) -> Column:
    key = F.concat_ws("|", F.coalesce(aria, F.lit("")), F.coalesce(href, F.lit("")), F.coalesce(text, F.lit("")))
    return F.coalesce(F.nullif(numeric, F.lit("")), F.concat(F.lit("cmt_"), F.substring(F.md5(key), 1, 8)))


def like_label(label: Column) -> Column:
    """Leading count of a label; ``1.2K`` is 1200 here, unlike :func:`parse_count`."""
    n = F.replace(first_match(label, r"^([0-9,.]+[kKmM]?) "), F.lit(","), F.lit(""))
    digits = F.regexp_extract(n, r"^([0-9]*)", 1).try_cast("bigint")
    return F.coalesce(F.when(F.lower(n).endswith("k"), F.round(F.regexp_extract(n, r"^([0-9.]*)", 1).try_cast("double") * 1000).cast("bigint")).otherwise(digits), F.lit(0).cast("bigint"))


def page_class(url: Column, title: Column, body: Column) -> Column:
    """Block pages by url first, then by ordered signs in body or title; ``none`` otherwise."""
    u, t, b = (F.lower(F.coalesce(c, F.lit(""))) for c in (url, title, body))
    by_text = F.lit("none")
    for name, signs in reversed(PAGE_CLASSES.items()):
        hit = F.lit(False)
        for sign in signs:
            hit = hit | F.contains(b, F.lit(sign)) | F.contains(t, F.lit(sign))
        by_text = F.when(hit, name).otherwise(by_text)
    has = lambda *parts: F.exists(F.array(*map(F.lit, parts)), lambda p: F.contains(u, p))
    return (
        F.when(has("/checkpoint/"), "checkpoint")
        .when(has("/login/", "login?next"), "login_wall")
        .when(has("/challenge/", "/security/"), "captcha")
        .when(has("checkpoint?next"), "none")
        .otherwise(by_text)
    )


def media_extension(url: Column, content_type: Column) -> Column:
    """By content type, then by url, else ``.bin``."""
    out = F.lit(".bin")
    for ext in reversed(URL_EXTENSIONS):
        out = F.when(F.contains(F.lower(url), F.lit(ext)), ext).otherwise(out)
    for kind, ext in reversed(CONTENT_TYPES.items()):
        out = F.when(F.contains(content_type, F.lit(kind)), ext).otherwise(out)
    return out


def confident_text(words: Column, at_least: float = 60.0) -> tuple[Column, Column]:
    """From array of text and conf: the confident words joined; mean of the positive confidences, one decimal."""
    kept = F.array_join(F.transform(F.filter(words, lambda w: w["conf"] > at_least), lambda w: w["text"]), " ")
    good = F.filter(words, lambda w: w["conf"] > 0)
    total = F.aggregate(good, F.lit(0.0), lambda a, w: a + w["conf"].cast("double"))
    return kept, F.when(F.size(good) > 0, F.bround(total / F.size(good), 1)).otherwise(0.0)


_URL_SPACE = "6ba7b8119dad11d180b400c04fd430c8"


def uuid5_hex(key: Column) -> Column:
    """Name-based UUID (version 5, URL name space) as 32 hex signs."""
    h = F.sha1(F.concat(F.unhex(F.lit(_URL_SPACE)), F.encode(key, "utf-8")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 2), 16, 10).cast("bigint").bitwiseAND(63).bitwiseOR(128)))
    return F.concat(F.substring(h, 1, 12), F.lit("5"), F.substring(h, 14, 3), variant, F.substring(h, 19, 14))


def short_md5_id(prefix: str, *parts: Column) -> Column:
    return F.concat(F.lit(prefix), F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8))
