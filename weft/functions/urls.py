"""URL functions as column expressions; null stays null unless stated."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The site whose profile links carry a slug, its query keys and reserved slugs, id patterns in order.
SITE = "facebook.com"
KEPT_KEYS = ("id", "story_fbid", "v", "fbid")
RESERVED_SLUGS = ("pages", "groups", "events", "marketplace", "watch")
POST_ID_PATTERNS = (
    r"/posts/([0-9]+)",
    r"/permalink/([0-9]+)",
    r"story_fbid=([0-9]+)",
    r"/p/([A-Za-z0-9_-]+)",
    r"/reel/([0-9]+)",
    r"[?&]v=([0-9]+)",
    r"(pfbid[A-Za-z0-9]+)",
    r"[?&]fbid=([0-9]+)",
    r"/photo/([0-9]+)",
)
POST_URL = (
    r"[^/]+/posts/(?:pfbid[A-Za-z0-9]+|[0-9]+)"
    r"|permalink\.php\?story_fbid=[0-9]+"
    r"|[^/]+/permalink/[0-9]+"
    r"|[^/]+/photos/(?:pfbid[A-Za-z0-9]+|[0-9]+)"
)


def first_match(text: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, null without one."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def _decoded(part: Column) -> Column:
    """Form decoding; a percent sign without two hex digits behind it stands for itself."""
    return F.try_url_decode(F.regexp_replace(part, "%(?![0-9A-Fa-f]{2})", "%25"))


def _encoded(part: Column) -> Column:
    """Form encoding that leaves letters, digits, ``_``, ``.``, ``-`` and ``~`` as they are."""
    return F.replace(F.replace(F.url_encode(part), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def normalize_url(url: Column, keys: tuple[str, ...] = KEPT_KEYS) -> Column:
    """Without fragment and without query parameters other than ``keys``; blank values go.

    Parameters stay in the order of their first appearance, repeated ones side by side, in one encoding;
    the scheme is in lower case, tabs and line ends go."""
    clean = F.regexp_replace(F.regexp_replace(url, "[\t\r\n]", ""), "^[\\x00-\\x20]+", "")
    plain = F.substring_index(clean, "#", 1)
    base, query = F.substring_index(plain, "?", 1), F.when(F.contains(plain, F.lit("?")), F.substring(plain, F.instr(plain, "?") + 1, F.length(plain))).otherwise("")
    name = lambda p: F.substring_index(p, "=", 1)
    value = lambda p: F.substr(p, F.length(name(p)) + 2)
    given = F.transform(F.filter(F.split(query, "&"), lambda p: value(p) != ""), lambda p: F.struct(_decoded(name(p)).alias("k"), _decoded(value(p)).alias("v")))
    kept = F.filter(given, lambda p: p["k"].isin(*keys))
    grouped = F.flatten(F.transform(F.array_distinct(F.transform(kept, lambda p: p["k"])), lambda k: F.filter(kept, lambda p: p["k"] == k)))
    shown = F.array_join(F.transform(grouped, lambda p: F.concat(p["k"], F.lit("="), _encoded(p["v"]))), "&")
    scheme = F.regexp_extract(base, "^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1)
    lower = F.concat(F.lower(scheme), F.substr(base, F.length(scheme) + 1))
    return F.concat(lower, F.when(F.size(kept) > 0, F.concat(F.lit("?"), shown)).otherwise(""))


def post_id(url: Column) -> Column:
    """First match of the ordered patterns."""
    return F.coalesce(*[first_match(url, p) for p in POST_ID_PATTERNS])


def user_id(url: Column, site: str = SITE) -> Column:
    """Numeric id parameter, else the profile slug unless reserved."""
    slug = first_match(url, rf"^https?://(?:www\.)?{site.replace('.', '[.]')}/([^/?#]+)")
    return F.coalesce(first_match(url, r"[?&]id=([0-9]+)"), F.when(~slug.isin(*RESERVED_SLUGS), slug))


def is_post_url(url: Column, site: str = SITE) -> Column:
    return url.rlike(rf"{site.replace('.', '[.]')}/(?:{POST_URL})")


def drop_query(url: Column) -> Column:
    return F.substring_index(url, "?", 1)


def canonical_permalink(url: Column, site: str = SITE) -> Column:
    """A story link rebuilt from its two ids; any other link without its query."""
    story, owner = first_match(url, r"[?&]story_fbid=([^&#]+)"), first_match(url, r"[?&]id=([^&#]+)")
    built = F.concat(F.lit(f"https://www.{site}/permalink.php?story_fbid="), story, F.coalesce(F.concat(F.lit("&id="), owner), F.lit("")))
    return F.coalesce(built, drop_query(url))


def page_slug(url: Column) -> Column:
    """First segment of the path."""
    return F.coalesce(first_match(url, r"^[a-zA-Z]+://[^/?#]*/+([^/?#]+)"), F.lit(""))


def last_segment(url: Column) -> Column:
    return F.element_at(F.split(F.rtrim(url, F.lit("/")), "/"), -1)


def absolute_href(href: Column, site: str = SITE) -> Column:
    return F.when(href.startswith("/"), F.concat(F.lit(f"https://www.{site}"), href)).otherwise(href)


def is_photo_url(url: Column) -> Column:
    return (F.contains(url, F.lit("/photo/")) | F.contains(url, F.lit("fbid="))) & ~F.contains(url, F.lit("/posts/"))


def feed_link(href: Column, slug: Column) -> Column:
    """Links of a feed that lead to posts of ``slug``, or by id anywhere; no reels, videos or groups."""
    low, name = F.lower(href), F.lower(slug)
    own = [F.contains(low, F.concat(F.lit("/"), name, F.lit(f"/{k}/"))) for k in ("posts", "permalink", "photos")]
    by_id = F.contains(href, F.lit("story_fbid=")) | F.contains(href, F.lit("pfbid"))
    wanted = F.when(name != "", own[0] | own[1] | own[2] | by_id).otherwise(F.contains(href, F.lit("/posts/")) | by_id)
    return wanted & ~href.rlike("/reel/|/videos/|/groups/")


def links_or_photos(posts: Column, photos: Column) -> Column:
    """Photo links join in where there are fewer than three post links."""
    return F.when(F.size(posts) < 3, F.array_union(posts, photos)).otherwise(posts)


def author_slug(url: Column) -> Column:
    """Owner's slug of a post, permalink, photo or video path."""
    return first_match(url, r"^[a-zA-Z]+://[^/?#]*/([^/?#]+)/(?:posts|permalink|photos|videos)(?:[/?#]|$)")


def rest_base(url: Column) -> Column:
    bare = F.rtrim(url, F.lit("/"))
    return F.when(bare.endswith("/rest/v1"), bare).otherwise(F.concat(bare, F.lit("/rest/v1")))


def local_media_path(path: Column, root: str) -> Column:
    """The part behind ``data/media/`` below another root; other paths stay."""
    return F.when(F.contains(path, F.lit("data/media/")), F.concat(F.lit(root.rstrip("/") + "/"), F.substring_index(path, "data/media/", -1))).otherwise(path)
