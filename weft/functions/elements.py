"""Elements of captured pages: comments, posts and profiles as rows.

Captured HTML isn't XML, so the standard parser walks it once for each page in Arrow batches.
The walk gives plain fields; every rule about them stays in column expressions."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from weft.functions.text import clean_text, comment_id, epoch_iso, follower_count, hashtags, heading_author, is_comment_noise, like_label, mentions, parent_names, strip
from weft.functions.urls import SITE, absolute_href, author_slug, first_match, user_id

_FIELDS = ("label", "author_name", "author_href", "text", "like_label", "numeric_id")
ELEMENT = StructType([StructField("ordinal", LongType()), *[StructField(f, StringType()) for f in _FIELDS], StructField("images", ArrayType(StringType())), StructField("links", ArrayType(StructType([StructField("name", StringType()), StructField("href", StringType())])))])


class _Articles(HTMLParser):
    """Each element of role ``article``: label, first link as author, texts of ``dir=auto``, images, links."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.done, self.open, self.depth, self.link, self.texts = [], [], 0, None, 0

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        void = tag in ("img", "br", "meta", "input", "link", "hr")
        if not void:
            self.depth += 1
        if a.get("role") == "article":
            self.open.append((self.depth, {"label": a.get("aria-label") or "", "text": [], "images": [], "links": [], "like_label": "", "numeric_id": a.get("data-id") or ""}))
        if not self.open:
            return
        item = self.open[-1][1]
        if tag == "a":
            self.link = {"href": a.get("href") or "", "name": ""}
            item["links"].append(self.link)
            if not item["numeric_id"] and "comment_id=" in self.link["href"]:
                item["numeric_id"] = "".join(c for c in self.link["href"].split("comment_id=")[1].split("&")[0] if c.isdigit())
        elif tag == "img":
            if a.get("alt") and self.texts:
                item["text"].append(a["alt"])
            elif a.get("src"):
                item["images"].append(a["src"])
        if a.get("dir") == "auto":
            self.texts = self.texts or self.depth
        label = a.get("aria-label") or ""
        if "reaction" in label or "cảm xúc" in label:
            item["like_label"] = label

    def handle_endtag(self, tag):
        if tag == "a":
            self.link = None
        if self.texts and self.depth <= self.texts:
            self.texts = 0
        if self.open and self.depth <= self.open[-1][0]:
            self.done.append(self.open.pop()[1])
        self.depth = max(0, self.depth - 1)

    def handle_data(self, data):
        if self.link is not None:
            self.link["name"] += data
        elif self.open and self.texts:
            self.open[-1][1]["text"].append(data)

    def rows(self) -> list[dict]:
        out = []
        for k, item in enumerate([*self.done, *(x for _, x in self.open)]):
            author = item["links"][0] if item["links"] else {"name": "", "href": ""}
            out.append({**item, "ordinal": k, "text": "".join(item["text"]).strip(), "author_name": author["name"].strip(), "author_href": author["href"], "links": item["links"][1:]})
        return out


@F.pandas_udf(ArrayType(ELEMENT))
def articles(html: pd.Series) -> pd.Series:
    def walk(page: str) -> list[dict]:
        parser = _Articles()
        parser.feed(page)
        parser.close()
        return parser.rows()

    return html.map(walk, na_action="ignore")


def comment_rows(pages: DataFrame, post_id: str, html: str, site: str = SITE) -> DataFrame:
    """Comments of captured pages: ids, author, texts, tags, likes; noise and empty ones left out.

    ``names`` are the names of possible parents, for :func:`weft.operators.edges.parents_by_name`."""
    e = pages.select(F.col(post_id).alias("post_id"), F.explode(articles(F.col(html))).alias("e")).select("post_id", "e.*")
    kept = e.where((F.col("text") != "") | (F.size("links") > 0)).where(~is_comment_noise(F.col("author_name"), F.col("text"), F.col("author_href"), site))
    return kept.select(
        "post_id",
        comment_id(F.col("numeric_id"), F.col("label"), F.col("author_href"), F.col("text")).alias("comment_id"),
        user_id(F.col("author_href"), site).alias("author_id"),
        "author_name",
        F.col("text").alias("raw_text"),
        clean_text(F.col("text")).alias("cleaned_text"),
        hashtags(F.col("text")).alias("hashtags"),
        mentions(F.col("text")).alias("mentions"),
        F.col("links").alias("mentioned_users"),
        F.col("images").alias("image_urls"),
        like_label(F.col("like_label")).alias("like_count"),
        parent_names(F.col("label")).alias("names"),
        "ordinal",
    )


def meta(html: Column, name: str) -> Column:
    """Content of a meta element by property or name."""
    pattern = rf'<meta[^>]*(?:property|name)="{name}"[^>]*content="([^"]*)"'
    return F.when(html.rlike(pattern), F.regexp_extract(html, pattern, 1))


def author_by_slug(links: Column, url: Column) -> Column:
    """Struct of user_id and name: the first link (array of name and href) that leads to the owner of a post's path
    and to nothing below, with a name of at least two signs that doesn't start with a digit."""
    slug = F.lower(author_slug(url))
    path = lambda href: F.lower(first_match(href, "^[a-zA-Z]+://[^/?#]*/+([^/?#]+)/*(?:[?#]|$)"))
    name = lambda x: F.trim(F.regexp_replace(x["name"], r"(?U)\s+", " "))
    good = F.filter(links, lambda x: (path(x["href"]) == slug) & (F.length(name(x)) >= 2) & ~name(x).rlike("^[0-9]"))
    first = F.get(good, F.lit(0))
    return F.when(first.isNotNull(), F.struct(user_id(first["href"]).alias("user_id"), name(first).alias("name")))


def author(links: Column, url: Column, heading: Column) -> Column:
    """Struct of user_id and name: the first link with a name, else the owner of the path, else the heading's name."""
    named = F.get(F.filter(links, lambda x: F.coalesce(strip(x["name"]), F.lit("")) != ""), F.lit(0))
    direct = F.when(named.isNotNull(), F.struct(user_id(absolute_href(named["href"])).alias("user_id"), strip(named["name"]).alias("name")))
    said = heading_author(heading)
    by_heading = F.when(said.isNotNull(), F.struct(F.lit(None).cast("string").alias("user_id"), said.alias("name")))
    return F.coalesce(direct, author_by_slug(links, url), by_heading)


def timestamp(utime: Column, label: Column) -> Column:
    """ISO time of an epoch attribute, else the label that says how long ago."""
    return F.coalesce(epoch_iso(utime.try_cast("bigint")), F.nullif(label, F.lit("")))


def profile(html: Column, url: Column) -> Column:
    """Struct of user_id (``unknown`` without one), display_name (more than one sign), bio (cleaned), image, flags,
    counts (null unless positive) and location of a profile page."""
    name = strip(meta(html, "og:title"))
    counted = lambda word: follower_count(first_match(html, rf"(?iu)([0-9][0-9,.]*[kKmM]?)\s+{word}"))
    return F.struct(
        F.coalesce(user_id(url), F.lit("unknown")).alias("user_id"),
        F.when(F.length(name) > 1, name).alias("display_name"),
        clean_text(meta(html, "og:description")).alias("bio"),
        meta(html, "og:image").alias("profile_image_url"),
        F.coalesce(counted("followers"), counted("người theo dõi")).alias("follower_count"),
        counted("friends").alias("friend_count"),
        html.rlike('aria-label="[^"]*[vV]erified').alias("is_verified"),
        (F.contains(url, F.lit("pages")) | F.contains(html, F.lit("page-info-section"))).alias("is_page"),
        first_match(html, "(?:Lives in|Sống tại)\\s+([^<]+)").alias("location"),
    )
