"""Functions over lists of links, tags and images."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weft.functions.text import strip
from weft.functions.urls import SITE, is_photo_url, user_id


def unique_links(hrefs: Column, reserved: tuple[str, ...], most: int = 30) -> Column:
    """Profile ids of the first ``most`` links, without reserved slugs, distinct in order."""
    ids = F.filter(F.transform(F.slice(hrefs, F.lit(1), F.lit(most)), lambda x: user_id(x)), lambda x: x.isNotNull() & ~x.isin(*reserved))
    return F.array_distinct(ids)


def first_non_empty(*lists: Column) -> Column:
    """The first list that has anything."""
    return F.coalesce(*[F.when(F.size(x) > 0, x) for x in lists], lists[-1])


def mention_links(links: Column, own_href: Column, site: str = SITE) -> Column:
    """From array of name and href: profile links, not the author's own, one for each href."""
    ok = F.filter(links, lambda x: F.contains(x["href"], F.lit(site + "/")) & (x["href"] != F.coalesce(own_href, F.lit(""))))
    hrefs = F.array_distinct(F.transform(ok, lambda x: x["href"]))
    return F.transform(hrefs, lambda h: F.get(F.filter(ok, lambda x: x["href"] == h), F.lit(0)))


def with_tag(tags: Column, tag: Column) -> Column:
    """The tag at the end unless it is there."""
    return F.when(F.array_contains(tags, tag), tags).otherwise(F.array_append(tags, tag))


def source_tag(kind: str, name: Column) -> Column:
    """Where a row came from: ``search:q``, ``hashtag:#t`` or the name itself."""
    prefix = {"search": "search:", "hashtag": "hashtag:#"}.get(kind, "")
    return F.concat(F.lit(prefix), name)


def has_media(urls: Column, mark: str = "scontent") -> Column:
    return F.exists(urls, lambda x: F.contains(x, F.lit(mark)))


def is_empty_post(text: Column, images: Column) -> Column:
    return (F.coalesce(strip(text), F.lit("")) == "") & (F.coalesce(F.size(images), F.lit(0)) <= 0)


def legacy_images(post_id: Column, local_images: Column, image_nodes: Column) -> Column:
    """Image nodes of old documents, made from their local images; newer ones keep theirs."""
    made = F.transform(local_images, lambda path, k: F.struct(F.concat(post_id, F.lit("_img_"), F.lpad(k.cast("string"), 3, "0")).alias("image_id"), path.alias("local_path"), F.lit(None).cast("string").alias("image_url"), F.lit("post").alias("source_type"), post_id.alias("source_id")))
    return F.when(F.coalesce(F.size(image_nodes), F.lit(0)) > 0, image_nodes).otherwise(F.coalesce(made, F.expr("cast(array() as array<struct<image_id:string,local_path:string,image_url:string,source_type:string,source_id:string>>)")))


def user_flags(index: Column, has_author: Column, size: int = 3) -> Column:
    """Zeros, with 1 in front for the post's author (index 0, if there is one)."""
    return F.concat(F.array(F.when((index == 0) & has_author, 1.0).otherwise(0.0)), F.array_repeat(F.lit(0.0), size - 1))


def text_or(text: Column, placeholder: str) -> Column:
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(placeholder))


def total_reactions(*counts: Column) -> Column:
    out = F.lit(0)
    for c in counts:
        out = out + F.coalesce(c, F.lit(0))
    return out


def post_type(url: Column) -> Column:
    """``photo`` for links of single photos, else ``post``."""
    return F.when(F.coalesce(is_photo_url(url), F.lit(False)), "photo").otherwise("post")
