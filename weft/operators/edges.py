"""Typed edges between users, posts, comments, tags and images."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.functions.text import mentions, short_md5_id, uuid5_hex
from weft.functions.urls import user_id
from weft.operators.vector import rounded

# Weights of interactions.
WEIGHTS = {"author": 10.0, "share": 5.0, "comment": 3.0, "love": 2.0, "care": 2.0, "wow": 1.5, "haha": 1.5, "sad": 1.5, "angry": 1.5, "like": 1.0}


def given(column: Column) -> Column:
    """Neither null nor empty."""
    return F.coalesce(column, F.lit("")) != ""


def weight(kind: Column, explicit: Column) -> Column:
    """An explicit weight other than 1 stays; 1 means the table's, and 1 for unknown kinds."""
    table = F.create_map(*[F.lit(x) for pair in WEIGHTS.items() for x in pair])
    return F.when(explicit == 1.0, F.coalesce(F.try_element_at(table, kind), F.lit(1.0))).otherwise(explicit)


def author_edges(posts: DataFrame) -> DataFrame:
    key = F.concat_ws("|", "author_id", "post_id", F.lit("author"))
    return posts.where(given(F.col("author_id"))).select(uuid5_hex(key).alias("edge_id"), F.col("author_id").alias("user_id"), "post_id", F.lit("author").alias("interaction_type"), weight(F.lit("author"), F.lit(1.0)).alias("weight"))


def interaction_edges(rows: DataFrame) -> DataFrame:
    """From user_id, post_id, interaction_type, weight."""
    return rows.select("user_id", "post_id", "interaction_type", weight(F.col("interaction_type"), F.col("weight")).alias("weight"))


def first_wins(rows: DataFrame, keys: list[str], order: str = "ordinal") -> DataFrame:
    """The row of the smallest ``order`` for each key, with partial aggregation."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(order)).alias("r")).select(*keys, *[F.col(f"r.{c}").alias(c) for c in rest])


def reply_edges(comments: DataFrame) -> DataFrame:
    """post_id, source, target, relation, timestamp, ordinal: replier to the parent's author, first of each pair."""
    parents = comments.groupBy("post_id", F.col("comment_id").alias("parent_id")).agg(F.max_by("author_id", "ordinal").alias("target"))
    both = comments.join(parents, ["post_id", "parent_id"]).where(given(F.col("author_id")) & given(F.col("target")) & (F.col("author_id") != F.col("target")))
    return first_wins(both.select("post_id", F.col("author_id").alias("source"), "target", F.lit("reply").alias("relation"), "timestamp", "ordinal"), ["post_id", "source", "target", "relation"])


def mention_edges(comments: DataFrame, posts: DataFrame) -> DataFrame:
    """Mentions of comments (links: id of the href, else the name), then those of the post's text.

    A post may mention its own author; a comment's author is left out. First of each pair wins."""
    linked = comments.select("post_id", F.col("author_id").alias("source"), "timestamp", "ordinal", F.explode("mentioned_users").alias("m"))
    linked = linked.select("post_id", "source", F.coalesce(user_id(F.col("m.href")), F.col("m.name")).alias("target"), "timestamp", "ordinal").where("source <> target")
    written = posts.select("post_id", F.col("author_id").alias("source"), F.explode(mentions(F.col("raw_text"))).alias("target"), F.lit(None).cast("string").alias("timestamp"), F.lit((1 << 62)).cast("bigint").alias("ordinal"))
    all_ = linked.withColumn("ordinal", F.col("ordinal").cast("bigint")).unionByName(written).where(given(F.col("source")) & given(F.col("target")))
    return first_wins(all_.withColumn("relation", F.lit("mention")), ["post_id", "source", "target", "relation"])


def with_reverse(edges: DataFrame) -> DataFrame:
    """Each edge, and the swapped one under ``<relation>_rev`` with the same timestamp."""
    back = F.struct(F.col("target").alias("source"), F.col("source").alias("target"), F.concat("relation", F.lit("_rev")).alias("relation"))
    there = F.struct("source", "target", "relation")
    return edges.withColumn("e", F.explode(F.array(there, back))).select("post_id", "e.source", "e.target", "e.relation", "timestamp")


def comment_reply_edges(comments: DataFrame) -> DataFrame:
    """Comment to post where it has no parent; else comment to comment and back, even to unknown parents."""
    up = F.struct(F.col("comment_id").alias("comment_id"), F.coalesce("parent_id", "post_id").alias("target_id"), F.when(F.col("parent_id").isNull(), "post").otherwise("comment").alias("target_type"), F.lit("reply_to").alias("direction"))
    down = F.struct(F.col("parent_id").alias("comment_id"), F.col("comment_id").alias("target_id"), F.lit("comment").alias("target_type"), F.lit("reply_to_rev").alias("direction"))
    return comments.select("post_id", F.explode(F.when(F.col("parent_id").isNull(), F.array(up)).otherwise(F.array(up, down))).alias("e")).select("post_id", "e.*")


def image_nodes(content: DataFrame) -> DataFrame:
    """source_id, source_type, image_id, image_url, local_path; urls and paths pair up to the shorter list."""
    n = F.least(F.size("image_urls"), F.size("local_images"))
    pairs = F.arrays_zip(F.slice("image_urls", F.lit(1), n).alias("url"), F.slice("local_images", F.lit(1), n).alias("path"))
    rows = content.where(F.coalesce(n, F.lit(0)) > 0).select("source_id", "source_type", F.posexplode(pairs).alias("k", "p"))
    where = F.coalesce(F.nullif(F.col("p.path"), F.lit("")), F.col("p.url"))
    return rows.select("source_id", "source_type", "k", short_md5_id("img_", F.col("source_id"), where).alias("image_id"), F.col("p.url").alias("image_url"), F.col("p.path").alias("local_path"))


def image_edges(nodes: DataFrame) -> DataFrame:
    return nodes.select("source_id", "image_id", "source_type", F.explode(F.array(F.lit("contains"), F.lit("contained_by"))).alias("direction"))


def hashtag_edges(tags: DataFrame) -> DataFrame:
    """From post_id, hashtags: both directions, each distinct tag once."""
    one = tags.select("post_id", F.explode("hashtags").alias("hashtag")).distinct()
    return one.select("post_id", "hashtag", F.explode(F.array(F.lit("has_hashtag"), F.lit("in_post"))).alias("direction"))


def hashtag_frequency(tags: DataFrame) -> DataFrame:
    return tags.select("post_id", F.explode("hashtags").alias("hashtag")).distinct().groupBy("hashtag").agg(F.count("*").alias("n_posts"))


def user_comment_edges(comments: DataFrame) -> DataFrame:
    return comments.where(given(F.col("author_id"))).select(F.col("author_id").alias("user_id"), "comment_id", F.lit("author").alias("relation_type"))


def commenters(comments: DataFrame) -> DataFrame:
    """One user for each author id, under the first name seen."""
    return comments.where(given(F.col("author_id"))).groupBy("post_id", "author_id").agg(F.min_by("author_name", "ordinal").alias("display_name"))


def neighbours(user_posts: DataFrame, comments: DataFrame) -> DataFrame:
    """Non-author interactions with the first comment of the same user on the post."""
    first = comments.groupBy("post_id", F.col("author_id").alias("user_id")).agg(F.min_by(F.struct("comment_id", "raw_text"), "ordinal").alias("c"))
    return user_posts.where("interaction_type <> 'author'").join(first, ["post_id", "user_id"], "left").select("post_id", "user_id", "interaction_type", "c.comment_id", "c.raw_text")


def parents_by_name(replies: DataFrame) -> DataFrame:
    """From post_id, comment_id, ordinal, author_name, names (array): the first comment by the first
    known name that stands before the reply becomes its parent."""
    holders = replies.groupBy("post_id", F.col("author_name").alias("name")).agg(F.min_by("comment_id", "ordinal").alias("parent_id"), F.min("ordinal").alias("at"))
    asked = replies.select("post_id", "comment_id", "ordinal", F.posexplode("names").alias("k", "name"))
    found = asked.join(holders, ["post_id", "name"]).where("at < ordinal").groupBy("post_id", "comment_id").agg(F.min_by("parent_id", "k").alias("parent_id"))
    return replies.select("post_id", "comment_id", "ordinal").join(found, ["post_id", "comment_id"], "left")


# Fixed value: posts of up to so many tags carry them along in a join; pairs with larger ones are counted one shared tag at a time.
CARRIED = 64


def similar_posts(tags: DataFrame, min_score: float | None = None) -> DataFrame:
    """post_a, post_b, n_shared, score: pairs that share a tag, by Jaccard (4 places, half to even).

    From post_id, tag, distinct. An equi-join on the tag: no pair without a shared tag is ever made. Both posts bring
    their tags, so a pair is counted where it is made, at the least tag it shares, and no pair is shuffled. With
    ``min_score`` only pairs that reach it: two such posts share one of the rarest tags of both, so a post's most
    frequent tags, as many as it can do without, make no pairs, and hot tags drop out of the join."""
    if min_score is not None:
        return _similar_from(tags, min_score)
    sets = tags.where("post_id is not null").groupBy("post_id").agg(F.count("*").alias("size"), F.collect_list("tag").alias("tags"))
    carried = sets.where(F.col("size") <= CARRIED).select("post_id", "size", "tags", F.explode("tags").alias("tag"))
    a, b = [carried.toDF(*[c + end if c != "tag" else c for c in carried.columns]) for end in ("_a", "_b")]
    common = F.array_intersect("tags_a", "tags_b")
    met = a.join(b, "tag").where("post_id_a < post_id_b").withColumn("common", common).where(F.array_min("common") == F.col("tag"))
    near = met.select(F.col("post_id_a").alias("post_a"), F.col("post_id_b").alias("post_b"), F.col("size_a"), F.col("size_b"), F.size("common").cast("long").alias("n_shared"))
    sized = sets.select("post_id", "size", F.explode("tags").alias("tag"))
    large, other = sized.where(F.col("size") > CARRIED).toDF("post_l", "size_l", "tag"), sized.toDF("post_o", "size_o", "tag")
    # two large posts meet both ways round, one of which counts
    ways = large.join(other, "tag").where((F.col("post_l") < F.col("post_o")) | ((F.col("post_l") > F.col("post_o")) & (F.col("size_o") <= CARRIED)))
    far = ways.groupBy("post_l", "post_o", "size_l", "size_o").agg(F.count("*").alias("n_shared"))
    first = F.col("post_l") < F.col("post_o")
    pick = lambda l, o, name: F.when(first, F.col(l)).otherwise(F.col(o)).alias(name)
    far = far.select(pick("post_l", "post_o", "post_a"), pick("post_o", "post_l", "post_b"), pick("size_l", "size_o", "size_a"), pick("size_o", "size_l", "size_b"), "n_shared")
    score = F.col("n_shared") / (F.col("size_a") + F.col("size_b") - F.col("n_shared"))
    return near.unionByName(far).select("post_a", "post_b", "n_shared", F.bround(score, 4).alias("score"))


def _similar_from(tags: DataFrame, min_score: float) -> DataFrame:
    spread = tags.groupBy("tag").agg(F.count("*").alias("df"))
    sets = tags.join(spread, "tag").groupBy("post_id").agg(F.sort_array(F.collect_list(F.struct("df", "tag"))).alias("s")).select("post_id", F.col("s.tag").alias("tags"))
    # a partner shares at least min_score of the tags, so it has one of the others and one more
    prefix = F.slice("tags", F.lit(1), (F.size("tags") - F.ceil(F.size("tags") * F.lit(min_score) - 1e-9) + 1).cast("int"))
    rare = sets.select("post_id", F.explode(prefix).alias("tag"))
    pairs = rare.toDF("post_a", "tag").join(rare.toDF("post_b", "tag"), "tag").where("post_a < post_b").select("post_a", "post_b").distinct()
    both = pairs.join(sets.toDF("post_a", "tags_a"), "post_a").join(sets.toDF("post_b", "tags_b"), "post_b")
    counted = both.withColumn("n_shared", F.size(F.array_intersect("tags_a", "tags_b")).cast("long"))
    score = F.col("n_shared") / (F.size("tags_a") + F.size("tags_b") - F.col("n_shared"))
    return counted.withColumn("score", score).where(F.col("score") >= min_score).select("post_a", "post_b", "n_shared", F.bround("score", 4).alias("score"))


def hashtag_nodes(tags: DataFrame) -> DataFrame:
    """hashtag, frequency, post_ids: one node a tag over all posts, the ids sorted."""
    one = tags.select("post_id", F.explode("hashtags").alias("hashtag")).distinct()
    return one.groupBy("hashtag").agg(F.count("*").alias("frequency"), F.sort_array(F.collect_list("post_id")).alias("post_ids"))


def sample_tags(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """post_id, hashtag: distinct tags of a post and of its comments (hashtags: array in both)."""
    both = posts.select("post_id", F.explode("hashtags").alias("hashtag")).unionByName(comments.select("post_id", F.explode("hashtags").alias("hashtag")))
    return both.distinct()


def author_nodes(posts: DataFrame) -> DataFrame:
    """user_id, display_name of a post's author, if it has one."""
    return posts.where(given(F.col("author_id"))).select("post_id", F.col("author_id").alias("user_id"), F.coalesce("author_name", F.lit("")).alias("display_name"))


# Relations between users that edges may state.
RELATIONS = ("follow", "friend", "mention", "mention_rev", "reply", "reply_rev", "tag", "co_occur", "share_chain", "topic")


def relation_edges(rows: DataFrame) -> DataFrame:
    """From source, target, relation, timestamp: given edges of a known relation with their deterministic ids, each once,
    the first timestamp; ``is_mutual`` where the opposite edge is there too."""
    known = rows.where(F.col("relation").isin(*RELATIONS) & given(F.col("source")) & given(F.col("target")))
    one = known.groupBy("source", "target", "relation").agg(F.min("timestamp").alias("timestamp"))
    # both directions of a pair meet under one key, so that a pair is found without a self-join
    pair = [F.least("source", "target"), F.greatest("source", "target"), F.col("relation")]
    ways = one.groupBy(*[c.alias(n) for c, n in zip(pair, ("a", "b", "relation"))]).agg(F.collect_list(F.struct("source", "target", "timestamp")).alias("ways"))
    out = ways.select("relation", (F.size("ways") > 1).alias("is_mutual"), F.inline("ways"))
    return out.select(uuid5_hex(F.concat_ws("|", "source", "target", "relation")).alias("edge_id"), "source", "target", "relation", "is_mutual", "timestamp")


def time_decay(rows: DataFrame, tau_seconds: float) -> DataFrame:
    """From key, user, ts: weight of consecutive interactions, exp(-dt / tau).

    A key's rows are dealt into hours; the first row of an hour takes its predecessor from the table of hours."""
    from pyspark.sql import Window

    at = F.unix_micros("ts")
    dealt = rows.withColumn("__hour", F.floor(at / 3_600_000_000))
    inside = Window.partitionBy("key", "__hour").orderBy("ts", "user")
    last = dealt.groupBy("key", "__hour").agg(F.max("ts").alias("__last"))
    before = last.select("key", "__hour", F.lag("__last").over(Window.partitionBy("key").orderBy("__hour")).alias("__before"))
    both = dealt.withColumn("__own", F.lag("ts").over(inside)).join(before, ["key", "__hour"])
    dt = (at - F.unix_micros(F.coalesce("__own", "__before"))) / 1e6
    return both.withColumn("weight", rounded(F.exp(-dt / tau_seconds), 6)).drop("__hour", "__own", "__before")
