"""Dense node numbers and edge lists of each sample, ready for graph learning.

Registrations carry a phase and an order; a node's number is its rank by first registration
inside its sample and type, so no window spans more than one sample."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weft.operators.edges import given
from weft.operators.tree import padded

# Engagement columns in order.
ENGAGEMENT = ("like", "love", "haha", "wow", "sad", "angry", "care", "comment_count", "share_count", "total_reactions")


def _register(df: DataFrame, phase: int, kind: str, node: str, order) -> DataFrame:
    return df.select("post_id", F.lit(kind).alias("kind"), F.col(node).cast("string").alias("node"), F.lit(phase).alias("phase"), order.cast("string").alias("ord"))


def registrations(posts: DataFrame, tree: DataFrame, hashtags: DataFrame, images: DataFrame, user_user: DataFrame, user_post: DataFrame, user_comment: DataFrame, image_edges: DataFrame | None = None) -> DataFrame:
    """All registrations: post, its author, the tree in preorder (comment, then author), tags, images,
    both ends of user edges (the empty id too), then what author edges name, and last the posts and comments
    of ``image_edges`` (post_id, source_id, source_type, image_id, ordinal). The variant without images is the one
    without ``image_edges`` and rows of ``images``."""
    pad = lambda c: padded(F.col(c))
    parts = [
        _register(posts, 0, "post", "post_id", F.lit("")),
        _register(posts.where(given(F.col("author_id"))), 1, "user", "author_id", F.lit("")),
        _register(tree, 2, "comment", "comment_id", F.concat(F.col("path"), F.lit("a"))),
        _register(tree.where(given(F.col("author_id"))), 2, "user", "author_id", F.concat(F.col("path"), F.lit("b"))),
        _register(hashtags, 3, "hashtag", "hashtag", pad("ordinal")),
        _register(images, 4, "image", "image_id", pad("ordinal")),
        _register(user_user, 5, "user", "source", F.concat(pad("ordinal"), F.lit("a"))),
        _register(user_user, 5, "user", "target", F.concat(pad("ordinal"), F.lit("b"))),
        _register(user_post.where(given(F.col("user_id"))), 6, "user", "user_id", pad("ordinal")),
        _register(user_comment.where(given(F.col("user_id")) & given(F.col("comment_id"))), 7, "user", "user_id", pad("ordinal")),
        _register(user_comment.where(given(F.col("user_id")) & given(F.col("comment_id"))), 7, "comment", "comment_id", pad("ordinal")),
    ]
    if image_edges is not None:  # only images that are nodes count
        sure = image_edges.join(images.select("post_id", "image_id").distinct(), ["post_id", "image_id"], "left_semi")
        parts.append(sure.select("post_id", F.col("source_type").alias("kind"), F.col("source_id").cast("string").alias("node"), F.lit(8).alias("phase"), pad("ordinal").alias("ord")))
    return reduce(DataFrame.unionByName, parts)


def typed_links(user_post: DataFrame, user_comment: DataFrame, user_user: DataFrame, comment_reply: DataFrame, hashtags: DataFrame, images: DataFrame) -> DataFrame:
    """post_id, src_kind, src, relation, dst_kind, dst of all edges that a graph takes over.

    Only author edges lead from users to posts, whatever relation an edge to a comment states leads there as ``author``,
    ``in_post`` rows are left out, and the way back from an image has its ends swapped."""
    row = lambda df, sk, s, rel, dk, d: df.select("post_id", sk.alias("src_kind"), s.cast("string").alias("src"), rel.alias("relation"), dk.alias("dst_kind"), d.cast("string").alias("dst"))
    k, c = F.lit, F.col
    to_image = c("direction") == "contains"
    parts = [
        row(user_post.where((c("interaction_type") == "author") & given(c("user_id"))), k("user"), c("user_id"), k("author"), k("post"), c("post_id")),
        row(user_comment.where(given(c("user_id")) & given(c("comment_id"))), k("user"), c("user_id"), k("author"), k("comment"), c("comment_id")),
        row(user_user.where(given(c("source")) & given(c("target"))), k("user"), c("source"), c("relation"), k("user"), c("target")),
        row(comment_reply.where(given(c("comment_id")) & given(c("target_id"))), k("comment"), c("comment_id"), c("direction"), F.when(c("target_type") == "post", "post").otherwise("comment"), c("target_id")),
        row(hashtags.where("direction = 'has_hashtag'"), k("post"), c("post_id"), k("has_hashtag"), k("hashtag"), c("hashtag")),
        row(images, F.when(to_image, c("source_type")).otherwise("image"), F.when(to_image, c("source_id")).otherwise(c("image_id")), c("direction"), F.when(to_image, k("image")).otherwise(c("source_type")), F.when(to_image, c("image_id")).otherwise(c("source_id"))),
    ]
    return reduce(DataFrame.unionByName, parts)


def without_kind(ids: DataFrame, index: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of a graph without one kind of nodes."""
    return ids.where(F.col("kind") != kind), index.where((F.col("src_kind") != kind) & (F.col("dst_kind") != kind))


def containers(ids: DataFrame, index: DataFrame, engagement: DataFrame, size: int = 1) -> DataFrame:
    """post_id, nodes, edges, engagement: one graph a row, placeholder features of ``size`` zeros for every node.

    A graph is one sample's: its nodes meet in one row."""
    one = ids.groupBy("post_id", "kind").agg(F.sort_array(F.collect_list(F.struct("idx", "node"))).alias("n"))
    nodes = one.select("post_id", F.struct("kind", F.col("n.node").alias("node_ids"), F.transform("n", lambda _: F.array_repeat(F.lit(0.0), size)).alias("x")).alias("g"))
    arrays = edge_arrays(index).select("post_id", F.struct("src_kind", "relation", "dst_kind", "src_idx", "dst_idx").alias("e"))
    by_post = lambda df, c: df.groupBy("post_id").agg(F.sort_array(F.collect_list(c)).alias(c))
    return by_post(nodes, "g").join(by_post(arrays, "e"), "post_id", "left").join(engagement, "post_id", "left").withColumnRenamed("g", "nodes").withColumnRenamed("e", "edges")


def passthrough(posts: DataFrame) -> DataFrame:
    """Fields that go along with a graph as they are: text (empty for none), image urls, local images (empty lists for none)."""
    lists = [F.coalesce(F.col(c), F.expr("cast(array() as array<string>)")).alias(c) for c in ("image_urls", "local_images")]
    return posts.select("post_id", F.coalesce("text", F.lit("")).alias("raw_text"), *lists)


def summary(ids: DataFrame, index: DataFrame) -> DataFrame:
    """part (node or edge), type, n over a corpus of graphs."""
    a = ids.groupBy(F.lit("node").alias("part"), F.col("kind").alias("type")).agg(F.count("*").alias("n"))
    b = index.groupBy(F.lit("edge").alias("part"), F.concat_ws("|", "src_kind", "relation", "dst_kind").alias("type")).agg(F.count("*").alias("n"))
    return a.unionByName(b)


def node_ids(registered: DataFrame) -> DataFrame:
    """post_id, kind, node, idx."""
    first = registered.groupBy("post_id", "kind", "node").agg(F.min(F.struct("phase", "ord")).alias("at"))
    return first.withColumn("idx", F.row_number().over(Window.partitionBy("post_id", "kind").orderBy("at")) - 1).drop("at")


def edge_index(ids: DataFrame, edges: DataFrame) -> DataFrame:
    """From post_id, src_kind, src, relation, dst_kind, dst: edges whose both ends have numbers."""
    a = ids.select("post_id", F.col("kind").alias("src_kind"), F.col("node").alias("src"), F.col("idx").alias("src_idx"))
    b = ids.select("post_id", F.col("kind").alias("dst_kind"), F.col("node").alias("dst"), F.col("idx").alias("dst_idx"))
    return edges.join(a, ["post_id", "src_kind", "src"]).join(b, ["post_id", "dst_kind", "dst"]).select("post_id", "src_kind", "relation", "dst_kind", "src_idx", "dst_idx")


def edge_arrays(index: DataFrame) -> DataFrame:
    """Two arrays for each edge type of a sample; types without edges are absent."""
    pairs = F.sort_array(F.collect_list(F.struct("src_idx", "dst_idx")))
    grouped = index.groupBy("post_id", "src_kind", "relation", "dst_kind").agg(pairs.alias("p"))
    return grouped.select("post_id", "src_kind", "relation", "dst_kind", F.col("p.src_idx").alias("src_idx"), F.col("p.dst_idx").alias("dst_idx"))


def num_nodes(ids: DataFrame) -> DataFrame:
    return ids.groupBy("post_id", "kind").agg(F.count("*").alias("num_nodes"))


def engagement_vector(posts: DataFrame) -> DataFrame:
    """Ten counts as floats, null as 0."""
    return posts.select("post_id", F.array(*[F.coalesce(F.col(c), F.lit(0)).cast("float") for c in ENGAGEMENT]).alias("engagement"))
