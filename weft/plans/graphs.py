"""Queries of typed graphs: dense numbers, edge lists, whole documents, corpus summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft.functions import lists
from weft.functions.text import short_md5_id
from weft.operators import document, edges, hetero, stats, tree, vector
from weft.plans.catalog import query
from weft.plans.registry import UUID_SQL, nested_sql
from weft.plans.standins import COMMENTS_SQL, INTERACTION_SQL, RICH_SQL, TREE_SQL, comments, interactions, posts, table

# One sample for each conversation: its turns are comments; tags and images follow from the turns.


def _tags(rows):
    """post_id, hashtag, ordinal: distinct tags in order."""
    one = rows.select("post_id", F.explode(F.array(F.element_at(F.split("author_id", "_"), 1), F.concat(F.lit("t"), F.expr("ordinal % 4")))).alias("hashtag")).distinct()
    from pyspark.sql import Window

    return one.withColumn("ordinal", F.row_number().over(Window.partitionBy("post_id").orderBy("hashtag")) - 1)


def _images(rows):
    """Image nodes of even turns and a cover of the post, with their order."""
    own = rows.where("ordinal % 2 = 0").select("post_id", F.col("comment_id").alias("source_id"), F.lit("comment").alias("source_type"), F.concat(F.lit("u"), "ordinal").alias("url"), (F.col("ordinal") + 1).alias("ordinal"))
    cover = rows.where("ordinal = 0").select("post_id", F.col("post_id").alias("source_id"), F.lit("post").alias("source_type"), F.lit("cover").alias("url"), F.lit(0).cast("long").alias("ordinal"))
    both = own.unionByName(cover)
    return both.select("post_id", short_md5_id("img_", F.col("source_id"), F.col("url")).alias("image_id"), "source_id", "source_type", "ordinal")


def _image_edges(nodes):
    return nodes.withColumn("direction", F.explode(F.array(F.lit("contains"), F.lit("contained_by"))))


def _graph(spark, sf_dir, with_images: bool = True):
    """ids and edge index of all samples."""
    rows = comments(spark, sf_dir)
    first = rows.where("ordinal = 0").select("post_id", "author_id")
    walked = tree.walk(rows).join(rows.select("post_id", "comment_id", "author_id"), ["post_id", "comment_id"])
    tags, images = _tags(rows), _images(rows)
    images = images if with_images else images.limit(0)
    user_user = edges.reply_edges(rows)
    user_post = first.select("post_id", F.col("author_id").alias("user_id"), F.lit("author").alias("interaction_type"), F.lit(0).alias("ordinal"))
    liked = rows.select("post_id", F.col("author_id").alias("user_id"), F.lit("like").alias("interaction_type"))
    user_comment = rows.select("post_id", F.col("author_id").alias("user_id"), "comment_id", "ordinal")
    image_edges = _image_edges(images)
    ids = hetero.node_ids(hetero.registrations(first, walked, tags, images, user_user, user_post, user_comment, image_edges))
    both_ways = edges.with_reverse(user_user)
    tag_edges = edges.hashtag_edges(tags.groupBy("post_id").agg(F.collect_set("hashtag").alias("hashtags")))
    links = hetero.typed_links(user_post.drop("ordinal").unionByName(liked), user_comment, both_ways, edges.comment_reply_edges(rows), tag_edges, image_edges)
    return ids, hetero.edge_index(ids, links)


IDS_SQL = (
    TREE_SQL
    + """, tags AS (SELECT DISTINCT post_id, unnest([split_part(author_id, '_', 1), 't' || (ordinal % 4)]) AS hashtag FROM comments),
 images AS (SELECT post_id, 'img_' || md5(source_id || '|' || url)[:8] AS image_id, source_id, source_type, o FROM (SELECT post_id, comment_id AS source_id, 'comment' AS source_type, 'u' || ordinal AS url, ordinal + 1 AS o FROM comments WHERE ordinal % 2 = 0
  UNION ALL SELECT post_id, post_id, 'post', 'cover', 0 FROM comments WHERE ordinal = 0)),
 reg AS (SELECT post_id, 'comment' AS kind, comment_id AS node, path || 'a' AS o FROM tree UNION ALL SELECT post_id, 'user', author_id, path || 'b' FROM tree
 UNION ALL SELECT post_id, 'user', author_id, '' FROM comments WHERE ordinal = 0 UNION ALL SELECT DISTINCT post_id, 'post', post_id, '' FROM comments WHERE ordinal = 0
 UNION ALL SELECT post_id, 'hashtag', hashtag, hashtag FROM tags UNION ALL SELECT post_id, 'image', image_id, lpad(o::VARCHAR, 10, '0') FROM images),
 ids AS (SELECT post_id, kind, node, row_number() OVER (PARTITION BY post_id, kind ORDER BY min(o)) - 1 AS idx FROM reg GROUP BY 1, 2, 3),
 replies AS (SELECT DISTINCT c.post_id, c.author_id AS s, p.author_id AS t FROM comments c JOIN comments p ON c.post_id = p.post_id AND c.parent_id = p.comment_id WHERE c.author_id <> p.author_id),
 e AS (SELECT post_id, 'comment' AS sk, comment_id AS s, 'reply_to' AS rel, CASE WHEN parent_id IS NULL THEN 'post' ELSE 'comment' END AS dk, coalesce(parent_id, post_id) AS d FROM comments
 UNION ALL SELECT post_id, 'comment', parent_id, 'reply_to_rev', 'comment', comment_id FROM comments WHERE parent_id IS NOT NULL
 UNION ALL SELECT post_id, 'user', author_id, 'author', 'post', post_id FROM comments WHERE ordinal = 0 UNION ALL SELECT post_id, 'user', author_id, 'author', 'comment', comment_id FROM comments
 UNION ALL SELECT post_id, 'user', s, 'reply', 'user', t FROM replies UNION ALL SELECT post_id, 'user', t, 'reply_rev', 'user', s FROM replies
 UNION ALL SELECT post_id, 'post', post_id, 'has_hashtag', 'hashtag', hashtag FROM tags
 UNION ALL SELECT post_id, source_type, source_id, 'contains', 'image', image_id FROM images UNION ALL SELECT post_id, 'image', image_id, 'contained_by', source_type, source_id FROM images),
 idx AS (SELECT e.post_id, sk AS src_kind, rel AS relation, dk AS dst_kind, a.idx AS src_idx, b.idx AS dst_idx FROM e JOIN ids a ON a.post_id = e.post_id AND a.kind = sk AND a.node = s JOIN ids b ON b.post_id = e.post_id AND b.kind = dk AND b.node = d)"""
)


@query("h_node_ids", IDS_SQL + " SELECT * FROM ids")
def h_node_ids(spark, sf_dir):
    return _graph(spark, sf_dir)[0].withColumn("idx", F.col("idx").cast("long"))


@query("h_num_nodes", IDS_SQL + " SELECT post_id, kind, count(*) AS num_nodes FROM ids GROUP BY 1, 2")
def h_num_nodes(spark, sf_dir):
    return hetero.num_nodes(_graph(spark, sf_dir)[0])


@query("h_edge_index", IDS_SQL + " SELECT * FROM idx")
def h_edge_index(spark, sf_dir):
    out = _graph(spark, sf_dir)[1]
    return out.withColumn("src_idx", F.col("src_idx").cast("long")).withColumn("dst_idx", F.col("dst_idx").cast("long"))


@query("h_edge_arrays", IDS_SQL + " SELECT post_id, src_kind, relation, dst_kind, list(src_idx ORDER BY src_idx, dst_idx) AS src_idx, list(dst_idx ORDER BY src_idx, dst_idx) AS dst_idx FROM idx GROUP BY 1, 2, 3, 4")
def h_edge_arrays(spark, sf_dir):
    out = hetero.edge_arrays(_graph(spark, sf_dir)[1])
    return out.withColumn("src_idx", F.col("src_idx").cast("array<bigint>")).withColumn("dst_idx", F.col("dst_idx").cast("array<bigint>"))


@query("h_without_images", IDS_SQL + " SELECT 'node' AS part, kind AS type, count(*) AS n FROM ids WHERE kind <> 'image' GROUP BY 2 UNION ALL SELECT 'edge', src_kind || '|' || relation || '|' || dst_kind, count(*) FROM idx WHERE src_kind <> 'image' AND dst_kind <> 'image' GROUP BY 2")
def h_without_images(spark, sf_dir):
    return hetero.summary(*_graph(spark, sf_dir, with_images=False))


@query("h_summary", IDS_SQL + " SELECT 'node' AS part, kind AS type, count(*) AS n FROM ids GROUP BY 2 UNION ALL SELECT 'edge', src_kind || '|' || relation || '|' || dst_kind, count(*) FROM idx GROUP BY 2")
def h_summary(spark, sf_dir):
    return hetero.summary(*_graph(spark, sf_dir))


@query("h_containers", IDS_SQL + """, g AS (SELECT post_id, count(DISTINCT kind) AS n_kinds, count(*) AS n_nodes, list(DISTINCT kind ORDER BY kind) AS kinds FROM ids GROUP BY 1), x AS (SELECT post_id, count(DISTINCT src_kind || relation || dst_kind) AS n_types, count(*) AS n_edges FROM idx GROUP BY 1)
SELECT post_id, n_kinds, kinds, n_nodes, 3 * n_nodes AS n_features, 0.0::DOUBLE AS features, n_types, n_edges, n_nodes::DOUBLE AS total_reactions FROM g JOIN x USING (post_id)""")  # fmt: skip
def h_containers(spark, sf_dir):
    ids, index = _graph(spark, sf_dir)
    counts = ids.groupBy("post_id").agg(F.count("*").alias("total_reactions")).select("post_id", *[F.lit(None).cast("long").alias(c) for c in hetero.ENGAGEMENT[:-1]], "total_reactions")
    out = hetero.containers(ids, index, hetero.engagement_vector(counts), 3)
    x = F.flatten(F.flatten(F.col("nodes.x")))
    return out.select(
        "post_id", F.size("nodes").cast("long").alias("n_kinds"), F.col("nodes.kind").alias("kinds"), F.size(F.flatten(F.col("nodes.node_ids"))).cast("long").alias("n_nodes"), F.size(x).cast("long").alias("n_features"),
        F.aggregate(x, F.lit(0.0), lambda a, v: a + v).alias("features"), F.size("edges").cast("long").alias("n_types"), F.size(F.flatten(F.col("edges.src_idx"))).cast("long").alias("n_edges"), F.col("engagement")[9].cast("double").alias("total_reactions"),
    )


@query("h_engagement", "SELECT page_id, [length(html) % 7, 0, 1, 1, 1, 1, 1, 1, 1, page_id % 3]::FLOAT[] AS engagement FROM pages")
def h_engagement(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select(F.col("page_id").alias("post_id"), (F.length("html") % 7).alias("like"), F.lit(None).cast("long").alias("love"), *[F.lit(1).alias(c) for c in hetero.ENGAGEMENT[2:-1]], (F.col("page_id") % 3).alias("total_reactions"))
    return hetero.engagement_vector(rows).select(F.col("post_id").alias("page_id"), "engagement")


@query("h_passthrough", "SELECT doc_id AS post_id, coalesce(text, '') AS raw_text, CASE WHEN doc_id % 3 = 0 THEN []::VARCHAR[] ELSE ['u' || doc_id] END AS image_urls, []::VARCHAR[] AS local_images FROM documents")
def h_passthrough(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("post_id"), "text", F.when(F.col("doc_id") % 3 != 0, F.array(F.concat(F.lit("u"), "doc_id"))).alias("image_urls"), F.lit(None).cast("array<string>").alias("local_images"))
    return hetero.passthrough(d)


@query("a_edge_summary", IDS_SQL + ", c AS (SELECT post_id, relation, count(*) AS n FROM idx GROUP BY 1, 2) SELECT * FROM c UNION ALL SELECT post_id, 'TOTAL', sum(n)::BIGINT FROM c GROUP BY 1")
def a_edge_summary(spark, sf_dir):
    return stats.edge_summary(_graph(spark, sf_dir)[1], "post_id", "relation")


@query("a_types", IDS_SQL + " SELECT DISTINCT 'node' AS part, kind AS type FROM ids UNION SELECT DISTINCT 'edge', src_kind || '|' || relation || '|' || dst_kind FROM idx")
def a_types(spark, sf_dir):
    return stats.distinct_types(*_graph(spark, sf_dir))


@query("v_drop_hashtags", IDS_SQL + " SELECT 'node' AS part, kind AS type, count(*) AS n FROM ids WHERE kind <> 'hashtag' GROUP BY 2 UNION ALL SELECT 'edge', src_kind || '|' || relation || '|' || dst_kind, count(*) FROM idx WHERE dst_kind <> 'hashtag' GROUP BY 2")
def v_drop_hashtags(spark, sf_dir):
    return hetero.summary(*hetero.without_kind(*_graph(spark, sf_dir), "hashtag"))


@query("v_user_flags", IDS_SQL + " SELECT post_id, node, [CASE WHEN idx = 0 THEN 1.0 ELSE 0.0 END, 0.0, 0.0]::DOUBLE[] AS flags FROM ids WHERE kind = 'user'")
def v_user_flags(spark, sf_dir):
    ids = _graph(spark, sf_dir)[0].where("kind = 'user'")
    return ids.select("post_id", "node", lists.user_flags(F.col("idx"), F.lit(True)).alias("flags"))


# Nodes and edges over a corpus.
TAGS_SQL = f"WITH t AS (SELECT DISTINCT doc_id::VARCHAR AS post_id, unnest(regexp_extract_all({RICH_SQL}, '#([\\p{{L}}\\p{{N}}_]+)', 1)) AS hashtag FROM documents)"


def _post_tags(spark, sf_dir):
    from weft.functions import text

    return posts(spark, sf_dir).select("post_id", text.hashtags(F.col("raw_text")).alias("hashtags"))


@query("e_hashtag_nodes", TAGS_SQL + " SELECT hashtag, count(*) AS frequency, list(post_id ORDER BY post_id) AS post_ids FROM t GROUP BY 1")
def e_hashtag_nodes(spark, sf_dir):
    return edges.hashtag_nodes(_post_tags(spark, sf_dir))


@query("e_sample_tags", f"WITH {COMMENTS_SQL} SELECT DISTINCT post_id, unnest([author_id, 'p' || (ordinal % 2)]) AS hashtag FROM comments UNION SELECT DISTINCT post_id, 'whole' FROM comments")
def e_sample_tags(spark, sf_dir):
    rows = comments(spark, sf_dir)
    return edges.sample_tags(rows.select("post_id", F.array(F.lit("whole")).alias("hashtags")), rows.select("post_id", F.array("author_id", F.concat(F.lit("p"), F.expr("ordinal % 2"))).alias("hashtags")))


@query(
    "e_post_post_from",
    """WITH t AS (SELECT DISTINCT event_id % 400 AS p, user_id % 60 AS tag FROM events), s AS (SELECT p, count(*) AS n FROM t GROUP BY 1),
x AS (SELECT a.p AS post_a, b.p AS post_b, count(*) AS n FROM t a JOIN t b ON a.tag = b.tag AND a.p < b.p GROUP BY 1, 2)
SELECT post_a, post_b, x.n AS n_shared, round_even(x.n::DOUBLE / (sa.n + sb.n - x.n), 4) AS score FROM x JOIN s sa ON sa.p = post_a JOIN s sb ON sb.p = post_b WHERE x.n::DOUBLE / (sa.n + sb.n - x.n) >= 0.4""",
)
def e_post_post_from(spark, sf_dir):
    tags = table(spark, sf_dir, "events").select((F.col("event_id") % 400).alias("post_id"), (F.col("user_id") % 60).alias("tag")).distinct()
    return edges.similar_posts(tags, 0.4)


@query("e_user_comment", f"WITH {COMMENTS_SQL} SELECT author_id AS user_id, comment_id, 'author' AS relation_type FROM comments WHERE ordinal % 5 <> 4")
def e_user_comment(spark, sf_dir):
    return edges.user_comment_edges(comments(spark, sf_dir).withColumn("author_id", F.when(F.col("ordinal") % 5 != 4, F.col("author_id"))))


@query("e_author_node", "SELECT doc_id::VARCHAR AS post_id, source AS user_id, CASE WHEN doc_id % 2 = 0 THEN upper(source) ELSE '' END AS display_name FROM documents WHERE coalesce(source, '') <> ''")
def e_author_node(spark, sf_dir):
    return edges.author_nodes(posts(spark, sf_dir).withColumn("author_name", F.when(F.col("post_id").cast("long") % 2 == 0, F.upper("author_id"))))


@query(
    "e_relations",
    f"""WITH r AS (SELECT 'u' || l_suppkey % 50 AS s, 'u' || l_partkey % 50 AS t, CASE l_linenumber % 4 WHEN 0 THEN 'follow' WHEN 1 THEN 'friend' WHEN 2 THEN 'co_occur' ELSE 'unknown' END AS rel, l_quantity::INT::VARCHAR AS ts FROM lineitem),
o AS (SELECT s, t, rel, min(ts) AS ts FROM r WHERE rel <> 'unknown' GROUP BY 1, 2, 3), h AS (SELECT *, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(s || '|' || t || '|' || rel)) AS h FROM o)
SELECT {UUID_SQL} AS edge_id, h.s AS source, h.t AS target, h.rel AS relation, b.s IS NOT NULL AS is_mutual, h.ts AS timestamp FROM h LEFT JOIN o b ON b.s = h.t AND b.t = h.s AND b.rel = h.rel AND h.s <> h.t""",
)
def e_relations(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        F.expr("'u' || l_suppkey % 50").alias("source"), F.expr("'u' || l_partkey % 50").alias("target"), F.expr("CASE l_linenumber % 4 WHEN 0 THEN 'follow' WHEN 1 THEN 'friend' WHEN 2 THEN 'co_occur' ELSE 'unknown' END").alias("relation"), F.col("l_quantity").cast("int").cast("string").alias("timestamp")
    )
    return edges.relation_edges(rows)


# Whole documents.
@query(
    "e_training_json",
    TREE_SQL
    + nested_sql("to_json({'comment_id': comment_id, 'author_id': author_id, 'depth': depth})::VARCHAR")
    + f""", first AS (SELECT post_id, author_id, author_name, raw_text FROM comments WHERE ordinal = 0),
 rep AS (SELECT c.post_id, c.author_id AS s, p.author_id AS t, min_by(c.timestamp, c.ordinal) AS ts FROM comments c JOIN comments p ON c.post_id = p.post_id AND c.parent_id = p.comment_id WHERE c.author_id <> p.author_id GROUP BY 1, 2, 3),
 uu AS (SELECT post_id, list({{'source_user_id': s, 'target_user_id': t, 'relation_type': rel, 'timestamp': ts}} ORDER BY s, t, rel) AS l FROM (SELECT post_id, s, t, 'reply' AS rel, ts FROM rep UNION ALL SELECT post_id, t, s, 'reply_rev', ts FROM rep) GROUP BY 1),
 uc AS (SELECT post_id, list({{'user_id': author_id, 'comment_id': comment_id, 'relation_type': 'author'}} ORDER BY ordinal) AS l FROM comments GROUP BY 1),
 nb AS (SELECT f.post_id, list({{'user_id': u, 'type': 'like', 'timestamp': NULL::VARCHAR, 'weight': 1.0::DOUBLE, 'content': CASE WHEN c.cid IS NULL THEN NULL ELSE c.role END, 'comment_id': c.cid}} ORDER BY u) AS l FROM (SELECT post_id, unnest(['user_0', 'nobody']) AS u FROM first) f LEFT JOIN (SELECT post_id, author_id, min_by(comment_id, ordinal) AS cid, any_value(author_id) AS role FROM comments GROUP BY 1, 2) c ON c.post_id = f.post_id AND c.author_id = f.u GROUP BY 1),
 tg AS (SELECT post_id, list({{'hashtag': hashtag, 'frequency': 1, 'post_ids': [post_id]}} ORDER BY hashtag) AS l FROM (SELECT DISTINCT post_id, 'a' || (ordinal % 2) AS hashtag FROM comments) GROUP BY 1)
SELECT f.post_id, '{{"sample_id":"g_' || md5(f.post_id)[:8] || '","post_id":"' || f.post_id || '","post_url":"https://x.org/' || f.post_id || '","platform":"x","node_features":' || to_json({{'text': 'n' || length(raw_text), 'image_urls': []::VARCHAR[]}})::VARCHAR
 || ',"engagement":{{"like":1,"total_reactions":3}},"graph_structure":' || (to_json({{'author_id': author_id, 'author_name': author_name}})::VARCHAR)[:-2] || ',"comment_tree":' || comment_tree || ',"neighbors":' || to_json(nb.l)::VARCHAR || ',"edges_user_user":' || coalesce(to_json(uu.l)::VARCHAR, '[]') || ',"edges_user_comment":' || to_json(uc.l)::VARCHAR || ',"hashtag_nodes":' || to_json(tg.l)::VARCHAR
 || '}},"metadata":{{"timestamp":"t0","location":null}}}}' AS document
FROM first f JOIN nested USING (post_id) JOIN nb USING (post_id) LEFT JOIN uu USING (post_id) JOIN uc USING (post_id) JOIN tg USING (post_id)""",
)
def e_training_json(spark, sf_dir):
    rows = comments(spark, sf_dir)
    walked = tree.walk(rows)
    trees = tree.nested_json(walked, walked.select("post_id", "comment_id", "depth").join(rows, ["post_id", "comment_id"]).select("post_id", "comment_id", F.to_json(F.struct("comment_id", "author_id", "depth")).alias("body")))
    posts_ = rows.where("ordinal = 0").select(
        "post_id", "author_id", "author_name", F.concat(F.lit("https://x.org/"), "post_id").alias("post_url"), F.lit("x").alias("platform"), F.struct(F.concat(F.lit("n"), F.length("raw_text")).alias("text"), F.expr("cast(array() as array<string>)").alias("image_urls")).alias("node_features"),
        F.struct(F.lit(1).alias("like"), F.lit(3).alias("total_reactions")).alias("engagement"), F.struct("timestamp", F.lit(None).cast("string").alias("location")).alias("metadata"),
    )
    liked = rows.where("ordinal = 0").select("post_id", F.explode(F.array(F.lit("user_0"), F.lit("nobody"))).alias("user_id"), F.lit("like").alias("interaction_type"), F.lit(None).cast("string").alias("timestamp"), F.lit(1.0).alias("weight"))
    neighbours = document.neighbours(liked, rows.withColumn("raw_text", F.col("author_id")))
    user_user = edges.with_reverse(edges.reply_edges(rows)).select("post_id", F.col("source").alias("source_user_id"), F.col("target").alias("target_user_id"), F.col("relation").alias("relation_type"), "timestamp")
    keyed = lambda df, *cols: (df.select("*", *[F.col(c).alias(f"__{i}") for i, c in enumerate(cols)]), [f"__{i}" for i in range(len(cols))])
    tags = rows.select("post_id", F.concat(F.lit("a"), F.expr("ordinal % 2")).alias("hashtag")).distinct().select("post_id", "hashtag", F.lit(1).alias("frequency"), F.array("post_id").alias("post_ids"))
    lists_ = {
        "neighbors": keyed(neighbours, "user_id"),
        "edges_user_user": keyed(user_user, "source_user_id", "target_user_id", "relation_type"),
        "edges_user_comment": (edges_user_comment(rows), ["ordinal"]),
        "hashtag_nodes": keyed(tags, "hashtag"),
    }
    return document.training_documents(posts_, trees, lists_)


def edges_user_comment(rows):
    return rows.select("post_id", F.col("author_id").alias("user_id"), "comment_id", F.lit("author").alias("relation_type"), "ordinal")


# Vectors of graphs.
@query("v_text_default", "SELECT doc_id, CASE WHEN coalesce(text, '') = '' OR doc_id % 9 = 0 THEN 'no text' ELSE text END AS text FROM documents")
def v_text_default(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", lists.text_or(F.when(F.col("doc_id") % 9 != 0, F.col("text")), "no text").alias("text"))


def _encode(batch: list[str]) -> list[list[float]]:
    """Stand-in for a model: number of words, of signs, and of texts that came with it at most."""
    return [[len(t.split()), len(t), 1.0 if len(batch) <= 32 else -1.0] for t in batch]


@query("v_embed_texts", r"WITH w AS (SELECT conv_id, turn, list_filter(regexp_split_to_array(coalesce(text, ''), '[\s\x0B\x1C-\x1F\x85\p{Z}]+'), lambda x: x <> '')[:128] AS w FROM conversations) SELECT conv_id, turn, [len(w), length(array_to_string(w, ' ')), 1]::DOUBLE[] AS vector FROM w")
def v_embed_texts(spark, sf_dir):
    return vector.embed_texts(table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"), "text", _encode).drop("text")


@query("v_missing_images", "SELECT page_id, CASE WHEN vec_id IS NULL THEN list_transform(range(64), lambda x: 0.0::DOUBLE) ELSE list_transform(embedding::DOUBLE[], lambda x: round(x, 5)) END AS vector FROM pages LEFT JOIN embeddings ON vec_id = 3 * page_id")
def v_missing_images(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select((F.col("vec_id") / 3).alias("page_id"), F.transform(vector.as_double(F.col("embedding")), lambda x: vector.rounded(x, 5)).alias("vector"))
    return vector.with_missing(table(spark, sf_dir, "pages").select("page_id"), e.where("page_id = floor(page_id)").withColumn("page_id", F.col("page_id").cast("long")), "page_id", 64)


@query("v_concat", "SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: round(x, 5)) || CASE WHEN vec_id % 4 = 0 THEN [0.0, 0.0, 0.0]::DOUBLE[] ELSE [1.0, 2.0, vec_id]::DOUBLE[] END AS v FROM embeddings")
def v_concat(spark, sf_dir):
    image = F.when(F.col("vec_id") % 4 != 0, F.array(F.lit(1.0), F.lit(2.0), F.col("vec_id").cast("double")))
    return table(spark, sf_dir, "embeddings").select("vec_id", vector.padded_concat(F.transform(vector.as_double(F.col("embedding")), lambda x: vector.rounded(x, 5)), image, 3).alias("v"))


@query("v_weighted_pool", "WITH x AS (SELECT label, vec_id % 7 AS w, unnest(embedding::DOUBLE[]) AS v, generate_subscripts(embedding, 1) AS d FROM embeddings), m AS (SELECT label, d, sum(v * w) AS v FROM x GROUP BY 1, 2) SELECT label, list(round(v, 3) ORDER BY d) AS pooled FROM m GROUP BY 1")
def v_weighted_pool(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").withColumn("w", F.col("vec_id") % 7)
    return vector.pooled(e, "label", "embedding", "w").select("label", F.transform("pooled", lambda x: vector.rounded(x, 3)).alias("pooled"))


@query("v_legacy_images", "SELECT page_id, list_transform(range(page_id % 3), lambda k: CASE WHEN page_id % 5 = 0 THEN 'img_new' ELSE page_id || '_img_' || lpad(k::VARCHAR, 3, '0') END)[:CASE WHEN page_id % 5 = 0 THEN 1 ELSE 9 END] AS image_ids FROM pages WHERE page_id % 5 <> 0 OR page_id % 3 > 0 UNION ALL SELECT page_id, ['img_new'] FROM pages WHERE page_id % 5 = 0 AND page_id % 3 = 0")
def v_legacy_images(spark, sf_dir):
    node = F.struct(F.lit("img_new").alias("image_id"), F.lit("p").alias("local_path"), F.lit(None).cast("string").alias("image_url"), F.lit("post").alias("source_type"), F.lit("s").alias("source_id"))
    p = table(spark, sf_dir, "pages").select("page_id", F.slice(F.array(F.lit("a.jpg"), F.lit("b.jpg")), F.lit(1), (F.col("page_id") % 3).cast("int")).alias("local"), F.when(F.col("page_id") % 5 == 0, F.array(node)).alias("nodes"))
    out = lists.legacy_images(F.col("page_id").cast("string"), F.col("local"), F.col("nodes"))
    return p.select("page_id", F.transform(out, lambda x: x["image_id"]).alias("image_ids"))


@query("v_batches", "WITH f AS (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 600), s AS (SELECT doc_id, row_number() OVER (ORDER BY md5('7|' || doc_id)) - 1 AS place FROM f) SELECT doc_id, place, place // 16 AS batch FROM s")
def v_batches(spark, sf_dir):
    return vector.training_batches(table(spark, sf_dir, "documents"), "doc_id", seed=7).withColumn("place", F.col("place").cast("long"))


# Corpus statistics.
@query("a_share", "SELECT count(*) AS total, count(*) FILTER (contains(html, '<img')) AS n_with, count(*) FILTER (contains(html, '<img')) / count(*)::DOUBLE AS share FROM pages")
def a_share(spark, sf_dir):
    return stats.share_with(table(spark, sf_dir, "pages"), F.contains("html", F.lit("<img")))


@query("a_group_limit", "SELECT conv_id, turn FROM conversations WHERE turn < 3")
def a_group_limit(spark, sf_dir):
    return stats.first_per_group(table(spark, sf_dir, "conversations").select("conv_id", "turn"), "conv_id", "turn", 3)


@query("a_fill_missing", "SELECT c_custkey, CASE WHEN c_nationkey = 0 THEN 77 ELSE c_nationkey END AS n FROM customer")
def a_fill_missing(spark, sf_dir):
    from weft.operators.merge import fill_missing

    return table(spark, sf_dir, "customer").select("c_custkey", fill_missing(F.col("c_nationkey"), F.lit(77)).alias("n"))


@query(
    "a_no_new_stop",
    """WITH s AS (SELECT user_id, event_id, event_type = 'purchase' AS new, row_number() OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
 t AS (SELECT *, n - coalesce(max(CASE WHEN new THEN n END) OVER (PARTITION BY user_id ORDER BY n), 0) >= 8 AS over_ FROM s), u AS (SELECT user_id, min(n) FILTER (over_) AS stop, max(n) AS last FROM t GROUP BY 1)
SELECT user_id, max(event_id) AS stopped_at, count(*) FILTER (new) AS n_new, bool_or(stop IS NOT NULL) AS stopped FROM t JOIN u USING (user_id) WHERE n <= coalesce(stop, last) GROUP BY 1""",
)
def a_no_new_stop(spark, sf_dir):
    return stats.no_new_stop(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), "user_id", "event_id", F.col("event_type") == "purchase")


@query("a_least_used", "SELECT arg_min(event_id, (value, event_id)) AS event_id, count(*) AS n FROM events")
def a_least_used(spark, sf_dir):
    return stats.least_used(table(spark, sf_dir, "events"), "event_id", "value", "event_id")


@query("e_interaction_weights", f"SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 2.5 ELSE CASE {INTERACTION_SQL} WHEN 'author' THEN 10.0 WHEN 'share' THEN 5.0 WHEN 'comment' THEN 3.0 WHEN 'angry' THEN 1.5 ELSE 1.0 END END::DOUBLE AS weight FROM events")
def e_interaction_weights(spark, sf_dir):
    rows = interactions(spark, sf_dir)
    return rows.select("event_id", edges.weight(F.col("interaction_type"), F.when(F.col("event_id") % 3 == 0, 2.5).otherwise(F.col("weight"))).alias("weight"))
