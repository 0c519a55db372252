"""Explicit schemas; every JSON read states one, missing fields are null."""

from __future__ import annotations

USER_POST = "edge_id string, user_id string, post_id string, interaction_type string, weight double, timestamp string"
USER_USER = "edge_id string, source_user_id string, target_user_id string, relation_type string, is_mutual boolean, edge_weight double, timestamp string"
USER_COMMENT = "edge_id string, user_id string, comment_id string, relation_type string, reaction_type string, timestamp string"
COMMENT_REPLY = "comment_id string, target_id string, target_type string, direction string, timestamp string"
POST_HASHTAG = "post_id string, hashtag string, direction string"
CONTENT_IMAGE = "source_id string, image_id string, source_type string, direction string"
HASHTAG_NODE = "hashtag string, frequency bigint, post_ids array<string>"
IMAGE_NODE = "image_id string, local_path string, image_url string, source_type string, source_id string"
COUNTS = ("like", "love", "haha", "wow", "sad", "angry", "care", "comment_count", "share_count", "view_count", "total_reactions")


def _struct(fields: str) -> str:
    return "struct<" + ",".join(":".join(f.strip().split(" ", 1)) for f in _split(fields)) + ">"


def _split(fields: str) -> list[str]:
    out, depth, part = [], 0, ""
    for c in fields:
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(part)
            part = ""
        else:
            part += c
    return [*out, part]


#: A sample as one document. The tree is recursive, which Spark structs can't be: it stays JSON text.
DOCUMENT = (
    "sample_id string, post_id string, post_url string, platform string, "
    "node_features struct<text:string,image_urls:array<string>,local_images:array<string>,video_urls:array<string>,hashtags:array<string>,mentions:array<string>>, "
    f"engagement struct<{','.join(f'`{c}`:bigint' for c in COUNTS)}>, "
    f"graph_structure struct<author_id:string,comment_tree:string,hashtag_nodes:array<{_struct(HASHTAG_NODE)}>,image_nodes:array<{_struct(IMAGE_NODE)}>,"
    f"edges_user_post:array<{_struct(USER_POST)}>,edges_user_user:array<{_struct(USER_USER)}>,edges_user_comment:array<{_struct(USER_COMMENT)}>,"
    f"edges_comment_reply:array<{_struct(COMMENT_REPLY)}>,edges_post_hashtag:array<{_struct(POST_HASHTAG)}>,edges_content_image:array<{_struct(CONTENT_IMAGE)}>>, "
    "metadata struct<timestamp:string,location:string,post_type:string,source_page:string,tagged_users:array<string>,external_links:array<string>,scraped_at:string>"
)
TABLES = ("edges_user_post", "edges_user_user", "edges_user_comment", "edges_comment_reply", "edges_post_hashtag", "edges_content_image", "hashtag_nodes", "image_nodes")
