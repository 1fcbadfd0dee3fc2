"""The tables of a collection: their columns, and a store that has all of them."""

from __future__ import annotations

from dockmill.sources.store import Store

_STATUS = "status string, error_message string, attempt_count int, last_attempt_at timestamp, created_at timestamp"

TABLES = {
    "document_metadata": "document_id string, title string, docket_id string, agency_id string, agency_name string, document_type string, posted_date string, comment_start_date string, comment_end_date string, metadata_json string, created_at timestamp, updated_at timestamp",
    "comments": "id string, attributes_json string, ord bigint, created_at timestamp",
    "attachments": "id string, comment_id string, format string, file_name string, url string, size bigint, blob_data binary",
    "transcriptions": f"comment_id string, markdown string, word_count int, {_STATUS}",
    "condensed_comments": f"comment_id string, structured_sections map<string,string>, word_count int, {_STATUS}",
    "theme_hierarchy": "code string, description string, level int, parent_code string, quotes_json string, detailed_guidelines string",
    "entity_taxonomy": "category string, label string, definition string, terms array<string>",
    "comment_entities": "comment_id string, category string, entity_label string",
    "theme_summaries": "theme_code string, structured_sections string, comment_count int, word_count int",
    "comment_themes": "comment_id string, theme_code string, score int",
    "theme_scoring_status": f"comment_id string, {_STATUS}",
    "llm_cache": "prompt_hash string, task_type string, task_level int, task_params string, result string, model string, created_at timestamp",
    "comment_theme_extracts": "comment_id string, theme_code string, extract struct<relevance:int,extract:map<string,array<string>>>, cluster_size int",
    "comment_clusters": "cluster_id bigint, representative_comment_id string, cluster_size bigint, similarity_threshold double, cluster_method string",
    "comment_cluster_membership": "comment_id string, cluster_id bigint, is_representative boolean, similarity_score double",
    "clustering_status": "total_comments bigint, total_clusters bigint, representative_count bigint, duplicates_filtered bigint, similarity_threshold double, min_cluster_size int, cluster_method string, status string, created_at timestamp, completed_at timestamp",
}

#: What identifies a row.
KEYS = {
    "document_metadata": ["document_id"],
    "comments": ["id"],
    "attachments": ["id", "format"],
    "transcriptions": ["comment_id"],
    "condensed_comments": ["comment_id"],
    "theme_hierarchy": ["code"],
    "entity_taxonomy": ["category", "label"],
    "comment_entities": ["comment_id", "category", "entity_label"],
    "theme_summaries": ["theme_code"],
    "comment_themes": ["comment_id", "theme_code"],
    "theme_scoring_status": ["comment_id"],
    "llm_cache": ["prompt_hash"],
    "comment_theme_extracts": ["comment_id", "theme_code"],
    "comment_clusters": ["cluster_id"],
    "comment_cluster_membership": ["comment_id"],
}


def open_store(spark, root: str) -> Store:
    """The store of a collection with all tables, those that are missing made empty."""
    store = Store(spark, root)
    for name, columns in TABLES.items():
        if not store.exists(name):
            store.overwrite(name, spark.createDataFrame([], columns))
    return store
