"""Every table and JSON schema as DDL text, declared once; nothing is ever inferred."""

from __future__ import annotations

# Version tags and vocabularies of the stored records.
CANONICAL_VERSION = "1.1"
ROW_VERSION = "1.0.0"
ROW_LEVELS = ("doc", "page", "block", "insight")
UNITS = ("pt", "px", "in", "mm")
BLOCK_TYPES = ("paragraph", "heading", "list_item", "table", "figure", "kv_pair", "footer", "header")
ROW_STATUSES = ("succeeded", "partial", "failed")
INSIGHT_KINDS = ("classification", "extraction", "summary", "qa")
JOB_STATUSES = ("accepted", "queued", "running", "succeeded", "partially_succeeded", "failed", "cancelled")
ENRICHMENT_STATUSES = ("pending", "running", "succeeded", "failed")
TERMINAL_STATUSES = ("succeeded", "failed", "partially_succeeded", "cancelled")
READY_STATUSES = ("succeeded", "partially_succeeded")
REVIEW_TRIGGERS = ("low_extraction_quality", "fraud_signal", "correctness_failure", "manual")
REVIEW_STATUSES = ("pending", "in_progress", "completed", "returned")
REVIEW_OUTCOMES = ("approved", "corrected", "rejected")

MESSAGE = "message_id string, queue_url string, stream string, body string, receive_count int, sent_at timestamp"

_PAGE_KEYS = (
    ("textDensity", "text_density"),
    ("imageDensity", "image_density"),
    ("tableDensity", "table_density"),
    ("charCount", "char_count"),
    ("tableCount", "table_count"),
    ("imageCount", "image_count"),
    ("checkboxCount", "checkbox_count"),
    ("radioButtonCount", "radio_button_count"),
)
# both spellings of every key; scalars stay strings so that a bad value is a null, not a bad record
PAGE_PAYLOAD = "struct<index:string," + ",".join(f"{k}:string" for pair in _PAGE_KEYS for k in pair) + ">"

_MESSAGE_BODY = (
    "s3 struct<bucket:struct<name:string>,object:struct<key:string>>,"
    "object_key string, objectKey string, source_path string, source_uri string,"
    "documentMetadata struct<contentType:string,mimeType:string,pageCount:string,"
    "inlineContent:string,inline_content:string,"
    f"layout:struct<textDensity:string,imageDensity:string,tableDensity:string,pages:array<{PAGE_PAYLOAD}>>>,"
    "documentBytes string, document_bytes string, documentContent string, document_content string, payload string,"
    "page_count string, pageCount string, TopicArn string, routing string, overrides string"
)


def message_body(override_flag: str) -> str:
    return f"{_MESSAGE_BODY}, `{override_flag}` string"



PAGE_METRICS = (
    "index int, text_density double, image_density double, table_density double, char_count long,"
    "table_count long, image_count long, checkbox_count long, radio_button_count long"
)

OVERRIDE_RULE = "priority long, pattern string, strategy string, model string, max_pages int"

FAILURE = (
    "message_id string, queue_url string, failure_reason string, error_message string, stacktrace string,"
    "receive_count int, source_path string, failed_at timestamp, batch_id long"
)

# exploded canonical tables
REGION_COLUMNS = "page int, polygon array<double>, bounding_box array<double>"
SPAN = "struct<content:string,confidence:double,page:int,polygon:array<double>,bounding_box:array<double>,span_id:string,parser:string,method:string>"
CELL = (
    "struct<row_index:int,column_index:int,content:string,confidence:double,page:int,polygon:array<double>,"
    "bounding_box:array<double>,row_span:int,column_span:int>"
)
TABLE = f"struct<table_id:string,confidence:double,cells:array<{CELL}>,caption:string,footnotes:array<string>,parser:string>"
FIELD = (
    "struct<name:string,value:string,confidence:double,value_type:string,page:int,polygon:array<double>,"
    "bounding_box:array<double>,parser:string,method:string>"
)
VISUAL = (
    "struct<description:string,confidence:double,page:int,polygon:array<double>,bounding_box:array<double>,"
    "tags:array<string>,parser:string,method:string>"
)
SEGMENT = "struct<page_number:int,parser:string,method:string,confidence:double,metadata:string>"
SUMMARY = (
    "struct<summary:string,confidence:double,method:string,title:string,model:string,justification:string,metadata:string>"
)
ENRICHMENT = (
    "struct<enrichment_type:string,provider:string,content:string,confidence:double,model:string,"
    "duration_ms:long,metadata:string>"
)
ATTACHMENT = (
    "struct<attachment_id:string,file_name:string,mime_type:string,checksum:string,source_uri:string,"
    "metadata:string,child_document_id:string>"
)

# one row per document; attachments point at their document instead of nesting it
CANONICAL = (
    "document_id string, source_uri string, checksum string, schema_version string, document_type string,"
    f"mime_type string, metadata string, text_spans array<{SPAN}>, tables array<{TABLE}>, fields array<{FIELD}>,"
    f"visual_descriptions array<{VISUAL}>, page_segments array<{SEGMENT}>, attachments array<{ATTACHMENT}>,"
    f"summaries array<{SUMMARY}>, enrichments array<{ENRICHMENT}>"
)

CANONICAL_COLUMNS = (
    "document_id", "source_uri", "checksum", "schema_version", "document_type", "mime_type", "metadata", "text_spans",
    "tables", "fields", "visual_descriptions", "page_segments", "attachments", "summaries", "enrichments",
)

# denormalised rows
ROW_BASE = (
    "schema_version string, request_id string, bundle_id string, part_id string, page_number int,"
    "generated_at timestamp, record_level string"
)
ROWS = (
    ROW_BASE + ", doc_title string, doc_type string, doc_language string, doc_summary string, total_pages long,"
    "total_blocks long, status string, insight_label string, insight_conf double,"
    "width double, height double, units string, page_text string, page_block_count long, source_mime string,"
    "engine_id string, lang_detected string,"
    "block_id string, block_type string, text string, bbox_x double, bbox_y double, bbox_w double, bbox_h double,"
    "confidence double, lines array<string>, table_rows int, table_cols int, kv_key string, kv_value string,"
    "insight_kind string, insight_use_case string, class_label string, class_conf double, field string,"
    "value_text string, value_number double, value_unit string, summary_text string, qa_question string,"
    "qa_answer string, evidence_part_id string, evidence_page_number int, evidence_block_id string"
)

TELEMETRY = (
    "event_name string, job_name string, run_id string, queue_url string, status string, message_id string,"
    "object_key string, failure_reason string, event_time timestamp, latency_ms long, duration_ms long,"
    "batch_size long, successes long, failures long, queue_depth long, inflight long, receive_count long"
)

JOB_EVENT = (
    "job_id string, status string, submitted_at timestamp, updated_at timestamp, error string, metadata string,"
    "enrichments string, notification_config string, notifications_emitted boolean"
)

RESULT = "job_id string, sequence long, canonical_document string"

REVIEW = (
    "document_id string, trigger string, title string, job_id string, canonical_document string,"
    "standardized_output string, insights string, reviewed_canonical_document string,"
    "reviewed_standardized_output string, reviewed_insights string, status string, outcome string,"
    "assigned_to string, assigned_at timestamp, latest_reviewed_at timestamp, created_at timestamp, updated_at timestamp"
)
