"""Column lists, nested types and controlled vocabularies."""

from pyspark.sql import types as T

# --- fixed values: record layout ------------------------------------------

METADATA_COLUMNS = [
    "type",
    "source",
    "region",
    "country",
    "model",
    "xev",
    "year1",
    "year2",
    "language",
    "version",
    "updated_at",
    "file_format",
    "content_summary",
]

EARLIER_COLUMNS = [
    "document_id",
    "source_type",
    "file_name",
    "upload_date",
    "car_model",
    "car_type",
    "engine_type",
    "price",
    "page_count",
    "text_length",
    "features",
    "keywords",
    "summary",
    "specifications",
    "gcs_uri",
]

# The summary is answered beside the other fields, not among them.
LABEL_FIELDS = [c for c in METADATA_COLUMNS if c != "content_summary"]

# Value of a field the answer does not mention; None is a null.
FIELD_DEFAULTS = {
    "type": "UNKNOWN",
    "source": "UNKNOWN",
    "region": "UNKNOWN",
    "country": "UNKNOWN",
    "model": "UNKNOWN",
    "xev": None,
    "year1": None,
    "year2": None,
    "language": "UNKNOWN",
    "version": "v1.0.0",
}

# --- fixed values: limits ---------------------------------------------------

DIRECT_LIMIT_BYTES = 20 * 1024 * 1024
REQUEST_TEXT_CHARS = 10_000
SUMMARY_CHARS = 1_000
ACCURACY_TARGET = 0.90
TOP_MODELS = 10

# --- fixed values: controlled vocabularies ----------------------------------

DOMAINS = {
    "type": ["브랜드", "차종정보", "비즈니스", "고객정보", "기술정보"],
    "source": [
        "도메인",
        "상품운영안",
        "신차해설서",
        "FAQ",
        "카탈로그",
        "기타판매문서",
        "기타교육문서",
        "기타비즈니스설명문서",
        "YOUTUBE",
        "오너스매뉴얼",
    ],
    "region": [
        "UNKNOWN",
        "COMMON",
        "A1(KOREA)",
        "A2(APAC)",
        "A3(CHINA)",
        "A4(INDIA)",
        "B1(NORTH AMERICA)",
        "B2(SOUTH AMERICA)",
    ],
    "xev": ["Hybrid", "Plugin-Hybrid"],
    "file_format": ["ppt", "pdf", "html", "web", "video", "string_link"],
}

# Values that stand for "no statement" and agree with everything.
PLACEHOLDERS = ["UNKNOWN", "COMMON"]

# --- types ------------------------------------------------------------------

METADATA_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in METADATA_COLUMNS]
)

SEGMENTS = "ARRAY<STRUCT<start_index: STRING, end_index: STRING>>"
PARAGRAPHS = f"ARRAY<STRUCT<segments: {SEGMENTS}>>"
SHARD_PAGES = f"ARRAY<STRUCT<page_number: INT, paragraphs: {PARAGRAPHS}>>"
PAGES = "ARRAY<STRUCT<page_number: INT, text: STRING>>"
ENTITIES = "ARRAY<STRUCT<type: STRING, mention_text: STRING, confidence: DOUBLE>>"

# One OCR output file, as its JSON is written.
SHARD_JSON = (
    "STRUCT<text: STRING,"
    " pages: ARRAY<STRUCT<pageNumber: INT, paragraphs: ARRAY<STRUCT<layout:"
    " STRUCT<textAnchor: STRUCT<textSegments:"
    " ARRAY<STRUCT<startIndex: STRING, endIndex: STRING>>>>>>>>,"
    " entities: ARRAY<STRUCT<type: STRING, mentionText: STRING,"
    " confidence: DOUBLE>>>"
)

EXTRACTED = (
    f"uri STRING, mime_type STRING, full_text STRING, pages {PAGES},"
    f" entities {ENTITIES}, status STRING, error STRING"
)

VIDEO_ANSWER = (
    "STRUCT<items: ARRAY<STRUCT<snippet: STRUCT<title: STRING,"
    " description: STRING, channelTitle: STRING, publishedAt: STRING,"
    " defaultLanguage: STRING, defaultAudioLanguage: STRING>>>>"
)

CAPTION_ANSWER = (
    "STRUCT<items: ARRAY<STRUCT<id: STRING,"
    " snippet: STRUCT<language: STRING, trackKind: STRING>>>>"
)
