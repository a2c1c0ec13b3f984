"""Table schemas and the fixed values the pipeline must reproduce.

Everything a job can vary (paths, fills, thresholds, join semantics) is a
function parameter elsewhere; this module only holds defaults.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the source pipeline's for identical results).
# ---------------------------------------------------------------------------

# Raw CSV header spellings -> canonical column name.  The last entry,
# ``review/helpfulness``, is our addition so the prefixed spelling is not
# silently dropped like the other unmapped headers.
HEADER_MAP: dict[str, str] = {
    "Title": "title", "title": "title",
    "description": "description", "Description": "description",
    "authors": "authors", "Authors": "authors",
    "image": "image", "Image": "image",
    "previewLink": "preview_link", "PreviewLink": "preview_link",
    "publisher": "publisher", "Publisher": "publisher",
    "publishedDate": "published_date", "PublishedDate": "published_date",
    "infoLink": "info_link", "InfoLink": "info_link",
    "categories": "categories", "Categories": "categories",
    "ratingsCount": "ratings_count", "RatingsCount": "ratings_count",
    "Id": "id", "id": "id",
    "Price": "price", "price": "price",
    "User_id": "user_id", "user_id": "user_id",
    "profileName": "profile_name", "ProfileName": "profile_name",
    "helpfulness": "helpfulness", "Helpfulness": "helpfulness",
    "review/score": "review_score", "review_score": "review_score",
    "review/time": "review_time", "review_time": "review_time",
    "review/summary": "review_summary", "review_summary": "review_summary",
    "review/text": "review_text", "Review_text": "review_text",
    "review/helpfulness": "helpfulness",
}

# Text values read as NULL by default (exact, case-sensitive, untrimmed).
NA_TOKENS: tuple[str, ...] = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Column order of the two raw tables.
CATALOG_COLUMNS: tuple[str, ...] = (
    "title", "description", "authors", "image", "preview_link",
    "publisher", "published_date", "info_link", "categories", "ratings_count",
)
REVIEW_COLUMNS: tuple[str, ...] = (
    "id", "title", "price", "user_id", "profile_name",
    "helpfulness", "review_score", "review_time", "review_summary", "review_text",
)

# Columns kept in the curated dataset, in order.
CURATED_COLUMNS: tuple[str, ...] = (
    "title", "user_id", "review_score", "review_summary",
    "review_text", "review_date", "authors", "categories", "publisher",
)

# Null fills applied after the join.
DEFAULT_FILLS: dict[str, object] = {"review_score": 0.0, "categories": "Unknown"}

# Table labels used by the audit, and the volume gate's minimum row counts.
CATALOG_LABEL = "books.books_data"
REVIEWS_LABEL = "books.books_rating"
VOLUME_THRESHOLDS: dict[str, int] = {
    "books.books_rating": 100_000,
    "books.books_data": 10_000,
}

# Valid review score range (inclusive).
SCORE_MIN, SCORE_MAX = 1, 5

# Null-profile metric labels: (label, table, column).
NULL_METRICS: tuple[tuple[str, str, str], ...] = (
    ("books_rating.review_score nulos", "reviews", "review_score"),
    ("books_rating.user_id nulos", "reviews", "user_id"),
    ("books_rating.title nulos", "reviews", "title"),
    ("books_rating.review_time nulos", "reviews", "review_time"),
    ("books_data.title nulos", "catalog", "title"),
    ("books_data.authors nulos", "catalog", "authors"),
)

# Audit report section labels.
SECTION_COUNTS = "1_conteo_registros"
SECTION_DISTRIBUTION = "2_review_distribution"
SECTION_NULLS = "3_nulos"
SECTION_SCORE_RANGE = "4_score_range"

# Audit report file name: prefix + run timestamp (yyyyMMdd_HHmmss).
REPORT_PREFIX = "verificacion_carga_"
REPORT_TS_FORMAT = "%Y%m%d_%H%M%S"

# Columns that a load adds: its number, and the row's place in it.
LOAD_SEQ, ROW_ORDER = "_load_seq", "_row_order"

# Development row cap of the source extract (off by default here).
DEV_REVIEW_CAP = 100_000

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

_S, _D, _L = T.StringType(), T.DoubleType(), T.LongType()

CATALOG_SCHEMA = T.StructType([
    T.StructField(c, _D if c == "ratings_count" else _S, True) for c in CATALOG_COLUMNS
])

REVIEW_SCHEMA = T.StructType([
    T.StructField(c, {"price": _D, "review_score": _D, "review_time": _L}.get(c, _S), True)
    for c in REVIEW_COLUMNS
])

CURATED_SCHEMA = T.StructType([
    T.StructField(c, {"review_score": _D, "review_date": T.TimestampNTZType()}.get(c, _S), True)
    for c in CURATED_COLUMNS
])

