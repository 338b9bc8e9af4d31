"""Column contracts of every dataset.

Bronze scalars are read as text and typed later with `try_*`, so one odd value never changes a schema, fails a
read or nulls out its neighbours.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _text(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


def _struct(*fields: T.StructField) -> T.StructType:
    return T.StructType(list(fields))


USER_AGENT = _struct(*_text("browser", "browser_version", "platform", "mobile"))

BRONZE = {
    "visitors": _struct(
        *_text("visitor_key", "load_count", "play_count"),
        T.StructField(
            "visitor_identity",
            _struct(*_text("name", "email"), T.StructField("org", _struct(*_text("name", "title")))),
        ),
        *_text("created_at", "last_active_at", "last_event_key", "identifying_event_key"),
        T.StructField("user_agent_details", USER_AGENT),
    ),
    "media": _struct(
        *_text("id", "hashed_id", "name", "duration", "created", "updated", "status", "archived", "section"),
        T.StructField("thumbnail", _struct(*_text("url", "width", "height"))),
        T.StructField("project", _struct(*_text("id", "name"))),
        *_text("progress"),
    ),
    # The union of the two event shapes in use. conversion_data is free-form and kept as its JSON text.
    "events": _struct(
        *_text("event_key", "received_at", "at", "event_type", "media_id", "ip", "position_s", "percent_viewed"),
        *_text("country", "region", "city", "lat", "lon", "org", "email", "visitor_key"),
        *_text("embed_url", "conversion_type", "conversion_data", "iframe_heatmap_url", "media_name", "media_url"),
        T.StructField("user_agent_details", USER_AGENT),
    ),
    "media_by_date": _struct(
        *_text("date", "load_count", "play_count", "play_rate", "hours_watched", "engagement", "visitors", "media_id"),
    ),
    "media_stats": _struct(
        *_text("load_count", "play_count", "play_rate", "hours_watched", "engagement", "visitors"),
    ),
}

# Of a lossless read: the text of a line that could not be read whole, and the file it stands in.
LINE_TEXT = "line_text"
SOURCE_FILE = "source_file"

# Where media_id comes from: the directory always, or the directory only when the record has none.
MEDIA_ID_FROM_PATH = ("visitors", "media")
MEDIA_ID_FROM_BODY = ("events", "media_by_date", "media_stats")


_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "user_agent": USER_AGENT,
}


def _columns(**types: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in types.items()])


_NONE = _columns()
_DAY = _columns(dt="date")
_DAY_AND_MEDIA = _columns(dt="date", media_id="string")

_MEDIA = dict(
    name="string",
    duration_s="double",
    created_at="timestamp",
    updated_at="timestamp",
    status="string",
    archived="boolean",
    section="string",
    project_id="bigint",
    project_name="string",
    thumbnail_url="string",
    progress="double",
    ingested_at="timestamp",
)

# Table -> (data columns, partition columns)
TABLES = {
    "silver_visitors": (
        _columns(
            visitor_key="string",
            load_count="bigint",
            play_count="bigint",
            name="string",
            email="string",
            ingested_at="timestamp",
        ),
        _DAY_AND_MEDIA,
    ),
    "silver_media_history": (_columns(**_MEDIA), _DAY_AND_MEDIA),
    "silver_media_snapshot": (_columns(media_id="string", **_MEDIA), _NONE),
    "silver_media_by_date": (
        _columns(
            day="date",
            load_count="bigint",
            play_count="bigint",
            play_rate="double",
            hours_watched="double",
            engagement="double",
            visitors="bigint",
            processed_at="timestamp",
        ),
        _DAY_AND_MEDIA,
    ),
    "silver_events": (
        _columns(
            at="timestamp",
            event_type="string",
            position_s="double",
            ip_hmac="string",
            processed_at="timestamp",
            event_key="string",
            received_at="timestamp",
            percent_viewed="double",
            country="string",
            region="string",
            visitor_key="string",
            embed_url="string",
            conversion_type="string",
            conversion_data="string",
            iframe_heatmap_url="string",
            media_name="string",
            media_url="string",
            user_agent_details="user_agent",
        ),
        _DAY_AND_MEDIA,
    ),
    "gold_dim_media": (
        _columns(
            media_id="string",
            title="string",
            duration_s="double",
            created_at="timestamp",
            updated_at="timestamp",
            status="string",
            archived="boolean",
            section="string",
            project_id="bigint",
            project_name="string",
            thumbnail_url="string",
            progress="double",
            silver_ingested_at="timestamp",
            gold_ingested_at="timestamp",
        ),
        _NONE,
    ),
    "gold_fact_media_daily": (
        _columns(
            media_id="string",
            unique_visitors="bigint",
            loads="bigint",
            plays="bigint",
            play_rate="double",
            gold_ingested_at="timestamp",
        ),
        _DAY,
    ),
}

# Tables beside the contract's: what could not be read of each dataset, and the counts of its files, by day.
QUARANTINE = "quarantine/lines"
FILE_COUNTS = "quarantine/files"

# A sketch of the visitors of each day and media, kept beside the fact.
SKETCHES = "visitor_sketches"
SKETCH_SCHEMA = "media_id string, visitor_sketch binary, dt date"

# Columns that the snapshot's files have beyond the contract's: the day that delivered the row, which ranks equal versions.
DELIVERED = "delivered"

# Directory of each table under the silver or gold root.
TABLE_DIRS = {
    "silver_visitors": "visitors",
    "silver_media_history": "media_history",
    "silver_media_snapshot": "media_snapshot",
    "silver_media_by_date": "media_by_date",
    "silver_events": "events",
    "gold_dim_media": "dim_media",
    "gold_fact_media_daily": "fact_media_daily",
}


def table_schema(table: str) -> T.StructType:
    data, partitions = TABLES[table]
    return T.StructType(data.fields + partitions.fields)


# The keys that carry personal data, and the text that replaces them.
EVENT_PII = ("ip", "email", "lat", "lon", "city", "org")
CATALOG_PII = ("email",)
REDACTED = "<redacted>"

# The fields a watermark may be read from, in order of preference.
WATERMARK_FIELDS = ("updated_at", "updated", "modified_at", "modified", "created_at", "created")
