"""Looking at raw data before modelling it: filters, samples, shapes, catalog views."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstat.functions.privacy import redact_variant
from reelstat.functions.typing import as_double, as_timestamp
from reelstat.operators.reports import top_k
from reelstat.schemas import WATERMARK_FIELDS


def filter_events(
    df: DataFrame,
    media_id: str | None = None,
    since: str | datetime | None = None,
    until: str | datetime | None = None,
    min_percent: float | None = None,
) -> DataFrame:
    """Events of one media, received in [since, until), viewed to at least `min_percent`.

    Each given condition excludes rows where its field is NULL or not a number.
    """
    if media_id is not None:
        df = df.where(F.col("media_id") == media_id)
    if since is not None:
        df = df.where(as_timestamp(F.col("received_at")) >= F.lit(since).cast("timestamp"))
    if until is not None:
        df = df.where(as_timestamp(F.col("received_at")) < F.lit(until).cast("timestamp"))
    if min_percent is not None:
        df = df.where(as_double(F.col("percent_viewed")) >= min_percent)
    return df


def sample_first(df: DataFrame, n: int = 100, order: Iterable[str] = ("received_at", "event_key")) -> DataFrame:
    """The first n rows in a fixed order."""
    return df.orderBy(*order).limit(n)


def top_media(events: DataFrame, n: int = 10) -> DataFrame:
    """Media with the most events. Events of no media count under `<none>`."""
    media = F.coalesce(F.nullif(F.col("media_id"), F.lit("")), F.lit("<none>"))
    counts = events.groupBy(media.alias("media_id")).agg(F.count(F.lit(1)).alias("events"))
    return top_k(counts, "events", "media_id", n)


def _payload_type(kind: Column, node: Column) -> Column:
    """Type name of a JSON value, given its schema text. A string with a `T` that ends in `Z` counts as a date-time."""
    text = F.try_variant_get(node, "$", "string")
    # Whole numbers beyond BIGINT have at least 19 digits and no scale; every other decimal had a fraction.
    digits = F.regexp_extract(kind, r"^DECIMAL\((\d+),0\)$", 1).try_cast("int")
    return (
        F.when(kind == "STRING", F.when(text.contains("T") & text.endswith("Z"), "iso_datetime").otherwise("str"))
        .when(kind == "BIGINT", "int")
        .when(kind.startswith("DECIMAL"), F.when(digits >= 19, "int").otherwise("float"))
        .when(kind.isin("DOUBLE", "FLOAT"), "float")
        .when(kind == "BOOLEAN", "bool")
        .when(kind == "VOID", "null")
        .when(kind.startswith("OBJECT"), "object")
        .when(kind.startswith("ARRAY"), "array")
        .otherwise(F.lower(kind))
    )


def payload_sample(
    raw: DataFrame, sample_size: int | None = None, min_percent: float | None = None, value: str = "value"
) -> DataFrame:
    """Payloads as `payload` variants, optionally with a numeric percent_viewed of at least `min_percent`, and
    optionally only the first `sample_size` by received_at, event_key and text."""
    df = raw.select(F.col(value).alias("_text"), F.try_parse_json(F.col(value)).alias("payload"))
    if min_percent is not None:
        percent = F.try_variant_get("payload", "$.percent_viewed", "variant")
        numeric = F.schema_of_variant(percent).rlike("^(BIGINT|DECIMAL.*|DOUBLE|FLOAT)$")
        df = df.where(numeric & (F.try_variant_get(percent, "$", "double") >= min_percent))
    if sample_size is not None:
        order = [F.try_variant_get("payload", f"$.{name}", "string") for name in ("received_at", "event_key")]
        df = df.orderBy(*order, "_text").limit(sample_size)
    return df.select("payload")


def payload_examples(
    raw: DataFrame, sample_size: int | None = None, min_percent: float | None = None, value: str = "value"
) -> DataFrame:
    """The payloads a profile looks at, as JSON text (keys in order) with personal data redacted at any depth."""
    sample = payload_sample(raw, sample_size, min_percent, value)
    return sample.select(F.to_json(redact_variant(F.col("payload"))).alias("value"))


def _key_counts(sample: DataFrame) -> DataFrame:
    """(key, type, n): how many payloads have a key with a value of the type, and, under a null key, how many there are.

    One pass, whose totals, a row per key and type, are kept in memory.
    """
    fields = F.map_entries(F.try_variant_get("payload", "$", "map<string,variant>"))
    fields = F.transform(fields, lambda e: F.struct(e["key"].alias("key"), e["value"].alias("node")))
    itself = F.array(F.struct(F.lit(None).cast("string").alias("key"), F.lit(None).cast("variant").alias("node")))
    each = sample.select(F.explode(F.concat(itself, F.coalesce(fields, F.slice(itself, 1, 0)))).alias("one")).select("one.*")
    kinds = each.select("key", "node", F.schema_of_variant("node").alias("kind"))  # once per value
    grouped = kinds.groupBy("key", F.when(F.col("key").isNotNull(), _payload_type(F.col("kind"), F.col("node"))).alias("type"))
    return grouped.agg(F.count(F.lit(1)).alias("n")).persist()


def payload_profile(
    raw: DataFrame, sample_size: int | None = None, min_percent: float | None = None, value: str = "value"
) -> DataFrame:
    """Per top-level key: how many payloads have it, the types it takes, and the share of payloads where it is NULL.

    The share is of all payloads, which are counted in the pass that counts the keys.
    """
    counts = _key_counts(payload_sample(raw, sample_size, min_percent, value))
    total = counts.where("key IS NULL").agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    # At most one entry per type name is collected for a key.
    return (
        counts.where("key IS NOT NULL")
        .groupBy("key")
        .agg(
            F.sum("n").alias("observed_in"),
            F.map_from_entries(F.sort_array(F.collect_list(F.struct("type", "n")))).alias("types"),
            F.sum(F.when(F.col("type") == "null", F.col("n")).otherwise(0)).alias("nulls"),
        )
        .select("key", "observed_in", "types", F.round(F.col("nulls") / total, 3).alias("null_frac"))
        .orderBy("key")
    )


def payload_summary(
    raw: DataFrame,
    sample_size: int | None = None,
    min_percent: float | None = None,
    value: str = "value",
    n_keys: int = 10,
) -> DataFrame:
    """Head of a profile: payloads fetched, payloads sampled, distinct keys, and the first keys by name."""
    counts = _key_counts(payload_sample(raw, sample_size, min_percent, value))
    keys = counts.where("key IS NOT NULL").select("key").distinct()
    first = keys.orderBy("key").limit(n_keys).agg(F.sort_array(F.collect_list("key")))
    return raw.agg(F.count(F.lit(1)).alias("fetched")).select(
        "fetched",
        counts.where("key IS NULL").agg(F.coalesce(F.sum("n"), F.lit(0))).scalar().alias("sampled"),
        keys.agg(F.count(F.lit(1))).scalar().alias("distinct_keys"),
        first.scalar().alias("top_keys"),
    )


# The four accepted forms of a watermark value, each with the shape that tells it apart.
_PROBE_FORMS = (
    (r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}Z$", "yyyy-M-d'T'H:m:s'Z'"),
    (r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}\.\d{1,6}Z$", "yyyy-M-d'T'H:m:s.SSSSSS'Z'"),
    (r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$", "yyyy-M-d H:m:s"),
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
)


def probe_time(text: Column) -> Column:
    """A watermark value read as UTC; NULL for text of any other form. The shape is matched first because a failed
    parse costs far more than a pattern."""
    return F.coalesce(
        *[F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(form))) for shape, form in _PROBE_FORMS]
    )


def _inner(node: Column) -> Column:
    """The elements of an array, or of the `items` of an object; none otherwise."""
    listed = F.try_variant_get(node, "$", "array<variant>")
    wrapped = F.try_variant_get(F.try_variant_get(node, "$.items", "variant"), "$", "array<variant>")
    return F.coalesce(listed, wrapped, F.array().cast("array<variant>"))


def _marked(last: bool):
    return lambda node: F.struct(node.alias("_node"), F.lit(last).alias("_last"))


def _probed(nodes: DataFrame, by: list[str], names: list[str]) -> DataFrame:
    """Per group: values found, times among them, earliest and latest, of each name."""
    node = F.col("_node")

    def string_at(name: str) -> Column:
        kind = F.schema_of_variant(F.try_variant_get(node, f"$.{name}", "variant"))
        return F.when(kind == "STRING", F.try_variant_get(node, f"$.{name}", "string"))

    texts = nodes.select(*by, "_left", *[string_at(name).alias(f"text_{i}") for i, name in enumerate(names)])
    times = texts.select("*", *[probe_time(F.col(f"text_{i}")).alias(f"time_{i}") for i in range(len(names))])
    # One row per group; a payload contributes to all candidates at once.
    measures = [
        measure
        for i in range(len(names))
        for measure in (
            F.count(f"text_{i}").alias(f"found_{i}"),
            F.count(f"time_{i}").alias(f"parsed_{i}"),
            F.min(f"time_{i}").alias(f"min_{i}"),
            F.max(f"time_{i}").alias(f"max_{i}"),
        )
    ]
    return times.groupBy(*by).agg(F.coalesce(F.max("_left"), F.lit(False)).alias("_left"), *measures)


def watermark_probe(
    raw: DataFrame,
    candidates: Iterable[str] = WATERMARK_FIELDS,
    by: Iterable[str] = (),
    value: str = "value",
) -> DataFrame:
    """Per candidate field, in order of preference: values found, values that are times, earliest and latest.

    Looks at JSON objects, at the elements of JSON arrays, and at the `items` of each, however they are nested. `suggested`
    marks the first candidate with usable times, per group of `by`.

    One pass takes the payloads and two containers inside each other, and says whether any of them holds more; only then a
    further pass takes the next levels of what is left. The totals of a pass, a row per group, are kept in memory.
    """
    by, names = list(by), list(candidates)
    nodes = raw.select(*by, F.try_parse_json(F.col(value)).alias("_node"))
    passes: list[DataFrame] = []
    more = True
    while more:
        inside = F.flatten(F.transform("_inner", _inner))
        levels = nodes.select(*by, "_node", _inner(F.col("_node")).alias("_inner")).withColumn("_inside", inside)
        marked = [F.transform(listed, _marked(last)) for listed, last in ((F.array("_node"), False), ("_inner", False), ("_inside", True))]
        each = levels.select(*by, F.explode(F.concat(*marked)).alias("_one")).select(*by, "_one.*")
        left = F.col("_last") & (F.size(_inner(F.col("_node"))) > 0)
        totals = _probed(each.withColumn("_left", left), by, names).persist()
        passes.append(totals)
        more = bool(totals.agg(F.max("_left")).first()[0])
        nodes = each.where(left).select(*by, F.explode(_inner(F.col("_node"))).alias("_node")) if more else nodes
    totals = passes[0]
    if len(passes) > 1:
        both = reduce(DataFrame.unionByName, passes)
        fold = {"found": F.sum, "parsed": F.sum, "min": F.min, "max": F.max}
        totals = both.groupBy(*by).agg(*[f(f"{n}_{i}").alias(f"{n}_{i}") for i in range(len(names)) for n, f in fold.items()])
    best = F.coalesce(*[F.when(F.col(f"parsed_{i}") > 0, F.lit(i)) for i in range(len(names))], F.lit(-1))
    fields = [
        F.struct(
            F.lit(i).alias("priority"),
            F.lit(name).alias("field"),
            F.col(f"found_{i}").alias("found"),
            F.col(f"parsed_{i}").alias("parsed"),
            F.col(f"min_{i}").alias("min_ts"),
            F.col(f"max_{i}").alias("max_ts"),
            (best == i).alias("suggested"),
        )
        for i, name in enumerate(names)
    ]
    return totals.select(*by, F.inline(F.array(*fields)))


def catalog_sweep(
    media: DataFrame,
    search: str | None = None,
    media_type: str | None = None,
    sort_by: str | None = None,
    descending: bool = False,
    page: int = 1,
    per_page: int = 50,
    max_pages: int | None = None,
) -> DataFrame:
    """The media whose name contains `search` (any case) and whose section is `media_type`, from `page` on.

    All pages, or `max_pages` of them.
    """
    if search:
        media = media.where(F.lower("name").contains(search.lower()))
    if media_type:
        media = media.where(F.col("section") == media_type)
    order = []
    if sort_by:
        order.append(F.col(sort_by).desc_nulls_last() if descending else F.col(sort_by).asc_nulls_last())
    first = (max(page, 1) - 1) * per_page
    ordered = media.orderBy(*order, F.col("media_id").asc())
    ordered = ordered.offset(first) if first else ordered
    return ordered if max_pages is None else ordered.limit(per_page * max_pages)


def catalog_summary(media: DataFrame, n: int = 10) -> DataFrame:
    """How many media there are, and the first n non-empty titles in media_id order."""
    titles = [F.nullif(F.col(name), F.lit("")) for name in ("name", "title") if name in media.columns]
    first = media.select("media_id", F.coalesce(*titles).alias("title")).where("title IS NOT NULL")
    first = first.orderBy("media_id", "title").limit(n)
    ordered = first.agg(F.sort_array(F.collect_list(F.struct("media_id", "title")))["title"].alias("t"))
    return media.agg(F.count(F.lit(1)).alias("count")).select("count", ordered.scalar().alias("top_titles"))


def landing_summary(lines: DataFrame, media_ids: Iterable[str] | None = None, value: str = "value") -> DataFrame:
    """Rows and bytes landed per media. Media that were asked for appear with 0 rows when nothing came."""
    landed = lines.groupBy("media_id").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length(value)).alias("bytes")
    )
    if media_ids is None:
        return landed
    asked = lines.sparkSession.createDataFrame([(m,) for m in media_ids], "media_id string").distinct()
    return with_requested(landed, asked)


def with_requested(landed: DataFrame, asked: DataFrame) -> DataFrame:
    return asked.join(landed, "media_id", "left").select(
        "media_id",
        F.coalesce("rows", F.lit(0)).alias("rows"),
        F.coalesce("bytes", F.lit(0)).alias("bytes"),
    )
