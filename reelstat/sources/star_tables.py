"""Bronze-shaped frames derived from the star-schema test tables.

Only tests, the bench and the registered queries use these; the operators know nothing of them. Like a real
bronze scan they deliver scalars as text, repeat records, leave values out and contain malformed ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstat.sources.files import join

_ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(join(sf_dir, f"{name}.parquet"))


def _media(df: DataFrame) -> Column:
    return F.get_json_object(df["props"], "$.k")


def _text(column: Column) -> Column:
    return column.cast("string")


def visitors_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, customers = table(spark, sf_dir, "events"), table(spark, sf_dir, "customer")
    kind, value = F.col("event_type"), F.col("value")
    joined = events.join(customers, events["user_id"] == customers["c_custkey"], "left")
    email = F.concat(F.lower("c_mktsegment"), F.lit("@example.com"))
    return joined.select(
        F.col("ts").cast("date").alias("dt"),
        _media(events).alias("media_id"),
        _text(F.col("user_id")).alias("visitor_key"),
        F.when(kind != "error", _text(F.floor(value))).alias("load_count"),
        F.when(kind.isin("view", "purchase"), _text(F.floor(value / 2).cast("double"))).alias("play_count"),
        F.struct(
            F.when(kind != "click", F.col("c_name")).alias("name"),
            F.when(kind == "signup", email).alias("email"),
        ).alias("visitor_identity"),
    )


def media_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    brand = F.regexp_extract("p_brand", r"#(\d+)", 1)
    return lines.join(parts, lines["l_partkey"] == parts["p_partkey"]).select(
        F.col("l_shipdate").cast("date").alias("dt"),
        _text(F.col("p_partkey")).alias("media_id"),
        _text(F.col("p_partkey")).alias("id"),
        F.col("p_name").alias("name"),
        _text(F.col("p_size") * 60.0).alias("duration"),
        F.date_format(F.date_sub("l_shipdate", F.col("l_linenumber")), "yyyy-MM-dd'T'00:00:00'Z'").alias("created"),
        # Versions of a month have one time, so the day that delivered them decides.
        F.date_format("l_shipdate", "yyyy-MM-'01T00:00:00+00:00'").alias("updated"),
        F.col("l_linestatus").alias("status"),
        F.when(F.col("l_returnflag") == "R", "true").otherwise("false").alias("archived"),
        F.col("p_type").alias("section"),
        F.struct(brand.alias("id"), F.col("p_brand").alias("name")).alias("project"),
        F.struct(F.concat(F.lit("https://img.example/"), F.col("p_partkey")).alias("url")).alias("thumbnail"),
        _text(1 - F.col("l_discount")).alias("progress"),
    )


def events_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events")
    n, kind = F.col("event_id"), F.col("event_type")
    user = F.col("user_id")
    return df.select(
        F.col("ts").cast("date").alias("dt"),
        F.when(n % 31 != 0, F.concat(F.lit("e"), F.floor(n / 2))).alias("event_key"),
        F.date_format("ts", _ISO).alias("received_at"),
        F.when(n % 41 == 0, "not a time").otherwise(F.date_format("ts", _ISO)).alias("at"),
        kind.alias("event_type"),
        F.when(n % 97 == 0, "").when(n % 89 != 0, _media(df)).alias("media_id"),
        F.when(kind == "error", "")
        .when(kind != "signup", F.concat(F.lit("10.0."), user % 256, F.lit(".1")))
        .alias("ip"),
        F.when(n % 43 == 0, "n/a").otherwise(_text(F.col("value"))).alias("position_s"),
        F.when(n % 53 == 0, "n/a").otherwise(_text(F.col("value") / 500)).alias("percent_viewed"),
        F.when(user % 2 == 0, "US").otherwise("DE").alias("country"),
        F.concat(F.lit("R"), user % 7).alias("region"),
        F.concat(F.lit("City "), user % 11).alias("city"),
        _text(F.when(n % 3 != 0, user / 10)).alias("lat"),
        _text(F.when(n % 3 != 0, user / 20)).alias("lon"),
        F.when(n % 5 == 0, F.concat(F.lit("Org "), user % 13)).alias("org"),
        F.when(kind == "signup", F.concat(F.lit("u"), user, F.lit("@example.com"))).alias("email"),
        _text(user).alias("visitor_key"),
        F.when(
            (kind == "purchase") & (n % 2 == 0),
            F.concat(F.lit('{"a":{"b":{"c":{"d":'), n, F.lit(',"org":{"name":"A ]}[x","l":[1,{"ip":"1"}]},"z":[[{"ip":null}]]}}}}')),
        )
        .when(kind == "purchase", F.concat(F.lit('{"email":"u'), user, F.lit('@example.com","n":'), n, F.lit("}")))
        .alias("conversion_data"),
    )


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(media_id, value): events as JSON lines, some of them cut off, some with a field of a wrong shape."""
    df = table(spark, sf_dir, "events")
    n = F.col("event_id")
    key = F.when(n % 31 != 0, F.concat(F.lit("e"), F.floor(n / 2)))
    whole = F.to_json(F.struct(key.alias("event_key"), F.date_format("ts", _ISO).alias("received_at"), "event_type"))
    cut = F.concat(F.lit('{"event_key":"e'), n, F.lit('","received_at'))
    odd = F.concat(F.lit('{"event_key":"p'), n, F.lit('","event_type":"odd","user_agent_details":"x'), n, F.lit('"}'))
    return df.select(_media(df).alias("media_id"), F.when(n % 37 == 0, cut).when(n % 41 == 0, odd).otherwise(whole).alias("value"))


def by_date_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events")
    days = df.groupBy(F.col("ts").cast("date").alias("dt"), _media(df).alias("media_id")).agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("user_id").alias("u"),
        F.count_if(F.col("event_type") == "view").alias("v"),
    )
    odd = F.col("media_id").cast("bigint") % 7 == 0
    return days.select(
        "dt",
        "media_id",
        _text(F.col("dt")).alias("date"),
        F.when(odd, "n/a").otherwise(_text(F.col("n"))).alias("load_count"),
        _text(F.col("v").cast("double")).alias("play_count"),
        _text(F.col("v") / F.col("n")).alias("play_rate"),
        _text(F.col("n") / 64).alias("engagement"),
        _text(F.col("u")).alias("visitors"),
    )


def event_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON text with values of several types under the same key."""
    df = table(spark, sf_dir, "events")
    n = F.col("event_id")
    quoted = F.concat(F.lit('"'), F.date_format("ts", _ISO), F.lit('"'))
    percent = (
        F.when(n % 10 == 0, "null")
        .when(n % 10 == 1, '"n/a"')
        .when(n % 10 == 2, "1")
        .otherwise(F.concat(F.lit("0."), F.lpad(_text(n % 90 + 5), 2, "0"), F.lit("5")))
    )
    pairs = [
        F.concat(F.lit('"event_key":"e'), n, F.lit('"')),
        F.concat(F.lit('"received_at":'), quoted),
        F.concat(F.lit('"event_type":"'), F.col("event_type"), F.lit('"')),
        F.concat(F.lit('"percent_viewed":'), percent),
        F.concat(F.lit('"mobile":'), F.when(n % 2 == 0, "true").otherwise("false")),
        F.concat(F.lit('"props":'), F.when(n % 4 == 0, '["a",1]').otherwise(F.col("props"))),
    ]
    org = F.when(n % 3 == 0, F.lit(',"org":null')).otherwise(F.lit(""))
    email = F.when(n % 5 == 0, F.concat(F.lit(',"email":"u'), n, F.lit('@example.com"'))).otherwise(F.lit(""))
    value = F.concat(F.lit("{"), F.concat_ws(",", *pairs), org, email, F.lit("}"))
    return df.select(_media(df).alias("media_id"), value.alias("value"))


def probe_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads with time fields in several formats, a quarter of them in `items`, a quarter six containers deep."""
    df = table(spark, sf_dir, "events")
    n = F.col("event_id")
    day = F.date_format("ts", "yyyy-MM-dd")
    record = F.concat(
        F.lit('{"created_at":"'),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.lit('","updated":'),
        F.when(n % 3 == 0, F.concat(F.lit('"'), day, F.lit('"'))).when(n % 3 == 1, '"soon"').otherwise("12"),
        F.lit(',"modified":"'),
        F.date_format("ts", _ISO),
        F.lit('"}'),
    )
    wrapped = F.concat(F.lit('{"items":['), record, F.lit("]}"))
    deep = F.concat(F.lit('[[[{"items":[{"items":[['), record, F.lit("]]}]}]]]"))
    value = F.when(n % 2 == 0, record).when(n % 4 == 1, wrapped).otherwise(deep)
    return df.select(_media(df).alias("media_id"), value.alias("value"))


def run_status_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A status log derived from the events: one entry each, steps and states from their type and number."""
    n = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("day#"), F.col("ts").cast("date")).alias("run_date"),
        F.upper("event_type").alias("data_in_process"),
        F.when(n % 3 == 0, "STARTED").when(n % 3 == 1, "SUCCEEDED").otherwise("FAILED").alias("status"),
        F.col("ts").cast("timestamp").alias("updated_at"),
    )
