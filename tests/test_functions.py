from __future__ import annotations

import hashlib
import hmac
import io
import json
from contextlib import redirect_stdout
from datetime import date, datetime

import pytest
from conftest import values
from pyspark.sql import functions as F

from reelstat.functions.privacy import drop_pii, hmac_column, redact, redact_json
from reelstat.functions.typing import as_count, as_day, as_timestamp, col_or_null, guarded_ratio, stamp
from reelstat.operators.quality import assert_no_pii, pii_columns
from reelstat.schemas import EVENT_PII


def one(spark, text, convert):
    return spark.createDataFrame([(text,)], "x string").select(convert(F.col("x"))).first()[0]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    "text, count",
    [("21", 21), ("21.0", 21), ("21.9", 21), ("9007199254740993", 9007199254740993), ("n/a", None), ("", None), (None, None)],
)
def test_counts(spark, ansi, text, count):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert one(spark, text, as_count) == count
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_malformed_times_are_null(spark):
    assert one(spark, "yesterday-ish", as_timestamp) is None
    assert one(spark, "2025-13-40", as_day) is None
    assert one(spark, "2025-03-04T05:06:07.250Z", lambda c: as_timestamp(c).cast("string")) == "2025-03-04 05:06:07.25"
    assert one(spark, "2025-03-04T05:06:07+02:00", lambda c: as_timestamp(c).cast("string")) == "2025-03-04 03:06:07"


def test_missing_column_is_typed_null(spark):
    df = spark.createDataFrame([("1.5",)], "a string")
    out = df.select(col_or_null(df, "a", "double").alias("a"), col_or_null(df, "b", "bigint").alias("b"))
    assert out.dtypes == [("a", "double"), ("b", "bigint")]
    assert tuple(out.first()) == (1.5, None)


def test_guarded_ratio(spark):
    df = spark.createDataFrame([(1, 2), (5, 0), (5, None)], "a bigint, b bigint")
    assert [r[0] for r in df.select(guarded_ratio(F.col("a"), F.col("b"))).collect()] == [0.5, 0.0, 0.0]


def test_stamp_takes_a_given_time(spark):
    at = datetime(2025, 1, 2, 3, 4, 5)
    assert stamp(spark.range(1), "t", at).select(F.col("t").cast("string")).first()[0] == "2025-01-02 03:04:05"
    assert stamp(spark.range(1), "t").first()["t"] is not None


@pytest.mark.parametrize("key", ["short", "k" * 64, "long key " * 12, "ключ"])
def test_hmac_equals_the_standard_library(spark, key):
    texts = ["10.0.0.1", "fe80::1", "ü", None, ""]
    out = hmac_column(spark.createDataFrame([(t,) for t in texts], "ip string"), "ip", key, "h").collect()
    want = [hmac.new(key.encode(), t.encode(), hashlib.sha256).hexdigest() if t else None for t in texts]
    assert [row.h for row in out] == want


def test_hmac_without_a_key_is_null(spark):
    df = spark.createDataFrame([("10.0.0.1",)], "ip string")
    assert hmac_column(df, "ip", None, "h").first()["h"] is None


def test_hmac_key_is_in_no_plan_and_stays_native(spark):
    key = "very-secret-key"
    df = hmac_column(spark.createDataFrame([("10.0.0.1",)], "ip string"), "ip", key, "h")
    df.collect()
    text = io.StringIO()
    with redirect_stdout(text):
        for mode in ("extended", "formatted", "cost", "codegen"):
            df.explain(mode)
    plan = text.getvalue()
    block = key.encode().ljust(64, b"\0")
    secrets = [key, key.encode().hex(), bytes(b ^ 0x36 for b in block).hex(), bytes(b ^ 0x5C for b in block).hex()]
    assert not [s for s in secrets if s.lower() in plan.lower()]
    assert "EvalPython" not in plan and "Join" not in plan


NESTED = (
    "ip string, lat double, note string, org struct<name:string,title:string>, "
    "who struct<email:string,id:int>, tags array<struct<email:string,k:int>>, extra map<string,string>"
)


def nested(spark):
    row = ("1.2.3.4", None, "keep", ("ACME", "CEO"), ("a@x", 1), [("b@x", 2), (None, 3)], {"email": "c@x", "k": "v"})
    return spark.createDataFrame([row], NESTED)


def test_redact_walks_nested_values(spark):
    row = redact(nested(spark)).first()
    assert (row.ip, row.lat, row.note, row.org) == ("<redacted>", None, "keep", "<redacted>")
    assert (row.who.email, row.who.id) == ("<redacted>", 1)
    assert [tuple(t) for t in row.tags] == [("<redacted>", 2), (None, 3)]
    assert row.extra == {"email": "<redacted>", "k": "v"}


def test_redact_catalog_form_also_hides_nulls(spark):
    row = redact(nested(spark), ("email",), null_too=True).first()
    assert row.org.name == "ACME" and row.ip == "1.2.3.4"
    assert [tuple(t) for t in row.tags] == [("<redacted>", 2), ("<redacted>", 3)]


def test_redact_keeps_null_structs(spark):
    df = spark.createDataFrame([(None,)], "who struct<email:string,id:int>")
    assert redact(df).first()["who"] is None


def test_redacted_maps_hold_the_text_beside_their_values(spark):
    columns = "m map<string,int>, s map<string,struct<ip:string,n:int>>, k map<int,struct<ip:string,n:int>>"
    df = spark.createDataFrame([({"email": 1, "x": 2, "ip": None}, {"org": ("1", 2), "y": ("1", 3)}, {7: ("1", 4)})], columns)
    row = redact(df).select(F.to_json("m").alias("m"), F.to_json("s").alias("s"), "k").first()
    assert json.loads(row.m) == {"email": "<redacted>", "x": 2, "ip": None} or json.loads(row.m) == {"email": "<redacted>", "x": 2}
    assert json.loads(row.s) == {"org": "<redacted>", "y": {"ip": "<redacted>", "n": 3}}
    assert tuple(row.k[7]) == ("<redacted>", 4)


@pytest.mark.parametrize("depth", [0, 1, 2, 3])
@pytest.mark.parametrize("null_too", [False, True])
def test_redaction_does_not_depend_on_depth(spark, depth, null_too):
    from reelstat.functions.privacy import redact_json

    def clean(value):
        if isinstance(value, list):
            return [clean(v) for v in value]
        if not isinstance(value, dict):
            return value
        return {k: "<redacted>" if k in EVENT_PII and (null_too or v is not None) else clean(v) for k, v in value.items()}

    deep = {"d": 1, "org": {"name": 'A ]}[x" \\', "ip": [1]}, "lat": None, "l": [[{"ip": "1", "k": [True, None, 1.5]}], []], "e": {}}
    values = [deep, {"a": {"b": {"c": deep, "email": [deep]}}}, [[[[deep, {"city": {}}]]]], {"note": '"email":"x"', "x": "\\"}]
    nested = deep
    for i in range(20):
        nested = {"n": nested, "ip": i} if i % 2 else [nested, {"lon": None}]
    texts = [json.dumps(v) for v in [*values, nested, {"a": {"b": {"c": {"d": "long" * 20_000, "email": "y" * 50_000}}}}]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    out = df.select("i", redact_json(F.col("t"), null_too=null_too, depth=depth).alias("c")).orderBy("i").collect()
    assert [json.loads(r.c) for r in out] == [clean(json.loads(t)) for t in texts]


@pytest.mark.parametrize(
    "text, clean",
    [
        ('{"a":1,"email":"x"}', '{"a":1,"email":"<redacted>"}'),
        ('{"email":null}', '{"email":null}'),
        ('{"org":{"name":"x"},"l":[{"ip":"1"},2]}', '{"l":[{"ip":"<redacted>"},2],"org":"<redacted>"}'),
        ('{"a":{"b":{"c":{"d":{"email":"x"}}}}}', '{"a":{"b":{"c":{"d":{"email":"<redacted>"}}}}}'),
        ('{"a":{"b":{"c":{"d":{"e":1.5}}}}}', '{"a":{"b":{"c":{"d":{"e":1.5}}}}}'),
        ("[]", "[]"),
        ("7", "7"),
        ("not json, a@x.com", "<redacted>"),
        (None, None),
    ],
)
def test_redact_json_at_any_depth(spark, text, clean):
    assert one(spark, text, redact_json) == clean


def test_pii_check_sees_every_depth(spark):
    df = nested(spark)
    assert pii_columns(df.schema) == ["ip", "lat", "org", "who.email", "tags.email"]
    with pytest.raises(ValueError, match="who.email"):
        assert_no_pii(drop_pii(df))
    flat = spark.createDataFrame([(date(2025, 1, 1), "US", "x")], "dt date, country string, email string")
    assert values(assert_no_pii(drop_pii(flat)), "dt", "country") == [(date(2025, 1, 1), "US")]


def test_deep_redaction_keeps_the_rest(spark):
    from reelstat.functions.privacy import redact_json

    texts = [
        '{"a":{"b":{"c":{"d":1,"email":"x","e":[{"ip":{"v":1},"k":true}]}}}}',
        '{"a":{"b":{"c":{"d":1,"email":null}}}}',
        '{"a":{"b":{"c":{"note":"the \\"email\\":\\"x\\" field"}}}}',
    ]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [json.loads(r.c) for r in rows.select("i", redact_json(F.col("t")).alias("c")).orderBy("i").collect()]
    assert got[0] == {"a": {"b": {"c": {"d": 1, "email": "<redacted>", "e": [{"ip": "<redacted>", "k": True}]}}}}
    assert got[1] == json.loads(texts[1]) and got[2] == json.loads(texts[2])
