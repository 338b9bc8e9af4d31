"""Pseudonymisation, removal and redaction of personal data, all as native expressions."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelstat.schemas import EVENT_PII, REDACTED

# Fixed values of the HMAC construction (RFC 2104) over SHA-256.
_BLOCK_BYTES = 64
_INNER_PAD = 0x36
_OUTER_PAD = 0x5C


def hmac_column(df: DataFrame, col: str, key: str | bytes | None, out: str) -> DataFrame:
    """Add `out`: lowercase hex HMAC-SHA256 of `col`. NULL and "" give NULL, and so does a missing key.

    The two padded keys come in through scalar subqueries. Written as literals they would show in every plan
    text and event log; as subquery results they are substituted only at run time, and the expression stays in
    whole-stage codegen with no join.
    """
    if not key:
        return df.withColumn(out, F.lit(None).cast("string"))
    raw = key.encode("utf-8") if isinstance(key, str) else key
    block = (hashlib.sha256(raw).digest() if len(raw) > _BLOCK_BYTES else raw).ljust(_BLOCK_BYTES, b"\0")
    pads = df.sparkSession.createDataFrame(
        pa.table(
            {
                "inner": pa.array([bytes(b ^ _INNER_PAD for b in block)], pa.binary()),
                "outer": pa.array([bytes(b ^ _OUTER_PAD for b in block)], pa.binary()),
            }
        )
    )
    inner, outer = pads.select("inner").scalar(), pads.select("outer").scalar()
    text = F.col(col).cast("string")
    digest = F.unhex(F.sha2(F.concat(inner, F.encode(text, "utf-8")), 256))
    return df.withColumn(out, F.when(text != "", F.sha2(F.concat(outer, digest), 256)))


def drop_pii(df: DataFrame, cols: Iterable[str] = EVENT_PII) -> DataFrame:
    """Drop the top-level columns that carry personal data. Country and region stay."""
    return df.drop(*cols)


def redact(df: DataFrame, keys: Iterable[str] = EVENT_PII, null_too: bool = False) -> DataFrame:
    """Replace the whole value under any of `keys`, at any depth, by a fixed text.

    The walk follows the schema at plan time: through structs, arrays and maps. A redacted field becomes a
    string whatever it was. NULL values are kept unless `null_too`.
    """
    keys = frozenset(keys)
    columns = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if field.name in keys:
            columns.append(_mask(value, null_too).alias(field.name))
        elif _mentions(field.dataType, keys):
            columns.append(_walk(value, field.dataType, keys, null_too).alias(field.name))
        else:
            columns.append(value)
    return df.select(*columns)


def _mask(value: Column, null_too: bool) -> Column:
    return F.lit(REDACTED) if null_too else F.when(value.isNotNull(), F.lit(REDACTED))


def _mentions(dtype: T.DataType, keys: frozenset[str]) -> bool:
    """Whether a redacted key can occur inside a value of this type; the others pass through untouched."""
    if isinstance(dtype, T.StructType):
        return any(f.name in keys or _mentions(f.dataType, keys) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _mentions(dtype.elementType, keys)
    return isinstance(dtype, (T.MapType, T.VariantType))


def _walk(value: Column, dtype: T.DataType, keys: frozenset[str], null_too: bool) -> Column:
    if isinstance(dtype, T.StructType):
        fields = [
            (
                _mask(value.getField(f.name), null_too)
                if f.name in keys
                else _walk(value.getField(f.name), f.dataType, keys, null_too)
            ).alias(f.name)
            for f in dtype.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        if not _mentions(dtype.elementType, keys):
            return value
        return F.transform(value, lambda item: _walk(item, dtype.elementType, keys, null_too))
    if isinstance(dtype, T.MapType):
        return _walk_map(value, dtype, keys, null_too)
    if isinstance(dtype, T.VariantType):
        return redact_variant(value, keys, null_too)
    return value


def _walk_map(value: Column, dtype: T.MapType, keys: frozenset[str], null_too: bool) -> Column:
    listed = sorted(keys)

    if not isinstance(dtype.keyType, T.StringType):  # no such key is one of the names
        return F.transform_values(value, lambda _, item: _walk(item, dtype.valueType, keys, null_too))
    plain = isinstance(dtype.valueType, T.StringType)

    def one(key: Column, item: Column) -> Column:
        hit = key.isin(listed) if null_too else key.isin(listed) & item.isNotNull()
        kept = _walk(item, dtype.valueType, keys, null_too)
        return F.when(hit, F.lit(REDACTED) if plain else _masked_variant()).otherwise(kept if plain else _as_variant(kept, dtype.valueType))

    # A map has one value type; one that cannot hold the text becomes a map of variants, which hold it beside the others.
    return F.transform_values(value, one)


def _as_variant(value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_variant_object(value)
    return value if isinstance(dtype, T.VariantType) else value.cast("variant")


def _masked_variant() -> Column:
    return F.parse_json(F.lit(f'"{REDACTED}"'))


# Fixed value: the tokens of JSON text. Strings are matched without backtracking, so their length does not matter.
_TOKENS = r'("[^"\\]*+(?:\\.[^"\\]*+)*+"|[\[\]{},:]|[^\[\]{},:"]++)'


def _redact_text(text: Column, keys: list[str], null_too: bool) -> Column:
    """The same on compact JSON text, at any depth: one pass over its tokens.

    The state is the text so far, the depth, the depth of the value that is being left out (-1: none), the token before,
    and whether the next token begins a value to be replaced.
    """
    quoted = [f'"{key}"' for key in keys]
    mask = F.lit(f'"{REDACTED}"')
    start = F.struct(
        F.lit("").alias("out"), F.lit(0).alias("depth"), F.lit(-1).alias("skip"), F.lit("").alias("last"), F.lit(False).alias("due")
    )

    def step(state: Column, token: Column) -> Column:
        opens, closes = token.isin("{", "["), token.isin("}", "]")
        depth = state["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0)
        skipping = state["skip"] >= 0
        hidden = state["due"] if null_too else state["due"] & (token != "null")
        written = F.when(skipping, F.lit("")).when(hidden, mask).otherwise(token)
        skip = F.when(skipping, F.when(depth == state["skip"], -1).otherwise(state["skip"])).when(hidden & opens, state["depth"]).otherwise(-1)
        due = ~skipping & (token == ":") & state["last"].isin(quoted)
        made = (F.concat(state["out"], written), depth, skip, token, due)
        return F.struct(*[c.alias(n) for c, n in zip(made, ("out", "depth", "skip", "last", "due"))])

    return F.aggregate(F.regexp_extract_all(text, F.lit(_TOKENS), F.lit(1)), start, step, lambda state: state["out"])


def redact_variant(value: Column, keys: Iterable[str] = EVENT_PII, null_too: bool = False, depth: int = 3) -> Column:
    """Redaction of a payload of unknown shape, at any depth.

    Objects and arrays are rebuilt down to `depth` levels, which costs least. What lies deeper and holds one of the keys is
    redacted in its JSON text, token by token; the result is the same whatever `depth` is.
    """
    listed = sorted(keys)
    name = r'(?<!\\)"(' + "|".join(listed) + r')":'

    def deep(node: Column) -> Column:
        return F.try_parse_json(_redact_text(F.to_json(node), listed, null_too))

    def level(node: Column, left: int) -> Column:
        kind = F.schema_of_variant(node)
        if left == 0:
            return F.when(F.to_json(node).rlike(name), deep(node)).otherwise(node)

        def entry(key: Column, item: Column) -> Column:
            hit = key.isin(listed)
            if not null_too:
                hit = hit & ~F.is_variant_null(item)
            return F.when(hit, _masked_variant()).otherwise(level(item, left - 1))

        as_map = F.try_variant_get(node, "$", "map<string,variant>")
        as_list = F.try_variant_get(node, "$", "array<variant>")
        return (
            F.when(kind.startswith("OBJECT"), F.to_variant_object(F.transform_values(as_map, entry)))
            .when(
                kind.startswith("ARRAY"),
                F.to_variant_object(F.transform(as_list, lambda item: level(item, left - 1))),
            )
            .otherwise(node)
        )

    return F.when(value.isNotNull(), level(value, depth))


def redact_nested(text: Column, keys: Iterable[str] = EVENT_PII) -> Column:
    """`redact_json` for a field that mostly holds plain text: only objects and arrays are touched."""
    return F.when(text.rlike(r"^\s*[\[{]"), redact_json(text, keys)).otherwise(text)


def redact_json(text: Column, keys: Iterable[str] = EVENT_PII, null_too: bool = False, depth: int = 3) -> Column:
    """`redact_variant` over JSON text. Text that is not JSON cannot be walked and is replaced as a whole."""
    parsed = F.try_parse_json(text)
    clean = F.to_json(redact_variant(parsed, keys, null_too, depth))
    return F.when(text.isNotNull(), F.when(parsed.isNotNull(), clean).otherwise(F.lit(REDACTED)))


