"""URL rules by a cascade of Bloom filters.

A url's keys are its host and each parent domain of it, with each beginning of its path that is as long as some rule's
path. The universe is the distinct keys of the whole corpus. Level 1 encodes the listed keys, level 2 the keys of the
universe that level 1 takes for listed though they are not, level 3 the listed keys that level 2 takes for those, and so
on until a level errs on no key. For every key of the universe the first level that does not hold it tells whether it is
listed, without error; no table is joined to the urls.

Only the levels' bits are broadcast. A level takes BITS_PER_KEY bits for each key it encodes and more where it is tested
on many more keys than it encodes, so that it errs on fewer keys than it encodes: the levels shrink, and their size follows
the listed keys and the logarithm of the corpus. Levels that would exceed MAX_BYTES together are not built: the urls' keys
are joined to the list instead, which gives the same answer.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.llm.native_text import lower_ascii, unused
from reelstat.llm.scratch import save

BITS_PER_KEY = 12
BUCKET = 32_768  # bits of one row of bitmap_construct_agg
MAX_BYTES = 64_000_000


def hosts_and_paths(pages: DataFrame, url_column: str = "url") -> DataFrame:
    """Adds host (after the first ://, up to / ? # or the end, A-Z lower-cased) and path (up to ? or #); else both empty."""
    url = F.coalesce(F.col(url_column), F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substring(`{url_column}`, instr(`{url_column}`, '://') + 3)"))
    rest = F.regexp_extract(F.coalesce(rest, F.lit("")), "(?s)^[^?#]*", 0)
    name = unused(pages, "_rest")
    split = pages.withColumn(name, rest)
    host = lower_ascii(F.regexp_extract(name, "(?s)^[^/]*", 0))
    path = F.expr(f"substring({name}, char_length(regexp_extract({name}, '(?s)^[^/]*', 0)) + 1)")
    return split.withColumn("host", host).withColumn("path", path).drop(name)


def _candidates(split: DataFrame, lengths: list[int]) -> DataFrame:
    """Adds keys: host or parent domain + beginning of the path, for the path lengths that rules have."""
    labels = F.split("host", "\\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    paths = F.array(*[F.when(F.char_length("path") >= n, F.substring("path", 1, n)) for n in lengths])
    paths = F.array_compact(paths) if lengths else F.array().cast("array<string>")
    keys = F.flatten(F.transform(domains, lambda d: F.transform(paths, lambda p: F.struct(d.alias("d"), p.alias("p")))))
    known = F.when(F.col("host") != "", F.array_distinct(F.transform(keys, lambda k: F.concat(k["d"], F.lit("\n"), k["p"]))))
    return split.withColumn("keys", F.coalesce(known, F.array().cast("array<string>")))


#: A level: its number, its bits' number, how many hashes a key has, its bits.
Level = tuple[int, int, int, bytes]


def _size(n: int, others: int) -> tuple[int, int]:
    """Bits and hashes of a level for n keys that is tested on so many others: it errs on n / 8 of them or fewer."""
    per_key = max(BITS_PER_KEY, math.ceil((math.log2(max(others, 1) / n) + 3) / math.log(2))) if others > n else BITS_PER_KEY
    return max(BUCKET, -(-n * per_key // BUCKET) * BUCKET), round(per_key * math.log(2))


def _spots(n_bits: int, hashes: int, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    return (one[:, None] + two[:, None] * np.arange(hashes, dtype=np.uint64)) % np.uint64(n_bits)


def holds(level: Level, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    bits, spots = np.frombuffer(level[3], np.uint8), _spots(level[1], level[2], one, two)
    return ((bits[spots >> np.uint64(3)] >> (spots & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)


def _hashes(number: int):
    return [F.xxhash64(F.lit(number), "key").alias("one"), F.xxhash64("key", F.lit(number)).alias("two")]


def _build(keys: DataFrame, number: int, n_bits: int, hashes: int) -> Level:
    """Each task reduces its keys to bitmaps of BUCKET bits, of which the driver gets one per bucket."""
    hashed = keys.select(*_hashes(number))
    wrapped = hashed.mapInArrow(_places(n_bits, hashes), "place long")
    grouped = wrapped.groupBy(F.floor(F.col("place") / BUCKET).alias("bucket"))
    rows = grouped.agg(F.bitmap_construct_agg(F.col("place") % BUCKET).alias("bits")).collect()
    bits = bytearray(n_bits // 8)
    for row in rows:
        bits[row.bucket * BUCKET // 8 : (row.bucket + 1) * BUCKET // 8] = row.bits
    return number, n_bits, hashes, bytes(bits)


def _places(n_bits: int, hashes: int):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for n in ("one", "two"))
            spots = np.unique(_spots(n_bits, hashes, one, two))
            yield pa.RecordBatch.from_arrays([pa.array(spots.astype(np.int64))], ["place"])

    return place


def _held(level):
    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for n in ("one", "two"))
            yield batch.select(["key"]).filter(pa.array(holds(level.value, one, two)))

    return test


def cascade(listed: DataFrame, universe: DataFrame) -> list[Level] | None:
    """Levels for the (distinct) listed keys among the (distinct) keys of the universe, both with a column key.

    None if they would take more than MAX_BYTES, which is known before a level's bits are gathered.
    """
    spark = universe.sparkSession
    encoded = listed.join(universe, "key", "left_semi")
    others = universe.join(listed, "key", "left_anti")
    levels: list[Level] = []
    encoded = save(encoded)
    others = save(others)
    size, left = 0, others.count()
    while n := encoded.count():
        n_bits, hashes = _size(n, left)
        size, left = size + n_bits // 8, n
        if size > MAX_BYTES:
            return None
        level = _build(encoded, len(levels) + 1, n_bits, hashes)
        levels.append(level)
        sent = spark.sparkContext.broadcast(level)
        wrong = others.select("key", *_hashes(level[0])).mapInArrow(_held(sent), "key string")
        encoded, others = save(wrong), encoded
    return levels


def _first_listed(levels):
    """For each url the longest key that the cascade knows as listed."""
    import xxhash

    def number(value: int) -> bytes:
        return int(value).to_bytes(4, "little")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            flat = batch.column("keys").flatten()
            counts = np.diff(batch.column("keys").offsets.to_numpy())
            keys = flat.to_pylist()
            listed = np.zeros(len(keys), bool)
            left = np.arange(len(keys))
            for depth, level in enumerate(levels.value):
                raw = [keys[i].encode() for i in left]
                # xxhash64(number, key) and xxhash64(key, number) as Spark chains them from seed 42.
                seed = xxhash.xxh64_intdigest(number(level[0]), 42)
                one = np.array([xxhash.xxh64_intdigest(k, seed) for k in raw], np.uint64)
                two = np.array([xxhash.xxh64_intdigest(number(level[0]), xxhash.xxh64_intdigest(k, 42)) for k in raw], np.uint64)
                held = holds(level, one, two)
                listed[left[~held]] = depth % 2 == 1
                left = left[held]
            listed[left] = len(levels.value) % 2 == 1
            at = 0
            for n in counts:
                mine = [keys[i] for i in range(at, at + n) if listed[i]]
                found.append(max(mine, key=lambda k: (len(k), k.index("\n")), default=None))
                at += n
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found, pa.string())], ["row", "found"])

    return judge


def judged(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) per page. Rules: (host, path, verdict), one verdict for a host and path.

    The longest fitting rule decides, of equally long ones that with the longer host; without one the url is not listed
    and gets `default`. A rule fits its host and all its subdomains if the url's path begins with the rule's.
    A null url has an empty host and path and is not listed. Repeated rows each have their row; urls count whole, however
    long; an empty table gives none; further columns of any name are not looked at.
    """
    spark = pages.sparkSession
    rules = save(rules.select((F.concat_ws("\n", "host", "path")).alias("key"), "verdict"))
    lengths = [r.n for r in rules.select(F.char_length(F.substring_index("key", "\n", -1)).alias("n")).distinct().collect()]
    split = _candidates(hosts_and_paths(pages.select("page_id", "url")), sorted(lengths))
    listed = rules.select("key").distinct()
    row = F.struct(F.col("page_id").cast("long").alias("page_id"), "host", "path").alias("row")
    levels = cascade(listed, split.select(F.explode("keys").alias("key")).distinct())
    if levels is None:
        # Equal pages are one group: a row of it comes from each of their keys, or one for each page without keys.
        each = split.select(row, F.greatest(F.size("keys"), F.lit(1)).alias("n"), F.explode_outer("keys").alias("key"))
        each = each.join(listed.withColumn("hit", F.lit(True)), "key", "left")
        best = F.max(F.when(F.col("hit"), F.struct(F.char_length("key"), F.instr("key", "\n"), "key"))).alias("best")
        grouped = each.groupBy("row", "n").agg(best, F.count("*").alias("rows"))
        copies = F.explode(F.sequence(F.lit(1), F.expr("int(rows div n)")))
        found = grouped.select("row", F.col("best.key").alias("found"), copies.alias("copy")).drop("copy")
    else:
        levels = spark.sparkContext.broadcast(levels)
        schema = "row struct<page_id:bigint,host:string,path:string>, found string"
        found = split.select(row, "keys").mapInArrow(_first_listed(levels), schema)
    said = found.join(rules.withColumnRenamed("key", "found"), "found", "left")
    return said.select(
        "row.page_id",
        "row.host",
        "row.path",
        F.regexp_replace("found", "\n", "").alias("rule"),
        F.coalesce("verdict", F.lit(default)).alias("verdict"),
    )
