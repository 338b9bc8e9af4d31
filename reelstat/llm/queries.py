"""One query per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstat.llm import (
    decontaminate,
    licenses,
    merkle,
    near_dedup,
    packing,
    paragraph_dedup,
    periodic_runs,
    quality,
    site_tree,
    token_files,
    toxicity,
    url_filter,
    warc,
)
from reelstat.llm.scratch import folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_SQL_WORDS = """list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"""

ORACLES["op3_benchmark_decontamination"] = f"""
WITH docs AS (SELECT doc_id, {_SQL_WORDS} AS words FROM documents),
items AS (SELECT item_id, {_SQL_WORDS} AS words FROM benchmark),
known AS (
    SELECT DISTINCT item_id, least(len(words), 13) AS length, array_to_string(words[i : i + least(len(words), 13) - 1], ' ') AS w
    FROM (SELECT *, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS i FROM items WHERE len(words) > 0)),
placed AS (
    SELECT doc_id, length, i, array_to_string(words[i : i + length - 1], ' ') AS w
    FROM (SELECT *, unnest(range(1, len(words) - length + 2)) AS i FROM docs, (SELECT DISTINCT length FROM known))),
hits AS (SELECT doc_id, item_id, i, placed.length FROM placed JOIN known USING (w, length)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + length)) AS p FROM hits) GROUP BY 1),
held AS (SELECT doc_id, string_agg(name, ',' ORDER BY name) AS names, count(*) AS n
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM hits) GROUP BY 1)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(covered.n, 0) AS n_hit, coalesce(held.n, 0) AS n_items,
    sha256(coalesce(names, '')) AS items_sha256, coalesce(covered.n > 0 AND 20 * covered.n >= len(words), false) AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN held USING (doc_id)
"""


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"), carried=["doc_id"])


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraph_dedup.report(table(spark, sf_dir, "documents"))


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: The rules of the contract, as host, path and verdict.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@query
def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judged(table(spark, sf_dir, "pages"), rules)


ORACLES["op5_url_filters"] = """
WITH cut AS (
    SELECT page_id, regexp_extract(CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END,
        '^[^?#]*') AS rest FROM pages),
parts AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        substr(rest, length(regexp_extract(rest, '^[^/]*')) + 1) AS path FROM cut),
matched AS (
    SELECT *, '.' || host AS dotted, CASE
        WHEN suffix('.' || host, '.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
        WHEN suffix('.' || host, '.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
        WHEN suffix('.' || host, '.com') AND starts_with(path, '/') THEN 'com/'
        WHEN suffix('.' || host, '.net') AND starts_with(path, '/es/') THEN 'net/es/'
        WHEN suffix('.' || host, '.net') AND starts_with(path, '/fr/') THEN 'net/fr/' END AS rule
    FROM parts)
SELECT page_id, host, path, rule,
    CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM matched
"""


@query
def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_tree.extract(table(spark, sf_dir, "pages"))


@query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query
def op8_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.recognised(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def planted_text(doc_id: Column, text: Column) -> Column:
    """The texts in which runs are looked for: in a tenth of them all words from one on repeat with a period."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    g = F.floor(h / 10)

    def repeated(w: Column) -> Column:
        n = F.size(w)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
        return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(w, place(i))), " ")

    made = F.get(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w))), F.lit(0))
    return F.coalesce(F.when(h % 10 == 0, made), text)


@query
def op11_periodic_run_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = periodic_runs.find_runs(docs.select("doc_id", planted_text(F.col("doc_id"), F.col("text")).alias("text")))
    # The greatest length / period: compared as fractions, by cross-multiplying.
    more = lambda a, b: a["length"] * b["period"] - b["length"] * a["period"]
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda a, b: F.when(more(b, a) > 0, b).otherwise(a))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.select("doc_id", "runs", "collapsed", best.alias("best"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = folder(spark)
    token_files.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    ids = F.col("ids")
    return token_files.read(spark, path).select(
        "doc_id", "start", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.crc32(ids).alias("ids_crc32")
    )


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    text, doc_id = F.col("text"), F.col("doc_id").cast("string").cast("binary")
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.when(F.crc32(doc_id) % 5 == 0, lower).otherwise(text)
    found = merkle.proofs(table(spark, sf_dir, "documents"), tampered)
    path = F.col("path")
    folded = merkle.folded(F.col("other"), path)
    proof = merkle.digest(merkle.siblings(path)).alias("proof_sha256")
    out = found.select("doc_id", "leaf", "subroot", "root", proof, folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql_spelt(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _sql_merkle(levels: int) -> str:
    """Levels one by one; the path of a row is what its nodes have beside them, level by level."""
    crc = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(doc_id::VARCHAR) + 1),
        lambda i: ascii(substr(doc_id::VARCHAR, i::BIGINT, 1))::BIGINT)), lambda c, b: list_reduce(
        list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295::BIGINT)"""
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    head = " || ".join(map(_sql_spelt, ("doc_id", "source", "lang", "n_chars")))
    other = f"CASE WHEN {crc} % 5 = 0 THEN {lower} ELSE text END"
    sql = f"""
WITH leaves AS (
    SELECT doc_id, coalesce('=' || source, '') AS tree, sha256({head} || {_sql_spelt('text')}) AS leaf,
        sha256({head} || {_sql_spelt(f'({other})')}) AS other FROM documents),
a0 AS (SELECT tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, doc_id, leaf, other,
    count(*) OVER (PARTITION BY tree) AS n, leaf AS digest, leaf AS own, other AS fold, '' AS proof FROM leaves)"""
    step = lambda new, old, keys, kept: f""",
{new}_nodes AS (SELECT DISTINCT {keys}, i, n, digest FROM {old}),
{new}_runs AS (SELECT {keys}, i // 16 AS i, string_agg(digest, '' ORDER BY i) AS joined, list(digest ORDER BY i) AS digests
    FROM {new}_nodes GROUP BY ALL),
{new} AS (SELECT {kept}, {old}.i // 16 AS i, (n + 15) // 16 AS n,
    CASE WHEN n = 1 THEN digest ELSE sha256(joined) END AS digest,
    CASE WHEN n = 1 THEN fold ELSE sha256(array_to_string(digests[: {old}.i % 16], '') || fold
        || array_to_string(digests[{old}.i % 16 + 2 :], '')) END AS fold,
    CASE WHEN n = 1 THEN proof ELSE proof || array_to_string(digests[: {old}.i % 16], '')
        || array_to_string(digests[{old}.i % 16 + 2 :], '') END AS proof
    FROM {old} JOIN {new}_runs ON {' AND '.join(f'{old}.{k} = {new}_runs.{k}' for k in keys.split(', '))} AND {old}.i // 16 = {new}_runs.i)"""  # noqa: E731
    for k in range(levels):
        sql += step(f"a{k + 1}", f"a{k}", "tree", f"a{k}.tree, doc_id, leaf, other")
    sql += f""",
b0 AS (SELECT 0 AS tree, dense_rank() OVER (ORDER BY tree) - 1 AS i, (SELECT count(DISTINCT tree) FROM leaves) AS n, digest,
    digest AS subroot, doc_id, leaf, fold, proof FROM a{levels})"""
    for k in range(levels):
        sql += step(f"b{k + 1}", f"b{k}", "tree", f"b{k}.tree, subroot, doc_id, leaf")
    return sql + f"""
SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = digest AS verified
FROM b{levels}"""


#: Six levels: sources of up to 16 ** 6 documents, and as many sources.
ORACLES["op13_merkle_manifest"] = _sql_merkle(6)
