"""Substring dedup: passages that several documents share, and near copies of paragraphs.

A repeated passage may stand anywhere in a text, so the paragraphs compared are of two kinds.

- Running paragraphs: the PASSAGE words from every word on. Not each is written out. The anchor of a paragraph is the least
  hash of its runs of ANCHOR words, so equal paragraphs have equal anchors, wherever they stand (winnowing). Consecutive
  paragraphs of one anchor are a block, about one for 13 words. Blocks meet by their anchor: where all holders have the
  same block, all its paragraphs are shared; else the paragraphs of each different block are compared one by one.
- Written paragraphs: the lines of PASSAGE words or more. Their MinHash signature is cut into BANDS bands of ROWS rows;
  paragraphs that collide in a band are compared on their full sets of 5-word shingles (`near_dedup.classes`). At
  similarity 0.75 a pair collides with probability 1 - (1 - 0.75 ** 2) ** 10 = 0.9997.

Equal running paragraphs are one class, and near paragraphs one component; of each, the document of the smallest id keeps
its occurrences and all other documents lose theirs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelstat.llm.near_dedup import PERCENT, classes, keyed
from reelstat.llm.scratch import save
from reelstat.llm.shingles import STEP, minhashes, mixed, multipliers, split_words, word_hashes

PASSAGE = 50
ANCHOR = 25
BANDS, ROWS = 10, 2
FIRST = -(2**63)  # stands for a null id, which is before all others
INVERSE = np.uint64(pow(int(STEP), -1, 2**64))


def banded(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    values = minhashes(shingles, bounds, multipliers(BANDS * ROWS, seed=2)).reshape(-1, BANDS, ROWS)
    return keyed(mixed(values[:, :, 0] * STEP + values[:, :, 1]))


def word_bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-last byte of each word of a UTF-8 text."""
    inside = np.concatenate([[False], ~((raw == 32) | ((raw >= 9) & (raw <= 13))), [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


class Runs:
    """Hashes of runs of a text's words, each from two sums over all words before."""

    def __init__(self, hashes: np.ndarray) -> None:
        powers = np.full(len(hashes) + 1, STEP)
        inverses = np.full(len(hashes) + 1, INVERSE)
        powers[0] = inverses[0] = 1
        self.inverses = np.cumprod(inverses)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * np.cumprod(powers)[:-1], dtype=np.uint64)])

    def __call__(self, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
        value = (self.sums[starts + lengths] - self.sums[starts]) * self.inverses[starts]
        return mixed(value + np.asarray(lengths).astype(np.uint64) * STEP)


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The least of `width` consecutive values, from each that has as many."""
    least, have = values, 1
    while have < width:
        step = min(have, width - have)
        least, have = np.minimum(least[: len(least) - step], least[step:]), have + step
    return least


def blocks_of(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First paragraph, number of paragraphs, anchor and hash of each block of a text."""
    n = len(hashes) - PASSAGE + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    runs = Runs(hashes)
    anchors = least_of(runs(np.arange(len(hashes) - ANCHOR + 1), ANCHOR), PASSAGE - ANCHOR + 1)
    starts = np.concatenate([[0], np.flatnonzero(anchors[1:] != anchors[:-1]) + 1])
    counts = np.diff(np.append(starts, n))
    return starts, counts, anchors[starts], runs(starts, counts + PASSAGE - 1)


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [blocks_of(word_hashes(split_words(text.as_py()))) for text in batch.column("text")]
        take = pa.array(np.repeat(np.arange(len(found)), [len(x[0]) for x in found]))
        starts, counts, anchors, hashes = (np.concatenate(x) for x in zip(*found)) if found else blocks_of(np.zeros(0))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id").take(take),
                batch.column("text_hash").take(take),
                pa.array(starts.astype(np.int32)),
                pa.array(counts.astype(np.int32)),
                pa.array(anchors.view(np.int64)),
                pa.array(hashes.view(np.int64)),
            ],
            ["id", "text_hash", "start", "n", "anchor", "block"],
        )


def _paragraphs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The paragraphs of the blocks that are wanted of each text."""
    names = ["anchor", "block", "at", "hash", "first", "last"]
    for batch in batches:
        for text, wanted in zip(batch.column("text"), batch.column("wanted")):
            runs = Runs(word_hashes(split_words(text.as_py())))
            block = {name: wanted.values.field(name).to_numpy() for name in ("start", "n", *names[:2], *names[4:])}
            take = np.repeat(np.arange(len(block["n"])), block["n"])
            at = np.arange(len(take)) - np.repeat(np.cumsum(block["n"]) - block["n"], block["n"])
            block |= {"at": at.astype(np.int32), "hash": runs(block["start"][take] + at, PASSAGE).view(np.int64)}
            columns = [pa.array(block[name] if name in ("at", "hash") else block[name][take]) for name in names]
            yield pa.RecordBatch.from_arrays(columns, names)


def _equal(named: DataFrame) -> DataFrame:
    """(id, text_hash, start, end, first): the running paragraphs that several documents hold; consecutive ones of the same
    first document are one span. Equal paragraphs have equal anchors, so both hashes together tell them apart."""
    blocks = "id long, text_hash long, start int, n int, anchor long, block long"
    running = save(named.select("id", "text_hash", "text").mapInArrow(_running, blocks))
    shared = running.groupBy("anchor").agg(
        F.min("id").alias("first"), F.max("id").alias("last"), (F.min("block") < F.max("block")).alias("differ")
    )
    met = save(running.join(shared.where("first < last").select("anchor", "first", "differ"), "anchor"))
    span = lambda at, n: [(F.col("start") + at).alias("start"), (F.col("start") + at + n + PASSAGE - 1).alias("end")]
    whole = met.where("not differ").select("id", "text_hash", *span(F.lit(0), F.col("n")), "first")
    apart = met.where("differ").drop("first", "differ")
    different = apart.groupBy("anchor", "block").agg(
        F.min(F.struct("id", "text_hash", "start", "n")).alias("one"), F.max("id").alias("last")
    )
    one = different.select("one.*", "anchor", "block", F.col("one.id").alias("first"), "last")
    wanted = F.collect_list(F.struct("start", "n", "anchor", "block", "first", "last")).alias("wanted")
    texts = named.join(one.groupBy("id", "text_hash").agg(wanted), ["id", "text_hash"]).select("text", "wanted")
    each = "anchor long, block long, at int, hash long, first long, last long"
    paragraphs = save(texts.mapInArrow(_paragraphs, each))
    held = paragraphs.groupBy("anchor", "hash").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    kept = paragraphs.select("anchor", "block", "at", "hash").join(held.where("first < last").drop("last"), ["anchor", "hash"])
    rank = F.dense_rank().over(Window.partitionBy("anchor", "block", "first").orderBy("at"))
    parts = kept.withColumn("island", F.col("at") - rank).groupBy("anchor", "block", "first", "island")
    parts = parts.agg(F.min("at").alias("at"), (F.max("at") - F.min("at") + 1).cast("int").alias("count"))
    split = apart.join(parts, ["anchor", "block"])
    return whole.unionByName(split.select("id", "text_hash", *span(F.col("at"), F.col("count")), "first"))


def _written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of PASSAGE words or more, with the numbers of their first and past-the-last word."""
    for batch in batches:
        ids, hashes, starts, ends, lines = [], [], [], [], []
        named = (batch.column("id").to_pylist(), batch.column("text_hash").to_pylist(), batch.column("text"))
        for doc, text_hash, text in zip(*named):
            at = 0
            for line in (text.as_py() or "").encode("utf-8", "surrogatepass").split(b"\n"):
                n = len(line.split())
                if n >= PASSAGE:
                    for column, value in zip((ids, hashes, starts, ends, lines), (doc, text_hash, at, at + n, line)):
                        column.append(value)
                at += n
        columns = [pa.array(x, pa.int64()) for x in (ids, hashes)]
        columns += [pa.array(starts, pa.int32()), pa.array(ends, pa.int32()), pa.array(lines, pa.binary()).cast(pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["id", "text_hash", "start", "end", "text"])


def repeated(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = PERCENT) -> DataFrame:
    """(id, text_hash, start, end, first): each occurrence, in words, of a passage that several documents hold.

    first is the smallest id among them; that document's occurrences are kept. A null id counts as the smallest; rows of
    one id count as one document. Texts of fewer than PASSAGE words hold no passage.
    """
    named = docs.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(FIRST)).alias("id"),
        F.xxhash64(text_column).alias("text_hash"),
        F.col(text_column).alias("text"),
    )
    equal = _equal(named)
    lines = named.mapInArrow(_written, "id long, text_hash long, start int, end int, text string")
    rows = lines.select(F.struct("id", "text_hash", "start", "end").alias("row_id"), "text")
    found = classes(rows, percent, 1, banded).select("row_id.*", "component")
    near = found.groupBy("component").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    return equal.unionByName(found.join(near, "component").select(*equal.columns))


def _words(spans: str):
    """Words inside any of the spans."""
    return F.aggregate(
        F.array_sort(spans),
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda a, s: F.struct(
            F.greatest(a["end"], s["end"]).alias("end"),
            (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], a["end"]))).alias("n"),
        ),
        lambda a: a["n"].cast("long"),
    )


def by_document(spans: DataFrame) -> DataFrame:
    """(id, text_hash, shared, removed, firsts): a row per text that holds a repeated passage."""
    span = F.struct("start", "end")
    return spans.groupBy("id", "text_hash").agg(
        F.collect_set(span).alias("shared"),
        F.collect_set(F.when(F.col("first") < F.col("id"), span)).alias("removed"),
        F.array_sort(F.collect_set("first")).alias("firsts"),
    )


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_repeated, n_removed, first_ids) of the documents that share a passage with another.

    n_repeated: words in shared passages; n_removed: those that the document loses as others hold them first; first_ids:
    the documents that keep them. Documents that share nothing have no row.
    """
    found = by_document(repeated(docs))
    null = lambda c: F.when(c != FIRST, c)
    return found.select(
        null(F.col("id")).alias("doc_id"),
        _words("shared").alias("n_repeated"),
        _words("removed").alias("n_removed"),
        F.transform("firsts", null).alias("first_ids"),
    )


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and the white space after each."""
    raw = text.encode("utf-8")
    starts, _ = word_bounds(np.frombuffer(raw, np.uint8))
    places = [*starts.tolist(), len(raw)]
    kept, at = [], 0
    for start, end in sorted(spans):
        if places[start] > at:
            kept.append(raw[at : places[start]])
        at = max(at, places[end])
    return b"".join([*kept, raw[at:]]).decode("utf-8")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, spans in zip(batch.column("text"), batch.column("removed")):
            spans = [(s["start"], s["end"]) for s in spans.as_py() or ()]
            texts.append(without(text.as_py(), spans) if spans else text.as_py())
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "text"])


def remove_passages(docs: DataFrame) -> DataFrame:
    """The documents, without the passages that a document of a smaller id holds. Documents left without words go."""
    found = save(by_document(repeated(docs)).select("id", "text_hash", "removed").where(F.size("removed") > 0))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row")
    keyed_docs = docs.select(
        row, "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST)).alias("id"), F.xxhash64("text").alias("text_hash")
    )
    hit = keyed_docs.join(found, ["id", "text_hash"])
    cut = hit.select("row", "text", "removed").mapInArrow(_cut, hit.select("row", "text").schema)
    cut = cut.where(F.col("text").rlike("[^\\x20\\x09-\\x0D]"))
    rest = keyed_docs.join(found, ["id", "text_hash"], "left_anti").select("row", "text")
    both = rest.unionByName(cut)
    return both.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
