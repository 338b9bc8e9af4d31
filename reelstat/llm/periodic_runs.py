"""Maximal runs of words that repeat with a period, by a dictionary of basic factors.

The basic factors of a text are its stretches of 1, 2, 4, ... words. Each gets a name, equal stretches the same one; names
of a length come from pairs of names of half that length, and a factor that occurs once is left out from then on, as no
longer factor that begins with it can repeat. Among the positions of a name the next occurrence within twice the factor's
length proposes a period; where these distances stay the same from word to word for more than a period, the occurrences
form arithmetic progressions of three terms at least. Such a stretch is extended to both sides as far as the words agree,
and what several lengths propose is one run.

No run is missed: let q be the smallest period of a run of 4 q words or more, and L the power of two with q <= L < 2 q. A
stretch of L words inside the run occurs next after exactly q words, since the repeated unit is not itself a repetition,
and this holds for q + 2 consecutive positions at least.

Texts are worked off in blocks, each by a few operations on whole arrays; a task holds one block and its words at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_WORDS = 6
LEAST_PERIODS = 4
BLOCK_WORDS = 300_000
STEP = 64
RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
Run = tuple[int, int, int]


class Codes(dict):
    """Words to numbers, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self)
        return code


def _successors(at: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ascending positions: new dense names (-1 if the factor occurs once) and the distance to the next occurrence, or 0."""
    order = np.argsort(names, kind="stable")
    ordered = names[order]
    same = ordered[1:] == ordered[:-1]
    dense = np.concatenate([[0], np.cumsum(~same)]) if len(at) else np.zeros(0, np.int64)
    repeated = np.concatenate([same, [False]]) | np.concatenate([[False], same]) if len(at) else np.zeros(0, bool)
    fresh, distance = np.full(len(at), -1), np.zeros(len(at), np.int64)
    fresh[order[repeated]] = dense[repeated]
    distance[order[:-1][same]] = at[order[1:][same]] - at[order[:-1][same]]
    return fresh, distance


def _stretches(at: np.ndarray, distance: np.ndarray, most: int) -> Iterator[tuple[int, int, int]]:
    """(first, last, distance) of consecutive positions with one distance of at most `most`, longer than that distance."""
    good = (distance > 0) & (distance <= most)
    at, distance = at[good], distance[good]
    if not len(at):
        return
    cut = np.flatnonzero((at[1:] != at[:-1] + 1) | (distance[1:] != distance[:-1])) + 1
    first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(at)]]) - 1
    long = last - first >= distance[first]
    for i, j in zip(first[long].tolist(), last[long].tolist()):
        yield int(at[i]), int(at[j]), int(distance[i])


def _agreeing(left: np.ndarray, right: np.ndarray) -> int:
    """How many words two equally long stretches have in common from their beginning."""
    at, step = 0, STEP
    while at < len(left):
        differ = np.flatnonzero(left[at : at + step] != right[at : at + step])
        if len(differ):
            return at + int(differ[0])
        at, step = at + step, 2 * step
    return len(left)


def block_runs(codes: np.ndarray, sizes: list[int]) -> list[list[Run]]:
    """The runs (start, length, period) of each of several texts that lie one after the other in `codes`, in order."""
    n = len(codes)
    begins = np.cumsum([0, *sizes])
    text = np.repeat(np.arange(len(sizes)), sizes)
    found: list[set[Run]] = [set() for _ in sizes]
    at, names, length = np.arange(n), text * (int(codes.max(initial=0)) + 1) + codes, 1
    while len(at):
        names, distance = _successors(at, names)
        for i, j, period in _stretches(at, distance, 2 * length):
            own = int(text[i])
            low, high = int(begins[own]), int(begins[own + 1])
            words = codes[low:high]
            start, end = i - low, j - low + period + length
            end += _agreeing(words[end:], words[end - period : len(words) - period])
            before = words[:start][::-1]
            start -= _agreeing(before, words[period : start + period][::-1])
            if end - start >= max(LEAST_WORDS, LEAST_PERIODS * period):
                found[own].add((start, end - start, period))
        alive = names >= 0
        named = np.full(n + length, -1)
        named[at[alive]] = names[alive]
        at, names = at[alive], names[alive]
        second = named[at + length]
        both = (second >= 0) & (text[np.minimum(at + length, n - 1)] == text[at])
        at, names = at[both], names[both] * (n + 1) + second[both]
        length *= 2
    return [sorted(runs, key=lambda run: (run[0], run[2])) for runs in found]


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words without those that repeat the first period of a run."""
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep)] if runs else words)


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def block(rows: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        known = Codes()
        codes = np.fromiter((known[word] for words in texts for word in words), np.int64, sum(map(len, texts)))
        runs = block_runs(codes, [len(words) for words in texts])
        clean = [collapsed(words, own).decode("utf-8") for words, own in zip(texts, runs)]
        named = [[{"start": s, "length": n, "period": q} for s, n, q in own] for own in runs]
        return pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(named, RUNS), pa.array(clean, pa.string())], ["doc_id", "runs", "collapsed"])

    for batch in batches:
        rows, texts, size = [], [], 0
        for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
            words = (text.as_py() or "").encode("utf-8").split()
            rows.append(doc_id.as_py())
            texts.append(words)
            size += len(words)
            if size >= BLOCK_WORDS:
                yield block(rows, texts)
                rows, texts, size = [], [], 0
        if rows:
            yield block(rows, texts)


def find_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, runs, collapsed) per row. Words are what space and \\t to \\r leave, numbered from 0.

    runs: array of (start, length, period) by start and period, of all stretches with smallest period q and max(6, 4 q)
    words or more that no neighbouring word extends. collapsed: the words joined by one space, without those that a run
    holds after its first q words.

    Null or empty text: no runs, and an empty text. Ids may be null or repeat; every row has a result of its own. Runs
    that overlap or begin at one word all count. A very long text is a block of its own, in memory proportional to its
    words. Other columns are not looked at, whatever their names. No rows give no rows.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    schema = "doc_id long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return rows.mapInArrow(_found, schema)
