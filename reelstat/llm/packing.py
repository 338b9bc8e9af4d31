"""Packing by shortest-pack-first over the length histogram.

Documents are tokenised once; each becomes pieces of at most `capacity` ids, full ones and a rest. The histogram of piece
lengths has at most `capacity` rows, whatever the corpus, and only it reaches the driver. There lengths are placed
longest first, each into the pattern that has the least room left and still fits, so whole groups of sequences are
planned at once and the plan has at most two patterns per length. Pieces are then numbered within their length and find
their pattern, sequence and offset by that rank. No sequence, piece or document passes through the driver.
"""

from __future__ import annotations

import re
import sys
import unicodedata
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.llm.scratch import save

CAPACITY = 2048
END_ID = 1
SALTS = 64
CACHED_WORDS = 500_000
BLOCK_CHARS = 4_000_000  # of texts whose words are looked up together
#: A run of punctuation between an ASCII letter and white space. No apostrophe: the tokenizer takes 's and the like as units.
AFTER_LETTERS = re.compile(rb"(?<=[a-z])([.,;:!?%&$*#|]+)(?![^ \t-\r])")


#: Byte-level models spell a byte by its Latin-1 character where that is printable, the others by 256, 257, ... in order.
PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
SPELT = {byte: 256 + i for i, byte in enumerate(b for b in range(256) if b not in PRINTABLE)}


def little_endian(ids: list[int]) -> bytes:
    numbers = array("I", ids)
    if sys.byteorder == "big":
        numbers.byteswap()
    return numbers.tobytes()


class Encoder:
    """Ids of texts as little-endian 32-bit bytes.

    The tokenizer lower-cases, never joins across ASCII white space, and takes punctuation after letters apart from them.
    So texts are lower-cased and cut there first, and each different word is encoded once and cached. A word of letters
    goes to the tokenizer's model at once, with bytes spelt as byte-level models spell them; all else takes the whole
    way. The cache is emptied when it holds CACHED_WORDS, which bounds its memory and changes no result.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words: dict[bytes, bytes] = {}

    def _add(self, words: list[bytes]) -> None:
        tokenize, odd = self.tokenizer.model.tokenize, []
        for word in words:
            text = word.decode("utf-8")
            if text.isascii():
                text, spelt = text.lower(), text.lower()
            else:
                text = "".join([c.lower() for c in unicodedata.normalize("NFC", text)])
                spelt = text.encode("utf-8").decode("latin-1").translate(SPELT)
            if text.isalpha():
                self.words[word] = little_endian([token.id for token in tokenize(spelt)])
            else:
                odd.append(word)
        for start in range(0, len(odd), 2000):
            block = [word.decode("utf-8") for word in odd[start : start + 2000]]
            for word, found in zip(odd[start:], self.tokenizer.encode_batch_fast(block, add_special_tokens=False)):
                self.words[word] = little_endian(found.ids)

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        split = [self._cut(text.encode("utf-8")) for text in texts]
        distinct = set().union(*split)
        missing = list(distinct - self.words.keys())
        if len(self.words) + len(missing) > CACHED_WORDS:
            self.words, missing = {}, list(distinct)
        self._add(missing)
        return (b"".join(map(self.words.__getitem__, words)) for words in split)

    @staticmethod
    def _cut(raw: bytes) -> list[bytes]:
        if b"<|" in raw:  # special tokens are looked for before lower-casing
            return raw.split()
        return AFTER_LETTERS.sub(rb" \1", raw.lower()).split()


def _encoded(encode: Encoder, texts: pa.Array) -> Iterator[bytes]:
    block, size = [], 0
    for text in texts:
        block.append(text.as_py() or "")
        size += len(block[-1])
        if size >= BLOCK_CHARS:
            yield from encode(block)
            block, size = [], 0
    yield from encode(block)


def _pieces(path: str, capacity: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores
        encode, end = Encoder(path), np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            for doc_id, ids in zip(batch.column(0).to_pylist(), _encoded(encode, batch.column(1))):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    part = memoryview(ids)[4 * start : 4 * (start + capacity)]
                    for column, value in zip(rows, (doc_id, start, len(part) // 4, zlib.crc32(part), total)):
                        column.append(value)
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            yield pa.RecordBatch.from_arrays([pa.array(r, pa.int64()) for r in rows], names)

    return cut


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """Patterns (sequences, {length: pieces in each}): shortest pack first.

    A length goes to the open patterns with the least room that still hold it, as often as they have room; a pattern of
    which only some sequences are needed is split in two. What is left opens a new pattern.
    """
    patterns: list[list] = []  # [sequences, {length: pieces}, room]
    open_: list[tuple[int, int]] = []  # (room, index), ascending
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            at = bisect_left(open_, (length, -1))
            if at == len(open_):
                fits = capacity // length
                for pieces in (fits, left % fits):
                    count = left // fits if pieces == fits else 1
                    if pieces and count and left:
                        patterns.append([count, {length: pieces}, capacity - pieces * length])
                        insort(open_, (patterns[-1][2], len(patterns) - 1))
                        left -= count * pieces
                continue
            room, index = open_.pop(at)
            count, held, _ = patterns[index]
            each = min(room // length, left)
            used = min(count, left // each)
            if used < count:
                patterns.append([count - used, dict(held), room])
                insort(open_, (room, len(patterns) - 1))
            patterns[index] = [used, {**held, length: each}, room - each * length]
            left -= used * each
            if patterns[index][2]:
                insort(open_, (patterns[index][2], index))
    return [(count, held) for count, held, _ in patterns]


def _slots(patterns: list[tuple[int, dict[int, int]]]) -> dict[int, list[np.ndarray]]:
    """By length: for ascending ranks, where each pattern's share begins, its pieces a sequence, first sequence, offset."""
    out: dict[int, list[list[int]]] = {}
    sequence = 0
    for count, held in patterns:
        offset = 0
        for length, each in held.items():
            begin, pieces, first, at = out.setdefault(length, [[0], [], [], []])
            begin.append(begin[-1] + count * each)
            pieces.append(each)
            first.append(sequence)
            at.append(offset)
            offset += length * each
        sequence += count
    return {length: [np.asarray(x, np.int64) for x in columns] for length, columns in out.items()}


def _placed(slots):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = (batch.column(name).to_numpy() for name in ("length", "rank"))
            sequence, offset = np.empty(len(ranks), np.int64), np.empty(len(ranks), np.int64)
            for length in np.unique(lengths):
                begin, pieces, first, at = slots.value[int(length)]
                rows = np.flatnonzero(lengths == length)
                share = np.searchsorted(begin, ranks[rows], "right") - 1
                inside = ranks[rows] - begin[share]
                sequence[rows] = first[share] + inside // pieces[share]
                offset[rows] = at[share] + inside % pieces[share] * length
            kept = batch.drop_columns(["rank"])
            yield kept.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    return place


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_column: str = "doc_id", text_column: str = "text"):
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) per piece.

    Null or empty text: a piece of the closing id alone. Ids may be null or repeat; every row is a document of its own.
    Sequences are filled from offset 0 without gaps; what a sequence lacks to `capacity` is padding.
    """
    spark = docs.sparkSession
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    pieces = save(source.mapInArrow(_pieces(tokenizer, capacity), schema))
    # A length may hold a third of all pieces: ranks are given within salted parts of it, shifted by the parts before.
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(_salts(pieces))))
    counts = save(salted.groupBy("length", "salt").count())
    total = {row.length: row.n for row in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    before = (
        "coalesce(sum(count) over (partition by length order by salt rows between unbounded preceding and 1 preceding), 0)"
    )
    shifts = counts.select("length", "salt", F.expr(before).alias("shift"))
    within = F.expr("row_number() over (partition by length, salt order by doc_id, start, ids_crc32)")
    ranked = salted.withColumn("within", within).join(shifts, ["length", "salt"])
    ranked = ranked.select(*pieces.columns, (F.col("shift") + F.col("within") - 1).alias("rank"))
    slots = spark.sparkContext.broadcast(_slots(plan(total, capacity)))  # at most two patterns per length
    return ranked.mapInArrow(_placed(slots), schema + ", sequence_id long, offset long")


def _salts(pieces: DataFrame) -> int:
    """Parts of about 100,000 pieces at the largest, 64 at least."""
    return max(SALTS, -(-pieces.count() // 100_000))
