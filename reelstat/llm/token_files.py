"""Token ids of documents in Arrow files of fixed-size lists.

Documents are sorted by id over the cluster, encoded in that order and appended to one stream of ids, which is cut into
shards. A shard is an Arrow IPC file: record batches of BATCH sequences, each sequence a fixed-size list of `length` ids
beside two bit masks of the same length, `mask` (an id, not padding) and `ends` (the last id of a document). As every
sequence has the same width, the i-th one of a mapped file is a view at a known place: nothing is decoded or copied. A
shard holds whole documents; its schema carries their ids and lengths and the shard's place, and a manifest has the
number of ids before each shard, so that both global positions and documents are found again.

Files are written and read by Spark's own sources, so they may lie in any store that Spark reaches.
"""

from __future__ import annotations

import codecs
import re
import string
import sys
import types
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstat.llm.packing import SPELT
from reelstat.llm.scratch import batches_of
from reelstat.sources.files import join

LENGTH = 2048
BATCH = 64
SHARD_BYTES = 8_000_000
READ_BYTES = 8_000_000
END_ID = 0
CACHED_WORDS = 700_000
SEEN_SLOTS = 1 << 22
#: Fixed value: the last bytes of an Arrow file. Spark's writer puts them there as the end of the file's only line.
MAGIC = "ARROW1"

#: Fixed value: the characters of Unicode's property White_Space, as the tokenizer's pattern takes them.
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
ODD_SPACE = re.compile(f" (?:[{SPACES}]|\\Z)")
BEFORE_WORD = re.compile(f" (?=[^{SPACES}])")
#: Punctuation that is a unit of its own after letters. No apostrophe: the tokenizer takes 's and the like as units.
STOPS = string.punctuation.replace("'", "")
LINES = re.compile(r"([^\W\d_]+)([.,;:!?]*)\n([^\W\d_]+)([.,;:!?]*)")
SPECIAL = "<|"


#: By byte, the character that byte-level models spell it with.
SPELLING = "".join(chr(SPELT.get(byte, byte)) for byte in range(256))


def plain(word: str) -> bool:
    """Letters alone, of scripts whose classes are the same in every version of Unicode."""
    return word.isalpha() and (word.isascii() or max(word) < "\u0250")


class Words(dict):
    """Ids of " " + word as bytes. It is emptied when it holds CACHED_WORDS, which bounds its memory and changes no result.

    A word is kept from its second time on, as most of a corpus's different words never come again and would push out those
    that do. `seen` marks first times by hash; two words of one hash only make the second be kept at once.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.kind = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.stops: dict[str, bytes] = {}
        self.seen, self.marks = bytearray(SEEN_SLOTS), 0

    def whole(self, text: str) -> bytes:
        return array(self.kind, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def letters(self, word: str) -> bytes:
        """Of letters as the model spells them: bytes by characters, a space before the word as the first of them."""
        spelt = codecs.charmap_decode(word.encode("utf-8"), "strict", SPELLING)[0]
        return array(self.kind, [token.id for token in self.tokenize(spelt)]).tobytes()

    def _stops(self, stops: str) -> bytes:
        if stops not in self.stops:
            if len(self.stops) >= CACHED_WORDS:
                self.stops = {}
            self.stops[stops] = self.whole(stops) if stops else b""
        return self.stops[stops]

    def __missing__(self, word: str) -> bytes:
        if word.isalpha() and word.isascii():
            ids = array(self.kind, [token.id for token in self.tokenize("Ġ" + word)]).tobytes()
        elif plain(letters := word.rstrip(STOPS)):
            ids = self.letters(" " + word) if letters == word else self[letters] + self._stops(word[len(letters) :])
        elif (lines := LINES.fullmatch(word)) and plain(lines[1]) and plain(lines[3]):
            return self[lines[1]] + self._stops(lines[2]) + self._stops("\n") + self.letters(lines[3]) + self._stops(lines[4])
        else:
            ids = self.whole(" " + word)
        slot = hash(word) & SEEN_SLOTS - 1
        if self.seen[slot]:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = ids
        else:
            if self.marks >= SEEN_SLOTS // 2:
                self.seen, self.marks = bytearray(SEEN_SLOTS), 0
            self.seen[slot] = 1
            self.marks += 1
        return ids


class Encoder:
    """Ids of texts as bytes of the machine's order, 16 bits an id where the vocabulary fits.

    The tokenizer's pattern always cuts before a space that a word follows, so each different word is encoded once and
    looked up from then on. Texts that may hold a special token take the tokenizer's own way.
    """

    def __init__(self, path: str):
        self.words = Words(path)

    def __call__(self, text: str) -> bytes:
        if SPECIAL in text:
            return self.words.whole(text)
        first, *rest = BEFORE_WORD.split(text) if ODD_SPACE.search(text) else text.split(" ")
        ids = b"".join(map(self.words.__getitem__, rest))
        if not first:
            return ids
        return (self.words.letters(first) if plain(first) else self.words.whole(first)) + ids


#: Fixed value: the name under which a worker process keeps its encoders from task to task.
KEPT = "_reelstat_encoders"


def kept_encoder(path: str) -> Encoder:
    """The process's encoder of a tokenizer: reading one takes longer than many a task."""
    held = sys.modules.setdefault(KEPT, types.ModuleType(KEPT)).__dict__
    if path not in held:
        held[path] = Encoder(path)
    return held[path]


def shard_file(kind: str, length: int, ids: bytearray, documents: list[tuple[int | None, int]], place: tuple[int, int]) -> pa.Buffer:
    """One file: the ids of whole documents as (doc_id, number of ids) cut into sequences, the last one padded with zeros.

    `ids` is padded in place and then written from where it is."""
    width = np.dtype(kind).itemsize
    used = len(ids) // width
    n = -(-used // length) * length
    ids.extend(bytes((n - used) * width))
    counts = np.array([count for _, count in documents], np.int64)
    mask, ends = np.zeros(n, bool), np.zeros(n, bool)
    mask[:used] = True
    ends[np.cumsum(counts) - 1] = True
    held = pa.table({"doc_id": pa.array([d for d, _ in documents], pa.int64()), "n_tokens": counts})
    index = pa.BufferOutputStream()
    with pa.ipc.new_stream(index, held.schema) as writer:
        writer.write_table(held)
    values = {"ids": np.frombuffer(ids, kind), "mask": mask, "ends": ends}
    columns = {name: pa.FixedSizeListArray.from_arrays(pa.array(x), length) for name, x in values.items()}
    about = {"partition": str(place[0]), "shard": str(place[1]), "n_tokens": str(used), "documents": index.getvalue().to_pybytes()}
    table = pa.table(columns).replace_schema_metadata(about)
    out = pa.BufferOutputStream()
    with pa.ipc.new_file(out, table.schema) as writer:
        writer.write_table(table, max_chunksize=BATCH)
    return out.getvalue()


def _one(value: pa.Buffer) -> pa.Array:
    """An array of one binary value, without a copy."""
    ends = pa.py_buffer(np.array([0, value.size], np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), 1, [None, ends, value])


def _shards(path: str, length: int, shard_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, place = kept_encoder(path), [TaskContext.get().partitionId(), 0]
        kind = {"H": "u2", "I": "u4"}[encode.words.kind]
        end = np.array([END_ID], kind).tobytes()
        ids = bytearray()
        documents: list[tuple[int | None, int]] = []

        def shard() -> pa.RecordBatch:
            made = shard_file(kind, length, ids, documents, tuple(place))
            place[1] += 1
            return pa.RecordBatch.from_arrays([_one(made.slice(0, made.size - len(MAGIC)))], ["value"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                before = len(ids)
                ids += encode(text.as_py() or "")
                ids += end
                documents.append((doc_id.as_py(), (len(ids) - before) // len(end)))
                if len(ids) >= shard_bytes:
                    yield shard()
                    ids, documents = bytearray(), []
        if documents:
            yield shard()
        pa.default_memory_pool().release_unused()  # the process lives on

    return write


class Shard:
    """A shard file, mapped or in memory. `shard[i]` gives (ids, mask, ends) of a sequence; the ids are a view of the file."""

    def __init__(self, source: str | pa.Buffer):
        self.file = pa.ipc.open_file(pa.memory_map(source) if isinstance(source, str) else source)
        about = self.file.schema.metadata
        self.place = int(about[b"partition"]), int(about[b"shard"])
        self.n_tokens = int(about[b"n_tokens"])
        self.length = self.file.schema.field("ids").type.list_size
        self.documents = pa.ipc.open_stream(pa.py_buffer(about[b"documents"])).read_all()

    def __len__(self) -> int:
        return -(-self.n_tokens // self.length)

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        batch = self.file.get_batch(i // BATCH)
        ids, mask, ends = (batch.column(k).values.slice(i % BATCH * self.length, self.length) for k in range(3))
        return ids.to_numpy(zero_copy_only=True), mask.to_numpy(zero_copy_only=False), ends.to_numpy(zero_copy_only=False)

    def ids(self) -> Iterator[np.ndarray]:
        """The ids of each document, in order."""
        batches = (self.file.get_batch(i).column(0).values.to_numpy() for i in range(self.file.num_record_batches))
        flat = np.concatenate([*batches, np.zeros(0, np.uint16)]) if self.file.num_record_batches != 1 else next(batches)
        at = 0
        for count in self.documents.column("n_tokens").to_pylist():
            yield flat[at : at + count]
            at += count


def _headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shards = [Shard(content.as_buffer()) for content in batch.column("content")]
        rows = [(*s.place, s.n_tokens, s.documents.num_rows) for s in shards]
        columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(4)]
        yield pa.RecordBatch.from_arrays(columns, ["partition", "shard", "n_tokens", "n_documents"])


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["partition", "shard", "doc_id", "before", "ids"]
    for batch in batches:
        for content in batch.column("content"):
            shard = Shard(content.as_buffer())
            doc_ids, counts = shard.documents.column("doc_id").to_pylist(), shard.documents.column("n_tokens").to_numpy()
            before = np.cumsum(counts) - counts
            ids, start, size = [], 0, 0
            for i, own in enumerate(shard.ids()):
                ids.append(own.astype("<u4").tobytes())
                size += len(ids[-1])
                if size >= READ_BYTES or i == len(doc_ids) - 1:
                    fixed = [pa.array([value] * len(ids), pa.int64()) for value in shard.place]
                    columns = [*fixed, pa.array(doc_ids[start : i + 1], pa.int64()), pa.array(before[start : i + 1]), pa.array(ids, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names)
                    ids, start, size = [], i + 1, 0


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(join(path, "shards")).select("content")


def write(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    length: int = LENGTH,
    id_column: str = "doc_id",
    text_column: str = "text",
    shard_bytes: int = SHARD_BYTES,
) -> None:
    """Writes `<path>/shards` and `<path>/manifest` (partition, shard, start, n_tokens, n_documents).

    Rows come by ascending id, a null id first; rows of one id come by the hash of their text, then by the text itself,
    and each row is a document of its own, copies too. A null or empty text is the closing id alone. A very long text
    makes a longer shard, as a document lies in one file. Other columns, whatever their names, are not looked at. An empty
    table gives an empty manifest.

    Only the number of ids of each range of documents, a row per shuffle partition, passes through the driver.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    order = ["doc_id", F.xxhash64("text")]  # a sample of these reaches the driver, so no texts
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    shards = ordered.mapInArrow(_shards(tokenizer, length, shard_bytes), "value binary")
    text = shards.select(F.col("value").cast("string").alias("value"))
    with batches_of(spark):
        text.write.option("lineSep", MAGIC).option("maxRecordsPerFile", 1).text(join(path, "shards"))
    _number(spark, path)


def _number(spark: SparkSession, path: str) -> None:
    long = "partition long, shard long, n_tokens long, n_documents long"
    # A row per shard, kept for both uses, as a header costs the reading of its file.
    headers = _files(spark, path).mapInArrow(_headers, long).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        ranges = sorted(headers.groupBy("partition").agg(F.sum("n_tokens")).collect())
        starts, at = [], 0
        for partition, count in ranges:
            starts.append((partition, at))
            at += count
        before = "sum(n_tokens) over (partition by partition order by shard) - n_tokens"
        numbered = headers.withColumn("before", F.expr(before))
        numbered = numbered.join(spark.createDataFrame(starts, "partition long, first long"), "partition")
        chosen = numbered.select("partition", "shard", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "n_documents")
        chosen.write.parquet(join(path, "manifest"))
    finally:
        headers.unpersist()


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) of every document, from the files: ids as little-endian 32-bit bytes, start the number of ids
    of all documents before it."""
    schema = "partition long, shard long, doc_id long, before long, ids binary"
    held = _files(spark, path).mapInArrow(_documents, schema)
    shards = spark.read.parquet(join(path, "manifest")).select("partition", "shard", F.col("start").alias("first"))
    return held.join(shards, ["partition", "shard"]).select("doc_id", (F.col("first") + F.col("before")).alias("start"), "ids")
