"""MinHash near-dedup by an inverted join of signature coordinates.

A text's set is its distinct 5-word shingles (`shingles.py`). Texts with the same set are one class from the start, so
a group of copies, however large, is a single node. A node's signature has K coordinates, each a key (coordinate, value).

Two sets of Jaccard similarity s collide in about s * K coordinates. Pairs are retained for the exact check when at
least T coordinates collide. To find them without listing the pairs of every key, keys are ordered by how many nodes
hold them, rarest first, and a node is posted only under its first K - T + 1 (the prefix): two nodes that collide T times
share a key of both prefixes. The frequent keys, those of passages that thousands of texts share, are skipped in posting;
whether they collide too is looked up in the signatures of the pairs that the prefix found.

Within the list of a key, nodes are paired with two of the list's nodes only, the hubs. Of its pairs, a node's best one is
checked; what it links is one component. Nodes of a list that then still lie in different components are compared in
blocks (`_across`), each pair in the list of its first shared coordinate only, and only links leave a block. So a list of
near copies yields a few rows per node, and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.llm.graph import components
from reelstat.llm.native_text import unused
from reelstat.llm.scratch import save
from reelstat.llm.shingles import groups, minhashes, multipliers, overlap, overlaps, shingle_set, shingle_sets
from xxhash import xxh3_128_digest

COORDINATES = 64
COLLISIONS = 34  # of 64; a pair at similarity 0.75 has fewer with probability 4.4e-5
PERCENT = 75
BLOCK_BYTES = 4_000_000
VALUE_BITS = 57  # of a key; the coordinate is above them


def keyed(values: np.ndarray) -> np.ndarray:
    """A key per coordinate, a row for each set: its number and the upper bits of its value."""
    coordinate = np.arange(values.shape[-1], dtype=np.uint64) << np.uint64(VALUE_BITS)
    return (coordinate | values >> np.uint64(64 - VALUE_BITS)).view(np.int64)


def coordinates(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The keys of sets, a row each: one for each coordinate of the MinHash signature."""
    return keyed(minhashes(shingles, bounds, multipliers(COORDINATES)))


def _signed(keys_of: Callable[[np.ndarray, np.ndarray], np.ndarray]):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in groups(text.as_py() for text in batch.column("text")):
                shingles, bounds = shingle_sets(texts)
                sizes = np.diff(bounds)
                nodes = [xxh3_128_digest(shingles[x:y]) if x < y else None for x, y in zip(bounds[:-1], bounds[1:])]
                keys = keys_of(shingles, np.unique(bounds))
                ends = np.concatenate([[0], np.cumsum(sizes > 0)]) * keys.shape[1]
                lists = pa.ListArray.from_arrays(
                    pa.array(ends.astype(np.int32)), pa.array(keys.reshape(-1)), mask=pa.array(sizes == 0)
                )
                own = batch.slice(at, len(texts))
                at += len(texts)
                made = [pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), lists]
                names = ["row_id", "text_hash", "n_shingles", "node", "keys"]
                yield pa.RecordBatch.from_arrays([own.column("row_id"), own.column("text_hash"), *made], names)

    return sign


def _similar(percent: int):
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kept = None, None
        for batch in batches:
            passed = []
            for a, left, right in zip(*(batch.column(name) for name in ("a", "text_a", "text_b"))):
                if a.as_py() != last:
                    last, kept = a.as_py(), shingle_set(left.as_py())
                both, either = overlap(kept, shingle_set(right.as_py()))
                passed.append(100 * both >= percent * either)
            yield batch.select(["a", "b"]).filter(pa.array(passed, pa.bool_()))

    return check


def _posted(nodes: DataFrame, collisions: int) -> DataFrame:
    """(key, node): the prefix of each node, without keys that no other node holds."""
    each = nodes.select("node", F.explode("keys").alias("key"))
    shared = each.groupBy("key").agg(F.count("*").alias("holders")).where("holders > 1")
    return (
        each.join(shared, "key")
        .groupBy("node")
        .agg(F.sort_array(F.collect_list(F.struct("holders", "key"))).alias("shared"))
        .where(F.size("shared") >= collisions)
        .select("node", F.explode(F.slice("shared", 1, F.size("shared") - collisions + 1)).alias("posted"))
        .select("posted.key", "node")
    )


def _hubs(posted: DataFrame) -> DataFrame:
    """Pairs a < b of each list's nodes with two of its nodes."""
    order = F.struct(F.xxhash64("node"), "node")
    ends = posted.groupBy("key").agg(F.min(order).alias("low"), F.max(order).alias("high")).where("low < high")
    pairs = posted.join(ends, "key").select("node", F.explode(F.array("low.node", "high.node")).alias("other"))
    pairs = pairs.where("node <> other")
    return pairs.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def _side(nodes: DataFrame, side: str, *more: str) -> DataFrame:
    return nodes.select(*more, *[F.col(name).alias(f"{name}_{side}") for name in nodes.columns if name not in more])


def _may_link(collisions: int, percent: int):
    """Similar sets are of similar size; then all collisions of a pair are counted, the skipped keys among them."""
    small, large = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    return (100 * small >= percent * large) & (F.size(F.array_intersect("keys_a", "keys_b")) >= collisions)


def _colliding(pairs: DataFrame, nodes: DataFrame, collisions: int, percent: int) -> DataFrame:
    """The pairs that may be linked, with their collisions."""
    left, right = _side(nodes, "a"), _side(nodes, "b")
    joined = pairs.withColumnsRenamed({"a": "node_a", "b": "node_b"}).join(left, "node_a").join(right, "node_b")
    joined = joined.where(_may_link(collisions, percent))
    hits = F.size(F.array_intersect("keys_a", "keys_b"))
    return joined.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"), hits.alias("hits"))


def _mixed(posted: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, node, component) of the lists that hold more than one component."""
    labelled = posted.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = labelled.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y")
    return labelled.join(mixed.select("key"), "key")


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingle_set(text.as_py()).tobytes() for text in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], ["node", "shingles"])


def _blocks(collisions: int, percent: int):
    """Links within a block, or between two blocks, of one list, as far as they join components that are still apart.

    Pairs that share an earlier coordinate are left to the list of that one.
    """

    def link(table: pa.Table) -> pa.Table:
        column = {name: table.column(name).to_pylist() for name in ("node", "component", "shingles")}
        key, i, j = (table.column(name)[0].as_py() for name in ("key", "i", "j"))
        keys = table.column("keys").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
        masks = table.column("posted").to_numpy().view(np.uint64)
        block, at = np.asarray(table.column("block")), np.uint64((key % (1 << 64)) >> VALUE_BITS)
        labels = np.unique(column["component"], return_inverse=True)[1]
        sets = [np.frombuffer(x, np.uint64) for x in column["shingles"]]
        sizes = np.array([len(x) for x in sets])
        earlier = (np.uint64(1) << at) - np.uint64(1)
        left, right = [], []
        for x in np.flatnonzero(block == i):
            y = np.flatnonzero((block == j) & (labels != labels[x]))
            if i == j:
                y = y[y > x]
            y = y[100 * np.minimum(sizes[y], sizes[x]) >= percent * np.maximum(sizes[y], sizes[x])]
            equal = keys[y] == keys[x]
            y, equal = (v[equal.sum(axis=1) >= collisions] for v in (y, equal))
            bits = (equal.astype(np.uint64) << np.arange(keys.shape[1], dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
            y = y[(bits & masks[y] & masks[x] & earlier) == 0]
            if not len(y):
                continue
            both, either = overlaps(sets[x], [sets[z] for z in y])
            for z in y[100 * both >= percent * either]:
                if labels[x] != labels[z]:  # not linked meanwhile
                    left.append(column["node"][x])
                    right.append(column["node"][z])
                    labels[labels == labels[z]] = labels[x]
        return pa.table({"a": pa.array(left, pa.binary()), "b": pa.array(right, pa.binary())})

    return link


def _across(lists: DataFrame, posted: DataFrame, nodes: DataFrame, texts: DataFrame, collisions: int, percent: int):
    """The links between different components of a list, each pair tested once and on its full sets.

    A list is dealt into blocks of about BLOCK_BYTES; a task holds two blocks, and only links leave it.
    """
    bit = f"shiftleft(1L, int(shiftrightunsigned(key, {VALUE_BITS})))"
    masks = posted.groupBy("node").agg(F.bit_or(F.expr(bit)).alias("posted"))
    sets = texts.join(lists.select("node").distinct(), "node").mapInArrow(_sets, "node binary, shingles binary")
    full = sets.join(nodes.select("node", "keys"), "node").join(masks, "node")
    full = save(full.withColumn("bytes", F.octet_length("shingles") + 800))
    weighed = lists.join(full.select("node", "bytes"), "node")
    counts = weighed.groupBy("key").agg(F.ceil(F.sum("bytes") / BLOCK_BYTES).cast("int").alias("n"))
    dealt = lists.join(counts, "key").withColumn("block", F.pmod(F.xxhash64("node"), "n").cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other")
    dealt = dealt.select("key", "node", "component", "block", others)
    dealt = dealt.select(
        "key", "node", "component", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    )
    spread = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # small in bytes, large in work
    grouped = dealt.join(full.drop("bytes"), "node").repartition(spread, "key", "i", "j").groupBy("key", "i", "j")
    return grouped.applyInArrow(_blocks(collisions, percent), "a binary, b binary")


def _best(pairs: DataFrame) -> DataFrame:
    """For each node, the pair with the most collisions."""
    either = pairs.select("a", "b", "hits", F.explode(F.array("a", "b")).alias("node"))
    best = either.groupBy("node").agg(F.max(F.struct("hits", "a", "b")).alias("best"))
    return best.select("best.a", "best.b").distinct()


def _texts_of(members: DataFrame, found: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, text): one text for each node."""
    needed = members.join(found.select("node", "row_id", "text_hash"), "node")
    same = texts["text_hash"].eqNullSafe(needed["text_hash"]) & texts["row_id"].eqNullSafe(needed["row_id"])
    return needed.join(texts, same).select("node", "text").dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full shingle sets are similar enough."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.select("a", "b").join(right, "b").join(left, "a")
    return joined.mapInArrow(_similar(percent), "a binary, b binary")


def classes(
    rows: DataFrame,
    percent: int = PERCENT,
    collisions: int = COLLISIONS,
    keys_of: Callable[[np.ndarray, np.ndarray], np.ndarray] = coordinates,
) -> DataFrame:
    """Rows (row_id, text) -> (row_id, text_hash, n_shingles, node, component), one row each; row_id of any orderable type.

    node is the class of equal sets, component the least node linked to it over any chain of links; both are null for a
    row without words or text, which is linked with nothing. Two nodes are linked if 100 * intersection >= percent *
    union of their full sets. Rows may repeat and row_id may be null: they are told apart by what they hold.
    """
    texts = rows.select("row_id", "text", F.xxhash64("text").alias("text_hash"))
    kind = rows.schema["row_id"].dataType.simpleString()
    schema = f"row_id {kind}, text_hash long, n_shingles long, node binary, keys array<bigint>"
    signed = save(texts.select("row_id", "text_hash", "text").mapInArrow(_signed(keys_of), schema))
    grouped = signed.where("node is not null").groupBy("node")
    found = grouped.agg(
        F.min(F.struct("row_id", "text_hash")).alias("rep"),
        F.any_value("n_shingles").alias("size"),
        F.any_value("keys").alias("keys"),
    )
    found = save(found.select("node", "rep.row_id", "rep.text_hash", "size", "keys"))
    nodes = found.select("node", "size", "keys")
    posted = save(_posted(nodes, collisions))
    held = save(_texts_of(posted.select("node").distinct(), found, texts))
    links = save(_confirmed(_best(_colliding(_hubs(posted), nodes, collisions, percent)), held, percent))
    labels = save(components(links))
    more = save(_across(save(_mixed(posted, labels)), posted, nodes, held, collisions, percent))
    if not more.isEmpty():
        labels = components(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))
    out = signed.select("row_id", "text_hash", "n_shingles", "node").join(labels, "node", "left")
    return out.select("row_id", "text_hash", "n_shingles", "node", F.coalesce("component", "node").alias("component"))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row: the smallest id reachable over links, and whether it is the row's.

    A row without words is its own component. Rows of a null id are kept only if no row of their component has an id.
    Repeated rows each have their row. Texts count whole, however long; an empty table gives none; other columns of the
    documents, whatever their names, are not looked at.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("row_id"), F.col(text_column).alias("text"))
    found = classes(rows)
    smallest = found.where("component is not null").groupBy("component").agg(F.min("row_id").alias("least"))
    joined = found.join(smallest, "component", "left")
    component = F.when(F.col("component").isNull(), F.col("row_id")).otherwise(F.col("least"))
    return joined.select(F.col("row_id").alias("doc_id"), "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents, one of each component: that of the smallest id, with all its columns.

    Equal rows of one id are one document and leave as one; of those that differ in other columns any one stays. Texts of one
    id are told apart: of several in one component, that of the smallest hash stays. A null id is after all others.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("row_id"), "text")
    texts = classes(rows).groupBy("component", "row_id", "text_hash").agg(F.count("*").alias("n"))
    texts = save(texts.withColumn("place", F.struct(F.col("row_id").isNull().alias("null"), "row_id", "text_hash")))
    grouped = texts.where("component is not null").groupBy("component").agg(F.min_by("n", "place").alias("n"), F.min("place").alias("place"))
    alone = texts.where("component is null").select("n", "place")
    kept = save(grouped.select("n", "place").unionByName(alone).select("n", "place.row_id", "place.text_hash"))
    hashed = unused(docs, "_hash")
    own = docs.withColumn(hashed, F.xxhash64("text"))

    def of(found: DataFrame) -> DataFrame:
        same = own["doc_id"].cast("long").eqNullSafe(found["row_id"]) & own[hashed].eqNullSafe(found["text_hash"])
        return own.join(found, same, "left_semi")

    once = of(kept.where("n = 1").select("row_id", "text_hash"))
    repeated = of(kept.where("n > 1").select("row_id", "text_hash")).dropDuplicates(["doc_id", hashed])
    return once.unionByName(repeated).drop(hashed)
