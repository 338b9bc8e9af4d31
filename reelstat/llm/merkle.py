"""A Merkle tree over documents, by group, whose leaves are placed by bitmap rank.

A leaf's place in its group is the rank of its id. The ids of a group are kept as bitmaps: one per BITS consecutive ids,
built by each task for its rows and merged, then compressed to the stretches of 512 ids that hold any, each with the
number of ids before it (a popcount directory). Ids that several rows have are counted in binary: slice s of the bitmaps
holds the ids whose number of rows has bit s. Rows before a bitmap follow from sums over a radix tree of the ids. A rank
then is one lookup and the popcount of at most 64 bytes, so no group is ever sorted.

Levels are reduced by slot arrays: nodes i * 16 .. i * 16 + 15 meet under key i, each in its slot, and their digest is node
i of the next level. The way back down gives every leaf the siblings on its path, run by run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstat.llm.scratch import save

FAN = 16
BITS = 32_768  # fixed value: of a bitmap of Spark's bitmap functions
STRETCH = 512
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def spelt(value: Column) -> Column:
    """`-` for null, else the value's bytes with their number before them, so that no two rows spell alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: list[Column]) -> Column:
    return digest(F.concat(*map(spelt, columns)))


#: From a bitmap, the stretches that hold bits: (stretch, before, ones, bits).
_STRETCHES = f"""
aggregate(
    filter(
        transform(sequence(0, {BITS // STRETCH - 1}), k -> named_struct(
            'stretch', k,
            'ones', bitmap_count(substring(bitmap, k * {STRETCH // 8} + 1, {STRETCH // 8})),
            'bits', substring(bitmap, k * {STRETCH // 8} + 1, {STRETCH // 8}))),
        b -> b.ones > 0),
    named_struct('n', 0L, 'list', cast(array() as array<struct<stretch:int,before:bigint,ones:bigint,bits:binary>>)),
    (a, b) -> named_struct(
        'n', a.n + b.ones,
        'list', concat(a.list, array(named_struct('stretch', b.stretch, 'before', a.n, 'ones', b.ones, 'bits', b.bits)))),
    a -> a.list)
"""
_BYTE = f"cast(conv(hex(substring(b.bits, cast(at % {STRETCH} div 8 as int) + 1, 1)), 16, 10) as int)"
#: Rows of ids below `at` in a bucket: the whole stretches before it by the directory, the rest by popcount.
_BEFORE = f"""
aggregate(slices, 0L, (n, s) -> n + shiftleft(coalesce(get(transform(
    slice(filter(s.stretches, b -> b.stretch <= at div {STRETCH}), -1, 1),
    b -> b.before + if(b.stretch < at div {STRETCH}, b.ones,
        bitmap_count(substring(b.bits, 1, cast(at % {STRETCH} div 8 as int)))
        + bit_count({_BYTE} & (shiftleft(1, cast(at % 8 as int)) - 1)))), 0), 0L), s.slice))
"""
_ROWS_AT = f"""
aggregate(slices, 0L, (n, s) -> n + shiftleft(coalesce(get(transform(
    filter(s.stretches, b -> b.stretch = at div {STRETCH}),
    b -> cast(shiftright({_BYTE}, cast(at % 8 as int)) & 1 as bigint)), 0), 0L), s.slice))
"""


def bitmaps(ids: DataFrame) -> DataFrame:
    """Rows (tree, doc_id) without nulls -> (tree, bucket, rows, slices): the compressed bitmaps of each tree's ids."""
    counts = ids.groupBy("tree", "doc_id").agg(F.count("*").alias("n"))
    held = F.expr("if(n = 1, array(0), filter(sequence(0, 62), s -> getbit(n, s) = 1))")
    each = counts.select("tree", F.expr("shiftright(doc_id, 15)").alias("bucket"), F.expr(f"doc_id & {BITS - 1}").alias("at"), F.explode(held).alias("slice"))
    merged = each.groupBy("tree", "bucket", "slice").agg(F.bitmap_construct_agg("at").alias("bitmap"))
    packed = merged.select("tree", "bucket", "slice", F.bitmap_count("bitmap").alias("ones"), F.expr(_STRETCHES).alias("stretches"))
    return packed.groupBy("tree", "bucket").agg(
        F.sum(F.expr("shiftleft(ones, slice)")).alias("rows"), F.collect_list(F.struct("slice", "stretches")).alias("slices")
    )


def with_starts(found: DataFrame) -> DataFrame:
    """The bitmaps with `start`, the rows of their tree before them, and `held`, those of the whole tree.

    The sums go up a radix tree of 2 ** 16 children a node and down again, so no window holds more rows than that.
    """
    level, steps, depth = found.select("tree", F.col("bucket").alias("k0"), "rows"), [], 3
    for d in range(depth):
        level = save(level.withColumn(f"k{d + 1}", F.expr(f"shiftright(k{d}, 16)")))
        before = F.expr(f"sum(rows) over (partition by tree, k{d + 1} order by k{d}) - rows").alias("before")
        steps.append(level.select("tree", f"k{d}", f"k{d + 1}", before))
        level = level.groupBy("tree", f"k{d + 1}").agg(F.sum("rows").alias("rows"))
    # What is left of the key is its sign.
    before = F.expr(f"sum(rows) over (partition by tree order by k{depth}) - rows").alias("start")
    top = level.select("tree", f"k{depth}", before, F.expr("sum(rows) over (partition by tree)").alias("held"))
    for d in reversed(range(depth)):
        joined = steps[d].join(top, ["tree", f"k{d + 1}"])
        top = joined.select("tree", f"k{d}", (F.col("start") + F.col("before")).alias("start"), "held")
    return found.join(top.withColumnRenamed("k0", "bucket"), ["tree", "bucket"])


def _tied(rows: DataFrame) -> DataFrame:
    """Places of rows that share an id, from the first of these places on, by ascending leaf.

    Equal leaves take places next to each other, whichever. Different ones are counted by the first 16 bits of their digest,
    which spread evenly, so a null id that a third of all rows have is no group of one task.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit("")).alias("key")
    columns = ["tree", "doc_id", "place", "total", "leaf", "other"]
    groups = save(rows.groupBy(*columns, key, F.substring("leaf", 1, 4).alias("begin")).agg(F.count("*").alias("n")))
    sums = groups.groupBy("tree", "key", "begin").agg(F.sum("n").alias("m"))
    sums = sums.withColumn("before", F.expr("sum(m) over (partition by tree, key order by begin) - m")).drop("m")
    within = F.expr("sum(n) over (partition by tree, key, begin order by leaf) - n")
    placed = groups.withColumn("within", within).join(sums, ["tree", "key", "begin"])
    copies = F.explode(F.expr("sequence(0L, n - 1)")).alias("copy")
    placed = placed.select(*columns, (F.col("place") + F.col("before") + F.col("within")).alias("first"), copies)
    return placed.withColumn("place", F.col("first") + F.col("copy")).select(*columns)


def placed(leaves: DataFrame) -> tuple[DataFrame, int]:
    """Leaves (tree, doc_id, leaf, other) with `place` in their tree, from 0, and `total`, the tree's leaves; and the largest
    total. Null ids come first."""
    some = leaves.where(F.col("doc_id").isNotNull())
    found = save(with_starts(bitmaps(some.select("tree", "doc_id"))))
    nulls = leaves.where(F.col("doc_id").isNull()).groupBy("tree").agg(F.count("*").alias("nulls"))
    sizes = found.groupBy("tree").agg(F.max("held").alias("held")).join(nulls, "tree", "full")
    zero = F.lit(0).cast("long")
    sizes = save(sizes.select("tree", F.coalesce("nulls", zero).alias("nulls"), (F.coalesce("nulls", zero) + F.coalesce("held", zero)).alias("total")))
    directory = found.join(sizes, "tree").select("tree", "bucket", (F.col("start") + F.col("nulls")).alias("start"), "total", "slices")
    keyed = some.withColumns({"bucket": F.expr("shiftright(doc_id, 15)"), "at": F.expr(f"doc_id & {BITS - 1}")})
    columns = ["tree", "doc_id", "place", "total", "leaf", "other"]
    located = keyed.join(directory, ["tree", "bucket"]).withColumn("place", F.col("start") + F.expr(_BEFORE))
    distinct = found.where(F.expr("exists(slices, s -> s.slice > 0)")).isEmpty()
    most = sizes.agg(F.max("total").alias("most"), F.max("nulls").alias("nulls")).first()
    if distinct and not most.nulls:
        return located.select(*columns), most.most or 0
    located = located.withColumn("copies", F.expr(_ROWS_AT))
    unnamed = leaves.where(F.col("doc_id").isNull()).join(sizes, "tree").withColumn("place", zero)
    ties = located.where("copies > 1").select(*columns).unionByName(unnamed.select(*columns))
    return located.where("copies = 1").select(*columns).unionByName(_tied(ties)), most.most


def _reduced(nodes: DataFrame) -> DataFrame:
    """Nodes (tree, i, total, node struct with digest) -> the runs of FAN of them as nodes of the next level, with the slots
    they came from. A tree of one node goes on as it is."""
    slot = F.struct((F.col("i") % FAN).cast("int").alias("slot"), "node")
    runs = nodes.groupBy("tree", F.expr(f"i div {FAN}").alias("i"), "total").agg(F.array_sort(F.collect_list(slot)).alias("slots"))
    joined = digest(F.array_join(F.transform("slots", lambda s: s["node"]["digest"]), ""))
    alone = F.col("total") == 1
    one = F.when(alone, F.get("slots", F.lit(0))["node"]["digest"]).otherwise(joined)
    return save(runs.select("tree", "i", alone.alias("alone"), F.expr(f"(total + {FAN - 1}) div {FAN}").alias("total"), "slots", one.alias("digest")))


def _levels(nodes: DataFrame, most: int) -> list[DataFrame]:
    """The runs of every level, bottom up, until each tree is one node."""
    levels = [_reduced(nodes)]
    while (most := -(-most // FAN)) > 1:
        below = levels[-1]
        levels.append(_reduced(below.select("tree", "i", "total", F.struct("digest").alias("node"))))
    return levels


def _spread(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """The lowest nodes with their paths: (tree, node, path, *more), from the tops' (tree, i, path, *more)."""
    more = [name for name in above.columns if name not in ("tree", "i", "path")]
    for level in reversed(levels):
        sides = [
            F.expr(f"array_join(transform(filter(slots, s -> s.slot {sign} one.slot), s -> s.node.digest), '')").alias(name)
            for sign, name in (("<", "left"), (">", "right"))
        ]
        opened = level.drop("total", "digest").join(above, ["tree", "i"]).withColumn("one", F.explode("slots"))
        path = F.when(F.col("alone"), F.col("path")).otherwise(F.concat(F.array(F.struct(*sides)), "path"))
        above = opened.select("tree", (F.col("i") * FAN + F.col("one.slot")).alias("i"), path.alias("path"), *more, F.col("one.node").alias("node"))
        lowest, above = above, above.drop("node")
    return lowest.drop("i")


def _numbered(trees: DataFrame) -> tuple[DataFrame, int]:
    """Trees (tree, digest) with `i`, their number by name. Ranges of names are sorted apart; a count of each range, a row per
    shuffle partition, passes through the driver."""
    ordered = trees.repartitionByRange("tree").sortWithinPartitions("tree")
    row = F.monotonically_increasing_id()
    parts = save(ordered.select("tree", "digest", F.shiftright(row, 33).alias("part"), row.bitwiseAND((1 << 33) - 1).alias("at")))
    starts, total = [], 0
    for part, n in sorted(parts.groupBy("part").count().collect()):
        starts.append((part, total))
        total += n
    first = trees.sparkSession.createDataFrame(starts, "part long, first long")
    return parts.join(first, "part").select("tree", "digest", (F.col("first") + F.col("at")).alias("i")), total


def proofs(docs: DataFrame, other_text: Column | None = None, columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    """(doc_id, leaf, other, subroot, root, path) per row of documents.

    leaf: digest of the five columns; other: the same with `other_text` as the text, by default the text itself. subroot:
    of the tree of the row's source; root: over the subroots by source, null first. path: for each run from the leaf up to
    the root, the digests left and right of the row's own, as joined texts; runs of one node have both empty.

    Leaves of a source ascend by doc_id, a null id first; rows of one id ascend by leaf, equal rows stand next to each other
    and each has its own place. Null columns and empty or very long texts are leaves like others. Further columns are not
    looked at, whatever their names. No rows give no rows.
    """
    values = [F.col(f"`{name}`") for name in columns]
    doc_id, source, text = values[0], values[1], values[4]
    other = leaf_digest([*values[:4], text if other_text is None else other_text])
    tree = F.coalesce(F.concat(F.lit("="), source), F.lit(""))
    leaves = save(docs.select(tree.alias("tree"), doc_id.cast("long").alias("doc_id"), leaf_digest(values).alias("leaf"), other.alias("other")))
    rows, most = placed(leaves)
    node = F.struct(F.col("leaf").alias("digest"), "doc_id", "other")
    levels = _levels(rows.select("tree", F.col("place").alias("i"), "total", node.alias("node")), most)
    trees, n_trees = _numbered(levels[-1].select("tree", "digest"))
    named = trees.select(F.lit("").alias("tree"), "i", F.lit(n_trees).cast("long").alias("total"), F.struct("digest", F.col("tree").alias("name")).alias("node"))
    over = _levels(named, n_trees)
    top = over[-1].select("tree", "i", F.expr(f"cast(array() as {PATH})").alias("path"), F.col("digest").alias("root"))
    tops = _spread(over, top)
    first = F.lit(0).cast("long").alias("i")
    tops = save(tops.select(F.col("node.name").alias("tree"), first, "path", F.col("node.digest").alias("subroot"), "root"))
    out = _spread(levels, tops)
    return out.select("node.doc_id", F.col("node.digest").alias("leaf"), "node.other", "subroot", "root", "path")


def siblings(path: Column) -> Column:
    """All digests of a path, from the leaf up, left to right."""
    return F.array_join(F.transform(path, lambda run: F.concat(run["left"], run["right"])), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda below, run: digest(F.concat(run["left"], below, run["right"])))
