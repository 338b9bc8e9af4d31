"""Benchmark decontamination, in built-in functions only.

Every run of 13 words of a benchmark item (an item of fewer words: all of them) is a window. The hashes of the windows
are a broadcast set; each document's windows are hashed in one pass and looked up in it, in the stage that scans the
documents; hits are verified word by word. Only hits and one row per document are shuffled.

The set is broadcast while it has at most BROADCAST_WINDOWS windows (counted; about 200 bytes each). Beyond that the
hashes are joined by a shuffle instead, with the same result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.llm.native_text import NOT_ALNUM, lower_ascii, words
from reelstat.llm.scratch import save

WINDOW = 13
BASE = WINDOW + 1
BROADCAST_WINDOWS = 1_000_000


def windows(items: DataFrame, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """(hash, words, length, items): each distinct window and the items that hold it."""
    split = items.select(F.col(id_column).alias("item"), words(lower_ascii(F.col(text_column)), NOT_ALNUM).alias("words"))
    split = split.where(F.size("words") > 0).withColumn("length", F.least(F.size("words"), F.lit(WINDOW)))
    starts = F.explode(F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)).alias("start")
    each = split.select("item", "length", "words", starts).withColumn("window", F.slice("words", "start", "length"))
    grouped = each.groupBy(F.xxhash64("window").alias("hash"), F.col("window").alias("window"), "length")
    return grouped.agg(F.array_sort(F.collect_set("item")).alias("items"))


def scanned(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, text_hash, n_words, copies, starts, items): a row per id and text, with its hits and how often it occurs.

    starts: (first word, length) of every verified window, ascending; items: the items that hold them, distinct.
    """
    known = save(windows(items))
    lengths = [row.length for row in known.select("length").distinct().orderBy("length").collect()]  # at most WINDOW
    n_windows = known.count()
    text = F.col(text_column)
    split = docs.select(
        F.col(id_column).alias("id"),
        F.xxhash64(text).alias("text_hash"),
        F.sha2(F.coalesce(text, F.lit("")), 256).alias("digest"),
        words(lower_ascii(text), NOT_ALNUM).alias("words"),
    ).withColumn("n_words", F.size("words").cast("long"))
    # One scan: place 0 stands for the document itself, start * BASE + length for each of its windows.
    places = F.array(F.lit(0))
    for length in lengths:
        last = F.size("words") - length + 1
        steps = F.sequence(F.lit(BASE + length), last * BASE + length, F.lit(BASE))
        places = F.concat(places, F.when(last > 0, steps).otherwise(F.array().cast("array<int>")))
    each = split.withColumn("place", F.explode(places))
    each = each.withColumn("start", F.floor(F.col("place") / BASE).cast("int")).withColumn("length", F.col("place") % BASE)
    window = F.slice("words", F.greatest("start", F.lit(1)), "length")
    each = each.withColumn("hash", F.when(F.col("place") > 0, F.xxhash64(window)))
    right = known.select("hash", "window", "items")
    if n_windows <= BROADCAST_WINDOWS:
        right = F.broadcast(right)
    else:  # the rows are shuffled: each carries its own window, not all words of its document
        each = each.withColumn("own", F.when(F.col("place") > 0, window)).drop("words")
        window = F.col("own")
    # array_contains, not =, so that the join's key is the hash alone.
    verified = (each["hash"] == right["hash"]) & F.array_contains(F.array(right["window"]), window)
    rows = each.join(right, verified, "left").where((F.col("place") == 0) | F.col("items").isNotNull())
    keys = ["id", "text_hash", "digest", "n_words"]
    rows = rows.select(*keys, (F.col("place") == 0).cast("int").alias("row"), "start", "length", "items")
    grouped = rows.groupBy(*keys).agg(
        F.sum("row").alias("copies"),
        F.sort_array(F.collect_set(F.when(F.col("row") == 0, F.struct("start", "length")))).alias("starts"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    )
    return grouped


def _covered():
    """Words inside any of the windows, which may overlap."""
    return F.aggregate(
        "starts",
        F.struct(F.lit(1).alias("end"), F.lit(0).alias("n")),
        lambda a, w: F.struct(
            F.greatest(a["end"], w["start"] + w["length"]).alias("end"),
            (a["n"] + F.greatest(F.lit(0), w["start"] + w["length"] - F.greatest(w["start"], a["end"]))).alias("n"),
        ),
        lambda a: a["n"].cast("long"),
    )


def contamination(docs: DataFrame, items: DataFrame, percent: int = 5) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for every row of the documents.

    Null or empty text has no words and is clean. Equal rows are counted apart. No items: the hash of the empty text.
    contaminated: n_hit > 0 and 100 * n_hit >= percent * n_words. Items of a null id hit words but are in no list.
    """
    found = scanned(docs, items).withColumn("n_hit", _covered())
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (100 * F.col("n_hit") >= percent * F.col("n_words"))).alias("contaminated"),
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
    ).drop("copy")


def remove_documents(docs: DataFrame, items: DataFrame, percent: int = 5) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    found = scanned(docs, items).withColumn("n_hit", _covered())
    bad = found.where((F.col("n_hit") > 0) & (100 * F.col("n_hit") >= percent * F.col("n_words")))
    bad = save(bad.select("id", "digest"))
    digest = F.sha2(F.coalesce(docs["text"], F.lit("")), 256)
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["id"]) & (digest == bad["digest"]), "left_anti")


def remove_spans(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents with every hit word, and what stands between it and the word before, taken out of the text.

    Null, empty and very long texts, repeated rows and further columns of any name stay as they are but for that.
    """
    found = save(scanned(docs, items).where(F.size("starts") > 0).select("id", "digest", "starts"))
    digest = F.sha2(F.coalesce(docs["text"], F.lit("")), 256)
    joined = docs.join(found, docs["doc_id"].eqNullSafe(found["id"]) & (digest == found["digest"]), "left")
    # Each token is what separates a word from the one before it, then the word; what follows the last word comes last.
    apart, word = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]", "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]"
    tokens = F.regexp_extract_all(docs["text"], F.lit(f"{apart}*{word}+|{apart}+"), F.lit(0))
    hit = lambda i: F.exists(found["starts"], lambda w: (i + 1 >= w["start"]) & (i + 1 < w["start"] + w["length"]))
    kept = F.array_join(F.filter(tokens, lambda t, i: ~hit(i)), "")
    text = F.when(found["starts"].isNull(), docs["text"]).otherwise(kept)
    return joined.select(*[text.alias(c) if c == "text" else docs[f"`{c}`"] for c in docs.columns])
