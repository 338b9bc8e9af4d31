"""Periodic runs, token files and the Merkle manifest against brute force, and their results on odd input."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import SMALL
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from reelstat.llm import merkle, periodic_runs, queries, token_files

#: With columns that the operators use for themselves inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, place long, at long, ids string, runs string, value string, start long"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
WORDS = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(13)
    texts: list[str | None] = [None, "", " \n\t ", "one", "One, two!", "the  the\n the <|endoftext|>", "中文 ÉTÉ x\x1c y"]
    for _ in range(60):
        words = []
        for _ in range(rng.randint(1, 4)):
            unit = [rng.choice(["a", "b", "Ça", "d.", "E"]) for _ in range(rng.randint(1, 9))]
            words += unit * rng.randint(0, 6) + [f"w{rng.randint(0, 99)}" for _ in range(rng.randint(0, 12))]
        texts.append(rng.choice([" ", "  ", "\n"]).join(words))
    texts.append("la " * 30_000 + " ".join(f"x{i}" for i in range(5_000)))  # very long
    places = [rng.choice([i, -i, i + 40_000, i * 10**12, i - 2**63, 2**63 - 1 - i]) for i in range(len(texts))]
    out = [(p, t, None if i % 4 else "en", [None, "a", "é", "z"][min(3, i % 11)], None if t is None else len(t)) for i, (p, t) in enumerate(zip(places, texts))]
    out += [out[9], out[9], (out[9][0], "other", "de", out[9][3], 5), (None, "x", None, "a", 1), (None, None, None, None, None), (None, "x", None, "a", 1)]
    out += [(500 + i, "lone", "en", f"s{i}", 4) for i in range(40)] + [(1000 + 3 * i, "many", None, "hot", i) for i in range(300)]
    return [(*r, "t", 1, 2, "i", "r", "v", 3) for r in out]


@pytest.fixture(scope="module")
def documents(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def runs_of(words: list) -> list[tuple[int, int, int]]:
    found = set()
    for q in range(1, len(words) // 4 + 1):
        begin = 0
        for i in range(len(words) - q + 1):
            if i == len(words) - q or words[i] != words[i + q]:
                length = i + q - begin
                smaller = any(all(words[k] == words[k + p] for k in range(begin, i + q - p)) for p in range(1, q))
                if length >= max(6, 4 * q) and not smaller:
                    found.add((begin, length, q))
                begin = i + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: list, runs: list) -> str:
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize("seed", range(40))
def test_block_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(20):
        words: list[int] = []
        for _ in range(rng.randint(0, 4)):
            unit = [rng.randint(0, rng.choice([1, 2, 5])) for _ in range(rng.randint(1, 9))]
            words += unit * rng.randint(0, 6) + unit[: rng.randint(0, len(unit))] + [rng.randint(0, 3) for _ in range(rng.randint(0, 5))]
        texts.append(words)
    codes = np.array([w for words in texts for w in words], np.int64)
    assert periodic_runs.block_runs(codes, list(map(len, texts))) == [runs_of(words) for words in texts]


def test_runs_of_documents(documents, nothing, rows):
    short = documents.where("length(text) < 10000 or text is null")
    want = Counter()
    for doc_id, text, *_ in rows:
        words = WORDS.findall(text or "")
        if len(words) < 10_000:
            found = runs_of(words)
            want[doc_id, tuple(found), collapsed(words, found)] += 1
    assert Counter((r.doc_id, tuple(map(tuple, r.runs)), r.collapsed) for r in periodic_runs.find_runs(short).collect()) == want
    (long,) = periodic_runs.find_runs(documents.where("length(text) > 10000")).collect()
    assert [tuple(r) for r in long.runs] == [(0, 30_000, 1)] and len(long.collapsed.split()) == 5_001
    assert periodic_runs.find_runs(nothing).collect() == []


def test_blocks_do_not_change_runs(documents, monkeypatch):
    want = Counter((r.doc_id, tuple(map(tuple, r.runs)), r.collapsed) for r in periodic_runs.find_runs(documents).collect())
    monkeypatch.setattr(periodic_runs, "BLOCK_WORDS", 1)
    assert Counter((r.doc_id, tuple(map(tuple, r.runs)), r.collapsed) for r in periodic_runs.find_runs(documents).collect()) == want


def test_run_query_equals_its_contract(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = Counter()
    for doc_id, text in docs:
        words = WORDS.findall(text or "")
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        if n > 400:
            words = words[:0]  # brute force is quadratic; longer ones are left to the other tests
        found = runs_of(words)
        best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
        milli = None if best[0] is None else 1000 * best[1] // best[2]
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join("%d,%d,%d\n" % r for r in found), collapsed(words, found))]
        if n <= 400:
            want[doc_id, len(found), *best, milli, *sha] += 1
    out = queries.QUERIES["op11_periodic_run_detection"](spark, SMALL)
    short = {k[0] for k in want}
    assert Counter(tuple(r) for r in out.collect() if r.doc_id in short) == want
    assert sum(n for k, n in want.items() if k[1]) > 5


def ids_of(tokenizer, text: str | None) -> list[int]:
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def test_token_files_read_back_what_the_tokenizer_gives(spark, documents, nothing, rows, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    path = str(tmp_path / "tokens")
    token_files.write(documents, path, TOKENIZER, length=64, shard_bytes=3_000)
    out = sorted(token_files.read(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in out] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i))
    want = Counter((r[0], tuple(ids_of(tokenizer, r[1]))) for r in rows)
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in out) == want
    at = 0
    for r in out:
        assert r.start == at
        at += len(r.ids) // 4
    manifest = spark.read.parquet(f"{path}/manifest").orderBy("start").collect()
    assert len(manifest) > 4 and sum(r.n_tokens for r in manifest) == at and sum(r.n_documents for r in manifest) == len(rows)
    again = str(tmp_path / "again")
    token_files.write(documents, again, TOKENIZER)  # other shards, same ids
    assert Counter(map(tuple, token_files.read(spark, again).collect())) == Counter(map(tuple, out))
    empty = str(tmp_path / "empty")
    token_files.write(nothing, empty, TOKENIZER)
    assert token_files.read(spark, empty).collect() == []


def test_sequences_of_a_mapped_file_are_views(documents, tmp_path):
    path = tmp_path / "tokens"
    token_files.write(documents, str(path), TOKENIZER, length=32)
    for file in (path / "shards").glob("part-*"):
        shard = token_files.Shard(str(file))
        counts = shard.documents.column("n_tokens").to_pylist()
        flat, ends, used = [], [], 0
        before = pa.total_allocated_bytes()
        for i in range(len(shard)):
            ids, mask, last = shard[i]
            assert len(ids) == len(mask) == len(last) == 32 and ids.dtype == np.uint16 and not ids.flags.owndata
            flat += ids[mask].tolist()
            ends += last[mask].tolist()
            used += int(mask.sum())
            assert not ids[~mask].any()
        assert used == shard.n_tokens == sum(counts) and pa.total_allocated_bytes() - before < 10_000
        assert np.flatnonzero(ends).tolist() == (np.cumsum(counts) - 1).tolist()
        assert [x for own in shard.ids() for x in own.tolist()] == flat


def test_words_that_come_once_take_no_place_from_others(monkeypatch):
    monkeypatch.setattr(token_files, "CACHED_WORDS", 1000)
    encode, whole = token_files.Encoder(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    texts = ["the frönt door. opens, the frönt\ndoor. opens, "] * 2 + [" ".join(f"once{chr(97 + n // 26)}{chr(97 + n % 26)}" for n in range(400))]
    for text in [*texts, texts[0]]:
        assert np.frombuffer(encode(text), np.uint16).tolist() == whole.encode(text, add_special_tokens=False).ids
    assert {"door.", "opens,", "frönt"} <= set(encode.words) and len(encode.words) < 20


def test_tokens_of_odd_texts():
    encode = token_files.Encoder(TOKENIZER)
    rng = random.Random(1)
    parts = ["a", "b", "Z", "é", "ß", "'s", "'t", "'re", "'", " ", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", " ", "　", "​"]
    parts += [".", ",", "!?", "..", "1", "23", "²", "中", "か", "ʰ", "ǅ", "́", "<|endoftext|>", "<", "|", "_", "Ġ", "\x00", "😀", "Ω", "&&&", "$"]
    for _ in range(4_000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 12)))
        want = encode.words.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encode(text), "u2").tolist() == want, text


def test_full_cache_changes_no_ids(monkeypatch):
    monkeypatch.setattr(token_files, "CACHED_WORDS", 3)
    encode = token_files.Encoder(TOKENIZER)
    text = "One two, three. four;\nFive six! seven&&& eight One two,"
    assert np.frombuffer(encode(text), "u2").tolist() == encode.words.tokenizer.encode(text, add_special_tokens=False).ids
    assert len(encode.words) <= 3


def h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def spelt(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(digests: list[str]) -> tuple[str, list[list[list[str]]]]:
    """The root, and for each leaf the siblings left and right of it, level by level."""
    paths: list[list] = [[] for _ in digests]
    owners = [[i] for i in range(len(digests))]
    while len(digests) > 1:
        upper, upper_owners = [], []
        for at in range(0, len(digests), 16):
            run = digests[at : at + 16]
            for k, own in enumerate(owners[at : at + 16]):
                for i in own:
                    paths[i].append(["".join(run[:k]), "".join(run[k + 1 :])])
            upper.append(h("".join(run)))
            upper_owners.append([i for own in owners[at : at + 16] for i in own])
        digests, owners = upper, upper_owners
    return digests[0], paths


def test_merkle_proofs_equal_brute_force(documents, nothing, rows):
    groups: dict = {}
    for doc_id, text, lang, source, n_chars, *_ in rows:
        make = lambda t: h("".join(map(spelt, (doc_id, source, lang, n_chars, t))))  # noqa: B023, E731
        groups.setdefault(source, []).append((doc_id is not None, doc_id or 0, make(text), make(None if text is None else text.upper()), doc_id))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    below = {}
    for name in names:
        groups[name].sort()
        below[name] = tree([g[2] for g in groups[name]])
    root, over = tree([below[name][0] for name in names])
    want = Counter()
    for k, name in enumerate(names):
        for (_, _, leaf, other, doc_id), own in zip(groups[name], below[name][1]):
            want[doc_id, leaf, other, below[name][0], root, tuple(map(tuple, [*own, *over[k]]))] += 1
    out = merkle.proofs(documents, F.upper("text")).withColumns({"proof": merkle.siblings(F.col("path")), "folded": merkle.folded(F.col("leaf"), F.col("path"))})
    out = out.withColumn("refolded", merkle.folded(F.col("other"), F.col("path"))).collect()
    assert Counter((r.doc_id, r.leaf, r.other, r.subroot, r.root, tuple(map(tuple, r.path))) for r in out) == want
    assert all(r.folded == root and (r.refolded == root) == (r.other == r.leaf) for r in out)
    assert all(r.proof == "".join(left + right for left, right in r.path) for r in out)
    assert merkle.proofs(nothing).collect() == []


def test_one_document_is_its_own_root(spark):
    (row,) = merkle.proofs(spark.createDataFrame([(7, "t", "en", "s", 1)], "doc_id int, text string, lang string, source string, n_chars long")).collect()
    assert row.leaf == row.subroot == row.root == h("1:71:s2:en1:11:t") and row.path == []


def test_ranks_without_ties_take_the_short_way(spark):
    ids = [2**40 + 5, -3, 0, 32_767, 32_768, 511, 512, -(2**63), 2**63 - 1, 70_000 * 32_768]
    leaves = spark.createDataFrame([("t", i, h(str(i)), "") for i in ids], "tree string, doc_id long, leaf string, other string")
    out, most = merkle.placed(leaves)
    assert most == len(ids) and {r.doc_id: r.place for r in out.collect()} == {i: k for k, i in enumerate(sorted(ids))}


def test_merkle_query_against_its_sql(spark):
    from check_oracle import compare, connect

    out = queries.QUERIES["op13_merkle_manifest"](spark, SMALL)
    assert compare(connect(SMALL), out, queries.ORACLES["op13_merkle_manifest"]) is None
