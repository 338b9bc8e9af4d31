"""Operators on documents against brute force, and their defined results on odd input."""

from __future__ import annotations

import hashlib
import random
import re
import textwrap
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from reelstat.llm import decontaminate, licenses, near_dedup, packing, paragraph_dedup, quality, toxicity
from reelstat.llm import shingles as signing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, id string, kept string, hash string"
LETTERS = "abcdefghijklmnopqrstuvwxyzäé"


def prose(rng: random.Random, n: int, vocabulary: int = 3000) -> list[str]:
    words = [("".join(LETTERS[(k * 7 + i * 13) % 28] for i in range(2 + k % 5)) + str(k)) for k in rng.choices(range(vocabulary), k=n)]
    for i in range(0, n, 8):
        words[i] = words[i].capitalize()
        words[i - 1] += "."
    return words


@pytest.fixture(scope="module")
def documents(spark):
    rng = random.Random(7)
    texts: list[str | None] = [None, "", " \n\t", "one", "one", "Two words", "the. " * 400]
    for _ in range(40):
        words = prose(rng, rng.randint(30, 300))
        texts.append(" ".join(words))
        for _ in range(rng.randint(0, 3)):
            copy = list(words)
            for _ in range(rng.randint(0, 6)):
                copy[rng.randrange(len(copy))] = "edit" + str(rng.randrange(99))
            texts.append(" ".join(copy))
    passage = " ".join(prose(rng, 70))
    texts += [" ".join(prose(rng, 90)) + " " + passage + " " + " ".join(prose(rng, 90)).lower() for _ in range(5)]
    texts.append(" ".join(prose(rng, 20_000, 90_000)))  # very long
    rows = [(i, t, None if i % 5 else "en", f"s{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[9], rows[9], (None, texts[12], None, None, None), (None, None, None, None, None)]
    return spark.createDataFrame([(*r, "r", "i", "k", "h") for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text: str | None) -> frozenset:
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def components(rows: list[tuple]) -> list:
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
            parent[root(i)] = root(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)].append(doc_id)
    return [min(least[root(i)], default=None) for i in range(len(rows))]


def test_near_dedup_equals_brute_force(documents, nothing):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    want = Counter((d, len(shingles(t)), c, d == c) for (d, t), c in zip(rows, components(rows)))
    assert Counter(map(tuple, near_dedup.near_duplicates(documents).collect())) == want
    kept = near_dedup.keep_one(documents)
    assert kept.columns == documents.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, *_, k in want if k}
    assert near_dedup.near_duplicates(nothing).collect() == []


def test_keep_one_leaves_one_row_of_each_group(spark):
    rng = random.Random(4)
    a, b, c, d = (" ".join(prose(rng, 100)) for _ in range(4))
    near = lambda text: text + " and more"
    rows = [(1, a), (1, a), (2, near(a)), (2, b), (3, c), (3, near(c)), (4, None), (4, None), (5, ""), (None, near(b)), (None, d), (None, d)]
    kept = near_dedup.keep_one(spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, source string"))
    assert kept.columns == ["doc_id", "text", "source"]
    out = Counter((r.doc_id, r.text) for r in kept.collect())
    assert out - Counter([(3, c), (3, near(c))]) == Counter([(1, a), (2, b), (4, None), (5, ""), (None, d)])
    assert out[3, c] + out[3, near(c)] == 1


def test_across_links_what_hubs_leave_apart(spark):
    """A chain of texts, each similar only to its neighbours, is one component."""
    rng = random.Random(3)
    words, texts = prose(rng, 400), []
    for _ in range(30):
        texts.append(" ".join(words))
        at = rng.randrange(0, 380)
        words = [*words[:at], *prose(rng, 20), *words[at + 20 :]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.component_id for r in near_dedup.near_duplicates(docs).collect()] == components(list(enumerate(texts)))


def base_counts(text: str | None) -> tuple:
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, inside = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7)), set()
    for i in range(len(w) - 7):
        if seen[tuple(w[i : i + 8])] > 1:
            inside.update(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(w) < 20 or 100 * len(inside) > 30 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside), failed


def test_quality_counts_and_verdict(documents, nothing, spark):
    out = quality.judged(documents).collect()
    assert Counter((r.doc_id, *tuple(r)[-8:-2]) for r in out) == Counter((r.doc_id, *base_counts(r.text)) for r in documents.collect())
    assert all(r.kept == (not r.base_failed and r.probability >= 0.5) for r in out)
    assert quality.judged(nothing).collect() == []
    rng = random.Random(1)
    clean = [" ".join(["The of and", *prose(rng, 80)]) for _ in range(60)]
    junk = [" ".join(w + "%%%" for w in prose(rng, 80)) for _ in range(12)]
    docs = spark.createDataFrame(list(enumerate(clean + junk)), "doc_id long, text string")
    assert {r.doc_id for r in quality.keep_good(docs).collect()} == set(range(60))


def test_estimation_finds_the_rule_that_errs():
    good, bad = quality.GOOD, quality.BAD
    patterns = [((good,) * 8, 800), ((bad,) * 7 + (good,), 100), ((good,) * 7 + (bad,), 100)]
    prior, on_good, on_bad = quality.estimate(patterns)
    assert 0.8 < prior < 0.95
    assert on_bad[0][bad] > 0.8 and on_bad[7][bad] < 0.3


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def test_decontamination_equals_brute_force(documents, nothing, spark):
    texts = [r.text for r in documents.collect() if r.text and len(r.text) > 600]
    lower = lambda t: (t or "").encode().lower().decode()
    items = [(1, " ".join(texts[0].split()[3:30])), (2, "short ITEM, here"), (10, texts[3][40:300]), (3, None), (4, ""), (5, texts[0][:300])]
    more = [(9001, "A short item here, and a short item: HERE."), (9002, "x " + texts[3][30:320])]
    docs = documents.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    held = defaultdict(set)
    for item, text in items:
        w = WORD.findall(lower(text))
        for i in range(max(len(w) - 12, 1) if w else 0):
            held[tuple(w[i : i + 13])].add(item)
    want = Counter()
    for doc_id, text in docs.collect():
        w, hit, found = WORD.findall(lower(text)), set(), set()
        for n in {len(k) for k in held}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in held:
                    hit.update(range(i, i + n))
                    found |= held[tuple(w[i : i + n])]
        sha = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        want[doc_id, len(w), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(w)] += 1
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert Counter(map(tuple, decontaminate.contamination(docs, benchmark).collect())) == want
    bad = {k[0] for k in want if k[5]}
    left = decontaminate.remove_documents(documents, benchmark)
    assert left.columns == documents.columns and not bad & {r.doc_id for r in left.collect()}
    assert left.count() == documents.count() - sum(n for k, n in want.items() if k[5] and (k[0] is None or k[0] < 9000))
    spans = {r.doc_id: r.text for r in decontaminate.remove_spans(docs, benchmark).collect()}
    assert spans[9001] == "A, and a." and spans[0] is None
    assert decontaminate.contamination(nothing, benchmark).collect() == []
    empty = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in decontaminate.contamination(documents, empty).collect())


def test_decontamination_by_a_shuffle_join_carries_windows_only(documents, spark, monkeypatch):
    text = next(r.text for r in documents.where("length(text) > 600").collect())
    benchmark = spark.createDataFrame([(1, " ".join(text.split()[3:30])), (2, "one")], "item_id long, text string")
    want = Counter(map(tuple, decontaminate.contamination(documents, benchmark).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    assert Counter(map(tuple, decontaminate.contamination(documents, benchmark).collect())) == want
    plan = decontaminate.scanned(documents, benchmark)._jdf.queryExecution().optimizedPlan().toString()
    (join,) = [line for line in plan.split("\n") if "Join Left" in line]
    assert "words" not in join


def test_packing_keeps_every_id_once(documents, nothing):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = [tuple(r) for r in packing.pack(documents, path).collect()]
    ids = [[*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1] for r in documents.collect()]
    cut = Counter()
    for doc, own in zip(documents.collect(), ids):
        for start in range(0, len(own), 2048):
            part = own[start : start + 2048]
            cut[doc.doc_id, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(own)] += 1
    assert Counter(r[:5] for r in rows) == cut
    ends: dict[int, int] = {}
    for *_, length, _, _, sequence, offset in sorted((r[:2] + r[2:] for r in rows), key=lambda r: r[5:]):
        assert offset == ends.get(sequence, 0)
        ends[sequence] = offset + length
    assert max(ends.values()) <= 2048 and set(ends) == set(range(len(ends)))
    assert packing.pack(nothing, path).collect() == []


@pytest.mark.parametrize("seed", range(20))
def test_plan_places_every_length_and_fits(seed):
    rng = random.Random(seed)
    histogram = {rng.randint(1, 64): rng.randint(1, 200) for _ in range(rng.randint(1, 40))}
    plan = packing.plan(histogram, 64)
    placed = Counter()
    for count, held in plan:
        assert count > 0 and sum(n * k for n, k in held.items()) <= 64
        for length, each in held.items():
            placed[length] += count * each
    assert placed == histogram and len(plan) <= 2 * len(histogram)


def test_tokens_of_odd_white_space():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    encode, plain = packing.Encoder(path), Tokenizer.from_file(path)
    texts = ["I'm  a x<|endoftext|>y don't \u0301a ΟΔΟΣ İ \x1c\x1d a\x1fb \x85 \u200b q 123 ...", "a\x0bb\x0cc\td", "テスト 12!?", "a\u0000b", ""]
    texts += ["Of%%% the&&& Éa. élan, it's it.'s a.b. Ab!? x|y A\u0301. ΣΑΣ. STRASSE ß; ǅ, ª. ²"]
    for text, ids in zip(texts, encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_passages_are_found_and_removed(documents, nothing):
    named = lambda doc_id: -1 if doc_id is None else doc_id
    rows = [(named(r.doc_id), r.text or "") for r in documents.collect()]
    holders = defaultdict(set)
    for doc_id, text in rows:
        w = text.lower().split()
        for i in range(len(w) - 49 if len(w) < 5000 else 0):
            holders[tuple(w[i : i + 50])].add(doc_id)
    exact = {d for v in holders.values() if len(v) > 1 for d in v}
    out = paragraph_dedup.report(documents).collect()
    near = {d for (d, _), c in zip(rows, components(rows)) for (e, _), f in zip(rows, components(rows)) if d != e and c == f}
    assert exact <= {named(r.doc_id) for r in out} <= exact | near
    left = paragraph_dedup.remove_passages(documents)
    assert left.columns == documents.columns
    last = [r for r in left.collect() if r.doc_id is not None and r.doc_id in sorted(exact)[-4:]]
    assert len(last) == 4 and all(len(r.text.split()) < 200 for r in last)
    assert paragraph_dedup.report(nothing).collect() == [] and paragraph_dedup.remove_passages(nothing).collect() == []


def test_passages_at_any_offset_equal_brute_force(spark):
    """Lower-case text without stops in lines of ten words, so that no line is a written paragraph."""
    rng = random.Random(11)
    plain = lambda n: [w.lower().rstrip(".") for w in prose(rng, n, 90_000)]
    passages = [plain(n) for n in (49, 50, 51, 57, 75, 140)]
    rows = [(i, ["the"] * (40 + 15 * i) + plain(60)) for i in range(4)] + [(4, ["a", "b", "c"] * 40), (5, ["b", "c", "a"] * 30)]
    for i in range(10, 70):
        words = plain(rng.randint(0, 90))
        for passage in rng.sample(passages, rng.randint(0, 3)):
            cut = rng.choice([0, 0, rng.randint(0, 20)])
            words += passage[cut:] + plain(rng.randint(0, 40))
        rows.append((i if rng.random() < 0.9 else None, words))
    rows += [rows[20], (rows[21][0], rows[22][1]), (99, rows[30][1][3:] + passages[5])]
    holders = defaultdict(set)
    for doc_id, words in rows:
        for i in range(len(words) - 49):
            holders[tuple(words[i : i + 50])].add(-1 if doc_id is None else doc_id)
    want = Counter()
    for doc_id, words in {(d, tuple(w)) for d, w in rows}:
        own, spans = -1 if doc_id is None else doc_id, [(i, holders[words[i : i + 50]]) for i in range(len(words) - 49)]
        shared = {p for i, held in spans if len(held) > 1 for p in range(i, i + 50)}
        removed = {p for i, held in spans if min(held) < own for p in range(i, i + 50)}
        firsts = sorted({min(held) for _, held in spans if len(held) > 1})
        if shared:
            want[doc_id, len(shared), len(removed), tuple(None if f < 0 else f for f in firsts)] += 1
    texts = [(d, "\n".join(" ".join(w[i : i + 10]) for i in range(0, len(w), 10))) for d, w in rows]
    out = paragraph_dedup.report(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.n_repeated, r.n_removed, tuple(r.first_ids)) for r in out) == want


def test_spans_are_cut_at_words():
    assert paragraph_dedup.without("á b\n c  d e", [(1, 3), (2, 3)]) == "á d e"
    assert paragraph_dedup.without("a b", [(0, 2)]) == ""


def test_toxicity_learns_from_the_other_folds_only(spark, nothing):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(400):
        words, toxic = prose(rng, 40), i % 8 == 0
        for _ in range(3 * toxic):
            words[rng.randrange(40)] = rng.choice(["blarg", "blargish", "moron"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame([*rows, (None, None), (9999, "")], "doc_id long, text string")
    known = spark.createDataFrame([*labels, (3, None), (None, 1)], "doc_id long, toxic int")
    out = toxicity.score(docs, known).collect()
    assert len(out) == 402 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    truth = dict(labels)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out if r.doc_id is not None)
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    lied = spark.createDataFrame([(d, 1 - t if zlib.crc32(str(d).encode()) % 5 == 0 else t) for d, t in labels], known.schema)
    assert Counter(map(tuple, toxicity.score(docs, lied).collect())) == Counter(map(tuple, out))
    assert toxicity.score(nothing, known).collect() == []
    assert len(toxicity.score(docs, known.limit(0)).collect()) == 402


def test_clauses_weigh_negation_speech_and_targets():
    weigh = lambda text: toxicity.features(text, toxicity.Lexicon({}))[0]
    assert weigh("you idiot") > weigh("an idiot") > weigh("he said an idiot") > 0
    assert weigh("not an idiot") < weigh("an idiot")
    assert weigh("I will kill you") > weigh("kill the process")
    assert weigh("nothing here") == 0
    assert weigh("an idiot, you") == weigh("you idiot")  # the target may come last
    assert weigh('he said: "you idiot"') < weigh("an idiot") and weigh('he said so. "you idiot"') == weigh("you idiot")
    assert weigh("not bad, an idiot") == weigh("an idiot") > weigh("not bad an idiot")
    assert weigh("stupid idiot") > 2 * weigh("an idiot")


def test_the_composed_grammar_does_what_its_transducers_do_in_sequence():
    rng = random.Random(3)
    for _ in range(3000):
        labels = [(label, float(rng.randrange(1, 9))) for label in rng.choices(toxicity.LABELS, k=rng.randrange(13))]
        assert abs(toxicity.clause_weight(labels) - toxicity.in_sequence(labels)) < 1e-9
    assert len(toxicity.outputs(toxicity.GRAMMAR, [(toxicity.INSULT, 1.0)])) == 1


def test_the_grammar_tells_quoted_and_negated_insults_from_meant_ones():
    """The same words in all documents: only what the transducers do with them can tell the labels."""
    rng = random.Random(8)
    rows = []
    for i in range(300):
        toxic = i % 2
        insult = rng.choice(["idiot", "moron", "loser", "clown"])
        clauses = [["he", "said", "you", insult], ["never", "a", insult], ["you"]] if not toxic else [["you", insult], ["you", insult], ["he", "said", "never"]]
        rng.shuffle(clauses)
        rows.append((". ".join(" ".join([*prose(rng, 3), *clause]) for clause in clauses), toxic))
    flat = toxicity._machine(1, lambda state, label: (0, label, 1.0))

    def missed(grammar, plain=False):
        lexicon = toxicity.Lexicon({})
        x = np.array([toxicity.features(text, lexicon, grammar)[: 1 if plain else 4] for text, _ in rows])
        y = np.array([toxic for _, toxic in rows], float)
        w = toxicity.fit(x[:200], y[:200])
        return int(((np.column_stack([x[200:], np.ones(100)]) @ w >= 0) != y[200:]).sum())

    assert missed(toxicity.GRAMMAR, plain=True) == 0 and missed(flat, plain=True) >= 30


def test_licenses_by_sentences(spark, nothing):
    rules = {"A": ["First line. Second line."], "B": ["First line."], "C": ["Other, 2.0."]}
    texts = [None, "", "x\nFIRST   line.\nmiddle words. Second-line!", "Second line. First line.", "say other 2.0. no\nOther 2.0."]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, licenses string")
    out = {r.doc_id: (list(r.sentence_ids), list(r.licenses)) for r in licenses.recognised(docs, rules).collect()}
    assert out == {0: ([], []), 1: ([], []), 2: ([1, 2], ["A"]), 3: ([2, 1], ["B"]), 4: ([3], ["C"])}
    assert licenses.recognised(nothing, rules).collect() == []
    assert all(not r.licenses for r in licenses.recognised(docs, {}).collect())


def scanned_plainly(text: str, rules: dict[str, list[str]]) -> tuple[list[int], list[str]]:
    """Licenses by trying, in each stretch between sentence ends, every line as the beginning of the last sentence."""
    known = licenses.identifiers(rules)
    ids: list[int] = []
    for stretch in re.split(licenses.ENDS, re.sub("[A-Z]", lambda m: m[0].lower(), text)):
        lines = [s for s in map(licenses.normal, stretch.split("\n")) if s]
        cut = next((i for i in range(len(lines)) if " ".join(lines[i:]) in known), len(lines))
        ids += [known[s] for s in [*lines[:cut], " ".join(lines[cut:])] if s in known]
    names, chain = set(), ids
    for name, sentences in sorted(licenses._sequences(rules), key=lambda rule: (-len(rule[1]), rule[0])):
        sequence, kept, i = [known[s] for s in sentences], [], 0
        while i < len(chain):
            if chain[i : i + len(sequence)] == sequence:
                names.add(name)
                kept, i = [*kept, 0], i + len(sequence)
            else:
                kept, i = [*kept, chain[i]], i + 1
        chain = kept
    return ids, sorted(names)


def test_usual_notices_and_brute_force(spark):
    """Wrapped and commented notices, tags, headings, rules inside rules, repeated rows, a very long text, clashing names."""
    rules = licenses.LICENSE_TEXTS
    rng = random.Random(4)
    wrapped = lambda text, mark: "\n".join(
        f"{mark} {line}" for part in text.split("\n") for line in textwrap.wrap(part, rng.randint(20, 70)) or [""]
    )
    texts, want = [None, ""], [[], []]
    for name, stated in rules.items():
        for text in stated:
            after = "\nMore text" if text.endswith(".") else "\n\nMore text"
            texts += [f"Some Title\n{wrapped(text, mark)}{after}" for mark in ("", "#", " *", "//")]
            want += [[name]] * 4
        texts.append(f"// SPDX-License-Identifier: {name}\nint x;")
        want.append([name])
    numbered = rules["BSD-3-Clause"][0].replace("\n\nRe", "\n1. Re").replace("\n\nNe", "\n3. Ne")
    texts += [numbered, "word " * 300_000 + "\n\n" + rules["MIT"][2], "line\n" * 50_000 + "\n* \n" * 50_000 + "All rights reserved", "mit license", numbered]
    want += [["BSD-3-Clause"], ["MIT"], ["proprietary"], [], ["BSD-3-Clause"]]
    every = [part for text in texts if text and len(text) < 5_000 for part in re.split("(?<=[.:])", text)]
    texts += ["".join(rng.choices(every, k=12)) for _ in range(150)]
    schema = "_chain long, text string, row string, names long, ids string, chain string, flat string, _m0 int"
    docs = spark.createDataFrame([(i, t, "r", i, "i", "c", "f", 5) for i, t in enumerate(texts)], schema)
    out = sorted(licenses.recognised(docs.repartition(4)).collect(), key=lambda r: r["_chain"])
    assert [list(r.licenses) for r in out[: len(want)]] == want
    assert [(list(r.sentence_ids), list(r.licenses)) for r in out] == [scanned_plainly(t or "", rules) for t in texts]
    assert all((r["names"], r.ids, r.chain, r.flat, r["_m0"], r.row, r.text) == (r["_chain"], "i", "c", "f", 5, "r", texts[r["_chain"]]) for r in out)


def test_helper_names_of_the_caller_stay(spark):
    """Columns that have the names of helpers, in the operators that return whole documents."""
    text = " ".join(prose(random.Random(9), 60))
    names = ["_hash", "_starts", "hash", "digest", "starts", "row_id", "text_hash", "component", "place", "copies", "a.b"]
    schema = "doc_id long, text string, " + ", ".join(f"`{n}` long" for n in names)
    rows = [(i, t, *[10 * i + k for k in range(len(names))]) for i, t in enumerate([text, text, None, "", "other words"])]
    docs = spark.createDataFrame(rows, schema)
    assert sorted(map(tuple, near_dedup.keep_one(docs).collect())) == sorted([rows[0], *rows[2:]], key=lambda r: r[0])
    items = spark.createDataFrame([("x", " ".join(text.split()[20:40]))], "item_id string, text string")
    out = {r[0]: tuple(r) for r in decontaminate.remove_spans(docs, items).collect()}
    assert [out[i][2:] for i in range(5)] == [r[2:] for r in rows] and out[4] == rows[4] and out[0][1] != text
    assert sorted(r[0] for r in decontaminate.remove_documents(docs, items).collect()) == [2, 3, 4]


def test_sets_of_many_texts_are_those_of_each():
    some = random.Random(5)
    texts = [" ".join(some.choices("a B c dd é É".split(), k=n)) for n in (0, 1, 4, 5, 6, 60, 0, 3000, 9000, 2)]
    texts = [None, *texts, "", "a\tB  c\nd e f"]
    values, bounds = signing.shingle_sets(texts)
    each = [signing.shingle_set(text) for text in texts]
    assert [values[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [own.tolist() for own in each]
    factors, held = signing.multipliers(20), [own for own in each if len(own)]
    least = signing.minhashes(values, np.unique(bounds), factors)
    assert least.tolist() == [signing.minhash(own, factors).tolist() for own in held]
    for one in held:
        both, either = signing.overlaps(one, held)
        assert list(zip(both.tolist(), either.tolist())) == [signing.overlap(one, other) for other in held]
    assert [len(x) for x in signing.shingle_sets([])] == [0, 1]
    assert [text for group in signing.groups(texts, 50) for text in group] == texts
