"""Toxicity by a weighted finite-state grammar over clauses.

A lexicon turns words into labels with weights: insult, threat, intent, target, negation, reported speech, pause, other.
Its insults and threats are the listed ones and those learnt from labelled rows: word beginnings that toxic documents hold
significantly more often than others, with their log-odds as weight. Five transducers read a clause one after another; an
arc rewrites a label and multiplies the weight that stands there:

- `SPEECH_MACHINE` damps what follows a verb of saying up to the end of the clause, and takes its target from it;
- `NEGATION_MACHINE` damps the three words after a negation, up to a pause;
- `INSULT_MACHINE` raises an insult right after another one;
- `THREAT_MACHINE` halves a threat without a word of intent before it;
- `TARGET_MACHINE` raises what stands in a clause with a target, which may come last: it guesses from the start whether
  there is one, and only the right guess is accepted. A threat without a target counts little.

They are composed once into one machine (`compose`), whose paths over a clause are followed in one pass; `in_sequence` runs
them one by one and is what the composition is tested against. A document is judged by its matched clauses: the heaviest,
their sum, their number and their share. How far these speak for label 1 is a logistic fit.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstat.llm.scratch import save

#: Labelled rows that are learnt from, chosen by the hash of their id. It bounds what is broadcast: ids and labels first,
#: then the terms, which are at most those of so many documents that three toxic ones or more hold.
MAX_ROWS = 50_000
LEAST_WEIGHT = 2.5
STEMS = (4, 6)
CACHED_WORDS = 300_000
TOKENS = re.compile(r"[^\W\d_]+|[.!?;:,()\"“”«»\n]")
ENDS = set(".!?;\n")  # of clauses; other marks are pauses inside them
LABELS = OTHER, INSULT, THREAT, TARGET, NEGATION, SPEECH, INTENT, PAUSE = range(8)
HARM = (INSULT, THREAT)

#: Words of the grammar in English, German, French and Spanish.
LISTED = {
    INSULT: "idiot idiots moron morons stupid dumb loser losers scum trash worthless pathetic disgusting clown imbecile "
    "dummkopf trottel abschaum wertlos connard débile ordure minable estúpido imbécil basura inútil",
    THREAT: "kill hurt destroy beat shoot murder töten umbringen schlagen tuer frapper détruire matar golpear destruir",
    TARGET: "you your he she they them him her du dich ihr euch er sie tu toi vous te il elle ils tú usted ustedes él ella",
    NEGATION: "not never no neither nor isn aren don nicht nie kein keine pas jamais aucun nunca jamás tampoco",
    INTENT: "will ll gonna going should must want werde wirst soll sollte vais va devrait veux voy va debería quiero",
    PAUSE: ", : ( ) \" “ ” « »",
    SPEECH: "said says wrote claims claimed quoted reported sagte schrieb behauptet dit écrit affirme dijo escribió afirma",
}


def stems(word: str) -> tuple[str, ...]:
    """The word itself, closed by a full stop, and its beginnings."""
    return (word + ".", *(word[:n] for n in STEMS if len(word) >= n))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist()):
            found = set(re.findall(r"[^\W\d_]{3,}", (text.as_py() or "").lower()))
            seen[toxic].update({s for word in found for s in stems(word)})
        terms = list(seen[0].keys() | seen[1].keys())
        columns = [pa.array(terms, pa.string()), *(pa.array([seen[i][t] for t in terms], pa.int64()) for i in (1, 0))]
        yield pa.RecordBatch.from_arrays(columns, ["term", "toxic", "clean"])


def learn_terms(train: DataFrame, least_weight: float = LEAST_WEIGHT) -> dict[str, float]:
    """From rows (text, toxic): the terms whose log-odds are above `least_weight` with 95 % confidence."""
    totals = train.agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")).first()
    if not totals.toxic or not totals.clean:
        return {}
    counts = train.select("text", "toxic").mapInArrow(_counted, "term string, toxic long, clean long")
    counts = counts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where("toxic > 2")
    toxic, clean = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.log(toxic / (totals.toxic + 1)) - F.log(clean / (totals.clean + 1))
    sure = odds - 1.64 * F.sqrt(1 / toxic + 1 / clean)
    found = counts.select("term", sure.alias("weight")).where(F.col("weight") > least_weight)
    return {row.term: row.weight for row in found.collect()}


class Lexicon:
    """Words to (label, weight). The cache of words is emptied when it is full, which changes no result."""

    def __init__(self, learnt: dict[str, float]):
        self.learnt = learnt
        listed_weight = {INSULT: 2.0, THREAT: 2.0}
        self.listed = {w: (label, listed_weight.get(label, 0.0)) for label, words in LISTED.items() for w in words.split()}
        self.known: dict[str, tuple[int, float]] = {}

    def __call__(self, word: str) -> tuple[int, float]:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= CACHED_WORDS:
                self.known = {}
            label, weight = self.listed.get(word, (OTHER, 0.0))
            learnt = max((self.learnt[s] for s in stems(word) if s in self.learnt), default=0.0)
            if learnt and label in (OTHER, INSULT, THREAT):
                label, weight = (INSULT if label == OTHER else label), max(weight, learnt)
            found = self.known[word] = (label, weight)
        return found


@dataclass(frozen=True)
class Machine:
    """A weighted transducer over labels. An arc (state, label) leads to (state, label written, factor); a label without
    an arc is refused in that state."""

    starts: frozenset
    finals: frozenset
    arcs: dict


def _machine(states: int, arc, starts: Iterable[int] = (0,), finals: Iterable[int] | None = None) -> Machine:
    """Of the rule arc(state, label) -> (state, label written, factor) or None."""
    arcs = {(s, label): arc(s, label) for s in range(states) for label in LABELS}
    kept = frozenset(range(states) if finals is None else finals)
    return Machine(frozenset(starts), kept, {at: to for at, to in arcs.items() if to is not None})


def _speech(said: int, label: int):
    return int(said or label == SPEECH), OTHER if said and label == TARGET else label, 0.4 if said and label in HARM else 1.0


def _negation(left: int, label: int):
    after = 3 if label == NEGATION else 0 if label == PAUSE else max(left - 1, 0)
    return after, label, 0.3 if left and label in HARM else 1.0


def _insult(after_one: int, label: int):
    return int(label == INSULT), label, 1.2 if after_one and label == INSULT else 1.0


def _threat(intended: int, label: int):
    return int(intended or label == INTENT), label, 0.5 if label == THREAT and not intended else 1.0


_ALONE, _AWAITED, _ADDRESSED = range(3)


def _target(state: int, label: int):
    if label == TARGET:
        return None if state == _ALONE else (_ADDRESSED, label, 1.0)
    factors = {INSULT: 1.0, THREAT: 0.2} if state == _ALONE else {INSULT: 1.3, THREAT: 1.5}
    return state, label, factors.get(label, 1.0)


SPEECH_MACHINE = _machine(2, _speech)
NEGATION_MACHINE = _machine(4, _negation)
INSULT_MACHINE = _machine(2, _insult)
THREAT_MACHINE = _machine(2, _threat)
TARGET_MACHINE = _machine(3, _target, (_ALONE, _AWAITED), (_ALONE, _ADDRESSED))
MACHINES = (SPEECH_MACHINE, NEGATION_MACHINE, INSULT_MACHINE, THREAT_MACHINE, TARGET_MACHINE)


def compose(first: Machine, second: Machine) -> Machine:
    """One machine that does what `second` does to what `first` writes. Only states that can be reached are made."""
    starts = frozenset((a, b) for a in first.starts for b in second.starts)
    arcs, open_states, seen = {}, list(starts), set(starts)
    while open_states:
        a, b = state = open_states.pop()
        for label in LABELS:
            to_a = first.arcs.get((a, label))
            to_b = to_a and second.arcs.get((b, to_a[1]))
            if not to_b:
                continue
            after = (to_a[0], to_b[0])
            arcs[state, label] = (after, to_b[1], to_a[2] * to_b[2])
            if after not in seen:
                seen.add(after)
                open_states.append(after)
    return Machine(starts, frozenset(s for s in seen if s[0] in first.finals and s[1] in second.finals), arcs)


def _numbered(machine: Machine) -> Machine:
    """The same machine with whole numbers for states."""
    number = {s: i for i, s in enumerate(sorted({at for at, _ in machine.arcs}, key=repr))}
    arcs = {(number[at], label): (number[to], out, factor) for (at, label), (to, out, factor) in machine.arcs.items()}
    return Machine(frozenset(map(number.get, machine.starts)), frozenset(map(number.get, machine.finals)), arcs)


GRAMMAR = _numbered(reduce(compose, MACHINES))


def outputs(machine: Machine, labels: list[tuple[int, float]]) -> list[list[tuple[int, float]]]:
    """What the machine's accepted paths write, one for each."""
    written = []
    for state in sorted(machine.starts):
        out = []
        for label, weight in labels:
            arc = machine.arcs.get((state, label))
            if arc is None:
                break
            state = arc[0]
            out.append((arc[1], weight * arc[2]))
        else:
            if state in machine.finals:
                written.append(out)
    return written


def _harm(paths: list[list[tuple[int, float]]]) -> float:
    return max((sum(weight for label, weight in path if label in HARM) for path in paths), default=0.0)


def in_sequence(labels: list[tuple[int, float]], machines: Iterable[Machine] = MACHINES) -> float:
    """What the clause weighs when each machine reads all that the one before it wrote."""
    paths = [labels]
    for machine in machines:
        paths = [out for path in paths for out in outputs(machine, path)]
    return _harm(paths)


def clause_weight(labels: list[tuple[int, float]], grammar: Machine = GRAMMAR) -> float:
    """What the clause weighs by the composed machine."""
    return _harm(outputs(grammar, labels))


def features(text: str, lexicon: Lexicon, grammar: Machine = GRAMMAR) -> tuple[float, float, float, float]:
    """Heaviest clause, log of their sum, log of their number, share of the clauses that match."""
    tokens = TOKENS.findall(text.lower())
    labels = list(map(lexicon, tokens))
    heavy = [i for i, (label, _) in enumerate(labels) if label in HARM]
    if not heavy:
        return 0.0, 0.0, 0.0, 0.0
    weights, clauses, begin, at = [], 1, 0, 0
    for i, token in enumerate([*tokens, "."]):
        if token in ENDS:
            clauses += i > begin
            while at < len(heavy) and heavy[at] < begin:
                at += 1
            if at < len(heavy) and heavy[at] < i:
                weights.append(clause_weight(labels[begin:i], grammar))
            begin = i + 1
    return max(weights), math.log1p(sum(weights)), math.log1p(len(weights)), len(weights) / clauses


def _featured(terms):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(terms.value)
        for batch in batches:
            rows = [features(text.as_py() or "", lexicon) for text in batch.column("text")]
            columns = [pa.array(column, pa.float64()) for column in zip(*rows)] or [pa.array([], pa.float64())] * 4
            yield pa.RecordBatch.from_arrays([batch.column("row"), *columns], ["row", "f0", "f1", "f2", "f3"])

    return measure


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps; the last weight is the constant. No rows: never toxic."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    w[-1] = -2.0
    for _ in range(30 if len(x) and 0 < y.sum() < len(y) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        pull = ridge * w * ([1.0] * (len(w) - 1) + [0.01])
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w - np.linalg.solve(curve, x.T @ (p - y) + pull)
    return w


def _chosen(labels: DataFrame, folds: int) -> DataFrame:
    """(doc_id, toxic) of at most about MAX_ROWS ids outside the held-out fold; of several labels of an id the greatest."""
    known = labels.where(F.col("toxic").isin(0, 1) & (_fold(folds) != 0))
    known = save(known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    share = min(1.0, MAX_ROWS / max(1, known.count()))
    return known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * share))


def _fold(folds: int) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds, F.lit(0))


def score(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row; only labels of rows outside the held-out fold are learnt from.

    held_out: crc32(doc_id as text) mod folds is 0; a row of a null id is held out. Of several labels of an id the
    greatest counts. Null and empty texts match no clause and get the score of that. Repeated rows are scored each, very
    long texts as a whole; other columns are not looked at, whatever their names. No rows give no rows; without labels
    every score is that of a document that matches no clause.

    Texts are not shuffled: the chosen ids, MAX_ROWS at most, are broadcast to the documents.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", (_fold(folds) == 0).alias("held_out"))
    chosen = F.broadcast(_chosen(labels, folds))
    train = save(rows.where(~F.col("held_out")).join(chosen, "doc_id").select("doc_id", "text", "toxic"))
    terms = spark.sparkContext.broadcast(learn_terms(train))
    names = ["f0", "f1", "f2", "f3"]
    schema = "row struct<doc_id:bigint,toxic:int>, " + ", ".join(f"{n} double" for n in names)
    sample = train.select(F.struct(F.col("doc_id").cast("long"), "toxic").alias("row"), "text")
    seen = sample.mapInArrow(_featured(terms), schema).select("row.toxic", *names).toPandas()
    w = fit(seen[names].to_numpy(float), seen["toxic"].to_numpy(float))
    schema = schema.replace("toxic:int", "held_out:boolean")
    found = rows.select(F.struct(F.col("doc_id").cast("long"), "held_out").alias("row"), "text")
    found = found.mapInArrow(_featured(terms), schema)
    logit = sum((F.col(n) * float(v) for n, v in zip(names, w)), F.lit(float(w[-1])))
    scored = found.select("row.doc_id", "row.held_out", F.round(1 / (1 + F.exp(-logit)), 6).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
