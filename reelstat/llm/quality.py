"""Quality rules as weak supervision, in built-in functions only.

Each rule votes on a document (1 good, 0 bad) or abstains (2). No rule decides: expectation-maximisation estimates how
each rule votes on good and on bad documents, from its agreement with the others, and the posterior probability of
"good" decides. The estimation needs only how often each combination of votes occurs: at most 3 ** len(RULES) rows,
whatever the corpus (6,561 for eight rules), grouped by Spark over all documents and iterated over on the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstat.llm.native_text import words
from reelstat.llm.scratch import save

GOOD, BAD, ABSTAIN = 1, 0, 2
WINDOW = 8
SYMBOLS = "[#*$%&|<>]"
ROUNDS = 50
#: The commonest words of four languages.
COMMON = "the of and to in is that it der die das und zu ist mit le la les de et un que el los en y por no se".split()


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, BAD).when(good, GOOD).otherwise(ABSTAIN)


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


RULES = ("length", "word_length", "symbols", "lines", "repeats", "common_words", "sentences", "letters")


def rules() -> dict[str, Column]:
    """The votes, over the counts of `measured`."""
    return {
        "length": _vote(F.col("n_words") < 20, F.col("n_words") >= 20),
        "word_length": _vote(~_share("word_chars", "n_words").between(2, 14), _share("word_chars", "n_words").between(3, 11)),
        "symbols": _vote(_share("n_symbols", "word_chars") > 0.05, _share("n_symbols", "word_chars") < 0.01),
        "lines": _vote((F.col("n_dup_lines") > 3) & (_share("n_dup_lines", "n_lines") > 0.3), F.col("n_dup_lines") < 3),
        "repeats": _vote(_share("n_repeat_words", "n_words") > 0.3, _share("n_repeat_words", "n_words") < 0.1),
        "common_words": _vote(F.col("n_common") == 0, F.col("n_common") >= 3),
        "sentences": _vote(_share("n_stops", "n_words") < 0.005, _share("n_stops", "n_words").between(0.02, 0.4)),
        "letters": _vote(_share("n_letters", "word_chars") < 0.85, _share("n_letters", "word_chars") > 0.92),
    }


def _hashes() -> Column:
    """A hash of each window of eight words, in order."""
    starts = F.when(F.size("words") > WINDOW, F.sequence(F.lit(1), F.size("words") - WINDOW + 1))
    return F.coalesce(F.transform(starts, lambda i: F.xxhash64(F.slice("words", i, WINDOW))), F.array().cast("array<bigint>"))


def measured(docs: DataFrame, text_column: str, carried: list[str]) -> DataFrame:
    """The carried columns of the documents with the counts that rules look at.

    n_words; word_chars, code points in words; n_symbols; n_lines with a word and n_dup_lines equal to an earlier one;
    n_repeat_words, words in windows of eight words that the text holds twice or more, the first included; n_common,
    different common words; n_stops, sentence ends; n_letters. Null or empty text: all 0.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    named = {f"__{c}": F.col(f"`{c}`") for c in carried}  # own names stay clear of the counts
    split = docs.select(*[v.alias(k) for k, v in named.items()], text.alias("text"), words(text).alias("words"))
    split = split.withColumn("lines", F.filter(F.split("text", "\n"), lambda line: F.btrim(line, F.lit(" \t\r\f\x0b")) != ""))
    hashed = split.withColumn("hashes", _hashes())
    pairs = F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    several = F.size(F.array_distinct("hashes")) < F.size("hashes")
    ordered = hashed.withColumn("ordered", F.when(several, pairs))
    equal = lambda x, i: F.coalesce(F.get("ordered", i)["h"] == x["h"], F.lit(False))
    twice = F.filter("ordered", lambda x, i: equal(x, i - 1) | equal(x, i + 1))
    found = ordered.withColumn("starts", F.sort_array(F.transform(twice, lambda x: x["i"])))
    covered = F.aggregate(
        "starts",
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda a, p: F.struct((p + WINDOW).alias("end"), (a["n"] + p + WINDOW - F.greatest(p, a["end"])).alias("n")),
        lambda a: a["n"],
    )
    return found.select(
        *named,
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.char_length("text") - F.char_length(F.regexp_replace("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size(F.array_intersect("words", F.array(*map(F.lit, COMMON)))).alias("n_common"),
        (F.char_length("text") - F.char_length(F.regexp_replace("text", "[.!?]", ""))).alias("n_stops"),
        F.char_length(F.regexp_replace("text", "[^\\p{L}]+", "")).alias("n_letters"),
    )


def estimate(patterns: list[tuple[tuple[int, ...], int]], rounds: int = ROUNDS) -> tuple[float, list, list]:
    """From (votes, documents) pairs: the share of good documents and, by rule, how it votes on good and on bad ones.

    Starts from the majority of votes. Counts that favour right votes a little keep a rule that never votes defined.
    """
    total = sum(n for _, n in patterns)
    posterior = [min(0.95, max(0.05, (v.count(GOOD) + 1) / (v.count(GOOD) + 2 * v.count(BAD) + 2))) for v, _ in patterns]
    prior, good, bad = 0.8, [], []
    for _ in range(rounds):
        mass = sum(p * n for p, (_, n) in zip(posterior, patterns))
        prior = (mass + 8) / (total + 10)
        good, bad = [], []
        for j in range(len(RULES)):
            on_good, on_bad = {GOOD: 4.0, BAD: 0.5, ABSTAIN: 1.0}, {GOOD: 0.5, BAD: 4.0, ABSTAIN: 1.0}
            for p, (votes, n) in zip(posterior, patterns):
                on_good[votes[j]] += p * n
                on_bad[votes[j]] += (1 - p) * n
            good.append({v: x / sum(on_good.values()) for v, x in on_good.items()})
            bad.append({v: x / sum(on_bad.values()) for v, x in on_bad.items()})
        posterior = [
            1 / (1 + math.exp(min(700.0, -_log_odds(prior, good, bad, votes)))) for votes, _ in patterns
        ]
    return prior, good, bad


def _log_odds(prior: float, good: list, bad: list, votes: tuple[int, ...]) -> float:
    odds = math.log(prior / (1 - prior))
    return odds + sum(math.log(good[j][v] / bad[j][v]) for j, v in enumerate(votes))


def judged(docs: DataFrame, text_column: str = "text", carried: list[str] | None = None) -> DataFrame:
    """The documents (all columns, or the carried ones) with their counts, base_failed, probability (of good) and kept.

    base_failed: under 20 words, or over 30 % of them in repeated windows. kept: not base_failed, probability >= 0.5.
    Columns of the documents that are named like a result are replaced by it.
    """
    carried = docs.columns if carried is None else carried
    counted = save(measured(docs, text_column, carried))
    voted = counted.select(*[rule.alias(name) for name, rule in rules().items()])
    patterns = [(tuple(row[:-1]), row[-1]) for row in voted.groupBy(*RULES).count().orderBy(*RULES).collect()]
    prior, good, bad = estimate(patterns)
    odds = F.lit(math.log(prior / (1 - prior)))
    for j, rule in enumerate(rules().values()):
        weight = {v: math.log(good[j][v] / bad[j][v]) for v in (GOOD, BAD, ABSTAIN)}
        odds = odds + F.when(rule == GOOD, weight[GOOD]).when(rule == BAD, weight[BAD]).otherwise(weight[ABSTAIN])
    few, repeated = F.col("n_words") < 20, 100 * F.col("n_repeat_words") > 30 * F.col("n_words")
    results = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "probability", "kept"]
    own = [F.col(f"`__{c}`").alias(c) for c in carried if c not in results]
    scored = counted.withColumn("probability", F.round(1 / (1 + F.exp(-odds)), 6)).withColumn("base_failed", few | repeated)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("probability") >= 0.5)).select(*own, *results)


def keep_good(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The documents that are kept, with their own columns."""
    tagged = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_column).alias("text"))
    return judged(tagged, carried=["row"]).where("kept").select("row.*")
