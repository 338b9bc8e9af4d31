"""License scans by sentence rules, in built-in functions only.

A text is cut into sentences, each normalised to its lower-case letters and digits with single spaces. A known sentence
has an identifier; a license rule is an ordered sequence of identifiers. A rule matches where its sentences stand one
after the other; sentences that are not known may lie between them, other known ones may not. Of rules that begin at the
same sentence the longest counts.

A sentence may be wrapped over lines, whose comment marks normalisation drops, and it may follow a heading without a
stop. A stretch of text without a stop or an empty line is therefore read twice: its end, from the first line at which a
known sentence begins that fills the rest of it, as one sentence, and each line before that as a sentence of its own.

Rules and sentences are a small table given by the caller; it is turned into expressions, and a list of more than
MAX_SENTENCES sentences is refused rather than made into a plan of unbounded size. Matching is one scan without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstat.llm.native_text import NOT_ALNUM, lower_ascii

MAX_SENTENCES = 5_000

#: License names and the texts that state them; a license may be stated in several ways.
LICENSE_TEXTS: dict[str, list[str]] = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License.",
        "Apache License\n\nVersion 2.0, January 2004",
    ],
    "BSD-2-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:\n\nRedistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer.\n\nRedistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution.",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:\n\nRedistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer.\n\nRedistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution.\n\nNeither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC0-1.0": [
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to "
        "this software to the public domain worldwide.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later "
        "version.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "LGPL-2.1": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) "
        "any later version.",
    ],
    "LGPL-3.0": [
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "proprietary": ["All rights reserved."],
}

#: Where a sentence ends, in a text whose A-Z are lower-case: at a stop before white space, at a colon that ends its line
#: before a list, and at a line without letters and digits.
_WORDLESS = "[\\x00-\\x09\\x0B-\\x2F\\x3A-\\x60\\x7B-\\x7F]*"
ENDS = f"(?<=[.!?])[\\x20\\x09-\\x0D]+|(?<=:)[\\x20\\x09\\x0D]*\\n(?={_WORDLESS}[0-9a-z]{{1,2}}[.)][\\x20\\x09])|\\n{_WORDLESS}\\n"


def _lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def normal(sentence: str) -> str:
    """What `_normal` makes of a sentence: lower-case words of a-z, 0-9 and non-ASCII characters."""
    return " ".join(re.findall("[0-9a-z\u0080-\U0010ffff]+", _lower(sentence)))


def sentences_of(text: str) -> list[str]:
    """The normalised sentences of a license text."""
    return [s for s in map(normal, re.split(ENDS, _lower(text))) if s]


def _sequences(rules: dict[str, list[str]]) -> list[tuple[str, list[str]]]:
    """(license, its sentences) for each text, and for each license's tag."""
    stated = [(name, sentences_of(text)) for name, texts in rules.items() for text in texts]
    tagged = [(name, [normal(f"SPDX-License-Identifier: {tag}")]) for name in rules for tag in (name, f"{name}-only", f"{name}-or-later")]
    return [(name, sentences) for name, sentences in stated + tagged if sentences]


def identifiers(rules: dict[str, list[str]]) -> dict[str, int]:
    """Normalised sentence -> identifier, from 1 in order of appearance."""
    found: dict[str, int] = {}
    for _, sentences in _sequences(rules):
        for sentence in sentences:
            found.setdefault(sentence, len(found) + 1)
    if len(found) > MAX_SENTENCES:
        raise ValueError(f"more than {MAX_SENTENCES} license sentences")
    return found


def _probes(sentences: Iterable[str]) -> list[str]:
    """Runs of up to three words, few in number, of which every one of the sentences has one: the commonest first."""
    left = {s: {" ".join(s.split()[i : i + 3]) for i in range(max(len(s.split()) - 2, 1))} for s in sentences}
    found: list[str] = []
    while left:
        counts = Counter(words for runs in left.values() for words in runs)
        found.append(min(counts, key=lambda words: (-counts[words], -len(words), words)))
        left = {s: runs for s, runs in left.items() if found[-1] not in runs}
    return found


def _normal(text: Column) -> Column:
    return F.btrim(F.regexp_replace(text, NOT_ALNUM, " "))


def _identified(text: Column, table: Column, longest: int) -> Column:
    """The identifiers of the known sentences of a text, in its order. No known sentence has more than `longest` words, and
    so none fills more than as many lines with words."""

    def of(sentence: Column) -> Column:
        return F.try_element_at(table, sentence).cast("bigint")

    def stretch(lines: Column) -> Column:
        n = F.size(lines)
        first = F.greatest(n - longest + 1, F.lit(1))
        ends = F.transform(
            F.sequence(first, n), lambda i: F.struct(i.alias("at"), of(F.array_join(F.slice(lines, i, n), " ")).alias("id"))
        )
        end = F.get(F.filter(ends, lambda e: e["id"].isNotNull()), F.lit(0))
        before = F.slice(lines, F.lit(1), F.coalesce(end["at"] - 1, n))
        return F.array_compact(F.concat(F.transform(before, of), F.array(end["id"])))

    stretches = F.transform(
        F.split(lower_ascii(text), ENDS),
        lambda s: F.filter(F.transform(F.split(s, "\\n"), _normal), lambda line: line != ""),
    )
    return F.flatten(F.transform(F.filter(stretches, lambda lines: F.size(lines) > 0), stretch))


def recognised(docs: DataFrame, rules: dict[str, list[str]] | None = None, text_column: str = "text") -> DataFrame:
    """The documents with sentence_ids (array of long, in order of text) and licenses (array of names, sorted).

    Rules: the texts that state a license, by its name; the license's SPDX tag is a text of each. Null or empty texts have
    empty arrays, repeated rows each have their row, texts count whole, however long. Of two rules that begin at the same
    sentence the longer counts. Columns of the two names are replaced; those of any other name stay as they are.
    """
    rules = LICENSE_TEXTS if rules is None else rules
    known = identifiers(rules)
    own = [c for c in docs.columns if c not in ("sentence_ids", "licenses")]
    row = F.struct(*[F.col(f"`{c}`") for c in own]).alias("row")
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    flat = F.concat(F.lit(" "), F.regexp_replace(lower_ascii(text), NOT_ALNUM, " "), F.lit(" "))
    found = docs.select(row, text.alias("text"), flat.alias("flat"))
    ids = F.array().cast("array<bigint>")
    if known:
        table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
        likely = F.lit(False)
        for words in _probes(known):  # cheap test: most texts hold no known sentence, whatever stands between its words
            likely = likely | F.contains(F.col("flat"), F.lit(f" {words} "))
        longest = max(len(sentence.split()) for sentence in known)
        ids = F.when(likely, _identified(F.col("text"), table, longest)).otherwise(ids)
    # Identifiers are written as ',1,,2,' so that a rule's sequence is looked for as a text.
    chain = F.concat(F.lit(","), F.array_join(F.col("ids").cast("array<string>"), ",,"), F.lit(","))
    none = F.array().cast("array<string>").alias("names")
    chained = found.select("row", ids.alias("ids")).select("row", "ids", chain.alias("chain"), none)
    # A longer rule that holds another one's sequence takes its place in the text: it is cut out before shorter ones look.
    ordered = [(name, "".join(f",{known[s]}," for s in sentences), len(sentences)) for name, sentences in _sequences(rules)]
    matches = []
    for name, sequence, _ in sorted(ordered, key=lambda rule: (-rule[2], rule[0])):
        holds = any(other != sequence and other in sequence for _, other, _ in ordered)
        matches.append(F.when(F.contains("chain", F.lit(sequence)), F.lit(name)))
        if holds:
            cut = F.replace("chain", F.lit(sequence), F.lit(";")).alias("chain")
            chained = chained.select("row", "ids", cut, F.concat("names", *[F.array(m) for m in matches]).alias("names"))
            matches = []
    names = F.array_sort(F.array_distinct(F.array_compact(F.concat("names", *[F.array(m) for m in matches]))))
    return chained.select("row.*", F.col("ids").alias("sentence_ids"), names.alias("licenses"))
