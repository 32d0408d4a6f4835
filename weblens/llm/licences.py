"""Recognise licences by their sentences and the order these stand in.

A text is normalised (A-Z in lower case, everything but letters a-z and digits as one space)
and may be cut at line ends and after closing signs. Known licence sentences are looked for
between any two such places, so that one may be a line or be wrapped over lines, with comment
signs before each, and may hold `;` and `:`. None goes on over the end of a sentence (`.!?`) or
a line without letters and digits. Where two begin the longer one counts, and what it covers
is not looked at again. Each gives a sentence identifier; other text gives none. The
identifiers of a text, in order, are matched against rules: a rule is a licence and the
identifiers that must follow each other without another known sentence between them.
Where identifiers are part of a place that a longer rule matches, a shorter rule that they make
up gives no licence of its own; elsewhere in the text it does.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weblens.llm.common import lower_ascii

# Applied in this order to text without A-Z. `H` ends every sentence; at `S` and `L` (a line's
# end) one may end or go on.
MARKS = (
    (r"[.!?][;:]*(?=[ \t\f\r\n])", "H"),
    (r"[;:](?=[ \t\f\r\n])", "S"),
    (r"\r\n|[\r\n]", "L"),
    (r"[^a-z0-9HSL]+", " "),
    (r" ?([HSL]) ?", "$1"),
    (r"LS*L", "H"),
)

# Sentences of public licences and notices, normalised.
SENTENCES = {
    "APACHE2": "licensed under the apache license version 2 0",
    "APACHE2-THE": "licensed under the apache license version 2 0 the license",
    "APACHE2-USE": "you may not use this file except in compliance with the license",
    "APACHE2-COPY": "you may obtain a copy of the license at",
    "MIT": "released under the mit license",
    "MIT-LICENSED": "licensed under the mit license",
    "MIT-GRANT": (
        "permission is hereby granted free of charge to any person obtaining a copy of this"
        " software and associated documentation files the software to deal in the software"
        " without restriction including without limitation the rights to use copy modify merge"
        " publish distribute sublicense and or sell copies of the software and to permit persons"
        " to whom the software is furnished to do so subject to the following conditions"
    ),
    "MIT-NOTICE": (
        "the above copyright notice and this permission notice shall be included in all copies"
        " or substantial portions of the software"
    ),
    "GPL3": "this work is licensed under the gnu general public license version 3",
    "GPL-FREE": (
        "this program is free software you can redistribute it and or modify it under the terms"
        " of the gnu general public license as published by the free software foundation either"
        " version 3 of the license or at your option any later version"
    ),
    "GPL-WARRANTY": (
        "this program is distributed in the hope that it will be useful but without any warranty"
        " without even the implied warranty of merchantability or fitness for a particular purpose"
    ),
    "BSD-REDISTRIBUTE": (
        "redistribution and use in source and binary forms with or without modification are"
        " permitted provided that the following conditions are met"
    ),
    "BSD-ENDORSE": (
        "neither the name of the copyright holder nor the names of its contributors may be used"
        " to endorse or promote products derived from this software without specific prior"
        " written permission"
    ),
    "CC-BY-NC4": "licensed under cc by nc 4 0",
    "CC-BY4": "licensed under cc by 4 0",
    "CC-BY-SA4": "licensed under cc by sa 4 0",
    "CC0": "this work is dedicated to the public domain under cc0 1 0",
    "RESERVED": "all rights reserved",
}

# Identifiers in their order, and what they say.
RULES = {
    "APACHE2": "Apache-2.0",
    "APACHE2-THE": "Apache-2.0",
    "APACHE2-THE APACHE2-USE APACHE2-COPY": "Apache-2.0",
    "MIT": "MIT",
    "MIT-LICENSED": "MIT",
    "MIT-GRANT MIT-NOTICE": "MIT",
    "GPL3": "GPL-3.0-only",
    "GPL-FREE": "GPL-3.0-or-later",
    "GPL-FREE GPL-WARRANTY": "GPL-3.0-or-later",
    "BSD-REDISTRIBUTE": "BSD-2-Clause",
    "BSD-REDISTRIBUTE BSD-ENDORSE": "BSD-3-Clause",
    "CC-BY-NC4": "CC-BY-NC-4.0",
    "CC-BY4": "CC-BY-4.0",
    "CC-BY-SA4": "CC-BY-SA-4.0",
    "CC0": "CC0-1.0",
    "RESERVED": "proprietary",
}


def marked(text: Column) -> Column:
    """Normalised text with marks where a sentence ends or may end."""
    for pattern, mark in MARKS:
        text = F.regexp_replace(text, pattern, mark)
    return F.concat(F.lit("H"), F.btrim(text), F.lit("H"))


def known_sentences(text: Column, sentences: dict[str, str]) -> Column:
    """The identifiers of the known sentences in marked text, in order."""
    names: dict[str, list[str]] = {}
    for name, sentence in sorted(sentences.items()):
        names.setdefault(" ".join(re.findall("[a-z0-9]+", sentence)), []).append(name)
    longest = sorted((k for k in names if k), key=len, reverse=True)
    any_of = "|".join(k.replace(" ", "[ SL]+") for k in longest)
    parts = F.regexp_extract_all(text, F.lit(f"(?<=[HSL])(?:{any_of})(?=[HSL])"), F.lit(0))
    pairs = [(F.lit(k), F.array(*map(F.lit, names[k]))) for k in longest]
    lookup = F.create_map(*[x for pair in pairs for x in pair])
    return F.flatten(F.transform(parts, lambda p: lookup[F.regexp_replace(p, "[SL]+", " ")]))


def _spelt(sequence: str) -> str:
    """Identifiers with a space before and after each."""
    return "".join(f" {name} " for name in sequence.split(" "))


def _outside_longer(sequence: str, rules: dict[str, str]) -> str:
    """A pattern for places of a rule that are no part of a place of a longer rule."""
    own, unless = _spelt(sequence), ""
    for longer in rules:
        whole = _spelt(longer)
        at = whole.find(own) if longer != sequence else -1
        while at >= 0:
            unless += f"(?!(?<={re.escape(whole[:at])}){re.escape(whole[at:])})"
            at = whole.find(own, at + 1)
    return unless + re.escape(own)


def matched_licences(names: Column, rules: dict[str, str]) -> Column:
    """The licences, sorted, of the rules that a text's identifiers fit."""
    spelt = F.array_join(F.transform(names, lambda n: F.concat(F.lit(" "), n, F.lit(" "))), "")
    found = [
        F.when(F.regexp_like(spelt, F.lit(_outside_longer(sequence, rules))), F.lit(licence))
        for sequence, licence in rules.items()
    ]
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*found))))


def scan_licences(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    sentences: dict[str, str] | None = None,
    rules: dict[str, str] | None = None,
) -> DataFrame:
    """`(doc_id, sentences, licences)` for every row of `docs`.

    `sentences` holds the identifiers of all known sentences in order, `licences` the sorted
    licences of the rules that fit. Both are empty for texts without known sentences, and for
    null and empty texts. Repeated rows each give a row; a null id stays null. `sentences` and
    `rules` replace the tables above; they are small by nature and part of the expressions.
    """
    content = lower_ascii(F.coalesce(F.col(text), F.lit("")))
    names = known_sentences(marked(content), sentences or SENTENCES).alias("sentences")
    # A generator, so that no filter is pushed down with copies of the search in it.
    found = docs.select(F.col(doc_id).alias("doc_id"), F.inline(F.array(F.struct(names))))
    return found.withColumn("licences", matched_licences(F.col("sentences"), rules or RULES))
