"""License scans by sentence rules.

A text is cut into sentences (at line ends, and after a stop followed by a blank); each sentence
is normalised (ASCII lower case, every run of other characters than letters and digits one blank)
and looked up among the known licence sentences. The identifiers of a text, with a gap where
sentences in between are unknown, are then matched against the rules in their order; a rule takes
the identifiers it matches, so a full notice is not reported again as its first sentence.

Null and empty texts match nothing. Each row is judged alone: repeated rows repeat their answer,
other columns are ignored, an empty table gives an empty result. The tables of sentences and rules
are parameters; the ones below are the defaults.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstar.llm.common import text_of

# Sentences of public licences and notices, normalised, and their identifiers.
SENTENCES = {
    "licensed under the apache license version 2 0": "apache2",
    "licensed under the apache license version 2 0 the license": "apache2",
    "you may not use this file except in compliance with the license": "apache2-comply",
    "you may obtain a copy of the license at": "apache2-copy",
    "http www apache org licenses license 2 0": "apache2-url",
    "released under the mit license": "mit",
    "licensed under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice",
    "this work is licensed under the gnu general public license version 3": "gpl3",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3-later",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "gpl-warranty",
    "see the gnu general public license for more details": "gpl-details",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under cc by 4 0": "cc-by",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "all rights reserved": "reserved",
}

#: Ordered rules: a licence and the identifiers that must follow each other.
RULES = (
    ("Apache-2.0", ("apache2", "apache2-comply", "apache2-copy", "apache2-url")),
    ("Apache-2.0", ("apache2",)),
    ("MIT", ("mit-grant", "mit-notice")),
    ("MIT", ("mit-grant",)),
    ("MIT", ("mit",)),
    ("GPL-3.0-or-later", ("gpl3-later", "gpl-warranty", "gpl-details")),
    ("GPL-3.0-or-later", ("gpl3-later",)),
    ("GPL-3.0", ("gpl3",)),
    ("CC-BY-NC-4.0", ("cc-by-nc",)),
    ("CC-BY-SA-4.0", ("cc-by-sa",)),
    ("CC-BY-4.0", ("cc-by",)),
    ("BSD", ("reserved", "bsd-grant")),
    ("BSD", ("bsd-grant",)),
    ("All-rights-reserved", ("reserved",)),
)

STOP, OTHER = r"([.!?;])[ \t]+", "[^0-9a-z]+"


def _sequence(ids: tuple[str, ...]) -> str:
    return "".join(f"<{i}>" for i in ids)


def sentence_ids(text: Column, sentences: dict[str, str]) -> Column:
    """The identifiers of a text as '<a><b>~<c>'; ~ stands for sentences that are not known."""
    known = F.create_map(*[F.lit(x) for pair in sentences.items() for x in pair])
    lower = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    parts = F.split(F.regexp_replace(lower, STOP, "$1\n"), "\n")
    plain = F.filter(F.transform(parts, lambda s: F.trim(F.regexp_replace(s, OTHER, " "))), lambda s: s != "")
    named = F.transform(plain, lambda s: F.coalesce(F.concat(F.lit("<"), F.try_element_at(known, s), F.lit(">")), F.lit("~")))
    return F.array_join(named, "")


def scan(docs: DataFrame, sentences: dict[str, str] = SENTENCES, rules: tuple = RULES, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, n_known, n_unmatched (known sentences no rule took), licenses (in rule order, comma-joined)."""
    out = docs.select(F.col(id_column).alias("doc_id"), sentence_ids(text_of(text_column), sentences).alias("_ids"))
    out = out.withColumn("n_known", F.regexp_count("_ids", F.lit("<")).cast("long"))
    found: dict[str, Column] = {}
    # A taken sequence leaves a gap behind, so that what stands on its two sides does not join.
    for k, (name, ids) in enumerate(rules):
        before = F.col(f"_ids{k - 1}" if k else "_ids")
        out = out.withColumn(f"_ids{k}", F.replace(before, F.lit(_sequence(ids)), F.lit("~")))
        hit = before != F.col(f"_ids{k}")
        found[name] = found[name] | hit if name in found else hit
    names = F.array_compact(F.array(*[F.when(hit, F.lit(name)) for name, hit in found.items()]))
    return out.select("doc_id", "n_known", F.regexp_count(f"_ids{len(rules) - 1}", F.lit("<")).cast("long").alias("n_unmatched"), F.array_join(names, ",").alias("licenses"))


def scan_sql(sentences: dict[str, str] = SENTENCES, rules: tuple = RULES) -> str:
    """The same scan of ``documents`` in SQL."""
    known = ", ".join(f"'{s}': '<{i}>'" for s, i in sentences.items())
    steps = "ids AS ids_0"
    levels = f"SELECT doc_id, ids, {steps} FROM i"
    hits: dict[str, list[str]] = {}
    for k, (name, ids) in enumerate(rules):
        levels = f"SELECT *, replace(ids_{k}, '{_sequence(ids)}', '~') AS ids_{k + 1} FROM ({levels})"
        hits.setdefault(name, []).append(f"ids_{k} <> ids_{k + 1}")
    names = ", ".join(f"CASE WHEN {' OR '.join(h)} THEN '{name}' END" for name, h in hits.items())
    return f"""
        WITH s AS (SELECT doc_id, string_split(regexp_replace(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{STOP}', '\\1' || chr(10), 'g'), chr(10)) AS parts FROM documents),
        p AS (SELECT doc_id, list_filter(list_transform(parts, lambda x: trim(regexp_replace(x, '{OTHER}', ' ', 'g'))), lambda x: x <> '') AS plain FROM s),
        i AS (SELECT doc_id, coalesce(array_to_string(list_transform(plain, lambda x: coalesce(MAP {{{known}}}[x], '~')), ''), '') AS ids FROM p)
        SELECT doc_id, CAST(length(ids) - length(replace(ids, '<', '')) AS BIGINT) AS n_known,
               CAST(length(ids_{len(rules)}) - length(replace(ids_{len(rules)}, '<', '')) AS BIGINT) AS n_unmatched,
               concat_ws(',', {names}) AS licenses
        FROM ({levels})"""
