"""Recognise licences by rules over known sentences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableferry.llm.common import named, row_key

# Sentences of public licences, in lower case without marks, and the
# order in which they make up a licence.
SENTENCES = {
    "apache-2.0-reference": "licensed under the apache license version 2 0",
    "apache-2.0-header": "licensed under the apache license version 2 0 the license",
    "apache-2.0-comply": "you may not use this file except in compliance with the license",
    "apache-2.0-copy": "you may obtain a copy of the license at",
    "mit-reference": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-grant": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software "
        "and associated documentation files the software to deal in the software without restriction "
        "including without limitation the rights to use copy modify merge publish distribute sublicense "
        "and or sell copies of the software and to permit persons to whom the software is furnished to "
        "do so subject to the following conditions"
    ),
    "mit-notice": (
        "the above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the software"
    ),
    "mit-as-is": (
        "the software is provided as is without warranty of any kind express or implied including but "
        "not limited to the warranties of merchantability fitness for a particular purpose and "
        "noninfringement"
    ),
    "gpl-3.0-reference": "this work is licensed under the gnu general public license version 3",
    "gpl-redistribute": (
        "this program is free software you can redistribute it and or modify it under the terms of the "
        "gnu general public license as published by the free software foundation either version 3 of "
        "the license or at your option any later version"
    ),
    "gpl-free": "this program is free software",
    "gpl-3.0-terms": (
        "you can redistribute it and or modify it under the terms of the gnu general public license as "
        "published by the free software foundation either version 3 of the license or at your option "
        "any later version"
    ),
    "cc-by-nc-4.0-reference": "licensed under cc by nc 4 0",
    "cc-by-nc-4.0-work": (
        "this work is licensed under a creative commons attribution noncommercial 4 0 international license"
    ),
    "bsd-redistribution": (
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met"
    ),
    "bsd-source": (
        "redistributions of source code must retain the above copyright notice this list of conditions "
        "and the following disclaimer"
    ),
    "bsd-binary": (
        "redistributions in binary form must reproduce the above copyright notice this list of "
        "conditions and the following disclaimer in the documentation and or other materials provided "
        "with the distribution"
    ),
}
RULES = [
    ("Apache-2.0", ["apache-2.0-reference"]),
    ("Apache-2.0", ["apache-2.0-header", "apache-2.0-comply"]),
    ("Apache-2.0", ["apache-2.0-header", "apache-2.0-comply", "apache-2.0-copy"]),
    ("MIT", ["mit-reference"]),
    ("MIT", ["mit-licensed"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-as-is"]),
    ("GPL-3.0", ["gpl-3.0-reference"]),
    ("GPL-3.0-or-later", ["gpl-redistribute"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-3.0-terms"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4.0-reference"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4.0-work"]),
    ("BSD", ["bsd-redistribution", "bsd-source", "bsd-binary"]),
]

# A sentence ends with one of these before white space or the end of the text.
SENTENCE_END = r"[.;:!?]+(?:[ \t\n\r\f]+|\z)"
MARKS = r"[^\p{L}\p{N}]+"


def normal_sentence(text: Column) -> Column:
    """Lower case, with each run of marks and white space as one space, none at the ends."""
    return F.btrim(F.regexp_replace(F.lower(text), MARKS, " "))


def _wrapped(filled: Column, whole: Column, texts: list[str]) -> Column:
    """Runs of two and more filled lines that may be one of ``texts``, but for all lines.

    From each line the run grows for as long as some text begins with it, so no
    run has more lines than a text has words.
    """
    known = F.array(*map(F.lit, texts))
    reach = max(len(text.split()) for text in texts)

    def begins(run: Column) -> Column:
        return F.exists(known, lambda text: F.startswith(text, run))

    def grow(run: Column, line: Column) -> Column:
        longer = F.concat(run["text"], F.lit(" "), line["normal"])
        longer = F.when(begins(longer), longer)  # missing once no text begins with it
        found = F.when(F.array_contains(known, longer), F.array(longer)).otherwise(none)
        return F.struct(longer.alias("text"), F.concat(run["found"], found).alias("found"))

    def runs(first: Column) -> Column:
        start = F.struct(first["normal"].alias("text"), none.alias("found"))
        after = F.slice(filled, first["at"] + 2, F.lit(max(reach - 1, 0)))
        grown = F.aggregate(after, start, grow, lambda run: run["found"])
        grown = F.filter(grown, lambda text: text != whole)
        return F.transform(grown, lambda text: F.struct(first["line"].alias("line"), text.alias("normal")))

    none = F.array().cast("array<string>")
    numbered = F.transform(filled, lambda x, i: F.struct(x["line"], x["normal"], i.alias("at")))
    return F.flatten(F.transform(F.filter(numbered, lambda x: begins(x["normal"])), runs))


def known_sentences(
    docs: DataFrame, sentences: dict[str, str], doc_id: str, text: str
) -> DataFrame:
    """``key``, ``sentence``, ``line``, ``rest`` and ``known``: where known sentences stand.

    A sentence over several lines counts as a whole (line 0), and so does each run
    of its lines, by the number of the first, as there a heading or a line without
    an end mark may stand before or after it. By ``rest`` the longest run from a
    line comes first.
    """
    texts = list(sentences.values())
    shortest = min(map(len, texts))
    rows = [F.struct(F.lit(v).alias("normal"), F.lit(k).alias("known")) for k, v in sentences.items()]
    table = docs.sparkSession.range(1).select(F.inline(F.array(*rows)))
    split = docs.select(
        row_key(named(docs, doc_id), named(docs, text)).alias("key"),
        F.posexplode(F.split(named(docs, text), SENTENCE_END, -1)).alias("sentence", "whole"),
    ).where(F.char_length("whole") >= shortest)
    lines = F.transform(
        F.split("whole", "\n", -1),
        lambda x, i: F.struct((i + 1).alias("line"), normal_sentence(x).alias("normal")),
    )
    lined = split.select(
        "key",
        "sentence",
        F.contains("whole", F.lit("\n")).alias("several"),
        F.filter(lines, lambda x: x["normal"] != "").alias("filled"),
    )
    joined = lined.withColumn("normal", F.array_join("filled.normal", " "))
    whole = F.array(F.struct(F.lit(0).alias("line"), "normal"))
    runs = _wrapped(F.col("filled"), F.col("normal"), texts)
    parts = F.when(F.col("several"), F.concat(whole, "filled", runs)).otherwise(whole)
    return (
        joined.select("key", "sentence", F.inline(parts))
        .where(F.char_length("normal") >= shortest)
        .join(F.broadcast(table), "normal")  # as many rows as there are sentences in the code
        .select("key", "sentence", "line", F.negative(F.char_length("normal")).alias("rest"), "known")
        .distinct()
    )


def scan_licenses(
    docs: DataFrame,
    sentences: dict[str, str] | None = None,
    rules: list[tuple[str, list[str]]] | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document and place where a licence stands in it.

    ``sentence`` is the number, from 0, of the sentence with which the rule
    begins, and ``n_sentences`` how many the rule has. A rule matches where its
    sentences follow each other among the known sentences of the document, in its
    order; text between them that is no known sentence does not matter. Of
    matches that begin at the same place the longest counts.

    Sentences end with a mark out of .;:!? before white space, and are compared in
    lower case without marks; a known sentence may also be some of the lines of
    one, such as those below a title without a mark. A missing or empty text has no sentences. Repeated
    rows each get their matches, and a missing doc_id stays missing. An empty
    table gives no rows. No other column is read.
    """
    sentences, rules = sentences or SENTENCES, rules or RULES
    found = known_sentences(docs, sentences, doc_id, text)
    sequence = found.groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("sentence", "line", "rest", "known"))).alias("found")
    )
    rows = [
        F.struct(
            F.lit(license_id).alias("license"),
            F.array(*map(F.lit, ids)).alias("ids"),
            F.lit(ids[0]).alias("first"),
        )
        for license_id, ids in rules
    ]
    ruled = docs.sparkSession.range(1).select(F.inline(F.array(*rows)))
    begun = sequence.select("key", "found", F.posexplode("found").alias("at", "one")).select(
        "key",
        "at",
        F.col("one.sentence").cast("long").alias("sentence"),
        F.col("one.known").alias("first"),
        F.transform("found", lambda x: x["known"]).alias("known"),
    )
    matched = begun.join(F.broadcast(ruled), "first").where(
        F.slice("known", F.col("at") + 1, F.size("ids")) == F.col("ids")
    )
    best = matched.groupBy("key", "at", "sentence").agg(
        F.max(F.struct(F.size("ids").cast("long").alias("n_sentences"), "license")).alias("match")
    )
    ids = docs.select(
        named(docs, doc_id).alias("doc_id"),
        row_key(named(docs, doc_id), named(docs, text)).alias("key"),
    )
    return ids.join(best, "key").select(
        "doc_id", "match.license", "sentence", "match.n_sentences"
    )
