"""Licence statements: known sentences become identifiers, and ordered rules match sequences of these.

A text is cut into sentences at line ends and at stops that are followed by white space. A sentence is
normalised: lower case, everything but letters and digits to one space. A table maps normalised sentences to
identifiers; sentences it lacks have none and end a sequence. Rules are tried in order on the sequence of
identifiers; what a rule has matched, later rules do not see.

All of it is column expressions within one row: no shuffle, and no group that could grow. Null and empty texts
have no sentences. Repeated rows give equal rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Normalised sentences of licence statements, and their identifiers.
SENTENCES = {
    "this work is licensed under the gnu general public license version 3": "GPL3-GRANT",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public"
    " license as published by the free software foundation either version 3 of the license or at your option any later"
    " version": "GPL3-LATER",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied"
    " warranty of merchantability or fitness for a particular purpose": "GPL-NOWARRANTY",
    "see the gnu general public license for more details": "GPL-SEE",
    "all rights reserved": "RESERVED",
    "licensed under cc by nc 4 0": "CCBYNC4",
    "licensed under cc by 4 0": "CCBY4",
    "licensed under cc by sa 4 0": "CCBYSA4",
    "released under the mit license": "MIT-REF",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
    " documentation files the software to deal in the software without restriction": "MIT-GRANT",
    "the software is provided as is without warranty of any kind": "AS-IS",
    "licensed under the apache license version 2 0": "APACHE2-REF",
    "licensed under the apache license version 2 0 the license": "APACHE2-GRANT",
    "you may not use this file except in compliance with the license": "APACHE-COMPLY",
    "you may obtain a copy of the license at": "APACHE-COPY",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the"
    " following conditions are met": "BSD-GRANT",
    "spdx license identifier mit": "SPDX-MIT",
    "spdx license identifier apache 2 0": "SPDX-APACHE2",
    "spdx license identifier gpl 3 0 only": "SPDX-GPL3",
}

# Licence, and the sequence of identifiers that states it; longer statements first.
RULES = [
    ("GPL-3.0-or-later", ["GPL3-LATER", "GPL-NOWARRANTY", "GPL-SEE"]),
    ("GPL-3.0-or-later", ["GPL3-LATER"]),
    ("Apache-2.0", ["APACHE2-GRANT", "APACHE-COMPLY", "APACHE-COPY"]),
    ("MIT", ["MIT-GRANT", "AS-IS"]),
    ("all-rights-reserved-then-GPL-3.0", ["RESERVED", "GPL3-GRANT"]),
    ("GPL-3.0", ["GPL3-GRANT"]),
    ("GPL-3.0", ["SPDX-GPL3"]),
    ("Apache-2.0", ["APACHE2-REF"]),
    ("Apache-2.0", ["APACHE2-GRANT"]),
    ("Apache-2.0", ["SPDX-APACHE2"]),
    ("MIT", ["MIT-REF"]),
    ("MIT", ["MIT-GRANT"]),
    ("MIT", ["SPDX-MIT"]),
    ("BSD", ["BSD-GRANT"]),
    ("CC-BY-NC-4.0", ["CCBYNC4"]),
    ("CC-BY-SA-4.0", ["CCBYSA4"]),
    ("CC-BY-4.0", ["CCBY4"]),
    ("all-rights-reserved", ["RESERVED"]),
]

# Where a sentence ends, and what a normalised sentence leaves out.
STOP = r"\n+|[.;:!?]\s+|[.;:!?]$"
NOISE = "[^a-z0-9]+"


def _known(text: Column) -> Column:
    """Identifiers of the text's sentences in order; an empty one for a sentence that is not known."""
    table = F.create_map(*(F.lit(v) for pair in SENTENCES.items() for v in pair))
    sentences = F.filter(F.split(F.coalesce(text, F.lit("")), STOP), lambda s: F.length(F.trim(s)) > 0)
    return F.transform(sentences, lambda s: F.coalesce(
        F.element_at(table, F.trim(F.regexp_replace(F.lower(s), NOISE, " "))), F.lit("")))


def scan(docs: DataFrame, rules: list[tuple[str, list[str]]] = RULES) -> DataFrame:
    """(doc_id, n_known, sentences, licences) for each row of docs; the last two comma-joined, the licences by name."""
    line = F.concat(F.lit("|"), F.array_join("__known", "|"), F.lit("|"))
    # every identifier has a mark of its own on both sides, so that sequences next to each other both match
    line = F.replace(line, F.lit("|"), F.lit("||"))
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _known(F.col("text")).alias("__known"))
    found = found.withColumn("__line", line)
    names = []
    for number, (licence, ids) in enumerate(rules):
        phrase = "".join(f"|{i}|" for i in ids)
        rest = F.replace("__line", F.lit(phrase), F.lit("|#|"))
        found = found.withColumn(f"__rule{number}", F.when(F.col("__line") != rest, F.lit(licence)))
        found = found.withColumn("__line", rest)
        names.append(f"__rule{number}")
    known = F.filter("__known", lambda i: i != "")
    return found.select(
        "doc_id", F.size(known).cast("long").alias("n_known"), F.array_join(known, ",").alias("sentences"),
        F.array_join(F.array_sort(F.array_distinct(F.filter(F.array(*names), lambda n: n.isNotNull()))), ",")
        .alias("licences"))


def oracle() -> str:
    """The same in DuckDB's SQL."""
    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    table = ", ".join(f"{quoted(k)}: {quoted(v)}" for k, v in SENTENCES.items())
    steps, line = [], "line0"
    for number, (licence, ids) in enumerate(RULES):
        phrase = quoted("".join(f"|{i}|" for i in ids))
        steps.append(f"s{number + 1} AS (SELECT *, replace({line}, {phrase}, '|#|') AS line{number + 1}, "
                     f"CASE WHEN contains({line}, {phrase}) THEN {quoted(licence)} END AS r{number} FROM s{number})")
        line = f"line{number + 1}"
    names = ", ".join(f"r{n}" for n in range(len(RULES)))
    return f"""
    WITH k AS (
      SELECT doc_id, list_transform(
        list_filter(regexp_split_to_array(coalesce(text, ''), '\\n+|[.;:!?]\\s+|[.;:!?]$'), lambda s: length(trim(s, ' ')) > 0),
        lambda s: coalesce((MAP {{{table}}})[trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'), ' ')], '')) AS known
      FROM documents),
    s0 AS (SELECT doc_id, list_filter(known, lambda i: i <> '') AS ids,
             replace('|' || coalesce(array_to_string(known, '|'), '') || '|', '|', '||') AS line0 FROM k),
    {", ".join(steps)}
    SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_known, coalesce(array_to_string(ids, ','), '') AS sentences,
           coalesce(array_to_string(list_sort(list_distinct(list_filter([{names}], lambda r: r IS NOT NULL))), ','), '') AS licences
    FROM s{len(RULES)}"""
