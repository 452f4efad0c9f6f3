"""License scans by sentence rules.

Texts are split into sentences at punctuation, blank lines and list marks; those with a licence
word are normalised (lower case, runs of other characters than letters and digits as one space)
and mapped to identifiers of known licence sentences.  A known sentence may run over single
line breaks and counts for the line it begins in, once a line; all known sentences of a line
count, in the order of the text, of those that begin at one word the first of the list.  The sequence of a document's identifiers is matched against the licence
rules in order; what a rule matches is taken out, so a later rule can't count it again.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

AZ, az = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
UNKNOWN = "unknown"

# Licence words, boundaries of the SQL (which reads line by line), ends of sentences, known sentences and rules, the first match counting.
LICENSE_WORD = r"(?i)licen[cs]|copyright|rights reserved|redistribut|warrant|permission|endorse|public domain|gpl|creative commons|cc by|cc-by|cc0|spdx"
BOUNDARY = r"[.!?;]+[ \t\r\n]+|[\r\n]+"
ENDS = (
    r"(?:(?<!\bv)\.|[!?]|;(?![\s#*/%|>]*either\b))+[ \t\r\n]+",  # not in 'v. 2.0' and 'Foundation; either version 2'
    r":[ \t\r]*\n",
    r"\n[ \t\r#*/;%|>=_~+.-]*\n|\r[ \t]*\r",  # blank lines, of comments too
    r"[\r\n]+[ \t#*/;%|>]*(?:[0-9]{1,2}[.)]|\((?:[0-9]{1,2}|[abd-z]|[ivx]{2,4})\)|[•◦‣·–-])[ \t]+",
)
#: the licence words over line breaks; and with the words of known sentences that have none of them
WORD = LICENSE_WORD.replace(" ", r"[ \t\r\n#*/;%|>]+")
KNOWN_WORD = WORD + r"|as[^a-zA-Z0-9]+is|\(c\)|apache[^a-zA-Z0-9]+2[^a-zA-Z0-9]+0|bsd[^a-zA-Z0-9]+[23][^a-zA-Z0-9]+clause"
#: a notice that counts only where its line has no other sentence
NOTICE = "copyright"
SENTENCES = (
    ("mitPermission", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mitNotice", r"above copyright notice and this permission notice shall be included"),
    ("iscPermission", r"permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("bsdUse", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsdSource", r"redistributions of source code must retain the above copyright notice"),
    ("bsdBinary", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsdEndorse", r"neither the name of .* may be used to endorse"),
    ("asIs", r"provided (by .* )?as is"),
    ("gplLater", r"either version [0-9]( [0-9])? of the license or at your option any later version"),
    ("agpl3", r"gnu affero general public license( as published by the free software foundation)? (either )?version 3"),
    ("lgpl3", r"gnu lesser general public license( as published by the free software foundation)? (either )?version 3"),
    ("lgpl21", r"gnu lesser general public license( as published by the free software foundation)? (either )?version 2 1"),
    ("gpl3", r"gnu general public license( as published by the free software foundation)? (either )?version 3"),
    ("gpl2", r"gnu general public license( as published by the free software foundation)? (either )?version 2"),
    ("gplAny", r"gnu (affero |lesser )?general public license"),
    ("apache2", r"licensed under the apache license version 2 0"),
    ("apacheComply", r"you may not use this (file|work) except in compliance with the license"),
    ("mpl2", r"mozilla public license v(ersion)? ?2 0"),
    ("epl2", r"eclipse public license v(ersion)? ?2 0"),
    ("mitReference", r"(released|licensed|distributed|available) under the (terms of the )?mit license"),
    ("bsdReference", r"(released|licensed|distributed|available) under the (terms of the )?bsd license"),
    ("apacheReference", r"apache 2 0"),
    ("mitName", r"spdx license identifier mit|2 0 or mit"),
    ("iscName", r"spdx license identifier isc"),
    ("bsd3Name", r"bsd 3 clause"),
    ("bsd2Name", r"bsd 2 clause"),
    ("agpl3Name", r"spdx license identifier agpl 3 0"),
    ("lgpl3Name", r"spdx license identifier lgpl 3 0"),
    ("lgpl21Name", r"spdx license identifier lgpl 2 1"),
    ("gpl3Name", r"spdx license identifier gpl 3 0"),
    ("gpl2Name", r"spdx license identifier gpl 2 0"),
    ("mpl2Name", r"spdx license identifier mpl 2 0"),
    ("epl2Name", r"spdx license identifier epl 2 0"),
    ("ccByNcSa4", r"(cc by nc sa|creative commons attribution noncommercial sharealike) 4 0"),
    ("ccByNcNd4", r"(cc by nc nd|creative commons attribution noncommercial noderivatives) 4 0"),
    ("ccByNc4", r"(cc by nc|creative commons attribution noncommercial) 4 0"),
    ("ccBySa4", r"(cc by sa|creative commons attribution sharealike) 4 0"),
    ("ccByNd4", r"(cc by nd|creative commons attribution noderivatives) 4 0"),
    ("ccBy4", r"(cc by|creative commons attribution) 4 0"),
    ("cc0", r"cc0 1 0|dedicate[ds]? .* to the public domain"),
    ("allRights", r"all rights reserved"),
    ("copyright", r"^(copyright|c) .*[0-9]{4}"),
)
RULES = (
    ("MIT", "<mitPermission>(<mitNotice>)?(<asIs>)?"),
    ("ISC", "<iscPermission>(<asIs>)?"),
    ("BSD-3-Clause", "<bsdUse><bsdSource><bsdBinary><bsdEndorse>(<asIs>)?"),
    ("BSD-2-Clause", "<bsdUse><bsdSource><bsdBinary>(<asIs>)?"),
    ("Apache-2.0", "<apache2>(<apacheComply>)?"),
    ("AGPL-3.0", "<agpl3>(<gplLater>)?"),
    ("LGPL-3.0", "<lgpl3>(<gplLater>)?"),
    ("LGPL-2.1", "<lgpl21>(<gplLater>)?"),
    ("GPL-3.0", "<gpl3>(<gplLater>)?"),
    ("GPL-2.0", "<gpl2>(<gplLater>)?"),
    ("GPL", "<gplAny>(<gplLater>)?"),
    ("MPL-2.0", "<mpl2>"),
    ("EPL-2.0", "<epl2>"),
    ("MIT", "<mitReference>"),
    ("BSD", "<bsdReference>"),
    ("Apache-2.0", "<apacheReference>"),
    ("MIT", "<mitName>"),
    ("ISC", "<iscName>"),
    ("BSD-3-Clause", "<bsd3Name>"),
    ("BSD-2-Clause", "<bsd2Name>"),
    ("AGPL-3.0", "<agpl3Name>"),
    ("LGPL-3.0", "<lgpl3Name>"),
    ("LGPL-2.1", "<lgpl21Name>"),
    ("GPL-3.0", "<gpl3Name>"),
    ("GPL-2.0", "<gpl2Name>"),
    ("MPL-2.0", "<mpl2Name>"),
    ("EPL-2.0", "<epl2Name>"),
    ("CC-BY-NC-SA-4.0", "<ccByNcSa4>"),
    ("CC-BY-NC-ND-4.0", "<ccByNcNd4>"),
    ("CC-BY-NC-4.0", "<ccByNc4>"),
    ("CC-BY-SA-4.0", "<ccBySa4>"),
    ("CC-BY-ND-4.0", "<ccByNd4>"),
    ("CC-BY-4.0", "<ccBy4>"),
    ("CC0-1.0", "<cc0>"),
    ("proprietary", "(<copyright>)?<allRights>"),
)


def sentence_ids(text: Column, sentences=SENTENCES) -> Column:
    """Identifiers of the text's licence sentences, in order; ``unknown`` for those with a licence
    word that no known sentence fits."""

    def identify(sentence: Column) -> Column:
        plain = F.regexp_replace(F.translate(sentence, AZ, az), "\r\n?", "\n")
        plain = F.trim(F.regexp_replace(F.regexp_replace(plain, "[^a-z0-9\n]+", " "), " ?\n[ \n]*", "\n"))
        for name, pattern in sentences:  # a mark where each known sentence begins
            plain = F.regexp_replace(plain, _over_lines(pattern), f"<{name}>$0")
        lines = F.filter(F.split(plain, "\n"), lambda line: line.contains("<"))
        known = F.flatten(F.transform(lines, chosen))
        unknown = F.when(sentence.rlike(WORD), F.array(F.lit(UNKNOWN))).otherwise(F.array().cast("array<string>"))
        return F.when(F.size(known) > 0, known).otherwise(unknown)

    def chosen(line: Column) -> Column:
        # marks side by side begin at one word: the first of the list stands first
        first = F.regexp_replace(line, r"(<\w+>)(?:<\w+>)+", "$1")
        found = F.array_distinct(F.regexp_extract_all(first, F.lit(r"<(\w+)>"), F.lit(1)))
        return F.when(F.size(found) > 1, F.array_remove(found, NOTICE)).otherwise(found)

    marked = F.filter(F.split(text, "(?i)" + "|".join(ENDS)), lambda s: s.rlike(KNOWN_WORD))
    return F.when(text.rlike(KNOWN_WORD), F.flatten(F.transform(marked, identify))).otherwise(F.array().cast("array<string>"))


def _over_lines(pattern: str) -> str:
    """The pattern with line breaks, and marks set before, where it has spaces; one that begins a
    line stays in that line."""
    mark = "(?:<\\w+>)*"
    if pattern.startswith("^"):
        return "(?m)^" + mark + pattern[1:].replace(".*", "[^\n]*").replace(" ", " " + mark)
    return pattern.replace(" ", f"(?:[ \n]{mark})").replace(".*", "(?s:.*?)")


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sentences=SENTENCES, rules=RULES) -> DataFrame:
    """One row per row: ``doc_id, sentences, licenses``.

    ``licenses`` has each licence once, by the order of the rules, and ``unknown`` if licence
    sentences are left that no rule takes.  A null or empty text has neither sentences nor
    licences; equal rows get equal results; a null doc_id stays null; other columns are ignored.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    df = docs.select(F.col(id_col).cast("long").alias("doc_id"), sentence_ids(text, sentences).alias("sentences"))
    df = df.withColumn("rest", F.concat_ws("", F.transform("sentences", lambda s: F.concat(F.lit("<"), s, F.lit(">")))))
    df = df.withColumn("found", F.array().cast("array<string>"))
    hit = F.col("rest") != ""
    for name, pattern in rules:
        df = df.withColumns({"found": F.when(hit & F.col("rest").rlike(pattern), F.array_append("found", F.lit(name))).otherwise(F.col("found")),
                             "rest": F.when(hit, F.regexp_replace("rest", pattern, "")).otherwise(F.col("rest"))})
    left = F.when(F.col("rest") != "", F.array_append("found", F.lit(UNKNOWN))).otherwise(F.col("found"))
    return df.select("doc_id", "sentences", F.array_distinct(left).alias("licenses"))


def duckdb_sql(table: str, id_col: str = "doc_id", text_col: str = "text", sentences=SENTENCES, rules=RULES) -> str:
    """The same scan in DuckDB SQL; lists are joined by commas."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    boundary = BOUNDARY.replace(r"\t", "\t").replace(r"\r", "\r").replace(r"\n", "\n")
    plain = f"trim(regexp_replace(translate(s, '{AZ}', '{az}'), '[^a-z0-9]+', ' ', 'g'))"
    cases = " ".join(f"WHEN regexp_matches({plain}, {quote(p)}) THEN {quote(n)}" for n, p in sentences)
    sql = f"""WITH split AS (
  SELECT {id_col} AS doc_id, list_filter(regexp_split_to_array(coalesce({text_col}, ''), {quote(boundary)}), lambda s: regexp_matches(s, {quote(LICENSE_WORD)})) AS marked
  FROM {table}), known AS (
  SELECT doc_id, list_transform(marked, lambda s: CASE {cases} ELSE '{UNKNOWN}' END) AS sentences FROM split), r0 AS (
  SELECT doc_id, sentences, coalesce(array_to_string(list_transform(sentences, lambda s: '<' || s || '>'), ''), '') AS rest, CAST([] AS VARCHAR[]) AS found FROM known)"""
    for i, (name, pattern) in enumerate(rules):
        sql += f""", r{i + 1} AS (
  SELECT doc_id, sentences, regexp_replace(rest, {quote(pattern)}, '', 'g') AS rest,
         CASE WHEN regexp_matches(rest, {quote(pattern)}) AND NOT list_contains(found, {quote(name)}) THEN list_append(found, {quote(name)}) ELSE found END AS found
  FROM r{i})"""
    return sql + f"""
SELECT doc_id, coalesce(array_to_string(sentences, ','), '') AS sentences,
       coalesce(array_to_string(CASE WHEN rest <> '' THEN list_append(found, '{UNKNOWN}') ELSE found END, ','), '') AS licenses
FROM r{len(rules)}"""
