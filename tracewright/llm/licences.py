"""Licence recognition by sentence rules (operator 5); DataFrame functions only.

A text is cut into sentences at blank lines and at full stops, question marks,
exclamation marks, colons and semicolons before white space. Any other line end may
end a sentence or not, so wrapped sentences are found as well as notices on a line of
their own without a full stop. A sentence is normalised: lower case, runs of anything
but letters, digits and dots become one space, so that comment marks at its line ends
vanish; a line of such marks only is blank. Known sentences have an identifier; of two
that begin at one line the longer counts. The identifiers found in a text, in
order, are matched against rules, each an ordered sequence of identifiers that must
stand in that order, other sentences between them or not. A text may match several
rules; a rule that is a part of another matched rule of the same licence adds
nothing.

Defined results: null and empty texts have no sentences and match no rule. Only
texts with a known sentence are in the result. Repeated rows repeat their result.

The SQL form ends sentences at every line end. It gives the same for texts without
wrapped licence sentences and does not find the wrapped ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Known licence sentences, as their licences state them.
SENTENCES = (
    ("gpl3-notice", "This work is licensed under the GNU General Public License, version 3."),
    ("ccbync4-notice", "Licensed under CC BY-NC 4.0."),
    ("mit-notice", "Released under the MIT License."),
    ("mit-title", "The MIT License (MIT)"),
    ("mit-title", "MIT License"),
    ("apache2-notice", "Licensed under the Apache License, Version 2.0."),
    ("apache2-notice", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("apache2-may", "you may not use this file except in compliance with the License."),
    ("apache2-copy", "You may obtain a copy of the License at"),
    ("apache2-asis", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'),
    ("apache2-see", "See the License for the specific language governing permissions and limitations under the License."),
    ("mit-grant", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("mit-notice-kept", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mit-asis", 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.'),
    ("bsd-grant", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("bsd-source", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("bsd-binary", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("bsd-names", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("gpl-free", "This program is free software:"),
    ("gpl-redistribute3", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl-redistribute2", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("gpl-useful", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;"),
    ("mpl2-notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc0-notice", "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this work to the public domain worldwide."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("ccby4-notice", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("ccbysa4-notice", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
)
#: Licences and the ordered sentences that state them.
RULES = (
    ("GPL-3.0", ("gpl3-notice",)),
    ("GPL-3.0-or-later", ("gpl-redistribute3", "gpl-useful")),
    ("GPL-2.0-or-later", ("gpl-redistribute2", "gpl-useful")),
    ("CC-BY-NC-4.0", ("ccbync4-notice",)),
    ("CC-BY-4.0", ("ccby4-notice",)),
    ("CC-BY-SA-4.0", ("ccbysa4-notice",)),
    ("CC0-1.0", ("cc0-notice",)),
    ("MIT", ("mit-notice",)),
    ("MIT", ("mit-grant", "mit-notice-kept", "mit-asis")),
    ("Apache-2.0", ("apache2-notice",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("MPL-2.0", ("mpl2-notice",)),
    ("Unlicense", ("unlicense",)),
)
_CUT = r"(?<=[.?!:;])[ \t\x0B\f\r]+|\n"


def normalised(text: Column) -> Column:
    """``text`` with an empty line after each sentence end; every line normalised."""
    ended = F.regexp_replace(F.lower(text), r"(?<=[.?!:;])[ \t\x0B\f\r]*[ \t\x0B\f\r\n]", "\n\n")
    return F.regexp_replace(F.regexp_replace(ended, r"[^a-z0-9.\n]+", " "), "(?m)^[ .]+|[ .]+$", "")


def _plain(sentence: str) -> str:
    import re

    return re.sub("^[ .]+|[ .]+$", "", re.sub("[^a-z0-9.]+", " ", sentence.lower()))


def known_sentences() -> dict[str, str]:
    """Identifier of each normalised known sentence, cut as texts are cut."""
    import re

    found = {}
    for name, text in SENTENCES:
        for part in re.split(_CUT, text):
            found[_plain(part)] = name
    return found


def _pattern() -> str:
    """Known sentences, the longest first, over whole lines; single line ends may
    stand for their spaces."""
    longest = sorted(known_sentences(), key=len, reverse=True)
    wrapped = "|".join(k.replace(".", r"\.").replace(" ", r"[ \n]") for k in longest)
    return f"(?m)^(?:{wrapped})$"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, sentences string, licences string``: per text with known sentences
    their identifiers in order, and the licences whose rules match, by name."""
    known = known_sentences()
    rows = docs.select(
        docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")
    )
    candidates = F.regexp_extract_all(normalised(F.col("text")), F.lit(_pattern()), F.lit(0))
    hit = rows.select("doc_id", candidates.alias("found")).where(F.size("found") > 0)
    identifier = F.create_map(*[F.lit(x) for item in known.items() for x in item])
    names = F.transform("found", lambda s: F.element_at(identifier, F.translate(s, "\n", " ")))
    sequence = F.concat(F.lit(" "), F.array_join(names, "  "), F.lit(" "))
    hit = hit.select("doc_id", names.alias("names"), sequence.alias("sequence"))
    matches = F.array(
        *[
            F.when(F.col("sequence").like("%" + "%".join(f" {n} " for n in rule) + "%"), F.lit(licence))
            for licence, rule in RULES
        ]
    )
    # BSD-3-Clause contains BSD-2-Clause: the longer rule stands for both.
    found = F.array_distinct(F.array_compact(matches))
    found = F.when(
        F.array_contains(found, "BSD-3-Clause"), F.array_remove(found, "BSD-2-Clause")
    ).otherwise(found)
    return hit.select(
        "doc_id",
        F.array_join("names", " ").alias("sentences"),
        F.array_join(F.sort_array(found), " ").alias("licences"),
    )


def oracle() -> str:
    """The same in DuckDB's SQL, over ``documents``."""
    known = ", ".join(f"('{text}', '{name}')" for text, name in known_sentences().items())
    rules = ", ".join(
        f"('{licence}', '{'%' + '%'.join(f' {n} ' for n in rule) + '%'}')" for licence, rule in RULES
    )
    return f"""
WITH cut AS (
  SELECT rowid AS row_no, doc_id,
    string_split_regex(regexp_replace(text, '([.?!:;])[ \\t\\x0B\\f\\r]+', '\\1' || chr(10), 'g'), '\\n') AS parts
  FROM (SELECT row_number() OVER () AS rowid, doc_id, text FROM documents) AS d),
sentence AS (
  SELECT row_no, doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS place FROM cut),
plain AS (
  SELECT row_no, doc_id, place,
    regexp_replace(regexp_replace(lower(part), '[^a-z0-9.]+', ' ', 'g'), '^[ .]+|[ .]+$', '', 'g') AS part
  FROM sentence),
known(part, name) AS (VALUES {known}),
hit AS (
  SELECT row_no, doc_id, string_agg(name, ' ' ORDER BY place) AS sentences,
    ' ' || string_agg(name, '  ' ORDER BY place) || ' ' AS sequence
  FROM plain JOIN known USING (part) GROUP BY row_no, doc_id),
rule(licence, pattern) AS (VALUES {rules}),
matched AS (
  SELECT DISTINCT row_no, licence FROM hit JOIN rule ON sequence LIKE pattern),
best AS (
  SELECT row_no, string_agg(licence, ' ' ORDER BY licence) AS licences FROM matched AS m
  WHERE licence <> 'BSD-2-Clause' OR NOT EXISTS (
    SELECT 1 FROM matched AS o WHERE o.row_no = m.row_no AND o.licence = 'BSD-3-Clause')
  GROUP BY row_no)
SELECT doc_id, sentences, coalesce(licences, '') AS licences FROM hit LEFT JOIN best USING (row_no)
"""
