"""Licence recognition by sentence rules.

A text is cut into sentences in two ways: line by line, and with line ends read as blanks so that a
wrapped sentence stays whole (an empty line always ends one). Sentences are normalised to lower-case
words, known ones become identifiers, and the identifiers in order, with a break wherever more than
``max_gap`` unknown sentences lie between two, are matched against the rules: a rule is a sequence of
identifiers that must stand one after the other. A known sentence may have a gap, ``{}``, for the one
to twelve words of a name.

Where several rules match at one place the longest counts: the first two conditions of a licence with
three are not a licence with two. The two ways see the same place twice, and one of them may see less
of it. So a rule that is part of a longer one counts as often as the way that sees it most often, by
itself or inside longer rules, exceeds the places of the longer ones.

``SPDX-License-Identifier`` lines give the identifiers they name, of those known to the rules.

Everything happens inside a row: nothing is shuffled, so copies and large sources cost what they
weigh. The tables of sentences and rules are parameters and part of the plan. Known sentences are cut
as texts are, so one with a full stop or semicolon inside becomes several identifiers in its rules.

Full texts are known by their titles, as GPL-3.0-only and so on; the notice that the GNU texts quote
at their end adds the licence with later versions.

Defined results: a line end may be LF, CRLF or CR; a null or empty text has no sentences and no
licences; a sentence that is repeated counts each time; rows that repeat keep their own results; an
empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom.llm.text import filled, table

# Sentences of public licence texts and notices, not cut yet.
TEXTS = {
    "mit.name": "The MIT License",
    "mit.name.paren": "The MIT License (MIT)",
    "mit.short": "MIT License",
    "mit.ref.released": "Released under the MIT License.",
    "mit.ref.licensed": "Licensed under the MIT License.",
    "mit.grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions:"
    ),
    "mit.notice": (
        "The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software."
    ),
    "mit.asis": (
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
    ),
    "mit.liability": (
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
        "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
        "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "apache.ref": "Licensed under the Apache License, Version 2.0.",
    "apache.name": "Apache License, Version 2.0",
    "apache.notice": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache.comply": "you may not use this file except in compliance with the License.",
    "apache.obtain": "You may obtain a copy of the License at",
    "apache.asis": (
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'
    ),
    "gpl3.ref": "This work is licensed under the GNU General Public License, version 3.",
    "gpl3.name": "GNU General Public License, version 3",
    "gpl2.ref": "This work is licensed under the GNU General Public License, version 2.",
    "gpl.free": "This program is free software:",
    "gpl3.terms": (
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "gpl2.terms": (
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."
    ),
    "gpl3.terms.semicolon": (
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation; either version 3 of the License, or (at your option) any later version."
    ),
    "gpl2.only": (
        "you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as "
        "published by the Free Software Foundation."
    ),
    "lgpl.free": "This library is free software:",
    "lgpl2.terms": (
        "you can redistribute it and/or modify it under the terms of the GNU Library General Public License as "
        "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later "
        "version."
    ),
    "lgpl21.terms": (
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any "
        "later version."
    ),
    "lgpl3.terms": (
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version."
    ),
    "agpl3.terms": (
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version."
    ),
    "gpl2.title": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "gpl3.title": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "lgpl2.title": "GNU LIBRARY GENERAL PUBLIC LICENSE Version 2, June 1991",
    "lgpl21.title": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    "lgpl3.title": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "agpl3.title": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    "apache.title": "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
    "mpl.title": "Mozilla Public License Version 2.0",
    "bsd.grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:"
    ),
    "bsd.source": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer."
    ),
    "bsd.binary": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    "bsd.names": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission."
    ),
    "isc.grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "unlicense.domain": "This is free and unencumbered software released into the public domain.",
    "cc.by-nc.ref": "Licensed under CC BY-NC 4.0.",
    "cc.by.ref": "Licensed under CC BY 4.0.",
    "cc.by-sa.ref": "Licensed under CC BY-SA 4.0.",
    "cc0.ref": "Licensed under CC0 1.0.",
    "mpl.notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."
    ),
    "0bsd.grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted."
    ),
    "isc.grant.and": (
        "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "zlib.asis": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib.liability": (
        "In no event will the authors be held liable for any damages arising from the use of this software."
    ),
    "zlib.grant": (
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, "
        "and to alter it and redistribute it freely, subject to the following restrictions:"
    ),
    "bsl.title": "Boost Software License - Version 1.0 - August 17th, 2003",
    "bsl.ref": "Distributed under the Boost Software License, Version 1.0.",
    "bsl.grant": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the "
        'software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, '
        "distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to "
        "permit third-parties to whom the Software is furnished to do so, all subject to the following:"
    ),
    "epl2.title": "Eclipse Public License - v 2.0",
    "epl2.notice": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public "
        "License 2.0 which is available at {}"
    ),
    "artistic2.title": "The Artistic License 2.0",
    "artistic2.short": "Artistic License 2.0",
    "wtfpl.title": "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE",
    "wtfpl.copy": (
        "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and "
        "changing it is allowed as long as the name is changed."
    ),
    "bsd.advertising": (
        "All advertising materials mentioning features or use of this software must display the following "
        "acknowledgement:"
    ),
    "bsd.product": "This product includes software developed by {}.",
    "bsd.names.of": (
        "Neither the name of {} nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission."
    ),
    "bsd.name.of": (
        "Neither the name of {} nor the names of contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission."
    ),
    "bsd.author": (
        "The name of {} may not be used to endorse or promote products derived from this software without specific "
        "prior written permission."
    ),
}

# Two names of one licence in SPDX lines. Fixed values.
SPDX_NAMES = {
    "GPL-2.0": "GPL-2.0-only", "GPL-2.0+": "GPL-2.0-or-later", "GPL-3.0": "GPL-3.0-only", "GPL-3.0+": "GPL-3.0-or-later",
    "LGPL-2.0": "LGPL-2.0-only", "LGPL-2.0+": "LGPL-2.0-or-later", "LGPL-2.1": "LGPL-2.1-only",
    "LGPL-2.1+": "LGPL-2.1-or-later", "LGPL-3.0": "LGPL-3.0-only", "LGPL-3.0+": "LGPL-3.0-or-later",
    "AGPL-3.0": "AGPL-3.0-only",
}

_BSD_NAMES = ("bsd.names", "bsd.names.of", "bsd.name.of", "bsd.author")

# Licence and the sentences that must follow one another; several rules may name one licence.
TEXT_RULES = (
    ("MIT", ("mit.grant", "mit.notice", "mit.asis", "mit.liability")),
    ("MIT", ("mit.ref.released",)),
    ("MIT", ("mit.ref.licensed",)),
    ("MIT", ("mit.name",)),
    ("MIT", ("mit.name.paren",)),
    ("MIT", ("mit.short",)),
    ("Apache-2.0", ("apache.notice", "apache.comply", "apache.obtain", "apache.asis")),
    ("Apache-2.0", ("apache.notice", "apache.comply", "apache.obtain")),
    ("Apache-2.0", ("apache.ref",)),
    ("Apache-2.0", ("apache.name",)),
    ("Apache-2.0", ("apache.title",)),
    ("GPL-3.0-or-later", ("gpl.free", "gpl3.terms")),
    ("GPL-3.0-or-later", ("gpl.free", "gpl3.terms.semicolon")),
    ("GPL-3.0-only", ("gpl3.ref",)),
    ("GPL-3.0-only", ("gpl3.name",)),
    ("GPL-3.0-only", ("gpl3.title",)),
    ("GPL-2.0-or-later", ("gpl.free", "gpl2.terms")),
    ("GPL-2.0-only", ("gpl.free", "gpl2.only")),
    ("GPL-2.0-only", ("gpl2.ref",)),
    ("GPL-2.0-only", ("gpl2.title",)),
    *[
        (licence, (free, terms))
        for free in ("gpl.free", "lgpl.free")
        for licence, terms in (
            ("LGPL-2.0-or-later", "lgpl2.terms"),
            ("LGPL-2.1-or-later", "lgpl21.terms"),
            ("LGPL-3.0-or-later", "lgpl3.terms"),
        )
    ],
    ("LGPL-2.0-only", ("lgpl2.title",)),
    ("LGPL-2.1-only", ("lgpl21.title",)),
    ("LGPL-3.0-only", ("lgpl3.title",)),
    ("AGPL-3.0-or-later", ("gpl.free", "agpl3.terms")),
    ("AGPL-3.0-only", ("agpl3.title",)),
    ("BSD-4-Clause", ("bsd.grant", "bsd.source", "bsd.binary", "bsd.advertising")),
    *[
        ("BSD-4-Clause", ("bsd.grant", "bsd.source", "bsd.binary", "bsd.advertising", "bsd.product", names))
        for names in _BSD_NAMES
    ],
    *[("BSD-3-Clause", ("bsd.grant", "bsd.source", "bsd.binary", names)) for names in _BSD_NAMES],
    ("BSD-2-Clause", ("bsd.grant", "bsd.source", "bsd.binary")),
    ("0BSD", ("0bsd.grant",)),
    ("ISC", ("isc.grant",)),
    ("ISC", ("isc.grant.and",)),
    ("Zlib", ("zlib.asis", "zlib.liability", "zlib.grant")),
    ("BSL-1.0", ("bsl.title",)),
    ("BSL-1.0", ("bsl.ref",)),
    ("BSL-1.0", ("bsl.grant",)),
    ("EPL-2.0", ("epl2.title",)),
    ("EPL-2.0", ("epl2.notice",)),
    ("Artistic-2.0", ("artistic2.title",)),
    ("Artistic-2.0", ("artistic2.short",)),
    ("WTFPL", ("wtfpl.title",)),
    ("WTFPL", ("wtfpl.copy",)),
    ("Unlicense", ("unlicense.domain",)),
    ("CC-BY-NC-4.0", ("cc.by-nc.ref",)),
    ("CC-BY-4.0", ("cc.by.ref",)),
    ("CC-BY-SA-4.0", ("cc.by-sa.ref",)),
    ("CC0-1.0", ("cc0.ref",)),
    ("MPL-2.0", ("mpl.notice",)),
    ("MPL-2.0", ("mpl.title",)),
)

MAX_GAP = 3
BREAK = "#"
GAP = "{}"
GAP_WORDS = "[a-z0-9]+(?: [a-z0-9]+){0,11}"
# A full stop after these is part of a name. Fixed values.
SHORTENED = "Inc|Corp|Ltd|Co"


def normalise(sentence: str) -> str:
    """Lower-case words of letters and digits."""
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()


def gap_pattern(sentence: str) -> str:
    """What the normalised words of a sentence with gaps look like."""
    return " ".join(GAP_WORDS if part == GAP else normalise(part) for part in re.split(r"(\{\})", sentence) if part == GAP or normalise(part))


Rules = tuple[tuple[str, tuple[str, ...]], ...]


def cut_known(sentences: dict[str, str], rules: Rules) -> tuple[dict[str, str], Rules]:
    """Sentences cut as texts are, and the rules in identifiers of the parts.

    A part that several sentences have in common has the identifier of the first.
    """
    by_words: dict[str, str] = {}
    known, names_of = {}, {}
    for name, sentence in sentences.items():
        parts = [p for p in re.split(r"(?<=[.!?;:])[\x20\t]+", sentence) if normalise(p) or GAP in p]
        for i, part in enumerate(parts):
            words = gap_pattern(part)
            if words not in by_words:
                by_words[words] = name if len(parts) == 1 else f"{name}.{i + 1}"
                known[by_words[words]] = part
        names_of[name] = tuple(by_words[gap_pattern(part)] for part in parts)
    return known, tuple((licence, tuple(n for name in names for n in names_of[name])) for licence, names in rules)


SENTENCES, RULES = cut_known(TEXTS, TEXT_RULES)


def _normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))


def read(text: Column) -> Column:
    """One kind of line end, and no full stop inside of a name."""
    ends = F.regexp_replace(text, r"\r\n?", "\n")
    return F.regexp_replace(ends, rf"\b({SHORTENED})\.([\x20\t\n])", "$1$2")


def cut_lines(text: Column) -> Column:
    """Sentences that end with their line at the latest."""
    return F.split(F.regexp_replace(text, r"([.!?;:])[\x20\t]+", "$1\n"), r"\n")


def cut_paragraphs(text: Column) -> Column:
    """Sentences that may run over line ends, up to an empty line."""
    joined = F.regexp_replace(F.regexp_replace(text, r"\n[\x20\t]*\n", "\u0001"), r"\n", " ")
    return F.split(F.regexp_replace(joined, r"([.!?;:])[\x20\t]+", "$1\u0001"), "\u0001")


def recognised(sentences: Column, known: dict[str, str], max_gap: int) -> Column:
    """Identifiers in order, each with a blank before and after, a break between distant ones."""
    exact = {normalise(sentence): name for name, sentence in known.items() if GAP not in sentence}
    gaps = {gap_pattern(sentence): name for name, sentence in known.items() if GAP in sentence}
    placed = F.transform(sentences, lambda s, i: F.struct(i.alias("at"), _normalised(s).alias("words")))
    # Exact for ASCII; other letters only make a sentence unknown.
    of_gaps = f"^(?:{'|'.join(gaps)})$" if gaps else "^$"
    hits = F.filter(placed, lambda p: p.words.isin(*exact) | ((p.words != "") & p.words.rlike(of_gaps)))
    names = F.create_map(*[F.lit(x) for pair in exact.items() for x in pair])

    def name(words: Column) -> Column:
        return F.coalesce(F.try_element_at(names, words), *[F.when(words.rlike(f"^{pattern}$"), F.lit(own)) for pattern, own in gaps.items()])

    parts = F.transform(
        hits,
        lambda p, i: F.concat(
            F.when((i > 0) & (p.at - F.get(hits, i - 1).at > max_gap + 1), F.lit(f" {BREAK} ")).otherwise(""),
            F.lit(" "),
            name(p.words),
            F.lit(" "),
        ),
    )
    return F.array_join(parts, "")


def rule_text(names: tuple[str, ...]) -> str:
    return "".join(f" {name} " for name in names)


def rule_pattern(rules: Rules) -> str:
    """Any rule, the longest that there is at a place."""
    longest_first = sorted({rule_text(names) for _, names in rules}, key=lambda text: (-text.count("  "), text))
    return "|".join(re.escape(text).replace(r"\ ", " ") for text in longest_first)


def matching(sequence: Column, rules: Rules) -> Column:
    """The texts of the rules that are met, place by place."""
    return F.regexp_extract_all(sequence, F.lit(f"({rule_pattern(rules)})"), F.lit(1))


def standing(by_line: Column, by_paragraph: Column) -> Column:
    """The distinct rules of both ways, without those seen only as part of longer ones."""

    def seen(rule: Column, longer: bool) -> Column:
        ways = [
            F.size(F.filter(way, lambda x: F.contains(x, rule) & ((x != rule) if longer else F.lit(True))))
            for way in (by_line, by_paragraph)
        ]
        return F.greatest(*ways)

    return F.filter(
        F.array_distinct(F.concat(by_line, by_paragraph)), lambda rule: seen(rule, False) > seen(rule, True)
    )


def spdx(text: Column, licences: set[str]) -> Column:
    """Known licences that SPDX lines name."""
    lines = F.regexp_extract_all(text, F.lit(r"SPDX-License-Identifier:[\x20\t]*([^\r\n]*)"), F.lit(1))
    words = F.flatten(F.transform(lines, lambda line: F.regexp_extract_all(line, F.lit(r"[A-Za-z0-9.+-]+"), F.lit(0))))
    other = F.create_map(*[F.lit(x) for pair in SPDX_NAMES.items() for x in pair])
    named = F.transform(words, lambda word: F.coalesce(F.try_element_at(other, word), word))
    return F.filter(named, lambda word: word.isin(*sorted(licences)))


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sentences: dict[str, str] = SENTENCES,
    rules: Rules = RULES,
    max_gap: int = MAX_GAP,
) -> DataFrame:
    """``id, by_line, by_paragraph, licenses`` for every document."""
    sentences, rules = cut_known(sentences, rules)
    texts = docs.select(F.col(id_col).alias("id"), read(filled(text_col)).alias("text"))
    marked = texts.select(
        "id",
        recognised(cut_lines(F.col("text")), sentences, max_gap).alias("by_line"),
        recognised(cut_paragraphs(F.col("text")), sentences, max_gap).alias("by_paragraph"),
        spdx(F.col("text"), {licence for licence, _ in rules}).alias("by_name"),
    )
    licence_of = F.create_map(*[F.lit(x) for licence, names in rules for x in (rule_text(names), licence)])
    met = standing(matching(F.col("by_line"), rules), matching(F.col("by_paragraph"), rules))
    licences = F.concat(F.transform(met, lambda rule: F.element_at(licence_of, rule)), "by_name")
    tidy = lambda sequence: F.trim(F.regexp_replace(sequence, "  +", " ")).alias(sequence)
    return marked.withColumn("licenses", F.array_sort(F.array_distinct(licences))).select(
        "id", tidy("by_line"), tidy("by_paragraph"), "licenses"
    )


def op9_license_scan(spark, sf_dir) -> DataFrame:
    """``by_line`` and ``by_paragraph`` are the identifier sequences, ``licenses`` comma-joined."""
    return scan(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"),
        "by_line",
        "by_paragraph",
        F.array_join("licenses", ",").alias("licenses"),
        F.size("licenses").cast("bigint").alias("n_licenses"),
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_KNOWN = ", ".join(f"({_quoted(normalise(s))}, {_quoted(name)})" for name, s in SENTENCES.items() if GAP not in s)
_GAPS = ", ".join(f"({_quoted('^' + gap_pattern(s) + '$')}, {_quoted(name)})" for name, s in SENTENCES.items() if GAP in s)
_RULES = ", ".join(f"({_quoted(rule_text(names))}, {_quoted(licence)})" for licence, names in RULES)
_SPDX = ", ".join(
    f"({_quoted(word)}, {_quoted(licence)})"
    for word, licence in [*SPDX_NAMES.items(), *sorted((licence, licence) for licence in {licence for licence, _ in RULES})]
)

OP9_SQL = f"""
WITH known(words, name) AS (VALUES {_KNOWN}),
gaps(pattern, gap_name) AS (VALUES {_GAPS}),
rules(rule, licence) AS (SELECT DISTINCT * FROM (VALUES {_RULES})),
spdx(word, licence) AS (VALUES {_SPDX}),
texts AS (
    SELECT doc_id, regexp_replace(regexp_replace(coalesce(text, ''), '\\r\\n?', chr(10), 'g'),
                                  '\\b({SHORTENED})\\.([\\x20\\t\\n])', '\\1\\2', 'g') AS text
    FROM documents
), cut AS (
    SELECT doc_id, 'line' AS way,
           string_split(regexp_replace(text, '([.!?;:])[\\x20\\t]+', '\\1' || chr(10), 'g'), chr(10)) AS parts
    FROM texts
    UNION ALL
    SELECT doc_id, 'paragraph',
           string_split(regexp_replace(replace(regexp_replace(text, '\\n[\\x20\\t]*\\n', chr(1), 'g'), chr(10), ' '),
                                       '([.!?;:])[\\x20\\t]+', '\\1' || chr(1), 'g'), chr(1))
    FROM texts
), placed AS (
    SELECT doc_id, way, place, trim(regexp_replace(lower(sentence), '[^a-z0-9]+', ' ', 'g')) AS words
    FROM (SELECT doc_id, way, unnest(parts) AS sentence, generate_subscripts(parts, 1) AS place FROM cut)
), named AS (
    SELECT doc_id, way, place, name FROM placed JOIN known USING (words)
    UNION ALL
    SELECT doc_id, way, place, min(gap_name) FROM placed JOIN gaps ON regexp_matches(words, pattern)
    WHERE words NOT IN (SELECT words FROM known) GROUP BY doc_id, way, place
), hits AS (
    SELECT *, place - lag(place) OVER (PARTITION BY doc_id, way ORDER BY place) AS step FROM named
), sequences AS (
    SELECT doc_id, way,
           string_agg(CASE WHEN step > {MAX_GAP + 1} THEN ' {BREAK} ' ELSE '' END || ' ' || name || ' ', '' ORDER BY place) AS ids
    FROM hits GROUP BY doc_id, way
), met AS (
    SELECT doc_id, way, regexp_extract_all(ids, {_quoted("(" + rule_pattern(RULES) + ")")}, 1) AS found FROM sequences
), ways AS (
    SELECT t.doc_id, coalesce(l.found, []) AS l, coalesce(p.found, []) AS p
    FROM texts t
    LEFT JOIN met l ON l.doc_id = t.doc_id AND l.way = 'line'
    LEFT JOIN met p ON p.doc_id = t.doc_id AND p.way = 'paragraph'
), each_rule AS (
    SELECT DISTINCT doc_id, l, p, unnest(list_concat(l, p)) AS rule FROM ways
), licensed AS (
    SELECT doc_id, licence FROM each_rule JOIN rules USING (rule)
    WHERE greatest(len(list_filter(l, lambda x: contains(x, rule))), len(list_filter(p, lambda x: contains(x, rule))))
        > greatest(len(list_filter(l, lambda x: contains(x, rule) AND x <> rule)),
                   len(list_filter(p, lambda x: contains(x, rule) AND x <> rule)))
    UNION
    SELECT doc_id, licence
    FROM (SELECT doc_id, unnest(regexp_extract_all(line, '[A-Za-z0-9.+-]+')) AS word
          FROM (SELECT doc_id, unnest(regexp_extract_all(text, 'SPDX-License-Identifier:[\\x20\\t]*([^\\r\\n]*)', 1)) AS line FROM texts))
    JOIN spdx USING (word)
), listed AS (
    SELECT doc_id, string_agg(licence, ',' ORDER BY licence) AS licenses, count(*) AS n FROM licensed GROUP BY doc_id
)
SELECT t.doc_id,
       coalesce(trim(regexp_replace(l.ids, '  +', ' ', 'g')), '') AS by_line,
       coalesce(trim(regexp_replace(p.ids, '  +', ' ', 'g')), '') AS by_paragraph,
       coalesce(licenses, '') AS licenses,
       coalesce(n, 0) AS n_licenses
FROM texts t
LEFT JOIN sequences l ON l.doc_id = t.doc_id AND l.way = 'line'
LEFT JOIN sequences p ON p.doc_id = t.doc_id AND p.way = 'paragraph'
LEFT JOIN listed n ON n.doc_id = t.doc_id
"""
