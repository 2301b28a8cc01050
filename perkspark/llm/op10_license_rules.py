"""License scans: sentences mapped to known licence sentences, sequences matched with rules.

A text is cut into pieces at line ends and after ``.``, ``!`` or ``?`` before
white space (a stop after a single letter, as in ``v. 2.0``, ends nothing).  A
piece is normalised to its lower-case ASCII letters and digits, with one blank
for any run of other characters, so that comment marks vanish; pieces without
letters or digits have no number.  Stops and such blank lines end a sentence, other
line ends may: a known sentence is recognised where it equals one piece, or
several wrapped lines of one sentence.  A recognised sentence inside a longer one
does not count.  ``SPDX-License-Identifier:`` names its licence itself, whichever it
is.  The sequence of recognised identifiers of a text is then matched with the
licence rules: a rule holds wherever its identifiers follow each other in order
with no other licence sentence between them.  No rule is part of another.  Texts
without any word that marks a known sentence are not cut at all.

Defined cases: null or empty text has no sentences and no licence; equal texts
have equal results; a text of any length is one row, scanned once; a null doc_id
is passed through; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import bounded_batches, byte_chunks, table

# Sentences of published licences and notices, by identifier.
SENTENCES = {
    "mit-notice": "Released under the MIT License.",
    "mit-notice-2": "Licensed under the MIT License.",
    "mit-notice-3": "This project is licensed under the terms of the MIT license.",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit-condition": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-warranty": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    "apache-copy": "You may obtain a copy of the License at",
    "apache-required": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "bsd-allow": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-warranty": 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.',
    "gpl3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl2-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "mpl-subject": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense-free": "This is free and unencumbered software released into the public domain.",
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-notice": "Licensed under CC BY 4.0.",
    "cc-by-sa-notice": "Licensed under CC BY-SA 4.0.",
    "cc-by-text": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-text": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc0-text": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "all-rights": "All rights reserved.",
    "lgpl3-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "lgpl21-free": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "lgpl21-hope": "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "agpl3-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "epl2-terms": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "epl2-terms-2": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v. 2.0 which is available at http://www.eclipse.org/legal/epl-2.0.",
    "zlib-as-is": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib-liable": "In no event will the authors be held liable for any damages arising from the use of this software.",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "boost-notice": "Distributed under the Boost Software License, Version 1.0.",
}

# Licence of each ordered sequence of sentences; none is part of another.
RULES = [
    ("MIT", ["mit-notice"]),
    ("MIT", ["mit-notice-2"]),
    ("MIT", ["mit-notice-3"]),
    ("MIT", ["mit-grant", "mit-condition", "mit-warranty"]),
    ("ISC", ["isc-grant"]),
    ("Apache-2.0", ["apache-notice"]),
    ("Apache-2.0", ["apache-header", "apache-copy", "apache-required"]),
    ("BSD-3-Clause", ["bsd-allow", "bsd-source", "bsd-binary", "bsd-names", "bsd-warranty"]),
    ("BSD-2-Clause", ["bsd-allow", "bsd-source", "bsd-binary", "bsd-warranty"]),
    ("GPL-3.0", ["gpl3-notice"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-hope"]),
    ("GPL-2.0-or-later", ["gpl2-free", "gpl-hope"]),
    ("MPL-2.0", ["mpl-subject"]),
    ("Unlicense", ["unlicense-free"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-notice"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-text"]),
    ("CC-BY-4.0", ["cc-by-notice"]),
    ("CC-BY-4.0", ["cc-by-text"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-notice"]),
    ("CC0-1.0", ["cc0-text"]),
    ("Proprietary", ["all-rights"]),
    ("LGPL-3.0-or-later", ["lgpl3-free", "gpl-hope"]),
    ("LGPL-2.1-or-later", ["lgpl21-free", "lgpl21-hope"]),
    ("AGPL-3.0-or-later", ["agpl3-free", "gpl-hope"]),
    ("EPL-2.0", ["epl2-terms"]),
    ("EPL-2.0", ["epl2-terms-2"]),
    ("Zlib", ["zlib-as-is", "zlib-liable", "zlib-grant"]),
    ("BSL-1.0", ["boost-notice"]),
]

SCHEMA = "doc_id long, n_known long, sentence_ids string, licenses string, matches string"
#: A licence expression after its tag; its identifier is this prefix and the expression.
SPDX = r"SPDX-License-Identifier:[ \t]*([A-Za-z0-9](?:[A-Za-z0-9.+-]*[A-Za-z0-9+])?(?: (?:AND|OR|WITH) [A-Za-z0-9](?:[A-Za-z0-9.+-]*[A-Za-z0-9+])?)*)"
SPDX_ID = "spdx:"
SPDX_TAG = re.compile(SPDX.encode())
#: A stop that ends no sentence; a stop that does; letters and digits apart.
INITIAL = re.compile(rb"(^|[^A-Za-z0-9])([A-Za-z])[.]([ \t\r\n])")
STOP = re.compile(rb"([.!?])[ \t\r\n]")
NOT_WORD = re.compile(rb"[^a-z0-9]+")


def normalised(sentence: bytes) -> bytes:
    return NOT_WORD.sub(b" ", sentence.lower()).strip()


def sentences(text: bytes) -> Iterator[list[tuple[int, bytes, bytes]]]:
    """The (number, normalised text, text) of each sentence's pieces, which are its lines."""
    number = 0
    cut = STOP.sub(rb"\1\n\n", INITIAL.sub(rb"\1\2 \3", text))
    sentence: list[tuple[int, bytes, bytes]] = []
    for line in cut.split(b"\n"):
        key = normalised(line)
        if key:
            sentence.append((number, key, line))
            number += 1
        elif sentence:
            yield sentence
            sentence = []
    if sentence:
        yield sentence


#: Identifier by normalised sentence, and the normalised sentences by their first word.
KNOWN = {normalised(INITIAL.sub(rb"\1\2 \3", text.encode())): name for name, text in SENTENCES.items()}
FIRST: dict[bytes, list[bytes]] = {}
for _key in KNOWN:
    FIRST.setdefault(_key.split()[0], []).append(_key)
#: Of each known sentence its longest word, and the tag; a text without any of them has no known sentence.
MARKS = re.compile(b"|".join(sorted({max(k.split(), key=len) for k in KNOWN} | {b"spdx"})))


def recognised(text: bytes) -> list[tuple[int, int, str]]:
    """(first piece, last piece, identifier) of known sentences, in order; pieces are numbered from 0."""
    if not MARKS.search(text.lower()):
        return []
    found = []
    for pieces in sentences(text):
        whole = b" ".join(key for _, key, _ in pieces) + b" "
        ends, at = {}, 0  # where a piece ends in the sentence
        starts = []
        for number, key, _ in pieces:
            starts.append(at)
            at += len(key) + 1
            ends[at] = number
        own = []
        for (number, key, raw), start in zip(pieces, starts, strict=True):
            for k in FIRST.get(key.split(b" ", 1)[0], ()):
                last = ends.get(start + len(k) + 1)
                if last is not None and whole.startswith(k, start):
                    own.append((number, last, KNOWN[k]))
            if tag := SPDX_TAG.search(raw):
                own.append((number, number, SPDX_ID + tag[1].decode()))
        # in order of their starts, longest first, one inside another ends no later than the furthest before it
        own.sort(key=lambda x: (x[0], -x[1], x[2]))
        reach = (-1, -1)
        for first, last, name in own:
            if last > reach[1] or (first, last) == reach:
                found.append((first, last, name))
                reach = (first, last)
    return found


def rule_matches(found: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """(first piece, last piece, licence) of each place where a rule holds, in order."""
    names = [n for _, _, n in found]
    out = [(a, b, n.removeprefix(SPDX_ID)) for a, b, n in found if n.startswith(SPDX_ID)]
    for licence, rule in RULES:
        for i in range(len(names) - len(rule) + 1):
            if names[i : i + len(rule)] == rule:
                out.append((found[i][0], found[i + len(rule) - 1][1], licence))
    return sorted(out)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in byte_chunks(batches):
        found = [recognised(t or b"") for t in texts]
        matches = [rule_matches(f) for f in found]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).cast(pa.int64()),
                pa.array([len(f) for f in found], pa.int64()),
                pa.array([",".join(n for _, _, n in f) for f in found], pa.string()),
                pa.array([",".join(sorted({m[2] for m in ms})) for ms in matches], pa.string()),
                pa.array([",".join(f"{licence}:{a}:{b}" for a, b, licence in ms) for ms in matches], pa.string()),
            ],
            names=[p.split()[0] for p in SCHEMA.split(", ")],
        )


def license_scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_known, sentence_ids (in order), licenses (sorted), matches (licence:first:last piece)."""
    return bounded_batches(docs).select("doc_id", "text").mapInArrow(_scan, SCHEMA)


def op10_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


_KNOWN_ROWS = ", ".join(f"('{k.decode()}', '{v}')" for k, v in KNOWN.items())
_RULE_ROWS = ", ".join(f"('{licence}', {ids})" for licence, ids in RULES)
ORACLE_SQL = rf"""
WITH known(k, id) AS (VALUES {_KNOWN_ROWS}),
rules(licence, ids) AS (VALUES {_RULE_ROWS}),
cut AS (
  SELECT row_number() OVER () AS r, doc_id,
    string_split(regexp_replace(regexp_replace(coalesce(text, ''), '(^|[^A-Za-z0-9])([A-Za-z])[.]([ \t\r\n])', '\1\2 \3', 'g'), '([.!?])[ \t\r\n]', '\1' || chr(10) || chr(10), 'g'), chr(10)) AS s
  FROM documents
), keyed AS (
  SELECT r, i, raw, trim(regexp_replace(translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g')) AS k
  FROM (SELECT r, i, s[i] AS raw FROM (SELECT r, s, unnest(range(1, len(s) + 1)) AS i FROM cut))
), numbered AS (
  SELECT r, k, raw, sum((k = '')::INT) OVER w AS sentence, sum((k <> '')::INT) OVER w - 1 AS n FROM keyed WINDOW w AS (PARTITION BY r ORDER BY i)
), pieces AS (
  SELECT r, sentence, list(k ORDER BY n) AS ks, min(n) AS first FROM numbered WHERE k <> '' GROUP BY r, sentence
), holding AS (
  SELECT p.*, known.k, id FROM pieces p JOIN known ON contains(' ' || array_to_string(ks, ' ') || ' ', ' ' || known.k || ' ')
), begun AS (
  SELECT *, unnest(range(1, len(ks) + 1)) AS i FROM holding
), spanned AS (
  SELECT *, unnest(range(i, least(len(ks), i + len(string_split(k, ' '))) + 1)) AS j FROM begun WHERE split_part(ks[i], ' ', 1) = split_part(k, ' ', 1)
), placed AS (
  SELECT r, first + i - 1 AS a, first + j - 1 AS b, id FROM spanned WHERE array_to_string(ks[i:j], ' ') = k
  UNION ALL
  SELECT r, n, n, '{SPDX_ID}' || regexp_extract(raw, '{SPDX}', 1) FROM numbered WHERE regexp_matches(raw, '{SPDX}')
), sole AS (
  SELECT * FROM placed x WHERE NOT EXISTS (SELECT 1 FROM placed y WHERE y.r = x.r AND y.a <= x.a AND y.b >= x.b AND (y.a < x.a OR y.b > x.b))
), found AS (
  SELECT r, list(id ORDER BY a, b, id) AS ids, list(a ORDER BY a, b, id) AS firsts, list(b ORDER BY a, b, id) AS lasts FROM sole GROUP BY r
), matched AS (
  SELECT r, licence, firsts[j] AS a, lasts[j + len(rules.ids) - 1] AS b
  FROM (SELECT *, unnest(range(1, len(ids) + 1)) AS j FROM found) f JOIN rules ON f.ids[j : j + len(rules.ids) - 1] = rules.ids
  UNION ALL
  SELECT r, id[{len(SPDX_ID) + 1}:], a, b FROM sole WHERE starts_with(id, '{SPDX_ID}')
), summed AS (
  SELECT r, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licenses, string_agg(licence || ':' || a || ':' || b, ',' ORDER BY a, b, licence) AS matches
  FROM matched GROUP BY r
)
SELECT doc_id, coalesce(len(ids), 0)::BIGINT AS n_known, coalesce(array_to_string(ids, ','), '') AS sentence_ids,
       coalesce(licenses, '') AS licenses, coalesce(matches, '') AS matches
FROM cut LEFT JOIN found USING (r) LEFT JOIN summed USING (r)
"""
