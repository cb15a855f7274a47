"""Licence scans by sentence rules.

A text is cut into sentences (at line ends, and at . ! ? before white space); a
sentence is normalised to its lower-case words without outer punctuation.  Known
licence sentences have identifiers, a sentence broken over lines included; the
identifiers found in a text, in order, are matched against ordered licence rules,
the longest rule that fits at a place taking its sentences.  An SPDX line is a
sentence whose identifier is its own expression.

Known are titles, standard headers and the granting sentences of Apache-2.0, MIT,
ISC, BSD-2-Clause, BSD-3-Clause, MPL-2.0, GPL-2.0 and 3.0, LGPL-2.0, 2.1 and 3.0,
AGPL-3.0 (only and or later), the six CC BY licences 4.0, CC0-1.0 and the Unlicense.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import extended

# Identifier and sentence; several wordings may have one identifier.
NOTICES = (
    ("apache-2-line", "Licensed under the Apache License, Version 2.0"),
    ("apache-2-line", 'Licensed under the Apache License, Version 2.0 (the "License")'),
    ("apache-2-compliance", "you may not use this file except in compliance with the License"),
    ("apache-2-header", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License'),
    ("apache-2-title", "Apache License Version 2.0, January 2004"),
    ("mit-line", "Released under the MIT License"),
    ("mit-line", "Licensed under the MIT License"),
    ("mit-title", "MIT License"),
    ("mit-title", "The MIT License"),
    ("mit-title", "The MIT License (MIT)"),
    ("mit-permission", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the '
                       '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
                       'publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do '
                       'so, subject to the following conditions'),
    ("mit-notice", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("isc-title", "ISC License"),
    ("isc-permission", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
                       "the above copyright notice and this permission notice appear in all copies"),
    ("isc-permission", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that "
                       "the above copyright notice and this permission notice appear in all copies"),
    ("bsd-2-title", "BSD 2-Clause License"),
    ("bsd-3-title", "BSD 3-Clause License"),
    ("bsd-grant", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd-source", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("bsd-binary", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
                   "documentation and/or other materials provided with the distribution"),
    ("bsd-endorse", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
                    "software without specific prior written permission"),
    ("mpl-2-notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v"),  # the sentence is cut behind "v."
    ("mpl-2-title", "Mozilla Public License Version 2.0"),
    ("gpl-3-line", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-later", "or, at your option, any later version"),
    ("cc-by-nc-4-line", "Licensed under CC BY-NC 4.0"),
    ("cc0-notice", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the "
                   "public domain worldwide"),
    ("unlicense-notice", "This is free and unencumbered software released into the public domain"),
    ("reserved", "all rights reserved"),
)
# Name, identifier, and version and date of the title of the licences with the same notice.
GNU = (
    ("GNU General Public License", "GPL", (("2", "June 1991"), ("3", "29 June 2007"))),
    ("GNU Library General Public License", "LGPL", (("2", "June 1991"),)),
    ("GNU Lesser General Public License", "LGPL", (("2.1", "February 1999"), ("3", "29 June 2007"))),
    ("GNU Affero General Public License", "AGPL", (("3", "19 November 2007"),)),
)
GNU_SUBJECTS = ("This program", "This software", "This library", "This file", "It")
# The conditions of the Creative Commons licences, in full and short.
COMMONS = (("", "BY"), ("-NonCommercial", "BY-NC"), ("-ShareAlike", "BY-SA"), ("-NoDerivatives", "BY-ND"),
           ("-NonCommercial-ShareAlike", "BY-NC-SA"), ("-NonCommercial-NoDerivatives", "BY-NC-ND"))
# Licence and its sentences in order; of the rules that fit at a place, the longest counts, then the earlier.
ORDERED = (
    ("Apache-2.0", ("apache-2-line", "apache-2-compliance")), ("Apache-2.0", ("apache-2-line",)), ("Apache-2.0", ("apache-2-compliance",)),
    ("Apache-2.0", ("apache-2-header",)), ("Apache-2.0", ("apache-2-title",)),
    ("GPL-3.0-or-later", ("gpl-3-line", "gpl-later")), ("GPL-3.0-only", ("gpl-3-line",)),
    ("MIT", ("mit-line", "mit-notice")), ("MIT", ("mit-line",)), ("MIT", ("mit-notice",)), ("MIT", ("mit-title",)), ("MIT", ("mit-permission",)),
    ("MIT", ("mit-permission", "mit-notice")), ("MIT", ("mit-title", "mit-permission", "mit-notice")),
    ("MIT", ("mit-title", "reserved", "mit-permission", "mit-notice")),
    ("ISC", ("isc-title",)), ("ISC", ("isc-permission",)), ("ISC", ("isc-title", "isc-permission")),
    ("BSD-2-Clause", ("bsd-2-title",)), ("BSD-3-Clause", ("bsd-3-title",)),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")), ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("reserved", "bsd-grant", "bsd-source", "bsd-binary")),
    ("BSD-3-Clause", ("reserved", "bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-2-title", "bsd-grant", "bsd-source", "bsd-binary")),
    ("BSD-3-Clause", ("bsd-3-title", "bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-2-title", "reserved", "bsd-grant", "bsd-source", "bsd-binary")),
    ("BSD-3-Clause", ("bsd-3-title", "reserved", "bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("MPL-2.0", ("mpl-2-notice",)), ("MPL-2.0", ("mpl-2-title",)), ("CC0-1.0", ("cc0-notice",)), ("Unlicense", ("unlicense-notice",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4-line",)), ("proprietary", ("reserved",)),
)
_SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+()-]+(?:[ \t]+(?:AND|OR|WITH)[ \t]+[A-Za-z0-9.+()-]+)*)", re.IGNORECASE)
_SPDX_WORD = "spdx-license-identifier"
_OWNERS = ("copyright", "c", "©")  # first words of a line that says whose the rights are

_FRAGMENT = re.compile(r"[^\n]+?(?:[.!?](?=\s|$)|$)", re.MULTILINE)
_OUTER = " \t\r\x0b\x0c.,;:!?\"'()[]{}<>*#/-"
_WORD = re.compile(rf"[^\s{re.escape(_OUTER)}]\S*")  # a word without the outer punctuation before it


def normalised(sentence: str) -> str:
    return " ".join(w for w in (w.strip(_OUTER) for w in sentence.lower().split()) if w)


def _families() -> tuple[list[tuple[str, str]], list[tuple[str, tuple[str, ...]]]]:
    """Sentences and rules of the licences whose notices differ in name and version only."""
    sentences, rules = [], []
    for full, short, versions in GNU:
        for version, date in versions:
            name, licence = f"{full.lower().replace(' ', '-')}-{version}", f"{short}-{version if '.' in version else version + '.0'}"
            sentences.append((f"{name}-title", f"{full} Version {version}, {date}"))
            for subject in GNU_SUBJECTS:
                terms = f"{subject} is free software; you can redistribute it and/or modify it under the terms of the {full}"
                by = "as published by the Free Software Foundation"
                sentences += [(f"{name}-later", f"{terms} {by}, either version {version} of the License, or (at your option) any later version"),
                              (f"{name}-only", f"{terms} {by}, version {version} of the License"), (f"{name}-only", f"{terms}, version {version}, {by}"),
                              (f"{name}-only", f"{terms} version {version} {by}")]
            rules += [(f"{licence}-or-later", (f"{name}-later",)), (f"{licence}-only", (f"{name}-only",)), (f"{licence}-only", (f"{name}-title",))]
    for full, short in COMMONS:
        name = f"cc-{short.lower()}-4"
        sentences += [(f"{name}-notice", f"This work is licensed under {article} Creative Commons Attribution{full} 4.0 International License") for article in ("a", "the")]
        sentences += [(f"{name}-line", f"Licensed under CC {short} 4.0"), (f"{name}-line", f"Licensed under CC-{short}-4.0")]
        rules += [(f"CC-{short}-4.0", (f"{name}-notice",)), (f"CC-{short}-4.0", (f"{name}-line",))]
    return sentences, rules


SENTENCES = (*NOTICES, *_families()[0])
RULES = (*ORDERED, *_families()[1])


class Scanner:
    def __init__(self, sentences=SENTENCES, rules=RULES):
        self.known = {normalised(text): name for name, text in sentences}
        self.starts = {text.split()[0] for text in self.known} | {_SPDX_WORD, *_OWNERS}
        self.prefixes = {" ".join(text.split()[:n]) for text in self.known for n in range(1, len(text.split()))}  # proper ones
        self.rules = sorted(rules, key=lambda r: -len(r[1]))

    def sentences(self, text: str | None) -> list[tuple[str, int, int]]:
        """(identifier, begin, end) of every known sentence, in order; of two that begin alike the longer one.

        A sentence may be broken over any number of lines: lines are joined as long as they begin a known sentence.
        """
        found, fragments, i = [], [m.span() for m in _FRAGMENT.finditer(text or "")], 0
        while i < len(fragments):
            begin, end = fragments[i]
            i += 1
            first = _WORD.search(text, begin, end)
            if not first:
                continue
            word = first[0].lower().strip(_OUTER)
            if word.startswith(_SPDX_WORD) and (m := _SPDX.search(text, begin, end)):
                found.append((f"spdx:{m[1]}", m.start(), m.end()))
                continue
            if word not in self.starts:
                continue
            words, j, best = normalised(text[begin:end]), i, None
            if word in _OWNERS and words.endswith("all rights reserved"):
                best = "reserved", i
            while best is None or words in self.prefixes:
                if words in self.known:
                    best = self.known[words], j
                if words not in self.prefixes or j == len(fragments) or text[fragments[j - 1][1] - 1] in ".!?":
                    break
                words = f"{words} {normalised(text[slice(*fragments[j])])}".rstrip()
                j += 1
            if best:
                begin += len(text[begin:end]) - len(text[begin:end].lstrip())
                found.append((best[0], begin, fragments[best[1] - 1][1]))
                i = best[1]
        return found

    def licences(self, names: list[str]) -> list[tuple[str, int, int]]:
        """(licence, from, to) over positions in the list of identifiers."""
        found, i = [], 0
        while i < len(names):
            if names[i].startswith("spdx:"):
                found.append((names[i][5:], i, i + 1))
                i += 1
                continue
            fit = next((r for r in self.rules if tuple(names[i: i + len(r[1])]) == r[1]), None)
            if fit:
                found.append((fit[0], i, i + len(fit[1])))
            i += len(fit[1]) if fit else 1
        return found


def scan(docs: DataFrame, sentences=SENTENCES, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, sentence_ids, licences and matches (licence, begin, end in characters) for every document; whole texts.

    A null, empty or licence-free text has empty lists; repeated rows and null
    ids are scanned like others; an empty table gives no rows; further columns
    are ignored.
    """
    scanner = Scanner(sentences, rules)
    held = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    match = pa.struct([("licence", pa.string()), ("begin", pa.int64()), ("end", pa.int64())])

    def run(batches):
        for b in batches:
            ids, names, matches = [], [], []
            for text in b.column("text").to_pylist():
                found = scanner.sentences(text)
                fits = scanner.licences([f[0] for f in found])
                ids.append([f[0] for f in found])
                names.append([f[0] for f in fits])
                matches.append([{"licence": n, "begin": found[x][1], "end": found[y - 1][2]} for n, x, y in fits])
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(ids, pa.list_(pa.string())), pa.array(names, pa.list_(pa.string())), pa.array(matches, pa.list_(match))],
                names=["id", "sentence_ids", "licences", "matches"])

    schema = extended(held.select("id").schema, "sentence_ids array<string>, licences array<string>, "
                      "matches array<struct<licence: string, begin: long, end: long>>")
    return held.mapInArrow(run, schema).select(F.col("id").alias(id_col), "sentence_ids", "licences", "matches")
