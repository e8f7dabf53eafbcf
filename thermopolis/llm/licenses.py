"""License scans by conditional compression: the template that shortens a block most, then its wording."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from itertools import accumulate

import ahocorasick
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermopolis.llm.common import lean, pieces
from thermopolis.llm.words import make_room

# The public wording of notices, beside the name of the license they state.
TEMPLATES: list[tuple[str, str]] = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        ' documentation files (the "Software"), to deal in the Software without restriction, including without limitation'
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and"
        " to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above"
        " copyright notice and this permission notice shall be included in all copies or substantial portions of the"
        " Software.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance'
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless"
        " required by applicable law or agreed to in writing, software distributed under the License is distributed on an"
        ' "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version.",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation; either version 2 of the License, or (at your"
        " option) any later version.",
    ),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met: Redistributions of source code must retain the above copyright notice, this list"
        " of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright"
        " notice, this list of conditions and the following disclaimer in the documentation and/or other materials"
        " provided with the distribution.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not"
        " distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("Apache-1.1", "Licensed under the Apache License, Version 1.1."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General"
        " Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your"
        " option) any later version.",
    ),
    (
        "LGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version.",
    ),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met: Redistributions of source code must retain the above copyright notice, this list"
        " of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright"
        " notice, this list of conditions and the following disclaimer in the documentation and/or other materials"
        " provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may"
        " be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    (
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"
        " which is available at https://www.eclipse.org/legal/epl-2.0/",
    ),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held"
        " liable for any damages arising from the use of this software. Permission is granted to anyone to use this"
        " software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject"
        " to the following restrictions:",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,"
        " use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any"
        " purpose, commercial or non-commercial, and by any means.",
    ),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
]
# Words that name a license or its family. A notice that lacks one of its template's, or has
# another one, states another license.
NAMING = frozenset(
    "affero agpl apache bsd by-nc by-nc-nd by-nc-sa by-nd by-sa cc0 eclipse epl gnu gpl isc lesser lgpl mit mozilla mpl"
    " noderivatives noderivs noncommercial sharealike unlicense".split()
)
#: These are common words, but where a template has them they must be there.
NAMING_HERE = frozenset(
    "attribution attribution-noderivatives attribution-noncommercial attribution-sharealike boost by creative general library public".split()
)
VERSION = re.compile(r"v?\d{1,2}(\.\d+)*")

#: Words a step in the search for notices of one line.
SHORT = 12
#: A template is tried if it shortens the compressed block by this share of its own compressed size ...
MIN_REDUCTION = 0.15
#: ... and confirmed if this share of its words stands there in order.
MIN_WORDING = 0.85
LEVEL = 19
MEMO_ROWS = 20_000
PIECE = 4 << 20
WORD = re.compile(r"\w(?:[\w.+-]*\w)?")
FOUND = "license string, line int, reduction double, wording double, missing array<string>, added array<string>"


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


class Matcher:
    """Templates as raw dictionaries of a compressor each."""

    def __init__(self, templates: list[tuple[str, str]]):
        self.templates = [(name, words_of(text)) for name, text in templates]
        #: Words a confirmed notice has at most.
        self.longest = int(max(len(w) for _, w in self.templates) / MIN_WORDING) + 1
        self.counts = [Counter(w) for _, w in self.templates]
        self.versioned = [any(VERSION.fullmatch(x) for x in w) for _, w in self.templates]
        #: Word sequences of which every notice near enough to a template holds one.
        self.marks = ahocorasick.Automaton()
        for _, w in self.templates:
            for piece in pieces_of(w):
                self.marks.add_word(f" {' '.join(piece)} ", len(piece))
        self.marks.make_automaton()
        self.plain = zstandard.ZstdCompressor(level=LEVEL)
        self.sizes = [len(self.plain.compress(" ".join(w).encode())) for _, w in self.templates]
        self.given = [
            zstandard.ZstdCompressor(
                level=LEVEL,
                dict_data=zstandard.ZstdCompressionDict(" ".join(w).encode().ljust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT),
            )
            for _, w in self.templates
        ]

    def marked(self, words: list[str]) -> Iterator[tuple[int, int]]:
        """Where marks stand, from the first word to the one behind the last."""
        ends = list(accumulate((len(w) + 1 for w in words), initial=0))
        for end, n in self.marks.iter(f" {' '.join(words)} "):
            last = bisect_right(ends, end - 1)
            yield last - n, last

    def is_named(self, template: int, missing: list[str], added: list[str]) -> bool:
        """Whether what differs leaves the license's name and version as they are."""
        differ = {*missing, *added}
        if differ & NAMING or NAMING_HERE.intersection(missing):
            return False
        return not (self.versioned[template] and any(VERSION.fullmatch(w) for w in differ))

    def ranked(self, block: list[str]) -> list[tuple[float, int]]:
        """Templates by how many bytes shorter the block gets with them at hand, as shares of their sizes.

        A template of whose words too few stand in the block, in whatever order, cannot be confirmed.
        """
        have = Counter(block)
        able = [sum(min(n, have[w]) for w, n in c.items()) >= MIN_WORDING * len(t) for c, (_, t) in zip(self.counts, self.templates, strict=True)]
        if not any(able):
            return []
        data = " ".join(block).encode()
        alone = len(self.plain.compress(data))
        cut = [alone - len(c.compress(data)) for c in self.given]
        order = sorted(range(len(cut)), key=lambda i: (-cut[i], i))
        return [(cut[i] / self.sizes[i], i) for i in order if able[i] and cut[i] >= MIN_REDUCTION * self.sizes[i]]

    def wording(self, template: list[str], block: list[str]) -> tuple[float, int, int, list[str], list[str]]:
        """Share of equal words, where they stand, and the words missing and added there."""
        whole = SequenceMatcher(None, template, block, autojunk=False)
        longest = whole.find_longest_match()
        slack = max(2, len(template) // 10)
        begin = max(0, longest.b - longest.a - slack)
        part = block[begin : longest.b - longest.a + len(template) + slack]
        steps = [x for x in SequenceMatcher(None, template, part, autojunk=False).get_opcodes()]
        equal = [x for x in steps if x[0] == "equal"]
        if not equal:
            return 0.0, 0, 0, template, []
        first, last = equal[0][3], equal[-1][4]
        missing = [w for kind, a, b, _, _ in steps if kind in ("delete", "replace") for w in template[a:b]]
        added = [w for kind, _, _, a, b in steps if kind in ("insert", "replace") for w in part[max(a, first) : min(b, last)]]
        share = (len(template) - len(missing)) / max(len(template), last - first)
        return share, begin + first, begin + last, missing, added

    def find(self, block: list[str]) -> list[tuple]:
        """(license, word, reduction, wording, missing, added) of all notices in a block, one after another.

        The block is searched in parts of two sizes, for a notice of one line saves too little of a
        long part to stand out. Parts overlap by half; of findings that overlap the longest stays.
        """
        parts = [(i, block[i : i + 2 * n]) for n in (SHORT, self.longest) for i in range(0, max(1, len(block) - n), n)]
        found: list[tuple] = []
        while parts:
            at, part = parts.pop()
            best = None
            for cut, i in self.ranked(part) if any(True for _ in self.marked(part)) else []:
                share, *place = self.wording(self.templates[i][1], part)
                if share >= MIN_WORDING and (best is None or share > best[2]) and self.is_named(i, *place[2:]):
                    best = (self.templates[i][0], cut, share, *place)
            if best:
                name, cut, share, first, last, missing, added = best
                found.append((first + at, last + at, (name, at + first, cut, share, missing, added)))
                parts += [(at, part[:first]), (at + last, part[last:])]
        taken: list[tuple[int, int, tuple]] = []
        for x in sorted(found, key=lambda x: (x[0] - x[1], -x[2][3], x[0], x[2][0])):
            if all(x[1] <= a or b <= x[0] for a, b, _ in taken):
                taken.append(x)
        return [row for _, _, row in sorted(taken, key=lambda x: x[0])]


def pieces_of(template: list[str]) -> list[list[str]]:
    """The template cut into more pieces than a notice of MIN_WORDING can break, so that one is whole.

    Of n words m may be missing, and as many added as keep the share: each breaks one piece at most.
    """
    n = len(template)
    most = max(m + int((n - m) * (1 / MIN_WORDING - 1) + 1e-9) for m in range(int(n * (1 - MIN_WORDING) + 1e-9) + 1))
    cuts = [round(i * n / (most + 1)) for i in range(most + 2)]
    return [template[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def blocks_of(text: str, matcher: Matcher) -> Iterator[tuple[list[str], list[int]]]:
    """Words and each word's line of the candidate blocks of a text: as many words as a notice can have on
    either side of every mark, however the text is wrapped."""
    words, places = [], []
    for i, line in enumerate(text.split("\n")):
        found = words_of(line)
        words += found
        places += [i] * len(found)
    begin = end = 0
    for first, last in matcher.marked(words):
        if end and first - matcher.longest > end:
            yield words[begin:end], places[begin:end]
            end = 0
        if not end:
            begin = max(0, first - matcher.longest)
        end = min(len(words), max(end, last + matcher.longest))
    if end:
        yield words[begin:end], places[begin:end]


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each notice found: id, ``license``, ``line`` (from 0), ``reduction``, ``wording``,
    and the words ``missing`` and ``added`` against the template.

    Every template is cut into so many pieces that a notice near enough to it holds one of them word for
    word; such marks with as many words on either side as a notice can have are candidate blocks, whatever
    lines they stand in. A block is compressed alone and with each template as a raw zstandard dictionary; templates are ranked by
    how much shorter that makes it (``reduction`` is that as a share of the template's own compressed
    size), and of those it shortens enough for the one with the nearest wording wins, if at least 0.85 of its words
    stand there in order and make up as much of that place. One that differs in a word that names the license,
    or in its version, states another one and is not reported under this name. What stands before and behind a notice is
    searched on. Blocks over twice the longest template are searched in
    overlapping parts, so texts are read whole. Equal blocks are searched once in a task.

    Defined results: NULL and empty texts, and texts without a mark, have no rows; repeated rows
    have their findings each; a NULL id passes; an empty table gives no rows.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, memo = Matcher(templates), {}
        for batch in pieces(batches, 1, PIECE):
            rows: list[list] = [[] for _ in range(7)]
            for row, text in enumerate(batch.column(1).cast(pa.large_binary()).to_pylist()):
                for words, places in blocks_of((text or b"").decode(), matcher):
                    key = " ".join(words)
                    if key not in memo:
                        make_room(memo, 1, MEMO_ROWS)
                        memo[key] = matcher.find(words)
                    for name, word, *rest in memo[key]:
                        for column, value in zip(rows, (row, name, places[word], *rest), strict=True):
                            column.append(value)
            if rows[0]:
                kinds = [pa.string(), pa.int32(), pa.float64(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.string())]
                ids = batch.column(0).take(pa.array(rows[0]))
                names = ["id", "license", "line", "reduction", "wording", "missing", "added"]
                yield pa.RecordBatch.from_arrays([ids, *[pa.array(x, k) for x, k in zip(rows[1:], kinds, strict=True)]], names)

    return docs.mapInArrow(lean(run), f"id {kind}, {FOUND}").withColumnRenamed("id", id_col)
