"""License notices, recognised by how well a template's text compresses them.

1. Each license has several wordings: short notices, titles, SPDX lines, standard headers,
   permission paragraphs and conditions. The rarest words of a wording are its keys. Each
   place where a key stands in a text gives a candidate block for each of its wordings:
   as much text before and after as the wording has there, and a quarter more, whatever
   the lines. Blocks of neighbouring keys overlap, so no notice is cut at a block's edge.
2. A block, its case, line breaks and comment marks folded, is compressed with the wording
   as a zstandard raw dictionary. The bytes saved against the same without a dictionary
   rank the wordings, and a wording of which a block saves less than ``LEAST_SAVED`` of
   what the wording saves on itself is out.
3. The others are confirmed by wording: the block's words are aligned with the wording's,
   and the words missing, added or changed are counted. Words that make one license
   differ from another (names, numbers, versions) must all be there.
4. Of confirmed notices that overlap the one that saves the most bytes stays; ties go to
   the one with fewer differing words, then to the first name, then to the first place.

Results are one row per notice found: a document may hold several, and the title, the
grant and the conditions of one license are notices of their own. Null and empty texts
hold none; repeated rows give repeated rows; null ids are kept. Long texts are read
whole; other columns, whatever their names, are not looked at. An empty table gives an
empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalmill.llm.common import slices

#: Fixed wordings of short notices.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has dedicated all copyright to the public domain under CC0 1.0.",
    "Proprietary": "All rights reserved.",
}

_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
    "in the documentation and/or other materials provided with the distribution. "
)
_GNU = (
    "{0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1}General Public License "
    "as published by the Free Software Foundation, either version {2} of the License, or (at your option) any later version."
)
#: Fixed published wordings: titles, standard headers, grants and conditions.
PUBLISHED = {
    "MIT": (
        "MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions:",
    ),
    "ISC": (
        "ISC License",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "Apache-2.0": (
        "Apache License Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "GPL-2.0": ("GNU General Public License version 2", _GNU.format("This program", "", "2")),
    "GPL-3.0": ("GNU General Public License version 3", _GNU.format("This program", "", "3")),
    "LGPL-2.1": ("GNU Lesser General Public License version 2.1", _GNU.format("This library", "Lesser ", "2.1")),
    "LGPL-3.0": ("GNU Lesser General Public License version 3", _GNU.format("This library", "Lesser ", "3")),
    "AGPL-3.0": ("GNU Affero General Public License version 3", _GNU.format("This program", "Affero ", "3")),
    "BSD-2-Clause": ("BSD 2-Clause License", _BSD + "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS"),
    "BSD-3-Clause": (
        "BSD 3-Clause License",
        _BSD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission.",
    ),
    "MPL-2.0": (
        "Mozilla Public License Version 2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    "EPL-2.0": (
        "Eclipse Public License v 2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
        "which is available at https://www.eclipse.org/legal/epl-2.0/",
    ),
    "BSL-1.0": ("Boost Software License Version 1.0",),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
        "for any damages arising from the use of this software.",
    ),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "CC-BY-4.0": ("Creative Commons Attribution 4.0 International License",),
    "CC-BY-SA-4.0": ("Creative Commons Attribution-ShareAlike 4.0 International License",),
    "CC-BY-NC-4.0": ("Creative Commons Attribution-NonCommercial 4.0 International License",),
    "CC-BY-ND-4.0": ("Creative Commons Attribution-NoDerivatives 4.0 International License",),
    "CC-BY-NC-SA-4.0": ("Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License",),
    "CC-BY-NC-ND-4.0": ("Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License",),
    "CC0-1.0": ("CC0 1.0 Universal",),
}


def all_wordings() -> dict[str, tuple[str, ...]]:
    """License -> wordings: short notice, published texts and SPDX lines."""
    out = {}
    for name in sorted({*TEMPLATES, *PUBLISHED}):
        spdx = () if name == "Proprietary" else tuple(f"SPDX-License-Identifier: {name}{end}" for end in ("", "-only", "-or-later")[: 3 if "GPL" in name else 1])
        out[name] = (*([TEMPLATES[name]] if name in TEMPLATES else []), *PUBLISHED.get(name, ()), *spdx)
    return out


#: Least share of the bytes a wording saves on itself; the share of words that may differ stays below the other.
LEAST_SAVED = 0.25
MOST_DIFFERENT = 0.25
_FOUND = "doc_id long, license string, start long, length long, saved double, n_missing int, n_added int, differences array<string>, text string"
#: Words of any prose or any license, which tell nothing by themselves.
_ORDINARY = set(
    "a all and are author binary code dedicated extent following form forms from has in is law library met of or possible provided source subject terms that the this to under use with without work "
    "licence licenced license licensed released v version".split()
)
#: Words too frequent in prose to look for, where a wording has others.
_FREQUENT = set(
    "accompanying any appear associated at by charge conditions copy distributed distribution documentation file foundation free general holders holder if international into later "
    "list made materials met modification modify name names not notice one other permission permitted person products program promote public purpose reproduce restriction retain rights "
    "sell shall software source specific use".split()
)
#: Wordings up to this length need all words that are not ordinary.
_SHORT = 24
_WORD = re.compile(r"[^\W_]+(?:[-.][^\W_]+)*")
_LINE = re.compile(r"\s*\n[\s*/#;>%-]*|\s+")


def wording(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def folded(text: str) -> bytes:
    """The text in lower case on one line, without comment marks at the beginnings of lines."""
    return _LINE.sub(" ", text).lower().encode()


class _Wording:
    """One wording of a license, ready to be compared with blocks."""

    def __init__(self, name: str, text: str):
        self.name, self.text = name, text
        self.places = [(m[0].lower(), m.start(), len(text) - m.end()) for m in _WORD.finditer(text)]
        self.words = [w for w, _, _ in self.places]
        raw = folded(text)
        data = zstandard.ZstdCompressionDict(raw * max(1, -(-64 // len(raw))), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.packer = zstandard.ZstdCompressor(level=3, write_content_size=False, write_checksum=False, dict_data=data)
        self.marks: set[str] = set()
        self.keys: list[str] = []


class Scanner:
    def __init__(self, templates: dict[str, str | tuple[str, ...]]):
        self.plain = zstandard.ZstdCompressor(level=3, write_content_size=False, write_checksum=False)
        self.wordings = [_Wording(n, t) for n in sorted(templates) for t in ([templates[n]] if isinstance(templates[n], str) else templates[n])]
        holders = Counter(w for own in self.wordings for w in set(own.words))
        self.by_key: dict[str, list[tuple[_Wording, int, int]]] = {}
        for own in self.wordings:
            own.whole = self.saved(folded(own.text), own)
            words = set(own.words)
            own.marks = words - _ORDINARY if len(words) <= _SHORT else set()
            for other in self.wordings:
                apart = words - set(other.words)
                if other.name != own.name and len(apart) <= MOST_DIFFERENT * len(own.words):
                    own.marks |= apart - _ORDINARY
            named = [w for w in words if re.search(r"[^\W\d_]", w) and w not in _ORDINARY] or list(words)
            rare = [w for w in named if w not in _FREQUENT] or named
            own.keys = sorted(rare, key=lambda w: (holders[w], -len(w), w))[:2]
            for word, before, after in own.places:
                if word in own.keys:
                    self.by_key.setdefault(word, []).append((own, before, after))
        keys = sorted(map(re.escape, self.by_key), key=lambda k: (-len(k), k))
        self.key = re.compile(r"(?<![^\W_])(?:%s)(?![^\W_])" % "|".join(keys), re.I)

    def saved(self, block: bytes, own: _Wording) -> int:
        return len(self.plain.compress(block)) - len(own.packer.compress(block))

    def confirm(self, block: str, own: _Wording) -> tuple | None:
        """(start, length, missing, added, differences) of the wording within the block."""
        want, marks = own.words, list(_WORD.finditer(block))
        have = [m[0].lower() for m in marks]
        if not own.marks <= set(have):
            return None
        pairs = [b for b in SequenceMatcher(None, want, have, autojunk=False).get_matching_blocks() if b.size]
        if not pairs:
            return None
        # the densest stretch: leave out matches far from the largest one
        core = max(pairs, key=lambda b: (b.size, -b.b))
        pairs = [b for b in pairs if abs((b.b - core.b) - (b.a - core.a)) <= max(2, len(want) // 3)]
        first, last = pairs[0].b, pairs[-1].b + pairs[-1].size
        same = sum(b.size for b in pairs)
        missing, added = len(want) - same, (last - first) - same
        differing = max(missing, added)
        if (differing and differing >= MOST_DIFFERENT * len(want)) or not own.marks <= set(have[first:last]):
            return None
        held = [False] * len(want), [False] * len(have)
        for b in pairs:
            held[0][b.a : b.a + b.size] = [True] * b.size
            held[1][b.b : b.b + b.size] = [True] * b.size
        differences = ["-" + w for w, h in zip(want, held[0]) if not h] + ["+" + w for w, h in zip(have[first:last], held[1][first:last]) if not h]
        return marks[first].start(), marks[last - 1].end() - marks[first].start(), missing, added, differences

    def candidates(self, text: str) -> Iterator[tuple[_Wording, int, str]]:
        """(wording, start, block) around each key."""
        for m in self.key.finditer(text):
            for own, before, after in self.by_key[m[0].lower()]:
                start = max(0, m.start() - before - before // 4 - 24)
                yield own, start, text[start : m.end() + after + after // 4 + 24]

    def notices(self, text: str) -> Iterator[tuple]:
        """(license, start, length, saved, missing, added, differences, text) in the order of places."""
        found: dict[tuple, tuple] = {}
        for own, at, block in self.candidates(text):
            raw = folded(block)
            saved = self.saved(raw, own)
            if saved < LEAST_SAVED * own.whole:
                continue
            hit = self.confirm(block, own)
            if hit is not None:
                rank = (-saved, hit[2] + hit[3], own.name, at + hit[0])
                row = (own.name, at + hit[0], hit[1], saved / own.whole, *hit[2:])
                found.setdefault((rank, row[:3]), row)
        taken: list[tuple] = []
        for key in sorted(found):
            row = found[key]
            if all(row[1] + row[2] <= t[1] or t[1] + t[2] <= row[1] for t in taken):
                taken.append(row)
        for row in sorted(taken, key=lambda r: r[1]):
            yield *row, text[row[1] : row[1] + row[2]]


def find_notices(docs: DataFrame, templates: dict[str, str | tuple[str, ...]] | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per notice: license, place and length in characters, share of the wording's bytes saved, wording differences, and its text.

    ``templates``: license -> wording or wordings; by default all of ``all_wordings``.
    """
    templates = all_wordings() if templates is None else templates

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.list_(pa.string()), pa.string()]
        names = [c.split()[0] for c in _FOUND.split(", ")]
        for batch in slices(batches, "text"):
            rows = [(d, *f) for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()) for f in scanner.notices(t or "")]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")).mapInArrow(scan, _FOUND)
