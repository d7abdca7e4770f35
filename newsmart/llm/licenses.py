"""License scans by conditional compression.

Lines with a cue are cut to the stretches around their cues; each stretch is
compressed alone and with every notice template as zstandard raw dictionary.  A
template that shares wording with the stretch makes it smaller, so templates rank
by the bytes they save.  Those that save enough are confirmed by their words: the
name of the license must stand in the stretch word by word, and the notice's
other words may differ only so far.  Of the notices of one license the best stays,
and a name inside a longer one (GPL in LGPL) yields to it.

All of a text is searched, one row at a time, where it is read; nothing is
shuffled.  Null text holds no notice, repeated rows each report theirs, null ids
are kept, further columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher
from functools import lru_cache

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, functions as F

CUE = r"(?i)licen[sc]|copyright|spdx|creative[\W_]+commons|\bcc[\W_]+by|\bcc0\b|public[\W_]+domain|\b(?:[al]?gpl|mpl|epl)(?:v\d|\b)|permission[\W_]+is[\W_]+hereby[\W_]+granted|redistribution[\W_]+and[\W_]+use"
#: Characters kept around a cue.
AROUND = 400
#: Share of a stretch's own compressed size that a template must save, and bytes.
LEAST_SHARE, LEAST_BYTES = 0.15, 6
#: Share of a notice's words that may be missing.
MISSING = 0.5
#: Characters of a block after its cue, and of a window of a longer one; half of it holds the longest body.
AFTER, WINDOW = 2400, 4800
#: Words before and after a name that may belong to its notice.
BESIDE = (10, 3)
#: Words that a heading may hold besides the name.
HEADING = frozenset(
    "the a an license licence licenses version v software open source full text of terms and conditions january february "
    "march april may june july august september october november december".split()
)

# Names of licenses as notices write them; the first is the longest form.
NAMES = {
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"),
    "MIT": ("MIT License", "MIT Licence"),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License", "2-Clause BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "New BSD License", "3-Clause BSD License"),
    "ISC": ("ISC License",),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU General Public License v2", "GPLv2", "GPL 2.0"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU General Public License v3", "GPLv3", "GPL 3.0"),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1", "LGPLv2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3", "LGPLv3"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "GNU Affero General Public License v3", "AGPLv3"),
    "EPL-2.0": ("Eclipse Public License, version 2.0", "Eclipse Public License 2.0", "EPL 2.0"),
    "Unlicense": ("The Unlicense",),
    "CC0-1.0": ("CC0 1.0", "Creative Commons Zero 1.0"),
}
_CC = {"BY": "Attribution", "SA": "ShareAlike", "NC": "NonCommercial", "ND": "NoDerivatives"}
for _kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
    for _version in ("2.0", "2.5", "3.0", "4.0"):
        _long = "-".join(_CC[k] for k in _kind.split("-"))
        NAMES[f"CC-{_kind}-{_version}"] = (
            f"CC {_kind} {_version}",
            f"Creative Commons {_long} {_version}",
            f"CC-{_kind}-{_version}",
        )

#: Ways to say it; the name goes into the braces.
NOTICES = (
    "Licensed under the {}.",
    "Released under the {}.",
    "Distributed under the terms of the {}.",
    "This work is licensed under the {}.",
    "SPDX-License-Identifier: {}",
)

_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS {}BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
    "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. {}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR "
    "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, "
    "INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
    "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
    "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN "
    "ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_GNU = (
    "This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}General "
    "Public License as published by the Free Software Foundation, either version {version} of the License, or (at your "
    "option) any later version. This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
    "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind}General "
    "Public License for more details. You should have received a copy of the GNU {kind}General Public License along with "
    "this {what}. If not, see <https://www.gnu.org/licenses/>."
)

#: Texts of licenses and their standard headers, with words that must stand in them.
BODIES = {
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        + _WARRANTY.format("OR COPYRIGHT HOLDERS "),
        ("permission is hereby granted", "sublicense"),
    ),
    "BSD-2-Clause": (_BSD.format(""), ("redistributions of source code must retain",)),
    "BSD-3-Clause": (
        _BSD.format(
            "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
            "products derived from this software without specific prior written permission. "
        ),
        ("redistributions of source code must retain", "endorse or promote products"),
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        "PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, "
        "OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION "
        "OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
        "SOFTWARE.",
        ("permission to use copy modify", "with or without fee"),
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License.",
        ("apache", "2.0"),
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        ("mozilla public license", "2.0"),
    ),
    "GPL-2.0": (_GNU.format(what="program", kind="", version="2"), ("gnu general public license", "version 2")),
    "GPL-3.0": (_GNU.format(what="program", kind="", version="3"), ("gnu general public license", "version 3")),
    "LGPL-2.1": (_GNU.format(what="library", kind="Lesser ", version="2.1"), ("gnu lesser general public license", "version 2.1")),
    "LGPL-3.0": (_GNU.format(what="library", kind="Lesser ", version="3"), ("gnu lesser general public license", "version 3")),
    "AGPL-3.0": (_GNU.format(what="program", kind="Affero ", version="3"), ("gnu affero general public license", "version 3")),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
        "which is available at https://www.eclipse.org/legal/epl-2.0/",
        ("eclipse public license", "2.0"),
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors "
        "of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication "
        "for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to "
        "be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. "
        + _WARRANTY.format(""),
        ("unencumbered",),
    ),
    "CC0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        ("to the extent possible under law", "waived all copyright"),
    ),
}


@dataclass(frozen=True)
class Template:
    license: str
    name: str
    text: str


def templates() -> tuple[Template, ...]:
    """One template per license and form of its name, holding every notice."""
    return tuple(
        Template(license_, name, " ".join(n.format(name) for n in NOTICES))
        for license_, names in NAMES.items()
        for name in dict.fromkeys((*names, license_))
    )


def _compressor(data: bytes) -> zstandard.ZstdCompressor:
    raw = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=9, dict_data=raw, write_content_size=False, write_dict_id=False)


@lru_cache(maxsize=4)
def _compressors(listed: tuple[Template, ...]) -> tuple:
    plain = zstandard.ZstdCompressor(level=9, write_content_size=False)
    return plain, [(t, _compressor(t.text.encode())) for t in listed]


@lru_cache(maxsize=4)
def _named(listed: tuple[Template, ...]) -> dict[str, list[tuple]]:
    """(words of the name, template, compressor) by the name's first word, longest first."""
    out: dict[str, list[tuple]] = {}
    for template, compressor in _compressors(listed)[1]:
        name = _words(template.name)
        out.setdefault(name[0], []).append((name, template, compressor))
    return {k: sorted(v, key=lambda x: (-len(x[0]), x[1].name)) for k, v in out.items()}


@lru_cache(maxsize=1)
def _bodies() -> list[tuple]:
    """(license, words, required words, compressor) of every body."""
    return [(k, _words(t), [_words(n) for n in needs], _compressor(t.encode())) for k, (t, needs) in BODIES.items()]


_WORD = re.compile(r"[^\W_]+(?:\.\d+)*")


def _words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _inside(name: list[str], words: list[str]) -> int:
    """Where ``name`` stands in ``words``, or -1."""
    for i in range(len(words) - len(name) + 1):
        if words[i : i + len(name)] == name:
            return i
    return -1


def _differences(template: Template, words: list[str]) -> tuple[int, list[str], list[str]]:
    """Least number of words missing over the notices, with the wording differences."""
    best = None
    for notice in NOTICES:
        wanted = _words(notice.format(template.name))
        blocks = SequenceMatcher(None, wanted, words, autojunk=False).get_matching_blocks()
        held = {i for b in blocks for i in range(b.a, b.a + b.size)}
        low = min((b.b for b in blocks if b.size), default=0)
        high = max((b.b + b.size for b in blocks if b.size), default=0)
        used = {i for b in blocks for i in range(b.b, b.b + b.size)}
        missing = [w for i, w in enumerate(wanted) if i not in held]
        extra = [words[i] for i in range(low, high) if i not in used]
        rank = (len(missing) + len(extra), missing, extra, len(wanted))
        best = rank if best is None or rank[0] < best[0] else best
    return best[3], best[1], best[2]


def stretches(line: str) -> Iterator[tuple[int, str]]:
    """(start, text) around the cues of a line, cut at words."""
    spans: list[list[int]] = []
    for cue in re.finditer(CUE, line):
        low, high = max(0, cue.start() - AROUND), min(len(line), cue.end() + AROUND)
        if spans and low <= spans[-1][1]:
            spans[-1][1] = high
        else:
            spans.append([low, high])
    for low, high in spans:
        # A stretch of many cues is taken in overlapping windows, so its cost stays linear.
        for at in range(low, high, 2 * AROUND):
            yield at, line[at : min(high, at + 3 * AROUND)]
            if at + 3 * AROUND >= high:
                break


def _lines(text: str, listed: tuple[Template, ...]) -> Iterator[tuple]:
    """Notices that stand on one line: rows of ``scan``."""
    plain, coded = _compressors(listed)
    for number, line in enumerate(text.split("\n")):
        taken: dict[str, tuple] = {}
        for _, stretch in stretches(line):
            data, words = stretch.encode(), _words(stretch)
            size = len(plain.compress(data))
            ranked = []
            for template, compressor in coded:
                saved = size - len(compressor.compress(data))
                if saved >= LEAST_BYTES and saved >= LEAST_SHARE * min(size, 60):
                    ranked.append((saved, template))
            ranked.sort(key=lambda x: (-x[0], -len(x[1].name), x[1].name))
            done: set[str] = set()
            places: list[tuple[int, int]] = []
            for saved, template in ranked:
                name = _words(template.name)
                at = _inside(name, words)
                if at < 0 or template.license in done or any(a < at + len(name) and at < b for a, b in places):
                    continue
                n, missing, extra = _differences(template, words)
                if len(missing) > MISSING * n:
                    continue
                places.append((at, at + len(name)))
                done.add(template.license)
                row = (number, template.license, saved, saved / size, " ".join(missing), " ".join(extra))
                if template.license not in taken or saved > taken[template.license][2]:
                    taken[template.license] = row
        yield from taken.values()


class _Block:
    """A window of neighbouring lines, as words with their lines."""

    def __init__(self, text: str, low: int, high: int, starts: list[int]):
        found = list(_WORD.finditer(text, low, high))
        self.text = text
        self.words = [m[0].lower() for m in found]
        self.spans = [m.span() for m in found]
        self.lines = [bisect_right(starts, m.start()) - 1 for m in found]

    def joined(self, first: int, end: int) -> bytes:
        """The text of some words with white space joined, without the marks at the beginnings of lines."""
        part = self.text[self.spans[first][0] : self.spans[end - 1][1]]
        return " ".join(re.sub(r"\n[^\w\n]*", " ", part).split()).encode()

    def heading(self, first: int, end: int) -> bool:
        """Whether the lines of a name say nothing else, but for words of titles and dates."""
        low, high = bisect_left(self.lines, self.lines[first]), bisect_right(self.lines, self.lines[end - 1])
        name = set(self.words[first:end])
        rest = self.words[low:first] + self.words[end:high]
        return len(rest) <= 6 and all(w in HEADING or w in name or w.isdigit() for w in rest)


def _blocks(text: str) -> Iterator[_Block]:
    spans: list[list[int]] = []
    for cue in re.finditer(CUE, text):
        low, high = max(0, cue.start() - AROUND), min(len(text), cue.end() + AFTER)
        if spans and low <= spans[-1][1]:
            spans[-1][1] = high
        else:
            spans.append([low, high])
    starts = [0, *(m.end() for m in re.finditer("\n", text))]
    for low, high in spans:
        for at in range(low, high, WINDOW // 2):
            yield _Block(text, at, min(high, at + WINDOW), starts)
            if at + WINDOW >= high:
                break


def _names(block: _Block, listed: tuple[Template, ...]) -> Iterator[tuple]:
    """Rows of names that their line alone does not confirm."""
    plain, named = _compressors(listed)[0], _named(listed)
    words, i = block.words, 0
    while i < len(words):
        held = next((x for x in named.get(words[i], ()) if words[i : i + len(x[0])] == x[0]), None)
        if held is None:
            i += 1
            continue
        name, template, compressor = held
        end = i + len(name)
        low, high = max(0, i - BESIDE[0]), min(len(words), end + BESIDE[1])
        size = len(plain.compress(block.joined(low, high)))
        saved = size - len(compressor.compress(block.joined(low, high)))
        n, missing, extra = _differences(template, words[low:high])
        heading = block.heading(i, end)
        # A name of one word without a number is a word of prose as well.
        plain_word = len(name) == 1 and not re.search(r"\d", name[0])
        if plain_word:
            before = words[i - 1] if i else ""
            sure = heading and (before in ("license", "licence", "identifier") or name[0] == "unlicense")
        else:
            enough = saved >= LEAST_BYTES and saved >= LEAST_SHARE * min(size, 60)
            sure = heading or enough and len(missing) <= MISSING * n
        if sure:
            own = (0, [], []) if heading else (n, missing, extra)
            yield block.lines[i], template.license, saved, saved / size, " ".join(own[1]), " ".join(own[2])
        i = end


def _texts(block: _Block) -> Iterator[tuple]:
    """(differences, first and last character, row) of license bodies."""
    if not block.words:
        return
    plain, words = _compressors(())[0], block.words
    data = block.joined(0, len(words))
    size = len(plain.compress(data))
    for license_, wanted, needs, compressor in _bodies():
        if any(_inside(n, words) < 0 for n in needs):
            continue
        saved = size - len(compressor.compress(data))
        if saved < LEAST_BYTES:
            continue
        parts = [(0, len(words))]
        while parts:
            low, high = parts.pop()
            if high - low < (1 - MISSING) * len(wanted):
                continue
            matched = [m for m in SequenceMatcher(None, wanted, words[low:high], autojunk=False).get_matching_blocks() if m.size]
            # Strays far from the rest, single words of other sentences, are not part of the body.
            core = max(range(len(matched)), key=lambda k: matched[k].size) if matched else 0
            a = z = core
            while a and matched[a].b - matched[a - 1].b - matched[a - 1].size <= len(wanted) // 3:
                a -= 1
            while z + 1 < len(matched) and matched[z + 1].b - matched[z].b - matched[z].size <= len(wanted) // 3:
                z += 1
            matched = matched[a : z + 1]
            n = sum(m.size for m in matched)
            if n < (1 - MISSING) * len(wanted):
                continue
            first, end = low + matched[0].b, low + matched[-1].b + matched[-1].size
            parts += [(low, first), (end, high)]
            if n < (1 - MISSING) * (end - first) or any(_inside(x, words[first:end]) < 0 for x in needs):
                continue
            held = {i for m in matched for i in range(m.a, m.a + m.size)}
            used = {low + i for m in matched for i in range(m.b, m.b + m.size)}
            missing = [w for i, w in enumerate(wanted) if i not in held]
            extra = [words[i] for i in range(first, end) if i not in used]
            own = block.joined(first, end)
            whole = len(plain.compress(own))
            less = whole - len(compressor.compress(own))
            if less < LEAST_BYTES or less < LEAST_SHARE * whole:
                continue
            row = (block.lines[first], license_, less, less / whole, " ".join(missing), " ".join(extra))
            yield len(missing) + len(extra), block.spans[first][0], block.spans[end - 1][1], row


def scan(text: str, listed: tuple[Template, ...]) -> Iterator[tuple]:
    """(line, license, bytes saved, share saved, missing, extra), one per line and license."""
    taken = {row[:2]: row for row in _lines(text, listed)}
    bodies = []
    for block in _blocks(text):
        for row in _names(block, listed):
            taken.setdefault(row[:2], row)
        bodies += _texts(block)
    # Of bodies over the same words the one with the fewest differences stays.
    places: list[tuple[int, int]] = []
    for _, low, high, row in sorted(bodies, key=lambda x: (x[0], -x[3][2], x[3])):
        if not any(a < high and low < b for a, b in places):
            places.append((low, high))
            if row[:2] not in taken or row[2] > taken[row[:2]][2]:
                taken[row[:2]] = row
    yield from sorted(taken.values(), key=lambda r: r[0])


SCHEMA = "doc_id long, line long, license string, bytes_saved long, share_saved double, missing string, extra string"


def find(docs: DataFrame, listed: tuple[Template, ...] | None = None) -> DataFrame:
    """One row per license notice of ``docs`` (doc_id, text), with its wording differences."""
    listed = listed or templates()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (doc_id, *found)
                for doc_id, text in zip(pd.array(batch["doc_id"], dtype="Int64"), batch["text"], strict=True)
                for found in scan(text, listed)
            ]
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])
            out["doc_id"] = pd.array(out["doc_id"], dtype="Int64")
            yield out

    chosen = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return chosen.where(F.col("text").rlike(CUE)).mapInPandas(run, SCHEMA)
