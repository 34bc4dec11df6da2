"""License scan by conditional compression.

A text is cut into blocks (paragraphs at blank lines, and single lines); blocks
that hold a license word are candidates.  Every candidate is compressed with
zstandard alone and with each template as a raw-content dictionary; the size
reduction ranks the templates.  The winner is confirmed by its exact wording:
words are compared one by one (matching runs of words), the words of
the block that the template lacks and the template words that the matched
stretch lacks are counted, and the match holds when both are few and every
word that tells the license (name, number, or key phrase) is there, and no word
that names another license stands in the stretch.

An ``SPDX-License-Identifier`` line states its license by itself: its expression
(ids with AND, OR, WITH and parentheses) is parsed, and every id on the list of
known ones is a match of variant -1; an unknown id, or a line that is no
expression, is none.

A block that is not confirmed as a whole is tried by its sentences.  Then
neighbouring paragraphs are tried together, up to ``WINDOW_WORDS`` words from
every paragraph with a license word on, so that a notice in its usual layout,
with blank lines, is found.  A candidate that recurs in a task is scored once.  Null and empty texts
have no blocks, equal blocks of a text are reported each with its place, ties
of the size reduction go to the exact wording and then to the template's name,
an empty table gives an empty result.  Extra columns are ignored.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEVEL = 3
MIN_REDUCTION = 0.35       # share of the stand-alone size that the dictionary must save
MAX_DIFFERENCE = 0.15      # wording differences by words of the matched stretch

# --- fixed values: public license texts and customary notices ------------------
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software. THE "
        "SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS "
        "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License."],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
        "details."],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
        "details."],
    "LGPL-2.1": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) "
        "any later version."],
    "LGPL-3.0": [
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public "
        "License for more details."],
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public "
        "License for more details."],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission."],
    "BSD-2-Clause": [
        "Licensed under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
        "PURPOSE ARE DISCLAIMED."],
    "Zlib": [
        "Licensed under the zlib License.",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote "
        "the original software. If you use this software in a product, an acknowledgment in the product documentation would "
        "be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be "
        "misrepresented as being the original software. 3. This notice may not be removed or altered from any source "
        "distribution."],
    "EPL-2.0": [
        "Licensed under the Eclipse Public License 2.0.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v. 2.0 "
        "which is available at http://www.eclipse.org/legal/epl-2.0."],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0."],
    "ISC": [
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.",
                  "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.",
                     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."],
    "CC-BY-3.0": ["Licensed under CC BY 3.0.",
                  "This work is licensed under a Creative Commons Attribution 3.0 Unported License."],
    "CC-BY-SA-3.0": ["Licensed under CC BY-SA 3.0.",
                     "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License."],
    "CC0-1.0": ["Released under CC0 1.0 Universal, dedicated to the public domain."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}
#: a block without any of these words is no candidate
HINTS = ("licen", "permission", "redistribut", "copyright", "warrant", "public domain", "spdx", "creative commons")
#: words that any license has; all other short-notice words tell one license from another
COMMON = {"licensed", "released", "under", "the", "license", "licence", "this", "work", "is", "a", "project", "terms", "of",
          "library", "version", "public", "general", "international", "v", "to", "dedicated", "domain", "universal"}
#: words that name a license: none of another one's may stand in a confirmed stretch
NAMES = {"affero", "apache", "attribution-noncommercial", "attribution-noderivatives", "attribution-sharealike", "boost", "bsd",
         "by-nc", "by-nd", "by-sa", "cc0", "eclipse", "epl", "isc", "lesser", "lgpl", "mit", "mozilla", "mpl", "zlib"}
#: SPDX ids that are known, beside those of the templates
SPDX_IDS = {"0BSD", "AFL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-1.1", "APSL-2.0", "Artistic-1.0", "Artistic-2.0",
            "BlueOak-1.0.0", "BSD-1-Clause", "BSD-3-Clause-Clear", "BSD-4-Clause", "CC-BY-1.0", "CC-BY-2.0", "CC-BY-2.5",
            "CC-BY-NC-3.0", "CC-BY-NC-ND-4.0", "CC-BY-NC-SA-4.0", "CC-BY-ND-3.0", "CDDL-1.0", "CDDL-1.1", "CECILL-2.1", "CPL-1.0",
            "ECL-2.0", "EFL-2.0", "EPL-1.0", "EUPL-1.1", "EUPL-1.2", "FTL", "GFDL-1.3", "GFDL-1.3-only", "GFDL-1.3-or-later",
            "GPL-1.0", "GPL-1.0-only", "GPL-1.0-or-later", "GPL-2.0+", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0+",
            "GPL-3.0-only", "GPL-3.0-or-later", "HPND", "IJG", "IPL-1.0", "LGPL-2.0", "LGPL-2.0-only", "LGPL-2.0-or-later",
            "LGPL-2.1+", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0+", "LGPL-3.0-only", "LGPL-3.0-or-later", "LPPL-1.3c",
            "MIT-0", "MPL-1.0", "MPL-1.1", "MS-PL", "MS-RL", "NCSA", "ODbL-1.0", "OFL-1.1", "OpenSSL", "OSL-3.0", "PHP-3.01",
            "PostgreSQL", "PSF-2.0", "Python-2.0", "Ruby", "SISSL", "TCL", "UPL-1.0", "Vim", "W3C", "WTFPL", "X11", "ZPL-2.1"}
# -------------------------------------------------------------------------------

#: words of paragraphs that are tried together: the longest template and as many again
WINDOW_WORDS = 2 * max(len(t.split()) for own in TEMPLATES.values() for t in own)

_WORD = re.compile(r"[0-9a-z]+(?:[.\-][0-9a-z]+)*", re.I)
_HINT = re.compile("|".join(map(re.escape, HINTS)), re.I)
_SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+\-() \t]*)")
_SPDX_PART = re.compile(r"[()]|[A-Za-z0-9.+\-]+")
_FORMAT = zstd.FORMAT_ZSTD1_MAGICLESS if hasattr(zstd, "FORMAT_ZSTD1_MAGICLESS") else zstd.FORMAT_ZSTD1


def words(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def blocks(text: str | None) -> list[tuple[int, int]]:
    """(start, end) of the candidate blocks: paragraphs with a license word, cut to the lines that hold one if short."""
    out = []
    if not text or not _HINT.search(text):
        return out
    at = 0
    for para in re.split(r"(\n[ \t\r]*\n)", text):
        if para.strip() and _HINT.search(para):
            lines, pos = [], at
            for line in para.split("\n"):
                lines.append((pos, pos + len(line), bool(_HINT.search(line))))
                pos += len(line) + 1
            hits = [k for k, x in enumerate(lines) if x[2]]
            # a run of hinted lines, with up to two lines between them, is one block
            run = [hits[0], hits[0]]
            for k in hits[1:] + [10 ** 9]:
                if k - run[1] <= 3:
                    run[1] = k
                else:
                    out.append((lines[run[0]][0], lines[run[1]][1]))
                    run = [k, k]
        at += len(para)
    return out


class Compressor:
    """Compressed sizes alone and under each template as raw dictionary."""

    def __init__(self, templates: dict[str, list[str]], level: int = LEVEL):
        params = zstd.ZstdCompressionParameters.from_level(
            level, format=_FORMAT, write_content_size=False, write_checksum=False, write_dict_id=False)
        self.alone = zstd.ZstdCompressor(compression_params=params)
        self.with_template = []
        for name in sorted(templates):
            for k, text in enumerate(templates[name]):
                raw = " ".join(words(text)).encode()
                # a raw dictionary needs eight bytes
                d = zstd.ZstdCompressionDict(raw.rjust(8), dict_type=zstd.DICT_TYPE_RAWCONTENT)
                self.with_template.append((name, k, words(text), zstd.ZstdCompressor(dict_data=d, compression_params=params)))
        self.telling = {(name, k): self._telling(name, w) for name, k, w, _ in self.with_template}
        self.foreign = {name: NAMES - {w for n, _, ws, _ in self.with_template if n == name for w in ws} for name in templates}

    def _telling(self, name: str, own: list[str]) -> set[str]:
        """Words of a template that no other license's templates have, and its version numbers."""
        if len(own) <= 20:
            return {w for w in own if w not in COMMON}
        others = {w for n, _, ws, _ in self.with_template if n != name for w in ws}
        return (set(own) - others) | {b for a, b in zip(own, own[1:]) if a in ("version", "v") and b[0].isdigit()}

    def ranked(self, block: str) -> list[tuple[float, str, int, list[str]]]:
        """(size reduction, template, variant, template words), best first."""
        raw = " ".join(words(block)).encode()
        if not raw:
            return []
        alone = len(self.alone.compress(raw))
        out = [(1 - len(c.compress(raw)) / alone, name, k, w) for name, k, w, c in self.with_template]
        return sorted(out, key=lambda x: (-x[0], x[1], x[2]))


def wording(block: list[str], template: list[str]) -> tuple[int, int, int, int]:
    """(first word, end word, words added in that stretch, template words missing) of the best aligned stretch."""
    m = [x for x in SequenceMatcher(None, block, template, autojunk=False).get_matching_blocks() if x.size]
    if not m:
        return 0, 0, 0, len(template)
    first, end = m[0].a, m[-1].a + m[-1].size
    common = sum(x.size for x in m)
    whole = first, end, end - first - common, len(template) - common
    # scattered words: the run of matches with most words in common over words between them
    best, score, run = (0, 0, 0, 0), 0, m[0].a
    for k, x in enumerate(m):
        between = x.a - (m[k - 1].a + m[k - 1].size) if k else 0
        if score <= between:
            score, run, common = 0, x.a, 0
        else:
            score -= between
        score, common = score + x.size, common + x.size if run != x.a else x.size
        best = max(best, (score, common, run, x.a + x.size), key=lambda b: b[0])
    _, common, first, end = best
    dense = first, end, end - first - common, len(template) - common
    return min(whole, dense, key=lambda w: w[2] + w[3])


@lru_cache(maxsize=4)
def _compressor(level: int) -> Compressor:
    return Compressor(TEMPLATES, level)


def classify(block: str, level: int = LEVEL, min_reduction: float = MIN_REDUCTION,
             max_difference: float = MAX_DIFFERENCE) -> dict | None:
    """The license that a block's wording confirms, with the stretch that states it, or None."""
    places = [m.span() for m in _WORD.finditer(block)]
    own, best = [block[a:b].lower() for a, b in places], None
    tool = _compressor(level)
    ranked = [r for r in tool.ranked(block) if r[0] >= min_reduction]
    for reduction, name, variant, template in ranked:
        first, end, added, missing = wording(own, template)
        telling = tool.telling[name, variant]
        lost = len(telling - set(own[first:end]))
        if tool.foreign[name] & set(own[first:end]):
            continue
        if added + missing <= max_difference * len(template) and lost <= (max_difference * len(telling) if len(telling) > 6 else 0):
            found = ((added + missing, -reduction, name, variant),
                     {"start": places[first][0], "end": places[end - 1][1], "license": name, "variant": variant, "reduction": float(reduction), "added": added, "missing": missing})
            best = min(best, found, key=lambda x: x[0]) if best else found
    return best[1] if best else None


def spdx(text: str) -> list[dict]:
    """The known ids of the text's SPDX lines, each with its place, where the line is an expression."""
    out = []
    for m in _SPDX.finditer(text):
        parts = [(p.group(), m.start(1) + p.start(), m.start(1) + p.end()) for p in _SPDX_PART.finditer(m.group(1))]
        ids, depth, want_id, exception = [], 0, True, False
        for part, a, b in parts:
            if part in "()":
                if (part == "(") != want_id or exception:
                    break
                depth += 1 if part == "(" else -1
                if depth < 0:
                    break
            elif part.upper() in ("AND", "OR", "WITH"):
                if want_id:
                    ids = []
                    break
                want_id, exception = True, part.upper() == "WITH"
            elif not want_id:
                break                               # the expression ends where two ids meet
            else:
                if not exception:
                    ids.append((part, a, b))
                want_id, exception = False, False
        if depth > 0 or want_id:
            continue
        out += [{"start": a, "end": b, "license": _KNOWN[i.lower()], "variant": -1, "reduction": 1.0, "added": 0, "missing": 0}
                for i, a, b in ids if i.lower() in _KNOWN]
    return out


_KNOWN = {i.lower(): i for i in SPDX_IDS | set(TEMPLATES)}
_SENTENCE = re.compile(r"(?<=[.!?;:])\s+")


def sentences(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """(start, end) of the sentences with a license word in a block, and of the runs that they form."""
    cuts = [start] + [m.end() for m in _SENTENCE.finditer(text, start, end)] + [end]
    spans = [(a, b) for a, b in zip(cuts, cuts[1:]) if b > a]
    hits = [k for k, (a, b) in enumerate(spans) if _HINT.search(text, a, b)]
    out, run = [], []
    for k in hits + [10 ** 9]:
        if run and k - run[-1] > 3:
            if len(run) > 1:
                out.append((spans[run[0]][0], spans[run[-1]][1]))
            out += [spans[i] for i in run]
            run = []
        run.append(k)
    return out


def windows(text: str, start: int, end: int) -> Iterator[list[tuple[int, int]]]:
    """For every paragraph with a license word: the (start, end) of the longest stretches of whole paragraphs from it on of at
    most ``WINDOW_WORDS`` words, half of them, and so on down to the paragraph alone (however long)."""
    paras, at = [], start
    for m in [*re.finditer(r"\n[ \t\r]*(?:\n[ \t\r]*)+", text[start:end]), None]:
        to = start + m.start() if m else end
        if text[at:to].strip():
            paras.append((at, to, len(_WORD.findall(text, at, to)), bool(_HINT.search(text, at, to))))
        at = start + m.end() if m else end
    for i, (a, b, n, hint) in enumerate(paras):
        if hint:
            reach = [(n, b)]
            for _, to, more, _ in paras[i + 1:]:
                n += more
                if n > WINDOW_WORDS:
                    break
                reach.append((n, to))
            most, out = WINDOW_WORDS, []
            while reach[0][0] < most:
                out.append((a, max(to for n, to in reach if n <= most)))
                most //= 2
            yield list(dict.fromkeys([*out, (a, b)]))


def find(text: str | None, judge) -> tuple[int, list[dict]]:
    """(number of candidates, confirmed matches) of a text; a block that is not confirmed as a whole is tried by
    runs of sentences, then by single sentences, so that a notice inside a long line is found."""
    n, found, stated = 0, [], spdx(text) if text and "SPDX" in text else []
    if stated:                                              # their lines are read; all other places stay
        n += len(stated)
        text = _SPDX.sub(lambda m: " " * len(m.group()), text)

    def take(s: int, own: dict) -> tuple[int, int]:
        found.append({**own, "start": s + own["start"], "end": s + own["end"]})
        return found[-1]["start"], found[-1]["end"]

    todo = blocks(text)
    while todo:
        s, e = todo.pop()
        n += 1
        whole = judge(text[s:e])
        if whole:
            a, b = take(s, whole)               # what is left on both sides may state another license
            todo += [(x, y) for x, y in ((s, a), (b, e)) if _HINT.search(text, x, y)]
            continue
        taken: list[tuple[int, int]] = []
        for a, b in sentences(text, s, e):
            if (a, b) != (s, e) and all(b <= x or a >= y for x, y in taken):
                n += 1
                own = judge(text[a:b])
                if own:
                    taken.append((a, b))
                    take(a, own)
    # what no block confirmed, by whole paragraphs together
    edges = [0, *(x for m in sorted(found, key=lambda m: m["start"]) for x in (m["start"], m["end"])), len(text or "")]
    tried = set()
    for s, e in zip(edges[0::2], edges[1::2]):
        if e <= s or not _HINT.search(text, s, e):
            continue
        done = s
        for spans in windows(text, s, e):
            for a, b in spans:
                if a < done or (a, b) in tried:
                    continue
                tried.add((a, b))
                n += 1
                own = judge(text[a:b])
                if own:
                    done = take(a, own)[1]
                    # the short form that a long notice began with was taken for itself: both are one notice
                    head = [m for m in found if m["end"] == s and m["license"] == own["license"]]
                    if head and not _WORD.search(text, s, found[-1]["start"]):
                        both = judge(text[head[0]["start"]:b])
                        if both and both["start"] == 0 and both["license"] == own["license"] \
                                and head[0]["start"] + both["end"] >= done:
                            found.remove(head[0])
                            found.pop()
                            done = take(head[0]["start"], both)[1]
                    break
    return n, sorted(found + stated, key=lambda m: m["start"])


def _scan(level: int, min_reduction: float, max_difference: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("license", pa.string()), ("variant", pa.int32()),
                                   ("reduction", pa.float64()), ("added", pa.int32()), ("missing", pa.int32())]))
        known: dict[str, dict | None] = {}

        def judge(block: str) -> dict | None:
            if block not in known:
                if len(known) > 20_000:
                    known.clear()
                known[block] = classify(block, level, min_reduction, max_difference)
            return known[block]

        for b in batches:
            rows, candidates = [], []
            for t in b.column(1):
                n, found = find(t.as_py(), judge)
                rows.append(found)
                candidates.append(n)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(candidates, pa.int32()), pa.array(rows, kind)],
                                             names=["doc_id", "n_candidates", "matches"])
    return run


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", level: int = LEVEL,
         min_reduction: float = MIN_REDUCTION, max_difference: float = MAX_DIFFERENCE) -> DataFrame:
    """(doc_id, n_candidates, matches) of every document; a match has its character span, license, size
    reduction and wording differences (words added, words missing)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_scan(level, min_reduction, max_difference),
                           "doc_id long, n_candidates int, matches array<struct<start int, end int, license string, "
                           "variant int, reduction double, added int, missing int>>")
