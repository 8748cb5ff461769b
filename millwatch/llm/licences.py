"""Licence scan: templates ranked by conditional compression, confirmed by word differences.

Lines with words of licences, with small gaps, are candidate blocks. A block is compressed alone and with every template as
a raw dictionary; what a template saves is its rank. Templates are confirmed in this order: words are aligned with the
wording, and a place with few differences is a notice. What is confirmed is blanked out and the rest of the block ranked
again, until nothing more is confirmed. Places are looked for in the whole text, so a notice may go beyond its block, and at
last every template's places outside of all blocks are taken, so that no notice is lost. A notice with few differences has
some piece of its wording unchanged, and around such pieces the words are aligned, so each such place is found.
Blocks are the same over many documents, so a worker remembers their reductions.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch.llm.store import map_arrow, octets_of

#: Wordings of licence notices by SPDX identifier (several of one licence are numbered).
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0#header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "MIT": "Released under the MIT License.",
    "MIT#grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL#notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC0-1.0": "Released into the public domain under CC0 1.0.",
    "CC-BY#text": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "Proprietary": "All rights reserved.",
}
_TRIGGER = re.compile(r"licen[sc]|copyright|\(c\)|©|permission|warrant|spdx|redistribut|rights reserved|public domain|creative commons|free software|\bgpl\b|\bcc0?[ -]", re.I)
_WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")
#: Lines without a trigger that may lie between two of one block.
GAP = 2
#: Share of a template's words that must stand in the text in order, and words of it that may differ.
COVER, DIFFER = 0.9, 4
LEVEL = 3
#: Longer passages are compressed each time.
REMEMBERED = 4096


class Scanner:
    def __init__(self, templates: dict[str, str] = TEMPLATES) -> None:
        self.words = {k: _WORD.findall(v.lower()) for k, v in templates.items()}
        self.alone = zstandard.ZstdCompressor(level=LEVEL)
        self.given = {k: zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(v.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)) for k, v in templates.items()}
        self.memory: dict[tuple[str, str], float] = {}

    def reduction(self, passage: str, template: str) -> float:
        """Share of a passage's compressed size that the template saves."""
        return self.reductions(passage, [template])[0]

    def reductions(self, passage: str, templates: list[str]) -> list[float]:
        if len(self.memory) >= 50_000:
            self.memory.clear()
        data, alone = b"", 0
        out = []
        for template in templates:
            saved = self.memory.get((template, passage))
            if saved is None:
                data = data or passage.encode("utf-8", "replace")
                alone = alone or len(self.alone.compress(data))
                saved = round(1 - len(self.given[template].compress(data)) / alone, 4)
                if len(passage) <= REMEMBERED:
                    self.memory[template, passage] = saved
            out.append(saved)
        return out

    def differences(self, block: str, template: str) -> tuple[float, list[str]]:
        """Share of the template's words found in order, and what is removed (-) and put in between (+)."""
        mine, theirs = self.words[template], _WORD.findall(block.lower())
        match = SequenceMatcher(None, mine, theirs, autojunk=False)
        runs = [m for m in match.get_matching_blocks() if m.size]
        found = sum(m.size for m in runs)
        out = []
        if runs:
            first, last = runs[0], runs[-1]
            out += [f"-{w}" for w in mine[: first.a]]
            for x, y in zip(runs, runs[1:], strict=False):
                out += [f"-{w}" for w in mine[x.a + x.size : y.a]] + [f"+{w}" for w in theirs[x.b + x.size : y.b]]
            out += [f"-{w}" for w in mine[last.a + last.size :]]
        return (found / len(mine) if mine else 0.0), out

    def passages(self, words: list[str], blocks: list[tuple[int, int]]) -> list[tuple[str, float, list[int], list[str]]]:
        """(template, size reduction, numbers of the matched words, differences) of the confirmed notices in a text.

        ``blocks`` are ranges of words. Of notices that share words, that of the block's highest rank counts; a place whose words
        another template explains with fewer differences, or with as few among more words, is left to that one. Outside of blocks the fewest differences
        count, then the longest template, then the largest reduction.
        """
        line = f" {' '.join(words)} "
        places: dict[str, list[tuple[list[int], list[str]]]] = {}
        taken: set[int] = set()
        out = []

        def found(name: str) -> list[tuple[list[int], list[str]]]:
            if name not in places:
                places[name] = _occurrences(words, line, self.words[name])
            return places[name]

        def take(name: str, matched: list[int], off: list[str]) -> None:
            taken.update(matched)
            out.append((name, self.reduction(" ".join(words[matched[0] : matched[-1] + 1]), name), matched, off))

        def confirmed(name: str, low: int, high: int) -> bool:
            before = len(out)
            for matched, off in found(name):
                if matched[-1] >= low and matched[0] < high and taken.isdisjoint(matched) and not any(
                        (len(o), -len(m)) < (len(off), -len(matched)) and set(matched) <= set(m)
                        for other in self.words if other != name for m, o in found(other)):
                    take(name, matched, off)
            return len(out) > before

        for low, high in blocks:
            untried = list(self.words)
            while untried and (rest := " ".join(words[k] for k in range(low, high) if k not in taken)):
                saved = dict(zip(untried, self.reductions(rest, untried), strict=True))
                ranked = sorted(untried, key=lambda n: (-saved[n], n))  # noqa: B023
                # what was not confirmed has no place in this block, and has none when more is blanked out
                first = next((i for i, n in enumerate(ranked) if confirmed(n, low, high)), len(ranked))
                untried = ranked[first + 1 :]
        others = [(len(off), -len(mine), name, matched, off) for name, mine in self.words.items()
                  for matched, off in found(name) if taken.isdisjoint(matched)]
        ranked = [(n, size, -self.reduction(" ".join(words[m[0] : m[-1] + 1]), name), name, m, off) for n, size, name, m, off in others]
        for *_, name, matched, off in sorted(ranked):
            if taken.isdisjoint(matched):
                take(name, matched, off)
        return out

    def scan(self, text: str) -> tuple[int, list[tuple[int, int, str, float, list[str]]]]:
        """Number of candidate blocks, and (first line, end line, template, reduction, differences) of confirmed notices.

        Notices are looked for in the whole text, however its lines are broken.
        """
        lines: list[list[int]] = []  # first and last line of each block
        if _TRIGGER.search(text):
            for i, line in enumerate(text.split("\n")):
                if _TRIGGER.search(line):
                    if lines and i - lines[-1][1] <= GAP + 1:
                        lines[-1][1] = i
                    else:
                        lines.append([i, i])
        n_blocks = len(lines)
        low = text.lower()
        words, blocks = _WORD.findall(low), []
        if lines:
            starts = [m.start() for m in _WORD.finditer(low)]
            breaks = [0, *[k + 1 for k, c in enumerate(low) if c == "\n"], len(low) + 1]
            blocks = [(bisect_left(starts, breaks[a]), bisect_left(starts, breaks[b + 1])) for a, b in lines]
        found = self.passages(words, blocks)
        if not found:
            return n_blocks, []
        at = [m.start() for m in _WORD.finditer(low)]
        ends = np.array([k for k, c in enumerate(low) if c == "\n"], np.int64)
        line_of = lambda k: int(np.searchsorted(ends, at[k]))
        return n_blocks, sorted((line_of(m[0]), line_of(m[-1]) + 1, name, saved, off) for name, saved, m, off in found)


def _finds(line: str, piece: list[str]) -> list[int]:
    """Numbers of the words at which `piece` starts in `line` (words with a space before and after each)."""
    asked, out, at, k, seen = f" {' '.join(piece)} ", [], -1, 0, 0
    while (at := line.find(asked, at + 1)) >= 0:
        k += line.count(" ", seen, at)
        seen = at
        out.append(k)
    return out


def _allowed(n: int) -> tuple[int, int]:
    """Differences, and missing words among them, that a notice of `n` words may have."""
    differ = DIFFER if n > 12 else 0
    return differ, min(differ, max(k for k in range(n + 1) if (n - k) / n >= COVER))


def _occurrences(words: list[str], line: str, mine: list[str]) -> list[tuple[list[int], list[str]]]:
    """(numbers of the matched words, differences) of the places of a template, none sharing a word with another."""
    differ, missing = _allowed(len(mine))
    out: list[tuple[list[int], list[str]]] = []
    n, reach = len(mine), 0
    for k in _finds(line, mine):
        if k >= reach:
            out.append((list(range(k, k + n)), []))
            reach = k + n
    if not differ:
        return out
    # each difference is within at most one of differ + 1 pieces, so one of them stands there unchanged
    cuts = [n * k // (differ + 1) for k in range(differ + 2)]
    starts = sorted({k - a for a, b in zip(cuts, cuts[1:], strict=False) for k in _finds(line, mine[a:b])} - {m[0] for m, _ in out})
    taken = {k for m, _ in out for k in m}
    windows: list[list[int]] = []
    for k in starts:
        a, b = max(0, k - differ), min(len(words), k + n + differ)
        if windows and a <= windows[-1][1]:
            windows[-1][1] = max(b, windows[-1][1])
        else:
            windows.append([a, b])
    for a, b in windows:
        part = ["" if k in taken else words[k] for k in range(a, b)]
        ends = []
        for j, costs in enumerate(_costs(part, mine, missing)):
            least = int((costs[n] + np.arange(missing + 1)).min())
            if least <= differ:
                ends.append((least, j))
        for _, j in sorted(ends):
            low = max(0, j - n - differ)
            matched, off = _trace(part[low:j], mine, missing)
            numbers = [a + low + k for k in matched]
            if len(off) <= differ and taken.isdisjoint(numbers):
                taken.update(numbers)
                out.append((numbers, off))
    return out


FAR = 100


def _costs(part: list[str], mine: list[str], missing: int) -> Iterator[np.ndarray]:
    """For each number of words read of `part`: [i, d] is the least number of words put in between, if the first i words
    of the template, d of them missing, end here (FAR and more: not at all). A place may start at any word."""
    n = len(mine)
    same = {w: np.array([w == x for x in mine]) for w in set(mine)}
    none = np.zeros(n, bool)
    now = np.full((n + 1, missing + 1), FAR, np.int64)
    now[0, 0] = 0
    for word in [None, *part]:
        if word is not None:
            step = np.minimum(now + 1, FAR)
            step[n] = FAR  # nothing is put in after the last word
            step[0, 0] = 0
            hit = same.get(word, none)
            step[1:][hit] = np.minimum(step[1:][hit], now[:-1][hit])
            now = step
        for d in range(1, missing + 1):
            now[1:, d] = np.minimum(now[1:, d], now[:-1, d - 1])
        yield now.copy()


def _trace(part: list[str], mine: list[str], missing: int) -> tuple[list[int], list[str]]:
    """Numbers of the matched words, and differences, of the best place that ends with `part`."""
    table = list(_costs(part, mine, missing))
    j, i = len(part), len(mine)
    d = int((table[j][i] + np.arange(missing + 1)).argmin())
    if table[j][i, d] >= FAR:
        return [], ["?"] * FAR
    matched, off = [], []
    while i:
        cost = table[j][i, d]
        if j and part[j - 1] == mine[i - 1] and table[j - 1][i - 1, d] == cost:
            i, j = i - 1, j - 1
            matched.append(j)
        elif j and i < len(mine) and table[j - 1][i, d] + 1 == cost:
            j -= 1
            off.append(f"+{part[j]}")
        else:
            i, d = i - 1, d - 1
            off.append(f"-{mine[i]}")
    return matched[::-1], off[::-1]


_SCANNER: list[Scanner] = []
FOUND = "n_blocks long, found array<struct<start:int,end:int,template:string,reduction:double,differences:array<string>>>"


def _scan(batch: pa.RecordBatch) -> dict:
    if not _SCANNER:
        _SCANNER.append(Scanner())
    out = [_SCANNER[0].scan(t.decode("utf-8", "replace")) for t in octets_of(batch)]
    return {
        "row": batch.column("row"), "n_blocks": [n for n, _ in out],
        "found": [[{"start": a, "end": b, "template": t, "reduction": r, "differences": d} for a, b, t, r, d in f] for _, f in out],
    }


def scan_licences(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """`row` (columns `keep` of `docs`), n_blocks and the confirmed notices found in each whole text.

    Null and empty texts have none. No rows move.
    """
    names = docs.columns if keep is None else keep
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("text").cast("binary").alias("text"))
    return map_arrow(rows, _scan, f"row {rows.schema['row'].dataType.simpleString()}, {FOUND}", rows=1024)


def licence_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_blocks, licences (sorted SPDX identifiers, comma-joined), n_differences (of all confirmed notices)."""
    out = scan_licences(docs, ["doc_id"])
    names = F.array_sort(F.array_distinct(F.transform("found", lambda f: F.substring_index(f["template"], "#", 1))))
    off = F.aggregate("found", F.lit(0), lambda n, f: n + F.size(f["differences"]))
    return out.select("row.doc_id", "n_blocks", F.array_join(names, ",").alias("licences"), off.cast("long").alias("n_differences"))
