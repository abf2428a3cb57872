"""License scans: runs of words compared with licence notices by the Dice coefficient of their word pairs."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator, Mapping
from math import ceil, floor

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import fresh, lean, sized_batches

THRESHOLD = 0.8
# Short notices of common licences, by their SPDX names; a name may have several texts.
NOTICES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    "LGPL-2.1": (
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    "LGPL-3.0": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission.",
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
}
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
Pair = tuple[bytes, bytes]


def words_of(text: str) -> list[bytes]:
    """Normalised words: A-Z lower-cased; letters, digits and anything beyond ASCII; the rest parts words."""
    return _WORD.findall(text.encode().lower())


def dice(a: set[Pair], b: set[Pair]) -> float:
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0.0


class Scanner:
    """Finds, in one text, the best run of words or lines for every notice."""

    def __init__(self, notices: Mapping[str, tuple[str, ...]] = NOTICES, threshold: float = THRESHOLD):
        self.threshold = threshold
        self.templates: list[tuple[str, set[Pair]]] = []
        # Word pairs that a run of words has at most, repeated ones counted each.
        self.longest: list[int] = []
        for name, texts in notices.items():
            for text in texts:
                words = words_of(text)
                if len(words) > 1:
                    self.templates.append((name, set(zip(words, words[1:]))))
                    self.longest.append(floor((len(words) - 1) * (2 - threshold) / threshold + 1e-9))
        self.index: dict[Pair, list[int]] = {}
        for number, (_, pairs) in enumerate(self.templates):
            for pair in pairs:
                self.index.setdefault(pair, []).append(number)
        # Size bounds: a set of pairs can reach the threshold only if its size lies between these,
        # and a text only if it holds at least `fewest` of the template's pairs.
        sizes = [len(pairs) for _, pairs in self.templates]
        self.low = [ceil(n * threshold / (2 - threshold) - 1e-9) for n in sizes]
        self.high = [floor(n * (2 - threshold) / threshold + 1e-9) for n in sizes]
        self.fewest = self.low

    def scan(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """(name, coefficient, first line, last line), best run for each licence, sorted by name.

        Runs are consecutive lines taken whole. Of equal coefficients the earliest and shortest run
        counts. Lines are numbered from 0.
        """
        wanted = self._wanted(words_of(text) if text else [])
        if not wanted:
            return []
        lines = [words_of(line) for line in text.split("\n")]
        best: dict[str, tuple[float, int, int]] = {}
        for number in wanted:
            name, template = self.templates[number]
            for found in self._runs(lines, template, self.low[number], self.high[number]):
                if name not in best or (-found[0], found[1], found[2]) < (-best[name][0], best[name][1], best[name][2]):
                    best[name] = found
        return [(name, *best[name]) for name in sorted(best)]

    def find(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """(name, coefficient, first line, last line) as from `scan`, of runs of words whatever else their lines hold.

        A run of words begins and ends with a pair of the template, since any other border only adds
        to its size, and may span lines, blank ones too. Whole lines are compared as well. Of runs that
        share a word only the one with the highest coefficient counts, of equal ones the first name.
        """
        words = words_of(text) if text else []
        wanted = self._wanted(words)
        if not wanted:
            return []
        line_of = [number for number, line in enumerate(text.split("\n")) for _ in words_of(line)]
        pairs = list(zip(words, words[1:]))
        found = [(-value, name, bisect_right(line_of, first - 1), bisect_right(line_of, last) - 1) for name, value, first, last in self.scan(text)]
        for number in wanted:
            found += [(-value, self.templates[number][0], first, last) for value, first, last in self._windows(pairs, number)]
        return self._chosen(found, line_of)

    def _chosen(self, found: list[tuple[float, str, int, int]], line_of: list[int]) -> list[tuple[str, float, int, int]]:
        best: dict[str, tuple[str, float, int, int]] = {}
        taken = bytearray(len(line_of))
        for value, name, first, last in sorted(found):
            if taken.find(1, first, last + 1) < 0:
                taken[first:last + 1] = b"\x01" * (last + 1 - first)
                best.setdefault(name, (name, -value, line_of[first], line_of[last]))
        return [best[name] for name in sorted(best)]

    def _wanted(self, words: list[bytes]) -> list[int]:
        """Templates of which the text holds so many pairs that a run may reach the threshold."""
        met: dict[int, set[Pair]] = {}
        index = self.index
        for pair in zip(words, words[1:]):
            if pair in index:
                for number in index[pair]:
                    met.setdefault(number, set()).add(pair)
        return [number for number, pairs in met.items() if len(pairs) >= self.fewest[number]]

    def _windows(self, pairs: list[Pair], number: int) -> Iterator[tuple[float, int, int]]:
        """(coefficient, first word, last word) of every run of words that reaches the threshold."""
        _, template = self.templates[number]
        low, high, longest = self.low[number], self.high[number], self.longest[number]
        places = [p for p, pair in enumerate(pairs) if pair in template]
        for at, first in enumerate(places):
            # Too few pairs of the template in reach.
            if at + low > len(places) or places[at + low - 1] >= first + longest:
                continue
            seen: set[Pair] = set()
            shared = 0
            for p in range(first, min(first + longest, len(pairs))):
                pair = pairs[p]
                new = pair not in seen
                seen.add(pair)
                if len(seen) > high:
                    break
                if new and pair in template:
                    shared += 1
                    value = 2 * shared / (len(seen) + len(template))
                    if value >= self.threshold:
                        yield value, first, p + 1

    def _runs(self, lines: list[list[bytes]], template: set[Pair], low: int, high: int) -> Iterator[tuple[float, int, int]]:
        for first, line in enumerate(lines):
            # The best run starts in a line that adds a pair of the template: without it the run is no worse.
            before: list[bytes] = []
            pairs: set[Pair] = set()
            for last in range(first, len(lines)):
                joined = before[-1:] + lines[last]
                pairs.update(zip(joined, joined[1:]))
                before = joined or before
                if last == first and line and not any(p in template for p in pairs) and not (line[-1:] and any(line[-1] == p[0] for p in template)):
                    break
                if len(pairs) > high:
                    break
                if not line:
                    break
                if len(pairs) >= low and lines[last]:
                    value = dice(pairs, template)
                    if value >= self.threshold:
                        yield value, first, last


def scan_documents(docs: DataFrame, notices: Mapping[str, tuple[str, ...]] = NOTICES, threshold: float = THRESHOLD,
                   key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, licenses) for every row; licenses is an array of (name, dice, first_line, last_line), sorted by name.

    One pass over whole texts, no shuffle. Null, empty and blank texts, and texts of one word, have
    no licence.
    """
    scanner = Scanner(notices, threshold)
    rows = fresh(docs, key, text)
    entry = pa.struct([("name", pa.string()), ("dice", pa.float64()), ("first_line", pa.int32()), ("last_line", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized_batches(batches, "text"):
            found = [[dict(zip(("name", "dice", "first_line", "last_line"), x)) for x in scanner.find(t)] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found, pa.list_(entry))], ["key", "licenses"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(lean(run), f"key {kind}, licenses array<struct<name: string, dice: double, first_line: int, last_line: int>>")
