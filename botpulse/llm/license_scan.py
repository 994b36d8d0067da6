"""License scans by patience alignment of template words with text words.

A template matches a place of a text when the alignment covers ``min_coverage`` of the
template's words with ``min_density`` of the words between its first and last aligned word.

*Places.* Only words that occur in few templates' texts by chance are looked at first: the positions of
the template's distinctive words (all but ``STOP_WORDS``), grouped where the gaps are at most the
template's length. A group that holds too few different template words to reach the
coverage can't match and is skipped (an exact bound). Each other group, widened by the template's length,
is aligned; the whole text is covered.

*Alignment.* Common words at both ends are matched; words that occur once in both ranges are anchors;
the longest increasing subsequence of the anchors' positions is kept (patience sorting); the gaps between
neighbouring anchors are aligned in the same way.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from botpulse.llm.common import text_of

# Short public license notices and names.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at"),
    "MIT": "Released under the MIT License",
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License"),
    "BSD-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "Apache-2.0-name": "Apache License, Version 2.0",
    "MIT-licensed": "Licensed under the MIT License",
    "MIT-name": "The MIT License",
    "MIT-title": "The MIT License (MIT)",
    "GPL-2.0-notice": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License"),
    "GPL-2.0-name": "GNU General Public License, version 2",
    "GPL-3.0-name": "GNU General Public License, version 3",
    "LGPL-2.1-notice": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License"),
    "LGPL-2.1-name": "GNU Lesser General Public License, version 2.1",
    "LGPL-3.0-name": "GNU Lesser General Public License, version 3",
    "AGPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License"),
    "AGPL-3.0-name": "GNU Affero General Public License, version 3",
    "MPL-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at"),
    "MPL-2.0-name": "Mozilla Public License, version 2.0",
    "EPL-2.0-name": "Eclipse Public License, version 2.0",
    "ISC-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies"),
    "ISC-name": "The ISC License",
    "BSD-name": "Licensed under the BSD License",
    "BSD-3-Clause-name": "BSD 3-Clause License",
    "BSD-2-Clause-name": "BSD 2-Clause License",
    "Unlicense-notice": "This is free and unencumbered software released into the public domain",
    "CC0-1.0-name": "CC0 1.0 Universal",
    "CC-BY-4.0-name": "Creative Commons Attribution 4.0 International License",
    "CC-BY-SA-4.0-name": "Creative Commons Attribution-ShareAlike 4.0 International License",
    "CC-BY-NC-4.0-name": "Creative Commons Attribution-NonCommercial 4.0 International License",
}
# Identifiers of license tags.
SPDX = (
    "Apache-2.0 MIT MIT-0 GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later LGPL-2.1-only LGPL-2.1-or-later "
    "LGPL-3.0-only LGPL-3.0-or-later AGPL-3.0-only AGPL-3.0-or-later MPL-2.0 EPL-2.0 ISC BSD-2-Clause BSD-3-Clause 0BSD "
    "Unlicense CC0-1.0 CC-BY-4.0 CC-BY-SA-4.0 CC-BY-NC-4.0 BSL-1.0 Zlib")
TEMPLATES |= {f"{name}-tag": f"SPDX-License-Identifier: {name}" for name in SPDX.split()}
STOP_WORDS = frozenset("the of and to a in is that it for on with as by this or be you may not any at from an are".split())
_WORD = re.compile(r"[\w+-]+(?:\.\d+)*")
MIN_COVERAGE, MIN_DENSITY = 0.85, 0.7


def words_with_offsets(text: str) -> tuple[list[str], list[int], list[int]]:
    found = list(_WORD.finditer(text))
    return [m[0].lower() for m in found], [m.start() for m in found], [m.end() for m in found]


def longest_increasing(values: list[int]) -> list[int]:
    """Positions of a longest strictly increasing subsequence (patience sorting)."""
    tops: list[int] = []
    top_at: list[int] = []
    before = [-1] * len(values)
    for i, v in enumerate(values):
        pile = bisect_left(tops, v)
        if pile == len(tops):
            tops.append(v)
            top_at.append(i)
        else:
            tops[pile], top_at[pile] = v, i
        before[i] = top_at[pile - 1] if pile else -1
    out = []
    i = top_at[-1] if top_at else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Patience alignment: increasing pairs of positions with equal words."""
    pairs: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            pairs.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            pairs.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        once = {w for w, n in in_b.items() if n == 1 and in_a.get(w) == 1}
        if not once:
            continue
        at_b = {b[j]: j for j in range(b0, b1) if b[j] in once}
        anchors = [(i, at_b[a[i]]) for i in range(a0, a1) if a[i] in once]
        kept = [anchors[k] for k in longest_increasing([j for _, j in anchors])]
        pairs += kept
        edges = [(a0 - 1, b0 - 1), *kept, (a1, b1)]
        todo += [(i + 1, i2, j + 1, j2) for (i, j), (i2, j2) in zip(edges, edges[1:])]
    return sorted(pairs)


class Template:
    def __init__(self, name: str, text: str):
        self.name = name
        self.words = words_with_offsets(text)[0]
        self.distinct = frozenset(self.words)
        self.rare = self.distinct - STOP_WORDS
        self.counts = Counter(self.words)


def find_template(words: list[str], at: dict[str, list[int]], t: Template,
                  min_coverage: float = MIN_COVERAGE, min_density: float = MIN_DENSITY) -> list[tuple[int, int, float]]:
    """Matches ``(first word, end word, coverage)`` of a template; ``at`` has the positions of template words."""
    need = min_coverage * len(t.words)
    places = sorted(p for w in t.rare for p in at.get(w, ()))
    out = []
    i = 0
    while i < len(places):
        j = i + 1
        while j < len(places) and places[j] - places[j - 1] <= len(t.words):
            j += 1
        low = max(0, places[i] - len(t.words))
        high = min(len(words), places[j - 1] + 1 + len(t.words))
        here = Counter(words[low:high]) if high - low < 50 * len(t.words) else None
        # the alignment can't have more words than both sides share
        if here is None or sum(min(n, here[w]) for w, n in t.counts.items()) >= need:
            out += _matches_between(words, low, high, t, need, min_density)
        i = j
    return out


def _matches_between(words: list[str], low: int, high: int, t: Template, need: float,
                     min_density: float) -> list[tuple[int, int, float]]:
    """Align ranges that begin at each possible first word of a match, left to right, without overlap."""
    out, n = [], len(t.words)
    reach = int(n / min_density) + 1
    heads = set(t.words[: n - int(-(-need // 1)) + 1])  # a match begins with one of these words
    p = low
    while p < high:
        if words[p] not in heads:
            p += 1
            continue
        part = words[p:min(high, p + reach)]
        pairs = align(part, t.words)
        if len(pairs) >= need:
            first, last = pairs[0][0], pairs[-1][0]
            if len(pairs) >= min_density * (last - first + 1):
                out.append((p + first, p + last + 1, len(pairs) / n))
                p += last + 1
                continue
        p += 1
    return out


def scan_text(text: str, templates: list[Template], **limits) -> list[tuple[str, int, int, float]]:
    """``(license, start, end, coverage)`` of a text, offsets in code points; of overlapping
    matches the one with more covered words stays."""
    rare = frozenset().union(*(t.rare for t in templates))
    lower = text.lower()
    if not any(w in lower for w in rare):
        return []
    words, starts, ends = words_with_offsets(text)
    at: dict[str, list[int]] = {}
    for i, w in enumerate(words):
        if w in rare:
            at.setdefault(w, []).append(i)
    found = []
    for t in templates:
        if sum(n for w, n in t.counts.items() if w in at or w in STOP_WORDS) < limits.get("min_coverage", MIN_COVERAGE) * len(t.words):
            continue
        found += [(coverage * len(t.words), coverage, a, b, t.name) for a, b, coverage in find_template(words, at, t, **limits)]
    found.sort(key=lambda m: (-m[0], -m[1], m[2], m[4]))
    out: list[tuple[str, int, int, float]] = []
    taken: list[tuple[int, int]] = []
    for _, coverage, a, b, name in found:
        if all(b <= x or y <= a for x, y in taken):
            taken.append((a, b))
            out.append((name, starts[a], ends[b - 1], coverage))
    return sorted(out, key=lambda m: m[1])


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 templates: dict[str, str] | None = None, **limits) -> DataFrame:
    """One row per row of ``docs``: its id and ``licenses``, an array of (license, start, end, coverage).

    Null text is empty (no licenses). Of overlapping matches the one with more covered words stays; on ties the one with the
    higher coverage, the earlier one, the first by name. Repeated rows and null ids keep their rows; an empty table gives an
    empty one; texts are scanned whole. Other columns are not read.
    """
    known = dict(templates if templates is not None else TEMPLATES)
    id_type = docs.schema[id_col].dataType.simpleString()
    kind = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                               ("coverage", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = [Template(n, t) for n, t in known.items()]
        for batch in batches:
            found = [[{"license": n, "start": a, "end": b, "coverage": c}
                      for n, a, b, c in scan_text(t.as_py(), ready, **limits)] for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, kind)], names=["id", "licenses"])

    rows = docs.select(docs[f"`{id_col}`"].alias("id"), text_of(docs, text_col).alias("text"))
    found = rows.mapInArrow(run, f"id {id_type}, licenses array<struct<license:string,start:int,end:int,coverage:double>>")
    return found.withColumnRenamed("id", id_col)
