"""License scans: MinHash bands over overlapping windows, then exact shingle containment.

A text is cut into blocks of BLOCK words, and the smallest value of each hash function is taken for
each block, for two blocks that follow each other, and so on by doubling. Two neighbouring blocks
of a size are a window; the windows of a size overlap by half, so a passage as long as a block, or
shorter, lies whole in one of them. Each of BANDS bands is one hash function: a window meets a
template in it with the probability of their Jaccard similarity J, in some band with
1 - (1 - J) ** BANDS. A template is looked for in windows of the smallest size that surely holds
it, where J is at least a quarter or so, and it is missed once in a thousand times or less.
Each window and template that meet are then compared shingle by shingle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.stage import slices
from headway.llm.words import WordSplitter, shingles

K = 3
BLOCK = 4
BANDS = 32
CONTAINED = 0.8

#: The wording of common license notices.
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0 header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
        "to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the "
        "License for the specific language governing permissions and limitations under the License."
    ),
    "MIT notice": "Released under the MIT License",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies."
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution."
    ),
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3",
    "GPL header": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If "
        "a copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/."
    ),
    "CC BY-NC 4.0 notice": "Licensed under CC BY-NC 4.0",
    "CC BY 4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to "
        "copy, modify, publish, use, compile, sell, or distribute this software, either in source "
        "code form or as a compiled binary, for any purpose, commercial or non-commercial, and by "
        "any means."
    ),
}

# Words are runs of letters, digits and bytes beyond ASCII; case does not count.
_PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


class Templates:
    """Shingles of templates, their least hashes, and the block size they are looked for with."""

    def __init__(self, texts: dict[str, str], bands: int = BANDS):
        self.names = list(texts)
        splitter = WordSplitter()
        words = splitter.split([t.encode().translate(_PLAIN) for t in texts.values()])
        hashes, text = shingles(words, K)
        self.odd = np.random.default_rng(29).integers(0, 1 << 63, bands, dtype=np.uint64) * 2 + 1
        self.sets = [np.unique(hashes[text == i]) for i in range(len(texts))]
        lengths = np.bincount(text, minlength=len(texts))
        if (lengths == 0).any():
            raise ValueError("a template must have words")
        self.level = [max(0, int(np.ceil(np.log2(n / BLOCK)))) for n in lengths.tolist()]
        self.least = np.array([[(s * a).min() for a in self.odd] for s in self.sets], dtype=np.uint64)
        self.levels = max(self.level, default=-1) + 1

    def of_level(self, level: int) -> list[int]:
        return [i for i, at in enumerate(self.level) if at == level]


def _windows(templates: Templates, hashes: np.ndarray, text: np.ndarray):
    """Windows that meet a template in a band: template, first and last shingle (exclusive)."""
    n = len(hashes)
    # Blocks do not cross texts: each text's shingles are cut on their own.
    first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    sizes = np.diff(np.r_[first, n])
    per = -(-sizes // BLOCK)
    owner = np.repeat(np.arange(len(first)), per)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
    start = first[owner] + number * BLOCK
    end = (first + sizes)[owner]
    least = [np.minimum.reduceat(hashes * a, start) for a in templates.odd]
    for level in range(templates.levels):
        size = BLOCK << level
        wanted = templates.of_level(level)
        pair = np.flatnonzero(np.r_[owner[1:] == owner[:-1], False])
        # A text's last block is a window by itself if it is the only one.
        alone = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]] & np.r_[owner[1:] != owner[:-1], True])
        if wanted:
            for left, right in ((pair, pair + 1), (alone, alone)):
                met = np.zeros((len(left), len(wanted)), dtype=bool)
                for band, low in enumerate(least):
                    window = np.minimum(low[left], low[right])
                    for column, template in enumerate(wanted):
                        met[:, column] |= window == templates.least[template, band]
                rows, columns = np.nonzero(met)
                for row, column in zip(rows.tolist(), columns.tolist(), strict=True):
                    a, b = left[row], right[row]
                    yield wanted[column], int(start[a]), int(min(start[b] + size, end[b]))
        # Blocks of the next size start at every second block.
        even = np.flatnonzero(number % 2 == 0)
        partner = np.minimum(even + 1, len(owner) - 1)
        partner = np.where(owner[partner] == owner[even], partner, even)
        least = [np.minimum(low[even], low[partner]) for low in least]
        owner, number, start, end = owner[even], number[even] // 2, start[even], end[even]


def _scanner(texts: dict[str, str], contained: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates, splitter = Templates(texts), WordSplitter()
        for batch in slices(batches, "content"):
            contents = batch.column("content").to_pylist()
            words = splitter.split([c.translate(_PLAIN) for c in contents])
            hashes, text = shingles(words, K)
            if not len(hashes):
                continue
            first_shingle = np.searchsorted(text, text)
            first_word = words.first[:-1][text] + np.arange(len(text)) - first_shingle
            found: dict[tuple[int, int], list] = {}
            for template, low, high in _windows(templates, hashes, text):
                own = templates.sets[template]
                hits = low + np.flatnonzero(np.isin(hashes[low:high], own))
                share = len(np.unique(hashes[hits])) / len(own)
                if share >= contained:
                    found.setdefault((int(text[low]), template), []).append(
                        (int(hits[0]), int(hits[-1]), share)
                    )
            rows = []
            for (document, template), hits in sorted(found.items()):
                merged: list[list] = []
                for low, high, share in sorted(hits):
                    if merged and low <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], high)
                        merged[-1][2] = max(merged[-1][2], share)
                    else:
                        merged.append([low, high, share])
                content, base = contents[document], int(words.offsets[document])
                last_word = words.first[document + 1] - 1
                for low, high, share in merged:
                    a = int(words.start[first_word[low]]) - base
                    b = int(words.end[min(first_word[high] + K - 1, last_word)]) - base
                    start = len(content[:a].decode("utf-8", "replace"))
                    length = len(content[a:b].decode("utf-8", "replace"))
                    rows.append((document, templates.names[template], start, start + length, share))
            doc_ids = batch.column("doc_id").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([doc_ids[r[0]] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.string()),
                    pa.array([r[2] for r in rows], pa.int64()),
                    pa.array([r[3] for r in rows], pa.int64()),
                    pa.array([r[4] for r in rows], pa.float64()),
                ],
                ["doc_id", "license", "start", "end", "containment"],
            )

    return run


def scan(
    docs: DataFrame, templates: dict[str, str] | None = None, contained: float = CONTAINED
) -> DataFrame:
    """Each passage of ``docs`` (doc_id and text, other columns are left out) that holds at least
    ``contained`` of a template's different shingles of three words: doc_id, license, start and
    end (code points, end exclusive) and containment. Passages of one template that overlap are
    one. A null, empty or clean text has no row; a repeated row has its own. No templates, no rows.
    """
    content = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).cast("binary").alias("content"),
    )
    return content.mapInArrow(
        _scanner(TEMPLATES if templates is None else templates, contained),
        "doc_id long, license string, start long, end long, containment double",
    )
