"""Licence notices in documents, by Dice coefficient with templates over word bigrams."""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from starflat.llm.common import byte_rows, texts

THRESHOLD = 0.8

# Wordings of public licence notices. A licence can have several.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
        except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
        writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
        WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
        specific language governing permissions and limitations under the License.""",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this
        software and associated documentation files (the "Software"), to deal in the Software without
        restriction, including without limitation the rights to use, copy, modify, merge, publish,
        distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
        Software is furnished to do so, subject to the following conditions: The above copyright
        notice and this permission notice shall be included in all copies or substantial portions of
        the Software.""",
    ),
    (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or
        without fee is hereby granted, provided that the above copyright notice and this permission
        notice appear in all copies.""",
    ),
    (
        "BSD-2-Clause",
        """Redistribution and use in source and binary forms, with or without modification, are
        permitted provided that the following conditions are met: 1. Redistributions of source code
        must retain the above copyright notice, this list of conditions and the following
        disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
        list of conditions and the following disclaimer in the documentation and/or other materials
        provided with the distribution.""",
    ),
    (
        "BSD-3-Clause",
        """Redistribution and use in source and binary forms, with or without modification, are
        permitted provided that the following conditions are met: 1. Redistributions of source code
        must retain the above copyright notice, this list of conditions and the following
        disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
        list of conditions and the following disclaimer in the documentation and/or other materials
        provided with the distribution. 3. Neither the name of the copyright holder nor the names of
        its contributors may be used to endorse or promote products derived from this software
        without specific prior written permission.""",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    (
        "GPL-3.0",
        """This program is free software: you can redistribute it and/or modify it under the terms of
        the GNU General Public License as published by the Free Software Foundation, either version 3
        of the License, or (at your option) any later version.""",
    ),
    (
        "GPL-2.0",
        """This program is free software; you can redistribute it and/or modify it under the terms of
        the GNU General Public License as published by the Free Software Foundation; either version 2
        of the License, or (at your option) any later version.""",
    ),
    (
        "MPL-2.0",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a
        copy of the MPL was not distributed with this file, You can obtain one at
        http://mozilla.org/MPL/2.0/.""",
    ),
    (
        "Unlicense",
        """This is free and unencumbered software released into the public domain. Anyone is free to
        copy, modify, publish, use, compile, sell, or distribute this software, either in source code
        form or as a compiled binary, for any purpose, commercial or non-commercial, and by any
        means.""",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    (
        "CC-BY-4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    (
        "CC-BY-NC-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
)

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
# Where a notice can begin or end: a line, a sentence or a comment mark.
BREAK = re.compile(rb"[.!?:;]+(?=\s)|[\r\n]+")


@dataclass(frozen=True)
class Template:
    name: str
    grams: Counter
    size: int
    least: int  # bigrams of a text that can reach the threshold
    most: int
    shared: int  # bigrams it must have in common


def bigrams(words: list[bytes]) -> list[tuple[bytes, bytes]]:
    return list(zip(words, words[1:]))


def compiled(templates, threshold: float) -> list[Template]:
    found = []
    for name, text in templates:
        grams = Counter(bigrams(WORD.findall(text.lower().encode())))
        size = sum(grams.values())
        if not size:
            continue
        least = math.ceil(size * threshold / (2 - threshold) - 1e-9)
        most = math.floor(size * (2 - threshold) / threshold + 1e-9)
        shared = math.ceil(threshold * (size + least) / 2 - 1e-9)
        found.append(Template(name, grams, size, max(1, least), most, max(1, shared)))
    return found


class Finder:
    """Best passage per licence of a text.

    Passages are runs of sentences or lines. The size of a text bounds its Dice
    coefficient with a template of another size: 2 min / (sum of both). Only
    runs within the bounds of a template are compared with it, and only from
    sentences on that have a bigram of it.
    """

    def __init__(self, templates, threshold: float) -> None:
        self.threshold = threshold
        self.templates = compiled(templates, threshold)
        self.having: dict[tuple[bytes, bytes], list[int]] = {}
        for i, template in enumerate(self.templates):
            for gram in template.grams:
                self.having.setdefault(gram, []).append(i)
        self.fewest = min((t.shared for t in self.templates), default=1)

    def find(self, text: bytes) -> list[tuple[str, float, int, int]]:
        """``(licence, score, first word, words)``, one row per licence found."""
        plain = text.decode("utf-8", "replace").lower().encode()
        words = WORD.findall(plain)
        hits = [i for i, gram in enumerate(zip(words, words[1:])) if gram in self.having]
        if len(hits) < self.fewest:
            return []
        shared: Counter = Counter()
        for i in hits:
            shared.update(self.having[words[i], words[i + 1]])
        wanted = [i for i, n in shared.items() if n >= self.templates[i].shared]
        if not wanted:
            return []
        starts = self._breaks(plain, len(words))
        best: dict[str, tuple[float, int, int]] = {}
        for i in wanted:
            template = self.templates[i]
            own = [h for h in hits if i in self.having[words[h], words[h + 1]]]
            for score, start, size in self._runs(words, starts, template, own):
                old = best.get(template.name)
                if old is None or (-score, start, size) < (-old[0], old[1], old[2]):
                    best[template.name] = (score, start, size)
        kept = []
        for name, (score, start, size) in sorted(best.items(), key=lambda x: (-x[1][0], x[0])):
            # A wording close to another licence's counts for the closer one only.
            if all(score == s or start >= a + n or a >= start + size for _, s, a, n in kept):
                kept.append((name, score, start, size))
        return sorted(kept)

    def _breaks(self, plain: bytes, n: int) -> list[int]:
        """Numbers of the words that begin a sentence or line, and the number of words."""
        starts, count, at = {0, n}, 0, 0
        for m in BREAK.finditer(plain):
            count += len(WORD.findall(plain, at, m.end()))
            at = m.end()
            starts.add(count)
        return sorted(starts)

    def _runs(self, words, starts: list[int], template: Template, own: list[int]):
        position = {start: k for k, start in enumerate(starts)}
        begins = sorted({starts[bisect_right(starts, h) - 1] for h in own})
        for start in begins:
            left = Counter(template.grams)
            common, at = 0, start
            for end in starts[position[start] + 1 :]:
                size = end - start - 1
                if size > template.most:
                    break
                for gram in zip(words[at : end - 1], words[at + 1 : end]):
                    if left[gram] > 0:
                        left[gram] -= 1
                        common += 1
                at = max(end - 1, start)
                if size >= template.least:
                    score = 2 * common / (size + template.size)
                    if score >= self.threshold:
                        yield score, start, end - start


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, license, score, first_word, n_words)``: each document's best passage per licence.

    Texts are lower-cased and cut into words. The score is the Dice coefficient
    of the multisets of word bigrams of a passage and a template, at least
    ``threshold``; of equal scores the first and shortest passage counts, of
    overlapping passages the better one. A document can hold several licences. The templates are a fixed list that
    travels with the code; nothing is shuffled.

    NULL and empty texts have no licence. Rows with NULL or repeated ids are
    scanned each by itself; an empty table gives no rows.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(templates, threshold)
        for keys, rows in byte_rows(batches):
            where, names, scores, firsts, sizes = [], [], [], [], []
            for i, row in enumerate(rows):
                for name, score, first, size in finder.find(row):
                    where.append(i)
                    names.append(name)
                    scores.append(score)
                    firsts.append(first)
                    sizes.append(size)
            yield pa.RecordBatch.from_arrays(
                [
                    keys.take(pa.array(where, pa.int64())),
                    pa.array(names, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(firsts, pa.int32()),
                    pa.array(sizes, pa.int32()),
                ],
                ["doc_id", "license", "score", "first_word", "n_words"],
            )

    schema = "doc_id long, license string, score double, first_word int, n_words int"
    return texts(docs).mapInArrow(apply, schema)
