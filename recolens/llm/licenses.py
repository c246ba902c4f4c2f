"""Licence notices in documents, by the Dice coefficient over word bigrams.

Text and templates are normalised alike: lower case, ASCII punctuation separates words. A stretch of
words, wherever it begins and ends, matches a template when 2 * |A & B| / (|A| + |B|) of their bigram
multisets reaches the threshold. That bounds the size of a matching stretch from both sides and its
number of template bigrams from below. Only bigrams of the template start or end a stretch (others at
its ends would only lower the coefficient), so a template is tried only where enough of its bigrams
stand within its largest size, and most texts are left after one look-up per bigram.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from recolens.llm.tokens import Members, grams, pieces, plain_words

#: Customary licence notices and short licence texts, as published.
TEMPLATES = {
    "AGPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "AGPL-3.0 short": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "Apache-2.0 short": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "BSD-2-Clause short": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "BSD-3-Clause short": "Released under the BSD 3-Clause License.",
    "CC-BY-4.0 short": "Licensed under CC BY 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0 short": "Licensed under CC BY-SA 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0 short": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-ND-4.0 short": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0 short": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND-4.0 short": "Licensed under CC BY-NC-ND 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "GPL-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "GPL-2.0 short": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-3.0 short": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "LGPL-2.0": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Library General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "LGPL-2.0 short": "This work is licensed under the GNU Library General Public License, version 2.",
    "LGPL-2.1": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "LGPL-2.1 short": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-3.0": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version.",
    "LGPL-3.0 short": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "MIT short": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "MPL-2.0 short": "Licensed under the Mozilla Public License, Version 2.0.",
    "Proprietary": "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the publisher.",
    "Proprietary short": "All rights reserved.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

PERCENT = 80
FOUND = "doc_id long, license string, dice double, first_line long, n_lines long, n_words long"


class Templates:
    def __init__(self, templates: dict[str, str], percent: int):
        self.names = sorted(templates)
        words = plain_words(pa.array([templates[n] for n in self.names], pa.string()))
        self.bags = [
            Counter(grams(words.hash[words.first[k] : words.first[k + 1]], 2).tolist()) for k in range(len(self.names))
        ]
        self.sizes = [sum(b.values()) for b in self.bags]
        self.percent = percent
        # 2 * min(a, b) / (a + b) >= p / 100 bounds the size a of a match of a template of size b.
        self.bounds = [
            (-(-percent * b // (200 - percent)), (200 - percent) * b // percent) for b in self.sizes
        ]
        self.members = Members(np.array([g for bag in self.bags for g in bag], np.uint64))
        known = self.members.values
        # How often each known bigram stands in each template.
        self.often = np.zeros((len(self.names), len(known)), np.int64)
        for k, bag in enumerate(self.bags):
            self.often[k, np.searchsorted(known, np.array(list(bag), np.uint64))] = list(bag.values())

    def matches(self, k: int, place: np.ndarray, gram: np.ndarray, text: np.ndarray):
        """(surplus, dice, size, first bigram) of the stretches that match template k, all texts of a batch
        at once. `place` has the bigrams of the template, `gram` their numbers and `text` their texts.

        The surplus is the number of shared bigrams less those of either side that aren't shared.
        """
        lo, hi = self.bounds[k]
        b = self.sizes[k]
        # A match shares at least `lo` bigrams, within `hi`.
        n = len(place) - lo + 1
        if not b or n < 1:
            return
        last = lo - 1
        starts = np.flatnonzero((place[last:] - place[:n] < hi) & (text[last:] == text[:n]))
        often = self.often[k]
        for s in starts.tolist():
            e_end = s + int(np.searchsorted(place[s : s + hi], place[s] + hi))
            seen: dict[int, int] = {}
            common, first, own = 0, int(place[s]), text[s]
            for at, g, of in zip(place[s:e_end].tolist(), gram[s:e_end].tolist(), text[s:e_end].tolist()):
                if of != own:
                    break
                seen[g] = seen.get(g, 0) + 1
                if seen[g] > often[g]:
                    continue  # ends on a bigram that isn't shared
                common += 1
                size = at - first + 1
                if size >= lo and 200 * common >= self.percent * (size + b):
                    yield 3 * common - size - b, 2 * common / (size + b), size, first

    def scan(self, hits: np.ndarray, grams_: np.ndarray, text: np.ndarray) -> list[tuple[int, int, str, float]]:
        """(first bigram, bigrams, license, dice) of the matching stretches, in order.

        `hits` are the places of known bigrams, `text` their texts. Of stretches that overlap only the one
        with the largest surplus stays, so that a whole notice is not named after a short one inside it;
        ties to the more similar, the shorter, the earlier one and the smaller name.
        """
        gram = np.searchsorted(self.members.values, grams_[hits])
        found = []
        for k, name in enumerate(self.names):
            own = np.flatnonzero(self.often[k][gram])
            for surplus, dice, size, first in self.matches(k, hits[own], gram[own], text[own]):
                found.append((-surplus, -dice, size, first, name))
        found.sort()
        begins: list[int] = []
        kept: list[tuple[int, int, str, float]] = []
        for _, dice, size, first, name in found:
            # Stretches share a word if one begins before the word after the other's last bigram ends.
            at = bisect_right(begins, first)
            if (at and kept[at - 1][0] + kept[at - 1][1] >= first) or (at < len(begins) and first + size >= begins[at]):
                continue
            begins.insert(at, first)
            kept.insert(at, (first, size, name, -dice))
        return kept


def scan_licenses(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    percent: int = PERCENT,
    doc: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, license, dice, first_line, n_lines, n_words), one row per notice found.

    Lines are counted from 0 at line feeds; a notice may begin and end within a line. `license` is the
    template that shares most with the words found. Null, empty and wordless texts have no notice, nor has an empty table. Every row is
    scanned by itself: repeated rows give repeated results, a null doc_id stays null. Other columns
    are ignored. `templates` is a fixed list that travels with the tasks.
    """
    templates = TEMPLATES if templates is None else templates

    def run(batches):
        known = Templates(templates, percent)
        for batch in batches:
            out = []
            for part in pieces(batch, 1):
                ids = part.column(0).to_pylist()
                words = plain_words(part.column(1))
                all_grams = grams(words.hash, 2)
                hits = known.members.where(all_grams)
                text_of = np.searchsorted(words.first, hits, "right") - 1
                whole = hits + 1 < words.first[text_of + 1]
                kept = known.scan(hits[whole], all_grams, text_of[whole])
                breaks = np.flatnonzero(words.raw == 10) if kept else None
                for first, size, name, dice in kept:
                    i = int(np.searchsorted(words.first, first, "right")) - 1
                    before, line, to = np.searchsorted(breaks, [words.offsets[i], words.start[first], words.start[first + size]]).tolist()
                    out.append((ids[i], name, dice, line - before, to - line + 1, size + 1))
            kinds = [pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
            names = ["doc_id", "license", "dice", "first_line", "n_lines", "n_words"]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], kinds[c]) for c in range(6)], names)

    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, FOUND)
