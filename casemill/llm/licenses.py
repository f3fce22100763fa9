"""License scans: MinHash bands over overlapping text windows, exact shingle containment after.

Texts and templates are cut into folded words (see ``decontam``) and five-word shingles.  For a
template of t words a document's windows hold 2t shingles, one every t words, so any passage of up
to t + 5 words lies whole in one of them.  A window that holds c of the template's m shingles has a
Jaccard similarity of at least c / (2t + m - c) with it; ``bands_for`` takes as many
bands as make a collision surer than ``SURE`` at the least similarity that verification accepts.  A
retrieved window is verified by the exact share of the template's shingles that it holds, compared as
words, not as hashes.

A notice that is spread wider than a window is found by the whole document: the template's shingles
that it holds are counted exactly, and a license that no window gave is reported if their share is
enough, from the first to the last of them.  So a license is reported just if a template's share in
the whole document is enough, and by its best window where one is.

A band can only collide where a document holds a shingle of a template; documents without any are
passed over before windows are made, which changes no result.  In all others the bands of every window
are looked up.

Templates are broadcast, at most ``GROUP_WORDS`` words of them at once; more are scanned in groups, one
pass after the other, each written before the next begins.

Edge cases: a null or empty text, or one under five words, matches nothing; templates need five
words; of equal shares the first window and the first template count; a text of any length is scanned
whole, by windows; repeated rows each get a row; other columns of the input are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from casemill.llm.common import Held, map_batches, written
from casemill.llm.decontam import fold_words
from casemill.llm.substring import MULT, mix

SHINGLE, CONTAINMENT, SURE = 5, 0.8, 1 - 1e-6
GROUP_WORDS = 1_000_000
WORDS_KEPT = 300_000

#: Well-known notices, by SPDX name.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("CC-BY-4.0", "This work is licensed under the Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("LGPL-3.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
]


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= WORDS_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingle_hashes(words: list[bytes], hashes: WordHashes, k: int = SHINGLE) -> np.ndarray:
    n = len(words)
    if n < k:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    g = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        g = g * MULT + h[i : n - k + 1 + i]
    return mix(g)


def bands_for(similarity: float, sure: float = SURE) -> tuple[int, int]:
    """(bands, rows of each): two rows, or one where passages are so short that two would need hundreds of bands."""
    rows = 2 if similarity >= 0.3 else 1
    return (1 if similarity >= 1 else math.ceil(math.log(1 - sure) / math.log(1 - similarity**rows))), rows


class Templates:
    """Templates with their MinHash bands, built once in each Python worker."""

    def __init__(self, texts: list[tuple[str, str]], containment: float):
        rng = np.random.default_rng(20240229)
        self.containment, self.hashes = containment, WordHashes()
        self.items, self.buckets = [], {}
        for name, text in texts:
            words = fold_words(text)
            if len(words) < SHINGLE:
                raise ValueError(f"a template of {name} has under {SHINGLE} words")
            self.items.append((name, len(words), np.unique(shingle_hashes(words, self.hashes)), shingles_of(words, range(len(words) - SHINGLE + 1))))
        self.sizes = sorted({size for _, size, *_ in self.items})
        self.shape: dict[int, tuple[int, int]] = {}
        for size in self.sizes:
            held = [(m, math.ceil(containment * m - 1e-9)) for _, n, _, x in self.items if n == size for m in [len(x)]]
            self.shape[size] = bands_for(min(c / (2 * size + m - c) for m, c in held))
        self.salt = rng.integers(1, 2**63, max([b * r for b, r in self.shape.values()], default=0), dtype=np.uint64)
        for j, (_, size, shingles, _) in enumerate(self.items):
            for key in self.keys(mix(shingles[None, :] ^ self.salt[:, None]).min(1)[:, None], size)[:, 0].tolist():
                self.buckets.setdefault((size, key), set()).add(j)
        self.known_keys = {size: np.array([k for s, k in self.buckets if s == size], np.uint64) for size in self.sizes}
        # The distinct shingles and, by them, the templates that hold each.
        held = np.concatenate([x[2] for x in self.items]) if self.items else np.zeros(0, np.uint64)
        self.all, place = np.unique(held, return_inverse=True)
        self.owners = np.repeat(np.arange(len(self.items)), [len(x[2]) for x in self.items])[np.argsort(place, kind="stable")]
        self.first_owner = np.r_[0, np.cumsum(np.bincount(place, minlength=len(self.all)))]

    @classmethod
    def of(cls, texts, containment: float) -> Templates:
        return Held.of((cls, hash((tuple(texts), containment))), lambda: cls(texts, containment))

    def keys(self, least: np.ndarray, size: int) -> np.ndarray:
        """The keys of all bands (rows of the result) of windows (columns), from the least values by each salt."""
        bands, rows = self.shape[size]
        values = least[: bands * rows].reshape(bands, rows, -1)
        out = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64)[:, None], values[:, 0].shape)
        for r in range(rows):
            out = mix(out * MULT + values[:, r])
        return out

    def windows(self, shingles: np.ndarray, most: int = 2_000_000):
        """(size, keys of the bands of all windows): a window is two runs of ``size`` shingles, or what there is."""
        runs: dict[int, list[np.ndarray]] = {size: [] for size in self.sizes}
        step = max(1, most // len(shingles))
        for g in range(0, len(self.salt), step):
            values = mix(shingles[None, :] ^ self.salt[g : g + step, None])
            for size in self.sizes:
                need = math.prod(self.shape[size]) - g
                if need > 0:
                    runs[size].append(np.minimum.reduceat(values[:need], np.arange(0, len(shingles), size), axis=1))
        for size, parts in runs.items():
            least = np.concatenate(parts)
            yield size, self.keys(np.minimum(least[:, :-1], least[:, 1:]) if least.shape[1] > 1 else least, size)

    def scan(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """(license, share of its shingles, first and last word) of the best window of each license."""
        words = fold_words(text)
        shingles = shingle_hashes(words, self.hashes)
        known = np.isin(shingles, self.all)
        at = np.flatnonzero(known)
        best: dict[str, tuple[float, int, int]] = {}
        for size, keys in self.windows(shingles) if len(at) else ():
            near: dict[int, set[int]] = {}
            for band, w in np.argwhere(np.isin(keys, self.known_keys[size])).tolist():
                near.setdefault(w, set()).update(self.buckets[size, int(keys[band, w])])
            for w in sorted(near):
                a, b = w * size, min((w + 2) * size, len(shingles))
                held = shingles_of(words, [i for i in range(a, b) if known[i]])
                for j in sorted(near[w]):
                    name, _, _, wanted = self.items[j]
                    share = len(wanted & held) / len(wanted)
                    if share >= self.containment and (share, -a) > (best.get(name, (0, 0, 0))[0], -best.get(name, (0, 0, 0))[1]):
                        best[name] = (share, a, b + SHINGLE - 1)
        for name, x in self.spread(words, shingles[at], at).items() if len(at) else ():
            best.setdefault(name, x)
        return [(name, *x) for name, x in sorted(best.items())]

    def spread(self, words: list[bytes], shingles: np.ndarray, at: np.ndarray) -> dict[str, tuple[float, int, int]]:
        """(share, first and last word) of the best template of each license in the whole document."""
        own = np.unique(shingles)
        place = np.searchsorted(self.all, own)
        owners = [self.owners[a:b] for a, b in zip(self.first_owner[place], self.first_owner[place + 1], strict=True)]
        shared = np.bincount(np.concatenate(owners), minlength=len(self.items))
        held = None
        best: dict[str, tuple[float, int, int]] = {}
        for j in np.flatnonzero(shared).tolist():
            name, _, _, wanted = self.items[j]
            if shared[j] < self.containment * len(wanted):
                continue
            held = held or [(tuple(words[i : i + SHINGLE]), i) for i in at.tolist()]
            mine = [i for x, i in held if x in wanted]
            share = len({x for x, _ in held if x in wanted}) / len(wanted)
            if share >= self.containment and share > best.get(name, (0.0,))[0]:
                best[name] = (share, mine[0], mine[-1] + SHINGLE)
        return best


def shingles_of(words: list[bytes], starts) -> set[tuple]:
    return {tuple(words[i : i + SHINGLE]) for i in starts}


def template_groups(texts: list[tuple[str, str]], most: int) -> list[list[tuple[str, str]]]:
    """``texts`` in groups of at most ``most`` words, or of one text."""
    out, size = [[]], 0
    for x in texts:
        n = len(fold_words(x[1]))
        if out[-1] and size + n > most:
            out.append([])
            size = 0
        out[-1].append(x)
        size += n
    return out


FOUND = "array<struct<license: string, share: double, start: int, end: int>>"


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] | None = None, *, containment: float = CONTAINMENT, group_words: int = GROUP_WORDS) -> DataFrame:
    """doc_id and licenses: an array of (license, share, first word, end of the window)."""
    texts = list(templates if templates is not None else TEMPLATES)
    rows = docs.select("doc_id", "text")
    for k, group in enumerate(template_groups(texts, group_words)):
        rows = _scanned(written(rows, "scanned") if k else rows, group, containment)
    return rows.drop("text")


def _scanned(rows: DataFrame, texts: list[tuple[str, str]], containment: float) -> DataFrame:
    """``rows`` (doc_id, text and, after a pass, licenses) with the licenses of these templates too."""
    shared = rows.sparkSession.sparkContext.broadcast(texts)
    thin = rows.select("doc_id", "text", *[c for c in rows.columns if c == "licenses"])
    kind = pa.list_(pa.struct([("license", pa.string()), ("share", pa.float64()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        known = Templates.of(shared.value, containment)
        for batch in batches:
            out = []
            for i, text in enumerate(batch.column(1).to_pylist()):
                best = {x["license"]: x for x in (batch.column(2)[i].as_py() if batch.num_columns > 2 else ())}
                for n, s, a, b in known.scan(text):
                    if n not in best or (s, -a) > (best[n]["share"], -best[n]["start"]):
                        best[n] = {"license": n, "share": s, "start": a, "end": b}
                out.append([best[n] for n in sorted(best)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, kind)], names=["doc_id", "text", "licenses"])

    return map_batches(thin, run, f"doc_id {thin.schema['doc_id'].dataType.simpleString()}, text string, licenses {FOUND}")
