"""Operator 9: license scans.

Templates are cut into word sequences; a text is cut into overlapping windows of the templates'
lengths.  Windows retrieve templates by MinHash bands, and each retrieved place is verified: the
share of the template's distinct shingles found in the text around the window must reach
``least_share``, which leaves room for one replaced word, or two in templates of ``LONG`` words.
In a template shorter than ``SHORT`` words every word tells licenses apart, so it must be whole.
Where matches of several licenses overlap, those with a smaller share go.

Lengths are put into classes (powers of two); a window of class ``m`` has ``m`` words and starts
every ``max(1, m // 4)`` words.  A template is looked up by its parts of the class's length, all of
its starts.  A window in a place with two replaced words has at least ``m - 5`` of the ``m - 1``
shingles of the part it stands for (``m >= 8``, so a Jaccard similarity of 3 / 11 or more), and with
``BANDS`` bands of one hash each the chance to miss it is below (8 / 11) ** BANDS, about 4e-5.  A key
is a window's least shingle hash, so a window without any shingle of a template cannot collide;
such windows are left out before.

Words are runs of letters and digits, lower-cased, so punctuation and case never matter.

Cases: null or empty texts have no words and no matches; a text shorter than a template's
window is one window; overlapping matches of one template are merged into the best; repeated
rows give repeated results; an empty table or no template gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from markbook.llm.common import Memo, mix64

# Notices by which texts state a license.
TEMPLATES = {
    "AGPL-3.0": ["it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either "
                 "version 3 of the License"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0",
                   "you may not use this file except in compliance with the License. You may obtain a copy of the License at"],
    "BSD-3-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                     "the following conditions are met"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0", "licensed under a Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0",
                     "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0",
                     "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3",
                "it under the terms of the GNU General Public License as published by the Free Software Foundation, either "
                "version 3 of the License"],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies"],
    "LGPL-3.0": ["it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either "
                 "version 3 of the License"],
    "MIT": ["Released under the MIT License",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
}
SHINGLE = 2
BANDS = 32
SHORT, LONG = 8, 16
WORD = re.compile(r"[^\W_]+")


def least_share(words: int, shingles: int) -> float:
    """The share that a template of so many words needs of its distinct shingles: an edited word
    costs two."""
    edits = 0 if words < SHORT else 1 if words < LONG else 2
    return 1 - edits * SHINGLE / shingles


def clearest(found: list[tuple[str, int, int, float]]) -> list[tuple[str, int, int, float]]:
    """The matches that no overlapping match beats."""
    by_place = sorted(found, key=lambda m: m[1])
    beaten: set[int] = set()
    reach = max((n for _, _, n, _ in found), default=0)
    for i, (_, first, n, share) in enumerate(by_place):
        for j in range(i + 1, len(by_place)):
            if by_place[j][1] >= first + reach:
                break
            if by_place[j][1] < first + n and by_place[j][3] != share:
                beaten.add(i if share < by_place[j][3] else j)
    return sorted(m for i, m in enumerate(by_place) if i not in beaten)


class Scanner:
    """Templates, their band keys by window length, and a text's windows."""

    def __init__(self, templates: dict[str, list[str]] = TEMPLATES):
        self.memo = Memo(300_000)
        g = np.random.default_rng(11)
        self.a = g.integers(1, 1 << 63, BANDS, dtype=np.uint64) | np.uint64(1)
        self.templates, self.retrieve = [], {}
        for name, notices in sorted(templates.items()):
            for text in notices:
                h = self.words(text)
                if len(h) < SHINGLE:
                    continue
                k, m = len(self.templates), 1 << (len(h).bit_length() - 1)
                self.templates.append((name, len(h), np.unique(self.shingles(h))))
                table = self.retrieve.setdefault(m, {})
                starts = range(len(h) - m + 1)
                for key_row in self.keys(h, m, np.array(starts)).T.tolist():
                    for band, key in enumerate(key_row):
                        table.setdefault((band, key), set()).add(k)
        self.known = np.unique(np.concatenate([s for _, _, s in self.templates])) if self.templates else np.zeros(0, np.uint64)
        # which template has which known shingle, and how many it needs
        self.has = np.array([np.isin(self.known, s) for _, _, s in self.templates], np.int64).reshape(len(self.templates), len(self.known))
        self.least = np.array([len(s) * (least_share(n, len(s)) - 1e-9) for _, n, s in self.templates])
        self.sorted_keys = {m: np.array(sorted({key for _, key in t}), np.uint64) for m, t in self.retrieve.items()}

    def words(self, text: str) -> np.ndarray:
        found = WORD.findall(text.lower())
        memo, known = self.memo, set(found)
        new = memo.missing(known)
        for w in known if memo.room(len(new)) else new:
            memo[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(memo.__getitem__, found), np.uint64, len(found))

    def shingles(self, h: np.ndarray) -> np.ndarray:
        n = max(len(h) - SHINGLE + 1, 0)
        total = np.zeros(n, np.uint64)
        for k in range(SHINGLE):
            total = total * np.uint64(0x9E3779B97F4A7C15) + h[k:n + k]
        return mix64(total)

    def keys(self, h: np.ndarray, m: int, starts: np.ndarray) -> np.ndarray:
        """Band keys (band, window) of the windows of ``m`` words at ``starts``."""
        s, width = self.shingles(h), max(min(m, len(h)) - SHINGLE + 1, 1)
        out = np.empty((BANDS, len(starts)), np.uint64)
        for band in range(BANDS):
            low = (s ^ (s >> np.uint64(31))) * self.a[band]
            low ^= low >> np.uint64(32)
            size = 1
            while 2 * size <= width:  # sliding minimum over ``size`` shingles, doubled
                low = np.minimum(low[:-size], low[size:])
                size *= 2
            out[band] = mix64(np.minimum(low[starts], low[starts + width - size]) + np.uint64(band))
        return out

    def near(self, s: np.ndarray) -> list[tuple[int, int]]:
        """Stretches of shingles around those that some template has, wide enough for any window
        and any verified place, from a multiple of 64.  A stretch without the least share of any
        template's distinct shingles cannot hold a verified place and is left out."""
        if not len(self.known):
            return []
        at = np.searchsorted(self.known, s)
        at[at == len(self.known)] = 0
        hit = np.flatnonzero(self.known[at] == s)
        if not self.enough(at[hit]):
            return []
        reach = 3 * max(n for _, n, _ in self.templates)
        cut = np.flatnonzero(np.diff(hit) > 2 * reach)
        found = []
        for a, b in zip(hit[np.append(0, cut + 1)].tolist(), hit[np.append(cut, len(hit) - 1)].tolist(), strict=True):
            a, b = max(0, a - reach), min(len(s), b + reach + 1)
            a -= a % 64
            if self.enough(at[hit[np.searchsorted(hit, a):np.searchsorted(hit, b)]]):
                found.append((a, b))
        return found

    def enough(self, places: np.ndarray) -> bool:
        """Whether these places among the known shingles hold the least share of some template."""
        if not len(places):
            return False
        there = np.zeros(len(self.known), np.int64)
        there[places] = 1
        return bool((self.has @ there >= self.least).any())

    def scan(self, text: str | None) -> list[tuple[str, int, int, float]]:
        """(license, first word, words, containment) of every verified, merged match."""
        h = self.words(text or "")
        found = []
        for a, b in self.near(self.shingles(h)) if len(h) >= SHINGLE else ():
            # windows start at multiples of their step, counted from the text's start
            found += [(name, first + a, n, share) for name, first, n, share in self.scan_words(h[a:b + SHINGLE - 1])]
        return found

    def scan_words(self, h: np.ndarray) -> list[tuple[str, int, int, float]]:
        s, best = self.shingles(h), {}
        for m, table in self.retrieve.items():
            step = max(1, m // 4)
            starts = np.unique(np.append(np.arange(0, max(len(h) - m, 0) + 1, step), max(len(h) - m, 0)))
            keys, known = self.keys(h, m, starts), self.sorted_keys[m]
            at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            hits = set()
            for band, w in zip(*np.nonzero(known[at] == keys), strict=True):
                hits |= {(k, int(starts[w])) for k in table.get((int(band), int(keys[band, w])), ())}
            for k, start in sorted(hits):
                name, n, need = self.templates[k]
                lo, hi = max(0, start - n), min(len(s), start + m + n)
                share, first, last = self.contained(s[lo:hi], need, n)
                if share >= least_share(n, len(need)) - 1e-9:
                    own = best.setdefault(k, [])
                    if own and lo + first <= own[-1][1]:
                        own[-1] = max(own[-1], (lo + first, lo + last, share), key=lambda x: x[2])
                    else:
                        own.append((lo + first, lo + last, share))
        found: dict[tuple[str, int], tuple[int, float]] = {}
        for k, own in best.items():
            for first, last, share in own:
                key = (self.templates[k][0], first)
                found[key] = max(found.get(key, (0, 0.0)), (last - first + SHINGLE, share), key=lambda x: x[1])
        return clearest([(name, first, n, share) for (name, first), (n, share) in sorted(found.items())])

    @staticmethod
    def contained(s: np.ndarray, need: np.ndarray, n: int) -> tuple[float, int, int]:
        """The largest share of the template's shingles within ``n`` words of the text, and
        the first and last shingle of that place."""
        at = np.searchsorted(need, s)
        at[at == len(need)] = 0
        hit = np.flatnonzero(need[at] == s)
        result = (0.0, 0, 0)
        for i in range(len(hit)):
            own = hit[i:np.searchsorted(hit, hit[i] + n - SHINGLE + 1)]
            share = len(np.unique(s[own])) / len(need)
            if share > result[0]:
                result = (share, int(own[0]), int(own[-1]))
        return result


_scanners: dict[str, Scanner] = {}


def _scanner(templates: dict[str, list[str]]) -> Scanner:
    key = repr(sorted(templates.items()))
    if key not in _scanners:
        _scanners.clear()
        _scanners[key] = Scanner(templates)
    return _scanners[key]


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                  templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """One row per match: doc_id, license, word (place of its first word), n_words, containment.
    The templates are a short fixed list; texts are read once and nothing is shuffled."""
    schema = "doc_id long, license string, word long, n_words long, containment double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(templates)
        for b in batches:
            rows = []
            for doc, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                rows += [(doc, *m) for m in scanner.scan(t.as_py())]
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                             names=[c.split()[0] for c in schema.split(", ")])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)
