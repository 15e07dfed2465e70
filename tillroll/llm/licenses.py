"""License scan by a trained paragraph classifier.

A notice is a line or, hard-wrapped, a window of adjacent lines that one template runs through; a line without words ends
it. Its features are the word bigrams and trigrams that occur in the license notices (all others have weight 0, so a
paragraph without any is ``unknown`` at once). A multinomial logistic regression over the families and ``unknown`` is
trained on disturbed copies of the notices (words dropped, swapped or added) and on a bounded, hash-drawn sample of the
corpus' own lines as unknown. A temperature, fitted on held-out copies, calibrates its probabilities. A prediction counts
if its calibrated probability reaches ``least`` and a template of the family confirms it: enough of the template's bigrams
are in the window's joined words. A heading, as "MIT License", confirms only where it is a line of its own. Of windows that overlap, the one with the most of its template counts, and the others
if they are notices besides it: of another family, with enough bigrams of their own.

Prediction covers every line of every text, in one pass without a shuffle. Defined results: a null or blank text has no
licenses; repeated rows are scanned alike; a line without words is unknown; of families with equal probability the first
in order wins; an empty table gives an empty result; other columns are ignored. Spans are whole lines; offsets are code
points, end exclusive.
"""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

WORD = re.compile(r"[^\W_]+(?:\.[0-9]+)*")
UNKNOWN = "unknown"

#: Usual notices of each family.
NOTICES = {
    "agpl": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    ],
    "bsd": [
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc0": ["Released under CC0 1.0 Universal.", "This work has been dedicated to the public domain under the CC0 1.0 Universal Public Domain Dedication."],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    ],
    "lgpl": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ],
    "epl": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at",
        "The accompanying program is provided under the terms of this Eclipse Public License (\"Agreement\").",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "unlicense": ["This is free and unencumbered software released into the public domain."],
}

#: Identifiers of each family, as in a line ``SPDX-License-Identifier: ...``.
IDENTIFIERS = {
    "agpl": ["AGPL-3.0-only", "AGPL-3.0-or-later", "AGPL-3.0"],
    "apache": ["Apache-2.0", "Apache-1.1"],
    "bsd": ["BSD-3-Clause", "BSD-2-Clause", "0BSD"],
    "cc-by": ["CC-BY-4.0", "CC-BY-3.0"],
    "cc-by-nc": ["CC-BY-NC-4.0"],
    "cc-by-sa": ["CC-BY-SA-4.0", "CC-BY-SA-3.0"],
    "cc0": ["CC0-1.0"],
    "epl": ["EPL-2.0", "EPL-1.0"],
    "gpl": ["GPL-3.0-or-later", "GPL-3.0-only", "GPL-2.0-or-later", "GPL-2.0-only", "GPL-3.0", "GPL-2.0"],
    "isc": ["ISC"],
    "lgpl": ["LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later"],
    "mit": ["MIT", "MIT-0"],
    "mpl": ["MPL-2.0"],
    "unlicense": ["Unlicense"],
}

#: Headings of each family. They count only where they are a line of their own.
HEADINGS = {
    "agpl": ["GNU Affero General Public License"],
    "apache": ["Apache License", "Apache License, Version 2.0", "Apache License, Version 2.0, January 2004"],
    "bsd": ["BSD License", "BSD 2-Clause License", "BSD 3-Clause License"],
    "cc-by": ["Attribution 4.0 International", "Creative Commons Attribution 4.0 International"],
    "cc-by-sa": ["Attribution-ShareAlike 4.0 International"],
    "cc0": ["CC0 1.0 Universal"],
    "epl": ["Eclipse Public License", "Eclipse Public License - v 2.0"],
    "gpl": ["GNU General Public License", "GNU General Public License v3.0"],
    "isc": ["ISC License", "The ISC License"],
    "lgpl": ["GNU Lesser General Public License"],
    "mit": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "mpl": ["Mozilla Public License", "Mozilla Public License Version 2.0"],
    "unlicense": ["The Unlicense"],
}
TEMPLATES = {f: [*texts, *(f"SPDX-License-Identifier: {i}" for i in IDENTIFIERS[f])] for f, texts in NOTICES.items()}

#: Ways of speaking of licenses that grant none; they teach ``unknown``.
OTHER = [
    "You need a license to drive this car.",
    "The public library is open from nine to five.",
    "The license of the software must be checked by the lawyer.",
    "Read the terms of the agreement before you sign.",
    "Version 2.0 of the report was published by the foundation.",
    "The work of the public school is under review.",
    "All rights reserved.",
]


def words(line: str) -> list[str]:
    return WORD.findall(line.lower())


def grams(w: list[str]) -> set[tuple[str, ...]]:
    return {*zip(w, w[1:]), *zip(w, w[1:], w[2:])}


def disturbed(w: list[str], filler: list[str], rng: random.Random) -> list[str]:
    """A copy with single words dropped or swapped, and filler around it."""
    out = [x for x in w if rng.random() > 0.06]
    if len(out) > 3 and rng.random() < 0.2:
        i = rng.randrange(len(out) - 1)
        out[i], out[i + 1] = out[i + 1], out[i]
    before, after = (rng.choices(filler, k=rng.choice((0, 0, 2, 6))) if filler else [] for _ in range(2))
    return [*before, *out, *after]


def corpus_lines(docs: DataFrame, at_most: int, longest: int = 2000) -> list[str]:
    """At most ``at_most`` distinct lines of the corpus, for training: those with the smallest hashes.

    ``at_most`` and ``longest``, the characters of a line that may teach, bound the sample. The distinct lines are
    estimated first, and only those whose hash lies under a limit that leaves some twice as many as wanted are sorted; so
    the driver gets that many at most, from all tasks together, however large the corpus is.
    """
    lines = docs.where(F.col("text").isNotNull()).select(F.explode(F.split("text", "\n")).alias("line"))
    lines = lines.where(F.length("line") <= longest).withColumn("draw", F.xxhash64("line", F.lit("draw")))
    n = lines.agg(F.approx_count_distinct("line", 0.02)).first()[0]
    limit = -(1 << 63) + min((1 << 64) - 1, (1 << 64) * 2 * at_most // max(n, 1))
    drawn = lines.where(F.col("draw") <= limit).select("line", "draw").distinct()
    return [r["line"] for r in drawn.orderBy("draw", "line").limit(at_most).collect()]


class Notice:
    """A template: its bigrams, how often it has each, and the pairs of words that are up to three places apart, in order.

    ``heading`` tells that it counts only where it is a line of its own.
    """

    def __init__(self, family: str, w: list[str], heading: bool = False):
        self.family, self.words, self.heading, self.counts = family, w, heading, Counter(zip(w, w[1:]))
        self.pairs = set(self.counts)
        self.near = {*self.pairs, *zip(w, w[2:]), *zip(w, w[3:])}

    def runs_on(self, line: list[str], following: list[str]) -> bool:
        """Whether the template goes on over the end of a line; a word on either side may be missing or a comment mark."""
        return any((a, b) in self.near for a in line[-2:] for b in following[:2])


class Model:
    """Weights of the n-grams for each class (``unknown`` first), the temperature, and the templates' bigrams."""

    def __init__(self, index, weights, bias, temperature, templates, headings):
        self.index, self.weights, self.bias, self.temperature = index, weights, bias, temperature
        self.families = [UNKNOWN, *templates]
        self.notices = [Notice(f, w) for f, ts in templates.items() for w in ts]
        self.notices += [Notice(f, w, True) for f, ts in headings.items() for w in ts]
        self.templates = {f: [n.pairs for n in self.notices if n.family == f] for f in templates}
        self.holders = {}  # bigram: numbers of the notices that have it
        for k, n in enumerate(self.notices):
            for g in n.pairs:
                self.holders.setdefault(g, []).append(k)

    def probabilities(self, found: list[int]) -> np.ndarray:
        z = (self.bias + self.weights[found].sum(axis=0) / max(len(found), 1) ** 0.5) / self.temperature
        e = np.exp(z - z.max())
        return e / e.sum()

    def confirmed(self, family: str, have: set) -> float:
        """The largest share of a template's bigrams that the line has."""
        return max(len(t & have) / len(t) for t in self.templates[family])

    def classify(self, line: str, least: float = 0.5, share: float = 0.6) -> tuple[str, float]:
        return self.classify_words(words(line), least, share)

    def classify_words(self, w: list[str], least: float, share: float) -> tuple[str, float]:
        have = grams(w)
        found = [self.index[g] for g in have if g in self.index]
        if not found:
            return UNKNOWN, 1.0
        p = self.probabilities(found)
        best = int(np.argmax(p))
        if best and p[best] >= least and self.confirmed(self.families[best], have) >= share:
            return self.families[best], float(p[best])
        return UNKNOWN, float(p[0])

    def windows(self, lines: list[list[str]], least: float, share: float) -> list[tuple[str, int, int]]:
        """(family, first line, last line) of the notices in a paragraph, given as the words of its lines."""
        joined = [x for w in lines for x in w]
        counts: dict[int, int] = {}
        for g in {*zip(joined, joined[1:])} & self.holders.keys():
            for k in self.holders[g]:
                counts[k] = counts.get(k, 0) + 1
        found, kinds = [], {}
        for k, count in counts.items():
            notice = self.notices[k]
            n = len(notice.pairs)
            if count / n < share:
                continue
            if notice.heading:
                for i, w in enumerate(lines):
                    if w == notice.words and self.classify_words(w, least, share)[0] == notice.family:
                        found.append((n, 0, i, k, set(notice.pairs)))
                continue
            own = [Counter(g for g in zip(w, w[1:]) if g in notice.pairs) for w in lines]
            over = [notice.pairs & {(a[-1], b[0])} for a, b in zip(lines, lines[1:])] + [set()]
            for i in range(len(lines)):
                have, j = own[i] & notice.counts, i
                while have or over[j]:
                    if len(have) / n >= share:
                        if (i, j) not in kinds:
                            kinds[i, j] = self.classify_words([x for w in lines[i : j + 1] for x in w], least, share)[0]
                        if kinds[i, j] == notice.family:
                            found.append((have.total(), j - i, i, k, set(have)))
                    if j + 1 == len(lines) or not notice.runs_on(lines[j], lines[j + 1]):
                        break
                    more = (have + Counter(over[j]) + own[j + 1]) & notice.counts
                    if more == have:
                        break
                    have, j = more, j + 1
        chosen, at = [], {}  # notices as lists, and those of each line
        for _, extra, i, k, have in sorted(found, key=lambda f: (-f[0], *f[1:4])):
            notice, j = self.notices[k], i + extra
            others = [c for x in range(i, j + 1) for c in at.get(x, ())]
            if len(have.difference(*(c[3] for c in others))) / len(notice.pairs) < share:
                continue  # a part of the others
            one = next((c for c in others if c[0] == notice.family), None)
            if one:
                one[1], one[2] = min(one[1], i), max(one[2], j)
                one[3] |= have
            else:
                one = [notice.family, i, j, set(have)]
                chosen.append(one)
            for x in range(i, j + 1):
                if not any(c is one for c in at.setdefault(x, [])):
                    at[x].append(one)
        return [(family, i, j) for family, i, j, _ in chosen]

    def spans(self, text: str, least: float, share: float) -> list[tuple[str, int, int]]:
        """(family, start, end) of the notices of a text, in order."""
        out, at, paragraph, places = [], 0, [], []
        for line in [*text.split("\n"), ""]:
            w = words(line)
            if w:
                paragraph.append(w)
                places.append((at, at + len(line)))
            elif paragraph:
                out += [(f, places[i][0], places[j][1]) for f, i, j in self.windows(paragraph, least, share)]
                paragraph, places = [], []
            at += len(line) + 1
        return sorted(out, key=lambda hit: (*hit[1:], hit[0]))


def fit(lines: list[str], copies: int = 60, rounds: int = 400, seed: int = 5) -> Model:
    """A model from disturbed templates and from ``lines`` as unknown.

    Lines that hold a template are left out, and those that are mostly a part of one, as lines of wrapped notices are.
    """
    rng = random.Random(seed)
    templates = {f: [words(t) for t in ts] for f, ts in TEMPLATES.items()}
    headings = {f: [words(t) for t in ts] for f, ts in HEADINGS.items()}
    pairs = {f: [set(zip(w, w[1:])) for w in ts] for f, ts in templates.items()}
    taught = {f: [*ts, *headings.get(f, [])] for f, ts in templates.items()}
    index = {g: i for i, g in enumerate(sorted({g for ts in taught.values() for w in ts for g in grams(w)}))}
    unknown = [words(x) for x in [*lines, *OTHER * copies]]
    everything = [t for ts in pairs.values() for t in ts]
    unknown = [w for w in unknown if max(len(t & b) / min(len(t), max(len(b), 1)) for b in [set(zip(w, w[1:]))] for t in everything) < 0.6]
    filler = [x for w in unknown for x in w][:5000]
    rows = [(0, w) for w in unknown if any(g in index for g in grams(w))]
    for c, ts in enumerate(taught.values(), 1):
        rows += [(c, disturbed(w, filler, rng)) for w in ts for _ in range(copies)]
    # notices that lost most of their words are unknown, too
    rows += [(0, rng.choices(filler, k=4) + w[i : i + 3]) for ts in templates.values() for w in ts for i in range(0, max(1, len(w) - 3), 3) if filler]
    rng.shuffle(rows)
    x = np.zeros((len(rows), len(index)), np.float32)
    y = np.zeros((len(rows), len(templates) + 1), np.float32)
    for i, (c, w) in enumerate(rows):
        found = [index[g] for g in grams(w) if g in index]
        x[i, found] = max(len(found), 1) ** -0.5
        y[i, c] = 1
    cut = len(rows) * 4 // 5
    weights, bias = np.zeros((len(index), y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)
    for _ in range(rounds):
        z = x[:cut] @ weights + bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        miss = (p - y[:cut]) / cut
        weights -= 4.0 * (x[:cut].T @ miss + 1e-5 * weights)
        bias -= 1.0 * miss.sum(axis=0)
    z = x[cut:] @ weights + bias

    def loss(t: float) -> float:
        s = z / t
        s = s - s.max(axis=1, keepdims=True)
        return float(-((s - np.log(np.exp(s).sum(axis=1, keepdims=True))) * y[cut:]).sum())

    temperature = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0), key=loss)
    return Model(index, weights, bias, temperature, templates, headings)


def scan(docs: DataFrame, model: Model, least: float = 0.5, share: float = 0.6) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, n_licenses, families (comma-joined, in order), spans (family:start:end)."""

    def one(batch: pa.RecordBatch) -> list[tuple]:
        out = []
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
            hits = model.spans(text.as_py() or "", least, share)
            out.append((doc_id, len(hits), ",".join(sorted({h[0] for h in hits})), ",".join(f"{f}:{a}:{b}" for f, a, b in hits)))
        return out

    return map_rows(docs.select("doc_id", "text"), one, "doc_id bigint, n_licenses bigint, families string, spans string")


def scan_corpus(docs: DataFrame, at_most: int = 4000) -> DataFrame:
    """``scan`` with a model fitted to at most ``at_most`` lines of the corpus."""
    return scan(docs, fit(corpus_lines(docs, at_most)))
