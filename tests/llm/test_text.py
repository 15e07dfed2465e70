"""Personal data, licenses, token counts and lines against plain Python."""

import hashlib
import itertools
import random
import re
import textwrap

import numpy as np
import pytest

from tillroll.llm import licenses, lines, pii, tokens

from .conftest import SF_DIR, with_clashes

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([ \-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(s):
    return re.sub("[^0-9]", "", s)


def luhn(d):
    return sum(v - 9 * (v > 9) for v in (int(c) * (1 + i % 2) for i, c in enumerate(reversed(d)))) % 10 == 0


def base_spans(text):
    text = text or ""
    return [
        [m.span() for m in EMAIL.finditer(text)],
        [m.span() for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))],
        [m.span() for m in CARD.finditer(text) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))],
        [m.span() for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15],
    ]


def as_text(spans):
    return ",".join(f"{k}:{a}:{b}" for k, own in zip(pii.KINDS, spans, strict=True) for a, b in own)


TRICKY = [
    "a@b.c@d.e a@b.c_x@d.e.f x@y a@@b.cc .@-.- %+@a.b.",
    "mail joe.doe@mail.example.com, or jane@x.org; \U0001f600 é@b.de ü.me@c.de",
    "1.2.3.4.5.6.7.8 1.2.3.999.5.6.7 0.0.0.0 00255.0001.2.3 256.1.1.1 1..2.3.4 10.0.0.1:80 v1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 5500000000000004 5500-0000-0000-0004-1 1 2 3 4 5 6 7 8 9",
    "card 378282246310005 visa 4222222222222 6011000990139424 6011 0009 9013 9424  4111  1111 1111 1111 1111",
    "+1 (743) 555-3824 and +49 30 123456 +1-2 +1234567 +123456789012345 +1234567890123456 ++1 555 123 4567--",
    "call (743) 555-3824 or 743-555-3824, phone 212.555.0100; section 743-555-38245",
    "write joe (at) example (dot) com or ann [at] mail.org to me",
    "fe80:0:0:0:0:0:0:1 2001:0db8:85a3:0000:0000:8a2e:0370:7334",
    "12345678901234567890123456789012345678901234567890 4111111111111111x4111111111111111",
    "a" * 20000 + "@b." + "c." * 20000 + " " + "1" * 30000 + " " + "1 " * 20000 + "+" + "(" * 20000 + "+1" + "-" * 20000,
]


@pytest.fixture(scope="module")
def tricky(spark):
    return with_clashes(spark.createDataFrame(list(enumerate(TRICKY)), "doc_id bigint, text string"))


def check_base(df):
    texts = {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}
    out = pii.personal_data(df).collect()
    assert len(out) == df.count()
    for r in out:
        spans = base_spans(texts[r["doc_id"]]) if r["doc_id"] is not None else None
        if spans is None:
            continue
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [len(s) for s in spans]
        assert r["base_sha256"] == hashlib.sha256(as_text(spans).encode()).hexdigest()
        every = [x for x in r["spans"].split(",") if x]
        assert set(filter(None, as_text(spans).split(","))) <= set(every)
        keys = [(pii.KINDS.index(k), int(a), int(b)) for k, a, b in (x.split(":") for x in every)]
        assert keys == sorted(keys)
    return {r["doc_id"]: r["spans"] for r in out}


def test_base_spans_on_tricky_texts(tricky):
    check_base(tricky)


def test_base_spans_on_edges(edge_docs, no_docs):
    check_base(edge_docs)
    assert pii.personal_data(no_docs).count() == 0


def test_base_spans_on_the_given_documents(spark):
    check_base(spark.read.parquet(f"{SF_DIR}/documents.parquet"))


def test_personal_data_runs_no_python(tricky):
    text = pii.candidates(tricky)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text


def test_reliabilities_follow_the_votes():
    counts = {(3, 1, 1, 1): 40, (3, -1, -1, 0): 30, (3, 0, 1, 1): 25, (3, 0, -1, 0): 20, (2, -1, 1, 0): 5, (2, 1, 1, 0): 20}
    labelers, p = pii.reliabilities(counts)
    assert p[(3, 1, 1, 1)] > 0.9 and p[(3, 0, 1, 1)] > 0.8 and p[(3, -1, -1, 0)] < 0.1 and p[(3, 0, -1, 0)] < 0.5
    assert p[(2, -1, 1, 0)] < 0.5 < p[(2, 1, 1, 0)]  # a failed checksum is not outvoted
    assert abs(labelers.likes.sum(axis=3) - 1).max() < 1e-9


def planted(rng, n, prior, likes):
    """Counts of votes that labelers of known reliabilities give, for each kind."""
    counts = {}
    for kind in range(4):
        for true in rng.random(n) < prior[kind]:
            key = (kind, *(int(rng.choice(3, p=likes[kind][j][int(true)])) - 1 for j in range(3)))
            counts[key] = counts.get(key, 0) + 1
    return counts


@pytest.mark.parametrize("n", [4000, 20000])
def test_em_finds_planted_reliabilities(n):
    """Shares of true candidates from 0.3 to 0.8, and labelers that are not what the first guess says."""
    rng = np.random.default_rng(n)
    prior = [0.8, 0.3, 0.6, 0.5]
    likes = np.array(
        [
            [[[0.7, 0.1, 0.2], [0.02, 0.08, 0.9]], [[0.6, 0.3, 0.1], [0.1, 0.2, 0.7]], [[0.1, 0.8, 0.1], [0.05, 0.35, 0.6]]],
            [[[0.9, 0.05, 0.05], [0.01, 0.04, 0.95]], [[0.8, 0.1, 0.1], [0.3, 0.1, 0.6]], [[0.2, 0.7, 0.1], [0.05, 0.55, 0.4]]],
            [[[0.55, 0.0, 0.45], [0.03, 0.0, 0.97]], [[0.7, 0.1, 0.2], [0.05, 0.05, 0.9]], [[0.3, 0.6, 0.1], [0.05, 0.25, 0.7]]],
            [[[0.8, 0.2, 0.0], [0.0, 0.4, 0.6]], [[0.9, 0.05, 0.05], [0.2, 0.1, 0.7]], [[0.4, 0.5, 0.1], [0.1, 0.2, 0.7]]],
        ]
    )
    found, _ = pii.reliabilities(planted(rng, n, prior, likes))
    assert np.abs(found.prior - prior).max() < 0.05
    assert np.abs(found.likes - likes).max() < 0.05


def test_pseudo_counts_do_not_grow_with_the_candidates():
    few = {(3, 1, 1, 1): 40, (3, -1, -1, 0): 30, (3, 0, 1, 1): 25, (3, 0, -1, 0): 20}
    shares = [pii.reliabilities({k: v * n for k, v in few.items()})[0].likes[3] for n in (1, 100)]
    assert (np.abs(shares[1] - shares[0]) < 0.1).all() and shares[1][1, 1, 2] > 0.99  # the votes alone decide


def test_loose_spans_beside_base_spans(spark):
    """Loose candidates are sought in what valid base spans leave, and in all of what they don't."""
    texts = ["+1 (212) 555-0100 (212) 555-0101", "+1 (212) 555-0100(212) 555-0101", "+12 (212) 555-0100 99999 (212) 555-0101"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    out = {r["doc_id"]: [(x["s"], x["e"], x["base"]) for x in r["spans"] if x["kind"] == 3] for r in pii.candidates(df).collect()}
    assert out[2][-1] == (25, 39, False)
    for i, spans in out.items():
        base = [(s, e) for s, e, is_base in spans if is_base]
        assert base == base_spans(texts[i])[3]
        assert not any(s < f and b < e for s, e, is_base in spans if not is_base for b, f in base)


def test_blocks_of_matches(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice(["a@b.co ", "é x ", "1.2.3.4 ", "\U0001f600", "+1 555 123 4567, "]) for _ in range(n))) for i, n in enumerate((0, 1, 5, 200, 900))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for block in (1, 3, 64):
        monkeypatch.setattr(pii, "BLOCK", block)
        check_base(df)


def test_many_matches_in_one_text(spark):
    """100,000 e-mails in one text, in about the time of two passes over it."""
    text = " ".join(f"mail a{i}@b{i}.com" for i in range(100_000))
    (row,) = pii.personal_data(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).collect()
    assert row["n_email"] == 100_000
    assert row["base_sha256"] == hashlib.sha256(as_text(base_spans(text)).encode()).hexdigest()


def test_many_boilerplate_lines_in_one_text(spark):
    text = "\n".join(f"line {i}" for i in range(100_000))
    df = spark.createDataFrame([(i, f"{text}\nown {i}", f"s{i}") for i in range(3)], "doc_id bigint, text string, source string")
    out = lines.remove_boilerplate(df, min_sites=3).collect()
    assert sorted(map(tuple, out)) == [(i, f"own {i}", 100_001, 100_000) for i in range(3)]


def test_lines_of_repeated_and_missing_ids(spark):
    rows = [(1, "x\na", "s1"), (1, "b\nx", "s2"), (None, "x\nc", "s3"), (None, "y\nx\ny", "s4"), (1, "x\na", "s1"), (2, None, "s5"), (None, "", None)]
    df = with_clashes(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))
    out = lines.remove_boilerplate(df, min_sites=4)
    assert sorted(map(tuple, out.collect()), key=str) == lines_by_hand(rows, 4)


def test_looser_spans_are_added_where_the_labelers_agree(spark):
    sure = [(i, f"phone +1 (212) 555-01{i:02d} now") for i in range(40)]
    free = [(100 + i, f"please call (212) 555-02{i:02d} today") for i in range(20)]
    odd = [(200 + i, f"serial 012-555-03{i:02d} of the box") for i in range(20)]
    out = pii.personal_data(spark.createDataFrame(sure + free + odd, "doc_id bigint, text string")).collect()
    found = {r["doc_id"]: r["spans"] for r in out}
    assert all(found[i].startswith("phone:6:") for i in range(40))
    assert all(found[100 + i] == "phone:12:26" for i in range(20))
    assert not any(found[200 + i] for i in range(20))


def test_licenses_are_found_and_others_not(spark):
    rows = [
        (1, "Text before.\nReleased under the MIT License.\nText after."),
        (2, "Licensed under the Apache License, Version 2.0."),
        (3, "# This work is licensed under the GNU General Public License, version 3. See the file."),
        (4, "Licensed under CC BY-NC 4.0.\nLicensed under CC BY 4.0."),
        (5, "I need a license to drive.\nThe public library is under the bridge.\nMIT is in Boston."),
        (6, "Released under the terms of nothing at all."),
    ]
    out = {r["doc_id"]: r for r in licenses.scan_corpus(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [out[i]["families"] for i in range(1, 7)] == ["mit", "apache", "gpl", "cc-by,cc-by-nc", "", ""]
    assert out[1]["spans"] == "mit:13:44" and out[4]["n_licenses"] == 2


#: Notices as published, and how many of their lines the template runs through.
WRAPPED = {
    "gpl": (3, "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation; either version 2 of the License, or\n(at your option) any later version."),
    "agpl": (3, "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU Affero General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version."),
    "lgpl": (3, "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version."),
    "bsd": (2, "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:"),
    "mit": (2, 'Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the "Software"), to deal\nin the Software without restriction, including without limitation the rights'),
    "mpl": (2, "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "apache": (2, 'Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at'),
    "cc-by": (2, "This work is licensed under a Creative Commons Attribution 4.0\nInternational License."),
    "cc-by-sa": (2, "This work is licensed under a Creative Commons\nAttribution-ShareAlike 4.0 International License."),
}


@pytest.mark.parametrize("mark", ["", " * ", "# ", "dnl "])
def test_wrapped_notices_are_seen_whole(spark, mark):
    head = "Some words about the file\nCopyright (C) 2020 The Authors\n\n"
    rows, want = [], {}
    for i, (family, (n, text)) in enumerate(WRAPPED.items()):
        lines = [mark + x for x in text.split("\n")]
        rows.append((i, head + "\n".join(lines) + "\n\nand so on"))
        want[i] = f"{family}:{len(head)}:{len(head) + len(chr(10).join(lines[:n]))}"
    rows = [(i + 100 * k, text) for k in range(30) for i, text in rows]  # so that they are among the model's lines
    out = {r["doc_id"]: r["spans"] for r in licenses.scan_corpus(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert out == {i: want[i % 100] for i, _ in rows}


def test_notices_wrapped_at_any_width():
    model = licenses.fit([])
    for family, texts in licenses.TEMPLATES.items():
        for text in texts:
            for width in (1, 12, 20, 30, 40, 60):
                lines = textwrap.wrap(text, width, break_long_words=False, break_on_hyphens=False)
                whole = "\n".join(lines)
                assert model.spans(f"Before it\n{whole}\nand after it", 0.5, 0.6) == [(family, 10, 10 + len(whole))], lines


def test_notices_that_share_lines_or_touch():
    model = licenses.fit([])
    apache = 'Licensed under the Apache License, Version 2.0 (the "License"); you may not\nuse this file except in compliance with the License.'
    both = apache + " Released under the MIT License."
    assert model.spans(both, 0.5, 0.6) == [("apache", 0, len(both)), ("mit", both.index("\n") + 1, len(both))]
    assert model.spans("Licensed under CC BY 4.0.\nLicensed under CC BY 4.0.", 0.5, 0.6) == [("cc-by", 0, 25), ("cc-by", 26, 51)]
    assert not model.spans("This program is free software; you can redistribute it and/or modify\n\nas published by the Free Software Foundation", 0.5, 0.6)


def test_headings_and_identifiers():
    """A heading counts as a line of its own only; identifiers of every family, and none of unknown ones."""
    model = licenses.fit([])
    for family, texts in licenses.HEADINGS.items():
        for text in texts:
            for line in (text, f"   {text}  ", f"# {text}", text.upper()):
                assert [s[0] for s in model.spans(f"before\n{line}\nafter it", 0.5, 0.6)] == [family], line
            if len(text.split()) < 4:  # longer ones are most of a notice
                assert not model.spans(f"People say that the {text} is a long text to read.", 0.5, 0.6)
    for family, names in licenses.IDENTIFIERS.items():
        for name in names:
            assert [s[0] for s in model.spans(f"// SPDX-License-Identifier: {name}", 0.5, 0.6)] == [family]
    for name in ("Foo-1.0", "Proprietary", "LicenseRef-Custom"):
        assert not model.spans(f"// SPDX-License-Identifier: {name}", 0.5, 0.6)


def test_the_sample_of_lines_is_bounded_by_all_tasks_together(spark):
    """As many lines, and the same, from any number of partitions; no partition sends more than its share."""
    texts = [f"line {i} " + "x" * (i % 7) for i in range(40_000)]
    df = spark.createDataFrame([("\n".join(texts[i::400]),) for i in range(400)], "text string")
    drawn = [licenses.corpus_lines(df.repartition(n), 100) for n in (2, 40)]
    assert drawn[0] == drawn[1] and len(drawn[0]) == 100
    everything = licenses.corpus_lines(df, 50_000)
    assert sorted(everything) == sorted(texts) and everything[:100] == drawn[0]
    assert len(licenses.corpus_lines(df, 50_000, longest=8)) == sum(len(t) <= 8 for t in texts)


def test_copies_of_a_line_take_one_place_in_the_sample(spark):
    texts = [f"line {i}" for i in range(6400)]
    once = licenses.corpus_lines(spark.createDataFrame([("\n".join(texts),)], "text string"), 50)
    assert len(once) == len(set(once)) == 50
    often = "\n".join([*texts, *[once[0]] * 3000])
    assert licenses.corpus_lines(spark.createDataFrame([(often,)] * 3, "text string"), 50) == once


def test_licenses_on_edges(edge_docs, no_docs):
    out = licenses.scan_corpus(edge_docs).collect()
    assert len(out) == edge_docs.count() and not any(r["n_licenses"] for r in out)
    assert licenses.scan_corpus(no_docs).count() == 0


def test_licenses_on_disturbed_notices():
    """Held-out accuracy: copies disturbed with another seed than in training."""
    import random

    model, rng, right, n = licenses.fit([]), random.Random(99), 0, 0
    for family, texts in licenses.TEMPLATES.items():
        for text in texts:
            for _ in range(20):
                w = [x for x in licenses.words(text) if rng.random() > 0.03]
                right += model.classify(" ".join(w))[0] == family
                n += 1
    assert right / n > 0.85


def test_licenses_equal_a_search_on_the_given_documents(spark):
    """The notices stand word for word in the given documents: a plain search finds the same lines."""
    known = {t: f for f, ts in licenses.TEMPLATES.items() for t in ts}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = {r["doc_id"]: r["spans"] for r in licenses.scan_corpus(docs).collect()}
    for r in docs.collect():
        at, want = 0, []
        for line in r["text"].split("\n"):
            if line in known:
                want.append(f"{known[line]}:{at}:{at + len(line)}")
            at += len(line) + 1
        assert out[r["doc_id"]] == ",".join(want)


def tokens_by_hand(word, scores, byte):
    """The best of all segmentations."""
    word, best = tokens.MARK + word, None
    for cuts in itertools.product((0, 1), repeat=len(word) - 1):
        ends = [i + 1 for i, c in enumerate(cuts) if c] + [len(word)]
        parts = [word[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        if any(len(p) > 1 and p not in scores for p in parts):
            continue
        score = sum(scores[p] if p in scores else byte * len(p.encode()) for p in parts)
        n = sum(1 if p in scores else len(p.encode()) for p in parts)
        if best is None or (-score, n) < best:
            best = (-score, n)
    return best[1]


WORDS = ["a", "the", "therein", "there", "theres", "unhappy", "licence", "ßé\U0001f600", "12345", "naïve", "xqzjk", "thethe", ""]


def test_token_counts_equal_all_segmentations(spark):
    scores, byte, _ = tokens.pieces("piece_bpe_32k.model")
    rows = [(i, f"{w}  {w}\n{w}x") for i, w in enumerate(WORDS)]
    out = {r["doc_id"]: r for r in tokens.count_tokens(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for i, w in enumerate(WORDS):
        assert out[i]["n_tokens"] == 2 * tokens_by_hand(w, scores, byte) + tokens_by_hand(w + "x", scores, byte)
        assert out[i]["n_words"] == 3


def test_token_counts_on_edges(edge_docs, no_docs, monkeypatch):
    out = [tuple(r) for r in tokens.count_tokens(edge_docs).collect()]
    words = {r["doc_id"]: len((r["text"] or "").split()) for r in edge_docs.collect() if r["doc_id"] is not None}
    assert {i: n for i, n, _ in out if i is not None} == words
    assert all((n == 0) == (t == 0) and t >= n for _, n, t in out)
    assert tokens.count_tokens(no_docs).count() == 0


def test_long_texts_come_in_pieces(monkeypatch):
    monkeypatch.setattr(tokens, "PIECE", 10)
    text = "one two  three fourteenlettersandmore five\n six"
    assert [w for ws in tokens.words_of(text) for w in ws] == text.split()


def lines_by_hand(rows, min_sites):
    sites = {}
    for _, text, site in rows:
        for line in (text or "").split("\n"):
            if site is not None and line.strip(" \t\r"):
                sites.setdefault(line.strip(" \t\r"), set()).add(site)
    out = []
    for doc_id, text, _ in rows:
        if text is None:
            out.append((doc_id, None, 0, 0))
            continue
        every = text.split("\n")
        kept = [x for x in every if len(sites.get(x.strip(" \t\r"), ())) < min_sites]
        out.append((doc_id, "\n".join(kept), len(every), len(every) - len(kept)))
    return sorted(out, key=str)


def test_lines_on_edges(edge_docs, no_docs):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in edge_docs.collect()]
    out = lines.remove_boilerplate(edge_docs, min_sites=2)
    assert sorted(map(tuple, out.collect()), key=str) == lines_by_hand(rows, 2)
    assert lines.remove_boilerplate(no_docs).count() == 0


@pytest.mark.parametrize("min_sites", [1, 3, 200])
def test_lines_near_the_threshold(spark, min_sites):
    rows = [(s * 1000 + k, f"line {k}\r\n \nbody {s} {k}\n  line {k}\t", f"site{s}") for k in (1, 2, 3, 150, 199, 200, 201, 250) for s in range(k)]
    df = with_clashes(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))
    out = lines.remove_boilerplate(df, min_sites=min_sites)
    assert sorted(map(tuple, out.collect()), key=str) == lines_by_hand(rows, min_sites)
