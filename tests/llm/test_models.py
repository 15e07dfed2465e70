"""Language identification, mixing, packing and top-k search."""

import zlib

import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillroll.llm import langid, mixing, packing, topk

from .conftest import SF_DIR, with_clashes


def docs(spark, sf_dir=SF_DIR):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def test_held_out_accuracy(spark):
    table = docs(spark, "/root/testdata/sf0.01")
    out = langid.identify(table, langid.fit(table)).join(table.select("doc_id", "lang"), "doc_id")
    rows = out.where("held_out").collect()
    assert len(rows) > 100
    assert sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)
    ids = [r["doc_id"] for r in rows]
    assert all(zlib.crc32(str(i).encode()) % 5 == 0 for i in ids)
    assert not any(r["rejected"] for r in out.collect())  # all are of a known language


def test_held_out_rows_and_labels_of_others_teach_nothing(spark):
    table = docs(spark)
    fooled = table.withColumn("lang", F.when(langid.held_out(), "xx").otherwise(F.col("lang")))
    model = langid.fit(fooled)
    assert "xx" not in model.languages
    assert np.array_equal(model.centroids, langid.fit(table).centroids)


def test_foreign_texts_are_rejected_and_short_ones_stay(spark):
    model = langid.fit(docs(spark, "/root/testdata/sf0.01"))
    names, score, rejected = model.predict(["Это совсем другой язык, и он далеко", "これは日本語の文章です", "123 456", None, "", "the", "Des eaux"])
    assert rejected.tolist() == [True, True, True, True, True, False, False]
    assert names[2:5] == ["und"] * 3 and names[5:] == ["en", "fr"] and score[2] == 0
    assert names[0] in model.languages


def test_languages_on_edges(edge_docs, no_docs):
    model = langid.fit(edge_docs)
    out = {r["doc_id"]: r for r in langid.identify(edge_docs, model).collect()}
    assert out[10]["lang_pred"] == "fr" or "fr" not in model.languages
    assert all(out[i]["lang_pred"] == "und" and out[i]["score"] == 0 and out[i]["rejected"] for i in (4, 5, 6, 7))
    assert langid.identify(edge_docs, model).count() == edge_docs.count()
    empty = langid.fit(no_docs)
    assert empty.languages == [] and langid.identify(no_docs, empty).count() == 0
    assert {r["lang_pred"] for r in langid.identify(edge_docs, empty).collect()} == {"und"}
    assert langid.drop_rejected(edge_docs, model).columns == edge_docs.columns
    assert langid.drop_rejected(no_docs, model).count() == 0


def test_long_texts_are_counted_in_pieces(monkeypatch):
    """Pieces overlap by two letters, so no n-gram is lost; single letters at the seams count again."""
    text = "Ein längerer Text, mit Wörtern... und 123 Zahlen; noch einer " * 9
    whole = langid.counts(text)
    monkeypatch.setattr(langid, "PIECE", 64)
    pieces = langid.counts(text)
    assert (pieces[whole > 0] >= whole[whole > 0]).mean() > 0.95
    assert langid.unit(langid.damped(whole)) @ langid.unit(langid.damped(pieces)) > 0.98


def grams_by_hand(text):
    """Counts of the n-grams of one to three letters, words in lower case with a blank on both sides."""
    words, word = [], ""
    for c in text or "":
        low = c.lower() if len(c.lower()) == 1 else c
        if c.isalpha():
            word += low
        elif word:
            words, word = [*words, word], ""
    words += [word] if word else []
    if not words:
        return None
    joined, found = " " + " ".join(words) + ("" if text[-1].isalpha() else " ") + " ", {}  # the text's end is one more
    for n in (1, 2, 3):
        for i in range(len(joined) - n + 1):
            code = 0
            for c in joined[i : i + n]:
                code = code << 21 | ord(c)
            place = (code * 0x9E3779B97F4A7C15 % 2**64) >> (64 - langid.BITS)
            found[place] = found.get(place, 0) + 1
    return found


def test_predictions_by_hand(spark, edge_docs):
    """Each text's n-grams counted one by one, and its cosine with every centroid."""
    table = docs(spark).select("doc_id", "lang", "text").unionByName(edge_docs.where("doc_id IS NULL OR doc_id <> 8 AND doc_id <> 9").select("doc_id", "lang", "text"))
    model = langid.fit(table)
    got = langid.identify(table, model).collect()
    texts = {(r["doc_id"], r["text"]) for r in table.collect()}
    by_id = {}
    for doc_id, text in texts:
        by_id.setdefault(doc_id, []).append(text)
    assert len(got) == table.count()
    checked = 0
    for r in got:
        if len(by_id[r["doc_id"]]) > 1:
            continue
        counts = grams_by_hand(by_id[r["doc_id"]][0])
        if counts is None:
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
            continue
        weights = {p: n**0.5 * float(model.idf[p]) for p, n in counts.items()}
        size = sum(w * w for w in weights.values()) ** 0.5
        cosines = [sum(w * float(c[p]) for p, w in weights.items()) / size for c in model.centroids]
        best = max(cosines)
        assert abs(r["score"] - best) < 1e-4
        assert r["lang_pred"] in {model.languages[i] for i, x in enumerate(cosines) if x > best - 1e-5}
        assert r["rejected"] == (best < model.least) or abs(best - model.least) < 1e-5
        checked += 1
    assert checked > 150


def test_too_many_languages_are_refused(spark):
    rows = [(i, f"l{i % 9}", f"text number {i}") for i in range(200)]
    table = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    with pytest.raises(ValueError, match="9 languages"):
        langid.fit(table, most_languages=8)
    assert len(set(langid.fit(table, most_languages=9).languages)) == 9


def test_the_sample_is_bounded(spark):
    rows = langid.training_sample(docs(spark, "/root/testdata/sf0.01"), 20).groupBy("lang").count().collect()
    assert len(rows) == 4 and all(0 < r["count"] <= 20 for r in rows)


TEXTS = ["", "plain words", "It's 12,345.67 — naïve 😀\n\n  tabs\t\tand   spaces  ", "<|endoftext|> inside <|endoftext|>", "ß中文 日本語 한국어  \x85x", "a" * 3000, " " * 5000, "don't we'LL they're\r\n\r\n\x0b\x1c\x00", "ᾼ ǅ ½ ² ٣ ­ ﻿"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_by_hand(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def test_ids_equal_those_of_the_tokenizers_file(spark, tokenizer):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    for text in TEXTS + [r["text"] for r in docs(spark).limit(60).collect()]:
        assert packing.token_ids(text, path).tolist() == ids_by_hand(tokenizer, text)


@pytest.mark.parametrize("run", [" " * 1_100_000, "\n" * 1_000_100, " \n\u3000\x85" * 280_000])
def test_ids_of_a_million_blanks(tokenizer, run):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    for text in (run, f"a{run}", f"{run}b", f"it {run}'s {run}<|endoftext|>{run}.", f"x{run}\x1cy {run[:600_000]}"):
        assert packing.token_ids(text, path).tolist() == ids_by_hand(tokenizer, text)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9])
def test_ids_at_the_edges_of_blank_runs(tokenizer, monkeypatch, n):
    """The same with short runs, over all texts of TEXTS and every neighbour."""
    monkeypatch.setattr(packing, "BLANK_RUN", n)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    near = ["", "a", "1", "!", "'s", "\x1c", "é", "<|endoftext|>"]
    runs = [" ", "  ", "\n", " \n", "\t  ", "   \u2003", "\r\n\r\n\xa0"]
    for text in TEXTS + [x + r + y for x in near for r in runs for y in near]:
        assert packing.token_ids(text, path).tolist() == ids_by_hand(tokenizer, text)


def check_packed(rows, texts, tokenizer, capacity=2048):
    """Every piece is right, and sequences are filled without gaps or overlaps."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for doc_id, text in texts.items():
        ids, own, at = ids_by_hand(tokenizer, text), sorted(by_doc.pop(doc_id), key=lambda r: r["piece"]), 0
        assert [r["piece"] for r in own] == list(range(len(own))) and len(own) == -(-len(ids) // capacity)
        for r in own:
            assert r["start"] == at and (r["piece"] == 0 or r["length"] == capacity)
            part = np.array(ids[at : at + r["length"]], "<u4")
            assert r["ids_crc32"] == zlib.crc32(part.tobytes())
            at += r["length"]
        assert at == len(ids)
    assert not by_doc
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_packing_of_the_given_documents(spark, tokenizer):
    table = docs(spark)
    rows = packing.pack(packing.pieces(table)).collect()
    n = check_packed(rows, {r["doc_id"]: r["text"] for r in table.collect()}, tokenizer)
    assert n <= 1.02 * -(-sum(r["length"] for r in rows) // 2048) + 1


def test_packing_on_edges(edge_docs, no_docs, tokenizer):
    unique = edge_docs.dropDuplicates(["doc_id"])
    rows = packing.pack(packing.pieces(unique)).collect()
    check_packed(rows, {r["doc_id"]: r["text"] for r in unique.collect()}, tokenizer)
    assert packing.pack(packing.pieces(no_docs)).count() == 0
    both = packing.pack(packing.pieces(edge_docs)).collect()
    assert sum(r["doc_id"] == 2 for r in both) == 2
    places = [(r["sequence_id"], r["offset"]) for r in both]
    assert len(set(places)) == len(places)


@pytest.mark.parametrize("seed", range(6))
def test_plans_use_up_the_histogram(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.integers(5, 300))
    histogram = np.zeros(capacity + 1, np.int64)
    lengths = rng.integers(1, capacity + 1, 60)
    np.add.at(histogram, lengths, rng.integers(1, 1 + 10 ** int(rng.integers(1, 6)), 60))
    used = np.zeros_like(histogram)
    sequences = 0
    for pattern, n in packing.plan(histogram, capacity):
        assert sum(pattern) <= capacity and n > 0
        np.add.at(used, list(pattern), n)
        sequences += n
    assert np.array_equal(used, histogram)
    # no worse than best fit alone, which is within 11/9 of the best
    alone = sum(n for _, n in packing.best_fit(histogram.copy(), capacity))
    assert sequences <= 1.05 * alone + 1
    runs = packing.slots(packing.plan(histogram, capacity), capacity)
    assert (np.diff(runs["length"] * 10**9 + runs["first"]) > 0).all()


@pytest.mark.parametrize("low, high", [(400, 950), (300, 2048)])
def test_plans_take_the_best_number_of_middles(low, high):
    histogram = np.bincount(np.random.default_rng(0).integers(low, high, 20000), minlength=2049)
    each = [sum(n for _, n in packing.plan(histogram, 2048, (m,))) for m in (8, 32)]
    assert sum(n for _, n in packing.plan(histogram)) == min(each) < max(each)


@pytest.mark.parametrize("low, high, over", [(400, 601, 0.01), (300, 681, 0.005), (100, 601, 0.005), (50, 301, 0.005), (300, 2048, 0.03)])
def test_plans_of_short_pieces_are_near_the_least(low, high, over):
    """Pieces of which a sequence takes four and more have patterns, too, and no plan is worse than best fit alone."""
    lengths = np.random.default_rng(1).integers(low, high, 20000)
    histogram = np.bincount(lengths, minlength=2049)
    chosen = packing.plan_or_best_fit(histogram)
    used = np.zeros_like(histogram)
    for pattern, n in chosen:
        assert sum(pattern) <= 2048
        np.add.at(used, list(pattern), n)
    assert np.array_equal(used, histogram)
    sequences, least = sum(n for _, n in chosen), -(-int(lengths.sum()) // 2048)
    assert sequences <= (1 + over) * least
    assert sequences <= sum(n for _, n in packing.best_fit(histogram.astype(np.int64), 2048))


def test_least_squares_come_down_to_the_histogram():
    """Also where every length is in many patterns: the misses shrink to little."""
    histogram = np.bincount(np.random.default_rng(3).integers(300, 681, 20000), minlength=2049).astype(float)
    rows = packing.patterns(np.flatnonzero(histogram), 2048, 32, 6)
    x = packing.least_squares(rows, histogram)
    made = sum(np.bincount(rows[:, j], x, len(histogram)) for j in range(rows.shape[1]))
    made[0] = 0
    assert (x >= 0).all() and np.abs(made - histogram).sum() < 0.05 * histogram.sum()
    assert all(set(r[r > 0]) <= set(np.flatnonzero(histogram)) and r.sum() == 2048 for r in rows)


def test_tokens_meet_the_targets(spark):
    table = docs(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").selectExpr("doc_id", "cast(quality AS string) AS domain")
    for targets in ({"1": 0.95, "0": 0.05}, {"1": 0.5, "0": 0.5}):
        for limit in (None, 1.0):
            rated = mixing.rates(table, labels, targets, max_rate=limit).collect()
            totals = [sum(r["rate"] * r["tokens"] * r["p"][d] for r in rated) for d in (0, 1)]
            assert abs(totals[0] / sum(totals) - targets["1"]) < 0.01
            assert all(r["rate"] >= 0 and (limit is None or r["rate"] <= limit) for r in rated)
            assert all(abs(sum(r["p"]) - 1) < 0.03 for r in rated)


def test_the_classifier_is_right_on_labelled_documents(spark):
    table = docs(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").selectExpr("doc_id", "cast(quality AS string) AS domain")
    train, test = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    rated = mixing.rates(table, train, {"1": 0.5, "0": 0.5}).join(test, "doc_id").collect()
    assert sum((r["p"][0] > 0.5) == (r["domain"] == "1") for r in rated) / len(rated) > 0.9


def test_rates_equal_a_local_descent(spark):
    """The same descent with numpy over single documents."""
    table = docs(spark)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").selectExpr("doc_id", "cast(quality AS string) AS domain")
    rows = mixing.rates(table, labels, {"1": 0.7, "0": 0.3}, max_rate=1.0).collect()
    p, t = np.array([r["p"] for r in rows]), np.array([r["tokens"] for r in rows], float)
    now, share = p.T @ t, np.array([0.7, 0.3])
    total, everything = (now / share).min(), now.sum()
    m = np.linalg.pinv((p * t[:, None]).T @ p / everything + 1e-6 * np.eye(2))
    w = np.ones(len(t))
    for _ in range(25):
        miss = (p.T @ (t * w) - share * total) / everything
        if abs(miss).max() < 1e-4:
            break
        w = np.clip(w - p @ (m @ miss), 0, 1)
    assert np.allclose(w, [r["rate"] for r in rows], atol=1e-6)


def test_mixing_on_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, "1"), (10, "0"), (None, "1"), (3, None), (8, "other")], "doc_id bigint, domain string")
    for known in (labels, labels.limit(0)):
        rated = mixing.rates(edge_docs, known, {"1": 0.5, "0": 0.5})
        assert rated.count() == edge_docs.count()
        assert rated.where("rate < 0 OR rate IS NULL").count() == 0
        assert rated.where("doc_id IN (4, 5, 6) AND tokens > 0").count() == 0
    assert mixing.mix(edge_docs, labels, {"1": 0.5, "0": 0.5}, max_rate=None).columns == edge_docs.columns
    assert mixing.rates(no_docs, labels, {"1": 0.5, "0": 0.5}).count() == 0
    assert mixing.mix(no_docs, labels, {"1": 0.5, "0": 0.5}).count() == 0


def test_copies_follow_the_rates(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit(1.3).alias("rate"))
    out = df.select(mixing.copies(F.col("rate"), F.col("doc_id")).alias("n")).groupBy("n").count().collect()
    counts = {r["n"]: r["count"] for r in out}
    assert counts.keys() == {1, 2} and abs(counts[2] / 20_000 - 0.3) < 0.02


def test_mixing_runs_no_python(edge_docs, spark):
    labels = spark.createDataFrame([(1, "1")], "doc_id bigint, domain string")
    text = mixing.mix(edge_docs, labels, {"1": 0.5, "0": 0.5})._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text


def top_by_hand(rows, queries, k):
    good = [(i, np.floor(256 * np.array(v, float))) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q in sorted(set(queries)):
        own = next((v for i, v in good if i == q), None)
        if own is None:
            continue
        scores = []
        for i, v in good:
            if i != q:
                n = min(len(v), len(own))
                scores.append((-int(sum(int(a) * int(b) for a, b in zip(own[:n], v[:n], strict=True))), i))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return out


@pytest.mark.parametrize(("shard", "block"), [(4096, 512), (7, 3), (50, 1)])
def test_top_k_equals_brute_force(spark, shard, block):
    rng = np.random.default_rng(shard)
    rows = [(i, rng.normal(size=12).round(2).tolist()) for i in range(300)]
    rows += [(300 + i, rows[5][1]) for i in range(20)]  # ties
    rows += [(400, None), (401, [None] * 12), (402, [float("nan")] * 12), (403, [float("inf")] + [0.0] * 11), (None, rows[0][1]), (404, []), (405, [0.0] * 12), (406, [1.0, -1.0])]
    df = with_clashes(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"))
    queries = [0, 5, 50, 100, 301, 400, 402, 404, 405, 406]
    found = topk.top_k(df, df.where(F.col("vec_id").isin(queries)), 5, shard_rows=shard, block_rows=block)
    exact = [(i, np.float32(v).tolist() if v is not None and None not in v else v) for i, v in rows]
    assert sorted(map(tuple, found.select("query_id", "rank", "vec_id", "score").collect())) == top_by_hand(exact, queries, 5)


@pytest.mark.parametrize("block_bytes", [1, 700, 1 << 20])
def test_top_k_in_blocks_of_queries(spark, block_bytes):
    """Any size of the blocks gives the same; ties across shards and tasks go to the smaller id."""
    rng = np.random.default_rng(9)
    rows = [(i, rng.integers(-2, 3, 6).astype(float).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(5)
    found = topk.top_k(df, df.where("vec_id % 20 = 0"), 5, shard_rows=16, block_rows=3, block_bytes=block_bytes)
    assert sorted(map(tuple, found.collect())) == top_by_hand(rows, range(0, 400, 20), 5)


def test_top_k_refuses_scores_that_a_long_cannot_hold(spark):
    rows = [(1, [3e9, 3e9]), (2, [4e9, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    with pytest.raises(ValueError, match="beyond a long"):
        topk.top_k(df, df)
    assert topk.top_k(df, df, scale=0.1).count() == 2


def test_a_better_threshold_finds_the_same():
    rng = np.random.default_rng(4)
    matrix = rng.integers(-50, 50, (500, 8)).astype(float)
    shard, q = topk.Shard(np.arange(500), matrix, 8), matrix[3]
    every = shard.best(3, q, 5)
    for n in range(5):
        floor = float(every[n][1])
        got = shard.best(3, q, 5, floor)
        assert [r for r in got if r[1] >= floor] == [r for r in every if r[1] >= floor]
    assert shard.best(3, q, 5, 1e9) == []


def test_top_k_of_few_and_of_large_numbers(spark):
    rows = [(1, [1e6, 2e6]), (2, [-3e9, 1e9]), (3, [5e9, 5e9])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    small = df.where("vec_id = 1")
    assert topk.top_k(small, small).count() == 0
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0
    found = topk.top_k(df, small, scale=1.0).collect()
    assert sorted(map(tuple, found)) == [(1, 1, 3, 15 * 10**15), (1, 2, 2, -(10**15))]


def test_max_score_probes_less_than_all(monkeypatch):
    """On vectors with few strong components most terms are not essential."""
    rng = np.random.default_rng(0)
    matrix = np.zeros((2000, 64))
    for i in range(2000):
        matrix[i, rng.integers(0, 64, 3)] = rng.integers(50, 256, 3)
    shard = topk.Shard(np.arange(2000), matrix, 64)
    seen = []
    scores = shard.scores
    monkeypatch.setattr(shard, "scores", lambda rows, q: seen.append(len(rows)) or scores(rows, q))
    got = shard.best(-1, matrix[7] * 1.0, 5)
    want = sorted(((int(i), int(s)) for i, s in enumerate(matrix @ matrix[7])), key=lambda r: (-r[1], r[0]))[:5]
    assert got == want and max(seen) < 500
