"""Near-duplicates, top-k search, language ID and mixing against brute-force versions."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventloom.llm import langid, minhash, mixing, queries, topk

from .edge import crc, edge_docs, edge_rows, no_docs, read_documents, words

# ---------------------------------------------------------------- near-duplicates


def shingle_set(text):
    w = words(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(rows, similarity=85):
    """Per row (id, set size, component): all pairs on exact sets, then union-find."""
    sets = [(d, shingle_set(t)) for d, t, *_ in rows]
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if a is not None and b is not None and s and t and 100 * len(s & t) >= similarity * len(s | t):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return Counter((d, len(s), None if d is None else find(d)) for d, s in sets)


def near_rows(n=60, seed=3):
    """A chain of copies with more and more changed words, small groups, and texts of their own."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(300)]
    rows = []
    for i in range(n):
        if i % 3 == 0:
            base = list(base)
            for _ in range(rng.randrange(9)):
                base[rng.randrange(len(base))] = f"x{rng.randrange(10**6)}"
        rows.append((1000 - 7 * i, " ".join(base) if i % 4 else " ".join(f"y{rng.randrange(99)}" for _ in range(80))))
    return rows


@pytest.mark.parametrize("block_bytes", [minhash.BLOCK_BYTES, 20_000])
def test_components_match_brute_force(spark, monkeypatch, block_bytes):
    """Also with blocks so small that a bucket is spread over many of them."""
    monkeypatch.setattr(minhash, "BLOCK_BYTES", block_bytes)
    rows = [(d, t) for d, t, *_ in edge_rows()] + near_rows()
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_components(rows)
    assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"]) for r in got)


def test_near_duplicates_empty_and_other_columns(spark):
    assert minhash.near_duplicates(no_docs(spark)).collect() == []
    assert minhash.one_of_each(no_docs(spark)).collect() == []
    docs = edge_docs(spark)
    rest = minhash.one_of_each(docs)
    assert rest.columns == docs.columns
    kept = {r["doc_id"] for r in minhash.near_duplicates(docs).where("kept").collect()}
    assert {r["doc_id"] for r in rest.collect()} == kept


@pytest.mark.parametrize("similarity", [40, 60, 70, 85, 100])
def test_signatures_rule_out_no_pair_at_the_threshold(similarity):
    """200 pairs at the threshold exactly, all sharing a bucket: signatures let every one through to its full sets."""
    a, b = minhash.hash_family(125, 3)
    rng = np.random.default_rng(similarity)
    for _ in range(200):
        x = rng.integers(0, 1 << 63, 400, np.uint64)
        both, one = 4 * similarity, (400 - 4 * similarity) // 2
        sets = [np.unique(x[: both + one]), np.unique(np.concatenate([x[:both], x[both + one : both + 2 * one]]))]
        sigs = np.stack([minhash.signature(s, a, b) for s in sets])
        unit = minhash.Unit(np.array([len(s) for s in sets]), np.arange(2), np.zeros(2, int), sigs, 0, 5, similarity)
        assert minhash.unit_candidates(unit).all() and minhash.unit_links(unit, [1, 2], sets) == [(1, 2)]


def test_signature_estimates_similarity():
    a, b = minhash.hash_family(125, 1)
    x = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 2000, np.uint64))
    y = np.concatenate([x[200:], np.random.default_rng(2).integers(0, 1 << 63, 200, np.uint64)])
    alike = (minhash.signature(x, a, b) == minhash.signature(y, a, b)).mean()
    assert abs(alike - 1800 / 2200) < 0.12


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=30))
def test_stars_find_components(pairs):
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    root = {x: {x} for p in pairs for x in p}
    for x, y in pairs:
        joined = root[x] | root[y]
        for z in joined:
            root[z] = joined
    got = {r["node"]: r["label"] for r in minhash.connected_components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {x: min(s) for x, s in root.items() if len(s) > 1}


# ---------------------------------------------------------------- top-k


def brute_top(rows, k=5, every=50):
    good = [(i, np.floor(256 * np.array(v, np.float64)).astype(np.int64)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in good:
        if q % every == 0:
            scores = [(-sum(int(x) * int(y) for x, y in zip(a, b)), i) for i, b in good if i != q]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return Counter(out)


def test_top_k_edge(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(130)] + [(i, [0.5] * 8) for i in range(200, 260)]
    rows += [(300, None), (301, [1.0, None]), (302, [float("nan")] * 8), (303, [float("inf")] * 8), (None, [1.0] * 8)]
    rows += [(304, []), (305, [1.0, 2.0]), (306, [0.0] * 8), (307, [1e6] * 8)]
    df = spark.createDataFrame([(*r, "x", 9) for r in rows], "vec_id long, embedding array<double>, score string, rank int").repartition(5)
    got = topk.top_k(df, F.col("vec_id") % 50 == 0, block=32).collect()
    assert Counter(map(tuple, got)) == brute_top(rows)


def test_top_k_few_rows_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    assert topk.top_k(spark.createDataFrame([], schema), F.col("vec_id") % 50 == 0).collect() == []
    assert topk.top_k(spark.createDataFrame([(0, [1.0])], schema), F.col("vec_id") % 50 == 0).collect() == []
    got = topk.top_k(spark.createDataFrame([(0, [1.0]), (1, [2.0])], schema), F.col("vec_id") % 50 == 0).collect()
    assert list(map(tuple, got)) == [(0, 1, 1, 256 * 512)]
    with pytest.raises(Exception, match="64-bit"):
        topk.top_k(spark.createDataFrame([(0, [1e16]), (1, [1e16])], schema), F.col("vec_id") % 50 == 0).collect()


def test_top_k_sends_no_blocks_to_the_driver(spark):
    """What a job may send to the driver is held at 1 MB: before, queries came there once for each candidate block."""
    v = np.random.default_rng(6).normal(size=(4000, 64))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>").repartition(4)
    conf, key = spark.sparkContext._jsc.sc().conf(), "spark.driver.maxResultSize"
    conf.set(key, "1m")
    try:
        got = topk.top_k(df, F.col("vec_id") % 50 == 0, block=16).collect()
    finally:
        conf.remove(key)
    w = np.floor(256 * v).astype(np.int64)
    scores = w[::50] @ w.T
    scores[np.arange(80), np.arange(0, 4000, 50)] = -(2**62)
    want = [(50 * q, r + 1, int(i), int(scores[q, i])) for q in range(80) for r, i in enumerate(np.lexsort((np.arange(4000), -scores[q]))[:5])]
    assert Counter(map(tuple, got)) == Counter(want)


@pytest.mark.parametrize("size", [1.0, 300.0, 1e5, 1e6])  # scores in 32-bit and 64-bit floats and in integers
def test_top_k_in_groups(spark, monkeypatch, size):
    monkeypatch.setattr(topk, "HELD", 100)  # many groups of queries, each meets runs of two blocks
    monkeypatch.setattr(topk, "RUN", 2)
    rng = np.random.default_rng(7)
    rows = [(int(i), [float(x) * size for x in rng.normal(size=6) * (rng.random(6) < 0.3)]) for i in range(400)]
    rows += [(i, [size * 0.5] * 6) for i in range(1000, 1100)] + [(i, [size] + [0.0] * (i % 6)) for i in range(1100, 1130)] + [(1200, [float(2**18)] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(6)
    got = topk.top_k(df, F.col("vec_id") % 5 == 0, k=7, block=16).collect()
    assert Counter(map(tuple, got)) == brute_top(rows, k=7, every=5)


def test_top_k_ids_in_several_rows(spark):
    rng = np.random.default_rng(8)
    rows = [(i % 40, rng.integers(-2, 3, 4).astype(float).tolist()) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = topk.top_k(df, F.col("vec_id") % 10 == 0, block=32).collect()
    assert Counter(map(tuple, got)) == brute_top(rows, every=10)


# ---------------------------------------------------------------- language ID


def brute_grams(text):
    x = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    n = Counter()
    for w in x:
        padded = f"\x01{w}\x01"
        n.update(w)
        n.update(padded[i : i + 2] for i in range(len(padded) - 1))
        n.update(padded[i : i + 3] for i in range(len(padded) - 2))
    return n


def brute_languages(rows, size=langid.PROFILE):
    ranked = lambda n: [g for g, _ in sorted(n.items(), key=lambda x: (-x[1], len(x[0]), x[0]))[:size]]
    sums = defaultdict(Counter)
    for d, t, lang, *_ in rows:
        if crc("" if d is None else d) % 3 != 1 and t is not None and lang is not None:
            sums[lang].update(brute_grams(t))
    profiles = {lang: {g: i for i, g in enumerate(ranked(n))} for lang, n in sorted(sums.items()) if n}
    out = Counter()
    for d, t, *_ in rows:
        own, pred, score = ranked(brute_grams(t or "")), "und", 0.0
        if own and profiles:
            apart = {lang: sum(abs(p[g] - i) if g in p else size for i, g in enumerate(own)) for lang, p in profiles.items()}
            pred = min(apart, key=apart.get)
            score = 1 - apart[pred] / (size * len(own))
        out[d, crc("" if d is None else d) % 3 == 1, pred, round(score, 9)] += 1
    return out


def test_languages_match_brute_force(spark):
    got = langid.identify_languages(edge_docs(spark)).collect()
    assert Counter((r[0], r[1], r[2], round(r[3], 9)) for r in got) == brute_languages(edge_rows())
    assert langid.identify_languages(no_docs(spark)).collect() == []


def test_language_query_and_held_out_accuracy(spark):
    rows = [(d["doc_id"], d["text"], d["lang"]) for d in read_documents(SF_SMALL)]
    got = queries.op3_language_id(spark, SF_SMALL).collect()
    assert Counter((r["doc_id"], r["held_out"], r["lang_pred"], round(r["score"], 9)) for r in got) == brute_languages(rows)
    lang = {d: x for d, _, x in rows}
    right = [r["lang_pred"] == lang[r["doc_id"]] for r in got if r["held_out"] and lang[r["doc_id"]]]
    assert sum(right) >= 0.95 * len(right)


# ---------------------------------------------------------------- mixing


def brute_quotas(tokens, limit):
    """Weights and quotas without a budget: the exponent that lets the smallest source be passed over ``limit`` times."""
    top, least = max(tokens), min(tokens)
    alpha = 1.0 if top == least or limit <= 1 else max(0.0, 1 - math.log(limit) / math.log(top / least))
    raw = [t**alpha for t in tokens]
    return [x / sum(raw) for x in raw], [max(round((t / top) ** (alpha - 1) * t), t) for t in tokens]


def source_sums(spark, tokens):
    return spark.createDataFrame([(f"s{i}", t, 1) for i, t in enumerate(tokens)], "source string, tokens long, n_docs long")


def entropy_share(tokens, alpha):
    top = max(tokens)
    raw = [(t / top) ** alpha for t in tokens]
    return -sum(x / sum(raw) * math.log(x / sum(raw)) for x in raw if x) / math.log(len(tokens))


@pytest.mark.parametrize("tokens", [[1, 10**6], [5, 5, 5], [3, 40, 500, 6000, 10**6], [7]])
@pytest.mark.parametrize("limit", [1.0, 1.5, 4.0])
def test_quotas_meet_repeat_limit(spark, tokens, limit):
    rows = sorted(mixing.quotas(source_sums(spark, tokens), None, repeat_limit=limit).collect(), key=lambda r: int(r["of"][1:]))
    weights, want = brute_quotas(tokens, limit)
    assert all(abs(r["weight"] - w) < 1e-9 for r, w in zip(rows, weights))
    assert all(abs(r["quota"] - q) <= 1 and r["full"] == r["quota"] // t for r, q, t in zip(rows, want, tokens))


@pytest.mark.parametrize("share", [0.1, 0.7, 0.95, 1.0])
def test_temperature_meets_entropy(spark, share):
    tokens = [3, 40, 500, 6000, 10**6]
    alpha = mixing.temperature(source_sums(spark, tokens), entropy=share)
    assert entropy_share(tokens, alpha) >= share - 1e-9
    assert alpha == 1.0 or entropy_share(tokens, alpha + 1e-6) < share + 1e-9


@pytest.mark.parametrize("budget, limit", [(2000, 2.0), (10**6, 1.2), (10, 5.0)])
def test_temperature_with_a_budget(spark, budget, limit):
    tokens = [30, 400, 5000, 10**6]
    alpha = mixing.temperature(source_sums(spark, tokens), budget, repeat_limit=limit)
    passes = lambda a: max(budget * t**a / sum(u**a for u in tokens) / t for t in tokens)
    assert passes(alpha) <= limit * (1 + 1e-9) or alpha == 1.0
    assert alpha == 0.0 or passes(alpha - 1e-6) > limit * (1 - 1e-4)
    rows = mixing.quotas(source_sums(spark, tokens), budget, repeat_limit=limit).collect()
    assert abs(sum(r["quota"] for r in rows) - budget) <= len(tokens)


def test_many_sources(spark):
    """More sources than one would bring to the driver; each of the first thousand also has a second, longer text."""
    n = 200_000
    docs = spark.range(n + 1000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < n, "one two").otherwise("w " * 50).alias("text"), F.concat(F.lit("site"), F.col("id") % n).alias("source")
    )
    got = mixing.mix_sources(docs, repeat_limit=2.0)
    sums = got.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    kinds = {(r["tokens"], r["rows"]): r["n"] for r in sums.groupBy("tokens", "rows").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert kinds == {(54, 2): 1000, (6, 2): n - 1000}  # small ones twice, the others once
    mixed = mixing.mixed_documents(docs, repeat_limit=2.0)
    assert mixed.count() == 2 * 1000 + 2 * (n - 1000)
    assert 0.5 < entropy_share([3] * 9 + [54], mixing.temperature(source_sums(spark, [3] * 9 + [54]), entropy=0.9)) <= 1


def brute_tokens(text):
    return len(words(text)) + 1


def check_mix(got, rows, limit=mixing.REPEAT_LIMIT):
    sums, given_ = Counter(), Counter()
    for d, t, s in rows:
        sums[s] += brute_tokens(t)
        given_[d, s] += 1
    tokens = list(sums.values())
    weights, quota = brute_quotas(tokens, limit)
    used, turns = Counter(), defaultdict(Counter)
    for r in got:
        used[r["source"]] += r["n_tokens"]
        turns[r["source"], r["turn"]][r["doc_id"], r["source"]] += 1
    longest = defaultdict(int)
    for d, t, s in rows:
        longest[s] = max(longest[s], brute_tokens(t))
    weight = dict(zip(sums, weights))
    assert all(abs(r["weight"] - weight[r["source"]]) < 1e-9 for r in got)
    # Every block has its share of every source, but for a text at either end.
    blocks, n_blocks = Counter(), 1 + max((r["block"] for r in got), default=0)
    for r in got:
        blocks[r["block"], r["source"]] += r["n_tokens"]
    for s, q in zip(sums, quota):
        assert q - longest[s] - 1 < used[s] <= q + 1
        assert all(abs(blocks[k, s] - q / n_blocks) <= 2 * longest[s] + 1 for k in range(n_blocks))
        full = q // sums[s]
        for turn in range(full):
            assert turns[s, turn] == Counter({k: n for k, n in given_.items() if k[1] == s})
        assert not turns[s, full + 1] and all(n <= given_[k] for k, n in turns[s, full].items())
    slots = defaultdict(list)
    for r in got:
        slots[r["block"]].append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_mixing_query(spark):
    got = queries.op10_temperature_mixing(spark, SF_SMALL).collect()
    check_mix(got, [(d["doc_id"], d["text"], d["source"]) for d in read_documents(SF_SMALL)])


def test_mixing_edge(spark):
    got = mixing.mix_sources(edge_docs(spark), repeat_limit=3.0, block_tokens=5000)
    check_mix(got.collect(), [(d, t, s) for d, t, _, s, *_ in edge_rows()], 3.0)
    again = mixing.mix_sources(edge_docs(spark, 2), repeat_limit=3.0, block_tokens=5000)
    assert sorted(map(str, got.collect())) == sorted(map(str, again.collect()))
    assert mixing.mix_sources(no_docs(spark)).collect() == [] and mixing.mixed_documents(no_docs(spark)).collect() == []


def test_mixed_documents_follow_the_plan(spark):
    docs = edge_docs(spark).withColumn("cut", F.lit("c"))
    got = mixing.mixed_documents(docs, repeat_limit=3.0)
    assert got.columns == docs.columns
    plan = mixing.mix_sources(docs, repeat_limit=3.0).collect()
    assert Counter((r["doc_id"], r["source"]) for r in got.collect()) == Counter((r["doc_id"], r["source"]) for r in plan)


def test_blocks_have_the_weights(spark):
    rows = [(i, " ".join(["w"] * 9), "a" if i < 600 else "b") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix_sources(docs, entropy=1.0, block_tokens=1500).collect()
    share = defaultdict(Counter)
    for r in got:
        share[r["block"]][r["source"]] += r["n_tokens"]
    assert len(share) == 8 and all(abs(c["a"] - c["b"]) <= 40 for c in share.values())


def test_scratch_tables_go(spark):
    """Of what an operator writes, only what its result reads stays; an outer scope removes that too."""
    import os

    from eventloom.llm import class_lm
    from eventloom.llm.common import Scratch, written
    from eventloom.session import ensure_checkpoint_dir

    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    there = lambda: {f for f in os.listdir(base) if os.path.isdir(f"{base}/{f}")}
    before, docs = there(), edge_docs(spark).cache()
    for run, left in ((minhash.near_duplicates, 2), (class_lm.score_documents, 1)):
        with Scratch() as tables:
            now = there()
            out = run(docs)
            assert len(there() - now) == left
            kept = tables.keep(written(out, "result"))
        assert len(there() - now) == 1 and kept.count() == len(edge_rows())
    with Scratch() as tables:
        first = written(spark.range(3), "one")
        tables.drop(first)
        with pytest.raises(ZeroDivisionError), Scratch():
            written(spark.range(3), "two")
            raise ZeroDivisionError
    assert len(there() - before) == 2
