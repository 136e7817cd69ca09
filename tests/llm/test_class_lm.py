"""Class bigram scores: the contract's counts against brute force, and the model against the unigram on held-out text."""

import math
from collections import Counter

import numpy as np
import pytest
from conftest import SF_SMALL

from eventloom.llm import class_lm, queries

from .edge import crc, edge_docs, edge_rows, no_docs, read_documents, words


def brute_base(rows):
    c = Counter()
    for d, t in rows:
        if crc("" if d is None else d) % 7 != 2:
            c.update(words(t) + [b""])
    n, v = sum(c.values()), len(c)
    out = []
    for d, t in rows:
        w = words(t) + [b""]
        base = sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)
        out.append((d, crc("" if d is None else d) % 7 == 2, len(w), sum(c[x] > 0 for x in w), n, round(base, 5)))
    return Counter(out)


def counts(got):
    return Counter((r[0], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in got)


@pytest.mark.parametrize("chunk_tokens", [class_lm.CHUNK_TOKENS, 500])
def test_counts_on_edge_cases(spark, chunk_tokens):
    got = class_lm.score_documents(edge_docs(spark), chunk_tokens=chunk_tokens).collect()
    assert counts(got) == brute_base([r[:2] for r in edge_rows()])
    assert all(r["score"] <= 0 and math.isfinite(r["score"]) for r in got)


def test_empty(spark):
    assert class_lm.score_documents(no_docs(spark)).collect() == []
    got = class_lm.score_documents(spark.createDataFrame([(10, "a b")], "doc_id long, text string")).collect()
    assert crc(10) % 7 == 2 or got[0]["train_tokens"] == 3


def test_chunks_do_not_change_scores(spark):
    a = class_lm.score_documents(edge_docs(spark)).collect()
    b = class_lm.score_documents(edge_docs(spark, 2), chunk_tokens=300).collect()
    key = lambda rows: Counter((r[0], round(r["score"], 6)) for r in rows)
    assert key(a) == key(b)


def test_query(spark):
    rows = [(d["doc_id"], d["text"]) for d in read_documents(SF_SMALL)]
    got = queries.op9_class_lm(spark, SF_SMALL).collect()
    assert counts(got) == brute_base(rows)
    out = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def brute_likelihood(bigrams, own):
    n = own.max() + 1
    t = np.zeros((n, n))
    for i in range(len(own)):
        for j in range(len(own)):
            t[own[i], own[j]] += bigrams[i, j]
    f = lambda x: (x[x > 0] * np.log(x[x > 0])).sum()
    return f(t.ravel()) - f(t.sum(0)) - f(t.sum(1))


def test_exchange_moves_up_and_stops_at_a_local_best():
    rng = np.random.default_rng(4)
    kind = rng.integers(0, 3, 30)
    bigrams = rng.poisson(np.array([[0.2, 9, 1], [1, 0.2, 9], [9, 1, 0.2]])[kind][:, kind]).astype(float)
    first = np.arange(30) % 3
    own = class_lm.exchange(bigrams, first, np.arange(28), 3, sweeps=50)
    best = brute_likelihood(bigrams, own)
    assert best > brute_likelihood(bigrams, first) and list(own[28:]) == list(first[28:])
    for w in range(28):
        for b in range(3):
            other = own.copy()
            other[w] = b
            assert brute_likelihood(bigrams, other) <= best + 1e-6


def test_model_is_a_distribution():
    """From any class, the probabilities of all known words, the end and the unknown word add up to one at most."""
    n_words, n = 8, class_lm._WORDS + 8 + 2 * class_lm._BANDS
    rng = np.random.default_rng(1)
    totals = np.zeros(n)
    totals[1 : 2 + n_words] = rng.integers(9, 99, n_words + 1)
    totals[2 + n_words : 2 + n_words + 6] = [5, 0, 4, 9, 8, 0]
    bigrams = np.outer(totals, totals) * rng.random((n, n))
    m = class_lm.Model(bigrams, totals, n_words, 3)
    sums = np.bincount(m.classes, totals, m.n)
    used = np.flatnonzero(sums > 0).tolist() + [m.classes[class_lm._UNKNOWN]]
    mass = 10 ** m.transition[:, used]
    assert (mass.sum(1) <= 1 + 1e-9).all() and (mass.sum(1) > 0.5).all()
    assert np.allclose((10 ** m.transition).sum(1), 1)


def test_words_choose_the_class_that_brute_force_finds():
    """Each word alone against the likelihood of the whole table, from a class of its own or out of the choice."""
    rng = np.random.default_rng(8)
    bigrams = rng.poisson(rng.random((24, 24)) * 4).astype(float)
    own = rng.integers(0, 6, 24)
    own[:6] = np.arange(6)
    table, beside = np.zeros((6, 6)), np.zeros((24, 13))
    np.add.at(table, (own[:, None], own[None, :]), bigrams)
    for w in range(24):
        for x in range(24):
            if x != w:
                beside[w, own[x]] += bigrams[w, x]
                beside[w, 6 + own[x]] += bigrams[x, w]
        beside[w, 12] = bigrams[w, w]
    got = class_lm.best_classes(beside, own, table, 4)
    for w in range(6, 24):
        reached = []
        for b in range(4):
            other = own.copy()
            other[w] = b
            reached.append(brute_likelihood(bigrams, other))
        assert reached[got[w]] >= max(reached) - 1e-6


def test_words_beyond_the_clustered_ones_are_classed_by_context(spark):
    """Two kinds of words, equally frequent, take turns: only context tells them apart."""
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(f"{'ab'[k % 2]}{rng.integers(0, 60)}" for k in range(60))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [class_lm.score_documents(docs, clustered=8, classes=4, chunk_tokens=n).collect() for n in (1000, 1 << 21)]
    assert counts(got[0]) == brute_base(rows)
    assert np.allclose(*([r["score"] for r in sorted(x, key=lambda r: r["doc_id"])] for x in got))
    out = [r for r in got[0] if r["held_out"]]
    # With the kind of the next word known, a token has about 60 choices, without it about 120.
    assert -sum(r["score"] for r in out) / sum(r["n_tokens"] for r in out) < math.log10(85)


@pytest.mark.parametrize("seed", range(4))
def test_exchange_goes_on_until_no_word_moves(seed):
    """By default, on tables that take more than a dozen sweeps; no single move raises the likelihood then."""
    rng = np.random.default_rng(seed)
    bigrams = rng.poisson(rng.random((400, 400)) ** 6 * 3).astype(float)
    first = np.arange(400) % 12
    own = class_lm.exchange(bigrams, first, np.arange(400), 12)
    assert (class_lm.exchange(bigrams, first, np.arange(400), 12, sweeps=12) != own).any()
    assert (class_lm.exchange(bigrams, own, np.arange(400), 12, sweeps=1) == own).all()
    table = lambda x: np.eye(12)[x].T @ bigrams @ np.eye(12)[x]
    f = lambda x: (x[x > 0] * np.log(x[x > 0])).sum()
    likelihood = lambda x: f(table(x).ravel()) - f(table(x).sum(0)) - f(table(x).sum(1))
    best = likelihood(own)
    for w in range(0, 400, 20):
        for b in range(12):
            other = own.copy()
            other[w] = b
            assert likelihood(other) <= best + 1e-6


def brute_scores(rows, clustered, classes):
    """The model's score of every row in plain Python: each choice by the likelihood of the whole recounted table."""
    held = lambda d: crc("" if d is None else d) % 7 == 2
    texts = [(d, words(t) + [b""]) for d, t in rows]
    count = Counter(w for d, ws in texts if not held(d) for w in ws)
    common = sorted((w for w in count if w and count[w] >= 8), key=lambda w: (-count[w], w))[:clustered]
    choosers = sorted(w for w in count if w and count[w] >= 8 and w not in common)
    word_class = {w: i % classes for i, w in enumerate(common)}

    def class_of(w):
        if w in word_class:
            return word_class[w]
        return "end" if w == b"" else ("band", count[w].bit_length() - 1) if count[w] else "unknown"

    def left_out(w):
        n = count[w]
        if w in word_class and not (w in choosers and n == 8) or w == b"" or not n:
            return class_of(w)
        if n & (n - 1):
            return class_of(w)
        return ("band", n.bit_length() - 2) if n > 1 else "unknown"

    pairs = Counter((a, b) for d, ws in texts if not held(d) for a, b in zip([b"", *ws], ws))

    def likelihood(of):
        table, rows_, cols = Counter(), Counter(), Counter()
        for (a, b), n in pairs.items():
            x, y = of(a), of(b)
            table[x, y] += n
            rows_[x] += n
            cols[y] += n
        f = lambda c: sum(n * math.log(n) for n in c.values())
        return f(table) - f(rows_) - f(cols)

    def best(w, now):
        reached = [likelihood(lambda x: b if x == w else class_of(x)) for b in range(classes)]  # noqa: B023
        top = max(range(classes), key=lambda b: (round(reached[b], 7), -b))
        return now if isinstance(now, int) and reached[top] <= reached[now] + 1e-6 else top

    moved = True
    while moved:
        moved = False
        for w in common:
            b = best(w, word_class[w])
            moved, word_class[w] = moved or b != word_class[w], b
    for _ in range(class_lm.WORD_SWEEPS):
        word_class.update({w: best(w, class_of(w)) for w in choosers})

    kinds = [*range(classes), "unknown", "end", *[("band", k) for k in range(class_lm._BANDS)]]
    moves, rows_, cols = Counter(), Counter(), Counter()
    for (a, b), n in pairs.items():
        moves[left_out(a), left_out(b)] += n
        rows_[left_out(a)] += n
        cols[left_out(b)] += n
    totals = Counter()
    for w, n in count.items():
        totals[class_of(w)] += n
    whole, smooth = sum(moves.values()), class_lm.SMOOTHING

    def step(a, b):
        x, y = class_of(a), class_of(b)
        share = (cols[y] + 1) / (whole + len(kinds))
        out = math.log10((moves[x, y] + smooth * share) / (rows_[x] + smooth))
        return out + (math.log10(count[b] / totals[y]) if count[b] else 0.0)

    return Counter((d, round(sum(step(a, b) for a, b in zip([b"", *ws], ws)), 4)) for d, ws in texts)


def small_corpus(seed=3):
    """Two kinds of words in turns, of falling frequency, words of exactly 8, rare ones, and texts without words."""
    rng = np.random.default_rng(seed)
    weights = 1 / np.arange(1, 15)
    rows = []
    for i in range(60):
        ws = [f"{'ab'[k % 2]}{rng.choice(14, p=weights / weights.sum())}" for k in range(rng.integers(0, 30))]
        rows.append((i, " ".join(ws + [f"rare{rng.integers(0, 60)}"] * (i % 3 == 0) + ["eight"] * (i in (1, 4, 5, 7)) * 2)))
    return rows + [(100, None), (101, ""), (None, "a1 b1")]


@pytest.mark.parametrize("hot, sent, chunk_tokens", [(1 << 18, 1 << 22, 1 << 21), (12, 1 << 22, 60), (12, 0, 60), (1 << 18, 0, 200)])
def test_scores_match_brute_force(spark, monkeypatch, hot, sent, chunk_tokens):
    """From the counts to the score; the same with words whose counts meet in parts, and with answers joined back."""
    monkeypatch.setattr(class_lm, "HOT_COUNT", hot)
    monkeypatch.setattr(class_lm, "SENT_WORDS", sent)
    monkeypatch.setattr(class_lm, "HOT_PARTS", 3)
    rows = small_corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = class_lm.score_documents(docs, clustered=5, classes=3, chunk_tokens=chunk_tokens).collect()
    assert counts(got) == brute_base(rows)
    assert Counter((r["doc_id"], round(r["score"], 4)) for r in got) == brute_scores(rows, 5, 3)


def test_whole_words_over_batches():
    """Rows of a word come together whatever the batches; the sums equal plain ones."""
    import pyarrow as pa

    rng = np.random.default_rng(0)
    word = np.sort(rng.integers(0, 9, 60))
    word[20:45] = word[20]
    word = np.sort(word)
    codes = [rng.integers(0, 7, rng.integers(0, 4)).astype(np.uint16) for _ in word]
    counts_ = [rng.integers(1, 9, len(c)).astype(np.int64) for c in codes]
    table = pa.table({"word": word, "own": pa.array(word.astype(np.int32)), "codes": pa.array([c.tobytes() for c in codes], pa.binary()), "counts": pa.array([c.tobytes() for c in counts_], pa.binary())})
    for size in (1, 3, 7, 100):
        got = {}
        for held in class_lm._whole_words(iter(table.to_batches(size))):
            for words_, own, beside in class_lm._dense(held, 7):
                for w, o, b in zip(words_.tolist(), own.tolist(), beside):
                    assert w not in got and o == w
                    got[w] = b
        for w in np.unique(word):
            want = np.zeros(7)
            for i in np.flatnonzero(word == w):
                np.add.at(want, codes[i], counts_[i])
            assert (got[w] == want).all()
