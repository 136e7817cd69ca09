"""Importance resampling, vector codes and quality scores against brute-force versions and held-out labels."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from eventloom.llm import cover_codes, importance, quality
from eventloom.llm.cover_codes import vector_codes
from eventloom.llm.importance import importance_resample
from eventloom.llm.quality import FEATURES, describe, quality_scores

from .edge import crc, edge_docs, edge_rows, no_docs, read_documents

# ---------------------------------------------------------------- importance resampling


def brute_words(text):
    out, word = [], ""
    for c in (text or "") + " ":
        c = c.lower() if c.isascii() else c
        if c.isascii() and not c.isalnum():
            out += [word] if word else []
            word = ""
        else:
            word += c
    return out


def brute_grams(text, length):
    w = brute_words(text)
    return [" ".join(w[i : i + n]) for n in range(1, length + 1) for i in range(len(w) - n + 1)]


def brute_resample(rows, target, buckets, length, least, draw):
    """(id, words, features, weight, score) of each row, those that must be drawn, and those of the last score and id."""
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(map(bucket, brute_grams(text, length)))
    for text in target:
        t.update(map(bucket, brute_grams(text, length)))
    total, aim = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (total + buckets) / ((s[b] + 1) * (aim + buckets)))) for b in range(buckets)}
    out = []
    for doc, text in rows:
        g = brute_grams(text, length)
        weight = sum(gain[bucket(x)] for x in g) // len(g) if g else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append((doc, len(brute_words(text)), len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    return out, [(r[0], r[4]) for r in able[: draw[0] * len(able) // draw[1]]]


def check_resample(spark, docs, rows, target, buckets=50, length=2, least=3, draw=(25, 100)):
    aims = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance_resample(docs, aims, buckets=buckets, length=length, least_words=least, draw=draw).collect()
    want, drawn = brute_resample(rows, target, buckets, length, least, draw)
    assert Counter(tuple(r)[:5] for r in got) == Counter(want)
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r["doc_id"], r["score"]) for r in ranked] == drawn


TARGET = ["the same text again", "w1 w2 w3 été", None, "", "One two three"]


@pytest.mark.parametrize("draw", [(25, 100), (0, 100), (1, 1), (2, 3)])
def test_resample_matches_brute_force(spark, draw):
    """Ties, repeated rows and null ids included: a third of the rows has one text."""
    check_resample(spark, edge_docs(spark), [r[:2] for r in edge_rows()], TARGET, draw=draw)


@pytest.mark.parametrize("length", [1, 2, 4])
def test_resample_of_segments(spark, monkeypatch, length):
    """Texts cut into short segments give the same n-grams."""
    monkeypatch.setattr(importance, "_SEGMENT", 7)
    for text in ("a b c d e f g h i j", "x", "", "ab-cd.ef  gh\tij\nkl ", "été " * 9, "y" * 40, "... --- ..."):
        found = sorted(int(b) for _, at in importance.features(text, 1000, length) for b in at)
        assert found == sorted(zlib.crc32(g.encode()) % 1000 for g in brute_grams(text, length))


def test_resample_of_one_id(spark):
    """All rows share score and id: each drawn one still has a rank of its own."""
    rows = [(4, "one two three four")] * 200 + [(5, "two three four five")] * 7
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    check_resample(spark, docs, rows, TARGET)


def test_resample_of_documents_and_empty_tables(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in read_documents(SF_SMALL)]
    check_resample(spark, docs, rows, TARGET, buckets=10_000, least=20)
    check_resample(spark, no_docs(spark), [], TARGET)
    check_resample(spark, docs.limit(0).unionByName(docs.where("doc_id < 9")), [r for r in rows if r[0] < 9], [], least=1)


def test_cut_value(spark):
    rng = random.Random(1)
    values = [rng.randrange(-50, 50) for _ in range(300)] + [7] * 100 + [-(1 << 63), (1 << 63) - 1]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    for wanted in (1, 2, 60, 200, 402):
        cut, above = importance.cut_value(df, "v", wanted, min(values), max(values))
        assert cut == sorted(values, reverse=True)[wanted - 1] and above == sum(v > cut for v in values)


# ---------------------------------------------------------------- vector codes


def brute_codes(rows, parts=8, entries=16, rounds=6):
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    part = max(1, -(-max((len(r[1]) for r in kept), default=0) // parts))
    points = [[math.floor(4096 * x) for x in r[1]] + [0] * (parts * part - len(r[1])) for r in kept]
    first = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))[:entries]
    books = [[points[i][p * part : (p + 1) * part] for i in first] or [[0] * part] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = [x[p * part : (p + 1) * part] for x in points]
            at = [nearest(x, books[p])[1] for x in own]
            for e in set(at):
                mine = [x for x, i in zip(own, at) if i == e]
                books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    digest = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    out, by_label = [], Counter()
    for r, x in zip(kept, points):
        found = [nearest(x[p * part : (p + 1) * part], books[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        out.append((r[0], "".join(f"{i:02x}" for _, i in found), error, r[2]))
        by_label[r[2]] += error
    return Counter((i, c, e, by_label[label], digest) for i, c, e, label in out)


def vector_rows(n, width, seed=5):
    """Groups about a few centres, exact copies, negative components; a third of the rows is one vector."""
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(width)] for _ in range(5)]
    rows = []
    for i in range(n):
        v = [float(np.float32(c + rng.gauss(0, 0.05 * (i % 4)))) for c in centres[i % 5]]
        rows.append((3 * i - 40, v if i % 3 else [0.25] * width, [None, 1, 2, 2][i % 4]))
    return rows


VECTORS = "vec_id long, embedding array<float>, label int, `text.x` string, doc long, vector string"


def vectors(spark, rows, parts=4):
    return spark.createDataFrame([(*r, "mine", 1, "v") for r in rows], VECTORS).repartition(parts)


@pytest.mark.parametrize("n, width, block", [(300, 16, 2048), (300, 16, 40), (200, 8, 64), (9, 24, 2048), (60, 13, 2048)])
def test_codes_match_brute_force(spark, n, width, block):
    rows = vector_rows(n, width)
    assert Counter(map(tuple, vector_codes(vectors(spark, rows), block=block).collect())) == brute_codes(rows)


def test_codes_of_awkward_rows(spark):
    """Null and non-finite vectors are left out; empty and shorter ones count zeros; ids repeat or are null."""
    rows = vector_rows(40, 16)
    rows += [(7, None, 1), (8, [1.0, None] * 8, 1), (9, [float("nan")] * 16, 2), (10, [float("inf")] * 16, None), (11, [], 1), (12, [0.5, -0.5], 3)]
    rows += [rows[1], rows[1], (None, rows[2][1], 4), (-99, rows[4][1], None), (-99, rows[5][1], None)]
    assert Counter(map(tuple, vector_codes(vectors(spark, rows)).collect())) == brute_codes(rows)
    assert vector_codes(vectors(spark, [])).collect() == []
    assert vector_codes(vectors(spark, [(1, None, 1)])).collect() == []
    assert Counter(map(tuple, vector_codes(vectors(spark, [(1, [], 1)])).collect())) == brute_codes([(1, [], 1)])


def test_codes_too_large_for_exact_distances(spark):
    with pytest.raises(Exception, match="not exact"):
        vector_codes(vectors(spark, [(1, [1e9] * 16, 1)])).collect()


def test_cover_tree_invariants():
    """Subtrees are runs, lie within the radius, children cover and stand apart; assignments equal exact ones."""
    rng = np.random.default_rng(2)
    points = np.floor(np.concatenate([rng.normal(size=(400, 6)) * 900, rng.normal(size=(300, 6)) * 9 + 500, np.full((200, 6), 77.0)]))
    tree = order, starts, ends, centres, radii, kids, n_kids = cover_codes.cover_tree(points)
    assert sorted(order.tolist()) == list(range(len(points)))
    for node in range(len(starts)):
        own = points[order[starts[node] : ends[node]]]
        far = np.sqrt(((own - points[centres[node]]) ** 2).sum(1).max())
        assert centres[node] in order[starts[node] : ends[node]] and far == radii[node]
        if n_kids[node]:
            below = range(kids[node], kids[node] + n_kids[node])
            assert [starts[k] for k in below] == [starts[node], *[ends[k] for k in below][:-1]] and ends[below[-1]] == ends[node]
            assert centres[below[0]] == centres[node] and all(radii[k] <= radii[node] / 2 for k in below)
            heads = points[[centres[k] for k in below]]
            apart = np.sqrt(((heads[:, None] - heads[None]) ** 2).sum(2)) + 1e9 * np.eye(len(heads))
            assert apart.min() > radii[node] / 2
        else:
            assert ends[node] - starts[node] <= 16 or radii[node] == 0
    for book in (points[:16], points[[0, 0, 5, 5, 899]], points[:1], np.concatenate([points[:3] + 400, points[:3]])):
        runs, places, which = cover_codes.assigned(points, tree, book)
        got = np.full(len(points), -1)
        for lo, hi, e in runs:
            got[lo:hi] = e
        got[places] = which
        assert (got == ((points[order][:, None] - book[None]) ** 2).sum(2).argmin(1)).all()
    assert len(places) < len(points)  # some subtrees went as a whole


# ---------------------------------------------------------------- quality


def test_quality_on_held_out_labels(spark):
    """Of the labels that were held out, nearly all are told apart; the answer needs nothing but the text."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = {r["doc_id"]: r for r in quality_scores(docs, labels).collect()}
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (crc(d) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for d, r in rows.items())
    known = [(rows[r["doc_id"]]["score"], r["quality"]) for r in labels.collect() if r["doc_id"] in rows and rows[r["doc_id"]]["held_out"]]
    good, bad = [s for s, q in known if q == 1], [s for s, q in known if q == 0]
    assert np.mean([(g > b) + (g == b) / 2 for g in good for b in bad]) > 0.95
    assert np.mean([(s >= 0.3) == (q == 1) for s, q in known]) > 0.93


def test_quality_learns_from_its_fold_only(spark):
    """Labels of the held-out fold, and other columns, change no score; repeated runs agree."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumn("lang", F.lit("xx")).withColumn("features", F.lit(1)).withColumn("y", F.lit("z"))
    first = sorted(map(tuple, quality_scores(docs, labels).collect()))
    assert first == sorted(map(tuple, quality_scores(other.repartition(3), turned).collect()))


def test_quality_of_awkward_rows(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(3, 0), (3, None), (None, 1), (999, 1)], "doc_id long, quality int")
    got = quality_scores(edge_docs(spark), labels).collect()
    want = Counter((r[0], crc("" if r[0] is None else r[0]) % 5 == 0) for r in edge_rows())
    assert Counter((r["doc_id"], r["held_out"]) for r in got) == want
    by_text = {}
    for r in edge_rows():
        by_text.setdefault(r[1] or "", set()).update(g["score"] for g in got if g["doc_id"] == r[0] and r[0] is not None)
    assert all(len(scores) <= 1 for scores in by_text.values()) and all(0 <= g["score"] <= 1 for g in got)
    assert quality_scores(no_docs(spark), labels).collect() == []
    for none in (labels.limit(0), labels.where("doc_id > 900"), labels.withColumn("quality", F.lit(None).cast("int"))):
        assert {(r["score"], r["predicted"]) for r in quality_scores(edge_docs(spark), none).collect()} == {(0.5, 1)}


def test_quality_of_one_class(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    assert all(r["score"] > 0.9 for r in quality_scores(docs, labels).collect())


def test_sample_is_bounded(spark, monkeypatch):
    """More labelled rows than asked for: about as many as asked for are fitted."""
    sizes = []
    plain = quality.fit
    monkeypatch.setattr(quality, "fit", lambda features, y, held: sizes.append(len(y)) or plain(features, y, held))
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("quality"))
    for parts in (2, 7):
        quality_scores(docs.repartition(parts), labels, fit_rows=500).collect()
    assert all(400 < n < 600 for n in sizes)


def test_model_adds_table_cells():
    """Scores by arrays equal the tables added up cell by cell; pairs catch what single features cannot."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    held = rng.random(3000) < 0.2
    model = quality.fit(x, y, held)
    assert (0, 1) in model.pairs
    scores = model.scores(x)
    for row, score in list(zip(x, scores))[:50]:
        total = model.start + sum(t[int((e <= v).sum())] for t, e, v in zip(model.tables, model.edges, row))
        total += sum(t[int((model.pair_edges[a] <= row[a]).sum()), int((model.pair_edges[b] <= row[b]).sum())] for (a, b), t in zip(model.pairs, model.pair_tables))
        assert abs(1 / (1 + math.exp(-total)) - score) < 1e-9
    assert ((scores > 0.5) == (y > 0.5))[held].mean() > 0.9


def test_shallow_trees():
    """At most four leaves, each the regularised mean of its bins; a table's tree cuts along either axis."""
    rng = np.random.default_rng(1)
    g, h = rng.normal(size=32), rng.random(32) + 1
    step = quality.shallow_tree(g, h)
    edges = [0, *(np.flatnonzero(np.diff(step)) + 1).tolist(), 32]
    assert 2 <= len(edges) - 1 <= 4
    for a, b in zip(edges, edges[1:]):
        assert abs(step[a] + g[a:b].sum() / (h[a:b].sum() + quality.RIDGE)) < 1e-12
    board = np.where((np.arange(8)[:, None] < 4) ^ (np.arange(8)[None] < 3), -1.0, 1.0)
    gain, table = quality.shallow_pair_tree(np.concatenate([board, board[:1]]), np.ones((9, 8)))
    assert gain > 0 and len(np.unique(table)) <= 4


def test_describe(monkeypatch):
    at = FEATURES.index
    assert describe(None) == describe("") == [0.0] * len(FEATURES)
    x = describe("The The cat.\nTHE | dog!!\nThe The cat.")
    assert x[at("log_words")] == math.log2(10) and x[at("same_as_before")] == 2 / 9 and x[at("bare_words")] == 1 / 9
    assert x[at("top_word")] == 5 / 9 and math.isclose(x[at("repeated_lines")], 1 / 3) and x[at("marked_words")] == 4 / 9
    for text in ("one two  three\nfour", "été à Noël " * 40, "x" * 90, "a b\n" * 30, " \n\t "):
        whole = describe(text)
        monkeypatch.setattr(quality, "_SEGMENT", 11)
        cut = describe(text)
        monkeypatch.undo()
        assert all(map(math.isclose, whole, cut))
