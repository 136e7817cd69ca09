"""The pipeline's stages against brute-force versions, on documents and on awkward cases."""

import base64
import random
import string
from collections import Counter

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

import corpus_pipeline as pipeline

from .edge import edge_docs, edge_rows, no_docs, read_documents
from .test_layout import brute_lines, check_packing
from .test_similar import brute_components, brute_tokens, shingle_set

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def stages(spark, docs, rows):
    """Runs the stages one after the other and checks each on what the one before kept."""
    out = pipeline.language_id(spark, docs, SF_SMALL).cache()
    assert out.columns == docs.columns
    kept = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) <= Counter(r[:2] for r in kept)
    docs, rows = out, [tuple(r) for r in out.collect()]

    out = pipeline.line_dedup(spark, docs, SF_SMALL).cache()
    assert out.columns == docs.columns
    got = [tuple(r) for r in out.collect()]
    assert Counter(r[:2] for r in got) == Counter(r[:2] for r in brute_lines(rows))
    assert all(r[4] == len(r[1]) for r in got)
    docs, rows = out, got

    out = pipeline.near_dedup(spark, docs, SF_SMALL).cache()
    assert out.columns == docs.columns
    stay = {d for d, _, c in brute_components(rows, pipeline.SIMILARITY) if d is None or d == c}
    assert Counter(r["doc_id"] for r in out.collect()) == Counter(r[0] for r in rows if r[0] in stay)
    docs, rows = out, [tuple(r) for r in out.collect()]

    out = pipeline.mixing(spark, docs, SF_SMALL).cache()
    assert out.columns == docs.columns
    got = [tuple(r) for r in out.collect()]
    assert set(got) == set(rows)
    tokens, mixed = Counter(), Counter()
    for r in rows:
        tokens[r[3]] += brute_tokens(r[1])
    for r in got:
        mixed[r[3]] += brute_tokens(r[1])
    assert all(tokens[s] <= mixed[s] <= 2 * tokens[s] for s in tokens)
    check_packing(pipeline.packing(spark, out, SF_SMALL).collect(), got)
    return len(got)


def test_stages_on_documents(spark):
    rows = [tuple(d[c] for c in COLUMNS) for d in read_documents(SF_SMALL)]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(*COLUMNS)
    assert stages(spark, docs, rows) > 0


def test_stages_on_edge_cases(spark):
    stages(spark, edge_docs(spark).withColumn("row", F.lit("r")).withColumn("found", F.lit("f")), edge_rows())


@pytest.mark.parametrize("name,stage", pipeline.STAGES)
def test_stage_on_no_documents(spark, name, stage):
    assert stage(spark, no_docs(spark), SF_SMALL).collect() == []


def test_run_is_the_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
    assert pipeline.run(spark, SF_SMALL).drop("sequence_id", "offset").exceptAll(docs.drop("sequence_id", "offset")).count() == 0


def test_near_dedup_links_from_similarity_80(spark):
    """Against brute force at 80, on pairs around 0.75 to 0.9 as well as on the table's documents."""
    rows = [(d["doc_id"], d["text"]) for d in read_documents(SF_SMALL)]
    for i, changed in enumerate(range(1, 15)):
        text = [f"w{i}x{k}" for k in range(204)]
        rows.append((10**6 + 2 * i, " ".join(text)))
        for k in range(changed):
            text[5 + 14 * k] = f"other{k}"
        rows.append((10**6 + 2 * i + 1, " ".join(text)))
    sets = [(d, shingle_set(t)) for d, t in rows]
    near = [(a, b) for i, (a, s) in enumerate(sets) for b, t in sets[:i] if s and t and 100 * len(s & t) >= 80 * len(s | t)]
    assert any(100 * len(s & t) < 85 * len(s | t) for a, s in sets for b, t in sets if (a, b) in set(near))
    root = {d: d for d, _ in rows}
    for _ in rows:
        before = dict(root)
        for a, b in near:
            root[a] = root[b] = min(root[a], root[b])
        if root == before:
            break
    got = pipeline.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF_SMALL)
    assert Counter(r["doc_id"] for r in got.collect()) == Counter(d for d, _ in rows if root[d] == d)


def corpus(spark, sf="sf0.01"):
    return spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select(*COLUMNS)


def test_language_stage_rejects_what_is_no_learned_language(spark):
    """Random letters, base64 and two unlearned languages of some length go; clean texts stay, short ones too."""
    rng = random.Random(1)
    docs = corpus(spark, "sf0.1")  # enough labelled texts of a length to tell
    clean = [r["text"] for r in docs.where("lang = 'en'").orderBy("doc_id").limit(30).collect()]
    latin = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua".split()
    finnish = "tämä on suomenkielinen teksti jossa kerrotaan metsästä järvistä ja talvesta sekä siitä miten ihmiset kulkevat hiihtäen jäätä pitkin".split()
    bad = [" ".join(rng.choice(ws) for _ in range(400)) for ws in (latin, finnish) for _ in range(3)]
    bad += [" ".join("".join(rng.choice(string.ascii_lowercase) for _ in range(rng.randint(2, 9))) for _ in range(400)) for _ in range(3)]
    bad += [base64.b64encode(rng.randbytes(3000)).decode() for _ in range(3)]
    good = clean + [" ".join(t.split()[:n]) for t in clean for n in (4, 12, 40)]
    rows = [(10**6 + i, t, None, "s", len(t)) for i, t in enumerate(bad + good)]
    added = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"] for r in pipeline.language_id(spark, docs.unionByName(added), SF_SMALL).collect()}
    assert {10**6 + i for i in range(len(bad), len(rows))} <= kept and not kept & {10**6 + i for i in range(len(bad))}
    known = docs.join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet").where("quality = 1"), "doc_id")
    lost = [r["doc_id"] for r in known.collect() if r["doc_id"] not in kept and any(c.isalpha() for c in r["text"] or "")]
    assert len(lost) <= 2


def test_language_stage_without_labels_keeps_all(spark):
    docs = corpus(spark).withColumn("lang", F.lit(None).cast("string"))
    assert pipeline.language_id(spark, docs, SF_SMALL).exceptAll(docs).count() == 0
    assert pipeline.language_id(spark, docs, SF_SMALL).count() == docs.count()
    awkward = edge_docs(spark).withColumn("lang", F.lit(None).cast("string"))
    assert pipeline.language_id(spark, awkward, SF_SMALL).count() == len(edge_rows())


def test_python_tasks_get_small_batches(spark, monkeypatch):
    """Whole texts go to Python tasks about 2 MB at a time, in every stage that has such tasks; the session's setting comes back."""
    from eventloom.llm import common, minhash, packing

    def sizes(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_pydict({"bytes": [b.nbytes], "n": [b.num_rows]})

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    rows = spark.range(0, 4000, 1, 1).select(F.repeat(F.lit("0123456789"), 1000).alias("text"))
    for own, least, most in ((None, 5, 2 << 20), ("64m", 5, 2 << 20), ("200k", 100, 200 << 10)):
        spark.conf.unset(key) if own is None else spark.conf.set(key, own)
        with common.small_batches(spark):
            got = rows.mapInArrow(sizes, "bytes long, n long").collect()
        assert spark.conf.get(key, None) == own
        assert sum(r["n"] for r in got) == 4000 and len(got) >= least and max(r["bytes"] for r in got) <= 1.5 * most
    spark.conf.unset(key)

    seen = {}
    for module in (pipeline, minhash, packing):
        def record(df, name, write=module.written):
            seen[name] = spark.conf.get(key, None)
            return write(df, name)

        monkeypatch.setattr(module, "written", record)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for _, stage in pipeline.STAGES:
        stage(spark, docs, SF_SMALL)
    names = ["pipeline-profiles", "pipeline-languages", "sets", "cells-inside", "sets-inside", "links-inside", "pieces"]
    assert {n: seen[n] for n in names} == dict.fromkeys(names, str(common.BATCH_BYTES)) and spark.conf.get(key, None) is None


def test_packing_plan_needs_no_python_rdd(spark):
    """An RDD of Python rows makes executors start, and keep, a second set of Python workers."""
    plan = pipeline.packing(spark, spark.read.parquet(f"{SF_SMALL}/documents.parquet"), SF_SMALL)._jdf.queryExecution().toString()
    assert "ExistingRDD" not in plan
