"""The load on Structured Streaming: same outcomes as batch, idempotent per epoch."""

from __future__ import annotations

import json
import os

from eventloom.streaming import start_event_stream

REC = '<Event><System><TimeCreated SystemTime="2024-01-02 03:04:0{i}"/></System><EventData><Data Name="n">{i}</Data><Data Name="m">x</Data></EventData></Event>'


def test_stream_loads_new_files(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for f in range(2):
        recs = [REC.format(i=i) for i in range(4)] + ["<Event><System>"]
        body = "\n".join(recs)
        (src / f"f{f}.xml").write_text(f"<Events>\n{body}\n</Events>\n", encoding="utf-8")
    out = str(tmp_path / "out")
    q = start_event_stream(
        spark, str(src), out, available_now=True, checkpoint_location=str(tmp_path / "ckpt"), name="t_stream"
    )
    q.awaitTermination(300)
    loaded, rejected = [], []
    for root, _, files in os.walk(out):
        for f in files:
            if not f.endswith(".txt"):
                continue
            lines = open(os.path.join(root, f), encoding="utf-8").read().splitlines()
            if "status=loaded" in root:
                loaded += [json.loads(x) for x in lines[1::2]]
            else:
                rejected += [json.loads(x) for x in lines]
    assert len(loaded) == 8
    assert {d["Event"]["EventData"]["Data"]["m"] for d in loaded} == {"x"}
    assert len(rejected) == 2 and {r["reason"] for r in rejected} == {"xml"}


def test_new_checkpoint_does_not_write_over(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    for run in range(2):
        (src / "f.xml").write_text(REC.format(i=run), encoding="utf-8")
        for _ in range(2):  # a restart with the same checkpoint is the same stream
            q = start_event_stream(spark, str(src), str(out), str(tmp_path / f"ckpt{run}"), available_now=True, name=f"t{run}")
            q.awaitTermination(300)
    streams = sorted(os.listdir(out))
    assert len(streams) == 2 and all(s.startswith("stream=") and len(s) > 20 for s in streams)
