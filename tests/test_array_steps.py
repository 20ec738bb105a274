"""Array files are read and written in steps of bounded size."""

from __future__ import annotations

import json

import pyarrow as pa

from strata.sources import json_array


def test_array_files_are_cut_in_small_steps(monkeypatch):
    monkeypatch.setattr(json_array, "HELD", 1000)
    texts = [json.dumps({"n": i, "text": "word " * 20}) for i in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["value"])
    assert max(p.num_rows for p in json_array._slices(batch)) <= 9
    assert sum(p.num_rows for p in json_array._slices(batch)) == 300
    lines = pa.array(["[", *[x for t in texts for x in (t, ",")][:-1], "]"])
    split = pa.RecordBatch.from_arrays([pa.array(["f"] * len(lines)), pa.array([0] * len(lines)), lines], names=["file", "start", "value"])
    out = list(json_array._cut({("f", 0): (0, 1, 0)})(iter([split])))
    assert max(b.num_rows for b in out) <= 9
    assert [t for b in out for t in b.column("text").to_pylist() if t] == texts
