from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordloom.llm import hilbert

OPTIONS = {"texts": ["source", "lang"], "numbers": ["n_chars"], "ties": ["doc_id", "n_chars"]}


@pytest.mark.parametrize(("dimensions", "bits"), [(1, 4), (2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_every_cell_by_neighbours(dimensions, bits):
    axes = np.meshgrid(*[np.arange(1 << bits)] * dimensions, indexing="ij")
    cells = np.stack(axes).reshape(dimensions, -1)
    index = hilbert.curve_index(cells, bits)
    assert sorted(index.tolist()) == list(range(cells.shape[1]))
    steps = np.abs(np.diff(cells[:, np.argsort(index)], axis=1)).sum(0)
    assert (steps == 1).all()


@pytest.mark.parametrize("frame", ["messy", "sample", "nothing"])
@pytest.mark.parametrize("shards", [1, 7, 16])
def test_rows_law(frame, shards, request):
    docs = request.getfixturevalue(frame)
    rows = hilbert.curve_shards(docs, shards=shards, **OPTIONS).collect()
    total = docs.count()
    assert len(rows) == total
    slots = {s: sorted(r.slot for r in rows if r.shard == s) for s in range(shards)}
    assert sum(map(len, slots.values())) == total
    assert all(v == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    ordered = sorted(rows, key=lambda r: (r.shard, r.slot))
    keys = [(r.curve, r.doc_id is not None, r.doc_id or 0) for r in ordered]
    assert keys == sorted(keys)


def test_number_codes_keep_order(spark):
    values = [None, -5, 0, 1, 2, 3, 100, 10**6, 2**40, 2**62]
    frame = spark.createDataFrame([(v,) for v in values], "v long")
    codes = [r[0] for r in frame.select(hilbert.number_code(F.col("v"), 10)).collect()]
    assert codes[:3] == [0, 0, 0] and codes[3:] == sorted(codes[3:]) and 0 < codes[3] and codes[-1] < 1024


def test_files_hold_the_shards(sample, tmp_path):
    path = str(tmp_path / "shards")
    hilbert.write_shards(sample, path, shards=4, **OPTIONS)
    back = sample.sparkSession.read.parquet(path)
    assert back.count() == sample.count() and back.select("shard").distinct().count() == 4
