"""Sharding: a whole, seeded, even shuffle."""

from collections import Counter, defaultdict

import numpy as np
import pytest

from kitchenlens.llm import sharding as sd


@pytest.mark.parametrize("bucket_bytes", [64 << 20, 40])
def test_whole_and_even(spark, bucket_bytes):
    rows = [(i, f"text {i % 40}", 1) for i in range(500)] + [(None, None, 1), (None, None, 1), (7, "", 1)] + [(9, "same", 1)] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string, Slot int")
    out = sd.external_shuffle(docs, shards=16, bucket_bytes=bucket_bytes)
    assert out.columns == ["doc_id", "text", "shard", "slot"]
    got = out.collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((a, b) for a, b, _ in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert sorted(slots) == list(range(16)) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    order = [r.doc_id for r in sorted(got, key=lambda r: (r.shard, r.slot)) if r.doc_id is not None and r.text != "same"]
    assert abs(np.corrcoef(np.arange(len(order)), order)[0, 1]) < 0.2
    again = sd.external_shuffle(docs, shards=16, bucket_bytes=bucket_bytes).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))
    assert sd.external_shuffle(docs.limit(0)).count() == 0
    few = sd.external_shuffle(docs.limit(3), shards=16).collect()
    assert len({r.shard for r in few}) == 3


def test_fisher_yates_is_uniform():
    seen = Counter(tuple(sd.fisher_yates(3, seed, 1)) for seed in range(6000))
    assert len(seen) == 6 and max(seen.values()) - min(seen.values()) < 250
    assert sorted(sd.fisher_yates(1000, 1, 2)) == list(range(1000)) and len(sd.fisher_yates(0, 1, 2)) == 0


def test_write_shards(spark, tmp_path):
    docs = spark.createDataFrame([(i, "x") for i in range(40)], "doc_id long, text string")
    sd.write_shards(sd.external_shuffle(docs, shards=4), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 40 and back.select("shard").distinct().count() == 4
