"""Shards: exact sizes, whole rows, gapless slots, the law of the draws, repeatable deals."""

import zlib
from collections import Counter

import numpy as np
import pytest

from faregauge.llm import sharding
from faregauge.llm.sharding import Deal

SF = "/root/testdata/sf0.01"


def check(docs, rows, shards=8):
    wanted = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == wanted
    counts = Counter(r.shard for r in rows)
    assert sorted(counts[s] for s in range(shards)) == sorted(sharding.sizes(len(rows), shards).tolist())
    for shard in range(shards):
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(counts[shard]))
    assert {r.law for r in rows} <= {"rows"} and {r.grown_shard for r in rows} <= {None}


def test_whole_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs.repartition(5).write.parquet(str(tmp_path / "d"))
    parts = spark.read.parquet(str(tmp_path / "d"))
    deal = Deal(segment=64, chunk_rows=20)
    rows = sharding.shard_digests(sharding.sharded(parts, deal)).collect()
    check(docs.collect(), rows)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert sorted(sharding.shard_digests(sharding.sharded(parts, deal)).collect()) == sorted(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    other = sharding.shard_digests(sharding.sharded(parts, Deal(seed=5))).collect()
    assert {(r.doc_id, r.shard) for r in other} != {(r.doc_id, r.shard) for r in rows}


def test_odd_rows(make):
    texts = [None, "", "é" * 5, "same", "same", "w " * 80_000]
    rows = [(i if i % 3 else None, texts[i % 6], i, "key") for i in range(29)]
    docs = make(rows, "doc_id long, text string, shard int, chunk string")
    check(docs.collect(), sharding.shard_digests(sharding.sharded(docs)).collect())
    empty = sharding.shard_digests(sharding.sharded(docs.limit(0)))
    assert empty.collect() == [] and dict(empty.dtypes)["text_crc32"] == "bigint"
    few = sharding.shard_digests(sharding.sharded(docs.limit(3), Deal(shards=5))).collect()
    assert Counter(r.shard for r in few) == {0: 1, 1: 1, 2: 1}


def test_matrix_has_both_margins():
    rows = [5, 0, 1000, 17, 3]
    drawn = np.array(sharding.matrix(rows, Deal()))
    assert drawn.sum(1).tolist() == rows and drawn.sum(0).tolist() == sharding.sizes(1025, 8).tolist()


def test_matrix_is_that_of_a_uniform_deal():
    """Two files of two rows, two shards: the matrix of a permutation is mixed in 2 of 3 cases."""
    mixed = sum(sharding.matrix([2, 2], Deal(shards=2, seed=s))[0] == [1, 1] for s in range(3000))
    assert abs(mixed / 3000 - 2 / 3) < 0.03


def test_every_shard_is_as_likely_for_every_row():
    """Rows of two files in segments of two, three shards: each pair as often, over many seeds."""
    seen, seeds = Counter(), 3000
    for seed in range(seeds):
        deal = Deal(shards=3, seed=seed, segment=2)
        counts = sharding.matrix([3, 3], deal)
        for file_no in range(2):
            memory = {}
            for number in range(2):
                labels = sharding.segment_labels(deal, file_no, 3, np.array(counts[file_no]), number, memory)
                seen.update((file_no, number, i, int(shard)) for i, shard in enumerate(labels))
    assert len(seen) == 18 and all(abs(n / seeds - 1 / 3) < 0.04 for n in seen.values())


def test_draws_beyond_numpys_range():
    rng = np.random.default_rng(3)
    good, bad, drawn = 3 * 10**9, 5 * 10**9, 10**6
    got = np.array([sharding.hypergeometric(rng, good, bad, drawn) for _ in range(400)])
    spread = (drawn * 0.375 * 0.625) ** 0.5
    assert abs(got.mean() - 375_000) < 5 * spread / 20 and 0.85 < got.std() / spread < 1.15
    assert sharding.hypergeometric(rng, 2 * 10**9, 0, 7) == 7 and sharding.hypergeometric(rng, 0, 2 * 10**9, 7) == 0


@pytest.mark.parametrize("limit", [10**9, 1])
def test_both_ways_to_draw_agree(monkeypatch, limit):
    monkeypatch.setattr(sharding, "_SMALL", limit)
    rng = np.random.default_rng(1)
    got = Counter(sharding.hypergeometric(rng, 3, 4, 3) for _ in range(4000))
    for k, p in enumerate((4 / 35, 18 / 35, 12 / 35, 1 / 35)):
        assert abs(got[k] / 4000 - p) < 0.03
