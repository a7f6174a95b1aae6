"""Quality scores: held-out accuracy, pure functions of the text, odd rows."""

import numpy as np

from faregauge.llm import quality
from faregauge.llm.common import crc_class

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.trained(docs, labels)
    got = {r.doc_id: r for r in quality.quality(docs, model).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (crc_class(i, 3) == 1) for i, r in got.items())
    known = [(r.quality, got[r.doc_id].score) for r in labels.collect() if crc_class(r.doc_id, 3) == 1]
    y, s = np.array([a for a, _ in known]), np.array([b for _, b in known])
    rank = np.argsort(np.argsort(s))
    auc = (rank[y == 1].mean() - (y.sum() - 1) / 2) / (y == 0).sum()
    assert auc > 0.95 and ((s >= 0.5) == y).mean() > 0.95


def test_odd_rows(make):
    toxic = [f"you are such a mugglefly {w} and more" for w in "one two three four five six seven".split()] * 10
    plain = [f"you are such a nice {w} and more" for w in "one two three four five six seven".split()] * 10
    rows = [(i, t) for i, t in enumerate(toxic + plain)]
    labels = [(i, int(i < len(toxic)), 1) for i, _ in rows] + [(None, 1, 1), (5000, None, None)]
    extra = [(None, "mugglefly"), (900, None), (901, ""), (901, ""), (902, "such a nice " * 30_000)]
    docs = make([(i, t, "x", 0.5) for i, t in rows + extra], "doc_id long, text string, held_out string, score double")
    labels = make(labels, "doc_id long, quality int, toxic int")
    got = quality.quality(docs, quality.trained(docs, labels)).collect()
    assert len(got) == len(rows) + len(extra)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert quality.quality(docs.limit(0), quality.trained(docs, labels)).collect() == []
    even = quality.trained(docs, labels.limit(0))
    assert {r.score for r in quality.quality(docs, even).collect()} == {0.5}


def test_what_lies_far_in_long_texts_is_learned(make):
    start = " ".join(f"w{i % 97}" for i in range(2000))
    words = "one two three four five six seven eight nine ten".split()
    texts = [(i, f"{start} {words[i % 10]} " + ("mugglefly " if i % 2 else "harmless ") * (1 + i % 3) + words[i // 10 % 10]) for i in range(160)]
    docs = make(texts, "doc_id long, text string")
    labels = make([(i, i % 2) for i, _ in texts], "doc_id long, quality int")
    assert min(len(t) for _, t in texts) > 6000
    got = {r.doc_id: r.predicted for r in quality.quality(docs, quality.trained(docs, labels)).collect()}
    assert sum(got[i] == i % 2 for i in got) > 0.95 * len(texts)
