"""Toxicity scores: held-out accuracy, pure functions of the text, odd rows."""

import cProfile
import random

import numpy as np

from faregauge.llm import toxicity
from faregauge.llm.common import crc_class
from faregauge.llm.compression import sizer

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.trained(docs, labels)
    got = {r.doc_id: r for r in toxicity.toxicity(docs, model).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (crc_class(i, 5) == 0) for i, r in got.items())
    known = [(r.toxic, got[r.doc_id].score) for r in labels.collect() if crc_class(r.doc_id, 5) == 0]
    y, s = np.array([a for a, _ in known]), np.array([b for _, b in known])
    rank = np.argsort(np.argsort(s))
    auc = (rank[y == 1].mean() - (y.sum() - 1) / 2) / (y == 0).sum()
    assert auc > 0.95 and ((s >= 0.5) == y).mean() > 0.95
    clean = toxicity.without_toxic(docs, model)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.select("doc_id").collect()} == {i for i, r in got.items() if not r.predicted}


def test_odd_rows(make):
    toxic = [f"you are such a mugglefly {w} and more" for w in "one two three four five six seven".split()] * 10
    plain = [f"you are such a nice {w} and more" for w in "one two three four five six seven".split()] * 10
    rows = [(i, t) for i, t in enumerate(toxic + plain)]
    labels = [(i, 1, int(i < len(toxic))) for i, _ in rows] + [(None, 1, 1), (5000, None, None)]
    extra = [(None, "mugglefly"), (900, None), (901, ""), (901, ""), (902, "such a nice " * 30_000)]
    docs = make([(i, t, "x", 0.5) for i, t in rows + extra], "doc_id long, text string, held_out string, score double")
    labels = make(labels, "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(docs, toxicity.trained(docs, labels)).collect()
    assert len(got) == len(rows) + len(extra)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert toxicity.toxicity(docs.limit(0), toxicity.trained(docs, labels)).collect() == []
    even = toxicity.trained(docs, labels.limit(0))
    assert {r.score for r in toxicity.toxicity(docs, even).collect()} == {0.5}


def test_what_lies_far_in_long_texts_is_learned(make):
    start = " ".join(f"w{i % 97}" for i in range(2000))
    words = "one two three four five six seven eight nine ten".split()
    texts = [(i, f"{start} {words[i % 10]} " + ("mugglefly " if i % 2 else "harmless ") * (1 + i % 3) + words[i // 10 % 10]) for i in range(160)]
    docs = make(texts, "doc_id long, text string")
    labels = make([(i, i % 2) for i, _ in texts], "doc_id long, toxic int")
    assert min(len(t) for _, t in texts) > 6000
    got = {r.doc_id: r.predicted for r in toxicity.toxicity(docs, toxicity.trained(docs, labels)).collect()}
    assert sum(got[i] == i % 2 for i in got) > 0.95 * len(texts)


def test_phrases_and_unspaced_terms(make):
    rng = np.random.default_rng(3)
    parts = "ba de fi go hu ka le mi no pu ra se ti vo zu".split()
    words = list(rng.permutation([a + b + c for a in parts for b in parts for c in ("", "n", "rt")][:400]))
    signs = [chr(0x4E00 + i) for i in range(300)]
    for telling, harmless, glue, pool in (
        (" ".join(words[:5]), " ".join(words[4::-1]), " ", words),
        ("".join(signs[7:11]), "".join(signs[20:24]), "", signs),
    ):
        rows = []
        for i in range(300):
            text = list(rng.choice(pool, 40))
            for _ in range(2):
                text.insert(int(rng.integers(40)), telling if i % 2 else harmless)
            rows.append((i, glue.join(text)))
        docs = make(rows, "doc_id long, text string")
        labels = make([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
        got = {r.doc_id: r for r in toxicity.toxicity(docs, toxicity.trained(docs, labels)).collect()}
        held = [r for r in got.values() if r.held_out]
        assert sum(r.predicted == r.doc_id % 2 for r in held) > 0.85 * len(held), telling


def test_features_as_stated_at_few_calls():
    """Counts, shares and quantiles of the size differences; windows cost no Python call each."""
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(300)]
    ordinary, toxic = (toxicity.wide(" ".join(words[a : a + 60])) for a in (0, 40))
    rule = toxicity.ToxicityRule()
    pieces = [" ".join(words[a : a + 150]).encode() for a in (0, 100)]
    features = toxicity._Features(ordinary, toxic, *pieces, rule)
    word_sizes = [sizer(c, rule.least_match) for c in (ordinary, toxic)]
    text_sizes = [sizer(c, rule.text_match) for c in pieces]
    for text in ["", "one", " ".join(rng.choices(words, k=3000))]:
        gains = np.array([word_sizes[0](b) - word_sizes[1](b) for b in (toxicity.wide(f" {w} ") for w in toxicity.words_of(text))] or [0])
        above = [sum(g >= s for g in gains) for s in rule.steps]
        away = np.array([text_sizes[0](w) - text_sizes[1](w) for w in toxicity.text_windows(text, rule.text_window)] or [0])
        plain = [min(gains.max(), 30), np.log1p(len(gains)), *np.log1p(above), *[np.sqrt(a / len(gains)) for a in above]]
        plain += [min(away.max(), 60), away.mean(), *[np.quantile(away, q) for q in (0.25, 0.5, 0.75, 0.9)]]
        plain += [np.log1p(sum(d >= s for d in away)) for s in rule.text_steps]
        assert np.allclose(features(text), plain, rtol=1e-12, atol=0)
    profile = cProfile.Profile()
    profile.runcall(features, text)
    assert sum(entry.callcount for entry in profile.getstats()) < len(toxicity.text_windows(text, rule.text_window))
