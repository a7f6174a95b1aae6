"""Near duplicates against all pairs, signatures against the true similarity."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa

from faregauge.llm import near_dedup
from faregauge.llm.near_dedup import NearRule
from faregauge.llm.shingles import shingle_bags

SF = "/root/testdata/sf0.01"


def bag(text, words=5):
    w = (text or "").encode().split()
    return Counter([tuple(w)] if 0 < len(w) < words else [tuple(w[i : i + words]) for i in range(len(w) - words + 1)])


def likeness(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def brute_classes(texts):
    bags = [bag(t) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = {}
    for i, b in enumerate(bags):
        for s in b:
            holders.setdefault(s, []).append(i)
    pairs = {(i, j) for held in holders.values() for i in held for j in held if i < j}
    empty = [i for i, b in enumerate(bags) if not b]
    pairs |= set(zip(empty, empty[1:]))
    for i, j in pairs:
        if not bags[i] or likeness(bags[i], bags[j]) >= 0.8:
            a, b = sorted((root(i), root(j)))
            parent[b] = a
    return [root(i) for i in range(len(texts))]


def check(docs, rows):
    got = near_dedup.near_duplicates(docs).collect()
    wanted = brute_classes([t for _, t in rows])
    groups = {}
    for (number, _), r in zip(rows, wanted):
        groups.setdefault(r, []).append(number)
    late = lambda n: (n is None, n or 0)
    expected = Counter((n, min(g, key=late), len(g)) for g in groups.values() for n in g)
    assert Counter((r.doc_id, r.class_id, r.class_size) for r in got) == expected
    assert sum(r.kept for r in got) == len(groups)
    assert all(r.doc_id == r.class_id for r in got if r.kept)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check(docs, [(r.doc_id, r.text) for r in docs.collect()])


def test_chains_ties_and_odd_rows(spark, make):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(500)]
    base = [rng.choice(words) for _ in range(120)]
    rows, number = [], 0
    text = list(base)
    for step in range(40):  # a chain: neighbours are alike, the ends are not
        rows.append((number, " ".join(text)))
        number += 1
        text[(step * 3) % 120] = rng.choice(words)
    other = [rng.choice(words) for _ in range(100)]
    for _ in range(60):  # a family about as alike as the limit
        text = list(other)
        for _ in range(rng.randint(1, 3)):
            text[rng.randrange(100)] = rng.choice(words)
        rows.append((number, " ".join(text)))
        number += 1
    rows += [(900, ""), (901, None), (902, " \n"), (None, "one two"), (903, "one  two"), (903, "one two"), (904, "a " * 5000), (905, "a " * 4100), (906, "a " * 3000)]
    rows += [(None, rows[0][1]), (2, rows[2][1])]
    docs = make([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, bucket string, size int")
    check(docs, rows)
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(brute_classes([t for _, t in rows])))
    assert near_dedup.near_duplicates(docs.limit(0)).collect() == []


def test_registers_agree_as_often_as_texts_overlap():
    rng = random.Random(1)
    words = [f"w{i}" for i in range(60)]
    a = ["x"] * 200 + [rng.choice(words) for _ in range(300)]
    b = ["x"] * 90 + a[200:] + [rng.choice(words) for _ in range(40)]
    texts = [" ".join(a), " ".join(b)]
    registers = 20_000
    text, shingle, weight = shingle_bags(pa.array(texts))
    times = near_dedup.signatures(text, shingle, weight, 2, registers)
    true = likeness(bag(texts[0]), bag(texts[1]))
    assert abs(np.mean(times[0] == times[1]) - true) < 4 * (true * (1 - true) / registers) ** 0.5


def test_one_bucket_shared_by_texts_that_are_not_alike(spark, make):
    """With one register per band nearly all members of a bucket are false candidates."""
    rng = random.Random(9)
    common = " ".join(f"c{i}" for i in range(60))
    rows = [(i, common + " " + " ".join(f"d{rng.randrange(10**6)}" for _ in range(60))) for i in range(30)]
    rows += [(100 + i, rows[i][1] + " end") for i in range(0, 30, 3)]
    docs = make(rows, "doc_id long, text string")
    rule = NearRule(bands=25, registers=1)
    got = near_dedup.near_duplicates(docs, rule).collect()
    assert {r.doc_id: r.class_id for r in got} == {n: n % 100 for n, _ in rows}


def test_least_node_of_each_component(make):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 50), (100, 60), (100, 70), (7, 7)]
    got = {r.node: r.root for r in near_dedup.components(make(edges, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(2, 41)} | {60: 50, 70: 50, 100: 50}


def test_sketches_let_similar_texts_pass():
    """The bound is the binomial tail, and pairs just above the limit pass it."""
    rule = NearRule()
    draws = np.random.default_rng(5).binomial(rule.size, 0.8, 2_000_000)
    assert (draws < rule.agreeing).sum() <= 12
    assert (draws < rule.agreeing + 10).sum() > 100
    rng = random.Random(6)
    texts = []
    for _ in range(200):
        words = [f"w{rng.randrange(10**6)}" for _ in range(400)]
        texts += [" ".join(words), " ".join("x" if i % 50 == 25 else w for i, w in enumerate(words))]
    for a, b in zip(texts[::2], texts[1::2], strict=True):
        assert 0.8 <= likeness(bag(a), bag(b)) < 0.82
    text, shingle, weight = shingle_bags(pa.array(texts))
    found = near_dedup.sketches(near_dedup.signatures(text, shingle, weight, len(texts), rule.size))
    assert ((found[::2] == found[1::2]).sum(1) >= rule.agreeing).all()


def test_blocks_smaller_than_buckets(spark, make):
    """Many copies with small changes and many unlike texts in one bucket, in blocks of 4."""
    rng = random.Random(12)
    common = [f"c{i}" for i in range(60)]
    rows = []
    for i in range(12):
        own = common + [f"d{rng.randrange(10**6)}" for _ in range(60)]
        rows += [(10 * i + j, " ".join(own + [f"e{j}"])) for j in range(rng.randrange(1, 9))]
    docs = make(rows, "doc_id long, text string")
    got = near_dedup.near_duplicates(docs, NearRule(bands=25, registers=1, block=4)).collect()
    assert {r.doc_id: r.class_id for r in got} == {n: n // 10 * 10 for n, _ in rows}


def test_copies_are_signed_once_and_keys_move_once(spark, make):
    """Copies send their keys once a task, and one exchange finds, counts and drops them."""
    rng = random.Random(21)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(80)) for _ in range(6)]
    rows = [(i, texts[i % 6] + "\n" * (i % 3)) for i in range(600)] + [(600, ""), (601, None)]
    rows += [(700 + i, t + " end") for i, t in enumerate(texts[:4])]
    docs = near_dedup.numbered(make(rows, "doc_id long, text string").coalesce(1))
    signed = near_dedup.stored(near_dedup.signed(docs, NearRule()), "signed")
    assert signed.where("size(bands) > 0").count() == 10
    first = signed.where("size(bands) > 0").select("doc_id").collect()
    assert sorted(r.doc_id for r in first) == [0, 1, 2, 3, 4, 5, 700, 701, 702, 703]
    shared = near_dedup.shared_buckets(signed)
    plan = shared._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(bucket") == plan.count("Exchange") == 1
    assert {r.n for r in shared.collect()} == {2}
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs.drop("_near_row")).collect()}
    assert got == {i: i % 6 for i in range(600)} | {600: 600, 601: 600} | {700 + i: i for i in range(4)}
    # The same from several tasks, each of which signs its own copies.
    spread = make(rows, "doc_id long, text string").repartition(5, "doc_id")
    signed = near_dedup.stored(near_dedup.signed(near_dedup.numbered(spread), NearRule()), "signed")
    assert signed.where("size(bands) > 0").count() > 10
    assert {r.n for r in near_dedup.shared_buckets(signed).collect()} == {2}
    assert {r.doc_id: r.class_id for r in near_dedup.near_duplicates(spread).collect()} == got


def test_a_pair_left_open_is_compared_once(spark, make, monkeypatch):
    """Families of three below the limit: two pairs are the pivot's, the third goes to one of its buckets."""
    rng = random.Random(31)
    rows = []
    for family in range(60):
        base = [f"c{rng.randrange(10**6)}" for _ in range(150)]
        for _ in range(3):
            words = list(base)
            for at in rng.sample(range(150), 3):
                words[at] = f"d{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(words)))
    moved, linked = [], near_dedup.linked

    def spy(cells, docs, rule):
        moved.append(cells.collect())
        return linked(cells, docs, rule)

    monkeypatch.setattr(near_dedup, "linked", spy)
    check(make(rows, "doc_id long, text string").coalesce(1), rows)
    families = Counter(r[near_dedup.ROW] // 3 for r in moved[1])
    assert len(families) > 15 and set(families.values()) == {2}
    asking = Counter(r[near_dedup.ROW] // 3 for r in moved[1] if r.asks)
    assert set(asking.values()) == {1}
