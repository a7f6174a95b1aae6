"""Merkle fingerprints against a plain version, edits located by branches."""

import hashlib

from pyspark.sql import functions as F

from faregauge.llm import merkle

SF = "/root/testdata/sf0.01"


def edited(rows):
    texts = [t or "" for _, t in rows]
    out = []
    for i, text in enumerate(texts):
        k = len(text) // 4
        out.append(text[: len(text) - k] + texts[(i + 1) % len(texts)][:k])
    return out


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    got = {r.doc_id: r for r in merkle.fingerprints(docs.repartition(5)).collect()}
    assert len(got) == len(rows)
    for (number, text), other in zip(rows, edited(rows)):
        r = got[number]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(other.encode()).hexdigest()
        assert (r.fingerprint == r.edited_fingerprint) == (text == other)
    by_text = {}
    for number, text in rows:
        by_text.setdefault(text, set()).add(got[number].fingerprint)
    assert all(len(f) == 1 for f in by_text.values())
    assert len({f for s in by_text.values() for f in s}) == len(by_text)
    long = [got[n] for n, t in rows if len(t) > 300]
    assert sum(r.near_edited > 0.4 for r in long) > 0.95 * len(long)
    assert sum(r.near_edited > r.near_next for r in long) > 0.97 * len(long)


def test_odd_rows(spark, make):
    rows = [(1, "one two three four"), (2, None), (3, ""), (3, "x\ny\n\nz"), (4, "é" * 9), (5, "w " * 60_000), (None, "last")]
    docs = make([(i, t, 3) for i, t in rows], "doc_id long, text string, n_chars int").coalesce(1)
    got = merkle.fingerprints(docs).collect()
    wanted = edited(rows)
    assert sorted((r.doc_id or 99, r.n_chars, r.edited_sha256) for r in got) == sorted(
        (i or 99, len(t or ""), hashlib.sha256(e.encode()).hexdigest()) for (i, t), e in zip(rows, wanted)
    )
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert merkle.fingerprints(docs.limit(0)).collect() == []
    (alone,) = merkle.fingerprints(make([(7, "a b c d e f g h")], "doc_id long, text string")).collect()
    assert alone.near_next == 1.0


def test_branches_locate_edits(make):
    lines = [f"line {i} of a text." for i in range(40)]
    other = list(lines)
    other[3], other[29] = "changed", "also changed"
    pair = make([("\n".join(lines), "\n".join([*other, "more"]))], "a string, b string")
    found = pair.select(merkle.differing_paragraphs(merkle.tree(F.col("a")), merkle.tree(F.col("b"))).alias("d")).first()
    assert found.d == [3, 29, 40]


def test_hashes_of_the_tree_have_full_width(make):
    lines = [f"line {i} of a text." for i in range(9)]
    docs = make([("\n".join(lines),)], "text string")
    tree = merkle.tree(F.col("text"))
    got = docs.select(tree.alias("t"), merkle.fingerprint(tree).alias("f")).first()
    wide = [hashlib.sha256(x.encode()).hexdigest()[:32] for x in lines]
    assert [p["hash"] for p in got.t] == wide
    sections = [hashlib.sha256(",".join(part).encode()).hexdigest()[:32] for part in (wide[:8], wide[8:])]
    root = hashlib.sha256(",".join(["9", *sections]).encode()).hexdigest()[:32]
    assert got.f.startswith(root + ":" + sections[0][:12] + "=" + wide[0][:12] + "(")
    many = make([(" ".join(f"a{i}b{i}c." for i in range(100_000)),)], "text string")
    distinct = many.select(F.size(F.array_distinct(merkle.pieces(merkle.tree(F.col("text"))))).alias("n")).first().n
    assert distinct > 99_990


def test_no_python_and_one_shuffle_of_texts(spark):
    plan = merkle.fingerprints(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
