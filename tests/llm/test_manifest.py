"""Dataset manifest against a plain version, with one and with many rounds of blocks."""

import hashlib
import zlib

import pytest

from faregauge.llm import manifest

SF = "/root/testdata/sf0.01"
NAMES = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def climbed(tree, i, node):
    proof = ""
    for level in tree[:-1]:
        start = i // 8 * 8
        left, right = "".join(level[start:i]), "".join(level[i + 1 : start + 8])
        proof, node, i = proof + left + right, digest(left, node, right), i // 8
    return proof, node


def lowered(text):
    return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain(rows):
    langs = sorted({r[2] for r in rows}, key=lambda lang: (lang is not None, (lang or "").encode()))
    by = {lang: sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for lang in langs}
    trees = {lang: levels([leaf(r) for r in by[lang]]) for lang in langs}
    top = levels([trees[lang][-1][0] for lang in langs])
    for place, lang in enumerate(langs):
        for i, row in enumerate(by[lang]):
            tampered = zlib.crc32(b"" if row[0] is None else str(row[0]).encode()) % 3 == 0
            start = leaf((*row[:4], lowered(row[4])) if tampered else row)
            proof, node = climbed(trees[lang], i, start)
            rest, node = climbed(top, place, node)
            yield row[0], leaf(row), trees[lang][-1][0], top[-1][0], digest(proof + rest), node, node == top[-1][0]


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple(map(str, r)))


@pytest.mark.parametrize("block_levels", [1, 3])
def test_whole_table(spark, monkeypatch, block_levels):
    monkeypatch.setattr(manifest, "LEVELS", block_levels)
    monkeypatch.setattr(manifest, "BLOCK", 8**block_levels)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = manifest.manifest(docs.repartition(7))
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
    assert ordered(got.collect()) == ordered(plain(docs.select(*NAMES).collect()))


def test_odd_rows(make):
    rows = [(None, None, None, None, None), (1, "a", None, 3, "ABC"), (1, "a", None, 3, "ABC"), (1, "a", None, 3, "xyz")]
    rows += [(2, "", "", 0, ""), (3, "s", "de", 1, "ÄA"), (-4, "s", "é", 9, None), (6, "s", "en", 2, "Long Text " * 60_000)]
    rows += [(i, "s", "en", i, f"Text {i % 3}") for i in range(7, 90)]
    schema = "doc_id long, source string, lang string, n_chars long, text string, tree string, pos int"
    docs = make([(*r, "x", 1) for r in rows], schema)
    assert ordered(manifest.manifest(docs).collect()) == ordered(plain(rows))
    assert manifest.manifest(docs.limit(0)).collect() == []
    (alone,) = manifest.manifest(docs.where("lang = 'de'")).collect()
    assert alone.leaf == alone.subroot == alone.root and alone.proof_sha256 == digest("")


def test_every_run_length(make):
    """A language for each size, so blocks and runs end at every place."""
    rows = [(i, "s", f"l{n}", 1, f"T{i}") for n in (1, 2, 7, 8, 9, 63, 64, 65, 511, 512, 513, 1025) for i in range(n)]
    got = manifest.manifest(make(rows, "doc_id long, source string, lang string, n_chars long, text string"))
    assert ordered(got.collect()) == ordered(plain(rows))
