"""Raking against a plain version; SQL twins of this folder's queries."""

import hashlib
import re
from collections import defaultdict

import duckdb
import pytest

from faregauge.llm import mixing, oracle, registry

SF = "/root/testdata/sf0.001"
POWERS = {"source": 0.7, "lang": 0.8, "topic": 0.5}


def plain(rows):
    """Probability per row of (doc_id, text, source, lang), in Python."""
    keys, tokens = [], []
    for _, text, source, lang in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        least = min((hashlib.md5(w.encode()).hexdigest() for w in words), default=None)
        topic = "none" if least is None else f"t{int(least[-1], 16) % 4}"
        keys.append((source or "", lang or "", topic))
        tokens.append(len(words))
    cells = defaultdict(float)
    for k, n in zip(keys, tokens):
        cells[k] += n
    total = sum(cells.values())
    weight = dict(cells)
    goals = []
    for i, power in enumerate(POWERS.values()):
        sums = defaultdict(float)
        for k, n in cells.items():
            sums[k[i]] += n
        mass = {c: n**power for c, n in sums.items() if n > 0}
        goals.append({c: m / sum(mass.values()) * total for c, m in mass.items()})
    for _ in range(8):
        for i, goal in enumerate(goals):
            sums = defaultdict(float)
            for k, w in weight.items():
                sums[k[i]] += w
            weight = {k: w * goal[k[i]] / sums[k[i]] if sums[k[i]] > 0 else w for k, w in weight.items()}
    return [min(0.8 * (weight[k] / cells[k] if cells[k] else 1), 1) for k in keys]


def test_against_plain(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source, r.lang) for r in docs.collect()]
    wanted = {r[0]: p for r, p in zip(rows, plain(rows))}
    got = mixing.mixed(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.probability == pytest.approx(wanted[r.doc_id], abs=1e-9)
        u = int(hashlib.md5(f"{r.doc_id}|7".encode()).hexdigest()[:12], 16) / 2**48
        assert r.kept == (u < r.probability)
    kept = mixing.sampled(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if r.kept}


def test_given_targets_are_met(make):
    rows = [(i, "w " * 10, f"s{i % 2 + (i % 7 == 0)}", "en" if i % 3 else "de") for i in range(200)]
    docs = make([(*r, "x") for r in rows], "doc_id long, text string, source string, lang string, tokens string")
    targets = {
        "source": make([("s0", 0.2), ("s1", 0.5), ("s2", 0.3), ("gone", 0.4)], "source string, share double"),
        "lang": make([("en", 0.5), ("de", 0.5)], "lang string, share double"),
    }
    cells = mixing.raked(mixing.cells_of(mixing.described(docs)), targets, 30).collect()
    by = defaultdict(float)
    for c in cells:
        by[c.source] += c.weight / 2000
        by[c.lang] += c.weight / 2000
    assert {k: round(v, 4) for k, v in by.items()} == {"s0": 0.2, "s1": 0.5, "s2": 0.3, "en": 0.5, "de": 0.5}


def test_kept_tokens_meet_the_targets(make):
    rows = [(i, "w " * 10, "hot" if i % 10 else "rare", "en" if i % 3 else "de") for i in range(3000)]
    docs = make(rows, "doc_id long, text string, source string, lang string")
    targets = {
        "source": make([("hot", 0.6), ("rare", 0.4)], "source string, share double"),
        "lang": make([("en", 0.5), ("de", 0.5)], "lang string, share double"),
    }

    def shares(rule):
        expected, drawn = defaultdict(float), defaultdict(float)
        for r in mixing.mixed(docs, rule, targets).collect():
            for c in (r.source, r.lang):
                expected[c] += r.tokens * r.probability
                drawn[c] += r.tokens * r.kept
        return [{c: n / (m["en"] + m["de"]) for c, n in m.items()} for m in (expected, drawn)]

    expected, drawn = shares(mixing.MixRule(whole_targets=True))
    for c, goal in {"hot": 0.6, "rare": 0.4, "en": 0.5, "de": 0.5}.items():
        assert expected[c] == pytest.approx(goal, abs=1e-3) and drawn[c] == pytest.approx(goal, abs=0.06)
    assert shares(mixing.MixRule())[0]["rare"] < 0.3


def test_odd_rows(make):
    rows = [(None, None, None, None), (1, "", "a", "en"), (1, "x y", None, "en"), (1, "x y", None, "en"), (2, "long " * 50_000, "", "de")]
    docs = make([(*r, 1) for r in rows], "doc_id long, text string, source string, lang string, probability int")
    assert len(mixing.mixed(docs).collect()) == len(rows)
    assert mixing.sampled(docs).schema == docs.schema
    assert mixing.mixed(docs.limit(0)).collect() == [] and mixing.sampled(docs.limit(0)).collect() == []


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_sql_twins(spark, name):
    from compare import differences

    connection = duckdb.connect()
    for table in ("documents", "pages", "labels", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    result = registry.queries()[name](spark, SF).toArrow()
    assert differences(result, connection.execute(oracle.oracle_sql()[name]).to_arrow_table()) is None
