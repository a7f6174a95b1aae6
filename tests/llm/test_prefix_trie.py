"""Prefix trie against a plain one, with deep and hot conversations."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from faregauge.llm import prefix_trie

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            mark = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[conv].append((turn is not None, turn or 0, mark, (role, text)))
    own = {c: [t for *_, t in sorted(v)] for c, v in own.items()}
    members, kids = defaultdict(list), defaultdict(set)
    length = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        turns = tuple(own.get(int(c / 20) * 20, [])[:h] + own[c][h:])
        length[c] = len(turns)
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
            if d:
                kids[turns[: d - 1]].add(turns[:d])
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        saved[node] = (len(members[node]) - 1) * words + sum(saved[k] for k in kids[node])
    for node, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if length[c] == len(node)).encode()
        above = min(members[node[:-1]]) if node else None
        yield min(m), len(node), above, len(m), len(kids[node]), leaves[node], saved[node], hashlib.sha256(ends).hexdigest()


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple(map(str, r)))


def test_whole_table(spark):
    conversations = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = conversations.select("conv_id", "turn", "role", "text").collect()
    assert ordered(prefix_trie.prefix_trie(conversations.repartition(6)).collect()) == ordered(plain(rows))


@pytest.mark.parametrize(("band", "segment"), [(2, 3), (3, 4096), (16, 5)])
def test_shared_and_deep_conversations(make, monkeypatch, band, segment):
    monkeypatch.setattr(prefix_trie, "BAND", band)
    monkeypatch.setattr(prefix_trie, "SEGMENT", segment)
    draw = random.Random(band)
    rows = [(c, t, "u", draw.choice("ab") + " x" * draw.randrange(2)) for c in range(60) for t in range(draw.randrange(1, 9))]
    rows += [(c, t, "u", f"long {min(t, 40)}") for c in (100, 101, 103, 160) for t in range(50 + c % 7)]
    assert ordered(prefix_trie.prefix_trie(make(rows, SCHEMA)).collect()) == ordered(plain(rows))


def test_a_third_of_all_conversations_are_equal(make):
    rows = [(c, t, "u", f"turn {t}") for c in range(0, 4000, 20) for t in range(3)]
    rows += [(c, t, "u", f"{c} {t}") for c in range(7, 2400, 20) for t in range(3)]
    got = prefix_trie.ends_digests(
        make([(3, 1, 2, c) for c in range(5000)] + [(0, 0, 0, -5)], "depth long, k1 long, k2 long, conv_id long"), ids_per_row=7
    ).collect()
    whole = hashlib.sha256(",".join(map(str, range(5000))).encode()).hexdigest()
    assert sorted(map(tuple, got)) == [(0, 0, 0, hashlib.sha256(b"-5").hexdigest()), (3, 1, 2, whole)]
    assert ordered(prefix_trie.prefix_trie(make(rows, SCHEMA)).collect()) == ordered(plain(rows))


def test_odd_rows(make):
    rows = [(0, None, None, None), (0, 1, "a", "b c"), (0, 1, "a", "b c"), (1, 5, "", ""), (None, 1, "a", "b"), (-5, 0, "a", "b c")]
    rows += [(21, 0, "x", "y"), (2, 0, "a", "w " * 90_000), (3, 1, "a", "tie 2"), (3, 1, "a", "tie 1"), (4, 0, "1:a", "b"), (5, 0, "1", "ab")]
    frame = make([(*r, 1, "d") for r in rows], SCHEMA + ", depth int, digest string")
    assert ordered(prefix_trie.prefix_trie(frame).collect()) == ordered(plain(rows))
    assert prefix_trie.prefix_trie(frame.limit(0)).collect() == []
    # The family's first conversation is absent and all own turns are replaced: the root alone.
    lone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 > 0)
    alone = prefix_trie.prefix_trie(make([(lone, 0, "a", "b")], SCHEMA)).collect()
    assert [tuple(r)[:7] for r in alone] == [(lone, 0, None, 1, 0, 1, 0)]
