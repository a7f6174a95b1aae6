"""Personal data: base rules against the plain patterns, added spans, masking."""

import hashlib
import random
import re

import numpy as np

from faregauge.llm import boosting, pii

SF = "/root/testdata/sf0.1"


def plain(text):
    """The patterns as stated, without the shortcuts."""
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    card, phone = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
    out = [("email", m.start(), m.end()) for m in email.finditer(text)]
    out += [("ip", m.start(), m.end()) for m in ip.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in card.finditer(text):
        d = re.sub("[^0-9]", "", m.group())
        s = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(d[::-1]))
        if 16 <= len(d) <= 19 and s % 10 == 0:
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in phone.finditer(text) if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return out


def test_base_rules_on_random_texts():
    rng = random.Random(2)
    pieces = ["a", "b@", "@c.d", ".", "1", "25", "256.", "1.2.3.4", "+", "(", ")", " ", "-", "4111 1111 1111 1111", "é", "+1 (771) 555-1655", "x.y@z", "\n"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 25)))
        assert pii.base_spans(text) == plain(text)


def test_whole_table_and_masking(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = pii.trained(docs)
    rows = {r.doc_id: r.text for r in docs.collect()}
    got = pii.personal_data(docs, model).collect()
    assert len(got) == len(rows)
    for r in got:
        base = plain(rows[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(pii.written(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert set(pii.written(base).split(",")) <= set(r.spans.split(",")) | {""}
    clean = pii.redacted(docs, model)
    assert clean.columns == docs.columns
    assert all(not plain(r.text) and r.n_chars == len(r.text) for r in clean.collect())


def test_other_formats_are_added(spark):
    model = pii.trained(spark.read.parquet(f"{SF}/documents.parquet"))
    text = "on the way. call (771) 555-1655 the nd, and write ann (at) mail3.example.com of the."
    ((base, spans),) = pii.found_spans([text], model)
    assert base == [] and {s[0] for s in spans} <= set(pii.KINDS) and spans
    ((_, none),) = pii.found_spans(["on the way of 12 things, in 2024, page 311"], model)
    assert none == []


def test_unlabelled_other_formats_are_no_negatives(make):
    rng = random.Random(5)
    words = "the way call write of next house and river stone paper".split()
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    n = lambda k: "".join(rng.choice("123456789") for _ in range(k))
    known = lambda: rng.choice([f"+1 ({n(3)}) {n(3)}-{n(4)}", f"{rng.choice(words)}{n(2)}@mail{n(1)}.example.com"])
    other = lambda: rng.choice([f"({n(3)}) {n(3)}-{n(4)}", f"{rng.choice(words)}{n(2)} (at) mail{n(1)}.example.com"])
    plain_numbers = lambda: rng.choice([f"20{n(2)}-0{n(1)}-1{n(1)}", f"{n(12)}", f"look at {rng.choice(words)}.html"])
    texts = [f"{say(6)} {known()} {say(6)} {other()} {say(5)} {other()} {say(4)} {plain_numbers()} {say(3)} {plain_numbers()} {say(3)}" for _ in range(300)]
    model = pii.trained(make([(t,) for t in texts], "text string"))
    asked = ["the way (771) 555-1655 of the house", "and write river12 (at) mail3.example.com of next"]
    assert [[s[0] for s in added] for _, added in pii.found_spans(asked, model)] == [["phone"], ["email"]]
    ((_, none),) = pii.found_spans(["the river 2024-01-15 of stone 518274619283 paper"], model)
    assert none == []


def test_odd_rows(make):
    rows = [(1, None), (None, "x@y.zz"), (2, ""), (2, "x@y.zz"), (3, "9" * 100_000), (4, "a" * 200_000 + "@"), (5, "1." * 50_000)]
    docs = make([(i, t, "s", 3) for i, t in rows], "doc_id long, text string, spans string, n_chars int")
    model = pii.trained(docs)
    got = pii.personal_data(docs, model).collect()
    assert sorted((r.doc_id or 0, r.n_email) for r in got) == [(0, 1), (1, 0), (2, 0), (2, 1), (3, 0), (4, 0), (5, 0)]
    back = pii.redacted(docs, model)
    assert back.schema == docs.schema and {r.text for r in back.where("doc_id = 1 or doc_id is null").collect()} == {None, "[EMAIL]"}
    assert pii.personal_data(docs.limit(0), pii.trained(docs.limit(0))).collect() == []


def test_every_text_and_span_is_learned_from(make):
    """No prefilter, no limit of texts, no limit of spans in a text: sums over all rows are the plain ones."""
    rng = random.Random(9)
    n = lambda k: rng.randint(1, k)
    ip = lambda: f"{n(9)}.{n(9)}.{n(9)}.{n(9)}"
    texts = [f"the way of {ip()} and stone {n(40)} river" for _ in range(1700)]
    texts += [f"the way of {n(9)}99.888.777.666 and stone" for _ in range(300)] + [" house ".join(ip() for _ in range(30)), None, ""]
    docs = make([(t,) for t in texts], "text string")
    model = pii.trained(docs)
    ((_, spans),) = pii.found_spans(["the way of 7[.]2[.]5[.]4 and stone"], model)
    assert [s[0] for s in spans] == ["ip"]
    plain_rows = [r for t in texts for r in zip(*pii.training_rows(t or "", pii.PiiRule()))]
    rows = pii.training_table(docs).collect()
    assert sum(r.n for r in rows) == len(plain_rows) >= 2 * 1730 + 300
    assert sum(r.hits for r in rows) == sum(y for _, y, _ in plain_rows)
    assert {(r.kind, tuple(r.x)) for r in rows} == {(k, tuple(x)) for x, _, k in plain_rows}


def test_trees_from_counted_vectors(make):
    """Cuts and leaves as on the repeated rows, whatever the partitioning."""
    rng = random.Random(4)
    rows = [([rng.randint(0, 30), rng.randint(0, 3)], rng.randint(1, 5)) for _ in range(400)]
    rows = [(x, n, n if x[0] > 11 and x[1] < 2 else 0) for x, n in rows]
    frame = make(rows, "x array<int>, n long, hits long")
    trees = boosting.BoostedTrees(trees=4).fit(frame.repartition(7))
    again = boosting.BoostedTrees(trees=4).fit(frame.coalesce(1))
    assert all(np.array_equal(a, b) for t, u in zip(trees.grown, again.grown) for a, b in zip(t, u))
    x = np.array([x for x, _, _ in rows])
    assert np.array_equal(trees.score(x) >= 0.5, (x[:, 0] > 11) & (x[:, 1] < 2))
    whole = np.repeat(x[:, 0], [n for _, n, _ in rows])
    assert np.allclose(trees._cuts(frame)[0], np.unique(np.quantile(whole, np.linspace(0, 1, 17)))[:-1])
    # The first leaves: sums of slopes over all rows that reach them.
    feature, threshold, value = trees.grown[0]
    share = sum(h for _, _, h in rows) / sum(n for _, n, _ in rows)
    leaf = trees._reached(x, trees.grown[0], 3) - 7
    for place in set(leaf.tolist()):
        here = [r for r, at in zip(rows, leaf) if at == place]
        top, low = sum(h - n * share for _, n, h in here), sum(n * share * (1 - share) for _, n, _ in here)
        assert abs(value[place] - 0.3 * top / (low + 1)) < 1e-5


def test_many_spans_in_a_text():
    spans = [("ip", 10 * i, 10 * i + 7) for i in range(60)] + [("card", 95, 120), ("phone", 5, 33)]
    known = pii._Spans(spans)
    for start in range(0, 640):
        for size in (1, 3, 7, 25):
            asked = ("ip", start, start + size)
            assert known.apart(asked) == all(asked[2] <= s or e <= start for _, s, e in spans)
            near = any(k == "ip" and start <= e and s <= asked[2] and abs(s - start) <= 4 and abs(e - asked[2]) <= 2 for k, s, e in spans)
            assert known.near(asked) == near
