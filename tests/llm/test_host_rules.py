"""Host rules: counts on odd texts, hosts with few documents, hosts that fail."""

import random
import re

from faregauge.llm import host_rules


def plain_repeats(words):
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    again = {i for i, w in enumerate(windows) if windows.count(w) > 1}
    return len({i + k for i in again for k in range(3)})


def test_counts_on_random_texts():
    rng = random.Random(8)
    for _ in range(500):
        text = "".join(rng.choice(["a", "b ", "c\n", " ", "\x0b", "\x1c", "é", "#", "\n\n", "\xa0"]) for _ in range(rng.randint(0, 60)))
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert host_rules.text_counts(text) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), plain_repeats(words),
        )


def test_small_hosts_are_shrunk_and_bad_hosts_fall(make):
    good = " ".join(f"w{i}" for i in range(80))
    rows = [(i, "bad", "short" if i % 10 else good) for i in range(200)]
    rows += [(1000 + i, f"h{i % 20}", good if i % 12 else "short") for i in range(2000)]
    rows += [(5000, "tiny", "short"), (5001, "tiny", good), (5002, None, good), (5003, "h1", None), (5003, "h1", None)]
    docs = make([(i, t, h, 1) for i, h, t in rows], "doc_id long, text string, source string, n_words int")
    got = host_rules.host_rules(docs).collect()
    assert len(got) == len(rows)
    rejected = {r.host for r in got if r.host_rejected}
    assert rejected == {"bad"}
    assert all(r.kept == (not r.base_failed and r.host != "bad") for r in got)
    assert host_rules.host_rules(docs.limit(0)).collect() == []
