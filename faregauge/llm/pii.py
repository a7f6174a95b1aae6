"""Personal data: high-recall candidates, boosted trees, calibrated thresholds.

Base rules find e-mail and IP addresses, cards and phone numbers exactly. Generators with
loose patterns propose further spans, which may overlap: other ways to write the same four
kinds. Boosted trees score a candidate by its format and its surroundings, and those above
the threshold of their kind are added, best first, where they touch nothing found before.

The trees learn from the whole corpus without hand labels. Spans of the base rules in all
texts are rewritten in other formats, in place, and serve as positives next to the
originals. Candidates that touch no base span are negatives only if they can't be what they
look like: those in one of the other formats that pass the checks of their kind (Luhn, octet
range, number of digits) may be real, and teach nothing. The threshold of a kind is the
lowest that keeps the wanted precision on the third of the texts not used for growing; a
kind that reaches it nowhere adds nothing. Tasks turn texts into vectors of small integers
and count equal ones, and all that is learned are sums over these counts.

Offsets are code points, the end exclusive. Null text counts as empty: no spans, and
``redacted`` keeps it null. Whole texts are searched. Repeated rows get equal results; an
empty table gives no rows (and trees that add nothing). ``redacted`` returns all columns.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faregauge.llm.boosting import BoostedTrees, matrix
from faregauge.llm.common import by_batch, prepare, stored, text_or_empty

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

# Fixed patterns of the base rules. E-mail is found from its at sign outwards and an IP
# from the first digit of a run, which gives the same matches in linear time.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_AT_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# What the generators propose, beyond the base rules.
CANDIDATES = {
    "email": re.compile(
        r"(?<![\w.@])[\w.%+-]{1,64}\s?(?:\(at\)|\[at\]|\{at\}| at |@)\s?[\w-]{1,63}(?:\s?(?:\.|\(dot\)|\[dot\]| dot )\s?[\w-]{2,63}){1,4}", re.I
    ),
    "ip": re.compile(r"(?<![0-9])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|[.,_-])[0-9]{1,3}){3}(?![0-9])"),
    "card": re.compile(r"(?<![0-9])[0-9](?:[ ._/-]{0,2}[0-9]){12,18}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9])(?:00|\+)?[0-9(][0-9]{0,3}[ ().0-9/-]{5,18}[0-9](?![0-9])"),
}
_HINTS = (
    re.compile(r"(?i)mail|contact|write|@"),
    re.compile(r"(?i)\bip\b|host|server|addr|login"),
    re.compile(r"(?i)card|visa|credit|pay|account"),
    re.compile(r"(?i)phone|tel|call|fax|mobile|cell"),
    re.compile(r"(?i)version|release|page|vol|token|key|hash|id\b"),
)
AROUND = 24
# Every e-mail candidate holds one of these.
_AT = ("@", "(at)", "[at]", "{at}", " at ")
# Thresholds are multiples of one part in so many.
SCORES = 1 << 16


@dataclass(frozen=True)
class PiiRule:
    """The precision that an added kind must reach; the seed of formats and of the unseen third."""

    precision: float = 0.98
    seed: int = 11


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[Span]:
    free = 0
    for found in _AT_DOMAIN.finditer(text):
        start = found.start()
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < found.start():
            free = found.end()
            yield "email", start, free


def base_spans(text: str) -> list[Span]:
    """Spans of the base rules, by kind as listed, then by start."""
    spans = list(_emails(text)) if "@" in text else []
    spans += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-9:]) <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        number = digits_of(m.group()) if m.end() - m.start() <= 40 else ""
        if 16 <= len(number) <= 19 and luhn(number):
            spans.append(("card", m.start(), m.end()))
    if "+" in text:
        spans += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(digits_of(m.group())) <= 15]
    return spans


def candidates(text: str) -> list[Span]:
    """Overlapping proposals of all generators."""
    found = []
    lower = text.lower()
    for kind in KINDS:
        if kind == "email" and not any(at in lower for at in _AT):
            continue
        found += [(kind, m.start(), m.end()) for m in CANDIDATES[kind].finditer(text)]
    return found


def features(text: str, span: Span) -> list[int]:
    """Format and surroundings of a candidate; not whether a base rule takes it."""
    kind, start, end = span
    body, before, after = text[start:end], text[max(0, start - AROUND) : start], text[end : end + AROUND]
    number = digits_of(body)
    groups = [g for g in re.split(r"[^0-9]+", body) if g]
    nearby = before + " " + after
    return [
        *[int(kind == k) for k in KINDS],
        len(body),
        len(number),
        len(groups),
        max(map(len, groups), default=0),
        min(map(len, groups), default=0),
        sum(c.isalpha() for c in body),
        body.count(" "),
        body.count("-"),
        body.count("."),
        body.count("(") + body.count(")"),
        body.count("[") + body.count("{"),
        int("@" in body or "at" in body.lower()),
        int(body[:1] == "+" or before[-1:] == "+"),
        int(bool(number) and luhn(number)),
        int(len(groups) == 4 and all(int(g[:9]) <= 255 for g in groups)),
        int(before[-1:].isspace() or not before),
        int(after[:1].isspace() or not after),
        int(before[-1:].isalnum()),
        int(after[:1].isalnum()),
        sum(c.isdigit() for c in nearby),
        *[int(bool(h.search(nearby))) for h in _HINTS],
    ]


class _Spans:
    """Spans by start, each with the last end up to it: what touches a span takes a search."""

    def __init__(self, spans: list[Span]):
        self._starts = sorted(s[1] for s in spans)
        self._ends = list(accumulate((e for _, e in sorted(s[1:] for s in spans)), max))
        self._by_kind = {k: sorted(s[1:] for s in spans if s[0] == k) for k in KINDS}

    def apart(self, span: Span) -> bool:
        before = bisect_left(self._starts, span[2])
        return not before or self._ends[before - 1] <= span[1]

    def near(self, span: Span) -> bool:
        """Whether a span of the same kind touches this one and has almost the same ends."""
        kind, start, end = span
        own = self._by_kind[kind]
        for s, e in own[bisect_left(own, (start - 4, -1)) : bisect_left(own, (start + 5, -1))]:
            if start <= e and s <= end and abs(e - end) <= 2:
                return True
        return False


def rewritten(kind: str, body: str, rng: random.Random) -> str:
    """The same datum in another format, for training."""
    number = digits_of(body)
    if kind == "email":
        at, dot = rng.choice([(" (at) ", "."), (" [at] ", " [dot] "), ("(at)", "(dot)"), (" at ", " dot ")])
        return body.replace("@", at).replace(".", dot)
    if kind == "ip":
        return body.replace(".", rng.choice(["[.]", "(.)"]))
    if kind == "card":
        return rng.choice([".", "/", " - "]).join(number[i : i + 4] for i in range(0, len(number), 4))
    local = number[-10:]
    return rng.choice(["({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "001 {} {} {}"]).format(local[:3], local[3:6], local[6:])


# What real data in other formats looks like, as far as the form tells.
_OTHER_EMAIL = re.compile(r"\s?(?:\(at\)|\[at\]|\{at\})\s?|\(dot\)|\[dot\]| dot |@\s|\s@", re.I)
_DATE = re.compile(r"(?<![0-9])(?:(?:19|20)[0-9]{2}([-./ ])[01]?[0-9]\1[0-3]?[0-9]|[0-3]?[0-9]([-./ ])[0-3]?[0-9]\2(?:19|20)[0-9]{2})(?![0-9])")


def plausible(kind: str, body: str) -> bool:
    """Whether a candidate may be real personal data that no base rule knows."""
    number = digits_of(body)
    groups = [g for g in re.split(r"[^0-9]+", body) if g]
    if kind == "email":
        return bool(_OTHER_EMAIL.search(body))
    if kind == "ip":
        return all(int(g) <= 255 for g in groups)
    if kind == "card":
        return 13 <= len(number) <= 19 and luhn(number)
    national = 2 <= len(groups) <= 6 and max(map(len, groups)) <= 8
    return 7 <= len(number) <= 15 and national and not _DATE.search(body)


def training_rows(text: str, rule: PiiRule) -> tuple[list[list[int]], list[int], list[str]]:
    """Features, labels and kinds of candidates of a text and of its rewritten forms."""
    rng = random.Random(f"{rule.seed}|{text}")
    x, y, kinds = [], [], []

    def take(text: str, truth: list[Span]) -> None:
        known = _Spans(truth)
        for span in candidates(text):
            same = known.near(span)
            if same or (known.apart(span) and not plausible(span[0], text[span[1] : span[2]])):
                x.append(features(text, span))
                y.append(int(same))
                kinds.append(span[0])

    spans = base_spans(text)
    take(text, spans)
    for kind, start, end in spans:
        body = rewritten(kind, text[start:end], rng)
        near = text[max(0, start - 80) : start], text[end : end + 80]
        changed = near[0] + body + near[1]
        others = base_spans(near[0]) + [(k, s + len(changed) - len(near[1]), e + len(changed) - len(near[1])) for k, s, e in base_spans(near[1])]
        take(changed, [(kind, len(near[0]), len(near[0]) + len(body)), *others])
    return x, y, kinds


@dataclass(frozen=True)
class PiiModel:
    """Trees and the threshold of each kind; above 1 where a kind adds nothing."""

    trees: BoostedTrees
    thresholds: dict[str, float]


def training_table(docs: DataFrame, rule: PiiRule | None = None) -> DataFrame:
    """(kind, unseen, x, n, hits) of the candidates of all texts, counted by their features.

    A text is unseen by the trees, in all its copies, or seen.
    """
    rule = rule or PiiRule()
    prepare(docs.sparkSession)
    unseen = F.pmod(F.xxhash64("text", F.lit(rule.seed)), F.lit(3)) == 2
    texts = docs.select(text_or_empty().alias("text")).withColumn("unseen", unseen)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, hits = Counter(), Counter()
        for text, late in zip(batch.column("text").to_pylist(), batch.column("unseen").to_pylist(), strict=True):
            for x, y, kind in zip(*training_rows(text, rule), strict=True):
                counts[kind, late, tuple(x)] += 1
                hits[kind, late, tuple(x)] += y
        kinds, late, x = zip(*counts, strict=True) if counts else ((), (), ())
        types = (pa.string(), pa.bool_(), pa.list_(pa.int32()), pa.int64(), pa.int64())
        columns = (kinds, late, x, [*counts.values()], [hits[c] for c in counts])
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["kind", "unseen", "x", "n", "hits"])

    rows = by_batch(texts, lambda: step, "kind string, unseen boolean, x array<int>, n long, hits long")
    return rows.groupBy("kind", "unseen", "x").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))


def lowest_thresholds(rows: DataFrame, trees: BoostedTrees, rule: PiiRule) -> dict[str, float]:
    """Per kind the least score from 0.5 on above which the wanted share of ``rows`` is right."""

    def scored(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = np.floor(trees.score(matrix(batch.column("x"))) * SCORES).astype(np.int64) if len(batch) else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([*batch.select(["kind", "n", "hits"]).columns, pa.array(at)], ["kind", "n", "hits", "at"])

    counted = by_batch(rows, lambda: scored, "kind string, n long, hits long, at long").where(F.col("at") >= SCORES // 2)
    steps = counted.groupBy("kind", "at").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")).collect()
    thresholds = dict.fromkeys(KINDS, 2.0)
    for kind in KINDS:
        n = hits = 0
        for r in sorted((r for r in steps if r["kind"] == kind), key=lambda r: -r["at"]):
            n, hits = n + r["n"], hits + r["hits"]
            if hits >= 5 and hits >= rule.precision * n:
                thresholds[kind] = r["at"] / SCORES
    return thresholds


def trained(docs: DataFrame, rule: PiiRule | None = None) -> PiiModel:
    """The model from all texts: trees from two thirds of them, thresholds from the other."""
    rule = rule or PiiRule()
    rows = stored(training_table(docs, rule), "candidates")
    total, hits = (int(v or 0) for v in rows.agg(F.sum("n"), F.sum("hits")).first())
    if total < 50 or not 0 < hits < total:
        return PiiModel(BoostedTrees(), dict.fromkeys(KINDS, 2.0))
    trees = BoostedTrees().fit(rows.where("NOT unseen"))
    return PiiModel(trees, lowest_thresholds(rows.where("unseen"), trees, rule))


def _fits(span: Span, added: list[tuple[int, int]]) -> bool:
    """Whether a span touches none of the sorted spans, which touch none of each other."""
    place = bisect_left(added, (span[2], -1))
    return not place or added[place - 1][1] <= span[1]


def found_spans(texts: list[str], model: PiiModel) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) per text; candidates of all texts are scored at once."""
    base = [base_spans(t) for t in texts]
    taken = [_Spans(b) for b in base]
    proposed = [(i, s) for i, t in enumerate(texts) for s in candidates(t) if taken[i].apart(s)]
    all_spans = [list(b) for b in base]
    added: list[list[tuple[int, int]]] = [[] for _ in texts]
    if proposed and model.trees.grown:
        scores = model.trees.score(np.array([features(texts[i], s) for i, s in proposed]))
        for at in np.argsort(-scores, kind="stable"):
            i, span = proposed[at]
            if scores[at] >= model.thresholds[span[0]] and _fits(span, added[i]):
                insort(added[i], span[1:])
                all_spans[i].append(span)
    order = {k: n for n, k in enumerate(KINDS)}
    return [(b, sorted(s, key=lambda x: (order[x[0]], x[1]))) for b, s in zip(base, all_spans, strict=True)]


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def personal_data(docs: DataFrame, model: PiiModel) -> DataFrame:
    """(doc_id, counts and digest of base spans, all spans) of every row; no shuffle."""
    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = found_spans(batch.column("text").to_pylist(), model)
        counts = [pa.array([sum(s[0] == k for s in b) for b, _ in found], pa.int64()) for k in KINDS]
        digest = pa.array([hashlib.sha256(written(b).encode()).hexdigest() for b, _ in found], pa.string())
        spans = pa.array([written(a) for _, a in found], pa.string())
        names = ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts, digest, spans], names)

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return by_batch(rows, lambda: step, schema)


def masked(text: str, spans: list[Span]) -> str:
    """The text with a mark in place of every span; of overlapping spans the first names it."""
    parts, done = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= done:
            parts += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*parts, text[done:]])


def cleared(texts: list[str], model: PiiModel) -> list[str]:
    """Texts masked until no rule finds more: a mask may part what had run together."""
    texts = list(texts)
    open_rows = list(range(len(texts)))
    while open_rows:
        found = found_spans([texts[i] for i in open_rows], model)
        open_rows = [i for i, (_, spans) in zip(open_rows, found, strict=True) if spans]
        for i, spans in zip(open_rows, [s for _, s in found if s], strict=True):
            texts[i] = masked(texts[i], spans)
    return texts


def redacted(docs: DataFrame, model: PiiModel) -> DataFrame:
    """``docs`` with all spans masked in ``text`` and ``n_chars``, if present, counted anew."""

    @F.pandas_udf("string")
    def mask(texts: pd.Series) -> pd.Series:
        clean = cleared(["" if t is None else t for t in texts], model)
        return pd.Series([None if t is None else c for t, c in zip(texts, clean, strict=True)], dtype=object)

    changed = docs.withColumn("text", mask("text"))
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        counted = F.coalesce(F.char_length("text").cast(kind), F.col("n_chars"))
        changed = changed.withColumn("n_chars", counted)
    return changed
