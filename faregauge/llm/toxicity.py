"""Toxicity by compression distance: windows under a toxic and an ordinary dictionary.

Two zstandard dictionaries are trained on windows of toxic and of ordinary labelled texts;
the differences of a window's compressed sizes find phrases of ordinary words and terms inside
scripts without spaces. Two more dictionaries are of words. The toxic one holds the word beginnings
that toxic texts use in many different contexts and ordinary texts don't; contexts are
counted, not texts, so copies of one toxic text don't vouch for its own vocabulary. The
ordinary one holds the ordinary words nearest to those, so a window that merely resembles a
toxic word is matched as well by either. The toxic dictionary has these too: what is left
of the size difference is what only toxic text explains.

A window of these is a run of words (one, by default: the sharpest contrast), written with two scattered bytes per character: a character that
no dictionary matches then costs two bytes and a match saves more than it costs. The
numbers of windows above several size differences, their shares and the largest difference
are calibrated on labelled texts that the dictionaries haven't seen.

Null and empty texts have no windows and get the score of a text without toxic windows.
Whole texts are read, however long. Repeated rows get equal scores. Without labels of both
classes every score is 0.5. Labels, lang, source and doc_id are not read by the scoring;
further columns are kept by ``without_toxic`` and ignored by ``toxicity``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faregauge.llm.common import by_batch, in_class, prepare, text_or_empty
from faregauge.llm.compression import Calibration, Sample, SampleBounds, calibrated, labelled_sample, packer, trained_content

HELD_OUT = (0, 5)
# Windows whose size difference a worker remembers.
REMEMBERED = 300_000
_WORD = re.compile(r"\w+")
_QUANTILES = (0.25, 0.5, 0.75, 0.9)


@dataclass(frozen=True)
class ToxicityRule:
    """Words per window, lengths of word beginnings, how telling these must be, ordinary words compared.

    ``text_*`` and ``dictionary`` are bytes per window of text and of each trained dictionary,
    least match, and the size differences from which windows are counted.
    """

    window: int = 1
    shortest: int = 4
    longest: int = 8
    least_contexts: int = 5
    context_share: float = 0.01
    ratio: float = 12.0
    steps: tuple[int, ...] = (2, 3, 4, 5, 6, 7, 8, 9)
    least_match: int = 6
    frequent: int = 20_000
    text_window: int = 48
    dictionary: int = 16 << 10
    text_match: int = 3
    text_steps: tuple[int, ...] = (2, 4, 6, 8, 12)

    @property
    def width(self) -> int:
        return 2 + 2 * len(self.steps) + 6 + len(self.text_steps)


class _Wide(dict):
    """Each character as a character whose two UTF-16 bytes are both scattered."""

    def __missing__(self, code: int) -> int:
        self[code] = made = 0x3400 + (code * 40503 + (code >> 3) * 9973) % 0xA000
        return made


_WIDE = _Wide()


def wide(text: str) -> bytes:
    return text.translate(_WIDE).encode("utf-16-le")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def windows(text: str, size: int) -> list[str]:
    """Runs of ``size`` words; a window ends between words, so no word is cut."""
    words = words_of(text)
    return words if size == 1 else [" ".join(words[i : i + size]) for i in range(0, len(words), size)]


def text_windows(text: str, size: int) -> list[bytes]:
    """The whole text in windows of ``size`` bytes; a short rest joins the last one."""
    content = text.lower().encode()
    starts = list(range(0, max(len(content) - size // 2, 1), size)) if content else []
    return [content[a:b] for a, b in zip(starts, [*starts[1:], len(content)], strict=True)] if starts else []


def _beginnings(word: str, rule: ToxicityRule) -> set[str]:
    lengths = {*range(rule.shortest, min(len(word), rule.longest) + 1), len(word)}
    return {word[:k] for k in lengths if k >= rule.shortest}


def _counted(texts: DataFrame, of_text: Callable[[str], Iterator[str]]) -> DataFrame:
    """(word, n) over all texts, summed per batch first."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        sums = Counter(w for t in batch.column("text").to_pylist() for w in of_text(t))
        return pa.RecordBatch.from_arrays([pa.array([*sums], pa.string()), pa.array([*sums.values()], pa.int64())], ["word", "n"])

    return by_batch(texts, lambda: step, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def telling_segments(toxic: DataFrame, ordinary: DataFrame, rule: ToxicityRule) -> list[str]:
    """Word beginnings with many different contexts in toxic texts and few in ordinary ones."""

    def contexts(batch: pa.RecordBatch) -> pa.RecordBatch:
        pairs = set()
        for text in batch.column("text").to_pylist():
            words = words_of(text)
            for before, word in zip(["", *words], words, strict=False):
                pairs |= {(g, before) for g in _beginnings(word, rule)}
        segments, before = zip(*pairs, strict=True) if pairs else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(segments, pa.string()), pa.array(before, pa.string())], ["word", "before"])

    n_toxic = toxic.count()
    least = max(rule.least_contexts, int(rule.context_share * n_toxic))
    pairs = by_batch(toxic, lambda: contexts, "word string, before string").distinct()
    often = pairs.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    seen = {r["word"]: r["n"] for r in often.collect()}
    found = _counted(ordinary, lambda t: (g for w in words_of(t) for g in _beginnings(w, rule) if g in seen))
    plain = Counter({r["word"]: r["n"] for r in found.collect()})
    share = ordinary.count() / max(1, n_toxic)
    good = {g for g, n in seen.items() if n * share > rule.ratio * (plain[g] + 0.5)}
    # The longest form that keeps half of the contexts, and none that extends a kept one.
    top = {g for g in good if not any(h != g and h.startswith(g) and seen[h] >= 0.5 * seen[g] for h in good)}
    kept = [g for g in top if not any(h != g and g.startswith(h) for h in top)]
    return sorted(kept, key=lambda g: (seen[g], g))


def nearest_ordinary(segments: list[str], ordinary: DataFrame, rule: ToxicityRule) -> list[str]:
    """Ordinary words that share the most with the segments: their start, then their inside."""
    counts = _counted(ordinary, words_of).orderBy(F.desc("n"), "word").limit(rule.frequent)
    common = {r["word"]: r["n"] for r in counts.collect()}
    starting = tuple(segments)
    frequent = [w for w in common if not w.startswith(starting)]
    near = []
    for segment in segments:
        starts: Counter[str] = Counter()
        for word in frequent:
            same = 0
            while same < min(len(word), len(segment)) and word[same] == segment[same]:
                same += 1
            if same >= 2:
                starts[word[: same + 1]] += common[word]
        near += sorted(starts, key=lambda s: (-len(s), -starts[s], s))[:6]
        for i in range(1, len(segment) - 2):
            for k in range(len(segment) - i, 2, -1):
                if found := next((w for w in frequent if segment[i : i + k] in w), None):
                    near.append(found)
                    break
    return near


@dataclass(frozen=True)
class ToxicityModel:
    """Contents of the dictionaries, the rule and the calibration; some tens of kilobytes."""

    ordinary: bytes
    toxic: bytes
    ordinary_text: bytes
    toxic_text: bytes
    rule: ToxicityRule
    calibration: Calibration

    def features(self) -> _Features:
        return _Features(self.ordinary, self.toxic, self.ordinary_text, self.toxic_text, self.rule)


class _Gains(dict):
    """Size difference of each window met; small windows come up again and again."""

    def __init__(self, ordinary: bytes, toxic: bytes, least_match: int):
        super().__init__()
        self._ordinary, self._toxic = (packer(c, least_match) for c in (ordinary, toxic))

    def __missing__(self, window: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        content = wide(f" {window} ")
        self[window] = gain = len(self._ordinary(content)) - len(self._toxic(content))
        return gain


class _Features:
    def __init__(self, ordinary: bytes, toxic: bytes, ordinary_text: bytes, toxic_text: bytes, rule: ToxicityRule):
        self._rule = rule
        self._gains = _Gains(ordinary, toxic, rule.least_match)
        self._packers = [packer(c, rule.text_match) for c in (ordinary_text, toxic_text)]
        self._steps, self._text_steps = np.array(rule.steps), np.array(rule.text_steps)

    def __call__(self, text: str) -> list[float]:
        rule = self._rule
        gains = np.array([*map(self._gains.__getitem__, windows(text, rule.window))] or [0])
        above = _at_least(gains, self._steps)
        shares = np.sqrt(above / len(gains))
        of_words = [min(gains.max(), 30), np.log1p(len(gains)), *np.log1p(above), *shares]
        cut = text_windows(text, rule.text_window)
        plain, toxic = (np.array([*map(len, map(pack, cut))] or [0]) for pack in self._packers)
        away = plain - toxic
        counts = np.log1p(_at_least(away, self._text_steps))
        return [*of_words, min(away.max(), 60), away.mean(), *np.quantile(away, _QUANTILES), *counts]


def _at_least(values: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """How many values reach each step."""
    return len(values) - np.searchsorted(np.sort(values), steps)


def fit(sample: Sample, rule: ToxicityRule | None = None) -> ToxicityModel:
    """Dictionaries from two thirds of the sample, calibration from the other."""
    rule = rule or ToxicityRule()
    segments = telling_segments(sample.learning(1), sample.learning(0), rule)
    near = nearest_ordinary(segments, sample.learning(0), rule)
    ordinary = wide(" " + " ".join(near) + " ")
    toxic = ordinary + wide(" " + " ".join(segments))
    cut = partial(text_windows, size=rule.text_window)
    texts = [trained_content(sample.windows(label, cut), rule.dictionary) for label in (0, 1)]
    found = sample.features(lambda: _Features(ordinary, toxic, *texts, rule), rule.width)
    return ToxicityModel(ordinary, toxic, *texts, rule, calibrated(*found))


def trained(docs: DataFrame, labels: DataFrame, bounds: SampleBounds | None = None) -> ToxicityModel:
    """The model from a bounded sample of labelled rows outside the held-out remainder."""
    prepare(docs.sparkSession)
    return fit(labelled_sample(docs, labels, "toxic", HELD_OUT, bounds or SampleBounds()))


def scores(texts: list[str], model: ToxicityModel, features: _Features | None = None) -> np.ndarray:
    features = features or model.features()
    width = len(model.calibration.mean)
    return model.calibration.score(np.array([features(t) for t in texts]).reshape(len(texts), width))


def toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; no shuffle."""
    rows = docs.select(
        F.col("doc_id").cast("long"), in_class(*HELD_OUT).alias("held_out"), text_or_empty().alias("text")
    )

    def step(features: _Features, batch: pa.RecordBatch) -> pa.RecordBatch:
        found = scores(batch.column("text").to_pylist(), model, features)
        columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(found), pa.array((found >= 0.5).astype(np.int32))]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    return by_batch(rows, lambda: partial(step, model.features()), "doc_id long, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, model: ToxicityModel, limit: float = 0.5) -> DataFrame:
    """The rows scored below ``limit``, all columns as they are."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features = model.features()
        for texts in batches:
            yield pd.Series(scores(texts.tolist(), model, features))

    return docs.where(score(text_or_empty()) < limit)
