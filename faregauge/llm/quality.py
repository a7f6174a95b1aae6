"""Text quality by compression: sizes under a dictionary of good and one of bad text.

Two zstandard dictionaries are trained on windows of labelled texts, one per class. The
score starts from the normalised difference of a window's two compressed sizes, divided by
its size without a dictionary. Bad parts may be a few lines of a long text, so the mean,
the extremes and the quartiles of that difference over all windows count, next to how far
windows compress by themselves (repetition) and with each dictionary. A logistic
calibration on texts that the dictionaries haven't seen makes a probability of them.

Null and empty texts have no windows; they get the score that zeros get. Whole texts are
read, however long. Repeated rows get equal scores. Without labels of both classes every
score is 0.5. Labels, lang, source and doc_id are not read by the scoring; further columns
are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faregauge.llm.common import by_batch, in_class, prepare, text_or_empty
from faregauge.llm.compression import (
    Calibration,
    Sample,
    SampleBounds,
    calibrated,
    labelled_sample,
    sizer,
    trained_content,
)

HELD_OUT = (1, 3)
WINDOW = 256
DICTIONARY = 16 << 10
LEAST_MATCH = 3


def windows(text: str) -> list[bytes]:
    """The whole text in windows of ``WINDOW`` bytes; a short rest joins the last one."""
    content = text.encode()
    if not content:
        return []
    starts = list(range(0, max(len(content) - WINDOW // 2, 1), WINDOW))
    return [content[a:b] for a, b in zip(starts, [*starts[1:], len(content)], strict=True)]


class _Features:
    def __init__(self, good: bytes, bad: bytes):
        self._sizers = [sizer(c, LEAST_MATCH) for c in (good, bad, b"")]

    def __call__(self, text: str) -> np.ndarray:
        cut = windows(text)
        if not cut:
            return np.zeros(FEATURES)
        sizes = np.array([[size(w) for size in self._sizers] for w in cut], float)
        length = np.array([len(w) for w in cut], float)
        away = (sizes[:, 0] - sizes[:, 1]) / sizes[:, 2]
        own = sizes / length[:, None]
        spread = [np.quantile(away, q) for q in (0, 0.1, 0.25, 0.5, 0.75, 0.9, 1)]
        total = sizes.sum(0)
        made = [
            (total[0] - total[1]) / total[2],
            *spread,
            *(total / length.sum()),
            *own.min(0),
            *own.max(0),
            (away > 0).mean(),
            np.log1p(length.sum()),
        ]
        made = np.array(made)
        return np.concatenate([made, np.abs(made[:11] - _CENTRES)])


# The distance from typical values lets a linear score fall off on both sides.
_CENTRES = np.array([0.0] * 8 + [0.5] * 3)
FEATURES = 8 + 3 + 3 + 3 + 2 + 11


@dataclass(frozen=True)
class QualityModel:
    """Contents of the two dictionaries and the calibration; some tens of kilobytes."""

    good: bytes
    bad: bytes
    calibration: Calibration

    def features(self) -> _Features:
        return _Features(self.good, self.bad)


def fit(sample: Sample) -> QualityModel:
    """Dictionaries from two thirds of the sample, calibration from the other."""
    contents = [trained_content(sample.windows(label, windows), DICTIONARY) for label in (1, 0)]
    return QualityModel(*contents, calibrated(*sample.features(lambda: _Features(*contents), FEATURES)))


def trained(docs: DataFrame, labels: DataFrame, bounds: SampleBounds | None = None) -> QualityModel:
    """The model from a bounded sample of labelled rows outside the held-out remainder."""
    prepare(docs.sparkSession)
    return fit(labelled_sample(docs, labels, "quality", HELD_OUT, bounds or SampleBounds()))


def scores(texts: list[str], model: QualityModel, features: _Features | None = None) -> np.ndarray:
    features = features or model.features()
    return model.calibration.score(np.array([features(t) for t in texts]).reshape(len(texts), FEATURES))


def quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; no shuffle."""
    rows = docs.select(
        F.col("doc_id").cast("long"), in_class(*HELD_OUT).alias("held_out"), text_or_empty().alias("text")
    )

    def step(features: _Features, batch: pa.RecordBatch) -> pa.RecordBatch:
        found = scores(batch.column("text").to_pylist(), model, features)
        columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(found), pa.array((found >= 0.5).astype(np.int32))]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    schema = "doc_id long, held_out boolean, score double, predicted int"
    return by_batch(rows, lambda: partial(step, model.features()), schema)
