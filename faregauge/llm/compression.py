"""Scoring texts by compressed sizes: samples of labels, dictionaries, calibration."""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faregauge.llm.common import by_batch, in_class, stored


@dataclass(frozen=True)
class SampleBounds:
    """How many labelled documents per class a fit takes, and windows per dictionary.

    Texts are taken whole, and only windows, counts and feature vectors reach the driver.
    Documents are drawn by a hash of their id, so the sample is the same on every cluster.
    """

    per_class: int = 2500
    dictionary_windows: int = 40_000
    seed: int = 17


@dataclass(frozen=True)
class Sample:
    """Stored rows of (doc_id, text, label, calibrates, weight), with whole texts.

    Two thirds are for dictionaries, the third that these don't see for calibration.
    """

    rows: DataFrame
    bounds: SampleBounds

    def learning(self, label: int) -> DataFrame:
        return self.rows.where(~F.col("calibrates") & (F.col("label") == label)).select("doc_id", "text")

    def windows(self, label: int, cut: Callable[[str], list[bytes]]) -> list[bytes]:
        """Windows from all over the texts of a class, drawn by a hash if they are too many."""

        def counted(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"n": [sum(len(cut(t)) for t in batch.column("text").to_pylist())]})

        rows = self.learning(label)
        total = by_batch(rows, lambda: counted, "n long").agg(F.sum("n")).first()[0] or 0
        every = 1 + total // self.bounds.dictionary_windows

        def drawn(batch: pa.RecordBatch) -> pa.RecordBatch:
            made = [
                (number, i, window)
                for number, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True)
                for i, window in enumerate(cut(text))
                if zlib.crc32(f"{number}|{i}".encode()) % every == 0
            ]
            numbers, places, found = zip(*made, strict=True) if made else ((), (), ())
            columns = [pa.array(numbers, pa.int64()), pa.array(places, pa.int64()), pa.array(found, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "i", "window"])

        found = by_batch(rows, lambda: drawn, "doc_id long, i long, window binary").collect()
        return [bytes(r["window"]) for r in sorted(found, key=lambda r: (r["doc_id"], r["i"], bytes(r["window"])))]

    def features(
        self, make: Callable[[], Callable[[str], np.ndarray]], width: int
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Features, labels and weights of the calibrating texts, computed in tasks."""

        def step(of_text: Callable[[str], np.ndarray], batch: pa.RecordBatch) -> pa.RecordBatch:
            made = [[float(v) for v in of_text(t)] for t in batch.column("text").to_pylist()]
            columns = [batch.column(c) for c in ("doc_id", "label", "weight")]
            return pa.RecordBatch.from_arrays([*columns, pa.array(made, pa.list_(pa.float64()))], ["doc_id", "label", "weight", "x"])

        rows = self.rows.where("calibrates").select("doc_id", "text", "label", "weight")
        schema = "doc_id long, label int, weight double, x array<double>"
        found = by_batch(rows, lambda: partial(step, make()), schema).collect()
        found.sort(key=lambda r: (r["doc_id"], r["label"], r["x"]))
        x = np.array([r["x"] for r in found], float).reshape(len(found), width)
        return x, np.array([r["label"] for r in found], int), np.array([r["weight"] for r in found], float)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, held_out: tuple[int, int], bounds: SampleBounds
) -> Sample:
    """A bounded sample of each class, without the held-out remainder of crc32(doc_id).

    Rows with a null id, text or label teach nothing. A document with several labels
    counts once for each. ``weight`` makes the classes as frequent as among all labels.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(~in_class(*held_out) & F.col("label").isin(0, 1))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    drawn = None
    for value in (0, 1):
        order = F.xxhash64("doc_id", F.lit(bounds.seed))
        part = known.where(F.col("label") == value).orderBy(order, "doc_id").limit(bounds.per_class)
        drawn = part if drawn is None else drawn.unionByName(part)
    # At most two classes of a bounded number of rows: a broadcast of proven size.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text IS NOT NULL")
    calibrates = F.pmod(F.xxhash64("doc_id", F.lit(bounds.seed + 1)), F.lit(3)) == 2
    rows = stored(texts.join(F.broadcast(drawn), "doc_id").withColumn("calibrates", calibrates), "labelled")
    taken = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = {v: counts.get(v, 0) / max(1, taken.get(v, 0)) for v in (0, 1)}
    return Sample(rows.withColumn("weight", F.when(F.col("label") == 1, share[1]).otherwise(F.lit(share[0]))), bounds)


def trained_content(samples: list[bytes], size: int) -> bytes:
    """Dictionary content that the trainer picks from samples; their end if they are few."""
    try:
        return zstandard.train_dictionary(size, samples, level=3).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def packer(content: bytes, least_match: int, level: int = 3) -> Callable[[bytes], bytes]:
    """Compression of a window with a raw-content dictionary."""
    parameters = zstandard.ZstdCompressionParameters.from_level(
        level,
        strategy=zstandard.STRATEGY_BTLAZY2,
        min_match=least_match,
        write_content_size=0,
        write_checksum=0,
        write_dict_id=0,
    )
    if len(content) >= 8:
        raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        raw.precompute_compress(compression_params=parameters)
        return zstandard.ZstdCompressor(dict_data=raw, compression_params=parameters).compress
    return zstandard.ZstdCompressor(compression_params=parameters).compress


def sizer(content: bytes, least_match: int, level: int = 3) -> Callable[[bytes], int]:
    """Compressed size of a window with a raw-content dictionary."""
    run = packer(content, least_match, level)
    return lambda window: len(run(window))


@dataclass(frozen=True)
class Calibration:
    """Logistic weights over standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def score(self, features: np.ndarray) -> np.ndarray:
        x = np.clip((features - self.mean) / self.scale, -8, 8)
        z = x @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def calibrated(features: np.ndarray, labels: np.ndarray, row_weights: np.ndarray, ridge: float = 1.0) -> Calibration:
    """Newton steps on the penalised log likelihood; without both classes the score is even."""
    width = features.shape[1]
    if len(set(labels.tolist())) < 2:
        constant = np.zeros(width + 1)
        return Calibration(np.zeros(width), np.ones(width), constant)
    mean, scale = features.mean(0), features.std(0) + 1e-6
    x = np.hstack([np.clip((features - mean) / scale, -8, 8), np.ones((len(features), 1))])
    row_weights = row_weights / row_weights.mean()
    w = np.zeros(width + 1)
    penalty = np.full(width + 1, ridge)
    penalty[-1] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        gradient = x.T @ (row_weights * (p - labels)) + penalty * w
        curve = (x * (row_weights * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, gradient)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return Calibration(mean, scale, w)
