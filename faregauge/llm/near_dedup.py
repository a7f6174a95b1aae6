"""Near duplicates by BagMinHash: weighted signatures, bands, exact check of multisets.

Signatures. A shingle with weight w (its count) owns the weight axis from 0 to w. The axis
is cut at the powers of two, and each interval has a Poisson process of its own whose rate
is the interval's length; every point has a time, a register and, by halving the interval
again and again, a level. A point counts if its level is at most w. A register keeps the
earliest time among the points of all shingles, so two texts agree in a register with a
probability that equals their weighted Jaccard similarity. Points are drawn in time order
and only up to the time by which all registers of a text are filled: a text with n
shingles costs some n + 8 m draws, however large the weights.

Bands. Equal runs of registers put texts into a common bucket. Bucket members are not
paired with each other: in each bucket one pivot, the text that shares most buckets with
others, is compared with all, and what is similar joins the pivot's class. Members outside
that class are then compared with all members of other classes, block against block inside
tasks of bounded size. Every pair of a bucket is then compared or lies within one class, so
no class is split, while a bucket of n copies costs n comparisons.

Sketches before texts. One byte of every register is the sketch of a text. A comparison
first counts equal bytes; only texts that agree as often as similar texts do, but for one
pair in a million at the limit itself, are read, moved to the comparison and cut into
shingles. What is returned as similar has always been verified on the texts.

Classes. Texts with the same words are one text from the start, whatever their number:
a task signs the first of them it meets, and a bucket counts what several tasks signed once.
Links are joined to classes by alternating large-star and
small-star steps on tables.

Null text counts as empty; all texts without words are one class. Rows may repeat, doc_ids
may repeat or be null: rows are told apart by their place in the stored input. An empty
table gives no rows. Columns other than doc_id and text are ignored by the search, and
``keep_one`` returns them unchanged.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faregauge.llm.common import anchored, by_batch, prepare, stored, text_or_empty
from faregauge.llm.shingles import WORDS, mixed, runs, shingle_bags

ROW = "_near_row"
EMPTY = xxhash.xxh3_128_digest(b"")
# Digests of signed texts that a task remembers.
REMEMBERED = 100_000


@dataclass(frozen=True)
class NearRule:
    """Words per shingle, least similarity, bands, registers per band, texts per block, miss of a sketch.

    With 25 bands of 5 registers a pair at 0.8 shares no bucket once in 20,000 pairs, and
    ``sketch_miss`` bounds how often its sketches disagree too much.
    """

    words: int = WORDS
    similar: tuple[int, int] = (4, 5)
    bands: int = 25
    registers: int = 5
    block: int = 256
    sketch_miss: float = 1e-6

    @property
    def size(self) -> int:
        return self.bands * self.registers

    @cached_property
    def agreeing(self) -> int:
        """Equal sketch bytes that a pair needs: fewer are rarer than ``sketch_miss`` at the limit.

        Registers agree independently of each other, with the similarity as probability.
        """
        more, parts = self.similar
        below, least = 0.0, 0
        while least < self.size:
            below += math.comb(self.size, least) * (more / parts) ** least * (1 - more / parts) ** (self.size - least)
            if below > self.sketch_miss:
                break
            least += 1
        return least


def _draw(seed: np.ndarray, salt: int) -> np.ndarray:
    return mixed(seed ^ np.uint64(salt * 0x9E3779B97F4A7C15 % (1 << 64)))


def _unit(bits: np.ndarray) -> np.ndarray:
    """Uniform in (0, 1)."""
    return ((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _points(text, shingle, weight, until, registers, out) -> None:
    """Draw all points up to each text's time and keep the earliest per register."""
    kinds = np.ceil(np.log2(weight)).astype(np.int64) + 1
    each = np.repeat(np.arange(len(weight)), kinds)
    kind = np.arange(len(each)) - np.repeat(np.cumsum(kinds) - kinds, kinds)
    length = np.where(kind > 0, 2.0 ** (kind - 1), 1.0)
    low = np.where(kind > 0, length, 0.0)
    seed = mixed(shingle[each] + (kind + 1).astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
    owner, top = text[each], weight[each]
    time = np.zeros(len(each))
    number = 0
    while len(time):
        number += 1
        time = time - np.log(_unit(_draw(seed, 3 * number))) / length
        going = time <= until[owner]
        time, seed, owner, length, low, top = (x[going] for x in (time, seed, owner, length, low, top))
        level = low + 1 + np.floor(_unit(_draw(seed, 3 * number + 1)) * length)
        register = (_draw(seed, 3 * number + 2) % np.uint64(registers)).astype(np.int64)
        counts = level <= top
        np.minimum.at(out, owner[counts] * registers + register[counts], time[counts])


def signatures(text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, texts: int, registers: int) -> np.ndarray:
    """Earliest times, one row per text; texts without shingles get infinities."""
    out = np.full(texts * registers, np.inf)
    total = np.bincount(text, weight, texts)
    filled = np.zeros(texts, bool)
    filled[total == 0] = True
    # By this time a register is empty in one text of twenty, and twice as late in none.
    until = registers * np.log(registers * 20) / np.maximum(total, 1)
    while not filled.all():
        open_rows = ~filled[text]
        _points(text[open_rows], shingle[open_rows], weight[open_rows], until, registers, out)
        filled |= np.isfinite(out.reshape(texts, registers)).all(1)
        until *= 2
    return out.reshape(texts, registers)


def band_keys(times: np.ndarray, rule: NearRule) -> np.ndarray:
    bits = times.view(np.uint64).reshape(len(times), rule.bands, rule.registers)
    key = np.broadcast_to(np.arange(1, rule.bands + 1, dtype=np.uint64), bits.shape[:2]).copy()
    for i in range(rule.registers):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + bits[:, :, i])
    return key.view(np.int64)


def sketches(times: np.ndarray) -> np.ndarray:
    """One byte per register."""
    return (mixed(times.view(np.uint64)) >> np.uint64(56)).astype(np.uint8)


def _sign_batch(rule: NearRule):
    seen: set[bytes] = {EMPTY}

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text")
        copies = [xxhash.xxh3_128_digest(b" ".join(t.encode().split())) for t in texts.to_pylist()]
        if len(seen) > REMEMBERED:
            seen.clear()
            seen.add(EMPTY)
        new = np.zeros(len(copies), bool)
        for i, copy in enumerate(copies):
            new[i] = copy not in seen
            seen.add(copy)
        texts = texts.filter(pa.array(new))
        sizes = np.zeros(len(copies), np.int64)
        found, keys, bytes_ = [], [], []
        for start, stop in runs(texts):
            text, shingle, weight = shingle_bags(texts.slice(start, stop - start), rule.words)
            times = signatures(text, shingle, weight, stop - start, rule.size)
            found.append(np.bincount(text, weight, stop - start).astype(np.int64))
            keys.append(band_keys(times, rule))
            bytes_ += [row.tobytes() for row in sketches(times)]
        sizes[new] = np.concatenate(found) if found else 0
        flat = pa.array(np.concatenate(keys).reshape(-1) if keys else np.zeros(0, np.int64))
        bounds = pa.array(np.concatenate([[0], np.cumsum(new)]).astype(np.int32) * rule.bands)
        sketch = iter(bytes_)
        return pa.RecordBatch.from_arrays(
            [
                batch.column(ROW),
                batch.column("doc_id"),
                pa.array(copies, pa.binary()),
                pa.array(sizes),
                pa.ListArray.from_arrays(bounds, flat),
                pa.array([next(sketch) if own else None for own in new], pa.binary()),
            ],
            [ROW, "doc_id", "copy", "size", "bands", "sketch"],
        )

    return step


def numbered(docs: DataFrame) -> DataFrame:
    """Rows with their place in stored files, which a second reading repeats."""
    return anchored(docs).withColumn(ROW, F.monotonically_increasing_id())


def signed(docs: DataFrame, rule: NearRule) -> DataFrame:
    """(row, doc_id, copy, size, bands, sketch): digest of the words, shingles, band keys.

    Texts without words, and those whose words the task has signed before, have no bands.
    """
    rows = docs.select(F.col(ROW), F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    schema = f"{ROW} long, doc_id long, copy binary, size long, bands array<long>, sketch binary"
    return by_batch(rows, lambda: _sign_batch(rule), schema)


def shared_buckets(signed_rows: DataFrame) -> DataFrame:
    """(bucket, row, n) of the n > 1 different texts of a bucket, each by the first of its rows.

    Keys move once: copies (64 bits agree) are found, counted and dropped where the bucket is. A
    bucket is read by one task, which gets a row of three numbers per text of it and task that
    signed one; it holds one of a text's band keys, so even a corpus of near copies alone is
    dealt to as many tasks as there are bands.
    """
    spread = signed_rows.select(F.explode("bands").alias("bucket"), F.xxhash64("copy").alias("same"), ROW)
    texts = spread.repartition("bucket").groupBy("bucket", "same").agg(F.min(ROW).alias(ROW))
    counted = texts.withColumn("n", F.count("*").over(Window.partitionBy("bucket")))
    return counted.where("n > 1").select("bucket", ROW, "n")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b), the root being the least node.

    Large-star and small-star steps in turn; a node with many neighbours is one row per
    task after partial aggregation, and the joins on it can be split.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges = stored(edges, "edges")
    mark = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # Small star: every node takes itself and its smaller neighbours to the least of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        edges = stored(
            small.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b")))
            .where("a <> b")
            .distinct(),
            "edges",
        )
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 40))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _packed_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    pack = zstandard.ZstdCompressor(level=3).compress
    packed = pa.array([pack(t.encode()) for t in batch.column("text").to_pylist()], pa.binary())
    return pa.RecordBatch.from_arrays([batch.column(ROW), packed], [ROW, "text"])


def _unpacked(texts: pa.Array) -> pa.Array:
    unpack = zstandard.ZstdDecompressor().decompress
    return pa.array([unpack(t).decode() for t in texts.to_pylist()], pa.string())


def texts_of(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(row, text) of the rows in ``chosen``, compressed one by one.

    ``chosen`` is stored, so its size is known: while it is small it goes to the texts and
    these are not shuffled; beyond that they are, compressed to about half.
    """
    rows = docs.select(F.col(ROW), text_or_empty().alias("text"))
    packed = by_batch(rows, lambda: _packed_batch, f"{ROW} long, text binary")
    return packed.join(chosen, ROW, "left_semi")


def _agreement(a: pa.Array, b: pa.Array, rule: NearRule) -> np.ndarray:
    left, right = _sketch_rows(a, rule), _sketch_rows(b, rule)
    return np.count_nonzero(left == right, axis=1)


def _sketch_rows(sketch: pa.Array, rule: NearRule) -> np.ndarray:
    return np.frombuffer(b"".join(sketch.to_pylist()), np.uint8).reshape(len(sketch), rule.size)


def _agreeing_batch(rule: NearRule):
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        near = _agreement(batch.column("a_sketch"), batch.column("b_sketch"), rule) >= rule.agreeing
        return batch.select([ROW, "pivot"]).filter(pa.array(near))

    return step


def with_pivots(members: DataFrame, sketch: DataFrame, rule: NearRule) -> DataFrame:
    """(row, pivot), once per pair, where sizes and sketches allow a link."""
    more, parts = rule.similar
    pairs = members.where(f"{ROW} <> pivot")
    fits = F.least("size", "pivot_size") * parts >= F.greatest("size", "pivot_size") * more
    a, b = F.least(ROW, "pivot").alias("a"), F.greatest(ROW, "pivot").alias("b")
    pairs = pairs.where(fits).groupBy(a, b).agg(F.min("pivot").alias("pivot"))
    pairs = pairs.select((F.col("a") + F.col("b") - F.col("pivot")).alias(ROW), "pivot")
    one = sketch.withColumnRenamed("sketch", "a_sketch")
    other = sketch.select(F.col(ROW).alias("pivot"), F.col("sketch").alias("b_sketch"))
    both = pairs.join(one, ROW).join(other, "pivot").select(ROW, "pivot", "a_sketch", "b_sketch")
    return by_batch(both, lambda: _agreeing_batch(rule), f"{ROW} long, pivot long")


def pivot_cells(pairs: DataFrame, rule: NearRule) -> DataFrame:
    """Cells of a pivot and at most about ``block`` of its partners, in the form of ``cells_of``."""
    many = pairs.groupBy("pivot").agg(F.ceil(F.count("*") / rule.block).cast("int").alias("parts"))
    dealt = pairs.join(many, "pivot").withColumn("x", F.pmod(F.xxhash64(ROW, F.lit(5)), "parts").cast("int"))
    bucket, y = F.col("pivot").alias("bucket"), F.lit(0).alias("y")
    asking = dealt.select(bucket, "x", y, F.lit(True).alias("asks"), ROW, F.col(ROW).alias("label"))
    heads = dealt.select("pivot", "x").distinct()
    asked = heads.select(
        bucket, "x", y, F.lit(False).alias("asks"), F.col("pivot").alias(ROW), F.col("pivot").alias("label")
    )
    return asking.unionByName(asked)


def _cell_links(rule: NearRule):
    more, parts = rule.similar

    def bags(rows: pa.Table) -> tuple[np.ndarray, ...]:
        texts = _unpacked(rows.column("text"))
        found = []
        for start, stop in runs(texts):
            text, shingle, weight = shingle_bags(texts.slice(start, stop - start), rule.words)
            found.append((text + start, shingle, weight))
        text, shingle, weight = (np.concatenate(x) for x in zip(*found, strict=True))
        return text, shingle, weight, np.bincount(text, weight, len(texts))

    def step(cell: pa.Table) -> pa.Table:
        side = cell.column("asks").to_numpy()
        asking, asked = cell.filter(pa.array(side)), cell.filter(pa.array(~side))
        links: list[tuple[int, int]] = []
        if asking.num_rows and asked.num_rows:
            x_text, x_shingle, x_weight, x_size = bags(asking)
            y_text, y_shingle, y_weight, y_size = bags(asked)
            order = np.argsort(y_shingle, kind="stable")
            y_text, y_shingle, y_weight = y_text[order], y_shingle[order], y_weight[order]
            x_label, y_label = asking.column("label").to_numpy(), asked.column("label").to_numpy()
            x_row, y_row = asking.column(ROW).to_numpy(), asked.column(ROW).to_numpy()
            ends = np.searchsorted(x_text, np.arange(len(x_row) + 1))
            for i in range(len(x_row)):
                own, weight = x_shingle[ends[i] : ends[i + 1]], x_weight[ends[i] : ends[i + 1]]
                low, high = np.searchsorted(y_shingle, own, "left"), np.searchsorted(y_shingle, own, "right")
                times = high - low
                at = np.repeat(low - (np.cumsum(times) - times), times) + np.arange(times.sum())
                shared = np.bincount(y_text[at], np.minimum(np.repeat(weight, times), y_weight[at]), len(y_row))
                alike = (parts * shared >= more * (x_size[i] + y_size - shared)) & (y_label != x_label[i])
                links += [(int(x_row[i]), int(r)) for r in y_row[alike]]
        a, b = zip(*links, strict=True) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return step


def _bucket_rows(buckets: pa.ChunkedArray, own: int) -> np.ndarray:
    """A row of bucket keys per text, filled up with the key they have in common."""
    lists = buckets.combine_chunks()
    bounds = lists.offsets.to_numpy()
    times = np.diff(bounds)
    out = np.full((len(times), times.max(initial=1)), own, np.int64)
    out[np.arange(out.shape[1]) < times[:, None]] = lists.values.to_numpy()[bounds[0] : bounds[-1]]
    return out


def _cell_partners(rule: NearRule):
    def step(cell: pa.Table) -> pa.Table:
        side = cell.column("asks").to_numpy()
        asking, asked = cell.filter(pa.array(side)), cell.filter(pa.array(~side))
        x, y = (_sketch_rows(t.column("sketch"), rule) for t in (asking, asked))
        x_label, y_label = asking.column("label").to_numpy(), asked.column("label").to_numpy()
        x_row, y_row = asking.column(ROW).to_numpy(), asked.column(ROW).to_numpy()
        x_near, y_near = np.zeros(len(x), bool), np.zeros(len(y), bool)
        own = cell.column("bucket")[0].as_py()
        x_in, y_in = _bucket_rows(asking.column("buckets"), own), _bucket_rows(asked.column("buckets"), own)
        # Of two texts that both ask, the first one does.
        y_asks = asked.column("outside").to_numpy()
        for i in range(len(x)):
            near = (np.count_nonzero(y == x[i], axis=1) >= rule.agreeing) & (y_label != x_label[i])
            near = np.flatnonzero(near & ~(y_asks & (y_row < x_row[i])))
            # Of the buckets that two texts share, the one with the least key compares them.
            shared = np.where(np.isin(y_in[near], x_in[i]), y_in[near], own).min(axis=1)
            near = near[shared == own]
            x_near[i] = len(near)
            y_near[near] = True
        kept = pa.concat_tables([asking.filter(pa.array(x_near)), asked.filter(pa.array(y_near))])
        return kept.select(["bucket", "x", "y", "asks", ROW, "label"])

    return step


def cells_of(members: DataFrame, labels: DataFrame, sketch: DataFrame, rule: NearRule) -> DataFrame:
    """(bucket, x, y, asks, row, label): what the pivots' comparisons leave open.

    In each bucket, members outside the pivot's class are compared with all members of other
    classes but the pivot itself. Both sides are dealt into blocks, and a cell of two blocks is
    one group of bounded size. Sketches move to all cells, and what has a partner there stays in
    the cell, for the comparison of texts; no pair is a row. Two texts that meet in several
    buckets are compared in one of these alone. A bucket whose members are all alike has no such
    members and costs nothing.
    """
    known = labels.withColumnsRenamed({"node": ROW, "root": "label"})
    # A bucket of two is done with its one pair.
    now = members.where("n > 2").join(known, ROW, "left").withColumn("label", F.coalesce("label", ROW))
    heads = now.where(f"{ROW} = pivot").select("bucket", F.col("label").alias("head"))
    asks = (F.col("label") != F.col("head")).alias("asks")
    now = stored(now.join(heads, "bucket").select("bucket", ROW, "pivot", "n", "label", asks), "open")
    active = stored(now.where("asks").groupBy("bucket").agg(F.count("*").alias("asking")), "active")
    now = stored(now.join(active, "bucket").withColumn("outside", F.col("asks")), "open")
    # At most one key per band.
    keys = now.groupBy(ROW).agg(F.collect_list("bucket").alias("buckets"))

    def dealt(total: str) -> Column:
        return F.ceil(F.col(total) / rule.block).cast("int")

    def place(total: str) -> Column:
        return F.pmod(F.xxhash64(ROW, F.lit(5)), dealt(total)).cast("int")

    def every(total: str) -> Column:
        return F.explode(F.sequence(F.lit(0), dealt(total) - 1))

    asking = now.where("asks").withColumn("x", place("asking")).withColumn("y", every("n"))
    # Pivots have been compared with all.
    asked = now.where(f"{ROW} <> pivot").withColumn("asks", F.lit(False))
    asked = asked.withColumn("y", place("n")).withColumn("x", every("asking"))
    cells = asking.unionByName(asked).select("bucket", "x", "y", "asks", "outside", ROW, "label")
    schema = f"bucket long, x int, y int, asks boolean, {ROW} long, label long"
    marks = stored(sketch.join(keys, ROW), "marks")
    return cells.join(marks, ROW).groupBy("bucket", "x", "y").applyInArrow(_cell_partners(rule), schema)


def linked(cells: DataFrame, docs: DataFrame, rule: NearRule) -> DataFrame:
    """(a, b) of the texts in stored ``cells`` that are similar and have different labels."""
    chosen = stored(cells.select(ROW).distinct(), "chosen")
    texts = stored(texts_of(docs, chosen), "texts")
    return cells.join(texts, ROW).groupBy("bucket", "x", "y").applyInArrow(_cell_links(rule), "a long, b long")


def _relabelled(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, root) after further links; nodes without a row are their own root."""
    if labels is None:
        return stored(components(links), "labels")
    a, b = (labels.select(F.col("node").alias(x), F.col("root").alias(f"{x}_root")) for x in "ab")
    joined = links.join(a, "a", "left").join(b, "b", "left")
    lifted = joined.select(F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b"))
    merged = components(lifted).withColumnsRenamed({"node": "old", "root": "new"})
    kept = labels.join(merged, labels.root == merged.old, "left").select("node", F.coalesce("new", "root").alias("root"))
    added = merged.select(F.col("old").alias("node"), F.col("new").alias("root"))
    return stored(kept.unionByName(added.join(labels.select("node"), "node", "left_anti")), "labels")


def classes(docs: DataFrame, rule: NearRule | None = None) -> DataFrame:
    """(row, doc_id, root) of every row of numbered ``docs``; root is a row of its class."""
    rule = rule or NearRule()
    prepare(docs.sparkSession)
    all_rows = stored(signed(docs, rule), "signed")
    members = stored(shared_buckets(all_rows), "members")
    # The text that shares most buckets with others is the likeliest to be like all of them.
    weights = stored(members.groupBy(ROW).agg(F.sum("n").alias("weight")), "weights")
    # Tables of known size: while small they go to the other side, which then isn't shuffled.
    sketch = stored(all_rows.select(ROW, "size", "sketch").join(weights, ROW), "sketches")
    members = stored(members.join(sketch.select(ROW, "weight", "size"), ROW), "members")
    order = F.struct("weight", (-F.col(ROW)).alias("before"), "size")
    pivots = members.groupBy("bucket").agg(F.max(order).alias("top"))
    pivots = pivots.select("bucket", (-F.col("top.before")).alias("pivot"), F.col("top.size").alias("pivot_size"))
    members = stored(members.join(pivots, "bucket"), "members")

    sketch = sketch.select(ROW, "sketch")
    pairs = stored(with_pivots(members, sketch, rule), "pairs")
    labels = _relabelled(None, linked(stored(pivot_cells(pairs, rule), "cells"), docs, rule))
    left_over = stored(cells_of(members, labels, sketch, rule), "cells")
    if not left_over.isEmpty():
        labels = _relabelled(labels, linked(left_over, docs, rule))
    first = F.min(F.when(F.size("bands") > 0, F.col(ROW)))
    copies = all_rows.groupBy("copy").agg(F.coalesce(first, F.min(ROW)).alias("rep"))
    roots = copies.join(labels.withColumnsRenamed({"node": "rep"}), "rep", "left")
    roots = roots.select("copy", F.coalesce("root", "rep").alias("root"))
    return all_rows.select(ROW, "doc_id", "copy").join(roots, "copy").select(ROW, "doc_id", "root")


def with_classes(docs: DataFrame, rule: NearRule | None = None) -> DataFrame:
    """(row, doc_id, class_id, class_size, kept) of every row of numbered ``docs``.

    ``class_id`` is the least doc_id of the class, and the row that has it stays; of several
    such rows the first. Null doc_ids come last.
    """
    found = stored(classes(docs, rule), "classes")
    order = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", ROW)
    best = found.groupBy("root").agg(F.min(order).alias("best"), F.count("*").alias("class_size"))
    return found.join(best, "root").select(
        ROW,
        "doc_id",
        F.col("best.doc_id").alias("class_id"),
        "class_size",
        (F.col(ROW) == F.col(f"best.{ROW}")).alias("kept"),
    )


def near_duplicates(docs: DataFrame, rule: NearRule | None = None) -> DataFrame:
    """(doc_id, class_id, class_size, kept) for every row."""
    return with_classes(numbered(docs.select("doc_id", "text")), rule).drop(ROW)


def keep_one(docs: DataFrame, rule: NearRule | None = None) -> DataFrame:
    """The rows of ``docs``, all columns as they are, with one of each class."""
    rows = numbered(docs)
    kept = with_classes(rows.select(ROW, "doc_id", "text"), rule).where("kept").select(ROW)
    return rows.join(kept, ROW, "left_semi").drop(ROW)
