"""Conversations that share beginnings as a prefix trie with subtree totals.

A turn is a digest of role and text; a prefix is the xor of 128-bit mixes of (depth, turn)
of its turns, which adds up along a conversation in segments, so no task needs a whole
conversation. Equal prefixes are a node; different ones are taken for equal only if 128 bits
collide.

Totals over subtrees go by bands of ``BAND`` depths. Every node first gives its value to the
gate of its band, the node right above the band. The gates are a trie of their own, a
``BAND``-th as deep, whose totals are found in the same way. With these, a node gives
its value, and a gate what lies below it too, to its ancestors within its band only. So a
node makes at most ``BAND`` rows, and depth D takes log(D) / log(``BAND``) rounds.

A null turn comes first; turns with equal number follow each other by role and text digests. Null
role or text are empty. Rows without a conv_id belong to no conversation and are left out.
Repeated rows are repeated turns. Long texts are hashed whole where they are read. An empty
table gives no rows, not even a root; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faregauge.llm.common import prepare, stored
from faregauge.llm.placing import places

BAND = 16
# Turns whose marks are added up in one window; conversations may have any number of these.
SEGMENT = 4096
FAMILY = 20
HEADS = 4
WORD = r"[^\x20\x09-\x0D]+"
KEY = ["depth", "k1", "k2"]


def head_turns(conv_id: Column) -> Column:
    """How many first turns come from the family's first conversation."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % HEADS).cast("int")


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, words) of every row; texts are read here and nowhere else."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.sha2(named, 256)).alias("digest"),
        F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).cast("long").alias("words"),
    )


def conversations_of(placed: DataFrame) -> DataFrame:
    """(conv_id, own, h, length, head): own turns, turns wanted and taken from the family's first."""
    heads = (
        placed.where(F.col("pos") < HEADS - 1)
        .groupBy("conv_id", F.col("size").alias("own"))
        .agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "words"))).alias("first"))
    )
    heads = stored(heads, "heads")
    rows = heads.select("conv_id", "own", head_turns(F.col("conv_id")).alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"))
    base = heads.select(F.col("conv_id").alias("base"), "first")
    taken = F.coalesce(F.slice("first", F.lit(1), F.col("h")), F.array().cast("array<struct<pos:bigint,digest:binary,words:bigint>>"))
    joined = rows.join(base, "base", "left").withColumn("head", taken)
    return joined.select("conv_id", "h", "head", (F.size("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).cast("long").alias("length"))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (conv_id, depth, digest, words, length) of rebuilt conversations, and these with their length."""
    placed = stored(places(stored(turns(conversations), "turns"), "conv_id", ["turn", "digest"]), "placed")
    convs = stored(conversations_of(placed), "conversations")
    shift = convs.select("conv_id", "length", F.size("head").alias("taken"))
    own = placed.where(F.col("pos") >= head_turns(F.col("conv_id"))).join(shift, "conv_id")
    depth = F.col("taken") + F.col("pos") - head_turns(F.col("conv_id")) + 1
    own = own.select("conv_id", depth.alias("depth"), "digest", "words", "length")
    opened = convs.select("conv_id", "length", F.posexplode("head").alias("place", "turn"))
    first = opened.select("conv_id", (F.col("place") + 1).cast("long").alias("depth"), "turn.digest", "turn.words", "length")
    return own.unionByName(first), convs.select("conv_id", "length")


def prefixes(rows: DataFrame) -> DataFrame:
    """Rows with the key (k1, k2) of the prefix that ends in them and of the one before (p1, p2)."""
    mark = [F.xxhash64(F.lit(salt), "depth", "digest").alias(f"m{salt}") for salt in (1, 2)]
    marked = rows.select("conv_id", "depth", "words", "length", *mark, F.floor((F.col("depth") - 1) / SEGMENT).alias("segment"))
    marked = stored(marked, "marks")
    sums = marked.groupBy("conv_id", "segment").agg(*[F.bit_xor(f"m{i}").alias(f"s{i}") for i in (1, 2)])
    past = Window.partitionBy("conv_id").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("conv_id", "segment", *[F.coalesce(F.bit_xor(f"s{i}").over(past), F.lit(0)).alias(f"s{i}") for i in (1, 2)])
    inside = Window.partitionBy("conv_id", "segment").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    run = marked.withColumns({f"r{i}": F.bit_xor(f"m{i}").over(inside) for i in (1, 2)})
    keys = {f"k{i}": F.col(f"r{i}").bitwiseXOR(F.col(f"s{i}")) for i in (1, 2)}
    joined = run.join(starts, ["conv_id", "segment"]).withColumns(keys)
    before = {f"p{i}": F.col(f"k{i}").bitwiseXOR(F.col(f"m{i}")) for i in (1, 2)}
    return joined.withColumns(before).select("conv_id", *KEY, "p1", "p2", "words", "length")


def nodes_of(rows: DataFrame) -> DataFrame:
    """One row per node below the root: members, the smallest one, ends, words, key of the parent."""
    return rows.groupBy(*KEY).agg(
        F.count("*").alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.max("words").alias("words"),
        F.max("p1").alias("p1"),
        F.max("p2").alias("p2"),
    )


def paths(nodes: DataFrame, rows: DataFrame, step: int) -> DataFrame:
    """(key, up, gate) of the nodes whose depth ``step`` divides.

    ``up`` are the keys from the band's first depth down to the node, ``gate`` is the key above
    them. Both are read off the node's smallest conversation, a band of it at a time.
    """
    level = F.col("depth") / step
    band = F.floor((level - 1) / BAND).cast("long")
    here = F.struct(*KEY)
    along = Window.partitionBy("conv_id", "band").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    some = rows.where(F.col("depth") % step == 0).select("conv_id", *KEY, band.alias("band"))
    climbed = some.select("conv_id", "band", "depth", F.collect_list(here).over(along).alias("up"))
    top = F.col("band") * (BAND * step)
    ends = rows.select("conv_id", *KEY).where(F.col("depth") % (BAND * step) == 0)
    gate = ends.select("conv_id", (F.col("depth") / (BAND * step)).cast("long").alias("band"), here.alias("gate"))
    zero = F.struct(F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"))
    climbed = climbed.join(gate, ["conv_id", "band"], "left").withColumn("gate", F.when(top == 0, zero).otherwise(F.col("gate")))
    return nodes.where(F.col("depth") % step == 0).select("conv_id", *KEY).join(climbed, ["conv_id", "depth"]).select(*KEY, "up", "gate")


def below(values: DataFrame, nodes: DataFrame, rows: DataFrame, step: int, deepest: int) -> DataFrame:
    """(key, n_leaves, saved): per node whose depth ``step`` divides, and the root, the sums of
    ``values`` strictly below it."""
    way = stored(paths(nodes, rows, step), "paths")
    valued = way.join(values, KEY)
    sums = [F.sum(c).alias(c) for c in ("n_leaves", "saved")]
    bands = stored(valued.groupBy("gate").agg(*sums).select("gate.*", "n_leaves", "saved"), "bands")
    if deepest > BAND * step:
        gates = below(bands, nodes, rows, BAND * step, deepest)
        # What lies below a gate: its own band and all that the gates below it gathered.
        both = bands.unionByName(gates).groupBy(*KEY).agg(*sums)
        bands = stored(both, "gates")
    # A gate passes what lies below it to the ancestors in its own band, next to its value.
    passed = valued.select(*KEY, "up", "n_leaves", "saved").join(
        bands.where("depth > 0").select(*KEY, F.col("n_leaves").alias("l"), F.col("saved").alias("s")), KEY, "left"
    )
    opened = passed.select(F.explode("up").alias("to"), "depth", "n_leaves", "saved", "l", "s")
    above = F.col("to.depth") < F.col("depth")
    share = [
        (F.coalesce(under, F.lit(0)) + F.when(above, F.col(own)).otherwise(F.lit(0))).alias(own)
        for own, under in (("n_leaves", "l"), ("saved", "s"))
    ]
    found = opened.select("to.*", *share).groupBy(*KEY).agg(*sums)
    return found.unionByName(bands.where("depth = 0").select(*KEY, "n_leaves", "saved"))


def ends_digests(ends: DataFrame, ids_per_row: int = 1000) -> DataFrame:
    """(key, ends_sha256) of nodes where conversations end: digest of their ids in order.

    Ids are range-sorted by node and id, so a node with most conversations spreads over many
    tasks, which write them as text in runs. What hashes a node then reads its runs one
    after another and holds one batch.
    """

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []

        def out() -> pa.RecordBatch:
            row = {**dict(zip(KEY, node, strict=True)), "first": ids[0], "text": ",".join(map(str, ids))}
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([(k, pa.int64()) for k in (*KEY, "first")] + [("text", pa.string())]))

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*KEY, "conv_id")]
            for *key, number in zip(*columns, strict=True):
                if ids and (key != node or len(ids) == ids_per_row):
                    yield out()
                    ids = []
                node = key
                ids.append(number)
        if ids:
            yield out()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None

        def out() -> pa.RecordBatch:
            row = {**dict(zip(KEY, node, strict=True)), "ends_sha256": state.hexdigest()}
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([(k, pa.int64()) for k in KEY] + [("ends_sha256", pa.string())]))

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*KEY, "text")]
            for *key, text in zip(*columns, strict=True):
                if key == node:
                    state.update(b",")
                else:
                    if state:
                        yield out()
                    node, state = key, hashlib.sha256()
                state.update(text.encode())
        if state:
            yield out()

    keys = ", ".join(f"{k} long" for k in KEY)
    order = [*KEY, "conv_id"]
    ordered = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    runs = ordered.mapInArrow(written, f"{keys}, first long, text string")
    return runs.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(hashed, f"{keys}, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """Every node with its members, children, subtree totals and digest of what ends there."""
    prepare(conversations.sparkSession)
    told, convs = rebuilt(conversations)
    rows = stored(prefixes(told), "prefixes")
    everyone = convs.agg(F.count("*").alias("n"), F.min("conv_id").alias("least"), F.max("length").alias("deepest")).first()
    plain = stored(nodes_of(rows), "nodes")
    # Children of the root are counted and linked apart: they may be most of all nodes.
    top = plain.where("depth = 1").agg(F.count("*").alias("n")).first()["n"]
    zero = F.lit(0).cast("long")
    root = conversations.sparkSession.range(1 if everyone["n"] else 0).select(
        zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), F.lit(everyone["n"]).cast("long").alias("n_convs"),
        F.lit(everyone["least"]).cast("long").alias("conv_id"), F.lit(None).cast("long").alias("parent_conv_id"),
        F.lit(top).cast("long").alias("n_children"), zero.alias("own_saved"),
    )
    parent_key = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")]
    counts = plain.where("depth > 1").groupBy(*parent_key).agg(F.count("*").alias("n_children"))
    parents = plain.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("above"))
    linked = plain.where("depth > 1").join(parents, ["depth", "p1", "p2"])
    linked = linked.unionByName(plain.where("depth = 1").withColumn("above", F.lit(everyone["least"]).cast("long")))
    kin = linked.join(counts, KEY, "left").select(
        *KEY, "n_convs", "conv_id", F.col("above").alias("parent_conv_id"),
        F.coalesce("n_children", F.lit(0)).alias("n_children"), ((F.col("n_convs") - 1) * F.col("words")).alias("own_saved"),
    )
    kin = stored(kin, "kin")
    values = kin.select(*KEY, (F.col("n_children") == 0).cast("long").alias("n_leaves"), F.col("own_saved").alias("saved"))
    totals = below(values, kin, rows, 1, everyone["deepest"] or 0)
    last = rows.where(F.col("depth") == F.col("length")).select(*KEY, "conv_id")
    turnless = convs.where("length = 0").select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "conv_id")
    digests = ends_digests(last.unionByName(turnless))
    whole = kin.unionByName(root).join(totals, KEY, "left").join(digests, KEY, "left")
    return whole.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        (F.coalesce("n_leaves", F.lit(0)) + (F.col("n_children") == 0).cast("long")).alias("n_leaves"),
        (F.coalesce("saved", F.lit(0)) + F.col("own_saved")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
