"""Merkle manifest of a dataset: leaves per row, a tree per language, one root, proofs.

Every aligned block of 512 nodes keeps each of its levels as one string of hex digests.
Parents are hashes of 512-digit substrings of a level, the siblings of a node are what
stands left and right of it in its substring. The tops of the blocks are the nodes of the
next round, which works in the same way, until every tree is down to its root; the roots
of the languages are then the nodes of the last tree. A round takes 512 nodes to one, so
there are few of them, and nothing but digests is ever sorted or grouped.

Null fields are marked as such in the leaf. A null language is a tree of its own and the
first one. A null doc_id comes first in its tree and counts as '' for the choice of tampered
rows; rows with equal doc_id follow each other by their leaf, and repeated rows are leaves of
their own. Texts are hashed whole, however long, where they are read. An empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faregauge.llm.common import in_class, prepare, stored
from faregauge.llm.placing import places

FAN = 8
LEVELS = 3
BLOCK = FAN**LEVELS
WIDTH = 64
RUN = FAN * WIDTH
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SEGMENT = "array<struct<before:string,after:string>>"


def leaf(text: Column) -> Column:
    """Digest of a row whose text is ``text``: every field with its length, or '-'."""

    def field(value: Column) -> Column:
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    values = [text if name == "text" else F.col(name).cast("string") for name in FIELDS]
    return F.sha2(F.concat(*map(field, values)), 256)


def folded_case(text: Column) -> Column:
    """``text`` with A-Z in lower case and all else as it is."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, tree, leaf, changed): ``changed`` is the leaf of the tampered row, if tampered."""
    tampered = folded_case(F.col("text").cast("string"))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("tree"),
        leaf(F.col("text").cast("string")).alias("leaf"),
        F.when(in_class(0, 3), leaf(tampered)).alias("changed"),
    )


def _runs(level: Column) -> Column:
    """A level cut into the strings of nodes that share a parent."""
    last = F.floor((F.length(level) - 1) / RUN).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(level, i * RUN + 1, F.lit(RUN)))


def _ended(level: int) -> Column:
    """Whether the tree ends below ``level``: a lone block that is down to one node."""
    return (F.col("size") <= BLOCK) & (F.size(f"runs{level}") == 1) & (F.length(F.get(f"runs{level}", F.lit(0))) == WIDTH)


def blocks(nodes: DataFrame) -> DataFrame:
    """Nodes (tree, pos, size, hash, item) in blocks, with the runs of all levels and the top.

    A block gathers 512 digests with their items, whatever the size of its tree.
    """
    grouped = nodes.groupBy("tree", F.floor(F.col("pos") / BLOCK).alias("block"), "size").agg(
        F.sort_array(F.collect_list(F.struct("pos", "hash", "item"))).alias("nodes")
    )
    built = grouped.withColumn("level", F.array_join(F.transform("nodes", lambda x: x["hash"]), ""))
    for k in range(LEVELS):
        built = built.withColumn(f"runs{k}", _runs(F.col("level")))
        above = F.array_join(F.transform(f"runs{k}", lambda run: F.sha2(run, 256)), "")
        built = built.withColumn("level", F.when(_ended(k), F.col("level")).otherwise(above))
    return built.withColumnRenamed("level", "top")


def _siblings(number: Column, level: int) -> Column:
    """What flanks node ``number`` (of the lowest level) in its run of ``level``, if there is one."""
    here = F.floor(number / FAN**level).cast("int")
    run = F.get(f"runs{level}", F.floor(here / FAN).cast("int"))
    at = (here % FAN) * WIDTH
    pair = F.struct(
        F.substring(run, F.lit(1), at).alias("before"),
        F.substring(run, at + WIDTH + 1, F.lit(RUN)).alias("after"),
    )
    return F.when(_ended(level), F.array().cast(SEGMENT)).otherwise(F.array(pair))


def with_paths(built: DataFrame, above: DataFrame) -> DataFrame:
    """(tree, pos, item, path, ...) of every node: its own segments, then those of its block.

    ``above`` has (tree, block, path) and what else goes to all nodes of a block.
    """
    passed = [c for c in above.columns if c not in ("tree", "block", "path")]
    kept = built.select("tree", "block", "size", "nodes", *[f"runs{k}" for k in range(LEVELS)])
    joined = kept.join(above, ["tree", "block"])
    opened = joined.select("*", F.posexplode("nodes").alias("number", "node"))
    own = F.concat(*[_siblings(F.col("number"), k) for k in range(LEVELS)])
    return opened.select(
        "tree",
        F.col("node.pos").alias("pos"),
        F.col("node.hash").alias("hash"),
        F.col("node.item").alias("item"),
        F.concat(own, "path").alias("path"),
        *passed,
    )


def above_blocks(built: DataFrame) -> DataFrame:
    """(tree, block, path, top) of every block: siblings on the way up, and the tree's root."""
    last = built.agg(F.max("block")).first()[0] or 0
    if last == 0:
        return built.select("tree", "block", F.array().cast(SEGMENT).alias("path"), "top")
    size = F.ceil(F.col("size") / BLOCK).alias("size")
    nodes = built.select("tree", F.col("block").alias("pos"), size, F.col("top").alias("hash"), F.lit(0).alias("item"))
    upper = stored(blocks(nodes), "blocks")
    found = with_paths(upper, above_blocks(upper))
    return found.select("tree", F.col("pos").alias("block"), "path", "top")


def folded(start: Column, path: Column) -> Column:
    """The root that ``start`` leads to with the given siblings."""
    return F.aggregate(path, start, lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]), 256))


def manifest(docs: DataFrame) -> DataFrame:
    """Leaf, roots, proof and check of every row."""
    prepare(docs.sparkSession)
    rows = places(stored(leaves(docs), "leaves"), "tree", ["doc_id", "leaf"])
    item = F.struct("doc_id", "changed").alias("item")
    built = stored(blocks(rows.select("tree", "pos", "size", F.col("leaf").alias("hash"), item)), "blocks")
    trees = above_blocks(built).withColumnRenamed("top", "subroot")
    # One row per language, in the order of the trees' names: '' for null, else '=' and the bytes.
    roots = trees.where(F.col("block") == 0).select(F.lit("").alias("all"), "tree", "subroot")
    ordered = places(stored(roots, "subroots"), "all", ["tree"])
    nodes = ordered.select(F.col("all").alias("tree"), "pos", "size", F.col("subroot").alias("hash"), F.col("tree").alias("item"))
    joint = stored(blocks(nodes), "blocks")
    heads = with_paths(joint, above_blocks(joint)).select(
        F.col("item").alias("tree"), F.col("path").alias("last"), F.col("top").alias("root")
    )
    above = trees.join(heads, "tree").select("tree", "block", F.concat("path", "last").alias("path"), "subroot", "root")
    found = with_paths(built, above)
    start = F.coalesce("item.changed", "hash")
    proof = F.array_join(F.transform("path", lambda s: F.concat(s["before"], s["after"])), "")
    checked = found.select(
        F.col("item.doc_id").alias("doc_id"),
        F.col("hash").alias("leaf"),
        "subroot",
        "root",
        F.sha2(proof, 256).alias("proof_sha256"),
        folded(start, F.col("path")).alias("folded_root"),
    )
    return checked.withColumn("verified", F.col("folded_root") == F.col("root"))
