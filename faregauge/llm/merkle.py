"""Merkle fingerprints of documents: pieces, paragraphs, sections, root.

A line is a paragraph, eight paragraphs are a section. A paragraph's hash covers its whole
line, a section's hash its paragraphs' hashes, the root the sections' hashes, so roots are
equal exactly for equal texts (all these hashes have 128 bits; below the root 48 of them are
printed). Below the paragraphs the fingerprint lists 32-bit hashes of
pieces, runs of up to three words that end with a sentence; they tell how alike two texts
are whose branches differ, and ``differing_paragraphs`` follows differing branches down.

    root:section=paragraph(pieces),paragraph(pieces);section=...

The next document of the edit is found on ids alone; texts move once, to meet the start of
the next text and its pieces. Everything is built from DataFrame functions.

Null text counts as empty: one empty paragraph, no pieces. Rows with equal doc_id follow
each other in the order of their files, null ids come last, and the next of the last row
is the first (of a single row: itself). An empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faregauge.llm.common import anchored, prepare, scratch, text_or_empty
from faregauge.operators.keys import key_offsets, numbered, stage_ordered

SECTION = 8
ROW = "_merkle_row"
# Up to three words of a line, none after one that ends a sentence.
PIECE = r"(?:[^\s]*[^\s.!?][ \t]+){0,2}[^\s]+"
# Hex digits of a hash in the tree, and of a paragraph's or section's as printed below the root.
WIDTH = 32
PRINTED = 12


def _short(value: Column, digits: int) -> Column:
    return F.substring(F.sha2(value, 256), 1, digits)


def _pieces(paragraph: Column) -> Column:
    found = F.regexp_extract_all(paragraph, F.lit(PIECE), F.lit(0))
    return F.transform(found, lambda p: F.shiftright(F.xxhash64(p), 32).cast("int"))


def tree(text: Column) -> Column:
    """Paragraphs of a text as (hash, pieces), in order."""
    return F.transform(
        F.split(text, "\n"), lambda p: F.struct(_short(p, WIDTH).alias("hash"), _pieces(p).alias("pieces"))
    )


def _sections(paragraphs: Column) -> Column:
    starts = F.sequence(F.lit(1), F.size(paragraphs), F.lit(SECTION))
    return F.transform(starts, lambda i: F.slice(paragraphs, i, SECTION))


def _section_hash(section: Column) -> Column:
    return _short(F.array_join(F.transform(section, lambda p: p["hash"]), ","), WIDTH)


def root(paragraphs: Column) -> Column:
    """Hash over the section hashes; the number of paragraphs goes in as well."""
    sections = F.transform(_sections(paragraphs), _section_hash)
    return _short(F.concat_ws(",", F.size(paragraphs).cast("string"), F.array_join(sections, ",")), WIDTH)


def pieces(paragraphs: Column) -> Column:
    """All piece hashes of a text, in order."""
    return F.flatten(F.transform(paragraphs, lambda p: p["pieces"]))


def fingerprint(paragraphs: Column) -> Column:
    """The whole tree as text, from the root down."""

    def of_paragraph(p: Column) -> Column:
        marks = F.array_join(F.transform(p["pieces"], lambda x: F.lower(F.substring(F.lpad(F.hex(x), 16, "0"), 9, 8))), "")
        return F.concat(F.substring(p["hash"], 1, PRINTED), F.lit("("), marks, F.lit(")"))

    def of_section(section: Column) -> Column:
        return F.concat(F.substring(_section_hash(section), 1, PRINTED), F.lit("="), F.array_join(F.transform(section, of_paragraph), ","))

    return F.concat(root(paragraphs), F.lit(":"), F.array_join(F.transform(_sections(paragraphs), of_section), ";"))


def likeness(root_a: Column, pieces_a: Column, root_b: Column, pieces_b: Column) -> Column:
    """1 for equal roots, else the share of pieces that both have among those either has."""
    either = F.size(F.array_union(pieces_a, pieces_b))
    shared = F.size(F.array_intersect(pieces_a, pieces_b)) / F.greatest(either, F.lit(1))
    return F.when(root_a == root_b, F.lit(1.0)).otherwise(shared)


def differing_paragraphs(a: Column, b: Column) -> Column:
    """Numbers (from 0) of the paragraphs that differ between two trees.

    Sections with equal hashes are passed over without a look at their paragraphs.
    """
    longest = F.greatest(F.size(a), F.size(b))
    starts = F.sequence(F.lit(1), longest, F.lit(SECTION))

    def branch(i: Column) -> Column:
        left, right = F.slice(a, i, SECTION), F.slice(b, i, SECTION)
        places = F.sequence(F.lit(0), F.greatest(F.size(left), F.size(right)) - 1)
        other = F.filter(places, lambda j: ~F.get(left, j)["hash"].eqNullSafe(F.get(right, j)["hash"]))
        return F.when(_section_hash(left) == _section_hash(right), F.array().cast("array<int>")).otherwise(
            F.transform(other, lambda j: (i + j - 1).cast("int"))
        )

    return F.flatten(F.transform(starts, branch))


def followers(rows: DataFrame) -> DataFrame:
    """(row, doc_id, before, before_chars): the row before each one in doc_id order.

    Only ids and lengths are sorted. ``before`` of the first row is the last one.
    """
    lengths = rows.select(ROW, "doc_id", F.char_length("text").alias("n_chars"))
    staged = stage_ordered(lengths, ["doc_id"], scratch(rows.sparkSession, "order"))
    total = staged.count()
    placed = numbered(staged, key_offsets(staged, ["part_no"]), ["part_no"], "place")
    before = placed.select(
        (F.col("place") % F.lit(max(total, 1)) + 1).alias("place"),
        F.col(ROW).alias("before"),
        F.col("n_chars").alias("before_chars"),
    )
    return placed.select("place", ROW, "doc_id").join(before, "place").drop("place")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of every text, of its edited form, and likeness to that and the next."""
    prepare(docs.sparkSession)
    rows = anchored(docs.select("doc_id", "text")).select(
        F.monotonically_increasing_id().alias(ROW), F.col("doc_id").cast("long"), text_or_empty().alias("text")
    )
    placed = rows.select(ROW, "text").join(followers(rows), ROW)
    own = placed.select(ROW, "doc_id", "text", tree(F.col("text")).alias("tree"))
    ahead = placed.select(
        F.col("before").alias(ROW),
        F.expr("substring(text, 1, cast(floor(before_chars / 4) as int))").alias("patch"),
        root(tree(F.col("text"))).alias("next_root"),
        pieces(tree(F.col("text"))).alias("next_pieces"),
    )
    cut = "cast(char_length(text) - floor(char_length(text) / 4) as int)"
    both = own.join(ahead, ROW).withColumn("edited", F.concat(F.expr(f"substring(text, 1, {cut})"), "patch"))
    both = both.withColumn("edited_tree", tree(F.col("edited")))
    mine, changed = F.col("tree"), F.col("edited_tree")
    return both.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        fingerprint(mine).alias("fingerprint"),
        fingerprint(changed).alias("edited_fingerprint"),
        likeness(root(mine), pieces(mine), root(changed), pieces(changed)).alias("near_edited"),
        likeness(root(mine), pieces(mine), F.col("next_root"), F.col("next_pieces")).alias("near_next"),
    )
