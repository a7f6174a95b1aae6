"""Byte-pair encoding by speculation: propose the longest tokens, verify, merge the rest.

Greedy longest match proposes the tokens of a word. The proposal is what merging in rank
order gives exactly if every adjacent pair (a, b) is compatible, that is if merging the
bytes of a and b together ends with a and b again. Compatibility needs no merging: while a
and b are built, the right edge of a passes through some tokens and the left edge of b
through others, each for a known span of ranks. The pair fails if any token of one edge
and any of the other have a merge whose rank falls in both spans. That test is arithmetic
on arrays over all new pairs of a batch. Words with a failing pair are merged exactly.

Null text counts as empty and gives no ids. Every row keeps its own result, repeated rows
and null doc_ids included; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faregauge.llm.chunks import ChunkEncoder
from faregauge.llm.common import by_batch, by_run, prepare, text_or_empty

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
NEVER = np.int64(1) << 40
# Verified pairs a worker remembers, some 100 bytes each.
PAIRS_REMEMBERED = 250_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file, reversed.

    Printable Latin-1 characters stand for themselves, the other bytes for the characters
    from 256 on, in order.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Tokens, merges and special strings of a byte-level vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            saved = json.load(file)
        letters = byte_letters()
        as_bytes = lambda token: bytes(letters[c] for c in token)
        model = saved["model"]
        self.special = {t["content"]: t["id"] for t in saved["added_tokens"]}
        ids = {as_bytes(t): i for t, i in model["vocab"].items()}
        size = max([*ids.values(), *self.special.values()]) + 1
        self.bytes_of = [b""] * size
        for token, number in ids.items():
            self.bytes_of[number] = token
        for text, number in self.special.items():
            self.bytes_of[number] = text.encode()
        self.of_byte = [ids[bytes([b])] for b in range(256)]
        self.left, self.right = np.full(size, -1), np.full(size, -1)
        self.born = np.full(size, -1, np.int64)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        self.one_way = True
        for rank, pair in enumerate(model["merges"]):
            a, b = (ids[as_bytes(x)] for x in (pair.split(" ") if isinstance(pair, str) else pair))
            made = ids[self.bytes_of[a] + self.bytes_of[b]]
            self.one_way &= self.born[made] < 0
            self.merges[a, b] = rank, made
            self.left[made], self.right[made], self.born[made] = a, b, rank
        keys = np.array([a * size + b for a, b in self.merges], np.int64)
        order = np.argsort(keys)
        self._keys = np.append(keys[order], np.int64(1) << 62)
        self._ranks = np.append(np.array([r for r, _ in self.merges.values()], np.int64)[order], NEVER)
        self._size = size
        self._proposed = {t: i for t, i in ids.items() if self._stable(i)}
        # Longest token that starts with two given bytes.
        self._reach: dict[bytes, int] = {}
        for token in self._proposed:
            self._reach[token[:2]] = max(len(token), self._reach.get(token[:2], 1))
        self._compatible: dict[int, bool] = {}
        # White space as Unicode lists it: the regex module's \\s has four control characters more.
        pattern = public_tokenizers.PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        self._piece = regex.compile(pattern)
        self._specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def _stable(self, token: int) -> bool:
        """Whether the token's own bytes merge to it: only then may it be proposed."""
        if not hasattr(self, "_stables"):
            made = np.flatnonzero(self.born >= 0)
            stable = np.ones(self._size, bool)
            stable[made] = self.compatible(self.left[made], self.right[made], self.born[made])
            for t in made[np.argsort(self.born[made])]:
                stable[t] &= stable[self.left[t]] and stable[self.right[t]]
            self._stables = stable
        return bool(self._stables[token])

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self._size + b
        at = np.searchsorted(self._keys, key)
        return np.where(self._keys[at] == key, self._ranks[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """Per pair, whether merging both together leaves the border between them.

        ``until`` bounds the ranks looked at. A token at the right edge of ``a`` lasts until
        the merge that takes it in; of merges with equal rank the leftmost goes first, so a
        merge across the border loses to one inside ``a`` and wins over one inside ``b``.
        """
        fine = np.ones(len(a), bool)
        limit = np.full(len(a), NEVER) if until is None else until
        x, x_ends = a.copy(), limit.copy()
        rows = np.arange(len(a))
        while len(rows):
            y, y_ends, inner = b[rows].copy(), limit[rows].copy(), np.arange(len(rows))
            while len(inner):
                rank = self._rank(x[rows][inner], y[inner])
                ends = y_ends[inner]
                # The bound itself is not an event inside b: ranks stay strictly below it.
                before = np.where(ends == limit[rows][inner], rank < ends, rank <= ends)
                bad = (rank < x_ends[rows][inner]) & before & (rank < limit[rows][inner])
                fine[rows[inner[bad]]] = False
                y_ends[inner] = np.minimum(np.where(self.born[y[inner]] >= 0, self.born[y[inner]], 0), limit[rows][inner])
                deeper = self.left[y[inner]] >= 0
                inner = inner[deeper]
                y[inner] = self.left[y[inner]]
            deeper = (self.right[x[rows]] >= 0) & fine[rows]
            rows = rows[deeper]
            x_ends[rows] = self.born[x[rows]]
            x[rows] = self.right[x[rows]]
        return fine

    def propose(self, word: bytes) -> list[int]:
        """Longest tokens from the left."""
        found, at, end = [], 0, len(word)
        ids, reach = self._proposed, self._reach
        while at < end:
            for stop in range(min(at + reach.get(word[at : at + 2], 1), end), at, -1):
                token = ids.get(word[at:stop])
                if token is not None:
                    found.append(token)
                    at = stop
                    break
        return found

    def merge(self, word: bytes) -> list[int]:
        """Exact merging: always the lowest rank, of equal ones the leftmost."""
        tokens = [self.of_byte[b] for b in word]
        after = list(range(1, len(tokens) + 1))
        before = list(range(-1, len(tokens) - 1))
        queue: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(tokens) and (m := self.merges.get((tokens[i], tokens[j]))):
                heapq.heappush(queue, (m[0], i, tokens[i], tokens[j]))

        for i in range(len(tokens) - 1):
            offer(i)
        while queue:
            _, i, a, b = heapq.heappop(queue)
            j = after[i]
            if tokens[i] != a or j >= len(tokens) or tokens[j] != b:
                continue
            tokens[i] = self.merges[a, b][1]
            tokens[j] = -1
            after[i] = after[j]
            if after[j] < len(tokens):
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [t for t in tokens if t >= 0]

    def _verified(self, pairs: np.ndarray) -> np.ndarray:
        known = self._compatible
        if len(known) > PAIRS_REMEMBERED:
            known.clear()
        different, place = np.unique(pairs, return_inverse=True)
        new = np.array([p for p in different.tolist() if p not in known], np.int64)
        if len(new):
            known.update(zip(new.tolist(), self.compatible(new // self._size, new % self._size).tolist(), strict=True))
        return np.fromiter(map(known.__getitem__, different.tolist()), bool, len(different))[place]

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Ids of words: propose all, verify all adjacent pairs, merge what failed."""
        if not self.one_way:
            return [self.merge(w) for w in words]
        found = [self.propose(w) for w in words]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((t for ids in found for t in ids), np.int64, int(sizes.sum()))
        if len(flat) < 2:
            return found
        owner = np.repeat(np.arange(len(found)), sizes)
        inside = owner[:-1] == owner[1:]
        fine = self._verified((flat[:-1] * self._size + flat[1:])[inside])
        for i in np.unique(owner[:-1][inside][~fine]).tolist():
            found[i] = self.merge(words[i])
        return found

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk: cut into pieces, then every different piece once."""
        pieces = [[p.encode() for p in self._piece.findall(c)] for c in chunks]
        different = list({p for several in pieces for p in several})
        ids = dict(zip(different, self.encode_words(different), strict=True))
        return [np.array([t for p in several for t in ids[p]], "<u4").tobytes() for several in pieces]

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts; strings of special tokens are these tokens."""
        result = []
        for text in texts:
            parts = self._specials.split(text) if self._specials else [text]
            coded = iter(self.encode_chunks([p for p in parts if p not in self.special]))
            result.append(
                b"".join(np.array([self.special[p]], "<u4").tobytes() if p in self.special else next(coded) for p in parts)
            )
        return result

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=2)
def own_encoder(path: str) -> ChunkEncoder:
    words = vocabulary(path)
    return ChunkEncoder(words.encode_chunks, words.encode_texts, tuple(words.special))


def _each(lists: pa.ListArray):
    bounds, ids = lists.offsets.to_numpy(), lists.values.to_numpy().astype("<u4")
    return (ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True))


def _encoded(path: str, texts: pa.Array) -> pa.ListArray:
    ids, bounds = own_encoder(path).encode(texts)
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32)))


def _decoded(path: str, lists: pa.ListArray) -> list[str]:
    words = vocabulary(path)
    return [words.decode(ids) for ids in _each(lists)]


def _sums(values) -> pa.Array:
    return pa.array([hashlib.sha256(v).hexdigest() for v in values], pa.string())


def _rows(docs: DataFrame) -> DataFrame:
    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))


def encode(docs: DataFrame, path: str = BYTE_BPE) -> DataFrame:
    """(doc_id, ids) of every row of ``docs``; no shuffle."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), _encoded(path, batch.column("text"))], ["doc_id", "ids"])

    return by_run(_rows(docs), lambda: step, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str = BYTE_BPE) -> DataFrame:
    """(doc_id, ids, text) with the text that the ids stand for."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = pa.array(_decoded(path, batch.column("ids")), pa.string())
        return pa.RecordBatch.from_arrays([*batch.columns, texts], ["doc_id", "ids", "text"])

    return by_batch(encoded.select("doc_id", "ids"), lambda: step, "doc_id long, ids array<int>, text string")


def encode_decode(docs: DataFrame, path: str = BYTE_BPE) -> DataFrame:
    """(doc_id, ids, text) as of ``decode(encode(docs))``, in one worker per task."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = _encoded(path, batch.column("text"))
        texts = pa.array(_decoded(path, lists), pa.string())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, texts], ["doc_id", "ids", "text"])

    return by_run(_rows(docs), lambda: step, "doc_id long, ids array<int>, text string")


def round_trip(docs: DataFrame, path: str = BYTE_BPE) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode, decode, and digest both.

    All three in one worker per task, and only digests leave it.
    """

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = _encoded(path, batch.column("text"))
        sizes = pa.array(np.diff(lists.offsets.to_numpy()).astype(np.int64))
        texts = (text.encode() for text in _decoded(path, lists))
        columns = [batch.column("doc_id"), sizes, _sums(_each(lists)), _sums(texts)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return by_run(_rows(docs), lambda: step, schema)
