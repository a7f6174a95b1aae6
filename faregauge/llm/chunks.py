"""Texts as chunks between spaces, so that a batch encodes each different chunk once.

A byte-level tokenizer first cuts a text into pieces, and a piece has at most one space,
in front. Between two characters that aren't white space a single space therefore always
starts a piece, and what stands between such spaces can be encoded on its own. Arrow cuts
and numbers the chunks of a batch; the ids of the different chunks are then laid out in
text order with array operations. A worker remembers the ids of chunks it has met.

Texts with other white space next to a space, with a space at the end, or with a special
token's string go through as a whole.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# White space beside a space, a space at the end. RE2 knows ASCII \s and the Z classes.
_UNSAFE = r" [\s\x0b\x{85}\pZ]|[\s\x0b\x{85}\pZ] | \z"
# Bytes of chunks and their ids that a worker remembers, and what an entry has besides.
REMEMBERED_BYTES = 80 << 20
ENTRY_BYTES = 180
# The same in arrays, with what a lookup and a copy take for a moment.
ARRAY_ENTRY_BYTES = 80

Encoder = Callable[[list[str]], list[bytes]]
ArrayFunction = Callable[[pa.Array, pa.Array], pa.ListArray]


def _escaped(literal: str) -> str:
    return "".join("\\" + c if not c.isalnum() else c for c in literal)


class _Cutter:
    """Batches of texts cut into chunks."""

    def __init__(self, texts: Encoder, special: tuple[str, ...]):
        self._texts = texts
        self._unsafe = "|".join([_UNSAFE, *map(_escaped, special)])

    def _numbered(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array, pa.Array]:
        """Which texts go as a whole, the number of every chunk, where the chunks of a text
        start, and the different chunks: those with a space in front are numbered first."""
        whole = pc.match_substring_regex(texts, self._unsafe).to_numpy(zero_copy_only=False)
        # A text that goes as a whole is a list with one chunk, which is never looked up.
        lists = pc.split_pattern(pc.if_else(pa.array(whole), "", texts), " ")
        bounds = lists.offsets.to_numpy().astype(np.int64)
        bounds = bounds - bounds[0]
        chunks = lists.flatten()
        first = np.zeros(len(chunks), bool)
        first[bounds[:-1]] = True
        codes = np.empty(len(chunks), np.int64)
        later = chunks.filter(pa.array(~first)).dictionary_encode()
        starts = chunks.filter(pa.array(first)).dictionary_encode()
        codes[~first] = later.indices.to_numpy()
        codes[first] = starts.indices.to_numpy() + len(later.dictionary)
        spaced = pc.binary_join_element_wise("", later.dictionary, " ")
        return whole, codes, bounds, spaced, starts.dictionary


class ChunkEncoder(_Cutter):
    """Ids of whole batches from two functions: one for chunks, one for whole texts.

    Both take strings and return each string's ids as little-endian 32-bit integers.
    """

    def __init__(self, chunks: Encoder, texts: Encoder, special: tuple[str, ...] = ()):
        super().__init__(texts, special)
        self._chunks = chunks
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._held = 0

    def _ids_of(self, keys: list[str]) -> list[bytes]:
        # Two generations: what is met again in time is carried over, rare chunks go.
        if self._held > REMEMBERED_BYTES // 2:
            self._known, self._older, self._held = {}, self._known, 0
        known, older = self._known, self._older
        found = list(map(known.get, keys))
        missing = [i for i, ids in enumerate(found) if ids is None]
        for known_to in (lambda names: list(map(older.get, names)), self._chunks):
            if not missing:
                break
            names = [keys[i] for i in missing]
            several = known_to(names)
            new = {name: ids for name, ids in zip(names, several, strict=True) if ids is not None}
            known.update(new)
            self._held += ENTRY_BYTES * len(new) + sum(map(len, new)) + sum(map(len, new.values()))
            for i, ids in zip(missing, several, strict=True):
                found[i] = ids
            missing = [i for i in missing if found[i] is None]
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the batch in a row, and the offsets of its texts (one more than texts)."""
        if not len(texts):
            return np.zeros(0, "<u4"), np.zeros(1, np.int64)
        whole, codes, bounds, spaced, starts = self._numbered(texts)
        keys = _strings(spaced) + _strings(starts)
        ids = self._ids_of(keys)
        if whole.any():
            places = np.flatnonzero(whole)
            codes[bounds[:-1][places]] = len(ids) + np.arange(len(places))
            ids = ids + self._texts(texts.take(pa.array(places)).to_pylist())
        return _laid_out(codes, ids, bounds)


class ArrayEncoder(_Cutter):
    """The same with chunks, their ids and the memory of both in Arrow arrays.

    No chunk that follows a space becomes a Python object. ``chunks`` takes these, space in
    front, and the chunks that start a text; it returns the ids of all, a list for each, in
    that order.
    """

    def __init__(self, chunks: ArrayFunction, texts: Encoder, special: tuple[str, ...] = ()):
        super().__init__(texts, special)
        self._chunks = chunks
        self._forget()

    def _forget(self) -> None:
        self._names = pa.array([], pa.string())
        self._lists = pa.array([], pa.list_(pa.uint32()))
        self._met = np.zeros(0, np.int64)
        self._batches = 0

    def _make_room(self, keys: pa.Array) -> None:
        """What was met least recently goes, half of all entries or more."""
        if keys.nbytes > REMEMBERED_BYTES:
            self._forget()
        if ARRAY_ENTRY_BYTES * len(self._names) + self._names.nbytes + self._lists.nbytes > REMEMBERED_BYTES:
            recent = self._met > np.median(self._met)
            kept = pa.array(np.flatnonzero(recent))
            self._names, self._lists, self._met = self._names.take(kept), self._lists.take(kept), self._met[recent]

    def _places(self, spaced: pa.Array, starts: pa.Array) -> np.ndarray:
        """The entry of every chunk in the memory, after new ones have been added."""
        keys = pa.concat_arrays([spaced, starts])
        self._make_room(keys)
        found = pc.index_in(keys, value_set=self._names)
        new = found.is_null()
        places = found.fill_null(0).to_numpy().astype(np.int64)
        missing = new.to_numpy(zero_copy_only=False)
        places[missing] = len(self._names) + np.arange(found.null_count)
        made = self._chunks(spaced.filter(new[: len(spaced)]), starts.filter(new[len(spaced) :]))
        self._names = pa.concat_arrays([self._names, keys.filter(new)])
        self._lists = pa.concat_arrays([self._lists, made])
        self._batches += 1
        self._met = np.append(self._met, np.zeros(found.null_count, np.int64))
        self._met[places] = self._batches
        return places

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the batch in a row, and the offsets of its texts (one more than texts)."""
        if not len(texts):
            return np.zeros(0, "<u4"), np.zeros(1, np.int64)
        whole, codes, bounds, spaced, starts = self._numbered(texts)
        codes = self._places(spaced, starts)[codes]
        lists = self._lists
        if whole.any():
            at = np.flatnonzero(whole)
            codes[bounds[:-1][at]] = len(lists) + np.arange(len(at))
            lists = pa.concat_arrays([lists, id_lists(self._texts(texts.take(pa.array(at)).to_pylist()))])
        laid = lists.take(pa.array(codes))
        return laid.values.to_numpy(), laid.offsets.to_numpy().astype(np.int64)[bounds]


def id_lists(several: list[bytes]) -> pa.ListArray:
    """The ids of several strings as one array of lists."""
    ends = np.cumsum(np.fromiter(map(len, several), np.int64, len(several)) // 4)
    ids = np.frombuffer(b"".join(several), "<u4")
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids))


def _strings(values: pa.Array) -> list[str]:
    """``to_pylist`` without a scalar object per value."""
    return values.to_numpy(zero_copy_only=False).tolist()


def _laid_out(codes: np.ndarray, ids: list[bytes], bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    pool = np.frombuffer(b"".join(ids), "<u4")
    sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    starts = np.cumsum(sizes) - sizes
    each = sizes[codes]
    ends = np.concatenate([[0], np.cumsum(each)])
    places = np.repeat(starts[codes] - ends[:-1], each) + np.arange(ends[-1])
    return pool[places], ends[bounds]
