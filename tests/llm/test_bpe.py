"""Own encoding against the library, on awkward words and on all given texts."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from faregauge.llm import bpe, token_files
from faregauge.llm.shingles import RUN_BYTES

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_texts():
    rng = random.Random(5)
    letters = "ab eéñß  \n\t'.,0123 the ing  　\x85\x1c\x0b\x1c\x0b漢字🙂<|>s"
    made = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    return made + [
        "", " ", "  ", "a", " a ", "a  b", "a \n b", "a\n\nb", "<|endoftext|>", "x<|endoftext|> y", "a <|endoftext|>",
        "<|endoftext|><|endoftext|>", "a" * 3000, "aaaaaaa aa aaaa", "ab" * 999, " " * 50, "é" * 77, "it's we'll I'VE",
        "\x00\x01", " x  y", "x 　y", "tab\t tab", "end ", "\n",
    ]


def test_own_ids_are_the_librarys(library):
    texts = odd_texts()
    wanted = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    for encoder in (bpe.own_encoder(PATH), token_files.library_encoder(PATH)):
        ids, bounds = encoder.encode(pa.array(texts))
        got = [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
        assert got == wanted


def test_decoded_as_the_library(library):
    words = bpe.vocabulary(PATH)
    for text in odd_texts():
        ids = library.encode(text, add_special_tokens=False).ids
        assert words.decode(np.array(ids, "<u4")) == library.decode(ids, skip_special_tokens=False) == text


def test_compatibility_is_what_merging_says():
    words = bpe.vocabulary(PATH)
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 3000, 20_000), rng.integers(0, 3000, 20_000)
    stable = [words._stable(int(x)) and words._stable(int(y)) for x, y in zip(a, b)]
    got = words.compatible(a, b)
    for x, y, ok, told in zip(a.tolist(), b.tolist(), stable, got.tolist()):
        if ok:
            assert told == (words.merge(words.bytes_of[x] + words.bytes_of[y]) == [x, y])


def test_all_tokens_that_may_be_proposed_merge_to_themselves():
    words = bpe.vocabulary(PATH)
    for token, number in words._proposed.items():
        assert words.merge(token) == [number]


def test_rows_of_every_kind(spark, make, library):
    import hashlib

    rows = [(1, "it is"), (1, "it is"), (None, "x"), (2, None), (3, ""), (4, "word " * 40_000)]
    docs = make([(i, t, "x", 7) for i, t in rows], "doc_id long, text string, ids string, n_tokens int")
    got = bpe.round_trip(docs).collect()
    wanted = []
    for i, t in rows:
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids, "<u4")
        wanted.append((i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(wanted, key=str)
    assert bpe.round_trip(docs.limit(0)).collect() == []


def test_a_step_takes_a_run_of_texts_and_hands_it_over(monkeypatch, library):
    class Rows:
        def mapInArrow(self, run, schema):
            return run

    monkeypatch.setattr(bpe, "_rows", lambda docs: Rows())
    texts = [*odd_texts()[:500], *(f"some words of text {i} " * 2000 for i in range(60)), "", "long words " * 300_000, "end"]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts))), "text": pa.array(texts)})
    given = batch.slice(0, 0), batch
    wanted = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    for operator in (bpe.encode, bpe.encode_decode, bpe.round_trip):
        made = list(operator(None)(iter(given)))
        place = 0
        for part in made:
            size = sum(len(t.encode()) for t in texts[place : place + len(part)])
            assert len(part) == 1 or size <= RUN_BYTES
            place += len(part)
        rows = pa.Table.from_batches(made).to_pydict()
        assert rows["doc_id"] == list(range(len(texts)))
        if "ids" in rows:
            assert rows["ids"] == wanted
        if "text" in rows:
            assert rows["text"] == texts
        if "n_tokens" in rows:
            assert rows["n_tokens"] == [len(ids) for ids in wanted]
            digests = [hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest() for ids in wanted]
            assert rows["ids_sha256"] == digests
            assert rows["decoded_sha256"] == [hashlib.sha256(t.encode()).hexdigest() for t in texts]
