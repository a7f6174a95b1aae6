"""Files of ids: order, starts, coding, and the library's own ids."""

import cProfile
import gc
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
from tokenizers import Tokenizer

from faregauge.llm import chunks, token_files
from faregauge.llm.common import scratch

SF = "/root/testdata/sf0.001"


def expected(rows):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start, out = 0, []
    for number, text in rows:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        out.append((number, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    path = scratch(spark, "ids")
    token_files.write_tokens(docs.repartition(3), path)
    got = token_files.token_digests(token_files.read_tokens(spark, path)).collect()
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    assert sorted(map(tuple, got)) == expected(rows)


def test_coding_and_page_index(spark):
    path = scratch(spark, "ids")
    token_files.write_tokens(spark.read.parquet(f"{SF}/documents.parquet").coalesce(1), path)
    parts = [f for f in spark.read.parquet(path).inputFiles()]
    meta = pq.ParquetFile(parts[0].removeprefix("file://")).metadata.row_group(0)
    columns = {meta.column(i).path_in_schema: meta.column(i) for i in range(meta.num_columns)}
    ids = next(c for name, c in columns.items() if name.startswith("ids"))
    assert "RLE_DICTIONARY" in ids.encodings
    assert "DELTA_BINARY_PACKED" in columns["first"].encodings
    assert columns["doc_id"].has_column_index and columns["doc_id"].has_offset_index
    metadata = token_files.read_metadata(spark, path)
    assert "ids:array" not in metadata._jdf.queryExecution().executedPlan().toString()


def test_odd_rows(spark, make):
    docs = make([(5, None, 1), (2, "b", 1), (2, "b", 1), (9, "", 1)], "doc_id long, text string, first int")
    path = scratch(spark, "ids")
    token_files.write_tokens(docs, path)
    got = sorted(map(tuple, token_files.token_digests(token_files.read_tokens(spark, path)).collect()))
    assert got == sorted(expected([(2, "b"), (2, "b"), (5, None), (9, "")]))
    path = scratch(spark, "ids")
    token_files.write_tokens(docs.limit(0), path)
    assert token_files.token_digests(token_files.read_tokens(spark, path)).collect() == []


def test_chunks_cost_few_calls_and_survive_small_memory(monkeypatch):
    """Ids as the library gives them, however little is remembered, at a few Python calls per chunk."""
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("abcdeé,.", k=6)) for _ in range(500)) for _ in range(8)]
    texts += ["", " two  spaces", "<|endoftext|> x", "a\tb c ", *texts[:2]]
    library = Tokenizer.from_file(token_files.BYTE_BPE)
    wanted = [library.encode(t, add_special_tokens=False).ids for t in texts]
    token_files.library_encoder.cache_clear()
    encoder = token_files.library_encoder(token_files.BYTE_BPE)
    profile = cProfile.Profile()
    ids, bounds = profile.runcall(encoder.encode, pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == wanted
    calls = sum(entry.callcount for entry in profile.getstats())
    assert calls < 5 * len({c for t in texts for c in t.split(" ")})
    monkeypatch.setattr(chunks, "REMEMBERED_BYTES", 100_000)
    for i in [*range(len(texts)), *range(len(texts))]:
        ids, _ = encoder.encode(pa.array(texts[i : i + 1]))
        assert ids.tolist() == wanted[i]
    token_files.library_encoder.cache_clear()


def test_chunks_between_spaces_cost_no_python_call_each():
    rng = random.Random(7)
    texts = [" ".join("".join(rng.choices("abcdeé,.", k=7)) for _ in range(3000)) for _ in range(8)]
    library = Tokenizer.from_file(token_files.BYTE_BPE)
    token_files.library_encoder.cache_clear()
    encoder = token_files.library_encoder(token_files.BYTE_BPE)
    encoder.encode(pa.array(["what is loaded once", "end "]))
    gc.collect()
    profile = cProfile.Profile()
    ids, bounds = profile.runcall(encoder.encode, pa.array(texts))
    wanted = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == wanted
    calls = sum(entry.callcount for entry in profile.getstats())
    assert calls < len({c for t in texts for c in t.split(" ")}) / 5, calls
    token_files.library_encoder.cache_clear()


def test_memory_is_bounded_and_keeps_what_was_met_last(monkeypatch):
    monkeypatch.setattr(chunks, "REMEMBERED_BYTES", 60_000)
    rng = random.Random(11)
    library = Tokenizer.from_file(token_files.BYTE_BPE)
    token_files.library_encoder.cache_clear()
    encoder = token_files.library_encoder(token_files.BYTE_BPE)
    for step in range(30):
        texts = ["often met words " + " ".join("".join(rng.choices("abcdé,", k=5)) for _ in range(40)) for _ in range(3)]
        texts += [["", "two  spaces"], ["<|endoftext|>"], ["漢字 é́ ​", "end "], []][step % 4]
        batch = pa.array(["before", *texts, "after"]).slice(1, len(texts))
        ids, bounds = encoder.encode(batch)
        wanted = [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == wanted
        assert chunks.ARRAY_ENTRY_BYTES * len(encoder._names) < 60_000 + chunks.ARRAY_ENTRY_BYTES * 150
        assert len(encoder._names) == len(set(encoder._names.to_pylist())) == len(encoder._lists)
        assert {"often", " met", " words"} <= set(encoder._names.to_pylist())
    whole = ["x \n y", "end ", "<|endoftext|>"]
    ids, bounds = encoder.encode(pa.array(whole))
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [library.encode(t, add_special_tokens=False).ids for t in whole]
    token_files.library_encoder.cache_clear()
