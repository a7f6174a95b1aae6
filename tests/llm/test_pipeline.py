"""Each stage on what the one before kept, against a plain version."""

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from faregauge.llm import mixing, pii, toxicity
from test_near_dedup import brute_classes

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        path = f"{tmp_path}/{name}"
        stage(spark, docs, SF).write.parquet(path)
        out = spark.read.parquet(path)
        after = {r.doc_id: r for r in out.collect()}
        if name != "bpe":
            assert out.columns == COLUMNS and out.schema == docs.schema
        if name == "toxicity":
            model = toxicity.trained(docs, spark.read.parquet(f"{SF}/labels.parquet"))
            scores = toxicity.scores([r.text for r in before.values()], model)
            assert set(after) == {i for i, s in zip(before, scores) if s < 0.5}
        elif name == "near_dedup":
            numbers = sorted(before)
            roots = brute_classes([before[i].text for i in numbers])
            assert set(after) == {min(numbers[j] for j, q in enumerate(roots) if q == r) for r in set(roots)}
        elif name == "pii":
            model = pii.trained(docs)
            clean = pii.cleared([r.text for r in before.values()], model)
            assert {i: r.text for i, r in after.items()} == dict(zip(before, clean))
            assert all(r.n_chars == len(r.text) for r in after.values())
        elif name == "mixing":
            assert set(after) == {r.doc_id for r in mixing.mixed(docs).collect() if r.kept}
        else:
            library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
            assert set(after) == set(before)
            for i, r in after.items():
                assert r.ids == library.encode(before[i].text, add_special_tokens=False).ids
                assert r.text == before[i].text and r.n_tokens == len(r.ids)
        docs = out


def test_odd_rows_pass_all_stages(spark, make, tmp_path):
    rows = [(1, None), (None, ""), (2, "one two"), (2, "one two"), (3, "x " * 30_000), (4, "mail a@b.cc now")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, _near_rows int, ids int"
    docs = make([(i, t, None, None, None, 0.5, 1, 2) for i, t in rows], schema)
    for part in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, part, SF)
            rows_out = out.count()
            if name == "near_dedup" and rows_out:
                assert rows_out == len(set(brute_classes([r.text for r in part.collect()])))
            if name != "bpe":
                assert out.columns == docs.columns
                part = out
            np.testing.assert_equal(rows_out <= part.count(), True)
