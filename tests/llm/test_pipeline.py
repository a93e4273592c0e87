import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from weftline.llm import bpe, mixing, quality

from .conftest import corpus
from .test_line_dedup import brute as lines_brute
from .test_minhash import brute as near_brute


@pytest.fixture(scope="module")
def stages(spark, docs, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    out, df = [docs], docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, df, "unused").write.parquet(str(folder / str(k)))
        df = spark.read.parquet(str(folder / str(k)))
        out.append(df)
    return out


def test_names_and_columns(stages, docs):
    assert len(corpus_pipeline.STAGES) == 5
    for df in stages[1:-1]:
        assert df.columns == docs.columns


def test_each_stage_on_its_own_input(stages):
    start, rules, lines, near, mixed, ids = stages
    kept = quality.apply_policy(quality.ledger(start), quality.STANDARD).where("kept").count()
    assert rules.count() == kept
    assert lines.count() == rules.count()
    want = lines_brute(rules)
    texts = sorted((str(r.doc_id), want[r.doc_id, r.text][2]) for r in rules.select("doc_id", "text").collect())
    assert sorted((str(r.doc_id), r.text) for r in lines.collect()) == texts
    assert all(r.n_chars == len(r.text) for r in lines.collect())
    comp = near_brute([(r.doc_id, r.text) for r in lines.select("doc_id", "text").collect()], 5)
    assert sorted(r.doc_id for r in near.where("doc_id IS NOT NULL").collect()) == sorted({i for i, c in comp.items() if i == c})
    copies = {r.doc_id: r.copies for r in mixing.plan_mix(near).where("doc_id IS NOT NULL").collect()}
    found = {r.doc_id: r.n for r in mixed.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert found == {i: n for i, n in copies.items() if n}
    codec = bpe.codec(public_tokenizers.path("word_bpe_49k.json"))
    texts = sorted(str(codec.encode(r.text)) for r in mixed.collect())
    assert texts == sorted(str(list(r.ids)) for r in ids.collect())


def test_empty(spark, empty):
    df = empty
    for _, stage in corpus_pipeline.STAGES:
        df = stage(spark, df, "unused")
    assert df.count() == 0
