"""The pipeline's stages against plain versions, each on its own input."""

import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from adresponse.llm import pii, quality
from adresponse.llm.store import keep
from test_operators import CLASHES, SF, awkward, check_packing, documents, exact_groups

STAGES = dict(corpus_pipeline.STAGES)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_stages_take_effect_in_order(spark):
    docs, columns = documents(spark), documents(spark).columns
    assert list(STAGES) == ["quality", "near_dup", "decontamination", "pii", "packing"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    # quality: what the classifier rejects goes, nothing else
    good = keep(STAGES["quality"](spark, docs, SF), "t")
    bad = {r.doc_id for r in quality.score_documents(docs, labels).where("predicted = 0").collect()}
    assert good.columns == columns and rows_of(good) == rows_of(docs.where(~F.col("doc_id").isin(*bad or [-1])))
    # near duplicates: the smallest document of each exact group stays
    single = keep(STAGES["near_dup"](spark, good, SF), "t")
    group, _ = exact_groups([(r.doc_id, r.text) for r in good.collect()], 5, 4, 5)
    assert single.columns == columns and rows_of(single) == rows_of(good.where(F.col("doc_id").isin(*{g for g in group.values()})))
    # decontamination: documents that hold a passage go, documents without a word triple of any item stay
    clean = keep(STAGES["decontamination"](spark, single, SF), "t")
    flat = lambda t: re.sub(r"[!-/:-@\[-`{-~]", " ", (t or "").lower()).split()
    items = [flat(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    triples = {tuple(w[i : i + 3]) for w in items for i in range(len(w) - 2)}
    left = {r.doc_id for r in clean.collect()}
    for r in single.collect():
        w = flat(r.text)
        joined = f" {' '.join(w)} "
        if any(f" {' '.join(i)} " in joined for i in items):
            assert r.doc_id not in left
        elif not any(tuple(w[i : i + 3]) in triples for i in range(len(w) - 2)):
            assert r.doc_id in left
    # personal data: masked in place
    masked = keep(STAGES["pii"](spark, clean, SF), "t")
    assert masked.columns == columns and masked.count() == clean.count()
    before = {r.doc_id: r.text for r in clean.collect()}
    for r in masked.collect():
        assert r.text == pii.mask(before[r.doc_id]) and r.n_chars == len(r.text) and not pii.find(r.text)[0]
    # packing: each document, whole
    packed = STAGES["packing"](spark, masked, SF).collect()
    assert {r.doc_id for r in packed} == left
    check_packing(packed)


def test_awkward_documents_pass_every_stage(spark):
    docs = awkward(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and set(CLASHES) <= set(out.columns)
        docs = keep(out, "t")
    assert STAGES["packing"](spark, docs, SF).count() > 0


@pytest.mark.parametrize("name", list(STAGES))
def test_no_documents(spark, name):
    assert STAGES[name](spark, documents(spark).limit(0), SF).count() == 0


def test_run(spark):
    check_packing(corpus_pipeline.run(spark, SF).collect())
