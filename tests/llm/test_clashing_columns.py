"""Extra columns with the operators' private names, odd signs and new columns' names pass through or give way."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from tidewater.llm import decontaminate, kn_quality, lattice, licenses, mixing, ngram_join, pii, spelling, token_counts
from tidewater.llm.common import all_but, free_names
from tidewater.llm.queries import BPE, PIECES, tokenizer_path

CLASHING = ["__key", "__places", "__gaps", "__new", "__bare", "__lang", "__mean", "__limit", "__SURPRISE", "__judged", "__gone_id", "__gone_tie", "__tie", "__decoded", "pieces",
            "n_pieces", "lossless", "key", "id", "tie", "digest", "node", "words", "with space", "a.b", "tick`ed", "n_replaced"]
TEXTS = ["Mrs. Anna Smith wrote to ann@example.com.", "one two three four five six seven", "one two three four five six seven", None, "", "Released under the MIT license."]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", len(t or ""), *(f"{c}{i}" for c in CLASHING)) for i, t in enumerate(TEXTS)]
    # one sort of extra column more: a number
    names = ", ".join("`" + c.replace("`", "``") + "` string" for c in CLASHING)
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars int, {names}")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, 1, 0, "x") for i in range(len(TEXTS))], "doc_id long, quality int, toxic int, __order string")


def extras(frame, gone=()):
    """doc_id -> values of the extra columns (without those that gave way)."""
    at = [frame.columns.index(c) for c in CLASHING if c not in gone]
    return {r[0]: [r[i] for i in at] for r in frame.collect()}


def want(ids, gone=()):
    return {i: [f"{c}{i}" for c in CLASHING if c not in gone] for i in ids}


def test_free_names():
    assert free_names(["__A", "__a_"], "__a", "__b", "__b") == ["__a__", "__b", "__b_"]


def test_quality(docs, labels):
    assert extras(kn_quality.keep_good(docs, labels)) == want(range(6))
    judged = kn_quality.judge(docs, labels)
    assert judged.columns == [*all_but(docs, "__judged"), "__judged"] and all(r["__judged"].kept for r in judged.collect())


def test_near_duplicates(docs):
    out = ngram_join.keep_one(docs)
    assert out.columns == docs.columns and extras(out) == want([0, 1, 3, 4, 5])


def test_decontamination(spark, docs):
    bench = spark.createDataFrame([("q", "released under the MIT license")], "item_id string, text string")
    assert extras(decontaminate.drop_contaminated(docs, bench)) == want(range(5))


def test_surrogates(docs):
    assert extras(pii.pseudonymise(docs, "k")) == want(range(6))
    out = pii.pseudonymise(docs, "k", count_as="n_replaced")
    assert extras(out, ["n_replaced"]) == want(range(6), ["n_replaced"])
    assert {r.doc_id: r.n_replaced for r in out.collect()} == {0: 2, 1: 0, 2: 0, 3: 0, 4: 0, 5: 0}


def test_pieces(docs):
    model = tokenizer_path(PIECES)
    out = lattice.encode(docs, model, decoded="__decoded")
    assert extras(out, ["pieces", "__decoded"]) == want(range(6), ["pieces", "__decoded"])
    back = lattice.decode(out, model, into="key")
    assert {r.doc_id: r.key for r in back.collect()} == {i: t or "" for i, t in enumerate(TEXTS)}


def test_row_operators(docs):
    for out in (licenses.license_scan(docs), token_counts.token_counts(docs, tokenizer_path(BPE)), mixing.mix(docs)):
        assert sorted(r.doc_id for r in out.collect()) == list(range(6))
    assert spelling.variants(docs).collect() == []


def test_stages(spark, tmp_path, docs, labels):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([("q", "released under the MIT license")], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = docs
    for _, step in pipeline.STAGES[:-1]:
        kept = step(spark, kept, str(tmp_path))
        assert kept.columns == docs.columns
    new = ["pieces", "n_pieces", "lossless"]
    last = pipeline.STAGES[-1][1](spark, kept, str(tmp_path))
    assert last.columns == [*all_but(docs, *new), *new]
    assert extras(last, new) == want([0, 1, 3, 4], new)
    assert last.where(~F.col("lossless")).count() == 0
