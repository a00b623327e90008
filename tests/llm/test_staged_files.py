"""Narrow staged tables have few files, however many shuffle partitions there are."""

import os
import random
from contextlib import contextmanager

import pytest

from tidewater.llm import kn_quality, ngram_join, pii
from tidewater.llm.common import n_files, stage
from tidewater.sources.publish import shared_dir

@contextmanager
def many_partitions(spark):
    """As on a large table: each shuffle has many more partitions than the session has cores."""
    n = 6 * spark.sparkContext.defaultParallelism
    wide = {"spark.sql.shuffle.partitions": str(n), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in wide}
    for k, v in wide.items():
        spark.conf.set(k, v)
    try:
        yield n
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def staged(spark):
    """The number of files in each folder below the shared one."""
    top = shared_dir(spark).removeprefix("file://").removeprefix("file:")
    return {x: sum(f.startswith("part-") for f in os.listdir(f"{top}/{x}")) for x in os.listdir(top) if os.path.isdir(f"{top}/{x}")}


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(rng.choices(words, k=40)) for _ in range(250)]
    texts += [t + " end" for t in texts[:120]] + [f"mail a{i}.b@x{i}.org now" for i in range(150)]
    return spark.createDataFrame([(i, "en", t) for i, t in enumerate(texts)], "doc_id long, lang string, text string")


@pytest.mark.parametrize("dealt", [False, True])
def test_all_rows_in_few_files(spark, dealt):
    with many_partitions(spark) as n:
        most = n_files(spark)
        assert most < n
        table = stage(spark.range(3000).groupBy("id").count(), "few", narrow=True, dealt=dealt)
        assert 1 < len(table.inputFiles()) <= most
        assert sorted(r["id"] for r in table.collect()) == list(range(3000))


def test_more_shuffle_partitions_give_more_files(spark):
    with many_partitions(spark):
        few = n_files(spark)
        spark.conf.set("spark.sql.shuffle.partitions", str(16 * few * 10))
        assert n_files(spark) == 10 * few


@pytest.mark.parametrize("name, run", [
    ("classes verified", lambda docs, labels: ngram_join.keep_one(docs)),
    ("trusted kn-counts kn-grams kn-probabilities", lambda docs, labels: kn_quality.keep_good(docs, labels)),
    ("mentions surrogates", lambda docs, labels: pii.pseudonymise(docs, "key")),
])
def test_stages_of_the_pipeline_write_few_files(spark, docs, name, run):
    labels = docs.selectExpr("doc_id", "1 as quality", "0 as toxic")
    before = staged(spark)
    with many_partitions(spark):
        run(docs, labels).count()
        new = {k: n for k, n in staged(spark).items() if k not in before}
        for kind in name.split():
            mine = [n for k, n in new.items() if k.rsplit("-", 1)[0] == kind]
            assert mine and max(mine) <= n_files(spark), (kind, mine)
