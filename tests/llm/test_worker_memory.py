"""What a task has used does not stay with its worker, and a class is joined once."""

import re

import pyarrow as pa

from tidewater.llm import lattice, ngram_join
from tidewater.llm.queries import PIECES, tokenizer_path


def test_no_memo_stays_with_a_worker(spark):
    texts = [(i, f"words of text {i} and the number {i * 7919} " * 20) for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(8)
    assert lattice.encode(docs, tokenizer_path(PIECES)).where("size(pieces) > 0").count() == 400

    def held(batches):
        from tidewater.llm import common

        for _ in batches:
            pass
        nodes = [x.nodes for x in common._kept.values() if isinstance(x, lattice.Lattices)]
        yield pa.RecordBatch.from_arrays([pa.array([len(nodes)], pa.int64()), pa.array([sum(nodes)], pa.int64())], ["memos", "nodes"])

    rows = spark.range(8).repartition(8).mapInArrow(held, "memos long, nodes long").collect()
    assert sum(r["memos"] for r in rows) > 0  # some workers live on
    assert sum(r["nodes"] for r in rows) == 0


def test_batches_leave_in_bounded_parts(spark):
    """Rows of more bytes than ``OUT_BYTES`` leave in several parts, a longer text alone, none lost."""
    long = "a word " * (lattice.OUT_BYTES // 5)
    texts = [(0, "x"), (1, long), (2, None), (3, ""), (4, "y z"), (5, long + "end")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    out = lattice.encode(docs, tokenizer_path(PIECES), decoded="back").orderBy("doc_id").collect()
    assert [(r["doc_id"], r["back"]) for r in out] == [(i, t or "") for i, t in texts]


def test_a_class_is_joined_once_with_all_its_places(spark):
    places = spark.createDataFrame([(d, t, f"{d}.{t}") for d in range(5) for t in range(32)], "digest long, tree int, low string")
    classes = spark.createDataFrame([(d, f"l{d}") for d in range(4)], "digest long, labels string")
    got = ngram_join._beside(places, classes)
    assert sorted(map(tuple, got.select("digest", "tree", "low", "labels").collect())) == sorted(map(tuple, places.join(classes, "digest").collect()))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Join Inner"):]
    assert plan.index("Generate") < plan.index("Join Inner") and re.search(r"Aggregate \[digest", below)
