"""Benchmark contamination against brute force over words."""

import random
import re

import pytest

from tidewater.llm import decontaminate as B

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS, ITEMS = "doc_id long, text string, items string, n_hit int", "item_id long, text string, doc_id int"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    windows = []
    for item, text in items:
        w = words(text)
        windows += [(item, tuple(w[i : i + 10])) for i in range(max(1, len(w) - 9))] if w else []
    out = []
    for doc, text in docs:
        w, hit, names = words(text), set(), set()
        for item, p in windows:
            for i in range(len(w) - len(p) + 1):
                if tuple(w[i : i + len(p)]) == p:
                    hit.update(range(i, i + len(p)))
                    names |= {str(item)} if item is not None else set()
        out.append((doc, len(w), len(hit), ",".join(sorted(names)), bool(hit)))
    return sorted(out, key=str)


def run(spark, docs, items, **how):
    d, b = spark.createDataFrame([(*r, "x", 1) for r in docs], DOCS), spark.createDataFrame([(*r, 1) for r in items], ITEMS)
    out = B.contamination(d.repartition(3), b, **how).collect()
    return sorted(((r.doc_id, r.n_words, r.n_hit, ",".join(r["items"]), r.contaminated) for r in out), key=str), out


@pytest.mark.parametrize("part_bytes", [64 << 20, 300])
def test_against_brute_force(spark, part_bytes):
    rng = random.Random(2)
    vocabulary = ["the", "of", "Étude", "naïve", "x1", "B", "9", "end"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([3, 9, 10, 11, 30])))) for i in range(12)]
    items += [(12, items[0][1]), (12, None), (13, ""), (14, "?!"), (None, "only me here"), (0, items[0][1])]
    docs = [(i, ", ".join(rng.choices(vocabulary, k=rng.randint(0, 40))) + ("; " + (rng.choice(items)[1] or "")) * (i % 3 > 0)) for i in range(60)]
    docs += [(100, "Only, ME here"), (None, "only me"), (100, "Only, ME here"), (101, "word " * 20_000 + items[3][1])]
    assert run(spark, docs, items, part_bytes=part_bytes)[0] == brute(docs, items)


def test_spans_point_into_the_original(spark):
    items = [(1, "alpha beta gamma")]
    _, out = run(spark, [(1, "¡Né! Alpha--beta\tGAMMA... alpha beta gamma; end")], items)
    text = "¡Né! Alpha--beta\tGAMMA... alpha beta gamma; end"
    assert [text[s.start : s.end] for s in out[0].spans] == ["Alpha--beta\tGAMMA... alpha beta gamma"]


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a b")])[1] == []
    assert run(spark, [(1, "a b"), (2, None)], [])[0] == [(1, 2, 0, "", False), (2, 0, 0, "", False)]


def test_drop_contaminated_passes_all_columns(spark):
    docs = spark.createDataFrame([(1, "x alpha beta", "k", 1), (2, "alpha", None, None), (3, None, "k", 2), (None, "beta alpha", "k", 3)], DOCS)
    out = B.drop_contaminated(docs, spark.createDataFrame([(1, "Alpha, beta", 1)], ITEMS))
    assert out.schema == docs.schema and sorted(r.n_hit or 0 for r in out.collect()) == [0, 2, 3]
