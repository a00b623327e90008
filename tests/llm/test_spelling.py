"""Spelling variants against counting, all pairs and following forms one by one."""

import random
import re
import zlib
from collections import Counter

import pytest

from tidewater.llm import spelling

SF = "/root/testdata/sf0.001"


def near(a: str, b: str) -> bool:
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_counts(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(x.lower() if x.isascii() else x for x in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def plain(counts):
    out, long = {}, [w for w in counts if len(w) > 1000]
    buckets = {}  # words with a neighbour share one of these; only they are compared
    for w in counts.keys() - set(long):
        for i in range(len(w)):
            buckets.setdefault(w[:i] + "*" + w[i + 1 :], []).append(w)
        for i in range(len(w) + 1):
            buckets.setdefault(w[:i] + "*" + w[i:], []).append(w)
    friends = {w: {x for x in long if w in long and near(w, x)} for w in counts}
    for members in buckets.values():
        for w in members:
            friends[w].update(x for x in members if near(w, x))
    for w, n in counts.items():
        best = min(friends[w], key=lambda x: (-counts[x], x), default=None)
        out[w] = (best if best is not None and counts[best] >= 2 * n else None, n, len(friends[w]))
    rows = Counter()
    for w, (form, n, k) in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        rows[w, form, root, n, k, counts[form] if form else None] += 1
    return rows


def found(table, long_from=spelling.LONG_FROM):
    """word -> (number of near words, the best of them)."""
    words = spelling.numbered(table)
    name = {r.id: r.word for r in words.collect()}
    assert [name[k] for k in sorted(name)] == sorted(name.values(), key=lambda w: w.encode())
    near = {r.id: (r.n_near, name[r.best.id]) for r in spelling.near_words(words, long_from).collect()}
    return {w: near.get(k, (0, None)) for k, w in name.items()}


def got(df):
    return Counter((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = plain(plain_counts([(r.doc_id, r.text) for r in docs.collect()]))
    assert any(r[1] for r in want) and got(spelling.variants(docs)) == want


def test_odd_texts_ties_and_slips(spark):
    rnd = random.Random(5)
    words = ["banana", "bananaa", "banan", "banaana", "bannana", "aaaaa", "aaaaaa", "aaaaaaa", "ÀÉîøü", "àéîøü", "Straße", "strasse", "STRASE", "colour", "color", "colours", "cÖlor"]
    rows = [(k, " ".join(rnd.choices(words, weights=range(1, 1 + len(words)), k=300))) for k in range(60)]
    rows += [(None, "Word wörds words0words w0rds"), (None, None), (7, ""), (7, "colour×colour÷colour 李娜 x́colour"), (7, "banana " * 40_000), (7, " ".join(["a" * 30_000] * 4 + ["a" * 29_999 + "b", "a" * 29_999] * 9))]
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, n int, word string").repartition(5)
    assert got(spelling.variants(docs)) == plain(plain_counts(rows))


def test_chain_of_forms(spark):
    """Counts that double along a chain of near words lead to one root."""
    chain = ["aaaaa" + "b" * k for k in range(9)]
    words = {w: 3 * 2**k for k, w in enumerate(chain)} | {"zzzzz": 3, "zzzzy": 6, "zzzzx": 6}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    near_by = found(table)
    assert near_by["aaaaa"] == (1, "aaaaab") and near_by["zzzzz"] == (2, "zzzzx") and near_by["zzzzx"] == (2, "zzzzy")
    forms = table.select("word").join(spark.createDataFrame(list(zip(chain, chain[1:])), "word string, form string"), "word", "left")
    roots = {r.word: r.root for r in spelling.with_roots(forms).collect()}
    assert roots == {w: chain[-1] if w in chain else w for w in words}


def test_random_vocabularies(spark):
    rnd = random.Random(11)
    words = {}
    for _ in range(1500):
        words["".join(rnd.choices("abé", k=rnd.randrange(5, 9)))] = rnd.choice([3, 3, 5, 9, 40])
    table = spark.createDataFrame(list(words.items()), "word string, n long").repartition(7)
    want = {(r[0], r[4]) for r in plain(words)}
    assert {(w, n) for w, (n, _) in found(table).items()} == want
    # Rotations as hashes, for all words or the longer ones, give the same.
    for long_from in (0, 6, 7):
        assert {(w, n) for w, (n, _) in found(table, long_from).items()} == want


def test_no_rows_and_bounds(spark):
    assert spelling.variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    with pytest.raises(ValueError):
        spelling.variants(spark.createDataFrame([], "doc_id long, text string"), ratio=1)
    plan = spelling.near_words(spelling.numbered(spark.createDataFrame([("aaaaa", 3)], "word string, n long")))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Cartesian", "NestedLoop"))
