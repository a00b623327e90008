"""The Jaccard join and connected components against brute force."""

import random
import re

import numpy as np
import pytest

from tidewater.llm import ngram_join as J
from tidewater.llm.components import connected_components

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, class_id string, KEPT int"


def grams(text):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    """(id, links, least id) of rows, a null id sorting last."""
    sets, n = [grams(t) for _, t in rows], len(rows)
    links, root = [0] * n, list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(n):
        for b in range(a + 1, n):
            shared = len(sets[a] & sets[b])
            if shared and shared / len(sets[a] | sets[b]) >= 0.8:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    least = {}
    for a in range(n):
        least[find(a)] = min(least.get(find(a), (True, 0)), (rows[a][0] is None, rows[a][0] or 0))
    out = [(rows[a][0], links[a], None if (w := least[find(a)] if sets[a] else (rows[a][0] is None, rows[a][0] or 0))[0] else w[1]) for a in range(n)]
    return sorted(out, key=str)


def run(spark, rows):
    out = J.jaccard_classes(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)).collect()
    return sorted(((r.doc_id, r.n_links, r.class_id) for r in out), key=str)


def corpus(seed=3):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 6))) for _ in range(400)]
    rows = []
    for group in range(12):
        base = rng.choices(words, k=rng.randint(3, 160))
        for copy in range(rng.choice([1, 1, 2, 6, 14])):
            text = [rng.choice(words) if copy and rng.random() < 0.008 * (group % 4) else w for w in base]
            rows.append((len(rows) * 7 % 1009, rng.choice([" ", ", ", "\n"]).join(text).title() if copy % 2 else " ".join(text)))
    return rows


@pytest.mark.parametrize("tile, dense", [(2048, 32), (3, 32), (2048, 2)])
def test_against_brute_force(spark, monkeypatch, tile, dense):
    monkeypatch.setattr(J, "TILE_DOCS", tile)
    monkeypatch.setattr(J, "DENSE_FROM", dense)
    rows = corpus()
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, "!!! --"), (4, "one two three"), (5, "One, two; three."), (6, "one two"), (7, long), (8, long + " more"), (9, "a b c d e"),
            (None, "a b c d e"), (11, "a b c d e f"), (12, "é è"), (12, "é è"), (13, "一 二"), (1, None)]
    assert run(spark, rows) == brute(rows)
    assert J.jaccard_classes(spark.createDataFrame([], SCHEMA)).collect() == []


def test_equal_sets_only(spark):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (3, "a b c d e f g"), (4, "a, b c d e f!")]
    out = J.jaccard_classes(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA), threshold=1.0).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in out) == [(1, 1, 2), (2, 1, 2), (3, 3, 0), (4, 1, 2)]


def test_keep_one_of_each_class(spark):
    rows = [(5, "one two three", "a", 1), (4, "One two three!", "b", 2), (4, "One two three!", "b", 2), (6, "other words here", None, None), (7, None, "c", 1), (None, "six seven", "d", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = J.keep_one(docs)
    assert out.schema == docs.schema
    assert sorted(map(tuple, out.collect()), key=str) == sorted([rows[1], rows[3], rows[4], rows[5]], key=str)


def test_shared_counts_in_tiles():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50))).astype(np.uint64) for _ in range(40)]
    want = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
    every = np.arange(40)
    got = J.shared_counts(sets, every, every)
    assert (got == want - np.diag(want.diagonal())).all()
    left, right = every[:17], every[17:]
    assert (J.shared_counts(sets, left, right) == want[:17, 17:]).all()


def test_missed_links():
    assert J.missed_links(0, 0, 32) == 31 / 64  # without links nothing is known
    assert J.missed_links(9, 19, 32) == 31 / 32 * 100 / 40
    assert J.missed_links(0, 1000, 32) < 0.0005


def test_every_pair_is_new_once():
    """Over all lengths and trees, a pair is new exactly once if it shares a node."""
    rng = np.random.default_rng(1)
    labels = rng.integers(0, 2, (60, 6, 5)).astype(np.uint16)
    every, times = np.arange(60), np.zeros((60, 60), int)
    for depth in range(5, 2, -1):
        for tree in range(6):
            times += J.new_pairs(labels, every, every, tree, depth)
    shared = (labels[:, None, :, :3] == labels[None, :, :, :3]).all(3).any(2)
    assert (times == shared).all() and 0 < shared.mean() < 1
    pairs = np.argwhere(np.triu(shared, 1))
    meets = (labels[pairs[:, 0], :, :3] == labels[pairs[:, 1], :, :3]).all(2).sum(1)
    assert J.tally(labels, pairs, range(3, 5))[:3] == [len(pairs), (meets == 1).sum(), (meets == 2).sum()]


def staged(monkeypatch):
    """(name, rows) of each staged table, in order."""
    seen, stage = [], J.stage

    def counted(df, name):
        out = stage(df, name)
        seen.append((name, out.count()))
        return out

    monkeypatch.setattr(J, "stage", counted)
    return seen


def changed(rng, text, share):
    return " ".join(f"x{rng.random()}".replace(".", "") if rng.random() < share else w for w in text.split())


def test_recall_of_planted_pairs_at_the_threshold(spark):
    """400 pairs of a similarity of 0.81."""
    rows = []
    for i in range(400):
        words = [f"w{i}x{k}" for k in range(100)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join([*words[:90], *(f"u{i}x{k}" for k in range(10))]))]
    near = {len(grams(a) & grams(b)) / len(grams(a) | grams(b)) for (_, a), (_, b) in zip(rows[::2], rows[1::2])}
    assert near == {86 / 106} and 0.8 <= 86 / 106 < 0.82
    assert sum(n for _, n, _ in run(spark, rows)) / 2 >= 0.99 * 400


def test_rounds_end_when_the_target_is_shown(spark, monkeypatch):
    """Many links that meet in several trees end the rounds before the floor; a
    few links never do."""
    rng, rows = random.Random(2), []
    for i in range(600):
        words = [f"w{i}x{k}" for k in range(50)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[:-1] + ["z"] * 3))]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    seen = staged(monkeypatch)
    assert sum(r.n_links for r in J.jaccard_classes(docs, threshold=0.9, target=0.99).collect()) == 1200
    early = sum(name == "verified" for name, _ in seen)
    seen.clear()
    J.jaccard_classes(docs.limit(20), threshold=0.9, target=0.99).collect()
    assert early < sum(name == "verified" for name, _ in seen) == J.MAX_DEPTH - J.MIN_DEPTH + 1


def test_templates_are_not_chained(spark, monkeypatch):
    """Pages of one template, none alike enough: nodes chain most of them, yet
    the sets moved to be verified are few a page, at either size."""
    share = {}
    for n in (300, 900):
        rng = random.Random(4)
        words = [f"w{k}" for k in range(300)]
        rows = [(i, changed(rng, " ".join(words), 0.05)) for i in range(n)]
        with monkeypatch.context() as patch:
            seen = staged(patch)
            assert all(links == 0 and i == least for i, links, least in run(spark, rows))
            share[n] = sum(c for name, c in seen if name == "active") / n
            assert max(c for name, c in seen if name == "active") <= J.TREES * n
    assert share[900] <= J.TREES * (J.MAX_DEPTH - J.MIN_DEPTH + 1)


def test_components_of_paths_stars_and_rings(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(999 - i, 200 + i) for i in range(20)] + [(200 + i, 201 + i) for i in range(19)]
    edges += [(3000 + i, 3000 + (i + 1) % 9) for i in range(9)] + [(7, 7), (None, 4), (1, 0)]
    rng.shuffle(edges)
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
