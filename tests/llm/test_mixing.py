"""The mix against plain targets, balance of its totals, and expectations over seeds."""

import random
import re
from collections import Counter, defaultdict

import pytest

from tidewater.llm import mixing

SF = "/root/testdata/sf0.001"


def plain_targets(rows):
    """Reshare the excess round by round."""
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    total, closed = 1.5 * sum(sizes.values()), set()
    while True:
        left = total - sum(2 * sizes[s] for s in closed)
        heavy = sum(weight[s] for s in order if s not in closed)
        target = {s: 2.0 * sizes[s] if s in closed else left * weight[s] / heavy for s in order}
        above = {s for s in order if s not in closed and target[s] >= 2 * sizes[s]}
        if not above or not sum(sizes.values()):
            return sizes, target if sum(sizes.values()) else dict.fromkeys(order, 0.0)
        closed |= above


def check(rows, got):
    sizes, targets = plain_targets(rows)
    size = lambda text: len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = Counter((k, size(t), sizes[s]) for k, t, s in rows)
    assert Counter((r.doc_id, r["size"], r.source_size) for r in got) == want
    assert all(r.taken == r.times * r["size"] and 0 <= r.times <= 2 for r in got)
    by_target = defaultdict(list)
    for s, t in targets.items():
        by_target[sizes[s], round(t, 6)].append(s)
    taken, most, docs = Counter(), Counter(), Counter()
    for r in got:
        key = (r.source_size, round(r.target, 6))
        assert key in by_target
        taken[key] += r.taken
        docs[key] += r.times
        most[key] = max(most[key], r["size"])
    for key, sources in by_target.items():
        if len(sources) == 1:  # one source has this target
            rate = key[1] / key[0] if key[0] else 0
            assert abs(taken[key] - key[1]) <= 2 * most[key] + 1e-6
            assert abs(docs[key] - rate * sum(1 for _, _, s in rows if s == sources[0])) <= 2 + 1e-6


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    got = mixing.mix(docs).collect()
    check(rows, got)
    again = mixing.mix(docs.repartition(13)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_odd_rows_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "DEAL", 50)
    rnd = random.Random(2)
    rows = [(k, "w " * rnd.choice([1, 2, 3, 40, 900]), rnd.choice(["hot"] * 5 + ["b", "é", "Z", "", None, "𐀀", "～"])) for k in range(1500)]
    rows += [(None, "same words here", "hot")] * 700 + [(7, "same", None)] * 120 + [(8, None, "empty"), (9, "", "empty"), (10, "\t\n\x0b\x0c\r ", "blank"), (11, "　\x1f ", "odd"), (12, "long " * 50_000, "b")]
    docs = spark.createDataFrame([(*r, 3, 1.0) for r in rows], "doc_id long, text string, source string, size int, p double").repartition(5)
    got = mixing.mix(docs, cell_units=200, block_units=60).collect()
    check(rows, got)
    assert Counter(map(tuple, got)) == Counter(map(tuple, mixing.mix(docs.repartition(2), cell_units=200, block_units=60).collect()))


def test_expectation_and_spread(spark):
    """Over many seeds each unit is taken about as often as its share says."""
    rnd, n, seeds = random.Random(4), 40, 400
    sizes, hits, totals = sorted((rnd.randrange(1, 200) for _ in range(n)), reverse=True), [0] * n, []
    for _ in range(seeds):
        p = [0.3] * n
        open_ = mixing.flight(sizes, p, [rnd.random() for _ in range(n)])
        assert len(open_) <= 2 and all(p[k] in (0.0, 1.0) for k in range(n) if k not in open_)
        assert abs(sum(p) - 0.3 * n) < 1e-6 and abs(sum(s * x for s, x in zip(sizes, p)) - 0.3 * sum(sizes)) < 1e-4
        hits = [h + x for h, x in zip(hits, p)]
        mixing.land(sizes, p, open_)
        totals.append(sum(s * x for s, x in zip(sizes, p)))
    assert all(abs(h / seeds - 0.3) < 0.12 for h in hits) and abs(sum(hits) / n / seeds - 0.3) < 0.01
    assert max(abs(t - 0.3 * sum(sizes)) for t in totals) <= 2 * max(sizes)
    equal = [0.5] * 9
    assert len(mixing.flight([7] * 9, equal, [rnd.random() for _ in range(9)])) <= 2


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "", "a"), (1, "", "a")]])
def test_no_words(spark, rows):
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert Counter((r.doc_id, r["size"], r.source_size, r.target, r.taken) for r in got) == Counter((k, 0, 0, 0.0, 0) for k, _, _ in rows)
