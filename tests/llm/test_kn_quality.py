"""The Kneser-Ney model against a plain version; held-out accuracy."""

import collections
import math
import random

import pytest

from tidewater.llm import kn_quality as K

DOCS, LABELS = "doc_id long, text string, lang string, kept string, PERPLEXITY int", "doc_id long, quality int, toxic int, text string"
ORDER = 4


def plain_model(texts, order):
    counts = [collections.Counter() for _ in range(order + 1)]
    for t in texts:
        s = K.START * (order - 1) + t + K.END
        counts[order].update(s[i : i + order] for i in range(len(s) - order + 1))
    for n in range(order - 1, 0, -1):
        counts[n].update(g[1:] for g in counts[n + 1])
    discounts = [None] + [K.discounts(collections.Counter(min(v, 4) for v in counts[n].values())) for n in range(1, order + 1)]

    def p(gram):
        n = len(gram)
        lower = p(gram[1:]) if n > 1 else 1 / (len(counts[1]) + 1)
        followers = {g: c for g, c in counts[n].items() if g[:-1] == gram[:-1]}
        total = sum(followers.values())
        if not total:
            return lower
        d = lambda c: discounts[n][min(c, 3) - 1] if c else 0
        c = counts[n].get(gram, 0)
        return (c - d(c)) / total + sum(map(d, followers.values())) / total * lower

    return p


def test_probabilities_against_a_plain_model(spark):
    train = ["abab cab", "abba", "cab é", "", "a1 b2"]
    judged = ["abc", "zé a", "", "ab9"]
    folded = [t.encode().translate(K._DIGITS).decode() for t in train + judged]
    p = plain_model(folded[: len(train)], ORDER)
    model = K.train(spark.createDataFrame([(t,) for t in train], "text string"), ORDER)
    grams = K.distinct_grams(spark.createDataFrame([(t,) for t in train + judged], "text string"), ORDER)
    got = {r.gram: r.p for r in K.probabilities(grams, model).collect()}
    want = {s[i : i + ORDER] for t in folded for s in [K.START * (ORDER - 1) + t + K.END] for i in range(len(s) - ORDER + 1)}
    assert set(got) == want
    for g, v in got.items():
        assert v == pytest.approx(p(g), rel=1e-9)


def test_probabilities_sum_to_one():
    p = plain_model(["abab cab", "abba", "cab"], 3)
    # the characters of the model share all but the weight of an unknown one
    for context in ("ab", "zz", K.START * 2):
        known = sum(p(context + c) for c in "abc " + K.END)
        assert known + p(context + "?") == pytest.approx(1)


def test_surprise_of_documents_in_runs(spark, monkeypatch):
    monkeypatch.setattr(K, "RUN_CHARS", 7)  # long texts come in several runs
    train = ["abab cab", "abba cabba bab"]
    p = plain_model(train, ORDER)
    model = K.train(spark.createDataFrame([(t,) for t in train], "text string"), ORDER)
    docs = spark.createDataFrame([(1, "abba cab abba bab cab"), (2, None), (3, ""), (4, "é" * 20)], "doc_id long, text string")
    table = K.write_table(K.probabilities(K.distinct_grams(docs, ORDER), model), ORDER)
    for r in K.with_surprise(docs, table, ORDER).collect():
        s = K.START * (ORDER - 1) + (r.text or "") + K.END
        assert r.__places == len(r.text or "") + 1 if hasattr(r, "__places") else r["__places"] == len(r.text or "") + 1
        assert r["__surprise"] == pytest.approx(-sum(math.log(p(s[i : i + ORDER])) for i in range(len(s) - ORDER + 1)))


def corpus(n=700):
    rng = random.Random(9)
    words = {"en": ["the", "and", "ther", "tion", "ing", "shes", "on", "re"], "fr": ["le", "de", "eau", "eux", "é", "que", "tre"]}
    docs, labels = [], []
    for i in range(n):
        lang = rng.choice(["en", "en", "fr"])
        good = rng.random() < 0.8
        text = " ".join(rng.choice(words[lang]) for _ in range(rng.randint(2, 120)))
        if not good:
            text = rng.choice([text.upper() + "!!", "".join(rng.choices("|%$#&xqz ", k=200)), " ".join(w + "###" for w in text.split())])
        docs.append((i, text, lang, "x", 1))
        if i % 2:
            labels.append((i, int(good), 0, "x"))
    return docs, labels, {d[0]: None for d in docs}


def test_junk_goes_and_good_documents_stay(spark):
    docs, labels, _ = corpus()
    good = {i: q for i, q, *_ in labels}
    out = K.judge(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    kept = {r.doc_id: r["__judged"].kept for r in out}
    assert len(out) == len(docs)
    assert sum(kept[i] for i in good if good[i]) >= 0.97 * sum(good.values())
    long_junk = [i for i in good if not good[i] and len(docs[i][1]) > 100]
    assert sum(not kept[i] for i in long_junk) >= 0.95 * len(long_junk)


def test_odd_rows_pass_with_their_columns(spark):
    docs, labels, _ = corpus(200)
    docs += [(None, None, None, None, None), (5000, "", "xx", "y", 2), (5001, "the " * 30_000, "en", "y", 2), (0, docs[0][1], docs[0][2], "x", 1)]
    labels += [(None, 1, 0, "x"), (3, None, None, "x"), (1, 1, 0, "x")]
    frame = spark.createDataFrame(docs, DOCS)
    out = K.keep_good(frame, spark.createDataFrame(labels, LABELS))
    assert out.schema == frame.schema
    ids = [r.doc_id for r in out.collect()]
    assert None in ids and 5000 in ids and 5001 in ids


def test_without_trusted_documents_nothing_is_rejected(spark):
    docs = spark.createDataFrame([(1, "abc", "en", "x", 1), (2, None, None, None, None)], DOCS)
    assert K.keep_good(docs, spark.createDataFrame([(1, 0, 0, "x")], LABELS)).count() == 2
    assert K.keep_good(spark.createDataFrame([], DOCS), spark.createDataFrame([(1, 1, 0, "x")], LABELS)).count() == 0


def test_sample_is_bounded(spark):
    labels = spark.createDataFrame([(i, 1, 0, "x") for i in range(500)], LABELS)
    sample = K.trusted_sample(labels, 100).collect()
    assert len(sample) == 100 and 5 < sum(r.held_out for r in sample) < 50


def test_sample_is_bounded_in_each_language(spark):
    docs = spark.createDataFrame([(i, "", "en" if i < 470 else "el" if i < 490 else None, "x", 1) for i in range(500)], DOCS)
    labels = spark.createDataFrame([(i, 1, 0, "x") for i in range(500)], LABELS)
    sample = [r.doc_id for r in K.trusted_sample(labels, 100, docs).collect()]
    assert len(sample) == len(set(sample)) == 130 and set(range(470, 500)) <= set(sample)


def test_rare_and_missing_languages_are_not_judged_by_others(spark):
    docs, labels, _ = corpus()
    rng = random.Random(4)
    words = "και το να είναι που με για από στην θα".split()
    for i in range(1000, 1500):
        docs.append((i, " ".join(rng.choices(words, k=60)), "el" if i < 1100 else None if i < 1200 else "gr", "x", 1))
    labels += [(i, 1, 0, "x") for i in (*range(1000, 1010), *range(1100, 1110), *range(1200, 1260))]
    out = {r.doc_id: r["__judged"] for r in K.judge(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()}
    assert all(out[i].kept and out[i].score_limit is None for i in range(1000, 1200))
    # 60 trusted documents are enough for a limit of their own.
    assert sum(out[i].kept for i in range(1200, 1500)) >= 0.97 * 300 and all(out[i].score_limit for i in range(1200, 1500))


def test_toxic_documents_are_not_trusted(spark):
    docs, labels, _ = corpus()
    toxic, rng = {i for i, q, *_ in labels if q and i % 3 == 0}, random.Random(8)
    docs = [(i, " ".join(w for x in text.split() for w in (x, rng.choice(["vyxulp", "zogwug"]))) if i in toxic else text, *more) for i, text, *more in docs]
    labels = [(i, q, int(i in toxic), x) for i, q, _, x in labels] + [(next(i for i, q, *_ in labels if q and i not in toxic), 1, None, "x")]
    sample = {r.doc_id for r in K.trusted_sample(spark.createDataFrame(labels, LABELS)).collect()}
    assert sample == {i for i, q, *_ in labels if q} - toxic
    kept = {r.doc_id: r["__judged"].kept for r in K.judge(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()}
    assert sum(not kept[i] for i in toxic) >= 0.9 * len(toxic)
    assert sum(kept[i] for i in sample) >= 0.97 * len(sample)
