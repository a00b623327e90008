"""The Kneser-Ney model is fitted on all trusted documents."""

from pyspark.sql import functions as F

from tidewater.llm import kn_quality as K

LABELS = "doc_id long, quality int, toxic int"


def test_all_trusted_documents_take_part(spark):
    labels = spark.range(43_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    docs = labels.select("doc_id", F.when(F.col("doc_id") < 42_000, "en").when(F.col("doc_id") < 42_050, "el").alias("lang"))
    got = {(r.lang, r.held_out): r.n for r in K.trusted_sample(labels, docs=docs).groupBy("lang", "held_out").agg(F.count("*").alias("n")).collect()}
    assert got["en", True] + got["en", False] == 42_000 and abs(got["en", True] - 8_400) < 500
    assert got["el", True] == K.MIN_HELD_OUT and got["el", False] == 50 - K.MIN_HELD_OUT
    assert got[None, True] == 190 and got[None, False] == 760


def test_judging_asks_for_all_of_them(spark, monkeypatch):
    asked = []
    real = K.trusted_sample
    monkeypatch.setattr(K, "trusted_sample", lambda labels, most, docs: asked.append(most) or real(labels, most, docs))
    docs = spark.createDataFrame([(i, "ab" * (i % 9 + 1), "en") for i in range(60)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(50)], LABELS)
    assert K.judge(docs, labels).count() == 60 and asked == [None]


def test_trusted_texts_are_not_shuffled(spark, monkeypatch):
    plans = {}
    real = K.stage

    def seen(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return real(df, name)

    monkeypatch.setattr(K, "stage", seen)
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as at large sizes
    try:
        docs = spark.createDataFrame([(i, "ab" * (i % 9 + 1), "en") for i in range(60)], "doc_id long, text string, lang string")
        labels = spark.createDataFrame([(i, 1, 0) for i in range(50)], LABELS)
        assert K.judge(docs, labels).count() == 60
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
    assert "Exchange" in plans["trusted"] and "Exchange" not in plans["trusted-texts"] and "Join" not in plans["trusted-texts"]


def test_trusted_texts_against_a_plain_join(spark):
    rows = [(i % 200 if i % 11 else None, None if i % 7 == 0 else f"text {i}", ["en", "", None][i % 3]) for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")  # ids repeat under several languages
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(180)], LABELS)
    sample = K.trusted_sample(labels, None, docs)
    held = {(r.doc_id, r.lang): r.held_out for r in sample.collect()}
    want = [(lang, text, held[i, lang]) for i, text, lang in rows if (i, lang) in held]
    assert {i for i, _ in held} == {i for i, *_ in rows if i is not None and i < 180 and i % 4} and len(set(held.values())) == 2
    assert sorted(map(repr, map(tuple, K.trusted_texts(docs, sample).collect()))) == sorted(map(repr, want))
