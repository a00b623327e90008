"""Quality classifier: an interpolated modified Kneser-Ney model of trusted text.

* Trusted texts are documents whose labels are all good and not toxic. All of them
  take part: a fifth of a language's (by hash of their id) is held out to calibrate its
  threshold, and ``MIN_HELD_OUT`` if half of them are as many; the model is fitted on
  the others. A caller may ask for fewer (``max_trusted`` in each language: those of
  least hash).
* N-grams are of characters (digits are folded to 0), with start and end marks.
  The highest order has counts, the lower orders count distinct characters to the
  left. Each order has three discounts from its counts of counts.
* Every distinct n-gram of the documents to be judged is gathered from all of
  them, and joined with the counts of n-grams and contexts order by order, in hash
  partitions, which gives its interpolated probability. The resulting table is
  written to the shared folder as shards of sorted hashes, which workers map into
  memory: nothing that grows with the corpus is broadcast, and no text is shuffled.
* A document's score is its mean surprise per character, drawn towards its
  language's mean by the weight of ``shrink`` characters, since a few characters
  prove little; its perplexity is reported as it is. A document is rejected if its
  score is above the ``quantile`` of held-out trusted documents of its language.
  Where they are too few to show that quantile, the threshold is at least three
  deviations above their mean. A language with fewer than ``MIN_HELD_OUT`` of them
  has no threshold, and its documents are all kept: another language's threshold
  says nothing about them.

Defined results: a null or empty text has only the end mark to predict; repeated
rows are judged alike; a null language is a language of its own; without trusted
documents nothing is rejected; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from tidewater.llm.common import all_but, free_names, lean, map_rows, mix64, narrowed, prepare, quoted, stage, utf8
from tidewater.llm.sorted_files import open_sorted, write_sorted

ORDER, HELD_OUT = 5, 5
QUANTILE, SHRINK, MIN_HELD_OUT = 0.995, 200, 20
#: Trusted documents of a language up to which the held out ones are counted off exactly.
RANKED = 2_000
#: Scores are compared in steps of this size, so that quantiles are exact on few values.
STEP = 0.001
START, END = "\x02", "\x03"
#: Characters that are worked on at once; distinct n-grams that a task remembers.
RUN_CHARS, REMEMBERED = 1 << 19, 2_000_000
_DIGITS = bytes.maketrans(b"123456789", b"000000000")
_FACTOR = 0x9E3779B97F4A7C15 | 1


def gram_hashes(codes: np.ndarray, order: int) -> np.ndarray:
    """64-bit hashes of all windows of ``order`` characters."""
    h = np.zeros(max(0, len(codes) - order + 1), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(order):
            h = h * np.uint64(_FACTOR) + codes[k : k + len(h)].astype(np.uint64) + np.uint64(1)
    return mix64(h)


def text_runs(column: pa.Array, order: int):
    """(text, codes, hashes, places, rows) of runs of texts: each window is one
    character or end mark in its context. A long text comes in several runs."""
    run, rows, size = [], [], 0

    def finish():
        text = "".join(run)
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        counts = np.fromiter(map(len, run), np.int64, len(run)) - order + 1
        starts = np.cumsum(counts + order - 1) - counts - order + 1
        places = np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        return text, gram_hashes(codes, order)[places], places, np.repeat(rows, counts)

    data, offsets = utf8(column)
    folded = data.tobytes().translate(_DIGITS)
    for i, (first, last) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        body = START * (order - 1) + folded[first:last].decode() + END
        for a in range(0, max(1, len(body) - order + 1), RUN_CHARS):
            piece = body[a : a + RUN_CHARS + order - 1]
            run.append(piece)
            rows.append(i)
            size += len(piece)
            if size >= RUN_CHARS:
                yield finish()
                run, rows, size = [], [], 0
    if run:
        yield finish()


def _distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes, where each stands first, and the number of each place's hash."""
    coded = pa.array(hashes).dictionary_encode()
    own, number = coded.dictionary.to_numpy(), coded.indices.to_numpy()
    first = np.empty(len(own), np.int64)
    first[number[::-1]] = np.arange(len(number))[::-1]
    return own, first, number


def gram_counts(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, c) of the column ``text``: counted in the tasks, then summed."""
    def count(batches):
        for batch in batches:
            for text, hashes, places, _ in text_runs(batch.column(0), order):
                own, first, number = _distinct(hashes)
                counts = np.bincount(number, minlength=len(own))
                grams = [text[k : k + order] for k in places[first].tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(grams, pa.string()), pa.array(counts)], ["gram", "c"])

    return texts.select("text").mapInArrow(lean(count), "gram string, c long").groupBy("gram").agg(F.sum("c").alias("c"))


def distinct_grams(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """The distinct n-grams of the column ``text``."""
    def gather(batches):
        seen = np.zeros(0, np.uint64)
        for batch in batches:
            for text, hashes, places, _ in text_runs(batch.column(0), order):
                own, first, _ = _distinct(hashes)
                at = np.minimum(np.searchsorted(seen, own), max(len(seen) - 1, 0))
                new = seen[at] != own if len(seen) else np.ones(len(own), bool)
                if new.any():
                    yield pa.RecordBatch.from_arrays([pa.array([text[k : k + order] for k in places[first[new]].tolist()], pa.string())], ["gram"])
                    seen = np.union1d(seen, own[new]) if len(seen) < REMEMBERED else np.sort(own)

    return texts.select("text").mapInArrow(lean(gather), "gram string").distinct()


def discounts(often: dict[int, int]) -> list[float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more, from the numbers
    of n-grams that occur once to four times. Where these are too odd for the
    formula (a discount below zero or above its count), the plain discount stands in."""
    n1, n2, n3, n4 = (max(1, often.get(k, 0)) for k in (1, 2, 3, 4))
    plain = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * plain * n2 / n1, 2 - 3 * plain * n3 / n2, 3 - 4 * plain * n4 / n3)
    return [min(d, k) if d > 0 else plain for k, d in enumerate(raw, 1)]


@dataclass
class Model:
    """Counts and contexts by order (index 0 is order 1), with their discounts."""

    order: int
    counts: list[DataFrame]
    contexts: list[DataFrame]
    discounts: list[list[float]]
    characters: int


def train(texts: DataFrame, order: int = ORDER) -> Model:
    """Fit the model on the column ``text``."""
    prepare(texts.sparkSession)
    counts = [stage(narrowed(gram_counts(texts, order)), "kn-counts")]
    for n in range(order - 1, 0, -1):
        counts.insert(0, stage(narrowed(counts[0].groupBy(F.substring("gram", 2, n).alias("gram")).agg(F.count("*").alias("c"))), "kn-counts"))
    found, contexts = [], []
    for n, table in enumerate(counts, 1):
        often = table.groupBy(F.least("c", F.lit(4)).alias("k")).count().collect()  # four rows
        d = discounts({row["k"]: row["count"] for row in often})
        found.append(d)
        saved = F.sum(F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2]))
        contexts.append(table.groupBy(F.substring("gram", 1, n - 1).alias("context")).agg(F.sum("c").alias("total"), saved.alias("saved")))
    return Model(order, counts, contexts, found, counts[0].count())


def probabilities(grams: DataFrame, model: Model) -> DataFrame:
    """(gram, p): interpolated probability of each n-gram's last character."""
    lower = None
    for n in range(1, model.order + 1):
        own = grams if n == model.order else grams.select(F.substring("gram", model.order - n + 1, n).alias("gram")).distinct()
        d, c = model.discounts[n - 1], F.coalesce("c", F.lit(0))
        taken = F.when(c == 0, 0.0).when(c == 1, d[0]).when(c == 2, d[1]).otherwise(d[2])
        rows = own.join(model.counts[n - 1], "gram", "left").withColumn("context", F.substring("gram", 1, n - 1)).join(model.contexts[n - 1], "context", "left")
        if n == 1:
            rows = rows.withColumn("lower", F.lit(1.0 / (model.characters + 1)))
        else:
            rows = rows.withColumn("suffix", F.substring("gram", 2, n - 1)).join(lower.select(F.col("gram").alias("suffix"), F.col("p").alias("lower")), "suffix")
        p = F.when(F.col("total").isNull(), F.col("lower")).otherwise((c - taken) / F.col("total") + F.col("saved") / F.col("total") * F.col("lower"))
        lower = stage(narrowed(rows.select("gram", p.alias("p"))), "kn-probabilities")
    return lower


def write_table(table: DataFrame, order: int) -> tuple[str, tuple[str, ...]]:
    """Write (gram, p) as a sorted table of hashes and log probabilities."""
    def hashed(batches):
        for batch in batches:
            codes = np.frombuffer("".join(batch.column(0).to_pylist()).encode("utf-32-le"), np.uint32)
            yield pa.RecordBatch.from_arrays([pa.array(gram_hashes(codes, order)[::order].view(np.int64)), pa.array(np.log(batch.column(1).to_numpy()))], ["key", "value"])

    return write_sorted(table.select("gram", "p").mapInArrow(lean(hashed), "key long, value double"))


def with_surprise(docs: DataFrame, table: tuple, order: int, text_column: str = "text", into: tuple[str, str] = ("__surprise", "__places")) -> DataFrame:
    """``docs`` with two columns more, named ``into``: the surprise (minus the sum
    of log probabilities) and the number of places."""
    at, columns = docs.columns.index(text_column), [*docs.columns, *into]

    def score(batches):
        known = open_sorted(*table)
        for batch in batches:
            surprise, places = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for _, hashes, _, rows in text_runs(batch.column(at), order):
                there, log_p = known.find(hashes)
                if not there.all():
                    raise ValueError("an n-gram is missing from the table: the documents have changed since it was made")
                surprise -= np.bincount(rows, log_p, batch.num_rows)
                places += np.bincount(rows, minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(surprise), pa.array(places)], columns)

    return map_rows(docs, score, StructType([*docs.schema.fields, StructField(into[0], DoubleType()), StructField(into[1], LongType())]))


def _score(mean, surprise: str = "__surprise", places: str = "__places") -> F.Column:
    return F.round((F.col(surprise) + SHRINK * mean) / (F.col(places) + SHRINK) / STEP).cast("long")


def trusted_sample(labels: DataFrame, max_trusted: int | None = None, docs: DataFrame | None = None) -> DataFrame:
    """(doc_id, lang, held_out) of all documents whose labels are all of quality 1 and not
    toxic, or with ``max_trusted`` of at most so many, those of least hash, in each language
    of ``docs`` (without it, in all)."""
    good = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic")).where("quality = 1 and coalesce(toxic, 0) = 0").select("doc_id")
    if docs is None:
        good = good.withColumn("lang", F.lit(None).cast("string"))
    else:
        good = docs.select("doc_id", "lang").join(good, "doc_id").distinct()
    good = stage(narrowed(good.withColumn("__order", F.xxhash64("doc_id", F.lit("trusted")))), "trusted")
    if max_trusted is None:
        n = good.groupBy(F.col("lang").alias("__lang")).agg(F.count("*").alias("__n"))  # one row a language
        counted = good.join(F.broadcast(n), F.col("lang").eqNullSafe(F.col("__lang")))
        # Only languages of few are ranked; of many, the share is cut off by hash.
        few = counted.where(F.col("__n") <= RANKED).withColumn("__rank", F.row_number().over(Window.partitionBy("lang").orderBy("__order", "doc_id")))
        few = few.select("doc_id", "lang", (F.col("__rank") <= _n_held_out()).alias("held_out"))
        many = counted.where(F.col("__n") > RANKED)
        return few.unionByName(many.select("doc_id", "lang", (F.col("__order").cast("double") / 2.0**64 + 0.5 < 1 / HELD_OUT).alias("held_out")))
    # A cut by hash leaves little more than is asked for (ten deviations), however
    # many a language has; only these are ranked.
    cuts = good.groupBy(F.col("lang").alias("__lang")).agg(F.least(F.count("*"), F.lit(max_trusted)).alias("__n"), ((max_trusted + 10 * max_trusted**0.5 + 10) / F.count("*") - 0.5).alias("__cut"))
    least = good.join(cuts, F.col("lang").eqNullSafe(F.col("__lang"))).where(F.col("__order").cast("double") / 2.0**64 < F.col("__cut"))
    ranked = least.withColumn("__rank", F.row_number().over(Window.partitionBy("lang").orderBy("__order", "doc_id"))).where(F.col("__rank") <= max_trusted)
    return ranked.select("doc_id", "lang", (F.col("__rank") <= _n_held_out()).alias("held_out"))


def _n_held_out() -> F.Column:
    return F.greatest(F.col("__n") / HELD_OUT, F.when(F.col("__n") >= 2 * MIN_HELD_OUT, MIN_HELD_OUT))


def trusted_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """(lang, text, held_out) of the documents in ``sample`` (as ``trusted_sample`` gives
    it for them). Each task looks its rows up by a 64-bit hash of id and language, so the
    texts stay where they are read; only ids are shuffled."""
    key = F.xxhash64("doc_id", "lang", F.col("lang").isNull()).alias("key")
    where = write_sorted(sample.select(key, F.col("held_out").cast("double").alias("value")))
    rows = docs.where("doc_id is not null").select(key, "lang", F.col("text").cast("string").alias("text"))

    def look_up(batches):
        known = open_sorted(*where)
        for batch in batches:
            there, held = known.find(batch.column(0).to_numpy().view(np.uint64))
            found = batch.filter(pa.array(there))
            yield pa.RecordBatch.from_arrays([*found.columns[1:], pa.array(held[there] > 0)], ["lang", "text", "held_out"])

    return map_rows(rows, look_up, StructType([rows.schema["lang"], rows.schema["text"], StructField("held_out", BooleanType())]))


def judge(docs: DataFrame, labels: DataFrame, order: int = ORDER, max_trusted: int | None = None, quantile: float = QUANTILE, into: str = "__judged") -> DataFrame:
    """``docs`` with perplexity, score, score_limit (null where there is none) and
    kept in a struct ``into``; a column of ``docs`` with that name gives way to it."""
    spark = docs.sparkSession
    prepare(spark)
    sample = stage(narrowed(trusted_sample(labels, max_trusted, docs)), "trusted")
    # Written once for both uses.
    texts = stage(trusted_texts(docs, sample), "trusted-texts")
    model = train(texts.where("not held_out"), order)
    grams = stage(narrowed(distinct_grams(docs.select(F.col("text").cast("string").alias("text")), order)), "kn-grams")
    table = probabilities(grams, model)
    where = write_table(table, order)
    held = stage(with_surprise(texts.where("held_out").select("lang", "text"), where, order).select("lang", "__surprise", "__places"), "held-out")
    total, places, n = held.agg(F.sum("__surprise"), F.sum("__places"), F.count("*")).first()
    if not n:
        limits = spark.createDataFrame([], "__lang string, __mean double, __limit double")
        common = 0.0
    else:
        # Means are rounded: sums of doubles depend on the order of their terms.
        common = round(total / places, 6)
        limits = held.groupBy(F.col("lang").alias("__lang")).agg(F.count("*").alias("n"), F.round(F.sum("__surprise") / F.sum("__places"), 6).alias("__mean"))
        limits = limits.where(F.col("n") >= MIN_HELD_OUT).drop("n")
        scored = held.join(F.broadcast(limits), F.col("lang").eqNullSafe(F.col("__lang"))).select("__lang", "__mean", _score(F.col("__mean")).alias("score"))
        limit, spread = F.percentile("score", F.lit(quantile)), F.round(F.avg("score") + 3 * F.stddev("score"))
        limits = stage(narrowed(scored.groupBy("__lang", "__mean").agg(F.when(F.count("*") * (1 - quantile) < 1, F.greatest(limit, spread)).otherwise(limit).alias("__limit"))), "limits")
    lang, mean, most, surprise, places = free_names(docs.columns, "__lang", "__mean", "__limit", "__surprise", "__places")
    judged = with_surprise(docs.withColumn("text", F.col("text").cast("string")) if dict(docs.dtypes)["text"] != "string" else docs, where, order, into=(surprise, places))
    # One row a language.
    judged = judged.join(F.broadcast(limits.toDF(lang, mean, most)), F.col("lang").eqNullSafe(F.col(lang)), "left")
    score, limit = _score(F.coalesce(mean, F.lit(common)), surprise, places), F.col(most)
    return judged.select(*map(quoted, all_but(docs, into)), F.struct(
        F.exp(F.col(surprise) / F.col(places)).alias("perplexity"), (score * STEP).alias("score"), (limit * STEP).alias("score_limit"),
        F.coalesce(score <= limit, F.lit(True)).alias("kept")).alias(into))


def keep_good(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """The documents that are not rejected, all columns as they are."""
    (into,) = free_names(docs.columns, "__judged")
    return judge(docs, labels, into=into, **how).where(F.col(into)["kept"]).select(*map(quoted, docs.columns))
