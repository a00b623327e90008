"""Spelling variants of words, found by permuterm rotations.

Words are counted over whole texts. Two words are near if they differ by exactly
one inserted, deleted or replaced code point. A word's form is its near word of
largest count, if that is at least ``RATIO`` times the word's own; following forms
to their end gives its root.

Method. A terminator is put behind each word and all rotations of it are sorted.
Of a word ``x c y`` the rotation that begins behind ``c`` is ``y$x`` and then ``c``:
words that differ in ``c`` alone share the prefix range of ``y$x``, the edited
character skipped, and the word ``x y`` without it has ``y$x`` as a whole rotation.
Each rotation is therefore laid under the key ``y$x``, keys are dealt by range and
sorted, and the rows of a key are scanned together. A key's rows differ in ``c``,
so they are no more than the alphabet and one; a scan keeps the two best of them
and emits for each member how many near words it has there and the best one, so
it is linear and no pairs are emitted. Equal letters side by side give the same
deletion several times; only the first of a run of letters counts. Rows carry a
word's place in code-point order instead of the word, and keys of very long words
are hashes of the rotation, so a word's rows grow with its length, not its square.

Forms at least double the count (``RATIO`` 2), so a chain of forms is no longer
than the bits of the largest count; pointers are followed by doubling.

Defined results: a null or empty text has no words; a null id is written as the
empty string before the colon; repeated rows count again; an empty table gives no
words. Columns besides the id and text columns are not read, so their names cannot
clash. Words are compared by code points, not by the letters that they show.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import discard, prepare, stage

#: Runs of letters; only A-Z are lower-cased.
LETTERS = r"([A-Za-zÀ-ÿ]++)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A run whose hash this number divides loses a code point.
SLIPS = 97
LEAST_LENGTH, LEAST_COUNT, RATIO = 5, 3, 2
#: Stands behind a word in its rotations; no letter, and before all letters.
END = "$"
#: Keys of more letters are hashed, modulo these primes with these bases.
LONG_FROM = 64
PRIMES, BASES = (2147483647, 2147483629, 2147483587, 2147483579), (1_000_003, 998_244_353, 77_777_777, 1_234_567_891)


def word_counts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n: the words of whole texts with at least ``least_length`` code points
    and ``least_count`` occurrences. A run loses the code point ``h % length`` if
    ``SLIPS`` divides h, the unsigned crc32 of ``<id>:<run>``."""
    runs = docs.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(F.col(text_column).cast("string"), F.lit(LETTERS), F.lit(1))).alias("run"))
    # A run of ASCII letters is lower-cased at once, the rest letter by letter.
    ascii_only = F.length("run") == F.octet_length("run")
    runs = runs.where(F.length("run") >= least_length).select("id", F.when(ascii_only, F.lower("run")).otherwise(F.translate("run", _UPPER, _LOWER)).alias("run"))
    h = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    slipped = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = runs.select(F.when(h % SLIPS == 0, slipped).otherwise(F.col("run")).alias("word"))
    counted = words.groupBy("word").agg(F.count("*").alias("n"))
    # One condition on both, which stays above the aggregate: below it the hash would be worked out twice.
    return counted.where(F.when(F.col("n") >= least_count, F.length("word") >= least_length).otherwise(F.lit(False)))


def numbered(words: DataFrame) -> DataFrame:
    """``words`` (word, n) with id, their places in code-point order: counted on from
    range part to range part, so no task sees all words."""
    parts = stage(words.repartitionByRange("word").withColumn("part", F.spark_partition_id()), "spelling-parts")
    before = F.coalesce(F.sum("k").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = parts.groupBy("part").agg(F.count("*").alias("k")).select("part", before.alias("before"))  # one row a part
    place = F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy("word"))
    out = stage(parts.join(starts, "part").select("word", "n", place.cast("long").alias("id")), "spelling-words")
    discard(parts)
    return out


def _powers(base: int, n: int, prime: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(pow(base, done, prime)) % np.uint64(prime)
        done += more
    return out


class _Rotated:
    """Hashes of ``y$x`` for all cuts of one long word, in time linear in its length."""

    def __init__(self, points: np.ndarray):
        self.n, self.sums, self.up, self.down = len(points), [], [], []
        for prime, base in zip(PRIMES, BASES):
            p = np.uint64(prime)
            up = _powers(base, len(points) + 2, prime)
            self.up.append(up)
            self.down.append(_powers(pow(base, -1, prime), len(points) + 2, prime))
            terms = points.astype(np.uint64) * up[: len(points)] % p
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64) % p]))

    def keys(self, skip: int) -> list[str]:
        """The keys without ``skip`` (0 or 1) code points behind each cut."""
        at = np.arange(self.n + 1 - skip)
        size, parts = self.n - at - skip, []  # of y
        for prime, sums, up, down in zip(PRIMES, self.sums, self.up, self.down):
            p = np.uint64(prime)
            y = (sums[self.n] + p - sums[at + skip]) % p * down[at + skip] % p
            parts.append((y + up[size] * np.uint64(ord(END)) % p + sums[at] * up[size + 1] % p) % p)
        return ["#%x:%x:%x:%x:%x" % (*x, self.n - skip) for x in zip(*(part.tolist() for part in parts))]


def _long_rotations(batches, long_from: int):
    for batch in batches:
        for word, n, id_ in zip(*(batch.column(x).to_pylist() for x in ("word", "n", "id"))):
            points = np.frombuffer(word.encode("utf-32-le"), np.uint32)
            rotated, size = _Rotated(points), len(points)
            first = np.concatenate([[True], points[1:] != points[:-1]])
            less = rotated.keys(1) if size - 1 > long_from else [word[i + 1 :] + END + word[:i] for i in range(size)]
            for keys, c, opens in ((rotated.keys(0), [""] * (size + 1), [False] * (size + 1)), (less, list(word), first.tolist())):
                for a in range(0, len(keys), 10_000):
                    b = min(a + 10_000, len(keys))
                    yield pa.RecordBatch.from_arrays([pa.array(keys[a:b]), pa.array(c[a:b]), pa.array(opens[a:b]), pa.array([id_] * (b - a)), pa.array([n] * (b - a))], ["key", "c", "first", "id", "n"])


def rotations(words: DataFrame, long_from: int = LONG_FROM) -> DataFrame:
    """key, c, first, id, n: each word ``x y`` under its rotations ``y$x`` with no c,
    and each word ``x c y`` under ``y$x`` with its c. ``first``: c opens its run of
    equal letters (x does not end with it).

    A key of more than ``long_from`` letters is written as four 31-bit hashes and its
    length: all rotations of a word of a million letters are then a million short
    rows, not a million million letters."""
    prepare(words.sparkSession)
    cut = words.where(F.length("word") <= long_from).withColumn("at", F.explode(F.sequence(F.lit(0), F.length("word"))))
    head, tail = F.substring("word", F.lit(1), F.col("at")), F.substring("word", F.col("at") + 1, F.length("word"))
    whole = cut.select(F.concat(tail, F.lit(END), head).alias("key"), F.lit("").alias("c"), F.lit(False).alias("first"), "id", "n")
    c = F.substring("word", F.col("at") + 1, F.lit(1))
    rest = F.substring("word", F.col("at") + 2, F.length("word"))
    before = F.when(F.col("at") > 0, F.substring("word", F.col("at"), F.lit(1))).otherwise(F.lit(""))
    less = cut.where(F.col("at") < F.length("word")).select(F.concat(rest, F.lit(END), head).alias("key"), c.alias("c"), (c != before).alias("first"), "id", "n")
    long = words.where(F.length("word") > long_from).mapInArrow(partial(_long_rotations, long_from=long_from), "key string, c string, first boolean, id long, n long")
    return whole.unionByName(less).unionByName(long)


def near_words(words: DataFrame, long_from: int = LONG_FROM) -> DataFrame:
    """id, n_near (long), best (struct of rank = -n and id: of the near words the one
    of largest count, then first in code-point order) of the words (word, n, id) that
    have near ones."""
    laid = rotations(words, long_from).repartitionByRange("key").sortWithinPartitions("key", "c")
    own = F.struct((-F.col("n")).alias("rank"), "id")
    group = Window.partitionBy("key")
    skips, firsts = F.col("c") != "", F.col("first")
    scan = laid.select(
        "key", "c", "first", "id", own.alias("own"),
        F.count(F.when(skips, 1)).over(group).alias("n_skip"), F.count(F.when(firsts, 1)).over(group).alias("n_first"),
        F.min(F.when(skips, own)).over(group).alias("top"), F.min(F.when(~skips, own)).over(group).alias("whole"),
        F.min(F.when(firsts, own)).over(group).alias("top_first"),
    )
    # The second best of those that skip a character, for the best itself.
    other = F.min(F.when(skips & (F.col("id") != F.col("top.id")), F.col("own"))).over(group)
    scan = scan.where(F.col("n_skip") + F.when(F.col("whole").isNull(), 0).otherwise(1) > 1).withColumn("next", other)
    replaced = F.when(skips, F.when(F.col("id") == F.col("top.id"), F.col("next")).otherwise(F.col("top")))
    shorter, longer = F.when(firsts, F.col("whole")), F.when(~skips, F.col("top_first"))
    best = F.array_min(F.filter(F.array(replaced, shorter, longer), lambda x: x.isNotNull()))
    n = F.when(skips, F.col("n_skip") - 1 + F.when(firsts & F.col("whole").isNotNull(), 1).otherwise(0)).otherwise(F.col("n_first"))
    emitted = scan.select("id", n.alias("n_near"), best.alias("best")).where("n_near > 0")
    return emitted.groupBy("id").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def with_roots(forms: DataFrame) -> DataFrame:
    """Add ``root``: from word along ``form`` to the last, by pointer doubling. A
    form must lead to a word of larger count, so there are no circles."""
    points = stage(forms.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "spelling-pointers")
    while True:
        onward = points.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = stage(points.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-pointers")
        discard(points)
        done = jumped.where("moved").isEmpty()
        points = jumped.select("word", "root")
        points._staged_path = jumped._staged_path
        if done:
            return forms.join(points, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = RATIO,
             long_from: int = LONG_FROM) -> DataFrame:
    """One row per word: word, form, root (string), n, n_near, form_n (long).
    ``ratio`` is 2 or more."""
    if ratio < 2:
        raise ValueError("a ratio under 2 allows long chains of forms")
    words = numbered(word_counts(docs, id_column, text_column, least_length, least_count))
    near = words.join(near_words(words, long_from), "id", "left")
    fits = -F.col("best.rank") >= ratio * F.col("n")
    near = near.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(fits, F.col("best.id")).alias("form_id"))
    named = words.select(F.col("id").alias("form_id"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    forms = stage(near.join(named, "form_id", "left").drop("form_id"), "spelling-forms")
    return with_roots(forms).select("word", "form", "root", "n", "n_near", "form_n")
