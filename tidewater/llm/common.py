"""Shared helpers: staged tables, worker imports, words and 64-bit hashes.

Word rule used by every operator that speaks of words: lower-case A-Z, then
take ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. In UTF-8 that is a translation of
single bytes, because every byte of a non-ASCII character is a word byte; so
``normalise`` maps a text to its words joined by one space in C code.
"""

from __future__ import annotations

import ctypes
import os
import uuid
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidewater.sources.publish import shared_dir

#: Bytes that are no part of a word.
NON_WORD = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_UPPER, _LOWER = bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B))
TO_WORDS = bytes.maketrans(_UPPER, _LOWER)
TO_WORDS = bytes(0x20 if b in NON_WORD else b for b in TO_WORDS)

#: Constants of the SplitMix64 finaliser and the golden-ratio step.
MIX_1, MIX_2, GOLDEN = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package where the driver found it.

    On a cluster the package is shipped with ``--py-files``; this only helps
    sessions whose workers share the driver's file system.
    """
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*filter(None, paths), root])
    env.setdefault("TOKENIZERS_PARALLELISM", "false")
    env.setdefault("ARROW_DEFAULT_MEMORY_POOL", "system")  # gives memory back between batches
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


#: Bytes of rows that go to a Python worker at once, however long the texts are.
BATCH_BYTES = 8 << 20
_kept: dict = {}


def kept(key: tuple, build):
    """What ``build`` makes for ``key``, kept by this worker process until it is
    asked for another key: workers live on between stages, and the memo of one
    operator must not stand beside that of the next."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = build()
    return _kept[key]


def give_back() -> None:
    """Return the memory that this worker process has freed to the system."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def lean(run):
    """``run`` for ``mapInArrow``. Idle workers stand beside the busy ones for as long
    as an executor has work, so a task's memory is given back when it ends."""
    def leaving(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return leaving


def free_names(columns: list[str], *wanted: str) -> list[str]:
    """Private column names that no column of the input has (in any letter case):
    each wanted name, with as many underscores behind it as that takes."""
    taken, out = {c.lower() for c in columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> str:
    """A column name for ``F.col``, whatever signs it holds."""
    return "`" + name.replace("`", "``") + "`"


def all_but(df: DataFrame, *names: str | None) -> list[str]:
    """The columns of ``df`` besides those that give way to new ones of these names."""
    gone = {n.lower() for n in names if n}
    return [c for c in df.columns if c.lower() not in gone]


def map_rows(df: DataFrame, run, schema: StructType) -> DataFrame:
    """``df.mapInArrow``, which takes no names with dots or backticks, for columns
    of any names: inside, the columns are numbered."""
    numbers = [f"c{i}" for i in range(len(schema))]

    def numbered(batches):
        for out in run(batches):
            yield pa.RecordBatch.from_arrays(out.columns, numbers)

    inner = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    fields = [StructField(n, f.dataType, f.nullable) for n, f in zip(numbers, schema.fields)]
    return inner.mapInArrow(lean(numbered), StructType(fields)).toDF(*schema.names)


def stage_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared folder of the session."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Shuffle partitions that share a file of a narrow staged table, where there are many.
PARTITIONS_A_FILE = 16


def n_files(spark: SparkSession) -> int:
    """Files of a narrow staged table at most: two for each core, or more as the
    shuffle partitions (and with them the data) get more."""
    return max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // PARTITIONS_A_FILE)


def narrowed(df: DataFrame, dealt: bool = False) -> DataFrame:
    """``df`` in as many partitions as a narrow staged table has files."""
    n = n_files(df.sparkSession)
    return df.repartition(n) if dealt else df.coalesce(n)


def stage(df: DataFrame, name: str, narrow: bool = False, dealt: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: short lineage, and
    a lost executor costs a reread instead of a recomputation.

    Every file costs its writer requests to the store, and on a local folder a few
    child processes. A ``narrow`` table (keys and numbers) has ``n_files`` of them,
    not one a partition: each is written by one task from several partitions, one
    after another. Where the work above is uneven (``dealt``), the rows are dealt
    out to the files in a shuffle, and the work keeps its tasks."""
    spark = df.sparkSession
    if narrow:
        df = narrowed(df, dealt)
    path = stage_dir(spark, name)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._staged_path = path
    return back


def discard(df: DataFrame) -> None:
    """Delete a staged table that no later result reads."""
    path = getattr(df, "_staged_path", None)
    if path is not None:
        jvm, sc = df.sparkSession._jvm, df.sparkSession.sparkContext
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its offsets from 0; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Cut rows into runs of about ``most`` bytes, a longer row alone in its run."""
    cuts, at, n = [], 0, len(offsets) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        cuts.append((at, end))
        at = end
    return cuts


def normalise(text: bytes) -> bytes:
    """The words of a text joined by one space."""
    return b" ".join(text.translate(TO_WORDS).split())


def word_texts(column: pa.Array) -> list[bytes]:
    """``normalise`` of every row; null has no words."""
    data, offsets = utf8(column)
    whole = data.tobytes().translate(TO_WORDS)
    return [b" ".join(whole[a:b].split()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser (a bijection of 64-bit words)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(MIX_1)
    x ^= x >> np.uint64(27)
    x *= np.uint64(MIX_2)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int, base: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2**64."""
    out = np.empty(max(n, 1), np.uint64)
    out[0], done, step = 1, 1, base % 2**64
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(step)
        done, step = done + more, step * step % 2**64
    return out


#: Base of the substring hash (odd, so that it has an inverse modulo 2**64).
BASE = 0x5851F42D4C957F2D
BASE_INVERSE = pow(BASE, -1, 2**64)


class SubstringHash:
    """64-bit hashes of substrings of one byte array, vectorised.

    The polynomial prefix sums ``sum(byte[i] * BASE**i)`` give the hash of a
    substring as a difference times ``BASE**-start``, so equal substrings hash
    alike wherever they stand.
    """

    def __init__(self, data: np.ndarray):
        with np.errstate(over="ignore"):
            terms = (data.astype(np.uint64) + np.uint64(1)) * powers(len(data), BASE)[: len(data)]
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
            self.inverse = powers(len(data) + 1, BASE_INVERSE)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix64((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))


def words_column(text):
    """The words of a text column as an array, with Spark functions only."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER.decode(), _LOWER.decode())
    return F.regexp_extract_all(lowered, F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), F.lit(1))
