"""Token ids as flat binary files that are memory-mapped.

File format, one set of files per shard in a folder:

* ``<name>.bin``: the ids of the shard's documents one after another, each
  document with the end id appended, as flat little-endian unsigned integers of
  ``width`` bytes (2 where the vocabulary and the end id fit, else 4);
* ``<name>.idx``: little-endian signed 64-bit integers, two runs: the documents'
  ids (n; a null id is the smallest integer) and their offsets counted in ids of
  the shard (n + 1). The manifest's base makes them offsets over all shards.

Shards hold ascending ranges of doc_id, and documents ascend inside a shard, so
the shards in order are one long flat array. Bases are prefix sums over the shards'
totals (one row per shard).

A task writes files of its own name; only files named by rows that Spark
committed to the manifest count, so a repeated or lost task leaves no doubt.

Defined results: a null text is empty and has the end id only; repeated ids are
ordered by the text's hash, and equal rows give equal bytes in any order; null
ids come first; an empty table gives no shards.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import prepare, stage, stage_dir
from tidewater.llm.sorted_files import place, uri, whole

END_ID = 2
NULL_ID = np.iinfo(np.int64).min
MANIFEST = pa.schema([("shard", pa.int32()), ("name", pa.string()), ("width", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])


def write_ids(docs: DataFrame, tokenizer: str, end_id: int = END_ID, folder: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Encode every whole text, write the files, and return the manifest: one row
    per shard in file order (shard, name, width, n_docs, n_ids, base, folder)."""
    spark = docs.sparkSession
    prepare(spark)
    folder = uri(folder or stage_dir(spark, "token-ids"))
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    hashed = rows.withColumn("tie", F.xxhash64("text"))
    ordered = hashed.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "text")

    def write(batches):
        from tidewater.llm.bpe import encoder

        encode, out = encoder(tokenizer, True), None
        width = 2 if max(encode.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        name, ids, lengths = uuid.uuid4().hex, [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                store, path = place(folder)
                store.create_dir(path, recursive=True)
                out = store.open_output_stream(f"{path}/{name}.bin")
            counts = np.zeros(batch.num_rows, np.int64)
            for a, b, run, n, ends in encode.ids_of(batch.column(1)):
                if ends:
                    run, n = np.insert(run, np.cumsum(n), end_id), n + 1
                counts[a:b] += n
                out.write(run.astype(f"<u{width}").tobytes())
            ids.append(batch.column(0).fill_null(NULL_ID).to_numpy())
            lengths.append(counts)
        if out is None:
            return
        out.close()
        lengths = np.concatenate(lengths)
        offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths)])
        with store.open_output_stream(f"{path}/{name}.idx") as index:
            index.write(np.concatenate([*ids, offsets]).astype("<i8").tobytes())
        yield pa.RecordBatch.from_pydict({"shard": [TaskContext.get().partitionId()], "name": [name], "width": [width], "n_docs": [len(lengths)], "n_ids": [int(offsets[-1])]}, MANIFEST)

    shards = stage(ordered.mapInArrow(write, "shard int, name string, width int, n_docs long, n_ids long"), "token-shards")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.select("*", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"), F.lit(folder).alias("folder"))


def read_ids(manifest: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Read the files back: per document its id, start (ids of all documents
    before it), n_tokens and ids_crc32 (of the ids as unsigned 32-bit integers)."""
    prepare(manifest.sparkSession)
    shards = stage(manifest, "token-manifest")

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                store, path = place(row["folder"])
                n, stem = row["n_docs"], f"{path}/{row['name']}"
                index, flat = whole(store, f"{stem}.idx", "<i8"), whole(store, f"{stem}.bin", f"<u{row['width']}")
                ids, offsets = np.array(index[:n]), np.array(index[n:])
                if offsets[-1] != len(flat):
                    raise ValueError(f"{stem}: {len(flat)} ids, its index says {offsets[-1]}")
                for a in range(0, n, 10_000):
                    b = min(n, a + 10_000)
                    sums = [zlib.crc32(flat[i:j].astype("<u4").tobytes()) for i, j in zip(offsets[a:b].tolist(), offsets[a + 1 : b + 1].tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[a:b], mask=ids[a:b] == NULL_ID), pa.array(offsets[a:b] + row["base"]), pa.array(np.diff(offsets[a : b + 1])), pa.array(sums, pa.int64())],
                        ["id", "start", "n_tokens", "ids_crc32"])

    # One shard is one row; deal the rows out, or one task would read all files.
    dealt = shards.repartition(max(1, shards.count()))
    return dealt.mapInArrow(read, "id long, start long, n_tokens long, ids_crc32 long").withColumnRenamed("id", id_column)
