"""Lookup tables as shards of sorted 64-bit keys in the shared folder.

A worker maps the files into memory and searches them, so a lookup moves neither
the rows that look up nor the table: nothing is shuffled or broadcast, and only
the pages that are touched are read. Shards split the keys by their highest bits,
about ``SHARD_ROWS`` each, so a task that writes one holds a bounded part.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import kept, prepare, stage_dir

SHARD_ROWS = 1_000_000


def uri(path: str) -> str:
    """``file:/x`` (as Hadoop prints it) as ``file:///x``."""
    return f"file://{path[5:]}" if path.startswith("file:/") and not path.startswith("file://") else path


def place(folder: str):
    """File system and path of a folder named as Spark names it."""
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def whole(store, path: str, kind: str) -> np.ndarray:
    """A flat file, memory-mapped where the store is a mounted folder."""
    if not store.get_file_info(path).size:
        return np.zeros(0, kind)
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, kind, "r")
    with store.open_input_file(path) as file:
        return np.frombuffer(file.read_buffer(), kind)


def write_sorted(table: DataFrame) -> tuple[str, tuple[str, ...]]:
    """Write ``table`` (key long; value double, optional); the folder and the
    shards' names in the order of their keys, as ``open_sorted`` takes them."""
    spark = table.sparkSession
    prepare(spark)
    folder, with_value = uri(stage_dir(spark, "sorted")), "value" in table.columns
    bits = max(0, int(np.ceil(np.log2(max(1, table.count()) / SHARD_ROWS))))

    def write(part: pa.Table) -> pa.Table:
        store, path = place(folder)
        store.create_dir(path, recursive=True)
        keys, name = part["key"].to_numpy().view(np.uint64), uuid.uuid4().hex
        order = np.argsort(keys, kind="stable")
        files = {"key": keys.astype("<u8")} | ({"value": part["value"].to_numpy().astype("<f8")} if with_value else {})
        for kind, values in files.items():
            with store.open_output_stream(f"{path}/{name}.{kind}") as out:
                out.write(values[order].tobytes())
        return pa.table({"shard": part["shard"][:1], "name": [name]})

    shard = F.shiftrightunsigned("key", 64 - bits) if bits else F.lit(0).cast("long")
    rows = table.select("key", *(["value"] if with_value else []), shard.alias("shard"))
    written = {r["shard"]: r["name"] for r in rows.groupBy("shard").applyInArrow(write, "shard long, name string").collect()}  # one row a shard
    return folder, tuple(written.get(k, "") for k in range(1 << bits))


class SortedTable:
    def __init__(self, folder: str, names: tuple[str, ...]):
        store, path = place(folder)
        self.bits = len(names).bit_length() - 1
        self.keys = [whole(store, f"{path}/{x}.key", "<u8") if x else np.zeros(0, np.uint64) for x in names]
        self.values = [whole(store, f"{path}/{x}.value", "<f8") if x and store.get_file_info(f"{path}/{x}.value").size else np.zeros(0) for x in names]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each key (64-bit, unsigned) whether it is there, and its value (else 0)."""
        coded = pa.array(keys).dictionary_encode()
        own = coded.dictionary.to_numpy()
        order = np.argsort(own)
        own, there, value = own[order], np.zeros(len(order), bool), np.zeros(len(order))
        bounds = np.searchsorted(own >> np.uint64(64 - self.bits), np.arange(len(self.keys) + 1, dtype=np.uint64)) if self.bits else [0, len(own)]
        for known, values, a, b in zip(self.keys, self.values, bounds[:-1], bounds[1:]):
            if b > a and len(known):
                at = np.minimum(np.searchsorted(known, own[a:b]), len(known) - 1)
                hit = known[at] == own[a:b]
                there[order[a:b]] = hit
                if len(values):
                    value[order[a:b]] = np.where(hit, values[at], 0)
        indices = coded.indices.to_numpy()
        return there[indices], value[indices]


def open_sorted(folder: str, names: tuple[str, ...]) -> SortedTable:
    return kept(("sorted", folder), lambda: SortedTable(folder, names))
