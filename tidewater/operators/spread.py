"""Joins and ranks that no single key can hold up.

A key that holds a third of all rows makes one task of a hash or range shuffle read
them all. Here the rows of such *heavy* keys never meet in a shuffle: keys with more
than ``SHARE`` of the rows are at most ``1 / SHARE`` by definition, so what belongs
to them can be broadcast whatever the size of the data; the other keys are shuffled,
and none of them holds more than its share.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.sources.publish import scratch_path

#: Share of all rows beyond which a key is heavy: at most 1,000 keys are.
SHARE = 0.001
#: Rows of a side in one cell of a grid join.
TILE = 2048


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_unique(rows: DataFrame, unique: DataFrame, on: Sequence[str], n: str, total: int, share: float = SHARE) -> DataFrame:
    """Left join of ``rows`` with ``unique`` (one row per null-safe key ``on``, whose
    column ``n`` is the key's number of rows among ``total``). Both are stored tables.

    Heavy keys are broadcast and the others shuffled; a row is in one branch only.
    """
    heavy = F.col(n) > F.lit(total * share)
    names = {x: f"__of_{x}" for x in on}
    keyed = unique.withColumnsRenamed(names)
    same = [rows[x].eqNullSafe(F.col(y)) for x, y in names.items()]
    few, rest = F.broadcast(keyed.where(heavy)), keyed.where(~heavy)
    in_few = rows.join(few, same, "inner").drop(*names.values())
    others = rows.join(F.broadcast(keyed.where(heavy).select(*names.values())), same, "left_anti")
    return in_few.unionByName(others.join(rest, [others[x].eqNullSafe(F.col(y)) for x, y in names.items()], "left").drop(*names.values()))


def grid_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, tile: int = TILE) -> DataFrame:
    """Inner join on one key of few values, many to many, dealt to a grid.

    The rows of a key on either side are dealt to tiles of about ``tile`` rows by the
    hash of the row, and each left tile meets each right tile in a cell of its own,
    so the number of cells grows with the rows of a key, not with the keys. A left
    row is copied once for each right tile, and the other way round: ``tile`` times
    fewer copies than the join has rows. Counts are one row a key, from map-side sums.
    Neither side may hold a column of the other, or one that begins with ``__grid``.
    """
    counts = {}
    for name, side, key in (("l", left, left_key), ("r", right, right_key)):
        tiles = F.ceil(F.count(F.lit(1)) / tile).cast("int")
        counts[name] = side.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__grid_key")).agg(tiles.alias(f"__grid_{name}"))
    shape = counts["l"].join(counts["r"], "__grid_key")
    cells = []
    for name, other, side, key in (("l", "r", left, left_key), ("r", "l", right, right_key)):
        dealt = side.join(shape.withColumnRenamed("__grid_key", f"__grid_key_{name}"), side[key] == F.col(f"__grid_key_{name}")).drop(f"__grid_key_{name}")
        own = F.pmod(F.xxhash64(*[F.col(f"`{x}`") for x in side.columns]), F.col(f"__grid_{name}")).cast("int")
        dealt = dealt.withColumn(f"__grid_own_{name}", own).withColumn(f"__grid_other_{name}", F.explode(F.sequence(F.lit(0), F.col(f"__grid_{other}") - 1)))
        cells.append(dealt.drop("__grid_l", "__grid_r"))
    a, b = cells
    met = a.join(b, (a[left_key] == b[right_key]) & (a["__grid_own_l"] == b["__grid_other_r"]) & (a["__grid_other_l"] == b["__grid_own_r"]))
    return met.drop("__grid_own_l", "__grid_other_l", "__grid_own_r", "__grid_other_r")


def with_place(df: DataFrame, order: Sequence[tuple[str, bool]], out: str = "place", share: float = SHARE) -> DataFrame:
    """R1-R3 as a column: each row's dense rank in the global order, given as
    (column, ascending). NULLs come first upward and last downward.

    The rows are worked out and stored once. Only their *distinct* keys are ranked:
    dealt to range parts, numbered inside their part, and moved up by the keys of the
    parts before (a prefix sum over one row a part). The ranks are then joined back
    to the rows, heavy keys apart. So no task sees all rows or those of one key.
    """
    rows, names = stored(df, "unplaced"), [x for x, _ in order]
    ways = [F.col(x).asc_nulls_first() if up else F.col(x).desc_nulls_last() for x, up in order]
    keys = stored(rows.groupBy(*names).agg(F.count(F.lit(1)).alias("__n")), "place-keys")
    parts = stored(keys.repartitionByRange(*ways).withColumn("__part", F.spark_partition_id()), "place-parts")
    ranked = parts.withColumn("__rank", F.row_number().over(Window.partitionBy("__part").orderBy(*ways)))
    sizes = parts.groupBy("__part").agg(F.count(F.lit(1)).alias("__keys"))
    before = F.sum("__keys").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    bases = sizes.select(F.col("__part").alias("__of"), F.coalesce(before, F.lit(0)).alias("__base"))  # one row a part
    places = stored(ranked.join(bases, ranked["__part"] == bases["__of"]).select(*names, "__n", (F.col("__base") + F.col("__rank")).cast("bigint").alias("__place")), "places")
    placed = join_unique(rows, places, names, "__n", rows.count(), share)
    return placed.select(*df.columns, F.col("__place").alias(out))
