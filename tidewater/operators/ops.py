"""Reusable DataFrame operators of the table builders.

All of them are compositions of DataFrame calls (join, groupBy, explode);
none collects data to the driver and none runs Python per row.
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.expr import live

_ids = itertools.count()

#: Places to which the rows of a NULL join key are dealt.
NULL_TASKS = 10_000


def _tmp(prefix: str) -> str:
    return f"__{prefix}{next(_ids)}"


def lookup(
    df: DataFrame,
    dim: DataFrame,
    left_key: Column | Sequence[Column],
    right_key: str | Column | Sequence[str | Column],
    fields: Mapping[str, str | Column] | None = None,
    how: str = "left",
    live_only: bool = False,
    where: Column | None = None,
    small: bool = False,
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Join ``dim`` to ``df`` on equal keys and bring ``fields`` along.

    ``fields`` maps output name -> dimension column; the dimension key is
    renamed to a private name, so one table can be looked up under many roles
    (X5) without ambiguous columns. ``live_only`` keeps only rows with
    ``_fivetran_deleted = False`` (F9; use it with ``how="inner"``), ``where``
    filters the dimension first. ``small`` puts a broadcast hint on the
    dimension; callers pass it only for code lists, bounded by their definition.

    A left join hashes all rows of a NULL key to one task, though they match
    nothing. ``spread_by`` names columns of ``df`` that tell its rows apart: their
    hash then deals the rows of NULL keys to ``NULL_TASKS`` places, by a second join
    key that is 0 wherever the key is not NULL.
    """
    left_keys = [left_key] if isinstance(left_key, Column) else list(left_key)
    right_keys = [right_key] if isinstance(right_key, (str, Column)) else list(right_key)
    d = dim.where(live()) if live_only else dim
    if where is not None:
        d = d.where(where)
    key_names = [_tmp("k") for _ in right_keys]
    cols = [(F.col(k) if isinstance(k, str) else k).alias(n) for k, n in zip(right_keys, key_names)]
    cols += [(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in (fields or {}).items()]
    d = d.select(*cols)
    if small:
        d = F.broadcast(d)
    if spread_by and how == "left" and not small:
        deal, none = _tmp("k"), F.lit(False)
        for lk in left_keys:
            none = none | lk.isNull()
        left_keys.append(F.when(none, 1 + F.pmod(F.xxhash64(*[df[x] for x in spread_by]), F.lit(NULL_TASKS))).otherwise(F.lit(0).cast("bigint")))
        # Always 0, but no literal: a constant would not remain a join key.
        d = d.withColumn(deal, F.pmod(F.xxhash64(*key_names), F.lit(1).cast("bigint")))
        key_names.append(deal)
    cond = None
    for lk, rk in zip(left_keys, key_names):
        e = lk == d[rk]
        cond = e if cond is None else cond & e
    return df.join(d, cond, how).drop(*key_names)


def prefix_clashes(df: DataFrame, other_columns, prefix: str) -> DataFrame:
    """Rename the columns of ``df`` that also exist in ``other_columns``."""
    clash = set(other_columns)
    return df.select(*[F.col(x).alias(prefix + x) if x in clash else F.col(x) for x in df.columns])


def keys_present(df: DataFrame, keys: DataFrame, left_key: Column, key: str) -> DataFrame:
    """Left-semi join against the distinct keys of ``keys`` (an EXISTS test).

    The keys are deduplicated first (map-side partial distinct), so only one
    row per key crosses the shuffle, however many rows carry it.
    """
    k = _tmp("k")
    d = keys.select(F.col(key).alias(k)).distinct()
    return df.join(d, left_key == d[k], "left_semi")


def preaggregate(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Group by ``keys`` and compute ``measures`` (partial aggregation map-side)."""
    return df.groupBy(*keys).agg(*[m.alias(n) for n, m in measures.items()])


def nest(
    df: DataFrame,
    keys: Sequence[str | Column],
    fields: Sequence[Column],
    out: str,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """One row per ``keys`` with ``out`` = array of struct(``fields``).

    The array is sorted (struct order: first field first), so runs repeat;
    the reference leaves the order undefined. ``extra`` are more aggregates.
    """
    arr = F.sort_array(F.collect_list(F.struct(*fields))).alias(out)
    return df.groupBy(*keys).agg(arr, *extra)


def sorted_runs(df: DataFrame, keys: Sequence[str], fields: Sequence[Column], aggregates: Sequence[Column] = (), by: int = 1) -> DataFrame:
    """keys, part, run and ``aggregates``: each parent's rows as sorted arrays of
    struct(``fields``), one for each range part that holds some of them. Ranges are
    of the keys and the first ``by`` fields; the parts of a parent ascend."""
    rows = df.withColumn("__row", F.struct(*fields))
    names = [x.name for x in rows.schema["__row"].dataType.fields[:by]]
    dealt = rows.repartitionByRange(*keys, *[F.col("__row")[x] for x in names]).withColumn("__part", F.spark_partition_id())
    return dealt.groupBy(*keys, "__part").agg(F.sort_array(F.collect_list("__row")).alias("__run"), *aggregates)


def nest_runs(df: DataFrame, keys: Sequence[str], fields: Sequence[Column], out: str,
              sums: Mapping[str, Column] | None = None, maxima: Mapping[str, Column] | None = None, by: int = 1) -> DataFrame:
    """N1 for large parents: ``nest`` whose last task only concatenates.

    Rows are dealt by ranges of the parent and the first ``by`` fields, so a parent
    with very many rows lies in several tasks, each of which sorts its own run. The
    runs of a parent hold disjoint ranges in the order of their parts; the last step
    puts them together in that order and compares nothing but part numbers. Rows that
    are equal in those fields share a part, so the array is the sorted one of ``nest``,
    element by element. ``sums`` and ``maxima`` are aggregates over the parent's rows,
    put together run by run.
    """
    sums, maxima = dict(sums or {}), dict(maxima or {})
    runs = sorted_runs(df, keys, fields, [F.sum(x).alias(n) for n, x in sums.items()] + [F.max(x).alias(n) for n, x in maxima.items()], by)
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("__part", "__run"))), lambda x: x["__run"])
    totals = [F.sum(n).alias(n) for n in sums] + [F.max(n).alias(n) for n in maxima]
    return runs.groupBy(*keys).agg(F.flatten(in_order).alias(out), *totals)


def distinct_count_by(df: DataFrame, part: str, counts: Mapping[str, str], *more: Column) -> DataFrame:
    """``count(distinct x) over (partition by part)`` as a grouped table.

    Returns one row per ``part`` value (NULL is a group) with one count per
    entry of ``counts`` (output name -> column) and ``more`` aggregates. Join it
    back with ``eqNullSafe``. Spark plans each distinct count as a two-level aggregate
    (first by (part, x), then by part), so a hot ``part`` value is spread
    over tasks before its final, tiny merge.
    """
    return df.groupBy(part).agg(*[F.count_distinct(F.col(x)).alias(n) for n, x in counts.items()], *more)


def repeat_rows(df: DataFrame, times: Column) -> DataFrame:
    """Each row ``times`` times (at least once), as a left join would give."""
    t = _tmp("r")
    return df.withColumn(t, F.explode(F.array_repeat(F.lit(True), F.greatest(times.cast("int"), F.lit(1))))).drop(t)
