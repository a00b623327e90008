"""Mixing sources to target weights by cube-method balanced sampling.

A document's size is its number of words (``[^\\x20\\x09-\\x0D]+``). Sources, in
code-point order and null last, weigh 3, 1, 2, and so on in turn; they share
``TOTAL`` times all sizes by weight; a target stops at ``MOST`` times its source's
size and the excess is shared anew until none is above. A source whose target is r
times its size takes each of its documents r times on average: the whole part of r
for certain, and once more with its fractional part as inclusion probability.

Method. The cube method balances these probabilities: the sample must keep each
source's number of words and of documents. Flight: of three documents in hand, the
probabilities move along the null space of the two balancing equations until one
is 0 or 1; either direction is drawn so that each probability is kept on average.
The next document takes the place of the decided one, the largest first, so that
what is left at the end is small. Sources are cut into blocks of bounded size by
the hash of the document; a block leaves two open documents at most, and these are
put together and flown again, block by block, until each source is one block. Its
last two are the landing problem: of their four outcomes the one nearest to the
source's open words is taken.

Equal rows (source, id, size) are one unit that takes whole numbers of copies in
expectation, so any number of repeated rows is one open probability at most; the
copies are dealt to the rows at the end, in chunks. Draws are hashes of the seed
and the unit, and units are flown in an order that is total, so reruns agree.

Defined results: a null or empty text has size 0 and takes no words; a null source
is a source of its own; null and repeated ids are rows like others; a source of
size 0 has target 0; an empty table gives no rows. Columns besides the id, text
and source columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import discard, mix64, prepare, stage

WORD = r"[^\x20\x09-\x0D]++"
#: Weights in turn, share of all sizes (times 2), most of a source's size.
WEIGHTS, HALVES, MOST = (3, 1, 2), 3, 2
#: Units of one task of the flight, and of one source's block in it.
CELL_UNITS, BLOCK_UNITS = 40_000, 10_000
SEED = 11
#: Copies of one unit that one row of the last step deals out.
DEAL = 65_536
#: A probability this near to 0 or 1 is decided.
EPS = 1e-9


def word_sizes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """id, source, size of each row."""
    size = F.coalesce(F.regexp_count(F.col(text_column).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.col(id_column).alias("id"), F.col(source_column).cast("string").alias("source"), size.alias("size"))


def source_targets(units: DataFrame) -> DataFrame:
    """source, n_units, source_size, target of a table of units (source, size, m).

    Places of sources in code-point order count on from range part to range part,
    so no task sees all sources. Of the resharing only its level (words for one
    unit of weight) passes through the driver: each round closes the sources that
    stand at their most, and shares what the others have left anew.
    """
    totals = units.groupBy("source").agg(F.count("*").alias("n_units"), F.sum(F.col("size") * F.col("m")).alias("source_size"))
    order = [F.col("source").isNull(), F.col("source")]
    parts = stage(totals.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "mix-sources")
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = parts.groupBy("part").agg(F.count("*").alias("n")).select("part", before.alias("before"))  # one row a part
    place = F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (place % len(WEIGHTS) + 1).cast("int"))
    weighed = stage(parts.join(starts, "part").select("source", "n_units", "source_size", weight.cast("long").alias("weight"), (MOST * F.col("source_size")).alias("most")), "mix-weights")
    discard(parts)
    words, weights = (int(x or 0) for x in weighed.agg(F.sum("source_size"), F.sum("weight")).first())
    left, open_weight = HALVES * words, weights  # in halves of words
    while True:
        closed = 2 * F.col("most") * open_weight <= F.lit(left) * F.col("weight")
        spent, rest = (int(x or 0) for x in weighed.agg(F.sum(F.when(closed, F.col("most"))), F.sum(F.when(~closed, F.col("weight")))).first())
        if rest == open_weight or not rest:
            break
        left, open_weight = HALVES * words - 2 * spent, rest
    share = F.lit(left).cast("double") * F.col("weight") / (2 * max(open_weight, 1))
    return weighed.select("source", "n_units", "source_size", F.least(F.col("most").cast("double"), share).alias("target"))


def flight(sizes: list[int], p: list[float], u: list[float]) -> list[int]:
    """Move the probabilities ``p`` of units with the given sizes, in place, until
    at most two are open; their indices. ``u`` holds a draw in [0, 1) for each unit."""
    hand, at, step, n = [], 0, 0, len(p)
    while True:
        while len(hand) < 3 and at < n:
            if EPS < p[at] < 1 - EPS:
                hand.append(at)
            else:
                p[at] = float(round(p[at]))
            at += 1
        if len(hand) < 3:
            return hand
        i, j, k = hand
        # The null space of (1, 1, 1) and the sizes; of (1, 1, 1) alone if all are equal.
        v = (sizes[j] - sizes[k], sizes[k] - sizes[i], sizes[i] - sizes[j])
        if not any(v):
            v = (1, -1, 0)
        up = min((1 - p[x] if d > 0 else p[x]) / abs(d) for x, d in zip(hand, v) if d)
        down = min((p[x] if d > 0 else 1 - p[x]) / abs(d) for x, d in zip(hand, v) if d)
        by = up if u[step] * (up + down) < down else -down
        step += 1
        still, nearest, gap = [], None, 1.0
        for x, d in zip(hand, v):
            q = p[x] + by * d
            if q <= EPS or q >= 1 - EPS:
                p[x] = 1.0 if q > 0.5 else 0.0
            else:
                p[x] = q
                still.append(x)
                if d and min(q, 1 - q) < gap:
                    nearest, gap = x, min(q, 1 - q)
        if len(still) == 3:  # rounding kept the deciding one a hair away from its end
            still.remove(nearest)
            p[nearest] = float(round(p[nearest]))
        hand = still


def land(sizes: list[int], p: list[float], open_: list[int]) -> None:
    """Decide the last units: the outcome nearest to their open words, then to
    their number."""
    words, number = sum(sizes[x] * p[x] for x in open_), sum(p[x] for x in open_)
    outcomes = reduce(lambda done, _: [[*x, y] for x in done for y in (0.0, 1.0)], open_, [[]])
    best = min(outcomes, key=lambda o: (abs(sum(sizes[x] * y for x, y in zip(open_, o)) - words), abs(sum(o) - number), o))
    for x, y in zip(open_, best):
        p[x] = y


def _fly(part: pa.Table) -> pa.Table:
    """One cell: the blocks in it one by one; ``p`` after their flight."""
    coded = pc.fill_null(part["source"].combine_chunks().dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)
    size, h, block = (part[x].to_numpy() for x in ("size", "h", "block"))
    order = np.lexsort((h, -size, block, coded))
    part, size, h = part.take(pa.array(order)), size[order], h[order].view(np.uint64)
    block, coded, last = block[order], coded[order], part["last"].to_numpy(zero_copy_only=False)
    p = part["p"].to_numpy().copy()
    with np.errstate(over="ignore"):
        u = (mix64(h + np.uint64(SEED)) >> np.uint64(11)).astype(float) * 2.0**-53
    starts = np.flatnonzero(np.concatenate([[True], (np.diff(block) != 0) | (np.diff(coded) != 0)]))
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(p)]):
        sizes, own = size[a:b].tolist(), p[a:b].tolist()
        open_ = flight(sizes, own, u[a:b].tolist())
        if last[a]:
            land(sizes, own, open_)
        p[a:b] = own
    return part.set_column(part.schema.get_field_index("p"), "p", pa.array(p))


def mix(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", seed: int = SEED, cell_units: int = CELL_UNITS, block_units: int = BLOCK_UNITS) -> DataFrame:
    """One row per row of ``docs``: the id, size, source_size, target, taken (words
    the mix takes) and times (0, 1 or 2 copies)."""
    prepare(docs.sparkSession)
    sizes = word_sizes(docs, id_column, text_column, source_column)
    units = stage(sizes.groupBy("source", "id", "size").agg(F.count("*").alias("m")), "mix-units")
    targets = source_targets(units).withColumnRenamed("source", "of")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)) * F.col("m")
    whole = F.floor(share + F.lit(EPS))
    h = F.xxhash64(F.lit(seed), F.coalesce("source", F.lit("")), F.col("source").isNull(), F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("id").isNull(), "size")
    keep = ["source", "id", "size", "m", "source_size", "target", "whole", "p", "h"]
    rest = units.join(targets, F.col("source").eqNullSafe(F.col("of"))).select(
        "source", "id", "size", "m", "source_size", "target", whole.alias("whole"), F.greatest(share - whole, F.lit(0.0)).alias("p"), h.alias("h"), F.col("n_units").alias("n"))
    done, n_rest = [], None
    while n_rest is None or n_rest:
        n_rest = units.count() if n_rest is None else n_rest
        blocks = F.ceil(F.col("n") / block_units)
        # The hash of the unit deals it to a block; a next round deals anew.
        cut = rest.select(*keep, F.pmod(F.xxhash64("h", F.lit(len(done))), blocks).alias("block"), (blocks == 1).alias("last"))
        cell = F.pmod(F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull(), "block"), F.lit(-(-n_rest // cell_units) or 1))
        cut = cut.withColumn("cell", cell)
        flown = stage(cut.groupBy("cell").applyInArrow(_fly, cut.schema), "mix-flown")
        open_ = (F.col("p") > 0) & (F.col("p") < 1)
        done.append(flown.where(~open_).select(*keep))
        rest = flown.where(open_).select(*keep)
        counts = rest.groupBy(F.col("source").alias("of")).agg(F.count("*").alias("n"))
        rest = rest.join(counts, F.col("source").eqNullSafe(F.col("of"))).drop("of")
        n_rest = flown.where(open_).count()
    units = reduce(DataFrame.unionByName, done)
    # Copies of a unit are dealt to its rows; a unit of very many rows in chunks.
    dealt = units.select("id", "size", "m", "source_size", "target", (F.col("whole") + F.col("p").cast("long")).alias("copies"))
    few = dealt.where(F.col("m") <= DEAL).withColumn("low", F.lit(0).cast("long"))
    many = dealt.where(F.col("m") > DEAL).withColumn("low", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1, F.lit(DEAL).cast("long")))).repartition("id", "low")
    rows = few.unionByName(many).withColumn("row", F.explode(F.sequence("low", F.least(F.col("low") + DEAL, F.col("m")) - 1)))
    times = F.floor(F.col("copies") / F.col("m")) + (F.col("row") < F.col("copies") % F.col("m")).cast("long")
    return rows.select(F.col("id").alias(id_column), "size", "source_size", "target", (times * F.col("size")).alias("taken"), times.alias("times"))
