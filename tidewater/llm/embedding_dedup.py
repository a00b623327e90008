"""Near-duplicate vectors by int8 tile products with rigorous error bounds.

* Vectors are compared inside their label (and length). Equal vectors are one
  class from the start, so a vector that is very common costs one row.
* Unit vectors x, y with cosine >= t differ by at most ``sqrt(2 - 2t)`` along
  every direction. A label of n vectors is cut along k fixed orthonormal
  directions into cells of that width, with k growing as the logarithm of n, and
  only neighbouring cells are compared. This loses no pair.
* Cells are dealt to hashed tiles of bounded size, and each pair of tiles is a
  task of its own: unit vectors are quantised to int8 with a scale of their own,
  ``x = s q + e``, and the tile product of the codes gives
  ``|x.y - s s' q.q'| <= |e| + |e'| (1 + |e|)``. Only pairs whose upper bound
  reaches the threshold are recomputed in double precision.
* A tile gives back link counts and a spanning forest, not pairs.

Defined results: a vector that is null, empty, zero or has null or non-finite
components, or whose label is null, links with nothing and is a component of its
own; repeated rows are other vectors that are equal; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from tidewater.llm.common import prepare, stage
from tidewater.llm.components import connected_components

THRESHOLD = 0.98
#: Vectors of a tile; directions at most; cells that a direction is taken to make.
TILE, MAX_DIRECTIONS, CELLS = 1024, 6, 5
#: Dimensions whose int8 products sum exactly in single precision (127**2 * 1024 < 2**24).
EXACT_DIMENSIONS = 1024
PAIRS_AT_ONCE = 32_768


def directions(dimension: int) -> np.ndarray:
    """Fixed orthonormal directions, one in each column."""
    k = min(dimension, MAX_DIRECTIONS)
    return np.linalg.qr(np.random.default_rng(dimension).standard_normal((dimension, k)))[0]


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by the largest component first, so that nothing overflows."""
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def quantise(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales and the length of each row's quantisation error."""
    scale = np.abs(units).max(1) / 127
    codes = np.rint(units / scale[:, None]).astype(np.int8)
    error = np.linalg.norm(units - codes * scale[:, None], axis=1)
    return codes, scale, error + 1e-12


def upper_bounds(a: tuple, b: tuple) -> np.ndarray:
    """Upper bounds of the cosines of all rows of ``a`` with all rows of ``b``."""
    (p, s, e), (q, t, f) = a, b
    product = np.zeros((len(p), len(q)))
    for k in range(0, p.shape[1], EXACT_DIMENSIONS):
        product += p[:, k : k + EXACT_DIMENSIONS].astype(np.float32) @ q[:, k : k + EXACT_DIMENSIONS].astype(np.float32).T
    product *= s[:, None] * t[None, :]
    product += e[:, None] + f[None, :] * (1 + e[:, None])
    return product


def exact_cosines(vectors: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", vectors[i], vectors[j])


def linked_pairs(units: np.ndarray, left: np.ndarray, right: np.ndarray, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row numbers) whose cosine reaches the threshold."""
    codes, scale, error = quantise(units)
    bounds = upper_bounds(*((codes[x], scale[x], error[x]) for x in (left, right)))
    i, j = np.nonzero(bounds >= threshold)
    if same:
        i, j = i[i < j], j[i < j]
    i, j = left[i], right[j]
    linked = np.concatenate([np.zeros(0, bool), *(exact_cosines(units, i[k : k + PAIRS_AT_ONCE], j[k : k + PAIRS_AT_ONCE]) >= threshold for k in range(0, len(i), PAIRS_AT_ONCE))])
    return i[linked], j[linked]


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least row that links reach from each row."""
    root = np.arange(n)
    while len(i):
        new = root.copy()
        np.minimum.at(new, i, root[j])
        np.minimum.at(new, j, root[i])
        new = new[new]
        if (new == root).all():
            break
        root = new
    return root


def _project(vectors: DataFrame, width: float) -> DataFrame:
    """Add each vector's cell numbers along the fixed directions."""

    def project(batches):
        at: dict[int, np.ndarray] = {}
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("vector"))
            ends = lists.offsets.to_numpy()
            flat, ends = lists.values.to_numpy(zero_copy_only=False), ends
            cells = []
            for a, b in zip(ends[:-1], ends[1:]):
                if b - a not in at:
                    at[b - a] = directions(int(b - a))
                cells.append(np.floor(unit(flat[None, a:b]) @ at[b - a] / width)[0].astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.list_(pa.int32()))], [*batch.schema.names, "cells"])

    return vectors.mapInArrow(project, StructType([*vectors.schema.fields, StructField("cells", ArrayType(IntegerType()))]))


def near_vectors(embeddings: DataFrame, threshold: float = THRESHOLD, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label") -> DataFrame:
    """One row per vector: its id, n_links (other vectors linked directly),
    component_id (least id that links reach) and kept (id = component_id)."""
    prepare(embeddings.sparkSession)
    vector = F.transform(F.col(vector_column), lambda x: x.cast("double"))
    rows = embeddings.select(F.col(id_column).alias("id"), F.col(label_column).alias("label"), vector.alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.coalesce(F.col("label").isNotNull() & finite & F.exists("vector", lambda x: x != 0), F.lit(False))
    digest = F.xxhash64("label", "vector")
    distinct = rows.where(usable).groupBy("label", "vector").agg(F.count("*").alias("n_copies"), F.min("id").alias("rep"))
    distinct = distinct.select(digest.alias("digest"), "label", "vector", "n_copies", "rep", F.size("vector").alias("dimension"))
    width = float(np.sqrt(max(0.0, 2 - 2 * threshold)) * (1 + 1e-6) + 1e-9)
    classes = stage(_project(distinct, width), "vectors")

    # The more vectors of a label, the more directions its cells are cut along.
    many = F.floor(F.log(F.col("n") / F.lit(float(TILE))) / F.lit(float(np.log(CELLS)))).cast("int")
    groups = classes.groupBy("label", "dimension").agg(F.count("*").alias("n"))
    groups = groups.withColumn("cut", F.greatest(F.lit(0), F.least(many, F.lit(MAX_DIRECTIONS), F.col("dimension"))))
    placed = classes.select("digest", "label", "dimension", "cells").join(groups, ["label", "dimension"])
    group = F.concat_ws("|", F.col("label").cast("string"), F.col("dimension").cast("string"))
    taken = F.slice("cells", F.lit(1), F.col("cut"))
    own = F.aggregate(taken, group, lambda name, c: F.concat(name, F.lit("|"), c.cast("string")))
    near = F.aggregate(taken, F.array(group), lambda names, c: F.flatten(F.transform(
        F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.transform(names, lambda name: F.concat(name, F.lit("|"), (c + d).cast("string"))))))
    placed = stage(placed.select("digest", own.alias("cell"), near.alias("near")), "cells")
    tiles = placed.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(TILE)).cast("int").alias("tiles"))

    def name(cell, k):
        return F.concat_ws("#", cell, F.lpad(k.cast("string"), 9, "0"))

    mine = placed.join(tiles, "cell").select("digest", "near", name(F.col("cell"), F.pmod("digest", "tiles")).alias("own"))
    met = mine.select("digest", "own", F.explode("near").alias("cell")).join(tiles, "cell")
    met = met.select("digest", "own", F.explode(F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda k: name(F.col("cell"), k))).alias("other"))
    dealt = met.select("digest", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), (F.col("own") <= F.col("other")).alias("on_left"))

    def verify(tile: pa.Table) -> pa.Table:
        tile = tile.combine_chunks()
        digests, copies = tile["digest"].to_numpy(), tile["n_copies"].to_numpy()
        units = unit(tile["vector"].combine_chunks().flatten().to_numpy().reshape(len(digests), -1))
        same = tile["low"][0] == tile["high"][0]
        on_left = np.array(tile["on_left"].to_pylist(), bool)
        left = np.arange(len(digests)) if same else np.flatnonzero(on_left)
        i, j = linked_pairs(units, left, left if same else np.flatnonzero(~on_left), same, threshold)
        links = np.bincount(i, copies[j], len(digests)) + np.bincount(j, copies[i], len(digests))
        return pa.table({"digest": digests, "links": links.astype(np.int64), "root": digests[forest(len(digests), i, j)]})

    full = dealt.join(classes.select("digest", "vector", "n_copies"), "digest")
    found = stage(full.groupBy("low", "high").applyInArrow(verify, "digest long, links long, root long"), "verified")
    joined = connected_components(found.select(F.col("digest").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "digest")
    known = classes.select("digest", "rep", "n_copies")
    least = known.join(joined, "digest").groupBy("component").agg(F.min("rep").alias("least"))
    reached = joined.join(least, "component").select("digest", "least")
    known = known.join(found.groupBy("digest").agg(F.sum("links").alias("links")), "digest", "left").join(reached, "digest", "left")
    known = known.select(F.col("digest").alias("key"), (F.col("n_copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("least", "rep").alias("least"))
    # A vector that cannot be compared has a key of its own, so that such rows do not meet in one task.
    keyed = rows.select("id", F.when(usable, digest).otherwise(F.xxhash64("id", F.lit("alone"))).alias("key"), usable.alias("usable"))
    out = keyed.join(known, "key", "left").withColumn("own", F.when(F.col("usable"), F.col("least")).otherwise(F.col("id")))
    return out.select(F.col("id").alias(id_column), F.when(F.col("usable"), F.col("n_links")).otherwise(0).cast("long").alias("n_links"),
                      F.col("own").cast("long").alias("component_id"), F.coalesce(F.col("id") == F.col("own"), F.lit(False)).alias("kept"))
