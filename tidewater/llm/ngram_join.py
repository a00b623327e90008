"""N-gram Jaccard join of documents: MinHash LSH forest, then exact sets.

* A document is the set of its runs of ``size`` words (all its words, if fewer).
  Documents of equal sets are one class from the start.
* Each class has a signature of ``trees`` sequences of ``max_depth`` labels (16
  bits of a minimum each). A tree is the trie of its sorted sequences, a node a
  prefix that several classes share. The forest is one table, sorted by tree and
  sequence, of the sequences that share their first ``min_depth`` labels.
* The first round matches whole sequences; each further round shortens the
  matched prefix by one label. A round verifies just the pairs that meet at its
  length and at no greater one, in the first tree where they do: a pair is seen
  once, nodes of the same members are one, and what only a chain of nodes joins
  is never compared. The labels alone tell which members have such a pair; only
  their sets are read and moved.
* Verification is exact, by the sets, in tiles of bounded size: a node is dealt
  to length classes (sets whose sizes differ by more than the threshold allows
  cannot pass) and hashed tiles, and every pair of tiles is a task of its own.
  Shingles of few documents are counted pair by pair, the others by a matrix
  product. A tile gives back counts and a spanning forest, not pairs.
* Rounds end when the links found so far show the target recall: of the links
  less than ``MARGIN`` above the threshold, those that meet in one tree only and
  in two only at the present length tell by Chao's estimate how many meet in none.
  One link more is assumed of the first kind, so that few links never
  end the rounds; then ``min_depth`` does.

Recall: at ``min_depth`` a pair at the threshold meets in no tree with a
probability of 3 in a million.

Defined results: documents without words (null, empty, punctuation) link with
nothing; repeated rows are copies of each other; a null id sorts last; an empty
table gives an empty result; columns besides id and text are not read, and may
have any names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import SubstringHash, discard, free_names, lean, mix64, narrowed, prepare, slices, stage, word_texts
from tidewater.llm.components import connected_components
from tidewater.llm.sorted_files import open_sorted, write_sorted

SIZE, THRESHOLD = 5, 0.8
TREES, MAX_DEPTH, MIN_DEPTH, TARGET = 32, 8, 5, 0.9999
#: Links that are less than this above the threshold tell the recall.
MARGIN = 0.05
#: Documents and shingles of a tile, bytes of words hashed at once.
TILE_DOCS, TILE_SHINGLES, SLICE_BYTES = 2048, 2_000_000, 1 << 20
#: A shingle of more documents of a tile is counted by matrix product.
DENSE_FROM, DENSE_COLUMNS = 32, 1024


def missed_links(once: int, twice: int, trees: int) -> float:
    """Chao's estimate of the links that meet in no tree, from those that meet in
    one and in two; one more of the first kind is assumed."""
    return (trees - 1) / max(trees, 1) * (once + 1) ** 2 / (2 * (twice + 1))


def shingle_runs(column: pa.Array, size: int):
    """(rows, hashes, starts): rows that have words, the hashes of their word
    runs one row after another, and each row's first place in them."""
    texts = word_texts(column)
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths)])
    for a, b in slices(offsets, SLICE_BYTES):
        rows = np.array([i for i in range(a, b) if texts[i]], np.int64)
        if not len(rows):
            continue
        data = np.frombuffer(b" ".join(texts[i] for i in rows), np.uint8)
        blanks = np.flatnonzero(data == 0x20)
        begin, end = np.concatenate([[0], blanks + 1]), np.concatenate([blanks, [len(data)]])
        words = np.fromiter((texts[i].count(b" ") + 1 for i in rows), np.int64, len(rows))
        first = np.cumsum(words) - words
        runs = np.maximum(words - size + 1, 1)
        starts = np.cumsum(runs) - runs
        at = np.repeat(first - starts, runs) + np.arange(runs.sum())
        last = at + np.repeat(np.minimum(words, size), runs) - 1
        yield rows, SubstringHash(data)(begin[at], end[last]), starts


def set_digest(shingles: np.ndarray) -> int:
    """A 64-bit digest of a set of hashes."""
    return int(mix64(np.array([mix64(shingles).sum(dtype=np.uint64) + np.uint64(len(shingles))])).view(np.int64)[0])


def _as_long(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def forest_labels(hashes: np.ndarray, starts: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """Each row's sequence of labels in every tree: rows x (trees * depth)."""
    factors = mix64(np.arange(1, trees * depth + 1, dtype=np.uint64)) | np.uint64(1)
    labels = np.empty((len(starts), trees * depth), np.uint16)
    scratch = np.empty_like(hashes)
    for at, factor in enumerate(factors):
        np.multiply(hashes, factor, out=scratch)
        labels[:, at] = mix64(np.minimum.reduceat(scratch, starts))  # the low 16 bits
    return labels


def node_hashes(labels: np.ndarray, depth: int) -> np.ndarray:
    """Hashes of the prefixes of this length: rows x trees, from rows x trees x labels."""
    node = np.zeros(labels.shape[:2], np.uint64)
    for level in range(depth):
        node = mix64(node ^ (labels[:, :, level].astype(np.uint64) + np.uint64(1)))
    return node


def meet(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which rows of two matrices of nodes share one in some tree."""
    out = np.zeros((len(left), len(right)), bool)
    for tree in range(left.shape[1]):
        out |= left[:, None, tree] == right[None, :, tree]
    return out


def new_pairs(labels: np.ndarray, left: np.ndarray, right: np.ndarray, tree: int, depth: int) -> np.ndarray:
    """Pairs that share a prefix of this length, in no tree before this one, and
    no longer prefix in any tree."""
    here = node_hashes(labels[:, : tree + 1], depth)
    out = (here[left, None, tree] == here[None, right, tree]) & ~meet(here[left, :tree], here[right, :tree])
    if depth < labels.shape[2] and out.any():
        longer = node_hashes(labels[:, tree:], depth + 1)
        out &= ~meet(longer[left], longer[right])
    return out


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.col(text_column).cast("string")
    return docs.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("tie"), text.alias("text"))


def signatures(rows: DataFrame, size: int, trees: int, depth: int) -> DataFrame:
    """id, tie, digest, n_shingles and labels of every row; null where it has no words."""

    def sign(batches):
        for batch in batches:
            n = batch.num_rows
            digests, counts, labels = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros((n, trees * depth), np.uint16)
            for which, hashes, starts in shingle_runs(batch.column(2), size):
                labels[which] = forest_labels(hashes, starts, trees, depth)
                for i, a, b in zip(which.tolist(), starts.tolist(), [*starts[1:].tolist(), len(hashes)]):
                    own = np.unique(hashes[a:b])
                    counts[i], digests[i] = len(own), set_digest(own)
            ends = np.arange(n + 1, dtype=np.int32) * np.int32(labels.itemsize * trees * depth)
            held = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(labels)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(digests, mask=counts == 0), pa.array(counts), held], ["id", "tie", "digest", "n_shingles", "labels"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(lean(sign), f"id {kind}, tie long, digest long, n_shingles long, labels binary")


def shingle_sets(rows: DataFrame, wanted: tuple, size: int) -> DataFrame:
    """digest and the sorted set of shingle hashes of the rows (key, text) whose
    key is in the sorted table ``wanted``."""

    def sets(batches):
        known = open_sorted(*wanted)
        for batch in batches:
            there, _ = known.find(batch.column(0).to_numpy().view(np.uint64))
            batch = batch.filter(pa.array(there))
            for _, hashes, starts in shingle_runs(batch.column(1), size):
                own = [np.unique(hashes[a:b]) for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(hashes)])]
                ends = np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([set_digest(x) for x in own], pa.int64()), pa.ListArray.from_arrays(ends, pa.array(_as_long(np.concatenate(own))))], ["digest", "shingles"])

    return rows.mapInArrow(lean(sets), "digest long, shingles array<long>")


def shared_counts(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets ``left`` with sets ``right`` (numbers
    into ``sets``), which are the same numbers or have none in common."""
    same, n = left is right, len(sets)
    out = np.zeros((len(left), len(right)), np.float32)
    owner = np.repeat(np.arange(n), [len(x) for x in sets])
    _, code, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row, column = np.full(n, -1), np.full(n, -1)
    row[left], column[right] = np.arange(len(left)), np.arange(len(right))
    order = np.argsort(code, kind="stable")
    owner, first = owner[order], np.cumsum(often) - often
    for k in range(2, min(DENSE_FROM, int(often.max())) + 1):
        groups = first[often == k]
        x, y = np.triu_indices(k, 1)
        step = max(1, 2_000_000 // len(x))
        for g in range(0, len(groups), step):
            held = owner[groups[g : g + step, None] + np.arange(k)]
            i, j = held[:, x].ravel(), held[:, y].ravel()
            if not same:
                swap = row[i] < 0
                i, j = np.where(swap, j, i), np.where(swap, i, j)
                crossing = (row[i] >= 0) & (column[j] >= 0)
                i, j = i[crossing], j[crossing]
            np.add.at(out, (row[i], column[j]), 1)
    heavy = np.flatnonzero(often > DENSE_FROM)
    for g in range(0, len(heavy), DENSE_COLUMNS):
        matrix = np.zeros((n, min(DENSE_COLUMNS, len(heavy) - g)), np.float32)
        for c, k in enumerate(heavy[g : g + DENSE_COLUMNS]):
            matrix[owner[first[k] : first[k] + often[k]], c] = 1
        out += matrix[left] @ matrix[right].T
    return np.triu(out, 1) + np.triu(out, 1).T if same else out


def sides(on_left: np.ndarray, on_right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the left and right sets of a pair of tiles: the same or disjoint."""
    left = np.flatnonzero(on_left)
    return left, left if (on_left & on_right).any() else np.flatnonzero(on_right)


def verify_tile(sets: list[np.ndarray], copies: np.ndarray, left: np.ndarray, right: np.ndarray, wanted: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each set of a pair of tiles: documents linked with it (copies counted),
    and the least set that links inside these tiles reach; then the pairs that
    link by less than ``MARGIN`` above the threshold. Only wanted pairs link."""
    n, same = len(sets), left is right
    links, root = np.zeros(n, np.int64), np.arange(n)
    if not len(left) or not len(right):
        return links, root, np.zeros((0, 2), np.int64)
    sizes = np.array([len(x) for x in sets], np.float64)
    shared = shared_counts(sets, left, right).astype(np.float64)
    alike = shared / (sizes[left][:, None] + sizes[right][None, :] - shared)
    linked = wanted & (shared > 0) & (alike >= threshold)
    near = np.argwhere(linked & (alike < threshold + MARGIN))
    near = np.stack([left[near[:, 0]], right[near[:, 1]]], axis=1)
    if same:
        near = near[near[:, 0] < near[:, 1]]
    links[left] += linked @ copies[right]
    if not same:
        links[right] += linked.T @ copies[left]
    while True:  # least reachable set: minima over links, then pointers doubled
        low = np.where(linked, root[right][None, :], n).min(1)
        new = root.copy()
        np.minimum.at(new, left, low)
        low = np.where(linked, root[left][:, None], n).min(0)
        np.minimum.at(new, right, low)
        new = new[new]
        if (new == root).all():
            return links, root, near
        root = new


def tally(labels: np.ndarray, pairs: np.ndarray, depths: range) -> list[int]:
    """The number of pairs, then of each length those that share a prefix of it in
    one tree only and in two only."""
    out = [len(pairs)]
    for depth in depths:
        node, seen = node_hashes(labels, depth), np.zeros(labels.shape[1] + 2, np.int64)
        for a in range(0, len(pairs), 100_000):
            i, j = pairs[a : a + 100_000].T
            seen += np.bincount((node[i] == node[j]).sum(1), minlength=len(seen))
        out += [int(seen[1]), int(seen[2])]
    return out


def _forest(classes: DataFrame, trees: int, max_depth: int, min_depth: int) -> DataFrame:
    """tree, path, digest and n_shingles of the sequences that share their first
    ``min_depth`` labels with another's, sorted by tree and path."""
    wide = 2 * max_depth
    paths = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda k: F.substring("labels", k * wide + 1, F.lit(wide)))
    placed = classes.select("digest", "n_shingles", F.posexplode(paths).alias("tree", "path"))
    placed = placed.withColumn("floor", F.xxhash64("tree", F.substring("path", 1, 2 * min_depth)))
    shared = placed.groupBy("floor").agg(F.count("*").alias("n")).where("n > 1").select("floor")
    held = placed.join(shared, "floor").select("tree", "path", "digest", "n_shingles")
    return stage(stage(narrowed(held), "paths").repartitionByRange("tree", "path", "digest").sortWithinPartitions("tree", "path", "digest"), "forest")


def _nodes(forest: DataFrame, depth: int, first: bool) -> DataFrame:
    """component (a node), tree, digest and n_shingles of the members of the nodes of
    this length that may hold new pairs, one node of those with the same members."""
    prefix = F.substring("path", 1, 2 * depth)
    longer = F.substring("path", 1, 2 * depth + 2)
    nodes = forest.groupBy("tree", prefix.alias("prefix")).agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("digest")).alias("who"), F.bit_xor(F.xxhash64("digest", F.lit(1))).alias("also"), F.min(longer).alias("low"), F.max(longer).alias("high"))
    nodes = nodes.where("n > 1" if first else "n > 1 and low <> high")
    once = nodes.groupBy("n", "who", "also").agg(F.min(F.struct("tree", "prefix")).alias("node")).select("node.*")
    return forest.withColumn("prefix", prefix).join(once, ["tree", "prefix"]).select(F.xxhash64("tree", "prefix").alias("component"), "tree", "digest", "n_shingles")


def _tiles(members: DataFrame, threshold: float) -> DataFrame:
    """Deal members (digest, n_shingles, component, tree) to pairs of tiles."""
    # Any step of at least -log(threshold) keeps linked sets in neighbouring levels.
    step = max(-math.log(threshold), 0.05)
    level = F.floor(F.log(F.col("n_shingles").cast("double")) / F.lit(step)).cast("int")
    members = members.withColumn("level", level)
    weigh = F.ceil(F.greatest(F.sum("n") / F.lit(TILE_DOCS), F.sum("weight") / F.lit(TILE_SHINGLES))).cast("int")
    levels = members.groupBy("component", "level").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("weight"))
    per_level = levels.groupBy("component", "level").agg(weigh.alias("tiles"))
    # A component has as many levels as the logarithm of its largest set: a short list.
    whole = levels.groupBy("component").agg(weigh.alias("all_tiles")).join(
        per_level.groupBy("component").agg(F.map_from_entries(F.collect_list(F.struct("level", "tiles"))).alias("tiles")), "component")
    dealt = members.join(whole, "component")
    own = F.concat_ws(".", F.lpad(F.col("level").cast("string"), 3, "0"), F.lpad(F.pmod(F.col("digest"), F.col("tiles")[F.col("level")]).cast("string"), 9, "0"))

    def others(step: int) -> Column:
        at = F.col("level") + step
        n = F.coalesce(F.col("tiles")[at], F.lit(0))
        names = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda k: F.concat_ws(".", F.lpad(at.cast("string"), 3, "0"), F.lpad((k - 1).cast("string"), 9, "0")))
        return F.when(n > 0, names).otherwise(F.array().cast("array<string>"))

    pairs = F.when(F.col("all_tiles") <= 1, F.array(F.struct(F.lit("").alias("low"), F.lit("").alias("high"), F.lit(True).alias("on_left"), F.lit(True).alias("on_right")))).otherwise(
        F.transform(F.concat(others(-1), others(0), others(1)), lambda x: F.struct(
            F.least(F.col("own"), x).alias("low"), F.greatest(F.col("own"), x).alias("high"), (F.col("own") <= x).alias("on_left"), (F.col("own") >= x).alias("on_right"))))
    return dealt.withColumn("own", own).select("digest", "component", "tree", F.inline(pairs))


def _beside(places: DataFrame, classes: DataFrame) -> DataFrame:
    """``places`` with the columns of their class. A class has places in many trees
    and tiles: it is joined once with all of them, and they part again behind the join."""
    held = places.groupBy("digest").agg(F.collect_list(F.struct(*(c for c in places.columns if c != "digest"))).alias("places"))
    return held.join(classes, "digest").select(*classes.columns, F.inline("places"))


def _links(rows: DataFrame, classes: DataFrame, size: int, threshold: float, trees: int, max_depth: int, min_depth: int, target: float) -> DataFrame:
    """digest, links and root, once for each tile that a class stands in."""
    forest = _forest(classes, trees, max_depth, min_depth)
    # Of the classes only those of the forest are joined, round by round.
    classes = stage(narrowed(classes.join(forest.select("digest").distinct(), "digest", "left_semi")), "forest-classes")
    place = "digest long, component long, tree int, low string, high string, on_left boolean, on_right boolean"

    def side_arrays(tile: pa.Table) -> tuple:
        labels = np.frombuffer(b"".join(tile["labels"].to_pylist()), np.uint16).reshape(-1, trees, max_depth)
        return labels, *sides(*(np.array(tile[x].to_pylist(), bool) for x in ("on_left", "on_right")))

    def find(depth: int):
        def run(tile: pa.Table) -> pa.Table:
            labels, left, right = side_arrays(tile)
            new, held = new_pairs(labels, left, right, tile["tree"][0].as_py(), depth), np.zeros(len(labels), bool)
            if left is right:
                np.fill_diagonal(new, False)
            held[left[new.any(1)]] = True
            held[right[new.any(0)]] = True
            return tile.drop(["labels"]).filter(pa.array(held))

        return run

    def verify(depth: int):
        def run(tile: pa.Table) -> pa.Table:
            digests, lists = tile["digest"].to_numpy(), tile["shingles"].combine_chunks()
            flat, ends = lists.flatten().to_numpy().view(np.uint64), np.concatenate([[0], np.cumsum(np.diff(lists.offsets.to_numpy()))])
            sets = [flat[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            labels, left, right = side_arrays(tile)
            new = new_pairs(labels, left, right, tile["tree"][0].as_py(), depth)
            links, root, near = verify_tile(sets, tile["n_copies"].to_numpy(), left, right, new, threshold)
            seen = [tally(labels, near, range(min_depth, depth + 1))] + [None] * (len(digests) - 1)
            return pa.table({"digest": digests, "links": links, "root": digests[root], "seen": pa.array(seen, pa.list_(pa.int64()))})

        return run

    found, known = None, np.zeros(1 + 2 * (max_depth - min_depth + 1), np.int64)
    for depth in range(max_depth, min_depth - 1, -1):
        members = stage(narrowed(_nodes(forest, depth, depth == max_depth)), "members")
        dealt = _beside(_tiles(members, threshold), classes.select("digest", "labels"))
        dealt = dealt.select("digest", "component", "tree", "low", "high", "on_left", "on_right", "labels")
        active = stage(narrowed(dealt.groupBy("component", "low", "high").applyInArrow(find(depth), place), dealt=True), "active")
        discard(members)
        # The sets of these classes' first rows; the texts stay where they are.
        here = classes.join(active.select("digest").distinct(), "digest", "left_semi")
        wanted = write_sorted(here.select(F.xxhash64("rep.id", "rep.tie").alias("key")))
        sets = shingle_sets(rows.select(F.xxhash64("id", "tie").alias("key"), "text"), wanted, size).dropDuplicates(["digest"])
        tiles = _beside(active, sets.join(classes.select("digest", "n_copies", "labels"), "digest"))
        new = stage(narrowed(tiles.groupBy("component", "low", "high").applyInArrow(verify(depth), "digest long, links long, root long, seen array<long>"), dealt=True), "verified")
        discard(active)
        found = new if found is None else found.union(new)
        at = 1 + 2 * (depth - min_depth)
        sums = new.agg(*(F.coalesce(F.sum(F.col("seen")[i]), F.lit(0)) for i in range(at + 2))).first()
        known[: at + 2] += np.array(sums, np.int64)
        missed = missed_links(int(known[at]), int(known[at + 1]), trees)
        if known[0] / (known[0] + missed) >= target:
            break
    discard(forest)
    discard(classes)
    return found.select("digest", "links", "root")


def jaccard_classes(docs: DataFrame, size: int = SIZE, threshold: float = THRESHOLD, trees: int = TREES, max_depth: int = MAX_DEPTH, min_depth: int = MIN_DEPTH, target: float = TARGET,
                    id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, tie (hash of the text), class_id (least
    id that links reach, itself included), n_links (other rows linked directly,
    copies included) and kept (it is the class's one row to keep)."""
    prepare(docs.sparkSession)
    rows = _keyed(docs, id_column, text_column)
    signed = stage(signatures(rows, size, trees, max_depth), "signatures")
    row_key = F.struct(F.col("id").isNull().alias("absent"), "id", "tie")
    classes = signed.where("digest is not null").groupBy("digest").agg(
        F.count("*").alias("n_copies"), F.min(row_key).alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("labels").alias("labels"))
    classes = stage(narrowed(classes), "classes")

    found = _links(rows, classes, size, threshold, trees, max_depth, min_depth, target)
    joined = connected_components(found.select(F.col("digest").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("digest").agg(F.sum("links").alias("links"))
    merged = classes.select("digest", "rep").join(joined.withColumnRenamed("node", "digest"), "digest")
    least = merged.groupBy("component").agg(F.min("rep").alias("least"))
    reached = merged.select("digest", "component").join(least, "component").select("digest", "least")
    known = classes.select("digest", "n_copies", "rep").join(links, "digest", "left").join(reached, "digest", "left")
    known = known.select(F.col("digest").alias("key"), (F.col("n_copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("least", "rep").alias("least"))
    # A row without words has a key of its own, so that such rows do not meet in one task.
    keyed = signed.select("id", "tie", F.coalesce("digest", F.xxhash64("id", "tie")).alias("key"), F.col("digest").isNull().alias("wordless"))
    out = keyed.join(known, "key", "left")
    alone = F.col("wordless") | F.col("least").isNull()
    return out.select(
        F.col("id").alias(id_column), "tie", F.when(alone, F.col("id")).otherwise(F.col("least.id")).alias("class_id"),
        F.when(alone, 0).otherwise(F.col("n_links")).cast("long").alias("n_links"),
        (alone | (row_key == F.col("least"))).alias("kept"))


def keep_one(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs``, one of each class: the one of the least id (rows equal
    in id and text are one row). All columns pass through unchanged."""
    tie, gone_id, gone_tie = free_names(docs.columns, "__tie", "__gone_id", "__gone_tie")
    gone = jaccard_classes(docs, **how).where("not kept").select(F.col("doc_id").alias(gone_id), F.col("tie").alias(gone_tie)).distinct()
    tied = docs.withColumn(tie, F.xxhash64(F.col("text").cast("string")))
    left = tied.join(gone, F.col("doc_id").eqNullSafe(F.col(gone_id)) & (F.col(tie) == F.col(gone_tie)), "left_anti")
    return left.dropDuplicates(["doc_id", tie]).drop(tie)
