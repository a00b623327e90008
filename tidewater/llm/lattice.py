"""Sampled SentencePiece segmentation by forward filtering, backward sampling.

A text's piece lattice has a node at each character boundary and an edge for each
piece that spells what lies between two nodes; a character without a piece of its
own has an edge of byte pieces. A path's probability is proportional to the
product of its edges' weights to the power ``alpha``. Forward filtering sums the
weights of all paths to each node; backward sampling walks from the end, drawing
each incoming edge by its share of the node's sum, so every path is drawn with
its probability. ``alpha`` 0 is uniform over paths; a large one nears the best.

Weights: the model ranks its pieces by merges and holds no probabilities, so a
piece of rank r weighs ``1 / (r + 10)`` (Zipf's law).

Draws are hashes of the seed, the row's key, the number of the chunk in its text
and the number of the step, so a row's segmentation does not depend on batches,
partitions or retries, and equal rows are segmented alike.

No piece of the model joins a blank to what stands before it (this is checked),
so texts are cut there into chunks, each distinct chunk's lattice is built once,
and all chunks of a slice walk back together as arrays. A text of any length is
handled in slices of bounded size.

Encoding escapes blanks as the model does, with one blank in front of a text; an
escape sign that a text itself holds goes to byte pieces. Decoding is therefore
lossless for any text.

Defined results: a null or empty text has no pieces and decodes to the empty
text; a null key is a key of its own; repeated rows are encoded alike; an empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from tidewater.llm.common import GOLDEN, SubstringHash, free_names, kept, map_rows, mix64, prepare, quoted, slices, utf8

#: Fixed value: the sign that stands for a blank in pieces.
ESCAPE = "▁"
#: What a text's own escape sign becomes inside the lattice: no piece spells it.
FOREIGN = 0x110000
ALPHA, SEED, RANK_OFFSET = 1.0, 20_240, 10
SLICE_BYTES, MEMO_NODES = 1 << 17, 500_000
#: Bytes of texts whose rows go back to Spark at once (a longer text alone).
OUT_BYTES = 1 << 20
#: Draws and the bounds that they are held against are integers of so many bits.
DRAW_BITS = 30
#: Marks that a word may be cut off from, where no piece joins a letter to them.
MARKS = ".,;:!?*%$&#|"


def draws(keys: np.ndarray, chunk: np.ndarray, step: int) -> np.ndarray:
    """Uniform draws of ``DRAW_BITS`` bits of the given rows' keys, chunk numbers and step."""
    with np.errstate(over="ignore"):
        x = mix64(keys + chunk.astype(np.uint64) * np.uint64(GOLDEN))
        x = mix64(x + np.uint64(step * GOLDEN % 2**64))
    return (x >> np.uint64(64 - DRAW_BITS)).astype(np.uint32)


def row_keys(ids: np.ndarray, seed: int) -> np.ndarray:
    return mix64(mix64(ids.astype(np.int64).view(np.uint64)) ^ np.uint64(seed))


class Pieces:
    """What the lattice needs of a model: spellings, weights and byte pieces."""

    def __init__(self, path: str, alpha: float):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.surface = [b""] * n  # what a piece decodes to
        byte_ids, spelled = {}, {}
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                self.surface[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                spelled[piece] = i
                self.surface[i] = piece.replace(ESCAPE, " ").encode()
        if len(byte_ids) < 256:
            raise ValueError("the model has no byte pieces, so it cannot spell every text")
        if any("\n" in p or ESCAPE in p.lstrip(ESCAPE) for p in spelled):
            raise ValueError("a piece of the model joins a blank or line feed to what stands before it")
        self.byte_ids = np.array([byte_ids[b] for b in range(256)])
        rank = {i: min(-model.get_score(i), n) for i in spelled.values()}
        self.log_weight = np.full(n, -alpha * np.log(n + RANK_OFFSET))
        for i, r in rank.items():
            self.log_weight[i] = -alpha * np.log(r + RANK_OFFSET)
        self.spelled = spelled
        self.longest = max(map(len, spelled))
        letters = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
        joined = {b for p in spelled for a, b in zip(p, p[1:]) if a in letters}
        self.marks = "".join(x for x in MARKS if x not in joined)
        # By length, the hashes of what begins a piece, and the piece that it is (else -1).
        begins: dict[int, dict] = {}
        for piece in spelled:
            for n in range(1, len(piece) + 1):
                begins.setdefault(n, {}).setdefault(piece[:n], spelled.get(piece[:n], -1))
        self.tables = {}
        for n, rows in begins.items():
            codes = np.array([[ord(c) for c in p] for p in rows], np.uint32)
            flat, at = SubstringHash(codes.ravel()), np.arange(len(rows)) * n
            hashes, ids = flat(at, at + n), np.array(list(rows.values()))
            order = np.argsort(hashes)
            self.tables[n] = hashes[order], ids[order]

    def at(self, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Of hashed spellings of one length: whether they begin a piece, and the piece that they are (else -1)."""
        known, ids = self.tables[length]
        k = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        begins = known[k] == hashes
        return begins, np.where(begins, ids[k], -1)


class Column:
    """An array that grows at its end."""

    def __init__(self, kind):
        self.array, self.n = np.zeros(1024, kind), 0

    def append(self, values: np.ndarray) -> None:
        if self.n + len(values) > len(self.array):
            grown = np.zeros(max(2 * len(self.array), self.n + len(values)), self.array.dtype)
            grown[: self.n] = self.array[: self.n]
            self.array = grown
        self.array[self.n : self.n + len(values)] = values
        self.n += len(values)


class Lattices:
    """Filtered lattices of distinct chunks, in arrays that all chunks share."""

    def __init__(self, path: str, alpha: float):
        self.pieces = Pieces(path, alpha)
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.first, self.last = Column(np.int32), Column(np.int32)  # nodes of a chunk
        self.begin = Column(np.int32)  # first edge into a node
        self.bound = Column(np.uint32)  # cumulated share of an edge among those into its node
        self.origin = Column(np.int32)  # node that an edge comes from
        self.token_at, self.token_n = Column(np.int32), Column(np.int32)
        self.tokens = Column(np.int32)
        self.nodes = 0

    def add(self, chunks: list[str]) -> None:
        """Build and filter the lattices of new chunks, all at once."""
        codes = np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32).copy()
        codes[codes == ord(ESCAPE)] = FOREIGN
        codes[codes == 0x20] = ord(ESCAPE)
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        start = np.cumsum(sizes) - sizes
        chunk = np.repeat(np.arange(len(chunks)), sizes)
        stop = np.repeat(start + sizes, sizes)
        n, hashed = len(codes), SubstringHash(codes)
        sources, lengths, ids, at = [], [], [], np.arange(n)
        for length in range(1, self.pieces.longest + 1):
            at = at[at + length <= stop[at]]
            begins, found = self.pieces.at(hashed(at, at + length), length)
            hit = (found >= 0) | (length == 1)  # a character without a piece goes by its bytes
            sources.append(at[hit])
            lengths.append(np.full(int(hit.sum()), length))
            ids.append(found[hit])
            at = at[begins]
            if not len(at):
                break
        source, length, piece = (np.concatenate(x) for x in (sources, lengths, ids))
        # Nodes of a chunk of m characters are m + 1 numbers in a row.
        origin = source + chunk[source]
        target = origin + length
        own_bytes = np.array([len(chr(c).encode()) if c != FOREIGN else 3 for c in codes[source[piece < 0]]], np.int64)
        weight = self.pieces.log_weight[np.maximum(piece, 0)]
        weight[piece < 0] = own_bytes * self.pieces.log_weight[self.pieces.byte_ids[0]]
        order = np.lexsort((length, target))
        source, piece, origin, target, weight = (x[order] for x in (source, piece, origin, target, weight))
        self._filter(origin, target, weight, start + np.arange(len(chunks)), sizes)
        # Tokens: one for a piece, the character's bytes for others.
        counts = np.ones(len(piece), np.int64)
        foreign = np.flatnonzero(piece < 0)
        spelled = [ESCAPE.encode() if codes[source[e]] == FOREIGN else chr(codes[source[e]]).encode() for e in foreign]
        counts[foreign] = [len(x) for x in spelled]
        at = np.cumsum(counts) - counts
        tokens = np.empty(int(counts.sum()), np.int32)
        tokens[at[piece >= 0]] = piece[piece >= 0]
        for e, x in zip(foreign, spelled):
            tokens[at[e] : at[e] + len(x)] = self.pieces.byte_ids[list(x)]
        base, low = len(self.place), start + np.arange(len(chunks)) + self.nodes
        self.place.update(zip(chunks, range(base, base + len(chunks))))
        self.first.append(low)
        self.last.append(low + sizes)
        self.token_at.append(at + self.tokens.n)
        self.token_n.append(counts)
        self.tokens.append(tokens)
        self.origin.append(origin + self.nodes)
        self.nodes += n + len(chunks)

    def _filter(self, origin: np.ndarray, target: np.ndarray, weight: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> None:
        """Forward sums of all chunks, one position after another, then the shares."""
        total = np.full(int(sizes.sum()) + len(sizes), -np.inf)
        total[first] = 0
        nodes, begin = np.unique(target, return_index=True)
        depth = nodes - first[np.searchsorted(first, nodes, "right") - 1]
        order = np.argsort(depth, kind="stable")
        bounds = np.searchsorted(depth[order], np.arange(1, int(sizes.max()) + 2))
        end = np.concatenate([begin[1:], [len(target)]])
        value = np.empty(len(target))
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            k = order[a:b]
            n = end[k] - begin[k]
            starts = np.cumsum(n) - n
            edges = np.repeat(begin[k] - starts, n) + np.arange(n.sum())
            reached = total[origin[edges]] + weight[edges]
            top = np.maximum.reduceat(reached, starts)
            share = np.exp(reached - np.repeat(top, n))
            sums = np.add.reduceat(share, starts)
            total[nodes[k]] = top + np.log(sums)
            value[edges] = share / np.repeat(sums, n)
        # Cumulated shares inside each node; the last is one, whatever the rounding.
        run = np.cumsum(value)
        run -= np.repeat(np.where(begin > 0, run[begin - 1], 0), end - begin)
        run[end - 1] = 1
        into = np.zeros(len(total), np.int64)
        into[nodes] = begin
        self.begin.append(into + self.bound.n)
        self.bound.append(np.floor(np.minimum(run, 1) * 2**DRAW_BITS))

    def sample(self, numbers: np.ndarray, keys: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Draw a path for each occurrence of a chunk; (tokens, number of tokens of each)."""
        first, bound = self.first.array[numbers], self.bound.array
        active, node, walk, step = np.arange(len(numbers)), self.last.array[numbers], [], 0
        while len(active):
            draw, edge = draws(keys[active], which[active], step), self.begin.array[node]
            beyond = np.flatnonzero(draw >= bound[edge])
            while len(beyond):
                edge[beyond] += 1
                beyond = beyond[draw[beyond] >= bound[edge[beyond]]]
            walk.append((active, edge))
            node = self.origin.array[edge]
            left = node > first[active]
            active, node, step = active[left], node[left], step + 1
        steps = np.zeros(len(numbers), np.int64)
        for active, _ in walk:
            steps[active] += 1
        ends = np.cumsum(steps)
        path = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
        for k, (active, edge) in enumerate(walk):
            path[ends[active] - 1 - k] = edge
        counts = self.token_n.array[path].astype(np.int64)
        per = np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)])
        at = np.repeat(self.token_at.array[path] - per[:-1], counts) + np.arange(per[-1])
        return self.tokens.array[at], per[ends] - per[ends - steps]

    def numbers(self, data: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """The memo's number of each chunk of ``data``."""
        chunks = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(data))
        coded = chunks.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        place = list(map(self.place.get, distinct))
        missing = [x for x, k in zip(distinct, place) if k is None]
        if missing:
            if self.place and self.nodes + sum(map(len, missing)) + len(missing) > MEMO_NODES:
                self.clear()
                missing = distinct
            self.add(missing)
            place = list(map(self.place.__getitem__, distinct))
        return np.array(place, np.int64)[coded.indices.to_numpy()]

    def encode(self, column: pa.Array, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all rows one after another, and each row's number of ids."""
        whole, offsets = utf8(column)
        out, counts = [], np.zeros(len(keys), np.int64)
        for a, b in slices(offsets, SLICE_BYTES):
            rows = np.array([i for i in range(a, b) if offsets[i] < offsets[i + 1]], np.int64)
            if not len(rows):
                continue
            # A blank in front of every text.
            data = np.frombuffer(b" " + b"\x00 ".join(whole[offsets[i] : offsets[i + 1]].tobytes() for i in rows), np.uint8)
            lengths = offsets[rows + 1] - offsets[rows] + 1
            keep = np.ones(len(data), bool)
            keep[np.cumsum(lengths + 1)[:-1] - 1] = False
            data = np.ascontiguousarray(data[keep])
            ends = np.cumsum(lengths)
            cuts = chunk_cuts(data, np.concatenate([[0], ends]), self.pieces.marks)
            row = np.searchsorted(ends, cuts[:-1], "right")
            first = np.searchsorted(cuts, ends - lengths)
            at = 0
            while at < len(cuts) - 1:  # one round, unless a single text is larger than a slice
                stop = max(at + 1, int(np.searchsorted(cuts, cuts[at] + 2 * SLICE_BYTES, "right")) - 1)
                part = np.ascontiguousarray(data[cuts[at] : cuts[stop]])
                numbers = self.numbers(part, cuts[at : stop + 1] - cuts[at])
                which = np.arange(at, stop) - first[row[at:stop]]
                tokens, n = self.sample(numbers, keys[rows[row[at:stop]]], which)
                out.append(tokens)
                np.add.at(counts, rows[row[at:stop]], n)
                at = stop
        return (np.concatenate(out) if out else np.zeros(0, np.int32)), counts


def chunk_cuts(data: np.ndarray, bounds: np.ndarray, marks: str) -> np.ndarray:
    """Where chunks begin and end: at rows' bounds, before a blank that follows no
    blank, between an ASCII letter and one of ``marks``, and on both sides of a
    line feed (no piece spells one)."""
    is_cut = np.zeros(len(data) + 1, bool)
    is_cut[bounds] = True
    blank, feed = data == 0x20, data == 0x0A
    kind = np.zeros(256, np.uint8)
    kind[np.frombuffer(marks.encode(), np.uint8)] = 1
    kind[0x41:0x5B] = kind[0x61:0x7B] = 2
    is_cut[1:-1] |= (blank[1:] & ~blank[:-1]) | feed[1:] | feed[:-1] | ((kind[data[1:]] == 1) & (kind[data[:-1]] == 2))
    return np.flatnonzero(is_cut)


def lattices(path: str, alpha: float) -> Lattices:
    return kept(("lattice", path, alpha), lambda: Lattices(path, alpha))


def surfaces(path: str) -> list[bytes]:
    return kept(("surface", path), lambda: Pieces(path, 1.0).surface)


def spell(surface: list[bytes], ids: np.ndarray, ends: np.ndarray) -> list[str]:
    """The texts that rows of ids spell (without the blank in front)."""
    return [b"".join([surface[i] for i in ids[a:b].tolist()])[1:].decode(errors="replace") for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def encode(docs: DataFrame, model: str, alpha: float = ALPHA, seed: int = SEED, key_column: str = "doc_id", text_column: str = "text", into: str = "pieces",
           decoded: str | None = None) -> DataFrame:
    """``docs`` with a column ``into`` (array of int): a segmentation of the text
    drawn by the row's key. All other columns pass through unchanged. ``decoded``
    names a column for the text that the pieces spell, decoded in the same pass.
    A column of ``docs`` with just the name of a new one gives way to it."""
    prepare(docs.sparkSession)
    stay = [c for c in docs.columns if c not in (into, decoded)]
    text, names = docs.columns.index(text_column), [*stay, into, *([decoded] if decoded else [])]
    places = [docs.columns.index(c) for c in stay]
    (key,) = free_names(docs.columns, "__key")
    keyed = docs.withColumn(key, F.coalesce(F.xxhash64(quoted(key_column)), F.lit(0)))

    def run(batches):
        built = lattices(model, alpha)
        try:
            for whole in batches:
                for a, b in slices(utf8(whole.column(text))[1], OUT_BYTES):
                    batch = whole.slice(a, b - a)
                    keys = row_keys(batch.column(batch.num_columns - 1).to_numpy(), seed)
                    tokens, counts = built.encode(batch.column(text).cast(pa.large_string()), keys)
                    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                    spelled = [pa.array(spell(built.pieces.surface, tokens, ends), pa.string())] if decoded else []
                    yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in places), pa.ListArray.from_arrays(ends, pa.array(tokens)), *spelled], names)
        finally:
            built.clear()  # the model stays with the worker, the memo goes with the task

    more = [StructField(into, ArrayType(IntegerType())), *([StructField(decoded, StringType())] if decoded else [])]
    return map_rows(keyed, run, StructType([*(docs.schema.fields[i] for i in places), *more]))


def decode(rows: DataFrame, model: str, pieces_column: str = "pieces", into: str = "decoded") -> DataFrame:
    """``rows`` with a column ``into``: the text that the pieces spell."""
    prepare(rows.sparkSession)
    at, stay = rows.columns.index(pieces_column), [c for c in rows.columns if c != into]
    names, places = [*stay, into], [rows.columns.index(c) for c in stay]

    def run(batches):
        surface = surfaces(model)
        for batch in batches:
            lists = batch.column(at)
            flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in places), pa.array(spell(surface, flat, ends), pa.string())], names)

    return map_rows(rows, run, StructType([*(rows.schema.fields[i] for i in places), StructField(into, StringType())]))
