"""Alignment of two tokenizers, with pair counts by external spill counting.

A byte-level BPE (A) and a SentencePiece model (B) encode the same bytes, a
blank and the text. Byte offsets where tokens of both end cut the tokens into
groups; every A token of a group is linked with every B token of it. A pair of
ids counts the documents that hold it linked, over the whole corpus; a link is
best if its count is the highest of its A id.

Method. A map task encodes whole texts and gathers pair-document records (pair,
document, times). When enough are gathered they are sorted side-major (A id
first), radix-partitioned by A id, and written as a zstd run: for each part the
distinct pairs with their number of documents, and the records. A merge task
holds one part: a k-way heap merge over the runs sums each pair; sides come
whole, so the highest count of an A id is known as its pairs pass, and the
counts stream back to each run in the order of its own pairs. With more runs
than ``FAN_IN``, merges form a tree: up with sums, down with the counts. A last
task for each run adds up the counts of its documents' links. Pairs are combined
in the runs before anything is merged, so an A id that stands in a third of all
links has at most one entry per B id and run; records stay in their run.

A document lies in one run as a whole. Memory is bounded by the run size, one
frame per merged run, and one document's distinct pairs. Lost executors cost
tasks: each attempt writes files of its own, and only those named in committed
rows are read. Files lie in the shared folder of the session.

Encoding. Texts are cut at places where both tokenizers must cut (see ``bpe``; no
piece of B may join what stands on both sides, which is checked), so both
tokens end there, groups never cross a cut, and a text's groups are those of its
chunks. Each distinct chunk is encoded and aligned once by a worker's memo.

Defined results: a text that is null, empty, or not given back by either side's
tokens (an escape sign inside it) has zeros, an empty digest, and counts for no
pair; repeated rows are documents of their own; null and repeated ids are
carried along; an empty table gives no rows. Columns besides the id and text
columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.bpe import ChunkEncoder
from tidewater.llm.common import kept, prepare, stage, stage_dir
from tidewater.llm.sorted_files import uri
from tidewater.llm.spill import Reader, Writer, merge

#: Fixed value: the sign that stands for a blank in pieces.
ESCAPE = "▁"
#: Radix parts, records of a run, and runs that one merge opens.
PARTS, RUN_RECORDS, FAN_IN = 32, 2_000_000, 64
PART_BITS = PARTS.bit_length() - 1
#: Bits of a document's number inside its run.
DOC_BITS = 24
SLICE_BYTES, MEMO_CHUNKS = 2 << 20, 250_000
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def byte_alphabet() -> dict[str, int]:
    """The byte of each character of a byte-level vocabulary: printable Latin-1
    stands for itself, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def piece_bytes(piece: str) -> bytes:
    hexed = re.fullmatch("<0x([0-9A-F]{2})>", piece)
    return bytes([int(hexed[1], 16)]) if hexed else piece.replace(ESCAPE, " ").encode()


def expand(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices of all given ranges, one after another."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


class ChunkAligner(ChunkEncoder):
    """Chunks of texts with their counts, pairs and groups, each aligned once."""

    slice_bytes, memo_chunks = SLICE_BYTES, MEMO_CHUNKS

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        super().__init__(a_path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=b_path)
        alphabet, vocabulary = byte_alphabet(), self.tokenizer.get_vocab()
        a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, k in vocabulary.items():
            a_bytes[k] = bytes(map(alphabet.__getitem__, token)) if all(x in alphabet for x in token) else token.encode()
        names = [self.pieces.id_to_piece(k) for k in range(self.pieces.get_piece_size())]
        spelt = [x for k, x in enumerate(names) if not self.pieces.is_control(k) and not self.pieces.is_byte(k) and not self.pieces.is_unknown(k)]
        if any(re.search(f"[^{ESCAPE}]{ESCAPE}|.\n", x) for x in spelt):
            raise ValueError(f"{b_path}: a piece joins a blank or line feed to what stands before it, so texts cannot be cut there")
        self.marks = "".join(x for x in self.marks if not any(re.search(f"[A-Za-z]{re.escape(x)}", p) for p in spelt))
        self.lead = self.pieces.encode("x")
        self.a_bytes, self.b_bytes = pa.array(a_bytes, pa.large_binary()), pa.array(map(piece_bytes, names), pa.large_binary())
        self.a_sizes, self.b_sizes = (pc.binary_length(x).to_numpy().astype(np.int64) for x in (self.a_bytes, self.b_bytes))
        self.b_bits = (len(names) - 1).bit_length()
        self.a_bits = max(PART_BITS, (len(a_bytes) - 1).bit_length())
        ids = pc.cast(pa.array(range(max(len(a_bytes), len(names)))), pa.large_string())
        self.written = pa.concat_arrays([pc.binary_join_element_wise(ids, pa.scalar(x, pa.large_string()), pa.scalar("", pa.large_string())) for x in ",|;"])
        self.n_ids = len(ids)

    @property
    def low_bits(self) -> int:
        return self.b_bits

    def pair_keys(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """64-bit keys, side-major, the A id's radix part on top."""
        a = a.astype(np.uint64)
        return (((a & np.uint64(PARTS - 1)) << np.uint64(self.a_bits - PART_BITS) | a >> np.uint64(PART_BITS)) << np.uint64(self.b_bits)) | b.astype(np.uint64)

    def clear(self) -> None:
        self.place = {}
        self.counts, self.good = np.zeros((0, len(COUNTS)), np.int64), np.zeros(0, bool)
        self.pair_starts, self.pair_counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pairs, self.times = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.groups = pa.array([], pa.large_string())

    def _coded(self, chunks: list[str]):
        """Ids, and number of ids of each chunk, of both sides."""
        a = [x.ids for x in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]
        b = [x[len(self.lead) :] for x in self.pieces.encode(["x" + x for x in chunks], num_threads=1)]
        for coded in (a, b):
            n = np.fromiter(map(len, coded), np.int64, len(coded))
            yield np.fromiter((k for x in coded for k in x), np.int64, int(n.sum())), n

    def _add(self, chunks: list[str], with_ids: bool) -> None:
        spelt = [x.encode() for x in chunks]
        (a, n_a), (b, n_b) = self._coded(chunks)
        good = self._same(spelt, a, n_a, self.a_bytes) & self._same(spelt, b, n_b, self.b_bytes)
        a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
        n_a, n_b = np.where(good, n_a, 0), np.where(good, n_b, 0)
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        common = np.intersect1d(a_ends, b_ends, assume_unique=True)
        a_group, b_group = np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)
        in_a, in_b = np.bincount(a_group, minlength=len(common)), np.bincount(b_group, minlength=len(common))
        chunk_of = np.repeat(np.arange(len(chunks)), n_a)
        group_chunk = np.zeros(len(common), np.int64)
        group_chunk[a_group] = chunk_of
        n_groups = np.bincount(group_chunk, minlength=len(chunks))
        n_links = np.bincount(group_chunk, weights=in_a * in_b, minlength=len(chunks)).astype(np.int64)
        # All links, one A token after another, then the distinct pairs of each chunk.
        width = in_b[a_group]
        linked = expand((np.cumsum(in_b) - in_b)[a_group], width)
        keys, owner = self.pair_keys(np.repeat(a, width), b[linked]), np.repeat(chunk_of, width)
        order = np.lexsort((keys, owner))
        keys, owner = keys[order], owner[order]
        first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])])) if len(keys) else np.zeros(0, np.int64)
        times = np.diff(np.append(first, len(keys)))
        pair_counts = np.bincount(owner[first], minlength=len(chunks))

        number = len(self.place)
        self.place.update(zip(chunks, range(number, number + len(chunks))))
        self.pair_starts = np.concatenate([self.pair_starts, len(self.pairs) + np.cumsum(pair_counts) - pair_counts])
        self.pair_counts = np.concatenate([self.pair_counts, pair_counts])
        self.pairs, self.times = np.concatenate([self.pairs, keys[first]]), np.concatenate([self.times, times])
        self.counts = np.concatenate([self.counts, np.stack([n_a, n_b, n_groups, n_links], 1)])
        self.good = np.concatenate([self.good, good])
        self.groups = pa.concat_arrays([self.groups, self._written(a, b, a_group, b_group, in_a, in_b, n_a + n_b)])

    @staticmethod
    def _same(spelt: list[bytes], ids: np.ndarray, n: np.ndarray, table: pa.Array) -> np.ndarray:
        """Of each chunk whether its tokens' bytes are its own."""
        joined = table.take(pa.array(ids))
        ends = np.frombuffer(joined.buffers()[1], np.int64)[np.concatenate([[0], np.cumsum(n)])] if len(ids) else np.zeros(len(n) + 1, np.int64)
        data = (joined.buffers()[2] or pa.py_buffer(b"")).to_pybytes()
        return np.fromiter((data[i:j] == x for x, i, j in zip(spelt, ends[:-1].tolist(), ends[1:].tolist())), bool, len(spelt))

    def _written(self, a, b, a_group, b_group, in_a, in_b, n) -> pa.Array:
        """Each chunk's groups as ``a1,a2|b1;a3|b2,b3;``."""
        if not len(a):
            return pa.array([""] * len(n), pa.large_string())
        # Tokens in written order: by group, A's before B's.
        start = np.cumsum(in_a + in_b) - in_a - in_b
        a_at = start[a_group] + np.arange(len(a)) - (np.cumsum(in_a) - in_a)[a_group]
        b_at = (start + in_a)[b_group] + np.arange(len(b)) - (np.cumsum(in_b) - in_b)[b_group]
        code = np.empty(len(a) + len(b), np.int64)
        code[a_at], code[b_at] = a, b
        code[start + in_a - 1] += self.n_ids  # "|" after the last A token
        code[start + in_a + in_b - 1] += 2 * self.n_ids  # ";" after the group
        text = self.written.take(pa.array(code))
        ends = np.ascontiguousarray(np.frombuffer(text.buffers()[1], np.int64)[np.concatenate([[0], np.cumsum(n)])])
        return pa.LargeStringArray.from_buffers(len(n), pa.py_buffer(ends), text.buffers()[2])

    def documents_of(self, column: pa.Array):
        """Runs of rows: (row range, counts, pairs as (row, key, times), good, the
        groups' text and its offsets, ends). A row beyond the slice size comes as
        several runs; ``ends`` is set on its last one."""
        texts = pc.fill_null(column.cast(pa.large_string()), "")
        blank = pc.if_else(pc.equal(pc.binary_length(texts), 0), pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string()))
        for a, b, data, offsets, ends in self._slices(pc.binary_join_element_wise(blank, texts, pa.scalar("", pa.large_string()))):
            if not len(data):
                yield a, b, np.zeros((b - a, len(COUNTS)), np.int64), (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)), np.ones(b - a, bool), memoryview(b""), np.zeros(b - a + 1, np.int64), ends
                continue
            numbers, first = self._numbers(data, offsets, True)
            sums = np.concatenate([np.zeros((1, len(COUNTS)), np.int64), np.cumsum(self.counts[numbers], 0)])
            bad = np.concatenate([[0], np.cumsum(~self.good[numbers])])
            row = np.repeat(np.arange(a, b), np.diff(first))
            own, times = np.unique(row << 32 | numbers, return_counts=True)
            row, chunk = own >> 32, own & 0xFFFFFFFF
            width = self.pair_counts[chunk]
            at = expand(self.pair_starts[chunk], width)
            pairs = (np.repeat(row, width), self.pairs[at], self.times[at] * np.repeat(times, width))
            text = self.groups.take(pa.array(numbers))
            places = np.frombuffer(text.buffers()[1], np.int64)[first]
            yield a, b, sums[first[1:]] - sums[first[:-1]], pairs, bad[first[1:]] == bad[first[:-1]], memoryview(text.buffers()[2] or b""), places, ends


class Run:
    """Documents and their pair records until they are written as one run."""

    def __init__(self, low_bits: int, key_bits: int):
        self.low_bits, self.key_bits = low_bits, key_bits
        self.rows, self.records, self.n_records, self.n_docs = [], [], 0, 0

    def add(self, ids: pa.Array, counts: np.ndarray, shas: list[str], records) -> None:
        """Whole documents; records: (document from 0 on, key, times)."""
        self.rows.append(pa.RecordBatch.from_arrays([ids, *map(pa.array, counts.T.copy()), pa.array(shas, pa.string())], ["id", *COUNTS, "groups_sha256"]))
        row, key, times = records
        self.records.append((key << np.uint64(DOC_BITS) | (row + self.n_docs).astype(np.uint64), times))
        self.n_records += len(times)
        self.n_docs += len(ids)

    def write(self, folder: str) -> str:
        both, times = (np.concatenate(x) for x in zip(*self.records))
        order = np.argsort(both)
        both, times = both[order], times[order]
        starts = np.flatnonzero(np.diff(both, prepend=~both[:1]))  # the same pair from several slices or chunks
        both, times = both[starts], np.add.reduceat(times, starts) if len(starts) else times
        keys, docs = both >> np.uint64(DOC_BITS), (both & np.uint64((1 << DOC_BITS) - 1)).astype("<u4")
        heads = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
        sizes, part_bits = np.diff(np.append(heads, len(keys))), np.uint64(self.key_bits - PART_BITS)
        bounds = np.searchsorted(keys[heads] >> part_bits, np.arange(PARTS + 1, dtype=np.uint64))
        out, wide = Writer(folder), np.append(heads, len(keys))
        for part, (i, j) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            out.segment(f"pairs-{part}", keys[heads[i:j]], sizes[i:j], self.low_bits)
            a, b = wide[i], wide[j]
            out.block(f"docs-{part}", docs[a:b].tobytes() + times[a:b].astype("<u4").tobytes(), int(b - a))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, self.rows[0].schema) as stream:
            for batch in self.rows:
                stream.write_batch(batch)
        out.block("rows", sink.getvalue().to_pybytes(), self.n_docs)
        return out.close()


def _spill(aligner: ChunkAligner, batches, folder: str, run_records: int):
    """Align the documents of a task; the name of each run written."""
    fresh = lambda: Run(aligner.low_bits, aligner.a_bits + aligner.b_bits)
    run, held = fresh(), None
    for batch in batches:
        ids = batch.column(0)
        for a, b, counts, (row, key, times), good, text, places, ends in aligner.documents_of(batch.column(1)):
            if held is None and ends:
                digests = [hashlib.sha256(text[i : j - 1]).hexdigest() if j > i and ok else "" for i, j, ok in zip(places[:-1].tolist(), places[1:].tolist(), good.tolist())]
            else:  # one long document, slice by slice
                counts_of, records, sha, fine = held or (0, [], hashlib.sha256(), True)
                if records:
                    sha.update(b";")
                sha.update(text[places[0] : places[-1] - 1])
                held = (counts_of + counts, [*records, (row, key, times)], sha, fine and bool(good.all()))
                if not ends:
                    continue
                counts, records, sha, fine = held
                held, good = None, np.array([fine])
                row, key, times = (np.concatenate(x) for x in zip(*records))
                digests = [sha.hexdigest() if fine else ""]
            counts = np.where(good[:, None], counts, 0)
            keep = good[row - a]
            run.add(ids.slice(a, b - a), counts, digests, (row[keep] - a, key[keep], times[keep]))
            if run.n_records >= run_records or run.n_docs >= 1 << DOC_BITS - 1:
                yield run.write(folder)
                run = fresh()
    if run.n_docs:
        yield run.write(folder)


def _merge_up(folder: str, part: int, inputs: list[str], low_bits: int) -> str:
    """Merge the runs of a part into one run of sums."""
    readers = [Reader(folder, x) for x in inputs]
    out = Writer(folder)
    for keys, sums, _ in merge([x.entries(f"pairs-{part}") for x in readers], low_bits):
        out.segment(f"pairs-{part}", keys, sums, low_bits)
    for x in readers:
        x.close()
    return out.close()


def _answers(chunks):
    """Take answers off a stream, as many at a time as ``send`` asks for."""
    held = np.zeros(0, np.uint64)
    n = yield
    while True:
        while len(held) < n:
            held = np.concatenate([held, np.frombuffer(next(chunks)[0], "<u8")])
        out, held = held[:n], held[n:]
        n = yield out


def _stream_back(folder: str, part: int, inputs: list[str], low_bits: int, answer: tuple[str, str] | None) -> str:
    """Merge the runs of a part and hand each of them its pairs' answers: twice the
    count, plus one for the highest count of the A id. The root of the tree works
    them out as sides pass; below it they are read from ``answer`` (file, input)."""
    readers = [Reader(folder, x) for x in inputs]
    out, given, known = Writer(folder), None, None
    if answer:
        known = Reader(folder, answer[0])
        given = _answers(known.blocks(f"answer-{answer[1]}"))
        next(given)
    for keys, sums, parts in merge([x.entries(f"pairs-{part}") for x in readers], low_bits):
        if given is None:
            side = keys >> np.uint64(low_bits)
            starts = np.flatnonzero(np.diff(side, prepend=~side[:1]))
            best = np.repeat(np.maximum.reduceat(sums, starts), np.diff(np.append(starts, len(sums))))
            packed = sums << np.uint64(1) | (sums == best).astype(np.uint64)
            out.segment(f"pairs-{part}", keys, packed, low_bits)
        else:
            packed = given.send(len(keys))
        for k, at in parts:
            out.block(f"answer-{inputs[k]}", packed[at].astype("<u8").tobytes(), len(at))
    for x in [*readers, *([known] if known else [])]:
        x.close()
    return out.close()


def _contribute(folder: str, name: str, answers: dict[int, str]):
    """A run's documents with the sums of their links' counts."""
    run = Reader(folder, name)
    (rows, n), = run.blocks("rows")
    n_best, count_sum = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for part, file in sorted(answers.items()):
        known = Reader(folder, file)
        packed = [np.frombuffer(data, "<u8") for data, _ in known.blocks(f"answer-{name}")]
        known.close()
        if not packed:
            continue
        packed = np.repeat(np.concatenate(packed), np.concatenate([sizes for _, sizes in run.entries(f"pairs-{part}")]).astype(np.int64)).astype(np.int64)
        (data, m), = run.blocks(f"docs-{part}")
        docs, times = np.frombuffer(data, "<u4").reshape(2, m).astype(np.int64)
        np.add.at(count_sum, docs, times * (packed >> 1))
        np.add.at(n_best, docs, times * (packed & 1))
    run.close()
    at = 0
    for batch in pa.ipc.open_stream(rows):
        end = at + batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[: 1 + len(COUNTS)], pa.array(n_best[at:end]), pa.array(count_sum[at:end]), batch.column(1 + len(COUNTS))],
            ["id", *COUNTS, "n_best", "count_sum", "groups_sha256"])
        at = end


class Alignment:
    """``documents``: the result for each document; ``pairs()``: the corpus-wide
    table of pairs."""

    def __init__(self, documents: DataFrame, roots: DataFrame, folder: str, b_bits: int, a_bits: int):
        self.documents, self._roots, self._folder, self._b_bits, self._a_bits = documents, roots, folder, b_bits, a_bits

    def pairs(self) -> DataFrame:
        """a_id, b_id, n_docs (documents that hold the pair linked), best."""
        folder, b_bits, a_bits = self._folder, np.uint64(self._b_bits), np.uint64(self._a_bits - PART_BITS)

        def read(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    known = Reader(folder, row["file"])
                    for keys, packed in known.entries(f"pairs-{row['part']}"):
                        high = keys >> b_bits
                        a = (high & (np.uint64(1) << a_bits) - np.uint64(1)) << np.uint64(PART_BITS) | high >> a_bits
                        b = keys & (np.uint64(1) << b_bits) - np.uint64(1)
                        yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64)), pa.array((packed >> np.uint64(1)).astype(np.int64)), pa.array((packed & np.uint64(1)) == 1)], ["a_id", "b_id", "n_docs", "best"])
                    known.close()

        return self._roots.select("part", "file").repartition(PARTS).mapInArrow(read, "a_id long, b_id long, n_docs long, best boolean")


def align(docs: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id", text_column: str = "text", run_records: int = RUN_RECORDS, fan_in: int = FAN_IN) -> Alignment:
    """Align the documents' tokens of the byte-level BPE at ``a_path`` (``.json``)
    and the SentencePiece model at ``b_path`` (``.model``), files that every worker
    can read. ``documents`` has the id, n_a, n_b, n_groups, n_links, n_best (links
    of the highest count of their A id), count_sum (over the links) and
    groups_sha256 (of ``a1,a2|b1;a3|b2,b3``, ids in order)."""
    spark = docs.sparkSession
    prepare(spark)
    folder = uri(stage_dir(spark, "alignment"))
    sizes = ChunkAligner(a_path, b_path)
    low_bits, a_bits = sizes.b_bits, sizes.a_bits
    if a_bits + low_bits + DOC_BITS > 64:
        raise ValueError(f"vocabularies of {a_bits} and {low_bits} bits leave no room for {DOC_BITS} bits of document numbers")
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))

    def spill(batches):
        aligner = kept(("align", a_path, b_path), lambda: ChunkAligner(a_path, b_path))
        for name in _spill(aligner, batches, folder, run_records):
            yield pa.RecordBatch.from_pydict({"input": [name]})

    runs = stage(rows.mapInArrow(spill, "input string"), "alignment-runs")
    parts = F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part")

    # Up: (part, input) -> (part, file), until a part has no more inputs than one merge opens.
    levels, inputs, n = [], runs.select(parts, "input"), runs.count()
    while True:
        batches = -(-n // fan_in)
        batch = F.pmod(F.xxhash64("input"), F.lit(batches)).alias("batch")
        jobs = inputs.select("part", batch, "input").groupBy("part", "batch").agg(F.collect_list("input").alias("inputs"))
        if batches <= 1:
            break

        def up(given):
            for batch in given:
                for row in batch.to_pylist():
                    file = _merge_up(folder, row["part"], row["inputs"], low_bits)
                    yield pa.RecordBatch.from_pylist([row | {"file": file}], schema=pa.schema([("part", pa.int32()), ("inputs", pa.list_(pa.string())), ("file", pa.string())]))

        merged = stage(jobs.select("part", "inputs").repartition(PARTS * batches).mapInArrow(up, "part int, inputs array<string>, file string"), "alignment-merges")
        levels.append((merged, batches))
        inputs, n = merged.select("part", F.col("file").alias("input")), batches

    # Down: (part, inputs, answer of their merge) -> (part, file of the inputs' answers).
    def back(given):
        for batch in given:
            for row in batch.to_pylist():
                answer = (row["answer"], row["merged"]) if row["answer"] else None
                file = _stream_back(folder, row["part"], row["inputs"], low_bits, answer)
                yield pa.RecordBatch.from_pylist([{"part": row["part"], "inputs": row["inputs"], "file": file}], schema=pa.schema([("part", pa.int32()), ("inputs", pa.list_(pa.string())), ("file", pa.string())]))

    no_answer = [F.lit(None).cast("string").alias("merged"), F.lit(None).cast("string").alias("answer")]
    roots = answered = stage(jobs.select("part", "inputs", *no_answer).repartition(PARTS).mapInArrow(back, "part int, inputs array<string>, file string"), "alignment-answers")
    for merged, batches in reversed(levels):
        known = answered.select(F.explode("inputs").alias("merged"), F.col("file").alias("answer"))
        work = merged.withColumnRenamed("file", "merged").join(known, "merged").select("part", "inputs", "merged", "answer")
        answered = stage(work.repartition(PARTS * batches).mapInArrow(back, "part int, inputs array<string>, file string"), "alignment-answers")

    # Leaves: one run's answers of all parts.
    leaves = answered.select("part", F.explode("inputs").alias("input"), "file").groupBy("input").agg(F.collect_list(F.struct("part", "file")).alias("answers"))

    def contribute(given):
        for batch in given:
            for row in batch.to_pylist():
                yield from _contribute(folder, row["input"], {x["part"]: x["file"] for x in row["answers"]})

    kind = rows.schema["id"].dataType.simpleString()
    result = leaves.repartition(max(1, min(runs.count(), 100_000))).mapInArrow(contribute, f"id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
    return Alignment(result.withColumnRenamed("id", id_column), roots, folder, low_bits, a_bits)
