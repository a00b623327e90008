"""Byte-level BPE of whole texts by their distinct chunks.

The byte-level pretokeniser never joins a non-space character with a white
space that follows it, so a text may be cut before any white space that follows
a non-space character: the ids of the pieces, put together, are the ids of the
text. White space at a cut stays with the piece that it begins, and a special
token's string holds no white space, so it is never cut. Each distinct chunk is
encoded once by the library (a bounded memo keeps chunks between batches), and
texts of any length are handled as slices of bounded size.

The pretokeniser also ends a run of letters before a punctuation mark, so a text
may be cut between an ASCII letter and a mark, unless an added token holds the
mark: a word is then the same chunk with and without a comma after it.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa

from tidewater.llm.common import kept, slices, utf8

#: Bytes of text that are worked on at once, and distinct chunks that are kept.
SLICE_BYTES, MEMO_CHUNKS = 8 << 20, 1_000_000
#: Encode at most so many bytes of chunks in one call of the library.
CALL_BYTES = 1 << 20
#: Marks that a word may be cut off from (no apostrophe: it may begin a suffix).
MARKS = ".,;:!?*%$&#"


def safe_cuts(data: np.ndarray, marks: str = "") -> np.ndarray:
    """Positions of UTF-8 ``data`` where it may be cut.

    Cut before a blank or line feed when the character before is plainly no
    white space: visible ASCII, or a two-byte character with a lead of 0xC3 or
    more (Unicode's two-byte white spaces have the lead 0xC2). Cut before one of
    ``marks`` when the character before is an ASCII letter.
    """
    if len(data) < 2:
        return np.zeros(0, np.int64)
    blank = (data[1:] == 0x20) | (data[1:] == 0x0A)
    before = data[:-1]
    solid = (before > 0x20) & (before < 0x7F)
    solid[1:] |= (before[1:] >= 0x80) & (data[:-2] >= 0xC3) & (data[:-2] <= 0xDF)
    cut = blank & solid
    if marks:
        kind = np.zeros(256, np.uint8)
        kind[np.frombuffer(marks.encode(), np.uint8)] = 1
        kind[0x41:0x5B] = kind[0x61:0x7B] = 2
        cut |= (kind[data[1:]] == 1) & (kind[before] == 2)
    return np.flatnonzero(cut) + 1


class ChunkEncoder:
    #: Limits of a subclass; without them the module's own hold.
    slice_bytes = memo_chunks = None

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = "".join(x.content for x in self.tokenizer.get_added_tokens_decoder().values())
        self.marks = "".join(x for x in MARKS if x not in added)
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.starts, self.lengths, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _add(self, chunks: list[str], with_ids: bool) -> None:
        lengths, ids, at = [], [], 0
        while at < len(chunks):
            end, size = at, 0
            while end < len(chunks) and (end == at or size < CALL_BYTES):
                size += 4 * len(chunks[end])
                end += 1
            coded = self.tokenizer.encode_batch_fast(chunks[at:end], add_special_tokens=False)
            lengths.extend(map(len, coded))
            if with_ids:
                ids.extend(chain.from_iterable([x.ids for x in coded]))
            at = end
        lengths = np.array(lengths, np.int64)
        first = len(self.place)
        self.place.update(zip(chunks, range(first, first + len(chunks))))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, np.array(ids, np.uint32)])

    def _numbers(self, data: np.ndarray, offsets: np.ndarray, with_ids: bool) -> tuple[np.ndarray, np.ndarray]:
        """The memo's number of each chunk of a slice, and each row's first chunk."""
        is_cut = np.zeros(len(data) + 1, bool)
        is_cut[safe_cuts(data, self.marks)] = True
        is_cut[offsets] = True
        cuts = np.flatnonzero(is_cut)
        chunks = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(data)))
        coded = chunks.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.place) + len(distinct) > (self.memo_chunks or MEMO_CHUNKS):
            self.clear()
        place = list(map(self.place.get, distinct))
        missing = [x for x, k in zip(distinct, place) if k is None]
        if missing:
            self._add(missing, with_ids)
            place = list(map(self.place.__getitem__, distinct))
        return np.array(place, np.int64)[coded.indices.to_numpy()], np.searchsorted(cuts, offsets)

    def _slices(self, column: pa.Array):
        """Slices of whole rows; a row beyond the slice size is cut into pieces, of
        which only the last comes with ``ends`` set."""
        slice_bytes = self.slice_bytes or SLICE_BYTES
        data, offsets = utf8(column)
        for a, b in slices(offsets, slice_bytes):
            part, low = data[offsets[a] : offsets[b]], 0
            if b - a > 1 or len(part) <= slice_bytes:
                yield a, b, part, offsets[a : b + 1] - offsets[a], True
                continue
            cuts = safe_cuts(part, self.marks)
            while low < len(part):
                k = int(np.searchsorted(cuts, low + slice_bytes, "right"))
                k -= k > 0 and cuts[k - 1] > low  # the last cut in reach, else the first beyond
                high = int(cuts[k]) if k < len(cuts) and low + slice_bytes < len(part) else len(part)
                yield a, b, part[low:high], np.array([0, high - low]), high == len(part)
                low = high

    def lengths_of(self, column: pa.Array) -> np.ndarray:
        """Number of ids of each row."""
        out = np.zeros(len(column), np.int64)
        for a, b, data, offsets, _ in self._slices(column):
            numbers, first = self._numbers(data, offsets, False)
            sums = np.concatenate([np.zeros(1, np.int64), np.cumsum(self.lengths[numbers])])
            out[a:b] += sums[first[1:]] - sums[first[:-1]]
        return out

    def ids_of(self, column: pa.Array):
        """Runs of ids in row order: (row range, ids, number of ids of each row, ends).

        A row beyond the slice size comes as several runs; ``ends`` is set on
        its last one.
        """
        for a, b, data, offsets, ends in self._slices(column):
            numbers, first = self._numbers(data, offsets, True)
            lengths = self.lengths[numbers]
            sums = np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths)])
            at = np.repeat(self.starts[numbers] - sums[:-1], lengths) + np.arange(sums[-1])
            yield a, b, self.ids[at], sums[first[1:]] - sums[first[:-1]], ends


def encoder(path: str, with_ids: bool) -> ChunkEncoder:
    """The worker's encoder; lengths and ids have memos of their own."""
    return kept(("bpe", path, with_ids), lambda: ChunkEncoder(path))
