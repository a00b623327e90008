"""Sorted runs of counted keys in zstd frames, and their k-way heap merge.

A *segment* is a list of entries (key, value) in ascending order of 64-bit keys,
cut into zstd frames. A key's high bits are its *side* (``key >> low_bits``); a
frame never splits a side, so whatever a merge hands out holds whole sides.

A *run file* holds the segments of all radix parts and any other named blocks,
with a footer that says where each lies. Files have names of their own for each
attempt of a task, and only names in rows that Spark committed are ever opened.
"""

from __future__ import annotations

import heapq
import json
import uuid

import numpy as np
import zstandard

from tidewater.llm.sorted_files import place

#: Entries of a frame, as far as sides are not split for it.
FRAME = 1 << 15
LEVEL = 1


class Writer:
    """Appends compressed blocks to a new file; ``close`` writes the footer."""

    def __init__(self, folder: str):
        store, path = place(folder)
        store.create_dir(path, recursive=True)
        self.name, self.at, self.index = uuid.uuid4().hex, 0, {}
        self.out = store.open_output_stream(f"{path}/{self.name}.run")
        self.zstd = zstandard.ZstdCompressor(level=LEVEL)

    def block(self, name: str, data: bytes, n: int = 0) -> None:
        packed = self.zstd.compress(data)
        self.out.write(packed)
        self.index.setdefault(name, []).append((self.at, len(packed), n))
        self.at += len(packed)

    def entries(self, name: str, keys: np.ndarray, values: np.ndarray) -> None:
        """One frame: the keys' differences and the values."""
        steps = np.diff(keys, prepend=np.uint64(0))
        self.block(name, steps.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes() + values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), len(keys))

    def segment(self, name: str, keys: np.ndarray, values: np.ndarray, low_bits: int) -> None:
        for a, b in frames(keys, low_bits):
            self.entries(name, keys[a:b], values[a:b])

    def close(self) -> str:
        footer = self.zstd.compress(json.dumps(self.index).encode())
        self.out.write(footer + len(footer).to_bytes(8, "little"))
        self.out.close()
        return self.name


def frames(keys: np.ndarray, low_bits: int) -> list[tuple[int, int]]:
    """Cuts of sorted keys after about ``FRAME`` entries, at the end of a side."""
    cuts, at = [], 0
    while at < len(keys):
        end = min(at + FRAME, len(keys)) - 1
        last = (int(keys[end]) >> low_bits) + 1 << low_bits  # beyond the side of the frame's last entry
        end = len(keys) if last >= 1 << 64 else int(np.searchsorted(keys, np.uint64(last)))
        cuts.append((at, end))
        at = end
    return cuts


class Reader:
    def __init__(self, folder: str, name: str):
        store, path = place(folder)
        self.file = store.open_input_file(f"{path}/{name}.run")
        size = self.file.size()
        n = int.from_bytes(self.file.read_at(8, size - 8), "little")
        self.zstd = zstandard.ZstdDecompressor()
        self.index = json.loads(self.zstd.decompress(self.file.read_at(n, size - 8 - n)))

    def blocks(self, name: str):
        """(bytes, n) of each block of that name, read one at a time."""
        for at, length, n in self.index.get(name, ()):
            yield self.zstd.decompress(self.file.read_at(length, at)), n

    def entries(self, name: str):
        """(keys, values) of each frame of a segment."""
        for data, n in self.blocks(name):
            rows = np.frombuffer(data, np.uint8).reshape(2, 8, n)
            steps, values = (np.ascontiguousarray(x.T).view("<u8").reshape(-1) for x in rows)
            yield np.cumsum(steps, dtype=np.uint64), values

    def close(self) -> None:
        self.file.close()


def merge(streams: list, low_bits: int):
    """k-way heap merge of segments given as iterators of (keys, values).

    The heap holds the last side of each stream's frame in hand; all entries up
    to the least of them are complete and are handed out at once, as (keys,
    sums of the values, parts): distinct keys ascending, whole sides, and for
    each stream that has some of them (stream, places among the keys). Memory is
    one frame of each stream.
    """
    heap, hand = [], {}

    def take(k: int) -> None:
        keys, values = next(streams[k], (None, None))
        if keys is not None:
            hand[k] = (keys, values)
            heapq.heappush(heap, (int(keys[-1]) >> low_bits, k))

    for k in range(len(streams)):
        take(k)
    while heap:
        side, upto = heap[0][0], []
        bound = side + 1 << low_bits
        for k, (keys, values) in sorted(hand.items()):
            if int(keys[0]) >= bound:
                continue
            end = len(keys) if int(keys[-1]) < bound else int(np.searchsorted(keys, np.uint64(bound)))
            upto.append((k, keys[:end], values[:end]))
            hand[k] = (keys[end:], values[end:])
        keys = np.concatenate([x[1] for x in upto])
        distinct, at = np.unique(keys, return_inverse=True)
        sums = np.zeros(len(distinct), np.uint64)
        np.add.at(sums, at, np.concatenate([x[2] for x in upto]))
        ends = np.cumsum([len(x[1]) for x in upto])
        yield distinct, sums, [(k, at[e - len(own) : e]) for (k, own, _), e in zip(upto, ends.tolist())]
        while heap and heap[0][0] == side:
            _, k = heapq.heappop(heap)
            del hand[k]
            take(k)
