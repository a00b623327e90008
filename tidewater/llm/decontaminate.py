"""Benchmark decontamination with an Aho-Corasick automaton.

Benchmark items (test questions and answers) are normalised to words; each run
of ``window`` consecutive item words is a pattern, and an item of fewer words,
but not none, is one pattern. A document is normalised the same way and scanned
once; a hit word lies inside any occurrence of a pattern. Spans are mapped back
to character offsets of the original text.

The automaton is broadcast under a stated bound: items are read in the order of
their texts into parts of at most ``part_bytes`` of patterns, and the documents
pass each part's automaton in turn, all in one map without any shuffle. A
benchmark of ordinary size is one part.

Defined results: null and empty texts have no words and no hits; an item
without words matches nothing; repeated items count once by id, an item without
id marks words but is no item of the count; repeated documents are judged row by
row; an empty table on either side gives no hits.
"""

from __future__ import annotations

import hashlib
import pickle
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import kept, map_rows, normalise, prepare, utf8, word_texts

WINDOW = 10
PART_BYTES = 64 << 20
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def item_windows(text: str | None, window: int) -> list[bytes]:
    """The patterns of one item."""
    words = normalise((text or "").encode()).split()
    if not words:
        return []
    return [b" ".join(words[i : i + window]) for i in range(max(1, len(words) - window + 1))]


def _parts(bench: DataFrame, id_column: str, text_column: str, window: int, part_bytes: int):
    """Patterns with their item ids, in parts of bounded bytes; the driver holds one part."""
    part, size = {}, 0
    rows = bench.select(F.col(id_column).cast("string"), F.col(text_column).cast("string")).distinct()
    for item, text in rows.toLocalIterator():
        for pattern in item_windows(text, window):
            part.setdefault(pattern, set()).add(item)
            size += len(pattern) + 64
            if size >= part_bytes:
                yield part
                part, size = {}, 0
    if part:
        yield part


def _broadcast(bench: DataFrame, **how) -> list[tuple]:
    sc = bench.sparkSession.sparkContext
    return [(uuid.uuid4().hex, sc.broadcast(pickle.dumps([(k, tuple(sorted(v - {None}))) for k, v in sorted(part.items())]))) for part in _parts(bench, **how)]


#: Automata that a worker process keeps.
KEPT_AUTOMATA = 4


def _automaton(part: tuple):
    """A part's automaton; a worker process keeps a few of them."""
    import ahocorasick

    key, broadcast = part
    automata = kept(("automata",), dict)
    if key not in automata:
        automaton = ahocorasick.Automaton()
        for pattern, items in pickle.loads(broadcast.value):
            spaced = f" {pattern.decode('latin-1')} "
            automaton.add_word(spaced, (len(spaced), items))
        automaton.make_automaton()
        if len(automata) >= KEPT_AUTOMATA:
            automata.clear()
        automata[key] = automaton
    return automata[key]


def _scan(automaton, words: bytes) -> tuple[np.ndarray, set]:
    """Which words are hit, and the items that hit them."""
    spaced = f" {words.decode('latin-1')} "
    spans, items = [], set()
    for end, (length, found) in automaton.iter(spaced):
        spans.append((end - length + 1, end))
        items.update(found)
    if not spans:
        return np.zeros(0, bool), items
    # The blank before word k is the k-th blank of ``spaced``.
    word_at = np.cumsum(np.frombuffer(spaced.encode("latin-1"), np.uint8) == 0x20)
    edges = np.zeros(int(word_at[-1]) + 1, np.int64)
    spans = np.array(spans)
    np.add.at(edges, word_at[spans[:, 0]] - 1, 1)
    np.add.at(edges, word_at[spans[:, 1]] - 1, -1)
    return np.cumsum(edges)[: int(word_at[-1]) - 1] > 0, items


def _runs(hit: np.ndarray) -> np.ndarray:
    """Starts and ends (after the last) of runs of hit words, interleaved."""
    return np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))


def contamination(docs: DataFrame, bench: DataFrame, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text",
                  item_id_column: str = "item_id", item_text_column: str = "text", part_bytes: int = PART_BYTES) -> DataFrame:
    """One row per document: its id, n_words, n_hit, items (ids as strings, sorted
    as strings), spans (runs of hit words as character offsets of the original
    text, end after the last character) and contaminated (``n_hit > 0``)."""
    spark = docs.sparkSession
    prepare(spark)
    parts = _broadcast(bench, id_column=item_id_column, text_column=item_text_column, window=window, part_bytes=part_bytes)

    def scan(batches):
        for batch in batches:
            texts = word_texts(batch.column(1))
            whole, offsets = utf8(batch.column(1))
            found: dict[int, tuple[np.ndarray, set]] = {}
            for part in parts:  # batch by batch, so that one part's automaton serves many texts
                automaton = _automaton(part)
                for i, words in enumerate(texts):
                    hit, items = _scan(automaton, words) if words else (np.zeros(0, bool), ())
                    if len(hit):
                        old = found.get(i)
                        found[i] = (hit | old[0], items | old[1]) if old else (hit, items)
            n_hit, names, spans = [0] * len(texts), [[]] * len(texts), [[]] * len(texts)
            for i, (hit, items) in found.items():
                original = whole[offsets[i] : offsets[i + 1]].tobytes().decode()
                places = [m.span() for m in _WORD.finditer(original)]
                edges = _runs(hit)
                n_hit[i], names[i] = int(hit.sum()), sorted(items)
                spans[i] = [{"start": places[a][0], "end": places[b - 1][1]} for a, b in zip(edges[::2], edges[1::2])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x.count(b" ") + 1 if x else 0 for x in texts], pa.int64()), pa.array(n_hit, pa.int64()),
                 pa.array(names, pa.list_(pa.string())), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                ["id", "n_words", "n_hit", "items", "spans"])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(scan, f"id {kind}, n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>")
    return found.select(F.col("id").alias(id_column), "n_words", "n_hit", "items", "spans", (F.col("n_hit") > 0).alias("contaminated"))


def digest(items: list[str]) -> str:
    """The digest that the registered query derives from ``items`` (for tests)."""
    return hashlib.sha256(",".join(items).encode()).hexdigest()


def drop_contaminated(docs: DataFrame, bench: DataFrame, window: int = WINDOW, part_bytes: int = PART_BYTES) -> DataFrame:
    """The documents without a hit word, all columns kept as they are.

    The verdict is made in the same map that passes the rows on, so no join
    brings them back together. Columns of any name and type pass through.
    """
    spark = docs.sparkSession
    prepare(spark)
    parts = _broadcast(bench, id_column="item_id", text_column="text", window=window, part_bytes=part_bytes)
    at = docs.columns.index("text")

    def keep(batches):
        for batch in batches:
            texts, clean = word_texts(batch.column(at)), np.ones(batch.num_rows, bool)
            for part in parts:
                automaton = _automaton(part)
                for i, words in enumerate(texts):
                    if clean[i] and words and next(automaton.iter(f" {words.decode('latin-1')} "), None) is not None:
                        clean[i] = False
            yield batch.filter(pa.array(clean))

    return map_rows(docs, keep, docs.schema)
