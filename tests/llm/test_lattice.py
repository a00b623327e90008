"""Sampled segmentations against a plain sampler, their distribution, and round trips."""

import collections
import math

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewater.llm import lattice as S
from tidewater.llm.queries import PIECES, tokenizer_path

SCHEMA = "doc_id long, text string, pieces2 string, DECODED int"
ODD = [None, "", " ", "   ", "\n", "a", "Hello world", "  two  spaces ▁ and é漢字 🎉\n\n new\tline  ", "<s> <0x41> </s>", "the therein\nthe there the", "a" * 300, "x\x00y"]


@pytest.fixture(scope="module")
def model():
    return tokenizer_path(PIECES)


def plain(pieces, text, key):
    """Segmentation by per-character lists, with the same draws."""
    out, chunk = [], 0
    data = np.frombuffer(b" " + text.encode(), np.uint8)
    cuts = S.chunk_cuts(data, np.array([0, len(data)]), pieces.marks)
    for a, b in zip(cuts[:-1], cuts[1:]):
        chars = [S.ESCAPE if c == " " else "" if c == S.ESCAPE else c for c in data[a:b].tobytes().decode()]
        n = len(chars)
        total, edges = [0.0] + [-math.inf] * n, [[] for _ in range(n + 1)]
        for j in range(1, n + 1):
            for length in range(1, min(pieces.longest, j) + 1):
                spelled = "".join(chars[j - length : j])
                if spelled in pieces.spelled:
                    i = pieces.spelled[spelled]
                    edges[j].append((j - length, [i], pieces.log_weight[i]))
                elif length == 1:
                    raw = (S.ESCAPE if spelled == "" else spelled).encode()
                    edges[j].append((j - 1, [int(pieces.byte_ids[x]) for x in raw], len(raw) * pieces.log_weight[pieces.byte_ids[0]]))
            top = max(total[i] + w for i, _, w in edges[j])
            total[j] = top + math.log(sum(math.exp(total[i] + w - top) for i, _, w in edges[j]))
        at, step, path = n, 0, []
        while at:
            u = int(S.draws(np.array([key], np.uint64), np.array([chunk]), step)[0])
            run = 0.0
            for i, tokens, w in edges[at]:
                run += math.exp(total[i] + w - total[at])
                if u < math.floor(run * 2**S.DRAW_BITS) or (i, tokens, w) == edges[at][-1]:
                    break
            path = tokens + path
            at, step = i, step + 1
        out += path
        chunk += 1
    return out


def encode(built, texts, keys):
    tokens, counts = built.encode(pa.array(texts, pa.large_string()), keys)
    ends = np.cumsum(counts)
    return [tokens[a:b].tolist() for a, b in zip(ends - counts, ends)]


@pytest.mark.parametrize("slice_bytes", [16, 2 << 20])
def test_against_a_plain_sampler(model, monkeypatch, slice_bytes):
    monkeypatch.setattr(S, "SLICE_BYTES", slice_bytes)
    built = S.Lattices(model, 0.3)
    keys = S.row_keys(np.arange(len(ODD)), 7)
    assert encode(built, ODD, keys) == [plain(built.pieces, t, k) if t else [] for t, k in zip(ODD, keys)]


def test_memo_is_bounded(model, monkeypatch):
    monkeypatch.setattr(S, "MEMO_NODES", 50)
    built, keys = S.Lattices(model, 0.3), S.row_keys(np.arange(30), 7)
    texts = [f"word{i} and x{i * 7}" for i in range(30)]
    assert [encode(built, [t], keys[i : i + 1])[0] for i, t in enumerate(texts)] == [plain(built.pieces, t, k) for t, k in zip(texts, keys)]


def test_paths_are_drawn_with_their_probability(model):
    built = S.Lattices(model, 0.2)
    n = 30_000
    got = collections.Counter(map(tuple, encode(built, ["the"] * n, S.row_keys(np.arange(n), 1))))
    weights, word = {}, S.ESCAPE + "the"
    for mask in range(2 ** (len(word) - 1)):
        cuts = [0] + [i for i in range(1, len(word)) if mask >> (i - 1) & 1] + [len(word)]
        parts = [word[a:b] for a, b in zip(cuts, cuts[1:])]
        if all(p in built.pieces.spelled for p in parts):
            ids = tuple(built.pieces.spelled[p] for p in parts)
            weights[ids] = math.exp(sum(built.pieces.log_weight[i] for i in ids))
    total = sum(weights.values())
    assert set(got) <= set(weights) and len(weights) > 3
    for ids, w in weights.items():
        share = w / total
        assert abs(got[ids] / n - share) < 5 * math.sqrt(share * (1 - share) / n) + 1e-9


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=5))
def test_decoding_is_lossless(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    built = S.lattices(tokenizer_path(PIECES), 1.0)
    surface = S.surfaces(tokenizer_path(PIECES))
    for t, ids in zip(texts, encode(built, texts, S.row_keys(np.arange(len(texts)), 3))):
        assert b"".join(surface[i] for i in ids)[1:].decode() == t


def test_frames(spark, model):
    rows = [(i, t, "x", 1) for i, t in enumerate(ODD)] + [(None, "null key", None, None), (6, ODD[6], "x", 1), (99, ODD[6], "x", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    coded = S.decode(S.encode(docs, model, alpha=0.1), model)
    assert coded.columns == [*docs.columns, "pieces", "decoded"]
    out = coded.collect()
    assert all(r.decoded == (r.text or "") for r in out) and len(out) == len(rows)
    both = S.encode(docs, model, alpha=0.1, decoded="decoded")
    assert both.columns == coded.columns and sorted(map(str, both.collect())) == sorted(map(str, out))
    again = S.encode(docs.repartition(5), model, alpha=0.1).collect()
    assert {(r.doc_id, r.text, tuple(r.pieces)) for r in again} == {(r.doc_id, r.text, tuple(r.pieces)) for r in out}
    assert len({tuple(r.pieces) for r in out if r.doc_id == 6}) == 1
    assert S.encode(spark.createDataFrame([], SCHEMA), model).collect() == []
