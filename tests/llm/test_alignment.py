"""The alignment against a plain one over whole texts."""

import bisect
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidewater.llm import alignment as al
from tidewater.llm import spill
from tidewater.llm.queries import BPE, PIECES, tokenizer_path

SF = "/root/testdata/sf0.001"
A, B = tokenizer_path(BPE), tokenizer_path(PIECES)


def plain(rows):
    """Whole texts by the libraries, groups token by token, counts in a Counter."""
    import sentencepiece
    from tokenizers import Tokenizer

    left, right = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    left.encode_special_tokens = True
    alphabet, found, counts = al.byte_alphabet(), [], Counter()
    for key, text in rows:
        links, groups, n = Counter(), [], (0, 0)
        if text:
            coded = left.encode(" " + text, add_special_tokens=False)
            a = [(i, bytes(alphabet[c] for c in token)) for i, token in zip(coded.ids, coded.tokens)]
            b = [(i, al.piece_bytes(right.id_to_piece(i))) for i in right.encode(text)]
            whole = (" " + text).encode()
            if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b):
                n = (len(a), len(b))
                ends = [set(np.cumsum([len(x) for _, x in side]).tolist()) for side in (a, b)]
                cuts = sorted(ends[0] & ends[1])
                groups = [([], []) for _ in cuts]
                for k, side in enumerate((a, b)):
                    for end, (i, _) in zip(np.cumsum([len(x) for _, x in side]).tolist(), side):
                        groups[bisect.bisect_left(cuts, end)][k].append(i)
        for u, v in groups:
            links.update((p, q) for p in u for q in v)
        counts.update(links.keys())
        said = ";".join(",".join(map(str, u)) + "|" + ",".join(map(str, v)) for u, v in groups)
        found.append((key, *n, len(groups), links, hashlib.sha256(said.encode()).hexdigest() if groups else ""))
    best = defaultdict(int)
    for (p, _), c in counts.items():
        best[p] = max(best[p], c)
    table = {(p, q): (c, c == best[p]) for (p, q), c in counts.items()}
    return Counter((k, na, nb, ng, sum(x.values()), sum(m * table[y][1] for y, m in x.items()), sum(m * table[y][0] for y, m in x.items()), sha) for k, na, nb, ng, x, sha in found), table


def got(result):
    return Counter(map(tuple, result.documents.collect())), {(r.a_id, r.b_id): (r.n_docs, r.best) for r in result.pairs().collect()}


ODD = [
    (1, None), (2, ""), (3, " "), (4, "  two  blanks "), (5, "\n\nline\tfeed\r\n x"), (6, "an escape ▁ sign"), (6, "again 6"), (None, "no id"), (None, "no id"),
    (7, "<|endoftext|> and <s> <unk> </s> <0x41>"), (8, "naïve Привет, мир! 李娜 🙂🙃 ﬁ  　 \u0000"), (9, "x" * 5000), (10, "tell, tell; tell: (tell)! don't 1,000.50"), (11, "a" + "́" * 9),
    (12, "long " * 30_000 + "▁"), (13, " ".join(f"w{i % 977}, {i}" for i in range(12_000))), (14, "ends with a line feed\n"), (15, "▁"), (16, "é è ü"),
]


def test_odd_texts_and_small_slices(spark, monkeypatch):
    from tidewater.llm import bpe

    docs = spark.createDataFrame([(*r, 5, "z") for r in ODD], "doc_id long, text string, n_a int, id string").repartition(3)
    assert got(al.align(docs, A, B)) == plain(ODD)
    # Texts beyond the slice size come slice by slice, with a memo that overflows.
    aligner = al.ChunkAligner(A, B)
    aligner.slice_bytes, aligner.memo_chunks = 4096, 50
    assert isinstance(aligner, bpe.ChunkEncoder)
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"id": pa.array([k for k, _ in ODD], pa.int64()), "text": pa.array([t for _, t in ODD])})
    taken = []
    monkeypatch.setattr(al.Run, "write", lambda self, folder: taken.append(self) or "x")
    list(al._spill(aligner, [batch], "", 10**9))
    want, _ = plain(ODD)
    rows = Counter((r["id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["groups_sha256"]) for b in taken[0].rows for r in b.to_pylist())
    assert rows == Counter({(*k[:5], k[7]): n for k, n in want.items()})


def test_trees_of_merges(spark):
    """Small runs, a small fan-in and many partitions give the same counts."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").repartition(7)
    rows = [tuple(r) for r in docs.collect()]
    result = al.align(docs, A, B, run_records=400, fan_in=3)
    assert got(result) == plain(rows)


def test_no_rows(spark):
    result = al.align(spark.createDataFrame([], "doc_id long, text string"), A, B)
    assert got(result) == (Counter(), {})


def test_merge_gives_whole_sides_in_order(tmp_path):
    """The heap merge against a sort of everything."""
    rnd, low = random.Random(3), 4
    files, everything = [], Counter()
    monkey = spill.FRAME
    spill.FRAME = 5
    try:
        for _ in range(6):
            entries = Counter({rnd.randrange(400): rnd.randrange(1, 9) for _ in range(rnd.choice([0, 1, 90]))})
            keys = sorted(entries)
            out = spill.Writer(str(tmp_path))
            out.segment("s", np.array(keys, np.uint64), np.array([entries[k] for k in keys], np.uint64), low)
            files.append(out.close())
            everything.update(entries)
        readers = [spill.Reader(str(tmp_path), x) for x in files]
        merged, sides = [], []
        for keys, sums, parts in spill.merge([x.entries("s") for x in readers], low):
            merged += zip(keys.tolist(), sums.tolist())
            sides += sorted({k >> low for k in keys.tolist()})
            assert sum(len(at) for _, at in parts) >= len(keys)
    finally:
        spill.FRAME = monkey
    assert merged == sorted(everything.items()) and sides == sorted(set(sides))


@pytest.mark.parametrize("n", [0, 1, 255])
def test_byte_alphabet_covers_every_byte(n):
    assert len(al.byte_alphabet()) == 256 and n in set(al.byte_alphabet().values())
