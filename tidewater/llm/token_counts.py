"""Token counts of whole texts, in Arrow functions that return lengths only.

Texts are worked on in slices of bounded bytes; a longer text is cut at safe
boundaries and its pieces' lengths are summed (see ``bpe``). The library counts
what it would encode without added special tokens, truncation or padding;
special strings inside texts are handled as its default.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows
and null ids are counted row by row; an empty table gives an empty result.
Columns besides the id and text columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import prepare, utf8


def _bpe_lengths(path: str):
    from tidewater.llm.bpe import encoder

    return encoder(path, False).lengths_of


def _piece_lengths(path: str):
    """SentencePiece has no safe cut for any text: calls are balanced by bytes."""
    import sentencepiece

    from tidewater.llm.bpe import CALL_BYTES
    from tidewater.llm.common import slices

    model = sentencepiece.SentencePieceProcessor(model_file=path)

    def lengths(column: pa.Array) -> np.ndarray:
        _, offsets = utf8(column)
        texts = column.fill_null("")
        return np.concatenate([np.zeros(0, np.int64), *(
            np.fromiter(map(len, model.encode(texts.slice(a, b - a).to_pylist(), num_threads=1)), np.int64, b - a)
            for a, b in slices(offsets, CALL_BYTES))])

    return lengths


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: its id, n_bytes (UTF-8), n_tokens and over_limit
    (``n_tokens > limit``). ``tokenizer`` is the path of a ``.json`` (tokenizers
    library) or ``.model`` (SentencePiece) file that every worker can read."""
    prepare(docs.sparkSession)

    def count(batches):
        lengths = (_piece_lengths if tokenizer.endswith(".model") else _bpe_lengths)(tokenizer)
        for batch in batches:
            _, offsets = utf8(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offsets)), pa.array(lengths(batch.column(1)))], ["id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    counted = rows.mapInArrow(count, f"id {rows.schema['id'].dataType.simpleString()}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
