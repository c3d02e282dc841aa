"""Token counts of whole texts by compiled transducers, in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import streams
from tidemark.llm.transducer import Tokenizer

_compiled: dict[int, Tokenizer] = {}


def count_tokens(docs: DataFrame, spec: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Bytes and tokens of every row's text; ``spec`` is the content of a byte-level BPE tokenizer file.

    Each worker compiles the tokenizer once. Null text is empty text and has no tokens; null ids, repeated rows and
    empty tables go through as they are; other columns are neither read nor returned.
    """
    shared = docs.sparkSession.sparkContext.broadcast(spec)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(shared.value)
        if key not in _compiled:
            _compiled.clear()
            _compiled[key] = Tokenizer(shared.value)
        tokenizer = _compiled[key]
        for part in streams.pieces(batches, "text"):
            raw, offsets = streams.texts_of(part.column("text"))
            sizes = offsets[1:] - offsets[:-1]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(sizes), pa.array(tokenizer.counts(raw, offsets))],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(count, f"doc_id {id_type}, n_bytes long, n_tokens long")
