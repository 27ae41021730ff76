"""Token counts of whole texts by heap-and-linked-list byte-pair merging."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .subwords import WordCounts


def count_tokens(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048) -> DataFrame:
    """n_bytes (UTF-8), n_tokens and over_limit of every document.

    A null text counts as empty: no bytes, no tokens.  Texts are never cut,
    however long; repeated rows are counted each; an empty table gives no rows;
    other columns are ignored.
    No shuffle is needed, and a worker keeps a bounded memory of word counts.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = WordCounts.shared(tokenizer_path)
        for batch in batches:
            data, offsets = tk.packed(batch.column(1))
            n = [counter.count(part, at) for _, _, part, at in tk.chunks(data, offsets)]
            tokens = np.concatenate(n) if n else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(offsets)), pa.array(tokens), pa.array(tokens > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return slim.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
