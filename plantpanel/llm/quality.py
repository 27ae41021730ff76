"""Quality rules: counted features and a hashed n-gram log-likelihood ratio.

Two multinomials over hashed byte n-grams are counted, one from the trusted
documents and one from all documents.  A document's score is the mean
log-likelihood ratio of its n-grams; a fixed threshold turns every score into a
verdict, so equal texts always fare alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk

NGRAM_BYTES = 4
BUCKET_BITS = 17
#: Pseudo-count of every bucket in both multinomials.
SHRINK = 3.0
#: Mean log-likelihood ratio below which a document is rejected.
MIN_SCORE = -0.45
#: Ids of trusted documents are broadcast up to this many (8 bytes each).
BROADCAST_IDS = 2_000_000
#: Characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True

FEATURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def ngram_buckets(data: np.ndarray, offsets: np.ndarray, bits: int = BUCKET_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of the byte n-grams inside each text, with their texts."""
    n = NGRAM_BYTES
    if len(data) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = np.zeros(len(data) - n + 1, dtype=np.uint64)
    for k in range(n):
        code = (code << np.uint64(8)) | data[k : len(data) - n + 1 + k]
    docs = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = docs[: len(code)] == docs[n - 1 :]
    bucket = (code[inside] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)
    return bucket.astype(np.int64), docs[: len(code)][inside]


def _firsts(docs: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For entries in text order: is it the first with its (text, hash), and how many have it."""
    key = tk.mix(h + docs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first, inverse, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    is_first = np.zeros(len(key), dtype=bool)
    is_first[first] = True
    return is_first, count[inverse]


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of packed texts."""
    n = len(offsets) - 1
    if not len(data):
        return tuple(np.zeros(n, dtype=np.int64) for _ in range(5))
    starts, ends, docs = tk.words(data, offsets)
    hasher = tk.Hasher(data)
    sums = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(tk.WORD_BYTE[data] & ((data & 0xC0) != 0x80), out=sums[1:])
    word_chars = sums[offsets[1:]] - sums[offsets[:-1]]
    np.cumsum(_SYMBOL[data], out=sums[1:])
    n_symbols = sums[offsets[1:]] - sums[offsets[:-1]]
    # Lines with a word that equal an earlier line of their text.
    l_starts, l_ends, l_docs = tk.lines(data, offsets)
    np.cumsum(tk.WORD_BYTE[data], out=sums[1:])
    full = sums[l_ends] > sums[l_starts]
    l_starts, l_ends, l_docs = l_starts[full], l_ends[full], l_docs[full]
    first, _ = _firsts(l_docs, hasher.spans(l_starts, l_ends))
    n_dup_lines = tk.per_text(l_docs[~first], n)
    # Words inside a 3-word window that the text has twice or more.
    h = hasher.spans(starts, ends)
    covered = np.zeros(len(h), dtype=bool)
    if len(h) > 2:
        k = np.uint64(0x9E3779B97F4A7C15)
        window = tk.mix((h[:-2] * k + h[1:-1]) * k + h[2:])
        inside = np.flatnonzero(docs[2:] == docs[:-2])
        _, count = _firsts(docs[inside], window[inside])
        at = inside[count > 1]
        for step in range(3):
            covered[at + step] = True
    return tk.per_text(docs, n), word_chars, n_symbols, n_dup_lines, tk.per_text(docs[covered], n)


def count_ngrams(docs: DataFrame, text_col: str, trusted_col: str | None, bits: int = BUCKET_BITS) -> DataFrame:
    """(bucket, raw, trusted): n-grams of all documents and of the trusted ones."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, good = np.zeros(1 << bits, dtype=np.int64), np.zeros(1 << bits, dtype=np.int64)
        for batch in batches:
            data, offsets = tk.packed(batch.column(0))
            trusted = np.asarray(batch.column(1).fill_null(False).to_numpy(zero_copy_only=False), dtype=bool)
            for i, j, part, at in tk.chunks(data, offsets):
                bucket, owner = ngram_buckets(part, at, bits)
                raw += np.bincount(bucket, minlength=1 << bits)
                good += np.bincount(bucket[trusted[i:j][owner]], minlength=1 << bits)
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(raw[used]), pa.array(good[used])], ["bucket", "raw", "trusted"])

    flag = F.col(trusted_col) if trusted_col else F.lit(False)
    return (
        docs.select(F.col(text_col).alias("text"), flag.alias("trusted"))
        .mapInArrow(count, "bucket long, raw long, trusted long")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted"))
    )


def ratio_table(counts: DataFrame, bits: int = BUCKET_BITS) -> np.ndarray:
    """log p_trusted - log p_raw by bucket; at most 2**bits rows reach the driver.

    Both counts are shrunk towards what the raw corpus lets expect among the
    trusted n-grams, so a rare n-gram is weak evidence and an unseen one none.
    """
    got = counts.toPandas()
    raw, good = np.zeros(1 << bits), np.zeros(1 << bits)
    raw[got["bucket"]], good[got["bucket"]] = got["raw"], got["trusted"]
    if not raw.sum() or not good.sum():
        return np.zeros(1 << bits, dtype=np.float32)
    expected = raw * (good.sum() / raw.sum())
    return np.log((good + SHRINK) / (expected + SHRINK)).astype(np.float32)


def with_trusted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Mark the documents that any label row calls good (quality 1) as ``_trusted``.

    The ids are broadcast while they are few (a checked bound); beyond that
    Spark joins by shuffling.
    """
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias(id_col)).distinct()
    good = good.withColumn("_trusted", F.lit(True))
    if good.count() <= BROADCAST_IDS:
        good = F.broadcast(good)
    return docs.join(good, id_col, "left")


def _verdicts(data: np.ndarray, offsets: np.ndarray, ratio: np.ndarray, min_score: float, bits: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Features and score, base_failed and kept of packed texts."""
    out = []
    for i, j, part, at in tk.chunks(data, offsets):
        bucket, owner = ngram_buckets(part, at, bits)
        total = np.bincount(owner, weights=ratio[bucket], minlength=j - i)
        score = total / np.maximum(np.bincount(owner, minlength=j - i), 1)
        out.append((*features(part, at), score))
    cols = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 5 + [np.zeros(0)]
    n_words, *_, repeat, score = cols
    failed = (n_words < 50) | (100 * repeat > 50 * n_words)
    return cols, failed, ~failed & (score >= min_score)


def _ratio(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, bits: int):
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    table = ratio_table(count_ngrams(with_trusted(slim, labels), "text", "_trusted", bits), bits)
    return slim, docs.sparkSession.sparkContext.broadcast(table)


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_score: float = MIN_SCORE,
    bits: int = BUCKET_BITS,
) -> DataFrame:
    """Features, score and verdict of every document.

    Returns id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    score, base_failed and kept.  A null or empty text has no words and fails
    the base rules; with no trusted document all scores are 0 and only the base
    rules decide.  A score at the threshold is kept; texts of any length are read
    whole.  Repeated rows are judged alike; other columns are ignored; an empty
    table gives no rows.
    """
    slim, shared = _ratio(docs, labels, id_col, text_col, bits)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols, failed, kept = _verdicts(*tk.packed(batch.column(1)), shared.value, min_score, bits)
            arrays = [batch.column(0), *map(pa.array, cols), pa.array(failed), pa.array(kept)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score", "base_failed", "kept"])

    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(judge, f"doc_id {kind}, {FEATURES}, score double, base_failed boolean, kept boolean")


def keep_good(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_score: float = MIN_SCORE, bits: int = BUCKET_BITS) -> DataFrame:
    """The rows of ``docs``, all columns, whose document ``score_documents`` would keep.

    Null, empty and short texts go; texts of any length are judged whole;
    repeated rows fare alike; an empty table stays empty.
    """
    _, shared = _ratio(docs, labels, id_col, text_col, bits)
    text_at = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_verdicts(*tk.packed(batch.column(text_at)), shared.value, min_score, bits)[2]))

    return docs.mapInArrow(keep, docs.schema)
