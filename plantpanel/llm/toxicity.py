"""Toxicity by a factorization machine over hashed terms.

The machine adds to each term's own weight the inner products of term vectors,
so it learns that two terms together mean something that neither does alone.
Terms are letter runs and their beginnings; which of them take part is settled
by their association with the label over all labelled rows that may be learned
from, and the machine is fitted on a bounded sample of these rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .common import held_out

BUCKET_BITS = 18
#: Bytes of a term's beginning that count as terms of their own.
PREFIX_BYTES = (4, 5, 6, 7, 8, 9)
#: Bounds: terms of the machine (those of highest z), rows of its fitting sample.
MAX_TERMS = 1024
SAMPLE_ROWS = 12_000
#: Least z-score of a term's document frequencies between the classes.
MIN_Z = 4.0
FACTORS = 6
THRESHOLD = 0.7
#: Label rows are broadcast up to this many (9 bytes each).
BROADCAST_ROWS = 2_000_000

_TERM = np.zeros(256, dtype=bool)
_TERM[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the letter runs and of their beginnings, with their texts."""
    starts, ends = tk.runs(_TERM[data], offsets)
    docs = tk.owner(offsets, starts)
    hasher = tk.Hasher(data, tk.FOLDED_CODES)
    shift = np.uint64(64 - BUCKET_BITS)
    buckets, owners = [hasher.spans(starts, ends) >> shift], [docs]
    for k, size in enumerate(PREFIX_BYTES):
        long = ends - starts >= size
        h = hasher.spans(starts[long], starts[long] + size)
        buckets.append(tk.mix(h + np.uint64(k + 1)) >> shift)
        owners.append(docs[long])
    return np.concatenate(buckets).astype(np.int64), np.concatenate(owners)


def present(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, bucket) pairs, ``wanted`` buckets only if given."""
    bucket, docs = terms(data, offsets)
    if wanted is not None:
        some = wanted[bucket] >= 0
        bucket, docs = wanted[bucket[some]], docs[some]
    pair = np.unique((docs << BUCKET_BITS) | bucket)
    return pair >> BUCKET_BITS, pair & ((1 << BUCKET_BITS) - 1)


def term_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Documents of label 0 and 1 that hold each bucket; the last entries count all."""
    size = 1 << BUCKET_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((2, size + 1), dtype=np.int64)
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            data, offsets = tk.packed(batch.column(0))
            for i, j, part, at in tk.chunks(data, offsets):
                docs, bucket = present(part, at)
                toxic = label[i:j][docs] == 1
                out[0, :-1] += np.bincount(bucket[~toxic], minlength=size)
                out[1, :-1] += np.bincount(bucket[toxic], minlength=size)
            out[:, -1] += np.bincount(label, minlength=2)[:2]
        used = np.flatnonzero(out.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(out[0, used]), pa.array(out[1, used])], ["bucket", "n0", "n1"])

    summed = rows.select("text", "toxic").mapInArrow(count, "bucket long, n0 long, n1 long").groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    # Terms of a single document say nothing; they need not reach the driver.
    got = summed.where(f"n0 + n1 > 1 OR bucket = {size}").toPandas()
    n0, n1 = np.zeros(size + 1), np.zeros(size + 1)
    n0[got["bucket"]], n1[got["bucket"]] = got["n0"], got["n1"]
    return n0, n1


def choose_terms(n0: np.ndarray, n1: np.ndarray, max_terms: int = MAX_TERMS) -> np.ndarray:
    """Buckets whose document frequency differs most between the classes, ties to the smaller bucket."""
    a, b = max(n1[-1], 1.0), max(n0[-1], 1.0)
    p = (n1[:-1] + n0[:-1]) / (a + b)
    z = np.abs(n1[:-1] / a - n0[:-1] / b) / np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / a + 1 / b))
    z[n0[:-1] + n1[:-1] < 2] = 0
    best = np.argsort(-z, kind="stable")[:max_terms]
    return best[z[best] >= MIN_Z]


def fit_machine(docs: np.ndarray, cols: np.ndarray, y: np.ndarray, n_terms: int, *, steps: int = 400, rate: float = 0.05, decay: float = 2e-5, seed: int = 9) -> tuple[float, np.ndarray, np.ndarray]:
    """Bias, weights and vectors by Adam on the logistic loss with weight decay."""
    x = np.zeros((len(y), n_terms), dtype=np.float32)
    x[docs, cols] = 1.0
    rng = np.random.default_rng(seed)
    prior = np.clip(y.mean() if len(y) else 0.0, 1e-3, 1 - 1e-3)
    theta = [np.array([np.log(prior / (1 - prior))], np.float32), np.zeros(n_terms, np.float32), rng.normal(0, 0.02, (n_terms, FACTORS)).astype(np.float32)]
    m, v = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    for step in range(1, steps + 1 if n_terms and len(y) else 1):
        b, w, f = theta
        xf = x @ f
        s = b[0] + x @ w + 0.5 * ((xf * xf).sum(axis=1) - x @ (f * f).sum(axis=1))
        g = (1 / (1 + np.exp(-np.clip(s, -30, 30))) - y).astype(np.float32) / len(y)
        gx = x.T @ g
        grads = [np.array([g.sum()], np.float32), gx + decay * w, x.T @ (g[:, None] * xf) - f * gx[:, None] + decay * f]
        for k, d in enumerate(grads):
            m[k] = 0.9 * m[k] + 0.1 * d
            v[k] = 0.99 * v[k] + 0.01 * d * d
            theta[k] = theta[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
    return float(theta[0][0]), theta[1], theta[2]


def machine_scores(docs: np.ndarray, cols: np.ndarray, n: int, bias: float, w: np.ndarray, f: np.ndarray) -> np.ndarray:
    """Bias, weights and the inner products of all pairs of the terms of each of ``n`` texts.

    The sum over pairs is half of the squared sum less the sum of squares.
    """
    s = bias + np.bincount(docs, weights=w[cols] - 0.5 * (f[cols] * f[cols]).sum(axis=1), minlength=n)
    for k in range(f.shape[1]):
        s = s + 0.5 * np.bincount(docs, weights=f[cols, k], minlength=n) ** 2
    return s


def score_toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, sample_rows: int = SAMPLE_ROWS, max_terms: int = MAX_TERMS, seed: int = 23) -> DataFrame:
    """held_out, score (0 to 1) and predicted (score >= threshold) of every document.

    Labels are learned only from rows whose crc32(id as text) mod 3 is not 1;
    rows without a label, or with another value than 0 and 1, teach nothing.
    Null and empty texts get the score of a text without terms; without any
    toxic label every score is near 0.  Texts are read whole, repeated rows are
    scored alike, other columns are ignored, an empty table gives no rows.  A
    document that several label rows name is toxic if any of them says so.

    Two bounds belong to the model and hold at every size: it is fitted on about
    ``sample_rows`` labelled rows, and has one weight and one vector for each of
    at most ``max_terms`` terms.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn("held_out", held_out("doc_id", 3, 1))
    marks = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marks = marks.where(~held_out("doc_id", 3, 1))
    n_marks = marks.count()
    if n_marks <= BROADCAST_ROWS:
        marks = F.broadcast(marks)
    known = slim.where("NOT held_out AND text IS NOT NULL").join(marks, "doc_id")
    n0, n1 = term_counts(known)
    chosen = choose_terms(n0, n1, max_terms)
    wanted = np.full(1 << BUCKET_BITS, -1, dtype=np.int64)
    wanted[chosen] = np.arange(len(chosen))
    shared_wanted = spark.sparkContext.broadcast(wanted)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tk.packed(batch.column(0))
            found = []
            for i, j, part, at in tk.chunks(data, offsets):
                owner, col = present(part, at, shared_wanted.value)
                found += [c.astype("<u2").tobytes() for c in np.split(col, np.searchsorted(owner, np.arange(1, j - i)))]
            yield pa.RecordBatch.from_arrays([batch.column(1).cast(pa.int32()), pa.array(found, pa.binary())], ["toxic", "cols"])

    share = min(1.0, sample_rows / max(1, n_marks))
    draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = known.where(draw < share).select("text", "toxic").mapInArrow(rows, "toxic int, cols binary").limit(2 * sample_rows).toPandas().sort_values(["toxic", "cols"])
    cols = [np.frombuffer(c, "<u2").astype(np.int64) for c in sample["cols"]]
    owner = np.repeat(np.arange(len(cols)), [len(c) for c in cols])
    model = fit_machine(owner, np.concatenate(cols) if cols else np.zeros(0, np.int64), sample["toxic"].to_numpy(dtype=np.float32), len(chosen))
    shared = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, (bias, w, f) = shared_wanted.value, shared.value
        for batch in batches:
            data, offsets = tk.packed(batch.column(1))
            out = []
            for i, j, part, at in tk.chunks(data, offsets):
                n = j - i
                owner, col = present(part, at, wanted)
                out.append(1 / (1 + np.exp(-np.clip(machine_scores(owner, col, n, bias, w, f), -500, 500))))
            p = np.concatenate(out) if out else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(score, f"doc_id {kind}, held_out boolean, score double, predicted int")
