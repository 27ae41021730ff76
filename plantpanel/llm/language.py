"""Language identification: sparse multinomial logistic regression on TF-IDF.

Features are character n-grams (1 to 3) of the folded text, hashed.  Document
frequencies come from every document that may be learned from; the weights are
fitted on a bounded sample with follow-the-regularised-leader and elastic-net
penalties, and a temperature fitted on held-back sample rows calibrates the
probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .common import held_out
from .subwords import LETTER, classes

BUCKETS = 1 << 14
NGRAMS = (1, 2, 3)
#: Bound of the fitting sample: documents over all languages.
SAMPLE_DOCS = 4000
MAX_LANGUAGES = 2000
UNKNOWN_LANGUAGE = "und"
_DOCS_AT_ONCE = 64
_K = np.uint64(0x9E3779B97F4A7C15)
_folds = np.arange(0x110000, dtype=np.uint32)
_folds[[c for c in range(0x3000) if len(chr(c).lower()) == 1]] = [ord(chr(c).lower()) for c in range(0x3000) if len(chr(c).lower()) == 1]


def folded_letters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters with one 0 for each run of anything else, and their texts."""
    points, at = tk.code_points(data, offsets)
    letter = classes(points) == LETTER
    docs = np.repeat(np.arange(len(at) - 1), np.diff(at))
    keep = np.ones(len(points), dtype=bool)
    keep[1:] = letter[1:] | letter[:-1] | (docs[1:] != docs[:-1])
    return np.where(letter, _folds[points], 0)[keep].astype(np.uint64), docs[keep]


def counts(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(first text, n-gram counts as texts x buckets) for a few texts at a time."""
    letters, docs = folded_letters(data, offsets)
    n = len(offsets) - 1
    codes, owners = [], []
    h = np.zeros(len(letters), dtype=np.uint64)
    for size in range(1, max(NGRAMS) + 1):
        stop = len(letters) - size + 1
        if stop <= 0:
            break
        h = h[:stop] * _K + letters[size - 1 :] + np.uint64(1)
        if size in NGRAMS:
            same = docs[:stop] == docs[size - 1 :]
            if size == 1:
                same &= letters > 0
            mixed = tk.mix(h + np.uint64(size))
            codes.append((mixed >> np.uint64(64 - 14)).astype(np.int64)[same])
            owners.append(docs[:stop][same])
    bounds = [np.searchsorted(o, np.arange(0, n + _DOCS_AT_ONCE, _DOCS_AT_ONCE)) for o in owners]
    for k, first in enumerate(range(0, n, _DOCS_AT_ONCE)):
        m = min(_DOCS_AT_ONCE, n - first)
        out = np.zeros(m * BUCKETS, dtype=np.int64)
        for c, o, b in zip(codes, owners, bounds):
            part = slice(b[k], b[k + 1])
            out += np.bincount((o[part] - first) * BUCKETS + c[part], minlength=m * BUCKETS)
        yield first, out.reshape(m, BUCKETS)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """How many of the texts hold each bucket (at most BUCKETS rows reach the driver)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(BUCKETS + 1, dtype=np.int64), 0
        for batch in batches:
            data, offsets = tk.packed(batch.column(0))
            for _, _, part, at in tk.chunks(data, offsets):
                for _, x in counts(part, at):
                    df[:-1] += (x > 0).sum(axis=0)
            n += batch.num_rows
        df[-1] = n
        used = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(df[used])], ["bucket", "df"])

    got = docs.select("text").mapInArrow(count, "bucket long, df long").groupBy("bucket").agg(F.sum("df").alias("df")).toPandas()
    out = np.zeros(BUCKETS + 1)
    out[got["bucket"]] = got["df"]
    return out[:-1], int(out[-1])


def summable(weights: np.ndarray) -> np.ndarray:
    """Single-precision weights on one grid, 24 bits below the largest.

    A text's counts times such weights add up in doubles without rounding (up to
    2**29 n-grams), so its score does not depend on the order of the sum, which
    BLAS chooses by the processor and by how many texts it is given at once.
    """
    top = np.abs(weights).max(initial=0.0)
    step = 2.0 ** (np.ceil(np.log2(top)) - 24) if top > 0 else 1.0
    return (np.rint(weights / step) * step).astype(np.float32)


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, n_classes: int, *, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02, epochs: int = 6) -> np.ndarray:
    """Multinomial FTRL-proximal; the last column of the weights is the bias."""
    shape = (n_classes, BUCKETS + 1)
    z, n = np.zeros(shape), np.zeros(shape)

    def weights(z, n):
        w = -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2)
        return np.where(np.abs(z) <= l1, 0.0, w)

    order = np.random.default_rng(5)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, x = rows[i]
            zi, ni = z[:, at], n[:, at]
            w = weights(zi, ni)
            s = w @ x
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y[i]] -= 1.0
            g = p[:, None] * x
            g2 = g * g
            z[:, at] = zi + g - (np.sqrt(ni + g2) - np.sqrt(ni)) / alpha * w
            n[:, at] = ni + g2
    return weights(z, n)


def fit_temperature(scores: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the scores that makes the held-back labels likeliest."""
    if not len(y):
        return 1.0

    def loss(log_t: float) -> float:
        s = scores / np.exp(log_t)
        s = s - s.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y])) + 1e-3 * log_t**2

    grid = np.linspace(np.log(0.05), np.log(5.0), 93)
    return float(np.exp(grid[int(np.argmin([loss(t) for t in grid]))]))


def identify_languages(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS, seed: int = 3) -> DataFrame:
    """held_out, lang_pred and score (a calibrated probability) of every document.

    Documents whose crc32(id as text) mod 4 is 2 are held out of learning, as
    are rows without a language.  ``und`` with score 0 stands for null texts
    and texts without a letter, and for all when there is nothing to learn
    from.  Texts are read whole, however long; repeated rows are predicted
    alike; of languages with equal scores the first by code point is predicted;
    an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    slim = slim.withColumn("held_out", held_out("doc_id", 4, 2))
    known = slim.where("NOT held_out AND lang IS NOT NULL AND text IS NOT NULL")
    langs = known.groupBy("lang").count().limit(MAX_LANGUAGES + 1).toPandas().sort_values("lang")
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages in {lang_col}")
    names = list(langs["lang"])
    if names:
        df, n_docs = document_frequencies(known)
        idf = np.log((1.0 + n_docs) / (1.0 + df)) + 1.0
        share = np.minimum(1.0, sample_docs / len(names) / langs["count"].to_numpy())
        quota = F.broadcast(spark.createDataFrame(list(zip(names, map(float, share))), "lang string, share double"))
        draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
        sample = known.join(quota, "lang").where(draw < F.col("share")).limit(2 * sample_docs)
        weights, temperature = _fit(sample, names, idf)
    else:
        idf, weights, temperature = np.ones(BUCKETS), np.zeros((0, BUCKETS + 1)), 1.0
    shared = spark.sparkContext.broadcast((summable(idf[:, None] * weights[:, :-1].T), weights[:, -1], idf**2, temperature, names))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, bias, idf2, t, names = shared.value
        w = w.astype(np.float64)
        labels = np.array([*names, UNKNOWN_LANGUAGE], dtype=object)
        for batch in batches:
            data, offsets = tk.packed(batch.column(1))
            best, score = np.full(batch.num_rows, len(names)), np.zeros(batch.num_rows)
            for i, _, part, at in tk.chunks(data, offsets):
                for first, x in counts(part, at) if names else ():
                    x = x.astype(np.float64)
                    s = x @ w
                    np.multiply(x, x, out=x)
                    # Summed row by row: a matrix product adds up by the number of rows.
                    norm = np.sqrt(np.multiply(x, idf2, out=x).sum(axis=1))
                    some = norm > 0
                    s = (s / np.maximum(norm, 1e-9)[:, None] + bias) / t
                    p = np.exp(s - s.max(axis=1, keepdims=True))
                    p /= p.sum(axis=1, keepdims=True)
                    rows = slice(i + first, i + first + len(x))
                    top = p.argmax(axis=1)
                    best[rows] = np.where(some, top, len(names))
                    score[rows] = np.where(some, p[np.arange(len(x)), top], 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(labels[best], pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.select("doc_id", "text", "held_out").mapInArrow(predict, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def _fit(sample: DataFrame, names: list[str], idf: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and temperature from the bounded sample, whose sparse rows come to the driver."""
    idf32 = idf.astype(np.float32)

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tk.packed(batch.column(1))
            at_, x_ = [], []
            for _, _, part, at in tk.chunks(data, offsets):
                for _, x in counts(part, at):
                    for row in x:
                        used = np.flatnonzero(row)
                        v = row[used] * idf32[used]
                        at_.append(used.astype("<u2").tobytes())
                        x_.append((v / np.sqrt((v * v).sum()) if len(v) else v).astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at_, pa.binary()), pa.array(x_, pa.binary())], ["lang", "at", "x"])

    got = sample.select("lang", "text").mapInArrow(sparse, "lang string, at binary, x binary").toPandas().sort_values(["lang", "at", "x"])
    code = {lang: i for i, lang in enumerate(names)}
    y = np.array([code[lang] for lang in got["lang"]], dtype=np.int64)
    rows = [(np.append(np.frombuffer(a, "<u2").astype(np.int64), BUCKETS), np.append(np.frombuffer(x, "<f4").astype(float), 1.0)) for a, x in zip(got["at"], got["x"])]
    some = [i for i, (at, _) in enumerate(rows) if len(at) > 1]
    back = [i for k, i in enumerate(some) if k % 5 == 4]
    fit = [i for k, i in enumerate(some) if k % 5 != 4]
    weights = fit_ftrl([rows[i] for i in fit], y[fit], len(names))
    scores = np.array([weights[:, at] @ x for at, x in (rows[i] for i in back)]).reshape(-1, len(names))
    return weights, fit_temperature(scores, y[back])
