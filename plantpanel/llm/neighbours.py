"""Approximate nearest neighbours from randomly rotated one-bit codes.

Every vector, less the centre, is rotated at random and kept as the signs of
its coordinates plus two correction scalars: its length and the code's own
inner product with the unit vector.  A rotated query is cut into ``QUERY_BITS``
bit planes, so its inner product with a code is a sum of bit counts over packed
words, and with the scalars it estimates the inner product of the originals
within a bound that holds with high probability.  Only vectors whose bound
reaches the best ones found are reranked with their original values.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settled

#: Vectors in a base block and queries in a query block.
BLOCK_VECTORS = 4096
BLOCK_QUERIES = 2048
#: Bits of a rotated query's coordinates.
QUERY_BITS = 4
#: Width of the error bound in standard errors.
BOUND = 2.5
#: Bound of the sample that the centre is fitted on.
CENTRE_SAMPLE = 20_000


def rotation(dim: int, seed: int = 41) -> np.ndarray:
    """A random orthogonal matrix, the same for the same arguments."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def packed_words(signs: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words, filled up with zeros."""
    raw = np.packbits(signs, axis=1)
    full = np.zeros((len(raw), (raw.shape[1] + 7) // 8 * 8), dtype=np.uint8)
    full[:, : raw.shape[1]] = raw
    return full.view(np.uint64)


def encode(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, residual lengths, and code-vector inner products."""
    rest = (vectors - centre) @ turn.T
    length = np.sqrt((rest * rest).sum(axis=1))
    signs = rest >= 0
    own = np.where(length > 0, np.abs(rest).sum(axis=1) / np.maximum(length, 1e-300) / math.sqrt(vectors.shape[1]), 1.0)
    return packed_words(signs), length, own


class Query:
    """One query against packed codes."""

    def __init__(self, query: np.ndarray, centre: np.ndarray, turn: np.ndarray, bits: int = QUERY_BITS):
        turned = turn @ query
        self.low = float(turned.min())
        self.step = max((float(turned.max()) - self.low) / ((1 << bits) - 1), 1e-300)
        level = np.rint((turned - self.low) / self.step).astype(np.int64)
        self.total = int(level.sum())
        self.planes = [packed_words((level >> k & 1 > 0)[None, :])[0] for k in range(bits)]
        self.shift, self.length, self.dim = float(query @ centre), float(np.sqrt(query @ query)), len(query)

    def estimate(self, words: np.ndarray, ones: np.ndarray, scale: np.ndarray, spread: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated inner products with the vectors of the codes, and their error bounds.

        ``ones`` counts the bits of each code; ``scale`` and ``spread`` come from its two scalars.
        """
        common = np.zeros(len(words), dtype=np.int32)
        for k, plane in enumerate(self.planes):
            for column, word in zip(words.T, plane):
                common += np.bitwise_count(column & word).astype(np.int32) << k
        # Code entries are +1 and -1: twice what the ones have less what all have.
        inner = self.step * (2 * common - self.total) + self.low * (2 * ones - self.dim)
        rounding = self.step * math.sqrt(self.dim / 12)
        return inner * scale + self.shift, BOUND * (self.length * spread + rounding * scale)


def scalars(words: np.ndarray, length: np.ndarray, own: np.ndarray, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit counts of codes, factors of their estimates, and standard errors for a query of length 1."""
    spread = length * np.sqrt(np.maximum(1 - own * own, 0)) / own / math.sqrt(max(dim - 1, 1))
    return np.bitwise_count(words).sum(axis=1, dtype=np.int64), length / own / math.sqrt(dim), spread


def exact(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision, added from the first component to the last."""
    return np.add.accumulate(vectors * query, axis=1)[:, -1]


def best_of(ids: np.ndarray, score: np.ndarray, k: int, slack: float) -> np.ndarray:
    """Entries among the k largest, or within ``slack`` of them."""
    if len(ids) <= k:
        return np.arange(len(ids))
    return np.flatnonzero(score >= np.partition(score, len(ids) - k)[len(ids) - k] - slack)


def search_block(q_ids, queries, ids, vectors, words, length, own, centre, turn, k):
    """The k nearest of one block for each query, by bound-guided reranking."""
    ones, scale, spread = scalars(words, length, own, queries.shape[1])
    out = []
    for q_id, v in zip(q_ids, queries):
        query = Query(v, centre, turn)
        about, bound = query.estimate(words, ones, scale, spread)
        about[ids == q_id] = -np.inf  # a query is no candidate of its own
        # The vectors that look nearest set the floor; those whose bound reaches it are reranked.
        first = best_of(ids, about, k, 0.0)
        first = first[np.isfinite(about[first])]
        floor = np.partition(vectors[first] @ v, len(first) - k)[len(first) - k] if len(first) >= k else -np.inf
        slack = 1e-9 * query.length * (float(length.max()) + float(np.linalg.norm(centre)))
        near = about + bound >= floor - slack
        near[first] = True
        at = np.flatnonzero(near & (about > -np.inf))
        at = at[best_of(at, vectors[at] @ v, k, slack)]
        score = exact(vectors[at], v)
        order = np.lexsort((ids[at], -score))[:k]
        out.append((np.full(len(order), q_id), ids[at[order]], score[order]))
    return [np.concatenate(x) for x in zip(*out)]


def usable(column: F.Column) -> F.Column:
    """Not null, not empty, no null or non-finite component, not all zeros."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return column.isNotNull() & (F.size(column) > 0) & ~bad & F.exists(column, lambda x: x != 0)


def nearest(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", query_modulus: int = 20, k: int = 20, block_vectors: int = BLOCK_VECTORS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """The k nearest vectors of every query by inner product.

    Queries are the rows whose id is divisible by ``query_modulus``, candidates
    all rows but the query's own.  Vectors that are null, zero, or hold null or
    non-finite components take no part, nor do those of another length than the
    commonest (ties: the smaller) and rows with a null id.  Rows repeated with
    the same id and values count once; nearest first, ties to the smaller id;
    an empty table gives no rows; other columns are ignored.

    Every meeting of a query block and a base block is a key of its own in an
    equi-join, so work spreads by blocks of both, and emits at most k rows for
    each query.  Original vectors travel with their codes, in the table's own
    precision: of a block of queries some have almost every vector as a
    candidate, so fetching candidates afterwards would move them all the same.
    Ids must be whole numbers, since queries are told by division.
    """
    spark = vectors.sparkSession
    single = vectors.schema[vector_col].dataType.simpleString() == "array<float>"
    real = np.float32 if single else np.float64
    slim = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(f"array<{'float' if single else 'double'}>").alias("v"))
    slim = slim.where(F.col("id").isNotNull()).where(usable(F.col("v")))
    sizes = slim.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return spark.createDataFrame([], schema)
    dim = int(sizes["dim"])
    slim = slim.where(F.size("v") == dim)
    n = int(sizes["count"])
    share = min(1.0, CENTRE_SAMPLE / n)
    draw = F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(1 << 30)) / float(1 << 30)
    # Means of the dim coordinates over the sample: one row.
    centre = slim.where(draw < share).agg(F.array(*[F.avg(F.get("v", F.lit(i))) for i in range(dim)]).alias("c")).first()["c"]
    centre = np.array([c or 0.0 for c in centre])
    shared = spark.sparkContext.broadcast((centre, rotation(dim)))
    n_blocks = math.ceil(n / block_vectors)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, turn = shared.value
        for batch in batches:
            v = np.asarray(batch.column(1).flatten().to_numpy(zero_copy_only=False), dtype=real).reshape(-1, dim)
            bits, length, own = encode(v.astype(np.float64), centre, turn)
            raw = [pa.array([row.tobytes() for row in x], pa.binary()) for x in (v, bits)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *raw, pa.array(length), pa.array(own)], ["id", "v", "bits", "length", "own"])

    index = settled(slim.dropDuplicates(["id", "v"]).mapInArrow(coded, "id long, v binary, bits binary, length double, own double"))

    def blocks(rows: DataFrame, number: int, columns: list[str], name: str) -> DataFrame:
        """One row per block: its columns packed into binary fields."""
        def pack(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("id", kind="stable")
            first = {name: int(pdf["block"].iloc[0]), f"{name}_ids": pdf["id"].to_numpy(dtype=np.int64).tobytes()}
            for c in columns:
                one = pdf[c]
                first[f"{name}_{c}"] = b"".join(one) if one.dtype == object else one.to_numpy(dtype=np.float64).tobytes()
            return pd.DataFrame([first])

        kinds = ", ".join([f"{name} int", f"{name}_ids binary", *(f"{name}_{c} binary" for c in columns)])
        hashed = rows.withColumn("block", F.pmod(F.xxhash64(F.lit(13), "id"), F.lit(number)).cast("int"))
        return hashed.groupBy("block").applyInPandas(pack, kinds)

    asked = index.where(F.col("id") % query_modulus == 0)
    q_blocks = max(1, math.ceil(asked.count() / block_queries))
    queries = blocks(asked.select("id", "v"), q_blocks, ["v"], "q")
    base = blocks(index, n_blocks, ["v", "bits", "length", "own"], "b")

    def each(number: int) -> F.Column:
        return F.explode(F.sequence(F.lit(0), F.lit(number - 1)))

    pairs = base.withColumn("q", each(q_blocks)).join(queries.withColumn("b", each(n_blocks)).hint("shuffle_hash"), ["q", "b"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, turn = shared.value
        for batch in batches:
            for at in range(batch.num_rows):
                row = {c: batch.column(i)[at].as_py() for i, c in enumerate(batch.schema.names)}
                ids = np.frombuffer(row["b_ids"], np.int64)
                found = search_block(
                    np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["q_v"], real).reshape(-1, dim).astype(np.float64),
                    ids, np.frombuffer(row["b_v"], real).reshape(-1, dim).astype(np.float64),
                    np.frombuffer(row["b_bits"], np.uint64).reshape(len(ids), -1),
                    np.frombuffer(row["b_length"], np.float64), np.frombuffer(row["b_own"], np.float64), centre, turn, k,
                )
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["query_id", "vec_id", "score"])

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    met = pairs.mapInArrow(meet, "query_id long, vec_id long, score double")
    return met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
