"""Ranked lexical search over bit-sliced Bloom signatures.

The index holds blocks of documents of about equal size.  A block is a bit
matrix: a document sets, for each of its terms and each frequency level that the
term reaches in it, a few rows of its own column.  Read by rows, the bitmaps of
a term say which documents may hold it how often, never too little, so sums of
its weight over them are upper bounds of the scores.  The best bounds of an item
are scored first; then every document whose bound reaches the tenth best of
these scores is scored exactly from its text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textkit as tk
from .common import settled

#: Frequencies from which on a term sets further rows.
LEVELS = np.array([1, 2, 3, 4, 6, 9, 14, 24, 48])
#: Rows that one (term, level) sets, and rows of a block for each of its largest document's (terms, levels).
HASHES, ROWS_A_KEY = 4, 8
#: Documents in a block at most, and bits of a block.
BLOCK_DOCS, BLOCK_BITS = 4096, 1 << 25
#: Terms of the items searched together; more items are searched in several groups.
GROUP_TERMS = 50_000
#: Documents whose ids and items are broadcast at most; more are joined by shuffling.
BROADCAST_DOCS = 200_000
#: Bounds that an item's first exact scores are taken from, for each rank wanted.
FIRST = 3

_TERM = np.zeros(256, dtype=bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEPS = np.random.default_rng(11).integers(1, 2**63, len(LEVELS) + HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def terms_of(text: str | None) -> list[bytes]:
    """The terms of one (short) text, in order, A-Z in lower case."""
    data = _LOWER[np.frombuffer((text or "").encode(), dtype=np.uint8)]
    starts, ends = tk.runs(_TERM[data], np.array([0, len(data)]))
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(starts, ends)]


class Terms:
    """The distinct terms of a group of items, found in texts by hash and then byte by byte."""

    def __init__(self, terms: list[bytes]):
        self.n = len(terms)
        data = np.frombuffer(b"".join(terms), dtype=np.uint8)
        ends = np.cumsum([len(x) for x in terms]).astype(np.int64)
        starts = ends - [len(x) for x in terms] if self.n else ends
        self.hashes = tk.Hasher(data).spans(starts, ends) if self.n else np.zeros(0, np.uint64)
        order = np.argsort(self.hashes)
        self._sorted, self._number = self.hashes[order], order
        self._data, self._starts, self._sizes = data, starts, ends - starts
        if (self._sorted[1:] == self._sorted[:-1]).any():
            raise ValueError("two terms of the items share their 64-bit hash")

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the tokens that are terms of the items, and these terms' numbers."""
        if not self.n or not len(hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self._sorted, hashes), self.n - 1)
        token = np.flatnonzero(self._sorted[at] == hashes)
        term = self._number[at[token]]
        same = ends[token] - starts[token] == self._sizes[term]
        token, term = token[same], term[same]
        size = self._sizes[term]
        first = np.cumsum(size) - size
        inside = np.arange(int(size.sum())) - np.repeat(first, size)
        equal = data[np.repeat(starts[token], size) + inside] == self._data[np.repeat(self._starts[term], size) + inside]
        if not equal.all():
            good = np.logical_and.reduceat(equal, first)
            token, term = token[good], term[good]
        return token, term


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, and start, end, hash and owner of every term of a chunk of texts."""
    low = _LOWER[data]
    starts, ends = tk.runs(_TERM[low], offsets)
    return low, starts, ends, tk.Hasher(low).spans(starts, ends), tk.owner(offsets, starts)


def _rows(hashes: np.ndarray, level: np.ndarray | int, n_rows: int) -> np.ndarray:
    """The rows (HASHES of them, in the last axis) that terms set at a level."""
    key = tk.mix(hashes ^ _STEPS[level])
    return (tk.mix(key[..., None] * _STEPS[len(LEVELS) :]) & np.uint64(n_rows - 1)).astype(np.int64)


class _Blocks:
    """Documents of one task on their way into blocks, by the size of their signatures."""

    def __init__(self):
        self.open: dict[int, list] = {}

    def add(self, doc_id, n: int, hashes: np.ndarray, levels: np.ndarray) -> tuple | None:
        """Keeps a document's (term, level) keys; gives back a block that has become full."""
        size = max(4, int(len(hashes) - 1).bit_length())
        kept = self.open.setdefault(size, [])
        kept.append((doc_id, n, hashes, levels))
        return self.close(size) if len(kept) >= max(1, min(BLOCK_DOCS, BLOCK_BITS // (ROWS_A_KEY << size))) else None

    def close(self, size: int) -> tuple:
        docs, n_rows = self.open.pop(size), ROWS_A_KEY << size
        column = np.repeat(np.arange(len(docs)), [len(d[2]) for d in docs])
        rows = _rows(np.concatenate([d[2] for d in docs]), np.concatenate([d[3] for d in docs]), n_rows)
        bits = np.zeros((n_rows, len(docs)), dtype=bool)
        for k in range(HASHES):
            bits[rows[:, k], column] = True
        return n_rows, [d[0] for d in docs], [d[1] for d in docs], np.packbits(bits, axis=1).tobytes()


def build_index(docs: DataFrame, terms: Terms, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Signatures of all documents that have a term, and counts of the items' terms.

    Rows are blocks (n_rows, ids, sizes, slices) and, one for each task, the
    numbers of its documents that hold each of ``terms`` (term, df).
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, df, id_type = _Blocks(), np.zeros(terms.n, np.int64), None

        def row(n_rows=None, ids=None, sizes=None, slices=None, term=None, count=None) -> pa.RecordBatch:
            values = zip((n_rows, ids, sizes, slices, term, count), (pa.int64(), pa.list_(id_type), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())))
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in values], ["n_rows", "ids", "sizes", "slices", "term", "df"])

        for batch in batches:
            id_type = batch.schema.field(0).type
            ids = batch.column(0).to_pylist()
            data, offsets = tk.packed(batch.column(1))
            for first, last, part, at in tk.chunks(data, offsets):
                low, starts, ends, hashes, owner = _tokens(part, at)
                token, term = terms.find(low, starts, ends, hashes)
                df += np.bincount(np.unique(owner[token] * max(terms.n, 1) + term) % max(terms.n, 1), minlength=terms.n)[: terms.n]
                order = np.argsort(hashes, kind="stable")
                order = order[np.argsort(owner[order], kind="stable")]
                own, by = owner[order], hashes[order]
                new = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (by[1:] != by[:-1])])[: len(by)])
                tf = np.diff(np.append(new, len(by)))
                reached = np.searchsorted(LEVELS, tf, side="right")  # levels, one at least
                key_hash, key_level = np.repeat(by[new], reached), np.arange(int(reached.sum())) - np.repeat(np.cumsum(reached) - reached, reached)
                upto = np.searchsorted(np.repeat(own[new], reached), np.arange(last - first + 1))
                sizes = np.bincount(owner, minlength=last - first)
                for d in np.flatnonzero(sizes):
                    full = blocks.add(ids[first + d], int(sizes[d]), key_hash[upto[d] : upto[d + 1]], key_level[upto[d] : upto[d + 1]].astype(np.int8))
                    if full is not None:
                        yield row(*full)
        if id_type is not None:
            for size in list(blocks.open):
                yield row(*blocks.close(size))
            held = np.flatnonzero(df)
            yield row(term=held, count=df[held])

    return slim.mapInArrow(build, f"n_rows long, ids array<{kind}>, sizes array<long>, slices binary, term array<long>, df array<long>")


class Items:
    """The items of a group: their terms with repeats, weights, and bounds and exact scores from them."""

    def __init__(self, keys: list, terms_of_items: list[list[bytes]], terms: list[bytes]):
        self.keys, self.terms = keys, Terms(terms)
        number = {t: k for k, t in enumerate(terms)}
        counted = [np.unique([number[t] for t in ts], return_counts=True) if ts else (np.zeros(0, np.int64),) * 2 for ts in terms_of_items]
        self.own, self.times = [c[0].astype(np.int64) for c in counted], [c[1].astype(np.int64) for c in counted]
        self.weights, self.n_docs, self.n_terms = np.zeros(len(terms), np.int64), 0, 0

    def weigh(self, n_docs: int, n_terms: int, df: dict[int, int]) -> None:
        self.n_docs, self.n_terms = n_docs, n_terms
        self.weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(k, 0) + 1))) for k in range(self.terms.n)], dtype=np.int64)

    def length(self, sizes: np.ndarray) -> np.ndarray:
        """The lengths m of documents of these sizes."""
        if sizes.size and 75 * int(sizes.max()) * self.n_docs >= 2**63:
            return np.array([25 + 75 * int(n) * self.n_docs // self.n_terms for n in sizes], dtype=np.int64)
        return 25 + (75 * sizes * self.n_docs) // max(self.n_terms, 1)

    @cached_property
    def _keys(self) -> list[np.ndarray]:
        return [tk.mix(self.terms.hashes ^ _STEPS[k])[:, None] * _STEPS[len(LEVELS) :] for k in range(len(LEVELS))]

    def bounds(self, n_rows: int, sizes: np.ndarray, slices: bytes) -> np.ndarray:
        """Upper bounds of the scores, one row for each item and one column for each document of a block."""
        n = len(sizes)
        bitmaps = np.frombuffer(slices, dtype=np.uint8).reshape(n_rows, -1)
        level = np.zeros((self.terms.n, n), dtype=np.int8)
        alive, so_far = np.arange(self.terms.n), None
        for keys in self._keys:
            rows = (tk.mix(keys[alive]) & np.uint64(n_rows - 1)).astype(np.int64)
            held = bitmaps[rows[:, 0]]
            for k in range(1, HASHES):
                held &= bitmaps[rows[:, k]]
            if so_far is not None:
                held &= so_far
            some = held.any(axis=1)
            alive, so_far = alive[some], held[some]
            if not len(alive):
                break
            level[alive] += np.unpackbits(so_far, axis=1, count=n).view(np.int8)
        # The most a term can add at each level: the frequency just below the next one, at most all of the document.
        m, most = self.length(sizes), np.append(LEVELS[1:] - 1, np.iinfo(np.int64).max)
        tf = np.minimum(most[:, None], sizes[None, :]).astype(np.float64)
        part = np.vstack([np.zeros(n), 1e9 * tf / (1000 * tf + 8 * m)]).astype(np.float32)
        flat, column = part.ravel(), np.arange(n)
        out = np.empty((len(self.keys), n), dtype=np.float32)
        for k, (own, times) in enumerate(zip(self.own, self.times)):
            adds = flat[level[own].astype(np.int64) * n + column]
            # Widened by more than single precision may lose in a sum of so many.
            out[k] = (times * self.weights[own]).astype(np.float32) @ adds * np.float32(1.0001 + 2e-7 * len(own)) if len(own) else 0
        return out

    def scores(self, items: np.ndarray, tf: np.ndarray, m: int) -> list[int]:
        """Exact scores of one document for some items; tf holds its frequency of each term."""
        out = []
        for k in items:
            own = self.own[k]
            f = tf[own]
            out.append(int((self.times[k] * self.weights[own] * ((1_000_000_000 * f) // (1000 * f + 8 * m))).sum()))
        return out


def _bounded(index: DataFrame, items, floors: np.ndarray | None, keep: int) -> DataFrame:
    """(doc_id, item, bound): of every block the ``keep`` best of an item or, with ``floors``, all that reach an item's."""
    blocks = index.where("slices IS NOT NULL").select("n_rows", "sizes", "slices", "ids")
    kind = index.schema["ids"].dataType.elementType.simpleString()

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = items.value
        for batch in batches:
            for r in range(batch.num_rows):
                ids = batch.column(3)[r].values
                b = group.bounds(batch.column(0)[r].as_py(), batch.column(1)[r].values.to_numpy(), batch.column(2)[r].as_buffer())
                if floors is not None:
                    item, doc = np.nonzero((b >= floors[:, None]) & (b > 0))
                else:
                    doc = np.argpartition(-b, min(keep, b.shape[1]) - 1, axis=1)[:, :keep]
                    item, doc = np.repeat(np.arange(len(b)), doc.shape[1]), doc.ravel()
                    some = b[item, doc] > 0
                    item, doc = item[some], doc[some]
                for lo in range(0, len(item), 1 << 18):
                    i, d = item[lo : lo + (1 << 18)], doc[lo : lo + (1 << 18)]
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(d)), pa.array(i.astype(np.int32)), pa.array(b[i, d])], ["doc_id", "item", "bound"])

    return blocks.mapInArrow(bound, f"doc_id {kind}, item int, bound float")


def _scored(docs: DataFrame, wanted: DataFrame, items, bounded: bool) -> DataFrame:
    """(item, doc_id, score): exact scores above 0 of the wanted (doc_id, item) from the documents' texts."""
    by_doc = wanted.groupBy("doc_id").agg(F.collect_set("item").alias("items"))
    by_doc = by_doc.withColumnRenamed("doc_id", "_of")
    found = docs.join(F.broadcast(by_doc) if bounded else by_doc, F.col("doc_id").eqNullSafe(F.col("_of"))).select("doc_id", "text", "items")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = items.value
        tf = np.zeros(group.terms.n, np.int64)
        for batch in batches:
            data, offsets = tk.packed(batch.column(1))
            item, doc, points = [], [], []
            for first, last, part, at in tk.chunks(data, offsets):
                low, starts, ends, hashes, owner = _tokens(part, at)
                token, term = group.terms.find(low, starts, ends, hashes)
                m = group.length(np.bincount(owner, minlength=last - first))
                upto = np.searchsorted(owner[token], np.arange(last - first + 1))
                for d in range(last - first):
                    mine = term[upto[d] : upto[d + 1]]
                    np.add.at(tf, mine, 1)
                    asked = batch.column(2)[first + d].values.to_numpy()
                    points += group.scores(asked, tf, int(m[d]))
                    item.append(asked)
                    doc.append(np.full(len(asked), first + d))
                    tf[mine] = 0
            if points:
                good = np.flatnonzero(np.array(points, np.int64) > 0)
                item, doc = np.concatenate(item)[good], np.concatenate(doc)[good]
                yield pa.RecordBatch.from_arrays([pa.array(item.astype(np.int32)), batch.column(0).take(pa.array(doc)), pa.array(np.array(points, np.int64)[good])], ["item", "doc_id", "score"])

    return found.mapInArrow(score, f"item int, doc_id {kind}, score long")


def _best(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search(docs: DataFrame, asked: list, k: int) -> DataFrame:
    """(item, rank, doc_id, score) of a group of items, given as rows (item_id, text); items are numbered."""
    spark = docs.sparkSession
    of = [terms_of(r[1]) for r in asked]
    items = Items([r[0] for r in asked], of, sorted({t for ts in of for t in ts}))
    index = settled(build_index(docs, items.terms))
    counts = index.where("slices IS NOT NULL").agg(F.sum(F.size("sizes")), F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b))).first()
    df = index.select(F.explode(F.arrays_zip("term", "df")).alias("c")).groupBy("c.term").agg(F.sum("c.df")).collect()  # a row for each term of the group
    items.weigh(counts[0] or 0, counts[1] or 0, {r[0]: r[1] for r in df})
    shared = spark.sparkContext.broadcast(items)
    first = Window.partitionBy("item").orderBy(F.desc("bound"))
    tops = _bounded(index, shared, None, FIRST * k).withColumn("at", F.row_number().over(first)).where(F.col("at") <= FIRST * k).select("doc_id", "item")
    seen = _best(_scored(docs, settled(tops), shared, len(asked) * FIRST * k <= BROADCAST_DOCS), k)
    floors = np.zeros(len(asked), np.float32)
    for r in seen.where(F.col("rank") == k).select("item", "score").collect():  # a row for each item of the group
        floors[r[0]] = r[1]
    wanted = settled(_bounded(index, shared, floors, 0).select("doc_id", "item"))
    return _best(_scored(docs, wanted, shared, wanted.select("doc_id").distinct().count() <= BROADCAST_DOCS), k)


def search(
    docs: DataFrame,
    items: DataFrame,
    *,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The k best documents of every item: item_id, rank, doc_id, score.

    A term's weight is floor(1000 ln((2N+2)/(2df+1))), a document's score sums
    weight * (10^9 tf div (1000 tf + 8 m)) over the item's terms with their
    repeats, with m = 25 + (75 n N div L); all counts cover all documents.
    Only documents that an upper bound rules out go unscored, so the result is
    exact.  Equal scores are ranked by id; rows that repeat an id are ranked
    each.  Null and empty texts have no terms: such documents are not found and
    such items find nothing.  An item that repeats with the same text counts
    once; an empty table gives no rows; other columns are ignored.  Texts are
    read whole, however long.

    The items are taken in groups of at most about ``GROUP_TERMS`` terms, so
    what a task holds of them is bounded however many there are.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    asked = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text")).where("text IS NOT NULL").distinct()
    chars, n = asked.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)), F.count("*")).first()
    n_groups = max(1, math.ceil(max(chars / 4 / GROUP_TERMS, n / 1024)))
    kind, id_kind = asked.schema["item_id"].dataType, docs.schema["doc_id"].dataType.simpleString()
    parts = []
    for group in range(n_groups):
        rows = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_groups)) == group).collect()  # bounded by GROUP_TERMS
        if rows:
            found = _search(docs, rows, k)
            names = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], f"item int, item_id {kind.simpleString()}")
            parts.append(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    if not parts:
        return spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id {id_kind}, score long")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
