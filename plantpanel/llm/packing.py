"""Best-fit packing of tokenised documents into fixed-length sequences.

Online best fit in bounded space: a fixed number of open bins is kept in a
bitset keyed by free space, so the tightest bin that still holds a piece is
found with two bit operations; when too many bins are open, the fullest closes.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .common import settled, unused
from .subwords import ByteLevelIds

SEQUENCE_TOKENS = 2048
OPEN_BINS = 256
#: Pieces that one packing group has on average.
GROUP_PIECES = 20_000
#: Equal pieces of a document (of rows repeated so often) that go to one group.
REPEATS = 1000
#: Hashes of pieces repeated more often are broadcast up to this many (16 bytes each).
BROADCAST_HASHES = 1_000_000


class OpenBins:
    """At most ``limit`` open bins of ``capacity``; ``place`` returns (bin, offset).

    ``n_closed`` counts the bins that closed because the limit was reached.
    """

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits = 0  # bit f: some open bin has f tokens free
        self.n_open = self.n_bins = self.n_closed = 0

    def place(self, length: int) -> tuple[int, int]:
        fits = self.bits >> length
        if length and fits:
            free = length + ((fits & -fits).bit_length() - 1)
            number = self._take(free)
        else:
            free, number = self.capacity, self.n_bins
            self.n_bins += 1
        offset = self.capacity - free
        left = free - length
        if left:  # a full bin closes by itself
            if self.n_open == self.limit:  # the fullest closes first
                self._take((self.bits & -self.bits).bit_length() - 1)
                self.n_closed += 1
            self.by_free[left].append(number)
            self.bits |= 1 << left
            self.n_open += 1
        return number, offset

    def _take(self, free: int) -> int:
        number = self.by_free[free].pop()
        if not self.by_free[free]:
            self.bits &= ~(1 << free)
        self.n_open -= 1
        return number


def piece_bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be shorter."""
    first = n % capacity
    starts = ([0] if first else []) + list(range(first, n, capacity))
    return [(s, min(capacity, first if s == 0 and first else capacity)) for s in starts]


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = SEQUENCE_TOKENS, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if asked for, the ids."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ByteLevelIds.shared(tokenizer_path)
        for batch in batches:
            data, offsets = tk.packed(batch.column(1))
            for i, j, part, at in tk.chunks(data, offsets):
                ids, ends = encoder.encode(part, at, end_id=0)
                rows: list[tuple[int, int, int, int, int]] = []
                kept = []
                begin = 0
                for d, end in enumerate(ends):
                    for k, (s, n) in enumerate(piece_bounds(int(end - begin), capacity)):
                        piece = ids[begin + s : begin + s + n]
                        rows.append((i + d, k, s, n, zlib.crc32(piece)))
                        if with_ids:
                            kept.append(piece)
                    begin = int(end)
                cols = list(zip(*rows))
                arrays = [batch.column(0).take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[2:])]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.array(kept, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    return slim.mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)


def pack_best_fit(pieces: DataFrame, *, capacity: int = SEQUENCE_TOKENS, open_bins: int = OPEN_BINS, group_pieces: int = GROUP_PIECES, seed: int = 11) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of at most ``capacity`` tokens.

    Pieces are spread over groups by a seeded hash (a document's own pieces
    too), ``group_pieces`` on average whatever the corpus size, and each group
    is packed on its own: its pieces arrive in seeded order, are placed once
    and stay, with at most ``open_bins`` bins open.  Pieces that repeated rows
    have in common are dealt to groups ``REPEATS`` at a time.  Pieces without
    tokens open a bin of their own; a null id takes part like any other; no
    pieces give no rows.  The columns of ``pieces`` stay.
    """
    pieces = settled(pieces)
    order, salt, group = unused(pieces.columns, "_order", "_salt", "_group")
    groups = max(1, math.ceil(pieces.where(F.col("length") < capacity).count() / group_pieces))
    # Full pieces are sequences of their own; they need no search.
    full = pieces.where(F.col("length") >= capacity)
    rest = pieces.where(F.col("length") < capacity).withColumn(order, F.xxhash64(F.lit(seed), "doc_id", "piece", "start", "length", "ids_crc32"))
    often = settled(rest.groupBy(F.col(order).alias("_often")).agg(F.ceil(F.count("*") / REPEATS).alias("_parts")).where("_parts > 1"))
    if often.count() <= BROADCAST_HASHES:
        often = F.broadcast(often)
    rest = rest.join(often, F.col(order) == F.col("_often"), "left").withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.coalesce("_parts", F.lit(1))))
    rest = rest.withColumn(group, F.pmod(F.xxhash64(F.lit(seed + 1), order, salt), F.lit(groups)).cast("int")).drop("_often", "_parts", salt)

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([order, "doc_id", "piece"], kind="stable")
        bins = OpenBins(capacity, open_bins)
        spots = [bins.place(int(n)) for n in pdf["length"]]
        base = (int(pdf[group].iloc[0]) + 1) << 32
        pdf["sequence_id"] = np.array([base + b for b, _ in spots], dtype=np.int64)
        pdf["offset"] = np.array([o for _, o in spots], dtype=np.int64)
        return pdf[[*columns, "sequence_id", "offset"]]

    columns = pieces.columns
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    packed = rest.groupBy(group).applyInPandas(pack, f"{kinds}, sequence_id long, offset long")
    alone = full.select(*columns, (-F.monotonically_increasing_id() - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(alone)


def pack_documents(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = SEQUENCE_TOKENS, open_bins: int = OPEN_BINS) -> DataFrame:
    """Tokenise, cut and pack documents; one row per piece.

    A null text counts as empty and has just the end id.  Texts of any length
    are cut into pieces of ``capacity`` tokens.  Repeated rows are packed each;
    an empty table gives no rows; other columns are ignored.
    """
    return pack_best_fit(tokenized_pieces(docs, tokenizer_path, id_col=id_col, text_col=text_col, capacity=capacity), capacity=capacity, open_bins=open_bins)
