"""Mixing sources to target weights by Sainte-Lague apportionment.

The mix is cut into blocks of equally many words.  Sources receive blocks by
the highest quotients ``target / (2k + 1)``; each source's blocks are dealt on
to its groups of shards and to the shards of each group the same way, and
inside a shard, whose documents lie in seeded order, a seeded choice of blocks
says which of them the mix takes.  What a full shard cannot take goes to the
next ones.  No step holds more than one shard, or one group of shards, of one
source in a task, so a source with a third of all rows is cut into many.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textkit as tk
from .common import settled, unused

#: Words are runs of anything but white space.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHT_CYCLE = (5.0, 2.0, 1.0)
MAX_REPEATS = 3
#: Shards that are dealt to together.
GROUP_SHARDS = 1000
#: Equal rows that go to one shard.
REPEATS = 1000
#: Hashes of rows repeated more often are broadcast up to this many (16 bytes each).
BROADCAST_HASHES = 1_000_000


def word_count(text: F.Column) -> F.Column:
    """Number of words of a text; null gives 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(caps: np.ndarray, weights: np.ndarray, total: float) -> np.ndarray:
    """Share ``total`` by weight; what exceeds a cap is shared again among the rest."""
    out = np.zeros(len(caps))
    open_ = caps > 0
    left = min(float(total), float(caps.sum()))
    while left > 1e-9 and open_.any():
        share = left * weights[open_] / weights[open_].sum()
        over = share >= caps[open_]
        if not over.any():
            out[open_] = share
            break
        full = np.flatnonzero(open_)[over]
        out[full] = caps[full]
        left -= caps[full].sum()
        open_[full] = False
    return out


def sainte_lague(votes: np.ndarray, seats: int, most: np.ndarray | None = None) -> np.ndarray:
    """Seats by the highest quotients ``votes / (2k + 1)``, ties to the earlier entry.

    A divisor found by bisection gives all but a few seats at once; the last
    ones are dealt one by one from a heap of next quotients, so the cost does
    not depend on the number of seats.  ``most`` caps the seats of an entry.
    """
    votes = np.asarray(votes, dtype=float)
    most = np.full(len(votes), np.inf) if most is None else np.asarray(most, dtype=float)
    seats = int(min(seats, most[votes > 0].sum()))
    if seats <= 0 or not (votes > 0).any():
        return np.zeros(len(votes), dtype=np.int64)

    def dealt(divisor: float) -> np.ndarray:
        return np.minimum(np.floor(votes / divisor + 0.5), most)

    low, high = 0.0, 2.0 * votes.max() + 1.0  # at high no one has a seat
    for _ in range(200):
        middle = (low + high) / 2
        if middle in (low, high):
            break
        if dealt(middle).sum() > seats:
            low = middle
        else:
            high = middle
    out = dealt(high)
    heap = [(-v / (2 * k + 1), i) for i, (v, k) in enumerate(zip(votes, out)) if v > 0 and k < most[i]]
    heapq.heapify(heap)
    for _ in range(seats - int(out.sum())):
        _, i = heapq.heappop(heap)
        out[i] += 1
        if out[i] < most[i]:
            heapq.heappush(heap, (-votes[i] / (2 * out[i] + 1), i))
    return out.astype(np.int64)


def deal_words(words: np.ndarray, take: int, block: int) -> np.ndarray:
    """Words that each shard gives of ``take``: whole blocks by highest quotients, at most ``MAX_REPEATS`` times its own.

    What rounding and full shards leave over goes to the first shards with room.
    """
    most = MAX_REPEATS * words
    got = np.minimum(sainte_lague(words.astype(float), take // block, np.ceil(most / block)) * block, most)
    room = most - got
    before = np.cumsum(room) - room
    return got + np.clip(min(take, int(most.sum())) - got.sum() - before, 0, room)


def mix_sources(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: dict[str | None, float] | None = None,
    share: float = 1.0,
    block_words: int = 64,
    shard_docs: int = 500,
    seed: int = 17,
    with_ranges: bool = False,
) -> DataFrame:
    """Decide how many words of every document the mix takes.

    Returns one row per input row: the id, ``size``, ``source_size``, ``target``
    and ``taken``.  Sources are ordered by code point, null last, and weigh 5,
    2, 1, repeating, unless ``weights`` names them.  The targets share
    ``share`` of all words; no target exceeds 3 times its source's words and
    no document is taken more than 3 times.

    Null or blank texts have size 0 and nothing is taken from them.  Repeated
    rows are separate documents.  Empty tables give an empty result.  Other
    columns are ignored, so their names cannot clash.  A source of n documents
    falls into ``n / shard_docs`` shards.  ``with_ranges`` adds ``whole``, the
    whole copies taken, ``ranges``, the words taken besides them as (lo, hi) in
    ascending order, and ``text_id``, the text's hash.

    Texts of any length count whole.  The per-source totals meet on the driver:
    one row for each source of the mixing recipe.  Rows that are repeated more
    often than ``REPEATS`` are dealt to several shards.
    """
    spark = docs.sparkSession
    narrow = settled(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            word_count(F.col(text_col)).alias("size"),
            F.xxhash64(F.col(text_col)).alias("text_id"),
            F.monotonically_increasing_id().alias("_row"),  # settled, so that every reader of a row sees the same number
        )
    )
    sources = settled(narrow.groupBy(F.col("source").alias("_source")).agg(F.ceil(F.count("*") / shard_docs).alias("_shards")))
    if sources.count() <= BROADCAST_HASHES:
        sources = F.broadcast(sources)
    keyed = narrow.join(sources, F.col("source").eqNullSafe(F.col("_source"))).drop("_source").withColumns(
        {
            "_null": F.col("source").isNull(),
            "_key": F.coalesce("source", F.lit("")),
            "_order": F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("source"), F.col("size")),
        }
    )
    often = settled(keyed.groupBy(F.col("_order").alias("_often")).agg(F.ceil(F.count("*") / REPEATS).alias("_parts")).where("_parts > 1"))
    if often.count() <= BROADCAST_HASHES:
        often = F.broadcast(often)
    salt = F.pmod(F.col("_row"), F.coalesce("_parts", F.lit(1)))
    keyed = keyed.join(often, F.col("_order") == F.col("_often"), "left").withColumn("_salt", salt)
    keyed = keyed.withColumn("_shard", F.pmod(F.xxhash64(F.lit(seed + 1), "_order", "_salt"), F.col("_shards")).cast("int")).drop("_often", "_parts", "_salt", "_row")

    shard_sizes = keyed.groupBy("_null", "_key", "_shard").agg(F.sum("size").alias("shard_words"))
    totals = shard_sizes.groupBy("_null", "_key").agg(F.sum("shard_words").alias("words")).toPandas()
    totals = totals.iloc[sorted(range(len(totals)), key=lambda i: (totals["_null"][i], totals["_key"][i].encode("utf-32-be")))].reset_index(drop=True)
    named = [None if null else key for null, key in zip(totals["_null"], totals["_key"])]
    weight = np.array([WEIGHT_CYCLE[i % 3] if weights is None else weights.get(s, 0.0) for i, s in enumerate(named)], dtype=float)
    words = totals["words"].to_numpy(dtype=float)
    target = water_fill(np.where(weight > 0, MAX_REPEATS * words, 0.0), weight, share * words.sum())
    # Blocks must be small against the targets, or rounding alone would move them.
    smallest = target[target > 0].min() if (target > 0).any() else 1.0
    block = int(max(1, min(block_words, smallest // 200 or 1)))
    totals["target"] = target
    blocks = sainte_lague(target, round(target.sum() / block), np.ceil(MAX_REPEATS * words / block))
    totals["take"] = np.minimum(blocks * block, MAX_REPEATS * words).astype(np.int64)
    quotas = spark.createDataFrame(
        totals.rename(columns={"words": "source_words"})[["_null", "_key", "source_words", "target", "take"]],
        "_null boolean, _key string, source_words long, target double, take long",
    )

    def dealt(parts: DataFrame, quotas: DataFrame, keys: list[str], part: str) -> DataFrame:
        """Deal the words of each quota on to its parts: (keys, part, shard_words, source_words, target, take)."""
        columns = [*keys, part, "shard_words", "source_words", "target", "take"]

        def deal(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(part)
            pdf["take"] = deal_words(pdf["shard_words"].to_numpy(dtype=np.int64), int(pdf["take"].iloc[0]), block)
            return pdf[columns]

        kinds = {"_null": "boolean", "_key": "string", "target": "double", "_group": "int", "_shard": "int"}
        joined = parts.join(quotas.drop("shard_words"), keys)
        return joined.groupBy(*keys).applyInPandas(deal, ", ".join(f"{c} {kinds.get(c, 'long')}" for c in columns))

    grouped = shard_sizes.withColumn("_group", F.expr(f"cast(_shard div {GROUP_SHARDS} as int)"))
    groups = grouped.groupBy("_null", "_key", "_group").agg(F.sum("shard_words").alias("shard_words"))
    quotas = dealt(groups, quotas, ["_null", "_key"], "_group")
    quotas = dealt(grouped, quotas, ["_null", "_key", "_group"], "_shard").drop("_group")

    w = Window.partitionBy("_null", "_key", "_shard").orderBy("_order", "doc_id", "text_id")
    laid = keyed.withColumn("_end", F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    placed = laid.join(quotas, ["_null", "_key", "_shard"]).withColumns(
        {"whole": F.expr("take div greatest(shard_words, 1L)"), "ranges": F.expr(_ranges_sql(block, seed))}
    )
    return placed.select(
        "doc_id",
        "size",
        F.col("source_words").alias("source_size"),
        "target",
        F.expr("size * whole + aggregate(ranges, 0L, (n, r) -> n + r.hi - r.lo)").alias("taken"),
        "source",
        *["whole", "ranges", "text_id"] * with_ranges,
    )


def _ranges_sql(block: int, seed: int) -> str:
    """Words taken, besides whole passes, of the document that lies at [_end - size, _end) in its shard.

    ``take`` words leave the shard: whole passes first, then whole blocks from a
    seeded first block onwards, round the end, then part of one more block (of
    the words behind the last block, if they suffice).  The documents themselves
    lie in seeded order, so neighbouring blocks are a random choice of documents
    and most documents stay whole.
    """
    full = f"(shard_words div {block})"
    rest = "(take % greatest(shard_words, 1L))"
    part = f"({rest} % {block})"
    behind = f"(shard_words % {block} >= {part})"
    limit = f"({full} * {block})"
    start = f"(pmod(xxhash64({seed}, _key, _shard), greatest({full}, 1L)) * {block})"
    stop = f"({start} + {rest} div {block} * {block} + IF({behind}, 0L, {part}))"
    chosen = f"array(struct(0L AS lo, {stop} - {limit} AS hi), struct({start} AS lo, least({stop}, {limit}) AS hi), struct({limit} AS lo, {limit} + IF({behind}, {part}, 0L) AS hi))"
    mine = f"transform({chosen}, r -> struct(greatest(r.lo - _end + size, 0L) AS lo, least(r.hi - _end + size, size) AS hi))"
    return f"filter({mine}, r -> r.hi > r.lo)"


def take_mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of the mix: whole copies of a document, then the rest of its words.

    A document of which the mix takes 2.5 times its words comes back twice
    whole and once with those of its words that lie in the chosen blocks, as
    one row for each connected range; one of which it takes none is gone.  Of
    rows that share an id each comes back as often as the mix takes it.  Null
    and blank texts have no words, so they are gone too; a null id or source
    is like any other; an empty table stays empty; texts of any length are cut
    at their words; other columns come along whatever their names.
    """
    mix = mix_sources(docs, id_col=id_col, text_col=text_col, source_col=source_col, with_ranges=True, **options)
    mix_id, mix_source, mix_text, mix_copy, copy, whole, ranges = unused(docs.columns, "_mix_id", "_mix_source", "_mix_text", "_mix_copy", "_copy", "_whole", "_ranges")
    taken = mix.select("taken", F.col("doc_id").alias(mix_id), F.col("source").alias(mix_source), F.col("text_id").alias(mix_text), F.col("whole").alias(whole), F.col("ranges").alias(ranges))
    left, same = docs, F.col(id_col).eqNullSafe(F.col(mix_id))
    if not docs.groupBy(id_col).count().where("count > 1").isEmpty():
        # Rows of one id, source and text are numbered on both sides.
        keys = [F.col(id_col), F.col(source_col).cast("string"), F.xxhash64(text_col)]
        left = docs.withColumn(copy, F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0))))
        taken = taken.withColumn(mix_copy, F.row_number().over(Window.partitionBy(mix_id, mix_source, mix_text).orderBy("taken")))
        for key, other in zip([*keys[1:], F.col(copy)], (mix_source, mix_text, mix_copy)):
            same &= key.eqNullSafe(F.col(other))
    names = docs.columns
    joined = left.join(taken.where("taken > 0").drop("taken").hint("shuffle_hash"), same).select(*[left[f"`{c}`"] for c in names], whole, ranges)
    text_at, n = names.index(text_col), len(names)

    def repeat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = np.arange(batch.num_rows)
            rows = pa.RecordBatch.from_arrays(batch.columns[:n], names)
            yield rows.take(pa.array(np.repeat(each, batch.column(n).to_numpy())))
            found = batch.column(n + 1)
            who = np.repeat(each, found.value_lengths().to_numpy())
            lo, hi = (found.flatten().field(k).to_numpy() for k in range(2))
            if len(who):
                # Ranges that touch are one.
                opens = np.append(True, (who[1:] != who[:-1]) | (lo[1:] != hi[:-1]))
                who, lo, hi = who[opens], lo[opens], hi[np.append(opens[1:], True)]
                rows = rows.take(pa.array(who))
                data, offsets = tk.packed(rows.column(text_at))
                starts, ends, owner = tk.words(data, offsets)
                first = np.searchsorted(owner, np.arange(len(who)))
                size = np.diff(first, append=len(owner))
                begin = np.where(lo == 0, offsets[:-1], starts[first + lo])
                stop = np.where(hi == size, offsets[1:], ends[first + hi - 1])
                cut = [data[a:b].tobytes().decode() for a, b in zip(begin, stop)]
                yield rows.set_column(text_at, rows.schema.field(text_at), pa.array(cut, pa.string()))

    return joined.mapInArrow(repeat, docs.schema)
