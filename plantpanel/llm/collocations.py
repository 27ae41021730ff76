"""Phrase mining with an FM-index of every shard of the corpus.

A shard is a stretch of the word ids of one language, with its depth-limited
Burrows-Wheeler transform.  A phrase is an interval of the sorted suffixes.  In
round k every shard extends the intervals of all frequent phrases of k words at
once, by one word to both sides: the rows of ``word + phrase`` follow from the
transform, and a row belongs to the extension if its first k words and its last
k words are frequent.  Counts are summed across shards, extensions that are
frequent in sum get an id, and their intervals go back to their shards.  What
shards and sums exchange are packed arrays, a few bytes for each extension.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textkit as tk
from .common import settled

#: Words and separators of a shard at most, and words for which there is one part of the sums; neither changes results.
SHARD, PART_WORDS = 1 << 19, 1 << 20
#: Salts that the candidates of a language are ranked in first.
SALTS = 64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAK = np.zeros(256, dtype=bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_IN_WORD = ~_BREAK
_IN_WORD[[0x20, 0x09]] = False
_PART = 1 << 20


def _parts(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, bool]]:
    """Chunks of whole texts, and of long texts cut behind a byte outside words: first text, bytes, offsets, whether it goes on one."""
    for first, _, part, at in tk.chunks(data, offsets, _PART):
        lo = 0
        while len(part) - lo > 2 * _PART and len(at) == 2:
            gaps = np.flatnonzero(~_IN_WORD[part[lo + _PART : lo + 2 * _PART]])
            hi = lo + _PART + int(gaps[0]) + 1 if len(gaps) else lo + 2 * _PART
            while not len(gaps) and hi < len(part) and _IN_WORD[part[hi - 1]]:
                hi += 1  # a word longer than a chunk stays whole
            yield first, part[lo:hi], np.array([0, hi - lo]), lo > 0
            lo = hi
        yield first, part[lo:], np.maximum(at - lo, 0), lo > 0


class _Shard:
    """Word ids of one language in a task, 0 where a piece ends; ids are numbers of words by first appearance, from 1."""

    def __init__(self):
        self.ids: list[np.ndarray] = []
        self.size, self.words = 0, {}

    def add(self, ids: np.ndarray) -> None:
        self.ids.append(ids)
        self.size += len(ids)


def _suffixes(ids: np.ndarray, depth: int) -> np.ndarray:
    """Positions ordered by their next ``depth`` ids; the end counts as separators."""
    bits = max(1, int(ids.max()).bit_length())
    rank, known, size = ids.astype(np.uint64), 1, bits
    while True:
        key, taken, used = rank.copy(), known, size
        while taken < depth and used + bits <= 64:
            key <<= np.uint64(bits)
            key[: len(ids) - taken] |= ids[taken:].astype(np.uint64)
            taken, used = taken + 1, used + bits
        order = np.argsort(key, kind="stable")
        if taken >= depth:
            return order
        by = key[order]
        rank = np.empty(len(ids), np.uint64)
        rank[order] = np.cumsum(np.concatenate([[0], by[1:] != by[:-1]])).astype(np.uint64)
        known, size = taken, max(1, int(rank.max()).bit_length())


def transform(ids: np.ndarray, n_own: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The transform of a shard, and the rows of its last positions that belong to the next shard."""
    order = _suffixes(ids, depth)
    return ids[order - 1], np.flatnonzero(order >= n_own)


def extended(bwt: np.ndarray, outside: np.ndarray, lo: np.ndarray, hi: np.ndarray, gid: np.ndarray) -> tuple[np.ndarray, ...]:
    """All extensions by one word of the phrases with these intervals: lo, hi, count, prefix and suffix.

    Row j starts with word c and goes on as row ``after[j]``; both follow from
    the transform, as rows that start with c stand in the order of the rows
    before which c stands.  So j lies in the interval of a phrase that is one
    word longer, whose prefix is the phrase of row j and whose suffix is that
    of row ``after[j]``.
    """
    after = np.argsort(bwt, kind="stable")
    of = np.full(len(bwt), -1, np.int64)
    size = hi - lo
    of[np.repeat(lo - np.cumsum(size) + size, size) + np.arange(int(size.sum()))] = np.repeat(gid, size)
    suffix = of[after]
    row = np.flatnonzero((of >= 0) & (suffix >= 0))
    if not len(row):
        return (np.zeros(0, np.int64),) * 5
    pre, suf = of[row], suffix[row]
    new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1] + 1) | (pre[1:] != pre[:-1]) | (suf[1:] != suf[:-1])]))
    start, end = row[new], row[np.append(new[1:] - 1, len(row) - 1)] + 1
    foreign = np.searchsorted(outside, end) - np.searchsorted(outside, start)
    return start, end, end - start - foreign, pre[new], suf[new]


def build_shards(docs: DataFrame, depth: int = 5, *, text_col: str = "text", lang_col: str = "lang", shard_size: int = SHARD) -> DataFrame:
    """(shard, lang, n, bwt, width, outside, words, starts, sizes, counts) of the texts of each task and language.

    ``n`` counts words; ``words`` are the distinct ones, with where the interval
    of each starts, its rows, and those that count.  A shard that ends inside a piece
    repeats the next ``depth`` - 1 words; ``outside`` are the rows of these.
    """
    slim = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    schema = pa.schema([("shard", pa.int64()), ("lang", pa.string()), ("n", pa.int64()), ("bwt", pa.binary()), ("width", pa.int32()), ("outside", pa.list_(pa.int64())), ("words", pa.list_(pa.string())), *((c, pa.list_(pa.int64())) for c in ("starts", "sizes", "counts"))])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards: dict[str, _Shard] = {}
        made = TaskContext.get().partitionId() << 32

        def closed(lang: str, everything: bool) -> Iterator[pa.RecordBatch]:
            nonlocal made
            now = shards[lang]
            ids = np.concatenate(now.ids)
            while len(ids) >= shard_size + depth or (everything and len(ids)):
                own = ids[:shard_size]
                next_words = ids[shard_size : shard_size + depth - 1]
                stop = np.flatnonzero(next_words == 0)
                taken = np.concatenate([own, next_words[: stop[0]] if len(stop) else next_words, np.zeros(depth, ids.dtype)])
                # Ids of this shard alone, dense, so that they stay narrow.
                known, dense = np.unique(taken, return_inverse=True)
                kind = np.uint16 if len(known) < 1 << 16 else np.uint32
                bwt, outside = transform(dense.astype(np.int64), len(own), depth)
                sizes, counts = np.bincount(dense), np.bincount(dense[: len(own)], minlength=len(known))
                starts = np.cumsum(sizes) - sizes
                names = list(now.words)
                row = [made, lang, int(np.count_nonzero(own)), _planes(bwt, kind), np.dtype(kind).itemsize, outside]
                row += [[names[i - 1].decode() for i in known[1:]], starts[1:], sizes[1:], counts[1:]]
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)
                made, ids = made + 1, ids[shard_size:]
            shards[lang] = _Shard()
            if len(ids):  # what is left keeps its words
                known, dense = np.unique(ids, return_inverse=True)
                names, zero = list(now.words), int(known[0] == 0)
                shards[lang].words = {names[i - 1]: k + 1 for k, i in enumerate(known[zero:])}
                shards[lang].add((dense + 1 - zero).astype(np.int32))

        for batch in batches:
            langs = batch.column(0).to_pylist()
            data, offsets = tk.packed(batch.column(1))
            for first, part, at, goes_on in _parts(data, offsets):
                low = _LOWER[part]
                starts, ends = tk.runs(_IN_WORD[low], at)
                if not len(starts):
                    if goes_on and _BREAK[low].any():
                        shards.setdefault(langs[first], _Shard()).add(np.zeros(1, np.int32))
                    continue
                owner = tk.owner(at, starts)
                hashes = tk.Hasher(low).spans(starts, ends)
                _, one, word = np.unique(hashes, return_index=True, return_inverse=True)
                raw = low.tobytes()
                names = [raw[starts[i] : ends[i]] for i in one]
                if not _alike(low, starts, ends, starts[one][word], ends[one][word]):  # two words share a hash
                    every = [raw[a:b] for a, b in zip(starts, ends)]
                    names = list(dict.fromkeys(every))
                    number = {w: i for i, w in enumerate(names)}
                    word = np.array([number[w] for w in every])
                breaks = np.concatenate([[0], np.cumsum(_BREAK[low])])
                cut = np.concatenate([[not goes_on or breaks[starts[0]] > 0], (breaks[starts[1:]] != breaks[ends[:-1]]) | (owner[1:] != owner[:-1])])
                run = np.concatenate([[0], np.flatnonzero(owner[1:] != owner[:-1]) + 1, [len(owner)]])
                of_lang: dict[str, list] = {}
                for a, b in zip(run[:-1], run[1:]):
                    of_lang.setdefault(langs[first + owner[a]], []).append(np.arange(a, b))
                for lang, spans in of_lang.items():
                    now, at_word = shards.setdefault(lang, _Shard()), np.concatenate(spans)
                    used, inverse = np.unique(word[at_word], return_inverse=True)
                    local = np.array([now.words.setdefault(names[i], len(now.words) + 1) for i in used], dtype=np.int64)[inverse]
                    separate = cut[at_word].astype(np.int64)
                    place = np.cumsum(separate + 1) - 1
                    ids = np.zeros(int(place[-1]) + 1, np.int32)
                    ids[place] = local
                    now.add(ids)
                    if now.size >= shard_size + depth:
                        yield from closed(lang, False)
                if low[-1:].size and len(at) == 2 and _BREAK[low[ends[-1] :]].any():
                    shards[langs[first]].add(np.zeros(1, np.int32))
        for lang in list(shards):
            if shards[lang].size:
                yield from closed(lang, True)
        pa.default_memory_pool().release_unused()

    return slim.mapInArrow(build, "shard long, lang string, n long, bwt binary, width int, outside array<long>, words array<string>, starts array<long>, sizes array<long>, counts array<long>")


def _alike(data: np.ndarray, a: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_end: np.ndarray) -> bool:
    """Whether spans that should be equal have equal bytes."""
    size = a_end - a
    if (size != b_end - b).any():
        return False
    inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    return bool((data[np.repeat(a, size) + inside] == data[np.repeat(b, size) + inside]).all())


def _intervals(shards: DataFrame) -> DataFrame:
    """(shard, lang, phrase, lo, hi, n): every word of every shard."""
    words = F.explode(F.arrays_zip("words", "starts", "sizes", "counts")).alias("w")
    return shards.select("shard", "lang", words).select("shard", "lang", F.col("w.words").alias("phrase"), F.col("w.starts").alias("lo"), F.expr("w.starts + w.sizes").alias("hi"), F.col("w.counts").alias("n"))


def _released(out: pa.Table) -> pa.Table:
    """The table, after Arrow has given back what it keeps for later: idle workers stay beside the running ones."""
    pa.default_memory_pool().release_unused()
    return out


def _planes(values: np.ndarray, kind: type) -> bytes:
    """Numbers byte by byte, all first bytes first: small numbers leave long runs of zeros, which every codec shrinks."""
    return np.ascontiguousarray(values.astype(kind)).view(np.uint8).reshape(len(values), -1).T.tobytes()


def _numbers(data: bytes, kind: type, n: int) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(-1, n).T.copy().view(kind).ravel()


def _packed(lo: np.ndarray, hi: np.ndarray, *more: np.ndarray) -> bytes:
    """Intervals in their order, and further numbers of each."""
    return b"".join([_planes(np.diff(lo, prepend=0), np.uint32), _planes(hi - lo, np.uint32), *(_planes(x, np.int64) for x in more)])


def _unpacked(data: bytes, n: int) -> list[np.ndarray]:
    lo = np.cumsum(_numbers(data[: 4 * n], np.uint32, n).astype(np.int64))
    hi = lo + _numbers(data[4 * n : 8 * n], np.uint32, n)
    return [lo, hi, *(_numbers(data[k : k + 8 * n], np.int64, n) for k in range(8 * n, len(data), 8 * n))]


def _gathered(rows: pa.Table) -> list[np.ndarray]:
    """The numbers of all packed rows, one after the other."""
    parts = [_unpacked(d, n) for d, n in zip(rows["data"].to_pylist(), rows["m"].to_pylist())]
    return [np.concatenate(x) for x in zip(*parts)]


def _pack_words(words: DataFrame) -> DataFrame:
    """(shard, m, data): the intervals (lo, hi, gid) of the frequent words of every shard."""
    schema = pa.schema([("shard", pa.int64()), ("m", pa.int64()), ("data", pa.binary())])

    def pack(rows: pa.Table) -> pa.Table:
        lo, hi, gid = (rows[c].to_numpy() for c in ("lo", "hi", "gid"))
        by = np.argsort(lo)
        return pa.Table.from_arrays([rows["shard"][:1].combine_chunks(), pa.array([len(lo)], pa.int64()), pa.array([_packed(lo[by], hi[by], gid[by])])], schema=schema)

    return words.select("shard", "lo", "hi", "gid").groupBy("shard").applyInArrow(pack, "shard long, m long, data binary")


def _extend(shards: DataFrame, frontier: DataFrame, parts: int) -> DataFrame:
    """(part, shard, m, data): the extensions (lo, hi, count, prefix, suffix) of a frontier, dealt to parts by prefix and suffix."""
    schema = pa.schema([("part", pa.int32()), ("shard", pa.int64()), ("m", pa.int64()), ("data", pa.binary())])

    def extend(shard: pa.Table, phrases: pa.Table) -> pa.Table:
        if not shard.num_rows or not phrases.num_rows:
            return schema.empty_table()
        row = shard.to_pylist()[0]
        lo, hi, gid = _gathered(phrases)
        bwt = _numbers(row["bwt"], np.uint16 if row["width"] == 2 else np.uint32, len(row["bwt"]) // row["width"])
        found = extended(bwt, np.array(row["outside"], dtype=np.int64), lo, hi, gid)
        part = (tk.mix(found[3].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + found[4].astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")  # inside a part the intervals stay in their order
        ends = np.cumsum(np.bincount(part, minlength=parts))
        out = []
        for k in np.flatnonzero(np.diff(ends, prepend=0)):
            own = order[ends[k - 1] if k else 0 : ends[k]]
            out.append((int(k), row["shard"], len(own), _packed(*(x[own] for x in found))))
        return _released(pa.Table.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), schema)], schema=schema) if out else schema.empty_table())

    left = shards.select("shard", "bwt", "width", "outside").groupBy("shard")
    return left.cogroup(frontier.withColumnRenamed("shard", "of").groupBy("of")).applyInArrow(extend, "part int, shard long, m long, data binary")


def _summed(extensions: DataFrame, least: int, parts: int) -> DataFrame:
    """The frequent extensions: a row (gid, pre, suf, a: arrays) for each part, and rows (shard, m, data) with their intervals (lo, hi, gid)."""
    longs = pa.list_(pa.int64())
    schema = pa.schema([("shard", pa.int64()), ("m", pa.int64()), ("data", pa.binary()), *((c, longs) for c in ("gid", "pre", "suf", "a"))])

    def add_up(rows: pa.Table) -> pa.Table:
        part, sizes, shards = rows["part"][0].as_py(), np.array(rows["m"].to_pylist()), rows["shard"].to_pylist()
        lo, hi, n, pre, suf = _gathered(rows)
        order = np.lexsort((suf, pre))
        new = np.concatenate([[True], (pre[order][1:] != pre[order][:-1]) | (suf[order][1:] != suf[order][:-1])])
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(new) - 1
        total = np.bincount(group, weights=n).astype(np.int64) if n.sum() < 1 << 53 else np.add.reduceat(n[order], np.flatnonzero(new))
        often = total >= least
        number = (np.cumsum(often) - 1) * parts + part  # unique, as parts share no remainder
        first = order[np.flatnonzero(new)][often]
        out = [(None, None, None, number[often], pre[first], suf[first], total[often])] if often.any() else []
        ends = np.cumsum(sizes)
        for k, shard in enumerate(shards):
            own = np.arange(ends[k] - sizes[k], ends[k])
            own = own[often[group[own]]]
            if len(own):
                out.append((shard, len(own), _packed(lo[own], hi[own], number[group[own]]), None, None, None, None))
        return _released(pa.Table.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), schema)], schema=schema) if out else schema.empty_table())

    return extensions.groupBy("part").applyInArrow(add_up, "shard long, m long, data binary, gid array<long>, pre array<long>, suf array<long>, a array<long>")


def _frequent(shards: DataFrame, depth: int, least: int) -> list[DataFrame]:
    """The frequent phrases of each length: lang, gid, pre, suf, phrase, last, a, starts, ends.

    ``starts`` and ``ends`` are the counts of the phrase's beginnings and
    endings by their number of words, the phrase itself last.
    """
    spark = shards.sparkSession
    n = shards.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n // PART_WORDS + 1)
    words = _intervals(shards)
    # A word's gid is the least of its rows' numbers: its intervals get it, and its count, where they meet, without a join.
    alike = Window.partitionBy("lang", "phrase")
    numbered = words.withColumn("gid", F.monotonically_increasing_id())
    common = settled(numbered.withColumns({"a": F.sum("n").over(alike), "gid": F.min("gid").over(alike)}).where(F.col("a") >= least))
    nobody = F.lit(None).cast("long")
    counted = common.select("lang", "gid", "phrase", "a").distinct()
    found = [settled(counted.select("lang", "gid", nobody.alias("pre"), nobody.alias("suf"), "phrase", F.col("phrase").alias("last"), "a", F.array("a").alias("starts"), F.array("a").alias("ends")))]
    frontier = _pack_words(common)
    for _ in range(depth - 1):
        longer = settled(_summed(_extend(shards, frontier, parts), least, parts))
        counted = longer.where("shard IS NULL").select(F.explode(F.arrays_zip("gid", "pre", "suf", "a")).alias("c")).select("c.*")
        begin = found[-1].select("lang", F.col("gid").alias("pre"), "phrase", "starts")
        end = found[-1].select(F.col("gid").alias("suf"), "last", "ends")
        named = counted.join(begin, "pre").join(end, "suf")
        found.append(settled(named.select("lang", "gid", "pre", "suf", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last", "a", F.concat("starts", F.array("a")).alias("starts"), F.concat("ends", F.array("a")).alias("ends"))))
        if found[-1].isEmpty():
            break
        frontier = longer.where("shard IS NOT NULL").select("shard", "m", "data")
    return found


def _outermost(found: list[DataFrame]) -> DataFrame:
    """Phrases of two words or more without a one-word extension, to either side, that occurs as often.

    A longer phrase is never more frequent than one inside it, and any phrase
    between the two is as frequent as either if these are equal, so extensions
    by one word suffice.
    """
    kept = []
    for k, phrases in enumerate(found[1:], start=1):
        if k + 1 < len(found):
            for side in ("pre", "suf"):
                most = found[k + 1].groupBy(F.col(side).alias("gid")).agg(F.max("a").alias("_most"))
                phrases = phrases.join(most, "gid", "left").where("_most IS NULL OR _most < a").drop("_most")
        kept.append(phrases.select("lang", "phrase", "a", "starts", "ends"))
    out = kept[0]
    for p in kept[1:]:
        out = out.unionByName(p)
    return out


def collocations(docs: DataFrame, *, least: int = 100, depth: int = 5, limit: int = 2000, text_col: str = "text", lang_col: str = "lang", shard_size: int = SHARD) -> DataFrame:
    """The strongest phrases of every language: lang, rank, phrase, a, l, r, n, score.

    Texts (A-Z in lower case) are cut at ``.,;:!?`` and line ends into pieces,
    and at blanks and tabs into words.  A candidate is a phrase of 2 to
    ``depth`` words that occurs ``least`` times or more (a); its weakest cut
    into l and r gives floor(1000 a n / (l r)), where n counts the words of the
    language.  Candidates inside a longer one that occurs as often are left
    out.  The first ``limit`` of a language by score, a, phrase are returned.

    Null texts are empty, a null language is ``und``; repeated rows count
    each; other columns are ignored; an empty table gives no rows.  Texts are
    read whole: a long one is cut behind a word, and a shard that ends inside a
    piece repeats the few words after it without counting them.
    """
    spark = docs.sparkSession
    name = f"shards_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Bucketed by shard, so that every round joins its intervals without moving the transforms.
    build_shards(docs, depth, text_col=text_col, lang_col=lang_col, shard_size=shard_size).repartition(n, "shard").write.bucketBy(n, "shard").saveAsTable(name)
    try:
        shards = spark.table(name)
        found = _frequent(shards, depth, least)
        if len(found) < 2:
            found.append(found[0].limit(0))
        total = shards.groupBy("lang").agg(F.sum("n").alias("n"))
        cut = """array_min(transform(sequence(1, size(starts) - 1), k -> struct(
            (1000 * cast(a AS decimal(20, 0)) * cast(n AS decimal(20, 0))) div (cast(starts[k - 1] AS decimal(19, 0)) * cast(ends[size(ends) - k - 1] AS decimal(19, 0))) AS score,
            k AS k, starts[k - 1] AS l, ends[size(ends) - k - 1] AS r)))"""
        scored = _outermost(found).join(total, "lang").withColumn("c", F.expr(cut)).select("lang", "phrase", "a", "c.l", "c.r", "n", "c.score")
        order = [F.desc("score"), F.desc("a"), "phrase"]
        # Each of many parts of a language keeps its first rows; few are left to rank together.
        part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
        first = scored.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= limit)
        ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= limit)
        return settled(ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
