"""Near-duplicate join on word shingles by chosen paths.

Documents with equal shingle sets form one class; classes are joined when
their sets' Jaccard similarity reaches the threshold.

* Candidates: in each of several runs a set walks down a random tree.  At a
  node it follows each of its tokens with probability 1 / (threshold * size),
  decided by a hash of node and token, so similar sets follow common tokens
  and meet.  Nodes with few sets are compared at once on small sketches; nodes
  with many are split further, and what the last level leaves together counts
  as candidates unseen (this costs comparisons, never a link).
* Who walks on: a partner at the threshold lacks at most (1 - threshold) of a
  set's tokens.  So a set of whose m first steps s ended in small nodes meets
  it there with probability 1 - exp(-(s - (1 - threshold) * m)) at least; only
  sets for which this misses the target recall walk below their large nodes.
* Links: candidates form clusters, and inside a cluster *all* pairs are
  compared exactly, tile by tile.  So the walk need only connect a cluster
  somewhere, no partner is capped, and large groups spread over many tasks
  that each return counts and a spanning forest instead of pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .common import settled, shuffled, unused
from .graph import components

SHINGLE_WORDS = 5
THRESHOLD = 0.8
#: Chance that a pair at the threshold meets in at least one run.
TARGET_RECALL = 0.9999
#: Chance that it meets in one run of three levels at worst: one set holds the other, which
#: leaves one common step on average at each level (0.632, 0.469, 0.374 after one, two, three).
RUN_RECALL = 0.37
LEVELS = 3
#: Sets that a node may hold to be compared at once.
SMALL_NODE = 128
#: Entries of small nodes compared in one call, on average.
BUCKET_ROWS = 20_000
#: How far below the threshold a sketch estimate may fall (four standard errors).
SKETCH_MARGIN = 0.17
#: Sets, and tokens in all, on one side of a tile (a larger set is a side by itself).
TILE = 2048
TILE_TOKENS = 1 << 22
#: Texts to gather are broadcast by hash up to this many (8 bytes each); beyond it they are joined by shuffling.
BROADCAST_CLASSES = 2_000_000
_TOKEN_BITS = 52
_K = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each packed text as 52-bit tokens: (text, token), sorted.

    A text with fewer words has its whole word sequence as one shingle; one
    without words has none.  At most 4095 texts at a time.
    """
    starts, ends, docs = tk.words(data, offsets)
    h = tk.Hasher(data).spans(starts, ends)
    n = len(h)
    code, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if n >= size:
        code = np.zeros(n - size + 1, dtype=np.uint64)
        for k in range(size):
            code = code * _K + h[k : n - size + 1 + k]
        inside = docs[size - 1 :] == docs[: n - size + 1]
        code, owner = tk.mix(code[inside]), docs[: n - size + 1][inside]
    n_words = tk.per_text(docs, len(offsets) - 1)
    short = np.flatnonzero((n_words > 0) & (n_words < size))
    if len(short):
        first = np.searchsorted(docs, short)
        whole = np.zeros(len(short), dtype=np.uint64)
        for k in range(size - 1):
            some = n_words[short] > k
            whole[some] = whole[some] * _K + h[first[some] + k]
        code = np.concatenate([code, tk.mix(whole + n_words[short].astype(np.uint64))])
        owner = np.concatenate([owner, short])
    key = np.unique((owner.astype(np.uint64) << np.uint64(_TOKEN_BITS)) | (code >> np.uint64(64 - _TOKEN_BITS)))
    return (key >> np.uint64(_TOKEN_BITS)).astype(np.int64), key & np.uint64((1 << _TOKEN_BITS) - 1)


def _sets(batch_ids: pa.Array, column: pa.Array, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Chunk by chunk: first, last + 1, text of each token, tokens, set key of each text (0: no set)."""
    data, offsets = tk.packed(column)
    for i, j, part, at in tk.chunks(data, offsets):
        for a in range(0, j - i, 4095):
            b = min(a + 4095, j - i)
            docs, tokens = shingle_sets(part[at[a] : at[b]], at[a : b + 1] - at[a], size)
            n = b - a
            counts = tk.per_text(docs, n)
            some = counts > 0
            key = np.zeros(n, dtype=np.uint64)
            key[some] = tk.mix(np.add.reduceat(tk.mix(tokens + _K), (np.cumsum(counts) - counts)[some])) if some.any() else 0
            key[some & (key == 0)] = 1
            yield i + a, i + b, docs, tokens, key


def limits(counts: np.ndarray, threshold: float) -> np.ndarray:
    """The hash below which a set of so many tokens follows a token."""
    return np.minimum(2.0**64 / (threshold * np.maximum(counts, 1)), 2.0**64 - 2048).astype(np.uint64)


def first_steps(docs: np.ndarray, tokens: np.ndarray, n: int, runs: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(text, node) of the first steps of each set in all runs, by text."""
    # One hash serves two runs: its halves are drawn apart.
    limit = np.repeat(limits(tk.per_text(docs, n), threshold) >> np.uint64(32), tk.per_text(docs, n)).astype(np.uint32)
    owners, nodes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for pair, root in enumerate(tk.mix(np.arange(1, (runs + 1) // 2 + 1, dtype=np.uint64))):
        h = tk.mix(tokens * _K ^ root)
        for half in range(min(2, runs - 2 * pair)):
            taken = np.flatnonzero((h >> np.uint64(32) if half else h).astype(np.uint32) < limit)
            owners.append(docs[taken])
            nodes.append(tk.mix(root + np.uint64(half + 1) + tokens[taken] * _K))
    owner, node = np.concatenate(owners), np.concatenate(nodes)
    order = np.argsort(owner, kind="stable")
    return owner[order], node[order]


def next_steps(docs: np.ndarray, tokens: np.ndarray, n: int, owner: np.ndarray, node: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, parent, node) of the steps that sets take from the nodes where they are."""
    counts = tk.per_text(docs, n)
    begin, limit = np.cumsum(counts) - counts, limits(counts, threshold)
    owners, parents, nodes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for a, b in _slices(counts[owner]):
        size = counts[owner[a:b]]
        at = np.repeat(begin[owner[a:b]] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        up, who = np.repeat(node[a:b], size), np.repeat(owner[a:b], size)
        taken = tk.mix(tokens[at] * _K ^ up) < limit[who]
        owners.append(who[taken])
        parents.append(up[taken])
        nodes.append(tk.mix(up[taken] + tokens[at[taken]] * _K))
    return np.concatenate(owners), np.concatenate(parents), np.concatenate(nodes)


def _slices(sizes: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs of entries of about ``most`` in sum."""
    ends = np.cumsum(sizes)
    a = 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, side="right")))
        yield a, b
        a = b


def sketches(docs: np.ndarray, tokens: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """256 one-permutation bins for each text: which have a token, and one bit of their least token."""
    bins = (tokens >> np.uint64(_TOKEN_BITS - 8)).astype(np.int64)
    first = np.ones(len(tokens), dtype=bool)
    first[1:] = (docs[1:] != docs[:-1]) | (bins[1:] != bins[:-1])
    used, bit = np.zeros((n, 256), dtype=bool), np.zeros((n, 256), dtype=bool)
    used[docs[first], bins[first]] = True
    bit[docs[first], bins[first]] = (tk.mix(tokens[first]) >> np.uint64(63)).astype(bool)
    return np.packbits(used, axis=1), np.packbits(bit, axis=1)


def estimated(used: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """Jaccard estimates of all pairs of a few sketches."""
    u, b = (np.unpackbits(x, axis=1).astype(np.float32) for x in (used, bit))
    s = u * (2 * b - 1)
    both = u @ u.T
    sizes = u.sum(axis=1)
    either = np.maximum(sizes[:, None] + sizes[None, :] - both, 1)
    return (s @ s.T) / either  # agreeing less differing: 2 * agree - both


def compare_small(table: pa.Table, threshold: float) -> pa.Table:
    """Spanning candidates of the small nodes of one bucket, from size ratios and sketches."""
    table = table.sort_by([("node", "ascending"), ("cid", "ascending")])
    node, cid = table["node"].to_numpy(), table["cid"].to_numpy()
    size = table["size"].to_numpy().astype(float)
    used, bit = (np.frombuffer(b"".join(table[c].to_pylist()), np.uint8).reshape(len(cid), -1) for c in ("used", "bit"))
    begin = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
    count = np.diff(begin, append=len(node))
    # Most nodes hold two sets: these are compared all at once.
    x = begin[count == 2]
    y = x + 1
    words_u, words_b = used.view(np.uint64), bit.view(np.uint64)
    both = words_u[x] & words_u[y]
    unlike = np.bitwise_count((words_b[x] ^ words_b[y]) & both).sum(axis=1, dtype=np.int64)
    either = np.bitwise_count(words_u[x] | words_u[y]).sum(axis=1, dtype=np.int64)
    alike = np.bitwise_count(both).sum(axis=1, dtype=np.int64) - 2 * unlike
    near = alike >= (threshold - SKETCH_MARGIN) * either
    near &= np.minimum(size[x], size[y]) >= threshold * np.maximum(size[x], size[y]) - 1e-9
    a, b = [cid[y[near]]], [cid[x[near]]]
    for s, n in zip(begin[count > 2], count[count > 2]):
        part = slice(s, s + n)
        close = estimated(used[part], bit[part]) >= threshold - SKETCH_MARGIN
        z = size[part]
        close &= np.minimum(z[:, None], z[None, :]) >= threshold * np.maximum(z[:, None], z[None, :]) - 1e-9
        roots = spanning(close)
        some = np.flatnonzero(roots != np.arange(n))
        a.append(cid[s + some])
        b.append(cid[s + roots[some]])
    return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)}, schema=_LINKS)


def spanning(near: np.ndarray) -> np.ndarray:
    """The least index that each entry of a symmetric relation is connected to."""
    n = len(near)
    label = np.arange(n)
    near = near.copy()
    near[label, label] = True
    while True:
        least = np.where(near, label[None, :], n).min(axis=1)
        least = least[least]
        if (least == label).all():
            return label
        label = least


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
_TILE_OUT = pa.schema([("cid", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])


def _unpack(block: dict, side: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return tuple(np.frombuffer(block[f"{side}_{c}"], k) for c, k in (("cid", np.int64), ("w", np.int64), ("size", np.int64), ("tokens", np.uint64)))


def common_counts(a_size: np.ndarray, a_tokens: np.ndarray, b_size: np.ndarray, b_tokens: np.ndarray, slab: int = 4096) -> np.ndarray:
    """Sizes of the intersections of the sets of two blocks."""
    shared = np.intersect1d(a_tokens, b_tokens)
    out = np.zeros((len(a_size), len(b_size)), dtype=np.float32)
    if not len(shared):
        return out

    def coordinates(size, tokens):
        row = np.repeat(np.arange(len(size)), size)
        col = np.minimum(np.searchsorted(shared, tokens), len(shared) - 1)
        hit = shared[col] == tokens
        row, col = row[hit], col[hit]
        order = np.argsort(col, kind="stable")
        return row[order], col[order]

    (ar, ac), (br, bc) = coordinates(a_size, a_tokens), coordinates(b_size, b_tokens)
    for lo in range(0, len(shared), slab):
        width = min(slab, len(shared) - lo)
        x, y = np.zeros((len(a_size), width), np.float32), np.zeros((len(b_size), width), np.float32)
        p, q = np.searchsorted(ac, [lo, lo + width])
        x[ar[p:q], ac[p:q] - lo] = 1
        p, q = np.searchsorted(bc, [lo, lo + width])
        y[br[p:q], bc[p:q] - lo] = 1
        out += x @ y.T
    return out


def compare_tile(row: dict, threshold: float) -> pa.RecordBatch:
    """Links between two blocks of one cluster (or inside one): weighted counts and a spanning forest."""
    a_cid, a_w, a_size, a_tokens = _unpack(row, "a")
    b_cid, b_w, b_size, b_tokens = _unpack(row, "b")
    same = row["i"] == row["j"]
    common = common_counts(a_size, a_tokens, b_size, b_tokens).astype(np.float64)
    near = common >= threshold * (a_size[:, None] + b_size[None, :] - common) - 1e-9
    if same:
        np.fill_diagonal(near, False)
        links, cid, square = near @ b_w.astype(np.float64), a_cid, near
    else:
        links = np.concatenate([near @ b_w.astype(np.float64), near.T @ a_w.astype(np.float64)])
        cid = np.concatenate([a_cid, b_cid])
        n, m = near.shape
        square = np.zeros((n + m, n + m), dtype=bool)
        square[:n, n:], square[n:, :n] = near, near.T
    roots = spanning(square)
    some = links > 0
    return pa.RecordBatch.from_arrays([pa.array(cid[some]), pa.array(np.rint(links[some]).astype(np.int64)), pa.array(cid[roots[some]])], schema=_TILE_OUT)


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, shingle_words: int = SHINGLE_WORDS, target_recall: float = TARGET_RECALL, with_keys: bool = False) -> DataFrame:
    """One row per document: its class, near-duplicate group and number of links.

    Returns id, ``class_id`` (smallest id of its near-duplicate group, itself
    if alone), ``copy_id`` (smallest id with the same shingle set) and
    ``n_links``: the different texts, its own left out, whose similarity to it
    reaches the threshold.

    Texts without a word (null and empty ones too) have no set: they are alone,
    without links.  Shorter texts than a shingle count as one shingle.  Repeated
    rows share everything; rows with a null id take part but name no class; an
    empty table gives no rows; other columns are ignored.  ``with_keys`` adds
    ``text_id``, the text's hash, and ``group_id``, which tells groups apart
    that share their smallest id (null without a word).  Texts are read whole,
    however long; one of very many words is one set of as many shingles.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    runs = max(1, math.ceil(math.log(1 - target_recall) / math.log(1 - RUN_RECALL)))
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [key for *_, key in _sets(batch.column(0), batch.column(1), shingle_words)]
            key = np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(key, mask=key == 0), batch.column(2)], ["doc_id", "cid", "copy"])

    # One narrow row for each document; texts are told apart by their hash.
    members = settled(slim.select("doc_id", "text", F.xxhash64("text").alias("copy")).mapInArrow(keys, f"doc_id {kind}, cid long, copy long"))
    texts = members.where("cid IS NOT NULL").groupBy("cid", "copy").agg(F.min("doc_id").alias("least"))
    # One text of each class stands for its set.
    classes = settled(texts.groupBy("cid").agg(F.count("*").alias("w"), F.min("least").alias("least"), F.min("copy").alias("copy")))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, owner, tokens, key in _sets(batch.column(0), batch.column(1), shingle_words):
                some = np.flatnonzero(key)
                _, first = np.unique(key[some], return_index=True)  # copies in one chunk walk once
                lead = np.zeros(j - i, dtype=bool)
                lead[some[first]] = True
                keep = lead[owner]
                owner, tokens = owner[keep], tokens[keep]
                used, bit = sketches(owner, tokens, j - i)
                at, node = first_steps(owner, tokens, j - i, runs, threshold)
                size, who = tk.per_text(owner, j - i), np.flatnonzero(lead)
                nodes = pa.ListArray.from_arrays(_list_offsets(at, who), pa.array(node.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[who].view(np.int64)), pa.array(size[who]), pa.array([used[k].tobytes() for k in who], pa.binary()), pa.array([bit[k].tobytes() for k in who], pa.binary()), nodes],
                    ["cid", "size", "used", "bit", "nodes"],
                )

    walked = slim.mapInArrow(walk, "cid long, size long, used binary, bit binary, nodes array<long>")
    # Copies in different chunks have walked alike: one row for each class stays.
    info = settled(walked.dropDuplicates(["cid"]))

    def meet(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Sets that are not alone at a node, and the candidates of small nodes."""
        sizes = rows.groupBy("node").agg(F.count("*").alias("n"), F.min("cid").alias("least")).where("n > 1")
        met = settled(rows.join(shuffled(sizes), "node"))
        few = met.where(F.col("n") <= SMALL_NODE).select("node", "cid")
        buckets = max(1, math.ceil(few.count() / BUCKET_ROWS))
        small = few.join(shuffled(info.select("cid", "size", "used", "bit")), "cid").withColumn("bucket", F.pmod(F.xxhash64("node"), F.lit(buckets)))
        return met.where(F.col("n") > SMALL_NODE), small.groupBy("bucket").applyInArrow(lambda t: compare_small(t, threshold), "a long, b long")

    many, candidates = meet(info.select("cid", F.explode("nodes").alias("node")))
    missed = -math.log(1 - target_recall)
    parents = many.groupBy("cid").agg(F.count("*").alias("n_large"), F.collect_list("node").alias("parents"))
    deep = info.select("cid", F.size("nodes").alias("m")).join(shuffled(parents), "cid")
    deep = settled(deep.where(F.col("m") - F.col("n_large") - (1 - threshold) * F.col("m") < missed).select("cid", "parents"))
    if not deep.isEmpty():
        steps = settled(_deep_steps(slim, classes, deep, shingle_words, threshold))
        second, more = meet(steps.where("level = 2").select("cid", "node").distinct())
        third = steps.where("level = 3").join(shuffled(second.select("cid", F.col("node").alias("parent"))), ["cid", "parent"], "left_semi")
        last, still_more = meet(third.select("cid", "node").distinct())
        candidates = candidates.unionByName(more).unionByName(still_more).unionByName(last.select(F.col("cid").alias("a"), F.col("least").alias("b")))
    clusters = settled(components(candidates.distinct()))

    links, roots = _exact(slim, clusters, classes, info, shingle_words, threshold)
    groups = components(roots)
    named = classes.join(groups, classes["cid"] == groups["node"], "left").select("cid", "w", "least", F.coalesce("component", "cid").alias("component"))
    least = named.groupBy("component").agg(F.min("least").alias("class_id"))
    by_class = (
        named.join(least, "component")
        .join(links, "cid", "left")
        .select("cid", "component", "class_id", F.col("least").alias("copy_id"), (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("n_links"))
    )
    return members.join(by_class, "cid", "left").select(
        "doc_id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("copy_id", "doc_id").alias("copy_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        *[F.col("copy").alias("text_id"), F.col("component").alias("group_id")] * with_keys,
    )


def _list_offsets(at: np.ndarray, who: np.ndarray) -> pa.Array:
    """Offsets of the lists of some texts, from the sorted text of each entry (others have none)."""
    return pa.array(np.append(np.searchsorted(at, who), len(at)), pa.int32())


def _texts_of(slim: DataFrame, wanted: DataFrame) -> DataFrame:
    """The documents whose text has a wanted hash."""
    if wanted.count() <= BROADCAST_CLASSES:
        wanted = F.broadcast(wanted)
    return slim.join(wanted, F.xxhash64("text") == F.col("wanted"), "left_semi")


def _deep_steps(slim: DataFrame, classes: DataFrame, deep: DataFrame, shingle_words: int, threshold: float) -> DataFrame:
    """(cid, level, parent, node) of the second and third steps of sets below their large nodes."""
    named = settled(deep.join(classes.select("cid", "copy"), "cid"))
    texts = _texts_of(slim, named.select(F.col("copy").alias("wanted"))).select(F.xxhash64("text").alias("copy"), "text").dropDuplicates(["copy"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, docs, tokens, _ in _sets(batch.column(0), batch.column(1), shingle_words):
                parents = batch.column(2).slice(i, j - i)
                owner = np.repeat(np.arange(j - i), parents.value_lengths().to_numpy())
                node = parents.flatten().to_numpy().view(np.uint64)
                for level in (2, 3):
                    owner, parent, node = next_steps(docs, tokens, j - i, owner, node, threshold)
                    ids = batch.column(0).slice(i, j - i).take(pa.array(owner))
                    yield pa.RecordBatch.from_arrays([ids, pa.array(np.full(len(owner), level, np.int32)), pa.array(parent.view(np.int64)), pa.array(node.view(np.int64))], ["cid", "level", "parent", "node"])

    return texts.join(named, "copy").select("cid", "text", "parents").mapInArrow(walk, "cid long, level int, parent long, node long")


def _exact(slim: DataFrame, clusters: DataFrame, classes: DataFrame, info: DataFrame, shingle_words: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """All pairs inside the clusters, in tiles: (cid, links) and the links' spanning forest."""
    texts = _texts_of(slim, clusters.select(F.col("node").alias("cid")).join(classes.select("cid", F.col("copy").alias("wanted")), "cid").select("wanted"))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, owner, tokens, key in _sets(batch.column(0), batch.column(1), shingle_words):
                key = key.view(np.int64)
                some = np.flatnonzero(key)
                some = some[np.unique(key[some], return_index=True)[1]]
                starts, ends = np.searchsorted(owner, some), np.searchsorted(owner, some, side="right")
                yield pa.RecordBatch.from_arrays([pa.array(key[some]), pa.array([tokens[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary())], ["cid", "tokens"])

    sets = texts.mapInArrow(gather, "cid long, tokens binary").dropDuplicates(["cid"])
    # Only clusters of several blocks are listed: at most one for TILE sets or TILE_TOKENS tokens of the corpus.
    sized = clusters.join(info.select(F.col("cid").alias("node"), "size"), "node")
    blocks = F.greatest(F.ceil(F.count("*") / TILE), F.ceil(F.sum("size") / TILE_TOKENS)).cast("int")
    several = settled(sized.groupBy("component").agg(blocks.alias("several")).where("several > 1"))
    if several.count() <= BROADCAST_CLASSES:
        several = F.broadcast(several)
    placed = clusters.join(several, "component", "left").select(F.col("node").alias("cid"), "component", F.coalesce("several", F.lit(1)).alias("blocks"))
    placed = placed.withColumn("block", F.pmod(F.xxhash64(F.lit(3), "cid"), "blocks").cast("int"))
    rows = sets.join(placed, "cid").join(classes.select("cid", "w"), "cid")

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("cid")
        tokens = table["tokens"].to_pylist()
        one = {"component": table["component"][0].as_py(), "block": table["block"][0].as_py(), "blocks": table["blocks"][0].as_py(), "cid": table["cid"].to_numpy().tobytes(), "w": table["w"].to_numpy().tobytes(), "size": np.array([len(t) // 8 for t in tokens], np.int64).tobytes(), "tokens": b"".join(tokens)}
        return pa.Table.from_pylist([one], schema=pa.schema([("component", pa.int64()), ("block", pa.int32()), ("blocks", pa.int32()), ("cid", pa.binary()), ("w", pa.binary()), ("size", pa.binary()), ("tokens", pa.binary())]))

    packed = settled(rows.groupBy("component", "block").applyInArrow(pack, "component long, block int, blocks int, cid binary, w binary, size binary, tokens binary"))
    fields = ("cid", "w", "size", "tokens")
    numbers = F.sequence(F.lit(0), F.col("blocks") - 1)
    # Block i goes to the tiles (i, j) for j >= i as their left side, to (j, i) for j <= i as their right.
    left = packed.select("component", F.col("block").alias("i"), F.explode(F.filter(numbers, lambda x: x >= F.col("block"))).alias("j"), *[F.col(c).alias(f"a_{c}") for c in fields])
    right = packed.select("component", F.explode(F.filter(numbers, lambda x: x <= F.col("block"))).alias("i"), F.col("block").alias("j"), *[F.col(c).alias(f"b_{c}") for c in fields])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield compare_tile(batch.slice(k, 1).to_pylist()[0], threshold)

    tiles = settled(left.join(shuffled(right), ["component", "i", "j"]).mapInArrow(compare, "cid long, links long, root long"))
    links = tiles.groupBy("cid").agg(F.sum("links").alias("links"))
    return links, tiles.select(F.col("cid").alias("a"), F.col("root").alias("b"))


def one_of_each_group(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, with one document left of each near-duplicate group.

    The one with the smallest id stays, once if its row is repeated; of several
    texts of that id in one group the one of the smallest hash.  Texts that
    share an id are judged one by one.  Rows with a null id stay unless their
    group has an id.
    """
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, with_keys=True, **options)
    going, going_text, text_id = unused(docs.columns, "_gone", "_gone_text", "_text_id")
    gone = found.where("class_id <> doc_id OR doc_id IS NULL AND class_id IS NOT NULL").select("doc_id", "text_id")
    unique = docs.where(F.col(id_col).isNotNull()).groupBy(id_col).count().where("count > 1").isEmpty()
    if not unique:
        heads = found.where("class_id = doc_id AND group_id IS NOT NULL").select("group_id", "doc_id", "text_id").distinct()
        first = heads.groupBy("group_id").agg(F.min("text_id").alias("first_text"))
        gone = gone.unionByName(heads.join(first, "group_id").where("text_id <> first_text").select("doc_id", "text_id"))
    gone = gone.distinct().select(F.col("doc_id").alias(going), F.col("text_id").alias(going_text))
    left = docs.join(gone, F.col(id_col).eqNullSafe(F.col(going)) & (F.xxhash64(text_col) == F.col(going_text)), "left_anti")
    if unique:
        return left
    once = left.where(F.col(id_col).isNotNull()).withColumn(text_id, F.xxhash64(text_col)).dropDuplicates([id_col, text_id]).drop(text_id)
    return left.where(F.col(id_col).isNull()).unionByName(once)
