"""Removal of repeated substrings by merging shard Burrows-Wheeler transforms.

A byte goes when it lies in a string of ``min_bytes`` bytes that also starts in
a document with a smaller id.  Three Spark steps find these strings without
sorting all suffixes of the corpus:

1. Every window of ``min_bytes`` bytes has one anchor, its smallest hashed
   ``ANCHOR_BYTES``-gram; neighbouring windows with the same anchor form a run.
   Equal windows have equal anchors, so whatever the corpus says about a window
   is known where its anchor's runs meet.  Blocks of documents first settle
   equal runs among themselves, then one entry for each distinct run goes to
   the anchor's bucket.  A run that a smaller document has whole goes.
2. Where an anchor has several different runs in several documents, their bytes
   are fetched.  Windows whose hash no other document has are left out, which
   loses nothing; of equal strings that are left, byte by byte, one stands for
   all.  Each bucket sorts the suffixes of its shards of strings, and merges the
   shards' Burrows-Wheeler transforms by iterative interleave refinement.
   Round k of the refinement tells which suffixes share k bytes; after
   ``min_bytes`` rounds the blocks left are the repeated intervals.
3. The verdicts return to their documents, which drop the covered bytes.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textkit as tk
from .common import in_order, settled

MIN_BYTES = 50
ANCHOR_BYTES = 20
#: Text bytes for each anchor bucket, and for each group of documents, on average.
BUCKET_BYTES = 8 << 20
GROUP_BYTES = 2 << 20
#: Symbols of a shard whose suffixes are sorted together (at most 2**20), and of
#: the shards merged at once, unless one anchor's runs have more.
SHARD_SYMBOLS = 1 << 14
UNIT_SYMBOLS = 1 << 15
#: Symbols that one refinement round adds.
STEP = 4
#: A prime and a factor below it that spread ids over groups: products stay within 64 bits.
PRIME = (1 << 31) - 1
SPREAD = 1_640_531_527


# ---------------------------------------------------------------- runs


def runs(data: np.ndarray, offsets: np.ndarray, size: int = MIN_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchored runs of packed texts: anchor hash, run hash, text, start, end."""
    empty = np.zeros(0, np.uint64), np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 3
    n, gram = len(data), min(ANCHOR_BYTES, size)
    if n < size:
        return empty
    hasher = tk.Hasher(data)
    h = hasher.grams(gram)
    # High half: hash; low half: position, so the minimum is the leftmost one.
    least = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    width, have = size - gram + 1, 1
    while 2 * have <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < width:
        least = np.minimum(least[: len(least) - (width - have)], least[width - have :])
    # A window must not reach into the next text.
    inside = np.ones(len(least), dtype=bool)
    for end in offsets[1:-1].tolist():
        inside[max(0, end - size + 1) : end] = False
    # Runs begin where the anchor changes or windows begin again, and end likewise.
    change = np.ones(len(least) + 1, dtype=bool)
    change[1:-1] = (least[1:] != least[:-1]) | (inside[1:] != inside[:-1])
    edge = np.flatnonzero(change)
    edge = edge[edge <= len(least)]
    starts, stops = edge[:-1], edge[1:]
    good = inside[starts]
    starts, ends = starts[good], stops[good] + size - 1
    if not len(starts):
        return empty
    anchor = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    return h[anchor], hasher.spans(starts, ends), tk.owner(offsets, starts), starts, ends


def _least_by(keys: tuple[np.ndarray, ...], doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts by keys then doc, and the first entry of each key in that order."""
    order = np.lexsort((doc, *reversed(keys)))
    new = np.zeros(len(order), dtype=bool)
    if len(order):
        new[0] = True
        for k in keys:
            s = k[order]
            new[1:] |= s[1:] != s[:-1]
    return order, new


# ---------------------------------------------------------------- Burrows-Wheeler


def shard_order(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Suffix order of strings that each end in a 0; with ``preceding`` it gives the transform.

    ``text`` has symbols 1..256 and the terminators; ``ends`` the positions
    after them.  The strings must come in sorted order: a terminator is then
    followed, cyclically, by its own string, and ties fall to the earlier one.
    """
    n = len(text)
    bits = max(1, int(n).bit_length())
    at = np.arange(n, dtype=np.uint64)
    stop = np.repeat(ends, np.diff(ends, prepend=0))
    left = stop - np.arange(n)  # symbols up to the terminator, included
    key = np.zeros(n, dtype=np.uint64)
    padded = np.append(text, np.zeros(4, text.dtype)).astype(np.uint64)
    for k in range(4):
        key = (key << np.uint64(9)) | np.where(left > k, padded[k : n + k], 0).astype(np.uint64)
    have, longest = 4, int(left.max())
    mask = np.uint64((1 << bits) - 1)
    while True:
        order = np.sort((key << np.uint64(bits)) | at)
        sa = (order & mask).astype(np.int64)
        head = order >> np.uint64(bits)
        new = np.ones(n, dtype=bool)
        new[1:] = head[1:] != head[:-1]
        if have >= longest or new.all():
            break
        rank = np.empty(n, dtype=np.uint64)
        rank[sa] = np.cumsum(new).astype(np.uint64)
        after = np.where(left > have, np.append(rank, np.zeros(have, np.uint64))[have : n + have], 0).astype(np.uint64)
        key = (rank << np.uint64(bits)) | after
        have *= 2
    return sa


def preceding(text: np.ndarray, ends: np.ndarray, sa: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` symbols before each suffix, packed, and whether a terminator is among them."""
    begins = ends - np.diff(ends, prepend=0)
    back = np.arange(-1, len(text) - 1)
    back[begins] = ends - 1  # before a string comes, cyclically, its own terminator
    packed = np.zeros(len(text), dtype=np.uint64)
    cut = np.zeros(len(text), dtype=bool)
    at = sa
    for k in range(count):
        at = back[at]
        packed |= text[at].astype(np.uint64) << np.uint64(9 * k)
        cut |= text[at] == 0
    return packed, cut


def merge_transforms(shards: list[tuple[np.ndarray, np.ndarray, np.ndarray]], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleave of shard transforms and, in merged order, blocks of suffixes that share ``depth`` symbols.

    ``shards`` holds (text, string ends, suffix order) of each.  A round sorts
    the interleave stably by the symbols that precede the suffixes, which brings
    it from being sorted by k symbols to k + STEP, and splits blocks where these
    symbols differ.  A terminator equals nothing, itself included.
    """
    shard = np.repeat(np.arange(len(shards), dtype=np.uint16), [len(t) for t, _, _ in shards])
    n = len(shard)
    bits = int(n).bit_length()
    step = max(1, min(STEP, (64 - bits) // 9, depth))
    block = np.zeros(n, dtype=np.int32)
    at = np.arange(n, dtype=np.uint64)
    mask = np.uint64((1 << bits) - 1)
    symbols, cut = np.empty(n, dtype=np.uint64), np.empty(n, dtype=bool)
    done, width = 0, 0
    while done < depth:
        now = depth % step or step if not done else step
        if now != width:
            width, before = now, [np.concatenate(x) for x in zip(*(preceding(*s, now) for s in shards))]
        # A shard's suffixes keep their order in the interleave.
        mine = np.argsort(shard, kind="stable")
        symbols[mine], cut[mine] = before
        order = np.sort((symbols << np.uint64(bits)) | at)
        moved = (order & mask).astype(np.int64)
        head = order >> np.uint64(bits)
        was = block[moved]
        new = np.ones(n, dtype=bool)
        new[1:] = (head[1:] != head[:-1]) | (was[1:] != was[:-1]) | cut[moved[1:]]
        shard, block = shard[moved], np.cumsum(new, dtype=np.int32)
        done += now
    return shard, block


def merged_least(strings: list[bytes], docs: np.ndarray, depth: int = MIN_BYTES, shard_symbols: int = SHARD_SYMBOLS) -> list[np.ndarray]:
    """For each string, the smallest document that has each of its windows of ``depth`` bytes, from merged transforms."""
    order = sorted(range(len(strings)), key=lambda i: (strings[i], docs[i]))
    lengths = np.array([len(strings[i]) + 1 for i in order])
    ends = np.cumsum(lengths)
    text = np.frombuffer(b"".join(strings[i] + b"\0" for i in order), dtype=np.uint8).astype(np.uint16) + 1
    text[ends - 1] = 0
    cuts, begin = [0], 0
    for i, e in enumerate(ends):
        if e - begin >= shard_symbols or i == len(ends) - 1:
            cuts.append(i + 1)
            begin = e
    suffixes, shards = [], []
    for a, b in zip(cuts[:-1], cuts[1:]):
        first = int(ends[a] - lengths[a])
        part = text[first : ends[b - 1]], ends[a:b] - first
        sa = shard_order(*part)
        suffixes.append(sa + first)
        shards.append((*part, sa))
    shard, block = merge_transforms(shards, depth)
    where = np.empty(len(text), dtype=np.int64)
    where[np.argsort(shard, kind="stable")] = np.concatenate(suffixes)
    owner = np.repeat(np.array(docs)[order], lengths)
    # Blocks are contiguous in merged order: least document of each.
    opens = np.flatnonzero(np.diff(block, prepend=-1))
    smallest = np.empty(len(text), dtype=owner.dtype)
    smallest[where] = np.repeat(np.minimum.reduceat(owner[where], opens), np.diff(opens, append=len(text)))
    out: list[np.ndarray] = [np.zeros(0, owner.dtype)] * len(strings)
    for k, i in enumerate(order):
        begin = int(ends[k] - lengths[k])
        out[i] = smallest[begin : begin + max(0, int(lengths[k]) - depth)]
    return out


def shared_stretches(strings: list[bytes], docs: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of windows whose hash several documents have: string, first window, number of windows."""
    none = (np.zeros(0, np.int64),) * 3
    lengths = np.array([len(x) for x in strings])
    data = np.frombuffer(b"".join(strings), dtype=np.uint8)
    if len(data) < depth:
        return none
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(strings)), lengths)[: len(data) - depth + 1]
    inside = np.flatnonzero(np.arange(len(owner)) + depth <= ends[owner])
    h, doc = tk.Hasher(data).grams(depth)[inside], docs[owner[inside]]
    order = np.argsort(h)
    opens = np.flatnonzero(np.append(True, h[order[1:]] != h[order[:-1]])) if len(h) else np.zeros(0, np.int64)
    if not len(opens):
        return none
    several = np.minimum.reduceat(doc[order], opens) < np.maximum.reduceat(doc[order], opens)
    shared = np.zeros(len(owner) + 1, dtype=bool)
    shared[inside[order]] = np.repeat(several, np.diff(opens, append=len(h)))
    at = np.flatnonzero(shared)
    lead = np.ones(len(at), dtype=bool)
    lead[1:] = (at[1:] != at[:-1] + 1) | (owner[at[1:]] != owner[at[:-1]])
    first = np.flatnonzero(lead)
    begins = at[first]
    return owner[begins], begins - (ends - lengths)[owner[begins]], np.diff(first, append=len(at))


def repeated_windows(strings: list[bytes], docs: np.ndarray, depth: int = MIN_BYTES, shard_symbols: int = SHARD_SYMBOLS) -> list[np.ndarray]:
    """For each string, which of its windows of ``depth`` bytes start in a smaller document's string."""
    docs = np.asarray(docs)
    out = [np.zeros(max(0, len(x) - depth + 1), dtype=bool) for x in strings]
    owner, start, count = (x.tolist() for x in shared_stretches(strings, docs, depth))
    pieces = [strings[i][a : a + n + depth - 1] for i, a, n in zip(owner, start, count)]
    least: dict[bytes, int] = {}
    for i, piece in zip(owner, pieces):
        least[piece] = min(int(docs[i]), least.get(piece, int(docs[i])))
    if least:
        found = dict(zip(least, merged_least(list(least), np.array(list(least.values())), depth, shard_symbols)))
        for i, a, n, piece in zip(owner, start, count, pieces):
            out[i][a : a + n] = found[piece] < docs[i]
    return out


# ---------------------------------------------------------------- Spark steps


def _group(doc, n_groups: int):
    """The group of a document, of its id as an array or as a column; ids with a common factor spread as well."""
    if isinstance(doc, Column):
        return F.pmod(doc, F.lit(PRIME)) * F.lit(SPREAD) % F.lit(PRIME) % F.lit(n_groups)
    return np.mod(doc, PRIME) * SPREAD % PRIME % n_groups


def _size_kind(size: int):
    """The unsigned integers that hold the length of a run (less than two windows)."""
    return np.uint16 if 2 * size <= 1 << 16 else np.uint32


def _bytes(column: pa.ChunkedArray, kind) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype=kind) for x in column.to_pylist()]


def _entries(batches: Iterator[pa.RecordBatch], n_buckets: int, n_groups: int, size: int) -> Iterator[pa.RecordBatch]:
    """Block by block: distinct runs for the anchor buckets, and verdicts already clear."""
    for batch in batches:
        known = np.asarray(batch.column(0).is_valid().to_numpy(zero_copy_only=False))
        ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        data, offsets = tk.packed(batch.column(1))
        found = []
        for i, _, part, at in tk.chunks(data, offsets):
            anchor, run, doc, _, _ = runs(part, at, size)
            keep = known[i + doc]
            found.append((anchor[keep] >> np.uint64(32), run[keep], ids[i + doc[keep]]))
        if not found:
            continue
        anchor, run, doc = (np.concatenate(x) for x in zip(*found))
        order, first = _least_by((run,), doc)
        anchor, run, doc = anchor[order], run[order], doc[order]
        least = doc[np.flatnonzero(first)][np.cumsum(first) - 1] if len(doc) else doc
        rows: list[dict] = []
        for g, part in _by(_group(doc[doc > least], n_groups), n_groups):
            late = np.flatnonzero(doc > least)[part]
            late = late[_distinct(run[late], doc[late])]
            rows.append({"bucket": g % n_buckets, "g": g, "run": run[late].tobytes(), "doc": doc[late].tobytes(), "anchor": None, "base": 0})
        anchor, run, doc = anchor[first], run[first], doc[first]
        for b, part in _by((tk.mix(anchor) % np.uint64(n_buckets)).astype(np.int64), n_buckets):
            base = int(doc[part].min())
            shift = doc[part] - base
            narrow = np.uint32 if int(shift.max()) < 1 << 32 else np.uint64
            rows.append({"bucket": b, "g": None, "run": run[part].tobytes(), "doc": shift.astype(narrow).tobytes(), "anchor": anchor[part].astype(np.uint32).tobytes(), "base": base})
        for k in range(0, len(rows), 256):
            yield pa.RecordBatch.from_pylist(rows[k : k + 256], schema=_ENTRY)


_ENTRY = pa.schema([("bucket", pa.int32()), ("g", pa.int32()), ("run", pa.binary()), ("doc", pa.binary()), ("anchor", pa.binary()), ("base", pa.int64())])
_VERDICT = pa.schema([("g", pa.int32()), ("bucket", pa.int32()), ("run", pa.binary()), ("doc", pa.binary()), ("ask_run", pa.binary()), ("ask_doc", pa.binary())])
_BYTES = pa.schema([("bucket", pa.int32()), ("g", pa.int32()), ("run", pa.binary()), ("doc", pa.binary()), ("anchor", pa.binary()), ("size", pa.binary()), ("text", pa.binary())])
_WINDOWS = pa.schema([("g", pa.int32()), ("run", pa.binary()), ("doc", pa.binary()), ("size", pa.binary()), ("windows", pa.binary())])


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def _by(key: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(key, entries) for the keys in 0..n-1 that have any."""
    order = np.argsort(key, kind="stable")
    bounds = np.searchsorted(key[order], np.arange(n + 1))
    for k in np.flatnonzero(np.diff(bounds)):
        yield int(k), order[bounds[k] : bounds[k + 1]]


def _distinct(run: np.ndarray, doc: np.ndarray) -> np.ndarray:
    order, first = _least_by((run, doc), doc)
    return order[first]


def _resolve(table: pa.Table, n_groups: int) -> pa.Table:
    """One bucket: runs that a smaller document has whole, and runs to be compared by bytes."""
    passed = table.filter(table["anchor"].is_null())
    table = table.filter(table["anchor"].is_valid())
    out = [{"g": r["g"], "bucket": r["bucket"], "run": r["run"], "doc": r["doc"], "ask_run": None, "ask_doc": None} for r in passed.to_pylist()]
    if table.num_rows:
        bucket = table["bucket"][0].as_py()
        anchor, run = (np.concatenate(_bytes(table[c], k)) for c, k in (("anchor", np.uint32), ("run", np.uint64)))
        doc = np.concatenate([np.frombuffer(d, np.uint32 if len(r) == 2 * len(d) else np.uint64).astype(np.int64) + b for d, r, b in zip(table["doc"].to_pylist(), table["run"].to_pylist(), table["base"].to_pylist())])
        order, first = _least_by((anchor, run), doc)
        anchor, run, doc = anchor[order], run[order], doc[order]
        late = doc > doc[first][np.cumsum(first) - 1]
        # Anchors with several runs in several documents: the first of each run is compared.
        a, r, d = anchor[first], run[first], doc[first]
        opens = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
        group = np.repeat(np.arange(len(opens)), np.diff(opens, append=len(a)))
        mixed = (np.minimum.reduceat(d, opens) < np.maximum.reduceat(d, opens))[group]
        r, d = r[mixed], d[mixed]
        verdicts = dict(_by(_group(doc[late], n_groups), n_groups))
        asks = dict(_by(_group(d, n_groups), n_groups))
        late_run, late_doc, none = run[late], doc[late], np.zeros(0, np.int64)
        for g in sorted(verdicts.keys() | asks.keys()):
            v, q = verdicts.get(g, none), asks.get(g, none)
            out.append({"g": g, "bucket": bucket, "run": late_run[v].tobytes(), "doc": late_doc[v].tobytes(), "ask_run": r[q].tobytes(), "ask_doc": d[q].tobytes()})
    return pa.Table.from_pylist(out, schema=_VERDICT)


def _key(run: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """One 64-bit key for a run in a document."""
    return tk.mix(run + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _fetch(texts: pa.Table, asked: pa.Table, size: int) -> pa.Table:
    """The bytes of the runs that buckets ask for, from the documents of one group."""
    asked = asked.filter(asked["ask_run"].is_valid())
    texts = texts.filter(texts["doc_id"].is_valid())
    if not asked.num_rows or not texts.num_rows:
        return _BYTES.empty_table()
    runs_, docs_ = _bytes(asked["ask_run"], np.uint64), _bytes(asked["ask_doc"], np.int64)
    bucket = np.repeat(asked["bucket"].to_numpy(), [len(x) for x in runs_])
    want_run, want_doc = np.concatenate(runs_), np.concatenate(docs_)
    want = _key(want_run, want_doc)
    order = np.argsort(want)
    g = texts["g"][0].as_py()
    ids = texts["doc_id"].to_numpy().astype(np.int64)
    data, offsets = tk.packed(texts["text"])
    place = np.full((len(want), 2), -1, dtype=np.int64)
    anchors = np.zeros(len(want), dtype=np.uint64)
    for i, _, part, at in tk.chunks(data, offsets):
        anchor, run, doc, starts, ends = runs(part, at, size)
        key = _key(run, ids[i + doc])
        spot = np.minimum(np.searchsorted(want[order], key), len(want) - 1)
        hit = want[order][spot] == key
        anchors[order[spot[hit]]] = anchor[hit]
        place[order[spot[hit]]] = np.stack([starts[hit], ends[hit]], axis=1) + offsets[i]
    # A run has one anchor, so one bucket asks for it.
    raw, out = data.tobytes(), []
    for b in np.unique(bucket):
        part = np.flatnonzero((bucket == b) & (place[:, 0] >= 0))
        part = part[np.argsort(anchors[part], kind="stable")]
        text = b"".join(raw[s:e] for s, e in place[part])
        out.append({"bucket": int(b), "g": g, "run": want_run[part].tobytes(), "doc": want_doc[part].tobytes(), "anchor": (anchors[part] >> np.uint64(32)).astype(np.uint32).tobytes(), "size": (place[part, 1] - place[part, 0]).astype(_size_kind(size)).tobytes(), "text": zlib.compress(text, 1)})
    return pa.Table.from_pylist(out, schema=_BYTES)


def _compare(table: pa.Table, size: int) -> pa.Table:
    """One bucket: which windows of its runs a smaller document's run has as well."""
    run, doc, anchor, lengths = (np.concatenate(_bytes(table[c], k)) for c, k in (("run", np.uint64), ("doc", np.int64), ("anchor", np.uint32), ("size", _size_kind(size))))
    if not len(run):
        return _WINDOWS.empty_table()
    text = b"".join(map(zlib.decompress, table["text"].to_pylist()))
    ends = np.cumsum(lengths, dtype=np.int64)
    strings = [text[e - n : e] for e, n in zip(ends.tolist(), lengths.tolist())]
    # Only runs of one anchor can share a window, so the bucket falls into units of whole anchors.
    found: list[np.ndarray] = [np.zeros(0, bool)] * len(run)
    order = np.argsort(anchor, kind="stable")
    done = np.cumsum(lengths[order], dtype=np.int64) // UNIT_SYMBOLS
    turn = np.append(True, anchor[order[1:]] != anchor[order[:-1]])
    first = np.flatnonzero(turn)
    unit = done[first]
    cuts = first[np.append(True, unit[1:] != unit[:-1])]
    for a, b in zip(cuts, np.append(cuts[1:], len(order))):
        part = order[a:b]
        for p, windows in zip(part, repeated_windows([strings[p] for p in part], doc[part], size)):
            found[p] = windows
    g = np.repeat(table["g"].to_numpy(), [len(x) // 8 for x in table["run"].to_pylist()])
    some = np.array([w.any() for w in found])
    out = []
    for k in np.unique(g[some]):
        part = np.flatnonzero(some & (g == k))
        out.append({"g": int(k), "run": run[part].tobytes(), "doc": doc[part].tobytes(), "size": np.array([len(found[p]) for p in part], np.uint32).tobytes(), "windows": np.concatenate([found[p] for p in part]).astype(np.uint8).tobytes()})
    return pa.Table.from_pylist(out, schema=_WINDOWS)


def _removed(texts: pa.Table, verdicts: pa.Table, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, offsets and removed mask of one group's documents."""
    known = np.asarray(texts["doc_id"].is_valid().to_numpy())
    ids = texts["doc_id"].fill_null(0).to_numpy().astype(np.int64)
    data, offsets = tk.packed(texts["text"])
    whole = verdicts.filter(verdicts["windows"].is_null())
    parts = verdicts.filter(verdicts["windows"].is_valid())
    keys = [_key(r, d) for r, d in zip(_bytes(whole["run"], np.uint64), _bytes(whole["doc"], np.int64))]
    full = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)
    p_keys = [_key(r, d) for r, d in zip(_bytes(parts["run"], np.uint64), _bytes(parts["doc"], np.int64))]
    if p_keys:
        p_key = np.concatenate(p_keys)
        p_size = np.concatenate(_bytes(parts["size"], np.uint32)).astype(np.int64)
        p_bits = np.concatenate(_bytes(parts["windows"], np.uint8))
        p_from = np.cumsum(p_size) - p_size
        order = np.argsort(p_key)
    edge = np.zeros(len(data) + 1, dtype=np.int64)
    for i, _, part, at in tk.chunks(data, offsets) if len(full) or p_keys else ():
        _, run, doc, starts, ends = runs(part, at, size)
        key = _key(run, ids[i + doc])
        live = known[i + doc]
        if len(full):
            spot = np.minimum(np.searchsorted(full, key), len(full) - 1)
            hit = (full[spot] == key) & live
            np.add.at(edge, starts[hit] + offsets[i], 1)
            np.add.at(edge, ends[hit] + offsets[i], -1)
        if p_keys:
            spot = np.minimum(np.searchsorted(p_key[order], key), len(order) - 1)
            hit = np.flatnonzero((p_key[order][spot] == key) & live)
            row = order[spot[hit]]
            n = p_size[row]
            step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            on = p_bits[np.repeat(p_from[row], n) + step] > 0
            window = (np.repeat(starts[hit], n) + step)[on] + offsets[i]
            np.add.at(edge, window, 1)
            np.add.at(edge, window + size, -1)
    return data, offsets, np.cumsum(edge)[:-1] > 0


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = MIN_BYTES, with_text: bool = False) -> DataFrame:
    """n_bytes, n_removed, n_spans and kept_sha256 of every document.

    With ``with_text`` the remaining bytes follow as ``kept`` (binary: a cut may
    fall inside a character).  A null text is empty.  Rows with a null id keep
    all and make nothing go.  Rows that share an id never make each other's
    bytes go.  Empty tables give no rows; other columns are ignored.  Texts of
    any length are read whole, chunk by chunk with the windows that overlap; a
    text of many groups' size is still one task's work, in bounded memory but
    for the text and the verdicts on it.  ``min_bytes`` may be of any size.
    """
    numbers = None
    if isinstance(docs.schema[id_col].dataType, T.IntegralType):
        slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    else:
        # Ids of another kind are numbered in their order.
        numbers = in_order(docs.select(F.col(id_col).alias("id")))
        slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(numbers, "id", "left").select(F.col("number").alias("doc_id"), "text")
    kind = docs.schema[id_col].dataType.simpleString()
    total = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = max(1, math.ceil(total / BUCKET_BYTES))
    n_groups = 2 * math.ceil(total / GROUP_BYTES / 2) + 1

    entries = slim.mapInArrow(lambda it: _entries(it, n_buckets, n_groups, min_bytes), _ddl(_ENTRY))
    verdicts = settled(entries.groupBy("bucket").applyInArrow(lambda t: _resolve(t, n_groups), _ddl(_VERDICT)))

    spread = [_group(x, n_groups) for x in (F.col("doc_id"), F.xxhash64("text"))]
    texts = slim.withColumn("g", F.coalesce(*spread, F.lit(0)).cast("int"))
    asked = verdicts.where("octet_length(ask_run) > 0").select("g", "bucket", "ask_run", "ask_doc")
    parts = (
        texts.groupBy("g").cogroup(asked.groupBy("g")).applyInArrow(lambda t, v: _fetch(t, v, min_bytes), _ddl(_BYTES))
        .groupBy("bucket").applyInArrow(lambda t: _compare(t, min_bytes), _ddl(_WINDOWS))
    )
    empty = F.lit(None).cast("binary")
    told = verdicts.where("octet_length(run) > 0").select("g", "run", "doc", empty.alias("size"), empty.alias("windows")).unionByName(parts)

    fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    ddl = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    schema = pa.schema(fields + [("kept", pa.binary())] * with_text)

    def finish(texts: pa.Table, verdicts: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return schema.empty_table()
        data, offsets, gone = _removed(texts, verdicts, min_bytes)
        opens, _ = tk.runs(gone, offsets)
        n = texts.num_rows
        sums = np.concatenate([[0], np.cumsum(gone)])
        kept = data[~gone].tobytes()
        at = (offsets - sums[offsets]).tolist()
        left = [kept[a:b] for a, b in zip(at[:-1], at[1:])]
        arrays = [texts["doc_id"].combine_chunks(), pa.array(np.diff(offsets)), pa.array(np.diff(sums[offsets])), pa.array(tk.per_text(tk.owner(offsets, opens), n)), pa.array([hashlib.sha256(x).hexdigest() for x in left])]
        return pa.Table.from_arrays(arrays + [pa.array(left, pa.binary())] * with_text, schema=schema)

    out = texts.groupBy("g").cogroup(told.groupBy("g")).applyInArrow(finish, ddl)
    if numbers is None:
        return out.withColumn("doc_id", F.col("doc_id").cast(kind))
    return out.join(numbers, F.col("doc_id") == F.col("number"), "left").select(F.col("id").alias("doc_id"), *[c for c in out.columns if c != "doc_id"])
