"""Subword tokens of whole texts, worked out once for each distinct pre-token.

The pre-tokenizer's pattern is applied to code-point classes with array
operations; the classes themselves come from the tokenizer library, asked once
for each distinct code point.  Pre-tokens are then hashed, and only those not
met before by this worker are turned into tokens.
"""

from __future__ import annotations

import heapq
import json
import unicodedata

import numpy as np
import pandas as pd
from tokenizers import Tokenizer, pre_tokenizers

from . import textkit as tk

LETTER, NUMBER, SPACE, OTHER, UNKNOWN = 1, 2, 3, 4, 0
#: Distinct pre-tokens kept by a worker; beyond it the memory starts afresh.
CACHE_SIZE = 1_500_000
#: English contractions that the patterns split off, after the apostrophe.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")

_pattern = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
_classes = np.zeros(0x110000, dtype=np.uint8)


def _classify(point: int) -> int:
    c = chr(point)
    for head, kind in (("a", LETTER), ("1", NUMBER), ("!", OTHER)):
        if len(_pattern.pre_tokenize_str(head + c)) == 1:
            return kind
    return SPACE


def classes(points: np.ndarray) -> np.ndarray:
    """Class of each code point as the library's patterns see it."""
    out = _classes[points]
    if (out == UNKNOWN).any():
        for p in np.unique(points[out == UNKNOWN]):
            _classes[p] = _classify(int(p))
        out = _classes[points]
    return out


def split_specials(data: np.ndarray, offsets: np.ndarray, specials: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Cut texts at special strings.

    Returns the bytes without them, the offsets of the segments, each segment's
    text, and (segment, id) for every special: it stands before that segment.
    """
    n = len(offsets) - 1
    raw = data.tobytes()
    found: list[tuple[int, int, int]] = []
    for text, number in specials.items():
        at = raw.find(text)
        while at >= 0:
            d = int(tk.owner(offsets, np.array([at]))[0])
            if at + len(text) <= offsets[d + 1]:
                found.append((at, at + len(text), number))
                at = raw.find(text, at + len(text))
            else:
                at = raw.find(text, at + 1)
    if not found:
        return data, offsets, np.arange(n), []
    found.sort()
    keep = np.ones(len(data), dtype=bool)
    for a, b, _ in found:
        keep[a:b] = False
    moved = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(keep, out=moved[1:])
    ends = np.array([b for _, b, _ in found])
    docs = np.concatenate([np.arange(n), tk.owner(offsets, ends - 1)])
    starts = np.concatenate([offsets[:-1], ends])
    is_cut = np.concatenate([np.full(n, -1), np.arange(len(found))])
    order = np.lexsort((np.arange(len(starts)), starts, docs))
    docs, starts, is_cut = docs[order], starts[order], is_cut[order]
    return data[keep], np.append(moved[starts], moved[-1]), docs, [(int(s), found[c][2]) for s, c in enumerate(is_cut) if c >= 0]


def _contractions(points: np.ndarray, kinds: np.ndarray, opens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Apostrophes that open a contraction, and the letters that follow in it."""
    n = len(points)
    at = np.flatnonzero(opens & (points == 0x27))
    at = at[at + 1 < n]
    # The apostrophe stands alone in its run: what follows is the letter itself.
    length = np.zeros(len(at), dtype=np.int64)
    for text in CONTRACTIONS:
        ok = (length == 0) & (at + len(text) < n)
        for k, c in enumerate(text):
            ok[ok] &= points[at[ok] + 1 + k] == ord(c)
        length[ok] = len(text)
    return at[length > 0], length[length > 0]


def _run_starts(kinds: np.ndarray, first: np.ndarray) -> np.ndarray:
    new = np.ones(len(kinds), dtype=bool)
    new[1:] = kinds[1:] != kinds[:-1]
    return new | first


def _firsts(n: int, offsets: np.ndarray) -> np.ndarray:
    first = np.zeros(n + 1, dtype=bool)
    first[offsets] = True
    return first[:n]


def _contractions_inside(at: np.ndarray, length: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Those that end within the text they begin in."""
    return tk.owner(offsets, at) == tk.owner(offsets, at + length)


def byte_level_starts(points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the byte-level pattern's matches begin (they cover every code point)."""
    n = len(points)
    kinds, first = classes(points), _firsts(n, offsets)
    last = np.append(first[1:], True)
    run = _run_starts(kinds, first)
    space = kinds == SPACE
    prev_blank = np.zeros(n, dtype=bool)  # a plain blank just before, in the same text
    prev_blank[1:] = (points[:-1] == 0x20) & ~first[1:]
    start = run.copy()
    start &= space | ~prev_blank  # a run takes a blank before it along
    # The last white space before something else stands apart from the rest of its run.
    before_text = space & ~last
    before_text[:-1] &= ~space[1:]
    start |= before_text
    at, length = _contractions(points, kinds, run & ~prev_blank)
    good = _contractions_inside(at, length, offsets)
    at, length = at[good], length[good]
    start[at + 1] = False
    ends = at + 1 + length
    inside = ends[ends < n]
    start[inside[kinds[inside] == LETTER]] = True
    return np.flatnonzero(start)


def word_spans(points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Matches of the word pattern: letter runs, single numbers, runs of the rest."""
    n = len(points)
    kinds, first = classes(points), _firsts(n, offsets)
    run = _run_starts(kinds, first)
    start = run | (kinds == NUMBER)
    at, length = _contractions(points, kinds, run)
    good = _contractions_inside(at, length, offsets)
    at, length = at[good], length[good]
    start[at + 1] = False
    ends = at + 1 + length
    inside = ends[ends < n]
    start[inside[kinds[inside] == LETTER]] = True
    starts = np.flatnonzero(start)
    stops = np.append(starts[1:], n)
    wanted = kinds[starts] != SPACE
    return starts[wanted], stops[wanted]


class _Memory:
    """Grows a sorted table of hashes with an int row number for each."""

    def __init__(self):
        self.clear()

    def clear(self):
        self.keys = np.zeros(0, dtype=np.uint64)
        self.rows = np.zeros(0, dtype=np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        return np.where(self.keys[at] == h, self.rows[at], -1)

    def add(self, h: np.ndarray, rows: np.ndarray):
        order = np.argsort(h)
        h, rows = h[order], rows[order]
        at = np.searchsorted(self.keys, h)
        self.keys, self.rows = np.insert(self.keys, at, h), np.insert(self.rows, at, rows)


class ByteLevelIds:
    """Ids of a byte-level BPE file of the tokenizers library."""

    _shared: dict[str, ByteLevelIds] = {}

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.specials = {t.content.encode(): i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.table = dict(enumerate(byte_alphabet()))
        self._forget()

    @classmethod
    def shared(cls, path: str):
        """One instance for each Python worker and file."""
        if path not in cls._shared:
            cls._shared[path] = cls(path)
        return cls._shared[path]

    def _forget(self):
        self.memory = _Memory()
        self.ids = np.zeros(0, dtype=np.uint32)
        self.begin = np.zeros(1, dtype=np.int64)

    def _learn(self, data: np.ndarray, h: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        raw, table, tokenize = data.tobytes(), self.table, self.tokenizer.model.tokenize
        words = [raw[a:b].decode("latin-1").translate(table) for a, b in zip(starts.tolist(), ends.tolist())]
        got = [[t.id for t in tokenize(w)] for w in words]
        sizes = np.fromiter(map(len, got), dtype=np.int64, count=len(got))
        flat = np.fromiter((i for x in got for i in x), dtype=np.uint32, count=int(sizes.sum()))
        base = len(self.begin) - 1
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, flat])
        self.memory.add(h, base + np.arange(len(h)))

    def encode(self, data: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, ``end_id`` after each, and where each text's ids end."""
        n = len(offsets) - 1
        data, segments, docs, specials = split_specials(data, offsets, self.specials)
        if len(self.memory.keys) > CACHE_SIZE:
            self._forget()
        points, at = tk.code_points(data, segments)
        first_byte = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        begins = byte_level_starts(points, at) if len(points) else np.zeros(0, np.int64)
        owner = docs[tk.owner(at, begins)]
        segment = tk.owner(at, begins)
        starts = first_byte[begins]
        ends = np.append(starts[1:], len(data))
        h = tk.Hasher(data).spans(starts, ends)
        codes, unique = pd.factorize(h)
        rows = self.memory.find(unique)
        new = np.flatnonzero(rows < 0)
        if len(new):
            example = np.zeros(len(unique), dtype=np.int64)
            example[codes[::-1]] = np.arange(len(h))[::-1]
            self._learn(data, unique[new], starts[example[new]], ends[example[new]])
            rows = self.memory.find(unique)
        rows = rows[codes]
        # Specials and end ids are items of one id each among the pre-tokens.
        if specials:
            s_seg, s_id = np.array(specials).T
        else:
            s_seg = s_id = np.zeros(0, dtype=np.int64)
        doc = np.concatenate([owner, docs[s_seg], np.arange(n)])
        seg = np.concatenate([segment, s_seg, np.full(n, np.iinfo(np.int64).max)])
        rank = np.concatenate([np.ones(len(rows)), np.zeros(len(s_seg)), np.ones(n)])
        length = np.concatenate([self.begin[rows + 1] - self.begin[rows], np.ones(len(s_seg) + n, np.int64)])
        source = np.concatenate([self.begin[rows], np.full(len(s_seg) + n, -1)])
        fixed = np.concatenate([np.zeros(len(rows), np.int64), s_id, np.full(n, end_id)])
        if len(s_seg):
            order = np.lexsort((rank, seg, doc))
        else:  # each text's end comes after its pre-tokens
            order = np.argsort(doc, kind="stable")
        doc, length, source, fixed = doc[order], length[order], source[order], fixed[order]
        out_at = np.cumsum(length) - length
        take = np.repeat(source - out_at, length) + np.arange(int(length.sum()))
        alone = np.repeat(source < 0, length)
        take[alone] = 0
        out = self.ids[take] if len(self.ids) else np.zeros(len(take), np.uint32)
        out[alone] = np.repeat(fixed, length)[alone].astype(np.uint32)
        return np.ascontiguousarray(out), np.cumsum(tk.per_text(doc, n, length))


def count_after_merges(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Tokens left of a word: its symbols minus the merges made.

    A heap holds the ranks of adjacent pairs, a doubly linked list the symbols
    that are left; the lowest rank (leftmost on ties) is merged until no pair
    has one.  Entries whose symbols have changed since are skipped.
    """
    n = len(symbols)
    if n < 2:
        return n
    parts = list(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        rank = ranks.get((parts[i], parts[i + 1]))
        if rank is not None:
            heap.append((rank, i, parts[i], parts[i + 1]))
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if parts[i] != left or j >= n or parts[j] != right:
            continue
        parts[i] = left + right
        parts[j] = ""  # gone: matches no entry any more
        after[i] = k = after[j]
        merges += 1
        if k < n:
            before[k] = i
            rank = ranks.get((parts[i], parts[k]))
            if rank is not None:
                heapq.heappush(heap, (rank, i, parts[i], parts[k]))
        h = before[i]
        if h >= 0:
            rank = ranks.get((parts[h], parts[i]))
            if rank is not None:
                heapq.heappush(heap, (rank, h, parts[h], parts[i]))
    return n - merges


def byte_alphabet() -> list[str]:
    """The printable stand-in for every byte value that byte-level vocabularies use.

    Printable Latin-1 characters stand for themselves; the other bytes take the
    code points from 256 on, in order.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


_NOT_SIMPLE = np.uint32(0xFFFFFFFF)


class WordCounts:
    """Token counts of a lower-casing, word-end BPE file by heap-and-list merging."""

    _shared: dict[str, WordCounts] = {}

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        pairs = (tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"])
        self.ranks = {pair: i for i, pair in enumerate(pairs)}
        self.word_end = model.get("end_of_word_suffix") or ""
        self.specials = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        self.alphabet = byte_alphabet()
        self.folded = np.full(0x110000, _NOT_SIMPLE - np.uint32(1), dtype=np.uint32)
        self.memory = _Memory()
        self.counts = np.zeros(0, dtype=np.int32)

    @classmethod
    def shared(cls, path: str):
        if path not in cls._shared:
            cls._shared[path] = cls(path)
        return cls._shared[path]

    def _fold_one(self, point: int) -> int:
        """The lower-case code point, or a mark that its text needs the library's normalizer."""
        c = chr(point)
        jamo = 0x1100 <= point < 0x1200 or 0xA960 <= point < 0xA980 or 0xD7B0 <= point < 0xD800
        if unicodedata.category(c)[0] == "M" or jamo or not unicodedata.is_normalized("NFC", c):
            return int(_NOT_SIMPLE)
        if c.isspace():
            return point
        low = self.tokenizer.normalizer.normalize_str(c)
        return ord(low) if len(low) == 1 else int(_NOT_SIMPLE)

    def _normalized(self, points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = self.folded[points]
        unseen = low == _NOT_SIMPLE - np.uint32(1)
        if unseen.any():
            for p in np.unique(points[unseen]):
                self.folded[p] = self._fold_one(int(p))
            low = self.folded[points]
        hard = np.unique(tk.owner(offsets, np.flatnonzero(low == _NOT_SIMPLE)))
        if not len(hard):
            return low, offsets
        parts = np.split(low, offsets[1:-1])
        for d in hard:
            text = points[offsets[d] : offsets[d + 1]].astype("<u4").tobytes().decode("utf-32-le")
            parts[d] = np.frombuffer(self.tokenizer.normalizer.normalize_str(text).encode("utf-32-le"), dtype=np.uint32)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def count(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each packed text; special strings in it count one each."""
        n = len(offsets) - 1
        data, segments, docs, specials = split_specials(data, offsets, self.specials)
        out = np.zeros(n, dtype=np.int64)
        for s, _ in specials:
            out[docs[s]] += 1
        if len(self.memory.keys) > CACHE_SIZE:
            self.memory, self.counts = _Memory(), np.zeros(0, dtype=np.int32)
        points, at = self._normalized(*tk.code_points(data, segments))
        if not len(points):
            return out
        starts, ends = word_spans(points, at)
        text = np.frombuffer(points.astype("<u4").tobytes().decode("utf-32-le").encode(), dtype=np.uint8)
        first_byte = np.append(np.flatnonzero((text & 0xC0) != 0x80), len(text))
        b_starts, b_ends = first_byte[starts], first_byte[ends]
        codes, unique = pd.factorize(tk.Hasher(text).spans(b_starts, b_ends))
        rows = self.memory.find(unique)
        new = np.flatnonzero(rows < 0)
        if len(new):
            example = np.zeros(len(unique), dtype=np.int64)
            example[codes[::-1]] = np.arange(len(codes))[::-1]
            at_word = example[new]
            raw, alphabet = text.tobytes(), self.alphabet
            got = []
            for a, b in zip(b_starts[at_word].tolist(), b_ends[at_word].tolist()):
                symbols = [alphabet[x] for x in raw[a:b]]
                symbols[-1] += self.word_end
                got.append(count_after_merges(symbols, self.ranks))
            self.memory.add(unique[new], len(self.counts) + np.arange(len(new)))
            self.counts = np.concatenate([self.counts, np.array(got, dtype=np.int32)])
            rows = self.memory.find(unique)
        return out + tk.per_text(docs[tk.owner(at, starts)], n, self.counts[rows[codes]])
