from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from plantpanel.llm import graph, jaccard_join, line_dedup, suffix_dedup
from plantpanel.llm import textkit as tk

from .helpers import SCHEMA, corpus, empty, prose, same, with_clashes, words_of


def shingles(text):
    w = words_of(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else [])


def brute_join(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    texts = {t: shingles(t) for _, t in rows if shingles(t)}
    names = list(texts)
    near = {t: {u for u in names if u != t and len(texts[t] & texts[u]) >= 0.8 * len(texts[t] | texts[u])} for t in names}
    group = {}
    for t in names:
        if t not in group:
            seen, todo = {t}, [t]
            while todo:
                for u in near[todo.pop()] - seen:
                    seen.add(u)
                    todo.append(u)
            ids = [i for i, u in rows if u in seen and i is not None]
            group |= {u: min(ids, default=None) for u in seen}
    return {(i, t): (group.get(t, i) if group.get(t) is not None else i, len(near.get(t, ()))) for i, t in rows}


def test_exploded_tables_are_not_broadcast(spark, monkeypatch):
    """Spark counts an exploded list for one row, so it would gather the steps of all sets on the driver."""
    plans, real = [], jaccard_join.settled

    def spy(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df)

    monkeypatch.setattr(jaccard_join, "settled", spy)
    jaccard_join.near_duplicates(corpus(spark)).count()
    exploded = [p for p in plans if "Generate explode" in p]
    assert exploded and not any("BroadcastExchange" in p for p in exploded)


def crowd(spark, n=300):
    """One crowd of near copies, larger than a small node, with a chain of ever farther edits."""
    rng = random.Random(9)
    base = [w.strip() for w in prose(rng, 160).split(" ")]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(60)}"
        rows.append((i, " ".join(w), "en", "s", 1))
    return spark.createDataFrame(rows, SCHEMA).unionByName(corpus(spark).withColumn("doc_id", F.col("doc_id") + n))


@pytest.mark.parametrize("make", [corpus, crowd])
def test_join(spark, make):
    docs = make(spark)
    want = brute_join(docs)
    rows = jaccard_join.near_duplicates(with_clashes(docs)).collect()
    assert len(rows) == docs.count()
    by_id = defaultdict(set)
    for (i, _), v in want.items():
        by_id[i].add(v)
    for r in rows:
        assert (r["class_id"], r["n_links"]) in by_id[r["doc_id"]], r
    assert same(jaccard_join.near_duplicates(docs.repartition(5)), jaccard_join.near_duplicates(docs))


def test_join_edges(spark):
    assert jaccard_join.near_duplicates(empty(spark)).count() == 0
    few = spark.createDataFrame([(1, None), (2, ""), (3, "a b"), (4, "a  b"), (5, "a c"), (6, "a b")], "doc_id long, text string")
    assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard_join.near_duplicates(few).collect()} == {1: (1, 0), 2: (2, 0), 3: (3, 1), 4: (3, 1), 5: (5, 0), 6: (3, 1)}
    left = jaccard_join.one_of_each_group(corpus(spark))
    assert left.columns == corpus(spark).columns
    ids = [r["doc_id"] for r in left.collect()]
    assert len(ids) == len(set(ids)) and 3 in ids and not {130, 131, 132} & set(ids) and 100 in ids and not {101, 107} & set(ids)


def test_one_of_each_group_with_odd_ids(spark):
    rows = [
        (1, "a b c"), (None, "a  b c"), (None, "a b c"),  # null ids go where their group has an id
        (None, "d e f"), (None, "d  e f"),  # and stay where it has none
        (2, "g h i"), (2, "j k l"), (3, "g  h i"),  # a clean text of a shared id stays
        (4, "a\tb c"), (4, "m n o"), (4, "m n o"),  # one text of an id goes, the other stays once
        (5, "p q r"), (5, "p  q r"),  # one of two near copies of one id stays
        (6, None), (None, None),
    ]
    left = [tuple(r) for r in jaccard_join.one_of_each_group(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sum(i == 5 for i, _ in left) == 1 and set(left) <= set(rows)
    assert sorted(map(str, (r for r in left if r[0] != 5))) == sorted(map(str, [rows[0], rows[3], rows[4], rows[5], rows[6], rows[9], rows[13], rows[14]]))


def test_tiles_agree_with_one_block(spark, monkeypatch):
    docs = crowd(spark)
    whole = jaccard_join.near_duplicates(docs)
    whole = whole.sparkSession.createDataFrame(whole.collect(), whole.schema)
    monkeypatch.setattr(jaccard_join, "TILE", 64)
    assert same(jaccard_join.near_duplicates(docs), whole)


def test_all_large_nodes_walk_on(spark, monkeypatch):
    """With every shared node large, the deeper steps alone must find the groups."""
    monkeypatch.setattr(jaccard_join, "SMALL_NODE", 1)
    docs = crowd(spark, 60)
    want = brute_join(docs)
    by_id = defaultdict(set)
    for (i, _), v in want.items():
        by_id[i].add(v)
    for r in jaccard_join.near_duplicates(docs).collect():
        assert (r["class_id"], r["n_links"]) in by_id[r["doc_id"]], r


@pytest.mark.parametrize(("left", "right", "common"), [(80, 100, 80), (90, 90, 80), (400, 500, 400)])
def test_walks_meet_as_often_as_stated(left, right, common):
    """Pairs at the threshold, contained ones too: share of runs that meet after one and after three levels."""
    rng = np.random.default_rng(5)
    pairs, runs = 150, 20
    tokens = rng.integers(0, 1 << 52, pairs * (left + right - common), dtype=np.uint64).reshape(pairs, -1)
    sets = [np.sort(np.concatenate([t[:common], t[common:left]])) if k == 0 else np.sort(np.concatenate([t[:common], t[left:]])) for t in tokens for k in (0, 1)]
    docs, flat = np.repeat(np.arange(len(sets)), [len(x) for x in sets]), np.concatenate(sets)
    owner, node = jaccard_join.first_steps(docs, flat, len(sets), runs, 0.8)
    mean = np.bincount(owner, minlength=len(sets)) / runs
    assert mean.mean() == pytest.approx(1.25, rel=0.05)
    met = lambda owner, node: [len(np.intersect1d(node[owner == 2 * k], node[owner == 2 * k + 1])) > 0 for k in range(pairs)]
    assert np.mean(met(owner, node)) > 0.99
    for _ in range(2):
        owner, _, node = jaccard_join.next_steps(docs, flat, len(sets), owner, node, 0.8)
    assert np.mean(met(owner, node)) > 0.99


def test_string_ids(spark):
    docs = corpus(spark).where("doc_id IS NOT NULL").withColumn("doc_id", F.format_string("d%05d", "doc_id"))
    numbers = {f"d{r['doc_id']:05d}": (f"d{r['class_id']:05d}", r["n_links"]) for r in jaccard_join.near_duplicates(corpus(spark).where("doc_id IS NOT NULL")).collect()}
    assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard_join.near_duplicates(docs).collect()} == numbers


def test_components(spark):
    rng = random.Random(1)
    pairs = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(40)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    parent = {x: x for p in pairs for x in p}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    want = {x: root(x) for p in pairs if p[0] != p[1] for x in p}
    assert got == want


def brute_repeats(docs, size=50):
    rows = sorted(((r["doc_id"], (r["text"] or "").encode()) for r in docs.collect() if r["doc_id"] is not None))
    first = {}
    for i, b in rows:
        for k in range(len(b) - size + 1):
            first.setdefault(b[k : k + size], i)
    out = {}
    for i, b in rows:
        gone = np.zeros(len(b), dtype=bool)
        for k in range(len(b) - size + 1):
            if first[b[k : k + size]] < i:
                gone[k : k + size] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[i] = (len(b), int(gone.sum()), int((gone & ~np.append(False, gone[:-1])).sum()) if len(b) else 0, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("make", [corpus, crowd])
def test_repeats(spark, make):
    docs = make(spark)
    want = brute_repeats(docs)
    rows = suffix_dedup.remove_repeats(with_clashes(docs)).collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r["doc_id"] is not None:
            assert tuple(r)[1:] == want[r["doc_id"]], r["doc_id"]
    assert suffix_dedup.remove_repeats(empty(spark)).count() == 0


def test_repeats_across_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 20_000)
    monkeypatch.setattr(suffix_dedup, "GROUP_BYTES", 10_000)
    docs = corpus(spark, seed=4)
    want = brute_repeats(docs)
    rows = suffix_dedup.remove_repeats(docs.repartition(6), with_text=True).collect()
    for r in rows:
        if r["doc_id"] is not None:
            assert tuple(r)[1:5] == want[r["doc_id"]] and hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"]


def test_merged_transforms_find_the_repeated_windows():
    rng = random.Random(3)
    base = ["".join(rng.choices("abc \0é", k=90)).encode() for _ in range(5)]
    strings = list({base[rng.randrange(5)][(a := rng.randrange(40)) : a + rng.randint(20, 70)] for _ in range(200)})
    docs = np.array([rng.randrange(50) for _ in strings])
    for depth in (1, 7, 50):
        least = {}
        for s, d in zip(strings, docs):
            for k in range(len(s) - depth + 1):
                least[s[k : k + depth]] = min(d, least.get(s[k : k + depth], 1 << 40))
        for shard in (100, 1500, 1 << 20):
            for s, got in zip(strings, suffix_dedup.merged_least(strings, docs, depth, shard)):
                assert got.tolist() == [least[s[k : k + depth]] for k in range(len(s) - depth + 1)]
            for s, d, got in zip(strings, docs, suffix_dedup.repeated_windows(strings, docs, depth, shard)):
                assert got.tolist() == [bool(least[s[k : k + depth]] < d) for k in range(len(s) - depth + 1)]


def brute_lines(docs):
    white = b" \t\n\v\f\r"
    rows = sorted({(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] is not None and r["text"] is not None})
    seen, out = set(), {}
    for i, t in rows:
        b = t.encode()
        _, starts, ends, lines, _ = line_dedup.chunk_lines(np.frombuffer(b, np.uint8), np.array([0, len(b)]))
        assert b"".join(b[s:e] for s, e in zip(starts, ends)) == b or not len(starts)
        left = [] if len(starts) else [b]
        for s, e, n in zip(starts, ends, lines):
            body = b[s:e].strip(white)
            if n >= line_dedup.MIN_LINES and e - s >= line_dedup.MIN_BYTES:
                if body in seen:
                    continue
                seen.add(body)
            left.append(b[s:e])
        out[i] = b"".join(left).decode()
    return out


def test_lines(spark):
    docs = corpus(spark)
    want = brute_lines(docs)
    out = line_dedup.dedup_lines(docs)
    assert out.columns == [*docs.columns, "n_lines_removed", "n_chunks_removed", "n_bytes_removed"]
    rows = out.collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r["doc_id"] in want:
            assert r["text"] == want[r["doc_id"]]
            assert r["n_bytes_removed"] == 0 or r["n_chunks_removed"] > 0
    assert any(r["n_chunks_removed"] for r in rows if r["doc_id"] in (121, 122, 123, 124))
    assert line_dedup.dedup_lines(empty(spark)).count() == 0
    assert line_dedup.dedup_lines(with_clashes(docs)).count() == docs.count()


def test_chunks_survive_insertions():
    rng = random.Random(6)
    lines = [prose(rng, 8).replace("\n", "") for _ in range(40)]

    def bodies(ls):
        b = "\n".join(ls).encode()
        _, s, e, _, _ = line_dedup.chunk_lines(np.frombuffer(b, np.uint8), np.array([0, len(b)]))
        return {b[x:y].strip() for x, y in zip(s, e)}

    assert len(bodies(lines) - bodies(["new line in front", *lines])) <= 2
    assert len(bodies(lines) - bodies([*lines[:20], "new line inside", *lines[20:]])) <= 3


def brute_passages(docs):
    """Lines that go: those in a run of 2 or more equal lines, of 40 bytes or more, that an earlier place has, by trying all pairs of places."""
    white = b" \t\n\v\f\r"
    rows = sorted({(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] is not None and r["text"] is not None})
    texts = [[(k, line.strip(white)) for k, line in enumerate(t.encode().split(b"\n")) if line.strip(white)] for _, t in rows]
    places = defaultdict(list)
    for d, lines in enumerate(texts):
        for k, (_, line) in enumerate(lines):
            places[line].append((d, k))
    out = {}
    for d, ((i, t), lines) in enumerate(zip(rows, texts)):
        gone = set()
        for k, (_, line) in enumerate(lines):
            for e, m in places[line]:
                if (e, m) >= (d, k):
                    break
                n = 0
                most = len(lines) - k if e < d else min(len(lines) - k, k - m)
                while n < most and m + n < len(texts[e]) and texts[e][m + n][1] == lines[k + n][1]:
                    n += 1
                if n >= 2 and len(b"\n".join(x for _, x in lines[k : k + n])) >= 40:
                    gone |= set(range(k, k + n))
        raw = t.encode().split(b"\n")
        starts = np.concatenate([[0], np.cumsum([len(x) + 1 for x in raw])])
        bounds = [0, *(int(starts[k]) for k, _ in lines[1:]), len(t.encode())]
        left = b"".join(t.encode()[bounds[k] : bounds[k + 1]] for k in range(len(lines)) if k not in gone) if lines else t.encode()
        out[i] = (left.decode(), len(gone), sum(k - 1 not in gone for k in gone))
    return out


def passages(spark):
    """Passages at random places between other lines, with short lines, blank lines and carriage returns."""
    rng = random.Random(12)
    line = lambda: prose(rng, rng.randint(1, 9)).replace("\n", "")
    pool = [[line() for _ in range(rng.randint(2, 9))] for _ in range(12)] + [["a", "b", "c d"] * 6, ["x", "y"]]
    rows = []
    for i in range(80):
        text = [line() for _ in range(rng.randint(0, 4))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(pool)
            a = rng.randrange(len(p))
            text += p[a : a + rng.randint(1, 9)] + [line() for _ in range(rng.randint(0, 3))]
        rows.append((i, "".join(x + rng.choice(["\n", "\n", "\n\n", "\r\n", " \n"]) for x in text), "en", "s", 1))
    rows.append((90, "again and again and again\n" * 7, "en", "s", 1))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("make", [corpus, crowd, passages])
def test_every_passage_goes_whole(spark, make):
    docs = make(spark)
    want = brute_passages(docs)
    rows = line_dedup.dedup_passages(with_clashes(docs)).collect()
    assert len(rows) == docs.count() and any(n for _, n, _ in want.values())
    for r in rows:
        if r["doc_id"] in want:
            assert (r["text"], r["n_lines_removed"], r["n_chunks_removed"]) == want[r["doc_id"]], r["doc_id"]
    assert same(line_dedup.dedup_passages(docs.repartition(5)), line_dedup.dedup_passages(docs))
    digest = {r["doc_id"]: r["kept_sha256"] for r in line_dedup.line_dedup_digest(docs).collect()}
    assert all(digest[i] == hashlib.sha256(t.encode()).hexdigest() for i, (t, _, _) in want.items())
    assert line_dedup.dedup_passages(empty(spark)).count() == 0


def test_passages_of_texts_that_share_an_id(spark):
    two = "first line of the passage\nsecond line of the passage\n"
    rows = [(1, two), (2, two + "and more"), (2, "something of its own\nthat no other text has\nof all of them")]
    out = line_dedup.dedup_passages(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r["doc_id"], r["text"]) for r in out.collect()) == [(1, two), (2, "and more"), rows[2]]


def test_passages_with_string_ids_and_clashing_counters(spark):
    docs = passages(spark)
    named = docs.withColumn("doc_id", F.format_string("d%05d", "doc_id")).withColumn("n_lines_removed", F.lit("mine"))
    out = line_dedup.dedup_passages(named, with_counters=False)
    assert out.columns == named.columns and {r["n_lines_removed"] for r in out.collect()} == {"mine"}
    want = {f"d{r['doc_id']:05d}": r["text"] for r in line_dedup.dedup_passages(docs).collect()}
    assert {r["doc_id"]: r["text"] for r in out.collect()} == want
    chunks = {f"d{r['doc_id']:05d}": r["text"] for r in line_dedup.dedup_lines(docs).collect()}
    assert {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(named).collect()} == chunks


def test_boundaries_are_those_of_a_plain_loop():
    rng = random.Random(21)
    text = "\n".join(prose(rng, rng.randint(1, 9)).replace("\n", "") for _ in range(200)).encode()
    data = np.frombuffer(text, np.uint8)
    docs, _, begins, stops = line_dedup.full_lines(data, np.array([0, len(data)]))
    h = tk.Hasher(data).spans(begins, stops)
    want, first = [], 0
    for k in range(len(h)):
        rolled = 0
        for j in range(line_dedup.WINDOW_LINES):
            rolled = (rolled * 0x9E3779B97F4A7C15 + (int(h[k - j]) if k >= j else 0)) % 2**64
        mixed = int(tk.mix(np.array([rolled], np.uint64))[0])
        if (mixed >> 32) % line_dedup.MEAN_LINES == 0 or k == len(h) - 1:
            if k > first and len(text[begins[first] : stops[k]]) >= line_dedup.MIN_BYTES:
                want.append((first, k))
            first = k + 1
    assert list(zip(*(x.tolist() for x in line_dedup.content_chunks(h, docs, begins, stops)))) == want


def test_repeats_with_string_ids(spark):
    docs = corpus(spark)
    named = docs.withColumn("doc_id", F.expr("IF(doc_id IS NULL, NULL, format_string('d%05d', doc_id))"))
    want = {tuple(r)[0]: tuple(r)[1:] for r in suffix_dedup.remove_repeats(docs).collect() if r["doc_id"] is not None}
    got = {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.remove_repeats(named).collect() if r["doc_id"] is not None}
    assert got == {f"d{i:05d}": v for i, v in want.items()}


def test_ids_with_a_common_factor_spread_over_groups(spark):
    ids = np.arange(0, 7_000_000, 7, dtype=np.int64) - 70_000
    group = suffix_dedup._group(ids, 7)
    sizes = np.bincount(group, minlength=7)
    assert sizes.max() < 1.1 * len(ids) / 7
    some = [*ids[:50].tolist(), -1, 2**62, -(2**62), 2**31 - 1]
    got = spark.createDataFrame([(i,) for i in some], "i long").select("i", suffix_dedup._group(F.col("i"), 7).alias("g")).collect()
    assert [r["g"] for r in got] == suffix_dedup._group(np.array([r["i"] for r in got]), 7).tolist()


@pytest.mark.parametrize("size", [50, 5_000, 32_768, 32_769, 60_000])
def test_lengths_of_runs_fit_their_integers(size):
    data = np.random.default_rng(size).integers(97, 123, 3 * size + 100).astype(np.uint8)
    *_, starts, ends = suffix_dedup.runs(data, np.array([0, len(data)]), size)
    assert len(starts) and (ends - starts).max() <= 2 * size <= np.iinfo(suffix_dedup._size_kind(size)).max + 1


def test_repeats_of_many_bytes(spark):
    """Windows of some thousand bytes, with what is left out of a passage at both ends."""
    rng = random.Random(23)
    passage = "".join(rng.choices("abcdefgh ", k=9_000))
    rows = [(1, "#" + passage), (2, passage[:2_900]), (3, "other #" + passage[1_000:8_000] + "# end"), (4, passage[100:9_000])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.remove_repeats(docs, min_bytes=3_000).collect()}
    assert got == {1: 0, 2: 0, 3: 7_000, 4: 8_900}
