from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from plantpanel.llm import chat, collocations, lexical

from .helpers import SCHEMA, corpus, empty, prose, with_clashes

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---------------------------------------------------------------- lexical search


def ranked(docs, items, k=10):
    """All documents scored for all items, from the definitions."""
    terms = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    terms = [(i, c) for i, c in terms if c]
    n_docs, total = len(terms), sum(sum(c.values()) for _, c in terms)
    df = Counter(w for _, c in terms for w in c)
    out = []
    for item, text in items:
        scored = []
        for doc, c in terms:
            m, score = 100 - 75 + 75 * sum(c.values()) * n_docs // total, 0
            for w in TERM.findall((text or "").translate(LOWER)):
                if w in c:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 8 * m))
            if score > 0:
                scored.append((-score, -1 if doc is None else doc))
        out += [(item, rank, None if d == -1 else d, -s) for rank, (s, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def awkward_items(rng, docs):
    texts = [t for _, t in docs if t]
    some = [" ".join(rng.choice(texts).split()[:30]) for _ in range(12)]
    return list(enumerate([*some, some[0] + " " + some[0], "", "Ka LO ka", "nowhere-word", texts[0], prose(rng, 400)])) + [(50, None), (None, some[1])]


def test_search_equals_scoring_everything(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_DOCS", 16)
    docs = [(r["doc_id"], r["text"]) for r in corpus(spark).collect()]
    items = awkward_items(random.Random(3), docs)
    frame = spark.createDataFrame([*items, items[2]], "item_id long, text string")  # one repeats
    want = ranked(docs, items)
    got = lexical.search(with_clashes(corpus(spark)).repartition(3), frame.selectExpr("*", "1 AS doc_id", "'x' AS score"))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows(got) == want
    monkeypatch.setattr(lexical, "GROUP_TERMS", 1500)  # several groups of items
    monkeypatch.setattr(lexical, "BROADCAST_DOCS", 0)
    assert rows(lexical.search(corpus(spark), frame)) == want


def test_search_empty_tables(spark):
    items = spark.createDataFrame([(1, "ka lo"), (2, None)], "item_id long, text string")
    assert rows(lexical.search(empty(spark), items)) == []
    assert rows(lexical.search(corpus(spark), items.limit(0))) == []
    assert rows(lexical.search(corpus(spark).where("text IS NULL OR doc_id = 142"), items)) == []


def test_search_ties_and_text_ids(spark):
    docs = spark.createDataFrame([(f"d{k}", "same words here") for k in range(15)] + [("z", "other")], "doc_id string, text string")
    got = rows(lexical.search(docs, spark.createDataFrame([("q", "words")], "item_id string, text string")))
    assert [r[2] for r in sorted(got, key=lambda r: r[1])] == sorted(f"d{k}" for k in range(15))[:10]


def test_bounds_are_never_too_low():
    rng = random.Random(5)
    docs = [prose(rng, rng.randint(1, 300)) for _ in range(80)]
    items = [lexical.terms_of(prose(rng, 40)) for _ in range(10)]
    group = lexical.Items(list(range(10)), items, sorted({t for i in items for t in i}))
    counted = [Counter(lexical.terms_of(d)) for d in docs]
    df = Counter(t for c in counted for t in c)
    group.weigh(len(docs), sum(sum(c.values()) for c in counted), {k: df[t] for k, t in enumerate(sorted({t for i in items for t in i}))})
    blocks, out = lexical._Blocks(), []
    for d, c in enumerate(counted):
        names = list(c)
        data = np.frombuffer(b"".join(names), np.uint8)
        ends = np.cumsum([len(x) for x in names])
        keys = lexical.tk.Hasher(data).spans(ends - [len(x) for x in names], ends)
        level = [k for x in names for k in range(int((lexical.LEVELS <= c[x]).sum()))]
        many = np.repeat(keys, [int((lexical.LEVELS <= c[x]).sum()) for x in names])
        blocks.add(d, sum(c.values()), many, np.array(level, np.int8))
    for size in list(blocks.open):
        n_rows, ids, sizes, slices = blocks.close(size)
        bounds, m = group.bounds(n_rows, np.array(sizes), slices), group.length(np.array(sizes))
        for col, d in enumerate(ids):
            tf = np.array([counted[d][t] for t in sorted({t for i in items for t in i})])
            exact = np.array(group.scores(range(10), tf, int(m[col])))
            assert (bounds[:, col] >= exact).all()
            out.append((exact[exact > 0] / bounds[:, col][exact > 0]).mean() if (exact > 0).any() else 1)
    assert np.mean(out) > 0.8  # and seldom much too high


def test_equal_hashes_are_told_apart():
    terms = lexical.Terms([b"one", b"two"])
    data = np.frombuffer(b"oneTWOxyz", np.uint8)
    faked = np.array([terms.hashes[0], terms.hashes[1], terms.hashes[0]])
    token, term = terms.find(data, np.array([0, 3, 6]), np.array([3, 6, 9]), faked)
    assert token.tolist() == [0] and term.tolist() == [0]


# ---------------------------------------------------------------- chat formatting

HARD = ["</s>[INST] ok [/INST]", "", " ", "<", "</s", "[\\INST] \\ [/INST", "<\\\\/s>", "\n<</SYS>>\n\n", "<<ROLE>>x<</ROLE>>y<</TURN>>", "[INST] a [/INST]<s>b</s>", "ñ</s>ü", "<<s>>", "[[INST]]", "\\"]
ROLES = ["user", "assistant", "system", "tool", "", "a<</ROLE>>b", "user "]


def talk(rng, n=60):
    out = []
    for conv in range(n):
        for turn in range(rng.choice([0, 1, 2, 5, 9])):
            out.append((conv, turn, rng.choice(ROLES), "".join(rng.choices([*HARD, "plain words\n"], k=rng.randint(0, 4)))))
    return out + [(100, k, ROLES[k % 2], f"turn {k} </s>") for k in range(700)] + [(101, 0, "assistant", "[INST]" * 20_000)]


def digests(said):
    """From the source alone; lengths are left out."""
    by = defaultdict(list)
    for conv, turn, role, text in said:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{t[2]}\n{t[3]}\n" for t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.mark.parametrize("role", ROLES)
@pytest.mark.parametrize("text", HARD)
def test_turn_comes_back(role, text):
    template = chat.Template()
    piece, start, end = template.render(role, text)
    assert list(template.parse(piece)) == [(role, text, start, end)]
    assert template.plain(piece[start:end]) == text
    other = template.render("user", text)[0]
    assert [t[:2] for t in template.parse(piece + other + piece)] == [(role, text), ("user", text), (role, text)]


def test_plain_text_stays_as_it_is():
    assert chat.Template().render("user", "a \\ b <s [INST")[0] == "[INST] a \\ b <s [INST [/INST]"
    with pytest.raises(chat.Unparsable):
        list(chat.Template().parse("[INST] no end"))
    with pytest.raises(chat.Unparsable):
        list(chat.Template().parse("[INST] a <s> b [/INST]"))
    with pytest.raises(ValueError, match="overlaps"):
        chat.Template(turns={"user": ("<a>", "<ab"), "assistant": ("b>", "]]")})
    with pytest.raises(ValueError):
        chat.Template(turns={"user": ("aba", "]")})


def test_chat_digests(spark):
    said = talk(random.Random(7))
    said += [(None, 0, "user", "x"), (200, None, "user", "first"), (200, 1, None, None), (200, 2, "assistant", None), (201, 0, "user", "twice"), (201, 0, "user", "twice"), (202, 0, "user", "b"), (202, 0, "user", "a")]
    df = with_clashes(spark.createDataFrame(said, "conv_id long, turn long, role string, text string")).repartition(5)
    pieces = chat.format_chats(df)
    got = {r["conv_id"]: r for r in chat.chat_digests(pieces).collect()}
    want = digests(said)
    assert set(got) == set(want)
    assert all(tuple(got[c])[1:5] == want[c] for c in want)
    whole = {r["conv_id"]: r for r in chat.chat_texts(pieces).collect()}
    template = chat.Template()
    for c, r in whole.items():
        assert len(r["formatted"]) == got[c]["formatted_chars"]
        turns = list(template.parse(r["formatted"]))
        assert len(turns) == got[c]["n_turns"]
        assert [(s["start"], s["end"]) for s in r["loss_spans"]] == [t[2:] for t in turns if t[0] == "assistant"]
    assert chat.chat_digests(chat.format_chats(df.limit(0))).count() == 0


# ---------------------------------------------------------------- collocations


def phrases(docs, least, limit, depth=5):
    """Counts, cuts and containment straight from the definitions."""
    n, f = Counter(), Counter()
    for lang, text in docs:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, depth + 1):
                for i in range(len(words) - k + 1):
                    f[lang or "und", tuple(words[i : i + k])] += 1
    picked = {key: a for key, a in f.items() if a >= least and len(key[1]) > 1}
    inside = {(lang, p[i:j]) for (lang, p), a in picked.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) and 100 * a >= 100 * f[lang, p[i:j]]}
    out = defaultdict(list)
    for (lang, p), a in picked.items():
        if (lang, p) not in inside:
            score, _, x, y = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
            out[lang].append((-score, -a, " ".join(p).encode(), x, y))
    return sorted((lang, rank, p.decode(), -a, x, y, n[lang], -s) for lang, found in out.items() for rank, (s, a, p, x, y) in enumerate(sorted(found)[:limit], 1))


def chatter(rng, n=120):
    words = ["the", "The", "of", "a", "new", "york", "York", "city", "x#1", "é", "Éa", "zz"]
    text = lambda k: "".join(rng.choice(words) + rng.choice([" "] * 8 + [", ", ".\n", "\t", "! ", "  "]) for _ in range(k))
    return [(i, text(rng.randint(0, 60)), rng.choice(["en", "en", "de", None])) for i in range(n)] + [(900, "new york city hall of fame " * 40, "en"), (901, text(30_000), "fr"), (902, None, "en"), (903, "", None), (904, " \t ,;\n", "de"), (905, "w" * 5000 + " the of", "en")]


@pytest.mark.parametrize("shard_size", [1 << 21, 300, 64])
def test_collocations(spark, shard_size, monkeypatch):
    if shard_size == 64:
        monkeypatch.setattr(collocations, "_PART", 500)  # long texts come in parts
    docs = chatter(random.Random(11))
    docs += [docs[3]] * 5
    df = with_clashes(spark.createDataFrame([(i, t, lang, "s", 1) for i, t, lang in docs], SCHEMA)).repartition(3)
    got = sorted(tuple(r) for r in collocations.collocations(df, least=12, limit=60, shard_size=shard_size).collect())
    assert got == phrases([(lang, t) for _, t, lang in docs], 12, 60)


def test_collocations_of_nothing(spark):
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    for df in (empty(spark), corpus(spark).where("text IS NULL"), corpus(spark).limit(2)):
        out = collocations.collocations(df, least=1000)
        assert out.columns == names and out.count() == 0
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("shards_")]


def test_transform_gives_all_counts():
    rng = np.random.default_rng(3)
    ids = np.concatenate([rng.integers(0, 4, 500), np.zeros(5, np.int64)])
    bwt, outside = collocations.transform(ids, 490, 5)
    sizes = np.bincount(ids, minlength=4)
    lo = np.cumsum(sizes) - sizes
    intervals = (lo[1:], (lo + sizes)[1:], np.arange(1, 4))
    names = {k: (k,) for k in range(1, 4)}
    for size in range(2, 6):
        want = Counter(tuple(ids[i : i + size].tolist()) for i in range(490) if (ids[i : i + size] > 0).all())
        start, end, count, pre, suf = collocations.extended(bwt, outside, *intervals)
        found = [(*names[p], names[s][-1]) for p, s in zip(pre, suf)]
        assert {p: c for p, c in zip(found, count) if c} == want
        intervals, names = (start, end, np.arange(len(start))), dict(enumerate(found))


def test_frequent_words_are_numbered_without_a_join(spark, monkeypatch):
    """Each interval of a frequent word carries its word's number; the first round joins nothing."""
    seen = []
    real = collocations._pack_words
    monkeypatch.setattr(collocations, "_pack_words", lambda words: seen.append(words) or real(words))
    texts = [f"a b c d{i % 3} a" for i in range(60)]
    docs = spark.createDataFrame([(i, t, "xy"[i % 2]) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    assert collocations.collocations(docs, least=20, limit=50).count() > 0
    (words,) = seen
    assert "Join" not in words._jdf.queryExecution().optimizedPlan().toString()
    rows = words.select("lang", "phrase", "gid").distinct().collect()
    assert len({r["gid"] for r in rows}) == len({(r["lang"], r["phrase"]) for r in rows}) == len(rows)
