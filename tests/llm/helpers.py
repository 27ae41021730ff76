"""Fixtures of the corpus operators: small documents with every awkward case."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Column names that operators use inside; as extra input columns they must not matter.
CLASHING = ["size", "target", "taken", "score", "h", "at", "cid", "node", "bucket", "g", "kept", "toxic", "quality", "sequence_id", "offset", "_shard", "_gone", "_mix_id", "id", "v", "rank"]
SYLLABLES = "ka lo mi tu re so na vi pe du cha fü éo ño".split()


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def prose(rng: random.Random, n: int) -> str:
    out = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n)]
    return " ".join(w + ("\n" if rng.random() < 0.1 else "") for w in out)


def corpus(spark, seed: int = 1, n: int = 60):
    """Prose with copies, near copies, shared passages, nulls, blanks, one long text, one repeated row."""
    rng = random.Random(seed)
    rows = [(i, prose(rng, rng.randint(1, 120)), "en", f"s{i % 4}", 1) for i in range(n)]
    base = prose(rng, 150)
    passage = "\n" + "\n".join(prose(rng, 12).replace("\n", "") for _ in range(6)) + "\n"
    for k in range(8):  # near copies
        w = base.split(" ")
        w[rng.randrange(len(w))] = f"edit{k}"
        rows.append((100 + k, " ".join(w), "en", "s0", 1))
    rows += [(120 + k, prose(rng, 30) + passage + prose(rng, 30), "de", "s1", 1) for k in range(5)]
    rows += [(130 + k, rows[3][1], "en", None, 1) for k in range(3)]  # exact copies
    rows += [(140, None, "en", "s2", 0), (141, "", None, "s2", 0), (142, " \n\t ", "en", "s3", 3), (143, "one", "en", "s3", 3), (144, "12 34 !!", "en", "s3", 3)]
    rows += [(150, prose(rng, 20_000), "fr", "s1", 1), (None, rows[5][1], "en", "s0", 1)]
    rows.append(rows[7])  # a repeated row
    return spark.createDataFrame(rows, SCHEMA)


def with_clashes(df):
    return df.withColumns({c: F.lit("x") for c in CLASHING})


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def same(a, b) -> bool:
    key = lambda df: sorted((tuple(map(str, r)) for r in df.collect()))
    return a.columns == b.columns and key(a) == key(b)
