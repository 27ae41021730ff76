"""Queries of the corpus operators, with production parameters on whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .chat import OTHER, TURNS, Template, chat_digests, format_chats
from .collocations import collocations
from .common import table
from .jaccard_join import near_duplicates
from .language import identify_languages
from .lexical import search
from .line_dedup import line_dedup_digest
from .mixing import mix_sources
from .neighbours import nearest
from .packing import pack_documents
from .quality import score_documents
from .suffix_dedup import remove_repeats
from .token_counts import count_tokens
from .toxicity import score_toxicity


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup_digest(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    return chat_digests(format_chats(said.unionByName(spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], said.schema))))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_mix_sources,
            op2_language_id,
            op3_quality_rules,
            op4_line_dedup,
            op5_toxicity,
            op6_best_fit_packing,
            op7_jaccard_join,
            op8_token_counts,
            op9_suffix_array_dedup,
            op10_nearest_neighbours,
            op11_lexical_search,
            op12_chat_format,
            op13_collocations,
            pipeline,
        )
    }


#: Links between distinct texts by brute force, groups by reachability.
_OP7 = r"""
WITH RECURSIVE d AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM documents),
t AS (SELECT min(doc_id) AS id, text, any_value(w) AS w FROM d WHERE len(w) > 0 GROUP BY text),
s AS (SELECT DISTINCT id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM t),
n AS (SELECT id, count(*) AS n, md5(string_agg(g, '|' ORDER BY g)) AS key FROM s GROUP BY id),
c AS (SELECT a.id AS a, b.id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.id <> b.id GROUP BY ALL),
e AS (SELECT a, b FROM c JOIN n x ON x.id = a JOIN n y ON y.id = b WHERE 10 * k >= 8 * (x.n + y.n - k)),
r(id, root) AS (SELECT id, id FROM n UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id),
g AS (SELECT id, min(root) AS class_id FROM r GROUP BY id),
l AS (SELECT a AS id, count(*) AS n_links FROM e GROUP BY a),
m AS (SELECT key, min(id) AS copy_id FROM n GROUP BY key)
SELECT d.doc_id, coalesce(g.class_id, d.doc_id) AS class_id, coalesce(m.copy_id, d.doc_id) AS copy_id, coalesce(l.n_links, 0) AS n_links
FROM d LEFT JOIN t ON d.text = t.text LEFT JOIN n ON n.id = t.id LEFT JOIN g ON g.id = t.id LEFT JOIN l ON l.id = t.id LEFT JOIN m ON m.key = n.key"""

_OP10 = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE list_sum(list_transform(embedding, lambda x: abs(x))) > 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.e, v.e) AS score FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 20 = 0),
k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM k WHERE rank <= 20"""


#: Terms, statistics and integer scores straight from their definitions.
_OP11 = r"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM documents),
q AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM benchmark),
n AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
g AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM n),
m AS (SELECT doc_id, 25 + ((75 * n * nn) // ll) AS m FROM n, g),
f AS (SELECT doc_id, w, count(*) AS tf FROM t GROUP BY ALL),
d AS (SELECT w, CAST(floor(1000 * ln((2 * any_value(nn) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS weight FROM f, g GROUP BY w),
s AS (SELECT item_id, doc_id, CAST(sum(k * weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM (SELECT item_id, w, count(*) AS k FROM q GROUP BY ALL) JOIN f USING (w) JOIN d USING (w) JOIN m USING (doc_id) GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10"""


def _chat_sql() -> str:
    """Digests from the source; the length also counts the marks and one sign for each mark inside a text."""
    mark = Template().mark.pattern
    own = " ".join(f"WHEN role = '{r}' THEN {len(a) + len(b)}" for r, (a, b) in TURNS.items())
    return f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
l AS (SELECT *, length(text) + len(regexp_extract_all(text, '{mark}')) + CASE {own}
  ELSE {sum(map(len, OTHER))} + length(role) + len(regexp_extract_all(role, '{mark}')) END AS n FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256, CAST(sum(n) AS BIGINT) AS formatted_chars
FROM l GROUP BY conv_id"""


#: Phrases counted one by one, lengths 1 to 5, then cuts and containment by joins.
_OP13 = r"""
WITH p AS (SELECT doc_id, row_number() OVER () AS row, coalesce(lang, 'und') AS lang, unnest(string_split_regex(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
t AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, w[i:i + k - 1] AS g, k FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, 6) AS r(k))),
f AS (SELECT lang, g, k, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT f.lang, f.g, f.k, f.a, unnest(range(1, f.k)) AS cut FROM f WHERE f.k >= 2),
s AS (SELECT c.*, x.a AS l, y.a AS r, n, (CAST(1000 AS HUGEINT) * c.a * n) // (CAST(x.a AS HUGEINT) * y.a) AS score
  FROM c JOIN f x ON x.lang = c.lang AND x.g = c.g[1:cut] JOIN f y ON y.lang = c.lang AND y.g = c.g[cut + 1:c.k] JOIN t ON t.lang = c.lang),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) AS pick FROM s),
o AS (SELECT lang, g[1:k - 1] AS g, max(a) AS a FROM f WHERE k > 2 GROUP BY ALL UNION ALL SELECT lang, g[2:k] AS g, max(a) AS a FROM f WHERE k > 2 GROUP BY ALL),
z AS (SELECT b.* FROM b WHERE pick = 1 AND NOT EXISTS (SELECT 1 FROM o WHERE o.lang = b.lang AND o.g = b.g AND o.a >= b.a)),
e AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM z)
SELECT lang, CAST(rank AS INTEGER) AS rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM e) WHERE rank <= 2000"""


def oracle_sql() -> dict[str, str]:
    """SQL for the operators that it can express in time; the others are tested by brute force."""
    return {
        "op7_jaccard_join": _OP7,
        "op10_nearest_neighbours": _OP10,
        "op11_lexical_search": _OP11,
        "op12_chat_format": _chat_sql(),
        "op13_collocations": _OP13,
    }
