"""The queries of this subpackage, next to their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cellmend.llm.common import importable

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: run(importable(spark), sf_dir)
        if oracle:
            ORACLES[name] = oracle.strip()
        return run
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op10_ngram_jaccard_join", """
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS sh FROM w),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS t FROM s),
p AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM e x JOIN e y ON x.t = y.t AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
r AS (
  WITH RECURSIVE walk(a, b) AS (SELECT a, b FROM p UNION SELECT walk.a, p.b FROM walk JOIN p ON walk.b = p.a)
  SELECT a, min(b) AS m FROM walk GROUP BY a)
SELECT doc_id, len(sh) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id
FROM s LEFT JOIN r ON doc_id = a
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    from cellmend.llm.ngram_join import ngram_jaccard_components
    return ngram_jaccard_components(table(spark, sf_dir, "documents"))


@query("op3_embedding_near_dedup", """
WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
p AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id
  WHERE list_cosine_similarity(x.e, y.e) >= 0.98),
r AS (
  WITH RECURSIVE walk(a, b) AS (SELECT a, b FROM p UNION SELECT walk.a, p.b FROM walk JOIN p ON walk.b = p.a)
  SELECT a, min(b) AS m FROM walk GROUP BY a),
n AS (SELECT a, count(*) AS n FROM p GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
FROM v LEFT JOIN r ON vec_id = r.a LEFT JOIN n ON vec_id = n.a
""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all vectors."""
    from cellmend.llm.vector_join import cosine_links
    return cosine_links(table(spark, sf_dir, "embeddings"))


@query("op5_best_fit_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    import public_tokenizers
    from cellmend.llm.packing import pack_documents
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op9_token_counts")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents."""
    import public_tokenizers
    from cellmend.llm.token_counts import count_tokens
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op4_source_mixing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of each document the mix takes."""
    from cellmend.llm.mixing import mix_sources
    return mix_sources(table(spark, sf_dir, "documents")).taken()


@query("op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents."""
    from cellmend.llm.toxicity import score_toxicity
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_quality_classifier")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents by the nearest labelled ones."""
    from cellmend.llm.quality_votes import score_quality
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: Stands for the secret key that an owner passes to ``pseudonymise``.
EXAMPLE_KEY = b"an example key, not a secret"


@query("op1_pii_pseudonyms")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their personal data replaced by pseudonyms."""
    from cellmend.llm.pii import pseudonymise
    return pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), EXAMPLE_KEY)


def _op2_oracle() -> str:
    from cellmend.llm.quality_rules import STOP_WORDS
    stops = ", ".join(f"'{w}'" for w in STOP_WORDS)
    space = r"[\x20\x09-\x0D]+"
    return rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, text, list_filter(regexp_split_to_array(text, '{space}'), lambda x: x <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    len(list_filter(regexp_split_to_array(translate(lower(text), '.,;:!?', '      '), '{space}'),
      lambda x: x IN ({stops}))) AS n_stop
  FROM t),
g AS (
  SELECT doc_id, unnest(range(1, len(words) - 3)) AS i,
    unnest(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) AS x
  FROM w WHERE len(words) >= 5),
d AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS n FROM g),
c AS (
  SELECT doc_id, sum(least(5, coalesce(after - i, 5))) AS n FROM (
    SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS after FROM d WHERE n > 1)
  GROUP BY doc_id),
m AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, n_stop, len(lines) AS n_lines,
    CAST(length(regexp_replace(text, '{space}', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN c ON w.doc_id = c.doc_id),
v AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    coalesce(word_chars / nullif(n_words, 0) BETWEEN 2.5 AND 12.0, false) AS ok_mean_word_length,
    coalesce(n_symbols / nullif(n_words, 0) <= 0.1, false) AS ok_symbol_ratio,
    coalesce(n_stop / nullif(n_words, 0) >= 0.04, false) AS ok_stop_word_ratio,
    coalesce(n_dup_lines / nullif(n_lines, 0) <= 0.35, false) AS ok_duplicate_line_ratio,
    coalesce(n_words / nullif(n_lines, 0) >= 1.5, false) AS ok_words_per_line
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND ok_mean_word_length AND ok_symbol_ratio AND ok_stop_word_ratio
    AND ok_duplicate_line_ratio AND ok_words_per_line AS kept,
  ok_mean_word_length, ok_symbol_ratio, ok_stop_word_ratio, ok_duplicate_line_ratio, ok_words_per_line
FROM v
"""


@query("op2_quality_rules", _op2_oracle())
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality measures and verdicts of all documents."""
    from cellmend.llm.quality_rules import quality_rules
    return quality_rules(table(spark, sf_dir, "documents"))


@query("op7_lm_scoring")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of all documents."""
    from cellmend.llm.suffix_tree_lm import score_texts
    return score_texts(table(spark, sf_dir, "documents"))


#: crc32 of the decimal id, modulo 9, in SQL.
_CRC9 = """
list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
  lambda crc, x: list_reduce(list_prepend(xor(crc, x), range(8)), lambda c, i: xor(c >> 1, 3988292384 * (c & 1))))
"""


@query("op11_conversation_trie", rf"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
    {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS x FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, list(x ORDER BY pos) AS own, xor({_CRC9}, 4294967295) % 9 AS h FROM t GROUP BY conv_id),
r AS (
  SELECT c.conv_id, list_concat(coalesce(b.own[1:c.h], []), c.own[c.h + 1:]) AS turns
  FROM c LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % 5),
p AS (SELECT conv_id, len(turns) AS n, unnest(range(0, len(turns) + 1)) AS depth, turns FROM r),
q AS (SELECT conv_id, n, depth, turns[1:depth] AS seq FROM p),
n AS (
  SELECT seq, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    (count(*) - 1) * coalesce(octet_length(encode(seq[depth].text)), 0) AS saved,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256
  FROM q GROUP BY seq, depth),
k AS (SELECT seq[1:depth - 1] AS seq, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1, 2),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k ON n.seq = k.seq AND n.depth = k.depth),
up AS (SELECT seq, unnest(range(0, depth + 1)) AS to_depth, saved, CAST(n_children = 0 AS INT) AS leaf FROM m),
s AS (SELECT seq[1:to_depth] AS seq, sum(saved) AS saved_tokens, sum(leaf) AS n_leaves FROM up GROUP BY 1)
SELECT m.conv_id, m.depth, p.conv_id AS parent_conv_id, m.n_convs, m.n_children,
  CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, m.ends_sha256
FROM m JOIN s ON m.seq = s.seq LEFT JOIN n p ON m.depth > 0 AND p.depth = m.depth - 1 AND p.seq = m.seq[1:m.depth - 1]
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of all rebuilt conversations."""
    from cellmend.llm.conversation_trie import prefix_trie
    return prefix_trie(table(spark, sf_dir, "conversations"))


@query("op12_hard_negatives", """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: coalesce(NOT isfinite(x), true))) = 0),
s AS (
  SELECT a.r AS a, b.r AS b, a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.r <> b.r),
p AS (
  SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.other_id AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.other_id) AS INT) AS rank,
  n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.a = p.a AND NOT n.same AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.other_id) <= 5
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector."""
    from pyspark.sql import functions as F
    from cellmend.llm.hard_negatives import mine_hard_negatives
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", label))


#: What both rows of the conversation with escapes say.
_MARKED = "\\### Assistant: </turn> ok"


def _op13_oracle() -> str:
    from cellmend.llm.chat_format import BUDGET, HISTORY, MARKS
    piece = ("length(regexp_replace(role, '([\\\\#<:])', '\\\\\\1', 'g'))"
             " + length(regexp_replace(text, '([\\\\#<])', '\\\\\\1', 'g')) + 14")
    return rf"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{_MARKED}' UNION ALL SELECT -7, 1, 'assistant', '{_MARKED}'),
t AS (
  SELECT conv_id, role, text, row_number() OVER o AS pos, {piece} AS chars,
    first_value(role) OVER o = 'system' AS has_system,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + {MARKS} AS cost
  FROM r WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST)),
s AS (
  SELECT *, sum(cost) OVER o AS until, greatest(1, floor(({BUDGET - HISTORY}
    - CASE WHEN has_system THEN first_value(cost) OVER o ELSE 0 END) / 2)) AS half
  FROM t WINDOW o AS (PARTITION BY conv_id ORDER BY pos)),
k AS (
  SELECT *, sum(CAST(cost > half AS INT)) OVER (PARTITION BY conv_id ORDER BY pos) AS n_large,
    CASE WHEN cost <= half THEN floor((until - cost) / half) END AS share FROM s),
w AS (
  SELECT conv_id, n_large, share, min(pos) AS first_pos, max(pos) AS last_pos, max(until) AS w_until
  FROM k GROUP BY ALL),
again AS (
  SELECT conv_id, sum(chars) AS chars FROM (
    SELECT k.conv_id, k.chars FROM k JOIN w ON k.conv_id = w.conv_id AND k.pos BETWEEN w.first_pos AND w.last_pos
    JOIN w v ON v.conv_id = w.conv_id AND v.first_pos = w.last_pos + 1
    WHERE w.w_until - (until - cost) <= {HISTORY} AND NOT (k.pos = 1 AND has_system)
    UNION ALL
    SELECT k.conv_id, k.chars FROM k JOIN w ON k.conv_id = w.conv_id AND w.first_pos > 1
    WHERE k.pos = 1 AND has_system)
  GROUP BY conv_id),
c AS (
  SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
    coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '') AS loss, sum(chars) AS chars
  FROM t GROUP BY conv_id)
SELECT c.conv_id, n_turns, turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
  CAST(c.chars + coalesce(again.chars, 0) AS BIGINT) AS formatted_chars
FROM c LEFT JOIN again ON again.conv_id IS NOT DISTINCT FROM c.conv_id
"""


@query("op13_chat_format", _op13_oracle())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one full of marks, read back from their training texts."""
    from pyspark.sql import functions as F
    from cellmend.llm.chat_format import format_chats, read_back
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(_MARKED).alias("text"))
    return read_back(format_chats(turns.unionByName(marked)))
