"""Registered queries of this package: each applies one operator, with production
parameters, to its whole table and derives the digest columns of its contract."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (language, line_dedup, mixing, neighbours, packing, prefix_trie, quality, simhash, token_counts, token_files, topk, toxicity,
               whitening)
from .common import crc_rest, table

WORD_VOCABULARY = "word_bpe_49k.json"
COUNT_VOCABULARY = "byte_bpe_50k.json"


def op1_simhash_vp_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and component."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learned from four fifths of the labelled ones."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(*toxicity.training_sample(docs, table(spark, sf_dir, "labels")))
    return toxicity.score(docs, model).select("doc_id", (crc_rest(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces with their sequence and place in it."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_VOCABULARY))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(COUNT_VOCABULARY), limit=512)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes every document's ids to Arrow files and reads them back."""
    docs = table(spark, sf_dir, "documents")
    manifest = token_files.write_token_files(docs, public_tokenizers.path(WORD_VOCABULARY))
    return token_files.read_token_files(spark, manifest, docs.schema["doc_id"].dataType)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's measures and verdict."""
    return quality.judge(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learned from two thirds of the labelled ones."""
    docs = table(spark, sf_dir, "documents")
    found = language.predict(docs, language.training_texts(language.learned_rows(docs)))
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that three or more documents share."""
    docs = table(spark, sf_dir, "documents")
    return line_dedup.digests(docs, line_dedup.keep_bitmaps(docs))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words that the mix takes of it."""
    plan = mixing.plan_mix(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def op10_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every vector whose id is divisible by 100."""
    return neighbours.search(table(spark, sf_dir, "embeddings"), asks=F.col("vec_id") % 100 == 0)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of rebuilt conversations."""
    return prefix_trie.build(table(spark, sf_dir, "conversations"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's first eight whitened components."""
    vectors = table(spark, sf_dir, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors))


def op13_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest inner products of every vector whose id is divisible by 50."""
    return topk.search(table(spark, sf_dir, "embeddings"), asks=F.col("vec_id") % 50 == 0)


QUERIES = {f.__name__: f for f in (op1_simhash_vp_trees, op2_toxicity, op3_best_fit_packing, op4_token_counts, op5_quality_rules, op6_language_id, op7_line_dedup, op8_source_mix, op9_token_files, op10_hilbert_neighbours,
                                   op11_prefix_trie, op12_whitening, op13_exact_topk)}

#: Lines as the contract of operator 7 describes them; chr(9..13) and the space are its white space.
_STRIP = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP7_SQL = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT *, {_LOWER.format(f"trim(line, {_STRIP})")} AS key FROM l),
g AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines,
       CAST(count(*) FILTER (WHERE keeper IS NOT NULL AND doc_id <> keeper) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE keeper IS NULL OR doc_id = keeper), '')) AS kept_sha256
FROM k LEFT JOIN g USING (key) GROUP BY doc_id"""

#: Words, lines and 5-word windows of operator 5, and its rules.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
OP5_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS words FROM documents),
w AS (SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS win
      FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 4)) AS i FROM d)),
r AS (SELECT doc_id, i FROM w QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
c AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + 4)) AS p FROM r) GROUP BY doc_id),
l AS (SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
      WHERE length(trim(line, {_STRIP})) > 0),
n AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS dups,
             count(*) FILTER (WHERE regexp_matches(line, '(\.\.\.|…)[\x20\x09]*$')) AS ends,
             count(*) FILTER (WHERE regexp_matches(line, '^[\x20\x09]*[-*•]')) AS bullets FROM l GROUP BY doc_id),
m AS (SELECT d.doc_id, text, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
             CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
             CAST(coalesce(dups, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
             coalesce(n_lines, 0) AS n_lines, coalesce(ends, 0) AS ends, coalesce(bullets, 0) AS bullets,
             length(regexp_replace(text, '[^\p{{L}}]+', '', 'g')) AS letters
      FROM d LEFT JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 2 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_lines OR word_chars < 2 * n_words
            OR word_chars > 25 * n_words OR 2 * letters < word_chars OR 10 * ends > 3 * n_lines OR 10 * bullets > 9 * n_lines) AS kept
FROM b"""

#: CRC-32 of the decimal id, bit by bit: a code point is mixed in, each -1 shifts once.
_CRC = """(SELECT xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
       lambda c: list_prepend(CAST(ascii(c) AS BIGINT), list_resize(CAST([] AS BIGINT[]), 8, CAST(-1 AS BIGINT)))))),
       lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295::BIGINT))"""
#: Operator 11: a node is a path, the MD5 digests of its turns one after another.
OP11_SQL = f"""
WITH t AS (SELECT conv_id, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS sym, length(coalesce(text, '')) AS chars,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sym, chars) AS pos
           FROM conversations WHERE conv_id IS NOT NULL),
h AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {_CRC} % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)),
s AS (SELECT h.conv_id, pos, sym, chars FROM h JOIN t ON t.conv_id = h.base AND pos <= h.h
      UNION ALL SELECT h.conv_id, pos, sym, chars FROM h JOIN t ON t.conv_id = h.conv_id AND pos > h.h),
p AS (SELECT conv_id, row_number() OVER w AS depth, string_agg(sym, '') OVER w AS path, chars FROM s WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
a AS (SELECT conv_id, depth, path, chars FROM p UNION ALL SELECT conv_id, 0, '', 0 FROM h),
n AS (SELECT path, min(conv_id) AS conv_id, max(depth) AS depth, count(*) AS n, max(chars) AS chars FROM a GROUP BY path),
c AS (SELECT left(path, len(path) - 32) AS path, count(*) AS n FROM n WHERE depth > 0 GROUP BY 1),
v AS (SELECT n.*, coalesce(c.n, 0) AS n_children, (n.n - 1) * n.chars AS own FROM n LEFT JOIN c USING (path)),
u AS (SELECT left(path, 32 * k) AS path, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(own) AS saved
      FROM (SELECT *, unnest(generate_series(0, depth)) AS k FROM v) GROUP BY 1),
e AS (SELECT path, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends
      FROM (SELECT conv_id, arg_max(path, depth) AS path FROM a GROUP BY conv_id) GROUP BY path)
SELECT v.conv_id, v.depth, CASE WHEN v.depth > 0 THEN up.conv_id END AS parent_conv_id, v.n AS n_convs, v.n_children, n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM v JOIN u USING (path) LEFT JOIN e USING (path) LEFT JOIN n up ON up.path = left(v.path, greatest(len(v.path) - 32, 0))"""

#: Operator 13: every query with every other vector of its length.
OP13_SQL = """
WITH v AS (SELECT CAST(vec_id AS BIGINT) AS vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS x FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.x) = len(q.x) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM p QUALIFY rank <= 5"""

ORACLE_SQL: dict[str, str] = {"op5_quality_rules": OP5_SQL, "op7_line_dedup": OP7_SQL, "op11_prefix_trie": OP11_SQL, "op13_exact_topk": OP13_SQL}
