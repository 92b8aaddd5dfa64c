"""The registered corpus queries and, where SQL can express them, their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adyield.llm import (alignment, ann, conversations, exact_topk, language_id, licences, mixing, near_dedup, packing, suffix_dedup,
                         toxicity, unit_dedup, url_filter)
from adyield.llm.licence_texts import known_texts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


ORACLES["op2_minhash_near_dedup"] = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) < 2 THEN CASE WHEN len(w) = 1 THEN [w[1]] ELSE [] END
         ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS items
  FROM words),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_shared
  FROM (SELECT doc_id, unnest(items) AS item FROM sets) a JOIN (SELECT doc_id, unnest(items) AS item FROM sets) b
    ON a.item = b.item AND a.doc_id <> b.doc_id
  GROUP BY ALL),
links AS (
  SELECT x, y FROM pairs JOIN sets a ON a.doc_id = x JOIN sets b ON b.doc_id = y
  WHERE 100 * n_shared >= 80 * (len(a.items) + len(b.items) - n_shared)),
reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, y FROM reached r JOIN links ON r.other = x)
SELECT s.doc_id, CAST(len(s.items) AS BIGINT) AS n_shingles, min(r.other) AS component_id, s.doc_id = min(r.other) AS kept
FROM sets s JOIN reached r ON r.doc_id = s.doc_id
GROUP BY s.doc_id, s.items"""


#: Words of a passage that op9 counts, where it stands elsewhere too.
COUNTED_WORDS = 51


@query
def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Beside what is removed, n_passages: stretches of runs of 51 words that stand anywhere else, however few bytes they have."""
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), words=COUNTED_WORDS, cut_words=False)
    text = F.make_valid_utf8(F.col("kept").cast("string"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), text.alias("text"),
                        F.size("passages").cast("long").alias("n_passages"))


@query
def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=2)


def held_out():
    """Whether a document's checksum keeps it out of training."""
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def learned(docs: DataFrame) -> list[tuple[str, int, int]]:
    """Language profiles from the documents that are not held out; as many rows as profiles hold."""
    training = docs.filter(F.coalesce(~held_out(), F.lit(True)))
    return [tuple(row) for row in language_id.learn_profiles(training).collect()]


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, learned(docs))
    return found.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")


@query
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


#: Repeated lines are a passage where a run of them has as many words.
PASSAGE_WORDS = 20


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans as text: start:end of each removed line, in characters, apart by blanks."""
    found = unit_dedup.remove_repeated_units(table(spark, sf_dir, "documents"), least_words=PASSAGE_WORDS)
    spans = F.transform("removed", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string")))
    return found.select("doc_id", "n_units", "n_repeated", "n_removed", "n_chars_removed", F.concat_ws(" ", spans).alias("removed_spans"))


ORACLES["op3_line_dedup"] = f"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(l, 1) AS unit, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
placed AS (
  SELECT *, CAST(coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY unit
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start,
         trim(regexp_replace(lower(line), '\\s+', ' ', 'g')) AS plain
  FROM lines),
judged AS (
  SELECT *, plain <> '' AND row_number() OVER (PARTITION BY plain ORDER BY doc_id, unit) > 1 AS again FROM placed),
runs AS (
  SELECT *, count(*) FILTER (plain <> '' AND NOT again) OVER (PARTITION BY doc_id ORDER BY unit) AS run FROM judged),
sized AS (
  SELECT *, again AND sum(len(string_split(plain, ' '))) FILTER (again) OVER (PARTITION BY doc_id, run) >= {PASSAGE_WORDS} AS gone FROM runs)
SELECT doc_id, count(*) AS n_units, count(*) FILTER (again) AS n_repeated, count(*) FILTER (gone) AS n_removed,
       CAST(coalesce(sum(length(line)) FILTER (gone), 0) AS BIGINT) AS n_chars_removed,
       coalesce(string_agg(start || ':' || (start + length(line)), ' ' ORDER BY unit) FILTER (gone), '') AS removed_spans
FROM sized GROUP BY doc_id"""


@query
def op4_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(table(spark, sf_dir, "documents"), licences.known_licences(spark))
    return found.withColumn("notices", F.concat_ws(",", "notices"))


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# the operator's notice lines without a look-ahead: a line goes if it matches the first, or the second and not the third
_NOTICE_LINE = r"^[^\p{L}\p{N}]*(copyright\b[^\p{L}\p{N}]*(©|\p{N})|\(c\)[^\S\n]*(copyright\b|\p{N})|©)"
_HOLDER_LINE = r"^[^\p{L}\p{N}]*copyright\b[^\p{L}\p{N}]*\p{L}"
_PROSE_LINE = r"^[^\p{L}\p{N}]*copyright\b[^\p{L}\p{N}]*(" + "|".join(licences._PROSE) + r")\b"


def _canonical_sql(text: str) -> str:
    notice = (f"regexp_matches(l, {_literal(_NOTICE_LINE)}) OR (regexp_matches(l, {_literal(_HOLDER_LINE)}) "
              f"AND NOT regexp_matches(l, {_literal(_PROSE_LINE)}))")
    bare = f"array_to_string(list_filter(string_split(lower({text}), chr(10)), lambda l: NOT ({notice})), chr(10))"
    words = f"trim(regexp_replace({bare}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
    for odd, usual in sorted(licences.SPELLINGS.items(), key=lambda pair: " " in pair[0]):
        words = f"regexp_replace({words}, '\\b{odd}\\b', '{usual}', 'g')"
    return words


_RESERVED = "All rights reserved.\n\n"
_KNOWN_SQL = ", ".join(f"({_literal(name)}, {_literal(text)})" for name, wordings in known_texts().items() for text in wordings
                       if not text.startswith(_RESERVED))
ORACLES["op4_licence_scan"] = f"""
WITH known AS (
  SELECT md5({_canonical_sql('body')}) AS digest, min(name) AS licence FROM (
    SELECT name, unnest(CASE WHEN contains(body, chr(10)) THEN [body, {_literal(_RESERVED)} || body] ELSE [body] END) AS body
    FROM (VALUES {_KNOWN_SQL}) AS t(name, body)) GROUP BY 1),
whole AS (
  SELECT doc_id, {_canonical_sql('text')} AS plain FROM documents),
lines AS (
  SELECT doc_id, {_canonical_sql('line')} AS plain
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)),
notices AS (
  SELECT doc_id, string_agg(DISTINCT licence, ',' ORDER BY licence) AS notices
  FROM lines JOIN known ON plain <> '' AND md5(plain) = digest GROUP BY doc_id)
SELECT whole.doc_id, CASE WHEN plain <> '' THEN md5(plain) END AS digest, licence, coalesce(notices, '') AS notices
FROM whole LEFT JOIN known ON plain <> '' AND md5(plain) = known.digest LEFT JOIN notices ON notices.doc_id = whole.doc_id"""


@query
def op6_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole corpus, sources weighted by the square root of their size, about as many bytes as before."""
    return mixing.mix(table(spark, sf_dir, "documents"))


ORACLES["op6_poisson_mixing"] = """
WITH sizes AS (
  SELECT source, CAST(sum(strlen(text)) AS DOUBLE) AS size FROM documents GROUP BY source),
rates AS (
  SELECT source, sqrt(size) * (sum(size) OVER () / sum(sqrt(size)) OVER ()) / size AS rate FROM sizes WHERE size > 0),
sums AS (
  SELECT source, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS upto
  FROM rates, range(0, 60) AS t(k)),
drawn AS (
  SELECT d.doc_id, d.source, ('0x' || substr(md5('0:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 13))::BIGINT / 4503599627370496.0 AS u
  FROM documents d),
counted AS (
  SELECT doc_id, CAST(count(*) AS INTEGER) AS n FROM drawn JOIN sums ON drawn.source IS NOT DISTINCT FROM sums.source AND upto <= u
  GROUP BY doc_id)
SELECT d.*, CAST(c.copy AS INTEGER) AS copy, md5('0:' || coalesce(CAST(d.doc_id AS VARCHAR), '') || ':' || c.copy) AS place
FROM documents d JOIN (SELECT doc_id, unnest(range(1, n + 1)) AS copy FROM counted) c ON c.doc_id = d.doc_id"""


@query
def op5_cross_polytope_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


@query
def op7_histogram_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


ORACLES["op7_histogram_top_k"] = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scored)
SELECT * FROM ranked WHERE rank <= 5"""


# The rules this query is asked to apply.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


@query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES).drop("words")


@query
def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.agreement(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                               public_tokenizers.path("piece_bpe_32k.model"))


@query
def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of the documents that is held out is neither learned from nor counted."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = toxicity.learn(docs.filter(~out), labels.filter(~out))
    return toxicity.score(docs, model).select("doc_id", out.alias("held_out"), "score", "predicted", F.concat_ws(", ", "voters").alias("voters"))


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.audit_damaged(table(spark, sf_dir, "conversations"))


ORACLES["op11_conversation_repair"] = r"""
WITH RECURSIVE plain AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations),
drawn AS (
  SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(0, 8 * length(key)),
         lambda i: CAST((ascii(substr(key, CAST(i // 8 + 1 AS INTEGER), 1)) >> CAST(i % 8 AS INTEGER)) & 1 AS BIGINT))),
         lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295) % 20 AS kind
  FROM plain),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM drawn, range(0, 2) AS t(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
judged AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
         lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair
  FROM placed),
rows AS (
  SELECT conv_id, i, chr(10) || role || ':' || text AS said, chr(10) || 'user:' || text AS as_u, chr(10) || 'assistant:' || text AS as_a,
         CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS x, CASE WHEN fault IN ('blank', 'duplicate') THEN 1000000000 ELSE 0 END AS no,
         CASE WHEN role[1] = 's' THEN 0 ELSE 1000000000 END AS not_s, CASE WHEN role[1] = 'u' THEN 0 ELSE 1000000000 END AS not_u,
         CASE WHEN role[1] = 'a' THEN 0 ELSE 1000000000 END AS not_a
  FROM judged),
states AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, {'c': CAST(0 AS BIGINT), 'p': '', 't': ''} AS n,
         {'c': CAST(1000000000 AS BIGINT), 'p': '', 't': ''} AS s, {'c': CAST(3 AS BIGINT), 'p': 'I', 't': chr(10) || 'user:'} AS u,
         {'c': CAST(6 AS BIGINT), 'p': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'} AS a
  FROM placed
  UNION ALL
  SELECT conv_id, i, n, s, u, list_min([a, {'c': u.c + 3, 'p': u.p || 'I', 't': u.t || chr(10) || 'assistant:'}]) AS a
  FROM (
    SELECT conv_id, i, n, s, a, list_min([u, {'c': n.c + 3, 'p': n.p || 'I', 't': n.t || chr(10) || 'user:'},
           {'c': s.c + 3, 'p': s.p || 'I', 't': s.t || chr(10) || 'user:'}, {'c': a.c + 3, 'p': a.p || 'I', 't': a.t || chr(10) || 'user:'}]) AS u
    FROM (
      SELECT v.conv_id, r.i, {'c': n.c + 4, 'p': n.p || 'D', 't': n.t} AS n,
             list_min([{'c': s.c + 4, 'p': s.p || 'D', 't': s.t}, {'c': n.c + x + no + not_s, 'p': n.p || 'K', 't': n.t || said}]) AS s,
             list_min([{'c': u.c + 4, 'p': u.p || 'D', 't': u.t}, {'c': n.c + x + no + not_u, 'p': n.p || 'K', 't': n.t || said},
               {'c': s.c + x + no + not_u, 'p': s.p || 'K', 't': s.t || said}, {'c': a.c + x + no + not_u, 'p': a.p || 'K', 't': a.t || said},
               {'c': n.c + x + no + 3, 'p': n.p || 'R', 't': n.t || as_u}, {'c': s.c + x + no + 3, 'p': s.p || 'R', 't': s.t || as_u},
               {'c': a.c + x + no + 3, 'p': a.p || 'R', 't': a.t || as_u}]) AS u,
             list_min([{'c': a.c + 4, 'p': a.p || 'D', 't': a.t}, {'c': u.c + x + no + not_a, 'p': u.p || 'K', 't': u.t || said},
               {'c': u.c + x + no + 3, 'p': u.p || 'R', 't': u.t || as_a}]) AS a
      FROM states v JOIN rows r ON v.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = v.i + 1))),
ends AS (
  SELECT conv_id, list_min([n, a]) AS best FROM states
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.p, '') AS audit,
       sha256(coalesce(best.t[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN ends ON o.conv_id IS NOT DISTINCT FROM ends.conv_id
     LEFT JOIN counts ON o.conv_id IS NOT DISTINCT FROM counts.conv_id"""
