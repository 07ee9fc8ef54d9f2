"""The registered queries: each operator over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglake.llm import alignment, decontaminate, lang_id, licences, line_dedup, near_dup, prefix_trie, segment_sampling, sharding, token_counts, token_shards, topk, toxicity
from loglake.session import fresh_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op9_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=80)


ORACLES["op9_minhash_near_dup"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(list_slice(w, i, i + 3), ' ')) END) AS sh FROM d
), x AS (SELECT doc_id, unnest(sh) AS t FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM x a JOIN x b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (
  SELECT p.a, p.b FROM p JOIN s sa ON sa.doc_id = p.a JOIN s sb ON sb.doc_id = p.b
  WHERE 100 * p.c >= 80 * (len(sa.sh) + len(sb.sh) - p.c)
), e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(a, b) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT s.doc_id, len(s.sh) AS n_shingles, m.component_id, s.doc_id = m.component_id AS kept FROM s JOIN m ON s.doc_id = m.doc_id
"""


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.dedup_lines(docs, fresh_path(spark, "line-index"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLES["op3_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, row_no, u.pos, u.line,
         translate(trim(u.line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, row_number() OVER () AS row_no, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
       LATERAL (SELECT unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS pos) AS u
), common AS (
  SELECT key, max(doc_id) AS last_doc FROM lines WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT l.doc_id, l.row_no, l.pos, l.line, c.key IS NOT NULL AND l.doc_id <> c.last_doc AS gone
  FROM lines l LEFT JOIN common c ON l.key = c.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id, row_no
"""


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lang_id.language_report(docs, lang_id.fit(docs.select("doc_id", "lang", "text")))


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"))


@query
def op2_segment_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_sampling.segment_report(table(spark, sf_dir, "documents"))


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.toxic_report(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query
def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return topk.top_k(rows, F.col("vec_id") % 50 == 0, k=5).withColumnRenamed("id", "vec_id")


ORACLES["op8_exact_top_k"] = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0
)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 5
"""


@query
def op6_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def _notice_rows() -> str:
    quoted = lambda text: "[" + ", ".join(f"'{w}'" for w in text.split()) + "]"
    rows = [f"('notice', '{label}', {quoted(key)}, {quoted(notice)})" for label, key, notice in licences.NOTICES]
    return ", ".join(rows + [f"('base', '{label}', {quoted(phrase)}, {quoted(phrase)})" for phrase, label in licences.BASE])


ORACLES["op6_licence_scan"] = rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rn,
         regexp_extract_all(translate(coalesce(text, ''), '{licences.UPPER}', '{licences.LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), n(kind, label, key, body) AS (VALUES {_notice_rows()}),
k AS (SELECT *, list_filter(range(1, len(body) + 1), lambda i: list_slice(body, i, i + len(key) - 1) = key)[1] AS lead FROM n),
z AS (
  SELECT d.rn, k.kind, k.label, k.body, k.lead, d.w,
         unnest(list_filter(list_transform(list_filter(range(1, len(d.w) + 1), lambda i: d.w[i] = k.key[1]), lambda i: i),
                            lambda i: list_slice(d.w, i, i + len(k.key) - 1) = k.key)) AS i
  FROM d JOIN k ON list_has_all(d.w, k.key)
), m AS (
  SELECT rn, kind, label, i, len(list_filter(range(1, len(body) + 1), lambda j: i - lead + j >= 1 AND coalesce(w[i - lead + j] = body[j], FALSE))) / len(body) AS share FROM z
), f AS (
  SELECT rn, count(*) FILTER (WHERE kind = 'base') AS n_base, min(i - 1) FILTER (WHERE kind = 'base') AS first_word,
         max(i - 1) FILTER (WHERE kind = 'base') AS last_word,
         array_to_string(list_sort(list(DISTINCT label) FILTER (WHERE kind = 'base')), ',') AS base_labels,
         array_to_string(list_sort(list(DISTINCT label) FILTER (WHERE kind = 'base' OR share >= {licences.LEAST_SHARE})), ',') AS labels,
         max(share) FILTER (WHERE kind = 'base' OR share >= {licences.LEAST_SHARE}) AS score
  FROM m GROUP BY rn
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(f.n_base, 0) AS n_base, f.first_word, f.last_word, coalesce(f.base_labels, '') AS base_labels,
       coalesce(f.labels, '') AS labels, coalesce(f.score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN f ON d.rn = f.rn
"""


@query
def op1_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards.write_shards(table(spark, sf_dir, "documents"), fresh_path(spark, "token-shards"))


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


@query
def op11_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(table(spark, sf_dir, "documents"), shards=8)


def _crc32(raw: str) -> str:
    """SQL for the unsigned CRC-32 of a hexadecimal text, bit by bit."""
    pairs = f"list_transform(regexp_extract_all({raw}, '..'), lambda p: ('0x' || p)::BIGINT)"
    bits = "lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    step = f"lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), {bits})"
    return f"xor(list_reduce(list_prepend(4294967295, {pairs}), {step}), 4294967295)"


def _jump(shards: int) -> str:
    """SQL for the published loop; each step is kept as [state, shard, next]."""
    step = f"""lambda s, i: CASE WHEN s[3] >= {shards} THEN s ELSE list_transform(
        [(s[1] * {sharding.MULTIPLIER}::HUGEINT + 1) % 18446744073709551616::HUGEINT],
        lambda k: [k, s[3], floor((s[3] + 1)::DOUBLE * ({sharding.TOP}::DOUBLE / ((k // 8589934592) + 1)::DOUBLE))::HUGEINT])[1] END"""
    start = "[('0x' || md5(coalesce(doc_id::VARCHAR, ''))[1:16])::UBIGINT::HUGEINT, 0::HUGEINT, 0::HUGEINT]"
    turns = f"list_transform(range({shards}), lambda i: [i::HUGEINT, 0::HUGEINT, 0::HUGEINT])"
    return f"list_reduce(list_prepend({start}, {turns}), {step})[2]::INT"


ORACLES["op11_jump_shards"] = rf"""
WITH d AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, {_crc32("hex(encode(coalesce(text, '')))")} AS text_crc32,
         {_jump(8)} AS shard, {_jump(9)} AS grown_shard FROM documents
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY md5(concat_ws(':', coalesce(doc_id::VARCHAR, ''), size, text_crc32))) - 1 AS slot, grown_shard
FROM d
"""


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie_report(table(spark, sf_dir, "conversations"))


ORACLES["op12_prefix_trie"] = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, md5(length(role)::VARCHAR || ':' || role || text)) AS seq FROM t GROUP BY conv_id
), placed AS (
  SELECT *, {_crc32("hex(encode(conv_id::VARCHAR))")} % 6 AS h FROM own
), whole AS (
  SELECT p.conv_id, list_concat(coalesce(list_slice(b.seq, 1, p.h), []), list_slice(p.seq, p.h + 1, len(p.seq))) AS seq
  FROM placed p LEFT JOIN own b ON b.conv_id = p.conv_id - p.conv_id % 100
), n AS (
  SELECT d, list_slice(seq, 1, d) AS pre, min(conv_id) AS conv_id, count(*) AS n_convs,
         list(conv_id ORDER BY conv_id) FILTER (WHERE len(seq) = d) AS final
  FROM (SELECT conv_id, seq, unnest(range(len(seq) + 1)) AS d FROM whole) GROUP BY ALL
), k AS (SELECT d - 1 AS d, list_slice(pre, 1, d - 1) AS pre, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
m AS (
  SELECT n.*, p.conv_id AS parent_conv_id, coalesce(k.n_children, 0) AS n_children
  FROM n LEFT JOIN n p ON p.d = n.d - 1 AND p.pre = list_slice(n.pre, 1, n.d - 1) LEFT JOIN k ON k.d = n.d AND k.pre = n.pre
), u AS (
  SELECT up AS d, list_slice(pre, 1, up) AS pre, sum((n_children = 0)::INT) AS n_leaves,
         sum(CASE WHEN d > 0 THEN (n_convs - 1) * length(pre[d].text) ELSE 0 END) AS saved_tokens
  FROM (SELECT *, unnest(range(d + 1)) AS up FROM m) GROUP BY ALL
)
SELECT m.conv_id, m.d AS depth, m.parent_conv_id, m.n_convs, m.n_children, u.n_leaves::BIGINT AS n_leaves, u.saved_tokens::BIGINT AS saved_tokens,
       sha256(coalesce(array_to_string(m.final, ','), '')) AS ends_sha256
FROM m JOIN u ON u.d = m.d AND u.pre = m.pre
"""


@query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_report(table(spark, sf_dir, "documents"))
