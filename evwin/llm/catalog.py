"""Registered queries of the operators in this subpackage, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evwin.llm import benchmarks, conversations, fingerprints, langid, licenses, lines, neighbours, phrases, sentencepiece, simhash, spelling, suffixes, toxicity
from evwin.llm.common import table


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.tokenize(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = benchmarks.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_passages", "contaminated", "item_ids", "score")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.dedup_bytes(table(spark, sf_dir, "documents"))


def op5_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.dedup_words(table(spark, sf_dir, "documents"))


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search_table(table(spark, sf_dir, "embeddings"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_lines", "n_removed", F.md5("kept").alias("kept_md5"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_table(table(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_toxicity": op2_toxicity,
    "op3_decontamination": op3_decontamination,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_phrase_dedup": op5_phrase_dedup,
    "op6_nearest": op6_nearest,
    "op7_language": op7_language,
    "op8_line_dedup": op8_line_dedup,
    "op9_license_scan": op9_license_scan,
    "op10_simhash": op10_simhash,
    "op11_fingerprints": op11_fingerprints,
    "op12_spelling": op12_spelling,
    "op13_conversation_trie": op13_conversation_trie,
}

LINE_SQL = f"""
WITH cut AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents
), ln AS (
  SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM cut
), keyed AS (
  SELECT l.doc_id, l.pos, trim(l.line, ' ') AS k, d.source FROM ln l JOIN documents d USING (doc_id) WHERE trim(l.line, ' ') <> ''
), boiler AS (
  SELECT k, min((doc_id, pos)) AS first FROM keyed GROUP BY k HAVING count(DISTINCT source) >= {lines.MIN_SITES}
), gone AS (
  SELECT keyed.doc_id, keyed.pos FROM keyed JOIN boiler USING (k) WHERE (keyed.doc_id, keyed.pos) <> boiler.first
), kept AS (
  SELECT ln.doc_id, string_agg(ln.line, chr(10) ORDER BY ln.pos) AS kept
  FROM ln LEFT JOIN gone ON gone.doc_id = ln.doc_id AND gone.pos = ln.pos WHERE gone.pos IS NULL GROUP BY ln.doc_id
), lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT cut.doc_id, CASE WHEN cut.text IS NULL THEN 0 ELSE len(cut.ls) END AS n_lines, coalesce(lost.n, 0) AS n_removed,
       CASE WHEN cut.text IS NULL THEN NULL ELSE md5(coalesce(kept.kept, '')) END AS kept_md5
FROM cut LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)
"""


def _template_values() -> str:
    all_ = [(p, label, "true") for p, label in licenses.BASE] + [(p, label, "false") for p, label in licenses.NOTICES]
    return ", ".join(f"({i}, '{p}', '{label}', {base})" for i, (p, label, base) in enumerate(all_))


LICENSE_SQL = rf"""
WITH tpl AS (
  SELECT tid, label, base, string_split(phrase, ' ') AS tw FROM (VALUES {_template_values()}) v(tid, phrase, label, base)
), tg AS (
  SELECT tid, label, base, len(tw) - 2 AS n_grams, unnest(range(0, len(tw) - 2)) AS tpos, tw FROM tpl
), tgram AS (
  SELECT tid, label, base, n_grams, tpos, tw[tpos + 1] AS t0, tw[tpos + 2] AS t1, tw[tpos + 3] AS t2 FROM tg
), d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
), w AS (
  SELECT rid, unnest(ws) AS w0, unnest(ws[2:]) AS w1, unnest(ws[3:]) AS w2, generate_subscripts(ws, 1) - 1 AS pos FROM d
), votes AS (
  SELECT w.rid, tid, label, base, n_grams, w.pos - tpos AS diagonal, count(DISTINCT tpos) AS hits, sum(DISTINCT (1::HUGEINT << tpos)) AS bits
  FROM w JOIN tgram ON w0 = t0 AND w1 = t1 AND w2 = t2 GROUP BY ALL
), cuts AS (
  SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY rid, tid ORDER BY diagonal) <= {licenses.SLACK} THEN 0 ELSE 1 END AS cut FROM votes
), runs AS (
  SELECT *, sum(cut) OVER (PARTITION BY rid, tid ORDER BY diagonal) AS run FROM cuts
), spans AS (
  SELECT rid, tid, label, base, n_grams, run, bit_count(bit_or(bits::HUGEINT)) / n_grams AS share,
         count(*) FILTER (hits = n_grams) AS n_exact, min(diagonal) FILTER (hits = n_grams) AS f, max(diagonal) FILTER (hits = n_grams) AS l
  FROM runs GROUP BY rid, tid, label, base, n_grams, run
)
SELECT d.doc_id, len(any_value(d.ws)) AS n_words, coalesce(sum(n_exact) FILTER (base), 0)::BIGINT AS n_base,
       min(f) FILTER (base) AS first_word, max(l) FILTER (base) AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base AND n_exact > 0), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base AND n_exact > 0 OR NOT base AND share >= {licenses.SHARE}), '') AS labels,
       coalesce(max(share), 0.0)::DOUBLE AS score
FROM d LEFT JOIN spans USING (rid) GROUP BY d.rid, d.doc_id
"""

#: DuckDB has no CRC-32: the table of its 256 remainders, and the checksum of a text column.
_CRC_TABLE = """crc_table AS (
  SELECT list(v ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda x, k: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END)) AS v FROM range(256) r(i))
)"""


def _crc(text: str) -> str:
    octets = f"list_transform(range(octet_length(encode({text}))), lambda k: ('0x' || substr(hex(encode({text})), 2 * k + 1, 2))::BIGINT)"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {octets}), lambda c, b: xor(c >> 8, tab[xor(c, b) % 256 + 1])))"


SPELLING_SQL = rf"""
WITH RECURSIVE {_CRC_TABLE}, found AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents
), counted AS (SELECT doc_id, run, count(*) AS n FROM found GROUP BY ALL
), hashed AS (SELECT run, n, {_crc("(coalesce(doc_id::VARCHAR, '') || ':' || run)")} AS h FROM counted, crc_table
), changed AS (
  SELECT CASE WHEN h % {spelling.DELETED} = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n FROM hashed
), words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM changed WHERE length(word) >= {spelling.MIN_LENGTH} GROUP BY word HAVING sum(n) >= {spelling.MIN_COUNT}
), cut AS MATERIALIZED (
  SELECT word, k, substr(word, 1, k) || substr(word, k + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS k FROM words)
), near AS MATERIALIZED (
  SELECT a.word, b.word AS other FROM cut a JOIN cut b ON a.k = b.k AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT cut.word, words.word FROM cut JOIN words ON cut.rest = words.word
  UNION SELECT words.word, cut.word FROM cut JOIN words ON cut.rest = words.word
), ranked AS (
  SELECT near.word, w.n, near.other, o.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near, row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, near.other) AS rank
  FROM near JOIN words w ON w.word = near.word JOIN words o ON o.word = near.other
), best AS (
  SELECT word, n_near, CASE WHEN other_n >= 2 * n THEN other END AS form, CASE WHEN other_n >= 2 * n THEN other_n END AS form_n FROM ranked WHERE rank = 1
), chain AS (
  SELECT word, form AS root FROM best WHERE form IS NOT NULL
  UNION ALL SELECT chain.word, best.form FROM chain JOIN best ON best.word = chain.root WHERE best.form IS NOT NULL
), roots AS (SELECT chain.word, root FROM chain LEFT JOIN best ON best.word = chain.root WHERE best.form IS NULL)
SELECT words.word, form, coalesce(root, words.word) AS root, n, coalesce(n_near, 0) AS n_near, form_n
FROM words LEFT JOIN best USING (word) LEFT JOIN roots USING (word)
"""

TRIE_SQL = f"""
WITH {_CRC_TABLE}, seqs AS MATERIALIZED (
  SELECT conv_id, list({{'role': r, 'text': x}} ORDER BY turn NULLS FIRST, md5(octet_length(encode(r))::VARCHAR || ':' || r || x)) AS seq
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL) GROUP BY conv_id
), own AS (SELECT conv_id, seq, conv_id - conv_id % {conversations.GROUP} AS of, {_crc("conv_id::VARCHAR")} % {conversations.BORROWED} AS h FROM seqs, crc_table
), rebuilt AS MATERIALIZED (
  SELECT own.conv_id, list_concat(coalesce(b.seq, [])[:h], own.seq[h + 1:]) AS seq FROM own LEFT JOIN seqs b ON b.conv_id = own.of
), placed AS (SELECT conv_id, len(seq) AS n_turns, unnest(range(len(seq) + 1)) AS depth, seq FROM rebuilt
), paths AS (SELECT conv_id, n_turns, depth, seq[:depth] AS path FROM placed
), nodes AS MATERIALIZED (
  SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n_turns = depth) AS ends,
         CASE WHEN depth = 0 THEN 0 ELSE octet_length(encode(path[depth].text)) END AS octets FROM paths GROUP BY depth, path
), ups AS MATERIALIZED (
  SELECT c.depth, c.conv_id, p.conv_id AS parent_conv_id FROM nodes c JOIN nodes p ON p.depth = c.depth - 1 AND p.path = c.path[:c.depth - 1]
), kids AS (SELECT depth - 1 AS depth, parent_conv_id AS conv_id, count(*) AS n_children FROM ups GROUP BY ALL
), above AS (
  SELECT n.depth, n.conv_id, unnest(range(n.depth + 1)) AS up, n.path, n.n_convs, n.octets, k.n_children FROM nodes n LEFT JOIN kids k USING (depth, conv_id)
), sums AS (
  SELECT up AS depth, path[:up] AS path, count(*) FILTER (n_children IS NULL) AS n_leaves, sum((n_convs - 1) * octets)::BIGINT AS saved_tokens FROM above GROUP BY ALL
)
SELECT n.conv_id, n.depth, u.parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, s.n_leaves, s.saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM nodes n JOIN sums s USING (depth, path) LEFT JOIN ups u ON u.depth = n.depth AND u.conv_id = n.conv_id LEFT JOIN kids k ON k.depth = n.depth AND k.conv_id = n.conv_id
"""

ORACLE: dict[str, str] = {
    "op8_line_dedup": LINE_SQL,
    "op9_license_scan": LICENSE_SQL,
    "op12_spelling": SPELLING_SQL,
    "op13_conversation_trie": TRIE_SQL,
}
