"""Registered queries of the text operators, one for each, and their DuckDB SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    decontam,
    hmm_lm,
    html_density,
    ngram_join,
    orchard_kmeans,
    ordinal_toxicity,
    pii_anchor,
    risk_thresholds,
    simple8b,
    sp_nbest,
    token_counts,
    turn_repair,
    warc_index,
)
from .common import read_table, ship

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_density.extract(read_table(spark, sf_dir, "pages"))


def op2_hmm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram base and hidden Markov score of every document."""
    return hmm_lm.score_texts(read_table(spark, sf_dir, "documents"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document: 5-word shingles, Jaccard similarity 0.8."""
    return ngram_join.ngram_join(read_table(spark, sf_dir, "documents"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return pii_anchor.find_pii(read_table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected toxicity severity of every document, fitted on the labels."""
    return ordinal_toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts and verdict of every document, cutoffs certified on all labels."""
    found = risk_thresholds.quality_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return found.select("doc_id", *risk_thresholds.COUNTS, "base_failed", "kept")


def op7_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start, length and checksum of every document's ids, from the files written."""
    return simple8b.ids_round_trip(read_table(spark, sf_dir, "documents"), WORD_BPE)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in every document."""
    return decontam.digest(decontam.find_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))).drop("spans")


def op9_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four best segmentations of every document."""
    return sp_nbest.digest(sp_nbest.segment(read_table(spark, sf_dir, "documents"), PIECE_BPE))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, looked up in the capture index and read back from the archives."""
    return warc_index.round_trip(read_table(spark, sf_dir, "pages"))


def op11_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repair of every damaged conversation."""
    return turn_repair.repair(read_table(spark, sf_dir, "conversations"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centroid, squared distance and inertias of every vector of 64 finite components."""
    return orchard_kmeans.cluster(read_table(spark, sf_dir, "embeddings"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and byte-level BPE tokens of every document."""
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), BYTE_BPE)


_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP8_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOW}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOW}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM benchmark),
sized AS (SELECT item, w, least(10, len(w)) AS k FROM items WHERE len(w) > 0),
win AS (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM sized, unnest(range(1, len(w) - k + 2)) AS t(i)),
widths AS (SELECT DISTINCT k FROM win),
found AS (SELECT rid, i, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM docs, widths, unnest(range(1, len(w) - k + 2)) AS t(i)),
hits AS (SELECT rid, i, k, item FROM found JOIN win USING (k, g)),
words AS (SELECT rid, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + k)) AS t(p) GROUP BY rid),
named AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (rid) LEFT JOIN named USING (rid)
"""

OP10_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
r AS (SELECT page_id, octet_length(encode(h)) AS payload_bytes, x,
             row_number() OVER (PARTITION BY x ORDER BY page_id DESC NULLS LAST) AS k,
             first_value(page_id) OVER (PARTITION BY x ORDER BY page_id DESC NULLS LAST) AS top FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((
         ((strpos('0123456789abcdef', substr(x, CAST(j * 5 // 4 AS INT) + 1, 1)) - 1) * 16
          + strpos('0123456789abcdef', substr(x, CAST(j * 5 // 4 AS INT) + 2, 1)) - 1) >> (3 - (j * 5) % 4)) & 31 AS INT), 1)), '') AS payload_digest,
       CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN k > 1 THEN top END AS refers_to
FROM r
"""

# Damage needs CRC-32, which DuckDB lacks: ``t`` is its table. Each step of ``walk`` takes the next row of all
# conversations: from each state the least (cost, audit), insertions before and, after the last row, behind it.
OP11_SQL = """
WITH RECURSIVE crc AS (SELECT list_transform(range(0, 256), lambda i: list_reduce(list_concat([i], range(0, 8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
drawn AS (SELECT conv_id, turn, role, text, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(key, ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 20 AS kind FROM keyed, crc),
hurt AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text FROM drawn, unnest(range(0, CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS u(copy)),
told AS (SELECT *, substr(role, 1, 1) AS r, right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS n FROM hurt),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) AS nth FROM told),
rows AS (SELECT *, last = '' AS blank, last <> '' AND nth > 1 AS dup, last <> '' AND nth = 1 AND last NOT IN ('.', '!', '?') AS trunc FROM seen),
facts AS (SELECT conv_id, count(*) AS n_rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate, count(*) FILTER (trunc) AS truncated FROM rows GROUP BY conv_id),
pairs AS (SELECT conv_id, count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM (SELECT conv_id, lag(r) OVER (PARTITION BY conv_id ORDER BY n) || r AS pair FROM rows) GROUP BY conv_id),
moves(p, r, q) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
added(p, q, c, a, names) AS (SELECT p, p, 0, '', CAST([] AS VARCHAR[]) FROM (VALUES (0), (1), (2), (3)) AS s(p) UNION ALL VALUES
  (0, 2, 2, 'I', ['user:']), (1, 2, 2, 'I', ['user:']), (2, 3, 2, 'I', ['assistant:']), (3, 2, 2, 'I', ['user:']),
  (0, 3, 4, 'II', ['user:', 'assistant:']), (1, 3, 4, 'II', ['user:', 'assistant:']), (3, 3, 4, 'II', ['user:', 'assistant:']), (2, 2, 4, 'II', ['assistant:', 'user:'])),
edits AS (SELECT conv_id, n, p, p AS q, 3 AS c, 'D' AS a, CAST([] AS VARCHAR[]) AS names FROM rows, (VALUES (0), (1), (2), (3)) AS s(p)
  UNION ALL SELECT conv_id, n, p, q, CAST(trunc AS INT), 'K', [role || ':' || text] FROM rows JOIN moves USING (r) WHERE NOT blank AND NOT dup
  UNION ALL SELECT conv_id, n, p, q, 2 + CAST(trunc AS INT), 'R', [CASE m.r WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text] FROM rows, moves m WHERE m.r <> 's' AND NOT blank AND NOT dup),
walk AS (
  SELECT conv_id, 0 AS n, 0 AS q, 0 AS c, '' AS a, CAST([] AS VARCHAR[]) AS names FROM facts
  UNION ALL
  SELECT w.conv_id, e.n, e.q, w.c + i.c + e.c, w.a || i.a || e.a, list_concat(list_concat(w.names, i.names), e.names)
  FROM walk w JOIN added i ON i.p = w.q JOIN edits e ON e.conv_id IS NOT DISTINCT FROM w.conv_id AND e.n = w.n + 1 AND e.p = i.q
  QUALIFY row_number() OVER (PARTITION BY w.conv_id, e.q ORDER BY w.c + i.c + e.c, w.a || i.a || e.a) = 1),
best AS (SELECT w.conv_id, w.c + i.c AS cost, w.a || i.a AS audit, list_concat(w.names, i.names) AS names
  FROM walk w JOIN facts f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.n_rows = w.n JOIN added i ON i.p = w.q WHERE i.q IN (0, 3)
  QUALIFY row_number() OVER (PARTITION BY w.conv_id ORDER BY w.c + i.c, w.a || i.a) = 1)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(names, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN pairs p ON p.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id
"""


def _op12_sql(rounds: int = 5) -> str:
    """Brute force: each round measures all vectors against all centroids."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
near{i} AS MATERIALIZED (SELECT rid, c, d FROM (
  SELECT rid, c, list_sum(list_transform(list_zip(v, m), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM kept, cent{i}) QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, c) = 1)""")
        if i < rounds:
            steps.append(f"""
sums{i} AS (SELECT c, j, sum(v[j]) AS s, count(*) AS n FROM kept JOIN near{i} USING (rid), unnest(range(1, 65)) AS u(j) GROUP BY c, j),
mean{i} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS m FROM sums{i} GROUP BY c),
cent{i + 1} AS MATERIALIZED (SELECT c, coalesce(n.m, o.m) AS m FROM cent{i} o LEFT JOIN mean{i} n USING (c))""")
    return f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
cent0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS INT) AS c, v AS m FROM kept QUALIFY c < 40),{','.join(steps)},
whole AS (SELECT *, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS part, CAST(sum(d) OVER () AS BIGINT) AS total FROM near{rounds})
SELECT vec_id, c AS cluster, CAST(d AS BIGINT) AS distance, part AS cluster_inertia, total AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM whole JOIN kept USING (rid) JOIN cent{rounds} USING (c)
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_main_text, op2_hmm_score, op3_ngram_join, op4_pii, op5_toxicity, op6_quality, op7_token_ids, op8_decontaminate, op9_segment, op10_warc,
        op11_turns, op12_centroids, op13_token_counts,
    )
}
ORACLE_SQL = {"op8_decontaminate": OP8_SQL, "op10_warc": OP10_SQL, "op11_turns": OP11_SQL, "op12_centroids": _op12_sql()}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def shipped(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(ship(spark), sf_dir)

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        return run

    return {k: shipped(f) for k, f in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
