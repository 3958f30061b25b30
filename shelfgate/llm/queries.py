"""Registered queries of this subpackage, each ``(spark, sf_dir) -> DataFrame``, and their SQL.

Every query applies one operator to its whole table and derives the digest
columns from the operator's output.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import bpe, exact, html, lines, packing, pii, quality, secrets, simhash, spelling, substrings, warc, whitening

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    return public_tokenizers.path(TOKENIZER)


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _sha(column: str):
    return F.sha2(F.col(column), 256)


def op1_bpe(spark: SparkSession, sf: str) -> DataFrame:
    path = tokenizer_path()
    out = bpe.decode(bpe.encode(_table(spark, sf, "documents"), path), path)
    return out.select("doc_id", F.expr("CAST(octet_length(ids) DIV 4 AS BIGINT)").alias("n_tokens"),
                      _sha("ids").alias("ids_sha256"), _sha("decoded").alias("decoded_sha256"))


def op2_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    out = lines.dedup_lines(_table(spark, sf, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op3_simhash(spark: SparkSession, sf: str) -> DataFrame:
    out = simhash.near_dedup(_table(spark, sf, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substrings.remove_repeats(_table(spark, sf, "documents"), digest=True)


def op5_html_text(spark: SparkSession, sf: str) -> DataFrame:
    return html.extract_text(_table(spark, sf, "pages"))


def op6_pii(spark: SparkSession, sf: str) -> DataFrame:
    found = pii.find_pii(_table(spark, sf, "documents").select("doc_id", "text"))
    names = [k.name for k in pii.KINDS if k.base]
    found = found.select("doc_id", "pii", F.expr(
        "transform(pii, s -> concat_ws(':', s.kind, CAST(s.start AS STRING), CAST(s.end AS STRING)))").alias("all"))
    n_base = F.expr(f"size(filter(pii, s -> s.k < {len(names)}))")
    return found.select(
        "doc_id", *[F.expr(f"CAST(size(filter(pii, s -> s.kind = '{n}')) AS BIGINT)").alias(f"n_{n}") for n in names],
        F.sha2(F.array_join(F.slice("all", F.lit(1), n_base), ","), 256).alias("base_sha256"),
        F.array_join("all", ",").alias("spans"))


def op7_warc(spark: SparkSession, sf: str) -> DataFrame:
    index, folder = warc.write_archives(_table(spark, sf, "pages"))
    return warc.read_records(index, folder, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact.exact_dedup(_table(spark, sf, "documents"), keep="largest")


def op9_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf, "documents"), tokenizer_path())


def op10_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    rules = quality.fit_rules(docs, _table(spark, sf, "labels"))
    return quality.apply_rules(docs, rules).select("doc_id", *quality.BASE, "base_failed", "kept")


def op11_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return spelling.spelling_variants(docs, words=spelling.with_slips(docs))


def op12_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets.scan(_table(spark, sf, "documents"), scratch_path(spark, "secret-ledger"))
    named = F.expr("transform(spans, s -> concat_ws(':', s.rule, CAST(s.start AS STRING), CAST(s.end AS STRING)))")
    base = F.expr(f"transform(filter(spans, s -> s.k < {len(secrets.BASE)}), "
                  "s -> concat_ws(':', s.rule, CAST(s.start AS STRING), CAST(s.end AS STRING)))")
    counts = [F.expr(f"CAST(size(filter(spans, s -> s.rule = '{r.name}')) AS BIGINT)").alias(f"n_{r.name}")
              for r in secrets.BASE]
    return found.select("doc_id", *counts, F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
                        F.array_join(named, ",").alias("spans"))


def op13_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_bpe, op2_line_dedup, op3_simhash, op4_substring_dedup, op5_html_text, op6_pii,
                                   op7_warc, op8_exact_dedup, op9_packing, op10_quality_rules,
                                   op11_spelling_variants, op12_secret_scan, op13_whitening)}

ORACLE_SQL = {
    "op2_line_dedup": r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(0, len(string_split(coalesce(text, ''), chr(10))))) AS no
  FROM documents),
w AS (SELECT * FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
first AS (SELECT line, length(line) AS n, min({'d': doc_id, 'no': no}) AS f FROM w GROUP BY line),
pairs AS (
  SELECT a.line AS a, b.line AS b, a.n AS an, b.n AS bn
  FROM first a JOIN first b ON b.n = a.n AND b.f < a.f WHERE a.n >= 10
  UNION ALL
  SELECT a.line, b.line, a.n, b.n FROM first a JOIN first b ON b.n = a.n + 1 AND b.f < a.f WHERE a.n >= 10
  UNION ALL
  SELECT a.line, b.line, a.n, b.n FROM first a JOIN first b ON b.n = a.n - 1 AND b.f < a.f WHERE b.n >= 10),
close AS (SELECT * FROM (SELECT *, CAST(least(9, (least(an, bn) - 1) // 2) AS BIGINT) AS h FROM pairs)
          WHERE left(a, h) = left(b, h) OR right(a, h) = right(b, h)),
near AS (
  SELECT DISTINCT a AS line FROM close
  WHERE len(list_filter(range(0, greatest(an, bn)), lambda i:
    left(a, i) = left(b, i) AND CASE WHEN an = bn THEN substring(a, i + 2) = substring(b, i + 2)
      WHEN an < bn THEN substring(a, i + 1) = substring(b, i + 2)
      ELSE substring(a, i + 2) = substring(b, i + 1) END)) > 0),
gone AS (
  SELECT w.doc_id, w.no FROM w JOIN first USING (line)
  WHERE {'d': w.doc_id, 'no': w.no} > first.f OR w.line IN (SELECT line FROM near)),
kept AS (
  SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.no) AS text
  FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.no = gone.no WHERE gone.no IS NULL GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(c.n, 0) AS n_lines, coalesce(g.n, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n FROM w GROUP BY doc_id) c USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) g USING (doc_id)
""",
    "op4_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS p, w FROM d WHERE len(w) >= 20),
v AS (SELECT doc_id, p, array_to_string(w[p:p + 19], ' ') AS t FROM s),
r AS (SELECT doc_id, p, row_number() OVER (PARTITION BY t ORDER BY doc_id, p) AS k FROM v),
g AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS q FROM r WHERE k > 1),
x AS (SELECT doc_id, list(q) AS gone FROM g GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN w
         ELSE list_filter(w, lambda y, i: NOT list_contains(gone, i)) END, ' ')) AS kept_sha256
FROM d LEFT JOIN x USING (doc_id)
""",
    "op7_warc": r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
q AS (SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS h,
             max(page_id) OVER (PARTITION BY b) AS best FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda k: substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST((CAST('0x' || substring(h, CAST((k // 8) * 10 + 1 AS BIGINT), 10) AS BIGINT)
               >> CAST(35 - 5 * (k % 8) AS BIGINT)) & 31 AS BIGINT) + 1, 1)), '') AS payload_digest,
       CASE WHEN best <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN best <> page_id THEN best END AS refers_to
FROM q
""",
    "op8_exact_dedup": r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS x FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY x) AS keep_id, count(*) OVER (PARTITION BY x) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY x) AS kept, sha256(x) AS text_sha256
FROM t
""",
    "op11_spelling_variants": r"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS r FROM documents),
u AS (SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r, count(*) AS c
      FROM t WHERE length(r) >= 6 GROUP BY ALL),
tab AS (
  SELECT list(v ORDER BY i) AS crc FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, x: xor(a >> 1, (a & 1) * 3988292384)) AS v
    FROM (SELECT CAST(unnest(range(0, 256)) AS BIGINT) AS i))),
b AS (
  SELECT doc_id, r, c, list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(
    string_split(concat(doc_id, ':', r), ''), lambda x: CASE WHEN ord(x) < 128 THEN [CAST(ord(x) AS BIGINT)]
      ELSE [CAST(195 AS BIGINT), CAST(ord(x) - 64 AS BIGINT)] END))) AS bytes FROM u),
h AS (
  SELECT r, c, xor(list_reduce(bytes, lambda a, x: xor(a >> 8, crc[(xor(a, x) & 255) + 1])), 4294967295) AS h
  FROM b, tab),
s AS (SELECT c, CASE WHEN h % 199 = 0 THEN concat(left(r, h % length(r)), substring(r, h % length(r) + 2)) ELSE r END AS word
      FROM h),
w AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM s WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
d AS (SELECT word, n, i, concat(left(word, i), substring(word, i + 2)) AS v
      FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM w)),
p AS (
  SELECT a.word AS a, a.n AS an, b.word AS b, b.n AS bn FROM d a JOIN d b ON a.i = b.i AND a.v = b.v AND a.word <> b.word
  UNION SELECT d.word, d.n, w.word, w.n FROM d JOIN w ON d.v = w.word
  UNION SELECT w.word, w.n, d.word, d.n FROM d JOIN w ON d.v = w.word),
g AS (SELECT a, an, count(*) AS n_near, min({'m': -bn, 'b': b}) AS best FROM p GROUP BY a, an),
f AS (SELECT a, n_near, CASE WHEN -best.m >= 5 * an THEN best.b END AS form, CASE WHEN -best.m >= 5 * an THEN -best.m END AS form_n
      FROM g),
chain AS (
  WITH RECURSIVE c AS (
    SELECT a AS word, form AS tip, 1 AS k FROM f WHERE form IS NOT NULL
    UNION ALL SELECT c.word, f.form, k + 1 FROM c JOIN f ON c.tip = f.a WHERE f.form IS NOT NULL)
  SELECT word, arg_max(tip, k) AS root FROM c GROUP BY word)
SELECT w.word, f.form, coalesce(chain.root, w.word) AS root, w.n, coalesce(f.n_near, 0) AS n_near, f.form_n
FROM w LEFT JOIN f ON w.word = f.a LEFT JOIN chain ON w.word = chain.word
""",
    "op12_secret_scan": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS (
  SELECT doc_id, 0 AS k, 'assign' AS kind, 12 AS least, regexp_extract_all(t, '(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 0) AS m,
    regexp_extract_all(t, '(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1) AS c, string_split_regex(t, '(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)') AS g FROM d
  UNION ALL SELECT doc_id, 1 AS k, 'access' AS kind, 18 AS least, regexp_extract_all(t, '(AKIA[A-Z0-9]+)', 0) AS m,
    regexp_extract_all(t, '(AKIA[A-Z0-9]+)', 1) AS c, string_split_regex(t, '(AKIA[A-Z0-9]+)') AS g FROM d
  UNION ALL SELECT doc_id, 2 AS k, 'hex' AS kind, 16 AS least, regexp_extract_all(t, '([0-9a-f]+)', 0) AS m,
    regexp_extract_all(t, '([0-9a-f]+)', 1) AS c, string_split_regex(t, '([0-9a-f]+)') AS g FROM d
  UNION ALL SELECT doc_id, 3 AS k, 'private_key' AS kind, 0 AS least, regexp_extract_all(t, '(-----BEGIN (?:[A-Z0-9]{1,20} ){0,3}PRIVATE KEY-----)', 0) AS m,
    regexp_extract_all(t, '(-----BEGIN (?:[A-Z0-9]{1,20} ){0,3}PRIVATE KEY-----)', 1) AS c, string_split_regex(t, '(-----BEGIN (?:[A-Z0-9]{1,20} ){0,3}PRIVATE KEY-----)') AS g FROM d
  UNION ALL SELECT doc_id, 4 AS k, 'github' AS kind, 0 AS least, regexp_extract_all(t, '(gh[pousr]_[A-Za-z0-9]{36,})', 0) AS m,
    regexp_extract_all(t, '(gh[pousr]_[A-Za-z0-9]{36,})', 1) AS c, string_split_regex(t, '(gh[pousr]_[A-Za-z0-9]{36,})') AS g FROM d
  UNION ALL SELECT doc_id, 5 AS k, 'slack' AS kind, 0 AS least, regexp_extract_all(t, '(xox[abeoprs]-[A-Za-z0-9-]{10,})', 0) AS m,
    regexp_extract_all(t, '(xox[abeoprs]-[A-Za-z0-9-]{10,})', 1) AS c, string_split_regex(t, '(xox[abeoprs]-[A-Za-z0-9-]{10,})') AS g FROM d
  UNION ALL SELECT doc_id, 6 AS k, 'google' AS kind, 0 AS least, regexp_extract_all(t, '(AIza[A-Za-z0-9_-]{35})', 0) AS m,
    regexp_extract_all(t, '(AIza[A-Za-z0-9_-]{35})', 1) AS c, string_split_regex(t, '(AIza[A-Za-z0-9_-]{35})') AS g FROM d
  UNION ALL SELECT doc_id, 7 AS k, 'stripe' AS kind, 0 AS least, regexp_extract_all(t, '([rs]k_live_[A-Za-z0-9]{16,})', 0) AS m,
    regexp_extract_all(t, '([rs]k_live_[A-Za-z0-9]{16,})', 1) AS c, string_split_regex(t, '([rs]k_live_[A-Za-z0-9]{16,})') AS g FROM d),
v AS (
  SELECT doc_id, k, kind, unnest(m) AS x, unnest(g[:len(m)]) AS gap, unnest(c) AS grp, unnest(range(0, len(m))) AS i, least FROM m),
e AS (
  SELECT *, sum(length(gap)) OVER w + sum(length(x)) OVER w AS e FROM v
  WINDOW w AS (PARTITION BY doc_id, k ORDER BY i ROWS UNBOUNDED PRECEDING)),
s AS (SELECT doc_id, k, kind, CAST(e - length(x) AS BIGINT) AS a, concat(kind, ':', CAST(e - length(x) AS BIGINT), ':', CAST(e AS BIGINT)) AS t
      FROM e WHERE length(grp) >= least),
j AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex, string_agg(t, ',' ORDER BY a, k) FILTER (k < 3) AS base,
         string_agg(t, ',' ORDER BY a, k) AS spans
  FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN j USING (doc_id)
""",
}
