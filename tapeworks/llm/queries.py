"""The corpus operators over the driver tables: one query each, and SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.llm import decontam, exactdup, linedup, merkle, packing, resample, secretscan, simhash, store, substring, tokencache, toxicity, urlfilter
from tapeworks.llm.common import shared_folder, table


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secretscan.secrets(table(spark, sf_dir, "documents"))
    counts = [secretscan.count_kind(F.col("base"), k).alias(f"n_{name}") for k, name in enumerate(secretscan.KINDS[:3])]
    return found.select("doc_id", *counts, F.sha2(secretscan.named(F.col("base")), 256).alias("base_sha256"), secretscan.named(F.col("spans")).alias("spans"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that aren't blank, those deleted, and a digest of the text that is left."""
    left = linedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", F.col("n_lines_").alias("n_lines"), F.col("n_removed_").alias("n_removed"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """About half of the rows, by a hash of their ids, form the snapshot; the others come in as a new batch."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    old = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    return exactdup.dedup(docs.filter(old), docs.filter(~old))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.removals(table(spark, sf_dir, "documents"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.document_digests(store.write_store(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json")))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(table(spark, sf_dir, "documents"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """About half of the rows, by a hash of their ids, are counted first; the others then find their copies' counts in the cache."""
    docs, tokenizer, counts = table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), shared_folder(spark)
    early = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    return tokencache.token_counts(docs.filter(early), tokenizer, counts).unionByName(tokencache.token_counts(docs.filter(~early), tokenizer, counts))


QUERIES = {
    f.__name__: f
    for f in (
        op1_best_fit_packing, op2_url_filters, op3_secret_scan, op4_benchmark_decontamination, op5_line_dedup,
        op6_exact_dedup, op7_substring_dedup, op8_simhash_near_dedup, op9_token_store, op10_toxicity,
        op11_merkle_manifest, op12_importance_resampling, op13_token_counts,
    )
}

ORACLE_SQL = {
    "op4_benchmark_decontamination": r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bs AS (SELECT item_id, w, least(len(w), 10) AS k FROM bw WHERE len(w) > 0),
bi AS (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM bs),
bg AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM bi),
di AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw, (SELECT DISTINCT k FROM bg) WHERE len(w) >= k),
dg AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g FROM di),
m AS (SELECT dg.doc_id, dg.k, dg.i, bg.item_id FROM dg JOIN bg ON dg.k = bg.k AND dg.g = bg.g),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS s
  FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id),
hits AS (
  SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS p FROM m) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(dw.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN items USING (doc_id) LEFT JOIN hits USING (doc_id)
""",
    "op5_line_dedup": r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents),
b AS (SELECT doc_id, i, line, regexp_replace(regexp_replace(line, '^[ \t\x0B\x0C\r]+', ''), '[ \t\x0B\x0C\r]+$', '') AS bare FROM l),
n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS nth FROM b WHERE bare <> ''),
w AS (
  SELECT doc_id, nth, 2 AS lines, bare || chr(10) || lead(bare) OVER (PARTITION BY doc_id ORDER BY nth) AS run FROM n
  UNION ALL SELECT doc_id, nth, 1, bare FROM n WHERE strlen(bare) >= 48 OR len(regexp_extract_all(bare, '[^ \t\x0B\x0C\r]+')) >= 8),
r AS (SELECT doc_id, nth, lines, row_number() OVER (PARTITION BY lines, run ORDER BY doc_id, nth) AS k FROM w WHERE run IS NOT NULL),
g AS (SELECT DISTINCT doc_id, unnest(range(nth, nth + lines)) AS nth FROM r WHERE k > 1),
k AS (
  SELECT b.doc_id, b.i, b.line, n.nth IS NOT NULL AS counts, g.nth IS NOT NULL AS gone
  FROM b LEFT JOIN n ON b.doc_id = n.doc_id AND b.i = n.i LEFT JOIN g ON n.doc_id = g.doc_id AND n.nth = g.nth)
SELECT doc_id, count(*) FILTER (counts) AS n_lines, count(*) FILTER (gone) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM k GROUP BY doc_id
""",
    "op7_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35),
h AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM p),
c AS (SELECT doc_id, i, count(*) OVER (PARTITION BY h) AS c FROM h),
e AS (
  SELECT doc_id, i, max(i) FILTER (c > 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS s
  FROM (SELECT doc_id, i, c FROM c UNION ALL SELECT doc_id, unnest(range(greatest(len(w) - 33, 1), len(w) + 1)), 0 FROM d)),
k AS (SELECT e.doc_id, count(*) FILTER (s IS NOT NULL) AS n_removed, string_agg(d.w[i], ' ' ORDER BY i) FILTER (s IS NULL) AS left_ FROM e JOIN d USING (doc_id) GROUP BY e.doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.left_, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
""",
    "op6_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
""",
    "op11_merkle_manifest": r"""
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_concat([b], range(8)),
           lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
d AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END AS fs,
         CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END AS fd,
         CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS fl,
         CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END AS fn,
         CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS ft, replace(text, chr(10), '') AS bare,
         list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                     lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])) % 2 = 1 AND doc_id IS NOT NULL AS even FROM documents, tab),
l AS (
  SELECT doc_id, source, sha256(fd || fs || fl || fn || ft) AS leaf,
         sha256(fd || fs || fl || fn || CASE WHEN bare IS NULL OR even IS NOT TRUE THEN ft ELSE strlen(bare) || ':' || bare END) AS used FROM d),
r AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM l),
t AS (
  SELECT CAST(0 AS BIGINT) AS lvl, s, i, leaf AS h, count(*) OVER (PARTITION BY s) AS n FROM r
  UNION ALL
  SELECT lvl + 1, s, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3 FROM t WHERE n > 1 GROUP BY lvl, s, i // 3, n),
sub AS (SELECT s, h AS subroot FROM t WHERE n = 1),
u AS (
  SELECT CAST(0 AS BIGINT) AS lvl, s AS i, subroot AS h, count(*) OVER () AS n FROM sub
  UNION ALL
  SELECT lvl + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3 FROM u WHERE n > 1 GROUP BY lvl, i // 3, n),
low AS (
  SELECT a.s, a.lvl, a.i, string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i) AS before_, string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i) AS after_
  FROM t a JOIN t b ON a.s = b.s AND a.lvl = b.lvl AND a.i // 3 = b.i // 3 WHERE a.n > 1 GROUP BY a.s, a.lvl, a.i),
high AS (
  SELECT a.lvl, a.i, string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i) AS before_, string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i) AS after_
  FROM u a JOIN u b ON a.lvl = b.lvl AND a.i // 3 = b.i // 3 WHERE a.n > 1 GROUP BY a.lvl, a.i),
deep AS (SELECT max(lvl) AS m FROM t),
step AS (
  SELECT r.s, r.i, low.lvl AS lvl, coalesce(before_, '') AS before_, coalesce(after_, '') AS after_
  FROM r JOIN low ON low.s = r.s JOIN (SELECT unnest(range((SELECT m + 1 FROM deep))) AS lvl) k ON low.lvl = k.lvl AND low.i = r.i // CAST(pow(3, k.lvl) AS BIGINT)
  UNION ALL
  SELECT r.s, r.i, (SELECT m + 1 FROM deep) + high.lvl, coalesce(before_, ''), coalesce(after_, '')
  FROM r JOIN (SELECT unnest(range((SELECT max(lvl) + 1 FROM u))) AS lvl) k ON true JOIN high ON high.lvl = k.lvl AND high.i = r.s // CAST(pow(3, k.lvl) AS BIGINT)),
p AS (
  SELECT s, i, list(before_ ORDER BY lvl) AS b, list(after_ ORDER BY lvl) AS a, string_agg(before_ || after_, '' ORDER BY lvl) AS proof FROM step GROUP BY s, i),
f AS (
  SELECT s, i, 1 AS k, used AS h FROM r
  UNION ALL
  SELECT f.s, f.i, k + 1, sha256(p.b[k] || h || p.a[k]) FROM f JOIN p ON f.s = p.s AND f.i = p.i WHERE k <= len(p.b))
SELECT r.doc_id, r.leaf, subroot, (SELECT h FROM u WHERE n = 1) AS root, sha256(coalesce(p.proof, '')) AS proof_sha256, g.h AS folded_root, g.h = (SELECT h FROM u WHERE n = 1) AS verified
FROM r JOIN sub USING (s) LEFT JOIN p ON p.s = r.s AND p.i = r.i
JOIN (SELECT s, i, max_by(h, k) AS h FROM f GROUP BY s, i) g ON g.s = r.s AND g.i = r.i
""",
    "op12_importance_resampling": r"""
WITH tab AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_concat([b], range(8)),
           lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
w AS (
  SELECT row_number() OVER () AS r, true AS doc, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 0, false, NULL, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
g AS (SELECT doc, r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM w),
n AS (SELECT doc, r, f, count(*) AS n FROM g GROUP BY ALL),
x AS (SELECT f, hex(encode(f)) AS x FROM (SELECT DISTINCT f FROM n)),
b AS (
  SELECT f, xor(list_reduce(list_concat([4294967295], list_transform(range(0, CAST(len(x) AS BIGINT), 2), lambda i: (instr('123456789ABCDEF', x[i + 1]) * 16 + instr('123456789ABCDEF', x[i + 2])))),
                            lambda c, v: xor(c >> 8, tab[(xor(c, v) & 255) + 1])), 4294967295) % 10000 AS b FROM x, tab),
k AS (
  SELECT b, coalesce(sum(n) FILTER (doc), 0) AS s, coalesce(sum(n) FILTER (NOT doc), 0) AS t FROM n JOIN b USING (f) GROUP BY b),
z AS (SELECT coalesce(sum(s), 0) AS ss, coalesce(sum(t), 0) AS tt FROM k),
v AS (SELECT b, CAST(floor(1000 * ln(CAST((t + 1) * (ss + 10000) AS DOUBLE) / CAST((s + 1) * (tt + 10000) AS DOUBLE))) AS BIGINT) AS gain FROM k, z),
d AS (SELECT r, sum(n) AS n, sum(n * gain) AS total FROM n JOIN b USING (f) JOIN v USING (b) WHERE doc GROUP BY r),
h AS (
  SELECT w.doc_id, CAST(coalesce(d.n, 0) AS BIGINT) AS n_features, len(w.w) >= 20 AS able, CAST(coalesce(floor(total / n), 0) AS BIGINT) AS weight,
         CAST('0x' || sha256('7:' || coalesce(CAST(w.doc_id AS VARCHAR), ''))[1:8] AS BIGINT) AS h
  FROM w LEFT JOIN d ON w.r = d.r WHERE w.doc),
p AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM h),
q AS (SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id NULLS FIRST, n_features) AS place, count(*) OVER (PARTITION BY able) AS m FROM p)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= 25 * m // 100 THEN place END AS rank FROM q
""",
}
