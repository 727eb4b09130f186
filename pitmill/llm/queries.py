"""The numbered queries, with the SQL that DuckDB can run for them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitmill.llm import decontaminate, hnsw, langid, licenses, lmscore, pieces, quality, resample, secrets, simhash, toxicity, urlfilter, whitening


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    index = hnsw.build_index(rows, k=20)
    return hnsw.search_index(index, rows.where("vec_id % 20 = 0"), k=20)


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return lmscore.score(docs, lmscore.fit(docs), lmscore.fit_lexicon(docs))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "shared", "item_shingles", F.round("containment", 6).alias("containment"))


def _op3_sql() -> str:
    words = r"list_filter(string_split_regex(lower(text), '[\x00-\x2f\x3a-\x60\x7b-\x7f]+'), lambda x: x <> '')"
    shingles = "unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END)"
    return f"""
WITH w AS (SELECT doc_id, row_number() OVER () AS n, {words} AS w FROM documents),
v AS (SELECT item_id, row_number() OVER () AS m, {words} AS w FROM (SELECT DISTINCT item_id, text FROM benchmark)),
d AS (SELECT DISTINCT doc_id, n, {shingles} AS s FROM w),
i AS (SELECT DISTINCT item_id, m, {shingles} AS s FROM v),
k AS (SELECT m, count(*) AS item_shingles FROM i GROUP BY m)
SELECT doc_id, item_id, count(*) AS shared, item_shingles, round(count(*) / item_shingles, 6) AS containment
FROM d JOIN i USING (s) JOIN k USING (m) GROUP BY doc_id, n, item_id, m, item_shingles HAVING count(*) >= 0.8 * item_shingles"""


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = pieces.decode(pieces.encode(_table(spark, sf_dir, "documents")))
    same = F.xxhash64(F.col("text").cast("binary")) == F.col("text_hash")
    return back.select("doc_id", F.size("pieces").cast("long").alias("n_pieces"), "pieces", same.alias("lossless"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    found = langid.identify(docs, langid.fit_languages(docs, learn=part != 2))
    return found.select("doc_id", F.coalesce(part == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op6_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return licenses.find_licenses(docs, licenses.fit_licenses(docs))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    found = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels, learn=part != 0))
    return found.select("doc_id", F.coalesce(part == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(urlfilter.RULES), "host string, path string, verdict string")
    return urlfilter.judge_urls(_table(spark, sf_dir, "pages"), rules)


def _op7_sql() -> str:
    fits = [
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}:{v}'"
        for h, p, v in sorted(urlfilter.RULES, key=lambda r: -len(r[0] + r[1]))
    ]
    return f"""
WITH u AS (SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
f AS (SELECT *, CASE {' '.join(fits)} END AS fit FROM u)
SELECT page_id, host, path, split_part(fit, ':', 1) AS rule, coalesce(split_part(fit, ':', 2), 'allow') AS verdict FROM f"""


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(_table(spark, sf_dir, "documents"))
    base = {r.kind for r in secrets.RULES if r.base}
    of = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[of(r.kind) for r in secrets.RULES if r.base],
        F.sha2(secrets.joined(F.filter("spans", lambda s: s.kind.isin(base))).cast("binary"), 256).alias("base_sha256"),
        secrets.joined(F.col("spans")).alias("spans"),
    )


def _op8_sql() -> str:
    def kind(i: int, r: secrets.Rule) -> str:
        p = r.pattern.replace("'", "''")
        return f"""SELECT doc_id, n, {i} AS ord, '{r.kind}' AS kind, regexp_extract_all(t, '{p}', 0) AS m, regexp_extract_all(t, '{p}', {r.group}) AS g, string_split_regex(t, '{p}') AS b FROM d WHERE regexp_matches(t, '{p}')"""

    base = ", ".join(f"'{r.kind}'" for r in secrets.RULES if r.base)
    counts = ", ".join(f"CAST(count(*) FILTER (WHERE kind = '{r.kind}') AS BIGINT) AS n_{r.kind}" for r in secrets.RULES if r.base)
    least = " ".join(f"WHEN '{r.kind}' THEN {r.least}" for r in secrets.RULES)
    return f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS n, coalesce(text, '') AS t FROM documents),
k AS ({' UNION ALL '.join(kind(i, r) for i, r in enumerate(secrets.RULES))}),
e AS (SELECT doc_id, n, ord, kind, m, g, b, unnest(range(1, len(m) + 1)) AS i FROM k),
s AS (SELECT doc_id, n, ord, kind, length(m[i]) AS w,
    CAST(list_sum(list_transform(b[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS a
  FROM e WHERE length(g[i]) >= CASE kind {least} END),
x AS (SELECT n, {counts},
    coalesce(string_agg(kind || ':' || a || ':' || (a + w), ',' ORDER BY a, ord) FILTER (WHERE kind IN ({base})), '') AS base,
    string_agg(kind || ':' || a || ':' || (a + w), ',' ORDER BY a, ord) AS spans FROM s GROUP BY n)
SELECT doc_id, {', '.join(f'coalesce(n_{r.kind}, 0) AS n_{r.kind}' for r in secrets.RULES if r.base)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN x USING (n)"""


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits().alias("fingerprint"), "component_id")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    xs = whitening.whole_numbers(_table(spark, sf_dir, "embeddings"))
    return whitening.whiten(xs, whitening.fit_whitening(xs, 4), 4)


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.fit_lines(docs, _table(spark, sf_dir, "labels")))


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def _op13_sql() -> str:
    def words(table: str) -> str:
        text = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        return f"list_filter(string_split_regex(coalesce({text}, ''), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM {table}"

    # the checksum of a word from its bytes: the table of all 256 remainders, then a byte after the other
    step = "CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"
    return f"""
WITH RECURSIVE r(b, k, c) AS (SELECT range, 0, range::UBIGINT FROM range(256) UNION ALL SELECT b, k + 1, {step} FROM r WHERE k < 8),
tab AS (SELECT list(c ORDER BY b) AS t FROM r WHERE k = 8),
d AS (SELECT doc_id, row_number() OVER () AS n, {words('documents')}),
e AS (SELECT {words('benchmark')}),
dw AS (SELECT n, unnest(w) AS word FROM d),
ew AS (SELECT unnest(w) AS word FROM e),
voc AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM dw UNION SELECT word FROM ew)),
crc AS (SELECT word, xor(list_reduce(list_transform(range(1, length(h) // 2 + 1), lambda i: ('0x' || substr(h, 2 * i - 1, 2))::UBIGINT),
    lambda c, x: xor(c // 256, t[((xor(c, x) & 255) + 1)::BIGINT]), 4294967295::UBIGINT), 4294967295::UBIGINT) % 10000 AS bucket FROM voc, tab),
s AS (SELECT bucket, count(*) AS s FROM dw JOIN crc USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM ew JOIN crc USING (word) GROUP BY bucket),
tot AS (SELECT (SELECT count(*) FROM dw) AS sa, (SELECT count(*) FROM ew) AS ta),
g AS (SELECT s.bucket, floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * (sa + 10000.0::DOUBLE) / ((s + 1.0::DOUBLE) * (ta + 10000.0::DOUBLE))))::BIGINT AS g FROM s LEFT JOIN t USING (bucket), tot),
w AS (SELECT n, count(*) AS f, sum(g) AS total FROM dw JOIN crc USING (word) JOIN g USING (bucket) GROUP BY n),
x AS (SELECT doc_id, n, coalesce(f, 0) AS n_features, CASE WHEN f IS NULL THEN 0 ELSE ((total - ((total % f + f) % f)) // f)::BIGINT END AS weight,
    floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::UBIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS noise FROM d LEFT JOIN w USING (n)),
k AS (SELECT n, row_number() OVER (ORDER BY weight + noise DESC, doc_id NULLS LAST, n) AS k, count(*) OVER () AS c FROM x WHERE n_features >= 20)
SELECT doc_id, n_features, weight, weight + noise AS score, CASE WHEN k <= 10 * c // 100 THEN k END AS rank FROM x LEFT JOIN k USING (n)"""


QUERIES = {f.__name__: f for f in (op1_hnsw, op2_lm_scoring, op3_decontaminate, op4_sentencepiece, op5_language_id, op6_license_scans, op7_url_filters, op8_secret_scans, op9_toxicity, op10_simhash, op11_whitening, op12_quality_rules, op13_resample)}
ORACLE_SQL = {"op3_decontaminate": _op3_sql(), "op7_url_filters": _op7_sql(), "op8_secret_scans": _op8_sql(), "op13_resample": _op13_sql()}
