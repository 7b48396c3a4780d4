"""The queries opN_<name> over the given tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import byte_bpe, code_compression, decontaminate, exact_dedup, html_extract, language_id, ngram_join, pii, secret_scan, substring_dedup, suffix_dedup, token_alignment, url_filter
from headway.llm._common import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(run):
        QUERIES[run.__name__] = run
        if sql:
            SQL[run.__name__] = sql
        return run

    return register


def tokenizer() -> tuple[str, str]:
    """Rank file and pattern of the queries' tokenizer; the operator takes any."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@query()
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = tokenizer()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = byte_bpe.decode(byte_bpe.encode(docs, ranks, pattern), ranks)
    return both.select(
        "doc_id", byte_bpe.n_ids("ids").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    machines = language_id.fit(docs.where(~language_id.held_out()))
    found = language_id.predict(docs.select("doc_id", "text"), machines)
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


@query("""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)
""")
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query()
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


#: The rules that the query judges by.
RULES = [
    url_filter.Rule("allow", "com", "/"), url_filter.Rule("block", "example.com", "/en/"), url_filter.Rule("allow", "www.example.com", "/en/"),
    url_filter.Rule("block", "net", "/es/"), url_filter.Rule("block", "net", "/fr/"),
]


@query("""
WITH p AS (
    SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substring(url, strpos(url, '://') + 3) END AS rest FROM pages),
h AS (
    SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM p),
r AS (
    SELECT *, CASE
        WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
        WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
        WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
        WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
        WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule FROM h),
o AS (
    SELECT host, count(quality) AS n, coalesce(sum(CASE WHEN quality = 1 AND toxic = 0 THEN 1 WHEN quality IS NOT NULL THEN 0 END), 0) AS g
    FROM h LEFT JOIN labels ON page_id = doc_id AND quality IS NOT NULL AND toxic IS NOT NULL GROUP BY host),
s AS (
    SELECT *, CASE WHEN regexp_matches(host, '\\.(co\\.uk|org\\.uk|ac\\.uk|gov\\.uk|com\\.au|co\\.jp|co\\.nz|com\\.br|co\\.in|co\\.za)$')
        THEN regexp_extract(host, '([^.]*\\.[^.]*)$', 1) ELSE regexp_extract(host, '([^.]*)$', 1) END AS suffix FROM o),
d AS (
    SELECT *, CASE WHEN host = suffix THEN host
        ELSE regexp_extract(substring(host, 1, greatest(0, length(host) - length(suffix) - 1)), '([^.]*)$', 1) || '.' || suffix END AS domain FROM s),
dd AS (SELECT suffix, domain, sum(n) AS n, sum(g) AS g FROM d GROUP BY suffix, domain),
ss AS (SELECT suffix, sum(n) AS n, sum(g) AS g FROM dd GROUP BY suffix),
u AS (
    SELECT level, count(*) AS units, sum(n)::DOUBLE AS n, sum(g)::DOUBLE AS g, sum(n * n)::DOUBLE AS nn, sum(g::DOUBLE * g / n) AS gg
    FROM (SELECT 1 AS level, n, g FROM ss UNION ALL SELECT 2, n, g FROM dd UNION ALL SELECT 3, n, g FROM d) WHERE n > 0 GROUP BY level),
v AS (
    SELECT *, (gg - g * g / n) / (units - 1) AS between_, (g - gg) / (n - units) AS inside_, (n - nn / n) / (units - 1) AS size_
    FROM u WHERE units >= 2 AND n > units),
k AS (
    SELECT level, 1 / least(0.5, greatest(0.001, CASE WHEN between_ + (size_ - 1) * inside_ > 0
        THEN (between_ - inside_) / (between_ + (size_ - 1) * inside_) ELSE 0.001 END)) - 1 AS pull FROM v),
k1 AS (SELECT coalesce(max(pull), 9.0) AS pull FROM k WHERE level = 1),
k2 AS (SELECT coalesce(max(pull), 9.0) AS pull FROM k WHERE level = 2),
k3 AS (SELECT coalesce(max(pull), 9.0) AS pull FROM k WHERE level = 3),
t AS (SELECT CASE WHEN sum(n) > 0 THEN sum(g)::DOUBLE / sum(n) ELSE 0.5 END AS share FROM ss),
ps AS (SELECT suffix, (g + k1.pull * share) / (n + k1.pull) AS share FROM ss, k1, t),
pd AS (SELECT dd.suffix, domain, (g + k2.pull * ps.share) / (n + k2.pull) AS share FROM dd JOIN ps USING (suffix), k2),
ph AS (SELECT host, n, (g + k3.pull * pd.share) / (n + k3.pull) AS share, k3.pull FROM d JOIN pd USING (suffix, domain), k3),
m AS (SELECT host, share + 1.645 * sqrt(share * (1 - share) / (n + pull + 1)) AS upper_ FROM ph)
SELECT page_id, r.host AS host, path, rule, CASE
    WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN upper_ < 0.5 THEN 'block' ELSE 'allow' END AS verdict
FROM r JOIN m ON r.host = m.host
""")
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = table(spark, sf_dir, "labels").where("quality is not null and toxic is not null")
    # A label belongs to the page with its id; a good page is of good quality and not toxic.
    good = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), 1).otherwise(0).alias("good")
    outcomes = pages.join(labels, pages["page_id"] == labels["doc_id"]).select("url", good)
    return url_filter.judge(pages, RULES, outcomes).select("page_id", "host", "path", "rule", "verdict")


@query()
def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query()
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.matches(docs, table(spark, sf_dir, "benchmark"))


@query()
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    forest = secret_scan.train(secret_scan.findings(spark))
    found = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), forest)
    # The report names a secret by its hash, so that it is not spread further.
    return found.select("doc_id", F.col("nth").cast("long").alias("nth"), F.length("value").cast("long").alias("n_chars"), F.sha2("value", 256).alias("value_sha256"), "score")


@query()
def op12_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    books = code_compression.fit(rows)
    found = code_compression.with_label_error(code_compression.encode(rows, books).drop("embedding"))
    sha = books.sha256() if books else None
    return found.select("vec_id", "code", "error", "label_error", F.lit(sha).cast("string").alias("codebooks_sha256"))


@query()
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    found = token_alignment.counted(table(spark, sf_dir, "documents").select("doc_id", "text"), a, b, digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")


@query()
def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    field = pii.train(pii.findings(spark))
    found = pii.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), field)

    def joined(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(number, pii.KINDS), F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))
