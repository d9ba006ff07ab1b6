"""One query per operator over the whole tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwatch.llm import (
    decontaminate,
    hosts,
    lines,
    nbsvm,
    packing,
    pii,
    planes,
    repair,
    rules,
    simhash,
    spelling,
    units,
    warc,
)
from cellwatch.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file() -> str:
    """The public byte-level BPE file; the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


OP1_SQL = r"""
WITH w AS (
  SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark),
s AS (
  SELECT DISTINCT item_id, least(len(w), 5) AS k,
         unnest([array_to_string(w[i : i + least(len(w), 5) - 1], ' ') FOR i IN range(1, len(w) - least(len(w), 5) + 2)]) AS s
  FROM w WHERE len(w) > 0),
items AS (SELECT *, count(*) OVER (PARTITION BY item_id) AS n FROM s),
d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
ds AS (
  SELECT DISTINCT doc_id, unnest([array_to_string(w[i : i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS s
  FROM d, (SELECT DISTINCT k FROM s)),
f AS (SELECT doc_id, item_id, n, count(*) AS n_found FROM ds JOIN items USING (s) GROUP BY ALL)
SELECT doc_id, item_id, n AS n_shingles, n_found, n_found / n AS containment
FROM f WHERE n_found >= ceil(0.8 * n - 1e-9)"""


@query("op1_decontamination", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP2_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS l
  FROM t),
win AS (
  SELECT doc_id, unnest(range(1, len(w) - 6)) AS p, unnest([array_to_string(w[i : i + 7], ' ') FOR i IN range(1, len(w) - 6)]) AS v
  FROM m WHERE len(w) >= 8),
twice AS (SELECT doc_id, p FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, v) > 1),
gaps AS (SELECT doc_id, least(8, lead(p, 1, p + 8) OVER (PARTITION BY doc_id ORDER BY p) - p) AS g FROM twice),
rep AS (SELECT doc_id, CAST(sum(g) AS BIGINT) AS n FROM gaps GROUP BY doc_id),
c AS (
  SELECT m.doc_id, len(w) AS n_words, CAST(coalesce(list_sum([length(x) FOR x IN w]), 0) AS BIGINT) AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         coalesce(rep.n, 0) AS n_repeat_words, len(l) AS n_lines,
         len(regexp_extract_all(t, '!')) AS n_exclamations, len(regexp_extract_all(t, '\p{Lu}')) AS n_capitals,
         len([i FOR i IN range(2, len(w) + 1) IF w[i] = w[i - 1]]) AS n_same_words
  FROM m LEFT JOIN rep ON m.doc_id = rep.doc_id),
f AS (
  SELECT *, CAST((n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT + 4 * (10 * n_symbols > 3 * n_words)::INT
           + 8 * (2 * n_dup_lines > n_lines)::INT + 16 * (word_chars < 2 * n_words)::INT
           + 32 * (word_chars > 20 * n_words)::INT + 64 * (10 * n_exclamations > 3 * n_words)::INT
           + 128 * (2 * n_capitals > word_chars)::INT + 256 * (10 * n_same_words > 3 * n_words)::INT AS BIGINT) AS failures
  FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failures & 3) <> 0 AS base_failed,
       failures = 0 AS kept, failures, 'standard-1' AS policy
FROM f"""


@query("op2_quality_rules", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rules.ledger(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        rules.fails(rules.BASE).alias("base_failed"),
        (~rules.fails(rules.STANDARD)).alias("kept"),
        "failures",
        F.lit(rules.STANDARD.version).alias("policy"),
    )


@query("op3_substring_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = units.repeated_units(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "begin", "end", "n_words", "digest", "kept_doc_id", "kept_begin", "n_occurrences")


@query("op4_token_planes")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = planes.write_ids(table(spark, sf_dir, "documents"), scratch_path(spark, "ids"), tokenizer_file())
    return planes.read_documents(spark, files)


@query("op5_simhash")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def crawl_records(pages: DataFrame) -> DataFrame:
    """Two records per page: its full response, and a later not-modified answer.

    Times, and which validators the second record has, follow from the page's
    number: the same tag, a weak one, only a date, or a tag of other content.
    """
    day = "EEE, dd MMM yyyy HH:mm:ss 'GMT'"
    rows = pages.select(
        F.col("page_id").alias("p"),
        "url",
        F.md5(F.coalesce("html", F.lit(""))).alias("digest"),
        F.length(F.coalesce("html", F.lit(""))).alias("size"),
    ).withColumns(
        {
            "t": F.lit(1704067200) + F.col("p") * 60,
            "again": F.lit(1704067200) + F.col("p") * 60 + (F.col("p") * 7919 % 1000 - 50) * 60,
            "shape": F.col("p") % 4,
            "tag": F.concat(F.lit('"'), F.substring("digest", 1, 16), F.lit('"')),
        }
    )
    date = F.date_format(F.timestamp_seconds(F.col("t") - 3600), day)
    full = rows.select(
        (F.col("p") * 2).alias("record_id"),
        F.lit("response").alias("kind"),
        "url",
        F.col("t").alias("ts"),
        F.col("tag").alias("etag"),
        date.alias("last_modified"),
        F.create_map(
            F.lit("Content-Type"), F.lit("text/html; charset=utf-8"),
            F.lit("Content-Length"), F.col("size").cast("string"),
            F.lit("Cache-Control"), F.lit("max-age=60"),
            F.lit("Date"), F.date_format(F.timestamp_seconds("t"), day),
        ).alias("headers"),
        F.col("digest").alias("payload_digest"),
    )
    revisit = rows.select(
        (F.col("p") * 2 + 1).alias("record_id"),
        F.lit("revisit").alias("kind"),
        "url",
        F.col("again").alias("ts"),
        F.when(F.col("shape") == 0, F.col("tag"))
        .when(F.col("shape") == 1, F.concat(F.lit("W/"), F.col("tag")))
        .when(F.col("shape") == 3, F.lit('"other"'))
        .alias("etag"),
        F.when(F.col("shape") == 2, date).alias("last_modified"),
        F.create_map(
            F.lit("content-length"), F.lit("0"),
            F.lit("Content-Type"), F.lit("text/plain"),
            F.lit("cache-control"), F.concat(F.lit("max-age="), (F.col("p") % 100).cast("string")),
            F.lit("DATE"), F.date_format(F.timestamp_seconds("again"), day),
            F.lit("X-Cache"), F.lit("hit"),
        ).alias("headers"),
        F.lit(None).cast("string").alias("payload_digest"),
    )
    return full.unionByName(revisit)


OP6_SQL = r"""
WITH c AS (
  SELECT page_id AS p, regexp_replace(regexp_replace(url, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS c,
         md5(coalesce(html, '')) AS digest, length(coalesce(html, '')) AS size,
         1704067200 + page_id * 60 AS t, 1704067200 + page_id * 60 + (page_id * 7919 % 1000 - 50) * 60 AS again,
         '"' || substr(md5(coalesce(html, '')), 1, 16) || '"' AS tag
  FROM pages),
k AS (
  SELECT *, regexp_replace(lower(regexp_extract(c, '^([^/?]*)', 1)), '^www\.|:(80|443)$', '', 'g')
    || regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_extract(c, '^[^/?]*(.*)$', 1),
         '([?&])utm_[^&]*', '\1', 'g'), '[?&]+$', ''), '([?&])&+', '\1', 'g'), '/$', '') AS canonical
  FROM c),
r AS (
  SELECT 2 * p AS record_id, true AS f, canonical, t AS ts, tag AS etag,
         strftime(make_timestamp((t - 3600) * 1000000), '%a, %d %b %Y %H:%M:%S GMT') AS lm,
         digest, size, p FROM k
  UNION ALL
  SELECT 2 * p + 1, false, canonical, again,
         CASE p % 4 WHEN 0 THEN tag WHEN 1 THEN 'W/' || tag WHEN 3 THEN '"other"' END,
         CASE p % 4 WHEN 2 THEN strftime(make_timestamp((t - 3600) * 1000000), '%a, %d %b %Y %H:%M:%S GMT') END,
         NULL, NULL, p FROM k),
j AS (
  SELECT v.record_id, v.p, v.canonical, v.ts, v.etag, v.lm, s.record_id AS rid, s.etag AS setag, s.lm AS slm, s.digest, s.size
  FROM r v LEFT JOIN r s ON s.f AND s.canonical = v.canonical AND s.ts < v.ts
  WHERE NOT v.f
  QUALIFY row_number() OVER (PARTITION BY v.record_id ORDER BY s.ts DESC NULLS LAST, s.record_id DESC) = 1),
st AS (
  SELECT *, CASE WHEN rid IS NULL THEN 'no_earlier_response'
                 WHEN etag IS NOT NULL THEN CASE WHEN regexp_replace(etag, '^W/', '') = setag THEN 'resolved' ELSE 'validator_mismatch' END
                 WHEN lm IS NOT NULL THEN CASE WHEN lm = slm THEN 'resolved' ELSE 'validator_mismatch' END
                 ELSE 'no_validator' END AS status
  FROM j)
SELECT record_id, record_id // 2 AS page_id, canonical, ts, status, rid AS response_id, rid // 2 AS response_page_id,
       CASE WHEN status = 'resolved' THEN 'cache-control: max-age=' || (p % 100) || chr(10) || 'content-length: ' || size || chr(10)
         || 'content-type: text/html; charset=utf-8' || chr(10)
         || 'date: ' || strftime(make_timestamp(ts * 1000000), '%a, %d %b %Y %H:%M:%S GMT') || chr(10) || 'x-cache: hit' END AS headers,
       CASE WHEN status = 'resolved' THEN digest END AS payload_digest
FROM st"""


@query("op6_revisits", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.resolved_revisits(crawl_records(table(spark, sf_dir, "pages")))
    return found.select(
        "record_id",
        F.floor(F.col("record_id") / 2).alias("page_id"),
        "canonical",
        "ts",
        "status",
        "response_id",
        F.floor(F.col("response_id") / 2).alias("response_page_id"),
        F.array_join(F.transform("headers", lambda h: F.concat(h["key"], F.lit(": "), h["value"])), "\n").alias("headers"),
        "payload_digest",
    )


LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP7_SQL = rf"""
WITH l AS (
  SELECT doc_id, unnest(range(0, len(string_split(coalesce(text, ''), chr(10))))) AS i,
         unnest(string_split(coalesce(text, ''), chr(10))) AS l
  FROM documents),
k AS (
  SELECT *, translate(regexp_replace(regexp_replace(l, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''), {LETTERS}) AS k
  FROM l),
common AS (SELECT k FROM k WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT k.*, c.k IS NOT NULL AS gone FROM k LEFT JOIN common c ON k.k = c.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id"""


@query("op7_line_dedup", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.drop_common_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op8_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"), tokenizer_file())


@query("op9_quality_classifier")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return nbsvm.scored(documents, nbsvm.learn(documents, table(spark, sf_dir, "labels")))


URL_RULES = (
    hosts.UrlRule("com/", "allow"),
    hosts.UrlRule("example.com/en/", "block"),
    hosts.UrlRule("www.example.com/en/", "allow"),
    hosts.UrlRule("net/es/", "block"),
    hosts.UrlRule("net/fr/", "block"),
)


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """host and bad of the pages whose path ends in the number of a labelled document.

    A page is bad if its document is of quality 0 or toxic.
    """
    known = (
        labels.filter("doc_id is not null")
        .groupBy("doc_id")
        .agg(F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)).alias("bad"))
    )
    number = F.regexp_extract(hosts.path_of(F.col("url")), "([0-9]+)(?:\\.html)?/?$", 1).try_cast("long")
    return pages.select(hosts.host_of(F.col("url")).alias("host"), number.alias("doc_id")).join(known, "doc_id").select("host", "bad")


OP10_SQL = rf"""
WITH p AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), {LETTERS}) AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
lab AS (
  SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
o AS (
  SELECT host, bad FROM p JOIN lab ON lab.doc_id = TRY_CAST(nullif(regexp_extract(path, '([0-9]+)(?:\.html)?/?$', 1), '') AS BIGINT)),
h AS (
  SELECT host, coalesce(n, 0) AS n, coalesce(x, 0) AS x, array_to_string(string_split(host, '.')[-2:], '.') AS two,
         string_split(host, '.')[-1] AS one, array_to_string(string_split(host, '.')[-3:], '.') AS three
  FROM (SELECT DISTINCT host FROM p) LEFT JOIN (SELECT host, count(*) AS n, CAST(sum(bad) AS BIGINT) AS x FROM o GROUP BY host) USING (host)),
e AS (
  SELECT host, n, x, CASE WHEN two IN {hosts.LONG_SUFFIXES} THEN two ELSE one END AS suffix,
         CASE WHEN two IN {hosts.LONG_SUFFIXES} THEN three ELSE two END AS domain
  FROM h),
s AS (SELECT suffix, sum(n) AS n, sum(x) AS x FROM e GROUP BY suffix),
d AS (SELECT domain, suffix, sum(n) AS n, sum(x) AS x FROM e GROUP BY ALL),
g AS (
  SELECT 's' AS level, n::DOUBLE AS n, x::DOUBLE AS x FROM s WHERE n > 0 UNION ALL
  SELECT 'd', n, x FROM d WHERE n > 0 UNION ALL SELECT 'h', n, x FROM e WHERE n > 0),
a AS (SELECT level, count(*) AS g, sum(n) AS n, sum(x) AS x, sum(n * n) AS nn, sum(x * x / n) AS xx FROM g GROUP BY level),
rho AS (
  SELECT level, g, n, x, ((xx - x * x / n) / ((x / n) * (1 - x / n)) - (g - 1)) / nullif(greatest(n - nn / n - (g - 1), 0), 0) AS rho FROM a),
k AS (
  SELECT level, CASE WHEN g < 2 OR x <= 0 OR x >= n OR coalesce(rho, 0) <= 1 / 10001.0::DOUBLE THEN 1e4::DOUBLE
                     ELSE greatest(1.0::DOUBLE, 1 / rho - 1) END AS k FROM rho),
c AS (
  SELECT coalesce((SELECT k FROM k WHERE level = 's'), 1.0::DOUBLE) AS ks, coalesce((SELECT k FROM k WHERE level = 'd'), 1.0::DOUBLE) AS kd,
         coalesce((SELECT k FROM k WHERE level = 'h'), 1.0::DOUBLE) AS kh,
         ((SELECT coalesce(sum(x), 0) FROM s)::DOUBLE + 0.5::DOUBLE) / ((SELECT coalesce(sum(n), 0) FROM s)::DOUBLE + 1) AS mean),
ps AS (SELECT suffix, (x + mean * ks) / (n + ks) AS ps FROM s, c),
pd AS (SELECT domain, (x + ps * kd) / (n + kd) AS pd FROM d JOIN ps USING (suffix), c),
b AS (SELECT host, n, x, x + pd * kh AS a, n - x + (1 - pd) * kh AS b FROM e JOIN pd USING (domain), c),
v AS (SELECT host, n, x, a / (a + b) - 1.645::DOUBLE * sqrt((a / (a + b)) * (1 - a / (a + b)) / (a + b + 1)) AS bound FROM b),
r AS (
  SELECT p.*, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM p)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN bound > 0.5 THEN 'block' ELSE 'allow' END AS verdict, n AS n_labelled, x AS n_bad
FROM r JOIN v USING (host)"""


@query("op10_host_reputation", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return hosts.judged(pages, page_outcomes(pages, table(spark, sf_dir, "labels")), URL_RULES)


# CRC-32 in SQL: the table of its polynomial, and the checksum of a list of bytes.
CRC_SQL = """crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda r, k: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END)) AS tab)"""


def crc_of(bytes_list: str) -> str:
    return (
        f"xor(list_reduce(list_prepend(4294967295, {bytes_list}), "
        "lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)"
    )


# Code points up to U+00FF as UTF-8: one byte or two.
_BYTES = (
    "flatten(list_transform(string_split(x, ''), lambda y: CASE WHEN ord(y) < 128 THEN [ord(y)::BIGINT] "
    "ELSE [(192 + (ord(y) >> 6))::BIGINT, (128 + (ord(y) & 63))::BIGINT] END))"
)

OP11_SQL = rf"""
WITH RECURSIVE {CRC_SQL},
r AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d,
         unnest(regexp_extract_all(translate(text, {LETTERS}), '[A-Za-z\x{{C0}}-\x{{FF}}]{{7,}}')) AS w
  FROM documents),
x AS (SELECT w, d || ':' || w AS x FROM r),
h AS (SELECT w, {crc_of(_BYTES)} AS h FROM x, crc),
c AS (SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS w FROM h),
v AS (SELECT w AS word, count(*) AS n FROM c WHERE length(w) >= 7 GROUP BY w HAVING count(*) >= 2),
g AS (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v),
less AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS s FROM g),
near AS (
  SELECT DISTINCT * FROM (
    SELECT a.word, b.word AS near FROM less a JOIN less b ON a.s = b.s AND a.i = b.i AND a.word <> b.word
    UNION ALL SELECT a.word, b.word FROM less a JOIN v b ON a.s = b.word
    UNION ALL SELECT b.word, a.word FROM less a JOIN v b ON a.s = b.word)),
best AS (
  SELECT near.word, v.word AS form, v.n AS form_n, count(*) OVER (PARTITION BY near.word) AS n_near
  FROM near JOIN v ON near.near = v.word
  QUALIFY row_number() OVER (PARTITION BY near.word ORDER BY v.n DESC, v.word) = 1),
f AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * v.n THEN form END AS form,
         CASE WHEN form_n >= 10 * v.n THEN form_n END AS form_n
  FROM v LEFT JOIN best ON v.word = best.word),
steps AS (
  SELECT word, form AS at FROM f WHERE form IS NOT NULL
  UNION ALL SELECT s.word, f.form FROM steps s JOIN f ON s.at = f.word AND f.form IS NOT NULL),
roots AS (SELECT s.word, s.at AS root FROM steps s JOIN f ON s.at = f.word AND f.form IS NULL)
SELECT f.word, form, coalesce(root, f.word) AS root, n, n_near, form_n FROM f LEFT JOIN roots ON f.word = roots.word"""


def mangled_words(docs: DataFrame, least: int = 7) -> DataFrame:
    """word: the lower-cased runs of all texts; a checksum takes one letter out of every 31st, for spelling errors to be there."""
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("d"),
        F.explode(spelling.lower_runs(F.col("text"), least)).alias("run"),
    ).withColumn("h", F.crc32(F.concat("d", F.lit(":"), "run")))
    without = F.expr("concat(substring(run, 1, int(h % length(run))), substring(run, int(h % length(run)) + 2))")
    return runs.select(F.when(F.col("h") % 31 == 0, without).otherwise(F.col("run")).alias("word"))


@query("op11_spelling_variants", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = spelling.word_counts(mangled_words(table(spark, sf_dir, "documents")))
    return spelling.variant_groups(counts)


def span_list(found: Column, base_only: bool = False) -> Column:
    """kind:start:end of spans as listed, comma-joined."""
    rows = F.filter(found, lambda s: s["base"]) if base_only else found
    return F.array_join(F.transform(rows, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@query("op12_personal_data")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.with_spans(docs.select("doc_id", "text"), pii.learn(docs)).drop("text")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(k) for k in pii.KINDS],
        F.sha2(span_list(F.col("spans"), True), 256).alias("base_sha256"),
        span_list(F.col("spans")).alias("spans"),
    )


OP13_SQL = rf"""
WITH RECURSIVE {CRC_SQL},
x AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS x
  FROM conversations),
h AS (SELECT *, {crc_of(_BYTES)} % 20 AS h FROM x, crc),
d AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role, unnest(range(CASE WHEN h = 3 THEN 2 ELSE 1 END)) AS again,
         CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM h WHERE h <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), again) AS i FROM d),
m AS (
  SELECT *, substr(role, 1, 1) AS k, NOT regexp_matches(text, '[^ 	-
]') AS blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again2,
         regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) NOT IN ('.', '!', '?') AS cut,
         lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM o),
t AS (
  SELECT *, NOT blank AND again2 AS dup, blank OR again2 AS must, (NOT blank AND NOT again2 AND cut)::INT AS t FROM m),
n AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate, CAST(sum(t) AS BIGINT) AS truncated,
         count(*) FILTER (before || k NOT IN ('su', 'ua', 'au')) AS illegal
  FROM t GROUP BY conv_id),
g AS (
  SELECT conv_id, n + 1 AS i, 0 AS c0, 4 AS c1, 2 AS c2, 0 AS c3 FROM n
  UNION ALL
  SELECT conv_id, i, least(g0, 2 + least(g2, 2 + g3)), least(g1, 2 + least(g2, 2 + g3)), least(g2, 2 + g3), least(g3, 2 + g2)
  FROM (
    SELECT t.conv_id, t.i,
           least(3 + c0, CASE WHEN NOT must THEN least(2 + t + c2, CASE k WHEN 's' THEN t + c1 WHEN 'u' THEN t + c2 END) END) AS g0,
           least(3 + c1, CASE WHEN NOT must THEN least(2 + t + c2, CASE k WHEN 'u' THEN t + c2 END) END) AS g1,
           least(3 + c2, CASE WHEN NOT must THEN least(2 + t + c3, CASE k WHEN 'a' THEN t + c3 END) END) AS g2,
           least(3 + c3, CASE WHEN NOT must THEN least(2 + t + c2, CASE k WHEN 'u' THEN t + c2 END) END) AS g3
    FROM g JOIN t ON t.conv_id = g.conv_id AND t.i = g.i - 1)),
c AS (
  SELECT conv_id, i, unnest([c0, c1, c2, c3]) AS c, unnest([0, 1, 2, 3]) AS q FROM g),
-- Every state with its next letter; q2 is the state after it.
e AS (
  SELECT h.conv_id, h.i, h.q, arg_min(a, l) AS a, min(l) AS l FROM (
    SELECT c.conv_id, c.i, c.q, c.c, t.t, t.must, t.k, t.role, t.text, unnest(['D', 'I', 'K', 'R']) AS l
    FROM c LEFT JOIN t ON t.conv_id = c.conv_id AND t.i = c.i) h,
    LATERAL (SELECT CASE l WHEN 'D' THEN q WHEN 'K' THEN CASE k WHEN 's' THEN CASE q WHEN 0 THEN 1 END
                 WHEN 'u' THEN CASE WHEN q <> 2 THEN 2 END WHEN 'a' THEN CASE q WHEN 2 THEN 3 END END
               ELSE CASE q WHEN 2 THEN 3 ELSE 2 END END AS q2,
             CASE l WHEN 'D' THEN 3 WHEN 'I' THEN 2 WHEN 'K' THEN CASE WHEN NOT must THEN t END
               ELSE CASE WHEN NOT must THEN 2 + t END END AS cost) s,
    LATERAL (SELECT q2, CASE l WHEN 'I' THEN h.i ELSE h.i + 1 END AS i2,
             CASE l WHEN 'D' THEN NULL WHEN 'K' THEN role || ':' || text
               ELSE CASE q2 WHEN 2 THEN 'user:' ELSE 'assistant:' END || CASE l WHEN 'R' THEN text ELSE '' END END AS line) a
    JOIN c c2 ON c2.conv_id = h.conv_id AND c2.i = i2 AND c2.q = s.q2
  WHERE h.c = cost + c2.c GROUP BY ALL),
w AS (
  SELECT conv_id, 1::BIGINT AS i, 0 AS q, '' AS audit, CAST([] AS VARCHAR[]) AS lines FROM n
  UNION ALL
  SELECT w.conv_id, a.i2, a.q2, audit || l, CASE WHEN a.line IS NULL THEN lines ELSE list_append(lines, a.line) END
  FROM w JOIN e ON e.conv_id = w.conv_id AND e.i = w.i AND e.q = w.q),
z AS (SELECT w.* FROM w JOIN n ON n.conv_id = w.conv_id AND w.i = n.n + 1 WHERE q IN (0, 3))
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(c0, 0) AS BIGINT) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN n ON n.conv_id = a.conv_id
  LEFT JOIN z ON z.conv_id = a.conv_id LEFT JOIN g ON g.conv_id = a.conv_id AND g.i = 1"""


@query("op13_conversation_repair", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair.repairs(repair.damaged(conversations), conversations.select("conv_id"))
