"""The registered queries of this folder, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path as vocabulary
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillweave.llm.context_mixing import score_texts
from tillweave.llm.decontamination import decontaminate
from tillweave.llm.fill_middle import fill_in_middle, restored
from tillweave.llm.near_copies import near_copies
from tillweave.llm.packing import pack
from tillweave.llm.planes import read_ids, write_ids
from tillweave.llm.quality import judge
from tillweave.llm.repeats import remove_repeats
from tillweave.llm.source_mix import mix
from tillweave.llm.term_scan import rank_documents
from tillweave.llm.token_counts import count_tokens
from tillweave.llm.toxicity import fit, score
from tillweave.llm.url_filters import host_of, judge_urls, segments_of
from tillweave.operators.materialize import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

WORDS_49K = "word_bpe_49k.json"


def _query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@_query
def op1_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    """Documents whose sets of 5-word shingles are similar to 0.8 or more: classes and numbers of links."""
    return near_copies(table(spark, sf, "documents")).drop("row")


@_query
def op2_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens of every document, and whether they exceed a context of 2048."""
    counted = count_tokens(table(spark, sf, "documents"), vocabulary(WORDS_49K))
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)


@_query
def op10_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Words of every document that lie in 10-word windows of the benchmark, and the items they come from."""
    found = decontaminate(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["begin"])
    items = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        "spans",
        "items",
    )


def _number(text: str, at: int) -> Column:
    """A number below 2**24 from a text's MD5, the same in both engines."""
    return F.conv(F.substring(F.md5(text), at, 6), 16, 10).cast("long")


def url_list(pages: DataFrame) -> DataFrame:
    """Dated entries (kind, pattern, action, day) that half of the pages, chosen by their URL, bring to the list."""
    host, path = host_of(F.col("url")), segments_of(F.col("url"))
    kind = F.element_at(F.array(F.lit("domain"), F.lit("host"), F.lit("prefix")), (_number("url", 7) % 3 + 1).cast("int"))
    chosen = pages.where(_number("url", 1) % 2 == 0).select(kind.alias("kind"), host.alias("host"), path.alias("path"), "url")
    prefix = F.concat_ws("/", F.concat(F.array("host"), F.slice("path", 1, 1)))
    return chosen.where((F.col("kind") != "prefix") | (F.size("path") > 0)).select(
        "kind",
        F.when(F.col("kind") == "prefix", prefix).otherwise(F.col("host")).alias("pattern"),
        F.element_at(
            F.array(F.lit("block"), F.lit("allow"), F.lit("remove")), (_number("url", 13) % 3 + 1).cast("int")
        ).alias("action"),
        F.date_add(F.lit("2024-01-01").cast("date"), (_number("url", 19) % 365).cast("int")).alias("day"),
    )


@_query
def op3_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    """Every page judged by the list entries in force on the day of its capture.

    The tables have no capture times and no lists: both are derived from the pages, whole tables, by hashes.
    """
    pages = table(spark, sf, "pages").select("page_id", "url")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") * 37 % 365).cast("int"))
    return judge_urls(pages.withColumn("day", day), url_list(pages))


ORACLE["op3_url_filters"] = """
WITH n AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(page_id * 37 % 365 AS INTEGER) AS day, md5(url) AS m,
         nullif(rtrim(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1), '.'), '') AS host,
         list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1), '/'), lambda x: x <> '')
           AS path
  FROM pages
),
numbers AS (
  SELECT *, CAST('0x' || substr(m, 1, 6) AS BIGINT) AS a, CAST('0x' || substr(m, 7, 6) AS BIGINT) AS b,
         CAST('0x' || substr(m, 13, 6) AS BIGINT) AS c, CAST('0x' || substr(m, 19, 6) AS BIGINT) AS d
  FROM n
),
entries AS (
  SELECT CASE b % 3 WHEN 0 THEN 'domain' WHEN 1 THEN 'host' ELSE 'prefix' END AS kind,
         CASE WHEN b % 3 = 2 THEN host || '/' || path[1] ELSE host END AS pattern,
         2 - c % 3 AS rank, DATE '2024-01-01' + CAST(d % 365 AS INTEGER) AS since
  FROM numbers WHERE a % 2 = 0 AND (b % 3 < 2 OR len(path) > 0)
),
daily AS (
  SELECT kind, pattern, since, max(rank) AS rank FROM entries
  WHERE kind IS NOT NULL AND pattern IS NOT NULL GROUP BY ALL
),
spans AS (SELECT *, lead(since) OVER (PARTITION BY kind, pattern ORDER BY since) AS until FROM daily),
labels AS (SELECT *, string_split(host, '.') AS l FROM n WHERE host IS NOT NULL),
asked AS (
  SELECT page_id, day, 'domain' AS kind, array_to_string(l[len(l) - i + 1:], '.') AS pattern, i AS weight
  FROM (SELECT *, unnest(range(1, len(l) + 1)) AS i FROM labels)
  UNION ALL SELECT page_id, day, 'host', host, 999 FROM labels
  UNION ALL SELECT page_id, day, 'prefix', host || '/' || path[1], 1001 FROM labels WHERE len(path) > 0
),
found AS (
  SELECT page_id, kind, pattern, since, CASE rank WHEN 2 THEN 'block' WHEN 1 THEN 'allow' END AS action
  FROM asked JOIN spans USING (kind, pattern)
  WHERE day >= since AND (until IS NULL OR day < until) AND rank > 0
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY weight DESC) = 1
)
SELECT n.page_id, n.host, n.day, found.action, found.kind, found.pattern, found.since
FROM n LEFT JOIN found USING (page_id)"""


@_query
def op4_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Toxicity of every document, learned from the labelled ones that are not held out."""
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    docs = table(spark, sf, "documents")
    model = fit(docs, table(spark, sf, "labels"), usable=fold != 0)
    scored = score(docs, model)
    return scored.select(
        "doc_id", (fold == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@_query
def op5_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Every piece of every document, and its place in a sequence of 2048 tokens."""
    return pack(table(spark, sf, "documents"), vocabulary(WORDS_49K))


@_query
def op6_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of every document, and whether it is kept after its own rules and those on lines its source repeats."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judge(table(spark, sf, "documents")).select("doc_id", *names, "n_common_words")


@_query
def op7_plane_files(spark: SparkSession, sf: str) -> DataFrame:
    """Every document as read back from files of byte planes."""
    folder = scratch_path(spark, "op7")
    write_ids(table(spark, sf, "documents"), folder, vocabulary(WORDS_49K))
    return read_ids(spark, folder, "long", ids=False)


@_query
def op8_context_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """Unigram and context-mixing log probabilities of every document, learned from those not held out."""
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    scored = score_texts(table(spark, sf, "documents"), training=fold != 1)
    names = ["n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte"]
    return scored.select("doc_id", (fold == 1).alias("held_out"), *names)


@_query
def op9_repeated_spans(spark: SparkSession, sf: str) -> DataFrame:
    """What is left of every document without the 35-word windows that occur anywhere else."""
    kept = remove_repeats(table(spark, sf, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@_query
def op11_fill_in_middle(spark: SparkSession, sf: str) -> DataFrame:
    """Every document cut and rearranged for fill-in-middle training, and what its output is restored to."""
    done = restored(fill_in_middle(table(spark, sf, "documents")))
    return done.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


ORACLE["op11_fill_in_middle"] = """
WITH numbered AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
),
drawn AS (
  SELECT doc_id, t, n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS a,
         CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS b,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                   OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
              WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM numbered
),
parts AS (
  SELECT *, substr(t, 1, least(a, b)) AS p, substr(t, least(a, b) + 1, abs(a - b)) AS m, substr(t, greatest(a, b) + 1) AS s
  FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN least(a, b) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN abs(a - b) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts"""


@_query
def op12_ranked_search(spark: SparkSession, sf: str) -> DataFrame:
    """The ten documents that suit each benchmark item best by the terms they share."""
    return rank_documents(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


ORACLE["op12_ranked_search"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
),
lengths AS (SELECT doc_id, CAST(len(terms) AS BIGINT) AS n FROM d WHERE len(terms) > 0),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
asked AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY item_id, term
),
found AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term
),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM found, totals GROUP BY term, docs
),
scored AS (
  SELECT item_id, doc_id,
         CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // totals.terms)))) AS BIGINT) AS score
  FROM asked JOIN found USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), totals
  GROUP BY item_id, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 10"""


@_query
def op13_source_mix(spark: SparkSession, sf: str) -> DataFrame:
    """How often a mix of the sources, weighed 5, 2, 1 in turn, takes every document, three times at most."""
    mixed = mix(table(spark, sf, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


ORACLE["op13_source_mix"] = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents
),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST([5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS w
  FROM d GROUP BY source
),
ordered AS (
  SELECT *, sum(source_size) OVER () AS whole, 3 * source_size / w AS closes,
         coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / w, source NULLS LAST
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS given,
         sum(w) OVER (ORDER BY 3 * source_size / w, source NULLS LAST
                      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share
  FROM sources
),
unit AS (SELECT max(CAST(whole - given AS DOUBLE) / share) AS unit FROM ordered WHERE (whole - given) / share <= closes),
aims AS (
  SELECT source, source_size, CASE WHEN unit * w <= 3 * source_size THEN unit * w ELSE 3 * source_size END AS target
  FROM sources, unit
),
numbered AS (
  SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
         CAST('0x' || substr(md5('1' || coalesce(':' || d.source, '')), 1, 4) AS BIGINT) / 65536.0 AS start,
         row_number() OVER (PARTITION BY d.source
                            ORDER BY size, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT), doc_id) AS i
  FROM d JOIN aims ON d.source IS NOT DISTINCT FROM aims.source
)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies
FROM (SELECT *, CAST(floor(i * rate + CAST(start AS DOUBLE)) - floor((i - 1) * rate + CAST(start AS DOUBLE)) AS BIGINT) AS copies
      FROM numbered)"""
