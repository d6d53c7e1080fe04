"""The registered queries of this subpackage and the SQL that redoes those SQL can express."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.llm import (
    ann_tree,
    chunked_bpe,
    hard_negatives,
    licences,
    line_dedup,
    mixing,
    packing,
    pii,
    quality,
    simhash,
    token_files,
    urls,
    vector_codes,
)
from tallyhouse.llm.words import n_words
from tallyhouse.operators.windows import with_group_sum
from tallyhouse.scratch import folder as scratch_folder, keep

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", "lang")
    judged = quality.judge(docs, _table(spark, folder, "labels"))
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept")


@query
def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, folder, "documents").select("doc_id", "text"))


@query
def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    kept = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256")
    return line_dedup.deduplicate(docs).select("doc_id", "n_lines", "n_dropped", kept)


ORACLES["op6_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, i, line, lower_ascii AS key
  FROM (
    SELECT doc_id, i, string_split(coalesce(text, ''), chr(10))[i] AS line,
           translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_ascii
    FROM (SELECT doc_id, text,
                 unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS i
          FROM documents)
  )
), repeated AS (
  SELECT key, max(doc_id) AS last_doc FROM lines WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), judged AS (
  SELECT l.*, r.key IS NOT NULL AND l.doc_id <> r.last_doc AS gone
  FROM lines l LEFT JOIN repeated r USING (key)
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(gone::INT) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@query
def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "source", "text")
    units = keep(mixing.units_of(docs.withColumn("_row", F.monotonically_increasing_id())), "sizes")
    taken = (F.col("copies") * F.col("_size")).alias("taken")
    return mixing.mix(units).select(
        "doc_id", F.col("_size").alias("size"), "source_size", "target", taken, "source", "copies"
    )


@query
def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    """A document's length is its words and one end mark."""
    docs = _table(spark, folder, "documents").select("doc_id", (n_words(F.col("text")) + 1).alias("length"))
    return packing.packed(keep(docs, "lengths"))


#: In production the key comes from a secret store; this one only makes runs comparable.
PSEUDONYM_KEY = "tallyhouse-demonstration-key"


@query
def op7_pii_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return pii.pseudonymised(docs, PSEUDONYM_KEY).select("doc_id", "text", "n_replaced")


@query
def op4_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """The URLs that rules decide are the labelled ones."""
    pages = _table(spark, folder, "pages").select("page_id", "url")
    return urls.judge(pages).select("page_id", "host", "path", "rule", "verdict")


@query
def op5_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licences.scan(_table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.array_join("licence_sentences", ",").alias("licence_sentences"),
        F.array_join("licences", ",").alias("licences"),
    )


TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"


@query
def op1_token_files(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path = scratch_folder(spark, "token-files")
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    token_files.write(docs, path, public_tokenizers.path(TOKENIZER))
    return token_files.read(spark, path)


@query
def op11_chunked_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return chunked_bpe.digests(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


@query
def op2_nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings").select("vec_id", "embedding")
    return ann_tree.search(vectors, F.col("vec_id") % 100 == 0)


@query
def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    """``label_error`` is the error summed over the rows of the same label."""
    codes = vector_codes.compress(_table(spark, folder, "embeddings").select("vec_id", "embedding", "label"))
    with_label = with_group_sum(codes.rows, ["label"], "error", "label_error").drop("label")
    return with_label.withColumn("codebooks_sha256", F.lit(codes.digest()))


def _codes_sql(n_parts: int = 8, n_entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """Every round evaluates every entry for every part."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT vec_id, label, m, any_value(p) AS p, min(d * {n_entries} + k) AS near FROM (
    SELECT parts.*, k, CAST(list_dot_product(parts.p, parts.p) - 2 * list_dot_product(parts.p, e.p)
                            + list_dot_product(e.p, e.p) AS HUGEINT) AS d
    FROM parts JOIN e{r} e USING (m)
  ) GROUP BY vec_id, label, m
)""")
        if r < rounds:
            steps.append(f"""
e{r + 1} AS MATERIALIZED (
  SELECT e.m, e.k, coalesce(n.p, e.p) AS p FROM e{r} e LEFT JOIN (
    SELECT m, k, list(c ORDER BY i) AS p FROM (
      SELECT m, near % {n_entries} AS k, i, floor(sum(p[i]) / count(*)) AS c
      FROM (SELECT *, unnest(range(1, len(p) + 1)) AS i FROM a{r}) GROUP BY ALL
    ) GROUP BY m, k
  ) n ON e.m = n.m AND e.k = n.k
)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT vec_id, label, m, v[m * (len(v) // {n_parts}) + 1:(m + 1) * (len(v) // {n_parts})] AS p
  FROM kept, (SELECT unnest(range({n_parts})) AS m)
), e0 AS MATERIALIZED (
  SELECT m, row_number() OVER (PARTITION BY m ORDER BY vec_id) - 1 AS k, p FROM parts
  WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {n_entries})
), {",".join(steps)}, coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', CAST(near % {n_entries} AS INT)), '' ORDER BY m) AS code,
         CAST(sum(near // {n_entries}) AS BIGINT) AS error
  FROM a{rounds} GROUP BY vec_id, label
), books AS (
  SELECT sha256(string_agg(CAST(CAST(p[i] AS BIGINT) AS VARCHAR), ',' ORDER BY m, k, i)) AS codebooks_sha256
  FROM (SELECT *, unnest(range(1, len(p) + 1)) AS i FROM e{rounds})
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded, books
"""


ORACLES["op12_vector_codes"] = _codes_sql()


@query
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.select("vec_id", label.alias("label"), "embedding"), F.col("vec_id") % 50 == 0)


ORACLES["op13_hard_negatives"] = """
WITH kept AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM kept a JOIN kept b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INT) AS rank, n.vec_id AS negative_id,
       positive_score, n.score AS negative_score
FROM positives p JOIN scored n USING (anchor_id)
WHERE NOT n.same AND 50 * positive_score <= 100 * n.score AND 100 * n.score <= 95 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY n.score DESC, n.vec_id)
QUALIFY row_number() OVER best <= 3
"""


def _quality_sql(risk: float = 0.05, error: float = 0.05, least_catch: float = 0.1) -> str:
    """Thresholds as in ``quality``: every cutoff is tested, per language and over all tests."""
    tests = [(rule, cutoff) for rule in quality.RULES for cutoff in rule.cutoffs]
    share = risk / len(quality.RULES)
    grid = ", ".join(f"('{rule.name}', {cutoff})" for rule, cutoff in tests)
    ratios = "\n".join(
        f"WHEN '{r.name}' THEN CASE WHEN {r.denominator} > 0 THEN {r.numerator} / {r.denominator} ELSE 0 END"
        for r in quality.RULES
    )
    return rf"""
WITH worded AS (
  SELECT doc_id, lang, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), windows AS (
  SELECT doc_id, i, w[i:i+2] AS win
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM worded)
), repeats AS (
  SELECT doc_id, count(DISTINCT pos) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS pos
    FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS c FROM windows) WHERE c > 1
  ) GROUP BY doc_id
), counted AS (
  SELECT doc_id, lang, len(w) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
         coalesce(n, 0) AS n_repeat_words
  FROM worded LEFT JOIN repeats USING (doc_id)
), based AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted
), grid(rule, cutoff) AS (VALUES {grid}
), scored AS (
  SELECT doc_id, lang, base_failed, rule, cutoff, CASE rule {ratios} END AS ratio FROM based, grid
), tested AS (
  SELECT lang, rule, cutoff, count(*) FILTER (quality = 1) AS n,
         count(*) FILTER (quality = 1 AND ratio >= cutoff) AS k,
         count(*) FILTER (quality = 0) AS n_bad,
         count(*) FILTER (quality = 0 AND ratio >= cutoff) AS caught
  FROM scored JOIN labels USING (doc_id) WHERE NOT base_failed AND quality IN (0, 1) GROUP BY ALL
), tails AS (
  SELECT *, CASE WHEN n = 0 THEN 1 ELSE list_sum(list_transform(range(0, k + 1), lambda j: exp(
      lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({share}) + (n - j) * ln(1 - {share})))) END AS p
  FROM tested
), admitted AS (
  SELECT * FROM tails
  WHERE p <= {error} / ({len(tests)} * (SELECT count(DISTINCT coalesce(lang, '')) FROM tested))
    AND caught > 0 AND caught >= {least_catch} * n_bad
), chosen AS (
  SELECT lang, rule, cutoff FROM admitted
  QUALIFY row_number() OVER (PARTITION BY lang, rule ORDER BY caught DESC, cutoff DESC) = 1
), rejected AS (
  SELECT DISTINCT s.doc_id FROM scored s
  JOIN chosen c ON s.rule = c.rule AND s.cutoff = c.cutoff AND s.lang IS NOT DISTINCT FROM c.lang
  WHERE s.ratio >= c.cutoff
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM rejected) AS kept
FROM based
"""


ORACLES["op9_quality_rules"] = _quality_sql()
