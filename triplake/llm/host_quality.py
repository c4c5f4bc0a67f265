"""Host-level quality rules: shrink each host's rate of failing documents, join the verdict back.

Per document, five counts are taken in one pass over its whole text; two base rules mark failing documents. Failures are
summed by host (partial sums first, so a host with most of the rows is no burden), each host's rate is shrunk with a beta
prior fitted to all hosts by the moments of beta-binomial counts, and hosts whose shrunk rate passes ``max_host_rate`` take
their remaining documents with them. The moments take out the noise that small counts have by themselves, so many hosts of
one document say nothing about how hosts differ; and the prior weighs a few documents at least (MIN_PRIOR_WEIGHT), so such
hosts stay near the overall rate.

Defined results: null text has no words (and so fails); a null host has no verdict, only the base rules count; repeated
rows and ids are judged row by row; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triplake.llm import store
from triplake.llm import textarrays as ta

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# A host goes when its shrunk failure rate is above this: nearly all of what it serves fails.
MAX_HOST_RATE = 0.8
# Weight, in documents, of the prior where hosts differ no more than chance does (its moments then give no finite weight).
MAX_PRIOR_WEIGHT = 1000.0
# The prior weighs at least this much, however unlike the large hosts are: a host seen once or twice goes only where more than
# seven in ten of all documents fail.
MIN_PRIOR_WEIGHT = 4.0

METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def _counts(data: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    n = len(off) - 1

    def inside(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return sums

    solid = ~ta.SPACE[data]
    chars = inside(solid & ~ta.CONTINUATION[data])
    symbols = inside(_SYMBOL[data])
    starts, ends, rows = ta.words(data, off)

    breaks = np.flatnonzero(data == 10)
    line_start = np.unique(np.concatenate([off[:-1], breaks + 1]))
    line_start = line_start[line_start < len(data)]
    line_end = np.append(line_start[1:], len(data))
    line_row = np.searchsorted(off, line_start, side="right") - 1
    closing = np.minimum(line_end, off[line_row + 1])
    broken = (closing > line_start) & (data[closing - 1] == 10) if len(data) else np.zeros(0, bool)
    closing = closing - broken
    with_word = inside(solid)
    real = with_word[closing] > with_word[line_start]
    line_start, closing, line_row = line_start[real], closing[real], line_row[real]
    _, later = ta.repeated_in_row(ta.content_hashes(data, line_start, closing), line_row)

    grams, first = ta.windows(ta.content_hashes(data, starts, ends), rows, 3)
    again, _ = ta.repeated_in_row(grams, rows[first])
    covered = np.zeros(len(starts), bool)
    for j in range(3):
        covered[first[again] + j] = True
    return [ta.per_row(rows, n), chars[off[1:]] - chars[off[:-1]], symbols[off[1:]] - symbols[off[:-1]],
            ta.per_row(line_row[later], n), ta.per_row(rows[covered], n)]


def with_metrics(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df``'s columns (text included) plus the five counts and ``base_failed``, names that ``df`` must not have."""
    schema = T.StructType([*df.schema.fields, *(T.StructField(m, T.LongType()) for m in METRICS),
                           T.StructField("base_failed", T.BooleanType())])
    at = df.columns.index(text_col)

    def scan(batches):
        for batch in batches:
            data, off = ta.flat(batch.column(at))
            for i, j in ta.pieces(off, 1 << 19):
                found = _counts(data[off[i]:off[j]], off[i:j + 1] - off[i])
                failed = (found[0] < MIN_WORDS) | (100 * found[4] > MAX_REPEAT_PERCENT * found[0])
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(i, j - i).columns, *(pa.array(x, pa.int64()) for x in found), pa.array(failed)],
                    names=schema.names)

    return store.map_arrow(df, scan, schema)


def host_verdicts(failures: DataFrame, max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """(host, n_docs, n_failed, shrunk_rate, host_rejected) from (host, base_failed) rows; null hosts are left out."""
    hosts = (failures.where(F.col("host").isNotNull()).groupBy("host")
             .agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed")))
    n, f = F.col("n_docs").cast("double"), F.col("n_failed").cast("double")
    sums = hosts.agg(F.sum(n).alias("n"), F.sum(f).alias("f"), F.sum(f * f / n).alias("ff"), F.sum(n * n).alias("nn"),
                     F.count(F.lit(1)).alias("k"))
    m = F.try_divide("f", "n")
    chance = m * (1 - m)  # variance of one document's failure at the overall rate
    likeness = F.try_divide(F.col("ff") - F.col("f") * m - chance * (F.col("k") - 1),
                            chance * (F.col("n") - F.try_divide("nn", "n") - (F.col("k") - 1)))
    weight = F.when(likeness > 0, F.least(F.lit(MAX_PRIOR_WEIGHT), F.greatest(F.lit(MIN_PRIOR_WEIGHT), 1 / likeness - 1))).otherwise(F.lit(MAX_PRIOR_WEIGHT))
    prior = sums.select(m.alias("m"), weight.alias("w"))  # one row of two numbers
    shrunk = (F.col("n_failed") + F.col("m") * F.col("w")) / (F.col("n_docs") + F.col("w"))
    return (hosts.join(F.broadcast(prior), F.lit(True)).select("host", "n_docs", "n_failed", shrunk.alias("shrunk_rate"))
            .withColumn("host_rejected", F.col("shrunk_rate") > max_host_rate))


def host_quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                 max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per document: its counts, ``base_failed``, its host's ``shrunk_rate`` and ``kept``."""
    docs = store.written(
        with_metrics(df.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), F.col(text_col).alias("text")))
        .drop("text"), "host-quality")
    return judged(docs, max_host_rate)


def judged(docs: DataFrame, max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Join the verdicts of ``docs``' hosts back to its rows; only rejected hosts can change one."""
    verdicts = store.maybe_broadcast(store.written(host_verdicts(docs, max_host_rate), "host-verdicts"))
    return (docs.join(verdicts.select("host", "shrunk_rate", "host_rejected"), "host", "left")
            .withColumn("kept", ~F.col("base_failed") & ~F.coalesce(F.col("host_rejected"), F.lit(False)))
            .select("doc_id", *METRICS, "base_failed", "kept", "host", "shrunk_rate"))


def kept_documents(df: DataFrame, text_col: str = "text", host_col: str = "source",
                   max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """``df`` without the documents that the rules reject; its columns stay as they are."""
    rows, name = store.renamed(df)
    failures = with_metrics(rows.select(F.col(name[host_col]).alias("host"), F.col(name[text_col]).alias("text"))).select("host", "base_failed")
    rejected = store.written(host_verdicts(failures, max_host_rate).where("host_rejected")
                             .select(F.col("host").alias("rejected_host")), "rejected-hosts")
    scored = with_metrics(rows, name[text_col]).where(~F.col("base_failed")).select(*rows.columns)
    return (scored.join(store.maybe_broadcast(rejected), F.col(name[host_col]) == F.col("rejected_host"), "left_anti")
            .toDF(*df.columns))


def op1_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, base verdict and host-level verdict of every document."""
    return (host_quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))
            .select("doc_id", *METRICS, "base_failed", "kept"))


SQL = rf"""
WITH w AS (
  SELECT row_number() OVER () AS k, doc_id, source AS host, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
lines AS (
  SELECT k, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT k, unnest(string_split(text, chr(10))) AS line FROM w)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY k),
grams AS (
  SELECT k, i, count(*) OVER (PARTITION BY k, words[i], words[i + 1], words[i + 2]) AS n
  FROM (SELECT k, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)),
repeated AS (
  SELECT k, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT k, unnest([i, i + 1, i + 2]) AS p FROM grams WHERE n >= 2) GROUP BY k),
base AS (
  SELECT doc_id, host, len(words)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN lines USING (k) LEFT JOIN repeated USING (k)),
failing AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM base),
hosts AS (
  SELECT host, count(*) AS n, sum(base_failed::INT) AS f FROM failing WHERE host IS NOT NULL GROUP BY host),
sums AS (SELECT sum(n) AS n, sum(f) AS f, sum(f * f / n) AS ff, sum(n * n) AS nn, count(*) AS k, sum(f) / sum(n) AS m FROM hosts),
prior AS (SELECT m, (ff - f * m - m * (1 - m) * (k - 1)) / nullif(m * (1 - m) * (n - nn / n - (k - 1)), 0) AS rho FROM sums),
weight AS (
  SELECT m, CASE WHEN rho > 0 THEN least({MAX_PRIOR_WEIGHT}, greatest({MIN_PRIOR_WEIGHT}, 1 / rho - 1)) ELSE {MAX_PRIOR_WEIGHT} END AS s
  FROM prior),
verdict AS (SELECT host, (f + m * s) / (n + s) > {MAX_HOST_RATE} AS rejected FROM hosts, weight)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(rejected, false) AS kept
FROM failing LEFT JOIN verdict USING (host)
"""

QUERIES = {"op1_host_quality": op1_host_quality}
ORACLE = {"op1_host_quality": SQL}
