"""Soft-membership mixing: classify documents into domains, then fit rates so that expected tokens meet targets.

1. A labelled table gives three domains: clean, low (quality 0) and toxic. A Bernoulli naive Bayes model over hashed
   words and marks is fitted to at most ``TRAIN_DOCS`` labelled documents (those with the smallest hashes of their ids); words in
   fewer than ``LEAST_DOCS`` of them, or no more common in a domain other than clean, have no weight. The model is a table of at most 2**16 rows, so it is broadcast.
2. Every document is scored over its whole text: domain posteriors and its number of tokens (words).
3. Nonnegative rates r, one a document, minimise the sum over domains k of (sum_d r_d n_d p_dk - t_k)^2 / T_k, where T_k
   are the domains' present expected tokens and t_k the targets, plus RIDGE times sum_d n_d (r_d - 1)^2. Projected
   gradient: r <- max(0, r - (sum_k p_dk g_k + RIDGE (r - 1)) / (1 + RIDGE)), g_k = (s_k - t_k) / T_k. In the coordinates
   sqrt(n_d) r_d the first term's matrix is similar to a stochastic one, so its largest eigenvalue is 1 and this step is
   safe at any size. A round is one distributed sum of three numbers; rates are an
   expression of the round's gradients and are written every few rounds.

Only DataFrame functions run here. Defined results: null or wordless texts have no tokens, the prior as posteriors and
the rate of their posteriors; labels of unknown ids are ignored, null labels too; of several labels of an id the worst
counts; without labelled documents every domain is equally likely; repeated rows get a rate each; an empty table gives
an empty table; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplake.llm import store

DOMAINS = ("clean", "low", "toxic")
# Shares of the mix's tokens that each domain gets. The mix has as many tokens as the documents have, or as many more as
# leave the domains in WHOLE all of theirs: a corpus with a larger share of clean text than its weight loses none of it.
WHOLE = ("clean",)
TARGET_WEIGHTS = {"clean": 0.94, "low": 0.06, "toxic": 0.0}
TRAIN_DOCS = 20_000
LEAST_DOCS = 5
LEAST_Z = 4.5  # standard deviations from the share that chance would give
BUCKETS = 1 << 16
SMOOTHING = 1.0
RIDGE = 0.02  # weight of staying at rate 1; makes the fit unique and keeps equal documents at equal rates
ROUNDS = 60
REBASE = 6
TOLERANCE = 1e-6


def _tokens(text) -> F.Column:
    """Lower-case words without marks, and the marks of each word alone (``!!``, ``###``)."""
    low = F.lower(text)
    return F.concat(F.split(low, r"[^\p{L}]+"), F.split(low, r"[\p{L}\p{N}\s]+"))


def _buckets(docs: DataFrame, *keep: str) -> DataFrame:
    """One row per distinct token, and at least one (with a null bucket) per document."""
    token = F.explode_outer(F.array_distinct(_tokens(F.col("text")))).alias("token")
    return docs.select(*keep, token).select(*keep, F.when(F.col("token") != "", F.pmod(F.xxhash64("token"), F.lit(BUCKETS))).alias("bucket"))


def fit(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, least_docs: int = LEAST_DOCS) -> tuple[DataFrame, list[float]]:
    """(bucket, one log weight a domain) and the domains' log priors, from ``docs`` (doc_id, text) and labels.

    A token counts once a document. The prior of a domain has a floor, so a domain without labelled documents stays possible.
    """
    domain = F.when(F.col("toxic") == 1, F.lit(2)).when(F.col("quality") == 0, F.lit(1)).when(F.col("quality") == 1, F.lit(0))
    known = labels.select("doc_id", domain.alias("domain")).where("domain IS NOT NULL AND doc_id IS NOT NULL")
    known = known.groupBy("doc_id").agg(F.max("domain").alias("domain")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs)
    known = store.written(known, "mixing-labels")
    sample = docs.where("doc_id IS NOT NULL").join(store.maybe_broadcast(known), "doc_id")
    own = store.written(_buckets(sample, "doc_id", "domain").distinct(), "mixing-sample")
    size = {r["domain"]: r["n"] for r in own.select("doc_id", "domain").distinct().groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = [size.get(k, 0) for k in range(len(DOMAINS))]
    total = sum(sizes)
    prior = [math.log((n + 1) / (total + len(DOMAINS))) for n in sizes]
    counts = own.where("bucket IS NOT NULL").groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), *(F.count(F.when(F.col("domain") == k, 1)).alias(f"n{k}") for k in range(len(DOMAINS))))
    # a token counts if it marks a domain other than clean: significantly more often there than overall
    part = [n / max(total, 1) for n in sizes]
    z = [(F.col(f"n{k}") - F.col("n") * q) / F.sqrt(F.col("n") * q * (1 - q)) for k, q in enumerate(part) if k and 0 < q < 1]
    told = F.greatest(*z, F.lit(0.0), F.lit(0.0)) >= LEAST_Z if z else F.lit(False)
    # P(token in a document | domain), drawn a little towards the token's overall share
    share = F.col("n") / max(total, 1)
    p = [(F.col(f"n{k}") + SMOOTHING * share) / (sizes[k] + SMOOTHING) for k in range(len(DOMAINS))]
    p = [F.least(F.greatest(x, F.lit(1e-4)), F.lit(1 - 1e-4)) for x in p]
    model = store.written(counts.where((F.col("n") >= least_docs) & told).select(
        "bucket", *(F.log(x / (1 - x)).alias(f"w{k}") for k, x in enumerate(p)), *(F.log(1 - x).alias(f"a{k}") for k, x in enumerate(p))), "mixing-model")
    absent = model.agg(*(F.sum(f"a{k}") for k in range(len(DOMAINS)))).first()
    return model.drop("a0", "a1", "a2"), [x + float(a or 0.0) for x, a in zip(prior, absent)]


def posteriors(docs: DataFrame, model: DataFrame, prior: list[float]) -> DataFrame:
    """(row_id, doc_id, n_tokens, p0, p1, p2) of every row of ``docs`` (doc_id, text), and what other columns it has."""
    own = ["row_id", "doc_id", "n_tokens", *(c for c in docs.columns if c not in ("doc_id", "text"))]
    rows = docs.withColumn("row_id", F.monotonically_increasing_id()).withColumn(
        "n_tokens", F.coalesce(F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")), F.lit(0)).cast("long"))
    each = _buckets(rows, *own).join(F.broadcast(model), "bucket", "left")
    scored = each.groupBy(*own).agg(
        *((F.lit(prior[k]) + F.coalesce(F.sum(f"w{k}"), F.lit(0.0))).alias(f"l{k}") for k in range(len(DOMAINS))))
    top = F.greatest(*(F.col(f"l{k}") for k in range(len(DOMAINS))))
    scored = scored.select(*own, *(F.exp(F.col(f"l{k}") - top).alias(f"e{k}") for k in range(len(DOMAINS))))
    mass = sum((F.col(f"e{k}") for k in range(1, len(DOMAINS))), F.col("e0"))
    return scored.select(*own, *(F.round(F.col(f"e{k}") / mass, 9).alias(f"p{k}") for k in range(len(DOMAINS))))


def rates(points: DataFrame, weights: dict[str, float] = TARGET_WEIGHTS, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """``points`` (n_tokens, p0, p1, p2, ...) with a ``rate`` each: projected gradient on the domains' expected tokens."""
    k_all = range(len(DOMAINS))
    points = store.written(points.withColumn("rate", F.lit(1.0)), "mixing-points")

    def totals(rate) -> list[float]:
        row = points.agg(*(F.sum(F.col("n_tokens") * F.col(f"p{k}") * rate) for k in k_all)).first()
        return [float(x or 0.0) for x in row]

    have = totals(F.lit(1.0))
    all_ = max([sum(have), *(n / weights[name] for n, name in zip(have, DOMAINS) if name in WHOLE and weights[name] > 0)])
    want = [weights[name] * all_ for name in DOMAINS]
    rate, now = F.col("rate"), have
    for turn in range(rounds):
        step = [(now[k] - want[k]) / have[k] if have[k] > 0 else 0.0 for k in k_all]
        if max(abs(now[k] - want[k]) for k in k_all) <= tolerance * max(all_, 1.0):
            break
        rate = F.greatest(F.lit(0.0), rate - (sum((F.col(f"p{k}") * step[k] for k in k_all[1:]), F.col("p0") * step[0]) + RIDGE * (rate - 1)) / (1 + RIDGE))
        if turn % REBASE == REBASE - 1:
            points = store.written(points.withColumn("rate", rate), "mixing-points")
            rate = F.col("rate")
        last, now = now, totals(rate)
        if max(abs(a - b) for a, b in zip(last, now)) <= 0.1 * tolerance * max(all_, 1.0):
            break  # targets that no rates meet: the least squares are reached
    return points.withColumn("rate", rate)


def source_mixing(docs: DataFrame, labels: DataFrame, weights: dict[str, float] = TARGET_WEIGHTS, id_col: str = "doc_id",
                  text_col: str = "text", train_docs: int = TRAIN_DOCS) -> DataFrame:
    """One row per document: (doc_id, n_tokens, p_clean, p_low, p_toxic, rate, copies).

    ``copies`` rounds the rate up or down by the hash of id and text, so its expectation is the rate.
    """
    return _planned(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                                F.xxhash64(F.col(text_col)).alias("own_h")), labels, weights, train_docs).drop("own_h")


def _planned(own: DataFrame, labels: DataFrame, weights: dict[str, float], train_docs: int = TRAIN_DOCS) -> DataFrame:
    """``source_mixing`` of ``own`` (doc_id, text, own_h), and what other columns it has."""
    model, prior = fit(own, labels, train_docs)
    fitted = rates(posteriors(own, model, prior), weights)
    chance = F.pmod(F.xxhash64("doc_id", "own_h", F.lit("mixing")), F.lit(1 << 20)) / (1 << 20)
    return fitted.select("doc_id", "n_tokens", *(F.col(f"p{k}").alias(f"p_{name}") for k, name in enumerate(DOMAINS)), "rate",
                         F.floor(F.col("rate") + chance).cast("long").alias("copies"),
                         *(c for c in own.columns if c not in ("doc_id", "text")))


def mixed_documents(docs: DataFrame, labels: DataFrame, weights: dict[str, float] = TARGET_WEIGHTS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``docs`` with each row repeated (or left out) by its ``copies``; columns as they are.

    Copies are a function of id and text, so a row takes those of its own id and 128-bit text hash.
    """
    own, name = store.renamed(docs)
    text = F.col(name[text_col])
    key = {"id_": F.col(name[id_col]).cast("long"), "h_": F.xxhash64(text), "g_": F.xxhash64(F.lit(1), text)}
    plan = _planned(own.select(key["id_"].alias("doc_id"), text.alias("text"), key["h_"].alias("own_h"), key["g_"].alias("own_g")),
                    labels, weights)
    changed = store.written(plan.where("copies != 1").groupBy(F.col("doc_id").alias("own_id"), "own_h", "own_g").agg(
        F.max("copies").alias("copies")), "mixing-copies")
    keyed = own.withColumns(key)
    on = keyed["id_"].eqNullSafe(changed["own_id"]) & (keyed["h_"] == changed["own_h"]) & (keyed["g_"] == changed["own_g"])
    out = keyed.join(store.maybe_broadcast(changed), on, "left")
    times = F.array_repeat(F.lit(1), F.coalesce(F.col("copies"), F.lit(1)).cast("int"))
    return out.withColumn("one", F.explode(times)).select(*own.columns).toDF(*docs.columns)


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posteriors, rate and copies of every document under the target weights."""
    return source_mixing(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {"op9_source_mixing": op9_source_mixing}
ORACLE: dict[str, str] = {}
