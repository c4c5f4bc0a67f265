"""Vectors as short codes: each of a vector's parts is named by its nearest entry in a trained codebook of integer parts.

Components become integers (floor of 1024 times the value). Distances come from dictionaries: in a batch every dimension's
distinct integers are listed once, their squared differences to all entries are tabulated, and the distance of a part to
all entries is one gathered table row a dimension, added up over dictionary codes. Training is a few passes over the
integer table: each task adds up its parts by nearest entry, a grouped sum merges these, and the codebooks (parts x entries
x width numbers, whatever the table's size) go back to the tasks.

Defined results: vectors that are null or hold a null, NaN or infinite component are left out. A code needs the length of
the vector with the smallest id, and that length in equal parts: other vectors keep their row with null code and error
(such rows add nothing to their label's error). Ids may repeat (ordered by id, then components) and null ids come last.
With fewer vectors than entries the codebooks are shorter. Ties go to the entry listed first. So that squared distances fit
64 bits, a component beyond 2**30 / sqrt(length) after scaling counts as that bound. Null labels are one label. An empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplake.llm import store

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
BLOCK_ROWS = 512  # rows whose distances to all entries are in memory at once


def nearest(values: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest entry, squared distance to it) of every row of ``values``; ties go to the lower index."""
    n, width = values.shape
    best, error = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if not n or not width:
        return best, error
    reach = max(abs(int(values.min())), abs(int(values.max()))) + max(abs(int(book.min())), abs(int(book.max())))
    kind = np.int32 if width * reach * reach < 1 << 31 else np.int64
    tables, codes = [], []
    for d in range(width):
        distinct, code = np.unique(values[:, d], return_inverse=True)
        tables.append(np.square((distinct[:, None] - book[None, :, d])).astype(kind))
        codes.append(code)
    sums, more = np.empty((BLOCK_ROWS, len(book)), kind), np.empty((BLOCK_ROWS, len(book)), kind)
    for a in range(0, n, BLOCK_ROWS):
        b = min(n, a + BLOCK_ROWS)
        total, row = sums[:b - a], more[:b - a]
        np.take(tables[0], codes[0][a:b], axis=0, out=total)
        for table, code in zip(tables[1:], codes[1:]):
            np.take(table, code[a:b], axis=0, out=row)
            total += row
        best[a:b] = total.argmin(axis=1)
        error[a:b] = total[np.arange(b - a), best[a:b]]
    return best, error


def integers(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, label, v) of the vectors with finite components only; ``v`` has the scaled components."""
    v = F.col(f"`{vector_col}`")
    whole = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    bound = F.floor(F.lit(float(1 << 30)) / F.sqrt(F.greatest(F.size(v), F.lit(1))))
    scaled = F.transform(v, lambda x: F.least(F.greatest(F.floor(x.cast("double") * SCALE), -bound), bound).cast("int"))
    return df.where(F.coalesce(whole, F.lit(False))).select(
        F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{label_col}`").alias("label"), scaled.alias("v"))


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    """Rows of a list column whose lists all have ``length`` components."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), length)


def codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Trained codebooks (parts, entries, width) of a written table of ``integers``; no entries if no vector can be coded."""
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(1).collect()
    length = len(first[0].v) if first else 0
    if not first or length % parts:
        return np.zeros((parts, 0, 0), np.int64)
    fitting = vectors.where(F.size("v") == length)
    seeds = fitting.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(entries).collect()
    width = length // parts
    books = np.array([r.v for r in seeds], np.int64).reshape(len(seeds), parts, width).transpose(1, 0, 2)

    for _ in range(rounds):
        def summed(batches, books=books):
            total, count = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
            for batch in batches:
                values = _matrix(batch.column(0), length)
                for p in range(parts):
                    part = values[:, p * width:(p + 1) * width]
                    best, _ = nearest(part, books[p])
                    count[p] += np.bincount(best, minlength=len(books[p]))
                    for d in range(width):
                        # sums of integers below 2**53 are exact as doubles
                        total[p, :, d] += np.bincount(best, weights=part[:, d], minlength=len(books[p])).astype(np.int64)
            p, e = np.nonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(count[p, e]),
                                              pa.array(list(total[p, e]), pa.list_(pa.int64()))], ["p", "e", "n", "s"])

        sums = store.map_arrow(fitting.select("v"), summed, "p int, e int, n long, s array<long>")
        merged = sums.groupBy("p", "e").agg(F.sum("n").alias("n"), F.array(*[
            F.sum(F.col("s")[d].cast("decimal(38,0)")) for d in range(width)]).alias("s")).collect()  # parts x entries rows at most
        books = books.copy()
        for r in merged:
            books[r.p, r.e] = [int(s) // r.n for s in r.s]
    return books


def coded(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """``vectors`` as (vec_id, label, code, error): two hex digits a part, and the squared distance to the coded vector."""
    parts, size, width = books.shape
    length = parts * width

    def assign(batches):
        for batch in batches:
            n = batch.num_rows
            fits = np.zeros(n, bool)
            if size:
                fits = np.diff(batch.column(2).offsets.to_numpy()) == length
            rows = np.flatnonzero(fits)
            values = _matrix(batch.column(2).take(pa.array(rows)), length) if len(rows) else np.zeros((0, length), np.int64)
            text = np.zeros((len(rows), 2 * parts), np.uint8)
            digits = np.frombuffer(b"0123456789abcdef", np.uint8)
            error = np.zeros(len(rows), np.int64)
            for p in range(parts if len(rows) else 0):
                best, e = nearest(values[:, p * width:(p + 1) * width], books[p])
                text[:, 2 * p], text[:, 2 * p + 1] = digits[best >> 4], digits[best & 15]
                error += e
            code, errors = np.full(n, None, object), np.full(n, None, object)
            code[rows] = [t.tobytes().decode() for t in text]
            errors[rows] = error.tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(code, pa.string()),
                                              pa.array(errors, pa.int64())], ["vec_id", "label", "code", "error"])

    types = dict(vectors.dtypes)
    return store.map_arrow(vectors.select("vec_id", "label", "v"), assign,
                           f"vec_id {types['vec_id']}, label {types['label']}, code string, error long")


def decoded(codes: DataFrame, books: np.ndarray) -> DataFrame:
    """``codes`` with ``decoded``: the components of the entries that each code names, scaled back (null for a null code)."""
    table = F.array(*[F.array(*[F.array(*[F.lit(int(x) / SCALE) for x in entry]) for entry in book]) for book in books])
    parts = [table[p][F.conv(F.substring("code", 2 * p + 1, 2), 16, 10).cast("int")] for p in range(len(books))]
    return codes.withColumn("decoded", F.when(F.col("code").isNotNull(), F.concat(*parts)))


def codebooks_digest(books: np.ndarray) -> str:
    """Digest of all entries' integers in decimal, by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every vector, its label's error and the codebooks' digest."""
    vectors = store.written(integers(spark.read.parquet(f"{sf_dir}/embeddings.parquet")), "vector-integers")
    books = codebooks(vectors)
    rows = store.written(coded(vectors, books), "vector-codes")
    labels = store.written(rows.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error")), "vector-label-errors")
    return (rows.join(store.maybe_broadcast(labels), F.col("label").eqNullSafe(F.col("of_label")))
            .select("vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256")))


def _sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The same training as relations; a distance and its entry are one number, so that the least is the nearest."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
best{r} AS MATERIALIZED (
  SELECT k, part, min(key) AS key FROM (
    SELECT k, part, entry, sum((x - c) * (x - c))::BIGINT * {entries} + entry AS key
    FROM v JOIN book{r} USING (part, pos) GROUP BY k, part, entry) GROUP BY k, part)""")
        if r < rounds:
            steps.append(f"""
mean{r} AS (
  SELECT part, key % {entries} AS entry, pos, sum(x)::BIGINT AS s, count(*) AS n
  FROM best{r} JOIN v USING (k, part) GROUP BY part, key % {entries}, pos),
book{r + 1} AS MATERIALIZED (
  SELECT part, entry, pos, CASE WHEN n IS NULL THEN c ELSE (s - ((s % n) + n) % n) // n END AS c
  FROM book{r} LEFT JOIN mean{r} USING (part, entry, pos))""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS k, vec_id, label, embedding AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cells AS (SELECT k, vec_id, len(e) // {parts} AS width, unnest(e) AS x, unnest(range(len(e))) AS p FROM kept),
v AS MATERIALIZED (SELECT k, p // width AS part, p % width AS pos, floor(x::DOUBLE * {SCALE})::BIGINT AS x FROM cells),
seeds AS (SELECT k, row_number() OVER (
  ORDER BY vec_id NULLS LAST, list_transform(e, lambda x: floor(x::DOUBLE * {SCALE})::BIGINT)) - 1 AS entry FROM kept QUALIFY entry < {entries}),
book0 AS MATERIALIZED (SELECT part, entry, pos, x AS c FROM seeds JOIN v USING (k)),{",".join(steps)},
codes AS (
  SELECT k, string_agg(printf('%02x', key % {entries}), '' ORDER BY part) AS code, sum(key // {entries})::BIGINT AS error
  FROM best{rounds} GROUP BY k),
digest AS (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM book{rounds})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN codes USING (k), digest
"""


QUERIES = {"op12_vector_codes": op12_vector_codes}
ORACLE = {"op12_vector_codes": _sql()}
