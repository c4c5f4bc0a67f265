"""Best-fit packing of documents into fixed-length sequences, in bulk-synchronous supersteps.

Documents are encoded, documents longer than a sequence are cut into full pieces (the first one takes the remainder),
and pieces are range-sorted by length, which gives each its rank among pieces of its length. Superstep L (from the
longest length down) places all pieces of length L at once: the gaps, sorted by size, are swept from the successor of L
upwards, each gap takes as many pieces as fit, and what finds no gap opens new sequences; the gaps are updated and the
next superstep follows. This is best-fit decreasing. Pieces of one length are interchangeable, and so are gaps of one
size, so conflicts resolve by rank: pieces r0..r1 of a length go, ``q`` each, to a run of consecutive sequences. The
sweep's state is therefore runs, not rows: its size depends on the sequence length alone, never on the number of
documents, and each piece finds its place in its own task by a successor search among the runs of its length.

Defined results: null text is empty (a piece of one id, the end id); repeated rows are packed each; an empty table
gives an empty table; other columns are not read.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from triplake.llm import encoder as enc
from triplake.llm import store
from triplake.llm import textarrays as ta

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
SEQUENCE_IDS = 1024

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(n: int, most: int) -> list[tuple[int, int]]:
    """(start, stop) of a document's pieces: all full but the first."""
    first = n % most or min(n, most)
    return [(0, first), *((a, a + most) for a in range(first, n, most))]


def pieces(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER,
           end_id: int = END_ID, sequence_ids: int = SEQUENCE_IDS) -> DataFrame:
    """Encoded pieces of every document: see ``PIECES``."""

    def scan(batches):
        coder = enc.encoder(tokenizer)
        for batch in batches:
            own = batch.column("doc_id")
            data, off = ta.flat(batch.column("text"))
            for i, j in ta.pieces(off, 1 << 19):
                ids, at = enc.with_end(*coder.encode(data[off[i]:off[j]], off[i:j + 1] - off[i]), end_id)
                raw = memoryview(np.ascontiguousarray(ids, "<u4").tobytes())
                row, piece, start, length, crc = [], [], [], [], []
                for k, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
                    for p, (x, y) in enumerate(cut(b - a, sequence_ids)):
                        for c, v in zip((row, piece, start, length, crc),
                                        (i + k, p, x, y - x, zlib.crc32(raw[4 * (a + x):4 * (a + y)]))):
                            c.append(v)
                yield pa.RecordBatch.from_arrays(
                    [own.take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return store.map_arrow(rows, scan, PIECES)


def supersteps(counts: dict[int, int], sequence_ids: int = SEQUENCE_IDS) -> np.ndarray:
    """Rows (length, first rank, one past the last rank, first sequence, pieces a sequence, offset there)."""
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap size -> runs (first sequence, number of them)
    sizes: list[int] = []
    placed: list[tuple[int, ...]] = []
    opened = 0

    def leave(size: int, first: int, n: int) -> None:
        if size > 0 and n > 0:
            if not gaps[size]:
                bisect.insort(sizes, size)
            gaps[size].append((first, n))

    def fill(length: int, rank: int, left: int, size: int, first: int, n: int) -> int:
        """Place up to ``left`` pieces into ``n`` sequences with a gap of ``size``; how many were placed."""
        q = size // length
        whole = min(n, left // q)
        if whole:
            placed.append((length, rank, rank + whole * q, first, q, sequence_ids - size))
            leave(size - q * length, first, whole)
        rest = left - whole * q
        if rest and whole < n:
            rest = min(rest, q)
            placed.append((length, rank + whole * q, rank + whole * q + rest, first + whole, rest, sequence_ids - size))
            leave(size - rest * length, first + whole, 1)
            leave(size, first + whole + 1, n - whole - 1)
            return whole * q + rest
        leave(size, first + whole, n - whole)
        return whole * q

    for length in sorted(counts, reverse=True):
        rank, total = 0, counts[length]
        while rank < total:
            at = bisect.bisect_left(sizes, length)  # successor: the smallest gap that takes this length
            if at == len(sizes):
                n = -(-(total - rank) // (sequence_ids // length))
                fill(length, rank, total - rank, sequence_ids, opened, n)
                opened += n
                break
            size = sizes[at]
            first, n = gaps[size].pop()
            if not gaps[size]:
                sizes.pop(at)
            rank += fill(length, rank, total - rank, size, first, n)
    return np.array(sorted(placed), np.int64).reshape(-1, 6)


def ranked(parts: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """``parts`` range-sorted by length with each row's ``rank`` among rows of its length, and rows a length."""
    spark = parts.sparkSession
    order = [F.desc("length"), "doc_id", "piece"]
    lined = (parts.repartitionByRange(store.default_width(spark), *order).sortWithinPartitions(*order)
             .withColumn("part", F.spark_partition_id())
             .withColumn("line", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    lined = store.written(lined, "packing-lines")
    # a run of one length in one partition: a row here; at most partitions + lengths of them
    runs = lined.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"), F.min("line").alias("first"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    runs = store.written(runs.withColumn("before", before), "packing-runs")
    counts = {r["length"]: r["n"] for r in runs.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows = lined.join(store.maybe_broadcast(runs.drop("n")), ["part", "length"])
    return rows.withColumn("rank", F.col("line") - F.col("first") + F.col("before")).drop("part", "line", "first", "before"), counts


def best_fit_packing(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER,
                     end_id: int = END_ID, sequence_ids: int = SEQUENCE_IDS) -> DataFrame:
    """One row per piece: (doc_id, piece, start, length, ids_crc32, sequence_id, offset)."""
    rows, counts = ranked(store.written(pieces(df, id_col, text_col, tokenizer, end_id, sequence_ids), "packing-pieces"))
    runs = supersteps(counts, sequence_ids)
    edges = (runs[:, 0] << 44) | runs[:, 1]

    def place(batches):
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            run = runs[np.searchsorted(edges, (length << 44) | rank, side="right") - 1]
            nth = rank - run[:, 1]
            columns = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(run[:, 3] + nth // run[:, 4]), pa.array(run[:, 5] + nth % run[:, 4] * length)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return store.map_arrow(rows, place, PIECES + ", sequence_id long, offset long")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of 1024 ids."""
    return best_fit_packing(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op3_best_fit_packing": op3_best_fit_packing}
ORACLE: dict[str, str] = {}
