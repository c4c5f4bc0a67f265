"""Exact deduplication by Grace hashing: partition records until a bucket's table fits, compare whole contents.

1. Each input task folds its own equal texts first, so a group of copies leaves a task as one representative however
   many rows it holds (a group with a third of all rows sends a few records per task). Every row remembers its
   representative's id; both go to a table in the shared folder. A task holds at most ``TABLE_BYTES`` of distinct contents,
   ``HELD_BYTES`` of carried columns and ``TABLE_ROWS`` rows at a time.
2. Representatives are partitioned by the first digits of their content hash, as many as make an even bucket half as large
   as a table may be, and enough to fill the tasks evenly. A bucket that is larger than ``TABLE_BYTES`` is partitioned by the next digits, again and again, until
   each of its parts fits or holds one hash alone; this looks at hashes and sizes only, so contents move once, when each
   bucket's depth is known. Spark's shuffle and sort files are the spill files. A task opens one open-addressing table after
   the other, one a bucket. The table compares complete contents; the hash only says where to look.
3. Rows take the verdict of their representative by an equality join whose keys are no hotter than one input task.

Defined results: null text counts as empty; texts are equal when identical after each run of ASCII white space is
replaced by one space; of rows that share the smallest doc_id of a group, one stays; a null doc_id counts as larger than
any other; an empty table gives an empty table; other columns are not read (and are carried whole by
``first_of_each``).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triplake.llm import store
from triplake.llm import textarrays as ta

# What a table may hold: distinct contents with their entries, and in stage 1 carried columns and rows.
TABLE_BYTES = 32 << 20
HELD_BYTES = 64 << 20
TABLE_ROWS = 1 << 18
ENTRY_BYTES = 100  # an entry's own, beside its content
HASH_BITS = 63
BUCKETS_A_TASK = 16  # at least, so that tasks are even
DIGIT_BITS = 4  # a bucket that does not fit is cut into 2**DIGIT_BITS
_NO_ID = np.iinfo(np.int64).max


def normalised(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flat text with every run of ASCII white space replaced by one space, row by row."""
    space = ta.SPACE[data]
    after = np.zeros(len(data), bool)
    after[1:] = space[:-1]
    inner = off[(off > 0) & (off < len(data))]
    after[inner] = False
    keep = ~(space & after)
    sums = np.concatenate([[0], np.cumsum(keep, dtype=np.int64)])
    return np.where(space, np.uint8(32), data)[keep], sums[off]


class ContentTable:
    """Open addressing with linear probing over (hash, complete content); entries are numbered in arrival order."""

    def __init__(self) -> None:
        self.slots = np.full(1024, -1, np.int64)
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.bytes = 0

    def find(self, h: int, content: bytes) -> tuple[int, bool]:
        """(entry of this content, whether it is new)."""
        if 2 * len(self.contents) >= len(self.slots):
            self._grow()
        mask = len(self.slots) - 1
        at = h & mask
        while (entry := self.slots[at]) >= 0:
            if self.hashes[entry] == h and self.contents[entry] == content:
                return int(entry), False
            at = (at + 1) & mask
        self.slots[at] = entry = len(self.contents)
        self.hashes.append(h)
        self.contents.append(content)
        self.bytes += len(content) + ENTRY_BYTES
        return entry, True

    def _grow(self) -> None:
        self.slots = np.full(4 * len(self.slots), -1, np.int64)
        mask = len(self.slots) - 1
        for entry, h in enumerate(self.hashes):
            at = h & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = entry


def _contents(column: pa.Array):
    """(digest, 63-bit hash, normalised content) of each row."""
    data, off = ta.flat(column)
    for i, j in ta.pieces(off):
        flat, cut = normalised(data[off[i]:off[j]], off[i:j + 1] - off[i])
        whole = flat.tobytes()
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
            content = whole[a:b]
            digest = hashlib.sha256(content).digest()
            yield digest, int.from_bytes(digest[:8], "little") >> 1, content


class Carried:
    """Rows taken out of their batches (a slice would keep the whole batch in memory), by their number here."""

    def __init__(self) -> None:
        self.batches: list[pa.RecordBatch] = []
        self.rows = self.bytes = 0

    def add(self, batch: pa.RecordBatch, picked: list[int]) -> int:
        """Copy the picked rows; the number of the first one."""
        first = self.rows
        if picked:
            self.batches.append(batch.take(pa.array(picked, pa.int64())))
            self.rows += len(picked)
            self.bytes += self.batches[-1].nbytes
        return first

    def take(self, rows: list[int], names: list[str]) -> dict[str, pa.Array]:
        whole = pa.Table.from_batches(self.batches).take(pa.array(rows, pa.int64())).combine_chunks()
        return {c: whole.column(c).chunk(0) for c in names}


def _typed(column: pa.Array, type_: pa.DataType) -> pa.Array:
    return column if column.type == type_ else column.cast(type_)


def _before(a: int | None, b: int | None) -> bool:
    """Whether id ``a`` goes before ``b``; null goes last."""
    return a is not None and (b is None or a < b)


def _fold(df: DataFrame) -> DataFrame:
    """Stage 1 over (doc_id, text, row struct or none): member rows and, with ``rep`` set, representatives."""
    payload = [T.StructField(f.name, f.dataType) for f in df.schema.fields if f.name not in ("doc_id", "text")]
    schema = T.StructType([
        T.StructField("rep_id", T.LongType()), T.StructField("doc_id", T.LongType()),
        T.StructField("leads", T.BooleanType()), T.StructField("text_sha256", T.StringType()),
        T.StructField("h", T.LongType()), T.StructField("n", T.LongType()), T.StructField("size", T.LongType()),
        T.StructField("text", T.StringType()), *payload])
    limits = TABLE_BYTES, HELD_BYTES, TABLE_ROWS

    def scan(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        serial = TaskContext.get().partitionId() << 33
        table, groups, held, n_rows = ContentTable(), [], Carried(), 0

        def picked(batch):
            """Copy the rows of this batch that lead their group."""
            new = {g["at"]: g for g in groups if g["here"]}
            at = sorted(new)
            first = held.add(batch, at)
            for k, row in enumerate(at):
                new[row].update(at=first + k, here=False)

        def flush():
            nonlocal table, groups, held, n_rows, serial
            if not groups:
                return
            # every member, then one representative a group with its leading row
            at = {c: [] for c in ("rep_id", "doc_id", "leads", "text_sha256", "h", "n", "size")}
            rows = []
            for entry, g in enumerate(groups):
                for k, m in enumerate(g["members"]):
                    for c, v in zip(at, (serial + entry, m, k == g["first"], g["sha"], None, None, None)):
                        at[c].append(v)
                rows += [None] * len(g["members"]) + [g["at"]]
                for c, v in zip(at, (serial + entry, g["lead"], None, None, g["h"], len(g["members"]), g["size"])):
                    at[c].append(v)
            columns = {c: pa.array(v, arrow.field(c).type) for c, v in at.items()} | held.take(rows, ["text", *(f.name for f in payload)])
            out = pa.RecordBatch.from_arrays([_typed(columns[f.name], f.type) for f in arrow], schema=arrow)
            serial += len(groups)
            table, groups, held, n_rows = ContentTable(), [], Carried(), 0
            for k in range(0, out.num_rows, 4096):
                yield out.slice(k, 4096)

        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            batch = pa.RecordBatch.from_arrays(batch.columns, names=batch.schema.names)
            for k, (digest, h, content) in enumerate(_contents(batch.column("text"))):
                entry, new = table.find(h, content)
                if new:
                    groups.append({"members": [], "first": 0, "lead": ids[k], "at": k, "here": True, "sha": digest.hex(), "h": h,
                                   "size": len(content) + ENTRY_BYTES})
                g = groups[entry]
                if not new and _before(ids[k], g["lead"]):
                    g.update(first=len(g["members"]), lead=ids[k], at=k, here=True)
                g["members"].append(ids[k])
                n_rows += 1
                if table.bytes > limits[0] or n_rows >= limits[2]:
                    picked(batch)
                    yield from flush()
            picked(batch)
            if held.bytes > limits[1]:
                yield from flush()
        yield from flush()

    return store.map_arrow(df, scan, schema)


def _resolve(reps: DataFrame, payload: list[T.StructField]) -> DataFrame:
    """Stage 2: (rep_id, winner, keep_id, group_size), with the winners' carried columns if there are any; one table a ``bucket``."""
    schema = T.StructType([T.StructField("rep_id", T.LongType()), T.StructField("winner", T.LongType()),
                           T.StructField("keep_id", T.LongType()), T.StructField("group_size", T.LongType()), *payload])
    names = [f.name for f in payload]

    def scan(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        table, classes, held, opened = ContentTable(), [], Carried(), None

        def picked(batch):
            """Copy the rows of this batch that lead their class."""
            new = {g["at"]: g for g in classes if g["here"]} if names else {}
            at = sorted(new)
            first = held.add(batch, at)
            for k, row in enumerate(at):
                new[row].update(at=first + k, here=False)

        def close():
            if not classes:
                return
            columns = {c: [] for c in ("rep_id", "winner", "keep_id", "group_size")}
            for g in classes:
                for rep in g["reps"] if not names else [g["best"]]:
                    for c, v in zip(columns, (rep, g["best"], g["lead"], g["n"])):
                        columns[c].append(v)
            columns = {c: pa.array(v, pa.int64()) for c, v in columns.items()}
            if names:
                columns |= held.take([g["at"] for g in classes], names)
            yield pa.RecordBatch.from_arrays([_typed(columns[f.name], f.type) for f in arrow], schema=arrow)

        for batch in batches:
            ids, docs, ns, buckets = (batch.column(c).to_pylist() for c in ("rep_id", "doc_id", "n", "bucket"))
            batch = pa.RecordBatch.from_arrays(batch.columns, names=batch.schema.names)
            for k, (_, h, content) in enumerate(_contents(batch.column("text"))):
                if buckets[k] != opened:  # buckets are ranges of hashes and rows come in hash order
                    picked(batch)
                    yield from close()
                    table, classes, held, opened = ContentTable(), [], Carried(), buckets[k]
                entry, new = table.find(h, content)
                if new:
                    classes.append({"reps": [], "n": 0, "best": ids[k], "lead": docs[k], "at": k, "here": True})
                g = classes[entry]
                if not new and (_before(docs[k], g["lead"]) or docs[k] == g["lead"] and ids[k] < g["best"]):
                    g.update(best=ids[k], lead=docs[k], at=k, here=True)
                g["n"] += ns[k]
                if not names:
                    g["reps"].append(ids[k])
            picked(batch)
        yield from close()

    return store.map_arrow(reps, scan, schema)


def _buckets(reps: DataFrame) -> DataFrame:
    """``reps`` (h, size, ...) with the ``bucket`` of each: the number of hash digits it is cut by and their value."""
    spark = reps.sparkSession
    total = reps.agg(F.sum("size")).first()[0] or 0
    width = store.default_width(spark)
    first = min(HASH_BITS, max((2 * total // TABLE_BYTES).bit_length(), (BUCKETS_A_TASK * width).bit_length()))
    reps = reps.withColumn("root", F.expr(f"shiftright(h, {HASH_BITS - first})"))
    bits, open_, too_big = first, reps.select("root", "h", "size"), None
    while True:
        part = F.expr(f"shiftright(h, {HASH_BITS - bits})").alias("part")
        big = open_.groupBy("root", part).agg(F.sum("size").alias("size"), F.min("h").alias("least"), F.max("h").alias("most"))
        big = store.written(big.where((F.col("size") > TABLE_BYTES) & (F.col("least") < F.col("most"))).select("root").distinct(), "exact-buckets")
        if big.isEmpty():
            break
        too_big = big if too_big is None else too_big.union(big)
        open_ = open_.join(store.maybe_broadcast(big), "root", "left_semi")
        bits = min(HASH_BITS, bits + DIGIT_BITS)
    depth = F.lit(first)
    if too_big is not None:
        cut = store.written(too_big.groupBy("root").agg(F.count(F.lit(1)).alias("cuts")), "exact-cuts")
        reps = reps.join(store.maybe_broadcast(cut), "root", "left")
        depth = F.least(F.lit(HASH_BITS), F.lit(first) + DIGIT_BITS * F.coalesce(F.col("cuts"), F.lit(0))).cast("int")
    reps = reps.withColumn("depth", depth).withColumn("bucket", F.expr(f"concat(depth, ':', shiftright(h, {HASH_BITS} - depth))"))
    return reps.repartition(width, "bucket").sortWithinPartitions("h")


def _dealt(folded: DataFrame, payload: list[str]) -> DataFrame:
    reps = folded.where(F.col("n").isNotNull()).select("rep_id", "doc_id", "n", "h", "size", "text", *payload)
    return _buckets(reps).select("rep_id", "doc_id", "n", "bucket", "text", *payload)


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (doc_id, keep_id, group_size, kept, text_sha256)."""
    folded = store.written(_fold(df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))), "exact-fold")
    verdicts = _resolve(_dealt(folded, []), [])
    rows = folded.where(F.col("n").isNull()).select("rep_id", "doc_id", "leads", "text_sha256")
    return rows.join(verdicts, "rep_id").select(
        "doc_id", "keep_id", "group_size", (F.col("leads") & (F.col("rep_id") == F.col("winner"))).alias("kept"), "text_sha256")


def first_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df``'s rows without later copies: of equal texts the row with the smallest id stays, all columns as they were."""
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                     F.struct(*[F.col(f"`{c}`") for c in df.columns if c != text_col]).alias("row_"))
    payload = [T.StructField(f.name, f.dataType) for f in rows.schema.fields if f.name in ("text", "row_")]
    folded = store.written(_fold(rows).where("n IS NOT NULL"), "exact-fold")
    won = _resolve(_dealt(folded, ["row_"]), payload)
    return won.select(*[F.col("text").alias(c) if c == text_col else F.col("row_")[c].alias(c) for c in df.columns])


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group, representative and verdict of every document."""
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm,
         row_number() OVER () AS k FROM documents),
g AS (
  SELECT *, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
         row_number() OVER (PARTITION BY norm ORDER BY doc_id NULLS LAST, k) AS r FROM d)
SELECT doc_id, keep_id, group_size::BIGINT AS group_size, r = 1 AS kept, sha256(norm) AS text_sha256 FROM g
"""

QUERIES = {"op5_exact_dedup": op5_exact_dedup}
ORACLE = {"op5_exact_dedup": SQL}
