"""Token counts from flat token files: find the end-of-document ids, stitch documents over block bounds.

The files hold fixed-width ids and nothing else: no header, no index. Each file is cut into blocks; a task searches a
block's ids for the end id with one array comparison. Documents that begin and end in a block are done there. A document
that crosses bounds gets its start from a prefix scan over the blocks (one row a block): the running number of
documents, and the running position of the last end id, first over a file's blocks, then over the files' totals.

Ids take two bytes, high byte first, which holds vocabularies of up to 65,536 (``ID_TYPE``; larger ones need ``<u4``).
Writing uses Spark's text writer with the end id's last byte as line separator, so files are flat binary and go to any
folder that Spark reaches. The files follow the table's own order, file by file, so no text is shuffled; ``doc_no`` and
``start`` count along it. Special strings in a text are ordinary text, so the end id stands only at ends.

The files name no documents. ``named`` gives the counts their ids back by place: the table's ids are read in the same
order (one narrow column), and a place that only one side has raises an error instead of giving a wrong name. The table
must be read from files, which gives the same rows in the same order each time.

Defined results: null text is an empty document (no ids before its end id); ids after the last end id of all files are
one more document with ``ended`` false; a null or repeated doc_id is kept, row by row; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from triplake.llm import encoder as enc
from triplake.llm import store
from triplake.llm import textarrays as ta

TOKENIZER = "byte_bpe_50k.json"
END_ID = 50256  # the vocabulary's own end-of-text id
ID_TYPE = ">u2"
BLOCK_BYTES = 1 << 20
# Documents a file may have: a task reads one file's bytes at once, so long tables are cut into more files.
FILE_DOCS = 1 << 14
_PLACE_BITS = 33  # of monotonically_increasing_id: the row's place in its partition


def places(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, part, k): each row's partition and its place there, as ``write_flat`` puts them into part files."""
    at = F.monotonically_increasing_id()
    return df.select(F.col(id_col).alias("doc_id"), F.shiftright(at, _PLACE_BITS).alias("part"),
                     at.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).alias("k"))


def write_flat(df: DataFrame, path: str, text_col: str = "text", tokenizer: str = TOKENIZER, end_id: int = END_ID,
               id_type: str = ID_TYPE, file_docs: int = FILE_DOCS) -> None:
    """Flat token files of ``df``'s documents in its own order, by part number and then by file number of the part."""
    most = np.iinfo(id_type).max
    if end_id > most:
        raise ValueError(f"end id {end_id} does not fit ids of type {id_type}")
    mark = np.array([end_id], id_type).tobytes()
    if mark[-1] > 0x7F:
        raise ValueError(f"the last byte of end id {end_id} as {id_type} must be below 128, to serve as line separator")

    def scan(batches):
        coder = enc.encoder(tokenizer, special_as_text=True)
        for batch in batches:
            data, off = ta.flat(batch.column(0))
            for i, j in ta.pieces(off, 1 << 19):
                ids, at = coder.encode(data[off[i]:off[j]], off[i:j + 1] - off[i])
                if len(ids) and ids.max() > most:
                    raise OverflowError(f"id {ids.max()} does not fit {id_type}")
                raw = ids.astype(id_type).tobytes()
                bounds = (np.dtype(id_type).itemsize * at).tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([raw[a:b] + mark[:-1] for a, b in zip(bounds, bounds[1:])], pa.binary())], names=["ids"])

    lines = store.map_arrow(df.select(F.col(text_col).alias("text")), scan, "ids binary")
    (lines.select(F.col("ids").cast("string").alias("value")).write.option("lineSep", chr(mark[-1]))
     .option("compression", "none").option("maxRecordsPerFile", file_docs).text(path))


def scan_flat(spark: SparkSession, path: str, end_id: int = END_ID, block_bytes: int = BLOCK_BYTES,
              id_type: str = ID_TYPE) -> DataFrame:
    """(doc_no, start, n_tokens, ended, part, k) of every document in the flat token files under ``path``.

    ``doc_no`` counts documents and ``start`` counts ids from the first file on, end ids included; ``k`` counts the
    documents that end in the files of part number ``part``.
    """
    width = np.dtype(id_type).itemsize
    block_bytes -= block_bytes % width
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).where("length > 0")
    blocks = files.select(
        F.regexp_extract("path", r"/part-(\d+)-[^/]*$", 1).cast("long").alias("part"),
        F.regexp_extract("path", r"-c(\d+)\.[^/]*$", 1).cast("long").alias("file"), "content",
        F.explode(F.sequence(F.lit(0), F.ceil(F.col("length") / block_bytes).cast("int") - 1)).alias("block")).select(
        "part", "file", "block", F.expr(f"substring(content, block * {block_bytes} + 1, {block_bytes})").alias("ids"))

    def search(batches):
        for batch in batches:
            heads = zip(*(batch.column(c).to_pylist() for c in ("part", "file", "block")))
            for (part, file, block), raw in zip(heads, batch.column("ids")):
                ids = np.frombuffer(raw.as_buffer(), id_type)
                ends = np.flatnonzero(ids == end_id)
                base = block * (block_bytes // width)
                # row -1 sums up the block; row k is its k-th end id
                n = len(ends) + 1
                at = np.concatenate([[base + ends[-1] if len(ends) else -1], base + ends])
                start = np.concatenate([[-1, -1], base + ends[:-1] + 1])[:n]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, part)), pa.array(np.full(n, file)), pa.array(np.full(n, block, np.int32)), pa.array(np.arange(-1, n - 1)),
                     pa.array(start), pa.array(at), pa.array(np.full(n, len(ids)))],
                    names=["part", "file", "block", "k", "start", "at", "n_ids"])

    found = store.written(store.map_arrow(
        blocks, search, "part long, file long, block int, k long, start long, at long, n_ids long"), "flat-ends")
    # prefix scan over a file's blocks ...
    sums = found.where("k = -1").select("part", "file", "block", "n_ids", F.when(F.col("at") >= 0, F.col("at")).alias("last"))
    ends = found.where("k >= 0").groupBy("part", "file", "block").agg(F.count(F.lit(1)).alias("n_ends"))
    own = Window.partitionBy("part", "file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = store.written(sums.join(ends, ["part", "file", "block"], "left").na.fill(0, ["n_ends"]).select(
        "part", "file", "block", "n_ids", "n_ends", "last", F.coalesce(F.sum("n_ends").over(own), F.lit(0)).alias("docs_before"),
        F.max("last").over(own).alias("last_before")), "flat-blocks")
    # ... then over the files' totals, one row a file
    all_ = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    totals = sums.groupBy("part", "file").agg(F.sum("n_ids").alias("n_ids"), F.sum("n_ends").alias("n_ends"), F.max("last").alias("last"))
    totals = totals.withColumn("file_start", F.coalesce(F.sum("n_ids").over(all_), F.lit(0)))
    totals = store.written(totals.select(
        "part", "file", "n_ids", "n_ends", "file_start", F.coalesce(F.sum("n_ends").over(all_), F.lit(0)).alias("file_docs"),
        (F.col("file_start") + F.col("last")).alias("last")).withColumn(
        "carried", F.coalesce(F.max("last").over(all_) + 1, F.lit(0))).withColumn(
        "part_docs", F.min("file_docs").over(Window.partitionBy("part"))), "flat-files")
    bounds = sums.join(store.maybe_broadcast(totals.select(
        "part", "file", "file_start", "file_docs", "part_docs", "carried")), ["part", "file"]).select(
        "part", "file", "block", "file_start", "part_docs", (F.col("file_docs") + F.col("docs_before")).alias("docs"),
        F.coalesce(F.col("file_start") + F.col("last_before") + 1, F.col("carried")).alias("open"))
    docs = found.where("k >= 0").join(store.maybe_broadcast(store.written(bounds, "flat-bounds")), ["part", "file", "block"])
    start = F.when(F.col("start") < 0, F.col("open")).otherwise(F.col("file_start") + F.col("start"))
    done = docs.select((F.col("docs") + F.col("k")).alias("doc_no"), start.alias("start"),
                       (F.col("file_start") + F.col("at") - start).alias("n_tokens"), F.lit(True).alias("ended"), "part",
                       (F.col("docs") + F.col("k") - F.col("part_docs")).alias("k"))
    tail = totals.agg(F.sum("n_ends").alias("doc_no"), F.coalesce(F.max("last") + 1, F.lit(0)).alias("start"), F.sum("n_ids").alias("n"))
    return done.union(tail.where("n > start").select("doc_no", "start", F.col("n") - F.col("start"), F.lit(False),
                                                       F.lit(None).cast("long"), F.lit(None).cast("long")))


def named(counts: DataFrame, names: DataFrame) -> DataFrame:
    """``counts`` of ended documents with the doc_id that stands at their place in ``names``."""
    known, found = F.col("doc_id_known"), F.col("doc_no").isNotNull()
    doc_id = F.when(known & found, F.col("doc_id")).otherwise(
        F.raise_error(F.lit("the table's rows and the token files' documents do not match")).cast("long"))
    return (counts.where("ended").join(names.withColumn("doc_id_known", F.lit(True)), ["part", "k"], "full")
            .select(doc_id.alias("doc_id"), "doc_no", "start", "n_tokens", "ended"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents as flat token files, count each document's ids from the files alone, name the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = store.scratch_path(spark, "flat-tokens")
    names = store.written(places(docs), "flat-names")
    write_flat(docs, path)
    return named(scan_flat(spark, path), names)


QUERIES = {"op6_token_counts": op6_token_counts}
ORACLE: dict[str, str] = {}
