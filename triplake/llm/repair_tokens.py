"""Token ids on disk under Re-Pair grammars: frequent id pairs become nonterminals, shard by shard.

Documents are range-sorted by id and encoded; every task cuts its run of documents into shards. In a shard, rounds of
pair replacement run until one would save less than a hundredth of the symbols: each round counts all adjacent pairs, gives
the most frequent ones new symbols and replaces their occurrences from left to right; a pair never spans two documents. A shard keeps its rules,
the expansion length of every nonterminal and where each document's symbols begin, so a range of a document's ids is
decoded without expanding what lies before it. Shards are rows of a Parquet dataset (one row group entry each), in
ascending document order.

Defined results: null text is empty (one id, the end id); null ids sort first; repeated ids keep a row each; an empty
table gives an empty dataset; other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from triplake.llm import encoder as enc
from triplake.llm import store
from triplake.llm import textarrays as ta

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
SHARD_IDS = 1 << 20
SLOT_BITS = 20
SLOTS = 1 << SLOT_BITS
PAIRS_A_ROUND = 2048
LEAST_COUNT = 8
LEAST_SAVING = 0.01  # of the sequence; a round below it is the last

SHARD_SCHEMA = ("part int, shard int, n_docs long, n_ids long, first_symbol long, doc_ids binary, doc_nulls binary, "
                "doc_ids_n binary, doc_symbols_n binary, rules binary, expansion binary, symbols binary")


def grammar(ids: np.ndarray, off: np.ndarray, first_symbol: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, symbols a document, rules as rows of two symbols) of documents' ids.

    A round counts pairs by slot of their hash and takes the most frequent slots. Each slot stands for one pair that occurs
    in it; positions of other pairs that share the slot are left to a later round, so no round sorts the sequence. Counts
    that decide are of that one pair. Every round but the last removes at least LEAST_SAVING of the sequence.
    """
    seq = ids.astype(np.uint32)
    last = np.zeros(len(seq), bool)
    last[off[1:][off[1:] > off[:-1]] - 1] = True
    rules: list[np.ndarray] = []
    symbol = first_symbol
    pair_of, number = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.int32)
    while len(seq) > 1:
        key = seq[:-1].astype(np.uint64)
        key <<= np.uint64(32)
        key |= seq[1:]
        slot = ((key * np.uint64(ta.BASE)) >> np.uint64(64 - SLOT_BITS)).astype(np.int32)
        slot[last[:-1]] = SLOTS  # a document's last symbol starts no pair
        count = np.bincount(slot, minlength=SLOTS + 1)[:SLOTS]
        often = count[count >= LEAST_COUNT]
        floor = int(np.partition(often, -PAIRS_A_ROUND)[-PAIRS_A_ROUND]) if len(often) > PAIRS_A_ROUND else LEAST_COUNT
        hot = np.append(count >= floor, False)
        at = np.flatnonzero(hot[slot])
        pair_of[slot[at]] = key[at]
        at = at[pair_of[slot[at]] == key[at]]
        # of neighbours that overlap every second one, from the left, is replaced
        fresh = np.ones(len(at), bool)
        fresh[1:] = np.diff(at) > 1
        head = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
        at = at[((np.arange(len(at)) - head) & 1) == 0]
        used = np.flatnonzero(np.bincount(slot[at], minlength=SLOTS) >= LEAST_COUNT)
        number[:] = -1
        number[used] = np.arange(len(used))
        at = at[number[slot[at]] >= 0]
        if not len(at) or len(at) < LEAST_SAVING * len(seq):
            break
        pairs = pair_of[used]
        rules.append(np.stack([pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)], axis=1))
        seq[at] = symbol + number[slot[at]]
        last[at] = last[at + 1]
        symbol += len(used)
        stay = np.ones(len(seq), bool)
        stay[at + 1] = False
        seq, last = seq[stay], last[stay]
    # symbols a document: the ends, with empty documents in their places
    ends = np.flatnonzero(last) + 1
    full = off[1:] > off[:-1]
    per = np.zeros(len(off) - 1, np.int64)
    per[full] = np.diff(np.concatenate([[0], ends]))
    table = np.concatenate(rules) if rules else np.zeros((0, 2), np.uint64)
    return seq.astype(np.uint32), per, table.astype(np.uint32)


def expansion_lengths(rules: np.ndarray, first_symbol: int) -> np.ndarray:
    """Number of ids each nonterminal stands for; a rule only uses symbols made before it."""
    out = np.ones(len(rules), np.int64)
    deep = rules.astype(np.int64) - first_symbol
    while True:
        now = np.where(deep >= 0, out[np.maximum(deep, 0)], 1).sum(axis=1) if len(rules) else out
        if np.array_equal(now, out):
            return out
        out = now


def opened(symbols: np.ndarray, rules: np.ndarray, first_symbol: int) -> np.ndarray:
    """The ids that a few ``symbols`` stand for; each pass opens every nonterminal by one level."""
    seq = symbols.astype(np.int64)
    rules = rules.astype(np.int64)
    while True:
        deep = seq >= first_symbol
        if not deep.any():
            return seq.astype(np.uint32)
        ends = np.cumsum(1 + deep)
        out = np.empty(int(ends[-1]), np.int64)
        pair = rules[seq[deep] - first_symbol]
        out[ends[~deep] - 1] = seq[~deep]
        out[ends[deep] - 2], out[ends[deep] - 1] = pair[:, 0], pair[:, 1]
        seq = out


def expanded(symbols: np.ndarray, rules: np.ndarray, first_symbol: int, pieces: int = 1 << 12) -> np.ndarray:
    """The ids that ``symbols`` stand for: every rule is opened once, then each symbol's ids are gathered.

    Rules are opened some at a time, and rules whose ids would outgrow the text (a long run of one pair) only where used.
    """
    size = expansion_lengths(rules, first_symbol)
    total = int(size.sum())
    if total > 4 * len(symbols) + (1 << 16):
        return opened(symbols, rules, first_symbol)
    pool = [opened(rules[k:k + pieces].ravel(), rules, first_symbol) for k in range(0, len(rules), pieces)]
    terminal = symbols < first_symbol
    pool = np.concatenate([*pool, symbols[terminal].astype(np.uint32)])
    place = np.cumsum(terminal) - 1 + total
    rule = np.where(terminal, 0, symbols.astype(np.int64) - first_symbol)
    begin, length = place, np.ones(len(symbols), np.int64)
    if len(rules):
        begin = np.where(terminal, place, (np.cumsum(size) - size)[rule])
        length = np.where(terminal, 1, size[rule])
    ends = np.cumsum(length)
    return pool[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - length), length)]


def decode_range(shard: dict, doc: int, start: int, stop: int) -> np.ndarray:
    """Ids [start, stop) of a shard's ``doc``-th document; opens only the symbols that overlap them."""
    first = shard["first_symbol"]
    rules = np.frombuffer(shard["rules"], "<u4").reshape(-1, 2)
    size = np.frombuffer(shard["expansion"], "<u4").astype(np.int64)
    per = np.frombuffer(shard["doc_symbols_n"], "<u4").astype(np.int64)
    begin = int(per[:doc].sum())
    own = np.frombuffer(shard["symbols"], "<u4")[begin:begin + per[doc]].astype(np.int64)
    lengths = np.where(own >= first, size[np.maximum(own - first, 0)] if len(size) else 1, 1)
    ends = np.cumsum(lengths)
    a, b = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, stop, side="left") + 1
    skipped = int(ends[a - 1]) if a else 0
    return opened(own[a:b], rules, first)[start - skipped:stop - skipped]


def shards(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER,
           end_id: int = END_ID) -> DataFrame:
    """Shard rows of ``df``'s documents in ascending id order (``part``, ``shard``); see ``SHARD_SCHEMA``."""

    def scan(batches):
        coder = enc.encoder(tokenizer)
        first = max(coder.tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1)
        part, number = TaskContext.get().partitionId(), 0
        docs, nulls, ids, lengths, total = [], [], [], [], 0

        def shard():
            flat, n = np.concatenate(ids), np.concatenate(lengths)
            off = np.concatenate([[0], np.cumsum(n)])
            symbols, per, rules = grammar(flat, off, first)
            row = [part, number, len(n), len(flat), first, np.concatenate(docs).astype("<i8").tobytes(),
                   np.packbits(np.concatenate(nulls)).tobytes(), n.astype("<u4").tobytes(), per.astype("<u4").tobytes(),
                   rules.astype("<u4").tobytes(), expansion_lengths(rules, first).astype("<u4").tobytes(),
                   symbols.astype("<u4").tobytes()]
            kinds = [pa.int32()] * 2 + [pa.int64()] * 3 + [pa.binary()] * 7
            names = [x.split()[0] for x in SHARD_SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)

        for batch in batches:
            own = batch.column("doc_id")
            data, off = ta.flat(batch.column("text"))
            for i, j in ta.pieces(off, 1 << 19):
                flat, cut = enc.with_end(*coder.encode(data[off[i]:off[j]], off[i:j + 1] - off[i]), end_id)
                docs.append(own.slice(i, j - i).fill_null(0).to_numpy())
                nulls.append(own.slice(i, j - i).is_null().to_numpy(zero_copy_only=False))
                ids.append(flat)
                lengths.append(np.diff(cut))
                total += len(flat)
                if total >= SHARD_IDS:
                    yield shard()
                    docs, nulls, ids, lengths, total, number = [], [], [], [], 0, number + 1
        if docs:
            yield shard()

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # the text's hash splits the rows of a frequent id (null, say) over partitions that follow each other
    sorted_ = (rows.repartitionByRange(store.default_width(df.sparkSession), F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first()))
    return store.map_arrow(sorted_, scan, SHARD_SCHEMA)


def write_tokens(df: DataFrame, path: str, **options) -> None:
    """Write ``df``'s documents as Re-Pair shards under ``path`` (any folder that Spark's writers reach)."""
    shards(df, **options).write.option("compression", "zstd").parquet(path)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document of a shard dataset, decoded from its files."""
    table = spark.read.schema(SHARD_SCHEMA).parquet(path)

    def scan(batches):
        for batch in batches:
            for s in batch.to_pylist():
                first, n = s["first_symbol"], np.frombuffer(s["doc_ids_n"], "<u4").astype(np.int64)
                ids = expanded(np.frombuffer(s["symbols"], "<u4"), np.frombuffer(s["rules"], "<u4").reshape(-1, 2), first)
                off = np.concatenate([[0], np.cumsum(n)])
                raw = memoryview(np.ascontiguousarray(ids, "<u4").tobytes())
                bounds = (4 * off).tolist()
                spans = [raw[a:b] for a, b in zip(bounds, bounds[1:])]
                null = np.unpackbits(np.frombuffer(s["doc_nulls"], np.uint8), count=len(n)).astype(bool)
                columns = [pa.array(np.frombuffer(s["doc_ids"], "<i8"), mask=null), pa.array(np.full(len(n), s["part"], np.int32)),
                           pa.array(np.full(len(n), s["shard"], np.int32)), pa.array(off[:-1]), pa.array(n),
                           pa.array([zlib.crc32(x) for x in spans], pa.int64())]
                names = ["doc_id", "part", "shard", "within", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array([np.frombuffer(x, "<u4") for x in spans], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, part int, shard int, within long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    docs = store.map_arrow(table, scan, schema)
    # starts: a prefix sum over the parts' totals (one row a part), then over each part's shards
    sizes = table.select("part", "shard", "n_ids")
    parts = (sizes.groupBy("part").agg(F.sum("n_ids").alias("size"))
             .withColumn("part_start", F.sum("size").over(Window.orderBy("part")) - F.col("size")).select("part", "part_start"))
    own = F.sum("n_ids").over(Window.partitionBy("part").orderBy("shard")) - F.col("n_ids")
    starts = sizes.withColumn("shard_start", own).join(parts, "part").select(
        "part", "shard", (F.col("part_start") + F.col("shard_start")).alias("begin"))
    return docs.join(store.maybe_broadcast(store.written(starts, "shard-starts")), ["part", "shard"]).select(
        "doc_id", (F.col("begin") + F.col("within")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def op10_repair_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and write all documents, read the files back and digest what they hold."""
    path = store.scratch_path(spark, "repair-tokens")
    write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return read_tokens(spark, path)


QUERIES = {"op10_repair_tokens": op10_repair_tokens}
ORACLE: dict[str, str] = {}
