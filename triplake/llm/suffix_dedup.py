"""Repeated 400-byte strings, found by interval expansion on Burrows-Wheeler transforms of small buckets.

A suffix array of the whole corpus would move every byte many times. Equal 400-byte strings have equal minimisers, so:

1. Each start of a 400-byte string is owned by its minimiser, the 200-byte string in it with the least hash; runs of
   starts with one owner are cells (about one per 100 bytes). A cell leaves its document as a few numbers: the hash of
   its minimiser (bucket) and the hash of all bytes that its strings can touch (neighbourhood).
2. Buckets with one cell hold nothing repeated. A neighbourhood that occurs twice is repeated as a whole, in any number
   of copies, by a count. What is left are buckets whose members differ somewhere near: one context per different
   neighbourhood is fetched from its text.
3. A task takes buckets together, replaces each minimiser by one symbol and builds the contexts' suffix array and BWT.
   Breadth-first backward extension then derives the common prefixes by increasing value: every interval of suffixes
   that share l symbols is extended to the left by each symbol before them, which marks the bounds where exactly l
   symbols are shared. It stops at the minimum length; bounds that are unmarked then have at least that much in common,
   and their suffixes start repeated strings.
4. Documents take up the marked starts and drop the bytes that the strings cover.

A bucket with very many different contexts (a passage in thousands of documents) is cut by start offset into ranges, which
are counted without being brought together. Bytes that all strings of a range share and that occur once rule it out; a range
whose bytes occur as a whole in another context is repeated as a whole; one context of each is cut on, down to single starts,
the deepest intervals of the same search. So a context takes a few rows, and more only where repeated strings begin or end.

Defined results: null text is empty (no bytes); texts below the length lose nothing; a null doc_id is an id like any
other; repeated rows are copies of each other; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplake.llm import store
from triplake.llm import textarrays as ta

LENGTH = 400
MINIMISER = 200
# Contexts of one bucket that go to one task; a larger bucket is cut by start offset.
BUCKET_CONTEXTS = 2048
# Start offsets in a range of such a bucket, by turn; the last are single starts.
RANGES = (32, 4, 1)
# Bytes whose cells are found at once; positions in them ride in 24 bits.
BLOCK = 1 << 20
# Symbols of one suffix array.
BATCH_SYMBOLS = 1 << 20
NO_ID = np.iinfo(np.int64).min


def cells(data: np.ndarray, off: np.ndarray, length: int, k: int, block: int = BLOCK) -> tuple[np.ndarray, ...]:
    """(row, minimiser, first start, last start, bucket, neighbourhood) of every cell; positions within the row.

    A row of more than ``block`` bytes is taken in blocks of starts, each with the ``length - 1`` bytes after it. Where a
    block's bound cuts a cell, the two parts have neighbourhoods of their own (the bound cuts the bytes too), so neither
    counts as the other's copy.
    """
    if not length <= block <= 1 << 24:
        raise ValueError("a block holds one string at least and its positions take 24 bits")
    if len(data) <= block:
        return _block_cells(data, off, length, k)
    out = []
    for r, (begin, end) in enumerate(zip(off[:-1].tolist(), off[1:].tolist())):
        step = block - length + 1
        for at in range(begin, max(end - length + 1, begin), step):
            to = min(at + block, end)
            _, m, a, b, bucket, near = _block_cells(data[at:to], np.array([0, to - at]), length, k)
            out.append((np.full(len(m), r), *(x + (at - begin) for x in (m, a, b)), bucket, near))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else tuple(np.zeros(0, np.int64) for _ in range(6))


def _block_cells(data: np.ndarray, off: np.ndarray, length: int, k: int) -> tuple[np.ndarray, ...]:
    """``cells`` of at most 2**24 bytes."""
    n, w = len(data), length - k + 1
    empty = tuple(np.zeros(0, np.int64) for _ in range(6))
    if n < length:
        return empty
    sums = ta.prefix_sums(data)
    grams = np.arange(n - k + 1)
    h = ta.range_hashes(sums, grams, grams + k)
    # least hash in each window of w grams, the leftmost of equal ones: the position rides in the low bits
    low = np.uint64((1 << 24) - 1)
    least = (h & ~low) | grams.astype(np.uint64)
    size = 1
    while size * 2 <= w:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    least = np.minimum(least[:len(least) - (w - size)], least[w - size:]) if w > size else least
    row = np.searchsorted(off, np.arange(n - length + 1), side="right") - 1
    start = np.flatnonzero(np.arange(n - length + 1) + length <= off[row + 1])
    if not len(start):
        return empty
    m, row = (least[start] & low).astype(np.int64), row[start]
    new = np.ones(len(start), bool)
    new[1:] = (m[1:] != m[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    a, b, m, row = start[first], start[np.append(first[1:], len(start)) - 1], m[first], row[first]
    left, right = np.maximum(off[row], m - (length - k)), np.minimum(off[row + 1], m + length)
    near = ta.mixed(ta.range_hashes(sums, left, right) + ((m - left) * 4096 + (right - m)).astype(np.uint64))
    return row, m - off[row], a - off[row], b - off[row], h[m].view(np.int64), near.view(np.int64)


def _cells(docs: DataFrame, length: int, k: int, block: int) -> DataFrame:
    """(da, dh, at, bucket, near): ``at`` packs the minimiser's position and the distances back to the cell's bounds."""

    def scan(batches):
        for batch in batches:
            data, off = ta.flat(batch.column("text"))
            for i, j in ta.pieces(off):
                row, m, a, b, bucket, near = cells(data[off[i]:off[j]], off[i:j + 1] - off[i], length, k, block)
                rows = pa.array(i + row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("da").take(rows), batch.column("dh").take(rows), pa.array((m << 24) | ((m - a) << 12) | (m - b)),
                     pa.array(bucket), pa.array(near)], names=["da", "dh", "at", "bucket", "near"])

    return store.map_arrow(docs.select("da", "dh", "text"), scan, "da long, dh long, at long, bucket long, near long")


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array of symbols in which every 0 counts as smaller than the next; doubling, on what is not yet unique."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    s = text[order]
    new = np.ones(n, bool)
    new[1:] = (s[1:] != s[:-1]) | (s[1:] == 0)
    rank = np.empty(n, np.int64)
    head = np.flatnonzero(new)
    rank[order] = np.repeat(head, np.diff(np.append(head, n)))
    step = 1
    while True:
        # groups of equal rank are sorted by the rank of what follows; the others stay
        size = np.diff(np.append(np.flatnonzero(new), n))
        open_ = np.repeat(size > 1, size)
        if not open_.any():
            return order
        at = np.flatnonzero(open_)
        suffix = order[at]
        key = (rank[suffix] << np.int64(32)) | rank[np.minimum(suffix + step, n - 1)]
        turn = np.argsort(key, kind="stable")
        order[at] = suffix[turn]
        key = key[turn]
        fresh = np.ones(len(at), bool)
        fresh[1:] = key[1:] != key[:-1]
        new[at] = fresh
        head = np.flatnonzero(new)
        group = np.repeat(head, np.diff(np.append(head, n)))
        rank[order[at]] = group[at]
        step *= 2


def common_at_least(text: np.ndarray, order: np.ndarray, least: int) -> np.ndarray:
    """For each suffix rank, whether its suffix shares at least ``least`` symbols with a neighbour in ``order``."""
    n = len(text)
    bwt = text[order - 1]
    lf = np.empty(n, np.int64)
    lf[np.argsort(bwt, kind="stable")] = np.arange(n)
    marked = np.zeros(n + 1, bool)
    marked[[0, n]] = True
    # every terminator is a symbol of its own: its suffix is an interval of one, bounded where nothing is shared
    zeros = np.arange(int((text == 0).sum()))
    marked[:len(zeros) + 1] = True
    lb, rb = np.array([0]), np.array([n])
    for shared in range(least):
        size = rb - lb
        ends = np.cumsum(size)
        if not len(ends):
            break
        owner = np.repeat(np.arange(len(lb)), size)
        inside = np.arange(ends[-1]) + np.repeat(lb - (ends - size), size)
        inside, owner = inside[bwt[inside] != 0], owner[bwt[inside] != 0]
        image = lf[inside]
        turn = np.argsort(image, kind="stable")
        image, owner, symbol = image[turn], owner[turn], bwt[inside[turn]]
        if not len(image):
            break
        new = np.ones(len(image), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (symbol[1:] != symbol[:-1])
        first = np.flatnonzero(new)
        lo, hi = image[first], image[np.append(first[1:], len(image)) - 1] + 1
        free = ~marked[hi]
        lb, rb = lo[free], hi[free]
        marked[rb] = True
        if shared == 0:
            lb, rb = np.concatenate([zeros, lb]), np.concatenate([zeros + 1, rb])
    return ~marked[:-1] | ~marked[1:]


def repeated_starts(buckets: np.ndarray, lefts: list[bytes], rights: list[bytes], starts: np.ndarray, length: int, k: int):
    """(context, offset in its left part) of the starts whose 400 bytes another context (or place) has too.

    ``starts[i]`` of context i's first positions are starts of its cell. The minimiser is one symbol, so ``length``
    bytes are ``length - k + 1`` symbols.
    """
    _, group = np.unique(buckets, return_inverse=True)
    sizes = np.array([len(x) + len(y) + 2 for x, y in zip(lefts, rights)])
    base = np.concatenate([[0], np.cumsum(sizes)])
    text = np.zeros(base[-1], np.int32)
    body = np.frombuffer(b"".join(x + b"\0" + y + b"\0" for x, y in zip(lefts, rights)), np.uint8)
    text[:] = body.astype(np.int32) + 1
    text[base[:-1] + np.array([len(x) for x in lefts])] = 257 + group
    text[base[1:] - 1] = 0
    order = suffix_order(text)
    found = order[common_at_least(text, order, length - k + 1)]
    context = np.searchsorted(base, found, side="right") - 1
    within = found - base[context]
    good = within < starts[context]
    return context[good], within[good]


def _searched(contexts: DataFrame, length: int, k: int) -> DataFrame:
    """(da, dh, lo, hi): runs of repeated starts of the contexts that occur once."""

    def scan(batches):
        held: list[tuple] = []
        symbols = 0

        def search():
            keys = np.array([r[0] for r in held])
            at = np.array([r[3] for r in held])
            m, back, fore = at >> 24, (at >> 12) & 4095, at & 4095
            who, where = repeated_starts(keys, [r[5] for r in held], [r[6] for r in held], back - fore + 1, length, k)
            once = np.array([r[4] for r in held]) == 1
            who, where = who[once[who]], where[once[who]]
            turn = np.lexsort((where, who))
            who, where = who[turn], where[turn]
            new = np.ones(len(who), bool)
            new[1:] = (who[1:] != who[:-1]) | (where[1:] != where[:-1] + 1)
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(who)) - 1
            c = who[first] if len(who) else who
            begin = m[c] - back[c]
            ids = [pa.array([held[i][x] for i in c.tolist()], pa.int64()) for x in (1, 2)]
            return pa.RecordBatch.from_arrays(
                [*ids, pa.array(begin + where[first] if len(who) else begin), pa.array(begin + where[last] if len(who) else begin)],
                names=["da", "dh", "lo", "hi"])

        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in ("bucket", "da", "dh", "at", "n", "left", "right"))):
                if symbols > BATCH_SYMBOLS and r[0] != held[-1][0]:
                    yield search()
                    held, symbols = [], 0
                held.append(r)
                symbols += len(r[5]) + len(r[6]) + 2
        if held:
            yield search()

    n = store.default_width(contexts.sparkSession)
    dealt = contexts.repartition(n, "bucket").sortWithinPartitions("bucket")
    return store.map_arrow(dealt.select("bucket", "da", "dh", "at", "n", "left", "right"), scan, "da long, dh long, lo long, hi long")


def _cut(contexts: DataFrame, length: int) -> list[DataFrame]:
    """(da, dh, lo, hi) of each turn: runs of repeated starts of the ``single`` ones among ``contexts`` (da, dh, at, single, body).

    An offset is a start's distance back from the minimiser, which equal strings share; x and y are a range's least and
    greatest one. What a context shares with others is found by hashes: 64 bits rule out, 128 bits prove.
    """
    m, back = F.shiftright("at", 24), F.shiftright("at", 12).bitwiseAND(F.lit(4095))
    ranges = contexts.select("*", F.col("at").bitwiseAND(F.lit(4095)).alias("x"), back.alias("y"))
    out = []
    for size in RANGES:
        first = F.col("b") * size
        parts = ranges.select("da", "dh", "at", "single", "body", "x", "y", F.explode(F.sequence(F.expr(f"x div {size}"), F.expr(f"y div {size}"))).alias("b"))
        parts = parts.select("da", "dh", "at", "single", "body", "b", F.greatest("x", first).alias("x"), F.least("y", first + (size - 1)).alias("y"))
        hull = F.substring("body", back - F.col("y") + 1, F.col("y") - F.col("x") + length)
        core = F.substring("body", back - first + 1, F.lit(max(0, length - size + 1)))
        parts = store.written(parts.select("da", "dh", "at", "single", "b", "x", "y", F.xxhash64(hull).alias("p"),
                                           F.xxhash64(F.lit(1), hull).alias("q"), F.xxhash64(core).alias("c")), "suffix-ranges")
        key = ["b", "x", "y", "p", "q"]
        groups = store.written(parts.groupBy(*key, "c").agg(
            F.count(F.lit(1)).alias("times"), F.min(F.struct("da", "dh", "at", "single")).alias("r")), "suffix-range-groups")
        out.append(parts.where("single").join(groups.where("times > 1").select(*key), key, "left_semi").select(
            "da", "dh", (m - F.col("y")).alias("lo"), (m - F.col("x")).alias("hi")))
        if size > 1:
            met = store.written(groups.groupBy("b", "c").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("b", "c"), "suffix-cores")
            left = groups.join(store.maybe_broadcast(met), ["b", "c"], "left_semi").select(
                "r.da", "r.dh", "r.at", (F.col("r.single") & (F.col("times") == 1)).alias("single"), "x", "y")
            ranges = left.join(contexts.select("da", "dh", "at", "body"), ["da", "dh", "at"])
    return out


def repeated_runs(docs: DataFrame, length: int = LENGTH, k: int = MINIMISER, bucket_contexts: int = BUCKET_CONTEXTS,
                  block: int = BLOCK) -> DataFrame:
    """(da, dh, lo, hi): runs of starts of repeated strings in the texts of ``docs`` (da, dh, text)."""
    found = _cells(docs, length, k, block)
    buckets = found.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("near").alias("x"), F.max("near").alias("y")).where("n > 1")
    shared = store.written(found.join(buckets.select("bucket", (F.col("x") != F.col("y")).alias("differ")), "bucket"), "suffix-cells")
    lo, hi = F.shiftright("at", 24) - F.shiftright("at", 12).bitwiseAND(F.lit(4095)), F.shiftright("at", 24) - F.col("at").bitwiseAND(F.lit(4095))
    whole = shared.where("NOT differ").select("da", "dh", lo.alias("lo"), hi.alias("hi"))
    near = store.written(shared.where("differ").groupBy("bucket", "near").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("da", "dh", "at")).alias("r")).select("bucket", "near", "n", "r.*"), "suffix-near")
    copied = shared.where("differ").join(near.where("n > 1").select("bucket", "near"), ["bucket", "near"], "left_semi").select(
        "da", "dh", lo.alias("lo"), hi.alias("hi"))
    sizes = near.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"))
    wanted = near.join(sizes, "bucket").withColumn("hot", F.col("members") > bucket_contexts)
    where = store.written(near.select("da", "dh").distinct(), "suffix-context-docs")
    texts = docs.join(store.maybe_broadcast(where), ["da", "dh"], "left_semi").withColumn("text", F.col("text").cast("binary"))
    met = wanted.join(texts, ["da", "dh"])
    contexts = met.where("NOT hot").select(
        "bucket", "da", "dh", "at", "n", F.substring("text", lo + 1, F.shiftright("at", 24) - lo).alias("left"),
        F.substring("text", F.shiftright("at", 24) + k + 1, hi + length - F.shiftright("at", 24) - k).alias("right"))
    searched = _searched(contexts, length, k)
    body = store.written(met.where("hot").select(
        "da", "dh", "at", (F.col("n") == 1).alias("single"), F.substring("text", lo + 1, hi - lo + length).alias("body")), "suffix-hot")
    cut = [] if body.isEmpty() else _cut(body, length)
    return functools.reduce(DataFrame.unionByName, [whole, copied, searched, *cut])


def suffix_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                 minimiser: int = MINIMISER, bucket_contexts: int = BUCKET_CONTEXTS, with_text: bool = False, block: int = BLOCK) -> DataFrame:
    """One row per document: (doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept])."""
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("da", F.coalesce("doc_id", F.lit(int(NO_ID)))).withColumn("dh", F.xxhash64("text"))
    runs = store.written(repeated_runs(rows.select("da", "dh", "text"), length, minimiser, bucket_contexts, block), "suffix-runs")
    runs = runs.groupBy("da", "dh").agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))  # at most the text's own starts
    marked = store.maybe_broadcast(store.written(runs.select("da", "dh"), "suffix-docs"))
    rows = rows.select("doc_id", "da", "dh", F.col("text").cast("binary").alias("text"))
    plain = rows.join(marked, ["da", "dh"], "left_anti").select("doc_id", "text", F.lit(None).cast(runs.schema["runs"].dataType).alias("runs"))
    touched = rows.join(marked, ["da", "dh"], "left_semi").join(runs, ["da", "dh"]).select("doc_id", "text", "runs")

    def scan(batches):
        for batch in batches:
            out = [[], [], [], []]
            kept = []
            for text, own in zip(batch.column("text"), batch.column("runs")):
                raw = text.as_buffer() if text.is_valid else b""
                data = np.frombuffer(raw, np.uint8)
                if not own.is_valid:
                    rest, spans = data, 0
                else:
                    v = own.values.flatten()
                    edge = np.zeros(len(data) + 1, np.int32)
                    np.add.at(edge, v[0].to_numpy(), 1)
                    np.add.at(edge, v[1].to_numpy() + length, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    rest = data[~gone]
                kept.append(rest.tobytes() if with_text else None)
                for c, x in zip(out, (len(data), len(data) - len(rest), spans, hashlib.sha256(rest).hexdigest())):
                    c.append(x)
            columns = [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(out, [pa.int64()] * 3 + [pa.string()]))]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                columns, names = [*columns, pa.array(kept, pa.binary())], [*names, "kept"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_text else "")
    return store.map_arrow(plain.unionByName(touched), scan, schema)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the strings of 400 bytes that stand anywhere else too."""
    return suffix_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op2_suffix_dedup": op2_suffix_dedup}
ORACLE: dict[str, str] = {}
