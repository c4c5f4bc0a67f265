"""Near-duplicates by an inverted join over MinHash coordinates, confirmed on whole shingle sets.

1. Each text becomes its set of distinct five-word shingles and a signature of 64 minima. Texts with the same set fold
   into one representative before anything is joined, so copies never meet as pairs.
2. Representatives are posted under every (coordinate, value). Values that only one of them has are dropped, and so are
   representatives with fewer shared values than the match threshold: they cannot reach it.
3. Star rounds: each posting list names one member its hub (another one each round) and a representative counts its
   collisions with the hubs of its lists; the best are confirmed on the whole sets. A list of n members yields at most n
   pairs, and members of one component skip each other, so a large group of near copies is joined in linear work.
4. Then all that is left: representatives post under the rarest of their shared values (a prefix that any pair above
   the threshold must meet in). Lists of one component are done. In the others a representative goes that shares too
   few of its shingles with any other to reach the similarity, and so do pairs whose shared shingles cannot or whose
   parity sketches differ in more bits than the sets may differ in elements; the rest is confirmed if it reaches the
   match threshold. These bounds are exact: none of them drops a link.
   Lists with many members outside their largest component (a large group of near copies and its strays) are not paired:
   their members meet in the elements by which they differ from one pivot of that component. Members within the
   similarity of the pivot are linked with it. Of any other two in different components at least one is farther from
   the pivot, so a link needs common differences, more the farther they are: some of their rarest must meet (a prefix).
   This is exact too.
5. Components of the confirmed links, by stars over the link table.

A pair at similarity 0.75 has 48 of 64 expected matches; fewer than 28 happen with a probability below 1e-7.

Defined results: null or wordless texts are empty sets, linked with nothing; texts of one to four words are one shingle;
a null doc_id is larger than any other; repeated rows are one representative; an empty table gives an empty table; other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from triplake.llm import store
from triplake.llm import textarrays as ta
from triplake.llm.components import components

SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 75
COORDINATES = 64
LEAST_MATCHES = 28
STAR_ROUNDS = 2
HUBS_A_ROUND = 3
# Longs of a set's parity sketch: 2048 bits, each flipped by the elements that hash to it.
SKETCH_LONGS = 32
# Lists with more members than this outside their largest component are joined on differences from a pivot.
OUTSIDE = 16
SKETCH = [f"bits{i}" for i in range(SKETCH_LONGS)]
NO_ID = np.iinfo(np.int64).min

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_MIX = ta.mixed(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(ta.BASE)) | np.uint64(1)


def shingle_sets(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes, row by row in ascending order; offsets of the rows in them)."""
    n = len(off) - 1
    low = _LOWER[data]
    starts, ends, rows = ta.words(low, off)
    own = ta.content_hashes(low, starts, ends)
    h, first = ta.windows(own, rows, SHINGLE_WORDS)
    row = rows[first]
    count = ta.per_row(rows, n)
    begin = np.concatenate([[0], np.cumsum(count)])
    for size in range(1, SHINGLE_WORDS):  # shorter texts: their whole sequence
        short = np.flatnonzero(count == size)
        g = np.full(len(short), size, np.uint64)
        for j in range(size):
            g = ta.mixed(g * np.uint64(ta.BASE) + own[begin[short] + j])
        h, row = np.concatenate([h, g]), np.concatenate([row, short])
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    h, row = h[new], row[new]
    return h, np.concatenate([[0], np.cumsum(ta.per_row(row, n))])


def signatures(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Minima of 64 hash functions over each (not empty) set, as 32-bit integers, a row a set.

    The whole 64-bit minimum is hashed down: its upper half is small in large sets, so that in large tables most
    values of unlike sets would be equal by chance.
    """
    out = np.empty((len(at) - 1, COORDINATES), np.int32)
    for k in range(COORDINATES):
        v = np.minimum.reduceat((h ^ _MIX[k]) * _MIX[COORDINATES - 1 - k], at[:-1])
        out[:, k] = ta.mixed(v).astype(np.uint32).view(np.int32)
    return out


def parity_sketches(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Per set, bit b tells whether an odd number of its elements hash to b; 32 longs a set, one set after the other.

    Two sets' sketches differ in at most as many bits as the sets differ in elements, so the count is a safe bound.
    """
    bits = 64 * SKETCH_LONGS
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    odd = np.bincount(row * bits + (h >> np.uint64(20) & np.uint64(bits - 1)).astype(np.int64), minlength=bits * (len(at) - 1)) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8").astype(np.int64)


def _described(df: DataFrame) -> DataFrame:
    """(row_id, doc_id, text_hash, n_shingles, set_a, set_b, signature) and any further longs of every row."""
    more = [c for c in df.columns if c not in ("doc_id", "text", "text_hash")]

    def scan(batches):
        serial = TaskContext.get().partitionId() << 33
        for batch in batches:
            data, off = ta.flat(batch.column("text"))
            for i, j in ta.pieces(off):
                h, at = shingle_sets(data[off[i]:off[j]], off[i:j + 1] - off[i])
                n = np.diff(at)
                full = np.flatnonzero(n)
                sums = [np.zeros(j - i, np.uint64), np.zeros(j - i, np.uint64)]
                signature = pa.nulls(j - i, pa.list_(pa.int32()))
                if len(full):
                    cuts = np.append(at[full], at[-1])
                    for s, salt in zip(sums, (1, 2)):
                        s[full] = np.add.reduceat(ta.mixed(h * np.uint64(2 * salt + 1) + np.uint64(salt)), cuts[:-1])
                    ends = np.zeros(j - i + 1, np.int32)
                    ends[1:] = np.cumsum(n > 0) * COORDINATES
                    signature = pa.ListArray.from_arrays(pa.array(ends), pa.array(signatures(h, cuts).ravel()))
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(serial + np.arange(j - i)), part.column("doc_id"), part.column("text_hash"), pa.array(n),
                     *(pa.array(s.view(np.int64)) for s in sums), signature, *(part.column(c) for c in more)],
                    names=["row_id", "doc_id", "text_hash", "n_shingles", "set_a", "set_b", "signature", *more])
                serial += j - i

    return store.map_arrow(df, scan, "row_id long, doc_id long, text_hash long, n_shingles long, set_a long, set_b long, "
                                     "signature array<int>" + "".join(f", {c} long" for c in more))


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Of (a, b) pairs those whose whole shingle sets are similar enough."""
    wanted = store.written(pairs.select(F.col("a").alias("rid")).union(pairs.select("b")).distinct(), "pair-ids")
    texts = texts.join(store.maybe_broadcast(wanted), "rid", "left_semi")
    met = (pairs.join(texts.select(F.col("rid").alias("a"), F.col("text").alias("text_a")), "a")
           .join(texts.select(F.col("rid").alias("b"), F.col("text").alias("text_b")), "b"))

    def side(batch, name):
        """(all rows' set elements, their rows, set size of each row); a text that stands in many rows is read once."""
        _, first, again = np.unique(batch.column(name).to_numpy(), return_index=True, return_inverse=True)
        h, at = shingle_sets(*ta.flat(batch.column(f"text_{name}").take(pa.array(first))))
        n = np.diff(at)[again]
        to = np.concatenate([[0], np.cumsum(n)])
        return h[np.arange(to[-1]) + np.repeat(at[again] - to[:-1], n)], np.repeat(np.arange(len(n)), n), n

    def scan(batches):
        for whole in batches:
            for k in range(0, whole.num_rows, 2048):
                batch = whole.slice(k, 2048)
                (x, row_x, n_x), (y, row_y, n_y) = side(batch, "a"), side(batch, "b")
                row = np.concatenate([row_x, row_y])
                key = ta.mixed(np.concatenate([x, y]) + row.astype(np.uint64) * np.uint64(ta.BASE))
                order = np.argsort(key)
                met_ = key[order[1:]] == key[order[:-1]]
                both = ta.per_row(row[order[1:][met_]], batch.num_rows)
                keep = 100 * both >= SIMILARITY_PERCENT * (n_x + n_y - both)
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return store.map_arrow(met.select("a", "b", "text_a", "text_b"), scan, "a long, b long")


def _matching(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Of (a, b) pairs those with enough equal coordinates and sizes that allow the similarity."""
    side = lambda x: reps.select(F.col("row_id").alias(x), F.col("signature").alias(f"s_{x}"), F.col("n_shingles").alias(f"n_{x}"))
    met = pairs.join(side("a"), "a").join(side("b"), "b")
    equal = F.aggregate(F.zip_with("s_a", "s_b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    fits = 100 * F.least("n_a", "n_b") >= SIMILARITY_PERCENT * F.greatest("n_a", "n_b")
    return met.where(fits & (equal >= LEAST_MATCHES)).select("a", "b")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (doc_id, n_shingles, component_id, kept)."""
    own = _grouped(df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                             F.xxhash64(F.col(text_col)).alias("text_hash")))
    component = F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return own.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _grouped(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` (doc_id, text, text_hash, further longs) without text: n_shingles, component and its least doc_id.

    Rows without shingles are linked with nothing: their component is null.
    """
    rows = store.written(_described(docs), "minhash-rows")
    sets = rows.where("n_shingles > 0").groupBy("set_a", "set_b", "n_shingles").agg(
        F.min(F.struct("row_id", F.coalesce("doc_id", F.lit(int(NO_ID))).alias("doc_key"), "text_hash")).alias("r"),
        F.min("doc_id").alias("least_id"))
    sets = store.written(sets.select("set_a", "set_b", "n_shingles", "r.*", "least_id"), "minhash-sets")
    signed = rows.select("row_id", "signature").join(sets.select("row_id", "n_shingles", "doc_key", "text_hash"), "row_id")

    def posted(t: DataFrame) -> DataFrame:
        return t.select(F.col("row_id").alias("rid"), F.posexplode("signature").alias("k", "v")).select(
            "rid", F.shiftleft(F.col("k").cast("long"), 32).bitwiseOR(F.col("v").bitwiseAND(F.lit(0xFFFFFFFF))).alias("key"))

    signed = store.written(signed, "minhash-reps")
    counts = posted(signed).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = posted(signed).join(counts, "key")
    lists = shared.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("n", "key"))).alias("keys"))  # at most 64 a rid
    lists = store.written(lists.where(F.size("keys") >= LEAST_MATCHES), "minhash-lists")
    active = store.maybe_broadcast(store.written(lists.select(F.col("rid").alias("row_id")), "minhash-active"))
    reps = store.written(signed.join(active, "row_id", "left_semi"), "minhash-active-reps")
    doc_key = F.coalesce("doc_id", F.lit(int(NO_ID)))
    places = store.written(reps.select(F.col("row_id").alias("rid"), "doc_key", "text_hash"), "minhash-places")
    # rows that repeat a representative's id and text are joined too: one of them is enough
    texts = store.written(docs.withColumn("doc_key", doc_key).join(
        store.maybe_broadcast(places), ["doc_key", "text_hash"]).select("rid", "text").dropDuplicates(["rid"]), "minhash-texts")

    # hubs: first the member with the fewest values of its own (the middle of a group of near copies), then any
    postings = lists.select("rid", F.size("keys").alias("s"), F.explode("keys.key").alias("key"))
    labels = None
    for turn in range(STAR_ROUNDS):
        order = F.struct((F.lit(COORDINATES) - F.col("s") if turn == 0 else F.lit(0)).alias("own"), F.xxhash64("rid", F.lit(turn)).alias("o"), "rid")
        hubs = postings.groupBy("key").agg(F.min(order)["rid"].alias("hub"))
        hits = postings.join(hubs, "key").where("rid != hub").groupBy("rid", "hub").agg(F.count(F.lit(1)).alias("hits"))
        best = Window.partitionBy("rid").orderBy(F.desc("hits"), "hub")
        pairs = _apart(hits, labels, "rid", "hub").withColumn("place", F.row_number().over(best)).where(
            F.col("place") <= HUBS_A_ROUND).select(F.col("rid").alias("a"), F.col("hub").alias("b"))
        labels, grew = _joined(labels, _links(pairs, reps, texts))
        if not grew:
            break
    prefix = lists.select("rid", F.slice("keys.key", F.lit(1), F.size("keys") - LEAST_MATCHES + 1).alias("own"))
    prefix = prefix.select("rid", "own", F.explode("own").alias("key"))
    live = store.written(_undecided(_tagged(prefix, labels)), "minhash-live")
    able = _able(live, texts)
    live = store.written(_undecided(live.join(able, "rid")), "minhash-able")
    rest, near = _across(live, able, texts)
    labels, _ = _joined(labels, _links(store.written(rest, "minhash-across"), reps, texts).union(near))

    found = sets.select("set_a", "set_b", "n_shingles", "least_id", F.col("row_id").alias("id")).join(labels, "id", "left")
    found = found.withColumn("component", F.coalesce("component", "id"))
    least = found.groupBy("component").agg(F.min("least_id").alias("component_id"))
    found = found.join(least, "component").select("set_a", "set_b", F.col("n_shingles").alias("n"), "component", "component_id")
    own = rows.join(found, (rows.set_a == found.set_a) & (rows.set_b == found.set_b) & (rows.n_shingles == found.n), "left")
    return own.select(*(c for c in docs.columns if c != "text"), "n_shingles", "component", "component_id")


def _undecided(postings: DataFrame) -> DataFrame:
    """Postings (rid, key, label, ...) under keys that have more than one label."""
    open_ = postings.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x != y").select("key")
    return postings.join(open_, "key", "left_semi")


def _sets(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """(rid, h, parity sketch) of the wanted representatives; h: their distinct shingles."""

    def scan(batches):
        for batch in batches:
            data, off = ta.flat(batch.column("text"))
            for i, j in ta.pieces(off, 1 << 20):
                h, at = shingle_sets(data[off[i]:off[j]], off[i:j + 1] - off[i])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rid").slice(i, j - i), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(h.view(np.int64))),
                     *(pa.array(x) for x in parity_sketches(h, at).reshape(-1, SKETCH_LONGS).T.copy())],
                    names=["rid", "h", *SKETCH])

    own = store.map_arrow(texts.join(store.maybe_broadcast(ids), "rid", "left_semi"), scan, "rid long, h array<long>, " + ", ".join(f"{x} long" for x in SKETCH))
    return own.dropDuplicates(["rid"])


def _able(live: DataFrame, texts: DataFrame) -> DataFrame:
    """(rid, n, c) of representatives that can still have a link: of their n shingles c are in another live one too."""
    own = _sets(texts, store.written(live.select("rid").distinct(), "minhash-live-ids"))
    each = own.select("rid", F.explode("h").alias("h"))
    shared = each.groupBy("h").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("h")
    c = each.join(shared, "h", "left_semi").groupBy("rid").agg(F.count(F.lit(1)).alias("c"))
    able = own.select("rid", *SKETCH, F.size("h").cast("long").alias("n")).join(c, "rid")
    return store.written(able.where(10000 * F.col("c") >= 100 * SIMILARITY_PERCENT * F.col("n")), "minhash-able-ids")


def _near() -> F.Column:
    """Whether shared shingles (c, c_b) and sketches of two sets of n and n_b elements allow the similarity."""
    least = F.least("c", "c_b") * (100 + SIMILARITY_PERCENT) >= SIMILARITY_PERCENT * (F.col("n") + F.col("n_b"))
    # the sets may differ in this many elements; their sketches differ in no more bits than that
    unlike = [F.bit_count(F.col(x).bitwiseXOR(F.col(f"{x}_b"))) for x in SKETCH]
    return least & (sum(unlike[1:], unlike[0]) * (100 + SIMILARITY_PERCENT) <= (100 - SIMILARITY_PERCENT) * (F.col("n") + F.col("n_b")))


def _across(live: DataFrame, able: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs that share a key, are of different components and may reach the similarity; and links found on the way.

    Of a key's members only those outside its most frequent component look for partners, so a large component of near
    copies is not paired with itself. Where these are many, ``_met`` finds the partners without pairing the list.
    """
    size = live.groupBy("key", "label").agg(F.count(F.lit(1)).alias("k"))
    main = size.groupBy("key").agg(F.max(F.struct("k", "label")).alias("m"), F.sum("k").alias("k"))
    main = store.written(main.select("key", F.col("m.label").alias("main"), (F.col("k") - F.col("m.k") > OUTSIDE).alias("wide")), "minhash-mains")
    narrow = live.join(main.where("NOT wide").drop("wide"), "key")
    other = live.select("key", *(F.col(c).alias(f"{c}_b") for c in ("rid", "label", "n", "c", "own", *SKETCH)))
    once = (F.col("label_b") == F.col("main")) | (F.col("rid") < F.col("rid_b"))
    first = F.array_intersect("own", "own_b")[0] == F.col("key")  # of all lists they share, in one
    pairs = (narrow.where("label != main").join(other, "key").where((F.col("label") != F.col("label_b")) & once & _near() & first)
             .select(F.least("rid", "rid_b").alias("a"), F.greatest("rid", "rid_b").alias("b")))
    places = live.select("key", "rid", "label").join(main.where("wide").drop("wide"), "key")
    places = store.written(places.groupBy("main", "rid").agg(F.first("label").alias("label"), F.count(F.lit(1)).alias("lists")), "minhash-wide")
    if places.isEmpty():
        return pairs.distinct(), pairs.limit(0)
    met, links = _met(places, texts)
    side = lambda x, end: able.select(F.col("rid").alias(x), *(F.col(c).alias(c + end) for c in ("n", "c", *SKETCH)))
    met = met.join(side("a", ""), "a").join(side("b", "_b"), "b").where(_near()).select("a", "b")
    return pairs.union(met).distinct(), links


def _met(places: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs of one ``main`` that may reach the similarity, and links of members with the pivot: places (main, rid, label, lists).

    The pivot is the member of the main component that is in most lists. d is the number of elements by which a set differs
    from the pivot's, far whether that is too many for a link. Two sets differ in at most ``d + d_b - 2 * common``
    elements (common: differences that both have), so they are only similar if
    ``2 * common >= d + d_b - part * (n + n_b)``, part being the share of their sizes that similar sets differ in.
    """
    gap, whole = 100 - SIMILARITY_PERCENT, 100 + SIMILARITY_PERCENT  # part is gap / whole; no similar set has over 100 / SIMILARITY_PERCENT times as many elements
    sets = store.written(_sets(texts, store.written(places.select("rid").distinct(), "minhash-wide-ids")).select("rid", "h"), "minhash-wide-sets")
    pivot = places.where("label = main").groupBy("main").agg(F.max(F.struct("lists", "rid"))["rid"].alias("pivot"))
    pivot = store.written(pivot.join(sets, F.col("pivot") == F.col("rid")).select("main", "pivot", F.col("h").alias("base")), "minhash-pivots")
    own = places.drop("lists").join(sets, "rid").join(store.maybe_broadcast(pivot), "main")
    own = own.select("main", "rid", "label", "pivot", F.size("h").cast("long").alias("n"), F.size("base").cast("long").alias("m"),
                     F.concat(F.array_except("h", "base"), F.array_except("base", "h")).alias("diff"))
    own = own.withColumn("d", F.size("diff").cast("long")).withColumn("far", whole * F.col("d") > gap * (F.col("n") + F.col("m")))
    own = store.written(own, "minhash-apart")
    links = own.where("NOT far AND label != main").select(F.least("rid", "pivot").alias("a"), F.greatest("rid", "pivot").alias("b"))

    # differences that two or more members have, the rarest first; those of one only would come before them
    each = own.select("main", "rid", F.explode("diff").alias("h"))
    again = each.groupBy("main", "h").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    rare = each.join(again, ["main", "h"]).groupBy("main", "rid").agg(F.array_sort(F.collect_list(F.struct("k", "h"))).alias("e"))
    rare = store.written(own.drop("diff", "pivot").join(rare, ["main", "rid"]).withColumn(
        "seeks", F.col("far") & (F.col("label") != F.col("main"))), "minhash-rare")
    # the least number of common differences: of one that is met, and of one that seeks; if both seek, the farther one does
    met_least = F.greatest(F.expr(f"({whole} * d - {gap} * (n - m)) div {2 * whole} + 1"), F.when(
        F.col("seeks"), F.ceil(F.col("d") - gap * F.col("n") / (2 * SIMILARITY_PERCENT))).otherwise(F.ceil(F.col("d") - gap * F.col("n") / SIMILARITY_PERCENT)))
    seek_least = F.greatest(F.lit(1), F.ceil(F.col("d") - gap * F.col("n") / SIMILARITY_PERCENT))

    def prefix(t: DataFrame, least) -> DataFrame:
        single = F.col("d") - F.size("e")
        return t.select("main", "rid", "label", "n", "d", "seeks", single.alias("single"), F.posexplode(F.slice(
            "e", F.lit(1), F.greatest(F.lit(0), F.col("d") - least + 1 - single).cast("int"))).alias("at", "x")).select(
            "main", "rid", "label", "n", "d", "seeks", (F.col("single") + F.col("at")).alias("at"), F.col("x.h").alias("h"))

    right = prefix(rare, met_least)
    right = right.select("main", "h", *(F.col(c).alias(f"{c}_b") for c in ("rid", "label", "n", "d", "seeks", "at")))
    once = ~F.col("seeks_b") | (F.struct("d_b", "rid_b") < F.struct("d", "rid"))
    fits = 100 * F.least("n", "n_b") >= SIMILARITY_PERCENT * F.greatest("n", "n_b")
    # where the first common difference stands, at most this many are common
    most = F.least(F.col("d") - F.col("at"), F.col("d_b") - F.col("at_b"))
    enough = whole * (2 * most - F.col("d") - F.col("d_b")) + gap * (F.col("n") + F.col("n_b")) >= 0
    pairs = prefix(rare.where("seeks"), seek_least).join(right, ["main", "h"]).where((F.col("label") != F.col("label_b")) & once & fits & enough)
    return store.written(pairs.select(F.least("rid", "rid_b").alias("a"), F.greatest("rid", "rid_b").alias("b")).distinct(), "minhash-met"), links


def _links(pairs: DataFrame, reps: DataFrame, texts: DataFrame) -> DataFrame:
    pairs = store.written(_matching(pairs, reps), "minhash-pairs")
    return store.written(_confirmed(pairs, texts), "minhash-links")


def _tagged(ids: DataFrame, labels: DataFrame | None, rid: str = "rid", label: str = "label") -> DataFrame:
    if labels is None:
        return ids.withColumn(label, F.col(rid))
    named = labels.select(F.col("id").alias(rid), F.col("component").alias(label))
    return ids.join(named, rid, "left").withColumn(label, F.coalesce(label, rid))


def _apart(pairs: DataFrame, labels: DataFrame | None, a: str, b: str) -> DataFrame:
    """Pairs that are not yet in one component."""
    if labels is None:
        return pairs
    return _tagged(_tagged(pairs, labels, a, "label_a"), labels, b, "label_b").where("label_a != label_b").drop("label_a", "label_b")


def _joined(labels: DataFrame | None, links: DataFrame) -> tuple[DataFrame, bool]:
    """Components of the links so far, and whether there were new ones."""
    grew = not links.isEmpty()
    if labels is not None:
        if not grew:
            return labels, False
        links = links.union(labels.select(F.col("id").alias("a"), F.col("component").alias("b")))
    return components(links), grew


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with exactly one row of each group of near copies: the one with the smallest id.

    A row is known by its id and the 128-bit hash of its text, so rows that share an id (or have none) are decided each;
    of equal ids the smallest hash stays, of rows equal in both any one. Rows without shingles all stay.
    """
    own, name = store.renamed(df)
    text = F.col(name[text_col])
    key = {"id_": F.col(name[id_col]).cast("long"), "h_": F.xxhash64(text), "g_": F.xxhash64(F.lit(1), text)}
    docs = own.select(key["id_"].alias("doc_id"), text.alias("text"), key["h_"].alias("text_hash"), key["g_"].alias("text_hash2"))
    rows = store.written(_grouped(docs).where("component IS NOT NULL").select(
        "component", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "text_hash2").alias("r")), "near-rows")
    groups = rows.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.min("r").alias("first")).where("n > 1").drop("n")
    copies = rows.join(store.maybe_broadcast(store.written(groups, "near-groups")), "component")
    copies = copies.groupBy("r").agg(F.count(F.lit(1)).alias("n"), F.first(F.col("r") == F.col("first")).alias("stays"))
    copies = store.written(copies.select(F.col("r.doc_id").alias("own_id"), F.col("r.text_hash").alias("own_h"),
                                         F.col("r.text_hash2").alias("own_g"), "n", "stays"), "near-copies")

    def joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        on = left["id_"].eqNullSafe(right["own_id"]) & (left["h_"] == right["own_h"]) & (left["g_"] == right["own_g"])
        return left.join(store.maybe_broadcast(right), on, how)

    keyed = own.withColumns(key)
    repeated = copies.where("stays AND n > 1").drop("n", "stays")
    if repeated.isEmpty():
        return joined(keyed, copies.where("NOT stays").drop("n", "stays"), "left_anti").select(*own.columns).toDF(*df.columns)
    rest = joined(keyed, copies.where("NOT stays OR n > 1").drop("n", "stays"), "left_anti")
    once = rest.unionByName(joined(keyed, repeated, "left_semi").dropDuplicates(list(key)))
    return once.select(*own.columns).toDF(*df.columns)


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle count, component and verdict of every document."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS k, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT k, CASE WHEN len(w) < {SHINGLE_WORDS} THEN array_to_string(w, ' ')
    ELSE w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4] END AS g
  FROM (SELECT k, w, unnest(range(1, greatest(len(w) - {SHINGLE_WORDS} + 2, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT k, count(*) AS n FROM s GROUP BY k),
both_ AS (
  SELECT x.k AS a, y.k AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.k != y.k GROUP BY x.k, y.k),
link AS (
  SELECT a, b FROM both_ JOIN n na ON na.k = a JOIN n nb ON nb.k = b
  WHERE 100 * c >= {SIMILARITY_PERCENT} * (na.n + nb.n - c)),
reach AS (SELECT k AS a, k AS b FROM d UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
comp AS (SELECT reach.a AS k, min(d.doc_id) AS component_id FROM reach JOIN d ON d.k = reach.b GROUP BY reach.a)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id,
       doc_id IS NOT DISTINCT FROM component_id AS kept
FROM d JOIN comp USING (k) LEFT JOIN n USING (k)
"""

QUERIES = {"op7_minhash_dedup": op7_minhash_dedup}
ORACLE = {"op7_minhash_dedup": SQL}
