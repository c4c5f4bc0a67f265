"""Merkle manifest of a dataset: every row's digest, its group's subroot, one root, and proofs that fold back to it.

A row's leaf is the digest of its columns, each with its byte length. Leaves are ranked within their group by a range sort
and the counts of its partitions, then dealt to aligned blocks of 16**3 ranks. A block keeps each level as one string of
fixed-width hex digests: substrings of 16 digests hash to the parents, and what flanks a digest in its substring is its
sibling segment. Block nodes are ranked by block number and go through the same step again until every group has one node;
the groups' nodes, ranked by group name, go through it once more and give the root. On the way back a block's segments are
put before those of the block above it, so a row's proof is the segments of some blocks, at any size of the table.

All of it is DataFrame and SQL expressions. A group of any size is spread over blocks; no task holds more than a block of a
group. Tables between the steps are written to the shared folder.

Defined results: null groups are a group of their own and come first; null ids come first and are never tampered with;
rows with one id are ordered by their leaf; repeated rows are leaves of their own; the proof of a lone leaf is the digest of
nothing and its root is the leaf; an empty table has no rows, no subroot and no root; other columns are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from triplake.llm import store

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 16
BLOCK_LEVELS = 3
TAMPER_EVERY = 5
DIGEST = 64  # hex digits


def leaf_digest(columns: dict[str, Column]) -> Column:
    """Digest of the columns' values in order: ``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    parts = []
    for value in columns.values():
        v = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _ranked(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``rank`` (from 0) within ``g`` by ``order`` and ``n``, the rows of ``g``.

    The range sort splits a group over partitions (a row number breaks ties of equal rows); partition counts give the
    offsets, one row for each partition and group that meet.
    """
    spark = rows.sparkSession
    rows = store.written(rows.withColumn("salt", F.monotonically_increasing_id()), f"{name}-rows")
    keys = [F.col(c).asc_nulls_first() for c in ("g", *order, "salt")]
    sorted_ = store.written(rows.repartitionByRange(store.default_width(spark), *keys).sortWithinPartitions(*keys)
                            .drop("salt").withColumn("place", F.monotonically_increasing_id())
                            .withColumn("part", F.spark_partition_id()), f"{name}-sorted")
    before = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = store.written(
        sorted_.groupBy("g", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("m"))
        .select("g", "part", (F.col("first") - F.coalesce(F.sum("m").over(before), F.lit(0))).alias("zero"),
                F.sum("m").over(Window.partitionBy("g")).alias("n")), f"{name}-starts")
    return (sorted_.join(store.maybe_broadcast(starts), ["g", "part"])
            .withColumn("rank", F.col("place") - F.col("zero")).drop("part", "place", "zero"))


def _runs(level: str) -> Column:
    """A level's string cut to the strings of up to 16 digests that have one parent."""
    width = FANOUT * DIGEST
    return F.expr(f"transform(sequence(0, (length({level}) - 1) div {width}), "
                  f"k -> cast(substring(cast({level} as binary), k * {width} + 1, {width}) as string))")


def _blocks(nodes: DataFrame, name: str) -> DataFrame:
    """One row a block: its members in rank order, ``height`` (levels it folds), the runs of each level and its node ``top``."""
    size = FANOUT ** BLOCK_LEVELS
    height = sum((F.col("n") > FANOUT ** k).cast("int") for k in range(BLOCK_LEVELS))
    out = (nodes.groupBy("g", F.expr(f"rank div {size}").alias("block"), "n")
           .agg(F.sort_array(F.collect_list(F.struct("rank", "node", "member"))).alias("members"))
           .withColumn("height", height)
           .withColumn("level0", F.expr("array_join(transform(members, x -> x.node), '')")))
    for k in range(BLOCK_LEVELS):
        out = (out.withColumn(f"runs{k}", F.when(F.col("height") > k, _runs(f"level{k}")))
               .withColumn(f"level{k + 1}", F.when(F.col("height") > k, F.expr(f"array_join(transform(runs{k}, r -> sha2(r, 256)), '')"))
                           .otherwise(F.col(f"level{k}"))))
    return store.written(out.select("g", "block", "n", "height", F.expr("transform(members, x -> x.member)").alias("members"),
                                    *[f"runs{k}" for k in range(BLOCK_LEVELS)], F.col(f"level{BLOCK_LEVELS}").alias("top")), name)


def _climbed(nodes: DataFrame, name: str) -> list[DataFrame]:
    """Blocks of every round, from the given nodes up to one block a group."""
    rounds = [_blocks(nodes, f"{name}-blocks")]
    size = FANOUT ** BLOCK_LEVELS
    most = rounds[0].agg(F.max("n")).first()[0] or 0
    while most > size:
        most = -(-most // size)
        rounds.append(_blocks(rounds[-1].select(
            "g", F.col("block").alias("rank"), F.col("top").alias("node"), F.expr(f"(n + {size - 1}) div {size}").alias("n"),
            F.struct("block").alias("member")), f"{name}-blocks"))
    return rounds


def _segments() -> Column:
    """The sibling segments, left and right, of the member at ``i`` of a block, level by level."""
    levels = []
    for k in range(BLOCK_LEVELS):
        run = f"runs{k}[cast(i div {FANOUT ** (k + 1)} as int)]"
        at = f"((i div {FANOUT ** k}) % {FANOUT}) * {DIGEST}"
        levels.append(f"named_struct('l', substring({run}, 1, cast({at} as int)), "
                      f"'r', substring({run}, cast({at} as int) + {DIGEST + 1}, {FANOUT * DIGEST}))")
    return F.expr(f"transform(members, (x, i) -> named_struct('member', x, 'path', "
                  f"concat(slice(array({', '.join(levels)}), 1, height), path)))")


def _descended(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """Rows (g, member, path, carry) of the first round's members: their blocks' segments before those ``above`` their group.

    ``above`` has a row a group: g, path and carry (a struct that every member of the group gets).
    """
    upper = above.withColumn("block", F.lit(0).cast("long"))
    for k, blocks in reversed(list(enumerate(rounds))):
        placed = (blocks.join(store.maybe_broadcast(store.written(upper, "merkle-paths")), ["g", "block"])
                  .select("g", "carry", F.explode(_segments()).alias("x")).select("g", "carry", "x.member", "x.path"))
        if k:
            upper = placed.select("g", F.col("member.block").alias("block"), "path", "carry")
    return placed


def manifest(df: DataFrame, columns: tuple[str, ...] = COLUMNS, id_col: str = "doc_id", group_col: str = "source",
             tampered: dict[str, Column] | None = None) -> DataFrame:
    """One row a row of ``df``: (id, group, leaf, subroot, root, path, shown_leaf).

    ``path`` has the sibling segments (l, r) from the leaf to the root. ``shown_leaf`` is the leaf of the row with the
    columns in ``tampered`` replaced by those expressions: what somebody who holds a changed copy would present.
    """
    cells = {c: F.col(f"`{c}`") for c in columns}
    shown = leaf_digest({**cells, **(tampered or {})})
    group = F.col(f"`{group_col}`").cast("string")
    leaves = df.select(F.coalesce(F.concat(F.lit("="), group), F.lit("-")).alias("g"), F.col(f"`{id_col}`").alias("id"),
                       group.alias("group"), leaf_digest(cells).alias("node"), shown.alias("shown"))
    leaves = leaves.withColumn("shown", F.when(F.col("shown") != F.col("node"), F.col("shown")))
    ranked = _ranked(leaves, ["id", "node"], "merkle-leaves")
    rounds = _climbed(ranked.select("g", "rank", "n", "node", F.struct("id", "group", F.col("node").alias("leaf"), "shown").alias("member")),
                      "merkle")
    subroots = rounds[-1].select(F.lit("").alias("g"), F.col("g").alias("name"), F.col("top").alias("node"))
    tops = _climbed(_ranked(subroots, ["name"], "merkle-subroots")
                    .select("g", "rank", "n", "node", F.struct("name", "node").alias("member")), "merkle-top")
    root = tops[-1].select("g", F.struct(F.col("top").alias("root")).alias("carry"),
                           F.expr("cast(array() as array<struct<l:string,r:string>>)").alias("path"))
    groups = _descended(tops, root).select(
        F.col("member.name").alias("g"), "path", F.struct(F.col("member.node").alias("subroot"), "carry.root").alias("carry"))
    return (_descended(rounds, groups)
            .select("member.id", "member.group", "member.leaf", "carry.subroot", "carry.root", "path",
                    F.coalesce("member.shown", "member.leaf").alias("shown_leaf")))


def proof_digest(path: Column) -> Column:
    """Digest of a path's segments, left to right and level by level."""
    return F.sha2(F.array_join(F.transform(path, lambda p: F.concat(p["l"], p["r"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a path's segments give."""
    return F.aggregate(path, leaf, lambda node, p: F.sha2(F.concat(p["l"], node, p["r"]), 256))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and what folding its possibly tampered copy gives."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_EVERY == 0, F.lit(False))
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    rows = manifest(docs, tampered={"text": F.when(hit, lowered).otherwise(F.col("text"))})
    return rows.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                       folded(F.col("shown_leaf"), F.col("path")).alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


# The checksum's table and the trees are built by their rules; a run's digests are kept as a list.
SQL = f"""
WITH RECURSIVE t AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i) ORDER BY i) AS crc
  FROM range(256) r(i)),
d AS (
  SELECT *, doc_id IS NOT NULL AND xor(4294967295, list_reduce(
           list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda p: ascii(substr(doc_id::VARCHAR, p, 1))::BIGINT),
           lambda c, b: xor(c // 256, crc[(xor(c, b) % 256) + 1]), 4294967295)) % {TAMPER_EVERY} = 0 AS hit
  FROM documents, t),
cells AS (
  SELECT doc_id, source, hit, text,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
         translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS low FROM d),
leaves AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || CASE WHEN hit THEN coalesce(strlen(low) || ':' || low, '-') ELSE coalesce(strlen(text) || ':' || text, '-') END) AS shown
  FROM cells),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY source) AS n, row_number() OVER () AS k FROM leaves),
tree AS (
  SELECT 0 AS level, source, pos, leaf AS h, n FROM placed
  UNION ALL
  SELECT level + 1, source, pos // {FANOUT}, sha256(string_agg(h, '' ORDER BY pos)), (n + {FANOUT - 1}) // {FANOUT}
  FROM tree WHERE n > 1 GROUP BY level, source, pos // {FANOUT}, n),
runs AS (SELECT level, source, pos // {FANOUT} AS run, list(h ORDER BY pos) AS hs FROM tree WHERE n > 1 GROUP BY ALL),
up AS (
  SELECT k, 0 AS level, source, pos, shown AS h, '' AS proof FROM placed
  UNION ALL
  SELECT k, level + 1, up.source, pos // {FANOUT},
         sha256(array_to_string(hs[1:pos % {FANOUT}], '') || h || array_to_string(hs[pos % {FANOUT} + 2:], '')),
         proof || array_to_string(hs[1:pos % {FANOUT}], '') || array_to_string(hs[pos % {FANOUT} + 2:], '')
  FROM up JOIN runs USING (level) WHERE runs.source IS NOT DISTINCT FROM up.source AND run = pos // {FANOUT}),
subs AS (
  SELECT source, h AS subroot, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM tree WHERE n = 1),
tree2 AS (
  SELECT 0 AS level, pos, subroot AS h, n FROM subs
  UNION ALL
  SELECT level + 1, pos // {FANOUT}, sha256(string_agg(h, '' ORDER BY pos)), (n + {FANOUT - 1}) // {FANOUT}
  FROM tree2 WHERE n > 1 GROUP BY level, pos // {FANOUT}, n),
runs2 AS (SELECT level, pos // {FANOUT} AS run, list(h ORDER BY pos) AS hs FROM tree2 WHERE n > 1 GROUP BY ALL),
arrived AS (SELECT k, arg_max(h, level) AS h, arg_max(proof, level) AS proof FROM up GROUP BY k),
up2 AS (
  SELECT k, 0 AS level, subs.pos, arrived.h, proof FROM arrived JOIN placed USING (k)
  JOIN subs ON subs.source IS NOT DISTINCT FROM placed.source
  UNION ALL
  SELECT k, level + 1, pos // {FANOUT},
         sha256(array_to_string(hs[1:pos % {FANOUT}], '') || h || array_to_string(hs[pos % {FANOUT} + 2:], '')),
         proof || array_to_string(hs[1:pos % {FANOUT}], '') || array_to_string(hs[pos % {FANOUT} + 2:], '')
  FROM up2 JOIN runs2 USING (level) WHERE run = pos // {FANOUT}),
ends AS (SELECT k, arg_max(h, level) AS folded_root, arg_max(proof, level) AS proof FROM up2 GROUP BY k)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified
FROM placed JOIN ends USING (k) JOIN subs ON subs.source IS NOT DISTINCT FROM placed.source,
     (SELECT h AS root FROM tree2 WHERE n = 1)
"""

QUERIES = {"op11_merkle_manifest": op11_merkle_manifest}
ORACLE = {"op11_merkle_manifest": SQL}
