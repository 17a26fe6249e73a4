"""Merkle manifest of a dataset: digests rise by time-forward processing, proofs come down.

A row's leaf is the digest of its fields. The leaves of a group (a source), in
the order of their ids, form a tree of fan-out 16: while several nodes are
left, every 16 consecutive ones become their digest. The groups' roots, in the
order of the groups, form one more tree in the same way.

Nodes are labelled by level and place, so that every parent comes after its
children. *Time-forward processing* sends a node's digest ahead, to its
parent's label, through a priority queue that gives messages back in the order
of their labels; a node is made when its children's messages come out. The
*reversed sweep* takes the labels backwards: the root's proof is empty, and a
node sends each child the child's siblings followed by its own proof, so that a
leaf receives its whole proof, level by level up to the root.

The queue is external in blocks of three levels: Spark's shuffle, sorted by
(tree, block, place) and spilled as needed, delivers a block's messages in
order; inside a block of at most 4,096 nodes the queue is a heap. So a sweep
over n leaves takes log4096(n) shuffles, of which the first moves all leaves
and the next 1/4096 of them; a source that holds most rows is many blocks, and
a proof is copied per block, not per leaf, before it reaches its leaves.

Places come from one range partitioning by (group, id, leaf), written with each
row's position in its partition; what earlier partitions hold of a group is a
running total of one row a partition and group.

Defined results: a null field is ``-`` in the leaf; a null group is a group of
its own, before all others; null ids come first, and rows of equal ids are
ordered by leaf, so equal rows have neighbouring places and each its own proof; one leaf is its
group's root, one group's root the root; a text of any length is hashed whole; other
columns, also of clashing names, are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlens.llm.common import per_task, small_batches, table, written

FAN, LEVELS = 16, 3
BLOCK = FAN ** LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf(fields: list[Column]) -> Column:
    """Digest of the fields: byte count, colon and value each, ``-`` for null."""
    def cell(c: Column) -> Column:
        s = c.cast("string")
        return F.when(s.isNull(), "-").otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))
    return F.sha2(F.concat(*(cell(c) for c in fields)), 256)


def digest(parts: list[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


# --- inside a block -----------------------------------------------------------

def rise(digests: list[str], levels: int) -> tuple[dict[tuple[int, int], list[str]], list[str]]:
    """Children's digests by label (level, place), and the digests that are left at the top."""
    runs: dict[tuple[int, int], list[str]] = {}
    queue = [((1, i // FAN), i, d) for i, d in enumerate(digests)]  # in order: a heap already
    top: list[str] = [] if levels else digests
    while levels and queue:
        label = queue[0][0]
        children = runs[label] = []
        while queue and queue[0][0] == label:
            children.append(heapq.heappop(queue)[2])
        level, node = label
        made = digest(children)
        if level < levels:
            heapq.heappush(queue, ((level + 1, node // FAN), node, made))
        else:
            top.append(made)
    return runs, top


def descend(runs: dict[tuple[int, int], list[str]], levels: int, path: list[str]):
    """(place, proof) of every leaf of a block whose top has the proof ``path``: the labels backwards."""
    queue = [(-levels, 0, path)]
    while queue:
        level, node, path = heapq.heappop(queue)
        if level == 0:
            yield -node, path
            continue
        children = runs[-level, -node]
        for j in range(len(children)):
            sides = ["".join(children[:j]), "".join(children[j + 1:])]
            heapq.heappush(queue, (level + 1, node * FAN - j, sides + path))


def fold(own: str, path: list[str]) -> str:
    """Root from a leaf and its proof (left and right siblings in turn, lowest level first)."""
    for left, right in zip(path[::2], path[1::2], strict=True):
        own = digest([left, own, right])
    return own


# --- blocks from Spark's sorted shuffle ---------------------------------------

def _blocks(batches):
    """Rows of one (tree, block) at a time from batches sorted by (tree, block, place)."""
    key, held = None, []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if row[:2] != key:
                if held:
                    yield held
                key, held = row[:2], []
            held.append(row)
    if held:
        yield held


def _columns(made, types, names, rows: int = 2048):
    held = []
    for row in made:
        held.append(row)
        if len(held) == rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types, strict=True)], names=names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types, strict=True)], names=names)


_NODE = "tree string, idx long, left int, digest string"


def _risen(batches):
    def made():
        for block in _blocks(batches):
            tree, number, _, left = block[0][:4]
            levels = min(LEVELS, left)
            yield tree, number, left - levels, rise([r[4] for r in block], levels)[1][0]
    yield from _columns(made(), [pa.string(), pa.int64(), pa.int32(), pa.string()], ["tree", "idx", "left", "digest"])


def _dealt(nodes: DataFrame) -> DataFrame:
    """Rows of a block in one partition, in the order of their labels."""
    return nodes.repartition("tree", "block").sortWithinPartitions("tree", "block", "idx")


def _block() -> Column:
    return F.call_function("div", F.col("idx"), F.lit(BLOCK)).alias("block")


def _tower(nodes: DataFrame) -> list[DataFrame]:
    """Tables of nodes, a block's levels apart; where ``left`` is 0, a node is its tree's root."""
    tables = [nodes]
    height = nodes.agg(F.max("left")).first()[0] or 0
    for _ in range(0, height, LEVELS):
        low = tables[-1].where("left > 0").select("tree", _block(), "idx", "left", "digest")
        tables.append(written(_dealt(low).mapInArrow(per_task(_risen), _NODE)))
    return tables


def _roots(tables: list[DataFrame]) -> DataFrame:
    out = None
    for t in tables:
        part = t.where("left = 0").select("tree", "digest")
        out = part if out is None else out.unionByName(part)
    return out


def _sent(nodes: DataFrame, messages: DataFrame, extra: list[str]) -> DataFrame:
    """A block's proof (place -1, so the first of its rows) and its nodes."""
    own = nodes.select("tree", _block(), "idx", "left", "digest", F.lit(None).cast("array<string>").alias("path"), *extra)
    blank = [F.lit(None).cast(nodes.schema[c].dataType).alias(c) for c in extra]
    sent = messages.select("tree", F.col("idx").alias("block"), F.lit(-1).cast("long").alias("idx"), F.lit(0).alias("left"),
                           F.lit("").alias("digest"), "path", *blank)
    return _dealt(own.unionByName(sent))


def _received(head: int):
    """(row, head of the message, proof) for the nodes of sorted blocks."""
    def received(batches):
        for block in _blocks(batches):
            message, rows = block[0], block[1:]
            if not rows:
                continue
            levels = min(LEVELS, rows[0][3])
            runs, _ = rise([r[4] for r in rows], levels)
            for place, path in descend(runs, levels, message[5][head:]):
                yield rows[place], message[5][:head], path
    return received


def _handed_down(head: int):
    def handed(batches):
        yield from _columns(((r[0], r[2], r[4], h + path) for r, h, path in _received(head)(batches)),
                            [pa.string(), pa.int64(), pa.string(), pa.list_(pa.string())], ["tree", "idx", "digest", "path"])
    return handed


def _come_down(tables: list[DataFrame], seeds: DataFrame, head: int) -> DataFrame:
    """Messages (tree, idx, path) for the blocks of the lowest table, from the trees' roots (tree, path)."""
    seeds = seeds.select("tree", F.lit(0).cast("long").alias("idx"), "path")
    messages = seeds  # whatever height a tree has, its root is the only node of its table, in block 0
    for level in range(len(tables) - 1, 0, -1):
        down = _sent(tables[level], _for_blocks(tables[level], messages, seeds), [])
        down = written(down.mapInArrow(per_task(_handed_down(head)), "tree string, idx long, digest string, path array<string>"))
        messages = down.select("tree", "idx", "path")
    return _for_blocks(tables[0], messages, seeds) if len(tables) > 1 else seeds


def _for_blocks(nodes: DataFrame, above: DataFrame, seeds: DataFrame) -> DataFrame:
    """One message a block of ``nodes``: from the table above, or the seed of a tree that ends here."""
    if above is seeds:
        return seeds.join(nodes.where("left = 0").select("tree"), "tree", "left_semi")
    return above.unionByName(seeds.join(nodes.where("left = 0").select("tree"), "tree", "left_semi"))


def _numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` with their place in their tree (``idx``) and the levels up to its root (``left``)."""
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = written(nodes.repartitionByRange(parts, "tree", *order).sortWithinPartitions("tree", *order)
                     .withColumn("at", F.monotonically_increasing_id()))
    placed = placed.withColumn("part", F.shiftright("at", 33))
    runs = placed.groupBy("tree", "part").agg(F.min("at").alias("low"), F.count("*").alias("n"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = F.sum("n").over(Window.partitionBy("tree"))
    height = sum(((whole > FAN ** k).cast("int") for k in range(1, 15)), (whole > 1).cast("int"))
    runs = runs.select("tree", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("low")).alias("shift"), height.alias("left"))
    return placed.join(runs, ["tree", "part"]).withColumn("idx", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def manifest(docs: DataFrame, id_col: str = "doc_id", group: str = "source", fields=FIELDS, claimed: Column | None = None,
             proofs: bool = False) -> DataFrame:
    """Per row: id, ``leaf``, ``subroot`` (its group's root), ``root``, ``proof_sha256``, ``folded_root``, ``verified``.

    ``claimed`` is the leaf digest to verify (null: the row's own): ``folded_root`` is the root it gives with
    the row's proof, ``verified`` whether that is the root. With ``proofs`` there is also ``proof``: left and
    right siblings in turn, lowest level first.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    own = leaf([F.col(c) for c in fields])
    claim = F.lit(None).cast("string") if claimed is None else claimed
    # "s" before a group's name keeps the null group ("") apart and first.
    rows = written(docs.select(F.coalesce(F.concat(F.lit("s"), F.col(group).cast("string")), F.lit("")).alias("tree"),
                               F.col(id_col).alias("key"), own.alias("digest"), claim.alias("claim")))
    tables = _tower(_numbered(rows, ["key", "digest"]))
    # The groups' roots are the leaves of the tree of groups.
    groups = _roots(tables).select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    tops = _numbered(written(groups), ["name"])
    top_tables = _tower(tops)
    seed = _roots(top_tables).select("tree", F.array("digest").alias("path"))
    messages = _come_down(top_tables, seed, 1)

    def named(batches):
        made = ((r[6], h + [r[4]] + path) for r, h, path in _received(1)(batches))
        yield from _columns(made, [pa.string(), pa.list_(pa.string())], ["tree", "path"])

    seeds = written(_sent(tops, messages, ["name"]).mapInArrow(per_task(named), "tree string, path array<string>"))
    messages = _come_down(tables, seeds, 2)

    def proven(batches):
        key_type = None

        def made():
            for r, (root, subroot), path in _received(2)(seen()):
                folded = fold(r[7] or r[4], path)
                yield r[6], r[4], subroot, root, digest(path), folded, folded == root, path if proofs else None

        def seen():
            nonlocal key_type
            for b in batches:
                key_type = b.schema.field(6).type
                types[0] = key_type
                yield b

        types = [None, *[pa.string()] * 5, pa.bool_(), pa.list_(pa.string())]
        yield from _columns(made(), types, ["key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "proof"])

    out = _sent(tables[0], messages, ["key", "claim"]).mapInArrow(
        per_task(proven), f"key {kind.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, "
                          "folded_root string, verified boolean, proof array<string>")
    out = out.withColumnRenamed("key", id_col)
    return out if proofs else out.drop("proof")


def lower_case(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def op11_merkle_manifest(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = leaf([lower_case(F.col(c)) if c == "text" else F.col(c) for c in FIELDS])
    return manifest(docs, claimed=F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, tampered))


OP11_SQL = """
WITH RECURSIVE cells AS (
  SELECT doc_id, source, text,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-')
    || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
    || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-') AS head,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
    -- CRC-32 of the decimal id: a byte is mixed in, then eight steps of the reflected polynomial.
    xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
      lambda c: list_concat([CAST(ascii(c) AS BIGINT)], [-1, -1, -1, -1, -1, -1, -1, -1])))),
      lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295) AS crc
  FROM documents),
leaves AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN crc % 5 = 0 THEN sha256(head || coalesce(strlen(low) || ':' || low, '-')) END AS claim FROM cells),
placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
  count(*) OVER (PARTITION BY source) AS size FROM leaves),
low AS (
  SELECT source, 0 AS lvl, idx, leaf AS digest, size FROM placed
  UNION ALL
  SELECT source, lvl + 1, idx // 16, sha256(string_agg(digest, '' ORDER BY idx)), (size + 15) // 16 FROM low WHERE size > 1
  GROUP BY source, lvl, idx // 16, size),
subroots AS (
  SELECT source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, count(*) OVER () AS size FROM low WHERE size = 1),
high AS (
  SELECT 0 AS lvl, idx, digest, size FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 16, sha256(string_agg(digest, '' ORDER BY idx)), (size + 15) // 16 FROM high WHERE size > 1
  GROUP BY lvl, idx // 16, size),
runs AS (
  SELECT 0 AS top, source, lvl, idx // 16 AS node, list(digest ORDER BY idx) AS d FROM low WHERE size > 1 GROUP BY source, lvl, idx // 16
  UNION ALL
  SELECT 1, NULL, lvl, idx // 16, list(digest ORDER BY idx) FROM high WHERE size > 1 GROUP BY lvl, idx // 16),
walk AS (
  SELECT p.doc_id, p.source, p.idx AS start, 0 AS top, 0 AS lvl, p.idx, p.size, p.leaf, coalesce(p.claim, p.leaf) AS own, '' AS proof,
    s.idx AS sub_idx, s.size AS subs, s.digest AS subroot
  FROM placed p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source
  UNION ALL
  SELECT w.doc_id, w.source, w.start, CASE WHEN w.size > 1 THEN w.top ELSE 1 END, CASE WHEN w.size > 1 THEN w.lvl + 1 ELSE 0 END,
    CASE WHEN w.size > 1 THEN w.idx // 16 ELSE w.sub_idx END, CASE WHEN w.size > 1 THEN (w.size + 15) // 16 ELSE w.subs END, w.leaf,
    CASE WHEN w.size > 1 THEN sha256(array_to_string(list_concat(r.d[1:w.idx % 16], [w.own], r.d[w.idx % 16 + 2:]), '')) ELSE w.own END,
    CASE WHEN w.size > 1 THEN w.proof || array_to_string(list_concat(r.d[1:w.idx % 16], r.d[w.idx % 16 + 2:]), '') ELSE w.proof END,
    w.sub_idx, w.subs, w.subroot
  FROM walk w LEFT JOIN runs r ON w.size > 1 AND r.top = w.top AND r.lvl = w.lvl AND r.node = w.idx // 16
    AND (w.top = 1 OR r.source IS NOT DISTINCT FROM w.source)
  WHERE w.size > 1 OR w.top = 0)
SELECT w.doc_id, w.leaf, w.subroot, h.digest AS root, sha256(w.proof) AS proof_sha256, w.own AS folded_root, w.own = h.digest AS verified
FROM walk w, high h WHERE w.top = 1 AND w.size = 1 AND h.size = 1
"""
