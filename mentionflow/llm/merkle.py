"""Merkle manifest of a dataset: one root for all rows, and a proof for each.

Rows are leaves, grouped by source. Runs of ``FAN`` consecutive nodes become their hash,
level by level, until one node a source remains; the same over the sources gives the root.
Every node then holds the siblings on its way to its parent, and repeated self-joins of the
nodes double the distance that a node's proof spans, until every leaf reaches the root.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .common import bounded, numbered

#: Consecutive nodes that share a parent.
FAN = 3
#: Levels that one job climbs: a group has at most FAN ** CLIMB nodes.
CLIMB = 6
#: Highest level that a source can need.
LEVELS = 40

#: Bytes of nodes that a round broadcasts at most; beyond that the same join shuffles.
BROADCAST_BYTES = 32 << 20

_SIBLINGS = "array<struct<left:binary,right:binary>>"


def field(value: Column) -> Column:
    """A value as the leaf's hash takes it: ``-`` for NULL, else UTF-8 byte count, ``:``, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(values: list[Column]) -> Column:
    """Hash of a row's fields, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]), 256))


def hexed(digest: Column) -> Column:
    """Digests, or digests put together, in lowercase hex."""
    return F.lower(F.hex(digest))


def _hash_of(digests: Column) -> Column:
    """Hash of digests put together, which enter as hex text."""
    return F.unhex(F.sha2(hexed(digests), 256))


def _height(leaves: Column) -> Column:
    """Levels above the leaves until one node remains."""
    powers = F.array(*[F.lit(FAN ** k) for k in range(LEVELS) if FAN ** k < 2 ** 62])
    return F.size(F.filter(powers, lambda p: p < leaves))


def _joined(run: Column) -> Column:
    """An array of digests put together."""
    return F.aggregate(run, F.lit(b""), lambda all_, digest: F.concat(all_, digest))


def climb(leaves: DataFrame) -> DataFrame:
    """All nodes of the trees whose leaves are ``tree``, ``pos`` (0, 1, …), ``digest``, ``leaves`` (of the tree).

    Rows: ``tree``, ``level``, ``pos``, ``digest``, ``height`` (of the tree), ``left`` and
    ``right`` (digests of the siblings before and after the node in its run, put together).

    A job takes groups of FAN ** CLIMB consecutive nodes, whose ancestors inside the group
    need no other group, so each climbs CLIMB levels at once and hands on one node a group.
    """
    at = leaves.select("tree", F.lit(0).alias("level"), "pos", "digest", _height(F.col("leaves")).alias("height"))
    made = []
    while True:
        groups = (at.groupBy("tree", "level", "height", F.expr(f"pos div {FAN ** CLIMB}").alias("group"))
                  .agg(F.sort_array(F.collect_list(F.struct("pos", "digest"))).alias("sorted"))
                  .withColumn("up0", F.col("sorted.digest")))
        for step in range(CLIMB):
            groups = groups.withColumn(f"up{step + 1}", _parents(F.col(f"up{step}")))
        groups = materialize(groups.drop("sorted"), "merkle-groups")
        each = F.concat(*[_nodes_of(step) for step in range(CLIMB)])
        made.append(groups.select("tree", "height", F.inline(each)))
        at = groups.where(F.col("level") + CLIMB <= F.col("height")).select(
            "tree", (F.col("level") + CLIMB).alias("level"), F.col("group").alias("pos"), F.col(f"up{CLIMB}")[0].alias("digest"), "height")
        if at.isEmpty():
            return functools.reduce(DataFrame.unionByName, made)


def _parents(digests: Column) -> Column:
    """The hashes of an array's runs."""
    runs = F.sequence(F.lit(0), F.floor((F.size(digests) - 1) / FAN).cast("int"))
    return F.transform(runs, lambda k: _hash_of(_joined(F.slice(digests, k * FAN + 1, FAN))))


def _nodes_of(step: int) -> Column:
    """The nodes that a group has ``step`` levels above its own, with their siblings."""
    digests, level = F.col(f"up{step}"), F.col("level") + step
    first = F.col("group") * (FAN ** (CLIMB - step))

    def node(digest, k):
        start = k - k % FAN
        return F.struct(level.alias("level"), (first + k).alias("pos"), digest.alias("digest"),
                        _joined(F.slice(digests, start + 1, k % FAN)).alias("left"),
                        _joined(F.slice(digests, k + 2, start + FAN - 1 - k)).alias("right"))

    nodes = F.transform(digests, node)
    return F.when(level <= F.col("height"), nodes).otherwise(F.slice(nodes, 1, 0))


def _node(tree, level, pos) -> Column:
    return F.struct(tree.cast("long").alias("tree"), level.cast("int").alias("level"), pos.cast("long").alias("pos"))


def _segments(node: Column, upper: Column, moves: Column, below: Column, payload: Column) -> list[Column]:
    siblings = F.when(moves, F.array(F.struct("left", "right"))).otherwise(F.array().cast(_SIBLINGS))
    return [node.alias("node"), upper.alias("upper"), siblings.alias("proof"), below.alias("below"), payload.alias("payload")]


def proofs(nodes: DataFrame, top: DataFrame, placed: DataFrame, highest: int, summit: int) -> DataFrame:
    """The rows of ``placed`` (``tree``, ``pos``, ``payload``) with ``proof``: the siblings up to the root, level by level.

    ``nodes`` are those of the sources' trees, ``top`` those of the tree over their roots
    (tree -1, its leaf k the root of tree k); ``highest`` is the greatest height of a source,
    ``summit`` the height of the top tree.

    Each round joins the nodes with the ancestors their segments end at, which doubles the
    distance. An ancestor that far up has at least that many levels below it (``below``), so
    the side that is looked up shrinks by FAN to the distance; inner nodes too low to be
    looked up again are left out, leaves never are. A segment that ends at the root has no
    ``upper`` node and is joined no more.
    """
    in_top = lambda level, pos: F.when(level < F.lit(summit), _node(F.lit(-1), level, pos))
    parent = F.floor(F.col("pos") / FAN)
    apex = F.col("level") + 1 >= F.col("height")
    upper = F.when(apex, in_top(F.lit(0), F.col("tree"))).otherwise(_node(F.col("tree"), F.col("level") + 1, parent))
    moves = F.col("level") < F.col("height")  # a lone leaf is the root of its source at once
    at, leaves = _node(F.col("tree"), F.col("level"), F.col("pos")), nodes.where("level = 0")
    own = placed.select(F.col("tree").alias("_t"), F.col("pos").alias("_p"), "payload")
    leaves = leaves.join(own, (F.col("tree") == F.col("_t")) & (F.col("pos") == F.col("_p")))
    nothing = F.lit(None).cast(placed.schema["payload"].dataType)
    inner = nodes.where("level > 0 AND level < height").select(_segments(at, upper, moves, F.col("level"), nothing))
    above = top.where(F.col("level") < F.lit(summit)).select(
        _segments(_node(F.lit(-1), F.col("level"), F.col("pos")), in_top(F.col("level") + 1, parent), F.lit(True), F.col("level") + highest + 1, nothing))
    under_way = materialize(leaves.select(_segments(at, upper, moves, F.lit(0), F.col("payload"))), "merkle-leaf-segments")
    inner = materialize(inner.unionByName(above), "merkle-inner-segments")
    arrived, distance = [], 1
    while True:
        arrived.append(under_way.where("upper IS NULL"))
        under_way = under_way.where("upper IS NOT NULL")
        if under_way.isEmpty():
            return functools.reduce(DataFrame.unionByName, arrived).select("payload", "proof")
        ends = inner.where(F.col("below") >= distance).select(F.col("node").alias("at"), F.col("upper").alias("next"), F.col("proof").alias("more"))
        if ends.count() * (distance * 2 * 32 * (FAN - 1) + 100) <= BROADCAST_BYTES:
            ends = F.broadcast(ends)
        doubled = lambda rows: rows.join(ends, F.col("upper") == F.col("at")).select(
            "node", F.col("next").alias("upper"), F.concat("proof", "more").alias("proof"), "below", "payload")
        under_way = materialize(doubled(under_way), "merkle-leaf-segments")
        needed = inner.where(F.col("below") >= 2 * distance)
        inner = materialize(doubled(needed.where("upper IS NOT NULL")).unionByName(needed.where("upper IS NULL")), "merkle-inner-segments")
        distance *= 2


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf (hex) and its siblings lead to."""
    return F.aggregate(proof, leaf, lambda node, s: F.sha2(F.concat(hexed(s["left"]), node, hexed(s["right"])), 256))


def proof_hash(proof: Column) -> Column:
    """Hash of all siblings, level by level, left to right."""
    return F.sha2(F.aggregate(proof, F.lit(""), lambda text, s: F.concat(text, hexed(s["left"]), hexed(s["right"]))), 256)


def manifest(docs: DataFrame, fields: list[str], key: str = "doc_id", group: str = "source", **kept: Column) -> DataFrame:
    """``key``, ``leaf``, ``subroot``, ``root`` (hex), ``proof`` (siblings by level) of every row, and the ``kept`` columns.

    ``fields`` are what a leaf's hash covers, in that order; ``kept`` are expressions over
    the rows, such as the hash of what a reader has received.

    Groups (NULL is one, the first) are ordered by bytes. Within a group leaves ascend by
    key, NULL keys first; rows of equal keys ascend by their hash, so equal rows are
    interchangeable and every row has a proof of its own. NULL and empty texts are hashed as
    such, however long. An empty table gives no rows. Other columns are not used.

    A group may hold any share of the rows: rows are numbered over range partitions, and
    nodes are dealt by runs of FAN ** CLIMB.
    """
    names = [f"kept{k}" for k in range(len(kept))]
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{group}`").alias("group"), leaf_hash([F.col(f"`{name}`") for name in fields]).alias("leaf"),
                       *[value.alias(name) for name, value in zip(names, kept.values())])
    rows = materialize(rows, "merkle-leaves")  # reads the texts once
    in_order = [F.col("group").asc_nulls_first(), F.col("key").asc_nulls_first(), F.col("leaf").asc()]
    rows = materialize(numbered(rows, in_order, "place"), "merkle-rows")
    groups = rows.groupBy("group").agg(F.min("place").alias("start"), F.count("*").alias("leaves"))
    trees = materialize(numbered(groups, [F.col("start").asc()], "tree"), "merkle-trees")
    of = bounded(trees.select(F.col("group").alias("of"), "start", "leaves", F.col("tree").cast("long").alias("tree")))
    placed = rows.join(of, F.col("group").eqNullSafe(F.col("of"))).select(
        "tree", (F.col("place") - F.col("start")).cast("long").alias("pos"), F.col("leaf").alias("digest"), "leaves",
        F.struct("key", "leaf", "tree", *names).alias("payload"))
    nodes = climb(placed.drop("payload"))
    subroots = materialize(nodes.where("level = height").select("tree", "digest", "height"), "merkle-subroots")
    total = subroots.agg(F.count("*").alias("n"), F.coalesce(F.max("height"), F.lit(0)).alias("highest")).first()
    top = climb(subroots.select(F.lit(-1).cast("long").alias("tree"), F.col("tree").alias("pos"), "digest", F.lit(total.n).alias("leaves")))
    root = top.where("level = height").select("height", hexed(F.col("digest")).alias("root")).first()
    proved = proofs(nodes, top, placed, total.highest, root.height if root else 0).select("payload.*", "proof")
    named = bounded(subroots.select(F.col("tree").alias("of"), hexed(F.col("digest")).alias("subroot")))
    return proved.join(named, F.col("tree") == F.col("of")).select(
        F.col("key").alias(key), hexed(F.col("leaf")).alias("leaf"), "subroot", F.lit(root.root if root else None).cast("string").alias("root"), "proof",
        *[F.col(name).alias(given) for name, given in zip(names, kept)])
