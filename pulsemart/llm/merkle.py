"""A Merkle manifest of a table, with a persistent version of the tree for every
tampered row.

Each row is a leaf, the hash of its fields.  Per source the leaves, in order of
their ids, form a tree of ``FAN`` children a node; the sources' roots, in order of
the sources, form another one, whose root names the whole table.

Positions come from a range partitioning: a row's place is its place in its
partition plus the rows of the source in the partitions before.  The tree is
built upwards in aligned blocks of ``FAN ** BLOCK_LEVELS`` nodes, a block to a
group: no group is larger, however many rows a source has, and the blocks' tops
are the nodes of the next, distributed, step.

A tampered leaf makes a version of the tree.  Versions are persistent: nothing is
changed or copied but the leaf's ancestors, and every other node is the original's.
Inside a block the ancestors are copied by its task; above it the version goes on
along the path of the block's top, whose untouched siblings were handed down
from the upper steps once for the whole block.  ``versions`` returns the copied nodes.

Defined cases: a null field is ``-``; a null source is a source of its own, the
first; null ids come before others; rows that repeat an id are in order of
their hashes, and equal rows follow each other in any order; an empty table gives
an empty table; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemart.llm.common import lower_az
from pulsemart.llm.places import placed
from pulsemart.llm.scratch import Scratch

FAN = 16
BLOCK_LEVELS = 2                   # levels of a block: 256 nodes
BLOCK = FAN ** BLOCK_LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")      # fixed order of a leaf's fields
TAMPERED_EVERY = 5

_PATH = "array<struct<left: string, right: string>>"


def node_hash(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def field_code(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    return F.sha2(F.encode(F.concat(*[field_code(v) for v in values]), "UTF-8"), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """``id``, ``grp`` (the source, in an order with null first), ``leaf`` and, for
    the rows that are tampered with, the ``tampered`` leaf."""
    *others, text = [F.col(c) for c in FIELDS]
    named = F.pmod(F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8")), F.lit(TAMPERED_EVERY)) == 0
    named = named & F.col("doc_id").isNotNull()
    return docs.select(
        F.col("doc_id").alias("id"), F.coalesce(F.concat(F.lit("="), "source"), F.lit("-")).alias("grp"),
        leaf_hash(*others, text).alias("leaf"),
        F.when(named, leaf_hash(*others, lower_az(text))).alias("tampered"),
    )


@dataclass
class Block:
    """The nodes of an aligned block, level by level, and what they know of the
    tree above."""

    levels: list[list[str]]

    @classmethod
    def build(cls, nodes: list[str], size: int) -> Block:
        """``nodes`` of one block of a level with ``size`` nodes: levels up to the
        block's top, or to the tree's."""
        levels = [nodes]
        for _ in range(BLOCK_LEVELS):
            if size == 1:
                break
            last = levels[-1]
            levels.append([node_hash("".join(last[i:i + FAN])) for i in range(0, len(last), FAN)])
            size = -(-size // FAN)
        return cls(levels)

    def siblings(self, at: int) -> list[tuple[str, str]]:
        """Per level the run's nodes left and right of the path from node ``at``."""
        out = []
        for level in self.levels[:-1]:
            run = at // FAN * FAN
            out.append(("".join(level[run:at]), "".join(level[at + 1:run + FAN])))
            at //= FAN
        return out


def copied_path(node: str, siblings: list[tuple[str, str]]) -> list[str]:
    """The ancestors of a changed node: the only nodes a version doesn't share."""
    out = []
    for left, right in siblings:
        node = node_hash(left + node + right)
        out.append(node)
    return out


def _ordered(group: pa.Table) -> tuple[pa.Table, int, int]:
    group = group.sort_by("pos")
    return group, group.column("pos")[0].as_py(), group.column("n")[0].as_py()


def _top(group: pa.Table) -> pa.Table:
    """A block's top as a node of the next step."""
    group, first, size = _ordered(group)
    block = Block.build(group.column("node").to_pylist(), size)
    return pa.table({
        "grp": pa.array([group.column("grp")[0].as_py()], pa.string()),
        "pos": pa.array([first // BLOCK], pa.int64()), "n": pa.array([-(-size // BLOCK)], pa.int64()),
        "node": pa.array([block.levels[-1][0]], pa.string()),
    })


def _pairs(path) -> list[tuple[str, str]]:
    return [(x["left"], x["right"]) for x in path]


def _handed_down(group: pa.Table, above: pa.Table) -> pa.Table:
    """Each node's path to the tree's top: inside its block, then the block's own."""
    group, first, size = _ordered(group)
    block = Block.build(group.column("node").to_pylist(), size)
    rest = _pairs(above.column("path")[0].as_py()) if above.num_rows else []
    paths = [[{"left": a, "right": b} for a, b in block.siblings(i) + rest] for i in range(group.num_rows)]
    kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
    return pa.table({"grp": group.column("grp"), "pos": group.column("pos"), "path": pa.array(paths, kind)})


def _climb(nodes: DataFrame, scratch: Scratch, name: str) -> list[DataFrame]:
    """The steps of a tree: its nodes, then block tops, until each group has one."""
    steps = [nodes]
    while (steps[-1].agg(F.max("n")).first()[0] or 0) > 1:
        # a group that is down to one node stays out of the next step: its top is known
        open_ = steps[-1].filter("n > 1").withColumn("block", F.floor(F.col("pos") / BLOCK))
        tops = open_.groupBy("grp", "block").applyInArrow(_top, "grp string, pos long, n long, node string")
        steps.append(scratch.store(tops, f"{name}_up{len(steps)}"))
    return steps


def _paths(steps: list[DataFrame], scratch: Scratch, name: str, lowest: int) -> DataFrame | None:
    """Paths of the nodes of step ``lowest``, handed down from the top step."""
    paths = None
    for k in range(len(steps) - 1, lowest - 1, -1):
        nodes = steps[k].withColumn("block", F.floor(F.col("pos") / BLOCK))
        above = paths if paths is not None else nodes.limit(0).selectExpr("grp", "pos", f"cast(array() as {_PATH}) AS path")
        down = nodes.groupBy("grp", "block").cogroup(above.groupBy("grp", "pos")).applyInArrow(
            _handed_down, f"grp string, pos long, path {_PATH}")
        paths = scratch.store(down, f"{name}_down{k}")
    return paths


def _leaf_rows(group: pa.Table, above: pa.Table) -> pa.Table:
    """The leaves of a block: their proofs, and a version for each tampered one."""
    group, first, size = _ordered(group)
    nodes = group.column("node").to_pylist()
    block = Block.build(nodes, size)
    meta = above.to_pylist()[0]
    rest = _pairs(meta["path"])
    tail = "".join(a + b for a, b in rest)
    tampered = group.column("tampered").to_pylist()
    proofs, folded, copies = [], [], []
    for i, changed in enumerate(tampered):
        inside = block.siblings(i)
        proofs.append(node_hash("".join(a + b for a, b in inside) + tail))
        path = copied_path(nodes[i] if changed is None else changed, inside + rest)
        folded.append(path[-1] if path else changed or nodes[i])
        copies.append([] if changed is None else path)
    n = group.num_rows
    return pa.table({
        "doc_id": group.column("id"), "source": pa.array([meta["grp"][1:] if meta["grp"][0] == "=" else None] * n, pa.string()),
        "pos": group.column("pos"), "leaf": group.column("node"),
        "subroot": pa.array([meta["subroot"]] * n, pa.string()), "root": pa.array([meta["root"]] * n, pa.string()),
        "proof_sha256": pa.array(proofs, pa.string()), "folded_root": pa.array(folded, pa.string()),
        "tampered_leaf": group.column("tampered"), "copied": pa.array(copies, pa.list_(pa.string())),
    })


def merkle_manifest(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` with its place ``pos`` in its source, ``leaf``,
    ``subroot``, ``root``, ``proof_sha256``, ``folded_root`` (the root recomputed from
    the leaf as it was found), ``verified``, and its version of the tree:
    ``tampered_leaf`` (null where nothing was changed) and ``copied``, the version's
    own nodes from the leaf's parent to the root."""
    scratch = Scratch(docs.sparkSession, "merkle")
    rows = placed(leaves(docs), scratch, "leaf", "id", "leaf")
    rows = scratch.store(rows.withColumnRenamed("leaf", "node"), "leaves")
    scratch.drop("leaf_ranged")
    steps = _climb(rows.select("grp", "pos", "n", "node"), scratch, "leaf")
    # each group's top is in the step where its size is down to one
    tops = steps[0].filter("n = 1")
    for step in steps[1:]:
        tops = tops.unionByName(step.filter("n = 1"))
    tops = scratch.store(tops.select("grp", F.col("node").alias("subroot")), "tops")
    sources = placed(tops.select(F.lit("").alias("grp"), F.col("grp").alias("source"), F.col("subroot").alias("node")),
                     scratch, "source", "source")
    sources = scratch.store(sources, "sources")
    upper = _climb(sources.select("grp", "pos", "n", "node"), scratch, "source")
    found = upper[-1].agg(F.max("node")).first()[0]
    above = _paths(upper, scratch, "source", 0)
    above = sources.select("pos", F.col("source").alias("grp"), F.col("node").alias("subroot")).join(above.drop("grp"), "pos")
    heads = scratch.store(above.select("grp", "subroot", "path"), "heads")
    inner = _paths(steps, scratch, "leaf", 1) if len(steps) > 1 else None
    blocks = rows.select("grp", F.floor(F.col("pos") / BLOCK).alias("block")).distinct()
    if inner is not None:
        blocks = blocks.join(inner.withColumnRenamed("pos", "block").withColumnRenamed("path", "inside"), ["grp", "block"], "left")
    else:
        blocks = blocks.withColumn("inside", F.lit(None).cast(_PATH))
    blocks = blocks.join(heads, "grp").select(
        "grp", "block", "subroot", F.lit(found).cast("string").alias("root"),
        F.concat(F.coalesce("inside", F.expr(f"cast(array() as {_PATH})")), "path").alias("path"),
    )
    blocks = scratch.store(blocks, "blocks")
    id_type = dict(rows.dtypes)["id"]
    out = rows.withColumn("block", F.floor(F.col("pos") / BLOCK)).groupBy("grp", "block").cogroup(
        blocks.groupBy("grp", "block")
    ).applyInArrow(
        _leaf_rows,
        f"doc_id {id_type}, source string, pos long, leaf string, subroot string, root string, proof_sha256 string, "
        "folded_root string, tampered_leaf string, copied array<string>",
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def versions(manifest: DataFrame) -> DataFrame:
    """The nodes that each version owns: (source, version, level, node), level 1 the
    leaf's parent.  All others are the untampered tree's."""
    return manifest.filter(F.col("tampered_leaf").isNotNull()).select(
        "source", F.col("pos").alias("version"), F.posexplode("copied").alias("nth", "node")
    ).select("source", "version", (F.col("nth") + 1).alias("level"), "node")
