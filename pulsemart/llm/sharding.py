"""Shards of near-equal bytes by histogram sort.

The sort key of a document is (hash of its text, hash of its id, id), so equal
texts are neighbours and may still be cut apart.  Instead of sorting to find
quantiles, exact bytes and rows are counted in cells of the key space.  Cells
that hold a splitter and are wider than the tolerance are probed again at 256
times the resolution, and so are cells with many rows, until every splitter is
within tolerance or at a single document.  The cells then give each
row its shard and its slot's base, and one exchange by cell numbers the rows.

What reaches the driver is bounded by the probes (4096 cells, then 256 for
each refined cell, of which there are at most a few hundred), never by rows.

Defined cases: a null text has no bytes; null ids sort first; equal rows get
different slots; an empty table gives an empty table; input columns
named like the output's are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from pulsemart.llm.common import stored

OVERHEAD_BYTES = 8
TOLERANCE = 0.001                  # of a shard's bytes
CROWDED = 4                        # refine cells with so many times the mean rows of a first-level cell
CROWDED_LEAST = 64
TEXT_SHIFTS = (52, 44, 36, 28, 20, 12, 4, 0)
ID_SHIFTS = (56, 48, 40, 32, 24, 16, 8, 0)
LEAF = T.StructType([
    T.StructField("__cell", T.StringType()), T.StructField("shard", T.IntegerType()),
    T.StructField("__base", T.LongType()),
])


@dataclass
class Probes:
    """The cells that have been refined, by resolution."""

    by_text: dict[int, list[int]] = field(default_factory=dict)      # shift -> prefixes of the text hash
    to_ids: dict[int, list[int]] = field(default_factory=dict)       # cells of a single text: go on with ids
    by_id: dict[int, list[str]] = field(default_factory=dict)        # shift -> "text hash:prefix of the id hash"

    def cell(self, h: Column, u: Column) -> Column:
        """The unrefined cell that a key lies in, as a string."""
        ids = F.concat(F.lit("u0/"), F.concat_ws(":", h, u))
        for s in reversed(ID_SHIFTS):
            here = F.concat_ws(":", h, F.shiftright(u, s))
            own = F.concat(F.lit(f"u{s}/"), here)
            ids = F.when(here.isin(self.by_id[s]), ids).otherwise(own) if self.by_id.get(s) else own
        out = ids
        for s in reversed(TEXT_SHIFTS):
            here = F.shiftright(h, s)
            own = F.concat(F.lit(f"h{s}/"), here)
            step = F.when(F.lit(False), own)
            if self.by_text.get(s):
                step = step.when(here.isin(self.by_text[s]), out)
            if self.to_ids.get(s):
                step = step.when(here.isin(self.to_ids[s]), ids)
            out = step.otherwise(own)
        return out


def _order(cell: str, min_h: int) -> tuple[int, int]:
    """Cells in key order: by their texts, then by their ids."""
    kind, _, rest = cell.partition("/")
    return (min_h, int(rest.partition(":")[2]) << int(kind[1:])) if kind[0] == "u" else (min_h, 0)


def _wide(leaves: list[dict], n_shards: int, tolerance: float, crowd: float) -> list[dict]:
    """Leaves to refine: with a splitter inside and over the tolerance, or crowded."""
    total = sum(x["bytes"] for x in leaves)
    at, j, out = 0, 1, []
    for x in leaves:
        end = at + x["bytes"]
        while j < n_shards and total * j <= at * n_shards:
            j += 1
        inside = j < n_shards and at * n_shards < total * j < end * n_shards
        if x["rows"] > 1 and (inside and x["bytes"] > tolerance * total / n_shards or x["rows"] > crowd):
            out.append(x)
        at = end
    return out


def find_cells(keys: DataFrame, n_shards: int, tolerance: float = TOLERANCE) -> tuple[Probes, list[dict]]:
    """Probe ``keys`` (``__h``, ``__u``, ``__size``) until the splitters meet the
    tolerance.  Returns the probes and the leaves in key order."""
    probes = Probes()
    while True:
        cell = probes.cell(F.col("__h"), F.col("__u"))
        found = keys.groupBy(cell.alias("cell")).agg(
            F.sum("__size").alias("bytes"), F.count(F.lit(1)).alias("rows"),
            F.min("__h").alias("min_h"), F.max("__h").alias("max_h"),
        )
        leaves = sorted((r.asDict() for r in found.collect()), key=lambda x: _order(x["cell"], x["min_h"]))
        if not leaves:
            return probes, leaves
        crowd = max(CROWDED_LEAST, CROWDED * sum(x["rows"] for x in leaves) / 4096)
        changed = False
        for x in _wide(leaves, n_shards, tolerance, crowd):
            kind, _, rest = x["cell"].partition("/")
            shift = int(kind[1:])
            if kind[0] == "u":
                if shift:
                    probes.by_id.setdefault(shift, []).append(rest)
                    changed = True
            else:
                single = x["min_h"] == x["max_h"]
                (probes.to_ids if single else probes.by_text).setdefault(shift, []).append(int(rest))
                changed = True
        if not changed:
            return probes, leaves


def _placed(leaves: list[dict], n_shards: int) -> list[tuple[str, int, int]]:
    """Each leaf's shard (cuts at the leaf ends nearest to the ideal ones) and slot base."""
    total, at, shard, base, out = sum(x["bytes"] for x in leaves), 0, 0, 0, []
    for x in leaves:
        middle = 2 * at + x["bytes"]                     # a cut before x is nearer if the ideal one is before x's middle
        while shard < n_shards - 1 and 2 * total * (shard + 1) < middle * n_shards:
            shard, base = shard + 1, 0
        out.append((x["cell"], shard, base))
        base += x["rows"]
        at += x["bytes"]
    return out


def shard_by_bytes(
    docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text", tolerance: float = TOLERANCE,
) -> DataFrame:
    """``docs`` with ``size`` (UTF-8 bytes of the text plus 8), ``shard`` and
    ``slot`` (gapless from 0 in each shard, in key order)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.withColumns({
        "__h": F.xxhash64(text), "__u": F.xxhash64(F.col(id_col)),
        "__size": F.octet_length(text).cast("long") + OVERHEAD_BYTES,
    })
    keys = stored(keyed.select("__h", "__u", "__size"), "shard_keys")
    probes, leaves = find_cells(keys, n_shards, tolerance)
    cells = docs.sparkSession.createDataFrame(_placed(leaves, n_shards), LEAF)
    outputs = [c for c in docs.columns if c not in ("size", "shard", "slot")]
    placed = keyed.withColumn("__cell", probes.cell(F.col("__h"), F.col("__u"))).drop("shard").join(
        F.broadcast(cells), "__cell"                       # bounded by the probes, see above
    )
    in_order = Window.partitionBy("__cell").orderBy("__h", "__u", F.col(id_col).asc_nulls_first(), "__size")
    return placed.withColumn("__n", F.row_number().over(in_order)).select(
        *outputs, F.col("__size").alias("size"), "shard", (F.col("__base") + F.col("__n") - 1).alias("slot")
    )
