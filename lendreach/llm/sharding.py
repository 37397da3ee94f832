"""Hierarchical weighted hash tree: regions hold racks, racks hold shards, and every level is one weighted draw."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendreach.llm.common import numbered

#: {region: {rack: {shard: weight}}}
Tree = dict[str, dict[str, dict[int, float]]]


def layout(shards: int, per_rack: int = 4, racks: int = 2) -> Tree:
    """Shards 0.. of weight 1 in racks of ``per_rack`` and regions of ``racks``."""
    tree: Tree = {}
    for s in range(shards):
        region = f"g{s // (per_rack * racks)}"
        tree.setdefault(region, {}).setdefault(f"{region}/k{s // per_rack}", {})[s] = 1.0
    return tree


def grow(tree: Tree, shard: int, weight: float = 1.0) -> Tree:
    """The tree with ``shard`` in a region of its own, so that rows move to the new shard and nowhere else."""
    return {**tree, f"n{shard}": {f"n{shard}/k": {shard: weight}}}


def _cost(key: Column, node: str, weight: float) -> Column:
    """Exponential draw of a node for a key: least with a chance in proportion to the weight."""
    hexed = F.substring(F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(f"|{node}"))
                              .cast("binary")), 1, 13)
    share = (F.conv(hexed, 16, 10).cast("long").cast("double") + 0.5) / float(2**52)
    return -F.ln(share) / float(weight)


def _draw(key: Column, nodes: dict[str, float]) -> Column:
    """The name of the node with the least draw; ties go to the first."""
    live = [(n, w) for n, w in nodes.items() if w > 0]
    if len(live) == 1:
        return F.lit(live[0][0])
    return F.array_min(F.array(*[F.struct(_cost(key, n, w).alias("cost"), F.lit(i).alias("i"), F.lit(n).alias("node"))
                                 for i, (n, w) in enumerate(live)]))["node"]


def _by_parent(parent: Column, draws: dict[str, Column]) -> Column:
    out = None
    for name, draw in draws.items():
        out = F.when(parent == name, draw) if out is None else out.when(parent == name, draw)
    return out


def place(df: DataFrame, key: str, tree: Tree, region: str = "region", rack: str = "rack",
          shard: str = "shard") -> DataFrame:
    """Add region, rack and shard of every row's key: descend the tree, drawing among the children at each level.

    A node's weight is the sum of its shards'. A row leaves a subtree only if a weight inside it or beside
    it on the row's path has changed; other subtrees keep all their rows. Nodes of weight 0 get none.
    """
    racks = {g: {k: sum(s.values()) for k, s in ks.items()} for g, ks in tree.items()}
    regions = {g: sum(ks.values()) for g, ks in racks.items()}
    if sum(regions.values()) <= 0:
        raise ValueError("no shard has a weight over 0")
    leaves = {k: {f"{k}/{s}": w for s, w in shards.items()} for g in tree for k, shards in tree[g].items()}
    col = F.col(key)
    df = df.withColumn(region, _draw(col, regions))
    df = df.withColumn(rack, _by_parent(F.col(region), {g: _draw(col, racks[g]) for g in racks if regions[g] > 0}))
    df = df.withColumn(shard, _by_parent(F.col(rack), {
        k: _draw(col, leaves[k]) for g in racks for k, w in racks[g].items() if w > 0}))
    return df.withColumn(shard, F.element_at(F.split(shard, "/"), -1).cast("int"))


def shard_rows(df: DataFrame, key: str, tree: Tree, grown: Tree | None = None,
               text: str | None = None) -> DataFrame:
    """Every row with region, rack, shard and a slot (gapless from 0) in its shard.

    ``grown`` adds ``grown_shard``, the place under another tree; ``text`` adds ``size`` (UTF-8 bytes
    plus 1) and ``text_crc32`` (of the UTF-8 bytes), with null as the empty text. Rows with a null or a
    repeated key all go where that key goes. Only built-in functions are used.
    """
    cols: dict[str, Column] = {}
    if text:
        raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
        cols = {"size": F.octet_length(raw).cast("long") + 1, "text_crc32": F.crc32(raw)}
    rows = place(df.withColumns(cols).drop(text) if text else df, key, tree)
    if grown is not None:
        rows = place(rows, key, grown, "__region", "__rack", "grown_shard").drop("__region", "__rack")
    return numbered(rows, F.col("shard"), F.col(key), "slot")
