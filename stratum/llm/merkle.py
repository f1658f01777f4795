"""Merkle manifest of a dataset: one binary tree a group, stored in blocks laid out after van Emde Boas.

A leaf is a digest of a row's fields.  Per group (say, per language) the leaves stand in order of their id; while
several nodes remain, every two consecutive ones become one, and a last one alone is hashed alone.  The groups'
subroots, in order of the group, are the leaves of a tree of the same kind, whose root stands for the dataset.

* **Blocks.**  Leaves are numbered without any one task seeing a group: rows are range-partitioned by (group, id) and
  numbered by partition offsets.  Aligned runs of ``2^HEIGHT`` leaves make a subtree, built in one task whatever the
  size of the group; the block roots are the leaves of the next tier, until one block holds all of a group's.
* **Layout.**  A block's nodes are one binary value.  A subtree is cut at half of its height, its top half
  first, then its lower subtrees one after another, each laid out likewise, so that a path from leaf to root touches few
  places whatever the size of a page.  :func:`address` works out a node's place; nothing is searched for.
* **Proofs** go from the upper tiers down: a block's own path to the root, worked out in the tier above, is joined to its
  row, and all siblings inside are taken by address.  Leaves are not shuffled again.

Every tier is written to the shared folder, so a lost executor costs one tier's tasks.  The rows in their order, read twice
and then done with, are kept by Spark on the executors' disks instead: a file a partition would be many small ones, and each
costs an executor a process or two that sets its mode.  The driver gets the root.

Defined results: a NULL field is written ``-``, another one as its byte count, ``:``, and its value; an empty text is thus
another leaf than a NULL one.  NULL ids stand before all others, rows of one id by their leaf; rows that are equal in
all fields are leaves of their own, side by side.  The NULL group stands first, others by their bytes.  A lone leaf is
its group's subroot, a lone subroot the root.  An empty table has no root and no proofs.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.common import small_side, stored

#: Levels of edges in a block: 1,024 leaves, 64 kB of nodes.
HEIGHT = 10
#: Rows of paths, of some hundred bytes each, that are broadcast at most.
PATH_ROWS = 50_000


# ---- layout ------------------------------------------------------------------
def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Places, in a tree of ``levels`` levels, of the nodes ``index`` at ``depth`` (the root has depth 0)."""
    place = np.zeros(len(index), np.int64)
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        levels, depth = levels - top, depth - top
        place += (1 << top) - 1 + (index >> depth) * ((1 << levels) - 1)
        index = index & ((1 << depth) - 1)
    return place


def parent(digests: Sequence[str]) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def height_of(n: int) -> int:
    """Edges between a leaf and the root of a tree of ``n`` leaves."""
    return max(n - 1, 0).bit_length()


def lay_out(leaves: Sequence[str], height: int) -> tuple[np.ndarray, str]:
    """The nodes over aligned ``leaves``, in their places (32 bytes each, zeros where none is), and the top one."""
    nodes = np.zeros(((2 << height) - 1, 32), np.uint8)
    row = list(leaves)
    for depth in range(height, -1, -1):
        places = address(height + 1, depth, np.arange(len(row)))
        nodes[places] = np.frombuffer(bytes.fromhex("".join(row)), np.uint8).reshape(-1, 32)
        if depth:
            row = [parent(row[i:i + 2]) for i in range(0, len(row), 2)]
    return nodes, row[0]


def siblings(nodes: np.ndarray, height: int, n: int) -> Iterator[tuple[int, list[str]]]:
    """For each of the ``n`` leaves of a block, leaf by leaf: its steps up to the block's root.

    A step is ``L`` or ``R``, the side on which the sibling stands, and its digest; or ``-`` for a lone node."""
    levels = []
    for k in range(height):
        at = np.arange(-(-n >> k))
        beside = at ^ 1
        there = beside < len(at)
        digests = nodes[address(height + 1, height - k, np.where(there, beside, 0))]
        text = digests.tobytes().hex()
        levels.append([("L" if i & 1 else "R") + text[64 * i:64 * i + 64] if there[i] else "-" for i in range(len(at))])
    for leaf in range(n):
        yield leaf, [levels[k][leaf >> k] for k in range(height)]


def fold(leaf: str, steps: Sequence[str]) -> str:
    """The root that ``leaf`` and the siblings of ``steps`` lead to."""
    for s in steps:
        leaf = sha256((s[1:] + leaf if s[0] == "L" else leaf + s[1:] if s[0] == "R" else leaf).encode()).hexdigest()
    return leaf


# ---- leaves and their numbers --------------------------------------------------
def written(field: Column) -> Column:
    text = field.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[written(f) for f in fields]), 256)


def leaves(df: DataFrame, fields: Sequence[str], id_col: str = "doc_id", group_col: str = "lang",
           changed: Mapping[str, Column] | None = None, where: Column | None = None) -> DataFrame:
    """(tree, id, leaf, claim): the leaf of every row; ``claim`` is the leaf that the row would have with the columns of
    ``changed`` in place of its own, for rows that ``where`` selects, else NULL."""
    quoted = {f: F.col(f"`{f}`") for f in fields}
    group = F.col(f"`{group_col}`").cast("string")
    claim = F.lit(None).cast("string")
    if changed:
        claim = F.when(F.lit(True) if where is None else where, leaf_digest([changed.get(f, quoted[f]) for f in fields]))
    # the NULL group is the empty name, others begin with a sign
    return df.select(F.coalesce(F.concat(F.lit("+"), group), F.lit("")).alias("tree"), F.col(f"`{id_col}`").alias("id"),
                     leaf_digest(list(quoted.values())).alias("leaf"), claim.alias("claim"))


@contextmanager
def numbered(rows: DataFrame, name: str) -> Iterator[DataFrame]:
    """``rows`` with ``pos``, their place within ``tree`` by (id, leaf) from 0, and ``n``, the rows of the tree; to be used
    inside the ``with`` only."""
    order = [F.col("tree"), F.col("id").asc_nulls_first(), F.col("leaf")]
    dealt = stored(rows.withColumn("tie", F.monotonically_increasing_id()), f"{name}-rows")
    ranged = dealt.repartitionByRange(*order, "tie").sortWithinPartitions(*order, "tie").drop("tie")
    # the order is total and its ranges are drawn once, so a lost partition comes back with the same numbers
    ranked = ranged.withColumn("row", F.monotonically_increasing_id()).persist(StorageLevel.DISK_ONLY)
    part = F.shiftright("row", 33)
    spans = ranked.groupBy("tree", part.alias("part")).agg(F.min("row").alias("first"), F.count("*").alias("rows"))
    by_tree = Window.partitionBy("tree")
    before = F.sum("rows").over(by_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = stored(spans.select("tree", "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"),
                                  F.sum("rows").over(by_tree).alias("n")), f"{name}-offsets")
    try:
        yield (ranked.withColumn("part", part).join(small_side(offsets), ["tree", "part"])
               .select(*rows.columns, (F.col("row") + F.col("shift")).alias("pos"), "n"))
    finally:
        ranked.unpersist()


# ---- blocks ----------------------------------------------------------------------
TIER = ("tree string, block long, n long, size int, height int, root string, nodes binary, "
        "ids array<long>, claims array<string>")


def _block_builder(height: int):
    def build(block: pa.Table) -> pa.Table:
        block = block.take(pa.array(np.argsort(block["pos"].to_numpy(), kind="stable")))
        n = block["n"][0].as_py()
        own = min(height, height_of(n))
        nodes, root = lay_out(block["leaf"].to_pylist(), own)
        row = {"tree": block["tree"][0].as_py(), "block": block["block"][0].as_py(), "n": n, "size": block.num_rows,
               "height": own, "root": root, "nodes": nodes.tobytes(), "ids": block["id"].to_pylist(),
               "claims": block["claim"].to_pylist()}
        return pa.Table.from_pylist([row], schema=pa.schema([
            ("tree", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("size", pa.int32()), ("height", pa.int32()),
            ("root", pa.string()), ("nodes", pa.binary()), ("ids", pa.list_(pa.int64())),
            ("claims", pa.list_(pa.string()))]))
    return build


def forest(rows: DataFrame, height: int, name: str) -> list[DataFrame]:
    """The tiers of blocks over ``rows`` (tree, pos, n, id, leaf, claim), the lowest first."""
    tiers: list[DataFrame] = []
    while True:
        dealt = rows.select("tree", F.shiftright("pos", height).alias("block"), "pos", "n", "id", "leaf", "claim")
        tiers.append(stored(dealt.groupBy("tree", "block").applyInArrow(_block_builder(height), TIER), f"{name}-{len(tiers)}"))
        open_ = tiers[-1].where(F.col("n") > (1 << height))
        if open_.isEmpty():
            return tiers
        rows = open_.select("tree", F.col("block").alias("pos"), (F.shiftright(F.col("n") - 1, height) + 1).alias("n"),
                            F.lit(None).cast("long").alias("id"), F.col("root").alias("leaf"),
                            F.lit(None).cast("string").alias("claim"))


def tops(tiers: Sequence[DataFrame], height: int) -> DataFrame:
    """(tree, root): the tops of all trees of a forest."""
    done = [t.where(F.col("n") <= (1 << height)).select("tree", "root") for t in tiers]
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


@dataclass(frozen=True)
class Manifest:
    """Stored tiers of the groups' trees and of the tree over their subroots (``tree`` there is empty)."""

    groups: list[DataFrame]
    subroots: DataFrame      # tree, leaf (the subroot), pos, n
    top: list[DataFrame]
    root: str | None
    height: int


def manifest(rows: DataFrame, height: int = HEIGHT) -> Manifest:
    """The manifest of rows as :func:`leaves` gives them."""
    with numbered(rows, "merkle-leaves") as leaves_:
        groups = forest(leaves_, height, "merkle-group")
    found = tops(groups, height).withColumnRenamed("root", "leaf")
    # one tree over the groups; the order is the group's name, so it stands in the place of the id
    with numbered(found.select(F.lit("").alias("tree"), F.col("tree").alias("id"), "leaf"), "merkle-subroots") as placed:
        ranked = stored(placed, "merkle-subroot-order")
    top = forest(ranked.select("tree", "pos", "n", F.lit(None).cast("long").alias("id"), "leaf",
                               F.lit(None).cast("string").alias("claim")), height, "merkle-top")
    root = tops(top, height).first()
    return Manifest(groups, ranked.select(F.col("id").alias("tree"), "leaf", "pos", "n"), top,
                    root["root"] if root else None, height)


# ---- paths -----------------------------------------------------------------------
PATHS = "tree string, block long, steps array<string>, subroot string"
PROOFS = ("id long, tree string, leaf string, subroot string, steps array<string>, proof_sha256 string, "
          "folded_root string")


def _leaves_of(nodes: bytes, height: int, size: int) -> tuple[np.ndarray, list[str]]:
    laid = np.frombuffer(nodes, np.uint8).reshape(-1, 32)
    text = laid[address(height + 1, height, np.arange(size))].tobytes().hex()
    return laid, [text[64 * i:64 * i + 64] for i in range(size)]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _path_reader(height: int):
    """Blocks with their path upwards -> the same for each block of the tier below."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _rows(batches):
            laid, _ = _leaves_of(b["nodes"], b["height"], b["size"])
            below = [{"tree": b["tree"], "block": (b["block"] << height) + i, "steps": inside + b["steps"],
                      "subroot": b["subroot"]} for i, inside in siblings(laid, b["height"], b["size"])]
            yield pa.RecordBatch.from_pylist(below, schema=pa.schema([
                ("tree", pa.string()), ("block", pa.int64()), ("steps", pa.list_(pa.string())), ("subroot", pa.string())]))
    return read


def _proof_reader(with_steps: bool):
    """Lowest blocks with their path upwards -> a proof for every leaf, and the root it leads to."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _rows(batches):
            laid, own = _leaves_of(b["nodes"], b["height"], b["size"])
            out = []
            for i, inside in siblings(laid, b["height"], b["size"]):
                steps = inside + b["steps"]
                out.append({"id": b["ids"][i], "tree": b["tree"], "leaf": own[i], "subroot": b["subroot"],
                            "steps": steps if with_steps else None,
                            "proof_sha256": sha256("".join(s[1:] for s in steps).encode()).hexdigest(),
                            "folded_root": fold(b["claims"][i] or own[i], steps)})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                ("id", pa.int64()), ("tree", pa.string()), ("leaf", pa.string()), ("subroot", pa.string()),
                ("steps", pa.list_(pa.string())), ("proof_sha256", pa.string()), ("folded_root", pa.string())]))
    return read


def _with_paths(tier: DataFrame, paths: DataFrame) -> DataFrame:
    return tier.join(small_side(paths, PATH_ROWS), ["tree", "block"])


def _descend(tiers: Sequence[DataFrame], ends: DataFrame, height: int, name: str) -> DataFrame:
    """Paths of the lowest tier's blocks: ``ends`` are those of whole trees (block 0 of the tier that holds all of one)."""
    paths = ends
    for i in range(len(tiers) - 1, 0, -1):
        below = _with_paths(tiers[i], paths).mapInArrow(_path_reader(height), PATHS)
        # trees that end further down are not in this tier: their path is still that of the whole tree
        short = ends.join(tiers[i].select("tree").distinct(), "tree", "left_anti")
        paths = stored(below.unionByName(short), f"{name}-paths-{i}")
    return paths


def proofs(m: Manifest, with_steps: bool = True) -> DataFrame:
    """(id, tree, leaf, subroot, steps, proof_sha256, folded_root) of every leaf.

    ``steps`` are the siblings from the leaf to the root (NULL without ``with_steps``), ``proof_sha256`` is the digest of their
    digests laid end to end, ``folded_root`` what they and the leaf, or its claim, lead to.
    """
    over = m.top[0].select("tree", F.lit(0).cast("long").alias("block"), F.array().cast("array<string>").alias("steps"),
                           F.lit("").alias("subroot")).limit(1)  # the one tree over the subroots
    above = _with_paths(m.top[0], _descend(m.top, over, m.height, "merkle-top")).mapInArrow(_path_reader(m.height), PATHS)
    ends = stored(above.select(F.col("block").alias("pos"), "steps").join(m.subroots, "pos").select(
        "tree", F.lit(0).cast("long").alias("block"), "steps", F.col("leaf").alias("subroot")), "merkle-ends")
    return _with_paths(m.groups[0], _descend(m.groups, ends, m.height, "merkle-group")).mapInArrow(
        _proof_reader(with_steps), PROOFS)
