"""A Merkle manifest of a table, and proofs for all its rows by octopus multiproofs.

Every row is a leaf, the SHA-256 of its length-prefixed columns. The leaves of a source,
ascending by doc_id, are the bottom of a ternary tree; its root is the source's subroot,
and the subroots, ordered by source, are the bottom of one more tree. A node is the
SHA-256 of its children's hexadecimal digests.

The table's order (source, doc_id) is cut into *leaf partitions* of ``per_part`` rows. As
no source gets a task of its own, a source that holds a third of all rows is many
partitions, and thousands of small ones share one. Trees are folded from below, LEVELS
levels at a time: aligned blocks of 3^LEVELS neighbours give all nodes above them, the
blocks' top nodes are the next round's bottom. The nodes (tree, level, idx, digest) are the
manifest; they are stored.

A leaf partition then works out, from the positions it holds alone, the smallest set of
nodes that it can't derive itself: on each level the other children of the parents it
knows. These coordinates of all partitions meet the stored nodes in one join. With what it
fetched, a partition derives the interior nodes that its leaves share, once, and expands
each leaf's own proof from them; the proof is checked by folding up the leaf as it is
presented. Texts stay in the scan that hashes them.

Bounds: a task holds one leaf partition, or one block, and what it fetched: at most two
nodes per level and side of each run of positions.

Edge cases: null columns count as ``-``, apart from an empty text. A null source is a source
of its own, the first; null doc_ids come first in their source, and rows of one doc_id go by
their leaf. Repeated rows are leaves of their own. An empty table gives no rows and no
nodes. Columns besides the five that are hashed are not read.
"""

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwell.llm.common import stored
from tickwell.plans.slices import ranked

ARITY = 3
#: Levels that one round folds: a block has ARITY ** LEVELS nodes.
LEVELS = 9
PER_PART = 16384
#: The tree over the subroots; the sources' trees are numbered from 0 in the order of the sources.
TOP = -1

NODES = "tree long, n long, level int, idx long, digest binary, is_root boolean"
COORDINATES = "part long, tree long, level int, idx long"
PROOFS = "doc_id long, leaf string, subroot string, root string, siblings array<struct<left: string, right: string>>, presented string, folded_root string, verified boolean"


class Manifest(NamedTuple):
    """``leaves``: part, tree, n, pos, doc_id, leaf, presented. ``runs``: the positions (tree, first, last) of each
    part. ``nodes``: all nodes of all trees. ``sources``: number of sources."""

    leaves: DataFrame
    runs: DataFrame
    nodes: DataFrame
    sources: int


def _told(column: Column) -> Column:
    text = column.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(text: Column) -> Column:
    """SHA-256 of a row with ``text`` as its text."""
    parts = [_told(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")]
    return F.unhex(F.sha2(F.concat(*parts, _told(text)).cast("binary"), 256))


def _node(children: Iterable[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def _above(size: int) -> int:
    """Nodes on the level above ``size`` nodes."""
    return -(-size // ARITY)


def height(size: int) -> int:
    """Levels above the leaves."""
    levels = 0
    while size > 1:
        size, levels = _above(size), levels + 1
    return levels


def _placed(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with their place from 0 on in the order of the whole table."""
    whole = rows.withColumn("all", F.lit(0))
    return ranked(whole, ["all"], order, "at").select(*rows.columns, (F.col("at") - 1).alias(name))


def _folded(levels: int, base: int):
    """Per task: the nodes of up to ``levels`` levels above sorted blocks of nodes on level ``base``."""
    import pyarrow as pa

    width = ARITY**levels

    def block(tree: int, n: int, low: int, nodes: list[str]) -> dict:
        size = n
        for _ in range(base):
            size = _above(size)
        out = {name: [] for name in ("tree", "n", "level", "idx", "digest", "is_root")}
        for level in range(base + 1, base + levels + 1):
            if size == 1:
                break
            size, low = _above(size), low // ARITY
            nodes = [_node(nodes[i : i + ARITY]) for i in range(0, len(nodes), ARITY)]
            for name, values in zip(out, ([tree] * len(nodes), [n] * len(nodes), [level] * len(nodes), range(low, low + len(nodes)), map(bytes.fromhex, nodes), [size == 1] * len(nodes)), strict=True):
                out[name].extend(values)
        return out

    def arrow(columns: dict) -> pa.RecordBatch:
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns.values(), types, strict=True)], names=list(columns))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, nodes = None, []
        for batch in batches:
            trees, sizes, places, digests = (c.to_pylist() for c in batch.columns)
            for tree, n, idx, digest in zip(trees, sizes, places, digests, strict=True):
                if open_ is None or open_[0] != tree or open_[2] // width != idx // width:
                    if open_ is not None:
                        yield arrow(block(*open_, nodes))
                    open_, nodes = (tree, n, idx), []
                nodes.append(digest.hex())
        if open_ is not None:
            yield arrow(block(*open_, nodes))

    return fold


def tree_nodes(bottom: DataFrame, most: int, levels: int = LEVELS) -> DataFrame:
    """All nodes of trees with at most ``most`` leaves, given as (tree, n, idx, digest)."""
    found = bottom.select("tree", "n", F.lit(0).alias("level"), "idx", "digest", (F.col("n") == 1).alias("is_root"))
    rest = found
    for base in range(0, height(most), levels):
        block = F.floor(F.col("idx") / F.lit(ARITY**levels))
        dealt = rest.where("NOT is_root").select("tree", "n", "idx", "digest").repartition("tree", block).sortWithinPartitions("tree", "idx")
        above = stored(dealt.mapInArrow(_folded(levels, base), NODES), "nodes")
        found = found.unionByName(above)
        rest = above.where(F.col("level") == base + levels)
    return found


def manifest(docs: DataFrame, presented: Column | None = None, per_part: int = PER_PART, levels: int = LEVELS) -> Manifest:
    """The manifest of ``docs`` by its own texts; ``presented`` are the texts to be proved against it, by default the same."""
    leaf = leaf_digest(F.col("text"))
    other = F.lit(None).cast("binary") if presented is None else leaf_digest(presented)
    # No source comes first: its key is the empty one.
    key = F.coalesce(F.concat(F.lit("1"), F.col("source").cast("string")), F.lit(""))
    rows = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("key"), leaf.alias("leaf"), other.alias("other"), F.monotonically_increasing_id().alias("row")), "leaves")
    placed = _placed(rows, ["key", "doc_id", "leaf", "row"], "g")
    placed = stored(placed.select("doc_id", "key", "leaf", F.nullif("other", "leaf").alias("presented"), "g", F.floor(F.col("g") / F.lit(per_part)).alias("part")), "placed")

    spans = stored(placed.groupBy("part", "key").agg(F.min("g").alias("low"), F.max("g").alias("high")), "spans")
    trees = spans.groupBy("key").agg(F.min("low").alias("start"), (F.max("high") - F.min("low") + 1).alias("n"))
    trees = stored(_placed(trees, ["key"], "tree"), "trees")
    held = trees.agg(F.count("*").alias("sources"), F.coalesce(F.max("n"), F.lit(0)).alias("most")).first()
    runs = stored(spans.join(trees, "key").select("part", "key", "tree", "n", "start", (F.col("low") - F.col("start")).alias("first"), (F.col("high") - F.col("start")).alias("last")), "runs")
    # The pairs of part and key are no hot keys: a part has few rows.
    leaves = placed.join(runs.select("part", "key", "tree", "n", "start"), ["part", "key"])
    leaves = stored(leaves.select("part", "tree", "n", (F.col("g") - F.col("start")).alias("pos"), "doc_id", "leaf", "presented"), "leaves")

    below = tree_nodes(leaves.select("tree", "n", F.col("pos").alias("idx"), F.col("leaf").alias("digest")), held.most, levels)
    subroots = below.where("is_root").select(F.lit(TOP).cast("long").alias("tree"), F.lit(held.sources).alias("n"), F.col("tree").alias("idx"), "digest")
    nodes = below.unionByName(tree_nodes(subroots, held.sources, levels))
    return Manifest(leaves, runs.select("part", "tree", "n", "first", "last"), nodes.select("tree", "level", "idx", "digest"), held.sources)


def missing(known: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(level, positions) of the fewest nodes that, with the ``known`` leaves, give the root of ``size`` leaves and a proof of each."""
    level, known = 0, np.unique(known)
    while size > 1:
        parents = np.unique(known // ARITY)
        children = (parents[:, None] * ARITY + np.arange(ARITY)).ravel()
        yield level, np.setdiff1d(children[children < size], known, assume_unique=True)
        known, size, level = parents, _above(size), level + 1


def coordinates(runs: DataFrame, sources: int) -> DataFrame:
    """(part, tree, level, idx): what each leaf partition must fetch, no node twice."""

    def wanted(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (tree, n), rows in group.groupby(["tree", "n"]):
            known = np.concatenate([np.arange(a, b + 1) for a, b in zip(rows["first"], rows["last"], strict=True)])
            out += [(tree, level, i) for level, places in missing(known, n) for i in places]
        out += [(TOP, level, i) for level, places in missing(group.tree.to_numpy(), sources) for i in places]
        found = pd.DataFrame(out, columns=["tree", "level", "idx"]).astype("int64")
        found.insert(0, "part", group.part.iloc[0])
        return found

    return runs.groupBy("part").applyInPandas(wanted, COORDINATES)


class _Tree:
    """What a partition knows of a tree: its own leaves, what it fetched, and what follows from both."""

    def __init__(self, leaves: dict[int, str], size: int, fetched: dict[int, dict[int, str]]):
        self.levels, self.sizes = [leaves], [size]
        while self.sizes[-1] > 1:
            level, size = len(self.levels) - 1, self.sizes[-1]
            nodes = self.levels[level] | fetched.get(level, {})
            parents = {p: [nodes[i] for i in range(p * ARITY, min(p * ARITY + ARITY, size))] for p in {i // ARITY for i in self.levels[level]}}
            self.levels[level] = nodes
            self.levels.append({p: _node(children) for p, children in parents.items()})
            self.sizes.append(_above(size))
        self.root = next(iter(self.levels[-1].values()))

    def paths(self, above: tuple = ()) -> dict[int, tuple]:
        """Per leaf the siblings (left, right) of each level, ``above`` following; shared parents are walked once."""
        paths = {0: above}
        for nodes, size in zip(self.levels[-2::-1], self.sizes[-2::-1], strict=True):
            lower = {}
            for p, rest in paths.items():
                run = range(p * ARITY, min(p * ARITY + ARITY, size))
                if all(i in nodes for i in run):
                    for i in run:
                        lower[i] = ((("".join(nodes[j] for j in run if j < i), "".join(nodes[j] for j in run if j > i)),) + rest)
            paths = lower
        return paths


def fold_up(leaf: str, siblings: Iterable[tuple[str, str]]) -> str:
    """The root that a leaf and the siblings of its path make."""
    for left, right in siblings:
        leaf = _node((left, leaf, right))
    return leaf


def proofs(made: Manifest) -> DataFrame:
    """Per leaf: doc_id, leaf, subroot, root, siblings by level, presented, folded_root, verified."""
    coords = coordinates(made.runs, made.sources)
    fetched = coords.join(made.nodes, ["tree", "level", "idx"]).select("part", "tree", "level", "idx", "digest")
    sources = made.sources

    def expand(leaves: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
        had: dict[int, dict[int, dict[int, str]]] = {}
        for tree, level, idx, digest in zip(nodes.tree, nodes.level, nodes.idx, nodes.digest, strict=True):
            had.setdefault(tree, {}).setdefault(level, {})[idx] = digest.hex()
        own = {tree: rows for tree, rows in leaves.groupby("tree")}
        trees = {t: _Tree(dict(zip(rows.pos, map(bytes.hex, rows.leaf), strict=True)), int(rows.n.iloc[0]), had.get(t, {})) for t, rows in own.items()}
        top = _Tree({t: tree.root for t, tree in trees.items()}, sources, had.get(TOP, {}))
        upper, out = top.paths(), []
        for t, rows in own.items():
            paths = trees[t].paths(upper[t])
            for doc_id, pos, leaf, presented in zip(rows.doc_id, rows.pos, rows.leaf, rows.presented, strict=True):
                shown = leaf if presented is None else presented
                folded = fold_up(shown.hex(), paths[pos])
                siblings = [{"left": left, "right": right} for left, right in paths[pos]]
                out.append((doc_id, leaf.hex(), trees[t].root, top.root, siblings, shown.hex(), folded, folded == top.root))
        found = pd.DataFrame(out, columns=["doc_id", "leaf", "subroot", "root", "siblings", "presented", "folded_root", "verified"])
        return found.astype({"doc_id": "Int64"})

    return made.leaves.groupBy("part").cogroup(fetched.groupBy("part")).applyInPandas(expand, PROOFS)
