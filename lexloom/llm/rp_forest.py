"""Near-duplicate vectors by a forest of random-projection trees with spill.

A tree halves space again and again at the median of a random direction; a vector within ``spill`` of
a cut goes to both sides, so close vectors seldom part.  Depth follows each label's number of
vectors, so leaves stay about as small whatever the table's size.  Every leaf of every tree is
compared in full, in double precision; leaves beyond BLOCK vectors are cut into blocks and compared
block by block in separate tasks.  A pair that shares several leaves counts in the first of them
only, which each task can tell from the leaf lists its vectors carry; so tasks return link counts and
stars, never pairs, and star contraction joins the stars.

With cosine 0.98 in 64 dimensions two linked vectors differ by at most 0.2, which a random direction
sees as about 0.025.  With ``spill`` at half of that a cut parts such a pair in about 1 of 75 cases, a
tree of depth 8 in 1 of 10; the eight trees part it together in 1 of 10^8.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.components import connected_components
from lexloom.llm.runtime import bounded_batches, hash_share, session_of, staged

TREES = 8
#: Vectors that a leaf holds on average, the spilled ones included.
LEAF = 256
#: Most vectors of one side of a comparison.
BLOCK = 1024
#: Spill in units of the spread that a linked pair shows along a random direction.
SPILL = 0.5
#: A leaf of 256 vectors is reached for a label of 10^12 vectors.
MAX_DEPTH = 41
#: Bits of a leaf's path in its code; the tree's number comes above.
PATH_BITS = 48
#: Vectors that medians are taken from, at most about so many, chosen by hash.
FIT_VECTORS = 16384
#: Fewest sampled vectors in a node whose own median is used; below it the whole level's is.
FIT_NODE = 16
#: Share of a node that goes to one side, spill included, about.
SHRINK = 0.54


@dataclass
class Tree:
    """One direction for each level; cuts of each level's nodes, by the node's path."""

    directions: np.ndarray
    cuts: list[np.ndarray]
    level_cut: list[float]

    def cut(self, level: int, node: np.ndarray) -> np.ndarray:
        known = self.cuts[level]
        inside = node < len(known)
        own = known[np.where(inside, node, 0)] if len(known) else np.full(len(node), np.nan)
        return np.where(inside & ~np.isnan(own), own, self.level_cut[level])


def fit_tree(sample: np.ndarray, depth: int, seed: int) -> Tree:
    """Medians of unit vectors ``sample``; levels finer than the sample take the level's median."""
    rng = np.random.default_rng(seed)
    directions = rng.standard_normal((depth, sample.shape[1]))
    directions /= np.linalg.norm(directions, axis=1, keepdims=True)
    node = np.zeros(len(sample), np.int64)
    cuts, level_cut = [], []
    for level in range(depth):
        at = sample @ directions[level]
        level_cut.append(float(np.median(at)) if len(at) else 0.0)
        known = np.full(1 << min(level, 10), np.nan)
        if level <= 10:
            order = np.argsort(node, kind="stable")
            edges = np.searchsorted(node[order], np.arange(len(known) + 1))
            for k in range(len(known)):
                if edges[k + 1] - edges[k] >= FIT_NODE:
                    known[k] = np.median(at[order[edges[k] : edges[k + 1]]])
        cuts.append(known)
        tree = Tree(directions, cuts, level_cut)
        node = node * 2 + (at >= tree.cut(level, node))
    return Tree(directions, cuts, level_cut)


def leaves(tree: Tree, x: np.ndarray, depth: np.ndarray, spill: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) of unit vectors ``x``, each down to its own ``depth``; a leaf is its path with a leading 1."""
    row, node = np.arange(len(x)), np.zeros(len(x), np.int64)
    done_row, done_leaf = [], []
    for level in range(len(tree.directions) + 1):
        end = depth[row] <= level
        done_row.append(row[end])
        done_leaf.append(node[end] | np.int64(1 << level))
        row, node = row[~end], node[~end]
        if not len(row) or level == len(tree.directions):
            break
        at = (x @ tree.directions[level])[row] - tree.cut(level, node)
        low, high = at < spill, at >= -spill
        row, node = np.r_[row[low], row[high]], np.r_[node[low] * 2, node[high] * 2 + 1]
    return np.concatenate(done_row), np.concatenate(done_leaf)


def depth_for(rows: int) -> int:
    return min(MAX_DEPTH, max(0, math.ceil(math.log(max(rows, 1) / LEAF) / -math.log(SHRINK))))


def _units(lists: pa.ListArray) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(lists), -1)
    scale = np.abs(x).max(axis=1, keepdims=True)
    x = x / np.where(scale > 0, scale, 1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _first_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest code that rows of ``a`` and ``b`` (padded with -1 and -2) share."""
    same = (a[:, :, None] == b[:, None, :]).any(2)
    return np.where(same, a, np.iinfo(np.int64).max).min(1)


def _compare(x: np.ndarray, y: np.ndarray, own: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(invalid="ignore"):
        near = x @ y.T >= threshold
    return np.nonzero(np.triu(near, 1) if own else near)


def _stars(a: np.ndarray, b: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The smallest id each member reaches over the links (a, b)."""
    root = ids.copy()
    while True:
        new = root.copy()
        np.minimum.at(new, a, root[b])
        np.minimum.at(new, b, root[a])
        if (new == root).all():
            return root
        root = new


def vector_links(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = 0.98, trees: int = TREES, seed: int = 7) -> DataFrame:
    """(id_col, n_links, component_id, kept): one row for each row of ``df``.

    Vectors link if their labels are equal and not null, they have the same length, and their cosine
    is at least ``threshold``.  Null, zero and non-finite vectors, those with null components and rows
    without a label or id have no links and are components of their own.  Equal vectors of a label are
    one node, compared once and counted by the number of rows, so repeated rows link with each other.
    Links belong to rows: an id that occurs with several vectors has a row, links and a component for
    each.  Other columns are left aside; an empty table gives an empty result.
    A plan is made for each length of vector that occurs.
    """
    spark = session_of(df)
    bounded_batches(spark)
    v = F.col("v")
    kind = "array<float>" if df.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    sound = F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(v, lambda c: c != 0), F.lit(False))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast(kind).alias("v")).withColumn("sound", sound)
    # Two hashes, 128 bits, name a vector of a label, so that rows find their node without its vector.
    own = rows.where("sound").select("id", "label", "v", F.xxhash64("label", "v").alias("h"), F.xxhash64(F.lit(seed), "v", "label").alias("g"))
    nodes = own.groupBy("h", "g").agg(F.first("label").alias("label"), F.first("v").alias("v"), F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"))
    whole = staged(nodes.withColumn("rep", F.monotonically_increasing_id()), "vectors").withColumn("dim", F.size("v"))
    sizes = whole.groupBy("dim", "label").agg(F.count(F.lit(1)).alias("n"))
    most = sizes.groupBy("dim").agg(F.sum("n").alias("n"), F.max("n").alias("largest")).collect()  # a row for each length of vector
    depth_of = F.least(F.lit(MAX_DEPTH), F.greatest(F.lit(0), F.ceil(F.log(F.col("n") / F.lit(float(LEAF))) / F.lit(-math.log(SHRINK))))).cast("int")
    parts = [_links_of(whole.where(F.col("dim") == m["dim"]).join(sizes.select("dim", "label", depth_of.alias("depth")), ["dim", "label"]), kind, m["dim"], m["n"], m["largest"], threshold, trees, seed) for m in most]
    found = parts[0] if parts else spark.createDataFrame([], "rep long, links long, root long")
    for p in parts[1:]:
        found = found.union(p)
    found = staged(found, "vector-links")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = connected_components(found.where("root <> rep"), "rep", "root").join(whole.select(F.col("rep").alias("node"), "least"), "node")
    named = joined.join(joined.groupBy("component").agg(F.min("least").alias("component_id")), "component").select(F.col("node").alias("rep"), "component_id")
    linked = (
        whole.select("h", "g", "rep", "least", "copies").join(counts, "rep", "left").join(named, "rep", "left")
        .select("h", "g", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "least").alias("component_id"))
    )
    own = own.select("id", "h", "g").join(linked, ["h", "g"]).select("id", "n_links", "component_id")
    alone = rows.where("not sound").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return own.union(alone).select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _links_of(vectors: DataFrame, kind: str, dim: int, rows: int, largest: int, threshold: float, trees: int, seed: int) -> DataFrame:
    """(rep, links, root) for each vector and comparison in which it has links."""
    spark = session_of(vectors)
    depth = depth_for(largest)
    sample = vectors.where(hash_share(rows, FIT_VECTORS, F.col("h"))).select("h", "g", "v").toArrow().combine_chunks().sort_by([("h", "ascending"), ("g", "ascending")]).combine_chunks()
    column = sample.column("v")
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    units = _units(column) if sample.num_rows else np.zeros((0, dim))
    forest = spark.sparkContext.broadcast([fit_tree(units, depth, seed + t) for t in range(trees)])
    spill = SPILL * math.sqrt(max(0.0, 2 - 2 * threshold)) / math.sqrt(dim)

    @F.arrow_udf("array<long>")
    def codes(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for v, d in batches:
            x, to = _units(v), d.to_numpy(zero_copy_only=False).astype(np.int64)
            found_row, found_code = [], []
            for t, tree in enumerate(forest.value):
                row, leaf = leaves(tree, x, to, spill)
                found_row.append(row)
                found_code.append(leaf | np.int64(t << PATH_BITS))
            row, code = np.concatenate(found_row), np.concatenate(found_code)
            order = np.lexsort((code, row))
            offsets = np.r_[0, np.cumsum(np.bincount(row, minlength=len(x)))].astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(code[order]))

    coded = staged(vectors.select("rep", "label", "v", "copies", codes("v", "depth").alias("codes")), "vector-codes")
    placed = coded.select("rep", "label", "v", "copies", "codes", F.explode("codes").alias("code"))
    blocks = coded.select("label", F.explode("codes").alias("code")).groupBy("label", "code").agg(F.count(F.lit(1)).alias("n"))
    blocks = blocks.where(f"n > {BLOCK}").select("label", "code", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    dealt = (
        placed.join(blocks, ["label", "code"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("label", "code", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "rep", "v", "copies", "codes")
    )

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        code, lo, hi = (k.as_py() for k in key[1:])
        table = table.combine_chunks().sort_by([("own", "ascending"), ("rep", "ascending")])
        ids, copies, own_ = (table.column(c).to_numpy() for c in ("rep", "copies", "own"))
        x = _units(table.column("v").combine_chunks())
        lists = table.column("codes").combine_chunks()
        ends = np.diff(lists.offsets.to_numpy())
        wide = np.full((len(ids), int(ends.max(initial=1))), -1, np.int64)
        wide[np.arange(wide.shape[1]) < ends[:, None]] = lists.flatten().to_numpy()
        links = np.zeros(len(ids), np.int64)
        root = ids.copy()
        cut = int((own_ == lo).sum())
        sides = [(0, cut, 0, cut)] if lo == hi else [(0, cut, cut, len(ids))]
        for a0, a1, b0, b1 in sides:
            a, b = _compare(x[a0:a1], x[b0:b1], lo == hi, threshold)
            a, b = a + a0, b + b0
            first = np.zeros(len(a), bool)
            for at in range(0, len(a), 1 << 15):
                some = slice(at, at + (1 << 15))
                first[some] = _first_shared(wide[a[some]], np.where(wide[b[some]] < 0, -2, wide[b[some]])) == code
            a, b = a[first], b[first]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            root = np.minimum(root, _stars(a, b, ids))
        some = links > 0
        return pa.table({"rep": ids[some], "links": links[some], "root": root[some]}, schema=pa.schema([("rep", pa.int64()), ("links", pa.int64()), ("root", pa.int64())]))

    return dealt.groupBy("label", "code", "lo", "hi").applyInArrow(compare, "rep long, links long, root long")
