"""Near duplicates by similarity: SimHash bands propose groups, the shingle sets decide.

A sketch is ``WORDS64`` SimHash fingerprints of a text's distinct shingles.  Of two texts with Jaccard
similarity J (sets of equal size) a bit differs with probability p = acos(2J / (1 + J)) / pi, and less for
sets of other sizes.  A band is a fixed choice of bits; texts that agree in one meet under its key, and
there are as many bands as miss less than ``MISSED`` of the pairs at the threshold.  Texts that meet and
differ in at most ``LOOSE`` of the bits are joined in groups.  Inside a group every pair that close is
held against the exact similarity of its shingle sets, unless verified links join the two already; only
verified links make components.  A task gets each set of a block once, so what is moved grows with a
group and not with its pairs; groups above ``BLOCK`` texts are cut into pairs of blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.llm import simhash
from lexloom.llm.components import connected_components
from lexloom.llm.runtime import bounded_batches, row_key, session_of, staged

#: Fingerprints of 64 bits in a sketch.
WORDS64 = 6
SKETCH_BITS = 64 * WORDS64
#: Share of the bits within which a pair is verified; at a similarity of 0.8 the mean is 0.15.
LOOSE = 0.24
#: Share of the pairs at the threshold that no band may bring together.
MISSED = 0.005
#: Bits of a band: so many that about 64 texts meet by chance, and this at least.
LEAST_BITS = 14
#: Texts of a group whose sets one task holds at once, twice.
BLOCK = 512


def differing(similarity: float) -> float:
    """Probability that a bit of two sketches differs."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def bands(rows: int, similarity: float) -> list[np.ndarray]:
    """The bits of each band for a table of so many sketches."""
    size = max(LEAST_BITS, math.ceil(math.log2(max(rows, 2))) - 6)
    count = math.ceil(math.log(MISSED) / math.log1p(-((1 - differing(similarity)) ** size)))
    r = np.random.default_rng(64)
    return [r.choice(SKETCH_BITS, size, replace=False) for _ in range(count)]


def band_keys(sketch: np.ndarray, chosen: list[np.ndarray]) -> Iterator[np.ndarray]:
    """A key for each band of the sketches (rows, WORDS64): the band's number and bits."""
    for number, bits in enumerate(chosen):
        key = np.full(len(sketch), number << 40, np.uint64)
        for i, bit in enumerate(bits.tolist()):
            key |= (sketch[:, bit // 64] >> np.uint64(bit % 64) & np.uint64(1)) << np.uint64(i)
        yield key


def sketches(df: DataFrame, text_col: str, words: int, out_col: str) -> DataFrame:
    bounded_batches(session_of(df))

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def made(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            out = []
            for text in batch.to_pylist():
                h = np.unique(simhash.shingle_hashes(text, words))
                out.append([np.uint64(simhash.fingerprint(simhash.remixed(h, k))).astype(np.int64).item() for k in range(WORDS64)])
            yield pa.array(out, pa.list_(pa.int64()))

    return df.withColumn(out_col, made(F.col(text_col)))


def shingle_sets(df: DataFrame, text_col: str, words: int, out_col: str) -> DataFrame:
    bounded_batches(session_of(df))

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def made(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array([np.unique(simhash.shingle_hashes(text, words)).view(np.int64) for text in batch.to_pylist()], pa.list_(pa.int64()))

    return df.withColumn(out_col, made(F.col(text_col)))


def forest_of_met(key: np.ndarray, node: np.ndarray, sketch: np.ndarray, loose: int, cut: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted by key: spanning forest of the pairs that share a key and differ in ``loose`` bits at most.

    With ``cut`` one key's rows, paired across it only.
    """
    found = [(node[:0], node[:0])]

    def blocks(lo: int, hi: int) -> None:
        for x in range(lo, cut or hi, BLOCK):
            for y in range(cut or x, hi, BLOCK):
                i, j = np.nonzero(distances(sketch[x : min(x + BLOCK, cut or hi)][:, None], sketch[y : min(y + BLOCK, hi)][None, :]) <= loose)
                found.append(simhash._forest(node[x + i], node[y + j]))

    if cut:
        blocks(0, len(node))
    else:
        edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
        size = np.diff(edge)
        run = np.repeat(np.arange(len(size)), size)
        small = size[run] <= simhash.SMALL
        for shift in range(1, min(simhash.SMALL, int(size.max(initial=1)))):
            i = np.flatnonzero((run[shift:] == run[:-shift]) & small[shift:])
            i = i[distances(sketch[i], sketch[i + shift]) <= loose]
            found.append((node[i], node[i + shift]))
        for r in np.flatnonzero(size > simhash.SMALL):
            blocks(int(edge[r]), int(edge[r + 1]))
    return simhash._forest(*(np.concatenate(x) for x in zip(*found, strict=True)))


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bits in which sketches (..., WORDS64) differ."""
    return sum((np.bitwise_count(x[..., w] ^ y[..., w]).astype(np.uint16) for w in range(x.shape[-1])), np.uint16(0))


def verified_forest(sketch: np.ndarray, sets: list[np.ndarray], part: np.ndarray, loose: int, tenths: int) -> list[tuple[int, int]]:
    """Links (i, j) that join what rows of similarity ``tenths`` / 10 or more join; of different parts only, if there are two."""
    root = list(range(len(sets)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    d = np.triu(distances(sketch[:, None], sketch[None, :]) <= loose, 1)
    if part.min() != part.max():
        d &= part[:, None] != part[None, :]
    i, j = np.nonzero(d)
    order = np.argsort(distances(sketch[i], sketch[j]), kind="stable")
    out = []
    for a, b in zip(i[order].tolist(), j[order].tolist(), strict=True):
        x, y = find(a), find(b)
        n, m = len(sets[a]), len(sets[b])
        if x == y or 10 * min(n, m) < tenths * max(n, m):
            continue
        common = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
        if common * 10 >= (n + m - common) * tenths:
            root[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def candidates(nodes: DataFrame, similarity: float, loose: int) -> DataFrame:
    """Edges (a, b) that join those of ``nodes`` (node long, fps array of distinct sketches) that may be similar."""
    chosen = bands(nodes.count(), similarity)
    names = [f"f{i}" for i in range(WORDS64)]
    rows = nodes.select("node", *[F.col("fps")[i].alias(c) for i, c in enumerate(names)])
    return simhash.links_by_key(rows, names, lambda sketch: band_keys(sketch, chosen), lambda key, node, sketch, cut: forest_of_met(key, node, sketch, loose, cut))


def components(docs: DataFrame, words: int, tenths: int, text_col: str = "text") -> DataFrame:
    """(row, component): ``row_key`` of each row of ``docs`` and a number for its group of near duplicates.

    Texts link if at least ``tenths`` tenths of the distinct shingles of both are common; null and empty
    texts, and others without words, link with each other.  Texts of equal sketches are one node.
    Repeated rows have one key; ids and clashing names of other columns play no part; an empty table has
    no components.
    """
    loose = int(SKETCH_BITS * LOOSE)
    keyed = docs.select(row_key(docs).alias("row"), F.col(text_col).cast("string").alias("text"))
    own = staged(sketches(keyed, "text", words, "fps").select("row", "fps"), "sketches")
    nodes = staged(own.groupBy("fps").agg(F.min("row").alias("row")).withColumn("node", F.monotonically_increasing_id()), "nodes")
    groups = staged(connected_components(candidates(nodes, tenths / 10, loose), "a", "b").withColumnRenamed("component", "g"), "groups")
    blocks = groups.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    placed = groups.join(blocks, "g").withColumn("part", F.expr("cast(pmod(xxhash64(node), blocks) as int)")).join(nodes, "node")
    sets = staged(shingle_sets(keyed.join(placed, "row").dropDuplicates(["node"]), "text", words, "shingles").drop("text", "row"), "shingles")
    dealt = sets.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).withColumns({"lo": F.least("part", "other"), "hi": F.greatest("part", "other")})

    def verify(table: pa.Table) -> pa.Table:
        node = table.column("node").to_numpy()
        sketch = np.array(table.column("fps").to_pylist(), np.int64).view(np.uint64)
        held = [x.values.to_numpy() for x in table.column("shingles")]
        links = verified_forest(sketch, held, table.column("part").to_numpy(), loose, tenths)
        a, b = np.array(links, np.int64).reshape(-1, 2).T
        return pa.table({"a": node[a], "b": node[b]})

    links = dealt.select("g", "lo", "hi", "node", "part", "fps", "shingles").groupBy("g", "lo", "hi").applyInArrow(verify, "a long, b long")
    parts = connected_components(links, "a", "b")
    named = nodes.join(parts, "node", "left").select("fps", F.coalesce("component", "node").alias("component"))
    return own.join(named, "fps").select("row", "component")
