"""SimHash near-duplicates by deletion variants.

A fingerprint of 64 bits is cut into s segments with s = floor(k / 2) + 1, the fewest for which two
fingerprints at distance k or less have a segment that differs in at most one bit.  Each segment is
indexed once for each of its bits with that bit as a wildcard, so such a pair meets under an equal
key; 64 keys per distinct fingerprint whatever s is.  Rows are dealt by key and sorted; within a key
distances are counted with numpy, each pair under its first common key only, and what leaves is a
spanning forest of the key's links, never all pairs.  Star contraction joins the forests.

Two things keep a key's work bounded.  Keys that a sample finds to be heavy are cut into blocks, and
each pair of blocks is a task of its own.  And where a table is so large that chance alone fills keys,
a key also holds one of k + 1 parts of the other segments: of k differing bits one part has none.

Several independent fingerprints can be taken of the same shingles: two texts link if any of them is
within k, which finds texts that one fingerprint alone parts by chance.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.llm.components import connected_components
from lexloom.llm.runtime import bounded_batches, session_of, staged

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
BITS = 64
#: Rows of one key compared at once with rows of the same key.
BLOCK = 2048
#: Keys with up to so many rows are compared by shifting whole columns, larger ones block by block.
SMALL = 32
PART = 4096
SEGMENT_BITS = 40
#: Rows of a key that one task may hold; what a sample of one node in SAMPLED finds above it is split.
HEAVY = 1 << 14
SAMPLED = 64
#: Rows that share a key by chance beyond which keys get a part of the other segments as well.
ROWS_PER_KEY = 1024


def shingle_hashes(text: str | None, words: int, seed: int = 42) -> np.ndarray:
    """XXH64 of every run of ``words`` words, repeats included; of the whole sequence if it is shorter."""
    tokens = (text or "").encode().translate(LOWER).split()
    if not tokens:
        return np.zeros(0, np.uint64)
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], seed) for a, b in zip(starts[: 1 - words].tolist(), ends[words - 1 :].tolist(), strict=True)], np.uint64)


def remixed(h: np.ndarray, k: int) -> np.ndarray:
    """A further hash of ``h`` for fingerprint number ``k``; the first is ``h`` itself."""
    if not k:
        return h
    x = h ^ np.uint64((0x9E3779B97F4A7C15 * k) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(h: np.ndarray) -> int:
    """Bit i is 1 if it is set in more than half of ``h``; of no hashes: 0."""
    if not len(h):
        return 0
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(h), PART):
        ones += np.unpackbits(h[at : at + PART].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(h), bitorder="little").tobytes(), "little")


def fingerprints(df: DataFrame, text_col: str, words: int, count: int = 1, out_col: str = "fps") -> DataFrame:
    """``df`` with ``out_col``, an array of ``count`` fingerprints (64 bits as signed long).

    A null or empty text has no words and so fingerprints of zero.  No shuffle.
    """
    bounded_batches(session_of(df))

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def fps(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            out = []
            for text in batch.to_pylist():
                h = shingle_hashes(text, words)
                out.append([np.uint64(fingerprint(remixed(h, k))).astype(np.int64).item() for k in range(count)])
            yield pa.array(out, pa.list_(pa.int64()))

    return df.withColumn(out_col, fps(F.col(text_col)))


def segments(k: int) -> list[tuple[int, int]]:
    """(first bit, bits) of each segment."""
    s = k // 2 + 1
    edges = [i * BITS // s for i in range(s + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def rest_parts(first: int, size: int, k: int) -> list[np.uint64]:
    """Masks of k + 1 parts of the bits outside a segment."""
    outside = [i for i in range(BITS) if not first <= i < first + size]
    return [np.uint64(sum(1 << int(i) for i in part)) for part in np.array_split(outside, k + 1)]


def refined(nodes: int, k: int) -> bool:
    """Whether so many fingerprints need keys with a part of the other segments."""
    return k > 1 and nodes >> (min(size for _, size in segments(k)) - 1) > ROWS_PER_KEY


def _keys(fp: np.ndarray, k: int, number: int, fine: bool = False) -> Iterator[np.ndarray]:
    """A key for each wildcard bit: numbers of fingerprint, bit and part, and the bit's segment without it.

    With ``fine`` there are k + 1 keys for each, with a part of the other segments.  What is too long for
    a key is folded into it; what meets by that is told apart by its distance.
    """
    for first, size in segments(k):
        segment = fp >> np.uint64(first) & np.uint64((1 << size) - 1)
        parts = rest_parts(first, size, k) if fine else [np.uint64(0)]
        for bit in range(size):
            rest = segment & ~np.uint64(1 << bit)
            for p, mask in enumerate(parts):
                own = (rest * np.uint64(0xD6E8FEB86659FD93)) ^ (fp & mask) if fine else rest
                if fine or size > SEGMENT_BITS:
                    own = own * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(BITS - SEGMENT_BITS)
                yield own | np.uint64(((number << 6 | first + bit) << 4 | p) << SEGMENT_BITS)


def _first_key(x: np.ndarray, k: int) -> np.ndarray:
    """The number of the first wildcard under which fingerprints that differ by ``x`` meet."""
    out = np.full(x.shape, BITS, np.int64)
    for first, size in reversed(segments(k)):
        part = x >> np.uint64(first) & np.uint64((1 << size) - 1)
        bit = np.bitwise_count(np.maximum(part, np.uint64(1)) - np.uint64(1)).astype(np.int64)
        out = np.where(np.bitwise_count(part) <= 1, first + bit, out)
    return out


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of stars that join the same nodes as the edges (a, b): each node with its component's smallest."""
    nodes, flat = np.unique(np.r_[a, b], return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        if (new == root).all() and (root[x] == root[y]).all():
            break
        root = new
    child = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[child], nodes[root[child]]


class _Linker:
    """Compares rows (key, node, fingerprint) that share a key."""

    def __init__(self, k: int):
        self.k = k

    def linked(self, bit: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Whether rows p and q link, and this is the first key where they meet."""
        x = p ^ q
        ok = np.bitwise_count(x) <= self.k
        at = np.flatnonzero(ok)
        ok[at] = _first_key(x[at], self.k) == bit[at]
        return ok

    def forest(self, key: np.ndarray, node: np.ndarray, fp: np.ndarray, cut: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Rows sorted by key: spanning forest of their links.  With ``cut`` one key's rows, linked across it only."""
        bit = (key.view(np.uint64) >> np.uint64(SEGMENT_BITS + 4) & np.uint64(63)).astype(np.int64)
        if cut:
            return self.large(int(bit[0]), node, fp, cut)
        edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
        size = np.diff(edge)
        run = np.repeat(np.arange(len(size)), size)
        found_a, found_b = [node[:0]], [node[:0]]
        small = size[run] <= SMALL
        for shift in range(1, min(SMALL, int(size.max(initial=1)))):
            i = np.flatnonzero((run[shift:] == run[:-shift]) & small[shift:])
            ok = i[self.linked(bit[i], fp[i], fp[i + shift])]
            found_a.append(node[ok])
            found_b.append(node[ok + shift])
        for r in np.flatnonzero(size > SMALL):
            lo, hi = edge[r], edge[r + 1]
            a, b = self.large(int(bit[lo]), node[lo:hi], fp[lo:hi])
            found_a.append(a)
            found_b.append(b)
        return _forest(np.concatenate(found_a), np.concatenate(found_b))

    def large(self, bit: int, node: np.ndarray, fp: np.ndarray, cut: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """The same for one key with many rows: blocks against blocks, links of a block kept as a forest."""
        ends_a, ends_b = [node[:0]], [node[:0]]
        n = len(node)
        for lo in range(0, cut or n, BLOCK):
            for at in range(cut or lo, n, BLOCK):
                ours, theirs = fp[lo : min(lo + BLOCK, cut or n)], fp[at : at + BLOCK]
                near = np.bitwise_count(ours[:, None] ^ theirs[None, :]) <= self.k
                i, j = np.nonzero(np.triu(near, 1) if at == lo else near)
                first = _first_key(ours[i] ^ theirs[j], self.k) == bit
                if first.any():
                    a, b = _forest(node[lo + i[first]], node[at + j[first]])
                    ends_a.append(a)
                    ends_b.append(b)
        return _forest(np.concatenate(ends_a), np.concatenate(ends_b))


Forest = Callable[..., tuple[np.ndarray, np.ndarray]]


def links_by_key(nodes: DataFrame, columns: list[str], index: Callable[[np.ndarray], Iterator[np.ndarray]], forest: Forest) -> DataFrame:
    """Edges (a, b): for each key of ``index`` over the ``columns`` (long) of ``nodes``, a forest of its rows' links.

    ``forest(key, node, columns, cut)`` sees rows sorted by key, or with ``cut`` the rows of two blocks
    of one key, to be linked across.  The index is dealt out by key, a row of key, node and columns for
    each.  A task holds one key's rows at a time, up to about HEAVY: keys that a sample of the nodes shows
    to be heavier are cut into blocks by the node's hash, and each pair of blocks is a task.
    """
    spark = session_of(nodes)
    bounded_batches(spark)
    schema = ", ".join(f"{c} long" for c in ("key", "node", *columns))

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = np.stack([c.to_numpy().view(np.uint64) for c in batch.columns[1:]], 1)
                for key in index(values):
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), *batch.columns], names=["key", "node", *columns])

    def linked(table: pa.Table, cut: int = 0) -> tuple[np.ndarray, np.ndarray]:
        key, node, *values = (c.to_numpy() for c in table.combine_chunks().columns[: 2 + len(columns)])
        return forest(key, node, np.stack([v.view(np.uint64) for v in values], 1), cut)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []  # rows of the last key so far

        def out(tables: list[pa.Table]) -> pa.RecordBatch:
            a, b = linked(pa.concat_tables(tables))
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            if not table.num_rows:
                continue
            key = table.column("key").to_numpy()
            cut = int(np.searchsorted(key, key[-1], side="left"))
            if cut:
                yield out([*held, table.slice(0, cut)])
                held = []
            elif held and held[0].column("key")[0].as_py() != key[0]:
                yield out(held)
                held = []
            held.append(table.slice(cut))
        if held:
            yield out(held)

    def link_blocks(group: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("own")
        lo, hi = (k.as_py() for k in group[1:])
        a, b = linked(table, 0 if lo == hi else int((table.column("own").to_numpy() == lo).sum()))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    def keyed(some: DataFrame) -> DataFrame:
        return some.select("node", *columns).mapInArrow(indexed, schema)

    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    heavy = None
    if nodes.count() > HEAVY:
        counted = keyed(nodes.where(F.pmod(F.xxhash64("node"), F.lit(SAMPLED)) == 0)).groupBy("key").agg((F.count(F.lit(1)) * SAMPLED).alias("n")).where(f"n > {HEAVY}")
        heavy = staged(counted.select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "heavy-keys")
    if heavy is None or heavy.isEmpty():
        return keyed(nodes).repartition(parts, "key").sortWithinPartitions("key").mapInArrow(link, "a long, b long")
    light = keyed(nodes).join(heavy, "key", "left_anti").repartition(parts, "key").sortWithinPartitions("key").mapInArrow(link, "a long, b long")
    owned = keyed(nodes).join(heavy, "key").withColumn("own", F.expr("cast(pmod(xxhash64(node, key), blocks) as int)")).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    dealt = owned.select("key", "node", *columns, "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))
    return light.union(dealt.groupBy("key", "lo", "hi").applyInArrow(link_blocks, "a long, b long"))


def fingerprint_links(nodes: DataFrame, k: int, count: int = 1) -> DataFrame:
    """Edges (a, b) that join what ``nodes`` (node long, fps array) links; distinct ``fps`` expected.

    For each fingerprint 64 rows of 24 bytes go into the index, k + 1 times as many where the table is
    ``refined``.
    """
    fine = refined(nodes.count(), k)
    linker = _Linker(k)
    found = None
    for number in range(count):
        own = nodes.select("node", F.col("fps")[number].alias("fp"))
        links = links_by_key(own, ["fp"], lambda v, n=number: _keys(v[:, 0], k, n, fine), lambda key, node, v, cut: linker.forest(key, node, v[:, 0], cut))
        found = links if found is None else found.union(links)
    return found


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, max_bits: int = 4, count: int = 1) -> DataFrame:
    """(id_col, fps, component_id): one row for each row of ``df``.

    Two texts link if one of their ``count`` fingerprints differs in at most ``max_bits`` bits;
    component_id is the smallest id reachable by links, the row's own included.  Null and empty texts
    have zero fingerprints and link like others.  Rows with null ids link too, and have a null component
    where they reach no id; repeated rows share their component, rows of one id with different texts
    don't for that.  Texts are read once; everything after works on fingerprints, equal ones as one node.
    """
    own = staged(fingerprints(df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")), "text", words, count).select("id", "fps"), "fingerprints")
    nodes = staged(own.groupBy("fps").agg(F.min("id").alias("least")).withColumn("node", F.monotonically_increasing_id()), "nodes")
    parts = connected_components(fingerprint_links(nodes, max_bits, count), "a", "b")
    named = nodes.join(parts, "node", "left").select("fps", "least", F.coalesce("component", "node").alias("component"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    labelled = named.join(least, "component").select("fps", "component_id")
    return own.join(labelled, "fps", "left").select(F.col("id").alias(id_col), "fps", "component_id")
