"""SimHash and vectors against brute force on small tables."""

import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from lexloom.llm import components, rp_forest, simhash


def closure(link: np.ndarray, ids: np.ndarray) -> np.ndarray:
    root = ids.copy()
    while True:
        new = np.minimum(root, np.where(link, root[None, :], np.iinfo(np.int64).max).min(1))
        if (new == root).all():
            return root
        root = new


def plain_fingerprint(text: str | None, words: int) -> int:
    """Bit by bit, as defined."""
    import re

    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    tokens = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(tokens[i : i + words]) for i in range(len(tokens) - words + 1)] or ([" ".join(tokens)] if tokens else [])
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def corpus(seed: int, n: int) -> list[str | None]:
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["É", "Ä", "THE"]
    base = [" ".join(r.choice(vocabulary) for _ in range(r.choice((5, 40, 300)))) for _ in range(n // 3)]
    out: list[str | None] = [None, "", " \t\n", "one", "Two words", "a\u00a0b c d e", "x " * 50]
    while len(out) < n:
        t = r.choice(base).split(" ")
        for _ in range(r.choice((0, 0, 1, 3))):
            t[r.randrange(len(t))] = r.choice(vocabulary)
        out.append(r.choice((" ", "\n", "  ")).join(t))
    return out


def test_fingerprints_as_defined():
    for words in (4, 5):
        for text in corpus(3, 80):
            assert simhash.fingerprint(simhash.shingle_hashes(text, words)) == plain_fingerprint(text, words)


def test_spark_hash_is_the_same(spark):
    text = "one two three four"
    (h,) = spark.range(1).select(F.xxhash64(F.lit(text))).first()
    assert np.int64(h).view(np.uint64) == simhash.shingle_hashes(text, 4)[0]


def test_components_of_texts(spark):
    for k, count in ((4, 1), (7, 1), (7, 3), (1, 1)):
        texts = corpus(k, 240)
        rows = spark.createDataFrame([(i * 3 + 1, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, component_id string")
        got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(rows, words=4, max_bits=k, count=count).collect()}
        hs = [simhash.shingle_hashes(t, 4) for t in texts]
        f = np.array([[simhash.fingerprint(simhash.remixed(h, c)) for c in range(count)] for h in hs], np.uint64)
        link = (np.bitwise_count(f[:, None, :] ^ f[None, :, :]) <= k).any(2)
        ids = np.arange(len(texts)) * 3 + 1
        assert got == dict(zip(ids.tolist(), closure(link, ids).tolist(), strict=True))


def test_large_groups_and_repeats(spark, monkeypatch):
    r = np.random.default_rng(2)
    hub = int(r.integers(0, 2**62))
    fps = list({hub ^ (1 << int(a)) ^ (1 << int(b)) for a, b in r.integers(0, 62, (400, 2))}) + [int(x) for x in r.integers(0, 2**62, 300)]
    monkeypatch.setattr(simhash, "BLOCK", 64)
    linker = simhash._Linker(4)
    f = np.array(fps, np.uint64)
    link = np.bitwise_count(f[:, None] ^ f[None, :]) <= 4
    ids = np.arange(len(f))
    edges = []
    for key in simhash._keys(f, 4, 0):
        order = np.argsort(key, kind="stable")
        edges.append(linker.forest(key[order], ids[order], f[order]))
    a, b = (np.concatenate(x) for x in zip(*edges, strict=True))
    found = np.zeros_like(link)
    found[a, b] = found[b, a] = True
    np.fill_diagonal(found, True)
    assert np.array_equal(closure(found, ids), closure(link, ids))
    assert len(a) < 64 * len(f)


def test_repeated_rows_and_null_ids(spark):
    rows = spark.createDataFrame([(5, "a b c d e"), (5, "a b c d e"), (None, "a b c d e"), (None, "other"), (2, None), (9, "")], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(rows).collect()), key=str)
    assert got == sorted([(5, 5), (5, 5), (None, 5), (None, None), (2, 2), (9, 2)], key=str)
    assert simhash.near_duplicates(rows.limit(0)).count() == 0


def test_star_contraction(spark):
    r = random.Random(1)
    chain = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(200, 200), (300, 301), (301, 300), (None, 4)]
    edges = chain + [(r.randrange(400, 480), r.randrange(400, 480)) for _ in range(50)]
    got = {x["node"]: x["component"] for x in components.connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    root = {n: n for e in edges for n in e if n is not None}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        if a is not None and b is not None and find(a) != find(b):
            root[max(find(a), find(b))] = min(find(a), find(b))
    want = {n: find(n) for n in root}
    assert got == {n: c for n, c in want.items() if sum(v == c for v in want.values()) > 1}
    assert components.connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_vectors_against_brute_force(spark):
    r = np.random.default_rng(8)
    base = r.standard_normal((120, 16))
    x = np.concatenate([base, base[:40] + 0.03 * r.standard_normal((40, 16)), base[:30] * 2, np.tile(base[0], (150, 1)) + 0.02 * r.standard_normal((150, 16))])
    labels = [int(i % 3) if i < 150 else 0 for i in range(len(x))]
    rows = [(i, [float(v) for v in row], lab, "x") for i, (row, lab) in enumerate(zip(x.astype(np.float32), labels, strict=True))]
    n = len(rows)
    odd = [(n, None, 0, "x"), (n + 1, [0.0] * 16, 0, "x"), (n + 2, [float("nan")] + [1.0] * 15, 0, "x"), (n + 3, [None] + [1.0] * 15, 0, "x"), (n + 4, rows[0][1], None, "x"), (n + 5, [1.0, 0.0], 0, "x"), (n + 6, [2.0, 0.0], 0, "x"), (n + 7, [], 0, "x"), (n + 8, [float("inf")] * 16, 0, "x")]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int, kept string")
    got = {g["vec_id"]: (g["n_links"], g["component_id"], g["kept"]) for g in rp_forest.vector_links(df).collect()}
    y = x.astype(np.float32).astype(float)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    lab = np.array(labels)
    link = (y @ y.T >= 0.98) & (lab[:, None] == lab[None, :])
    np.fill_diagonal(link, False)
    roots = closure(link | np.eye(n, dtype=bool), np.arange(n))
    want = {i: (int(link[i].sum()), int(roots[i]), bool(roots[i] == i)) for i in range(n)}
    want |= {i[0]: (0, i[0], True) for i in odd} | {n + 5: (1, n + 5, True), n + 6: (1, n + 5, False)}
    assert got == want
    assert rp_forest.vector_links(df.limit(0)).count() == 0


def test_blocks_of_large_leaves(spark, monkeypatch):
    monkeypatch.setattr(rp_forest, "BLOCK", 40)
    r = np.random.default_rng(3)
    x = r.standard_normal(8) + 0.01 * r.standard_normal((150, 8))
    df = spark.createDataFrame([(i, [float(v) for v in row], 1) for i, row in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = rp_forest.vector_links(df).collect()
    assert {(g["n_links"], g["component_id"]) for g in got} == {(149, 0)} and len(got) == 150


def test_recall_of_close_pairs():
    r = np.random.default_rng(5)
    a = r.standard_normal((3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    noise = r.standard_normal(a.shape)
    noise -= (noise * a).sum(1, keepdims=True) * a
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    b = a * 0.98 + noise * np.sqrt(1 - 0.98**2)
    both = np.concatenate([a, b])
    depth = np.full(len(both), rp_forest.depth_for(len(both)))
    met = np.zeros(len(a), bool)
    for t in range(rp_forest.TREES):
        row, leaf = rp_forest.leaves(rp_forest.fit_tree(both[::3], int(depth[0]), t), both, depth, np.sqrt(0.04) / 8)
        held: dict[int, set] = {}
        for x, y in zip(row.tolist(), leaf.tolist(), strict=True):
            held.setdefault(x, set()).add(y)
        met |= np.array([bool(held[i] & held[i + len(a)]) for i in range(len(a))])
    assert met.all()
