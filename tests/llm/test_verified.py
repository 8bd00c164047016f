"""The pipeline's near-duplicate stage against exact similarity."""

import random

import numpy as np

import corpus_pipeline
from lexloom.llm import queries, simhash, verified

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def similarity(a: str, b: str) -> float:
    x, y = (set(simhash.shingle_hashes(t, corpus_pipeline.WORDS).tolist()) for t in (a, b))
    return len(x & y) / len(x | y) if x | y else 1.0


def planted(r: random.Random) -> list[str]:
    """Copies with a changed end: pairs above and below 0.8, and many texts that share half with each other."""
    fresh = lambda n: [f"w{r.randrange(10**7)}" for _ in range(n)]
    out = []
    for n in (30, 100, 400):
        for share in (0.4, 0.6, 0.65, 0.75, 0.78, 0.79, 0.8, 0.81, 0.82, 0.85, 0.9, 0.97):
            for _ in range(6):
                same, a, b = fresh(n), [], []
                k = round(n * (1 - share) / share / 2)
                a, b = fresh(k), fresh(k)
                out += [" ".join(same + a), " ".join(same + b)]
    hub = fresh(100)
    return out + [" ".join(hub + fresh(50)) for _ in range(150)]


def exact_groups(texts: list[str]) -> np.ndarray:
    sets = [set(simhash.shingle_hashes(t, corpus_pipeline.WORDS).tolist()) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            common = len(a & b)
            if common * 10 >= 8 * (len(a) + len(b) - common):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return np.array([find(i) for i in range(len(texts))])


def test_stage_equals_exact_similarity(spark, monkeypatch):
    texts = planted(random.Random(11))
    want = exact_groups(texts)
    rows = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], SCHEMA)
    for block in (verified.BLOCK, 32):
        monkeypatch.setattr(verified, "BLOCK", block)
        kept = {r["doc_id"] for r in corpus_pipeline.near_duplicate_stage(spark, rows, "").select("doc_id").collect()}
        firsts = set(np.flatnonzero(want == np.arange(len(texts))).tolist())
        assert not firsts - kept  # nothing is dropped that no similarity of 0.8 joins to another
        assert len(kept - firsts) <= 2  # of about 100 pairs at 0.8 and above
    assert len(firsts & set(range(len(texts) - 150, len(texts)))) == 150


def test_null_and_repeated_ids_keep_their_documents(spark):
    texts = {"a": "one two three four five six seven", "b": "eight nine ten eleven twelve thirteen", "c": "red green blue white black grey pink"}
    rows = [(None, texts["a"]), (None, texts["b"]), (3, texts["b"]), (5, texts["a"]), (5, texts["c"]), (5, texts["c"]), (None, "q w e r t y u i o p")]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA)
    kept = sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicate_stage(spark, df, "").collect()), key=str)
    assert kept == sorted([(3, texts["b"]), (5, texts["a"]), (5, texts["c"]), (None, "q w e r t y u i o p")], key=str)


def test_mixing_keeps_null_ids_and_takes_the_budget(spark):
    r = random.Random(5)
    rows = [(None if i % 3 == 0 else i // 2, " ".join(f"w{r.randrange(10**6)}" for _ in range(r.randint(1, 40))), "en", f"src{i % 7}", 1) for i in range(600)]
    df = spark.createDataFrame(rows, SCHEMA)
    kept = corpus_pipeline.mixing_stage(spark, df, "").collect()
    words = lambda t: len(t.split())
    total, taken = sum(words(x[1]) for x in rows), sum(words(k["text"]) for k in kept)
    budget = total * corpus_pipeline.KEPT_TENTHS // 10
    assert {tuple(k) for k in kept} <= set(rows) and len(kept) == len({tuple(k) for k in kept})
    assert budget <= taken < budget + 40 * 7  # at most one document more for each leaf
    nulls = sum(k["doc_id"] is None for k in kept)
    assert 0.8 * 200 < nulls <= 200


def test_mixing_equals_brute_force_by_leaf(spark):
    from test_models import fill

    r = random.Random(6)
    langs, sources = ("en", "de", "es", "it"), [f"src{i}" for i in (0, 1, 5, 11, 16, 30)]
    rows = [(i, " ".join(["w"] * r.randint(1, 30)), r.choice(langs[: 1 + i % 4]), sources[r.randrange(6) * (i % 3) // 2], i) for i in range(1500)]
    domain = lambda s: {0: "web", 1: "news", 2: "forum", 3: "reference"}.get(int(s[3:]) // 5, "other")
    size = lambda t: len(t.split())
    held: dict = {}
    for _, text, lang, source, _ in rows:
        leaf = (domain(source), lang, source)
        held[leaf] = held.get(leaf, 0) + size(text)
    weights = [queries.DOMAIN_WEIGHTS, queries.LANG_WEIGHTS, queries.SOURCE_WEIGHTS]

    def share(path: tuple, budget: int) -> dict:
        if len(path) == 3:
            return {path: budget}
        names = sorted({leaf[len(path)] for leaf in held if leaf[: len(path)] == path})
        table = weights[len(path)]
        cap = lambda n: sum(v for k, v in held.items() if k[: len(path) + 1] == (*path, n))
        parts = fill([(n, table.get(n, table["*"]), cap(n)) for n in names], budget)
        return {k: v for n in names for k, v in share((*path, n), parts[n]).items()}

    want = share((), sum(held.values()) * corpus_pipeline.KEPT_TENTHS // 10)
    got = dict.fromkeys(held, 0)
    for k in corpus_pipeline.mixing_stage(spark, spark.createDataFrame(rows, SCHEMA), "").collect():
        got[(domain(k["source"]), k["lang"], k["source"])] += size(k["text"])
    assert all(want[k] <= got[k] < want[k] + 30 for k in held) and any(want[k] < held[k] for k in held)
