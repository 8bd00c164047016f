"""Every stage of the pipeline on nulls, repeats, empty tables and clashing names; split keys and finer keys of the indexes."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lexloom.llm import components, mixing, queries, rp_forest, runtime, simhash, verified

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, component string, language string, share string, ids string"


def rows():
    r = random.Random(14)
    words = "the river runs under old bridges and people watch boats drift slowly past gardens every morning while children play".split()
    text = lambda n: " ".join(r.choice(words) + (".") * (r.random() < 0.1) for _ in range(n)).capitalize()
    own = [(i, text(r.choice((30, 90))), "en", f"src{i % 3}") for i in range(80)]
    own += [(None, text(50), "en", "src1"), (200, None, "en", "src1"), (201, "", None, None), (202, "12 34 !!", "en", "src1"), (203, text(4000), "en", None)]
    own += [own[3]] * 3 + [(3, text(40), "en", "src2")]
    return [(*x, 1, "a", "b", "c", "d", "e") for x in own]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_keeps_whole_rows(spark, docs, name, stage):
    kept = stage(spark, docs, "").collect()
    if name == "SentencePiece encoding":
        assert len(kept) == docs.count() and all(r["n_ids"] == len(r["ids"]) for r in kept)
        assert {r["n_ids"] for r in kept if r["doc_id"] in (200, 201)} == {0}
        return
    have = {tuple(r) for r in docs.collect()}
    assert {tuple(r) for r in kept} <= have
    texts = {r["text"] for r in kept}
    if name == "quality classifier":
        assert texts.isdisjoint({None, ""}) and sum(r["doc_id"] == 3 for r in kept) == 5
    if name == "language ID":
        assert texts.isdisjoint({None, "", "12 34 !!"}) and len(kept) == docs.count() - 3
    if name == "SimHash near-dedup":
        assert len(kept) == len(have) - 1  # three repeats are one row, null and empty are one group
    if name == "mixing sources":
        size = lambda t: len((t or "").split())
        total, taken = (sum(size(r["text"]) for r in x) for x in (docs.collect(), kept))
        assert texts.isdisjoint({None, ""}) and total * corpus_pipeline.KEPT_TENTHS // 10 <= taken <= total


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_of_nothing_is_nothing(spark, docs, name, stage):
    out = stage(spark, docs.limit(0), "")
    assert out.count() == 0 and (name == "SentencePiece encoding" or out.columns == docs.columns)


def test_quality_and_language_stages_by_the_operators_alone(spark, docs):
    """The stages' decisions, row by row, from the operators' own functions."""
    from lexloom.llm import langid, quality

    scorer, model = quality.fit(docs), langid.train(docs)
    have = docs.select("doc_id", "text").collect()
    good = sorted(str(tuple(r)) for r in have if scorer.score(r["text"]) >= queries.QUALITY_THRESHOLD)
    assert sorted(str(tuple(r)) for r in corpus_pipeline.quality_stage(spark, docs, "").select("doc_id", "text").collect()) == good
    names, _ = model.predict_all([r["text"] for r in have])
    wanted = sorted(str(tuple(r)) for r, n in zip(have, names, strict=True) if n in corpus_pipeline.LANGUAGES)
    assert sorted(str(tuple(r)) for r in corpus_pipeline.language_stage(spark, docs, "").select("doc_id", "text").collect()) == wanted


def test_near_copies_of_eight_tenths_are_found(spark):
    """Recall of the configured setting by exact Jaccard of five-word shingles, in steps from 0.8."""
    r = random.Random(31)
    texts, pairs = [], []
    for _ in range(700):
        n, share = r.randint(40, 400), r.uniform(0.8, 0.97)
        words = [f"w{r.randrange(10**6)}" for _ in range(n)]
        own = set(zip(*[words[i:] for i in range(5)], strict=False))
        copy = list(words)
        while True:
            trial = list(copy)
            trial[r.randrange(n)] = f"x{r.randrange(10**6)}"
            theirs = set(zip(*[trial[i:] for i in range(5)], strict=False))
            if len(own & theirs) < share * len(own | theirs):
                break
            copy = trial
        theirs = set(zip(*[copy[i:] for i in range(5)], strict=False))
        pairs.append((len(texts), len(texts) + 1, len(own & theirs) / len(own | theirs)))
        texts += [" ".join(words), " ".join(copy)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = verified.components(df, corpus_pipeline.WORDS, corpus_pipeline.SIMILARITY_TENTHS)
    keyed = df.select(runtime.row_key(df).alias("row"), "doc_id")
    group = {x["doc_id"]: x["component"] for x in found.join(keyed, "row").collect()}
    for low, high in ((0.8, 0.85), (0.85, 0.9), (0.9, 1.01)):
        linked = [group[a] == group[b] for a, b, j in pairs if low <= j < high]
        assert len(linked) > 50 and sum(linked) >= 0.95 * len(linked), (low, sum(linked), len(linked))
    assert len({group[a] for a, _, _ in pairs}) == len(pairs)  # nothing unlike is joined


# --- indexes --------------------------------------------------------------------------------------


def closure(link, ids):
    root = ids.copy()
    while True:
        new = np.minimum(root, np.where(link, root[None, :], np.iinfo(np.int64).max).min(1))
        if (new == root).all():
            return root
        root = new


def crowded(n):
    """Fingerprints around two centres, many within a few bits, and some anywhere."""
    r = np.random.default_rng(17)
    out = set()
    for centre in r.integers(0, 2**62, 2).tolist():
        for _ in range(n):
            x = centre
            for b in r.integers(0, 62, r.integers(0, 7)).tolist():
                x ^= 1 << b
            out.add(x)
    return sorted(out | set(r.integers(0, 2**62, n).tolist()))


@pytest.mark.parametrize("split, fine", [(False, False), (True, False), (False, True), (True, True)])
def test_split_and_finer_keys_lose_no_link(spark, monkeypatch, split, fine):
    if split:
        for name, value in (("HEAVY", 16), ("SAMPLED", 2), ("BLOCK", 32)):
            monkeypatch.setattr(simhash, name, value)
    monkeypatch.setattr(simhash, "refined", lambda nodes, k: fine)
    fps = crowded(250)
    f = np.array(fps, np.uint64)
    link = np.bitwise_count(f[:, None] ^ f[None, :]) <= 4
    ids = np.arange(len(f))
    nodes = runtime.staged(spark.createDataFrame([(i, [x]) for i, x in enumerate(fps)], "node long, fps array<long>"), "test-nodes")
    got = {x["node"]: x["component"] for x in components.connected_components(simhash.fingerprint_links(nodes, 4), "a", "b").collect()}
    want = closure(link, ids)
    assert [got.get(i, i) for i in range(len(f))] == want.tolist()


def test_table_size_decides_on_finer_keys():
    assert not simhash.refined(15_000_000, 4) and simhash.refined(50_000_000_000, 4) and not simhash.refined(10**12, 1)
    for first, size in simhash.segments(4):
        parts = simhash.rest_parts(first, size, 4)
        assert len(parts) == 5 and sum(int(p) for p in parts) == (1 << 64) - 1 - (((1 << size) - 1) << first)


def test_split_bands_lose_no_pair(spark, monkeypatch):
    texts = []
    r = random.Random(2)
    base = [f"w{i}" for i in range(120)]
    for _ in range(120):
        t = list(base)
        for _ in range(r.randrange(4)):
            t[r.randrange(len(t))] = f"x{r.randrange(10**6)}"
        texts.append(" ".join(t))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = {tuple(x["row"]): x["component"] for x in verified.components(df, 5, 8).collect()}
    for name, value in (("HEAVY", 16), ("SAMPLED", 1), ("BLOCK", 32)):
        monkeypatch.setattr(simhash, name, value)
    monkeypatch.setattr(verified, "BLOCK", 16)
    cut = {tuple(x["row"]): x["component"] for x in verified.components(df, 5, 8).collect()}
    groups = lambda d: sorted(sorted(k for k in d if d[k] == c) for c in set(d.values()))
    assert groups(cut) == groups(whole)


def test_ids_and_null_ids_in_fingerprint_components(spark):
    rows = [(5, "a b c d e"), (5, "quite another text here now"), (9, "quite another text here now"), (None, "a b c d e"), (7, "a b c d e")]
    got = sorted(((x["doc_id"], x["component_id"]) for x in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == sorted([(5, 5), (5, 5), (9, 5), (None, 5), (7, 5)], key=str)
    # The two texts of id 5 are two documents: 9 is linked to one, 7 to the other; no link joins the two.
    far = [(1, "a b c d e"), (5, "a b c d e"), (5, "quite another text here now"), (9, "quite another text here now")]
    got = sorted((x["doc_id"], x["component_id"]) for x in simhash.near_duplicates(spark.createDataFrame(far, "doc_id long, text string")).collect())
    assert got == [(1, 1), (5, 1), (5, 5), (9, 5)]


def test_one_vector_id_with_two_vectors(spark):
    rows = [(1, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [1.0, 0.001], 0), (3, [0.0, 2.0], 0), (4, [0.0, 1.0], 0)]
    got = sorted(tuple(x) for x in rp_forest.vector_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).select("vec_id", "n_links", "component_id").collect())
    assert got == [(1, 1, 1), (1, 2, 1), (2, 1, 1), (3, 2, 1), (4, 2, 1)]


# --- others ---------------------------------------------------------------------------------------


def test_levels_of_any_name(spark):
    df = spark.createDataFrame([(i, f"g{i % 3}", f"h{i % 2}", 5) for i in range(60)], "doc_id long, cap string, share string, n long")
    got = mixing.mix(df, {"cap": F.col("cap"), "share": F.col("share")}, {"cap": F.when(F.col("cap") == "g0", 3).otherwise(1), "share": F.lit(1)}, F.expr("sum(cap) div 2"), F.col("n"))
    assert got.agg(F.sum("tokens_taken")).first()[0] == 150 and got.columns[:3] == ["doc_id", "cap", "share"]
    with pytest.raises(ValueError, match="n_tokens"):
        mixing.mix(df, {"n_tokens": F.col("cap")}, {"n_tokens": F.lit(1)}, F.lit(5), F.col("n"))


def test_samples_stay_small_under_equal_rows(spark):
    df = spark.range(20000).selectExpr("case when id < 15000 then 1 else id end as a", "'t' as text")
    hashed = df.select(runtime.row_hash(df).alias("s"))
    sample = hashed.where(runtime.hash_share(20000, 400, F.col("s"))).dropDuplicates(["s"])
    assert 40 < sample.count() < 400


def test_shared_folder_is_not_invented_on_a_cluster():
    class Conf:
        def get(self, *a):
            return None

    class Session:
        conf = Conf()

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

            @staticmethod
            def getConf():
                return Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        runtime.shared_dir(Session())


def test_tables_on_the_way_are_deleted(spark):
    seen = []

    def make():
        seen.append(runtime.staged(spark.range(5).toDF("x"), "way"))
        return seen[0].selectExpr("x + 1 as x")

    out = runtime.staged_alone(make, "result")
    system, place = runtime._place(spark, seen[0]._staged_path)
    assert not system.exists(place) and out.count() == 5
    runtime.discard(out)
    system, place = runtime._place(spark, out._staged_path)
    assert not system.exists(place)
