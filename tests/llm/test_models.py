"""Classifiers, mixing, URL filter and pipeline."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lexloom.llm import langid, mixing, ngrams, quality, queries, url_filter

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


# --- quality --------------------------------------------------------------------------------------


def prose(r, n=80):
    w = ["the", "river", "runs", "under", "old", "bridges", "and", "people", "watch", "boats", "drift", "slowly", "past", "gardens", "every", "morning"]
    out = [r.choice(w) for _ in range(n)]
    for i in range(9, n, 10):
        out[i] += "."
    return " ".join(out).capitalize()


def junk(r, kind):
    t = prose(r)
    if kind == 0:
        return " ".join(x + "!!" for x in t.upper().split())
    if kind == 1:
        return " ".join(x + r.choice(("***", "%%%", "&&&", "$$$")) for x in t.split())
    if kind == 2:
        return " | ".join(t.replace(".", "").split())
    return " ".join(" ".join([x] * 9) for x in t.split()[:12])


def test_weak_labels_find_junk_and_keep_prose(spark):
    r = random.Random(6)
    rows = [(i, prose(r, r.choice((30, 80, 200))), 1) for i in range(300)] + [(1000 + i, junk(r, i % 4), 0) for i in range(60)]
    df = spark.createDataFrame([(*x, "c") for x in rows], "doc_id long, text string, want int, quality_score string")
    scorer = quality.fit(df)
    got = quality.classify(df, scorer).select("want", "quality_score").collect()
    good, bad = ([g["quality_score"] for g in got if g["want"] == k] for k in (1, 0))
    assert min(good) >= 0.5 and np.mean(np.array(bad) < 0.5) > 0.9
    assert all(0 <= a <= 1 for a in scorer.labels.accuracy().values())


def test_quality_edges(spark):
    r = random.Random(1)
    rows = [(1, None), (2, ""), (3, " \n"), (4, "Short."), (5, prose(r) * 3000), (6, prose(r)), (6, prose(r))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x["doc_id"]: x["quality_score"] for x in quality.classify(df, quality.fit(df)).collect()}
    assert got[1] == got[2] == got[3] == 0 and 0 < got[4] <= 1 and got[5] >= 0.5
    none = quality.fit(df.limit(0))
    assert none.score("anything at all") == 0.5 and quality.classify(df.limit(0), none).count() == 0


def test_em_learns_accuracies():
    r = random.Random(3)
    k = len(quality.LABELLERS)
    counts: dict[str, int] = {}
    for _ in range(4000):
        bad = r.random() < 0.2
        kind = r.randrange(k)
        p = "".join(("b" if r.random() < 0.95 else "-") if bad and j == kind else ("b" if r.random() < 0.002 else "g" if j in (0, 5, 7) and not (bad and r.random() < 0.5) else "-") for j in range(k))
        counts[p] = counts.get(p, 0) + 1
    model = quality.fit_weak_labels(counts)
    assert 0.75 < model.share[0] < 0.87
    assert model.posterior("g----g-g-") > 0.9 and model.posterior("g------gb") < 0.5 and model.posterior("-b---g---") < 0.5


def test_grams_do_not_depend_on_pieces(monkeypatch):
    data = np.random.default_rng(0).integers(0, 256, 5000, dtype=np.uint8).tobytes()
    whole = [np.concatenate(list(ngrams.grams(data, (n,), 4096))) for n in (1, 2, 4)]
    monkeypatch.setattr(ngrams, "PIECE", 700)
    assert all(np.array_equal(w, np.concatenate(list(ngrams.grams(data, (n,), 4096)))) for n, w in zip((1, 2, 4), whole, strict=True))


# --- language -------------------------------------------------------------------------------------

SYLLABLES = {"en": "the and ing tion er th wh", "de": "sch ung heit ü ge ein ch", "fr": "eau é ou que tion le è", "es": "ción ll ñ os ar que í"}


def words_in(r, lang, n):
    s = SYLLABLES[lang].split()
    return " ".join("".join(r.choice(s) for _ in range(r.randint(1, 3))) for _ in range(n))


def test_language_held_out(spark):
    r = random.Random(2)
    rows = [(i, words_in(r, lang, r.choice((5, 40))), lang) for i, lang in enumerate(r.choice(list(SYLLABLES)) for _ in range(800))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(df.where("doc_id % 4 <> 2"))
    got = langid.identify(df.where("doc_id % 4 = 2"), model).select("lang", F.col("language.lang").alias("found"), F.col("language.score").alias("score")).collect()
    assert np.mean([g["lang"] == g["found"] for g in got]) > 0.95 and all(0 <= g["score"] <= 1 for g in got)


def test_language_edges(spark):
    rows = [(1, None, "en"), (2, "12 !? ---", "en"), (3, "the king thing", None), (4, "the thing", "en"), (5, "schung heit", "de"), (5, "schung heit", "de"), (6, "", "de"), (7, "the thing " * 40000, "en")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, language string")
    got = {r["doc_id"]: (r["language"]["lang"], r["language"]["score"]) for r in langid.identify(df, langid.train(df)).collect()}
    assert got[1] == got[2] == got[6] == ("und", 0.0) and got[3][0] == "en" and got[5][0] == "de" and got[7][0] == "en"
    empty = langid.train(df.limit(0))
    assert [r["language"]["lang"] for r in langid.identify(df.where("doc_id = 4"), empty).collect()] == ["und"]


# --- mixing ---------------------------------------------------------------------------------------


def fill(children, budget):
    """Water-filling in whole tokens, child by child; (name, weight, cap) to share."""
    live = sorted((c for c in children if c[1] > 0), key=lambda c: (c[2] / c[1], c[0] is not None, c[0]))
    left, out = min(budget, sum(c[2] for c in live)), {c[0]: 0 for c in children}
    while live and live[0][2] * sum(c[1] for c in live) <= live[0][1] * left:
        name, _, cap = live.pop(0)
        out[name], left = cap, left - cap
    total = sum(c[1] for c in live)
    for name, w, _ in live:
        out[name] = w * left // total
    for name, _, _ in live[: left - sum(w * left // total for _, w, _ in live)]:
        out[name] += 1
    return out


def test_water_filling(spark):
    r = random.Random(9)
    rows, want = [], {}
    for case in range(60):
        children = [(f"c{i}" if i else None, r.choice((0, 1, 3, 10)), r.randint(0, 60)) for i in range(r.randint(1, 6))]
        budget = r.randint(0, 200)
        rows += [(case, *c, budget) for c in children]
        want |= {(case, k): v for k, v in fill(children, budget).items()}
    df = spark.createDataFrame(rows, "parent int, name string, w long, cap long, budget long")
    got = {(x["parent"], x["name"]): x["share"] for x in mixing.divide_budget(df, ["parent"], "name", "w", "cap", "budget").collect()}
    assert got == want


def test_prefixes_fill_budgets(spark):
    r = random.Random(4)
    rows = [(i, r.choice(("a", "b", None)), r.choice(("x", "y")), r.randint(0, 9)) for i in range(500)] + [(7, "a", "x", 5)] * 3 + [(None, "a", "x", 4)]
    df = spark.createDataFrame([(*x, "c") for x in rows], "doc_id long, top string, leaf string, n long, share string")
    for tenths, epochs in ((3, 1), (12, 2), (99, 2)):
        got = mixing.mix(df, {"top": F.col("top"), "leaf": F.col("leaf")}, {"top": F.when(F.col("top") == "a", 3).otherwise(1), "leaf": F.lit(1)}, F.expr(f"sum(cap) * {tenths} div {10 * epochs}"), F.col("n"), max_epochs=epochs)
        taken = got.agg(F.sum("tokens_taken")).first()[0]
        held = sum(x[3] for x in rows)
        assert taken == min(held * epochs, held * epochs * tenths // (10 * epochs))
        assert got.where("tokens_taken > n_tokens * %d or partial_tokens > n_tokens" % epochs).count() == 0
    assert mixing.mix(df.limit(0), {"top": F.col("top")}, {"top": F.lit(1)}, F.lit(5), F.col("n")).count() == 0


@needs_tables
def test_mixing_equals_sql(spark):
    import duckdb

    c = duckdb.connect()
    c.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = c.execute(queries.OP2_SQL)
    columns = [d[0] for d in want.description]
    assert sorted(map(tuple, queries.op2_mixing(spark, SF).select(*columns).collect())) == sorted(want.fetchall())


# --- URLs -----------------------------------------------------------------------------------------


def test_rules_and_parts(spark):
    urls = ["http://WWW.Example.ORG/es/x?y", "https://a.org", "https://a.org/", "ftp://x.com/de/#f", "http://b.example.org/en/12", "no scheme", None, "", "a://b://c/d", "http://xorg/", "http://u@com:80/fr/", "http://com/fr/é\n2"]
    df = spark.createDataFrame([(i, u, "z") for i, u in enumerate(urls)], "page_id long, url string, verdict string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"]) for r in url_filter.judge_with_rule_labels(df, queries.RULES).collect()}
    want = [("www.example.org", "/es/x", "example.org/es/"), ("a.org", "", None), ("a.org", "/", "org/"), ("x.com", "/de/", "com/de/"), ("b.example.org", "/en/12", "example.org/en/1"), ("", "", None), ("", "", None), ("", "", None), ("b:", "//c/d", None), ("xorg", "/", None), ("u@com:80", "/fr/", None), ("com", "/fr/é\n2", "com/fr/")]
    assert got == dict(enumerate(want))


def test_trees_learn(spark):
    r = random.Random(7)
    rows = [(f"http://{'spam' if bad else 'site'}{r.randint(1, 99)}.{'biz' if bad and r.random() < 0.8 else 'net'}/{'/'.join(str(r.randint(1, 10**6)) if bad else 'page' for _ in range(3 if bad else 1))}{'?a=1&b=2' if bad else ''}", "block" if bad else "allow") for bad in (r.random() < 0.4 for _ in range(1500))]
    df = spark.createDataFrame(rows, "url string, verdict string")
    model = url_filter.train(df.where(F.crc32("url") % 2 == 0))
    judged = url_filter.judge(df.where(F.crc32("url") % 2 == 1).withColumnRenamed("verdict", "want"), {}, model)
    assert judged.agg(F.avg((F.col("want") == F.col("verdict")).cast("int"))).first()[0] > 0.97
    one = url_filter.train(df.where("verdict = 'block'"))
    assert {x["verdict"] for x in url_filter.judge(df.limit(3), {}, one).collect()} == {"block"}
    none = url_filter.train(df.limit(0))
    assert {x["verdict"] for x in url_filter.judge(df.limit(3), {}, none).collect()} == {"allow"}


# --- pipeline -------------------------------------------------------------------------------------


@needs_tables
def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES:
        kept.append(stage(spark, kept[-1], SF).persist())
    ids = [{r["doc_id"] for r in k.select("doc_id").collect()} for k in kept]
    assert all(b <= a for a, b in zip(ids, ids[1:], strict=False))
    assert all(k.columns == docs.columns for k in kept[:-1]) and ids[4] == ids[5]
    labels = {r["doc_id"]: (r["quality"], r["toxic"]) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert not [i for i in ids[0] - ids[1] if labels.get(i) == (1, 0)]
    texts = [r["text"] for r in kept[3].select("text").collect()]
    assert len(set(texts)) == len(texts)
    for k in kept[1:]:
        k.unpersist()
