"""Queries without SQL against brute force on small tables that reach beyond one page and the first ids."""

import difflib
import random

from lexloom.operators import entities, keyed
from lexloom.plans import more_queries  # noqa: F401
from lexloom.plans.queries import QUERIES


def test_layout_takes_all_words_of_all_documents(spark, tmp_path):
    r = random.Random(3)
    texts = {i: " ".join(f"w{r.randrange(10**6)}" for _ in range(n)) for i, n in ((1, 5), (2, 60), (3, 61), (99, 192), (100, 193), (5000, 1500), (7001, 4))}
    spark.createDataFrame([*texts.items(), (8000, None), (8001, "")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {x["path"]: x["markdown"] for x in QUERIES["b16_layout_to_markdown"](spark, str(tmp_path)).collect()}
    want = {"8001": "# Title\n\n\n"}
    for i, text in texts.items():
        words = text.split(" ")
        pages = [" ".join(words[at : at + 192]) for at in range(0, len(words), 192)]
        want[str(i)] = "# Title\n\n" + "\n\n".join(f"<!-- Page {n} -->\n{p}" for n, p in enumerate(pages, 1)) + "\n"
    assert got == want


def test_fuzzy_candidates_of_all_customers(spark, tmp_path):
    suppliers = {i: f"Supplier#{i:09d}" for i in (1, 2, 3, 40, 500)}
    customers = [f"Customer#{i:09d}" for i in (1, 299, 300, 500, 12345)]
    spark.createDataFrame([(int(c[-9:]), c) for c in customers], "c_custkey long, c_name string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame(list(suppliers.items()), "s_suppkey long, s_name string").write.parquet(f"{tmp_path}/supplier.parquet")
    got = {}
    for x in QUERIES["j13_fuzzy_candidates"](spark, str(tmp_path)).collect():
        got.setdefault(x["name"], []).append((x["rank"], x["entity_id"], round(x["ratio"], 6)))
    key = lambda name: name.lower().replace("#", "")
    want = {}
    for c in customers:
        name = c.replace("Customer", "Suplier")
        ranked = sorted((-difflib.SequenceMatcher(None, key(name), key(d)).ratio(), i) for i, d in suppliers.items())
        want[name] = [(n, i, round(-r, 6)) for n, (r, i) in enumerate(((r, i) for r, i in ranked if -r >= 0.72), 1)]
    assert {k: sorted(v) for k, v in got.items()} == want


def test_shards_of_the_catalogue_change_nothing(spark, monkeypatch):
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcde") for _ in range(r.randint(4, 9)))
    book = spark.createDataFrame([(i, f"{word()} {word()} office") for i in range(60)] + [(100, "abc"), (101, "The abc")], "entity_id long, display string")
    names = spark.createDataFrame([(f"{word()} {word()} office",) for _ in range(15)] + [("abc",), ("zzzzzz",)], "name string")
    ask = lambda: sorted(map(tuple, entities.fuzzy_candidates(names, book, n=5, cutoff=0.5, keep=4).collect()))
    whole = ask()
    monkeypatch.setattr(entities, "SHARD_KEYS", 7)
    monkeypatch.setattr(entities, "BLOCK_NAMES", 4)
    assert ask() == whole and len({x[0] for x in whole}) > 10


def test_bounds_lose_no_close_key():
    r = random.Random(5)
    for letters in ("ab ", "abcde0 ", "0123456789"):
        word = lambda letters=letters: "".join(r.choice(letters) for _ in range(r.choice((1, 3, 9, 20, 63, 64, 65, 230)))).strip() or "a"
        keys = sorted({word() for _ in range(80)})
        shelf = entities.Shelf(keys)
        for key in [*(word() for _ in range(10)), *r.sample(keys, 3), keys[0] + "a", keys[-1][:7]]:
            for n, cutoff in ((1, 0.3), (3, 0.72), (8, 0.5)):
                close, inside = shelf.close(key, n, cutoff)
                assert sorted(close) == sorted(difflib.get_close_matches(key, keys, n=n, cutoff=cutoff))
                assert all(v == difflib.SequenceMatcher(None, k, key).ratio() for k, v in close.items())
                assert inside == [k for k in keys if key in k or k in key]
    assert entities.Shelf([]).close("abc", 8, 0.5) == ({}, [])


def test_names_without_letters_are_close_to_nothing(spark):
    book = spark.createDataFrame([(1, "Office of Works"), (2, "!!"), (3, None)], "entity_id long, display string")
    names = spark.createDataFrame([("??",), (None,), ("",), ("office of work",)], "name string")
    assert [(x["name"], x["entity_id"], x["rank"]) for x in entities.fuzzy_candidates(names, book).collect()] == [("office of work", 1, 1)]


def test_numbers_have_no_gaps_and_do_not_depend_on_partitions(spark):
    df = spark.range(3000).selectExpr("concat('k', id) as k")
    one = {x["k"]: x["_number"] for x in keyed.numbered(df.repartition(7), ["k"], 10).collect()}
    assert sorted(one.values()) == list(range(11, 3011))
    assert one == {x["k"]: x["_number"] for x in keyed.numbered(df.coalesce(1), ["k"], 10).collect()}
    assert keyed.numbered(df.limit(0), ["k"]).count() == 0


def test_only_measured_small_tables_are_broadcast(spark, monkeypatch):
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    df = spark.range(100).selectExpr("cast(id as string) as k")
    assert hinted(keyed.small(df, "k"))
    monkeypatch.setattr(keyed, "SMALL", 10)
    assert not hinted(keyed.small(df, "k"))
    monkeypatch.setattr(keyed, "MEASURED", 10)
    assert not hinted(keyed.small(df, "k"))
