import random

import numpy as np
from pyspark.sql import functions as F

from lexloom.operators import coverage, effects, entities, layout, publish, search
from lexloom.operators.keyed import as_of_pair
from lexloom.streaming import poll

BATCH = "publish_seq long, document_id string, version_kind string, snapshot_date date, source_sha256 string, markdown string"


def empty_state(spark):
    make = lambda schema: spark.createDataFrame([], schema)
    return publish.State(
        make("document_id string, title string, latest_version_id string"),
        make("version_id string, document_id string, version_kind string, snapshot_date date, source_sha256 string, markdown_sha256 string, canonical_sha256 string, publish_seq long, word_count long, is_metadata_only boolean"),
        make("version_id string, document_id string, ordinal int, provision_type string, number string, heading string, anchor string, extent string, text_sha256 string"),
        make("text_sha256 string, markdown string, plain_text string"),
    )


def batch(spark, *rows):
    typed = spark.createDataFrame(rows, BATCH.replace("snapshot_date date", "snapshot_date string"))
    return typed.withColumn("snapshot_date", F.to_date("snapshot_date"))


def test_publish_reuses_equal_content(spark):
    b1 = batch(spark, (1, "d", "point_in_time", "2020-01-01", "s1", "# D\n## 1 A\nx\n"), (2, "d", "point_in_time", "2020-02-01", "s2", "# D\n## 1 A\ny\n"))
    s1 = publish.publish(empty_state(spark), b1)
    again = publish.publish(s1, batch(spark, (3, "d", "point_in_time", "2020-01-01", "s1", "# D\n## 1 A\nx\n")))
    assert again.versions.count() == 2 and again.texts.count() == 2 and again.provisions.count() == 2
    assert again.documents.first()["latest_version_id"] == "point-in-time:2020-01-01:d"
    clash = publish.publish(s1, batch(spark, (4, "d", "point_in_time", "2020-01-01", "s9", "# D\n## 1 A\nz\n")))
    ids = sorted(r["version_id"] for r in clash.versions.collect())
    assert len(ids) == 3 and ids[1].startswith("point-in-time:2020-01-01:d:") and len(ids[1].rsplit(":", 1)[1]) == 12


def test_as_of_pair_edges(spark):
    left = spark.createDataFrame([("e1", 1, 5), ("e2", 1, 1), ("e3", 1, 9), ("e4", 2, 5), ("e5", 1, None)], "id string, k int, t int")
    right = spark.createDataFrame([("v1", 1, 1), ("v2", 1, 5), ("v3", 1, 7)], "v string, k int, t int")
    got = {r["id"]: (r["before_id"], r["after_id"]) for r in as_of_pair(left, right, "k", "t", "t", "v", "id").collect()}
    assert got == {"e1": ("v1", "v2"), "e2": (None, "v1"), "e3": ("v3", None), "e4": (None, None), "e5": (None, None)}


def test_as_of_pair_has_no_nested_loop(spark):
    left = spark.range(10).selectExpr("id", "id % 3 as k", "id as t")
    plan = as_of_pair(left, left.selectExpr("id as v", "k", "t"), "k", "t", "t", "v", "id")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_extent_option(spark):
    e = spark.createDataFrame([("e", "d", "T", True, "2001-01-01")], "effect_id string, affected_document_id string, textual_kind string, applied boolean, x string").withColumn("in_force_date", F.to_date("x"))
    refs = spark.createDataFrame([("e", "affected", "1", "section")], "effect_id string, side string, section_number string, provision_kind string")
    v = spark.createDataFrame([("a", "d", "2000-01-01"), ("b", "d", "2002-01-01")], "version_id string, document_id string, y string").withColumn("snapshot_date", F.to_date("y"))
    p = spark.createDataFrame([("a", "section", "1", "E", "x"), ("a", "section", "1", "S", "y"), ("b", "section", "1", "E", "x"), ("b", "section", "1", "S", "y")], "version_id string, provision_type string, number string, extent string, text_sha256 string")
    loose = effects.verify_effects(effects.confirmation_facts(e, refs, v, p)).first()
    strict = effects.verify_effects(effects.confirmation_facts(e, refs, v, p, match_extent=True)).first()
    assert (loose["text_differs"], strict["text_differs"], strict["text_identical"]) == (1, 0, 1)


def test_query_terms():
    assert search.query_terms(['"deprivation of" (citizenship)', "-peace or and order"]) == [["deprivation", "of", "citizenship"], ["peace", "order"]]
    assert search.query_terms(["or", ""]) == [["power"]]


def test_fuzzy_candidates(spark):
    names = spark.createDataFrame([("The Environment Agencies",), ("zzz",)], "name string")
    book = spark.createDataFrame([(1, "Environment Agency"), (2, "Food Agency")], "entity_id long, display string")
    got = entities.fuzzy_candidates(names, book).collect()
    assert [(r["entity_id"], r["rank"]) for r in got] == [(1, 1)]


def test_decisions_and_scopes(spark):
    people = spark.createDataFrame([(1, "A"), (2, "Group")], "entity_id long, name string")
    d = spark.createDataFrame([("x", 1, None), ("y", None, "office"), ("z", 99, None)], "name string, entity_id long, kind string")
    alias, fresh, counts = entities.apply_decisions(d, people)
    assert [tuple(r) for r in alias.collect()] == [(1, "x")] and [tuple(r) for r in fresh.collect()] == [(3, "y", "office")]
    assert {r["outcome"]: r["n"] for r in counts.collect()} == {"linked": 1, "created": 1, "skipped": 1}


def test_layout():
    rows = [("PART", 90, 20, 40, 10, 0.9), ("I", 135, 20, 10, 10, 0.9)]
    rows += [(w, 80 + 60 * i, 100, 50, 10, 0.9) for i, w in enumerate(("The", "boat", "shall", "float."))]
    rows += [(w, 80 + 60 * i, 120, 50, 10, 0.9) for i, w in enumerate(("And", "again", "it", "does"))] + [("x", 600, 100, 5, 10, 0.2)]
    assert layout.lines_to_markdown(layout.lines_of_page(2, "", rows)) == "## Part I\n\nThe boat shall float.\n\nAnd again it does"
    assert layout.lines_of_page(1, "", []) == []
    assert layout.lines_of_page(1, "", [("x", 600, 100, 5, 10, 0.2)]) == []


def test_lines_are_those_of_a_walk():
    r = random.Random(6)
    for _ in range(60):
        n = r.randint(1, 120)
        page = sorted(r.randrange(4) for _ in range(n))
        spread = r.choice((20, 200, 2000))
        items = sorted((p, r.choice((r.random(), 0.5)) * spread, r.choice((6.0, 9.0, 25.0))) for p in page)
        want, total, count, last = [], 0.0, 0, None
        for p, centre, reach in items:
            new = p != last or abs(total / count - centre) > reach
            total, count, last = (centre, 1, p) if new else (total + centre, count + 1, p)
            want.append(new)
        p, centre, reach = (np.array(v) for v in zip(*items, strict=True))
        assert layout.line_starts(p, centre, reach).tolist() == want
    empty = np.zeros(0)
    assert layout.line_starts(empty, empty, empty).tolist() == []


def test_layout_table(spark):
    docs = spark.createDataFrame([("p", "T", [(1, "Some text.", [])]), ("q", None, [])], "path string, title string, pages array<struct<page:int,text:string,text_items:array<struct<text:string,x:double,y:double,width:double,height:double,confidence:double>>>>")
    got = {r["path"]: r["markdown"] for r in layout.layout_to_markdown(docs).collect()}
    assert got == {"p": "# T\n\n<!-- Page 1 -->\nSome text.\n", "q": "\n"}


EVENT = "document_id long, legislation_type string, updated string, n int"


def landing(spark, tmp_path):
    def land(n, rows):
        spark.createDataFrame(rows, EVENT).coalesce(1).write.parquet(str(tmp_path / "in" / f"b={n}"))

    return land, lambda: spark.readStream.schema(EVENT).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))


def test_poll_takes_events_once_and_publications_again(spark, tmp_path):
    land, stream = landing(spark, tmp_path)
    land(1, [(1, "ukpga", "2020-01-02", 1), (1, "ukpga", "2020-01-01", 2), (2, "uksi", "2020-01-01", 3), (9, "eur", "2020-01-01", 0), (8, "uksi", "2019-12-31", 0)])
    state = poll.TableState(spark, str(tmp_path / "state"), ["document_id", "updated"])
    ask = lambda: poll.poll(stream(), state, str(tmp_path / "c"), since="2020-01-01", types=("ukpga", "uksi"))
    first = poll.to_ingest(ask(), None)
    assert {r["document_id"]: r["n"] for r in first.collect()} == {1: 2, 2: 3}
    taken = spark.createDataFrame([(1, "2020-01-02"), (2, "2020-01-01")], "document_id long, updated string")
    assert poll.to_ingest(ask(), taken).count() == 0
    land(2, [(3, "uksi", "2020-02-01", 4), (1, "ukpga", "2020-02-01", 5), (1, "ukpga", "2020-02-02", 6)])
    assert {r["document_id"]: r["n"] for r in poll.to_ingest(ask(), taken).collect()} == {1: 5, 3: 4}
    assert [d[2] for d in state.deltas()] == [0, 1]


def test_state_takes_new_data_behind_another_checkpoint(spark, tmp_path):
    land, stream = landing(spark, tmp_path)
    state = poll.TableState(spark, str(tmp_path / "state"), ["document_id"], [F.col("updated").desc()], latest=True)
    land(1, [(1, "x", "2020-01-01", 1)])
    poll.run_available(stream(), poll.into(state), str(tmp_path / "a"))
    land(2, [(2, "x", "2020-01-01", 2), (1, "x", "2019-01-01", 3), (1, "x", "2020-01-01", 4)])
    poll.run_available(stream().where("n > 1"), poll.into(state), str(tmp_path / "b"))
    assert {r["document_id"]: r["n"] for r in state.read().collect()} == {1: 4, 2: 2}  # 3 is older, 4 equally old but later
    poll.run_available(stream(), poll.into(state), str(tmp_path / "a"))
    assert {r["document_id"]: r["n"] for r in state.read().collect()} == {1: 4, 2: 2}


def test_replayed_batch_writes_nothing_and_compaction_forgets_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(poll, "COMPACT_EVERY", 3)
    state = poll.TableState(spark, str(tmp_path / "state"), ["document_id"], [F.col("updated").desc()], latest=True)
    make = lambda k: spark.createDataFrame([(k % 4, "x", f"2020-01-{k + 1:02d}", k)], EVENT)
    for k in range(8):
        assert state.write(make(k), "one", k) and not state.write(make(90), "one", k)
        assert {r["n"] for r in state.read().collect()} == set(range(max(0, k - 3), k + 1))
    assert state.write(make(20), "two", 0) and not state.write(make(21), "one", 7)
    assert state.applied() == {"one": 7, "two": 0} and state.snapshots() == [5, 8]
    assert not [n for n in state._names() if n.startswith("d=") and int(n[2:].split("-")[0]) < 6]


def test_half_written_snapshot_does_not_count(spark, tmp_path):
    state = poll.TableState(spark, str(tmp_path / "state"), ["document_id"])
    make = lambda k: spark.createDataFrame([(k, "x", "2020-01-01", k)], EVENT)
    state.write(make(1), "q", 0)
    make(7).write.parquet(str(tmp_path / "state" / "s=000000000000"))
    state.write(make(2), "q", 1)
    assert {r["n"] for r in state.read().collect()} == {1, 2}
    state.compact()
    assert {r["n"] for r in state.read().collect()} == {1, 2} and state.deltas() == []


def test_failure_reports(spark):
    r = spark.createDataFrame([([("fetch", "Read timed out"), ("fetch", "HTTP status 404 for x")],), ([],)], "failures array<struct<stage:string,error:string>>")
    assert {(x["stage"], x["category"]): x["n"] for x in coverage.failure_counts(coverage.failures_of(r)).collect()} == {("fetch", "timeout"): 1, ("fetch", "HTTP status 404"): 1}
