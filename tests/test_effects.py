"""Effects over whole tables: the narrow plans against the general ones."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from lexloom.operators import diff, effects
from lexloom.plans.adapters import Tables
from lexloom.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


def planned(name, spark):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_coverage_of_single_references_equals_that_of_any(spark):
    r = random.Random(6)
    one = lambda *xs: r.choice([*xs, None])
    rows = [(f"e{i}", one(1, 2, 3), one("T", "NT"), one(True, False), one("1", "2", "9"), one("section", "schedule")) for i in range(300)]
    own = spark.createDataFrame(rows, "effect_id string, affected_document_id long, textual_kind string, applied boolean, section_number string, provision_kind string")
    provisions = spark.createDataFrame([(1, "section", "1"), (1, "section", "1"), (1, None, "2"), (2, "schedule", "2"), (None, "section", "1"), (3, "section", None), (4, "section", "1")], "document_id long, provision_type string, number string")
    plain = lambda df: sorted(map(str, df.select("document_id", "effects", "textual", "applied", "provision_matched").collect()))
    want = plain(effects.effects_coverage(own, own.withColumn("side", F.lit("affected")), provisions))
    assert plain(effects.effects_coverage(own, None, provisions)) == want and len(want) == 4


@needs_tables
def test_coverage_moves_no_ids(spark):
    plan = planned("a4_effects_coverage", spark)
    assert plan.count("FileScan") == 3 and "concat_ws" not in plan


def history(spark, seed):
    """Provisions and effects of a few documents, with versions undated or of one date, and readings of extents."""
    r = random.Random(seed)
    rows, asked = [], []
    for d in range(8):
        for v in range(r.randint(0, 5)):
            date = r.choice([None, *(dt.date(2000 + n, 1, 1) for n in range(5))])
            for n in range(r.randint(1, 6)):
                rows.append((d, f"{d}:{v}", date, n * 2, r.choice(["section", "schedule", None]), r.choice(["1", "2", "3", None]), r.choice([None, "S"]), f"h{r.randint(1, 2)}", "a", r.choice(["x", "y", "x "])))
        for n in range(r.randint(0, 30)):
            asked.append((f"e{d}:{n}", d, r.choice([None, *(dt.date(1999 + n, *m) for n in range(7) for m in ((1, 1), (6, 1)))]), r.choice(["T", "T", "NT"]), r.choice(["1", "2", "3", None]), r.choice(["section", "schedule", None])))
    p = spark.createDataFrame(rows, "document_id long, version_id string, snapshot_date date, ordinal int, provision_type string, number string, extent string, heading string, anchor string, markdown string")
    p = p.withColumn("text_sha256", F.sha2("markdown", 256)).withColumn("compare_code", diff.compare_code(F.col("markdown")))
    return p, spark.createDataFrame(asked, "effect_id string, affected_document_id long, in_force_date date, textual_kind string, section_number string, provision_kind string")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_attribution_in_documents_equals_that_of_pairs(spark, seed):
    provisions, asked = history(spark, seed)
    versions = provisions.select("version_id", "document_id", "snapshot_date").distinct()
    pairs = diff.neighbours(versions)
    arrays = asked.select("effect_id", F.array("section_number").alias("affected_section_numbers"), F.when(F.col("provision_kind").isNotNull(), F.array("provision_kind")).alias("affected_provision_kinds"))
    want = diff.attach_effects(diff.provision_diff(pairs, provisions), diff.window_candidates(pairs, versions, asked), diff.effect_targets(arrays))
    got = diff.attach_in_documents(diff.document_diff(provisions), diff.document_candidates(versions, asked))
    plain = lambda df, *columns: sorted(map(str, df.select("pair_id", "effect_id", *columns).collect()))
    assert plain(got[0], "gap", "rank", "index", "status") == plain(want[0], "gap", "rank", "index", "status") != []
    assert plain(got[1]) == plain(want[1]) != []


def test_lines_by_document_lose_nothing(spark, tmp_path):
    prices = [0.1, 123.45, 10.004, 10.0041, 1e300, float("nan"), -7.005, None]
    times = ["1997-03-01 00:00:00", "1997-03-01 12:34:56.789", "1997-03-01 12:34:56.788", None]
    rows = [(i % 3, 5, i % 7, i % 2, p, t, "N", "O") for i, (p, t) in enumerate([(p, t) for p in prices for t in times] * 2)]
    for kind in ("timestamp", "timestamp_ntz", "date"):
        df = spark.createDataFrame(rows, "l_partkey long, l_orderkey long, l_suppkey long, l_linenumber int, l_extendedprice double, t string, l_returnflag string, l_linestatus string")
        df.withColumn("l_shipdate", F.col("t").cast(kind)).drop("t").write.parquet(f"{tmp_path}/{kind}/lineitem.parquet")
        t = Tables(spark, f"{tmp_path}/{kind}")
        plain = lambda d: sorted(map(str, d.select("l_partkey", "l_orderkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_extendedprice", "ordinal", "markdown").collect()))
        assert plain(t.dated_lines(whole=True)) == plain(t.dated_lines())


@needs_tables
@pytest.mark.parametrize("name", ["j15_attached_effects", "j15_unattached_effects"])
def test_attribution_shuffles_each_table_once(spark, name):
    plan = planned(name, spark)
    assert plan.count("FileScan") == 4 and plan.count("Exchange hashpartitioning") == 3


@needs_tables
def test_versions_and_provisions_share_their_shuffle(spark):
    got = QUERIES["j15_unattached_effects"](spark, SF)
    got.collect()
    assert "ReusedExchange" in got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
