import pytest

from lexloom import corpus
from lexloom.functions.text import MINISTERIAL


def test_parameters():
    assert corpus.list_params({"year": " 2001 ", "q": "", "limit": "9999", "metadata_only": "No", "offset": "-3"}) == {"year": 2001, "metadata_only": False, "limit": 500, "offset": 0}
    with pytest.raises(ValueError):
        corpus.list_params({"metadata_only": "maybe"})
    assert corpus.page_links("q=a&offset=50", 50, 50, 50) == ("q=a&offset=0", "q=a&offset=100")
    assert corpus.page_links("q=a", 3, 50, 0) == (None, None)


def test_plans():
    plan = corpus.search_plan({"actor": "Minister", "limit": 1000, "unknown": 1, "terms": "a b"})
    assert (plan.actor, plan.limit, plan.terms) == (MINISTERIAL, 100, ["a b"])
    with pytest.raises(ValueError):
        corpus.search_plan({"modality": "maybe"})


def test_diff_of_stored_versions(spark, tmp_path):
    save = lambda name, rows, schema: spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / name))
    save("versions", [("v1", "d", "2000-01-01"), ("v2", "d", "2001-01-01"), ("w", "other", "2001-01-01")], "version_id string, document_id string, snapshot_date string")
    spark.read.parquet(str(tmp_path / "versions")).selectExpr("version_id", "document_id", "date(snapshot_date) as snapshot_date").write.parquet(str(tmp_path / "v"))
    (tmp_path / "versions").rename(tmp_path / "old")
    (tmp_path / "v").rename(tmp_path / "versions")
    save("provisions", [("v1", "d", 1, "section", "1", "h", "a", None, "x"), ("v2", "d", 1, "section", "1", "h", "a", None, "y")], "version_id string, document_id string, ordinal int, provision_type string, number string, heading string, anchor string, extent string, text_sha256 string")
    save("texts", [("x", "old"), ("y", "new")], "text_sha256 string, markdown string")
    save("effects", [("e1", "d", "T", "2000-06-01"), ("e2", "d", "T", "2002-06-01")], "effect_id string, affected_document_id string, textual_kind string, in_force_date string")
    save("refs", [("e1", "affected", "1", "section"), ("e2", "affected", "1", "section")], "effect_id string, side string, section_number string, provision_kind string")
    c = corpus.Corpus(spark, str(tmp_path))
    entries, attached, rest = c.diff_versions("v1", "v2")
    assert [(r["status"], r["from_markdown"], r["to_markdown"]) for r in entries.collect()] == [("changed", "old", "new")]
    assert [r["effect_id"] for r in attached.collect()] == ["e1"] and rest.count() == 0
    for a, b in (("v1", "none"), ("v1", "w")):
        with pytest.raises(ValueError):
            c.diff_versions(a, b)
