"""Pages whose url looks like an archive's first record, and archives that can't be read."""

import pytest
from pyspark.sql import functions as F

from lexloom.llm import arc_tables


def test_pages_with_filedesc_urls_stay(spark):
    rows = [(1, "http://a/", "x"), (2, "filedesc://b.arc", "y"), (3, "filedesc://b.arc", "x"), (4, None, "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = {(r["record_key"], r["type"], r["refers_to_key"]) for r in arc_tables.pages_through_archives(pages).collect()}
    assert got == {(1, "revisit", 3), (2, "response", None), (3, "response", None), (4, "response", None)}


def test_unreadable_archive_fails_the_query(spark, monkeypatch):
    pages = spark.createDataFrame([(1, "http://a/", "x")], "page_id long, url string, html string")
    whole = arc_tables.pages_to_arc
    cut = lambda *a, **k: whole(*a, **k).withColumn("content", F.expr("substring(content, 1, length(content) - 20)"))
    monkeypatch.setattr(arc_tables, "pages_to_arc", cut)
    with pytest.raises(Exception, match="archive pages-"):
        arc_tables.pages_through_archives(pages).collect()
