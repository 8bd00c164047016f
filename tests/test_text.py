from pyspark.sql import functions as F

from lexloom.functions import text as t
from lexloom.operators import publish
from lexloom.sources import clml, feeds, files

ACT = b"""<Legislation xmlns="http://www.legislation.gov.uk/namespaces/legislation" xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:atom="http://www.w3.org/2005/Atom" DocumentURI="http://x/1" RestrictExtent="E+W">
<Metadata><dc:title>Boats Act</dc:title></Metadata><Primary><PrimaryPrelims><Title>Boats Act</Title><Number>1999 c. 3</Number><LongTitle>About boats .</LongTitle></PrimaryPrelims><Body>
<P1group><Title>Boats</Title><P1><Pnumber>1<CommentaryRef Ref="c1"/></Pnumber><P1para><Text>A boat ( small ) , floats .</Text><P3><Pnumber>a</Pnumber><P3para><Text>on <b>water</b>;</Text></P3para></P3></P1para></P1></P1group>
<P1group Match="false"><Title>Gone</Title><P1><Pnumber>2</Pnumber><P1para><Text>no</Text></P1para></P1></P1group></Body>
<Schedules><Schedule><Number>SCHEDULE 1</Number><TitleBlock><Title>Oars</Title></TitleBlock><ScheduleBody><Part><Title>One</Title><P1group><Title>Length</Title><P1><Pnumber>1</Pnumber><P1para><Text>long</Text></P1para></P1></P1group></Part></ScheduleBody></Schedule></Schedules></Primary>
<Versions><Version Description="S"><P1group><Title>Boats</Title><P1><Pnumber>1</Pnumber><P1para><Text>A Scots boat</Text></P1para></P1></P1group></Version></Versions>
<Commentaries><Commentary id="c1"><Para><Text>Noted</Text></Para></Commentary></Commentaries></Legislation>"""


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_act_renders_in_order():
    blocks = clml.to_markdown(ACT).split("\n\n")
    assert blocks[1:] == ["# Boats Act", "1999 c. 3", "About boats.", "## 1 Boats", "> Commentary: Noted", "A boat ( small), floats.", "(a) on water;", "## SCHEDULE 1 Oars", "### 1 Length", "long", "## 1 Boats (S)", "A Scots boat\n"]
    assert 'title: "Boats Act"' in blocks[0] and 'extent: "E+W"' in blocks[0]


def test_metadata_only_and_failures(spark):
    bare = b'<Legislation xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:atom="http://www.w3.org/2005/Atom" DocumentURI="u"><dc:title>T</dc:title><atom:link type="application/pdf" href="p.pdf"/></Legislation>'
    assert clml.METADATA_ONLY in clml.to_markdown(bare) and "- p.pdf" in clml.to_markdown(bare)
    rows = spark.createDataFrame([("a", bytearray(ACT)), ("b", bytearray(b"<no")), ("c", bytearray(b"<x/>")), ("d", None)], "path string, content binary")
    got = {r["path"]: (r["markdown"] is None, r["error"]) for r in clml.clml_to_markdown(rows).collect()}
    assert got["a"] == (False, None) and all(got[k][0] and got[k][1] for k in "bcd")


def test_headings(spark):
    for heading, number, kind, extent in (("SCHEDULE 5 X", "5", "schedule", None), ("28D Title (E+W)", "28D", "section", "E+W"), ("28DA Title", None, "document", None), ("Title (see)", None, "document", None), ("(2) x", None, "document", None)):
        h = F.lit(heading)
        n = t.heading_number(h)
        assert one(spark, n, t.provision_type(h, n), t.extent_suffix(h)) == (number, kind, extent)
    assert one(spark, t.heading_number(F.lit("28DA Title"), strict_suffix=False)) == ("28DA",)


def test_splitting(spark):
    docs = spark.createDataFrame([("a", "lost\n## 1 One\ntext\n##  \n\n## Two (S)\nmore\n"), ("b", "no headings "), ("c", "")], "id string, body string")
    got = [(r["id"], r["ordinal"], r["heading"], r["number"], r["anchor"]) for r in publish.split_provisions(docs).orderBy("id", "ordinal").collect()]
    assert got == [("a", 1, "1 One", "1", "1-one"), ("a", 2, "## Two (S)", None, "two-s"), ("b", 1, "Document", None, "document"), ("c", 1, "Document", None, "document")]


def test_effect_kinds_and_refs(spark):
    for kind, want in (("Words substituted", "T"), ("coming into force", "CO"), ("enforced", "CO"), (" ", "UN"), ("Applied", "NT"), ("amendment to earlier commencing SI", "T")):
        assert one(spark, t.textual_kind(F.lit(kind))) == (want,)
    for ref, label, want in (("section-28D-4", "x", ("section", "28D")), ("part-I", "Pt. 2", ("part", "2")), (None, "Sch. 5 para. 3", ("schedule", "5")), (None, "Foo 3", (None, None)), (None, "", (None, None))):
        got = one(spark, t.provision_ref(F.lit(ref).cast("string"), F.lit(label)))[0]
        assert tuple(got) == want


def test_dated_addresses(spark):
    u = "https://www.legislation.gov.uk"
    for raw, want in ((f"{u}/a/2026-01-01/x", f"{u}/a/x"), (f"{u}/a/2026-01-01/2026-01-02/x", f"{u}/a/2026-01-02/x"), (f"{u}/2026-01-01", f"{u}/2026-01-01"), ("http://other/a/2026-01-01", "http://other/a/2026-01-01")):
        assert one(spark, t.canonical_addresses(F.lit(raw))) == (want,)


def test_feeds(spark):
    page = b"""<feed xmlns="http://www.w3.org/2005/Atom" xmlns:leg="http://www.legislation.gov.uk/namespaces/legislation" xmlns:ukm="http://www.legislation.gov.uk/namespaces/metadata"><leg:morePages>2</leg:morePages>
<entry><content><ukm:Effect EffectId="k1" Type="substituted" Applied="true" AffectedURI="http://www.legislation.gov.uk/id/ukpga/1971/77"><ukm:AffectedProvisions><ukm:Section Ref="section-3" URI="u">s. 3</ukm:Section></ukm:AffectedProvisions>
<ukm:InForce Prospective="true"/><ukm:InForce Date="2001-02-03" Qualification="q"/><ukm:InForce Date="2001-02-03"/></ukm:Effect></content></entry><entry><title>A</title><link rel="alternate" href="/x"/><link rel="self" href="http://h/id/uksi/2001/x7"/></entry></feed>"""
    pages = spark.createDataFrame([("p", bytearray(page)), ("bad", bytearray(b"<"))], "path string, content binary")
    effects, refs = feeds.parse_effects(pages)
    (e,) = effects.collect()
    assert (e["effect_id"], str(e["in_force_date"]), e["qualification"], e["prospective"], e["affected_document_id"], e["more_pages"], e["textual_kind"]) == ("k1", "2001-02-03", "q", False, "ukpga/1971/77", 2, "T")
    (r,) = refs.collect()
    assert (r["side"], r["provision_kind"], r["section_number"]) == ("affected", "section", "3")
    (y,) = [r for r in feeds.parse_year_feed(pages).collect() if r["feed_error"] is None]
    assert (y["legislation_type"], y["year"], y["number"], y["document_id"]) == ("uksi", 2001, 0, "uksi/2001/x7")


def test_files(spark, tmp_path):
    head = ",".join(files.DUTY_COLUMNS)
    (tmp_path / "d.csv").write_text("﻿" + head + '\n1,u,http://www.legislation.gov.uk/id/ukpga/Vict/52-53/39,T,,,,http://www.legislation.gov.uk/id/ukpga/Vict/52-53/39/section/4,a|b,"A ""x""\nB",,,,,Power,do,,,\n', encoding="utf-8")
    (tmp_path / "bad.csv").write_text("a,b\n1,2\n")
    rows, failures = files.read_duties(spark, [str(tmp_path / "d.csv"), str(tmp_path / "bad.csv")])
    from lexloom.operators.entities import staged_duties

    (r,) = staged_duties(rows).collect()
    assert (r["document_id"], r["enactment_type"], r["section_path"], r["provision_number"], r["subsections"], r["modality"]) == ("ukpga/Vict/52-53/39", "ukpga", "section/4", "4", ["a", "b"], "power")
    assert r["actor"] == 'A "x"\nB' and len(failures) == 1
    (tmp_path / "e.jsonl").write_text('{"id": 1, "targets": ["a"], "is_direction_power": true, "instrument": "x"}\nnot json\n{"id": "s"}\n')
    assert [r["id"] for r in files.read_enrichment(spark, str(tmp_path / "e.jsonl")).collect()] == [1]
    raw = spark.createDataFrame([("a/b.md", bytearray(b"text" * 50)), ("c.pdf", bytearray(b"p")), ("../x.md", bytearray(b"n")), ("/y.md", bytearray(b"n"))], "key string, content binary")
    stored = files.put_objects(raw)
    assert sorted(r["key"] for r in stored.collect()) == ["a/b.md.gz", "c.pdf"]
    assert {r["key"]: bytes(r["content"]) for r in files.get_objects(stored).collect()} == {"a/b.md": b"text" * 50, "c.pdf": b"p"}


def test_markdown_to_text_by_cases(spark):
    cases = {
        "---\ntitle: x\n---\n# Head\n\n> quoted *text*": "Head quoted text", "a ```\ncode\n``` b `c` d": "a b c d", "see ![alt](u) and [the act](http://x) now": "see and the act now",
        "#no space": "no space", "  many\t\tspaces\u00a0here ": "many spaces here", "a-b_c~d": "a b c d", "": "", "```open": "open",
    }
    for raw, want in cases.items():
        got = one(spark, t.markdown_to_text(F.lit(raw)))[0]
        assert got.replace("`", "") == want, raw


def test_comparison_text_by_cases(spark):
    cases = {"a  ,b": "a,b", "( x ) .": "( x).", "25A . . .": "25A . . .", "x .y .z": "x.y.z", "end .": "end.", "a . . b": "a . . b", "a\u00a0;b": "a;b", " .x": ".x", "v ]": "v]", "no. 5": "no. 5"}
    for raw, want in cases.items():
        assert one(spark, t.comparison_text(F.lit(raw))) == (want,), raw


def test_ministers_by_cases(spark):
    yes = ("Secretary of State for Transport", "the Minister", "the appropriate Ministers", "Treasury", "the Lords Commissioners of Her Majesty's Treasury", "Lord Chancellor's office", "the Department, in writing", "a Northern Ireland department", "Her Majesty in Council", "Attorney General", "the Minister for Health", "Scottish Ministers acting jointly")
    no = ("person authorised by the Secretary of State", "Departmental officer", "the Treasury Solicitor", "minister's office", "Attorney General's office", "any person", "administrator", "the ministers of religion")
    for name in yes + no:
        assert one(spark, t.is_ministerial(F.lit(name))) == (name in yes,), name


def test_errors_by_cases(spark):
    cases = {"HTTP status 404 for http://x": "HTTP status 404", "Read Timed Out": "timeout", "not legislation XML after HTTP status 200 for u": "non-legislation XML response", "not parseable legislation XML": "unparseable XML response", "connection reset": "connection reset", "Connection reset by peer": "connection reset", "no element found: 1": "empty or malformed XML", "odd": "odd"}
    for raw, want in cases.items():
        assert one(spark, t.error_category(F.lit(raw))) == (want,), raw


def test_printed_dates_by_cases(spark):
    from lexloom.functions import dates

    cases = (("Made - - 28th April 2026", 2026, "2026-04-28"), ("ade\u2013\u2014 1st May, 2001", 2002, "2001-05-01"), ("Made 5 June 2001", 2004, None), ("Made 31st February 2001", 2001, None), ("MADE 5 June 2001", 2001, None), ("Remade 5 June 2001", 2001, None), ("Made by 5 June 2001", None, None), ("x " * 3000 + "Made 5 June 2001", None, None))
    for raw, year, want in cases:
        assert one(spark, dates.printed_date(F.lit(raw), F.lit(year).cast("int")).cast("string")) == (want,), raw[-40:]
    assert one(spark, dates.printed_date(F.lit("x " * 3000 + "Made 5 June 2001"), within=None).cast("string")) == ("2001-06-05",)
