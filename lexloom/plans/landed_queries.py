"""Queries over landed files made from the driver's tables: XML, feeds, archives, reports; and over what they fill."""

from __future__ import annotations

import gzip
import io
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.functions import text as t
from lexloom.operators import coverage, documents, entities, layout, publish, register, runs, search
from lexloom.plans import more_queries as more
from lexloom.plans.adapters import Tables, sql
from lexloom.plans.queries import PLANS, query
from lexloom.session import shared_dir
from lexloom.sources import clml, feeds, files
from lexloom.streaming import poll

ATOM_FEED = '<feed xmlns="http://www.w3.org/2005/Atom" xmlns:leg="http://www.legislation.gov.uk/namespaces/legislation" xmlns:ukm="http://www.legislation.gov.uk/namespaces/metadata" xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:pbl="http://www.legislation.gov.uk/namespaces/publication-log">'


def landed(tb: Tables, name: str, contents: dict[str, bytes]) -> str:
    """A few named files below a folder of their own, written by the driver."""
    root = poll.work_dir(tb.spark, shared_dir(tb.spark), name)
    place = tb.spark._jvm.org.apache.hadoop.fs.Path
    system = place(root).getFileSystem(tb.spark._jsc.hadoopConfiguration())
    for path, data in contents.items():
        out = system.create(place(f"{root}/{path}"), True)
        out.write(data)
        out.close()
    return root


def act(n: str, body: str = "", extra: str = "") -> str:
    return f"""<Legislation xmlns="http://www.legislation.gov.uk/namespaces/legislation" xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:ukm="http://www.legislation.gov.uk/namespaces/metadata" xmlns:atom="http://www.w3.org/2005/Atom" DocumentURI="http://x/{n}"><ukm:Metadata><dc:title>Act {n}</dc:title>{extra}</ukm:Metadata>{body}</Legislation>"""


def xml_of(template: str, key: str) -> Column:
    """``template`` with {n} as the key's value, as bytes."""
    return F.encode(F.replace(F.lit(template), F.lit("{n}"), F.col(key).cast("string")), "UTF-8")


def nations(tb: Tables) -> list[int]:
    return [r["n_nationkey"] for r in tb.read("nation").select("n_nationkey").collect()]  # 25 rows


@query("s1_scan_xml", "select n_nationkey as n, 'Act ' || n_nationkey as title, n_nationkey % 3 = 0 as packed from nation")
def s1(tb: Tables) -> DataFrame:
    contents = {}
    for n in nations(tb):
        data = act(str(n), "<Body><P1group><Title>x</Title></P1group></Body>").encode()
        contents[f"xml/point-in-time/2020-01-01/ukpga/2001/{n}/data.xml" + (".gz" if n % 3 == 0 else "")] = gzip.compress(data) if n % 3 == 0 else data
    found = clml.scan_xml(tb.spark, landed(tb, "xml", contents | {"xml/point-in-time/2020-01-01/ukpga/2001/1/other.txt": b"no"}))
    rendered = clml.clml_to_markdown(found)
    return rendered.select(clml.document_ref(F.col("path")).number.cast("int").alias("n"), t.fallback_title(F.col("markdown"), F.lit("none")).alias("title"), F.col("path").endswith(".gz").alias("packed"))


@query("s2_scan_markdown", "select n_nationkey::varchar as number, case when n_nationkey % 2 = 0 then 'ukpga' else 'uksi' end as legislation_type, length('# N' || n_nationkey)::int as size from nation where n_nationkey % 5 <> 4")
def s2(tb: Tables) -> DataFrame:
    kinds = ("ukpga", "uksi", "asp")
    root = landed(tb, "markdown", {f"markdown/enacted/{'asp' if n % 5 == 4 else kinds[n % 2]}/2001/{n}.md": f"# N{n}".encode() for n in nations(tb)})
    return files.scan_markdown(tb.spark, root, ["ukpga", "uksi"]).select("ref.number", "ref.legislation_type", F.length("markdown").alias("size"))


def customer_pages(tb: Tables) -> DataFrame:
    """(path, content): year lists of a nation's customers on seven pages, each page naming the next; every fourth nation's list ends after two."""
    own = tb.read("customer").withColumn("page", (F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey")) - 1) % 7)
    entry = F.concat(F.lit("<entry><title>"), F.regexp_replace("c_name", "[&<]", ""), F.lit('</title><link rel="self" href="http://x/id/ukpga/'), (F.col("c_nationkey") + 1990).cast("string"), F.lit("/"), F.col("c_custkey").cast("string"), F.lit('"/></entry>'))
    pages = own.groupBy("c_nationkey", "page").agg(F.array_join(F.array_sort(F.collect_list(entry)), "").alias("entries"))
    follows = (F.col("page") < 6) & ~((F.col("c_nationkey") % 4 == 0) & (F.col("page") == 1))
    link = F.when(follows, F.concat(F.lit('<link rel="next" href="p/'), F.col("c_nationkey").cast("string"), F.lit("/"), (F.col("page") + 1).cast("string"), F.lit('"/>'))).otherwise("")
    return pages.select(F.concat(F.lit("p/"), F.col("c_nationkey").cast("string"), F.lit("/"), F.col("page").cast("string")).alias("path"), F.encode(F.concat(F.lit(ATOM_FEED), link, "entries", F.lit("</feed>")), "UTF-8").alias("content"))


@query("s4_year_feed", "select 'ukpga' as legislation_type, (1990 + c_nationkey)::int as year, c_custkey::int as number, c_name as title, 'ukpga/' || (1990 + c_nationkey) || '/' || c_custkey as document_id from customer")
def s4(tb: Tables) -> DataFrame:
    return feeds.parse_year_feed(customer_pages(tb)).select("legislation_type", "year", "number", "title", "document_id")


@query("s5_followed_pages", "select c_nationkey as nation, count(*)::bigint as documents from (select *, (row_number() over (partition by c_nationkey order by c_custkey) - 1) % 7 as page from customer) where not (c_nationkey % 4 = 0 and page > 1) group by 1")
def s5(tb: Tables) -> DataFrame:
    pages = customer_pages(tb)
    starts = tb.read("nation").select(F.concat(F.lit("p/"), F.col("n_nationkey").cast("string"), F.lit("/0")).alias("path"))
    rows = feeds.parse_year_feed(feeds.followed(pages, starts))
    return rows.groupBy((F.col("year") - 1990).alias("nation")).agg(F.count(F.lit(1)).alias("documents"))


@query("s6_number_ranges", """with y as (select r_name as legislation_type, (2000 + r_regionkey)::int as year, case when r_regionkey % 2 = 0 then 436 else 200 end as status, (r_regionkey * 130 + 20)::int as highest from region)
  select legislation_type, year, g::int as first, least(g + 99, highest)::int as last from (select *, unnest(generate_series(1, highest, 100)) as g from y where status = 436) union all select legislation_type, year, 1, null from y where status <> 436""")
def s6(tb: Tables) -> DataFrame:
    years = tb.read("region").selectExpr("r_name as legislation_type", "cast(2000 + r_regionkey as int) as year", "case when r_regionkey % 2 = 0 then 436 else 200 end as status", "cast(r_regionkey * 130 + 20 as int) as highest")
    return feeds.range_plan(years)


EFFECT_XML = (
    '<ukm:Effect EffectId="e{k}" Type="{kind}" Applied="{applied}" RequiresApplied="true" Modified="2020" URI="u" AffectedURI="http://x/id/ukpga/1990/{c}" AffectedProvisions="all" AffectingURI="http://x/id/uksi/2001/{k}" AffectingProvisions="">'
    '<ukm:AffectedTitle>T {c}</ukm:AffectedTitle><ukm:AffectedProvisions><ukm:Section Ref="section-{c}A" URI="s">s. {c}A</ukm:Section><ukm:SectionRange Ref="" URI="r">Sch. {c} para. 2</ukm:SectionRange></ukm:AffectedProvisions>'
    '<ukm:InForceDates><ukm:InForce Date="{date}" Qualification="wholly in force"/><ukm:InForce Prospective="true"/></ukm:InForceDates></ukm:Effect>'
)
EFFECT_KINDS = ("substituted", "coming into force", "applied", "")


def effect_pages(tb: Tables) -> DataFrame:
    """A page of effects for each customer, an effect for each order; every fifth has no date."""
    k = F.col("o_orderkey")
    xml = F.lit(EFFECT_XML)
    for name, value in (("{kind}", F.element_at(F.array(*map(F.lit, EFFECT_KINDS)), (k % 4 + 1).cast("int"))), ("{applied}", F.when(k % 3 == 0, "true").otherwise("false")), ("{date}", F.when(k % 5 == 0, "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))), ("{c}", F.col("o_custkey").cast("string")), ("{k}", k.cast("string"))):
        xml = F.replace(xml, F.lit(name), value)
    pages = tb.read("orders").select("o_custkey", xml.alias("x")).groupBy("o_custkey").agg(F.array_join(F.collect_list("x"), "").alias("x"))
    return pages.select(F.concat(F.lit("e/"), F.col("o_custkey").cast("string")).alias("path"), F.encode(F.concat(F.lit(ATOM_FEED), F.lit("<leg:morePages>2</leg:morePages>"), "x", F.lit("</feed>")), "UTF-8").alias("content"))


@query("s7_effects", """select 'e' || o_orderkey as effect_id, case o_orderkey % 4 when 0 then 'T' when 1 then 'CO' when 2 then 'NT' else 'UN' end as textual_kind, o_orderkey % 3 = 0 as applied, o_orderkey % 5 = 0 as prospective,
  case when o_orderkey % 5 > 0 then o_orderdate::date::varchar end as in_force_date, 'ukpga/1990/' || o_custkey as affected_document_id, 'uksi/2001/' || o_orderkey as affecting_document_id, 2::int as more_pages from orders""")
def s7(tb: Tables) -> DataFrame:
    found = feeds.parse_effects(effect_pages(tb))[0]
    return found.select("effect_id", "textual_kind", "applied", "prospective", F.col("in_force_date").cast("string").alias("in_force_date"), "affected_document_id", "affecting_document_id", "more_pages")


@query("s7_effect_refs", """select 'e' || o_orderkey as effect_id, 'affected' as side, unnest(['section', 'schedule']) as provision_kind, unnest([o_custkey || 'A', o_custkey::varchar]) as section_number from orders""")
def s7_refs(tb: Tables) -> DataFrame:
    return feeds.parse_effects(effect_pages(tb))[1].select("effect_id", "side", "provision_kind", "section_number")


@query("s8_publication_log", """select 'ukpga/2001/' || event_id as document_id, 'ukpga' as legislation_type, strftime(ts, '%Y-%m-%d') as updated, event_id % 2 = 0 as is_new, event_id % 3 = 0 as is_republished from events where event_type <> 'error'""")
def s8(tb: Tables) -> DataFrame:
    k = F.col("event_id")
    entry = F.concat(
        F.lit("<entry><dc:identifier>http://x/id/ukpga/2001/"), k.cast("string"), F.lit("</dc:identifier><title>t</title><updated>"), F.date_format("ts", "yyyy-MM-dd"), F.lit("</updated><pbl:ContentType>"),
        F.when(F.col("event_type") == "error", "notice").otherwise("legislation"), F.lit("</pbl:ContentType><pbl:New>"), F.when(k % 2 == 0, "true").otherwise("false"), F.lit("</pbl:New><pbl:Republished>"), F.when(k % 3 == 0, "true").otherwise("false"), F.lit("</pbl:Republished></entry>"),
    )
    pages = tb.read("events").select("user_id", entry.alias("x")).groupBy("user_id").agg(F.array_join(F.collect_list("x"), "").alias("x"))
    rows = feeds.parse_publication_log(pages.select(F.col("user_id").cast("string").alias("path"), F.encode(F.concat(F.lit(ATOM_FEED), "x", F.lit("</feed>")), "UTF-8").alias("content")))
    return rows.select("document_id", "legislation_type", "updated", "is_new", "is_republished")


@query("s12_still_to_fetch", "select c_custkey::varchar as path from customer where c_custkey % 4 <> 0 or c_custkey % 3 = 0")
def s12(tb: Tables) -> DataFrame:
    c, k = tb.read("customer"), F.col("c_custkey")
    path = k.cast("string").alias("path")
    broken = F.when(k % 9 == 0, F.lit("")).when(k % 9 == 3, "<html/>").otherwise("<Legislation")
    content = F.when(k % 3 == 0, F.encode(broken, "UTF-8")).otherwise(xml_of(act("{n}"), "c_custkey"))
    return clml.still_to_fetch(c.select(path), c.where("c_custkey % 4 = 0").select(path, content.alias("content")))


@query("s13_duties_csv", "select 'd' || s_suppkey as duty_uri, 'says \"' || s_name || '\", twice' as action, case when s_suppkey % 2 = 0 then 'x' else '' end as actor from supplier")
def s13(tb: Tables) -> DataFrame:
    root = poll.work_dir(tb.spark, shared_dir(tb.spark), "duties")
    empty = {c: F.lit("") for c in files.DUTY_COLUMNS}
    s = tb.read("supplier")
    own = empty | {"duty_uri": F.concat(F.lit("d"), F.col("s_suppkey").cast("string")), "action": F.concat(F.lit('says "'), "s_name", F.lit('", twice')), "actor": F.when(F.col("s_suppkey") % 2 == 0, "x").otherwise("")}
    options = {"header": True, "escape": '"', "quoteAll": True, "emptyValue": ""}
    s.where("s_suppkey % 3 > 0").select(*[own[c].alias(c) for c in files.DUTY_COLUMNS]).write.options(**options).csv(f"{root}/a")
    s.where("s_suppkey % 3 = 0").select(*[own[c].alias(c) for c in reversed(files.DUTY_COLUMNS)]).write.options(**options).csv(f"{root}/b")
    s.select(F.lit("x").alias("duty_uri")).write.options(**options).csv(f"{root}/short")
    place = tb.spark._jvm.org.apache.hadoop.fs.Path
    system = place(root).getFileSystem(tb.spark._jsc.hadoopConfiguration())
    paths = [f.getPath().toString() for d in ("a", "b", "short") for f in system.listStatus(place(f"{root}/{d}")) if f.getPath().getName().endswith(".csv")]
    rows, failures = files.read_duties(tb.spark, paths)
    if not failures:
        raise ValueError("a file without the columns must be a failure")
    return rows.select("duty_uri", "action", "actor")


@query("s14_unzipped", "select c_custkey::varchar as path, case when c_custkey % 7 > 0 then 'b/' || c_custkey || '.xml' end as member, case when c_custkey % 7 > 0 then 'ukpga/2001/' || c_custkey end as document_id, c_custkey % 7 = 0 as broken from customer")
def s14(tb: Tables) -> DataFrame:
    @F.pandas_udf(T.BinaryType())
    def packed(keys: pd.Series) -> pd.Series:
        out = []
        for k in keys:
            held = io.BytesIO()
            with zipfile.ZipFile(held, "w") as z:
                z.writestr(f"b/{k}.xml", f'<Legislation DocumentURI="http://x/id/ukpga/2001/{k}"/>')
                z.writestr("a.txt", "no")
            out.append(held.getvalue() if k % 7 else held.getvalue()[:20])
        return pd.Series(out)

    rows = files.unzip(tb.read("customer").select(F.col("c_custkey").cast("string").alias("path"), packed("c_custkey").alias("content")))
    return rows.select("path", "member", F.nullif("document_id", F.lit("")).alias("document_id"), F.col("error").isNotNull().alias("broken"))


@query("s15_enrichment_lines", "select p_partkey as id, lower(p_type) as instrument, len([p_name])::int as targets from part where p_partkey % 5 <> 0")
def s15(tb: Tables) -> DataFrame:
    root = poll.work_dir(tb.spark, shared_dir(tb.spark), "lines")
    line = F.to_json(F.struct(F.col("p_partkey").alias("id"), F.array("p_name").alias("targets"), F.lit(True).alias("is_direction_power"), F.lower("p_type").alias("instrument")))
    bad = F.when(F.col("p_partkey") % 10 == 0, '{"id": "word"}').otherwise("{broken")
    tb.read("part").select(F.when(F.col("p_partkey") % 5 == 0, bad).otherwise(line).alias("value")).write.text(f"{root}/rows")
    return files.read_enrichment(tb.spark, f"{root}/rows").select("id", "instrument", F.size("targets").alias("targets"))


@query("s16_fetch_reports", "select r_name as legislation_type, stage, category, count(*)::bigint as n from (select r_name, unnest(['fetch', 'fetch', 'parse']) as stage, unnest(['timeout', 'HTTP status 404', 'empty or malformed XML']) as category from region) group by all")
def s16(tb: Tables) -> DataFrame:
    root = poll.work_dir(tb.spark, shared_dir(tb.spark), "reports")
    failure = lambda stage, error: F.struct(F.lit(stage).alias("stage"), F.col("r_name").alias("legislation_type"), F.lit(error).alias("error"))
    own = F.array(failure("fetch", "Read timed out"), failure("fetch", "HTTP status 404 for http://x"), failure("parse", "no element found: 1"))
    files.write_report(tb.read("region").select(F.lit("point-in-time").alias("mode"), F.col("r_name").alias("legislation_type"), F.array(F.lit("a"), F.lit("b")).alias("fetched"), own.alias("failures")), root)
    rows = coverage.failures_of(files.read_report(tb.spark, root))
    return rows.groupBy("legislation_type", "stage", "category").agg(F.count(F.lit(1)).alias("n"))


@query("s17_version_links", "select c_custkey::varchar as path, unnest(['2001-02-03', '2010-01-0' || (c_custkey % 9 + 1)]) as date from customer where c_custkey % 11 > 0")
def s17(tb: Tables) -> DataFrame:
    link = lambda d: f'<atom:link rel="http://purl.org/dc/terms/hasVersion" title="{d}" href="h"/>'
    xml = act("{n}", extra=link("2001-02-03") + link("2010-01-0{d}") + link("2001-02-03") + link("enacted") + '<atom:link rel="self" title="2020-01-01" href="h"/>')
    named = F.replace(F.replace(F.lit(xml), F.lit("{n}"), F.col("c_custkey").cast("string")), F.lit("{d}"), (F.col("c_custkey") % 9 + 1).cast("string"))
    content = F.when(F.col("c_custkey") % 11 == 0, F.encode(F.lit("<broken"), "UTF-8")).otherwise(F.encode(named, "UTF-8"))
    return clml.version_links(tb.read("customer").select(F.col("c_custkey").cast("string").alias("path"), content.alias("content")))


@query("s18_act_list", "select 'ukpga/2001/' || s_suppkey as document_path from supplier where s_suppkey % 3 > 0")
def s18(tb: Tables) -> DataFrame:
    root = poll.work_dir(tb.spark, shared_dir(tb.spark), "acts")
    own = F.concat(F.lit("  ukpga/2001/"), F.col("s_suppkey").cast("string"), F.lit("  # "), "s_name")
    tb.read("supplier").select(F.when(F.col("s_suppkey") % 3 > 0, own).otherwise(F.concat(F.lit("# "), "s_name")).alias("value")).write.text(f"{root}/rows")
    return files.act_list(tb.spark, f"{root}/rows")


@query("x4_commentaries", """select c_custkey, sha256('---' || chr(10) || 'title: "Act ' || c_custkey || '"' || chr(10) || 'document_uri: "http://x/' || c_custkey || '"' || chr(10) || '---' || chr(10) || chr(10) || '# Act ' || c_custkey || chr(10) || chr(10) || '## 1 Head' || chr(10) || chr(10)
  || '> Commentary: Note on ' || c_custkey || '.' || chr(10) || chr(10) || 'Text.' || chr(10)) as markdown_sha256 from customer""")
def x4(tb: Tables) -> DataFrame:
    body = '<Body><P1group><Title>Head</Title><P1><Pnumber><CommentaryRef Ref="c1"/><CommentaryRef Ref="gone"/>1</Pnumber><P1para><Text>Text.</Text></P1para></P1></P1group></Body><Commentaries><Commentary id="c1"><Para><Text>Note on {n} .</Text></Para></Commentary></Commentaries>'
    rendered = clml.clml_to_markdown(tb.read("customer").select(F.col("c_custkey").cast("string").alias("path"), xml_of(act("{n}", body), "c_custkey").alias("content")))
    return rendered.select(F.col("path").cast("long").alias("c_custkey"), F.sha2("markdown", 256).alias("markdown_sha256"))


@query("f10_in_force", "select c_custkey, ['2 Kept ' || c_custkey, 'SCHEDULE 1 Still'] as headings from customer")
def f10(tb: Tables) -> DataFrame:
    group = lambda n, title, match: f'<P1group{match}><Title>{title}</Title><P1><Pnumber>{n}</Pnumber><P1para><Text>t</Text></P1para></P1></P1group>'
    schedule = lambda n, title, match: f"<Schedule{match}><Number>SCHEDULE {n}</Number><TitleBlock><Title>{title}</Title></TitleBlock><ScheduleBody><P><Text>x</Text></P></ScheduleBody></Schedule>"
    off = ' Match="false"'
    body = f"<Body>{group(1, 'Gone {n}', off)}{group(2, 'Kept {n}', '')}</Body><Schedules>{schedule(1, 'Still', '')}{schedule(2, 'Gone', off)}</Schedules>"
    rendered = clml.clml_to_markdown(tb.read("customer").select(F.col("c_custkey").cast("string").alias("path"), xml_of(act("{n}", body), "c_custkey").alias("content")))
    return rendered.select(F.col("path").cast("long").alias("c_custkey"), F.expr(r"regexp_extract_all(markdown, '(?m)^## (.*)$', 1)").alias("headings"))


@query("t32_pretty_xml", "select c_custkey, '<?xml version=''1.0'' encoding=''utf-8''?>' || chr(10) || '<a>' || chr(10) || '  <b n=\"' || c_custkey || '\">x</b>' || chr(10) || '  <c />' || chr(10) || '</a>' as xml from customer")
def t32(tb: Tables) -> DataFrame:
    raw = tb.read("customer").select("c_custkey", xml_of('<a><b n="{n}">x</b>\n\n<c/></a>', "c_custkey").alias("content"))
    return clml.pretty(raw).select("c_custkey", F.decode("content", "UTF-8").alias("xml"))


# --- text -----------------------------------------------------------------------------------------


@query("t26_display_body", "select doc_id, sha256(chr(10) || '# H' || chr(10) || text) as body from documents where text is not null")
def t26(tb: Tables) -> DataFrame:
    front = F.concat(F.lit("---\ntitle: \"x\"\npdf_alternatives:\n  - \"u\"\n---\n\n# H\n"), "text")
    return tb.read("documents").where("text is not null").select("doc_id", F.sha2(t.body_of(front), 256).alias("body"))


@query("t27_ocr_lines", "select c_custkey, 'An Acte for ' || c_name || ' within the present Parliament, with Groundes' as line from customer")
def t27(tb: Tables) -> DataFrame:
    return tb.read("customer").select("c_custkey", layout.cleaned(F.concat(F.lit("Can  Ax Acre for "), "c_name", F.lit(' w"in the pent Parliam’, w* Groundfs wy'))).alias("line"))


@query("t28_line_roles", r"""select doc_id, count(*) filter (where c = 'noise')::bigint as noise, count(*) filter (where c = 'heading')::bigint as headings, count(*) filter (where c = 'text')::bigint as texts from (select doc_id, case
  when l = '' or regexp_full_match(l, '[^\p{L}\p{N}\p{M}]+') or (length(l) <= 3 and not regexp_full_match(l, '[\p{L}\p{N}]+')) then 'noise' when length(l) <= 80 and regexp_matches(l, '[A-Za-z]') and regexp_replace(l, '[^A-Za-z]', '', 'g') = upper(regexp_replace(l, '[^A-Za-z]', '', 'g')) then 'heading' else 'text' end as c
  from (select doc_id, unnest(string_split(text, chr(10))) as l from documents where text is not null)) group by doc_id""")
def t28(tb: Tables) -> DataFrame:
    lines = tb.read("documents").where("text is not null").select("doc_id", F.explode(F.split("text", "\n")).alias("l")).withColumn("c", layout.line_class("l"))
    return lines.groupBy("doc_id").agg(F.count_if(F.col("c") == "noise").alias("noise"), F.count_if(F.col("c") == "heading").alias("headings"), F.count_if(F.col("c") == "text").alias("texts"))


@query("t29_safe_stems", "select page_id, 'a-b-' || page_id || '-' || substr(sha256('http://x/y/a b&' || page_id || '.pdf?q=1'), 1, 12) as stem from pages")
def t29(tb: Tables) -> DataFrame:
    return tb.read("pages").select("page_id", t.safe_stem(F.concat(F.lit("http://x/y/a b&"), F.col("page_id").cast("string"), F.lit(".pdf?q=1"))).alias("stem"))


@query("w10_group_totals", sql("""select coalesce(g, 'all') as "group", n::bigint as document_count from (select case when legislation_type = 'en' then 'main' else 'other' end as g, count(*) as n from m_docs where legislation_type in ('en', 'de', 'fr', 'es') group by rollup(case when legislation_type = 'en' then 'main' else 'other' end))""", "m_docs"))
def w10(tb: Tables) -> DataFrame:
    return documents.timeline_totals(documents.timeline(documents.corpus_summary(tb.documents()), {"main": ["en"], "other": ["de", "fr", "es"]}, 1980, 2030))


# --- search ---------------------------------------------------------------------------------------


def _phrases_sql(plan: search.Plan) -> str:
    w = search.WEIGHTS
    phrases = [" ".join(x.lower().replace("#", " ").split()) for x in (*plan.terms, *plan.targets)]
    hits = " + ".join(f"contains(spaced, ' {p} ')::int" for p in phrases)
    any_of = lambda c: "(" + " or ".join(f"{c} ilike '%{p}%'" for p in plan.targets) + ")"
    pattern = "|".join(plan.domain)
    return sql(f"""with own as (select *, ' ' || array_to_string(list_filter(regexp_split_to_array(lower(concat_ws(' ', action, condition)), '[^a-z0-9]+'), lambda x: x <> ''), ' ') || ' ' as spaced from m_duties where modality in ('power', 'both')),
      ranked as (select *, ({hits}) * {search.SCALE} // {len(phrases)} as text_rank from own),
      hits as (select duty_id from m_targets where {any_of("target_text")} union select duty_id from m_targets join m_entities using (entity_id) where {any_of("name")}
        union select t.duty_id from m_targets t join m_duties d using (duty_id) join m_members m on m.class_id = t.entity_id and m.document_id = d.document_id join m_entities e on e.entity_id = m.entity_id where {any_of("e.name")})
      select duty_id, (text_rank + case when hit then {w['target']} else 0 end + case when instrument in ('economy', 'direct') then {w['instrument']} else 0 end + case when is_direction_power then {w['direction']} else 0 end
        + case when regexp_matches(enactment_title, '{pattern}', 'i') then {w['title']} else 0 end + case when regexp_matches(action, '{pattern}', 'i') then {w['action']} else 0 end)::bigint as score
      from (select *, duty_id in (select duty_id from hits) as hit from ranked) join m_enrichments using (duty_id) where text_rank > 0 or hit order by score desc, duty_id limit {plan.limit}""", "m_duties", "m_enrichments", "m_entities", "m_targets", "m_members")


PHRASES = search.Plan(terms=["economy ring", "blue"], targets=["Supplier#000000007"], instruments=["economy", "direct"], domain=["ring", "blue"], limit=100)


@query("p3_search_by_phrases", _phrases_sql(PHRASES))
def p3(tb: Tables) -> DataFrame:
    return search.search_by_phrases(PHRASES, tb.duties(), tb.enrichments(), tb.targets(), tb.entities(), tb.members(), ministerial_only=False).select("duty_id", "score")


@query("p1_search_all_candidates", PLANS and sql("""with own as (select *, list_filter(regexp_split_to_array(lower(concat_ws(' ', action, condition)), '[^a-z0-9]+'), lambda x: x <> '') as tok from m_duties)
  select duty_id, 10000::bigint as score from own join m_enrichments using (duty_id) where list_contains(tok, 'promo') order by duty_id limit 100""", "m_duties", "m_enrichments"))
def p1_all(tb: Tables) -> DataFrame:
    plan = search.Plan(terms=["promo"], modality="both", limit=100, candidates=None)
    return search.search_powers(plan, tb.duties(), tb.enrichments(), tb.targets(), tb.entities(), tb.members()).select("duty_id", "score")


# --- publishing -----------------------------------------------------------------------------------


def published_rows(tb: Tables) -> DataFrame:
    """What a first publication of all documents makes of each, with the keys of its objects."""
    spark = tb.spark
    rows = tb.read("documents").where("text is not null").selectExpr("doc_id as publish_seq", "source as document_id", "case when doc_id % 5 = 0 then 'enacted' else 'point_in_time' end as version_kind", "case when doc_id % 5 = 0 then null else date_add(date'2000-01-01', cast(doc_id % 50 as int)) end as snapshot_date", "sha2(text, 256) as source_sha256", "text as markdown")
    versions = spark.createDataFrame([], "version_id string, document_id string, version_kind string, canonical_sha256 string, source_sha256 string, markdown_sha256 string, publish_seq long")
    made = publish.assign_versions(versions, publish.prepared(rows))
    key = lambda end: F.concat(F.lit("k/"), F.col("publish_seq").cast("string"), F.lit(end))
    return made.select(
        "publish_seq", "document_id", "version_id", "created", "source_sha256", "markdown_sha256", F.lit(None).cast("string").alias("source_uri"), key(".md").alias("markdown_key"),
        F.when(F.col("publish_seq") % 2 == 0, key(".xml")).alias("source_key"), F.when(F.col("publish_seq") % 3 == 0, F.array(F.lit("http://p/1.pdf"), F.lit("http://p/2.pdf"))).alias("pdf_alternatives"),
    )


@query("k6_observations", f"with {more.BATCH_SQL} select 'r1' as run_id, document_id, status, count(*)::bigint as n from (select h.document_id, case when f.n = 1 then 'fetched' else 'not_modified' end as status from h join firsts f using (publish_seq)) group by all")
def k6(tb: Tables) -> DataFrame:
    rows = runs.observations(published_rows(tb), "r1")
    return rows.groupBy("run_id", "document_id", "status").agg(F.count(F.lit(1)).alias("n"))


@query("b1_published_files", f"""with {more.BATCH_SQL}, f as (select document_id, version_id, 'markdown' as file_kind, 'k/' || publish_seq || '.md' as object_key, null as source_url from named union all select document_id, version_id, 'clml_xml', 'k/' || publish_seq || '.xml', null from named where publish_seq % 2 = 0
  union all select document_id, version_id, 'pdf', null, unnest(['http://p/1.pdf', 'http://p/2.pdf']) from named where publish_seq % 3 = 0) select distinct document_id, version_id, file_kind, object_key, source_url, file_kind <> 'pdf' as is_canonical from f""")
def b1_files(tb: Tables) -> DataFrame:
    empty = tb.spark.createDataFrame([], "document_id string, version_id string, file_kind string, object_key string, sha256 string, source_url string, is_canonical boolean")
    return runs.published_files(empty, published_rows(tb)).select("document_id", "version_id", "file_kind", "object_key", "source_url", "is_canonical")


@query("b1_published_objects", f"with {more.BATCH_SQL} select 'k/' || publish_seq || '.md' as key, sha as sha256 from h union all select 'k/' || publish_seq || '.xml', sha from h where publish_seq % 2 = 0")
def b1_objects(tb: Tables) -> DataFrame:
    return runs.published_objects(tb.spark.createDataFrame([], "key string, sha256 string, source_url string"), published_rows(tb)).select("key", "sha256")


@query("k7_load_order", sql("select d.id, case when d.doc_id % 4 > 0 then latest_version_id end as latest_version_id from m_docs d", "m_docs"))
def k7(tb: Tables) -> DataFrame:
    root = poll.work_dir(tb.spark, shared_dir(tb.spark), "load")
    tables = {"versions": tb.latest_versions().where("doc_id % 4 > 0").select("version_id"), "documents": tb.documents().select("id", "latest_version_id")}
    order = runs.load_in_order(tables, lambda name, df: df.write.mode("overwrite").parquet(f"{root}/{name}"))
    if order != ["documents", "versions", "documents"]:
        raise ValueError("parents come first, pointers last")
    return tb.spark.read.parquet(f"{root}/documents")


@query("b5_rerendered", "select doc_id, case doc_id % 4 when 0 then 'missing' when 1 then 'failed' when 2 then 'still' else 'recovered' end as outcome, case when doc_id % 4 = 3 then 'Act ' || doc_id end as title from documents where doc_id % 3 > 0")
def b5(tb: Tables) -> DataFrame:
    k = F.col("doc_id")
    name = k.cast("string")
    d = tb.read("documents").select("doc_id", name.alias("id"))
    versions = d.select(F.concat(F.lit("v"), "id").alias("version_id"), F.col("id").alias("document_id"), F.lit("enacted").alias("version_kind"), (k % 3 > 0).alias("is_metadata_only"))
    docs = d.select("id", F.concat(F.lit("v"), "id").alias("latest_version_id"))
    sources = d.select(F.concat(F.lit("v"), "id").alias("version_id"), F.lit("clml_xml").alias("file_kind"), F.concat("id", F.lit(".xml")).alias("object_key"))
    content = F.when(k % 4 == 1, F.encode(F.lit("<broken"), "UTF-8")).when(k % 4 == 2, xml_of(act("{n}"), "doc_id")).otherwise(xml_of(act("{n}", "<Body><P1group><Title>x</Title><P1><Pnumber>1</Pnumber><P1para><Text>t</Text></P1para></P1></P1group></Body>"), "doc_id"))
    objects = d.where("doc_id % 4 > 0").select(F.concat("id", F.lit(".xml")).alias("key"), content.alias("content"))
    rows = runs.rerender_metadata_only(versions, docs, sources, objects)[0]
    return rows.select(F.col("document_id").cast("long").alias("doc_id"), "outcome", t.fallback_title(F.col("markdown"), F.lit(None).cast("string")).alias("title"))


@query("b6_compression_report", "select count(*)::bigint as scanned, count(*) filter (where doc_id % 5 = 1 and text is not null)::bigint as other_kinds, count(*) filter (where text is null)::bigint as missing, count(*) filter (where doc_id % 5 <> 1 and text is not null)::bigint as compressed, 0::bigint as failed, coalesce(sum(octet_length(encode(text))) filter (where doc_id % 5 <> 1), 0)::bigint as bytes_before from documents where doc_id % 5 > 0")
def b6(tb: Tables) -> DataFrame:
    k = F.col("doc_id") % 5
    key = F.concat(F.lit("o/"), F.col("doc_id").cast("string"), F.when(k == 0, ".md.gz").when(k == 1, ".pdf").otherwise(".xml"))
    return runs.compress_objects(tb.read("documents").select(key.alias("key"), F.encode("text", "UTF-8").alias("content")))[2].drop("bytes_after")


# --- dictionary -----------------------------------------------------------------------------------


def dictionary_of(tb: Tables) -> register.Dictionary:
    s, k = tb.read("supplier"), F.col("s_suppkey")
    slug = lambda n: F.concat(F.lit("s"), F.lpad(n.cast("string"), 9, "0"))
    own = s.select(
        slug(k).alias("slug"), F.col("s_name").alias("title"), F.lit("agency").alias("format"), F.lit("live").alias("status"), F.when(k % 4 == 0, "changed_name").alias("closed_status"), F.lit(None).cast("string").alias("closed_at"),
        F.when(k % 2 == 0, F.concat(F.lit(" AB"), k.cast("string"))).otherwise(F.when(k % 3 == 0, F.concat(F.lit("The "), "s_name"))).alias("abbreviation"),
        F.array(slug(k + 1), slug(k + 2)).alias("parents"), F.when(k % 4 == 0, F.array(slug(k + 1))).otherwise(F.array().cast("array<string>")).alias("successors"),
    )
    second = tb.read("customer").selectExpr("concat('m', c_custkey) as id", "case when c_custkey % 2 = 0 then replace(c_name, 'Customer', 'Supplier') else c_name end as name", "case when c_custkey % 3 = 0 then 'official' else 'organ' end as category", "'x' as subtype")
    uris = s.select(F.concat(F.lit("http://u/"), k.cast("string")).alias("body_uri"), F.concat(F.lit("The "), "s_name").alias("body_name"))
    manual = s.where("s_suppkey % 5 = 0").select(slug(k).alias("slug"), F.concat(F.lit("Office "), k.cast("string")).alias("alias"), F.lit("statutory").alias("alias_kind"))
    return register.dictionary(own, second, uris, manual)


DICTIONARY_SQL = """s as (select s_suppkey as k, s_name as name, (select min(s_suppkey) from supplier) as lo, (select max(s_suppkey) from supplier) as hi from supplier),
c as (select 'm' || c_custkey as id, case when c_custkey % 2 = 0 then replace(c_name, 'Customer', 'Supplier') else c_name end as name, c_custkey as ck from customer)"""


@query("b9_dictionary", f"""with {DICTIONARY_SQL} select name, 'body' as kind, case when k + 1 <= hi then (select name from s p where p.k = s.k + 1) end as parent, case when k % 4 = 0 and k + 1 <= hi then (select name from s p where p.k = s.k + 1) end as successor, (select min(id) from c where c.name = s.name) as second_id, 'http://u/' || k as legislation_uri from s
  union all select name, case when ck % 3 = 0 then 'office' else 'body' end, null, null, id, null from c where name not in (select name from s)""")
def b9(tb: Tables) -> DataFrame:
    e = dictionary_of(tb).entities
    names = e.select("entity_id", "name")
    parents, successors = names.withColumnsRenamed({"entity_id": "parent_id", "name": "parent"}), names.withColumnsRenamed({"entity_id": "successor_id", "name": "successor"})
    return e.join(parents, "parent_id", "left").join(successors, "successor_id", "left").select("name", "kind", "parent", "successor", "second_id", "legislation_uri")


@query("b9_dictionary_aliases", f"""with {DICTIONARY_SQL} select name, 'AB' || k as alias, 'abbreviation' as alias_kind from s where k % 2 = 0 union all select (select name from s p where p.k = s.k + 1), name, 'former_name' from s where k % 4 = 0 and k + 1 <= hi union all select name, 'Office ' || k, 'statutory' from s where k % 5 = 0""")
def b9_aliases(tb: Tables) -> DataFrame:
    book = dictionary_of(tb)
    return book.aliases.join(book.entities.select("entity_id", "name"), "entity_id").select("name", "alias", "alias_kind")


def class_book(tb: Tables) -> DataFrame:
    own = tb.read("supplier").selectExpr("s_suppkey as entity_id", "case when s_suppkey = 3 then 'Regulator' when s_suppkey = 5 then 'National Energy System Operator' else s_name end as name", "'body' as kind")
    return register.with_classes(register.shaped(own, register.ENTITY))


CLASS_VALUES = ", ".join(f"('{x}')" for x in register.CLASS_TERMS)


@query("b10_class_terms", f"select x as name from (values {CLASS_VALUES}) v(x) where x <> 'regulator' or not exists (select 1 from supplier where s_suppkey = 3)")
def b10_terms(tb: Tables) -> DataFrame:
    return class_book(tb).where("kind = 'class'").select("name")


@query("b10_resolved_targets", f"select p_partkey as duty_id, case p_partkey % 3 when 0 then 'licensee' when 1 then 'Regulator' else 'nobody' end as target_text, case when p_partkey % 3 = 0 and p_partkey % 2 = 0 then 'class' when p_partkey % 2 = 0 then 'none' else 'own' end as found from part")
def b10_targets(tb: Tables) -> DataFrame:
    e = class_book(tb)
    k = F.col("p_partkey")
    rows = tb.read("part").select(k.alias("duty_id"), F.when(k % 3 == 0, "licensee").when(k % 3 == 1, "Regulator").otherwise("nobody").alias("target_text"), F.when(k % 2 == 1, 1).cast("long").alias("entity_id"), F.when(k % 2 == 0, "unresolved").otherwise("exact").alias("resolution"))
    found = register.resolve_to_classes(rows, e).join(e.where("kind = 'class'").select("entity_id", F.lit(True).alias("c")), "entity_id", "left")
    return found.select("duty_id", "target_text", F.when(F.col("c"), "class").when(F.col("resolution") == "unresolved", "none").otherwise("own").alias("found"))


@query("b10_memberships", "select 'National Energy System Operator' as member, unnest(['licence holder', 'system operator', 'licence holder']) as class, unnest(['ukpga/1989/29', 'ukpga/1989/29', 'ukpga/2023/52']) as document_id from supplier where s_suppkey = 5")
def b10_members(tb: Tables) -> DataFrame:
    e = class_book(tb)
    rows = tb.spark.createDataFrame(list(register.MEMBERSHIPS), "member_name string, class_name string, document_id string")
    m = register.memberships(e, rows)
    return m.join(e.select("entity_id", F.col("name").alias("member")), "entity_id").join(e.select(F.col("entity_id").alias("class_id"), F.col("name").alias("class")), "class_id").select("member", "class", "document_id")


DECISION = "case c_custkey % 6 when 0 then 'match' when 1 then 'class' when 2 then 'office' when 3 then 'none' when 4 then 'match' else 'odd' end"


@query("b11_decision_counts", f"select case when d = 'match' and c_custkey % 6 = 4 then 'invalid' when d = 'odd' then 'invalid' else d end as outcome, count(*)::bigint as n from (select c_custkey, {DECISION} as d from customer) group by 1")
def b11_counts(tb: Tables) -> DataFrame:
    return decided(tb)[1].withColumnRenamed("n", "n")


@query("b11_new_names", "select c_name as name, case c_custkey % 6 when 0 then 'actor_name' when 1 then 'class' else 'office' end as kind from customer where c_custkey % 6 in (0, 1, 2)")
def b11_names(tb: Tables) -> DataFrame:
    book = decided(tb)[0]
    made = book.entities.where("kind in ('class', 'office')").select("name", "kind")
    return made.unionByName(book.aliases.select(F.col("alias").alias("name"), F.col("alias_kind").alias("kind")))


def decided(tb: Tables) -> tuple[register.Dictionary, DataFrame]:
    book = register.Dictionary(register.shaped(tb.entities().withColumn("kind", F.lit("body")), register.ENTITY), tb.spark.createDataFrame([], register.ALIAS))
    known = tb.read("supplier").agg(F.min("s_suppkey").alias("m")).first()["m"]
    rows = tb.read("customer").select(F.col("c_name").alias("name"), F.expr(DECISION).alias("decision"), F.when(F.col("c_custkey") % 6 == 0, F.lit(known)).otherwise(F.lit(-1)).cast("long").alias("entity_id"))
    return register.apply_links(rows, book)


# --- coverage -------------------------------------------------------------------------------------


@query("a12_coverage_counters", """with x as (select case when page_id % 2 = 0 then 'en' else 'fr' end as t, page_id % 6 as c from pages), y as (select t, count(*) as n, count(*) filter (where c in (0, 1, 5)) as v, count(*) filter (where c in (1, 5)) as m, count(*) filter (where c = 0) as f, count(*) filter (where c = 5) as p, count(*) filter (where c = 2) as e, count(*) filter (where c = 3) as b, count(*) filter (where c = 4) as o from x group by t),
  z as (select lang as t, count(*) as md from documents group by 1), q as (select event_type as t, count(*) filter (where event_id % 2 = 0) as ff, count(*) filter (where event_id % 2 = 1) as cf from events group by 1),
  j as (select t, n, v, m, f, p, e, b, o, md, ff, cf from y full join z using (t) full join q using (t))
  select case when grouping(t) = 1 then 'all' else t end as legislation_type, coalesce(sum(n), 0)::bigint as xml_files, coalesce(sum(v), 0)::bigint as valid_legislation_xml, coalesce(sum(m), 0)::bigint as metadata_only_xml, coalesce(sum(f), 0)::bigint as full_text_xml, coalesce(sum(p), 0)::bigint as pdf_linked_xml,
  coalesce(sum(e), 0)::bigint as empty_xml, coalesce(sum(b), 0)::bigint as malformed_xml, coalesce(sum(o), 0)::bigint as non_legislation_xml, coalesce(sum(md), 0)::bigint as markdown_files, 0::bigint as fetched, coalesce(sum(ff), 0)::bigint as fetch_failures, coalesce(sum(cf), 0)::bigint as convert_failures from j group by rollup(t)""")
def a12(tb: Tables) -> DataFrame:
    k = F.col("page_id") % 6
    pdf = act("{n}", extra='<atom:link type="application/pdf" href="http://p.pdf"/>')
    content = F.when(k == 0, xml_of(act("{n}", "<Body/>"), "page_id")).when(k == 1, xml_of(act("{n}"), "page_id")).when(k == 2, F.encode(F.lit(""), "UTF-8")).when(k == 3, F.encode(F.lit("<a>"), "UTF-8")).when(k == 4, F.encode(F.lit("<html/>"), "UTF-8")).otherwise(xml_of(pdf, "page_id"))
    own = tb.read("pages").select(F.when(F.col("page_id") % 2 == 0, "en").otherwise("fr").alias("legislation_type"), content.alias("content"))
    failures = tb.read("events").select(F.col("event_type").alias("legislation_type"), F.when(F.col("event_id") % 2 == 0, "fetch").otherwise("convert").alias("stage"))
    none = tb.spark.createDataFrame([], "legislation_type string, path string")
    return coverage.coverage_counters(own, tb.read("documents").selectExpr("lang as legislation_type"), none, failures)


QUEUE_SQL = """f as (select doc_id as file_id, 'v' || doc_id as version_id, 'http://p/' || doc_id as source_url, doc_id % 6 as c, doc_id from documents), d as (select doc_id, lang || '/' || doc_id as document_id, case when doc_id % 9 > 0 then (1990 + doc_id % 20)::int end as calendar_year, lang, doc_id % 2 = 0 as is_metadata_only from documents)"""


def queue_tables(tb: Tables) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    k = F.col("doc_id")
    d = tb.read("documents").select("doc_id", F.concat_ws("/", "lang", k.cast("string")).alias("document_id"), "lang")
    version, url = F.concat(F.lit("v"), k.cast("string")).alias("version_id"), F.concat(F.lit("http://p/"), k.cast("string")).alias("source_url")
    file = lambda rows, kind, key: rows.select(k.alias("file_id"), version, url, F.lit(kind).alias("file_kind"), F.concat(F.lit(key), k.cast("string")).alias("object_key"), (k % 7 == 0).alias("is_canonical"))
    own = file(d, "pdf", "pdf/").unionByName(file(d.where("doc_id % 6 = 1"), "extracted_text", "x/")).unionByName(file(d, "report", coverage.REPORTS)).unionByName(file(d.where("doc_id % 6 = 3"), "markdown", coverage.RENDERED)).unionByName(file(d.where("doc_id % 6 = 4"), "markdown", "markdown/enacted/"))
    versions = d.select(version, "document_id", (k % 2 == 0).alias("is_metadata_only"), F.when(k % 2 == 0, F.lit("2020-01-01")).cast("date").alias("snapshot_date"))
    docs = d.select(F.col("document_id").alias("id"), F.when(k % 9 > 0, 1990 + k % 20).cast("int").alias("calendar_year"), F.col("lang").alias("legislation_type"))
    return own, versions, docs, d.select(k.alias("file_id"), F.when(k % 6 == 2, 3).otherwise(1).alias("attempts"))


@query("b15_parse_queue", f"with {QUEUE_SQL} select file_id, document_id from f join d using (doc_id) where c not in (1, 2) and lang = 'en' order by is_metadata_only desc, calendar_year nulls first, document_id, source_url limit 50")
def b15_queue(tb: Tables) -> DataFrame:
    own, versions, docs, failed = queue_tables(tb)
    return coverage.parse_queue(own, versions, docs, failed, legislation_type="en", only_metadata=False, limit=50).select("file_id", "document_id")


@query("b15_markdown_queue", f"with {QUEUE_SQL} select file_id, document_id from f join d using (doc_id) where c <> 3")
def b15_markdown(tb: Tables) -> DataFrame:
    own, versions, docs, _ = queue_tables(tb)
    return coverage.markdown_queue(own, versions, docs).select("file_id", "document_id")


@query("b15_document_pdf", f"with {QUEUE_SQL} select file_id from f where doc_id = (select min(doc_id) from documents where lang = 'en' and doc_id % 2 = 0)")
def b15_one(tb: Tables) -> DataFrame:
    own, versions, _, _ = queue_tables(tb)
    first = tb.read("documents").where("lang = 'en' and doc_id % 2 = 0").agg(F.min("doc_id").alias("m")).first()["m"]
    return coverage.document_pdf(own, versions, f"en/{first}", "2020-01-01").select("file_id")


@query("d1_unplausible_dates", "select o_orderkey, case when o_orderkey % 3 = 0 then null else o_orderdate::date::varchar end as date from orders")
def d1_years(tb: Tables) -> DataFrame:
    from lexloom.functions import dates

    xml = F.concat(F.lit('<Made Date="'), F.col("o_orderdate").cast("date").cast("string"), F.lit('"/><EnactmentDate Date="1900-01-01"/>'))
    year = F.year("o_orderdate") + F.when(F.col("o_orderkey") % 3 == 0, 3).when(F.col("o_orderkey") % 3 == 1, 2)
    return tb.read("orders").select("o_orderkey", dates.legal_date(xml, year).date.cast("string").alias("date"))


@query("b7_staged_duties", f"with {more.DUTY_SQL} select 'd' || (l_orderkey % 3000) as duty_uri, count(*)::bigint as n, count(*) filter (where l_linenumber > 2)::bigint as with_parts from lineitem group by 1")
def b7_staged(tb: Tables) -> DataFrame:
    return entities.staged_duties(more.raw_duties(tb)).groupBy("duty_uri").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.size("subsections") == 2).alias("with_parts"))
