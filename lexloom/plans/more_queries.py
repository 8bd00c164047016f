"""Queries over the driver's tables: text, publishing, duties and entities, coverage, layouts, streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.functions import dates, text as t
from lexloom.operators import coverage, entities, keyed, layout, publish
from lexloom.plans.adapters import Tables, sql
from lexloom.plans.queries import query
from lexloom.session import shared_dir
from lexloom.sources import clml, feeds, files
from lexloom.streaming import poll

# --- text -----------------------------------------------------------------------------------------

MD = "concat('---\\ntitle: \"T', doc_id, '\"\\nstatus: Current\\n---\\n# Head ', doc_id, '\\n\\n## ', case when doc_id % 4 = 0 then 'SCHEDULE ' else '' end, doc_id % 40 + 1, 'A *Part* (E+W)\\n', replace(text, '\\n', '\\n## 7 '))"
MD_SQL = r"""md as (select doc_id, lang, source, text, '---' || chr(10) || 'title: "T' || doc_id || '"' || chr(10) || 'status: Current' || chr(10) || '---' || chr(10) || '# Head ' || doc_id || chr(10) || chr(10) || '## ' || case when doc_id % 4 = 0 then 'SCHEDULE ' else '' end
  || (doc_id % 40 + 1) || 'A *Part* (E+W)' || chr(10) || replace(text, chr(10), chr(10) || '## 7 ') as markdown from documents where text is not null)"""
PROVS_SQL = rf"""{MD_SQL}, bodies as (select *, regexp_replace(markdown, '(?s)\A---\n.*?\n---\n', '') as body from md),
parts as (select doc_id, unnest(list_filter(string_split(chr(10) || body, chr(10) || '## '), lambda x, i: i > 1)) as part, generate_subscripts(list_filter(string_split(chr(10) || body, chr(10) || '## '), lambda x, i: i > 1), 1) as ordinal from bodies),
heads as (select doc_id, ordinal, part, trim(split_part(part, chr(10), 1)) as heading, trim('## ' || part, ' ' || chr(10)) as markdown from parts where trim(part, ' ' || chr(10)) <> ''),
provs as (select doc_id, row_number() over (partition by doc_id order by ordinal)::int as ordinal, heading, markdown, coalesce(nullif(regexp_extract(heading, '(?i)^SCHEDULES?\.?\s+([A-Z]?\d+[A-Z]?)\b', 1), ''), nullif(regexp_extract(heading, '^([A-Za-z]?\d+[A-Za-z]?|\([^)]+\))\b', 1), '')) as number from heads)"""


def markdown_docs(tb: Tables) -> DataFrame:
    return tb.read("documents").where("text is not null").selectExpr("doc_id", "lang", "source", "text", f"{MD} as markdown")


def provisions_of(tb: Tables) -> DataFrame:
    return publish.split_provisions(markdown_docs(tb).select("doc_id", t.body_of(F.col("markdown")).alias("body")))


@query("t5_split_provisions", f"with {PROVS_SQL} select doc_id, ordinal, heading, number, sha256(markdown) as text_sha256 from provs")
def t5(tb: Tables) -> DataFrame:
    return provisions_of(tb).select("doc_id", "ordinal", "heading", "number", "text_sha256")


@query("t6_t9_heading_fields", rf"""with {PROVS_SQL} select doc_id, ordinal, number, case when lower(heading) like 'schedule%' then 'schedule' when number is not null then 'section' else 'document' end as provision_type,
  nullif(trim(regexp_extract(heading, '\s+\(([EWSNI.+ ]+)\)$', 1)), '') as extent, coalesce(nullif(left(regexp_replace(regexp_replace(lower(heading), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 120), ''), 'provision-' || ordinal) as anchor from provs""")
def t6(tb: Tables) -> DataFrame:
    return provisions_of(tb).select("doc_id", "ordinal", "number", "provision_type", "extent", "anchor")


def plain_sql(column: str) -> str:
    """Words of Markdown: what is fenced or an image goes, code and links stay as text, marks and spaces part words."""
    unfenced = f"regexp_replace(regexp_replace({column}, '(?s)\\A---\\n.*?\\n---\\n', ''), '(?s)```.*?```', ' ', 'g')"
    shown = f"regexp_replace(replace({unfenced}, '`', ''), '!\\[[^\\]]*\\]\\([^)]+\\)', ' ', 'g')"
    linked = f"regexp_replace({shown}, '\\[([^\\]]+)\\]\\([^)]+\\)', '\\1', 'g')"
    return f"array_to_string(list_filter(regexp_split_to_array({linked}, '[*_~#>[:space:]-]+'), lambda w: w <> ''), ' ')"


@query("t10_markdown_to_text", f"with {MD_SQL} select doc_id, sha256({plain_sql('markdown')}) as plain from md")
def t10(tb: Tables) -> DataFrame:
    return markdown_docs(tb).select("doc_id", F.sha2(t.markdown_to_text(F.col("markdown")), 256).alias("plain"))


@query("t11_word_count", r"select doc_id, len(regexp_extract_all(text, '[\p{L}\p{M}\p{Nd}_]+'))::bigint as words from documents where text is not null")
def t11(tb: Tables) -> DataFrame:
    return tb.read("documents").where("text is not null").select("doc_id", t.word_count(F.col("text")).alias("words"))


@query("t2_t3_hashes", r"""select page_id, sha256(url || html) as raw, sha256(regexp_replace('see https://www.legislation.gov.uk/ukpga/' || page_id || '/2020-01-02/x and ' || url, '(https?://(?:www\.)?legislation\.gov\.uk/ukpga/[0-9]+)/\d{4}-\d{2}-\d{2}/', '\1/')) as canonical from pages""")
def t2(tb: Tables) -> DataFrame:
    linked = F.concat(F.lit("see https://www.legislation.gov.uk/ukpga/"), F.col("page_id").cast("string"), F.lit("/2020-01-02/x and "), "url")
    return tb.read("pages").select("page_id", t.content_sha256(F.concat("url", "html")).alias("raw"), t.canonical_sha256(linked).alias("canonical"))


@query("t1_control_characters", "select doc_id, 'a' || case doc_id % 4 when 0 then 'EUR' when 1 then '...' when 2 then '''' else ' per mille ' end || 'b-' as fixed from documents")
def t1(tb: Tables) -> DataFrame:
    raw = F.concat(F.lit("a"), F.element_at(F.array(F.lit("\x80"), F.lit("\x85"), F.lit("\x92"), F.lit("\x89")), (F.col("doc_id") % 4 + 1).cast("int")), F.lit("b\x96"))
    return tb.read("documents").select("doc_id", t.normalize_markdown(raw).alias("fixed"))


@query("t4_frontmatter", f"with {MD_SQL} select doc_id, 'T' || doc_id as title, 'Current' as status, 'Head ' || doc_id as first_title from md")
def t4(tb: Tables) -> DataFrame:
    md = F.col("markdown")
    return markdown_docs(tb).select("doc_id", t.frontmatter_value(md, "title").alias("title"), t.frontmatter_value(md, "status").alias("status"), t.fallback_title(md, F.lit("none")).alias("first_title"))


#: White space of Unicode, as a class.
SPACES = r"[\s\x0B\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
#: A full stop takes the space before it along; where one match takes a letter that the next one needs, a second pass finds it.
FULL_STOP = r"([^. ]) \.([^. ]| [^.]| $|$)"
COMPARED = rf"regexp_replace(regexp_replace(text, '{SPACES}+', ' ', 'g'), ' ([,;:)\]])', '\1', 'g')"


@query("t12_comparison_text", rf"select doc_id, sha256(trim(regexp_replace(regexp_replace({COMPARED}, '{FULL_STOP}', '\1.\2', 'g'), '{FULL_STOP}', '\1.\2', 'g'))) as compared from documents where text is not null")
def t12(tb: Tables) -> DataFrame:
    return tb.read("documents").where("text is not null").select("doc_id", F.sha2(t.comparison_text(F.col("text")), 256).alias("compared"))


KINDS = ("substituted", "Commencement", "coming into force", "applied (with modifications)", "see", " ", "construed as one with", "inserted")


@query("t16_textual_kind", "select event_id, case event_id % 8 when 0 then 'T' when 1 then 'CO' when 2 then 'CO' when 3 then 'NT' when 4 then 'NT' when 5 then 'UN' when 6 then 'NT' else 'T' end as kind from events")
def t16(tb: Tables) -> DataFrame:
    kind = F.element_at(F.array(*map(F.lit, KINDS)), (F.col("event_id") % 8 + 1).cast("int"))
    return tb.read("events").select("event_id", t.textual_kind(kind).alias("kind"))


@query("t17_provision_ref", """select event_id, case event_id % 4 when 0 then 'section' when 1 then 'schedule' when 2 then 'regulation' end as kind, case when event_id % 4 < 3 then (event_id % 90)::varchar || case when event_id % 4 = 0 then 'A' else '' end end as number from events""")
def t17(tb: Tables) -> DataFrame:
    n = F.col("event_id") % 90
    ref = F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("section-"), n.cast("string"), F.lit("A-4")))
    label = F.element_at(F.array(F.lit("x"), F.concat(F.lit("Sch. "), n.cast("string"), F.lit(" para. 2")), F.concat(F.lit("regs. "), n.cast("string")), F.lit("Pt. IV")), (F.col("event_id") % 4 + 1).cast("int"))
    return tb.read("events").select("event_id", t.provision_ref(ref, label).alias("p")).select("event_id", "p.kind", "p.number")


@query("t18_duty_addresses", """select page_id, case when page_id % 3 < 2 then 'ukpga/1990/' || page_id end as document_id, case page_id % 3 when 0 then 'section/' || (page_id % 50) || 'A/2' when 1 then 'other/1990/1/schedule/paragraph/3' else 'x/' || page_id end as section_path,
  case page_id % 3 when 0 then 'section' when 1 then 'other' else 'x' end as kind, case page_id % 3 when 0 then (page_id % 50) || 'A' when 1 then '1990' else page_id::varchar end as number from pages""")
def t18(tb: Tables) -> DataFrame:
    p = F.col("page_id")
    enactment = F.when(p % 3 < 2, F.concat(F.lit(t.ID_PREFIX + "ukpga/1990/"), p.cast("string"), F.lit("/"))).otherwise("http://elsewhere/")
    section = F.when(p % 3 == 0, F.concat(F.lit(t.ID_PREFIX + "ukpga/1990/"), p.cast("string"), F.lit("/section/"), (p % 50).cast("string"), F.lit("A/2"))).when(p % 3 == 1, t.ID_PREFIX + "other/1990/1/schedule/paragraph/3").otherwise(F.concat(F.lit("x/"), p.cast("string")))
    rows = tb.read("pages").select("page_id", t.document_id_of(enactment).alias("document_id"), t.section_path(section, enactment).alias("section_path"))
    return rows.withColumn("p", t.path_provision(F.col("section_path"))).select("page_id", "document_id", "section_path", "p.kind", "p.number")


@query("t19_t20_normalisers", """select c_custkey, case c_custkey % 4 when 0 then 'power' when 1 then 'both' when 2 then 'unknown' else 'duty' end as modality, case c_custkey % 3 when 0 then 'explicit' when 1 then 'implicit' end as inference,
  case when c_custkey % 2 = 0 then 'the ' else '' end || lower(replace(c_name, '#', '')) as name from customer""")
def t19(tb: Tables) -> DataFrame:
    k = F.col("c_custkey")
    raw = F.element_at(F.array(F.lit(" Power"), F.lit("duty|power"), F.lit("Missing"), F.lit("DUTY")), (k % 4 + 1).cast("int"))
    inf = F.element_at(F.array(F.lit("Explicit "), F.lit("implicit"), F.lit("n/a")), (k % 3 + 1).cast("int"))
    name = F.concat(F.when(k % 2 == 0, "HM The ").otherwise("The "), "c_name")
    return tb.read("customer").select("c_custkey", t.modality(raw).alias("modality"), t.enum_or_null(inf, ("explicit", "implicit")).alias("inference"), t.match_name(name).alias("name"))


@query("t24_t25_labels", """select o_orderkey, year(o_orderdate) || case when o_orderkey % 2 = 0 then ' c. ' else ' No. ' end || o_orderkey as citation, case o_orderkey % 4 when 0 then 'England, Wales and Scotland' when 1 then 'Northern Ireland' when 2 then null else 'England and Wales' end as extent,
  case when o_orderstatus = 'F' then 'Royal Assent ' else 'Made ' end || strftime(o_orderdate, '%-d %B %Y') as legal_date, case when o_orderkey % 3 = 0 then 'PDF-backed' when o_orderkey % 3 = 1 then 'Full text, ' || format('{:,}', o_orderkey + 1000) || ' words' end as coverage from orders""")
def t24(tb: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    extent = F.element_at(F.array(F.lit("E+W+S"), F.lit("N.I."), F.lit("E+X"), F.lit("E + W")), (k % 4 + 1).cast("int"))
    return tb.read("orders").select(
        "o_orderkey", t.citation(F.year("o_orderdate"), k, k % 2 == 0).alias("citation"), t.extent_in_words(extent).alias("extent"),
        t.legal_date_label(F.col("o_orderdate").cast("date"), F.when(F.col("o_orderstatus") == "F", "enacted")).alias("legal_date"), t.coverage_label(F.when(k % 3 == 0, True).when(k % 3 == 1, False), k + 1000).alias("coverage"),
    )


@query("t29_object_keys", "select doc_id, 'xml/enacted/' || lang || '/' || doc_id || '/data.xml' as xml_key, 'markdown/point-in-time/2020-02-0' || (doc_id % 9 + 1) || '/' || lang || '/' || doc_id || '.md' as markdown_key, substr(sha256(source), 1, 12) as digest from documents")
def t29(tb: Tables) -> DataFrame:
    path = F.concat_ws("/", "lang", F.col("doc_id").cast("string"))
    date = F.concat(F.lit("2020-02-0"), (F.col("doc_id") % 9 + 1).cast("string"))
    return tb.read("documents").select("doc_id", t.object_key("xml", F.lit("enacted"), path, date).alias("xml_key"), t.object_key("markdown", F.lit("point-in-time"), path, date).alias("markdown_key"), F.substring(F.sha2("source", 256), 1, 12).alias("digest"))


@query("t30_error_categories", """select k as category, count(*)::bigint as n from (select case event_id % 6 when 0 then 'non-legislation XML response' when 1 then 'HTTP status 404' when 2 then 'timeout' when 3 then 'connection reset' when 4 then 'empty or malformed XML' else 'odd ' || event_type end as k from events) group by 1""")
def t30(tb: Tables) -> DataFrame:
    k = F.col("event_id") % 6
    message = F.when(k == 0, "not legislation XML here").when(k == 1, F.concat(F.lit("HTTP status 404 for http://x/"), F.col("event_id").cast("string"))).when(k == 2, "Read TIMED OUT").when(k == 3, "Connection reset by peer").when(k == 4, "no element found: 1").otherwise(F.concat(F.lit("odd "), "event_type"))
    return tb.read("events").groupBy(t.error_category(message).alias("category")).agg(F.count(F.lit(1)).alias("n"))


@query("t31_decoded_paths", "select page_id, case when page_id % 2 = 0 then 'a b/' || page_id else '100%zz/' || page_id end as path from pages")
def t31(tb: Tables) -> DataFrame:
    raw = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("/a%20b/"), F.col("page_id").cast("string"), F.lit("/"))).otherwise(F.concat(F.lit("100%zz/"), F.col("page_id").cast("string")))
    return tb.read("pages").select("page_id", t.decoded_path(raw).alias("path"))


@query("f11_ministerial_actors", """select c_custkey, case c_custkey % 6 when 0 then true when 1 then false when 2 then true when 3 then false when 4 then true else false end as ministerial from customer""")
def f11(tb: Tables) -> DataFrame:
    names = ("The Secretary of State", "person authorised by the Secretary of State", "any Ministers", "Departmental officer", "Lord Chancellor", "minister's office")
    return tb.read("customer").select("c_custkey", t.is_ministerial(F.element_at(F.array(*map(F.lit, names)), (F.col("c_custkey") % 6 + 1).cast("int"))).alias("ministerial"))


@query("r1_split_lists", "select doc_id, case when doc_id % 5 = 0 then null else 'a,' || source end as parts from documents")
def r1(tb: Tables) -> DataFrame:
    raw = F.when(F.col("doc_id") % 5 == 0, "||").otherwise(F.concat(F.lit("a||"), "source", F.lit("|")))
    return tb.read("documents").select("doc_id", F.array_join(t.split_list(raw), ",").alias("parts"))


@query("n1_json_items", "select event_id, json_extract_string(props, '$.k')::bigint as k from events")
def n1(tb: Tables) -> DataFrame:
    return tb.read("events").select("event_id", F.from_json("props", "k long").getField("k").alias("k"))


# --- dates ----------------------------------------------------------------------------------------


@query("d1_legal_dates", """select o_orderkey, case when o_orderkey % 4 < 3 then o_orderdate::date::varchar end as date, case when o_orderkey % 4 = 3 then null when o_orderkey % 2 = 0 then 'made' else 'enacted' end as kind from orders""")
def d1(tb: Tables) -> DataFrame:
    xml = F.concat(F.lit("<x><"), F.when(F.col("o_orderkey") % 2 == 0, "Made").otherwise("ukm:EnactmentDate"), F.lit(' a="1" Date="'), F.col("o_orderdate").cast("date").cast("string"), F.lit('"/></x>'))
    year = F.year("o_orderdate") + F.when(F.col("o_orderkey") % 4 == 3, 5).otherwise(1)
    return tb.read("orders").select("o_orderkey", dates.legal_date(xml, year).alias("d")).select("o_orderkey", F.col("d.date").cast("string").alias("date"), "d.kind")


@query("d2_printed_dates", """select o_orderkey, case when o_orderkey % 7 in (0, 5) then null else o_orderdate::date::varchar end as date from orders""")
def d2(tb: Tables) -> DataFrame:
    # A day that does not exist, a clipped word, dashes, a comma, a year that is not the document's, a date beyond the preamble.
    day, k = F.concat(F.date_format("o_orderdate", "d"), F.lit("th "), F.date_format("o_orderdate", "MMMM")), F.col("o_orderkey") % 7
    year = F.date_format("o_orderdate", "yyyy")
    printed = (
        F.when(k == 0, "Made 31st February 2001").when(k == 1, F.concat(F.lit("ade - - - "), day, F.lit(", "), year)).when(k == 2, F.concat(F.lit("Made \u2013 \u2014 "), day, F.lit(" "), year))
        .when(k == 3, F.concat(F.lit("made"), F.lit("......"), day, F.lit("  "), year)).when(k == 5, F.concat(F.repeat(F.lit("x "), F.lit(3000)), F.lit("Made "), day, F.lit(" "), year))
        .otherwise(F.concat(F.lit("Made "), day, F.lit("\n"), year))
    )
    own = F.year("o_orderdate") + F.when(k == 4, 2).otherwise(-1)
    return tb.read("orders").select("o_orderkey", dates.printed_date(F.concat(F.lit("STATUTORY\n"), printed, F.lit("\nLaid")), own).cast("string").alias("date"))


@query("d3_date_ranges", "select o_orderkey, unnest(generate_series(o_orderdate::date, o_orderdate::date + 2, interval 1 day))::date::varchar as day from orders")
def d3(tb: Tables) -> DataFrame:
    d = F.col("o_orderdate").cast("date")
    days = tb.read("orders").select("o_orderkey", F.explode(F.sequence(d, F.date_add(d, 2))).alias("day"))
    return days.withColumn("day", F.col("day").cast("string"))


@query("d4_timestamps", "select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') as ts from events")
def d4(tb: Tables) -> DataFrame:
    return tb.read("events").select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ts"))


@query("w5_earliest_in_force", """select o_orderkey, arg_min(l_linenumber, (l_shipdate, l_partkey)) filter (where l_linestatus = 'F') as line, min(l_shipdate::date) filter (where l_linestatus = 'F')::varchar as date, count(*) filter (where l_linestatus = 'F') = 0 as prospective
  from lineitem join orders on l_orderkey = o_orderkey group by o_orderkey""")
def w5(tb: Tables) -> DataFrame:
    rows = tb.read("lineitem").join(tb.read("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    first = F.min(F.when(F.col("l_linestatus") == "F", F.struct("l_shipdate", "l_partkey", "l_linenumber")))
    return rows.groupBy("o_orderkey").agg(first.alias("f")).select("o_orderkey", F.col("f.l_linenumber").alias("line"), F.col("f.l_shipdate").cast("date").cast("string").alias("date"), F.col("f").isNull().alias("prospective"))


@query("w6_empty_runs", """with y as (select l_partkey as p, year(l_shipdate) as y, count(*) as n from lineitem group by all), g as (select p, y, n, y - row_number() over (partition by p order by y) as island from y where n < 4)
  select p::varchar as legislation_type, min(y)::int as first_year, max(y)::int as last_year, count(*)::bigint as years from g group by p, island""")
def w6(tb: Tables) -> DataFrame:
    n = tb.read("lineitem").groupBy(F.col("l_partkey").cast("string").alias("legislation_type"), F.year("l_shipdate").alias("year")).agg(F.count(F.lit(1)).alias("c"))
    return coverage.empty_runs(n.withColumn("n", F.when(F.col("c") < 4, 0).otherwise(F.col("c"))))


# --- publishing -----------------------------------------------------------------------------------

BATCH_SQL = r"""b as (select doc_id as publish_seq, source as document_id, case when doc_id % 5 = 0 then 'enacted' else 'point_in_time' end as version_kind, case when doc_id % 5 = 0 then null else date '2000-01-01' + (doc_id % 50)::int end as snapshot_date, text as markdown from documents where text is not null),
h as (select *, sha256(markdown) as sha, case when version_kind = 'enacted' then 'enacted:' || document_id else 'point-in-time:' || snapshot_date || ':' || document_id end as preferred from b),
firsts as (select *, row_number() over (partition by document_id, version_kind, sha order by publish_seq) as n from h),
made as (select *, case when row_number() over (partition by preferred order by publish_seq) = 1 then preferred else preferred || ':' || substr(sha, 1, 12) end as version_id from firsts where n = 1),
named as (select h.publish_seq, h.document_id, m.version_id from h join made m using (document_id, version_kind, sha))"""


def published(tb: Tables) -> publish.State:
    spark = tb.spark
    rows = tb.read("documents").where("text is not null").selectExpr("doc_id as publish_seq", "source as document_id", "case when doc_id % 5 = 0 then 'enacted' else 'point_in_time' end as version_kind", "case when doc_id % 5 = 0 then null else date_add(date'2000-01-01', cast(doc_id % 50 as int)) end as snapshot_date", "sha2(text, 256) as source_sha256", "text as markdown")
    empty = lambda schema: spark.createDataFrame([], schema)
    state = publish.State(
        empty("document_id string, title string, latest_version_id string"),
        empty("version_id string, document_id string, version_kind string, snapshot_date date, source_sha256 string, markdown_sha256 string, canonical_sha256 string, publish_seq long, word_count long, is_metadata_only boolean"),
        empty("version_id string, document_id string, ordinal int, provision_type string, number string, heading string, anchor string, extent string, text_sha256 string"),
        empty("text_sha256 string, markdown string, plain_text string"),
    )
    half = rows.agg(F.max("publish_seq").alias("m")).first()["m"] // 2
    return publish.publish(publish.publish(state, rows.where(F.col("publish_seq") <= half)), rows.where(F.col("publish_seq") > half))


@query("b1_published_versions", f"with {BATCH_SQL} select version_id, document_id, version_kind, snapshot_date::varchar as snapshot_date, sha as markdown_sha256, publish_seq from made")
def b1(tb: Tables) -> DataFrame:
    return published(tb).versions.select("version_id", "document_id", "version_kind", F.col("snapshot_date").cast("string").alias("snapshot_date"), "markdown_sha256", "publish_seq")


@query("b1_latest_versions", f"with {BATCH_SQL} select document_id, arg_max(version_id, publish_seq) as latest_version_id from named group by document_id")
def b1_latest(tb: Tables) -> DataFrame:
    return published(tb).documents.select("document_id", "latest_version_id")


@query("b1_provision_texts", rf"with {BATCH_SQL} select distinct sha256(regexp_replace(markdown, '\A\s+|\s+\z', '', 'g')) as text_sha256 from made")
def b1_texts(tb: Tables) -> DataFrame:
    return published(tb).texts.select("text_sha256")


DUP_SQL = "v as (select doc_id as publish_seq, doc_id::varchar as version_id, source as document_id, sha256(text) as c, case when doc_id % 4 = 0 then null else date '2010-01-01' + (doc_id % 300)::int end as d from documents where text is not null), k as (select *, first_value(version_id) over (partition by document_id, c order by d nulls last, publish_seq, version_id) as keeper_id, count(*) over (partition by document_id, c) as n from v)"


def dup_versions(tb: Tables) -> DataFrame:
    return tb.read("documents").where("text is not null").selectExpr("doc_id as publish_seq", "cast(doc_id as string) as version_id", "source as document_id", "'current' as version_kind", "sha2(text, 256) as canonical_sha256", "case when doc_id % 4 = 0 then null else date_add(date'2010-01-01', cast(doc_id % 300 as int)) end as snapshot_date")


@query("a7_duplicate_versions", f"with {DUP_SQL} select version_id, keeper_id, n from k where n > 1")
def a7(tb: Tables) -> DataFrame:
    return publish.duplicate_map(dup_versions(tb))


@query("b3_merged_files", f"""with {DUP_SQL}, f as (select doc_id as file_id, doc_id::varchar as version_id, 'pdf' as file_kind, lang as source_url, null::varchar as object_key from documents where text is not null union all select doc_id + 10000000, doc_id::varchar, 'markdown', null, source from documents where text is not null and doc_id % 3 = 0),
  m as (select f.*, coalesce(k.keeper_id, f.version_id) as vid, k.keeper_id is null or k.keeper_id = f.version_id as own from f left join k on k.version_id = f.version_id and k.n > 1),
  r as (select *, row_number() over (partition by vid, file_kind, coalesce(source_url, ''), coalesce(object_key, '') order by own desc, version_id, file_id) as n from m) select file_id, vid as version_id, file_kind, source_url, object_key from r where n = 1""")
def b3(tb: Tables) -> DataFrame:
    d = tb.read("documents").where("text is not null")
    own = d.selectExpr("doc_id as file_id", "cast(doc_id as string) as version_id", "'pdf' as file_kind", "lang as source_url", "cast(null as string) as object_key").unionByName(d.where("doc_id % 3 = 0").selectExpr("doc_id + 10000000 as file_id", "cast(doc_id as string) as version_id", "'markdown' as file_kind", "cast(null as string) as source_url", "source as object_key"))
    v = dup_versions(tb)
    docs = v.groupBy("document_id").agg(F.max("version_id").alias("latest_version_id"))
    return publish.merge_duplicates(docs, v, v.select("version_id", "document_id"), own)[3]


@query("b3_latest_after_merge", f"with {DUP_SQL} select l.document_id, coalesce(k.keeper_id, l.x) as latest_version_id from (select document_id, max(version_id) as x from v group by document_id) l left join k on k.version_id = l.x and k.n > 1")
def b3_latest(tb: Tables) -> DataFrame:
    v = dup_versions(tb)
    docs = v.groupBy("document_id").agg(F.max("version_id").alias("latest_version_id"))
    empty = tb.spark.createDataFrame([], "file_id long, version_id string, file_kind string, source_url string, object_key string")
    return publish.merge_duplicates(docs, v, v.select("version_id", "document_id"), empty)[0].select("document_id", "latest_version_id")


@query("b2_backfilled_hashes", "select doc_id, sha256(text) as canonical_sha256 from documents where text is not null")
def b2(tb: Tables) -> DataFrame:
    d = tb.read("documents").where("text is not null")
    v = d.selectExpr("doc_id", "cast(doc_id as string) as version_id", "case when doc_id % 2 = 0 then sha2(text, 256) end as canonical_sha256")
    return publish.backfill_canonical(v, d.selectExpr("cast(doc_id as string) as version_id", "text as markdown")).select("doc_id", "canonical_sha256")


@query("b4_rerender_outcomes", """with v as (select doc_id, source as document_id, sha256(text) as old, case when doc_id % 3 = 0 then sha256(text) when doc_id % 3 = 1 then sha256(text || '!') else (select sha256(text) from documents where doc_id = 0) end as new from documents where text is not null)
  select doc_id::varchar as version_id, case when old = new then 'unchanged' when exists (select 1 from v w where w.document_id = v.document_id and w.old = v.new) then 'conflict' else 'updated' end as outcome from v""")
def b4(tb: Tables) -> DataFrame:
    d = tb.read("documents").where("text is not null")
    v = d.selectExpr("cast(doc_id as string) as version_id", "source as document_id", "'current' as version_kind", "'x' as source_sha256", "sha2(text, 256) as markdown_sha256")
    zero = F.lit(next((r["text"] for r in d.where("doc_id = 0").select("text").head(1)), None)).cast("string")
    new = d.select(F.col("doc_id").cast("string").alias("version_id"), F.when(F.col("doc_id") % 3 == 0, F.col("text")).when(F.col("doc_id") % 3 == 1, F.concat("text", F.lit("!"))).otherwise(zero).alias("markdown"))
    return publish.rerender(v, new).select("version_id", "outcome")


@query("b6_j12_rekeyed", "select doc_id, case when doc_id % 2 = 0 then source || '.gz' else source || '/' || doc_id end as object_key from documents")
def b6(tb: Tables) -> DataFrame:
    d = tb.read("documents").selectExpr("doc_id", "case when doc_id % 2 = 0 then source else concat(source, '/', doc_id) end as object_key")
    mapping = tb.read("documents").selectExpr("source as old_key", "concat(source, '.gz') as new_key").distinct()
    return publish.rekey(d, mapping, "object_key").select("doc_id", "object_key")


@query("b12_missing_versions", """select document_id, date::varchar as date from (select *, row_number() over (partition by document_id order by date desc) as n from (select distinct l_partkey as document_id, l_shipdate::date as date from lineitem) a
  where not exists (select 1 from lineitem b where b.l_partkey = a.document_id and b.l_shipdate::date = a.date and b.l_returnflag = 'R')) where n <= 5""")
def b12(tb: Tables) -> DataFrame:
    rows = tb.read("lineitem").selectExpr("l_partkey as document_id", "cast(l_shipdate as date) as date", "l_returnflag")
    return publish.missing_versions(rows.select("document_id", "date"), rows.where("l_returnflag = 'R'").select("document_id", "date").distinct(), 5).withColumn("date", F.col("date").cast("string"))


@query("k1_objects", "select doc_id, sha256(text) as sha256, 'docs/' || doc_id || '.md' as key from documents where text is not null")
def k1(tb: Tables) -> DataFrame:
    raw = tb.read("documents").where("text is not null").select(F.concat(F.lit("docs/"), F.col("doc_id").cast("string"), F.lit(".md")).alias("key"), F.encode("text", "UTF-8").alias("content"))
    back = files.get_objects(files.put_objects(raw))
    return back.select(F.regexp_extract("key", r"(\d+)", 1).cast("long").alias("doc_id"), F.sha2("content", 256).alias("sha256"), "key")


# --- duties and entities --------------------------------------------------------------------------


def raw_duties(tb: Tables) -> DataFrame:
    e = tb.read("lineitem")
    uri = F.concat(F.lit(t.ID_PREFIX + "ukpga/19"), (F.col("l_suppkey") % 90 + 10).cast("string"), F.lit("/"), (F.col("l_suppkey") % 7).cast("string"))
    return e.select(
        (F.col("l_quantity").cast("int")).cast("string").alias("dutyTempId"), F.concat(F.lit("d"), (F.col("l_orderkey") % 3000).cast("string")).alias("duty_uri"), uri.alias("enactment"), F.lit("t").alias("enactmentTitle"), F.lit("x").alias("enactmentType"),
        F.concat(uri, F.lit("/section/"), F.col("l_linenumber").cast("string")).alias("section"), F.when(F.col("l_linenumber") > 2, "a|b").otherwise("").alias("subsection"), F.concat(F.lit("a"), F.col("l_partkey").cast("string")).alias("actor"),
        F.when(F.col("l_partkey") % 2 == 0, F.concat(F.lit("b"), (F.col("l_partkey") % 20).cast("string"))).otherwise("").alias("actorIsBody"), F.when(F.col("l_partkey") % 3 == 0, F.concat(F.lit("c"), (F.col("l_partkey") % 20).cast("string"))).otherwise("").alias("actorIsAlias"),
        F.when(F.col("l_partkey") % 5 > 0, F.concat(F.lit("u"), (F.col("l_partkey") % 9).cast("string"))).otherwise("").alias("body_uri"), F.col("l_linestatus").alias("modality"), F.concat_ws(":", "l_partkey", "l_suppkey", F.date_format("l_shipdate", "yyyyMMdd"), "l_linenumber").alias("action"), F.lit("").alias("condition"), F.lit("explicit").alias("inference"), F.lit("?").alias("priority"),
    )


DUTY_SQL = """raw as (select l_quantity::int as tmp, 'd' || (l_orderkey % 3000) as duty_uri, 'ukpga/19' || (l_suppkey % 90 + 10) || '/' || (l_suppkey % 7) as document_id, l_linenumber::varchar as number, 'a' || l_partkey as actor, case when l_partkey % 2 = 0 then 'b' || (l_partkey % 20) end as body, case when l_partkey % 3 = 0 then 'c' || (l_partkey % 20) end as alias,
  case when l_partkey % 5 > 0 then 'u' || (l_partkey % 9) end as body_uri, l_partkey || ':' || l_suppkey || ':' || strftime(l_shipdate, '%Y%m%d') || ':' || l_linenumber as action from lineitem)"""


@query("b7_duties", f"with {DUTY_SQL} select duty_uri, tmp::bigint as source_temp_id, document_id, 'ukpga' as enactment_type, 'section/' || number as section_path, number as provision_number, actor, action from (select *, row_number() over (partition by duty_uri order by tmp nulls last, action nulls last, actor nulls last) as n from raw) where n = 1")
def b7(tb: Tables) -> DataFrame:
    docs = tb.spark.createDataFrame([], "id string")
    return entities.load_duties(raw_duties(tb), docs)[0].select("duty_uri", "source_temp_id", "document_id", "enactment_type", "section_path", "provision_number", "actor", "action")


@query("a9_duty_matches", f"with {DUTY_SQL} select duty_uri, body_name, match_kind, max(u) as body_uri from (select duty_uri, body as body_name, 'direct' as match_kind, case when alias is null then body_uri end as u from raw where body is not null union all select duty_uri, alias, 'alias', body_uri from raw where alias is not null) group by 1, 2, 3")
def a9(tb: Tables) -> DataFrame:
    return entities.load_duties(raw_duties(tb), tb.spark.createDataFrame([], "id string"))[1]


@query("b7_unlinked", f"with {DUTY_SQL}, d as (select * from (select *, row_number() over (partition by duty_uri order by tmp nulls last, action nulls last, actor nulls last) as n from raw) where n = 1) select count(*)::bigint as duties, count(*) filter (where not (document_id like '%/3'))::bigint as unlinked_documents from d")
def b7_counts(tb: Tables) -> DataFrame:
    docs = tb.read("supplier").select(F.concat(F.lit("ukpga/19"), (F.col("s_suppkey") % 90 + 10).cast("string"), F.lit("/3")).alias("id")).union(tb.spark.range(10, 100).select(F.concat(F.lit("ukpga/19"), F.col("id").cast("string"), F.lit("/3")))).distinct()
    return entities.load_duties(raw_duties(tb), docs)[2]


INSTRUMENTS = ("economy", "standard", "promo")
ENRICH_SQL = """rows as (select p_partkey as id, [' ' || upper('supplier#' || lpad((p_partkey % 250)::varchar, 9, '0')), '', 'alias ' || (p_partkey % 40), 'nobody'] as targets, p_size > 25 as dir, lower(p_type) as instrument from part where p_partkey % 3 <> 0),
x as (select distinct id as duty_id, trim(unnest(targets)) as target_text from rows)"""


def enriched(tb: Tables):
    rows = tb.read("part").selectExpr("p_partkey as id", "array(concat(' ', upper(concat('supplier#', lpad(cast(p_partkey % 250 as string), 9, '0')))), '', concat('alias ', p_partkey % 40), 'nobody') as targets", "p_size > 25 as is_direction_power", "lower(p_type) as instrument")
    duties = tb.read("part").where("p_partkey % 3 <> 0").selectExpr("p_partkey as duty_id")
    aliases = tb.read("nation").selectExpr("cast(n_nationkey as bigint) as entity_id", "concat('ALIAS ', n_nationkey) as alias")
    return entities.load_enrichment(rows, duties, tb.entities(), aliases, INSTRUMENTS)


@query("b8_enrichments", f"with {ENRICH_SQL} select id as duty_id, case when instrument in ('economy', 'standard', 'promo') then instrument else 'other' end as instrument, dir as is_direction_power from rows")
def b8(tb: Tables) -> DataFrame:
    return enriched(tb)[0]


B8_TARGETS = f"""with {ENRICH_SQL}, y as (select duty_id, target_text, (select min(s_suppkey) from supplier where lower(s_name) = lower(target_text)) as e, (select min(n_nationkey) from nation where lower('ALIAS ' || n_nationkey) = lower(target_text)) as a from x where target_text <> '')"""


@query("b8_targets", f"{B8_TARGETS} select duty_id, target_text, coalesce(e, a)::bigint as entity_id, case when e is not null then 'exact' when a is not null then 'alias' else 'unresolved' end as resolution from y")
def b8_targets(tb: Tables) -> DataFrame:
    return enriched(tb)[1]


@query("a13_resolution_histogram", f"{B8_TARGETS} select case when e is not null then 'exact' when a is not null then 'alias' else 'unresolved' end as resolution, count(*)::bigint as n from y group by 1")
def a13(tb: Tables) -> DataFrame:
    return entities.histogram(enriched(tb)[1], "resolution")


@query("a14_resolution_ratio", "select count(*)::bigint as names, count(*) filter (where exists (select 1 from customer where lower(c_name) = lower(n)))::bigint as resolved from (select distinct 'customer#' || lpad((o_custkey * 2)::varchar, 9, '0') as n from orders)")
def a14(tb: Tables) -> DataFrame:
    duties = tb.read("orders").selectExpr("concat('CUSTOMER#', lpad(cast(o_custkey * 2 as string), 9, '0')) as actor")
    return entities.resolution_ratio(duties, tb.read("customer").selectExpr("c_custkey as entity_id", "c_name as name"), tb.spark.createDataFrame([], "entity_id long, alias string"))


@query("b11_unresolved_actors", "select 'customer#' || lpad((o_custkey * 2)::varchar, 9, '0') as name, count(*)::bigint as duties from orders where o_custkey * 2 >= (select max(c_custkey) + 1 from customer) group by 1")
def b11(tb: Tables) -> DataFrame:
    duties = tb.read("orders").selectExpr("concat('CUSTOMER#', lpad(cast(o_custkey * 2 as string), 9, '0')) as actor")
    rows = entities.unresolved_actors(duties, tb.read("customer").selectExpr("c_custkey as entity_id", "c_name as name"), tb.spark.createDataFrame([], "entity_id long, alias string"))
    return rows.select(F.lower("actor").alias("name"), "duties")


@query("b9_former_names", "select s_suppkey + 1 as entity_id, s_name as alias, 'former' as alias_kind from supplier where s_suppkey % 4 = 0")
def b9(tb: Tables) -> DataFrame:
    return entities.former_names(tb.read("supplier").selectExpr("s_suppkey as entity_id", "s_name as name", "case when s_suppkey % 4 = 0 then s_suppkey + 1 end as successor_id"))


@query("b9_new_aliases", "select s_suppkey as entity_id, 'Office ' || s_suppkey as alias, 'short' as alias_kind from supplier where s_suppkey % 2 = 1 and s_suppkey % 5 <> 0")
def b9_aliases(tb: Tables) -> DataFrame:
    s = tb.read("supplier")
    found = s.selectExpr("s_suppkey as entity_id", "case when s_suppkey % 2 = 0 then concat('The ', s_name) else concat('Office ', s_suppkey) end as alias", "'short' as alias_kind")
    held = s.where("s_suppkey % 5 = 0").selectExpr("s_suppkey as entity_id", "concat('OFFICE ', s_suppkey) as alias", "'short' as alias_kind")
    return entities.new_aliases(found, s.selectExpr("s_suppkey as entity_id", "s_name as name"), held)


@query("b10_scoped_members", "select s_suppkey as entity_id, s_suppkey % 3 as class_id, s_nationkey::bigint as document_id from supplier where s_suppkey > 5")
def b10(tb: Tables) -> DataFrame:
    s = tb.read("supplier")
    defs = s.where("s_suppkey > 5").selectExpr("upper(s_name) as member_name", "concat('supplier#', lpad(cast(s_suppkey % 3 as string), 9, '0')) as class_name", "cast(s_nationkey as bigint) as document_id")
    return entities.scoped_members(defs, s.selectExpr("s_suppkey as entity_id", "s_name as name"))


@query("j13_fuzzy_candidates")
def j13(tb: Tables) -> DataFrame:
    names = tb.read("customer").selectExpr("replace(c_name, 'Customer', 'Suplier') as name")
    return entities.fuzzy_candidates(names, tb.read("supplier").selectExpr("s_suppkey as entity_id", "s_name as display"))


# --- coverage and reports -------------------------------------------------------------------------


@query("a12_coverage_audit", """with x as (select lang, case page_id % 5 when 0 then 'full' when 1 then 'metadata_only' when 2 then 'html' when 3 then 'empty' else 'other' end as c from (select page_id, case when page_id % 2 = 0 then 'en' else 'fr' end as lang from pages)),
  y as (select lang, count(*) as n, count(*) filter (where c = 'full') as f, count(*) filter (where c = 'metadata_only') as m, count(*) filter (where c = 'html') as h, count(*) filter (where c = 'empty') as e, count(*) filter (where c = 'other') as o from x group by lang),
  z as (select lang, count(*) as md from documents group by lang), j as (select lang, coalesce(n, 0) as n, coalesce(f, 0) as f, coalesce(m, 0) as m, coalesce(h, 0) as h, coalesce(e, 0) as e, coalesce(o, 0) as o, coalesce(md, 0) as md from y full join z using (lang))
  select case when grouping(lang) = 1 then 'TOTAL' else lang end as legislation_type, sum(n)::bigint as xml_files, sum(f)::bigint as "full", sum(m)::bigint as metadata_only, sum(h)::bigint as html, sum(e)::bigint as empty, sum(o)::bigint as other, sum(md)::bigint as markdown_files from j group by rollup(lang)""")
def a12(tb: Tables) -> DataFrame:
    k = F.col("page_id") % 5
    content = F.when(k == 0, '<Legislation x="1"><Body><P/></Body></Legislation>').when(k == 1, "<leg:Legislation><Metadata/></leg:Legislation>").when(k == 2, F.col("html")).when(k == 3, " ").otherwise("<other/>")
    return coverage.coverage_audit(tb.read("pages").select(F.when(F.col("page_id") % 2 == 0, "en").otherwise("fr").alias("legislation_type"), content.alias("content")), tb.read("documents").selectExpr("lang as legislation_type"))


@query("b14_failure_counts", "select event_type as stage, case when event_id % 2 = 0 then 'timeout' else 'HTTP status 500' end as category, count(*)::bigint as n from events group by 1, 2")
def b14(tb: Tables) -> DataFrame:
    failure = F.struct(F.col("event_type").alias("stage"), F.when(F.col("event_id") % 2 == 0, "x Timed Out").otherwise("HTTP status 500 for u").alias("error"))
    return coverage.failure_counts(coverage.failures_of(tb.read("events").select(F.array(failure).alias("failures"))))


@query("b13_probe_classes", "select event_id, case event_id % 4 when 0 then 'latest available' when 1 then 'resources available' when 2 then 'not found' else 'server error' end as class from events")
def b13(tb: Tables) -> DataFrame:
    probe = lambda label, code: F.struct(F.lit(label).alias("label"), F.lit(code).alias("status_code"))
    k = F.col("event_id") % 4
    probes = F.when(k == 0, F.array(probe("latest_xml", 200), probe("enacted_xml", 404))).when(k == 1, F.array(probe("latest_xml", 404), probe("resources_xml", 200))).when(k == 2, F.array(probe("latest_xml", 404), probe("enacted_xml", 404))).otherwise(F.array(probe("latest_xml", 503)))
    return tb.read("events").select("event_id", feeds.probe_class(probes).alias("class"))


@query("b15_pdf_candidates", """with f as (select doc_id as file_id, source as version_id, lang as source_url, 'pdf' as file_kind, doc_id % 7 = 0 as c from documents union all select doc_id, source, 'de', 'extracted_text', false from documents where doc_id % 50 = 1)
  select file_id, version_id from (select *, row_number() over (partition by version_id order by c desc, file_id) as n from f a where file_kind = 'pdf' and not exists (select 1 from f b where b.file_kind = 'extracted_text' and b.version_id = a.version_id and b.source_url = a.source_url) and not (a.file_id % 14 = 0)) where n = 1""")
def b15(tb: Tables) -> DataFrame:
    d = tb.read("documents")
    own = d.selectExpr("doc_id as file_id", "source as version_id", "lang as source_url", "'pdf' as file_kind", "doc_id % 7 = 0 as is_canonical").unionByName(d.where("doc_id % 50 = 1").selectExpr("doc_id as file_id", "source as version_id", "'de' as source_url", "'extracted_text' as file_kind", "false as is_canonical"))
    failed = d.selectExpr("doc_id as file_id", "case when doc_id % 14 = 0 then 3 else 2 end as attempts")
    return coverage.pdf_candidates(own, failed).select("file_id", "version_id")


@query("b17_prune_guard", "select count(*)::bigint as sampled, count(*) filter (where c_custkey not in (select o_custkey from orders))::bigint as missing, count(*) filter (where c_custkey not in (select o_custkey from orders)) > count(*) * 0.02 as abort from customer where c_custkey % 5 = 0")
def b17(tb: Tables) -> DataFrame:
    return coverage.prune_guard(tb.read("customer").where("c_custkey % 5 = 0").selectExpr("c_custkey as key"), tb.read("orders").selectExpr("o_custkey as key"), "key")


@query("s11_crawl_plan", "select r_name as legislation_type, unnest(generate_series(greatest(1995, 1990 + r_regionkey * 3), case when r_regionkey = 2 then 1999 else 2003 end))::int as year from region")
def s11(tb: Tables) -> DataFrame:
    types = tb.read("region").selectExpr("r_name as legislation_type", "cast(1990 + r_regionkey * 3 as int) as start_year", "case when r_regionkey = 2 then 1999 end as end_year")
    return feeds.crawl_plan(types, 1995, 2003)


@query("s3_path_refs", "select doc_id, 'point-in-time' as collection, '2020-01-0' || (doc_id % 9 + 1) as date, lang as legislation_type, '2001' as year, doc_id::varchar as number, lang || '/2001/' || doc_id as document_id from documents")
def s3(tb: Tables) -> DataFrame:
    path = F.concat(F.lit("file:///x/markdown/point-in-time/2020-01-0"), (F.col("doc_id") % 9 + 1).cast("string"), F.lit("/"), "lang", F.lit("/2001/"), F.col("doc_id").cast("string"), F.lit(".md"))
    return tb.read("documents").select("doc_id", clml.document_ref(path).alias("r")).select("doc_id", "r.*")


XML = """<Legislation xmlns="http://www.legislation.gov.uk/namespaces/legislation" xmlns:dc="http://purl.org/dc/elements/1.1/" DocumentURI="http://x/{n}" Status="revised"><Metadata><dc:title>Act {n}</dc:title></Metadata>
<Body><P1group><Title>Meaning of {n}</Title><P1><Pnumber>1</Pnumber><P1para><Text>Whoever ( {n} ) , does.</Text><P2><Pnumber>a</Pnumber><P2para><Text>this</Text></P2para></P2></P1para></P1></P1group></Body></Legislation>"""


@query("x2_clml_to_markdown", "select n_nationkey as n, sha256('---' || chr(10) || 'title: \"Act ' || n_nationkey || '\"' || chr(10) || 'document_uri: \"http://x/' || n_nationkey || '\"' || chr(10) || 'status: \"revised\"' || chr(10) || '---' || chr(10) || chr(10) || '# Act ' || n_nationkey || chr(10) || chr(10) || '## 1 Meaning of ' || n_nationkey || chr(10) || chr(10) || 'Whoever ( ' || n_nationkey || '), does.' || chr(10) || chr(10) || '(a) this' || chr(10)) as markdown_sha256 from nation")
def x2(tb: Tables) -> DataFrame:
    own = F.encode(F.replace(F.lit(XML), F.lit("{n}"), F.col("n_nationkey").cast("string")), "UTF-8")
    rendered = clml.clml_to_markdown(tb.read("nation").select(F.col("n_nationkey").cast("string").alias("path"), own.alias("content")))
    return rendered.select(F.col("path").cast("int").alias("n"), F.sha2("markdown", 256).alias("markdown_sha256"))


#: Words of a line and lines of a page: the last line still ends above the foot of the page.
LINE_WORDS, PAGE_LINES = 8, 24


@query("b16_layout_to_markdown")
def b16(tb: Tables) -> DataFrame:
    n = LINE_WORDS * PAGE_LINES
    worded = tb.read("documents").where("text is not null").select(F.col("doc_id").cast("string").alias("path"), F.split("text", r"\s+").alias("words"))
    # A row for each page before its words are cut out, so that a long text's words are not read again for each of its pages.
    paged = worded.select("path", "words", F.explode(F.sequence(F.lit(0), F.ceil(F.size("words") / n).cast("int") - 1)).alias("p"))
    places = {"x": [80.0 + i % LINE_WORDS * 40 for i in range(n)], "y": [90.0 + i // LINE_WORDS * 14 for i in range(n)], "width": [36.0] * n, "height": [10.0] * n, "confidence": [0.9] * n}
    held = F.least(F.size("words") - F.col("p") * n, F.lit(n))
    items = F.arrays_zip(F.slice("words", F.col("p") * n + 1, n).alias("text"), *[F.slice(F.array(*map(F.lit, v)), F.lit(1), held).alias(c) for c, v in places.items()])
    pages = paged.select("path", (F.col("p") + 1).alias("page"), F.lit("").alias("text"), items.alias("text_items"))
    return layout.pages_to_markdown(pages, worded.select("path", F.lit("Title").alias("title")))


# --- streams --------------------------------------------------------------------------------------


def shared(tb: Tables) -> str:
    return shared_dir(tb.spark)


def event_stream(tb: Tables) -> DataFrame:
    schema = tb.read("events").schema
    return tb.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(tb.sf_dir)


@query("e1_poll_publication_log", "select user_id as document_id, event_id, event_type from (select *, row_number() over (partition by user_id order by ts, event_id) as n from events where event_type <> 'error') where n = 1")
def e1(tb: Tables) -> DataFrame:
    root = poll.work_dir(tb.spark, shared(tb), "poll")
    stream = event_stream(tb).selectExpr("user_id as document_id", "ts as updated", "event_id", "event_type")
    state = poll.TableState(tb.spark, f"{root}/state", ["document_id", "event_id"])
    seen = poll.poll(stream.where("event_type <> 'error'"), state, f"{root}/checkpoint", since="1900-01-01")
    return poll.to_ingest(seen.select("document_id", "updated", "event_id", "event_type"), None).select("document_id", "event_id", "event_type")


@query("e2_replayed_upsert", "select user_id, max(event_id) as event_id from events group by user_id")
def e2(tb: Tables) -> DataFrame:
    # Six files in batches of two; a second query with a checkpoint of its own brings rows that the first did not.
    root = poll.work_dir(tb.spark, shared(tb), "replay")
    tb.read("events").select("user_id", "event_id").repartition(6, "event_id").write.parquet(f"{root}/landed")
    stream = tb.spark.readStream.schema("user_id long, event_id long").option("maxFilesPerTrigger", 2).parquet(f"{root}/landed")
    state = poll.TableState(tb.spark, f"{root}/state", ["user_id"], [F.col("event_id").desc()], latest=True)
    some = stream.where("user_id % 2 = 0")
    for rows, checkpoint in ((some, "a"), (some, "a"), (stream, "b")):
        poll.run_available(rows, poll.into(state), f"{root}/{checkpoint}")
    state.compact()
    return state.read()


@query("e5_windowed_counts", "select strftime(time_bucket(interval '1 day', ts), '%Y-%m-%d %H:%M:%S') as day, event_type, count(*)::bigint as n from events group by 1, 2")
def e5(tb: Tables) -> DataFrame:
    root = poll.work_dir(tb.spark, shared(tb), "windows")
    stream = event_stream(tb).withColumn("at", F.to_timestamp(F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")), "yyyy-MM-dd HH:mm:ss z"))
    counts = poll.windowed_counts(stream, "at", "event_type", "1 day", "1 hour")
    counts.writeStream.outputMode("complete").foreachBatch(lambda b, n: b.write.mode("overwrite").parquet(f"{root}/out")).option("checkpointLocation", f"{root}/c").trigger(availableNow=True).start().awaitTermination()
    done = tb.spark.read.parquet(f"{root}/out")
    return done.select(F.date_format(F.col("w.start"), "yyyy-MM-dd HH:mm:ss").alias("day"), "event_type", "n")


@query("e5_distinct_events", "select count(distinct event_id)::bigint as n from events")
def e5_distinct(tb: Tables) -> DataFrame:
    root = poll.work_dir(tb.spark, shared(tb), "distinct")
    stream = event_stream(tb).withColumn("at", F.col("ts").cast("timestamp"))
    once = poll.distinct_events(stream, "at", "event_id", "40 days").select("event_id")
    once.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/c").trigger(availableNow=True).start().awaitTermination()
    return tb.spark.read.schema("event_id long").parquet(f"{root}/out").agg(F.count(F.lit(1)).alias("n"))


@query("e3_effects_since_cursor", sql("select e.effect_id from m_effects e where in_force_date > (select max(in_force_date) - 200 from m_effects f where f.affected_document_id = e.affected_document_id)", "m_effects"))
def e3(tb: Tables) -> DataFrame:
    e = tb.effects()
    cursor = e.groupBy("affected_document_id").agg(F.date_sub(F.max("in_force_date"), 200).alias("cursor"))
    return e.join(cursor, "affected_document_id").where("in_force_date > cursor").select("effect_id")


# --- smaller operators ----------------------------------------------------------------------------


@query("o7_hash_sample", "select c_custkey from customer where substr(md5('s:' || c_custkey), 1, 2) < '40'")
def o7(tb: Tables) -> DataFrame:
    # A sample that every run repeats: by the hash of the key, not by chance.
    return tb.read("customer").where(F.substring(F.md5(F.concat(F.lit("s:"), F.col("c_custkey").cast("string")).cast("binary")), 1, 2) < "40").select("c_custkey")


@query("o11_first_wins", "select url_host, min(page_id) as page_id from (select page_id, regexp_extract(url, '://([^/?#]*)', 1) as url_host from pages) group by 1")
def o11(tb: Tables) -> DataFrame:
    rows = tb.read("pages").select("page_id", F.regexp_extract("url", "://([^/?#]*)", 1).alias("url_host"))
    return keyed.distinct_on(rows, ["url_host"], [F.col("page_id")]).select("url_host", "page_id")


@query("j1_three_way_join", "select o_orderkey, c_name, n_name from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey where o_orderstatus = 'P'")
def j1(tb: Tables) -> DataFrame:
    o = tb.read("orders").where("o_orderstatus = 'P'")
    return o.join(tb.read("customer"), F.col("o_custkey") == F.col("c_custkey")).join(tb.read("nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("o_orderkey", "c_name", "n_name")


@query("j3_semi_in_filter", "select l_suppkey, count(*)::bigint as n, count(*) filter (where l_orderkey in (select o_orderkey from orders where o_orderstatus = 'F'))::bigint as matched from lineitem group by 1")
def j3(tb: Tables) -> DataFrame:
    done = tb.read("orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"), F.lit(True).alias("done"))
    return tb.read("lineitem").join(done, "l_orderkey", "left").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.count_if("done").alias("matched"))


@query("r2_array_membership", "select doc_id from documents where list_contains(['src1', 'src4'], source)")
def r2(tb: Tables) -> DataFrame:
    return tb.read("documents").where(F.array_contains(F.array(F.lit("src1"), F.lit("src4")), F.col("source"))).select("doc_id")


@query("r3_distinct_in_order", "select doc_id, source || ',' || lang || ',x' as parts from documents")
def r3(tb: Tables) -> DataFrame:
    return tb.read("documents").select("doc_id", F.array_join(F.array_distinct(F.array("source", "lang", "source", F.lit("x"), "lang")), ",").alias("parts"))


@query("d5_rounded_scores", "select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity::bigint as q, round((l_quantity * 7)::bigint::decimal(18, 0) / 16, 4)::varchar as score from lineitem")
def d5(tb: Tables) -> DataFrame:
    rows = tb.read("lineitem")
    score = F.round(((F.col("l_quantity") * 7).cast("long") / 16).cast("double"), 4).cast("string")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("long").alias("q"), score.alias("score"))


@query("d6_medians", "select l_suppkey, quantile_disc(l_linenumber, 0.5)::int as middle from lineitem group by 1")
def d6(tb: Tables) -> DataFrame:
    return tb.read("lineitem").groupBy("l_suppkey").agg(F.expr("percentile_disc(0.5) within group (order by l_linenumber)").cast("int").alias("middle"))


@query("t14_t15_flags", "select page_id, page_id % 3 = 0 as metadata_only, case when page_id % 2 = 0 then 'Head ' || page_id else 'p' || page_id end as title from pages")
def t14(tb: Tables) -> DataFrame:
    md = F.concat(F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("# Head "), F.col("page_id").cast("string"), F.lit("\n\n"))).otherwise("x\n"), F.when(F.col("page_id") % 3 == 0, clml.METADATA_ONLY).otherwise(""))
    return tb.read("pages").select("page_id", md.contains(clml.METADATA_ONLY).alias("metadata_only"), t.fallback_title(md, F.concat(F.lit("p"), F.col("page_id").cast("string"))).alias("title"))


@query("x6_addresses", "select page_id, 'ukpga/19' || (page_id % 90 + 10) || '/' || page_id as document_id from pages")
def s17(tb: Tables) -> DataFrame:
    address = F.concat(F.lit("http://x.org/id/ukpga/19"), (F.col("page_id") % 90 + 10).cast("string"), F.lit("/"), F.col("page_id").cast("string"), F.lit("/2001-01-01"))
    return tb.read("pages").select("page_id", files.seed_ref(address).alias("document_id"))
