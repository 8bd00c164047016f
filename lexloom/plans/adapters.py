"""Driver tables seen as the model's tables, once for Spark and once as DuckDB SQL (``CTES``)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexloom.functions import text as t
from lexloom.operators.diff import compare_code

EFFECT_TYPES = {"1-URGENT": "substituted", "2-HIGH": "coming into force", "3-MEDIUM": "applied", "4-NOT SPECIFIED": "", "5-LOW": "inserted"}


#: A provision's text: its words, with spaces that differ from supplier to supplier and that no reader minds.
MARKDOWN = "concat(l_returnflag, case l_suppkey % 3 when 0 then ', ' when 1 then ' , ' else ',  ' end, l_linestatus)"


#: Kinds and extents: provisions 7 are schedules, of some suppliers a reading for one extent only.
KIND = "case when l_linenumber = 7 then 'schedule' else 'section' end"
EXTENT = "case l_suppkey % 5 when 0 then 'S' when 1 then 'E+W' end"


@dataclass
class Tables:
    spark: SparkSession
    sf_dir: str

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def documents(self) -> DataFrame:
        return self.read("documents").selectExpr(
            "concat_ws('/', lang, 1990 + doc_id % 35, doc_id) as id", "doc_id", "lang as legislation_type", "case when doc_id % 17 = 0 then null else cast(1990 + doc_id % 35 as int) end as calendar_year",
            "case when doc_id % 13 = 0 then concat('x', doc_id) else cast(doc_id as string) end as number", "substring(text, 1, 40) as title",
            "case doc_id % 4 when 0 then 'Current' when 1 then 'Revoked' when 2 then 'Prospective' end as status", "source as extent", "case when doc_id % 11 = 0 then null else concat('v', doc_id) end as latest_version_id",
            "case when doc_id % 3 = 0 then date_add(date'2000-01-01', cast(doc_id % 9000 as int)) end as legal_date", "text",
        )

    def latest_versions(self) -> DataFrame:
        labels = self.read("labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
        return self.read("documents").join(labels, "doc_id", "left").selectExpr("concat('v', doc_id) as version_id", "doc_id", "n_chars as word_count", "quality = 0 as is_metadata_only")

    def dated_lines(self, whole: bool = False) -> DataFrame:
        lines = self.lines_by_document() if whole else self.read("lineitem")
        rows = lines.selectExpr("l_partkey", "cast(year(l_shipdate) as int) as y", "l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "markdown" if whole else f"{MARKDOWN} as markdown")
        # The text comes last, so that order is total and whoever asks for it asks for the same lines: they are shuffled once.
        w = Window.partitionBy("l_partkey", "y").orderBy("l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", *(["markdown"] if whole else []))
        return rows.withColumn("ordinal", F.row_number().over(w))

    def lines_by_document(self) -> DataFrame:
        """Lines with all of a document in one place.  Times and prices travel as days and pence, and as they are where that would lose anything."""
        lines = self.read("lineitem")
        time = lines.schema["l_shipdate"].dataType.simpleString()
        sent = lines.selectExpr("*", "cast(l_shipdate as date) as day", "try_cast(round(l_extendedprice * 100) as bigint) as pence").selectExpr(
            "l_partkey", "day", "l_orderkey", "l_linenumber", "l_suppkey", "pence", f"{MARKDOWN} as markdown",
            f"case when not (cast(day as {time}) <=> l_shipdate) then l_shipdate end as time", "case when not (pence / 100D <=> l_extendedprice) then l_extendedprice end as price",
        ).repartition("l_partkey")
        return sent.selectExpr("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "markdown", f"coalesce(time, cast(day as {time})) as l_shipdate", "coalesce(price, pence / 100D) as l_extendedprice")

    def versions(self, whole: bool = False) -> DataFrame:
        """``whole``: with all of a document in one place, from the lines that ``provisions`` has there."""
        if whole:
            return self.provisions(whole).where("ordinal = 1").select("version_id", "document_id", "snapshot_date")
        return self.read("lineitem").selectExpr("l_partkey as document_id", "cast(year(l_shipdate) as int) as y").distinct().selectExpr("concat(document_id, ':', y) as version_id", "document_id", "make_date(y, 1, 1) as snapshot_date")

    def provisions(self, whole: bool = False) -> DataFrame:
        """``whole``: with all of a document in one place."""
        return self.dated_lines(whole).selectExpr(
            "concat(l_partkey, ':', y) as version_id", "l_partkey as document_id", "ordinal", f"{KIND} as provision_type", "cast(l_linenumber as string) as number", f"{EXTENT} as extent",
            "concat('h', l_linenumber) as heading", "concat('a', l_linenumber) as anchor", "markdown", "sha2(markdown, 256) as text_sha256", *(["make_date(y, 1, 1) as snapshot_date"] if whole else []),
        ).withColumn("compare_code", compare_code(F.col("markdown")))

    def provision_keys(self) -> DataFrame:
        return self.read("lineitem").selectExpr("l_partkey as document_id", f"{KIND} as provision_type", "cast(l_linenumber as string) as number")

    def texts(self) -> DataFrame:
        return self.read("lineitem").selectExpr(f"{MARKDOWN} as markdown").distinct().selectExpr("sha2(markdown, 256) as text_sha256", "markdown")

    def effects(self, whole: bool = False) -> DataFrame:
        """``whole``: with all of an affected document in one place.  Numbers travel; ids are spelt where they arrive."""
        lines = self.read("lineitem").selectExpr("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "cast(l_shipdate as date) as shipped", "cast(round(l_extendedprice * 100) as bigint) as pence", "l_linestatus = 'F' as applied")
        kind = t.textual_kind(t.lookup(F.col("o_orderpriority"), EFFECT_TYPES))
        orders = self.read("orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("in_force_date"), kind.alias("textual_kind"), (F.col("o_orderstatus") == "O").alias("prospective"))
        both = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        return (both.repartition("l_partkey") if whole else both).select(
            F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "shipped", "pence").alias("effect_id"), F.col("o_custkey").alias("affecting_document_id"), F.col("l_partkey").alias("affected_document_id"), F.concat(F.lit("part "), "l_partkey").alias("affected_title"),
            "in_force_date", "textual_kind", "applied", "prospective", F.col("l_linenumber").cast("string").alias("section_number"),
        )

    def refs(self) -> DataFrame:
        return self.effects().select("effect_id", F.lit("affected").alias("side"), "section_number", F.lit("section").alias("provision_kind"))

    def parts(self) -> DataFrame:
        return self.read("part").selectExpr("p_partkey as id", "p_name as title")

    def duties(self) -> DataFrame:
        return self.read("part").selectExpr(
            "p_partkey as duty_id", "cast(p_size as bigint) as document_id", "p_name as enactment_title", "case p_size % 3 when 0 then 'ukpga' when 1 then 'uksi' else 'gbla' end as enactment_type", "p_brand as actor",
            "concat(lower(p_type), ' ', p_name) as action", "case when p_size % 5 = 0 then concat('if ', p_name) end as condition", "case p_size % 4 when 0 then 'duty' when 1 then 'both' else 'power' end as modality",
        )

    def enrichments(self) -> DataFrame:
        return self.read("part").where("p_size % 7 <> 0").selectExpr("p_partkey as duty_id", "lower(p_type) as instrument", "p_size < 10 as is_direction_power")

    def entities(self) -> DataFrame:
        return self.read("supplier").selectExpr("s_suppkey as entity_id", "s_name as name")

    def targets(self) -> DataFrame:
        lines = self.read("lineitem").selectExpr("l_partkey as duty_id", "l_suppkey as entity_id").where("duty_id % 5 = entity_id % 5").distinct()
        return lines.join(self.entities(), "entity_id").selectExpr("duty_id", "entity_id", "concat('the ', name) as target_text")

    def members(self) -> DataFrame:
        return self.read("supplier").where("s_suppkey % 7 = 0").selectExpr("s_suppkey + 1 as entity_id", "s_suppkey as class_id", "s_suppkey % 50 as document_id")


CTES = {
    "m_docs": """select concat_ws('/', lang, 1990 + doc_id % 35, doc_id) as id, doc_id, lang as legislation_type, case when doc_id % 17 = 0 then null else (1990 + doc_id % 35)::int end as calendar_year,
      case when doc_id % 13 = 0 then 'x' || doc_id else doc_id::varchar end as number, substr(text, 1, 40) as title, case doc_id % 4 when 0 then 'Current' when 1 then 'Revoked' when 2 then 'Prospective' end as status,
      source as extent, case when doc_id % 11 = 0 then null else 'v' || doc_id end as latest_version_id, case when doc_id % 3 = 0 then date '2000-01-01' + (doc_id % 9000)::int end as legal_date, text from documents""",
    "m_latest": "select 'v' || d.doc_id as version_id, d.doc_id, n_chars as word_count, q = 0 as is_metadata_only from documents d left join (select doc_id, max(quality) as q from labels group by doc_id) l using (doc_id)",
    "m_lines": f"""select l_partkey, year(l_shipdate)::int as y, l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_extendedprice, {MARKDOWN} as markdown,
      row_number() over (partition by l_partkey, year(l_shipdate) order by l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_extendedprice) as ordinal from lineitem""",
    "m_versions": "select distinct l_partkey || ':' || year(l_shipdate) as version_id, l_partkey as document_id, make_date(year(l_shipdate), 1, 1) as snapshot_date from lineitem",
    "m_provisions": f"""select l_partkey || ':' || y as version_id, l_partkey as document_id, ordinal::int as ordinal, {KIND} as provision_type, l_linenumber::varchar as number, {EXTENT} as extent, 'h' || l_linenumber as heading, 'a' || l_linenumber as anchor,
      markdown, sha256(markdown) as text_sha256 from m_lines""",
    "m_effects": f"""select concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate::date, round(l_extendedprice * 100)::bigint) as effect_id, o_custkey as affecting_document_id, l_partkey as affected_document_id, 'part ' || l_partkey as affected_title,
      o_orderdate::date as in_force_date, case o_orderpriority {" ".join(f"when '{k}' then '{dict(substituted="T", applied="NT", inserted="T").get(v, "CO" if v else "UN")}'" for k, v in EFFECT_TYPES.items())} end as textual_kind,
      l_linestatus = 'F' as applied, o_orderstatus = 'O' as prospective, l_linenumber::varchar as section_number from lineitem join orders on l_orderkey = o_orderkey""",
    "m_duties": """select p_partkey as duty_id, p_size::bigint as document_id, p_name as enactment_title, case p_size % 3 when 0 then 'ukpga' when 1 then 'uksi' else 'gbla' end as enactment_type, p_brand as actor,
      lower(p_type) || ' ' || p_name as action, case when p_size % 5 = 0 then 'if ' || p_name end as condition, case p_size % 4 when 0 then 'duty' when 1 then 'both' else 'power' end as modality from part""",
    "m_enrichments": "select p_partkey as duty_id, lower(p_type) as instrument, p_size < 10 as is_direction_power from part where p_size % 7 <> 0",
    "m_entities": "select s_suppkey as entity_id, s_name as name from supplier",
    "m_targets": "select distinct l_partkey as duty_id, l_suppkey as entity_id, 'the ' || s_name as target_text from lineitem join supplier on l_suppkey = s_suppkey where l_partkey % 5 = l_suppkey % 5",
    "m_members": "select s_suppkey + 1 as entity_id, s_suppkey as class_id, s_suppkey % 50 as document_id from supplier where s_suppkey % 7 = 0",
}


def sql(body: str, *names: str) -> str:
    """``body`` behind the named model tables (and those they build on); a leading ``with`` in it is merged."""
    wanted = list(dict.fromkeys([*(["m_lines"] if "m_provisions" in names and "m_lines" not in names else []), *names]))
    own = ", ".join(f"{n} as ({CTES[n]})" for n in wanted)
    body = body.strip()
    return f"with {own}, {body[5:]}" if body.lower().startswith("with ") else f"with {own} {body}"
