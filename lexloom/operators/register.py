"""The dictionary of bodies: built from a register and a second source, classes with members by act, decisions on names."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.functions import text as t
from lexloom.operators.keyed import distinct_on, numbered

ENTITY = (
    "entity_id long, name string, kind string, org_type string, status string, closed_reason string, closed_at string, slug string, parent_id long, successor_id long, "
    "second_id string, legislation_uri string"
)
ALIAS = "entity_id long, alias string, alias_kind string, source string"

#: Statutory classes of bodies.
CLASS_TERMS = (
    "licence holder", "licensee", "system operator", "transmission system operator", "distribution system operator", "relevant system operator", "statutory undertaker",
    "utility undertaker", "nominated undertaker", "competent authority", "enforcement authority", "relevant authority", "appropriate authority", "licensing authority",
    "relevant planning authority", "street authority", "governing body", "regulator",
)
#: Member, class, the act that defines the class.
MEMBERSHIPS = (
    ("National Energy System Operator", "licence holder", "ukpga/1989/29"),
    ("National Energy System Operator", "system operator", "ukpga/1989/29"),
    ("National Energy System Operator", "licence holder", "ukpga/2023/52"),
)


@dataclass
class Dictionary:
    """Entities (ENTITY) and aliases (ALIAS)."""

    entities: DataFrame
    aliases: DataFrame


def columns_of(schema: str) -> list[tuple[str, str]]:
    return [tuple(c.strip().split(" ")) for c in schema.split(",")]


def shaped(df: DataFrame, schema: str) -> DataFrame:
    """``df`` with the columns of ``schema``, null where it lacks one."""
    return df.select(*[(F.col(n) if n in df.columns else F.lit(None)).cast(k).alias(n) for n, k in columns_of(schema)])


def said(aliases: DataFrame, entities: DataFrame, held: DataFrame | None = None) -> DataFrame:
    """Aliases (ALIAS, first column order decides) that differ from their entity's name, each spelling of an entity once."""
    rows = aliases.join(entities.select("entity_id", "name"), "entity_id").where(t.match_name(F.col("alias")) != t.match_name(F.col("name")))
    rows = rows.withColumn("_l", F.lower("alias"))
    if held is not None:
        rows = rows.join(held.select("entity_id", F.lower("alias").alias("_l")).distinct(), ["entity_id", "_l"], "left_anti")
    return shaped(distinct_on(rows, ["entity_id", "_l"], [F.col("_rank"), F.col("alias"), F.col("alias_kind")]), ALIAS)


def named_once(entities: DataFrame) -> DataFrame:
    """(norm, entity_id): the first entity of each name, spelled for comparison."""
    return entities.groupBy(t.match_name(F.col("name")).alias("norm")).agg(F.min("entity_id").alias("entity_id"))


def dictionary(register: DataFrame, second: DataFrame, uris: DataFrame, manual: DataFrame) -> Dictionary:
    """Entities and aliases from a register and what other sources add.

    ``register`` (slug, title, format, status, closed_status, closed_at, abbreviation, parents, successors;
    the last two arrays of slugs) gives bodies, numbered by slug.  Of several parents or successors the
    first named counts, if it is in the register.  Aliases are abbreviations, the names of bodies that
    changed theirs (for the successor, one step on), and ``manual`` ones (slug, alias, alias_kind).
    ``second`` (id, name, category, subtype) is matched by name and adds what is new, officials as
    offices; ``uris`` (body_uri, body_name) attaches addresses, the smallest if several.
    """
    own = numbered(distinct_on(register, ["slug"], [F.col("title")]), ["slug"]).withColumnRenamed("_number", "entity_id")
    ids = own.select(F.col("slug").alias("_slug"), F.col("entity_id").alias("_id"))
    first = lambda df, c, name: df.withColumn("_slug", F.get(c, F.lit(0))).join(ids, "_slug", "left").withColumnRenamed("_id", name).drop("_slug")
    linked = first(first(own, "parents", "parent_id"), "successors", "successor_id")
    bodies = shaped(linked.withColumnsRenamed({"title": "name", "format": "org_type", "closed_status": "closed_reason"}).withColumns({"kind": F.lit("body"), "closed_at": t.or_null(F.substring("closed_at", 1, 10))}), ENTITY)
    entities = with_second_source(bodies, second)
    entities = with_addresses(entities, uris)
    short = linked.select("entity_id", F.trim("abbreviation").alias("alias"), F.lit("abbreviation").alias("alias_kind"), F.lit("register").alias("source"), F.lit(0).alias("_rank")).where("alias <> ''")
    former = linked.where("closed_status = 'changed_name' and successor_id is not null").select(F.col("successor_id").alias("entity_id"), F.col("title").alias("alias"), F.lit("former_name").alias("alias_kind"), F.lit("register").alias("source"), F.lit(1).alias("_rank"))
    by_hand = manual.join(own.select("slug", "entity_id"), "slug").select("entity_id", "alias", "alias_kind", F.lit("manual").alias("source"), F.lit(2).alias("_rank"))
    return Dictionary(entities, said(short.unionByName(former).unionByName(by_hand), entities))


def with_second_source(entities: DataFrame, second: DataFrame) -> DataFrame:
    """``entities`` with the ids of a second source by name, and a new entity for each name that they lack."""
    rows = second.withColumn("norm", t.match_name(F.col("name")))
    first = distinct_on(rows, ["norm"], [F.col("id")])
    found = first.join(named_once(entities), "norm", "left")
    matched = found.where("entity_id is not null").select("entity_id", F.col("id").alias("_second"))
    top = entities.agg(F.max("entity_id").alias("m")).first()["m"] or 0  # one number
    fresh = numbered(found.where("entity_id is null").drop("entity_id"), ["norm"], top)
    new = fresh.select(
        F.col("_number").alias("entity_id"), "name", F.when(F.col("category") == "official", "office").otherwise("body").alias("kind"), F.col("subtype").alias("org_type"),
        F.lit("live").alias("status"), F.col("id").cast("string").alias("second_id"),
    )
    kept = entities.join(matched, "entity_id", "left").withColumn("second_id", F.coalesce("second_id", F.col("_second").cast("string")))
    return shaped(kept, ENTITY).unionByName(shaped(new, ENTITY))


def with_addresses(entities: DataFrame, uris: DataFrame) -> DataFrame:
    own = uris.where("body_uri is not null").select(t.match_name(F.col("body_name")).alias("norm"), "body_uri").join(named_once(entities), "norm")
    least = own.groupBy("entity_id").agg(F.min("body_uri").alias("_uri"))
    return shaped(entities.join(least, "entity_id", "left").withColumn("legislation_uri", F.coalesce("legislation_uri", "_uri")), ENTITY)


# --- classes --------------------------------------------------------------------------------------


def with_classes(entities: DataFrame, terms: tuple[str, ...] = CLASS_TERMS) -> DataFrame:
    """``entities`` and an entity of kind class for each term that names none of them."""
    rows = entities.sparkSession.createDataFrame([(x,) for x in terms], "name string")
    return with_new(entities, rows.select("name", F.lit("class").alias("kind")), F.lit(True))


def with_new(entities: DataFrame, rows: DataFrame, same_name: Column) -> DataFrame:
    """``entities`` and ``rows`` (name, kind) whose name none of those has for which ``same_name`` holds; ids go on by name."""
    held = entities.where(same_name).select(F.lower("name").alias("_l")).distinct()
    fresh = distinct_on(rows.withColumn("_l", F.lower("name")).join(held, "_l", "left_anti"), ["kind", "_l"], [F.col("name")])
    top = entities.agg(F.max("entity_id").alias("m")).first()["m"] or 0  # one number
    new = numbered(fresh, ["_l", "kind"], top).select(F.col("_number").alias("entity_id"), "name", "kind", F.lit("n/a").alias("status"))
    return shaped(entities, ENTITY).unionByName(shaped(new, ENTITY))


def resolve_to_classes(targets: DataFrame, entities: DataFrame) -> DataFrame:
    """Targets (duty_id, target_text, entity_id, resolution) that nothing else resolved, by the class of their name."""
    classes = entities.where("kind = 'class'").groupBy(F.lower("name").alias("_l")).agg(F.min("entity_id").alias("_class"))
    rows = targets.withColumn("_l", F.lower("target_text")).join(classes, "_l", "left")
    hit = (F.col("resolution") == "unresolved") & F.col("_class").isNotNull()
    return rows.select("duty_id", "target_text", F.when(hit, F.col("_class")).otherwise(F.col("entity_id")).alias("entity_id"), F.when(hit, "exact").otherwise(F.col("resolution")).alias("resolution"))


def memberships(entities: DataFrame, rows: DataFrame) -> DataFrame:
    """(entity_id, class_id, document_id) of ``rows`` (member_name, class_name, document_id), valid in that act only."""
    member = entities.select("entity_id", F.lower("name").alias("_m"))
    group = entities.where("kind = 'class'").select(F.col("entity_id").alias("class_id"), F.lower("name").alias("_c"))
    return rows.withColumns({"_m": F.lower("member_name"), "_c": F.lower("class_name")}).join(member, "_m").join(group, "_c").select("entity_id", "class_id", "document_id").distinct()


# --- decisions ------------------------------------------------------------------------------------


def apply_links(decisions: DataFrame, book: Dictionary) -> tuple[Dictionary, DataFrame]:
    """(dictionary, counts) after decisions (name, decision, entity_id) on names of actors.

    ``match`` with a known id makes the name an alias, unless it is that entity's own; ``class`` and
    ``office`` make an entity, unless one of that kind and name is there; ``none`` does nothing.  All else
    is invalid.  Nameless rows are left out.  Counts are of decisions, not of what they changed.
    """
    rows = decisions.where("name <> ''").join(book.entities.select("entity_id", F.lower("name").alias("_own")), "entity_id", "left")
    valid = F.when(F.col("decision") == "match", F.when(F.col("_own").isNotNull(), "match")).when(F.col("decision").isin("class", "office", "none"), F.col("decision"))
    rows = rows.withColumn("outcome", F.coalesce(valid, F.lit("invalid")))
    links = rows.where("outcome = 'match' and lower(name) <> _own").select("entity_id", F.col("name").alias("alias"), F.lit("actor_name").alias("alias_kind"), F.lit("decision").alias("source")).withColumn("_l", F.lower("alias"))
    held = book.aliases.select("entity_id", F.lower("alias").alias("_l")).distinct()
    fresh = distinct_on(links.join(held, ["entity_id", "_l"], "left_anti"), ["entity_id", "_l"], [F.col("alias")])
    entities = book.entities
    for kind in ("class", "office"):
        entities = with_new(entities, rows.where(F.col("outcome") == kind).select("name", F.lit(kind).alias("kind")), F.col("kind") == kind)
    counts = rows.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
    return Dictionary(entities, shaped(book.aliases, ALIAS).unionByName(shaped(fresh, ALIAS))), counts
