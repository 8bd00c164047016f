"""Duties, their enrichment, and the dictionary of bodies that they name."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexloom.functions import text as t
from lexloom.operators import closest
from lexloom.operators.closest import Shelf
from lexloom.operators.keyed import SMALL, distinct_on, numbered


def staged_duties(raw: DataFrame) -> DataFrame:
    """Trimmed and normalised rows of the duties file, empty fields null."""
    clean = lambda c: t.or_null(F.trim(F.col(c)))
    rows = raw.withColumn("enactment", F.trim("enactment")).withColumn("section", F.trim("section"))
    path = t.section_path(F.col("section"), F.col("enactment"))
    rows = rows.withColumn("section_path", path).withColumn("document_id", t.document_id_of(F.col("enactment"))).withColumn("_p", t.path_provision(F.col("section_path")))
    return rows.select(
        F.trim("duty_uri").alias("duty_uri"), clean("dutyTempId").cast("long").alias("source_temp_id"), F.col("enactment").alias("enactment_uri"), "document_id",
        F.coalesce(F.split_part("document_id", F.lit("/"), F.lit(1)), F.trim("enactmentType")).alias("enactment_type"), clean("enactmentTitle").alias("enactment_title"),
        F.col("section").alias("section_uri"), "section_path", F.col("_p.kind").alias("provision_kind"), F.col("_p.number").alias("provision_number"), t.split_list(F.col("subsection")).alias("subsections"),
        clean("actor").alias("actor"), clean("actorIsBody").alias("actor_is_body"), clean("actorIsAlias").alias("actor_is_alias"), clean("body_uri").alias("body_uri"), t.modality(F.col("modality")).alias("modality"),
        clean("action").alias("action"), clean("condition").alias("condition"), t.enum_or_null(F.col("inference"), ("explicit", "implicit")).alias("inference"), t.enum_or_null(F.col("priority"), ("primary", "secondary")).alias("priority"),
    )


def first_duties(raw: DataFrame) -> DataFrame:
    """The raw row that stands for each duty: the first by temporary id, action and actor, then by all its fields.

    An aggregate, combined before its shuffle, so what a duty's other rows hold does not travel.
    """
    clean = lambda c: t.or_null(F.trim(F.col(c)))
    order = [x for c in (clean("dutyTempId").cast("long"), clean("action"), clean("actor")) for x in (c.isNull(), c)]
    best = raw.groupBy(F.trim("duty_uri").alias("_uri")).agg(F.min(F.struct(F.struct(*order).alias("o"), F.struct(*[F.col(c) for c in raw.columns]).alias("r"))).alias("b"))
    return best.select("b.r.*")


def load_duties(raw: DataFrame, documents: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(duties, actor matches, counts): the first row of each duty, each body it names once, and what the corpus lacks.

    Only the rows that stay are normalised whole; of the others just the names of bodies are read.
    """
    duties = staged_duties(first_duties(raw))
    clean = lambda c: t.or_null(F.trim(F.col(c)))
    own = raw.select(F.trim("duty_uri").alias("duty_uri"), clean("actorIsBody").alias("body"), clean("actorIsAlias").alias("alias"), clean("body_uri").alias("uri"))
    named = F.array(
        F.struct(F.col("body").alias("body_name"), F.lit("direct").alias("match_kind"), F.when(F.col("alias").isNull(), F.col("uri")).alias("body_uri")),
        F.struct(F.col("alias").alias("body_name"), F.lit("alias").alias("match_kind"), F.col("uri").alias("body_uri")),
    )
    matches = own.select("duty_uri", F.explode(named).alias("m")).select("duty_uri", "m.*").where("body_name is not null").groupBy("duty_uri", "body_name", "match_kind").agg(F.max("body_uri").alias("body_uri"))
    counts = duties.join(documents.select(F.col("id").alias("document_id"), F.lit(1).alias("known")), "document_id", "left").agg(F.count(F.lit(1)).alias("duties"), F.count_if(F.col("known").isNull()).alias("unlinked_documents"))
    return duties, matches, counts


def load_enrichment(rows: DataFrame, duties: DataFrame, entities: DataFrame, aliases: DataFrame, instruments: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """(enrichments, targets) of rows (id, targets, is_direction_power, instrument) whose duty is known.

    Unknown instruments become other; a target resolves to the entity of that name, else of that alias,
    in any case of letters, the smallest id if several.
    """
    known = rows.where("id is not null").join(duties.select(F.col("duty_id").alias("id")), "id", "left_semi")
    known = known.withColumn("instrument", F.when(F.col("instrument").isin(*instruments), F.col("instrument")).otherwise("other")).withColumn("is_direction_power", F.coalesce("is_direction_power", F.lit(False)))
    enrichments = distinct_on(known, ["id"], [F.col("instrument"), F.col("is_direction_power").desc()]).select(F.col("id").alias("duty_id"), "instrument", "is_direction_power")
    words = known.select(F.col("id").alias("duty_id"), F.explode("targets").alias("x")).select("duty_id", t.or_null(F.trim("x")).alias("target_text")).where("target_text is not null")
    single = words.withColumn("_l", F.lower("target_text")).groupBy("duty_id", "_l").agg(F.min("target_text").alias("target_text"))
    exact = entities.groupBy(F.lower("name").alias("_l")).agg(F.min("entity_id").alias("by_name"))
    other = aliases.groupBy(F.lower("alias").alias("_l")).agg(F.min("entity_id").alias("by_alias"))
    resolved = single.join(exact, "_l", "left").join(other, "_l", "left")
    return enrichments, resolved.select("duty_id", "target_text", F.coalesce("by_name", "by_alias").alias("entity_id"), F.when(F.col("by_name").isNotNull(), "exact").when(F.col("by_alias").isNotNull(), "alias").otherwise("unresolved").alias("resolution"))


def histogram(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def new_aliases(candidates: DataFrame, entities: DataFrame, aliases: DataFrame) -> DataFrame:
    """Aliases (entity_id, alias, alias_kind) that say something their entity's name does not and are not held yet."""
    rows = candidates.join(entities.select("entity_id", "name"), "entity_id").where(t.match_name(F.col("alias")) != t.match_name(F.col("name")))
    held = aliases.select("entity_id", F.lower("alias").alias("_l")).distinct()
    fresh = rows.withColumn("_l", F.lower("alias")).join(held, ["entity_id", "_l"], "left_anti")
    return distinct_on(fresh, ["entity_id", "_l"], [F.col("alias"), F.col("alias_kind")]).select("entity_id", "alias", "alias_kind")


def former_names(register: DataFrame) -> DataFrame:
    """Closed entities' names as aliases of their successor, one step on."""
    return register.where("successor_id is not null").select(F.col("successor_id").alias("entity_id"), F.col("name").alias("alias"), F.lit("former").alias("alias_kind"))


def unresolved_actors(duties: DataFrame, entities: DataFrame, aliases: DataFrame) -> DataFrame:
    """Distinct actors that neither an entity nor an alias names, with how many duties name them."""
    known = entities.select(F.lower("name").alias("_l")).union(aliases.select(F.lower("alias"))).distinct()
    return duties.where("actor is not null").withColumn("_l", F.lower("actor")).join(known, "_l", "left_anti").groupBy("_l").agg(F.min("actor").alias("actor"), F.count(F.lit(1)).alias("duties"))


def resolution_ratio(duties: DataFrame, entities: DataFrame, aliases: DataFrame) -> DataFrame:
    names = duties.select(F.lower("actor").alias("_l")).where("_l is not null").distinct()
    known = entities.select(F.lower("name").alias("_l")).union(aliases.select(F.lower("alias"))).distinct().withColumn("known", F.lit(True))
    return names.join(known, "_l", "left").agg(F.count(F.lit(1)).alias("names"), F.count_if("known").alias("resolved"))


#: Keys of the catalogue, and keys of names, that one task compares with each other at most; of fewer names than the
#: latter, LEAST_NAMES at least make a task.
SHARD_KEYS, BLOCK_NAMES, LEAST_NAMES = 100_000, 10_000, 500
#: Tasks at most, some of which then compare several pairs of them.
MAX_TASKS = 20_000


def fuzzy_candidates(names: DataFrame, catalogue: DataFrame, *, n: int = 8, cutoff: float = 0.72, keep: int = 6) -> DataFrame:
    """(name, entity_id, display, ratio, rank): for each name the closest catalogue entries (entity_id, display).

    Close are the ``n`` best keys with a ratio of at least ``cutoff``, and for names longer than 8
    characters keys that contain the name or lie in it.  A name that has no letters or digits, or is null, has none.
    Names and entries of one key are compared once.  Blocks of names' keys meet shards of the catalogue's, each
    pair of them in a task of its own, whatever the sizes of both; a shard's best are merged by name.
    """
    keyed = catalogue.select(t.match_name(F.col("display")).alias("near"), F.col("entity_id").cast("long").alias("entity_id"), "display").where("near <> ''")
    asked = names.select("name", t.match_name(F.col("name")).alias("key")).where("key <> ''")
    size = keyed.agg(F.approx_count_distinct("near").alias("keys"), F.sum(F.octet_length("near") + F.octet_length("display") + 16).alias("bytes")).first()
    wanted, wide = asked.agg(F.approx_count_distinct("key").alias("c")).first()["c"], 2 * names.sparkSession.sparkContext.defaultParallelism
    shards, blocks = size["keys"] // SHARD_KEYS + 1, max(wanted // BLOCK_NAMES, min(wanted // LEAST_NAMES, wide)) + 1
    # Both sides give their numbers in one type, since an int and a long of the same value go to different partitions.
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    part = lambda c, k: F.pmod(F.xxhash64(c), F.lit(k)).cast("int")
    book = keyed.select("near").distinct().select("near", part("near", shards).alias("shard"), every(blocks).alias("block"))
    keys = asked.select("key").distinct().select("key", every(shards).alias("shard"), part("key", blocks).alias("block"))

    def match(left: pa.Table, right: pa.Table) -> pa.Table:
        shelf, own = Shelf(sorted(right["near"].to_pylist())), left["key"].to_pylist()
        # Closeness is the ratio from the key to the name, which is not always the one from the name to the key.
        held, score = shelf.closest(own, n, cutoff)
        row, slot = np.nonzero(held >= 0)
        long = [i for i, k in enumerate(own) if len(k) > 8]
        whose, inner = shelf.inside([own[i] for i in long])
        pairs = lambda i, k: i * max(1, len(shelf.keys)) + k
        close, inside = pairs(row, held[row, slot]), np.unique(pairs(np.array(long, np.int64)[whose], inner))
        both = np.unique(np.concatenate([close, inside]))
        i, k = both // max(1, len(shelf.keys)), both % max(1, len(shelf.keys))
        scores = np.full(len(both), np.nan)
        scores[np.searchsorted(both, close)] = score[row, slot]
        columns = [left["key"].take(i), pa.array(shelf.keys, pa.string()).take(pa.array(k)), pa.array(scores, from_pandas=True), pa.array(np.isin(both, inside)), pa.array(shelf.ratios(closest.Texts(own), i, k))]
        return pa.table(columns, ["key", "near", "score", "inside", "ratio"])

    # A number of partitions that is given stays: the pairs are small in bytes and long in work, and would be put together else.
    dealt = lambda df: df.repartition(min(shards * blocks, MAX_TASKS), "shard", "block").groupBy("shard", "block")
    found = dealt(keys).cogroup(dealt(book)).applyInArrow(match, "key string, near string, score double, inside boolean, ratio double")
    # Of all shards' close keys the best n stay; a tie goes to the later key, as within a shard.
    best = Window.partitionBy("key").orderBy(F.col("score").desc_nulls_last(), F.col("near").desc())
    left = found.withColumn("_k", F.dense_rank().over(best)).where((F.col("score").isNotNull() & (F.col("_k") <= n)) | F.col("inside"))
    # All entries of a key rank by their ids alone, so the first ``keep`` of each are enough.
    entries = keyed.groupBy("near", "entity_id").agg(F.min("display").alias("display"))
    entries = entries.withColumn("_n", F.row_number().over(Window.partitionBy("near").orderBy("entity_id"))).where(F.col("_n") <= keep).drop("_n")
    entries = F.broadcast(entries) if (size["bytes"] or 0) <= SMALL else entries
    one = distinct_on(left.join(entries, "near"), ["key", "entity_id"], [F.col("ratio").desc(), F.col("near")])
    ranked = one.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy(F.col("ratio").desc(), "entity_id"))).where(F.col("rank") <= keep)
    return asked.distinct().join(ranked, "key").select("name", "entity_id", "display", "ratio", "rank")


def scoped_members(definitions: DataFrame, entities: DataFrame) -> DataFrame:
    """(entity_id, class_id, document_id) of definitions (class_name, member_name, document_id), valid in that document only."""
    member = entities.select(F.col("entity_id"), F.lower("name").alias("_m"))
    group = entities.select(F.col("entity_id").alias("class_id"), F.lower("name").alias("_c"))
    rows = definitions.withColumn("_m", F.lower("member_name")).withColumn("_c", F.lower("class_name"))
    return rows.join(member, "_m").join(group, "_c").select("entity_id", "class_id", "document_id").distinct()


def apply_decisions(decisions: DataFrame, entities: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(aliases, new entities, counts) of decisions (name, entity_id, kind): an id links, a kind without id creates, else skipped."""
    valid = decisions.join(entities.select("entity_id", F.lit(True).alias("known")), "entity_id", "left")
    outcome = F.when(F.col("known"), "linked").when(F.col("entity_id").isNull() & F.col("kind").isNotNull(), "created").otherwise("skipped")
    rows = valid.withColumn("outcome", outcome)
    top = entities.agg(F.max("entity_id").alias("m")).first()["m"] or 0  # one number
    created = numbered(rows.where("outcome = 'created'").select("name", "kind").distinct(), ["name", "kind"], top)
    fresh = created.select(F.col("_number").alias("entity_id"), "name", "kind")
    return rows.where("outcome = 'linked'").select("entity_id", F.col("name").alias("alias")).distinct(), fresh, histogram(rows, "outcome")
