"""The amendment register: listing, summaries, coverage and confirmation against the texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.operators.keyed import as_of_pair


def affected_arrays(refs: DataFrame) -> DataFrame:
    """Distinct section numbers and kinds of each effect's affected side, sorted; null instead of empty."""
    own = refs.where("side = 'affected'").groupBy("effect_id").agg(F.array_sort(F.collect_set("section_number")).alias("n"), F.array_sort(F.collect_set("provision_kind")).alias("k"))
    return own.select("effect_id", F.when(F.size("n") > 0, F.col("n")).alias("affected_section_numbers"), F.when(F.size("k") > 0, F.col("k")).alias("affected_provision_kinds"))


def list_effects(effects: DataFrame, refs: DataFrame, *, direction: str = "affected", document_id=None, after=None, through=None, textual_only: bool = False, limit: int | None = 500) -> DataFrame:
    """Effects of a document in a half-open window of dates, with the provisions they affect.

    Undated effects drop out only where a bound is given.  References are aggregated for the effects of
    the page alone.
    """
    if direction not in ("affected", "affecting"):
        raise ValueError("direction must be affected or affecting")
    if document_id is not None:
        effects = effects.where(F.col(f"{direction}_document_id") == document_id)
    if after is not None:
        effects = effects.where(F.col("in_force_date") > F.lit(after).cast("date"))
    if through is not None:
        effects = effects.where(F.col("in_force_date") <= F.lit(through).cast("date"))
    if textual_only:
        effects = effects.where("textual_kind = 'T'")
    if limit is not None:
        effects = effects.orderBy(F.col("in_force_date").desc_nulls_last(), "effect_id").limit(limit)
    own = refs.join(effects.select("effect_id"), "effect_id", "left_semi")
    return effects.join(affected_arrays(own), "effect_id", "left")


def changesets(effects: DataFrame, documents: DataFrame) -> DataFrame:
    """For each affecting and affected document: counts, dates, and whether the corpus holds the affected one."""
    known = documents.select(F.col("id").alias("affected_document_id"), F.col("title").alias("own_title"))
    joined = effects.join(known, "affected_document_id", "left")
    return joined.groupBy("affecting_document_id", "affected_document_id").agg(
        F.coalesce(F.max("affected_title"), F.max("own_title")).alias("affected_title"),
        F.count(F.lit(1)).alias("effect_count"),
        F.count_if(F.col("textual_kind") == "T").alias("textual_count"),
        F.count_if("applied").alias("applied_count"),
        F.count_if("prospective").alias("prospective_count"),
        F.min("in_force_date").alias("first_in_force"),
        F.max("in_force_date").alias("last_in_force"),
        F.coalesce(F.bool_or(F.col("own_title").isNotNull()), F.lit(False)).alias("in_corpus"),
    )


def changeset_totals(changes: DataFrame) -> DataFrame:
    return changes.groupBy("affecting_document_id").agg(*[F.sum(c).alias(c) for c in ("effect_count", "textual_count", "applied_count", "prospective_count")], F.count(F.lit(1)).alias("documents"))


def effects_coverage(effects: DataFrame, refs: DataFrame | None, provisions: DataFrame) -> DataFrame:
    """For each affected document: effects, textual, applied, and those with a reference that a provision answers.

    Without ``refs`` each effect has one reference and carries it as section_number and provision_kind: no
    effect is then looked up by its id; effects are counted by document and reference, where the provisions meet them.
    """
    if refs is None:
        return _coverage_of_single(effects, provisions)
    owned = refs.where("side = 'affected'").join(effects.select("effect_id", F.col("affected_document_id").alias("document_id")), "effect_id")
    keys = provisions.select("document_id", F.col("number").alias("section_number"), F.col("provision_type").alias("provision_kind"))
    matched = owned.join(keys, ["document_id", "section_number", "provision_kind"], "left_semi").select("effect_id").distinct().withColumn("matched", F.lit(True))
    return effects.join(matched, "effect_id", "left").groupBy(F.col("affected_document_id").alias("document_id")).agg(
        F.count(F.lit(1)).alias("effects"), F.count_if(F.col("textual_kind") == "T").alias("textual"), F.count_if("applied").alias("applied"), F.count_if("matched").alias("provision_matched")
    )


def _coverage_of_single(effects: DataFrame, provisions: DataFrame) -> DataFrame:
    key = ["document_id", "section_number", "provision_kind"]
    count = lambda c: F.coalesce(c, F.lit(False)).cast("long")
    asked = effects.select(F.col("affected_document_id").alias("document_id"), *key[1:], F.lit(1).cast("long").alias("effects"), count(F.col("textual_kind") == "T").alias("textual"), count(F.col("applied")).alias("applied"), F.lit(False).alias("answered"))
    none = [F.lit(0).cast("long").alias(c) for c in ("effects", "textual", "applied")]
    held = provisions.where("document_id is not null and number is not null and provision_type is not null").select("document_id", F.col("number").alias("section_number"), F.col("provision_type").alias("provision_kind"), *none, F.lit(True).alias("answered"))
    met = asked.unionByName(held).groupBy(*key).agg(*[F.sum(c).alias(c) for c in ("effects", "textual", "applied")], F.max("answered").alias("answered"))
    own = met.groupBy("document_id").agg(*[F.sum(c).alias(c) for c in ("effects", "textual", "applied")], F.sum(F.when(F.col("answered"), F.col("effects")).otherwise(0)).alias("provision_matched"))
    return own.where("effects > 0")


def confirmation_facts(effects: DataFrame, refs: DataFrame, versions: DataFrame, provisions: DataFrame, *, match_extent: bool = False) -> DataFrame:
    """For each applied textual effect: what the versions around its date say of the provisions it names.

    ``match_extent`` compares a provision's reading for an extent with that of the same extent only.
    """
    live = effects.where("in_force_date is not null and applied and textual_kind = 'T'").select("effect_id", F.col("affected_document_id").alias("document_id"), "in_force_date")
    paired = as_of_pair(live, versions, "document_id", "in_force_date", "snapshot_date", "version_id", "effect_id")
    eff = paired.join(refs.where("side = 'affected' and section_number is not null").select("effect_id", "section_number", "provision_kind"), "effect_id")
    p = provisions.select("version_id", F.col("number").alias("section_number"), F.col("provision_type").alias("provision_kind"), F.col("text_sha256"), F.coalesce("extent", F.lit("")).alias("extent"))
    before = p.select(F.col("version_id").alias("before_id"), "section_number", "provision_kind", F.col("text_sha256").alias("b"), F.col("extent").alias("be"))
    after = p.select(F.col("version_id").alias("after_id"), "section_number", "provision_kind", F.col("text_sha256").alias("a"), F.col("extent").alias("ae"))
    both = eff.join(before, ["before_id", "section_number", "provision_kind"], "left")
    if match_extent:
        both = both.withColumn("ae", F.col("be")).join(after, ["after_id", "section_number", "provision_kind", "ae"], "left")
    else:
        both = both.join(after, ["after_id", "section_number", "provision_kind"], "left")
    b, a = F.col("b"), F.col("a")
    ranged = F.col("before_id").isNotNull() & F.col("after_id").isNotNull()
    return both.groupBy("document_id", "effect_id").agg(
        F.bool_or(~ranged).alias("outside_range"),
        F.bool_or(b.isNotNull() & a.isNotNull() & F.coalesce(b != a, F.lit(False))).alias("text_differs"),
        F.bool_or((b.isNull() != a.isNull()) & ranged).alias("presence_changed"),
        F.bool_or(b.isNotNull() & a.isNotNull() & F.coalesce(b == a, F.lit(False))).alias("text_identical"),
        F.bool_and(b.isNull() & a.isNull()).alias("provision_absent"),
    )


def verify_effects(facts: DataFrame) -> DataFrame:
    """For each document how many effects the texts confirm; the classes may overlap as facts do."""
    moved = F.col("text_differs") | F.col("presence_changed")
    return facts.groupBy("document_id").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("outside_range") & ~moved).alias("outside_range"),
        F.count_if("provision_absent").alias("provision_absent"),
        F.count_if(F.col("presence_changed") & ~F.col("text_differs")).alias("presence_changed"),
        F.count_if("text_differs").alias("text_differs"),
        F.count_if(F.col("text_identical") & ~moved).alias("text_identical"),
    )


def confirmation_rates(verified: DataFrame) -> DataFrame:
    """Counts by document and a TOTAL row, with the share of checkable effects that is confirmed."""
    sums = ("total", "outside_range", "provision_absent", "presence_changed", "text_differs", "text_identical")
    rolled = verified.rollup("document_id").agg(*[F.sum(c).alias(c) for c in sums], F.grouping("document_id").alias("g"))
    confirmed = F.col("text_differs") + F.col("presence_changed")
    checkable = confirmed + F.col("text_identical")
    return rolled.select(
        F.when(F.col("g") == 1, "TOTAL").otherwise(F.col("document_id").cast("string")).alias("document"), *sums, confirmed.alias("confirmed"), checkable.alias("checkable"),
        F.when(checkable > 0, F.round(confirmed / checkable, 6)).alias("rate"),
    )
