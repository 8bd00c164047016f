"""Ranked search of powers and duties against a plan."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Document types of either kind of legislation; some types are in neither.
PRIMARY = ("ukpga", "asp", "anaw", "asc", "apni", "aep", "apgb", "aip", "nia", "ukla", "ukcm", "mwa", "mnia", "aosp", "ukppa", "gbla")
SECONDARY = ("uksi", "ssi", "wsi", "nisr", "nisi", "nisro", "eur", "eudn", "eudr")
#: Best rows by words that are ranked on; None ranks all.
CANDIDATES = 4000
SCALE = 10_000
WEIGHTS = {"target": 4000, "instrument": 2500, "direction": 3000, "title": 2500, "action": 2000}


@dataclass
class Plan:
    terms: list[str] = field(default_factory=list)
    targets: list[str] = field(default_factory=list)
    instruments: list[str] = field(default_factory=list)
    domain: list[str] = field(default_factory=list)
    actor: str | None = None
    modality: str = "power"
    legislation_kind: str = "all"
    direction_only: bool = False
    with_conditions_only: bool = False
    limit: int = 20
    candidates: int | None = CANDIDATES

    def checked(self) -> Plan:
        self.limit = max(1, min(100, self.limit))
        if self.modality not in ("power", "duty", "both") or self.legislation_kind not in ("all", "primary", "secondary"):
            raise ValueError("unknown modality or kind of legislation")
        for pattern in [*self.domain, *([self.actor] if self.actor else [])]:
            re.compile(pattern)
        return self


def query_terms(terms: list[str]) -> list[list[str]]:
    """Words of each term, without operators, quotes and brackets; with none left, the word "power"."""
    out = []
    for term in terms:
        words = re.sub(r"(^|\s)-+", " ", re.sub(r'["()]', " ", term)).split()
        words = [w.lower() for w in words if w.lower() not in ("or", "and")]
        if words:
            out.append(words)
    return out or [["power"]]


def text_rank(tokens: Column, terms: list[list[str]]) -> Column:
    """Share of terms of which all words occur among ``tokens``, in units of 1 / SCALE; 0 is no match."""
    hits = reduce(lambda a, b: a + b, [reduce(lambda a, b: a & b, [F.array_contains(tokens, w) for w in words]).cast("int") for words in terms])
    return F.floor(hits * SCALE / len(terms)).cast("long")


def tokens_of(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^a-z0-9]+"), lambda w: w != ""))


def ilike_any(column: Column, patterns: list[str]) -> Column:
    """Substring match with any pattern; no patterns match nothing."""
    return reduce(lambda a, b: a | b, [column.ilike(f"%{p}%") for p in patterns], F.lit(False))


def target_hits(patterns: list[str], duties: DataFrame, targets: DataFrame, entities: DataFrame, members: DataFrame) -> DataFrame:
    """(duty_id) of powers over a body: by the target's words, by its entity's name, or by a class that the act gives the body."""
    direct = targets.where(ilike_any(F.col("target_text"), patterns)).select("duty_id")
    named = entities.where(ilike_any(F.col("name"), patterns)).select("entity_id")
    by_entity = targets.join(named, "entity_id", "left_semi").select("duty_id")
    classes = members.join(named, "entity_id", "left_semi").select(F.col("class_id").alias("entity_id"), "document_id")
    by_class = targets.join(duties.select("duty_id", "document_id"), "duty_id").join(classes, ["entity_id", "document_id"], "left_semi").select("duty_id")
    return direct.union(by_entity).union(by_class).distinct()


def search_powers(plan: Plan, duties: DataFrame, enrichments: DataFrame, targets: DataFrame, entities: DataFrame, members: DataFrame) -> DataFrame:
    """The best ``plan.limit`` powers with score (whole units of 1 / SCALE) and their distinct targets.

    Candidates are the ``plan.candidates`` best by words (None: all of them) and all target hits; targets
    are looked up for the rows that are returned only.
    """
    plan = plan.checked()
    terms = query_terms(plan.terms)
    fits = F.lit(True)
    if plan.modality != "both":
        fits = fits & (F.col("modality") == plan.modality)
    if plan.actor:
        fits = fits & F.col("actor").rlike("(?i)" + plan.actor)
    ranked = duties.where(fits).withColumn("text_rank", text_rank(tokens_of(F.concat_ws(" ", "action", "condition")), terms))
    matched = ranked.where("text_rank > 0")
    if plan.candidates is not None:
        matched = matched.orderBy(F.col("text_rank").desc(), "duty_id").limit(plan.candidates)
    matched = matched.select("duty_id", F.lit(False).alias("hit"))
    hits = target_hits(plan.targets, duties, targets, entities, members).select("duty_id", F.lit(True).alias("hit")) if plan.targets else None
    found = (matched.union(hits) if hits is not None else matched).groupBy("duty_id").agg(F.bool_or("hit").alias("hit"))
    rows = ranked.join(found, "duty_id").join(enrichments, "duty_id")
    if plan.direction_only:
        rows = rows.where("is_direction_power")
    if plan.with_conditions_only:
        rows = rows.where("condition is not null")
    if plan.legislation_kind != "all":
        rows = rows.where(F.col("enactment_type").isin(*(PRIMARY if plan.legislation_kind == "primary" else SECONDARY)))
    points = lambda cond, name: F.when(cond, WEIGHTS[name]).otherwise(0)
    score = F.col("text_rank") + points(F.col("hit"), "target") + points(F.col("instrument").isin(*plan.instruments) if plan.instruments else F.lit(False), "instrument")
    if "direct" in plan.instruments:
        score = score + points(F.col("is_direction_power"), "direction")
    if plan.domain:
        pattern = "(?i)" + "|".join(plan.domain)
        score = score + points(F.col("enactment_title").rlike(pattern), "title") + points(F.col("action").rlike(pattern), "action")
    best = rows.withColumn("score", score.cast("long")).orderBy(F.col("score").desc(), "duty_id").limit(plan.limit)
    texts = targets.join(best.select("duty_id"), "duty_id", "left_semi").groupBy("duty_id").agg(F.array_sort(F.collect_set("target_text")).alias("targets"))
    return best.join(texts, "duty_id", "left").withColumn("targets", F.coalesce("targets", F.array().cast("array<string>")))


#: Fixed value: actors that a script's search takes for ministers.
SCRIPT_MINISTERS = "secretary of state|^the ministers?$|^ministers?$|treasury|lord chancellor|scottish ministers|welsh ministers"


def phrase_rank(text: Column, phrases: list[str]) -> Column:
    """Share of phrases whose words stand side by side in ``text``, in units of 1 / SCALE; 0 is no match."""
    spaced = F.concat(F.lit(" "), F.array_join(F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^a-z0-9]+"), lambda w: w != ""), " "), F.lit(" "))
    plain = [" ".join(re.findall(r"[a-z0-9]+", p.lower())) for p in phrases]
    hits = reduce(lambda a, b: a + b, [spaced.contains(f" {p} ").cast("int") for p in plain])
    return F.floor(hits * SCALE / len(plain)).cast("long")


def search_by_phrases(plan: Plan, duties: DataFrame, enrichments: DataFrame, targets: DataFrame, entities: DataFrame, members: DataFrame, ministerial_only: bool = True) -> DataFrame:
    """The best ``plan.limit`` powers by phrases: terms and targets alike are phrases, any of which may match.

    Only powers are searched (modality power or both), all that match are ranked, and what a plan says of
    actors, kinds and conditions is not asked; ``ministerial_only`` takes the actors that are ministers.
    """
    plan = plan.checked()
    phrases = [x for x in (*plan.terms, *plan.targets) if re.search(r"[A-Za-z0-9]", x)] or ["power"]
    rows = duties.where("modality in ('power', 'both')")
    if ministerial_only:
        rows = rows.where(F.col("actor").rlike("(?i)" + SCRIPT_MINISTERS))
    ranked = rows.withColumn("text_rank", phrase_rank(F.concat_ws(" ", "action", "condition"), phrases))
    hits = target_hits(plan.targets, duties, targets, entities, members) if plan.targets else duties.select("duty_id").limit(0)
    found = ranked.join(hits.withColumn("hit", F.lit(True)), "duty_id", "left").where((F.col("text_rank") > 0) | F.col("hit")).join(enrichments, "duty_id")
    points = lambda cond, name: F.when(cond, WEIGHTS[name]).otherwise(0)
    pattern = "(?i)" + "|".join(plan.domain)
    score = F.col("text_rank") + points(F.col("hit"), "target") + points(F.col("instrument").isin(*plan.instruments) if plan.instruments else F.lit(False), "instrument")
    score = score + points(F.col("is_direction_power") if "direct" in plan.instruments else F.lit(False), "direction")
    score = score + points(F.col("enactment_title").rlike(pattern) if plan.domain else F.lit(False), "title") + points(F.col("action").rlike(pattern) if plan.domain else F.lit(False), "action")
    return found.withColumn("score", score.cast("long")).orderBy(F.col("score").desc(), "duty_id").limit(plan.limit)
