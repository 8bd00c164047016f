"""Landed feed pages (path, content) to rows: year lists, amendment effects, publication events."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.functions import text as t
from lexloom.sources.clml import ATOM, DC, LEG, UKM

LOG = "{http://www.legislation.gov.uk/namespaces/publication-log}"
LISTED = "legislation_type string, year int, number int, title string, document_id string"
EFFECT = (
    "effect_id string, uri string, effect_type string, applied boolean, requires_applied boolean, prospective boolean, in_force_date string, qualification string, commencing_document_id string, "
    "affected_document_id string, affected_title string, affected_provisions string, affecting_document_id string, affecting_title string, affecting_provisions string, comments string, modified string, "
    "refs array<struct<side:string,ref:string,uri:string,label:string>>, more_pages int"
)
EVENT = "document_id string, legislation_type string, title string, updated string, is_new boolean, is_republished boolean, more_pages int"


def names(schema: str) -> list[str]:
    return re.findall(r"(?:^|, )(\w+) ", re.sub(r"<.*?>+", "", schema))


def document_id(address: str | None) -> str | None:
    parts = [p for p in urlsplit(address or "").path.split("/") if p]
    return "/".join(parts[parts[:1] == ["id"] :]) or None


def listed(address: str, title: str) -> tuple:
    parts = (document_id(address) or "").split("/")
    number = lambda k: int(parts[k]) if len(parts) > k and parts[k].isdigit() else 0
    return parts[0], number(1), number(2), title, "/".join(parts)


def pages_left(root: ElementTree.Element) -> int:
    text = root.findtext(f"{LEG}morePages") or ""
    return int(text) if text.isdigit() else 0


def year_rows(root: ElementTree.Element) -> Iterator[tuple]:
    for entry in root.iterfind(f"{ATOM}entry"):
        links = {a.get("rel"): a.get("href") for a in reversed(entry.findall(f"{ATOM}link"))}
        address, title = links.get("self", links.get("alternate")), entry.findtext(f"{ATOM}title")
        if address is not None and title is not None:
            yield listed(address, title)


def effect_rows(root: ElementTree.Element) -> Iterator[tuple]:
    for e in root.iter(f"{UKM}Effect"):
        if e.get("EffectId") is None:
            continue
        forces = list(e.iter(f"{UKM}InForce"))
        dated = [f for f in forces if re.fullmatch(r"\d{4}-\d{2}-\d{2}", f.get("Date") or "")]
        first = min(dated, key=lambda f: f.get("Date"), default=None)  # the first in the feed of equal dates
        some = lambda k: e.get(k) or None
        refs = []
        for side, tag in (("affected", "AffectedProvisions"), ("affecting", "AffectingProvisions"), ("commencing", "CommencementAuthority")):
            box = e.find(f"{UKM}{tag}")
            refs += [{"side": side, "ref": s.get("Ref"), "uri": s.get("URI"), "label": " ".join("".join(s.itertext()).split())} for s in (box if box is not None else ()) if s.tag.rpartition("}")[2] in ("Section", "SectionRange")]
        yield (
            e.get("EffectId"), e.get("URI"), e.get("Type", ""), e.get("Applied") == "true", e.get("RequiresApplied") == "true", first is None and any(f.get("Prospective") == "true" for f in forces),
            first.get("Date") if first is not None else None, (first.get("Qualification") or None) if first is not None else None, document_id(first.get("CommencingURI")) if first is not None else None,
            document_id(e.get("AffectedURI")), e.findtext(f"{UKM}AffectedTitle") or None, some("AffectedProvisions"), document_id(e.get("AffectingURI")), e.findtext(f"{UKM}AffectingTitle") or None,
            some("AffectingProvisions"), some("Comments"), e.get("Modified"), refs, pages_left(root),
        )


def event_rows(root: ElementTree.Element) -> Iterator[tuple]:
    for entry in root.iterfind(f"{ATOM}entry"):
        own = entry.findtext(f"{DC}identifier")
        if own is not None and entry.findtext(f"{LOG}ContentType") == "legislation":
            found = listed(own, entry.findtext(f"{ATOM}title") or "")
            yield found[4], found[0], found[3], entry.findtext(f"{ATOM}updated") or "", entry.findtext(f"{LOG}New") == "true", entry.findtext(f"{LOG}Republished") == "true", pages_left(root)


def parsed(pages: DataFrame, rows: Callable[[ElementTree.Element], Iterator[tuple]], schema: str) -> DataFrame:
    """Rows of every page of (path, content), with ``feed_error`` for pages that are no XML."""
    columns = names(schema)

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for path, content in zip(frame["path"], frame["content"], strict=True):
                try:
                    out += [(path, *r, None) for r in rows(ElementTree.fromstring(bytes(content or b"")))]
                except ElementTree.ParseError as e:
                    out.append((path, *[None] * len(columns), str(e)))
            yield pd.DataFrame(out, columns=["path", *columns, "feed_error"], dtype=object)

    return pages.select("path", "content").mapInPandas(parse, f"path string, {schema}, feed_error string")


def parse_year_feed(pages: DataFrame) -> DataFrame:
    return parsed(pages, year_rows, LISTED)


def parse_effects(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(effects, refs): effects with their textual kind, and each provision they name with its kind and number."""
    rows = parsed(pages, effect_rows, EFFECT)
    effects = rows.where("effect_id is not null").withColumn("textual_kind", t.textual_kind(F.col("effect_type"))).withColumn("in_force_date", F.to_date("in_force_date"))
    refs = effects.select("effect_id", F.explode("refs").alias("r")).select("effect_id", "r.*")
    own = t.provision_ref(F.col("ref"), F.col("label"))
    return effects.drop("refs"), refs.withColumn("p", own).select("effect_id", "side", "ref", "uri", "label", F.col("p.kind").alias("provision_kind"), F.col("p.number").alias("section_number"))


def parse_publication_log(pages: DataFrame) -> DataFrame:
    return parsed(pages, event_rows, EVENT)


def crawl_plan(types: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """(legislation_type, year) of types (legislation_type, start_year, end_year) within the asked years; null bounds are open."""
    low = F.greatest(F.coalesce("start_year", F.lit(first_year)), F.lit(first_year))
    high = F.least(F.coalesce("end_year", F.lit(last_year)), F.lit(last_year))
    return types.where(low <= high).select("legislation_type", F.explode(F.sequence(low, high)).alias("year"))


def next_pages(pages: DataFrame) -> DataFrame:
    """(path, next) of landed feed pages (path, content): the address that each names as the page after it, null on the last."""
    return parsed(pages, lambda root: iter([(next((a.get("href") for a in root.iterfind(f"{ATOM}link") if a.get("rel") == "next"), None),)]), "next string").select("path", "next")


def followed(pages: DataFrame, starts: DataFrame) -> DataFrame:
    """Landed ``pages`` (path, content) that are reached from ``starts`` (path) by following each page's next.

    Links are doubled in every round, so a list of n pages takes about log n rounds, and a list that leads
    back into itself ends as well.
    """
    step = next_pages(pages).where("next is not null")
    reached = starts.select("path").distinct()
    known = reached.count()
    while True:
        reached = reached.union(reached.join(step, "path").select(F.col("next").alias("path"))).distinct()
        now = reached.count()
        if now == known:
            return pages.join(reached, "path", "left_semi")
        known = now
        step = step.alias("a").join(step.alias("b"), F.col("a.next") == F.col("b.path")).select(F.col("a.path").alias("path"), F.col("b.next").alias("next"))


def range_plan(years: DataFrame, width: int = 100) -> DataFrame:
    """(legislation_type, year, first, last): years (legislation_type, year, status, highest) whose listing was refused as too long, in ranges of numbers.

    436 is the answer to a list that is too long; others are listed whole, as the range from 1 on without end.
    """
    long = years.where("status = 436").select("legislation_type", "year", F.explode(F.sequence(F.lit(1), F.greatest("highest", F.lit(1)), F.lit(width))).alias("first"), "highest")
    ranges = long.select("legislation_type", "year", "first", F.least(F.col("first") + width - 1, F.greatest("highest", F.lit(1))).alias("last"))
    whole = years.where("status <> 436").select("legislation_type", "year", F.lit(1).alias("first"), F.lit(None).cast("int").alias("last"))
    return ranges.unionByName(whole)


def number_ranges(first: int, last: int, width: int = 100) -> list[tuple[int, int]]:
    """Ranges of document numbers that together cover ``first`` to ``last``, for years too long for one list."""
    return [(a, min(a + width - 1, last)) for a in range(first, last + 1, width)]


def probe_class(status: Column) -> Column:
    """What fallback addresses say of a failed fetch: the first that answers, else what they failed with."""
    ok = lambda label: F.exists(status, lambda s: (s.label == label) & (s.status_code == 200))
    every = lambda code: F.forall(status, lambda s: F.coalesce(s.status_code == code, F.lit(False)))
    return (
        F.when(F.size(status) == 0, "unprobed").when(ok("latest_xml"), "latest available").when(ok("enacted_xml"), "enacted available").when(ok("resources_xml"), "resources available")
        .when(every(404), "not found").when(F.exists(status, lambda s: s.status_code >= 500), "server error").otherwise("unreachable")
    )


