"""Legislation XML to Markdown.

Element order and mixed content carry meaning, which a columnar XML reader loses, so each file is
walked as a tree in a Python worker; the walk yields blocks, and the blocks joined are the document.
Everything further (front matter, provisions, hashes) is read back from the Markdown by columns.
"""

from __future__ import annotations

import gzip
import re
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Namespaces, and the sentence that stands for a missing text.
LEG, UKM, ATOM, DC = "{http://www.legislation.gov.uk/namespaces/legislation}", "{http://www.legislation.gov.uk/namespaces/metadata}", "{http://www.w3.org/2005/Atom}", "{http://purl.org/dc/elements/1.1/}"
METADATA_ONLY = "Source XML contains metadata only; full text may be available in PDF or another source format."
_TIDY = ((re.compile(r" +([,;:)\]])"), r"\1"), (re.compile(r"(?<![.\s]) +\.(?!\s*\.)"), "."))


def words(node: ElementTree.Element | None) -> str:
    """All text in ``node``, spaced as a reader expects whatever the indentation of its markup."""
    if node is None:
        return ""
    out = " ".join("".join(node.itertext()).split())
    for pattern, to in _TIDY:
        out = pattern.sub(to, out)
    return out


def kind(node: ElementTree.Element) -> str:
    return node.tag.rpartition("}")[2]


def holds(node: ElementTree.Element) -> bool:
    """False for what is not law at the date the file was asked for."""
    return node.get("Match") != "false"


def notes(node: ElementTree.Element | None) -> list[str]:
    return [] if node is None else [r for c in node.iter(f"{LEG}CommentaryRef") if (r := c.get("Ref"))]


def lines(node: ElementTree.Element | None) -> list[str]:
    """Texts and numbered paragraphs right below ``node``, inner paragraphs after their parent's first line."""
    out: list[str] = []
    for child in [] if node is None else node:
        name = kind(child)
        if name == "Text":
            out.append(words(child))
        elif name in ("P1", "P2", "P3"):
            number, para = child.find(f"{LEG}Pnumber"), child.find(f"{LEG}{name}para")
            if number is not None and para is not None:
                inner = lines(para) or [words(para)]
                out += [f"({words(number)}) {inner[0]}", *inner[1:]] if inner[0] else []
    return [x for x in out if x]


Section = tuple[str, str, list[str], list[str]]  # number, title, lines, commentary ids


def sections(node: ElementTree.Element) -> Iterator[Section]:
    """Provisions below ``node`` in order; headings without provisions of their own give their text."""
    for child in filter(holds, node):
        name = kind(child)
        title = " ".join((child.findtext(f"{LEG}Title") or "").split())
        if name == "P1group":
            first = child.find(f"{LEG}P1/{LEG}P1para")
            number = child.find(f"{LEG}P1/{LEG}Pnumber")
            yield words(number), title, lines(child if first is None else first), notes(number)
        elif name == "P1":
            number, para = child.find(f"{LEG}Pnumber"), child.find(f"{LEG}P1para")
            if found := lines(child if para is None else para):
                yield words(number), "", found, notes(number)
        elif name == "P":
            if (found := lines(child) or [words(child)]) != [""]:
                yield "", "", found, notes(child)
        elif name in ("Part", "Chapter", "Pblock"):
            inner = list(sections(child))
            yield from inner
            if not inner and (found := lines(child) or [words(child)]) != [""]:
                yield "", title, found, notes(child)
        else:
            yield from sections(child)


def schedules(root: ElementTree.Element) -> Iterator[Section]:
    """A section for each schedule; what is headed inside it gets third-level headings."""
    for s in filter(holds, root.iterfind(f".//{LEG}Schedules/{LEG}Schedule")):
        body, number = s.find(f"{LEG}ScheduleBody"), s.find(f"{LEG}Number")
        out: list[str] = []
        for n, title, found, _ in sections(body) if body is not None else ():
            head = f"{n} {title}".strip()
            out += [f"### {head}"] * bool(head) + found
        if body is not None and not out:
            out = lines(body) or [words(body)]
        yield words(number) if number is not None else "SCHEDULE", words(s.find(f"{LEG}TitleBlock/{LEG}Title")), [x for x in out if x], notes(number)


def pdf_links(root: ElementTree.Element) -> list[str]:
    atom = [a.get("href") for a in root.iter(f"{ATOM}link") if a.get("type") == "application/pdf"]
    other = [u for a in root.iter(f"{UKM}Alternative") if (u := a.get("URI")) and u.lower().endswith(".pdf")]
    return list(dict.fromkeys(x for x in atom + other if x))


def quoted(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace('"', '\\"')
    return f'"{escaped}"'


def to_markdown(content: bytes) -> str:
    """The document's Markdown; ValueError where title or address is missing, ParseError where it is no XML."""
    root = ElementTree.fromstring(content)
    title, address = root.findtext(f".//{DC}title"), root.get("DocumentURI")
    if title is None:
        raise ValueError("the document has no title")
    if address is None:
        raise ValueError("the document has no address")
    links = pdf_links(root)
    head = {"title": title, "document_uri": address, "status": root.get("Status"), "extent": root.get("RestrictExtent")}
    front = ["---", *[f"{k}: {quoted(v)}" for k, v in head.items() if v is not None]]
    front += ["pdf_alternatives:", *[f"  - {quoted(x)}" for x in links]] if links else []
    prelims = f".//{LEG}PrimaryPrelims/{LEG}"
    number = root.findtext(f"{prelims}Number")
    if not number:
        year, own = (x.get("Value") if (x := root.find(f".//{UKM}{n}")) is not None else None for n in ("Year", "Number"))
        number = f"{year} Chapter {own}" if year is not None and own is not None else ""
    long_title = words(root.find(f"{prelims}LongTitle"))
    blocks = ["\n".join([*front, "---"]), f"# {root.findtext(f'{prelims}Title') or title}", *filter(None, (number, long_title))]
    body, versions = root.find(f".//{LEG}Body"), root.find(f".//{LEG}Versions")
    found = [(s, None) for s in (sections(body) if body is not None else ())] + [(s, None) for s in schedules(root)]
    for v in filter(holds, versions.iterfind(f"{LEG}Version") if versions is not None else ()):
        found += [(s, v.get("Description") or None) for s in sections(v)]
    if not found and not long_title:
        blocks += [METADATA_ONLY, *(["\n".join(["PDF alternatives:", *[f"- {x}" for x in links]])] if links else [])]
    texts = {c.get("id"): words(c) for c in root.iterfind(f".//{LEG}Commentaries/{LEG}Commentary")}
    for (n, name, own, refs), extent in found:
        blocks.append("## " + (f"{n} {name}".strip() or "Section") + (f" ({extent})" if extent else ""))
        blocks += [f"> Commentary: {texts[r]}" for r in refs if texts.get(r)] + own
    return "\n\n".join(blocks) + "\n"


def scan_xml(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of every ``data.xml`` and ``data.xml.gz`` below ``path``."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "data.xml*").option("recursiveFileLookup", True).load(path).select("path", "content")


RENDERED = "path string, markdown string, error string"


def clml_to_markdown(files: DataFrame) -> DataFrame:
    """(path, markdown, error) of (path, content); a file that can't be rendered has its error instead."""

    def render(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for path, content in zip(frame["path"], frame["content"], strict=True):
                try:
                    rows.append((path, to_markdown(unpacked(content)), None))
                except (ValueError, ElementTree.ParseError, OSError, EOFError) as e:
                    rows.append((path, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["path", "markdown", "error"])

    return files.select("path", "content").mapInPandas(render, RENDERED)


def version_dates(content: bytes) -> list[str]:
    """Dates of a document's other versions, from its links, distinct and in order."""
    found = {a.get("title", "") for a in ElementTree.fromstring(content).iter(f"{ATOM}link") if a.get("rel") == "http://purl.org/dc/terms/hasVersion"}
    return sorted(x for x in found if re.fullmatch(r"\d{4}-\d{2}-\d{2}", x))


def unpacked(content: bytes | None) -> bytes:
    data = bytes(content or b"")
    return gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data


def version_links(files: DataFrame) -> DataFrame:
    """(path, date) of the versions that each document (path, content) names; a file that is no XML names none."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for path, content in zip(frame["path"], frame["content"], strict=True):
                try:
                    rows += [(path, d) for d in version_dates(unpacked(content))]
                except (ElementTree.ParseError, OSError, EOFError):
                    continue
            yield pd.DataFrame(rows, columns=["path", "date"], dtype=object)

    return files.select("path", "content").mapInPandas(read, "path string, date string")


def xml_facts(files: DataFrame) -> DataFrame:
    """``files`` (content and others) with ``kind`` and ``pdf_linked`` of each.

    Kinds: empty, malformed, non_legislation, full_text (it has a body), metadata_only.
    """

    @F.pandas_udf("kind string, pdf_linked boolean")
    def facts(content: pd.Series) -> pd.DataFrame:
        out = []
        for raw in content:
            try:
                data = unpacked(raw)
                root = ElementTree.fromstring(data) if data else None
            except (ElementTree.ParseError, OSError, EOFError):
                out.append(("malformed", False))
                continue
            if root is None:
                out.append(("empty", False))
            elif kind(root) != "Legislation":
                out.append(("non_legislation", False))
            else:
                out.append(("full_text" if root.find(f".//{LEG}Body") is not None else "metadata_only", bool(pdf_links(root))))
        return pd.DataFrame(out, columns=["kind", "pdf_linked"])

    return files.withColumn("_x", facts("content")).withColumns({"kind": F.col("_x.kind"), "pdf_linked": F.col("_x.pdf_linked")}).drop("_x")


def pretty(files: DataFrame) -> DataFrame:
    """``files`` (content and others) with the XML indented, an element a line, as it is written to the store; what is no XML stays as it is."""

    @F.pandas_udf(T.BinaryType())
    def indented(content: pd.Series) -> pd.Series:
        out = []
        for raw in content:
            try:
                root = ElementTree.fromstring(unpacked(raw))
            except (ElementTree.ParseError, OSError, EOFError):
                out.append(raw)
                continue
            ElementTree.indent(root)
            out.append(ElementTree.tostring(root, encoding="utf-8", xml_declaration=True))
        return pd.Series(out)

    return files.withColumn("content", indented("content"))


def still_to_fetch(plan: DataFrame, landed: DataFrame) -> DataFrame:
    """``plan`` (path) without what has landed (path, content) in a usable state: XML whose root is a document."""
    usable = xml_facts(landed).where("kind in ('full_text', 'metadata_only')").select("path").distinct()
    return plan.join(usable, "path", "left_anti")


def document_ref(path: Column) -> Column:
    """struct(collection, date, legislation_type, year, number, document_id) from a stored file's path; null fields where it does not fit."""
    p = path
    pattern = r"(?:^|/)(enacted|point-in-time)(?:/(\d{4}-\d{2}-\d{2}))?/((?:[^/]+/)+?)([^/]+?)(?:/data\.xml(?:\.gz)?|\.md)$"
    get = lambda k: F.nullif(F.regexp_extract(p, pattern, k), F.lit(""))
    parts = F.split(F.concat(get(3), get(4)), "/")
    fits = F.size(parts) >= 3
    return F.struct(get(1).alias("collection"), get(2).alias("date"), F.when(fits, F.get(parts, F.lit(0))).alias("legislation_type"), F.when(fits, F.get(parts, F.lit(1))).alias("year"), F.when(fits, F.element_at(parts, -1)).alias("number"), F.when(fits, F.concat(get(3), get(4))).alias("document_id"))
