"""TEI XML as GROBID writes it: metadata, bibliography, figures and body with spans."""

from __future__ import annotations

import datetime
import json
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.operators.ids import dense_ids
from quillspark.operators.spans import corpus_joins, rejoin, sentences
from quillspark.schema import BIB
from quillspark.session import reliable

NS = "{http://www.tei-c.org/ns/1.0}"
XML_ID = "{http://www.w3.org/XML/1998/namespace}id"
_TITLE = re.compile(r"\W?\s*(?:archive number|arxiv|corr|doi|math)[.,:]?\s*(?:abs/|pr/|number)?\s*[0-9].*", re.I)


def year_of(date: str | None, now: int | None = None) -> int | None:
    """The year of a loosely written date, if it lies within the last 200 years."""
    now = now or datetime.date.today().year
    for m in re.findall(r"(?<!\d)(\d{4})(?!\d)", date or ""):
        if now - 200 <= int(m) <= now:
            return int(m)
    return None


def _all(e: ET.Element | None) -> str:
    return " ".join("".join(e.itertext()).split()) if e is not None else ""


def _names(e: ET.Element) -> list[str]:
    out = []
    for p in e.iterfind(f"{NS}author/{NS}persName"):
        name = " ".join(filter(None, (_all(x) for kind in ("forename", "surname") for x in p.iterfind(NS + kind))))
        if name:
            out.append(name)
    return out


def header(root: ET.Element) -> dict:
    file = root.find(f"{NS}teiHeader/{NS}fileDesc")
    if file is None:
        return {"title": None, "year": None, "authors": []}
    date, bibl = file.find(f"{NS}publicationStmt/{NS}date"), file.find(f"{NS}sourceDesc/{NS}biblStruct/{NS}analytic")
    return {"title": _all(file.find(f"{NS}titleStmt/{NS}title")) or None, "year": year_of(date.get("when") or _all(date)) if date is not None else None, "authors": _names(bibl) if bibl is not None else []}


def bibliography(root: ET.Element) -> list[dict]:
    """Entries with an xml:id, a title and an author: analytic, else monogr."""
    out = []
    for b in root.iterfind(f"{NS}text/{NS}back/{NS}div/{NS}listBibl/{NS}biblStruct"):
        for kind in ("analytic", "monogr"):
            part = b.find(NS + kind)
            title = _TITLE.sub("", _all(part.find(f"{NS}title"))).strip() if part is not None else ""
            if title and (names := _names(part)) and b.get(XML_ID):
                date = next((d for d in b.iterfind(f"{NS}monogr/{NS}imprint/{NS}date") if d.get("type") == "published"), None)
                out.append({"ref": b.get(XML_ID), "id": None, "title": title, "year": year_of(date.get("when") or _all(date)) if date is not None else None, "authors": names})
                break
    return out


def figures(root: ET.Element) -> list[dict]:
    return [{"ref": f.get(XML_ID), "kind": "table" if f.get("type") == "table" else "figure", "description": " ".join(filter(None, (_all(f.find(f"{NS}head")), _all(f.find(f"{NS}figDesc")))))} for f in root.iterfind(f"{NS}text/{NS}body/{NS}figure")]


def paragraph(p: ET.Element, cite_at: dict[str, int], fig_at: dict[str, int]) -> tuple[str, list[dict], list[dict]]:
    """Text of mixed content with the offsets of its references; an unknown target has no index."""
    text, cites, refs = p.text or "", [], []
    for child in p:
        inner = "".join(child.itertext())
        if child.tag == f"{NS}ref" and child.get("type") in ("bibr", "table", "figure"):
            target = (child.get("target") or "").lstrip("#")
            known, into = (cite_at, cites) if child.get("type") == "bibr" else (fig_at, refs)
            into.append({"index": known.get(target), "start": len(text), "end": len(text) + len(inner)})
        text += inner + (child.tail or "")
    return text, cites, refs


def _leaves(text: str, cites: list[dict], refs: list[dict], joins=None) -> list[dict]:
    out = []
    text, (cites, refs) = rejoin(text, joins, cites, refs)
    for s, e in sentences(text):
        own = lambda xs: [{"index": x["index"], "start": x["start"] - s, "end": min(x["end"], e) - s} for x in xs if s <= x["start"] < e]  # noqa: B023, E731
        out.append({"headline": None, "content": {"text": text[s:e], "citations": own(cites), "references": own(refs)}})
    return out


def _section(div: ET.Element, headline: str | None, cite_at: dict, fig_at: dict, joins=None) -> dict:
    content = []
    for child in div:
        if child.tag == f"{NS}head":
            continue
        t, c, r = paragraph(child, cite_at, fig_at)
        if not t.strip():
            continue
        if child.tag == f"{NS}p":
            content.append({"headline": None, "content": _leaves(t, c, r, joins)})
        else:
            content.append({"headline": child.tag.removeprefix(NS), "content": {"text": t, "citations": c, "references": r}})
    return {"headline": headline, "content": content}


def body(root: ET.Element, title: str | None, cite_at: dict[str, int], fig_at: dict[str, int], joins=None) -> dict:
    """The tree: abstract, then divs with their numbers before their heads; leading sections without a head dissolve into the root."""
    secs = []
    abstract = root.find(f"{NS}teiHeader/{NS}profileDesc/{NS}abstract")
    if abstract is not None and _all(abstract):
        inner = abstract.findall(f"{NS}div") or [abstract]
        parts = [x for d in inner for x in _section(d, None, cite_at, fig_at, joins)["content"]]
        secs.append({"headline": "Abstract", "content": parts})
    lead: list[dict] = []
    for div in root.iterfind(f"{NS}text/{NS}body/{NS}div"):
        head = div.find(f"{NS}head")
        name = " ".join(filter(None, (head.get("n"), _all(head)))) if head is not None else None
        sec = _section(div, name or None, cite_at, fig_at, joins)
        if sec["headline"] is None and not any(s["headline"] not in (None, "Abstract") for s in secs):
            lead += sec["content"]
        else:
            secs.append(sec)
    at = 1 if secs and secs[0]["headline"] == "Abstract" else 0
    return {"headline": title, "content": secs[:at] + lead + secs[at:]}


def parse(xml: bytes, joins=None) -> dict | None:
    """A document, with broken words of its paragraphs joined where joins has them, or None if it isn't XML."""
    try:
        root = ET.fromstring(xml)
    except ET.ParseError:
        return None
    bib, figs = bibliography(root), figures(root)
    head = header(root)
    tree = body(root, head["title"], {b["ref"]: i for i, b in enumerate(bib)}, {f["ref"]: i for i, f in enumerate(figs) if f["ref"]}, joins)
    return head | {"bibliography": bib, "non_plaintext_content": figs, "hierarchy": json.dumps(tree, ensure_ascii=False)}


COLUMNS = f"path string, title string, year int, authors array<string>, bibliography {BIB}, non_plaintext_content array<struct<kind: string, description: string>>, hierarchy string"


def _paragraphs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for path, content in zip(b["path"], b["content"], strict=True):
            try:
                rows += [(path, "".join(p.itertext())) for p in ET.fromstring(bytes(content)).iter(f"{NS}p")]
            except ET.ParseError:
                continue
        yield pd.DataFrame(rows, columns=["path", "text"])


def _parse_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for path, content, joins in zip(b["path"], b["content"], b["joins"], strict=True):
            d = parse(bytes(content), joins)
            if d and d["title"] and d["authors"]:
                d["bibliography"] = [{k: x[k] for k in ("id", "title", "year", "authors")} for x in d["bibliography"]]
                d["non_plaintext_content"] = [{k: x[k] for k in ("kind", "description")} for x in d["non_plaintext_content"]]
                rows.append({"path": path} | d)
        out = pd.DataFrame(rows, columns=["path", "title", "year", "authors", "bibliography", "non_plaintext_content", "hierarchy"])
        yield out.assign(year=out["year"].astype("Int32"))


def documents(files: DataFrame) -> DataFrame:
    """Documents of XML files (path, content; without content none) that parse and have a title and an author."""
    files = files.where("content is not null")
    joins = corpus_joins(files.select("path", "content").mapInPandas(_paragraphs, "path string, text string"), "path")
    return files.select("path", "content").join(joins, "path", "left").mapInPandas(_parse_all, COLUMNS)


def directory(spark: SparkSession, path: str) -> DataFrame:
    """Documents of all .xml files below path that parse and have a title and an author; id is their rank by path.

    Files are parsed once, into a checkpoint; only paths are numbered."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.xml").load(path)
    own = reliable(documents(files.select("path", "content")))
    nth = dense_ids(own.select(F.col("path").alias("id")))
    return own.join(nth.select(F.col("old").alias("path"), F.col("new").alias("id")), "path")
