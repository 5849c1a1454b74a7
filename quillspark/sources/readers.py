"""Sources: JSON lines, S2ORC (both layouts), MAG, Scopus, citation graphs, CORE. All with explicit schemas."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T_
from pyspark.sql.types import _parse_datatype_string

from quillspark.functions import text as T
from quillspark.operators import ids as I  # noqa: E741
from quillspark.operators.spans import corpus_joins, rejoin, sentences
from quillspark.schema import DOCUMENT, PAPER

_SPANS = "array<struct<start: string, end: string, attributes: struct<ref_id: string, id: string, matched_paper_id: string, n: string>>>"
S2ORC = "corpusid bigint, content struct<text: string, annotations: map<string, string>>"
S2ORC_PAPER = "corpusid bigint, externalids struct<MAG: string, DOI: string>, title string, authors array<struct<authorId: string, name: string>>, year int, s2fieldsofstudy array<struct<category: string>>"
S2ORC_META = S2ORC_PAPER + ", abstract string, citing array<bigint>"
_REF = "array<struct<start: int, end: int, ref_id: string>>"
_PAR = f"array<struct<section: string, text: string, cite_spans: {_REF}, ref_spans: {_REF}>>"
S2ORC_OLD = (
    "paper_id string, title string, authors array<struct<first: string, middle: array<string>, last: string, suffix: string>>, year int, doi string, mag_id string, mag_field_of_study array<string>, outbound_citations array<string>, "
    f"abstract {_PAR}, body_text {_PAR}, bib_entries map<string, struct<title: string, authors: array<struct<first: string, middle: array<string>, last: string>>, year: int, link: string>>, ref_entries map<string, struct<text: string, type: string>>"
)
MAG = "PaperId bigint, OriginalTitle string, Year int, Authors array<string>, References array<bigint>, Fields array<string>, Doi string, Journal string"
SCOPUS = "`dc:title` string, `prism:coverDate` string, `dc:creator` string"


def json_lines(spark: SparkSession, path: str, schema: str = DOCUMENT) -> DataFrame:
    """Rows of JSON lines, gzip or not; blank lines are skipped. Gzip can't be split: repartition afterwards where files are large.

    A column `extra` gets the keys that the schema doesn't have, as a JSON object (null if there are none)."""
    own = _parse_datatype_string(schema)
    if "extra" not in own.names:
        return spark.read.schema(schema).json(path)
    known = [f for f in own.fields if f.name != "extra"]
    line = F.from_json("value", T_.StructType(known))
    every = F.from_json("value", "map<string, string>")
    raw = F.map_filter("__all", lambda k, v: ~k.isin([f.name for f in known]))
    quoted = F.transform(F.map_entries(raw), lambda e: F.concat(F.regexp_replace(F.to_json(F.array(e["key"])), r"^\[|\]$", ""), F.lit(":"), F.coalesce(F.when(e["value"].rlike(r"^(?:[\[{].*|-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false)$"), e["value"]).otherwise(F.regexp_replace(F.to_json(F.array(e["value"])), r"^\[|\]$", "")), F.lit("null"))))
    rows = spark.read.text(path).where("trim(value) <> ''").select(line.alias("__r"), every.alias("__all"), "value")
    extra = F.when(F.size(raw) > 0, F.concat(F.lit("{"), F.array_join(quoted, ","), F.lit("}")))
    return rows.select("__r.*", extra.alias("extra")).select(*own.names)


def numbered(df: DataFrame) -> DataFrame:
    """df, read from files, with row_pos, its position in the order of paths and of rows in them. No single-task sort.

    Spark deals out files by size, so each block of a file is placed by its path and offset; ids within a block follow
    each other in the task that reads it."""
    own = df.select("*", F.col("_metadata.file_path").alias("__f"), F.col("_metadata.file_block_start").alias("__s"), F.monotonically_increasing_id().alias("__m"))
    blocks = own.groupBy("__f", "__s").agg(F.count("*").alias("__n"), F.min("__m").alias("__first"))
    before = blocks.withColumn("__before", F.sum("__n").over(Window.orderBy("__f", "__s")) - F.col("__n")).drop("__n")
    return own.join(before, ["__f", "__s"]).withColumn("row_pos", F.col("__before") + F.col("__m") - F.col("__first")).drop("__f", "__s", "__m", "__before", "__first")


def by_ids(df: DataFrame, ids: DataFrame) -> DataFrame:
    return I.keep_ids(df, ids)


def slice_rows(df: DataFrame, first: int, end: int) -> DataFrame:
    """Rows first..end-1 of a numbered frame."""
    return df.where(F.col("row_pos").between(first, end - 1))


def selected_rows(df: DataFrame, positions: DataFrame) -> DataFrame:
    return df.join(positions.select("row_pos").distinct(), "row_pos", "left_semi")


def transformed(df: DataFrame, f: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """A row transform with set-up once a partition."""
    return df.mapInPandas(f, schema)


def preload(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows whose id passes, before anything heavier is parsed."""
    return df.where(predicate)


def stubs(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc_id, title, authors, text): the first text that isn't empty."""
    first = nodes.where(F.length("text") > 0).groupBy("doc_id").agg(F.min_by("text", "path").alias("text"))
    return docs.select("doc_id", "title", "authors").join(first, "doc_id", "left")


def paper_records(docs: DataFrame) -> DataFrame:
    return docs.select("id", "s2orc_id", "mag_id", "doi", "title", "year", "authors")


def papers(spark: SparkSession, path: str) -> DataFrame:
    return json_lines(spark, path, PAPER)


def citation_graph(spark: SparkSession, path: str) -> DataFrame:
    """(citing, cited) of JSON objects {"citing": [cited, ...], ...}, whether in one line or over many.

    The files are read in parts that end with a list, so that one large object is spread over tasks."""
    parts = spark.read.option("lineSep", "]").text(path)
    key, list_ = F.regexp_extract("value", r'"(-?\d+)"\s*:\s*\[', 1), F.regexp_extract("value", r'"\s*:\s*\[([^\[]*)$', 1)
    each = parts.select(key.try_cast("bigint").alias("citing"), F.explode(F.split(list_, ",")).alias("c"))
    return each.select("citing", F.trim(F.regexp_replace("c", r"\s", "")).try_cast("bigint").alias("cited")).where("citing is not null and cited is not null")


def mag(spark: SparkSession, path: str) -> DataFrame:
    """MAG records that have a title and an author."""
    own = json_lines(spark, path, MAG).where("OriginalTitle is not null and size(Authors) > 0")
    return own.select(F.col("PaperId").alias("id"), F.col("OriginalTitle").alias("title"), F.col("Year").alias("year"), F.col("Authors").alias("authors"), F.col("References").alias("references"), F.col("Fields").alias("fields"), F.col("Doi").alias("doi"), F.col("Journal").alias("journal"))


def scopus(spark: SparkSession, path: str) -> DataFrame:
    own = json_lines(spark, path, SCOPUS).where("`dc:title` is not null and `prism:coverDate` is not null and `dc:creator` is not null")
    return own.select(F.col("`dc:title`").alias("title"), F.get(F.split("`prism:coverDate`", "-"), F.lit(0)).try_cast("int").alias("year"), F.array("`dc:creator`").alias("authors"))


def metadata(papers_: DataFrame, abstracts: DataFrame, graph: DataFrame) -> DataFrame:
    """papers with abstract (or null) and citing (or an empty array): corpusid keys all three, graph is (citing, cited)."""
    cited = graph.groupBy(F.col("citing").alias("corpusid")).agg(F.array_sort(F.collect_set("cited")).alias("citing"))
    out = papers_.join(abstracts.select("corpusid", "abstract"), "corpusid", "left").join(cited, "corpusid", "left")
    return out.withColumn("citing", F.coalesce("citing", F.array().cast("array<bigint>")))


def s2orc_metadata(meta: DataFrame) -> DataFrame:
    return meta.select(
        F.col("corpusid").alias("id"), F.col("corpusid").alias("s2orc_id"), F.col("externalids.MAG").try_cast("bigint").alias("mag_id"), F.col("externalids.DOI").alias("doi"), "title", "year",
        F.transform("authors", lambda a: a["name"]).alias("authors"), F.array_sort(F.array_distinct(F.transform(F.coalesce("s2fieldsofstudy", F.array().cast("array<struct<category: string>>")), lambda x: x["category"]))).alias("fields_of_study"),
        F.array_sort("citing").alias("citations"), "abstract",
    )


def records(papers_: DataFrame) -> DataFrame:
    """(id, title, year, authors) of papers that have a title and an author."""
    return papers_.where("title is not null and size(authors) > 0").select(F.col("corpusid").alias("id"), "title", "year", F.transform("authors", lambda a: a["name"]).alias("authors"))


def annotation(name: str) -> Column:
    """Spans of one kind: JSON text in content.annotations, ends as numbers or strings."""
    own = F.from_json(F.try_element_at("content.annotations", F.lit(name)), _SPANS)
    return F.transform(F.coalesce(own, F.array().cast(_SPANS)), lambda s: F.struct(s["start"].try_cast("int").alias("start"), s["end"].try_cast("int").alias("end"), s["attributes"].alias("a")))


def inside(spans: Column, start: Column, end: Column) -> Column:
    return F.filter(spans, lambda s: (s["start"] >= start) & (s["end"] <= end))


def span_text(text: Column, span: Column) -> Column:
    return F.substring(text, span["start"] + 1, span["end"] - span["start"])


def s2orc_paragraphs(full: DataFrame) -> DataFrame:
    """(corpusid, section, start, end, text, citations, references): each paragraph or formula with the last header that
    begins at or before it ('' if none), and its spans rebased. Spans of one document only: nothing is joined."""
    heads = F.array_sort(F.array_distinct(F.transform(annotation("sectionheader"), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))))
    parts = F.array_distinct(F.concat(*[F.transform(annotation(n), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))) for n in ("paragraph", "formula")]))
    own = full.select("corpusid", F.col("content.text").alias("body"), heads.alias("heads"), annotation("bibref").alias("bibref"), F.concat(annotation("figureref"), annotation("tableref")).alias("figref"), F.explode(parts).alias("p"))
    last = F.element_at(F.filter("heads", lambda h: h["start"] <= F.col("p.start")), -1)
    rebased = lambda c: F.transform(inside(F.col(c), F.col("p.start"), F.col("p.end")), lambda s: F.struct(s["a"]["ref_id"].alias("ref"), (s["start"] - F.col("p.start")).alias("start"), (s["end"] - F.col("p.start")).alias("end")))
    own = own.withColumn("head", F.when(F.exists("heads", lambda h: h["start"] <= F.col("p.start")), last))
    return own.select("corpusid", F.when(F.col("head").isNull(), "").otherwise(span_text(F.col("body"), F.col("head"))).alias("section"), F.col("p.start").alias("start"), F.col("p.end").alias("end"), span_text(F.col("body"), F.col("p")).alias("text"), rebased("bibref").alias("citations"), rebased("figref").alias("references"))


def s2orc_bibliography(full: DataFrame, meta: DataFrame) -> DataFrame:
    """(doc_id, pos, ref, id, title, year, authors): entry spans with the title and authors inside, the year from the linked paper."""
    own = full.select("corpusid", F.col("content.text").alias("body"), annotation("bibtitle").alias("titles"), annotation("bibauthor").alias("names"), F.posexplode(annotation("bibentry")).alias("pos", "b"))
    texts = lambda c: F.transform(inside(F.col(c), F.col("b.start"), F.col("b.end")), lambda s: span_text(F.col("body"), s))
    own = own.select(F.col("corpusid").alias("doc_id"), "pos", F.col("b.a.id").alias("ref"), F.col("b.a.matched_paper_id").try_cast("bigint").alias("id"), T.clean_title(F.get(texts("titles"), F.lit(0))).alias("title"), texts("names").alias("authors"))
    return own.join(meta.select(F.col("corpusid").alias("id"), "year"), "id", "left").select("doc_id", "pos", "ref", "id", "title", "year", "authors")


def s2orc_figures(full: DataFrame) -> DataFrame:
    """(doc_id, pos, ref, kind, description)."""
    kinds = F.concat(*[F.transform(annotation(n), lambda s, n=n: F.struct(F.lit(n).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["a"]["id"].alias("ref"))) for n in ("figure", "table")])
    return full.select("corpusid", F.col("content.text").alias("body"), F.posexplode(kinds).alias("pos", "f")).select(F.col("corpusid").alias("doc_id"), "pos", F.col("f.ref").alias("ref"), F.col("f.kind").alias("kind"), span_text(F.col("body"), F.col("f")).alias("description"))


def _leaf(text: str, cites: list, refs: list, joins=None) -> list[dict]:
    """Sentences of a paragraph, without its broken words, as leaves; a span belongs to the sentence in which it begins."""
    out = []
    text, (cites, refs) = rejoin(text, joins, cites, refs)
    for s, e in sentences(text):
        own = lambda xs: [{"index": x["index"], "start": max(0, x["start"] - s), "end": min(x["end"], e) - s} for x in xs if s <= x["start"] < e]  # noqa: B023, E731
        out.append({"headline": None, "content": {"text": text[s:e], "citations": own(cites), "references": own(refs)}})
    return out


def paragraphs_tree(title: str | None, abstract: str | None, paragraphs: list[dict], cite_at: dict, fig_at: dict, joins=None) -> dict:
    """Root -> abstract and sections -> paragraphs -> sentences."""
    secs: list[dict] = []
    if abstract and abstract.strip():
        secs.append({"headline": "Abstract", "content": [{"headline": None, "content": _leaf(abstract, [], [], joins)}]})
    for p in paragraphs:
        if not secs or secs[-1]["headline"] != (p["section"] or None) or secs[-1]["headline"] == "Abstract" and not p["section"]:
            secs.append({"headline": p["section"] or None, "content": []})
        spans = lambda xs, at: [{"index": at.get(x["ref"]), "start": int(x["start"]), "end": int(x["end"])} for x in (xs if xs is not None else [])]
        secs[-1]["content"].append({"headline": None, "content": _leaf(p["text"], spans(p["citations"], cite_at), spans(p["references"], fig_at), joins)})
    return {"headline": title, "content": secs}


def s2orc(meta: DataFrame, full: DataFrame) -> DataFrame:
    """Documents of metadata, with the full text where there is one; cited ids that no entry has are appended as entries."""
    head = s2orc_metadata(meta)
    bib, figs = s2orc_bibliography(full, meta), s2orc_figures(full)
    cited = head.select(F.col("id").alias("doc_id"), F.explode("citations").alias("id")).join(bib.select("doc_id", "id"), ["doc_id", "id"], "left_anti")
    extra = cited.join(head.select("id", "title", "year", "authors"), "id").withColumn("pos", F.lit(1 << 20) + F.row_number().over(Window.partitionBy("doc_id").orderBy("id"))).withColumn("ref", F.lit(None).cast("string"))
    rows = F.array_sort(F.collect_list(F.struct("pos", "ref", "id", "title", "year", "authors")))
    bibs = bib.unionByName(extra.select(bib.columns)).groupBy(F.col("doc_id").alias("id")).agg(rows.alias("bib"))
    figures = figs.groupBy(F.col("doc_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct("pos", "ref", "kind", "description"))).alias("figs"))
    pars = s2orc_paragraphs(full).groupBy(F.col("corpusid").alias("id")).agg(F.array_sort(F.collect_list(F.struct("start", "end", "section", "text", F.to_json("citations").alias("c"), F.to_json("references").alias("r")))).alias("pars"))
    texts = s2orc_paragraphs(full).select(F.col("corpusid").alias("id"), "text").unionByName(head.select("id", F.col("abstract").alias("text")))
    own = head.join(bibs, "id", "left").join(figures, "id", "left").join(pars, "id", "left").join(corpus_joins(texts.where("text is not null"), "id"), "id", "left")

    @F.pandas_udf("string")
    def tree(title: pd.Series, abstract: pd.Series, pars: pd.Series, bib: pd.Series, figs: pd.Series, joins: pd.Series) -> pd.Series:
        out = []
        for t, a, p, b, f, j in zip(title, abstract, pars, bib, figs, joins, strict=True):
            at = lambda xs: {x["ref"]: i for i, x in enumerate(xs) if x["ref"] is not None} if xs is not None else {}
            rows = [{"section": x["section"], "text": x["text"], "citations": json.loads(x["c"]), "references": json.loads(x["r"])} for x in (p if p is not None else [])]
            out.append(json.dumps(paragraphs_tree(t, a, rows, at(b), at(f), j), ensure_ascii=False))
        return pd.Series(out)

    return own.withColumn("hierarchy", tree("title", "abstract", "pars", "bib", "figs", "joins")).withColumn("bibliography", F.transform("bib", lambda x: x.dropFields("pos", "ref"))).withColumn("non_plaintext_content", F.transform("figs", lambda x: x.dropFields("pos", "ref"))).drop("bib", "figs", "pars", "abstract", "joins")


def s2orc_old(raw: DataFrame) -> DataFrame:
    """Documents of the older single-file layout."""
    name = lambda a: F.array_join(F.filter(F.concat(F.array(a["first"]), F.coalesce(a["middle"], F.array().cast("array<string>")), F.array(a["last"])), lambda x: F.coalesce(x, F.lit("")) != ""), " ")
    bib = F.transform(F.array_sort(F.map_entries(F.coalesce("bib_entries", F.create_map().cast("map<string, struct<title: string, authors: array<struct<first: string, middle: array<string>, last: string>>, year: int, link: string>>")))), lambda e: F.struct(e["key"].alias("ref"), e["value"]["link"].try_cast("bigint").alias("id"), T.clean_title(e["value"]["title"]).alias("title"), e["value"]["year"].alias("year"), F.transform(e["value"]["authors"], name).alias("authors")))
    figs = F.transform(F.array_sort(F.map_entries(F.coalesce("ref_entries", F.create_map().cast("map<string, struct<text: string, type: string>>")))), lambda e: F.struct(e["key"].alias("ref"), e["value"]["type"].alias("kind"), e["value"]["text"].alias("description")))
    own = raw.select(
        F.col("paper_id").try_cast("bigint").alias("id"), F.col("paper_id").try_cast("bigint").alias("s2orc_id"), F.trim(F.get(F.split("mag_id", ","), F.lit(0))).try_cast("bigint").alias("mag_id"), "doi", "title", "year", F.transform("authors", name).alias("authors"),
        F.coalesce("mag_field_of_study", F.array().cast("array<string>")).alias("fields_of_study"), F.array_sort(F.filter(F.transform(F.coalesce("outbound_citations", F.array().cast("array<string>")), lambda x: x.try_cast("bigint")), lambda x: x.isNotNull())).alias("citations"),
        bib.alias("bib"), figs.alias("figs"), F.to_json("body_text").alias("body"), F.array_join(F.transform(F.coalesce("abstract", F.array().cast(_PAR)), lambda p: p["text"]), " ").alias("abs"),
    )

    texts = raw.select(F.col("paper_id").try_cast("bigint").alias("id"), F.explode(F.concat(*[F.transform(F.coalesce(c, F.array().cast(_PAR)), lambda p: p["text"]) for c in ("abstract", "body_text")])).alias("text"))
    own = own.join(corpus_joins(texts.where("id is not null and text is not null"), "id"), "id", "left")

    @F.pandas_udf("string")
    def tree(title: pd.Series, abstract: pd.Series, body: pd.Series, bib: pd.Series, figs: pd.Series, joins: pd.Series) -> pd.Series:
        out = []
        for t, a, p, b, f, j in zip(title, abstract, body, bib, figs, joins, strict=True):
            at = lambda xs: {x["ref"]: i for i, x in enumerate(xs)} if xs is not None else {}
            spans = lambda xs: [{"ref": x.get("ref_id"), "start": x["start"], "end": x["end"]} for x in xs or []]
            rows = [{"section": x.get("section") or "", "text": x.get("text") or "", "citations": spans(x.get("cite_spans")), "references": spans(x.get("ref_spans"))} for x in (json.loads(p) if p else [])]
            out.append(json.dumps(paragraphs_tree(t, a, rows, at(b), at(f), j), ensure_ascii=False))
        return pd.Series(out)

    return own.withColumn("hierarchy", tree("title", "abs", "body", "bib", "figs", "joins")).withColumn("bibliography", F.transform("bib", lambda x: x.dropFields("ref"))).withColumn("non_plaintext_content", F.transform("figs", lambda x: x.dropFields("ref"))).drop("bib", "figs", "body", "abs", "joins")


def mag_to_core(references: DataFrame, mag_index: DataFrame, core_index: DataFrame) -> DataFrame:
    """(id, citations): MAG reference ids (id, references) through MAG's and CORE's mappings (old, new each), unknown ones dropped."""
    each = references.select("id", F.explode("references").alias("old")).join(mag_index, "old").select("id", F.col("new").alias("old")).join(core_index, "old")
    return each.groupBy("id").agg(F.array_sort(F.collect_set("new")).alias("citations"))
