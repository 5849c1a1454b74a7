"""python -m quillspark.plans.cli JOB ARGUMENTS: jobs over files, for spark-submit.

Results are folders of JSON lines; with --indexed, one file and an index of its rows (key, offset) beside it.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import text as T
from quillspark.operators import bibliography as B
from quillspark.operators import dedup, filters, stats, tree
from quillspark.operators import ids as I  # noqa: E741
from quillspark.operators import search as S
from quillspark.plans import jobs
from quillspark.schema import RELATED_WORK
from quillspark.session import reliable
from quillspark.sources import readers, sinks, tei

Args = argparse.Namespace
#: Names of results (arguments that hold paths) and the frames that go there; None prints.
Results = dict[str, DataFrame]
Job = Callable[[SparkSession, Args], Results]

_jobs: dict[str, tuple[Job, list[str], dict[str, dict]]] = {}
_FLAG = {"action": "store_true"}
_MATCH = {"match-threshold": {"type": float, "default": 0.75}, "max-year-diff": {"type": int, "default": 2}}
_ROWS = {"from-row": {"type": int, "default": 0}, "to-row": {"type": int}}


def _job(*paths: str, **options: dict) -> Callable[[Job], Job]:
    """Registers a job by its function's name; an underscore at the end of an option's name is dropped."""

    def add(f: Job) -> Job:
        _jobs[f.__name__.strip("_")] = f, list(paths), {k.replace("_", "-"): v for k, v in options.items()}
        return f

    return add


def _opt(kind: type, default=None) -> dict:
    return {"type": kind, "default": default}


def _docs(spark: SparkSession, path: str, a: Args | None = None) -> DataFrame:
    """Documents, or the rows from_row .. to_row - 1 of them."""
    own = readers.json_lines(spark, path)
    if a is None or not (a.from_row or a.to_row):
        return own
    return readers.slice_rows(readers.numbered(own), a.from_row, a.to_row or 1 << 62).drop("row_pos")


def _how(a: Args) -> dict:
    return {"threshold": a.match_threshold, "max_year_diff": a.max_year_diff}


def _mapping(spark: SparkSession, path: str, docs: DataFrame, mag: DataFrame) -> DataFrame:
    """(id, mag_id) of lines that give for each document, in order, the position of its MAG record."""
    at = sinks.read_mapping(readers.numbered(spark.read.text(path))).where("value is not null")
    own = readers.numbered(docs).select("row_pos", "id").join(at, "row_pos")
    return own.join(readers.numbered(mag).select(F.col("row_pos").alias("value"), F.col("id").alias("mag_id")), "value").select("id", "mag_id")


# ---- conversion --------------------------------------------------------------------------------------------------
@_job("original", subfolders={"nargs": "*", "default": ["papers", "abstracts", "s2orc", "citations"]})
def extract_s2orc(spark: SparkSession, a: Args) -> Results:
    """Downloads of S2ORC, a folder of gzip parts for each kind, as one sorted set of lines each, and the citation graph."""
    out = {}
    for name in a.subfolders:
        lines = spark.read.text(f"{a.original}/{name}")
        if name == "citations":
            g = jobs.extracted_graph(lines)
            out[f"{a.original}/{name}.json"] = g.select(F.to_json(F.map_from_arrays(F.array(F.col("citing").cast("string")), F.array("cited"))).alias("value"))
        else:
            out[f"{a.original}/{name}.jsonl"] = jobs.extracted(lines)
    return out


@_job("papers", "abstracts", "citation_graph", "result")
def create_s2orc_metadata(spark: SparkSession, a: Args) -> Results:
    own = readers.json_lines(spark, a.papers, readers.S2ORC_PAPER)
    return {a.result: readers.metadata(own, readers.json_lines(spark, a.abstracts, "corpusid bigint, abstract string"), readers.citation_graph(spark, a.citation_graph))}


@_job("metadata", "result")
def create_s2orc_records(spark: SparkSession, a: Args) -> Results:
    return {a.result: readers.records(readers.json_lines(spark, a.metadata, readers.S2ORC_PAPER))}


@_job("metadata", "s2orc", "result")
def convert_s2orc(spark: SparkSession, a: Args) -> Results:
    return {a.result: jobs.convert_s2orc(readers.json_lines(spark, a.metadata, readers.S2ORC_META), readers.json_lines(spark, a.s2orc, readers.S2ORC))}


@_job("original", "result")
def convert_s2orc_old(spark: SparkSession, a: Args) -> Results:
    return {a.result: jobs.convert_s2orc_old(readers.json_lines(spark, a.original, readers.S2ORC_OLD))}


@_job("original", "result", mag=_opt(str), s2orc=_opt(str), omitted=_opt(str), **_MATCH)
def convert_core(spark: SparkSession, a: Args) -> Results:
    """TEI files below a folder; with MAG and S2ORC records, their fields and ids. The omitted paths go to a file of names."""
    own = tei.directory(spark, a.original)
    papers = own.select("id", "title", "year", "authors")
    none = spark.createDataFrame([], "id bigint, title string, year int, authors array<string>, doi string, fields array<string>")
    mag = readers.mag(spark, a.mag) if a.mag else none
    probes = papers.withColumnRenamed("id", "probe_id")
    to_mag = S.to_mapping(S.search(probes, mag, **_how(a))).select(F.col("probe_id").alias("id"), F.col("id").alias("mag_id")) if a.mag else none.select("id", F.col("id").alias("mag_id"))
    to_s2 = none.select("id", F.col("id").alias("s2orc_id"))
    if a.s2orc:
        to_s2 = S.to_mapping(S.search(probes, readers.papers(spark, a.s2orc), **_how(a))).select(F.col("probe_id").alias("id"), F.col("id").alias("s2orc_id"))
    to_mag, to_s2 = reliable(to_mag), reliable(to_s2)
    docs = jobs.convert_core(own, papers, to_mag, mag, to_s2, **_how(a))
    if a.mag:
        refs = mag.join(to_mag.withColumnRenamed("id", "doc_id"), mag["id"] == F.col("mag_id")).select(F.col("doc_id").alias("id"), "references")
        back = to_mag.groupBy(F.col("mag_id").alias("old")).agg(F.max("id").alias("new"))
        same = back.select(F.col("old"), F.col("old").alias("new"))
        more = readers.mag_to_core(refs, same, back).withColumnRenamed("citations", "__more")
        none_ = F.array().cast("array<bigint>")
        docs = docs.join(more, "id", "left").withColumn("citations", F.array_sort(F.array_union(F.coalesce("citations", none_), F.coalesce("__more", none_)))).drop("__more")
    full = jobs.convert(docs)
    out = {a.result: full.drop("path")}
    if a.omitted:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.xml").load(a.original).select("path")
        out[a.omitted] = jobs.omitted(files, full)
    return out


# ---- trees -------------------------------------------------------------------------------------------------------
@_job("original", "result", discard=_FLAG, multi=_opt(str), **_ROWS)
def multi_lvl_hier(spark: SparkSession, a: Args) -> Results:
    docs, found = jobs.leveled_documents(_docs(spark, a.original, a), a.discard)
    return {a.result: docs} | ({a.multi: found} if a.multi else {})


@_job("original", "result", empty_headlines=_FLAG, no_text=_FLAG, plain_latin=_opt(float), named_text_blocks=_FLAG, filter_ids=_FLAG, **_ROWS)
def pruning_hier(spark: SparkSession, a: Args) -> Results:
    names = ["figure"] if a.named_text_blocks else None
    return {a.result: jobs.pruned_documents(_docs(spark, a.original, a), a.plain_latin, names, a.empty_headlines, a.no_text, a.filter_ids)}


# ---- collections -------------------------------------------------------------------------------------------------
@_job("first", "second", "result", **_MATCH)
def extension_subset(spark: SparkSession, a: Args) -> Results:
    second = _docs(spark, a.second)
    hits = S.search(second.select(F.col("id").alias("probe_id"), "title", "year", "authors"), _docs(spark, a.first), **_how(a))
    return {a.result: I.extension_subset(second, hits)}


@_job("first", "second", "result")
def extend_ids(spark: SparkSession, a: Args) -> Results:
    return {a.result: I.extend_ids(_docs(spark, a.first), readers.numbered(_docs(spark, a.second)), "row_pos").drop("row_pos")}


@_job("first", "second", "result", **_MATCH)
def extend(spark: SparkSession, a: Args) -> Results:
    return {a.result: jobs.extend(_docs(spark, a.first), readers.numbered(_docs(spark, a.second)), "row_pos", **_how(a)).drop("row_pos")}


@_job("dataset", "result", match_threshold=_opt(float, 1.0), max_year_diff=_opt(int, 0))
def deduplication(spark: SparkSession, a: Args) -> Results:
    docs = _docs(spark, a.dataset)
    rep = dedup.deduplicate(docs.select("id", "title", "year", "authors"), a.match_threshold, a.max_year_diff)
    to = rep.select(F.col("id").alias("old"), F.col("representative").alias("new"))
    moved = docs.select("id", F.explode("citations").alias("old")).join(to, "old").where("new <> id").groupBy("id").agg(F.array_sort(F.collect_set("new")).alias("__c"))
    kept = I.keep_ids(docs, rep.where("id = representative").select("id"))
    bib = B.explode(kept.withColumnRenamed("id", "doc_id")).join(to.withColumnRenamed("old", "id"), "id", "left").withColumn("id", F.coalesce("new", "id")).drop("new")
    out = kept.drop("citations", "bibliography").join(moved.withColumnRenamed("__c", "citations"), "id", "left").join(B.collect(bib).withColumnRenamed("doc_id", "id"), "id", "left")
    return {a.result: out.withColumns({c: F.coalesce(c, F.array().cast(docs.schema[c].dataType)) for c in ("citations", "bibliography")}).select(*docs.columns)}


@_job("dataset", "result", "ids")
def discard_documents(spark: SparkSession, a: Args) -> Results:
    return {a.result: I.discard_documents(_docs(spark, a.dataset), spark.read.schema("id bigint").csv(a.ids))}


@_job("dataset", "results")
def filter_missing_ids(spark: SparkSession, a: Args) -> Results:
    return {a.results: I.filter_missing_ids(_docs(spark, a.dataset))}


@_job("documents", "results", "references")
def create_references(spark: SparkSession, a: Args) -> Results:
    own = _docs(spark, a.documents)
    return {a.results: I.create_references(B.explode(own.withColumnRenamed("id", "doc_id")), _docs(spark, a.references))}


@_job("dataset", "results")
def sort_dataset(spark: SparkSession, a: Args) -> Results:
    return {a.results: _docs(spark, a.dataset).orderBy("id")}


@_job("results", intervals={"nargs": "+", "required": True})
def merge_intervals(spark: SparkSession, a: Args) -> Results:
    """Results of intervals, in the order given."""
    return {a.results: sinks.merge_parts(*[spark.read.text(p) for p in a.intervals])}


@_job("dataset", "database", scopus=_FLAG)
def create_title_database(spark: SparkSession, a: Args) -> Results:
    own = readers.scopus(spark, a.dataset).withColumn("id", F.monotonically_increasing_id()) if a.scopus else _docs(spark, a.dataset)
    return {a.database: sinks.titles(own)}


# ---- other catalogues and bibliographies -------------------------------------------------------------------------
@_job("mag", "core", "result", **_MATCH)
def enhance_mag_with_core(spark: SparkSession, a: Args) -> Results:
    core = tei.directory(spark, a.core)
    both = jobs.enhance_mag_with_core(readers.mag(spark, a.mag), core, B.explode(core.withColumnRenamed("id", "doc_id")), **_how(a))
    names = {"id": "PaperId", "title": "OriginalTitle", "year": "Year", "authors": "Authors", "references": "References", "fields": "Fields", "doi": "Doi", "journal": "Journal"}
    return {a.result: both.withColumnsRenamed(names)}


@_job("dataset", "mag", "result", **_MATCH)
def create_papers_2_mag_mapping(spark: SparkSession, a: Args) -> Results:
    """A line for each document: the position of its MAG record, -1 for none."""
    docs, mag = readers.numbered(_docs(spark, a.dataset)), readers.numbered(readers.mag(spark, a.mag))
    found = S.mag_mapping(docs, mag, **_how(a)).join(mag.select(F.col("id").alias("mag_id"), F.col("row_pos").alias("value")), "mag_id", "left")
    return {a.result: sinks.mapping_lines(docs.select("id", "row_pos").join(found.select("id", "value"), "id", "left"))}


@_job("dataset", "mag", "to_mag", "result", just_references=_FLAG, match_threshold=_opt(float, 0.75))
def enhance_papers_with_mag(spark: SparkSession, a: Args) -> Results:
    docs, mag = _docs(spark, a.dataset), readers.mag(spark, a.mag)
    return {a.result: jobs.enhanced_with_mag(docs, _mapping(spark, a.to_mag, docs, mag), mag, a.just_references, a.match_threshold)}


@_job("dataset", "result", search=_opt(str), **_MATCH, **_ROWS)
def identify_bibliography(spark: SparkSession, a: Args) -> Results:
    return {a.result: jobs.identified_bibliographies(_docs(spark, a.dataset, a), readers.papers(spark, a.search or a.dataset), **_how(a))}


@_job("dataset", "result", "citation_graph", id_=_opt(str, "id"), search=_opt(str), title_match_threshold=_opt(float, 0.75), authors_match_threshold=_opt(float, 1e-9), year_diff_threshold=_opt(int, 0), **_ROWS)
def enrich_bibliography_from_citation_graph(spark: SparkSession, a: Args) -> Results:
    papers, how = readers.papers(spark, a.search or a.dataset), {"title_threshold": a.title_match_threshold, "author_threshold": a.authors_match_threshold, "max_year_diff": a.year_diff_threshold}
    return {a.result: jobs.enriched_documents(_docs(spark, a.dataset, a), readers.citation_graph(spark, a.citation_graph), papers, a.id, **how)}


@_job("dataset", "result")
def identify_citation_spans(spark: SparkSession, a: Args) -> Results:
    return {a.result: jobs.documents_with_spans(_docs(spark, a.dataset))}


# ---- related work ------------------------------------------------------------------------------------------------
@_job("documents", "reviews", "references", references_dataset=_opt(str))
def related_work(spark: SparkSession, a: Args) -> Results:
    docs = _docs(spark, a.documents)
    reviews, named = jobs.related_work_documents(docs, _docs(spark, a.references_dataset) if a.references_dataset else docs)
    return {a.reviews: reviews, a.references: named}


_BOUNDS = ("cit", "cit-frac", "cit-group-frac", "sec-rev", "sec-ref", "par-rev", "par-ref", "fraction-of-cited-documents-with-multi-section-content-filter")


@_job("related_work", "references", "res_related_work", "res_references", sec_non_empty_headlines_ref=_FLAG, has_abstract_rev=_opt(int, 2), has_abstract_ref=_opt(int, 2), **{f"{end}-{b}": _opt(float) for b in _BOUNDS for end in ("min", "max")})
def related_work_filter(spark: SparkSession, a: Args) -> Results:
    """Reviews and references within bounds; an absent bound is open."""
    reviews, refs = readers.json_lines(spark, a.related_work, RELATED_WORK), _docs(spark, a.references)
    pair = lambda b: tuple(getattr(a, f"{end}_{b.replace('-', '_')}") for end in ("min", "max"))
    nodes, _, _ = jobs.parts(refs)
    wanted = [filters.number_of_sections(nodes, *pair("sec-ref")), filters.text_parts_in_sections(nodes, *pair("par-ref"))]
    if a.sec_non_empty_headlines_ref:
        wanted.append(filters.nonempty_headlines(nodes))
    if a.has_abstract_ref:
        wanted.append(filters.has_headline(nodes, T.ABSTRACT, a.has_abstract_ref, 1, 1))
    bounds = dict(zip(("cit", "cit_frac", "group_frac", "sec", "par", "multi"), map(pair, ("cit", "cit-frac", "cit-group-frac", "sec-rev", "par-rev", _BOUNDS[-1])), strict=True))
    kept, named = jobs.filtered_related_work(reviews, refs, filters.combined(*wanted), abstract=a.has_abstract_rev, **bounds)
    return {a.res_related_work: kept, a.res_references: named}


@_job("dataset", "results")
def convert_back_from_rw(spark: SparkSession, a: Args) -> Results:
    return {a.results: jobs.documents_from_related_work(readers.json_lines(spark, a.dataset, RELATED_WORK))}


@_job("dataset", "orig", "results")
def convert_back_to_rw(spark: SparkSession, a: Args) -> Results:
    return {a.results: jobs.documents_to_related_work(_docs(spark, a.dataset), readers.json_lines(spark, a.orig, RELATED_WORK))}


@_job("dataset", "references", "train", "val", "test", test_prop=_opt(float, 0.1), val_prop=_opt(float, 0.1), fixed_seed=_opt(int, 42))
def make_rw_train_val_test_splits(spark: SparkSession, a: Args) -> Results:
    docs = readers.json_lines(spark, a.dataset, RELATED_WORK)
    tops = jobs.parts(_docs(spark, a.references))[0].where("depth = 1").groupBy("doc_id").agg(F.count("*").alias("n"))
    edges = docs.select(F.col("id").alias("citing"), F.explode("citations").alias("cited"))
    own = jobs.split_dataset(docs, edges, tops, a.val_prop, a.test_prop, a.fixed_seed)
    return {getattr(a, p): own.where(F.col("part") == p).drop("part") for p in ("train", "val", "test")}


# ---- statistics --------------------------------------------------------------------------------------------------
def _features(spark: SparkSession, a: Args) -> DataFrame:
    docs = readers.json_lines(spark, a.dataset, RELATED_WORK) if a.rw else _docs(spark, a.dataset)
    nodes, spans, bib = jobs.parts(docs, "related_work" if a.rw else "hierarchy")
    pool = _docs(spark, a.references) if a.references else docs
    tops = jobs.parts(pool)[0].where("depth = 1").groupBy("doc_id").agg(F.count("*").alias("n"))
    whole = jobs.parts(docs)[0] if a.rw else nodes
    flat = docs.withColumnRenamed("id", "doc_id")
    return stats.features(flat, nodes, spans, bib, pool.select("id")).join(stats.review_features(flat, nodes, spans, bib, tops, whole), "doc_id", "left")


@_job("dataset", "result", references=_opt(str), rw=_FLAG)
def filter_features(spark: SparkSession, a: Args) -> Results:
    return {a.result: _features(spark, a)}


@_job("dataset", "result", references=_opt(str), rw=_FLAG)
def stats_(spark: SparkSession, a: Args) -> Results:
    """(metric, value, count); of reviews, also of what they cite."""
    docs = readers.json_lines(spark, a.dataset, RELATED_WORK) if a.rw else _docs(spark, a.dataset)
    nodes, spans, bib = jobs.parts(docs, "related_work" if a.rw else "hierarchy")
    pool = _docs(spark, a.references) if a.references else docs
    out = stats.documents_stats(docs.withColumnRenamed("id", "doc_id"), nodes, spans, bib, pool.select("id"))
    if a.rw:
        full = jobs.parts(pool)[0]
        tops = tree.abstract(full).select("doc_id", "path")
        edges = docs.select(F.col("id").alias("citing"), F.explode("citations").alias("cited"))
        out = out.unionByName(stats.related_work_stats(nodes, edges, tree.cut(full, tops), full))
    return {a.result: out}


JOBS = list(_jobs)


def run(spark: SparkSession, args: Args) -> Results:
    """The results of a job by the paths where they go; nothing is written."""
    return _jobs[args.job][0](spark, args)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=__doc__)
    sub = p.add_subparsers(dest="job", required=True)
    for name, (f, paths, options) in _jobs.items():
        own = sub.add_parser(name, description=f.__doc__)
        for x in paths:
            own.add_argument(x)
        for o, how in options.items():
            own.add_argument(f"--{o.strip('-')}", **how)
        own.add_argument("--indexed", action="store_true")
    return p


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"quillspark {args.job}").getOrCreate()
    for path, df in run(spark, args).items():
        if args.indexed and "id" in df.columns:
            rows = (json.loads(r.value) for r in sinks.as_json(df).toLocalIterator())
            sinks.write_indexed(((r["id"], r) for r in rows), path)
        elif df.columns == ["value"]:
            df.write.text(path)
        else:
            sinks.write_json_lines(df, path)


if __name__ == "__main__":
    main()
