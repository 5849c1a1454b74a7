"""Whole jobs as compositions of operators; each returns DataFrames and writes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions import text as T
from quillspark.operators import bibliography as B
from quillspark.operators import dedup, filters, multilevel, tree
from quillspark.operators import ids as I  # noqa: E741
from quillspark.operators.search import search
from quillspark.operators.spans import harvard_spans
from quillspark.schema import SPAN
from quillspark.session import reliable
from quillspark.sources import readers

_SERIAL = r"\W*(?:(?:[0-9]+|[ivx]+|[a-z])(?:\.[0-9a-z]+)*[.:)]?\s+)?"
RELATED_WORK = rf"(?i){_SERIAL}(?:related\s+works?|related\s+literature|theoretical\s+background|literature\s+review|review\s+of\s+(?:the\s+)?literature)\W*$"
BACKGROUND = rf"(?i){_SERIAL}background\W*$"
INTRODUCTION = rf"(?i){_SERIAL}introduction\W*$"


def convert(docs: DataFrame) -> DataFrame:
    """Full records with dense ids, citations cut to them and translated.

    Documents are needed three times, so what parses and assembles them runs once, into a checkpoint."""
    docs = reliable(docs)
    nodes = tree.flatten(docs.withColumnRenamed("id", "doc_id"))
    ok = filters.passing(filters.full_record(docs.withColumnRenamed("id", "doc_id"), nodes)).withColumnRenamed("doc_id", "id")
    kept = I.discard_documents(docs, ok)
    new = reliable(I.dense_ids(ok))
    cited = kept.select("id", F.explode("citations").alias("old")).join(new, "old").groupBy("id").agg(F.array_sort(F.collect_set("new")).alias("c"))
    out = kept.join(cited, "id", "left").withColumn("citations", F.coalesce("c", F.array().cast("array<bigint>"))).drop("c")
    return out.withColumnRenamed("id", "old").join(new, "old").withColumnRenamed("new", "id").drop("old").select(*docs.columns)


def omitted(paths: DataFrame, converted: DataFrame) -> DataFrame:
    """Source paths that gave no document."""
    return paths.join(converted.select("path"), "path", "left_anti")


def related_work_sections(nodes: DataFrame) -> DataFrame:
    """(doc_id, path) of the one related-work section of depth 1 with text, or of a single background section as high as
    the introduction, where the introduction holds no background itself."""
    tops = nodes.where("depth = 1")
    full = nodes.where(F.length("text") > 0).select("doc_id", F.slice("path", 1, 1).alias("path")).distinct()

    def only(df: DataFrame) -> DataFrame:
        one = df.groupBy("doc_id").agg(F.count("*").alias("n"), F.min("path").alias("path"), F.min("height").alias("height")).where("n = 1").drop("n")
        return one

    named = tops.where(F.col("headline").rlike(f"^{RELATED_WORK}"))
    first = only(named).select("doc_id", "path")
    intro = tops.where(F.col("headline").rlike(f"^{INTRODUCTION}")).groupBy("doc_id").agg(F.min("path").alias("ip"), F.min_by("height", "path").alias("ih"))
    inner = nodes.where((F.col("depth") > 1) & F.col("headline").rlike(f"^{BACKGROUND}")).select("doc_id", F.slice("path", 1, 1).alias("ip")).distinct()
    back = only(tops.where(F.col("headline").rlike(f"^{BACKGROUND}"))).join(named.select("doc_id").distinct(), "doc_id", "left_anti")
    back = back.join(intro, "doc_id").where("height = ih").join(inner, ["doc_id", "ip"], "left_anti").select("doc_id", "path")
    return first.unionByName(back).join(full, ["doc_id", "path"], "left_semi")


def related_work(nodes: DataFrame, spans: DataFrame, bib: DataFrame, available: DataFrame) -> dict[str, DataFrame]:
    """Targets cut out of documents that also have an abstract with text.

    `sections` (doc_id, path), `rest` (NODES without them, the abstract first), `target` (NODES of the sections, rooted),
    `rest_spans` and `target_spans` (SPANS at their nodes' new places), `citations` (doc_id, citations: resolved ids cited
    in the section that are available (id)), `references` (id)."""
    abstracts = tree.abstract(nodes).select("doc_id", F.col("path").alias("__a"))
    at = related_work_sections(nodes).join(abstracts.select("doc_id"), "doc_id", "left_semi")
    own = nodes.join(at.select("doc_id").distinct(), "doc_id", "left_semi")
    target, target_spans = tree.cut(own, at, spans)
    inside = spans.where("kind = 'cit'").join(at.withColumnRenamed("path", "__at"), "doc_id").where(F.slice("path", 1, 1) == F.col("__at"))
    ids = inside.join(bib.where("id is not null").select("doc_id", F.col("pos").alias("index"), "id"), ["doc_id", "index"]).join(available.select("id").distinct(), "id", "left_semi")
    cites = at.select("doc_id").join(ids.groupBy("doc_id").agg(F.array_sort(F.collect_set("id")).alias("citations")), "doc_id", "left").withColumn("citations", F.coalesce("citations", F.array().cast("array<bigint>")))
    head, first = F.get("path", F.lit(0)), F.get("__a", F.lit(0))
    place = F.when(head == first, F.lit(0)).when(head < first, head + 1).otherwise(head)

    def fronted(df: DataFrame) -> DataFrame:
        rest = F.concat(F.array(place), F.slice("path", F.lit(2), F.greatest(F.size("path") - 1, F.lit(0))))
        return df.join(abstracts, "doc_id").withColumn("path", F.when(F.size("path") > 0, rest).otherwise(F.col("path"))).drop("__a")

    kept, kept_spans = tree.remove(fronted(own), fronted(at), fronted(spans.join(at.select("doc_id"), "doc_id", "left_semi")))
    refs = bib.join(at.select("doc_id"), "doc_id", "left_semi").where("id is not null").select("id").distinct().join(available.select("id"), "id", "left_semi")
    return {"sections": at, "rest": kept, "rest_spans": kept_spans, "target": target, "target_spans": target_spans, "citations": cites, "references": refs}


def related_work_filter(reference_filter: DataFrame, targets: DataFrame, target_filter) -> DataFrame:
    """Targets whose citations, cut to references that pass, let them pass target_filter (papers -> (doc_id, passed))."""
    kept = filters.passing(reference_filter).withColumnRenamed("doc_id", "id")
    cut = I.filter_citations(targets, kept)
    ok = filters.passing(target_filter(cut)).withColumnRenamed("doc_id", "id")
    return I.keep_ids(cut, ok)


def back_from_related_work(rest: DataFrame, target: DataFrame, at: DataFrame, bib: DataFrame, rest_spans: DataFrame, target_spans: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """NODES and SPANS with the sections put back in, and citations from the whole bibliography."""
    return *tree.insert(rest, target, at, rest_spans, target_spans), B.citations(bib)


def back_to_related_work(nodes: DataFrame, at: DataFrame, spans: DataFrame) -> dict[str, DataFrame]:
    """`rest` and `rest_spans` without the sections at known paths (doc_id, path), `target` and `target_spans` of them."""
    target, inside = tree.cut(nodes, at, spans)
    rest, left = tree.remove(nodes, at, spans)
    return {"rest": rest, "rest_spans": left, "target": target, "target_spans": inside}


def pruned(nodes: DataFrame, spans: DataFrame, bib: DataFrame, coverage: float | None = None, names: list[str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """NODES, SPANS and bibliography after pruning: documents without text go, and what refers to them loses its id."""
    left, moved = tree.prune_all(nodes, coverage, names, spans)
    full = filters.passing(tree.has_text(left).withColumnRenamed("has_text", "passed"))
    gone = nodes.where("depth = 0").select("doc_id").join(full, "doc_id", "left_anti").select(F.col("doc_id").alias("id"), F.lit(True).alias("__gone"))
    cut_ = bib.join(full, "doc_id", "left_semi").join(gone, "id", "left").withColumn("id", F.when(F.col("__gone").isNull(), F.col("id"))).select(*bib.columns)
    return left.join(full, "doc_id", "left_semi"), moved.join(full, "doc_id", "left_semi"), cut_


def identified_spans(leaves: DataFrame, bib: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leaves with citations by name added and resolved, and (doc_id, growth): how many more spans have an entry."""
    new = harvard_spans(leaves, bib)
    n = lambda df: df.groupBy("doc_id").agg(F.sum(F.size(F.filter("spans", lambda x: x["index"].isNotNull()))).alias("n"))
    grown = n(new).join(n(leaves).withColumnRenamed("n", "old"), "doc_id").select("doc_id", (F.col("n") - F.col("old")).alias("growth"))
    return new, grown


def with_spans(nodes: DataFrame, spans: DataFrame) -> DataFrame:
    """Leaves (doc_id, path, headline, text, spans) of NODES and citation SPANS."""
    own = F.array_sort(F.collect_list(F.struct("pos", "index", "start", "end")))
    rows = spans.where("kind = 'cit'").groupBy("doc_id", "path").agg(F.transform(own, lambda x: F.struct(x["index"].alias("index"), x["start"].alias("start"), x["end"].alias("end"))).alias("spans"))
    return nodes.where("text is not null").join(rows, ["doc_id", "path"], "left").select("doc_id", "path", "headline", "text", F.coalesce("spans", F.array().cast(f"array<{SPAN}>")).alias("spans"))


def without_spans(leaves: DataFrame, nodes: DataFrame, spans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """NODES and SPANS with the texts and citation spans of leaves."""
    new = leaves.select("doc_id", "path", F.posexplode("spans").alias("pos", "s")).select("doc_id", "path", F.lit("cit").alias("kind"), "pos", "s.*")
    both = nodes.drop("text").join(leaves.select("doc_id", "path", "text"), ["doc_id", "path"], "left").select(*nodes.columns)
    return both, spans.where("kind <> 'cit'").unionByName(new.select(*spans.columns))


def extend(first: DataFrame, second: DataFrame, order: str, **how) -> DataFrame:
    """Papers of both, those of second with ids after first's; unknown bibliography entries of each are searched in the other."""
    moved = I.extend_ids(first, second, order)

    def found(docs: DataFrame, pool: DataFrame) -> DataFrame:
        bib = B.identify(B.explode(docs.withColumnRenamed("id", "doc_id")), pool.select("id", "title", "year", "authors"), **how)
        both = B.collect(bib).join(B.citations(bib), "doc_id").withColumnRenamed("doc_id", "id")
        return docs.drop("bibliography", "citations").join(both, "id", "left").withColumn("citations", F.coalesce("citations", F.array().cast("array<bigint>")))

    return found(first, moved).unionByName(found(moved, first), allowMissingColumns=True)


def deduplicated(papers: DataFrame, edges: DataFrame, **how) -> tuple[DataFrame, DataFrame]:
    """Representatives, and edges between them."""
    rep = dedup.deduplicate(papers, **how)
    mapping = rep.select(F.col("id").alias("old"), F.col("representative").alias("new"))
    kept = I.keep_ids(papers, rep.where("id = representative").select("id"))
    return kept, I.translate_edges(edges, mapping).where("citing <> cited")


def enhance_mag_with_core(mag: DataFrame, core: DataFrame, core_bib: DataFrame, **how) -> DataFrame:
    """MAG records (id, title, year, authors, references) and CORE papers that aren't among them, with references united.

    core_bib: (doc_id, pos, title, year, authors). New ids follow MAG's, with the gaps that dropped duplicates leave."""
    probes = core.select(F.col("id").alias("probe_id"), "title", "year", "authors")
    hit = search(probes, mag, **how)
    found, new = hit.where("id is not null").select(F.col("probe_id").alias("core"), "id"), hit.where("id is null").select("probe_id")
    fresh = core.join(new.withColumnRenamed("probe_id", "id"), "id", "left_semi")
    rep = dedup.deduplicate(fresh, **how)
    top = mag.agg(F.max("id").alias("top"))
    number = I.dense_ids(fresh.select("id")).crossJoin(F.broadcast(top)).select(F.col("old").alias("representative"), (F.col("top") + 1 + F.col("new")).alias("new_id"))
    as_mag = found.unionByName(rep.join(number, "representative").select(F.col("id").alias("core"), F.col("new_id").alias("id")))
    entries = core_bib.select(F.struct("doc_id", "pos").alias("probe_id"), "title", "year", "authors")
    refs = search(entries, mag, **how).where("id is not null").select(F.col("probe_id.doc_id").alias("core"), F.col("id").alias("ref"))
    more = refs.join(as_mag, "core").groupBy("id").agg(F.collect_set("ref").alias("more"))
    kept = fresh.join(rep.where("id = representative").select("id"), "id", "left_semi").select(F.col("id").alias("representative"), "title", "year", "authors").join(number, "representative").select(F.col("new_id").alias("id"), "title", "year", "authors", F.array().cast("array<bigint>").alias("references"))
    both = mag.unionByName(kept, allowMissingColumns=True)
    empty = F.array().cast("array<bigint>")
    return both.join(more, "id", "left").withColumn("references", F.array_sort(F.array_union(F.coalesce("references", empty), F.coalesce("more", empty)))).drop("more")


def create_references(bib: DataFrame, pool: DataFrame) -> DataFrame:
    return I.create_references(bib, pool)


def split_dataset(papers: DataFrame, edges: DataFrame, tops: DataFrame, val: float, test: float, seed: int = 42) -> DataFrame:
    """papers with `part`; only those all of whose cited documents have several sections may leave train."""
    bad = edges.join(tops.where("n > 1").select(F.col("doc_id").alias("cited")), "cited", "left_anti").select(F.col("citing").alias("id")).distinct().withColumn("__bad", F.lit(True))
    own = papers.join(bad, "id", "left")
    return I.split(own, val, test, F.col("__bad").isNull(), seed).select(*papers.columns, "part")


def convert_core(docs: DataFrame, papers: DataFrame, mapping: DataFrame, mag: DataFrame, s2orc_mapping: DataFrame, **how) -> DataFrame:
    """TEI documents with identified bibliographies, MAG's fields and S2ORC's ids."""
    bib = B.identify(B.explode(docs.withColumnRenamed("id", "doc_id")), papers, **how)
    both = B.collect(bib).join(B.citations(bib), "doc_id").withColumnRenamed("doc_id", "id")
    own = docs.drop("bibliography", "citations").join(both, "id", "left")
    for c, kind in (("mag_id", "bigint"), ("doi", "string"), ("fields_of_study", "array<string>")):
        if c not in own.columns:
            own = own.withColumn(c, F.lit(None).cast(kind))
    out = B.enhance_with_mag(own, mapping, mag)
    return out.join(s2orc_mapping.select("id", "s2orc_id"), "id", "left")


def last(df: DataFrame, order: str) -> DataFrame:
    return I.last_row(df, order)


def convert_s2orc(meta: DataFrame, full: DataFrame) -> DataFrame:
    docs = readers.s2orc(meta, full)
    return convert(docs)


def convert_s2orc_old(raw: DataFrame) -> DataFrame:
    docs = readers.s2orc_old(raw)
    return convert(docs)



def parts(docs: DataFrame, column: str = "hierarchy") -> tuple[DataFrame, DataFrame, DataFrame]:
    """NODES, SPANS and bibliography of documents (id, hierarchy, bibliography)."""
    flat = docs.withColumnRenamed("id", "doc_id")
    return tree.flatten(flat, column), tree.flatten_spans(flat, column), B.explode(flat)


def _tree(docs: DataFrame, nodes: DataFrame, spans: DataFrame, column: str = "hierarchy") -> DataFrame:
    """docs that still have nodes, with the trees of them."""
    new = tree.rebuild(nodes, spans).select(F.col("doc_id").alias("id"), F.col("hierarchy").alias("__tree"))
    return docs.drop(column).join(new, "id").withColumnRenamed("__tree", column)


def _bibliography(docs: DataFrame, bib: DataFrame, cited: bool = True) -> DataFrame:
    """docs with new bibliographies and, if cited, the citations that follow from them."""
    new = B.collect(bib)
    if cited:
        new = new.join(B.citations(bib), "doc_id")
    out = docs.drop(*[c for c in new.columns if c != "doc_id"]).join(new.withColumnRenamed("doc_id", "id"), "id", "left")
    for c in ("bibliography", "citations") if cited else ("bibliography",):
        out = out.withColumn(c, F.coalesce(c, F.array().cast(docs.schema[c].dataType)))
    return out


def pruned_documents(docs: DataFrame, coverage: float | None = None, names: list[str] | None = None, empty: bool = True, textless: bool = True, cut: bool = False) -> DataFrame:
    """Documents after the pruning steps asked for; those without text left go, with cut also from citations and entries."""
    nodes, spans, bib = parts(docs)
    left, moved = tree.prune_all(nodes, coverage, names, spans, empty, textless)
    full = filters.passing(tree.has_text(left).withColumnRenamed("has_text", "passed"))
    kept = full.withColumnRenamed("doc_id", "id")
    out = _tree(I.discard_documents(docs, kept) if cut else I.keep_ids(docs, kept), left, moved)
    return out.select(*docs.columns)


def leveled_documents(docs: DataFrame, discard: bool = False) -> tuple[DataFrame, DataFrame]:
    """Documents with trees of several levels, and the ids (id) of those where levels were found."""
    new = multilevel.restructure(docs.withColumnRenamed("id", "doc_id"), discard).withColumnRenamed("doc_id", "id")
    return docs.drop("hierarchy").join(new.drop("established"), "id").select(*docs.columns), new.where("established").select("id")


def related_work_documents(docs: DataFrame, references: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Reviews, whose trees lack the section that became `related_work`, and the references that they name."""
    nodes, spans, bib = parts(docs)
    out = related_work(nodes, spans, bib, references)
    at = out["sections"].select(F.col("doc_id").alias("id"), F.col("path").alias("related_work_orig_path"))
    own = docs.drop("citations").join(at, "id").join(out["citations"].withColumnRenamed("doc_id", "id"), "id")
    own = _tree(_tree(own, out["rest"], out["rest_spans"]), out["target"], out["target_spans"], "related_work")
    return own.select(*docs.columns, "related_work", "related_work_orig_path"), I.keep_ids(references, out["references"])


def documents_from_related_work(reviews: DataFrame) -> DataFrame:
    """Whole documents of reviews: the section is back at its place, citations are those of the bibliography."""
    nodes, spans, bib = parts(reviews)
    target, inside, _ = parts(reviews, "related_work")
    at = reviews.select(F.col("id").alias("doc_id"), F.col("related_work_orig_path").alias("path"))
    whole, moved, cites = back_from_related_work(nodes, target, at, bib, spans, inside)
    out = _tree(reviews.drop("citations", "related_work", "related_work_orig_path"), whole, moved).join(cites.withColumnRenamed("doc_id", "id"), "id", "left")
    return out.withColumn("citations", F.coalesce("citations", F.array().cast("array<bigint>"))).select(*[c for c in reviews.columns if not c.startswith("related_work")])


def documents_to_related_work(docs: DataFrame, reviews: DataFrame) -> DataFrame:
    """Whole documents cut again at the places that reviews of the same ids have."""
    own = docs.join(reviews.select("id", "related_work_orig_path"), "id")
    nodes, spans, _ = parts(own)
    out = back_to_related_work(nodes, own.select(F.col("id").alias("doc_id"), F.col("related_work_orig_path").alias("path")), spans)
    return _tree(_tree(own, out["rest"], out["rest_spans"]), out["target"], out["target_spans"], "related_work").select(*docs.columns, "related_work", "related_work_orig_path")


def identified_bibliographies(docs: DataFrame, papers: DataFrame, **how) -> DataFrame:
    """Documents whose unknown bibliography entries got ids of papers, and the citations that follow."""
    return _bibliography(docs, B.identify(B.explode(docs.withColumnRenamed("id", "doc_id")), papers, **how)).select(*docs.columns)


def documents_with_spans(docs: DataFrame) -> DataFrame:
    """Documents with citations by name found in their texts and resolved by their bibliographies."""
    nodes, spans, bib = parts(docs)
    leaves, _ = identified_spans(with_spans(nodes, spans), bib)
    return _tree(docs, *without_spans(leaves, nodes, spans)).select(*docs.columns)


def enriched_documents(docs: DataFrame, edges: DataFrame, papers: DataFrame, key: str = "id", **how) -> DataFrame:
    """Documents whose bibliographies have the papers that a graph names for them. The graph's ids are in column `key` of
    docs and papers."""
    named = papers.where(F.col(key).isNotNull()).select(F.col(key).alias("cited"), F.col("id").alias("__id"))
    own = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("citing"), F.col("id").alias("__doc"))
    e = edges.join(own, "citing").join(named, "cited").select(F.col("__doc").alias("citing"), F.col("__id").alias("cited")).where("citing <> cited")
    bib = B.enrich_from_graph(B.explode(docs.withColumnRenamed("id", "doc_id")), e, papers, **how)
    return _bibliography(docs, bib).select(*docs.columns)


def enhanced_with_mag(docs: DataFrame, mapping: DataFrame, mag: DataFrame, just_references: bool = False, title_threshold: float = 0.75) -> DataFrame:
    """Documents merged with their MAG records (mapping: id, mag_id): fields as in enhance_with_mag unless just_references;
    references that are documents themselves become citations, and all references are merged into the bibliography."""
    out = docs.withColumn("authors", T.dedup_authors(F.coalesce("authors", F.array().cast("array<string>")))) if just_references else B.enhance_with_mag(docs, mapping, mag)
    to_doc = mapping.where("mag_id is not null").groupBy(F.col("mag_id").alias("ref")).agg(F.max("id").alias("id"))
    refs = mapping.select(F.col("id").alias("doc_id"), F.col("mag_id").alias("__m")).join(mag.select(F.col("id").alias("__m"), F.posexplode("references").alias("key", "ref")), "__m")
    records = refs.join(mag.select(F.col("id").alias("ref"), "title", "year", "authors"), "ref").join(to_doc, "ref", "left").select("doc_id", "key", "id", "title", "year", "authors")
    bib = B.merge_records(B.explode(docs.withColumnRenamed("id", "doc_id")), records, author_threshold=1e-9, title_threshold=title_threshold)
    more = records.where("id is not null").groupBy(F.col("doc_id").alias("id")).agg(F.collect_set("id").alias("__more"))
    none = F.array().cast("array<bigint>")
    out = _bibliography(out, bib, cited=False).join(more, "id", "left")
    return out.withColumn("citations", F.array_sort(F.array_union(F.coalesce("citations", none), F.coalesce("__more", none)))).select(*docs.columns)


def filtered_related_work(reviews: DataFrame, references: DataFrame, reference_filter: DataFrame, **bounds) -> tuple[DataFrame, DataFrame]:
    """Reviews and references that pass. Bounds are (least, most) pairs: cit, cit_frac, group_frac, sec, par, multi; and
    abstract, the text parts that an abstract needs (0: none is needed)."""
    kept = I.keep_ids(references, filters.passing(reference_filter).withColumnRenamed("doc_id", "id"))
    tops = parts(kept)[0].where("depth = 1").groupBy("doc_id").agg(F.count("*").alias("n"))
    bound = lambda k: bounds.get(k) or (None, None)

    def passed(cut: DataFrame) -> DataFrame:
        docs = cut.withColumnRenamed("id", "doc_id")
        nodes, spans, bib = parts(cut, "related_work")
        edges = docs.select(F.col("doc_id").alias("citing"), F.explode("citations").alias("cited"))
        multi = bound("multi")
        own = [
            filters.number_of_citations(docs, *bound("cit")), filters.citations_fraction(docs, spans, bib, *bound("cit_frac")), filters.citation_groups_fraction(nodes, spans, bib, *bound("group_frac")),
            filters.number_of_sections(nodes, *bound("sec")), filters.text_parts_in_sections(nodes, *bound("par"), whole=True), filters.cited_multi_section(edges, docs, tops, multi[0] or 0.0, 1.0 if multi[1] is None else multi[1]),
        ]
        if bounds.get("abstract"):
            own.append(filters.has_headline(parts(cut)[0], T.ABSTRACT, bounds["abstract"], 1, 1))
        return filters.combined(*own)

    return related_work_filter(reference_filter, reviews, passed), kept


def extracted(lines: DataFrame) -> DataFrame:
    """Lines (value) of the parts of a download, in order of corpusid; lines that aren't JSON are an error."""
    key = F.get_json_object("value", "$.corpusid").cast("bigint")
    bad = F.raise_error(F.concat(F.lit("no corpusid in: "), F.substring("value", 1, 80)))
    return lines.where("trim(value) <> ''").select(F.coalesce(key, bad.cast("bigint")).alias("corpusid"), "value").orderBy("corpusid").select("value")


def extracted_graph(lines: DataFrame) -> DataFrame:
    """(citing, cited array) of lines of citations (citingcorpusid, citedcorpusid); those without both ends are dropped."""
    at = lambda k: F.get_json_object("value", f"$.{k}").try_cast("bigint")
    return I.citation_graph(lines.select(at("citingcorpusid").alias("citing"), at("citedcorpusid").alias("cited")))
