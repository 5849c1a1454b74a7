"""Statistics and features of documents: long tables of (metric, value, count), partial and final in one aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions import text as T
from quillspark.operators import tree
from quillspark.operators.filters import resolved
from quillspark.operators.spans import citation_places, citation_style, group


def tree_stats(nodes: DataFrame) -> DataFrame:
    """(doc_id, sections, paragraphs, sentences, words, chars); the root counts as a section."""
    txt = F.col("text")
    return nodes.groupBy("doc_id").agg(
        (F.count_if((F.col("height") >= 2) & (F.col("depth") > 0)) + 1).alias("sections"), F.count_if((F.col("height") == 1) & F.col("headline").isNull()).alias("paragraphs"),
        F.count(txt).alias("sentences"), F.coalesce(F.sum(T.word_count(txt)), F.lit(0)).alias("words"), F.coalesce(F.sum(F.length(txt)), F.lit(0)).cast("bigint").alias("chars"),
    )


def vocabulary(nodes: DataFrame) -> DataFrame:
    """One row: distinct lower-case words."""
    return nodes.where("text is not null").select(F.explode(T.words(F.lower("text"))).alias("w")).agg(F.countDistinct("w").alias("vocabulary"))


def cited_stats(edges: DataFrame, per_doc: DataFrame) -> DataFrame:
    """tree_stats of all cited documents together, for each citing one."""
    names = ["sections", "paragraphs", "sentences", "words", "chars"]
    return edges.join(per_doc.withColumnRenamed("doc_id", "cited"), "cited").groupBy("citing").agg(*[F.sum(n).alias(n) for n in names])


def histogram(per_doc: DataFrame, metrics: list[str]) -> DataFrame:
    """(metric, value, count) over rows of a feature frame."""
    long = per_doc.select(F.explode(F.map_from_arrays(F.array(*[F.lit(m) for m in metrics]), F.array(*[F.col(m).cast("bigint") for m in metrics]))).alias("metric", "value"))
    return long.groupBy("metric", "value").agg(F.count("*").alias("count"))


def merge(*parts: DataFrame) -> DataFrame:
    """Histograms of parts of a collection, together."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("metric", "value").agg(F.sum("count").alias("count"))


def render(hist: DataFrame, buckets: int = 40) -> DataFrame:
    """(metric, bucket, low, high, count): equal integer buckets from each metric's least to its greatest value."""
    ends = hist.groupBy("metric").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    own = hist.where("value is not null").join(ends, "metric").withColumn("w", F.greatest(F.lit(1), F.ceil((F.col("hi") - F.col("lo") + 1) / buckets)))
    b = F.floor((F.col("value") - F.col("lo")) / F.col("w"))
    return own.withColumn("bucket", b).groupBy("metric", "bucket", (F.col("lo") + F.col("bucket") * F.col("w")).alias("low"), (F.col("lo") + (F.col("bucket") + 1) * F.col("w") - 1).alias("high")).agg(F.sum("count").alias("count"))


def features(docs: DataFrame, nodes: DataFrame, spans: DataFrame, bib: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Per document, one row: counts of authors, citations, sections, text, spans, groups and bibliography, and the style.

    docs: (doc_id, year, authors, citations, fields_of_study, non_plaintext_content); known: ids (id) that exist."""
    leaf = nodes.where("text is not null")
    per = tree_stats(nodes)
    tops = nodes.where("depth = 1").groupBy("doc_id").agg(F.count("*").alias("top_sections"), F.count_if(F.coalesce("headline", F.lit("")) != "").alias("top_headlines"))
    heads = tree.sections(nodes).groupBy("doc_id").agg(F.count_if(F.coalesce("headline", F.lit("")) != "").alias("nonempty_headlines"), F.count("*").alias("inner_sections"))
    per_top = leaf.groupBy("doc_id", F.slice("path", 1, 1).alias("t")).agg(F.count("*").alias("n")).groupBy("doc_id").agg(F.min("n").alias("min_parts"), F.max("n").alias("max_parts"))
    cites = resolved(spans, bib)
    frac = cites.groupBy("doc_id").agg(F.count("*").alias("citation_spans"), F.count_if("known").alias("resolved_spans"))
    grouped = group(cites, ["doc_id", "path"], leaf.select("doc_id", "path", "text")).groupBy("doc_id", "path", "group_no").agg(F.bool_or("known").alias("known"))
    grouped = grouped.groupBy("doc_id").agg(F.count("*").alias("citation_groups"), F.count_if("known").alias("resolved_groups"))
    entries = bib.groupBy("doc_id").agg(F.count("*").alias("bib_entries"), F.count("id").alias("bib_with_id"))
    size = lambda c: F.coalesce(F.size(c), F.lit(0)).alias(f"n_{c}")
    out = docs.select("doc_id", "year", *[size(c) for c in ("authors", "citations", "fields_of_study", "non_plaintext_content") if c in docs.columns])
    if known is not None:
        cited = docs.select("doc_id", F.explode("citations").alias("id")).join(known.select("id").distinct(), "id", "left_semi").groupBy("doc_id").agg(F.count("*").alias("known_citations"))
        out = out.join(cited, "doc_id", "left")
    for other in (per, tops, heads, per_top, frac, grouped, entries):
        out = out.join(other, "doc_id", "left")
    counts = [c for c in out.columns if c not in ("doc_id", "year")]
    return out.fillna(0, counts).join(citation_style(leaf), "doc_id", "left")


def review_features(docs: DataFrame, nodes: DataFrame, spans: DataFrame, bib: DataFrame, tops: DataFrame, whole: DataFrame | None = None) -> DataFrame:
    """Per document, fractions and lengths that tell how well its citations are covered; 0 where nothing is to be counted.

    nodes, spans: of the tree in question (a section of related work, or the whole); whole: NODES with the abstract, if
    other than nodes; tops: (doc_id, n) top-level nodes of all documents that can be cited, of which NODES aren't needed
    here. A paragraph is a node of height 1; its citations count as one where any of them is known."""
    leaf = nodes.where("text is not null").select("doc_id", "path", "text")
    multi = tops.select(F.col("doc_id").alias("id"), (F.col("n") > 1).alias("multi"))
    entry = bib.where("id is not null").select("doc_id", F.col("pos").alias("index"), "id").join(multi, "id", "left").select("doc_id", "index", F.lit(True).alias("known"), F.coalesce("multi", F.lit(False)).alias("multi"))
    cites = spans.where("kind = 'cit'").join(entry, ["doc_id", "index"], "left").join(leaf.select("doc_id", "path"), ["doc_id", "path"]).fillna(False, ["known", "multi"])
    per_cite = cites.groupBy("doc_id").agg(F.avg(F.col("known").cast("int")).alias("known_fraction"), F.avg(F.col("index").isNull().cast("int")).alias("unknown_entry_fraction"))
    per_group = group(cites, ["doc_id", "path"], leaf).groupBy("doc_id", "path", "group_no").agg(F.bool_or("known").alias("known"), F.bool_or("multi").alias("multi")).groupBy("doc_id").agg(F.avg(F.col("known").cast("int")).alias("known_group_fraction"), F.avg(F.col("multi").cast("int")).alias("multi_group_fraction"))
    paragraph = F.when(F.size("path") > 0, tree.parent(F.col("path"))).otherwise(F.col("path"))
    per_par = cites.groupBy("doc_id", paragraph.alias("p")).agg(F.bool_or("known").alias("known"), F.bool_or("multi").alias("multi")).groupBy("doc_id").agg(F.avg(F.col("known").cast("int")).alias("known_paragraph_fraction"), F.avg(F.col("multi").cast("int")).alias("multi_paragraph_fraction"))
    entries = bib.groupBy("doc_id").agg((F.count("id") / F.count("*")).alias("known_entry_fraction"))
    cited = docs.select("doc_id", F.explode("citations").alias("id")).join(multi, "id", "left").groupBy("doc_id").agg(F.avg(F.coalesce("multi", F.lit(False)).cast("int")).alias("multi_cited_fraction"))

    def length(n: DataFrame, name: str) -> DataFrame:
        headed = F.when(F.col("height") == 2, T.word_count(F.coalesce("headline", F.lit(""))))
        words = F.coalesce(F.sum(T.word_count(F.col("text"))), F.lit(0)) + F.coalesce(F.sum(headed), F.lit(0))
        return n.groupBy("doc_id").agg(words.cast("bigint").alias(f"{name}_words"), F.count("text").alias(f"{name}_text_parts"))

    every = nodes if whole is None else whole
    top = tree.abstract(every).select("doc_id", F.col("path").alias("__t"))
    inside = every.join(top, "doc_id").where(F.slice("path", 1, 1) == F.col("__t"))
    input_ = docs.select("doc_id", F.explode("citations").alias("id")).join(length(every, "input").withColumnRenamed("doc_id", "id"), "id").groupBy("doc_id").agg(F.sum("input_words").alias("input_words"), F.sum("input_text_parts").alias("input_text_parts"))
    out = docs.select("doc_id")
    for other in (per_cite, per_group, per_par, entries, cited, length(nodes, "target"), length(inside, "abstract"), input_, top.select("doc_id", F.lit(1).alias("has_abstract"))):
        out = out.join(other, "doc_id", "left")
    return out.fillna(0)


def _uncited(docs: DataFrame, spans: DataFrame, bib: DataFrame) -> DataFrame:
    """(doc_id, all_known, uncited): 1 if every citation span has a known entry; 1 if a citation has no span."""
    cites = spans.where("kind = 'cit'").join(bib.select("doc_id", F.col("pos").alias("index"), "id"), ["doc_id", "index"], "left")
    unknown = cites.where("id is null").select("doc_id").distinct().withColumn("__u", F.lit(0))
    used = cites.where("id is not null").select("doc_id", "id")
    left = docs.select("doc_id", F.explode("citations").alias("id")).join(used, ["doc_id", "id"], "left_anti").select("doc_id").distinct().withColumn("__l", F.lit(1))
    return docs.select("doc_id").join(unknown, "doc_id", "left").join(left, "doc_id", "left").select("doc_id", F.coalesce("__u", F.lit(1)).alias("all_known"), F.coalesce("__l", F.lit(0)).alias("uncited"))


def _suspected(nodes: DataFrame, spans: DataFrame, styles: DataFrame) -> DataFrame:
    """(doc_id): documents where something that looks like a citation in their style has no span."""
    leaf = nodes.where("text is not null and depth > 0").join(styles.where("style <> 'UNKNOWN'"), "doc_id")
    hits = leaf.select("doc_id", "path", F.explode(citation_places("text", "style")).alias("h")).select("doc_id", "path", "h.*")
    own = spans.where("kind = 'cit'").groupBy("doc_id", "path").agg(F.collect_list(F.struct("start", "end")).alias("own"))
    free = ~F.coalesce(F.exists("own", lambda x: (x["start"] < F.col("end")) & (F.col("start") < x["end"])), F.lit(False))
    return hits.join(own, ["doc_id", "path"], "left").where(free).select("doc_id").distinct()


def documents_stats(docs: DataFrame, nodes: DataFrame, spans: DataFrame, bib: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(metric, value, count): totals (value null) and histograms over documents, sections and text parts.

    A null value of year counts the documents without one; fields of study and styles are metrics of their own."""
    f = features(docs, nodes, spans, bib, known).join(_uncited(docs, spans, bib), "doc_id", "left")
    headed = nodes.groupBy("doc_id").agg((F.coalesce(F.sum(F.length("text")), F.lit(0)) + F.coalesce(F.sum(F.length("headline")), F.lit(0))).alias("chars_with_headlines"))
    f = f.join(headed, "doc_id", "left").fillna(0, ["chars_with_headlines"]).withColumn("all_headed", (F.col("top_headlines") == F.col("top_sections")).cast("int"))
    flags = {"all_known": "with_all_known_citations", "uncited": "with_non_referenced_citations", "all_headed": "with_non_empty_headlines"}
    numeric = [c for c in f.columns if c not in ("doc_id", "style", *flags)]
    sums = [c for c in ("citation_spans", "bib_entries", "bib_with_id", "nonempty_headlines", "n_citations") if c in f.columns]
    totals = f.agg(F.count("*").alias("documents"), *[F.sum(c).alias(f"total_{c}") for c in sums], *[F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in flags.items()])
    names = totals.columns
    long = totals.select(F.explode(F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[F.col(n).cast("bigint") for n in names]))).alias("metric", "count"))
    none = F.lit(None).cast("bigint").alias("value")
    own = f.select("doc_id", "style")
    suspected = _suspected(nodes, spans, own).agg(F.count("*").alias("count")).select(F.lit("with_suspected_missing_reference").alias("metric"), none, "count")
    styles = own.groupBy("style").agg(F.count("*").alias("count")).select(F.concat(F.lit("style_"), F.coalesce("style", F.lit("UNKNOWN"))).alias("metric"), none, "count")
    leaf = nodes.where("text is not null")
    leaves = histogram(leaf.select(F.length("text").alias("text_part_chars")), ["text_part_chars"])
    tops = nodes.where("depth = 1").select("doc_id", F.col("path").alias("t")).join(leaf.where("depth > 0").groupBy("doc_id", F.slice("path", 1, 1).alias("t")).agg(F.count("*").alias("text_parts_per_top_section")), ["doc_id", "t"], "left").fillna(0)
    out = merge_all(histogram(f, numeric), long.select("metric", none, "count"), suspected, styles, leaves, histogram(tops, ["text_parts_per_top_section"]))
    if "fields_of_study" in docs.columns:
        fields = docs.select(F.explode(F.array_distinct(F.transform("fields_of_study", F.lower))).alias("x")).groupBy("x").agg(F.count("*").alias("count"))
        out = out.unionByName(fields.select(F.concat(F.lit("field_"), "x").alias("metric"), none, "count"))
    return out


def merge_all(*parts: DataFrame) -> DataFrame:
    """Parts with different metrics, together."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def averages(hist: DataFrame) -> DataFrame:
    """(metric, n, total, mean, least, most) of histograms."""
    n, total = F.sum("count"), F.sum(F.col("value") * F.col("count"))
    return hist.where("value is not null").groupBy("metric").agg(n.alias("n"), total.alias("total"), (total / n).alias("mean"), F.min("value").alias("least"), F.max("value").alias("most"))


def related_work_stats(targets: DataFrame, edges: DataFrame, abstracts: DataFrame, full: DataFrame) -> DataFrame:
    """Histograms over target sections, and over the abstracts and full texts that they cite (NODES each)."""
    names = ["sections", "paragraphs", "sentences", "words", "chars"]
    parts = {"target": tree_stats(targets), "abstract": cited_stats(edges, tree_stats(abstracts)), "full": cited_stats(edges, tree_stats(full))}
    out = None
    for p, df in parts.items():
        h = histogram(df, names).withColumn("metric", F.concat(F.lit(f"{p}_"), "metric"))
        v = vocabulary(targets if p == "target" else abstracts if p == "abstract" else full).select(F.lit(f"{p}_vocabulary").alias("metric"), F.lit(None).cast("bigint").alias("value"), F.col("vocabulary").alias("count"))
        out = h.unionByName(v) if out is None else out.unionByName(h).unionByName(v)
    return out
