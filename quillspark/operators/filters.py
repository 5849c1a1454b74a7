"""Document filters. Each is a frame of (doc_id, passed), or a boolean column where one row has all that is needed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions import text as T
from quillspark.operators import tree
from quillspark.operators.spans import group


def between(x: Column, least: float | None, most: float | None) -> Column:
    """Inclusive bounds; either may be open."""
    if least is not None and most is not None and least > most:
        raise ValueError("the lower bound is above the upper one")
    out = F.lit(True)
    if least is not None:
        out = out & (x >= least)
    if most is not None:
        out = out & (x <= most)
    return F.coalesce(out, F.lit(False))


def always(value: bool = True) -> Column:
    return F.lit(value)


def combined(*filters: DataFrame) -> DataFrame:
    """Passed where all passed; a document that one of them doesn't know fails."""
    return reduce(lambda a, b: a.withColumnRenamed("passed", "p").join(b, "doc_id").select("doc_id", (F.col("p") & F.col("passed")).alias("passed")), filters)


def passing(filtered: DataFrame) -> DataFrame:
    """Ids that passed."""
    return filtered.where("passed").select("doc_id")


def _docs(nodes: DataFrame) -> DataFrame:
    return nodes.where("depth = 0").select("doc_id")


def nonempty_headlines(nodes: DataFrame, min_height: int = 2) -> DataFrame:
    """Every section of that height has a headline."""
    bad = tree.sections(nodes, min_height).where("headline is null or headline = ''").groupBy("doc_id").agg(F.count("*").alias("n"))
    return _docs(nodes).join(bad, "doc_id", "left").select("doc_id", F.col("n").isNull().alias("passed"))


def number_of_sections(nodes: DataFrame, least: int | None, most: int | None, min_height: int = 2) -> DataFrame:
    n = tree.sections(nodes, min_height).groupBy("doc_id").agg(F.count("*").alias("n"))
    return _docs(nodes).join(n, "doc_id", "left").select("doc_id", between(F.coalesce("n", F.lit(0)), least, most).alias("passed"))


def text_parts_in_sections(nodes: DataFrame, least: int | None, most: int | None, whole: bool = False) -> DataFrame:
    """Every top-level section has so many text parts; with whole, the whole tree counts as one section."""
    top = F.array().cast("array<int>") if whole else F.slice("path", 1, 1)
    tops = nodes.where("depth = 0" if whole else "depth = 1").select("doc_id", F.col("path").alias("top"))
    n = tree.text_contents(nodes).groupBy("doc_id", top.alias("top")).agg(F.count("*").alias("n"))
    ok = tops.join(n, ["doc_id", "top"], "left").groupBy("doc_id").agg(F.bool_and(between(F.coalesce("n", F.lit(0)), least, most)).alias("ok"))
    return _docs(nodes).join(ok, "doc_id", "left").select("doc_id", F.coalesce("ok", F.lit(True)).alias("passed"))


def number_of_citations(docs: DataFrame, least: int | None, most: int | None) -> DataFrame:
    return docs.select("doc_id", between(F.coalesce(F.size("citations"), F.lit(0)), least, most).alias("passed"))


def resolved(spans: DataFrame, bib: DataFrame) -> DataFrame:
    """Citation spans with `known`: whether their bibliography entry (doc_id, pos, id) has an id."""
    known = bib.where("id is not null").select("doc_id", F.col("pos").alias("index"), F.lit(True).alias("known"))
    return spans.where("kind = 'cit'").join(known, ["doc_id", "index"], "left").withColumn("known", F.coalesce("known", F.lit(False)))


def citations_fraction(docs: DataFrame, spans: DataFrame, bib: DataFrame, least: float | None, most: float | None) -> DataFrame:
    """Share of citation spans that are resolved; 0 without spans."""
    share = resolved(spans, bib).groupBy("doc_id").agg(F.avg(F.col("known").cast("int")).alias("f"))
    return docs.select("doc_id").join(share, "doc_id", "left").select("doc_id", between(F.coalesce("f", F.lit(0.0)), least, most).alias("passed"))


def citation_groups_fraction(nodes: DataFrame, spans: DataFrame, bib: DataFrame, least: float | None, most: float | None) -> DataFrame:
    """Share of citation groups with a resolved member; 0 without spans."""
    groups = group(resolved(spans, bib), ["doc_id", "path"], nodes.where("text is not null").select("doc_id", "path", "text")).groupBy("doc_id", "path", "group_no").agg(F.bool_or("known").alias("known"))
    share = groups.groupBy("doc_id").agg(F.avg(F.col("known").cast("int")).alias("f"))
    return _docs(nodes).join(share, "doc_id", "left").select("doc_id", between(F.coalesce("f", F.lit(0.0)), least, most).alias("passed"))


def full_record(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """A title, an author and some text."""
    return docs.join(tree.has_text(nodes), "doc_id", "left").select("doc_id", (F.col("title").isNotNull() & (F.coalesce(F.size("authors"), F.lit(0)) > 0) & F.coalesce("has_text", F.lit(False))).alias("passed"))


def valid_after_prune(nodes: DataFrame, coverage: float | None = None) -> DataFrame:
    return tree.has_text(tree.prune_all(nodes, coverage)).select("doc_id", F.col("has_text").alias("passed"))


def has_headline(nodes: DataFrame, pattern: str, least_parts: int = 0, min_depth: int = 0, max_depth: int | None = None) -> DataFrame:
    """The first part with such a headline has so many text parts."""
    hit = tree.get_part(nodes, pattern, 1, min_depth, max_depth).select("doc_id", F.col("path").alias("top"))
    n = tree.text_contents(nodes).select("doc_id", F.explode(F.concat(F.when(F.col("depth") > 0, tree.ancestors(F.col("path"))).otherwise(F.array().cast("array<array<int>>")), F.array("path"))).alias("top")).groupBy("doc_id", "top").agg(F.count("*").alias("n"))
    ok = hit.join(n, ["doc_id", "top"], "left").select("doc_id", (F.coalesce("n", F.lit(0)) >= least_parts).alias("ok"))
    return _docs(nodes).join(ok, "doc_id", "left").select("doc_id", F.coalesce("ok", F.lit(False)).alias("passed"))


def cited_multi_section(edges: DataFrame, docs: DataFrame, tops: DataFrame, least: float = 0.0, most: float = 1.0) -> DataFrame:
    """Share of citations whose document has more than one top-level node (tops: doc_id, n); unknown ones count as no."""
    if least <= 0 and most >= 1:
        return docs.select("doc_id", F.lit(True).alias("passed"))
    multi = tops.select(F.col("doc_id").alias("cited"), (F.col("n") > 1).alias("m"))
    share = edges.join(multi, "cited", "left").groupBy(F.col("citing").alias("doc_id")).agg(F.avg(F.coalesce("m", F.lit(False)).cast("int")).alias("f"))
    return docs.select("doc_id").join(share, "doc_id", "left").select("doc_id", between(F.coalesce("f", F.lit(0.0)), least, most).alias("passed"))


def fields_of_study(docs: DataFrame, names: list[str], case_sensitive: bool = False) -> DataFrame:
    own = F.col("fields_of_study") if case_sensitive else T.field_names(F.col("fields_of_study"))
    wanted = F.array(*[F.lit(n if case_sensitive else n.lower()) for n in names])
    return docs.select("doc_id", F.coalesce(F.arrays_overlap(own, wanted), F.lit(False)).alias("passed"))
