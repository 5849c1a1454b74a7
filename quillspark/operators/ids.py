"""Id algebra: filtering, translating, renumbering, union, split. Papers are rows with id, citations and bibliography."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def filter_edges(edges: DataFrame, kept: DataFrame) -> DataFrame:
    """(citing, cited) whose cited is in kept (id)."""
    return edges.join(kept.select(F.col("id").alias("cited")).distinct(), "cited", "left_semi").select("citing", "cited")


def filter_citations(papers: DataFrame, kept: DataFrame) -> DataFrame:
    """papers with citations cut to ids in kept (order and repeats stay) and other bibliography ids set to null."""
    ids = kept.select(F.col("id").alias("__kept")).distinct()
    cites = papers.select("id", F.posexplode("citations").alias("pos", "__kept")).join(ids, "__kept", "left_semi").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "__kept"))).alias("c"))
    out = papers.drop("citations").join(cites, "id", "left").withColumn("citations", F.coalesce(F.transform("c", lambda x: x["__kept"]), F.array().cast("array<bigint>"))).drop("c")
    if "bibliography" in papers.columns:
        known = papers.select("id", F.explode("bibliography.id").alias("__kept")).join(ids, "__kept", "left_semi").groupBy("id").agg(F.collect_set("__kept").alias("k"))
        own = F.transform("bibliography", lambda b: b.withField("id", F.when(F.array_contains(F.coalesce("k", F.array().cast("array<bigint>")), b["id"]), b["id"])))
        out = out.join(known, "id", "left").withColumn("bibliography", own).drop("k")
    return out.select(*papers.columns)


def filter_missing_ids(papers: DataFrame) -> DataFrame:
    return filter_citations(papers, papers)


def translate_edges(edges: DataFrame, mapping: DataFrame) -> DataFrame:
    """(citing, cited) through mapping (old, new); an id that it lacks is an error when it is read."""
    must = lambda c: F.when(F.col(c).isNull(), F.raise_error(F.lit("id without translation"))).otherwise(F.col(c))
    a, b = (mapping.select(F.col("old").alias(x), F.col("new").alias(f"n{x}")) for x in ("citing", "cited"))
    return edges.join(a, "citing", "left").join(b, "cited", "left").select(must("nciting").alias("citing"), must("ncited").alias("cited")).distinct()


def dense_ids(ids: DataFrame) -> DataFrame:
    """(old, new): ids numbered from 0 in order.

    Range-partitioned: partitions are numbered by their sizes and rows within them, so no single task sorts all ids. The
    rows carry their partition's number, by which the sizes, one row a partition, are joined."""
    ranged = ids.select(F.col("id").alias("old")).where("id is not null").distinct().repartitionByRange("old").sortWithinPartitions("old")
    placed = ranged.select("old", F.spark_partition_id().alias("__p"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("__i"))
    counts = placed.groupBy("__p").agg(F.count("*").alias("n"))
    before = counts.select("__p", (F.sum("n").over(Window.orderBy("__p")) - F.col("n")).alias("before"))
    return placed.join(F.broadcast(before), "__p").select("old", (F.col("before") + F.col("__i")).cast("bigint").alias("new"))


def extend_ids(first: DataFrame, second: DataFrame, order: str) -> DataFrame:
    """second with ids max(first) + 1, + 2, ... in `order`."""
    top = first.agg(F.coalesce(F.max("id"), F.lit(-1)).alias("top"))
    nth = dense_ids(second.select(F.col(order).alias("id"))).withColumnRenamed("old", order)
    return second.drop("id").join(nth, order).crossJoin(F.broadcast(top)).withColumn("id", F.col("top") + 1 + F.col("new")).drop("top", "new")


def keep_ids(df: DataFrame, ids: DataFrame) -> DataFrame:
    return df.join(ids.select("id").distinct(), "id", "left_semi")


def discard_documents(papers: DataFrame, kept: DataFrame) -> DataFrame:
    """Papers whose ids are kept, with citations cut to them."""
    own = keep_ids(papers, kept)
    return filter_citations(own, kept)


def extension_subset(second: DataFrame, matches: DataFrame) -> DataFrame:
    """Rows of second whose id has no match (probe_id, id)."""
    found = matches.where("id is not null").select(F.col("probe_id").alias("id"))
    return second.join(found, "id", "left_anti")


def create_references(bib: DataFrame, pool: DataFrame) -> DataFrame:
    """Rows of pool that some bibliography entry (id) refers to."""
    return keep_ids(pool, bib.where("id is not null"))


def split_key(id_: Column, seed: int = 42) -> Column:
    """A number below 2^32, the same for an id and a seed everywhere."""
    return F.pmod((id_ + seed) * F.lit(2654435761), F.lit(1 << 32))


def split(df: DataFrame, val: float, test: float, eligible: Column | None = None, seed: int = 42) -> DataFrame:
    """df with `part`: floor(n val) and floor(n test) of the n eligible rows, in the order of split_key; the rest is train."""
    ok = F.lit(True) if eligible is None else eligible
    own = df.withColumn("__ok", ok)
    order = dense_ids(own.where("__ok").select((split_key(F.col("id"), seed) * F.lit(1 << 30).cast("decimal(38,0)") + F.col("id")).alias("id")))
    ranked = own.withColumn("old", split_key(F.col("id"), seed) * F.lit(1 << 30).cast("decimal(38,0)") + F.col("id")).join(order, "old", "left")
    n = own.where("__ok").agg(F.count("*").alias("__n"))
    part = F.when(~F.col("__ok"), "train").when(F.col("new") < F.floor(F.col("__n") * val), "val").when(F.col("new") < F.floor(F.col("__n") * val) + F.floor(F.col("__n") * test), "test").otherwise("train")
    return ranked.crossJoin(F.broadcast(n)).withColumn("part", part).select(*df.columns, "part")


def repair_ids(papers: DataFrame, positional: DataFrame, only_missing: bool = False) -> DataFrame:
    """papers (row_pos, s2orc_id, ...) with s2orc_id from positional (row_pos, value); -1 stands for null."""
    new = F.when(F.col("value") >= 0, F.col("value"))
    own = papers.join(positional, "row_pos", "left").withColumn("s2orc_id", F.coalesce("s2orc_id", new) if only_missing else new)
    return own.select(*papers.columns)


def last_row(df: DataFrame, order: str) -> DataFrame:
    return df.groupBy().agg(F.max_by(F.struct(*df.columns), order).alias("r")).select("r.*")


def citation_graph(edges: DataFrame) -> DataFrame:
    """(citing, cited array) of edges with both ends; repeats are kept, in order of id."""
    return edges.where("citing is not null and cited is not null").groupBy("citing").agg(F.array_sort(F.collect_list("cited")).alias("cited"))
