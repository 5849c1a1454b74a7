"""Line dedup: lines that occur in more than `max_docs` distinct documents are dropped from all of them.

A line is compared in its normal form: lower case, runs of blanks, tabs, form feeds and carriage returns as one blank,
trimmed. Documents count as distinct by their content, so the copies of one text count once and are left to
near-duplicate removal. Two 64-bit hashes stand for a line, two for a document. Counting aggregates (line, document)
pairs before lines, so a line of very many documents burdens no single task. Positions to drop come back to the texts by
a join on the document's hashes, in which the texts stream past a table of positions and aren't sorted; adaptive execution
splits the partition of a text with very many copies.

Defined results: a line of blanks only is neither counted nor dropped; a null text stays null, with 0 lines dropped; a
text all of whose lines go becomes empty; repeated rows and null ids, of whatever type, stay; an empty table gives an
empty result; other columns stay as they are, and where one is called lines_dropped, the new one gets underscores behind
its name; a text of any length is one row, split in the JVM; there are no ties.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import free, fresh, work_table

MAX_DOCS = 50


def normal(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, "[ \\t\\f\\r]+", " ")))


def _pair(c: Column, name: str) -> list[Column]:
    return [F.xxhash64(c).alias(f"{name}1"), F.xxhash64(F.lit(name), c).alias(f"{name}2")]


def deduplicate(docs: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """docs with text without its dropped lines, and a column lines_dropped behind the others."""
    text = F.col("text").cast("string")
    lines = (
        docs.where("text is not null")
        .select(*_pair(text, "__d"), F.posexplode(F.split(text, "\n", -1)).alias("__at", "__line"))
        .select("__d1", "__d2", "__at", normal(F.col("__line")).alias("__line")).where("__line <> ''")
        .select("__d1", "__d2", "__at", *_pair(F.col("__line"), "__h"))
    )
    seen = lines.select("__h1", "__h2", "__d1", "__d2").distinct().groupBy("__h1", "__h2").agg(F.count("*").alias("__n"))
    often = work_table(seen.where(F.col("__n") > max_docs).select("__h1", "__h2"), "lines")
    hits = lines.join(often, ["__h1", "__h2"], "left_semi")
    drop = work_table(hits.groupBy("__d1", "__d2").agg(F.collect_set("__at").alias("__drop")), "positions")
    d1, d2, gone = (fresh(docs, c) for c in ("d1", "d2", "drop"))
    keyed = docs.withColumns(dict(zip((d1, d2), _pair(text, "__d"), strict=True)))
    kept = F.array_join(F.filter(F.split(text, "\n", -1), lambda x, i: ~F.array_contains(gone, i)), "\n")
    return keyed.join(drop.toDF(d1, d2, gone).hint("shuffle_hash"), [d1, d2], "left").select(
        *[F.when(F.col(gone).isNull(), text).otherwise(kept).alias(c) if c.lower() == "text" else F.col(f"`{c}`") for c in docs.columns],
        F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)).alias(free(docs, "lines_dropped")),
    )


def oracle(max_docs: int = MAX_DOCS) -> str:
    """DuckDB SQL for (doc_id, text, lines_dropped)."""
    form = r"lower(trim(regexp_replace(x, '[ \t\f\r]+', ' ', 'g')))"
    return f"""
    with l as (select distinct text, unnest(string_split(text, chr(10))) as x from documents),
    often as (select {form} as f from l group by 1 having f <> '' and count(distinct md5(text)) > {max_docs}),
    hot as (select list(f) as fs from often),
    d as (select doc_id, text, string_split(text, chr(10)) as xs, coalesce(fs, []) as fs from documents, hot),
    k as (select doc_id, text, xs, list_filter(xs, lambda x: not list_contains(fs, {form})) as kept from d)
    select doc_id, case when text is null then null else array_to_string(kept, chr(10)) end as text,
      case when text is null then 0 else cast(len(xs) - len(kept) as integer) end as lines_dropped from k"""
