"""More registered queries: trees with spans, searches with years and authors, sources, citation repair and whole jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.catalog import _MATCH, _SCORE, _SETS, _TREE, _bench, _edges, _nodes, _path, _register, _shown, _t, _titled, _tokens_cte
from quillspark.functions import similarity as M
from quillspark.functions import text as T
from quillspark.operators import bibliography as B
from quillspark.operators import filters, search, spans, stats, tree
from quillspark.operators import ids as I  # noqa: E741
from quillspark.plans import jobs
from quillspark.schema import BIB, SPAN
from quillspark.session import reliable, scratch
from quillspark.sources import readers, sinks, tei

_WORD = r"[\p{L}\p{M}\p{N}_]"


# ---- trees with spans --------------------------------------------------------------------------------------------
@_register(f"with {_TREE} select doc_id, path, headline from nodes where height = 1")
def nodes_with_height(spark: SparkSession, d: str) -> DataFrame:
    return tree.nodes_with_height(_nodes(spark, d), 1).select("doc_id", _path(), "headline")


@_register(f"""with {_TREE} select doc_id, path, 0 as step, '' as step_path from nodes where height = 0 union all select doc_id, path, 1, top::varchar from nodes where depth = 2 union all select doc_id, path, 2, path from nodes where depth = 2""")
def paths_to_height(spark: SparkSession, d: str) -> DataFrame:
    return tree.paths_to_height(_nodes(spark, d), 0).select("doc_id", _path(), "step", _path("step_path").alias("step_path"))


@_register(f"with {_TREE} select doc_id, path, text from nodes where text is not null")
def text_contents(spark: SparkSession, d: str) -> DataFrame:
    return tree.text_contents(_nodes(spark, d)).select("doc_id", _path(), "text")


def _leaf_spans(nodes: DataFrame) -> DataFrame:
    """Two spans at the beginning of each text: of entries j % 3 and, from the third character on, (j + 1) % 3."""
    j = F.element_at("path", -1)
    leaf = nodes.where("text is not null and depth = 2")
    both = F.filter(F.array(F.struct(F.lit(0).alias("pos"), (j % 3).alias("index"), F.lit(0).alias("start"), F.lit(1).alias("end")), F.struct(F.lit(1).alias("pos"), ((j + 1) % 3).alias("index"), F.lit(2).alias("start"), F.lit(3).alias("end"))), lambda x: x["end"] <= F.length("text"))
    return leaf.select("doc_id", "path", F.lit("cit").alias("kind"), F.explode(both).alias("s")).select("doc_id", "path", "kind", "s.*")


#: doc_id, top, j, text, and the spans of _leaf_spans as s, e, index.
_SPANNED = """sp as (select doc_id, top, split_part(path, '.', 2)::int as j, text, unnest([0, 2]) as s from nodes where depth = 2), spans as (select doc_id, top, j, text, s, s + 1 as e, case when s = 0 then j % 3 else (j + 1) % 3 end as index from sp where s < length(text))"""


@_register(f"""with {_TREE}, {_SPANNED} select doc_id, path, index, s as "start", e as "end" from (select doc_id, (top - 1) || '.' || j as path, index, s, e from spans where top > 0)""")
def tree_remove_spans(spark: SparkSession, d: str) -> DataFrame:
    """Citation spans after the first section is taken out."""
    nodes = _nodes(spark, d)
    _, moved = tree.remove(nodes, nodes.where("depth = 1 and path[0] = 0").select("doc_id", "path"), _leaf_spans(nodes))
    return moved.select("doc_id", _path(), "index", "start", "end")


@_register(f"""with {_TREE}, places as (select doc_id from nodes where depth = 0 and height = 2), o as (select n.doc_id, case when top is null then '' when top >= 1 then (top + 1) || substr(path, length(top::varchar) + 1) else path end as path, n.height, n.headline, n.text from nodes n)
select * from o union all select doc_id, '1', 1, 'NEW', null from places union all select doc_id, '1.0', 0, null, 'new text' from places""")
def tree_insert(spark: SparkSession, d: str) -> DataFrame:
    """A section put in as the second one of each document that has any."""
    nodes = _nodes(spark, d)
    at = nodes.where("depth = 0 and height = 2").select("doc_id", F.array(F.lit(1)).alias("path"))
    none, path = F.lit(None).cast("string"), F.array().cast("array<int>")
    sub = at.select("doc_id", F.explode(F.array(F.struct(path.alias("path"), F.lit(0).alias("depth"), F.lit(1).alias("height"), F.lit("NEW").alias("headline"), none.alias("text")), F.struct(F.array(F.lit(0)).alias("path"), F.lit(1).alias("depth"), F.lit(0).alias("height"), none.alias("headline"), F.lit("new text").alias("text")))).alias("n")).select("doc_id", "n.*")
    return tree.insert(nodes, sub, at).select("doc_id", _path(), "height", "headline", "text")


def _odd(nodes: DataFrame) -> DataFrame:
    """Nodes with empty and foreign headlines, sections without text, and figures."""
    top, leaf = F.get("path", F.lit(0)), F.col("depth") == 2
    head = F.when((F.col("depth") == 1) & (top % 3 == 0), "").when((F.col("depth") == 1) & (top % 5 == 1), "Ωμέγα").when(leaf & (F.get("path", F.lit(1)) == 1), "Figure").otherwise(F.col("headline"))
    return nodes.withColumn("headline", head).withColumn("text", F.when(leaf & (top % 4 == 3), "").otherwise(F.col("text")))


_ODD = """odd as (select doc_id, top, depth, case when depth = 2 then split_part(path, '.', 2)::int end as j, case when depth = 1 and top % 3 = 0 then '' when depth = 1 and top % 5 = 1 then 'Ωμέγα' when depth = 2 and split_part(path, '.', 2) = '1' then 'Figure' else headline end as headline, case when depth = 2 and top % 4 = 3 then '' else text end as text from nodes)"""


def _left(bad: str, leaf: str = "false") -> str:
    """CTE `kept` of odd without the sections for which bad holds and the leaves for which leaf does, paths closed up."""
    return f"""{_ODD}, gone as (select doc_id, top from odd s where depth = 1 and ({bad})), stay as (select * from odd o where not exists (select 1 from gone g where g.doc_id = o.doc_id and g.top = o.top) and not (depth = 2 and {leaf})),
    rt as (select doc_id, top, row_number() over (partition by doc_id order by top) - 1 as i from stay where depth = 1), rj as (select doc_id, top, j, row_number() over (partition by doc_id, top order by j) - 1 as k from stay where depth = 2),
    kept as (select s.*, case depth when 0 then '' when 1 then i::varchar else i || '.' || k end as path from stay s left join rt on rt.doc_id = s.doc_id and rt.top = s.top left join rj on rj.doc_id = s.doc_id and rj.top = s.top and rj.j = s.j)"""


def _out(nodes: DataFrame) -> DataFrame:
    return nodes.select("doc_id", _path(), "headline", "text")


_KEPT = "select doc_id, path, headline, text from kept"
_TEXTLESS = "not exists (select 1 from odd t where t.doc_id = s.doc_id and t.top = s.top and t.depth = 2 and t.text <> '')"


@_register(f"with {_TREE}, {_left(chr(34) + 'headline' + chr(34) + ' is null or headline = ' + chr(39) * 2)} {_KEPT}")
def prune_empty_headlines(spark: SparkSession, d: str) -> DataFrame:
    return _out(tree.prune_empty_headlines(_odd(_nodes(spark, d)), 1))


@_register(f"with {_TREE}, {_left('''coalesce(length(regexp_replace(headline, '[^A-Za-z]', '', 'g')) / nullif(length(headline), 0), 0) < 0.7''')} {_KEPT}")
def prune_by_script(spark: SparkSession, d: str) -> DataFrame:
    return _out(tree.prune_by_script(_odd(_nodes(spark, d)), 0.7, 1))


@_register(f"with {_TREE}, {_left(_TEXTLESS)} {_KEPT}")
def prune_textless(spark: SparkSession, d: str) -> DataFrame:
    return _out(tree.prune_textless(_odd(_nodes(spark, d))))


@_register(f"with {_TREE}, {_left('false', 'j = 1')} {_KEPT}")
def prune_named_text(spark: SparkSession, d: str) -> DataFrame:
    return _out(tree.prune_named_text(_odd(_nodes(spark, d)), ["figure"]))


@_register(f"""with {_TREE}, {_SPANNED}, {_left(_TEXTLESS, 'j = 1')} select k.doc_id, k.path, index, s as "start", e as "end" from spans p join kept k on k.doc_id = p.doc_id and k.top = p.top and k.j = p.j and k.depth = 2""")
def prune_all_spans(spark: SparkSession, d: str) -> DataFrame:
    """Citation spans of documents that have gone through the whole pruning."""
    nodes = _nodes(spark, d)
    return tree.prune_all(_odd(nodes), 0.7, ["figure"], _leaf_spans(nodes))[1].select("doc_id", _path(), "index", "start", "end")


@_register(f"with {_TREE} select doc_id, path from nodes where depth = 1 and top = 1")
def abstract_part(spark: SparkSession, d: str) -> DataFrame:
    top = F.get("path", F.lit(0))
    head = F.when(F.col("depth") == 1, F.when(top == 1, "1. Abstract:").when(top == 3, "ABSTRACT").when(top == 0, "Abstract of it").otherwise("abstracts"))
    return tree.abstract(_nodes(spark, d).withColumn("headline", F.coalesce(head, "headline"))).select("doc_id", _path())


@_register(f"with {_TREE} select l.doc_id, ls[1] as title, n.text from l left join nodes n on n.doc_id = l.doc_id and n.path = '0.0'")
def stub_scan(spark: SparkSession, d: str) -> DataFrame:
    nodes = _nodes(spark, d)
    docs = nodes.where("depth = 0").select("doc_id", F.col("headline").alias("title"), F.array(F.lit("A")).alias("authors"))
    return readers.stubs(nodes, docs).drop("authors")


# ---- filters and statistics with spans ---------------------------------------------------------------------------
def _three(nodes: DataFrame) -> DataFrame:
    """Bibliographies of three entries, the second one unknown."""
    e = F.explode(F.array(*[F.struct(F.lit(p).alias("pos"), F.lit(i).cast("bigint").alias("id")) for p, i in ((0, 7), (1, None), (2, 9))])).alias("e")
    return nodes.where("depth = 0").select("doc_id", e).select("doc_id", "e.*", F.lit("T").alias("title"), F.lit(None).cast("int").alias("year"), F.array(F.lit("A")).alias("authors"))


_GROUPS = f"""{_SPANNED}, g as (select doc_id, top, j, s, index <> 1 as known, case when s = 0 or regexp_matches(substr(text, 2, 1), '{_WORD}') then 1 else 0 end as new from spans),
gg as (select *, sum(new) over (partition by doc_id, top, j order by s) as no from g), grouped as (select doc_id, top, j, no, bool_or(known) as known from gg group by 1, 2, 3, 4)"""


@_register(f"with {_TREE}, {_GROUPS}, f as (select doc_id, avg(case when known then 1 else 0 end) as f from grouped group by 1) select l.doc_id, coalesce(f, 0) between 0.7 and 1 as passed from l left join f using (doc_id)")
def filter_citation_groups(spark: SparkSession, d: str) -> DataFrame:
    nodes = _nodes(spark, d)
    return filters.citation_groups_fraction(nodes, _leaf_spans(nodes), _three(nodes), 0.7, 1.0)


@_register(f"with {_TREE} select doc_id, coalesce(bool_or(length(text) > 0 and top % 4 <> 3), false) as passed from nodes group by 1")
def filter_valid_after_prune(spark: SparkSession, d: str) -> DataFrame:
    return filters.valid_after_prune(_odd(_nodes(spark, d)))


@_register(f"with {_TREE} select doc_id, count(*) filter (where depth = 1) between 3 and 10 and coalesce(bool_or(length(text) > 0), false) as passed from nodes group by 1")
def filter_combined(spark: SparkSession, d: str) -> DataFrame:
    nodes = _nodes(spark, d)
    return filters.combined(filters.number_of_sections(nodes, 3, 10, 1), tree.has_text(nodes).withColumnRenamed("has_text", "passed"))


@_register(f"with {_TREE} select doc_id from nodes group by 1 having count(*) filter (where depth = 1) between 3 and 10")
def ids_passing(spark: SparkSession, d: str) -> DataFrame:
    return filters.passing(filters.number_of_sections(_nodes(spark, d), 3, 10, 1))


_PER_TEXT = r"""pt as (select doc_id, count(text) as sentences, coalesce(sum(len(list_filter(string_split_regex(text, '\s+'), lambda x: x <> ''))), 0) as words, coalesce(sum(length(text)), 0) as chars, coalesce(sum(length(text)), 0) + coalesce(sum(length(headline)), 0) as headed from nodes group by 1)"""

_COUNTS = f"""{_GROUPS}, c as (select doc_id, count(*) as citation_spans, count(*) filter (where index <> 1) as resolved_spans from spans group by 1), gc as (select doc_id, count(*) as citation_groups, count(*) filter (where known) as resolved_groups from grouped group by 1),
t as (select doc_id, count(*) as top_sections, count(*) filter (where headline <> '') as top_headlines from nodes where depth = 1 group by 1)"""


@_register(f"""with {_TREE}, {_COUNTS} select l.doc_id, l.doc_id % 3 as n_citations, l.doc_id % 3 as known_citations, 1 as n_authors, coalesce(top_sections, 0) as top_sections, coalesce(top_headlines, 0) as top_headlines, coalesce(citation_spans, 0) as citation_spans, coalesce(resolved_spans, 0) as resolved_spans,
coalesce(citation_groups, 0) as citation_groups, coalesce(resolved_groups, 0) as resolved_groups, 3 as bib_entries, 2 as bib_with_id from l left join c using (doc_id) left join gc using (doc_id) left join t using (doc_id)""")
def filter_features_spans(spark: SparkSession, d: str) -> DataFrame:
    """Features that rest on spans, citations and bibliographies."""
    nodes = _nodes(spark, d)
    cites = F.filter(F.sequence(F.lit(1), F.lit(3)).cast("array<bigint>"), lambda x: x <= F.col("doc_id") % 3)
    docs = _t(spark, d, "documents").select("doc_id", F.lit(None).cast("int").alias("year"), F.array("lang").alias("authors"), cites.alias("citations"))
    f = stats.features(docs, nodes, _leaf_spans(nodes), _three(nodes), docs.select(F.col("doc_id").alias("id")))
    return f.select("doc_id", *[F.col(c).cast("bigint").alias(c) for c in ("n_citations", "known_citations", "n_authors", "top_sections", "top_headlines", "citation_spans", "resolved_spans", "citation_groups", "resolved_groups", "bib_entries", "bib_with_id")])


_STATS = f"""with {_TREE}, {_COUNTS}, {_PER_TEXT},
top as (select doc_id, top, count(*) filter (where depth = 2) as n from nodes where depth > 0 group by 1, 2),
u as (select 'text_part_chars' as metric, length(text) as value from nodes where text is not null union all select 'text_parts_per_top_section', n from top union all select 'sentences', sentences from pt union all select 'words', words from pt union all select 'chars', chars from pt union all select 'chars_with_headlines', headed from pt
union all select 'citation_spans', coalesce(citation_spans, 0) from l left join c using (doc_id) union all select 'n_citations', doc_id % 3 from l union all select 'all_known', (citation_spans is null or citation_spans = resolved_spans)::int from l left join c using (doc_id) union all select 'uncited', (doc_id % 3 > 0)::int from l)"""


@_register(f"""{_STATS} select metric, value::bigint as value, count(*) as count from u where metric not in ('all_known', 'uncited') group by 1, 2 union all select 'documents', null, count(*) from l union all select 'total_citation_spans', null, sum(citation_spans)::bigint from c union all select 'total_bib_entries', null, 3 * count(*) from l union all select 'total_bib_with_id', null, 2 * count(*) from l
union all select 'total_n_citations', null, sum(doc_id % 3)::bigint from l union all select 'with_all_known_citations', null, sum(value)::bigint from u where metric = 'all_known' union all select 'with_non_referenced_citations', null, sum(value)::bigint from u where metric = 'uncited' union all select 'year', null, count(*) from l union all select 'field_' || lang, null, count(*) from documents group by 1""")
def documents_stats(spark: SparkSession, d: str) -> DataFrame:
    """Totals and histograms; citations 1 and 2 are none that a span refers to."""
    nodes = _nodes(spark, d)
    cites = F.filter(F.sequence(F.lit(1), F.lit(2)).cast("array<bigint>"), lambda x: x <= F.col("doc_id") % 3)
    docs = _t(spark, d, "documents").select("doc_id", F.lit(None).cast("int").alias("year"), F.array("lang").alias("authors"), cites.alias("citations"), F.array(F.upper("lang"), "lang").alias("fields_of_study"))
    shown = ["text_part_chars", "text_parts_per_top_section", "sentences", "words", "chars", "chars_with_headlines", "citation_spans", "n_citations", "documents", "total_citation_spans", "total_bib_entries", "total_bib_with_id", "total_n_citations", "with_all_known_citations", "with_non_referenced_citations", "year"]
    return stats.documents_stats(docs, nodes, _leaf_spans(nodes), _three(nodes)).where(F.col("metric").isin(shown) | F.col("metric").startswith("field_")).select("metric", "value", "count")


@_register(f"""with {_TREE}, {_SPANNED}, rb as (select doc_id, top, j, s, index <> 1 as known, index = 0 as multi from spans), rk as (select doc_id, avg(known::int) as known_fraction, avg(multi::int) as m from rb group by 1), rp as (select doc_id, avg(known::int) as kp, avg(multi::int) as mp from (select doc_id, top, bool_or(known) as known, bool_or(multi) as multi from rb group by 1, 2) group by 1),
rw as (select doc_id, sum(len(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> ''))) as n, count(text) as parts, max(case when depth = 0 and height = 2 then len(list_filter(string_split_regex(headline, '\\s+'), lambda x: x <> '')) end) as h from nodes group by 1)
select l.doc_id, round(coalesce(known_fraction, 0), 6) as known_fraction, round(coalesce(kp, 0), 6) as known_paragraph_fraction, round(coalesce(mp, 0), 6) as multi_paragraph_fraction, 0.0::double as unknown_entry_fraction, round((2 / 3)::double, 6) as known_entry_fraction, 1.0::double as multi_cited_fraction, (coalesce(n, 0) + coalesce(h, 0))::bigint as target_words, parts as target_text_parts from l left join rk using (doc_id) left join rp using (doc_id) left join rw using (doc_id)""")
def review_features(spark: SparkSession, d: str) -> DataFrame:
    """How well citations are covered: entry 7 has several sections, entry 9 one."""
    nodes = _nodes(spark, d)
    docs = nodes.where("depth = 0").select("doc_id", F.array(F.lit(7)).cast("array<bigint>").alias("citations"))
    tops = spark.createDataFrame([(7, 3), (9, 1)], "doc_id bigint, n bigint")
    f = stats.review_features(docs, nodes, _leaf_spans(nodes), _three(nodes), tops)
    shares = ["known_fraction", "known_paragraph_fraction", "multi_paragraph_fraction", "unknown_entry_fraction", "known_entry_fraction", "multi_cited_fraction"]
    return f.select("doc_id", *[F.round(c, 6).alias(c) for c in shares], "target_words", "target_text_parts")


_FIVE = "sections paragraphs sentences words chars".split()
_PER = r"""per as (select doc_id, count(*) filter (where height >= 2 and depth > 0) + 1 as sections, count(*) filter (where height = 1 and headline is null) as paragraphs, count(text) as sentences, coalesce(sum(len(list_filter(string_split_regex(text, '\s+'), lambda x: x <> ''))), 0)::bigint as words, coalesce(sum(length(text)), 0)::bigint as chars from nodes group by 1)"""


@_register(f"""with {_TREE}, {_PER}, m as (select max(doc_id) + 1 as n from documents), e as (select doc_id as citing, (doc_id * 7 + 1) % n as cited from documents, m union all select doc_id, (doc_id * 5 + 2) % n from documents, m), k as (select citing, {', '.join(f'sum({c}) as {c}' for c in _FIVE)} from e join per on per.doc_id = e.cited group by 1),
v as (select count(distinct w) as n from (select unnest(list_filter(string_split_regex(lower(text), '\\s+'), lambda x: x <> '')) as w from nodes where text is not null)), u as ({' union all '.join(f"select 'target_{c}' as metric, {c} as value from per union all select 'abstract_{c}', {c} from k union all select 'full_{c}', {c} from k" for c in _FIVE)})
select metric, value::bigint as value, count(*) as count from u group by 1, 2 union all select p || '_vocabulary', null, n from v, (select unnest(['target', 'abstract', 'full']) as p)""")
def related_work_stats(spark: SparkSession, d: str) -> DataFrame:
    docs, nodes = _t(spark, d, "documents"), _nodes(spark, d)
    top = F.broadcast(docs.agg((F.max("doc_id") + 1).alias("n")))
    e = docs.crossJoin(top).select(F.col("doc_id").alias("citing"), F.explode(F.array((F.col("doc_id") * 7 + 1) % F.col("n"), (F.col("doc_id") * 5 + 2) % F.col("n"))).alias("cited"))
    return stats.related_work_stats(nodes, e, nodes, nodes)


# ---- searches with years and authors -----------------------------------------------------------------------------
def _record(df: DataFrame, first: str) -> DataFrame:
    return df.withColumn("year", F.when(F.col("id") % 6 != 0, 1990 + F.col("id") % 4).cast("int")).withColumn("authors", F.array(F.concat(F.lit(first), (F.col("id") % 5).cast("string"))))


def _pool(spark: SparkSession, d: str) -> DataFrame:
    return _record(_bench(spark, d), "A. Src")


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return _record(_titled(spark, d), "Ann Src")


_HOW = {"threshold": 0.3, "max_year_diff": 1}
_BEST = f"""{_MATCH.rsplit(', best as', 1)[0].rsplit("best as", 1)[0]}
best as (select * from (select *, row_number() over (partition by probe_id order by score desc, id) as r from q where score >= 0.3 - 1e-9 and probe_id % 5 = id % 5 and (probe_id % 6 = 0 or id % 6 = 0 or abs(probe_id % 4 - id % 4) <= 1)) where r = 1)"""


@_register(f"{_BEST} select a.id as probe_id, best.id as id, round(score, 6) as score from a left join best on best.probe_id = a.id")
def search_authors(spark: SparkSession, d: str) -> DataFrame:
    """Titles, years within one and authors, full on one side and by initials on the other."""
    return search.search(_docs(spark, d).withColumnRenamed("id", "probe_id"), _pool(spark, d), **_HOW).withColumn("score", F.round("score", 6))


def _tens(spark: SparkSession, d: str) -> DataFrame:
    """Ten documents make one bibliography; every ninth entry is known."""
    known = F.when(F.col("id") % 9 == 0, F.col("id") % 3)
    return _docs(spark, d).select(F.floor(F.col("id") / 10).cast("bigint").alias("doc_id"), (F.col("id") % 10).cast("int").alias("pos"), known.alias("id"), "title", "year", "authors")


@_register(f"{_BEST} select a.id // 10 as doc_id, string_agg(coalesce(best.id::varchar, '-'), ' ' order by a.id % 10) as ids from a left join best on best.probe_id = a.id group by 1")
def identify_references(spark: SparkSession, d: str) -> DataFrame:
    found = search.identify_references(_tens(spark, d).drop("id"), _pool(spark, d), **_HOW)
    return found.select("doc_id", F.array_join(F.transform("ids", lambda x: F.coalesce(x.cast("string"), F.lit("-"))), " ").alias("ids"))


_IDENTIFIED = f"""{_BEST}, en as (select a.id // 10 as doc_id, a.id % 10 as pos, case when a.id % 9 = 0 then a.id % 3 end as known, best.id as new from a left join best on best.probe_id = a.id),
n as (select doc_id, new, min(pos) as pos from en where known is null and new <> doc_id and not exists (select 1 from en t where t.doc_id = en.doc_id and t.known = en.new) group by 1, 2),
i as (select en.doc_id, en.pos, coalesce(known, n.new) as id from en left join n on n.doc_id = en.doc_id and n.pos = en.pos and en.known is null and en.new = n.new)"""


@_register(f"{_IDENTIFIED} select * from i")
def identify_bibliography(spark: SparkSession, d: str) -> DataFrame:
    return B.identify(_tens(spark, d), _pool(spark, d), **_HOW).select("doc_id", "pos", "id")


@_register(f"{_IDENTIFIED} select doc_id, coalesce(string_agg(distinct id::varchar, ' ' order by id::varchar), '') as citations, count(id) - count(*) filter (where known) as growth from (select i.*, (i.doc_id * 10 + i.pos) % 9 = 0 as known from i) group by 1")
def bibliography_citations(spark: SparkSession, d: str) -> DataFrame:
    """Citations after identification, and how many entries were found."""
    before = _tens(spark, d)
    after = B.identify(before, _pool(spark, d), **_HOW)
    names = F.array_join(F.array_sort(F.transform("citations", lambda x: x.cast("string"))), " ").alias("citations")
    return B.citations(after).join(B.growth(before, after), "doc_id").select("doc_id", names, "growth")


@_register(f"{_BEST} select a.id as id, coalesce(case when a.id % 3 = 0 and a.id % 100 in (select item_id from benchmark) then a.id % 100 end, best.id) as mag_id from a left join best on best.probe_id = a.id")
def mag_mapping(spark: SparkSession, d: str) -> DataFrame:
    own = _docs(spark, d).withColumn("mag_id", F.when(F.col("id") % 3 == 0, F.col("id") % 100))
    return search.mag_mapping(own, _pool(spark, d), **_HOW)


@_register(f"""with {_tokens_cte('d', 'documents', 'doc_id')}, s as (select id, {_SETS} as a from d), n as (select id, len(a) as n, least(2, len(a)) as m from s)
select id, (case when n > 0 then 1 else 0 end)::double as whole, round(case when n > 0 then 2 * (m / n) / (m / n + 1) else 0 end, 6) as part from n""")
def one_to_many(spark: SparkSession, d: str) -> DataFrame:
    own = _titled(spark, d).withColumn("a", T.token_set(F.col("title")))
    s = own.select("id", M.one_to_many(F.col("a"), F.array("a", F.slice("a", 1, 2))).alias("s"))
    return s.select("id", F.round(F.get("s", F.lit(0)), 6).alias("whole"), F.round(F.get("s", F.lit(1)), 6).alias("part"))


@_register("""select doc_id as id, case when doc_id % 3 = 0 then array_to_string(['Ann Lee', source], '|') else array_to_string(['Ann Lee', source, 'Lee Roe'], '|') end as authors, doc_id % 3 = 0 or doc_id % 3 = 1 as abstract from documents""")
def dedup_authors(spark: SparkSession, d: str) -> DataFrame:
    """The first of equal names; and headlines of abstracts."""
    k = F.col("doc_id") % 3
    names = F.array(F.lit("Ann Lee"), F.col("source"), F.lit("LEE, Ann"), F.upper("source"), F.when(k == 0, "Lee  ann").otherwise("Lee Roe"))
    head = F.when(k == 0, " ABSTRACT: ").when(k == 1, "iv. abstract").otherwise("Abstract of")
    return _t(spark, d, "documents").select(F.col("doc_id").alias("id"), F.array_join(T.dedup_authors(names), "|").alias("authors"), T.is_abstract(head).alias("abstract"))


@_register(r"select doc_id as id, round(case when length(text) > 0 then length(regexp_replace(text, '[^\p{Latin}]', '', 'g')) / length(text) else 0 end, 6) as latin from documents")
def names_covered(spark: SparkSession, d: str) -> DataFrame:
    """Shares of characters by their Unicode names, over whole texts."""
    return _t(spark, d, "documents").select(F.col("doc_id").alias("id"), F.round(T.names_covered("LATIN .*LETTER")(F.col("text")), 6).alias("latin"))


# ---- citation spans ----------------------------------------------------------------------------------------------
def _leaves(spark: SparkSession, d: str, tail: str) -> DataFrame:
    leaf = _nodes(spark, d).where("text is not null")
    return leaf.select("doc_id", "path", "headline", F.concat("text", F.lit(tail)).alias("text"), F.length("text").alias("n"))


def _span(index: Column, start: Column, size: int) -> Column:
    return F.struct(index.cast("int").alias("index"), start.alias("start"), (start + size).alias("end"))


@_register(f"""with {_TREE} select doc_id, path, text || ' as [1] and [3][4]' as text, concat_ws(' ', '0:' || (length(text) + 4) || ':' || (length(text) + 7), '-:' || (length(text) + 12) || ':' || (length(text) + 15), '-:' || (length(text) + 15) || ':' || (length(text) + 18)) as spans from nodes where text is not null""")
def enhance_spans(spark: SparkSession, d: str) -> DataFrame:
    own = _leaves(spark, d, " as [1] and [3-4]").withColumn("spans", F.array(_span(F.lit(0), F.col("n") + 4, 3), _span(F.lit(None), F.col("n") + 12, 5))).drop("n")
    return spans.enhanced(own).select("doc_id", _path(), "text", _shown().alias("spans"))


@_register(f"""with {_TREE} select doc_id, path, '0:' || (length(text) + 1) || ':' || (length(text) + 12) || case when doc_id % 2 = 0 then ' 1:' || (length(text) + 17) || ':' || (length(text) + 27) else '' end as spans from nodes where text is not null""")
def identify_citation_spans(spark: SparkSession, d: str) -> DataFrame:
    """Citations by name are added where the bibliography has them, and unknown spans get their entry."""
    known = F.when(F.col("doc_id") % 3 == 0, F.array(_span(F.lit(None), F.col("n") + 1, 11))).otherwise(F.array().cast(f"array<{SPAN}>"))
    own = _leaves(spark, d, " (Lee, 1999) and Roe (2001)").withColumn("spans", known).drop("n")
    entry = F.array(F.struct(F.lit(0).alias("pos"), F.lit(1999).alias("year"), F.array(F.lit("Ann Lee")).alias("authors")), F.struct(F.lit(1).alias("pos"), F.lit(2001).alias("year"), F.array(F.lit("Bo Roe")).alias("authors")))
    bib = own.select("doc_id").distinct().select("doc_id", F.explode(entry).alias("e")).select("doc_id", "e.pos", F.lit(None).cast("bigint").alias("id"), F.lit("T").alias("title"), "e.year", "e.authors")
    found, _ = jobs.identified_spans(own, bib.where("pos = 0 or doc_id % 2 = 0"))
    return found.select("doc_id", _path(), _shown().alias("spans"))


# ---- sources and sinks -------------------------------------------------------------------------------------------
@_register("select doc_id as id, split_part(text, chr(10), 1) as title, 1990 + doc_id % 30 as year, source as author, doc_id % 5 as reference from documents where doc_id % 7 <> 0 and doc_id % 5 <> 0")
def mag_scan(spark: SparkSession, d: str) -> DataFrame:
    """Records without title or authors are left out."""
    k, at = F.col("doc_id"), scratch(spark, "mag")
    own = _t(spark, d, "documents").select(k.alias("PaperId"), F.when(k % 5 != 0, F.substring_index("text", "\n", 1)).alias("OriginalTitle"), (1990 + k % 30).alias("Year"), F.when(k % 7 != 0, F.array("source")).otherwise(F.array().cast("array<string>")).alias("Authors"), F.array(k % 5).alias("References"))
    sinks.write_json_lines(own, at)
    return readers.mag(spark, at).select("id", "title", F.col("year").cast("bigint").alias("year"), F.get("authors", F.lit(0)).alias("author"), F.get("references", F.lit(0)).alias("reference"))


@_register("select split_part(text, chr(10), 1) as title, (1990 + doc_id % 30)::int as year, source as author from documents where doc_id % 7 <> 0")
def scopus_scan(spark: SparkSession, d: str) -> DataFrame:
    k, at = F.col("doc_id"), scratch(spark, "scopus")
    _t(spark, d, "documents").select(F.substring_index("text", "\n", 1).alias("dc:title"), F.concat((1990 + k % 30).cast("string"), F.lit("-05-01")).alias("prism:coverDate"), F.when(k % 7 != 0, F.col("source")).alias("dc:creator")).write.json(at)
    return readers.scopus(spark, at).select("title", "year", F.get("authors", F.lit(0)).alias("author"))


@_register("select l_orderkey as citing, l_partkey as cited from lineitem")
def citation_graph_scan(spark: SparkSession, d: str) -> DataFrame:
    """JSON objects of lists, written and read again."""
    at = scratch(spark, "graph")
    g = I.citation_graph(_edges(spark, d))
    g.select(F.to_json(F.map_from_arrays(F.array(F.col("citing").cast("string")), F.array("cited")))).write.text(at)
    return readers.citation_graph(spark, at)


@_register("""select doc_id as id, split_part(text, chr(10), 1) as title, source as author, length(text)::bigint as chars, lang as extra from documents""")
def json_lines_scan(spark: SparkSession, d: str) -> DataFrame:
    """Documents with trees, bibliographies and keys the schema doesn't know, written as JSON lines and read again."""
    at, docs = scratch(spark, "docs"), _t(spark, d, "documents")
    leaf = F.struct(F.lit(None).cast("string").alias("headline"), F.struct(F.col("text"), F.array().cast(f"array<{SPAN}>").alias("citations"), F.array().cast(f"array<{SPAN}>").alias("references")).alias("content"))
    hierarchy = F.to_json(F.struct(F.lit("T").alias("headline"), F.array(leaf).alias("content")))
    own = docs.select(F.col("doc_id").alias("id"), F.substring_index("text", "\n", 1).alias("title"), F.array("source").alias("authors"), hierarchy.alias("hierarchy"), F.array().cast(BIB).alias("bibliography"), F.to_json(F.struct("lang")).alias("extra"))
    sinks.write_json_lines(own, at)
    back = readers.json_lines(spark, at)
    leaves = tree.flatten(back.withColumnRenamed("id", "doc_id")).where("text is not null").select(F.col("doc_id").alias("id"), F.length("text").cast("bigint").alias("chars"))
    return back.join(leaves, "id").select("id", "title", F.get("authors", F.lit(0)).alias("author"), "chars", F.get_json_object("extra", "$.lang").alias("extra"))


@_register("select row_number() over (order by doc_id) - 1 as row_pos, case when doc_id % 3 = 0 then null else doc_id end as value from documents")
def mapping_scan(spark: SparkSession, d: str) -> DataFrame:
    """A mapping written as lines, -1 for none, and read again by their positions."""
    at = scratch(spark, "mapping")
    own = I.dense_ids(_t(spark, d, "documents").select(F.col("doc_id").alias("id"))).select(F.col("new").alias("row_pos"), F.when(F.col("old") % 3 != 0, F.col("old")).alias("value"))
    sinks.mapping_lines(own).write.text(at)
    return sinks.read_mapping(readers.numbered(spark.read.text(at)))


@_register("select doc_id as id, row_number() over (order by doc_id) - 1 as row_pos from documents where doc_id % 2 = 0 qualify row_number() over (order by doc_id) - 1 between 10 and 59")
def positional_slice(spark: SparkSession, d: str) -> DataFrame:
    """Rows 10 to 59 of a file, as the feature has it."""
    at = scratch(spark, "rows")
    _t(spark, d, "documents").where("doc_id % 2 = 0").select(F.col("doc_id").alias("id")).orderBy("id").write.json(at)
    return readers.slice_rows(readers.numbered(readers.json_lines(spark, at, "id bigint")), 10, 60)


_XML = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


@_register(rf"""with {_TREE}, t as (select doc_id, trim(ls[1]) as title, coalesce(len(ls), 0) as n from l) select doc_id, title, (1990 + doc_id % 30)::int as year, 'Ann Lee|Bo Roe' as authors, 'Old work' as bib_title, 1999 as bib_year, case when doc_id % 2 = 0 then 1 else 0 end as citations from t where title <> '' and doc_id % 11 <> 0""")
def tei_scan(spark: SparkSession, d: str) -> DataFrame:
    """Documents as TEI XML: those without authors are dropped."""
    title = _XML(F.get(F.filter(F.split("text", "\n"), lambda x: F.trim(x) != ""), F.lit(0)))
    name = "<author><persName><forename>{}</forename><surname>{}</surname></persName></author>"
    who = F.when(F.col("doc_id") % 11 != 0, name.format("Ann", "Lee") + name.format("Bo", "Roe")).otherwise("")
    cite = F.when(F.col("doc_id") % 2 == 0, '<ref type="bibr" target="#b0">[1]</ref>').otherwise("none")
    xml = F.concat(
        F.lit('<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><fileDesc><titleStmt><title>'), title, F.lit('</title></titleStmt><publicationStmt><date when="'), (1990 + F.col("doc_id") % 30).cast("string"), F.lit('-05"/></publicationStmt><sourceDesc><biblStruct><analytic>'), who,
        F.lit("</analytic></biblStruct></sourceDesc></fileDesc></teiHeader><text><body><div><head>H</head><p>As "), cite, F.lit(' says.</p></div></body><back><div><listBibl><biblStruct xml:id="b0"><analytic><title>Old work</title>' + name.format("B", "C") + '</analytic><monogr><imprint><date type="published" when="1999"/></imprint></monogr></biblStruct></listBibl></div></back></text></TEI>'),
    )
    got = tei.documents(_t(spark, d, "documents").select(F.col("doc_id").cast("string").alias("path"), F.encode(xml, "UTF-8").alias("content")))
    found = reliable(got.withColumn("doc_id", F.col("path").cast("bigint")))  # parsed once for both uses
    n = tree.flatten_spans(found).groupBy("doc_id").agg(F.count("*").cast("int").alias("citations"))
    b = F.get("bibliography", F.lit(0))
    return found.join(n, "doc_id", "left").select("doc_id", "title", "year", F.array_join("authors", "|").alias("authors"), b["title"].alias("bib_title"), b["year"].alias("bib_year"), F.coalesce("citations", F.lit(0)).alias("citations"))


# ---- jobs --------------------------------------------------------------------------------------------------------
_CLASSES = f"""{_tokens_cte('d', 'documents', 'doc_id')}, s as (select id, {_SETS} as a from d), r as (select id, case when len(a) > 0 then min(id) over (partition by a) else id end as rep from s), top as (select max(doc_id) + 1 as n from documents)"""


@_register(f"with {_CLASSES}, e as (select doc_id as citing, (doc_id * 7 + 1) % n as cited from documents, top) select distinct a.rep as citing, b.rep as cited from e join r a on a.id = citing join r b on b.id = cited where a.rep <> b.rep")
def deduplication_job(spark: SparkSession, d: str) -> DataFrame:
    """Citations between the representatives of equal papers."""
    own = _titled(spark, d).select("id", "title", F.lit(None).cast("int").alias("year"), F.array().cast("array<string>").alias("authors"))
    top = F.broadcast(own.agg((F.max("id") + 1).alias("n")))
    e = own.crossJoin(top).select(F.col("id").alias("citing"), ((F.col("id") * 7 + 1) % F.col("n")).alias("cited"))
    return jobs.deduplicated(own, e, threshold=1.0, match_authors=False)[1]


@_register("""with bad as (select distinct l_orderkey as id from lineitem left join part on p_partkey = l_partkey where p_size is null or p_size <= 2), k as (select o_orderkey as id, ((o_orderkey + 42) * 2654435761) % 4294967296 as k, o_orderkey not in (select id from bad) as ok from orders),
r as (select id, row_number() over (order by k, id) - 1 as i, count(*) over () as n from k where ok)
select k.id, case when not ok then 'train' when i < floor(n * 0.1) then 'val' when i < floor(n * 0.1) + floor(n * 0.2) then 'test' else 'train' end as part from k left join r on r.id = k.id""")
def split_job(spark: SparkSession, d: str) -> DataFrame:
    """Only papers all of whose cited documents have several sections leave the training part."""
    tops = _t(spark, d, "part").select(F.col("p_partkey").alias("doc_id"), (F.col("p_size") - 1).alias("n"))
    return jobs.split_dataset(_t(spark, d, "orders").select(F.col("o_orderkey").alias("id")), _edges(spark, d), tops, 0.1, 0.2)


def _with_related(nodes: DataFrame) -> DataFrame:
    top = F.get("path", F.lit(0))
    head = F.when(F.col("depth") == 1, F.when(top == 0, "Abstract").when(top == 2, "2 Related Work"))
    return nodes.withColumn("headline", F.coalesce(head, "headline"))


_RELATED = f"{_TREE}, own as (select n.* from nodes n join (select distinct doc_id from nodes where depth = 1 and top = 2) using (doc_id))"


@_register(f"""with {_RELATED} select doc_id, 'rest' as part, case when top > 2 then (top - 1) || substr(path, length(top::varchar) + 1) else path end as path, text from own where top is null or top <> 2 union all select doc_id, 'target', substr(path, 3), text from own where top = 2""")
def related_work(spark: SparkSession, d: str) -> DataFrame:
    """Documents with an abstract and one related-work section, parted."""
    nodes = _with_related(_nodes(spark, d))
    out = jobs.related_work(nodes, _leaf_spans(nodes), _three(nodes), spark.range(7, 8))
    return out["rest"].select("doc_id", F.lit("rest").alias("part"), _path(), "text").unionByName(out["target"].select("doc_id", F.lit("target").alias("part"), _path(), "text"))


@_register(f"""with {_RELATED}, {_SPANNED} select s.doc_id, top || '.' || j as path, index, s as "start", e as "end" from spans s where s.doc_id in (select doc_id from own)""")
def related_work_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Spans after the section was cut out and put back in."""
    nodes = _with_related(_nodes(spark, d))
    bib = _three(nodes)
    out = jobs.related_work(nodes, _leaf_spans(nodes), bib, spark.range(7, 8))
    _, back, _ = jobs.back_from_related_work(out["rest"], out["target"], out["sections"], bib, out["rest_spans"], out["target_spans"])
    return back.select("doc_id", _path(), "index", "start", "end")


@_register("""select doc_id as id, case when doc_id % 3 = 0 and doc_id % 200 in (select item_id from benchmark) then source || '|Ann Lee' else source end as authors, case when doc_id % 2 = 0 then 1980 when doc_id % 3 = 0 and doc_id % 200 in (select item_id from benchmark) then 1999 end as year,
case when doc_id % 3 = 0 and doc_id % 200 in (select item_id from benchmark) then '10.1/' || (doc_id % 200) end as doi, case when doc_id % 3 = 0 and doc_id % 200 in (select item_id from benchmark) then lang || '|physics' else lang end as fields from documents""")
def enhance_with_mag(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("doc_id")
    own = _t(spark, d, "documents").select(k.alias("id"), F.array("source").alias("authors"), F.when(k % 2 == 0, 1980).alias("year"), F.lit(None).cast("bigint").alias("mag_id"), F.lit(None).cast("string").alias("doi"), F.array("lang").alias("fields_of_study"))
    mag = _t(spark, d, "benchmark").select(F.col("item_id").alias("id"), F.array(F.lit("Ann Lee"), F.lit("Lee, Ann")).alias("authors"), F.lit(1999).alias("year"), F.concat(F.lit("10.1/"), F.col("item_id").cast("string")).alias("doi"), F.array(F.lit("physics")).alias("fields"))
    out = B.enhance_with_mag(own, own.where("id % 3 = 0").select("id", (F.col("id") % 200).alias("mag_id")), mag)
    return out.select("id", F.array_join("authors", "|").alias("authors"), "year", "doi", F.array_join("fields_of_study", "|").alias("fields"))


@_register("""with e as (select doc_id, doc_id % (select count(*) from benchmark) as item from documents) select doc_id, 0 as pos, item as id from e union all select doc_id, 1, case when item < (select count(*) from benchmark) - 1 then item + 1 else 0 end from e""")
def enrich_from_graph(spark: SparkSession, d: str) -> DataFrame:
    """An entry with the title of a cited paper gets its id; other cited papers become entries."""
    papers = _bench(spark, d).withColumns({"year": F.lit(None).cast("int"), "authors": F.array().cast("array<string>")})
    own = _t(spark, d, "documents").crossJoin(F.broadcast(papers.agg(F.count("*").alias("n")))).select("doc_id", (F.col("doc_id") % F.col("n")).alias("item"), "n")
    bib = own.join(papers.withColumnRenamed("id", "item"), "item").select("doc_id", F.lit(0).alias("pos"), F.lit(None).cast("bigint").alias("id"), "title", "year", "authors")
    e = own.select(F.col("doc_id").alias("citing"), F.explode(F.array("item", (F.col("item") + 1) % F.col("n"))).alias("cited"))
    return B.enrich_from_graph(bib, e, papers, title_threshold=1.0).select("doc_id", "pos", "id")
