"""Document trees as node tables: (doc_id, path, depth, height, headline, text); path [] is the root.

Ordering by path is pre-order. A node with text is a leaf of height 0, like an empty section; others have a height of
one more than their highest child.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions import text as T
from quillspark.schema import NODES, SPANS
from quillspark.session import SLICE, sliced


def walk(tree: dict, path: tuple[int, ...] = ()) -> tuple[list[tuple], list[tuple], int]:
    """Nodes and spans below a tree of {headline, content}, in pre-order, and its height."""
    content = tree.get("content")
    if isinstance(content, dict):
        spans = [(list(path), kind, i, s.get("index"), s["start"], s["end"]) for kind, key in (("cit", "citations"), ("ref", "references")) for i, s in enumerate(content.get(key) or [])]
        return [(list(path), len(path), 0, tree.get("headline"), content.get("text") or "")], spans, 0
    below, spans, height = [], [], 0
    for i, child in enumerate(content or []):
        n, s, h = walk(child, (*path, i))
        below += n
        spans += s
        height = max(height, h + 1)
    return [(list(path), len(path), height, tree.get("headline"), None), *below], spans, height


def _flat(what: int, column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = (["path", "depth", "height", "headline", "text"], ["path", "kind", "pos", "index", "start", "end"])[what]
        kinds = [pa.int64(), pa.list_(pa.int32()), *((pa.int32(), pa.int32(), pa.string(), pa.string()), (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32()))[what]]
        for b in batches:
            for lo in range(0, b.num_rows, SLICE):
                part = b.slice(lo, SLICE).to_pydict()
                rows = [(d, *r) for d, t in zip(part["doc_id"], part[column], strict=True) if t for r in walk(json.loads(t))[what]]
                yield pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["doc_id", *names])

    return run


def flatten(docs: DataFrame, column: str = "hierarchy") -> DataFrame:
    """NODES of documents (doc_id, hierarchy as JSON)."""
    return docs.select("doc_id", column).mapInArrow(_flat(0, column), NODES)


def flatten_spans(docs: DataFrame, column: str = "hierarchy") -> DataFrame:
    return docs.select("doc_id", column).mapInArrow(_flat(1, column), SPANS)


def build(nodes: list[tuple], spans: dict[tuple, dict[str, list]] | None = None) -> dict | None:
    """The tree of (path, headline, text) rows in pre-order; positions among siblings are those of the rows."""
    root: dict | None = None
    at: dict[tuple, dict] = {}
    for path, headline, text in nodes:
        own = {"headline": headline, "content": []}
        if text is not None:
            s = (spans or {}).get(tuple(path), {})
            own["content"] = {"text": text, "citations": s.get("cit", []), "references": s.get("ref", [])}
        at[tuple(path)] = own
        if len(path):
            at[tuple(path[:-1])]["content"].append(own)
        else:
            root = own
    return root


def rebuild(nodes: DataFrame, spans: DataFrame | None = None) -> DataFrame:
    """(doc_id, hierarchy as JSON) of NODES, with SPANS if given."""
    n = nodes.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("path", "headline", "text"))).alias("nodes"))
    if spans is None:
        n = n.withColumn("spans", F.lit(None).cast("array<struct<path: array<int>, kind: string, pos: int, index: int, start: int, end: int>>"))
    else:
        n = n.join(spans.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("path", "kind", "pos", "index", "start", "end"))).alias("spans")), "doc_id", "left")

    def one(ns: list[dict], ss: list[dict] | None) -> str:
        own: dict[tuple, dict[str, list]] = {}
        for s in ss or []:
            own.setdefault(tuple(s["path"]), {}).setdefault(s["kind"], []).append({k: s[k] for k in ("index", "start", "end")})
        return json.dumps(build([(x["path"], x["headline"], x["text"]) for x in ns], own), ensure_ascii=False, separators=(",", ":"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, SLICE):
                part = b.slice(lo, SLICE).to_pydict()
                yield pa.record_batch([pa.array(part["doc_id"], pa.int64()), pa.array(map(one, part["nodes"], part["spans"]), pa.string())], ["doc_id", "hierarchy"])

    return n.select("doc_id", "nodes", "spans").mapInArrow(run, "doc_id bigint, hierarchy string")


def parent(path: Column) -> Column:
    return F.slice(path, F.lit(1), F.greatest(F.size(path) - 1, F.lit(0)))


def ancestors(path: Column) -> Column:
    """Paths of all proper ancestors."""
    return F.transform(F.sequence(F.lit(0), F.size(path) - 1), lambda k: F.slice(path, F.lit(1), k))


def under(nodes: DataFrame, tops: DataFrame, proper: bool) -> DataFrame:
    """(doc_id, path) of the nodes below those of tops (doc_id, path), themselves too unless proper. Equi joins only."""
    own = nodes.where("depth > 0").select("doc_id", "path", F.explode(ancestors(F.col("path"))).alias("top"))
    if not proper:
        own = own.unionByName(nodes.select("doc_id", "path", F.col("path").alias("top")))
    return own.join(tops.select("doc_id", F.col("path").alias("top")).distinct(), ["doc_id", "top"], "left_semi").select("doc_id", "path").distinct()


def relabel(paths: Sequence[tuple[int, ...]], steps: Sequence[tuple[str, Sequence[bool], int]]) -> list[tuple[tuple[int, ...], int] | None]:
    """New path and height of each node of a tree (paths in pre-order) after steps, in order; None for nodes that are gone.

    Steps: ("fail", flags, h) drops subtrees whose top, not the root and of height h at least, is flagged, unless the root
    is no higher than h; ("bare", flags, 0) drops nodes without a flagged node in their subtree, but for the root; ("leaf",
    flags, 0) drops flagged nodes with all below. Siblings close up at the end; a height is that of what is left."""
    live = list(range(len(paths)))

    def high() -> list[int]:
        deep: dict[tuple[int, ...], int] = {}
        for k in reversed(live):
            p = paths[k]
            own = deep.setdefault(p, len(p))
            if p:
                deep[p[:-1]] = max(own, deep.get(p[:-1], 0))
        return [deep[paths[k]] - len(paths[k]) for k in live]

    for kind, flags, least in steps:
        if not live:
            break
        tall = high() if kind == "fail" else []
        if kind == "fail" and tall[0] <= least:
            continue
        if kind == "bare":
            full = {paths[k][:n] for k in live if flags[k] for n in range(len(paths[k]) + 1)}
            live = [k for k in live if not paths[k] or paths[k] in full]
            continue
        keep, gone = [], None
        for i, k in enumerate(live):
            p = paths[k]
            if gone is not None and p[: len(gone)] == gone:
                continue
            gone = None
            if p and flags[k] and (kind == "leaf" or tall[i] >= least):
                gone = p
            else:
                keep.append(k)
        live = keep
    new: dict[tuple[int, ...], tuple[int, ...]] = {}
    kids: dict[tuple[int, ...], int] = {}
    out: list[tuple[tuple[int, ...], int] | None] = [None] * len(paths)
    for k, h in zip(live, high(), strict=True):
        p = paths[k]
        if p:
            i = kids.get(p[:-1], 0)
            kids[p[:-1]] = i + 1
            new[p] = (*new[p[:-1]], i)
        else:
            new[p] = ()
        out[k] = (new[p], h)
    return out


def surgery(nodes: DataFrame, steps: Sequence[tuple[str, Column, int]], spans: DataFrame | None = None):
    """NODES after steps (see relabel; flags are columns of nodes), and SPANS, if given, at the new places of their nodes.

    A document's nodes are brought together once; only its paths and flags go through Python."""
    flags = [F.coalesce(c, F.lit(False)).alias(f"__f{i}") for i, (_, c, _) in enumerate(steps)]
    extra = [c for c in nodes.columns if c not in ("doc_id", "path", "height")]
    docs = nodes.select("*", *flags).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("path", *[F.col(f"__f{i}") for i in range(len(steps))], F.struct(*extra).alias("__own"))), _by_path).alias("__n"))
    kinds = [(kind, least) for kind, _, least in steps]

    def one(paths: list[list[int]], flags: list[list[bool]]) -> list[dict | None]:
        own = [(kind, f, least) for (kind, least), f in zip(kinds, flags, strict=True)]
        return [None if x is None else {"path": x[0], "height": x[1]} for x in relabel([tuple(p) for p in paths], own)]

    run = sliced(one, "array<struct<path: array<int>, height: int>>", pa.list_(pa.struct({"path": pa.list_(pa.int32()), "height": pa.int32()})))

    flag = lambda i: F.col("__n")[f"__f{i}"]
    packed = F.array(*[flag(i) for i in range(len(steps))]) if steps else F.array().cast("array<array<boolean>>")
    placed = docs.withColumn("__at", run(F.col("__n")["path"], packed))
    each = placed.select("doc_id", F.explode(F.arrays_zip("__n", "__at")).alias("z")).where("z.__at is not null")
    new = each.select("doc_id", F.col("z.__at.path").alias("path"), F.col("z.__at.height").alias("height"), "z.__n.__own.*")
    if "depth" in nodes.columns:
        new = new.withColumn("depth", F.size("path"))
    new = new.select(*nodes.columns)
    if spans is None:
        return new
    moves = each.select("doc_id", F.col("z.__n.path").alias("path"), F.col("z.__at.path").alias("__new"))
    return new, spans.join(moves, ["doc_id", "path"]).withColumn("path", F.col("__new")).select(*spans.columns)


def _by_path(x: Column, y: Column) -> Column:
    return F.when(x["path"] < y["path"], -1).when(x["path"] > y["path"], 1).otherwise(0)


def heights(nodes: DataFrame) -> DataFrame:
    """Nodes with heights, and siblings numbered from 0, as they are now."""
    return surgery(nodes, [])


def pre_order(nodes: DataFrame) -> DataFrame:
    return nodes.orderBy("doc_id", "path")


def text_contents(nodes: DataFrame) -> DataFrame:
    return nodes.where("text is not null")


def sections(nodes: DataFrame, min_height: int = 2) -> DataFrame:
    return nodes.where((F.col("depth") > 0) & (F.col("height") >= min_height))


def nodes_with_height(nodes: DataFrame, height: int) -> DataFrame:
    return nodes.where(F.col("height") == height)


def paths_to_height(nodes: DataFrame, height: int) -> DataFrame:
    """(doc_id, path, step, step_path): the chain from the root to each node of that height."""
    own = nodes_with_height(nodes, height).select("doc_id", "path", F.posexplode(F.concat(F.when(F.col("depth") > 0, ancestors(F.col("path"))).otherwise(F.array().cast("array<array<int>>")), F.array("path"))).alias("step", "step_path"))
    return own


def has_text(nodes: DataFrame) -> DataFrame:
    """(doc_id, has_text)."""
    return nodes.groupBy("doc_id").agg(F.coalesce(F.bool_or(F.length("text") > 0), F.lit(False)).alias("has_text"))


def get_part(nodes: DataFrame, pattern: str, most: int | None = None, min_depth: int = 0, max_depth: int | None = None) -> DataFrame:
    """Nodes whose headline begins with a match of pattern, in pre-order; none below another, `most` a document."""
    band = F.col("depth") >= min_depth
    if max_depth is not None:
        band &= F.col("depth") <= max_depth
    hits = nodes.where(band & F.col("headline").rlike(f"^(?:{pattern})"))
    free = hits.join(under(nodes, hits, proper=True), ["doc_id", "path"], "left_anti")
    if most is None:
        return free
    return free.withColumn("__r", F.row_number().over(Window.partitionBy("doc_id").orderBy("path"))).where(F.col("__r") <= most).drop("__r")


def remove(nodes: DataFrame, paths: DataFrame, spans: DataFrame | None = None):
    """Nodes (and spans) without the subtrees at paths (doc_id, path); siblings close up and heights follow."""
    marked = nodes.join(paths.select("doc_id", "path", F.lit(True).alias("__x")).distinct(), ["doc_id", "path"], "left")
    left = surgery(marked, [("leaf", F.col("__x"), 0)], spans)
    return left.drop("__x") if spans is None else (left[0].drop("__x"), left[1])


def _moved(df: DataFrame, spot: DataFrame) -> DataFrame:
    n = F.size("__at")
    moves = (F.size("path") >= n) & (F.slice("path", F.lit(1), n - 1) == F.slice("__at", F.lit(1), n - 1)) & (F.get("path", n - 1) >= F.get("__at", n - 1))
    moved = F.transform("path", lambda x, i: F.when(i == n - 1, x + 1).otherwise(x))
    return df.join(spot, "doc_id", "left").withColumn("path", F.when(F.coalesce(moves, F.lit(False)), moved).otherwise(F.col("path"))).drop("__at")


def insert(nodes: DataFrame, subtree: DataFrame, at: DataFrame, spans: DataFrame | None = None, sub_spans: DataFrame | None = None):
    """Nodes with subtree (NODES, rooted at []) put in at the paths of `at` (doc_id, path); later siblings move on. With
    spans and sub_spans, the spans of both at their new places."""
    spot = at.select("doc_id", F.col("path").alias("__at"))
    put = lambda df: df.join(spot, "doc_id").withColumn("path", F.concat("__at", "path")).drop("__at")
    both = _moved(nodes, spot).unionByName(put(subtree)).withColumn("depth", F.size("path"))
    every = None if spans is None else _moved(spans, spot) if sub_spans is None else _moved(spans, spot).unionByName(put(sub_spans))
    return surgery(both, [], every)


def cut(nodes: DataFrame, at: DataFrame, spans: DataFrame | None = None):
    """The subtrees at paths (doc_id, path), one a document, rooted at []; with spans, theirs too."""
    spot = at.select("doc_id", F.col("path").alias("__at"))

    def below(df: DataFrame) -> DataFrame:
        own = df.join(spot, "doc_id").where(F.slice("path", F.lit(1), F.size("__at")) == F.col("__at"))
        return own.withColumn("path", F.slice("path", F.size("__at") + 1, F.greatest(F.size("path"), F.lit(1)))).drop("__at")

    own = below(nodes).withColumn("depth", F.size("path"))
    return own if spans is None else (own, below(spans))


def prune(nodes: DataFrame, keep: Column, min_height: int = 0, spans: DataFrame | None = None):
    """Nodes (and spans) without subtrees whose top, of at least min_height by the original heights, fails `keep`; the root
    stays.

    Nothing happens to a document whose root is no higher than min_height."""
    return surgery(nodes, [("fail", ~F.coalesce(keep, F.lit(False)), min_height)], spans)


def prune_empty_headlines(nodes: DataFrame, min_height: int = 2, spans: DataFrame | None = None):
    return prune(nodes, F.col("headline") != "", min_height, spans)


def prune_by_script(nodes: DataFrame, coverage: float, min_height: int = 2, share: Column | None = None, spans: DataFrame | None = None):
    """Keeps headlines of which at least `coverage` are plain Latin letters (or what `share` says)."""
    return prune(nodes, (T.latin_share(F.col("headline")) if share is None else share) >= coverage, min_height, spans)


def prune_textless(nodes: DataFrame, spans: DataFrame | None = None):
    """Nodes with text somewhere below; the root stays."""
    return surgery(nodes, [("bare", F.length("text") > 0, 0)], spans)


def _named(names: list[str]) -> Column:
    return F.col("text").isNotNull() & F.lower("headline").isin([n.lower() for n in names])


def prune_named_text(nodes: DataFrame, names: list[str], spans: DataFrame | None = None):
    """Without text leaves whose lower-case headline is one of names."""
    return surgery(nodes, [("leaf", _named(names), 0)], spans)


def prune_all(nodes: DataFrame, coverage: float | None = None, names: list[str] | None = None, spans: DataFrame | None = None, empty: bool = True, textless: bool = True):
    """Empty headlines, then foreign ones, then text-less parts, then named blocks, all in one pass over each document."""
    headline = F.coalesce("headline", F.lit(""))
    steps = [("fail", headline == "", 2)] if empty else []
    if coverage is not None:
        steps.append(("fail", T.latin_share(headline) < coverage, 2))
    if textless:
        steps.append(("bare", F.length("text") > 0, 0))
    if names:
        steps.append(("leaf", _named(names), 0))
    return surgery(nodes, steps, spans)


def abstract(nodes: DataFrame) -> DataFrame:
    """The first part of depth 1 headed as abstract that has text below: its node."""
    named = nodes.where((F.col("depth") == 1) & T.is_abstract(F.col("headline")))
    full = nodes.where(F.length("text") > 0).select("doc_id", F.slice("path", 1, 1).alias("path")).distinct()
    w = Window.partitionBy("doc_id").orderBy("path")
    return named.join(full, ["doc_id", "path"], "left_semi").withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def text_tree(docs: DataFrame) -> DataFrame:
    """NODES of plain texts: the root's headline is the first line, each other line is a section of its sentences. JVM only."""
    lines = F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")
    own = docs.select("doc_id", F.get(lines, F.lit(0)).alias("title"), F.slice(lines, 2, 1_000_000_000).alias("lines"))
    secs = own.select("doc_id", F.posexplode("lines").alias("i", "line"))
    leaves = secs.select("doc_id", "i", F.posexplode(F.filter(F.split("line", r"(?<=[.!?])\s+"), lambda x: x != "")).alias("j", "s"))
    root = own.select("doc_id", F.array().cast("array<int>").alias("path"), F.lit(0).alias("depth"), F.when(F.size("lines") > 0, 2).otherwise(0).alias("height"), F.col("title").alias("headline"), F.lit(None).cast("string").alias("text"))
    mid = secs.select("doc_id", F.array("i").alias("path"), F.lit(1).alias("depth"), F.lit(1).alias("height"), F.regexp_extract("line", r"^(\S+)", 1).alias("headline"), F.lit(None).cast("string").alias("text"))
    low = leaves.select("doc_id", F.array("i", "j").alias("path"), F.lit(2).alias("depth"), F.lit(0).alias("height"), F.lit(None).cast("string").alias("headline"), F.col("s").alias("text"))
    return root.unionByName(mid).unionByName(low)
