"""Spans over text: replacement, repair and grouping. Kernels take and return plain Python values; *_udf wrap them.

A span is (index or None, start, end), end exclusive, in code points.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Callable, Iterator, Sequence
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from quillspark.schema import SPAN
from quillspark.session import sliced

_SPANS = pa.list_(pa.struct({"index": pa.int32(), "start": pa.int32(), "end": pa.int32()}))
Span = tuple[int | None, int, int]

_NUM = r"\s*\d+\s*"
_PAIR = rf"{_NUM}-{_NUM}"
_LIST = rf"{_NUM}(?:,{_NUM})+"
_INSIDE = rf"(?:{_LIST}|{_PAIR}|{_NUM})"
ROUND, SQUARE = rf"\({_INSIDE}\)", rf"\[{_INSIDE}\]"
NORMALIZED = r"\[CITE:(?:UNK|\d+)\]"
_NAME = r"(?!Although\b|Also\b)[A-Z][\w'’-]+"
_TWO = rf"({_NAME})(?:\s+(?:and|&)\s+({_NAME})|\s+et\s+al\.?)?"
_YEAR = r"((?:19|20)\d\d[a-z]?(?:,\s*p+\.\s*\d+)?)"
HARVARD = rf"\(?(?:e\.g\.,?\s*)?{_TWO},\s*{_YEAR}\)?|{_TWO}\s+\({_YEAR}\)"
STYLES = {"HARVARD": HARVARD, "VANCOUVER_PARENTHESIS": ROUND, "VANCOUVER_SQUARE_BRACKETS": SQUARE, "NORMALIZED": NORMALIZED}


def style(counts: dict[str, Column]) -> Column:
    """The style with the most matches; UNKNOWN if none or several have the most."""
    top = F.greatest(*counts.values())
    wins = sum((F.when(c == top, 1).otherwise(0) for c in counts.values()), F.lit(0))
    out = F.lit("UNKNOWN")
    for name, c in counts.items():
        out = F.when(c == top, F.lit(name)).otherwise(out)
    return F.when((top > 0) & (wins == 1), out).otherwise("UNKNOWN")


#: What has a number in brackets and is no citation by number: telephone numbers as +1 (988) 555-2485, years as in Roe (2001).
_NO_NUMBER = rf"\(\d{{2,5}}\)\s*\d{{3,4}}-\d{{3,4}}|{_TWO}\s+\((?:19|20)\d\d\)"


def citation_style(leaves: DataFrame, bare: bool = True) -> DataFrame:
    """(doc_id, style) from all texts (doc_id, text) of a document. Without bare, bracketed numbers of telephones and years
    of citations by name don't count as citations by number."""
    counts = {n: F.regexp_count("text", F.lit(p)) for n, p in STYLES.items()}
    if not bare:
        counts["VANCOUVER_PARENTHESIS"] -= F.regexp_count("text", F.lit(_NO_NUMBER))
    per = leaves.groupBy("doc_id").agg(*[F.sum(c).alias(n) for n, c in counts.items()])
    return per.select("doc_id", style({n: F.coalesce(F.col(n), F.lit(0)) for n in STYLES}).alias("style"))


@F.pandas_udf(ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType())])))
def citation_places(text: pd.Series, style: pd.Series) -> pd.Series:
    """Where texts have what looks like a citation in that style; nothing for other styles and null texts."""
    forms = {n: re.compile(p) for n, p in STYLES.items()}
    return pd.Series([[{"start": m.start(), "end": m.end()} for m in forms[s].finditer(t)] if s in forms and t else [] for t, s in zip(text, style, strict=True)])


def overlap(a: Sequence, b: Sequence) -> bool:
    return a[-2] < b[-1] and b[-2] < a[-1]


def replace(text: str, changes: Sequence[tuple[int, int, str]], groups: Sequence[Sequence[Span]], collision: str = "raise") -> tuple[str, list[list[Span]]]:
    """text with disjoint (start, end, new) parts replaced, and groups of spans moved along.

    A span that a change cuts through is a collision: `skip` leaves out the change, `remove` the span, `merge` extends
    the span over the new text, `raise` raises. A change inside a span only changes its length."""
    cut = lambda s, c: s[1] < c[1] and c[0] < s[2] and not (s[1] <= c[0] and c[1] <= s[2])
    todo = sorted(changes)
    spans = [list(g) for g in groups]
    if collision == "skip":
        todo = [c for c in todo if not any(cut(s, c) for g in spans for s in g)]
    elif any(cut(s, c) for g in spans for s in g for c in todo):
        if collision == "raise":
            raise ValueError("a replacement cuts through a span")
        if collision == "remove":
            spans = [[s for s in g if not any(cut(s, c) for c in todo)] for g in spans]
        else:
            spans = [[(s[0], min([s[1], *(c[0] for c in todo if cut(s, c))]), max([s[2], *(c[1] for c in todo if cut(s, c))])) for s in g] for g in spans]
    parts, at = [], 0
    for s, e, new in todo:
        parts += [text[at:s], new]
        at = e
    parts.append(text[at:])

    def moved(p: int, end: bool) -> int:
        shift = 0
        for s, e, new in todo:
            if e <= p and (s < p or not end):
                shift += len(new) - (e - s)
        return p + shift

    return "".join(parts), [[(i, moved(s, False), moved(e, True)) for i, s, e in g] for g in spans]


def shift(spans: Sequence[Span], start: int, by: int) -> list[Span]:
    """Spans at or after `start` moved."""
    return [(i, s + by, e + by) if s >= start else (i, s, e) for i, s, e in spans]


def shift_column(spans: Column, start: Column, by: Column) -> Column:
    return F.transform(spans, lambda s: F.when(s["start"] >= start, F.struct(s["index"].alias("index"), (s["start"] + by).alias("start"), (s["end"] + by).alias("end"))).otherwise(s))


def uncross(spans: Sequence[Span]) -> list[Span]:
    """In order of start, each cut where the next begins."""
    own = sorted(spans, key=lambda s: s[1])
    return [(i, s, min(e, n[1])) for (i, s, e), n in zip(own, [*own[1:], (None, 1 << 60, 0)], strict=True)]


def uncross_rows(spans: DataFrame, by: list[str], *more: str) -> DataFrame:
    """The same for rows; of equal spans the one that is first by `more` is cut."""
    w = Window.partitionBy(*by).orderBy("start", "end", *more)
    return spans.withColumn("end", F.coalesce(F.least("end", F.lead("start").over(w)), F.col("end")))


def numbers(s: str) -> list[int]:
    return [int(x) for x in re.findall(r"\d+", s)]


def vancouver_map(found: Sequence[tuple[int, int]], interpolate: bool = False) -> dict[int, int]:
    """Number in the text -> bibliography index, from (number, index) of spans with one number; the last one counts.

    With interpolation, numbers between two neighbours with the same difference are filled in."""
    known = dict(found)
    if interpolate:
        own = sorted(known)
        for a, b in zip(own, own[1:], strict=False):
            if known[a] - a == known[b] - b:
                known |= {n: n + known[a] - a for n in range(a + 1, b)}
    return known


def vancouver_rows(found: DataFrame, by: list[str]) -> DataFrame:
    """The same, interpolated, for rows (by, number, index): gaps and islands over index - number."""
    first = found.groupBy(*by, "number").agg(F.min("index").alias("index")).withColumn("d", F.col("index") - F.col("number"))
    w = Window.partitionBy(*by).orderBy("number")
    runs = first.withColumn("island", F.sum(F.when(F.col("d") == F.lag("d").over(w), 0).otherwise(1)).over(w))
    ends = runs.groupBy(*by, "island", "d").agg(F.min("number").alias("lo"), F.max("number").alias("hi"))
    return ends.select(*by, F.explode(F.sequence("lo", "hi")).alias("number"), "d").select(*by, "number", (F.col("number") + F.col("d")).alias("index"))


_DASHED = re.compile(r"\[(\d+)\s*-\s*(\d+)\]|\[(\d+)\]\s*-\s*\[(\d+)\]|\((\d+)\)\s*-\s*\((\d+)\)")


def expand_dashed(text: str, spans: Sequence[Span], index_of: Callable[[int], int | None] | dict[int, int]) -> tuple[str, list[Span]]:
    """`[3-6]`, `[3]-[6]`, `(3)-(6)` written out as one bracket for each number, each with a span of its own.

    Only where a citation span overlaps them; `(3-6)` may be anything and stays. How long a range may be is for
    drop_suspicious() to say, which comes first."""
    get = index_of.get if isinstance(index_of, dict) else index_of
    out, added, keep, at, moved = [], [], list(spans), 0, 0
    for m in _DASHED.finditer(text):
        lo, hi = (int(x) for x in m.groups() if x is not None)
        here = (m.start() + moved, m.end() + moved)
        if lo > hi or not any(overlap(s, here) for s in keep):
            continue
        left, right = ("[", "]") if "[" in m[0] else ("(", ")")
        new = [f"{left}{n}{right}" for n in range(lo, hi + 1)]
        grown = sum(map(len, new)) - len(m[0])
        out += [text[at : m.start()], *new]
        at = m.end()
        keep = shift([s for s in keep if not overlap(s, here)], here[1], grown)
        p = here[0]
        for n, x in zip(range(lo, hi + 1), new, strict=True):
            added.append((get(n), p, p + len(x)))
            p += len(x)
        moved += grown
    out.append(text[at:])
    return "".join(out), sorted(keep + added, key=lambda s: s[1])


def merge_dashed(text: str, spans: Sequence[Span], others: Sequence[Span] = (), square: bool = True) -> tuple[str, list[Span], list[Span]]:
    """The inverse: neighbouring spans of consecutive numbers, each in brackets, become `[first-last]` with one span, index
    None. Spans that don't hold exactly one number are dropped; other spans, of references, move along."""
    left, right = "[]" if square else "()"
    own = [(s, n[0]) for s in sorted(spans, key=lambda s: s[1]) if len(n := numbers(text[s[1] : s[2]])) == 1]
    groups: list[list[tuple[Span, int]]] = []
    for s, n in own:
        part, last = text[s[1] : s[2]], groups[-1][-1] if groups else None
        if last and last[1] + 1 == n and not text[last[0][2] : s[1]].strip() and part[0] == left and part[-1] == right:
            groups[-1].append((s, n))
        else:
            groups.append([(s, n)])
    changes = [(g[0][0][1], g[-1][0][2], f"{left}{g[0][1]}-{g[-1][1]}{right}") for g in groups if len(g) > 1]
    outer = [(g[0][0][0] if len(g) == 1 else None, g[0][0][1], g[-1][0][2]) for g in groups]
    new, (cites, rest) = replace(text, changes, [outer, list(others)], "merge")
    return new, cites, rest


_BRACKETS = re.compile(rf"{ROUND}|{SQUARE}")


def split_merged(text: str, spans: Sequence[Span], index_of: dict[int, int]) -> list[Span]:
    """Spans without index in which brackets with numbers stand, as `Lamma et al. [5,6,7]`: one span for each number.

    The first begins at the bracket, each ends behind its comma, the last with the bracket."""
    out: list[Span] = []
    for i, s, e in spans:
        found = list(_BRACKETS.finditer(text, s, e)) if i is None else []
        for m in found:
            at, parts = m.start(), m[0].split(",")
            for k, part in enumerate(parts):
                end = at + len(part) + (k < len(parts) - 1)
                out.append((index_of.get(numbers(part)[0]), at, end))
                at = end
        if not found:
            out.append((i, s, e))
    return sorted(out, key=lambda s: s[1])


def drop_suspicious(text: str, spans: Sequence[Span], max_id: int = 1000, most: int = 100) -> list[Span]:
    """Without spans that have no index and not exactly one number, or a number over max_id, or a range of `most` or more."""

    def fine(span: Span) -> bool:
        if span[0] is not None:
            return True
        part = text[span[1] : span[2]]
        if not _DASHED.search(part):
            return len(n := numbers(part)) == 1 and n[0] <= max_id
        ends = [numbers(x) for x in part.split("-")]
        return len(ends) == 2 and all(len(n) == 1 and n[0] <= max_id for n in ends) and ends[1][0] - ends[0][0] < most

    return [s for s in spans if fine(s)]


def snap(text: str, spans: Sequence[Span], pattern: re.Pattern) -> list[Span]:
    """Spans take the bounds of the match that they overlap; of several, the first's start and the last's end."""
    out = sorted(spans, key=lambda s: s[1])
    for m in pattern.finditer(text):
        hit = [k for k, s in enumerate(out) if overlap(s, m.span())]
        if hit:
            first, last = out[hit[0]], out[hit[-1]]
            out[hit[0]] = (first[0], m.start(), m.end() if len(hit) == 1 else first[2])
            if len(hit) > 1:
                out[hit[-1]] = (last[0], last[1], m.end())
    return out


def fix_boundaries(text: str, spans: Sequence[Span]) -> list[Span]:
    """Spans widened, over blanks, to a bracket that is missing at one end."""
    out = []
    for i, s, e in spans:
        for left, right in ("()", "[]"):
            part = text[s:e]
            if part.count(left) > part.count(right):
                k = e
                while k < len(text) and text[k].isspace():
                    k += 1
                e = k + 1 if k < len(text) and text[k] == right else e
            elif part.count(right) > part.count(left):
                k = s - 1
                while k >= 0 and text[k].isspace():
                    k -= 1
                s = k if k >= 0 and text[k] == left else s
        out.append((i, s, e))
    return out


def normalize(text: str, citations: Sequence[Span], references: Sequence[Span]) -> tuple[str, list[Span], list[Span]]:
    """Spans' texts replaced by `[CITE:i]` and `[REF:i]` (UNK without index), one blank around each."""
    every = sorted([(s, "CITE") for s in citations] + [(s, "REF") for s in references], key=lambda x: x[0][1])
    out, at = "", 0
    new: dict[str, list[Span]] = {"CITE": [], "REF": []}
    for (i, s, e), kind in every:
        if s < at:
            continue
        before = (out + text[at:s]).rstrip()
        mark = f"[{kind}:{'UNK' if i is None else i}]"
        out = before + (" " if before else "")
        new[kind].append((i, len(out), len(out) + len(mark)))
        out += mark
        at = e
        rest = text[at:]
        at += len(rest) - len(rest.lstrip())
        if at < len(text):
            out += " "
    return out + text[at:], new["CITE"], new["REF"]


def harvard_hits(text: str) -> list[tuple[int, int, list[str], int]]:
    """(start, end, authors, year) of citations by name; those whose year isn't a plain number are left out."""
    out = []
    for m in re.finditer(HARVARD, text):
        g = m.groups()
        names, year = ([x for x in g[:2] if x], g[2]) if g[2] else ([x for x in g[3:5] if x], g[5])
        if year.isdigit():
            out.append((m.start(), m.end(), names, int(year)))
    return out


def add_harvard(text: str, spans: Sequence[Span], resolve: Callable[[list[str], int], int | None]) -> list[Span]:
    """Spans and those citations by name that overlap none of them and that resolve; then unknown spans with one hit are resolved."""
    hits = harvard_hits(text)
    new = [(i, s, e) for s, e, names, year in hits if not any(overlap(x, (s, e)) for x in spans) and (i := resolve(names, year)) is not None]
    known = []
    for i, s, e in spans:
        own = [h for h in hits if overlap((s, e), h[:2])] if i is None else []
        known.append((resolve(own[0][2], own[0][3]) if len(own) == 1 else i, s, e))
    return sorted(known + new, key=lambda s: s[1])


def enhance(text: str, spans: Sequence[Span], style_: str, index: dict[int, int], max_id: int = 1000, most: int = 100, plain: bool = True) -> tuple[str, list[Span]]:
    """Spans of one text repaired by its document's style and its map of numbers to entries; ranges and lists of numbers in
    plain texts only (those without a headline)."""
    out = list(spans)
    if style_.startswith("VANCOUVER"):
        out = drop_suspicious(text, out, max(max_id, *index, 0), most)
        if plain:
            text, out = expand_dashed(text, out, index)
            out = split_merged(text, out, index)
    p = {"HARVARD": HARVARD, "VANCOUVER_PARENTHESIS": ROUND, "VANCOUVER_SQUARE_BRACKETS": SQUARE}.get(style_)
    return text, snap(text, out, re.compile(p)) if p else out


def enhanced(leaves: DataFrame, interpolate: bool = True, max_id: int = 1000, most: int = 100) -> DataFrame:
    """leaves (doc_id, path, headline, text, spans) with text and citation spans repaired by the whole document's style and
    numbering; spans are arrays of (index, start, end). A document's leaves meet in one row of an aggregate."""
    leaf = F.struct("path", "headline", "text", "spans")
    docs = leaves.groupBy("doc_id").agg(F.array_sort(F.collect_list(leaf), lambda x, y: F.when(x["path"] < y["path"], -1).when(x["path"] > y["path"], 1).otherwise(0)).alias("leaves"))
    styles = citation_style(leaves, bare=False)
    kind = "array<struct<path: array<int>, headline: string, text: string, spans: array<struct<index: int, start: int, end: int>>>>"

    def one(rows: list[dict], style_: str | None) -> list[dict]:
        each = [[(x["index"], x["start"], x["end"]) for x in r["spans"] or []] for r in rows]
        texts = [r["text"] or "" for r in rows]
        found = [(n[0], i) for t, own in zip(texts, each, strict=True) for i, s, e in own if i is not None and len(n := numbers(t[s:e])) == 1]
        index = vancouver_map(found, interpolate)
        new = [enhance(t, own, style_ or "UNKNOWN", index, max_id, most, r["headline"] is None) for r, t, own in zip(rows, texts, each, strict=True)]
        return [{"path": r["path"], "headline": r["headline"], "text": t, "spans": [dict(zip(("index", "start", "end"), x, strict=True)) for x in got]} for r, (t, got) in zip(rows, new, strict=True)]

    run = sliced(one, kind, pa.list_(pa.struct({"path": pa.list_(pa.int32()), "headline": pa.string(), "text": pa.string(), "spans": _SPANS})))
    both = docs.join(styles, "doc_id", "left").select("doc_id", F.explode(run("leaves", "style")).alias("r"))
    return both.select("doc_id", "r.*")


def harvard_spans(leaves: DataFrame, bib: DataFrame) -> DataFrame:
    """Leaves (doc_id, path, text, spans) of all documents with citations by name added and resolved, for those documents
    whose style is by name; the others stay.

    A citation that no span overlaps becomes a span if one entry of bib (doc_id, pos, title, year, authors) has such an
    author and year; a span without entry that holds one citation takes its entry. One word of a name is enough."""
    from quillspark.operators.bibliography import lookup

    named = citation_style(leaves, bare=False).where("style = 'HARVARD'").select("doc_id")
    own = leaves.join(named, "doc_id", "left_semi")
    hit = "array<struct<start: int, end: int, authors: array<string>, year: int>>"

    @F.pandas_udf(hit)
    def find(text: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(("start", "end", "authors", "year"), h, strict=True)) for h in harvard_hits(t or "")] for t in text])

    hits = own.select("doc_id", "path", "spans", F.explode(find("text")).alias("h"))
    met = F.filter("spans", lambda x: (x["start"] < F.col("h.end")) & (F.col("h.start") < x["end"]))
    hits = hits.select("doc_id", "path", "h.*", met.alias("met")).where("size(met) = 0 or exists(met, x -> x.index is null)")
    ask = hits.withColumn("query_id", F.struct("doc_id", "path", "start")).withColumn("title", F.lit(None).cast("string"))
    found = lookup(ask, bib, author_threshold=1e-9).where("pos is not null").select("query_id.*", F.col("pos").cast("int").alias("pos"))
    known = hits.join(found, ["doc_id", "path", "start"]).groupBy("doc_id", "path").agg(F.collect_list(F.struct("start", "end", "pos", F.size("met").alias("met"))).alias("known"))
    count = hits.where("size(met) > 0").groupBy("doc_id", "path").agg(F.collect_list(F.struct("start", "end")).alias("all"))
    inside = lambda x, y: (x["start"] < y["end"]) & (y["start"] < x["end"])
    entry = lambda x: F.get(F.filter("known", lambda y: inside(x, y) & (y["met"] > 0)), F.lit(0))["pos"]
    alone = lambda x: F.size(F.filter("all", lambda y: inside(x, y))) == 1
    old = F.transform("spans", lambda x: F.struct(F.when(x["index"].isNull() & alone(x), entry(x)).otherwise(x["index"]).alias("index"), x["start"].alias("start"), x["end"].alias("end")))
    new = F.transform(F.filter("known", lambda y: y["met"] == 0), lambda y: F.struct(y["pos"].alias("index"), y["start"].alias("start"), y["end"].alias("end")))
    none = F.array().cast(f"array<{SPAN}>")
    both = F.array_sort(F.concat(F.coalesce(old, F.coalesce("spans", none)), F.coalesce(new, none)), lambda x, y: F.when(x["start"] < y["start"], -1).when(x["start"] > y["start"], 1).otherwise(0))
    return leaves.join(known, ["doc_id", "path"], "left").join(count, ["doc_id", "path"], "left").withColumn("known", F.coalesce("known", F.array().cast("array<struct<start: int, end: int, pos: int, met: int>>"))).withColumn("all", F.coalesce("all", F.array().cast("array<struct<start: int, end: int>>"))).withColumn("spans", both).drop("known", "all").select(*leaves.columns)


def kernel(f: Callable[[str, list[Span]], tuple[str, list[Span]]]) -> Callable[[Column, Column], Column]:
    """An Arrow UDF on (text, array of spans) from a kernel that returns both."""

    def one(text: str | None, own: list[dict] | None) -> dict:
        new, out = f(text or "", [(x["index"], x["start"], x["end"]) for x in own or []])
        return {"text": new, "spans": [dict(zip(("index", "start", "end"), x, strict=True)) for x in out]}

    return sliced(one, "struct<text: string, spans: array<struct<index: int, start: int, end: int>>>", pa.struct({"text": pa.string(), "spans": _SPANS}))


@cache
def _word_codes() -> np.ndarray:
    """Which code points are letters, marks, numbers or _."""
    return np.array([unicodedata.category(chr(c))[0] in "LMN" or c == 95 for c in range(sys.maxunicode + 1)])


def group_places(text: str, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Numbers of the groups of spans in their order: a span with only non-word characters between it and the one before
    belongs to that one's group. The text is looked at once."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    words = np.concatenate([[0], np.cumsum(_word_codes()[codes])])
    lo = np.minimum(end[:-1], len(codes))
    hi = np.clip(start[1:], lo, len(codes))
    return np.cumsum(np.concatenate([[1], words[hi] > words[lo]]))


@F.arrow_udf(ArrayType(LongType()))
def group_numbers(text: pa.Array, start: pa.Array, end: pa.Array) -> pa.Array:
    """group_places of texts with arrays of starts and ends."""
    out = [group_places(t.as_py() or "", s.values.to_numpy(), e.values.to_numpy()) if len(s) else np.empty(0, np.int64) for t, s, e in zip(text, start, end, strict=True)]
    at = np.concatenate([[0], np.cumsum([len(x) for x in out], dtype=np.int64)])
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *out]), pa.int64()))


def group(spans: DataFrame, by: list[str], texts: DataFrame, text: str = "text") -> DataFrame:
    """Spans with group_no: consecutive ones with only non-word characters between them belong together.

    texts: (by, text); spans of no text are left out. A text meets the array of its spans once."""
    rest = [c for c in spans.columns if c not in by]
    own = spans.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("start", "end", *[c for c in rest if c not in ("start", "end")]))).alias("__s"))
    at = lambda c: F.col("__s")[c].cast("array<int>")  # noqa: E731  a lambda in the arguments may keep Spark from taking the UDF out
    both = own.join(texts.select(*by, F.col(text).alias("__t")), by).select(*by, "__s", group_numbers(F.col("__t"), at("start"), at("end")).alias("group_no"))
    each = both.select(*by, F.explode(F.arrays_zip("__s", "group_no")).alias("z"))
    return each.select(*by, *[F.col("z.__s")[c].alias(c) for c in rest], "z.group_no")


def dehyphenate(text: str, accept: Callable[[str, str], bool]) -> list[tuple[int, int, str]]:
    """Replacements that join `word- part` where accept(word, part) says so."""
    return [(m.start(), m.end(), m[1] + m[2]) for m in re.finditer(r"(\w+)-\s+(\w+)", text) if accept(m[1], m[2])]


def vocabulary_acceptor(words: set[str]) -> Callable[[str, str], bool]:
    """Joined words that occur in a vocabulary which doesn't have both parts."""
    return lambda a, b: (a + b).lower() in words and not (a.lower() in words and b.lower() in words)


_BROKEN = re.compile(r"(\w+)-\s+(\w+)")


@F.pandas_udf(ArrayType(StringType()))
def _pairs(text: pd.Series) -> pd.Series:
    return pd.Series([sorted({f"{a} {b}".lower() for a, b in _BROKEN.findall(t or "")}) for t in text])


@F.pandas_udf(ArrayType(StringType()))
def _whole_words(text: pd.Series) -> pd.Series:
    return pd.Series([sorted(set(re.findall(r"\w+", _BROKEN.sub(" ", t or "").lower()))) for t in text])


def corpus_joins(texts: DataFrame, key: str) -> DataFrame:
    """(key, joins): of (key, text) rows, the broken pairs, as "word part", that the vocabulary of all texts accepts.

    The rule is that of vocabulary_acceptor; broken words' parts don't count as words. Nothing is collected."""
    pairs = texts.select(key, F.explode(_pairs("text")).alias("pair")).distinct()
    at = F.split("pair", " ")
    each = pairs.select("pair").distinct().select("pair", F.get(at, F.lit(0)).alias("__a"), F.get(at, F.lit(1)).alias("__b"))
    asked = each.select(F.explode(F.array("__a", "__b", F.concat("__a", "__b"))).alias("w")).distinct()
    words = texts.select(F.explode(_whole_words("text")).alias("w")).join(asked, "w", "left_semi").distinct()
    known = lambda name: words.select(F.col("w").alias(name), F.lit(True).alias(f"{name}k"))
    ok = each.withColumn("__j", F.concat("__a", "__b")).join(known("__j"), "__j").join(known("__a"), "__a", "left").join(known("__b"), "__b", "left")
    ok = ok.where("__ak is null or __bk is null").select("pair")
    return pairs.join(ok, "pair").groupBy(key).agg(F.array_sort(F.collect_set("pair")).alias("joins"))


def rejoin(text: str, joins, *groups: list[dict]) -> tuple[str, list[list[dict]]]:
    """text with its broken words joined where joins has them, and groups of {index, start, end} moved; a join that cuts a span is left out."""
    known = set(joins if joins is not None else ())
    changes = dehyphenate(text, lambda a, b: f"{a} {b}".lower() in known) if known else []
    if not changes:
        return text, list(groups)
    new, moved = replace(text, changes, [[(x["index"], x["start"], x["end"]) for x in g] for g in groups], "skip")
    return new, [[dict(zip(("index", "start", "end"), x, strict=True)) for x in g] for g in moved]


def dehyphenated(docs: DataFrame) -> DataFrame:
    """(doc_id, text, joined): whole texts with broken words joined by the corpus vocabulary, and how many were."""
    own = docs.select("doc_id", "text", F.xxhash64("text").alias("__key"))
    joins = corpus_joins(own.select("__key", "text").where("text is not null"), "__key")

    @F.pandas_udf("struct<text: string, joined: int>")
    def run(text: pd.Series, joins: pd.Series) -> pd.DataFrame:
        rows = []
        for t, j in zip(text, joins, strict=True):
            known = set(j if j is not None else ())
            changes = dehyphenate(t, lambda a, b: f"{a} {b}".lower() in known) if known and t is not None else []  # noqa: B023
            rows.append((replace(t, changes, [])[0] if changes else t, len(changes)))
        return pd.DataFrame(rows, columns=["text", "joined"])

    return own.join(joins, "__key", "left").select("doc_id", run("text", "joins").alias("r")).select("doc_id", "r.text", "r.joined")


_END = re.compile(r"(?<=[.!?])[\"')\]]*\s+(?=[A-Z0-9\"'(\[])")


def sentences(text: str) -> list[tuple[int, int]]:
    """Half-open offsets of sentences: they end with . ? or ! before blanks and a capital, digit or opening mark."""
    cuts = [m.end() for m in _END.finditer(text)]
    edges = [0, *cuts, len(text)]
    out = []
    for a, b in zip(edges, edges[1:], strict=False):
        part = text[a:b]
        s, e = a + len(part) - len(part.lstrip()), a + len(part.rstrip())
        if s < e:
            out.append((s, e))
    return out


def _sentence_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo in range(0, b.num_rows, 100):
            part, row, found = b.slice(lo, 100), [], []
            for i, t in enumerate(part.column("text").to_pylist()):
                own = [(s, e, t[s:e]) for s, e in sentences(t)]
                row += [i] * len(own)
                found += own
            start, end, text = zip(*found, strict=True) if found else ([], [], [])
            yield pa.record_batch({"doc_id": part.column("doc_id").take(pa.array(row, pa.int64())), "start": pa.array(start, pa.int32()), "end": pa.array(end, pa.int32()), "sentence": pa.array(text, pa.string())})


def sentence_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, start, end, sentence) of whole texts (doc_id, text); null texts have none."""
    own = docs.where("text is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(_sentence_rows, "doc_id bigint, start int, end int, sentence string")
