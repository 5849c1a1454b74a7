"""Kernels on plain values, and frames on small hand-made tables."""

import json

import pytest
from pyspark.sql import functions as F

from quillspark.functions import similarity as M
from quillspark.functions import text as T
from quillspark.operators import bibliography as B
from quillspark.operators import dedup, filters, multilevel, search, spans, tree
from quillspark.operators import ids as I  # noqa: E741
from quillspark.plans import jobs
from quillspark.sources import readers, sinks, tei


def one(spark, c, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(c).first()[0]


def test_normalize(spark):
    n = T.normalize_string(F.col("s"))
    assert one(spark, n, s="Žluťoučký  kůň-2011 Timmermann") == "zlutoucky kun 201 timerman"
    assert one(spark, n, s="日本") == "日本"
    for raw, clean in {
        "A study. arXiv:1234.5 [cs]": "A study", "Waves of light, CoRR, abs/1505.1": "Waves of light", "Random maps, math.PR/1506.03806. [47] , more": "Random maps", "Fever in civets, Archive Number: 2012.1. Mail": "Fever in civets",
        "A map Doi: 10.1109/X. 58. Another, with words": "A map", "What doi means and where": "What doi means and where", "Model 3.0 of 122.333": "Model 3.0 of 122.333", "Aftermath 2": "After", "é DOI 10.1": "é", "x math 5\ny": "x\ny",
    }.items():
        assert one(spark, T.clean_title(F.col("s")), s=raw) == clean
    assert one(spark, n, s="Щедрая Юность") == "shchedraia iunost " and one(spark, n, s="Ψυχή και ΘΕΟΣ") == "psukhe kai theos"
    assert one(spark, T.dedup_authors(F.array(F.lit("J. Doe"), F.lit("Doe J"), F.lit("Ann Lee"))), s="") == ["J. Doe", "Ann Lee"]


def test_scores(spark):
    a, b = F.array(*map(F.lit, "abc")), F.array(*map(F.lit, "abd"))
    assert one(spark, M.similarity(a, b), s="") == pytest.approx(2 * 0.5 * (2 / 3) / (0.5 + 2 / 3))
    assert one(spark, M.containment(a, F.array(F.lit("a"))), s="") == 1.0
    both = T.author_sets(F.array(F.lit("John Ronald Doe"))), T.author_initials(F.array(F.lit("John Ronald Doe")))
    short = T.author_sets(F.array(F.lit("J. R. Doe"))), T.author_initials(F.array(F.lit("J. R. Doe")))
    assert one(spark, M.match_author_groups(*both, *short), s="") is True
    other = T.author_sets(F.array(F.lit("Kim Roe"))), T.author_initials(F.array(F.lit("Kim Roe")))
    assert one(spark, M.match_author_groups(*both, *other), s="") is False


def test_against(spark):
    docs = {1: "The cat, the CAT sat", 2: "", 3: None, 4: "dog 7 dog dog", 5: "nothing"}
    items = {10: "the cat the mat", 11: "Dog dog", 12: "...", 13: "sat 7"}
    frame = lambda x: spark.createDataFrame(list(x.items()), "id bigint, text string")
    got = {(r.a, r.b): (r.containment, r.dice) for r in M.against(frame(docs), frame(items)).collect()}
    assert set(got) == {(a, b) for a in docs for b in items}
    shared = {(1, 10): (2 / 3, 6 / 9), (1, 13): (1 / 2, 2 / 7), (4, 11): (1.0, 4 / 6), (4, 13): (1 / 2, 2 / 6)}
    assert {k: pytest.approx(v) for k, v in got.items() if v != (0, 0)} == shared


def test_search(spark):
    papers = spark.createDataFrame([(1, "Deep learning for citation analysis", 2019, ["Ann Lee"]), (2, "Deep learning for citation analysis", 2010, ["Bob Roe"]), (3, "Graphs", None, ["C D"])], "id bigint, title string, year int, authors array<string>")
    probes = spark.createDataFrame([(10, "Deep Learning for Citation Analysis", 2010, ["B. Roe"]), (11, "deep learning for citation", 2019, ["A. Lee"]), (12, "nothing alike", None, ["X"]), (13, None, None, None)], "probe_id bigint, title string, year int, authors array<string>")
    assert {r.probe_id: r.id for r in search.search(probes, papers).collect()} == {10: 2, 11: 1, 12: None, 13: None}
    assert {r.probe_id: r.id for r in search.search(probes, papers, fulltext=True).collect()} == {10: 2, 11: 1, 12: None, 13: None}


@pytest.mark.parametrize("t", [0.5, 0.75, 1.0])
def test_similar_sets_are_complete(spark, t):
    import itertools
    import random

    rng = random.Random(1)
    sets = [sorted(set(rng.choices("abcdefgh", k=rng.randrange(1, 7)))) for _ in range(40)]
    sets = [list(x) for x in {tuple(s) for s in sets}]
    got = {(tuple(r.a), tuple(r.b)) for r in search.similar_sets(spark.createDataFrame([(s,) for s in sets], "a array<string>"), spark.createDataFrame([(s,) for s in sets], "b array<string>"), t).collect()}
    want = set()
    for a, b in itertools.product(sets, sets):
        i = len(set(a) & set(b))
        if i:
            j, c = i / len(set(a) | set(b)), i / min(len(a), len(b))
            if 2 * j * c / (j + c) >= t - 1e-12:
                want.add((tuple(a), tuple(b)))
    assert got == want


def test_spans():
    text, own = spans.expand_dashed("a [3-5] b [1]-[2] (7-9) [1-2]", [(None, 2, 7), (9, 10, 13), (0, 14, 17)], {3: 0, 1: 9})
    assert text == "a [3][4][5] b [1][2] (7-9) [1-2]" and own == [(0, 2, 5), (None, 5, 8), (None, 8, 11), (9, 14, 17), (None, 17, 20)]
    assert spans.expand_dashed("war (1990-1995) [2-4]", [(None, 4, 15)], {}) == ("war (1990-1995) [2-4]", [(None, 4, 15)])
    for spaced in ("(3) - (5)", "(3)-(5)"):
        assert spans.expand_dashed(f"x {spaced}.", [(None, 2, 5)], {4: 1})[0] == "x (3)(4)(5)."
    back, cites, refs = spans.merge_dashed("x [7] [1][2][3] y [5][4] z", [(6, 2, 5), (0, 6, 9), (1, 9, 12), (2, 12, 15), (4, 18, 21), (3, 21, 24)], [(None, 16, 17), (0, 25, 26)])
    assert back == "x [7] [1-3] y [5][4] z" and cites == [(6, 2, 5), (None, 6, 11), (4, 14, 17), (3, 17, 20)] and refs == [(None, 12, 13), (0, 21, 22)]
    assert spans.merge_dashed("(1)(2) 3 4", [(0, 0, 3), (1, 3, 6), (2, 7, 8), (None, 7, 10)], (), False) == ("(1-2) 3 4", [(None, 0, 5), (2, 6, 7)], [])
    text, own, _ = spans.normalize("x [1] y", [(3, 2, 5)], [])
    assert text == "x [CITE:3] y" and own == [(3, 2, 10)]
    assert spans.fix_boundaries("see (Doe, 2001 ) now", [(1, 4, 14)]) == [(1, 4, 16)]
    assert spans.uncross([(1, 0, 9), (2, 5, 12)]) == [(1, 0, 5), (2, 5, 12)]
    assert spans.vancouver_map([(1, 0), (4, 3)], True) == {1: 0, 2: 1, 3: 2, 4: 3}
    assert spans.vancouver_map([(1, 0), (1, 5), (4, 8), (6, 9)], True) == {1: 5, 2: 6, 3: 7, 4: 8, 6: 9}
    assert spans.split_merged("As in [5, 6] and", [(None, 0, 12), (2, 13, 16)], {5: 4}) == [(4, 6, 9), (None, 9, 12), (2, 13, 16)]
    assert spans.split_merged("no list 5,6", [(None, 0, 11)], {5: 4}) == [(None, 0, 11)]
    assert spans.drop_suspicious("[1-300] [1-3] [2-2000] x y", [(None, 0, 7), (None, 8, 13), (None, 14, 22), (None, 23, 24), (0, 25, 26)]) == [(None, 8, 13), (0, 25, 26)]
    assert spans.snap("see (Doe, 2001) and", [(1, 5, 8), (2, 10, 13)], __import__("re").compile(spans.HARVARD)) == [(1, 4, 8), (2, 10, 15)]
    assert spans.drop_suspicious("[99] [1]", [(None, 0, 4), (None, 5, 8)], 10) == [(None, 5, 8)]
    assert spans.add_harvard("As (Doe, 2001) and Lee (1999) say", [(None, 3, 14)], lambda a, y: {2001: 0, 1999: 1}[y]) == [(0, 3, 14), (1, 19, 29)]
    with pytest.raises(ValueError):
        spans.replace("abcdef", [(1, 3, "")], [[(0, 2, 5)]])
    assert spans.replace("abcdef", [(1, 3, "")], [[(0, 2, 5)]], "remove") == ("adef", [[]])
    assert [("One. Two!")[s:e] for s, e in spans.sentences("One. Two!")] == ["One.", "Two!"]
    accept = spans.vocabulary_acceptor({"learning"})
    assert spans.dehyphenate("deep learn- ing now", accept) == [(5, 15, "learning")]


def section(h, text="x"):
    return {"headline": h, "content": [{"headline": None, "content": {"text": text, "citations": [], "references": []}}]}


def test_levels():
    assert [multilevel.sparsity(*x) for x in (((1,), (4,)), ((1,), (1, 1)), ((1, 1), (4, 2)), ((3, 1, 2), (4, 2)), ((2,), (1,)))] == [2, 0, 4, 2, -1]
    assert multilevel.guess("II.2.1 Data", True) == ((2, 2, 1), ("ROMAN", "ARABIC", "ARABIC"))
    ok, t = multilevel.to_levels({"headline": "T", "content": [section(h) for h in ("1 Introduction", "2 Methods", "2.1 Data", "2.2 Model", "3 Results", "Appendix")]})
    assert ok and [s["headline"] for s in t["content"]] == ["1 Introduction", "2 Methods", "3 Results", "Appendix"]
    assert [s["headline"] for s in t["content"][1]["content"] if s["headline"]] == ["2.1 Data", "2.2 Model"]
    assert multilevel.to_levels({"headline": "T", "content": [section("A"), section("B")]})[0]
    assert not multilevel.to_levels({"headline": "T", "content": {"text": "", "citations": [], "references": []}})[0]


@pytest.fixture(scope="module")
def nodes(spark):
    t = {"headline": "T", "content": [section("1 Introduction"), section("Abstract", "short"), section("2 Related Work", "as said"), {"headline": "", "content": []}]}
    return tree.flatten(spark.createDataFrame([(7, json.dumps(t))], "doc_id bigint, hierarchy string")).cache()


def test_tree(nodes):
    back = json.loads(tree.rebuild(nodes).first().hierarchy)
    assert [s["headline"] for s in back["content"]] == ["1 Introduction", "Abstract", "2 Related Work", ""]
    assert tree.abstract(nodes).first().path == [1]
    assert [r.path for r in tree.get_part(nodes, "2").collect()] == [[2]]
    assert tree.pre_order(tree.prune_textless(nodes)).where("depth = 1").count() == 3
    sub = nodes.where("path = array(1)").withColumn("path", F.array().cast("array<int>")).withColumn("depth", F.lit(0))
    grown = tree.insert(nodes, sub, nodes.where("path = array(0)").select("doc_id", "path"))
    assert [r.headline for r in grown.where("depth = 1").orderBy("path").collect()] == ["Abstract", "1 Introduction", "Abstract", "2 Related Work", ""]
    assert filters.has_headline(nodes, "2 Rel", 1, 1, 1).first().passed


TREE = {"headline": "T", "content": [
    {"headline": "", "content": [section("Lost", "gone [1]"), section("Lost too", "more")]},
    {"headline": "2 Kept", "content": [section("2.1 Sub", "kept [2] text"), {"headline": "Void", "content": []}, section("Метод", "x [3]"), {"headline": "figure", "content": {"text": "fig", "citations": [], "references": [{"index": 0, "start": 0, "end": 3}]}}]},
    section("Abstract", "short [4]"), section("3 Related Work", "as said [5]"), section("4 End", "end [6]"),
]}


@pytest.fixture(scope="module")
def cited(spark):
    """Nodes and spans of a tree whose texts cite `[n]` with index n."""

    def mark(t):
        import re

        if isinstance(t["content"], dict):
            t["content"]["citations"] = [{"index": int(m[1]), "start": m.start(), "end": m.end()} for m in re.finditer(r"\[(\d)\]", t["content"]["text"])]
        else:
            for c in t["content"]:
                mark(c)
        return t

    docs = spark.createDataFrame([(1, json.dumps(mark(json.loads(json.dumps(TREE)))))], "doc_id bigint, hierarchy string")
    return tree.flatten(docs).cache(), tree.flatten_spans(docs).cache()


def consistent(nodes, spans_):
    """Every span's text names its index; heights and depths are right; the indexes."""
    texts = {tuple(r.path): r.text for r in nodes.collect()}
    rows = [(tuple(r.path), r.kind, r["index"], r.start, r.end) for r in spans_.collect()]
    for path, kind, index, start, end in rows:
        assert texts[path][start:end] == (f"[{index}]" if kind == "cit" else "fig")
    for r in nodes.collect():
        below = [len(p) for p in texts if p[: len(r.path)] == tuple(r.path)]
        assert r.depth == len(r.path) and r.height == max(below) - r.depth
        assert not r.path or (*r.path[:-1], r.path[-1] - 1) in texts or not r.path[-1]
    return sorted(i for _, k, i, _, _ in rows if k == "cit")


def test_spans_follow_trees(spark, cited):
    nodes_, spans_ = cited
    assert consistent(nodes_, spans_) == [1, 2, 3, 4, 5, 6]
    at = spark.createDataFrame([(1, [1, 0])], "doc_id bigint, path array<int>")
    assert consistent(*tree.remove(nodes_, at, spans_)) == [1, 3, 4, 5, 6]
    assert consistent(*tree.prune_empty_headlines(nodes_, spans=spans_)) == [2, 3, 4, 5, 6]
    assert consistent(*tree.prune_by_script(nodes_, 0.2, 1, spans=spans_)) == [2, 4, 5, 6]
    left, moved = tree.prune_textless(nodes_, spans_)
    assert consistent(left, moved) == [1, 2, 3, 4, 5, 6] and left.where("headline = 'Void'").isEmpty()
    left, moved = tree.prune_named_text(nodes_, ["Figure"], spans_)
    assert consistent(left, moved) == [1, 2, 3, 4, 5, 6] and moved.where("kind = 'ref'").isEmpty()
    every = tree.prune_all(nodes_, 0.2, ["figure"], spans_)
    assert consistent(*every) == [2, 3, 4, 5, 6] and [r.headline for r in every[0].where("depth = 1").orderBy("path").collect()] == ["2 Kept", "Abstract", "3 Related Work", "4 End"]
    back = json.loads(tree.rebuild(*every).first().hierarchy)["content"][0]["content"][0]["content"][0]["content"]
    assert back == {"text": "kept [2] text", "citations": [{"index": 2, "start": 5, "end": 8}], "references": []}
    sub, inside = tree.cut(nodes_, at, spans_)
    assert consistent(sub, inside) == [2] and sub.where("depth = 0").first().headline == "2.1 Sub"
    rest, left = tree.remove(nodes_, at, spans_)
    whole, all_ = tree.insert(rest, sub, at, left, inside)
    key = lambda df: sorted(map(str, df.collect()))
    assert key(whole.select(*nodes_.columns)) == key(nodes_) and key(all_.select(*spans_.columns)) == key(spans_)


def test_related_work_round_trip(spark, cited):
    nodes_, spans_ = cited
    bib = spark.createDataFrame([(1, i, 50 + i if i != 4 else None, f"B{i}", 2000, ["A B"]) for i in range(7)], "doc_id bigint, pos int, id bigint, title string, year int, authors array<string>")
    out = jobs.related_work(nodes_, spans_, bib, spark.createDataFrame([(55,), (51,)], "id bigint"))
    assert [r.path for r in out["sections"].collect()] == [[3]] and out["citations"].first().citations == [55]
    assert consistent(out["rest"], out["rest_spans"]) == [1, 2, 3, 4, 6] and consistent(out["target"], out["target_spans"]) == [5]
    assert [r.headline for r in out["rest"].where("depth = 1").orderBy("path").collect()] == ["Abstract", "", "2 Kept", "4 End"]
    back, spans2, cites = jobs.back_from_related_work(out["rest"], out["target"], out["sections"], bib, out["rest_spans"], out["target_spans"])
    assert consistent(back, spans2) == [1, 2, 3, 4, 5, 6] and cites.first().citations == [50, 51, 52, 53, 55, 56]
    assert [r.headline for r in back.where("depth = 1").orderBy("path").collect()] == ["Abstract", "", "2 Kept", "3 Related Work", "4 End"]
    again = jobs.back_to_related_work(back, out["sections"], spans2)
    assert consistent(again["rest"], again["rest_spans"]) == [1, 2, 3, 4, 6] and consistent(again["target"], again["target_spans"]) == [5]


def test_pruned_documents(spark, cited):
    nodes_, spans_ = cited
    empty = tree.flatten(spark.createDataFrame([(9, json.dumps({"headline": "E", "content": [section("", "")]}))], "doc_id bigint, hierarchy string"))
    bib = spark.createDataFrame([(1, 0, 9, "E", 2000, ["A"]), (1, 1, 1, "T", 2000, ["A"]), (9, 0, 1, "T", 2000, ["A"])], "doc_id bigint, pos int, id bigint, title string, year int, authors array<string>")
    left, moved, cut = jobs.pruned(nodes_.unionByName(empty), spans_, bib, 0.2, ["figure"])
    assert {r.doc_id for r in left.collect()} == {1} and consistent(left, moved) == [2, 3, 4, 5, 6]
    assert sorted((r.doc_id, r.pos, r.id) for r in cut.collect()) == [(1, 0, None), (1, 1, 1)] or {(r.doc_id, r.pos, r.id) for r in cut.collect()} == {(1, 0, None), (1, 1, 1)}


def test_enhanced_and_harvard(spark):
    rows = [(1, [0], None, "As [1] and [3-5], see [2, 3]. [900]", [(0, 3, 6), (None, 11, 16), (None, 22, 28), (None, 30, 35)]), (1, [1], None, "again [4]", [(3, 6, 9)]), (2, [0], None, "As Lee (1999) and (Roe, 2001) say (Poe, 2005)", [(None, 19, 28)]), (3, [0], None, None, None)]
    leaves = spark.createDataFrame(rows, "doc_id bigint, path array<int>, headline string, text string, spans array<struct<index: int, start: int, end: int>>")
    got = {(r.doc_id, tuple(r.path)): (r.text, [tuple(s) for s in r.spans]) for r in spans.enhanced(leaves).collect()}
    assert got[1, (0,)] == ("As [1] and [3][4][5], see [2, 3]. [900]", [(0, 3, 6), (2, 11, 14), (3, 14, 17), (None, 17, 20), (None, 34, 39)]) and got[1, (1,)] == ("again [4]", [(3, 6, 9)])
    bib = spark.createDataFrame([(2, 0, None, "x", 1999, ["Ann Lee"]), (2, 1, None, "y", 2001, ["Bob Roe"]), (1, 0, None, "z", 1999, ["Ann Lee"])], "doc_id bigint, pos int, id bigint, title string, year int, authors array<string>")
    new, grown = jobs.identified_spans(leaves, bib)
    got = {(r.doc_id, tuple(r.path)): [tuple(s) for s in r.spans or []] for r in new.collect()}
    assert got[2, (0,)] == [(0, 3, 13), (1, 19, 28)] and got[1, (1,)] == [(3, 6, 9)]
    assert {r.doc_id: r.growth for r in grown.collect()}[2] == 2


def brute_greedy(papers, match):
    """The rule in its own words, paper by paper, over all pairs."""
    of, heads = {}, []
    for x in sorted(papers):
        y = min((y for y in papers if y != x and match(x, y)), key=lambda y: (-match(x, y), y), default=None)
        if y is None:
            of[x] = x
        elif x in of:
            of[y] = of[x]
        elif y in of:
            of[x] = of[y]
        else:
            h = min((h for h in heads if match(x, h)), key=lambda h: (-match(x, h), h), default=None)
            if h is None:
                heads.append(x)
            of[x] = of[y] = x if h is None else h
    return of


@pytest.mark.parametrize("t, years, authors", [(1.0, 0, True), (0.6, 1, True), (0.6, 2, False)])
def test_dedup_greedy(spark, t, years, authors):
    import random

    rng = random.Random(6)
    papers = {i: (" ".join(sorted(set(rng.choices(["red", "blue", "fish", "bird", "tree"], k=rng.randrange(1, 5))))), rng.choice([None, 2000, 2001, 2003]), rng.choice([["Ann Lee"], ["A. Lee", "Bo Roe"], ["Bo Roe"], []])) for i in range(70)}
    names = lambda a: ({*a.lower().replace(".", "").split()}, {*[w[0] for w in a.lower().split()[:-1]], a.lower().split()[-1]})
    inside = lambda a, b: a <= b or b <= a

    def match(x, y):
        (s, p, a), (u, q, b) = papers[x], papers[y]
        s, u = set(s.split()), set(u.split())
        i = len(s & u)
        if not i or (p and q and abs(p - q) > years):
            return 0
        j, c = i / len(s | u), i / min(len(s), len(u))
        if 2 * j * c / (j + c) < t - 1e-9:
            return 0
        if authors and not any(inside(f, g) or inside(f, h) or inside(k, g) for f, k in map(names, a) for g, h in map(names, b)):
            return 0
        return round(2 * j * c / (j + c), 9)

    key = {i: (frozenset(p[0].split()), p[1], frozenset(map(str, p[2]))) for i, p in papers.items()}
    first = {i: i if authors and not papers[i][2] else min(j for j in papers if key[j] == key[i]) for i in papers}
    of = brute_greedy({x for x in first.values()}, match)
    want = {i: of.get(f, f) for i, f in first.items()}
    rows = [(i, *p) for i, p in papers.items()]
    got = dedup.deduplicate(spark.createDataFrame(rows, "id bigint, title string, year int, authors array<string>"), t, years, authors)
    assert {r.id: r.representative for r in got.collect()} == want and len(set(want.values())) < 60


def test_json_lines_keep_trees_and_extra_keys(spark, tmp_path):
    docs = [{"id": 1, "title": 'A "b" é', "hierarchy": {"headline": None, "content": []}, "origin": "x", "flag": True, "score": 1.5, "more": {"a": [1]}, "citations": [3]}, {"id": 2, "title": None, "hierarchy": None}]
    (tmp_path / "in.jsonl").write_text("\n\n".join(json.dumps(d) for d in docs))
    own = readers.json_lines(spark, str(tmp_path / "in.jsonl"))
    assert json.loads(own.where("id = 1").first().extra) == {"origin": "x", "flag": True, "score": 1.5, "more": {"a": [1]}} and own.where("id = 2").first().extra is None
    sinks.write_json_lines(own, str(tmp_path / "out"))
    back = {d["id"]: d for r in spark.read.text(str(tmp_path / "out")).collect() for d in [json.loads(r.value)]}
    assert back[1]["hierarchy"] == docs[0]["hierarchy"] and back[1]["title"] == docs[0]["title"] and back[1]["more"] == {"a": [1]} and back[1]["flag"] is True and back[2]["hierarchy"] is None
    for d in docs:
        assert {k: back[d["id"]][k] for k in d} == d
    import gzip

    (tmp_path / "z.json.gz").write_bytes(gzip.compress((tmp_path / "in.jsonl").read_bytes()))
    assert sorted(map(str, readers.json_lines(spark, str(tmp_path / "z.json.gz")).collect())) == sorted(map(str, own.collect()))


def test_row_positions_follow_files(spark, tmp_path):
    sizes, at = [3, 400, 1, 50, 0, 7], 0
    for k, n in enumerate(sizes):
        (tmp_path / f"{k}.json").write_text("".join(json.dumps({"id": at + i, "title": "x" * (900 if k % 2 else 3)}) + "\n" for i in range(n)))
        at += n
    for schema in ("id bigint, title string", "id bigint, title string, extra string"):
        got = readers.numbered(readers.json_lines(spark, str(tmp_path), schema)).collect()
        assert len(got) == at and all(r.id == r.row_pos for r in got)
    assert sorted(r.id for r in readers.slice_rows(readers.numbered(readers.json_lines(spark, str(tmp_path), "id bigint, title string")), 2, 6).collect()) == [2, 3, 4, 5]


def test_graph_over_lines(spark, tmp_path):
    (tmp_path / "g.json").write_text(json.dumps({str(i): list(range(i % 4)) for i in range(20)}, indent=2))
    assert {tuple(r) for r in readers.citation_graph(spark, str(tmp_path / "g.json")).collect()} == {(i, j) for i in range(20) for j in range(i % 4)}


def test_similarity_links(spark):
    titles = ["red fish blue tree", "Fish red, blue tree", "red fish blue", "bird", "", None, "red fish blue bird tree", "bird"]
    got = {r.id: (r.class_id, r.class_size, r.n_links) for r in search.similarity_links(spark.createDataFrame(list(enumerate(titles)), "id bigint, title string"), 0.75).collect()}
    assert got == {0: (0, 2, 3), 1: (0, 2, 3), 2: (2, 1, 3), 3: (3, 2, 1), 4: (4, 1, 0), 5: (5, 1, 0), 6: (6, 1, 3), 7: (3, 2, 1)}


def test_related_work(spark, nodes):
    spans_ = spark.createDataFrame([(7, [2, 0], "cit", 0, 0, 0, 2)], "doc_id bigint, path array<int>, kind string, pos int, index int, start int, end int")
    bib = spark.createDataFrame([(7, 0, 5, "B", 2000, ["A B"])], "doc_id bigint, pos int, id bigint, title string, year int, authors array<string>")
    out = jobs.related_work(nodes, spans_, bib, spark.createDataFrame([(5,)], "id bigint"))
    assert [r.path for r in out["sections"].collect()] == [[2]] and out["citations"].first().citations == [5]
    assert [r.headline for r in out["rest"].where("depth = 1").orderBy("path").collect()] == ["Abstract", "1 Introduction", ""]
    assert out["target"].where("depth = 0").first().headline == "2 Related Work"


def test_bibliography(spark):
    bib = spark.createDataFrame([(1, 0, None, "Deep nets", None, ["Ann Lee"]), (1, 1, 9, "Other thing", 2001, ["X Y"])], "doc_id bigint, pos int, id bigint, title string, year int, authors array<string>")
    papers = spark.createDataFrame([(4, "Deep nets", 2000, ["Ann Lee"]), (1, "Other thing", 2001, ["X Y"])], "id bigint, title string, year int, authors array<string>")
    assert {(r.pos, r.id) for r in B.identify(bib, papers).collect()} == {(0, 4), (1, 9)}
    more = spark.createDataFrame([(1, 4, "Deep nets", 2000, ["A. Lee"]), (1, 6, "New one", 1999, ["Q R"])], "doc_id bigint, id bigint, title string, year int, authors array<string>")
    assert {(r.pos, r.id, r.year) for r in B.merge_records(bib, more).collect()} == {(0, 4, 2000), (1, 9, 2001), (2, 6, 1999)}


def test_ids(spark):
    papers = spark.createDataFrame([(5, [9, 5, 9, 3])], "id bigint, citations array<bigint>")
    assert I.filter_citations(papers, spark.createDataFrame([(9,)], "id bigint")).first().citations == [9, 9]
    assert [(r.old, r.new) for r in I.dense_ids(spark.createDataFrame([(7,), (3,), (7,)], "id bigint")).orderBy("old").collect()] == [(3, 0), (7, 1)]
    with pytest.raises(Exception, match="without translation"):
        I.translate_edges(spark.createDataFrame([(1, 2)], "citing bigint, cited bigint"), spark.createDataFrame([(1, 0)], "old bigint, new bigint")).collect()


TEI = """<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><fileDesc><titleStmt><title>On Things</title></titleStmt><publicationStmt><date when="2001-05"/></publicationStmt>
<sourceDesc><biblStruct><analytic><author><persName><forename>Ann</forename><surname>Lee</surname></persName></author></analytic></biblStruct></sourceDesc></fileDesc></teiHeader>
<text><body><div><head n="1.">Intro</head><p>As <ref type="bibr" target="#b0">[1]</ref> says. More.</p></div></body><back><div><listBibl><biblStruct xml:id="b0"><analytic><title>Old</title>
<author><persName><forename>B</forename><surname>C</surname></persName></author></analytic><monogr><imprint><date type="published" when="1999"/></imprint></monogr></biblStruct></listBibl></div></back></text></TEI>"""


def test_tei(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "a.xml").write_text(TEI)
    (tmp_path / "b.xml").write_text("<broken")
    d = tei.directory(spark, str(tmp_path)).first()
    assert (d.id, d.title, d.year, d.authors, d.bibliography[0].year) == (0, "On Things", 2001, ["Ann Lee"], 1999)
    leaf = json.loads(d.hierarchy)["content"][0]["content"][0]["content"][0]["content"]
    assert leaf["text"] == "As [1] says." and leaf["citations"] == [{"index": 0, "start": 3, "end": 6}]


def test_readers_dehyphenate(spark, tmp_path):
    x = TEI.replace("As <ref", "Deep learn- ing and well- known, as <ref").replace(" says.", " says. We know learning well known.")
    (tmp_path / "a.xml").write_text(x)
    leaf = json.loads(tei.directory(spark, str(tmp_path)).first().hierarchy)["content"][0]["content"][0]["content"][0]["content"]
    assert leaf["text"] == "Deep learning and well- known, as [1] says." and leaf["citations"] == [{"index": 0, "start": 34, "end": 37}]
    text = "Intro Deep learn- ing, as in [1]. We like learning."
    ann = {"paragraph": json.dumps([{"start": 6, "end": 51}]), "bibref": json.dumps([{"start": 29, "end": 32, "attributes": {"ref_id": "b0"}}])}
    (tmp_path / "f.jsonl").write_text(json.dumps({"corpusid": 1, "content": {"text": text, "annotations": ann}}))
    (tmp_path / "m.jsonl").write_text(json.dumps({"corpusid": 1, "title": "T", "authors": [{"name": "A"}], "year": 2000, "citing": []}))
    d = readers.s2orc(readers.json_lines(spark, str(tmp_path / "m.jsonl"), readers.S2ORC_META), readers.json_lines(spark, str(tmp_path / "f.jsonl"), readers.S2ORC)).first()
    leaf = json.loads(d.hierarchy)["content"][0]["content"][0]["content"][0]["content"]
    assert leaf["text"] == "Deep learning, as in [1]." and leaf["citations"] == [{"index": None, "start": 21, "end": 24}]
    old = {"paper_id": "7", "title": "T", "body_text": [{"section": "S", "text": text[6:], "cite_spans": [{"start": 23, "end": 26, "ref_id": "b0"}], "ref_spans": []}]}
    (tmp_path / "o.jsonl").write_text(json.dumps(old))
    d = readers.s2orc_old(readers.json_lines(spark, str(tmp_path / "o.jsonl"), readers.S2ORC_OLD)).first()
    assert json.loads(d.hierarchy)["content"][0]["content"][0]["content"][0]["content"]["text"] == "Deep learning, as in [1]."


def test_dehyphenated(spark):
    import random
    import re

    rng = random.Random(3)
    stems, ends = ["learn", "know", "été", "walk", "talk"], ["ing", "ed", "er"]
    whole = [a + b for a in stems[:3] for b in ends] + stems[2:] + ["er"]
    texts = [" ".join(rng.choice([rng.choice(whole), f"{rng.choice(stems)}-{rng.choice(' ' + chr(10))}{rng.choice(ends)}".replace("walk", "Walk")]) for _ in range(rng.randrange(1, 40))) for _ in range(30)]
    docs = [*enumerate(texts), (None, texts[0]), (40, None), (41, "")]
    broken = re.compile(r"(\w+)-\s+(\w+)")
    words = {w for t in texts for w in re.findall(r"\w+", broken.sub(" ", t).lower())}
    join = lambda m: m[1] + m[2] if (m[1] + m[2]).lower() in words and not {m[1].lower(), m[2].lower()} <= words else m[0]
    want = [(d, None if t is None else broken.sub(join, t)) for d, t in docs]
    got = spans.dehyphenated(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert sorted([(r.doc_id, r.text) for r in got], key=repr) == sorted(want, key=repr)
    assert any(w != d for w, d in zip(want, docs)) and sum(r.joined for r in got) > 20


def test_s2orc(spark, tmp_path):
    ann = lambda *s: json.dumps([{"start": a, "end": str(b), "attributes": x} for a, b, x in s])
    text = "Intro We cite [1]. Fine. Old work B C"
    full = {"corpusid": 1, "content": {"text": text, "annotations": {"sectionheader": ann((0, 5, {})), "paragraph": ann((6, 24, {})), "bibref": ann((14, 17, {"ref_id": "b0"})), "bibentry": ann((25, 37, {"id": "b0", "matched_paper_id": "2"})), "bibtitle": ann((25, 33, {})), "bibauthor": ann((34, 37, {}))}}}
    meta = [{"corpusid": 1, "title": "T", "authors": [{"name": "A"}], "year": 2000, "citing": [2]}, {"corpusid": 2, "title": "Old work", "authors": [{"name": "B C"}], "year": 1990, "citing": []}]
    (tmp_path / "f.jsonl").write_text(json.dumps(full))
    (tmp_path / "m.jsonl").write_text("\n".join(map(json.dumps, meta)))
    docs = {r.id: r for r in readers.s2orc(readers.json_lines(spark, str(tmp_path / "m.jsonl"), readers.S2ORC_META), readers.json_lines(spark, str(tmp_path / "f.jsonl"), readers.S2ORC)).collect()}
    b = docs[1].bibliography[0]
    assert (b.id, b.title, b.year, b.authors) == (2, "Old work", 1990, ["B C"])
    sec = json.loads(docs[1].hierarchy)["content"][0]
    assert sec["headline"] == "Intro" and sec["content"][0]["content"][0]["content"]["citations"] == [{"index": 0, "start": 8, "end": 11}]


def test_files(spark, tmp_path):
    (tmp_path / "g.json").write_text('{"1": [2, 3]}')
    assert {tuple(r) for r in readers.citation_graph(spark, str(tmp_path / "g.json")).collect()} == {(1, 2), (1, 3)}
    sinks.write_indexed([(5, {"id": 5, "t": "é"}), (6, {"id": 6})], str(tmp_path / "o.jsonl"))
    at = {r.key: r.file_line_offset for r in sinks.read_index(spark, str(tmp_path / "o.jsonl.index")).collect()}
    assert json.loads((tmp_path / "o.jsonl").read_bytes()[at[6] :])["id"] == 6


def test_stream(spark, tmp_path):
    from quillspark.streaming import ingest

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"id": 1, "title": "A"}\n{"id": 1, "title": "B"}\n{"id": 2, "title": "C"}')
    ingest.append(ingest.once(ingest.papers(spark, str(tmp_path / "in"))), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(60)
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2]


@pytest.mark.parametrize("t", [0.3, 0.75])
@pytest.mark.parametrize("same", [False, True])
def test_joined_sets(monkeypatch, t, same):
    """The kernel of the blocked join against brute force, where it counts all words and where it looks for candidates."""
    import random

    import numpy as np

    from quillspark.operators import setjoin

    rnd = random.Random(7)
    for words, at_once in ((6, 3), (40, 50), (4000, 2_000_000)):
        monkeypatch.setattr(setjoin, "AT_ONCE", at_once)
        a = [{rnd.randrange(-words, words) * 98765432101 for _ in range(rnd.randint(1, 30))} for _ in range(60)]
        b = a if same else [{*rnd.sample(sorted(x), max(1, len(x) - 2)), 5} for x in a] + [{1}, {7}]
        flat = lambda x: (np.array([w for s in x for w in s], np.int64), np.array([len(s) for s in x]))
        got = [(i, j, s) for x in setjoin.joined(*flat(a), *flat(b), t, same) for i, j, s in zip(*(y.tolist() for y in x), strict=True)]
        want = {}
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                n = len(x & y)
                if n and (i < j or not same):
                    jac, cont = n / len(x | y), n / min(len(x), len(y))
                    if (s := 2 * jac * cont / (jac + cont)) >= t - 1e-9:
                        want[i, j] = pytest.approx(s)
        assert {(i, j): s for i, j, s in got} == want and len(got) == len(want)


def test_similarity_join_shuffles_no_candidates(spark):
    """Titles that share words but don't match never leave a worker as pairs."""
    name = lambda i: "q".join(str(i))  # noqa: E731  runs of a digit would be one
    left = spark.createDataFrame([(i, f"common words w{name(i)} x{name(i)} y{name(i)}") for i in range(300)], "left_id bigint, title string")
    right = left.withColumnRenamed("left_id", "right_id")
    plan = search.similarity_join(left, right, 0.6)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Generate" not in plan
    assert search.similarity_join(left, right, 0.6).count() == 300 and search.similarity_join(left, right, 0.3).count() == 90000


def test_prefix_candidates_of_equal_titles(spark):
    """Equal probes and papers by the thousand, beginnings of all lengths, against brute force; equal probes meet once."""
    titles = ["same words here now"] * 3000 + ["sa", "same wo", "same words h", "same words here", "s", "same words here now and then", "x" * 5, "zebra ab", "!!!", ""]
    rows = spark.createDataFrame(list(enumerate(titles)), "id bigint, title string")
    probes = rows.where("id >= 2990").withColumnRenamed("id", "probe_id")
    got = {}
    for r in search.prefix_candidates(probes, rows, 5).collect():
        got.setdefault(r.probe_id, []).append(r.id)
    norm = dict(rows.select("id", T.normalize_string(F.col("title"))).collect())
    want = {p: x for p in range(2990, len(titles)) if norm[p] and (x := [i for i in norm if norm[i].startswith(norm[p])][:5])}
    assert {p: sorted(x) for p, x in got.items()} == want
    met = search.prefix_candidates(rows.withColumnRenamed("id", "probe_id"), rows, 5)
    assert met.count() == sum(len([i for i in norm if norm[i].startswith(n)][:5]) for n in norm.values() if n and n != norm[0]) + 3000 * 5


def test_best_of():
    """The kernel of the top k in small steps against a full sort, with many equal scores."""
    import numpy as np

    from quillspark.functions.similarity import best_of

    rnd = np.random.default_rng(3)
    for k in (1, 4, 11):
        q, c, ids = rnd.integers(-2, 3, (30, 4)) * 0.1, rnd.integers(-2, 3, (200, 4)) * 0.1, rnd.permutation(200)
        i, own, score = best_of(q, ((ids[p], c[p]) for p in np.array_split(np.arange(200), 3)), k, rows=7, columns=13)
        full = np.einsum("ij,kj->ik", q, c)
        for x in range(30):
            best = np.lexsort((ids, -full[x]))[:k]
            assert own[i == x].tolist() == ids[best].tolist() and score[i == x] == pytest.approx(full[x][best])
    assert [len(x) for x in best_of(rnd.random((5, 4)), iter([(np.arange(2), rnd.random((2, 4)))]), 3)] == [10, 10, 10]


def test_names_are_looked_up_once(spark, monkeypatch):
    import unicodedata

    import pandas as pd

    asked = []
    monkeypatch.setattr(unicodedata, "name", lambda c, d, own=unicodedata.name: asked.append(c) or own(c, d))
    assert T.names_covered("LATIN .*LETTER").func(pd.Series(["aé1 " * 50, "", None, "aa\x00"])).round(6).tolist() == [0.5, 0.0, 0.0, 0.666667]
    assert len(asked) == len(set(asked))


def test_band_join_parts_hot_keys(spark, monkeypatch):
    """One key, years known and unknown on both sides, against brute force, in as many tasks as the pairs need."""
    monkeypatch.setattr(search, "PAIRS", 1000)
    a = [(i, 2000 + i % 9 if i % 5 else None, i % 11 // 10) for i in range(150)]
    b = [(i, 2000 + i % 7 if i % 4 else None, i % 7 // 6) for i in range(80)]
    met = search.band_join(spark.createDataFrame(a, "probe int, py int, k int"), spark.createDataFrame(b, "id int, qy int, k int"), "k", "py", "qy", 2).select("probe", "id")
    want = sorted((i, j) for i, x, k in a for j, y, m in b if k == m and (x is None or y is None or abs(x - y) <= 2))
    assert sorted(map(tuple, met.collect())) == want
    assert met.rdd.getNumPartitions() > 8
    none = spark.createDataFrame([], "id int, qy int, k int")
    assert search.band_join(spark.createDataFrame(a, "probe int, py int, k int"), none, "k", "py", "qy", 2).count() == 0


def test_tei_without_content(spark):
    """Files without content, or in batches that leave nothing, give no documents."""
    files = spark.createDataFrame([("1", None), ("2", b"<x/>"), ("3", b"no")], "path string, content binary")
    assert tei.documents(files).count() == 0
