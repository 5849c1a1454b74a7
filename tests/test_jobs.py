"""Every job of the command line on small collections, read from files and written to files."""

import gzip
import json

import pytest

from quillspark.plans import cli


def leaf(text, cites=(), headline=None):
    return {"headline": headline, "content": {"text": text, "citations": [{"index": i, "start": s, "end": e} for i, s, e in cites], "references": []}}


def section(headline, *leaves):
    return {"headline": headline, "content": [{"headline": None, "content": list(leaves)}]}


def paper(id_, title, year, *sections, bib=(), citations=(), authors=("Ann Lee",)):
    entries = [{"id": i, "title": t, "year": y, "authors": ["Ann Lee"]} for i, t, y in bib]
    return {
        "id": id_, "s2orc_id": None, "mag_id": None, "doi": None, "title": title, "authors": list(authors), "year": year, "fields_of_study": None, "citations": list(citations),
        "hierarchy": {"headline": title, "content": list(sections)}, "bibliography": entries, "non_plaintext_content": [], "venue": "here",
    }


ABSTRACT = section("Abstract", leaf("We look at it."), leaf("It is new."))
DOCS = [
    paper(0, "A study of deep graph walks", 2001, section("1 Introduction", leaf("As (Lee, 2003) says.")), section("2 Related Work", leaf("See [1] here.", [(0, 4, 7)]), leaf("Nothing.")), ABSTRACT, section("", leaf("lost")), bib=[(None, "Shallow trees in the wild", 2003)]),
    paper(1, "Shallow trees in the wild", 2003, ABSTRACT, section("1 Body", leaf("Text."), leaf("Ü", headline="Figure"))),
    paper(2, "A study of deep graph walks", 2001, ABSTRACT, citations=[1, 9], bib=[(1, "Shallow trees in the wild", 2003), (9, "Gone", None)]),
    paper(3, "Numbered parts of long papers", None, *[section(h, leaf("T.")) for h in ("1 One", "1.1 One a", "1.2 One b", "2 Two", "2.1 Two a", "3 Three")]),
]


def put(path, rows):
    path.write_text("".join(json.dumps(r, ensure_ascii=False) + "\n" for r in rows))
    return str(path)


@pytest.fixture(scope="module", autouse=True)
def plain_plans(spark):
    """Plans of many small joins: compiling them would take longer than running them."""
    own = {"spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "2"}
    before = {k: spark.conf.get(k, None) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@pytest.fixture(scope="module")
def at(tmp_path_factory):
    d = tmp_path_factory.mktemp("jobs")
    put(d / "docs", DOCS)
    put(d / "mag", [
        {"PaperId": 70, "OriginalTitle": "A study of deep graph walks", "Year": 2001, "Authors": ["A. Lee", "Bo Roe"], "References": [71, 72], "Fields": ["Maths"], "Doi": "10.1/x", "Journal": "J"},
        {"PaperId": 71, "OriginalTitle": "Shallow trees in the wild", "Year": 2003, "Authors": ["Ann Lee"], "References": [], "Fields": None, "Doi": None, "Journal": None},
        {"PaperId": 72, "OriginalTitle": "Something else altogether", "Year": 1990, "Authors": ["Cy Dee"], "References": [], "Fields": None, "Doi": None, "Journal": None},
    ])
    (d / "graph").write_text(json.dumps({"0": [1, 3], "2": [1]}))
    (d / "ids").write_text("0\n2\n")
    return d


def run(spark, at, job, *args):
    """Rows by the name of the result's path."""
    own = cli.parser().parse_args([job, *[str(at / a[1:]) if a.startswith("@") else a for a in args]])
    out = {}
    for path, df in cli.run(spark, own).items():
        rows = [json.loads(r.value) if df.columns != ["value"] else r.value for r in (df if df.columns == ["value"] else cli.sinks.as_json(df)).collect()]
        out[path.rsplit("/", 1)[-1]] = sorted(rows, key=lambda r: r.get("id", 0)) if rows and isinstance(rows[0], dict) else rows
    return out


def heads(tree):
    return [x["headline"] for x in tree["content"]]


def test_trees(spark, at):
    got = run(spark, at, "pruning_hier", "@docs", "r", "--empty-headlines", "--no-text", "--plain-latin", "0.5", "--named-text-blocks")["r"]
    assert heads(got[0]["hierarchy"]) == ["1 Introduction", "2 Related Work", "Abstract"]
    assert got[0]["venue"] == "here"
    assert len(got[1]["hierarchy"]["content"][1]["content"][0]["content"]) == 1
    got = run(spark, at, "multi_lvl_hier", "@docs", "r", "--multi", "m", "--discard")
    assert heads([x for x in got["r"] if x["id"] == 3][0]["hierarchy"]) == ["1 One", "2 Two", "3 Three"]
    assert {x["id"] for x in got["m"]} >= {3}
    assert [x["id"] for x in run(spark, at, "multi_lvl_hier", "@docs", "r", "--from-row", "3")["r"]] == [3]


def test_related_work_and_back(spark, at):
    known = json.loads(json.dumps(DOCS))
    known[0]["bibliography"][0]["id"] = 1
    put(at / "known", known)
    got = run(spark, at, "related_work", "@known", "reviews", "refs")
    (r,) = got["reviews"]
    assert r["citations"] == [1]
    assert heads(r["hierarchy"]) == ["Abstract", "1 Introduction", ""]
    assert r["related_work"]["headline"] == "2 Related Work"
    assert r["related_work"]["content"][0]["content"][0]["content"]["citations"] == [{"index": 0, "start": 4, "end": 7}]
    assert [x["id"] for x in got["refs"]] == [1]
    put(at / "reviews", got["reviews"])
    put(at / "refs", got["refs"])
    (back,) = run(spark, at, "convert_back_from_rw", "@reviews", "r")["r"]
    assert back["citations"] == [1]
    assert sorted(heads(back["hierarchy"])) == sorted(heads(DOCS[0]["hierarchy"]))
    put(at / "whole", [back])
    (again,) = run(spark, at, "convert_back_to_rw", "@whole", "@reviews", "r")["r"]
    assert again["related_work"] == got["reviews"][0]["related_work"]
    assert again["hierarchy"] == got["reviews"][0]["hierarchy"]
    kept = run(spark, at, "related_work_filter", "@reviews", "@refs", "a", "b", "--min-cit", "1", "--min-cit-frac", "0.5")
    assert [x["id"] for x in kept["a"]] == [0]
    assert [x["id"] for x in kept["b"]] == [1]
    kept = run(spark, at, "related_work_filter", "@reviews", "@refs", "a", "b", "--min-cit", "1", "--min-par-ref", "3")
    assert kept == {"a": [], "b": []}
    parts = run(spark, at, "make_rw_train_val_test_splits", "@reviews", "@refs", "tr", "va", "te", "--test-prop", "1", "--val-prop", "0")
    assert [len(parts[p]) for p in ("tr", "va", "te")] == [0, 0, 1]
    (f,) = run(spark, at, "filter_features", "@reviews", "f", "--rw", "--references", str(at / "refs"))["f"]
    assert (f["known_fraction"], f["multi_cited_fraction"], f["has_abstract"], f["abstract_text_parts"], f["target_text_parts"]) == (1, 1, 1, 2, 2)
    assert f["input_text_parts"] == 0 or f["input_words"] > 0
    assert {"target_vocabulary", "documents"} <= {x["metric"] for x in run(spark, at, "stats", "@reviews", "s", "--rw", "--references", str(at / "refs"))["s"]}


def test_collections(spark, at):
    assert [x["id"] for x in run(spark, at, "sort_dataset", "@docs", "r")["r"]] == [0, 1, 2, 3]
    got = run(spark, at, "discard_documents", "@docs", "r", "@ids")["r"]
    assert [(x["id"], x["citations"]) for x in got] == [(0, []), (2, [])]
    assert run(spark, at, "filter_missing_ids", "@docs", "r")["r"][2]["citations"] == [1]
    assert [x["id"] for x in run(spark, at, "create_references", "@docs", "r", "@docs")["r"]] == [1]
    got = run(spark, at, "deduplication", "@docs", "r")["r"]
    assert [x["id"] for x in got] == [0, 1, 3]
    put(at / "more", [paper(0, "Shallow trees in the wild", 2003), paper(5, "An unseen paper about rain", 1999)])
    assert [x["id"] for x in run(spark, at, "extension_subset", "@docs", "@more", "r")["r"]] == [5]
    assert [x["id"] for x in run(spark, at, "extend_ids", "@docs", "@more", "r")["r"]] == [4, 5]
    got = run(spark, at, "extend", "@docs", "@more", "r", "--max-year-diff", "0")["r"]
    assert [x["id"] for x in got] == [0, 1, 2, 3, 4, 5]
    assert got[0]["bibliography"][0]["id"] == 4
    assert got[0]["citations"] == [4]
    assert run(spark, at, "merge_intervals", "r", "--intervals", str(at / "ids"), str(at / "ids"))["r"] == ["0", "2", "0", "2"]
    assert run(spark, at, "create_title_database", "@docs", "t")["t"][1]["norm_title"] == "shalow tres in the wild"


def test_bibliographies(spark, at):
    got = run(spark, at, "identify_bibliography", "@docs", "r")["r"]
    assert got[0]["bibliography"][0]["id"] == 1
    assert got[0]["citations"] == [1]
    got = run(spark, at, "enrich_bibliography_from_citation_graph", "@docs", "r", "@graph")["r"]
    assert [(b["id"], b["title"]) for b in got[0]["bibliography"]] == [(1, "Shallow trees in the wild"), (3, "Numbered parts of long papers")]
    assert got[0]["citations"] == [1, 3]
    got = run(spark, at, "identify_citation_spans", "@docs", "r")["r"]
    assert got[0]["hierarchy"]["content"][0]["content"][0]["content"][0]["content"]["citations"] in ([], [{"index": 0, "start": 3, "end": 14}])
    lines = run(spark, at, "create_papers_2_mag_mapping", "@docs", "@mag", "m")["m"]
    assert lines == ["0", "1", "0", "-1"]
    (at / "lines").write_text("\n".join(lines) + "\n")
    got = run(spark, at, "enhance_papers_with_mag", "@docs", "@mag", "@lines", "r")["r"]
    assert (got[0]["authors"], got[0]["doi"], got[0]["mag_id"], got[0]["fields_of_study"], got[0]["citations"]) == (["Ann Lee", "A. Lee", "Bo Roe"], "10.1/x", 70, ["Maths"], [1])
    assert [(b["id"], b["title"]) for b in got[0]["bibliography"]] == [(1, "Shallow trees in the wild"), (None, "Something else altogether")]
    just = run(spark, at, "enhance_papers_with_mag", "@docs", "@mag", "@lines", "r", "--just-references")["r"]
    assert (just[0]["authors"], just[0]["doi"], just[0]["citations"]) == (["Ann Lee"], None, [1])


TEI = """<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><fileDesc><titleStmt><title>{title}</title></titleStmt><sourceDesc><biblStruct><analytic><author><persName><forename>Ann</forename><surname>Lee</surname></persName></author></analytic></biblStruct></sourceDesc></fileDesc></teiHeader><text><body><div><head>H</head><p>{text}</p></div></body><back><div><listBibl><biblStruct xml:id="b0"><analytic><title>Shallow trees in the wild</title><author><persName><forename>A</forename><surname>Lee</surname></persName></author></analytic></biblStruct></listBibl></div></back></text></TEI>"""


def test_sources(spark, at):
    xml = at / "xml" / "a"
    xml.mkdir(parents=True)
    (xml / "1.xml").write_text(TEI.format(title="A study of deep graph walks", text="One."))
    (xml / "2.xml").write_text(TEI.format(title="Rain on tin roofs", text="Two."))
    (xml / "3.xml").write_text(TEI.format(title="No text", text=""))
    got = run(spark, at, "convert_core", str(at / "xml"), "r", "--mag", str(at / "mag"), "--s2orc", str(at / "docs"), "--omitted", "o")
    assert [(x["title"], x["mag_id"], x["s2orc_id"]) for x in got["r"]] == [("A study of deep graph walks", 70, 0), ("Rain on tin roofs", None, None)]
    assert len(got["o"]) == 1
    got = run(spark, at, "enhance_mag_with_core", "@mag", str(at / "xml"), "r")["r"]
    by = {x["PaperId"]: x for x in got}
    assert by[70]["References"] == [71, 72] and by[70]["Journal"] == "J"
    assert {x["OriginalTitle"] for x in got if x["PaperId"] > 72} == {"Rain on tin roofs", "No text"}
    assert all(x["References"] == [71] for x in got if x["PaperId"] > 72)
    s2 = at / "s2"
    for name, rows in {"papers": [{"corpusid": 2, "title": "B", "authors": [{"authorId": "1", "name": "Ann Lee"}], "year": 2000}, {"corpusid": 1, "title": "A", "authors": [], "year": None}], "abstracts": [{"corpusid": 2, "abstract": "abs"}], "citations": [{"citingcorpusid": 2, "citedcorpusid": 1}, {"citingcorpusid": 2, "citedcorpusid": None}]}.items():
        (s2 / name).mkdir(parents=True)
        with gzip.open(s2 / name / "part.gz", "wt") as f:
            f.write("".join(json.dumps(r) + "\n" for r in rows))
    got = run(spark, at, "extract_s2orc", str(s2), "--subfolders", "papers", "abstracts", "citations")
    assert [json.loads(x)["corpusid"] for x in got["papers.jsonl"]] == [1, 2]
    assert got["citations.json"] == ['{"2":[1]}']
    (at / "papers").write_text("\n".join(got["papers.jsonl"]))
    (at / "abstracts").write_text("\n".join(got["abstracts.jsonl"]))
    (at / "cites").write_text("\n".join(got["citations.json"]))
    meta = run(spark, at, "create_s2orc_metadata", "@papers", "@abstracts", "@cites", "r")["r"]
    assert {x["corpusid"]: (x["abstract"], x["citing"]) for x in meta} == {1: (None, []), 2: ("abs", [1])}
    assert [x["id"] for x in run(spark, at, "create_s2orc_records", "@papers", "r")["r"]] == [2]


def test_written(spark, at):
    cli.main(["sort_dataset", str(at / "docs"), str(at / "sorted")])
    assert [json.loads(x.value) for x in spark.read.text(str(at / "sorted")).collect()] == DOCS
    cli.main(["sort_dataset", str(at / "docs"), str(at / "one"), "--indexed"])
    lines = (at / "one").read_bytes()
    index = [x.split("\t") for x in (at / "one.index").read_text().splitlines()[1:]]
    assert [json.loads(lines[int(o) :].split(b"\n")[0])["id"] for _, o in index] == [0, 1, 2, 3]


def test_all_jobs_have_a_parser():
    assert len(cli.JOBS) == 31
