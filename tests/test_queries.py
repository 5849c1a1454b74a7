"""Every registered query of the engine against its SQL, on the smallest tables."""

import pytest

from quillspark import catalog
from quillspark.operators import dedup
from tests.oracle import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, con, name):
    query, sql = catalog.queries()[name], catalog.oracle_sql().get(name)
    if sql is None:
        assert query(spark, SF).count() > 0
    else:
        assert compare(spark, con, SF, query, sql) is None


def test_dedup_greedy_keeps_sources_apart(spark, tmp_path):
    """Sources that are alike as names, null ones, texts without a title."""
    import duckdb

    sources = ["src1", "src11", "src11", "SRC1", None, None, "", "", "  ", "A b", "b a", "a", "a-b", "Ann Lee", "A. Lee", "ß", "ss", "日本", "日", "src1"]
    rows = [(i, "Red fish" if i % 2 else "fish, red\nmore", s) for i, s in enumerate(sources)]
    rows += [(100 + i, t, s) for i, (t, s) in enumerate((t, s) for t in (None, "", "!!!", "\nred fish") for s in ("src1", "src1", None, None))]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    own = duckdb.connect()
    own.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert compare(spark, own, str(tmp_path), catalog.queries()["dedup_greedy"], catalog.oracle_sql()["dedup_greedy"]) is None


def on(spark, tmp_path, name, texts):
    """A query on documents of these texts, compared with its SQL."""
    import duckdb

    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    own = duckdb.connect()
    own.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    return compare(spark, own, str(tmp_path), catalog.queries()[name], catalog.oracle_sql()[name])


@pytest.mark.parametrize("name", ["identify_citation_spans", "enhance_spans"])
def test_phones_are_no_citations(spark, tmp_path, name):
    """Telephone numbers in documents of one sentence don't outweigh its citations."""
    assert on(spark, tmp_path, name, ["T\nCall +1 (988) 555-2485", "T\nCall +1 (988) 555-2485 or (20) 555-1234 now.", "T\nOne +1 (1) 2 only.", "T", "T\n+1 (988) 555-2485 (988) 555-2485 (988) 555-2485"]) is None


def test_citation_groups(spark, tmp_path):
    """Marks, numbers and signs in gaps; texts don't travel with their spans."""
    assert on(spark, tmp_path, "citation_groups", ["", "a", "abc ... def _ ,,, ", None, "²  ½ é e\u0301 日本 🙂🙂🙂🙂 ۴ ... " * 9, "\u203f .,;:-" * 30, "word. " * 500]) is None
    assert "Exchange" not in catalog.queries()["citation_groups"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("years, authors", [(0, True), (0, False)])
def test_null_titles_stand_alone(spark, years, authors):
    papers = spark.createDataFrame([(1, None, 2000, ["Ann Lee"]), (2, None, 2000, ["Ann Lee"]), (3, "", 2000, ["Ann Lee"]), (4, "red", 2000, ["Ann Lee"]), (5, "Red", 2000, ["Ann Lee"])], "id bigint, title string, year int, authors array<string>")
    got = {r.id: r.representative for r in dedup.deduplicate(papers, 1.0, years, authors).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4}


def brute_sentences(text):
    """Character by character: . ! or ?, closing marks, blanks, then a capital, a digit or an opening mark."""
    out, first, i = [], 0, 0
    while i < len(text):
        if text[i] in ".!?":
            j = i + 1
            while j < len(text) and text[j] in "\"')]":
                j += 1
            k = j
            while k < len(text) and text[k].isspace():
                k += 1
            if j < k < len(text) and text[k] in "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789\"'([":
                out.append((first, k))
                first = k
        i += 1
    return [(a + len(p) - len(p.lstrip()), a + len(p.rstrip())) for a, b in [*out, (first, len(text))] if (p := text[a:b]).strip()]


def test_sentences(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {}
    for r in catalog.queries()["sentence_split"](spark, SF).collect():
        assert texts[r.doc_id][r.start : r.end] == r.sentence
        got.setdefault(r.doc_id, []).append((r.start, r.end))
    assert {d: sorted(x) for d, x in got.items()} == {d: x for d, t in texts.items() if (x := brute_sentences(t))}
    assert all("".join("".join(t[s:e] for s, e in sorted(got.get(d, []))).split()) == "".join(t.split()) for d, t in texts.items())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
