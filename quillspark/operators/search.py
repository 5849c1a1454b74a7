"""Fuzzy joins of papers: an exact set-similarity join by prefix filtering, year band and author match, best match.

With a = |A|, b = |B| and the score S (harmonic mean of Jaccard and containment), S >= t needs an overlap of at least
o(a) = ceil(t a / (2 - t)); so two matching sets share one of the first a - o(a) + 1 (b - o(b) + 1) words when words are
ordered by rarity (see setjoin). Rows are collapsed to distinct word sets first; equal titles meet only once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions import similarity as M
from quillspark.functions import text as T
from quillspark.operators.setjoin import matches

THRESHOLD, MAX_YEAR_DIFF, K = 0.75, 0, 100


def _hashed(a: str) -> list[Column]:
    """id and w of an array of distinct words: its hash, and those of its words."""
    return [F.xxhash64(a).alias("id"), F.transform(a, lambda x: F.xxhash64(x)).alias("w")]


def _first(sets: DataFrame) -> DataFrame:
    return sets.groupBy("id").agg(F.first("w").alias("w"))


def similar_sets(left: DataFrame, right: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(a, b, score) of distinct sorted word sets, columns `a` and `b` (arrays), with score >= threshold.

    Exact. At threshold 1 it is an equi join."""
    if threshold >= 1.0:
        return left.join(right, F.col("a") == F.col("b")).where("size(a) > 0").withColumn("score", F.lit(1.0))
    met = matches(_first(left.select(*_hashed("a"))), _first(right.select(*_hashed("b"))), threshold)
    return met.join(left.select("a", F.xxhash64("a").alias("l")), "l").join(right.select("b", F.xxhash64("b").alias("r")), "r").select("a", "b", "score")


def similarity_join(left: DataFrame, right: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(left_id, right_id, score) for (left_id, title) and (right_id, title). Only hashes of titles' words are shuffled."""
    la, rb = left.withColumn("a", T.token_set(F.col("title"))), right.withColumn("b", T.token_set(F.col("title")))
    if threshold >= 1.0:
        return la.select("left_id", "a").join(rb.select("right_id", "b"), F.col("a") == F.col("b")).where("size(a) > 0").select("left_id", "right_id", F.lit(1.0).alias("score"))
    met = matches(_first(la.select(*_hashed("a"))), _first(rb.select(*_hashed("b"))), threshold)
    return met.join(la.select("left_id", F.xxhash64("a").alias("l")), "l").join(rb.select("right_id", F.xxhash64("b").alias("r")), "r").select("left_id", "right_id", "score")


def similar_pairs(classes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(u, v, score), u < v, of (class_id, a): distinct sorted word sets with a score of at least threshold. Exact."""
    if threshold >= 1.0:
        return classes.select(F.col("class_id").alias("u"), F.col("class_id").alias("v"), F.lit(1.0).alias("score")).limit(0)
    return matches(classes.select(F.col("class_id").alias("id"), _hashed("a")[1]), None, threshold).toDF("u", "v", "score")


def title_classes(df: DataFrame) -> DataFrame:
    """(id, class_id, a) of (id, title): class_id is the least id with the same word set a; without words, one's own."""
    own = df.select("id", T.token_set(F.col("title")).alias("a"))
    first = own.where("size(a) > 0").groupBy("a").agg(F.min("id").alias("class_id"))
    return own.where("size(a) > 0").join(first, "a").select("id", "class_id", "a").unionByName(own.where("size(a) = 0 or a is null").select("id", F.col("id").alias("class_id"), "a"))


def self_similarity_join(df: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Members (id, class_id) of (id, title), and pairs (u, v, score) of class_ids with u < v: two ids match if they are of
    one class that has words, or of two that are a pair. Copies are never expanded into pairs."""
    classes = title_classes(df)
    return classes.select("id", "class_id"), similar_pairs(classes.where("id = class_id").select("class_id", "a"), threshold)


def similarity_links(df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(id, class_id, class_size, n_links): how many other ids each one matches, in its class and beyond. A row for each row."""
    classes = title_classes(df)
    size = classes.groupBy("class_id").agg(F.count("*").alias("class_size"))
    pairs = similar_pairs(classes.where("id = class_id").select("class_id", "a").dropDuplicates(["class_id"]), threshold)
    each = pairs.select("u", "v").union(pairs.select("v", "u"))
    beyond = each.join(size.select(F.col("class_id").alias("v"), F.col("class_size").alias("k")), "v").groupBy(F.col("u").alias("class_id")).agg(F.sum("k").alias("beyond"))
    full = size.join(beyond, "class_id", "left")
    return classes.join(full, "class_id").select("id", "class_id", "class_size", (F.when(F.size("a") > 0, F.col("class_size") - 1).otherwise(0) + F.coalesce("beyond", F.lit(0))).alias("n_links"))


def years_compatible(a: Column, b: Column, d: int) -> Column:
    return a.isNull() | b.isNull() | (F.abs(a - b) <= d)


#: Pairs that a task of band_join compares, about.
PAIRS = 20_000_000


def band_join(p: DataFrame, q: DataFrame, by: str, py: str, qy: str, d: int) -> DataFrame:
    """All pairs of rows of p and q that agree in `by` and whose years are compatible; columns of both, `by` once.

    A key has pairs without number, so its rows of p are parted by year and by chance, those of q are copied to each part,
    and there are as many tasks as the pairs need, whatever few bytes the tables have."""
    n = lambda df, c: df.groupBy(by).agg(F.count("*").alias(c))
    keys, pairs = n(p, "__a").join(n(q, "__b"), by).agg(F.count("*"), F.coalesce(F.sum(F.col("__a") * F.col("__b")), F.lit(0))).first()
    tasks = int(min(20_000, max(1, pairs // PAIRS + 1)))
    parts = int(min(256, -(-4 * tasks // max(1, keys))))
    p = p.withColumn("__s", F.pmod(F.xxhash64(*[F.col(c) for c in p.columns]), F.lit(parts)).cast("int"))
    q = q.withColumn("__s", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def met(a: DataFrame, b: DataFrame, *on: str) -> DataFrame:
        keys = [by, "__s", *on]
        return a.repartition(tasks, *keys).join(b.repartition(tasks, *keys).hint("shuffle_hash"), keys).drop("__s", *on)

    near = q.where(F.col(qy).isNotNull()).withColumn("__y", F.explode(F.sequence(F.col(qy).cast("bigint") - d, F.col(qy).cast("bigint") + d)))
    dated = met(p.where(F.col(py).isNotNull()).withColumn("__y", F.col(py).cast("bigint")), near, "__y")
    return dated.unionByName(met(p, q.where(F.col(qy).isNull()))).unionByName(met(p.where(F.col(py).isNull()), q.where(F.col(qy).isNotNull())))


#: Lengths on which titles and their beginnings meet: a beginning on the largest that it has.
CUTS = (*range(1, 13), 16, 24, 32, 48, 64, 96, 128, 192, 256)


def prefix_candidates(probes: DataFrame, papers: DataFrame, k: int = K) -> DataFrame:
    """(probe_id, id): at most k papers whose normal title begins with the probe's, smallest id first.

    Equal probes meet papers once, and of each one's papers a partition passes on the first k only."""
    p = probes.select("probe_id", T.normalize_string(F.col("title")).alias("pt")).where("pt <> ''")
    cut = F.array_max(F.filter(F.array(*map(F.lit, CUTS)), lambda c: c <= F.length("pt"))).alias("cut")
    q = p.select("pt").distinct().select("pt", cut)
    used = q.groupBy("cut").agg(F.max(F.length("pt")).alias("n")).collect()
    longest, cuts = max([r["n"] for r in used], default=1), sorted(r["cut"] for r in used)
    t = papers.select("id", F.left(T.normalize_string(F.col("title")), F.lit(longest)).alias("tt")).where("tt <> ''")
    each = t.select("id", "tt", F.explode(F.filter(F.array(*map(F.lit, cuts)).cast("array<int>"), lambda c: c <= F.length("tt"))).alias("cut"))
    met = each.withColumn("key", F.left("tt", F.col("cut"))).join(q.withColumn("key", F.left("pt", F.col("cut"))), ["cut", "key"]).where(F.startswith("tt", "pt"))
    w = Window.partitionBy("pt").orderBy("id")
    best = met.select("pt", "id").withColumn("r", F.row_number().over(w)).where(F.col("r") <= k).groupBy("pt").agg(F.collect_list("id").alias("ids"))
    return p.join(best, "pt").select("probe_id", F.explode("ids").alias("id"))


def _with_names(df: DataFrame, p: str) -> DataFrame:
    names = F.coalesce("authors", F.array().cast("array<string>"))
    return df.withColumn(f"{p}f", T.author_sets(names)).withColumn(f"{p}i", T.author_initials(names))


def candidates(
    probes: DataFrame, papers: DataFrame, threshold: float = THRESHOLD, max_year_diff: int = MAX_YEAR_DIFF, match_authors: bool = True,
    author_threshold: float = 1.0, fulltext: bool = False, exclude: DataFrame | None = None, k: int = K,
) -> DataFrame:
    """(probe_id, id, score): all papers that search() chooses from."""
    pr, pa = probes.select("probe_id", "title", "year", "authors"), papers.select("id", "title", "year", "authors")
    cand = similarity_join(pr.select(F.col("probe_id").alias("left_id"), "title"), pa.select(F.col("id").alias("right_id"), "title"), threshold).select(F.col("left_id").alias("probe_id"), F.col("right_id").alias("id"), "score")
    if fulltext:
        hits = prefix_candidates(pr, pa, k)
        both = hits.join(pr.select("probe_id", F.col("title").alias("pt")), "probe_id").join(pa.select("id", F.col("title").alias("tt")), "id")
        scored = both.select("probe_id", "id", M.similarity(T.token_set(F.col("pt")), T.token_set(F.col("tt"))).alias("score"))
        cand = scored.where(F.col("score") >= threshold).unionByName(cand.join(hits.select("probe_id").distinct(), "probe_id", "left_anti"))
    if exclude is not None:
        cand = cand.join(exclude, ["probe_id", "id"], "left_anti")
    names = lambda df, p: _with_names(df, p).drop("authors") if match_authors else df.drop("authors")
    cand = cand.join(names(pr.drop("title").withColumnRenamed("year", "py"), "p"), "probe_id").join(names(pa.drop("title").withColumnRenamed("year", "qy"), "q"), "id")
    cand = cand.where(years_compatible(F.col("py"), F.col("qy"), max_year_diff))
    if match_authors:
        cand = cand.where(M.match_author_groups(F.col("pf"), F.col("pi"), F.col("qf"), F.col("qi"), author_threshold))
    return cand.select("probe_id", "id", "score")


def search(probes: DataFrame, papers: DataFrame, *args, **how) -> DataFrame:
    """The best paper (id, title, year, authors) for each probe (probe_id, title, year, authors): (probe_id, id, score).

    Every probe gives a row, with null id if nothing matches. Candidates have a title score of at least `threshold`,
    compatible years and, unless match_authors is off, a matching author; the highest score wins, then the least id.
    With fulltext, papers whose titles begin with the probe's replace other candidates. exclude: (probe_id, id) pairs."""
    best = candidates(probes, papers, *args, **how).groupBy("probe_id").agg(F.max_by(F.struct("id", "score"), F.struct("score", -F.col("id"))).alias("b"))
    return probes.select("probe_id").join(best.select("probe_id", "b.*"), "probe_id", "left")


def to_mapping(matches: DataFrame) -> DataFrame:
    """(probe_id, id) of the probes that were found."""
    return matches.where("id is not null").select("probe_id", "id")


def inverse_mapping(matches: DataFrame) -> DataFrame:
    """(id, probe_id): the last probe that was matched to each paper."""
    return matches.where("id is not null").groupBy("id").agg(F.max("probe_id").alias("probe_id"))


def last_at_or_before(points: DataFrame, marks: DataFrame, by: list[str], at: str, mark_at: str, value: str) -> DataFrame:
    """points with the value of the last mark (by mark_at, value) at or before each, per `by`; null if none. One shuffle."""
    tagged = points.withColumn("__m", F.lit(None).cast(marks.schema[value].dataType)).withColumn("__at", F.col(at)).withColumn("__k", F.lit(1))
    own = marks.select(*by, F.col(value).alias("__m"), F.col(mark_at).alias("__at")).withColumn("__k", F.lit(0))
    w = Window.partitionBy(*by).orderBy("__at", "__k", "__m").rowsBetween(Window.unboundedPreceding, 0)
    return tagged.unionByName(own, allowMissingColumns=True).withColumn(value, F.last("__m", ignorenulls=True).over(w)).where("__k = 1").drop("__m", "__at", "__k")


def overlapping(a: DataFrame, b: DataFrame, by: list[str], start: str = "start", end: str = "end", width: int = 256) -> DataFrame:
    """Pairs of half-open spans of one key that overlap: `by`, a's columns prefixed a_, b's prefixed b_.

    Spans meet in buckets of `width` characters; a pair is kept in the bucket where the later of its starts lies."""

    def side(df: DataFrame, p: str) -> DataFrame:
        own = df.select(*by, *[F.col(c).alias(p + c) for c in df.columns if c not in by])
        return own.where(F.col(p + start) < F.col(p + end)).withColumn("__cell", F.explode(F.sequence(F.floor(F.col(p + start) / width), F.floor((F.col(p + end) - 1) / width))))

    met = side(a, "a_").join(side(b, "b_"), [*by, "__cell"])
    late = F.greatest(F.col("a_" + start), F.col("b_" + start))
    return met.where((F.col("a_" + start) < F.col("b_" + end)) & (F.col("b_" + start) < F.col("a_" + end)) & (F.floor(late / width) == F.col("__cell"))).drop("__cell")


def with_references(papers: DataFrame) -> DataFrame:
    """(id, reference_id) of (id, references) whose reference is itself a paper."""
    each = papers.select("id", F.explode("references").alias("reference_id"))
    return each.join(papers.select(F.col("id").alias("reference_id")).distinct(), "reference_id", "left_semi").select("id", "reference_id")


def identify_references(bib: DataFrame, papers: DataFrame, **how) -> DataFrame:
    """(doc_id, ids): for each document the papers its bibliography (doc_id, pos, title, year, authors) refers to, in order, null if unknown."""
    probes = bib.withColumn("probe_id", F.struct("doc_id", "pos"))
    found = search(probes, papers, **how)
    ordered = F.array_sort(F.collect_list(F.struct(F.col("probe_id.pos").alias("pos"), "id")))
    return found.groupBy(F.col("probe_id.doc_id").alias("doc_id")).agg(F.transform(ordered, lambda x: x["id"]).alias("ids"))


def mag_mapping(papers: DataFrame, mag: DataFrame, **how) -> DataFrame:
    """(id, mag_id): a known mag_id that exists in mag, else the best match."""
    known = papers.where("mag_id is not null").select("id", "mag_id").join(mag.select(F.col("id").alias("mag_id")), "mag_id", "left_semi")
    rest = papers.join(known.select("id"), "id", "left_anti").withColumnRenamed("id", "probe_id")
    return known.select("id", "mag_id").unionByName(search(rest, mag, **how).select(F.col("probe_id").alias("id"), F.col("id").alias("mag_id")))
