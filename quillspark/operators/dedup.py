"""De-duplication of papers by matches with other papers."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions import text as T
from quillspark.operators.search import candidates
from quillspark.session import reliable


def by_title(df: DataFrame) -> DataFrame:
    """(id, representative) of (id, title): the least id with the same word set; rows without words stand for themselves."""
    t = T.token_set(F.col("title"))
    w = Window.partitionBy("__t")
    return df.select("id", t.alias("__t")).select("id", F.when(F.size("__t") > 0, F.min("id").over(w)).otherwise(F.col("id")).alias("representative"))


def components(edges: DataFrame, tag: str = "component", root: str | None = None) -> DataFrame:
    """(node, root) of (u, v): the least node that is reached, by minimum propagation with pointer jumping.

    Each round is a reliable checkpoint in the shared folder."""
    both = reliable(edges.select("u", "v").union(edges.select("v", "u")).distinct())
    label = reliable(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m")).select("node", F.least("node", "m").alias("root")))
    while True:
        near = both.join(label.select(F.col("node").alias("v"), F.col("root").alias("r")), "v").groupBy(F.col("u").alias("node")).agg(F.min("r").alias("r"))
        step = label.join(near, "node").select("node", "root", F.least("root", "r").alias("new"))
        jump = label.select(F.col("node").alias("new"), F.col("root").alias("over"))
        step = reliable(step.join(jump, "new", "left").select("node", "root", F.least("new", F.coalesce("over", "new")).alias("new")))
        changed = step.where("root <> new").isEmpty()
        label = step.select("node", F.col("new").alias("root"))
        if changed:
            return label


def greedy(order: list, best: dict, near: dict) -> dict:
    """Paper -> representative. Papers are gone through in order; best has each one's best match, near all its matches,
    best first.

    A paper without a match stands for itself. Where the paper has a representative, its match takes it over; where only
    the match has one, the paper does. If neither has, both go to the best matching one of the representatives that were
    set up so before, or the paper becomes one, for both."""
    of: dict = {}
    heads: set = set()
    for x in order:
        y = best.get(x)
        if y is None:
            of[x] = x
        elif x in of:
            of[y] = of[x]
        elif y in of:
            of[x] = of[y]
        else:
            head = next((h for h in near[x] if h in heads), None)
            if head is None:
                heads.add(x)
                head = x
            of[x] = of[y] = head
    return of


def _greedy(g: pd.DataFrame) -> pd.DataFrame:
    near: dict = {}
    for u, v, _ in sorted(zip(g.u, g.v, g.score, strict=True), key=lambda r: (r[0], -r[2], r[1])):
        near.setdefault(u, []).append(v)
    of = greedy(sorted({*near, *g.v}), {u: x[0] for u, x in near.items()}, near)
    return pd.DataFrame({"id": list(of), "representative": list(of.values())})


def deduplicate(papers: DataFrame, threshold: float = 1.0, max_year_diff: int = 0, match_authors: bool = True) -> DataFrame:
    """(id, representative) for papers (id, title, year, authors).

    Papers with the same words in the title, the same year and the same authors' words are one: the least id stands for
    them and is looked at in their place, so copies never meet each other. The others are searched among each other;
    matches form components, in each of which papers are gone through in order of id (see greedy)."""
    names = F.coalesce("authors", F.array().cast("array<string>"))
    keyed = papers.select("id", "title", "year", "authors", T.token_set(F.col("title")).alias("__t"), F.array_sort(F.array_distinct(T.author_sets(names))).alias("__a"))
    alone = (F.coalesce(F.size("__t"), F.lit(0)) < 1) | (F.size("__a") == 0 if match_authors else F.lit(False))
    keyed = keyed.withColumn("__own", F.when(alone, F.col("id")))
    parts = ("__t", F.coalesce("year", F.lit(-(1 << 31))), "__a", F.coalesce(F.col("__own").cast("string"), F.lit("")))
    keyed = keyed.withColumn("__k", F.struct(F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit(1), *parts).alias("b")))
    first = reliable(keyed.groupBy("__k").agg(F.min(F.struct("id", "title", "year", "authors")).alias("r")))  # read five times
    one = first.select("r.*")
    own = one.select(F.col("id").alias("probe_id"), "title", "year", "authors")
    pairs = candidates(own, one, threshold, max_year_diff, match_authors).where("probe_id <> id").select(F.col("probe_id").alias("u"), F.col("id").alias("v"), "score")
    pairs = reliable(pairs)
    root = components(pairs.select("u", "v"))
    grouped = pairs.join(root.withColumnRenamed("node", "u"), "u").groupBy("root").applyInPandas(_greedy, "id bigint, representative bigint")
    of = keyed.select("id", "__k").join(first.select("__k", F.col("r.id").alias("first")), "__k").select("id", "first")
    return of.join(grouped.withColumnRenamed("id", "first"), "first", "left").select("id", F.coalesce("representative", "first").alias("representative"))
