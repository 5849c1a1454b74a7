"""MinHash near-duplicate groups.

Each document becomes the set of its word 3-grams (one shorter gram if it has fewer words). `PERMS` multiply-add-shift
hashes (universal from 32 to 32 bits) give its minima, kept as their low 16 bits. Documents with equal signatures are
collapsed first; the others meet in `BANDS` bands. Every bucket is verified in full: two members are linked if their
signatures agree in a share of at least `threshold`. Members that a chain of links already joins needn't be compared
again, which leaves the components as they would be with all pairs. A bucket of at most `LIMIT` members is verified in
one worker. A larger one is dealt into chunks of that size, and in each round some LIMIT of its members, the leaders, go
to all chunks, where every member is compared with them; whoever is joined with the bucket's smallest member then needs
no further look, nor does a leader, and rounds go on until nobody else is left: of two members that are linked, either
one has been a leader or both hang on the smallest one. So no task holds more than 2 x LIMIT signatures, a bucket of true
copies takes one round whatever its size, and no link is lost; a bucket of n members that agree too little takes
n / LIMIT rounds. Links are joined to components by alternating large-star and small-star until nothing changes.

Defined results: a null or wordless text belongs to no group; a null doc_id is never grouped; ids are of any type that
can be ordered; rows that repeat a doc_id are one document, of which one row stays (the longest text, of equally long
ones that with the smallest hash); the smallest doc_id of a group stays; very long texts are signed whole; an empty table
gives an empty result; other columns, whatever their names, are ignored by `groups` and kept by `deduplicate`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import U64, Words, fresh, ids_only, mix, runs, text_slices, type_of, whole_groups, work_table

PERMS, BANDS, GRAM, THRESHOLD = 128, 32, 3, 0.5
_rng = np.random.default_rng(20240611)
_A = _rng.integers(0, 2**64, PERMS, dtype=U64) | U64(1)
_B = _rng.integers(0, 2**64, PERMS, dtype=U64)
LIMIT = 4096


def signatures(texts: pa.Array) -> np.ndarray:
    """PERMS minima (low 16 bits) of each text; rows of texts without words are meaningless."""
    w = Words(texts)
    out = np.zeros((len(texts), PERMS), np.uint16)
    has = np.flatnonzero(w.n > 0)
    if not len(has):
        return out
    n = np.maximum(w.n[has] - GRAM + 1, 1)
    first = np.concatenate([[0], np.cumsum(n)[:-1]])
    at = np.repeat(w.off[has] - first, n) + np.arange(n.sum())
    end = np.repeat(w.off[has + 1], n)
    g = np.zeros(len(at), U64)
    for k in range(GRAM):
        inside = at + k < end
        g = mix(g * U64(0x9E3779B97F4A7C15) + np.where(inside, w.h[np.minimum(at + k, len(w.h) - 1)], U64(k)))
    x = g >> U64(32)
    for i in range(PERMS):
        out[has, i] = (np.minimum.reduceat(x * _A[i] + _B[i], first) >> U64(32)).astype(np.uint16)
    return out


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo, hi in text_slices(b):
            part = b.slice(lo, hi - lo)
            sig = signatures(part.column("text"))
            bare = Words(part.column("text")).n == 0
            yield pa.record_batch({"doc_id": part.column("doc_id"), "sig": pa.array([None if e else s.tobytes() for s, e in zip(sig, bare, strict=True)], pa.binary())})


def linked(sig: np.ndarray, need: int, leader: np.ndarray | None = None, group: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the graph on rows of sig in which those are adjacent that agree in at least need places.

    With leader, only links with a leader at one end count. group says which rows are joined already; it is updated."""
    n = len(sig)
    group = np.arange(n) if group is None else group
    edges = []
    for i in range(n) if leader is None else np.flatnonzero(leader):
        # every other group is looked at, member by member, but for groups that i has joined already
        rest = np.arange(i) if leader is None else np.flatnonzero(group != group[i])
        while len(rest):
            block = rest[:4096]
            hit = block[(sig[block] == sig[i]).sum(axis=1) >= need]
            rest = rest[len(block) :]
            if not len(hit):
                continue
            while len(hit := hit[group[hit] != group[i]]):
                edges.append((int(i), int(hit[0])))
                group[group == group[hit[0]]] = group[i]
            rest = rest[group[rest] != group[i]]
    return edges


def _verify(need: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in whole_groups(batches, "bucket"):
            bucket = b.column("bucket").to_numpy()
            sig = np.frombuffer(b"".join(b.column("sig").to_pylist()), np.uint16).reshape(-1, PERMS)
            same = bucket[1:] == bucket[:-1]
            near = np.zeros(len(same), bool)
            for lo in range(0, len(same), 4096):
                near[lo : lo + 4096] = (sig[lo + 1 : lo + 4097] == sig[lo : lo + 4096][: len(sig) - lo - 1]).sum(axis=1) >= need
            first, end = runs(bucket)
            broken = np.concatenate([[0], np.cumsum(same & ~near)])
            bad = broken[np.maximum(end - 1, 0)] != broken[first]  # not all neighbours are linked: compare the others
            keep = np.flatnonzero(near & same & ~np.repeat(bad, end - first)[:-1])
            u, v = [keep + 1], [keep]
            for f, e in zip(first[bad], end[bad], strict=True):
                pairs = np.array(linked(sig[f:e], need) if e - f > 2 else [], np.int64).reshape(-1, 2) + f
                u.append(pairs[:, 0])
                v.append(pairs[:, 1])
            yield pa.record_batch({c: b.column("node").take(pa.array(np.concatenate(x))) for c, x in (("u", u), ("v", v))})

    return run


def _round(need: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links (v is set) of a chunk's members with the leaders, and the open members (v is null) that are left."""
        for b in whole_groups(batches, "place"):
            first, end = runs(b.column("place").to_numpy())
            for f, e in zip(first.tolist(), end.tolist(), strict=True):
                part = b.slice(f, e - f)
                leader, shut, anchor = (part.column(c).to_numpy(zero_copy_only=False) for c in ("leader", "shut", "anchor"))
                sig = np.frombuffer(b"".join(part.column("sig").to_pylist()), np.uint16).reshape(-1, PERMS)
                group = np.where(shut | anchor, -1, np.arange(e - f))  # the shut ones hang on the smallest member, which is in every chunk
                pairs = np.array(linked(sig, need, leader & ~shut, group), np.int64).reshape(-1, 2)
                left = np.flatnonzero((group != group[anchor.argmax()]) & ~leader)
                u, v = np.concatenate([pairs[:, 0], left]), np.concatenate([pairs[:, 1], np.full(len(left), -1)])
                node = part.column("node")
                yield pa.record_batch({"bucket": part.column("bucket").take(pa.array(u)), "u": node.take(pa.array(u)), "v": node.take(pa.array(np.where(v < 0, None, v), pa.int64()))})

    return run


def _large(members: DataFrame, need: int, limit: int) -> DataFrame:
    """Links (u, v) of buckets of more than limit members (bucket, size, least, node, sig)."""
    kind = type_of(members, "node")
    own = members.withColumn("chunks", F.ceil(F.col("size") / limit).cast("int"))
    own = work_table(own.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")), "large")
    links, turn = own.select(F.col("node").alias("u"), F.col("node").alias("v")).limit(0), 0
    left = own.select("bucket", "node")
    while True:
        waiting = left.groupBy("bucket").agg(F.count("*").alias("waiting"), F.min("node").alias("next"))
        # a hash picks some limit of those that wait, the smallest of them in any case
        chance = F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(1 << 30)) < F.lit(float(limit << 30)) / F.col("waiting")
        led = left.join(waiting, "bucket").where(chance | (F.col("node") == F.col("next"))).select("bucket", "node")
        state = own.join(left.withColumn("open", F.lit(True)), ["bucket", "node"], "left").join(led.withColumn("led", F.lit(True)), ["bucket", "node"], "left")
        anchor, leads = F.col("node") == F.col("least"), F.coalesce("led", F.lit(False))
        shut = F.col("open").isNull() & ~leads
        place = lambda chunk: F.xxhash64("bucket", chunk).alias("place")
        here = state.select(place("chunk"), "bucket", "node", "sig", leads.alias("leader"), shut.alias("shut"), anchor.alias("anchor"))
        guest = F.explode(F.filter(F.sequence(F.lit(0), F.col("chunks") - 1), lambda k: k != F.col("chunk"))).alias("at")
        sent = state.where(leads | anchor).select("bucket", "node", "sig", leads.alias("leader"), shut.alias("shut"), anchor.alias("anchor"), guest)
        sent = sent.select(place("at"), "bucket", "node", "sig", "leader", "shut", "anchor")
        placed = here.unionByName(sent).repartition("place").sortWithinPartitions("place", "node")
        out = work_table(placed.mapInArrow(_round(need), f"bucket bigint, u {kind}, v {kind}"), "round")
        links = links.unionByName(out.where("v is not null").select("u", "v"))
        left, turn = out.where("v is null").select("bucket", F.col("u").alias("node")), turn + 1
        if left.isEmpty():
            return links


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for edges (u, v): root is the smallest node of the component. Alternates large-star and small-star.

    Null ends are dropped; loops name a component of their own. Each round is written to the shared folder."""
    e = edges.where("u is not null and v is not null")
    nodes = e.select(F.col("u").alias("node")).union(e.select("v")).distinct()
    e = work_table(e.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    said = None
    while True:
        both = e.union(e.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        e = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small-star: u's smaller neighbours and u itself go to the smallest of them
        least = e.groupBy("u").agg(F.min("v").alias("m"))
        e = e.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least).where("u <> v").distinct()
        e = work_table(e, "edges")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == said:
            break
        said = now
    return nodes.join(e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")), "node", "left").select("node", F.coalesce("root", "node").alias("root"))


def links(one: DataFrame, threshold: float = THRESHOLD, limit: int = LIMIT) -> DataFrame:
    """(u, v) of (node, sig), whose signatures are distinct: links that leave the components as all links would."""
    band = F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1)))
    rows, need, kind = 2 * PERMS // BANDS, int(np.ceil(threshold * PERMS)), type_of(one, "node")
    each = one.select("node", band.alias("band"), "sig").select("node", F.xxhash64("band", F.expr(f"substring(sig, band * {rows} + 1, {rows})")).alias("bucket"))
    # of buckets with the same members, told by hashes over them, one is enough
    print_ = (F.count("*").alias("size"), F.bit_xor(F.xxhash64("node")).alias("a"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("b"))
    seen = each.groupBy("bucket").agg(*print_, F.min("node").alias("least")).where("size > 1")
    kept = work_table(seen.groupBy("size", "a", "b", "least").agg(F.min("bucket").alias("bucket")).drop("a", "b"), "buckets")
    # merged whatever the size, so that small inputs run and are measured by the plan of large ones
    members = work_table(each.join(kept.hint("merge"), "bucket"), "members").join(one, "node")
    near = members.where(F.col("size") <= limit).select("bucket", "node", "sig").repartition("bucket").sortWithinPartitions("bucket", "node").mapInArrow(_verify(need), f"u {kind}, v {kind}")
    if kept.where(F.col("size") > limit).isEmpty():
        return near
    return near.unionByName(_large(members.where(F.col("size") > limit), need, limit))


def groups(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, group_id, group_size, keep): a row for each row of docs that is in a group of two rows or more."""
    ids = ids_only(docs)
    signed = work_table(ids.where("doc_id is not null and text is not null").mapInArrow(_sign, f"doc_id {type_of(ids)}, sig binary").where("sig is not null"), "signatures")
    one = work_table(signed.groupBy("sig").agg(F.min("doc_id").alias("node")), "distinct")
    exact = work_table(signed.join(one, "sig").select("doc_id", "node"), "exact")
    # a doc_id that repeats with other texts has several signatures; it is one node all the same
    several = exact.groupBy("doc_id").agg(F.min("node").alias("v"), F.max("node").alias("most")).where("v <> most")
    again = exact.join(several, "doc_id").where("node <> v").select(F.col("node").alias("u"), "v").distinct()
    root = components(links(one, threshold).union(again).distinct())
    of = exact.join(root, "node", "left").select("doc_id", F.coalesce("root", "node").alias("group_id"))
    of = work_table(of.withColumn("row", F.monotonically_increasing_id()), "groups")
    sized = of.groupBy("group_id").agg(F.count("*").alias("group_size"), F.min(F.when(F.col("doc_id") == F.col("group_id"), F.col("row"))).alias("kept")).where("group_size > 1")
    return of.join(sized, "group_id").select("doc_id", "group_id", "group_size", (F.col("row") == F.col("kept")).alias("keep"))


def deduplicate(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs with one document of each group, its columns and order of columns unchanged."""
    gone, key, row = work_table(groups(docs, threshold).where("not keep").select("doc_id", "group_id"), "dropped"), fresh(docs, "gone"), fresh(docs, "row")
    same = F.col("doc_id") == F.col(key)
    left = docs.join(gone.where("doc_id <> group_id").select(F.col("doc_id").alias(key)).distinct(), same, "left_anti")
    again = gone.where("doc_id = group_id").select(F.col("doc_id").alias(key)).distinct()
    if again.isEmpty():
        return left
    # rows that repeat a kept doc_id: the first of them stays
    order = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.length("text").desc(), F.xxhash64("text")))
    return left.join(again, same, "left_anti").unionByName(left.join(again, same, "left_semi").withColumn(row, order).where(F.col(row) == 1).drop(row))
