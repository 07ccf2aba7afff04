"""SimHash near-duplicate detection with covering locality-sensitive hashing.

A text's fingerprint is the bitwise majority of the XXH64 hashes of its
four-word shingles. Two fingerprints are linked when they differ in at most
``radius`` bits. Candidates come from a covering family of bit masks: every bit
position i gets a nonzero vector m(i) in GF(2)^(radius+1), and there is a table
for every nonzero vector v that keeps the bits with <m(i), v> = 1. The vectors
of at most ``radius`` differing positions span less than the whole space, so
some v is orthogonal to all of them and its table drops exactly those bits: no
linked pair can be missed.

A bucket gives a spanning forest of its links, never its pairs. A bucket with
more than ``bucket_cap`` distinct fingerprints is dealt out again by a second
covering family inside the bucket; the two masks together leave so few free
bits that the size of a second bucket is bounded by a constant, and the same
argument makes it exact.

Defined results: a null text counts as empty and has fingerprint zero, which is
linked like any other; a null id takes part but is never a component's
smallest id unless all ids of the component are null; repeated rows are kept,
one result each; extra columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshwork.llm.common import cut, release, table, utf8, workers_import

BITS = 64
SHINGLE_WORDS = 4
RADIUS = 4
BUCKET_CAP = 4096

#: Bits set in each byte value, lowest first.
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_LANES = (np.arange(8, dtype=np.intp) * 256)[None, :]


def fingerprint(raw: bytes, words: int = SHINGLE_WORDS) -> int:
    """64-bit fingerprint of UTF-8 bytes."""
    import xxhash

    parts = raw.lower().split()  # bytes: lower-cases A-Z only, splits at \x20 and \x09-\x0D
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) < words:
        hashes = np.array([xxhash.xxh64_intdigest(joined, 42)], dtype=np.uint64)
    else:
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: len(parts) - words + 1].tolist()
        pieces = [joined[a:b] for a, b in zip(starts, ends[words - 1 :].tolist(), strict=True)]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(42)), np.uint64, len(pieces))
    lanes = hashes.astype("<u8").view(np.uint8).reshape(-1, 8) + _LANES
    counts = np.bincount(lanes.ravel(), minlength=2048).reshape(8, 256) @ _BYTE_BITS
    chosen = (counts.ravel() * 2 > len(hashes)).astype(np.uint8)
    return int.from_bytes(np.packbits(chosen, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """``id_col`` and ``fp`` (the fingerprint as a signed 64-bit integer)."""
    import pyarrow as pa

    workers_import(docs.sparkSession)

    def run(batches):
        for batch in batches:
            got = [fingerprint(x.as_buffer().to_pybytes(), words) for x in batch.column(1)]
            fp = pa.array(np.array(got, dtype=np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), fp], names=[id_col, "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, utf8(text_col).alias("raw")).mapInArrow(run, f"`{id_col}` {kind}, fp long")


def covering_masks(radius: int, order: list[int] | None = None, bits: int = BITS) -> list[int]:
    """The 2^(radius+1) - 1 masks of a covering family; ``order`` permutes the positions."""
    top = 2 ** (radius + 1) - 1
    vectors = [i % top + 1 for i in range(bits)]
    places = order or list(range(bits))
    return [sum(1 << places[i] for i, m in enumerate(vectors) if (m & v).bit_count() & 1) for v in range(1, top + 1)]


def second_family(radius: int, tries: int = 64) -> list[int]:
    """A permuted family that leaves few free bits together with any mask of the first."""
    first = covering_masks(radius)
    best: tuple[int, list[int]] | None = None
    for seed in range(tries):
        masks = covering_masks(radius, np.random.default_rng(seed).permutation(BITS).tolist())
        worst = max(BITS - (a | b).bit_count() for a in first for b in masks)
        if best is None or worst < best[0]:
            best = (worst, masks)
    return best[1]


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def bucket_links(members: np.ndarray, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(root, linked) arrays: a star for each connected component of more than one."""
    out, rest = [], members
    while len(rest) > 1:
        root, queue, rest = rest[0], [rest[0]], rest[1:]
        while queue and len(rest):
            near = np.bitwise_count(rest ^ queue.pop()) <= radius
            if near.any():
                hits = rest[near]
                out.append((np.full(len(hits), root), hits))
                queue.extend(hits)
                rest = rest[~near]
    return out


def _links_in_buckets(rows: DataFrame, keys: list[str], radius: int, cap: int | None) -> DataFrame:
    """rows: ``keys`` and ``fp``. Gives (over, a, b, *keys): links of small
    buckets, and the members of buckets over ``cap`` with ``over`` true."""
    import pyarrow as pa

    names = ["over", "a", "b", *keys]

    def frame(over, a, b, key):
        n = len(a)
        return pa.RecordBatch.from_arrays([pa.array([over] * n, pa.bool_()), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), *(pa.array(np.full(n, k, np.int64)) for k in key)], names=names)

    def handle(key, parts):
        members = np.unique(np.concatenate(parts))
        if len(members) < 2:
            return
        for root, hits in bucket_links(members, radius):
            yield frame(False, hits, root, key)

    def run(batches):
        open_key, parts, size, over = None, [], 0, False
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(i).to_numpy() for i in range(len(keys))]
            fps = batch.column(len(keys)).to_numpy().view(np.uint64)
            change = np.zeros(len(fps), bool)
            for c in cols:
                change[1:] |= c[1:] != c[:-1]
            starts = np.concatenate([[0], np.flatnonzero(change)])
            ends = np.append(starts[1:], len(fps))
            # runs of one row inside a batch can't link
            inner = (ends - starts > 1) | (starts == 0) | (ends == len(fps))
            for s, e in zip(starts[inner].tolist(), ends[inner].tolist(), strict=True):
                key = tuple(int(c[s]) for c in cols)
                if key != open_key:
                    if open_key is not None and not over:
                        yield from handle(open_key, parts)
                    open_key, parts, size, over = key, [], 0, False
                parts.append(fps[s:e])
                size += e - s
                if over or (cap and size > cap):
                    for p in parts:
                        yield frame(True, p, p, key)
                    parts, over = [], True
        if open_key is not None and not over:
            yield from handle(open_key, parts)

    spec = ", ".join(["over boolean, a long, b long", *(f"{k} long" for k in keys)])
    dealt = rows.select(*keys, "fp").repartition(*keys).sortWithinPartitions(*keys, "fp")
    return dealt.mapInArrow(run, spec)


def links(distinct: DataFrame, radius: int = RADIUS, bucket_cap: int = BUCKET_CAP) -> DataFrame:
    """Links ``a`` > ``b`` between distinct fingerprints (column ``fp``).

    Their connected components are those of all pairs within ``radius``.
    """
    first = [_signed(m) for m in covering_masks(radius)]
    tables = F.array(*(F.struct(F.lit(v).cast("long").alias("v"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for v, m in enumerate(first)))
    dealt = distinct.select("fp", F.explode(tables).alias("t")).select("t.v", "t.key", "fp")
    found = cut(_links_in_buckets(dealt, ["v", "key"], radius, bucket_cap))
    edges = found.where(~F.col("over")).select("a", "b")
    if found.where("over").limit(1).count():
        second = [_signed(m) for m in second_family(radius)]
        again = F.array(*(F.struct(F.lit(w).cast("long").alias("w"), F.col("a").bitwiseAND(F.lit(m)).alias("more")) for w, m in enumerate(second)))
        deeper = found.where("over").select("v", "key", F.col("a").alias("fp"), F.explode(again).alias("t")).select("v", "key", "t.w", "t.more", "fp")
        edges = edges.unionByName(_links_in_buckets(deeper, ["v", "key", "w", "more"], radius, None).select("a", "b"))
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()


#: Edges up to which one task finds the components (16 bytes each).
TOGETHER = 1 << 17
#: A key with one in so many rows or more is hot: there are at most as many such keys.
HOT = 1000


def beside(rows: DataFrame, small: DataFrame, key: str, total: int, fits: F.Column | None = None) -> DataFrame:
    """Inner join with ``small``, which has a row for each key and the number ``n`` of the
    key's rows, of ``total`` in all. Hot keys, at most ``HOT``, come by broadcast, so that no
    task gets all rows of a key; the rest is shuffled. fits: whether a row of ``small`` is
    of bounded size, where its columns don't say so."""
    hot = F.col("n") * HOT >= total
    hot = hot if fits is None else hot & fits
    often = F.broadcast(small.where(hot))
    rest = rows.join(often.select(key), key, "left_anti")
    return rows.join(often, key).unionByName(rest.join(small.where(~hot), key))


def _star_steps(edges: DataFrame, total: int) -> DataFrame:
    """A large-star and a small-star step over ``total`` edges."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    low = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
    large = cut(beside(both, low, "u", 2 * total).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())
    low = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
    rest = beside(large, low, "a", large.count()).where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return cut(rest.union(low.select("a", "m")).distinct())


def lowest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, roots) of the edges' nodes but the roots."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while len(apart := np.flatnonzero(root[x] != root[y])):
        x, y = x[apart], y[apart]
        low = np.minimum(root[x], root[y])
        for end in (root[x], root[y]):
            np.minimum.at(root, end, low)
        while (root[root] != root).any():
            root = root[root]
    below = root != np.arange(len(nodes))
    return nodes[below], nodes[root[below]]


def _united(edges: DataFrame) -> DataFrame:
    """The components of a bounded number of edges, in one task."""
    import pyarrow as pa

    def run(batches):
        parts = [(batch.column(0).to_numpy(), batch.column(1).to_numpy()) for batch in batches if batch.num_rows]
        if parts:
            found = lowest(*(np.concatenate(x) for x in zip(*parts, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["node", "root"])

    workers_import(edges.sparkSession)
    return cut(edges.select("a", "b").coalesce(1).mapInArrow(run, "node long, root long"))


def components(edges: DataFrame, total: int | None = None) -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b) but the roots: the root is
    its component's smallest node. Alternates large-star and small-star steps,
    both made of aggregates and joins, until the edges no longer change. The files of a
    step are released after the next one. Up to ``TOGETHER`` edges one task gives the
    same, as a step costs many small files however few the edges. total: the number of
    rows of ``edges``, if it is known; up to ``TOGETHER`` they needn't be told apart first."""
    if total is not None and total <= TOGETHER:
        return _united(edges)
    edges = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct())
    before = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if 0 < now[0] <= TOGETHER:
            return _united(edges)
        if now == before or not now[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
        edges = _star_steps(edges, now[0])
        release(edges.sparkSession)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, words: int = SHINGLE_WORDS, bucket_cap: int = BUCKET_CAP) -> DataFrame:
    """``id_col``, ``fp``, ``component_id``: the smallest id reachable over links."""
    own = cut(fingerprints(docs, id_col, text_col, words))
    distinct = cut(own.groupBy("fp").agg(F.min(id_col).alias("low"), F.count("*").alias("n")))
    total = distinct.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    stars = components(links(distinct, radius, bucket_cap))
    members = stars.union(stars.select(F.col("root").alias("node"), "root").distinct())
    lows = members.join(distinct, members.node == distinct.fp).select("node", "root", "low")
    best = lows.groupBy("root").agg(F.min("low").alias("best"), F.count("*").alias("n"))
    found = beside(lows, best, "root", total).select("node", "best")
    classes = cut(distinct.join(found, distinct.fp == found.node, "left").select("fp", F.coalesce("best", "low").alias("component_id"), "n"))
    return beside(own, classes, "fp", total).select(id_col, "fp", "component_id")


def hex16(fp: str) -> F.Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex16("fp").alias("fingerprint"), "component_id")
