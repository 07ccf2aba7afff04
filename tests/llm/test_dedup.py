"""SimHash against all pairs, the exact de-duplication against SQL, the chain of links."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from meshwork.llm import exact_dedup, simhash
from tests.conftest import SF


def slow_fingerprint(text):
    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    parts = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)] if words else []
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def slow_components(points, radius=4):
    """Smallest id reachable, for (id, fingerprint) rows."""
    up = {i: i for i, _ in points}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for n, (i, a) in enumerate(points):
        for j, b in points[n + 1 :]:
            if (a ^ b).bit_count() <= radius:
                x, y = top(i), top(j)
                up[max(x, y)] = min(x, y)
    return {i: top(i) for i in up}


def test_query_equals_all_pairs(spark):
    got = {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in simhash.op1_simhash(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    points = [(r[0], slow_fingerprint(r[1])) for r in docs]
    assert {i: v[0] for i, v in got.items()} == dict(points)
    assert {i: v[1] for i, v in got.items()} == slow_components(points)


def test_every_pair_within_the_radius_meets_in_a_table():
    rng = random.Random(3)
    for masks in (simhash.covering_masks(4), simhash.second_family(4)):
        for _ in range(3000):
            flips = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4)))
            assert any(flips & m == 0 for m in masks)


@pytest.mark.parametrize("cap", [4096, 6])
def test_dense_groups_with_and_without_the_second_family(spark, cap):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(6)]
    fps = {b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 5))) for b in base for _ in range(25)} | {rng.getrandbits(64) for _ in range(50)} | {0}
    points = list(enumerate(sorted(fps)))
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for _, f in points], "fp long")
    stars = {r["node"]: r["root"] for r in simhash.components(simhash.links(df, 4, cap)).collect()}
    signed = {i: int(np.uint64(f).astype(np.int64)) for i, f in points}
    want = slow_components(points)
    group = lambda key: sorted(sorted(v) for v in key.values())
    a, b = {}, {}
    for i, _ in points:
        a.setdefault(want[i], []).append(i)
        b.setdefault(stars.get(signed[i], signed[i]), []).append(i)
    assert group(a) == group(b)


def test_components_of_a_long_chain(spark):
    edges = spark.range(60).select((F.col("id") + 1).alias("a"), F.col("id").alias("b"))
    assert {tuple(r) for r in simhash.components(edges).collect()} == {(i, 0) for i in range(1, 61)}
    assert simhash.components(edges.limit(0)).count() == 0


def test_exact_query_equals_sql(spark, duck):
    got = sorted(map(tuple, exact_dedup.op8_exact_dedup(spark, SF).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()))
    assert got == sorted(duck.sql(f"SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM ({exact_dedup.OP8_SQL})").fetchall())


def test_groups_over_many_partitions(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 4 != 0, F.lit("Same TEXT")).otherwise(F.concat(F.lit("own "), F.col("id").cast("string"))).alias("text"))
    for keep, want in (("smallest", 1), ("largest", 399)):
        got = exact_dedup.exact_duplicates(docs, keep=keep, partitions=7).collect()
        assert all(r["keep_id"] == (want if r["doc_id"] % 4 else r["doc_id"]) and r["group_size"] == (300 if r["doc_id"] % 4 else 1) for r in got)
        assert sum(r["kept"] for r in got) == 101


def test_stitching_runs_over_several_partitions():
    edges = [(0, 1, 0, 2, 1, 2), (0, 2, 1, 3, 5, 9), (1, 3, 0, 4, 3, 4), (2, 1, 0, 1, 0, 0), (2, 2, 1, 1, 8, 8)]
    got = {(r[0], r[1]): r[2:] for r in exact_dedup.stitch(edges, {1, 2})}
    assert got[0, 1] == got[1, 0] == got[2, 0] == (8, 0, 9) and got[0, 0] == (2, 1, 2) and got[2, 1] == (1, 8, 8)
