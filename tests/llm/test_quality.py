"""Importance resampling against a slow version: weights, cut, keys and what stays."""

import math
import random
import tracemalloc
from collections import Counter
from fractions import Fraction
from functools import cache
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from meshwork.llm import ngrams, quality
from tests.conftest import SF

SF01 = "/root/testdata/sf0.01"
BITS = 10


def fold(i):
    return crc32(str(i).encode()) % 4


@cache
def bucket(gram, bits):
    code = int.from_bytes(gram, "big") * 0xC2B2AE3D % 2**32
    return ((code ^ code >> 15) * 0x2C1B3C6D % 2**32) >> (32 - bits)


def grams(text, bits):
    """Buckets of the trigrams of one text, and whether each word repeats the one before."""
    raw = f" {text or ''} ".encode()
    words = [w for w in bytes(b if b > 32 else 32 for b in raw).split(b" ") if w]
    return [("gram", bucket(raw[i : i + 3], bits)) for i in range(len(raw) - 2)] + [("word", int(a == b)) for a, b in zip(words, [None, *words], strict=False)]


def slow_weights(docs, good, bits=BITS):
    """log weight by id: docs {id: text}; good: ids labelled 1."""
    found = {i: grams(t, bits) for i, t in docs.items()}
    raw, target = Counter(), Counter()
    for i, g in found.items():
        raw.update(g)
        if i in good and fold(i) not in (2, 3):
            target.update(g)
    size = {"gram": 1 << bits, "word": 2}
    whole = {id(c): {k: sum(n for (x, _), n in c.items() if x == k) for k in size} for c in (raw, target)}

    def log_p(counted, g):
        return math.log((counted[g] + 0.5) / (whole[id(counted)][g[0]] + 0.5 * size[g[0]]))

    units = {g: round((log_p(target, g) - log_p(raw, g)) * quality.UNIT) for g in raw}
    return {i: 100.0 * (sum(units[x] for x in g) / quality.UNIT) / (len(g) + quality.SHRINK) for i, g in found.items()}


def some_texts(n, seed=3):
    rng = random.Random(seed)
    return {i: " ".join(rng.choice(["good", "words", "are", "here", "bad!!", "x", "ça", "日本"]) for _ in range(rng.choice([0, 1, 5, 30]))) + rng.choice(["", " ", "\n"]) for i in range(n)} | {n: None, n + 1: "rep rep rep", n + 2: "rep rep rep"}


def test_weights_equal_a_slow_count_in_any_batches(spark):
    texts = some_texts(120)
    good = {i for i in range(0, 120, 2)}
    labels = spark.createDataFrame([(i, int(i in good)) for i in range(100)] + [(None, 1)], "doc_id long, quality int")
    rows = list(texts.items())
    seen = []
    for parts in (1, 3, 7):
        random.Random(parts).shuffle(rows)
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        model = quality.fit(docs, labels, bits=BITS)
        seen.append({r["doc_id"]: r["log_weight"] for r in quality.resample(docs, model).collect()})
    want = slow_weights(texts, {i for i in good if i < 100})
    assert seen[0] == seen[1] == seen[2]  # to the last bit
    for i, w in want.items():
        assert seen[0][i] == pytest.approx(w, abs=1e-5)
    assert seen[0][121] == seen[0][122] and seen[0][120] == 0.0
    assert all(v == 0.0 for i, v in seen[0].items() if not texts[i])


def test_what_stays_equals_a_slow_version(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    good = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    weights = slow_weights(texts, good, quality.BITS)
    got = {r["doc_id"]: r for r in quality.op3_quality(spark, SF).collect()}
    assert got.keys() == texts.keys()
    for i, r in got.items():
        assert r["log_weight"] == pytest.approx(weights[i], abs=1e-4)
    calibrated = sorted(got[i]["log_weight"] for i in good if i in got and fold(i) == 3)
    at = Fraction(1, 1000) * (len(calibrated) - 1)
    low = calibrated[int(at)] + float(at - int(at)) * (calibrated[int(at) + 1] - calibrated[int(at)])
    k = sum(r["log_weight"] >= low - 5.0 for r in got.values())
    bound = sorted((r["key"] for r in got.values()), reverse=True)[k - 1]
    assert all(r["kept"] == (r["key"] >= bound) for r in got.values())


def test_a_long_text_is_summed_in_windows():
    rng = random.Random(1)
    long = " ".join(rng.choice(["alpha", "beta", "beta", "c" * 5000, "ü"]) for _ in range(3000)).encode()
    assert len(long) > 2 * ngrams.SLICE_BYTES
    model = quality.Model(np.random.default_rng(0).integers(-(10**7), 10**7, (1 << 10) + 2), 10)
    whole, most = model.sums([long, b"x"]), ngrams.SLICE_BYTES
    n = quality.counts([long], 10)
    try:
        for q in (ngrams, quality.ngrams):
            q.slices.__defaults__ = (1 << 30,)
        ngrams.SLICE_BYTES = 1 << 30
        assert [x.tolist() for x in model.sums([long, b"x"])] == [x.tolist() for x in whole]
        assert quality.counts([long], 10).tolist() == n.tolist()
    finally:
        ngrams.SLICE_BYTES = most
        ngrams.slices.__defaults__ = (most,)


def test_a_very_long_text_takes_little_memory():
    model = quality.Model(np.ones((1 << 16) + 2, np.int64), 16)
    for raw in (b"word of text " * 400_000, b"x" * 5_000_000):
        tracemalloc.start()
        total, n = model.sums([raw])
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert total[0] == n[0] > len(raw) and peak < 5 * len(raw) + 30e6


def test_a_given_share_is_sampled_by_weight(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "plain words of a text").otherwise("§§ ## §§ ##").alias("text"))
    labels = spark.range(0, 2000, 2).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    for temperature, low, high in ((0.0, 0.45, 0.55), (0.3, 0.55, 0.85), (100.0, 0.999, 1.0)):
        model = quality.fit(docs, labels, temperature=temperature)
        got = quality.resample(docs, model, keep=0.25).where("kept").collect()
        assert len(got) == 500 and low <= sum(r["doc_id"] % 2 == 0 for r in got) / 500 <= high


def test_rows_that_the_model_has_not_seen(spark):
    """Good rows of the measured fold stay, most junk goes; the filter keeps what the query keeps."""
    docs, labels = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    got = quality.op3_quality(spark, SF01)
    unseen = got.join(labels, "doc_id").where((F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2) | (F.col("quality") == 0))
    share = {r["quality"]: r["kept"] for r in unseen.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[1] > 0.98 and share[0] < 0.15
    chosen = {r["doc_id"] for r in got.where("kept").select("doc_id").collect()}
    assert {r["doc_id"] for r in quality.keep_good(docs.repartition(5), labels).select("doc_id").collect()} == chosen


def test_clashing_names_and_ties(spark):
    rows = [(1, "same text", "a", 1.0), (1, "same text", "a", 1.0), (2, "same text", None, None), (None, None, "b", 2.0), (3, "", "c", 3.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, noise_ string, key double")
    labels = spark.createDataFrame([(1, 1), (1, 1), (None, 1)], "doc_id long, quality int")
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))
    none = docs.limit(0)
    assert quality.keep_good(none, labels).count() == 0 and quality.keep_good(docs, labels.limit(0), keep=0.0).count() == 0
