"""Quality classifier by importance resampling.

Two generative models over hashed n-grams, one of target text and one of the raw
corpus, give each document the log ratio of its probabilities. The importance
weight is tempered by length: the log ratio is divided by the number of n-grams
(plus ``SHRINK``, which pulls short texts towards no evidence) and multiplied by
``temperature``, so that long documents are not judged by their length. Documents
are then sampled without replacement in proportion to their weights: each gets a
Gumbel noise drawn from its id, and the k largest sums of log weight and noise stay.

The n-grams are byte trigrams, hashed to 2^``bits`` buckets, and, as a second
family, whether each word repeats the word before it. The raw model counts every
document. The target model counts a bounded sample of ``target_rows`` documents
labelled as good, outside the folds ``CALIBRATION`` and ``MEASURED`` of their ids.
k is the share ``keep`` of the input if that is given. By default it is the number
of documents whose weight reaches the cut: the ``tail`` quantile of at most
``target_rows`` good documents of the calibration fold, which the model has not
seen, less ``slack`` for each n-gram. Fold ``MEASURED`` takes no part in either.

Log ratios are kept as whole multiples of 2^-24 and summed as whole numbers, so a
document's weight depends on its own text alone: equal texts weigh the same in any
batch, partitioning or retry. A text over a slice is summed in windows.

The k-th largest key is found with counts of ever narrower key ranges, a row for
each range, never by collecting or globally sorting keys.

Defined results: a null or empty text has no n-gram and log weight 0; a text of
blanks alone has only the trigrams of its blanks; a null id gets the noise of id 0
and is no target; equal keys at the cut all stay, so repeated rows stay or go
together; without target rows every log weight is 0 and all documents stay (or the
share ``keep`` with the largest noise); an empty table gives none; extra columns
are ignored or passed through, whatever their names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshwork.llm import ngrams
from meshwork.llm.common import bounded_sample, cut, fold, table, utf8, workers_import

BITS = 16
TARGET_ROWS = 20_000
SMOOTHING = 0.5
TAIL = 0.001
#: Of a log ratio per n-gram: what the cut lies below the calibration quantile.
SLACK = 0.05
#: N-grams without evidence that are added to each text.
SHRINK = 20
TEMPERATURE = 100.0
#: Folds of the ids (crc32 modulo 4) that the target model does not see.
CALIBRATION, MEASURED = 3, 2
#: Log ratios are kept as whole multiples of this part of a nat.
UNIT = 1 << 24
#: Key ranges counted at once when the k-th largest key is sought.
RANGES = 4096

_WORD = re.compile(rb"[^\x00-\x20]+")


@dataclass
class Model:
    """Log ratios, in units, of the trigram buckets, then of the two repetition events."""

    table: np.ndarray
    bits: int
    cut: float = -np.inf
    temperature: float = TEMPERATURE

    def sums(self, raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Summed log ratio in units, and the number of n-grams, of each text."""
        totals, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        repeat = self.table[1 << self.bits :]
        for part in ngrams.slices(raws):
            if len(part[0]) > ngrams.SLICE_BYTES:
                codes, words, same = long_features(part[0], self.bits)
                total, n = 0, 0
                for c in codes:
                    total += int(self.table[c].sum())
                    n += len(c)
                totals.append(np.array([total + int(repeat[0]) * (words - same) + int(repeat[1]) * same]))
                sizes.append(np.array([n + words]))
                continue
            bounds, codes, first, same = features(part, self.bits)
            inside = ngrams.inner(bounds, 3)
            totals.append(ngrams.segment_sums(self.table[codes], inside)[::2] + ngrams.segment_sums(repeat[same], first))
            sizes.append(inside[1::2] - inside[::2] + np.diff(first))
        return np.concatenate(totals), np.concatenate(sizes)

    def log_weights(self, raws: list[bytes]) -> np.ndarray:
        total, n = self.sums(raws)
        return self.temperature * (total / UNIT) / (n + SHRINK)


def features(raws: list[bytes], bits: int):
    """(text bounds, trigram buckets at each byte, word bounds of each text, for each
    word 1 if it repeats the one before it in the text)."""
    data, bounds = ngrams.joined(raws)
    codes = ngrams.buckets(data, 3, bits)
    starts, ends = ngrams.word_spans(data)
    first = np.searchsorted(starts, bounds)
    hashes = ngrams.word_hashes(data, starts, ends)
    same = np.zeros(len(starts), np.int64)
    same[1:] = hashes[1:] == hashes[:-1]
    same[first[:-1][first[:-1] < len(same)]] = 0
    return bounds, codes, first, same


def long_features(raw: bytes, bits: int):
    """(an iterator over the trigram buckets of each window, words, words that repeat
    the one before) of one long text, a window at a time."""
    words = same = 0
    before = None
    for m in _WORD.finditer(raw):
        word = m.group()
        same += word == before
        words += 1
        before = word
    codes = (ngrams.buckets(np.frombuffer(w, np.uint8), 3, bits) for w in ngrams.windows(b" " + raw + b" ", 2))
    return codes, words, same


def counts(raws: list[bytes], bits: int) -> np.ndarray:
    total = np.zeros((1 << bits) + 2, np.int64)
    for part in ngrams.slices(raws):
        if len(part[0]) > ngrams.SLICE_BYTES:
            codes, words, same = long_features(part[0], bits)
            for c in codes:
                total[:-2] += np.bincount(c, minlength=1 << bits)
            total[-2:] += np.array([words - same, same])
            continue
        bounds, codes, _, same = features(part, bits)
        kept = np.ones(len(codes), bool)  # all but the two of each text that reach into the next
        for k in (1, 2):
            kept[(bounds[1:] - k)[bounds[1:] - k < len(codes)]] = False
        total[:-2] += np.bincount(codes[kept], minlength=1 << bits)
        total[-2:] += np.bincount(same, minlength=2)
    return total


def log_probabilities(counted: np.ndarray) -> np.ndarray:
    """Smoothed log probabilities, of each family by itself."""
    out = np.zeros(len(counted))
    for part in (slice(None, -2), slice(-2, None)):
        n = counted[part] + SMOOTHING
        out[part] = np.log(n / n.sum())
    return out


def target_ids(labels: DataFrame, id_col: str, label_col: str, rows: int) -> DataFrame:
    """At most ``rows`` ids with label 1 for the target model (role 1) and as many for
    the cut (role 2), chosen by their hashes."""
    good = labels.where(F.col(label_col) == 1).where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("target_id")).distinct()
    pick = lambda rows_of, role: bounded_sample(rows_of, "target_id", rows).withColumn("role", F.lit(role))
    return pick(good.where(~fold("target_id").isin(CALIBRATION, MEASURED)), 1).union(pick(good.where(fold("target_id") == CALIBRATION), 2))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", target_rows: int = TARGET_ROWS, bits: int = BITS, tail: float = TAIL, slack: float = SLACK, temperature: float = TEMPERATURE) -> Model:
    """Counts n-grams of all documents and of the target sample in one pass over
    the texts, then places the cut with a pass over the calibration sample (over the
    target sample where that is empty)."""
    import pyarrow as pa

    spark = docs.sparkSession
    workers_import(spark)
    size = (1 << bits) + 2
    chosen = cut(target_ids(labels, id_col, label_col, target_rows))  # at most 2 x target_rows ids
    marked = docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("raw")).join(F.broadcast(chosen), F.col("id") == F.col("target_id"), "left").select("raw", F.coalesce("role", F.lit(0)).alias("role"))

    def count(batches):
        raw, target = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            good = batch.column(1).to_numpy() == 1
            texts = batch.column(0).to_pylist()
            mine = counts([t for t, g in zip(texts, good, strict=True) if g], bits)
            target += mine
            raw += mine + counts([t for t, g in zip(texts, good, strict=True) if not g], bits)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(raw[some]), pa.array(target[some])], names=["bucket", "raw", "target"])

    # as many rows as there are buckets
    got = marked.mapInArrow(count, "bucket int, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    whole, target = np.zeros(size, np.int64), np.zeros(size, np.int64)
    whole[got["bucket"]] = got["raw"]
    target[got["bucket"]] = got["target"]
    if not target.sum():
        return Model(np.zeros(size, np.int64), bits, -np.inf, temperature)
    ratio = log_probabilities(target) - log_probabilities(whole)
    model = Model(np.rint(ratio * UNIT).astype(np.int64), bits, -np.inf, temperature)
    for role in (2, 1):  # of bounded samples
        low = log_weights(marked.where(F.col("role") == role).select(F.lit(0).alias("id"), "raw"), model).agg(F.percentile("log_weight", tail)).first()[0]
        if low is not None:
            model.cut = float(low) - temperature * slack
            break
    return model


def log_weights(rows: DataFrame, model: Model) -> DataFrame:
    """rows: id, raw. Gives id, log_weight."""
    import pyarrow as pa

    held = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            got = held.value.log_weights(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.float64())], names=["id", "log_weight"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, log_weight double")


def gumbel(id_col: str | F.Column, seed: int = 42) -> F.Column:
    """Standard Gumbel noise drawn from an id."""
    h = F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(id_col) if isinstance(id_col, str) else id_col, F.lit(0)), F.lit(seed)), 11)
    return -F.log(-F.log((h + F.lit(0.5)) / F.lit(float(2**53))))


def kth_largest(keys: DataFrame, k: int, col: str = "key") -> float:
    """The k-th largest value of a double column, exactly."""
    low, high = keys.agg(F.min(col), F.max(col)).first()
    while low < high:
        width = (high - low) / RANGES
        if width <= 0 or low + width == low or high - width == high:
            break
        place = F.least(F.floor((F.col(col) - F.lit(low)) / F.lit(width)), F.lit(RANGES - 1))
        inside = keys.where(F.col(col).between(low, high))
        found = sorted((tuple(r) for r in inside.groupBy(place.alias("p")).agg(F.count("*"), F.min(col), F.max(col)).collect()), reverse=True)
        for _, n, least, most in found:
            if k <= n:
                low, high = least, most
                break
            k -= n
    if low < high:  # a range too narrow to split: few distinct values
        for value, n in sorted((tuple(r) for r in keys.where(F.col(col).between(low, high)).groupBy(col).count().collect()), reverse=True):
            if k <= n:
                return value
            k -= n
    return low


def bound_of(keyed: DataFrame, model: Model, keep: float | None) -> float:
    """The smallest key that stays. keyed: log_weight, key."""
    k = keyed.where(F.col("log_weight") >= model.cut).count() if keep is None else round(keep * keyed.count())
    return kth_largest(keyed, k) if k else float("inf")


def resample(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, keep: float | None = None) -> DataFrame:
    """``id_col``, log_weight, key, kept of each document."""
    rows = docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("raw"))
    keyed = cut(log_weights(rows, model).withColumn("key", F.col("log_weight") + gumbel("id", seed)))
    return keyed.select(F.col("id").alias(id_col), "log_weight", "key", (F.col("key") >= F.lit(bound_of(keyed, model, keep))).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: float | None = None, **options) -> DataFrame:
    """The rows of ``docs`` that resampling keeps. Weights are computed anew beside each
    row, to the same bits, so that texts need not be joined with their keys."""
    import pyarrow as pa

    model = fit(docs, labels, id_col, text_col, **options)
    rows = docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("raw"))
    bound = bound_of(cut(log_weights(rows, model).select("log_weight", (F.col("log_weight") + gumbel("id")).alias("key"))), model, keep)
    held = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)
    noise_col = "noise_"
    while noise_col in map(str.lower, docs.columns):
        noise_col += "_"

    def run(batches):
        for batch in batches:
            raws = [x.as_buffer().to_pybytes() if x.is_valid else b"" for x in batch.column(place)]
            noise = batch.column(batch.num_columns - 1).to_numpy()
            kept = batch.filter(pa.array(held.value.log_weights(raws) + noise >= bound))
            yield pa.RecordBatch.from_arrays(kept.columns[:-1], schema=pa.schema(list(kept.schema)[:-1]))

    return docs.withColumn(noise_col, gumbel(id_col)).mapInArrow(run, docs.schema)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return resample(docs, fit(docs, table(spark, sf_dir, "labels")))
