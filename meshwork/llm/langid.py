"""Language identification by multilingual mixture inference.

Each language has a model of hashed byte trigrams. A document's words are taken
as drawn from a mixture of the languages; expectation-maximisation estimates the
proportions. The set of languages grows from the best one as long as the
likelihood, penalised by the set's size, improves. The predicted language is the
one with the largest proportion in the chosen set, which is also the score.

Models are fitted on a bounded sample: about ``rows_per_language`` labelled documents
of each language, chosen by a hash of their ids, never from the held-out fold.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
a null id is never used for training; repeated rows are predicted alike; without
any labelled document all are ``und``; an empty table gives none; extra columns
are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshwork.llm import ngrams
from meshwork.llm.common import draw, few_rows, fold, table, workers_import

BITS = 15
ROWS_PER_LANGUAGE = 5_000
SMOOTHING = 0.1
#: Cost of one more language, times the log of the number of words.
PENALTY = 2.0
#: Each byte lies in three trigrams.
TEMPER = 1 / 3
STEPS = 12
UNDETERMINED = "und"

#: ASCII bytes that are no letters become blanks.
_LETTERS = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], np.uint8)


def letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes with ASCII non-letters blanked, and each text's bounds."""
    data, bounds = ngrams.joined([t.lower().encode("utf-8", "replace") for t in texts])
    return _LETTERS[data], bounds


def _slices(texts: list[str], most: int = ngrams.SLICE_BYTES):
    held, size = [], 0
    for t in texts:
        if held and size + len(t) > most:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield held


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # languages x buckets, log probabilities
    bits: int = BITS
    penalty: float = PENALTY

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, list[str]]]:
        """(language, its proportion, languages of the mixture) for each text."""
        out: list = [(UNDETERMINED, 0.0, [])] * len(texts)
        if not self.languages:
            return out
        known = [i for i, t in enumerate(texts) if t]
        at = 0
        for part in _slices([texts[i] for i in known]):
            shares = self.mixtures(part)
            for i, t, row in zip(known[at:], part, shares, strict=False):
                if row.any() and any(map(str.isalpha, t)):
                    best = int(row.argmax())
                    out[i] = (self.languages[best], min(1.0, float(row[best])), [self.languages[k] for k in np.argsort(-row, kind="stable") if row[k] > 0])
            at += len(part)
        return out

    def word_scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words x languages log likelihoods and the word bounds of each text."""
        data, bounds = letters(texts)
        codes = ngrams.buckets(data, 3, self.bits)
        starts, ends = ngrams.word_spans(data)
        # a word's trigrams begin from the blank before it to its last byte but one
        edges = np.empty(2 * len(starts), np.int64)
        edges[::2], edges[1::2] = starts - 1, np.maximum(ends - 1, starts)
        scores = np.empty((len(starts), len(self.languages)))
        for k, row in enumerate(self.table):
            total = np.zeros(len(codes) + 1)
            np.cumsum(row[codes], dtype=np.float64, out=total[1:])
            ends_at = total[np.minimum(edges, len(codes))]
            scores[:, k] = ends_at[1::2] - ends_at[::2]
        return scores * TEMPER, np.searchsorted(starts, bounds)

    def mixtures(self, texts: list[str]) -> np.ndarray:
        """Texts x languages proportions; zero rows for texts without words."""
        scores, bounds = self.word_scores(texts)
        shares = np.zeros((len(texts), len(self.languages)))
        n = np.diff(bounds)
        docs = np.flatnonzero(n)
        if not len(docs):
            return shares
        first = bounds[:-1][docs]
        sizes = n[docs]
        top = scores.max(axis=1)
        given = np.exp(scores - top[:, None])
        single = np.add.reduceat(scores - top[:, None], first, axis=0)  # each language alone
        best = single.argmax(axis=1)
        found = np.zeros((len(docs), len(self.languages)))
        found[np.arange(len(docs)), best] = 1
        value = single[np.arange(len(docs)), best]
        full, _ = em(given, first, sizes, np.full(found.shape, 1 / len(self.languages)))
        open_docs = np.arange(len(docs))
        for m in range(2, len(self.languages) + 1):
            # the languages with the largest proportions, m of them, the best one included
            rank = full[open_docs].copy()
            rank[np.arange(len(open_docs)), best[open_docs]] = 2
            order = np.argsort(-rank, axis=1, kind="stable")
            may = full[open_docs, order[:, m - 1]] * sizes[open_docs] > 0.5
            open_docs, order = open_docs[may], order[may]
            if not len(open_docs):
                break
            start = np.zeros((len(open_docs), len(self.languages)))
            np.put_along_axis(start, order[:, :m], 1 / m, axis=1)
            rows = np.concatenate([np.arange(a, a + s) for a, s in zip(first[open_docs], sizes[open_docs], strict=True)])
            own = sizes[open_docs]
            got, reached = em(given[rows], np.concatenate([[0], np.cumsum(own)[:-1]]), own, start)
            better = reached - self.penalty * np.log1p(own) > value[open_docs]
            found[open_docs[better]] = got[better]
            value[open_docs[better]] = (reached - self.penalty * np.log1p(own))[better]
            open_docs = open_docs[better]
            if not len(open_docs):
                break
        shares[docs] = found
        return shares


def em(given: np.ndarray, first: np.ndarray, sizes: np.ndarray, shares: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of each document after so many steps, and its log likelihood."""
    for _ in range(steps):
        mixed = np.repeat(shares, sizes, axis=0)
        mixed *= given
        total = mixed.sum(axis=1)
        mixed /= np.maximum(total, 1e-300)[:, None]
        shares = np.add.reduceat(mixed, first, axis=0) / sizes[:, None]
    mixed = (np.repeat(shares, sizes, axis=0) * given).sum(axis=1)
    return shares, np.add.reduceat(np.log(np.maximum(mixed, 1e-300)), first)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", held_out: int = 2, rows_per_language: int = ROWS_PER_LANGUAGE, bits: int = BITS) -> Model:
    """Trigram models of the languages of the documents outside fold ``held_out``."""
    import pyarrow as pa

    spark = docs.sparkSession
    workers_import(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"), F.col(lang_col).alias("tongue"))
    usable = rows.where(F.col("tongue").isNotNull() & F.col("id").isNotNull() & (fold("id") != held_out) & F.col("body").isNotNull())
    # a row for each language
    sizes = {r[0]: r[1] for r in usable.groupBy("tongue").count().collect()}
    if not sizes:
        return Model([], np.zeros((0, 1 << bits)), bits)
    languages = sorted(sizes)
    share = few_rows(spark, [(k, min(1.0, rows_per_language / sizes[k])) for k in languages], "tongue string, share double")
    sample = usable.join(F.broadcast(share), "tongue").where(draw("id") < F.col("share")).select("tongue", "body")

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            by: dict[str, list[str]] = {}
            for tongue, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by.setdefault(tongue, []).append(body)
            for tongue, texts in by.items():
                held = total.setdefault(tongue, np.zeros(1 << bits, np.int64))
                for part in _slices(texts):
                    data, _ = letters(part)
                    kept = (data[:-2] > 32) | (data[1:-1] > 32)
                    held += np.bincount(ngrams.buckets(data, 3, bits)[kept], minlength=1 << bits)
        for tongue, held in total.items():
            some = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays([pa.array([tongue] * len(some), pa.string()), pa.array(some, pa.int32()), pa.array(held[some])], names=["tongue", "bucket", "n"])

    got = sample.mapInArrow(count, "tongue string, bucket int, n long").groupBy("tongue", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counted = np.zeros((len(languages), 1 << bits))
    counted[got["tongue"].map({k: i for i, k in enumerate(languages)}).to_numpy(int), got["bucket"].to_numpy(int)] = got["n"]
    smooth = counted + SMOOTHING
    return Model(languages, np.log(smooth / smooth.sum(axis=1, keepdims=True)), bits)


def predictions(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, lang_pred, score, languages (those of the chosen mixture)."""
    import pyarrow as pa

    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            got = held.value.predict(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x[0] for x in got], pa.string()), pa.array([x[1] for x in got], pa.float64()), pa.array([x[2] for x in got], pa.list_(pa.string()))], names=[id_col, "lang_pred", "score", "languages"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double, languages array<string>")


def keep_identified(docs: DataFrame, text_col: str = "text", least: float = 0.5, **options) -> DataFrame:
    """The rows whose main language is determined and has at least the share ``least``."""
    import pyarrow as pa

    held = docs.sparkSession.sparkContext.broadcast(fit(docs, text_col=text_col, **options))
    place = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            got = held.value.predict(batch.column(place).to_pylist())
            yield batch.filter(pa.array([x[0] != UNDETERMINED and x[1] >= least for x in got], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = predictions(docs, fit(docs))
    return found.select("doc_id", (fold("doc_id") == 2).alias("held_out"), "lang_pred", "score", F.array_join("languages", ",").alias("languages"))
