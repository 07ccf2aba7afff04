"""Full-text search over documents as a batch query.

Words are folded (case, accents), and a query matches a document if each of its
words begins a word of the document or is within the allowed edits of one: none up
to two letters, one up to five, two beyond. Documents that match are ordered by
(share of matched words + phrase bonus + boost of an exact id) * factor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meshwork.functions.scalars import folded, shingles, tokens

ID_BOOST, PHRASE = 10.0, 1.0
STEM_ENDINGS = ("ing", "es", "s")


def edits(word: Column) -> Column:
    return F.when(F.length(word) <= 2, 0).when(F.length(word) <= 5, 1).otherwise(2)


def matches(q: str):
    """Whether a document's word answers the query's word."""
    return lambda w: w.startswith(q) | (F.levenshtein(w, F.lit(q)) <= edits(F.lit(q)))


def light_stem(word: Column) -> Column:
    """Plural and -ing endings off words that stay at least three letters long."""
    out = word
    for e in STEM_ENDINGS:
        out = F.when(word.endswith(e) & (F.length(word) >= len(e) + 3) & (out == word), F.left(word, F.length(word) - len(e))).otherwise(out)
    return out


def analysed(docs: DataFrame, text: str, synonyms: dict[str, str] | None = None) -> DataFrame:
    """Documents with their words, stems, and word shingles of two and three."""
    words = tokens(text)
    if synonyms:
        pairs = F.create_map(*(F.lit(x) for kv in synonyms.items() for x in kv))
        words = F.transform(words, lambda w: F.coalesce(pairs[w], w))
    return docs.withColumns({"words": words, "stems": F.transform(words, light_stem), "shingles_2": shingles(text, 2), "shingles_3": shingles(text, 3), "keyword": folded(text)})


def search(docs: DataFrame, query: str, id_col: str = "doc_id", text_cols: tuple[str, ...] = ("name_en",), factor: str = "degree_score_factor", k: int = 10) -> DataFrame:
    """The k best documents for a query: id, score, highlight; ties by id."""
    spark: SparkSession = docs.sparkSession
    wanted = [r[0] for r in spark.range(1).select(F.explode(tokens(F.lit(query)))).collect()]  # the query's own words
    best = None
    for text in text_cols:
        words = tokens(text)
        hits = [F.exists(words, matches(q)) for q in wanted]
        exact = [F.array_contains(words, q) for q in wanted]
        every = F.lit(bool(wanted))
        for h in hits:
            every = every & h
        share = sum((e.cast("double") for e in exact), F.lit(0.0)) / max(len(wanted), 1)
        phrase = F.when(F.contains(F.array_join(words, " "), F.lit(" ".join(wanted))), PHRASE).otherwise(0.0)
        score = F.when(every, 1.0 + share + phrase).otherwise(0.0)
        best = score if best is None else F.greatest(best, score)  # the best field counts
    own = F.when(F.col(id_col).cast("string") == query, ID_BOOST).otherwise(0.0)
    scored = docs.withColumn("score", (best + own) * F.col(factor)).where("score > 0")
    mark = text_cols[0]
    return scored.select(id_col, "score", F.col(mark).alias("highlight")).orderBy(F.col("score").desc(), F.col(id_col)).limit(k)


def fetch(docs: DataFrame, ids: list[str], id_col: str = "doc_id") -> DataFrame:
    """Documents of some ids (a small list of the caller's)."""
    wanted = docs.sparkSession.createDataFrame([(i,) for i in ids], f"{id_col} string")
    return docs.join(F.broadcast(wanted), id_col, "left_semi")
