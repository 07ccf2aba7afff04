"""Object-to-object similarity from shared concepts.

Without a gate pairs are made by blocks of vectors (``blocks.py``), so none is shuffled.
With a gate the pair join on a concept is the only step that grows with a concept's frequency. It takes only scores from ``min_score`` on and keeps to pairs of listed
types. With a gate the rows of the objects to be processed are one side of the join,
so it costs their number times a concept's frequency; joined products are summed on each side of the shuffle. Frequent concepts are
split by AQE's skew join, since both sides are shuffled on the concept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshwork.functions.scalars import at_least, sigma
from meshwork.operators.blocks import Vectors
from meshwork.schema import EDGE_KEY, FROM_KEY, NODE_KEY, ONTOLOGY, TO_KEY, TYPE_PAIR
from meshwork.sources.shared import kept

MIN_SCORE, MIN_SHARED, MIN_SUM, THRESHOLD = 0.1, 4, 0.1, 0.1


def similarity(final: DataFrame, pairs: list[tuple[str, str]], gate: DataFrame | None = None, min_score: float = MIN_SCORE, min_shared: int = MIN_SHARED, min_sum: float = MIN_SUM) -> DataFrame:
    """Sums of products of scores over shared concepts.

    Of two types the pair is ordered by type, of one type by id. gate: node keys of
    which one end must be. All type pairs are done in one plan.

    Pairs are summed on two numbers that stand for the objects in the order of
    (type, id), so the one large shuffle moves numbers; keys come back for the pairs
    that are left.
    """
    if gate is None:
        return Vectors(final, pairs, min_score, min_shared, min_sum).pairs()
    allowed = sorted({tuple(sorted(p)) for p in pairs})
    kinds = sorted({t for p in pairs for t in p})
    code = F.lit(None).cast("int")
    for i, kind in enumerate(kinds):
        code = F.when(F.col("object_type") == kind, F.lit(i)).otherwise(code)
    rows = kept(final.where(F.col("object_type").isin(*kinds) & at_least("score", min_score)).select(*NODE_KEY, "concept_id", "score"))
    objects = rows.select(NODE_KEY).distinct()
    if gate is not None:
        objects = objects.join(gate.select(NODE_KEY).distinct().withColumn("_g", F.lit(True)), NODE_KEY, "left").withColumn("_g", F.coalesce("_g", F.lit(False)))
    else:
        objects = objects.withColumn("_g", F.lit(True))
    objects = kept(objects.orderBy("object_type", "object_id", "institution_id").select(*NODE_KEY, "_g", code.alias("_t"), F.monotonically_increasing_id().alias("_i")))
    numbered = kept(rows.join(objects, NODE_KEY).select("concept_id", "score", "_g", "_t", "_i"))
    side = lambda s, of: of.select("concept_id", *(F.col(c).alias(f"{s}{c}") for c in ("score", "_g", "_t", "_i")))
    # the gated objects' rows meet all others, a pair of two gated ends once
    own = numbered.where("_g") if gate is not None else numbered
    joined = side("a", own).join(side("b", numbered), "concept_id").where("a_i != b_i AND (NOT b_g OR a_i < b_i)")
    joined = joined.select(F.least("a_i", "b_i").alias("a_i"), F.greatest("a_i", "b_i").alias("b_i"), F.least("a_t", "b_t").alias("a_t"), F.greatest("a_t", "b_t").alias("b_t"), "ascore", "bscore")
    if len(kinds) > 1:
        joined = joined.where((F.col("a_t") * len(kinds) + F.col("b_t")).isin(*(kinds.index(x) * len(kinds) + kinds.index(y) for x, y in allowed)))
    got = joined.groupBy("a_i", "b_i").agg(F.sum(F.col("ascore") * F.col("bscore")).alias("score"), F.count("*").alias("n_concepts"))
    got = got.where((F.col("n_concepts") >= min_shared) & at_least("score", min_sum))
    end = lambda s, i: objects.select(F.col("_i").alias(i), *(F.col(c).alias(f"{s}_{c}") for c in NODE_KEY))
    return got.join(end("from", "a_i"), "a_i").join(end("to", "b_i"), "b_i").select(*EDGE_KEY, "score", "n_concepts")


def vectors(final: DataFrame, pairs: list[tuple[str, str]]) -> Vectors:
    """The ungated similarity's vectors, for its pairs, means and best links."""
    return Vectors(final, pairs, MIN_SCORE, MIN_SHARED, MIN_SUM)


def best_links(found: Vectors, k: int, first: DataFrame | None = None) -> DataFrame:
    """The adjusted scores of one type's ``k`` best links of each object, as edges from it."""
    means = kept(found.means())
    mean = means.select("avg_score").first()
    return adjusted(found.top(k, mean[0] if mean else 1.0, THRESHOLD, first), means)


def candidate_estimate(final: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Joined rows a similarity run would make, by pair of types, from concept counts."""
    n = final.where(at_least("score", MIN_SCORE)).groupBy("concept_id", "object_type").agg(F.count("*").alias("n"))
    a, b = n.select("concept_id", F.col("object_type").alias("from_object_type"), F.col("n").alias("n_a")), n.select("concept_id", F.col("object_type").alias("to_object_type"), F.col("n").alias("n_b"))
    allowed = final.sparkSession.createDataFrame(sorted({tuple(sorted(p)) for p in pairs}), "from_object_type string, to_object_type string")
    rows = a.join(b, "concept_id").join(F.broadcast(allowed), TYPE_PAIR)
    same = F.col("from_object_type") == F.col("to_object_type")
    return rows.groupBy(*TYPE_PAIR).agg(F.sum(F.when(same, F.col("n_a") * (F.col("n_a") - 1) / 2).otherwise(F.col("n_a") * F.col("n_b"))).cast("bigint").alias("candidates"))


def pair_means(scores: DataFrame) -> DataFrame:
    return scores.groupBy(*TYPE_PAIR).agg(F.avg("score").alias("avg_score"), F.count("*").alias("n_rows"))


def scaled(scores: DataFrame, means: DataFrame, least: float = THRESHOLD) -> DataFrame:
    """Rows with sigma of their score and of the mean of their types, from ``least`` on."""
    got = scores.join(F.broadcast(means.select(*TYPE_PAIR, "avg_score")), TYPE_PAIR)
    return got.withColumn("score", sigma("score", "avg_score")).drop("avg_score").where(at_least("score", least))


def adjusted_pairs(found: Vectors, means: DataFrame, least: float = THRESHOLD, digits: int | None = None, marks: DataFrame | None = None) -> DataFrame:
    """``adjusted`` of all pairs of some vectors; sigma, ``least`` and rounding (``digits``) act once on
    objects of equal vectors. marks: as in ``Vectors.pairs``."""
    def change(rows):
        rows = scaled(rows, means, least)
        return rows if digits is None else rounded(rows, digits)

    return found.pairs(change, marks).drop("n_concepts")


def rounded(rows: DataFrame, digits: int) -> DataFrame:
    return rows.withColumn("score", F.round("score", digits))


def adjusted(scores: DataFrame, means: DataFrame | None = None, least: float = THRESHOLD, gate: DataFrame | None = None) -> DataFrame:
    """sigma(score, mean of the pair of types), from ``least`` on; pairs of types
    without a mean give no rows. gate: node keys of which one end must be."""
    means = pair_means(scores) if means is None else means
    got = scaled(scores, means, least).select(*EDGE_KEY, "score")
    return got if gate is None else either_end(got, gate)


def either_end(rows: DataFrame, gate: DataFrame) -> DataFrame:
    """Rows with one end or both among the gate's node keys."""
    for side, mark in (("from", "_a"), ("to", "_b")):
        keys = gate.select(*(F.col(c).alias(f"{side}_{c}") for c in NODE_KEY)).distinct().withColumn(mark, F.lit(True))
        rows = rows.join(keys, [f"{side}_{c}" for c in NODE_KEY], "left")
    return rows.where("_a OR _b").drop("_a", "_b")


def to_ontology(final: DataFrame, other: str, kind: str, least: float = THRESHOLD) -> DataFrame:
    """Object-to-concept (or category) scores as edges that end in the ontology."""
    return final.where(at_least("score", least)).select(*(F.col(a).alias(b) for a, b in zip(NODE_KEY, FROM_KEY, strict=True)), F.lit(ONTOLOGY).alias(TO_KEY[0]), F.lit(kind).alias(TO_KEY[1]), F.col(other).alias(TO_KEY[2]), "score")


def concept_pairs(undirected: DataFrame, least: float = THRESHOLD, gate: DataFrame | None = None) -> DataFrame:
    rows = undirected.where(at_least("normalised_score", least)).select(F.lit(ONTOLOGY).alias(FROM_KEY[0]), F.lit("Concept").alias(FROM_KEY[1]), F.col("from_id").alias(FROM_KEY[2]), F.lit(ONTOLOGY).alias(TO_KEY[0]), F.lit("Concept").alias(TO_KEY[1]), F.col("to_id").alias(TO_KEY[2]), F.col("normalised_score").alias("score"))
    return rows if gate is None else either_end(rows, gate)


def score_all(final: DataFrame, categories: DataFrame, undirected: DataFrame, pairs: list[tuple[str, str]], least: float = THRESHOLD, gate: DataFrame | None = None, digits: int | None = None) -> DataFrame:
    """All adjusted scores: objects with objects, with concepts and categories, and
    concepts with each other; digits: rounded to so many."""
    short = lambda rows: rows if digits is None else rounded(rows, digits)
    if gate is None:
        found = vectors(final, pairs)
        objects = adjusted_pairs(found, kept(found.means()), least, digits)
    else:
        objects = short(adjusted(similarity(final, pairs, gate), least=least))
    return objects.unionByName(short(to_ontology(final, "concept_id", "Concept", least).unionByName(to_ontology(categories, "category_id", "Category", least)).unionByName(concept_pairs(undirected, least, gate))))
