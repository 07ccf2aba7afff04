"""Object-to-concept and object-to-category scores.

Sums over shared concepts are bounded by sigma(sum, mean); the mean is that of all
qualifying sums, a one-row aggregate that is broadcast, and 1 where there are none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshwork.config import SCORE_SLOTS, UNION_CALCULATIONS
from meshwork.functions.scalars import at_least, logistic2, sigma
from meshwork.schema import NODE_KEY, OBJECTS, ONTOLOGY

CATEGORY_LEAST = {"Person": 1.0, "Publication": 1.0, "Unit": 1.0, "Course": 0.1, "Startup": 0.1, "Widget": 0.1}


def as_object(frame: DataFrame, kind: str, object_id: str | Column, *rest: str, institution: str = OBJECTS) -> DataFrame:
    oid = F.col(object_id) if isinstance(object_id, str) else object_id
    return frame.select(F.lit(institution).alias("institution_id"), F.lit(kind).alias("object_type"), oid.alias("object_id"), *rest)


def mean_or_one(raw: DataFrame, column: str = "score") -> DataFrame:
    return raw.agg(F.coalesce(F.avg(column), F.lit(1.0)).alias("mean_"))


def bounded(raw: DataFrame, mean_of: DataFrame | None = None, least: float | None = None) -> DataFrame:
    """Raw scores put through sigma. mean_of: the rows whose mean scales them;
    least: the raw score from which rows are kept."""
    rows = raw if least is None else raw.where(at_least("score", least))
    mean = mean_or_one(raw if mean_of is None else mean_of)
    return rows.crossJoin(F.broadcast(mean)).withColumn("score", sigma("score", "mean_")).drop("mean_")


def slide_sums(course_lecture: DataFrame, lecture_slide: DataFrame, detections: DataFrame, kind: str = "Course") -> DataFrame:
    """Raw sums of slides' detections over lecture and course (or MOOC).
    course_lecture: id, lecture_id; lecture_slide: lecture_id, slide_id.

    Detections are summed by lecture first, so the join with courses is small."""
    own = detections.where("object_type = 'Slide'").select(F.col("object_id").alias("slide_id"), "concept_id", "score")
    by_lecture = lecture_slide.join(own, "slide_id").groupBy("lecture_id", "concept_id").agg(F.sum("score").alias("score"))
    got = course_lecture.join(by_lecture, "lecture_id").groupBy("id", "concept_id").agg(F.sum("score").alias("score"))
    return as_object(got, kind, "id", "concept_id", "score")


def lecture_sums(lecture_slide: DataFrame, detections: DataFrame) -> DataFrame:
    own = detections.where("object_type = 'Slide'").select(F.col("object_id").alias("slide_id"), "concept_id", "score")
    got = lecture_slide.join(own, "slide_id").groupBy("lecture_id", "concept_id").agg(F.sum("score").alias("score"))
    return as_object(got, "Lecture", "lecture_id", "concept_id", "score")


def llm_scores(tags: DataFrame) -> DataFrame:
    """Keyword scores of lectures, at most 1."""
    return tags.select(*NODE_KEY, "concept_id", F.least(F.col("score"), F.lit(1.0)).alias("score"))


def concept_sums(traversal: DataFrame, id_col: str, kind: str, least: float) -> DataFrame:
    """Raw sums over a traversal (id, concept_id, score), from ``least`` on."""
    got = traversal.groupBy(id_col, "concept_id").agg(F.sum("score").alias("score")).where(at_least("score", least))
    return as_object(got, kind, id_col, "concept_id", "score")


def active_research(raw: DataFrame, active: DataFrame, research: DataFrame) -> DataFrame:
    """Rows of units that are active research units."""
    yes = lambda f: f.where("field_value = '1'").select(NODE_KEY).distinct()
    return raw.join(yes(active), NODE_KEY, "left_semi").join(yes(research), NODE_KEY, "left_semi")


def category_sums(category_cluster: DataFrame, cluster_concept: DataFrame, symmetric: DataFrame, least: float = 0.1) -> DataFrame:
    """Raw sums of the symmetric neighbours of a category's concepts."""
    members = category_cluster.select(F.col("from_id").alias("category"), F.col("to_id").alias("cluster")).join(cluster_concept.select(F.col("from_id").alias("cluster"), F.col("to_id").alias("from_id")), "cluster")
    got = members.join(symmetric, "from_id").groupBy("category", F.col("to_id").alias("concept_id")).agg(F.sum("score").alias("score")).where(at_least("score", least))
    return as_object(got, "Category", "category", "concept_id", "score", institution=ONTOLOGY)


def labelled(scores: DataFrame, calculation: str) -> DataFrame:
    return scores.withColumn("calculation_type", F.lit(calculation))


def union_scores(calculated: DataFrame, detections: DataFrame, manual: DataFrame, least: float = 0.1) -> DataFrame:
    """Whitelisted calculated scores and detections from ``least`` on, and all manual mappings."""
    spark = calculated.sparkSession
    allowed = spark.createDataFrame(list(UNION_CALCULATIONS), "object_type string, calculation_type string")
    cols = [*NODE_KEY, "concept_id", "calculation_type", "score"]
    a = calculated.join(F.broadcast(allowed), ["object_type", "calculation_type"], "left_semi").where(at_least("score", least)).select(cols)
    b = detections.where(at_least("score", least)).withColumn("calculation_type", F.concat(F.lit("concept detection on "), "text_source")).select(cols)
    c = manual.withColumn("calculation_type", F.concat(F.lit("manual mapping on "), "text_source")).select(cols)
    return a.unionByName(b).unionByName(c)


def scoring_matrix(union: DataFrame) -> DataFrame:
    """The three score slots of each (object, concept), by the table of rules; the
    largest score of a slot counts."""
    def slot(n: int) -> Column:
        fits = None
        for kind, calculation, k in SCORE_SLOTS:
            if k == n:
                one = (F.col("object_type") == kind) & (F.col("calculation_type") == calculation)
                fits = one if fits is None else fits | one
        return F.max(F.when(fits, F.col("score"))).alias(f"score_{n}")

    return union.groupBy(*NODE_KEY, "concept_id").agg(slot(1), slot(2), slot(3))


def final_scores(matrix: DataFrame) -> DataFrame:
    total = sum((F.coalesce(F.col(f"score_{n}"), F.lit(0.0)) for n in (1, 2, 3)), F.lit(0.0))
    return matrix.select(*NODE_KEY, "concept_id", logistic2(total).alias("score"))


def category_raw(concept_scores: DataFrame, category_cluster: DataFrame, cluster_concept: DataFrame, kinds: dict[str, float] | None = None) -> DataFrame:
    """Object-to-category sums of concept scores through the clusters, from the
    type's own least on. concept_scores: node key, concept_id, score."""
    kinds = CATEGORY_LEAST if kinds is None else kinds
    members = category_cluster.select(F.col("from_id").alias("category_id"), F.col("to_id").alias("cluster")).join(cluster_concept.select(F.col("from_id").alias("cluster"), F.col("to_id").alias("concept_id")), "cluster").select("category_id", "concept_id")
    least = F.lit(None).cast("double")
    for kind, x in kinds.items():
        least = F.when(F.col("object_type") == kind, F.lit(float(x))).otherwise(least)
    got = concept_scores.where(F.col("object_type").isin(*kinds)).join(members, "concept_id").groupBy(*NODE_KEY, "category_id").agg(F.sum("score").alias("score"))
    return got.where(F.round("score", 9) >= least)


def category_means(raw: DataFrame) -> DataFrame:
    return raw.groupBy("institution_id", "object_type").agg(F.avg("score").alias("avg_score"))


def category_final(raw: DataFrame, means: DataFrame) -> DataFrame:
    """sigma(raw, mean of the type); there are as many means as types."""
    return raw.join(F.broadcast(means), ["institution_id", "object_type"]).select(*NODE_KEY, "category_id", sigma("score", "avg_score").alias("score"))
