"""Degree scores, log-normalised for each pair of types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshwork.config import DEGREE_PAIRS
from meshwork.schema import FROM_KEY, NODE_KEY, OBJECTS, ONTOLOGY
from meshwork.operators.views import mirrored

COLUMNS = [*FROM_KEY, "to_object_type", "degree", "log_degree"]


def _with_log(rows: DataFrame) -> DataFrame:
    return rows.withColumn("log_degree", F.log1p("degree")).select(COLUMNS)


def edge_degrees(edges: DataFrame, inverse: bool = False) -> DataFrame:
    """Distinct objects at the other end, for each object and type of the other end.
    Edges are made distinct first, so that counting needs no second expansion."""
    rows = (mirrored(edges) if inverse else edges).select(*FROM_KEY, "to_object_type", "to_object_id").distinct()
    return _with_log(rows.groupBy(*FROM_KEY, "to_object_type").agg(F.count("to_object_id").alias("degree")))


def hub_degrees(hubs: DataFrame, others: DataFrame, ends: tuple[str, str]) -> DataFrame:
    """Degrees of edges given by their hubs: of an object all distinct objects that share a
    hub with it. hubs: id, hub of the objects counted for; others: id, hub at the other end;
    both without repeats. ends: their types.

    An object of one hub has as many as its hub; only those of several are expanded, as
    theirs may meet in more than one hub."""
    own = hubs.groupBy("id").agg(F.count("*").alias("n_hubs"), F.min("hub").alias("hub"))
    sizes = others.groupBy("hub").agg(F.count("id").alias("degree"))
    single = own.where("n_hubs = 1").join(sizes, "hub").select("id", "degree")
    many = own.where("n_hubs > 1").select(F.col("id").alias("many"))
    several = hubs.join(many, F.col("id").eqNullSafe(F.col("many")), "left_semi").join(others.withColumnRenamed("id", "other"), "hub").select("id", "other").distinct()
    rows = single.unionByName(several.groupBy("id").agg(F.count("other").alias("degree")))
    return _with_log(rows.select(F.lit(OBJECTS).alias("from_institution_id"), F.lit(ends[0]).alias("from_object_type"), F.col("id").alias("from_object_id"), F.lit(ends[1]).alias("to_object_type"), "degree"))


def ontology_degrees(scores: DataFrame, other: str, kind: str, inverse: bool = False) -> DataFrame:
    """Degrees between objects and concepts (or categories): scores has the node key
    and ``other``, each pair once."""
    if not inverse:
        rows = scores.groupBy(*NODE_KEY).agg(F.count("*").alias("degree"))
        return _with_log(rows.select(*(F.col(a).alias(b) for a, b in zip(NODE_KEY, FROM_KEY, strict=True)), F.lit(kind).alias("to_object_type"), "degree"))
    rows = scores.groupBy(other, "object_type").agg(F.count("*").alias("degree"))
    return _with_log(rows.select(F.lit(ONTOLOGY).alias("from_institution_id"), F.lit(kind).alias("from_object_type"), F.col(other).alias("from_object_id"), F.col("object_type").alias("to_object_type"), "degree"))


def slide_degrees(slide_edges: DataFrame) -> DataFrame:
    """Slides of each lecture."""
    rows = slide_edges.where("from_object_type = 'Slide'").groupBy(F.col("to_object_id").alias("from_object_id")).agg(F.count_distinct("from_object_id").alias("degree"))
    return _with_log(rows.select(F.lit(OBJECTS).alias("from_institution_id"), F.lit("Lecture").alias("from_object_type"), "from_object_id", F.lit("Slide").alias("to_object_type"), "degree"))


def max_log_degrees(combinations: DataFrame) -> DataFrame:
    return combinations.groupBy("from_object_type", "to_object_type").agg(F.max("log_degree").alias("max_log_degree"))


def normalised(combinations: DataFrame) -> DataFrame:
    """norm_log_degree: the log degree by the largest of its pair of types."""
    most = F.broadcast(max_log_degrees(combinations))  # a row for each pair of types
    return combinations.join(most, ["from_object_type", "to_object_type"]).withColumn("norm_log_degree", F.when(F.col("max_log_degree") > 0, F.col("log_degree") / F.col("max_log_degree"))).select(*COLUMNS, "norm_log_degree")


def degree_scores(normal: DataFrame, pairs=DEGREE_PAIRS) -> DataFrame:
    """Averages over an object's whitelisted pairs of types."""
    wanted = normal.sparkSession.createDataFrame(list(pairs), "from_object_type string, to_object_type string")
    own = normal.join(F.broadcast(wanted), ["from_object_type", "to_object_type"], "left_semi")
    got = own.groupBy(*FROM_KEY).agg(F.avg("degree").alias("avg_degree"), F.avg("log_degree").alias("avg_log_degree"), F.avg("norm_log_degree").alias("avg_norm_log_degree"))
    return got.select(*(F.col(a).alias(b) for a, b in zip(FROM_KEY, NODE_KEY, strict=True)), "avg_degree", "avg_log_degree", "avg_norm_log_degree")
