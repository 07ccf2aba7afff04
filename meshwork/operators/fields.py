"""Derived fields of objects and edges, as (key, field_language, field_name, field_value)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meshwork.config import RESEARCH_SUBTYPES
from meshwork.functions.scalars import as_date
from meshwork.schema import EDGE_KEY, FROM_KEY, NODE_KEY, ONTOLOGY


def field(frame: DataFrame, keys: list[str], name: str, value: Column) -> DataFrame:
    return frame.select(*keys, F.lit("n/a").alias("field_language"), F.lit(name).alias("field_name"), value.cast("string").alias("field_value"))


def node_degree(symmetric: DataFrame) -> DataFrame:
    """Neighbours of each concept in the symmetric graph."""
    got = symmetric.groupBy("from_id").agg(F.count("to_id").alias("n"))
    got = got.select(F.lit(ONTOLOGY).alias("institution_id"), F.lit("Concept").alias("object_type"), F.col("from_id").alias("object_id"), "n")
    return field(got, NODE_KEY, "node_degree", F.col("n"))


def ended_edges(edge_fields: DataFrame, as_of: str) -> DataFrame:
    """Edges with an end before ``as_of``; texts that are no date don't count."""
    return edge_fields.where((F.col("field_name") == "end_datetime") & (as_date("field_value") < F.lit(as_of).cast("date"))).select(EDGE_KEY).distinct()


def _active(edges: DataFrame, ended: DataFrame) -> DataFrame:
    joined = edges.join(ended.withColumn("_e", F.lit(True)), EDGE_KEY, "left")
    return joined.withColumn("active", F.col("_e").isNull().cast("int"))


def is_at_institution(edges: DataFrame, edge_fields: DataFrame, as_of: str) -> DataFrame:
    """1 for a person with any affiliation that has not ended."""
    own = edges.where("from_object_type = 'Person' AND to_object_type = 'Unit'").select(EDGE_KEY).distinct()
    got = _active(own, ended_edges(edge_fields, as_of)).groupBy(*FROM_KEY).agg(F.max("active").alias("v"))
    return field(got.select(*(F.col(a).alias(b) for a, b in zip(FROM_KEY, NODE_KEY, strict=True)), "v"), NODE_KEY, "is_at_institution", F.col("v"))


def is_active_affiliation(edges: DataFrame, edge_fields: DataFrame, as_of: str) -> DataFrame:
    """The same for each person-unit edge."""
    own = edges.where("from_object_type = 'Person' AND to_object_type = 'Unit'").select(EDGE_KEY).distinct()
    return field(_active(own, ended_edges(edge_fields, as_of)), EDGE_KEY, "is_active_affiliation", F.col("active"))


def is_active_unit(nodes: DataFrame, node_fields: DataFrame, as_of: str) -> DataFrame:
    """0 for a unit that was terminated, else 1."""
    gone = node_fields.where((F.col("field_name") == "date_terminated") & (as_date("field_value") < F.lit(as_of).cast("date"))).select(NODE_KEY).distinct().withColumn("_e", F.lit(True))
    got = nodes.where("object_type = 'Unit'").select(NODE_KEY).distinct().join(gone, NODE_KEY, "left")
    return field(got, NODE_KEY, "is_active_unit", F.col("_e").isNull().cast("int"))


def is_research_unit(nodes: DataFrame, node_fields: DataFrame, subtypes: tuple[str, ...] = RESEARCH_SUBTYPES) -> DataFrame:
    """1 for a unit of a research subtype; without a subtype 0."""
    subtype = node_fields.where("field_name = 'subtype' AND field_language = 'en'").select(*NODE_KEY, "field_value")
    got = nodes.where("object_type = 'Unit'").select(NODE_KEY).distinct().join(subtype, NODE_KEY, "left")
    return field(got, NODE_KEY, "is_research_unit", F.coalesce(F.col("field_value").isin(*subtypes), F.lit(False)).cast("int"))


def subtype_rank(node_fields: DataFrame, mappings: DataFrame) -> DataFrame:
    """The mapped rank of a unit's subtype; units without one have no row."""
    rank = mappings.where("context = 'subtype ranking'").select(F.col("from_field_value").alias("field_value"), F.col("to_field_value").alias("rank"))
    own = node_fields.where("object_type = 'Unit' AND field_name = 'subtype' AND field_language = 'en'")
    return field(own.join(F.broadcast(rank), "field_value"), NODE_KEY, "subtype_rank", F.col("rank"))


def latest_teaching_year(edge_fields: DataFrame) -> DataFrame:
    """The largest year, as text, of each course-person edge."""
    got = edge_fields.where("field_name = 'teaching_assignment_year'").groupBy(*EDGE_KEY).agg(F.max("field_value").alias("v"))
    return field(got, EDGE_KEY, "latest_teaching_assignment_year", F.col("v"))


def _history(history: DataFrame, persons: DataFrame, order: list[Column], name: str) -> DataFrame:
    w = Window.partitionBy("from_id", "to_id").orderBy(*order, F.col("row_id"))
    known = persons.select(F.col("object_id").try_cast("bigint").alias("_id")).where("_id IS NOT NULL").distinct()
    best = history.withColumn("_n", F.row_number().over(w)).where("_n = 1")
    best = best.withColumn("_id", F.col("from_id").try_cast("bigint")).join(known, "_id", "left_semi")
    return best.select("from_id", "to_id", F.lit(name).alias("field_name"), F.coalesce("position_name_en", "position_name_fr").alias("field_value"))


def last_position_name(history: DataFrame, persons: DataFrame) -> DataFrame:
    """The position that began last, of each person in each unit."""
    return _history(history, persons, [F.col("start_date").desc_nulls_last()], "last_position_name")


def longest_position_name(history: DataFrame, persons: DataFrame, as_of: str) -> DataFrame:
    """The position held longest; an open one lasts until ``as_of``."""
    days = F.datediff(F.coalesce("end_date", F.lit(as_of).cast("date")), F.col("start_date"))
    return _history(history, persons, [days.desc_nulls_last()], "longest_position_name")
