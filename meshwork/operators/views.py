"""Materialised views over the schemas: symmetric fields and edges, all fields, profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meshwork.schema import EDGE_KEY, FROM_KEY, NODE_KEY, TO_KEY


def mirrored(rows: DataFrame) -> DataFrame:
    """The rows with both ends exchanged."""
    swap = dict(zip(FROM_KEY + TO_KEY, TO_KEY + FROM_KEY, strict=True))
    return rows.select(*(F.col(swap[c]).alias(c) if c in swap else F.col(c) for c in rows.columns))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def symmetric_fields(edge_fields: list[DataFrame], calculated: DataFrame | None = None) -> DataFrame:
    """Edge fields of all schemas and the calculated ones, in both directions."""
    keys = [*EDGE_KEY, "field_language", "field_name"]
    frames = [f.select(*keys, "field_value") for f in edge_fields + ([calculated] if calculated is not None else [])]
    rows = _union(frames)
    both = rows.unionByName(mirrored(rows))
    return both.groupBy(*keys).agg(F.max("field_value").alias("field_value"))


def page_profiles(profiles: list[DataFrame]) -> DataFrame:
    """Profiles of all schemas, marked to be processed."""
    return _union(profiles).withColumn("to_process", F.lit(1))


def all_fields(node_fields: list[DataFrame], calculated: DataFrame) -> DataFrame:
    """Node fields of all schemas; where a calculated one has the same key, it wins."""
    keys = [*NODE_KEY, "field_language", "field_name"]
    rows = _union([f.select(*keys, "field_value", F.lit(i).alias("_from")) for i, f in enumerate([*node_fields, calculated])])
    w = Window.partitionBy(*keys).orderBy(F.col("_from").desc(), F.col("field_value").desc_nulls_last())
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "_from")


def parent_child_symmetric(edges: list[DataFrame]) -> DataFrame:
    """Edges as Child-to-Parent and, mirrored with a marked context, Parent-to-Child."""
    rows = _union([e.select(*EDGE_KEY, "context") for e in edges])
    down = mirrored(rows).withColumns({"edge_type": F.lit("Parent-to-Child"), "context": F.concat("context", F.lit(" (mirror)"))})
    return rows.withColumn("edge_type", F.lit("Child-to-Parent")).unionByName(down)


def ontology_nodes(categories: DataFrame, concepts: DataFrame) -> DataFrame:
    return categories.unionByName(concepts, allowMissingColumns=True)


def ontology_edges(category_tree: DataFrame, category_cluster: DataFrame, cluster_concept: DataFrame) -> DataFrame:
    """Concept to category through its cluster, and category to category."""
    through = category_cluster.select(F.col("from_id").alias("category"), F.col("to_id").alias("cluster")).join(cluster_concept.select(F.col("from_id").alias("cluster"), F.col("to_id").alias("concept")), "cluster")
    a = through.select(F.lit("Concept").alias("from_object_type"), F.col("concept").alias("from_object_id"), F.lit("Category").alias("to_object_type"), F.col("category").alias("to_object_id"))
    b = category_tree.select(F.lit("Category").alias("from_object_type"), F.col("from_id").alias("from_object_id"), F.lit("Category").alias("to_object_type"), F.col("to_id").alias("to_object_id"))
    return a.unionByName(b)


def pivot_fields(fields: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Wide columns from (key, field_language, field_name, field_value): ``name`` of
    language n/a, ``name_lang`` else; one shuffle however many columns."""
    flat = F.when(F.col("field_language") == "n/a", F.col("field_name")).otherwise(F.concat_ws("_", "field_name", "field_language"))
    own = fields.select(*keys, flat.alias("_f"), "field_value").where(F.col("_f").isin(*names))
    return own.groupBy(*keys).agg(*(F.max(F.when(F.col("_f") == n, F.col("field_value"))).alias(n) for n in names))
