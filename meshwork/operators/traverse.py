"""Fixed-length traversals of the graph, materialised as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshwork.functions.scalars import at_least

KEPT_GROUPS = ("Professor", "Director", "Researcher")
LEAST = 0.1


def unit_person(edges: DataFrame, edge_fields: DataFrame, mappings: DataFrame, groups: tuple[str, ...] = KEPT_GROUPS) -> DataFrame:
    """Persons affiliated to units in positions of some groups, with the group's rank.
    The two mappings are small seed tables."""
    first = mappings.where("from_field_name = 'position_name' AND to_field_name = 'position_group'").select(F.col("from_field_value").alias("field_value"), F.col("to_field_value").alias("position_group"))
    second = mappings.where("from_field_name = 'position_group' AND to_field_name = 'position_rank'").select(F.col("from_field_value").alias("position_group"), F.col("to_field_value").alias("position_rank"))
    chain = F.broadcast(first.join(second, "position_group").where(F.col("position_group").isin(*groups)))
    names = edge_fields.where("from_object_type = 'Person' AND to_object_type = 'Unit'").where(F.col("field_name").isin("current_position_name", "last_position_name")).select("from_object_id", "to_object_id", "field_value")
    own = edges.where("from_object_type = 'Person' AND to_object_type = 'Unit'").select("from_object_id", "to_object_id").distinct()
    got = names.join(chain, "field_value").join(own, ["from_object_id", "to_object_id"])
    best = got.groupBy(F.col("to_object_id").alias("unit_id"), F.col("from_object_id").alias("person_id")).agg(F.min(F.struct("position_rank", "position_group")).alias("p"))
    return best.select("unit_id", "person_id", "p.position_group", "p.position_rank")


def person_publication(edges: DataFrame) -> DataFrame:
    return edges.where("from_object_type = 'Publication' AND to_object_type = 'Person' AND context = 'authorship'").select(F.col("to_object_id").alias("person_id"), F.col("from_object_id").alias("publication_id")).distinct()


def publication_concept(detections: DataFrame, least: float = LEAST) -> DataFrame:
    return detections.where("object_type = 'Publication' AND text_source = 'abstract'").where(at_least("score", least)).select(F.col("object_id").alias("publication_id"), "concept_id", "score")


def person_publication_concept(authorship: DataFrame, concepts: DataFrame) -> DataFrame:
    return authorship.join(concepts, "publication_id").select("person_id", "publication_id", "concept_id", "score")


def unit_publication_concept(affiliation: DataFrame, authorship: DataFrame, concepts: DataFrame) -> DataFrame:
    """A publication counts once for a unit, however many of its persons wrote it."""
    papers = affiliation.select("unit_id", "person_id").join(authorship, "person_id").select("unit_id", "publication_id").distinct()
    return papers.join(concepts, "publication_id").select("unit_id", "publication_id", "concept_id", "score")


def mooc_person_publication_concept(edges: DataFrame, written: DataFrame) -> DataFrame:
    """Concepts of the publications of a MOOC's teachers."""
    teachers = edges.where("from_object_type = 'MOOC' AND to_object_type = 'Person' AND context = 'teacher'").select(F.col("from_object_id").alias("mooc_id"), F.col("to_object_id").alias("person_id")).distinct()
    return teachers.join(written, "person_id").select("mooc_id", "person_id", "publication_id", "concept_id", "score")


def _by_hubs(moocs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(mooc_id, hub) of the MOOCs with one hub, and of those with several."""
    own = moocs.groupBy("id").agg(F.count("*").alias("n"), F.min("hub").alias("hub"))
    several = moocs.join(own.where("n > 1").select(F.col("id").alias("many")), F.col("id").eqNullSafe(F.col("many")), "left_semi")
    return own.where("n = 1").select(F.col("id").alias("mooc_id"), "hub"), several.select(F.col("id").alias("mooc_id"), "hub")


def mooc_concepts_by_hubs(moocs: DataFrame, teachers: DataFrame, written: DataFrame) -> DataFrame:
    """As ``mooc_person_publication_concept``, from the ends' hubs (id, hub, without repeats)
    instead of their edges: what was written goes to its hubs, so edges are never shuffled."""
    single, several = _by_hubs(moocs)
    persons = teachers.withColumnRenamed("id", "person_id")
    one = single.join(persons.join(written, "person_id"), "hub")
    edges = several.join(persons, "hub").select("mooc_id", "person_id").distinct()
    cols = ["mooc_id", "person_id", "publication_id", "concept_id", "score"]
    return one.select(cols).unionByName(edges.join(written, "person_id").select(cols))


def mooc_sums_by_hubs(moocs: DataFrame, teachers: DataFrame, written: DataFrame) -> DataFrame:
    """mooc_id, concept_id and the summed score of what a MOOC's teachers wrote: summed
    once for each person and hub, which all MOOCs of one hub share."""
    single, several = _by_hubs(moocs)
    own = written.groupBy("person_id", "concept_id").agg(F.sum("score").alias("score"))
    persons = teachers.withColumnRenamed("id", "person_id")
    sums = persons.join(own, "person_id").groupBy("hub", "concept_id").agg(F.sum("score").alias("score"))
    one = single.join(sums, "hub").select("mooc_id", "concept_id", "score")
    edges = several.join(persons, "hub").select("mooc_id", "person_id").distinct()
    rest = edges.join(own, "person_id").groupBy("mooc_id", "concept_id").agg(F.sum("score").alias("score"))
    return one.unionByName(rest)


def lecture_timestamps(slides: DataFrame, detections: DataFrame, stamps: DataFrame) -> DataFrame:
    """The largest score of each concept at each time stamp of a slide in a lecture.
    slides: slide_id, lecture_id; stamps: slide_id, lecture_id, timestamp."""
    own = detections.where("object_type = 'Slide'").select(F.col("object_id").alias("slide_id"), "concept_id", "score")
    return slides.join(stamps, ["slide_id", "lecture_id"]).join(own, "slide_id").groupBy("lecture_id", "slide_id", "concept_id", "timestamp").agg(F.max("score").alias("score"))


def ontology_subset(seeds: DataFrame, category_tree: DataFrame, category_cluster: DataFrame, cluster_concept: DataFrame, root: str, hops: int = 3) -> DataFrame:
    """Categories above some concepts: their own, their ancestors up to ``hops``, and
    the root. Category trees are small; each hop is one join."""
    own = cluster_concept.join(seeds.select(F.col("id").alias("to_id")), "to_id", "left_semi").select(F.col("from_id").alias("to_id")).distinct()
    level = category_cluster.join(own, "to_id", "left_semi").select(F.col("from_id").alias("id")).distinct()
    found = level
    for _ in range(hops):
        level = category_tree.join(level.withColumnRenamed("id", "from_id"), "from_id", "left_semi").select(F.col("to_id").alias("id")).distinct()
        found = found.union(level)
    return found.union(seeds.sparkSession.createDataFrame([(root,)], "id string")).distinct()


def touching(edges: DataFrame, ids: DataFrame, a: str = "from_id", b: str = "to_id") -> DataFrame:
    """Edges with either end among some ids: two semi joins and a union in place of a
    join with OR, which would compare all pairs."""
    one = edges.join(ids.select(F.col("id").alias(a)), a, "left_semi").select(edges.columns)
    other = edges.join(ids.select(F.col("id").alias(b)), b, "left_semi").select(edges.columns)
    return one.union(other).distinct()
