"""Keys, schemas and names of the graph model."""

from __future__ import annotations

import re

from pyspark.sql import types as T

NODE_KEY = ["institution_id", "object_type", "object_id"]
FROM_KEY = [f"from_{c}" for c in NODE_KEY]
TO_KEY = [f"to_{c}" for c in NODE_KEY]
EDGE_KEY = FROM_KEY + TO_KEY
TYPE_PAIR = ["from_object_type", "to_object_type"]
STATE = ["checksum_current", "checksum_previous", "has_changed", "last_date_cached", "has_expired", "to_process"]

#: Objects of the ontology carry their own institution.
ONTOLOGY, OBJECTS = "Ont", "TST"
OBJECT_TYPES = ("Category", "Concept", "Course", "Lecture", "MOOC", "Person", "Publication", "Slide", "Specialisation", "Startup", "StudyPlan", "Transcript", "Unit", "Widget")
ONTOLOGY_TYPES = ("Category", "Concept")
LECTURE_TYPES = ("Lecture", "Slide", "Transcript")
#: Types that synchronisation leaves out.
UNSYNCED_TYPES = ("Slide", "Transcript")


def institution_of(object_type: str, objects: str = OBJECTS) -> str:
    return ONTOLOGY if object_type in ONTOLOGY_TYPES else objects


def schema_slot(*object_types: str) -> str:
    """The schema an object or an edge lies in: lectures if either end does."""
    if any(t in LECTURE_TYPES for t in object_types):
        return "lectures"
    return "ontology" if all(t in ONTOLOGY_TYPES for t in object_types) else "registry"


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


_STATE = [*_strings("checksum_current", "checksum_previous"), T.StructField("has_changed", T.IntegerType()), T.StructField("last_date_cached", T.DateType()), T.StructField("has_expired", T.IntegerType()), T.StructField("to_process", T.IntegerType())]
_SCORE = [T.StructField("score", T.DoubleType())]
_TIMES = [T.StructField(n, T.TimestampNTZType()) for n in ("record_created_date", "record_updated_date")]

LANGUAGES = ("en", "fr", "de", "it")
PROFILE_TEXTS = ("name", "description_short", "description_medium", "description_long")


def page_profile_fields() -> list[T.StructField]:
    """The wide profile: languages x texts x their attributes, then the keys."""
    fields = _strings(*NODE_KEY, "short_code", "subtype_en", "subtype_fr")
    for text in PROFILE_TEXTS:
        for lang in LANGUAGES:
            fields += [*_strings(f"{text}_{lang}_value"), *(T.StructField(f"{text}_{lang}_{a}", T.IntegerType()) for a in ("is_auto_generated", "is_auto_corrected", "is_auto_translated")), *_strings(f"{text}_{lang}_translated_from")]
    for stem in ("numeric_id", "external_key", "external_url"):
        fields += _strings(*(f"{stem}_{lang}" for lang in LANGUAGES))
    return [*fields, T.StructField("is_visible", T.IntegerType())]


TABLES: dict[str, T.StructType] = {
    "nodes": T.StructType([*_strings(*NODE_KEY, "object_title", "text_source", "raw_text"), *_TIMES]),
    "edges": T.StructType([*_strings(*EDGE_KEY, "context"), *_TIMES]),
    "node_fields": T.StructType(_strings(*NODE_KEY, "field_language", "field_name", "field_value")),
    "edge_fields": T.StructType(_strings(*EDGE_KEY, "context", "field_language", "field_name", "field_value")),
    "page_profile": T.StructType(page_profile_fields()),
    "detections": T.StructType([*_strings(*NODE_KEY, "concept_id", "text_source"), *_SCORE]),
    "manual_mapping": T.StructType([*_strings(*NODE_KEY, "concept_id", "text_source"), *_SCORE]),
    "llm_tags": T.StructType([*_strings(*NODE_KEY, "concept_id"), *_SCORE]),
    "mappings": T.StructType(_strings("from_object_type", "from_field_name", "from_field_value", "to_object_type", "to_field_name", "to_field_value", "context")),
    "id_map": T.StructType(_strings(*EDGE_KEY, "context")),
    "category_tree": T.StructType(_strings("from_id", "to_id")),
    "category_cluster": T.StructType(_strings("from_id", "to_id")),
    "cluster_concept": T.StructType(_strings("from_id", "to_id")),
    "concept_symmetric": T.StructType([*_strings("from_id", "to_id"), *_SCORE]),
    "concept_undirected": T.StructType([*_strings("from_id", "to_id"), *_SCORE, T.StructField("normalised_score", T.DoubleType())]),
    "embeddings": T.StructType([*_strings(*NODE_KEY), T.StructField("embedding", T.ArrayType(T.FloatType()))]),
    "fields_changed": T.StructType([*_strings(*NODE_KEY), *_STATE]),
    "edge_fields_changed": T.StructType([*_strings(*EDGE_KEY), *_STATE]),
    "scores_expired": T.StructType([*_strings(*NODE_KEY), *_STATE[3:]]),
    "type_flags": T.StructType([*_strings("institution_id", "object_type", "flag_type"), T.StructField("to_process", T.IntegerType())]),
    "edge_type_flags": T.StructType([*_strings("from_institution_id", "from_object_type", "to_institution_id", "to_object_type", "flag_type"), T.StructField("to_process", T.IntegerType())]),
}

#: Columns that identify a row of each table.
KEYS: dict[str, list[str]] = {
    "nodes": NODE_KEY, "edges": [*EDGE_KEY, "context"], "node_fields": [*NODE_KEY, "field_language", "field_name"],
    "edge_fields": [*EDGE_KEY, "context", "field_language", "field_name"], "page_profile": NODE_KEY,
    "detections": [*NODE_KEY, "concept_id", "text_source"], "manual_mapping": [*NODE_KEY, "concept_id", "text_source"], "llm_tags": [*NODE_KEY, "concept_id"],
    "category_tree": ["from_id", "to_id"], "category_cluster": ["from_id", "to_id"], "cluster_concept": ["from_id", "to_id"],
    "concept_symmetric": ["from_id", "to_id"], "concept_undirected": ["from_id", "to_id"], "fields_changed": NODE_KEY, "edge_fields_changed": EDGE_KEY, "scores_expired": NODE_KEY,
}

#: SQL types of columns whose name alone fixes them; anything else is text.
COLUMN_TYPES = {
    "score": "double", "row_score": "double", "degree_score": "double", "semantic_score": "double", "row_rank": "int", "link_rank": "int",
    "year": "int", "depth": "int", "video_duration": "int", "latest_academic_year": "int", "latest_teaching_assignment_year": "int", "sort_number": "int", "subtype_rank": "int", "current_position_rank": "int",
    "is_restricted": "int", "is_at_institution": "int", "is_active_unit": "int", "is_research_unit": "int", "is_active_affiliation": "int",
}


def column_type(name: str) -> str:
    return COLUMN_TYPES.get(name, "string")


_GRAMMAR = (
    ("similarity", r"Edges_N_(?P<from>[A-Za-z]+)_N_(?P<to>[A-Za-z]+)_T_(?:GBC|AS)"),
    ("object_to_concept", r"Edges_N_(?P<from>[A-Za-z]+)_N_Concept_T_[A-Za-z]+"),
    ("object_to_object", r"(?:Edges|Data|Stats)_N_(?P<from>[A-Za-z]+)_N_(?P<to>[A-Za-z]+)_T_[A-Za-z]+"),
    ("profile", r"Data_N_(?P<doc>[A-Za-z]+)_T_PageProfile"),
    ("object", r"(?:Data|Stats|Nodes)_N_(?P<doc>[A-Za-z]+)(?:_T_[A-Za-z]+)?"),
    ("link_index", r"Index_D_(?P<doc>[A-Za-z]+)_L_(?P<link>[A-Za-z]+)_T_(?P<subtype>ORG|SEM|MIX)(?:_Search)?"),
    ("doc_index", r"Index_D_(?P<doc>[A-Za-z]+)"),
    ("link_index", r"IndexBuildup_Fields_Links_ParentChild_(?P<doc>[A-Za-z]+)_(?P<link>[A-Za-z]+)"),
    ("doc_index", r"IndexBuildup_Fields_Docs_(?P<doc>[A-Za-z]+)"),
)


def classify(table_name: str) -> tuple[str, dict[str, str]] | None:
    """(kind, types in the name) of a table by the grammar of its name."""
    name = table_name.removesuffix("_COPY")
    for kind, pattern in _GRAMMAR:
        if m := re.fullmatch(pattern, name):
            return kind, {k: v for k, v in m.groupdict().items() if v}
    return None


def link_table(doc: str, link: str, subtype: str) -> str:
    return f"Index_D_{doc}_L_{link}_T_{subtype}"
