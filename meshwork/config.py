"""Settings that select types, fields, orders and filters; data, not code."""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations_with_replacement


@dataclass(frozen=True)
class IndexConfig:
    doc_types: tuple[str, ...]
    code_in_name: frozenset[str] = frozenset()
    doc_fields: dict[str, list] = field(default_factory=dict)
    link_fields: dict[str, dict] = field(default_factory=dict)  # by link type: obj, order
    pair_fields: dict[tuple[str, str], dict] = field(default_factory=dict)  # by (doc, link): obj2obj, order
    es_doc_fields: dict[str, list] = field(default_factory=dict)
    es_link_fields: dict[str, list] = field(default_factory=dict)
    doc_filters: dict[str, list[str]] = field(default_factory=dict)
    link_filters: dict[str, list[str]] = field(default_factory=dict)

    @staticmethod
    def flat(fields: list) -> list[str]:
        """Field names: ``name``, or ``name_lang`` for [lang, name]."""
        return [f if isinstance(f, str) else f"{f[1]}_{f[0]}" for f in fields]

    def order(self, doc: str, link: str) -> list[tuple[str, str]]:
        """Order rules of a link list: the pair's own, else the link type's."""
        own = self.pair_fields.get((doc, link), {})
        return [tuple(o) for o in own.get("order", self.link_fields.get(link, {}).get("order", []))]

    def es_fields(self, link: str) -> list[str]:
        """Fields of a link in a nested document; the last setting that names the type wins."""
        found = self.doc_fields.get(link, [])
        found = self.link_fields.get(link, {}).get("obj", found)
        found = self.es_doc_fields.get(link, found)
        return self.flat(self.es_link_fields.get(link, found))

    @classmethod
    def from_json(cls, text: dict) -> IndexConfig:
        links = text.get("fields", {}).get("links", {})
        return cls(
            tuple(text.get("doc-types", ())),
            frozenset(t for t, o in text.get("options", {}).get("docs", {}).items() if o.get("include_code_in_name")),
            text.get("fields", {}).get("docs", {}),
            links.get("default", {}),
            {(a, b): v for a, row in links.get("parent-child", {}).items() for b, v in row.items()},
            text.get("es-fields", {}).get("docs", {}),
            text.get("es-fields", {}).get("links", {}),
            text.get("es-filters", {}).get("docs", {}),
            text.get("es-filters", {}).get("links", {}),
        )


@dataclass(frozen=True)
class ScoreConfig:
    """Type pairs with similarity scores, by group."""

    groups: dict[str, list[tuple[str, str]]]

    def pairs(self) -> list[tuple[str, str]]:
        """All pairs, each sorted by name, once."""
        return sorted({tuple(sorted(p)) for g in self.groups.values() for p in g})


def types_to_process(node_types: list[str], edge_pairs: list[tuple[str, str]], config: IndexConfig) -> dict[str, list[tuple[str, str]]]:
    """Pairs to work on: of fields, the flagged edges that the configuration has as
    parent and child; of scores, all combinations of flagged node types."""
    known = {tuple(sorted(p)) for p in config.pair_fields}
    flagged = {tuple(sorted(p)) for p in edge_pairs}
    return {"fields": sorted(flagged & known), "scores": list(combinations_with_replacement(sorted(node_types), 2))}


#: Pairs whose degrees make up an object's degree score.  Fixed values.
DEGREE_PAIRS = (
    ("Category", "Course"), ("Category", "Lecture"), ("Category", "Person"), ("Category", "Publication"),
    ("Concept", "Course"), ("Concept", "Lecture"), ("Concept", "Publication"),
    ("Course", "Concept"), ("Course", "Lecture"),
    ("Lecture", "Concept"), ("Lecture", "Slide"),
    ("MOOC", "Concept"), ("MOOC", "Lecture"),
    ("Person", "Publication"), ("Publication", "Concept"), ("Startup", "Concept"),
    ("Unit", "Concept"), ("Unit", "Person"), ("Widget", "Concept"),
)

#: Weight of the degree score in a search document, by type.  Fixed values.
DEGREE_FACTORS = {"Course": 128, "Lecture": 128, "MOOC": 64, "Person": 128, "Publication": 1, "Startup": 64, "Unit": 64, "Widget": 64, "Category": 512, "Concept": 512}

#: (object type, calculation type, slot of the scoring matrix).  Fixed values.
SCORE_SLOTS = (
    ("Person", "concept detection on biography", 1),
    ("Course", "manual mapping on course page description", 1),
    ("Lecture", "LLM keyword extraction (bounded)", 1),
    ("MOOC", "slide sum-scores aggregation (bounded)", 1),
    ("Publication", "concept detection on abstract", 1),
    ("Startup", "concept detection on startup website", 1),
    ("Unit", "concept detection on unit website", 1),
    ("Widget", "concept detection on quiz description", 1),
    ("Category", "concept sum-scores aggregation (bounded)", 1),
    ("Person", "abstract sum-scores aggregation (bounded)", 2),
    ("Course", "slide sum-scores aggregation (bounded)", 2),
    ("Lecture", "slide sum-scores aggregation (bounded)", 2),
    ("MOOC", "people sum-scores aggregation (bounded)", 2),
    ("Unit", "manual mapping on unit website", 2),
    ("Course", "concept detection on course page description", 3),
    ("Unit", "abstract sum-scores aggregation (bounded)", 3),
)

#: Calculated scores that enter the union of all scores.  Fixed values.
UNION_CALCULATIONS = (
    ("Course", "slide sum-scores aggregation (bounded)"),
    ("Lecture", "slide sum-scores aggregation (bounded)"),
    ("Lecture", "LLM keyword extraction (bounded)"),
    ("MOOC", "slide sum-scores aggregation (bounded)"),
    ("MOOC", "people sum-scores aggregation (bounded)"),
    ("Person", "abstract sum-scores aggregation (bounded)"),
    ("Unit", "abstract sum-scores aggregation (bounded)"),
    ("Category", "concept sum-scores aggregation (bounded)"),
)

RESEARCH_SUBTYPES = ("Laboratory", "Group", "Chair", "Center", "Institute")

#: Scored pairs as delivered; a deployment may load its own.  Fixed values.
SCORES = ScoreConfig({
    "education": [("Course", "Course"), ("Course", "Lecture"), ("Course", "MOOC"), ("Lecture", "Lecture"), ("Lecture", "MOOC"), ("MOOC", "MOOC"), ("Widget", "Widget")],
    "research": [("Person", "Person"), ("Person", "Publication"), ("Person", "Startup"), ("Person", "Unit"), ("Publication", "Publication"), ("Publication", "Startup"), ("Publication", "Unit"), ("Startup", "Startup"), ("Startup", "Unit"), ("Unit", "Unit")],
})

#: Index settings as delivered; a deployment may load its own with from_json.  Fixed values.
INDEX = IndexConfig(
    doc_types=("Category", "Concept", "Course", "Lecture", "MOOC", "Person", "Publication", "Unit", "Widget"),
    code_in_name=frozenset({"Course", "Unit"}),
    doc_fields={"Category": ["depth"], "Course": ["latest_academic_year"], "Person": ["is_at_institution", "gender"], "Publication": ["year", "published_in", "publisher"], "Unit": ["is_active_unit", "is_research_unit", "subtype_rank"]},
    link_fields={"Category": {"order": [["depth", "DESC"]]}, "Course": {"order": [["latest_academic_year", "DESC"]]}, "Person": {"order": [["is_at_institution", "DESC"]]}, "Publication": {"obj": ["year", "published_in", "publisher"], "order": [["year", "DESC"]]}, "Unit": {"order": [["is_active_unit", "DESC"], ["is_research_unit", "DESC"]]}},
    pair_fields={
        ("Course", "Person"): {"obj2obj": ["latest_teaching_assignment_year"], "order": [["is_at_institution", "DESC"], ["latest_teaching_assignment_year", "DESC"]]},
        ("Person", "Course"): {"obj2obj": ["latest_teaching_assignment_year"], "order": [["is_at_institution", "DESC"], ["latest_teaching_assignment_year", "DESC"]]},
        ("Person", "Unit"): {"obj2obj": ["is_active_affiliation", "current_position_rank"], "order": [["is_active_affiliation", "DESC"], ["is_active_unit", "DESC"], ["is_research_unit", "DESC"]]},
        ("Unit", "Person"): {"obj2obj": ["is_active_affiliation", "current_position_rank"], "order": [["is_at_institution", "DESC"], ["is_active_affiliation", "DESC"], ["current_position_rank", "ASC"]]},
    },
    es_doc_fields={"Publication": ["year", "published_in", "publisher"], "Unit": ["is_active_unit", "is_research_unit"]},
    es_link_fields={"Category": [], "Person": [], "Publication": [], "Unit": []},
    link_filters={"Category": ["depth = 4"], "Person": ["is_at_institution = 1"], "Unit": ["is_active_unit = 1", "is_research_unit = 1"]},
)
