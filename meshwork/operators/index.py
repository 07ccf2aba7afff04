"""The search index: fields of documents and links, ranked links, nested documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meshwork.config import DEGREE_FACTORS, IndexConfig
from meshwork.functions.scalars import any_of, differs, rank_score
from meshwork.operators.views import mirrored, pivot_fields
from meshwork.schema import EDGE_KEY, FROM_KEY, NODE_KEY, TO_KEY, column_type

SEM_LINKS, ES_LINKS = 32, 16
LEAST_DEGREE = 0.001
DOC, LINK = ["doc_institution_id", "doc_type", "doc_id"], ["link_institution_id", "link_type", "link_id"]


def doc_fields(profiles: DataFrame, all_fields: DataFrame, degrees: DataFrame, doc_type: str, names: list[str]) -> DataFrame:
    """Index columns of one type's documents: its fields side by side and its degree score."""
    own = profiles.where(F.col("object_type") == doc_type).select(*NODE_KEY)
    wide = pivot_fields(all_fields.where(F.col("object_type") == doc_type), NODE_KEY, names)
    score = degrees.where(F.col("object_type") == doc_type).select(*NODE_KEY, "avg_norm_log_degree")
    joined = own.join(wide, NODE_KEY, "left").join(score, NODE_KEY, "left")
    typed = [F.col(n).try_cast(column_type(n)).alias(n) for n in names]
    return joined.select(*(F.col(a).alias(b) for a, b in zip(NODE_KEY, DOC, strict=True)), *typed, F.coalesce("avg_norm_log_degree", F.lit(LEAST_DEGREE)).alias("degree_score"))


def link_fields(edges: DataFrame, fields: DataFrame, doc_type: str, link_type: str, names: list[str]) -> DataFrame:
    """Index columns of parent-child links of a pair of types, in its sorted order.
    edges and fields: the symmetric ones."""
    a, b = sorted((doc_type, link_type))
    of_pair = (F.col("from_object_type") == a) & (F.col("to_object_type") == b)
    own = edges.where(of_pair).select(EDGE_KEY).distinct()
    wide = pivot_fields(fields.where(of_pair), EDGE_KEY, names)
    return own.join(wide, EDGE_KEY, "left").select(*EDGE_KEY, *(F.col(n).try_cast(column_type(n)).alias(n) for n in names))


def display_name(name: str, code: str, doc_type: str, config: IndexConfig) -> Column:
    """``code: name`` for types that show their code; null without a code there."""
    return F.concat(F.col(code), F.lit(": "), F.col(name)) if doc_type in config.code_in_name else F.col(name)


def doc_texts(docs: DataFrame, profiles: DataFrame, doc_type: str, config: IndexConfig) -> DataFrame:
    """Documents with names, short descriptions and subtypes of their profiles."""
    texts = profiles.where(F.col("object_type") == doc_type).select(*(F.col(a).alias(b) for a, b in zip(NODE_KEY, DOC, strict=True)), display_name("name_en_value", "short_code", doc_type, config).alias("name_en"), display_name("name_fr_value", "short_code", doc_type, config).alias("name_fr"), F.col("description_short_en_value").alias("description_en"), "subtype_en")
    return docs.join(texts, DOC)


def refresh_columns(rows: DataFrame, source: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Columns copied from another table are taken from it anew, where it has the key."""
    new = source.select(*keys, *(F.col(c).alias(f"_{c}") for c in columns), F.lit(True).alias("_hit"))
    joined = rows.join(new, keys, "left")
    return joined.select(*(F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in rows.columns))


def stale(rows: DataFrame, source: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """The rows that refresh_columns would change (null-safe)."""
    new = source.select(*keys, *(F.col(c).alias(f"_{c}") for c in columns))
    return rows.join(new, keys).where(any_of([differs(c, f"_{c}") for c in columns])).select(rows.columns)


def org_edges(edges: DataFrame, doc_type: str, link_type: str) -> DataFrame:
    """(doc, link) of symmetric parent-child edges."""
    own = edges.where((F.col("from_object_type") == doc_type) & (F.col("to_object_type") == link_type))
    return own.select(*(F.col(a).alias(b) for a, b in zip(FROM_KEY + TO_KEY, DOC + LINK, strict=True))).distinct()


def sem_edges(scores: DataFrame, doc_type: str, link_type: str) -> DataFrame:
    """(doc, link, semantic_score) of similarity scores, whichever way they lie."""
    both = scores.select(*EDGE_KEY, "score").unionByName(mirrored(scores.select(*EDGE_KEY, "score")))
    own = both.where((F.col("from_object_type") == doc_type) & (F.col("to_object_type") == link_type))
    return own.groupBy(*(F.col(a).alias(b) for a, b in zip(FROM_KEY + TO_KEY, DOC + LINK, strict=True))).agg(F.max("score").alias("semantic_score"))


def order_by(rules: list[tuple[str, str]], score: str) -> list[Column]:
    """Configured rules with their columns' types, then the score, then the id."""
    cols = []
    for name, way in rules:
        c = F.col(name).try_cast(column_type(name))
        cols.append(c.desc_nulls_last() if way.upper() == "DESC" else c.asc_nulls_first())
    return [*cols, F.col(score).desc_nulls_last(), F.col("link_id").asc()]


def rank_links(links: DataFrame, rules: list[tuple[str, str]], score: str, k: int | None = None) -> DataFrame:
    """Links with row_rank within their document and row_score; at most k of each
    document, cut on each partition before the shuffle."""
    w = Window.partitionBy(*DOC).orderBy(*order_by(rules, score))
    ranked = links.withColumn("row_rank", F.row_number().over(w))
    if k is not None:
        ranked = ranked.where(F.col("row_rank") <= k)
    return ranked.withColumn("row_score", rank_score("row_rank"))


def with_link_columns(links: DataFrame, link_docs: DataFrame, columns: list[str]) -> DataFrame:
    """Links beside some columns of the documents they lead to."""
    own = link_docs.select(*(F.col(a).alias(b) for a, b in zip(DOC, LINK, strict=True)), *columns)
    return links.join(own, LINK)


def mixed(org: DataFrame, sem: DataFrame) -> DataFrame:
    """Organisational links with their ranks, then semantic ones that are not among
    them, ranked after the last of their document. ORG rows bring their degree score."""
    keys = DOC + LINK
    a = org.select(*keys, F.col("degree_score").alias("score"), "row_rank", F.lit("ORG").alias("link_subtype"))
    last = org.groupBy(*DOC).agg(F.max("row_rank").alias("_last"))
    rest = sem.join(org.select(keys), keys, "left_anti").join(last, DOC, "left")
    b = rest.select(*keys, F.col("semantic_score").alias("score"), (F.col("row_rank") + F.coalesce("_last", F.lit(0))).alias("row_rank"), F.lit("SEM").alias("link_subtype"))
    return a.unionByName(b)


def es_links(links: DataFrame, docs: DataFrame, link_docs: DataFrame, link_type: str, config: IndexConfig, k: int = ES_LINKS) -> DataFrame:
    """Links for nested documents: of known documents, to link documents that pass
    the configured filters, up to rank k."""
    own = link_docs
    for predicate in config.link_filters.get(link_type, []):
        own = own.where(F.expr(predicate))
    known = docs.select(DOC).distinct()
    return links.where(F.col("row_rank") <= k).join(known, DOC, "left_semi").join(own.select(*(F.col(a).alias(b) for a, b in zip(DOC, LINK, strict=True))).distinct(), LINK, "left_semi")


def choose_links(kinds: dict[str, DataFrame]) -> DataFrame | None:
    """The mixed links if there are such, else the organisational, else the semantic."""
    return next((kinds[k] for k in ("MIX", "ORG", "SEM") if k in kinds), None)


def loose_ends(links: DataFrame, docs: DataFrame) -> DataFrame:
    """Links to documents that don't exist."""
    return links.join(docs.select(*(F.col(a).alias(b) for a, b in zip(DOC, LINK, strict=True))), LINK, "left_anti")


def nested_docs(docs: DataFrame, links: DataFrame, link_names: DataFrame, factors: dict[str, int] = DEGREE_FACTORS) -> DataFrame:
    """A row for each document with its texts by language and its links in order.

    links are cut to some rank before; so a document's list is bounded. link_names:
    the link documents' key (as DOC) and name_en, name_fr.
    """
    named = links.join(link_names.select(*(F.col(a).alias(b) for a, b in zip(DOC, LINK, strict=True)), F.col("name_en").alias("_en"), F.col("name_fr").alias("_fr")), LINK, "left")
    item = F.struct(F.col("row_rank").alias("link_rank"), "link_type", "link_id", F.struct(F.col("_en").alias("name")).alias("en"), F.struct(F.col("_fr").alias("name")).alias("fr"))
    lists = named.groupBy(*DOC).agg(F.sort_array(F.collect_list(item)).alias("links"))
    factor = F.lit(1)
    for kind, weight in factors.items():
        factor = F.when(F.col("doc_type") == kind, F.lit(weight)).otherwise(factor)
    empty = F.array().cast(lists.schema["links"].dataType)
    return docs.join(lists, DOC, "left").select(
        *DOC, "degree_score", (factor * F.col("degree_score")).alias("degree_score_factor"),
        F.struct(F.col("name_en").alias("name"), F.col("description_en").alias("description")).alias("en"),
        F.struct(F.col("name_fr").alias("name")).alias("fr"), F.coalesce("links", empty).alias("links"),
    )
