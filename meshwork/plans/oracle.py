"""The graph's tables as DuckDB SQL, to check results against.

Written apart from the DataFrame code, from the operators' definitions.
``sql(body)`` puts the views that a statement names before it.
"""

from __future__ import annotations

import re

SIGMA = "(2e0 / (1 + exp(-({x}) / (4 * ({a})))) - 1)"


def sigma(x: str, a: str) -> str:
    return SIGMA.format(x=x, a=a)


def least(x: str, bound: float) -> str:
    return f"round({x}, 9) >= CAST({bound} AS DOUBLE)"


V: dict[str, str] = {
    "v_parts": "SELECT p_partkey, p_type, p_brand, p_type || '/' || p_brand AS concept_id FROM part",
    "v_affil": "SELECT CAST(c_custkey AS VARCHAR) AS person_id, CAST(c_nationkey AS VARCHAR) AS unit_id, c_mktsegment, c_custkey FROM customer",
    "v_author": "SELECT CAST(o_custkey AS VARCHAR) AS person_id, CAST(o_orderkey AS VARCHAR) AS publication_id FROM orders",
    "v_det": "SELECT CAST(l_orderkey AS VARCHAR) AS publication_id, concept_id, least(1e0, sum(l_quantity) / 100) AS score FROM lineitem JOIN v_parts ON l_partkey = p_partkey GROUP BY ALL",
    "v_slide": "SELECT CAST(l_suppkey AS VARCHAR) || '-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) AS slide_id, CAST(l_suppkey AS VARCHAR) || '-' || CAST(l_orderkey AS VARCHAR) AS lecture_id, CAST(l_suppkey AS VARCHAR) AS course_id, concept_id, least(1e0, max(l_quantity) / 100) AS score FROM lineitem JOIN v_parts ON l_partkey = p_partkey GROUP BY ALL",
    "v_manual": "SELECT CAST(l_suppkey AS VARCHAR) AS course_id, concept_id FROM lineitem JOIN v_parts ON l_partkey = p_partkey GROUP BY ALL HAVING count(*) >= 6",
    "v_cc": "SELECT DISTINCT p_type AS category_id, p_type || '#' || CAST(CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INT) % 5 AS VARCHAR) AS cluster, concept_id FROM v_parts",
    "v_pairs": "SELECT a.concept_id AS from_id, b.concept_id AS to_id, count(*) AS n FROM v_det a JOIN v_det b ON a.publication_id = b.publication_id AND a.concept_id <> b.concept_id GROUP BY ALL",
    "v_sym": "SELECT from_id, to_id, n / (SELECT max(n) FROM v_pairs) / 10 AS score FROM v_pairs",
    "v_undir": "SELECT from_id, to_id, n / (SELECT max(n) FROM v_pairs) AS normalised_score FROM v_pairs WHERE from_id < to_id",
    "v_positions": "SELECT * FROM (VALUES ('BUILDING', 'Professor', '1'), ('MACHINERY', 'Director', '2'), ('AUTOMOBILE', 'Researcher', '3'), ('FURNITURE', 'Staff', '4'), ('HOUSEHOLD', 'Student', '5')) t(name, grp, rank)",
    "v_last": "SELECT o_custkey, strftime(max(o_orderdate), '%Y-%m-%d') AS last FROM orders GROUP BY ALL",
    "v_end": "SELECT person_id, unit_id, CASE WHEN c_custkey % 97 = 0 THEN 'unknown' ELSE last END AS field_value FROM v_affil LEFT JOIN v_last ON o_custkey = c_custkey WHERE last < '2001-01-01' OR c_custkey % 97 = 0",
    "v_ended": "SELECT DISTINCT person_id, unit_id FROM v_end WHERE TRY_CAST(field_value AS DATE) < DATE '2001-08-02'",
    "v_subtype": "SELECT CAST(n_nationkey AS VARCHAR) AS unit_id, ['Laboratory', 'Group', 'School', 'Center', 'Service'][n_nationkey % 5 + 1] AS subtype, CASE n_nationkey % 4 WHEN 0 THEN '2000-01-01' WHEN 1 THEN '2005-01-01' END AS terminated FROM nation",
    "v_units": "SELECT CAST(n_nationkey AS VARCHAR) AS unit_id FROM nation UNION ALL SELECT 'R' || CAST(r_regionkey AS VARCHAR) FROM region",
    "v_active": "SELECT unit_id, CAST(coalesce(terminated < '2001-08-02', false) = false AS INT) AS active, CAST(coalesce(subtype IN ('Laboratory', 'Group', 'Chair', 'Center', 'Institute'), false) AS INT) AS research FROM v_units LEFT JOIN v_subtype USING (unit_id)",
    "v_teach": "SELECT DISTINCT CAST(s_suppkey AS VARCHAR) AS mooc_id, CAST(c_custkey AS VARCHAR) AS person_id FROM supplier JOIN customer ON s_nationkey = c_nationkey WHERE c_custkey % 10 = 0",
    "v_years": "SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS course_id, CAST(o_custkey AS VARCHAR) AS person_id, CAST(year(l_shipdate) AS VARCHAR) AS y FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    "v_nodes": """SELECT 'Unit' AS object_type, unit_id AS object_id FROM v_units UNION ALL SELECT 'Person', CAST(c_custkey AS VARCHAR) FROM customer
        UNION ALL SELECT 'Publication', CAST(o_orderkey AS VARCHAR) FROM orders UNION ALL SELECT 'Course', CAST(s_suppkey AS VARCHAR) FROM supplier
        UNION ALL SELECT 'MOOC', CAST(s_suppkey AS VARCHAR) FROM supplier UNION ALL SELECT DISTINCT 'Concept', concept_id FROM v_parts UNION ALL SELECT DISTINCT 'Category', p_type FROM part""",
    "v_edges": """SELECT 'Person' AS from_object_type, person_id AS from_object_id, 'Unit' AS to_object_type, unit_id AS to_object_id, 'affiliation' AS context FROM v_affil
        UNION ALL SELECT 'Publication', publication_id, 'Person', person_id, 'authorship' FROM v_author
        UNION ALL SELECT 'Unit', CAST(n_nationkey AS VARCHAR), 'Unit', 'R' || CAST(n_regionkey AS VARCHAR), 'parent unit' FROM nation
        UNION ALL SELECT 'Course', CAST(s_suppkey AS VARCHAR), 'Unit', CAST(s_nationkey AS VARCHAR), 'offered by' FROM supplier
        UNION ALL SELECT 'MOOC', mooc_id, 'Person', person_id, 'teacher' FROM v_teach""",
    "v_efields": "SELECT person_id, unit_id, 'end_datetime' AS field_name, field_value FROM v_end UNION ALL SELECT person_id, unit_id, 'current_position_name', c_mktsegment FROM v_affil",
    "v_nfields": """SELECT 'Person' AS object_type, CAST(c_custkey AS VARCHAR) AS object_id, 'n/a' AS field_language, 'segment' AS field_name, c_mktsegment AS field_value FROM customer
        UNION ALL SELECT 'Person', CAST(c_custkey AS VARCHAR), 'n/a', 'balance', CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) FROM customer
        UNION ALL SELECT 'Publication', CAST(o_orderkey AS VARCHAR), 'n/a', 'year', CAST(year(o_orderdate) AS VARCHAR) FROM orders
        UNION ALL SELECT 'Publication', CAST(o_orderkey AS VARCHAR), 'n/a', 'published_in', o_orderpriority FROM orders
        UNION ALL SELECT 'Publication', CAST(o_orderkey AS VARCHAR), 'n/a', 'publisher', o_orderstatus FROM orders
        UNION ALL SELECT 'Unit', unit_id, 'en', 'subtype', subtype FROM v_subtype
        UNION ALL SELECT 'Unit', unit_id, 'n/a', 'date_terminated', terminated FROM v_subtype WHERE terminated IS NOT NULL""",
    "v_state": """SELECT object_type, CAST(k AS VARCHAR) AS object_id, k, 'c' || CAST(k % 7 AS VARCHAR) AS checksum_current, CASE WHEN k % 5 <> 0 THEN 'c' || CAST(k % 3 AS VARCHAR) END AS checksum_previous, 0 AS has_changed, CASE WHEN k % 11 <> 0 THEN CAST(t AS DATE) END AS last_date_cached, 0 AS has_expired, CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END AS to_process
        FROM (SELECT 'Person' AS object_type, o_custkey AS k, max(o_orderdate) AS t FROM orders GROUP BY ALL UNION ALL SELECT 'Publication', o_orderkey, o_orderdate FROM orders UNION ALL SELECT 'Course', l_suppkey, max(l_shipdate) FROM lineitem GROUP BY ALL)""",
    "v_old": "SELECT *, last_date_cached IS NULL OR last_date_cached < DATE '2001-08-02' - INTERVAL 90 DAY AS old FROM v_state",
    "v_expired": "SELECT * EXCLUDE (has_expired, old, n), CAST(old AND n <= 100 AS INT) AS has_expired FROM (SELECT *, row_number() OVER (PARTITION BY object_type, old ORDER BY last_date_cached ASC NULLS FIRST, object_id) AS n FROM v_old)",
    "v_fresh": "SELECT * EXCLUDE (has_changed, to_process), CAST(checksum_current IS DISTINCT FROM checksum_previous AS INT) AS has_changed, CAST(checksum_current IS DISTINCT FROM checksum_previous OR has_expired = 1 OR last_date_cached IS NULL AS INT) AS to_process FROM v_expired",
    # traversals
    "v_g1": "SELECT unit_id, person_id, grp AS position_group, rank AS position_rank FROM v_affil JOIN v_positions ON name = c_mktsegment WHERE grp IN ('Professor', 'Director', 'Researcher')",
    "v_g3": f"SELECT * FROM v_det WHERE {least('score', 0.1)}",
    "v_g4": "SELECT person_id, publication_id, concept_id, score FROM v_author JOIN v_g3 USING (publication_id)",
    "v_g5": "SELECT unit_id, publication_id, concept_id, score FROM (SELECT DISTINCT unit_id, publication_id FROM v_g1 JOIN v_author USING (person_id)) JOIN v_g3 USING (publication_id)",
    # scores
    "v_k1raw": "SELECT course_id, concept_id, sum(score) AS score FROM v_slide GROUP BY ALL",
    "v_k1": f"SELECT course_id, concept_id, {sigma('score', f'(SELECT coalesce(avg(score), 1) FROM v_k1raw WHERE {least("score", 1)})')} AS score FROM v_k1raw WHERE {least('score', 1)}",
    "v_k5raw": f"SELECT person_id, concept_id, sum(score) AS score FROM v_g4 GROUP BY ALL HAVING {least('sum(score)', 0.1)}",
    "v_k5": f"SELECT person_id, concept_id, {sigma('score', '(SELECT coalesce(avg(score), 1) FROM v_k5raw)')} AS score FROM v_k5raw",
    "v_k6raw": f"SELECT unit_id, concept_id, sum(score) AS score FROM v_g5 GROUP BY ALL HAVING {least('sum(score)', 1)}",
    "v_k6": f"SELECT unit_id, concept_id, {sigma('score', '(SELECT coalesce(avg(score), 1) FROM v_k6raw JOIN v_active USING (unit_id) WHERE active = 1 AND research = 1)')} AS score FROM v_k6raw",
    "v_k7raw": f"SELECT category_id, to_id AS concept_id, sum(score) AS score FROM v_cc JOIN v_sym ON from_id = concept_id GROUP BY ALL HAVING {least('sum(score)', 0.1)}",
    "v_k7": f"SELECT category_id, concept_id, {sigma('score', f'(SELECT coalesce(avg(score), 1) FROM v_k7raw WHERE {least("score", 1)})')} AS score FROM v_k7raw",
    "v_k8": f"""SELECT 'Course' AS object_type, course_id AS object_id, concept_id, 'slide sum-scores aggregation (bounded)' AS calculation_type, score FROM v_k1 WHERE {least('score', 0.1)}
        UNION ALL SELECT 'Person', person_id, concept_id, 'abstract sum-scores aggregation (bounded)', score FROM v_k5 WHERE {least('score', 0.1)}
        UNION ALL SELECT 'Unit', unit_id, concept_id, 'abstract sum-scores aggregation (bounded)', score FROM v_k6 WHERE {least('score', 0.1)}
        UNION ALL SELECT 'Category', category_id, concept_id, 'concept sum-scores aggregation (bounded)', score FROM v_k7 WHERE {least('score', 0.1)}
        UNION ALL SELECT 'Publication', publication_id, concept_id, 'concept detection on abstract', score FROM v_det WHERE {least('score', 0.1)}
        UNION ALL SELECT 'Course', course_id, concept_id, 'manual mapping on course page description', 1e0 FROM v_manual""",
    "v_k9": """SELECT object_type, object_id, concept_id,
        max(score) FILTER ((object_type = 'Course' AND calculation_type LIKE 'manual%') OR object_type IN ('Publication', 'Category')) AS score_1,
        max(score) FILTER (object_type = 'Person' OR (object_type = 'Course' AND calculation_type LIKE 'slide%')) AS score_2,
        max(score) FILTER (object_type = 'Unit') AS score_3 FROM v_k8 GROUP BY ALL""",
    "v_k10": "SELECT object_type, object_id, concept_id, 2e0 / (1 + exp(-2 * (coalesce(score_1, 0) + coalesce(score_2, 0) + coalesce(score_3, 0)))) - 1 AS score FROM v_k9",
    "v_k11": f"""SELECT object_type, object_id, category_id, sum(score) AS score FROM v_k10 JOIN v_cc USING (concept_id) WHERE object_type IN ('Person', 'Publication', 'Unit', 'Course') GROUP BY ALL
        HAVING {least('sum(score)', 1)} OR (object_type = 'Course' AND {least('sum(score)', 0.1)})""",
    "v_k12": "SELECT object_type, avg(score) AS avg_score FROM v_k11 GROUP BY ALL",
    "v_k13": f"SELECT object_type, object_id, category_id, {sigma('score', 'avg_score')} AS score FROM v_k11 JOIN v_k12 USING (object_type)",
    # degrees
    "v_n1": """SELECT from_object_type, from_object_id, to_object_type, count(DISTINCT to_object_id) AS degree FROM v_edges GROUP BY ALL
        UNION ALL SELECT to_object_type, to_object_id, from_object_type, count(DISTINCT from_object_id) FROM v_edges WHERE from_object_type <> to_object_type GROUP BY ALL
        UNION ALL SELECT object_type, object_id, 'Concept', count(*) FROM v_k10 GROUP BY ALL
        UNION ALL SELECT 'Concept', concept_id, object_type, count(*) FROM v_k10 GROUP BY ALL
        UNION ALL SELECT object_type, object_id, 'Category', count(*) FROM v_k13 GROUP BY ALL
        UNION ALL SELECT 'Category', category_id, object_type, count(*) FROM v_k13 GROUP BY ALL""",
    "v_n4": "SELECT *, ln(1 + degree) AS log_degree, CASE WHEN max(ln(1 + degree)) OVER w > 0 THEN ln(1 + degree) / max(ln(1 + degree)) OVER w END AS norm_log_degree FROM v_n1 WINDOW w AS (PARTITION BY from_object_type, to_object_type)",
    "v_n5": """SELECT from_object_type AS object_type, from_object_id AS object_id, avg(degree) AS avg_degree, avg(log_degree) AS avg_log_degree, avg(norm_log_degree) AS avg_norm_log_degree FROM v_n4
        WHERE from_object_type || '>' || to_object_type IN ('Category>Course', 'Category>Lecture', 'Category>Person', 'Category>Publication', 'Concept>Course', 'Concept>Lecture', 'Concept>Publication', 'Course>Concept', 'Course>Lecture', 'Lecture>Concept', 'Lecture>Slide', 'MOOC>Concept', 'MOOC>Lecture', 'Person>Publication', 'Publication>Concept', 'Startup>Concept', 'Unit>Concept', 'Unit>Person', 'Widget>Concept') GROUP BY ALL""",
    # similarity
    # numbers stand for the objects, in the order of (type, id)
    "v_scored": f"SELECT object_type, object_id, concept_id, score FROM v_k10 WHERE {least('score', 0.1)}",
    "v_numbers": "SELECT object_type, object_id, CAST(row_number() OVER (ORDER BY object_type, object_id) AS INTEGER) AS i FROM (SELECT DISTINCT object_type, object_id FROM v_scored WHERE object_type IN ('Person', 'Publication', 'Unit', 'Course'))",
    "v_numbered": "SELECT i, object_type, concept_id, score FROM v_scored JOIN v_numbers USING (object_type, object_id)",
    "v_x1n": f"""SELECT a.i AS a_i, b.i AS b_i, sum(a.score * b.score) AS score, count(*) AS n FROM (SELECT * FROM v_numbered WHERE object_type = 'Person') a JOIN (SELECT * FROM v_numbered WHERE object_type = 'Person') b ON a.concept_id = b.concept_id AND a.i < b.i
        GROUP BY ALL HAVING count(*) >= 4 AND {least('sum(a.score * b.score)', 0.1)}""",
    "v_x1": "SELECT a.object_id AS a_id, b.object_id AS b_id, score, n FROM v_x1n JOIN v_numbers a ON a.i = a_i JOIN v_numbers b ON b.i = b_i",
    "v_x4": f"SELECT a_id, b_id, s AS score FROM (SELECT a_id, b_id, {sigma('score', 'avg(score) OVER ()')} AS s FROM v_x1) WHERE {least('s', 0.1)}",
    # the configured pairs of types that the tables have
    "v_xall": f"""SELECT a.i AS a_i, b.i AS b_i, any_value(a.object_type) AS a_type, any_value(b.object_type) AS b_type, sum(a.score * b.score) AS score FROM v_numbered a JOIN v_numbered b ON a.concept_id = b.concept_id AND a.i < b.i
        AND (a.object_type = b.object_type OR (a.object_type = 'Person' AND b.object_type IN ('Publication', 'Unit')) OR (a.object_type = 'Publication' AND b.object_type = 'Unit'))
        GROUP BY a.i, b.i HAVING count(*) >= 4 AND {least('sum(a.score * b.score)', 0.1)}""",
    "v_xalladj": f"SELECT a_type, a.object_id AS a_id, b_type, b.object_id AS b_id, s AS score FROM (SELECT *, {sigma('score', 'avg(score) OVER (PARTITION BY a_type, b_type)')} AS s FROM v_xall) JOIN v_numbers a ON a.i = a_i JOIN v_numbers b ON b.i = b_i WHERE {least('s', 0.1)}",
    # index
    "v_atinst": "SELECT a.person_id AS person_id, max(CASE WHEN e.unit_id IS NULL THEN 1 ELSE 0 END) AS v FROM v_affil a LEFT JOIN v_ended e USING (person_id, unit_id) GROUP BY ALL",
    "v_pdoc": "SELECT person_id AS doc_id, v AS is_at_institution, coalesce(avg_norm_log_degree, 0.001e0) AS degree_score FROM v_atinst LEFT JOIN v_n5 ON object_type = 'Person' AND object_id = person_id",
    "v_udoc": "SELECT unit_id AS doc_id, active AS is_active_unit, research AS is_research_unit, coalesce(avg_norm_log_degree, 0.001e0) AS degree_score FROM v_active LEFT JOIN v_n5 ON object_type = 'Unit' AND object_id = unit_id",
    "v_org": "SELECT unit_id AS doc_id, person_id AS link_id, CASE WHEN e.link IS NULL THEN 1 ELSE 0 END AS is_active_affiliation FROM v_affil LEFT JOIN (SELECT person_id, unit_id, 1 AS link FROM v_ended) e USING (person_id, unit_id)",
    "v_sem": "SELECT doc_id, link_id, score AS semantic_score FROM (SELECT a_id AS doc_id, b_id AS link_id, score FROM v_x4 UNION ALL SELECT b_id, a_id, score FROM v_x4)",
    "v_semrank": "SELECT *, row_number() OVER (PARTITION BY s.doc_id ORDER BY p.is_at_institution DESC NULLS LAST, round(semantic_score, 9) DESC, s.link_id) AS row_rank FROM v_sem s JOIN (SELECT doc_id AS link_id, is_at_institution, degree_score FROM v_pdoc) p USING (link_id)",
}


#: Views that are read more than once and dear.
ONCE = frozenset("v_k10 v_numbered v_x1n v_xall v_x4".split())


def sql(body: str) -> str:
    """The statement with the views it needs before it."""
    needed: list[str] = []

    def want(text: str) -> None:
        for name in re.findall(r"\bv_\w+", text):
            if name in V and name not in needed:
                want(V[name])
                if name not in needed:
                    needed.append(name)

    want(body)
    return ("WITH " + ",\n".join(f"{n} AS {'MATERIALIZED ' if n in ONCE else ''}({V[n]})" for n in needed) + "\n" if needed else "") + body
