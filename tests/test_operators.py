"""Properties of the operators on small literal tables."""

import pytest
from pyspark.sql import functions as F

from meshwork import config, schema
from meshwork.functions import scalars as fn
from meshwork.operators import degree, entities, gates, index, quality, scoring, similarity, traverse, upsert, views
from meshwork.plans import formulas
from meshwork.sources import tables as io

S = "k int, a string, x double"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_upsert_is_idempotent_and_keeps_other_columns(spark):
    t = spark.createDataFrame([(1, "p", 1.0), (2, None, None)], S)
    s = spark.createDataFrame([(2, 5.0), (3, None)], "k int, x double")
    once = upsert.safe_upsert(t, s, ["k"], ["x"])
    assert rows(once) == rows(upsert.safe_upsert(once, s, ["k"], ["x"])) == [(1, "p", 1.0), (2, None, 5.0), (3, None, None)]


def test_upsert_of_repeated_keys_does_not_depend_on_order(spark):
    t = spark.createDataFrame([], S)
    s = [(1, "b", 2.0), (1, "a", 9.0), (1, "b", 1.0)]
    a = upsert.safe_upsert(t, spark.createDataFrame(s, S), ["k"], ["a", "x"])
    b = upsert.safe_upsert(t, spark.createDataFrame(s[::-1], S), ["k"], ["a", "x"])
    assert rows(a) == rows(b) == [(1, "b", 2.0)]


def test_replace_resets_unnamed_columns(spark):
    t = spark.createDataFrame([(1, "p", 1.0)], S)
    assert rows(upsert.replace_into(t, spark.createDataFrame([(1, 2.0)], "k int, x double"), ["k"])) == [(1, None, 2.0)]


def test_change_report_tolerates_small_differences(spark):
    t = spark.createDataFrame([(1, None, 1.0), (2, "a", 1.0), (3, "a", None)], S)
    s = spark.createDataFrame([(1, "v", 1.0000001), (2, None, 2.0), (3, "a", None), (4, None, None)], S)
    assert rows(upsert.change_report(t, s, ["k"], ["a", "x"])) == [
        (1, "key exists", "new value", "no change"), (2, "key exists", "set to null", "new value"), (3, "key exists", "no change", "no change"), (4, "key is new", "no change", "no change"),
    ]


def test_touch_moves_the_stamp_only_on_change(spark):
    t = spark.createDataFrame([(1, "a", "old"), (2, "b", "old")], "k int, a string, stamp string")
    s = spark.createDataFrame([(1, "a"), (2, "c"), (3, "d")], "k int, a string")
    assert rows(upsert.touch(t, s, ["k"], ["a"], F.lit("new"), "stamp")) == [(1, "a", "old"), (2, "c", "new"), (3, "d", "new")]


def test_tuple_comparison_with_null_is_not_true(spark):
    df = spark.createDataFrame([(1, None), (1, 2)], "a int, b int")
    assert df.where(fn.rows_equal(["a", "b"], [F.lit(1), F.lit(2)])).count() == 1
    assert df.where(fn.rows_equal(["a", "b"], [F.lit(1), F.lit(None)])).count() == 0


def test_expire_limits_each_type_and_takes_the_stalest(spark):
    state = spark.createDataFrame([("T", "A", str(i), None if i == 3 else f"2001-01-0{i + 1}", 1) for i in range(5)], "institution_id string, object_type string, object_id string, last_date_cached string, has_expired int").withColumn("last_date_cached", F.col("last_date_cached").cast("date"))
    got = gates.expire(state, "2001-08-01", 90, 2)
    assert rows(got.where("has_expired = 1").select("object_id")) == [("0",), ("3",)]


def test_sync_leaves_out_slides_and_concept_pairs(spark):
    empty = spark.createDataFrame([], "institution_id string, object_type string, object_id string, to_process int")
    nodes = spark.createDataFrame([("T", "Slide", "1"), ("T", "Transcript", "1"), ("T", "Person", "1"), ("T", "Person", "1")], "institution_id string, object_type string, object_id string")
    assert rows(gates.sync(empty, nodes, schema.NODE_KEY)) == [("T", "Person", "1", 1)]


def test_mirror_of_the_mirror_is_the_edge(spark):
    e = spark.createDataFrame([("T", "A", "1", "T", "B", "2", "c")], ", ".join(f"{c} string" for c in [*schema.EDGE_KEY, "context"]))
    assert rows(views.mirrored(views.mirrored(e))) == rows(e)


def test_calculated_fields_win(spark):
    cols = "institution_id string, object_type string, object_id string, field_language string, field_name string, field_value string"
    own = spark.createDataFrame([("T", "A", "1", "n/a", "f", "z")], cols)
    calculated = spark.createDataFrame([("T", "A", "1", "n/a", "f", "a")], cols)
    assert rows(views.all_fields([own], calculated))[0][-1] == "a"


def test_bounded_scores_without_rows_and_in_range(spark):
    raw = spark.createDataFrame([("a", 0.0), ("b", 50.0)], "id string, score double")
    got = dict(rows(scoring.bounded(raw)))
    assert got["a"] == 0.0 and 0 < got["b"] < 1
    assert scoring.bounded(raw.limit(0)).count() == 0
    assert scoring.mean_or_one(raw.limit(0)).first()[0] == 1.0


def test_scoring_matrix_keeps_every_slot(spark):
    u = spark.createDataFrame([("T", "Course", "1", "c", "slide sum-scores aggregation (bounded)", 0.5), ("T", "Course", "1", "c", "manual mapping on course page description", 1.0), ("T", "Course", "1", "c", "something else", 9.0)], "institution_id string, object_type string, object_id string, concept_id string, calculation_type string, score double")
    assert rows(scoring.scoring_matrix(u)) == [("T", "Course", "1", "c", 1.0, 0.5, None)]


@pytest.mark.parametrize(("shared", "n"), [(3, 0), (4, 1)])
def test_similarity_needs_four_shared_concepts(spark, shared, n):
    final = spark.createDataFrame([("T", "A", o, f"c{i}", 0.5) for o in "xy" for i in range(shared)], "institution_id string, object_type string, object_id string, concept_id string, score double")
    assert similarity.similarity(final, [("A", "A")]).count() == n


def test_similarity_gate_takes_either_end(spark):
    final = spark.createDataFrame([("T", k, o, f"c{i}", 0.5) for k, o in (("A", "x"), ("B", "y"), ("B", "z")) for i in range(4)], "institution_id string, object_type string, object_id string, concept_id string, score double")
    gate = spark.createDataFrame([("T", "B", "y")], "institution_id string, object_type string, object_id string")
    assert rows(similarity.similarity(final, [("B", "A")], gate).select("from_object_id", "to_object_id")) == [("x", "y")]


def test_normal_degrees_are_at_most_one(spark):
    e = spark.createDataFrame([("T", "A", a, "T", "B", b) for a, b in ("12", "13", "22")], ", ".join(f"{c} string" for c in schema.EDGE_KEY))
    got = degree.normalised(degree.edge_degrees(e)).agg(F.max("norm_log_degree"), F.min("norm_log_degree")).first()
    assert got[0] == 1.0 and got[1] > 0


def test_mixed_ranks_follow_on(spark):
    key = "doc_institution_id string, doc_type string, doc_id string, link_institution_id string, link_type string, link_id string"
    org = spark.createDataFrame([("T", "A", "1", "T", "B", "x", 1, 0.5)], key + ", row_rank int, degree_score double")
    sem = spark.createDataFrame([("T", "A", "1", "T", "B", "x", 1, 0.9), ("T", "A", "1", "T", "B", "y", 2, 0.8), ("T", "A", "2", "T", "B", "y", 1, 0.8)], key + ", row_rank int, semantic_score double")
    assert rows(index.mixed(org, sem).select("doc_id", "link_id", "row_rank", "link_subtype")) == [("1", "x", 1, "ORG"), ("1", "y", 3, "SEM"), ("2", "y", 1, "SEM")]


def test_flattened_names_and_sampled_diff(spark):
    a = spark.range(100).select("id", F.struct(F.col("id").alias("v"), F.struct(F.lit(1).alias("w")).alias("s")).alias("d"))
    assert quality.flattened(a).columns == ["id", "d.v", "d.s.w"]
    d = quality.table_diff(a.select("id"), a.select("id", F.lit(1).alias("one")).drop("one"), ["id"], ["id"], sample=10).first()
    assert d["n_match"] == d["n_rows"] >= 10


@pytest.mark.parametrize(("name", "kind"), [("Edges_N_Person_N_Unit_T_AS", "similarity"), ("Edges_N_Object_N_Concept_T_FinalScores", "object_to_concept"), ("Data_N_Object_T_PageProfile", "profile"), ("Index_D_Person", "doc_index"), ("Index_D_Person_L_Unit_T_ORG_COPY", "link_index"), ("IndexBuildup_Fields_Docs_Unit", "doc_index"), ("nothing", None)])
def test_table_names(name, kind):
    got = schema.classify(name)
    assert (got[0] if got else None) == kind


def test_config_from_json_and_types():
    c = config.IndexConfig.from_json({"doc-types": ["A"], "fields": {"docs": {"A": ["x", ["en", "y"]]}, "links": {"default": {"A": {"obj": ["z"], "order": [["z", "DESC"]]}}, "parent-child": {"A": {"B": {"obj2obj": ["q"], "order": [["q", "ASC"]]}}}}}, "es-fields": {"docs": {"A": ["w"]}}})
    assert c.flat(c.doc_fields["A"]) == ["x", "y_en"] and c.order("C", "A") == [("z", "DESC")] and c.order("A", "B") == [("q", "ASC")] and c.es_fields("A") == ["w"]
    assert config.types_to_process(["B", "A"], [("B", "A"), ("A", "C")], c) == {"fields": [("A", "B")], "scores": [("A", "A"), ("A", "B"), ("B", "B")]}


def test_formulas_run_in_order(spark):
    known = {}
    formulas.formula("b", "a", into=known)(lambda t: t["a"].withColumn("y", F.col("x") + 1))
    formulas.formula("c", "b", into=known)(lambda t: t["b"].agg(F.sum("y").alias("s")))
    assert formulas.order(["c"], known) == ["b", "c"]
    assert formulas.run({"a": spark.range(3).withColumnRenamed("id", "x")}, known=known)["c"].first()[0] == 6


def test_statements_and_templates():
    assert io.statements("SELECT ';' AS a; -- no; \nSELECT 2 /* ; */;") == ["SELECT ';' AS a", "SELECT 2"]
    assert io.fill_template("SELECT * FROM [[x]].t", {"x": "y"}) == "SELECT * FROM y.t"
    with pytest.raises(KeyError):
        io.fill_template("[[z]]", {})


def test_payload_round_trip_commit_and_delete(spark):
    payload = {"nodes": [{"institution_id": "T", "object_type": "Person", "object_id": "1", "object_title": "A", "custom_fields": [{"field_language": "en", "field_name": "f", "field_value": "v"}], "page_profile": {"name_en_value": "A"}, "manual_mapping": [{"concept_id": "c"}]}], "edges": [{"from_institution_id": "T", "from_object_type": "Person", "from_object_id": "1", "to_institution_id": "T", "to_object_type": "Unit", "to_object_id": "u", "context": "x"}]}
    g = entities.Graph.from_json(spark, payload)
    assert g.tables["manual_mapping"].first()["score"] == 1.0
    assert g.tables["page_profile"].first()["name_en_value"] == "A"
    new = entities.Graph({"nodes": g.tables["nodes"].withColumn("object_title", F.lit("B"))})
    assert g.commit(new, F.lit(None)).tables["nodes"].first()["object_title"] == "B"
    assert g.commit(new, F.lit(None), update_existing=False).tables["nodes"].first()["object_title"] == "A"
    assert g.report(new)["nodes"].first()["object_title_change"] == "new value"
    left = g.delete_nodes(g.tables["nodes"])
    assert all(left.tables[n].count() == 0 for n in ("nodes", "node_fields", "edges", "page_profile"))
    assert '"field_value":"v"' in g.to_json().first()[0]
    again = entities.node_checksums(g.tables["nodes"], g.tables["node_fields"])
    assert again.first()["checksum"] == entities.node_checksums(g.tables["nodes"], g.tables["node_fields"]).first()["checksum"]


def test_dump_import_copy_and_types(spark, tmp_path):
    t = spark.createDataFrame([(1, "p", 1.0), (2, "q", None)], S)
    assert io.dump_database({"t": t, "u": t}, str(tmp_path), exclude="u") == ["t"]
    assert rows(io.import_database(spark, str(tmp_path), ["t"])["t"]) == rows(t)
    assert io.copy_rows(t, t, ["k"], "ignore").count() == 2 and io.copy_rows(t, t, ["k"]).count() == 4
    assert io.apply_types(spark.createDataFrame([("x", "7")], "year string, score string")).first() == (None, 7.0)
    assert io.query(spark, "SELECT k FROM t WHERE x >= :low", {"t": t}, low=1.0).first()[0] == 1
    assert io.run_script(spark, "SELECT 1; SELECT 2 AS v").first()[0] == 2


def test_lexical_concepts(spark):
    texts = spark.createDataFrame([("1", "Graph theory, graph!"), ("2", None)], "id string, body string")
    concepts = spark.createDataFrame([("c1", "Graph"), ("c2", "None")], "concept_id string, name string")
    got = io.lexical_concepts(texts, concepts, ["id"], "body").collect()
    assert len(got) == 1 and got[0]["concept_id"] == "c1" and got[0]["score"] == 0.5


def test_nested_documents_without_links_have_an_empty_list(spark, tmp_path):
    key = "doc_institution_id string, doc_type string, doc_id string"
    docs = spark.createDataFrame([("T", "Unit", "1", 0.5, "n", "f", "d")], key + ", degree_score double, name_en string, name_fr string, description_en string")
    links = spark.createDataFrame([], key + ", link_institution_id string, link_type string, link_id string, row_rank int")
    got = index.nested_docs(docs, links, docs.select("doc_institution_id", "doc_type", "doc_id", "name_en", "name_fr"))
    assert got.first()["links"] == [] and got.first()["degree_score_factor"] == 32.0
    io.write_documents(got, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 1
    assert io.full_index([got]).first()["_id"] == "Unit-1"


def test_streamed_state(spark, tmp_path):
    from meshwork.streaming import updates

    spark.createDataFrame([(1, "2024-01-01 00:00:00", 7, "click", 1.0), (2, "2024-01-01 00:00:01", 7, "click", 1.0)], "event_id long, ts string, user_id long, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(str(tmp_path / "in"))
    stream = updates.event_stream(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema)
    state = spark.createDataFrame([("TST", "Person", "1", 0, 0)], "institution_id string, object_type string, object_id string, has_changed int, to_process int")
    saved = []
    q = updates.maintain_state(updates.changed_objects(stream), lambda: state, lambda df, n: saved.extend(map(tuple, df.collect())), str(tmp_path / "cp"))
    q.awaitTermination(60)
    assert ("TST", "Person", "7", 1, 1) in saved and ("TST", "Person", "1", 0, 0) in saved


def _hubs(spark):
    """MOOCs and persons by their hubs, some with several and some without a partner, and their edges."""
    moocs = spark.createDataFrame([("m1", 1), ("m2", 1), ("m3", 2), ("m4", 1), ("m4", 2), ("m5", 9), (None, 1)], "id string, hub int")
    persons = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2), ("c", 2), ("d", 3)], "id string, hub int")
    pairs = moocs.toDF("from_object_id", "hub").join(persons.toDF("to_object_id", "hub"), "hub").select("from_object_id", "to_object_id").distinct()
    edges = pairs.select(F.lit(schema.OBJECTS).alias("from_institution_id"), F.lit("MOOC").alias("from_object_type"), "from_object_id", F.lit(schema.OBJECTS).alias("to_institution_id"), F.lit("Person").alias("to_object_type"), "to_object_id", F.lit("teacher").alias("context"))
    return moocs, persons, edges


def test_degrees_by_hubs_are_those_of_the_edges(spark):
    moocs, persons, edges = _hubs(spark)
    assert rows(degree.hub_degrees(moocs, persons, ("MOOC", "Person"))) == rows(degree.edge_degrees(edges))
    assert rows(degree.hub_degrees(persons, moocs, ("Person", "MOOC"))) == rows(degree.edge_degrees(edges, inverse=True))


def test_concepts_by_hubs_are_those_of_the_edges(spark):
    moocs, persons, edges = _hubs(spark)
    written = spark.createDataFrame([("a", "p1", "x", 0.5), ("a", "p2", "x", 0.25), ("b", "p2", "x", 1.0), ("b", "p3", "y", 0.75), ("c", "p4", "y", 2.0), ("e", "p5", "z", 1.0)], "person_id string, publication_id string, concept_id string, score double")
    whole = traverse.mooc_person_publication_concept(edges, written)
    assert rows(traverse.mooc_concepts_by_hubs(moocs, persons, written)) == rows(whole)
    assert rows(traverse.mooc_sums_by_hubs(moocs, persons, written)) == rows(whole.groupBy("mooc_id", "concept_id").agg(F.sum("score")))
