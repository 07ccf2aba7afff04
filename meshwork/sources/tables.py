"""Reading, writing and describing tables."""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meshwork.operators.upsert import insert_ignore, replace_into
from meshwork.schema import KEYS, TABLES, column_type

SQL_NAME = re.compile(r"\[\[(\w+)\]\]")


def with_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a schema, cast; missing ones null."""
    return df.select(*((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema))


def read_table(spark: SparkSession, path: str, name: str | None = None, fmt: str = "parquet", **options) -> DataFrame:
    """A parquet, orc, json or csv table (or one over jdbc), with the model's schema if named."""
    if fmt == "jdbc":
        return spark.read.format("jdbc").options(**options).load()
    reader = spark.read.options(**options)
    if name and fmt in ("json", "csv"):
        reader = reader.schema(TABLES[name])
    df = reader.format(fmt).load(path)
    return with_schema(df, TABLES[name]) if name else df


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "error", where: str | None = None, partition_by: tuple[str, ...] = (), **options) -> None:
    """Dump of a table, in as many files as it has partitions."""
    rows = df if where is None else df.where(where)
    writer = rows.write.mode(mode).options(**options)
    (writer.partitionBy(*partition_by) if partition_by else writer).format(fmt).save(path)


def copy_rows(target: DataFrame, source: DataFrame, keys: list[str], mode: str = "insert", columns: list[str] | None = None, where: str | None = None) -> DataFrame:
    """The target after a copy: insert (append), replace or ignore (keep known keys)."""
    rows = source if where is None else source.where(where)
    rows = rows if columns is None else rows.select(*columns)
    if mode == "insert":
        return target.unionByName(rows, allowMissingColumns=True)
    if mode == "replace":
        return replace_into(target, rows, keys)
    if mode == "ignore":
        return insert_ignore(target, rows, keys)
    raise ValueError(f"mode is insert, replace or ignore, not {mode}")


def dump_database(tables: dict[str, DataFrame], folder: str, include: str = ".*", exclude: str | None = None) -> list[str]:
    """Writes the tables whose names fit; gives the names."""
    names = [n for n in sorted(tables) if re.search(include, n) and not (exclude and re.search(exclude, n))]
    for n in names:
        write_table(tables[n], f"{folder.rstrip('/')}/{n}", mode="overwrite")
    return names


def import_database(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    return {n: read_table(spark, f"{folder.rstrip('/')}/{n}") for n in names}


def fill_template(text: str, schemas: dict[str, str]) -> str:
    """[[slot]] in a statement becomes the schema of that slot; unknown slots are errors."""
    return SQL_NAME.sub(lambda m: schemas[m[1]], text)


def statements(script: str) -> list[str]:
    """Statements of a script, without comments; semicolons in quotes don't end one."""
    bare = re.sub(r"('(?:[^']|'')*'|\"[^\"]*\")|--[^\n]*|/\*.*?\*/", lambda m: m[1] or " ", script, flags=re.S)
    parts = re.findall(r"(?:'(?:[^']|'')*'|\"[^\"]*\"|[^;'\"])+", bare)
    return [p.strip() for p in parts if p.strip()]


def run_script(spark: SparkSession, script: str, schemas: dict[str, str] | None = None) -> DataFrame | None:
    """Runs a script's statements in order; gives the last one's result."""
    out = None
    for s in statements(fill_template(script, schemas or {})):
        out = spark.sql(s)
    return out


def query(spark: SparkSession, sql: str, tables: dict[str, DataFrame] | None = None, **args) -> DataFrame:
    """A query with named parameters over given tables."""
    for name, df in (tables or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql, args=args or None)


def materialise(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Writes a view's rows and gives the written table."""
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.parquet(path)


#: Item of an import payload.
FIELD = T.StructType([T.StructField(n, T.StringType()) for n in ("field_language", "field_name", "field_value")])
NODE_ITEM = T.StructType([*TABLES["nodes"].fields[:6], T.StructField("custom_fields", T.ArrayType(FIELD)), T.StructField("page_profile", T.MapType(T.StringType(), T.StringType())), T.StructField("manual_mapping", T.ArrayType(T.StructType([T.StructField("concept_id", T.StringType()), T.StructField("text_source", T.StringType()), T.StructField("score", T.DoubleType())])))])
EDGE_ITEM = T.StructType([*TABLES["edges"].fields[:7], T.StructField("custom_fields", T.ArrayType(FIELD))])
PAYLOAD = T.StructType([T.StructField("nodes", T.ArrayType(NODE_ITEM)), T.StructField("edges", T.ArrayType(EDGE_ITEM))])


def import_json(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Tables of a JSON file {nodes: [...], edges: [...]}."""
    return from_items(spark.read.schema(PAYLOAD).json(path, multiLine=True))


def import_payload(spark: SparkSession, payload: dict) -> dict[str, DataFrame]:
    """Tables of a request body {type: nodes|edges, data: [...]} or {nodes, edges}."""
    body = {payload["type"]: payload["data"]} if "type" in payload else payload
    row = json.dumps({k: body.get(k, []) for k in ("nodes", "edges")})
    return from_items(spark.createDataFrame([(row,)], "j string").select(F.from_json("j", PAYLOAD).alias("p")).select("p.*"))


def from_items(df: DataFrame) -> dict[str, DataFrame]:
    nodes, edges = df.select(F.explode("nodes").alias("i")).select("i.*"), df.select(F.explode("edges").alias("i")).select("i.*")
    key, ends = [f.name for f in NODE_ITEM.fields[:3]], [f.name for f in EDGE_ITEM.fields[:7]]
    profile = [f.name for f in TABLES["page_profile"] if f.name not in key]
    return {
        "nodes": nodes.select(*(f.name for f in NODE_ITEM.fields[:6])),
        "node_fields": nodes.select(*key, F.explode("custom_fields").alias("f")).select(*key, "f.*"),
        "page_profile": with_schema(nodes.where("page_profile IS NOT NULL").select(*key, *(F.col("page_profile")[c].alias(c) for c in profile)), TABLES["page_profile"]),
        "manual_mapping": nodes.select(*key, F.explode("manual_mapping").alias("m")).select(*key, "m.concept_id", "m.text_source", F.coalesce("m.score", F.lit(1.0)).alias("score")),
        "edges": edges.select(ends),
        "edge_fields": edges.select(*ends, F.explode("custom_fields").alias("f")).select(*ends, "f.*"),
    }


def to_payload(nodes: DataFrame, node_fields: DataFrame) -> DataFrame:
    """A JSON item of each node with its fields in order."""
    key = KEYS["nodes"]
    lists = node_fields.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("field_language", "field_name", "field_value"))).alias("custom_fields"))
    return nodes.join(lists, key, "left").select(F.to_json(F.struct(*(c for c in nodes.columns), "custom_fields")).alias("item"))


def apply_types(df: DataFrame) -> DataFrame:
    """Columns cast to the types their names stand for; bad values become null."""
    return df.select(*(F.col(c).try_cast(column_type(c)).alias(c) if column_type(c) != "string" else F.col(c) for c in df.columns))


def describe(df: DataFrame) -> list[tuple[str, str, bool]]:
    return [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema]


def catalog_tables(spark: SparkSession, pattern: str = ".*", schema: str | None = None) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(schema) if re.search(pattern, t.name))


def write_documents(nested: DataFrame, folder: str) -> None:
    """Nested documents as gzipped JSON lines, a folder for each type."""
    nested.withColumn("_type", F.col("doc_type")).write.mode("overwrite").partitionBy("_type").option("compression", "gzip").json(folder)


def full_index(parts: list[DataFrame]) -> DataFrame:
    """All types' documents as JSON with their ids ``type-id``."""
    rows = [p.select(F.concat_ws("-", "doc_type", "doc_id").alias("_id"), F.to_json(F.struct(*p.columns)).alias("document")) for p in parts]
    return reduce(DataFrame.unionByName, rows)


def bulk_load(index: DataFrame, send, chunk: int = 1000) -> None:
    """Hands the index in chunks to ``send(list of (id, document))`` on the executors."""
    def each(rows):
        held = []
        for r in rows:
            held.append((r[0], r[1]))
            if len(held) == chunk:
                send(held)
                held = []
        if held:
            send(held)

    index.foreachPartition(each)


def lexical_concepts(texts: DataFrame, concepts: DataFrame, id_cols: list[str], text_col: str) -> DataFrame:
    """Concepts named in texts, scored by the share of the text's words: the default in
    place of a detection service. concepts: concept_id, name of one word."""
    words = texts.select(*id_cols, F.explode(F.split(F.lower(F.col(text_col)), r"[^\p{L}\p{N}]+")).alias("name"))
    total = words.groupBy(*id_cols).agg(F.count("*").alias("_n"))
    hits = words.join(concepts.select("concept_id", F.lower("name").alias("name")), "name").groupBy(*id_cols, "concept_id").agg(F.count("*").alias("_h"))
    return hits.join(total, id_cols).select(*id_cols, "concept_id", (F.col("_h") / F.col("_n")).alias("score"))
