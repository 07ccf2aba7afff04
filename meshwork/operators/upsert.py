"""Keyed changes of tables, as functions from old tables to new ones.

No table format with a MERGE is assumed: a change is one full outer join on the
key (or an anti join and a union), which shuffles both sides once by the key; two
changes in a row by the same key share that partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meshwork.functions.scalars import all_of, any_of, differs
from meshwork.schema import EDGE_KEY, FROM_KEY, NODE_KEY, TO_KEY

TOLERANCE = 1e-6


def last_per_key(source: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """One row for each key: the first by ``order``; without one the largest row,
    so that the outcome doesn't depend on the rows' arrival."""
    rest = [c for c in source.columns if c not in keys]
    if not rest:
        return source.distinct()
    if order is None:
        return source.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_row")).select(*keys, "_row.*").select(source.columns)
    w = Window.partitionBy(*keys).orderBy(*order)
    return source.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def _beside(target: DataFrame, source: DataFrame, keys: list[str], how: str) -> DataFrame:
    t, s = target.select(*keys, F.struct(*target.columns).alias("_t")), source.select(*keys, F.struct(*source.columns).alias("_s"))
    return t.join(s, keys, how)


def safe_upsert(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str], order: list[Column] | None = None) -> DataFrame:
    """Inserts new keys; of known keys sets only ``columns``, the others stay."""
    source = last_per_key(source.select(*keys, *columns), keys, order)
    joined = _beside(target, source, keys, "full_outer")
    old, new = F.col("_t").isNotNull(), F.col("_s").isNotNull()
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in columns:
            out.append(F.when(new, F.col(f"_s.{c}")).otherwise(F.col(f"_t.{c}")).alias(c))
        else:
            out.append(F.when(old, F.col(f"_t.{c}")).alias(c))
    return joined.select(out)


def replace_into(target: DataFrame, source: DataFrame, keys: list[str], defaults: dict[str, Column] | None = None, order: list[Column] | None = None) -> DataFrame:
    """Source rows take the place of target rows of their key; columns that the
    source lacks go back to their defaults, or null."""
    defaults = defaults or {}
    source = last_per_key(source, keys, order)
    missing = {c: defaults.get(c, F.lit(None).cast(target.schema[c].dataType)) for c in target.columns if c not in source.columns}
    filled = source.withColumns(missing).select(target.columns) if missing else source.select(target.columns)
    return target.join(source.select(keys), keys, "left_anti").unionByName(filled)


def insert_ignore(target: DataFrame, source: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """Source rows of keys that the target lacks are added; known rows stay."""
    fresh = last_per_key(source, keys, order).join(target.select(keys), keys, "left_anti")
    return target.unionByName(fresh, allowMissingColumns=True)


def insert_absent(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Only the rows to be added, for a sink that appends."""
    return source.join(target.select(keys), keys, "left_anti")


def update_join(target: DataFrame, source: DataFrame, keys: list[str], sets: dict[str, Column | str], only: Column | None = None) -> DataFrame:
    """UPDATE ... JOIN ... SET: of target rows with a source row (and ``only`` true)
    the columns of ``sets`` change. In expressions the source is ``s``, the target ``t``."""
    joined = target.alias("t").join(source.alias("s").withColumn("_hit", F.lit(True)), all_of([F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]), "left")
    hit = F.coalesce(F.col("_hit") & (only if only is not None else F.lit(True)), F.lit(False))
    value = lambda e: F.expr(e) if isinstance(e, str) else e
    return joined.select(*(F.when(hit, value(sets[c])).otherwise(F.col(f"t.{c}")).alias(c) if c in sets else F.col(f"t.{c}") for c in target.columns))


def set_cells(target: DataFrame, where: dict[str, object], sets: dict[str, object]) -> DataFrame:
    """Sets columns of the rows whose columns equal ``where``."""
    hit = all_of([F.col(k) == F.lit(v) for k, v in where.items()])
    return target.withColumns({c: F.when(hit, F.lit(v)).otherwise(F.col(c)) for c, v in sets.items()})


def get_cells(table: DataFrame, where: dict[str, object], columns: list[str]) -> DataFrame:
    return table.where(all_of([F.col(k) == F.lit(v) for k, v in where.items()])).select(*columns)


def eval_counts(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str], by: list[str]) -> DataFrame:
    """Dry run of an upsert: for each value of ``by`` the rows there are and the rows
    that would change or be added (n_total, n_patch)."""
    joined = _beside(target, source, keys, "right")
    changed = F.col("_t").isNull() | any_of([differs(f"_t.{c}", f"_s.{c}") for c in columns])
    return joined.groupBy(*(F.col(f"_s.{c}").alias(c) for c in by)).agg(F.count("*").alias("n_total"), F.count_if(changed).alias("n_patch"))


def change_report(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """For each source row: whether its key exists and, for each column, ``no
    change``, ``new value`` or ``set to null``; floats are equal within 1e-6."""
    joined = _beside(target, source, keys, "right")
    floats = {f.name for f in target.schema if f.dataType.simpleString() in ("double", "float")}

    def said(c: str) -> Column:
        old, new = F.col(f"_t.{c}"), F.col(f"_s.{c}")
        same = old.eqNullSafe(new)
        if c in floats:
            same = same | F.coalesce(F.abs(old - new) < TOLERANCE, F.lit(False))
        return F.when(same, "no change").when(new.isNull(), "set to null").otherwise("new value").alias(f"{c}_change")

    return joined.select(*keys, F.when(F.col("_t").isNull(), "key is new").otherwise("key exists").alias("key_status"), *map(said, columns))


def touch(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str], now: Column, stamp: str = "record_updated_date") -> DataFrame:
    """safe_upsert that moves ``stamp`` only for rows with a real change."""
    source = last_per_key(source.select(*keys, *columns), keys)
    joined = _beside(target, source, keys, "full_outer")
    new = F.col("_s").isNotNull()
    moved = new & (F.col("_t").isNull() | any_of([differs(f"_t.{c}", f"_s.{c}") for c in columns]))
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in columns:
            out.append(F.when(new, F.col(f"_s.{c}")).otherwise(F.col(f"_t.{c}")).alias(c))
        else:
            out.append((F.when(moved, now).otherwise(F.col(f"_t.{c}")) if c == stamp else F.col(f"_t.{c}")).alias(c))
    return joined.select(out)


def _without_ends(frame: DataFrame, nodes: DataFrame) -> DataFrame:
    for side in (FROM_KEY, TO_KEY):
        frame = frame.join(nodes.select(*(F.col(a).alias(b) for a, b in zip(NODE_KEY, side, strict=True))), side, "left_anti")
    return frame


def delete_nodes(tables: dict[str, DataFrame], nodes: DataFrame) -> dict[str, DataFrame]:
    """Removes nodes with all that hangs on them: fields, profiles, concepts, and
    the edges and edge fields at either end."""
    gone = nodes.select(NODE_KEY).distinct()
    return {name: _without_ends(t, gone) if "from_object_id" in t.columns else t.join(gone, NODE_KEY, "left_anti") for name, t in tables.items()}


def delete_edges(tables: dict[str, DataFrame], edges: DataFrame) -> dict[str, DataFrame]:
    gone = edges.select(EDGE_KEY).distinct()
    return {name: t.join(gone, EDGE_KEY, "left_anti") for name, t in tables.items()}


def delete_concepts(detections: DataFrame, nodes: DataFrame) -> DataFrame:
    return detections.join(nodes.select(NODE_KEY).distinct(), NODE_KEY, "left_anti")
