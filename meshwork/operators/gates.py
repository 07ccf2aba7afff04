"""Change tracking: type flags, expiry, refresh and what is to be processed.

State tables hold a row for each object or edge; each step gives the next state.
``as_of`` stands for today, so runs can be repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meshwork.functions.scalars import differs
from meshwork.operators.upsert import update_join
from meshwork.schema import EDGE_KEY, FROM_KEY, NODE_KEY, TO_KEY, UNSYNCED_TYPES, institution_of

DAYS, PER_TYPE = 90, 100


#: Objects to be processed that are broadcast, at most.
FEW = 500_000


def type_flags(spark: SparkSession, nodes: list[tuple], objects: str = "TST") -> DataFrame:
    """nodes: (type, process fields, process scores). A row for each type and flag."""
    rows = [(institution_of(t, objects), t, flag, int(on)) for t, *ons in nodes for flag, on in zip(("fields", "scores"), ons, strict=False)]
    return spark.createDataFrame(rows, "institution_id string, object_type string, flag_type string, to_process int")


def edge_type_flags(spark: SparkSession, edges: list[tuple], objects: str = "TST") -> DataFrame:
    """edges: (from type, to type, process fields); set in both directions."""
    rows = {(institution_of(x, objects), x, institution_of(y, objects), y, "fields", int(on)) for a, b, on in edges for x, y in ((a, b), (b, a))}
    return spark.createDataFrame(sorted(rows), "from_institution_id string, from_object_type string, to_institution_id string, to_object_type string, flag_type string, to_process int")


def flagged(flags: DataFrame, kind: str) -> DataFrame:
    """Types (or type pairs) whose flag of a kind is set; a row each."""
    keys = [c for c in flags.columns if c not in ("flag_type", "to_process")]
    return flags.where((F.col("flag_type") == kind) & (F.col("to_process") == 1)).select(keys).distinct()


def gate(rows: DataFrame, state: DataFrame, flags: DataFrame | None = None, kind: str = "fields", keys: list[str] | None = None) -> DataFrame:
    """Rows whose object is to be processed and whose type is flagged. The few type
    flags are broadcast and come first."""
    if flags is not None:
        types = flagged(flags, kind)
        rows = rows.join(F.broadcast(types), types.columns, "left_semi")
    return rows.join(state.where("to_process = 1").select(keys or NODE_KEY), keys or NODE_KEY, "left_semi")


def config_pairs(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The flags as a configuration: (object_type, fields, scores) and, for edges,
    (type_1, type_2, to_process) with the pair's names in order, each pair once."""
    on = lambda k: F.max(F.when(F.col("flag_type") == k, F.col("to_process")))
    by_type = nodes.groupBy("object_type").agg(on("fields").alias("fields"), on("scores").alias("scores"))
    pairs = edges.select(F.least("from_object_type", "to_object_type").alias("type_1"), F.greatest("from_object_type", "to_object_type").alias("type_2"), "to_process").distinct()
    return by_type, pairs


def sync(state: DataFrame, objects: DataFrame, keys: list[str], to_process: int = 1) -> DataFrame:
    """Adds a fresh row for each object (or edge) that the state lacks; slides and
    transcripts are left out, and edges between two concepts."""
    kinds = [k for k in keys if k.endswith("object_type")]
    for k in kinds:
        objects = objects.where(~F.col(k).isin(*UNSYNCED_TYPES))
    if len(kinds) == 2:
        objects = objects.where(~((F.col(kinds[0]) == "Concept") & (F.col(kinds[1]) == "Concept")))
    fresh = objects.select(keys).distinct().join(state.select(keys), keys, "left_anti")
    return state.unionByName(fresh.withColumn("to_process", F.lit(to_process)), allowMissingColumns=True)


def reset(state: DataFrame, types: DataFrame | None = None) -> DataFrame:
    """to_process := 0, for all or for some types."""
    if types is None:
        return state.withColumn("to_process", F.lit(0))
    return update_join(state, F.broadcast(types), types.columns, {"to_process": F.lit(0)})


def randomize(state: DataFrame, as_of: str, period: int = 182, key: str = "object_id") -> DataFrame:
    """Test aid: last_date_cached somewhere in the last ``period`` days, by the key."""
    days = (F.conv(F.substring(F.md5(F.col(key).cast("binary")), 1, 8), 16, 10).cast("long") % period).cast("int")
    return state.withColumn("last_date_cached", F.date_sub(F.lit(as_of).cast("date"), days))


def is_old(as_of: str, older_than: int, column: str = "last_date_cached") -> Column:
    return F.col(column).isNull() | (F.col(column) < F.date_sub(F.lit(as_of).cast("date"), older_than))


def expire(state: DataFrame, as_of: str, older_than: int = DAYS, limit_per_type: int | None = PER_TYPE, keys: list[str] | None = None) -> DataFrame:
    """has_expired := 1 for objects never cached or not since ``older_than`` days, at
    most ``limit_per_type`` of each type (the stalest first); 0 for all others.

    The limit is the feature: it bounds a run's work. Ranks are cut on each
    partition before the shuffle by type.
    """
    keys = keys or NODE_KEY
    kinds = [k for k in keys if k.endswith("object_type")]
    if limit_per_type is None:
        return state.withColumn("has_expired", is_old(as_of, older_than).cast("int"))
    w = Window.partitionBy(*kinds).orderBy(F.col("last_date_cached").asc_nulls_first(), *(F.col(k) for k in keys))
    chosen = state.where(is_old(as_of, older_than)).select(*keys, "last_date_cached").withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= limit_per_type).select(keys)
    return state.drop("has_expired").join(chosen.withColumn("_e", F.lit(1)), keys, "left").withColumn("has_expired", F.coalesce("_e", F.lit(0))).select(state.columns)


def refresh(state: DataFrame, checksums: DataFrame | None = None, keys: list[str] | None = None) -> DataFrame:
    """Takes in new checksums of expired objects, then marks what is to be processed:
    changed, expired or never cached."""
    keys = keys or NODE_KEY
    if checksums is not None:
        joined = state.join(checksums.select(*keys, F.col("checksum").alias("_c")), keys, "left")
        state = joined.withColumn("checksum_current", F.when(F.col("has_expired") == 1, F.coalesce("_c", "checksum_current")).otherwise(F.col("checksum_current"))).drop("_c").select(state.columns)
    changed = differs("checksum_current", "checksum_previous").cast("int")
    state = state.withColumn("has_changed", changed)
    todo = (F.col("has_changed") == 1) | (F.col("has_expired") == 1) | F.col("last_date_cached").isNull()
    return state.withColumn("to_process", F.coalesce(todo, F.lit(False)).cast("int"))


def refresh_stats(state: DataFrame, kind: str = "object_type") -> DataFrame:
    """Counts of a refresh by type, and over all types with a null type."""
    return state.rollup(kind).agg(
        F.count_if(F.col("last_date_cached").isNull()).alias("new_or_never_cached"),
        F.count_if(F.col("has_changed") == 1).alias("checksum_changed"),
        F.count_if(F.col("has_expired") == 1).alias("cache_expired"),
        F.count_if(F.col("to_process") == 1).alias("to_process"),
    )


def rollover(state: DataFrame) -> DataFrame:
    """checksum_previous := checksum_current and has_changed := 0 where they differ."""
    moved = differs("checksum_current", "checksum_previous")
    return state.withColumns({"checksum_previous": F.when(moved, F.col("checksum_current")).otherwise(F.col("checksum_previous")), "has_changed": F.when(moved, 0).otherwise(F.col("has_changed"))})


def propagate_nodes(cache: DataFrame, state: DataFrame) -> DataFrame:
    """to_process of a cached node table := 1 for objects to be processed, else 0."""
    todo = state.where("to_process = 1").select(*NODE_KEY, F.lit(1).alias("_p"))
    return cache.drop("to_process").join(todo, NODE_KEY, "left").withColumn("to_process", F.coalesce("_p", F.lit(0))).drop("_p")


def propagate_edges(cache: DataFrame, state: DataFrame) -> DataFrame:
    """The same for an edge table, whose state may hold the edge in either direction."""
    todo = state.where("to_process = 1").select(EDGE_KEY)
    mirrored = todo.select(*(F.col(b).alias(a) for a, b in zip(EDGE_KEY, TO_KEY + FROM_KEY, strict=True)))
    both = todo.unionByName(mirrored).distinct().withColumn("_p", F.lit(1))
    return cache.drop("to_process").join(both, EDGE_KEY, "left").withColumn("to_process", F.coalesce("_p", F.lit(0))).drop("_p")


def propagate_scores(matrix: DataFrame, state: DataFrame) -> DataFrame:
    """The same for a score matrix: 1 if either end is to be processed. Up to ``FEW`` of
    these are broadcast, so that the matrix stays where it is."""
    out = matrix.drop("to_process")
    few = state.where("to_process = 1").count() <= FEW
    for side, mark in (("from", "_a"), ("to", "_b")):
        todo = state.where("to_process = 1").select(*(F.col(c).alias(f"{side}_{c}") for c in NODE_KEY), F.lit(1).alias(mark))
        todo = F.broadcast(todo) if few else todo
        out = out.join(todo, [f"{side}_{c}" for c in NODE_KEY], "left")
    return out.withColumn("to_process", F.coalesce("_a", "_b", F.lit(0))).drop("_a", "_b")


def marks(state: DataFrame) -> DataFrame:
    """What is to be processed, as marks for ``Vectors.pairs``: a matrix made with them needs no ``propagate_scores``."""
    return state.where("to_process = 1").select(*NODE_KEY, F.lit(1).alias("mark"))


def settle(state: DataFrame, processed: DataFrame, as_of: str, keys: list[str] | None = None) -> DataFrame:
    """After a run: cached today, not expired, nothing to do, for what was processed."""
    keys = keys or NODE_KEY
    return update_join(state, processed.select(keys).distinct(), keys, {"last_date_cached": F.lit(as_of).cast("date"), "has_expired": F.lit(0), "to_process": F.lit(0)})


def status(state: DataFrame, kinds: list[str] | None = None) -> DataFrame:
    return state.groupBy(*(kinds or ["object_type"]), "has_expired", "to_process").agg(F.count("*").alias("n"))


def aged(state: DataFrame, as_of: str, older_than: int | None = None, has_expired: int | None = None) -> DataFrame:
    """State rows by age and by expiry."""
    if older_than is not None:
        state = state.where(is_old(as_of, older_than))
    return state if has_expired is None else state.where(F.col("has_expired") == has_expired)
