"""Comparison of table versions, key checks and samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meshwork.functions.scalars import any_of, differs

#: (statistic, fail above, warn above)
LIMITS = (("new", 25.0, 10.0), ("deleted", 25.0, 10.0), ("mismatch", 10.0, 5.0))


def flattened(df: DataFrame, prefix: str = "") -> DataFrame:
    """Struct columns as columns of their own with dotted names."""
    def leaves(schema: StructType, path: str):
        for f in schema:
            name = f"{path}.{f.name}" if path else f.name
            if isinstance(f.dataType, StructType):
                yield from leaves(f.dataType, name)
            else:
                yield name

    return df.select(*(F.col(".".join(f"`{p}`" for p in n.split("."))).alias(n) for n in leaves(df.schema, prefix)))


def table_diff(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str], sample: int | None = None) -> DataFrame:
    """One row: rows that are new, deleted, match or mismatch, and for each column the
    mismatches and the values set to null. sample: of so many keys of each side, by hash."""
    if sample is not None:
        pick = lambda f: f.select(keys).orderBy(F.xxhash64(*keys), *keys).limit(sample)
        chosen = pick(old).union(pick(new)).distinct()
        old, new = old.join(chosen, keys, "left_semi"), new.join(chosen, keys, "left_semi")
    o = old.select(*keys, F.struct(*columns).alias("_o"))
    n = new.select(*keys, F.struct(*columns).alias("_n"))
    both = o.join(n, keys, "full_outer")
    known = F.col("_o").isNotNull() & F.col("_n").isNotNull()
    changed = any_of([differs(f"_o.{c}", f"_n.{c}") for c in columns])
    aggs = [F.count("*").alias("n_rows"), F.count_if(F.col("_o").isNull()).alias("n_new"), F.count_if(F.col("_n").isNull()).alias("n_deleted"), F.count_if(known & ~changed).alias("n_match"), F.count_if(known & changed).alias("n_mismatch")]
    for c in columns:
        aggs.append(F.count_if(known & differs(f"_o.{c}", f"_n.{c}")).alias(f"{c}_mismatch"))
        aggs.append(F.count_if(known & F.col(f"_o.{c}").isNotNull() & F.col(f"_n.{c}").isNull()).alias(f"{c}_set_to_null"))
    return both.agg(*aggs)


def median_change(old: DataFrame, new: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Median of the absolute change of a number over common keys."""
    joined = old.select(*keys, F.col(column).alias("_o")).join(new.select(*keys, F.col(column).alias("_n")), keys)
    return joined.agg(F.percentile(F.abs(F.col("_n") - F.col("_o")), 0.5).alias(f"{column}_median_change"))


def verdict(diff: DataFrame) -> DataFrame:
    """Percentages of a diff with pass, warn or fail for each."""
    out = diff
    for name, fail, warn in LIMITS:
        share = 100.0 * F.col(f"n_{name}") / F.greatest(F.col("n_rows"), F.lit(1))
        out = out.withColumns({f"{name}_percent": F.round(share, 6), f"{name}_verdict": F.when(share > fail, "fail").when(share > warn, "warn").otherwise("pass")})
    return out


def duplicate_keys(table: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once; none if the key is unique."""
    return table.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """A row for each table, counted in one job."""
    return reduce(DataFrame.unionByName, [t.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows") for name, t in tables.items()])


def by_keys(table: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    return table.join(wanted.select(keys).distinct(), keys, "left_semi")


def existing(wanted: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Each wanted key with 1 if the table has it, else 0."""
    have = table.select(keys).distinct().withColumn("_h", F.lit(1))
    return wanted.select(keys).distinct().join(have, keys, "left").select(*keys, F.coalesce("_h", F.lit(0)).alias("found"))


def _draw(keys: list[str], seed: int) -> Column:
    """A number in hexadecimal that a row's key and the seed give in any layout and engine."""
    return F.md5(F.concat_ws("|", *(F.col(k).cast("string") for k in keys), F.lit(str(seed))).cast("binary"))


def random_rows(table: DataFrame, n: int, seed: int = 42, keys: list[str] | None = None) -> DataFrame:
    """n rows by a seeded hash of the key: equal runs give equal rows."""
    keys = keys or table.columns
    return table.orderBy(_draw(keys, seed), *keys).limit(n)


def stratified_rows(table: DataFrame, by: list[str], n: int, seed: int = 42, keys: list[str] | None = None) -> DataFrame:
    """n rows of each stratum, by a seeded hash of the key: equal runs give equal rows."""
    keys = keys or table.columns
    w = Window.partitionBy(*by).orderBy(_draw(keys, seed), *keys)
    return table.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")
