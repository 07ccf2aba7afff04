"""Exact de-duplication by content sort.

Sampled splitters range-partition the normalised texts, Spark's external sort puts
equal texts next to each other, and one pass compares each text in full with its
neighbour. The splitters are short whatever the texts' lengths: the first bytes,
then the digest, and last the id, which spreads a large group of equal texts over
many partitions. Runs that touch a partition's edge are stitched
by comparing the edge texts of neighbouring partitions; this takes two rows a
partition, whatever the number of documents.

Defined results: texts are equal if identical after lower-casing A-Z only; a
null text counts as empty; of rows that share the winning id too, each is a
group member and each is marked kept; a null id loses to any other (a group of
null ids keeps null); extra columns are ignored; an empty table gives none. ``keep_first`` keeps exactly one
row of each group, also where ids are null or repeated.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshwork.llm.common import cut, few_rows, table, workers_import
from meshwork.llm.survivors import fresh_name, row_key, survivors

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Bytes of a text that its splitter begins with.
HEAD_BYTES = 16


def normalised(text_col: str) -> F.Column:
    """The text with A-Z lower-cased, null as empty."""
    return F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, LOWER)


def sorted_runs(docs: DataFrame, id_col: str, text_col: str, partitions: int) -> DataFrame:
    """A row per document: (id, sha, part, run, n, low, high, edge) where ``run``
    numbers the runs of equal texts in partition ``part``, n, low and high are the
    run's size and ids there, and edge has bit 1 for the first run, 2 for the last.
    ``content`` is the text on one row of each edge run, else null."""
    import pyarrow as pa
    from pyspark import TaskContext

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), normalised(text_col).cast("binary").alias("body"))
    rows = rows.select("id", "body", F.sha2("body", 256).alias("sha"), F.substring("body", 1, HEAD_BYTES).alias("head"))
    dealt = rows.repartitionByRange(partitions, "head", "sha", "id").sortWithinPartitions("head", "sha", "body", "id").select("id", "body", "sha")
    names = ["id", "sha", "part", "run", "n", "low", "high", "edge", "content"]

    def run(batches):
        part = TaskContext.get().partitionId()
        text, ids, number = None, [], 0
        held = []  # finished runs not yet sent: a batch's worth

        digest = None

        def close(last):
            known = [x for x in ids if x is not None]
            edge = (number == 0) + 2 * last
            held.append((ids, digest, number, min(known, default=None), max(known, default=None), edge, text if edge else None))

        def send():
            sizes = np.array([len(x[0]) for x in held])
            spread = lambda values: np.repeat(np.array(values, dtype=object), sizes).tolist()
            content = []
            for x in held:
                content += [x[6], *[None] * (len(x[0]) - 1)]
            id_type = typed[0]
            arrays = [pa.array([i for x in held for i in x[0]], id_type), pa.array(spread([x[1] for x in held])), pa.array([part] * int(sizes.sum()), pa.int32()), pa.array(np.repeat([x[2] for x in held], sizes), pa.int64()), pa.array(np.repeat(sizes, sizes), pa.int64()), pa.array(spread([x[3] for x in held]), id_type), pa.array(spread([x[4] for x in held]), id_type), pa.array(np.repeat([x[5] for x in held], sizes), pa.int32()), pa.array(content, pa.binary())]
            held.clear()
            return pa.RecordBatch.from_arrays(arrays, names=names)

        typed = []
        for batch in batches:
            typed = [batch.column(0).type]
            for i, body, sha in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                body = body.as_py()
                if body == text:
                    ids.append(i)
                    continue
                if text is not None:
                    close(False)
                    number += 1
                text, ids, digest = body, [i], sha
            if len(held) > 2000:
                yield send()
        if text is not None:
            close(True)
            yield send()

    return dealt.mapInArrow(run, f"id {kind}, sha string, part int, run long, n long, low {kind}, high {kind}, edge int, content binary")


def stitch(edges: list, same: set) -> list[tuple]:
    """edges: (part, edge, run, n, low, high) by part and run; same: parts whose
    first text equals the last one of the part before. Gives (part, run, n, low,
    high) with the totals of the runs joined over partitions."""
    chains: list[list] = []
    for row in edges:
        if row[1] & 1 and row[0] in same and chains:
            chains[-1].append(row)
        else:
            chains.append([row])
    out = []
    for chain in chains:
        n = sum(r[3] for r in chain)
        low = min((r[4] for r in chain if r[4] is not None), default=None)
        high = max((r[5] for r in chain if r[5] is not None), default=None)
        out += [(r[0], r[2], n, low, high) for r in chain]
    return out


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", partitions: int | None = None) -> DataFrame:
    """``id_col``, keep_id, group_size, kept, text_sha256; a row per document.

    keep: ``smallest`` or ``largest``, the id that stays of equal texts.
    partitions: of the sort; by default spark.sql.shuffle.partitions.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep is smallest or largest, not {keep}")
    spark = docs.sparkSession
    workers_import(spark)
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = cut(sorted_runs(docs, id_col, text_col, partitions))
    tops = rows.where("content is not null")
    # at most two rows a partition; texts are compared on the executors
    first = tops.where("edge % 2 = 1").select("part", F.col("content").alias("first"))
    last = tops.where("edge >= 2").select("part", F.col("content").alias("last"))
    parts = sorted(r[0] for r in first.select("part").collect())
    after = dict(zip(parts, parts[1:], strict=False))
    same: set = set()
    if after:
        pairs = few_rows(spark, list(after.items()), "part int, next int")
        joined = last.join(pairs, "part").join(first.withColumnRenamed("part", "next"), "next")
        same = {r[0] for r in joined.where("last = first").select("next").collect()}
    edges = sorted(tuple(r) for r in tops.select("part", "edge", "run", "n", "low", "high").collect())
    edges.sort(key=lambda r: (r[0], r[2]))
    totals = few_rows(spark, stitch(edges, same), f"part int, run long, all_n long, all_low {kind}, all_high {kind}")
    joined = rows.drop("content").join(F.broadcast(totals), ["part", "run"], "left")
    own, whole = ("low", "all_low") if keep == "smallest" else ("high", "all_high")
    keep_id = F.when(F.col("all_n").isNotNull(), F.col(whole)).otherwise(F.col(own))
    return joined.select(F.col("id").alias(id_col), keep_id.alias("keep_id"), F.coalesce("all_n", "n").alias("group_size"), F.col("id").eqNullSafe(keep_id).alias("kept"), F.col("sha").alias("text_sha256"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of equal texts: that of the smallest id, of equal rows any."""
    key = fresh_name(docs)
    keyed = docs.withColumn(key, row_key(docs, id_col))
    found = exact_duplicates(keyed, key, text_col).where("group_size > 1")
    return survivors(keyed, key, found.select(F.col(key).alias("key"), F.col("keep_id").alias("best")))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"), keep="largest")


OP8_SQL = """
WITH t AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
    FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
    doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(body) AS text_sha256
FROM t WINDOW w AS (PARTITION BY body)
"""
