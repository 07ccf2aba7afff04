"""Nodes and edges as one API: load, set from items, to JSON, checksums, commit, delete."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meshwork.functions.scalars import checksum
from meshwork.operators import quality, upsert
from meshwork.schema import EDGE_KEY, KEYS, NODE_KEY
from meshwork.sources import tables as io

#: Columns that the checksum of an object leaves out.
UNCHECKED = ("record_created_date", "record_updated_date", "row_id")


def node_checksums(nodes: DataFrame, node_fields: DataFrame) -> DataFrame:
    """Node key and checksum over a node's own columns and its fields in order."""
    lists = node_fields.groupBy(*NODE_KEY).agg(F.to_json(F.sort_array(F.collect_list(F.struct("field_language", "field_name", "field_value")))).alias("custom_fields"))
    own = [c for c in nodes.columns if c not in UNCHECKED]
    return nodes.join(lists, NODE_KEY, "left").select(*NODE_KEY, checksum([*own, "custom_fields"]).alias("checksum"))


def has_text(nodes: DataFrame) -> DataFrame:
    """Nodes whose concepts can be detected: text and its source are not blank."""
    return nodes.where((F.trim("text_source") != "") & (F.trim("raw_text") != ""))


@dataclass
class Graph:
    """Tables of a graph; changes give a new Graph, and nothing is written here."""

    tables: dict[str, DataFrame] = field(default_factory=dict)

    @classmethod
    def from_json(cls, spark: SparkSession, payload: dict) -> Graph:
        return cls(io.import_payload(spark, payload))

    def exists(self, wanted: DataFrame) -> DataFrame:
        """Nodes or edges, by the columns ``wanted`` has."""
        keys = EDGE_KEY if EDGE_KEY[0] in wanted.columns else NODE_KEY
        return quality.existing(wanted, self.tables["edges" if keys is EDGE_KEY else "nodes"], keys)

    def list_objects(self, **where: object) -> DataFrame:
        return upsert.get_cells(self.tables["nodes"], where, self.tables["nodes"].columns)

    def report(self, new: Graph) -> dict[str, DataFrame]:
        """What a commit of ``new`` would change, by table."""
        return {n: upsert.change_report(self.tables[n], t, KEYS[n], [c for c in t.columns if c not in KEYS[n]]) for n, t in new.tables.items() if n in self.tables}

    def commit(self, new: Graph, now: Column, update_existing: bool = True) -> Graph:
        """The tables with the new ones upserted, or only unknown keys added."""
        out = dict(self.tables)
        for n, t in new.tables.items():
            keys = KEYS[n]
            rest = [c for c in t.columns if c not in keys]
            if n not in out:
                out[n] = upsert.last_per_key(t, keys)
            elif not update_existing:
                out[n] = upsert.insert_ignore(out[n], t, keys)
            elif "record_updated_date" in out[n].columns:
                out[n] = upsert.touch(out[n], t, keys, [c for c in rest if c in out[n].columns], now)
            else:
                out[n] = upsert.safe_upsert(out[n], t, keys, [c for c in rest if c in out[n].columns])
        return Graph(out)

    def delete_nodes(self, keys: DataFrame) -> Graph:
        return Graph(upsert.delete_nodes(self.tables, keys))

    def delete_edges(self, keys: DataFrame) -> Graph:
        own = {n: t for n, t in self.tables.items() if EDGE_KEY[0] in t.columns}
        return Graph(self.tables | upsert.delete_edges(own, keys))

    def to_json(self) -> DataFrame:
        return io.to_payload(self.tables["nodes"], self.tables["node_fields"])
