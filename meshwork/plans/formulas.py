"""Registry of formulas: named steps with the tables they need, run in their order."""

from __future__ import annotations

from collections.abc import Callable
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame

Step = Callable[[dict[str, DataFrame]], DataFrame]
FORMULAS: dict[str, tuple[tuple[str, ...], Step]] = {}


def formula(name: str, *needs: str, into: dict | None = None) -> Callable[[Step], Step]:
    """Registers a step that makes table ``name`` from the tables ``needs``."""
    def keep(step: Step) -> Step:
        (FORMULAS if into is None else into)[name] = (needs, step)
        return step

    return keep


def order(names: list[str] | None = None, known: dict | None = None) -> list[str]:
    """Steps in an order in which each comes after what it needs."""
    known = FORMULAS if known is None else known
    wanted, todo = set(), list(names or known)
    while todo:
        n = todo.pop()
        if n in known and n not in wanted:
            wanted.add(n)
            todo += known[n][0]
    return [n for n in TopologicalSorter({n: sorted(set(known[n][0]) & wanted) for n in sorted(wanted)}).static_order()]


def run(tables: dict[str, DataFrame], names: list[str] | None = None, known: dict | None = None, keep: Callable[[str, DataFrame], DataFrame] = lambda n, df: df) -> dict[str, DataFrame]:
    """The tables with all wanted steps' results; ``keep`` may write each (a checkpoint
    or a table) before later steps read it."""
    known = FORMULAS if known is None else known
    tables = dict(tables)
    for n in order(names, known):
        tables[n] = keep(n, known[n][1](tables))
    return tables
