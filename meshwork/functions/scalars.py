"""Column functions of the engine."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sigma(x: str | Column, mean: str | Column) -> Column:
    """2 / (1 + exp(-x / (4 mean))) - 1: [0, inf) to [0, 1)."""
    return F.lit(2.0) / (1 + F.exp(-col(x) / (4 * col(mean)))) - 1


def logistic2(x: str | Column) -> Column:
    """2 / (1 + exp(-2 x)) - 1."""
    return F.lit(2.0) / (1 + F.exp(-2 * col(x))) - 1


def at_least(x: str | Column, bound: float) -> Column:
    """x >= bound, on nine decimals so that sums that land on the bound count alike."""
    return F.round(col(x), 9) >= F.lit(float(bound))


def rank_score(rank: str | Column) -> Column:
    return F.lit(0.5) + F.lit(1.0) / (1 + col(rank))


def differs(a: str | Column, b: str | Column) -> Column:
    """Null-safe inequality."""
    return ~col(a).eqNullSafe(col(b))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda x, y: x | y, conditions, F.lit(False))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda x, y: x & y, conditions, F.lit(True))


def rows_equal(left: list[str | Column], right: list[str | Column]) -> Column:
    """(a, b, ...) = (c, d, ...): null if a compared pair holds a null, unlike structs."""
    return all_of([col(a) == col(b) for a, b in zip(left, right, strict=True)])


def levenshtein_similarity(a: str | Column, b: str | Column) -> Column:
    """1 - distance / longer length; 1 for two empty texts."""
    longer = F.greatest(F.length(col(a)), F.length(col(b)))
    return F.when(longer == 0, F.lit(1.0)).otherwise(1 - F.levenshtein(col(a), col(b)) / longer)


def checksum(columns: list[str]) -> Column:
    """MD5 of the JSON of some columns, sorted by name, nulls kept."""
    return F.md5(F.to_json(F.struct(*(F.col(c) for c in sorted(columns))), {"ignoreNullFields": "false"}))


def as_date(x: str | Column) -> Column:
    """The date in a text, null if there is none."""
    return F.try_to_timestamp(col(x)).cast("date")


def number(x: str | Column, kind: str = "double") -> Column:
    return col(x).try_cast(kind)


ACCENTED, PLAIN = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy"


def folded(text: str | Column) -> Column:
    """Lower case without accents: the key of a case- and accent-insensitive match."""
    return F.translate(F.lower(col(text)), ACCENTED, PLAIN)


def key_normal(text: str | Column) -> Column:
    """Equality key of a collation that ignores case, accents and trailing blanks."""
    return F.rtrim(folded(text))


def tokens(text: str | Column) -> Column:
    """Folded words of a text."""
    return F.filter(F.split(F.regexp_replace(folded(text), "[^a-z0-9ß]+", " "), " "), lambda w: w != "")


def shingles(text: str | Column, n: int) -> Column:
    """Runs of n words, blank-joined; none if there are fewer."""
    w = tokens(text)
    return F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, n), " "))).otherwise(F.array().cast("array<string>"))
