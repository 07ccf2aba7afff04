"""URL filter: rules first, gradient-boosted trees on lexical features for the rest.

A rule such as ``net/`` is a host and the start of a path; it fits its host and all
subdomains, and the longest fitting rule wins. The trees are trained on labelled
URLs; where no labels are given, those are the URLs that a rule decides. Features
are lengths, depth, digit ratio, entropies, parameter counts and, for the host's
suffixes, the smoothed share of blocked training URLs. While the trees are grown, a
URL sees the shares of other hosts' folds only, so the trees don't learn their own labels.

The training sample is bounded (``rows``: distinct labelled URLs chosen by their
hashes). Scoring is one pass without a shuffle.

Defined results: a null URL or one without ``://`` has an empty host and path, fits
no rule, and is judged by the trees on empty features; repeated rows are judged
alike; without labelled URLs of both kinds the verdict is the only kind there is,
``allow`` if there is none; an empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meshwork.llm.common import draw, table, workers_import
from meshwork.llm.exact_dedup import LOWER, UPPER

ROWS = 20_000
TREES, DEPTH, RATE, BINS = 40, 3, 0.2, 32
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: Hosts are dealt out to so many folds; a training URL sees the suffix shares of the others.
FOLDS = 5


def split_url(url: str) -> tuple[Column, Column]:
    """(host, path) columns of a URL column."""
    known = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(known, "://")
    rest = F.when(at > 0, known.substr(at + 3, F.length(known))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(host) + 1, F.length(rest) + 1), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def rule_of(host: str, path: str, rules=RULES) -> Column:
    """The longest rule that fits, else null."""
    out = None
    for text, _ in sorted(rules, key=lambda r: -len(r[0])):
        domain, _, rest = text.partition("/")
        fits = ((F.col(host) == domain) | F.col(host).endswith("." + domain)) & F.col(path).startswith("/" + rest)
        out = F.when(fits, F.lit(text)) if out is None else out.when(fits, F.lit(text))
    return out


def entropy(text: str) -> float:
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values()) if n else 0.0


_ADDRESS = re.compile(r"\[.*\]|\d{1,3}(?:\.\d{1,3}){3}")


def suffixes(host: str) -> tuple[str, ...]:
    """The last label and the last two of a host without user and port; none for an address."""
    name = re.sub(r":\d*$", "", host.rpartition("@")[2]).rstrip(".")
    if _ADDRESS.fullmatch(name):
        return ("address", "address")
    parts = name.split(".")
    return parts[-1], ".".join(parts[-2:])


def lexical(url: str | None, host: str, path: str) -> list[float]:
    url = url or ""
    query = url.partition("?")[2].partition("#")[0]
    digits = sum(map(str.isdigit, url))
    segments = [s for s in path.split("/") if s]
    return [len(url), len(host), len(path), len(segments), digits / max(1, len(url)), sum(map(str.isdigit, host)) / max(1, len(host)), entropy(host), entropy(path), sum(1 for p in query.split("&") if p), len(query), host.count("."), host.count("-"), float(url[:5].lower() == "https"), float("#" in url), float(path.endswith("/")), float("." in (segments[-1] if segments else ""))]


@dataclass
class Model:
    base: float = -30.0
    trees: list = field(default_factory=list)
    rates: dict = field(default_factory=dict)
    prior: float = 0.0

    def features(self, rows, rates=None) -> np.ndarray:
        """rates: of each row, where they are not the model's own."""
        known = [self.rates] * len(rows) if rates is None else rates
        return np.array([lexical(*r) + [have.get(s, self.prior) for s in suffixes(r[1])] for r, have in zip(rows, known, strict=True)], dtype=float)

    def blocked(self, rows) -> np.ndarray:
        """Probability that each (url, host, path) is to be blocked."""
        if not len(rows):
            return np.zeros(0)
        x = self.features(rows)
        total = np.full(len(x), self.base)
        for tree in self.trees:
            total += apply_tree(tree, x)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def apply_tree(tree, x: np.ndarray) -> np.ndarray:
    """tree: a float, or (feature, bound, low side, high side)."""
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    k, bound, low, high = tree
    left = x[:, k] <= bound
    out = np.empty(len(x))
    out[left], out[~left] = apply_tree(low, x[left]), apply_tree(high, x[~left])
    return out


def grow(x, grad, curve, cuts, depth, least=5.0, ridge=1.0):
    """A regression tree on gradients, split where the gain is largest."""
    g, h = grad.sum(), curve.sum()
    best = (1e-6, None, None)
    if depth and len(x) > 1:
        for k, bounds in enumerate(cuts):
            for b in bounds:
                left = x[:, k] <= b
                gl, hl = grad[left].sum(), curve[left].sum()
                if left.sum() < least or (~left).sum() < least:
                    continue
                gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge)
                if gain > best[0]:
                    best = (gain, k, b)
    if best[1] is None:
        return float(RATE * g / (h + ridge))
    left = x[:, best[1]] <= best[2]
    return (best[1], float(best[2]), grow(x[left], grad[left], curve[left], cuts, depth - 1), grow(x[~left], grad[~left], curve[~left], cuts, depth - 1))


def train(rows: list[tuple], blocked: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Model:
    """rows: (url, host, path); blocked: 1 or 0 for each."""
    if not len(rows):
        return Model()
    rate = float(blocked.mean())
    if rate in (0.0, 1.0):
        return Model(base=30.0 if rate else -30.0)
    fold = [crc32(r[1].encode("utf-8", "replace")) % FOLDS for r in rows]

    def shares(without: int | None) -> dict[str, float]:
        seen: dict[str, list[float]] = {}
        for r, y, f in zip(rows, blocked, fold, strict=True):
            if f != without:
                for s in set(suffixes(r[1])):
                    held = seen.setdefault(s, [0.0, 0.0])
                    held[0] += y
                    held[1] += 1
        return {s: (a + 2 * rate) / (n + 2) for s, (a, n) in seen.items()}

    model = Model(float(np.log(rate / (1 - rate))), [], shares(None), rate)
    others = [shares(k) for k in range(FOLDS)]
    x = model.features(rows, [others[f] for f in fold])
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for k in range(x.shape[1])]
    total = np.full(len(x), model.base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        tree = grow(x, blocked - p, p * (1 - p), cuts, depth)
        model.trees.append(tree)
        total += apply_tree(tree, x)
    return model


def located(pages: DataFrame, url_col: str, rules=RULES) -> DataFrame:
    """The pages' own columns with host_, path_ and rule_."""
    host, path = split_url(url_col)
    return pages.withColumns({"host_": host, "path_": path}).withColumn("rule_", rule_of("host_", "path_", rules))


def fit(pages: DataFrame, url_col: str = "url", labels: DataFrame | None = None, rules=RULES, rows: int = ROWS) -> Model:
    """labels: (url, blocked 0/1); by default the URLs that rules decide."""
    verdicts = dict(rules)
    if labels is None:
        known = located(pages.select(F.col(url_col).alias("url")), "url", rules).where("rule_ IS NOT NULL").select("url", "host_", "path_", F.col("rule_").isin([r for r, v in verdicts.items() if v == "block"]).cast("int").alias("y"))
    else:
        known = located(labels.select(F.col(url_col).alias("url"), F.col("blocked").cast("int").alias("y")), "url", rules).select("url", "host_", "path_", "y")
    # at most ``rows`` URLs
    known = known.where("url IS NOT NULL AND y IS NOT NULL")
    n = known.count()
    if n > rows:  # drawn by URL, so that the copies of a URL stay together, before they are made one
        known = known.where(draw("url") < rows / n)
    sample = known.distinct().orderBy(F.xxhash64("url"), "url", "y").limit(rows).collect()
    return train([(r[0], r[1], r[2]) for r in sample], np.array([r[3] for r in sample], float))


def verdicts(pages: DataFrame, model: Model, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """``id_col``, host, path, rule, verdict, score (of the trees: blocked)."""
    import pyarrow as pa

    workers_import(pages.sparkSession)
    held = pages.sparkSession.sparkContext.broadcast(model)
    names = [id_col, "host", "path", "rule", "score"]

    def run(batches):
        for batch in batches:
            rows = list(zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True))
            score = pa.array(held.value.blocked(rows), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), batch.column(4), score], names=names)

    kind = pages.schema[id_col].dataType.simpleString()
    rows = located(pages.select(id_col, F.col(url_col).alias("url_")), "url_", rules)
    scored = rows.select(id_col, "url_", "host_", "path_", "rule_").mapInArrow(run, f"`{id_col}` {kind}, host string, path string, rule string, score double")
    by_rule = F.when(F.col("rule").isin([r for r, v in rules if v == "block"]), "block").when(F.col("rule").isNotNull(), "allow")
    return scored.withColumn("verdict", F.coalesce(by_rule, F.when(F.col("score") >= 0.5, "block").otherwise("allow")))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return verdicts(pages, fit(pages)).select("page_id", "host", "path", "rule", "verdict", "score")
