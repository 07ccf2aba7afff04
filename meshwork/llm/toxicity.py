"""Toxicity scores from a learnt lexicon matched by Levenshtein automata.

The lexicon holds words, and stems with any ending, that occur in toxic training
documents and hardly in others. Its trie intersected with the Levenshtein
automata of its terms is made into deterministic automata (of ``GROUP`` terms each, as
a single one grows faster than its terms), which run over the words of many documents
at once. Each match looks at its context: matches between paired quotation marks of a
line or beside a reporting verb are quotation. A logistic model on the weight and density
of the other matches, and on the weight of the quoted ones with coefficients of their
own, gives the score; what quotation is worth is learnt from the labels.

Everything is learnt from bounded samples of labelled rows (``toxic_rows`` and
``clean_rows``, chosen by the hashes of their ids) outside the held-out
fold; the lexicon holds every term that passes the tests of ``choose_terms``, so
the samples bound it.

Defined results: a null or empty text is scored like a text without matches; a
null id is never used for training; repeated rows score alike; without toxic
training rows every score is the smoothed prior; an empty table gives none;
extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshwork.llm.common import bounded_sample, cut, fold, table, workers_import

TOXIC_ROWS = 5_000
CLEAN_ROWS = 15_000
THRESHOLD = 0.3
FEATURES = 6
SHORTEST, LONGEST = 4, 16
#: Closing marks of each opening one; straight marks pair in turns.
CLOSING = {"“": "”", "„": "“”", "«": "»", "»": "«", "‘": "’"}
_MARK = re.compile('["“”„«»‘]')
REPORTING = ("said", "says", "called", "wrote", "quoted", "so-called", "sagte", "nannte", "schrieb", "dit", "appelé", "écrit", "dijo", "llamó", "escribió")
#: Characters of a word besides letters and digits: those that stand in for letters.
EXTRA = "@$*€"
#: Terms of one deterministic automaton.
GROUP = 40
CODES = 0x250


def _char_classes() -> np.ndarray:
    """For code points under CODES: 1 if the character belongs to words."""
    return np.array([chr(c).isalnum() or chr(c) in EXTRA for c in range(CODES)], bool)


_IN_WORD = _char_classes()


def words_of(text: str) -> set[str]:
    out, held = set(), []
    for c in text.lower():
        if c.isalnum() or c in EXTRA:
            held.append(c)
        elif held:
            out.add("".join(held))
            held = []
    if held:
        out.add("".join(held))
    return out


def allowed_edits(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 10 else 2


class _Part:
    """The deterministic automaton of some of the terms."""

    def __init__(self, terms: list[tuple[str, bool]], places: list[int]):
        """places: the terms' numbers in the whole lexicon, ascending."""
        self.places = np.array(places, np.int32)
        # the lengths that a word within the allowed edits can have
        self.shortest = min(len(t) - allowed_edits(t) for t, _ in terms)
        self.longest = max((1 << 30) if stem else len(t) + allowed_edits(t) for t, stem in terms)
        children: list[dict[str, int]] = [{}]
        ends: list[list[int]] = [[]]
        most = [0]
        for k, (text, _) in enumerate(terms):
            node, edits = 0, allowed_edits(text)
            most[0] = max(most[0], edits)
            for c in text:
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({})
                    ends.append([])
                    most.append(0)
                node = children[node][c]
                most[node] = max(most[node], edits)
            ends[node].append(k)
        alphabet = sorted({c for t, _ in terms for c in t})
        self.classes = np.zeros(CODES, np.int32)  # 0: any other character
        for i, c in enumerate(alphabet):
            if ord(c) < CODES:
                self.classes[ord(c)] = i + 1
        self.far = np.array([ord(c) for c in alphabet if ord(c) >= CODES], np.uint32)  # the last classes
        self.first_far = len(alphabet) - len(self.far) + 1

        def closed(items) -> frozenset:
            best: dict[int, int] = {}
            queue = list(items)
            while queue:
                node, e = queue.pop()
                if e > most[node] or best.get(node, 9) <= e:
                    continue
                best[node] = e
                queue += [(child, e + 1) for child in children[node].values()]
            return frozenset(best.items())

        def step(items: frozenset, c: str | None) -> frozenset:
            out = []
            for node, e in items:
                for label, child in children[node].items():
                    out.append((child, e + (label != c)))
                out.append((node, e + 1))
            return closed(out)

        def accepts(items, stems: bool):
            found = [(e, k) for node, e in items for k in ends[node] if e <= allowed_edits(terms[k][0]) and (terms[k][1] or not stems)]
            return min(found, default=None)

        start = closed([(0, 0)])
        number, order, rows = {start: 1}, [start], [[0] * (len(alphabet) + 1)]
        final = [(-1, 0)]
        absorbing = [False]
        at = 0
        while at < len(order):
            items = order[at]
            at += 1
            whole = accepts(items, False)
            final.append((whole[1], whole[0]) if whole else (-1, 0))
            stem = accepts(items, True)
            # a stem matched in full needs no more; one matched with an edit may yet match better
            absorbing.append(bool(stem and stem[0] == 0))
            row = []
            for c in [None, *alphabet]:
                got = step(items, c)
                if not got:
                    row.append(0)
                    continue
                if got not in number:
                    number[got] = len(order) + 1
                    order.append(got)
                row.append(number[got])
            rows.append(row)
        self.moves = np.array(rows, np.int32)
        self.final = np.array(final, np.int32)
        self.absorbing = np.array(absorbing, bool)
        # the best edited stem on the way is remembered by the scan
        self.stem = np.full((len(rows), 2), -1, np.int32)
        for i, items in enumerate(order, 1):
            if got := accepts(items, True):
                self.stem[i] = (got[1], got[0])

    def run(self, codes: np.ndarray, small: np.ndarray, starts: np.ndarray, ends: np.ndarray, most: np.ndarray) -> None:
        """Lowers the rows of ``most`` (edits, place, whole, term; by word) to the matches here."""
        classes = np.where(codes < CODES, self.classes[small], 0)
        if len(self.far):
            beyond = np.flatnonzero(codes >= CODES)
            at = np.minimum(np.searchsorted(self.far, codes[beyond]), len(self.far) - 1)
            classes[beyond] = np.where(self.far[at] == codes[beyond], at + self.first_far, 0)
        alive = np.flatnonzero((ends - starts >= self.shortest) & (ends - starts <= self.longest))
        state = np.ones(len(alive), np.int32)
        i = 0
        while len(alive):
            state = self.moves[state, classes[starts[alive] + i]]
            i += 1
            over = starts[alive] + i >= ends[alive]
            self._lower(most, alive, self.stem[state], i, 0)
            if over.any():
                self._lower(most, alive[over], self.final[state[over]], i, 1)
            going = ~over & (state > 0) & ~self.absorbing[state]
            alive, state = alive[going], state[going]

    def _lower(self, most: np.ndarray, words: np.ndarray, got: np.ndarray, i: int, whole: int) -> None:
        hit = got[:, 0] >= 0
        if not hit.any():
            return
        words, got = words[hit], got[hit]
        new = np.stack([got[:, 1], np.full(len(got), i), np.full(len(got), whole), self.places[got[:, 0]]], 1)
        old = most[words]
        less, same = np.zeros(len(words), bool), np.ones(len(words), bool)
        for k in range(4):
            less |= same & (new[:, k] < old[:, k])
            same &= new[:, k] == old[:, k]
        most[words[less]] = new[less]


class Automaton:
    """Words within the allowed edits of a term, or beginning so for a stem: the match
    of fewest edits, of these the one that ends first, then a stem, then the first term."""

    def __init__(self, terms: list[tuple[str, bool]]):
        """terms: (text, whether any ending may follow)."""
        self.terms = terms
        order = sorted(range(len(terms)), key=lambda k: (len(terms[k][0]), terms[k][0], k))
        groups = [sorted(order[i : i + GROUP]) for i in range(0, len(order), GROUP)]
        self.parts = [_Part([terms[k] for k in g], g) for g in groups]

    def scan(self, text: str) -> tuple[list[tuple[int, int, int, int]], int]:
        """Matches (start, end, term, edits) in a lower-cased text, and its words."""
        codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
        return self.scan_codes(codes)

    def scan_codes(self, codes: np.ndarray):
        small = np.minimum(codes, CODES - 1)
        inside = np.zeros(len(codes) + 2, bool)
        inside[1:-1] = _IN_WORD[small] | (codes >= CODES)
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        most = np.full((len(starts), 4), 1 << 30, np.int32)
        for part in self.parts:
            part.run(codes, small, starts, ends, most)
        found = np.flatnonzero(most[:, 0] < 1 << 30)
        return [(int(starts[w]), int(ends[w]), int(most[w, 3]), int(most[w, 0])) for w in found], starts


def quoted_spans(text: str) -> list[tuple[int, int]]:
    """(begin, end) between paired quotation marks of a line: straight ones in turns, the
    others from an opening to its closing one. A mark without its partner quotes nothing."""
    out, line = [], 0
    for part in text.split("\n"):
        straight, opened = -1, []
        for m in _MARK.finditer(part):
            c, at = m[0], line + m.start()
            if c == '"':
                if straight < 0:
                    straight = at
                else:
                    out.append((straight, at))
                    straight = -1
            elif opened and c in CLOSING[text[opened[-1]]]:
                out.append((opened.pop(), at))
            elif c in CLOSING:
                opened.append(at)
        line += len(part) + 1
    return out


def reported(text: str, start: int, end: int) -> bool:
    """Whether a match stands beside a reporting verb."""
    near = f"{text[max(0, start - 24) : start]} ".split() + text[end : end + 16].split()[:1]
    return any(w.strip(".,;:") in REPORTING for w in near)


def quotation(text: str, start: int, end: int, spans: list[tuple[int, int]] | None = None) -> bool:
    """Whether a match stands between paired quotation marks or beside a reporting verb."""
    spans = quoted_spans(text) if spans is None else spans
    return any(a < start and end <= b for a, b in spans) or reported(text, start, end)


@dataclass
class Model:
    terms: list[tuple[str, bool]] = field(default_factory=list)
    exact_only: frozenset = frozenset()  # (term, edits) that clean documents hold as well
    weights: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES))
    automaton: Automaton | None = None

    def hits(self, texts: list[str | None], most: int = 1 << 20):
        """For each text: matches (term, edits, quoted, text of the match), words."""
        if self.automaton is None:
            self.automaton = Automaton(self.terms)
        at = 0
        while at < len(texts):
            part, size = [], 0
            while at < len(texts) and (not part or size < most):
                low = (texts[at] or "").lower()
                part.append(low)
                size += len(low) + 1
                at += 1
            whole = "\n".join(part) + "\n"
            bounds = np.cumsum([0, *(len(p) + 1 for p in part)])
            found, starts = self.automaton.scan(whole)
            words = np.diff(np.searchsorted(starts, bounds))
            out: list[list] = [[] for _ in part]
            owner = np.searchsorted(bounds, [f[0] for f in found], side="right") - 1 if found else []
            last, spans = -1, []
            for o, (a, b, k, e) in zip(owner, found, strict=True):
                text, base = part[o], int(bounds[o])
                if o != last:
                    last, spans = o, quoted_spans(text)
                out[o].append((k, e, quotation(text, a - base, b - base, spans), whole[a:b]))
            yield from zip(out, words.tolist(), strict=True)

    def features(self, matches, words: int) -> list[float]:
        """Of the matches outside quotation: whether there are any, their weight and density;
        of those inside: whether there are any, and their weight."""
        weight = quoted_weight = 0.0
        for k, e, quoted, _ in matches:
            if (k, e) not in self.exact_only:
                if quoted:
                    quoted_weight += 1.0 if e == 0 else 0.5
                else:
                    weight += 1.0 if e == 0 else 0.5
        return [1.0, float(weight > 0), np.log1p(weight), min(1.0, 20 * weight / max(words, 1)), float(quoted_weight > 0), np.log1p(quoted_weight)]

    def scores(self, texts: list[str | None]) -> np.ndarray:
        rows = np.array([self.features(m, n) for m, n in self.hits(texts)]).reshape(-1, FEATURES)
        return 1 / (1 + np.exp(-np.clip(rows @ self.weights, -30, 30)))


def term_counts(texts: list[str]) -> Counter:
    """Documents that hold each prefix and, marked by a blank, each whole word."""
    total: Counter = Counter()
    for t in texts:
        words = [w for w in words_of(t or "") if len(w) >= SHORTEST]
        total.update({w[:n] for w in words for n in range(SHORTEST, min(len(w), LONGEST) + 1)} | {w + " " for w in words if len(w) <= LONGEST})
    return total


def choose_terms(toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int) -> list[tuple[str, bool]]:
    """Words and stems frequent in toxic documents and near absent in clean ones.

    So many documents must hold a term that, were labels drawn at random, less than
    one of all the terms looked at would be found in toxic documents alone.
    """
    share = (n_toxic + 1) / (n_toxic + n_clean + 2)
    least = max(3, 0.002 * n_toxic, np.log(max(len(toxic), 1)) / -np.log(share))
    pure = {p for p, n in toxic.items() if n >= least and clean.get(p, 0) / max(n_clean, 1) <= 0.02 * n / max(n_toxic, 1)}
    chosen: dict[str, tuple[int, bool]] = {}
    by_stem: dict[str, list[str]] = {}
    for p in toxic:
        if p[-1] != " ":
            by_stem.setdefault(p[:-1], []).append(p)
    for p in sorted(x for x in pure if x[-1] != " "):
        if p[:-1] in pure and len(p) > SHORTEST:
            continue  # its own prefix is looked at
        while True:  # lengthen while nearly all words go on alike
            longer = max(by_stem.get(p, []), key=lambda q: (toxic[q], q), default=None)
            if longer is None or toxic[longer] < 0.95 * toxic[p]:
                break
            p = longer
        chosen[p] = (toxic[p], toxic.get(p + " ", 0) < 0.5 * toxic[p])
    for w in (x[:-1] for x in pure if x[-1] == " "):
        if not any(w[:n] in chosen for n in range(SHORTEST, len(w) + 1)):
            chosen[w] = (toxic[w + " "], False)
    best = sorted(chosen.items(), key=lambda x: (-x[1][0], x[0]))
    return [(t, stem) for t, (_, stem) in best]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 30) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the first column is the constant."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + penalty * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        move = np.linalg.solve(curve, slope)
        w = w - move
        if np.abs(move).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", held_out: int = 2, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> Model:
    import pyarrow as pa

    spark = docs.sparkSession
    workers_import(spark)
    usable = labels.select(F.col(id_col).alias("row"), F.col(label_col).cast("int").alias("y")).where(F.col("row").isNotNull() & (fold("row") != held_out)).distinct()
    pick = lambda y, n: bounded_sample(usable.where(F.col("y") == y), "row", n)
    chosen = cut(pick(1, toxic_rows).union(pick(0, clean_rows)))  # at most toxic_rows + clean_rows ids
    sample = cut(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body")).join(F.broadcast(chosen), F.col("id") == F.col("row")).select("id", "y", "body"))
    sizes = {r[0]: r[1] for r in sample.groupBy("y").count().collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic:
        return Model([], frozenset(), np.array([np.log(0.5 / (n_clean + 0.5)), *[0.0] * (FEATURES - 1)]), Automaton([]))

    def count(batches):
        total: Counter = Counter()
        for batch in batches:
            total.update(term_counts(batch.column(0).to_pylist()))
        keys = list(total)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([total[k] for k in keys], pa.int64())], names=["term", "n"])

    # the sample is bounded, and so are its terms
    least = max(3, 0.002 * n_toxic)
    often = cut(sample.where("y = 1").select("body").mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("toxic")).where(F.col("toxic") >= least))
    toxic = dict(often.toPandas().itertuples(index=False, name=None))
    wanted = spark.sparkContext.broadcast(frozenset(toxic))

    def count_wanted(batches):
        total: Counter = Counter()
        for batch in batches:
            for k, n in term_counts(batch.column(0).to_pylist()).items():
                if k in wanted.value:
                    total[k] += n
        keys = list(total)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([total[k] for k in keys], pa.int64())], names=["term", "n"])

    clean = dict(sample.where("y = 0").select("body").mapInArrow(count_wanted, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas().itertuples(index=False, name=None))
    model = Model(choose_terms(toxic, clean, n_toxic, n_clean))
    if not model.terms:
        model.weights = np.array([np.log((n_toxic + 0.5) / (n_clean + 0.5)), *[0.0] * (FEATURES - 1)])
        return model
    model.automaton = Automaton(model.terms)
    held = spark.sparkContext.broadcast(model)

    def match(batches):
        for batch in batches:
            rows = list(held.value.hits(batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([[(k, e, int(q)) for k, e, q, _ in m] for m, _ in rows], pa.list_(pa.list_(pa.int32()))), pa.array([n for _, n in rows], pa.int64())], names=["y", "hits", "words"])

    found = sample.select("y", "body").mapInArrow(match, "y int, hits array<array<int>>, words long").toPandas()
    dirty: Counter = Counter()
    for y, hits in zip(found["y"], found["hits"], strict=True):
        if y == 0:
            dirty.update({(int(h[0]), int(h[1])) for h in hits if h[1] > 0})
    model.exact_only = frozenset(k for k, n in dirty.items() if n > max(1, 0.0002 * n_clean))
    x = np.array([model.features([(int(h[0]), int(h[1]), bool(h[2]), "") for h in hits], n) for hits, n in zip(found["hits"], found["words"], strict=True)])
    model.weights = logistic(x, found["y"].to_numpy(float))
    return model


def toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, score, matches (term, edits, quoted, word) of each document."""
    import pyarrow as pa

    held = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.struct([("term", pa.string()), ("edits", pa.int32()), ("quoted", pa.bool_()), ("word", pa.string())])

    def run(batches):
        model = held.value
        for batch in batches:
            scores, found = [], []
            for m, n in model.hits(batch.column(1).to_pylist()):
                x = float(np.dot(model.features(m, n), model.weights))
                scores.append(1 / (1 + np.exp(-min(30.0, max(-30.0, x)))))
                found.append([{"term": model.terms[k][0], "edits": e, "quoted": q, "word": w} for k, e, q, w in m])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(found, pa.list_(kind))], names=[id_col, "score", "matches"])

    own = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {own}, score double, matches array<struct<term:string,edits:int,quoted:boolean,word:string>>")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = toxicity(docs, fit(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", (fold("doc_id") == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), F.size("matches").cast("long").alias("n_matches"))
