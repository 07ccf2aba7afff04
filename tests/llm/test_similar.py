"""Near copies by five-word similarity against a plain version over all pairs."""

import corpus_pipeline
from meshwork.llm import similar, survivors
from tests.conftest import SF


def plain_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def plain_kept(rows):
    """rows: (id, text) with distinct ids; the smallest id of each group stays."""
    sets, root = {i: plain_set(t) for i, t in rows}, {i: i for i, _ in rows}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {i for i in ids if top(i) == i}


def kept(spark, docs):
    return sorted(r[0] for r in corpus_pipeline.near_copies(spark, docs, SF).select("doc_id").collect())


def test_near_copies_finds_all_pairs_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").dropDuplicates(["text"])
    want = plain_kept([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    assert kept(spark, docs) == sorted(want)


def test_near_copies_at_the_bound_and_in_large_groups(spark):
    import random

    draw = random.Random(7)
    word = lambda: f"w{draw.randrange(10**6)}"
    rows = []
    for n in (5, 6, 9, 13, 40, 41, 44, 45, 49, 200):  # edits around the bound
        base = [word() for _ in range(n)]
        for edits in range(0, 6):
            own = list(base)
            for _ in range(edits):
                own[draw.randrange(n)] = word()
            rows.append(" ".join(own).upper() if edits % 2 else "  ".join(own))
        rows.append(" ".join(base[: n * 4 // 5 + 1]))
    base = [word() for _ in range(120)]
    for _ in range(150):  # a chain and a star of near copies
        own = list(base)
        own[draw.randrange(120)] = word()
        rows.append(" ".join(own))
        base = own if draw.random() < 0.3 else base
    common = " ".join(word() for _ in range(30))
    rows += [common + " " + " ".join(word() for _ in range(draw.choice((2, 4, 6, 8, 30)))) for _ in range(60)]
    rows += ["", " \n", "one two", "One  two", "one three"]
    draw.shuffle(rows)
    rows = list(enumerate(rows))
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    want = sorted(plain_kept(rows))
    assert kept(spark, docs) == want
    assert kept(spark, docs.limit(0)) == []
    similar.SAMPLE_ROWS, held = 20, similar.SAMPLE_ROWS  # another order of the shingles gives the same
    try:
        assert kept(spark, docs) == want
    finally:
        similar.SAMPLE_ROWS = held
    held = similar.FEW, similar.FASTER, similar.ENOUGH
    similar.FEW, similar.FASTER, similar.ENOUGH = 1, 3, 0  # rounds up to the largest bucket give the same, too
    try:
        assert kept(spark, docs) == want
    finally:
        similar.FEW, similar.FASTER, similar.ENOUGH = held


def test_pairs_are_verified_whatever_way_the_sets_take(spark, monkeypatch):
    """Hubs, single pairs and long texts, by broadcast and by shuffle."""
    import random

    from pyspark.sql import functions as F

    draw = random.Random(11)
    texts = []
    for k in range(12):
        base = [f"w{draw.randrange(10**7)}" for _ in range(400)]
        for _ in range(40 if k < 2 else 6):
            own = list(base)
            for _ in range(draw.choice((0, 3, 12, 25))):
                own[draw.randrange(400)] = "x"
            texts.append((k, " ".join(own)))
    sets = [plain_set(t) for _, t in texts]
    pairs = [(i, j) for i, x in enumerate(texts) for j, y in enumerate(texts[:i]) if x[0] == y[0] and (j % 6 == 0 or draw.random() < 0.1)] + [(3, 470 % len(texts)), (5, 100)]
    want = sorted((min(p), max(p)) for p in pairs if 5 * len(sets[p[0]] & sets[p[1]]) >= 4 * len(sets[p[0]] | sets[p[1]]))
    assert 0 < len(want) < len(pairs)
    rows = spark.createDataFrame([(i, t.encode()) for i, (_, t) in enumerate(texts)], "node long, raw binary").repartition(3)
    asked = spark.createDataFrame(pairs, "a long, b long").repartition(3)
    for light, hot, most in ((500_000, 1000, 1 << 16), (0, 1000, 1 << 16), (500_000, 20, 1 << 16), (0, 20, 1 << 16), (500_000, 20, 100), (500_000, 1, 1 << 16)):
        monkeypatch.setattr(similar, "LIGHT", light)
        monkeypatch.setattr(similar, "HOT", hot, raising=False)
        monkeypatch.setattr(similar, "HOT_BYTES", most)
        got = similar._verified(rows, asked).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).collect()
        assert sorted(map(tuple, got)) == want


def test_rows_are_not_shuffled_to_drop_some(spark):
    """However large the rows: the keys of those that go are broadcast."""
    docs = spark.range(100).selectExpr("cast(id as string) as key", "repeat('x', 1000) as text")
    groups = spark.range(40).selectExpr("cast(id as string) as key", "cast(id div 2 * 2 as string) as best")
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = survivors.survivors(docs, "key", groups)
        assert left.count() == 80
        assert "SortMergeJoin" not in left._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def test_one_row_of_each_group_stays(spark):
    """Null, repeated and tied ids, a large group of equal rows, clashing names."""
    text = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen"
    near = text + " eighteen"
    rows = [(6, "A same text", "x"), (1, "a SAME text", "x"), (6, "another text of its own", "x"), (None, "null twice", "x"), (None, "null twice", "y"), (None, "NULL twice", "x"), (7, "equal rows", None), (7, "equal rows", None)]
    rows += [(-5, text, "x"), (9, near, "x"), (8, near.upper(), "x"), (10, None, "x"), (11, "", "x"), (12, "  ", "x")] + [(20, "many equal rows", "z")] * 1000 + [(30 + i, f"own text {i} {i * i}", "z") for i in range(40)]
    docs = spark.createDataFrame([(i, t, s, "k", 1, 2, "b") for i, t, s in rows], "doc_id long, text string, source string, row_key string, n long, node long, best string").repartition(7)
    exact = corpus_pipeline.exact_copies(spark, docs, SF)
    assert exact.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"] or "") for r in exact.collect()), key=str)
    want = {(1, "a SAME text"), (6, "another text of its own"), (7, "equal rows"), (-5, text), (8, near.upper()), (10, ""), (12, "  "), (20, "many equal rows")} | {(r[0], r[1]) for r in rows if r[0] and r[0] >= 30}
    assert [x for x in got if x[0] is not None] == sorted(want, key=str)
    assert len([x for x in got if x[0] is None]) == 1 and len(got) == len(want) + 1
    left = sorted(((r["doc_id"], r["text"] or "") for r in corpus_pipeline.near_copies(spark, docs, SF).collect()), key=str)
    assert [x for x in left if x[0] is not None] == sorted(want - {(8, near.upper()), (12, "  ")}, key=str)
    assert len(left) == len(want) - 1
    assert corpus_pipeline.exact_copies(spark, docs.limit(0), SF).count() == corpus_pipeline.near_copies(spark, docs.limit(0), SF).count() == 0


def test_keys_keep_the_order_of_ids(spark):
    ids = [-(2**63), -7, -1, 0, 1, 9, 10, 2**63 - 1, None]
    df = spark.createDataFrame([(i, "t") for i in ids], "doc_id long, text string")
    keys = [r[0] for r in df.select(survivors.row_key(df)).collect()]
    assert keys == sorted(keys) and len(set(keys)) == len(ids)
    odd = spark.createDataFrame([(1, None, "a"), (1, "a", None), (1, "", "a"), (1, "a", "")], "doc_id long, x string, y string")
    assert odd.select(survivors.row_key(odd)).distinct().count() == 4


def test_components_in_one_task_and_by_steps(spark):
    """Chains, stars and loops: both ways find the smallest node, and few edges take few jobs."""
    import random

    from meshwork.llm import simhash

    draw = random.Random(3)
    edges = [(i + 1, i) for i in range(-300, -200)] + [(1000, i) for i in range(1001, 1100)] + [(7, 7), (8, 9), (9, 8)] + [(draw.randrange(2000, 2400), draw.randrange(2000, 2400)) for _ in range(250)]
    df = spark.createDataFrame(edges, "a long, b long")
    root: dict = {}

    def top(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in edges:
        x, y = sorted((top(a), top(b)))
        root[y] = x
    want = sorted((i, top(i)) for i in root if top(i) != i)
    spark.sparkContext.setJobGroup("few", "few edges")
    assert sorted(map(tuple, simhash.components(df).collect())) == want
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("few")) <= 12
    simhash.TOGETHER, held = 0, simhash.TOGETHER
    try:
        assert sorted(map(tuple, simhash.components(df).collect())) == want
    finally:
        simhash.TOGETHER = held
