import random
import re

import numpy as np

from lenstrail.llm import common
from lenstrail.llm import ngram_join as N


def shingles(text, k=5):
    w = re.findall(r"\w+", (text or "").lower())
    return {tuple(w[i : i + k]) for i in range(max(len(w) - k + 1, 1))} if w else set()


def brute(rows, threshold=0.8):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    low = {}
    for i, (doc_id, _) in enumerate(rows):
        low[root(i)] = min(low.get(root(i), doc_id), doc_id)
    return {rows[i][0]: (low[root(i)], links[i]) for i in range(len(rows))}


def corpus(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    say = lambda n: [rng.choice(words) for _ in range(n)]
    rows = []
    bases = [say(rng.randint(40, 200)) for _ in range(12)]
    for i in range(260):
        kind = i % 4
        w = list(rng.choice(bases))
        if kind == 0:
            w = say(rng.randint(0, 60))
        elif kind == 1:
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = rng.choice(words)
        elif kind == 2:
            w = w + say(rng.randint(0, 12))
        rows.append((i * 3 + 1, " ".join(w)))
    return rows


def check(spark, rows, parts=4):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    got = {r.doc_id: r for r in N.ngram_join(df).collect()}
    want = brute(rows)
    assert len(got) == len(rows)
    assert {d: (r.class_id, r.n_links) for d, r in got.items()} == want
    assert {d for d, r in got.items() if r.kept} == {c for c, _ in want.values()}


def test_equals_brute_force(spark):
    check(spark, corpus(1))


def test_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 8)
    monkeypatch.setattr(N, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(N, "DIFF_BLOCK", 6)
    check(spark, corpus(2))


def test_kept_documents_are_the_same_without_counts(spark, monkeypatch):
    """Blocks of one component are not paired then."""
    for name, value in (("BLOCK", 8), ("BLOCK_BYTES", 3000), ("DIFF_BLOCK", 3)):
        monkeypatch.setattr(N, name, value)
    rows = corpus(5)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute(rows)
    got = {r.doc_id: r for r in N.ngram_join(df, count_links=False).collect()}
    assert {d: r.class_id for d, r in got.items()} == {d: c for d, (c, _) in want.items()}
    assert sorted(r.doc_id for r in N.distinct_documents(df).collect()) == sorted({c for c, _ in want.values()})


def test_one_long_text_and_its_near_copies(spark, monkeypatch):
    rng = random.Random(4)
    long = [f"w{rng.randrange(5000)}" for _ in range(60_000)]
    rows = []
    for i in range(9):
        w = list(long)
        for _ in range(i * 150):
            w[rng.randrange(len(w))] = f"x{i}{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    check(spark, rows + [(9, "few words")])


def test_leaders_that_do_not_link(spark, monkeypatch):
    """Members that miss their leader must still find each other."""
    monkeypatch.setattr(N, "BLOCK", 4)
    monkeypatch.setattr(N, "DIFF_BLOCK", 5)
    rng = random.Random(9)
    core = [f"c{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(24):
        family = i % 6
        own = [f"f{family}x{k}" for k in range(40)]
        tail = [f"r{i}"]
        rows.append((i, " ".join(core + own + tail)))
    check(spark, rows)


def test_edge_rows(spark):
    rows = [(1, None, 1), (2, "", 2), (3, "?!", 3), (4, "one two", 4), (5, "One, two!", 5), (None, "one two", 6), (4, "one two", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept int")
    got = N.ngram_join(df).collect()
    assert len(got) == 7
    by = {(r.doc_id, r.class_id, r.n_links, r.kept) for r in got}
    assert by == {(1, 1, 0, True), (2, 2, 0, True), (3, 3, 0, True), (4, 4, 3, True), (5, 4, 3, False), (None, 4, 3, False)}
    out = N.distinct_documents(df)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == [1, 2, 3, 4]
    assert N.ngram_join(df.limit(0)).count() == 0 and N.distinct_documents(df.limit(0)).count() == 0


def test_pruning_keeps_what_can_reach_the_threshold():
    steps = N.least_matches(0.8, N.TOLERANCE)
    assert steps[-1][0] == N.HASHES and all(0 < m < 0.8 * n for n, m in steps[1:])


def test_pairs_at_the_threshold_are_hardly_ever_dropped():
    alive, at = np.ones(1), 0  # how likely m of `at` values agree and the pair is kept
    for n, least in N.least_matches(0.8, N.TOLERANCE):
        for _ in range(n - at):
            alive = np.append(0.2 * alive, 0) + np.append(0, 0.8 * alive)
        at = n
        alive[:least] = 0
    assert 1 - alive.sum() < 1e-5


def tasks_of(spark, work):
    """Result of `work`, and how many tasks its jobs had."""
    group = f"tasks-{random.random()}"
    spark.sparkContext.setJobGroup(group, "counted by a test")
    try:
        out = work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    infos = [tracker.getStageInfo(s) for s in stages]
    return out, sum(i.numCompletedTasks for i in infos if i)


def test_rounds_over_few_links_need_few_tasks(spark, monkeypatch):
    chain = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)]
    edges = spark.createDataFrame(chain, "a long, b long")
    settings = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        got, tasks = tasks_of(spark, lambda: {r.id: r.component for r in common.components(edges).collect()})
        monkeypatch.setattr(common, "MAX_BROADCAST", 0)  # minima by a shuffle: the same components
        shuffled = {r.id: r.component for r in common.components(edges).collect()}
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)
    assert got == shuffled == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)}
    assert tasks < 600, tasks


def test_blocks_by_broadcast_and_by_shuffle(spark, monkeypatch):
    rows = corpus(9)
    monkeypatch.setattr(N, "BLOCK", 4)
    check(spark, rows)
    monkeypatch.setattr(common, "MAX_BROADCAST", 0)
    check(spark, rows)
