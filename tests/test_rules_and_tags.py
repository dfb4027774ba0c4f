import math
import random
from itertools import combinations

from conftest import rows
from lenstrail.config import Roi
from lenstrail.operators import rules, tags

NAMES = ["A", "B", "C", "D"]
BOXES = [Roi(n, 0, 2, i, i + 2) for i, n in enumerate(NAMES)]


def mined(spark):
    rnd = random.Random(3)
    sets = [sorted(rnd.sample(NAMES, rnd.randint(1, 4))) for _ in range(60)] + [["A", "B"]] * 30
    tx = spark.createDataFrame([(f"u{i}", s) for i, s in enumerate(sets)], "user_id string, items array<string>")
    return sets, tx


def brute(sets, support, confidence):
    n = len(sets)
    freq = {}
    for size in range(1, 5):
        for c in combinations(NAMES, size):
            f = sum(set(c) <= set(s) for s in sets)
            if f >= math.ceil(support * n):
                freq[c] = f
    found = []
    for items, f in freq.items():
        for last in items:
            rest = tuple(i for i in items if i != last)
            if rest and f / freq[rest] >= confidence:
                conf = f / freq[rest]
                found.append((list(rest), [last], conf, conf / (freq[last,] / n), f / n))
    return freq, found


def test_mining_equals_enumeration(spark):
    sets, tx = mined(spark)
    freq, found = brute(sets, 0.3, 0.5)
    assert rows(rules.frequent_itemsets(tx, 0.3)) == sorted([(list(k), v) for k, v in freq.items()], key=repr)
    got = rows(rules.association_rules(tx, 0.3, 0.5))
    assert [r[:2] for r in got] == [r[:2] for r in sorted(found, key=repr)]
    for a, b in zip(got, sorted(found, key=repr)):
        assert all(abs(x - y) < 1e-12 for x, y in zip(a[2:], b[2:]))
    kept = rules.filter_rules(rules.association_rules(tx, 0.3, 0.5), exclude="B", n=None).collect()
    assert {(tuple(r.antecedent), r.consequent[0]) for r in kept} == {
        (tuple(a), c[0]) for a, c, _, lift, _ in found if lift > 1 and c != ["B"]
    }


def test_transactions(visits):
    df = visits(
        [
            ("1", "a", "2010-01-01 00:00:00", "B"),
            ("2", "a", "2010-01-01 00:00:00", "A"),
            ("3", "a", "2010-01-02 00:00:00", "B"),
            ("4", "a", "1999-01-02 00:00:00", "C"),
            ("5", "b", "2010-01-02 00:00:00", "Unknown"),
        ]
    )
    assert rows(rules.user_transactions(df)) == [("a", ["A", "B"])]


RULES = "antecedent array<string>, consequent array<string>, confidence double, lift double, support double"


def test_links_and_nodes(spark):
    df = spark.createDataFrame(
        [
            (["B", "A"], ["C"], 0.5, 2.0, 0.1),
            (["A"], ["C"], 0.29, 1.0, 0.2),
            (["B"], ["A"], 0.2, 1.0, 0.3),
            (["D"], ["A"], 0.19, 9.0, 0.3),
        ],
        RULES,
    )
    links = rules.flow_links(df)
    got = rows(links)
    assert [r[:2] for r in got] == [("A", "C"), ("B", "A")]
    assert got[0][2:4] == (0.5, 1.5) and abs(got[0][4] - 0.3) < 1e-12 and got[0][5] == 50
    nodes = rules.flow_nodes(links)
    assert rows(nodes) == [("A", 0), ("B", 1), ("C", 2)]
    numbered = rules.flow_link_indices(links, nodes).select("source_idx", "target_idx")
    assert rows(numbered) == [(0, 2), (1, 0)]
    # 0.29 * 100 is just below 29 in floating point and is cut, not rounded
    assert rules.flow_links(df.limit(2).filter("confidence < 0.5")).first()["thickness"] == int(0.29 * 100)


def test_next_step(spark):
    df = spark.createDataFrame(
        [
            (["A"], ["B"], 0.3, 1.0, 0.1),
            (["A", "C"], ["B"], 0.6, 2.0, 0.1),
            (["A", "D"], ["B"], 0.6, 3.0, 0.1),
            (["A"], ["C"], 0.25, 1.0, 0.1),
            (["A"], ["D"], 0.1, 1.0, 0.1),
            (["A"], ["X"], 0.9, 1.0, 0.1),
            (["X"], ["A"], 0.9, 1.0, 0.1),
        ],
        RULES,
    )
    recs = rules.next_step(df, BOXES, n=2)
    assert rows(recs.filter("source = 'A'")) == [("A", 1, "B", 0.6, 3.0), ("A", 2, "C", 0.25, 1.0)]
    assert rows(rules.start_places(df, BOXES)) == [("A",), ("C",), ("D",)]
    arc = rules.next_step_arcs(recs, BOXES).filter("source = 'A' AND target = 'C'").first()
    assert (arc.source_lat, arc.source_lon, arc.target_lon) == (1.0, 1.0, 3.0)
    assert arc.width == 0.25 * 15 and arc.strong is False


def test_tag_rules(spark):
    words = ["Rome", "abc\n", "àb", "k69", "", "Foo", "foo", "bar", None, "flickr"]
    df = spark.createDataFrame(
        [("A", words), ("A", ["zed", "bar"]), ("A", None), ("A", []), ("Unknown", ["foo"])],
        "roi string, tags array<string>",
    )
    assert rows(tags.roi_word_counts(df)) == [("A", "bar", 2), ("A", "foo", 2), ("A", "zed", 1)]
    assert rows(tags.roi_tags(df, n=1)) == [("A", "bar", 2)]
    assert rows(tags.roi_word_weights(tags.roi_tags(df), n=2)) == [("A", "bar", 2, 1, 0.5), ("A", "foo", 2, 2, 0.5)]
