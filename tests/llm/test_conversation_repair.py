import hashlib
import heapq
import random
import re
import zlib

import pytest

from lenstrail.llm import conversation_repair as R

SCHEMA = "conv_id long, turn long, role string, text string"


def ordered(rows):
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, repaired) by a search over whole edit lists in order of (cost, letters)."""
    fault = faults(rows)
    heap = [(0, "", 0, 0, ())]
    done = set()
    while heap:
        cost, audit, i, state, made = heapq.heappop(heap)
        if i == len(rows) and state in (0, 3):
            return cost, audit, made
        if (i, state, cost, audit) in done:
            continue
        done.add((i, state, cost, audit))

        def follow(role, state=state):
            if role[:1] == "s":
                return 1 if state == 0 else None
            if role[:1] == "u":
                return 2 if state != 2 else None
            return 3 if role[:1] == "a" and state == 2 else None

        if len(audit) <= 3 * len(rows) + 2:
            for role in ("user", "assistant"):
                if (to := follow(role)) is not None:
                    heapq.heappush(heap, (cost + 2, audit + "I", i, to, (*made, (role, ""))))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, made))
            if fault[i] not in ("blank", "duplicate"):
                extra = fault[i] == "truncated"
                for name, step, letter in ((role, 0, "K"), ("user", 2, "R"), ("assistant", 2, "R")):
                    if (to := follow(name)) is not None:
                        heapq.heappush(heap, (cost + step + extra, audit + letter, i + 1, to, (*made, (name, text))))


def brute(rows):
    rows = ordered(rows)
    fault = faults(rows)
    turns = [t for t, _, _ in rows if t is not None]
    first = [r[:1] for _, r, _ in rows]
    cost, audit, made = cheapest(rows)
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(fault.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:], strict=False)),
        cost,
        audit,
        hashlib.sha256("\n".join(f"{r}:{x}" for r, x in made).encode()).hexdigest(),
    )


def result(df, **options):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r.conv_id: tuple(r[n] for n in names) for r in R.repair(df, **options).collect()}


def by_conversation(rows):
    out = {}
    for c, t, r, x in rows:
        out.setdefault(c, []).append((t, r, x))
    return out


def some_rows(n, seed, longest=7):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant"]
    texts = ["Yes.", "No", "Why?", "", "  \t", None, "a\nb! ", "long text without an end", "é.", "…", "Yes.\x85"]
    rows = []
    for conv in range(n):
        for _ in range(rng.randint(1, longest)):
            turn = rng.choice([None, *range(8)])
            rows.append((conv, turn, rng.choice(roles), rng.choice(texts)))
    return rows


def test_random_conversations_against_a_search(spark):
    rows = some_rows(150, 1)
    want = {c: brute(r) for c, r in by_conversation(rows).items()}
    for parts in (1, 6):
        assert result(spark.createDataFrame(rows, SCHEMA).repartition(parts)) == want


def damage(rows):
    out = []
    for c, t, r, x in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        if kind:
            x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
            out += [(c, t, "user" if kind == 4 else r, x)] * (2 if kind == 3 else 1)
    return out


def test_damage_and_conversations_that_lose_every_row(spark):
    rows = some_rows(300, 2, longest=2) + [(None, 1, "user", "Hi."), (None, None, None, None)]
    left = by_conversation(damage(rows))
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    want = {c: brute(left[c]) if c in left else empty for c in by_conversation(rows)}
    assert len(left) < len(want)
    assert result(spark.createDataFrame(rows, SCHEMA), damage=True) == want


def test_runs_joined_equal_one_long_run():
    rng = random.Random(3)
    steps = [(rng.choice("suax"), rng.choice("bdt---"), rng.choice([0, 0, 0, 2])) for _ in range(90)]
    whole = R.solve(steps, R.ENDS)[R.START]
    for size in (1, 7, 40):
        stretch = R.Stretch()
        for i in range(0, len(steps), size):
            stretch.add(R.matrix(steps[i : i + size]))
        assert R.finished(stretch.result()) == whole


@pytest.mark.parametrize("run", [3, 256])
def test_one_conversation_holds_most_rows_and_is_cut(spark, monkeypatch, run):
    rng = random.Random(4)
    rows = [(7, t, rng.choice(["user", "assistant", "tool"]), rng.choice(["Yes.", f"No {t}", f"Why {t}?", " "])) for t in range(3000)]
    rows += [(c, 0, "user", "Hi.") for c in range(20)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        monkeypatch.setattr(R, "RUN", run)
        parts = R._stretches(R._units(R.plain_rows(spark.createDataFrame(rows, SCHEMA)))).where("conv_id = 7 AND n > 0").count()
        got = result(spark.createDataFrame(rows, SCHEMA).repartition(9))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert parts > 1
    mine = ordered(by_conversation(rows)[7])
    code = {"blank": "b", "duplicate": "d", "truncated": "t", "": "-"}
    steps = [(r[:1], code[f], 0) for (_, r, _), f in zip(mine, faults(mine), strict=True)]
    cost, letters = R.solve(steps, R.ENDS)[R.START]
    assert got[7][5:7] == (cost, letters.decode())
    assert got[7][1:4] == tuple(faults(mine).count(f) for f in ("blank", "duplicate", "truncated"))
    assert {got[c] for c in range(20) if c != 7} == {brute([(0, "user", "Hi.")])}


def test_many_equal_rows_are_one_step(spark):
    rows = [(1, None, "user", "Same.")] * 5000 + [(1, 3, "assistant", "Sure.")]
    got = result(spark.createDataFrame(rows, SCHEMA).repartition(8))[1]
    made = hashlib.sha256(b"user:Same.\nassistant:Sure.").hexdigest()
    assert got == (0, 0, 4999, 0, 4999, 3 * 4999, "K" + "D" * 4999 + "K", made)


def test_repaired_turns_long_text_clashing_columns_and_no_rows(spark):
    long = "word " * 300_000 + "end."
    df = spark.createDataFrame(
        [(1, 0, "assistant", long, 5, "x"), (1, 1, "user", "Stop", 6, "y"), (2, 0, "system", "Be kind.", 7, "z")],
        SCHEMA + ", copies int, audit string",
    )
    got = sorted(tuple(r) for r in R.repaired(R.plain_rows(df)).collect())
    assert got == [
        (1, 0, "insert", "user", ""),
        (1, 1, "keep", "assistant", long),
    ]
    assert {c: r[6] for c, r in result(df).items()} == {1: "IKD", 2: "D"}
    assert result(df.limit(0)) == {} and result(df.limit(0), damage=True) == {}
    assert R.repaired(R.plain_rows(df.limit(0))).count() == 0
