"""Values carried along ranges, and the parts of lines, against plain walks."""

import random

import pytest
from pyspark.sql import functions as F

from panelstats.operators import lines, ordered, structure


@pytest.mark.parametrize("parts", [1, 7])
def test_carried_equals_a_walk(spark, parts):
    rng = random.Random(parts)
    rows = [(rng.choice(["a", "b", None]) if i % 9 == 0 else "a", i, rng.choice([None, None, i]), rng.randint(0, 9)) for i in range(200)]
    rng.shuffle(rows)
    df = ordered.ranged(spark.createDataFrame(rows, "k string, n int, v int, x int"), ["k"], "n", parts)
    assert df.select("_part").distinct().count() == (1 if parts == 1 else 7)
    out = ordered.carried(df, ["k"], last={"l": F.col("v")}, previous={"p": F.col("v")}, total={"s": F.col("x")}, least_after={"m": F.col("x")})
    got = {r["n"]: (r["l"], r["p"], r["s"], r["m"]) for r in out.collect()}
    want = {}
    for k in ("a", "b", None):
        own, last, before, total = sorted(r for r in rows if r[0] == k) if k else sorted((r for r in rows if r[0] is None), key=lambda r: r[1]), None, None, 0
        own = sorted((r for r in rows if r[0] == k), key=lambda r: r[1])
        for at, (_, n, v, x) in enumerate(own):
            last, total = v if v is not None else last, total + x
            want[n] = (last, before, total, min(r[3] for r in own[at:]))
            before = v
    assert got == want


def test_rows_are_shuffled_once_and_whole_groups_not_summed_up(spark):
    """Only the group that lies in several parts is; a total beyond 32 bits is carried too."""
    rows = [(k, i, 2**30) for k, n in (("a", 3), (None, 90), ("b", 90), ("c", 3)) for i in range(n)]
    df = ordered.ranged(spark.createDataFrame(rows, "k string, n int, x int"), ["k"], "n", 4)
    parts = {}
    for r in df.select("k", "_part", "_wide").distinct().collect():
        parts.setdefault((r["k"], r["_wide"]), set()).add(r["_part"])
    assert len(parts) == 4 and all(wide == (len(p) > 1) for (_, wide), p in parts.items()) and parts["b", True] and parts[None, True]
    out = ordered.carried(df, ["k"], total={"s": F.col("x")}, previous={"p": F.col("n")})
    assert {(r["k"], r["n"]): (r["s"], r["p"]) for r in out.collect()} == {(k, i): ((i + 1) * 2**30, i - 1 if i else None) for k, i, _ in rows}
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()


def walk(rows):
    out, known, part = [], {}, {}
    for doc, n, name, values in rows:
        own = known.setdefault(doc, {})
        if name and name in own:
            if own[name] == values:
                continue
            part[doc] = part.get(doc, 0) + 1
            own.clear()
        own.setdefault(name, values)
        out.append((doc, n, part.get(doc, 0), name, values))
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_parts_equal_the_walk_on_random_rows(spark, seed):
    rng = random.Random(seed)
    names = ["", *"abcdefghijkl"[: rng.choice([2, 5, 12])]]
    rows = [(rng.choice("xxxy"), i, rng.choice(names), [None if rng.random() < 0.2 else float(rng.randint(0, 1)) for _ in range(rng.randint(1, 2))]) for i in range(rng.choice([12, 150]))]
    df = ordered.ranged(spark.createDataFrame(rows, "doc string, n int, label string, values array<double>"), ["doc"], "n", 5)
    out = lines.parts(df, ["doc"])
    assert sorted((r["doc"], r["n"], r["part"], r["label"], r["values"]) for r in out.collect()) == walk(sorted(rows, key=lambda r: r[1]))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Pandas" not in plan and "Python" not in plan


def test_long_chains_are_followed(spark):
    df = ordered.ranged(spark.createDataFrame([("d", i, "same", [float(i)]) for i in range(300)], "doc string, n int, label string, values array<double>"), ["doc"], "n", 6)
    assert sorted((r["n"], r["part"]) for r in lines.parts(df, ["doc"]).collect()) == [(i, i) for i in range(300)]


def test_titles_carry_over_the_ranges_of_one_document(spark):
    rng = random.Random(5)
    say = {"t": lambda i: f"7-{i % 3}- title {i % 3}" + (" (دنباله)" if i % 2 else ""), "p": lambda i: f"note {i}", "x": lambda i: None}
    kinds = [rng.choice("tppxxx") for _ in range(150)]
    rows = [("d", i, "table" if k == "x" else "para", say[k](i)) for i, k in enumerate(kinds)] + [("e", 0, "table", None)]
    got = {(r["doc"], r["block_no"]): (r["title"], r["group"], r["part"]) for r in structure.attach_titles(spark.createDataFrame(rows, "doc string, block_no int, kind string, text string")).collect()}
    title, base, group, part = None, "", 0, 0
    for i, k in enumerate(kinds):
        if k == "t":
            title, fresh = rows[i][3], str(i % 3)
            if fresh != base:
                base, group, part = fresh, group + 1, 0
        assert got["d", i] == (title, group, part if k == "x" else None), i
        part += k == "x"
    assert got["e", 0] == (None, 0, 0)
