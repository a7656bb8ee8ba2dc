"""As-of joins and event generations against plain loops."""

import random

import pytest

from starfold.operators import imbh
from starfold.operators.asof import asof_join

LEFT = "k string, t double, a int, found string"
RIGHT = "k string, t double, v int"


def brute(left, right, direction, equal):
    out = []
    for k, t, a, f in left:
        best = None
        if k is not None and t is not None:
            past = [r for r in right if r[0] == k and r[1] is not None and (r[1] < t or (equal and r[1] == t))]
            future = [r for r in right if r[0] == k and r[1] is not None and (r[1] > t or (equal and r[1] == t))]
            p = max(past, key=lambda r: (r[1], r[2]), default=None)
            n = min(future, key=lambda r: (r[1], r[2]), default=None)
            if direction == "backward":
                best = p
            elif direction == "forward":
                best = n
            else:
                best = n if p is None or (n is not None and n[1] - t < t - p[1]) else p
        out.append((k, t, a, f, best))
    return sorted(map(str, out))


@pytest.mark.parametrize(
    ("direction", "equal"),
    [("backward", True), ("backward", False), ("forward", True), ("forward", False), ("nearest", True)],
)
def test_asof(spark, direction, equal):
    """A hot key, ties, nulls, keys of one side only, a column named like the result."""
    rng = random.Random(f"{direction}{equal}")
    keys = ["hot"] * 12 + ["a", "b", "c", None]
    time = lambda: None if rng.random() < 0.03 else float(rng.randint(0, 120))
    left = [(rng.choice([*keys, "left"]), time(), i, "x") for i in range(700)] + [("hot", 5.0, -1, "x")] * 40
    right = [(rng.choice([*keys, "right"]), time(), i) for i in range(300)]
    got = asof_join(
        spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), ["k"], "t",
        direction=direction, allow_equal=equal, tie=["v"],
    )
    assert got.columns == ["k", "t", "a", "found", "found_"]
    rows = [(r[0], r[1], r[2], r[3], None if r[4] is None else tuple(r[4])) for r in got.collect()]
    assert sorted(map(str, rows)) == brute(left, right, direction, equal)


def test_asof_of_nothing(spark):
    left, right = spark.createDataFrame([("a", 1.0, 1, "x")], LEFT), spark.createDataFrame([], RIGHT)
    assert asof_join(left, right, ["k"], "t").first()["found_"] is None
    assert asof_join(left.where("a = 0"), right, ["k"], "t").count() == 0
    with pytest.raises(ValueError):
        asof_join(left, right, ["k"], "t", direction="sideways")
    with pytest.raises(ValueError):
        asof_join(left, right, ["k"], "t", direction="nearest", allow_equal=False)


def folded(rows):
    gen = {}
    for _, p, a, b in sorted(rows, key=lambda r: r[0]):
        gen[p] = max(gen.get(p, 0), 1 + max(gen.get(a, 0), gen.get(b, 0)))
    return gen


def generations(spark, rows):
    schema = "simulation_id string, ttot double, seq bigint, product_name bigint, parent_name_1 bigint, parent_name_2 bigint"
    events = spark.createDataFrame([("s", 0.0, i, p, a, b) for i, p, a, b in rows], schema)
    return {r["product_name"]: r["generation"] for r in imbh.merger_generations(events, 10).collect()}


def test_generations_of_a_random_graph(spark):
    """All events at one time: names that come again, new products, parents that are unknown or null."""
    rng = random.Random(4)
    rows = []
    for i in range(1500):
        a, b = rng.randint(0, 200), rng.choice([None, rng.randint(0, 200), rng.randint(0, 5)])
        rows.append((i, rng.choice([a, a, b if b is not None else a, 300 + i % 40]), a, b))
    assert generations(spark, rows) == folded(rows)


def test_generations_of_long_chains(spark):
    """One name in every event, and a chain of new names, settle in few rounds."""
    rows = [(i, 1, 1, 1000 + i) for i in range(3000)] + [(5000 + i, 10_001 + i, 10_000 + i, 7) for i in range(3000)]
    assert generations(spark, rows) == folded(rows)


def test_longest_paths_with_cycles(spark):
    """Nodes on cycles of any kind, and those that depend on them, have no value."""
    from starfold.operators.paths import longest_paths

    rng = random.Random(6)
    links = [(i, j, 1) for i in range(1, 60) for j in rng.sample(range(i), min(i, rng.randint(0, 2)))]
    links += [(100, 101, 1), (101, 102, 1), (102, 100, 1), (103, 102, 1), (104, 103, 1), (104, 5, 1)]
    links += [(a, b, 1) for a in (110, 111, 112) for b in (110, 111, 112) if a != b] + [(120, 120, 1), (121, 7, 1)]
    ids = sorted({i for a, b, _ in links for i in (a, b)})
    value = {}
    while True:
        ready = [i for i in ids if i not in value and all(b in value for a, b, _ in links if a == i)]
        if not ready:
            break
        for i in ready:
            value[i] = max([0, *(w + value[b] for a, b, w in links if a == i)])
    nodes = spark.createDataFrame([(i, 0) for i in ids], "id long, base long")
    got = longest_paths(nodes, spark.createDataFrame(links, "id long, pred long, w long"), limit=len(ids))
    assert {r["id"]: r["value"] for r in got.collect()} == value
    assert 121 in value and 104 not in value


def test_settled_nodes_leave_the_state(spark, monkeypatch):
    """Beside a ladder that takes many rounds, nodes that are settled at once are written in the first state only."""
    import starfold.operators.paths as paths

    n, k = 12, 500
    ladder = [(i, i - d, 1) for i in range(n) for d in (1, 2) if i >= d]
    sizes, state = [], paths._state

    def counted(nodes, links, *rest):
        sizes.append(nodes.count())
        return state(nodes, links, *rest)

    monkeypatch.setattr(paths, "_state", counted)
    nodes = spark.range(n + k).selectExpr("id", "1 base")
    got = {r["id"]: r["value"] for r in paths.longest_paths(nodes, spark.createDataFrame(ladder, "id long, pred long, w long")).collect()}
    assert got == {i: i + 1 if i < n else 1 for i in range(n + k)}
    assert len(sizes) > 2 and max(sizes[1:]) <= n
