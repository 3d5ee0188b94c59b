"""Connected components: one job writes and counts the edges of a round."""

import random

from sensorcast.llm import components


def test_rounds_are_counted_while_written(spark, monkeypatch):
    """the edges of a round are not read again to see whether they have settled."""
    calls = []
    stored = components.stored

    def counted(df, name):
        table, path = stored(df, name)
        calls.append(name)
        table.agg = None  # reading the written table back to count it fails
        return table, path
    monkeypatch.setattr(components, "stored", counted)
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 30) if i % 10 != 9] + [(50, 50), (7, 5), (None, 3)], "a long, b long")
    found = {r.id: r.component for r in components.connected_components(links).collect()}
    assert found == {i: i // 10 * 10 for i in range(30)}
    assert 2 <= len(calls) <= 10


def test_no_links(spark):
    links = spark.createDataFrame([(1, 1), (None, 2)], "a long, b long")
    assert components.connected_components(links).collect() == []
    assert components.connected_components(links.limit(0)).collect() == []


def _by_union(links):
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in links:
        x, y = sorted((top(a), top(b)))
        root[y] = x
    return {x: top(x) for x in root}


def test_any_graph(spark):
    """Shuffled paths, a hub, a ring, a grid and random links, some of them repeated and turned round."""
    rng = random.Random(5)
    path = rng.sample(range(0, 200), 200)
    ring = rng.sample(range(1000, 1100), 100)
    links = list(zip(path, path[1:])) + [(2000, i) for i in rng.sample(range(1900, 2100), 150) if i != 2000]
    links += list(zip(ring, ring[1:] + ring[:1])) + [(rng.randrange(3000, 3400), rng.randrange(3400, 3800)) for _ in range(300)]
    links += [(4000 + 20 * x + y, 4000 + 20 * x + y + d) for x in range(19) for y in range(19) for d in (1, 20)]
    links = [link if rng.random() < 0.5 else link[::-1] for link in links + rng.sample(links, 200)]
    found = components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len(found) == len({r.id for r in found})
    assert {r.id: r.component for r in found} == _by_union(links)


def test_a_round_is_one_shuffle(spark, monkeypatch):
    """a round reads its edges once, deals them out once and joins nothing; every job of a round takes the driver's memory."""
    written = []
    stored = components.stored
    monkeypatch.setattr(components, "stored", lambda df, name: written.append(name) or stored(df, name))
    links, _ = stored(spark.createDataFrame([(i, i + 1) for i in range(30)], "a long, b long"), "test-links")
    sc = spark.sparkContext
    sc.setJobGroup("component-rounds", "")
    try:
        components.connected_components(links)
        jobs = sc.statusTracker().getJobIdsForGroup("component-rounds")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(written) >= 2 and len(jobs) <= 2 * len(written)
