import random

from lexweave.llm import graph


def brute_roots(edges):
    root = {}
    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = (root.setdefault(v, v) for v in (a, b))
            root.update({v: min(x, y) for v, r in root.items() if r in (x, y)})
    return root


def made(seed):
    rnd = random.Random(seed)
    chain = [(i, i + 1) for i in range(-40, 60)]
    hub = [(1000, i) for i in range(1001, 1100)]
    pairs = [(rnd.randrange(2000, 2400), rnd.randrange(2000, 2400)) for _ in range(180)]
    edges = [(a, b) if rnd.random() < 0.5 else (b, a) for a, b in chain + hub + pairs]
    edges += edges[::3] + [(5, None), (None, 7), (None, None), (3000, 3000), (-(1 << 63), (1 << 63) - 1)]
    rnd.shuffle(edges)
    return edges


def test_both_ways_agree_with_brute_force(spark, monkeypatch):
    edges = made(3)
    df = spark.createDataFrame(edges, "a long, b long").repartition(5)
    for limit in (0, 60, 1_000_000):
        monkeypatch.setattr(graph, "ONE_TASK", limit)
        rows = graph.connected_components(df, spark).collect()
        got = {r.node: r.root for r in rows}
        assert len(got) == len(rows)
        assert got == brute_roots(edges)
    assert graph.connected_components(df.where("a = b"), spark).collect() == []


def test_few_edges_leave_few_files(spark):
    # every shuffle leaves files of its own for each task that writes: 211 partitions of a few edges filled the disk
    df = spark.createDataFrame(made(4), "a long, b long")
    sc = spark.sparkContext
    sc.setJobGroup("few-edges", "")
    try:
        graph.connected_components(df, spark).collect()
        tracker = sc.statusTracker()
        stages = {s for j in tracker.getJobIdsForGroup("few-edges") for s in tracker.getJobInfo(j).stageIds}
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(stages) <= 8


def test_edges_made_in_the_same_worker(spark):
    edges = [e for e in made(4) if None not in e]
    df = spark.createDataFrame([(0, b, a) for a, b in edges], "x long, b long, a long").repartition(3)
    swapped = lambda batches: (x.select([2, 1]) for x in batches)
    got = {r.node: r.root for r in graph.connected_components(df, spark, swapped).collect()}
    assert got == brute_roots(edges)
    assert graph.connected_components(df.where("a = b"), spark, swapped).collect() == []
