"""Operator 10: which buckets its steps read, and that no link is lost by reading fewer."""
from wattline.llm import bag_minhash
from wattline.llm.components import connected_components


def test_only_shared_buckets_are_read_again(spark):
    rows = [(10, 1), (10, 2), (11, 3), (12, 1), (12, 2), (13, 2), (13, 4), (13, 1)]
    shared = bag_minhash._shared(spark.createDataFrame(rows, "band long, node long"))
    assert sorted(map(tuple, shared.collect())) == [(10, 1, 1), (10, 2, 1), (12, 1, 1), (12, 2, 1), (13, 1, 1), (13, 2, 1), (13, 4, 1)]


def test_buckets_of_the_same_nodes_are_compared_once(spark, monkeypatch):
    """Buckets 10 and 12 hold the same nodes; 14 is cut into blocks, and all links between its components are found."""
    monkeypatch.setattr(bag_minhash, "BLOCK_SHINGLES", 40)
    members = {10: [1, 2], 12: [2, 1], 13: [1, 2, 3], 14: list(range(20, 32))}
    split = spark.createDataFrame([(b, n, n, len(ns)) for b, ns in members.items() for n in ns],
                                  "band long, node long, component long, size long")
    kept = bag_minhash._different(split)
    assert sorted({r["band"] for r in kept.collect()}) == [10, 13, 14]
    values = {n: list(range(10)) if n in (1, 2, 20, 31) else [100 * n + k for k in range(10)] for n in {x for ns in members.values() for x in ns}}
    sets = spark.createDataFrame([(n, v) for n, v in values.items()], "node long, elements array<long>")
    links = {tuple(sorted((r["a"], r["b"]))) for r in bag_minhash._block_links(split, sets, 0.8).collect()}
    assert links == {(1, 2), (20, 31)}


def test_components_of_few_edges_write_few_files(spark):
    """Many shuffle partitions don't become as many tasks and files of a few rows."""
    few = spark.sparkContext.defaultParallelism
    held = {"spark.sql.shuffle.partitions": str(5 * few), "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        edges = spark.createDataFrame([(2 * i, 2 * i + 1) for i in range(100)] + [(7, 7), (500, 500)], "a long, b long")
        found = connected_components(edges)
        assert len(found.inputFiles()) <= few
        assert {r["node"]: r["component"] for r in found.collect()} == {n: n - n % 2 for n in range(200)} | {500: 500}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_the_largest_component_is_not_compared_with_itself(spark, monkeypatch):
    """Blocks meet in tiles without a join, and every link between components is found."""
    monkeypatch.setattr(bag_minhash, "BLOCK_SHINGLES", 40)
    monkeypatch.setattr(bag_minhash, "TILE", 2)
    met, real = spark.sparkContext.accumulator(0), bag_minhash._overlaps

    def counted(left, right):
        met.add(1)
        return real(left, right)
    monkeypatch.setattr(bag_minhash, "_overlaps", counted)
    main, rest = list(range(1, 81)), list(range(100, 140))
    split = spark.createDataFrame([(5, n, 1 if n in main else n, 120) for n in main + rest], "band long, node long, component long, size long")
    values = {n: [1000 * n + k for k in range(10)] for n in main + rest}
    values |= {100: values[40], 120: values[7], 139: values[125]}
    sets = spark.createDataFrame(list(values.items()), "node long, elements array<long>")
    links = bag_minhash._block_links(split, sets, 0.8).collect()
    assert {tuple(sorted((r["a"], r["b"]))) for r in links} == {(40, 100), (7, 120), (125, 139)}
    assert {tuple(sorted((r["low"], r["high"]))) for r in links} == {(1, 100), (1, 120), (125, 139)}
    # 20 blocks of the component by 10 of the others, and these by each other once.
    assert 0 < met.value <= 20 * 10 + 10 * 11 // 2
