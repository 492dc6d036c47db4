"""Mixing of very many sources: no task or broadcast that holds all of them."""
from wattline.llm import mixing


def test_many_sources_are_numbered_by_partitions(spark, monkeypatch):
    plans, store = [], mixing.stored

    def kept(df, name, **settings):
        plans.append((name, df._jdf.queryExecution().analyzed().toString()))
        return store(df, name, **settings)
    monkeypatch.setattr(mixing, "stored", kept)
    names = [None if i == 7 else f"s{i * 7919 % 3001}" for i in range(3000)]
    docs = spark.createDataFrame([(i, "a b c d", s) for i, s in enumerate(names)], "doc_id long, text string, source string")
    rows = mixing.mix(docs.repartition(5), budget=0.5).collect()
    order = sorted(set(names), key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    # 4 words a source; half of all words by weight stays below every cap.
    want = {s: 0.5 * 4 * len(order) * w / sum(weight.values()) for s, w in weight.items()}
    assert len(rows) == 3000 and all(abs(r["target"] - want[r["source"]]) < 1e-6 for r in rows)
    assert not any("row_number" in plan for name, plan in plans if name in ("numbered", "sources"))
    assert not any("strategy=broadcast" in plan for _, plan in plans)


def test_places_over_several_partitions(spark):
    keys = [None] + [f"k{i}" for i in range(500)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = mixing.numbered(spark.createDataFrame([(k,) for k in keys], "source string").repartition(3), "source", "place")
        rows = found.collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = sorted(keys, key=lambda s: (s is None, s or ""))
    assert [r["source"] for r in sorted(rows, key=lambda r: r["place"])] == want
    assert sorted(r["place"] for r in rows) == list(range(len(keys)))
