"""What Python workers keep, and how many files scratch tables have."""
import numpy as np

from vigil.llm import common, components, langid, packing, simhash


def test_a_worker_keeps_the_tables_of_one_operator(monkeypatch):
    import public_tokenizers
    import pyarrow as pa

    monkeypatch.setattr(common, "_HELD", {})
    made = []
    assert common.held("a", lambda: made.append("a") or 1) == 1 and common.held("a", lambda: made.append("a") or 2) == 1
    assert made == ["a"]

    class Shared:
        value = {"en": langid.train(["some plain words"])}

    batch = [pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["plain words"])], names=["doc_id", "text"])]
    for run, key in ((langid._predict(Shared), "langid"), (packing._tokenise(public_tokenizers.path("byte_bpe_50k.json"), 1024, 2), "packing"),
                     (simhash._fingerprints(3, 42), "simhash")):
        assert sum(b.num_rows for b in run(iter(batch))) == 1
        assert [k if isinstance(k, str) else k[0] for k in common._HELD] == [key]


def test_narrow_tables_have_few_files_whatever_the_shuffle_partitions(spark):
    common.ship(spark)
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", 40)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        mark = common.made()
        rng = np.random.default_rng(1)
        links = [(int(x), int(y)) for x, y in zip(rng.integers(0, 200, 150), rng.integers(0, 200, 150))]
        got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
        root = list(range(200))
        for _ in root:
            for x, y in links:
                root[x] = root[y] = min(root[x], root[y])
        assert got == {x: root[x] for p in links if p[0] != p[1] for x in p}
        paths = [p for p in common._made()[mark:] if "/llm-cc-edges" not in p]
        assert paths and all(len(spark.read.parquet(p).inputFiles()) == 1 for p in paths)
        wide = common.staged(spark.range(100_000).repartition(40, "id"), "wide", 100_000)
        assert wide.count() == 100_000 and len(wide.inputFiles()) == 7
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
