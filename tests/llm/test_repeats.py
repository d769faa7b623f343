"""Rows that share an id: in the neighbour search, and among near duplicates."""

import numpy as np

from sievework.llm import ann, jaccard


def test_more_than_k_repeats_of_an_id_hide_no_neighbours(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(60, 4)).astype(np.float32)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    rows += [(7, [float(c) for c in x[0] * 3 + e]) for e in rng.normal(size=(100, 4)) * 0.01] + [rows[0]] * 30
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    for k, block in ((5, 4096), (20, 16), (59, 4096)):
        out = sorted(ann.search(df, df.where("vec_id = 0").limit(1), k, block_rows=block, ratio=10.0).collect(), key=lambda r: r["rank"])
        best = {}
        for i, v in rows:
            if i:
                best[i] = max(best.get(i, -np.inf), float(np.dot(np.float32(v).astype(float), x[0].astype(float))))
        want = sorted(best, key=lambda i: (-best[i], i))[:k]
        assert [r["vec_id"] for r in out] == want and want[0] == 7


def test_rows_that_share_an_id_are_judged_by_their_own_text(spark):
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(30))
    rows = [(5, text(k), k) for k in range(10)] + [(5, text(0), 99), (5, text(0), 0), (3, text(4) + " more", 1), (3, text(20), 2), (9, text(20).upper(), 3)]
    rows += [(None, text(30), 1), (None, text(30).upper(), 2), (None, text(31), 3), (None, "", 4), (5, None, 5), (5, None, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(3)
    kept = [(r["doc_id"], (r["text"] or "").lower()) for r in jaccard.keep_one(df, size=5, percent=80).collect()]
    want = [(5, text(k)) for k in range(10) if k != 4] + [(3, text(4) + " more"), (3, text(20)), (None, text(30)), (None, text(31)), (None, ""), (5, ""), (5, "")]
    order = lambda x: (x[0] or 0, x[1])
    assert sorted(kept, key=order) == sorted(want, key=order)


def test_large_rows_are_in_small_row_groups(spark):
    """A task that writes or reads rows of megabytes holds a few of them, not all."""
    import glob

    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    from sievework.llm.common import materialise

    rows = spark.range(0, 60, 1, 1).select(F.expr("array_join(transform(sequence(1, 20000), i -> sha2(concat(id, ' ', i), 512)), '')").alias("block"))
    df, path = materialise(rows, large_rows=True)
    (file,) = glob.glob(f"{path}/*.parquet")
    meta = pq.ParquetFile(file).metadata
    assert df.count() == 60
    assert max(meta.row_group(i).total_byte_size for i in range(meta.num_row_groups)) <= 40 << 20
