"""What a model and written tables leave on disk."""

import os
import random
import re

import numpy as np
from pyspark.sql.readwriter import DataFrameWriter
from recolens.llm import kneser_ney, setjoin, store



def test_dense_columns_take_a_byte(tmp_path):
    columns = np.random.default_rng(2).integers(0, 3, (5, 10000))
    columns[0, [0, 17, 9999]] = [255, 256, 2**40]
    columns[3, 5] = 254
    path = kneser_ney.write_dense(str(tmp_path), "d", columns)
    assert os.path.getsize(path.replace("file://", "")) < 6 * 10000
    dense, at = kneser_ney.Dense(path, 5), np.array([0, 3, 5, 17, 17, 9999])
    for k in range(5):
        assert dense.take(k, at).tolist() == columns[k, at].tolist()
        assert (dense.take(k, np.arange(10000)) == columns[k]).all()
    assert len(kneser_ney.Dense(kneser_ney.write_dense(str(tmp_path), "e", columns[:, :0]), 5).take(0, at[:0])) == 0


def folders(spark):
    root = spark.conf.get("spark.checkpoint.dir").replace("file://", "").replace("file:", "")
    return set(os.listdir(root))


def test_a_trained_model_leaves_no_packed_tables(spark):
    rows = [(i, " ".join(random.Random(i).choice("abcdef") for _ in range(20))) for i in range(30)]
    before = folders(spark)
    kneser_ney.train(spark.createDataFrame(rows, "doc_id long, text string"), order=3)
    left = {re.sub("-[0-9a-f]{32}$", "", f) for f in folders(spark) - before}
    assert "lm" in left and not left & {"lm-pairs", "lm-triples", "lm-pair-sums"}


def test_shuffles_end_with_the_write(spark, monkeypatch):
    seen, before = [], spark.conf.get(store.SHUFFLES_END, None)
    inner = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: (seen.append(spark.conf.get(store.SHUFFLES_END, None)), inner(self, *a, **k))[1])
    df = store.written(spark.range(100).groupBy("id").count(), "ends")
    assert seen == ["true"] and df.count() == 100 and spark.conf.get(store.SHUFFLES_END, None) == before


def test_a_set_join_drops_tables_with_their_use(spark):
    words = [random.Random(i % 7).choices("abcdef", k=30) for i in range(30)]
    rows = [(i, " ".join([*w, str(i % 3)])) for i, w in enumerate(words)]
    before = folders(spark)
    found = setjoin.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    left = {re.sub("-[0-9a-f]{32}$", "", f) for f in folders(spark) - before}
    assert "rows" in left and not left & {"sets", "groups", "counts", "prefix", "lists", "kept", "halves"}
    assert found.count() == 30
