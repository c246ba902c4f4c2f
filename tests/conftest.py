import os
import sys

import numpy as np
import pytest
from pyspark.sql import SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from helpers import SF  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("recolens-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def lake(spark):
    from recolens.sources.bind import Lake

    return Lake(spark, SF)


@pytest.fixture
def conf(spark):
    """Set session configuration for one test."""
    changed = {}

    def set_(name, value):
        changed.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, str(value))

    yield set_
    for name, value in changed.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture
def shop(spark):
    """A small stall with small whole-number vectors: twins that always tie, a product without any
    direction, one without a category, a user who has seen nothing and a category nobody sells."""
    kinds = dict.fromkeys(("c1", "c2", "c3", "c4"), "cups") | dict.fromkeys(("m1", "m2", "m3"), "mats") | {"x9": None}
    ids = sorted(kinds)
    p = np.array([[(3 * i + 5 * d + i * d) % 7 - 3 for d in range(16)] for i in range(len(ids))], np.float32)
    p[ids.index("m2")] = p[ids.index("m1")]
    p[ids.index("c4")] = 0
    names = {"ann": "power_user", "bob": "casual_user", "cyd": "regular_user"}
    u = np.array([[(2 * k + d) % 5 - 2 for d in range(16)] for k in range(len(names))], np.float32)
    late = {"c4", "x9"}

    class Shop:
        pass

    s = Shop()
    s.ids, s.p, s.u, s.kinds, s.late, s.names = ids, p, u, kinds, late, list(names)
    s.products = spark.createDataFrame(
        [(i, kinds[i], i in late, v.tolist()) for i, v in zip(ids, p)],
        "product_id string, category string, is_cold boolean, p array<float>",
    )
    s.users = spark.createDataFrame(
        [(n, names[n], v.tolist()) for n, v in zip(names, u)], "user_id string, segment string, u array<float>"
    )
    s.seen = spark.createDataFrame([("ann", "m1"), ("ann", "c2"), ("cyd", "x9")], "user_id string, product_id string")
    s.popular = spark.createDataFrame(
        [("m2", "mats", 1), ("c1", "cups", 2), ("m1", "mats", 3), ("c3", "cups", 4)],
        "product_id string, category string, rank int",
    )
    s.requests = lambda *rows: spark.createDataFrame(
        [(f"R{i}", *r) for i, r in enumerate(rows)],
        "request_id string, user_id string, n int, category string, exclude_seen boolean",
    )
    return s
