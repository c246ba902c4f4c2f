"""The star-schema test tables seen as reviews, products, users, vectors and event logs.

See FIXTURES.md, part 2. Everything is derived by Spark from the tables in ``folder``.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from recolens.functions import scalars as S
from recolens.operators import bronze, gold, silver
from recolens.operators.skew import ensure_checkpoint_dir

#: Rows that make a product or user of the tables warm, where cold ones are wanted: about the median
#: count, so that both kinds occur on the whole tables.
SUPPORT = 32

#: Rows a file of a stream holds, about; a trigger takes as many files as its rows need.
STREAM_ROWS = 1_000_000


def _id(prefix: str, col: str) -> Column:
    return F.concat(F.lit(prefix), F.col(col).cast("string"))


class Lake:
    def __init__(self, spark: SparkSession, folder: str):
        # Dates in the tables carry no zone; both engines must read them in the same one.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def stream(self, name: str, files: int = 6) -> DataFrame:
        """The same table as a stream: its rows shuffled over several files, an equal share per trigger."""
        rows, path = self.table(name), self.scratch(f"{name}-log")
        each = max(1, -(-rows.count() // (files * STREAM_ROWS)))
        rows.repartition(files * each, F.xxhash64(*rows.columns)).write.parquet(path)
        return self.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", each).parquet(path)

    def arrivals(self, rows: DataFrame, batch: Column, batches: int = 6) -> DataFrame:
        """``rows`` as a stream that brings batch 0, 1, ... one after another, as many files each.

        The file source takes files by their time, so the batches are written in this order, from one table
        of all of them.
        """
        path, kept = self.scratch("arrivals"), self.scratch("batches")
        rows.withColumn("__batch", batch).write.parquet(kept)
        dealt = self.spark.read.parquet(kept)
        largest = dealt.groupBy("__batch").count().where(F.col("__batch").between(0, batches - 1)).agg(F.max("count")).first()[0]
        files = max(1, -(-(largest or 0) // STREAM_ROWS))
        empty = self.spark.createDataFrame([], rows.schema)
        for i in range(batches):
            part = dealt.where(F.col("__batch") == i).drop("__batch")
            part.repartition(files).write.mode("append").parquet(path)
            # A part without rows leaves no file; a file without rows keeps the batches apart.
            for _ in range((i + 1) * files - self._files(path)):
                empty.write.mode("append").parquet(path)
        return self.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(path)

    def _files(self, path: str) -> int:
        """Parquet files in a folder."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return sum(s.getPath().getName().endswith(".parquet") for s in files.listStatus(folder))

    def scratch(self, name: str) -> str:
        """A new folder for a written table, in the folder all executors share."""
        ensure_checkpoint_dir(self.spark)
        # The context's own folder inside the shared one; it goes when the session ends.
        return f"{self.spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}/{name}"

    # --- reviews and catalogue -----------------------------------------------------------

    def reviews(self, stream: bool = False) -> DataFrame:
        """Order lines as reviews; every fiftieth order is delivered twice."""
        lines = self.stream("lineitem") if stream else self.table("lineitem")
        part = self.table("part").select("p_partkey", F.col("p_type").alias("category"))
        orders = self.table("orders").select("o_orderkey", "o_custkey")
        order = F.col("l_orderkey")
        copies = F.when(order % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
            F.array(F.lit(0))
        )
        return (
            lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
            .join(part, lines["l_partkey"] == part["p_partkey"])
            .select(
                F.when(order % 101 != 0, _id("U", "o_custkey")).alias("user_id"),
                F.when(order % 103 != 0, _id("P", "l_partkey")).alias("asin"),
                (F.floor(F.col("l_quantity") / 7) - 1).cast("double").alias("rating"),
                F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("timestamp"),
                (F.col("l_returnflag") != "R").alias("verified_purchase"),
                F.floor(F.col("l_discount") * 100 + 0.5).alias("helpful_vote"),
                "category",
                F.explode(copies).alias("copy"),
            )
            .drop("copy")
        )

    def metadata(self) -> DataFrame:
        return self.table("part").select(
            _id("P", "p_partkey").alias("product_id"),
            F.col("p_type").alias("category"),
            F.col("p_name").alias("title"),
            F.array("p_brand").alias("description"),
            F.col("p_retailprice").alias("price"),
            F.col("p_brand").alias("store"),
        )

    def interactions(self) -> DataFrame:
        return bronze.bronze_interactions(self.reviews())

    def products(self) -> DataFrame:
        return bronze.bronze_products(self.metadata())

    def users(self) -> DataFrame:
        return bronze.user_profile(self.interactions())

    def silver(self) -> DataFrame:
        return silver.silver_interactions(self.interactions())

    def gold_products(self, min_interactions: int = S.MIN_INTERACTIONS) -> DataFrame:
        return gold.gold_products(self.silver(), self.products(), min_interactions)

    def customers(self) -> DataFrame:
        return self.table("customer").select(_id("U", "c_custkey").alias("user_id"))

    # --- vectors -------------------------------------------------------------------------

    def _vectors(self, table: str, key: Column, start: int) -> DataFrame:
        vectors = self.table("embeddings").select(
            "vec_id", F.slice("embedding", start, 16).cast("array<float>").alias("vec")
        )
        # Every vector is used; where there are more rows than vectors they repeat.
        known = self.table("embeddings").agg(F.count(F.lit(1))).scalar()
        rows = self.table(table).withColumn("vec_id", key % known)
        return rows.join(vectors, "vec_id").drop("vec_id")

    def product_vectors(self, start: int = 1) -> DataFrame:
        return self._vectors("part", F.col("p_partkey"), start).select(
            _id("P", "p_partkey").alias("product_id"),
            F.col("p_type").alias("category"),
            F.col("p_size").alias("size"),
            F.col("vec").alias("p"),
        )

    def user_vectors(self) -> DataFrame:
        return self._vectors("customer", F.col("c_custkey") * 7 + 3, 1).select(
            _id("U", "c_custkey").alias("user_id"), F.col("vec").alias("u")
        )

    def content_vectors(self) -> DataFrame:
        """The embeddings themselves as products: 64 dimensions, label as category."""
        return self.table("embeddings").select(
            F.col("vec_id").cast("string").alias("product_id"),
            F.col("label").cast("string").alias("category"),
            F.col("embedding").cast("array<float>").alias("p"),
        )

    @cached_property
    def supported(self) -> DataFrame:
        from recolens.operators.cold_start import min_support_filter

        return min_support_filter(self.interactions(), SUPPORT)

    def factor_items(self) -> DataFrame:
        """Vectors standing in for factors: only products the support filter keeps."""
        kept = self.supported.select("product_id").distinct()
        return self.product_vectors().join(kept, "product_id", "left_semi").select("product_id", "p")

    def factor_users(self) -> DataFrame:
        kept = self.supported.select("user_id").distinct()
        return self.user_vectors().join(kept, "user_id", "left_semi")

    def bridged_items(self) -> DataFrame:
        """Vectors standing in for predictions: products larger than size 5."""
        return self.product_vectors(17).filter("size > 5").select("product_id", "p")

    # --- event logs ----------------------------------------------------------------------

    def events(self, stream: bool = False) -> DataFrame:
        rows = self.stream("events") if stream else self.table("events")
        return rows.withColumn("k", F.get_json_object("props", "$.k").cast("long"))

    def impressions(self) -> DataFrame:
        views = self.events().filter("event_type = 'view'")
        user = _id("U", "user_id")
        return views.select(
            user.alias("user_id"),
            S.ab_variant(user).alias("ab_variant"),
            F.col("ts").cast("timestamp").alias("ts"),
        )

    def raw_feedback(self, stream: bool = False) -> DataFrame:
        """All non-view events as sent, the not allowed ones included."""
        user = _id("U", "user_id")
        assigned = S.ab_variant(user)
        flipped = F.when(assigned == S.CONTROL, S.TREATMENT).otherwise(S.CONTROL)
        return (
            self.events(stream)
            .filter("event_type <> 'view'")
            .select(
                "event_id",
                user.alias("user_id"),
                _id("P", "k").alias("product_id"),
                F.when(F.col("event_type") == "error", "skip")
                .otherwise(F.col("event_type"))
                .alias("interaction_type"),
                F.when(F.col("event_id") % 37 == 0, flipped).otherwise(assigned).alias("ab_variant"),
                F.col("ts").cast("timestamp").alias("ts"),
            )
        )

    def feedback(self) -> DataFrame:
        from recolens.operators.abtest import validate_feedback

        return validate_feedback(self.raw_feedback())[0]

    def requests(self, stream: bool = False) -> DataFrame:
        """Views as recommendation requests: latency from value, a hit when k is even."""
        return (
            self.events(stream)
            .filter("event_type = 'view'")
            .select(
                _id("U", "user_id").alias("user_id"),
                F.col("ts").cast("timestamp").alias("ts"),
                F.col("value").alias("latency_ms"),
                (F.col("k") % 2 == 0).alias("cache_hit"),
            )
        )

    def recommend_requests(self) -> DataFrame:
        """One request per customer; customers in debt are treated as unknown users.

        n, category and the exclusion flag vary with the customer's nation and segment.
        """
        nation = F.col("c_nationkey")
        kinds = F.array(*[F.lit(c) for c in ("ECONOMY", "SMALL", "STANDARD", "PROMO")])
        return self.table("customer").select(
            _id("R", "c_custkey").alias("request_id"),
            F.when(F.col("c_acctbal") < 0, _id("X", "c_custkey"))
            .otherwise(_id("U", "c_custkey"))
            .alias("user_id"),
            (nation + 1).cast("int").alias("n"),
            F.when(nation >= 12, F.element_at(kinds, (nation - 12) % 4 + 1)).alias("category"),
            (F.col("c_mktsegment") != "BUILDING").alias("exclude_seen"),
        )
