"""The driver tables read as a behaviour log with profiles, pairs and scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybuy import schemas
from tallybuy.functions.columns import PromoCalendar
from tallybuy.session import write_out

CALENDAR = PromoCalendar(promo_from=1101, promo_to=1130, pre_after=1001, pre_before=1101)
CUTOFF = "2000-01-01"

# Part type → category id; score set → multipliers of (user, seller).
CATEGORY_IDS = {"ECONOMY": 1, "LARGE": 2, "MEDIUM": 3, "PROMO": 4, "SMALL": 5, "STANDARD": 6}
SCORE_FACTORS = {1: (31, 17), 2: (13, 101), 3: (7, 59)}

LOG_COLUMNS = [
    "user_id", "item_id", "cat_id", "seller_id", "brand_id", "time_stamp", "action_type",
]


class Fixtures:
    """Lazy frames over one directory of driver tables."""

    def __init__(self, spark: SparkSession, directory: str) -> None:
        self.spark = spark
        self.directory = directory
        self._tables: dict[str, DataFrame] = {}
        self._log: DataFrame | None = None
        self._log_all: DataFrame | None = None
        self._pairs: DataFrame | None = None

    def table(self, name: str) -> DataFrame:
        """A driver table; opened once, as opening lists files and reads footers."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.directory}/{name}.parquet")
        return self._tables[name]

    def stored(self) -> Fixtures:
        """The same inputs over a written-out copy of all actions, and pairs made from that copy.

        For plans that start from them many times: the three-way join behind
        the log is done once.
        """
        copy = Fixtures(self.spark, self.directory)
        copy._log_all = write_out(self.log_all(), "log-all")
        copy._pairs = write_out(copy.pairs(), "pairs")
        return copy

    def log_all(self) -> DataFrame:
        """Every action, past and future, with its date."""
        if self._log_all is not None:
            return self._log_all
        category = F.lit(None).cast("bigint")
        for name, number in CATEGORY_IDS.items():
            category = F.when(F.col("p_type") == name, F.lit(number).cast("bigint")).otherwise(category)
        joined = (
            self.table("lineitem")
            .join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
        )
        date = F.col("o_orderdate").cast("date")
        return joined.select(
            F.col("o_custkey").alias("user_id"),
            F.col("l_partkey").alias("item_id"),
            category.alias("cat_id"),
            F.col("l_suppkey").alias("seller_id"),
            F.substring("p_brand", 7, 10).cast("int").alias("brand_id"),
            (F.month(date) * 100 + F.day(date)).cast("int").alias("time_stamp"),
            ((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 4).cast("int").alias("action_type"),
            date.alias("event_date"),
        )

    def dated_log(self) -> DataFrame:
        return self.log_all().where(F.col("event_date") < F.lit(CUTOFF).cast("date"))

    def log(self) -> DataFrame:
        if self._log is None:
            self._log = self.dated_log().select(*LOG_COLUMNS)
        return self._log

    def log_raw(self) -> DataFrame:
        """The log with gaps in ``brand_id``, as a raw file would have them."""
        gap = F.col("item_id") % 97 == 0
        brand = F.when(~gap, F.col("brand_id")).alias("brand_id")
        return self.log().select(*[brand if c == "brand_id" else c for c in LOG_COLUMNS])

    def pairs(self) -> DataFrame:
        """Pairs with a promotion buy in the past; label = seen again later."""
        if self._pairs is not None:
            return self._pairs
        past = F.col("event_date") < F.lit(CUTOFF).cast("date")
        buy = CALENDAR.is_promo(F.col("time_stamp")) & (F.col("action_type") == schemas.BUY)
        # Other past actions say nothing about a pair, and are most of the rows.
        return (
            self.log_all()
            .where(past & buy | ~past)
            .groupBy("user_id", "seller_id")
            .agg(F.max(past & buy).alias("bought"), F.max((~past).cast("int")).alias("label"))
            .where("bought")
            .select("user_id", "seller_id", "label", self._is_test().alias("is_test"))
        )

    @staticmethod
    def _is_test() -> Column:
        return (F.col("user_id") * 7 + F.col("seller_id") * 13) % 4 == 0

    def labelled(self) -> DataFrame:
        return self.pairs().where(~F.col("is_test")).select("user_id", "seller_id", "label")

    def unlabelled(self) -> DataFrame:
        return self.pairs().where("is_test").select("user_id", "seller_id")

    def any_pairs(self) -> DataFrame:
        """Labelled and unlabelled pairs together: every pair with a past promotion buy.

        Needs no look into the future, so it reads less than :meth:`pairs`.
        """
        if self._pairs is not None:
            return self._pairs.select("user_id", "seller_id")
        buy = CALENDAR.is_promo(F.col("time_stamp")) & (F.col("action_type") == schemas.BUY)
        return self.log().where(buy).select("user_id", "seller_id").distinct()

    def user_info_raw(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.table("customer").select(
            key.alias("user_id"),
            F.when(key % 50 != 0, (F.col("c_nationkey") % 9).cast("int")).alias("age_range"),
            F.when(key % 3 != 2, (key % 3).cast("int")).alias("gender"),
        )

    def user_info(self) -> DataFrame:
        from tallybuy.sources.tables import clean_profile

        return clean_profile(self.user_info_raw())

    def format2(self) -> DataFrame:
        special = (F.col("user_id") + F.col("seller_id")) % 5 == 0
        return self.labelled().select(
            "user_id",
            F.col("seller_id").alias("merchant_id"),
            F.when(special, -1).otherwise(F.col("label")).cast("int").alias("label"),
        )

    def scores(self, k: int) -> DataFrame:
        a, b = SCORE_FACTORS[k]
        mixed = (F.col("user_id") * a + F.col("seller_id") * b) % 997 + 1
        return self.unlabelled().select(
            "user_id", "seller_id", (mixed.cast("double") / 999.0).alias("prob")
        )

    def score_sets(self) -> DataFrame:
        """All score sets below each other, from one read of the pairs."""
        sets = []
        for k, (a, b) in SCORE_FACTORS.items():
            mixed = (F.col("user_id") * a + F.col("seller_id") * b) % 997 + 1
            sets.append(
                F.struct(F.lit(k).alias("source"), (mixed.cast("double") / 999.0).alias("prob"))
            )
        return (
            self.unlabelled()
            .select("user_id", "seller_id", F.explode(F.array(*sets)).alias("s"))
            .select("s.source", "user_id", "seller_id", "s.prob")
        )

    def seller_vectors(self) -> DataFrame:
        return self.table("embeddings").select(
            F.col("vec_id").alias("seller_id"), F.col("embedding").alias("vector")
        )

    def vector_lines(self) -> DataFrame:
        values = F.transform("embedding", lambda v: v.cast("string"))
        return self.table("embeddings").select(
            F.concat(
                F.lit("s"), F.col("vec_id").cast("string"), F.lit(" "),
                F.array_join(values, " "), F.lit(" "),
            ).alias("value")
        )
