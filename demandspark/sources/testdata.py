"""Dispensing-shaped views over the star-schema test tables."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.functions.stage import null_safe, stage

#: Suppliers (a key and a nation, some 60 bytes each) that may be broadcast.
BROADCAST_ROWS = 1_000_000
#: One in so many orders settles beforehand which pairs and years there are outside a span.
SLICE = 256
# Public holidays of the fixture: month, day, name (fixed values).
HOLIDAYS = (
    (1, 1, "元日"),
    (2, 11, "建国記念の日"),
    (4, 29, "昭和の日"),
    (5, 3, "憲法記念日"),
    (5, 5, "こどもの日"),
    (11, 3, "文化の日"),
    (11, 23, "勤労感謝の日"),
)


def _brand_item() -> Column:
    n = F.lpad(F.substring("p_brand", 7, 2), 4, "0")
    return F.concat(n, F.lit("001F"), n)


def _type_item() -> Column:
    return F.rpad("p_type", 12, "0")


def _attributes(yj: Column, n: Column, size: Column) -> list[Column]:
    def mod(k: int) -> Column:
        return (n % k).cast("string")

    return [
        F.concat(F.lit("ID"), yj).alias("yj_id"),
        yj.alias("yj_code"),
        F.date_add(F.lit("1995-01-01").cast("date"), size.cast("int")).alias("application_start_date"),
        F.concat(F.lit("Z"), mod(4)).alias("yakushu_zaigata_kubun_id"),
        F.concat(F.lit("G"), mod(5)).alias("general_name"),
        F.concat(F.lit("K"), mod(3)).alias("kikaku"),
        mod(2).alias("generic_kubun_id"),
        F.when(n % 2 == 0, "TAB").otherwise("ML").alias("tanni_name"),
        (n % 4).cast("double").alias("tanni_suryo"),
        F.lit("0").alias("direct_sales_input_kubun_id"),
        F.concat(F.lit("T"), mod(2)).alias("tokutei_hoken_kubun_id"),
        F.lit("1").alias("keiryo_kongo_kanou_kubun_id"),
        F.lit("0").alias("kekkaku_yobou_flag"),
        mod(2).alias("high_risk_drug_flag"),
        F.concat(F.lit("P"), mod(3)).alias("dokuyakau_gekiyaku_kubun_id"),
        F.lit("0").alias("kisei_drug_kubun_id"),
    ]


@dataclass(frozen=True)
class TestData:
    """The fixture tables of one scale-factor directory."""

    __test__ = False
    spark: SparkSession
    sf_dir: str
    #: Written tables by span.
    _spans: dict = field(default_factory=dict, compare=False, repr=False)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def _suppliers(self) -> DataFrame:
        suppliers = self.table("supplier").select("s_suppkey", "s_nationkey")
        return F.broadcast(suppliers) if suppliers.count() <= BROADCAST_ROWS else suppliers

    @cached_property
    def _lines(self) -> DataFrame:
        """What facts take from their lines, derived before the joins: a day and a whole amount
        take fewer bytes of a shuffle than what they come from."""
        return self.table("lineitem").select(
            "l_orderkey",
            "l_partkey",
            "l_suppkey",
            F.col("l_shipdate").cast("date").alias("dispensing_date"),
            (7 * (F.col("l_linenumber").cast("long") - 1)).alias("hi_kaisu"),
            F.col("l_quantity").alias("total_dose"),
            F.round("l_extendedprice", 0).alias("drug_price"),
        )

    def _facts(self, item: Column, location: Column, subject: Column, lines: DataFrame | None = None, orders: DataFrame | None = None) -> DataFrame:
        lines, orders = lines or self._lines, orders or self.table("orders")
        return (
            lines.join(self._suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
            .select(
                item.alias("yj_code"),
                location.cast("string").alias("store_code"),
                "dispensing_date",
                F.concat(F.lit("P"), F.lpad(subject.cast("string"), 9, "0")).alias("patient_no"),
                "hi_kaisu",
                "total_dose",
                "drug_price",
                F.concat(F.lit("D"), F.lpad((F.col("o_custkey") % 20).cast("string"), 2, "0")).alias("doctor_code"),
            )
        )

    @cached_property
    def rx(self) -> DataFrame:
        return self._facts(_brand_item(), F.col("s_nationkey"), F.col("o_custkey"))

    @cached_property
    def facts(self) -> DataFrame:
        """``rx`` as a written table: the sources meet once for all that a flow takes from the facts."""
        return stage(self.rx, "facts")

    def between(self, start: date, end: date) -> DataFrame:
        """``rx`` of the days from ``start`` to ``end`` as a written table: other facts do not meet the sources."""
        key = "facts", start, end
        if key not in self._spans:
            self._spans[key] = stage(self.rx.where(F.col("dispensing_date").between(F.lit(start), F.lit(end))), "facts")
        return self._spans[key]

    def stock(self, start: date, end: date) -> DataFrame:
        """Days of each pair of item and location of all facts, which have every pair and the first and last year.

        Facts of the span and those of a slice of the other orders have most of them.  Of all other
        lines part, location and year are looked at, and those with a pair or a year yet unknown
        meet the sources too.
        """
        key = "stock", start, end
        if key not in self._spans:
            self._spans[key] = self._stock(start, end)
        return self._spans[key]

    def _stock(self, start: date, end: date) -> DataFrame:
        day, pair = F.col("dispensing_date"), ["yj_code", "store_code"]

        def days(facts: DataFrame) -> DataFrame:
            ends = facts.groupBy(*pair).agg(F.min(day).alias("first"), F.max(day).alias("last"))
            return ends.select(*pair, F.explode(F.array("first", "last")).alias("dispensing_date"))

        def sliced(df: DataFrame, order: str) -> DataFrame:
            return df.where(F.pmod(F.xxhash64(F.col(order).cast("long")), F.lit(SLICE)) == 0)

        sources = _brand_item(), F.col("s_nationkey"), F.col("o_custkey")
        others = self._lines.where(~F.coalesce(day.between(F.lit(start), F.lit(end)), F.lit(False)))
        some = self._facts(*sources, sliced(others, "l_orderkey"), sliced(self.table("orders"), "o_orderkey"))
        known = stage(days(self.between(start, end)).unionByName(days(some)), "stock")
        first, last = known.agg(F.year(F.min(day)), F.year(F.max(day))).first()
        placed = others.join(self._suppliers, F.col("l_suppkey") == F.col("s_suppkey")).withColumn("__year", F.year(day))
        kinds = ["l_partkey", "s_nationkey", "__year"]
        named = (
            placed.select(*kinds)
            .join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
            .select(*kinds, _brand_item().alias("yj_code"), F.col("s_nationkey").cast("string").alias("store_code"))
        )
        marked = null_safe(named, known.select(*pair).distinct().withColumn("__known", F.lit(True)), pair)
        new_year = F.lit(first is None) | (F.col("__year") < F.lit(first)) | (F.col("__year") > F.lit(last))
        left = stage(marked.where(F.col("__known").isNull() | (F.col("__year").isNotNull() & new_year)).select(*kinds).distinct(), "stock-left")
        if left.isEmpty():
            return known
        lines = null_safe(placed, left, kinds, "left_semi").select(*others.columns)
        return stage(known.unionByName(days(self._facts(*sources, lines))), "stock")

    @cached_property
    def rx_coarse(self) -> DataFrame:
        """Facts in which subjects come back often: few subjects and locations on purpose."""
        return self._facts(_type_item(), F.col("s_nationkey") % 5, F.col("o_custkey") % 50)

    @cached_property
    def drug(self) -> DataFrame:
        brands = self.table("part").groupBy("p_brand").agg(F.min("p_size").alias("size"))
        return brands.select(*_attributes(_brand_item(), F.substring("p_brand", 7, 2).cast("int"), F.col("size")))

    @cached_property
    def drug_coarse(self) -> DataFrame:
        kinds = self.table("part").groupBy(_type_item().alias("kind")).agg(
            F.min("p_size").alias("size"), F.min(F.length("p_type")).alias("n")
        )
        return kinds.select(*_attributes(F.col("kind"), F.col("n"), F.col("size")))

    @cached_property
    def units(self) -> DataFrame:
        key = F.col("n_nationkey")
        return self.table("nation").select(
            (key.cast("long") + 1000).alias("soshiki_unit_id"), key.cast("string").alias("soshiki_unit_code")
        )

    @cached_property
    def srq(self) -> DataFrame:
        """The assortment: every pair of item and location that has facts."""
        return self.stocked(self.rx)

    def stocked(self, rx: DataFrame) -> DataFrame:
        return rx.select(
            F.concat(F.lit("ID"), F.col("yj_code")).alias("yj_id"), (F.col("store_code").cast("long") + 1000).alias("soshiki_unit_id_store")
        ).distinct()

    @cached_property
    def pairs_coarse(self) -> DataFrame:
        """Assortment of the coarse facts: the pairs they contain."""
        return self.rx_coarse.select("yj_code", F.lpad("store_code", 6, "0").alias("store_code")).distinct()

    def holidays(self, first_year: int, last_year: int) -> DataFrame:
        rows = [(y, m, d, n) for y in range(first_year, last_year + 1) for m, d, n in HOLIDAYS]
        return self.spark.createDataFrame(rows, "y int, m int, d int, name string").select(
            F.make_date("y", "m", "d").alias("jst_date"), "name"
        )
