"""Retail star-schema views over the order/line-item tables.

``transactions`` joins only what the asked columns need: every line has its order, customer
and part, so leaving a join out never changes the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.operators.warehouse import time_dimension
from ledgerloom.session import dealt

FROM_ORDERS = {"customer_id", "order_date", "date_key", "delivery_days", "payment_method", "is_prime_member", "city", "state"}
FROM_PART = {"brand", "category"}
FROM_GEO = {"city", "state"}
# source columns that make a row's position unique, after the order date
TIE_BREAK = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
# orders per slice of a customer's day, used to split long histories
SLICE = 4096


# deterministic spread of nulls and dirty values over the lines
SPREAD = "(l_orderkey * 7 + l_partkey + l_linenumber)"
ORDER_DAY = "cast(o_orderdate as date)"

TRANSACTION_SQL = {
    "order_id": "cast(l_orderkey as string)",
    "customer_id": "cast(o_custkey as string)",
    "product_id": "cast(l_partkey as string)",
    "order_date": ORDER_DAY,
    "date_key": f"year({ORDER_DAY}) * 10000 + month({ORDER_DAY}) * 100 + day({ORDER_DAY})",
    "quantity": "l_quantity",
    "list_price": "l_extendedprice",
    "unit_price": "l_extendedprice / l_quantity",
    # 12 digits keep the product within 18, the widest decimal held as one long
    "revenue": "cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2)))",
    "discount_pct": "cast(round(l_discount * 100) as double)",
    "category": f"if({SPREAD} % 11 <> 0, p_type, null)",
    "brand": "p_brand",
    "payment_method": "o_orderpriority",
    "city": "n_name",
    "state": f"if({SPREAD} % 13 <> 0, r_name, null)",
    "is_prime_member": "if(o_custkey % 10 <> 7, o_custkey % 3 = 0, null)",
    "delivery_days": f"if({SPREAD} % 17 <> 0, pmod(datediff(cast(l_shipdate as date), {ORDER_DAY}), 46), null)",
    "customer_rating": f"if({SPREAD} % 5 <> 0, cast(10 + {SPREAD} % 41 as double) / 10, null)",
    "is_returned": "l_returnflag = 'R'",
    "tx_id": f"struct({', '.join(TIE_BREAK)})",
    "tx_slice": f"floor(l_orderkey / {SLICE})",
    "line_number": "l_linenumber",
    "spread_key": SPREAD,
}


ISO_DAY = "date_format(order_date, 'yyyy-MM-dd')"
PAID = "cast(list_price as string)"

RAW_SQL = {
    "order_id": "order_id",
    "line_number": "cast(line_number as string)",
    "customer_id": "customer_id",
    "product_id": "product_id",
    "quantity": "cast(cast(quantity as int) as string)",
    "order_date": f"""case spread_key % 6 when 1 then date_format(order_date, 'dd/MM/yyyy')
        when 2 then date_format(order_date, 'dd-MM-yy') when 3 then 'not-a-date' when 4 then null else {ISO_DAY} end""",
    "price": f"""case spread_key % 7 when 0 then concat('₹ ', {PAID}) when 1 then concat('(', {PAID}, ')') when 2 then 'N/A'
        when 3 then concat('Rs. ', {PAID}) when 4 then null
        when 5 then concat(cast(floor(list_price) as string), '00') else {PAID} end""",
    "rating": """case spread_key % 6 when 0 then '4 stars' when 1 then '3/5' when 2 then '4.5' when 3 then 'bad'
        when 5 then '9/10' end""",
    "city": """case spread_key % 7 when 0 then 'Bangalore' when 1 then 'bengaluru ' when 2 then 'Hydrabad'
        when 3 then 'New Delhi' when 4 then 'Nowhere' when 6 then 'MUMBAI' end""",
    "prime": "case spread_key % 6 when 0 then 'Yes' when 1 then 'n' when 2 then 'TRUE' when 3 then '0' when 4 then 'maybe' end",
    "delivery": """case spread_key % 7 when 0 then 'Same Day' when 1 then '2-4 days' when 2 then '5' when 3 then '90 days'
        when 4 then '-3' when 6 then 'Express' end""",
    "payment": """case spread_key % 8 when 0 then 'PhonePe' when 1 then 'C.O.D' when 2 then 'CREDIT_CARD' when 3 then 'debit card'
        when 4 then 'NetBanking' when 5 then 'Store wallet' when 7 then 'Bank Account' end""",
    "category": """case spread_key % 4 when 0 then ' Electronics & Accessories ' when 1 then 'ELECTRONIC'
        when 2 then 'Home   Decor' end""",
    "tx_id": "struct(order_date as order_day, tx_id)",
}


class Retail:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.days = None
        self.n_lines = None

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def transactions(self, *columns: str) -> DataFrame:
        asked = set(columns)
        fact = self.table("lineitem")
        if asked & FROM_ORDERS:
            # orders grow with the lines: joined by shuffles at every size, which also deals the lines out anew,
            # however few row groups their file has
            rows = self.lines()
            orders = dealt(self.table("orders"), rows, "o_orderkey").hint("merge")
            fact = dealt(fact, rows, "l_orderkey").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        if asked & FROM_GEO:
            places = self.table("nation").join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            people = self.table("customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
            fact = fact.join(people, F.col("o_custkey") == F.col("c_custkey"))
        if asked & FROM_PART:
            fact = fact.join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"), "left")
        return fact.selectExpr(*[f"{TRANSACTION_SQL[c]} as {c}" for c in columns])

    def products(self) -> DataFrame:
        return self.table("part").filter("p_partkey % 20 <> 0").selectExpr(
            "cast(p_partkey as string) as product_id",
            "p_name as product_name",
            "if(p_partkey % 8 <> 0, p_brand, null) as brand",
            "if(p_partkey % 9 <> 0, p_type, null) as category",
            "cast(1995 + p_partkey % 7 as int) as launch_year",
            "cast(p_retailprice as decimal(18,2)) as base_price_2015",
        )

    def customers(self) -> DataFrame:
        places = self.table("nation").join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        people = self.table("customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        return people.selectExpr(
            "cast(c_custkey as string) as customer_id",
            "c_name as customer_name",
            "try_element_at(array('18-25', '26-35', '36-45', '46-55', '56+'), cast(c_custkey % 6 as int) + 1) as age_group",
            "n_name as city",
            "r_name as state",
            "c_custkey % 4 = 0 as is_prime_member",
            "c_mktsegment as segment",
        )

    def span(self) -> tuple[str, str]:
        """The first and last order day: one row, found once."""
        if self.days is None:
            day = F.col("o_orderdate").cast("date").cast("string")
            self.days = tuple(self.table("orders").agg(F.min(day), F.max(day)).first())
        return self.days

    def lines(self) -> int:
        """Number of order lines, from the footers of their files."""
        if self.n_lines is None:
            self.n_lines = self.table("lineitem").count()
        return self.n_lines

    def calendar(self) -> DataFrame:
        """Every day from the first order to the last, so that no order line falls outside."""
        return time_dimension(self.spark, *self.span())

    def raw(self, *columns: str, sort: bool = False) -> DataFrame:
        """Dirty order lines: every column is text and follows from the row's spread key.

        ``sort`` puts them in the order of ``tx_id``, before the texts are made: those are wider than what they are made of.
        """
        needed = ["order_id", "customer_id", "product_id", "order_date", "quantity", "list_price",
                  "spread_key", "line_number", "tx_id"]
        base = self.transactions(*needed)
        if sort:
            at = [f"_at_{i}" for i in range(len(TIE_BREAK))]
            base = base.withColumns({a: F.col(f"tx_id.{c}") for a, c in zip(at, TIE_BREAK)}).orderBy("order_date", *at)
        return base.selectExpr(*[f"{RAW_SQL[c]} as {c}" for c in columns or RAW_SQL])
