"""The roles a customer-offer pipeline needs, derived from the star schema.

profile   one row per customer
balances  per customer and product: how many orders (NULL if none) and their value
flows     per customer and event type: number of events and their volume
sales     customers of the regions the campaign reached: bought or not, and revenue, per product
train     sales with everything known about those customers
holdout   customers not reached, with flows and balances
scores    propensity and revenue estimate per product, from the orders

A product is an order status. Money columns hold two decimals, so they are summed in whole cents: exact,
the same whatever order the rows arrive in, and on primitive longs.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from propense.operators import silver

PRODUCTS = {"o": "O", "f": "F", "p": "P"}
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
CAMPAIGN_REGIONS = ("AFRICA", "AMERICA", "ASIA")
MIN_ORDERS_FOR_SALE = 4


def _hundredths(amount: str) -> Column:
    """A two-decimal column in whole hundredths."""
    return F.floor(F.col(amount) * 100.0 + 0.5)


def _total(units: Column, when: Column, per_unit: float = 100.0) -> Column:
    """Exact sum over the rows that qualify, back in the column's own unit."""
    return F.sum(F.when(when, units)) / per_unit


@dataclass(frozen=True)
class Roles:
    spark: SparkSession
    sf_dir: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir.rstrip('/')}/{name}.parquet")

    @cached_property
    def profile(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("client"),
            F.col("c_mktsegment").alias("segment"),
            F.col("c_acctbal").alias("acctbal"),
            F.col("c_nationkey").alias("nation"),
        )

    @cached_property
    def balances(self) -> DataFrame:
        price = _hundredths("o_totalprice")
        aggregates = []
        for p, status in PRODUCTS.items():
            is_product = F.col("o_orderstatus") == status
            aggregates += [
                F.nullif(F.count_if(is_product), F.lit(0)).alias(f"count_{p}"),
                _total(price, is_product).alias(f"bal_{p}"),
            ]
        return self.table("orders").groupBy(F.col("o_custkey").alias("client")).agg(*aggregates)

    @cached_property
    def flows(self) -> DataFrame:
        value = _hundredths("value")
        aggregates = []
        for e in EVENT_TYPES:
            is_type = F.col("event_type") == e
            aggregates += [
                F.coalesce(_total(value, is_type), F.lit(0.0)).alias(f"volume_{e}"),
                F.count_if(is_type).alias(f"txn_{e}"),
            ]
        return self.table("events").groupBy(F.col("user_id").alias("client")).agg(*aggregates)

    @cached_property
    def campaign_clients(self) -> DataFrame:
        reached = self.table("region").where(F.col("r_name").isin(*CAMPAIGN_REGIONS))
        nations = self.table("nation").join(reached, F.col("n_regionkey") == F.col("r_regionkey"))
        return (
            self.table("customer")
            .join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left_semi")
            .select(F.col("c_custkey").alias("client"))
        )

    @cached_property
    def sales(self) -> DataFrame:
        revenue = _hundredths("l_extendedprice") * _hundredths("l_discount")
        per_order = (
            self.table("lineitem")
            .groupBy(F.col("l_orderkey").alias("o_orderkey"))
            .agg(F.sum(revenue).alias("order_revenue"))
        )
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
        aggregates = []
        for p, status in PRODUCTS.items():
            is_product = F.col("o_orderstatus") == status
            aggregates += [
                F.count_if(is_product).alias(f"n_{p}"),
                _total(F.col("order_revenue"), is_product, 10000.0).alias(f"r_{p}"),
            ]
        per_client = (
            orders.join(per_order, "o_orderkey", "left")
            .groupBy(F.col("o_custkey").alias("client"))
            .agg(*aggregates)
        )
        columns = ["client"]
        for p in PRODUCTS:
            bought = F.coalesce(F.col(f"n_{p}") >= MIN_ORDERS_FOR_SALE, F.lit(False))
            columns += [
                bought.cast("int").alias(f"sale_{p}"),
                F.when(bought, F.coalesce(f"r_{p}", F.lit(0.0))).otherwise(0.0).alias(f"revenue_{p}"),
            ]
        return self.campaign_clients.join(per_client, "client", "left").select(*columns)

    @cached_property
    def train(self) -> DataFrame:
        return silver.train_table(self.sales, [self.flows, self.balances, self.profile], "client")

    @cached_property
    def holdout(self) -> DataFrame:
        # The keys of sales are the campaign's clients; asking for those alone spares its joins.
        return silver.holdout_table(
            self.profile, [self.balances, self.flows], self.campaign_clients, "client"
        )

    @cached_property
    def scores(self) -> DataFrame:
        """All estimates of a customer in one row: the product's share of the order value as the
        propensity, and the mean order value in thousands as the revenue."""
        total = sum((F.coalesce(F.col(f"bal_{p}"), F.lit(0.0)) for p in PRODUCTS), F.lit(0.0))
        columns = ["client"]
        for p in PRODUCTS:
            share = F.coalesce(F.try_divide(F.col(f"bal_{p}"), total), F.lit(0.0))
            mean = F.try_divide(F.col(f"bal_{p}"), F.col(f"count_{p}"))
            columns += [
                share.alias(f"{p}_predicted_probability"),
                (F.coalesce(mean, F.lit(0.0)) / 1000.0).alias(f"{p}_predicted_revenue"),
            ]
        return self.balances.select(*columns)

    def score_tables(self) -> dict[str, tuple[DataFrame, DataFrame]]:
        """The same estimates as scoring writes them: two tables per product."""
        return {
            p: (
                self.scores.select("client", F.col(f"{p}_predicted_probability").alias("predicted_probability")),
                self.scores.select("client", F.col(f"{p}_predicted_revenue").alias("predicted_revenue")),
            )
            for p in PRODUCTS
        }
