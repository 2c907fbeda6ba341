"""The entity-season panel and its dirty twin, built from the star-schema tables.

`player_id` is a customer, `year` an order year, `team` the nation, `conf` the region.
(player_id, year) is unique, so a player has at most one row per season.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import checkpointed
from .tables import table

TARGET_TOTAL = 900000
TEST_YEAR = 2001


# Amounts have four decimals and are summed as whole units, so a sum does not depend on the
# order of the rows. The units are summed in a high and a low part: two bigint sums stay in
# generated code and hold some 10**12 rows of one key without overflow.
UNITS = 10000
LOW_BITS = 20


def _unit_parts(c: Column, name: str) -> list[Column]:
    units = F.floor(c * UNITS + 0.5)
    return [F.sum(F.shiftright(units, LOW_BITS)).alias(f"{name}_hi"),
            F.sum(units.bitwiseAND(F.lit((1 << LOW_BITS) - 1))).alias(f"{name}_lo")]


def _units(name: str) -> Column:
    """The high part scales exactly by a power of two, so the sum is rounded once at most."""
    return F.col(f"{name}_hi").cast("double") * F.lit(float(1 << LOW_BITS)) + F.col(f"{name}_lo").cast("double")


def _amount(name: str) -> Column:
    return _units(name) / F.lit(float(UNITS))


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem, orders, customer, nation, region = (
        table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer", "nation", "region"))
    price = F.col("l_extendedprice")
    measures = {"mp": F.col("l_quantity"), "pts": price, "ast": price * F.col("l_discount"), "stl": price * F.col("l_tax")}
    per_order = lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"), *[p for name, c in measures.items() for p in _unit_parts(c, name)])
    # Aggregate to (customer, year) before touching customer: the join then carries a few
    # rows per customer however many orders one customer has.
    seasons = (
        orders.select("o_orderkey", "o_custkey", "o_totalprice", F.year("o_orderdate").alias("year"))
        .join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .groupBy("o_custkey", "year")
        .agg(
            F.count(F.lit(1)).alias("gp"), F.sum("n_lines").cast("double").alias("blk"),
            *[F.sum(f"{name}_{part}").alias(f"{name}_{part}") for name in measures for part in ("hi", "lo")],
            *_unit_parts(F.col("o_totalprice"), "total"),
        )
    )
    people = (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", F.col("n_name").alias("team"), F.col("r_name").alias("conf"),
                F.col("c_mktsegment").alias("type"))
    )
    return seasons.join(people, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_custkey").alias("player_id"), "year", "team", "conf", "type", "gp", "blk",
        *[_amount(name).alias(name) for name in measures],
        (_units("total") > float(TARGET_TOTAL * UNITS)).cast("int").alias("drafted"),
    )


def once(frame: DataFrame) -> DataFrame:
    """The frame written to the shared folder, for queries that fit on it and apply to it: the
    facts behind it are read once."""
    return checkpointed(frame)


def raw_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel with missing and malformed columns added, each a rule on the key."""
    p, s = F.col("player_id"), F.col("year")

    def when_int(cond: Column, value: Column) -> Column:
        return F.when(cond, value.cast("double"))

    yr_code = (p * 7 + s) % 10
    yr = (F.when(yr_code == 1, "0").when(yr_code.isin(2, 3), "Fr").when(yr_code.isin(4, 5), "So")
          .when(yr_code.isin(6, 7), "Jr").when(yr_code.isin(8, 9), "Sr"))
    text = lambda c: c.cast("string")
    ht_code = p % 12
    ht = (F.when(ht_code == 1, "-").when(ht_code == 2, "Jr").when(ht_code == 3, "76")
          .when(ht_code.isin(4, 5, 6), F.concat(text(5 + p % 3), F.lit("'"), text(p % 11)))
          .when(ht_code.isin(7, 8), F.concat(F.lit("Jun-0"), text(p % 10)))
          .when(ht_code == 9, "Jul-00")
          .when(ht_code.isin(10, 11),
                F.concat(text(1 + p % 11), F.when(p % 2 == 0, F.lit("-Jun")).otherwise(F.lit("-May")))))
    num = F.when(p % 9 == 1, "23B").when(p % 9 == 2, "--").when(p % 9 > 2, text(p % 50))
    made = when_int((p + s) % 3 != 0, (p + s) % 40)
    tried = (F.when((p + s) % 5 == 0, None).when((p + s) % 7 == 0, F.lit(0.0))
             .otherwise(((p + s) % 40 + p % 6).cast("double")))
    return (
        panel(spark, sf_dir)
        .withColumns({
            "yr": yr, "ht": ht, "num": num,
            "pick": when_int(F.col("drafted") == 1, 1 + p % 60),
            "Rec_Rank": when_int(p % 10 < 3, p % 100),
            "dunksmade": made, "dunksmiss_dunksmade": tried,
            "TO_per": F.when((p * 3 + s) % 8 == 0, F.lit(0.0)).otherwise(((p * 3 + s) % 25).cast("double")),
            "AST_per": ((p + s * 3) % 35).cast("double"),
        })
        .withColumn("dunks_ratio", F.when(
            (p % 2 == 0) & (F.col("dunksmiss_dunksmade") > 0),
            F.try_divide(F.col("dunksmade"), F.col("dunksmiss_dunksmade"))))
    )


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as array<double>, with a rare positive class."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("x"), "label",
        (F.col("label") == 0).cast("int").alias("drafted"),
    )


def doc_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return table(spark, sf_dir, "labels").join(docs, "doc_id")


def train_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("year") < TEST_YEAR)


def test_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("year") == TEST_YEAR)


def shot_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel with shooting, rebound and rating columns standing in under their usual
    names; attempts and turnovers are 0 for some rows."""
    p, s = F.col("player_id"), F.col("year")
    d = lambda c: c.cast("double")
    return (
        panel(spark, sf_dir).withColumnRenamed("gp", "GP")
        .withColumns({
            "TPA": d((p + s) % 5), "TPM": d(p % 2), "twoPA": d((p * 3 + s) % 7), "FTA": d(p % 9),
            "TO_per": F.when((p * 3 + s) % 8 == 0, F.lit(0.0)).otherwise(d((p * 3 + s) % 25)),
            "treb": d((p * 5 + s) % 12),
            "ORtg": F.try_divide(F.col("pts"), d(F.col("GP"))),
            "drtg": F.try_divide(F.col("ast"), d(F.col("GP"))),
        })
        .withColumns({"twoPM": F.least(F.col("twoPA"), d(p % 4)), "FTM": F.least(F.col("FTA"), d(s % 6))})
    )
