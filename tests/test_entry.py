"""The driver contract and independence from partitioning."""

import ast
import pathlib

from pyspark.sql import functions as F

import __spark_entry__ as entry
from rosterline.operators.evaluate import auroc
from rosterline.operators.split import season_key, with_hash_part, with_stratified_fold
from rosterline.sources import frames

ROOT = pathlib.Path(__file__).resolve().parent.parent


def test_contract(spark):
    assert entry.entry(spark).columns == ["player_id", "year", "team", "team_performance_tier"]
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_repartitioning_changes_nothing(spark, sf_dir):
    panel = frames.panel(spark, sf_dir).cache()
    shuffled = panel.repartition(13, "pts")
    key = season_key()
    for make in (
        lambda df: with_hash_part(df, key).select("player_id", "year", "part"),
        lambda df: with_stratified_fold(df, "drafted", key, ["player_id", "year"]).select("player_id", "year", "fold"),
        lambda df: auroc(df, "pts", "drafted"),
    ):
        assert sorted(map(str, make(panel).collect())) == sorted(map(str, make(shuffled).collect()))


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    spark.catalog.clearCache()
    plan = frames.panel(spark, sf_dir).select("player_id", "gp")._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and "c_mktsegment" not in plan


def test_no_machine_local_lineage_cut():
    for path in (ROOT / "rosterline").rglob("*.py"):
        tree = ast.parse(path.read_text())
        names = {n.attr for n in ast.walk(tree) if isinstance(n, ast.Attribute)}
        assert not names & {"localCheckpoint", "crossJoin", "randomSplit"}, path


def test_panel_key_is_unique(spark, sf_dir):
    panel = frames.panel(spark, sf_dir)
    assert panel.groupBy("player_id", "year").count().filter(F.col("count") > 1).count() == 0
