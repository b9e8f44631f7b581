"""What the plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from lendmart.operators import joins, ledger, panel
from lendmart.plans import adapters as A
from lendmart.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
NARROW = ["clean_numeric", "range_guard", "regex_conform", "sentinel_clean", "money_round",
          "consistency_flags", "list_count", "duration_months", "code_split"]
# these order a handful of rows: calendar months, candidates, a top-k
FEW_ROWS = {"automl_names", "model_for_month", "champion", "top_features"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


_PLANS = {}


def query_plan(spark, name) -> str:
    if name not in _PLANS:
        _PLANS[name] = plan_of(QUERIES[name](spark, SF))
    return _PLANS[name]


def details_of(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", list(ORACLES))
def test_no_python_and_no_cross_join(spark, name):
    plan = query_plan(spark, name)
    assert not re.search(r"EvalPython|MapInPandas|FlatMapGroups|MapInArrow", plan)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", NARROW)
def test_cleansing_needs_no_shuffle(spark, name):
    assert "Exchange" not in query_plan(spark, name)


@pytest.mark.parametrize("name", [n for n in ORACLES if n not in FEW_ROWS])
def test_single_task_exchanges_carry_partial_results_only(spark, name):
    """One task may merge one row per map task, or the k rows of a top-k."""
    lines = query_plan(spark, name).split("\n")
    for at, line in enumerate(lines):
        if "SinglePartition" in line:
            below = next(x for x in lines[at + 1:] if "Project" not in x)
            assert re.search(r"HashAggregate\(keys=\[\]|LocalLimit|TakeOrdered", below), below


def test_month_filter_reaches_the_scan(spark):
    plan = details_of(QUERIES["snapshot_extract"](spark, SF))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan).group(1)
    assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThan(o_orderdate" in pushed
    assert "o_orderpriority" not in re.search(r"ReadSchema: (.*)", plan).group(1)


def test_scan_reads_only_what_the_cohort_report_needs(spark):
    plan = details_of(QUERIES["default_rate_by_month"](spark, SF))
    schemas = " ".join(re.findall(r"ReadSchema: (\S+)", plan))
    for unused in ("l_partkey", "l_tax", "l_quantity", "o_totalprice"):
        assert unused not in schemas


def test_moving_average_shuffles_once(spark):
    rows = spark.read.parquet(f"{SF}/events.parquet").selectExpr(
        "user_id AS Customer_ID", "CAST(ts AS DATE) AS snapshot_date", "value AS fe_1")
    plan = plan_of(panel.ema_latest(rows, ["fe_1"]))
    assert plan.count("Exchange hashpartitioning") == 1


def test_grid_average_needs_no_sort(spark):
    rows = spark.read.parquet(f"{SF}/events.parquet").selectExpr(
        "user_id AS Customer_ID", "CAST(ts AS DATE) AS snapshot_date", "value AS fe_1")
    plan = plan_of(panel.ema_latest_on_grid(rows, ["fe_1"], "2024-01-30", start="2024-01-01",
                                            unit="DAY"))
    assert "Sort" not in plan and "Window" not in plan and "partial_sum" in plan


def test_latest_per_key_is_cut_down_before_the_shuffle(spark):
    rows = spark.range(100).selectExpr("id % 3 AS k", "id AS t")
    plan = plan_of(panel.latest_per_key(rows, "k", "t"))
    assert plan.count("WindowGroupLimit") == 2


def test_hot_customer_is_split_by_adaptive_execution(spark):
    """A third of the scored rows belong to one customer: the join's hot partition is
    read by several tasks, and no row is lost."""
    scored = spark.range(0, 300000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
        .alias("Customer_ID"), F.rand(1).alias("score"))
    known = spark.range(0, 300000, 1, 8).select(
        F.when(F.col("id") == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
        .alias("Customer_ID"), F.lit(1).alias("label"),
        F.lit("2024-01-01").cast("date").alias("snapshot_date"))
    options = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    }
    old = {k: spark.conf.get(k) for k in options}
    for k, v in options.items():
        spark.conf.set(k, v)
    try:
        joined = joins.matured(scored, known)
        # every scored customer is known: 200,000 of their own and 100,000 hot rows
        assert len(joined.collect()) == 300000
        assert "skew=true" in plan_of(joined) or "skewed" in plan_of(joined)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_label_reduction_combines_before_the_shuffle(spark):
    rows = spark.range(10).selectExpr("'c' AS Customer_ID", "1 AS label",
                                      "date'2024-01-01' AS snapshot_date")
    assert "partial_max" in plan_of(ledger.one_label_per_customer(rows))


def test_panel_combines_events_before_the_shuffle(spark):
    assert "partial_sum" in plan_of(A.panel(spark, SF))


def test_later_labels_do_not_hide_earlier_ones(spark):
    known = spark.sql("""SELECT * FROM VALUES ('a', 1, date'2024-01-01'), ('a', 0, date'2024-05-01'),
        ('b', 0, date'2024-05-01'), ('c', 0, date'2024-02-01'), ('c', 1, date'2024-02-01')
        AS t(Customer_ID, label, snapshot_date)""")
    scored = spark.sql("""SELECT * FROM VALUES ('a', date'2024-01-01'), ('a', date'2024-04-01'),
        ('b', date'2024-01-01'), ('c', date'2024-03-01') AS t(Customer_ID, inference_date)""")
    got = joins.matured(scored, known, as_of="2024-03-01").collect()
    assert sorted((r["Customer_ID"], r["label"], str(r["label_date"])) for r in got) == [
        ("a", 1, "2024-01-01"), ("c", 1, "2024-02-01")]
    assert len(joins.matured(scored, known).collect()) == 4


def test_two_production_models_are_an_error(spark):
    registry = spark.sql("""SELECT 'production' AS model_label, concat('v', id) AS model_version,
        date'2024-01-01' AS trained FROM range(2)""")
    batches = spark.sql("SELECT date'2024-03-01' AS inference_date")
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS|more than one row"):
        joins.models_for(registry, batches).collect()
