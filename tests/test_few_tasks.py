"""Small tables take few tasks although shuffle partitions are many, and households are made once a query."""

from pyspark.sql import functions as F

from kinveil.operators import clk, positions
from kinveil.plans import linkage

SF = "/root/testdata/sf0.001"


def test_numbers_of_few_rows_take_few_ranges(spark, monkeypatch):
    """Numbers of 121,000 households took 200 tasks and files."""
    ranges, stage = [], positions.stage
    monkeypatch.setattr(positions, "stage", lambda df, *more: ranges.append(stage(df, *more)) or ranges[-1])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        got = positions.with_position(spark.range(5000).select((F.col("id") * 7 % 5003).alias("id")), ["id"]).collect()
        assert len(ranges[0].inputFiles()) <= 16
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [r.position for r in sorted(got)] == list(range(5000))


def test_links_read_households_once(spark):
    """The households, numbered by windows, were made twice and joined with themselves."""
    plan = linkage.QUERIES["household_link_resolve"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


def test_score_reads_households_once(spark):
    plan = linkage.QUERIES["hh_score"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


def test_filters_take_a_few_tasks_a_core(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        own = spark.createDataFrame([("LI", "1", "5 OAK ST", "1")], "family_name string, phone_number string, household_street_address string, household_zip string")
        out = clk.clks(own, {"clk": clk.SCHEMAS["fn-phone-addr-zip"]}, linkage.SECRET, "households")
        assert out.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism and out.count() == 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
