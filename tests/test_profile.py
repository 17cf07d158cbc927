"""Deep-empty profiling."""

from medframe.operators import profile


def test_indicators_and_drop(spark):
    df = spark.sql("""
      select * from values
        (1, cast(null as string), '  ', char(9), array(), array(' '),
         named_struct('a', cast(null as string), 'b', named_struct('c', '')), 0.0),
        (2, cast(null as string), '', char(9), array(), array(),
         named_struct('a', cast(null as string), 'b', named_struct('c', ' ')), cast(null as double))
      as t(id, n, blank, tab, empty_arr, blank_arr, st, num)""")
    flags = [r.asDict() for r in profile.is_deep_empty(df).orderBy("id").collect()]
    assert flags[0] == {"id": 1, "n": 0, "blank": 0, "tab": 1, "empty_arr": 0, "blank_arr": 1, "st": 0, "num": 1}
    assert flags[1]["blank_arr"] == 0 and flags[1]["num"] == 0
    counts = profile.filled_counts(df).first().asDict()
    assert counts == {"id": 2, "n": 0, "blank": 0, "tab": 2, "empty_arr": 0, "blank_arr": 1, "st": 0, "num": 1}
    assert profile.drop_deep_empty(df).columns == ["id", "tab", "blank_arr", "num"]


def test_zero_rows_keep_all_columns(spark):
    df = spark.sql("select 1 as a, '' as b where false")
    assert profile.drop_deep_empty(df).columns == ["a", "b"]


def test_dotted_names(spark):
    df = spark.sql("select '' as `a.b`, 'x' as `c.d`")
    assert profile.drop_deep_empty(df).columns == ["c.d"]


def test_profile_is_one_aggregation(spark):
    df = spark.range(100).selectExpr("id", "cast(null as string) as s")
    plan = profile.filled_counts(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") >= 1 and "SortMergeJoin" not in plan


def test_materialised_drop_runs_its_input_once(spark):
    from pyspark.sql import functions as F

    runs = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(i):
        runs.add(1)
        return "x" if i == 7 else ""

    rows = spark.range(50).select(F.col("id"), seen("id").alias("one"), F.lit("  ").alias("blank"),
                                  F.array().cast("array<string>").alias("none"))
    out = profile.drop_deep_empty(rows, materialize=True)
    assert out.columns == ["id", "one"] and out.count() == 50 and out.where("one = 'x'").count() == 1
    assert runs.value == 50
    nothing = profile.drop_deep_empty(rows.where("id < 0"), materialize=True)
    assert nothing.columns == rows.columns and nothing.count() == 0
