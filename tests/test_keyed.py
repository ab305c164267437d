from rollcall.operators import latest_by_key


def test_last_wins_and_null_comes_first(spark):
    rows = [("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z"), ("b", None, "n"), ("b", 0, "m"),
            ("c", None, "only"), (None, 1, "p"), (None, 2, "q")]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    found = {r.k: r.v for r in latest_by_key(df, ["k"], ["o"]).collect()}
    assert found == {"a": "y", "b": "m", "c": "only", None: "q"}


def test_second_order_column_breaks_ties(spark):
    df = spark.createDataFrame([(1, 5, 0, "x"), (1, 5, 1, "y")], "k int, o int, p int, v string")
    assert latest_by_key(df, ["k"], ["o", "p"]).first().v == "y"
    assert latest_by_key(df, ["k"], ["o", "p"]).columns == df.columns


def test_hot_key_is_thinned_before_the_shuffle(spark, tmp_path, executed):
    path = str(tmp_path / "log")
    spark.range(0, 60000, 1, 6).selectExpr(
        "case when id % 3 = 0 then -1 else id end as k", "id as o", "id * 2 as v"
    ).write.parquet(path)
    df = latest_by_key(spark.read.parquet(path), ["k"], ["o"])
    plan = executed(df)
    before, after = plan.split("Exchange hashpartitioning")
    assert "row_number(), 1, Final" in before
    assert "row_number(), 1, Partial" in after
    assert df.count() == 40001
    assert df.where("k = -1").first().v == 2 * 59997
