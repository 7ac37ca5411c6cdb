from snapmetrics.functions.metrics import price_growth, ratio


def test_zero_denominators_x6(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (-1.0, 0.0), (1.0, None), (1.0, 4.0)], "a double, b double")
    assert [r.q for r in df.select(ratio("a", "b").alias("q")).collect()] == [None, None, None, None, 0.25]


def test_price_growth_x11(spark):
    df = spark.createDataFrame([(2.0, 1.0), (2.0, 0.0), (2.0, 2.0)], "p double, c double")
    assert [r.g for r in df.select(price_growth("p", "c").alias("g")).collect()] == [1.0, 0.0, None]
