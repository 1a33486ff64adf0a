import math
from datetime import date

import pytest
from nightledger.functions import offers as fo
from nightledger.functions.text import canonical_url, compared_values, value_set
from pyspark.sql import functions as F


def one(spark, values, kind, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("v")).alias("x"), "i").orderBy("i").select("x").collect()]


def test_price_texts(spark):
    texts = ["EUR 1,095", "EUR 919", "EUR 1,095.50", "EUR 1.095,50", "EUR 2.800", "none", "", None, "12,5", "1.234.567", "€ 61,29", "1,234,567.8", "-5", ".", "9" * 400]
    got = one(spark, texts, "string", fo.parse_price)
    assert got[:14] == [1095.0, 919.0, 1095.5, 1095.5, 2800.0, None, None, None, 12.5, 1234567.0, 61.29, 1234567.8, -5.0, None]


def test_nightly_room_slug(spark):
    df = spark.createDataFrame([(1095.0, 4), (None, 4), (10.0, 0), (10.0, None), (10.0, -1)], "t double, n int")
    assert [r[0] for r in df.select(fo.nightly("t", "n")).collect()] == [273.75, None, None, None, None]
    assert one(spark, ["217097709_383286522_2_1_0", "no-leading-digits", None, "12"], "string", fo.room_of_block) == ["217097709", None, None, None]
    assert one(spark, ["Hôtel & Spa!", "__a__", "", None], "string", fo.slug) == ["h_tel_spa", "a", "", None]


def test_meal_plan_and_cancellation(spark):
    texts = ["All-Inclusive, breakfast", "Full board", "half board", "Breakfast included", "", None]
    assert one(spark, texts, "string", lambda c: fo.meal_plan(c)[1]) == [4, 3, 2, 1, 0, 0]
    texts = ["Free cancellation, non-refundable", "Non refundable", "x", None]
    assert one(spark, texts, "string", lambda c: fo.cancellation(c)[2]) == [1, 0, None, None]


def test_quality_phrases_stay_within_words_and_tokens(spark):
    rows = [["kitchenware"], ["private kitchen"], ["private", "entrance"], ["private entrance"], [], None]
    assert one(spark, rows, "array<string>", lambda c: fo.quality_flags(c)["hq__kitchen"]) == [0, 1, 0, 0, 0, 0]
    assert one(spark, rows, "array<string>", lambda c: fo.quality_flags(c)["hq__private_entrance"]) == [0, 0, 0, 1, 0, 0]


def test_calendar_and_stay(spark):
    days = [date(2031, 7, 5), date(2031, 1, 1), None]
    assert one(spark, days, "date", lambda c: fo.calendar(c)["checkin_is_weekend"]) == [True, False, None]
    assert one(spark, days, "date", lambda c: fo.calendar(c)["season"]) == ["peak", "off", None]
    assert one(spark, days, "date", lambda c: fo.stay(c, F.lit(3), F.lit(2))[1]) == [date(2031, 7, 10), date(2031, 1, 6), None]


def test_similarities(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (math.nan, 2.0), (5.0, 5.0)], "a double, b double")
    a, b = F.col("a"), F.col("b")
    assert [r[0] for r in df.select(fo.numeric_similarity(a, b, 4)).collect()] == [0.75, None, None, 1.0]
    assert [r[0] for r in df.select(fo.numeric_similarity(a, b, 4, "zero")).collect()] == [0.75, 0.0, 0.0, 1.0]
    assert df.limit(1).select(fo.weighted_mean([(0.2, F.lit(1.0)), (0.6, F.lit(None).cast("double")), (0.2, F.lit(0.0))])).first()[0] == 0.5
    assert df.limit(1).select(fo.weighted_mean([(0.2, F.lit(None).cast("double"))])).first()[0] == 0.0


def test_names_of_hot_columns_dont_clash():
    assert list(fo.multi_hot(F.col("t"), ["a b", "A-b", "?"], "x_")) == ["x_a_b", "x_a_b_2", "x_value"]


def test_flags(spark):
    assert one(spark, ["Yes", "0", None, " TRUE "], "string", fo.boolean_of) == [True, False, False, True]
    with pytest.raises(Exception, match="not a flag"):
        one(spark, ["perhaps"], "string", fo.boolean_of)


def test_values_and_addresses(spark):
    rows = [["A  B", "a b ", " ", None, "c"], [], None]
    assert one(spark, rows, "array<string>", value_set) == [["a b", "c"], [], []]
    assert one(spark, rows, "array<string>", compared_values) == [["a b", "a b", "c"], [], []]
    assert one(spark, ["u?a#b", "u#b?a", "u", "", None], "string", canonical_url) == ["u", "u", "u", "", None]
    assert one(spark, ["u?x=1"], "string", lambda c: fo.with_query(c, checkin="2031-07-01", q="a b")) == ["u?checkin=2031-07-01&q=a+b"]
