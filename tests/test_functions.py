"""Expression helpers against hand-written expectations (FIXTURES.md section 4)."""

from decimal import Decimal

from pyspark.sql import functions as F

from patronage.functions import cat, decode, ordered_listagg, sequence_suffix, strip_token, text_int, true_false


def one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_strip_token_removes_anywhere_and_empties_to_null(spark):
    out = one(spark, [("n/a",), ("x n/a",), (None,), ("",), ("2001",)], "s string", strip_token("s", "n/a"))
    assert out == [None, "x ", None, None, "2001"]


def test_cat_treats_null_as_empty(spark):
    out = one(spark, [(None, "L"), ("F", None), (None, None)], "a string, b string",
              cat("a", F.lit(" "), "b"))
    assert out == [" L", "F ", " "]


def test_ordered_listagg_nulls_last_and_skipped(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (1, 3, None), (1, None, "z"), (2, 5, None)],
                               "g int, k int, v string")
    out = dict(df.groupBy("g").agg(ordered_listagg("v", ";", "k").alias("l")).collect())
    assert out == {1: "a;b;z", 2: None}


def test_sequence_suffix_cannot_collide(spark):
    out = one(spark, [(1,), (9,), (99,), (100,), (1101,)], "n int", F.concat(F.lit("G1"), sequence_suffix("n")))
    assert out == ["G101", "G109", "G199", "G1#100#", "G1#1101#"]
    # every (text, number) can be read back from its id
    import re
    pairs = [(g, n) for g in ("", "G1", "G11", "G1#1", "G#101#", "#") for n in (1, 10, 99, 100, 101, 1101)]
    ids = one(spark, pairs, "g string, n int", F.concat("g", sequence_suffix("n")))
    back = [(m[1], int(m[2])) if (m := re.fullmatch(r"(.*)#(\d+)#", i)) else (i[:-2], int(i[-2:])) for i in ids]
    assert back == pairs


def test_text_int_is_null_for_sentinel(spark):
    out = one(spark, [("n/a",), ("1999",), (None,)], "s string", text_int("s"))
    assert out == [None, 1999, None]


def test_decode_and_true_false(spark):
    rows = [("M",), ("F",), ("N",), (None,)]
    out = one(spark, rows, "g string", decode("g", (("M", "Male"), ("F", "Female")), F.col("g")))
    assert out == ["Male", "Female", "N", None]
    out = one(spark, rows, "g string", true_false(F.col("g") == "M"))
    assert out == ["TRUE", "FALSE", "FALSE", "FALSE"]


def test_text_year_compare_lets_sentinel_through(spark):
    # 'n/a' >= '1930' as text: an alumnus without a class year qualifies
    out = one(spark, [("n/a",), ("1929",), ("1930",)], "s string", F.col("s") >= F.lit("1930"))
    assert out == [True, False, True]


def test_decimal_share_rounds_at_scale_4(spark):
    out = one(spark, [(Decimal("100.01"),)], "a decimal(14,2)", (F.col("a") / 2).cast("decimal(24,4)"))
    assert out == [Decimal("50.0050")]


def test_money_sum_is_exact_and_keeps_the_decimal_type(spark):
    from patronage.functions import money_sum
    df = spark.createDataFrame([(1, Decimal("0.10")), (1, Decimal("0.20")), (1, Decimal("-99999999999.99")),
                                (2, None), (3, Decimal("9999999999.99")), (3, Decimal("0.01"))],
                               "k int, a decimal(14,2)")
    got = dict(df.groupBy("k").agg(money_sum("a").alias("s")).collect())
    want = dict(df.groupBy("k").agg(F.sum("a").alias("s")).collect())
    assert got == want == {1: Decimal("-99999999999.69"), 2: None, 3: Decimal("10000000000.00")}
    assert df.agg(money_sum("a").alias("s")).schema["s"].dataType.simpleString() == "decimal(24,2)"
