"""Scalar Column builders on hand-made edge cases (FIXTURES.md 1, 5, 8, 9)."""

from pyspark.sql import functions as F

from fundlens.functions import numeric as nm
from fundlens.functions import strings as st


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_extract_token_and_isin(spark):
    names = ["A (LU0106258741)", "B (LU 0106258741)", "C (abc) (x)", "D ()", "E", None, "F (lu0106258741) \n"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    out = df.select(st.extract_token("n").alias("t")).select("t", st.token_isin("t").alias("i"))
    got = rows(out)
    assert got == [
        ("LU0106258741", "LU0106258741"),
        ("LU 0106258741", "LU0106258741"),
        ("X", None),
        (None, None),
        (None, None),
        (None, None),
        ("LU0106258741", "LU0106258741"),
    ]


def test_isin_rejects_trailing_newline(spark):
    df = spark.createDataFrame([("LU0106258741\n",), ("LU010625874",)], "t string")
    assert [r[0] for r in df.select(st.token_isin("t")).collect()] == [None, None]


def test_is_country_label(spark):
    labels = ["United States", "Asia", "Greater China", "South Africa", "Australasia", "", None, " Thailand "]
    df = spark.createDataFrame([(x,) for x in labels], "x string")
    got = [r[0] for r in df.select(st.is_country_label("x")).collect()]
    # tokens are case-sensitive: "Australasia" holds no token -> country
    assert got == [True, False, False, False, True, False, False, True]


def test_norm_code_and_holding_key(spark):
    df = spark.createDataFrame([(None, "Name"), ("", " n2 "), ("  aapl:us ", "Apple")], "t string, n string")
    out = df.select(st.norm_code("t").alias("tn"), st.norm_code("n").alias("nn"))
    out = out.select("tn", st.holding_key("tn", "nn").alias("k"))
    assert rows(out) == [("", "NAME"), ("", "N2"), ("AAPL:US", "AAPL:US")]


def test_display_helpers(spark):
    df = spark.createDataFrame(
        [("NVIDIA CorpNVDA:NSQ", "NVDA:NSQ"), ("Bank (CB25D04A)", None), (None, "X:Y"), ("a   b", "")],
        "n string, t string")
    out = df.select(st.normalize_ticker("t").alias("tk"), st.clean_holding_name("n", "t").alias("c"))
    out = out.select("tk", "c", st.display_label("c", "tk").alias("l"))
    assert rows(out) == [
        ("NVDA", "NVIDIA Corp", "NVIDIA Corp (NVDA)"),
        ("", "Bank", "Bank"),
        ("X", "", "X"),
        ("", "a b", "a b"),
    ]


def test_extract_symbol_and_clean_stock_name(spark):
    df = spark.createDataFrame(
        [("Stock ring P12", None), ("BANK X (CB25)", None), (" ", " "), ("Name", " ptt "), ("Acme PTT", "PTT"),
         ("abc", "  ")],
        "n string, fb string")
    out = df.select(st.extract_symbol("n", "fb").alias("s"), st.clean_stock_name("n", "fb").alias("c"))
    assert rows(out) == [("P12", "Stock ring P12"), ("CB25", "BANK X (CB25)"), (None, ""), ("PTT", "Name"),
                         ("PTT", "Acme"), ("ABC", "")]


def test_clip_and_ratio(spark):
    df = spark.createDataFrame([(0.0, 0.0), (130.0, 130.0), (100.0, 30.0), (50.0, None)], "t double, m double")
    out = df.select(nm.clip_range(nm.safe_ratio("m", F.least(F.col("t"), F.lit(100.0))), 0.0, 1.0).alias("r"))
    assert [r[0] for r in out.collect()] == [None, 1.0, 0.3, None]


def test_exact_sum_is_order_independent(spark):
    vals = [(0.1,), (0.2,), (0.3,), (1e9 + 0.123456,), (-0.1,)]
    a = spark.createDataFrame(vals, "v double").agg(nm.exact_sum("v")).first()[0]
    b = spark.createDataFrame(list(reversed(vals)), "v double").repartition(3).agg(nm.exact_sum("v")).first()[0]
    assert a == b
    assert abs(a - (1e9 + 0.623456)) < 1e-6
