"""The mixed-format parser against a literal table of inputs and results."""

from pyspark.sql import functions as F

from starling.functions.dates import (STANDARD_DATE, STANDARD_DATETIME, is_nonstandard,
                                      parse_mixed_datetime)

CASES = [
    ("2024-03-05", "2024-03-05 00:00:00"),
    ("2024-03-05 14:30:15", "2024-03-05 14:30:15"),
    ("2024/03/05 14:30:15", "2024-03-05 14:30:15"),
    ("March 05, 2024", "2024-03-05 00:00:00"),
    ("Mar 5, 2024", "2024-03-05 00:00:00"),
    ("03/05/2024 14:30", "2024-03-05 14:30:00"),
    ("05-03-2024", "2024-05-03 00:00:00"),        # month first, as the reference reads it
    ("05-03-2024 10:11:12", "2024-05-03 10:11:12"),
    ("25-03-2024", "2024-03-25 00:00:00"),        # day first only when it cannot be a month
    ("25/03/2024", "2024-03-25 00:00:00"),
    ("2024-3-5 7:05", "2024-03-05 07:05:00"),
    ("2024-03-05T14:30:15", "2024-03-05 14:30:15"),
    ("  2024-03-05  ", "2024-03-05 00:00:00"),
    ("20240305", "1970-08-23 06:18:25"),          # all digits are Unix seconds
    ("0", "1970-01-01 00:00:00"),
    ("9223372036", "2262-04-11 23:47:16"),
    ("99999999999", None),                        # beyond the nanosecond range
    ("2024-13-01", None), ("13-13-2024", None), ("2024-02-30", None),
    ("garbage", None), ("1.5", None), ("-5", None),
    ("today", None), ("12:30", None), ("Mar 2024", None), ("2024-03", None),
    ("", None), ("   ", None), ("nan", None), ("NaN", None), ("None", None), ("NULL", None), (None, None),
]


def _run(spark, values, **kw):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    out = df.select(F.date_format(parse_mixed_datetime(F.col("s"), **kw), "yyyy-MM-dd HH:mm:ss").alias("p"))
    return [r.p for r in out.collect()]


def test_parse_table(spark):
    got = _run(spark, [c[0] for c in CASES])
    for (raw, want), g in zip(CASES, got):
        assert g == want, (raw, g, want)


def test_hyphen_day_first_switch(spark):
    assert _run(spark, ["05-03-2024", "25-03-2024"], hyphen_day_first=True) == [
        "2024-03-05 00:00:00", "2024-03-25 00:00:00"]


def test_parse_result_is_zoneless(spark):
    df = spark.createDataFrame([("2024-03-05 10:00:00",)], "s string")
    assert df.select(parse_mixed_datetime(F.col("s")).alias("p")).schema["p"].dataType.simpleString() == "timestamp_ntz"


def test_nonstandard_counts(spark):
    rows = [("2024-03-05",), ("2024-3-5",), ("03/05/2024",), (None,), ("2024-03-05 10:00:00",)]
    df = spark.createDataFrame(rows, "s string")
    r = df.agg(F.count_if(is_nonstandard(F.col("s"), STANDARD_DATE)).alias("d"),
               F.count_if(is_nonstandard(F.col("s"), STANDARD_DATETIME)).alias("t")).first()
    assert (r.d, r.t) == (4, 4)


PANDAS_LAYOUTS = [
    "2024-03-05T14:30", "2024-03-05T14:30:15.123456789", "2024-03-05 14:30:15.1234567", "05-Mar-2024", "5 March 2024", "Mar 5 2024",
    "March 05, 2024 14:30", "05/03/24", "13/03/24", "05.03.2024", "2024.03.05", "\t2024-03-05\t", " 2024-03-05 10:00\n",
    "03/05/2024 02:30 PM", "03/05/2024 12:05 AM", "2024-03-05 12:30:15 pm", "March 5, 2024 1:30 PM", "31 Feb 2024",
    "5-Mar-2024 10:11:12", "mar 05, 2024", "Sept 5 2024", "2024/3/5 4:05", "2024-03-05 25:00", "13/13/2024"]


def test_layouts_read_as_pandas_reads_them(spark):
    import pandas as pd
    df = spark.createDataFrame(list(enumerate(PANDAS_LAYOUTS)), "i int, s string")
    got = {r.i: r.p for r in df.select("i", parse_mixed_datetime(F.col("s")).alias("p")).collect()}
    for i, text in enumerate(PANDAS_LAYOUTS):
        try:
            want = pd.to_datetime(text.strip(), format="mixed").floor("us").to_pydatetime()
        except Exception:
            want = None
        assert got[i] == want, (text, got[i], want)
