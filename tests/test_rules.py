"""Literal cases of the cleaning rules."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom import presets
from ledgerloom.config import CleaningConfig, Categorical, Dates, Dedup, Geo, Missing, Outliers, Payment, Price, Ratings
from ledgerloom.functions import parsing
from ledgerloom.functions.dates import parse_date
from ledgerloom.operators import cleaning as cl


def outcomes(spark, values, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("v"))).collect()]


def step_outcomes(spark, values, step, *settings):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["v"] for r in cl.clean_one(step, rows, *settings).orderBy("i").collect()]


def test_prices(spark):
    given = ["Rs. 1,500", "1e5", "(12.5)", "₹ 2,000", "1-2", "--5", "5-", None, "", "2.675", "0.125"]
    assert step_outcomes(spark, given, cl.prices_step, Price(("v",), coerce_invalid_to_null=True)) == [
        0.15, 15.0, -12.5, 2000.0, None, None, None, None, None, *np.round([2.675, 0.125], 2)]


def test_price_signs(spark):
    given = ["-5", "(5", "5)", "(-5)", "()", "-", ".", "5.", ".5", "-.5", "(1,234.50)", "$-7", "7-", "1.2.3", "((5))", "-(5)", "- 5 Rs"]
    assert step_outcomes(spark, given, cl.prices_step, Price(("v",), coerce_invalid_to_null=True)) == [
        -5.0, None, None, None, None, None, None, 5.0, 0.5, -0.5, -1234.5, -7.0, None, None, None, None, -5.0]


def test_price_keeps_text_when_asked(spark):
    rows = spark.createDataFrame([("5.5",), ("free",)], "v string")
    kept = cl.clean_one(cl.prices_step, rows, Price(("v",))).collect()
    assert [(r["v"], r["v_raw"]) for r in kept] == [(5.5, None), (None, "free")]


def test_ratings(spark):
    given = ["4", "4 stars", "3/5", "9/10", "7", "0.2", "0/5", "0 Stars", "1 star", "inf", "0", "-1", "5d", None]
    got = step_outcomes(spark, given, cl.ratings_step, Ratings("v", impute_strategy=2.0), ())
    assert got == [4.0, 4.0, 3.0, 4.5, 5.0, 1.0, 1.0, 1.0, 1.0, 5.0, 2.0, 2.0, 2.0, 2.0]


def test_rating_means_and_medians(spark):
    given = ["1", "2", "5", None]
    assert step_outcomes(spark, given, cl.ratings_step, Ratings("v"), ())[3] == 2.0
    assert step_outcomes(spark, given, cl.ratings_step, Ratings("v", impute_strategy="mean"), ())[3] == 2.7


def test_delivery(spark):
    given = ["Same Day", "2-4 days", "4–2", "10+", "3.5", "90 days", "-3", "Express", None, "7 - 9"]
    got = outcomes(spark, given, lambda c: parsing.delivery_days(parsing.lower_text(c), 30, True))
    assert got == [0, 4, 4, 10, 3, 30, None, None, None, 9]
    assert outcomes(spark, ["90 days"], lambda c: parsing.delivery_days(parsing.lower_text(c), 30, False)) == [90]


def test_booleans(spark):
    assert outcomes(spark, ["Yes", "T", " y ", "0", "NO", "maybe", None], parsing.boolean) == [
        True, True, True, False, False, None, None]


def test_payment(spark):
    given = ["PhonePe", "C.O.D", "debit card", "Bank Account", "Credit", "cash_on_delivery", "CreditCard", "G Pay", None, "my gpay"]
    assert step_outcomes(spark, given, cl.payment_step, Payment("v", presets.PAYMENT_MAPPINGS)) == [
        "UPI", "Cash on Delivery", "Debit Card", "Credit Card", "Credit", "Cash on Delivery", "Credit Card", "G Pay", None, "UPI"]


def test_cities(spark):
    given = ["Bangalore", "bengaluru ", "Hydrabad", "Chenai", "Kolkatta", "Mumbay", "Dehli", "Puna", None, "Pünē", "NEW  delhi"]
    geo = Geo("v", tuple(presets.CANONICAL_CITIES), presets.CITY_MAPPINGS, presets.CITY_CUTOFF)
    assert step_outcomes(spark, given, cl.cities_step, geo) == [
        "Bengaluru", "Bengaluru", "Hyderabad", "Chennai", "Kolkata", "Mumbay", "Dehli", "Puna", None, "Pune", "NEW  delhi"]


def test_categories(spark):
    given = ["  Home   Decor ", "ELECTRONIC", "Toys&Games", " Books\t", None]
    cfg = Categorical(("v",), mappings={"v": presets.CATEGORY_MAPPINGS})
    assert step_outcomes(spark, given, cl.categories_step, cfg) == ["home decor", "electronics", "toysandgames", "books", None]


def test_dates(spark):
    formats = ["%d/%m/%Y", "%d-%m-%y", "%Y-%m-%d", "%d %b %Y", "%b %d, %Y"]
    given = ["2020-1-5", "13/02/1999", "01-02-69", "01-02-68", "31/02/2020", "5 Jan 2021", "Jan 5, 2021", "2021-03-04 10:20:30", "x", None]
    got = outcomes(spark, given, lambda c: parse_date(c, formats).cast("string"))
    assert got == ["2020-01-05", "1999-02-13", "1969-02-01", "2068-02-01", None, "2021-01-05", "2021-01-05", "2021-03-04", None, None]
    general = {"2021/03/04": "2021-03-04", "Jan 5, 2021": "2021-01-05", "5 January 2021": "2021-01-05", "5th sept 99": "1999-09-05", "20210304": "2021-03-04",
               "25/12/2020": "2020-12-25", "12.25.68": "2068-12-25", "4.4.2004": "2004-04-04", "2021-Mar-4": "2021-03-04", "MARCH 4 2021 5:06 pm": "2021-03-04",
               "03/04/2021": None, "5 Foo 2021": None, "30 Feb 2021": None, "2021/13/01": None, "1 2 3": None, "not-a-date": None, "": None, "12": None,
               "2021/03/04T10:20:30.5": "2021-03-04", " 7-feb-2010 ": "2010-02-07", "99/99/2020": None}
    assert outcomes(spark, list(general), lambda c: parse_date(c).cast("string")) == list(general.values())
    assert outcomes(spark, ["03/04/2021", "5 January 2021"], lambda c: parse_date(c, ["%m/%d/%Y"]).cast("string")) == ["2021-03-04", "2021-01-05"]
    assert step_outcomes(spark, ["x", "2/1/2020"], cl.dates_step, Dates(("v",), input_formats=("%d/%m/%Y",))) == ["x", "2020-01-02"]


def test_dedup(spark):
    rows = spark.createDataFrame(
        [(1, None, "2", None), (2, None, "3", "b"), (3, "k", None, "c"), (4, "k", None, "d")], "n int, k string, q string, x string")
    first = cl.deduplicate(rows, Dedup(("k", "absent")), F.col("n")).orderBy("n").collect()
    assert [r["n"] for r in first] == [1, 3]
    summed = cl.deduplicate(rows, Dedup(("k",), "q", "aggregate"), F.col("n")).orderBy("n").collect()
    assert [(r["n"], r["q"], r["x"]) for r in summed] == [(1, 5.0, "b"), (3, 0.0, "c")]
    assert cl.deduplicate(rows, Dedup(("absent",)), F.col("n")).count() == 4


def test_outliers(spark):
    given = ["10", "11", "12", "1100", "130000", "bad", "7000"]
    got = step_outcomes(spark, given, cl.outliers_step, Outliers("v"), ())
    assert got == [10.0, 11.0, 12.0, 1100.0, 1300.0, None, 7000.0]  # median 556


def test_mode_takes_smallest_on_ties(spark):
    rows = spark.createDataFrame([("b", None), ("a", None), (None, None)], "v string, w string")
    filled = cl.impute_mode(rows, ["v", "w"])
    assert sorted(r["v"] for r in filled.collect()) == ["a", "a", "b"]
    assert {r["w"] for r in filled.collect()} == {None}


def test_config_sections():
    assert CleaningConfig.from_dict({"dates": {}, "other": {"x": 1}}).dates.target_format == "%Y-%m-%d"
    assert presets.CATALOG.missing.include[0] == "base_price_2015"
    with pytest.raises(TypeError):
        CleaningConfig.from_dict({"dates": {"unknown": 1}})


@pytest.mark.parametrize("by", [(), ("source_file",)])
def test_report_adds_up_and_empty_input_runs(spark, by):
    rows = spark.createDataFrame(
        [("f1", "a", "1", 1), ("f1", "a", "2", 2), ("f2", None, "3", 3)], "source_file string, k string, v string, n int")
    cfg = CleaningConfig(missing=Missing(exclude=("k",)), dedup=Dedup(("k",)), price=Price(("v",), coerce_invalid_to_null=True), outliers=Outliers("v"))
    cleaned, report = cl.run_cleaning(rows, cfg, F.col("n"), by)
    counts = {(r["step"], r["metric"]): r["s"] for r in report.filter("field = ''").groupBy("step", "metric").agg(F.sum("value").alias("s")).collect()}
    assert counts[("dedup", "dropped")] + counts[("dedup", "kept")] == counts[("dq", "rows_before")] == 3
    assert cleaned.count() == counts[("dq", "rows_after")] == 2
    none, _ = cl.run_cleaning(rows.limit(0), cfg, F.col("n"), by)
    assert none.count() == 0


def shown(column):
    return column._jc.toString()


def test_values_are_worked_out_once(spark):
    """A reading names its pieces once: nested alternatives multiplied the patterns and casts of every row."""
    from pyspark.sql import functions as F

    from ledgerloom.functions import dates as fd, parsing

    text = F.col("t")
    assert len(shown(parsing.rating_value(text))) < 1500
    assert len(shown(parsing.delivery_days(text, 30, True))) < 1000
    assert "regexp" not in shown(parsing.plain_text(text))
    for reading in (fd.parse_iso(text), fd.parse_with(text, "%d/%m/%Y"), fd.parse_with(text, "%d-%m-%y")):
        assert "to_date" not in shown(reading)


def test_numeric_formats_as_before(spark):
    from ledgerloom.functions import dates as fd

    given = ["1/2/2020", "31/02/2020", "29/2/2020", "01/02/0000", "1/2/20", "1/2/2020\n", " 1/2/2020", None]
    want = ["2020-02-01", None, "2020-02-29", "0000-02-01", None, None, None, None]
    assert [d for d in outcomes(spark, given, lambda c: fd.parse_with(c, "%d/%m/%Y").cast("string"))] == want
    given, want = ["5-6-68", "05-06-69", "29-02-72", "29-02-71"], ["2068-06-05", "1969-06-05", "1972-02-29", None]
    assert [d for d in outcomes(spark, given, lambda c: fd.parse_with(c, "%d-%m-%y").cast("string"))] == want
    given, want = ["2020-1-5", "0000-01-05", "2020-02-30", "2020-01-05\n"], ["2020-01-05", "0000-01-05", None, None]
    assert [d for d in outcomes(spark, given, lambda c: fd.parse_iso(c).cast("string"))] == want


def test_readings_at_their_edges(spark):
    from ledgerloom.functions import parsing

    given = ["4 stars", "4 Star", "3 / 5", "3/0", "0 stars", "4 stars x", "4 starstar", "-1", "0", "inf", "\x1c4.5　", "/5", "1e1", None]
    want = [4.0, 4.0, 3.0, None, 0.0, None, None, None, None, 5.0, 4.5, None, 10.0, None]
    assert outcomes(spark, given, lambda c: parsing.rating_value(parsing.plain_text(c))) == want
    given = ["2 - 4 days", "2–9", "5-", "9999999999999999999999-3", "3-9999999999999999999999", "-3", "7days", "Same Day", "", None]
    want = [4, 9, 5, None, 3, None, 7, 0, None, None]
    assert outcomes(spark, given, lambda c: parsing.delivery_days(parsing.lower_text(c), 30, True)) == want
