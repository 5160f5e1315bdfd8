import datetime as dt

from pyspark.sql import functions as F

from pricelake.functions import (
    cap_category, day_of_week0, exact_avg, initcap_words, run_type, safe_divide, sma_signal,
    surrogate_key, trunc_date,
)


def test_initcap_after_punctuation(spark):
    df = spark.createDataFrame(
        [("OIL & GAS E&P",), ("consumer-cyclical a/b",), ("",), (None,), ("middle east/nation_3",)],
        "s string")
    got = [r[0] for r in df.select(initcap_words("s")).collect()]
    assert got == ["Oil & Gas E&P", "Consumer-Cyclical A/B", "", None, "Middle East/Nation_3"]


def test_cap_category_boundaries(spark):
    caps = [200e9, 10e9, 2e9, 300e6, 1.0, 0.0, -1.0, None]
    df = spark.createDataFrame([(c,) for c in caps], "m double")
    got = [r[0] for r in df.select(cap_category("m")).collect()]
    assert got == ["Mega Cap", "Large Cap", "Mid Cap", "Small Cap", "Micro Cap",
                   "Unknown", "Unknown", "Unknown"]


def test_safe_divide_and_signal(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (3.0, 2.0)], "n double, d double")
    assert [r[0] for r in df.select(safe_divide("n", "d")).collect()] == [None, None, 1.5]
    s = spark.createDataFrame([(2.0, 1.0), (1.0, 2.0), (1.0, 1.0), (None, 1.0)],
                              "c double, s double")
    assert [r[0] for r in s.select(sma_signal("c", "s")).collect()] == [
        "Above 30d MA", "Below 30d MA", "At 30d MA", "At 30d MA"]


def test_dates(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 7),), (dt.date(2024, 1, 6),)], "d date")
    got = df.select(day_of_week0("d"), trunc_date("week", "d"), trunc_date("month", "d"),
                    trunc_date("year", "d")).collect()
    assert got[0][0] == 0 and got[1][0] == 6
    assert got[0][1] == dt.date(2024, 1, 1)
    assert got[0][2] == dt.date(2024, 1, 1) and got[0][3] == dt.date(2024, 1, 1)


def test_surrogate_key_deterministic_and_null_safe(spark):
    df = spark.createDataFrame([("A", dt.date(2024, 1, 2)), ("A", None)], "t string, d date")
    k = [r[0] for r in df.select(surrogate_key("t", "d")).collect()]
    assert len(set(k)) == 2 and all(len(x) == 32 for x in k)


def test_run_type(spark):
    df = spark.createDataFrame([("MERGE INTO x",), ("-- is_incremental()",), ("select 1",)], "q string")
    assert [r[0] for r in df.select(run_type("q")).collect()] == [
        "Incremental Run", "Incremental Run", "Full Refresh Run"]


def test_exact_avg_half_up(spark):
    # 0.00005 average must round half up to 0.0001, independent of float summation.
    df = spark.createDataFrame([(0.0001,), (0.0,)], "x double")
    assert df.select(exact_avg("x", 4, 4)).collect()[0][0] == 0.0001
    df2 = spark.createDataFrame([(-0.0001,), (0.0,)], "x double")
    assert df2.select(exact_avg("x", 4, 4)).collect()[0][0] == -0.0001


from decimal import ROUND_HALF_UP, Decimal  # noqa: E402

from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

from pricelake.functions.scalar import INITCAP_DELIMITERS  # noqa: E402

_DELIMS = set(' \t\n!?@"^#$&~_,.:;+-*%/|\\[](){}<>')


def py_initcap(s):
    out, cap = [], True
    for ch in s.lower():
        out.append(ch.upper() if cap else ch)
        cap = ch in _DELIMS
    return "".join(out)


def test_delimiter_list_matches_python_set():
    # The regex character class used by the library equals the set used by py_initcap.
    import re
    rx = re.compile(f"[{INITCAP_DELIMITERS}]")
    assert {c for c in map(chr, range(32, 127)) if rx.match(c)} == {c for c in _DELIMS if c >= " "}


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="abcXYZ &-/_.(é ", min_size=0, max_size=12), min_size=1,
                max_size=8))
def test_initcap_matches_python_rule(spark, words):
    df = spark.createDataFrame([(w,) for w in words], "s string")
    got = [r[0] for r in df.select(initcap_words("s")).collect()]
    assert got == [py_initcap(w) for w in words]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(-10**9, 10**9), min_size=1, max_size=40))
def test_exact_avg_is_half_up_of_true_mean(spark, units):
    xs = [u / 10**4 for u in units]                      # values with at most 4 decimals
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = df.select(exact_avg("x", 4, 4)).collect()[0][0]
    true = (Decimal(sum(units)) / len(units) / 10**4).quantize(Decimal("0.0001"), ROUND_HALF_UP)
    assert got == float(true)


def test_exact_ratio_of_huge_counts(spark):
    from pricelake.functions.scalar import exact_ratio, price_avg
    df = spark.createDataFrame([(3 * 10**14 + 1, 2 * 10**13), (-5, 10**5), (0, 7), (1, 0)], "u long, n long")
    got = [r[0] for r in df.select(exact_ratio("u", "n", 4, 4)).collect()]
    assert got == [0.0015, -0.0001 if 2 * 5 >= 10**5 else 0.0, 0.0, None]
    sums = spark.createDataFrame([(10, 1_500_000, 3), (0, 500_000, 1), (0, 499_999, 1), (5, 0, 0)], "w long, f long, n long")
    assert [r[0] for r in sums.select(price_avg("w", "f", "n")).collect()] == [3.3334, 0.0001, 0.0, None]
