"""Column-level helpers used inside the jobs.

Every helper returns a ``Column`` built from Spark's own functions, so expressions stay inside
whole-stage code generation; no Python UDF is involved anywhere in the package.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results)
# ---------------------------------------------------------------------------------------------
# Market-cap size classes, checked top-down with ">=" except the last one, which is "> 0".
CAP_CLASSES = [
    (200e9, "Mega Cap"),
    (10e9, "Large Cap"),
    (2e9, "Mid Cap"),
    (300e6, "Small Cap"),
]
CAP_MICRO = "Micro Cap"
CAP_UNKNOWN = "Unknown"
CAP_CATEGORIES = ["Mega Cap", "Large Cap", "Mid Cap", "Small Cap", "Micro Cap", "Unknown"]

# Signal labels for close price against the rounded 30-row simple moving average.
SIGNAL_ABOVE = "Above 30d MA"
SIGNAL_BELOW = "Below 30d MA"
SIGNAL_AT = "At 30d MA"
SIGNALS = ["Above 30d MA", "Below 30d MA", "At 30d MA"]

# Run-type tags for job-log rows, from lower-cased query text.
RUN_INCREMENTAL = "Incremental Run"
RUN_FULL = "Full Refresh Run"
INCREMENTAL_MARKERS = ["%is_incremental%", "%merge into%"]

# Word delimiters for initcap: whitespace plus  ! ? @ " ^ # $ & ~ _ , . : ; + - * % / | \ [ ] ( ) { } < >
INITCAP_DELIMITERS = r"""\s!?@"^#$&~_,.:;+\-*%/|\\\[\](){}<>"""

# Null placeholder used inside surrogate keys.
KEY_NULL = "_null_"
# ---------------------------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_divide(numerator, denominator) -> Column:
    """``numerator / denominator``, null when the denominator is 0 or null (never raises)."""
    return F.try_divide(_c(numerator), _c(denominator))


def surrogate_key(*cols) -> Column:
    """Deterministic text key: md5 over the '-'-joined string forms, nulls as a placeholder."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(KEY_NULL)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def initcap_words(x) -> Column:
    """Lower-case, then capitalise the first letter after start or after any delimiter.

    Spark's own ``initcap`` only looks at whitespace (``E&P`` -> ``E&p``); here the text is split
    *after* each delimiter with a zero-width look-behind and every piece is capitalised.
    """
    pieces = F.split(F.lower(_c(x)), f"(?<=[{INITCAP_DELIMITERS}])")
    capped = F.transform(
        pieces, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30)))
    return F.when(_c(x).isNotNull(), F.array_join(capped, ""))


def cap_category(market_cap) -> Column:
    m = _c(market_cap)
    expr = None
    for bound, label in CAP_CLASSES:
        expr = F.when(m >= bound, label) if expr is None else expr.when(m >= bound, label)
    return expr.when(m > 0, CAP_MICRO).otherwise(CAP_UNKNOWN)


def sma_signal(close, sma) -> Column:
    c, s = _c(close), _c(sma)
    return F.when(c > s, SIGNAL_ABOVE).when(c < s, SIGNAL_BELOW).otherwise(SIGNAL_AT)


def outside(x, lo: float, hi: float) -> Column:
    """Range violation: not null and strictly outside [lo, hi]."""
    v = _c(x)
    return v.isNotNull() & ((v > hi) | (v < lo))


def any_of(*preds: Column) -> Column:
    return reduce(lambda a, b: a | b, preds)


def run_type(text) -> Column:
    t = F.lower(_c(text))
    hit = any_of(*[t.like(p) for p in INCREMENTAL_MARKERS])
    return F.when(hit, RUN_INCREMENTAL).otherwise(RUN_FULL)


def trunc_date(unit: str, d) -> Column:
    """Start of the week (Monday) / month / quarter / year of a DATE, as a DATE."""
    return F.trunc(_c(d), unit)


def day_of_week0(d) -> Column:
    """Day of week with 0 = Sunday .. 6 = Saturday."""
    return F.dayofweek(_c(d)) - 1


def int_div(a, b) -> Column:
    """Integral quotient (truncated) of whole numbers, bigint or decimal(38,0)."""
    return F.call_function("div", _c(a), _c(b))


def exact_ratio(units_sum, count, in_scale: int, out_scale: int) -> Column:
    """round(units_sum / 10^in_scale / count, out_scale), half away from zero, as DOUBLE; null if
    count = 0.  ``units_sum`` is a whole number of 10^-in_scale units.  Integers only, so the result
    depends neither on summation order nor on how large the count is."""
    wide = "decimal(38,0)"
    u = _c(units_sum).cast(wide) * F.lit(10 ** max(0, out_scale - in_scale)).cast("decimal(6,0)")
    n = (F.nullif(_c(count), F.lit(0)).cast("decimal(20,0)")
         * F.lit(10 ** max(0, in_scale - out_scale)).cast("decimal(11,0)"))
    half_up = int_div((F.abs(u) * 2 + n).cast(wide), (n * 2).cast(wide))
    return F.signum(u.cast("double")) * half_up.cast("double") / F.lit(float(10 ** out_scale))


# Decimals kept of the fraction of a price: far below the spacing of doubles of price size, so an
# average rounds as that of the stored values.
PRICE_SCALE = 10


def price_parts(price) -> tuple[Column, Column]:
    """Whole and fraction (in 10^-PRICE_SCALE units) of a price that is not negative, as bigint:
    both subtractions are exact, and sums of either part stay exact."""
    p = _c(price)
    whole = F.floor(p)
    return whole.cast("long"), F.round((p - whole) * float(10 ** PRICE_SCALE)).cast("long")


def price_avg(whole_sum, fraction_sum, count) -> Column:
    """round(average, 4), half up, as DOUBLE, from sums of ``price_parts``; null if count = 0.
    All steps are bigint; what is below 1e-4 is carried as a remainder."""
    step = 10 ** (PRICE_SCALE - 4)
    w, f, n = _c(whole_sum), _c(fraction_sum), F.nullif(_c(count), F.lit(0))
    a = w * 10_000 + int_div(f, F.lit(step))
    q = int_div(a, n)
    up = ((a - q * n) * step + f % step) * 2 >= n * step
    return (q + F.when(up, 1).otherwise(0)).cast("double") / F.lit(10_000.0)


def packed(text) -> Column:
    """A text as bytes, told apart from all others: a md5 in lower-case hex as its 16 bytes after a zero
    byte, any other text as it is after a one.  Null stays null."""
    t = _c(text).cast("string")
    return F.when(t.rlike("^[0-9a-f]{32}$") & (F.length(t) == 32), F.concat(F.lit(b"\0"), F.unhex(t))) \
        .otherwise(F.concat(F.lit(b"\1"), t.cast("binary")))


def unpacked(data) -> Column:
    """The text of ``packed``."""
    d = _c(data)
    rest = F.substring(d, 2, 1 << 30)
    return F.when(F.substring(d, 1, 1) == F.lit(b"\0"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))


def exact_avg(x, in_scale: int, out_scale: int, over: WindowSpec | Window | None = None) -> Column:
    """``round(avg(x), out_scale)`` that is independent of floating-point summation order.

    Lossless when x carries at most ``in_scale`` decimals (cent prices: 2, rounded returns: 4).
    """
    units = F.round(_c(x) * 10 ** in_scale).cast("decimal(20,0)")
    s, n = F.sum(units), F.count(_c(x))
    if over is not None:
        s, n = s.over(over), n.over(over)
    return exact_ratio(s, n, in_scale, out_scale)
