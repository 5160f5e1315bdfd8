"""Series windows: hand-made edge cases and a brute-force comparison on random histories with
small chunks (many chunks shorter than the 89-row look-back)."""

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest

from pricelake.operators import series


def q(x, places=4):
    if x is None:
        return None
    return float(Decimal(x).quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP))


def d(x: float) -> Decimal:
    return Decimal(repr(x))


def _key(h):
    # Spark order: date, close, volume with nulls first.
    return (h[0], h[1], float("-inf") if h[4] is None else h[4])


def brute(hist):
    """Reference computation over one ticker's rows [(date, close, high, low, volume)]."""
    hist = sorted(hist, key=_key)
    out, rets = [], []
    for i, (day, close, high, low, vol) in enumerate(hist):
        prev = hist[i - 1][1] if i else None
        ret = None if not prev else q(d((close - prev) / prev * 100))
        rets.append(ret)
        row = {"price_date": day, "trading_day_seq": i + 1, "prev_close_price": prev,
               "daily_return_pct": ret}
        for n in (7, 30, 90):
            w = [d(h[1]) for h in hist[max(0, i - n + 1): i + 1]]
            row[f"sma_{n}d"] = q(sum(w) / len(w))
        for n in (7, 30):
            w = [h[4] for h in hist[max(0, i - n + 1): i + 1] if h[4] is not None]
            row[f"vol_ma_{n}d"] = None if not w else int(q(d(sum(w) / len(w)), 0))
        r = [d(x) for x in rets if x is not None]
        row["cumulative_avg_return_pct"] = q(sum(r) / len(r)) if r else None
        out.append(row)
    return out


def make_rows(seed, tickers=3, days=260, dup_share=0.0, decimals=2):
    rnd = random.Random(seed)
    rows = []
    for t in range(tickers):
        day = dt.date(2000, 1, 3)
        n = rnd.randint(days // 3, days)
        for _ in range(n):
            if rnd.random() >= dup_share:        # else: another bar on the same day
                day += dt.timedelta(days=rnd.choice([1, 1, 1, 2, 3, 7, 20]))
            close = round(rnd.uniform(1, 500), decimals)
            high, low = close + 1.0, max(close - 1.0, 0.01)
            vol = None if rnd.random() < 0.05 else rnd.randint(0, 10_000)
            rows.append((f"T{t}", day, close, high, low, vol))
    return rows


@pytest.mark.parametrize("seed,chunk_days,dup_share,decimals",
                         [(1, 5, 0.0, 2), (2, 45, 0.0, 2), (3, 732, 0.0, 2), (4, 10, 0.3, 2),
                          (5, 30, 0.0, 6), (6, 30, 0.0, 10)])
def test_series_matches_brute_force(spark, seed, chunk_days, dup_share, decimals):
    """dup_share > 0: several bars per (ticker, date) - not valid data, but the order (date,
    close, volume) must then be applied the same way in the side table and the main pass."""
    data = make_rows(seed, dup_share=dup_share, decimals=decimals)
    df = spark.createDataFrame(
        data, "ticker string, price_date date, close_price double, high_price double, "
              "low_price double, volume bigint")
    got = series.series_metrics(df, chunk_days=chunk_days).collect()
    by_t = {}
    for t, day, c, h, lo, v in data:
        by_t.setdefault(t, []).append((day, c, h, lo, v))
    want = {(t, r["trading_day_seq"]): r for t, hist in by_t.items() for r in brute(hist)}
    assert len(got) == len(want)
    cols = ["price_date", "trading_day_seq", "prev_close_price", "daily_return_pct", "sma_7d", "sma_30d",
            "sma_90d", "vol_ma_7d", "vol_ma_30d", "cumulative_avg_return_pct"]
    for r in got:
        w = want[(r["ticker"], r["trading_day_seq"])]
        for c in cols:
            assert r[c] == w[c], (r["ticker"], r["price_date"], c, r[c], w[c])


def test_first_day_and_gaps(spark):
    df = spark.createDataFrame(
        [("A", dt.date(2024, 1, 2), 10.0, 11.0, 9.0, 100),
         ("A", dt.date(2024, 1, 12), 20.0, 21.0, 19.0, 300),     # 10-day gap: frames count rows
         ("B", dt.date(2024, 1, 2), 5.0, 5.0, 5.0, None)],
        "ticker string, price_date date, close_price double, high_price double, "
        "low_price double, volume bigint")
    r = {(x["ticker"], x["trading_day_seq"]): x for x in series.series_metrics(df).collect()}
    a1, a2, b1 = r[("A", 1)], r[("A", 2)], r[("B", 1)]
    assert a1["prev_close_price"] is None and a1["daily_return_pct"] is None
    assert a1["sma_7d"] == 10.0 and a1["sma_90d"] == 10.0
    assert a2["sma_7d"] == 15.0 and a2["daily_return_pct"] == 100.0
    assert a2["vol_ma_7d"] == 200 and a2["cumulative_avg_return_pct"] == 100.0
    assert b1["vol_ma_7d"] is None and b1["price_vs_sma_30d"] == "At 30d MA"
    assert a2["intraday_range"] == 2.0 and a2["intraday_range_pct"] == 10.0


def test_daily_returns_only(spark):
    df = spark.createDataFrame(
        [("A", dt.date(2024, 1, d), float(d), float(d), float(d), 1) for d in range(1, 8)],
        "ticker string, price_date date, close_price double, high_price double, "
        "low_price double, volume bigint")
    out = series.daily_returns(df, chunk_days=2).orderBy("price_date").collect()
    assert [r["trading_day_seq"] for r in out] == list(range(1, 8))
    assert [r["prev_close_price"] for r in out] == [None, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0]
    assert "sma_7d" not in out[0].asDict()
