import datetime as dt

import pytest

from pyspark.sql import functions as F

from pricelake.operators import staging
from pricelake.session import scratch_path
from pricelake.sources import files

PRICE_COLS = "date string, open string, high string, low string, close string, volume string, " \
             "ticker string, ingested_at timestamp_ntz"
TS = dt.datetime(2024, 1, 2)


def test_price_validation(spark):
    raw = spark.createDataFrame([
        ("2024-01-02", "1", "2", "1", "1.5", "10", "  aapl ", TS),
        ("2024-01-02", "1", "2", "1", "1.5", "10", "  ", TS),          # blank ticker: kept
        ("2024-01-03", "1", "2", "1", "1.5", None, "aapl", TS),         # null volume: kept
        ("2024-01-04", "0", "2", "1", "1.5", "10", "aapl", TS),         # zero open: dropped
        ("2024-01-05", "1", "1", "2", "1.5", "10", "aapl", TS),         # high < low: dropped
        ("2024-01-06", "1", "2", "1", "n/a", "10", "aapl", TS),         # bad close: dropped
        ("bad", "1", "2", "1", "1.5", "10", "aapl", TS),                # bad date: dropped
        ("2024-01-08", "1", "2", "1", "1.5", "164000.0", "aapl", TS),   # float volume: 164000
    ], PRICE_COLS)
    out = staging.stg_prices(raw).collect()
    assert len(out) == 4
    assert {r["ticker"] for r in out} == {"AAPL", ""}
    assert {r["volume"] for r in out} == {10, None, 164000}
    r = [x for x in out if x["price_date"] == dt.date(2024, 1, 2) and x["ticker"] == "AAPL"][0]
    assert r["price_change"] == 0.5 and r["pct_change_open_to_close"] == 50.0


def _companies(spark, rows):
    return spark.createDataFrame(rows, "ticker string, company_name string, sector string, "
                                 "industry string, country string, exchange string, "
                                 "currency string, market_cap bigint, full_time_employees bigint, "
                                 "website string, ingested_at timestamp_ntz")


def test_company_dedup_and_validation(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    raw = _companies(spark, [
        ("x", "X null", "s", "i", "c", "e", "u", None, 1, "w", t2),
        ("x", "X five", "s", "i", "c", "e", "u", 5, 1, "w", t2),
        ("x", "X nine", "s", "i", "c", "e", "u", 9, 1, " ", t1),
        ("y", "Y old", "s", "i", "c", "e", "u", 7, 1, "w", t1),
        ("y", "Y new", "s", "i", "c", "e", "u", 7, 1, "w", t2),       # equal cap: later wins
        ("  ", "blank", "s", "i", "c", "e", "u", 7, 1, "w", t1),      # blank ticker: dropped
        ("z", None, "s", "i", "c", "e", "u", 7, 1, "w", t1),          # null name: dropped
    ])
    out = {r["ticker"]: r for r in staging.stg_companies(raw).collect()}
    assert set(out) == {"X", "Y"}
    assert out["X"]["company_name"] == "X nine" and out["X"]["website"] is None
    assert out["Y"]["company_name"] == "Y new"
    assert out["X"]["market_cap_category"] == "Micro Cap"


def test_csv_by_header_name_and_rejects(spark):
    path = scratch_path(spark, "csv-test")
    df = spark.createDataFrame([("1.5", "2024-01-02", "1", "2", "1", "164000.0", "a", "2024-01-02 00:00:00"),
                                ("2", "bad", "1", "2", "1", "5", "b", "2024-01-02 00:00:00"),
                                ("NULL", "2024-01-03", "1", "2", "1", "7", "c", "2024-01-02 00:00:00")],
                               "close string, date string, open string, high string, low string, "
                               "volume string, ticker string, ingested_at string")
    files.write_csv(df, path)     # Close-first file
    raw = files.read_raw_csv(spark, path)
    good, rejects = files.split_rejects(raw, files.RAW_PRICE_TYPES)
    g = {r["ticker"]: r for r in good.collect()}
    assert g["a"]["close"] == 1.5 and g["a"]["open"] == 1.0 and g["a"]["volume"] == 164000
    assert g["c"]["close"] is None           # NULL token -> null, not a reject
    rj = rejects.collect()
    assert [(r["ticker"], r["reject_columns"]) for r in rj] == [("b", "date")]


def test_restrict_and_combine(spark):
    a = spark.createDataFrame([("A", dt.date(2024, 1, 2))], "ticker string, price_date date")
    b = spark.createDataFrame([("B", dt.date(2023, 1, 2))], "ticker string, price_date date")
    both = staging.combine_extracts([a, b])
    assert both.count() == 2
    assert staging.restrict(both, ["A", "B"], "2024-01-01", "2024-12-31").count() == 1
    uni = spark.createDataFrame([("B",)], "t string")
    assert staging.restrict(both, uni).collect()[0]["ticker"] == "B"
    try:
        staging.combine_extracts([])
        raise AssertionError("expected failure")
    except ValueError:
        pass


def test_stamp(spark):
    df = spark.createDataFrame([(1.0,)], "Close double")
    out = staging.stamp(df, "MSFT", "2024-01-02 00:00:00")
    r = out.collect()[0]
    assert out.columns == ["close", "ticker", "ingested_at"] and r["ticker"] == "MSFT"


def test_json_missing_fields_become_null(spark):
    path = scratch_path(spark, "json-test")
    spark.createDataFrame([('{"TICKER": "aa", "COMPANY_NAME": "A", "MARKET_CAP": 164000.0}',),
                           ('{"TICKER": "bb", "COMPANY_NAME": "B", "SECTOR": "oil & gas e&p",'
                            ' "INGESTED_AT": "2024-01-02 00:00:00"}',)], "value string") \
        .write.text(path)
    raw = files.read_company_records(spark, path)
    assert raw.columns == list(files.RAW_COMPANY_TYPES)
    r = {x["ticker"]: x for x in raw.collect()}
    assert r["aa"]["market_cap"] == 164000 and r["aa"]["sector"] is None
    assert r["bb"]["market_cap"] is None and r["bb"]["ingested_at"] == dt.datetime(2024, 1, 2)
    out = {x["ticker"]: x for x in staging.stg_companies(raw).collect()}
    assert out["BB"]["sector"] == "Oil & Gas E&P" and out["AA"]["market_cap_category"] == "Micro Cap"


def test_file_loads_into_raw_then_build(spark):
    """CSV + JSON files -> RAW (rejects kept aside) -> marts, through the warehouse module."""
    from pricelake.plans import warehouse
    root = scratch_path(spark, "file-load")
    csv_path, json_path = scratch_path(spark, "csv-in"), scratch_path(spark, "json-in")
    files.write_csv(spark.createDataFrame(
        [("2024-01-02", "10", "11", "9", "10.5", "100", "abc", "2024-01-03 00:00:00"),
         ("2024-01-03", "10.5", "12", "10", "11", "164000.0", "abc", "2024-01-04 00:00:00"),
         ("bad", "1", "2", "1", "1.5", "10", "abc", "2024-01-04 00:00:00")],
        "date string, open string, high string, low string, close string, volume string, "
        "ticker string, ingested_at string"), csv_path)
    spark.createDataFrame([('{"TICKER": "abc", "COMPANY_NAME": "Abc Inc", "SECTOR": "energy",'
                            ' "MARKET_CAP": 5e11, "INGESTED_AT": "2024-01-01 00:00:00"}',)],
                          "value string").write.text(json_path)
    paths = warehouse.load_csv(spark, csv_path, root)
    warehouse.load_company_json(spark, json_path, root)
    assert spark.read.parquet(paths["raw_stock_prices_rejects"]).count() == 1
    warehouse.build(spark, root, full_refresh=True)
    fct = {r["trading_day_seq"]: r for r in warehouse.current(spark, root, "fct_stock_prices").collect()}
    assert len(fct) == 2 and fct[2]["daily_return_pct"] == round((11 - 10.5) / 10.5 * 100, 4)
    assert fct[2]["volume"] == 164000 and fct[1]["market_cap_category"] == "Mega Cap"


def test_orphan_ticker_keeps_its_prices_with_null_company(spark):
    from pricelake.operators import intermediate
    prices = spark.createDataFrame([("A", dt.date(2024, 1, 2)), ("ORPHAN", dt.date(2024, 1, 2))],
                                   "ticker string, price_date date")
    companies = spark.createDataFrame(
        [("id-a", "A", "A Inc", "Energy", "Oil", "US", "NYQ", "USD", 1e9, "Small Cap", 10)],
        "company_id string, ticker string, company_name string, sector string, industry string, "
        "country string, exchange string, currency string, market_cap_usd double, "
        "market_cap_category string, full_time_employees bigint")
    out = {r["ticker"]: r for r in intermediate.attach_companies(prices, companies).collect()}
    assert out["A"]["company_name"] == "A Inc"
    assert out["ORPHAN"]["company_id"] is None and out["ORPHAN"]["sector"] is None


def _lines(path, name, *lines):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(lines) + "\n")


def test_csv_folder_with_other_headers_and_bad_rows(spark, tmp_path):
    head = "date,open,high,low,close,volume,ticker,ingested_at"
    _lines(tmp_path / "in", "a.csv", head, "2024-01-02,1,3,1,2,9007199254740993,AA,2024-01-03 00:00:00",
           "2024-01-03,1,3,1,2,10,AA", "2024-01-04,1,3,1,2,10,AA,2024-01-05 00:00:00,more",
           "2024-01-05,1,3,1,x,10,AA,2024-01-06 00:00:00", '2024-01-08,1,3,1,2,164000.0,"A,B",2024-01-09 00:00:00')
    _lines(tmp_path / "in", "b.csv", "CLOSE,ticker,volume,low,high,open,date,ingested_at",
           "2,BB,7,1,3,1,2024-01-02,2024-01-03 00:00:00")
    _lines(tmp_path / "in", "c.csv", "date,ticker,close", "2024-01-02,CC,5")
    (tmp_path / "in" / "d.csv").write_text("")
    types = files.RAW_PRICE_TYPES
    good, rejects = files.split_rejects(files.read_raw_csv(spark, str(tmp_path / "in"), list(types)), types)
    rows = sorted((r["ticker"], str(r["date"]), r["open"], r["close"], r["volume"]) for r in good.collect())
    assert rows == [("A,B", "2024-01-08", 1.0, 2.0, 164000), ("AA", "2024-01-02", 1.0, 2.0, 9007199254740993),
                    ("BB", "2024-01-02", 1.0, 2.0, 7)]
    assert sorted(r["reject_columns"].split(",")[0] for r in rejects.collect()) == ["close", "record", "record", "record"]


def test_csv_load_fails_when_nothing_arrives(spark, tmp_path):
    from pricelake.plans import warehouse
    head = "date,open,high,low,close,volume,ticker,ingested_at"
    _lines(tmp_path / "in", "a.csv", head, "2024-01-02,1,3,1,2,5,AA,2024-01-03 00:00:00")
    root = str(tmp_path / "wh")
    path = warehouse.load_csv(spark, str(tmp_path / "in"), root)["raw_stock_prices"]
    _lines(tmp_path / "in", "a.csv", head)
    with pytest.raises(ValueError, match="no rows arrived"):
        warehouse.load_csv(spark, str(tmp_path / "in"), root)
    assert spark.read.parquet(path).count() == 1          # RAW keeps what it had


def test_headers_are_read_without_the_files(spark, tmp_path):
    """The header pass runs no job and stops at each file's first line; gzip files and empty ones too."""
    import gzip
    from pricelake.streaming import folders
    body = "".join(f"{k},{k % 7},text\n" for k in range(400_000))
    (tmp_path / "in dir").mkdir()
    (tmp_path / "in dir" / "a.csv").write_text("x,y,z\n" + body)
    (tmp_path / "in dir" / "b.csv").write_text("\ufeffz,\"Y\",x\r\n1,2,3\r\n")
    (tmp_path / "in dir" / "c.csv.gz").write_bytes(gzip.compress(("x,y,z\n" + body).encode()))
    (tmp_path / "in dir" / "d.csv").write_text("")
    (tmp_path / "in dir" / "_hidden.csv").write_text("no,no\n")
    jvm = spark.sparkContext._jvm
    read = lambda: sum(s.getBytesRead() for s in jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    before, n = read(), jobs()
    found = files.csv_headers(spark, str(tmp_path / "in dir"))
    assert jobs() == n and read() - before < 3 * 65536
    assert [(names, [f[-8:] for f in fs]) for names, fs in found] == [(["x", "y", "z"], ["ir/a.csv", "c.csv.gz"]), (["z", "y", "x"], ["ir/b.csv"])]
    rows = files.read_raw_csv(spark, str(tmp_path / "in dir"))
    assert rows.count() == 800_001
    assert rows.filter("x = '3' and y = '2' and z = '1'").count() == 1
    long = tmp_path / "long.csv"
    long.write_text(",".join(f"column{k}" for k in range(5000)) + "\n1\n")
    assert len(folders.first_lines(spark, str(long))[0][1].split(",")) == 5000
