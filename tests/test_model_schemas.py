"""Published column order and types of every model (FIXTURES.md section 1)."""

from pricelake.operators import intermediate, marts, series, staging
from pricelake.plans import catalog

SF = "/root/testdata/sf0.001"


def test_model_layouts(spark):
    p, c = catalog.stg_p(spark, SF), catalog.stg_c(spark, SF)
    j = intermediate.prices_joined(p, c)
    r = series.daily_returns(j)
    m = series.moving_averages(r)
    f = marts.fct_prices(p, c)
    d = marts.dim_companies(c)
    assert p.columns == staging.STG_PRICE_COLUMNS and len(p.columns) == 12
    assert c.columns == staging.STG_COMPANY_COLUMNS and len(c.columns) == 14
    assert j.columns == intermediate.JOINED_COLUMNS and len(j.columns) == 22
    assert r.columns == series.RETURNS_COLUMNS and len(r.columns) == 27
    assert m.columns == series.MOVING_AVERAGE_COLUMNS and len(m.columns) == 34
    assert f.columns == marts.FCT_COLUMNS and len(f.columns) == 37 and "company_id" not in f.columns
    assert d.columns == marts.DIM_COLUMNS and len(d.columns) == 14
    types = {x.name: x.dataType.simpleString() for x in f.schema.fields}
    assert types["price_week"] == "date" and types["day_of_week"] == "int"
    assert types["trading_day_seq"] == "int" and types["vol_ma_7d"] == "bigint"
    assert types["ingested_at"] == "timestamp_ntz" and types["dbt_updated_at"] == "timestamp"
    assert types["market_cap_usd"] == "double" and types["full_time_employees"] == "bigint"
