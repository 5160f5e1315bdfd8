from pricelake.__main__ import main
from pricelake.plans import warehouse
from pricelake.session import scratch_path


def test_cli_load_build_test(spark, capsys):
    root = scratch_path(spark, "cli")
    assert main(["load", "--root", root, "--sf-dir", "/root/testdata/sf0.001"]) == 0
    assert main(["build", "--root", root, "--full-refresh"]) == 0
    assert main(["build", "--root", root]) == 0                      # incremental: v=2
    assert warehouse.current_path(spark, root, "fct_stock_prices").endswith("d=2")
    code = main(["test", "--root", root, "--as-of", "2024-01-31"])
    out = capsys.readouterr().out
    assert "all_tickers_present" in out          # the fixed universe is not in these tables
    assert code == 1 and "daily_return_within_bounds" in out and "failing rules" in out
