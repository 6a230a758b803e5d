import pytest

from barlab.operators import features
from barlab.sinks import files as out
from barlab.sources import files


@pytest.fixture(scope="module")
def grid(tmp_path_factory):
    base = tmp_path_factory.mktemp("raw")
    header = "Date,Open,High,Low,Close,Volume\n"
    lines = "2024-01-02 01:00:00,1,3,1,2,10\n2024-01-02 00:00:00,1.5,3,1,null,20\n"
    for name in ("EURUSD_1h", "EURUSD_1d", "GBPUSD_1h", "XEURUSD_1h"):
        (base / f"{name}_2017-01-01_2024-12-31.csv").write_text(header + lines)
    return str(base)


def test_grid_is_tagged_and_missing_files_are_skipped(spark, grid):
    bars = files.read_bar_grid(spark, grid, ("EURUSD", "GBPUSD", "USDJPY"), ("1h", "1d"))
    counts = {(r.Pair, r.Timeframe): r["count"] for r in bars.groupBy("Pair", "Timeframe").count().collect()}
    assert counts == {("EURUSD", "1h"): 2, ("EURUSD", "1d"): 2, ("GBPUSD", "1h"): 2}
    assert bars.columns == ["Date", "Pair", "Timeframe", "Open", "High", "Low", "Close", "Volume"]
    assert bars.filter("Close is null").count() == 3


def test_grid_without_any_file_is_empty(spark, grid):
    bars = files.read_bar_grid(spark, grid, ("USDJPY",), ("1h",))
    assert bars.count() == 0 and "Timeframe" in bars.columns


def test_bad_lines_do_not_stop_the_rest(spark, tmp_path):
    path = tmp_path / "bars.csv"
    path.write_text(
        "Date,Open,High,Low,Close,Volume\n2024-01-01 00:00:00,1,1,1,1,1\nnonsense\n"
        "2024-01-01 01:00:00,1,1,x,1,1\n2024-01-01 02:00:00,1,1,1,1,1\n"
    )
    rows = files.read_permissive(spark, str(path))
    assert files.good_rows(rows).count() == 2
    bad = files.rejected_rows(rows).collect()
    assert sorted(r[files.CORRUPT] for r in bad) == ["2024-01-01 01:00:00,1,1,x,1,1", "nonsense"]


@pytest.mark.parametrize("format", ["csv", "parquet"])
def test_processed_table_survives_the_files(spark, make_bars, tmp_path, format):
    processed = features.bar_features(make_bars({"A": [1.0, 2.5, 4.0], "B": [7.0]}))
    out.write_processed(processed, str(tmp_path / "t"), format)
    back = files.read_processed(spark, str(tmp_path / "t"), format)
    assert back.columns == processed.columns
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, processed.collect()), key=str)
    assert dict(back.dtypes)["Volatility5"] == "double"
    assert (tmp_path / "t" / "Timeframe=1h" / "Pair=A").exists()


def test_processed_scan_prunes_folders(spark, make_bars, tmp_path):
    out.write_processed(features.bar_features(make_bars({"A": [1.0], "B": [7.0]})), str(tmp_path / "t"))
    one = files.read_processed(spark, str(tmp_path / "t"), "parquet").filter("Pair = 'A'").select("Close")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Pair" in plan and "ReadSchema: struct<Close:double>" in plan


def test_null_text_is_read_as_a_missing_number(spark, tmp_path):
    path = tmp_path / "p.csv"
    columns = files.PROCESSED_SCHEMA.names
    values = ["2024-01-01 00:00:00", "A", "1h", *["1"] * 10, "null", "0", "0"]
    path.write_text(",".join(columns) + "\n" + ",".join(values) + "\n")
    row = files.read_processed(spark, str(path)).collect()[0]
    assert row.Volatility5 is None and row.MA20 == 1.0


def test_first_existing_path_wins(spark, tmp_path):
    (tmp_path / "old.csv").write_text("Pair,x\nA,1\n")
    paths = [str(tmp_path / "new.csv"), str(tmp_path / "old.csv")]
    assert files.read_first_existing(spark, paths).collect()[0].x == "1"
    assert files.read_first_existing(spark, paths[:1]) is None


def test_table_files_follow_the_order(spark, make_bars, tmp_path):
    bars = make_bars({"B": [1.0, 2.0], "A": [3.0, 4.0]}).select("Date", "Pair", "Close")
    out.write_table(bars, str(tmp_path / "t"))
    parts = sorted((tmp_path / "t").glob("part-*.csv"))
    lines = [line for part in parts for line in part.read_text().splitlines() if not line.startswith("Date")]
    assert [line.split(",")[1] for line in lines] == ["A", "B", "A", "B"]
