import os

from frames import to_spark, walk

from tidemark.operators.stats import summary
from tidemark.sources import candles as files

HEADER = "timestamp,open,high,low,close,volume,symbol\n"


def put(folder, name, text):
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def test_mixed_folder(spark, tmp_path):
    put(tmp_path, "BTC_USDT_4h_20240101.csv", HEADER + "2024-01-01 00:00:00,1,2,0.5,1.5,10,BTC/USDT\n2024-01-01 04:00:00,1,2,0.5,oops,10,BTC/USDT\n")
    put(tmp_path, "other.csv", "symbol,timestamp,open,high,low,close,volume,trades_count,note\nETH,2024-01-01 00:00:00,1,2,0.5,1.5,10,7,x\n,2024-01-01 01:00:00,1,2,0.5,1.5,10,8,x\n")
    put(tmp_path, "short.csv", "timestamp,open\n2024-01-01 00:00:00,1\n")
    rows, bad = files.read_candle_csv(spark, str(tmp_path))
    got = {(r["symbol"], r["timeframe"], r["trades_count"]) for r in rows.collect()}
    assert got == {("BTC/USDT", "4h", None), ("ETH", "1h", 7), ("other", "1h", 8)}
    quarantined = bad.collect()
    reasons = {r["reason"]: r for r in quarantined}
    assert len(quarantined) == 2 and "oops" in reasons["bad line"]["line"]
    assert reasons["missing columns high, low, close, volume, symbol"]["file"].endswith("short.csv")


def test_headers_of_any_form(spark, tmp_path):
    line = "2024-01-01 00:00:00,1,2,0.5,1.5,10,A\n"
    put(tmp_path, "quoted.csv", '"timestamp","open","high","low","close","volume","symbol"\n' + line)
    put(tmp_path, "blank.csv", ' timestamp , "open" ,high,low, close,volume,symbol\r\n' + line.replace("A", " B "))
    put(tmp_path, "mark.csv", "\ufeff" + HEADER + line.replace("A", "C"))
    put(tmp_path, "twice.csv", "timestamp,open,open,high,low,close,volume,symbol\n")
    put(tmp_path, "empty.csv", "\n")
    for i in range(105):
        put(tmp_path, f"n{i}.csv", HEADER.replace("\n", f",x{i}\n") + line.replace("A\n", f"D{i},0\n"))
    rows, bad = files.read_candle_csv(spark, str(tmp_path))
    assert {r["symbol"] for r in rows.select("symbol").collect()} == {"A", "B", "C", *(f"D{i}" for i in range(105))}
    assert sorted(r["reason"] for r in bad.collect()) == ["no header", "repeated or empty column names"]


def test_symbol_from_file_name(spark, tmp_path):
    put(tmp_path, "GOLD.csv", "timestamp,open,high,low,close,volume\n2024-01-01 00:00:00,1,2,0.5,1.5,10\n")
    assert files.read_candle_csv(spark, str(tmp_path))[0].count() == 0
    rows, _ = files.read_candle_csv(spark, str(tmp_path), need_symbol=False)
    assert rows.first()["symbol"] == "GOLD"


def test_rewriting_a_day_leaves_others(spark, tmp_path):
    path = str(tmp_path / "t")
    base = to_spark(spark, walk("A", 72))
    files.write_by_day(base, path)
    files.write_by_day(base.limit(3), path)
    days = {str(r["day"]): r["count"] for r in spark.read.parquet(path).groupBy("day").count().collect()}
    assert days == {"2024-01-01": 3, "2024-01-02": 24, "2024-01-03": 24}


def test_csv_folders_and_summary(spark, tmp_path):
    base = to_spark(spark, walk("BTC/USDT", 5))
    files.write_candle_csv(base, str(tmp_path / "c"))
    assert os.path.isdir(tmp_path / "c" / "symbol_safe=BTC_USDT" / "frame=1h")
    files.write_summary(summary(base), str(tmp_path / "s"))
    assert spark.read.option("header", True).csv(str(tmp_path / "s")).count() == 1
