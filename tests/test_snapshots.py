from datetime import date

from nightledger.operators.snapshots import WINDOW_KEY, presence_records, snapshot_changes
from pyspark.sql import functions as F

D1, D2, D3 = date(2031, 1, 1), date(2031, 1, 3), date(2031, 1, 4)


def test_added_removed_changed_and_null_keys(spark, rows):
    data = [
        (D1, "a", 1, "on", 1.0), (D2, "a", 1, "on", 1.0), (D3, "a", 1, "on", 2.0),
        (D1, "b", None, "on", None), (D2, "b", None, "on", None), (D3, "b", None, None, None),
        (D1, None, 1, "x", 1.0), (D3, None, 1, "x", 1.0),
        (D2, "c", 7, "on", None), (D3, "c", 7, "on", 5.0),
        (None, "z", 1, "on", 1.0),
    ]
    df = spark.createDataFrame(data, "day date, k string, n int, status string, price double").selectExpr("*", "1 as at", "'x' as change", "2 as row_hash")
    got = rows(snapshot_changes(df, "day", ["k", "n"], ["status", "price"]))
    assert sorted(map(str, got)) == sorted(
        map(str, [(D2, None, 1, "removed"), (D2, "c", 7, "added"), (D3, "a", 1, "changed"), (D3, "b", None, "changed"), (D3, None, 1, "added"), (D3, "c", 7, "changed")])
    )


def test_no_or_one_snapshot(spark, rows):
    df = spark.createDataFrame([(D1, "a", 1)], "day date, k string, v int")
    assert rows(snapshot_changes(df, "day", ["k"], ["v"])) == []
    assert rows(snapshot_changes(df.limit(0), "day", ["k"], ["v"])) == []


def test_presence_last_row_counts_and_lowest_price(spark):
    key = "property_url string, lead_time_days int, stay_length_days int, adults int, children int, rooms int, currency string, market string"
    k = ("u", 1, 2, 2, 0, 1, "EUR", "m")
    seen = spark.createDataFrame([(D1, 1, *k, "available"), (D1, 9, *k, " Scrape_Failed "), (D1, 3, "u?x", *k[1:], "available"), (D2, 4, *k, None)], f"snapshot_date date, presence_id long, {key}, availability_status string")
    nan = float("nan")
    offers = spark.createDataFrame(
        [(D1, *k, 5.0), (D1, "u#y", *k[1:], 4.0), (D1, *k, nan), (D1, *k, -1.0), (D1, *k, 0.0), (D1, *k, None), (D2, "other", *k[1:], 3.0)], f"snapshot_date date, {key}, price_per_night double"
    )
    hash_of = spark.range(1).select(F.xxhash64(F.lit("scrape_failed"))).first()[0]
    got = {(r["snapshot_date"], r["status_hash"], r["price"]) for r in presence_records(seen, offers).collect()}
    assert got == {(D1, hash_of, 4.0), (D2, None, None)}
    assert presence_records(seen.limit(0), offers).columns == ["snapshot_date", *WINDOW_KEY, "status_hash", "price"]
