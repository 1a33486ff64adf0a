import math

import pytest
from nightledger.functions import offers as fo
from nightledger.functions import pages as fp
from nightledger.operators import quantiles, relational, summaries
from nightledger.operators import validation as val
from nightledger.sources import html
from pyspark.sql import functions as F


def test_availability_states(spark):
    on, off, failed = fo.STATUS_PRIORITY
    cases = {
        (on, on): "available", (off, on): "newly_available", (on, off): "disappeared", (off, off): "still_unavailable", (failed, on): "unknown", (on, failed): "unknown",
        (None, on): "unknown", (on, None): "unknown", ("other", on): "unknown", (on, "other"): "unknown", (None, None): "unknown",
    }
    df = spark.createDataFrame([(b, n, want) for (b, n), want in cases.items()], "b string, n string, want string")
    assert df.where(fo.availability_state(F.col("n"), F.col("b")) != F.col("want")).count() == 0


def test_quality_phrases_stand_in_one_token(spark):
    df = spark.createDataFrame([(["private", "entrance", None],), (["a private entrance here"],), (None,), ([],), (["carpool", "pools"],)], "t array<string>")
    flags = fo.quality_flags("t")
    got = [(r["hq__private_entrance"], r["hq__pool"]) for r in df.select(*[c.alias(n) for n, c in flags.items()]).collect()]
    assert got == [(0, 0), (1, 0), (0, 0), (0, 0), (0, 0)]


def test_quantiles_of_a_group_that_spans_tasks(spark):
    import statistics

    values = [((i * 7919) % 10007) / 7 for i in range(20000)]
    df = spark.createDataFrame([("hot", v) for v in values] + [("small", 1.0), ("small", 2.0), (None, 5.0), ("none", math.nan), ("none", None)], "g string, v double").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        counts = df.where("v is not null and not isnan(v)").groupBy("g", F.col("v").alias("value")).agg(F.count("*").alias("n"))
        spread = quantiles.cumulative_counts(counts, ["g"]).where("g = 'hot'")
        assert spread.agg(F.max("upto")).first()[0] == 20000
        got = {r["g"]: (r["n"], r["median"]) for r in quantiles.medians(df, ["g"], F.col("v")).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got["hot"] == (20000, pytest.approx(statistics.median(values))) and got["small"] == (2, 1.5) and got[None] == (1, 5.0) and "none" not in got


def test_carrying_a_value_over_tasks(spark, rows):
    data = [("k", i, "x" if i == 0 else "y" if i == 2500 else None) for i in range(5000)] + [("l", 1, None)]
    df = spark.createDataFrame(data, "k string, t int, s string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = relational.carry_forward(df, ["k"], "t", ["s"])
        assert got.groupBy("k", "s").count().collect() and {tuple(r) for r in got.groupBy("k", "s").count().collect()} == {("k", "x", 2500), ("k", "y", 2500), ("l", None, 1)}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_profiles_of_dirty_rows(spark, rows):
    schema = "u string, property_name string, property_type string, room_id string, latitude double, longitude double, price_per_night double, c long"
    data = [("a", " N ", "t", "1", 1.0, math.nan, 10.0, 0), ("a", "N", " ", "1", 3.0, None, 30.0, 0), ("a", "M", None, None, None, None, math.nan, 0), (None, "x", "x", "1", 1.0, 1.0, 1.0, 0), (" ", "x", "x", "1", 1.0, 1.0, 1.0, 0), ("b", None, None, None, None, None, None, 0)]
    got = summaries.profiles(spark.createDataFrame(data, schema), "u")
    cols = ["u", "offer_rows", "distinct_rooms", "property_name", "property_type", "median_latitude", "median_longitude", "median_price_per_night"]
    assert rows(got.select(*cols)) == [("a", 3, 1, "N", "t", 2.0, None, 20.0), ("b", 1, 0, None, None, None, None, None)]
    assert rows(summaries.profiles(spark.createDataFrame([], schema), "u")) == []


def test_run_checks(spark, rows):
    inventory = spark.createDataFrame([(1, "u", "1", "a"), (2, "u", "1", "b"), (3, "u", " ", None), (4, None, "1", "c"), (5, "u", "1", "d")], "n int, property_url string, room_id string, room_name string")
    assert rows(val.issue_counts(val.inventory_issues(inventory, "n"))) == [("room_inventory_duplicates", 2), ("room_inventory_fields", 2)]
    prices = spark.createDataFrame(
        [(1, "d", "d", 2, "t", "1", "a", 100.0, 50.0, "EUR 100"), (2, None, "d", 2, "t", None, " ", 0.0, 50.0, "EUR 0"), (3, "d", "d", 3, "t", None, "a", 100.0, 33.33, None), (4, "d", "d", 0, "t", "1", "a", -5.0, math.nan, None)],
        "n int, checkin string, checkout string, stay_length_days int, captured_at string, room_id string, room_name string, current_price_value double, price_per_night double, current_price_text string",
    )
    found = val.issues(prices, val.price_row_rules(F.col("current_price_text")), F.col("n"))
    assert rows(found.select("check", "location")) == [("price_per_night_consistency", "2"), ("price_row_fields", "2"), ("price_row_positive_price", "2"), ("price_row_room_identity", "2")]
    assert rows(val.run_report(found)) == [(4, 4, False)] and rows(val.run_report(found.limit(0))) == [(0, 0, True)]
    features = spark.createDataFrame([(1, "u", "1", 0.0, 31, -1), (2, "u", "1", 1000.0, 30, 0), (3, "u", None, None, None, None), (4, "u", "2", math.nan, 0, 1)], "n int, property_url string, room_id string, room_size_sqm double, max_persons int, bed_count int")
    assert rows(val.issue_counts(val.room_feature_issues(features, "n"))) == [("room_feature_bounds", 4), ("room_feature_duplicates", 1), ("room_feature_room_id", 1)]
    props = spark.createDataFrame([(1, "u", 0.0, 10.0, {"a": 11.0, "b": 5.0}, [(-1.0,)]), (2, "u", 5.5, -0.1, None, None), (3, None, None, math.nan, {}, [])], "n int, property_url string, star_rating double, review_score double, review_subscores map<string,double>, nearby_poi array<struct<distance: double>>")
    assert rows(val.issue_counts(val.property_feature_issues(props, "n"))) == [("property_feature_bounds", 5), ("property_feature_duplicates", 1), ("property_feature_property_url", 1)]
    failures = spark.createDataFrame([(1, "drift", "a.html"), (2, " ", "b.html"), (3, None, None)], "n int, category string, snapshot_filename string")
    assert rows(val.issue_counts(val.failure_issues(failures, spark.createDataFrame([("a.html",)], "name string"), "n"))) == [("failure_category", 2), ("failure_snapshot_exists", 1)]


def test_files_of_a_run(spark, tmp_path):
    (tmp_path / "price_rows.jsonl").write_text("")
    gone = [r["location"].rsplit("/", 1)[1] for r in val.file_issues(spark, str(tmp_path)).collect()]
    assert gone == ["room_inventory.jsonl", "failures.jsonl", "scrape_debug.log"]
    assert val.file_issues(spark, str(tmp_path / "none")).count() == 4


def test_page_failures(spark):
    long = "hotel guest reviews " + "x" * 600
    asked = "https://h.example/p/1?q"
    cases = [
        ("captcha", asked, 1, 0, 200, None), ("Verify you’re human", asked, 0, 0, 200, "blocked_challenge"), (long, asked, 0, 0, 403, "blocked_challenge"), (long, asked, 0, 0, 502, "temporary_booking_error"),
        (long, "https://other.example/p/1", 0, 0, 200, "redirect"), (long, "https://H.example/p/1/#x", 0, 0, None, "selector_drift"), (long + " Sold out", None, 0, 0, None, "empty_availability"),
        (long + " bad gateway", asked, 0, 0, None, "temporary_booking_error"), ("short", asked, 0, 0, 200, "partial_load"), (None, None, 0, 0, None, "partial_load"), ("x" * 600, asked, 0, 2, 200, "selector_drift"), ("x" * 600, asked, 0, 0, 200, "partial_load"),
    ]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, t string, final string, expected int, fallback int, status int, want string")
    got = fp.page_failure(fp.page_text("t"), F.col("final"), F.lit(asked), F.col("expected"), F.col("fallback"), F.col("status"))
    bad = df.withColumn("got", got).where(~F.col("got").eqNullSafe(F.col("want"))).collect()
    assert bad == []


def test_listing_cards(spark, rows):
    card = "<div data-testid='property-card'><a href='{}' data-testid='title-link'><div data-testid='title'>{}</div></a><div data-testid='review-score'>8,7 <i>Superb</i></div></div>"
    page = card.format("https://h.example/hotel/gr/a.html?label=1", "A &amp;  B") + card.format("https://h.example/hotel/gr/a.html", "again") + card.format("/x", "none") + card.format("https://h.example/hotel/gr/b.html", " ")
    df = spark.createDataFrame([(1, page), (2, None), (3, "<div data-testid='property-card'>")], "id int, html string")
    assert rows(html.listings(df, "id", "html")) == [(1, 1, "A & B", "https://h.example/hotel/gr/a.html", None, "8,7 Superb", None)]


def test_offers_carry_their_room(spark, rows):
    row = "<tr class='js-rt-block-row x' data-block-id='{}'>{}<td><span class='bui-price-display__value'>EUR {}</span></td><td><select><option>1</option><option>2</option></select></td></tr>"
    room = "<th class='hprt-table-cell-roomtype'><a class='hprt-roomtype-link' data-room-id='77'>Big <b>Room</b></a><span class='only_x_left'>Only 2</span></th>"
    page = "<table>" + row.format("55_1", "", "90") + row.format("77_1", room, "100") + row.format("77_2", "", "120") + "<tr><td>other</td></tr></table>"
    df = spark.createDataFrame([(1, page), (2, None)], "id int, html string")
    got = html.price_rows(df, "id", "html").select("position", "room_id", "room_name", "block_id", "current_price_text", "original_price_text", "scarcity_text", "quantity_options").collect()
    assert [tuple(r) for r in got] == [
        (1, "55", None, "55_1", "EUR 90", None, None, ["1", "2"]), (2, "77", "Big Room", "77_1", "EUR 100", None, "Only 2", ["1", "2"]), (3, "77", "Big Room", "77_2", "EUR 120", None, "Only 2", ["1", "2"]),
    ]


def test_room_features(spark):
    row = "<tr class='js-rt-block-row' data-block-id='{}'>{}<td class='hprt-table-cell-occupancy'>{}</td></tr>"
    room = "<th class='hprt-table-cell-roomtype'><a class='hprt-roomtype-link' {}>{}</a><span class='rt-bed-type'>2 single beds</span><span class='rt-bed-type'>1 sofa bed</span><ul><li class='hprt-facilities-facility'>Balcony</li><li class='hprt-facilities-facility x'>25,5 m²</li></ul></th>"
    page = "<table>" + row.format("9_1", room.format("data-room-id='7'", "Junior Suite with View"), "Sleeps: 2 - 4 guests") + row.format("7_2", "", "x") + row.format("8_1", "<th class='hprt-table-cell-roomtype'></th>", "Max persons: 3") + row.format("7_9", room.format("data-room-id='7'", "Again"), "") + row.format("none", "<th class='hprt-table-cell-roomtype'></th>", "") + "</table>"
    df = spark.createDataFrame([(1, page), (2, None)], "id int, html string")
    got = {r["room_id"]: r for r in html.room_features(df, "id", "html").collect()}
    assert set(got) == {"7", "8"}
    a, b = got["7"], got["8"]
    assert (a["room_name"], a["room_size_sqm"], a["bed_types"], a["bed_count"], a["max_persons"], a["amenities"], a["room_class"]) == ("Junior Suite with View", 25.5, ["2 single beds", "1 sofa bed"], 3, 4, ["Balcony", "25,5 m²"], "Junior Suite")
    assert (b["room_size_sqm"], b["bed_types"], b["bed_count"], b["max_persons"], b["amenities"], b["room_class"]) == (None, None, None, 3, None, None)


def test_property_features(spark):
    page = """<i data-testid='rating-squares' aria-label='4.5 out of 5'></i><a data-atlas-latlng='35.5,24.0'>map</a><div data-testid='breadcrumb-current'>Villa (old) Rosa (Bed  and Breakfast) (Greece) deals</div>
    <div data-testid='review-score-right-component'>Scored <b>9.1</b> 9.1 Superb 1,242 reviews</div><div data-testid='review-subscore'>Free WiFi 10</div><div data-testid='review-subscore'>Location</div><div data-testid='review-subscore'>Comfort 8.5</div>
    <div data-testid='facility-group-container'><h3>Food</h3><ul><li>Bar</li><li> </li><li>Grill</li></ul></div><div data-testid='facility-group-container'><h3>Languages spoken here</h3><ul><li>Greek</li></ul></div>
    <div data-testid='poi-block'><h3>Beaches</h3><ul><li>Nea Chora 1,200 m</li><li>Far Beach 3.5 KM</li><li>nowhere</li></ul></div><div data-testid='property-section--content'>other</div>
    <div data-testid='property-section--content'>Check-in From 14:00 to 23:30 Check-out From 7:00 to 11:00 Cancellation/ prepayment Varies by room Children welcome</div><button data-testid='gallery-cta-count'>+1,048 photos</button>"""
    df = spark.createDataFrame([(1, page), (2, None), (3, "<a data-atlas-latlng='x,1'><i data-testid='rating-stars' aria-label='9 stars'>")], "id int, html string")
    got = {r["page"]: r.asDict(True) for r in html.property_features(df, "id", "html").collect()}
    assert got[1] == {
        "page": 1, "star_rating": 4.5, "review_score": 9.1, "review_count": 1242, "review_subscores": {"Free WiFi": 10.0, "Comfort": 8.5}, "latitude": 35.5, "longitude": 24.0, "property_type": "Bed and breakfast",
        "property_facilities": ["Bar", "Grill"], "languages_spoken": ["Greek"],
        "nearby_poi": [{"poi_name": "Nea Chora", "distance": 1200.0, "unit": "m", "category": "Beaches"}, {"poi_name": "Far Beach", "distance": 3.5, "unit": "km", "category": "Beaches"}],
        "checkin_from": "14:00", "checkin_until": "23:30", "checkout_from": "7:00", "checkout_until": "11:00", "house_rules": {"cancellation": "Varies by room"}, "photo_count": 1048, "sustainability_level": None,
    }
    assert all(v is None for k, v in got[2].items() if k != "page") and all(v is None for k, v in got[3].items() if k != "page")
