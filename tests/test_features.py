import math
from datetime import date

from nightledger.operators import features as fe
from nightledger.operators import runs
from nightledger.operators.design import fit_booster, fit_contract
from pyspark.sql import functions as F

D = date(2031, 7, 5)


def test_wide_offers_reconcile_and_precedence(spark):
    offers = spark.createDataFrame(
        [(1, "u", "111", "Studio", "2031-07-05", "Breakfast included"), (2, "u", None, "Suite", "bad", "Non-refundable"), (3, "u", None, "Loft", None, None)],
        "line int, property_url string, room_id string, room_name string, checkin string, conditions_text string",
    )
    inventory = spark.createDataFrame([(1, "u", "222", "Suite"), (2, "u", "333", "Suite")], "line int, property_url string, room_id string, room_name string")
    rooms = spark.createDataFrame([(1, "u", "111", 20.0), (2, "u", "111", 25.0), (3, "u", "222", 30.0)], "line int, property_url string, room_id string, size double")
    props = spark.createDataFrame([(1, "u", 8.0, None), (2, "u", 9.0, 1.0)], "line int, property_url string, score double, size double")
    got = {r["line"]: r for r in fe.wide_offers(offers, rooms, props.drop("size"), inventory, "line").collect()}
    assert [got[k]["room_id"] for k in (1, 2, 3)] == ["111", "222", None]
    assert [got[k]["room_id_reconciled"] for k in (1, 2, 3)] == [False, True, False]
    assert [got[k]["size"] for k in (1, 2, 3)] == [25.0, 30.0, None] and got[3]["score"] == 9.0
    assert [got[k]["season"] for k in (1, 2, 3)] == ["peak", None, None] and got[1]["meal_plan"] == "breakfast"
    over = {r["line"]: r["size"] for r in fe.wide_offers(offers, rooms, props, inventory, "line").collect()}
    assert over == {1: 1.0, 2: 1.0, 3: 1.0}


def test_presence_takes_the_best_status(spark, rows):
    key = ["property_url", "lead_time_days"]
    offers = spark.createDataFrame([("a", 7), ("a", 7)], "property_url string, lead_time_days int")
    failures = spark.createDataFrame(
        [("a", 7, "selector_drift", "price_rows"), ("b", 7, "empty_availability", "price_rows"), ("b", 7, "blocked", "price_rows"), ("c", 7, "blocked", "room_inventory"), ("d", None, "blocked", "price_rows")],
        "property_url string, lead_time_days int, category string, stage string",
    )
    got = rows(fe.presence_of(offers, failures, key).select("property_url", "availability_status"))
    assert got == [("a", "available"), ("b", "no_available_offer"), ("d", "scrape_failed")]


def test_snapshot_history_places_and_candidates(spark, rows):
    d = spark.createDataFrame([(D, None, "x"), (None, D, "x"), (None, None, "20310705T01Z"), (None, None, "bad")], "b date, c date, r string")
    assert [x[0] for x in d.select(fe.snapshot_of("b", "c", "r")).collect()] == [D, D, D, None]
    w = spark.createDataFrame([(1, "u", None, None, None, None, 3), (2, "u", "N", "Villa", 1.0, 2.0, None)], "line int, property_url string, property_name string, property_type string, latitude double, longitude double, adults int")
    h = fe.history_offers(w, "line", "m").orderBy("line").collect()
    assert (h[0]["property_name"], h[0]["property_type"], h[0]["latitude"], h[0]["adults"], h[1]["adults"], h[0]["currency"]) == ("N", "Villa", 1.0, 3, 2, "EUR")
    poi = spark.createDataFrame(
        [(1, 35.5, 24.0, [("Beach", 300.0, "m"), ("beach bar", 1.2, "km"), ("Airport", 9.0, "km")]), (2, None, None, [("Sandy BEACH", 50.0, "m")]), (3, 35.5, 24.0, None)],
        "id int, lat double, lon double, nearby_poi array<struct<category:string,distance:double,unit:string>>",
    )
    km = {r["id"]: r["beach_km"] for r in fe.place_distances(poi, "lat", "lon", {"beach": [(35.6, 24.0)]}, {"beach": "beach"}).collect()}
    assert km[1] == 0.3 and km[2] == 0.05 and 11 < km[3] < 11.2
    found = spark.createDataFrame([(1, "u?x", "A"), (2, "u", "B"), (3, "v#y", "C"), (4, None, "D")], "line int, url string, name string")
    known = spark.createDataFrame([("v?z",), (None,)], "url string")
    assert rows(fe.candidates(found, known, "url", "line").select("url", "name")) == [("u", "A")]
    cov = spark.createDataFrame([(1, D, "m", 5.0), (2, D, "m", None), (3, None, "m", 1.0)], "line int, checkin date, market string, temp double")
    assert rows(fe.covariates_for(spark.createDataFrame([(D, "m"), (D, "n")], "checkin date, market string"), cov, "line").select("market", "cov_temp")) == [("m", None), ("n", None)]


def test_runs(spark, rows):
    reg = spark.createDataFrame(
        [("r1", "completed", "2031-07-01T00:00:00", {"room_inventory": 5, "property_features": 2}), ("r2", "completed", "2031-07-03T00:00:00", {"room_inventory": 0, "property_features": 2}), ("r3", "memory_halt", "2031-07-04T00:00:00", {"room_inventory": 5, "property_features": 5}), ("r4", None, None, None)],
        "run_id string, status string, finished_at string, artifact_counts map<string,int>",
    )
    assert rows(runs.freshness(reg, date(2031, 7, 8))) == [("r1", 7, False)]
    assert rows(runs.freshness(reg, date(2031, 7, 9))) == [("r1", 8, True)]
    assert rows(runs.freshness(reg.limit(0), D)) == [(None, None, True)]
    assert runs.register(reg, reg.where("run_id = 'r1'")).count() == 4
    fails = spark.createDataFrame([("r", "drift", "http://x/chal_t", None), ("r", "drift", None, "net::ERR_ABORTED"), ("r", None, None, None)], "run_id string, category string, final_url string, message string")
    assert rows(runs.failure_rollup(fails)) == [("r", None, 1, 0, 0), ("r", "drift", 2, 1, 1)]
    t = spark.createDataFrame([("u",), ("v",)], "property_url string")
    w = spark.createDataFrame([(7, 1), (7, 4)], "lead_time_days int, stay_length_days int")
    priced = spark.createDataFrame([("u", 7, 1)], "property_url string, lead_time_days int, stay_length_days int")
    failed = spark.createDataFrame([("u", 7, 4, "empty"), ("v", 7, 4, "timeout")], "property_url string, lead_time_days int, stay_length_days int, category string")
    assert rows(runs.pending(t, w, priced, failed, ["empty"])) == [("v", 2)]
    meta = spark.createDataFrame([("r1", "2031-07-01"), ("r2", None)], "run_id string, search_base_date string")
    lines = spark.createDataFrame([("r2", 1, None, 3), ("r2", 2, D, 4), ("r3", 1, D, 5)], "run_id string, line int, checkin date, lead_time_days int")
    assert rows(runs.search_base_date(meta, lines)) == [("r1", date(2031, 7, 1)), ("r2", date(2031, 7, 1)), ("r3", date(2031, 6, 30))]


def test_matrix_contract_and_booster(spark):
    df = spark.range(0, 240).select(
        (F.col("id") % 12).cast("string").alias("u"),
        F.when(F.col("id") % 9 > 0, (F.col("id") % 7).cast("double")).alias("size"),
        F.element_at(F.array(F.lit("Villa"), F.lit(" Hotel"), F.lit(None)), (F.col("id") % 3 + 1).cast("int")).alias("kind"),
        F.when(F.col("id") % 2 == 0, F.array(F.lit("pool"))).alias("tags"),
        F.exp(4 + (F.col("id") % 7) * 0.1 + (F.col("id") % 2) * 0.3).alias("price"),
    )
    c = fit_contract(df, ["size"], ["kind"], "tags", 25)
    assert list(c.columns()) == ["size", "size_missing", "kind__Hotel", "kind__Villa", "token__pool"]
    b = fit_booster(df, "price", "u", ["size"], ["kind"], "tags", folds=3, maxIter=5)
    assert b.scores["r2_log"] > 0.5 and b.lower <= b.upper
    out = b.predict(df.limit(5), ["u"]).collect()
    assert len(out) == 5 and all(0 < r["low"] <= r["high"] for r in out)


def _offers(spark):
    n = F.col("id")
    return spark.range(0, 400).select(
        (n % 20).cast("string").alias("u"), (n % 7).cast("double").alias("size"), F.element_at(F.array(F.lit("Villa"), F.lit("Hotel")), (n % 2 + 1).cast("int")).alias("kind"),
        F.when(n % 3 == 0, F.array(F.lit("pool"))).alias("tags"), F.exp(4 + (n % 7) * 0.1 + (n % 2) * 0.3 + (n % 11) * 0.01).alias("price"),
    )


def test_search_and_bake_off(spark):
    from nightledger.operators import search

    space = {"maxDepth": [2, 3], "maxIter": [2, 4]}
    assert len(search.sample_configs(space, 9, 1)) == 4 and search.sample_configs(space, 2, 1) == search.sample_configs(space, 2, 1)
    assert search.better({"mae": 1.0, "r2_log": 0.1}, {"mae": 2.0, "r2_log": 0.9}) and search.better({"mae": 1.0, "r2_log": 0.5}, {"mae": 1.0, "r2_log": 0.4})
    winner, board = search.bake_off(_offers(spark), "price", "u", ["size"], ["kind"], "tags", [25], {"boosted": {"maxDepth": [3], "maxIter": [3]}, "forest": {"maxDepth": [1], "numTrees": [2]}}, 1, folds=3)
    assert winner["family"] == "boosted" and [b["metrics"]["mae"] for b in board] == sorted(b["metrics"]["mae"] for b in board) and board[0]["metrics"]["folds"] == 3


def test_quantile_tree_covers(spark):
    from nightledger.operators import search

    df = _offers(spark)
    tree = search.fit_quantile_tree(df, "price", ["size"], ["kind"], coverage=0.8)
    got = tree.predict(df, ["price"]).agg(F.avg((F.col("price").between(F.col("low") - 1e-9, F.col("high") + 1e-9)).cast("int")).alias("share"), F.count("low").alias("n")).first()
    assert got["n"] == 400 and 0.7 <= got["share"] <= 0.95


def test_counterfactual_prices(spark):
    from nightledger.operators import search
    from nightledger.operators.design import fit_booster

    df = _offers(spark)
    b = fit_booster(df, "price", "u", ["size"], ["kind"], "tags", folds=3, maxIter=8)
    client = {"size": 6.0, "kind": "Hotel", "unknown": 1}
    peer = df.where("size = 0 and kind = 'Villa'").limit(5)
    out = search.adjusted_prices(b, peer, client, "price", ["u", "price"]).collect()
    assert len(out) == 5 and all(1.5 < r["factor"] <= 2.0 and abs(r["adjusted"] - r["price"] * r["factor"]) < 1e-9 for r in out)
    same = search.adjusted_prices(b, df.where("size = 6 and kind = 'Hotel'").limit(3), client, "price", ["u"]).collect()
    assert all(abs(r["factor"] - 1) < 1e-9 for r in same)
    for r in search.price_gaps(b, peer, client, 150.0, "price", ["u"]).collect():
        assert abs(r["gap"] - r["explained"] - r["residual"]) < 1e-9
    moves = {r["feature"]: r["contribution"] for r in search.gap_drivers(b, peer, client).collect()}
    whole = search.adjusted_prices(b, peer.limit(1), client, "price", ["u"], None).first()["factor"]
    assert set(moves) == {"size", "kind"} and abs(math.exp(sum(moves.values())) - whole) < 1e-6
