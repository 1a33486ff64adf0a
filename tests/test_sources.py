import json

import pytest
from nightledger.operators.relational import upsert
from nightledger.sources import files, html
from nightledger.streaming.history import run_once, upsert_stream, windowed_counts
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])


def test_json_lines_with_issues(spark, tmp_path, rows):
    (tmp_path / "x.jsonl").write_text('{"a": 1, "b": "é"}\n\n  \n{"a": 2\n[1, 2]\n{"a": 3, "c": 1}\n"text"\n')
    records, issues = files.read_json_lines(spark, str(tmp_path / "x.jsonl"), SCHEMA)
    assert rows(records) == [(1, "é"), (3, None)]
    assert sorted(r["message"] for r in issues.collect()) == ["the line can't be parsed", "the line is no object", "the line is no object"]
    assert sorted((r["line"], r["text"]) for r in issues.collect()) == [(4, '{"a": 2'), (5, "[1, 2]"), (7, '"text"')]
    with pytest.raises(ValueError, match="x.jsonl:4: the line can't be parsed"):
        files.read_json_lines(spark, str(tmp_path / "x.jsonl"), SCHEMA, strict=True)
    assert [d.count() for d in files.read_json_lines(spark, str(tmp_path / "no.jsonl"), SCHEMA, strict=True)] == [0, 0]
    none, gone = files.read_json_lines(spark, str(tmp_path / "no.jsonl"), SCHEMA)
    assert none.count() == 0 and gone.first()["message"] == "the file is missing"
    files.write_json_lines(records, str(tmp_path / "out"))
    files.write_json_lines(records, str(tmp_path / "out"), append=True)
    again, bad = files.read_json_lines(spark, str(tmp_path / "out"), SCHEMA)
    assert again.count() == 4 and bad.count() == 0


def test_csv_and_missing_tables(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, "x,y"), (2, None)], SCHEMA)
    files.write_csv(df, str(tmp_path / "c"))
    assert rows(files.read_csv_text(spark, str(tmp_path / "c"), ["a", "b"])) == [("1", "x,y"), ("2", None)]
    assert files.read_csv_text(spark, str(tmp_path / "d"), ["a"]).columns == ["a"]
    empty, status = files.read_or_empty(spark, str(tmp_path / "p"), SCHEMA)
    assert (empty.count(), empty.columns, status) == (0, ["a", "b"], "missing")


def test_nested_round_trip(spark):
    df = spark.createDataFrame([({"b": 1, "a": 2}, ["x", None], (1, "s")), (None, None, None)], "m map<string,int>, l array<string>, s struct<i:int,t:string>")
    text = files.encode_nested(df)
    assert json.loads(text.first()["m"]) == {"a": 2, "b": 1} and text.first()["m"].index("a") < text.first()["m"].index("b")
    back = files.decode_nested(text, {f.name: f.dataType for f in df.schema.fields})
    assert back.collect() == df.collect()
    with pytest.raises(Exception, match="m holds invalid JSON"):
        files.decode_nested(text.withColumn("m", F.lit("{oops")), {"m": df.schema["m"].dataType}).collect()


def test_versions_and_streamed_upsert(spark, tmp_path, rows):
    t = files.BucketedTable(spark, str(tmp_path / "t"), ["a"], SCHEMA, 4)
    assert t.read().count() == 0
    source = tmp_path / "in"
    for n, data in enumerate(([(1, "x"), (2, "x")], [(1, "y")], [(1, "y")])):
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(str(source))
        q = upsert_stream(spark.readStream.schema(SCHEMA).parquet(str(source)), t, [], str(tmp_path / "cp"))
        q.awaitTermination()
    assert rows(t.read()) == [(1, "y"), (2, "x")]
    assert t.rewrite(spark.createDataFrame([(2, "z")], SCHEMA), lambda old, new: upsert(old, new, ["a"])) == 1
    assert rows(t.read()) == [(1, "y"), (2, "z")] and t.rewrite(spark.createDataFrame([], SCHEMA), lambda old, new: new) == 0
    t = files.VersionedTable(spark, str(tmp_path / "v"))
    for n in range(4):
        t.write(spark.createDataFrame([(n, "z")], SCHEMA))
    assert rows(t.read(SCHEMA)) == [(3, "z")] and sorted(p.name for p in (tmp_path / "v" / "current").iterdir() if p.name.isdigit()) == ["3", "4"]
    t.write(upsert(t.read(SCHEMA), spark.createDataFrame([(9, "z")], SCHEMA), ["a"]))
    assert t.read(SCHEMA).count() == 2


def test_stream_equals_batch(spark, tmp_path, rows):
    df = spark.range(0, 500).select(F.timestamp_seconds(F.col("id") * 613).alias("ts"), (F.col("id") % 3).cast("string").alias("kind"), F.col("id").cast("double").alias("v"))
    df.write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "e"))
    make = lambda d: windowed_counts(d, "ts", "kind", "v", "1 day", "1 hour")
    assert rows(run_once(make(stream))) == rows(make(df))


def test_broken_html(spark, rows):
    page = "<p>One<script>no</script> <b>Two’s<p>Three &amp; four</div><style>x"
    df = spark.createDataFrame([(1, page), (2, None), (3, "<a href='/x?q'>A <i>b</i></a><a href='/x#z'>B</a><a>c</a><a href=/y>D")], "id int, html string")
    got = {r["id"]: r["t"] for r in html.visible_text(df, "html", "t").collect()}
    assert got[2] is None and got[1].startswith("one") and "no" not in got[1].split()
    assert rows(html.links(df, "id", "html").select("page", "position", "href", "text")) == [(3, 1, "/x", "A b")]


def test_rooms_of_a_page(spark, rows):
    page = "<a href='#RD12'> </a><a href='#RD12'>Double <b>Room</b></a><a href='#RD7'>Studio</a><a href='#RD12'>Again</a><a href='#RDx'>x</a><a href='/p#RD9'>other page</a><a href='#map'>Map</a>"
    df = spark.createDataFrame([(1, page), (2, None), (3, "<a href='#RD7'>Suite</a>")], "id int, html string")
    assert rows(html.room_inventory(df, "id", "html")) == [(1, 1, "12", "Double Room"), (1, 2, "7", "Studio"), (3, 1, "7", "Suite")]
    assert [r[2] for r in rows(html.links(df.where("id = 1"), "id", "html"))] == ["#RD12", "#RD7", "#RDx", "/p", "#map"]


def test_run_folders(spark, tmp_path, rows):
    from nightledger.sources import runs

    root = str(tmp_path / "runs")
    assert runs.latest_run(spark, root) is None
    for name in ("20310601T1", "20310602T1", "20310603T1"):
        (tmp_path / "runs" / name).mkdir(parents=True)
    (tmp_path / "runs" / "20310602T1" / "rooms.jsonl").write_text('{"a": 1, "b": "x"}\nno\n')
    assert runs.latest_run(spark, root) == "20310603T1" and runs.latest_run(spark, root, "rooms.jsonl") == "20310602T1"
    tables, issues = runs.read_run(spark, f"{root}/20310602T1", {"rooms": SCHEMA, "gone": SCHEMA})
    assert rows(tables["rooms"]) == [(1, "x")] and tables["gone"].count() == 0
    assert sorted((r["line"] or 0, r["message"]) for r in issues.collect()) == [(0, "the file is missing"), (2, "the line is no object")]
    assert rows(runs.read_registry(spark, f"{root}/20310602T1/rooms.jsonl", SCHEMA)) == [(1, "x")]
    runs.write_document(spark, f"{root}/meta.json", {"b": "é", "a": 1})
    assert runs.read_document(spark, f"{root}/meta.json") == {"a": 1, "b": "é"} and runs.read_document(spark, f"{root}/no.json", {}) == {}
    assert rows(runs.client_profile(spark, {"a": 5, "z": 1}, SCHEMA)) == [(5, None)]


def test_line_numbers_over_splits(spark, tmp_path):
    path = tmp_path / "long.jsonl"
    path.write_text("".join(('{"a": %d}\n' % i) if i % 1000 else "oops\n" for i in range(1, 20001)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        _, issues = files.read_json_lines(spark, str(path), SCHEMA)
        assert sorted(r["line"] for r in issues.collect()) == list(range(1000, 20001, 1000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_artifacts_in_the_order_of_targets(spark, tmp_path, rows):
    from nightledger.sources import runs

    for name, text in (("b", '{"a": 1, "b": "x"}\n{"a": 2\n\n{"a": 3}\n'), ("a", '{"a": 4}\n'), ("broken", "no\n"), ("unlisted", '{"a": 9}\n')):
        (tmp_path / name).mkdir()
        (tmp_path / name / "rows.jsonl").write_text(text)
    root = str(tmp_path)
    got = runs.read_artifacts(spark, root, ["b", "gone", "broken", "a"], "rows.jsonl", SCHEMA)
    assert rows(got) == [(1, "b", 1, 1, "x"), (1, "b", 4, 3, None), (4, "a", 1, 4, None)]
    assert rows(runs.read_artifacts(spark, root, ["gone"], "rows.jsonl", SCHEMA)) == []
    runs.rebuild_stream(spark, root, ["b", "a"], "rows.jsonl", SCHEMA, str(tmp_path / "all"))
    assert [r["a"] for r in spark.read.schema(SCHEMA).json(str(tmp_path / "all")).collect()] == [1, 3, 4]
