import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.operators import quality as Q
from recordloom.operators.merge import Sources
from recordloom.plans import models
from recordloom.plans import presets as P
from recordloom.plans.loads import LoadJob, run_load, run_loads, run_pipeline
from recordloom.session import checkpoint_root, drop_staged, path_exists, stage
from recordloom.sources import feeds as R
from recordloom.sources import tables as S

HEADER = ",".join(P.FLAT_COLUMNS)


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_delimited_feed(spark, tmp_path):
    text = (
        "name,id,x\n"
        '"Smith, ""Joe""",1,1.5\n'
        '"two\nlines",2,NA\n'
        "None,3,abc\n"
        "null,4,\n"
    )
    got = R.read_delimited(
        spark,
        write(tmp_path / "f.csv", text),
        T.StructType.fromDDL("id string, name string, x double"),
    )
    assert [tuple(r) for r in got.orderBy("id").collect()] == [
        ("1", 'Smith, "Joe"', 1.5), ("2", "two\nlines", None), ("3", None, None), ("4", None, None),
    ]


def test_delimited_feed_lacking_columns(spark, tmp_path):
    with pytest.raises(Q.CheckError, match=r"missing required columns \['latitude'\]"):
        R.read_delimited(
            spark, write(tmp_path / "f.csv", HEADER.replace(",latitude", "") + "\n"), P.FLAT_SCHEMA
        )


def nested_record(i, **more):
    address = {"street": "1 St", "city": "X", "state": "OR", "postalCode": "97201",
               "country": "United States", "latitude": 1.0, "longitude": 2.0}
    return {"Id": str(i), "Name": f"n{i}", "Brewery_Type__c": "Micro", "Is_Craft_Brewery__c": True,
            "BillingAddress": address, **more}


def test_json_array_and_landing(spark, tmp_path):
    source = write(
        tmp_path / "in.json",
        json.dumps([nested_record(1), nested_record(2, BillingAddress=None)], indent=4),
    )
    reads = []

    def read():
        reads.append(1)
        return R.read_json_records(spark, source, P.NESTED_SCHEMA)

    landed = str(tmp_path / "landed")
    first = R.read_or_land(spark, landed, P.NESTED_SCHEMA, read)
    second = R.read_or_land(spark, landed, P.NESTED_SCHEMA, read)
    assert len(reads) == 1
    assert sorted(first.collect()) == sorted(second.collect()) and first.count() == 2
    assert second.filter("BillingAddress IS NULL").count() == 1


def test_unreadable_landed_copy_is_an_error(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    write(landed / "part.json", "{broken")
    write(landed / "_SUCCESS", "")
    with pytest.raises(Exception):
        R.read_or_land(spark, str(landed), P.NESTED_SCHEMA, lambda: pytest.fail("reloaded")).collect()


def test_table_may_be_replaced_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    assert S.replace_table(spark.range(5), path)["rows"] == 5
    assert S.replace_table(S.read_table(spark, path).filter("id > 1"), path)["rows"] == 3
    assert S.read_table(spark, path).count() == 3
    assert len([p for p in (tmp_path / "t").iterdir() if not p.name.startswith(".")]) == 1  # the old version is gone


@pytest.mark.parametrize("fault", ["write", "accept", "commit"])
def test_a_failed_replacement_leaves_the_old_table(spark, tmp_path, monkeypatch, fault):
    path = str(tmp_path / "t")
    S.replace_table(spark.range(5), path)

    def fail(*_):
        raise OSError("lost")

    broken = spark.range(9).withColumn("id", F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("bad row"))))
    if fault == "commit":
        monkeypatch.setattr(S, "create_file", fail)
    with pytest.raises(Exception):
        S.replace_table(broken if fault == "write" else spark.range(9), path, accept=fail if fault == "accept" else None)
    monkeypatch.undo()
    assert S.read_table(spark, path).count() == 5
    assert S.replace_table(spark.range(7), path)["rows"] == 7 and S.read_table(spark, path).count() == 7


def test_a_version_that_was_never_accepted_does_not_count(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(f"{path}/version-000000001")  # a writer that died
    with pytest.raises(FileNotFoundError):
        S.read_table(spark, path)
    S.replace_table(spark.range(4), path)
    spark.range(3).write.parquet(f"{path}/version-000000009")
    assert S.read_table(spark, path).count() == 4


def test_the_last_versions_stay_for_their_readers(spark, tmp_path):
    path = str(tmp_path / "t")
    S.replace_table(spark.range(3), path)
    before = S.read_table(spark, path)
    S.replace_table(spark.range(4), path, keep=2)
    assert before.count() == 3 and S.read_table(spark, path).count() == 4
    S.replace_table(spark.range(5), path)
    assert [p.name for p in tmp_path.joinpath("t").iterdir()] == ["version-000000003"]


def test_files_with_differing_headers_match_by_name(spark, tmp_path):
    write(tmp_path / "a b.csv", 'id,name,x\n1,"a\nb",1.5\n')
    write(tmp_path / "c.csv", "name,x,id,more\nz,NA,2,q\n")
    write(tmp_path / "d.csv", "id,name,x\n")
    got = R.read_delimited(spark, str(tmp_path), T.StructType.fromDDL("id string, name string, x double"))
    assert sorted(tuple(r) for r in got.collect()) == [("1", "a\nb", 1.5), ("2", "z", None)]
    write(tmp_path / "e.csv", "id,x\n3,1\n")
    with pytest.raises(Q.CheckError, match="missing required columns"):
        R.read_delimited(spark, str(tmp_path), T.StructType.fromDDL("id string, name string, x double"))


def test_run_log(spark, tmp_path):
    log = str(tmp_path / "log")
    assert S.recent_runs(spark, log).collect() == []
    for i in range(3):
        S.log_run(spark, log, S.RunRecord("src", "tbl", i, "success", "note", at=dt.datetime(2024, 1, i + 1, tzinfo=dt.timezone.utc)))
    got = S.recent_runs(spark, log, 2).collect()
    assert [(r.source, r.table_name, r.row_count, r.status, r.note) for r in got] == [
        ("src", "tbl", 2, "success", "note"), ("src", "tbl", 1, "success", "note"),
    ]
    assert S.recent_runs(spark, log, 0).count() == 1


def test_older_log_without_later_columns(spark, tmp_path):
    log = str(tmp_path / "log")
    spark.createDataFrame(
        [(dt.datetime(2024, 1, 1), "s", "t", 1, "success", None)],
        "ts timestamp, source string, table_name string, row_count long, status string, note string",
    ).write.parquet(log)
    assert "metrics_json" not in S.recent_runs(spark, log).columns
    S.log_run(spark, log, S.RunRecord("s", "t", 2, "success", metrics={"row_count": 2}))
    assert [r.metrics_json for r in S.recent_runs(spark, log).collect()] == ['{"row_count": 2}', None]


def flat_rows(spark, **override):
    rows = [
        {"id": "1", "name": "a", "brewery_type": "micro", "address_1": "addr1", "city": "x", "state_province": "ca",
         "postal_code": "11111", "country": "us", "longitude": None, "latitude": 1.0},
        {"id": "2", "name": "b", "brewery_type": "regional", "address_1": "addr2", "city": "y", "state_province": "or",
         "postal_code": "22222", "country": "us", "longitude": -120.0, "latitude": None},
    ]
    full = [{**{c: None for c in P.FLAT_COLUMNS}, **r, **override} for r in rows]
    return spark.createDataFrame([tuple(r[c] for c in P.FLAT_COLUMNS) for r in full], P.FLAT_SCHEMA)


FLAT_CHECKS = Q.FeedChecks("flat feed", P.FLAT_COLUMNS, P.COORDINATE_COLUMNS, P.COORDINATE_COLUMNS)


def job(read):
    return LoadJob("flat_csv", "raw_flat", read, FLAT_CHECKS)


def test_load_and_bad_feed(spark, tmp_path):
    root, log = str(tmp_path), str(tmp_path / "log")
    assert run_load(spark, job(lambda s: flat_rows(s)), root, log) == 2
    bad = job(lambda s: flat_rows(s, latitude=None))
    with pytest.raises(Q.CheckError, match=r"columns entirely null \['latitude'\]"):
        run_load(spark, bad, root, log)
    with pytest.raises(Q.CheckError, match="no rows returned"):
        run_load(spark, job(lambda s: flat_rows(s).limit(0)), root, log)
    assert S.read_table(spark, f"{root}/raw_flat").filter("latitude = 1.0").count() == 1
    runs = S.recent_runs(spark, log).collect()
    assert [r.status for r in runs] == ["failed", "failed", "success"]
    assert runs[0].note == "flat feed: no rows returned" and runs[0].row_count == 0
    assert json.loads(runs[2].metrics_json) == {
        "row_count": 2, "null_pct_latitude": 0.5, "null_pct_longitude": 0.5,
    }
    assert runs[2].duration_seconds > 0


def test_checks(spark):
    df = spark.createDataFrame([(1, None, 3), (None, None, 4)], "a int, b int, c int")
    assert Q.FeedChecks("ctx", ["a", "b"], ["a", "absent"], ["a", "b", "absent"]).run(df) == {"null_pct_a": 0.5, "null_pct_b": 1.0}
    with pytest.raises(Q.CheckError, match=r"ctx: columns entirely null \['b'\]"):
        Q.FeedChecks("ctx", some_known=["a", "b"]).run(df)
    with pytest.raises(Q.CheckError, match=r"ctx: missing required columns \['d'\]"):
        Q.FeedChecks("ctx", ["d"]).run(df)
    with pytest.raises(Q.CheckError, match="ctx: no rows returned"):
        Q.FeedChecks("ctx", some_known=["a"]).run(df.limit(0))
    assert Q.FeedChecks("ctx", rates=["a"]).summary({"rows": 0, "known_a": 0}) == {"null_pct_a": 0.0}
    columns, rows = Q.look(df, 1)
    assert columns.count() == 3 and rows.count() == 1
    assert Q.accepted_values(df, "a", ["1"]).count() == 0
    assert Q.expression_is_true(df, "a > 5").count() == 1


def test_failed_data_test_stops_the_run(spark, tmp_path):
    tests = lambda f: [Q.DataTest("no_rows", f["raw_flat"])]
    with pytest.raises(Q.CheckError, match="no_rows"):
        run_pipeline(spark, [job(lambda s: flat_rows(s))], {}, tests, str(tmp_path), str(tmp_path / "log"))


def test_two_feeds_end_to_end(spark, tmp_path):
    flat = write(
        tmp_path / "flat.csv",
        HEADER + "\n"
        + "f1, Acme Ales ,micro,1 Oak St,,,Bend,Oregon,97701,United States,5415551234,,-121.3,44.0\n"
        + "f2,North Road Ales,bar,2 Oak St,,,Bend,Oregon,97701,United States,,http://n,-121.3,95\n"
        + "f3,Solo,nano,3 Oak St,,,Bend,Oregon,97701,United States,,,,\n",
    )
    address = {"street": "9", "city": "BEND", "state": "oregon", "postalCode": "1", "country": " United States "}
    nested = write(
        tmp_path / "nested.json",
        json.dumps([
            nested_record("m1", Name="acme ales", BillingAddress=address, Phone="+1999", Website="http://m1"),
            nested_record("m2", Name="North Road Ale", BillingAddress=address, Phone="+1888"),
            nested_record("m3", Name="Else", BillingAddress=address),
            nested_record("m4", Name="Solo", BillingAddress=address, Brewery_Type__c="Beer Brand"),
        ]),
    )
    jobs = [
        LoadJob("flat_csv", "raw_flat", lambda s: R.read_delimited(s, flat, P.FLAT_SCHEMA), FLAT_CHECKS),
        LoadJob("nested_json", "raw_nested", lambda s: R.read_json_records(s, nested, P.NESTED_SCHEMA), Q.FeedChecks("nested feed")),
    ]
    steps = {
        "left": lambda f: models.standard_flat(f["raw_flat"]),
        "right": lambda f: models.standard_nested(f["raw_nested"]),
        "links": lambda f: models.linked(f["left"], f["right"]),
        "merged": lambda f: models.merged(f["left"], f["right"], f["links"], Sources("a", "b")),
    }
    tests = lambda f: [Q.DataTest("unique_id", Q.unique(f["left"], P.LEFT_ID))]
    frames, results = run_pipeline(spark, jobs, steps, tests, str(tmp_path / "root"), str(tmp_path / "log"))
    assert [r.status for r in results.collect()] == ["pass"]
    got = {
        (r[P.LEFT_ID], r[P.RIGHT_ID], r.source_status, r.match_strategy, r.phone, r.website_url)
        for r in frames["merged"].collect()
    }
    assert got == {
        ("f1", "m1", "matched", "exact_name_state", "+15415551234", "http://m1"),
        ("f2", "m2", "matched", "fuzzy_name_city", "+1888", "http://n"),
        ("f3", None, "a_only", None, None, None),
        ("m3", "m3", "b_only", None, None, None),
    }


def test_flat_export_and_views(spark, tmp_path):
    df = spark.sql("SELECT 1 AS id, named_struct('x', 2, 'y', named_struct('z', 'q')) AS s, array(1, 2) AS l")
    assert S.flatten(df).columns == ["id", "s_x", "s_y_z", "l"]
    S.export_jsonl(df.withColumn("none", F.lit(None).cast("string")), str(tmp_path / "j"))
    line = next((tmp_path / "j").glob("part-*")).read_text().strip()
    assert json.loads(line) == {"id": 1, "s": {"x": 2, "y": {"z": "q"}}, "l": [1, 2], "none": None}
    S.materialize(df, "as_view", "view")
    S.materialize(df, "as_table", "table", str(tmp_path))
    assert spark.table("as_view").collect() == spark.table("as_table").collect()
    assert S.materialize(df, "same", "inline") is df


def test_staged_tables_are_dropped(spark):
    drop_staged(spark)
    stage(spark.range(3))
    assert path_exists(spark, checkpoint_root(spark))
    assert drop_staged(spark) == 1 and drop_staged(spark) == 0
