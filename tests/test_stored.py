"""Scans, sinks, checkpoints and the incremental stream."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F, types as T

from terraloom.operators.weather import weather_features, zip_parameters
from terraloom.plans import reshape as plan_reshape
from terraloom.sources import checkpoints, documents, observations, sinks, tables
from terraloom.streaming import resume


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_headers_nulls_types(spark, tmp_path):
    p = write(tmp_path / "a.csv", 'id,x,id,name,flag,empty,zip,"q,1"\n1,2.5,7,None,True,,007,"a ""b"", c"\n\n2,NA,8,é,False,,abc,\n')
    df = tables.read_table(spark, p)
    assert df.columns == ["id", "x", "id.1", "name", "flag", "empty", "zip", "q,1"]
    assert [k for _, k in df.dtypes] == ["bigint", "double", "bigint", "string", "boolean", "double", "string", "string"]
    assert [tuple(r) for r in df.orderBy("id").collect()] == [
        (1, 2.5, 7, None, True, None, "007", 'a "b", c'), (2, None, 8, "é", False, None, "abc", None)]
    typed = tables.read_table(spark, p, schema=T.StructType([T.StructField("id", T.StringType()), T.StructField("x", T.FloatType())]))
    assert dict(typed.dtypes)["id"] == "string" and dict(typed.dtypes)["x"] == "float"
    text = tables.read_text_csv(spark, p)
    assert text.count() == 2 and {k for _, k in text.dtypes} == {"string"}


def test_keyed_csv_round_trip(spark, tmp_path, rows):
    df = spark.createDataFrame([(5, "a", None), (3, None, 2.5)], "row_id long, s string, v double")
    for name, options, first in (("k", {}, "row_id"), ("r", {"key_name": "id"}, "id")):
        path = str(tmp_path / name)
        sinks.write_table(df, path, **options)
        assert [names[0] for names in tables.headers(spark, path)] == [first]
        assert rows(tables.read_keyed_table(spark, path)) == [(3, None, 2.5), (5, "a", None)]
    sinks.write_table(df, str(tmp_path / "n"), row_id=None)
    assert list(tables.headers(spark, str(tmp_path / "n"))) == [("s", "v")]


def test_unnamed_key_column(spark, tmp_path, rows):
    p = write(tmp_path / "c.csv", ",lat,lon\n0,1.5,2.5\n3,,\n")
    assert rows(tables.read_keyed_table(spark, p)) == [(0, 1.5, 2.5), (3, None, None)]


def test_every_file_by_its_own_header(spark, tmp_path, rows):
    write(tmp_path / "s1.csv", "id,mean,max\n1,10,20\n")
    write(tmp_path / "s2.csv", "id,max,mean\n2,21,11\n")
    write(tmp_path / "s3.csv", "id,mean,max,note\n3,12,22,x\n4,13,23\n")
    df = tables.read_table(spark, str(tmp_path / "s*.csv"))
    assert rows(df, "id", "mean", "max", "note") == [(1, 10, 20, None), (2, 11, 21, None), (3, 12, 22, "x"), (4, 13, 23, None)]


def test_surplus_fields_are_an_error(spark, tmp_path):
    p = write(tmp_path / "r.csv", "a,b\n1,2\n1,2,3\n")
    with pytest.raises(Exception, match="more than 2 fields"):
        tables.read_text_csv(spark, p).collect()


def test_train_or_test(spark, tmp_path):
    train, test = write(tmp_path / "train.csv", "a\n1\n"), write(tmp_path / "test.csv", "a\n2\n")
    assert tables.read_master(spark, True, train, test).first()[0] == 1
    assert tables.read_master(spark, False, train, test).first()[0] == 2


def test_glob_names_the_file(spark, tmp_path):
    for year in (2020, 2021):
        write(tmp_path / f"stats_Rabi_{year}.csv", f"id,year\n1,{year}\n")
    df = tables.read_table(spark, str(tmp_path / "stats_*.csv"), source_file="file")
    assert sorted((r.year, r.file.rsplit("/", 1)[1]) for r in df.collect()) == [(2020, "stats_Rabi_2020.csv"), (2021, "stats_Rabi_2021.csv")]


def test_stats_append(spark, tmp_path):
    row = spark.createDataFrame([(1, "Rabi", 2020, 1.0, None, 1.0, 0.0, 1.0, None, None, 16.0)],
                                "id int, season string, year int, mean double, max double, min double, stdDev double, p90 double, slope double, intercept double, auc double")
    path = str(tmp_path / "stats")
    sinks.append_stats(row, path)
    sinks.append_stats(row.withColumn("id", F.lit(2)), path)
    assert list(tables.headers(spark, path)) == [sinks.STATS_HEADER]
    assert sorted(r.value for r in spark.read.text(path).where("value NOT LIKE 'id%'").collect()) == [
        "1,Rabi,2020,1.0,,1.0,0.0,1.0,,,16.0", "2,Rabi,2020,1.0,,1.0,0.0,1.0,,,16.0"]


def test_rewrite_in_place(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).selectExpr("id", "id AS dup").write.parquet(path)
    old = sinks.rewrite_table(spark, path, spark.read.parquet, lambda d: d.drop("dup"), lambda d, p: d.write.parquet(p))
    assert spark.read.parquet(path).columns == ["id"] and spark.read.parquet(path).count() == 3
    assert spark.read.parquet(old).columns == ["id", "dup"]


def test_checkpoints(spark, tmp_path, rows):
    path = str(tmp_path / "ckpt")
    assert checkpoints.load_checkpoint(spark, path, 2021, "Rabi").isEmpty()
    one = spark.createDataFrame([(2021, "Rabi", 1, 1.0, 1.0, None), (2021, "Rabi", 2, 2.0, 1.0, None), (2020, "Rabi", 1, 9.0, 1.0, None)],
                                "year int, season string, loc_id long, gdd double, rain_cv double, spi3_mean double")
    checkpoints.save_checkpoint(one.withColumn("saved_at", F.lit("2024-01-01").cast("timestamp")), path)
    checkpoints.save_checkpoint(one.where("loc_id = 2").withColumn("gdd", F.lit(5.0)), path)
    got = checkpoints.load_checkpoint(spark, path, 2021, "Rabi")
    assert rows(got, "loc_id", "gdd") == [(1, 1.0), (2, 5.0)]
    assert checkpoints.load_checkpoint(spark, path).count() == 3
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "season" in plan.split("PartitionFilters")[1].split("]")[0]


def test_failures(spark, tmp_path, rows):
    path = str(tmp_path / "failed")
    assert checkpoints.read_failures(spark, path).isEmpty()
    failed = spark.createDataFrame([(1.0, 2.0, "2020-06-01", "2020-10-31", "HTTP 500: x", 1)], checkpoints.FAILURE_SCHEMA)
    checkpoints.write_failures(failed, path)
    assert rows(checkpoints.read_failures(spark, path)) == rows(failed)


def document(values, fill=-999.0):
    return {"type": "Feature", "geometry": {"type": "Point", "coordinates": [78.0, 21.0, 357.04]},
            "properties": {"parameter": {"CDD10": values, "PRECTOTCORR": values}}, "header": {"title": "t", "fill_value": fill}}


def test_weather_files(spark, tmp_path, rows):
    write(tmp_path / "a.json", json.dumps(document({"20220601": 1.5, "20220602": -999.0}), indent=1))
    docs = documents.read_weather(spark, str(tmp_path / "a.json"))
    assert rows(docs, "lon", "lat", "fill_value") == [(78.0, 21.0, -999.0)]
    days = zip_parameters(docs, ["lon"], fill_value=-999.0)
    assert rows(days) == [(78.0, dt.date(2022, 6, 1), 1.5, 1.5), (78.0, dt.date(2022, 6, 2), None, None)]


def test_geocode_files(spark, tmp_path, rows):
    hit = {"results": [{"geometry": {"location": {"lat": 1.25, "lng": 7}}}, {"geometry": {"location": {"lat": 0, "lng": 0}}}], "status": "OK"}
    write(tmp_path / "a.json", json.dumps(hit, indent=1))
    write(tmp_path / "b.json", json.dumps({"results": [], "status": "ZERO_RESULTS"}))
    assert rows(documents.read_geocode(spark, str(tmp_path / "*.json")), "lat", "lon", "status") == [(1.25, 7.0, 200), (None, None, 204)]


def test_observations_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "obs")
    spark.sql("SELECT id AS cell_id, timestamp'2021-06-01' + make_dt_interval(int(id)) AS ts, double(id) AS evi, 'x' AS other FROM range(10)").write.parquet(path)
    obs = observations.read_observations(spark, path, "2021-06-03", "2021-06-05")
    assert sorted(r.cell_id for r in obs.collect()) == [2, 3]
    plan = obs._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan and "other" not in plan


def test_inventory_catalogue_listing(spark, tmp_path, rows):
    folder = tmp_path / "files"
    folder.mkdir()
    write(folder / "full.tif", "data")
    write(folder / "empty.tif", "")
    found = observations.read_inventory(spark, str(folder), "*.tif").collect()
    assert [(r.path.rsplit("/", 1)[1], r.length) for r in found] == [("full.tif", 4)]
    p = write(tmp_path / "cat.csv", "url,lon0,lat0,lon1,lat1\nu,1,2,3,4\n")
    assert rows(observations.read_catalogue(spark, p)) == [("u", 1.0, 2.0, 3.0, 4.0)]
    spark.createDataFrame([("http://h/", '<a href="t/">t</a>')], "url string, html string").write.parquet(str(tmp_path / "pages"))
    assert rows(observations.read_listing(spark, str(tmp_path / "pages")), "abs_url", "kind") == [("http://h/t/", "dir")]


def docs_for(loc, days, start=dt.date(2022, 6, 1)):
    values = {(start + dt.timedelta(i)).strftime("%Y%m%d"): 5.0 + (i * 37 % 23) + loc for i in range(days)}
    return {"loc_id": loc, "prectotcorr": values, "cdd10": values}


def test_stream_resumes(spark, tmp_path, rows):
    """Three runs: two with new files (one repeats a location), one without; the result equals one batch pass."""
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    (tmp_path / "in").mkdir()
    batches = [[docs_for(1, 122), docs_for(2, 95)], [docs_for(2, 122), docs_for(3, 30)], []]
    for i, docs in enumerate(batches):
        if docs:
            write(tmp_path / "in" / f"{i}.json", "\n".join(json.dumps(d) for d in docs))
        resume.drain_documents(spark, source, target, progress)
    got = resume.drained_features(spark, target).drop("saved_at")
    final = [docs_for(1, 122), docs_for(2, 122), docs_for(3, 30)]
    frame = spark.createDataFrame([(d["loc_id"], d["prectotcorr"], d["cdd10"]) for d in final], resume.DOCUMENT_SCHEMA)
    want = weather_features(zip_parameters(frame, ["loc_id"]), ["loc_id"])
    shown = [F.round(c, 9).alias(c) if k == "double" else F.col(c) for c, k in want.dtypes]
    assert rows(got.select(shown)) == rows(want.select(shown))


def test_wide_seasons_take_every_year(spark, tmp_path):
    """A season-year outside 1991-2002 has its columns."""
    days = [(1, dt.datetime(1989, 7, 1), 5.0), (1, dt.datetime(2005, 12, 1), 7.0)]
    spark.createDataFrame(days, "l_suppkey bigint, l_shipdate timestamp_ntz, l_quantity double").write.parquet(str(tmp_path / "lineitem.parquet"))
    row = plan_reshape.widen_seasons(spark, str(tmp_path)).first()
    assert (row["mean_1989_Kharif"], row["mean_2005_Rabi"], row["mean_1997_Rabi"]) == (5.0, 7.0, None)


def test_stream_joins_a_split_season(spark, tmp_path, rows):
    """One season in two runs, the second of which also corrects a day."""
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    (tmp_path / "in").mkdir()
    whole = docs_for(1, 122)
    first = {k: v + (k == "20220601") for k, v in whole["cdd10"].items() if k < "20220801"}
    second = {k: v for k, v in whole["cdd10"].items() if k >= "20220801" or k == "20220601"}
    for i, days in enumerate((first, second)):
        write(tmp_path / "in" / f"{i}.json", json.dumps({"loc_id": 1, "prectotcorr": days, "cdd10": days}))
        resume.drain_documents(spark, source, target, progress)
    got = resume.drained_features(spark, target).drop("saved_at")
    frame = spark.createDataFrame([(1, whole["prectotcorr"], whole["cdd10"])], resume.DOCUMENT_SCHEMA)
    want = weather_features(zip_parameters(frame, ["loc_id"]), ["loc_id"])
    shown = [F.round(c, 9).alias(c) if k == "double" else F.col(c) for c, k in want.dtypes]
    assert rows(got.select(shown)) == rows(want.select(shown))
