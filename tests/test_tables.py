"""Cleaning, keys, enrichment, reshaping, comparison."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from terraloom.operators import clean, collisions, columns, compare, enrich, keys, reshape, skew

MASTER = (
    "row_id long, FarmerID string, State string, SEX string, Zipcode string, codes string, sizes string, `Address type` string, "
    "Location string, Ownership string, `Target_Variable/Total Income` double, Perc_of_house_with_6plus_room double, "
    "Total_Land_For_Agriculture double, No_of_Active_Loan_In_Bureau double, Avg_Disbursement_Amount_Bureau double"
)


def bucket(text, n=256, prefix=18):
    return int.from_bytes(hashlib.sha256(text.encode()).digest()[:prefix], "big") % n


def farmer(i, sex="MALE", codes="1", sizes="1.5", target=10.0, perc=1.0, land=2.0, loans=1.0, amount=50.0, zipcode="007", state="S"):
    return (i, "f", state, sex, zipcode, codes, sizes, "a", "l", "o", target, perc, land, loans, amount)


def test_clean_master(spark):
    data = [
        farmer(0), farmer(1), farmer(2, sex=None), farmer(3, sex=None), farmer(4, target=0.0), farmer(5, target=None),
        farmer(6, perc=None), farmer(7, land=None), farmer(8, loans=0.0), farmer(9, loans=None), farmer(10, sex="é"),
        farmer(11, codes="12d", target=0.0), farmer(12, codes=" 12 ", sizes="1e5"),
    ]
    out = clean.clean_master(spark.createDataFrame(data, MASTER))
    got = {r["row_id"]: r for r in out.collect()}
    assert set(got) == {0, 2, 5, 8, 9, 10, 12}
    assert dict(out.dtypes)["codes"] == "bigint" and dict(out.dtypes)["sizes"] == "double" and dict(out.dtypes)["Zipcode"] == "string"
    assert out.columns[-1] == "SEX" and not set(clean.DROPPED) & set(out.columns)
    assert got[0]["SEX"] == bucket("MALE") and got[2]["SEX"] is None and got[10]["SEX"] == bucket("é")
    assert got[5][clean.TARGET] is None
    assert got[8][clean.LOAN_AMOUNT] == 0 and got[9][clean.LOAN_AMOUNT] == 50
    assert got[12]["codes"] == 12 and got[12]["sizes"] == 1e5


def test_dropping_a_missing_column_fails(spark):
    with pytest.raises(KeyError):
        columns.drop_columns(spark.range(1), ["id", "nope"])


@pytest.mark.parametrize("values, numeric, integral", [
    (["1", " 2 "], True, True), (["1", "2.5"], True, False), (["1", None], False, False), (["12d"], False, False), (["NaN"], False, False), ([], True, True),
])
def test_numeric_columns(spark, values, numeric, integral):
    df = spark.createDataFrame([(v,) for v in values], "`a.b` string")
    r = columns.numeric_columns(df, ["a.b"]).first()
    assert (r["numeric"], r["integral"]) == (numeric, integral)


def test_constant_value(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y")], "a int, b string")
    assert columns.constant_value(df, ["a"]).first()[0] == 1
    with pytest.raises(Exception, match="not constant"):
        columns.constant_value(df, ["b"]).collect()


def test_collision_audit_golden(spark):
    df = spark.range(50_000).select(F.concat(F.lit("cat_"), F.col("id").cast("string")).alias("c"))
    assert tuple(collisions.collision_audit(df, F.col("c")).first()) == (50_000, 606, 611, pytest.approx(1.222))
    empty = collisions.collision_audit(df.where("false"), F.col("c")).first()
    assert tuple(empty) == (0, 0, 0, None)


def test_dedup_keeps_first_with_nulls(spark, rows):
    df = spark.createDataFrame([(3, "a", None), (1, "a", None), (2, "a", 1.0), (4, "a", 1.0)], "id int, k string, v double")
    assert rows(clean.dedup_keep_first(df, "id")) == [(1, "a", None), (2, "a", 1.0)]


def test_row_ids_are_consecutive(spark):
    """Most rows share one order value; ids still run 0..n-1 in order."""
    df = spark.range(5000).select((F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(7)).alias("k"), "id").repartition(6)
    got = keys.attach_row_ids(df, ["k"]).orderBy("row_id").collect()
    assert [r.row_id for r in got] == list(range(5000))
    assert [r.k for r in got] == sorted(r.k for r in got)
    assert len({r.id for r in got}) == 5000


def test_align_by_position(spark, rows):
    a, b = spark.createDataFrame([("x",), ("y",)], "a string"), spark.createDataFrame([(9,), (5,)], "b int")
    assert rows(keys.align_by_position(a, b, ["a"], ["b"])) == [(0, "x", 5), (1, "y", 9)]
    with pytest.raises(ValueError, match="length"):
        keys.align_by_position(a, b.limit(1), ["a"], ["b"])


@pytest.mark.parametrize("hot_rows", [None, 1])
def test_reindex(spark, rows, hot_rows):
    master = spark.createDataFrame([(0,), (1,), (2,), (2,)], "row_id long")
    look = spark.createDataFrame([(2, 5.0, None), (0, None, 1.0), (9, 9.0, 9.0)], "row_id long, lat double, lon double")
    assert rows(keys.reindex_left(master, look, "row_id", hot_rows)) == [(0, None, 1.0), (1, None, None), (2, 5.0, None), (2, 5.0, None)]
    with pytest.raises(Exception, match="duplicate key"):
        keys.reindex_left(master, look.union(look), "row_id", hot_rows).collect()


@pytest.mark.parametrize("how", ["left", "inner"])
def test_skew_join_equals_join(spark, how):
    """One key holds most rows; null keys and unmatched keys on both sides."""
    left = spark.range(3000).select(F.when(F.col("id") % 3 < 2, F.lit(1)).when(F.col("id") % 50 == 0, None).otherwise(F.col("id")).alias("k"), "id")
    right = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (5000, "e")], "k long, v string")
    got = skew.skew_join(left, right, ["k"], how, spread_by=F.col("id"), hot_rows=100, salts=8)
    want = left.join(right, "k", how)
    assert got.exceptAll(want.select(got.columns)).isEmpty() and want.select(got.columns).exceptAll(got).isEmpty()
    assert skew.salt_rows(left, skew.hot_keys(left, ["k"], 100), ["k"], F.col("id"), 8).where("k = 1").select("_salt").distinct().count() == 8
    with pytest.raises(ValueError):
        skew.skew_join(left, right, ["k"], "outer")


OLD = [(1, 1.0, "o"), (2, None, "o"), (3, 3.0, "o")]
NEW = [(2, 20.0, "n"), (3, None, "n"), (4, 4.0, None)]


@pytest.mark.parametrize("wins, want", [
    ("new", [(1, 1.0, "o"), (2, 20.0, "n"), (3, None, "n"), (4, 4.0, None)]),
    ("existing", [(1, 1.0, "o"), (2, None, "o"), (3, 3.0, "o"), (4, 4.0, None)]),
    ("non_null", [(1, 1.0, "o"), (2, 20.0, "n"), (3, 3.0, "n"), (4, 4.0, None)]),
])
def test_upsert(spark, rows, wins, want):
    old, new = (spark.createDataFrame(d, "id int, lat double, tag string") for d in (OLD, NEW))
    once = enrich.upsert(old, new, ["id"], wins)
    assert rows(once) == want
    assert rows(enrich.upsert(once, new, ["id"], wins)) == want


def places(spark):
    master = spark.createDataFrame([(i, "V%d" % (i % 4), "D") for i in range(20)], "row_id long, VILLAGE string, DISTRICT string")
    gaz = spark.createDataFrame([(" v0,  D ", 2, 9.0, 9.0), ("V0, d", 1, 1.0, 2.0), ("V1, D", 1, 3.0, 4.0), ("V2, D", 1, 5.0, 6.0)],
                                "address string, rank int, lat double, lon double")
    return master, gaz


def test_lookup_and_resume(spark, rows):
    """A run cut after part of the rows and resumed gives what one full run gives."""
    master, gaz = places(spark)
    parts = ["VILLAGE", "DISTRICT"]
    empty = spark.createDataFrame([], "row_id long, lat double, lon double, status int")
    full = enrich.enrich_incremental(master, empty, gaz, parts, hot_rows=2)
    got = {r.row_id: (r.lat, r.lon, r.status) for r in full.collect()}
    assert got[0] == (1.0, 2.0, 200) and got[1] == (3.0, 4.0, 200) and got[3] == (None, None, 204) and len(got) == 20
    part = enrich.enrich_incremental(master.where("row_id < 7"), empty, gaz, parts)
    assert rows(enrich.enrich_incremental(master, part, gaz, parts)) == rows(full)
    assert enrich.completion(full).first() == (15, 20)


def test_retry(spark, rows):
    master, gaz = places(spark)
    parts = ["VILLAGE", "DISTRICT"]
    first = enrich.lookup_first(master, gaz.where("lat < 2"), parts)
    again = enrich.retry_missing(master, first, gaz, parts)
    assert rows(again) == rows(enrich.lookup_first(master, gaz, parts))
    done = again.where("status = 200")
    assert enrich.retry_rows(done).isEmpty()
    assert rows(enrich.retry_missing(master.join(done, "row_id", "left_semi"), done, gaz, parts)) == rows(done)
    by_lat = first.drop("status")
    assert enrich.retry_rows(by_lat).count() == by_lat.where("lat IS NULL").count()


def test_response_status(spark):
    df = spark.createDataFrame([(429, None), (500, [1]), (200, []), (200, None), (200, [1])], "http int, results array<int>")
    got = [r[0] for r in df.select(enrich.response_status(F.col("http"), F.col("results"))).collect()]
    assert got == [429, 500, 204, 204, 200]


def test_latest_and_summary(spark, rows):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (1, "c", 2), (2, "d", 1)], "k int, v string, at int")
    assert rows(enrich.latest_per_key(df, ["k"], ["at"]), "k", "v") == [(1, "b"), (2, "d")]
    assert rows(enrich.checkpoint_summary(df.union(df), ["k"], "v", "at")) == [(1, 3, 3), (2, 1, 1)]
    assert rows(enrich.completed_keys(df, df, keys=["k"])) == [(1,), (2,)]


def test_widen(spark, rows):
    df = spark.createDataFrame([(1, "Kharif", 2020, 1.0), (1, "Rabi", 2020, 2.0), (2, "Rabi", 2020, None), (3, "Rabi", 1999, 7.0)],
                               "id int, season string, year int, mean double")
    wide = reshape.widen_seasons(df, "id", [("Kharif", 2020), ("Rabi", 2020)], ["mean"])
    assert wide.columns == ["id", "mean_2020_Kharif", "mean_2020_Rabi"]
    assert rows(wide) == [(1, 1.0, 2.0), (2, None, None)]
    master = spark.createDataFrame([(2,), (9,)], "id int")
    assert rows(reshape.join_wide(master, wide, "id"), "id") == [(1,), (2,), (9,)]
    with pytest.raises(Exception, match="more than one row"):
        reshape.widen_seasons(df.union(df), "id", [("Rabi", 2020)], ["mean"]).collect()


def test_frame_diff(spark, rows):
    a = spark.createDataFrame([(1, "x", 1.0), (2, None, 2.0), (3, "z", None)], "id int, s string, v double")
    b = spark.createDataFrame([(1, "x", 1.5), (2, None, 2.0), (4, "n", None)], "id int, s string, v double")
    assert compare.frame_diff(a, a, ["id"]).isEmpty()
    assert rows(compare.frame_diff(a, b, ["id"]).where("column <> '(row)'")) == [(1, "v", "1.0", "1.5"), (3, "s", "z", None), (4, "s", None, "n")]
    assert rows(compare.frame_diff(a, b, ["id"]).where("column = '(row)'")) == [(3, "(row)", "present", None), (4, "(row)", None, "present")]
    with pytest.raises(ValueError, match="one side only"):
        compare.frame_diff(a, b.drop("v"), ["id"])
