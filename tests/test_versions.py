"""Versioned tables: readers during a rewrite, crashes before the commit, concurrent writers, compaction."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from terraloom.sources import files, versions
from terraloom.streaming import resume


@pytest.fixture
def path(spark):
    return files.scratch_dir(spark, "table")


def ids(spark, n, tag="a"):
    return spark.range(n).select("id", F.lit(tag).alias("tag"))


def test_reader_during_a_rewrite(spark, rows, path):
    versions.create(ids(spark, 3), path)
    before = versions.read_version(spark, path)
    seen_inside = []

    def change(df):
        seen_inside.extend(rows(versions.read_version(spark, path)))
        return df.select((F.col("id") * 10).alias("id"))
    assert versions.rewrite(spark, path, change) == 2
    assert seen_inside == rows(before) == [(0, "a"), (1, "a"), (2, "a")]
    assert rows(versions.read_version(spark, path)) == [(0,), (10,), (20,)] and rows(versions.read_version(spark, path, 1)) == rows(before)


def test_crash_before_the_commit(spark, rows, path, monkeypatch):
    versions.create(ids(spark, 3), path)
    monkeypatch.setattr(files, "put_new", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        versions.rewrite(spark, path, lambda df: df.limit(0))
    monkeypatch.undo()
    assert versions.versions(spark, path) == [1] and len(rows(versions.read_version(spark, path))) == 3
    assert len(files.matching(spark, f"{path}/parts/part=*")) == 2
    versions.remove_old(spark, path)
    assert len(files.matching(spark, f"{path}/parts/part=*")) == 1 and len(rows(versions.read_version(spark, path))) == 3


def test_two_writers(spark, rows, path):
    """An append lands behind whatever came first; a rewrite of an older version fails and loses nothing."""
    versions.create(ids(spark, 1), path)

    def change(df):
        versions.append(ids(spark, 1, "late"), path)
        return df.limit(0)
    with pytest.raises(versions.VersionConflict):
        versions.rewrite(spark, path, change)
    assert rows(versions.read_version(spark, path)) == [(0, "a"), (0, "late")]
    taken = versions.versions(spark, path)[-1]
    with pytest.raises(versions.VersionConflict):
        versions.commit(spark, path, [], ids(spark, 1).schema, taken - 1)
    with pytest.raises(ValueError, match="do not fit"):
        versions.append(spark.range(1), path)


def test_compaction(spark, rows, path):
    """Newest rows stay, rows appended meanwhile too; the folders of a season are all that a filter reads."""
    for turn in range(3):
        versions.append(spark.range(4 - turn).select("id", F.lit(turn).alias("saved"), F.concat(F.lit("s"), F.col("id") % 2).alias("season")), path, ["season"])
    versions.compact(spark, path, ["id"], ["saved"], ["season"])
    assert rows(versions.read_version(spark, path), "id", "saved") == [(0, 2), (1, 2), (2, 1), (3, 0)]
    versions.append(spark.range(1).select("id", F.lit(9).alias("saved"), F.lit("s0").alias("season")), path, ["season"])
    versions.remove_old(spark, path)
    df = versions.read_version(spark, path)
    assert df.count() == 5 and versions.versions(spark, path) == [5]
    plan = df.where("season = 's1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(season" in plan


def test_no_version(spark, path):
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, path)
    versions.append(ids(spark, 0), path)
    assert versions.read_version(spark, path).count() == 0


def test_a_batch_reads_the_folders_it_touches(spark, path):
    """Of twenty season-years stored, a batch of one day reads one; run again, it stores its days once."""
    days = spark.range(20).selectExpr("id % 2 AS loc_id", "make_date(2000 + int(id), 7, 1) AS date", "1.0D AS prectotcorr", "2.0D AS cdd10", "'Kharif' AS season", "2000 + int(id) AS year")
    resume.store_days(days, path, ["loc_id"], 0)
    new = spark.sql("SELECT 1L AS loc_id, DATE'2005-07-02' AS date, 1.0D AS prectotcorr, 2.0D AS cdd10, 'Kharif' AS season, 2005 AS year")
    for _ in range(2):
        resume.store_days(new, path, ["loc_id"], 1)
    touched = resume.touched_days(spark, path, ["loc_id"], 1)
    assert {f.split("/year=")[1][:4] for f in touched.inputFiles()} == {"2005"}
    assert sorted((r.loc_id, str(r.date)) for r in touched.collect()) == [(1, "2005-07-01"), (1, "2005-07-02")]
    assert resume.touched_days(spark, path, ["loc_id"], 7) is None
