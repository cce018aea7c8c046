from __future__ import annotations

import hashlib
import math
from urllib.parse import quote, urljoin

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraloom.functions import arrays, dates, gamma, hashing, numeric, text, urls


def values(spark, data, schema="x string"):
    return spark.createDataFrame([(d,) for d in data], schema)


@pytest.mark.parametrize("value, mod_256, mod_2e32, mod_2e21", [
    ("MALE", 52, 3337868340, 835608), ("FEMALE", 149, 3358899605, 64443), ("", 174, 3106154414, 1842196),
    ("é", 249, 399169017, 1295187), ("cat_7", 22, 3613809942, 1811201),
])
def test_hash_golden(spark, value, mod_256, mod_2e32, mod_2e21):
    x = F.col("x")
    row = values(spark, [value]).select(
        hashing.hash_bucket(x, 256), hashing.hash_bucket(x), hashing.hash_bucket(x, 2**21, 8)).first()
    assert tuple(row) == (mod_256, mod_2e32, mod_2e21)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 256, 1000, 2**31 - 1, 2**32, 10**15 + 37, 2**58 + 1, 2**58])
@pytest.mark.parametrize("prefix", [1, 8, 18, 32])
def test_hash_any_modulus(spark, n, prefix):
    words = [f"w{i}" for i in range(50)] + ["", "日本"]
    got = [r[0] for r in values(spark, words).select(hashing.hash_bucket(F.col("x"), n, prefix)).collect()]
    assert got == [int.from_bytes(hashlib.sha256(w.encode()).digest()[:prefix], "big") % n for w in words]


def test_hash_null_and_limits(spark):
    assert values(spark, [None]).select(hashing.hash_bucket(F.col("x"), 1000)).first()[0] is None
    assert values(spark, [None]).select(hashing.hash_bucket(F.col("x"), 256)).first()[0] is None
    for bad in ({"n_buckets": 0}, {"n_buckets": 2**59}, {"prefix_bytes": 33}):
        with pytest.raises(ValueError):
            hashing.hash_bucket(F.col("x"), **bad)


HREFS = [
    "A.TIF", "sub/", "./x.tif", "../up.tif", "../../up2/", "a/../b", "a/./b/", "/root.tif", "/r/../s/", "//cdn.test/z", "?C=N;O=D",
    "#frag", "", "x?q=../y", "x#../y", "http://other.test/a/../b", "ftp://f.test/", ".", "..", "mailto:a@b.test", "a b",
]
BASES = [
    "http://h.test/a/b/c", "https://h.test/a/b/", "http://h.test", "http://h.test/", "http://h.test/a?x=/y/#z", "http://h.test/p;v/q#top",
]


def test_resolve_url_like_urljoin(spark):
    pairs = [(b, h) for b in BASES for h in HREFS]
    got = spark.createDataFrame(pairs, "b string, h string").select(
        "b", "h", urls.resolve_url(F.col("b"), F.col("h")).alias("u")).collect()
    assert {(r.b, r.h): r.u for r in got} == {(b, h): urljoin(b, h) for b, h in pairs}


def test_link_rules(spark):
    df = values(spark, ["../", "../x/", "/", "t/", "A.TIF", "/a/b.tif", None])
    kept = [r[0] for r in df.where(urls.is_listing_entry(F.col("x"))).collect()]
    assert kept == ["t/", "A.TIF", "/a/b.tif"]
    assert [r[0] for r in df.where(urls.has_suffix(F.col("x"))).collect()] == ["A.TIF", "/a/b.tif"]
    assert values(spark, ["http://h/a/b//"]).select(urls.last_path_part(F.col("x"))).first()[0] == "b"
    assert values(spark, ["http://h/a//"]).select(urls.child_url(F.col("x"), F.lit("t"))).first()[0] == "http://h/a/t/"
    assert values(spark, ["q-017"]).select(urls.contains_any(F.col("x"), [])).first()[0] is False


def test_percent_encode_like_quote(spark):
    texts = ["a b/c~d*e+f", "São, Índia", "100%", "x&y=z?#", "-_.~", "日本", "tab\tnew\nline", "(a)'!"]
    got = [r[0] for r in values(spark, texts).select(text.percent_encode(F.col("x"))).collect()]
    assert got == [quote(t) for t in texts]


def test_log_edges(spark):
    got = [r[0] for r in values(spark, [math.e, 0.0, -1.0, None], "x double").select(numeric.log_with_edges(F.col("x"))).collect()]
    assert got[0] == pytest.approx(1.0) and got[1] == -math.inf and math.isnan(got[2]) and got[3] is None


def test_numeric_text(spark):
    cases = {"12d": None, "NaN": None, " 12 ": 12.0, "1e5": 1e5, "abc": None, "-.5": -0.5, "7.": 7.0, "": None, "inf": math.inf, "0x1": None}
    got = [r[0] for r in values(spark, list(cases)).select(numeric.to_number(F.col("x"))).collect()]
    assert got == list(cases.values())
    prefixes = {"12.5abc": 12.5, "abc": None, "  -3e2x": -300.0, "1e": 1.0, "": None, ".5.5": 0.5, "+7": 7.0}
    got = [r[0] for r in values(spark, list(prefixes)).select(numeric.parse_prefix_number(F.col("x"))).collect()]
    assert got == list(prefixes.values())


def test_population_cv_zero_mean(spark):
    got = values(spark, [-1.0, 1.0], "x double").select(numeric.population_cv("x")).first()[0]
    assert math.isnan(got)
    assert values(spark, [None], "x double").select(numeric.sum_or_zero("x")).first()[0] == 0


def test_min_max_constant(spark):
    df = spark.createDataFrame([(5.0,), (None,)], "x double")
    got = [r[0] for r in df.select(numeric.min_max_scale(F.col("x"), F.lit(5.0), F.lit(5.0))).collect()]
    assert got == [0.0, None]


SEASON_EDGES = {
    "2021-10-31": ("Kharif", 2021), "2021-11-01": ("Rabi", 2021), "2021-12-31": ("Rabi", 2021), "2022-01-01": ("Rabi", 2021),
    "2020-02-29": ("Rabi", 2019), "2022-04-30": ("Rabi", 2021), "2022-05-01": (None, 2022), "2022-05-31": (None, 2022),
    "2022-06-01": ("Kharif", 2022),
}


def test_season_edges(spark):
    df = values(spark, list(SEASON_EDGES)).select(F.to_date("x").alias("d"))
    got = [tuple(r) for r in df.select(dates.season_name(F.col("d")), dates.season_year(F.col("d"))).collect()]
    assert got == list(SEASON_EDGES.values())


def test_epoch_days_ignores_session_zone(spark):
    sql = "SELECT timestamp_ntz'1970-01-02 12:00:00' n, date'1970-01-03' d, timestamp'1970-01-02 06:00:00' t"
    df = spark.sql(sql)
    assert tuple(df.select(*[dates.epoch_days(df, c) for c in "ndt"]).first()) == (1.5, 2.0, 1.25)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert df.select(dates.epoch_days(df, "n")).first()[0] == 1.5
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_dates_and_errors(spark):
    row = values(spark, ["2022-06-01"]).select(
        dates.compact_date(F.col("x")), dates.parse_compact_date(F.lit("20220601")).cast("string"),
        text.truncate_error(F.repeat("x", F.lit(30))), dates.epoch_millis_to_days(F.lit(43_200_000))).first()
    assert row[0] == "20220601" and row[1] == "2022-06-01" and len(row[2]) == 100 and row[3] == 0.5


def test_gamma_cdf_erlang():
    """For a whole shape the distribution function has a closed form."""
    for a in (1, 2, 5, 40):
        x = np.array([0.01, 0.5, a * 0.5, a, a + 2.0, a * 3.0])
        want = [1 - math.exp(-v) * sum(v**k / math.factorial(k) for k in range(a)) for v in x]
        assert gamma._gamma_cdf(x, np.full(len(x), float(a))) == pytest.approx(want, abs=1e-12)
    big = gamma._gamma_cdf(np.array([700.0, 1e6]), np.array([703.77, 1e6]))
    assert 0.4 < big[0] < 0.5 and 0.499 < big[1] < 0.501
    assert list(gamma._gamma_cdf(np.array([0.0, -1.0]), np.array([2.0, 2.0]))) == [0.0, 0.0]


def test_normal_quantile_edges(spark):
    df = values(spark, [0.0, 1.0, 0.5, 0.975, None], "x double")
    got = [r[0] for r in df.select(gamma.normal_quantile(F.col("x"))).collect()]
    assert got[0] == -math.inf and got[1] == math.inf and got[2] == 0 and got[3] == pytest.approx(1.959963985) and got[4] is None


def test_gamma_shape_solves_root(spark):
    """ln(a) - digamma(a) = s, digamma checked by differences of lgamma."""
    s = [0.0007, 0.01, 0.2, 0.5772, 2.0]
    df = values(spark, s, "x double").select("x", gamma.gamma_shape(F.lit(math.e), 1 - F.col("x")).alias("a"))
    for r in df.collect():
        h = r.a * 1e-4
        psi = (8 * (math.lgamma(r.a + h) - math.lgamma(r.a - h)) - (math.lgamma(r.a + 2 * h) - math.lgamma(r.a - 2 * h))) / (12 * h)
        assert math.log(r.a) - psi == pytest.approx(r.x, abs=2e-8)
    assert values(spark, [0.0], "x double").select(gamma.gamma_shape(F.lit(math.e), 1 - F.col("x"))).first()[0] is None


def test_array_helpers(spark):
    df = spark.createDataFrame([([1.0, 2.0, 2.0], [1.0, 2.00001, 2.0])], "a array<double>, b array<double>")
    row = df.select(arrays.argmax(F.col("a")), arrays.all_close(F.col("a"), F.col("b")), arrays.all_close(F.col("a"), F.col("b"), 0.0, 0.0),
                    arrays.squared_error(F.col("a"), F.array(F.lit(0.0), F.lit(0.0), F.lit(0.0)))).first()
    assert tuple(row) == (2, True, False, 9.0)


def test_ids_and_points(spark):
    df = spark.createDataFrame([("7", "V", 1), ("", "V", 1), (None, "V", 1), (None, None, 1)], "i string, v string, z int")
    got = [r[0] for r in df.select(text.id_or_fallback(F.col("i"), F.col("v"), F.col("z"))).collect()]
    assert got == ["7", "V_1", "V_1", None]
    line = spark.range(1).select(text.point_literal(F.lit(3), F.lit(78.5), F.lit(21.0), "Kharif_2021")).first()[0]
    assert line == "ee.Feature(ee.Geometry.Point([78.5, 21.0]), {id: '3_Kharif_2021'}),"
