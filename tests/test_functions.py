"""Hash buckets and months."""

from __future__ import annotations

from datetime import datetime

import pytest

from rowtide import bucket_distribution, register_functions, with_bucket, with_months
from rowtide.functions.transforms import SEED_ZERO
from scripts import bag


def murmur3(data: bytes) -> int:
    """The published hash, written out byte by byte."""
    mask = 0xFFFFFFFF
    rotl = lambda x, r: ((x << r) | (x >> (32 - r))) & mask
    mix = lambda k: rotl(k * 0xCC9E2D51 & mask, 15) * 0x1B873593 & mask
    h, whole = 0, len(data) // 4 * 4
    for i in range(0, whole, 4):
        h = (rotl(h ^ mix(int.from_bytes(data[i : i + 4], "little")), 13) * 5 + 0xE6546B64) & mask
    if data[whole:]:
        h ^= mix(int.from_bytes(data[whole:], "little"))
    h ^= len(data)
    h = (h ^ (h >> 16)) * 0x85EBCA6B & mask
    h = (h ^ (h >> 13)) * 0xC2B2AE35 & mask
    return h ^ (h >> 16)


def test_seed(spark):
    assert spark.sql(f"SELECT hash({SEED_ZERO})").first()[0] == 0


def test_strings(spark):
    texts = ["", "a", "ab", "abc", "abcd", "acme", "globex", "naïve-ü", "日本語テキスト", "\x00\xff", "x" * 1000, "y" * 100_003]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "s STRING")
    found = {r["s"]: r["b"] for r in with_bucket(df, "s", 512, "b").collect()}
    assert found.pop(None) is None
    assert found == {t: (murmur3(t.encode()) & 0x7FFFFFFF) % 512 for t in texts}
    assert (found["acme"], found["globex"], found["naïve-ü"]) == (208, 90, 84)


def test_integers(spark):
    values = [0, 1, 34, -1, 2**31, -(2**31), 2**63 - 1, -(2**63)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v BIGINT")
    found = {r["v"]: r["b"] for r in with_bucket(df, "v", 512, "b").collect()}
    assert found.pop(None) is None
    assert found == {v: (murmur3(v.to_bytes(8, "little", signed=True)) & 0x7FFFFFFF) % 512 for v in values}
    assert (found[34], found[-1]) == (339, 232)
    small = with_bucket(df.where("v IN (0, 1, 34)").selectExpr("CAST(v AS INT) AS v"), "v", 512, "b")
    assert all(r["b"] == found[r["v"]] for r in small.collect())


def test_rows_of_the_example(spark):
    df = spark.createDataFrame(
        [
            (1, "acme", datetime(2025, 8, 1, 12)),
            (2, "acme", datetime(2025, 8, 15, 9, 10, 11)),
            (3, "globex", datetime(2025, 7, 31, 23, 59, 59)),
        ],
        "id BIGINT, company_id STRING, `timestamp` TIMESTAMP",
    )
    out = with_months(with_bucket(df, "company_id", 512), "timestamp")
    assert bag(out, "id", "bucket_company_id", "month_timestamp") == {(1, 208, 667): 1, (2, 208, 667): 1, (3, 90, 666): 1}
    assert bag(bucket_distribution(df, "company_id", 512)) == {(208, 2): 1, (90, 1): 1}


def test_sql_functions(spark):
    register_functions(spark)
    row = spark.sql(
        """SELECT bucket_string(512, 'acme') AS a, bucket_long(512, 34) AS b, bucket_string(512, NULL) AS c,
                  months(TIMESTAMP '2025-08-01 12:00:00') AS d, months(TIMESTAMP_NTZ '1969-12-31 23:00:00') AS e"""
    ).first()
    assert tuple(row) == (208, 339, None, 667, -1)


def test_months_do_not_decrease(spark):
    hours = spark.sql("SELECT TIMESTAMP_NTZ '1960-01-01' + make_interval(0, 0, 0, 0, CAST(id AS INT) * 97) AS ts FROM range(12000)")
    months = [r["m"] for r in with_months(hours, "ts", "m").orderBy("ts").collect()]
    assert months == sorted(months)
    assert months[0] == -120


def test_plan_stays_in_generated_code(spark):
    df = spark.range(10).selectExpr("CAST(id AS STRING) AS s")
    plan = with_bucket(df, "s", 512)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    assert all(line.strip().startswith(("*(1)", "+- *(1)")) for line in plan.splitlines() if line.strip())


def test_arguments_are_checked(spark):
    with pytest.raises(TypeError, match="double"):
        with_bucket(spark.sql("SELECT 1.0D AS x"), "x", 8)
    with pytest.raises(ValueError, match="positive"):
        with_bucket(spark.sql("SELECT 'a' AS x"), "x", 0)


def test_functions_of_the_session_do_not_matter(spark):
    """A foreign function of the same name is neither used nor replaced unasked."""
    other = spark.newSession()
    other.sql("CREATE TEMPORARY FUNCTION bucket_string(n INT, s STRING) RETURNS INT RETURN 7")
    other.sql("CREATE TEMPORARY FUNCTION months(x INT) RETURNS INT RETURN x + 1")
    df = other.sql("SELECT 'acme' AS name")
    assert with_bucket(df, "name", 512, "b").first().b == with_bucket(spark.sql("SELECT 'acme' AS name"), "name", 512, "b").first().b != 7
    with pytest.raises(ValueError, match="other functions"):
        register_functions(other)
    assert other.sql("SELECT months(1) AS m").first().m == 2
    register_functions(other, replace=True)
    register_functions(other)
    assert other.sql("SELECT months(TIMESTAMP_NTZ '1971-02-03 00:00:00') AS m").first().m == 13


def test_months_of_instants_are_in_utc(spark):
    other = spark.newSession()
    register_functions(other)
    found = set()
    for zone in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
        other.conf.set("spark.sql.session.timeZone", zone)
        instants = other.sql("SELECT explode(array(1754013600, -1, 0, -2678400, -2678401)) AS s").selectExpr("s", "timestamp_seconds(s) AS at")
        rows = with_months(instants, "at", "m").selectExpr("s", "m", "months_utc(at) AS n").collect()
        found |= {(r.s, r.m) for r in rows} | {(r.s, r.n) for r in rows}
    assert found == {(1754013600, 667), (-1, -1), (0, 0), (-2678400, -1), (-2678401, -2)}
