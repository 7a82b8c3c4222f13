"""Partition functions: hash bucket of a key, months since 1970.

The hash is 32-bit Murmur3 (x86, seed 0) over the UTF-8 bytes of a string or the
8 little-endian bytes of an integer. Spark's own `hash` does the byte work:

* `hash(SEED_ZERO, x)` hashes `x` with seed 0, because `hash(SEED_ZERO)` is 0 and
  each argument seeds the next;
* for whole 4-byte words Spark's hash is the standard one. A shorter last word is
  padded with zero bytes; then the steps that the standard hash does not apply to
  a last word are taken back.

They are SQL functions, so they also serve SQL text, and Catalyst expands them to
plain arithmetic inside generated code: no Python, no per-row call.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rowtide.model import q

# Fixed values of the hash: multipliers and offset, and the integer that Spark's hash maps to 0.
WORD_FACTOR = 5
WORD_OFFSET = 0xE6546B64
MIX_FACTOR_1 = 0x85EBCA6B
MIX_FACTOR_2 = 0xC2B2AE35
SEED_ZERO = -1693959553

MASK = 0xFFFFFFFF
SIGN_MASK = 0x7FFFFFFF


def _inverse(factor: int) -> int:
    return pow(factor, -1, MASK + 1)


FUNCTIONS = [
    # Products modulo 2^32 in two halves, which keeps them inside a BIGINT.
    f"""rt_times(a BIGINT, b BIGINT) RETURNS BIGINT
        RETURN (a * (b & 65535) + (((a * shiftright(b, 16)) & 65535) * 65536)) & {MASK}""",
    "rt_fold16(h BIGINT) RETURNS BIGINT RETURN h ^ shiftright(h, 16)",
    "rt_fold13(h BIGINT) RETURNS BIGINT RETURN h ^ shiftright(h, 13)",
    "rt_unfold13(h BIGINT) RETURNS BIGINT RETURN h ^ shiftright(h, 13) ^ shiftright(h, 26)",
    f"rt_right13(h BIGINT) RETURNS BIGINT RETURN (shiftright(h, 13) | (h * 524288)) & {MASK}",
    f"""rt_finish(h BIGINT) RETURNS BIGINT
        RETURN rt_fold16(rt_times(rt_fold13(rt_times(rt_fold16(h), {MIX_FACTOR_1})), {MIX_FACTOR_2}))""",
    f"""rt_unfinish(h BIGINT) RETURNS BIGINT
        RETURN rt_fold16(rt_times(rt_unfold13(rt_times(
            rt_fold16(h), {_inverse(MIX_FACTOR_2)})), {_inverse(MIX_FACTOR_1)}))""",
    "rt_padded(n INT) RETURNS INT RETURN CAST(n + 3 - (n + 3) % 4 AS INT)",
    f"""rt_hash_padded(s STRING) RETURNS BIGINT
        RETURN hash({SEED_ZERO}, rpad(CAST(s AS BINARY), rt_padded(octet_length(s)), X'00')) & {MASK}""",
    f"""rt_hash_odd(s STRING) RETURNS BIGINT
        RETURN rt_finish(octet_length(s) ^ rt_right13(rt_times(
            ((rt_unfinish(rt_hash_padded(s)) ^ rt_padded(octet_length(s))) - {WORD_OFFSET}) & {MASK},
            {_inverse(WORD_FACTOR)})))""",
    f"""rt_murmur3_string(s STRING) RETURNS BIGINT
        RETURN CASE WHEN s IS NULL THEN NULL
                    WHEN octet_length(s) % 4 = 0 THEN hash({SEED_ZERO}, s) & {MASK}
                    ELSE rt_hash_odd(s) END""",
    f"""rt_murmur3_long(v BIGINT) RETURNS BIGINT
        RETURN CASE WHEN v IS NOT NULL THEN hash({SEED_ZERO}, v) & {MASK} END""",
    f"rt_bucket_string(n INT, s STRING) RETURNS INT RETURN CAST((rt_murmur3_string(s) & {SIGN_MASK}) % n AS INT)",
    f"rt_bucket_long(n INT, v BIGINT) RETURNS INT RETURN CAST((rt_murmur3_long(v) & {SIGN_MASK}) % n AS INT)",
]

# What SQL text may call; the library itself only uses names that start with `rt_`.
PUBLIC_FUNCTIONS = {
    "murmur3_string": "(s STRING) RETURNS BIGINT RETURN rt_murmur3_string(s)",
    "murmur3_long": "(v BIGINT) RETURNS BIGINT RETURN rt_murmur3_long(v)",
    "bucket_string": "(n INT, s STRING) RETURNS INT RETURN rt_bucket_string(n, s)",
    "bucket_long": "(n INT, v BIGINT) RETURNS INT RETURN rt_bucket_long(n, v)",
    "months": "(ts TIMESTAMP_NTZ) RETURNS INT RETURN (year(ts) - 1970) * 12 + month(ts) - 1",
    "months_utc": "(ts TIMESTAMP) RETURNS INT RETURN {utc}",
}

_MICROS_PER_DAY = 86_400_000_000

# Sessions that hold the functions of this module, by session id.
_private: set[str] = set()
_public: set[str] = set()


def _session_id(spark: SparkSession) -> str:
    return spark._jsparkSession.sessionUUID()


def _utc_months(column: str) -> str:
    """Months of an instant in UTC, whatever the session's time zone."""
    micros = f"unix_micros({column})"
    day = f"date_from_unix_date(CAST(({micros} - pmod({micros}, {_MICROS_PER_DAY})) DIV {_MICROS_PER_DAY} AS INT))"
    return f"(year({day}) - 1970) * 12 + month({day}) - 1"


def _register_private(spark: SparkSession) -> None:
    if _session_id(spark) not in _private:
        for definition in FUNCTIONS:
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {definition}")
        _private.add(_session_id(spark))


def register_functions(spark: SparkSession, replace: bool = False) -> None:
    """Make `bucket_string(n, s)`, `bucket_long(n, v)`, `months(ts)` and `months_utc(ts)` available to SQL text.

    `months` takes timestamps without a time zone (and dates); `months_utc` takes instants. Functions
    of these names that the session has from elsewhere are only replaced when asked for.
    """
    _register_private(spark)
    foreign = [n for n in PUBLIC_FUNCTIONS if spark.catalog.functionExists(n)] if _session_id(spark) not in _public else []
    if foreign and not replace:
        raise ValueError(f"the session has other functions of these names: {foreign}")
    for name, definition in PUBLIC_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{definition.format(utc=_utc_months('ts'))}")
    _public.add(_session_id(spark))


def with_bucket(df: DataFrame, column: str, n: int, name: str | None = None) -> DataFrame:
    """Add the bucket number of `column` in [0, n); null stays null."""
    if n < 1:
        raise ValueError("the number of buckets must be positive")
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        function = "rt_bucket_string"
    elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        function = "rt_bucket_long"
    else:
        raise TypeError(f"no bucket for a column of type {kind.simpleString()}")
    _register_private(df.sparkSession)
    return df.withColumn(name or f"bucket_{column}", F.expr(f"{function}({n}, {q(column)})"))


def with_months(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Add the months from 1970-01 to `column`; earlier months are negative. Instants are taken in UTC."""
    months = f"(year({q(column)}) - 1970) * 12 + month({q(column)}) - 1"
    if isinstance(df.schema[column].dataType, T.TimestampType):
        months = _utc_months(q(column))
    return df.withColumn(name or f"month_{column}", F.expr(months))


def bucket_distribution(df: DataFrame, column: str, n: int) -> DataFrame:
    """Number of rows per bucket."""
    return with_bucket(df.select(q(column)), column, n, "bucket").groupBy("bucket").agg(F.expr("count(*) AS n"))
