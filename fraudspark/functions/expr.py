"""Column expressions shared by the operators.

All of these are built-in Spark expressions (codegen friendly); none is a
Python UDF.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from fraudspark import schema as S

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_micros(col: str | Column) -> Column:
    """Microseconds since the epoch of a TIMESTAMP_NTZ (UTC wall clock).

    Independent of the session time zone, unlike a cast to TIMESTAMP.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), c)


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts).cast("bigint")


def day_of_week(ts: Column) -> Column:
    """Monday = 0 (Spark `weekday`; `dayofweek` would be Sunday = 1)."""
    return F.weekday(ts).cast("bigint")


def is_night(hour: Column) -> Column:
    return (hour >= S.NIGHT_START_HOUR) | (hour <= S.NIGHT_END_HOUR)


def is_weekend(dow: Column) -> Column:
    return dow >= S.SATURDAY


def direction(shap: Column) -> Column:
    """Sign of an attribution as a word."""
    return (
        F.when(shap > 0, F.lit("toward_fraud"))
        .when(shap < 0, F.lit("toward_genuine"))
        .otherwise(F.lit("neutral"))
    )


def ntz_from_micros(micros: Column) -> Column:
    """The TIMESTAMP_NTZ of microseconds since 1970, whatever the session's time zone."""
    seconds = (micros.cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def to_naive_utc(text: Column) -> Column:
    """Parse an ISO-8601 string to a naive UTC TIMESTAMP_NTZ.

    With an explicit offset (`Z`, `+02:00`, `+0200`, `+02`) the instant is
    converted to UTC; without one the wall clock is taken as UTC already. A
    plain cast to TIMESTAMP_NTZ would silently drop the offset. Text that is
    no timestamp gives null.
    """
    has_offset = text.rlike(r":\d{2}.*(Z|z|[+-]\d{2}(:?\d{2})?)$")
    full = F.regexp_replace(F.regexp_replace(text, r"(:\d{2}.*[+-]\d{2})$", "$1:00"),
                            r"(:\d{2}.*[+-]\d{2})(\d{2})$", "$1:$2")
    full = F.regexp_replace(full, "z$", "Z")
    as_utc = ntz_from_micros(F.unix_micros(full.try_cast("timestamp")))
    return F.when(has_offset, as_utc).otherwise(text.try_cast("timestamp_ntz"))


def sql_double(x: float) -> str:
    """A DOUBLE literal in Spark SQL (a bare 0.1 would be DECIMAL)."""
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def bucket_sql(value_sql: str, bounds: Sequence[float]) -> str:
    """SQL text of `bucket_of`: a balanced tree of CASE branches."""
    bounds = [float(b) for b in bounds]

    def build(lo: int, hi: int) -> str:
        if lo == hi:
            return str(lo)
        mid = (lo + hi) // 2
        return f"CASE WHEN {value_sql} < {sql_double(bounds[mid])} THEN {build(lo, mid)} ELSE {build(mid + 1, hi)} END"

    return f"CAST({build(0, len(bounds))} AS INT)"


def bucket_of(value: Column | str, bounds: Sequence[float]) -> Column:
    """Index of the range `value` falls in, for sorted `bounds`.

    Returns i with bounds[i-1] <= value < bounds[i] (0 below the first bound,
    len(bounds) at or above the last). Built as a balanced tree of CASE
    branches, so each row does log2(len(bounds)) comparisons inside codegen.
    `value` given as a column name / SQL text builds the tree in one call.
    """
    if isinstance(value, str):
        return F.expr(bucket_sql(value, bounds))
    bounds = list(bounds)

    def build(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value < F.lit(float(bounds[mid])), build(lo, mid)).otherwise(build(mid + 1, hi))

    return build(0, len(bounds)).cast("int")


_P = 2147483647  # 2^31 - 1
_MULTIPLIERS = (48271, 16807, 69621, 40692)
_FINISH = ((15, 69621), (13, 48271), (16, 16807))


def with_mix_hash(df, out: str, parts) -> "DataFrame":  # noqa: F821
    """Add `out` = a deterministic 31-bit integer mix of bigint inputs.

    A linear combination modulo 2^31-1 followed by three xor-shift/multiply
    rounds, each in its own projection so no sub-expression is duplicated.
    Only BIGINT multiply, modulo, shift and xor, all below 2^62, so a SQL
    engine reproduces it exactly (see `mix_hash_sql`).
    """
    lin = F.lit(12345).cast("bigint")
    for i, p in enumerate(parts):
        c = p if isinstance(p, Column) else F.lit(p).cast("bigint")
        lin = lin + F.pmod(c.cast("bigint"), F.lit(_P)) * F.lit(_MULTIPLIERS[i % len(_MULTIPLIERS)] + i)
    df = df.withColumn(out, F.pmod(lin, F.lit(_P)))
    for shift, mult in _FINISH:
        h = F.col(out)
        df = df.withColumn(out, F.pmod(h.bitwiseXOR(F.shiftright(h, shift)) * F.lit(mult), F.lit(_P)))
    return df


def mix_hash_sql(source: str, out: str, parts) -> str:
    """DuckDB spelling of `with_mix_hash`: a query adding column `out` to `source`."""
    terms = " + ".join(
        f"((CAST({p} AS BIGINT) % {_P} + {_P}) % {_P}) * {_MULTIPLIERS[i % len(_MULTIPLIERS)] + i}"
        for i, p in enumerate(parts))
    q = f"SELECT *, (12345 + {terms}) % {_P} AS {out} FROM ({source})"
    for k, (shift, mult) in enumerate(_FINISH):
        q = (f"SELECT * EXCLUDE ({out}), (xor({out}, {out} >> {shift}) * {mult}) % {_P} AS {out} "
             f"FROM ({q}) s{k}")
    return q


def _poisson1_cuts(scale: int = _P) -> list[int]:
    """Integer cut points of the Poisson(1) CDF on [0, scale)."""
    cuts, cdf, term = [], 0.0, math.exp(-1.0)
    for k in range(12):
        cdf += term
        cuts.append(int(cdf * scale))
        term /= k + 1
    return cuts


POISSON1_CUTS = _poisson1_cuts()


def poisson1_weight(u: Column) -> Column:
    """Poisson(1) draw from a uniform integer u in [0, 2^31-1): count of cuts <= u."""
    w = F.lit(0)
    for c in POISSON1_CUTS:
        w = w + F.when(u >= F.lit(c), 1).otherwise(0)
    return w.cast("bigint")


def poisson1_weight_sql(u: str) -> str:
    return "(" + " + ".join(f"(CASE WHEN {u} >= {c} THEN 1 ELSE 0 END)" for c in POISSON1_CUTS) + ")"


def int_key(df, name: str) -> Column:
    """A BIGINT key for hashing: integral ids as they are, other ids through
    Spark's xxhash64 (ids are STRING in the contract, BIGINT in test data)."""
    from pyspark.sql import types as T

    if isinstance(df.schema[name].dataType, T.IntegralType):
        return F.col(name).cast("bigint")
    return F.xxhash64(F.col(name))


def ntz_literal(v) -> Column:
    """A TIMESTAMP_NTZ literal from a datetime or ISO text, read as a UTC wall
    clock (a Python datetime literal would otherwise be shifted by the session
    time zone)."""
    text = v.isoformat(sep=" ") if hasattr(v, "isoformat") else str(v)
    return F.lit(text).cast("timestamp_ntz")
