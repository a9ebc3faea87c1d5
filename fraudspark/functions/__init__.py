"""Column-expression helpers. Everything here stays JVM-side."""

from fraudspark.functions.expr import (  # noqa: F401
    bucket_of,
    direction,
    epoch_micros,
    is_night,
    is_weekend,
    with_mix_hash,
    poisson1_weight,
    to_naive_utc,
)
