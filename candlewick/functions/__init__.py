"""Column-expression helpers. All are built-in Spark expressions (codegen'd,
JVM-side); none is a UDF."""

from candlewick.functions.expr import (  # noqa: F401
    day_start_ms,
    epoch_ms,
    from_epoch_ms,
    guarded_log_ratio,
    hours_between,
    lit_ts,
    safe_divide,
)
