"""Column expressions; all built from ``pyspark.sql.functions`` (JVM-side, codegen-friendly)."""

from .exprs import (  # noqa: F401
    bucket_label,
    epoch_seconds_between,
    guarded_duration_sec,
    month_start,
    round_ratio,
    row_json,
    safe_ratio,
    struct_json,
    text_to_date,
    text_to_timestamp,
    title_case,
)
