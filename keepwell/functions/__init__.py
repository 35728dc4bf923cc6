"""Column expressions shared by the operators (all JVM-side, codegen friendly)."""

from keepwell.functions.columns import (  # noqa: F401
    days_between,
    epoch_micros,
    event_id_expr,
    geographic_segment,
    is_positive_purchase,
    pseudonymize,
)
