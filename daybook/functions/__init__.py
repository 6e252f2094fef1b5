"""Column-level helpers (pure expressions, evaluated inside whole-stage codegen)."""

from daybook.functions.calendar import (  # noqa: F401
    UNITS,
    WindowSpec,
    contiguous_dates,
    is_valid_iso_date,
    period_end_dates,
    validate_window,
    window_bounds,
    window_predicate,
    window_size_bound,
)
