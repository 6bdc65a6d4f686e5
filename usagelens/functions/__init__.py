"""Column-expression helpers shared by the operators (all JVM-side)."""
from usagelens.functions.core import (  # noqa: F401
    as_ts, attach, keep_first, month_start, nz, round_doubles, round_exact, round_half_even, safe_div,
    week_start, whole_days,
)
