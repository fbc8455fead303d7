"""Column-expression helpers (all JVM-side, codegen friendly; no Python UDFs)."""

from sparkfolio.functions.arith import (  # noqa: F401
    add, div, eps_ratio, mul, round_half, scale, sigmoid_dot, sub,
)
from sparkfolio.functions.calendar import (  # noqa: F401
    WEEKDAYS, hour_of_day, weekday_name, weekday_ord,
)
from sparkfolio.functions.coerce import (  # noqa: F401
    accounting_number, multi_format_timestamp, python_float, to_date_safe,
    to_number, try_num, yes_no_flag, zero_pad,
)
