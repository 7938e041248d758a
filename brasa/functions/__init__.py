"""Column-expression helpers (all JVM-side, codegen friendly)."""
from brasa.functions.columns import (  # noqa: F401
    nan_to_null, cut, minutes_between, add_minutes, null_safe_least,
    lookup, parse_decimal_text, ratio_with_inf,
)
from brasa.functions.time import (  # noqa: F401
    hour_of, hour_cycle, month_cycle, period_of_day, diurnal_nocturnal, high_season,
)
from brasa.functions.text import normalise_header, team_code_v1, team_code_v2  # noqa: F401
