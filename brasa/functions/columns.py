"""Generic column expressions.

Null rules (pandas semantics reproduced on Spark):
* NaN is normalised to NULL at sources and after risky arithmetic;
* ``np.minimum`` propagates missing values, Spark ``least`` skips them;
* ``pd.cut`` gives missing for values outside every bin.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    c = _c(c)
    return F.when(~F.isnan(c), c)


def cut(c, bins: Sequence[float], labels: Sequence[str], right: bool = False) -> Column:
    """Bin a numeric column like ``pd.cut``: outside/NULL -> NULL.

    ``right=False`` means intervals ``[b_i, b_{i+1})``.
    """
    c = _c(c)
    if len(labels) != len(bins) - 1:
        raise ValueError("labels must have len(bins) - 1 entries")
    expr = None
    for lo, hi, lab in zip(bins[:-1], bins[1:], labels):
        if right:
            cond = (c > F.lit(float(lo))) & (c <= F.lit(float(hi)))
        else:
            cond = (c >= F.lit(float(lo))) & (c < F.lit(float(hi)))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    # NaN never falls in a bin
    return F.when(c.isNotNull() & ~F.isnan(c), expr)


def minutes_between(start, end) -> Column:
    """(end - start) in fractional minutes; microsecond exact."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / F.lit(60_000_000.0)


def add_minutes(ts, minutes) -> Column:
    return F.timestamp_add("MINUTE", _c(minutes) if not isinstance(minutes, int) else F.lit(minutes), _c(ts))


def null_safe_least(a, b) -> Column:
    """``np.minimum``: missing if either side is missing."""
    a, b = _c(a), _c(b)
    return F.when(a.isNotNull() & b.isNotNull(), F.least(a, b))


def lookup(c, mapping: Mapping, default=None) -> Column:
    """Literal dictionary recode (a tiny in-expression hash map, no join)."""
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    v = F.try_element_at(m, _c(c))
    return v if default is None else F.coalesce(v, F.lit(default))


def parse_decimal_text(c, strip: Sequence[str] = ()) -> Column:
    """European decimal text (``1.234,56``) -> double; bad text -> NULL."""
    s = _c(c).cast("string")
    for token in strip:
        s = F.replace(s, F.lit(token), F.lit(""))
    s = F.replace(s, F.lit("."), F.lit(""))
    s = F.replace(s, F.lit(","), F.lit("."))
    return nan_to_null(F.trim(s).try_cast("double"))


def ratio_with_inf(num, den) -> Column:
    """num / den with IEEE semantics for den == 0 (±inf, NaN -> NULL)."""
    num, den = _c(num), _c(den)
    return (
        F.when(num.isNull() | den.isNull(), F.lit(None).cast("double"))
        .when(den != 0, num / den)
        .when(num > 0, F.lit(float("inf")))
        .when(num < 0, F.lit(float("-inf")))
        .otherwise(F.lit(None).cast("double"))
    )


def require(df, ok, message):
    """Fail the job on the first row where ``ok`` is not true.  A filter, so that no
    column pruning above it can drop the check."""
    message = F.lit(message) if isinstance(message, str) else message
    return df.where(F.when(ok, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
