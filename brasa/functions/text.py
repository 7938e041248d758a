"""Text rules: header normalisation and response-team codes."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalise_header(name: str) -> str:
    """strip -> whitespace runs to '_' -> upper case (driver-side, names only)."""
    return re.sub(r"\s+", "_", name.strip()).upper()


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# FIXED VALUES: team-code rewrite rules, applied in this order.
# variant 1: H<n> -> BHA<n>; A<n> -> AA<n>; B<n>... -> BA<n>
# variant 2: BHA-<n>... -> BHA<n>; AA<n>... -> AA<n>; BA<n>... -> BA<n>
def team_code_v1(c) -> Column:
    s = _c(c).cast("string")
    s = F.regexp_replace(s, r"^H(\d+)\b", "BHA$1")
    s = F.regexp_replace(s, r"^A(\d+)\b", "AA$1")
    return F.regexp_replace(s, r"^B(\d+)\b.*", "BA$1")


def team_code_v2(c) -> Column:
    s = _c(c).cast("string")
    s = F.regexp_replace(s, r"^(BHA-(\d+)).*$", "BHA$2")
    s = F.regexp_replace(s, r"^(AA\d+).*$", "$1")
    return F.regexp_replace(s, r"^(BA\d+).*$", "$1")
