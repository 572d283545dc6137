"""Column -> Column helpers; all of them stay inside JVM codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The currency sign and thousands mark found in price text.
CURRENCY_MARKS = "[₹,]"
# What counts as a number once those marks are gone.  Spark's own cast would
# also take "12d", "NaN" and "Infinity", none of which is a price.
NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def price_to_number(c: Column | str) -> Column:
    """Price text (``₹1,299``) to double; null when it is not a number."""
    bare = F.regexp_replace(_col(c).cast("string"), CURRENCY_MARKS, "")
    return F.when(bare.rlike(NUMBER), bare.try_cast("double"))


def price_similarity(a: Column | str, b: Column | str) -> Column:
    """1 - |a-b| / max(a,b); 1 when neither price is positive."""
    a, b = _col(a), _col(b)
    top = F.greatest(a, b)
    return F.when(
        a.isNotNull() & b.isNotNull(),
        F.when(top > 0, 1 - F.abs(a - b) / top).otherwise(F.lit(1.0)),
    )


def like_pattern(pattern: str) -> str:
    """A pattern without ``%`` means "contains"."""
    return pattern if "%" in pattern else f"%{pattern}%"


def matches_like(c: Column | str, pattern: str) -> Column:
    """Case-insensitive LIKE."""
    return _col(c).ilike(like_pattern(pattern))


def matches_regex(c: Column | str, pattern: str) -> Column:
    """Case-insensitive, unanchored regex; ``%`` carries no meaning here."""
    return _col(c).rlike("(?i)" + pattern.replace("%", ""))
