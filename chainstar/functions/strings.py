"""String cleaning, bounded strings and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for equal results:
# the prefix hashed into every surrogate key, the id and the text of the
# default ("unknown") dimension member.
SURROGATE_SALT = "surrogate"
UNKNOWN_ID = "0"
UNKNOWN_TEXT = "[Unknown]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c: Column | str) -> Column:
    """``trim(x::varchar)``; strips blanks only, as PostgreSQL does."""
    return F.trim(_col(c).cast("string"))


def bounded(c: Column | str, n: int) -> Column:
    """``x::varchar(n)``; PostgreSQL cuts longer text to n characters."""
    return F.substring(_col(c).cast("string"), 1, n)


def surrogate_key(*cols: Column | str, salt: str = SURROGATE_SALT) -> Column:
    """``md5(salt || key [|| key2 ...])`` as lower-case hex.

    NULL in, NULL out (``||`` with NULL is NULL).  Being a pure function of
    the natural key, the id can be recomputed anywhere instead of looked up.
    """
    return F.md5(F.concat(F.lit(salt), *[_col(c).cast("string") for c in cols]))


def default_text(c: Column | str, text: str = UNKNOWN_TEXT) -> Column:
    """``coalesce(x, '[Unknown]')``."""
    return F.coalesce(_col(c), F.lit(text))


def any_true(*flags: Column | str) -> Column:
    """``case when a = true or b = true then true else false end``."""
    out = None
    for f in flags:
        term = F.coalesce(_col(f) == F.lit(True), F.lit(False))
        out = term if out is None else (out | term)
    return out
