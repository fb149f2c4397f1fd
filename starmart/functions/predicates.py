"""Row predicates used by the cleaning, SCD and fact steps."""

from __future__ import annotations

import unicodedata
from functools import lru_cache, reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

CANCELLED = "CANCELLED"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c) -> Column:
    """``x IS NULL OR TRIM(x) = ''``. ``trim`` strips spaces only, so a tab
    is not blank."""
    col = _c(c)
    return col.isNull() | (F.trim(col) == F.lit(""))


def any_changed(old: str, new: str, columns, collation: str | None = None) -> Column:
    """True when any attribute differs between the ``old`` and ``new`` side,
    treating NULL and ``''`` as equal: OR over ``COALESCE(o,'') <>
    COALESCE(n,'')``. Deliberately not ``~eqNullSafe``. With ``collation``
    (e.g. ``"UNICODE_CI_AI"``) the strings compare under that collation."""
    def side(prefix, c):
        v = F.coalesce(F.col(f"{prefix}.{c}").cast("string"), F.lit(""))
        return F.collate(v, collation) if collation else v

    return reduce(or_, [side(old, c) != side(new, c) for c in columns])


def not_cancelled(status="status") -> Column:
    """``status <> 'CANCELLED'`` (a NULL status is excluded, as in SQL)."""
    return _c(status) != F.lit(CANCELLED)


@lru_cache(maxsize=1)
def _bases() -> tuple[str, str]:
    """Small letters with marks, and the letters without: by Unicode's own
    decomposition, for the scripts below U+2000 (Latin, Greek, Cyrillic and so on)."""
    pairs = []
    for code in range(0xC0, 0x2000):
        c = chr(code)
        plain = "".join(x for x in unicodedata.normalize("NFD", c) if not unicodedata.combining(x))
        if len(plain) == 1 and plain != c and c == c.lower():
            pairs.append((c, plain))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def folded(c) -> Column:
    """A string without case and accents (``É`` as ``e``), itself an ordinary
    string: it groups and joins by hash, as a collated one does not."""
    return F.regexp_replace(F.translate(F.lower(_c(c)), *_bases()), r"\p{M}+", "")
