"""Text normalisation as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Any Unicode white space plus the four ASCII separators, at either end.
_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def strip(c: Column) -> Column:
    """Remove white space of every kind from both ends (``trim`` only takes blanks)."""
    return F.regexp_replace(c, _EDGE_SPACE, "")


def normalize_code(c: Column) -> Column:
    """Strip and upper-case a code; null stays null."""
    return F.upper(strip(c))


def within_domain(c: Column, valid: Sequence[str], default: str) -> Column:
    """Keep ``c`` if it is a known code, else ``default``; null maps to ``default``."""
    return F.when(c.isin(*valid), c).otherwise(F.lit(default))


def canonical(c: Column, names: Sequence[str], default: str) -> Column:
    """Map a label to its canonical spelling, ignoring case and outer blanks.

    ``names`` is a fixed vocabulary of a few entries, so the lookup is a literal
    map inside the projection and needs no join.
    """
    lookup: Mapping[str, str] = {n.strip().lower(): n for n in names}
    literal = F.create_map(*[F.lit(x) for x in chain.from_iterable(lookup.items())])
    return F.coalesce(F.try_element_at(literal, F.lower(strip(c))), F.lit(default))
