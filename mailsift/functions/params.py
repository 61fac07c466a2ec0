"""Parameter normalisers (S3, S4) as column expressions.

Configuration in the source tool comes from environment strings; here the
same normalisation runs over columns so term lists and flags can live in
tables (one row per mailbox, per user, per run ...).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from mailsift.functions._util import as_col
from mailsift.functions.text import ustrip

# The lower-cased spellings that count as a true flag.
TRUE_SPELLINGS = ("true", "1", "yes", "on")

# The default keyword list of the source tool's configuration
# (used by the command line when no --keywords are given).
DEFAULT_TERMS = "electrolyte, lithium, battery, solid-state, ion-conductor, solid electrolyte, diffusion, ion transport"  # noqa: E501


def normalise_terms(c) -> Column:
    """S3: split on ``,``, strip, lower-case, drop blanks; order and repeats kept."""
    parts = F.split(as_col(c), ",", -1)
    cleaned = F.transform(parts, lambda x: F.lower(ustrip(x)))
    return F.filter(cleaned, lambda x: x != F.lit(""))


def normalise_term_list(terms: Iterable[str] | str | None) -> list[str]:
    """Driver-side twin of S3 for a literal parameter (a handful of strings)."""
    if terms is None:
        return []
    if isinstance(terms, str):
        terms = terms.split(",")
    return [t.strip().lower() for t in terms if t.strip()]


def parse_flag(c, default: bool = False) -> Column:
    """Lower-cased value in {true, 1, yes, on}; no trim; null -> default."""
    v = F.lower(F.coalesce(as_col(c), F.lit(str(default))))
    return v.isin(*TRUE_SPELLINGS)
