"""Text cleaning.

Null policy: a null input stays null in every function here.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for the same results.
# Sex labels (after strip + lower) and their code; anything else falls back to
# its first letter, upper-cased.
SEX_LABELS = {"homme": "H", "femme": "F", "h": "H", "f": "F", "m": "H"}
# Electrification labels; the match is exact (case and accents count), any
# other value becomes null.
ELECTRIFICATION_LABELS = {"Electrifiée": True, "Non électrifiée": False}

# A run of letters, or a run of anything else.  Splitting on it lets title
# case treat every non-letter (hyphen, apostrophe, digit, blank) as a word
# boundary, as Python's str.title does, where initcap only splits on blanks.
_WORD_RUNS = r"(\p{L}+|[^\p{L}]+)"
# White space at either end, Unicode-aware (a no-break space counts), like
# Python's str.strip(); Spark's trim only removes the blank character.
_EDGE_WS = r"(?U)^\s+|\s+$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: Column | str) -> Column:
    """Strip Unicode white space at both ends."""
    return F.regexp_replace(_col(c), _EDGE_WS, "")


def title_case(c: Column | str) -> Column:
    """Upper-case the first letter of every run of letters and lower-case the
    rest; non-letters are kept as they are (F1 core).

    ``saint-étienne`` -> ``Saint-Étienne``, ``d'ascq`` -> ``D'Ascq``,
    ``3rd`` -> ``3Rd``.
    """
    runs = F.regexp_extract_all(_col(c), F.lit(_WORD_RUNS), 1)
    cased = F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)),
                                                 F.lower(F.substring(r, 2, 2 ** 31 - 1))))
    return F.when(_col(c).isNotNull(), F.array_join(cased, ""))


def normalize_city(c: Column | str) -> Column:
    """strip white space, then title case."""
    return title_case(strip_ws(c))


def first_letter(c: Column | str) -> Column:
    return F.upper(F.substring(strip_ws(c), 1, 1))


def map_with_fallback(c: Column | str, mapping: Mapping[str, str],
                      fallback: Column | None = None) -> Column:
    """F2 generic: look up ``lower(strip(c))`` in a literal map; when absent,
    use ``fallback`` (default: the first letter, upper-cased)."""
    lit_map = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    key = F.lower(strip_ws(c))
    fb = first_letter(c) if fallback is None else fallback
    return F.coalesce(F.try_element_at(lit_map, key), fb)


def normalize_sex(c: Column | str) -> Column:
    """sex label to H / F, else the first letter upper-cased."""
    return map_with_fallback(c, SEX_LABELS)


def label_to_bool(c: Column | str, labels: Mapping[str, bool] | None = None) -> Column:
    """exact two-label match to a boolean; anything else is null."""
    labels = ELECTRIFICATION_LABELS if labels is None else labels
    out = None
    for label, value in labels.items():
        out = (F.when(_col(c) == label, F.lit(value)) if out is None
               else out.when(_col(c) == label, F.lit(value)))
    return out
