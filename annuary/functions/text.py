"""Column helpers for text whose whitespace rules follow Unicode, not only U+0020."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(c: Column) -> Column:
    """Remove Unicode white space at both ends; null stays null."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def collapse(c: Column) -> Column:
    """Runs of white space become one blank, ends are stripped."""
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


#: Fixed value: the running header of the printed pages, without white space.
RUNNING_HEADER = "AMERICANMENOFSCIENCE"


def squash(c: Column) -> Column:
    """All white space removed, then the running header of the printed pages."""
    return F.regexp_replace(F.regexp_replace(c, r"(?U)\s+", ""), f"(?i){RUNNING_HEADER}", "")


def blank_to_null(c: Column) -> Column:
    return F.when(strip(c) != "", c)


def null_to_blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def first_filled(*columns: Column) -> Column:
    """The first value that is neither null nor blank, returned as it was written."""
    return F.coalesce(*[blank_to_null(c) for c in columns])


def pipe_join(*chunks: Column) -> Column:
    """Split every chunk at semicolons, trim, drop blanks and join with ' | '; null if nothing is left."""
    parts = [F.coalesce(F.split(c, ";"), F.array().cast("array<string>")) for c in chunks]
    kept = F.filter(F.transform(F.concat(*parts), strip), lambda x: x != "")
    return F.when(F.size(kept) > 0, F.array_join(kept, " | "))


#: The four word-boundary repairs of a misread capital Z, as (pattern, replacement).
OCR_REPAIRS = [
    (r"\bsool\b", "zool"),
    (r"\bSool\b", "Zool"),
    (r"\bsoolog", "zoolog"),
    (r"\bSoolog", "Zoolog"),
]


def repair_ocr(c: Column) -> Column:
    for pattern, replacement in OCR_REPAIRS:
        c = F.regexp_replace(c, pattern, replacement)
    return c


def tokens(c: Column) -> Column:
    """Lower-case words; full stops, commas, semicolons and colons count as blanks."""
    return F.filter(F.split(F.regexp_replace(F.lower(c), "[.,;:]", " "), r"(?U)\s+"), lambda x: x != "")
