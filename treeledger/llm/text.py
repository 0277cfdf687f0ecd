"""Expressions that several operators share."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word is a run of characters other than these (ASCII white space).
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE + "+"), lambda w: w != "")


def crc_fold(column: str, folds: int) -> Column:
    """``crc32(id as text) mod folds``; null for a null id."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(folds))


def let(value: Column, body) -> Column:
    """``body(value)``, with ``value`` computed once for all its uses."""
    return F.transform(F.array(value), body)[0]


def unused(frame, stem: str) -> str:
    """A column name that ``frame`` does not have, whatever its case."""
    taken = {c.lower() for c in frame.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name


WORD_BYTES = re.compile(rb"[^\x20\x09-\x0D]+")
