"""Quality-flag expressions (flag label, quality score and boolean flags)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .core import col, flag_when, map_values

# Flag code -> label, in the order the reference lists them.
FLAG_LABELS = {
    "": "Official",
    "A": "Aggregate",
    "F": "FAO Estimate",
    "E": "Estimated",
    "P": "Provisional",
    "I": "Imputed",
    "T": "Unofficial",
    "C": "Calculated",
    "S": "Standardized",
    "R": "Mirror Estimate",
    "Q": "Questionnaire",
    "B": "Break in Series",
    "N": "Not Significant",
    "M": "Missing",
    "X": "International Organization",
}
FLAG_LABEL_DEFAULT = "Unknown"

# Flag code -> quality score 0-5; 'B' and unknown codes score NULL.
FLAG_SCORES = {
    "": 5, "Q": 5,
    "A": 4, "S": 4, "C": 4, "X": 4,
    "F": 3, "E": 3, "P": 3,
    "I": 2, "T": 2, "R": 2,
    "N": 1,
    "M": 0,
}

# Flag groups used by the boolean columns.
HIGH_QUALITY_FLAGS = ("", "Q", "A", "S", "C", "X")
ESTIMATED_FLAGS = ("E", "F", "I", "P")
ACCEPTED_FLAGS = tuple(FLAG_LABELS)


def flag_label(c) -> Column:
    return map_values(c, FLAG_LABELS, FLAG_LABEL_DEFAULT)


def flag_quality_score(c) -> Column:
    return map_values(c, FLAG_SCORES).cast("bigint")


def is_high_quality(c) -> Column:
    return flag_when(col(c).isin(*HIGH_QUALITY_FLAGS))


def is_missing(c) -> Column:
    return flag_when(col(c) == F.lit("M"))


def is_estimated(c) -> Column:
    return flag_when(col(c).isin(*ESTIMATED_FLAGS))


def is_mirror_trade(c) -> Column:
    return flag_when(col(c) == F.lit("R"))
