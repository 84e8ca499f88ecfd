"""Area-code classification."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from .core import col, flag_when


def area_type(c) -> Column:
    """<1000 Country, >=5000 Global/Major Region, else (NULL too) Sub-Regional Group."""
    c = col(c)
    return (F.when(c < 1000, F.lit("Country"))
            .when(c >= 5000, F.lit("Global/Major Region"))
            .otherwise(F.lit("Sub-Regional Group")))


def is_country(c, cfg: Config = DEFAULT) -> Column:
    """A bare comparison, so the filter built on it reaches the Parquet scan."""
    return flag_when(col(c) < cfg.country_area_code_max)
