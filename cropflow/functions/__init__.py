"""Column expressions: `Column -> Column`, all built-in Spark functions."""

from . import areas, core, flags, kpi  # noqa: F401
