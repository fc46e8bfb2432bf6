"""All registered queries: importing this module fills the registry."""

from . import q_aggregates, q_columns, q_filters, q_history, q_joins, q_polygons, q_rasters, q_windows  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401

# Names that once read a part of their tables run the whole job that name_all names: all vectors, and windows over the table's own range of dates.
for _name in [n for n in QUERIES if n.endswith("_all")]:
    QUERIES[_name.removesuffix("_all")], ORACLES[_name.removesuffix("_all")] = QUERIES[_name], ORACLES[_name]
