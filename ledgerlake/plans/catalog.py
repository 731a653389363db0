"""All registered queries of the library's own operators, with their SQL."""

from . import contracts, crosschecks, entities, indicators, integrity, jobs, normalisation, notice_trees, notices, pairing, readings, reports, run_reports, scalars, statistics, streams  # noqa: F401
from .base import ORACLE_SQL, QUERIES  # noqa: F401
