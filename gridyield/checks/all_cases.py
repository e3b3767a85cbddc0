"""All registered queries."""

from gridyield.checks import cases_calendar, cases_catalog, cases_grid, cases_jobs, cases_kernels, cases_storage, cases_time  # noqa: F401
from gridyield.checks.registry import ORACLES, QUERIES  # noqa: F401
