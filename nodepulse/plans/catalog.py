"""All registered queries: importing this module fills the registry."""

from . import queries_edges, queries_failures, queries_figures, queries_jobs, queries_nodes, queries_tables  # noqa: F401
from .registry import REGISTRY, Query  # noqa: F401
