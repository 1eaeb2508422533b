"""All registered queries of the reference's own operators, with their SQL twins."""

from tallyframe.plans import (  # noqa: F401
    access_queries,
    evidence_queries,
    file_queries,
    grid_queries,
    aggregate_queries,
    join_queries,
    misc_queries,
    panel_queries,
    rank_queries,
    scalar_queries,
    score_queries,
    structure_queries,
    summary_queries,
    vote_queries,
)
from tallyframe.plans.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
