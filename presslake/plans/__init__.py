"""Named queries (one per SURVEY §2 operator) and their DuckDB oracles."""

from presslake.plans.registry import ORACLE, OPERATOR, QUERIES  # noqa: F401


def load_all():
    """Import every query module so its queries register themselves."""
    from presslake.plans import q_corpus, q_extract, q_fn, q_nodes, q_pages, q_plan, q_sites, q_urls  # noqa: F401
    return QUERIES, ORACLE
