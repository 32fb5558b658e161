"""Every operator as a named query over the driver's tables, with its SQL check."""


def load():
    """Import all query modules and return the registry."""
    from hetgraph.catalog import models_q, registry, sampling_q, serving_q, tables_q  # noqa: F401

    return registry
