"""Domain views over the driver's tables and one registered query per operator."""


def all_queries():
    """Import every query module and return the registry."""
    import importlib
    import pkgutil

    from lendreach.checks import registry
    for m in sorted(x.name for x in pkgutil.iter_modules(__path__)):
        if m.startswith("q_"):
            importlib.import_module(f"{__name__}.{m}")
    return registry
