"""Training-data operators. ``QUERIES`` and ``ORACLE_SQL`` are merged by the entry module.

Both are looked up when they are asked for: a Python worker of one operator doesn't load the others and their libraries.
"""

__all__ = ["ORACLE_SQL", "QUERIES"]


def __getattr__(name: str):
    if name in __all__:
        from lexcurate.llm import registry

        return getattr(registry, name)
    raise AttributeError(f"module {__name__!r} has no attribute {name!r}")
