"""How a module of the catalog names its queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable


def registry() -> tuple[dict, dict, Callable]:
    """Empty queries and oracles, and a decorator that fills them under the function's name."""
    queries: dict[str, Callable] = {}
    oracles: dict[str, str] = {}

    def registered(oracle: str | None = None) -> Callable:
        def add(fn: Callable) -> Callable:
            queries[fn.__name__] = fn
            if oracle is not None:
                oracles[fn.__name__] = oracle
            return fn

        return add

    return queries, oracles, registered
