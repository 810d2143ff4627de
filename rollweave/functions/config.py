"""Layered settings: defaults, a base file, an environment's file, and variables, later ones over earlier ones."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce


def merged(*layers: Mapping) -> dict:
    """Later layers win; mappings merge, all else is replaced."""

    def over(low: Mapping, high: Mapping) -> dict:
        return dict(low) | {k: over(low[k], v) if isinstance(v, Mapping) and isinstance(low.get(k), Mapping) else v for k, v in high.items()}

    return reduce(over, layers, {})


def from_variables(variables: Mapping[str, str], prefix: str = "RW_", between: str = "__") -> dict:
    """RW_DB__HOST=x as {"db": {"host": "x"}}; a deeper name replaces a plain one."""
    out: dict = {}
    for name in variables:
        if name.startswith(prefix):
            value: object = variables[name]
            for part in reversed(name.removeprefix(prefix).lower().split(between)):
                value = {part: value}
            out = merged(out, value)  # type: ignore[arg-type]
    return out
