"""Operator registry: every operator is a plain ``DataFrame -> DataFrame`` function.

``@operator("name")`` records a function under a name; ``op("name", **params)``
gives the one-argument form that ``DataFrame.transform`` takes.  User code adds
its own operators the same way.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Operator:
    name: str
    func: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    params: tuple[str, ...]
    summary: str


_OPERATORS: dict[str, Operator] = {}


def operator(name: str, inputs: tuple[str, ...] = ("df",)) -> Callable:
    """Register a function; ``inputs`` names its DataFrame arguments."""

    def register(func: Callable) -> Callable:
        names = tuple(inspect.signature(func).parameters)
        if name in _OPERATORS:
            raise ValueError(f"operator {name!r} is already registered")
        _OPERATORS[name] = Operator(
            name=name,
            func=func,
            inputs=inputs,
            params=tuple(n for n in names if n not in inputs),
            summary=(inspect.getdoc(func) or "").split("\n")[0],
        )
        return func

    return register


def op(name: str, **params) -> Callable[[DataFrame], DataFrame]:
    """The operator as a one-argument function for ``DataFrame.transform``."""
    entry = _OPERATORS.get(name)
    if entry is None:
        raise KeyError(f"unknown operator {name!r}")
    return lambda df: entry.func(df, **params)


def operators() -> dict[str, Operator]:
    return dict(_OPERATORS)
