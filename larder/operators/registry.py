"""X1 — named DataFrame transforms plugged between the bronze read and the silver write.

Each transform is ``fn(df) -> DataFrame``; tables name theirs in the contracts
(``larder.contracts.SILVER_TRANSFORM``). The contracts' own transforms drop rows without
the columns they require and de-duplicate; others register with ``@transform``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..contracts import TRANSFORM_REQUIRES
from .relational import dedup_rows, not_null

Transform = Callable[[DataFrame], DataFrame]
TRANSFORMS: dict[str, Transform] = {}


def transform(name: str) -> Callable[[Transform], Transform]:
    def register(fn: Transform) -> Transform:
        TRANSFORMS[name] = fn
        return fn
    return register


def get_transform(name: str) -> Transform:
    try:
        return TRANSFORMS[name]
    except KeyError:
        raise KeyError(f"unknown transform {name!r}; known: {sorted(TRANSFORMS)}") from None


def apply_transform(df: DataFrame, name: str) -> DataFrame:
    return df.transform(get_transform(name))


def _clean(required: tuple[str, ...]) -> Transform:
    return lambda df: dedup_rows(not_null(df, *required))


for _name, _required in TRANSFORM_REQUIRES.items():
    transform(_name)(_clean(_required))
