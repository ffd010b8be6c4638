"""The whole model tree as one lazy mapping."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame

from watchpost.functions.clock import AsOf
from watchpost.operators.staging import STAGING_MODELS
from watchpost.plans.marts import INPUTS, MARTS, WITHOUT_TOWER
from watchpost.sources.lazy import LazyTables

MODEL_NAMES = (*STAGING_MODELS, *MARTS)
DIMENSIONS = tuple(name for name in MARTS if name.startswith("dim_"))


class StarSchema(LazyTables):
    """``stg_*``, ``dim_*`` and ``fct_*`` over raw tables, planned on first access.

    A model may be replaced by a table that is already materialized (``ready``); the
    models built on it then read that table.  A model whose raw tables are missing is missing too.
    """

    def __init__(
        self,
        raw: Mapping[str, DataFrame],
        as_of: AsOf | datetime | str,
        ready: Mapping[str, DataFrame] | None = None,
    ):
        moment = AsOf.of(as_of)
        ready = ready or {}
        self._as_of, self._ready = moment, set(ready)
        staged = {f"stg_{name}" for name in raw}
        loaders = {name: partial(model, raw) for name, model in STAGING_MODELS.items() if name in staged}
        for name, model in MARTS.items():  # in an order in which inputs come first
            if all(source in loaders or source in ready for source in INPUTS[name]):
                loaders[name] = partial(model, self, moment)
        loaders |= {name: partial(ready.__getitem__, name) for name in ready}
        super().__init__(loaders)

    def without_tower(self, name: str) -> DataFrame:
        """A fact for a query that uses no column of the tower dimension: the written table, or
        the fact planned without that join."""
        return self[name] if name in self._ready else WITHOUT_TOWER[name](self, self._as_of)
