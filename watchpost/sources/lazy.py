"""A mapping of names to DataFrames that are only planned when somebody asks."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame


class LazyTables(Mapping[str, DataFrame]):
    """``name -> DataFrame``; each loader runs once, on first access."""

    def __init__(self, loaders: Mapping[str, Callable[[], DataFrame]]):
        self._loaders = dict(loaders)
        self._planned: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._planned:
            self._planned[name] = self._loaders[name]()
        return self._planned[name]

    def __contains__(self, name: object) -> bool:
        """Whether there is such a table; nothing is planned for the answer."""
        return name in self._loaders

    def __iter__(self) -> Iterator[str]:
        return iter(self._loaders)

    def __len__(self) -> int:
        return len(self._loaders)
