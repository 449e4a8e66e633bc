"""Mapping whose values (DataFrame definitions) are built on first access.

Building a DataFrame costs driver time (each operation is analysed), so the
layer maps only define the tables a query actually touches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from typing import Any


class LazyMap(Mapping):
    def __init__(self, keys: Iterable[str], build: Callable[[str], Any]):
        self._keys = list(keys)
        self._build = build
        self._built: dict[str, Any] = {}

    def __getitem__(self, key: str) -> Any:
        if key not in self._keys:
            raise KeyError(key)
        if key not in self._built:
            self._built[key] = self._build(key)
        return self._built[key]

    def __iter__(self) -> Iterator[str]:
        return iter(self._keys)

    def __len__(self) -> int:
        return len(self._keys)
