"""Paged feature services as a Spark data source; the transport is injected.

A transport is a class with ``info() -> dict``, ``page(offset, count) -> dict``, ``ids() -> list[int]`` and
``by_ids(list) -> dict``; it is named by an import path, so every task builds its own.
"""
from __future__ import annotations

import importlib
import json
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class FilePages:
    """Transport over a folder: ``info.json`` and ``features.json`` (offline caches and tests)."""

    def __init__(self, location: str):
        root = Path(location)
        self._info = json.loads((root / "info.json").read_text(encoding="utf-8"))
        self._features = json.loads((root / "features.json").read_text(encoding="utf-8"))

    def info(self) -> dict:
        return self._info

    def page(self, offset: int, count: int) -> dict:
        part = self._features[offset:offset + count]
        return {"features": part, "exceededTransferLimit": offset + len(part) < len(self._features)}

    def ids(self) -> list[int]:
        return [f["properties"]["OBJECTID"] for f in self._features]

    def by_ids(self, ids: list[int]) -> dict:
        wanted = set(ids)
        return {"features": [f for f in self._features if f["properties"]["OBJECTID"] in wanted]}


class _Batch(InputPartition):
    def __init__(self, offset: int | None, ids: list[int] | None, count: int, last: bool):
        self.offset, self.ids, self.count, self.last = offset, ids, count, last


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def _transport(self):
        module, name = self.options.get("transport", "zonaria.sources.paged.FilePages").rsplit(".", 1)
        return getattr(importlib.import_module(module), name)(self.options["location"])

    def partitions(self) -> list[InputPartition]:
        transport = self._transport()
        info = transport.info()
        if info.get("type") != "Feature Layer":
            raise ValueError(f"no es Feature Layer: {info.get('type')}")
        size = int(info.get("maxRecordCount") or 1000)
        total = info.get("count")
        if (info.get("advancedQueryCapabilities") or {}).get("supportsPagination"):
            if total is None:
                return [_Batch(0, None, size, True)]
            starts = list(range(0, max(int(total), 1), size))
            return [_Batch(s, None, size, s == starts[-1]) for s in starts]
        ids = sorted(transport.ids())
        return [_Batch(None, ids[i:i + size], size, False) for i in range(0, len(ids), size)]

    def read(self, partition: _Batch) -> Iterator[tuple]:
        transport = self._transport()
        offset = partition.offset
        while True:
            answer = transport.by_ids(partition.ids) if partition.ids is not None else transport.page(offset, partition.count)
            features = answer.get("features") or []
            for f in features:
                g = f.get("geometry") or {}
                props = {k: None if v is None else str(v) for k, v in (f.get("properties") or {}).items()}
                yield g.get("type"), json.dumps(g.get("coordinates")), props
            more = answer.get("exceededTransferLimit") or len(features) >= partition.count
            if partition.ids is not None or not partition.last or not features or not more:
                return
            offset += len(features)          # the announced count was too low (or absent): the last page goes on


class PagedFeatures(DataSource):
    """``spark.read.format("paged_features").option("location", …)``: one input partition per page or id batch."""

    @classmethod
    def name(cls) -> str:
        return "paged_features"

    def schema(self) -> str:
        return "geometry_type string, coordinates string, properties map<string,string>"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)
