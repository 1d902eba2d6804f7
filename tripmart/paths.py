"""Where a table lives in the lake: a pure function of its coordinates."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

DROP_TABLES = frozenset({"trips", "trip_details", "drivers", "customers", "vehicles", "boundaries", "weather"})
LAYER_FOLDERS = {"raw": "raw", "input": "input", "enrich": "enrich", "system": "system"}
# Tables kept in a folder of their own inside a layer.
SPECIAL_FOLDERS = {
    ("raw", "boundaries"): "raw/boundaries",
    ("enrich", "located_trips"): "enrich/spatial",
    ("enrich", "weather_trips"): "enrich/weather",
}
SANDBOX = "sandbox"


@dataclass(frozen=True)
class Lake:
    """A lake root; a ``dev`` run keeps all its tables in a sandbox folder."""

    root: str
    runtype: str = "prod"

    def __post_init__(self):
        if self.runtype not in ("prod", "dev"):
            raise ValueError(f"runtype must be prod or dev, not {self.runtype!r}")

    @property
    def base(self) -> str:
        root = self.root.rstrip("/")
        return f"{root}/{SANDBOX}" if self.runtype == "dev" else root

    def drop(self, table: str, loadtype: str, date: dt.date | str | None = None) -> str:
        """CSV drop: every dated folder for a full load, one folder for a delta load."""
        if table not in DROP_TABLES:
            raise ValueError(f"table {table!r} has no drop folder")
        if loadtype == "full":
            folder = "*"
        elif loadtype == "delta":
            if date is None:
                raise ValueError("a delta load needs the date of its drop")
            folder = str(date)
        else:
            raise ValueError(f"loadtype must be full or delta, not {loadtype!r}")
        return f"{self.base}/drops/{folder}/{table}.csv"

    def boundary_file(self, name: str) -> str:
        if not name.endswith(".geojson"):
            raise ValueError(f"{name!r} is not a GeoJSON file")
        return f"{self.base}/{LAYER_FOLDERS['input']}/boroughs/{name}"

    def _folder(self, table: str, layer: str) -> str:
        if layer not in LAYER_FOLDERS:
            raise ValueError(f"unknown layer {layer!r}")
        return f"{self.base}/{SPECIAL_FOLDERS.get((layer, table), LAYER_FOLDERS[layer])}/{table}"

    def current(self, table: str, layer: str, fmt: str = "parquet") -> str:
        """The published table."""
        return f"{self._folder(table, layer)}/current/{table}.{fmt}"

    def snapshot(self, table: str, layer: str, date: dt.date | str) -> str:
        """The dated staging copy a publish reads back."""
        return f"{self._folder(table, layer)}/delta/{date}/{table}.parquet"
