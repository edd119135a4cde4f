"""The set of tables a report run works on: stored tables plus the marts derived from them."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from fieldcast.operators.names import wildcard_flags

#: columns that serve as the pattern of an ILIKE join, by table
PATTERN_COLUMNS = {
    "tbsdeployed": ["deployment"],
    "deployments": ["deployment"],
    "packagesindeployment": ["contentpackage", "languagecode"],
    "contentinpackage": ["contentpackage", "categoryid", "contentid"],
    "playstatistics": ["contentpackage"],
    "categories": ["categoryname"],
    "contentmetadata2": ["title"],
    "recipients": ["language"],
}

Mart = Callable[["Tables"], DataFrame]
MARTS: dict[str, Mart] = {}


def mart(fn: Mart) -> Mart:
    """Register a function ``Tables -> DataFrame`` under its own name."""
    MARTS[fn.__name__] = fn
    return fn


class Tables(Mapping):
    """Name -> DataFrame.  A name that is not stored is built from its mart, lazily.

    A stored table wins over a mart of the same name, so once ``usage_info`` has been
    written, ``tables.with_table("usage_info", spark.read.parquet(...))`` makes every
    report below it read the stored copy.
    """

    def __init__(
        self, frames: Mapping[str, DataFrame | Callable[[], DataFrame]], flags: dict | None = None,
        names: Mapping[str, Callable[[], DataFrame]] | None = None,
    ):
        """``names`` has, for tables that are costly to make, a frame that holds every name of their pattern columns."""
        self._names = dict(names or {})
        self._frames = dict(frames)
        self._built: dict[str, DataFrame] = {}
        self._flags: dict[str, dict[str, bool]] = {} if flags is None else flags

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            if name in self._frames:
                source = self._frames[name]
                self._built[name] = source() if callable(source) else source
            elif name in MARTS:
                self._built[name] = MARTS[name](self)
            else:
                raise KeyError(name)
        return self._built[name]

    def __iter__(self):
        return iter({**self._frames, **MARTS})

    def __len__(self) -> int:
        return len({**self._frames, **MARTS})

    def stored(self, name: str) -> bool:
        return name in self._frames

    def with_table(self, name: str, frame: DataFrame) -> "Tables":
        """A copy in which ``name`` is the given frame; marts are rebuilt on top of it."""
        flags = {k: v for k, v in self._flags.items() if k != name}
        return Tables({**self._frames, name: frame}, flags, {k: v for k, v in self._names.items() if k != name})

    def wildcards(self, table: str, column: str) -> bool:
        """Whether names in a pattern column hold LIKE metacharacters; looked up once per table."""
        if table not in self._flags:
            holder = self._names[table]() if table in self._names else self[table]
            self._flags[table] = wildcard_flags(holder, PATTERN_COLUMNS[table])
        return self._flags[table][column]
