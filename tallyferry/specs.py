"""What to move: table specs, settings and the rules that need no data."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from datetime import datetime

STAMP = "%Y-%m-%d %H:%M:%S"


class MoveError(Exception):
    """Base of the errors a move can end in."""


class ModeConflict(MoveError):
    """A sample size and a date window were both asked for."""


class MissingInput(MoveError):
    """A table has no directory of files to load."""


class TooManyBadRows(MoveError):
    """A load met more malformed rows than its budget."""


@dataclass(frozen=True)
class TableSpec:
    """One table: its name and the columns that steer the move.

    ``partition_col`` orders chunks and samples, ``date_col`` carries date
    windows (None: the table is always moved whole), ``key_cols`` identify a
    row when two copies are compared cell by cell. ``target_name`` is set when
    the copy has another name, ``sample_window`` when samples of this table are
    a fixed date window instead of its newest keys. With ``sample_floor`` a sample's keys
    are ranked among the rows dated after the oldest of the 3n newest keys only.
    """

    name: str
    partition_col: str | None = None
    date_col: str | None = None
    key_cols: tuple[str, ...] = ()
    target_name: str | None = None
    sample_window: "Window | None" = None
    sample_floor: bool = False

    @property
    def target(self) -> str:
        return self.target_name or self.name


@dataclass(frozen=True)
class Window:
    """Half-open date window ``[start, end)``; either end may be open.

    Ends are kept as canonical text, so unpadded input compares like a date.
    """

    start: str | None = None
    end: str | None = None

    def __post_init__(self) -> None:
        for name in ("start", "end"):
            text = getattr(self, name)
            if text is not None:
                object.__setattr__(self, name, str(datetime.strptime(text, STAMP)))
        if self.start is not None and self.end is not None and self.start >= self.end:
            raise ValueError(f"the window is empty: {self.start} is not before {self.end}")

    def __bool__(self) -> bool:
        return self.start is not None or self.end is not None

    @property
    def weeks(self) -> float:
        """Length in weeks, -1 while an end is open."""
        if self.start is None or self.end is None:
            return -1.0
        span = datetime.strptime(self.end, STAMP) - datetime.strptime(self.start, STAMP)
        return span.total_seconds() / 604800


@dataclass(frozen=True)
class Settings:
    """How to move. Defaults are the fixed values of the tool being replaced.

    ``escape_breaks`` keeps a row on one line: line breaks and backslashes in text
    are written as ``\\n``, ``\\r`` and ``\\\\`` and read back. Turn it off for files of
    other writers that mean backslashes as they stand.
    """

    chunk_mb: float = 5000
    whole_table_mb: int = 10000
    windowed_table_mb: int = 20000
    window_weeks: int = 150
    chunking: bool = False
    compression: str | None = "gzip"
    separator: str = "\t"
    null_marker: str = ""
    max_bad_rows: int = 1000
    files_per_batch: int = 100
    escape_breaks: bool = True
    idempotent: bool = True


@dataclass(frozen=True)
class JobSpec:
    """The tables of one job."""

    tables: tuple[TableSpec, ...] = field(default_factory=tuple)

    @classmethod
    def from_mapping(
        cls,
        objects: Mapping[str, Iterable[str]],
        date_cols: Mapping[str, str] | None = None,
        key_cols: Mapping[str, tuple[str, ...]] | None = None,
        undated: Iterable[str] = (),
        default_date_col: str | None = None,
    ) -> "JobSpec":
        """Build from ``{"tables": [...], "partitioning_columns": [...]}``.

        Tables are ``schema.table``; partitioning columns ``schema.table.column``.
        ``date_cols`` gives the date column per schema, ``undated`` the tables
        that are never cut by date.
        """
        cut = {}
        for dotted in objects.get("partitioning_columns", ()):
            table, _, column = dotted.rpartition(".")
            cut[table] = column
        no_dates = set(undated)
        specs = []
        for name in objects["tables"]:
            schema = name.split(".")[0]
            date_col = (date_cols or {}).get(schema, default_date_col)
            specs.append(
                TableSpec(
                    name=name,
                    partition_col=cut.get(name),
                    date_col=None if name in no_dates else date_col,
                    key_cols=(key_cols or {}).get(name, ()),
                )
            )
        return cls(tuple(specs))


def check_mode(sample_size: int, window: Window | None) -> None:
    """A sample and a date window exclude each other."""
    if sample_size > 0 and window:
        raise ModeConflict("give either a sample size or a date window, not both")


def moves_in_one_piece(size_mb: float, weeks: float, settings: Settings) -> bool:
    """Whether a table is small enough, or its window short enough, to skip chunking."""
    if not settings.chunking:
        return True
    short_window = size_mb < settings.windowed_table_mb and 0 < weeks < settings.window_weeks
    return short_window or size_mb < settings.whole_table_mb
