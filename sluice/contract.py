"""Schema contracts: explicit fields plus the rules every row must satisfy.

A contract is data, not code: the reader schema, the row rules and the reject
messages are all generated from it, so the documented contract and the checks
cannot drift apart (one rule per declared-required column).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class RangeRule:
    """Inclusive ``[low, high]``; checked only when the value is present."""

    column: str
    low: float
    high: float
    message: str | None = None

    def text(self) -> str:
        return self.message or f"{self.column} out of range"


@dataclass(frozen=True)
class Period:
    """Half-open ``[start, end)`` on a timestamp column; checked when present."""

    column: str
    start: str
    end: str
    message: str | None = None

    def text(self) -> str:
        return self.message or f"{self.column} outside period"


@dataclass(frozen=True)
class SameDay:
    """``date_column`` must equal ``to_date(ts_column)`` when both are present."""

    date_column: str
    ts_column: str
    message: str | None = None

    def text(self) -> str:
        return self.message or f"{self.date_column} mismatch"


@dataclass(frozen=True)
class Contract:
    fields: T.StructType
    key: tuple[str, ...] = ()
    # Required columns in rule order; those also in ``blank`` fail on NULL or
    # on text that trims to ''.
    required: tuple[str, ...] = ()
    blank: tuple[str, ...] = ()
    same_day: tuple[SameDay, ...] = ()
    period: Period | None = None
    ranges: tuple[RangeRule, ...] = ()
    corrupt_column: str | None = "_corrupt_record"
    messages: dict = field(default_factory=dict)
    # ``trim`` strips spaces only, so a key made of a tab is not blank; set
    # this to treat any whitespace-only text as blank.
    blank_whitespace: bool = False

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields.fields]

    def dtype(self, name: str) -> T.DataType:
        return self.fields[name].dataType

    def read_schema(self) -> T.StructType:
        """Contract fields plus the corrupt-record column for a permissive read."""
        extra = [T.StructField(self.corrupt_column, T.StringType())] if self.corrupt_column else []
        return T.StructType(list(self.fields.fields) + extra)

    def message(self, kind: str, column: str | None = None) -> str:
        default = {
            "corrupt": "row not parsed",
            "missing": f"{column} missing",
            "blank": f"{column} blank",
        }[kind]
        return self.messages.get((kind, column), default)
