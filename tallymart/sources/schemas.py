"""What changed between two schemas, by column name, and rows of one in the shape of another."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.operators.rules import quoted

SAME, ADDED, DROPPED, WIDENED, INCOMPATIBLE = "same", "added", "dropped", "widened", "incompatible"

# Digits that whole-number types hold.
DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


class SchemaError(ValueError):
    """The new schema cannot stand for the old one."""


@dataclass(frozen=True)
class Change:
    kind: str
    column: str
    old: T.DataType | None = None
    new: T.DataType | None = None

    @property
    def fits(self) -> bool:
        return self.kind != INCOMPATIBLE

    def __str__(self) -> str:
        types = [t.simpleString() for t in (self.old, self.new) if t is not None]
        return f"{self.kind} {self.column} ({' -> '.join(types)})"


@dataclass(frozen=True)
class Shape:
    """Defaults of columns that older rows lack."""

    defaults: dict[str, object] = field(default_factory=dict)


def widens(old: T.DataType, new: T.DataType) -> bool:
    """Whether every value of the old type is one of the new type, exactly."""
    if type(old) in DIGITS:
        if type(new) in DIGITS:
            return DIGITS[type(new)] > DIGITS[type(old)]
        if isinstance(new, T.DecimalType):
            return new.precision - new.scale >= DIGITS[type(old)]
        # a DOUBLE holds whole numbers of up to 15 digits, a FLOAT of up to 6
        return isinstance(new, T.DoubleType) and DIGITS[type(old)] <= 15 or (
            isinstance(new, T.FloatType) and DIGITS[type(old)] <= 6
        )
    if isinstance(old, T.FloatType):
        return isinstance(new, T.DoubleType)
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale and new != old
    if isinstance(old, T.DateType):
        return isinstance(new, T.TimestampNTZType)
    if isinstance(old, T.NullType):
        return True
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return all(c.fits and c.kind != DROPPED for c in compare(old, new)) and old != new
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return widens(old.elementType, new.elementType)
    return False


def compare(old: T.StructType, new: T.StructType) -> list[Change]:
    """One entry per column of either schema: in the new one's order, then those dropped.

    Order and nullability are no difference.  A column whose type neither stays nor widens is
    incompatible, and so are two columns whose names differ in case only.
    """
    before = {f.name: f.dataType for f in old.fields}
    after = {f.name: f.dataType for f in new.fields}
    folded = {n.lower(): n for n in before}
    out = []
    for name, kind in after.items():
        if name not in before:
            clash = folded.get(name.lower())
            out.append(Change(INCOMPATIBLE if clash else ADDED, name, before.get(clash), kind))
        elif _plain(before[name]) == _plain(kind):
            out.append(Change(SAME, name, before[name], kind))
        else:
            out.append(Change(WIDENED if widens(before[name], kind) else INCOMPATIBLE, name, before[name], kind))
    lower = {n.lower() for n in after}
    return out + [Change(DROPPED, n, t) for n, t in before.items() if n.lower() not in lower]


def _plain(kind: T.DataType) -> str:
    """A type without the nullability of its parts."""
    return kind.simpleString()


def shaped(df: DataFrame, schema: T.StructType, shape: Shape | None = None) -> DataFrame:
    """Rows of an older schema in the columns and types of ``schema``."""
    defaults = (shape or Shape()).defaults
    wrong = [c for c in compare(df.schema, schema) if not c.fits]
    if wrong:
        raise SchemaError("; ".join(map(str, wrong)))
    held = set(df.columns)
    return df.select(
        *[
            (F.col(quoted(f.name)) if f.name in held else F.lit(defaults.get(f.name))).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
