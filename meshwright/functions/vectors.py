"""3-vector algebra on columns, kept inside generated code."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Vec(NamedTuple):
    x: Column
    y: Column
    z: Column

    @classmethod
    def of(cls, name: str | Column) -> "Vec":
        """The x, y, z fields of a struct column."""
        base = F.col(name) if isinstance(name, str) else name
        return cls(base["x"], base["y"], base["z"])

    def minus(self, other: "Vec") -> "Vec":
        return Vec(self.x - other.x, self.y - other.y, self.z - other.z)

    def plus(self, other: "Vec") -> "Vec":
        return Vec(self.x + other.x, self.y + other.y, self.z + other.z)

    def times(self, factor: Column) -> "Vec":
        return Vec(self.x * factor, self.y * factor, self.z * factor)

    def dot(self, other: "Vec") -> Column:
        return self.x * other.x + self.y * other.y + self.z * other.z

    def cross(self, other: "Vec") -> "Vec":
        return Vec(
            self.y * other.z - self.z * other.y,
            self.z * other.x - self.x * other.z,
            self.x * other.y - self.y * other.x,
        )

    def norm(self) -> Column:
        return F.sqrt(self.dot(self))

    def struct(self) -> Column:
        return F.struct(self.x.alias("x"), self.y.alias("y"), self.z.alias("z"))


def unit(vector: Vec, length: Column) -> Vec:
    """``vector / length``, or zero where the length is zero."""
    zero = F.lit(0.0)
    return Vec(*[F.when(length > 0.0, part / length).otherwise(zero) for part in vector])


def clean(value: Column, digits: int = 6) -> Column:
    """Round for reporting and fold negative zero into zero."""
    return F.round(value, digits) + F.lit(0.0)
