"""Published column lists. Every mart ends in ``Contract.publish``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Contract:
    """An ordered list of (column, type) that a published frame must have, no more and no less."""

    def __init__(self, *columns: tuple[str, str]):
        self.columns = columns

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.columns]

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in self.columns))

    @property
    def wide(self) -> Contract:
        """The same columns with room for totals over very large tables.

        A contract's own types suit its own volumes; a sum past them raises instead of wrapping.
        """
        return Contract(*[(n, _widened(t)) for n, t in self.columns])

    def publish(self, df: DataFrame, wide: bool = False) -> DataFrame:
        columns = self.wide.columns if wide else self.columns
        return df.select([F.col(n).cast(t).alias(n) for n, t in columns])


def _widened(type_: str) -> str:
    if type_ == "int":
        return "bigint"
    if type_.startswith("decimal("):
        return f"decimal(28,{type_.rstrip(')').split(',')[1]})"
    return type_
