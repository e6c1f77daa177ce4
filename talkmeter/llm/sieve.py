"""A bitmap of hashed keys that fits every task: rows without a key are told apart before a shuffle.

The bitmap has ``ROOM`` bits per key, from ``PAGE`` to ``MOST`` (8 MB) in all, so what is sent to the tasks is
bounded. A row whose bit is clear has none of the keys for certain; a row whose bit is set has one or shares
its bit with one, so an exact step must follow. A table with so many keys that most bits are set loses
the gain and nothing else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkmeter.llm.common import staged

PAGE = 32_768  # bits in one row of bitmap_construct_agg
MOST = 1 << 26
ROOM = 64


class Sieve:
    def __init__(self, keys: DataFrame, columns: list[str]):
        wanted, self.bits = ROOM * keys.count(), PAGE
        while self.bits < min(wanted, MOST):
            self.bits *= 2
        slot = self._slot([F.col(name) for name in columns])
        self.pages = staged(
            keys.groupBy(F.floor(slot / PAGE).cast("int").alias("__page")).agg(
                F.bitmap_construct_agg(slot % PAGE).alias("__bits")
            ),
            "sieve",
        )

    def _slot(self, columns: list[Column]) -> Column:
        return F.pmod(F.xxhash64(*columns), F.lit(self.bits))

    def _met(self, columns: list[Column]) -> Column:
        slot = self._slot(columns)
        byte = F.substring("__bits", (F.floor(slot % PAGE / 8) + 1).cast("int"), F.lit(1))
        number = F.conv(F.hex(byte), 16, 10).cast("int")
        on_page = F.floor(slot / PAGE).cast("int") == F.col("__page")
        return on_page & (F.bit_get(number, (slot % 8).cast("int")) == 1)

    def passing(self, rows: DataFrame, *columns: Column) -> DataFrame:
        """The rows that may have a key; all that have one are among them."""
        return rows.join(F.broadcast(self.pages), self._met(list(columns)), "left_semi")

    def stopped(self, rows: DataFrame, *columns: Column) -> DataFrame:
        """The other rows, which have none."""
        return rows.join(F.broadcast(self.pages), self._met(list(columns)), "left_anti")
