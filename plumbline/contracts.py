"""What a table promises: its columns, header aliases, key, required and numeric columns."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the table-name classes a package may carry
TABLE_NAME = re.compile(r"^[a-z]+_(dim|fact|bridge|mart|meta)_[a-z0-9_]+$")


@dataclass(frozen=True)
class TableContract:
    name: str
    columns: tuple[str, ...]
    key: tuple[str, ...]
    required: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()
    year_columns: tuple[str, ...] = ()
    aliases: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def valid_name(self) -> bool:
        return bool(TABLE_NAME.match(self.name))

    def key_struct(self) -> Column:
        """The key as one struct: null counts as a value, unlike in a multi-column distinct count."""
        return F.struct(*[F.col(c) for c in self.key])
