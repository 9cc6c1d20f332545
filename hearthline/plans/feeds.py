"""The two kinds of data: homes for sale and homes sold.

A feed names everything in which they differ, so that the jobs are written once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql.types import StructType

from hearthline import schemas
from hearthline.operators import constraints, mapping, rules


@dataclass(frozen=True)
class Feed:
    name: str
    key: str
    first_page: int
    schema: StructType
    required: tuple[str, ...]
    fields: tuple[tuple[str, str, str], ...]
    rules: Callable[[int], Sequence[rules.Rule]]
    to_rows: Callable[..., DataFrame]
    breaches: Callable[[], Column]
    storable: Callable[[], Column]

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def payload(self) -> list[str]:
        """Columns besides the key and the metadata."""
        return [c for c in self.columns if c != self.key and c not in schemas.METADATA]

    def rules_at(self, as_of: datetime | str) -> Sequence[rules.Rule]:
        """The rules in force at a moment: build years end with its year."""
        year = as_of.year if isinstance(as_of, datetime) else datetime.fromisoformat(as_of).year
        return self.rules(year)

    def with_rules(self, make: Callable[[int], Sequence[rules.Rule]]) -> Feed:
        """The same feed with rules of your own."""
        return replace(self, rules=make)


ACTIVE = Feed(
    name="active",
    key="id",
    first_page=0,
    schema=schemas.ACTIVE,
    required=mapping.REQUIRED_ACTIVE,
    fields=mapping.ACTIVE_FIELDS,
    rules=rules.active_rules,
    to_rows=mapping.map_active,
    breaches=constraints.breaches_active,
    storable=constraints.storable_active,
)

SOLD = Feed(
    name="sold",
    key="estate_id",
    first_page=1,
    schema=schemas.SOLD,
    required=mapping.REQUIRED_SOLD,
    fields=mapping.SOLD_FIELDS,
    rules=rules.sold_rules,
    to_rows=mapping.map_sold,
    breaches=constraints.breaches_sold,
    storable=constraints.storable_sold,
)
