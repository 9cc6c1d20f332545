"""Searches over the stored tables, with the parameter names of the source.

All bounds are inclusive, and a NULL fails its bound. Predicates on single columns are
plain comparisons, so they reach the scan; price per size, free text and a part of a
street are computed from the rows that the other predicates leave.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date, datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.functions.dates import days_back

PAGE_SIZE = 50
#: Rows before a page from which it is looked for by counting ranges; rows of a range that may be sorted.
DEEP = 100_000
RANGE_ROWS = 50_000
_SPLITS = 128

# Search names and the columns they stand for.
ACTIVE_RANGES = {
    "price": "price",
    "rooms": "rooms",
    "size": "size",
    "lotSize": "lot_size",
    "buildYear": "build_year",
    "daysForSale": "days_for_sale",
}
SOLD_RANGES = {"price": "price", "rooms": "rooms", "size": "size", "buildYear": "build_year"}
BOX = {"latitude": "latitude", "longitude": "longitude"}
ACTIVE_SORT = {
    "daysForSale": "days_for_sale",
    "price": "price",
    "size": "size",
    "rooms": "rooms",
    "lotSize": "lot_size",
    "buildYear": "build_year",
    "zipCode": "zip_code",
    "createdDate": "created_date",
}
SOLD_SORT = {
    "date": "sold_date",
    "price": "price",
    "size": "size",
    "rooms": "rooms",
    "buildYear": "build_year",
    "zipCode": "zip_code",
    "sqmPrice": "sqm_price",
}


def _ranges(names: Mapping[str, str]) -> dict[str, Callable[[Any], Column]]:
    known = {}
    for name, column in names.items():
        known[f"{name}Min"] = lambda v, c=column: F.col(c) >= v
        known[f"{name}Max"] = lambda v, c=column: F.col(c) <= v
    return known


def _equals(column: str) -> Callable[[Any], Column]:
    return lambda v: F.col(column) == v


def _sqm_price() -> Column:
    return F.try_divide(F.col("price"), F.col("size"))


def _free_text(text: str) -> Column:
    wanted = text.lower()
    return F.lower("street").contains(wanted) | F.lower("city").contains(wanted)


def _class_up_to(worst: str) -> Column:
    """Bounds on the plain column that a class up to this letter keeps; they reach the scan."""
    small, name = worst.lower(), F.col("energy_class")
    after = chr(ord(worst[0].upper()) + 1)
    return (name < after) | ((name >= "a") & (name < chr(ord(small[0]) + 1))) | (name >= "\x80")


def _class_from(best: str) -> Column:
    name = F.col("energy_class")
    return (name >= best[0].upper()) | (name >= best[0].lower())


# Energy classes are letters, A the best: the minimum is the worst class allowed.
_ACTIVE: dict[str, Callable[[Any], Column]] = {
    **_ranges(ACTIVE_RANGES),
    **_ranges(BOX),
    "sqmPriceMin": lambda v: _sqm_price() >= v,
    "sqmPriceMax": lambda v: _sqm_price() <= v,
    "energyClassMin": lambda v: _class_up_to(v) & (F.ascii(F.upper("energy_class")) <= ord(v.upper())),
    "energyClassMax": lambda v: _class_from(v) & (F.ascii(F.upper("energy_class")) >= ord(v.upper())),
    "propertyType": _equals("property_type"),
    "city": _equals("city"),
    "zipCode": _equals("zip_code"),
    "q": _free_text,
}

_SOLD: dict[str, Callable[[Any], Column]] = {
    **_ranges(SOLD_RANGES),
    **_ranges(BOX),
    "zipcodeFrom": lambda v: F.col("zip_code") >= v,
    "zipcodeTo": lambda v: F.col("zip_code") <= v,
    "propertyType": _equals("property_type"),
    "saleType": _equals("sale_type"),
    "street": lambda v: F.lower("address").contains(v.lower()),
    "salesDateMin": lambda v: F.col("sold_date") >= F.lit(date(int(v), 1, 1)),
    "city": _equals("city"),
    "zipCode": _equals("zip_code"),
}


def _search(table: DataFrame, known: Mapping[str, Callable[[Any], Column]], params: Mapping[str, Any]) -> DataFrame:
    unknown = sorted(set(params) - set(known))
    if unknown:
        raise ValueError(f"no stored column answers: {', '.join(unknown)}")
    for name, value in params.items():
        if value is not None:
            table = table.filter(known[name](value))
    return table


def search_active(table: DataFrame, developments: DataFrame | None = None, **params: Any) -> DataFrame:
    """Homes for sale that meet all given parameters.

    ``priceDevelopment`` (down or up) needs the frame made by
    :func:`hearthline.operators.history.price_development`.
    """
    development = params.pop("priceDevelopment", None)
    found = _search(table, _ACTIVE, params)
    if development is None:
        return found
    if developments is None:
        raise ValueError("priceDevelopment needs developments")
    moved = developments.filter(F.col("development") == development).select("id")
    return found.join(moved, "id", "left_semi")


def search_sold(table: DataFrame, **params: Any) -> DataFrame:
    """Sales that meet all given parameters."""
    return _search(table, _SOLD, params)


def sold_since(table: DataFrame, as_of: datetime | str | Column, days: int = 7) -> DataFrame:
    """Sales of the last ``days`` days up to ``as_of``."""
    first, last = days_back(as_of, days)
    return table.filter(F.col("sold_date").between(first, last))


def lookup(table: DataFrame, key: str, value: Any) -> DataFrame:
    """The row of a key, if there is one."""
    return table.filter(F.col(key) == value)


def _sort_columns(sort: str, names: Mapping[str, str], key: str) -> tuple[str, bool]:
    name, _, direction = sort.rpartition("-")
    if name not in names or direction not in ("a", "d"):
        raise ValueError(f"cannot sort by {sort!r}")
    return names[name], direction == "a"


def _marked(name: str, bounds: list) -> Column:
    """Where a value lies among ascending bounds: 2k between two of them, 2k + 1 on one; -1 for NULL."""
    value, marks = F.col(name), F.array(*map(F.lit, bounds))
    below = F.size(F.filter(marks, lambda b: b < value))
    on = F.exists(marks, lambda b: b == value).cast("int")
    return F.when(value.isNull(), -1).otherwise(2 * below + on)


def _between(name: str, bounds: list, first: int, last: int) -> Column:
    """The rows marked ``first`` to ``last``, as plain bounds that reach the scan."""
    value, kept = F.col(name), F.col(name).isNotNull()
    if first > 0:
        kept = kept & (value >= bounds[first // 2] if first % 2 else value > bounds[first // 2 - 1])
    if last < 2 * len(bounds):
        kept = kept & (value <= bounds[last // 2] if last % 2 else value < bounds[last // 2])
    return kept


def _near_page(
    found: DataFrame, column: str, ascending: bool, key: str, skip: int, size: int, range_rows: int
) -> tuple[DataFrame, int]:
    """The part of the results that holds a page, and the rows of it before the page.

    Rows are counted by ranges between quantiles of the sort value, at most 257 numbers a
    round; the range the page lies in is looked at again until it is small. Rows of one value
    are told apart by their key. Nothing is sorted here.
    """
    name, up = column, ascending
    while True:
        shares = [k / _SPLITS for k in range(1, _SPLITS)]
        quantiles = found.agg(F.percentile_approx(name, shares)).first()[0]
        bounds = sorted(set(quantiles or []))
        counts = {r.at: r.n for r in found.groupBy(_marked(name, bounds).alias("at")).agg(F.count(F.lit(1)).alias("n")).collect()}
        order = sorted((at for at in counts if at >= 0), reverse=not up) + ([-1] if -1 in counts else [])
        before, held = 0, []
        for at in order:
            if before + counts[at] > skip or held:
                held.append(at)
                if before + sum(counts[k] for k in held) >= skip + size:
                    break
            else:
                before += counts[at]
        if not held:  # the page lies beyond the results
            return found.limit(0), 0
        known = [at for at in held if at >= 0]
        near = F.lit(False)
        if known:
            near = _between(name, bounds, min(known), max(known))
        if -1 in held:
            near = near | F.col(name).isNull()
        found, skip = found.filter(near), skip - before
        total = sum(counts[k] for k in held)
        if total <= range_rows or len(held) > 1 or len(order) == 1 and name == key:
            return found, skip
        if held[0] % 2 or len(order) == 1:  # rows of one value, or of none
            name, up = key, True


def result_page(
    found: DataFrame,
    sort: str,
    names: Mapping[str, str],
    key: str,
    page: int,
    first_page: int,
    size: int = PAGE_SIZE,
    after: tuple[Any, Any] | None = None,
    deep: int = DEEP,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """One page of a search in order; rows of equal value are ordered by key.

    ``sort`` is a field and ``-a`` or ``-d``. NULLs come last. Far into the results
    pass ``after``, the (sort value, key) of the last row seen: the page that
    follows it is then found by a filter instead of by counting rows off. A page that
    more than ``deep`` rows precede is looked for by counting ranges, in a few small jobs that
    run here; only the range it lies in is sorted.
    """
    column, ascending = _sort_columns(sort, names, key)
    value = F.col(column)
    if after is not None:
        seen, last_key = after
        tie = F.col(key) > last_key
        if seen is None:
            found = found.filter(value.isNull() & tie)
        else:
            beyond = (value > seen) if ascending else (value < seen)
            found = found.filter(beyond | ((value == seen) & tie) | value.isNull())
        skip = 0
    else:
        skip = (page - first_page) * size
        if skip > deep:
            found, skip = _near_page(found, column, ascending, key, skip, size, range_rows)
    direction = value.asc_nulls_last() if ascending else value.desc_nulls_last()
    return found.orderBy(direction, F.col(key)).offset(skip).limit(size)


def active_page(found: DataFrame, sort: str = "daysForSale-a", page: int = 0, **how: Any) -> DataFrame:
    """A page of homes for sale; the first is page 0."""
    return result_page(found, sort, ACTIVE_SORT, "id", page, 0, **how)


def sold_page(found: DataFrame, sort: str = "date-d", page: int = 1, **how: Any) -> DataFrame:
    """A page of sales; the first is page 1."""
    return result_page(found, sort, SOLD_SORT, "estate_id", page, 1, **how)
