from datetime import date

import pytest

from hearthline.operators import search

ROWS = [
    (1, 100, 10, "Elm Road 1", "Aarhus", "A", 3), (2, 200, 10, "Oak Road 2", "Elmby", "D", 1),
    (3, 300, None, "Ash Road 3", "Odense", "I", None), (4, 400, 20, "Elm Road 4", "Odense", None, 1),
]


@pytest.fixture
def homes(spark):
    return spark.createDataFrame(
        ROWS, "id int, price int, size int, street string, city string, energy_class string, days_for_sale int"
    )


def ids(df):
    return sorted(r.id for r in df.collect())


def test_parameters(homes):
    assert ids(search.search_active(homes, priceMin=200, priceMax=400)) == [2, 3, 4]
    assert ids(search.search_active(homes, sizeMin=1, priceMax=None)) == [1, 2, 4]
    assert ids(search.search_active(homes, sqmPriceMin=20, sqmPriceMax=20)) == [2, 4]
    assert ids(search.search_active(homes, energyClassMin="I", energyClassMax="D")) == [2, 3]
    assert ids(search.search_active(homes, q="ELM")) == [1, 2, 4]
    assert ids(search.search_active(homes, city="Odense")) == [3, 4]
    with pytest.raises(ValueError, match="floorMin"):
        search.search_active(homes, floorMin=1)
    with pytest.raises(ValueError, match="developments"):
        search.search_active(homes, priceDevelopment="down")


def test_pages_and_seeking(homes):
    order = [2, 4, 1, 3]
    pages = [r.id for p in (0, 1) for r in search.active_page(homes, "daysForSale-a", p, size=2).collect()]
    assert pages == order
    seen = [r.id for r in search.active_page(homes, "daysForSale-a", after=(1, 2), size=2).collect()]
    assert seen == [4, 1]
    assert [r.id for r in search.active_page(homes, "daysForSale-a", after=(None, 2)).collect()] == [3]
    assert [r.id for r in search.active_page(homes, "price-d", size=2).collect()] == [4, 3]
    with pytest.raises(ValueError):
        search.active_page(homes, "street-a")


@pytest.mark.parametrize("sort", ["daysForSale-a", "price-d", "size-a"])
def test_deep_pages_equal_offsets(spark, monkeypatch, sort):
    """Many ties, nulls and a hot value; the page comes from a small range."""
    rows = spark.range(20_000).selectExpr(
        "id", "CAST(hash(id) % 1000 AS INT) AS price", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 10 = 1 THEN NULL ELSE CAST(id % 500 AS INT) END AS days_for_sale",
        "CAST(NULL AS INT) AS size",
    )
    plain = search.active_page(rows, sort, 0, size=20_000).collect()
    seen, near = [], search._near_page
    monkeypatch.setattr(search, "_near_page", lambda *a: seen.append(near(*a)) or seen[-1])
    for page in (11, 50, 101, 199, 250):
        got = search.active_page(rows, sort, page, size=100, deep=1000, range_rows=200).collect()
        assert got == plain[100 * page : 100 * page + 100]
    assert len(seen) == 5 and all(part.count() <= 700 for part, _ in seen)


def test_sales_by_date(spark):
    sold = spark.createDataFrame([(1, date(2024, 6, 1)), (2, date(2024, 5, 1)), (3, None)], "estate_id int, sold_date date")
    found = search.sold_since(sold, "2024-06-08 10:00:00", 7).collect()
    assert [r.estate_id for r in found] == [1]
    assert search.search_sold(sold, salesDateMin=2024).count() == 2
    first = search.sold_page(sold, "date-d", page=1, size=1).collect()
    assert [r.estate_id for r in first] == [1]
    assert search.lookup(sold, "estate_id", 2).count() == 1
