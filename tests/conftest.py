"""A local session and builders of small input tables."""

from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

import pytest

from forecourt.session import local_session
from forecourt.sources import schemas
from forecourt.sources.schemas import Inputs

AS_OF = date(2001, 7, 1)


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cpus=4)
    yield session
    session.stop()


def ago(days: int) -> date:
    return AS_OF - timedelta(days=days)


@pytest.fixture
def listings(spark):
    """Build inputs from cars given as dicts; every car gets its own decode row.

    Defaults: a listed car of dealer 1, style 7, model year 1999, seen yesterday.
    """

    def build(cars, zips=None, distances=None) -> Inputs:
        hist, vins = [], {}
        for i, car in enumerate(cars):
            car = {
                "vin": f"v{i}",
                "dealer": 1,
                "first": ago(10),
                "last": ago(1),
                "sold": False,
                "latest": True,
                "price": 100,
                "mileage": 1000,
                "style": 7,
                "year": "1999",
                "make": 1,
                "model": 1,
            } | car
            price = None if car["price"] is None else Decimal(str(car["price"]))
            hist.append(
                (car["vin"], car["dealer"], car["first"], car["last"], car["sold"], car["latest"])
                + (price, Decimal(str(car["mileage"])))
            )
            vins[car["vin"]] = (car["vin"], car["style"], car["year"], car["make"], car["model"])
        zips = zips or {1: "10"}
        makes = {v[3] for v in vins.values()}
        models = {v[4] for v in vins.values()}

        def frame(rows, schema):
            return spark.createDataFrame(rows, schema)

        return Inputs(
            hist=frame(hist, schemas.HIST),
            dealers=frame(list(zips.items()), schemas.DEALERS),
            vins=frame(list(vins.values()), schemas.VINS),
            divisions=frame([(m, f"make{m}") for m in makes], schemas.DIVISIONS),
            models=frame([(m, f"model{m}") for m in models], schemas.MODELS),
            zipdist=frame(distances or [("10", "10", 0.0)], schemas.ZIPDIST),
        )

    return build


def rows_of(df, *keys):
    """Rows as dicts, by the values of the key columns."""
    found = {}
    for row in df.collect():
        key = tuple(row[k] for k in keys)
        found[key[0] if len(keys) == 1 else key] = row.asDict()
    return found
