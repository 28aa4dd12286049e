"""The matrix by difference against the full build of each day."""

import random
from datetime import timedelta
from decimal import Decimal

import pytest
from conftest import AS_OF, ago
from pyspark.sql import functions as F

from forecourt.plans import daily, refresh
from forecourt.sources import schemas
from forecourt.sources.schemas import Inputs


def rows(df):
    return sorted(str(sorted(r.asDict().items())) for r in df.collect())


def hist_of(spark, records):
    made = [
        (v, d, last - timedelta(days=lot), last, sold, True, Decimal(p), Decimal(m))
        for v, d, lot, last, sold, p, m in records
    ]
    return spark.createDataFrame(made, schemas.HIST)


def tables(spark, records):
    cars = sorted({r[0] for r in records})
    vins = [(v, i % 3, str(1995 + i % 8), 1, 1) for i, v in enumerate(cars)]
    vins[0] = (vins[0][0], None, "1999", 1, 1)  # not decoded
    pairs = [(a, b, 0.0 if a == b else 60.0) for a in ("10", "20") for b in ("10", "20")]
    frame = spark.createDataFrame
    return Inputs(
        hist=hist_of(spark, records),
        dealers=frame([(1, "10"), (2, "20"), (3, "20"), (4, None)], schemas.DEALERS),
        vins=frame(vins, schemas.VINS),
        divisions=frame([(1, "m")], schemas.DIVISIONS),
        models=frame([(1, "m")], schemas.MODELS),
        zipdist=frame(pairs, schemas.ZIPDIST),
    )


def full(spark, records, gone, inputs, day):
    """The matrix of the newest records known on a day; `records` in the order they came."""
    newest = {}
    for r in records:
        if r[3] <= day and (r[0] not in newest or r[3] >= newest[r[0]][3]):
            newest[r[0]] = r
    left = [r for v, r in newest.items() if v not in gone]
    built = Inputs(**{**vars(inputs), "hist": hist_of(spark, left)})
    return daily.metric_matrix(built, day)


@pytest.mark.parametrize("start", [AS_OF, AS_OF.replace(year=2000, month=12, day=30)])
def test_late_changed_and_vanished_cars(spark, tmp_path, start):
    """Three refreshes, one over several days; the second case passes the turn of a year."""
    rng = random.Random(start.toordinal())

    def some(n, latest, back):
        return [
            (f"v{rng.randrange(60)}", rng.randint(1, 5), rng.randrange(100), latest - timedelta(days=rng.randrange(back)),
             rng.random() < 0.5, rng.randint(500, 9000), rng.randint(0, 90_000))
            for _ in range(n)
        ]

    first = some(80, start, 125)
    # Records of every border: the day of each snapshot's and window's end.
    first += [(f"b{n}", 1, 3, start - timedelta(days=n), n % 2 == 0, 700 + n, 100) for n in (0, 1, 2, 44, 45, 46, 59, 60, 61, 88, 89, 90, 91, 120, 121)]
    first += [(f"n{n}", 2, n, start, True, 800 + n, 100) for n in (87, 88, 89, 90, 91)]
    days = [start + timedelta(days=n) for n in (1, 2, 6)]
    batches = [some(15, days[0], 3), some(15, days[1], 100), some(15, days[2], 4) * 2]
    gone = [[], ["v1", "v2", "v999"], ["v3"]]
    known = [r for r in first if r[3] <= start]
    inputs = tables(spark, first + [r for b in batches for r in b])
    root = str(tmp_path)
    # Of a batch's records of a car the greatest of the last day counts, so state it in that order.
    ordered = lambda batch: sorted(batch, key=lambda r: (r[0], r[3], r[1], r[3] - timedelta(days=r[2]), *r[4:]))
    refresh.start(spark, root, inputs, hist_of(spark, known), start)
    assert rows(refresh.matrix(spark, root, inputs.zipdist)) == rows(full(spark, ordered(known), [], inputs, start))
    seen, lost = ordered(known), []
    for day, batch, away in zip(days, batches, gone, strict=True):
        vanished = spark.createDataFrame([(v,) for v in away], "vin string")
        refresh.refresh(spark, root, inputs, hist_of(spark, batch), day, vanished)
        lost += away
        seen = [r for r in seen if r[0] not in away]
        seen += [r for r in ordered(batch) if r[0] not in away]
        want = full(spark, seen, [], inputs, day)
        assert rows(refresh.matrix(spark, root, inputs.zipdist)) == rows(want), day
        if day == days[1]:
            refresh.compact(spark, root)
            assert len(refresh.runs(spark, root)) == 1
    with pytest.raises(ValueError, match="already"):
        refresh.refresh(spark, root, inputs, hist_of(spark, known), days[-1])


def test_a_run_that_is_not_committed_does_not_count(spark, tmp_path, monkeypatch):
    records = [("v1", 1, 5, ago(3), True, 900, 100), ("v2", 1, 5, ago(3), True, 950, 100)]
    inputs = tables(spark, records)
    root = str(tmp_path)
    refresh.start(spark, root, inputs, inputs.hist, ago(1))
    before = rows(refresh.matrix(spark, root, inputs.zipdist))
    new = hist_of(spark, [("v2", 1, 5, AS_OF, False, 700, 100)])
    with monkeypatch.context() as broken:
        broken.setattr(refresh, "_commit", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            refresh.refresh(spark, root, inputs, new, AS_OF)
    assert rows(refresh.matrix(spark, root, inputs.zipdist)) == before
    refresh.refresh(spark, root, inputs, new, AS_OF)
    found = refresh.matrix(spark, root, inputs.zipdist).filter("dim = 'dealer_id' and measure = 'price'")
    assert [(r.cars_sold, r.cars_lstd) for r in found.collect()] == [(0, 1)]


def test_nothing_new_changes_nothing_but_the_day(spark, tmp_path):
    records = [(f"v{i}", 1, i, ago(i), True, 900, 100) for i in range(1, 120, 7)]
    inputs = tables(spark, records)
    root = str(tmp_path)
    refresh.start(spark, root, inputs, inputs.hist, ago(1))
    refresh.refresh(spark, root, inputs, inputs.hist.filter(F.lit(False)), AS_OF)
    want = daily.metric_matrix(inputs, AS_OF)
    assert rows(refresh.matrix(spark, root, inputs.zipdist)) == rows(want)
