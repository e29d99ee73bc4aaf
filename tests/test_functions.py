"""Scalar kernels, calendar and projections against values worked out by hand."""

import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from gridweave.functions import calendar as C
from gridweave.functions import nulls
from gridweave.functions import projection as P
from gridweave.functions import scalars as S
from gridweave.plans import serving
from gridweave.schema import FEATURES, chosen, editions, group_of, lossless, present


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(("direction", "u", "v"), [(0, 0, -1), (90, -1, 0), (180, 0, 1), (270, 1, 0)])
def test_wind_cardinals(spark, direction, u, v):
    assert value(spark, S.wind_u(F.lit(1.0), F.lit(direction))) == pytest.approx(u, abs=1e-12)
    assert value(spark, S.wind_v(F.lit(1.0), F.lit(direction))) == pytest.approx(v, abs=1e-12)
    back = value(spark, S.wind_direction(F.lit(float(u)), F.lit(float(v))))
    assert min(abs(back - direction), 360 - abs(back - direction)) < 1e-9


@pytest.mark.parametrize(("rh", "branch"), [(9.99, S.EMC_DRY), (10.0, S.EMC_MIDDLE), (50.0, S.EMC_MIDDLE), (50.01, S.EMC_MOIST)])
def test_moisture_branches(spark, rh, branch):
    f = 20 * 9 / 5 + 32
    expected = branch[0] + branch[1] * rh + branch[2] * f + branch[3] * rh * f + branch[4] * rh * rh
    assert value(spark, S.moisture_content(F.lit(20.0), F.lit(rh))) == pytest.approx(max(expected, 0))


def test_missing_values_pass_through(spark):
    none = F.lit(None).cast("double")
    for column in (nulls.at_least(none, 0.0), nulls.at_most(none, 30.0), nulls.clip(none, 0, 1), S.vapour_deficit(none, F.lit(5.0)), S.fire_weather(none, F.lit(1.0)), S.moisture_content(F.lit(1.0), none)):
        assert value(spark, column) is None
    assert value(spark, nulls.holds(none > 1)) is False
    df = nulls.nan_to_null(spark.createDataFrame([(float("nan"), 1)], "a double, b int"))
    assert df.first().a is None and df.first().b == 1


def test_cover_squares_before_it_clips(spark):
    assert value(spark, S.vegetation_cover(F.lit(0.0))) == pytest.approx((0.05 / 0.81) ** 2)
    assert value(spark, S.vegetation_cover(F.lit(0.99))) == 1.0


def test_first_day_of_year_and_monday(spark):
    sin, cos = S.year_cycle(F.lit("2001-01-01").cast("date"))
    assert (value(spark, sin), value(spark, cos)) == (0.0, 1.0)
    sin, cos = S.week_cycle(F.lit("2024-01-01").cast("date"))
    assert (value(spark, sin), value(spark, cos)) == (0.0, 1.0)


@pytest.mark.parametrize(("x", "cell"), [(0.5, 0), (1.5, 2), (2.5, 2)])
def test_grid_index_halves_to_even(spark, x, cell):
    assert value(spark, S.grid_index(F.lit(x), 0.0, 1.0)) == cell


@pytest.mark.parametrize(("distance", "regime"), [(6.0, 2), (6.0001, 1), (None, 1)])
def test_regime_boundary(spark, distance, regime):
    assert value(spark, serving.regime(F.lit(distance).cast("double"))) == regime


def test_easter_and_regional_holidays(spark):
    assert [C.easter(y) for y in (1995, 2000, 2001, 2024)] == [date(1995, 4, 16), date(2000, 4, 23), date(2001, 4, 15), date(2024, 3, 31)]
    found = {(r.day, r.region) for r in C.regional_only(C.holidays(spark, 2024, 2024)).collect()}
    assert (date(2024, 3, 28), 1) in found and (date(2024, 3, 29), 1) not in found
    assert not {d for d, _ in found} & {d for d, c in C.holiday_rows(2024, 2024) if c is None}


def test_composite_tag(spark):
    assert value(spark, C.composite_day(F.lit("A2016225"))) == date(2016, 8, 12)


def test_projections(spark):
    x, y = P.equal_area(F.lit(10.0), F.lit(52.0))
    assert (value(spark, x), value(spark, y)) == (pytest.approx(4321000), pytest.approx(3210000))
    x, y = P.equal_area(F.lit(-3.7), F.lit(40.4))
    lon, lat = P.equal_area_inverse(F.lit(value(spark, x)), F.lit(value(spark, y)))
    assert (value(spark, lon), value(spark, lat)) == (pytest.approx(-3.7, abs=1e-8), pytest.approx(40.4, abs=1e-8))
    # EPSG's own example for this projection: 5 E, 50 N.
    x, y = P.equal_area(F.lit(5.0), F.lit(50.0))
    assert (value(spark, x), value(spark, y)) == (pytest.approx(3962799.45, abs=0.1), pytest.approx(2999718.85, abs=0.1))
    x, y = P.mollweide(F.lit(180.0), F.lit(0.0), radius=1.0)
    assert (value(spark, x), value(spark, y)) == (pytest.approx(2 * math.sqrt(2)), pytest.approx(0))
    x, y = P.mollweide(F.lit(0.0), F.lit(90.0), radius=1.0)
    assert value(spark, y) == pytest.approx(math.sqrt(2), abs=1e-2)
    lon, lat = P.geostationary_inverse(F.lit(0.0), F.lit(0.0))
    assert (value(spark, lon), value(spark, lat)) == (0.0, 0.0)
    assert value(spark, P.geostationary_inverse(F.lit(0.3), F.lit(0.0))[0]) is None


def test_age_and_ramp(spark):
    assert [value(spark, S.age_text(F.lit(s))) for s in (5, 130, 7200, 200000)] == ["just now", "2m ago", "2h ago", "2d ago"]
    assert value(spark, S.age_text(F.lit(5), fine=True)) == "5s ago"
    assert value(spark, S.ramp_position(F.lit(S.BASE_RATE))) == pytest.approx(0.0)
    assert value(spark, S.ramp_position(F.lit(1.0))) == 1.0


def test_feature_names():
    assert len(FEATURES) == 135 == len(set(FEATURES))
    assert FEATURES[0] == "CLC_2018_1" and FEATURES[63] == "EVI" and FEATURES[-1] == "wind_v_mean"
    assert present(["kbdi", "EVI", "x"])[0] == ["EVI", "kbdi"]
    assert chosen(["a_max", "b", "a_max", "c_max"], "_max$", "^c") == ["a_max"]
    assert editions("CLC_forest", ["CLC_2006_forest", "CLC_2012_forest", "CLC_2012_scrub"]) == {2006: "CLC_2006_forest", 2012: "CLC_2012_forest"}
    assert editions("popdens", ["popdens_2015", "popdens_2020"]) == {2015: "popdens_2015", 2020: "popdens_2020"}
    assert group_of("dist_to_fire") == "fire_context" and group_of("t2m_max") == "weather"
    assert lossless("is_fire") and not lossless("kbdi")


def test_causes(spark):
    listed = F.array(*map(F.lit, ("t2m_max", "kbdi", "dist_to_fire")))
    assert value(spark, serving.causes(listed)) == ["near active fire", "very dry ground"]
