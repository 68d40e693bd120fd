"""Coordinate systems: known points, and there and back again."""

import pytest
from pyspark.sql import functions as F

from caudal.operators import projections as P


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def plane(spark, lat, lon, code):
    r = P.from_degrees(spark.createDataFrame([(float(lat), float(lon))], "lat double, lon double"), "lat", "lon", code).first()
    return r.x, r.y


def test_known_points(spark):
    lit = lambda *v: [F.lit(float(x)) for x in v]
    x, y = plane(spark, 48.8582, 2.2945, 32631)
    assert abs(x - 448251.8) < 0.1 and abs(y - 5411932.7) < 0.1
    assert plane(spark, 0, -75, 32618) == pytest.approx((500_000, 0), abs=1e-6)
    assert plane(spark, 0, -75, 32718) == pytest.approx((500_000, 10_000_000), abs=1e-6)
    assert plane(spark, 4.596200416666666, -74.07750791666666, 3116) == pytest.approx((1_000_000, 1_000_000), abs=1e-6)
    assert plane(spark, 4, -73, 9377) == pytest.approx((5_000_000, 2_000_000), abs=1e-6)
    assert plane(spark, 0, 180, 3857) == pytest.approx((20037508.342789244, 0), abs=1e-6)
    # A standard worked example of seven parameters.
    moved = one(spark, *P.helmert(*lit(3657660.66, 255768.55, 5201382.11), (0, 0, 4.5, 0, 0, 0.554, 0.219)))
    assert moved == pytest.approx((3657660.78, 255778.43, 5201387.75), abs=0.01)
    back = one(spark, *P.helmert(*lit(*moved), (0, 0, 4.5, 0, 0, 0.554, 0.219), back=True))
    assert back == pytest.approx((3657660.66, 255768.55, 5201382.11), abs=0.01)


@pytest.mark.parametrize("code", [4326, 4218, 3857, 3115, 3116, 9377, 21897, 32618, 32718])
def test_there_and_back(spark, code):
    df = spark.range(300).selectExpr("-4.0 + (id % 20) * 0.83 as a", "-80.0 + (id div 20) * 0.97 as b")
    back = P.to_degrees(P.from_degrees(df, "a", "b", code), "x", "y", code)
    worst = back.agg(F.max(F.abs(F.col("lat") - F.col("a"))), F.max(F.abs(F.col("lon") - F.col("b"))), F.count("lat")).first()
    assert max(worst[:2]) < (1e-9 if not P.system(code).shift else 1e-6) and worst[2] == 300


def test_datum_shift_moves_by_some_hundred_metres(spark):
    df = spark.createDataFrame([(1, 1_000_000.0, 1_000_000.0), (2, None, 1.0)], "k int, x double, y double")
    rows = {r.k: r for r in P.to_degrees(df, "x", "y", 21897).collect()}
    lat, lon = rows[1].lat, rows[1].lon
    assert rows[2].lat is None and rows[2].y == 1.0
    assert abs(lat - 4.5962) < 1e-3 and abs(lon + 74.0775) < 1e-3 and abs(lat - 4.599047222222222) > 1e-3


def test_codes():
    assert P.utm_code(3.4, -76.5) == 32618 and P.utm_code(-3.4, 179.9) == 32760
    assert P.code_of_prj('PROJCS["x",AUTHORITY["EPSG","4686"],AUTHORITY["EPSG","3115"]]') == 3115
    assert P.code_of_prj('PROJCS["MAGNA_Colombia_Oeste",GEOGCS["GCS_MAGNA"]]') == 3115 and P.code_of_prj('PROJCS["WGS_1984_UTM_Zone_18N"]') == 32618
    assert P.code_of_prj('GEOGCS["GCS_WGS_1984"]') == 4326 and P.code_of_prj(None) is None and P.code_of_prj("?") is None
    with pytest.raises(ValueError):
        P.system(1)
