"""Branch coverage of the column functions on small frames."""

import math

import pytest
from pyspark.sql import functions as F

from roadpulse.functions import calendar, dashboard, numeric, risk, roads, text, weather


def values(spark, rows, layout, *columns):
    df = spark.createDataFrame(rows, layout)
    return [tuple(r) for r in df.select(*columns).collect()]


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_weather_class_hist_order(spark):
    rows = [(5.1, 0.0, 1e4), (5.0, 0.0, 1e4), (1.0, 90.0, 1e4), (0.0, 71.0, 500.0), (0.0, 70.0, 999.0), (0.0, 0.0, 1000.0)]
    got = values(
        spark, rows, "p double, c double, v double", weather.weather_class_hist(F.col("p"), F.col("c"), F.col("v"))
    )
    assert [g[0] for g in got] == ["Heavy Rain", "Rain", "Light Rain", "Cloudy", "Fog", "Clear"]


def test_weather_class_live_and_surface(spark):
    rows = [(5.1,), (0.6,), (0.5,), (0.0,)]
    got = values(
        spark, rows, "p double", weather.weather_class_live(F.col("p")), weather.road_surface(F.col("p")),
        weather.road_surface_from_label(weather.weather_class_live(F.col("p"))),
    )
    assert got == [
        ("Heavy Rain", "Wet", "Wet"), ("Rain", "Wet", "Wet"), ("Light Rain", "Wet", "Wet"), ("Clear", "Dry", "Dry"),
    ]


def test_falsy_default(spark):
    got = values(spark, [(0.0,), (None,), (3.5,)], "c double", weather.falsy_default(F.col("c"), 20.0))
    assert [g[0] for g in got] == [20.0, 20.0, 3.5]


def test_midday(spark):
    got = values(spark, [(list(range(24)),), ([7, 8],), ([],)], "a array<int>", weather.midday(F.col("a")))
    assert [g[0] for g in got] == [12, 8, None]


def test_rush_hours(spark):
    got = values(
        spark, [(h,) for h in range(24)], "h int", calendar.is_rush_hour(F.col("h")), calendar.is_rush_hour_live(F.col("h"))
    )
    assert [h for h, (a, _) in enumerate(got) if a] == [7, 8, 17, 18, 19]
    assert [h for h, (_, b) in enumerate(got) if b] == [7, 8, 9, 17, 18, 19]


def test_cyclical(spark):
    sin, cos = calendar.cyclical(F.lit(6), 24)
    assert one(spark, sin) == pytest.approx(1.0)
    assert one(spark, cos) == pytest.approx(0.0, abs=1e-12)


def test_iso_round_trip(spark):
    ts = calendar.parse_iso(F.lit("2024-03-01T08:09:10.000123"))
    assert one(spark, calendar.format_iso(ts)) == "2024-03-01T08:09:10.000123"
    assert one(spark, calendar.parse_iso(F.lit("no time"))) is None


@pytest.mark.parametrize(
    "kind, name, expected",
    [
        ("highway", "Thika Road", (6, 80, 0.72)),
        ("main_road", "Uhuru Highway", (6, 80, 0.72)),
        ("city_street", "Some Lane", (4, 40, 0.58)),
        ("main_road", "Kenyatta Avenue", (4, 40, 0.58)),
        ("main_road", "Moi Drive", (4, 40, 0.58)),
        ("main_road", "Ngong Road", (4, 60, 0.65)),
    ],
)
def test_road_class(spark, kind, name, expected):
    df = spark.range(1).withColumn("k", roads.road_class(F.lit(kind), F.lit(name)))
    assert tuple(df.select(*roads.class_columns(F.col("k")).values()).first()) == expected


def test_road_type_is_case_sensitive_for_primary(spark):
    rows = [("HIGHWAY",), ("primary",), ("Primary",), (None,)]
    got = values(spark, rows, "t string", roads.road_type(F.col("t")))
    assert [g[0] for g in got] == ["highway", "main_road", "city_street", "city_street"]


def test_base_risk_adjust_and_null_name(spark):
    rows = [("thika road", 0.72), ("Waiyaki Way", 0.85), ("Ngong Road", 0.65), (None, 0.5)]
    got = values(spark, rows, "n string, b double", roads.adjust_base_risk(F.col("b"), F.col("n")))
    assert [g[0] for g in got] == pytest.approx([0.84, 0.92, 0.65, 0.5])


def test_line_points(spark):
    layout = "g array<struct<lon:double,lat:double>>"
    point = [(float(i), -float(i)) for i in range(4)]
    got = values(spark, [(point[:1],), (point[:2],), (point[:3],), (point,)], layout, roads.line_points(F.col("g")))
    assert [[p.lon for p in g[0]] for g in got] == [[0, 0, 0], [0, 1, 1], [0, 1, 2], [0, 2, 3]]


def test_labels(spark):
    segment = roads.segment_id(F.lit("Some Group"), F.lit("(1, 2, 0)"), F.lit(2))
    assert one(spark, segment) == "Some Group_(1, 2, 0)_2"
    assert one(spark, roads.location_label(F.lit("Thika Road"), segment)) == "Thika Road Segment 2"


def test_risk_level_bounds(spark):
    rows = [(0.75,), (0.7499,), (0.5,), (0.4999,), (0.45,), (0.4499,)]
    got = values(
        spark, rows, "s double", risk.risk_level(F.col("s")), risk.risk_level(F.col("s"), *risk.LIVE_LEVELS)
    )
    assert [g[0] for g in got] == ["High", "Medium", "Medium", "Low", "Low", "Low"]
    assert [g[1] for g in got] == ["High", "Medium", "Medium", "Medium", "Medium", "Low"]


def test_risk_score_is_capped_and_lowered_on_holidays(spark):
    def score(base, time, holiday):
        return one(spark, risk.risk_score(F.lit(base), F.lit(time), F.lit(1.0), F.lit(1.0), F.lit(holiday)))

    assert score(0.9, 2.2, False) == 1.0
    assert score(0.5, 1.0, True) == pytest.approx(0.4)


@pytest.mark.parametrize("score", [0.0, 0.1, 0.375, 0.4, 0.5, 0.9, 1.0])
def test_severity_probabilities(spark, score):
    weights = [max(0.03, 0.08 * score), max(0.15, 0.30 * score), 1 - max(0.18, 0.38 * score)]
    got = one(spark, risk.severity_probabilities(F.lit(score)))
    assert list(got) == pytest.approx([w / sum(weights) for w in weights])
    assert sum(got) == pytest.approx(1.0)


def test_density_and_speed_truncate_and_clip(spark):
    assert one(spark, risk.density_estimate(F.lit(0.999))) == 89
    assert one(spark, risk.density_estimate(F.lit(1.0), 50)) == 100
    assert one(spark, risk.density_estimate(F.lit(0.0), -90)) == 10
    assert one(spark, risk.speed_estimate(F.lit(80), F.lit(50))) == int(80 * (0.3 + 0.7 * 0.5))
    assert one(spark, risk.speed_estimate(F.lit(40), F.lit(10), 40)) == 50
    assert one(spark, risk.speed_estimate(F.lit(40), F.lit(100), -30)) == 10


def test_rule_score(spark):
    plain = one(spark, risk.rule_score(F.lit(50), F.lit("Clear"), F.lit(12), F.lit(0.6)))
    wet_rush = one(spark, risk.rule_score(F.lit(50), F.lit("Light Rain"), F.lit(9), F.lit(0.6)))
    assert plain == pytest.approx(0.3)
    assert wet_rush == pytest.approx(0.3 * 1.5 * 1.3)
    assert one(spark, risk.rule_score(F.lit(100), F.lit("Rain"), F.lit(8), F.lit(0.95))) == 1.0


def test_rule_probabilities_stay_in_their_bands(spark):
    rows = [(level, str(i)) for level in ("High", "Medium", "Low") for i in range(200)]
    df = spark.createDataFrame(rows, "level string, key string")
    df = df.select("level", risk.rule_probs(F.col("level"), F.col("key")).alias("p"), risk.rule_confidence(F.col("level"), F.col("key")).alias("c"))
    for r in df.collect():
        p = r["p"].asDict()
        assert p["high"] + p["medium"] + p["low"] == pytest.approx(1.0)
        for name, (lo, hi) in risk.PROBABILITY_BANDS[r["level"]].items():
            assert lo <= p[name.lower()] < hi
        lo, hi = risk.CONFIDENCE_BANDS[r["level"]]
        assert lo <= r["c"] < hi
        assert p["invalid"] == (min(p["high"], p["medium"], p["low"]) < 0)


def test_alert(spark):
    rows = [("High", 0.81, 10), ("High", 0.8, 89), ("Medium", 0.99, 89), ("Low", 0.1, 90)]
    got = values(spark, rows, "l string, c double, d int", risk.alert(F.col("l"), F.col("c"), F.col("d")))
    assert [g[0] for g in got] == [True, False, False, True]


def test_model_side_probabilities(spark):
    probs = F.array(F.lit(0.2), F.lit(0.8))
    assert one(spark, risk.expected_score(probs, ["High", "Low"])) == pytest.approx(0.2 * 0.9 + 0.8 * 0.3)
    assert one(spark, risk.model_confidence(probs, F.lit("Low"), ["High", "Low"])) == pytest.approx(0.8)
    assert one(spark, risk.model_probs(probs, ["High", "Low"])).medium == pytest.approx(0.3)


def test_primary_cause(spark):
    rows = [
        ("Rain", 7, "Speeding", "Friday"), ("Fog", 12, "Other", "Monday"), ("Clear", 17, "Other", "Friday"),
        ("Light Rain", 12, "Other", "Sunday"),
    ]
    got = values(
        spark, rows, "w string, h int, t string, d string",
        text.primary_cause(F.col("w"), F.col("h"), F.col("t"), F.col("d")),
    )
    assert [g[0] for g in got] == [
        "Wet Road Surface, Heavy Traffic, Over-Speeding", "Poor Visibility", "Heavy Traffic, Rush Hour", "Driver Error",
    ]


def test_primary_factors(spark):
    rows = [(80, "Rain", 8, 0.7), (79, "Clear", 12, 0.69)]
    got = values(
        spark, rows, "d int, w string, h int, b double",
        text.primary_factors(F.col("d"), F.col("w"), F.col("h"), F.col("b")),
    )
    assert got[0][0] == "High traffic density, Adverse weather conditions, Rush hour traffic, High-risk location"
    assert got[1][0] == "Normal traffic conditions"


def test_explanations(spark):
    rules = text.explanation("RuleBased", F.lit("High"), F.lit(0.9), F.lit(85), F.lit("Heavy Rain"))
    model = text.explanation("ML", F.lit("High"), F.lit(0.725), F.lit(85), F.lit("Clear"))
    assert one(spark, rules) == (
        "Traffic density at 85% with heavy rain conditions. Risk assessment based on traffic patterns and weather impact"
    )
    assert one(spark, model) == (
        "ML model prediction: High risk with 72% confidence. Traffic density at 85% with clear conditions"
    )


def test_dashboard_text(spark):
    assert one(spark, dashboard.tostring(F.lit(45.0))) == "45"
    assert one(spark, dashboard.tostring(F.lit(45.3))) == "45.3"
    assert one(spark, dashboard.strcat(F.lit("a"), F.lit(None), "b")) == "ab"
    assert one(spark, dashboard.display_level(F.lit("odd"))) == "LOW"
    assert one(spark, dashboard.alert_marker(F.lit(False))) == ""


def test_cell_colours(spark):
    got = values(
        spark, [(v,) for v in (5, 6, 10, 11, 59, 60, 79, 80)], "v int",
        dashboard.cell_colour(F.col("v"), dashboard.COUNT_RULES), dashboard.cell_colour(F.col("v"), dashboard.DENSITY_RULES),
    )
    assert [g[0] for g in got][:4] == [None, "yellow", "yellow", "red"]
    assert [g[1] for g in got][4:] == [None, "yellow", "yellow", "red"]


def test_rounding_and_clip(spark):
    assert one(spark, numeric.rounded(F.lit(1.005), 2)) == 1.01
    assert one(spark, numeric.clip(F.lit(0.1), 0.3, 0.95)) == 0.3
    assert one(spark, numeric.clip(F.lit(None).cast("double"), 0.3, 0.95)) is None


def test_uniform_is_fixed_and_spread(spark):
    df = spark.range(5000).select(numeric.uniform01(F.col("id"), ":x").alias("u"))
    got = [r.u for r in df.collect()]
    assert got == [r.u for r in df.collect()]
    assert 0 <= min(got) and max(got) < 1
    assert math.isclose(sum(got) / len(got), 0.5, abs_tol=0.02)
