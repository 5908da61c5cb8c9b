"""Operators against plain Python on small frames, hot keys included."""

from collections import Counter

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roadpulse.operators import dashboard, evaluation, history, neighbours, ordering, partials, patterns, roads
from roadpulse.schemas import ACCIDENT_SCHEMA, EVENT_SCHEMA, ROAD_EDGE_SCHEMA, conform
from roadpulse.sources import dims, tables, weather_docs

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def accidents(spark, rows):
    """Accident rows from dicts; missing columns are null."""
    names = [f.name for f in ACCIDENT_SCHEMA.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ACCIDENT_SCHEMA)


def row(i, location="A", road="R", date="2024-01-10", **more):
    base = {
        "id": i, "accident_id": f"N{i}", "location": location, "road_name": road, "latitude": -1.2,
        "longitude": 36.8, "date": date, "severity": "Minor", "risk_score": 0.5, "hour": 8, "day_of_week": "Monday",
    }
    return {**base, **more}


def test_patterns_cutoff_ties_and_null_keys(spark):
    rows = [
        row(1, hour=9, day_of_week="Tuesday", severity="Fatal"),
        row(2, hour=8, day_of_week="Monday", date="2024-01-03"),
        row(3, hour=7, day_of_week="Sunday", date="2024-01-02"),
        row(4, location=None),
        row(5, location="B", hour=None, day_of_week=None, date="2023-11-01"),
        row(6, location="A", latitude=-1.3),
    ]
    got = {
        (r.LocationName, r.Latitude): r for r in patterns.location_patterns(accidents(spark, rows), updated_at="now").collect()
    }
    assert set(got) == {("A", -1.2), ("A", -1.3), ("B", -1.2)}
    first = got[("A", -1.2)]
    assert (first.AccidentCount_30d, first.FatalCount_30d, first.AccidentCount_7d) == (3, 1, 3)
    assert (first.PeakRiskHour, first.PeakRiskDay) == (7, "Monday")
    assert first.LastAccidentDate == "2024-01-10" and first.UpdatedAt == "now"
    assert got[("A", -1.3)].AccidentCount_7d == 3
    lone = got[("B", -1.2)]
    assert (lone.AccidentCount_7d, lone.PeakRiskHour, lone.PeakRiskDay) == (0, 12, "Monday")
    strict = patterns.location_patterns(accidents(spark, rows), strict_30d=True)
    assert {r.LocationName for r in strict.collect()} == {"A"}


def test_profile_takes_first_known_place_and_caps(spark):
    rows = [
        row(1, latitude=None, severity="Fatal", risk_score=1.0), row(2, latitude=-1.25, severity="Odd"),
        row(3, location="B", road="R2", severity="Minor", risk_score=0.0),
    ]
    got = {r.location_name: r for r in patterns.location_profile(accidents(spark, rows)).collect()}
    assert got["A"].latitude == -1.25
    assert got["A"].base_risk == pytest.approx(min(0.95, 0.3 + 0.4 * 0.75 + 0.3 * 0.75))
    assert got["B"].base_risk == pytest.approx(max(0.3, 0.5 * 0.3 + 0.3 * 0.4 + 0.0))


def test_profile_fallback(spark):
    assert patterns.profile_or_fallback(None, spark).count() == 3


def test_hotspot_first_match(spark):
    names = ["Thika Road", "UCA2 Link", "Uca5", "Mombasa Rd", "A109", "A8 East", "UCB3", "Ngong Road", None]
    frame = spark.createDataFrame([(n, 0.9) for n in names], "road_name string, base_risk double")
    got = {r.road_name: r for r in roads.calibrate(frame, dims.hotspots(spark)).collect()}
    rates = {n: got[n].ntsa_fatal_rate for n in names}
    # "UCA2" holds "a2", so the first hotspot takes it.
    assert rates == {
        "Thika Road": 3.71, "UCA2 Link": 3.71, "Uca5": 5.29, "Mombasa Rd": 2.28, "A109": 2.28, "A8 East": 2.28,
        "UCB3": 3.92, "Ngong Road": None, None: None,
    }
    assert got["Thika Road"].base_risk == 0.95 and got["Ngong Road"].base_risk == 0.9
    assert got["Ngong Road"].ntsa_verified is False


def test_hotspots_of_ones_own(spark):
    own = spark.createDataFrame(
        [(0, "UCB1", 1.0, 1.0, 1.1), (1, "Thika", 2.0, 1.0, 1.05)],
        "rank int, road string, fatal_per_km double, total_annual double, multiplier double",
    )
    frame = spark.createDataFrame([("Thika ucb",), ("Thika",), ("uca1",)], "road_name string").withColumn("base_risk", F.lit(0.5))
    got = {r.road_name: r.ntsa_fatal_rate for r in roads.calibrate(frame, own).collect()}
    assert got == {"Thika ucb": 1.0, "Thika": 2.0, "uca1": None}


def test_alias_and_points(spark):
    def edge(i, name, points, tag="primary"):
        line = None if points is None else [(36.7 + i / 100, -1.2 - p / 100) for p in range(points)]
        return (name, tag, None, (i, i, 7), line)

    edges = spark.createDataFrame(
        [
            edge(1, "OLD A104 way", 3), edge(2, "waiyaki way", 4), edge(3, None, 2), edge(4, "Ngong Road", None),
            edge(5, "Langata Road", 1), edge(6, "Langata Road x", 1, "highway"),
        ],
        ROAD_EDGE_SCHEMA,
    )
    found = {(r.edge_key.u, r.road_group, r.road_name) for r in roads.match_aliases(edges).collect()}
    # The second alias of a group is unused once the first one matches an edge.
    assert found == {
        (2, "Waiyaki Way", "Waiyaki Way"), (4, "Ngong Road", "Ngong Road"),
        (5, "Lang'ata Road", "Langata Road"), (6, "Lang'ata Road", "Langata Road"),
    }
    points = roads.extract_road_points(edges).collect()
    assert Counter(p.road_group for p in points) == {"Waiyaki Way": 3, "Lang'ata Road": 2}
    assert {p.road_type for p in points if p.road_group == "Lang'ata Road"} == {"main_road", "highway"}
    assert {p.osm_id for p in points} == {"7"}


def test_dedup_hot_key_and_idempotence(spark):
    rows = [(i, 1.0 if i % 3 else float(i), f"p{i}") for i in range(300)]
    frame = spark.createDataFrame(rows, "i int, lat double, name string").withColumn("lon", F.lit(2.0))
    once = ordering.dedup_first(frame, ["lat", "lon"], ["i"])
    assert {r.name for r in once.collect()} == {"p1"} | {f"p{i}" for i in range(0, 300, 3)}
    assert once.columns == frame.columns
    twice = ordering.dedup_first(once, ["lat", "lon"], ["i"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


@FEW
@given(st.lists(st.tuples(st.sampled_from(["x", "x", "x", "y", "z"]), st.integers(0, 3)), min_size=1, max_size=60))
def test_sequence_numbers_every_row_in_order(spark, keys):
    rows = [(k, t, i) for i, (k, t) in enumerate(keys)]
    frame = spark.createDataFrame(rows, "k string, t int, i int")
    got = [(r.t, r.i) for r in ordering.with_sequence(frame, ["t", "i"], "n").orderBy("n").collect()]
    assert got == sorted((t, i) for _, t, i in rows)
    numbers = sorted(r.n for r in ordering.with_sequence(frame, ["t", "i"], "n").collect())
    assert numbers == list(range(1, len(rows) + 1))


def test_sequence_with_one_hot_time(spark):
    frame = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("t"), "id")
    got = [r.id for r in ordering.with_sequence(frame, ["t", "id"], "n").orderBy("n").collect()]
    assert got == [i for _, i in sorted((5 if i % 3 == 0 else i, i) for i in range(20_000))]


def test_split_and_folds_with_a_hot_label(spark):
    frame = spark.range(9000).withColumn("label", F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 100 == 1, None).otherwise("b"))
    split = ordering.stratified_split(frame, "label", "id").collect()
    assert len(split) == 9000
    sizes = Counter(r.label for r in split)
    tests = Counter(r.label for r in split if r.is_test)
    assert all(tests[k] == round(0.2 * sizes[k] + 1e-9) for k in sizes)
    folds = Counter((r.label, r.fold) for r in ordering.assign_folds(frame, "label", "id").collect())
    for k in sizes:
        share = [folds[(k, f)] for f in range(5)]
        assert sum(share) == sizes[k] and max(share) - min(share) <= 1


def test_selection_equals_ranking(spark, monkeypatch):
    """Cells that are refined until single hashes, null and one-row labels, and columns named like helpers."""
    frame = spark.range(6000).withColumn("label", F.when(F.col("id") == 7, "one").when(F.col("id") % 50 == 1, None).otherwise((F.col("id") % 2).cast("string")))
    frame = frame.withColumns({"take": F.lit(1), "n": F.lit(2)})
    ranked = ordering.hash_rank(frame, "label", "id", ":split:42", "rank")
    want = {r.id: r.rank <= round(0.2 * r.rank_of + 1e-9) for r in ranked.collect()}
    for rows in (100_000, 2, 0):
        monkeypatch.setattr(ordering, "CELL_ROWS", rows)
        split = ordering.stratified_split(frame, "label", "id")
        assert split.columns == [*frame.columns, "is_test"] and {r.id: r.is_test for r in split.collect()} == want
    monkeypatch.setattr(ordering, "GROUPS_SENT", 0)
    assert {r.id: r.is_test for r in ordering.stratified_split(frame, "label", "id").collect()} == want
    assert ordering.stratified_split(frame.limit(0), "label", "id").count() == 0


def test_sample_keeps_small_groups_whole(spark):
    frame = spark.range(1000).withColumn("k", F.when(F.col("id") < 4, "few").otherwise("many"))
    got = Counter(r.k for r in ordering.sample_n(frame, "k", 15, F.col("id")).collect())
    assert got == {"few": 4, "many": 15}


def brute_asof(events, seen, age):
    out = {}
    for key, t in events:
        current = [(o, v) for o, v in seen if o <= t and t - o < age]
        out[key] = max(current)[0] if current else None
    return out


@FEW
@given(
    st.lists(st.integers(0, 2000), min_size=1, max_size=40), st.lists(st.integers(0, 2000), max_size=15, unique=True),
)
def test_asof_both_ways_match_brute_force(spark, times, seen):
    events = [(str(i), t) for i, t in enumerate(times)]
    ev = spark.createDataFrame(events, "EventId string, s int").select("EventId", F.timestamp_seconds("s").alias("Timestamp"))
    obs = spark.createDataFrame([(t, float(t)) for t in seen], "s int, precipitation double").select(
        F.timestamp_seconds("s").alias("obs_ts"), "precipitation"
    )
    want = brute_asof(events, [(t, t) for t in seen], 300)
    for asof in (history.weather_asof, history.weather_asof_ordered):
        got = asof(ev, obs).collect()
        assert {r.EventId: None if r.precipitation is None else int(r.precipitation) for r in got} == want


def test_weather_documents(spark, tmp_path):
    hours = {"temperature_2m": [0.0] * 24, "precipitation": [0.0] * 12 + [1.26] + [0.0] * 11, "cloudcover": [50.0] * 24,
             "windspeed_10m": [3.26] * 24, "visibility": [None] * 24}
    short = {k: v[:2] for k, v in hours.items()}
    docs = [{"date": "2024-01-01", "hourly": hours}, {"date": "2024-01-02", "hourly": short}, {"date": "2024-01-03"}]
    import json

    (tmp_path / "docs.json").write_text("\n".join(json.dumps(d) for d in docs))
    got = {r.date: r for r in weather_docs.read_weather_docs(spark, str(tmp_path)).collect()}
    first = got["2024-01-01"]
    assert (first.temperature, first.precipitation, first.windspeed, first.visibility) == (20.0, 1.3, 3.3, 10000.0)
    assert (first.weather, first.road_surface) == ("Rain", "Wet")
    assert (got["2024-01-02"].weather, got["2024-01-02"].road_surface) == ("Clear", "Dry")
    assert got["2024-01-03"].temperature == 21.0
    dated = spark.createDataFrame([("2024-01-01",), ("2024-04-09",)], "date string")
    joined = {r.date: r.weather for r in history.with_weather(dated, weather_docs.read_weather_docs(spark, str(tmp_path))).collect()}
    assert joined == {"2024-01-01": "Rain", "2024-04-09": "Clear"}


def test_joined_factors_equal_expressions(spark):
    frame = spark.createDataFrame([(8, "Friday", "Fog"), (99, "Someday", "Hail"), (None, None, None)], "hour int, day_of_week string, weather string")
    joined = history.with_risk_factors(frame, history.factor_tables(spark)).collect()
    direct = history.with_risk_factors(frame).collect()
    assert sorted(map(str, joined)) == sorted(map(str, direct))
    assert tuple(direct[1])[3:] == (1.0, 1.0, 1.0)


def events(spark, rows):
    names = EVENT_SCHEMA.names
    base = {"LocationName": "L", "RoadName": "R", "Latitude": 1.0, "Longitude": 2.0, "RiskLevel": "Low", "RiskScore": 0.5,
            "Confidence": 0.7, "TrafficDensity": 50, "Weather": "Clear", "AlertTriggered": False}
    full = [{**base, **r} for r in rows]
    frame = spark.createDataFrame([tuple(r.get(n) for n in names if n != "Timestamp") + (r["s"],) for r in full],
                                  ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in EVENT_SCHEMA.fields if f.name != "Timestamp") + ", s int")
    return conform(frame.withColumn("Timestamp", F.timestamp_seconds("s")), EVENT_SCHEMA)


def test_dashboard_windows_exclude_their_bound(spark):
    as_of = F.timestamp_seconds(F.lit(10_000))
    rows = [
        {"EventId": "a", "s": 10_000 - 300, "TrafficDensity": 90}, {"EventId": "b", "s": 10_000 - 299, "TrafficDensity": 80},
        {"EventId": "c", "s": 9_999, "TrafficDensity": 79, "RiskLevel": "High", "RiskScore": 0.9, "AlertTriggered": True},
    ]
    ev = events(spark, rows)
    assert dashboard.active_high_risk(ev, as_of).first()[0] == 1
    assert dashboard.active_high_risk(ev.filter("false"), as_of).first()[0] == 0
    spot = dashboard.risk_heatmap(ev, as_of).first()
    assert (spot.Title, spot.Description, spot.RiskColor, spot.Size) == ("L - R", "Density: 83%, Risk: 0.633, Events: 3", "orange", "small")
    impact = dashboard.weather_impact(ev, as_of).first()
    assert (impact.EventCount, impact.HighRiskPercentage, impact.AlertRate) == (3, 33.3, 33.3)
    feed = dashboard.live_feed(ev, as_of).collect()
    assert [f.Density for f in feed] == [79, 80, 90] and feed[0].RiskDisplay == "HIGH"
    stats = dashboard.run_stats(ev).first()
    assert (stats.events_generated, stats.high_risk_events, stats.alerts_triggered, stats.elapsed_minutes) == (3, 1, 1, 5.0)


def test_watchlist_semi(spark):
    profile = spark.createDataFrame([(f"L{i}", "R", i / 20) for i in range(15)], "location_name string, road_name string, base_risk double")
    watched = patterns.watchlist(profile)
    ev = events(spark, [{"EventId": str(i), "s": i, "LocationName": f"L{i}"} for i in range(15)])
    assert {r.LocationName for r in patterns.on_watchlist(ev, watched).collect()} == {f"L{i}" for i in range(3, 15)}


def test_report_with_a_class_never_predicted(spark):
    pairs = [("High", "High"), ("High", "Low"), ("Medium", "High"), ("Low", "Low")]
    pred = spark.createDataFrame(pairs, "label string, prediction string")
    got = {r["class"]: r for r in evaluation.class_report(pred).collect()}
    assert got["Medium"].precision == got["Medium"].recall == got["Medium"].f1 == 0.0
    assert got["High"].precision == 0.5 and got["Low"].recall == 1.0
    assert got["accuracy"].f1 == 0.5
    matrix = {r.label: (r.High, r.Low, r.Medium) for r in evaluation.confusion(pred).collect()}
    assert matrix == {"High": (1, 1, 0), "Low": (0, 1, 0), "Medium": (1, 0, 0)}
    assert sum(map(sum, matrix.values())) == len(pairs)


@pytest.mark.parametrize("block_rows", [7, 1000])
def test_neighbours_match_brute_force(spark, block_rows):
    # A third of the training rows are copies of one point.
    def point(i):
        return [1.0, 1.0] if i % 3 == 0 else [float(i * 7 % 11), float(i * 5 % 13)]

    train = [(i, point(i), "ab"[i % 2]) for i in range(40)]
    test = [(100 + i, [float(i), float(i % 4)]) for i in range(12)]
    left = spark.createDataFrame(train, "id bigint, vector array<double>, label string")
    right = spark.createDataFrame(test, "id bigint, vector array<double>")
    got = {r.test_id: r.prediction for r in neighbours.knn_predict(left, right, 5, block_rows).collect()}
    want = {}
    for i, v in test:
        near = sorted((sum((a - b) ** 2 for a, b in zip(v, w)), j, y) for j, w, y in train)[:5]
        votes = Counter(y for _, _, y in near)
        want[i] = min(votes, key=lambda y: (-votes[y], y))
    assert got == want


@pytest.mark.parametrize("block_rows", [16, 4096])
def test_neighbours_are_exact_and_pruned(spark, block_rows):
    draw = np.random.default_rng(3)
    centres = draw.uniform(-100, 100, (12, 4))
    points = centres[draw.integers(0, 12, 900)] + draw.normal(0, 1, (900, 4))
    points[::3] = points[0]  # a hot point
    asked = np.vstack([centres + 0.5, points[:40], [[1e6] * 4]])
    layout = "id bigint, vector array<double>, label string"
    train = spark.createDataFrame([(i, [float(x) for x in p], "ab"[i % 2]) for i, p in enumerate(points)], layout)
    test = spark.createDataFrame([(i, [float(x) for x in p], "?") for i, p in enumerate(asked)], layout)
    got = {}
    for r in neighbours.knn_neighbours(train, test, 4, block_rows).collect():
        got.setdefault(r.test_id, {})[r.place] = r.train_id
    for i, p in enumerate(asked):
        distance = np.zeros(len(points))
        for d in range(4):
            distance += (p[d] - points[:, d]) ** 2
        assert [got[i][n + 1] for n in range(4)] == np.lexsort((np.arange(len(points)), distance))[:4].tolist()
    # A second search visits the clusters near by only.
    pivots = np.unique(points[:30], axis=0)
    blocks = neighbours.block_table(neighbours.in_cells(train, pivots), block_rows)
    own = neighbours.first_blocks(test.select("id", "vector"), pivots, blocks, 4).withColumn("reach", F.lit(4.0))
    visited = neighbours.other_blocks(own.filter("id < 12"), pivots, blocks).selectExpr("avg(size(blocks)) AS n").first().n
    assert 0 < visited < len(blocks) / 3


def test_matrix_products_lose_no_neighbour(spark):
    """Far from the origin a product tells near distances apart but roughly; the bound covers that, and results are exact."""
    rng = np.random.default_rng(8)
    points = 1e5 + rng.integers(0, 9, (700, 5)) * 1e-3
    found, error = neighbours.squares()(points, points)
    exact = np.zeros((700, 700))
    for dim in range(5):
        exact += (points[:, dim, None] - points[None, :, dim]) ** 2
    assert (abs(found - exact) <= error[:, None]).all() and error.max() > np.unique(exact)[1]
    frame = spark.createDataFrame([(i, p.tolist(), str(i % 3)) for i, p in enumerate(points)], "id long, vector array<double>, label string")
    got = neighbours.knn_neighbours(frame.filter("id >= 100"), frame.filter("id < 100"), 4, 64).collect()
    assert len(got) == 400
    for r in got:
        order = sorted(range(100, 700), key=lambda j: (exact[r.test_id, j], j))
        assert r.train_id == order[r.place - 1] and r.distance == exact[r.test_id, r.train_id]


def test_other_blocks_are_all_that_may_hold_a_nearer_row(spark):
    """Cells are ruled out first, then their rings; none that reaches into a row's reach is left out."""
    rng = np.random.default_rng(4)
    points, pivots = rng.normal(size=(400, 3)), rng.normal(size=(12, 3))
    cells = neighbours.in_cells(spark.createDataFrame([(i, "a", p.tolist()) for i, p in enumerate(points)], "id long, label string, vector array<double>"), pivots)
    blocks = neighbours.block_table(cells, 8)
    asked = spark.createDataFrame([(i, p.tolist(), 0, 0.3) for i, p in enumerate(points[:50])], "id long, vector array<double>, home int, reach double")
    placed = {r.id: (r.cell, r.away) for r in cells.collect()}
    for r in neighbours.other_blocks(asked, pivots, blocks).collect():
        assert len(r.blocks) < len(blocks)
        for i in np.flatnonzero(((points - points[r.id]) ** 2).sum(axis=1) <= 0.09):
            cell, away = placed[i]
            mine = blocks[(blocks["cell"] == cell) & (blocks["above"] < away) & (blocks["high"] >= away)]["block"]
            assert len(mine) == 1 and int(mine.iloc[0]) in r.blocks


def test_neighbours_of_few_or_no_rows(spark):
    layout = "id bigint, vector array<double>, label string"
    train = spark.createDataFrame([(1, [0.0], "a"), (2, [3.0], "b")], layout)
    test = spark.createDataFrame([(7, [1.0], "?"), (8, [3.0], "?")], layout)
    got = [(r.test_id, r.train_id, r.place) for r in neighbours.knn_neighbours(train, test, 5).collect()]
    assert sorted(got) == [(7, 1, 1), (7, 2, 2), (8, 1, 2), (8, 2, 1)]
    for left, right in ((train.limit(0), test), (train, test.limit(0))):
        assert neighbours.knn_predict(left, right).count() == 0


def test_tables_round_trip(spark, tmp_path):
    frame = accidents(spark, [row(1), row(2)])
    tables.save_table(frame, "accident_history")
    assert tables.read_accidents(spark, "accident_history").count() == 2
    tables.save_table(frame, "accident_history", bucket_by="location", buckets=4)
    assert spark.table("accident_history").count() == 2
    assert tables.read_road_points_or_curated(spark, str(tmp_path / "none")).count() == 17
    assert dims.curated_points(spark).filter("latitude between -1.45 and -1.15").count() == 17


def test_daily_partials_follow_changed_days(spark, tmp_path):
    """One day changed and one emptied: only these are read and written, and results equal those of all rows."""

    def history_of(changed):
        rows = []
        for i in range(600):
            day = f"2024-01-{i % 25 + 1:02d}" if i % 3 else "2024-01-09"  # a hot day
            if changed and day == "2024-01-12":
                continue
            more = changed and day == "2024-01-09"
            rows.append(row(
                i, date=day, location=None if i % 41 == 0 else f"L{i % 7}", road_name=None if i % 37 == 0 else f"R{i % 2}",
                latitude=None if i % 29 == 0 else float(i % 3), longitude=36.0, hour=None if i % 11 == 0 else (i * 7 + more) % 24,
                day_of_week=["Friday", "Monday", None][i % 3], severity=["Fatal", "Minor", "Serious"][i * i % 3 - more],
                risk_score=None if i % 13 == 0 else (i % 97) / 97, accident_id=None if i % 17 == 0 else f"A{i}",
            ))
        return accidents(spark, rows)

    def same(got, want, value):
        def listed(frame):
            return sorted(tuple(r) for r in frame.withColumn(value, F.round(value, 9)).select(*sorted(want.columns)).collect())

        assert listed(got) == listed(want) and want.count() > 5

    path, source = str(tmp_path / "partials"), str(tmp_path / "accidents")
    partials.write_partials(history_of(False), path)
    files = set(tmp_path.glob("partials/*/*.parquet"))
    now = history_of(True)
    now.write.partitionBy("date").parquet(source)
    for unread in tmp_path.glob("accidents/date=2024-01-20/*"):
        unread.write_bytes(b"not a table")
    stored = spark.read.schema(ACCIDENT_SCHEMA).parquet(source)
    for _ in range(2):
        partials.update_days(stored, path, ["2024-01-09", "2024-01-12"])
    left = set(tmp_path.glob("partials/*/*.parquet"))
    assert {f.parent.name for f in files ^ left} == {"day=2024-01-09", "day=2024-01-12"}
    table = spark.read.parquet(path)
    for strict in (False, True):
        same(partials.patterns_of(table, strict, "t"), patterns.location_patterns(now, strict, "t"), "AvgRiskScore")
    same(partials.profile_of(table), patterns.location_profile(now), "base_risk")
    assert partials.patterns_of(partials.day_partials(now.limit(0))).count() == 0
