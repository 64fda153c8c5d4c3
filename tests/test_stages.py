"""The five stages on generated feeds, against the same arithmetic in plain Python."""

import csv
import json
import math
import random
import statistics
from collections import Counter, defaultdict

import pytest
from test_spatial import brute_force, square

from areascore.plans import civic, stages
from areascore.scratch import release
from areascore.sources import Layout

PREFIXES = ["MN", "BK", "QN", "BX", "SI", "ZZ"]
N_AREAS = 36


def areas():
    """A 6 x 6 board of squares, a hole in every fifth, each overlapping its neighbours a little."""
    out = []
    for i in range(N_AREAS):
        x, y = -74 + 0.1 * (i % 6), 40.5 + 0.1 * (i // 6)
        rings = [square(x, y, 0.055)]
        if i % 5 == 0:
            rings.append(square(x, y, 0.01))
        code = "MN0601" if i == 0 else f"{PREFIXES[i % 6]}{i:04d}"
        out.append((code, f"Area {i}", rings))
    return out


def write(path, header, lines):
    with open(path, "w", newline="") as file:
        writer = csv.writer(file)
        writer.writerow(header)
        writer.writerows(lines)


def generate(root):
    rng = random.Random(11)
    for folder in ("raw", "geo"):
        (root / folder).mkdir()
    features = [
        {"type": "Feature", "properties": {"ntaname": name, "nta2020": code}, "geometry": {"type": "Polygon", "coordinates": rings}}
        for code, name, rings in areas()
    ]
    (root / "geo" / civic.POLYGON_FILE).write_text(json.dumps({"type": "FeatureCollection", "features": features}))

    def place():
        # A third of everything falls on one spot.
        if rng.random() < 1 / 3:
            return 40.71, -73.79
        return round(rng.uniform(40.4, 41.1), 5), round(rng.uniform(-74.1, -73.4), 5)

    crime, food, calls = [], [], []
    for i in range(1500):
        lat, lon = place()
        crime.append(
            [f"c{i}", "01/02/2024", rng.choice([" theft", 'arson, "first"\ndegree', ""]),
             rng.choice(["felony ", "MISDEMEANOR", ""]), rng.choice(["bronx", "(null)", " ", "QUEENS"]),
             lat if i % 50 else "", lon, "unused"]
        )
    for i in range(1500):
        lat, lon = place()
        food.append(
            [f"{i % 400}", "a cafe", rng.choice(["Manhattan", "0", "Brooklyn"]),
             rng.choice(["10001", "10002.0", "7030", "none", ""]), "Thai", "01/02/2024",
             rng.choice(["5", "28", "40", "12", "x"]), rng.choice(["a", ""]), lat, lon]
        )
    for i in range(1200):
        lat, lon = place()
        calls.append(
            [f"k{i}", "2024-01-02T03:04:05.000", rng.choice(["Rodent", "Noise", ""]), "d", "10001",
             rng.choice(["BRONX", "Unspecified", ""]), lat, lon]
        )
    write(
        root / "raw" / civic.RAW_FILES["crime"],
        ["CMPLNT_NUM", "CMPLNT_FR_DT", "OFNS_DESC", "LAW_CAT_CD", "BORO_NM", "Latitude", "Longitude", "EXTRA"],
        crime,
    )
    write(root / "raw" / civic.RAW_FILES["restaurants"], list(civic.RAW_COLUMNS["restaurants"]), food)
    write(root / "raw" / civic.RAW_FILES["complaints311"], list(civic.RAW_COLUMNS["complaints311"]), calls)
    rent = [
        ["10001", "New York", "NY", "m", "2000", "2100.5", ""],
        ["10002", "Newark", "NJ", "New York-Newark", "", "1500", "1600"],
        ["7030", "Hoboken", "NJ", "new york", "900", "", ""],
        ["60601", "Chicago", "IL", "Chicago", "1", "2", "3"],
        ["10009", "New York", "NY", "m", "", "", ""],
    ]
    write(
        root / "raw" / civic.RAW_FILES["rent"],
        ["RegionName", "City", "State", "Metro", "2024-01-31", "2024-02-29", "2024-03-31"],
        rent,
    )
    people = [[code, name, 1000 * (i % 4)] for i, (code, name, _) in enumerate(areas()) if i % 6]
    write(root / "geo" / civic.POPULATION_FILE, ["nta_code", "nta_name", "population"], people)
    return crime, food, calls


def expected_features(crime, food, calls):
    shapes = [(code, rings) for code, _, rings in areas()]

    def find(lat, lon):
        return brute_force(shapes, float(lon), float(lat))

    out = defaultdict(dict)
    n, felonies = Counter(), Counter()
    for _, _, offence, law, boro, lat, lon, _ in crime:
        if offence == "" or lat == "" or boro.strip().upper() in ("(NULL)", ""):
            continue
        code = find(lat, lon)
        n[code] += 1
        felonies[code] += law.strip().upper() == "FELONY"
    for code in n:
        out[code].update(total_crimes=n[code], felonies=felonies[code])
    scores, zips = defaultdict(list), defaultdict(Counter)
    for row in food:
        if row[2] == "0" or row[6] == "x":
            continue
        code = find(row[8], row[9])
        scores[code].append(int(row[6]))
        digits = {"10001": "10001", "10002.0": "10002", "7030": "07030"}.get(row[3])
        if digits and code:
            zips[digits][code] += 1
    for code, values in scores.items():
        out[code].update(
            n_inspections=len(values),
            avg_score=statistics.mean(values),
            critical_rate=sum(v >= 28 for v in values) / len(values),
        )
    counted = Counter()
    for row in calls:
        if row[2] != "" and row[5] == "BRONX":
            counted[find(row[6], row[7])] += 1
    for code, count in counted.items():
        out[code]["n_complaints"] = count
    rents = defaultdict(list)
    for digits, value in (("10001", 2100.5), ("10002", 1600.0), ("07030", 900.0)):
        home = min(zips[digits], key=lambda code: (-zips[digits][code], code))
        rents[home].append(value)
    for code, values in rents.items():
        out[code]["median_rent_zori"] = statistics.mean(values)
    out.pop(None, None)
    people = {code: 1000.0 * (i % 4) for i, (code, _, _) in enumerate(areas()) if i % 6}
    for code, row in out.items():
        for name in ("total_crimes", "felonies", "n_inspections", "n_complaints"):
            row.setdefault(name, 0)
        row["felony_share"] = row["felonies"] / row["total_crimes"] if row["total_crimes"] else 0.0
        row.setdefault("avg_score", None)
        row.setdefault("critical_rate", 0.0)
        row["population"] = people.get(code)
        for rate, count in (("crimes_per_1k", "total_crimes"), ("complaints_per_1k", "n_complaints")):
            row[rate] = row[count] / (row["population"] / 1000) if row["population"] else 0.0
        rent = row.setdefault("median_rent_zori", None)
        row["median_rent_imputed"] = rent is None and code in civic.RENT_OVERRIDES
        if row["median_rent_imputed"]:
            row["median_rent_zori"] = civic.RENT_OVERRIDES[code]
    return dict(out)


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("civic")
    feeds = generate(root)
    layout = Layout(str(root))
    cleaned = stages.run_clean(spark, layout)
    enriched = stages.run_enrich(spark, layout)
    stages.run_features(spark, layout)
    stages.run_score(spark, layout)
    stages.run_analytics(spark, layout)
    return layout, cleaned, enriched, expected_features(*feeds)


def close(a, b):
    if a is None or b is None or isinstance(a, (str, bool)):
        return a == b
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)


def test_counts(spark, run):
    layout, cleaned, enriched, _ = run
    assert cleaned["rent"]["rows"] == 3
    assert all(c["rows_in"] == c["rows"] + c["dropped"] for c in cleaned.values())
    assert any(c["dropped"] > 0 for c in cleaned.values())
    for feed in civic.POINT_FEEDS:
        table = spark.read.parquet(layout.enriched(feed))
        assert cleaned[feed]["rows"] == enriched[feed]["rows"] == table.count()
        assert enriched[feed]["hits"] == table.filter("nta_code IS NOT NULL").count() > 0
    assert enriched["rent"] == {"rows": 3, "hits": 3, "hit_pct": 100.0}


def test_cleaned_schema(spark, run):
    layout = run[0]
    crime = spark.read.parquet(layout.cleaned("crime"))
    assert crime.columns == [*civic.RAW_COLUMNS["crime"], "IS_FELONY"]
    texts = {row[0] for row in crime.select("OFNS_DESC").distinct().collect()}
    assert texts == {"THEFT", 'ARSON, "FIRST"\nDEGREE'}
    rent = {row["ZIPCODE"]: row for row in spark.read.parquet(layout.cleaned("rent")).collect()}
    assert (rent["10001"]["month"], rent["10001"]["ZORI"]) == ("2024-02-29", 2100.5)


def test_features(spark, run):
    layout, expected = run[0], run[3]
    got = {row["nta_code"]: row.asDict() for row in spark.read.parquet(layout.scores(civic.FEATURES_TABLE)).collect()}
    assert set(got) == set(expected)
    assert len(got) > 25 and any(row["median_rent_imputed"] for row in got.values())
    for code, row in expected.items():
        for name, value in row.items():
            assert close(got[code][name], value), (code, name)


def test_scores(spark, run):
    layout, features = run[0], run[3]
    got = {row["nta_code"]: row.asDict() for row in spark.read.parquet(layout.scores(civic.SCORES_TABLE)).collect()}
    z = {}
    for name in civic.SCORE_SPEC.directions:
        known = [row[name] for row in features.values() if row[name] is not None]
        mean, spread = statistics.fmean(known), statistics.pstdev(known)
        for code, row in features.items():
            z[code, name] = 0.0 if spread == 0 else -((mean if row[name] is None else row[name]) - mean) / spread
    raw = {}
    for code, row in features.items():
        score = sum(
            weight * statistics.fmean(z[code, name] for name in civic.SCORE_SPEC.subscores[sub])
            for sub, weight in civic.SCORE_SPEC.weights.items()
        )
        starved = row["median_rent_zori"] is None and row["n_inspections"] < 20
        raw[code] = None if starved else score
    known = [score for score in raw.values() if score is not None]
    assert 0 < len(known) < len(raw)
    for code, score in raw.items():
        scaled = None if score is None else 100 * (score - min(known)) / (max(known) - min(known))
        assert close(got[code]["newcomer_score"], score)
        assert got[code]["score_available"] == (score is not None)
        assert (scaled is None and got[code]["newcomer_score_100"] is None) or math.isclose(
            got[code]["newcomer_score_100"], scaled, abs_tol=1e-6
        )


TABLES = {
    "summary": ["metric", "column", "label", "unit", "higher_is_better", "mean", "median", "min", "max", "std", "n_ntas"],
    "distribution": ["metric", "bin_center", "bin_lo", "bin_hi", "count"],
    "top_bottom": ["metric", "kind", "rank", "nta_code", "nta_name", "value"],
    "borough_box": ["metric", "borough", "q1", "median", "q3", "lowerfence", "upperfence"],
    "borough_points": ["metric", "borough", "nta_name", "value"],
    "correlation": ["feature_row", "feature_col", "r"],
    "rent_vs_feature_bins": ["feature", "bin_index", "x_mid", "rent_median", "rent_q1", "rent_q3", "n_ntas"],
    "rent_vs_feature_ols": ["feature", "slope", "intercept", "pearson_r", "r2", "x_min", "x_max", "x_example_median", "y_example_predicted"],
    "rent_vs_feature_points": ["feature", "nta_name", "borough", "x", "y"],
}


def test_result_tables(spark, run):
    layout, features = run[0], run[3]
    tables = {name: spark.read.parquet(layout.analytics(f"{name}.parquet")) for name in TABLES}
    for name, columns in TABLES.items():
        assert tables[name].columns == columns, name
    summary = {row["metric"]: row for row in tables["summary"].collect()}
    assert set(summary) == {"score", "crime", "food", "rent", "311"}
    assert summary["crime"]["n_ntas"] == len(features)
    assert close(summary["crime"]["mean"], statistics.fmean(r["crimes_per_1k"] for r in features.values()))
    counted = {row["metric"]: row["sum(count)"] for row in tables["distribution"].groupBy("metric").sum("count").collect()}
    assert counted == {metric: row["n_ntas"] for metric, row in summary.items()}
    assert tables["correlation"].count() == 36
    assert tables["top_bottom"].filter("metric = 'crime'").count() == 20
    assert tables["borough_points"].count() == sum(counted.values())
    boroughs = {row[0] for row in tables["borough_box"].select("borough").distinct().collect()}
    assert boroughs <= {*civic.BOROUGHS.values(), "Other"} and "Other" in boroughs


def test_command_line(spark, tmp_path, capsys):
    """Two stages with options; the shared folder is empty afterwards."""
    import os

    from areascore import __main__ as cli

    assert list(cli.STAGES) == ["clean", "enrich", "features", "score", "analytics"]
    generate(tmp_path)
    release(spark)
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    cli.main([str(tmp_path), "clean", "enrich", "--only-types"])
    cli.main([str(tmp_path), "features", "score", "--no-fill-rates"])
    out = capsys.readouterr().out
    assert "rows_in" in out and "hit_pct" in out and "imputed" in out and "unscored" in out
    assert set(os.listdir(shared)) == before
    layout = Layout(str(tmp_path))
    kinds = {row[0] for row in spark.read.parquet(layout.scores(civic.DIAGNOSTICS_TABLE)).select("kind").collect()}
    assert kinds >= {"top", "bottom"}
    types = {row[0] for row in spark.read.parquet(layout.cleaned("complaints311")).select("COMPLAINT_TYPE").collect()}
    assert types <= {name.upper() for name in civic.COMPLAINT_TYPES}
