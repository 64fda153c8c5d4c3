"""Configuration of the civic feeds: crime, restaurant inspections, 311 complaints, rent.

File names, column names, sentinels, thresholds, weights, overrides and labels below are
fixed values: the contract of the published feeds and of the tables derived from them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from areascore.operators.cleaning import CleanSpec
from areascore.operators.scoring import ScoreSpec
from areascore.operators.summaries import Metric

RAW_FILES = {
    "crime": "nypd_complaints.csv",
    "restaurants": "restaurant_inspections.csv",
    "complaints311": "complaints_311_food.csv",
    "rent": "zori_zip.csv",
}

# Feeds with free text that may hold line breaks; a file of these is read by one task.
MULTI_LINE = {"crime": True, "restaurants": True, "complaints311": True, "rent": False}

# Raw columns and their types. Dates are carried as text, as the feeds spell them.
RAW_COLUMNS = {
    "crime": {
        "CMPLNT_NUM": "string",
        "CMPLNT_FR_DT": "string",
        "OFNS_DESC": "string",
        "LAW_CAT_CD": "string",
        "BORO_NM": "string",
        "Latitude": "double",
        "Longitude": "double",
    },
    "restaurants": {
        "CAMIS": "string",
        "DBA": "string",
        "BORO": "string",
        "ZIPCODE": "string",
        "CUISINE DESCRIPTION": "string",
        "INSPECTION DATE": "string",
        "SCORE": "int",
        "GRADE": "string",
        "Latitude": "double",
        "Longitude": "double",
    },
    "complaints311": {
        "unique_key": "string",
        "created_date": "string",
        "complaint_type": "string",
        "descriptor": "string",
        "incident_zip": "string",
        "borough": "string",
        "latitude": "double",
        "longitude": "double",
    },
}

CRITICAL_SCORE = 28
COMPLAINT_TYPES = [
    "Food Poisoning",
    "Food Establishment",
    "Rodent",
    "Unsanitary Animal Pvt Property",
]


def clean_specs() -> dict[str, CleanSpec]:
    """How the three point feeds are cleaned (conditions need a running session)."""
    return {
        "crime": CleanSpec(
            columns={name: name for name in RAW_COLUMNS["crime"]},
            required=["BORO_NM", "OFNS_DESC", "Latitude", "Longitude"],
            upper=["BORO_NM", "OFNS_DESC", "LAW_CAT_CD"],
            sentinels={"BORO_NM": ["(NULL)", ""]},
            flags={"IS_FELONY": F.col("LAW_CAT_CD") == "FELONY"},
        ),
        "restaurants": CleanSpec(
            columns={
                "CAMIS": "CAMIS",
                "DBA": "DBA",
                "BORO": "BORO",
                "ZIPCODE": "ZIPCODE",
                "CUISINE DESCRIPTION": "CUISINE",
                "INSPECTION DATE": "INSPECTION_DATE",
                "SCORE": "SCORE",
                "GRADE": "GRADE",
                "Latitude": "Latitude",
                "Longitude": "Longitude",
            },
            required=["BORO", "SCORE", "Latitude", "Longitude"],
            upper=["BORO", "DBA", "CUISINE", "GRADE"],
            sentinels={"BORO": ["0", ""]},
            flags={"IS_CRITICAL": F.col("SCORE") >= CRITICAL_SCORE},
        ),
        "complaints311": CleanSpec(
            columns={
                "unique_key": "COMPLAINT_ID",
                "created_date": "CREATED_DATE",
                "complaint_type": "COMPLAINT_TYPE",
                "descriptor": "DESCRIPTOR",
                "incident_zip": "ZIPCODE",
                "borough": "BORO",
                "latitude": "Latitude",
                "longitude": "Longitude",
            },
            required=["COMPLAINT_TYPE", "Latitude", "Longitude"],
            upper=["BORO", "COMPLAINT_TYPE"],
            sentinels={"BORO": ["UNSPECIFIED"]},
        ),
    }


POINT_FEEDS = ["crime", "restaurants", "complaints311"]

RENT_CITY = "New York"
RENT_PATTERN = "new york"
RENT_PATTERN_COLUMNS = ["Metro", "MsaName"]

POLYGON_FILE = "nta.geojson"
POPULATION_FILE = "nta_population.csv"
ZIP_LOOKUP_FILE = "zip_to_nta.csv"

AREA_KEYS = ["nta_code", "nta_name"]
FEATURES_TABLE = "neighborhood_features.parquet"
SCORES_TABLE = "newcomer_score.parquet"
DIAGNOSTICS_TABLE = "score_diagnostics.parquet"

RENT_OVERRIDES = {"MN0601": 5775.0, "MN0301": 5500.0, "MN0602": 6300.0, "MN0402": 4475.0}

RATES = {"crimes_per_1k": "total_crimes", "complaints_per_1k": "n_complaints"}
FILLED = [
    "total_crimes",
    "felonies",
    "felony_share",
    "n_inspections",
    "critical_rate",
    "n_complaints",
    "crimes_per_1k",
    "complaints_per_1k",
]

SCORE_SPEC = ScoreSpec(
    directions={
        "crimes_per_1k": -1,
        "felony_share": -1,
        "avg_score": -1,
        "critical_rate": -1,
        "complaints_per_1k": -1,
        "median_rent_zori": -1,
    },
    subscores={
        "safety_score": ["crimes_per_1k", "felony_share"],
        "food_safety_score": ["avg_score", "critical_rate"],
        "cleanliness_score": ["complaints_per_1k"],
        "affordability_score": ["median_rent_zori"],
    },
    weights={
        "safety_score": 0.30,
        "food_safety_score": 0.25,
        "cleanliness_score": 0.15,
        "affordability_score": 0.30,
    },
    gate_measure="median_rent_zori",
    gate_count="n_inspections",
    gate_min=20,
    composite="newcomer_score",
    available="score_available",
    rescaled="newcomer_score_100",
)

# Result tables, and the columns that the stages add or look for.
RESULT_TABLES = {
    "summary": "summary",
    "histogram": "distribution",
    "top_bottom": "top_bottom",
    "boxes": "borough_box",
    "box_points": "borough_points",
    "correlation": "correlation",
    "bins": "rent_vs_feature_bins",
    "fits": "rent_vs_feature_ols",
    "points": "rent_vs_feature_points",
}
AREA_CODE, AREA_NAME = AREA_KEYS
AREA_GROUP, AREA_COUNT = "borough", "n_ntas"
RENT, RENT_IMPUTED = "median_rent_zori", "median_rent_imputed"

METRICS = [
    Metric("score", "newcomer_score_100", "Newcomer Score", "/ 100", True),
    Metric("crime", "crimes_per_1k", "Crimes per 1k residents", "per 1k", False),
    Metric("food", "critical_rate", "Critical inspection rate", "share", False),
    Metric("rent", "median_rent_zori", "Median rent (ZORI)", "$ / month", False),
    Metric("311", "complaints_per_1k", "311 complaints per 1k", "per 1k", False),
]

BOROUGHS = {
    "MN": "Manhattan",
    "BK": "Brooklyn",
    "QN": "Queens",
    "BX": "Bronx",
    "SI": "Staten Island",
}
