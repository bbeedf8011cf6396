"""Postcode area → region dimension.

Built as an inline ``VALUES`` relation, so the optimizer knows its exact size
(a ``LocalRelation``) and nothing is shipped from the Python driver per row.
Any other dimension DataFrame with the same two columns can be used instead.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# --- fixed values: postcode area → region (121 areas, alphabetical by area) ---
# The feed covers England and Wales, so Scottish areas and BT never match; TD
# is listed under North East because every TD sale in the feed is English.
REGION_TABLE = {
    "AB": "Scotland",
    "AL": "East of England",
    "B": "West Midlands",
    "BA": "South West",
    "BB": "North West",
    "BD": "Yorkshire",
    "BH": "South West",
    "BL": "North West",
    "BN": "South East",
    "BR": "London",
    "BS": "South West",
    "BT": "Northern Ireland",
    "CA": "North West",
    "CB": "East of England",
    "CF": "Wales",
    "CH": "North West",
    "CM": "East of England",
    "CO": "East of England",
    "CR": "London",
    "CT": "South East",
    "CV": "West Midlands",
    "CW": "North West",
    "DA": "London",
    "DD": "Scotland",
    "DE": "East Midlands",
    "DG": "Scotland",
    "DH": "North East",
    "DL": "North East",
    "DN": "Yorkshire",
    "DT": "South West",
    "DY": "West Midlands",
    "E": "London",
    "EC": "London",
    "EH": "Scotland",
    "EN": "London",
    "EX": "South West",
    "FK": "Scotland",
    "FY": "North West",
    "G": "Scotland",
    "GL": "South West",
    "GU": "South East",
    "HA": "London",
    "HD": "Yorkshire",
    "HG": "Yorkshire",
    "HP": "South East",
    "HR": "West Midlands",
    "HS": "Scotland",
    "HU": "Yorkshire",
    "HX": "Yorkshire",
    "IG": "London",
    "IP": "East of England",
    "IV": "Scotland",
    "KA": "Scotland",
    "KT": "South East",
    "KW": "Scotland",
    "KY": "Scotland",
    "L": "North West",
    "LA": "North West",
    "LD": "Wales",
    "LE": "East Midlands",
    "LL": "Wales",
    "LN": "East Midlands",
    "LS": "Yorkshire",
    "LU": "East of England",
    "M": "North West",
    "ME": "South East",
    "MK": "South East",
    "ML": "Scotland",
    "N": "London",
    "NE": "North East",
    "NG": "East Midlands",
    "NN": "East Midlands",
    "NP": "Wales",
    "NR": "East of England",
    "NW": "London",
    "OL": "North West",
    "OX": "South East",
    "PA": "Scotland",
    "PE": "East of England",
    "PH": "Scotland",
    "PL": "South West",
    "PO": "South East",
    "PR": "North West",
    "RG": "South East",
    "RH": "South East",
    "RM": "London",
    "S": "Yorkshire",
    "SA": "Wales",
    "SE": "London",
    "SG": "East of England",
    "SK": "North West",
    "SL": "South East",
    "SM": "London",
    "SN": "South West",
    "SO": "South East",
    "SP": "South West",
    "SR": "North East",
    "SS": "East of England",
    "ST": "West Midlands",
    "SW": "London",
    "SY": "Wales",
    "TA": "South West",
    "TD": "North East",
    "TF": "West Midlands",
    "TN": "South East",
    "TQ": "South West",
    "TR": "South West",
    "TS": "North East",
    "TW": "London",
    "UB": "London",
    "W": "London",
    "WA": "North West",
    "WC": "London",
    "WD": "East of England",
    "WF": "Yorkshire",
    "WN": "North West",
    "WR": "West Midlands",
    "WS": "West Midlands",
    "WV": "West Midlands",
    "YO": "Yorkshire",
    "ZE": "Scotland",
}

# --- fixed values: the closed set of region names ---
REGIONS = (
    "East Midlands", "East of England", "London", "North East", "North West",
    "Northern Ireland", "Scotland", "South East", "South West", "Wales",
    "West Midlands", "Yorkshire",
)


def region_pairs() -> list[tuple[str, str]]:
    return list(REGION_TABLE.items())


def region_values_sql(area_col: str = "postcode_area", region_col: str = "region") -> str:
    """The dimension as an inline SQL table."""
    rows = ", ".join(f"('{a}', '{r}')" for a, r in region_pairs())
    return f"(VALUES {rows}) AS regions({area_col}, {region_col})"


def region_lookup(spark: SparkSession) -> DataFrame:
    """The area → region dimension: ``postcode_area``, ``region``."""
    return spark.sql(f"SELECT * FROM {region_values_sql()}")
