"""Fixed values of the price-paid feed.

These must equal the published feed specification for results to be right.
They are stated once, here, and every other module reads them from here.
"""
from __future__ import annotations

# --- fixed values: feed column order (headerless file, published order) ---
FEED_COLUMNS = [
    "transaction_id",
    "price",
    "date_of_transfer",
    "postcode",
    "property_type",
    "old_new",
    "duration",
    "paon",
    "saon",
    "street",
    "locality",
    "town_city",
    "district",
    "county",
    "ppd_category_type",
    "record_status",
]

# --- fixed values: timestamp text in the feed ---
FEED_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm"

# --- fixed values: code dictionaries ---
PROPERTY_TYPES = {
    "D": "Detached",
    "S": "Semi-Detached",
    "T": "Terraced",
    "F": "Flat/Maisonette",
    "O": "Other",
}
DURATIONS = {"F": "Freehold", "L": "Leasehold", "U": "Unknown"}
PPD_CATEGORIES = {"A": "Standard Price Paid", "B": "Additional Price Paid"}

# --- fixed values: cleaning bounds and live statuses ---
MIN_PLAUSIBLE_PRICE = 1_000
MAX_PLAUSIBLE_PRICE = 50_000_000
LIVE_STATUSES = ("A", "C")

# --- fixed values: analysis defaults ---
MIN_CELL_ROWS = 30          # thin-cell floor
MEDIAN_ACCURACY = 10_000    # percentile_approx accuracy
