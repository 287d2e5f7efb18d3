"""Parameters of the sales pipeline.

Everything the models treat as a literal (areas, regions, borough lists, price bands,
thresholds, analysis years, calendar) lives here so that a run can be re-aimed at another
market or at the test fixture without touching the model code.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

# ---------------------------------------------------------------------------------------
# Fixed values. These must equal the published behaviour for results to match; they are
# stated once, in natural order, and everything else refers to them by name.
# ---------------------------------------------------------------------------------------

# Postcode areas kept at ingestion (leading capital letters of the postcode).
LONDON_AREAS = ("E", "EC", "N", "NW", "SE", "SW", "W", "WC")

# Region label per postcode area; anything else is "Other".
REGION_BY_AREA = (
    ("E", "East London"),
    ("EC", "East Central London"),
    ("N", "North London"),
    ("NW", "North West London"),
    ("SE", "South East London"),
    ("SW", "South West London"),
    ("W", "West London"),
    ("WC", "West Central London"),
)
OTHER_REGION = "Other"

CENTRAL_BOROUGHS = (
    "City of London",
    "Westminster",
    "Kensington and Chelsea",
    "Camden",
    "Islington",
    "Southwark",
    "Lambeth",
    "Hammersmith and Fulham",
)

# Compared with the letters-only postcode area, so only EC and WC can ever match.
PRIME_AREAS = ("EC", "WC", "W1", "SW1", "SW3", "SW7", "NW1")

PROPERTY_TYPES = (
    ("D", "Detached"),
    ("S", "Semi-Detached"),
    ("T", "Terraced"),
    ("F", "Flat"),
    ("O", "Other"),
)
TENURES = (("F", "Freehold"), ("L", "Leasehold"))
PPD_TYPES = (("A", "Standard"), ("B", "Additional"))
NEW_BUILD = (("Y", True), ("N", False))
UNKNOWN_LABEL = "Unknown"

PROPERTY_DESCRIPTIONS = (
    ("Detached", "Standalone house"),
    ("Semi-Detached", "House sharing one wall"),
    ("Terraced", "House in a row sharing both walls"),
    ("Flat", "Apartment within a larger building"),
    ("Other", "Non-standard property type"),
)
UNKNOWN_PROPERTY_DESCRIPTION = "Unknown property type"
HOUSE_TYPES = ("Detached", "Semi-Detached", "Terraced")
PROPERTY_CATEGORY_HOUSE = "House"
PROPERTY_CATEGORY_FLAT = "Apartment"
PROPERTY_CATEGORY_OTHER = "Other"

# Upper bounds are exclusive; the last label takes everything above.
PRICE_BANDS = (
    (250_000, "1. Under £250K"),
    (500_000, "2. £250K-£500K"),
    (750_000, "3. £500K-£750K"),
    (1_000_000, "4. £750K-£1M"),
    (2_000_000, "5. £1M-£2M"),
    (5_000_000, "6. £2M-£5M"),
)
TOP_PRICE_BAND = "7. £5M+"

MARKET_SEGMENTS = (
    (500_000, "Affordable"),
    (1_500_000, "Mid-Market"),
    (5_000_000, "Premium"),
)
TOP_MARKET_SEGMENT = "Super-Prime"

MILLION_PLUS = 1_000_000
SUPER_PRIME = 5_000_000

LIQUIDITY_TIERS = (
    (1, "High Liquidity"),
    (2, "Moderate Liquidity"),
    (3, "Lower Liquidity"),
    (4, "Thin Market"),
)

# Ratio of a postcode median to its borough median; upper bounds exclusive.
VALUE_POSITIONS = (
    (0.75, "Significantly Undervalued (>25% below)"),
    (0.90, "Undervalued (10-25% below)"),
    (1.10, "In Line With Borough"),
    (1.25, "Premium (10-25% above)"),
)
TOP_VALUE_POSITION = "Significant Premium (>25% above)"

UNMATCHED_BOROUGH = "Unmatched"
SURROGATE_KEY_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_KEY_SEPARATOR = "-"

MIN_POSTCODE_SALES = 30
MIN_SEGMENT_SALES = 50
MIN_TYPE_SALES = 50

# Investment-matrix labels (the fourth label is our own name for high growth + high volume).
QUADRANT_LABELS = (
    ("high_growth_high_volume", "Prime"),
    ("high_growth_low_volume", "Growth Markets"),
    ("low_growth_high_volume", "Safe Harbour"),
    ("low_growth_low_volume", "Avoid"),
)


@dataclass(frozen=True)
class Config:
    """Model parameters. Defaults reproduce the published London analysis."""

    areas: tuple[str, ...] = LONDON_AREAS
    region_by_area: tuple[tuple[str, str], ...] = REGION_BY_AREA
    central_boroughs: tuple[str, ...] = CENTRAL_BOROUGHS
    prime_areas: tuple[str, ...] = PRIME_AREAS
    # Calendar of the date dimension: [start, end).
    calendar_start: dt.date = dt.date(2021, 1, 1)
    calendar_end: dt.date = dt.date(2025, 1, 1)
    first_year: int = 2021
    last_year: int = 2024
    recent_since_year: int = 2023
    min_postcode_sales: int = MIN_POSTCODE_SALES
    min_segment_sales: int = MIN_SEGMENT_SALES
    min_type_sales: int = MIN_TYPE_SALES
    million_plus: int = MILLION_PLUS
    super_prime: int = SUPER_PRIME
    top_liquidity_k: int = 5
    price_bands: tuple[tuple[int, str], ...] = PRICE_BANDS
    top_price_band: str = TOP_PRICE_BAND
    market_segments: tuple[tuple[int, str], ...] = MARKET_SEGMENTS
    top_market_segment: str = TOP_MARKET_SEGMENT
    value_positions: tuple[tuple[float, str], ...] = VALUE_POSITIONS
    top_value_position: str = TOP_VALUE_POSITION
    # Largest row count a lookup / dimension may have to be broadcast.
    broadcast_max_rows: int = 200_000
    # Yearly raw file names carry the year: pp-2021.csv, or pp=2021 when written by Spark.
    year_in_path_pattern: str = r"pp[-=](\d{4})"

    def with_(self, **kw) -> "Config":
        return replace(self, **kw)


LONDON = Config()

# The driver's test tables hold no property sales. The fixture adapter derives them from
# orders (see sources/fixture.py); its calendar, analysis years and central list follow.
FIXTURE = Config(
    central_boroughs=tuple(f"NATION_{i}" for i in range(8)),
    calendar_start=dt.date(1997, 1, 1),
    calendar_end=dt.date(2001, 1, 1),
    first_year=1997,
    last_year=2000,
    recent_since_year=1999,
)
