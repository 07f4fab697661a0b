"""What the operators are told about weather readings: schemas, rules and lists."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from obsloom.functions.bins import bin_left_closed, bin_right_closed
from obsloom.functions.labels import Rule, label
from obsloom.operators.conform import columns

# The columns of a raw reading.
READING_SCHEMA = columns(
    "time string, province string, city string, temperature double, temp_min double, temp_max double, "
    "humidity int, feels_like double, visibility int, precipitation double, cloudcover int, "
    "wind_speed double, wind_gust double, wind_direction int, pressure int, is_day boolean, "
    "weather_code int, weather_main string, weather_description string, weather_icon string"
)

# The columns of the silver table, in order.
SILVER_SCHEMA = columns(
    "time timestamp, province string, region string, city string, temperature double, temp_min double, "
    "temp_max double, humidity double, feels_like double, visibility double, precipitation double, "
    "cloudcover double, wind_speed double, wind_gust double, wind_direction double, pressure double, "
    "is_day boolean, weather_code int, weather_main string, weather_description string, weather_icon string, "
    "hour int, day int, month int, weekday int, temp_range double, wind_dir_sin double, wind_dir_cos double, "
    "rain int, extreme string, temp_level string, humidity_level string, pressure_level string, "
    "wind_level string, temp_lag_1 double, humidity_lag_1 double, pressure_lag_1 double, update_at timestamp"
)

# The columns of the gold table, in order.
GOLD_SCHEMA = columns(
    "time timestamp, province string, city string, temperature double, humidity double, pressure double, "
    "wind_speed double, precipitation double, cloudcover double, risk_score double, update_at timestamp"
)

# Measured columns kept to 2 digits, derived ones kept to 4.
MEASURED = [
    "temperature", "temp_min", "temp_max", "humidity", "feels_like", "visibility", "precipitation",
    "cloudcover", "wind_speed", "wind_gust", "wind_direction", "pressure",
]
DERIVED = ["temp_range", "wind_dir_sin", "wind_dir_cos", "temp_lag_1", "humidity_lag_1", "pressure_lag_1"]

# Weights of the risk score.
RISK_WEIGHTS = {"precipitation": 0.4, "wind_speed": 0.3, "cloudcover": 0.2, "humidity": 0.1}

# Cities by region.
REGION_CITIES = {
    "north": [
        "Bac Giang", "Bac Kan", "Bac Ninh", "Tu Son", "Cao Bang", "Dien Bien Phu", "Ha Giang", "Ha Noi",
        "Hai Duong", "Hai Phong", "Hoa Binh", "Hung Yen", "My Hao", "Lai Chau", "Lang Son", "Lao Cai",
        "Nam Dinh", "Ninh Binh", "Tam Diep", "Viet Tri", "Cam Pha", "Ha Long", "Mong Cai", "Uong Bi",
        "Son La", "Song Cong", "Thai Nguyen", "Tuyen Quang", "Phuc Yen", "Vinh Yen", "Yen Bai",
    ],
    "central": [
        "Quy Nhon", "Phan Thiet", "Da Nang", "Buon Ma Thuot", "Gia Nghia", "Pleiku", "Ha Tinh", "Hong Linh",
        "Cam Ranh", "Nha Trang", "Kon Tum", "Phan Rang - Thap Cham", "Tuy Hoa", "Dong Hoi", "Hoi An",
        "Tam Ky", "Quang Ngai", "Dong Ha", "Thai Hoa", "Vinh", "Sam Son", "Thanh Hoa",
    ],
    "south": [
        "Chau Doc", "Long Xuyen", "Ba Ria", "Vung Tau", "Bac Lieu", "Ben Tre", "Di An", "Thu Dau Mot",
        "Thuan An", "Dong Xoai", "Ca Mau", "Can Tho", "Bien Hoa", "Long Khanh", "Nga Bay", "Vi Thanh",
        "Ha Tien", "Rach Gia", "Tan An", "Soc Trang", "Ho Chi Minh", "Tay Ninh", "My Tho", "Tra Vinh",
        "Vinh Long",
    ],
}
CITY_REGION = {city: region for region, cities in REGION_CITIES.items() for city in cities}
UNKNOWN_REGION = "unknown"

# Inputs of the classifiers.
FEATURES = [
    "humidity", "visibility", "cloudcover", "wind_direction", "pressure", "is_day", "hour", "day", "month",
    "weekday", "wind_dir_sin", "wind_dir_cos", "temp_lag_1", "humidity_lag_1", "pressure_lag_1",
]
# What a reading is taken to be where the caller says nothing.
SCORING_DEFAULTS = {
    "temperature": 28.0, "temp_min": 24.0, "temp_max": 32.0, "humidity": 80.0, "visibility": 10.0,
    "cloudcover": 50.0, "wind_direction": 0.0, "pressure": 1013.0, "is_day": 1, "hour": 12, "day": 15,
    "month": 6, "weekday": 3, "temp_lag_1": 28.0, "humidity_lag_1": 80.0, "pressure_lag_1": 1013.0,
}
# Columns that give the target away or are no numbers.
LEAKING = [
    "extreme", "rain", "time", "weather_code", "weather_main", "weather_description", "weather_icon",
    "temperature", "temp_min", "temp_max", "feels_like", "temp_range", "wind_speed", "wind_gust", "rainfall",
    "precipitation", "temp_level", "humidity_level", "pressure_level", "wind_level",
]

# Mining limits per region, and the items a rule should lead to.
MIN_SUPPORT = {"north": 0.005, "central": 0.005, "south": 0.001}
MIN_CONFIDENCE = {"north": 0.1, "central": 0.1, "south": 0.05}
# Regions without limits of their own.
DEFAULT_SUPPORT, DEFAULT_CONFIDENCE = 0.005, 0.1
RULE_TARGETS = ["rain_yes", "heatwave", "heavy_rain", "storm"]
EXTREME_TARGETS = ["heatwave", "heavy_rain", "storm"]
MAX_RULES = 200
MIN_LIFT = 1.5

CLUSTER_FEATURES = [
    "temperature", "temp_min", "temp_max", "temp_range", "humidity", "pressure", "wind_speed", "precipitation",
    "cloudcover",
]
CITY_FEATURES = ["temperature", "humidity", "pressure", "wind_speed", "cloudcover"]

# Bin names, inner cuts, and outer ends of the closed variant.
LEVELS = {
    "temp_level": ("temp_max", -100, (20, 30), 100, ("temp_low", "temp_medium", "temp_high")),
    "humidity_level": ("humidity", 0, (60, 80), 100, ("humidity_low", "humidity_medium", "humidity_high")),
    "pressure_level": ("pressure", 0, (1000, 1015), 2000, ("pressure_low", "pressure_normal", "pressure_high")),
    "wind_level": ("wind_speed", 0, (10, 25), 100, ("wind_low", "wind_medium", "wind_high")),
}
HEAT_ABOVE, DOWNPOUR_ABOVE, STORM_ABOVE = 35, 50, 40


def five_class_rules(rain: str = "precipitation") -> list[Rule]:
    """Variant v1: heat, heavy rain, storm, rain; ``rain`` names the column with the amount."""
    return [
        ("heatwave", F.col("temp_max") > HEAT_ABOVE),
        ("heavy_rain", F.col(rain) > DOWNPOUR_ABOVE),
        ("storm", F.col("wind_speed") > STORM_ABOVE),
        ("rain", F.col(rain) > 0),
    ]


def four_class_rules(rain: str = "rain") -> list[Rule]:
    """Variant v2: heat, rain, storm; rain goes before storm."""
    return [
        ("heatwave", F.col("temp_max") > HEAT_ABOVE),
        ("rain", F.col(rain) > 0),
        ("storm", F.col("wind_speed") > STORM_ABOVE),
    ]


def extreme(variant: str = "v1", rain: str | None = None) -> Column:
    rules = five_class_rules(rain or "precipitation") if variant == "v1" else four_class_rules(rain or "rain")
    return label(rules, "normal")


def levels(variant: str = "v1", null_to_top: bool = False) -> dict[str, Column]:
    """The four level columns: v1 closes its bins on the right, v2 on the left."""
    out = {}
    for name, (source, bottom, cuts, top, names) in LEVELS.items():
        if variant == "v1":
            out[name] = bin_right_closed(F.col(source), [bottom, *cuts, top], names)
        else:
            out[name] = bin_left_closed(F.col(source), cuts, names, null_to_top)
    return out
