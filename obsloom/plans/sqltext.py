"""Pieces of DuckDB text shared by the checks."""

from __future__ import annotations


def half_up_sql(expression: str, digits: int) -> str:
    """The same rounding as ``functions.rounding.half_up``."""
    return f"cast(round(cast({expression} as decimal(38,{digits + 6})), {digits}) as double)"


def label_v1_sql(rain: str = "precipitation") -> str:
    return (
        f"case when temp_max > 35 then 'heatwave' when {rain} > 50 then 'heavy_rain' "
        f"when wind_speed > 40 then 'storm' when {rain} > 0 then 'rain' else 'normal' end"
    )


def label_v2_sql() -> str:
    return (
        "case when temp_max > 35 then 'heatwave' when precipitation > 0 then 'rain' "
        "when wind_speed > 40 then 'storm' else 'normal' end"
    )


def level_right_sql(column: str, low: float, a: float, b: float, high: float, names: tuple[str, str, str]) -> str:
    return (
        f"case when {column} > {low} and {column} <= {a} then '{names[0]}' "
        f"when {column} > {a} and {column} <= {b} then '{names[1]}' "
        f"when {column} > {b} and {column} <= {high} then '{names[2]}' end"
    )


def level_left_sql(column: str, a: float, b: float, names: tuple[str, str, str], null_to_top: bool = False) -> str:
    null = f"'{names[2]}'" if null_to_top else "null"
    return (
        f"case when {column} is null then {null} when {column} < {a} then '{names[0]}' "
        f"when {column} < {b} then '{names[1]}' else '{names[2]}' end"
    )


# The level bins, written once more for the checks.
LEVEL_BINS = [
    ("temp_level", "temp_max", -100, 20, 30, 100, ("temp_low", "temp_medium", "temp_high")),
    ("humidity_level", "humidity", 0, 60, 80, 100, ("humidity_low", "humidity_medium", "humidity_high")),
    ("pressure_level", "pressure", 0, 1000, 1015, 2000, ("pressure_low", "pressure_normal", "pressure_high")),
    ("wind_level", "wind_speed", 0, 10, 25, 100, ("wind_low", "wind_medium", "wind_high")),
]


def levels_sql(variant: str = "v1", null_to_top: bool = False) -> str:
    out = []
    for name, column, low, a, b, high, names in LEVEL_BINS:
        text = (
            level_right_sql(column, low, a, b, high, names)
            if variant == "v1"
            else level_left_sql(column, a, b, names, null_to_top)
        )
        out.append(f"{text} as {name}")
    return ", ".join(out)


def unpivot_sql(source: str, columns: list[str], value: str = "value") -> str:
    """One row per column and row, values as double."""
    return " union all ".join(
        f"select '{c}' as \"column\", cast({c} as double) as {value} from {source}" for c in columns
    )
