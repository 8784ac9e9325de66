"""What is known about features: family, value columns, how a value spreads over time."""

from __future__ import annotations

from collections.abc import Iterable

# Names as the exports write them.
CUMULATIVE = (
    "StepCount",
    "DistanceWalkingRunning",
    "BasalEnergyBurned",
    "ActiveEnergyBurned",
    "FlightsClimbed",
    "DailyDistanceCycling",
    "BloodGlucose",
    "DailyDistanceSwimming",
    "EnergyConsumed",
    "Carbohydrates",
    "Protein",
    "TotalFat",
    "BloodAlcoholContent",
)
IGNORED = ("Mindful",)
SOURCE = "applehealthkit"
DAILY_SUMMARY = "ActivitySummary"
SENSITIVE = ("id", "metadata", "source_id", "source_name")
NO_TIME_ACCUMULATION = ("ActivitySummary", "Height", "Weight")
CONTEXT = ("datetime", "created_at", "updated_at", "participant_id", "data_source")
VALUE_COLUMNS = {
    "scalar": ("value",),
    "blood_pressure": ("blood_pressure_systolic_value", "blood_pressure_diastolic_value"),
    "ecg": ("average_heart_rate", "sampling_frequency", "voltage_measurements"),
    "daily_summary": (
        "apple_stand_hours",
        "apple_exercise_time",
        "active_energy_burned",
        "apple_stand_hours_goal",
        "apple_exercise_time_goal",
        "active_energy_burned_goal",
    ),
}
# End of fixed values.


def is_cumulative(name: str) -> bool:
    """Whether a value is an amount to share out over its windows rather than a level to repeat."""
    return name in CUMULATIVE


def family(columns: Iterable[str]) -> str:
    """Family of a record from the columns it has; the first that fits counts."""
    have = set(columns)
    if "value" in have:
        return "scalar"
    if have.issuperset(VALUE_COLUMNS["blood_pressure"]):
        return "blood_pressure"
    return "ecg" if "average_heart_rate" in have else "daily_summary"


def value_columns(columns: Iterable[str]) -> list[str]:
    """The columns to aggregate, among those present."""
    have = set(columns)
    return [c for c in VALUE_COLUMNS[family(have)] if c in have]
