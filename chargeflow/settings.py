"""Names and defaults that all jobs share."""

from __future__ import annotations

from dataclasses import dataclass

#: A vehicle's month is the unit of work: windows and groups have these keys.
KEYS = ["vehicle_id", "yyyymm"]
SESSION = [*KEYS, "session_id"]

# The measured fields of either unit, and how minutes are made of them.
MASTER_FIELDS = ["soc", "voltage", "current", "speed", "cell_temp", "bms_temp", "pack_delta", "charge_limit", "discharge_limit", "km"]
SLAVE_FIELDS = ["soc", "voltage", "current"]
LAST_FIELDS = ["soc", "soc_master", "soc_slave", "km"]
MEAN_FIELDS = [
    "voltage", "voltage_master", "voltage_slave", "current", "current_master", "current_slave",
    "speed", "cell_temp", "bms_temp", "pack_delta", "charge_limit", "discharge_limit",
]

# The feature order that models expect.
FEATURES = [
    "soc", "soc_master", "soc_slave", "voltage", "voltage_master", "voltage_slave", "current", "current_master", "current_slave",
    "bms_temp", "pack_delta", "charge_limit", "discharge_limit", "km", "power_kw", "soc_rate_per_min", "temp_rise_rate",
    "elapsed_min", "soc_delta_to_full",
]
LABEL = "rct_minutes"

# Edges of the ranges of absolute current, in ampere.
CURRENT_EDGES = [0, 1, 5, 10, 20, 40, 80, 200, 1000]


@dataclass(frozen=True)
class Settings:
    """Thresholds of the charging job. The defaults."""

    time_zone: str = "Australia/Melbourne"
    tolerance_s: float = 15.0
    idle_speed: float = 0.5
    min_charge_a: float = 6.0
    max_charge_a: float = 350.0
    min_voltage: float = 300.0
    min_soc_step: float = -0.05
    session_gap_min: float = 10.0
    min_session_min: float = 4.0
    min_delta_soc: float = 0.2
    min_energy_kwh: float = 0.1
    min_idle_share: float = 0.8
    min_median_a: float = 5.0
    max_dt_s: float = 180.0
    soc_step: float = 5.0


DEFAULTS = Settings()
