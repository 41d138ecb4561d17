"""Settings of the jobs, as plain frozen dataclasses."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Ranges:
    """Closed ranges a reading must lie in to be valid."""

    # fixed values
    lon: tuple[float, float] = (124.0, 132.0)
    lat: tuple[float, float] = (33.0, 43.0)
    speed: tuple[float, float] = (0.0, 300.0)
    accel: tuple[float, float] = (-100.0, 100.0)
    gyro: tuple[float, float] = (-2000.0, 2000.0)


@dataclass(frozen=True)
class Box:
    """A monitored road area in degrees; all four edges belong to it."""

    name: str
    min_lon: float
    max_lon: float
    min_lat: float
    max_lat: float


# fixed values: the one monitored road
ROAD_863 = Box("863", 127.52, 127.78, 34.50, 35.07)
DEFAULT_BOXES: tuple[Box, ...] = (ROAD_863,)


@dataclass(frozen=True)
class MissingDefaults:
    """What an absent (not a null) JSON key stands for."""

    # fixed values
    speed: float = 0.0
    hdop: float = 99.0
    satellites: int = 0


@dataclass(frozen=True)
class ContextLimits:
    """Which readings are good enough to judge: moving, and with a GPS fix."""

    # fixed values
    min_velocity: float = 5.0  # exclusive
    max_hdop: float = 5.0  # inclusive
    min_satellites: int = 4  # inclusive


@dataclass(frozen=True)
class ImpactRule:
    """Weighted sum of absolute z-scores, and the score an impact must exceed."""

    # fixed values
    weights: tuple[tuple[str, float], ...] = (("accel_z", 0.7), ("gyro_y", 0.3))
    threshold: float = 3.0

    def __post_init__(self) -> None:
        if not self.weights:
            raise ValueError("an impact rule needs at least one weighted column")

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(name for name, _ in self.weights)


@dataclass(frozen=True)
class RiskLevels:
    """Impact counts above which a segment-day is a warning or critical."""

    # fixed values
    warning_above: int = 3
    critical_above: int = 5


@dataclass(frozen=True)
class OutputFiles:
    """Data files of a day: as many as its bytes ask for, within an upper bound."""

    # fixed value
    per_day: int = 16
    file_bytes: int = 64 << 20


@dataclass(frozen=True)
class FactLayout:
    """Size of the fact table's files and of the row groups that lookups can skip.

    Bytes are those of the plain rows; Parquet makes less of them.
    """

    file_bytes: int = 128 << 20
    row_group_bytes: int = 8 << 20
