"""Run settings with their defaults, and the rules that check them."""

from __future__ import annotations

from dataclasses import dataclass, field

Box = tuple[float, float, float, float]

# Study areas as (county code, UTM code, county name, default box in degrees or None).
AREA_PRESETS: dict[str, tuple[str, int, str, Box | None]] = {
    "maricopa": ("04013", 32612, "Maricopa County", (-112.15, 33.35, -111.85, 33.55)),
    "phoenix_east": ("04013", 32612, "Maricopa County", (-111.90, 33.35, -111.70, 33.50)),
    "phoenix_west": ("04013", 32612, "Maricopa County", (-112.40, 33.40, -112.20, 33.55)),
    "fresno": ("06019", 32611, "Fresno County", (-119.87, 36.70, -119.68, 36.83)),
    "allegheny": ("42003", 32617, "Allegheny County", None),
    "harris": ("48201", 32615, "Harris County", (-95.55, 29.65, -95.25, 29.85)),
    "king": ("53033", 32610, "King County", (-122.40, 47.50, -122.20, 47.68)),
    "lancaster": ("42071", 32618, "Lancaster County", None),
    "hennepin": ("27053", 32615, "Hennepin County", None),
    "wake": ("37183", 32617, "Wake County", None),
    "boulder": ("08013", 32613, "Boulder County", None),
    "sedgwick": ("20173", 32614, "Sedgwick County", None),
    "bernalillo": ("35001", 32613, "Bernalillo County", None),
}


def effective_bbox(explicit: Box | None, preset: str | None) -> Box | None:
    """An explicit box, else the preset's, else none."""
    if explicit is not None:
        return explicit
    return AREA_PRESETS[preset][3] if preset in AREA_PRESETS else None


@dataclass(frozen=True)
class DatasetSettings:
    """Settings of a patch dataset run."""

    strategy: str = "curated"
    # The default counties of a dataset.
    county_geoids: tuple[str, ...] = ("06019", "04013", "48201", "53033", "27053", "37183", "08013", "42071", "20173", "35001")
    n_positive: int = 2000
    n_negative: int = 2000
    type_budgets: dict[str, int] = field(default_factory=dict)
    split_method: str = "geographic"
    test_fraction: float = 0.15
    val_fraction: float = 0.15
    seed: int = 42
    patch_size: int = 512
    resolution: float = 0.6
    jitter_m: float = 50.0
    negative_min_distance_m: float = 500.0
    max_temporal_gap_years: float = 3.0

    @property
    def n_positive_effective(self) -> int:
        """Type budgets, when given, replace the total."""
        return sum(self.type_budgets.values()) if self.type_budgets else self.n_positive


def validate_config(s: DatasetSettings) -> list[str]:
    """Problems with the settings; empty when there are none."""
    rules = [
        (s.strategy not in ("curated", "randomized"), f"strategy must be curated or randomized, not {s.strategy!r}"),
        (s.strategy == "curated" and not s.county_geoids, "the curated strategy needs at least one county"),
        (s.n_positive_effective <= 0, "the positive budget must be above 0"),
        (s.n_negative < 0, "the negative budget must not be below 0"),
        (s.split_method not in ("geographic", "random"), f"split method must be geographic or random, not {s.split_method!r}"),
    ]
    rules += [(n < 0, f"the budget of type {k!r} must not be below 0") for k, n in s.type_budgets.items()]
    return [message for broken, message in rules if broken]
