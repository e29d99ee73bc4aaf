"""Features and the rules that go by their names."""

from __future__ import annotations

import re

# The model's input columns, in order.
LAND_COVER_CLASSES = tuple(sorted(map(str, range(1, 45))))
LAND_COVER_SHARES = ("agricultural", "arable_land", "artificial", "artificial_vegetation", "forest_and_semi_natural", "forest", "heterogeneous_agriculture", "industrial", "inland_waters", "inland_wetlands", "marine_waters", "maritime_wetlands", "mine", "open_space", "permanent_crops", "scrub", "urban_fabric", "waterbody", "wetlands")
OTHER_FEATURES = (
    "EVI", "FAPAR", "LAI", "LST", "NDVI", "RH_max", "RH_mean", "RH_min", "RH_range", "aspect_1", "aspect_2",
    "aspect_3", "aspect_4", "aspect_5", "aspect_6", "aspect_7", "aspect_8", "aspect_NODATA", "aspect_eastness",
    "aspect_southness", "built_s", "burn_frequency_365d", "dist_to_fire", "dist_to_railways_mean",
    "dist_to_railways_stdev", "dist_to_roads_mean", "dist_to_roads_stdev", "dist_to_urban",
    "dist_to_waterways_mean", "dist_to_waterways_stdev", "elevation_mean", "elevation_stdev", "emc_peak", "ffwi",
    "fire_upwind_exposure", "fvc", "hli", "is_natura2000", "kbdi", "lai_anomaly", "ndvi_anomaly", "popdens",
    "precip_sum_180d", "precip_sum_30d", "precip_sum_365d", "precip_sum_7d", "precip_sum_90d", "roughness_mean",
    "roughness_stdev", "slope_mean", "slope_stdev", "soil_moisture_mean", "soil_temperature_mean", "spi_90d",
    "surface_pressure_max", "surface_pressure_mean", "surface_pressure_min", "surface_pressure_range", "t2m_max",
    "t2m_mean", "t2m_min", "t2m_range", "terrain_curvature", "time_since_last_fire", "total_precipitation_mean",
    "tpi", "wind_speed_max", "wind_speed_mean", "wind_u_atmaxspeed", "wind_u_mean", "wind_v_atmaxspeed",
    "wind_v_mean",
)
FEATURES = (*(f"CLC_2018_{c}" for c in LAND_COVER_CLASSES), *(f"CLC_2018_{s}_proportion" for s in LAND_COVER_SHARES), *OTHER_FEATURES)

# Valid range of stored numbers and scale, by composite.
VALID = {"NDVI": (-2000, 10000, 0.0001), "EVI": (-2000, 10000, 0.0001), "LAI": (0, 100, 0.1), "FAPAR": (0, 100, 0.01), "LST": (7500, 65535, 0.02)}

# Phrases by the features that raise risk, in order of preference.
CAUSES = (
    (("dist_to_fire", "fire_upwind_exposure"), "near active fire"),
    (("kbdi", "spi_90d", "precip_sum_90d", "precip_sum_180d"), "very dry ground"),
    (("t2m_max", "t2m_mean"), "extreme heat"),
    (("ffwi", "wind_speed_max", "RH_min"), "hot-dry-windy weather"),
    (("emc_peak", "ndvi_anomaly", "fvc", "lai_anomaly"), "dry, abundant fuel"),
    (("time_since_last_fire",), "long-unburned fuel buildup"),
    (("popdens", "dist_to_roads_mean", "dist_to_roads_stdev", "dist_to_urban"), "close to people & roads"),
    (("burn_frequency_365d",), "recent fire history"),
)

#: Feature groups of the ablation, by name pattern; the first that fits counts.
GROUPS = (
    ("fire_context", r"^(dist_to_fire|fire_upwind|time_since|burn_freq)"),
    ("human", r"^(popdens|built_s|dist_to_(roads|railways|urban))"),
    ("terrain", r"^(elevation|slope|roughness|aspect|tpi|terrain|hli)"),
    ("land_cover", r"^(CLC_|is_natura)"),
    ("vegetation", r"^(NDVI|EVI|LAI|FAPAR|LST|fvc|ndvi|lai)"),
    ("drought", r"^(kbdi|spi|precip_sum|soil)"),
    ("weather", r""),
)
#: Variables of the forecast that may stand in for the day's own.
WEATHER = re.compile(r"^(t2m|RH|surface_pressure|wind|total_precipitation|emc|ffwi)")


def chosen(columns: list[str], include: str = "", exclude: str | None = None) -> list[str]:
    """Columns by pattern, in their order, each once."""
    return [c for c in dict.fromkeys(columns) if re.search(include, c) and not (exclude and re.search(exclude, c))]


def present(columns: list[str], wanted: tuple[str, ...] = FEATURES) -> tuple[list[str], list[str]]:
    """(features there are, in the fixed order; missing ones)."""
    there = set(columns)
    return [f for f in wanted if f in there], [f for f in wanted if f not in there]


def group_of(feature: str) -> str:
    return next(name for name, pattern in GROUPS if re.search(pattern, feature))


def lossless(name: str) -> bool:
    """Whether a variable must keep all its bits: flags and land-cover classes."""
    return name.startswith(("is_", "CLC_"))


def editions(base: str, columns: list[str]) -> dict[int, str]:
    """Year and column of each edition of a variable: CLC_2006_x, CLC_2012_x or popdens_2015."""
    head, _, tail = base.partition("_")
    found = {}
    for c in columns:
        m = re.fullmatch(rf"{re.escape(head)}_(\d{{4}})(?:_{re.escape(tail)})?" if tail else rf"{re.escape(head)}_(\d{{4}})", c)
        if m and (not tail or c.endswith(tail)):
            found[int(m[1])] = c
    return found
