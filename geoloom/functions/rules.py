"""Ordered rule tables as column expressions, and the tables of the cycling domain."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(rules: Iterable[tuple[Column, object]], default: object = None) -> Column:
    """The value of the first rule that holds; one CASE expression, so it stays in generated code."""
    out = None
    for test, value in rules:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(test, value) if out is None else out.when(test, value)
    end = default if isinstance(default, Column) else F.lit(default)
    return end if out is None else out.otherwise(end)


def lookup(key: Column, table: dict[str, object], default: object = None) -> Column:
    """A small table as an expression: keys that share a value are tested together."""
    by_value: dict[object, list[str]] = {}
    for k, v in table.items():
        by_value.setdefault(v, []).append(k)
    return first_match(((key.isin(ks), v) for v, ks in by_value.items()), default)


# Factors, ranks and penalties of the cycling cost model.
SPEED_STEPS = [(20, 1.0), (25, 1.3), (30, 1.6)]
SPEED_ABOVE, SPEED_UNKNOWN = 2.0, 1.4
#: (exact names, part of a list-like value or None, factor), in order of precedence
ROAD_TYPES = [
    (["cycleway"], "cycleway", 0.6),
    (["path", "footway", "bridleway"], "path", 0.7),
    (["pedestrian"], None, 0.8),
    (["living_street"], None, 0.9),
    (["service"], None, 1.0),
    (["residential"], "residential", 1.1),
    (["unclassified", "busway"], None, 1.4),
    (["tertiary", "tertiary_link"], "tertiary", 1.7),
    (["secondary", "secondary_link"], "secondary", 2.2),
    (["primary", "primary_link"], "primary", 2.7),
]
ALLEY, ROAD_OTHER = 1.3, 1.3
INFRA_FACTORS = {"protected_lane": 0.4, "track": 0.5, "shared_path": 0.6, "buffered_lane": 0.7, "designated_path": 0.7, "bicycle_road": 0.8, "bike_lane": 0.85, "share_busway": 0.9, "sharrow": 0.95}
ROUTE_FACTORS = {"Protected Bike Lane": 0.4, "Neighborhood Greenway": 0.6, "Buffered Bike Lane": 0.7, "Bike Lane": 0.85, "Marked Shared Lane": 0.95}
ROUTE_INFRA = {"Protected Bike Lane": "protected_lane", "Buffered Bike Lane": "buffered_lane", "Bike Lane": "bike_lane", "Marked Shared Lane": "sharrow", "Neighborhood Greenway": "neighborhood_greenway"}
ROUTE_RANKS = {"Protected Bike Lane": 1, "Neighborhood Greenway": 2, "Buffered Bike Lane": 3, "Bike Lane": 4, "Marked Shared Lane": 5}
ROUGH = ["paving_stones", "sett", "cobblestone", "unhewn_cobblestone"]
LOOSE = ["unpaved", "gravel", "fine_gravel", "compacted", "dirt", "grass", "ground", "mud", "sand"]
#: traffic control -> penalty on primary, secondary, tertiary and minor roads
CONTROL_PENALTIES = {"traffic_signals": (0.0, 2.0, 5.0, 7.0), "crossing": (7.0, 7.0, 8.0, 9.0), "stop": (7.0, 7.0, 8.0, 9.0), "mini_roundabout": (7.0, 7.0, 7.0, 8.0), "give_way": (10.0, 10.0, 10.0, 10.0)}
UNCONTROLLED = (25.0, 20.0, 15.0, 12.0)
ROAD_CLASSES = ("primary", "secondary", "tertiary", "minor")
TURN_MULTIPLIERS = {"primary": 2.5, "primary_link": 2.0, "secondary": 2.0, "secondary_link": 1.5, "tertiary": 1.5, "tertiary_link": 1.2, "residential": 0.8, "living_street": 0.5, "service": 0.5, "cycleway": 0.0, "path": 0.0, "pedestrian": 0.0}
TURN_BASE, TURN_LEAST_DEGREES, TURN_OTHER = 30.0, 45.0, 1.0


def road_rank(highway: Column) -> Column:
    """4 primary, 3 secondary, 2 tertiary, 1 anything else, from a name or a list-like text."""
    return first_match([(highway.like("%primary%"), 4), (highway.like("%secondary%"), 3), (highway.like("%tertiary%"), 2)], 1)


def severity(fatal: Column, incapacitating: Column, non_incapacitating: Column, not_evident: Column) -> Column:
    """5 to 1 by the worst kind of injury."""
    return first_match([(fatal > 0, 5), (incapacitating > 0, 4), (non_incapacitating > 0, 3), (not_evident > 0, 2)], 1)


def side_tag(name: str) -> Column:
    """A cycleway's tag (buffer, separation, shared_lane) given for its left, right or both sides, or plainly."""
    return F.coalesce(*[F.col(f"cycleway_{side}{name}") for side in ("left_", "right_", "both_", "")])


def infra_columns() -> tuple[Column, Column]:
    """(category, type) of an edge's bicycle infrastructure from its tags. The right side counts before the left one; a
    side without a tag of its own has that of both sides, or the plain one. Fixed values: tag values and classes."""
    c = F.col
    way = F.coalesce(c("cycleway_right"), c("cycleway_both"), c("cycleway"), c("cycleway_left"), F.lit(""))
    separation = side_tag("separation")
    separated = separation.isNotNull() & ~separation.isin("no", "none")
    buffered, marked = side_tag("buffer").isNotNull(), side_tag("shared_lane").isNotNull()
    street = F.coalesce((c("bicycle_road") == "yes") | (c("cyclestreet") == "yes"), F.lit(False))
    track, lane, shared = way.isin("track", "separate"), way.isin("lane", "exclusive"), way.isin("shared_lane", "shared")
    on, allowed = c("highway"), c("bicycle")
    category = first_match(
        [
            (on.isin("cycleway", "path", "pedestrian") | track | separated, "separated"),
            (lane | buffered, "on_road"),
            (shared | (way == "share_busway") | marked | street, "shared"),
            (on.isin("footway", "bridleway", "steps") & allowed.isin("yes", "designated", "permissive"), "path"),
            (allowed.isin("designated", "yes"), "shared"),
        ]
    )
    kind = first_match(
        [
            (separated & (track | (way == "lane")), "protected_lane"),
            ((on == "cycleway") | track, "track"),
            (buffered, "buffered_lane"),
            (lane, "bike_lane"),
            (shared | marked, "sharrow"),
            (street, "bicycle_road"),
            (way == "share_busway", "share_busway"),
            (on.isin("path", "footway", "bridleway", "pedestrian", "steps"), "shared_path"),
            (allowed == "designated", "designated_path"),
        ]
    )
    return category, kind


def safety_factors() -> dict[str, Column]:
    """Speed, road, infrastructure, surface and lighting factors of an edge."""
    c = F.col
    mph = F.regexp_replace("maxspeed", "[^0-9].*", "").try_cast("int")
    speed = first_match([(mph <= most, f) for most, f in SPEED_STEPS] + [(mph > SPEED_STEPS[-1][0], SPEED_ABOVE)], SPEED_UNKNOWN)
    on = c("highway")
    road = [((on == "service") & (c("service") == "alley"), ALLEY)]
    for names, part, factor in ROAD_TYPES:
        road.append((on.isin(names) | on.contains(part) if part else on.isin(names), factor))
    infra = F.coalesce(lookup(c("infra_type"), INFRA_FACTORS), lookup(c("display_route_type"), ROUTE_FACTORS), F.lit(1.0))
    return {
        "speed_factor": speed,
        "road_type_factor": first_match(road, ROAD_OTHER),
        "infrastructure_factor": infra,
        "surface_factor": first_match([(c("surface").isin(ROUGH), 1.3), (c("surface").isin(LOOSE), 1.5)], 1.0),
        "lighting_factor": lookup(c("lit"), {"yes": 1.0, "no": 1.2}, 1.1),
    }


def control_penalty(control: Column, road_class: Column, is_intersection: Column) -> Column:
    """Penalty of a node by its traffic control and worst road."""

    def by_class(values: tuple[float, ...]) -> Column:
        return first_match([(road_class == name, v) for name, v in zip(ROAD_CLASSES[:3], values, strict=False)], values[3])

    rules = [(control == name, by_class(values)) for name, values in CONTROL_PENALTIES.items()]
    return first_match([*rules, (control.isNull() & is_intersection, by_class(UNCONTROLLED))], 0.0)


def oneway_fits(oneway: Column, letter: Column, azimuth: Column) -> Column:
    """Direction of an edge against a route's one-way letter. An azimuth under 45 fits every letter but '-'."""
    a = azimuth
    arcs = {"S": (135, 225), "E": (45, 135), "W": (225, 315), "NW": (270, 360)}
    rules = [(oneway == "2W", True), (letter == "-", F.lit(None).cast("boolean")), (((letter == "N") & a.between(315, 360)) | (a < 45), True)]
    return first_match(rules + [((letter == k) & a.between(*arc), True) for k, arc in arcs.items()], False)
