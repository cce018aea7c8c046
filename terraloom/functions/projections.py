"""Map projections as column expressions: degrees to metres and back on a sphere.

Sinusoidal, Mollweide, and the interrupted homolosine made of both: sinusoidal up to the parallel where the two have equal lengths,
Mollweide beyond it, cut into lobes with a central meridian each.  A place that is not on the map is NULL.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

RADIUS = 6_378_137.0  # fixed value: metres, the sphere of the raster files
JOINT = 40 + 44 / 60 + 11.8 / 3600  # fixed value: degrees of the parallel where the homolosine changes
# West and east end and central meridian of the lobes of each hemisphere.
NORTH = ((-180.0, -40.0, -100.0), (-40.0, 180.0, 30.0))
SOUTH = ((-180.0, -100.0, -160.0), (-100.0, -20.0, -60.0), (-20.0, 80.0, 20.0), (80.0, 180.0, 140.0))
EDGE = 1e-9  # degrees by which rounding may leave the map
NEWTON_STEPS = 40
ROOT2 = math.sqrt(2.0)


Step = Mapping[str, Callable[[Mapping[str, Column]], Column]]


@dataclass(frozen=True)
class Projection:
    """``forward`` takes degrees to a struct (x, y) and ``inverse`` metres to a struct (lon, lat).

    ``steps`` lead from ``x`` and ``y`` to ``lon`` and ``lat``; each names values by those before it.  Lons are not wrapped, so a map
    around 180 goes on beyond.
    """

    forward: Callable[[Column, Column], Column]
    steps: Sequence[Step]

    def inverse(self, x: Column, y: Column) -> Column:
        """One expression, for use within arrays too."""
        def after(i: int, known: tuple) -> Callable:
            def use(v: Column) -> Column:
                if i == len(self.steps):
                    return F.struct(v["lon"].alias("lon"), v["lat"].alias("lat"))
                found = {k: v[k] for k in known} | {k: f(v) for k, f in self.steps[i].items()}
                return _let(after(i + 1, tuple(found)), **found)
            return use

        return _let(after(0, ("x", "y")), x=x, y=y)

    def to_degrees(self, points: DataFrame, x: str, y: str, prefix: str = "_") -> DataFrame:
        """Rows with ``lon`` and ``lat`` behind the prefix, by plain columns, which are compiled: for many points."""
        names, kept = {"x": x, "y": y}, points.columns
        for step in self.steps:
            known = {k: F.col(c) for k, c in names.items()}
            points = points.withColumns({f"{prefix}{k}": f(known) for k, f in step.items()})
            names |= {k: f"{prefix}{k}" for k in step}
        return points.select(*kept, f"{prefix}lon", f"{prefix}lat")


def _let(use: Callable[[Column], Column], **values: Column) -> Column:
    """``use`` of a struct of values that are worked out once, however often it names them."""
    return F.get(F.transform(F.array(F.struct(*[v.alias(k) for k, v in values.items()])), use), F.lit(0))


def _unit(value: Column) -> Column:
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), value))


def _place_step(central: float) -> Step:
    """lon and lat of ``lat`` and ``away`` degrees from the central meridian, NULLs further out than the map goes."""
    def there(v: Mapping[str, Column]) -> Column:
        return (F.abs(v["away"]) <= 180 + EDGE) & (F.abs(v["lat"]) <= 90 + EDGE)

    return {"lon": lambda v: F.when(there(v), v["away"] + central),
            "lat": lambda v: F.when(there(v), F.greatest(F.lit(-90.0), F.least(F.lit(90.0), v["lat"])))}


def _sinusoidal_away(across: Column, lat: Column, metres: float) -> Column:
    return F.when(F.abs(lat) >= 90, 0.0).otherwise(across / (F.lit(metres) * F.cos(F.radians(lat))))


def _mollweide_lat(t: Column) -> Column:
    return F.degrees(F.asin(_unit((2 * t + F.sin(2 * t)) / math.pi)))


def _mollweide_away(across: Column, c: Column, radius: float) -> Column:
    return F.when(c < 1e-12, 0.0).otherwise(F.degrees(across / (F.lit(2 * ROOT2 * radius / math.pi) * c)))


def _angle(sine: Column) -> Column:
    return F.asin(F.when(F.abs(sine) <= 1 + EDGE, _unit(sine)))


def sinusoidal(central: float = 0.0, radius: float = RADIUS) -> Projection:
    metres = radius * math.pi / 180

    def forward(lon: Column, lat: Column) -> Column:
        return F.struct(((lon - central) * metres * F.cos(F.radians(lat))).alias("x"), (lat * metres).alias("y"))

    return Projection(forward, (
        {"lat": lambda v: v["y"] / metres}, {"away": lambda v: _sinusoidal_away(v["x"], v["lat"], metres)}, _place_step(central)))


def _mollweide_angle(lat: Column) -> Column:
    """The angle t with 2t + sin 2t = pi sin(lat), by Newton steps from a start that is exact at the equator and the poles."""
    def step(t: Column, wanted: Column) -> Column:
        slope = 2 + 2 * F.cos(2 * t)
        return F.when(slope < 1e-12, t).otherwise(t - (2 * t + F.sin(2 * t) - wanted) / slope)

    wanted = F.array_repeat(F.lit(math.pi) * F.sin(F.radians(lat)), NEWTON_STEPS)
    return F.aggregate(wanted, F.asin(_unit(F.sin(F.radians(lat)))), step)


def _mollweide_xy(away: Column, lat: Column, radius: float) -> Column:
    wide = 2 * ROOT2 * radius / math.pi
    return _let(lambda v: F.struct((v["turn"] * wide * F.cos(v["t"])).alias("x"), (F.lit(ROOT2 * radius) * F.sin(v["t"])).alias("y")),
                t=_mollweide_angle(lat), turn=F.radians(away))


def mollweide(central: float = 0.0, radius: float = RADIUS) -> Projection:
    def forward(lon: Column, lat: Column) -> Column:
        return _mollweide_xy(lon - central, lat, radius)

    return Projection(forward, (
        {"sine": lambda v: v["y"] / (ROOT2 * radius)}, {"t": lambda v: _angle(v["sine"])}, {"c": lambda v: F.cos(v["t"])},
        {"lat": lambda v: _mollweide_lat(v["t"]), "away": lambda v: _mollweide_away(v["x"], v["c"], radius)}, _place_step(central)))


def joint_shift() -> float:
    """Metres by which the Mollweide parts move towards the equator, so that both parts meet at the joint."""
    t, wanted = math.radians(JOINT), math.pi * math.sin(math.radians(JOINT))
    for _ in range(NEWTON_STEPS):
        t -= (2 * t + math.sin(2 * t) - wanted) / (2 + 2 * math.cos(2 * t))
    return RADIUS * (ROOT2 * math.sin(t) - math.radians(JOINT))


def _lobe(north: Column, at: Column, scale: float) -> Column:
    """(west, east, central) of the lobe that a lon, or an easting with ``scale`` metres a degree, falls into."""
    def pick(parts: tuple) -> Column:
        picked = None
        for west, east, central in reversed(parts):
            here = F.struct(F.lit(west).alias("west"), F.lit(east).alias("east"), F.lit(central).alias("central"))
            picked = here if picked is None else F.when(at <= east * scale, here).otherwise(picked)
        return picked

    return F.when(north, pick(NORTH)).otherwise(pick(SOUTH))


def homolosine() -> Projection:
    """The interrupted homolosine; of two lobes that meet in a meridian, the western one takes it."""
    shift, metres = joint_shift(), RADIUS * math.pi / 180

    def forward(lon: Column, lat: Column) -> Column:
        def of_place(v: Column) -> Column:
            away = v["lon"] - v["lobe"]["central"]
            sinu, moll = sinusoidal().forward(away, v["lat"]), _mollweide_xy(away, v["lat"], RADIUS)
            shifted = _let(lambda m: F.struct(m["p"]["x"].alias("x"), (m["p"]["y"] - F.signum(v["lat"]) * shift).alias("y")), p=moll)
            at = _let(lambda m: m["p"], p=F.when(F.abs(v["lat"]) > JOINT, shifted).otherwise(sinu))
            return _let(lambda m: F.struct((m["p"]["x"] + F.radians(v["lobe"]["central"]) * RADIUS).alias("x"), m["p"]["y"].alias("y")), p=at)

        return _let(of_place, lon=lon, lat=lat, lobe=_lobe(lat >= 0, lon, 1.0))

    def kept(v: Mapping[str, Column]) -> Column:
        on_map = (F.abs(v["away"]) <= 180 + EDGE) & (F.abs(v["lat"]) <= 90 + EDGE)
        return on_map & (v["lon"] >= v["west"] - EDGE) & (v["lon"] <= v["east"] + EDGE)

    return Projection(forward, (
        {end: lambda v, end=end: _lobe(v["y"] >= 0, v["x"], metres)[end] for end in ("west", "east", "central")}
        | {"polar": lambda v: F.abs(v["y"]) > JOINT * metres},
        {"across": lambda v: v["x"] - v["central"] * metres,
         "t": lambda v: F.when(v["polar"], _angle((v["y"] + F.signum(v["y"]) * shift) / (ROOT2 * RADIUS)))},
        {"c": lambda v: F.cos(v["t"]), "lat": lambda v: F.when(v["polar"], _mollweide_lat(v["t"])).otherwise(v["y"] / metres)},
        {"away": lambda v: F.when(v["polar"], _mollweide_away(v["across"], v["c"], RADIUS)).otherwise(_sinusoidal_away(v["across"], v["lat"], metres))},
        {"lon": lambda v: v["away"] + v["central"]},
        {"lon": lambda v: F.when(kept(v), v["lon"]), "lat": lambda v: F.when(kept(v), v["lat"])}))
