"""The plan surface: sixteen analyses with typed parameters over a registry of measures. A plan is checked first; each analysis returns a lazy DataFrame.

Places number some ten thousands, so windows over all units of a level hold no more rows than that; observations are grouped by unit before."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field, is_dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import relational, spatial
from . import forecast as fc
from .model import given

LEVELS = ("ulke", "il", "ilce", "mahalle")


class PlanError(ValueError):
    """A plan that can't be run; state: invalid, ambiguous or not_found; candidates: what may have been meant."""

    def __init__(self, state: str, message: str, candidates: list[str] | None = None) -> None:
        super().__init__(message)
        self.state, self.candidates = state, candidates or []


@dataclass(frozen=True)
class Measure:
    id: str
    unit: str
    levels: tuple[str, ...]
    rows: str  #: a query of (geo_id, period, dim, v, projected) at the finest level
    kind: str = "month"
    dims: tuple[str, ...] = ()
    additive: bool = False
    derived: bool = False
    names: tuple[str, ...] = ()


MEASURES = {
    m.id: m
    for m in (
        Measure("price", "TL", ("ilce",), "select geo_id, period, dim, v, projected from cell", dims=("F", "O", "P"), names=("unit price", "house price")),
        Measure("listings", "count", ("ilce", "il", "ulke"), "select geo_id, period, cast(null as string) dim, cast(count(*) as double) v, projected from obs group by geo_id, period, projected", additive=True, names=("number of listings",)),
        Measure("people", "count", ("mahalle", "ilce", "il", "ulke"), "select unit_id geo_id, '2001' period, cast(null as string) dim, cast(people as double) v, 0 projected from pop", kind="year", additive=True, names=("population",)),
        Measure("listing_share", "%", ("ilce",), "select geo_id, period, cast(null as string) dim, 100e0 * count(case when dim = 'F' then 1 end) / count(*) v, projected from obs group by geo_id, period, projected", derived=True, names=("share of finished listings",)),
    )
}


def measure(name: str) -> Measure:
    """A measure by its id or one of its names; else those that share words with the name are candidates."""
    if name in MEASURES:
        return MEASURES[name]
    words = set(name.lower().split())
    exact = [m for m in MEASURES.values() if name.lower() in m.names]
    if len(exact) == 1:
        return exact[0]
    near = exact or [m for m in MEASURES.values() if words & {w for n in (m.id, *m.names) for w in n.split()}]
    raise PlanError("ambiguous" if near else "not_found", f"no measure is called {name}", [m.id for m in near])


@dataclass(frozen=True)
class Place:
    geo_id: str
    level: str


def place(geo_id: str) -> Place:
    for head, level in (("MAH_", "mahalle"), ("ILCE_", "ilce"), ("IL_", "il")):
        if geo_id.startswith(head):
            return Place(geo_id, level)
    if geo_id == "TR":
        return Place(geo_id, "ulke")
    raise PlanError("not_found", f"no place is called {geo_id}")


def fingerprint(plan: object) -> str:
    """What equal plans share."""
    held = asdict(plan) if is_dataclass(plan) else plan
    return hashlib.sha256(json.dumps([type(plan).__name__, held], sort_keys=True, default=str).encode()).hexdigest()[:16]


# Plans


def _within(name: str, value: float, low: float, high: float) -> None:
    if not low <= value <= high:
        raise PlanError("invalid", f"{name} must be {low:g} to {high:g}, not {value:g}")


@dataclass(frozen=True)
class Profile:
    place: str


@dataclass(frozen=True)
class Compare:
    places: tuple[str, ...]
    measures: tuple[str, ...]
    period: str = "last"
    dim: str | None = None

    def __post_init__(self) -> None:
        _within("places", len(self.places), 2, 20)
        _within("measures", len(self.measures), 1, 12)


@dataclass(frozen=True)
class Rank:
    measure: str
    level: str
    scope: str | None = None
    descending: bool = True
    limit: int = 20
    period: str = "last"
    dim: str | None = None
    least_people: int | None = None
    least_listings: int | None = None

    def __post_init__(self) -> None:
        _within("limit", self.limit, 1, 1000)


@dataclass(frozen=True)
class SeriesOf:
    places: tuple[str, ...]
    measure: str
    first: str | None = None
    last: str | None = None
    dim: str | None = None
    projected: bool = False


@dataclass(frozen=True)
class Distribution:
    measure: str
    level: str
    scope: str | None = None
    period: str = "last"
    dim: str | None = None


@dataclass(frozen=True)
class Surroundings:
    lat: float
    lon: float
    metres: float
    brand: str | None = None
    category: str | None = None
    limit: int = 50
    report: str = "brands"  #: brands, categories or list

    def __post_init__(self) -> None:
        _within("metres", self.metres, 50, 500_000)
        if self.report not in ("brands", "categories", "list"):
            raise PlanError("invalid", f"no report is called {self.report}")


@dataclass(frozen=True)
class Density:
    scope: str | None = None
    segment: str | None = None
    descending: bool = True
    limit: int = 20
    least_people: int = 1


@dataclass(frozen=True)
class Shares:
    place: str


@dataclass(frozen=True)
class Similar:
    place: str
    criteria: tuple[tuple[str, str | None], ...] = (("price", "F"), ("price", "O"), ("listings", None))
    scope: str | None = None
    n: int = 10


@dataclass(frozen=True)
class Turnover:
    kind: str | None = None


@dataclass(frozen=True)
class Listing:
    lat: float | None = None
    lon: float | None = None
    metres: float | None = None
    brand: str | None = None
    category: str | None = None
    least_rating: float | None = None
    order: str = "rating"  #: rating, price, name or distance
    limit: int = 50

    def __post_init__(self) -> None:
        if self.order not in ("rating", "price", "name", "distance") or (self.order == "distance" and self.metres is None):
            raise PlanError("invalid", f"no such order: {self.order}")


@dataclass(frozen=True)
class Relation:
    x: str
    y: str
    level: str
    scope: str | None = None
    period_x: str = "last"
    period_y: str = "last"
    dim_x: str | None = None
    dim_y: str | None = None


@dataclass(frozen=True)
class Coverage:
    measure: str


@dataclass(frozen=True)
class Criterion:
    measure: str
    weight: float = 1.0
    dim: str | None = None
    more_is_better: bool = True


@dataclass(frozen=True)
class Suitable:
    criteria: tuple[Criterion, ...]
    level: str = "ilce"
    scope: str | None = None
    limit: int = 20
    least_people: int | None = None
    least_coverage: float = 0.7


@dataclass(frozen=True)
class Projection:
    place: str
    measure: str
    horizon: int | None = None
    dim: str | None = None
    inflation: dict[str, float] = field(default_factory=dict)


@dataclass(frozen=True)
class Outlook:
    place: str
    horizon: int = 12


class Engine:
    """Runs plans over the tables of a folder."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def _rows(self, text: str) -> DataFrame:
        return given(self.spark, self.sf_dir, text)

    def places(self) -> DataFrame:
        """(geo_id, level, parent_id, il, ilce): every place with its ancestors."""
        geo = self._rows("select geo_id, level, parent_id from geo")
        up = geo.select(F.col("geo_id").alias("parent_id"), F.col("parent_id").alias("grand_id"))
        held = geo.join(up, "parent_id", "left")
        ilce = F.when(F.col("level") == "ilce", F.col("geo_id")).when(F.col("level") == "mahalle", F.col("parent_id"))
        il = F.when(F.col("level") == "il", F.col("geo_id")).when(F.col("level") == "ilce", F.col("parent_id")).when(F.col("level") == "mahalle", F.col("grand_id"))
        return held.select("geo_id", "level", "parent_id", il.alias("il"), ilce.alias("ilce"))

    def scope(self, level: str, within: str | None) -> DataFrame:
        """(geo_id): the units of a level within a place."""
        if level not in LEVELS:
            raise PlanError("invalid", f"no level is called {level}")
        units = self.places().where(F.col("level") == level)
        if within is None or (p := place(within)).level == "ulke":
            return units.select("geo_id")
        if p.level == level:
            return units.where(F.col("geo_id") == p.geo_id).select("geo_id")
        if LEVELS.index(p.level) > LEVELS.index(level):
            raise PlanError("invalid", f"{p.geo_id} holds no units of the level {level}")
        return units.where(F.col(p.level) == p.geo_id).select("geo_id")

    def values(self, m: Measure, level: str, dim: str | None = None, projected: bool = False) -> DataFrame:
        """(geo_id, period, v) of a measure at a level; additive ones are summed up from the finest level."""
        if level not in m.levels:
            raise PlanError("invalid", f"{m.id} has no values for the level {level}", list(m.levels))
        if dim is not None and dim not in m.dims:
            raise PlanError("invalid", f"{m.id} has no dimension {dim}", list(m.dims))
        if m.dims and dim is None:
            raise PlanError("invalid", f"{m.id} needs a dimension", list(m.dims))
        rows = self._rows(m.rows)
        rows = rows.where(F.col("dim") == dim) if dim else rows
        rows = rows if projected else rows.where("projected = 0")
        finest = m.levels[0]
        if level == finest:
            return rows.select("geo_id", "period", "v")
        up = self.places().where(F.col("level") == finest).select("geo_id", (F.lit("TR") if level == "ulke" else F.col(level)).alias("up"))
        return rows.join(up, "geo_id").groupBy(F.col("up").alias("geo_id"), "period").agg(F.sum("v").alias("v"))

    def bound(self, values: DataFrame, period: str) -> DataFrame:
        """The values of one period: the last that there is, or a given one, which must exist."""
        if period == "last":
            last = values.agg(F.max("period").alias("period"))
            return values.join(F.broadcast(last), "period")
        found = values.where(F.col("period") == period)
        if found.isEmpty():
            low, high = values.agg(F.min("period"), F.max("period")).first()
            raise PlanError("not_found", f"no values for {period}; there are some from {low} to {high}")
        return found

    def people(self, level: str) -> DataFrame:
        return self.values(MEASURES["people"], level).select("geo_id", F.col("v").alias("people"))

    # The analyses

    def run(self, plan: object) -> DataFrame:
        return getattr(self, f"_{type(plan).__name__.lower()}")(plan)

    def _profile(self, plan: Profile) -> DataFrame:
        """(measure, dim, period, v, parent_v): every measure's last value of a place, and its parent's of the same period."""
        p, out = place(plan.place), []
        parent = self.places().where(F.col("geo_id") == p.geo_id).select(F.col("parent_id").alias("geo_id"))
        for m in MEASURES.values():
            for dim in (m.dims or (None,)) if p.level in m.levels else ():
                own = self.values(m, p.level, dim).where(F.col("geo_id") == p.geo_id).groupBy().agg(F.max("period").alias("period"), F.max_by("v", "period").alias("v")).where("period is not null")
                above = LEVELS[max(0, LEVELS.index(p.level) - 1)]
                if above in m.levels and above != p.level:
                    held = self.values(m, above, dim).join(parent, "geo_id", "left_semi").select("period", F.col("v").alias("parent_v"))
                    own = own.join(held, "period", "left")
                else:
                    own = own.withColumn("parent_v", F.lit(None).cast("double"))
                out.append(own.select(F.lit(m.id).alias("measure"), F.lit(dim).cast("string").alias("dim"), "period", "v", "parent_v"))
        found = out[0]
        for x in out[1:]:
            found = found.unionByName(x)
        return found

    def _compare(self, plan: Compare) -> DataFrame:
        """(measure, period, and a column for each place): values of the last period that all places of a level have, or of the given one."""
        places, out = [place(x) for x in plan.places], []
        for m in map(measure, plan.measures):
            level = places[0].level
            mine = [x.geo_id for x in places if x.level == level]
            rows = self.values(m, level, plan.dim if m.dims else None).where(F.col("geo_id").isin(mine))
            if plan.period == "last":
                common = rows.groupBy("period").agg(F.count_distinct("geo_id").alias("n")).where(F.col("n") == len(set(mine))).agg(F.max("period").alias("period"))
                rows = rows.join(F.broadcast(common), "period")
            else:
                rows = self.bound(rows, plan.period)
            out.append(rows.groupBy("period").pivot("geo_id", mine).agg(F.max("v")).select(F.lit(m.id).alias("measure"), "period", *mine))
        found = out[0]
        for x in out[1:]:
            found = found.unionByName(x, allowMissingColumns=True)
        return found

    def _rank(self, plan: Rank) -> DataFrame:
        """(geo_id, v, place, percentile): units by value, ties by id; 100 for the first."""
        m = measure(plan.measure)
        rows = self.bound(self.values(m, plan.level, plan.dim), plan.period).join(self.scope(plan.level, plan.scope), "geo_id", "left_semi").where("v is not null")
        if plan.least_people is not None:
            rows = rows.join(self.people(plan.level).where(F.col("people") >= plan.least_people), "geo_id", "left_semi")
        if plan.least_listings is not None:
            rows = rows.join(self.values(MEASURES["listings"], plan.level).where(F.col("v") >= plan.least_listings).select("geo_id", "period"), ["geo_id", "period"], "left_semi")
        order = [F.col("v").desc() if plan.descending else F.col("v").asc(), "geo_id"]
        i, n = F.row_number().over(W.orderBy(*order)).cast("long"), F.count("*").over(W.orderBy(F.lit(0)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
        ranked = rows.select("geo_id", "v", i.alias("place"), n.alias("n"))
        return ranked.select("geo_id", "v", "place", F.when(F.col("n") > 1, 100.0 * (F.col("n") - F.col("place")) / (F.col("n") - 1)).alias("percentile")).where(F.col("place") <= plan.limit)

    def _seriesof(self, plan: SeriesOf) -> DataFrame:
        """(geo_id, first, last, change, points, cagr, yoy): how measured values of each place have changed; percentages give differences in points alone, and
        a yearly rate takes a year or more."""
        m, level = measure(plan.measure), place(plan.places[0]).level
        rows = self.values(m, level, plan.dim, plan.projected).where(F.col("geo_id").isin(list(plan.places)))
        rows = rows.where(F.col("period") >= plan.first) if plan.first else rows
        rows = rows.where(F.col("period") <= plan.last) if plan.last else rows
        at = F.substring("period", 1, 4).cast("int") * 12 + (F.substring("period", 6, 2).cast("int") if m.kind == "month" else F.lit(0))
        dated = rows.withColumn("at", at)
        before = dated.select("geo_id", (F.col("at") + 12).alias("at"), F.col("v").alias("year_ago"))
        ends = dated.join(before, ["geo_id", "at"], "left").groupBy("geo_id").agg(F.min("period").alias("first"), F.max("period").alias("last"), F.min_by("v", "at").alias("a"), F.max_by("v", "at").alias("z"), (F.max("at") - F.min("at")).alias("months"), F.max_by("year_ago", "at").alias("y"))
        percent = F.lit(m.unit == "%")
        return ends.select(
            "geo_id", "first", "last",
            F.when(~percent, F.col("z") / F.col("a") - 1).alias("change"), F.when(percent, F.col("z") - F.col("a")).alias("points"),
            F.when(~percent & (F.col("months") >= 12), F.pow(F.col("z") / F.col("a"), 12 / F.col("months")) - 1).alias("cagr"), F.when(~percent, F.col("z") / F.col("y") - 1).alias("yoy"),
        )

    def _distribution(self, plan: Distribution) -> DataFrame:
        rows = self.bound(self.values(measure(plan.measure), plan.level, plan.dim), plan.period).join(self.scope(plan.level, plan.scope), "geo_id", "left_semi")
        p = F.percentile("v", F.array(*map(F.lit, (0.1, 0.25, 0.5, 0.75, 0.9))))
        q = rows.agg(F.count("v").alias("n"), F.min("v").alias("lowest"), p.alias("p"), F.max("v").alias("highest"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("sd"))
        return q.select("n", "lowest", *(F.get("p", F.lit(i)).alias(name) for i, name in enumerate(("p10", "p25", "median", "p75", "p90"))), "highest", "mean", "sd")

    def _pois(self, brand: str | None, category: str | None) -> DataFrame:
        rows = self._rows("select id, name, category, brand, cast(rating as double) rating, price, cast(lat as double) lat, cast(lon as double) lon from poi")
        rows = rows.where(F.col("brand") == brand) if brand else rows
        return rows.where(F.col("category") == category) if category else rows

    def _surroundings(self, plan: Surroundings) -> DataFrame:
        near = spatial.near(self._pois(plan.brand, plan.category), plan.lat, plan.lon, plan.metres)
        if plan.report == "brands":
            return near.groupBy("brand").agg(F.count("*").alias("n"), F.round(F.min("m"), 2).alias("nearest"))
        if plan.report == "categories":
            return near.groupBy("category").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "category").limit(15)
        return near.orderBy("m", "id").limit(plan.limit).select("id", "name", F.round("m", 2).alias("m"))

    def _density(self, plan: Density) -> DataFrame:
        """(geo_id, n, people, per_1000): customers with a positive balance for each thousand people of a quarter; none counts as 0."""
        rows = self._rows("select 'MAH_' || c_nationkey || '_' || c_mktsegment geo_id, c_mktsegment segment from customer where c_acctbal > 0")
        rows = rows.where(F.col("segment") == plan.segment) if plan.segment else rows
        n = rows.groupBy("geo_id").agg(F.count("*").alias("n"))
        units = self.scope("mahalle", plan.scope).join(self.people("mahalle"), "geo_id").where(F.col("people") >= plan.least_people)
        found = units.join(n, "geo_id", "left").select("geo_id", F.coalesce("n", F.lit(0)).alias("n"), "people", (1000 * F.coalesce("n", F.lit(0)) / F.nullif("people", F.lit(0))).alias("per_1000"))
        return found.orderBy(F.col("per_1000").desc_nulls_last() if plan.descending else F.col("per_1000").asc_nulls_last(), "geo_id").limit(plan.limit)

    def _shares(self, plan: Shares) -> DataFrame:
        """(dim, n, share, parent_share): kinds of a place's observations in percent of those that have one, beside its parent's; unknown ones last, without a share."""
        p = place(plan.place)
        column = {"ilce": "geo_id", "il": "il_id"}.get(p.level)
        if column is None:
            raise PlanError("invalid", f"{p.level} has no observations of its own")
        rows = self._rows("select geo_id, il_id, case when src = '4-NOT SPECIFIED' then null else src end dim from obs")
        parent = self._rows("select n_nationkey, n_regionkey from nation").where(F.concat(F.lit("ILCE_"), F.col("n_nationkey")) == p.geo_id).select(F.concat(F.lit("IL_"), F.col("n_regionkey")).alias("il_id"))

        def told(df: DataFrame, name: str) -> DataFrame:
            n = df.groupBy("dim").agg(F.count("*").alias("n"))
            known = n.agg(F.sum(F.when(F.col("dim").isNotNull(), F.col("n"))).alias("known"))
            return n.crossJoin(F.broadcast(known)).select("dim", "n", F.when(F.col("dim").isNotNull(), 100 * F.col("n") / F.col("known")).alias(name))

        own = told(rows.where(F.col(column) == p.geo_id), "share").alias("o")
        above = rows.join(F.broadcast(parent), "il_id", "left_semi") if p.level == "ilce" else rows
        up = told(above, "parent_share").alias("u")
        return own.join(up, F.col("o.dim").eqNullSafe(F.col("u.dim")), "left").select("o.dim", "o.n", "share", "parent_share").orderBy(F.col("dim").isNull(), F.col("n").desc(), "dim")

    def _similar(self, plan: Similar) -> DataFrame:
        """(geo_id, distance): units nearest to a place by z-scores of measures, in logarithms where all values are positive; units lacking one are left out."""
        p, held = place(plan.place), None
        for i, (name, dim) in enumerate(plan.criteria):
            v = self.bound(self.values(measure(name), p.level, dim), "last").groupBy("geo_id").agg(F.avg("v").alias(f"x{i}"))
            held = v if held is None else held.join(v, "geo_id")
        names = [f"x{i}" for i in range(len(plan.criteria))]
        held = held.dropna(subset=names)
        least = held.agg(*(F.min(c).alias(f"least_{c}") for c in names))
        logs = held.crossJoin(F.broadcast(least)).select("geo_id", *(F.when(F.col(f"least_{c}") > 0, F.log(c)).otherwise(F.col(c)).alias(c) for c in names))
        stats = logs.agg(*(F.avg(c).alias(f"m_{c}") for c in names), *(F.stddev_pop(c).alias(f"s_{c}") for c in names))
        z = logs.crossJoin(F.broadcast(stats)).select("geo_id", *(((F.col(c) - F.col(f"m_{c}")) / F.when(F.col(f"s_{c}") == 0, 1.0).otherwise(F.col(f"s_{c}"))).alias(c) for c in names))
        mine = z.where(F.col("geo_id") == p.geo_id).select(*(F.col(c).alias(f"own_{c}") for c in names))
        others = z.join(self.scope(p.level, plan.scope), "geo_id", "left_semi").where(F.col("geo_id") != p.geo_id).crossJoin(F.broadcast(mine))
        square: Column = F.lit(0.0)
        for c in names:
            square = square + F.pow(F.col(c) - F.col(f"own_{c}"), 2)
        return others.select("geo_id", F.round(F.sqrt(square), 12).alias("distance")).orderBy("distance", "geo_id").limit(plan.n)

    def _turnover(self, plan: Turnover) -> DataFrame:
        """(kind, snap, present, added, removed, net, churn) of users on the map of events by snapshots of ten days; the first has none added."""
        rows = self._rows("select distinct event_type kind, user_id, cast(floor((day(ts) - 1) / 10) as int) snap from events")
        rows = rows.where(F.col("kind") == plan.kind) if plan.kind else rows
        now = rows.withColumn("here", F.lit(1))
        shifted = rows.withColumn("snap", F.col("snap") + 1).withColumn("was", F.lit(1))
        last = rows.agg(F.max("snap").alias("last_snap"), F.min("snap").alias("first_snap"))
        both = now.join(shifted, ["kind", "user_id", "snap"], "full_outer").crossJoin(F.broadcast(last)).where(F.col("snap") <= F.col("last_snap"))
        counted = lambda test: F.count(F.when(test, 1))
        added = F.col("here").isNotNull() & F.col("was").isNull() & (F.col("snap") > F.col("first_snap"))
        found = both.groupBy("kind", "snap").agg(counted(F.col("here").isNotNull()).alias("present"), counted(added).alias("added"), counted(F.col("here").isNull()).alias("removed"))
        return found.select("*", (F.col("added") - F.col("removed")).alias("net"), (100.0 * (F.col("added") + F.col("removed")) / F.nullif(F.col("present") + F.col("removed"), F.lit(0))).alias("churn"))

    def _listing(self, plan: Listing) -> DataFrame:
        rows = self._pois(plan.brand, plan.category)
        if plan.metres is not None:
            rows = spatial.near(rows, plan.lat, plan.lon, plan.metres)
        rows = rows.where(F.col("rating") >= plan.least_rating) if plan.least_rating is not None else rows
        order = {"rating": [F.col("rating").desc_nulls_last(), F.col("price").desc_nulls_last()], "price": [F.col("price").asc_nulls_last()], "name": ["name"], "distance": ["m"]}[plan.order]
        return rows.orderBy(*order, "id").limit(plan.limit).select("id", "name", "rating", "price")

    def _relation(self, plan: Relation) -> DataFrame:
        """(n, pearson, spearman): both null for fewer than five pairs, or where a side doesn't vary."""
        side = lambda name, dim, period, c: self.bound(self.values(measure(name), plan.level, dim), period).select("geo_id", F.col("v").alias(c))
        pairs = side(plan.x, plan.dim_x, plan.period_x, "x").join(side(plan.y, plan.dim_y, plan.period_y, "y"), "geo_id").join(self.scope(plan.level, plan.scope), "geo_id", "left_semi").dropna(subset=["x", "y"])
        ranks = pairs.select("x", "y", relational.average_rank("x").alias("rx"), relational.average_rank("y").alias("ry"))
        enough = (F.count("*") >= 5) & (F.stddev_pop("x") > 0) & (F.stddev_pop("y") > 0)
        return ranks.agg(F.count("*").alias("n"), F.when(enough, F.corr("x", "y")).alias("pearson"), F.when(enough, F.corr("rx", "ry")).alias("spearman"))

    def _coverage(self, plan: Coverage) -> DataFrame:
        m = measure(plan.measure)
        rows = self._rows(m.rows)
        units = self.scope(m.levels[0], None).agg(F.count("*").alias("units"))
        found = rows.agg(F.count_distinct("geo_id").alias("geos"), F.count_distinct("period").alias("periods"), F.min("period").alias("first"), F.max("period").alias("last"), F.sum(F.when(F.col("projected") == 1, 1).otherwise(0)).alias("projected"))
        return found.crossJoin(F.broadcast(units)).withColumn("share", 100.0 * F.col("geos") / F.col("units"))

    def _suitable(self, plan: Suitable) -> DataFrame:
        """(geo_id, score, covered, place, best_place, worst_place): weighted mean of percentiles over the criteria that a unit has, if these hold enough of the
        weight; a child takes its parent's value where its level lacks a measure; best and worst place when any one criterion is left out."""
        up = self.places().where(F.col("level") == plan.level).select("geo_id", "il", "ilce")
        units = self.scope(plan.level, plan.scope)
        if plan.least_people is not None:
            units = units.join(self.people(plan.level).where(F.col("people") >= plan.least_people), "geo_id", "left_semi")
        parts = None
        for i, c in enumerate(plan.criteria):
            m = measure(c.measure)
            level = plan.level if plan.level in m.levels else next((x for x in reversed(LEVELS[: LEVELS.index(plan.level)]) if x in m.levels), None)
            if level is None:
                raise PlanError("invalid", f"{m.id} has no values for {plan.level} or above")
            v = self.bound(self.values(m, level, c.dim), "last").select(F.col("geo_id").alias("at"), "v")
            mine = units.join(up, "geo_id").select("geo_id", (F.col("geo_id") if level == plan.level else F.lit("TR") if level == "ulke" else F.col(level)).alias("at")).join(v, "at").where("v is not null")
            n = F.count("*").over(W.orderBy(F.lit(0)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
            p = F.when(n > 1, 100 * (relational.average_rank("v") - 1) / (n - 1)).otherwise(F.lit(50.0))
            part = mine.select("geo_id", F.lit(i).alias("i"), (p if c.more_is_better else 100 - p).alias("p"), F.lit(float(c.weight)).alias("w"))
            parts = part if parts is None else parts.unionByName(part)
        whole = sum(c.weight for c in plan.criteria)
        # Left out: none (-1), then each criterion
        runs = parts.withColumn("out", F.explode(F.sequence(F.lit(-1), F.lit(len(plan.criteria) - 1 if len(plan.criteria) > 1 else -1)))).where("i <> out")
        scored = runs.groupBy("out", "geo_id").agg((F.sum(F.col("p") * F.col("w")) / F.sum("w")).alias("score"), (F.sum("w") / whole).alias("covered"))
        kept = scored.join(scored.where("out = -1").where(F.col("covered") >= plan.least_coverage).select("geo_id"), "geo_id", "left_semi")
        placed = kept.withColumn("place", F.row_number().over(W.partitionBy("out").orderBy(F.col("score").desc(), "geo_id")).cast("long"))
        whole_runs = placed.where("out = -1").select("geo_id", "score", "covered", "place")
        span = placed.groupBy("geo_id").agg(F.min("place").alias("best_place"), F.max("place").alias("worst_place"))
        return whole_runs.join(span, "geo_id").where(F.col("place") <= plan.limit)

    def _projection(self, plan: Projection) -> DataFrame:
        """Forecast of one place's measure; percentages and derived measures have none, and a series has at least six periods."""
        m, p = measure(plan.measure), place(plan.place)
        if m.derived or m.unit == "%":
            raise PlanError("invalid", f"{m.id} can't be carried on: it is no level")
        rows = self.values(m, p.level, plan.dim).where(F.col("geo_id") == p.geo_id)
        if rows.count() < 6:
            raise PlanError("not_found", f"{p.geo_id} has no series of six periods for {m.id}")
        found = fc.forecast(rows, plan.horizon or {"month": 12, "quarter": 4, "year": 5}[m.kind], seasonal=m.unit == "count")
        return fc.real_terms(found, plan.inflation) if plan.inflation and m.unit == "TL" else found

    def _outlook(self, plan: Outlook) -> DataFrame:
        """(measure, dim, geo_id, last_step, forecast, low, high, total): every measure that can be carried on, of the place or the nearest ancestor that has a
        series; counts also as their sum over the horizon."""
        p, out = place(plan.place), None
        up = self.places().where(F.col("geo_id") == p.geo_id).first()
        chain = [x for x in (p.geo_id, up["ilce"], up["il"], "TR") if x]
        chain = sorted(set(chain), key=chain.index)
        for m in MEASURES.values():
            if m.derived or m.unit == "%":
                continue
            for dim in m.dims or (None,):
                for geo_id in chain:
                    try:
                        steps = self._projection(Projection(geo_id, m.id, plan.horizon, dim))
                    except PlanError:
                        continue
                    ends = steps.groupBy("geo_id").agg(F.max("step").alias("last_step"), *(F.max_by(c, "step").alias(c) for c in ("forecast", "low", "high")), F.when(F.lit(m.unit == "count"), F.sum("forecast")).alias("total"))
                    row = ends.select(F.lit(m.id).alias("measure"), F.lit(dim).cast("string").alias("dim"), "geo_id", "last_step", "forecast", "low", "high", "total")
                    out = row if out is None else out.unionByName(row)
                    break
        if out is None:
            raise PlanError("not_found", f"nothing can be carried on for {p.geo_id}")
        return out


def answer(engine: Engine, make, *args, **kwargs) -> dict:
    """{state, ...}: ok with the plan's fingerprint and result, or why there is none; never raises for a wrong plan."""
    try:
        plan = make(*args, **kwargs)
        return {"state": "ok", "fingerprint": fingerprint(plan), "result": engine.run(plan)}
    except PlanError as e:
        return {"state": e.state, "message": str(e), "candidates": e.candidates}
    except TypeError as e:
        return {"state": "invalid", "message": str(e), "candidates": []}


def tools() -> list[dict]:
    """A tool for each analysis, with its parameters' names, types and defaults."""
    from dataclasses import MISSING, fields

    plans = (Profile, Compare, Rank, SeriesOf, Distribution, Surroundings, Density, Shares, Similar, Turnover, Listing, Relation, Coverage, Suitable, Projection, Outlook)
    return [{"name": p.__name__.lower(), "parameters": {f.name: {"type": str(f.type), "required": f.default is MISSING and f.default_factory is MISSING} for f in fields(p)}} for p in plans]
