"""Feature sets from declarative specs.

A spec names a target entity, the actions to look at, aggregate primitives,
parent entities, and conditions. :func:`plan_features` lists the columns a spec
gives; :func:`synthesize` computes them:

* plain features fold the log per target: rows, distinct values, modes, each
  also under every condition;
* stacked features (depth 3 and up) describe the parents of a target's rows,
  e.g. the mean over a user's rows of how often the row's seller occurs. The
  aggregates of all parents meet the log rows, and one aggregate folds them. Only
  folds of one's own that look at each parent once have the log counted per
  (target, parent) first, and the counts serve as weights.

:func:`synthesize_all` computes many specs from one prepared log and shares
their counts.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from tallybuy.functions.columns import PromoCalendar, cells, epoch_days, month_of, ratio, spread
from tallybuy.operators.joins import lookup
from tallybuy.operators.keys import encode_top_values, with_actions
from tallybuy.operators.population import ENTITY_KEYS, restrict_to, with_profile
from tallybuy.session import write_out

SECONDS_PER_DAY = 86400.0

# Columns each target entity is described by.
ENTITY_COLUMNS: Mapping[str, tuple[str, ...]] = {
    "user_id": (
        "item_id", "cat_id", "seller_id", "brand_id", "month", "time_stamp", "action_type",
    ),
    "user_seller": ("item_id", "cat_id", "brand_id", "time_stamp", "action_type", "month"),
    "seller_id": (
        "user_id", "item_id", "cat_id", "brand_id", "time_stamp", "month", "action_type",
        "age_range", "gender",
    ),
}
# Parents a target entity has without asking for them.
_SIBLINGS = {"user_id": ("seller_id",), "seller_id": ("user_id",), "user_seller": ()}
_TIME_COLUMNS = ("month", "time_stamp", "before_pro")


@dataclass(frozen=True)
class FeatureSpec:
    """What to compute for which entity.

    ``depth`` below 3 leaves the stacked features out. Depth 4 adds aggregates
    of the parents to the log rows, see :func:`direct_features`.
    """

    name: str
    target: str
    actions: tuple[int, ...]
    primitives: tuple[str, ...]
    depth: int = 3
    conditions: Mapping[str, tuple] = field(default_factory=dict)
    drop: tuple[str, ...] = ()
    extra_parents: tuple[str, ...] = ()
    columns: tuple[str, ...] | None = None
    transforms: tuple[str, ...] = ()

    @property
    def keys(self) -> list[str]:
        return ENTITY_KEYS[self.target]

    @property
    def categoricals(self) -> list[str]:
        chosen = self.columns if self.columns is not None else ENTITY_COLUMNS[self.target]
        return [c for c in chosen if c not in self.drop and c not in self.keys]

    @property
    def parents(self) -> list[str]:
        siblings = [p for p in _SIBLINGS[self.target] if p not in self.drop]
        return [*siblings, *self.extra_parents]

    def condition_columns(self) -> dict[str, Column]:
        """Every (column, value) condition, by its name in feature names."""
        return {
            f"{c}_{str(v).lower()}": F.col(c) == F.lit(v)
            for c, values in self.conditions.items()
            for v in values
        }


# --- registries -------------------------------------------------------------

# A fold takes the value, the number of rows it stands for, and the condition
# under which it counts, and returns an aggregate over one target's values.
Fold = Callable[[Column, Column, Column], Column]


def _distinct(_value: Column, _n: Column, seen: Column) -> Column:
    return F.count_if(seen)


def _mode(value: Column, n: Column, seen: Column) -> Column:
    """Most frequent value; among equals the lowest."""
    best = F.max(F.when(seen, F.struct(n.alias("n"), (-value).alias("v"))))
    return -best["v"]


def _repeat_share(_value: Column, n: Column, seen: Column) -> Column:
    return F.avg(F.when(seen, (n > 1).cast("double")))


def _distinct_share(_value: Column, n: Column, seen: Column) -> Column:
    return ratio(F.count_if(seen), F.sum(F.when(seen, n)))


# Folds of a categorical column, over its distinct values.
VALUE_FOLDS: dict[str, Fold] = {
    "nunique": _distinct,
    "mode": _mode,
    "repeat_share": _repeat_share,
    "distinct_share": _distinct_share,
}


def _mean(value: Column, n: Column, _seen: Column) -> Column:
    return ratio(F.sum(value * n), F.sum(n))


def _std(value: Column, n: Column, _seen: Column) -> Column:
    v = value.cast("double")
    return spread(F.sum(v * n), F.sum(v * v * n), F.sum(n))


def _max(value: Column, _n: Column, seen: Column) -> Column:
    return F.max(F.when(seen, value))


def _min(value: Column, _n: Column, seen: Column) -> Column:
    return F.min(F.when(seen, value))


def _median(value: Column, n: Column, seen: Column) -> Column:
    # Values are row counts of parents; see profiles.count_summary on its state.
    return F.percentile(F.when(seen, value), F.lit(0.5), n)


# Folds of a parent's aggregate, over the parents a target meets.
STACKED_FOLDS: dict[str, Fold] = {
    "mean": _mean,
    "std": _std,
    "max": _max,
    "min": _min,
    "median": _median,
}
# Folds to which two rows of one parent are the same as one of twice the weight.
_BY_ROWS = frozenset({*STACKED_FOLDS, "trend"})


def register_fold(name: str, fold: Fold, stacked: bool = False) -> None:
    """Add a primitive of one's own, for categorical or for stacked values."""
    if name in VALUE_FOLDS or name in STACKED_FOLDS:
        raise ValueError(f"primitive {name} exists")
    (STACKED_FOLDS if stacked else VALUE_FOLDS)[name] = fold


# --- preparation ------------------------------------------------------------


def prepare(
    spec: FeatureSpec,
    log: DataFrame,
    pairs: DataFrame | None,
    profile: DataFrame,
    calendar: PromoCalendar,
    day: Column | None = None,
) -> DataFrame:
    """Log rows a spec looks at, with month, date and profile columns.

    ``day`` is the date of a row; without one it is read off ``time_stamp``
    within a single year.
    """
    rows = with_actions(log, spec.actions)
    if pairs is not None:
        rows = restrict_to(rows, pairs, spec.target)
    ts = F.col("time_stamp")
    when = F.make_date(F.lit(2016), month_of(ts), (ts % 100).cast("int")) if day is None else day
    dated = rows.select(
        "*",
        month_of(ts).alias("month"),
        when.alias("date"),
        calendar.is_before_promo(ts).alias("before_pro"),
    )
    joined = with_profile(dated, profile, "inner")
    return joined.drop(*[c for c in spec.drop if c not in spec.keys])


# --- planning ---------------------------------------------------------------


@dataclass(frozen=True)
class StackedValue:
    """An aggregate of a parent entity: its rows, or distinct values of a column."""

    parent: str
    name: str
    of: str | None = None
    condition: str | None = None


def stacked_values(spec: FeatureSpec) -> list[StackedValue]:
    """Parent aggregates a spec stacks on.

    Rows of the parent, rows under each condition, distinct values per column.
    """
    if spec.depth < 3:
        return []
    out: list[StackedValue] = []
    for p in spec.parents:
        if "count" in spec.primitives:
            out.append(StackedValue(p, f"{p}_count"))
            out += [
                StackedValue(p, f"{p}_count_if_{c}", condition=c) for c in spec.condition_columns()
            ]
        if "nunique" in spec.primitives:
            out += [
                StackedValue(p, f"{p}_nunique_{c}", of=c) for c in spec.categoricals if c != p
            ]
    return out


def _stacked_cases(spec: FeatureSpec, value: StackedValue) -> list[str | None]:
    """Conditions a stacked value is folded under. Conditions do not nest."""
    plain_count = value.of is None and value.condition is None
    return [None, *spec.condition_columns()] if plain_count else [None]


def _suffix(condition: str | None) -> str:
    return "" if condition is None else f"_where_{condition}"


def plan_features(spec: FeatureSpec) -> list[str]:
    """Names of the feature columns, without computing anything."""
    cases = [None, *spec.condition_columns()]
    names: list[str] = []
    if "count" in spec.primitives:
        names += [f"count{_suffix(c)}" for c in cases]
    for p in spec.primitives:
        if p in VALUE_FOLDS:
            names += [f"{p}_{col}{_suffix(c)}" for col in spec.categoricals for c in cases]
    if "trend" in spec.primitives:
        names += [f"daily_trend{_suffix(c)}" for c in cases]
    for transform in spec.transforms:
        names += [
            f"{fold}_{transform}{_suffix(c)}"
            for fold in ("mean", "std") if fold in spec.primitives for c in cases
        ]
    for value in stacked_values(spec):
        for c in _stacked_cases(spec, value):
            for fold in [*STACKED_FOLDS, "trend"]:
                if fold in spec.primitives:
                    names.append(f"{fold}_{value.name}{_suffix(c)}")
    return names


# --- computing --------------------------------------------------------------


@dataclass(frozen=True)
class Part:
    """A spec as one of several that are computed together, from the same rows.

    ``name`` sets its features apart from those of the others; counts and values of
    parents are the same for all and shared.
    """

    spec: FeatureSpec
    name: str = ""

    @staticmethod
    def n(condition: str | None) -> str:
        """Name of the count of rows, or of rows under a condition."""
        return "n" if condition is None else f"n_{condition}"

    def out(self, feature: str) -> str:
        return f"{self.name}{feature}"

    def cases(self) -> dict[str, Column | None]:
        """What each count counts."""
        return {self.n(None): None, **{self.n(c): e for c, e in self.spec.condition_columns().items()}}


def _all_cases(parts: Sequence[Part]) -> dict[str, Column | None]:
    return {name: e for part in parts for name, e in part.cases().items()}


def _case_counts(parts: Sequence[Part]) -> list[Column]:
    """Rows, and rows under each condition."""
    return [
        (F.count(F.lit(1)) if e is None else F.count_if(e)).alias(name)
        for name, e in _all_cases(parts).items()
    ]


def _counted_cells(
    parts: Sequence[Part], rows: DataFrame, keys: Sequence[Column], columns: Sequence[str]
) -> DataFrame:
    """Counts per (key, column, value) for several columns from one pass."""
    cases = _all_cases(parts)
    flags = {name: e for name, e in cases.items() if e is not None}
    kept = [*keys, *[e.alias(f"_is_{name}") for name, e in flags.items()]]
    long = cells(rows, kept, columns)
    by = [c for c in long.columns if not c.startswith("_is_")]
    return long.groupBy(*by).agg(
        *[(F.count_if(f"_is_{name}") if name in flags else F.count(F.lit(1))).alias(name) for name in cases]
    )


def _plain(parts: Sequence[Part], rows: DataFrame) -> DataFrame:
    """Row counts and folds of the categorical columns per target."""
    keys = parts[0].spec.keys
    folds = {part.name: [p for p in part.spec.primitives if p in VALUE_FOLDS] for part in parts}
    columns = list(dict.fromkeys(c for part in parts if folds[part.name] for c in part.spec.categoricals))
    if not columns:
        counts = rows.groupBy(*keys).agg(*_case_counts(parts))
        counted = {name: F.col(name) for name in _all_cases(parts)}
    else:
        counts = _counted_cells(parts, rows, [F.col(k) for k in keys], columns)
        first = F.col("cell") == 0
        counted = {
            name: F.coalesce(F.sum(F.when(first, F.col(name))), F.lit(0)) for name in _all_cases(parts)
        }
    out: list[Column] = []
    for part in parts:
        cases = [None, *part.spec.condition_columns()]
        if "count" in part.spec.primitives:
            out += [counted[part.n(c)].alias(part.out(f"count{_suffix(c)}")) for c in cases]
        for col in part.spec.categoricals if folds[part.name] else ():
            for c in cases:
                n = F.col(part.n(c))
                seen = (F.col("cell") == columns.index(col)) & F.col("value").isNotNull() & (n > 0)
                for p in folds[part.name]:
                    fold = VALUE_FOLDS[p](F.col("value"), n, seen)
                    out.append(fold.alias(part.out(f"{p}_{col}{_suffix(c)}")))
    return counts.groupBy(*keys).agg(*out) if columns else counts.select(*keys, *out)


def _daily(parts: Sequence[Part], rows: DataFrame) -> DataFrame:
    """Counts per target and day. The calendar bounds the days of a target."""
    return rows.groupBy(*parts[0].spec.keys, "date").agg(*_case_counts(parts))


def _trend(parts: Sequence[Part], rows: DataFrame) -> DataFrame:
    """Slope of the daily row counts against time, in rows per day and day."""
    x = epoch_days(F.col("date"))
    out = []
    for part in parts:
        for c in [None, *part.spec.condition_columns()]:
            n = F.col(part.n(c))
            slope = F.regr_slope(F.when(n > 0, n), F.when(n > 0, x))
            out.append(slope.alias(part.out(f"daily_trend{_suffix(c)}")))
    return _daily(parts, rows).groupBy(*parts[0].spec.keys).agg(*out)


def _gaps(parts: Sequence[Part], rows: DataFrame) -> DataFrame:
    """Mean and spread of the seconds since the target's previous row.

    Rows of the same day follow each other at distance zero, so days with their
    counts say everything; conditions must depend on the day alone.
    """
    keys, days, out = parts[0].spec.keys, _daily(parts, rows), []
    order = Window.partitionBy(*keys).orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    gap = F.datediff(F.col("date"), F.max("date").over(order)).cast("double") * SECONDS_PER_DAY
    days = days.withColumn("gap", gap)
    for part in parts:
        for c in part.spec.conditions:
            if c not in _TIME_COLUMNS:
                raise ValueError(f"time since previous cannot be conditioned on {c}")
        for c in [None, *part.spec.condition_columns()]:
            inside = F.col(part.n(c)) > 0
            g = F.when(inside, F.col("gap"))
            # The target's very first row has no gap.
            m = F.sum(F.col(part.n(c)) - (inside & F.col("gap").isNull()).cast("int"))
            total, squares = F.coalesce(F.sum(g), F.lit(0.0)), F.coalesce(F.sum(g * g), F.lit(0.0))
            if "mean" in part.spec.primitives:
                mean = F.when(m > 0, ratio(total, m))
                out.append(mean.alias(part.out(f"mean_time_since_previous{_suffix(c)}")))
            if "std" in part.spec.primitives:
                std = spread(total, squares, m)
                out.append(std.alias(part.out(f"std_time_since_previous{_suffix(c)}")))
    return days.groupBy(*keys).agg(*out)


# Row transforms: each computes mean_<name> and std_<name>, with conditions.
TRANSFORMS: dict[str, Callable[[Sequence[Part], DataFrame], DataFrame]] = {
    "time_since_previous": _gaps,
}


def _of_parent(part: Part, parent: str) -> list[StackedValue]:
    return [v for v in stacked_values(part.spec) if v.parent == parent]


def _parent_aggregates(parts: Sequence[Part], rows: DataFrame, parent: str) -> DataFrame:
    """One row per parent with every value stacked from it."""
    wanted = list(dict.fromkeys(v for part in parts for v in _of_parent(part, parent)))
    columns = list(dict.fromkeys(v.of for v in wanted if v.of is not None))
    if not columns:
        cases = _all_cases(parts)
        out = []
        for v in wanted:
            case = cases[Part.n(v.condition)]
            out.append((F.count(F.lit(1)) if case is None else F.count_if(case)).alias(v.name))
        return rows.groupBy(parent).agg(*out)
    counted = _counted_cells(parts, rows, [F.col(parent).alias("_parent")], columns)
    out = []
    for v in wanted:
        if v.of is None:
            e = F.sum(F.when(F.col("cell") == 0, F.col(Part.n(v.condition))))
        else:
            here = F.col("cell") == columns.index(v.of)
            e = F.count_if(here & F.col("value").isNotNull())
        out.append(e.alias(v.name))
    return counted.groupBy(F.col("_parent").alias(parent)).agg(*out)


def _weighted_slope(value: Column, n: Column, x: Column) -> Column:
    """Slope of ``value`` on ``x``, each point counted ``n`` times."""
    v, w = value.cast("double"), n.cast("double")
    sw, sx, sy = F.sum(w), F.sum(w * x), F.sum(w * v)
    sxy, sxx = F.sum(w * x * v), F.sum(w * x * x)
    down = sw * sxx - sx * sx
    # Days are whole numbers: a spread below one half means a single day.
    return F.when(down > 0.5, F.try_divide(sw * sxy - sx * sy, down))


# Days are counted from here in weighted slopes, to keep the sums small.
_SLOPE_ORIGIN = 9000


def _stacked_parents(parts: Sequence[Part]) -> list[str]:
    return list(dict.fromkeys(v.parent for part in parts for v in stacked_values(part.spec)))


def _stacked_folds(part: Part) -> list[str]:
    return [f for f in [*STACKED_FOLDS, "trend"] if f in part.spec.primitives]


def _fold_stacked(part: Part, parent: str, weights: Mapping[str, Column], met: Column | None = None) -> list[Column]:
    """Folds of what a part stacks on a parent; NULL for a target without ``met``, if that is given."""
    out = []
    for value in _of_parent(part, parent):
        for c in _stacked_cases(part.spec, value):
            v, n = F.col(value.name), weights[part.n(c)]
            for fold in _stacked_folds(part):
                if fold == "trend":
                    e = _weighted_slope(v, n, epoch_days(F.col("date")) - _SLOPE_ORIGIN)
                else:
                    e = STACKED_FOLDS[fold](v, n, n > 0)
                e = e if met is None else F.when(F.count(met) > 0, e)
                out.append(e.alias(part.out(f"{fold}_{value.name}{_suffix(c)}")))
    return out


def _stacked(parts: Sequence[Part], rows: DataFrame, parent: str) -> DataFrame:
    """Parent aggregates folded over the parents that each target meets, one row per (target, parent)."""
    keys = parts[0].spec.keys
    per_day = ["date"] if any("trend" in part.spec.primitives for part in parts) else []
    met = rows.groupBy(*keys, F.col(parent).alias("_p"), *per_day).agg(*_case_counts(parts))
    about = _parent_aggregates(parts, rows, parent).withColumnRenamed(parent, "_p")
    joined = lookup(met, about, ["_p"], "inner")
    weights = {name: F.col(name) for name in _all_cases(parts)}
    return joined.groupBy(*keys).agg(*[e for part in parts for e in _fold_stacked(part, parent, weights)])


def _stacked_by_rows(parts: Sequence[Part], rows: DataFrame) -> DataFrame:
    """Row counts, and the aggregates of all parents folded over each target's rows, in one aggregate.

    The aggregates of a parent are written out, so those of few parents are broadcast on
    their measured size and the rows are moved for the large ones only.
    """
    keys, parents, out = parts[0].spec.keys, _stacked_parents(parts), []
    for part in parts:
        if "count" in part.spec.primitives and not _folds_values(part):
            cases = {None: F.lit(True), **part.spec.condition_columns()}
            out += [F.count_if(e).alias(part.out(f"count{_suffix(c)}")) for c, e in cases.items()]
    # A target with a null key has no stacked values.
    named = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    read = {*keys, *parents, "date", *[c for part in parts for c in part.spec.conditions]}
    joined = rows.select(*[c for c in rows.columns if c in read])
    for parent in parents:
        stacking = [part for part in parts if _of_parent(part, parent)]
        about = write_out(_parent_aggregates(stacking, rows, parent), f"about-{parent}")
        joined = lookup(joined, about, [parent])
        known = F.col(parent).isNotNull()
        weights = {
            name: F.when(known, F.lit(1) if e is None else F.coalesce(e.cast("int"), F.lit(0))).cast("bigint")
            for name, e in _all_cases(stacking).items()
        }
        met = F.when(named & known, F.lit(1))
        out += [e for part in stacking for e in _fold_stacked(part, parent, weights, met)]
    return joined.groupBy(*keys).agg(*out)


def _passes(parts: Sequence[Part]) -> int:
    """How many times the rows are read for some parts."""
    spec_passes = {p for part in parts for p in part.spec.transforms}
    parents = _stacked_parents(parts)
    trends = any("trend" in part.spec.primitives for part in parts)
    return 1 + trends + len(spec_passes) + 2 * len(parents)


def _folds_values(part: Part) -> bool:
    return any(p in VALUE_FOLDS for p in part.spec.primitives) and bool(part.spec.categoricals)


def _together(parts: Sequence[Part], rows: DataFrame) -> DataFrame:
    """Features of several parts with one target entity, one row per target.

    Each kind of count is taken once for all parts that need it.
    """
    keys = parts[0].spec.keys
    by_rows = [p for p in parts if stacked_values(p.spec) and _BY_ROWS.issuperset(_stacked_folds(p))]
    # Parts without folds of values have their row counts from the aggregate of the stacked features.
    plain = [p for p in parts if p not in by_rows or _folds_values(p)]
    frames: list[DataFrame] = []

    def add(chosen: list[Part], frame: Callable[[list[Part], DataFrame], DataFrame]) -> None:
        if chosen:
            frames.append(frame(chosen, rows))

    add(plain, _plain)
    add(by_rows, _stacked_by_rows)
    add([p for p in parts if "trend" in p.spec.primitives], _trend)
    for name, transform in TRANSFORMS.items():
        add([p for p in parts if name in p.spec.transforms], transform)
    others = [p for p in parts if p not in by_rows]
    for parent in _stacked_parents(others):
        add([p for p in others if _of_parent(p, parent)], lambda some, r, parent=parent: _stacked(some, r, parent))
    # The first frame has every target; the others may miss those without parents.
    return reduce(lambda a, b: a.join(b, keys, "left"), frames)


def _dealt(part: Part, wide: DataFrame) -> DataFrame:
    """The frame of one part: its columns under their own names."""
    names = [F.col(f"`{part.out(c)}`").alias(c) for c in plan_features(part.spec)]
    return wide.select(*part.spec.keys, *names)


def _needed(parts: Sequence[Part], extra: Sequence[str] = ()) -> set[str]:
    """Columns of the rows that some parts look at."""
    out = {"date", *extra}
    for part in parts:
        spec = part.spec
        out |= {*spec.keys, *spec.categoricals, *spec.conditions, *spec.parents}
    return out


def synthesize(spec: FeatureSpec, rows: DataFrame) -> DataFrame:
    """All features of a spec, one row per target, in :func:`plan_features` order.

    ``rows`` come from :func:`prepare`. With stacked features several passes
    start from them, so they are written out first.
    """
    part = Part(spec)
    needed = _needed([part])
    rows = rows.select(*[c for c in rows.columns if c in needed])
    if _passes([part]) > 1:
        rows = write_out(rows, "prepared")
    return _dealt(part, _together([part], rows))


def direct_features(spec: FeatureSpec, rows: DataFrame, parent: str) -> DataFrame:
    """Log rows with the aggregates of one of their parents (depth 4's last step).

    For a target these add nothing: a fold over them is already a stacked
    feature of depth 3.
    """
    return lookup(rows, _parent_aggregates([Part(spec)], rows, parent), [parent])


def encoded(spec: FeatureSpec, features: DataFrame, n: int = 10, by_rank: bool = False) -> DataFrame:
    """Replace mode columns by 0/1 columns of their most frequent values."""
    modes = [c for c in plan_features(spec) if c.startswith("mode_")]
    return encode_top_values(features, modes, n, by_rank)


# --- several specs ------------------------------------------------------------


def _scope(target: str) -> str:
    return f"_of_{target}"


def prepare_all(
    specs: Sequence[FeatureSpec],
    log: DataFrame,
    pairs: DataFrame | None,
    profile: DataFrame,
    calendar: PromoCalendar,
    day: Column | None = None,
    unrestricted: Sequence[str] = (),
) -> DataFrame:
    """Log rows that any spec looks at, from one pass over the log.

    The profile is joined once. Whether the entity of a row occurs in ``pairs`` is
    looked up once for each kind of entity that specs are restricted by, and goes
    along as a flag; that of a user comes with the profile.
    """
    actions = sorted({a for s in specs for a in s.actions})
    rows = with_actions(log, actions)
    bound = [] if pairs is None else [s for s in specs if s.name not in unrestricted]
    for target in dict.fromkeys(s.target for s in bound):
        keys = ENTITY_KEYS[target]
        known = pairs.select(*keys).distinct().withColumn(_scope(target), F.lit(True))
        if target == "user_id":
            profile = lookup(profile, known, keys).fillna(False, [_scope(target)])
        else:
            rows = lookup(rows, known, keys).fillna(False, [_scope(target)])
    whole = FeatureSpec("all", "user_seller", tuple(actions), ())
    rows = prepare(whole, rows, None, profile, calendar, day)
    if len(bound) == len(specs) and bound:
        rows = rows.where(reduce(lambda a, b: a | b, [_looked_at(s, True) for s in bound]))
    return rows


def _looked_at(spec: FeatureSpec, restricted: bool) -> Column:
    """Rows of a spec among those of all."""
    picked = F.col("action_type").isin(list(spec.actions))
    return picked & F.col(_scope(spec.target)) if restricted else picked


def synthesize_all(
    specs: Sequence[FeatureSpec],
    log: DataFrame,
    pairs: DataFrame | None,
    profile: DataFrame,
    calendar: PromoCalendar,
    day: Column | None = None,
    unrestricted: Sequence[str] = (),
    side_by_side: int = 4,
) -> dict[str, DataFrame]:
    """Features of many specs by name, computed together; specs named ``unrestricted`` don't look at ``pairs``.

    The log is prepared and written once for all specs (:func:`prepare_all`). Specs
    that look at the same rows (one target entity, the same actions, all restricted to
    ``pairs`` or all not) then share every count: their cells, days and parents are the union of
    what each asks for, and each count is taken under the conditions of any in one
    aggregate; their rows are written for them if they are read more than once. Others share no count, and a row or a target would carry the columns of
    specs that don't look at it. The wide frames, ``side_by_side`` at a time, are written,
    too, and their columns are dealt back to the specs, so reading the result of one spec
    doesn't compute the others again.
    """
    names = [s.name for s in specs]
    if len(set(names)) < len(names):
        raise ValueError("specs must have different names")
    if not specs:
        return {}
    restricted = {s.name: pairs is not None and s.name not in unrestricted for s in specs}
    parts = [Part(s, f"{s.name}__") for s in specs]
    flags = {_scope(s.target) for s in specs if restricted[s.name]}
    if flags:
        pairs = write_out(pairs.select(*ENTITY_KEYS["user_seller"]).distinct(), "pairs")
    rows = prepare_all(specs, log, pairs, profile, calendar, day, unrestricted)
    needed = _needed(parts, ["action_type", *flags])
    rows = write_out(rows.select(*[c for c in rows.columns if c in needed]), "prepared")
    groups: dict[tuple, list[Part]] = {}
    for part in parts:
        same = (part.spec.target, restricted[part.spec.name], frozenset(part.spec.actions))
        groups.setdefault(same, []).append(part)

    def wide(some: list[Part]) -> DataFrame:
        first = some[0].spec
        picked = rows.where(_looked_at(first, restricted[first.name]))
        if _passes(some) > 1:
            looked_at = _needed(some)
            picked = write_out(picked.select(*[c for c in rows.columns if c in looked_at]), "picked")
        return write_out(_together(some, picked), "synthesized")

    with ThreadPoolExecutor(side_by_side) as pool:
        started = [(some, pool.submit(inheritable_thread_target(rows.sparkSession)(wide), some)) for some in groups.values()]
        out = {part.spec.name: _dealt(part, done.result()) for some, done in started for part in some}
    return {name: out[name] for name in names}


_FAVOUR = {"before_pro": (True, False), "action_type": (1, 3)}
_PRO = {"before_pro": (True, False)}
_MONTHS = {"month": (6, 8, 11)}
_LATE_MONTHS = {"month": (6, 9, 10, 11)}
_USUAL = ("count", "mean", "std")
_GOODS = ("cat_id", "brand_id", "item_id")

# The named feature sets.
SPECS: dict[str, FeatureSpec] = {
    s.name: s
    for s in (
        FeatureSpec(
            "seller_buy_mode", "seller_id", (2,), ("mode",), 3, _PRO,
            drop=("user_id", "item_id", "cat_id", "brand_id", "time_stamp"),
            columns=("month", "action_type", "before_pro", "age_range", "gender"),
        ),
        FeatureSpec("seller_fav_count", "seller_id", (1, 3), _USUAL, 4, _FAVOUR),
        FeatureSpec("user_fav_count", "user_id", (1, 3), _USUAL, 3, _FAVOUR),
        FeatureSpec("user_seller_fav_count", "user_seller", (1, 3), _USUAL, 3, _FAVOUR),
        FeatureSpec("user_buy_pro_count", "user_id", (2,), _USUAL, 3, _PRO),
        FeatureSpec("user_click_pro_count", "user_id", (0,), _USUAL, 3, _PRO),
        FeatureSpec("seller_buy_pro_count", "seller_id", (2,), _USUAL, 3, _PRO),
        FeatureSpec("seller_click_pro_count", "seller_id", (0,), _USUAL, 3, _PRO),
        FeatureSpec(
            "user_seller_click_pro_count", "user_seller", (0,), _USUAL, 3, _PRO, extra_parents=_GOODS
        ),
        FeatureSpec(
            "user_seller_click_trend", "user_seller", (0,), ("count", "trend"), 3, _MONTHS,
            extra_parents=_GOODS,
        ),
        FeatureSpec(
            "user_seller_fav_count_per_month", "user_seller", (3,), _USUAL, 3, _MONTHS,
            extra_parents=_GOODS,
        ),
        FeatureSpec(
            "user_seller_cart_count_per_month", "user_seller", (1,), _USUAL, 3, _MONTHS,
            extra_parents=_GOODS,
        ),
        FeatureSpec(
            "user_seller_all_time_mean", "user_seller", (0, 1, 2, 3), ("mean", "std"), 3, _MONTHS,
            extra_parents=_GOODS, transforms=("time_since_previous",),
        ),
        FeatureSpec(
            "user_seller_all_per_month_count_time", "user_seller", (0, 1, 2, 3),
            ("nunique", *_USUAL), 3, _LATE_MONTHS, extra_parents=(*_GOODS, "time_stamp"),
        ),
        FeatureSpec(
            "user_seller_click_unique_count", "user_seller", (0,), ("nunique", "mean", "std"), 3,
            _LATE_MONTHS, extra_parents=_GOODS,
        ),
        FeatureSpec(
            "user_seller_buy", "user_seller", (2,), ("count", "mean", "max", "min", "std", "median"),
            3, extra_parents=("cat_id", "time_stamp", "month", "brand_id"),
        ),
    )
}
