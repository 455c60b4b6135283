"""Quantiles without gathering all values, or all sketches, in one task.

Spark's exact ``percentile`` aggregate keeps a value -> count map per group
and merges every map of a group in one final task: memory grows with the
number of distinct values.  Even a sketch aggregate merges one partial
buffer per map task in the group's final task.  ``exact_quantiles``
computes the same numbers as ``percentile`` (linear interpolation at position
p * (n - 1), as ``describe()`` does) in bounded pieces, the same way at every
input size:

1. bracket: a KLL sketch per group, merged in two levels (map tasks are
   salted by partition id, each salt merges its tasks' sketches, the group
   merges the salts), probed just below and just above the ranks each level
   needs.  Count, mean and ends come from the same scan;
2. count: the values below, at and between the ends of every bracket are
   counted, so ranks are exact from here on.  A rank that falls on an end is
   resolved, however many values are tied there.  A bracket that missed its rank
   becomes the part that holds it.  Where more than ``bound`` values lie strictly
   between the ends, the same scan sketches just these, and the bracket is cut at
   the ranks wanted within it; then the counts are taken again.  Cuts are made
   by rank, so the shape of the distribution does not matter: each pass leaves
   about a 150th;
3. gather: the values strictly inside a bracket (counted: ``bound`` of a group
   and level at most) are ranked by a window.  Where Spark's ``percentile`` is asked for
   by name, it takes this place, over values held to their bracket.

The passes are steered by what was counted, so building the result runs Spark
jobs; only rows per group, ``LOCAL_GROUPS`` at most, reach the driver.  With more
groups their state is a checkpoint in the shared folder (``spark.checkpoint.dir``).

Rows meet the state of their group through ``attach``: literals without groups,
a broadcast of counted size up to ``LOCAL_GROUPS`` groups, so that no raw row is
shuffled; beyond that a join in which only the groups of many rows are salted.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablestats.functions.clean import known
from tablestats.session import ensure_checkpoint_dir

SKETCH_K = 4096   # KLL size parameter of the brackets (about 7e-4 normalised rank error)
MAX_K = 65535     # the largest that Spark's sketch takes
SALTS = 1024      # first-level merge groups of map tasks
MARGIN = 3.0      # bracket half-width, in sketch rank errors
BOUND = 65536     # values of a group and level that a window may rank
LEAST_BOUND = 64  # smaller bounds can't be met: a cut keeps a few values on both sides
INNER_K = 256     # least size parameter of the sketches that cut a bracket
GRID = 1024       # even ranks at which a bracket can be cut
PASSES = 40       # count passes before giving up (each leaves about a 150th)
LOCAL_GROUPS = 10_000       # groups whose state is held on the driver and broadcast
ROWS_PER_COPY = 1_000_000   # rows of a group that meet one copy of its state in a shuffled join


def kll_rank_error(k: int) -> float:
    """Normalised two-sided rank error of a KLL sketch (99% confidence)."""
    return 2.296 / k ** 0.9723


def _two_level_sketch(data: DataFrame, by: list[str], values: list[Column], k: int,
                      extra: list[tuple[Column, str]], salted: bool = True) -> DataFrame:
    """Per group: merged KLL sketches ``_sk0``.. of ``values`` plus aggregates ``_e0``..

    Level 1 groups by (group, partition id mod SALTS): each map task feeds a
    single salt, so each level-1 task merges about #tasks / SALTS sketches;
    level 2 merges at most SALTS sketches per group.  ``extra`` pairs an aggregate with
    the function ('sum', 'min' or 'max') that merges it.
    """
    first = [F.kll_sketch_agg_double(v, k).alias(f"_sk{j}") for j, v in enumerate(values)]
    first += [e.alias(f"_e{j}") for j, (e, _) in enumerate(extra)]
    if not salted:
        return data.groupBy(*by).agg(*first)
    salt = (F.spark_partition_id() % SALTS).alias("_salt")
    return data.groupBy(*by, salt).agg(*first).groupBy(*by).agg(
        *[F.kll_merge_agg_double(f"_sk{j}").alias(f"_sk{j}") for j in range(len(values))],
        *[getattr(F, merge)(f"_e{j}").alias(f"_e{j}") for j, (_, merge) in enumerate(extra)])


def _grid() -> str:
    """``GRID + 1`` even ranks as one constant (a sketch takes no computed ranks)."""
    return "array(" + ", ".join(f"{i / GRID!r}D" for i in range(GRID + 1)) + ")"


def settled(df: DataFrame) -> tuple[DataFrame, list[dict] | None]:
    """``df`` computed once: its rows if there are ``LOCAL_GROUPS`` at most, else a checkpoint and None."""
    rows = df.limit(LOCAL_GROUPS + 1).toArrow()
    if rows.num_rows <= LOCAL_GROUPS:
        return df.sparkSession.createDataFrame(rows, df.schema), rows.to_pylist()
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(), None


def attach(data: DataFrame, side: DataFrame, by: list[str], cols: list[str], rows: list[dict] | None = None,
           weight: str | None = None) -> DataFrame:
    """Add the per-group columns of ``side`` to every data row whose group it has.

    ``rows``: those of ``side`` if ``settled`` gave them.  Otherwise, without groups
    the one row is a scalar subquery, and with groups the join shuffles: groups
    that hold more than ``ROWS_PER_COPY`` rows by the column ``weight`` are
    spread over as many copies of their state.
    """
    if not by:
        if rows is not None:
            types = dict(side.dtypes)
            return data.withColumns({c: F.lit(rows[0][c]).cast(types[c]) for c in cols})
        # One reference to the subquery (a struct), fields extracted afterwards:
        # every extra reference could run the subquery again.
        s = side.select(F.struct(*cols).alias("_s")).scalar()
        with_s = data.select("*", s.alias("_s"))
        return with_s.select(*data.columns, *[F.col("_s").getField(c).alias(c) for c in cols])
    if rows is not None:
        return data.join(F.broadcast(side.select(*by, *cols)), by)
    if weight is None:
        return data.join(side.select(*by, *cols), by)
    copies = F.ceil(F.col(weight) / ROWS_PER_COPY).cast("int")
    heavy, found = settled(side.where(F.col(weight) > ROWS_PER_COPY).select(*by, copies.alias("_copies")))
    spread = data.join(F.broadcast(heavy) if found is not None else heavy, by, "left")
    salt = F.pmod(F.monotonically_increasing_id(), F.coalesce(F.col("_copies"), F.lit(1))).cast("int")
    each = side.select(*by, *cols, F.explode(F.sequence(F.lit(0), F.greatest(copies, F.lit(1)) - 1)).alias("_salt"))
    return spread.withColumn("_salt", salt).drop("_copies").join(each, [*by, "_salt"]).drop("_salt")


class _Targets:
    """Levels of several series of values, numbered through, and SQL for where each stands.

    The position ``p * (n - 1)`` of a level lies at or between the ranks ``low`` and
    ``high``.  Column ``_c{4t}`` and the next three count the values below the bracket
    of target t, at its lower end, strictly inside (ranks ``first`` to ``last - 1``)
    and at its upper end.
    """

    def __init__(self, levels: Sequence[Sequence[float]]):
        self.levels = [[float(p) for p in ps] for ps in levels]
        self.flat = [(s, p) for s, ps in enumerate(self.levels) for p in ps]
        self.all = range(len(self.flat))

    def of(self, s: int) -> list[int]:
        return [t for t, (own, _) in enumerate(self.flat) if own == s]

    def names(self, t: int) -> dict[str, str]:
        s, p = self.flat[t]
        pos = f"({p!r}D * cast(_n{s} - 1 as double))"
        first = f"(_c{4 * t} + _c{4 * t + 1})"
        return {"x": f"_v{s}", "lo": f"_lo{t}", "hi": f"_hi{t}", "least": f"_min{s}", "most": f"_max{s}", "pos": pos,
                "low": f"floor({pos})", "high": f"ceil({pos})", "below": f"_c{4 * t}", "first": first,
                "inside": f"_c{4 * t + 2}", "last": f"({first} + _c{4 * t + 2})", "at_hi": f"_c{4 * t + 3}"}

    def sql(self, t: int, text: str, **more: object) -> str:
        return text.format(**self.names(t), **more)

    def needed(self, t: int) -> str:
        """Does a rank fall strictly inside the bracket?"""
        return self.sql(t, "(({low} >= {first} AND {low} < {last}) OR ({high} >= {first} AND {high} < {last}))")


def _value(v: str | Column) -> Column:
    return known((F.col(v) if isinstance(v, str) else v).cast("double"))


def _values(df: DataFrame, by: list[str], values: Sequence[str | Column]) -> DataFrame:
    """(group keys, _v0, ...) rows with a value that is known, and non-null group keys."""
    cols = [_value(v).alias(f"_v{s}") for s, v in enumerate(values)]
    keep = reduce(lambda a, b: a | b, [F.col(f"_v{s}").isNotNull() for s in range(len(cols))])
    for b in by:
        keep = keep & F.col(b).isNotNull()
    return df.select(*[F.col(b) for b in by], *cols).where(keep)


def _counts(targets: _Targets) -> list[Column]:
    """Per target: values below the bracket, at its lower end, strictly inside, at its upper end."""
    return [F.expr(targets.sql(t, f"count_if({where})")) for t in targets.all for where in
            ("{x} < {lo}", "{x} = {lo}", "{x} > {lo} AND {x} < {hi}", "{x} = {hi} AND {hi} > {lo}")]


class _Fences:
    """Box-plot fences beside the quartiles of series 0 (targets 0, 1, 2).

    The brackets of the quartiles bound both fences.  The count pass also counts what lies
    beyond these bounds and between them, and finds the nearest value inside the
    box's reach; what lies between them is gathered, so that whiskers and outliers
    need no scan of their own.
    """

    def __init__(self, reach: float):
        r = repr(float(reach)) + "D"
        # A hair wider, for the rounding of interpolated quartiles.
        wide = "1e-9D * (abs(_lo0) + abs(_hi2) + abs(_hi2 - _lo0))"
        self.low = (f"(_lo0 - {r} * (_hi2 - _lo0) - {wide})", f"(_hi0 - {r} * (_lo2 - _hi0) + {wide})")
        self.high = (f"(_lo2 + {r} * (_lo2 - _hi0) - {wide})", f"(_hi2 + {r} * (_hi2 - _lo0) + {wide})")
        self.exact = (f"(q1 - {r} * (q3 - q1))", f"(q3 + {r} * (q3 - q1))")
        ends = (*self.low, *self.high)
        self.in_low, self.in_high = (f"(_v0 >= {a} AND _v0 <= {b})" for a, b in (self.low, self.high))
        self.aggregates = [
            (F.expr(f"count_if(_v0 < {self.low[0]})"), "sum"), (F.expr(f"count_if{self.in_low}"), "sum"),
            (F.expr(f"min(CASE WHEN _v0 > {self.low[1]} THEN _v0 END)"), "min"),
            (F.expr(f"count_if(_v0 > {self.high[1]})"), "sum"), (F.expr(f"count_if{self.in_high}"), "sum"),
            (F.expr(f"max(CASE WHEN _v0 < {self.high[0]} THEN _v0 END)"), "max")]
        self.finite = " AND ".join(f"abs({e}) < double('Infinity')" for e in ends)

    def open(self, bound: int) -> str:
        """Is there more between the bounds than may be gathered?"""
        return f"_n0 > 0 AND NOT coalesce({self.finite} AND _f1 <= {bound} AND _f4 <= {bound}, false)"

    def answers(self) -> list[str]:
        """``whisker_low, whisker_high, n_out`` from the quartiles, the counts and the gathered ``_near``."""
        low, high = self.exact
        first = f"array_min(array_append(transform(filter(_near, i -> i.t = -1 AND i.x >= {low}), i -> i.x), _f2))"
        last = f"array_max(array_append(transform(filter(_near, i -> i.t = -2 AND i.x <= {high}), i -> i.x), _f5))"
        beyond = (f"aggregate(_near, _f0 + _f3, (a, i) -> a + CASE WHEN (i.t = -1 AND i.x < {low}) "
                  f"OR (i.t = -2 AND i.x > {high}) THEN i.c ELSE 0L END)")
        return [f"least(coalesce({first}, q1), q1) AS whisker_low", f"greatest(coalesce({last}, q3), q3) AS whisker_high",
                f"{beyond} AS n_out"]


def _narrowed(targets: _Targets, delta: float, bound: int, sketched: bool) -> tuple[list[str], str]:
    """Each target's bracket after its counts, and whether any has to be counted again (SQL)."""
    out, again = [], []
    for t in targets.all:
        large = f"({targets.needed(t)} AND {targets.names(t)['inside']} > {bound})"
        # A rank strictly inside is looked up in the sketch of the values there, a little further out.
        lo, hi = "{lo}", "{hi}"
        if sketched:
            rank_lo, rank_hi = f"(({{low}} - {{first}}) / {{inside}} - {delta!r}D)", f"(({{high}} + 1 - {{first}}) / {{inside}} + {delta!r}D)"
            lo = f"CASE WHEN {large} AND {{low}} >= {{first}} AND {rank_lo} > 0 THEN get(_cuts{t}, cast(floor({rank_lo} * {GRID}) as int)) ELSE {{lo}} END"
            hi = f"CASE WHEN {large} AND {{high}} < {{last}} AND {rank_hi} < 1 THEN get(_cuts{t}, cast(ceil({rank_hi} * {GRID}) as int)) ELSE {{hi}} END"
        missed = "({low} < {below} OR {high} >= {last} + {at_hi})"
        out.append(targets.sql(t, f"CASE WHEN {{low}} < {{below}} THEN {{least}} WHEN {{high}} >= {{last}} + {{at_hi}} THEN {{hi}} ELSE {lo} END AS _lo{t}"))
        out.append(targets.sql(t, f"CASE WHEN {{low}} < {{below}} THEN {{lo}} WHEN {{high}} >= {{last}} + {{at_hi}} THEN {{most}} ELSE {hi} END AS _hi{t}"))
        again.append(targets.sql(t, f"coalesce(_n{targets.flat[t][0]} > 0 AND ({missed} OR {large}), false)"))
    return out, " OR ".join(again) + " AS _again"


def _any(df: DataFrame, rows: list[dict] | None, flag: str) -> bool:
    return any(r[flag] for r in rows) if rows is not None else df.where(flag).limit(1).count() > 0


def _bracketed(df: DataFrame, values: Sequence[str | Column], levels: Sequence[Sequence[float]], by: Sequence[str],
               k: int, salted: bool, bound: int, fences: _Fences | None, states: Sequence[Column]) -> tuple:
    """Passes 1 and 2: ``targets, data, parts, state, rows``.

    Each bracket in ``state`` holds the ranks of its level and at most ``bound`` values
    strictly inside, if a rank falls there."""
    by, targets = list(by), _Targets(levels)
    keys = [f"`{b}`" for b in by]
    n_series = len(levels)
    data = _values(df, by, values)
    delta = MARGIN * kll_rank_error(k)
    inner_k, bound = max(k, INNER_K), max(bound, LEAST_BOUND)

    # Pass 1: count, mean, ends and a sketch; probes around each level's ranks.
    series = [F.col(f"_v{s}") for s in range(n_series)]
    extra = [(F.expr(f"{f}(_v{s})"), m) for s in range(n_series) for f, m in
             (("count", "sum"), ("sum", "sum"), ("min", "min"), ("max", "max"))]
    n_extra = len(extra)
    extra += [(state, "collect_list") for state in states]
    rows_read = df.withColumns({f"_v{s}": _value(v) for s, v in enumerate(values)}) if states else data
    first = _two_level_sketch(rows_read, by, series, k, extra, salted or bool(states))
    cols = [f"_e{n_extra + i} AS _s{i}" for i in range(len(states))]
    for s in range(n_series):
        n, total, least, most = (f"_e{4 * s + i}" for i in range(4))
        cols += [f"coalesce({n}, 0L) AS _n{s}", f"try_divide({total}, {n}) AS _mean{s}", f"{least} AS _min{s}", f"{most} AS _max{s}"]
    for t, (s, p) in enumerate(targets.flat):
        probe = f"CASE WHEN _e{4 * s} > 0 THEN kll_sketch_get_quantile_double(_sk{s}, {{!r}}D) END"
        cols.append((f"_e{4 * s + 2}" if p - delta <= 0 else probe.format(p - delta)) + f" AS _lo{t}")
        cols.append((f"_e{4 * s + 3}" if p + delta >= 1 else probe.format(p + delta)) + f" AS _hi{t}")
    state, rows = settled(first.selectExpr(*keys, *cols))
    parts = state.select(*by, *[f"_s{i}" for i in range(len(states))])
    state = state.drop(*[f"_s{i}" for i in range(len(states))])
    brackets = [f"_{end}{t}" for t in targets.all for end in ("lo", "hi")]
    kept = [c for c in state.columns if c not in by and c not in brackets]

    # Count passes, until no bracket missed its ranks or holds more than the bound.
    most_rows = (max((r[f"_n{s}"] for r in rows for s in range(n_series)), default=0) if rows is not None
                 else max(state.agg(*[F.max(f"_n{s}") for s in range(n_series)]).first()))
    sketched = 4 * delta * most_rows > bound
    counts = _counts(targets)
    numbers = [f"coalesce(_c{i}, 0L) AS _c{i}" for i in range(len(counts))]
    beside = fences.aggregates if fences else []
    numbers += [f"_f{i}" for i in range(len(beside))]
    renamed = [f"_e{i} AS _c{i}" for i in range(len(counts))] + [f"_e{len(counts) + i} AS _f{i}" for i in range(len(beside))]
    for _ in range(PASSES):
        met = attach(data, state, by, brackets, rows, "_n0")
        if sketched:
            inside = [F.expr(targets.sql(t, "CASE WHEN {x} > {lo} AND {x} < {hi} THEN {x} END")) for t in targets.all]
            both = _two_level_sketch(met, by, inside, inner_k, [*((c, "sum") for c in counts), *beside], salted)
            counted = both.selectExpr(*keys, *renamed, *[
                f"CASE WHEN kll_sketch_get_n_double(_sk{t}) > 0 THEN kll_sketch_get_quantile_double(_sk{t}, {_grid()}) END AS _cuts{t}"
                for t in targets.all])
        else:
            counted = met.groupBy(*by).agg(*[c.alias(f"_c{i}") for i, c in enumerate(counts)],
                                           *[c.alias(f"_f{i}") for i, (c, _) in enumerate(beside)])
        ends, again = _narrowed(targets, MARGIN * kll_rank_error(inner_k), bound, sketched)
        fresh = attach(counted, state, by, [*kept, *brackets], rows)
        state, rows = settled(fresh.selectExpr(*keys, *kept, *ends, *numbers, again))
        if not _any(state, rows, "_again"):
            break
        sketched = True
    else:
        raise RuntimeError("the brackets of exact_quantiles did not close")
    return targets, data, parts, state, rows


def exact_series(df: DataFrame, values: Sequence[str | Column], levels: Sequence[Sequence[float]],
                 by: Sequence[str] = (), k: int = SKETCH_K, salted: bool = True, bound: int = BOUND,
                 fences: _Fences | None = None, states: Sequence[Column] = ()) -> DataFrame:
    """Per group, for series ``s`` of ``values``: ``n{s}``, ``mean{s}``, ``q{s}`` (an exact quantile per level).

    All series go through the same scans; see the module for the passes.  Rows with
    a null group key are ignored, groups without any known value are absent; without
    ``by`` there is always one row (n = 0 and null quantiles for an empty input).
    ``fences`` adds ``whisker_low``, ``whisker_high`` and ``n_out``, unless more than
    ``bound`` values of a group lie where a fence can be.  ``states`` are aggregates over
    the rows of ``df`` that the first scan takes as well; ``s0``, ... are arrays of
    their values, one for each of at most ``SALTS`` parts of the data.
    """
    by, keys, n_series = list(by), [f"`{b}`" for b in by], len(levels)
    bound = max(bound, LEAST_BOUND)
    targets, data, parts, state, rows = _bracketed(df, values, levels, by, k, salted, bound, fences, states)
    brackets = [f"_{end}{t}" for t in targets.all for end in ("lo", "hi")]
    beside = fences.aggregates if fences else []

    # Gather what lies strictly inside a bracket whose ranks fall there.
    open_fences = fences.open(bound) if fences else "true"
    state = state.selectExpr("*", *[f"{targets.needed(t)} AS _need{t}" for t in targets.all], f"{open_fences} AS _open")
    if rows is not None:
        state, rows = settled(state)
    if fences and _any(state, rows, "_open"):
        fences = None
    picked, inner = state, False
    if fences or any(_any(state, rows, f"_need{t}") for t in targets.all):
        inner = True
        met = attach(data, state, by, [*brackets, *[f"_need{t}" for t in targets.all]], rows, "_n0")
        hits = [targets.sql(t, f"_need{t} AND {{x}} > {{lo}} AND {{x}} < {{hi}}") for t in targets.all]
        each = ", ".join(targets.sql(t, f"CASE WHEN {hits[t]} THEN struct({t} AS t, {{x}} AS x) END") for t in targets.all)
        if fences:
            hits += [fences.in_low, fences.in_high]
            each += "".join(f", CASE WHEN {hit} THEN struct({t} AS t, _v0 AS x) END" for t, hit in ((-1, fences.in_low), (-2, fences.in_high)))
        hist = (met.where(" OR ".join(f"({h})" for h in hits))
                .selectExpr(*keys, f"explode(filter(array({each}), i -> i IS NOT NULL)) AS _i")
                .groupBy(*by, "_i.t", "_i.x").agg(F.count(F.lit(1)).alias("_c")))
        order = Window.partitionBy(*by, "t").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        facts = [c for c in state.columns if c not in by]
        ranked = attach(hist.withColumn("_end", F.sum("_c").over(order)), state, by,
                        [c for c in facts if c[:2] in ("_n", "_c") and not c.startswith("_need")], rows)
        picks = [F.expr(targets.sql(
            t, f"max(CASE WHEN t = {t} AND {{{rank}}} - {{first}} < _end AND {{{rank}}} - {{first}} >= _end - _c THEN x END)")).alias(f"_{name}{t}")
            for t in targets.all for name, rank in (("a", "low"), ("b", "high"))]
        if fences:
            near = F.collect_list(F.when(F.col("t") < 0, F.struct("t", "x", F.col("_c").alias("c"))))
            picks.append(near.alias("_near"))
        picked = ranked.groupBy(*by).agg(*picks)
        if by:
            picked = state.join(F.broadcast(picked) if rows is not None else picked, by, "left")
        else:
            picked = attach(picked, state, by, facts, rows)

    def quantile(t: int) -> str:
        a, b = (f"CASE WHEN {{{rank}}} < {{first}} THEN {{lo}} WHEN {{{rank}}} >= {{last}} THEN {{hi}} ELSE "
                + (f"_{name}{t}" if inner else "null") + " END" for name, rank in (("a", "low"), ("b", "high")))
        return targets.sql(t, f"CASE WHEN {{low}} = {{high}} THEN {a} ELSE ({{high}} - {{pos}}) * ({a}) + ({{pos}} - {{low}}) * ({b}) END")

    out = [c for s in range(n_series) for c in (
        f"_n{s} AS n{s}", f"_mean{s} AS mean{s}",
        f"CASE WHEN _n{s} > 0 THEN array({', '.join(quantile(t) for t in targets.of(s))}) END AS q{s}")]
    if states:
        picked = attach(picked, parts, by, [f"_s{i}" for i in range(len(states))])
    out += [f"_s{i} AS s{i}" for i in range(len(states))]
    if not fences:
        return picked.selectExpr(*keys, *out)
    near = "coalesce(_near, array()) AS _near" if by else "_near"
    box = picked.selectExpr(*keys, *out, near, *[f"_f{i}" for i in range(len(beside))])
    return (box.withColumns({"q1": F.get("q0", 0), "q3": F.get("q0", 2)})
            .selectExpr(*keys, *[c.split(" AS ")[-1] for c in out], *fences.answers()))


def own_percentiles(df: DataFrame, values: Sequence[str | Column], levels: Sequence[Sequence[float]],
                    by: Sequence[str] = (), k: int = SKETCH_K, bound: int = BOUND) -> tuple[DataFrame, list[Column]]:
    """``df`` with brackets, and for each series an aggregate: an array of Spark's own ``percentile`` per level.

    Held to a bracket that contains the ranks of its level, values beyond it count as its
    ends: the order within is as it was, and so is the percentile.  Where no rank falls
    strictly inside, what is there counts as the lower end.  Of the distinct values in the
    maps of all tasks, which one task merges, ``bound`` at most are then no ends.
    Rows with a null group key, or of a group without known values, are left out."""
    by = list(by)
    targets, _, _, state, rows = _bracketed(df, values, levels, by, k, True, max(bound, LEAST_BOUND), None, ())
    state = state.selectExpr("*", *[f"{targets.needed(t)} AS _need{t}" for t in targets.all])
    if rows is not None:
        state, rows = settled(state)
    met = attach(df, state, by, [f"_{c}{t}" for t in targets.all for c in ("lo", "hi", "need")], rows, "_n0")

    def held(s: int, t: int) -> Column:
        x, lo, hi = _value(values[s]), F.col(f"_lo{t}"), F.col(f"_hi{t}")
        return F.when((x <= lo) | (~F.col(f"_need{t}") & (x < hi)), lo).when(x >= hi, hi).otherwise(x)

    return met, [F.array(*[F.percentile(held(s, t), F.lit(targets.flat[t][1])) for t in targets.of(s)])
                 for s in range(len(levels))]


def exact_quantiles(df: DataFrame, value: str | Column, levels: Sequence[float],
                    by: Sequence[str] = (), k: int = SKETCH_K, salted: bool = True,
                    method: str | None = None, bound: int = BOUND) -> DataFrame:
    """Per group: ``n`` (non-null values), ``mean`` and ``q`` (array, one exact quantile per level).

    Rows with a null group key are ignored, and groups without any non-null
    value are absent; without ``by`` there is always one row (n = 0 and null
    quantiles for an empty input).  NaN counts as null.

    The result and the way to it are the same at every size; ``bound`` is the number
    of values of a group and level that a task may rank (``LEAST_BOUND`` at least), ``salted=False`` merges the sketches of a group in
    one level, and ``method='percentile'`` asks for Spark's own aggregate, over values held
    to the counted brackets (``own_percentiles``).
    """
    by = list(by)
    if exact_method(method) == "percentile":
        x = F.col("_v0")
        met, (q,) = own_percentiles(_values(df, by, [value]), [x], [levels], by, k, bound)
        return met.groupBy(*by).agg(F.count(x).alias("n"), F.avg(x).alias("mean"), F.when(F.count(x) > 0, q).alias("q"))
    out = exact_series(df, [value], [levels], by, k, salted, bound)
    return out.select(*by, F.col("n0").alias("n"), F.col("mean0").alias("mean"), F.col("q0").alias("q"))


def exact_box(df: DataFrame, value: str | Column, by: Sequence[str], reach: float, k: int = SKETCH_K,
              bound: int = BOUND) -> DataFrame:
    """Per group: ``n``, ``q`` (the quartiles) and, where three scans give them,
    ``whisker_low``, ``whisker_high``, ``n_out`` for fences ``reach`` inter-quartile ranges off the box."""
    by = list(by)
    out = exact_series(df, [value], [(0.25, 0.5, 0.75)], by, k, True, bound, _Fences(reach))
    more = [c for c in ("whisker_low", "whisker_high", "n_out") if c in out.columns]
    return out.select(*by, F.col("n0").alias("n"), F.col("q0").alias("q"), *more)


def approx_quantiles(df: DataFrame, value: str | Column, levels: Sequence[float],
                     by: Sequence[str] = (), k: int = SKETCH_K,
                     salted: bool = True) -> DataFrame:
    """Per group: ``n``, ``q`` (array) and ``mean``: KLL sketch quantiles and the mean, in one pass.

    The sketches are merged in two levels: no task merges more than about
    SALTS of them.  Normalised rank error about ``kll_rank_error(k)``; the
    sketch draws at random, so values may differ between runs within that
    error.  Same row contract as ``exact_quantiles``.
    """
    by = list(by)
    data, x = _values(df, by, [value]), F.col("_v0")
    sk = _two_level_sketch(data, by, [x], k, [(F.count(x), "sum"), (F.sum(x), "sum")], salted)
    return sk.select(*by, F.coalesce(F.col("_e0"), F.lit(0)).cast("long").alias("n"), _sketched("_sk0", levels).alias("q"),
                     F.try_divide(F.col("_e1"), F.col("_e0")).alias("mean"))


def _sketched(sketch: str, levels: Sequence[float]) -> Column:
    ranks = F.array(*[F.lit(float(p)) for p in levels])
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, ranks))


def approx_series(df: DataFrame, values: Sequence[str | Column], levels: Sequence[Sequence[float]],
                  k: int = SKETCH_K, states: Sequence[Column] = ()) -> DataFrame:
    """One row: ``q{s}``, sketch quantiles of every series, and ``s{i}``, arrays of the ``states``
    (as in ``exact_series``); one scan for all of them."""
    rows = df.withColumns({f"_v{s}": _value(v) for s, v in enumerate(values)})
    sk = _two_level_sketch(rows, [], [F.col(f"_v{s}") for s in range(len(levels))], k, [(state, "collect_list") for state in states])
    return sk.select(*[_sketched(f"_sk{s}", own).alias(f"q{s}") for s, own in enumerate(levels)],
                     *[F.col(f"_e{i}").alias(f"s{i}") for i in range(len(states))])


def exact_method(method: str | None = None) -> str:
    """'bracket' (the one path, whatever the size), or 'percentile' if asked for by name."""
    if method not in ("percentile", "bracket", None):
        raise ValueError("method must be 'percentile', 'bracket' or None")
    return method or "bracket"


def sketch_kind(sketch: str | None) -> str:
    """'kll' (two-level merge, whatever the size), or 'gk' (Spark's
    ``percentile_approx`` in one aggregate) if asked for by name."""
    if sketch not in ("gk", "kll", None):
        raise ValueError("sketch must be 'gk', 'kll' or None")
    return sketch or "kll"


def fused_quantiles(exact: bool, sketch: str | None = None, method: str | None = None) -> bool:
    """True when the caller named an aggregate that computes quantiles within
    its own: the GK sketch, or the exact percentile."""
    return exact_method(method) == "percentile" if exact else sketch_kind(sketch) == "gk"


def rel_err_to_k(rel_err: float) -> int:
    """Smallest KLL k whose 99 % rank error is at most half of ``rel_err``."""
    k = int((2 * 2.296 / rel_err) ** (1 / 0.9723)) + 1
    if k > MAX_K:
        raise ValueError(f"a rank error of {rel_err} needs a sketch of k = {k}; the largest is {MAX_K}")
    return max(8, k)
