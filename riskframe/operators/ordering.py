"""Exact global order without a one-task window.

* ``select_ranks`` finds the values at given ranks of any number of columns. Each round takes
  approximate quantiles of a few rows as pivots, counts all rows exactly around them, and keeps
  only the interval that holds the wanted rank. Pivots that hit the rank end the search, so a
  value that fills a third of the table cannot stall it. The driver sees pivots and counts only.
* ``order_cuts`` does the same for a lexicographic order (time, id, ...), which turns every split
  by position into a plain filter.
* ``running_sums`` gives running totals in key order, per range bucket plus bucket offsets.
* ``dense_codes`` numbers sorted distinct strings.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.session import materialise, shuffle_width

LEAF_ROWS = 1 << 17  # an interval of at most this many rows is sorted inside one aggregate
PRECISION = 2000  # accuracy of the pivots
PIVOT_ROWS = 1 << 20  # pivots and bounds are read from about this many rows
COLUMNS_PER_JOB = 32  # keeps the aggregate expressions of wide tables small
SINGLE_BUCKET_ROWS = 200_000  # below this a global order is one bucket
STRING_BOUNDS = 256  # least and most pieces of a global order of strings
MOST_STRING_BOUNDS = 8192


# -- keys ---------------------------------------------------------------------------------------


def numeric_key(df: DataFrame, column: Column | str) -> Column:
    """``column`` as BIGINT or DOUBLE in the same order; NaN counts as missing."""
    col = F.col(column) if isinstance(column, str) else column
    kind = df.select(col).schema[0].dataType
    if isinstance(kind, T.LongType):
        return col
    if isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType, T.BooleanType)):
        return col.cast("bigint")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.nanvl(col.cast("double"), F.lit(None).cast("double"))
    if isinstance(kind, T.DecimalType):
        return col.cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(col.cast("timestamp"))
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("bigint")
    raise TypeError(f"no numeric order for {kind.simpleString()}")


def content_keys(df: DataFrame) -> list[Column]:
    """Two 52-bit hashes of the row: the last tie-breakers, exact in DOUBLE pivots."""
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if not _has_map(f.dataType)]
    return [F.shiftright(F.xxhash64(F.lit(seed), *plain), 12) for seed in (1, 2)]


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.MapType):
        return True
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return False


def total_order(df: DataFrame, *columns: str) -> list[Column]:
    """Order keys for ``columns``, completed by row content so that only true copies tie.

    A column without numeric order (a string id) is left to the content hashes.
    """
    keys = []
    for name in columns:
        if name in df.columns and not isinstance(df.schema[name].dataType, T.StringType):
            keys.append(numeric_key(df, name))
    return keys + content_keys(df)


# -- values at ranks ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Located:
    """The value at a rank, the rows below it and the rows equal to it."""

    value: int | float
    below: int
    equal: int


@dataclass
class _Search:
    name: str
    rank: int
    lo: int | float | None
    hi: int | float | None
    below: int
    rows: int

    @property
    def bracket(self) -> tuple:
        return self.name, self.lo, self.hi


def select_ranks(
    df: DataFrame,
    keys: dict[str, Column],
    ranks: Callable[[str, int], Sequence[int]],
    leaf_rows: int | None = None,
) -> dict[str, tuple[int, dict[int, Located]]]:
    """For each key its non-missing count and the exact values at ``ranks(name, count)``."""
    leaf_rows = leaf_rows or LEAF_ROWS
    names = list(keys)
    out: dict[str, tuple[int, dict[int, Located]]] = {}
    for start in range(0, len(names), COLUMNS_PER_JOB):
        part = names[start : start + COLUMNS_PER_JOB]
        frame = df.select(*[keys[n].alias(f"k{i}") for i, n in enumerate(part)])
        found = _select(frame, lambda alias, n, _, p=part: ranks(p[int(alias[1:])], n), leaf_rows)
        out.update({part[int(alias[1:])]: result for alias, result in found.items()})
    return out


def _select(frame, ranks, leaf_rows):
    edge = frame.agg(
        *[
            F.struct(F.count(c).alias("n"), F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c)
            for c in frame.columns
        ],
        F.count(F.lit(1)).alias("rows"),
    ).first()
    out = {c: (edge[c].n, {}) for c in frame.columns}
    open_: list[_Search] = []
    for c in frame.columns:
        for rank in sorted(set(ranks(c, edge[c].n, edge["rows"]))):
            if not 0 <= rank < edge[c].n:
                raise ValueError(f"rank {rank} outside 0..{edge[c].n - 1}")
            open_.append(_Search(c, rank, edge[c].lo, edge[c].hi, 0, edge[c].n))
    for s in open_:  # the interval is open, so step outside the extreme values
        s.lo = s.lo - 1 if isinstance(s.lo, int) and s.lo > -(2**63) else None
        s.hi = s.hi + 1 if isinstance(s.hi, int) and s.hi < 2**63 - 1 else None
    while open_:
        wide = [s for s in open_ if s.rows > leaf_rows]
        leaves = [s for s in open_ if s.rows <= leaf_rows]
        if leaves:
            for s, hit in zip(leaves, _read_leaves(frame, leaves)):
                out[s.name][1][s.rank] = hit
        open_ = []
        if wide:
            for s, hit in _narrow(frame, wide):
                if hit is None:
                    open_.append(s)
                else:
                    out[s.name][1][s.rank] = hit
    return out


def _inside(s: _Search) -> Column:
    x, cond = F.col(s.name), F.col(s.name).isNotNull()
    if s.lo is not None:
        cond = cond & (x > F.lit(s.lo))
    if s.hi is not None:
        cond = cond & (x < F.lit(s.hi))
    return cond


def _narrowed(frame: DataFrame, searches: list[_Search]) -> DataFrame:
    brackets = {s.bracket: s for s in searches}
    return frame.where(reduce(lambda a, b: a | b, [_inside(s) for s in brackets.values()]))


def _read_leaves(frame: DataFrame, searches: list[_Search]) -> list[Located]:
    brackets = {s.bracket: s for s in searches}
    slot = {b: f"v{i}" for i, b in enumerate(brackets)}
    lists = _narrowed(frame, searches).agg(
        *[
            F.sort_array(F.collect_list(F.when(_inside(s), F.col(s.name)))).alias(slot[b])
            for b, s in brackets.items()
        ]
    )
    picks = []
    for i, s in enumerate(searches):
        values = F.col(slot[s.bracket])
        value = F.get(values, F.lit(s.rank - s.below))
        picks.append(
            F.struct(
                value.alias("value"),
                (F.array_position(values, value) - 1).alias("below"),
                _count_of(values, value).alias("equal"),
            ).alias(f"s{i}")
        )
    row = lists.select(*picks).first()
    return [
        Located(row[f"s{i}"].value, s.below + row[f"s{i}"].below, row[f"s{i}"].equal)
        for i, s in enumerate(searches)
    ]


def _count_of(values: Column, value: Column) -> Column:
    return F.size(F.filter(values, lambda v: v == value))


def some_rows(rows: int) -> Column:
    """Predicate that keeps about ``PIVOT_ROWS`` of ``rows`` rows.

    Quantile sketches of all tasks meet in one task, so they must stay small. What is read from
    these rows only places pivots and bucket bounds; no result depends on the choice.
    """
    return F.lit(True) if rows <= PIVOT_ROWS else F.rand(42) < PIVOT_ROWS / rows


def _narrow(frame: DataFrame, searches: list[_Search]):
    brackets: dict[tuple, list[_Search]] = {}
    for s in searches:
        brackets.setdefault(s.bracket, []).append(s)
    near = _narrowed(frame, searches)
    thinned = near.withColumn("_u", F.rand(42))
    asks = []
    for i, group in enumerate(brackets.values()):
        probs = set()
        for s in group:
            p = (s.rank - s.below) / s.rows
            probs |= {min(1.0, max(0.0, p + d / PRECISION)) for d in (-4, 0, 4)}
        picked = _inside(group[0])
        if group[0].rows > PIVOT_ROWS:
            picked = picked & (F.col("_u") < PIVOT_ROWS / group[0].rows)
        asks.append(
            F.percentile_approx(
                F.when(picked, F.col(group[0].name)), sorted(probs), PRECISION
            ).alias(f"p{i}")
        )
    row = thinned.agg(*asks).first()
    pivots = []
    for i, group in enumerate(brackets.values()):
        chosen = set(row[f"p{i}"] or [])
        s = group[0]
        if isinstance(s.lo, int) and isinstance(s.hi, int):
            # BIGINT pivots pass through DOUBLE; halving ends the search beyond 2^53 too
            chosen.add((s.lo + s.hi) // 2)
        pivots.append(sorted(chosen))
    places = [
        F.when(_inside(group[0]), _place(F.col(group[0].name), pivots[i]))
        for i, group in enumerate(brackets.values())
    ]
    if len(places) == 1:
        coded = near.select(F.lit(0).alias("bracket"), places[0].alias("place"))
    else:
        entries = [
            F.struct(F.lit(i).alias("bracket"), place.alias("place"))
            for i, place in enumerate(places)
        ]
        coded = near.select(F.inline(F.array(*entries)))
    counted = (
        coded.where("place is not null")
        .groupBy("bracket", "place")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()  # at most two rows per pivot
    )
    by_place = {(r["bracket"], r["place"]): r["n"] for r in counted}
    for i, group in enumerate(brackets.values()):
        counts = [by_place.get((i, place), 0) for place in range(2 * len(pivots[i]) + 1)]
        for s in group:
            target, hit = s.rank - s.below, None
            lo, hi, below, upto = s.lo, s.hi, 0, s.rows
            less = 0
            for j, p in enumerate(pivots[i]):
                less, same = less + counts[2 * j], counts[2 * j + 1]
                if less > target:
                    hi, upto = p, less
                    break
                if target < less + same:
                    hit = Located(p, s.below + less, same)
                    break
                less += same
                lo, below = p, less
            yield _Search(s.name, s.rank, lo, hi, s.below + below, upto - below), hit


def _place(x: Column, pivots: Sequence) -> Column:
    """2i for a value between pivots, 2i + 1 for one equal to pivot i, by binary decisions."""

    def decide(low: int, high: int) -> Column:
        if low < high:
            mid = (low + high) // 2
            return F.when(x < F.lit(pivots[mid]), decide(low, mid)).otherwise(
                decide(mid + 1, high)
            )
        if low == 0:
            return F.lit(0)
        return F.when(x == F.lit(pivots[low - 1]), F.lit(2 * low - 1)).otherwise(F.lit(2 * low))

    return decide(0, len(pivots))


def exact_quantiles(
    df: DataFrame, keys: dict[str, Column], probabilities: Sequence[float]
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles, exact; ``[None, ...]`` for a column without values."""

    def ends(n: int) -> list[tuple[int, int, float]]:
        spots = [p * (n - 1) for p in probabilities]
        return [(int(s), min(int(s) + 1, n - 1), s - int(s)) for s in spots]

    found = select_ranks(
        df, keys, lambda _, n: [r for lo, hi, _ in ends(n) for r in (lo, hi)] if n else []
    )
    out: dict[str, list[float | None]] = {}
    for name, (n, hits) in found.items():
        if n == 0:
            out[name] = [None] * len(probabilities)
            continue
        values = []
        for lo, hi, share in ends(n):
            a, b = float(hits[lo].value), float(hits[hi].value)
            values.append(a + (b - a) * share)
        out[name] = values
    return out


# -- cuts in a lexicographic order --------------------------------------------------------------


@dataclass(frozen=True)
class Cut:
    """A position in an order: rows whose keys sort before ``path`` lie before it.

    ``spare`` of the ``equal`` identical rows at ``path`` also lie before it.
    An empty path stands for the end of the table (``all_before``) or its start.
    """

    path: tuple
    all_before: bool = False
    spare: int = 0
    equal: int = 0


def order_cuts(
    df: DataFrame, order: Sequence[Column], ranks: Callable[[int], Sequence[int]]
) -> list[Cut]:
    """The cuts after the first ``rank`` rows for the ranks that ``ranks(rows)`` names.

    Missing keys sort last. The rows are counted by the scan that starts the search. Ties are
    settled key by key; all ties of one level are searched together.
    """
    wanted: list[int] = []
    cuts: dict[int, Cut] = {}
    # path -> {rank: (position among the rows at the path, number of those rows)}
    open_: dict[tuple, dict[int, tuple[int, int]]] = {(): {}}

    def start(rows: int) -> None:
        wanted.extend(ranks(rows))
        for rank in wanted:
            if rank <= 0:
                cuts[rank] = Cut(())
            elif rank >= rows:
                cuts[rank] = Cut((), all_before=True)
            else:
                open_[()][rank] = (rank, rows)

    for level, key in enumerate(order):
        tied: dict[tuple, dict[int, tuple[int, int]]] = {}
        paths = list(open_)
        for at in range(0, len(paths), COLUMNS_PER_JOB):
            part = paths[at : at + COLUMNS_PER_JOB]

            def positions(alias: str, n: int, rows: int, part=part) -> list[int]:
                if level == 0:
                    start(rows)
                return [p for p, _ in open_[part[int(alias[1:])]].values() if p < n]

            if level == 0:
                frame = df.select(key.alias("k0"))
            else:
                here = [rows_at(order, Cut(path)) for path in part]
                frame = df.where(reduce(lambda a, b: a | b, here)).select(
                    *[F.when(cond, key).alias(f"k{i}") for i, cond in enumerate(here)]
                )
            found = _select(frame, positions, LEAF_ROWS)
            for i, path in enumerate(part):
                n, hits = found[f"k{i}"]
                for rank, (position, rows) in open_[path].items():
                    hit = hits.get(position) or Located(None, n, rows - n)
                    deeper, rest = path + (hit.value,), position - hit.below
                    if rest == 0:
                        cuts[rank] = Cut(deeper)
                    elif level + 1 < len(order):
                        tied.setdefault(deeper, {})[rank] = (rest, hit.equal)
                    else:
                        cuts[rank] = Cut(deeper, spare=rest, equal=hit.equal)
        open_ = tied
        if not open_:
            break
    return [cuts[rank] for rank in wanted]


def before(order: Sequence[Column], cut: Cut) -> Column:
    """Predicate 'the row lies before the cut' (NULL means no)."""
    if not cut.path:
        return F.lit(cut.all_before)
    cond = None
    for key, value in reversed(list(zip(order, cut.path))):
        lower = key.isNotNull() if value is None else key < F.lit(value)
        same = key.isNull() if value is None else key == F.lit(value)
        cond = lower if cond is None else lower | (same & cond)
    return cond


def not_before(order: Sequence[Column], cut: Cut) -> Column:
    """The opposite of ``before``, missing keys included, in a form that scans can push down."""
    if not cut.path:
        return F.lit(not cut.all_before)
    cond = None
    for key, value in reversed(list(zip(order, cut.path))):
        if value is None:
            after, same = F.lit(False), key.isNull()
            reached = same
        else:
            after, same = (key > F.lit(value)) | key.isNull(), key == F.lit(value)
            reached = (key >= F.lit(value)) | key.isNull()
        cond = reached if cond is None else after | (same & cond)
    return cond


def rows_at(order: Sequence[Column], cut: Cut) -> Column:
    """Predicate 'the row has the keys of the cut'."""
    parts = [k.isNull() if v is None else k == F.lit(v) for k, v in zip(order, cut.path)]
    return F.coalesce(reduce(lambda a, b: a & b, parts), F.lit(False))


def _copies(df: DataFrame, order: Sequence[Column], cut: Cut, number: int) -> DataFrame:
    """``number`` of the identical rows at the cut, made by all tasks from one of them."""
    one = df.where(rows_at(order, cut)).limit(1).select(F.struct("*"))
    return df.sparkSession.range(number).select(one.scalar().alias("row")).select("row.*")


def slice_rows(
    df: DataFrame, order: Sequence[Column], start: Cut | None = None, end: Cut | None = None
) -> DataFrame:
    """Rows from ``start`` (inclusive) to ``end`` (exclusive) as a filter."""
    cond = F.lit(True)
    if start is not None:
        cond = not_before(order, start)
        if start.spare:
            cond = cond & ~rows_at(order, start)
    if end is not None:
        cond = before(order, end) if start is None else cond & before(order, end)
    rows = df.where(cond)
    lead, tail = (start.spare if start else 0), (end.spare if end else 0)
    if lead and tail and start.path == end.path:
        return rows.unionByName(_copies(df, order, start, tail - lead))
    if lead:
        rows = rows.unionByName(_copies(df, order, start, start.equal - lead))
    if tail:
        rows = rows.unionByName(_copies(df, order, end, tail))
    return rows


def with_segment(
    df: DataFrame, order: Sequence[Column], cuts: Sequence[Cut], name: str
) -> DataFrame:
    """Number of cuts at or before each row, in one scan; ``cuts`` in ascending order."""
    segment = F.lit(0)
    for cut in cuts:
        segment = segment + F.coalesce(not_before(order, cut), F.lit(False)).cast("int")
    shared: dict[tuple, list[int]] = {}
    for i, cut in enumerate(cuts):
        if cut.spare:
            shared.setdefault(cut.path, []).append(i)
    rows = df
    for at in shared.values():
        rows = rows.where(~rows_at(order, cuts[at[0]]))
    rows = rows.withColumn(name, segment)
    for at in shared.values():
        marks = [0] + [cuts[i].spare for i in at] + [cuts[at[0]].equal]
        for step, (low, high) in enumerate(zip(marks, marks[1:])):
            if high > low:
                part = _copies(df, order, cuts[at[0]], high - low)
                rows = rows.unionByName(part.withColumn(name, F.lit(at[0] + step)))
    return rows


# -- running totals -----------------------------------------------------------------------------


def range_bounds(df: DataFrame, columns: Sequence[str]) -> dict[str, list[float]]:
    """Inner bucket bounds per DOUBLE column: approximate quantiles, none for small tables."""
    parts = shuffle_width(df.sparkSession)
    n = df.count()
    if n <= SINGLE_BUCKET_ROWS or parts == 1:
        return {c: [] for c in columns}
    probs = [i / parts for i in range(1, parts)]
    row = (
        df.where(some_rows(n))
        .agg(*[F.percentile_approx(c, probs, 10 * parts).alias(f"b{i}") for i, c in enumerate(columns)])
        .first()
    )
    return {c: sorted(set(row[f"b{i}"] or [])) for i, c in enumerate(columns)}


def with_buckets(
    df: DataFrame, bounds: dict[str, list[float]], suffix: str = "_bucket"
) -> DataFrame:
    """Add ``<column><suffix>``, the index of the range bucket of each column."""
    inf = float("inf")
    out = df
    for column, inner in bounds.items():
        if not inner:
            out = out.withColumn(column + suffix, F.when(F.col(column).isNotNull(), F.lit(0)))
            continue
        out = Bucketizer(
            inputCol=column,
            outputCol=column + suffix,
            splits=[-inf] + [b for b in inner if abs(b) < inf] + [inf],
            handleInvalid="keep",
        ).transform(out)
        out = out.withColumn(column + suffix, F.col(column + suffix).cast("int"))
    return out


def running_sums(
    df: DataFrame, key: str, sums: dict[str, str], bucket: str, by: Sequence[str] = ()
) -> DataFrame:
    """Running totals ``{result: column}`` in key order within ``by``; keys must be distinct.

    Each bucket is summed on its own; the bucket totals (one row per bucket) give the offsets.
    """
    within = (
        Window.partitionBy(*by, bucket)
        .orderBy(key)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    earlier = (
        Window.partitionBy(*by)
        .orderBy(bucket)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow - 1)
    )
    totals = df.groupBy(*by, bucket).agg(*[F.sum(c).alias(f"_t_{r}") for r, c in sums.items()])
    offsets = totals.select(
        *by,
        bucket,
        *[F.coalesce(F.sum(f"_t_{r}").over(earlier), F.lit(0)).alias(f"_o_{r}") for r in sums],
    )
    local = df.select("*", *[F.sum(c).over(within).alias(f"_w_{r}") for r, c in sums.items()])
    joined = local.join(offsets, [*by, bucket], "inner")
    return joined.select(
        *df.columns, *[(F.col(f"_w_{r}") + F.col(f"_o_{r}")).alias(r) for r in sums]
    )


# -- numbering distinct strings -----------------------------------------------------------------


def dense_codes(
    values: DataFrame, column: str, code: str, by: Sequence[str] = (), rows: int | None = None
) -> DataFrame:
    """0-based position of each distinct string within ``by``, in binary order.

    ``values`` must hold each (by, column) once; it is read several times, so pass a written
    table. Large tables are cut at bounds taken from a hash sample of the values.
    """
    n = values.count() if rows is None else rows
    if n <= SINGLE_BUCKET_ROWS:
        order = Window.partitionBy(*by).orderBy(column)
        return values.withColumn(code, F.row_number().over(order).cast("bigint") - 1)
    pieces = max(STRING_BOUNDS, min(MOST_STRING_BOUNDS, n // SINGLE_BUCKET_ROWS))
    sample = (
        values.select(F.col(column).alias("v"))
        .orderBy(F.xxhash64("v"), "v")
        .limit(16 * pieces)
        .agg(F.array_sort(F.collect_set("v")).alias("v"))
        .first()["v"]
    )
    step = max(1, len(sample) // pieces)
    bounds = F.array(*[F.lit(v) for v in sample[step::step]])
    cut = values.withColumn("_bucket", F.size(F.filter(bounds, lambda b: b <= F.col(column))))
    cut = materialise(cut, "codes").withColumn("_one", F.lit(1).cast("bigint"))
    ranked = running_sums(cut, column, {"_rank": "_one"}, "_bucket", by)
    return ranked.withColumn(code, F.col("_rank") - 1).drop("_bucket", "_one", "_rank")
