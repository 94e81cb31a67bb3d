"""Windows over series of any length without sorting a series as one piece.

``Window.partitionBy(series)`` would put a whole series into one task, and one
series may hold a third of all rows. Rows are therefore laid out in two steps.

1. *Positions.* Rows are cut into time chunks by a row expression. A row number
   inside its chunk plus the rows in earlier chunks (a cumulative sum over the
   small table of chunk sizes) is the row's position in its series. Running
   totals that start at the head of the series take the same route.
2. *Blocks.* ``block_rows`` consecutive positions form a block. The last
   ``behind`` rows of a block are copied into the next one and the first
   ``ahead`` rows into the previous one, so that a window over
   ``(series, block)`` sees every row that its frame reaches. Copies are
   dropped afterwards.

Exponential averages are computed inside a block as weighted prefix sums
(:func:`ema`), so they need no pass of their own.
"""

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.timeframes import epoch_seconds, seconds_of
from tidemark.schemas import SERIES
from tidemark.session import broadcast_if_small, scratch_dir

CHUNK_ROWS = 32768
BLOCK_ROWS = 32768

# Rows per summation segment of an exponential average. Spans 7 to 101 share it: the weights of
# span 7 stay below 1e263 and those of span 101 fade to 1e-18 within one segment.
SEGMENT_ROWS = 2100
_FADE = 41.5  # -ln(1e-18)
_GROWTH_LIMIT = 640.0  # ln(1e278)


@dataclass(frozen=True)
class Step:
    """One group of derived columns and the rows its frames reach.

    ``layers`` are dicts of SQL expressions by column name; a layer may use the
    columns of the layers before it. Steps run layer by layer together, so that
    all windows of one layer share a single pass over the block. ``carries`` names
    columns that hold the last known value of another column, from the head of the series on.
    ``holds`` maps result columns to a column of the layers whose last known value in the series they
    hold, however far back it lies, and to a column with the value before the first row (or None).
    """

    adds: tuple
    layers: tuple
    behind: int = 0
    ahead: int = 0
    totals: dict = field(default_factory=dict)
    firsts: dict = field(default_factory=dict)
    carries: dict = field(default_factory=dict)
    holds: dict = field(default_factory=dict)


def with_position(
    df: DataFrame,
    keys=SERIES,
    time: str = "time",
    totals: dict | None = None,
    firsts: dict | None = None,
    carries: dict | None = None,
    with_length: bool = False,
    chunk_rows: int = CHUNK_ROWS,
    then=(),
) -> DataFrame:
    """Add ``_pos``, the 0-based position of each row in its series by ``time``.

    ``totals`` maps new names to expressions summed from the head of the series
    to the row; ``firsts`` maps new names to expressions read at the first row;
    ``carries`` maps new names to columns whose last known value (neither NULL nor NaN) up to the row
    they hold, NULL before the first; ``with_length`` adds ``_length``, the rows of the series. Equal times are
    put in the order of the columns ``then``.
    Rows without a key or time are left out.
    """
    keys, totals, firsts, carries = list(keys), totals or {}, firsts or {}, carries or {}
    numbers = {f.name for f in df.schema if f.dataType.typeName() in ("double", "float")}
    there = {n: F.when(~F.isnan(c), F.col(c)) if c in numbers else F.col(c) for n, c in carries.items()}
    bar = seconds_of(F.col("timeframe")) if "timeframe" in df.columns else F.lit(3600)
    chunk_seconds = bar.cast("long") * chunk_rows
    chunked = df.withColumn("_chunk", F.floor(epoch_seconds(F.col(time)) / chunk_seconds))

    sizes = chunked.groupBy(*keys, "_chunk").agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.sum(e).alias(n) for n, e in totals.items()],
        *[F.min_by(e, time).alias(n) for n, e in firsts.items()],
        *[F.max_by(e, F.when(e.isNotNull(), F.col(time))).alias(n) for n, e in there.items()],
    )
    series = W.partitionBy(*keys).orderBy("_chunk")
    before = series.rowsBetween(W.unboundedPreceding, -1)
    so_far = series.rowsBetween(W.unboundedPreceding, 0)
    starts = sizes.select(
        *keys,
        "_chunk",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"),
        *[F.coalesce(F.sum(n).over(before), F.lit(0.0)).alias(f"_before{n}") for n in totals],
        *[F.first(n).over(so_far).alias(n) for n in firsts],
        *[F.last(n, ignorenulls=True).over(before).alias(f"_before{n}") for n in carries],
        *([F.sum("_rows").over(W.partitionBy(*keys)).alias("_length")] if with_length else []),
    )
    in_chunk = W.partitionBy(*keys, "_chunk").orderBy(time, *then)
    running = in_chunk.rowsBetween(W.unboundedPreceding, 0)
    numbered = chunked.withColumns(
        {
            "_local": F.row_number().over(in_chunk) - 1,
            **{n: F.sum(e).over(running) for n, e in totals.items()},
            **{n: F.last(e, ignorenulls=True).over(running) for n, e in there.items()},
        }
    )
    placed = numbered.join(starts, [*keys, "_chunk"])
    return placed.withColumns(
        {
            "_pos": F.col("_start") + F.col("_local"),
            **{n: F.col(n) + F.col(f"_before{n}") for n in totals},
            **{n: F.coalesce(n, f"_before{n}") for n in carries},
        }
    ).drop("_chunk", "_start", "_local", *[f"_before{n}" for n in (*totals, *carries)])


def in_blocks(df: DataFrame, behind=0, ahead=0, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Give positioned rows a ``_block`` and copy the rows that neighbours reach."""
    size = max(block_rows, behind, ahead)
    own, offset = F.floor(F.col("_pos") / size), F.col("_pos") % size
    lowest = own - F.when((offset < ahead) & (own > 0), 1).otherwise(0)
    highest = own + F.when(offset >= size - behind, 1).otherwise(0)
    return (
        df.withColumn("_block", F.explode(F.sequence(lowest, highest)))
        .withColumn("_own", F.col("_block") == own)
        .withColumn("_segment", F.floor(F.col("_pos") / SEGMENT_ROWS))
    )


RUNNING = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


def over_block(frame: str = "", keys=SERIES) -> str:
    """OVER clause: the rows of a block in series order.

    A segment is a run of positions, so ordering by it first changes nothing
    but lets the windows of ``ema`` share the sort.
    """
    return f"OVER (PARTITION BY {', '.join(keys)}, _block ORDER BY _segment, _pos {frame})"


def trailing(rows: int) -> str:
    return f"ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW"


def double(x: float) -> str:
    return f"{x!r}D"


def with_held(out: DataFrame, holds: dict, keys=SERIES) -> DataFrame:
    """Add ``{name: (column, seed)}``: the last known value of ``column`` among the rows of the series up to this one.

    Only own rows count, as copied rows lack the history before them. What earlier blocks hold comes
    from a table of one row per block, written first by a pass over the columns that ``holds`` needs, so that the
    plan of the result has one layout only.
    """
    known = {n: F.when(F.col("_own"), F.col(c)) for n, (c, _) in holds.items()}
    ends = out.groupBy(*keys, "_block").agg(
        *[F.max_by(e, F.when(e.isNotNull(), F.col("_pos"))).alias(f"_before_{n}") for n, e in known.items()]
    )
    before = W.partitionBy(*keys).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    starts = ends.select(
        *keys, "_block", *[F.last(f"_before_{n}", ignorenulls=True).over(before).alias(f"_before_{n}") for n in holds]
    )
    spark = out.sparkSession
    path = scratch_dir(spark, "ends")
    starts.write.parquet(path)
    starts = broadcast_if_small(spark.read.schema(starts.schema).parquet(path))
    within = {
        n: f"last(CASE WHEN _own THEN {c} END, true) {over_block(RUNNING, keys)}" for n, (c, _) in holds.items()
    }
    out = out.selectExpr("*", *[f"{e} AS _within_{n}" for n, e in within.items()]).join(starts, [*keys, "_block"], "left")
    seeds = {n: [seed] if seed else [] for n, (_, seed) in holds.items()}
    return out.withColumns({n: F.coalesce(f"_within_{n}", f"_before_{n}", *seeds[n]) for n in holds})


def run(
    df: DataFrame,
    steps,
    keys=SERIES,
    time: str = "time",
    chunk_rows: int = CHUNK_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Lay the series out once, apply all steps, and return the input columns plus theirs."""
    totals = {n: e for s in steps for n, e in s.totals.items()}
    firsts = {n: e for s in steps for n, e in s.firsts.items()}
    carries = {n: e for s in steps for n, e in s.carries.items()}
    adds = [n for s in steps for n in s.adds]
    kept = [c for c in df.columns if c not in adds]
    numbers = {f.name for f in df.schema if f.dataType.typeName() in ("double", "float")}
    # NaN counts as missing.
    df = df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if c in numbers else c for c in kept])
    out = with_position(df, keys, time, totals, firsts, carries, chunk_rows=chunk_rows)
    out = in_blocks(
        out, max(s.behind for s in steps), max(s.ahead for s in steps), block_rows
    )
    made = set()
    for level in range(max(len(s.layers) for s in steps)):
        layer = {n: e for s in steps if level < len(s.layers) for n, e in s.layers[level].items()}
        # Steps may share helper columns: the same name stands for the same expression.
        new = {n: e for n, e in layer.items() if n not in made}
        if new:
            out = out.selectExpr("*", *[f"{e} AS {n}" for n, e in new.items()])
        made.update(new)
    holds = {n: e for s in steps for n, e in s.holds.items()}
    if holds:
        out = with_held(out, holds, keys)
    return out.where("_own").select(*kept, *adds)


def rolling(column: str, means=None, deviations=None, extremes=None, keys=SERIES) -> tuple:
    """Three layers with strict trailing windows of ``column``: NULL unless every row holds a value.

    ``means`` and ``deviations`` (sample) map names to rows; ``extremes`` maps
    names to ("min" or "max", rows). A frame costs its length per row, so a long
    window is merged from equal parts: its sum is the sum of its parts, and its
    squared deviations are those inside the parts plus those of the part means.
    Parts are plain short frames, so nothing cancels.
    """
    gap = f"_gap_{column}"
    parts = {
        gap: f"last(CASE WHEN {column} IS NULL THEN _pos END, true) {over_block(RUNNING, keys)}"
    }
    merged, done = {}, {}

    def part(fn, rows):
        name = f"_{fn}_{column}_{rows}"
        parts[name] = f"{fn}({column}) {over_block(trailing(rows), keys)}"
        return name

    def earlier(name, rows, count):
        return [name] + [
            f"lag({name}, {i * rows}) {over_block(keys=keys)}" for i in range(1, count)
        ]

    def where_full(rows, value):
        return (
            f"CASE WHEN _pos >= {rows - 1} AND ({gap} IS NULL OR _pos - {gap} >= {rows}) "
            f"THEN {value} END"
        )

    for name, rows in (means or {}).items():
        size = _part_rows(rows)
        sums = earlier(part("sum", size), size, rows // size)
        merged[f"_of_{name}"] = f"({' + '.join(sums)}) / {rows}"
        done[name] = where_full(rows, f"_of_{name}")
    for name, rows in (deviations or {}).items():
        size = _part_rows(rows)
        count = rows // size
        total = part("sum", size)
        sums = [f"{total}_{i}" for i in range(count)]
        merged.update(zip(sums, earlier(total, size, count)))
        inside = earlier(part("var_pop", size), size, count)
        merged[f"_of_{name}"] = " + ".join(inside)
        center = f"({' + '.join(sums)}) / {rows}"
        between = " + ".join(f"power({m} / {size} - {center}, 2)" for m in sums)
        squares = f"(_of_{name} + {between}) * {size}"
        done[name] = where_full(rows, f"sqrt({squares} / {rows - 1})") if rows > 1 else "NULL"
    for name, (fn, rows) in (extremes or {}).items():
        size = _part_rows(rows)
        values = earlier(part(fn, size), size, rows // size)
        merge = {"min": "least", "max": "greatest"}[fn]
        merged[f"_of_{name}"] = values[0] if len(values) == 1 else f"{merge}({', '.join(values)})"
        done[name] = where_full(rows, f"_of_{name}")
    return parts, merged, done


def _part_rows(rows: int) -> int:
    """The largest divisor up to 11, or the whole window where there is none."""
    return next((d for d in range(min(rows, 11), 1, -1) if rows % d == 0), rows)


def _decay(span: int) -> float:
    return 1.0 - 2.0 / (span + 1.0)


def _segment_rows(span: int) -> int:
    rate = -math.log(_decay(span))
    if SEGMENT_ROWS * rate >= _FADE and SEGMENT_ROWS * rate <= _GROWTH_LIMIT:
        return SEGMENT_ROWS
    return math.ceil(_FADE / rate)


def ema_reach(span: int) -> int:
    """Rows after which an old value weighs less than 1e-18, below double precision."""
    return 1 if span <= 1 else math.ceil(_FADE / -math.log(_decay(span)))


def twice_averaged(of_span: str, of_signal: str, span: int, signal: int) -> str:
    """The ``signal`` average of the ``span`` average, from the two averages of the same input.

    The product of two different geometric filters is a weighted difference of both.
    """
    a, b = 2.0 / (span + 1), 2.0 / (signal + 1)
    return (
        f"({of_span} * {double(b * (1 - a) / (b - a))} - {of_signal} * {double(a * (1 - b) / (b - a))})"
    )


def ema(averages: dict, keys=SERIES, seeds: dict | None = None, started: str | None = None) -> tuple:
    """Four layers that add ``e_t = a*x_t + (1-a)*e_{t-1}``, ``e_0 = x_0``, for ``{name: (x, span)}``.

    ``seeds`` maps names to columns with the value before the first row, NULL
    where there is none. ``x`` must hold a value in every row, or with ``started``, a column, in every
    row from the first one on in which that column holds a value. Inside a segment
    of positions the average is ``q**j * sum(u_i / q**i)``; what came earlier
    enters through the last value of the previous segment, older ones have
    faded out.
    """
    decays, inner, ends, values = {}, {}, {}, {}
    begins = "_pos = 0"
    if started:
        # At the head of a block's copied rows this is wrong and without weight.
        decays[f"_start_{started}"] = f"lag({started}) {over_block(keys=keys)}"
        begins = f"_pos = 0 OR _start_{started} IS NULL"
    for name, (x, span) in averages.items():
        x = f"CAST({x} AS DOUBLE)"
        if span <= 1:
            values[name] = x
            continue
        q = _decay(span)
        rows = _segment_rows(span)
        segment = "_segment" if rows == SEGMENT_ROWS else f"_pos DIV {rows}"
        here = f"OVER (PARTITION BY {', '.join(keys)}, _block, {segment} ORDER BY _pos {RUNNING})"
        local, end, decay = f"_in_{name}", f"_end_{name}", f"_decay_{span}"
        weighted = f"{x} * {double(1.0 - q)}"
        first = f"coalesce({weighted} + {seeds[name]} * {double(q)}, {x})" if seeds else x
        entry = f"CASE WHEN {begins} THEN {first} ELSE {weighted} END"
        decays[decay] = f"power({double(q)}, _pos % {rows})"
        inner[local] = f"{decay} * sum(({entry}) / {decay}) {here}"
        at_end = f"CASE WHEN _pos % {rows} = {rows - 1} THEN {local} END"
        ends[end] = f"last({at_end}, true) {over_block(BEFORE, keys)}"
        values[name] = f"{local} + coalesce({end}, 0D) * {decay} * {double(q)}"
    return decays, inner, ends, values
