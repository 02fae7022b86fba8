"""Sums of weights inside many time windows, without pairing movements with windows.

Windows of one length: time is cut into blocks of that length, so every window is the end of one block and the
beginning of the next. Running sums of each block, from its beginning and from its end, are taken once, and
every border of a window looks up the one that it falls on. Two numbers are added for a window, however many
movements it holds.

Windows of any lengths (``window_sums``): time is cut into aligned blocks of several sizes, each a multiple of the one before. A window is a few dozen
blocks; a movement lies in one block of each size. Movements are added up per block and windows add up their
blocks, so both meet on equal keys, and only blocks that some window needs are built.

Both ways nothing is subtracted, and a sum holds only what is inside its window: a NaN or a huge weight
elsewhere cannot touch it. The cost is that of movements plus windows, however many windows overlap, and a busy
zone is spread over time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonepulse.functions.plan import evaluate_once, spread
from zonepulse.functions.timeparts import epoch_micro
from zonepulse.schemas import MODES, Mode
from zonepulse.sources.scratch import broadcast_if_small, is_small, materialize

#: Block sizes for positions in seconds and in microseconds, up to about an hour.
SECOND_BLOCKS = (1, 16, 256, 4096)
MICRO_BLOCKS = (*[10**k for k in range(7)], *[n * 1_000_000 for n in SECOND_BLOCKS[1:]])


def _down(pos: Column, size: int) -> Column:
    return pos - F.pmod(pos, F.lit(size).cast("bigint"))


def _up(pos: Column, size: int) -> Column:
    return pos + F.pmod(-pos, F.lit(size).cast("bigint"))


def _run(size: int, a: Column, b: Column) -> Column:
    """The blocks of one size from ``a`` up to ``b`` (both aligned)."""
    starts = F.sequence(a, b - size, F.lit(size).cast("bigint"))
    blocks = F.transform(starts, lambda x: F.struct(F.lit(size).alias("size"), x.alias("block")))
    return F.when(a < b, blocks).otherwise(F.array().cast("array<struct<size:int,block:bigint>>"))


def window_blocks(spans: DataFrame, sizes: Sequence[int], low: str = "lo", high: str = "hi") -> DataFrame:
    """``spans`` with one row for each aligned block (``size``, ``block``) that its [low, high) is made of.

    From both ends, blocks grow from size to size until the next size does not fit any more.
    """
    # the range between the aligned borders of each size, worked out once per window
    named = evaluate_once(spans.withColumns({
        **{f"a{i}": _up(F.col(low), size) for i, size in enumerate(sizes)}, **{f"b{i}": _down(F.col(high), size) for i, size in enumerate(sizes)},
    }))
    fits, runs = [F.col(f"a{i}") <= F.col(f"b{i}") for i in range(len(sizes))], []
    for i, size in enumerate(sizes):
        a, b = F.col(f"a{i}"), F.col(f"b{i}")
        if i + 1 < len(sizes):
            larger = fits[i + 1]
            runs.append(_run(size, a, F.when(larger, F.col(f"a{i + 1}")).otherwise(b)))
            runs.append(_run(size, F.when(larger, F.col(f"b{i + 1}")).otherwise(b), b))
        else:
            runs.append(_run(size, a, b))
    return evaluate_once(named.select(*spans.columns, F.concat(*runs).alias("pieces"))).select(*spans.columns, F.inline("pieces"))


def window_sums(
    ticks: DataFrame,
    windows: DataFrame,
    keys: Sequence[str],
    weights: Sequence[str],
    sizes: int | Sequence[int],
    period: int | None = None,
) -> DataFrame:
    """Sum of each weight over ticks with ``lo <= pos < hi``; one row per distinct window.

    ``ticks``: keys, bigint ``pos``, weights. ``windows``: keys, bigint ``lo`` and ``hi`` (repeats
    allowed). ``sizes`` are the block sizes, ascending, each a multiple of the one before (one number: that
    size and 1). With ``period`` positions lie in [0, period) and a window may run over the end of the
    period, once. A window without ticks sums to 0.
    """
    keys, weights = list(keys), list(weights)
    sizes = (1, sizes) if isinstance(sizes, int) else tuple(sizes)
    kinds = {f.name: f.dataType for f in ticks.schema.fields}

    spans = windows.select(*keys, "lo", "hi").filter(F.col("lo") < F.col("hi")).dropna(subset=keys).distinct()
    if period:
        wrapped = F.col("hi") > period
        parts = spans.select(*keys, "lo", "hi", spread(
            ["from", "to"], [F.col("lo"), F.least(F.col("hi"), F.lit(period).cast("bigint"))], [F.lit(0).cast("bigint"), F.col("hi") - period],
            when=[None, wrapped],
        ))
    else:
        parts = spans.withColumns({"from": F.col("lo"), "to": F.col("hi")})
    pieces = window_blocks(parts, sizes, "from", "to").drop("from", "to")

    # the sizes that are needed near a tick: a short list for each key and each block of the largest size
    needed = pieces.groupBy(*keys, _down(F.col("block"), sizes[-1]).alias("near")).agg(F.collect_set("size").alias("sizes"))
    met = ticks.withColumn("near", _down(F.col("pos"), sizes[-1])).join(needed, [*keys, "near"])
    each = met.select(*keys, "pos", *weights, F.explode("sizes").alias("size"))
    block = F.col("pos") - F.pmod(F.col("pos"), F.col("size").cast("bigint"))
    totals = each.groupBy(*keys, "size", block.alias("block")).agg(*[F.sum(w).alias(w) for w in weights])
    # Spark may add a decimal digit to sums; the weights keep their own type
    return pieces.join(totals, [*keys, "size", "block"], "left").groupBy(*keys, "lo", "hi").agg(
        *[F.coalesce(F.sum(w), F.lit(0)).cast(_sum_type(kinds[w].simpleString())).alias(w) for w in weights])


def _sum_type(kind: str) -> str:
    return "double" if kind in ("double", "float") else "bigint" if kind in ("int", "bigint", "smallint", "tinyint") else kind


# -- windows of one length

_CELLS = 16  # look-ups of a block are dealt over so many keys
_TASK_ROWS = 1_000_000  # rows that a task sorts or groups, on average
_SECOND = 1_000_000


def _start_of(pos: Column, length: int) -> Column:
    return pos - F.pmod(pos, F.lit(length).cast("bigint"))


def window_borders(windows: DataFrame, length: int, period: int | None = None) -> DataFrame:
    """``windows`` with one row for each border to look up: ``kind``, ``at`` and ``block``.

    The window [lo, lo + length) is the end of lo's block from ``lo`` on, and the next block up to ``lo + length``.
    With ``period`` positions lie in [0, period), the last block may be shorter, and a window that runs over the
    end of the period goes on at 0.
    """
    lo, end = F.col("lo"), F.col("lo") + length
    own = _start_of(lo, length)
    after = own + length
    rows, when = [[F.lit("end"), lo, own]], [None]
    if period is None:
        rows.append([F.lit("begin"), end, after])
        when.append(end > after)
    else:
        last = F.lit(period).cast("bigint")
        rows += [[F.lit("begin"), F.least(end, last), after], [F.lit("begin"), end - last, F.lit(0).cast("bigint")]]
        when += [F.least(end, last) > after, end > last]
    return windows.select("*", spread(["kind", "at", "block"], *rows, when=when))


def _running_sums(ticks: DataFrame, groups: list[str], weights: list[str], length: int, period: int | None, tasks: int | None = None) -> DataFrame:
    """For each tick two rows: the borders ``since``..``until`` whose sum it completes, and that sum.

    ``kind`` 'end': all from the tick to the end of its block; 'begin': all from the beginning of the block to the tick.
    Ticks of one position are added up first, so a block has at most as many rows as positions.
    """
    blocks = ticks.withColumn("block", _start_of(F.col("pos"), length))
    blocks = blocks.repartition(tasks, *groups, "block") if tasks else blocks
    at_once = blocks.groupBy(*groups, "block", "pos").agg(*[F.sum(w).alias(w) for w in weights])
    block = Window.partitionBy(*groups, "block")
    up, down = block.orderBy("pos"), block.orderBy(F.desc("pos"))
    until_now = (Window.unboundedPreceding, Window.currentRow)
    edge = F.col("block") + length if period is None else F.least(F.col("block") + length, F.lit(period).cast("bigint"))
    known = at_once.select(
        *groups, "pos", "block",
        F.coalesce(F.lag("pos").over(up) + 1, F.col("block")).alias("since"), F.coalesce(F.lead("pos").over(up), edge).alias("until"),
        *[F.sum(w).over(up.rowsBetween(*until_now)).alias(f"begin_{w}") for w in weights],
        *[F.sum(w).over(down.rowsBetween(*until_now)).alias(f"end_{w}") for w in weights],
    )
    return known.select(*groups, spread(
        ["kind", "since", "until", *weights],
        [F.lit("end"), F.col("since"), F.col("pos"), *[F.col(f"end_{w}") for w in weights]],
        [F.lit("begin"), F.col("pos") + 1, F.col("until"), *[F.col(f"begin_{w}") for w in weights]],
    ))


def equal_window_sums(
    ticks: DataFrame, windows: DataFrame, keys: Sequence[str], weights: Sequence[str], length: int,
    period: int | None = None, by: Sequence[str] = (), small: bool = False, tasks: int | None = None,
) -> DataFrame:
    """Sums of ticks with ``lo <= pos < lo + length`` in parts: rows of ``windows`` with ``by`` and weights.

    ``ticks``: keys, ``by``, bigint ``pos``, weights. ``windows``: keys, bigint ``lo`` and any other columns; rows may
    repeat, each gets its own result. A window's sum over each value of ``by`` is the sum of its rows, at
    most three; where there is no tick there is no row. ``small`` says that the windows are few enough to broadcast,
    ``tasks`` says over how many tasks ticks and look-ups are dealt (default: as Spark finds by the bytes).
    """
    runs = _running_sums(ticks, [*keys, *by], list(weights), length, period, tasks)
    return _looked_up(runs, window_borders(windows, length, period), list(keys), list(weights), list(by), length, small, tasks)


def tasks_for(rows: int) -> int:
    """Tasks over which to deal ``rows``, so that what a task holds does not grow with them."""
    return max(1, -(-rows // _TASK_ROWS))


def _looked_up(
    runs: DataFrame, borders: DataFrame, keys: list[str], weights: list[str], by: list[str], length: int, small: bool, tasks: int | None = None
) -> DataFrame:
    size = max(1, length // _CELLS)
    cells = F.sequence(F.expr(f"since div {size}"), F.expr(f"until div {size}"))
    asked = borders.drop("block").withColumn("cell", F.expr(f"at div {size}"))
    known, on = runs.withColumn("cell", F.explode(cells)), [*keys, "kind", "cell"]
    if small:
        asked = F.broadcast(asked)
    elif tasks:
        known, asked = known.repartition(tasks, *on), asked.repartition(tasks, *on)
    met = known.join(asked, on)
    return met.filter("at BETWEEN since AND until").select(*[c for c in borders.columns if c not in ("kind", "at", "block")], *by, *weights)


def timed_window_sums(moves: DataFrame, windows: DataFrame, weights: Sequence[str], minutes: int) -> DataFrame:
    """Weights of the movements with ``t_lo <= t < t_lo + minutes``, in parts: rows of ``windows`` with weights.

    Positions are microseconds. Movements outside the blocks of all windows go before any shuffle if the list of
    blocks is small, else by a join on (direction, zone, block). The others are added up by whole
    seconds, but for seconds inside which a window begins or ends.
    """
    keys, length = ["direction", "zone_id"], minutes * 60 * _SECOND
    spans = windows.withColumn("lo", epoch_micro(F.col("t_lo"))).filter(F.col("lo").isNotNull() & F.col("zone_id").isNotNull())
    borders = window_borders(spans, length)
    needed = wanted_blocks(borders)
    ticks = moves.select(*keys, epoch_micro(F.col("t")).alias("pos"), *weights).withColumn("near", _start_of(F.col("pos"), length))
    ticks = ticks.join(broadcast_if_small(needed), [*keys, "near"])
    second = _start_of(F.col("pos"), _SECOND)
    ticks = ticks.withColumn("pos", F.when(F.array_contains("fine", second), F.col("pos")).otherwise(second))
    runs = _running_sums(ticks, keys, list(weights), length, None)
    return _looked_up(runs, borders, keys, list(weights), [], length, is_small(borders)).drop("lo")


def wanted_blocks(borders: DataFrame) -> DataFrame:
    """The blocks in which some window begins or ends, with the seconds that a border cuts (nearly always none); written, as they are counted too."""
    second = _start_of(F.col("at"), _SECOND)
    blocks = borders.groupBy("direction", "zone_id", F.col("block").alias("near")).agg(F.collect_set(F.when(second != F.col("at"), second)).alias("fine"))
    return materialize(blocks, "blocks")


def movements(
    trips: DataFrame, mode: Mode, weight: Column | None = None, columns: Sequence[str] | None = None
) -> DataFrame:
    """Two rows per trip: its departure ('out') and its arrival ('in'), with zone, time and weight.

    ``columns`` names the weight columns of the result; those of other modes are null. By default the
    only weight column is the mode's name.
    """
    amount = (F.col(mode.weight) if weight is None else weight).cast(mode.weight_type)
    sides = spread(
        ["direction", "zone_id", "t", "w"],
        [F.lit("out"), F.col(mode.start_zone).cast("int"), F.col(mode.start_time), amount],
        [F.lit("in"), F.col(mode.end_zone).cast("int"), F.col(mode.end_time), amount],
    )
    long = trips.select(sides).filter(F.col("zone_id").isNotNull() & F.col("t").isNotNull())
    return long.select("direction", "zone_id", "t", *weight_columns(mode, F.col("w"), columns))


def weight_columns(mode: Mode, amount: Column, columns: Sequence[str] | None = None) -> list[Column]:
    """The weight under its mode's name, and typed nulls for the other modes of ``columns``."""
    names = list(columns or [mode.name])
    return [(amount if n == mode.name else F.lit(None)).cast(MODES[n].weight_type).alias(n) for n in names]


def all_movements(tables: dict[Mode, DataFrame], weights: dict[str, Column] | None = None) -> DataFrame:
    """Movements of several modes in one frame, one weight column per mode; ``weights`` replaces a mode's own weight."""
    names = [m.name for m in tables]
    return reduce(DataFrame.unionByName, [movements(t, m, (weights or {}).get(m.name), names) for m, t in tables.items()])


def timeline_sums(moves: DataFrame, windows: DataFrame, weights: Sequence[str]) -> DataFrame:
    """Weights of the movements with ``t_lo <= t < t_hi``; rows (direction, zone_id, t_lo, t_hi, weights).

    Positions are microseconds, so borders and movements with a sub-second part are as exact as any other;
    blocks below a second are built only near windows that have such a border.
    """
    keys, weights = ["direction", "zone_id"], list(weights)
    spans = windows.select(*keys, "t_lo", "t_hi").dropna().distinct()
    spans = spans.withColumns({"lo": epoch_micro(F.col("t_lo")), "hi": epoch_micro(F.col("t_hi"))})
    ticks = moves.select(*keys, epoch_micro(F.col("t")).alias("pos"), *weights)
    sums = window_sums(ticks, spans, keys, weights, MICRO_BLOCKS)
    # windows are distinct by their times, which the positions stand for
    return spans.join(sums, [*keys, "lo", "hi"]).select(*keys, "t_lo", "t_hi", *weights)
