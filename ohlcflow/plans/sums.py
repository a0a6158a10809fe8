"""Trailing ROWS averages by differences of running sums.

Spark evaluates a sliding frame by adding up the frame again for every row:
7, 30 and 90 additions a row for the three price averages. Here a running sum
and a running count are kept instead and the frame is their difference at its
two edges: one addition and two subtractions a row for every frame, however
long, and all frames of a value share the running sums.

Running sums restart in every block of ``block_rows`` consecutive rows of a
series (with the ``n - 1`` rows before it as halo, dropped afterwards), which
keeps them small and so bounds the rounding error. With a block of m rows
(halo included) and values of absolute sum S in it, every average of c values
differs from the exact one by at most ``2 * m * 2**-53 * S / c``; where all
partial sums are exact doubles (prices on a binary grid, integer volumes) the
difference is 0. Values must be finite, as silver's are: an infinity would
spoil the differences of the rest of its block.

One exchange on the key serves the numbering and the blocks. ``segmented``
numbers the rows over range partitions instead (see :mod:`.skew`) and then
exchanges on (key, block), so that no task holds a whole series.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .skew import blocks_with_halo, series_row_number

DEFAULT_SUM_ROWS = 4096


def prefix_trailing_avg(
    df: DataFrame,
    specs: Mapping[str, tuple[str, int]],
    key: str = "symbol",
    order: str = "date",
    block_rows: int = DEFAULT_SUM_ROWS,
    segmented: bool = False,
    keep_number: bool = False,
) -> DataFrame:
    """Add ``out = avg(value) over the n-row trailing frame`` for each ``out -> (value, n)``.

    NULL values are left out of sum and count, as ``avg`` does; a frame
    without values is NULL. Rows of equal key and order are taken in any order.
    ``keep_number`` leaves the row's number in its series as ``_rn``.
    """
    if segmented:
        numbered = series_row_number(df, key, order)
    else:
        series = Window.partitionBy(key).orderBy(F.col(order).asc())
        numbered = df.withColumn("_rn", F.row_number().over(series))
    rows = blocks_with_halo(numbered, max(n for _, n in specs.values()), block_rows)
    block = Window.partitionBy(key, "_blk").orderBy("_rn")
    upto = block.rowsBetween(Window.unboundedPreceding, 0)
    values = list(dict.fromkeys(v for v, _ in specs.values()))
    rows = rows.withColumns(
        {
            **{f"_sum_{i}": F.coalesce(F.sum(F.col(v).cast("double")).over(upto), F.lit(0.0)) for i, v in enumerate(values)},
            **{f"_cnt_{i}": F.count(v).over(upto) for i, v in enumerate(values)},
        }
    )

    def edge_difference(column: str, n: int) -> Column:
        # no row n places back: the frame starts where the block's rows do
        return F.col(column) - F.coalesce(F.lag(column, n).over(block), F.lit(0))

    edges = {}
    for out, (value, n) in specs.items():
        i = values.index(value)
        edges[f"_s_{out}"], edges[f"_c_{out}"] = edge_difference(f"_sum_{i}", n), edge_difference(f"_cnt_{i}", n)
    rows = rows.withColumns(edges).filter(F.col("_shift") == 0)
    rows = rows.withColumns({out: F.when(F.col(f"_c_{out}") > 0, F.col(f"_s_{out}") / F.col(f"_c_{out}")) for out in specs})
    helpers = [f"_{kind}_{i}" for kind in ("sum", "cnt") for i in range(len(values))]
    return rows.drop("_shift", "_blk", *([] if keep_number else ["_rn"]), *helpers, *edges)
