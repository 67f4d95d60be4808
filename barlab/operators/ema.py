"""Exponential moving averages as window sums, with no carry from block to block.

For a = 2 / (span + 1) and q = 1 - a the average is y_0 = x_0, y_t = q y_(t-1) + a x_t, which
unrolls to y_t = sum of a q^(t-j) x_j. Rows are cut into blocks; inside a block the sum is
q^k times a running sum of a x_j q^(-j), so it costs one pass.

A row without a value (NULL or NaN) has weight 0 and a NULL result; later averages divide by the
decayed weights of the values that are there, which is 1 as long as none is missing.

What precedes the block adds q^(k+1) times the previous block's last average. With blocks
long enough that q^rows is below MEMORY, that average needs only its own block's rows: all
older rows weigh less than the rounding of a double. The same bound is the lookback with
which a segment may start anywhere in a series.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlab.functions.checks import require_columns
from barlab.operators.series import Series, over_series

# Weight below which an old row cannot change a double.
MEMORY = 1e-18
# q^(-rows) must stay far from overflow.
_MAX_EXPONENT = 600.0


def _decay(span: int) -> float:
    return 1.0 - 2.0 / (span + 1.0)


def memory_rows(span: int) -> int:
    """Rows after which an earlier value is forgotten."""
    return math.ceil(math.log(MEMORY) / math.log(_decay(span))) if span > 1 else 1


def _fits_block(spans: list[int]) -> bool:
    rows = max(memory_rows(n) for n in spans)
    fastest = min(spans)
    return fastest == 1 or -rows * math.log(_decay(fastest)) <= _MAX_EXPONENT


def block_rows(spans: list[int]) -> int:
    """One block length that suits all spans."""
    if not _fits_block(spans):
        raise ValueError(f"spans {spans} differ too much to share a block; see share_blocks")
    return max(memory_rows(n) for n in spans)


def with_emas(s: Series, columns: dict[str, tuple[str, int]]) -> Series:
    """Add ``{output: (input, span)}`` to a series already cut by ``Series.blocked``.

    The expressions are SQL text: one call into the JVM each, where columns would take dozens.
    """
    keys = ", ".join(f"`{k}`" for k in s.keys)
    growing = f"OVER (PARTITION BY {keys}, _block ORDER BY _k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    order = ", ".join(f"`{c}`" for c in s.order)
    before = f"OVER (PARTITION BY {keys} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    value = {out: f"CASE WHEN NOT isnan(`{x}`) THEN CAST(`{x}` AS DOUBLE) END" for out, (x, _) in columns.items()}
    decay = {out: _decay(span) for out, (_, span) in columns.items() if span > 1}
    local, sums, carries, final = {}, {}, {}, {}
    for out, q in decay.items():
        # The first value of a series starts the average with the whole weight.
        first = f"_block = 0 AND count({value[out]}) {growing} = 1"
        weight = f"CASE WHEN {first} THEN 1D ELSE {1.0 - q!r}D END"
        local[f"_w_{out}"] = F.expr(f"CASE WHEN ({value[out]}) IS NOT NULL THEN {weight} ELSE 0D END")
        back, forth = f"_w_{out} * power({q!r}D, -_k)", f"power({q!r}D, _k)"
        total = f"sum(coalesce({value[out]}, 0D) * {back}) {growing} * {forth}"
        sums[f"_l_{out}"] = F.expr(f"named_struct('x', {total}, 'w', sum({back}) {growing} * {forth})")
        # Last local sums of the block before: the latest ones on a block's final row.
        ends = f"CASE WHEN _k = {s.block - 1} THEN _l_{out} END"
        carries[f"_c_{out}"] = F.expr(f"last({ends}, true) {before}")
    for out in columns:
        final[out] = F.expr(value[out])
        if out in decay:
            x, w = (
                f"(_l_{out}.{k} + power({decay[out]!r}D, _k + 1) * coalesce(_c_{out}.{k}, 0D))" for k in "xw"
            )
            final[out] = F.expr(f"CASE WHEN ({value[out]}) IS NOT NULL THEN {x} / {w} END")
    s = s.with_columns(local).with_columns(sums).with_columns(carries).with_columns(final)
    return s.drop(*local, *sums, *carries)


def blocked_for(s: Series, spans: list[int]) -> Series:
    """Cut a series into the blocks ``with_emas`` needs."""
    return s.blocked(block_rows(spans))


def share_blocks(spans: list[int]) -> list[list[int]]:
    """Group spans so that each group can share one block length."""
    groups: list[list[int]] = []
    for span in sorted(spans):
        if groups and _fits_block([*groups[-1], span]):
            groups[-1].append(span)
        else:
            groups.append([span])
    return groups


def with_macd(s: Series, fast: int = 12, slow: int = 26, signal: int = 9) -> Series:
    """MACD line, signal and histogram; the averages of both spans must be present."""
    s = s.with_columns({"macd_line": F.col(f"_ema_{fast}") - F.col(f"_ema_{slow}")})
    s = with_emas(s, {"macd_signal": ("macd_line", signal)})
    return s.with_columns({"macd_hist": F.col("macd_line") - F.col("macd_signal")})


MACD_SPANS = [12, 26, 9]


def macd_lookback(fast: int = 12, slow: int = 26, signal: int = 9) -> int:
    return memory_rows(max(fast, slow)) + memory_rows(signal)


# --- operators on bar tables -------------------------------------------------------------


def ema(bars: DataFrame, spans: tuple[int, ...] = (15, 50), x: str = "close", **layout):
    """Add ``ema_<span>``; NULL where the column has no value."""
    require_columns(bars, [x])
    out = bars
    for group in share_blocks(list(spans)):

        def build(s: Series, group: list[int] = group) -> Series:
            return with_emas(blocked_for(s, group), {f"ema_{n}": (x, n) for n in group})

        out = over_series(out, build, lookback=max(map(memory_rows, group)), **layout)
    return out


def macd(bars: DataFrame, **layout) -> DataFrame:
    require_columns(bars, ["close"])

    def build(s: Series) -> Series:
        s = with_emas(
            blocked_for(s, MACD_SPANS), {"_ema_12": ("close", 12), "_ema_26": ("close", 26)}
        )
        return with_macd(s).drop("_ema_12", "_ema_26")

    return over_series(bars, build, lookback=macd_lookback(), **layout)
