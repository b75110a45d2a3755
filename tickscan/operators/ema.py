"""Exponential moving averages over bars, and the crossover rule, as a distributed scan.

The EMA of span ``s`` steps once per non-empty bar: ``e_n = a*p_n + (1-a)*e_{n-1}``,
``a = 2/(s+1)``, ``e_0 = seed`` (0 by default). Every step is an affine map ``e -> d*e + b`` with
``d = 1-a``, and affine maps compose, so the recurrence is a prefix scan that needs no single task
to see a symbol's whole history:

* **level 0** - bars are grouped into blocks of ``2**bits`` consecutive window indices and each block
  is collected once as a sorted array, keyed by ``(symbol, block)``: the one shuffle of the bars. A
  block's summary is its bar count and its EMA started from 0.
* **levels 1..L** - block summaries ``(count, value)`` are folded per parent group of at most
  ``2**bits`` children (sorted array + ``aggregate``), giving each child the composition of the
  children before it; the top level folds the few remaining nodes of a symbol.
* **descent** - each node's incoming value is ``d**(count before) * parent_in + value before``,
  joined down level by level;
* **bars** - inside a block the recurrence ``e = a*p + (1-a)*e`` is stepped bar by bar, in order, from
  the block's incoming value: the reference's own formula, so that rounding does not depend on a
  bar's place in its block. (A closed form per bar makes the sign of the difference of two converged
  EMAs noise, and a flat price then gives false crossovers.)

So a symbol that holds a third of all bars is spread over its ``n/64`` blocks, every shuffle is
keyed by ``(symbol, block)``, and no group at any level exceeds 64 members. The level count grows
with ``log64`` of the history length in windows.

The previous bar's EMAs (needed by the crossover rule) are the values of the same sequence: a block's
first bar has the block's incoming value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import BUY, DEFAULT_SPANS, SELL
from ..session import write_and_read

BLOCK_BITS = 6


def alpha(span: float) -> float:
    return 2.0 / (span + 1.0)


def ema_col(span) -> str:
    return f"ema{span}"


def levels_for(w_min: int | None, w_max: int | None, bits: int = BLOCK_BITS) -> int:
    """Number of fold levels so that the top level holds at most ``2**bits`` nodes per symbol."""
    if w_min is None or w_max is None:
        return 1
    lv = 1
    while (w_max >> (bits * lv)) - (w_min >> (bits * lv)) >= (1 << bits):
        lv += 1
    return lv


def _d(x: float) -> str:
    """A double literal in SQL text."""
    return f"{float(x)!r}D"


def _fold(nodes: DataFrame, group_cols: list[str], child: str, spans,
          with_children: bool = True) -> tuple[DataFrame | None, DataFrame]:
    """Fold the children of each group in child order.

    ``nodes`` has ``group_cols, child, _cnt, _b<span>...`` (a child's bar count and its composed value
    from 0). Returns (per-child exclusive prefix ``_cb, _bb<span>``, per-group ``_cnt, _b<span>``).
    Expressions are SQL text: one driver round trip each, instead of one per expression node.
    """
    bcols = [f"_b{s}" for s in spans]
    elem = "struct(" + ", ".join([f"{child} AS c", "_cnt AS n"] + [f"{b} AS {b}" for b in bcols]) + ")"
    out_type = "array<struct<c:bigint,cb:bigint," + ",".join(f"{b}:double" for b in bcols) + ">>"
    zero = ("named_struct('n', CAST(0 AS BIGINT), " + ", ".join(f"'{b}', 0.0D" for b in bcols)
            + f", 'out', CAST(array() AS {out_type}))")
    nxt = ", ".join(f"'{b}', acc.{b} * pow({_d(1.0 - alpha(s))}, CAST(x.n AS DOUBLE)) + x.{b}"
                    for b, s in zip(bcols, spans))
    done = "named_struct('c', CAST(x.c AS BIGINT), 'cb', acc.n, " + ", ".join(f"'{b}', acc.{b}" for b in bcols) + ")"
    out = f"concat(acc.out, array({done}))" if with_children else "acc.out"
    step = f"(acc, x) -> named_struct('n', acc.n + x.n, {nxt}, 'out', {out})"
    folded = nodes.groupBy(*group_cols).agg(
        F.expr(f"aggregate(array_sort(collect_list({elem})), {zero}, {step})").alias("_f"))
    groups = folded.selectExpr(*group_cols, "_f.n AS _cnt", *[f"_f.{b} AS {b}" for b in bcols])
    if not with_children:
        return None, groups
    children = (folded.selectExpr(*group_cols, "inline(_f.out)")
                      .selectExpr(*group_cols, f"c AS {child}", "cb AS _cb",
                                  *[f"{b} AS _bb{s}" for b, s in zip(bcols, spans)]))
    return children, groups


def blocks_of(bars: DataFrame, key: str = "symbol", order: str = "w", bits: int = BLOCK_BITS) -> DataFrame:
    """``key, _g1, _bars``: the bars of each block as one array sorted by ``order``."""
    rest = [c for c in bars.columns if c not in (key, order)]
    elem = "struct(" + ", ".join([f"`{order}` AS _o"] + [f"`{c}`" for c in rest]) + ")"
    return (bars.selectExpr(f"`{key}`", f"shiftright(`{order}`, {bits}) AS _g1", f"{elem} AS _bar")
                .groupBy(key, "_g1").agg(F.array_sort(F.collect_list("_bar")).alias("_bars")))


def ema(bars: DataFrame, spans=DEFAULT_SPANS, key: str = "symbol", order: str = "w",
        price: str = "close", seed: float | str = 0.0, levels: int | None = None,
        bits: int = BLOCK_BITS, with_previous: bool = False, with_position: bool = False,
        materialize: bool = False) -> DataFrame:
    """Add ``ema<span>`` columns (and ``prev_ema<span>`` / ``bar_no`` if asked) to ``bars``.

    ``order`` must be a long that is unique per ``key`` and increases with time (the window index
    ``w`` of :func:`bars`). ``materialize`` writes the blocks once to the shared folder, so that the
    upward fold and the final pass both read them. ``levels`` is derived from the range of the blocks
    when not given (one small aggregate job). ``seed`` is the value before the first bar: a number (0
    as in the reference) or ``"first_close"`` (each symbol starts from its first close, a per-symbol
    aggregate joined at the top level). ``bar_no`` is the 1-based position of the bar in its symbol's
    history, carried down the levels from the fold counts.
    """
    spans = list(spans)
    blocks = blocks_of(bars, key, order, bits)
    if materialize:
        blocks = write_and_read(blocks, "bar-blocks")
    if levels is None:
        r = blocks.agg(F.min("_g1").alias("lo"), F.max("_g1").alias("hi")).first()
        levels = levels_for(r["lo"] << bits, r["hi"] << bits, bits) if r["lo"] is not None else 1
    g = [f"_g{i}" for i in range(levels + 1)]  # _g1 = block; _g<l+1> = parent of _g<l>
    ds = {s: 1.0 - alpha(s) for s in spans}
    px = f"CAST(x.`{price}` AS DOUBLE)"

    def stepped(acc: str, s) -> str:
        return f"{px} * {_d(alpha(s))} + {acc} * {_d(ds[s])}"

    # ---- level 1..L: block summaries folded upward ----------------------------------------------
    zero = "named_struct(" + ", ".join(f"'e{s}', 0.0D" for s in spans) + ")"
    local = "named_struct(" + ", ".join(f"'e{s}', {stepped(f'acc.e{s}', s)}" for s in spans) + ")"
    nodes = blocks.selectExpr(f"`{key}`", "_g1", "CAST(size(_bars) AS BIGINT) AS _cnt",
                              f"aggregate(_bars, {zero}, (acc, x) -> {local}) AS _e")
    nodes = nodes.selectExpr(f"`{key}`", "_g1", "_cnt", *[f"_e.e{s} AS _b{s}" for s in spans])
    prefixes = []  # per level l (1..L): child prefix table keyed by (key, g[l]) with parent g[l+1]
    for lv in range(1, levels):
        nodes = nodes.selectExpr("*", f"shiftright({g[lv]}, {bits}) AS {g[lv + 1]}")
        children, nodes = _fold(nodes, [key, g[lv + 1]], g[lv], spans)
        prefixes.append((lv, children))
    top_children, _ = _fold(nodes, [key], g[levels], spans)
    if seed == "first_close":
        first = blocks.selectExpr(f"`{key}`", "_g1", f"_bars[0].`{price}` AS _p")
        seeds = first.groupBy(key).agg(F.min_by("_p", "_g1").cast("double").alias("_seed"))
        top_children = top_children.join(seeds, key)
        seed_sql = "_seed"
    else:
        seed_sql = _d(float(seed))

    # incoming value of each node: the value before its parent pushed through the nodes before it,
    # and the number of bars before it (``_nin``)
    def incoming(parent_in: bool) -> list[str]:
        vals = [f"pow({_d(ds[s])}, CAST(_cb AS DOUBLE)) * {f'_in{s}' if parent_in else seed_sql} + _bb{s} AS _in{s}"
                for s in spans]
        return vals + [("_nin + _cb" if parent_in else "_cb") + " AS _nin"]

    level_in = top_children.selectExpr(key, g[levels], *incoming(False))
    for lv, children in reversed(prefixes):
        level_in = children.join(level_in, [key, g[lv + 1]]).selectExpr(key, g[lv], *incoming(True))

    # ---- bars: the recurrence in order from the block's incoming value -----------------------------
    rest = [c for c in bars.columns if c not in (key, order)]
    state = [("n", "_nin")] + [(f"e{s}", f"_in{s}") for s in spans]
    row = ", ".join(["x AS bar", "acc.n + 1 AS n"] + [f"acc.e{s} AS p{s}" for s in spans])

    def value(s) -> str:
        # with a first-close seed the first bar's EMA is exactly the close
        return (f"CASE WHEN acc.n = 0 THEN {px} ELSE {stepped(f'acc.e{s}', s)} END" if seed == "first_close"
                else stepped(f"acc.e{s}", s))

    new = ", ".join(f"{value(s)} AS e{s}" for s in spans)
    bar_type = blocks.schema["_bars"].dataType.elementType.simpleString()
    out_type = ("array<struct<bar:" + bar_type + ",n:bigint," + ",".join(f"p{s}:double" for s in spans) + ","
                + ",".join(f"e{s}:double" for s in spans) + ">>")
    start = "named_struct(" + ", ".join(f"'{n}', {v}" for n, v in state) + f", 'out', CAST(array() AS {out_type}))"
    done = f"struct({row}, {new})"
    step = ("named_struct('n', acc.n + 1, " + ", ".join(f"'e{s}', {value(s)}" for s in spans)
            + f", 'out', concat(acc.out, array({done})))")
    run = (blocks.join(level_in, [key, "_g1"])
                 .selectExpr(f"`{key}`", f"inline(aggregate(_bars, {start}, (acc, x) -> {step}, acc -> acc.out))"))
    added = [f"e{s} AS {ema_col(s)}" for s in spans]
    if with_previous:
        added += [f"p{s} AS prev_{ema_col(s)}" for s in spans]
    if with_position:
        added.append("n AS bar_no")
    names = {order: "bar._o"} | {c: f"bar.`{c}`" for c in rest}
    return run.selectExpr(*[f"`{c}`" if c == key else f"{names[c]} AS `{c}`" for c in bars.columns], *added)


def crossovers(emas: DataFrame, fast: str = "ema38", slow: str = "ema100",
               prev_fast: str = "prev_ema38", prev_slow: str = "prev_ema100", min_bars: int = 0) -> DataFrame:
    """Buy when the fast EMA rises above the slow one, sell when it falls below.

    ``Buy!``: ``fast > slow`` now and ``fast <= slow`` on the previous bar; ``Sell!``: ``fast < slow``
    now and ``fast >= slow`` before. The previous values of a symbol's first bar are 0.
    A row-wise filter over :func:`ema` output made ``with_previous=True``; no shuffle. With
    ``min_bars`` (needs ``with_position=True``) advisories start at the ``min_bars``-th bar.
    """
    f, s_, pf, ps = (F.col(c) for c in (fast, slow, prev_fast, prev_slow))
    pf, ps = F.coalesce(pf, F.lit(0.0)), F.coalesce(ps, F.lit(0.0))
    msg = F.when((f > s_) & (pf <= ps), F.lit(BUY)).when((f < s_) & (pf >= ps), F.lit(SELL))
    out = emas.withColumn("message", msg).where(F.col("message").isNotNull())
    return out.where(F.col("bar_no") >= min_bars) if min_bars else out
