"""Mixing sources to target weights by temperature, in DataFrame functions alone.

Token shares ``p`` of the sources become weights in proportion to ``p ** a``. The
exponent ``a`` between 0 (all sources alike) and 1 (as they are) is found by
bisection: the largest that reaches a target entropy, or the smallest that keeps
the repetitions of every source within a limit. The weights are then realised in
passes over blocks of documents, in another order of the blocks in each pass;
the last pass of a source stops where its budget of tokens ends.

Tokens are words (stretches without white space). Null and empty texts have none;
a source of such texts alone is passed once. A null source is a source like any
other. Repeated rows are drawn one by one, but if a budget ends among rows with one id
and text, the last pass repeats one of them; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.session import checkpointed

BLOCKS = 4096
REPETITIONS = 2.0
# A plan of up to so many sources (a row of some 100 bytes each) is broadcast.
BROADCAST_SOURCES = 100_000
# Exponents tried at once, rounds of trials, and decimals of the result.
_GRID, _ROUNDS, _DECIMALS = 31, 6, 6
# Odd, so that multiplying permutes the blocks; and a shift from pass to pass.
_MULTIPLIER, _SHIFT = 1597, 2039


def tokens_of(text: Column) -> Column:
    counted = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    return F.coalesce(counted, F.lit(0)).cast("bigint")


def _slot(block: Column, turn: Column) -> Column:
    """Place of a block in the order of one pass."""
    return F.pmod(block * _MULTIPLIER + turn * _SHIFT, F.lit(BLOCKS)).cast("int")


def sized(docs: DataFrame, seed: str) -> DataFrame:
    """``row`` (the input row) with source, tokens, hashed order and block."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    # the text too, so that rows which share an id (or have none) are in many blocks
    spread = F.md5(F.concat(F.lit(f"{seed}:"), name, F.lit(":"), F.coalesce(F.md5("text"), F.lit("-"))))
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col("source").alias("source"),
        tokens_of(F.col("text")).alias("tokens"),
        spread.alias("spread"),
    )
    block = F.conv(F.substring("spread", 1, 8), 16, 10).cast("bigint") % BLOCKS
    return rows.withColumn("block", block.cast("int"))


def exponent(
    sources: DataFrame, repetitions: float | None, entropy: float | None, budget: int | None
) -> float:
    """The exponent by bisection, on sums over the sources for several trials at once.

    ``entropy`` is a share of the highest possible one. Without a budget every
    source is seen whole at least once, so its repetitions follow from its share
    and the largest. Where no exponent will do, the nearest end is taken.
    """
    some = sources.filter("total > 0")
    whole = some.agg(F.sum("total")).first()[0]
    if not whole:
        return 1.0
    known = some.select((F.col("total") / whole).alias("p"))
    low, high = 0.0, 1.0
    for _ in range(_ROUNDS):
        trials = [low + (high - low) * (i + 1) / (_GRID + 1) for i in range(_GRID)]
        ends = [0.0] if low == 0 else []
        sums = known.agg(
            F.count("p").alias("n"),
            F.max("p").alias("most"),
            F.min("p").alias("least"),
            *[F.sum(F.pow("p", F.lit(a))).alias(f"z{i}") for i, a in enumerate(ends + trials)],
            *[
                F.sum(F.pow("p", F.lit(a)) * F.log("p")).alias(f"s{i}")
                for i, a in enumerate(ends + trials)
            ],
        ).first()

        def fits(i: int, a: float, sums=sums) -> bool:
            """Whether the weights at this exponent are flat enough (entropy) or steep enough."""
            z = sums[f"z{i}"]
            if entropy is not None:
                return math.log(z) - a * sums[f"s{i}"] / z >= entropy * math.log(sums.n)
            passes = sums.most ** (1 - a) * z if budget is None else budget / whole
            return passes * sums.least ** (a - 1) / z <= repetitions

        tried = [(a, fits(i, a)) for i, a in enumerate(ends + trials)]
        if entropy is not None:
            # flat enough up to some exponent
            good = [a for a, ok in tried if ok]
            if not good and low == 0:
                return 0.0
            above = [a for a, ok in tried if not ok]
            low, high = max([low, *good]), min([high, *above])
        else:
            # steep enough from some exponent on
            good = [a for a, ok in tried if ok]
            if good and good[0] == 0.0:
                return 0.0
            below = [a for a, ok in tried if not ok]
            low, high = max([low, *below]), min([high, *good])
    return round((low + high) / 2, _DECIMALS)


def plan(
    rows: DataFrame, repetitions: float | None, entropy: float | None, budget: int | None
) -> DataFrame:
    """One row per source: whole ``passes``, and the block at which the last, partial pass ends.

    ``cut`` is the place of that block in the pass, ``left`` the tokens it still takes.
    """
    blocks = checkpointed(
        rows.groupBy("source", "block").agg(F.sum("tokens").alias("tokens"))
    )
    sources = blocks.groupBy("source").agg(F.sum("tokens").alias("total"))
    a = exponent(sources, repetitions, entropy, budget)
    largest = sources.agg(F.max("total")).first()[0] or 0
    turns = F.pow(F.lit(largest) / F.col("total"), F.lit(1 - a))
    raised = sources.withColumn("turns", F.when(F.col("total") > 0, turns).otherwise(1.0))
    if budget is not None:
        spent = raised.agg(F.sum(F.col("turns") * F.col("total"))).first()[0]
        scaled = F.col("turns") * budget / spent if spent else F.lit(1.0)
        raised = raised.withColumn("turns", F.when(F.col("total") > 0, scaled).otherwise(1.0))
    passes = F.floor("turns").cast("bigint")
    budgeted = raised.select(
        F.col("source").alias("of"),
        passes.alias("passes"),
        ((F.col("turns") - passes) * F.col("total")).alias("rest"),
    )
    same = F.col("source").eqNullSafe(F.col("of"))
    placed = blocks.join(budgeted, same).withColumn("slot", _slot(F.col("block"), F.col("passes")))
    # at most BLOCKS rows per source
    order = Window.partitionBy("of").orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
    upto = placed.withColumn("upto", F.sum("tokens").over(order))
    whole = F.col("upto") <= F.col("rest")
    return upto.groupBy("of", "passes").agg(
        F.coalesce(F.min(F.when(~whole, F.col("slot"))), F.lit(BLOCKS)).alias("cut"),
        (F.first("rest") - F.coalesce(F.max(F.when(whole, F.col("upto"))), F.lit(0))).alias("left"),
    )


def _edge(rows: DataFrame) -> DataFrame:
    """Rows of the blocks in which budgets end, with the passes that draw them: ``times``, from
    ``since`` on.

    Equal rows (of one spread) are counted first, and running sums go by stretches of the spread and
    then inside one, over counts alone, so no task sorts a block or a group of copies.
    """
    stretch = F.substring("spread", 9, 3).alias("stretch")
    key = F.coalesce(F.md5(F.col("source").cast("string")), F.lit("-")).alias("of_key")
    keyed = rows.withColumn("of_key", key)
    groups = keyed.groupBy("of_key", "spread", stretch, "tokens").agg(
        F.count(F.lit(1)).alias("n"), F.first("left").alias("left")
    )
    sums = groups.groupBy("of_key", "stretch").agg(F.sum(F.col("n") * F.col("tokens")).alias("sum"))
    # at most 4,096 stretches a source
    earlier = Window.partitionBy("of_key").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    begun = sums.select("of_key", "stretch", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("begin"))
    inside = (
        Window.partitionBy("of_key", "stretch").orderBy("spread").rowsBetween(Window.unboundedPreceding, -1)
    )
    own = F.coalesce(F.sum(F.col("n") * F.col("tokens")).over(inside), F.lit(0))
    free = F.col("left") - F.col("begin") - own
    fit = F.when(F.col("tokens") == 0, F.col("n")).otherwise(F.floor(free / F.col("tokens")))
    taken = F.when(free < 0, F.lit(0)).otherwise(F.least(fit, F.col("n"))).cast("bigint")
    fitted = groups.join(begun, ["of_key", "stretch"]).select("of_key", "spread", "n", taken.alias("taken"))
    placed = keyed.join(fitted, ["of_key", "spread"])
    full = (F.col("taken") == F.col("n")).cast("bigint")
    alone = placed.withColumn("times", F.col("passes") + full).withColumn("since", F.lit(0).cast("bigint"))
    # where only some of several equal rows fit, one stands for them: at most one group a source
    names = rows.columns
    split = placed.filter("taken > 0 AND taken < n").groupBy("of_key", "spread").agg(
        *[F.first(c).alias(c) for c in names if c != "spread"], F.first("taken").alias("taken")
    )
    again = split.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "taken")))
    more = again.withColumn("times", F.col("passes") + 1).withColumn("since", F.col("passes"))
    columns = [*names, "times", "since"]
    return alone.select(*columns).unionByName(more.select(*columns))


def mixed(
    docs: DataFrame,
    repetitions: float | None = REPETITIONS,
    entropy: float | None = None,
    budget: int | None = None,
    seed: str = "mix",
) -> DataFrame:
    """``row``, ``source`` and ``tokens`` once for each ``pass`` that draws the row, with the
    ``slot`` of its block in that pass.

    Give either ``repetitions`` or ``entropy``. ``budget`` is in tokens; without it
    every row is drawn once at least.
    """
    if (repetitions is None) == (entropy is None):
        raise ValueError("give either a repetition limit or a target entropy")
    rows = sized(docs, seed)
    known = checkpointed(plan(rows, repetitions, entropy, budget))
    small = known.count() <= BROADCAST_SOURCES
    same = F.col("source").eqNullSafe(F.col("of"))
    drawn = rows.join(F.broadcast(known) if small else known, same).withColumn(
        "last", _slot(F.col("block"), F.col("passes"))
    )
    edge = F.col("last") == F.col("cut")
    sure = drawn.filter(~edge).withColumn(
        "times", F.col("passes") + (F.col("last") < F.col("cut")).cast("bigint")
    ).withColumn("since", F.lit(0).cast("bigint"))
    each = sure.unionByName(_edge(drawn.filter(edge)).select(*sure.columns)).filter("times > 0")
    turns = F.explode(F.sequence("since", F.col("times") - 1)).alias("pass")
    return each.select("row", "source", "tokens", "block", turns).select(
        "row", "source", "tokens", "pass", _slot(F.col("block"), F.col("pass")).alias("slot")
    )


def mixing_report(docs: DataFrame) -> DataFrame:
    """``doc_id, source, n_tokens, pass, slot``, a row for each time a document is drawn."""
    return mixed(docs).select(
        F.col("row.doc_id").alias("doc_id"), "source", F.col("tokens").alias("n_tokens"), "pass", "slot"
    )


def mix(docs: DataFrame) -> DataFrame:
    """The input rows as often as they are drawn."""
    return mixed(docs).select("row.*")


def mixing_sql() -> str:
    """The report in SQL; with the default settings the exponent has a closed form."""
    return f"""
WITH sized AS (
  SELECT doc_id, source, text, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || coalesce(md5(text), '-')) AS spread,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens
  FROM documents
), rows AS (
  SELECT *, CAST(CAST('0x' || substr(spread, 1, 8) AS BIGINT) % {BLOCKS} AS BIGINT) AS block
  FROM sized
), sources AS (
  SELECT source, sum(tokens) AS total FROM rows GROUP BY source
), ends AS (
  SELECT max(total) AS largest, min(total) AS least FROM sources WHERE total > 0
), chosen AS (
  SELECT largest, round(CASE WHEN largest <= {REPETITIONS} * least THEN 0
    ELSE 1 - ln({REPETITIONS}) / ln(CAST(largest AS DOUBLE) / least) END, {_DECIMALS}) AS a
  FROM ends
), turned AS (
  SELECT source, total,
    CASE WHEN total > 0 THEN pow(CAST(largest AS DOUBLE) / total, 1 - a) ELSE 1.0 END AS turns
  FROM sources CROSS JOIN chosen
), budgeted AS (
  SELECT source AS of, CAST(floor(turns) AS BIGINT) AS passes,
    (turns - floor(turns)) * total AS rest
  FROM turned
), blocks AS (
  SELECT source, block, sum(tokens) AS tokens FROM rows GROUP BY source, block
), placed AS (
  SELECT *, (block * {_MULTIPLIER} + passes * {_SHIFT}) % {BLOCKS} AS slot
  FROM blocks JOIN budgeted ON source IS NOT DISTINCT FROM of
), summed AS (
  SELECT *, sum(tokens) OVER (PARTITION BY of ORDER BY slot ROWS UNBOUNDED PRECEDING) AS upto
  FROM placed
), plan AS (
  SELECT of, passes, coalesce(min(slot) FILTER (WHERE upto > rest), {BLOCKS}) AS cut,
    any_value(rest) - coalesce(max(upto) FILTER (WHERE upto <= rest), 0) AS left_over
  FROM summed GROUP BY of, passes
), drawn AS (
  SELECT *, (block * {_MULTIPLIER} + passes * {_SHIFT}) % {BLOCKS} AS last
  FROM rows JOIN plan ON source IS NOT DISTINCT FROM of
), counted AS (
  SELECT *, CASE WHEN last <> cut THEN passes + CAST(last < cut AS BIGINT)
    ELSE passes + CAST(sum(CASE WHEN last = cut THEN tokens ELSE 0 END) OVER (
      PARTITION BY source, last = cut ORDER BY spread
      ROWS UNBOUNDED PRECEDING) <= left_over AS BIGINT) END AS times
  FROM drawn
), each AS (
  SELECT *, unnest(range(times)) AS pass FROM counted WHERE times > 0
)
SELECT doc_id, source, CAST(tokens AS BIGINT) AS n_tokens, pass,
  CAST((block * {_MULTIPLIER} + pass * {_SHIFT}) % {BLOCKS} AS INTEGER) AS slot
FROM each"""
