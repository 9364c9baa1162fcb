"""Mixing sources to target weights: temperature on token shares, realised as budgeted block permutations.

1. Tokens (words) per source, summed before the shuffle.
2. Weights are shares to the power of an exponent, normalised. Exponent 1 keeps the natural mix, 0 makes all sources
   equal. Entropy falls and the largest repetition falls as the exponent rises, so both are met by bisection: the
   largest exponent whose entropy reaches ``entropy`` times the greatest possible, or, if some source would then be
   repeated more than ``repeats`` times, the smallest exponent that keeps that limit. Each round evaluates a row of
   exponents over the table of sources in one aggregate and keeps the interval between two of them.
3. A source's budget is its weight times the budget of the mix. Whole passes take every row; the last, partial pass
   takes rows in the pass's permutation while they fit. A permutation orders blocks by a hash of pass and block, and
   the rows of a block by a hash of pass and row.

The text never moves. Blocks of about ``BLOCK_TOKENS`` tokens are summed per source, a window over these sums finds the
block in which the budget ends, and a window over that block's rows finds the row; what reaches the rows is one cut
per source. A source with a third of all rows costs no task more than its list of block sums and one block of rows.
The table of sources is broadcast if it is counted to be at most ``BROADCAST_ROWS``, else joined by sort and merge.
Built-in functions only.

Defined results: null text is empty; a null source is a source; a source without tokens gets no budget and no draw.
Rows without tokens come in whole passes and, in a partial pass, with the rows around them. Rows that repeat id and
text are drawn together. An empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermart.llm.frames import WORD, Scratch, unpacked, whole_row

ENTROPY = 0.95
REPEATS = 4.0
SEED = 20
BLOCK_TOKENS = 1_000_000
BROADCAST_ROWS = 100_000
# Exponents tried per round, and rounds: the interval ends below a millionth.
FAN, ROUNDS = 16, 6
PLACES = 6


def _row_key(id_col: Column, text: Column) -> Column:
    return F.xxhash64(id_col, text)


def _block(key: Column, blocks: Column) -> Column:
    return F.pmod(key, blocks)


def _block_order(turn: Column, block: Column) -> Column:
    return F.xxhash64(F.lit(SEED), turn, block)


def _row_order(turn: Column, key: Column) -> Column:
    return F.xxhash64(F.lit(SEED + 1), turn, key)


def figures(shares: DataFrame, exponents: list[float], budget_share: float = 1.0) -> list:
    """(exponent, entropy, most) for each exponent: the mix's entropy and its largest number of repeats."""
    log_share = F.log("share")
    tried = shares.select(log_share.alias("l"), F.explode(F.array(*[F.lit(e) for e in exponents])).alias("exponent"))
    mass = F.exp(F.col("exponent") * F.col("l"))
    rows = (
        tried.groupBy("exponent")
        .agg(
            F.sum(mass).alias("z"),
            F.sum(mass * F.col("exponent") * F.col("l")).alias("s"),
            F.max((F.col("exponent") - 1) * F.col("l")).alias("top"),
        )
        .select("exponent", (F.log("z") - F.col("s") / F.col("z")).alias("entropy"), (F.exp("top") * budget_share / F.col("z")).alias("most"))
        .collect()
    )  # one row per exponent
    return sorted(rows, key=lambda r: r["exponent"])


def exponent_for(shares: DataFrame, entropy: float = ENTROPY, repeats: float = REPEATS, budget_share: float = 1.0) -> float:
    """The exponent that meets both targets, to a millionth. shares: one row per source with tokens."""
    count = shares.count()
    if count <= 1:
        return 1.0
    goal = entropy * figures(shares, [0.0])[0]["entropy"]

    def bisected(meets, largest: bool) -> float:
        """End of the interval of exponents that meet the target; it starts at 0 for the largest, else ends at 1."""
        low, high = 0.0, 1.0
        for _ in range(ROUNDS):
            grid = [low + (high - low) * k / FAN for k in range(FAN + 1)]
            good = [meets(r) for r in figures(shares, grid, budget_share)]
            if largest:
                k = max((i for i, g in enumerate(good) if g), default=0)
                low, high = grid[k], grid[min(k + 1, FAN)]
            else:
                k = min((i for i, g in enumerate(good) if g), default=FAN)
                low, high = grid[max(k - 1, 0)], grid[k]
        return low if largest else high

    even = bisected(lambda r: r["entropy"] >= goal, True)
    # Whole passes over everything already repeat budget_share times; no exponent can go below that.
    allowed = max(repeats, budget_share) + 1e-9
    rare = bisected(lambda r: r["most"] <= allowed, False)
    return round(max(even, rare), PLACES)


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def plan(rows: DataFrame, scratch: Scratch, entropy: float, repeats: float, budget_share: float) -> DataFrame:
    """One row per source: weight, budget, whole passes, blocks, and where the partial pass ends.

    rows: source, n (tokens), key. Columns of the result: origin (the source), tokens, weight, budget, passes, blocks,
    and the cut: rows of blocks ordered before (cut_order, cut_block) are drawn, and those of that block up to cut_row.
    """
    totals = scratch.write(rows.groupBy(F.col("source").alias("origin")).agg(F.sum("n").alias("tokens")).where("tokens > 0"), "sources")
    everything = totals.agg(F.sum("tokens")).head()[0] or 0
    shares = totals.withColumn("share", F.col("tokens") / F.lit(float(max(everything, 1))))
    exponent = exponent_for(shares, entropy, repeats, budget_share)
    mass = F.pow("share", F.lit(exponent))
    norm = shares.agg(F.sum(mass)).head()[0] or 1.0
    weight = mass / F.lit(norm)
    most = F.lit(max(repeats, budget_share)) * F.col("tokens")
    budget = F.round(F.least(weight * F.lit(everything * budget_share), most)).cast("long")
    planned = shares.select(
        "origin",
        "tokens",
        F.round(weight, 12).alias("weight"),
        budget.alias("budget"),
        F.floor(budget / F.col("tokens")).cast("long").alias("passes"),
        F.ceil(F.col("tokens") / F.lit(BLOCK_TOKENS)).cast("long").alias("blocks"),
    )
    planned = scratch.write(planned.withColumn("rest", F.col("budget") - F.col("passes") * F.col("tokens")), "planned")

    same = F.col("source").eqNullSafe(F.col("origin"))
    dealt = rows.join(_small(planned), same).select(
        "origin", "n", "key", "passes", "rest", _block(F.col("key"), F.col("blocks")).alias("block")
    )
    order = _block_order(F.col("passes"), F.col("block"))
    sums = dealt.groupBy("origin", "passes", "rest", "block").agg(F.sum("n").alias("n")).withColumn("order", order)
    before = Window.partitionBy("origin").orderBy("order", "block").rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        sums.withColumn("done", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .where("done <= rest and done + n > rest")
        .groupBy(F.col("origin").alias("at"))
        .agg(F.min_by(F.struct("order", "block", (F.col("rest") - F.col("done")).alias("room")), F.struct("order", "block")).alias("end"))
    )
    ends = scratch.write(ends.select("at", "end.order", "end.block", "end.room"), "ends")
    last = dealt.join(_small(ends.select("at", F.col("block").alias("end_block"), "room")), F.col("origin").eqNullSafe(F.col("at")) & (F.col("block") == F.col("end_block")))
    in_order = last.groupBy("at", "room", _row_order(F.col("passes"), F.col("key")).alias("row")).agg(F.sum("n").alias("n"))
    upto = Window.partitionBy("at").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    cuts = in_order.withColumn("done", F.sum("n").over(upto)).where("done <= room").groupBy(F.col("at").alias("cut_at")).agg(F.max("row").alias("cut_row"))
    planned = planned.join(ends.select("at", F.col("order").alias("cut_order"), F.col("block").alias("cut_block")), F.col("origin").eqNullSafe(F.col("at")), "left")
    planned = planned.join(cuts, F.col("origin").eqNullSafe(F.col("cut_at")), "left").drop("at", "cut_at")
    return scratch.write(planned, "plan")


def draws(df: DataFrame, planned: DataFrame, source: Column, key: Column) -> DataFrame:
    """``df`` with a row per draw and the columns of the plan and the draw; rows that are not drawn are gone."""
    block = _block(key, F.col("blocks"))
    order = _block_order(F.col("passes"), block)
    earlier = (order < F.col("cut_order")) | ((order == F.col("cut_order")) & (block < F.col("cut_block")))
    at_cut = (block == F.col("cut_block")) & (_row_order(F.col("passes"), key) <= F.col("cut_row"))
    more = (F.col("rest") > 0) & F.coalesce(earlier | at_cut, F.lit(False))
    times = F.col("passes") + more.cast("long")
    drawn = df.join(_small(planned), source.eqNullSafe(F.col("origin"))).withColumn("times", times).where("times > 0")
    return drawn.withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)))


def mixed(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", source: str = "source",
    entropy: float = ENTROPY, repeats: float = REPEATS, budget_share: float = 1.0, scratch: Scratch | None = None,
) -> DataFrame:
    """``docs`` as drawn: rows repeat as often as they are drawn, all columns as they were."""
    scratch = scratch or Scratch(docs.sparkSession)
    rows = scratch.write(_measured(docs, text, id_col, source), "tokens")
    planned = plan(rows, scratch, entropy, repeats, budget_share)
    packed = docs.select(whole_row(docs).alias("doc"))
    key = _row_key(F.col("doc")[id_col], F.col("doc")[text])
    return draws(packed, planned, F.col("doc")[source], key).select(*unpacked(packed))


def _measured(docs: DataFrame, text: str, id_col: str, source: str) -> DataFrame:
    n = F.coalesce(F.regexp_count(docs[text], F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(docs[id_col].alias("id"), docs[source].alias("source"), n.alias("n"), _row_key(docs[id_col], docs[text]).alias("key"))


def op1_mixing(spark, sf_dir: str) -> DataFrame:
    """Every draw: the row, its pass, its place in the permutation, and ``mix_at``, which interleaves the sources."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark)
    rows = scratch.write(_measured(docs, "text", "doc_id", "source"), "tokens")
    planned = plan(rows, scratch, ENTROPY, REPEATS, 1.0)
    block = _block(F.col("key"), F.col("blocks"))
    order = _block_order(F.col("turn"), block)
    progress = (order / F.lit(2.0**64) + 0.5 + F.col("turn")) * F.col("tokens") / F.col("budget")
    return draws(rows, planned, F.col("source"), F.col("key")).select(
        F.col("id").alias("doc_id"),
        "source",
        F.col("n").alias("n_tokens"),
        F.col("turn").alias("pass"),
        block.alias("block"),
        order.alias("block_order"),
        _row_order(F.col("turn"), F.col("key")).alias("row_order"),
        progress.alias("mix_at"),
        "weight",
        "budget",
    )
