"""Mix sources to target weights: budgets down a tree, then seeded prefixes of its leaves."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lookback.llm.common import n_words, staged

#: Order keys are the first 60 bits of an MD5, so that any SQL engine can repeat them.
KEY_BITS = 60


def order_key(seed: int, epoch: Column, key: Column) -> Column:
    """Place of a row in the seeded order of an epoch."""
    text = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), key)
    return F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 10).cast("long")


def _same(left: DataFrame, right: DataFrame, names: list[str], prefix: str = "to") -> Column:
    """Null-safe equality of the columns ``names``, which bear a prefix on the right."""
    pairs = [left[n].eqNullSafe(right[f"{prefix}_{n}"]) for n in names]
    return reduce(Column.__and__, pairs, F.lit(True))


def _weight(value: Column, weights: dict[str, float]) -> Column:
    weight = F.lit(1.0)
    for name, given in sorted(weights.items()):
        weight = F.when(value == name, F.lit(float(given))).otherwise(weight)
    return weight


def budgets(
    leaves: DataFrame,
    levels: list[str],
    weights: dict[str, dict[str, float]],
    total: float,
    max_epochs: int,
) -> DataFrame:
    """``leaves`` (``levels``, ``tokens``) with the ``budget`` of each.

    At every node the budget goes to the children by weight. A child can take at most
    ``max_epochs`` times the tokens below it; what it cannot take goes to its siblings by
    weight, and only what all of them cannot take is missing from the node and was
    therefore offered to the node's own siblings first, level by level. Children are
    sorted by capacity per weight: those that fill up are a prefix, and the rest share
    what is left.
    """
    nodes = leaves.select(*levels, (F.col("tokens") * max_epochs).cast("double").alias("cap"))
    given, above = None, []
    for i, level in enumerate(levels):
        path = levels[: i + 1]
        rows = nodes.groupBy(*path).agg(F.sum("cap").alias("cap"))
        rows = rows.withColumn("w", _weight(F.col(level), weights.get(level, {})))
        if given is None:
            rows = rows.withColumn("b", F.lit(float(total)))
        else:
            parent = given.select(*(F.col(n).alias(f"to_{n}") for n in above), F.col("given").alias("b"))
            rows = rows.join(parent, _same(rows, parent, above)).select(*path, "cap", "w", "b")
        group = Window.partitionBy(*above) if above else Window.partitionBy(F.lit(0))
        order = group.orderBy(F.col("cap") / F.col("w"), level)
        before = order.rowsBetween(Window.unboundedPreceding, -1)
        rows = rows.withColumns(
            {
                "left": F.col("b") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
                "open": F.sum("w").over(group) - F.coalesce(F.sum("w").over(before), F.lit(0.0)),
            }
        )
        full = F.col("cap") * F.col("open") <= F.col("w") * F.col("left")
        rows = rows.withColumn("level", F.when(~full, F.col("left") / F.col("open")))
        # The first child that does not fill up sets the share per weight of the rest.
        rows = rows.withColumn(
            "level", F.first("level", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
        )
        given = rows.select(
            *path,
            F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.col("w") * F.col("level")).alias("given"),
        )
        above = path
    parent = given.select(*(F.col(n).alias(f"to_{n}") for n in levels), F.floor("given").cast("long").alias("budget"))
    return leaves.join(parent, _same(leaves, parent, levels)).select(*leaves.columns, "budget")


def plan(
    rows: DataFrame,
    levels: list[str],
    weights: dict[str, dict[str, float]],
    *,
    share: float,
    max_epochs: int,
    seed: int,
) -> DataFrame:
    """Per leaf its ``budget``, whole ``epochs``, and the last place taken of the next one.

    ``rows`` has ``levels``, ``key`` (string) and ``tokens``. The prefix of a leaf is
    found in two steps, so that no leaf is ever sorted in one task: its order keys fall
    into about sqrt(n) ranges of about sqrt(n) rows, token sums per range tell which one
    the prefix ends in, and only that range is sorted. Rows of equal ``key`` share a place.
    """
    leaves = staged(
        rows.groupBy(*levels).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("rows")),
        "mix-leaves",
    )
    total = leaves.agg(F.sum("tokens").alias("t")).first()["t"] or 0
    leaves = budgets(leaves, levels, weights, share * total, max_epochs)
    whole = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(max_epochs)
    leaves = staged(
        leaves.withColumn("epochs", whole.cast("int")).withColumns(
            {
                "rest": F.col("budget") - F.col("epochs") * F.col("tokens"),
                "ranges": F.ceil(F.sqrt("rows")).cast("long"),
            }
        ),
        "mix-budgets",
    )
    ends = leaves.where("rest > 0").select(
        *(F.col(n).alias(f"to_{n}") for n in levels), "epochs", "rest", "ranges"
    )
    placed = rows.join(ends, _same(rows, ends, levels)).withColumn(
        "place", order_key(seed, F.col("epochs"), F.col("key"))
    )
    half = 1 << (KEY_BITS // 2)
    placed = placed.withColumn(
        "range", F.floor(F.floor(F.col("place") / F.lit(half)) * F.col("ranges") / F.lit(half)).cast("long")
    )
    sums = placed.groupBy(*levels, "range", "rest").agg(F.sum("tokens").alias("sum"))
    upto = Window.partitionBy(*levels).orderBy("range")
    sums = sums.withColumn("upto", F.sum("sum").over(upto))
    last = staged(
        sums.where(F.col("upto") > F.col("rest"))
        .groupBy(*levels)
        .agg(F.min(F.struct("range", (F.col("upto") - F.col("sum")).alias("before"))).alias("m"))
        .select(*(F.col(n).alias(f"at_{n}") for n in levels), F.col("m.range").alias("last"), "m.before"),
        "mix-ranges",
    )
    at = _same(placed, last, levels, "at")
    inside = placed.join(last, at & (placed["range"] == last["last"]))
    peers = inside.groupBy(*levels, "place", "key", "rest", "before").agg(F.sum("tokens").alias("sum"))
    order = Window.partitionBy(*levels).orderBy("place", "key")
    taken = peers.withColumn("upto", F.col("before") + F.sum("sum").over(order))
    cut = (
        taken.where(F.col("upto") <= F.col("rest"))
        .groupBy(*levels)
        .agg(F.max(F.struct("place", "key")).alias("cut"))
        .select(*(F.col(n).alias(f"cut_{n}") for n in levels), "cut")
    )
    low = last.select(*(F.col(f"at_{n}").alias(f"low_{n}") for n in levels), F.col("last"))
    joined = leaves.join(low, _same(leaves, low, levels, "low"), "left").join(
        cut, _same(leaves, cut, levels, "cut"), "left"
    )
    return staged(
        joined.select(
            *(F.col(n).alias(f"to_{n}") for n in levels),
            F.col("tokens").alias("leaf_tokens"),
            "budget",
            "epochs",
            "rest",
            "ranges",
            "last",
            "cut",
        ),
        "mix-plan",
    )


def mix(
    docs: DataFrame,
    *,
    levels: dict[str, Column],
    weights: dict[str, dict[str, float]] | None = None,
    share: float = 1.0,
    max_epochs: int = 4,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` chosen to meet the weights, with ``lb_tokens`` and ``lb_epochs`` added.

    ``levels`` names the tree from the root down, ``weights`` gives weights of values per
    level (1 where none is given); the budget is ``share`` of all tokens (words). A leaf
    of ``t`` tokens with budget ``b`` gives ``b // t`` whole epochs and of the next one,
    in its seeded order, the longest prefix of rows with at most ``b % t`` tokens.
    ``lb_epochs`` (1 or more) says how often a row is taken.

    Null levels are nodes of their own. Null texts have no tokens; a leaf without tokens
    is taken ``max_epochs`` times. Rows that share an id (null counts as one) in a leaf
    share a place and are taken together. No rows give no rows.

    Only the leaf table meets the rows, joined by its measured size; texts are neither
    shuffled nor sorted.
    """
    names = docs.columns
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    keyed = docs.withColumns(
        {f"lb_{n}": c for n, c in levels.items()} | {"lb_key": key, "lb_tokens": n_words(F.col(text_col))}
    )
    nodes = [f"lb_{n}" for n in levels]
    slim = staged(
        keyed.select(*nodes, F.col("lb_key").alias("key"), F.col("lb_tokens").alias("tokens")),
        "mix-rows",
    )
    leaf = plan(
        slim,
        nodes,
        {f"lb_{n}": w for n, w in (weights or {}).items()},
        share=share,
        max_epochs=max_epochs,
        seed=seed,
    )
    rows = keyed.join(leaf, _same(keyed, leaf, nodes))
    place = order_key(seed, F.col("epochs"), F.col("lb_key"))
    half = 1 << (KEY_BITS // 2)
    reach = F.floor(F.floor(place / F.lit(half)) * F.col("ranges") / F.lit(half)).cast("long")
    here = F.struct(place.alias("place"), F.col("lb_key").alias("key"))
    more = F.when(F.col("rest") <= 0, F.lit(0)).otherwise(
        F.when(F.col("last").isNull() | (reach < F.col("last")), 1)
        .when((reach == F.col("last")) & (here <= F.col("cut")), 1)
        .otherwise(0)
    )
    return (
        rows.withColumn("lb_epochs", (F.col("epochs") + more).cast("int"))
        .where("lb_epochs > 0")
        .select(*names, *nodes, "lb_tokens", "lb_epochs")
    )
