"""Mixing sources to target weights by hierarchical budgeting, in DataFrame operations only.

The levels (domain, language, source) form a tree whose leaves hold documents. A token budget is
handed down: every node shares its part among its children by weight, a child takes no more than
its subtree can give (its tokens times ``max_epochs``), and what a child cannot take goes to its
siblings first; only what a whole subtree cannot take is left to the siblings of its ancestor.
A leaf with part a and t tokens gives a div t whole epochs and, of the next epoch, the longest
prefix that fits into the rest; the order within an epoch is that of a seeded hash.

Prefixes are found without sorting a leaf: hash ranges (about the root of the leaf's rows) are
summed, whole ranges are taken, and only the range that holds the cut is ordered.

Defined cases: a null level is the empty name; names without a weight have ``default_weight``; a
null text has no tokens; documents without tokens cost nothing and lie in a prefix like others,
a leaf without any tokens gives each document once; rows with equal ids are taken in any order; a
budget above all capacities takes every document ``max_epochs`` times; an empty table or a budget
of nothing gives no rows (documents without tokens before the first cut excepted).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.llm.common import materialize

WORD = r"[^\x20\x09-\x0D]+"
HASH_SPAN = 1 << 32


def count_tokens(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def domain_of(source: str = "source") -> Column:
    """Five neighbouring source numbers make a domain; sources without a number are domain x."""
    number = F.regexp_extract(F.coalesce(F.col(source), F.lit("")), "([0-9]{1,9})$", 1)
    group = F.floor(number.cast("long") / 5).cast("string")
    return F.when(number == "", "x").otherwise(F.concat(F.lit("d"), group))


def _weight(column: str, weights: dict[str, int], default: int) -> Column:
    out = F.lit(default)
    for name, w in weights.items():
        out = F.when(F.col(column) == name, F.lit(w)).otherwise(out)
    return out.cast("decimal(38,0)")


def _share(children: DataFrame, parent: list[str], weight: Column, order: str) -> DataFrame:
    """Water-filling of ``part`` (of the parent) over children with capacity ``cap``: adds
    ``given``. Children are taken in the order of capacity per weight; those whose fair share of
    what is left reaches their capacity are filled, the others share the rest exactly."""
    by = Window.partitionBy(*parent).orderBy(F.col("__ratio"), F.col(order))
    up_to = by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*parent)
    full = children.withColumn("__w", weight).withColumn(
        "__ratio", F.col("cap").cast("double") / F.col("__w").cast("double")
    )
    full = full.withColumns(
        {
            "__before": F.sum("cap").over(up_to) - F.col("cap"),
            "__left": F.sum("__w").over(whole) - F.sum("__w").over(up_to) + F.col("__w"),
        }
    ).withColumn(
        "__full",
        (F.col("part") - F.col("__before")) * F.col("__w") >= F.col("cap") * F.col("__left"),
    )
    open_w = F.when(~F.col("__full"), F.col("__w")).otherwise(F.lit(0).cast("decimal(38,0)"))
    full = full.withColumns(
        {
            "__rest": F.col("part")
            - F.sum(F.when(F.col("__full"), F.col("cap")).otherwise(0)).over(whole),
            "__open": F.sum(open_w).over(whole),
            "__to": F.sum(open_w).over(up_to),
        }
    )
    exact = F.expr(
        "case when __full then cap else cast((__rest * __to) div __open as decimal(20,0))"
        " - cast((__rest * (__to - __w)) div __open as decimal(20,0)) end"
    )
    drop = [c for c in full.columns if c.startswith("__")]
    return full.withColumn("given", exact.cast("long")).drop(*drop)


def leaf_budgets(
    tokens: DataFrame,
    levels: Sequence[str],
    weights: dict[str, dict[str, int]],
    budget_percent: int,
    max_epochs: int,
    default_weight: int = 1,
) -> DataFrame:
    """One row per leaf: its levels, tokens, rows, given (tokens), epochs (whole), rest."""
    leaves = materialize(
        tokens.groupBy(*levels).agg(
            F.sum("n_tokens").alias("tokens"), F.count("*").alias("rows")
        ),
        "mix-leaves",
    )
    caps = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    part = total * budget_percent // 100
    nodes: DataFrame | None = None
    for depth, level in enumerate(levels):
        above, names = list(levels[:depth]), list(levels[: depth + 1])
        children = caps.groupBy(*names).agg(F.sum("cap").alias("cap"))
        if nodes is None:
            children = children.withColumn("part", F.lit(part).cast("long"))
        else:
            children = children.join(nodes.withColumnRenamed("given", "part"), above)
        weight = _weight(level, weights.get(level, {}), default_weight)
        nodes = _share(children, above, weight, level).select(*names, "given")
    return leaves.join(nodes, list(levels)).withColumns(
        {
            "epochs": F.expr("coalesce(given div nullif(tokens, 0), 0)"),
            "rest": F.expr("given - coalesce(given div nullif(tokens, 0), 0) * tokens"),
        }
    )


def _place(seed: int) -> Column:
    """Hash of the document in the epoch that is cut, as hexadecimal text."""
    parts = (F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(str(seed)))
    return F.md5(F.concat_ws("|", *parts, F.col("__epochs").cast("string")).cast("binary"))


def _range() -> Column:
    """Number of the hash range of the document, of ``__ranges`` ranges of its leaf."""
    head = F.conv(F.substring("__place", 1, 8), 16, 10).cast("long")
    return F.shiftright(head * F.col("__ranges"), 32)


def mix_sources(
    docs: DataFrame,
    tokens: DataFrame,
    levels: dict[str, Column],
    weights: dict[str, dict[str, int]],
    n_tokens: Column,
    budget_percent: int = 60,
    max_epochs: int = 2,
    seed: int = 7,
    epoch: str = "mix_epoch",
) -> DataFrame:
    """Rows of ``docs`` with the column ``epoch`` (0 for the first copy), one row per selected
    copy; a column of that name in ``docs`` is replaced.

    ``tokens`` is the narrow table of the same documents: doc_id, the level names (never null) and
    n_tokens; ``levels`` and ``n_tokens`` say how to compute these from ``docs``. Texts are not
    shuffled but for the rows of the one hash range per leaf that holds its cut.
    """
    names = list(levels)
    leaf = {f"__{name}": name for name in names}
    budgets = leaf_budgets(tokens, names, weights, budget_percent, max_epochs)
    budgets = materialize(
        budgets.withColumn("__ranges", F.floor(F.sqrt(F.col("rows"))).cast("long"))
        .withColumnRenamed("epochs", "__epochs"),
        "mix-budgets",
    )
    placed = tokens.join(budgets.select(*names, "__epochs", "rest", "__ranges"), names)
    sums = (
        placed.withColumn("__place", _place(seed))
        .withColumn("__range", _range())
        .groupBy(*names, "__range")
        .agg(F.sum("n_tokens").alias("here"), F.first("rest").alias("rest"))
    )
    running = Window.partitionBy(*names).orderBy("__range").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    cuts = (
        sums.withColumn("after", F.sum("here").over(running))
        .where("after > rest")
        .groupBy(*names)
        .agg(F.min(F.struct("__range", F.expr("after - here as before"))).alias("cut"))
    )
    plan = budgets.join(cuts, names, "left").select(
        *(F.col(name).alias(own) for own, name in leaf.items()),
        F.col("__epochs"),
        F.col("rest").alias("__rest"),
        F.col("__ranges"),
        F.coalesce("cut.__range", F.col("__ranges")).alias("__cut"),
        F.coalesce("cut.before", F.lit(0)).alias("__before"),
        ((F.col("rest") > 0) | (F.col("__epochs") == 0)).alias("__partial"),
    )
    plan = materialize(plan, "mix-plan")
    tagged = (
        docs.withColumns({own: levels[name] for own, name in leaf.items()})
        .join(plan, list(leaf))
        .withColumn("__place", _place(seed))
        .withColumn("__range", _range())
    )
    clear = tagged.where("__range <> __cut or not __partial").withColumn(
        "__taken", F.expr("__partial and __range < __cut")
    )
    order = (
        Window.partitionBy(*leaf, "__range")
        .orderBy("__place", "doc_id")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    at_cut = (
        tagged.where("__range = __cut and __partial")
        .withColumn("__tokens", n_tokens)
        .withColumn("__taken", F.sum("__tokens").over(order) + F.col("__before") <= F.col("__rest"))
        .drop("__tokens")
    )
    return (
        clear.unionByName(at_cut)
        .withColumn("__copies", F.col("__epochs") + F.col("__taken").cast("long"))
        .where("__copies > 0")
        .select(
            *(F.col(c) for c in docs.columns if c != epoch),
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("__copies") - 1)).alias(epoch),
        )
    )
