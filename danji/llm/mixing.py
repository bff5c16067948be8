"""Mixing sources to target weights: hierarchical token budgets, filled from seeded epochs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hex digits of the seeded order that name a bucket: 4096 buckets a leaf.
BUCKET_DIGITS = 3


def _weight(level: str, weights: dict[str, int]) -> Column:
    """The weight of a child by its name; a name that is not listed weighs weights["*"], else 1."""
    out = F.lit(weights.get("*", 1))
    for name, w in weights.items():
        if name != "*":
            out = F.when(F.col(level) == name, F.lit(w)).otherwise(out)
    return out.cast("bigint")


def _share(children: DataFrame, parents: list[str], child: str) -> DataFrame:
    """Deal each parent's budget among its children by weight, none beyond its capacity.

    Children are taken by capacity per weight; one whose capacity is at most its share of what is
    left gets all of it, and what it lacks is dealt to its siblings. Whole numbers throughout: what
    the whole shares leave over goes, one by one, to the largest remainders, equal ones by name.
    """
    over = f"partition by {', '.join(parents)}" if parents else "partition by 0"
    order = f"{over} order by per_weight, {child}"
    return (
        children.withColumn("per_weight", F.expr("coalesce(double(capacity) / nullif(weight, 0), 0)"))
        .selectExpr(
            "*",
            f"coalesce(sum(capacity) over ({order} rows between unbounded preceding and 1 preceding), 0) as before",
            f"sum(weight) over ({order} rows between current row and unbounded following) as weights",
        )
        .withColumn("filled", F.expr("capacity * weights <= (parent_budget - before) * weight or capacity = 0"))
        .selectExpr(
            "*",
            f"sum(if(filled, capacity, 0)) over ({over}) as given",
            f"sum(if(filled, 0, weight)) over ({over}) as open",
        )
        .withColumn("whole", F.expr("if(filled, 0, (parent_budget - given) * weight div nullif(open, 0))"))
        .withColumn("rest", F.expr("if(filled, -1, (parent_budget - given) * weight % nullif(open, 0))"))
        .selectExpr(
            "*", f"row_number() over ({over} order by rest desc, {child}) as turn",
            f"parent_budget - given - sum(whole) over ({over}) as spare",
        )
        .withColumn("budget", F.expr("if(filled, capacity, whole + if(turn <= spare, 1, 0))"))
        .drop("per_weight", "before", "weights", "filled", "given", "open", "parent_budget", "weight", "whole", "rest", "turn", "spare")
    )


def budgets(leaves: DataFrame, levels: list[str], weights: dict[str, dict[str, int]], budget: Column, max_epochs: int) -> DataFrame:
    """The token budget of each leaf of the tree: the levels, leaf_tokens, budget.

    leaves: the levels and leaf_tokens, a row per leaf. A node holds at most max_epochs times its
    tokens. Going down from the root, a node's shortage goes to its siblings, and only what a whole
    subtree cannot hold is seen one level up. Windows run over the tree's nodes, not over documents.
    """
    nodes = [leaves.withColumn("capacity", F.when(_weight(levels[-1], weights.get(levels[-1], {})) > 0, F.col("leaf_tokens") * max_epochs).otherwise(0))]
    for depth in range(len(levels) - 1, 0, -1):
        level = levels[depth - 1]
        held = nodes[0].groupBy(*levels[:depth]).agg(F.sum("capacity").alias("capacity"))
        nodes.insert(0, held.withColumn("capacity", F.when(_weight(level, weights.get(level, {})) > 0, F.col("capacity")).otherwise(0)))
    given = None
    for depth, level in enumerate(levels):
        children = nodes[depth].withColumn("weight", _weight(level, weights.get(level, {})))
        parents = levels[:depth]
        if given is None:
            total = nodes[0].agg(F.sum("capacity")).scalar()
            children = children.withColumn("parent_budget", F.least(budget, total))
        else:
            children = children.join(given.select(*parents, F.col("budget").alias("parent_budget")), parents)
        given = _share(children, parents, level)
    return given.drop("capacity")


def mixture(
    docs: DataFrame, levels: dict[str, Column], weights: dict[str, dict[str, int]], tokens: Column,
    budget: int | None = None, fraction: tuple[int, int] = (1, 1), max_epochs: int = 4, seed: int = 0,
    id_col: str = "doc_id",
) -> DataFrame:
    """How often and how far each document is taken: doc_id, the levels, tokens, epochs, tail_tokens.

    levels: names and columns from the root of the tree to its leaves. budget: tokens in all; else
    the fraction (numerator, denominator) of all tokens there are. A leaf of T tokens with budget A
    goes through A div T whole epochs and the first A mod T tokens of one more, whose order is the
    MD5 of seed, epoch and id: a document is taken `epochs` times whole, and tail_tokens of it once
    more (its first tokens, where the prefix ends inside it).

    The order is cut into 4096 buckets a leaf by its first digits. Sums per bucket are combined on the
    map side and added up in a window over buckets; the running sum inside a bucket then sees one
    bucket's rows, so a source that holds a third of all rows is spread over 4096 groups. No texts
    are moved. Null or missing names are the name ''. Documents without tokens count 0 and are taken
    whole if the prefix reaches them. Rows that repeat an id and its values are drawn one by one. An
    empty table gives no rows. Sums times weights must stay below 2**63.
    """
    names = list(levels)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        *[F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in levels.items()],
        F.coalesce(tokens, F.lit(0)).cast("bigint").alias("tokens"),
    )
    leaves = rows.groupBy(*names).agg(F.sum("tokens").alias("leaf_tokens"))
    if budget is None:
        amount = leaves.agg(F.expr(f"sum(leaf_tokens) * {fraction[0]} div {fraction[1]}")).scalar()
    else:
        amount = F.lit(budget).cast("bigint")
    plan = budgets(leaves, names, weights, amount, max_epochs).selectExpr(
        *names, "coalesce(budget div nullif(leaf_tokens, 0), 0) as epochs",
        "coalesce(budget % nullif(leaf_tokens, 0), 0) as rest",
    )
    drawn = rows.join(plan, names).withColumn("place", F.md5(F.concat_ws("|", F.lit(str(seed)), "epochs", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    # Dealt by leaf and bucket, whatever the join before has left: a leaf may hold a third of all rows.
    drawn = drawn.withColumn("bucket", F.substring("place", 1, BUCKET_DIGITS)).repartition(*names, "bucket")
    key = ", ".join([*names, "bucket"])
    sums = drawn.groupBy(*names, "bucket").agg(F.sum("tokens").alias("bucket_tokens"))
    before = sums.selectExpr(
        *names, "bucket",
        f"coalesce(sum(bucket_tokens) over (partition by {', '.join(names)} order by bucket rows between unbounded preceding and 1 preceding), 0) as bucket_before",
    )
    inside = drawn.selectExpr(
        "*", f"coalesce(sum(tokens) over (partition by {key} order by place, tokens, doc_id rows between unbounded preceding and 1 preceding), 0) as inside_before"
    )
    return inside.join(before, [*names, "bucket"]).selectExpr(
        "doc_id", *names, "tokens", "epochs",
        "greatest(0, least(tokens, rest - bucket_before - inside_before)) as tail_tokens",
    )
