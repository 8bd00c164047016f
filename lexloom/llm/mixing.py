"""Mixing sources to target weights: hierarchical budgets, then token prefixes from seeded epochs.

DataFrame operations only.  Available tokens are summed up a tree (such as domain, language, source);
a token budget goes down it by weight.  A child that holds less than its share gets all it has and
its siblings share the rest by weight; since a node's budget never exceeds what its subtree holds, a
shortage reaches the level above only when no sibling can take it.  All arithmetic is in whole
tokens, so the leaves' budgets add up exactly.

Each leaf then takes its documents in seeded order, one pass (epoch) after the other, up to its
budget: whole epochs by multiplication, the last one as a prefix in the hash order of (seed, epoch,
id).  The prefix is found in two steps, sums of hash buckets and rows within a bucket, so no task
sorts a whole leaf.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.llm.runtime import discard, staged

#: Hex digits of the order hash that name a bucket: 4,096 buckets a leaf.
BUCKET_DIGITS = 3
BIG = "decimal(38,0)"


def word_count(text: Column) -> Column:
    """Words between ASCII white space, the default measure of tokens; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def divide_budget(children: DataFrame, parent: list[str], name: str, weight: str, cap: str, budget: str, out: str = "share") -> DataFrame:
    """``children`` with ``out``: the part of ``budget`` (the same in all rows of a parent) each gets.

    Water-filling in whole tokens: children in order of cap / weight; those whose cap does not exceed
    their share of what is left get their cap, the others split the remainder by weight, odd tokens
    going to the first in that order.  Weight 0 gets nothing; the budget is cut to what can be placed.
    """
    live = F.col(weight) > 0
    cap_ = F.when(live, F.col(cap)).otherwise(0).cast(BIG)
    weight_ = F.col(weight).cast(BIG)
    order = [F.when(live, F.col(cap).cast("double") / F.col(weight)).otherwise(F.lit(float("inf"))).asc(), F.col(name).asc_nulls_first()]
    whole = Window.partitionBy(*parent)
    before = whole.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    after = whole.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    w = (
        children.withColumn("_cap", cap_)
        .withColumn("_left", F.least(F.col(budget).cast(BIG), F.sum("_cap").over(whole)) - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
        .withColumn("_weights", F.sum(weight_).over(after))
        .withColumn("_full", ~live | (F.col("_cap") * F.col("_weights") <= weight_ * F.col("_left")))
    )
    part = F.when(F.col("_full"), F.lit(None)).otherwise(weight_)
    w = (
        w.withColumn("_rest", F.least(F.col(budget).cast(BIG), F.sum("_cap").over(whole)) - F.coalesce(F.sum(F.when(F.col("_full"), F.col("_cap"))).over(whole), F.lit(0)))
        .withColumn("_split", F.sum(part).over(whole))
        .withColumn("_even", F.expr(f"cast({weight} as {BIG}) * _rest div _split").cast(BIG))
        .withColumn("_odd", F.col("_rest") - F.sum(F.when(~F.col("_full"), F.col("_even"))).over(whole))
        .withColumn("_place", F.sum(F.when(~F.col("_full"), 1)).over(whole.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    )
    share = F.when(F.col("_full"), F.col("_cap")).otherwise(F.col("_even") + F.when(F.col("_place") <= F.col("_odd"), 1).otherwise(0))
    return w.withColumn(out, share.cast("long")).select(*children.columns, out)


def tree_budgets(leaves: DataFrame, levels: list[str], weights: list[str], cap: str, budget: int) -> DataFrame:
    """``levels`` of ``leaves`` with ``share``, each leaf's part of ``budget``; ``weights`` names a whole-number column for each level.

    A window works on the children of one parent: on names, never on documents.
    """
    held = leaves.withColumn("_c", F.when(F.least(F.lit(1), *[F.col(w) for w in weights]) > 0, F.col(cap)).otherwise(0))
    above = None
    for depth, (level, weight) in enumerate(zip(levels, weights, strict=True)):
        path = levels[: depth + 1]
        level_rows = held.groupBy(*path).agg(F.sum("_c").alias("_sum"), F.max(weight).alias("_w"))
        parent = path[:-1]
        if above is not None:
            matched = [level_rows[c].eqNullSafe(above[c]) for c in parent]
            children = level_rows.join(above, matched).select(*[level_rows[c] for c in path], level_rows["_sum"], "_w", "_budget")
        else:
            children = level_rows.withColumn("_budget", F.lit(budget))
        above = divide_budget(children, parent, level, "_w", "_sum", "_budget", "_share").select(*path, F.col("_share").alias("_budget"))
    return above.withColumnRenamed("_budget", "share")


#: Columns of ``mix``'s result beside the id and the levels.
TAKEN = ("n_tokens", "full_epochs", "partial_tokens", "tokens_taken")


def mix(df: DataFrame, levels: dict[str, Column], weights: dict[str, Column], budget: Column, tokens: Column, id_col: str = "doc_id", seed: str = "mix", max_epochs: int = 1) -> DataFrame:
    """(id_col, levels, n_tokens, full_epochs, partial_tokens, tokens_taken) of the documents taken.

    ``levels`` names the tree from the top, each a Column over ``df`` (null is a value of its own); the
    ``weights`` are whole-number Columns over those names.  ``tokens`` measures a document.  A leaf holds
    ``max_epochs`` times its tokens; ``budget`` is an aggregate over the leaves' ``cap``.  A document is
    taken ``full_epochs`` times whole and once more up to ``partial_tokens`` (all of it but for the one at
    the prefix's end).  Documents without tokens (null and empty texts), of weight 0 or beyond the prefix
    give no row; repeated rows count one by one; null ids take part under an empty name; an empty table
    gives no rows.  Level names may be any but those of the result's own columns.  Text is read once;
    what is shuffled are ids, leaves and counts.
    """
    if clash := set(levels) & {id_col, *TAKEN}:
        raise ValueError(f"levels must not be named {', '.join(sorted(clash))}")
    names, own, weighed = list(levels), [f"_l{i}" for i in range(len(levels))], [f"_w{i}" for i in range(len(levels))]
    rows = staged(df.select(F.col(id_col).cast("long").alias("_id"), *[c.cast("string").alias(o) for o, c in zip(own, levels.values(), strict=True)], tokens.cast("long").alias("n_tokens")).where("n_tokens > 0"), "mix-rows")
    named = rows.groupBy(*own).agg(F.sum("n_tokens").alias("_held")).select(*[F.col(o).alias(n) for o, n in zip(own, names, strict=True)], F.col("_held").alias("_h"))
    leaves = named.select(*[F.col(f"`{n}`").alias(o) for o, n in zip(own, names, strict=True)], *[weights[n].cast("long").alias(w) for w, n in zip(weighed, names, strict=True)], F.col("_h").alias("_held"), (F.col("_h") * max_epochs).alias("cap"))
    leaves = staged(leaves, "mix-leaves")
    total = leaves.select("cap").agg(budget.cast("long").alias("b")).first()["b"] or 0  # one number
    shares = tree_budgets(leaves, own, weighed, "cap", total)
    plan = staged(
        leaves.alias("l").join(shares.alias("s"), [F.col(f"l.{n}").eqNullSafe(F.col(f"s.{n}")) for n in own])
        .select(*[F.col(f"l.{n}") for n in own], F.expr("share div _held").alias("_full"), (F.col("share") % F.col("_held")).alias("_part"))
        .where("_full > 0 or _part > 0"), "mix-plan"
    )
    hexed = F.md5(F.concat_ws(":", F.lit(seed), F.col("_full").cast("string"), F.coalesce(F.col("_id").cast("string"), F.lit(""))).cast("binary"))
    dealt = (
        rows.alias("r").join(plan.alias("p"), [F.col(f"r.{n}").eqNullSafe(F.col(f"p.{n}")) for n in own])
        .select("_id", *[F.col(f"r.{n}") for n in own], "n_tokens", "_full", "_part", hexed.alias("_h")).withColumn("_bucket", F.substring("_h", 1, BUCKET_DIGITS))
    )
    dealt = staged(dealt, "mix-dealt")
    discard(rows, leaves, plan)
    buckets = dealt.groupBy(*own, "_bucket").agg(F.sum("n_tokens").alias("_n"))
    # At most 4,096 sums a leaf, however many documents it holds.
    start = F.coalesce(F.sum("_n").over(Window.partitionBy(*own).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = buckets.select(*own, "_bucket", start.alias("_start"))
    inside = Window.partitionBy(*own, "_bucket").orderBy("_h", F.col("_id").asc_nulls_first(), "n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    summed = dealt.withColumn("_upto", F.sum("n_tokens").over(inside))
    at = summed.alias("d").join(starts.alias("b"), [*[F.col(f"d.{n}").eqNullSafe(F.col(f"b.{n}")) for n in own], F.col("d._bucket") == F.col("b._bucket")])
    partial = F.greatest(F.lit(0).cast("long"), F.least(F.col("n_tokens"), F.col("_part") - F.col("_start") - F.col("_upto") + F.col("n_tokens")))
    taken = at.select("_id", *[F.col(f"d.{n}") for n in own], "n_tokens", F.col("_full").alias("full_epochs"), partial.alias("partial_tokens"))
    taken = taken.withColumn("tokens_taken", F.col("full_epochs") * F.col("n_tokens") + F.col("partial_tokens")).where("tokens_taken > 0")
    return taken.select(F.col("_id").alias(id_col), *[F.col(o).alias(n) for o, n in zip(own, names, strict=True)], *TAKEN)
