"""Mixing sources to target weights by hierarchical budgets (DataFrame operations only).

The corpus is a tree: domain, language, source. A token budget enters at the root and is split at each
level in proportion to the children's weights. A child never gets more than its capacity (its tokens
times ``max_epochs``); what it cannot take is shared among its siblings by their weights, and leaves
for the level above only once all of them are full, because a parent's capacity is the sum of its
children's. All amounts are whole tokens, so the leaves' budgets sum exactly to the budget, or to the
corpus' capacity where that is less.

A leaf's budget is ``full`` epochs of all its documents and a rest; the rest is filled with the longest
prefix of documents, in the order md5("seed:epoch:doc_id"), whose tokens fit. To find the prefix, tokens are
summed by the digest's first 12 bits; only the one bucket of a leaf in which the rest runs out is
ordered row by row, so a hot source is never sorted whole.

Defined cases: a null text has no tokens, and a leaf without tokens gives nothing; null and empty source or lang are the leaf "(none)"; a weight
that is not given is 1, and a leaf whose weight is 0 or less at any level gets nothing and is no capacity; rows with equal doc_ids are ordered by
tokens, and those with equal tokens too are taken together or not at all; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import UID, WORD_RE, cut

LEVELS = ("domain", "lang", "source")
DOMAIN_WEIGHTS = {"d0": 4, "d1": 3, "d2": 2, "d3": 1}
LANG_WEIGHTS = {"en": 5, "de": 2, "es": 2, "fr": 1}
SOURCE_WEIGHTS = {"src0": 3, "src5": 2, "src10": 2}
WEIGHTS = {"domain": DOMAIN_WEIGHTS, "lang": LANG_WEIGHTS, "source": SOURCE_WEIGHTS}
NONE = "(none)"
BUCKET_DIGITS = 3
#: whole numbers beyond 64 bits, and factors whose products still are such
WHOLE, FACTOR = "decimal(38,0)", "decimal(20,0)"


def domain_of(source: Column) -> Column:
    """The domain of a source: d0 to d3 by the number at its end, d0 without one."""
    n = F.regexp_extract(source, "([0-9]{1,9})$", 1).try_cast("int")
    return F.concat(F.lit("d"), F.coalesce(n % 4, F.lit(0)).cast("string"))


def _weight(column: str, weights: dict[str, int]) -> Column:
    out = F.lit(1).cast("long")
    for k, v in sorted(weights.items()):
        out = F.when(F.col(column) == k, F.lit(v).cast("long")).otherwise(out)
    return out


def _total(rows: DataFrame, keys: list[str], name: str, value: Column, wide: bool) -> DataFrame:
    """rows with the sum of ``value`` over each set of equal keys; where that may be any number of rows, summed
    before it is shuffled and joined back."""
    value = F.coalesce(F.sum(value) if wide else F.sum(value).over(Window.partitionBy(*keys)), F.lit(0)).alias(name)
    return rows.join(rows.groupBy(*keys).agg(value), keys) if wide else rows.withColumn(name, value)


def running(rows: DataFrame, keys: list[str], order: list[str], sums: dict[str, str], wide: bool) -> DataFrame:
    """rows with, for every new name in ``sums``, the sum of its column over the rows of the same keys that come
    before. ``order`` must tell all rows of a key apart. ``wide`` is for keys of any number of rows: these are dealt
    out by ranges of keys and order, so that one key is many tasks; a range's rows add to the sum of the ranges before,
    of which there are few."""
    window = lambda by, within: Window.partitionBy(*by).orderBy(*within).rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c, by, within: F.coalesce(F.sum(c).over(window(by, within)), F.lit(0)).cast(WHOLE)
    if not wide:
        return rows.withColumns({new: before(c, keys, order) for new, c in sums.items()})
    # written once: the ranges are drawn by sampling, so another run could draw others
    ranged = cut(rows.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    parts = ranged.groupBy(*keys, "_range").agg(*(F.sum(c).alias(f"_sum{i}") for i, c in enumerate(sums.values())))
    parts = parts.select(*keys, "_range", *(before(f"_sum{i}", keys, ["_range"]).alias(f"_upto{i}") for i in range(len(sums))))
    told = ranged.join(parts, [*keys, "_range"])
    told = told.withColumns({new: (F.col(f"_upto{i}") + before(c, [*keys, "_range"], order)).cast(WHOLE) for i, (new, c) in enumerate(sums.items())})
    return told.drop("_range", *(f"_upto{i}" for i in range(len(sums))))


def split_budget(nodes: DataFrame, parent: list[str], name: str, weights: dict[str, int], wide: bool = False) -> DataFrame:
    """nodes (parent.., name, cap, parent_budget) with ``budget``: each parent's split among children.

    With children in ascending order of cap / weight, those are full whose cap is at most their share of
    what the fuller ones leave; the rest share the remainder by weight, rounded so that it is used up.
    Weights still to come are the total less those before, so every sum is a running one; products are
    decimals of 38 digits, which no corpus outgrows. ``wide`` where a parent can have any number of children."""
    n = nodes.withColumn("w", _weight(name, weights)).withColumn("_all", F.lit(0))
    keys = parent or ["_all"]
    zero = n.where("w <= 0").withColumn("budget", F.lit(0).cast("long")).drop("w", "_all")
    n = n.where("w > 0").withColumn("ratio", F.col("cap") * F.lit(1.0) / F.col("w"))
    n = running(n, keys, ["ratio", name], {"cap_before": "cap", "w_before": "w"}, wide)
    n = _total(n, keys, "w_all", F.col("w"), wide)
    n = n.withColumn("full", F.expr(f"cap * cast(w_all - w_before as {FACTOR}) <= cast(parent_budget - cap_before as {FACTOR}) * w"))
    n = n.drop("ratio", "cap_before", "w_before", "w_all")
    n = cut(n, "full") if wide else n
    n = _total(_total(n, keys, "taken", F.when(F.col("full"), F.col("cap")), wide), keys, "w_sum", F.when(~F.col("full"), F.col("w")), wide)
    n = running(n, [*keys, "full"], [name], {"s": "w"}, wide)
    part = lambda upto: f"cast(parent_budget - taken as {FACTOR}) * cast({upto} as {FACTOR}) div w_sum"
    n = n.withColumn("budget", F.when(F.col("full"), F.col("cap")).otherwise(F.expr(f"{part('s + w')} - {part('s')}")))
    return n.drop("full", "taken", "w_sum", "s", "w", "_all").unionByName(zero)


def leaf_plan(leaves: DataFrame, numerator: int, denominator: int, max_epochs: int, weights: dict) -> DataFrame:
    """leaves (domain, lang, source, tokens) -> full, rest, epoch: what each leaf gives."""
    # what a leaf without weight at any level could take is no capacity of its ancestors either
    can = F.least(*(_weight(level, weights[level]) for level in LEVELS)) > 0
    at = leaves.withColumn("cap", F.when(can, F.col("tokens") * max_epochs).otherwise(F.lit(0).cast("long")))
    total = at.agg(F.expr(f"coalesce(sum(tokens), 0L) * {numerator} div {denominator}")).first()[0]
    budgets = None
    for i, level in enumerate(LEVELS):
        parent, names = list(LEVELS[:i]), list(LEVELS[: i + 1])
        caps = at.groupBy(*names).agg(F.sum("cap").alias("cap"))
        nodes = caps.withColumn("parent_budget", F.lit(total).cast("long")) if budgets is None else caps.join(budgets, parent)
        budgets = split_budget(nodes, parent, level, weights[level], wide=level == LEVELS[-1]).select(*names, F.col("budget").alias("parent_budget"))
    plan = at.join(budgets, list(LEVELS)).withColumnRenamed("parent_budget", "budget")
    full = F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(F.lit(0).cast("long"))
    return plan.withColumn("full", full).select(*LEVELS, "full", (F.col("budget") - F.col("full") * F.col("tokens")).alias("rest"))


def copies(docs: DataFrame, extra: tuple[str, ...] = (), numerator: int = 4, denominator: int = 5, max_epochs: int = 2, seed: int = 17, weights: dict = WEIGHTS) -> DataFrame:
    """doc_id, domain, lang, source, n_tokens, copies (how often the mixture takes the document) for
    every row, and the columns ``extra`` of docs."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    leaf = lambda c: F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) == "", F.lit(NONE)).otherwise(F.col(c).cast("string"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), domain_of(leaf("source")).alias("domain"), leaf("lang").alias("lang"), leaf("source").alias("source"),
        F.regexp_count(text, F.lit(WORD_RE)).cast("long").alias("n_tokens"), *extra,
    )
    rows = cut(rows, "mixing")
    leaves = cut(rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens")), "leaves")
    plan = cut(leaf_plan(leaves, numerator, denominator, max_epochs, weights), "plan")
    rows = rows.join(plan, list(LEVELS))
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("full").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    rows = rows.withColumn("h", h).withColumn("bucket", F.substring("h", 1, BUCKET_DIGITS))
    # the bucket in which each leaf's rest runs out
    sums = rows.groupBy(*LEVELS, "bucket").agg(F.sum("n_tokens").alias("bucket_tokens"), F.first("rest").alias("rest"))
    upto = F.sum("bucket_tokens").over(Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    edge = (
        sums.withColumn("upto", upto).where("upto > rest").groupBy(*LEVELS)
        .agg(F.min("bucket").alias("edge"), F.min_by(F.col("rest") - F.col("upto") + F.col("bucket_tokens"), "bucket").alias("room"))
    )
    rows = rows.join(cut(edge, "edge"), list(LEVELS), "left")
    order = Window.partitionBy(*LEVELS).orderBy("h", "doc_id", "n_tokens")
    within = rows.where("bucket = edge")
    # a range frame: rows of the same id and tokens are peers and count together
    within = within.withColumn("more", (F.sum("n_tokens").over(order.rangeBetween(Window.unboundedPreceding, 0)) <= F.col("room")).cast("long"))
    outside = rows.where("edge is null or bucket <> edge").withColumn("more", F.expr("case when edge is null or bucket < edge then 1L else 0L end"))
    # a leaf whose rest is 0 gives no more than its full epochs
    more = F.when(F.col("rest") > 0, F.col("more")).otherwise(F.lit(0).cast("long"))
    return within.unionByName(outside).select("doc_id", *LEVELS, "n_tokens", (F.col("full") + more).alias("copies"), *extra)


def mix(docs: DataFrame, numerator: int = 9, denominator: int = 10, max_epochs: int = 1, seed: int = 17, weights: dict = WEIGHTS) -> DataFrame:
    """``docs`` (a table on disk) as the mixture has them: each row as often as it is taken."""
    told = docs.withColumn(UID, F.monotonically_increasing_id())
    taken = copies(told.select("doc_id", "text", "lang", "source", UID), (UID,), numerator, denominator, max_epochs, seed, weights)
    out = told.join(taken.where("copies > 0").select(UID, F.col("copies").alias(UID + "_copies")), UID)
    if max_epochs > 1:
        out = out.withColumn(UID + "_epoch", F.explode(F.expr(f"sequence(1L, {UID}_copies)")))
    return out.select(*docs.columns)


def sql(numerator: int = 4, denominator: int = 5, max_epochs: int = 2, seed: int = 17, weights: dict = WEIGHTS) -> str:
    """The same in DuckDB SQL, over the view documents."""
    weight_sql = lambda level: "CASE " + " ".join(f"WHEN {level} = '{k}' THEN {v}" for k, v in sorted(weights[level].items())) + " ELSE 1 END"
    level_sql, of = [], "SELECT CAST(coalesce(sum(tokens), 0) AS BIGINT) * %d // %d AS parent_budget FROM leaves" % (numerator, denominator)
    level_sql.append(f"b0 AS ({of})")
    for i, level in enumerate(LEVELS):
        parent, names = list(LEVELS[:i]), list(LEVELS[: i + 1])
        part = f"PARTITION BY {', '.join(parent)}" if parent else ""
        w = weight_sql(level)
        join = f"JOIN b{i} USING ({', '.join(parent)})" if parent else "CROSS JOIN b0"
        comma = lambda *x: ", ".join(filter(None, x))
        full_part = f"PARTITION BY {comma(*parent, 'is_full')}"
        level_sql.append(f"""
        n{i} AS (SELECT {', '.join(names)}, cap, parent_budget, {w} AS w
                 FROM (SELECT {', '.join(names)}, CAST(sum(cap) AS BIGINT) AS cap FROM leaves GROUP BY ALL) {join} WHERE {w} > 0),
        l{i} AS (SELECT *, parent_budget - coalesce(sum(cap) OVER ({part} ORDER BY cap * 1.0 / w, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_budget,
                 sum(w) OVER ({part} ORDER BY cap * 1.0 / w, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_after FROM n{i}),
        f{i} AS (SELECT *, cap * w_after <= left_budget * w AS is_full FROM l{i}),
        r{i} AS (SELECT *, parent_budget - coalesce(sum(cap) FILTER (is_full) OVER ({part}), 0) AS rest, sum(w) FILTER (NOT is_full) OVER ({part}) AS w_sum,
                 sum(w) OVER ({full_part} ORDER BY {level} ROWS UNBOUNDED PRECEDING) AS s FROM f{i}),
        b{i + 1} AS (SELECT {', '.join(names)}, CAST(CASE WHEN is_full THEN cap ELSE rest * s // w_sum - rest * (s - w) // w_sum END AS BIGINT) AS parent_budget FROM r{i})""")
    keys = ", ".join(LEVELS)
    return f"""
    WITH named AS (SELECT doc_id, coalesce(nullif(lang, ''), '{NONE}') AS lang, coalesce(nullif(source, ''), '{NONE}') AS source,
                          CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+')) AS BIGINT) AS n_tokens FROM documents),
    docs AS (SELECT *, 'd' || coalesce(TRY_CAST(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS INT) % 4, 0) AS domain FROM named),
    leaves AS (SELECT {keys}, CAST(sum(n_tokens) AS BIGINT) AS tokens,
                      CASE WHEN least({', '.join(map(weight_sql, LEVELS))}) > 0 THEN CAST(sum(n_tokens) AS BIGINT) * {max_epochs} ELSE 0 END AS cap FROM docs GROUP BY {keys}),
    {', '.join(level_sql)},
    plan AS (SELECT {keys}, CASE WHEN tokens > 0 THEN coalesce(parent_budget, 0) // tokens ELSE 0 END AS epochs, tokens, coalesce(parent_budget, 0) AS parent_budget
             FROM leaves LEFT JOIN b3 USING ({keys})),
    placed AS (SELECT *, parent_budget - epochs * tokens AS rest, md5('{seed}:' || epochs || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM docs JOIN plan USING ({keys})),
    summed AS (SELECT *, sum(n_tokens) OVER (PARTITION BY {keys} ORDER BY h, doc_id, n_tokens) AS upto FROM placed)
    SELECT doc_id, domain, lang, source, n_tokens, CAST(epochs + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS BIGINT) AS copies FROM summed"""
