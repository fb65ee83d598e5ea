"""Mixing sources to target weights with a temperature, DataFrame functions only.

A source's weight is its token share to the power ``alpha``, normalised: 1 keeps
the shares, 0 makes them equal.  ``alpha`` is bisected: the largest one whose
weights have the target entropy (as a part of the logarithm of the number of
sources), raised where the most repeated source would exceed the repetition
limit (the limit wins).  Five halvings are evaluated by one job.

The weights are realised for a budget of tokens.  A source of t tokens with the
quota q gives all its documents floor(q / t) times; of one more pass it gives the
documents that come first in a permutation of its documents, as many as fit the
rest of the quota.  The permutation orders documents by a hash, and the place of
the cut is found by digits of that hash: sums by digit, never an order of a whole
source, so a source with any share of the rows is split over all tasks.  Copies
are dealt to blocks that each hold the weights: a source's passes, the last one up
to its cut, are one line by pass and hash, and each block gets an equal part of it;
documents of a block are in the order of a second hash.

Defined cases: a null text has no tokens; a null source is a source of its own;
a source without tokens takes no part in the weights and keeps every document
once; repeated rows share their hash and stay or go together; an empty table
gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barsmith.llm.common import materialise

#: A token here is a run without white space.
TOKEN = r"[^\x20\x09-\x0D]+"
#: Digits of the permutation's hash (60 bits), bits of each, halvings by one job, jobs.
DIGITS, BITS, HALVINGS, ROUNDS = 5, 12, 5, 6
#: Blocks that each hold the weights.
BLOCKS = 64


def tokens(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(TOKEN)), F.lit(0)).cast("long")


def order_key(seed: str, source: str, doc: str) -> Column:
    """60 bits of an MD5 of the source and the document's id."""
    name = F.concat_ws("|", F.lit(seed), F.coalesce(F.col(source), F.lit("")), F.coalesce(F.col(doc).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("long")


def shares(keyed: DataFrame) -> DataFrame:
    """(source, n_tokens, share) of the sources with tokens."""
    by = keyed.groupBy("source").agg(F.sum("n_tokens").alias("n_tokens")).where("n_tokens > 0")
    return by.withColumn("share", F.col("n_tokens") / F.sum("n_tokens").over(Window.partitionBy(F.lit(0))))


def bisect_alpha(sources: DataFrame, budget_ratio: float, target_entropy: float | None, max_repeats: float | None) -> float:
    """Exponent for the sources; ``budget_ratio`` is the budget by all tokens.

    One job evaluates the ends of 2**HALVINGS parts of each interval; the part
    in which the condition changes is the next interval.
    """
    parts = 2 ** HALVINGS
    goals = [g for g, x in (("entropy", target_entropy), ("repeats", max_repeats)) if x is not None]
    at = {g: (0.0, 1.0) for g in goals}
    for _ in range(ROUNDS if goals else 0):
        grid = F.array(*[F.struct(F.lit(g).alias("goal"), F.lit(k).alias("k"), F.lit(lo + (hi - lo) * k / parts).alias("a"))
                         for g, (lo, hi) in at.items() for k in range(parts + 1)])
        power = F.pow("share", F.col("x.a"))
        rows = (sources.select("share", F.explode(grid).alias("x"))
                .groupBy("x.goal", "x.k").agg(
                    F.count("*").alias("n"), F.sum(power).alias("z"), F.sum(power * F.log("share")).alias("zl"),
                    F.max(power / F.col("share")).alias("top"), F.first("x.a").alias("a")).collect())
        if not rows:
            return 1.0
        for goal in goals:
            own = sorted((r for r in rows if r["goal"] == goal), key=lambda r: r["k"])
            if goal == "entropy":       # falls with alpha: the last place that still has it
                good = [r["k"] for r in own if math.log(r["z"]) - r["a"] * r["zl"] / r["z"] >= target_entropy * math.log(r["n"])]
                k = max(good, default=0)
            else:                       # falls with alpha: the last place that exceeds the limit
                bad = [r["k"] for r in own if budget_ratio * r["top"] / r["z"] > max_repeats]
                k = max(bad, default=-1)
                if k < 0:
                    at[goal] = (at[goal][0], at[goal][0])
                    continue
            lo, hi = at[goal]
            step = (hi - lo) / parts
            at[goal] = (lo + step * k, min(hi, lo + step * (k + 1)))
    low = at["entropy"][0] if "entropy" in at else 0.0 if "repeats" in at else 1.0
    return max(low, at["repeats"][1]) if "repeats" in at else low


def quotas(sources: DataFrame, alpha: float, budget: int) -> DataFrame:
    """(source, n_tokens, weight, passes, rest): whole passes and tokens of one more."""
    power = F.pow("share", F.lit(alpha))
    weighed = sources.withColumn("weight", power / F.sum(power).over(Window.partitionBy(F.lit(0))))
    quota = F.floor(F.col("weight") * F.lit(budget) + 1e-6)
    return weighed.select("source", "n_tokens", "weight", quota.alias("quota"),
                          F.floor(quota / F.col("n_tokens")).alias("passes"), (quota % F.col("n_tokens")).alias("rest"))


def cut_keys(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """(source, cut): the least key that no longer fits ``rest`` when documents come by key.

    Each round sums tokens by the next digit among keys that share the digits
    found so far, and takes the digit in which the sum first exceeds the rest.
    """
    found = wanted.select("source", F.lit(0).cast("long").alias("prefix"), F.col("rest").cast("long").alias("rest"))
    for d in range(1, DIGITS + 1):
        shift = BITS * (DIGITS - d)
        own = keyed.select(F.col("source").alias("s"), "n_tokens", F.shiftright("key", shift + BITS).alias("p"),
                           F.shiftright("key", shift).bitwiseAND((1 << BITS) - 1).alias("digit"))
        sums = (own.join(found, F.col("s").eqNullSafe(F.col("source")) & (F.col("p") == F.col("prefix")))
                .groupBy("source", "prefix", "rest", "digit").agg(F.sum("n_tokens").alias("t")))
        # at most 2**BITS rows for each source
        upto = F.sum("t").over(Window.partitionBy("source").orderBy("digit"))
        over = sums.withColumn("upto", upto).where(F.col("upto") > F.col("rest"))
        first = over.groupBy("source", "prefix", "rest").agg(F.min_by(F.struct("digit", "t", "upto"), "digit").alias("f"))
        found = materialise(first.select(
            "source", (F.shiftleft("prefix", BITS) + F.col("f.digit")).alias("prefix"),
            (F.col("rest") - F.col("f.upto") + F.col("f.t")).alias("rest")), "cut")
    return found.select("source", F.col("prefix").alias("cut"))


def plan(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", budget: int | None = None,
         target_entropy: float | None = 0.95, max_repeats: float | None = 4.0, seed: str = "mix") -> DataFrame:
    """(id, source, n_tokens, key, weight, copies, span) for every row; ``budget`` is in tokens (null: as many as there are).

    ``span`` is how many passes the source gets, the last one as the part of its keys before the cut.
    """
    keyed = materialise(docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                                    tokens(text_col).alias("n_tokens"), order_key(seed, source_col, id_col).alias("key")), "mix-keys")
    sources = materialise(shares(keyed), "mix-sources")
    total = sources.agg(F.sum("n_tokens")).first()[0] or 0
    budget = total if budget is None else budget
    alpha = bisect_alpha(sources, budget / total if total else 1.0, target_entropy, max_repeats)
    wanted = materialise(quotas(sources, alpha, budget), "mix-quotas")
    cuts = cut_keys(keyed, wanted.where("rest > 0"))
    rule = (wanted.join(cuts.withColumnRenamed("source", "c"), F.col("source").eqNullSafe(F.col("c")), "left")
            .select(F.col("source").alias("s"), "weight", "passes", "cut", "rest"))
    more = (F.col("rest") > 0) & (F.col("cut").isNull() | (F.col("key") < F.col("cut")))
    copies = F.when(F.col("weight").isNull(), F.lit(1)).otherwise(F.col("passes") + more.cast("long"))
    last = F.when(F.col("rest") > 0, F.coalesce(F.col("cut") / F.lit(float(1 << (BITS * DIGITS))), F.lit(1.0))).otherwise(F.lit(0.0))
    span = F.when(F.col("weight").isNull(), F.lit(1.0)).otherwise(F.col("passes").cast("double") + last)
    return (keyed.join(rule, F.col("source").eqNullSafe(F.col("s")), "left")
            .select("id", "source", "n_tokens", "key", F.coalesce("weight", F.lit(0.0)).alias("weight"), copies.cast("long").alias("copies"), span.alias("span")))


def realise(docs: DataFrame, planned: DataFrame, id_col: str = "doc_id", source_col: str = "source", blocks: int = BLOCKS, pass_col: str | None = None) -> DataFrame:
    """The rows of ``docs`` as often as planned, with ``mix_block`` and ``mix_order`` and, if named, the pass.

    Rows are looked up by (id, source); each such pair has one plan.  The new
    columns take the place of columns of these names.
    """
    docs = docs.drop("mix_block", "mix_order", *([pass_col] if pass_col else []))
    one = planned.groupBy("id", "source").agg(*(F.max(c).alias(f"_mix_{c}") for c in ("copies", "key", "span")))
    one = one.where("_mix_copies > 0").withColumnsRenamed({"id": "_mix_id", "source": "_mix_source"})
    got = docs.join(one, docs[id_col].eqNullSafe(F.col("_mix_id")) & docs[source_col].cast("string").eqNullSafe(F.col("_mix_source")))
    each = got.withColumn("_mix_pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_mix_copies") - 1)))
    place = (F.col("_mix_pass") + F.col("_mix_key") / F.lit(float(1 << (BITS * DIGITS)))) / F.col("_mix_span")
    second = F.md5(F.concat_ws("|", F.col("_mix_key").cast("string"), F.col("_mix_pass").cast("string")))
    out = (each.withColumn("mix_block", F.least(F.floor(place * blocks), F.lit(blocks - 1)).cast("int"))
           .withColumn("mix_order", F.conv(F.substring(second, 1, 15), 16, 10).cast("long")))
    if pass_col:
        out = out.withColumn(pass_col, F.col("_mix_pass"))
    return out.drop("_mix_id", "_mix_source", "_mix_copies", "_mix_key", "_mix_span", "_mix_pass")


def in_order(mixed: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """Realised rows by block and order: partition after partition, each a stretch of the orders of one block."""
    parts = -(-int(mixed.sparkSession.conf.get("spark.sql.shuffle.partitions")) // blocks)
    stretch = F.floor(F.col("mix_order") / F.lit(float(1 << (BITS * DIGITS))) * parts)
    place = (F.col("mix_block") * parts + F.least(stretch, F.lit(parts - 1))).cast("int")
    return mixed.repartitionById(blocks * parts, place).sortWithinPartitions("mix_block", "mix_order")


def oracle(target_entropy: float = 0.95, max_repeats: float = 4.0, seed: str = "mix") -> str:
    """DuckDB SQL for the plan of ``documents`` with a budget of all tokens."""
    parts = 2 ** HALVINGS
    ctes = [f"""d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{TOKEN}')), 0)::BIGINT AS n_tokens,
  ('0x' || substr(md5(concat_ws('|', '{seed}', coalesce(source, ''), coalesce(doc_id::VARCHAR, ''))), 1, 15))::BIGINT AS key FROM documents)""",
            "s AS (SELECT source, sum(n_tokens)::BIGINT AS n_tokens, sum(n_tokens) / sum(sum(n_tokens)) OVER () AS share FROM d GROUP BY source HAVING sum(n_tokens) > 0)",
            "e0 AS (SELECT 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi)", "r0 AS (SELECT 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi)"]
    for i in range(ROUNDS):
        for g, good, pick in (
                ("e", f"ln(sum(pow(share, a))) - a * sum(pow(share, a) * ln(share)) / sum(pow(share, a)) >= {target_entropy} * ln(count(*))", "coalesce(max(k), 0)"),
                ("r", f"max(pow(share, a) / share) / sum(pow(share, a)) > {max_repeats}", "max(k)")):
            ctes.append(f"{g}g{i} AS (SELECT k, a, lo, hi FROM (SELECT k, lo + (hi - lo) * k / {parts} AS a, lo, hi FROM {g}{i}, range(0, {parts + 1}) t(k)) , s GROUP BY k, a, lo, hi HAVING {good})")
            ctes.append(f"{g}{i + 1} AS (SELECT CASE WHEN k IS NULL THEN lo ELSE lo + (hi - lo) / {parts} * k END AS lo, CASE WHEN k IS NULL THEN lo ELSE least(hi, lo + (hi - lo) / {parts} * (k + 1)) END AS hi FROM {g}{i}, (SELECT {pick} AS k FROM {g}g{i}))")
    ctes += [f"al AS (SELECT greatest((SELECT lo FROM e{ROUNDS}), (SELECT hi FROM r{ROUNDS})) AS alpha)",
             "w AS (SELECT source, n_tokens, pow(share, alpha) / sum(pow(share, alpha)) OVER () AS weight FROM s, al)",
             "q AS (SELECT source, n_tokens, weight, floor(weight * (SELECT sum(n_tokens) FROM s) + 1e-6)::BIGINT AS quota FROM w)",
             "o AS (SELECT d.*, sum(n_tokens) OVER (PARTITION BY source ORDER BY key RANGE UNBOUNDED PRECEDING) AS upto FROM d)"]
    return ("WITH " + ",\n".join(ctes) + """
SELECT o.doc_id, o.source, o.n_tokens,
  CASE WHEN q.weight IS NULL THEN 1 ELSE q.quota // q.n_tokens + (CASE WHEN q.quota % q.n_tokens > 0 AND o.upto <= q.quota % q.n_tokens THEN 1 ELSE 0 END) END::BIGINT AS copies
FROM o LEFT JOIN q ON o.source IS NOT DISTINCT FROM q.source""")


def realised_oracle() -> str:
    """DuckDB SQL for the realised rows of ``documents``: that of the plan, with its last part replaced."""
    ctes = oracle().rpartition("\nSELECT o.doc_id")[0]
    keys = f"{1 << (BITS * DIGITS)}.0::DOUBLE"
    return ctes + f""",
u AS (SELECT o.source, min(o.key) FILTER (o.upto > q.quota % q.n_tokens) AS cut FROM o JOIN q ON o.source IS NOT DISTINCT FROM q.source GROUP BY o.source),
p AS (SELECT o.doc_id, o.source, o.key,
  CASE WHEN q.weight IS NULL THEN 1 ELSE q.quota // q.n_tokens + (CASE WHEN q.quota % q.n_tokens > 0 AND o.upto <= q.quota % q.n_tokens THEN 1 ELSE 0 END) END::BIGINT AS copies,
  CASE WHEN q.weight IS NULL THEN 1 ELSE (q.quota // q.n_tokens)::DOUBLE + (CASE WHEN q.quota % q.n_tokens > 0 THEN u.cut::DOUBLE / {keys} ELSE 0 END) END::DOUBLE AS span
  FROM o LEFT JOIN q ON o.source IS NOT DISTINCT FROM q.source LEFT JOIN u ON o.source IS NOT DISTINCT FROM u.source),
c AS (SELECT *, unnest(range(0, copies)) AS pass FROM p)
SELECT doc_id, source, pass, least(floor((pass::DOUBLE + key::DOUBLE / {keys}) / span * {BLOCKS}), {BLOCKS - 1})::INTEGER AS mix_block,
  ('0x' || substr(md5(concat_ws('|', key::VARCHAR, pass::VARCHAR)), 1, 15))::BIGINT AS mix_order
FROM c"""
