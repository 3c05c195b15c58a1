"""Mixing sources to target weights by Poisson replication.

A source with share w of the target and size n (characters) gets the mean repetition rate w * total / n; a document
is repeated k times, k being the inverse of the Poisson distribution at a number hashed from the seed and the
document's id.  The copies are then shuffled globally by a hash of seed, id and copy number.

Edge cases: a NULL source is a source of its own; a NULL id hashes as '~'; repeated rows of one id get the same
count each; an empty or NULL text has size 0 but is repeated at its source's rate; a source of size 0 has the rate 1;
an empty table gives no rows; other columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.llm.common import bits52, fresh, join_small, shared, text_of, unit_hash

# Without given weights a source's weight is its size to this power (below 1 small sources gain).
TEMPERATURE = 0.5
SEED = 20_240
# A rate above STEP is made of equal parts of at most STEP, each drawn by itself; TERMS covers such a part to 1e-30.
STEP = 32.0
TERMS = 128


def source_rates(docs: DataFrame, source: str = "source", text: str = "text", weights: DataFrame | None = None,
                 temperature: float = TEMPERATURE, total: int | None = None) -> DataFrame:
    """(source, size, rate) per source; ``weights`` (source, weight) names the targets, sources it lacks get none;
    ``total`` is the size of the mixture, that of the input unless given."""
    sizes = docs.groupBy(F.col(source).alias("source")).agg(F.sum(F.length(text_of(text)).cast("long")).alias("size"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.pow(F.col("size").cast("double"), F.lit(temperature)))
    else:
        w = weights.select(F.col("source").alias("w_source"), F.col("weight").cast("double").alias("weight"))
        sizes = sizes.join(w, F.col("source").eqNullSafe(F.col("w_source")), "left").drop("w_source").fillna(0.0, ["weight"])
    sizes = shared(sizes)
    all_size, all_weight = sizes.agg(F.sum("size"), F.sum("weight")).first()
    goal = float(total if total is not None else (all_size or 0))
    rate = F.when(F.col("size") > 0, F.col("weight") / F.lit(float(all_weight or 1) or 1.0) * F.lit(goal) / F.col("size"))
    return sizes.select("source", "size", F.coalesce(rate, F.lit(1.0)).alias("rate"))


def poisson_parts(rate: Column) -> tuple[Column, Column]:
    """How many parts a rate is drawn in, and the distribution function of one part as an array over 0..TERMS."""
    parts = F.greatest(F.lit(1), F.ceil(rate / STEP)).cast("int")
    lam = rate / parts
    first = F.exp(-lam)
    start = F.struct(first.alias("p"), first.alias("c"), F.array(first).alias("all"))

    def step(a, k):
        p = a["p"] * lam / k
        return F.struct(p.alias("p"), (a["c"] + p).alias("c"), F.concat(a["all"], F.array(a["c"] + p)).alias("all"))

    return parts, F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, step, lambda a: a["all"])


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", weights: DataFrame | None = None,
        temperature: float = TEMPERATURE, total: int | None = None, seed: int = SEED) -> DataFrame:
    """The mixture: the columns of ``docs``, copy (1, 2, ...) and shuffle_key (long).

    Rows are dealt over the partitions by the hash of shuffle_key and sorted by it within each, so every partition
    is a random sample in random order and a hot source spreads evenly."""
    name, parts, cdf, copy, key = fresh(docs, "mix_source", "mix_parts", "mix_cdf", "copy", "shuffle_key")
    rates = source_rates(docs, source, text, weights, temperature, total)
    n, table = poisson_parts(F.col("rate"))
    label = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("~"))
    side = rates.select(label.alias(name), n.alias(parts), table.alias(cdf))
    marked = docs.withColumn(name, F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("~")))
    joined = join_small(marked, side, name)
    drawn = F.aggregate(
        F.sequence(F.lit(1), F.col(parts)), F.lit(0),
        lambda a, j: a + F.size(F.filter(F.col(cdf), lambda c: c <= unit_hash(F.lit(seed), F.col(doc_id), F.lit("n"), j))))
    many = joined.withColumn(copy, drawn).where(F.col(copy) > 0)
    copies = many.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.sequence(F.lit(1), F.col(copy))).alias(copy))
    dealt = copies.withColumn(key, bits52(F.lit(seed), F.col(doc_id), F.lit("at"), F.col(copy)))
    return dealt.repartition(F.col(key)).sortWithinPartitions(key, doc_id, copy)
