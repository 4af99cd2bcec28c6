"""Mixing sources to target weights by Poisson replication.

Each source has a mean repetition rate: its target share of the text over its present share. A document comes
as often as the inverse of a Poisson distribution with that mean says at the document's own
hash, so copies are drawn independently of order and partitions, and a repeated task draws alike. Documents
are unfolded by their counts; a hash of id and copy deals the copies to partitions and orders them there.

Means above ``PART`` are drawn as sums of equal parts, which are Poisson again, so no mean underflows.

Defined results: null is a source of its own; so a null text counts no characters. Sources without any characters keep
rate 1. Sources with a weight of 0 are left out; those missing from ``weights`` have weight 0. Rows with equal ids
and texts draw equal counts. Columns keep their names, whatever they are; ``_copy`` and ``_order`` are added, in place of input columns
with these names. An empty table has no copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import parts_for
from tidemark.session import stage

PART = 8
TERMS = 64
BROADCAST_SOURCES = 10_000


def uniform(*parts: Column, seed: str) -> Column:
    """A number in [0, 1) of 52 bits from the md5 of the parts."""
    text = F.concat_ws("|", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def rates(
    docs: DataFrame, weights: dict[str, float] | None = None, power: float = 0.5,
    source: str = "source", text: str = "text",
) -> DataFrame:
    """(source, rate, parts, cdf), one row per source.

    Without ``weights`` the target weight of a source is its number of characters to the ``power``:
    1 keeps the mix, 0 makes all sources equal. The total of characters stays as it is.
    """
    sizes = docs.groupBy(F.col(source).alias("_source")).agg(F.sum(F.length(text)).alias("_chars"))
    sizes = sizes.withColumn("_chars", F.coalesce("_chars", F.lit(0)))
    if weights is None:
        weight = F.pow(F.col("_chars").cast("double"), F.lit(power))
    else:
        weight = F.coalesce(
            *[F.when(F.col("_source") == name, F.lit(float(w))) for name, w in weights.items()], F.lit(0.0)
        )
    sizes = sizes.withColumn("_weight", weight)
    totals = sizes.agg(F.sum("_chars").alias("_all"), F.sum("_weight").alias("_weights"))
    rate = F.when(
        (F.col("_chars") > 0) & (F.col("_weights") > 0),
        F.col("_weight") / F.col("_weights") * F.col("_all") / F.col("_chars"),
    ).otherwise(F.lit(1.0))
    # one row of totals
    found = sizes.join(F.broadcast(totals)).select(
        "_source", F.floor(rate * 1e9 + 0.5).alias("_nanos")
    )
    parts = F.greatest(F.ceil(F.col("_nanos") / (PART * 1e9)), F.lit(1))
    found = found.withColumn("_parts", parts.cast("int")).withColumn("_mean", F.col("_nanos") / 1e9 / F.col("_parts"))
    steps = F.aggregate(
        F.sequence(F.lit(1), F.lit(TERMS)),
        F.struct(F.exp(-F.col("_mean")).alias("p"), F.array(F.exp(-F.col("_mean"))).alias("cdf")),
        lambda acc, k: F.struct(
            (acc["p"] * F.col("_mean") / k).alias("p"),
            F.array_append(acc["cdf"], F.element_at(acc["cdf"], -1) + acc["p"] * F.col("_mean") / k).alias("cdf"),
        ),
        lambda acc: acc["cdf"],
    )
    return found.select("_source", (F.col("_nanos") / 1e9).alias("_rate"), "_parts", steps.alias("_cdf"))


def mix(
    docs: DataFrame, weights: dict[str, float] | None = None, power: float = 0.5, seed: str = "mix",
    key: str = "doc_id", source: str = "source", text: str = "text", shuffle: bool = True,
) -> DataFrame:
    """Documents by their counts, with ``_copy`` from 1 and ``_order``, the place of a copy in the new order."""
    shares = stage(rates(docs, weights, power, source, text), "rates")
    few = shares.select("_source").limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    shares = F.broadcast(shares) if few else shares  # beyond that AQE joins and splits a hot source
    ident = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("text "), F.md5(F.col(text))))
    # the row travels as one value, so that its columns may have any names
    own = [c for c in docs.columns if c not in ("_copy", "_order")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("_row"), F.col(source).alias("_named"), ident.alias("_ident"), F.col(key).alias("_key"))
    joined = rows.join(shares, F.col("_named").eqNullSafe(F.col("_source")))
    draws = F.transform(
        F.sequence(F.lit(1), F.col("_parts")),
        lambda j: uniform(F.col("_ident"), j, seed=seed),
    )
    count = F.aggregate(
        draws, F.lit(0), lambda acc, u: acc + F.size(F.filter("_cdf", lambda c: c <= u))
    )
    copies = joined.withColumn("_count", count).where("_count > 0").withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.col("_count")))
    )
    copies = copies.select(
        "_row", "_key", "_copy", uniform(F.col("_ident"), F.col("_copy"), seed=f"{seed}-order").alias("_order")
    )
    if shuffle:
        copies = copies.repartition(parts_for(docs), "_order").sortWithinPartitions("_order", "_key", "_copy")
    return copies.select("_row.*", "_copy", "_order")
