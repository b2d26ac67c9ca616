"""Mixing sources to target weights by Sainte-Lague apportionment.

The mix is counted in blocks of equally many words. Water-filling turns the
weights into a word target per source; the blocks of the mix go to the sources
by highest quotients target / (2 k + 1), and each source's blocks to its
shards (hash slices of its documents) the same way, by their words. Within a
shard the documents lie end to end in a seeded order; a quota above the
shard's blocks takes whole passes, and the rest is a seeded, evenly spaced
choice of blocks. What a document contributes then follows from its word range
alone, so blocks are never materialised.

Only DataFrame functions run here. Windows are taken over a shard (about
SHARD_WORDS words, however large its source) or over one row per source; no
window or task holds a whole source, nor all rows of one id or none; a source
of more than REGION shards shares its blocks among regions of shards first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import written

#: Weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
BLOCK_WORDS = 64
SHARD_WORDS = 100_000
REGION = 1000
SEED = 11
WORD = r"[^\x20\x09-\x0D]+"


def _number(*parts: Column) -> Column:
    """60 seeded bits, as SQL engines agree on them."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("long")


def apportion(parties: DataFrame, votes: str, seats: str, group: list[str], order: list[str], out: str) -> DataFrame:
    """Sainte-Lague: ``seats`` (one value per group) go to the parties of each
    group by the highest quotients votes / (2 k + 1), equal quotients in
    ``order``.

    With S parties the last quotient seated lies between total / (2 (seats +
    S/2)) and total / (2 (seats - S/2)); a party's seats below that range are
    sure, so only about 4 S quotients are made into rows and ranked.
    """
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(1))
    base = parties.withColumn("_all", F.sum(votes).over(whole)).withColumn("_most", F.count("*").over(whole))
    sure = F.floor(F.col(votes) * (F.col(seats) - F.col("_most") / 2) / F.col("_all") - 0.5)
    base = base.withColumn("_sure", F.when(F.col("_all") > 0, F.greatest(sure, F.lit(0))).otherwise(0).cast("long"))
    base = base.withColumn("_open", F.col(seats) - F.sum("_sure").over(whole))
    bids = F.when((F.col(votes) > 0) & (F.col("_open") > 0),
                  F.sequence(F.lit(1), F.ceil(F.col("_most") * F.col(votes) / F.col("_all")).cast("int") + 3))
    base = base.withColumn("_bid", F.explode_outer(bids))
    quotient = F.col(votes) / (2 * (F.col("_sure") + F.col("_bid")) - 1)
    rank = F.row_number().over(whole.orderBy(quotient.desc_nulls_last(), *(F.col(c).asc_nulls_last() for c in order)))
    won = (F.col("_bid").isNotNull() & (rank <= F.col("_open"))).cast("long")
    keep = [F.col(c) for c in parties.columns]
    return base.withColumn("_won", won).groupBy(*keep, "_sure").agg(F.sum("_won").alias("_w")).select(
        *keep, (F.col("_sure") + F.col("_w")).alias(out))


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE) -> DataFrame:
    """Words per source (source, source_size, no) -> with ``target``.

    The level is the least at which the sources capped at twice their size and
    the others, by weight, add up to the mix: the fixed point of resharing the
    excess. A source without words gets 0.
    """
    pick = reduce(lambda c, kv: c.when(F.col("no") % len(weights) == kv[0], F.lit(kv[1])),
                  enumerate(weights), F.when(F.lit(False), F.lit(0)))
    one = Window.partitionBy(F.lit(1))
    by_cap = one.orderBy(F.col("source_size") / F.col("w"), "no")
    d = sources.withColumn("w", pick.cast("long"))
    d = d.withColumn("mix", F.sum("source_size").over(one) * F.lit(float(share)))
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("capped", F.coalesce(F.sum(2 * F.col("source_size")).over(before), F.lit(0)))
    d = d.withColumn("w_left", F.sum("w").over(one) - F.coalesce(F.sum("w").over(before), F.lit(0)))
    fits = (F.col("mix") - F.col("capped")) * F.col("w") / F.col("w_left") <= 2 * F.col("source_size")
    first = F.min(F.when(fits, F.struct(F.col("source_size") / F.col("w"), F.col("no"), "mix", "capped", "w_left"))).over(one)
    d = d.withColumn("at", first)
    level = (F.col("at.mix") - F.col("at.capped")) * F.col("w") / F.col("at.w_left")
    cap = (2 * F.col("source_size")).cast("double")
    return d.select("source", "source_size", "no", F.coalesce(F.least(level, cap), cap).alias("target"))


def mix_sources(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, block_words: int = BLOCK_WORDS,
                shard_words: int = SHARD_WORDS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken.

    ``taken`` counts the words the mix takes of the document, repeats counted,
    never above twice its size. Null texts have size 0 and nothing is taken of
    them; the null source is a source, last in order. Repeated rows are
    documents of their own, laid one behind the other, and one row until they
    are. Long texts are counted whole. No rows give no rows; other columns are
    ignored. The same rows always give the same mix.
    """
    rows = written(_counted(_sized(docs)), "sizes")
    laid = _with_quotas(rows, rows, weights, share, block_words, shard_words, seed)
    in_shard = Window.partitionBy("no", "shard").orderBy("at", F.col("doc_id").asc_nulls_first(), "digest")
    before = F.coalesce(F.sum(F.col("size") * F.col("copies")).over(in_shard.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    laid = laid.withColumn("before", before).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    laid = laid.withColumn("end", F.col("before") + F.col("copy") * F.col("size"))
    # of the blocks before b, the seeded even choice takes (b * extra + phase) div n
    taken = [F.expr(
        f"passes * ({x}) + {block_words} * (((({x}) div {block_words}) * extra + phase) div n)"
        f" + (({x}) % {block_words}) * (((({x}) div {block_words} + 1) * extra + phase) div n"
        f" - ((({x}) div {block_words}) * extra + phase) div n)") for x in ("end", "end - size")]
    return laid.select("doc_id", "size", "source_size", "target", (taken[0] - taken[1]).alias("taken"))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, block_words: int = BLOCK_WORDS,
                    shard_words: int = SHARD_WORDS, seed: int = SEED) -> DataFrame:
    """The mix in whole documents: every row as often as it is taken (0, 1 or
    2 times), with its columns as they were.

    A shard's whole passes repeat all its documents; for the rest of its quota
    a seeded, even choice along the documents' sizes is taken once more, so
    that the words taken keep close to the quota. Rows alike in id, source and
    text lie in one shard; as in ``mix_sources``, null texts have no words.
    """
    sizes = written(_counted(_sized(docs)), "sizes")
    laid = _with_quotas(_sized(docs, F.struct("*").alias("doc")), sizes, weights, share, block_words, shard_words, seed)
    by_size = Window.partitionBy("no", "shard").orderBy("size", "at", F.col("doc_id").asc_nulls_first(), "digest")
    laid = laid.withColumn("i", F.row_number().over(by_size).cast("long"))
    copies = F.expr("passes + (i * extra + phase) div n - ((i - 1) * extra + phase) div n").cast("int")
    return laid.where(copies > 0).select("doc", F.explode(F.sequence(F.lit(1), copies)).alias("copy")).select("doc.*")


def _sized(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id, source, size in words, and 60 bits of the text's digest, which
    spread rows that have one id, or none, over shards."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(*more, F.col("doc_id").cast("long"), F.col("source").cast("string"), size.alias("size"),
                       _number(F.coalesce("text", F.lit(""))).alias("digest"))


def _counted(sized: DataFrame) -> DataFrame:
    """Rows alike in id, source and text as one, with their number."""
    return sized.groupBy("doc_id", "source", "size", "digest").agg(F.count("*").alias("copies"))


def _with_quotas(rows: DataFrame, sizes: DataFrame, weights, share, block_words, shard_words, seed) -> DataFrame:
    """Rows (doc_id, source, size, digest and others) with their source's target
    and their shard's quota: passes over all n blocks, extra blocks, and phase.
    ``sizes`` holds the same rows, counted, cheap to read again."""
    by_name = Window.partitionBy(F.lit(1)).orderBy(F.col("source").asc_nulls_last())
    sources = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size")).withColumn(
        "no", F.row_number().over(by_name) - 1)
    aimed = targets(sources, weights, share)
    total = F.sum("target").over(Window.partitionBy(F.lit(1)).orderBy("no").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing))
    aimed = aimed.withColumn("_seats", F.round(total / block_words).cast("long"))
    # one row per source: written once, so that every use sees the same numbers
    aimed = written(apportion(aimed, "target", "_seats", [], ["no"], "blocks").withColumn(
        "shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("long")), "mix-sources")

    def dealt(rows: DataFrame) -> DataFrame:
        key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("digest").cast("string"))
        to = aimed.select(F.col("source").alias("_s"), "no", "shards", "target", "source_size")
        return rows.join(to, F.col("source").eqNullSafe(F.col("_s"))).withColumn(
            "shard", F.pmod(_number(F.lit(f"shard{seed}"), key), F.col("shards"))).withColumn(
            "at", _number(F.lit(f"order{seed}"), key)).drop("_s", "shards")

    # source -> regions of REGION shards -> shards: no window holds more than
    # the regions of a source or the shards of a region
    shards = written(dealt(sizes).groupBy("no", "shard").agg(F.sum(F.col("size") * F.col("copies")).alias("words")).withColumn(
        "region", F.expr(f"shard div {REGION}")), "mix-shards")
    regions = shards.groupBy("no", "region").agg(F.sum("words").alias("region_words")).join(
        aimed.select("no", "blocks"), "no")
    regions = apportion(regions, "region_words", "blocks", ["no"], ["region"], "region_blocks")
    quotas = apportion(shards.join(regions.select("no", "region", "region_blocks"), ["no", "region"]),
                       "words", "region_blocks", ["no", "region"], ["shard"], "quota")
    n = F.greatest(F.ceil(F.col("words") / block_words), F.lit(1)).cast("long")
    quotas = quotas.withColumn("n", n).withColumn("q", F.least(F.col("quota"), 2 * F.col("n")))
    phase = F.pmod(_number(F.lit(f"phase{seed}"), F.col("no").cast("string"), F.col("shard").cast("string")), F.col("n"))
    quotas = quotas.select("no", "shard", "n", F.expr("q div n").alias("passes"), F.expr("q % n").alias("extra"), phase.alias("phase"))
    return dealt(rows).join(quotas, ["no", "shard"])
