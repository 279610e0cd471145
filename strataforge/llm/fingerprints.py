"""Document fingerprints by consistent weighted sampling, in native expressions.

A document is the multiset of its five-word shingles; the weight of a shingle is its count. Every shingle draws
r, c ~ Gamma(2, 1) and beta ~ U(0, 1) from its hash, and its weight w gives

    t = floor(ln w / r + beta),    ln a = ln c - r (t - beta + 1).

The smallest a wins, and the sample is (shingle, t): two documents draw the same sample with the probability of
their generalised Jaccard similarity. A shingle's weight is dealt out in units: its i-th copy goes to one of ``BINS``
bins, chosen by a hash of (shingle, i), and in each bin the shingle draws with the units that it has there, so a text
costs at most one draw per word instead of ``BINS`` per shingle. Likeness is the share of equal samples among the bins
that either document fills; bins that neither fills say nothing. Units of both documents are nested, so the least of
two weights is the sum of the least weights in the bins; and as all units are dealt alike, each of the heavier text's
is as likely to win a filled bin as any other, so the estimate is unbiased whatever the weights (one permutation
hashing, on units).

Defined results: null and wordless texts have an empty fingerprint, and two empty ones have likeness 1. Texts with
fewer than five words are one shingle. Equal texts have equal fingerprints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .columns import long_array, range_bounds, range_of, shuffle_partitions, uniform, words

SHINGLE = 5
BINS = 128
_SAMPLE_BITS = 16
_LONG_MIN = -(1 << 63)
#: At most so many ranges of ids; each is sorted on its own and may spill.
MAX_RANGES = 16384


def draws(shingles: DataFrame, keys: list[str]) -> DataFrame:
    """Samples (keys, sample) of weighted shingles (keys, h, w); the winner of each bin, one row each.

    ``h`` is the shingle's hash and null for a document without words, which keeps a row with a null sample.
    """
    h = F.col("h")
    unit = F.explode(F.sequence(F.lit(1), F.col("w").cast("int"))).alias("_u")
    place = F.when(h.isNotNull(), F.xxhash64(h, F.col("_u"), F.lit(19)).bitwiseAND(F.lit(BINS - 1)).cast("int"))
    units = shingles.select(*keys, "h", unit).select(*keys, "h", place.alias("bin")).groupBy(*keys, "h", "bin").agg(F.count(F.lit(1)).alias("w"))
    drawn = (
        units.withColumns({"g1": F.xxhash64(h, F.col("bin"), F.lit(11)), "g2": F.xxhash64(h, F.col("bin"), F.lit(13))})
        .withColumns(
            {
                "r": -F.ln(uniform(F.col("g1"), True) * uniform(F.col("g1"), False)),
                "c": F.ln(-F.ln(uniform(F.col("g2"), True) * uniform(F.col("g2"), False))),
                "b": uniform(F.xxhash64(h, F.col("bin"), F.lit(23)), True),
            }
        )
        .withColumn("k", F.floor(F.ln("w") / F.col("r") + F.col("b")))
        .select(
            *keys,
            "bin",
            F.when(
                h.isNotNull(),
                F.shiftleft(((F.col("c") - F.col("r") * (F.col("k") - F.col("b") + 1) + 128) * float(1 << 32)).cast("bigint"), _SAMPLE_BITS)
                .bitwiseOR(F.xxhash64(h, F.col("k"), F.lit(17)).bitwiseAND(F.lit((1 << _SAMPLE_BITS) - 1))),
            ).alias("a"),
        )
    )
    least = drawn.groupBy(*keys, "bin").agg(F.min("a").alias("a"))
    low = F.col("a").bitwiseAND(F.lit((1 << _SAMPLE_BITS) - 1))
    return least.select(*keys, F.shiftleft(F.col("bin"), _SAMPLE_BITS).bitwiseOR(low.cast("int")).alias("sample"))


def weighted_shingles(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, h, w): the distinct shingles of each text and their counts. ``keys`` identify a row of ``texts``.

    If ``texts`` is partitioned by some of the keys, neither this nor ``draws`` shuffles.
    """
    split = texts.select(*keys, words(F.col(text), r"\s+").alias("_w"))
    at = split.select(*keys, "_w", F.explode(F.sequence(F.lit(0), F.greatest(F.size("_w") - SHINGLE, F.lit(0)))).alias("_i"))
    h = F.when(F.size("_w") > 0, F.xxhash64(F.lit(0), *[F.get("_w", F.col("_i") + j) for j in range(SHINGLE)]))
    return at.select(*keys, h.alias("h")).groupBy(*keys, "h").agg(F.count(F.lit(1)).alias("w"))


def as_text(signature: Column) -> Column:
    """Six hexadecimal digits per filled bin."""
    return F.array_join(F.transform(signature, lambda x: F.lpad(F.hex(x), 6, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated generalised Jaccard similarity of two signatures, 0 to 1."""
    bins = lambda s: F.transform(s, lambda x: F.shiftright(x, _SAMPLE_BITS))
    filled = F.size(F.array_union(bins(a), bins(b)))
    return F.when(filled == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / filled.cast("double"))


def dealt_with_next(docs: DataFrame, key: str) -> DataFrame:
    """Rows of ``docs`` dealt out to ranges of ``key``, so that a row's successor is in its own range.

    Adds ``range`` and ``tail``: a range also gets, with tail = 1, the first rows of the range after it (after the
    last: of the first range). Ranges are cut at quantiles of the key, so no window has to span the table. Null keys
    come first.
    """
    spark = docs.sparkSession
    ordered = docs.withColumn("_k", F.coalesce(F.col(key).cast("bigint"), F.lit(_LONG_MIN)))
    bounds = range_bounds(ordered, "_k", min(4 * shuffle_partitions(spark), MAX_RANGES))
    ordered = ordered.withColumn("_range", range_of(F.col("_k"), bounds))
    firsts = {r["_range"]: r["f"] for r in ordered.groupBy("_range").agg(F.min("_k").alias("f")).collect()}
    used = sorted(firsts)
    before = {r: used[i - 1] for i, r in enumerate(used)}
    first = long_array([firsts.get(i, _LONG_MIN) for i in range(len(bounds) + 1)])
    previous = long_array([before.get(i, i) for i in range(len(bounds) + 1)]).cast("array<int>")
    place = lambda r, tail: F.struct(r.alias("range"), F.lit(tail).alias("tail"))
    own = F.array(place(F.col("_range"), 0))
    both = F.array(place(F.col("_range"), 0), place(F.get(previous, F.col("_range")), 1))
    dealt = ordered.withColumn("_to", F.explode(F.when(F.col("_k") == F.get(first, F.col("_range")), both).otherwise(own)))
    return dealt.select(*docs.columns, "_to.range", "_to.tail").repartition(4 * shuffle_partitions(spark), "range")


def edited(text: Column, following: Column) -> Column:
    """``text`` with its last floor(n/2) code points replaced by the first as many, or all, of ``following``."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.left(text, n - half), F.left(following, half))


def fingerprint_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, with likenesses; one row per input row.

    The texts are shuffled once, by range of the key; all grouping happens inside a range. Rows of equal keys follow
    one another in the order of their texts.
    """
    dealt = dealt_with_next(docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("t")), key)
    w = Window.partitionBy("range").orderBy("tail", F.col(key).asc_nulls_first(), "t")
    placed = dealt.select("range", "tail", key, "t", F.lead("t").over(w).alias("n"), F.row_number().over(w).alias("rn"))
    with_edit = placed.withColumn("e", F.when(F.col("tail") == 0, edited(F.col("t"), F.col("n"))))

    both = F.array(F.struct(F.lit(0).alias("kind"), F.col("t").alias("t")), F.struct(F.lit(1).alias("kind"), F.col("e").alias("t")))
    texts = with_edit.select("range", "rn", F.explode(both).alias("x")).select("range", "rn", "x.kind", "x.t")
    keys = ["range", "rn", "kind"]
    sampled = draws(weighted_shingles(texts, keys, "t"), keys)
    of = lambda kind: F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.col("sample"))))
    signed = sampled.groupBy("range", "rn").agg(of(0).alias("s"), of(1).alias("es"))
    signed = signed.withColumn("ns", F.lead("s").over(Window.partitionBy("range").orderBy("rn")))

    own = with_edit.where("tail = 0").select(
        "range", "rn", key, F.char_length("t").cast("bigint").alias("n_chars"), F.sha2(F.col("e").cast("binary"), 256).alias("edited_sha256")
    )
    return own.join(signed.hint("merge"), ["range", "rn"]).select(
        key, "n_chars", "edited_sha256", as_text(F.col("s")).alias("fingerprint"), as_text(F.col("es")).alias("edited_fingerprint"),
        likeness(F.col("s"), F.col("es")).alias("near_edited"), likeness(F.col("s"), F.col("ns")).alias("near_next"),
    )
