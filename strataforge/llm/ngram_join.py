"""Exact Jaccard self-join of documents on word n-grams by universe partitioning.

A document is the set of 64-bit hashes of its distinct ``N``-word shingles (all its words, if fewer). Two sets link if
100 |a & b| >= ``PERCENT`` |a | b|.

* **Size bands.** Bands of sizes grow by the factor ``BAND``. A band's scheme hashes the universe of shingles into m
  segments. Linked sets whose smaller one lies in the band differ in at most H shingles, H from the band's largest
  size, so at least m - H of their m segments are equal (pigeonhole). A set is cut by the scheme of its own band and of
  the band below, if partners may lie there.
* **Allocation by cost.** Per band, the number of sets (a count over all data) prices two plans: segments that must
  be equal (one signature each), or fewer, larger segments that may differ by one shingle (a signature for the segment
  and for each of its one-deletion neighbours; if every segment differed in two or more, the sets would differ in more
  than H). The first plan takes ``SPARE`` segments more than H + 1, and every set leaves out its most frequent signatures,
  ``SPARE`` or, by its own size, more, but fewer than the equal segments that a link guarantees: the least frequent of
  these is left out by neither set, whose ranking is the same for both. So signatures that many sets share, such as
  empty segments or parts of common passages, cost nothing, and no link is lost.
* **Verification.** Sets that share a signature are compared exactly. Equal sets are one class from the start, and
  buckets of the same members are one bucket. In a bucket, every member is first compared with one member, the one that
  shares most with others, as the text that the others were copied from does; members that are linked by then, directly
  or not, need no comparison with each other. In buckets that still hold several components, all remaining pairs of
  different components are compared, but for those whose parity bitmaps differ in more bits than linked sets differ in
  shingles.

``link_documents`` returns components only, for which links inside a component need not all be found; every component
is exact. ``linked_documents`` also counts the links of every document and ``link_pairs`` lists them: a link joins
members of one component, so all pairs of distinct sets of a component are compared, in blocks of at most ``BLOCK``
members and some ``BLOCK_SHINGLES`` shingles that are dealt out evenly. That work grows with the square of a
component's number of distinct sets, as its links do.

Defined results: null, empty and wordless texts have no shingles and are alone; equal texts are one class whatever
their number; null ids are not linked with others; repeated ids are one document each by their text; an empty table
gives an empty one; extra columns are ignored. Shingles and sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut, trimmed

N, PERCENT = 4, 85
BAND = 1.4
SPARE = 10
#: Price of comparing two sets, in signatures.
COMPARE = 40.0
#: Members of a component, and their shingles, that are compared with as many others at a time; shingles counted together.
BLOCK, BLOCK_SHINGLES, COLUMNS = 512, 1 << 19, 1 << 12
#: Bits of the bitmap that bounds the difference of two sets from below.
BITMAP = 512
MASK = (1 << 64) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, for uint64 arrays."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _constants():
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    space = np.zeros(256, bool)
    space[[32, 9, 10, 11, 12, 13]] = True
    base = 0x9E3779B97F4A7C15 | 1
    return lower, space, _mix(np.arange(1, 257, dtype=np.uint64)), base, pow(base, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[:1] = 1
    size = 1
    while size < n:
        step = np.uint64(pow(base, size, 1 << 64))
        out[size : 2 * size] = out[: min(size, n - size)] * step
        size *= 2
    return out


def shingle_sets(texts: list[bytes], n: int = N) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, ascending. One vectorised pass over all texts."""
    lower, space, value, base, inverse = _constants()
    if not texts:
        return []
    data = lower[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
    sizes = np.array([len(t) for t in texts], np.int64)
    firsts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    inside = ~space[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside)).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]  # the text ends with a separator
    owner = np.searchsorted(firsts, starts, "right") - 1
    # hash of a word: sum of value[byte] * base^position, moved to position 0
    powers = _powers(base, len(data) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value[data] * powers[:-1], dtype=np.uint64)))
    back = _powers(inverse, len(data) + 1)
    word = _mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))
    del powers, sums, back
    count = np.bincount(owner, minlength=len(texts))
    at = np.concatenate(([0], np.cumsum(count)))
    hashes = np.zeros(max(0, len(word) - n + 1), np.uint64)
    for j in range(n):
        hashes = _mix(hashes + word[j : len(word) - n + 1 + j]) if len(hashes) else hashes
    out = []
    for i in range(len(texts)):
        a, b = at[i], at[i + 1]
        if b - a >= n:
            out.append(np.unique(hashes[a : b - n + 1]))
        elif b > a:
            h = np.zeros(1, np.uint64)
            for x in word[a:b]:
                h = _mix(h + x)
            out.append(_mix(h + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def in_batches(texts: pa.Array, limit: int = 1 << 18) -> Iterator[np.ndarray]:
    """Shingle sets of a column of texts, some ``limit`` bytes at a time, so a worker holds little besides its batch."""
    part, size = [], 0
    for at in range(0, len(texts), 256):
        for b in texts.slice(at, 256).cast(pa.binary()).to_pylist():
            part.append(b or b"")
            size += len(part[-1])
            if size >= limit:
                yield from shingle_sets(part)
                part, size = [], 0
    yield from shingle_sets(part)


def links(common: int, a: int, b: int) -> bool:
    return 100 * common >= PERCENT * (a + b - common)


def band_of(size: int) -> int:
    return int(math.log(size) / math.log(BAND) + 1e-9)


def band_top(band: int) -> int:
    """The largest size of a band."""
    top = int(BAND ** (band + 1)) + 1
    while band_of(top) > band:
        top -= 1
    return top


def differences(size: int) -> int:
    """The most shingles in which a set of ``size`` and a larger linked one can differ."""
    return size * 100 // PERCENT - size


def plan(band: int, sets: float) -> tuple[int, bool]:
    """(segments, one deletion allowed) for a band with so many sets: the cheaper of the two plans."""
    top = band_top(band)
    h = differences(top)
    low = BAND**band

    def meets(load: float, pairs: float) -> float:
        return pairs * math.exp(-2 * load)  # two empty segments

    pairs = sets * sets / 2
    equal = h + 1 + (SPARE if h else 0)
    cost_equal = sets * equal + (COMPARE * equal * meets(low / equal, pairs) if not h else 0.0)
    # half of H, rounded down, can be spent on two differences each
    wide = h // 2 + 1
    load = low / wide
    cost_wide = sets * (wide + top) + COMPARE * wide * meets(load, pairs)
    return (wide, True) if h and cost_wide < cost_equal else (equal, False)


def _signatures(s: np.ndarray, band: int, segments: int, wide: bool) -> np.ndarray:
    """64-bit signatures of a set under a band's scheme."""
    seed = np.uint64((band * 2 + wide + 1) * 0x9E3779B97F4A7C15 & MASK)
    segment = (_mix(s ^ seed) >> np.uint64(32)).astype(np.int64) * segments >> 32
    token = _mix(s + seed)
    total = np.zeros(segments, np.uint64)
    np.add.at(total, segment, token)
    label = _mix(np.arange(1, segments + 1, dtype=np.uint64) + seed)
    out = [_mix(total ^ label)]
    if wide:
        out.append(_mix((total[segment] - token) ^ label[segment]))
    return np.concatenate(out)


def _set_key(s: np.ndarray) -> int:
    """A signed 64-bit hash of a set."""
    h = int(_mix(np.array([int(_mix(s).sum(dtype=np.uint64)) + len(s) * 0x9E3779B97F4A7C15 & MASK], np.uint64))[0])
    return h - (1 << 64) if h >> 63 else h


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, key = [], []
        for s in in_batches(batch.column("text")):
            n.append(len(s))
            key.append(_set_key(s) if len(s) else None)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), pa.array(n, pa.int64()), pa.array(key, pa.int64())], names=["doc_id", "digest", "n", "key"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, size = [], 0
        for s in in_batches(batch.column("text")):
            rows.append((_set_key(s) if len(s) else None, s.view(np.int64)))
            size += len(s)
            if size > 1 << 19:
                yield _set_batch(rows)
                rows, size = [], 0
        if rows:
            yield _set_batch(rows)


def _parity(s: np.ndarray) -> np.ndarray:
    """BITMAP bits, each the parity of the shingles that hash there, as signed longs.

    Two bitmaps differ in at most as many bits as their sets differ in shingles.
    """
    odd = np.bincount((_mix(s) % np.uint64(BITMAP)).astype(np.int64), minlength=BITMAP) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _set_batch(rows: list) -> pa.RecordBatch:
    def lists(parts: list[np.ndarray]) -> pa.Array:
        offsets = np.concatenate(([0], np.cumsum([len(x) for x in parts]))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts)))

    sets, bits = [s for _, s in rows], [_parity(s.view(np.uint64)) for _, s in rows]
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int64()), lists(sets), lists(bits)], names=["key", "s", "bits"])


def _signer(plans: dict[int, tuple[int, bool]]):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # equal sets of one task sign once

        def batch_of(parts: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
            flat = np.concatenate([x for _, x in parts]).view(np.int64)
            owner = np.repeat(np.array([k for k, _ in parts], np.int64), [len(x) for _, x in parts])
            return pa.RecordBatch.from_arrays([pa.array(flat), pa.array(owner)], names=["sig", "key"])

        parts, size = [], 0
        for batch in batches:
            for s in in_batches(batch.column("text")):
                key = _set_key(s) if len(s) else None
                if key is None or key in seen:
                    continue
                seen.add(key)
                for band in {band_of(len(s)), band_of(-(-len(s) * PERCENT // 100))}:
                    segments, wide = plans.get(band, (0, False))
                    if segments:
                        # the lowest bits say whether the band is odd and the plan wide: a set has two bands at most
                        mark = np.uint64(band % 2 + 2 * wide)
                        x = (_signatures(s, band, segments, wide) & np.uint64(MASK - 3)) | mark
                        parts.append((key, x))
                        size += len(x)
                if size > 1 << 18:
                    yield batch_of(parts)
                    parts, size = [], 0
        if parts:
            yield batch_of(parts)

    return sign


def _candidates(docs: DataFrame, plans: dict[int, tuple[int, bool]], classes: DataFrame) -> DataFrame:
    """(sig, key, weight): the signatures that several classes share, without those that a class may leave out.

    A set of n shingles differs from linked ones of its own band in at most differences(n) segments, so it may leave
    out all but one of the rest; under the scheme of the band below it may leave out ``SPARE``.
    """
    rows = docs.mapInArrow(trimmed(_signer(plans)), "sig bigint, key bigint")
    bucket = Window.partitionBy("sig")
    ends = rows.withColumns({"a": F.min("key").over(bucket), "b": F.max("key").over(bucket)})
    shared = ends.where("a <> b").select("sig", "key").distinct().withColumn("n", F.count(F.lit(1)).over(bucket))
    sized = shared.join(classes.select("key", F.col("n").alias("size")), "key")
    mark, size = F.col("sig").bitwiseAND(F.lit(3)), F.col("size")
    order = Window.partitionBy("key", mark).orderBy(F.desc("n"), "sig")
    # what a set shares with how many: the text that others were copied from shares most
    weight = F.sum("n").over(Window.partitionBy("key"))
    ranked = sized.withColumns({"rank": F.row_number().over(order), "weight": weight})
    own = F.floor(F.ln(size) / math.log(BAND) + 1e-9).cast("int")
    segments = F.create_map(*[F.lit(x) for b, (m, _) in sorted(plans.items()) for x in (b, m)]) if plans else F.create_map(F.lit(0), F.lit(0))
    most = F.floor(size * 100 / PERCENT) - size
    spare = F.when(own % 2 == mark % 2, F.coalesce(F.try_element_at(segments, own), F.lit(0)) - most - 1).otherwise(SPARE)
    spare = F.when(mark >= 2, 0).otherwise(F.greatest(spare, F.lit(SPARE)))
    return ranked.where(F.col("rank") > spare).select("sig", "key", "weight")


def _distinct_buckets(rows: DataFrame) -> DataFrame:
    """``rows`` without buckets of one member, and with one bucket of those that have the same members."""
    members = [F.bit_xor(F.xxhash64("key", F.lit(seed))).alias(f"m{seed}") for seed in (31, 37)]
    of_sig = rows.groupBy("sig").agg(F.count(F.lit(1)).alias("c"), *members).where("c > 1")
    first = of_sig.groupBy("c", "m31", "m37").agg(F.min("sig").alias("sig")).select("sig")
    return rows.join(first, "sig", "left_semi")


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of keys whose sets link."""
    left = pairs.join(sets.select(F.col("key").alias("a"), F.col("s").alias("sa")), "a")
    both = left.join(sets.select(F.col("key").alias("b"), F.col("s").alias("sb")), "b")
    small, large = F.least(F.size("sa"), F.size("sb")), F.greatest(F.size("sa"), F.size("sb"))
    both = both.where(small * 100 >= large * PERCENT)
    common = F.size(F.array_intersect("sa", "sb"))
    return both.where(common * (100 + PERCENT) >= (F.size("sa") + F.size("sb")) * PERCENT).drop("sa", "sb")


def components(edges: DataFrame) -> DataFrame:
    """(key, comp): the least key that each end of the edges (a, b) reaches. Label spreading with pointer jumping.

    Every round is a table in the shared folder; only whether labels changed comes to the driver. Labels only fall, so
    the rounds end.
    """
    both = cut(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = cut(both.groupBy(F.col("a").alias("key")).agg(F.least(F.min("b"), F.first("a")).alias("comp")), "labels")
    while True:
        near = both.join(labels.select(F.col("key").alias("b"), "comp"), "b").groupBy(F.col("a").alias("key")).agg(F.min("comp").alias("m"))
        spread = labels.join(near, "key").select("key", "comp", F.least("comp", "m").alias("m"))
        jump = spread.join(labels.select(F.col("key").alias("m"), F.col("comp").alias("j")), "m").select("key", F.least("m", "j").alias("comp"), (F.least("m", "j") < F.col("comp")).alias("changed"))
        done = cut(jump, "labels")
        labels = done.select("key", "comp")
        if done.where("changed").isEmpty():
            return labels


def _joined(rows: DataFrame, sets: DataFrame) -> DataFrame | None:
    """(key, comp): the components of the links between sets that share a bucket; none if there is no link. rows: (sig, key, weight)."""
    bucket = Window.partitionBy("sig")
    top = F.max(F.struct("weight", "key")).over(bucket)["key"]
    near = rows.withColumn("hub", top).where("key <> hub")
    pairs = near.select(F.least("key", "hub").alias("a"), F.greatest("key", "hub").alias("b")).distinct()
    links = cut(_verify(pairs, sets), "links")
    comps = None if links.isEmpty() else components(links)
    # buckets of one component need nothing more
    marked = rows.select("sig", "key")
    marked = marked.withColumn("comp", F.col("key")) if comps is None else marked.join(comps, "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    several = marked.groupBy("sig").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("sig")
    known = marked.join(several, "sig", "left_semi").join(sets.select("key", F.size("s").alias("size"), "bits"), "key")
    known = cut(known.select("sig", "key", "comp", "size", "bits"), "open")
    side = lambda x: known.select("sig", *[F.col(c).alias(f"{c}_{x}") for c in ("key", "comp", "size", "bits")])
    differ = sum((F.bit_count(F.get("bits_a", F.lit(i)).bitwiseXOR(F.get("bits_b", F.lit(i)))) for i in range(BITMAP // 64)), F.lit(0))
    like = differ * (100 + PERCENT) <= (F.col("size_a") + F.col("size_b")) * (100 - PERCENT)
    rest = side("a").join(side("b"), "sig").where("key_a < key_b and comp_a <> comp_b").where(like)
    rest = rest.select(F.col("key_a").alias("a"), F.col("key_b").alias("b"), F.col("comp_a").alias("ca"), F.col("comp_b").alias("cb")).distinct()
    more = _verify(rest, sets).select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    more = cut(more.distinct(), "more")
    if more.isEmpty():
        return comps
    # links between components join them
    over = components(more).select(F.col("key").alias("comp"), F.col("comp").alias("top"))
    if comps is None:
        return over.select(F.col("comp").alias("key"), F.col("top").alias("comp"))
    # a set without a link before is in no component yet
    old = comps.join(over, "comp", "left").select("key", F.coalesce("top", "comp").alias("comp"))
    return old.union(over.join(comps.select(F.col("key").alias("comp")), "comp", "left_anti").select(F.col("comp").alias("key"), F.col("top").alias("comp")))


def _classes(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(sized, named, sets): rows (doc_id, digest, n, key), classes (key, rep, n, members, comp) of equal sets, and the
    sets (key, s, bits) that may have links; no sets if there is no link."""
    docs = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    sized = cut(docs.withColumn("digest", F.xxhash64("text")).mapInArrow(trimmed(_sizes), "doc_id bigint, digest bigint, n bigint, key bigint"), "sizes")
    # a histogram of bands: at most some dozens of rows
    classes = sized.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.count("doc_id").alias("members"))
    band = F.floor(F.ln("n") / math.log(BAND) + 1e-9).cast("int")
    counts = {r["band"]: r["c"] for r in classes.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("c")).collect()}
    bands = {b for b in counts} | {b - 1 for b in counts if b}
    plans = {b: plan(b, counts.get(b, 0) + counts.get(b + 1, 0)) for b in bands if differences(band_top(b))}
    rows = cut(_distinct_buckets(cut(_candidates(docs, plans, classes), "candidates")), "buckets")
    known = cut(rows.select("key").distinct().join(classes.select("key", "rep"), "key"), "wanted")
    texts = docs.join(known.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    found = texts.select("text").mapInArrow(trimmed(_sets), "key bigint, s array<bigint>, bits array<bigint>")
    sets = cut(found.join(known, "key", "left_semi").dropDuplicates(["key"]), "sets")
    comps = _joined(rows, sets)
    if comps is None:
        return sized, classes.withColumn("comp", F.col("key")), None
    # keys are hashes; a component is named by its least document
    named = classes.join(comps, "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    return sized, cut(named, "classes"), sets


def _named_by_component(sized: DataFrame, named: DataFrame, key: str) -> DataFrame:
    least = named.groupBy("comp").agg(F.min("rep").alias("component_id"))
    of_key = named.select("key", "comp").join(least, "comp").select("key", "component_id")
    own = sized.join(of_key, "key")
    alone = sized.where("key is null").withColumn("component_id", F.col("doc_id"))
    return own.select("doc_id", "n", "component_id", "key").union(alone.select("doc_id", "n", "component_id", "key")).select(
        F.col("doc_id").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"), F.col("key").alias("_class")
    )


def link_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id): the set size and the least key reachable by links, one row per input row."""
    sized, named, _ = _classes(docs, key, text)
    return _named_by_component(sized, named, key).drop("_class")


def _linked(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Which sets of ``a`` link with which of ``b``, exactly; a matrix of booleans."""
    sizes_a, sizes_b = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    flat_a, flat_b = np.concatenate(a), np.concatenate(b)
    both = np.intersect1d(flat_a, flat_b)
    common = np.zeros((len(a), len(b)), np.float32)  # exact below 2^24

    def places(flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(both, flat)
        seen = at < len(both)
        seen[seen] = both[at[seen]] == flat[seen]
        return np.repeat(np.arange(len(sizes)), sizes)[seen], at[seen]

    (row_a, at_a), (row_b, at_b) = places(flat_a, sizes_a), places(flat_b, sizes_b)
    for first in range(0, len(both), COLUMNS):
        part = []
        for row, at, n in ((row_a, at_a, len(a)), (row_b, at_b, len(b))):
            here = (at >= first) & (at < first + COLUMNS)
            m = np.zeros((n, min(COLUMNS, len(both) - first)), np.float32)
            m[row[here], at[here] - first] = 1
            part.append(m)
        common += part[0] @ part[1].T
    return common.astype(np.int64) * (100 + PERCENT) >= (sizes_a[:, None] + sizes_b[None]) * PERCENT


def _compare(table: pa.Table) -> pa.Table:
    """The links between two blocks of a component: for each member, with which and how many documents."""
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("me", "key", "members")), range(table.num_rows), strict=True))
    s = table.column("s").combine_chunks()
    values, offsets = s.values.to_numpy(zero_copy_only=False), s.offsets.to_numpy()
    first, last = table.column("x")[0].as_py(), table.column("y")[0].as_py()
    side = lambda block: [r for r in rows if r[0] == block]
    of = lambda part: [values[offsets[i] : offsets[i + 1]] for *_, i in part]
    a, b = side(first), side(last)
    found = _linked(of(a), of(b))
    if first == last:
        np.fill_diagonal(found, False)
    out = []
    for part, others, m in ((a, b, found), (b, a, found.T))[: 1 if first == last else 2]:
        keys, weights = np.array([x[1] for x in others], np.int64), np.array([x[2] for x in others], np.int64)
        out += [(x[1], int(weights[hit].sum()), keys[hit].tolist()) for x, hit in zip(part, m, strict=True) if hit.any()]
    return pa.table([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.list_(pa.int64()))], names=["key", "n_links", "linked"])


def _links_of_classes(named: DataFrame, sets: DataFrame) -> DataFrame:
    """(key, n_links, linked): for each class and block, the linked classes of other sets and how many documents they have."""
    size = named.groupBy("comp").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles")).where("size > 1")
    blocks = F.ceil(F.greatest(F.col("size") / BLOCK, F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    members = named.join(size, "comp").select("comp", "key", "members", F.least(blocks, F.col("size")).cast("int").alias("blocks"))
    # any even deal will do
    me = F.pmod(F.xxhash64("key", F.lit(29)), F.col("blocks")).cast("int")
    dealt = members.withColumn("me", me).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("comp", "key", "members", "me", F.least("me", "other").alias("x"), F.greatest("me", "other").alias("y"))
    return dealt.join(sets.select("key", "s"), "key").groupBy("comp", "x", "y").applyInArrow(_compare, "key bigint, n_links bigint, linked array<bigint>")


def linked_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``link_documents`` with n_links: how many other documents each one links with, equal texts among them.

    Rows of null ids are no documents that others link with, and have 0 links themselves.
    """
    sized, named, sets = _classes(docs, key, text)
    found = _named_by_component(sized, named, key)
    equal = named.select(F.col("key").alias("_class"), (F.col("members") - 1).alias("_equal"))
    if sets is None:
        counted = equal.withColumn("_other", F.lit(0))
    else:
        other = _links_of_classes(named, sets).groupBy(F.col("key").alias("_class")).agg(F.sum("n_links").alias("_other"))
        counted = equal.join(other, "_class", "left")
    n = F.when(F.col(key).isNotNull(), F.coalesce("_equal", F.lit(0)) + F.coalesce("_other", F.lit(0))).otherwise(0)
    return found.join(counted, "_class", "left").select(key, "n_shingles", "component_id", n.cast("bigint").alias("n_links"))


def link_pairs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(pairs, members): all links (a, b), a < b, between the least documents of classes of equal sets, and the class
    (key, class_id) of every document that has shingles. Classes without an id have no links."""
    sized, named, sets = _classes(docs, key, text)
    members = sized.where("doc_id is not null").join(named.select("key", "rep"), "key").select(F.col("doc_id").alias(key), F.col("rep").alias("class_id"))
    if sets is None:
        return sized.sparkSession.createDataFrame([], "a bigint, b bigint"), members
    linked = _links_of_classes(named, sets).select("key", F.explode("linked").alias("with"))
    rep = lambda c, to: named.select(F.col("key").alias(c), F.col("rep").alias(to))
    return linked.join(rep("key", "a"), "key").join(rep("with", "b"), "with").where("a < b").select("a", "b"), members


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` for each component: of the least id, and among rows of one id of the least digest of the text.

    Rows without shingles and rows of null ids stay. Rows are told apart by id and text, so a repeated id loses no
    other text; rows that are equal in both are one.
    """
    sized, named, _ = _classes(docs, key, text)
    rows = sized.where("doc_id is not null").join(named.select("key", "comp"), "key")
    first = rows.groupBy("comp").agg(F.min(F.struct("doc_id", "digest")).alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1").select("comp", "first")
    many = cut(rows.join(first, "comp").select("doc_id", "digest", (F.struct("doc_id", "digest") == F.col("first")).alias("is_first")), "members")
    same = lambda of, rows: (of[key].cast("bigint") == rows["id_"]) & (F.xxhash64(of[text]) == rows["digest_"])
    named_apart = [F.col("doc_id").alias("id_"), F.col("digest").alias("digest_")]
    extra = many.where("not is_first").select(*named_apart).distinct()
    kept = docs.join(extra, same(docs, extra), "left_anti")
    twice = cut(many.where("is_first").groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(*named_apart), "twice")
    if twice.isEmpty():
        return kept
    again = kept.join(twice, same(kept, twice), "left_semi").dropDuplicates([key, text])
    return kept.join(twice, same(kept, twice), "left_anti").unionByName(again)
