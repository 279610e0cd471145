"""Resharding by minimum-cost flow: move the fewest bytes so that shards have given capacities.

Old shards are cut into ``BLOCKS`` blocks by a hash of the row, so a hot shard is as many tasks as any other. Block
sizes (a bounded table) give the supplies, new shards the capacities; a byte that stays costs 0 and one that moves 1.
The flow is realised in the order of blocks and rows: a row goes where the middle of its bytes falls, so sizes differ
from the capacities by about one row per cut. Rows then get gapless slots, and the shards that gain or lose rows are
rewritten.

Defined results: a null text has no bytes; null ids are rows like others; repeated rows get slots of their own; an
empty table gives an empty layout; extra columns are kept by ``rewrite``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import fresh_path

#: Blocks of an old shard, dealt out in groups of ``GROUP``. Shards * BLOCKS rows at most reach the driver.
BLOCKS, GROUP = 2048, 64
OVERHEAD = 8


def min_cost_flow(supply: list[int], capacity: list[int], cost) -> dict[tuple[int, int], int]:
    """Cheapest flow of all supplies into the capacities, by successive shortest paths. cost(i, j) is per unit."""
    n, m = len(supply), len(capacity)
    left, room = list(supply), list(capacity)
    flow: dict[tuple[int, int], int] = {}
    pi = [0] * (n + m)  # potentials keep reduced costs non-negative

    while any(left):
        # Dijkstra from all sources with supply left, over the dense bipartite residual graph
        dist, back, done = [float("inf")] * (n + m), [-1] * (n + m), [False] * (n + m)
        for i in range(n):
            if left[i]:
                dist[i] = 0
        for _ in range(n + m):
            u = min((v for v in range(n + m) if not done[v]), key=lambda v: dist[v])
            if dist[u] == float("inf"):
                break
            done[u] = True
            steps = ((n + j, cost(u, j)) for j in range(m)) if u < n else ((i, -cost(i, u - n)) for i in range(n) if flow.get((i, u - n)))
            for v, c in steps:
                d = dist[u] + c + pi[u] - pi[v]
                if d < dist[v] - 1e-12:
                    dist[v], back[v] = d, u
        ends = [j for j in range(m) if room[j] and dist[n + j] < float("inf")]
        if not ends:
            raise ValueError("the capacities are smaller than the supplies")
        end = min(ends, key=lambda j: dist[n + j] + pi[n + j])
        far = max(d for d in dist if d < float("inf"))
        pi = [p + min(d, far) for p, d in zip(pi, dist, strict=True)]
        path, v = [], n + end
        while back[v] >= 0:
            path.append((back[v], v))
            v = back[v]
        pushed = min([left[v], room[end], *(flow[(b, a - n)] for a, b in path if a >= n)])
        for a, b in path:
            key, sign = ((a, b - n), 1) if a < n else ((b, a - n), -1)
            flow[key] = flow.get(key, 0) + sign * pushed
        left[v] -= pushed
        room[end] -= pushed
    return {k: x for k, x in flow.items() if x}


def size_of(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("bigint")


def crc_of(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def _dealt(docs: DataFrame, old: Column, key: str, text: str) -> DataFrame:
    block = F.pmod(F.xxhash64(F.col(key), F.col("text_crc32")), F.lit(BLOCKS)).cast("int")
    sized = docs.withColumns({"old": old.cast("int"), "size": size_of(F.col(text)), "text_crc32": crc_of(F.col(text))})
    return sized.withColumn("block", block).withColumn("part", F.floor(F.col("block") / GROUP).cast("int"))


def _cuts(supplies: dict[int, int], capacity: list[int]) -> tuple[dict[int, list[tuple[int, int, int]]], int]:
    """Per old shard the (from, to, new shard) intervals of its bytes; and the bytes that move."""
    olds = sorted(supplies)
    flow = min_cost_flow([supplies[o] for o in olds], capacity, lambda i, j: 0 if olds[i] == j else 1)
    cuts: dict[int, list[tuple[int, int, int]]] = {o: [] for o in olds}
    for (i, j), n in sorted(flow.items(), key=lambda x: (x[0][0], olds[x[0][0]] != x[0][1], x[0][1])):
        at = cuts[olds[i]][-1][1] if cuts[olds[i]] else 0
        cuts[olds[i]].append((at, at + n, j))
    return cuts, sum(n for (i, j), n in flow.items() if olds[i] != j)


class Layout:
    """Where every block starts in its old shard, how old shards are cut, and where pieces start in the new ones."""

    def __init__(self, docs: DataFrame, old: Column, shards: int, key: str = "doc_id", text: str = "text"):
        spark = docs.sparkSession
        self.docs, self.old, self.shards, self.key, self.text = docs, old, shards, key, text
        sizes = _dealt(docs, old, key, text).groupBy("old", "block").agg(F.sum("size").alias("n")).collect()
        supplies: dict[int, int] = {}
        starts = []
        for r in sorted(sizes, key=lambda r: (r["old"], r["block"])):
            starts.append((r["old"], r["block"], supplies.get(r["old"], 0)))
            supplies[r["old"]] = supplies.get(r["old"], 0) + r["n"]
        total = sum(supplies.values())
        self.capacity = [total // shards + (j < total % shards) for j in range(shards)]
        self.cuts, self.moved_bytes = _cuts(supplies, self.capacity)
        self.starts = spark.createDataFrame(starts, "old int, block int, start bigint")
        self.intervals = spark.createDataFrame(
            [(o, [(a, b, j) for a, b, j in parts]) for o, parts in self.cuts.items()], "old int, cuts array<struct<a:bigint,b:bigint,j:int>>"
        )
        narrow = self._assigned(docs)
        counts = narrow.groupBy("old", "block", "shard").agg(F.count(F.lit(1)).alias("n")).collect()
        offsets, filled = [], dict.fromkeys(range(shards), 0)
        for r in sorted(counts, key=lambda r: (r["shard"], r["old"] != r["shard"], r["old"], r["block"])):
            offsets.append((r["old"], r["block"], r["shard"], filled[r["shard"]]))
            filled[r["shard"]] += r["n"]
        self.offsets = spark.createDataFrame(offsets, "old int, block int, shard int, first bigint")

    def _assigned(self, docs: DataFrame) -> DataFrame:
        dealt = _dealt(docs, self.old, self.key, self.text).repartition("old", "part")
        w = Window.partitionBy("old", "part", "block").orderBy(self.key, "text_crc32", "size")
        before = F.coalesce(F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        placed = dealt.withColumn("before", before).join(F.broadcast(self.starts), ["old", "block"]).join(F.broadcast(self.intervals), "old")
        middle = F.col("start") + F.col("before") + F.floor(F.col("size") / 2)
        at = F.filter("cuts", lambda c: (c.a <= middle) & (middle < c.b))
        return placed.withColumn("shard", F.get(at, F.lit(0)).j).drop("start", "cuts")

    def assigned(self) -> DataFrame:
        """The rows with old, size, text_crc32, shard and slot."""
        rows = self._assigned(self.docs)
        w = Window.partitionBy("old", "part", "block", "shard").orderBy("before")
        ranked = rows.withColumn("rank", F.row_number().over(w) - 1).join(F.broadcast(self.offsets), ["old", "block", "shard"])
        return ranked.withColumn("slot", F.col("first") + F.col("rank")).drop("block", "part", "before", "first", "rank")

    def affected(self) -> list[int]:
        """New shards that gain or lose rows."""
        moved = [(o, j) for o, parts in self.cuts.items() for _, _, j in parts if o != j]
        return sorted({x for pair in moved for x in pair if 0 <= x < self.shards})

    def rewrite(self, path: str | None = None, only_affected: bool = False) -> str:
        """Write shards as Parquet below ``path``, one folder each; returns the path. Rows of a shard are in slot order within a file."""
        path = path or fresh_path(self.docs.sparkSession, "shards")
        rows = self.assigned()
        if only_affected:
            rows = rows.where(F.col("shard").isin(self.affected()))
        rows.write.partitionBy("shard").parquet(path)
        return path


def reshard_documents(docs: DataFrame, shards: int = 24, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Digest of the rewritten shards: rows of one source were one old shard, and sizes become near equal."""
    docs = docs.select(key, text, source)
    old = F.pmod(F.crc32(F.coalesce(F.col(source), F.lit("")).cast("binary")), F.lit(shards))
    path = Layout(docs, old, shards, key, text).rewrite()
    kept = docs.sparkSession.read.schema(f"`{key}` bigint, `{text}` string, slot bigint, shard int").parquet(path)
    return kept.select(
        key, size_of(F.col(text)).alias("size"), crc_of(F.col(text)).alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
