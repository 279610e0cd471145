"""Benchmark decontamination by winnowing, in native expressions.

Words are runs of letters and digits, A-Z lower-cased. A benchmark window is ``WINDOW`` consecutive words of an item,
or all words of a shorter item. Winnowing keeps the least hash of the ``WINDOW - K + 1`` K-grams inside each window,
so two texts that share a span of ``WINDOW`` words share a fingerprint: the join on fingerprints finds every such
span. Neighbouring windows of a text that have the same fingerprint look it up once; a joined fingerprint is extended to
all windows of its run, which are compared word by word. Items shorter than a window are looked up by their whole length.

The training side is read once: no words leave their task unless a fingerprint is one of the benchmark's.
Fingerprints of the benchmark are broadcast below ``MAX_BROADCAST`` rows, which are counted first, and joined by a
shuffle beyond that.

Defined results: null and wordless texts have no words and no hits; items without words have no window; an item of
null id marks words but is not listed; repeated rows are separate rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import indices, let, lower_ascii, window_hashes, words

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
K = 5
#: Windows of the benchmark (some 100 bytes each) that may be broadcast.
MAX_BROADCAST = 200_000


def item_words(text: Column) -> Column:
    return words(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS)


def _fingerprint(grams: Column, at: Column) -> Column:
    """The least K-gram hash of the window that starts at ``at``."""
    return F.array_min(F.slice(grams, at + 1, WINDOW - K + 1))


def benchmark_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """(win, len, fp, items): distinct windows, the winnowed fingerprint (of full ones) and the ids they occur in."""
    split = benchmark.select(F.col(item).alias("item"), item_words(F.col(text)).alias("w")).where(F.size("w") > 0)
    split = split.withColumn("g", window_hashes(F.col("w"), K))
    at = split.select("item", "w", "g", F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - WINDOW, F.lit(0)))).alias("i"))
    n = F.least(F.size("w"), F.lit(WINDOW))
    runs = at.select(
        "item", F.concat_ws(" ", F.slice("w", F.col("i") + 1, WINDOW)).alias("win"), n.alias("len"),
        F.when(n == WINDOW, _fingerprint(F.col("g"), F.col("i"))).alias("fp"),
    )
    return runs.groupBy("win", "len", "fp").agg(F.collect_set("item").alias("items"))


def _lengths(windows: DataFrame) -> tuple[list[int], int]:
    """The lengths of windows (at most WINDOW of them) and the number of windows."""
    found = windows.groupBy("len").agg(F.count(F.lit(1)).alias("n")).collect()
    return sorted(r["len"] for r in found), sum(r["n"] for r in found)


def _probes(w: Column, row: Column, lengths: list[int]) -> Column:
    """array<struct<len, first, last, h>>: what a text of the words ``w`` looks up.

    Of full windows, one fingerprint for each run of windows that have the same least K-gram hash, with the first and the
    last of these windows; of shorter lengths every run of so many words; and, with length 0, the text itself, whose
    hash is its own so that a shuffle spreads them.
    """
    probe = lambda n, first, last, h: F.struct(F.lit(n).alias("len"), first.alias("first"), last.alias("last"), h.alias("h"))

    def winnowed(f: Column) -> Column:
        fresh = F.filter(indices(F.size(f)), lambda i: (i == 0) | (F.get(f, i) != F.get(f, i - 1)))
        return let(fresh, lambda at: F.transform(at, lambda i, k: probe(WINDOW, i, F.coalesce(F.get(at, k + 1), F.size(f)) - 1, F.get(f, i))))

    parts = [F.array(probe(0, F.lit(-1), F.lit(-1), row))]
    if WINDOW in lengths:
        of_windows = lambda g: F.transform(indices(F.size(w) - (WINDOW - 1)), lambda i: _fingerprint(g, i))
        parts.append(let(window_hashes(w, K), lambda g: let(of_windows(g), winnowed)))

    def runs_of(n: int) -> Column:
        return F.transform(indices(F.size(w) - (n - 1)), lambda i: probe(n, i, i, F.xxhash64(F.slice(w, i + 1, n))))

    parts += [runs_of(n) for n in lengths if n < WINDOW]
    return F.concat(*parts)


def occurrences(docs: DataFrame, benchmark: DataFrame, key: str, text: str) -> DataFrame:
    """(row, key, n_words, i, len, items): occurrences of benchmark windows, and a row of null items per document.

    One pass over the texts. The row of null items has i = -1; it keeps documents without hits.
    """
    windows = benchmark_windows(benchmark)
    lengths, n = _lengths(windows)
    small = n <= MAX_BROADCAST
    hint = F.broadcast if small else (lambda df: df)
    kept = ["row", key, "n_words"]
    read = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key), F.col(text).alias("t"))
    looked = let(item_words(F.col("t")), lambda w: F.struct(w.alias("w"), _probes(w, F.col("row"), lengths).alias("p")))
    at = read.select("row", key, looked.alias("x")).select("row", key, F.size("x.w").cast("bigint").alias("n_words"), F.col("x.w").alias("w"), F.explode("x.p").alias("p"))
    at = at.select(*kept, "w", "p.len", "p.first", "p.last", "p.h")
    # the words that the windows of a run cover
    covered = F.slice("w", F.greatest(F.col("first"), F.lit(0)) + 1, F.col("last") - F.col("first") + F.col("len"))
    if not small:  # the other words don't have to cross the shuffle
        at = at.withColumn("s", covered).drop("w")
    known = windows.select("len", F.coalesce("fp", F.xxhash64(F.split("win", " "))).alias("h")).distinct()
    near = at.join(hint(known.withColumn("near", F.lit(True))), ["len", "h"], "left").where(F.col("near") | (F.col("len") == 0))
    if small:
        near = near.withColumn("s", covered).drop("w")
    # a fingerprint that is one of the benchmark's is extended to every window of its run
    each = near.select(*kept, "len", "first", "s", F.explode(F.sequence("first", "last")).alias("i"))
    run = F.when(F.col("len") == 0, F.col("row").cast("string")).otherwise(F.concat_ws(" ", F.slice("s", F.col("i") - F.col("first") + 1, F.col("len"))))
    each = each.select(*kept, "i", "len", run.alias("win"))
    return each.join(hint(windows.select("win", "len", "items")), ["win", "len"], "left").select(*kept, "i", "len", "items")


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: its words, the words inside any occurrence of a benchmark window, and the items."""
    found = occurrences(docs, benchmark, key, text)
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    step = lambda acc, x: F.struct(
        (acc.n + F.greatest(F.lit(0), x.i + x.len - F.greatest(x.i, acc.end))).alias("n"), F.greatest(acc.end, x.i + x.len).alias("end")
    )
    span = F.when(F.col("items").isNotNull(), F.struct("i", "len"))
    per_row = found.groupBy("row", key, "n_words").agg(
        F.aggregate(F.sort_array(F.collect_set(span)), zero, step, lambda acc: acc.n).cast("bigint").alias("n_hit"),
        F.array_sort(F.transform(F.array_distinct(F.flatten(F.collect_set("items"))), lambda x: x.cast("string"))).alias("ids"),
    )
    return per_row.select(
        key, "n_words", "n_hit", F.size("ids").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "ids").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no benchmark window occurs, with their columns.

    Contamination depends on the text alone, so rows are told apart by its digest, which null texts share.
    """
    digest = F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)
    marked = docs.withColumn("_digest", digest)
    bad = occurrences(marked, benchmark, "_digest", text).where(F.col("items").isNotNull()).select("_digest").distinct()
    return marked.join(bad, "_digest", "left_anti").select(*docs.columns)


#: DuckDB: every window of every text, joined as text.
ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0)
), dw AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)
), hit AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n
), pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id
), ids AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN ids USING (doc_id)
"""
