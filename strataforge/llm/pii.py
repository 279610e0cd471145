"""Personal data: span generators, boosted trees over format and context, calibrated thresholds. Native expressions.

Base spans (email, ip, card, phone) follow fixed patterns and checks and always stay. High-recall generators then
propose further spans that the base patterns can't see: spelled-out addresses, national phone numbers, card numbers in
dotted groups, social security numbers, and card and phone numbers inside base matches that failed, as where two numbers
stand side by side; they overlap freely. Gradient-boosted trees score each proposal from its format and its context, and
a threshold per kind, set on held-out examples for a precision of ``PRECISION``, selects. A selected span that overlaps a
base span or a better selected one is not added; of equally good ones the first in the text wins.

The trees are fitted on ``EXAMPLES`` labelled examples that a seeded rule generates (a documented bound, independent
of the data); their features come from the same expressions as those of the documents.

Positions are code points, ends exclusive. Defined results: a null text is empty and has no spans; repeated rows are
separate rows; an empty table gives an empty one; extra columns are ignored. The patterns are possessive and anchored at the start of a run, which
changes no match but keeps long runs of digits or letters linear.
"""

from __future__ import annotations

import math
import random
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .columns import indices, let

KINDS = ("email", "ip", "card", "phone", "ssn")

EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_OCTET = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
_IP_VALID = rf"^(?:{_OCTET}\.){{3}}{_OCTET}$"

#: Proposals: (kind, what a text must match at all, pattern).
_AT, _DOT = r"(?:\s?[\[({<]\s?at\s?[\])}>]\s?|\s[\[({<]?at[\])}>]?\s|\s@\s)", r"(?:\s?[\[({<]\s?dot\s?[\])}>]\s?|\sdot\s|\s?\.\s?)"
GENERATORS = (
    ("email", r"(?i)\b(?:at|dot)\b|\s@\s", rf"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]++{_AT}[a-z0-9-]++(?:{_DOT}[a-z0-9-]++)*{_DOT}(?:com|org|net|edu|gov|info|io|co|uk|de|fr|es|eu|us)\b"),
    ("phone", r"[0-9]{3}[\x20.-][0-9]{4}", r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])"),
    ("card", r"[0-9]{4}[._/][0-9]{4}", r"(?<![0-9])[0-9]{4}(?:[._/][0-9]{4}){3}(?![0-9])"),
    ("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
)
#: Inside failed base matches: (kind, what a text must match at all, digits that a failed match has at least, pattern).
INNER = (
    ("card", r"[0-9](?:[\x20-]?[0-9]){14}", 15, r"(?<![0-9])(?:[0-9]{14,19}|[0-9]{4}(?:\x20[0-9]{4}){3}|[0-9]{4}(?:-[0-9]{4}){3}|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5})(?![0-9])"),
    ("phone", r"\+[0-9][\x20().0-9-]{15}", 16, r"\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{2,4}\)[\x20.-]?|[0-9]{2,4}[\x20.-])[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9])"),
)
_CUE = r"(?i)(?:call|phone|tel|mobile|cell|fax|contact|ssn|social|security|card|visa|mail|reach|write)\b[^\n]{0,12}$"
_ANTI = r"(?i)(?:order|invoice|ref|version|serial|part|sku|item|isbn|id|no\.|batch|#)[\x20:#.]{0,3}$"

EXAMPLES, TREES, DEPTH, RATE, PRECISION = 2400, 30, 3, 0.3, 0.95
CONTEXT_BEFORE, CONTEXT_AFTER = 24, 4


#: Matches that are located together.
_RUN = 256


def _located(text: Column, pattern: str) -> Column:
    """array<struct<s, e, m>>: starts, ends and texts of the leftmost matches that don't overlap."""
    p = F.lit(pattern)

    def walk(x: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int,m:string>>").alias("out"))

        def step(acc: Column, i: Column) -> Column:
            s, m = acc.at + F.char_length(F.get(x.gaps, i)), F.get(x.found, i)
            e = s + F.char_length(m)
            return F.struct(e.alias("at"), F.concat(acc.out, F.array(F.struct(s.alias("s"), e.alias("e"), m.alias("m")))).alias("out"))

        # matches are located in runs, and the runs one after the other: an array that grows is copied at each step
        n = F.size(x.found)
        runs = F.transform(indices(F.ceil(n / _RUN).cast("int")), lambda r: F.aggregate(F.sequence(r * _RUN, F.least(n, (r + 1) * _RUN) - 1), start, step))

        def joined(y: Column) -> Column:
            ends = F.aggregate(y, F.array(F.lit(0)), lambda acc, z: F.concat(acc, F.array(F.element_at(acc, -1) + z.at)))
            moved = lambda e: F.transform(y, lambda z, k: F.transform(z.out, lambda v: F.struct((v.s + F.get(e, k)).alias("s"), (v.e + F.get(e, k)).alias("e"), v.m.alias("m"))))
            return let(ends, lambda e: F.flatten(moved(e)))

        return let(runs, joined)

    return let(F.struct(F.regexp_extract_all(text, p, F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("gaps")), walk)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    def add(acc: Column, i: Column) -> Column:
        d = F.substring(F.reverse(digits), 1, 19)
        v = F.substr(d, i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return acc + F.when(v > 9, v - 9).otherwise(v)

    return F.aggregate(indices(F.char_length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return m.rlike(_IP_VALID)
    if kind == "card":
        return let(_digits(m), lambda d: F.when(F.char_length(d).between(14, 19), luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.char_length(_digits(m)).between(10, 15)
    return F.lit(True)


_SPANS = "array<struct<s:int,k:int,e:int>>"


def base_spans(text: Column) -> Column:
    """array<struct<s, k, e>> of the base kinds, by start and then kind."""
    needs = {"email": F.contains(text, F.lit("@")), "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike(r"[0-9][\x20-]?[0-9]"), "phone": text.rlike(r"\+[0-9]")}
    patterns = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}

    def of(k: int, kind: str) -> Column:
        found = F.filter(_located(text, patterns[kind]), lambda x: _valid(kind, x.m))
        spans = F.transform(found, lambda x: F.struct(x.s.alias("s"), F.lit(k).alias("k"), x.e.alias("e")))
        return F.when(needs[kind], spans).otherwise(F.array().cast(_SPANS))

    return F.array_sort(F.concat(*[of(k, kind) for k, kind in enumerate(KINDS[:4])]))


def _features(kind: str, m: Column, before: Column, after: Column) -> list[Column]:
    flag = lambda c: F.when(c, 1.0).otherwise(0.0)
    d = _digits(m)
    n = F.char_length(d)
    return [
        F.lit(float(KINDS.index(kind))),
        n.cast("double"),
        flag(F.contains(m, F.lit("("))),
        (F.char_length(m) - n).cast("double"),
        flag(before.rlike(_CUE)),
        flag(before.rlike(_ANTI)),
        flag(before.rlike(r"[A-Za-z0-9#/_=:.$]$")),
        flag(after.rlike(r"^(?:[A-Za-z0-9/_=%]|[.-][0-9])")),
        flag(luhn(d)) if kind == "card" else F.lit(0.0),
        F.size(F.array_distinct(F.split(d, ""))).cast("double"),
        flag(m.rlike(r"(?i)[\[({<@][\s\S]*[^a-z][a-z]{2,6}$|\sat\s[^\s]+\sdot\s")) if kind == "email" else F.lit(0.0),
        flag(d.rlike("^(?:1?[2-9][0-9]{2}[2-9][0-9]{6}|[0-9]{11,15})$")) if kind == "phone" else flag(d.rlike("^[2-9]")),
        flag(d.rlike("^(?:000|666|9)|^[0-9]{3}00|0000$")),
    ]


def proposals(text: Column) -> Column:
    """array<struct<s, k, e, f>>: spans of all generators with their features."""

    def described(kind: str, located: Column) -> Column:
        def one(x: Column) -> Column:
            before = F.substr(text, F.greatest(x.s - CONTEXT_BEFORE, F.lit(0)) + 1, F.least(x.s, F.lit(CONTEXT_BEFORE)))
            after = F.substr(text, x.e + 1, F.lit(CONTEXT_AFTER))
            return F.struct(x.s.alias("s"), F.lit(KINDS.index(kind)).alias("k"), x.e.alias("e"), F.array(*_features(kind, x.m, before, after)).alias("f"))

        return F.transform(located, one)

    def inside(kind: str, least: int, pattern: str) -> Column:
        failed = F.filter(_located(text, PHONE if kind == "phone" else CARD), lambda x: (F.char_length(_digits(x.m)) >= least) & ~_valid(kind, x.m))
        moved = lambda x: F.transform(_located(x.m, pattern), lambda y: F.struct((x.s + y.s).alias("s"), (x.s + y.e).alias("e"), y.m.alias("m")))
        return F.flatten(F.transform(failed, moved))

    none = F.array().cast("array<struct<s:int,k:int,e:int,f:array<double>>>")
    of = [F.when(text.rlike(need), described(kind, _located(text, pattern))).otherwise(none) for kind, need, pattern in GENERATORS]
    of += [F.when(text.rlike(need), described(kind, inside(kind, least, pattern))).otherwise(none) for kind, need, least, pattern in INNER]
    return F.concat(*of)


def _examples() -> list[tuple[str, int, bool]]:
    """(text, label, held out): seeded templates; # is a digit, @ a lower-case letter, L and N four digits of a number that
    passes or fails Luhn, V and W all sixteen of one; the rest stands for itself."""
    # fixed values: what personal data and its look-alikes look like
    yes = (
        "mail me: @@@@.@@@ (at) @@@@@@ (dot) com today", "@@@##[at]@@@@@.org is mine", "write to @@@_@@ {at} @@@@ {dot} net please", "reach @@@ (at) @@@@@.@@@.org",
        "@@@@ [at] @@@@@@@ [dot] com", "the @@@@@@@@ <at> @@@@ <dot> org @@@", "@@@@ at @@@@@@ dot com", "ask @@@.@@@@@ at @@@@ dot net", "@@@@ @ @@@@@@ . org",
        "call (2##) 255-#### now", "my phone is 3##-5##-####.", "tel 4##.3##.#### after six", "@@@@ (7##) 4##-#### @@@@", "contact: 6## 8## #### or so", "fax 8##-2##-####",
        "@@@@ 2##-5##-#### @@@", "@@ @@@@@ 9## 4## ####, @@@", "3##.7##.####", "+1 (2##) 5##-#### V", "+49 30 ####-### V", "@@@ +1 4##-2##-#### V",
        "card L.L", "visa L/L ok", "pay with L_L today", "@@@ L.L @@@@", "V V", "@@@@ V V @@", "V ####", "##### V", "@@@ #### V.", 
        "ssn 2##-4#-12##", "social security 1##-3#-21##", "his ssn is 5##-2#-34##, keep it", "@@@@ 3##-5#-61## @@@", "4##-1#-28##", "@@ @@@@@@, 1##-4#-56##, @@@", "1##-2#-34##", "7##-6#-12## @@@@",
    )
    no = (
        "look (at) this (dot) @@@ thing", "staring [at] # . # @@@", "value {at} @@ . #", "@@ at @@ . @@@ @@@", "sold at #. com @@", "@@@@ at @@@@. De @@@@", "met at @@@@@. Us @@ @@@",
        "order 1##-###-####", "part 0##.###.####/@@", "serial: 1##-###-####-##", "id=0##-###-####", "ratio 1## ### ####%", "x1##.###.####.#", "sku 0## ### #### units", "#0## ### ####", "order 3##-5##-####", "ref 4##.6##.####", "@@@ 1##-0##-#### @@",
        "build N.N ok", "ref N/N", "key_N_N", "version N.N", "@@@@ N.N @@", "W W", "@@@ W W @@@", "W ####", "##### W", "isbn W W",
        "isbn 9##-0#-####", "part 000-##-####", "batch 666-##-####", "code 9##-##-####/#", "item 0##-0#-####-@", "@@@ 9##-##-#### @@", "@@@ ###-00-#### @@", "part 3##-4#-12##", "@@@ 666-##-####",
    )
    rng = random.Random(17)

    def group(valid: bool) -> list[str]:
        while True:
            few = rng.sample(range(10), rng.choice((2, 3, 10, 10)))
            d = [rng.choice(few) for _ in range(16)]
            s = sum(x if i % 2 else (2 * x - 9 if 2 * x > 9 else 2 * x) for i, x in enumerate(d))
            if (s % 10 == 0) == valid:
                return ["".join(map(str, d[i : i + 4])) for i in range(0, 16, 4)]

    def fill(t: str) -> str:
        for mark in "LN":
            for sep in "._/":
                if f"{mark}{sep}{mark}" in t:
                    t = t.replace(f"{mark}{sep}{mark}", sep.join(group(mark == "L")))
        for mark in "VW":
            while mark in t:
                t = t.replace(mark, "".join(group(mark == "V")), 1)
        return "".join(rng.choice("0123456789") if c == "#" else rng.choice("abcdefghijklmnopqrstuvwxyz") if c == "@" else c for c in t)

    made = []
    for i in range(EXAMPLES):
        label = i % 2
        made.append((fill(rng.choice(yes if label else no)), label, i % 8 >= 6))
    return made


def _fit(rows: list[tuple[list[float], int]]) -> list[tuple]:
    """Boosted trees of DEPTH levels under logistic loss: nested (feature, cut, below, above), leaves floats."""
    x, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    score = np.zeros(len(rows))

    def grow(at: np.ndarray, depth: int):
        g = y[at] - 1 / (1 + np.exp(-score[at]))
        h = np.maximum(1e-6, np.abs(g) * (1 - np.abs(g)))
        gain = lambda u, v: u * u / (v + 1.0)
        best = None
        for f in range(x.shape[1] if depth else 0):
            order = np.argsort(x[at, f], kind="stable")
            v, u, w = x[at, f][order], np.cumsum(g[order]), np.cumsum(h[order])
            ends = np.flatnonzero(np.diff(v) > 0)
            if not len(ends):
                continue
            found = gain(u[ends], w[ends]) + gain(u[-1] - u[ends], w[-1] - w[ends]) - gain(u[-1], w[-1])
            k = int(found.argmax())
            if found[k] > 1e-9 and (best is None or found[k] > best[0]):
                best = (found[k], f, float(v[ends[k]] + v[ends[k] + 1]) / 2)
        if best is None:
            return RATE * float(g.sum() / (h.sum() + 1.0))
        below = x[at, best[1]] <= best[2]
        return (best[1], best[2], grow(at[below], depth - 1), grow(at[~below], depth - 1))

    trees = []
    for _ in range(TREES):
        trees.append(grow(np.arange(len(rows)), DEPTH))
        score += np.array([_value(trees[-1], r) for r, _ in rows])
    return trees


def _value(tree, x: list[float]) -> float:
    while not isinstance(tree, float):
        tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return tree


def _tree_column(tree, f: Column) -> Column:
    if isinstance(tree, float):
        return F.lit(tree)
    return F.when(F.get(f, F.lit(tree[0])) <= tree[1], _tree_column(tree[2], f)).otherwise(_tree_column(tree[3], f))


_FITTED: list[Model] = []


class Model:
    """Trees and, per kind of proposal, the least score that is selected."""

    def __init__(self, trees: list, thresholds: dict[int, float]):
        self.trees, self.thresholds = trees, thresholds

    @classmethod
    def of_rule(cls, spark: SparkSession) -> Model:
        """The fitted model; it depends on the seeded examples only, so a driver fits it once."""
        if not _FITTED:
            _FITTED.append(cls.fit(spark))
        return _FITTED[0]

    @classmethod
    def fit(cls, spark: SparkSession) -> Model:
        made = spark.createDataFrame(_examples(), "text string, label int, held boolean").coalesce(1)
        rows = made.select("label", "held", F.explode(proposals(F.col("text"))).alias("x")).select("label", "held", "x.k", "x.f").collect()
        trees = _fit([(list(r["f"]), r["label"]) for r in rows if not r["held"]])
        thresholds = {}
        for k in {r["k"] for r in rows}:
            held = sorted(((sum(_value(t, r["f"]) for t in trees), r["label"]) for r in rows if r["held"] and r["k"] == k), reverse=True)
            right, least = 0, math.inf
            for i, (s, label) in enumerate(held):
                right += label
                if right >= PRECISION * (i + 1) and label:
                    least = s
            thresholds[k] = least - 1e-9
        return cls(trees, thresholds)

    def score(self, f: Column) -> Column:
        return reduce(lambda a, b: a + b, [_tree_column(t, f) for t in self.trees])

    def threshold(self, k: Column) -> Column:
        return reduce(lambda c, x: F.when(k == x[0], float(x[1])).otherwise(c), self.thresholds.items(), F.lit(math.inf))


def all_spans(text: Column, base: Column, model: Model) -> Column:
    """The base spans and the selected proposals that overlap neither them nor a better one."""
    scored = F.transform(proposals(text), lambda x: F.struct((-model.score(x.f)).alias("rank"), x.s.alias("s"), x.k.alias("k"), x.e.alias("e")))
    chosen = F.array_sort(F.filter(scored, lambda x: -x["rank"] >= model.threshold(x.k)))
    span = lambda x: F.struct(x.s.alias("s"), x.k.alias("k"), x.e.alias("e"))
    free = lambda acc, x: ~F.exists(acc, lambda y: (y.s < x.e) & (x.s < y.e))
    return F.array_sort(F.aggregate(chosen, base, lambda acc, x: F.when(free(acc, x), F.concat(acc, F.array(span(x)))).otherwise(acc)))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x.k), x.s.cast("string"), x.e.cast("string"))), ",")


def with_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with _base and _spans."""
    model = Model.of_rule(docs.sparkSession)
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumn("_base", base_spans(t)).withColumn("_spans", all_spans(t, F.col("_base"), model))


def find_pii(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of base spans, their digest and all spans; one row per input row."""
    found = with_spans(docs.select(key, text), text)
    count = lambda k: F.size(F.filter("_base", lambda x: x.k == k)).cast("bigint")
    return found.select(
        key, *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS[:4])],
        F.sha2(_joined(F.col("_base")).cast("binary"), 256).alias("base_sha256"), _joined(F.col("_spans")).alias("spans"),
    )


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with each span, or run of overlapping spans, replaced by its kind in brackets."""
    tags = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, x: Column) -> Column:
        fresh = F.concat(acc.out, F.substr(text, acc.at + 1, F.greatest(x.s - acc.at, F.lit(0))), F.get(tags, x.k))
        return F.struct(F.when(x.s >= acc.at, fresh).otherwise(acc.out).alias("out"), F.greatest(acc.at, x.e).alias("at"))

    rest = lambda acc: F.concat(acc.out, F.substr(text, acc.at + 1, F.char_length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, rest)).otherwise(text)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text`` replaced; null texts stay null."""
    return with_spans(docs, text).withColumn(text, redacted(F.col(text), F.col("_spans"))).select(*docs.columns)
