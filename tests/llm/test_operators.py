"""The training-data operators against brute force, on small tables with every odd row."""

import hashlib
import io
import os
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataforge.llm import decontaminate, fingerprints, html_extract, licenses, ngram_join, pii, sharding, spiece, toxicity, warc
from strataforge.llm.queries import SENTENCEPIECE_MODEL

WORDS = [f"w{i}" for i in range(60)]
LONG = " ".join(f"x{i * 7 % 911}" for i in range(6000))
TEXTS = [
    (1, "one two three four five six seven eight nine ten eleven twelve"), (2, "ONE two three four five six seven eight nine ten eleven twelve"), (3, None), (4, ""), (5, "   \n\t "), (6, "a b"),
    (7, "a b"), (8, " ".join(WORDS)), (9, " ".join(WORDS[:-2])), (10, " ".join(WORDS[2:] + ["z"])), (11, LONG), (12, LONG + " tail"), (13, "é😀 ß ñandú x@y.zz"), (14, "a b"), (15, "wort " * 50),
]


def docs(spark, rows=TEXTS):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    # columns that the operators use inside, and must not trip over
    return df.withColumns({"lang": F.lit("en"), "source": F.concat(F.lit("s"), F.coalesce("doc_id", F.lit(0)) % 2), "n_chars": F.length("text").cast("long"), "row": F.lit("r"), "key": F.lit(1), "n": F.lit(2), "range": F.lit(3)})


# ---- 1 ---------------------------------------------------------------------------------------------------------------


def shingles(text):
    w = (text or "").split()
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def test_fingerprints(spark):
    rows = {r["doc_id"]: r for r in fingerprints.fingerprint_documents(docs(spark)).collect()}
    order = sorted(rows)
    by_id = {i: t or "" for i, t in TEXTS}
    assert len(rows) == len(TEXTS)
    for i, doc in enumerate(order):
        own, after = by_id[doc], by_id[order[(i + 1) % len(order)]]
        edit = own[: len(own) - len(own) // 2] + after[: len(own) // 2]
        assert rows[doc]["edited_sha256"] == hashlib.sha256(edit.encode()).hexdigest() and rows[doc]["n_chars"] == len(own)
        for near, other in (("near_edited", edit), ("near_next", after)):
            a, b = shingles(own), shingles(other)
            top = sum((a | b).values())
            exact = sum((a & b).values()) / top if top else 1.0
            # a bin counts like any other even if one shingle holds most of the weight: see the operator's limits
            if max([*a.values(), *b.values(), 0]) <= 8:
                assert abs(rows[doc][near] - exact) < 0.2, (doc, near, exact)
    assert rows[6]["fingerprint"] == rows[7]["fingerprint"] == rows[14]["fingerprint"] != "" and rows[3]["fingerprint"] == ""


def test_weighted_collisions(spark):
    """The collision rate over many texts is the generalised Jaccard similarity, weights counted."""
    rng = np.random.default_rng(3)
    pairs = []
    for i in range(60):
        base = [[f"b{i}_{j}_{k}" for k in range(5)] for j in range(60)]
        a = sum((base[j] * int(rng.integers(1, 5)) for j in range(45)), [])
        b = sum((base[j] * int(rng.integers(1, 5)) for j in range(15, 60)), [])
        pairs.append((i, " ".join(a), " ".join(b)))
    df = spark.createDataFrame(pairs, "i int, a string, b string")
    texts = df.select("i", F.explode(F.array(F.struct(F.lit(0).alias("s"), F.col("a").alias("t")), F.struct(F.lit(1).alias("s"), F.col("b").alias("t")))).alias("x")).select("i", "x.s", "x.t")
    got = fingerprints.draws(fingerprints.weighted_shingles(texts, ["i", "s"], "t"), ["i", "s"]).groupBy("i", "s").agg(F.collect_list("sample").alias("f"))
    sig = {(r["i"], r["s"]): set(r["f"]) for r in got.collect()}
    rate, exact = [], []
    for i, a, b in pairs:
        x, y = sig[i, 0], sig[i, 1]
        rate.append(len(x & y) / len({v >> 16 for v in x | y}))
        p, q = shingles(a), shingles(b)
        exact.append(sum((p & q).values()) / sum((p | q).values()))
    assert abs(np.mean(rate) - np.mean(exact)) < 0.03


def test_fingerprints_of_repeated_lines(spark):
    """Estimates hold where shingles are repeated many times, evenly or not."""
    rng = np.random.default_rng(11)
    rows = []
    for i in range(40):
        lines = [" ".join(f"l{i}_{j}_{k}" for k in range(6)) for j in range(3)]
        rest = [f"r{i}_{k}" for k in range(120)]
        rows.append((2 * i, " ".join([*(lines[0:1] * 40), *rest, *(lines[1:2] * int(rng.integers(1, 40)))])))
        rows.append((2 * i + 1, " ".join([*(lines[0:1] * int(rng.integers(1, 80))), *rest[:60], *(lines[2:3] * 9)])))
    rows.append((80, "wort " * 400))
    rows.append((81, "wort " * 100 + "ende"))
    got = {r["doc_id"]: r for r in fingerprints.fingerprint_documents(docs(spark, rows)).collect()}
    text, off = dict(rows), []
    for i in range(82):
        own, after = text[i], text[(i + 1) % 82]
        edit = own[: len(own) - len(own) // 2] + after[: len(own) // 2]
        for near, other in (("near_edited", edit), ("near_next", after)):
            a, b = shingles(own), shingles(other)
            off.append(got[i][near] - sum((a & b).values()) / sum((a | b).values()))
    assert max(map(abs, off)) < 0.2 and abs(np.mean(off)) < 0.02


# ---- 2 ---------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""), ("", ""), ("just text", "just text"), ("<p>hi", "hi"), ("<!-- open <p>x</p>", ""), ("<p>1 < 2 &amp;&#33;</p>", "1 < 2 &!"),
        ("<html><head><title>t</title></head><body><nav><a href=x>menu</a></nav><article><h1>T</h1><p>a  b\n c<p><b>d<br></p><p>e</p></article><footer>f</footer>", "T\na b c\nd\ne"),
        ("<body><div class='sidebar'><p>side words here</p></div><div id=main><p>One two three four.</p><p>Five <a href=x>six</a> seven.</p><section class='comments'><p>reader says a lot of words, more than the article</p></section></div><form>x</form><script>var t='</p>';</script></body>", "One two three four.\nFive six seven."),
        ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"), ("<div" * 500, ""),
    ],
)
def test_html(page, text):
    assert html_extract.extract(page) == text


def test_html_frame(spark):
    df = spark.createDataFrame([(1, "u", "<p>x y</p>", 1), (1, "u", "<p>x y</p>", 1), (None, None, None, 2)], "page_id long, url string, html string, text int")
    out = html_extract.extract_pages(df).collect()
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in out) == [(0, "", 0), (1, "x y", 3), (1, "x y", 3)]
    assert html_extract.extract_pages(df.limit(0)).count() == 0


def test_threshold_prunes_lists_of_links():
    links = "<div><ul><li><a href=x>Home link</a></li><li><a href=y>Other link</a></li></ul></div>"
    article = "<div><p>" + "A paragraph of an article that says much. " * 9 + "</p><h2>Short</h2><p>See <a href=z>this</a>.</p></div>"
    want = ("A paragraph of an article that says much. " * 9).strip() + "\nShort\nSee this."
    assert html_extract.extract(f"<body>{article}{links}</body>") == html_extract.extract(f"<body>{links}{article}</body>") == want
    assert html_extract.extract("<body><div class='content has-sidebar'><p>kept words</p></div><div class='sidebar'>gone</div></body>") == "kept words"


# ---- 3 ---------------------------------------------------------------------------------------------------------------


def lowered_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_components(rows):
    sets = {i: (lambda w: frozenset(tuple(w[j : j + 4]) for j in range(max(1, len(w) - 3))) if w else frozenset())(lowered_words(t)) for i, t in rows}
    ids, up = [i for i in sets if sets[i]], {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    inverted, common = defaultdict(list), Counter()
    for i in ids:
        seen = Counter(o for s in sets[i] for o in inverted[s])
        for o, c in seen.items():
            if 100 * c >= 85 * (len(sets[i]) + len(sets[o]) - c):
                up[max(find(i), find(o))] = min(find(i), find(o))
        for s in sets[i]:
            inverted[s].append(i)
        common.update(seen.keys())
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_copies(n):
    rng = np.random.default_rng(5)
    base = [f"v{i}" for i in range(200)]
    rows = []
    for i in range(n):
        w = list(base)
        for at in rng.integers(0, 200, int(rng.integers(0, 12))):
            w[at] = f"q{i}_{at}"
        rows.append((100 + i, " ".join(w)))
    return rows


def test_ngram_join(spark):
    rows = TEXTS + near_copies(60)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.link_documents(docs(spark, rows)).collect()}
    assert got == brute_components(rows)


def test_ngram_join_odd_tables(spark):
    assert ngram_join.link_documents(docs(spark).limit(0)).count() == 0
    one = ngram_join.link_documents(docs(spark, [(None, "a b"), (None, "a b"), (2, "A b")])).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"]) for r in one if r["doc_id"]) == [(2, 2)] and len(one) == 3
    kept = ngram_join.one_of_each(docs(spark))
    assert {r["doc_id"] for r in kept.collect()} == {i for i, (_, c) in brute_components(TEXTS).items() if i == c} and kept.columns == docs(spark).columns


def test_all_links(spark, monkeypatch):
    """Every link between different texts, not only those that hold components together; blocks are crossed."""
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    rows = TEXTS + near_copies(60) + [(500, near_copies(2)[1][1]), (None, "a b")]
    sets = {i: frozenset(tuple(w[j : j + 4]) for j in range(max(1, len(w) - 3))) for i, t in rows if i is not None and (w := lowered_words(t))}
    linked = lambda i, j: 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])
    expected = {i: sum(i != j and linked(i, j) for j in sets) for i in sets}
    found = ngram_join.linked_documents(docs(spark, rows)).collect()
    assert len(found) == len(rows) and {r["doc_id"]: r["n_links"] for r in found} == expected | {i: 0 for i, _ in rows if i not in sets}
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found if r["doc_id"]} == brute_components([x for x in rows if x[0]])
    pairs, members = ngram_join.link_pairs(docs(spark, rows))
    first = {s: min(i for i in sets if sets[i] == s) for s in sets.values()}
    assert {r["doc_id"]: r["class_id"] for r in members.collect()} == {i: first[s] for i, s in sets.items()}
    got = [(r["a"], r["b"]) for r in pairs.collect()]
    assert sorted(got) == sorted((i, j) for i in first.values() for j in first.values() if i < j and linked(i, j)) and len(got) > 40
    assert ngram_join.linked_documents(docs(spark).limit(0)).count() == 0


@pytest.mark.parametrize("size", [6, 7, 13, 40, 111, 500, 3000])
def test_plans_hold_the_pigeonhole(size):
    band = ngram_join.band_of(size)
    assert ngram_join.band_of(ngram_join.band_top(band)) == band and ngram_join.band_of(ngram_join.band_top(band) + 1) == band + 1
    segments, wide = ngram_join.plan(band, 1e6)
    h = ngram_join.differences(ngram_join.band_top(band))
    assert 2 * segments > h if wide else segments >= h + 1 + (ngram_join.SPARE if h else 0)


def test_one_of_each_by_row(spark):
    near = " ".join(WORDS)
    rows = [(1, near), (5, near), (5, "an unrelated text of six words"), (5, "an unrelated text of six words"), (None, near), (7, None), (7, None), (8, near + " tail"), (9, "")]
    kept = ngram_join.one_of_each(docs(spark, rows))
    assert kept.columns == docs(spark).columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert got == sorted([(1, near), (5, "an unrelated text of six words"), (None, near), (7, None), (7, None), (9, "")], key=str)
    assert ngram_join.one_of_each(docs(spark, [])).collect() == []


# ---- 4 ---------------------------------------------------------------------------------------------------------------


def toxic_table(spark, n=400):
    rng = np.random.default_rng(1)
    plain = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)]
    rows, labels = [], []
    for i in range(n):
        w = list(rng.choice(plain, 40))
        bad = i % 4 == 0
        if bad:
            w[5], w[20] = ("idiot", "moron") if i % 8 else ("1d10t", "m0r0n")
        rows.append((i, " ".join(w)))
        labels.append((i, 0, int(bad)))
    rows += [(n, None), (n + 1, ""), (None, "idiot moron")]
    return docs(spark, rows), spark.createDataFrame(labels + [(n, 0, None)], "doc_id long, quality int, toxic int")


def test_toxicity(spark):
    texts, labels = toxic_table(spark)
    rows = toxicity.score_documents(texts, labels).collect()
    assert len(rows) == 403
    for r in rows:
        i = r["doc_id"]
        assert r["held_out"] == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        if i is not None:
            assert r["predicted"] == int(i < 400 and i % 4 == 0), i
    kept = toxicity.keep_civil(texts, labels)
    assert kept.columns == texts.columns and kept.count() == 302
    assert toxicity.score_documents(texts, labels.limit(0)).where("predicted = 1").count() == 0


def test_trigrams_are_counted_over_all_texts(spark):
    texts = docs(spark)
    counts = toxicity.trigram_counts(texts)
    assert counts.sum() == sum(len(f" {t} ".encode()) - 2 for _, t in TEXTS if t)


def test_disguises_of_any_length():
    text = "you are a stupid idiot and those morons act like bitches or asses " * 50
    table, c = toxicity._classes(), None
    c = table[np.frombuffer(f" {text} ".encode(), np.uint8)]
    counts = np.bincount((c[:-2] * 28 + c[1:-1]) * 28 + c[2:], minlength=28**3).astype(float)
    reader = toxicity.Reader(toxicity.LetterModel(counts))
    for odd, word in {
        "m0r0n5": "morons", "b1tche$": "bitches", "stu.pid": "stupid", "st-up-id!": "stupid", "i d i o t": "idiot", "y o u a r e a s t u p i d i d i o t": "idiot", "stup" + "i" * 500 + "d": "stupid",
        "idiоt": "idiot", "ｓｔｕｐｉｄ": "stupid", "a c t": "act", "x" * 300 + "1": "xi", "@$$e$": "asses",
    }.items():
        assert word in reader.words(f"so {odd}, they say"), odd
    assert reader.spans("on 2020-01-02 for $100 | 12 | well. 4 5 6 7") == set()


def test_toxicity_of_odd_tables(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (None, 1)], "doc_id long, toxic int")
    got = toxicity.score_documents(docs(spark, [(1, "a b"), (1, "a b"), (1, None), (None, "a b"), (2, "")]), labels).collect()
    assert len(got) == 5 and all(r["score"] == got[0]["score"] for r in got) and all(r["held_out"] is not None for r in got)
    assert toxicity.score_documents(docs(spark, []), labels).collect() == []


# ---- 5 ---------------------------------------------------------------------------------------------------------------


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_contamination(rows, items):
    windows = defaultdict(set)
    for i, t in items:
        w = item_words(t)
        for j in range(max(1, len(w) - 9)) if w else ():
            windows[tuple(w[j : j + 10])].add(i)
    out = {}
    for d, t in rows:
        w = item_words(t)
        hit, found = set(), set()
        for size in {len(k) for k in windows}:
            for j in range(len(w) - size + 1):
                ids = windows.get(tuple(w[j : j + size]))
                if ids:
                    hit.update(range(j, j + size))
                    found |= ids
        s = ",".join(sorted(map(str, found)))
        out[d] = (len(w), len(hit), len(found), hashlib.sha256(s.encode()).hexdigest(), bool(hit))
    return out


@pytest.mark.parametrize("limit", [decontaminate.MAX_BROADCAST, 0])
def test_decontamination(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST", limit)
    items = [(1, "one two three four five six seven eight nine ten eleven"), (2, "w5 w6 w7"), (3, None), (4, ""), (5, LONG[:400]), (6, "wort"), (10, "W5, w6; w7!"), (7, "wort " * 12)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.contamination(docs(spark), bench).collect()
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in rows}
    expected = brute_contamination(TEXTS, items)
    assert got == expected and len(rows) == len(TEXTS)
    kept = decontaminate.drop_contaminated(docs(spark), bench)
    assert {r["doc_id"] for r in kept.collect()} == {d for d, x in expected.items() if not x[4]} and kept.columns == docs(spark).columns
    assert decontaminate.contamination(docs(spark), bench.limit(0)).where("contaminated").count() == 0


# ---- 6 ---------------------------------------------------------------------------------------------------------------


def test_warc_round_trip(spark):
    x = "x" * 150
    rows = [(5, "http://a b\n", x), (4, None, x), (3, "u", x), (2, "u", None), (1, "u", "short"), (6, "u", "short"), (7, "u", "é" * 50)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"id": F.lit(1), "digest": F.lit("d")})
    got = {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.warc_round_trip(pages).collect()}
    for i, _, html in rows:
        b = (html or "").encode()
        first = 3 if html == x and i != 3 else None
        assert got[i] == (len(b), hashlib.sha256(b).hexdigest(), "revisit" if first else "response", first)
    assert warc.warc_round_trip(pages.limit(0)).count() == 0


def test_salvage():
    def rec(i):
        p = b"p%d" % i * 50
        return warc.record("response", f"urn:page:{i}", "u", p, hashlib.sha256(p).hexdigest())

    packed = [warc._member(rec(i)) for i in range(6)]
    broken = bytearray(packed[2])
    broken[30] ^= 255
    data = b"junk" + packed[0] + packed[1] + bytes(broken) + packed[3] + packed[4][:40] + packed[5]
    found = list(warc.salvage(io.BytesIO(data)))
    assert [x["id"] for x in found if x["kind"] == "record"] == ["urn:page:0", "urn:page:1", "urn:page:3", "urn:page:5"]
    at = 0
    for x in found:  # records and gaps cover the file
        assert x["start"] == at
        at += x["length"] if x["kind"] == "gap" else len(packed[int(x["id"][-1])])
    assert at == len(data)
    bare = rec(0) + rec(1)[:100] + rec(2).replace(b"p2p2", b"p2p3", 1) + rec(3)
    assert [x["id"] for x in warc.salvage(io.BytesIO(bare)) if x["kind"] == "record"] == ["urn:page:0", "urn:page:3"]
    assert list(warc.salvage(io.BytesIO(b""))) == []


def test_repeated_pages_and_lost_records(spark, monkeypatch):
    page = "<p>" + "x" * 200 + "</p>"
    pages = lambda rows: spark.createDataFrame(rows, "page_id long, url string, html string")
    rows = [(1, "u", page), (1, "u", page), (2, "u", page), (3, None, None), (3, None, None)]
    got = sorted((r["page_id"], r["record_type"], r["refers_to"]) for r in warc.warc_round_trip(pages(rows)).collect())
    assert got == [(1, "response", None), (1, "response", None), (2, "revisit", 1), (3, "response", None), (3, "response", None)]
    assert warc.warc_round_trip(pages([])).collect() == []
    write = warc.write_warc
    monkeypatch.setattr(warc, "write_warc", lambda *a: write(*a).withColumn("records", F.col("records") + 1))
    with pytest.raises(RuntimeError):
        warc.warc_round_trip(pages(rows))


# ---- 7 ---------------------------------------------------------------------------------------------------------------


def test_sharding(spark):
    rows = TEXTS + [(1000 + i, "t" * (i % 37)) for i in range(3000)] + [(None, "n"), (1000, "")]
    out = sharding.reshard_documents(docs(spark, rows), shards=8).collect()
    assert len(out) == len(rows)
    sizes, slots = Counter(), defaultdict(list)
    for r in out:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) == set(range(8))
    mean = sum(sizes.values()) / 8
    biggest = max(r["size"] for r in out)
    assert all(abs(s - mean) <= 2 * biggest for s in sizes.values())
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in out} == {(i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows}
    assert sharding.reshard_documents(docs(spark).limit(0)).count() == 0


def test_min_cost_flow():
    rng = np.random.default_rng(2)
    for _ in range(20):
        supply = [int(x) for x in rng.integers(0, 50, 5)]
        capacity = [sum(supply) // 4 + 1] * 4
        flow = sharding.min_cost_flow(supply, capacity, lambda i, j: 0 if i == j else 1)
        assert all(sum(f for (i, _), f in flow.items() if i == k) == s for k, s in enumerate(supply))
        assert all(sum(f for (_, j), f in flow.items() if j == k) <= c for k, c in enumerate(capacity))
        moved = sum(f for (i, j), f in flow.items() if i != j)
        assert moved == sum(max(0, s - (capacity[i] if i < 4 else 0)) for i, s in enumerate(supply))
    assert sharding.min_cost_flow([3], [3, 3], lambda i, j: (5, 1)[j]) == {(0, 1): 3}
    with pytest.raises(ValueError):
        sharding.min_cost_flow([3], [2], lambda i, j: 1)


# ---- 8 ---------------------------------------------------------------------------------------------------------------


@pytest.mark.skipif(not os.path.exists(SENTENCEPIECE_MODEL), reason="no model")
def test_pieces(spark, monkeypatch):
    import sentencepiece

    vocabulary = spiece.Vocabulary.load(SENTENCEPIECE_MODEL)
    library = sentencepiece.SentencePieceProcessor(model_file=SENTENCEPIECE_MODEL)
    texts = [t or "" for _, t in TEXTS] + ["  a  b ", "x\n\n y\t", "ＡＢ ﬁ", ". . .", "a" * 100, "中文字符测试" * 20, "\u0000x", "the quick brown fox jumps over the lazy dog " * 20]
    exact, a, b = spiece.Codec(vocabulary), spiece.Codec(vocabulary, 0.1, 7), spiece.Codec(vocabulary, 0.1, 8)
    for t in texts:
        assert exact.encode(t) == library.encode(t)
        assert a.decode(a.encode(t)) == t and a.encode(t) == spiece.Codec(vocabulary, 0.1, 7).encode(t)
    assert a.encode(texts[-1]) != b.encode(texts[-1])
    # many texts together come out as one by one, whatever the sizes of the arrays
    texts += [None, "a▁b", "▁", "▁▁ x ▁", " ", "a ", "\U0010ffff 𐍈x ñ", "z" * 39 + " " + "z" * 41, LONG]
    for codec in (exact, a, spiece.Codec(vocabulary, 0.5, 7), spiece.Codec(vocabulary, 1.0, 7)):
        for together in (3, spiece.TOGETHER):
            monkeypatch.setattr(spiece, "TOGETHER", together)
            offsets, ids = codec.encode_all(texts)
            assert codec.decode_all(offsets, ids) == [t or "" for t in texts]
            for t, first, last in zip(texts, offsets, offsets[1:], strict=False):
                one = codec.encode(t)
                assert ids[first:last].tolist() == one and (codec.decode(one) if one else "") == (t or "")
    assert [len(x) for x in exact.encode_all([])] == [1, 0]
    rows = {r["doc_id"]: r for r in spiece.round_trip(docs(spark), SENTENCEPIECE_MODEL).collect()}
    assert len(rows) == len(TEXTS) and all(r["lossless"] for r in rows.values()) and rows[3]["n_tokens"] == 0
    assert {r["doc_id"]: len(r["token_ids"]) for r in spiece.encode_documents(docs(spark), SENTENCEPIECE_MODEL).collect()} == {i: r["n_tokens"] for i, r in rows.items()}


@pytest.mark.skipif(not os.path.exists(SENTENCEPIECE_MODEL), reason="no model")
def test_occurrences_are_cut_on_their_own():
    vocabulary = spiece.Vocabulary.load(SENTENCEPIECE_MODEL)
    codec = spiece.Codec(vocabulary, 0.1, 7)
    word = "international"
    cuts = lambda ids: Counter("|".join(vocabulary.pieces[i] for i in ids).split("|" + spiece.SPACE))
    assert len(cuts(codec.encode_all([" ".join([word] * 500)])[1])) > 5
    texts = [f"{word} {i}" for i in range(200)]
    offsets, ids = codec.encode_all(texts)
    assert len({tuple(ids[a : a + 3]) for a in offsets[:-1]}) > 3
    # what else is in the batch changes no cut
    alone = [codec.encode_all([t])[1].tolist() for t in texts]
    assert alone == [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)]


@pytest.mark.skipif(not os.path.exists(SENTENCEPIECE_MODEL), reason="no model")
def test_pieces_of_odd_tables(spark):
    rows = [(1, "same text"), (1, "same text"), (None, "same text"), (2, None), (3, ""), (4, "q" * 50_000 + " end")]
    got = spiece.round_trip(docs(spark, rows), SENTENCEPIECE_MODEL).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"] > 0) for r in got) == [(0, True), (1, True), (1, True), (2, False), (3, False), (4, True)]
    assert all(r["lossless"] for r in got) and len({r["ids_sha256"] for r in got if r["doc_id"] in (None, 1)}) == 1
    assert spiece.round_trip(docs(spark, []), SENTENCEPIECE_MODEL).collect() == []


# ---- 9 ---------------------------------------------------------------------------------------------------------------


def luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (2 if i % 2 else 1)
        s += v - 9 if v > 9 else v
    return s % 10 == 0


def brute_base(t):
    only = lambda m: re.sub("[^0-9]", "", m.group())
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 14 <= len(only(m)) <= 19 and luhn(only(m))]
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(only(m)) <= 15]
    return sorted(out)


PII = [
    "a@b.c_d@e.f x", "a@b.c.d@e.f@g.h", "é😀 x@y.zz 1.2.3.4.5.6.7.8 999.1.1.1 0001.2.3.004", "+1 (988) 555-2485 4337166598464399 4337-1665-9846-4399", "a-b_c@d-e.f-g.", None, "", "+12345678901234567 +1234567890-",
    "4111 1111  1111 1111 4111-1111-1111-1111x", "9" * 20000, "a" * 30000 + "@b.c", "+1" + "-" * 3000 + "2", "@@a@b.c@d.e", "1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "1  11  11 " * 300,
    "call (212) 555-0199 or bob (at) mail (dot) com, order 123-456-7890, ssn 123-45-6789; card 4111.1111.1111.1111 and 10.0.0.1", "call (212) 555-0199",
]


def test_pii(spark):
    rows = list(enumerate(PII)) + [(0, PII[0])]
    out = pii.find_pii(docs(spark, rows)).collect()
    assert len(out) == len(rows)
    for r in out:
        base = brute_base(PII[r["doc_id"]] or "")
        listed = [f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(x[1] == k for x in base) for k in range(4)]
        assert set(listed) <= set(r["spans"].split(",")) | {""}
    spans = {r["doc_id"]: r["spans"] for r in out}
    assert "phone:5:19" in spans[15] and "ssn:" in spans[15] and "card:" in spans[15] and "123-456-7890" not in {PII[15][int(s.split(":")[1]) : int(s.split(":")[2])] for s in spans[15].split(",")}
    clean = {r["doc_id"]: r["text"] for r in pii.redact(docs(spark, rows)).collect()}
    assert clean[16] == "call [PHONE]" and clean[5] is None and clean[6] == "" and clean[4] == "[EMAIL]."
    assert pii.find_pii(docs(spark).limit(0)).count() == 0


def test_added_spans(spark):
    """Recall and precision of what the trees add, on sentences that are none of their examples."""
    yes = {
        "You can write to john [at] example [dot] com any time.": ["john [at] example [dot] com"], "212-555-0199 was on the note": ["212-555-0199"], "His number, 123-45-6789, was listed.": ["123-45-6789"],
        "jane.doe (at) mail (dot) org": ["jane.doe (at) mail (dot) org"], "We saw 4111.1111.1111.1111 on it": ["4111.1111.1111.1111"], "two cards 4111111111111111 5500005555555559 lay there": ["4111111111111111", "5500005555555559"],
        "Ring me on (415) 555-2671 please": ["(415) 555-2671"], "maria at gmail dot com": ["maria at gmail dot com"], "reach us: 303.555.0142": ["303.555.0142"], "+1 (988) 555-2485 4337166598464399": ["+1 (988) 555-2485", "4337166598464399"],
        "pay 5500-0055-5555-5559 4111-1111-1111-1111 now": ["5500-0055-5555-5559", "4111-1111-1111-1111"], "my ssn: 219-09-9999": ["219-09-9999"], "bob @ work . com": ["bob @ work . com"], "415 555 2671 is the desk": ["415 555 2671"],
        "4111 1111 1111 1111 12345": ["4111 1111 1111 1111"], "Contact 650-253-0000, ask for Al.": ["650-253-0000"], "the nurse (628) 555-0107 said so": ["(628) 555-0107"], "call center at 888 555 0123.": ["888 555 0123"],
    }
    no = [
        "order 212-555-0199", "version 4111.1111.1111.1112", "the file 000-12-3456", "part 666-45-1234", "He arrived at noon. De Gaulle spoke", "numbers 1234567812345678 8765432187654321", "serial: 123-456-7890-12", "id=123-456-7890",
        "SKU 987-65-4321", "look at the dot on it", "invoice 415-555-2671", "we met at home. Us two", "ratio 100 200 3000", "pages 12-34 and 56-78-90", "isbn 978-3-16-148410-0", "between 1914-1918 and 1939-1945",
    ]
    texts = [*yes, *no]
    found = {r["doc_id"]: [t for t in r["spans"].split(",") if t] for r in pii.find_pii(docs(spark, list(enumerate(texts)))).collect()}
    spans = {i: [texts[i][int(a) : int(b)] for _, a, b in (x.split(":") for x in got)] for i, got in found.items()}
    wanted = [(i, x) for i, t in enumerate(yes) for x in yes[t]]
    assert sum(x in spans[i] for i, x in wanted) >= 0.9 * len(wanted)
    assert sum(len(spans[i]) for i in range(len(yes), len(texts))) <= 1
    # many matches are located as few are
    many = "a@b.co " * 1000
    assert [r["n_email"] for r in pii.find_pii(docs(spark, [(1, many)])).collect()] == [1000]
    assert pii.find_pii(docs(spark, [])).collect() == []


# ---- 10 --------------------------------------------------------------------------------------------------------------


def test_licenses(spark):
    mit = licenses.TEXTS["MIT"]
    variant = "Copyright (c) 2020 Somebody\nAll rights reserved.\n\n" + mit.upper().replace("HOLDERS", "OWNERS").replace(",", " ;").replace("\n", "\n// ")
    rows = [(1, mit), (2, variant), (3, mit + " more"), (4, None), (5, ""), (6, "text\nLicensed under CC BY-NC 4.0.\nlicenced under the Apache License - version 2.0\nlicense to nothing"), (6, "text"), (7, licenses.TEXTS["ISC"])]
    got = sorted((r["doc_id"], r["license"] or "", r["notices"]) for r in licenses.scan_licenses(docs(spark, rows)).collect())
    assert got == [(1, "MIT", ""), (2, "MIT", ""), (3, "", ""), (4, "", ""), (5, "", ""), (6, "", ""), (6, "", "Apache-2.0,CC-BY-NC-4.0"), (7, "ISC", "")]
    assert len({licenses.TEXTS[k] for k in licenses.TEXTS}) == len(licenses.TEXTS)


def test_licence_wordings(spark):
    mit = licenses.TEXTS["MIT"]
    wrapped = "\n".join(mit.replace("AUTHORS OR COPYRIGHT HOLDERS", "AUTHORS OR\nCOPYRIGHT HOLDERS").split("\n"))
    lines = {
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0", "Released under the MIT License.": "MIT", "This software is available under the terms of the Apache License 2.0": "Apache-2.0",
        "# SPDX-License-Identifier: MPL-2.0": "MPL-2.0", "-" * 210 + " Licensed under CC BY-NC 4.0." + " " * 300: "CC-BY-NC-4.0", "MIT": "", "We met the MIT team about a license": "", "Licenced under Creative Commons Attribution-ShareAlike 4.0 International licence": "CC-BY-SA-4.0",
        "license licence license": "",
    }
    rows = [(i, f"some text\n{x}\nand more") for i, x in enumerate(lines)] + [(100, wrapped), (101, "The MIT License (MIT)\n\nCopyright (c) 2020 A. Body\n\n" + mit), (102, "BSD 3-Clause License\nCopyright 2001, The Body.\nAll rights reserved.\n" + licenses.TEXTS["BSD-3-Clause"])]
    got = {r["doc_id"]: r for r in licenses.scan_licenses(docs(spark, rows)).collect()}
    assert [got[i]["notices"] for i in range(len(lines))] == list(lines.values())
    assert [got[i]["license"] for i in (100, 101, 102)] == ["MIT", "MIT", "BSD-3-Clause"]
    same = [r[0] for r in spark.createDataFrame([("licence licence",), ("license licence",), ("licence license",)], "t string").select(licenses.digest(F.col("t"))).collect()]
    assert len(set(same)) == 1
    assert licenses.scan_licenses(docs(spark, [])).collect() == []


