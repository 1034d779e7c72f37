"""Classifiers, decontamination, sharding, mixing and archives."""

import gzip
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from cardwatch.llm import decontaminate, labels, mixing, quality, sharding, textarrays, toxicity, warc
from llm_fixtures import DOCS, documents, frame, prose


def _texts(values):
    return list(textarrays.slices(pa.array(values)))


def test_words_and_shingles():
    values = ["A b\tC d  e", None, "", " \n", "one two", "x" * 300_000, "café au lait"]
    got, at = [], 0
    for texts in _texts(values):
        words = textarrays.Words(texts)
        for i in range(len(texts)):
            got.append([bytes(texts.data[s:e]) for s, e, t in zip(words.starts, words.ends, words.text) if t == i])
        hashes = textarrays.PrefixHash(textarrays.LOWER[texts.data]).ranges(words.starts, words.ends)
        text, _, grams = textarrays.shingles(hashes, words, 3)
        for i in range(len(texts)):
            n = len(got[at + i])
            assert (text == i).sum() == (0 if n == 0 else max(1, n - 2))
        at += len(texts)
    assert got == [(v or "").encode().split() for v in values]


def test_equal_words_have_equal_hashes():
    texts = _texts(["the cat The CAT", "cat"])[0]
    words = textarrays.Words(texts)
    h = textarrays.PrefixHash(textarrays.LOWER[texts.data]).ranges(words.starts, words.ends)
    assert h[0] == h[2] and h[1] == h[3] == h[4] and h[0] != h[1]


def test_folds_are_crc32(spark):
    rows = spark.createDataFrame([(i,) for i in (0, 7, 123456, -5)] + [(None,)], "doc_id long")
    got = rows.select("doc_id", labels.fold(rows.doc_id, 5).alias("f")).collect()
    assert all(r.f == zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 for r in got)


def _labelled(spark, n=400):
    rng = random.Random(2)
    rows, marks = [], []
    for i in range(n):
        junk, rude = rng.random() < 0.3, rng.random() < 0.3
        text = ("spam " * rng.randrange(20, 60)) if junk else ". ".join(prose(rng, 8) for _ in range(rng.randrange(2, 9)))
        if rude:
            text += f". you {rng.choice(['oaf', 'lout', 'OAF'])} {prose(rng, 3)}. " + prose(rng, 5)
        rows.append((i, text, "en", "s", 0, "", 0, 0, 0, 0, 0))
        marks.append((i, int(not junk), int(rude)))
    rows += [(n, "", "en", "s", 0, "", 0, 0, 0, 0, 0), (n + 1, None, "en", "s", 0, "", 0, 0, 0, 0, 0), (None, "a b", "en", "s", 0, "", 0, 0, 0, 0, 0)]
    marks += [marks[0], (None, 1, 1), (3, None, None), (n + 50, 1, 0)]
    return frame(spark, rows), spark.createDataFrame(marks, "doc_id long, quality int, toxic int"), rows, marks


def test_classifiers_on_held_out_rows(spark):
    docs, marks, rows, known = _labelled(spark)
    for module, column, folds, held in ((quality, 1, 4, 2), (toxicity, 2, 5, 0)):
        got = {r.doc_id: r for r in module.classify(docs, marks).collect()}
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got.values())
        out = [m for m in known if m[0] in got and m[0] is not None and m[column] is not None and got[m[0]].held_out]
        assert len(out) > 40 and all(zlib.crc32(str(m[0]).encode()) % folds == held for m in out)
        right = sum((got[m[0]].score >= 0.5) == bool(m[column]) for m in out)
        assert right / len(out) > 0.95
    assert got[400].score == got[401].score == 0


def test_offending_sentences(spark):
    docs, marks, rows, _ = _labelled(spark)
    texts = {r[0]: r[1] for r in rows}
    for r in toxicity.classify(docs, marks).filter("size(offending) > 0").collect():
        for s in r.offending:
            sentence = texts[r.doc_id].encode()[s.start : s.end].decode().lower()
            assert "oaf" in sentence or "lout" in sentence


def test_trees_by_hand():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 4))
    y = ((x[:, 1] > 0.5) ^ (x[:, 2] > 0.3)).astype(float)
    trees = quality.fit_trees(x, y, 40, 3)
    assert ((trees.score(x) > 0.5) == y).mean() > 0.97
    one = trees.base
    for f, c, v in zip(trees.feature, trees.cut, trees.value):
        node = 0
        while node < 7:
            node = 2 * node + 1 + (x[5, f[node]] > c[node])
        one += v[node - 7]
    assert abs(1 / (1 + np.exp(-one)) - trees.score(x[5:6])[0]) < 1e-12
    assert quality.fit_trees(x[:0], y[:0]).score(x[:2]).tolist() == [0.5, 0.5]


def test_contaminated_windows(spark):
    rng = random.Random(4)
    items = [(i, prose(rng, rng.randrange(8, 40))) for i in range(30)] + [(90, None), (91, ""), (92, "two words"), (None, "a b c d e f")]
    rows = []
    for i in range(120):
        body, item = prose(rng, rng.randrange(0, 80)).split(), rng.choice(items[:30])[1].split()
        kind = i % 4
        if kind == 1:
            item[rng.randrange(len(item))] = "other"
        if kind < 3:
            body[len(body) // 2 : len(body) // 2] = item
        rows.append((i, " ".join(body).encode().upper().decode() if kind == 2 else ", ".join(body), "en", "s", 0, "", 0, 0, 0, 0, 0))
    rows += [(500, None, "", "", 0, "", 0, 0, 0, 0, 0), (501, "two, WORDS", "", "", 0, "", 0, 0, 0, 0, 0), rows[0]]

    def grams(text):
        words = [bytes(w) for w in _split(text)]
        return [tuple(words[i : i + 5]) for i in range(len(words) - 4)] if len(words) >= 5 else ([tuple(words)] if words else [])

    def _split(text):
        return "".join(c if c.isalnum() or ord(c) > 127 else " " for c in (text or "")).encode().lower().split()

    want = {}
    for r in rows:
        g = grams(r[1])
        for item, text in items:
            parts = Counter(grams(text))
            m = min(sum(parts.values()), len(g))
            for p in range(len(g) - m + 1) if m and item is not None else ():
                w = Counter(g[p : p + m])
                value = sum((w & parts).values()) / sum((w | parts).values())
                if value >= 0.8 and value > want.get((r[0], item), 0):
                    want[r[0], item] = value
    for size in (4 << 20, 500):
        got = {(r.doc_id, r.item_id): r.similarity for r in
               decontaminate.contaminated(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"), pass_bytes=size).collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    assert (501, 92) in got


def test_contaminated_windows_with_repeated_shingles(spark):
    """A run of one word that differs turns many fingerprint bits, whatever the similarity is."""
    rng = random.Random(14)

    def grams(text):
        words = text.split()
        return [tuple(words[i : i + 5]) for i in range(len(words) - 4)]

    items, rows = [], []
    for i in range(12):
        n, run = ((160, 16), (120, 12), (160, 1))[i % 3]
        body, cut = prose(rng, n).split(), rng.randrange(n)
        theirs = body if run == 1 else body + ["nn"] * run
        mine = body[:cut] + ["mm"] * (run if run > 1 else 14) + body[cut:] if i % 2 else body + ["mm"] * run
        items.append((i, " ".join(theirs)))
        rows.append((i, " ".join(prose(rng, 30).split() + mine + prose(rng, 30).split()), "en", "s", 0, "", 0, 0, 0, 0, 0))
    want = {}
    for r in rows:
        g = grams(r[1])
        for item, text in items:
            parts = Counter(grams(text))
            m = min(sum(parts.values()), len(g))
            for p in range(len(g) - m + 1):
                w = Counter(g[p : p + m])
                value = sum((w & parts).values()) / sum((w | parts).values())
                if value >= 0.8 and value > want.get((r[0], item), 0):
                    want[r[0], item] = value
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.contaminated(
        frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert len(want) >= 6
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_items_without_id(spark):
    rng = random.Random(15)
    texts = [prose(rng, 20) for _ in range(3)]
    items = spark.createDataFrame([(None, texts[0]), (None, texts[1]), ((1 << 60) + 1, texts[2])], "item_id long, text string")
    rows = [(1, texts[0] + " x " + texts[1], "", "", 0, "", 0, 0, 0, 0, 0), (2, texts[2], "", "", 0, "", 0, 0, 0, 0, 0)]
    got = decontaminate.contaminated(frame(spark, rows), items).collect()
    assert sorted((r.doc_id, str(r.item_id)) for r in got) == [(1, "None"), (1, "None"), (2, str((1 << 60) + 1))]


def test_blocks_find_all_within_the_radius():
    rng = np.random.default_rng(3)
    prints = rng.random((50, 128)) > 0.5
    items = decontaminate.Items(np.arange(50), [], prints, decontaminate._blocks(prints), None, None, None)
    bits = prints[rng.integers(0, 50, 300)].copy()
    for row in bits:
        row[rng.choice(128, rng.integers(0, 60), replace=False)] ^= True
    want = {(w, i) for w in range(300) for i in range(50) if (bits[w] != prints[i]).sum() <= decontaminate.RADIUS}
    assert set(items.near(np.arange(50), bits)) == want


def test_shards(spark):
    rows = documents(9)
    got = sharding.assign(frame(spark, rows), [1.0] * 5).collect()
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted(
        (str(r[0]), len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 5)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({(r.doc_id, r.shard) for r in got}) == len({r.doc_id for r in got})


def test_weighted_shards_move_little(spark):
    keys = spark.range(20_000)
    shards = [sharding.rendezvous(keys.id, w).alias(n) for n, w in (
        ("a", [1, 2, 0, 1]), ("b", [1, 2, 0, 1, 1]), ("c", [1, 3, 0, 1]))]
    rows = keys.select(*shards).toPandas()
    share = rows.a.value_counts(normalize=True)
    assert abs(share[1] - 0.5) < 0.02 and 2 not in share and abs(share[0] - 0.25) < 0.02
    assert ((rows.a == rows.b) | (rows.b == 4)).all() and abs((rows.b == 4).mean() - 0.2) < 0.02
    assert ((rows.a == rows.c) | (rows.c == 1)).all()


def _targets(sizes, share=1.5, cap=2.0):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > cap * sizes[s]}
        if not over:
            return out | {s: weight[s] * level for s in open_}
        out |= {s: cap * sizes[s] for s in over}
        left -= sum(out[s] for s in over)
        open_ -= over
    return out


@pytest.mark.parametrize("block", [256, 3])
def test_mix(spark, block):
    rows = documents(11, 200)
    got = mixing.mix(frame(spark, rows), block=block).collect()
    again = mixing.mix(frame(spark, rows).coalesce(1), block=block).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)
    words = [(r[0], r[3], len((r[1] or "").encode().split())) for r in rows]
    sizes = defaultdict(int)
    for _, s, n in words:
        sizes[s] += n
    target = _targets(sizes)
    assert sorted((str(r.doc_id), r.size) for r in got) == sorted((str(d), n) for d, _, n in words)
    by_size = {v: s for s, v in sizes.items()}
    taken = defaultdict(int)
    for r in got:
        s = by_size[r.source_size]
        assert abs(r.target - target[s]) < 1e-6 * max(1, target[s])
        assert r.taken % max(1, r.size) == 0 and r.taken <= 2 * r.size
        taken[s] += r.taken
    longest = {s: max(n for _, x, n in words if x == s) for s in sizes}
    assert all(abs(taken[s] - target[s]) <= longest[s] for s in sizes)


def test_rounding_keeps_expectations(spark):
    """Over many seeds each document is taken as often as its fraction says."""
    rows = spark.createDataFrame([(i, "s", 1 + i % 7, 0.1 + 0.08 * i) for i in range(10)], "doc_id long, source string, size long, p double")
    total = Counter()
    for seed in range(60):
        for r in mixing.pivotal_rounding(rows, 4, seed).collect():
            total[r.doc_id] += r.bit
    assert all(abs(total[i] / 60 - (0.1 + 0.08 * i)) < 0.27 for i in range(10))


def test_archives(spark, tmp_path):
    rng = random.Random(6)
    html = ["<p>" + prose(rng, 40), "x" * 99, "y" * 100, None, "", "ü" * 60, "z" * (17 << 20), "a\0b\r\n\r\nc" * 30]
    pages = [(i, rng.choice(["http://a.example/p?q=1", "https://B.example:81/ü x", None, "no url", "http://[bad"]), rng.choice(html[:6])) for i in range(60)]
    pages += [(100, "http://big.example/", html[6]), (101, "http://big.example/", html[7]), (None, "http://a.example/", html[0]), pages[0]]
    root = f"file://{tmp_path}/warc"
    got = [tuple(r) for r in warc.round_trip(spark.createDataFrame(pages, "page_id long, url string, html string"), root).collect()]
    first = {}
    for i, _, h in pages:
        p = (h or "").encode()
        if len(p) >= 100 and i is not None:
            first[p] = min(first.get(p, i), i)
    want = []
    for i, _, h in pages:
        p = (h or "").encode()
        to = first.get(p) if first.get(p, i) != i else None
        want.append((i, "response" if to is None else "revisit", to, len(p), hashlib.sha256(p).hexdigest(), p if to is None else None))
    assert sorted(((r[0], *r[2:5], r[5], None if r[6] is None else bytes(r[6])) for r in got), key=str) == sorted(want, key=str)
    assert {r[0] for r in warc.lookup(spark, root, "http://big.example/")} == {100, 101}
    assert warc.lookup(spark, root, "http://none.example/") == []
    odd = next(p for p in pages if p[1] and " " in p[1])
    assert {r[0] for r in warc.lookup(spark, root, odd[1])} == {p[0] for p in pages if p[1] == odd[1]}
    records = b"".join(gzip.decompress(f.read_bytes()) for f in (tmp_path / "warc/archives").glob("part-*"))
    assert records.count(b"WARC/1.1\r\n") == len(pages)


def test_url_keys():
    assert warc.url_key("http://blog.Example.com:81/a?b=1") == "com,example,blog:81)/a?b=1"
    assert warc.url_key("https://example.com") == "com,example)/"
    assert warc.url_key(None) == ""


def test_empty_tables(spark, tmp_path):
    none = spark.createDataFrame([], DOCS)
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([], "item_id long, text string")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    for result in (quality.classify(none, marks), toxicity.classify(none, marks), mixing.mix(none),
                   sharding.assign(none, [1.0, 1.0]), decontaminate.contaminated(none, items),
                   decontaminate.contaminated(frame(spark, documents(2)), items),
                   warc.round_trip(pages, f"file://{tmp_path}/none")):
        assert result.count() == 0
    assert {r.score for r in quality.classify(frame(spark, documents(2)), marks).collect()} == {0.5}


def test_many_rows_of_one_size_without_id_are_mixed_in_bounded_blocks(spark):
    """5 000 equal rows: no block holds more than a few times its size, and their draws differ."""
    rows = spark.range(5000).selectExpr("cast(null as long) as doc_id", "'s' as source", "cast(7 as long) as size", "0.5 as p")
    placed = mixing._with_ref(rows)
    assert placed.select("ref").distinct().count() == 5000
    folded = mixing._fold(placed, 0, 0, mixing.BLOCK, "doc_id")
    assert folded.groupBy("piece").count().agg({"count": "max"}).first()[0] <= 2 * mixing.BLOCK
    bits = mixing.pivotal_rounding(rows).groupBy("bit").count().collect()
    assert {r.bit: r["count"] for r in bits} == {0: 2500, 1: 2500}
