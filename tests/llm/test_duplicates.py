"""Exact, near, line and long-match duplicates against brute force."""

import hashlib
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest

from cardwatch.llm import exactdup, fragments, linedup, longmatch, neardup, textarrays
from cardwatch.llm.components import components
from cardwatch.llm.runindex import RunIndex
from llm_fixtures import DOCS, components as brute_components, cut_repeats, documents, frame, prose, thue_morse


@pytest.mark.parametrize("seed,k,percent", [(1, 4, 85), (2, 5, 80), (3, 2, 50)])
def test_near_duplicates(spark, seed, k, percent):
    rows = documents(seed)
    got = neardup.components_of(frame(spark, rows), k, percent)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_components(rows, k, percent)


def test_near_duplicates_without_a_common_centre(spark, monkeypatch):
    """A large group of copies, each edited elsewhere: components although no text is like all."""
    rng = random.Random(5)
    base = prose(rng, 60).split()
    rows = []
    for i in range(120):
        words = list(base)
        for _ in range(rng.randrange(4)):
            words[rng.randrange(60)] = f"edit{i}"
        rows.append((i, " ".join(words), None, None, None, None, 0, 0, 0, 0, 0))
    monkeypatch.setattr(neardup, "HOT_DOCUMENTS", 8)
    got = neardup.components_of(frame(spark, rows), 4, 85)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_components(rows, 4, 85)


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_near_duplicates_across_rows_without_id(spark, monkeypatch, limit):
    """A null-id row between two others joins them; near copies of null-id rows are found."""
    monkeypatch.setattr(neardup, "BROADCAST_NODES", limit)
    rng = random.Random(12)

    def row(i, words):
        return (i, " ".join(words), None, None, None, None, 0, 0, 0, 0, 0)

    chain, other, lone = (prose(rng, 120).split() for _ in range(3))
    rows = [row(1, chain[:100]), row(None, chain[8:108]), row(None, chain[8:108]), row(3, chain[16:116]),
            row(None, other), row(7, other[3:]), row(None, other[6:]), row(None, lone), row(None, lone[2:]), row(9, ["x"])]
    got = sorted((tuple(r) for r in neardup.components_of(frame(spark, rows), 2, 80).collect()), key=str)
    assert got == brute_components(rows, 2, 80)
    assert {r[2] for r in got if r[0] in (1, 3)} == {1} and sum(r[0] is None and r[2] == 7 for r in got) == 2


def test_near_duplicates_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BROADCAST_NODES", 0)
    rows = documents(4)
    got = neardup.components_of(frame(spark, rows), 4, 85)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_components(rows, 4, 85)


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(200)] + [(500, 501), (501, 500), (7, 7)], "u long, v long")
    labels = dict(tuple(r) for r in components(links).collect())
    assert labels == {i: 0 for i in range(201)} | {500: 500, 501: 500}


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_exact_duplicates(spark, limit):
    rows = documents(6)
    got = exactdup.refine(frame(spark, rows), digest_all=True, broadcast_keys=limit).collect()
    plain = [re.sub(r"[\x20\x09-\x0D]", "", r[1] or "") for r in rows]
    groups = {}
    for r, p in zip(rows, plain):
        groups.setdefault(p, []).append((-len(r[1] or ""), r[0] is None, r[0]))
    want = []
    for r, p in zip(rows, plain):
        best = min(groups[p], key=lambda x: (x[0], x[1], x[2] or 0))
        kept = len(groups[p]) == 1 or (r[0] == best[2] and -len(r[1] or "") == best[0])
        want.append((r[0], best[2], len(groups[p]), kept, hashlib.sha256(p.encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_exact_reads_survivors_only(spark):
    rows = documents(6)
    got = exactdup.refine(frame(spark, rows)).collect()
    assert all((r.text_sha256 is not None) or r.group_size == 1 for r in got)
    assert any(r.text_sha256 is None for r in got)


def test_long_matches(spark):
    rows = documents(7)
    got = longmatch.remove_repeats(frame(spark, rows)).collect()
    got = sorted(((1 << 62 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=str)
    want = [(*w[:4], hashlib.sha256(w[4]).hexdigest()) for w in cut_repeats(rows)]
    assert got == sorted(want, key=str)


def test_long_matches_with_frequent_pieces_and_many_flushes(spark, monkeypatch):
    monkeypatch.setattr(longmatch, "HOT_DOCUMENTS", 3)
    monkeypatch.setattr(longmatch, "FLUSH_BYTES", 1000)
    monkeypatch.setattr(longmatch, "BUCKET_BYTES", 500)
    rows = documents(8)
    got = longmatch.remove_repeats(frame(spark, rows)).collect()
    want = [(*w[:4], hashlib.sha256(w[4]).hexdigest()) for w in cut_repeats(rows)]
    got = [(1 << 62 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got]
    assert sorted(got, key=str) == sorted(want, key=str)


def _cut(spark, texts):
    rows = [(i, t, None, None, None, None, 0, 0, 0, 0, 0) for i, t in texts]
    got = longmatch.remove_repeats(frame(spark, rows)).collect()
    got = [(1 << 62 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got]
    want = [(*w[:4], hashlib.sha256(w[4]).hexdigest()) for w in cut_repeats(rows)]
    assert sorted(got, key=str) == sorted(want, key=str)
    return got


def test_long_matches_of_many_rows_without_id(spark):
    """Texts whose hashes agree in 31 bits: a range of one row is not cut out of another."""
    passage = prose(random.Random(9), 12)
    heads = [f"{passage} a{i}" for i in range(120_000)]
    others = [f"b{i} " + "nothing in common with any other text, only long enough" for i in range(120_000)]
    short = [hash_of(heads), hash_of(others)]
    _, a, b = np.intersect1d(*short, return_indices=True)
    assert len(a)
    texts = [(1, passage)] + [(None, t) for i, j in zip(a, b) for t in (heads[i], others[j])]
    got = _cut(spark, texts + [(7, heads[0]), (7, others[0]), (7, heads[0])])
    assert sum(r[2] > 0 for r in got) >= len(a)


def hash_of(texts):
    column = pa.array(texts)
    return np.concatenate([longmatch.text_versions(t, textarrays.PrefixHash(t.data)) for t in textarrays.slices(column)]) >> 33


def test_words_of_equal_polynomial_hash(spark):
    """Long words of two letters, the letters swapped: other words, other sets, other texts."""
    one, two = thue_morse("ab"), thue_morse("ba")
    rows = [(i, t, None, None, None, None, 0, 0, 0, 0, 0) for i, t in enumerate([one, two, f"{one} x y z w", f"{two} x y z w", one])]
    got = sorted((tuple(r) for r in neardup.components_of(frame(spark, rows), 4, 85).collect()), key=str)
    assert got == brute_components(rows, 4, 85)
    _cut(spark, [(1, one), (2, two), (None, one + "!"), (None, two + "!")])


def test_run_index():
    rng = random.Random(1)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 90))) for _ in range(60)]
    document = np.sort(np.array([rng.randrange(40) for _ in strings]))
    first = np.cumsum([0] + [len(s) for s in strings])
    index = RunIndex.build(np.frombuffer(b"".join(strings), np.uint8), first, document, 9)
    number, start, least = index.earliest(np.diff(first), 9)
    want = {}
    for d, s in zip(document, strings):
        for p in range(len(s) - 8):
            want[s[p : p + 9]] = min(want.get(s[p : p + 9], 99), d)
    assert len(number) == sum(max(0, len(s) - 8) for s in strings)
    assert all(want[strings[i][p : p + 9]] == m for i, p, m in zip(number, start, least))


def test_lines(spark):
    rng = random.Random(3)
    rows = []
    for i in range(80):
        lines = ["menu", "", "rare" if i % 8 == 0 else f"own {i}", "seven" if i % 7 == 0 else " ", prose(rng, 4)]
        rows.append((i, None if i == 9 else "\n".join(lines), "en", None if i == 3 else f"s{i % 14}", 0, "", 0, 0, 0, 0, 0))
    rows += [rows[0], (None, "menu\nx", "en", "s1", 0, "", 0, 0, 0, 0, 0)]
    sites = {}
    for r in rows:
        for line in (r[1] or "").split("\n"):
            sites.setdefault(line, set()).add(r[3])
    spread = {x for x, s in sites.items() if x.strip(" ") and len(s - {None}) >= 7}
    want = []
    for r in rows:
        lines = [] if r[1] is None else r[1].split("\n")
        keep = [x for x in lines if x not in spread]
        want.append((r[0], len(lines), len(lines) - len(keep), None if r[1] is None else "\n".join(keep)))
    got = linedup.remove_boilerplate(frame(spark, rows), min_sites=7).collect()
    assert "menu" in spread and "rare" in spread
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_sites_that_a_line_needs(spark):
    """Half of the sites of a small input, ten of a large one; salted occurrences give the same lines."""
    for sites, least in ((0, 2), (3, 2), (5, 3), (19, 10), (400, 10)):
        rows = [(i, "x", None, f"s{i}", None, None, 0, 0, 0, 0, 0) for i in range(sites)] + [(None,) * 11]
        assert linedup.least_sites(frame(spark, rows)) == least
    rows = [(i, f"menu\nown {i}\n{'half' if i % 2 else 'rare'}", "en", f"s{i % 4}", 0, "", 0, 0, 0, 0, 0) for i in range(40)]
    got = [r.text for r in linedup.remove_boilerplate(frame(spark, rows)).collect()]
    assert sorted(got) == sorted(f"own {i}" for i in range(40))


def test_lines_with_more_keys_than_are_sent_around(spark, monkeypatch):
    rows = [(i, f"menu\nown {i}", "en", f"s{i % 5}", 0, "", 0, 0, 0, 0, 0) for i in range(60)]
    monkeypatch.setattr(linedup, "BROADCAST_LINES", 0)
    assert sorted(r.text for r in linedup.remove_boilerplate(frame(spark, rows)).collect()) == sorted(f"own {i}" for i in range(60))


def test_length_round_leaves_prefixes_of_single_lengths_unhashed(spark):
    rows = [(i, "a" * i, None, None, None, None, 0, 0, 0, 0, 0) for i in range(20)] + [(50, "b" * 7, None, None, None, None, 0, 0, 0, 0, 0)] * 2
    keys = {r.length for r in exactdup.repeated_keys(frame(spark, rows)).collect()}
    assert keys == {7}
    got = {r.doc_id: r.group_size for r in exactdup.refine(frame(spark, rows), broadcast_keys=0).collect()}
    assert got[50] == 2 and all(n == 1 for i, n in got.items() if i != 50)


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    for result in (neardup.components_of(none), exactdup.refine(none), longmatch.remove_repeats(none),
                   linedup.remove_boilerplate(none)):
        assert result.count() == 0


def test_a_run_index_is_built_in_little_memory():
    """Less than 100 bytes at a time for each byte of the strings, also where the runs are short."""
    import tracemalloc

    import numpy as np

    from cardwatch.llm.runindex import RunIndex

    draw = np.random.default_rng(5)
    lengths = draw.integers(50, 129, 3000)
    data, first = draw.integers(97, 110, lengths.sum()).astype(np.uint8), np.append(0, np.cumsum(lengths))
    tracemalloc.start()
    RunIndex.build(data, first, np.arange(3000), 50)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 * len(data)


def test_run_indexes_of_short_and_empty_strings():
    import numpy as np

    from cardwatch.llm.runindex import RunIndex

    for strings in ([b""], [b"a", b""], [b"abcabca", b"bcabca", b"\xff" * 9, b"\xff" * 8, b"xabcabca"]):
        lengths = np.array([len(s) for s in strings])
        data, first = np.frombuffer(b"".join(strings), np.uint8), np.append(0, np.cumsum(lengths))
        found = RunIndex.build(data, first, np.arange(len(strings)), 7).earliest(lengths, 7)
        want = {(i, at, next(j for j, t in enumerate(strings) if s[at:at + 7] in t))
                for i, s in enumerate(strings) for at in range(len(s) - 6)}
        assert set(zip(*(c.tolist() for c in found))) == want


@pytest.mark.parametrize("key_bits", [63, 0])
def test_a_run_index_has_the_runs_of_all_sorted_suffixes(monkeypatch, key_bits):
    """Also where two ranks and a place do not fit one key; only suffixes of ``width`` bytes have samples."""
    from cardwatch.llm import runindex

    monkeypatch.setattr(runindex, "_KEY_BITS", key_bits)
    rng = random.Random(11)
    for letters, width in ((b"a", 7), (b"ab", 9), (bytes(range(256)), 50), (b"ab\x00\xff", 50)):
        passage = bytes(rng.choice(letters) for _ in range(150))
        cuts = [sorted((rng.randrange(150), rng.randrange(150))) for _ in range(25)]
        strings = [passage[a:b] for a, b in cuts] + [passage, passage, b""]
        document = np.sort(np.array([rng.randrange(9) for _ in strings]))
        lengths = np.array([len(s) for s in strings])
        data, first = np.frombuffer(b"".join(strings), np.uint8), np.append(0, np.cumsum(lengths))
        index = RunIndex.build(data, first, document, width)
        rows = sorted((s[at:], i, s[at - 1] + 1 if at else 0) for i, s in enumerate(strings) for at in range(len(s) + 1))
        runs = [i for i, r in enumerate(rows) if not i or r[2] != rows[i - 1][2]]
        assert index.run_first.tolist() == runs and index.run_byte.tolist() == [rows[i][2] for i in runs]
        heads = [r[0][:width] if len(r[0]) >= width else None for r in rows]
        groups = [i for i, h in enumerate(heads) if h is not None and (not i or h != heads[i - 1])]
        assert index.group_first.tolist() == groups
        number, start, least = index.earliest(lengths, width)
        found = dict(zip(zip(number.tolist(), start.tolist()), least.tolist()))
        at = {(i, p): s[p : p + width] for i, s in enumerate(strings) for p in range(len(s) - width + 1)}
        assert found == {k: min(d for s, d in zip(strings, document) if w in s) for k, w in at.items()}


def test_a_run_index_takes_less_time_than_eight_argsorts():
    import time

    draw = np.random.default_rng(6)
    base, lengths = draw.integers(97, 123, 2_000).astype(np.uint8), draw.integers(50, 81, 4000)
    data = np.concatenate([base[a : a + n] for a, n in zip(draw.integers(0, 1_900, len(lengths)), lengths)])
    first = np.append(0, np.cumsum(lengths))

    def least_time(work):
        took = []
        for _ in range(3):
            began = time.thread_time()
            work()
            took.append(time.thread_time() - began)
        return min(took)

    numbers = draw.integers(0, 1 << 62, len(data) + len(lengths))
    once = least_time(numbers.argsort)
    assert least_time(lambda: RunIndex.build(data, first, np.arange(len(lengths)), 50)) < 8 * once


def test_fragments_cost_no_pass_over_the_keys_each():
    """Counts of owners are as brute force has them, and 16 384 fragments of a flush take one sort, not a scan per fragment."""
    rng = np.random.default_rng(4)
    hashes = rng.integers(0, 2**64, 60_000, dtype=np.uint64)[rng.integers(0, 60_000, 100_000)]
    owner = rng.integers(0, 50, len(hashes)).astype(np.uint64)
    began = time.process_time()
    batches = list(fragments.pack(hashes, owner, 14))
    assert time.process_time() - began < 3
    rows, found = pa.Table.from_batches(batches), {}
    for i in range(0, rows.num_rows, 400):
        fragment, keys, total, alone = fragments.tally(rows.slice(i, 1))
        found |= {(fragment << 32) | int(k): int(n) for k, n in zip(keys, total)}
        want = {}
        for h, o in zip((hashes >> np.uint64(18)).tolist(), owner.tolist()):
            if h >> 32 == fragment:
                want.setdefault(h, set()).add(o)
        assert {(fragment << 32) | int(k): int(n) for k, n in zip(keys, total)} == {k: len(v) for k, v in want.items()}
        assert sorted(alone.tolist()) == sorted(min(v) for v in want.values() if len(v) == 1)
    assert found


def test_frequent_keys_are_looked_up_not_sorted():
    """A slice's keys are compared with a million frequent ones, again and again."""
    rng = np.random.default_rng(5)
    known = longmatch.Repeats([], 3, 8)
    known.hot = np.unique(rng.integers(0, 2**35, 1_000_000).astype(np.uint64))
    hashes = rng.integers(0, 2**64, 16_000, dtype=np.uint64)
    hashes[::7] = known.hot[: len(hashes[::7])] << np.uint64(29)
    began = time.process_time()
    found = [known.known(hashes)[1] for _ in range(20)]
    assert time.process_time() - began < 3
    assert np.array_equal(found[0], np.isin(hashes >> np.uint64(29), known.hot)) and found[0].any()


def test_marks_differ_in_no_more_bits_than_sets_in_shingles():
    rng = np.random.default_rng(6)
    for n in (0, 1, 40, 3_000):
        pool = np.unique(rng.integers(0, 2**64, n + 300, dtype=np.uint64))
        one, two = (np.sort(rng.choice(pool, n, replace=False)) for _ in range(2))
        text = np.repeat([0, 2], [n, n])
        marks = neardup.set_marks(text, np.append(one, two), 3)
        assert not marks[1].any() and np.bitwise_count(marks[0] ^ marks[2]).sum() <= len(np.setxor1d(one, two))


def test_unlike_pairs_of_common_shingles_are_ruled_out_by_their_marks(spark, monkeypatch):
    """Texts that share a rare run but little else are candidates; their sets are not compared."""
    close, write = [], neardup.written

    def watched(rows, label, *rest):
        found = write(rows, label, *rest)
        if label == "close-pairs":
            close.extend((r.a, r.b) for r in found.collect())
        return found

    monkeypatch.setattr(neardup, "written", watched)
    rng = random.Random(13)
    shared = prose(rng, 60).split()
    rows = []
    for i in range(12):
        own = [f"w{i}x{j}" for j in range(40)]
        for edit in ("", "changed"):  # each has a near copy, so each is possible
            rows.append((len(rows), " ".join([*own, *shared, *own[:20], edit]), None, None, None, None, 0, 0, 0, 0, 0))
    got = neardup.components_of(frame(spark, rows), 4, 85)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_components(rows, 4, 85)
    assert 12 <= len(set(close)) <= 20  # of 276


def test_a_task_sends_a_frequent_window_once(monkeypatch):
    """Its smallest document's place, however many flushes there are; the other places are decided ranges."""
    monkeypatch.setattr(longmatch, "FLUSH_BYTES", 6_000)
    line = prose(random.Random(14), 14)
    texts = [line] * 300
    batch = pa.RecordBatch.from_arrays([pa.array(range(300), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    monkeypatch.setattr(longmatch, "slices", lambda column: textarrays.slices(column, 2_000))

    class Shared:
        def __init__(self, value):
            self.value = value

    class Known:
        def known(self, hashes):
            return np.ones(len(hashes), bool), np.ones(len(hashes), bool)

    sent, decided = [], {}
    for out in longmatch._dealt(Shared(Known()), Shared(np.zeros(0, np.int64)), 8)(iter([batch])):
        for row in out.to_pylist():
            document = np.frombuffer(row["documents"], np.int64)
            start = np.frombuffer(row["starts"], np.int32)
            if row["texts"] is None:
                for d, a, b in zip(document.tolist(), start.tolist(), np.frombuffer(row["lengths"], np.int32).tolist()):
                    decided.setdefault(d, set()).update(range(a, b))
            else:
                sent += [texts[d].encode()[a : a + 50] for d, a in zip(document.tolist(), start.tolist())]
    common = {line.encode()[i : i + 50] for i in range(len(line.encode()) - 49)}
    assert len(common) > 1 and all(sent.count(w) == 1 for w in common)
    assert all(len(decided[d]) >= len(line.encode()) for d in range(1, 300)) and 0 not in decided
