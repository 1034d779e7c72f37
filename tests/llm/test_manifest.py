"""The Merkle manifest against a plain tree, its versions, and its stages."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from cardwatch.llm import merkle
from cardwatch.llm.queries import QUERIES, tampered_by_id
from llm_fixtures import prose

DOCS = "doc_id long, text string, lang string, source string, n_chars long, grp string, pos long, row int, block int"
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    values = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return sha(*["-" if v is None else f"{len(v.encode())}:{v}" for v in values])


def build(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def siblings(levels, at):
    out = []
    for row in levels[:-1]:
        run = at // 8 * 8
        out.append((row[run:at], row[at + 1 : run + 8]))
        at //= 8
    return out


def brute(rows):
    groups = {}
    for r in rows:
        tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
        changed = leaf(r[0], r[1] and r[1].translate(UPPER), *r[2:5]) if tampered else None
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(*r[:5]), changed))
    names = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    for name in names:
        groups[name].sort(key=lambda x: x[:3])
    trees = {name: build([x[2] for x in groups[name]]) for name in names}
    top = build([trees[name][-1][0] for name in names])
    out = []
    for j, name in enumerate(names):
        for i, (known, doc_id, digest, changed) in enumerate(groups[name]):
            way = siblings(trees[name], i) + siblings(top, j)
            folded = changed or digest
            for left, right in way:
                folded = sha(*left, folded, *right)
            out.append((doc_id if known else None, digest, trees[name][-1][0], top[-1][0],
                        sha(*[x for a, b in way for x in a + b]), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def rows_of(seed, n, langs):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        text = rng.choice([None, "", "Ünï ABC", prose(rng, rng.randrange(1, 30)), prose(rng, 5).title()])
        out.append((i * 7 - 50, text, rng.choice(langs), rng.choice(["s", None, "S:1"]), rng.choice([None, i]), "g", 1, 2, 3))
    return out


def got(spark, rows, levels=1):
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    found = merkle.manifest(docs, *tampered_by_id(), levels).drop("copied")
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.mark.parametrize("n,langs,levels", [
    (150, ["en", "de", None, ""], 4), (75, ["en"], 1), (300, ["en", "é", "z", None, "=", "-"], 1),
    (200, [f"l{i}" for i in range(90)], 1), (1, ["en"], 4), (8, ["en"], 1), (9, [None], 1), (65, ["x"], 2)])
def test_equals_a_plain_tree(spark, n, langs, levels):
    """With small blocks, trees have several stages; results do not depend on where they are cut."""
    rows = rows_of(n, n, langs)
    assert got(spark, rows, levels) == brute(rows)


def test_null_ids_repeated_rows_and_one_long_text(spark):
    rng = random.Random(4)
    rows = rows_of(5, 30, ["en", None]) + [(None, None, None, None, None, None, None, None, None)] * 20
    rows += [(9, "Same ROW", "en", "s", 1, "g", 1, 2, 3)] * 25 + [(12, prose(rng, 30000).title(), "en", "s", 2, "g", 1, 2, 3)]
    assert got(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert got(spark, []) == []


def test_versions_share_what_they_do_not_copy():
    leaves = [sha(str(i)).encode() for i in range(300)]
    tree = merkle.Tree(leaves, 3)
    before, root = len(tree.digests), tree.digests[tree.root]
    own = tree.put(77, sha("new").encode())
    assert len(own) == 4 and len(tree.digests) == before + 4 and tree.digests[tree.root] == root
    changed = [*leaves]
    changed[77] = sha("new").encode()
    assert tree.digests[own[-1]] == merkle.Tree(changed, 3).digests[-1]
    shared = {c for node in own[1:] for c in tree.children[node]} - set(own)
    assert shared and max(shared) < before


def test_copied_nodes_are_the_way_to_the_root(spark):
    rows = rows_of(8, 100, ["en"])
    docs = spark.createDataFrame(rows, DOCS)
    found = merkle.manifest(docs, F.lit(True), F.lit("other"), 1).collect()
    assert len({r.root for r in found}) == 1 and len({r.folded_root for r in found}) == 100
    assert all(len(r.copied) == 4 and r.copied[-1] == r.folded_root and not r.verified for r in found)


def test_query(spark, tmp_path):
    rows = rows_of(6, 120, ["en", "fr", None])
    spark.createDataFrame([r[:5] for r in rows], ", ".join(DOCS.split(", ")[:5])).write.parquet(f"file://{tmp_path}/documents.parquet")
    found = QUERIES["op11_merkle_manifest"](spark, f"file://{tmp_path}")
    assert found.columns[:7] == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r)[:7] for r in found.collect()), key=str) == brute(rows)
