"""The registered operator queries beside their SQL, and the pipeline stage by stage."""

import random
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from cardwatch.llm import mixing
from cardwatch.llm.queries import QUERIES, SQL
from llm_fixtures import gram_set, prose, thue_morse

SF = "/root/testdata/sf0.001"


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(r[i] for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    got = QUERIES[name](spark, SF)
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.execute(SQL[name])
    assert _rows(got.columns, [tuple(r) for r in got.collect()]) == _rows([d[0] for d in want.description], want.fetchall())


def test_thirteen_operators_and_five_stages():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"file://{tmp_path}/{i}")
        docs = spark.read.parquet(f"file://{tmp_path}/{i}")
        seen.append(docs.toPandas())
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").df()
    marked = labels.assign(kept=labels.doc_id.isin(seen[0].doc_id))
    assert (marked.kept == (marked.quality == 1)).mean() > 0.95
    sets = {r.doc_id: gram_set(r.text, 5) for r in seen[0].itertuples()}
    kept = set(seen[1].doc_id)
    for i in sets:
        partners = [j for j in sets if j != i and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
        assert i in kept or partners
        assert not (i in kept and any(j in kept for j in partners))
    items = [" ".join(t.split()) for (t,) in duckdb.sql(f"SELECT text FROM '{SF}/benchmark.parquet'").fetchall()]
    held = {r.doc_id for r in seen[1].itertuples() if any(t in " ".join(r.text.split()) for t in items)}
    assert held and not held & set(seen[2].doc_id)
    assert set(seen[1].doc_id) - held == set(seen[2].doc_id)
    taken = {r.doc_id: r.taken // max(1, r.size) for r in mixing.mix(
        spark.read.parquet(f"file://{tmp_path}/2")).collect()}
    assert seen[3].doc_id.value_counts().to_dict() == {d: n for d, n in taken.items() if n}
    assert len(seen[4]) == len(seen[3]) and set(seen[4].columns) == {*corpus_pipeline.COLUMNS, "shard", "slot"}
    for _, rows in seen[4].groupby("shard"):
        assert sorted(rows.slot) == list(range(len(rows)))
    assert corpus_pipeline.run(spark, SF).count() == len(seen[4])


PLAIN = "doc_id long, text string, lang string, source string, n_chars long"


def _texts(frame):
    return Counter((r.doc_id, r.text) for r in frame.collect())


def test_near_copies_without_id(spark):
    rng = random.Random(21)
    a, b, c = (prose(rng, 80) for _ in range(3))
    rows = [(1, a), (None, a + " x"), (None, a), (None, b), (None, b), (None, b + " x"), (2, c), (None, ""), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", j) for j, (i, t) in enumerate(rows)], PLAIN)
    got = _texts(corpus_pipeline.near_duplicate_stage(spark, docs, SF))
    of_b = [k for k in got if k[1].startswith(b)]
    assert len(of_b) == 1 and got.pop(of_b[0]) == 1
    assert got == {(1, a): 1, (2, c): 1, (None, ""): 2}


def test_contaminated_documents_and_items_without_id(spark, tmp_path):
    rng = random.Random(22)
    items, clean = [prose(rng, 30) for _ in range(3)], prose(rng, 60)
    spark.createDataFrame([(5, items[0]), (None, items[1]), (None, items[2])], "item_id long, text string").write.parquet(
        f"file://{tmp_path}/benchmark.parquet")
    rows = [(None, prose(rng, 9) + " " + items[0]), (None, items[1] + " x"), (3, items[2]), (None, clean), (4, clean)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], PLAIN)
    got = _texts(corpus_pipeline.decontamination_stage(spark, docs, f"file://{tmp_path}"))
    assert got == {(None, clean): 1, (4, clean): 1}


def test_mix_and_shards_of_rows_without_id(spark):
    rng = random.Random(23)
    rows = [(None if i % 3 == 0 else i, prose(rng, rng.randrange(1, 60)), "en", f"s{i % 3 % 2}", 0) for i in range(300)]
    rows += [(1, "one id, one more text", "en", "s1", 0), rows[3], rows[3], rows[1], (None, None, "en", "s0", 0)]
    docs = spark.createDataFrame(rows, PLAIN).repartition(5)
    mixed = corpus_pipeline.mixing_stage(spark, docs, SF)
    target = {r.size: r.target for r in mixing.mix(docs).selectExpr("source_size as size", "target").distinct().collect()}
    got = _texts(mixed)
    for source in ("s0", "s1"):
        sizes = [len(r[1].split()) for r in rows if r[3] == source and r[1]]
        words = sum(len(r.text.split()) for r in mixed.filter(f"source = '{source}'").collect())
        assert abs(words - target[sum(sizes)]) <= max(sizes)
    assert all(n <= 2 * sum(r[:2] == k for r in rows) for k, n in got.items())
    placed = corpus_pipeline.sharding_stage(spark, mixed, SF).toPandas()
    assert len(placed) == sum(got.values())
    assert placed[placed.doc_id.isna()].shard.nunique() == corpus_pipeline.SHARDS
    for _, part in placed.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))


def _stage(spark, stage, texts, sf=SF):
    rows = [(i, t, "en", "s", 0) for i, t in texts]
    return _texts(stage(spark, spark.createDataFrame(rows, PLAIN).repartition(3), sf))


def test_rows_that_share_an_id_are_judged_by_their_text(spark, tmp_path):
    """Unique texts of a repeated id stay, equal rows of one id go but for one."""
    rng = random.Random(24)
    a, b, c, unique, other = (prose(rng, 80) for _ in range(5))
    got = _stage(spark, corpus_pipeline.near_duplicate_stage,
                 [(1, a), (2, a + " x"), (2, unique), (3, b), (3, b), (3, b), (None, other), (None, c), (9, c)])
    assert got == {(1, a): 1, (2, unique): 1, (3, b): 1, (None, other): 1, (9, c): 1}
    item = prose(rng, 30)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    got = _stage(spark, corpus_pipeline.decontamination_stage, [(2, a + " " + item), (2, unique), (2, unique)], f"file://{tmp_path}")
    assert got == {(2, unique): 2}


def test_texts_of_a_share_of_equal_hashes(spark, tmp_path):
    one, two = thue_morse("ab"), thue_morse("ba")
    got = _stage(spark, corpus_pipeline.near_duplicate_stage, [(1, one), (2, two)])
    assert got == {(1, one): 1, (2, two): 1}
    words = " ".join([one] * 3 + ["b c d e f g h i j k l m"])
    spark.createDataFrame([(1, words)], "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    swapped = words.replace(one, two)
    got = _stage(spark, corpus_pipeline.decontamination_stage, [(1, words), (2, swapped.replace("m", "n"))], f"file://{tmp_path}")
    assert not any(k[0] == 1 for k in got)


def test_pipeline_without_labels_and_without_documents(spark, tmp_path):
    texts = [(1, prose(random.Random(1), 40)), (2, None), (None, "")]
    labels = "doc_id long, quality int, toxic int"
    spark.createDataFrame([], labels).write.parquet(f"file://{tmp_path}/labels.parquet")
    got = _stage(spark, corpus_pipeline.quality_stage, texts, f"file://{tmp_path}")
    assert got == {t: 1 for t in texts}
    for name, kinds in (("documents", PLAIN), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], kinds).write.parquet(f"file://{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, f"file://{tmp_path}").count() == 0
