"""The corpus pipeline, stage by stage, on a small corpus with planted cases."""

import random

import pytest

import corpus_pipeline
from tallyframe.llm.queries import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rng = random.Random(8)
    vocab = ["".join(rng.choice(["ka", "lo", "mi", "ru", "se", "to"]) for _ in range(3)) for _ in range(200)]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    docs = [(i, text(rng.choice([30, 80, 200])), "en", "s", 0) for i in range(300)]
    labels = []
    for i in range(0, 300, 3):
        labels.append((i, 1, int(i % 2 == 0)))
        if i % 2 == 0:
            docs[i] = (i, docs[i][1] + " scum idiot " + text(5), "en", "s", 0)
    item = text(30)
    near = docs[1][1].split()
    near[4] = "changed"
    docs += [(300, docs[5][1], "en", "s", 0), (301, " ".join(near) + " " + " ".join(near[:60]), "en", "s", 0), (302, docs[7][1] + " extra", "en", "s", 0), (303, text(5) + " " + item, "en", "s", 0), (304, None, None, None, None), (305, "", "en", "s", 0), (306, text(9000), "en", "s", 0)]
    out = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return str(out)


def test_pipeline(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, left = docs.columns, {r.doc_id for r in docs.collect()}
    gone = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        now = {r.doc_id for r in docs.select("doc_id").distinct().collect()}
        assert now <= left
        gone[name], left = left - now, now
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    toxic = {i for i in range(0, 300, 6)}
    assert gone["toxicity"] == toxic
    assert gone["exact_dedup"] == {300, 305}
    assert 302 in gone["near_dedup"] and gone["near_dedup"] <= {301, 302}
    assert gone["decontamination"] == {303}
    assert gone["packing"] == set()
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).select("doc_id", "piece", "length", "ids_crc32").collect())) == sorted(map(tuple, docs.select("doc_id", "piece", "length", "ids_crc32").collect()))


def test_stages_on_nulls_repeats_and_clashing_columns(spark, sf_dir):
    """Decisions are by row: a repeated id, a null id or a repeated row takes no other document along."""
    long = "word " * 3 + " ".join(f"w{i}x" for i in range(6000))
    rows = [
        (1, "same text here"), (2, "same text here"), (2, "other text"), (3, "q"), (3, "q"), (None, "same  text here"), (None, "alone without an id"), (4, None), (5, ""),
        (6, long), (7, long + " and"), (8, " ".join(f"a{i}" for i in range(60))), (8, " ".join(f"b{i}" for i in range(60))), (9, " ".join(f"a{i}" for i in range(59))),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, _id long, _key string, kept boolean"
    docs = spark.createDataFrame([(i, t, "en", "s", 0, 77, "k", False) for i, t in rows], schema)
    said = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)
    stages = dict(corpus_pipeline.STAGES)
    got = stages["exact_dedup"](spark, docs, sf_dir)
    assert got.columns == docs.columns
    # Of equal texts the longest stays: the one with two blanks.
    assert said(got) == sorted([(2, "other text"), (3, "q"), (None, "same  text here"), (None, "alone without an id"), (4, None), *rows[9:]], key=repr)
    got = stages["near_dedup"](spark, docs, sf_dir)
    assert said(got) == sorted([rows[0], rows[2], rows[3], rows[4], *rows[6:10], *rows[11:13]], key=repr)
    bad = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first().text
    more = docs.unionByName(spark.createDataFrame([(8, "x " + bad, "en", "s", 0, 1, "k", True), (None, bad, "en", "s", 0, 1, "k", True)], schema))
    got = stages["decontamination"](spark, more, sf_dir)
    assert said(got) == sorted(rows, key=repr) and got.columns == docs.columns
    whole = spark.read.parquet(f"{sf_dir}/documents.parquet")
    clean, insult = whole.where("doc_id = 1").first().text, whole.where("doc_id = 0").first().text + " more"
    more = whole.unionByName(spark.createDataFrame([(1, insult, "en", "s", 0), (None, insult, "en", "s", 0)], whole.schema))
    got = said(stages["toxicity"](spark, more, sf_dir))
    assert (1, insult) not in got and (None, insult) not in got and {(1, clean), (304, None), (305, "")} <= set(got)
    packed = stages["packing"](spark, docs, sf_dir)
    assert sorted(((r.doc_id, r.piece) for r in packed.where("doc_id in (3, 4, 5)").collect())) == [(3, 0), (3, 0), (4, 0), (5, 0)]
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), sf_dir).collect() == [], name


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
    assert set(ORACLE_SQL) <= set(QUERIES)
