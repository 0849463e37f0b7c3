import random

import pytest
from llm_rows import SCHEMA, document

import corpus_pipeline


@pytest.fixture(scope="module")
def tables(spark, words, tmp_path_factory):
    """Good documents of three kinds, junk, copies, boilerplate, and one benchmark passage."""
    rng = random.Random(9)
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n)) + "."
    passage = prose(30)
    rows, labels = [], []
    for k in range(300):
        text = "\n".join(prose(rng.randint(8, 40)) for _ in range(4))
        if k % 10 == 1:
            text = " ".join("$$$ %%% ###".split() * 30)
        elif k % 10 == 2:
            text += "\nthis footer stands on every site of the corpus"
        elif k == 13:
            text += " " + passage
        elif k in (23, 33, 43):
            text = rows[3][1]
        rows.append(document(k, text, f"site{k % 7}"))
        labels.append((k, int(k % 10 != 1), 0))
    rows += [document(None, None), document(900, None, None), document(901, ""), rows[5]]
    folder = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tables)
        if name != "mix":
            assert docs.columns == columns
        kept[name] = docs.collect()
    ids = {name: sorted(r["doc_id"] for r in rows if r["doc_id"] is not None) for name, rows in kept.items()}
    quality = [i for i in ids["quality"] if i < 900]
    assert quality == sorted([i for i in range(300) if i % 10 != 1] + [5])
    assert ids["line_dedup"] == ids["quality"]
    texts = {r["doc_id"]: r["text"] for r in kept["line_dedup"]}
    assert sum("footer" in (texts[i] or "") for i in texts) == 1 and "footer" in texts[2]
    assert all(r["n_chars"] == len(r["text"]) for r in kept["line_dedup"] if r["text"] is not None)
    assert not {23, 33, 43} & set(ids["near_dedup"]) and {3, 5} <= set(ids["near_dedup"]) and ids["near_dedup"].count(5) == 1
    assert set(ids["near_dedup"]) - set(ids["decontaminate"]) == {13}
    assert ids["mix"] == ids["decontaminate"] and all(0 <= r["taken"] <= 2 * r["size"] for r in kept["mix"])


def test_run(spark, tables):
    rows = sorted(map(tuple, corpus_pipeline.run(spark, tables).collect()), key=repr)
    assert rows and rows == sorted(map(tuple, corpus_pipeline.run(spark, tables).collect()), key=repr)
    assert corpus_pipeline.ORACLE_SQL is None and [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontaminate", "mix"]


def test_empty_documents(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tables)
    assert docs.count() == 0


#: Names that stages use inside.
CLASHING = ["row", "fingerprint", "same_id", "same_t1", "dropped", "k1", "lines", "quality_score", "node", "fp"]


def test_stages_keep_columns_of_any_name(spark, tables, edge_rows):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(edge_rows, SCHEMA)
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars", *[F.lit(f"own {name}").alias(name) for name in CLASHING]).repartition(3)
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, tables)
        assert docs.columns == columns
        rows = docs.collect()
        assert len(rows) <= n and all(r[c] == f"own {c}" for r in rows for c in CLASHING)
        docs = spark.createDataFrame(rows, docs.schema)
    sizes = dict(corpus_pipeline.STAGES)["mix"](spark, docs, tables)
    assert sizes.count() == docs.count()
