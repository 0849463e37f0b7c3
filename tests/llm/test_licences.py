from llm_rows import SCHEMA, document
from pyspark.sql import functions as F

from shoptrail.llm import licences

MIT = licences.KNOWN["MIT"][-1]
CASES = {
    "Released under the MIT License.": ("MIT", True),
    "RELEASED under the   mit licence": ("MIT", True),
    f"Copyright (c) 2020 A. Author\n\n{MIT}": ("MIT", True),
    f"(C) 1999 Somebody\n{MIT.lower().replace(',', ' -')}": ("MIT", True),
    f"Some words first.\n\n{MIT}\n\nand some after": ("MIT", False),
    f"{MIT} one word more": ("", False),
    "text\nLicensed under CC BY-NC 4.0.\n  Licensed under the Apache Licence, Version 2.0 ": ("Apache-2.0,CC-BY-NC-4.0", False),
    "Licensed under the MIT License. Licensed under the MIT License.": ("", False),
    "Copyright 2020": ("", False),
    "": ("", False),
    "\n\n\n": ("", False),
}


def test_cases(spark):
    rows = [(k, text) for k, text in enumerate(CASES)] + [(90, None), (None, "SPDX-License-Identifier: MIT"), (91, "x " * 60_000), (0, "other")]
    expected = [(k, names, entire) for k, (names, entire) in enumerate(CASES.values())]
    expected += [(90, "", False), (None, "MIT", True), (91, "", False), (0, "", False)]
    found = licences.query(spark.createDataFrame([document(*r) for r in rows], SCHEMA).repartition(3))
    got = [(r["doc_id"], r["licences"], r["entire"]) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert all(r["n_licences"] == len([x for x in r["licences"].split(",") if x]) for r in found.collect())


def test_known_texts_stay_apart(spark):
    known = licences.known_digests(spark)
    n = len({(name, text) for name, texts in licences.KNOWN.items() for text in texts})
    assert known.count() == n and known.select("digest").distinct().count() == n


def test_spellings(spark):
    pairs = [("licence", "LICENSE"), ("authorised", "authorized"), ("favour", "favor"), ("catalogue", "catalog"), ("whilst", "while"),
             ("judgement", "judgment"), ("centre", "center"), ("fulfill", "fulfil"), ("copyright owner", "Copyright-Holder")]
    df = spark.createDataFrame(pairs, "a string, b string")
    assert df.where(licences.canonical(F.col("a")) != licences.canonical(F.col("b"))).count() == 0


def test_large_tables_of_known_texts_need_no_broadcast(spark):
    known = licences.known_digests(spark, {"own": ("a text of our own",)}).hint("merge")
    docs = spark.createDataFrame([document(1, "A text, of our own!"), document(2, "no")], SCHEMA)
    assert sorted((r["doc_id"], r["licences"]) for r in licences.scan(docs, known).collect()) == [(1, ["own"]), (2, [])]


def test_empty(no_docs):
    assert licences.query(no_docs).count() == 0


def test_no_python(edge_docs):
    plan = licences.query(edge_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_whole_texts_in_their_usual_layout(spark):
    lines = MIT.splitlines()
    usual = "\n\n".join(["\n".join(lines[:4]), lines[4], "\n".join(lines[5:])])
    texts = {"MIT": usual} | {f.stem: f.read_text(encoding="utf-8") for f in licences.TEXTS.glob("*.txt")}
    assert {"Apache-2.0", "GPL-3.0", "MPL-2.0", "BSD-3-Clause", "ISC"} <= set(texts)
    rows = [document(2 * k, t) for k, t in enumerate(texts.values())]
    rows += [document(2 * k + 1, f"Words before.\n\n{t}\n\nand after") for k, t in enumerate(texts.values())]
    found = {r["doc_id"]: (r["licences"], r["entire"]) for r in licences.query(spark.createDataFrame(rows, SCHEMA)).collect()}
    for k, name in enumerate(texts):
        assert found[2 * k] == (name, True)
        if name != "BSD-2-Clause":  # all of its paragraphs also stand in BSD-3-Clause
            assert found[2 * k + 1] == (name, False)
