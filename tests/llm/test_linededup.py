import hashlib

from llm_rows import SCHEMA, document

from shoptrail.llm import linededup


def brute_force(rows, sites=6):
    where, first = {}, {}
    for id, text, site in rows:
        for at, line in enumerate(text.split("\n") if text is not None else []):
            key = line.strip(" ")
            if len(key) >= linededup.MIN_CHARS:
                where.setdefault(key, set()).add(site)
                first[key] = min(first.get(key, (True, 0, 0)), (id is None, id or 0, at))
    out = []
    for id, text, site in rows:
        lines = text.split("\n") if text is not None else []
        gone = [
            at for at, line in enumerate(lines)
            if len(where.get(line.strip(" "), ())) >= sites and first[line.strip(" ")] != (id is None, id or 0, at)
        ]
        clean = None if text is None else "\n".join(x for at, x in enumerate(lines) if at not in gone)
        digest = None if clean is None else hashlib.sha256(clean.encode()).hexdigest()
        out.append((id, len(lines), len(gone), len((clean or "").encode()), digest))
    return sorted(out, key=repr)


def rows_with_boilerplate():
    line = lambda k: f"boilerplate line number {k} of this corpus"
    rows = []
    for k in range(1, 13):  # line k stands on k sites
        rows += [(1000 * k + s, f"own words of {k} {s} are here\n  {line(k)} \nshort\n{line(k)}", f"site{s}") for s in range(k)]
    rows += [(50_000 + k, line(3), "site0") for k in range(100)]  # often, but on few sites
    rows += [(60_000, None, "site1"), (60_001, "", None), (None, line(12), None), (60_002, "\n\n", "site2"), (60_003, f"{line(6)}\n" * 3000, None)]
    return rows


def test_matches_brute_force(spark):
    rows = rows_with_boilerplate()
    docs = spark.createDataFrame([document(*r) for r in rows], SCHEMA).repartition(4)
    found = linededup.query(docs)
    assert sorted(map(tuple, found.collect()), key=repr) == brute_force(rows)
    clean = linededup.deduplicated(docs)
    assert clean.columns == docs.columns and clean.count() == len(rows)


def test_coarse_sketches_are_corrected_by_exact_counts(spark):
    """With 16 cells a sketch of 40 sites errs by a quarter; the band around the threshold catches that."""
    rows = [(i * 100 + s, f"a line that stands on {n} sites in this test", f"site{s}") for i, n in enumerate((36, 39, 40, 41, 44)) for s in range(n)]
    docs = spark.createDataFrame([document(*r) for r in rows], SCHEMA)
    lines = linededup._lines(docs, "doc_id", "text", "source", 20)
    assert linededup.boilerplate(lines, sites=40, lg_k=4).count() == 3


def test_repeated_rows_are_treated_alike(spark):
    rows = [(k % 8, "the same line on every one of the sites", f"site{k % 8}") for k in range(16)]
    found = linededup.query(spark.createDataFrame([document(*r) for r in rows], SCHEMA)).collect()
    assert sorted((r["doc_id"], r["n_removed"]) for r in found) == sorted((k % 8, int(k % 8 > 0)) for k in range(16))


def test_empty(no_docs):
    assert linededup.query(no_docs).count() == 0


def test_no_python(edge_docs):
    plan = linededup.query(edge_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_long_passages_go_from_two_sites_on(spark, words):
    passage = lambda k, n: " ".join(words[(k * 50 + i) % 400] for i in range(n))
    rows = [(k, f"own line of document number {k}\n{passage(0, 60)}", f"site{k % 2}") for k in range(4)]  # long, two sites
    rows += [(10 + k, passage(1, 60), "site0") for k in range(3)]  # long, one site
    rows += [(20 + k, passage(2, 49), f"site{k}") for k in range(5)]  # short, five sites
    rows += [(30 + k, passage(3, 49), f"site{k}") for k in range(6)]  # short, six sites
    rows += [(40 + k, passage(4, 50), None if k else "site1") for k in range(2)]  # just long, a null site
    docs = spark.createDataFrame([document(*r) for r in rows], SCHEMA)
    texts = {r["doc_id"]: r["text"] for r in linededup.deduplicated(docs).collect()}
    whole = {r[0]: r[1] for r in rows}
    changed = {k for k in whole if texts[k] != whole[k]}
    assert changed == {1, 2, 3, 31, 32, 33, 34, 35, 41}
    assert texts[1] == "own line of document number 1" and texts[41] == ""
