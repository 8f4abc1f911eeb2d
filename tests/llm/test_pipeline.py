import corpus_pipeline
from llm_data import awkward, clashing, docs_of, prose

import __spark_entry__ as entry
from cutline.llm import queries


def test_registered_names():
    assert set(queries.ORACLES) <= set(queries.QUERIES)
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES] == list(range(1, 14))
    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries())


def tables(spark, folder, docs, labels):
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_stages_against_brute_force(spark, tmp_path):
    base = [prose(90, i) for i in range(40)]
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(base)]
    rows += [(100 + i, base[i], "en", "s0", len(base[i])) for i in range(10)]
    rows += [(200 + i, base[i] + " extra", "en", "s0", 0) for i in range(10, 20)]
    rows += [(300 + i, "%%% $$$ ### @@ " * 30, "en", "s0", 0) for i in range(3)]
    docs = clashing(docs_of(spark, rows))
    folder = tables(spark, tmp_path, docs, [(i, 1, 0) for i in range(40)])
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(corpus_pipeline.stored(stage(spark, kept[-1], folder)))
        assert kept[-1].columns == docs.columns
    ids = [{r["doc_id"] for r in k.select("doc_id").collect()} for k in kept]
    assert not ids[1] & {300, 301, 302} and len(ids[1] & set(range(40))) >= 39
    assert ids[2] == {i for i in ids[1] if not (i < 10 and i + 100 in ids[1])}
    assert ids[3] == {i for i in ids[2] if not (200 <= i < 300 and i - 200 in ids[2])}
    assert ids[4] <= ids[3] and len(ids[4]) >= 0.5 * len(ids[3])
    packed = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in packed} == ids[4]


def test_awkward_and_empty_tables(spark, tmp_path):
    folder = tables(spark, tmp_path / "a", docs_of(spark), [(1, 1, 0), (11, 1, 0), (6, 1, 0)])
    got = {r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect()}
    assert got <= {r[0] for r in awkward()} - {3, 4}
    assert corpus_pipeline.run(spark, tables(spark, tmp_path / "b", docs_of(spark, []), [])).count() == 0
