"""The pipeline on a folder of small tables, each stage against what the next may see."""

import corpus_pipeline
from llm.test_text_operators import components_by_force, removed_by_force, words


def test_stages(spark, corpus, tmp_path):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in corpus] + [(None, corpus[40][1], None, None, None)]
    prose = " ".join(f"Word{n} is here now." for n in range(40))
    rows += [(5000 + i, f"{prose} Item{i} ends." + (" You fool!" if i % 2 else ""), "en", "s", 9) for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(5000 + i, 1, i % 2) for i in range(40)] + [(i, 1, 0) for i, _ in corpus],
                          "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, corpus_pipeline.stored(stage(spark, docs, str(tmp_path)), f"test-{name}")
        assert docs.columns == before.columns
        seen[name] = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=repr)
    assert not any("fool" in (t or "") for _, t in seen["toxicity"]) and len(seen["toxicity"]) == len(rows) - 20
    groups = components_by_force([r for r in seen["quality"] if r[0] is not None], 5, 80)
    assert {i for i, _ in seen["near_duplicates"] if i is not None} == {top for _, top in groups.values()}
    lost = removed_by_force([r for r in seen["near_duplicates"] if r[0] is not None], 20)
    for i, text in seen["passages"]:
        if i is not None:
            assert len(words(text)) == lost[i][0] - lost[i][1]
    packed = corpus_pipeline.packed(spark, docs, str(tmp_path))
    assert {r["doc_id"] for r in packed.collect()} == {i for i, _ in seen["passages"]}
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == packed.count()


def test_near_duplicates_go_by_row(spark, tmp_path):
    base = [f"w{n}" for n in range(60)]
    near, other, third = " ".join(base), " ".join(f"o{n}" for n in range(60)), " ".join(f"t{n}" for n in range(60))
    close, closer = " ".join([*base, "x"]), " ".join([*base, "x", "y"])
    alone = [(None, " ".join(f"n{k}-{n}" for n in range(60))) for k in range(3)]
    nulls = [(None, " ".join([*(f"m{n}" for n in range(60)), *tail])) for tail in ([], ["x"], ["x", "y"])]
    rows = [(None, close), (7, near), (7, closer), (7, other), (3, other), (5, third), (5, third), *alone, *nulls]

    def left(some):
        frame = spark.createDataFrame([(i, t, 1) for i, t in some], "doc_id long, text string, n_chars long").repartition(3)
        return sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.distinct(spark, frame, str(tmp_path)).collect()), key=repr)
    found = left(rows)
    assert len(found) == 7 and set(alone) <= set(found) and {(3, other), (5, third)} <= set(found)
    assert sum(row in nulls for row in found) == 1 and sum(row in [(7, near), (7, closer)] for row in found) == 1
    odd = [(None, "a b c d e"), (7, "a b c d e"), (7, "other words are here now"), (3, "Other words ARE here now"), (7, "a b c d e")]
    assert left(odd) == sorted([(7, "a b c d e"), (3, "Other words ARE here now")], key=repr)
