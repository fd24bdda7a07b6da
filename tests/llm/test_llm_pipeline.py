from __future__ import annotations

import random

import corpus_pipeline
from llm_data import documents, frame, sentence
from test_llm_recompress import brute as cut_words
from test_llm_simhash import fingerprint, groups



def test_stages_match_brute_force(spark, tmp_path):
    rng = random.Random(8)
    item = sentence(rng, 30)
    rows = [*documents(), (700, sentence(rng, 50) + ". " + item + " " + sentence(rng, 9), "en", "s", 0), (701, "123 456 ...", "en", "s", 0)]
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, sf_dir = frame(spark, rows), str(tmp_path)
    columns = docs.columns
    first = corpus_pipeline.language(spark, docs, sf_dir)
    want = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    assert first.columns == columns and sorted(map(str, map(tuple, first.collect()))) == sorted(map(str, want))

    second = corpus_pipeline.near_copies(spark, first, sf_dir)
    root = groups({fingerprint(r[1]) for r in want})
    least = {}
    for r in want:
        g = root[fingerprint(r[1])]
        least[g] = min(least.get(g, 1 << 62), 1 << 62 if r[0] is None else r[0])
    got = [tuple(r) for r in second.collect()]
    assert second.columns == columns and sorted(r[0] for r in got) == sorted(set(least.values()))

    third = corpus_pipeline.repeated_passages(spark, frame(spark, got), sf_dir)
    cut = [(k, kept if gone else text) for k, text, kept, _, gone in cut_words(got) if not gone or kept]
    assert third.columns == columns and sorted((r["doc_id"], r["text"]) for r in third.collect()) == sorted(cut)

    fourth = corpus_pipeline.decontamination(spark, third, sf_dir)
    assert sorted(r["doc_id"] for r in fourth.collect()) == sorted(k for k, _ in cut if k != 700)
    last = corpus_pipeline.packing(spark, fourth, sf_dir)
    assert {r["doc_id"] for r in last.select("doc_id").distinct().collect()} == {k for k, _ in cut if k != 700}


def test_run_reads_documents(spark, tmp_path):
    frame(spark, [(1, "one two three", "en", "s", 13), (2, "four five six", "en", "s", 13)]).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().count() == 2


def test_near_copies_keep_a_row_of_every_group(spark):
    rng = random.Random(11)
    texts = [sentence(rng, 40) for _ in range(30)]
    rows = [(None, t, "en", None, i) for i, t in enumerate(texts[:15])] * 2  # many unlinked texts without an id, each twice
    rows += [(7, t, "en", "s", 0) for t in texts[15:25]]  # one id, ten texts
    rows += [(3, texts[20], "en", "s", 0), (9, texts[0], "en", "s", 0)]  # a smaller id for one of them, an id for a text without one
    rows += [(50 + i, t, None, "s", 0) for i, t in enumerate(texts[25:])] * 2
    rows += [(None, texts[1], None, "en", 1), (None, texts[2], "fr", None, 2)]
    stage = dict(corpus_pipeline.STAGES)["simhash_neardup"]
    got = [tuple(r) for r in stage(spark, frame(spark, rows).repartition(4), "").collect()]
    root = groups({fingerprint(t) for t in texts})
    want = {}
    for r in rows:
        g = root[fingerprint(r[1])]
        want[g] = min(want.get(g, (True, 0)), (r[0] is None, r[0] or 0))
    assert len(want) == len(got) == 30 and set(got) <= set(rows)
    assert {root[fingerprint(r[1])]: (r[0] is None, r[0] or 0) for r in got} == want


def test_language_without_labels(spark):
    rows = [(1, "one two", None, "s", 7), (2, "123 456", None, "s", 7), (3, None, None, "s", None), (None, "été", None, None, 3), (5, "", None, "s", 0)]
    got = corpus_pipeline.language(spark, frame(spark, rows), "")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, (rows[0], rows[3])))


def test_decontamination_keeps_other_rows_of_an_id(spark, tmp_path):
    rng = random.Random(21)
    item = sentence(rng, 30)
    half = item.split()
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(None, "See " + item, "en", "s", 1), (None, sentence(rng, 40), "en", "s", 2), (None, None, None, None, None), (None, "", "en", "s", 0),
            (5, item + ".", "en", "s", 3), (5, sentence(rng, 40), "en", "s", 4), (5, item + ".", "fr", "s", 5),
            (6, " ".join(half[:15]), "en", "s", 6), (6, " ".join(half[15:]), "en", "s", 7)]  # two rows do not add up
    got = corpus_pipeline.decontamination(spark, frame(spark, rows).repartition(3), str(tmp_path))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, (rows[i] for i in (1, 2, 3, 5, 7, 8))))


def test_stages_take_empty_tables_and_clashing_names(spark, tmp_path):
    spark.createDataFrame([(1, "what is the name of the thing that was asked")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    names = ["__own_score", "score", "lang_pred", "__text", "__all", "__id", "__none", "__found", "kept", "n_words", "row", "fp", "__letter"]
    rng = random.Random(3)
    rows = [(i, sentence(rng, 20), ("en", "fr")[i % 2], "s", 0) for i in range(6)]
    for data in (rows, []):
        docs = frame(spark, data).selectExpr("*", *[f"{i} AS `{n}`" for i, n in enumerate(names)])
        for name, stage_of in corpus_pipeline.STAGES[:-1]:
            out = stage_of(spark, docs, str(tmp_path))
            assert out.columns == docs.columns and out.count() == len(data), name
        assert corpus_pipeline.packing(spark, docs, str(tmp_path)).select("doc_id").distinct().count() == len(data)
