"""The corpus pipeline against plain Python over the stages' own verdicts."""

from pyspark.sql import functions as F

import corpus_pipeline
from revlens.llm import line_dedup, lsh_forest, pu_quality, winnow
from revlens.llm.common import id_crc, materialize, read_table

from ..conftest import SF_SMALL


def test_stages_take_effect(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(spark, stage(spark, docs, SF_SMALL), f"test-{name}")
        if name != "packing":
            assert out.dtypes == docs.dtypes
        if name == "quality":
            score = pu_quality.score_quality(spark, docs, read_table(spark, SF_SMALL, "labels"), id_crc() % 5 != 0)
            keep = {r.doc_id for r in score.collect() if r.score >= 0.3}
        elif name == "line_dedup":
            keep = {r.doc_id for r in docs.collect()}
            text = {r.doc_id: r.kept_text for r in line_dedup.drop_repeated_lines(spark, docs).collect()}
            assert all(r.text == text[r.doc_id] and r.n_chars == len(r.text) for r in out.collect())
        elif name == "near_dedup":
            keep = {r.doc_id for r in lsh_forest.near_duplicates(spark, docs).collect() if r.kept}
        elif name == "decontamination":
            got = winnow.decontaminate(spark, docs, read_table(spark, SF_SMALL, "benchmark")).collect()
            keep = {r.doc_id for r in got if not (r.n_hit and 20 * r.n_hit >= r.n_words)}
        else:
            keep = {r.doc_id for r in docs.collect()}
        assert {r.doc_id for r in out.select("doc_id").collect()} == keep
        seen.append(name)
        docs = out
    assert seen == ["quality", "line_dedup", "near_dedup", "decontamination", "packing"]


def test_empty_documents(spark):
    docs = read_table(spark, SF_SMALL, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(spark, stage(spark, docs, SF_SMALL), f"test-empty-{name}")
        assert docs.count() == 0


def test_rows_without_an_id_or_with_a_repeated_one_are_judged_each(spark):
    base = read_table(spark, SF_SMALL, "documents")
    item = read_table(spark, SF_SMALL, "benchmark").where(F.size(F.split("text", " ")) >= 13).first().text
    clean, other = (" ".join(f"{w}{i}" for i in range(60)) for w in "ab")
    rows = [(None, clean), (None, item), (7, other), (7, item), (8, item), (9, clean)]

    def frame(own):
        texts = spark.createDataFrame(own, "_id long, _text string")
        return texts.crossJoin(base.limit(1)).select(*({"doc_id": F.col("_id").cast(base.schema["doc_id"].dataType), "text": F.col("_text")}.get(c, F.col(c)).alias(c)
                                                       for c in base.columns))

    def left(out):
        return sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)

    got = corpus_pipeline.decontamination(spark, frame(rows), SF_SMALL)
    assert left(got) == sorted([(None, clean), (7, other), (9, clean)], key=repr)
    # a row without an id goes with its equal, another stays; of repeated rows one stays, with or without an id
    repeated = [(3, clean), (3, clean), (None, clean), (None, other), (None, other), (4, item)]
    got = corpus_pipeline.near_duplicates(spark, frame(repeated), SF_SMALL)
    assert left(got) == sorted([(3, clean), (None, other), (4, item)], key=repr)
    # every row has its key beside its score, and stays by its own score
    labels = spark.createDataFrame([(7, 1), (8, 0), (9, 1)], "doc_id long, quality int")
    keys = pu_quality.score_quality(spark, frame(rows), labels, F.lit(True), keyed=True)
    want = frame(rows).select("doc_id", F.xxhash64("text").alias("text_key"))
    assert sorted((r[0], r[2]) for r in keys.where("doc_id is not null").collect()) == sorted(map(tuple, want.where("doc_id is not null").collect()))

    # and it stays or goes by that score, where it is read
    score = {r.text_key: r.score for r in keys.collect()}
    least = sorted(set(score.values()))[1]
    kept = pu_quality.keep_quality(spark, frame(rows), labels, F.lit(True), least)
    want = [(r.doc_id, r.text) for r in frame(rows).withColumn("k", F.xxhash64("text")).collect() if score[r.k] >= least]
    assert left(kept) == sorted(want, key=repr) and len(want) < len(rows)


def test_columns_named_like_ours_and_no_length_column(spark, tmp_path):
    lines = "\n".join(f"repeated line {i}" for i in range(3))
    rows = [(i, f"{lines}\nown words of document number {i} " + " ".join(f"w{i}x{j}" for j in range(40)), "en", "s", i, f"t{i}", "k") for i in range(15)]
    schema = "doc_id long, text string, lang string, source string, n_lines int, kept_text string, keep string, id string, row string, x int, bins string, score string"
    docs = spark.createDataFrame([(*r, "i", "r", 1, "b", "0.1") for r in rows], schema).drop("n_chars")
    extra = {c: {r.doc_id: r[c] for r in docs.collect()} for c in docs.columns if c != "text"}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = materialize(spark, stage(spark, docs, SF_SMALL), f"test-clash-{name}")
        assert out.columns == schema.replace(",", "").split()[::2]
        got = out.collect()
        assert all(r[c] == extra[c][r.doc_id] for c in extra for r in got)
        if name != "quality":
            assert len(got) == 15
        if name == "line_dedup":
            assert not any("repeated line" in r.text for r in got)
