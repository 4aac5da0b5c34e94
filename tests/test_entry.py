"""Driver contract: entry(), queries() / oracle_sql() keys, oracle parity
on the smallest scale, and plan properties of the registered queries."""

import duckdb

import __spark_entry__ as E
from revlens.sources.files import TABLES

from .conftest import SF_SMALL


def test_entry_runs(spark):
    df = E.entry(spark)
    r = df.collect()
    assert len(r) == 1 and r[0].total > 0


def test_oracle_keys_subset():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(o) >= 60


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def test_oracle_parity_small(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    q, o = E.queries(), E.oracle_sql()
    keys = ["kpis", "product_metrics", "watchlist", "monthly_trend", "per_class_prf", "vocabulary", "dedup_text",
            "text_length_quartiles", "helpfulness", "feed_page"]
    for k in keys:
        df = q[k](spark, SF_SMALL)
        s = _canon(df.columns, [tuple(r) for r in df.collect()])
        cur = con.execute(o[k])
        d = _canon([c[0] for c in cur.description], cur.fetchall())
        assert s[0] == d[0], k
        assert [tuple(map(str, x)) for x in s[1]] == [tuple(map(str, x)) for x in d[1]], k


def test_no_python_udf_in_relational_plans(spark):
    q, o = E.queries(), E.oracle_sql()
    for k in ["kpis", "top_words_by_class", "product_top_words", "vocabulary", "clean_text", "bigrams", "eval_metrics"]:
        plan = q[k](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, k


def test_changed_inputs_are_seen(spark, tmp_path):
    import shutil

    import pyarrow.parquet as pq

    from revlens.sources.files import source_version

    for t in ("orders", "lineitem", "customer", "documents"):
        shutil.copyfile(f"{SF_SMALL}/{t}.parquet", tmp_path / f"{t}.parquet")
    d = str(tmp_path)
    before, version = E.queries()["kpis"](spark, d).collect()[0].total, source_version(spark, d, "orders")
    rows = pq.read_table(f"{d}/orders.parquet")
    pq.write_table(rows.slice(0, rows.num_rows // 2), f"{d}/orders.parquet")
    spark.catalog.refreshByPath(f"{d}/orders.parquet")
    assert E.queries()["kpis"](spark, d).collect()[0].total < before
    assert source_version(spark, d, "orders") != version


def test_vocabulary_moves_terms_once_and_counts_repeats(spark):
    from revlens.operators.words import vocabulary

    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["a"]), (3, []), (4, None)], "Id int, w array<string>")
    v = vocabulary(df, "w", min_df=1)
    assert v._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert {(r.term, r.term_freq, r.doc_freq) for r in v.collect()} == {("a", 3, 2), ("b", 1, 1)}


def test_vocabulary_is_counted_in_tasks_of_bounded_text(spark, tmp_path, monkeypatch):
    """One file of one row group: its texts are dealt to tasks by their bytes, and terms merged in as many; counts stay whole."""
    import re
    from collections import Counter

    import pyarrow as pa
    import pyarrow.parquet as pq

    from revlens.operators import words as W
    from revlens.sources.fixtures import document_text

    name = lambda i: "zq" + "".join(chr(97 + int(c)) for c in str(i))
    texts = [" ".join(name((i * 31 + j * j) % 97) for j in range(40)) for i in range(300)] + ["Red  Apple, red apple! 7 red"] * 200 + [None, "", "the", "red"]
    ids = [None if i % 50 == 7 else i % 180 for i in range(len(texts) - 1)] + [1 << 40]
    pq.write_table(pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string()), "source": ["s"] * len(ids)}), tmp_path / "documents.parquet")
    total = sum(len(t or "") for t in texts)
    monkeypatch.setattr(W, "COUNT_BYTES", 2048, raising=False)
    monkeypatch.setattr(W, "MERGE_BYTES", 4096, raising=False)
    for key, n in (("vocabulary", 1), ("vocabulary_bigram", 2)):
        tf, df = Counter(), Counter()
        for t in texts:
            w = [x for x in re.sub("[^a-z]+", " ", (t or "").lower()).split() if x != "the"]
            terms = [" ".join(w[i:i + n]) for i in range(len(w) - n + 1)]
            tf.update(terms)
            df.update(set(terms))
        want = sorted(((t, c, df[t]) for t, c in tf.items() if df[t] >= 5), key=lambda r: (-r[1], r[0]))[:10000]
        v = E.queries()[key](spark, str(tmp_path))
        assert [tuple(r) for r in v.orderBy("index").collect()] == [(*r, i) for i, r in enumerate(want)]
        moved = [int(x) for x in re.findall(r"Exchange .*?, (\d+)\), REPARTITION_BY_NUM", v._jdf.queryExecution().executedPlan().toString())]
        assert len(moved) == 2 and max(moved) >= total // 2048 and min(moved) >= total // 4096, (key, moved)
    sizes = W.dealt_terms(document_text(spark, str(tmp_path)), max(moved)).groupBy("part").count().toPandas()["count"]
    assert sizes.sum() == len(texts) and sizes.max() <= 4 * len(texts) / max(moved)
