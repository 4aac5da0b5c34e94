"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm import (
    exact_dedup, fm_variants, hash_tree, interpolation, line_dedup, lsh_forest, norm_buckets, packing, pu_quality, token_blocks, toxicity,
    url_gbt, winnow,
)
from revlens.llm.common import id_crc, read_table
from revlens.session import scratch_path


def op1_toxicity_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    got = toxicity.score_toxicity(spark, docs, labels, id_crc() % 5 != 0)
    return got.select("doc_id", (id_crc() % 5 == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_lm_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    # of the documents learned from, one in twenty serves to learn the weights
    return interpolation.score_documents(spark, docs, id_crc() % 7 != 2, F.floor(id_crc() / 7) % 20 == 0)


def op3_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    got = winnow.decontaminate(spark, docs, items)
    return got.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                      winnow.contaminated().alias("contaminated"))


def op4_extendible_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(spark, read_table(spark, sf_dir, "documents"))


def op5_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    got = pu_quality.score_quality(spark, docs, labels, id_crc() % 5 != 0)
    return got.select("doc_id", (id_crc() % 5 == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6_line_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    got = line_dedup.drop_repeated_lines(spark, docs)
    return got.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op7_url_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_gbt.judge_urls(spark, read_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op8_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_duplicates(spark, read_table(spark, sf_dir, "documents"))


def op9_hierarchical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_pfor_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "llm", "token-files")
    token_blocks.write_token_files(read_table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_blocks.read_token_files(spark, path)


#: op11: production tree of 40 shards, with room for 64
SHARDS = 40


def op11_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    path = scratch_path(spark, "llm", "shards")
    hash_tree.write_shards(spark, docs, path, hash_tree.Tree(SHARDS))
    stored = hash_tree.read_shards(spark, path, docs.schema)
    text = F.col("row.text")
    return stored.select("row.doc_id", hash_tree.row_size(text).alias("size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
                         F.lit("key").alias("law"), "shard", "slot", hash_tree.shard_of(F.col("row.doc_id"), hash_tree.Tree(SHARDS + 1)).alias("grown_shard"))


def op12_fm_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_variants.variant_groups(spark, read_table(spark, sf_dir, "documents"))


def op13_norm_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return norm_buckets.ranked_search(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_toxicity_ftrl, op2_lm_interpolation, op3_winnowing, op4_extendible_hash, op5_pu_quality, op6_line_bitmaps,
    op7_url_gbt, op8_lsh_forest, op9_hierarchical_packing, op10_pfor_blocks, op11_hash_tree,
    op12_fm_variants, op13_norm_buckets)}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

#: crc32 of a text in SQL: the table of 256 entries by its rule, then one step a byte
_CRC_TABLE = """list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END))"""
_CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(range(strlen({x})),
    lambda i: CAST('0x' || substr(hex({x}), CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT))),
    lambda c, b: xor(c >> 8, {table}[xor(c, b) & 255 + 1])), 4294967295)""".replace("xor(c, b) & 255 + 1", "(xor(c, b) & 255) + 1")


def _tree_sql(shards: int, shape: tuple[int, int, int] = (4, 4, 4), descents: int = 24) -> str:
    """Shard of each id in ``ids`` by the equal-weight tree: first descent that ends in a filled slot.  ``descents``: the chance of more
    is below 1e-9 an id; an id without any is null, which the comparison would show."""
    regions, racks, slots = shape
    unit = lambda path: f"(CAST('0x' || substr(md5(concat_ws(':', k, t, {path})), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0"
    pick = lambda n, path, w: f"CAST(list_position(l, list_min(l)) - 1 AS INTEGER) FROM (SELECT list_transform(range({n}), lambda c: -ln({unit(path)}) / {w}) AS l)"
    return f"""
        SELECT k, arg_min(s, t) AS shard FROM (
          SELECT k, t, (slot * {racks} + rack) * {regions} + region AS s FROM (
            SELECT *, (SELECT {pick(slots, "region, rack, c", "1.0")}) AS slot FROM (
              SELECT *, (SELECT {pick(racks, "region, c", f"{slots}.0")}) AS rack FROM (
                SELECT k, t, (SELECT {pick(regions, "c", f"{racks * slots}.0")}) AS region
                FROM ids, (SELECT unnest(range({descents})) AS t))))) WHERE s < {shards} GROUP BY k"""


SQL = {
    "op4_extendible_hash": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op6_line_bitmaps": f"""
        WITH l AS (
          SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                 generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
        k AS (SELECT *, {_LOWER.format(f"trim(line, {_BLANKS})")} AS key FROM l),
        often AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
        m AS (SELECT k.*, often.key IS NOT NULL AS gone FROM k LEFT JOIN often ON k.key = often.key)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM m GROUP BY doc_id""",
    "op3_winnowing": f"""
        WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[a-z0-9\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM documents),
        b AS (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[a-z0-9\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM benchmark),
        bw AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS g
               FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM b WHERE len(w) > 0)),
        ns AS (SELECT DISTINCT n FROM bw),
        dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
               FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, ns WHERE len(w) >= n)),
        hit AS (SELECT DISTINCT doc_id, i, n, g FROM dw SEMI JOIN bw USING (n, g)),
        words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
                  FROM (SELECT DISTINCT hit.doc_id, CAST(bw.item_id AS VARCHAR) AS item FROM hit JOIN bw USING (n, g)) GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(words.n_hit, 0) AS n_hit, coalesce(items.n_items, 0) AS n_items,
               sha256(coalesce(items.list, '')) AS items_sha256,
               coalesce(words.n_hit, 0) > 0 AND 20 * coalesce(words.n_hit, 0) >= len(d.w) AS contaminated
        FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op8_lsh_forest": f"""
        WITH RECURSIVE d AS (
          SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS g
              FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM d WHERE len(w) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
        link AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
        sym AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, sym.b FROM reach JOIN sym ON reach.b = sym.a),
        low AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, low.component_id, d.doc_id = low.component_id AS kept
        FROM d JOIN low ON low.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id""",
    "op11_hash_tree": f"""
        WITH ids AS (SELECT DISTINCT coalesce(CAST(doc_id AS VARCHAR), '') AS k FROM documents),
        now AS ({_tree_sql(SHARDS)}),
        grown AS ({_tree_sql(SHARDS + 1)}),
        tab AS (SELECT {_CRC_TABLE} AS crc),
        d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(CAST(doc_id AS VARCHAR), '') AS k FROM documents)
        SELECT doc_id, CAST(strlen(text) + 16 AS BIGINT) AS size, CAST({_CRC.format(x="text", table="crc")} AS BIGINT) AS text_crc32,
               'key' AS law, CAST(now.shard AS INTEGER) AS shard,
               row_number() OVER (PARTITION BY now.shard ORDER BY doc_id) - 1 AS slot, CAST(grown.shard AS INTEGER) AS grown_shard
        FROM d JOIN now USING (k) JOIN grown USING (k), tab""",
    "op12_fm_variants": f"""
        WITH RECURSIVE tab AS (SELECT {_CRC_TABLE} AS crc),
        runs AS (SELECT doc_id, {_LOWER.format("run")} AS run, count(*) AS n
                 FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents)
                 WHERE length(run) >= 7 GROUP BY ALL),
        hashed AS (SELECT run, n, {_CRC.format(x="coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run", table="crc")} AS h FROM runs, tab),
        cut AS (SELECT n, CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2)
                          ELSE run END AS word FROM hashed),
        v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
        less AS (SELECT word, i, substr(word, 1, CAST(i - 1 AS INTEGER)) || substr(word, CAST(i + 1 AS INTEGER)) AS d
                 FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)),
        pair AS (SELECT DISTINCT a.word AS w, b.word AS x FROM less a JOIN less b ON a.d = b.d AND a.i = b.i AND a.word <> b.word
                 UNION SELECT less.word, v.word FROM less JOIN v ON v.word = less.d
                 UNION SELECT v.word, less.word FROM less JOIN v ON v.word = less.d),
        near AS (SELECT w, count(*) AS n_near, max(v.n) AS top FROM pair JOIN v ON v.word = x GROUP BY w),
        best AS (SELECT pair.w, min(x) AS x, any_value(near.n_near) AS n_near, any_value(near.top) AS top
                 FROM pair JOIN near ON near.w = pair.w JOIN v ON v.word = x AND v.n = near.top GROUP BY pair.w),
        f AS (SELECT v.word, v.n, coalesce(best.n_near, 0) AS n_near, CASE WHEN top >= 10 * v.n THEN x END AS form,
                     CASE WHEN top >= 10 * v.n THEN top END AS form_n FROM v LEFT JOIN best ON best.w = v.word),
        walk AS (SELECT word, coalesce(form, word) AS at, form IS NULL AS done FROM f
                 UNION ALL SELECT walk.word, coalesce(f.form, f.word), f.form IS NULL FROM walk JOIN f ON f.word = walk.at WHERE NOT done)
        SELECT f.word, f.form, walk.at AS root, f.n, f.n_near, f.form_n FROM f JOIN walk ON walk.word = f.word AND walk.done""",
    "op13_norm_buckets": f"""
        WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[a-z0-9\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM documents),
        q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[a-z0-9\\x{{80}}-\\x{{10FFFF}}]+')) AS term FROM benchmark),
        s AS (SELECT count(*) FILTER (WHERE len(w) > 0) AS nd, CAST(sum(len(w)) AS BIGINT) AS l FROM d),
        tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM d) SEMI JOIN q USING (term) GROUP BY ALL),
        wt AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(nd) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM tf, s GROUP BY term),
        m AS (SELECT doc_id, 50 + (50 * len(w) * nd) // l AS m FROM d, s WHERE len(w) > 0),
        sc AS (SELECT item_id, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
               FROM q JOIN tf USING (term) JOIN wt USING (term) JOIN m USING (doc_id) GROUP BY ALL)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
        FROM sc WHERE score > 0 QUALIFY rank <= 50""",
}
