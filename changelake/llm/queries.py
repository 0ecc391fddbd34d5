"""The operators as named queries over the test tables, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def named(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with its SQL for DuckDB."""

    def register(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return register


def vocabulary(name: str) -> str:
    """A file of the public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed_digest(sequences: DataFrame) -> DataFrame:
    """What op7 returns of each piece."""
    return sequences.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@named("op7_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from changelake.llm.packing import pack

    docs = table(spark, sf_dir, "documents")
    return packed_digest(pack(docs, vocabulary("byte_bpe_50k.json"), end_id=1, longest=2048, added_tokens=True))


@named("op8_token_files")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from changelake.llm.huffman import read_tokens, write_tokens
    from changelake.llm.storage import shared_folder

    folder = shared_folder(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), folder, vocabulary("word_bpe_49k.json"), end_id=1, added_tokens=True)
    return read_tokens(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


LINES_SQL = """
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (SELECT r, doc_id, len(lines) AS n_lines, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM doc),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM line),
common AS (SELECT key, max(doc_id) AS top FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT r) >= 3),
marked AS (SELECT k.*, c.key IS NOT NULL AND k.doc_id IS DISTINCT FROM c.top AS dropped
    FROM keyed k LEFT JOIN common c ON c.key = k.key AND length(k.key) >= 20)
SELECT doc_id, CAST(any_value(n_lines) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE dropped) AS BIGINT) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""


@named("op1_line_dedup", LINES_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from changelake.llm.line_dedup import dedup_lines

    kept = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=3, min_chars=20)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@named("op10_mixing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from changelake.llm.mixing import mixed, per_row

    mix = mixed(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, most=2.0)
    return per_row(mix).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


TOP_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.x AS DOUBLE[]), CAST(c.x AS DOUBLE[])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@named("op2_top_k", TOP_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from changelake.llm.bit_sliced import top_k

    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, F.col("vec_id") % 20 == 0, k=20, scale=64.0)


@named("op4_near_dup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from changelake.llm.near_dup import clusters

    found = clusters(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=2, percent=80)
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


@named("op6_quality_rules")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from changelake.llm.outliers import COUNTS, judged

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return judged(docs).select("doc_id", *COUNTS, "base_failed", "kept", "distance")


def licence_sql() -> str:
    from changelake.llm.licences import TEMPLATES, THRESHOLD, plain_words

    rows = ", ".join(f"('{name}', '{' '.join(plain_words(text))}')" for name, text in TEMPLATES.items())
    pairs = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    return f"""
WITH template AS (SELECT name, {pairs} AS b FROM (SELECT name, string_split(words, ' ') AS w FROM (VALUES {rows}) t(name, words))),
doc AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_replace(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g') AS norm FROM documents),
unit AS (SELECT r, unnest(list_concat(string_split(norm, chr(10)), regexp_split_to_array(norm, '\\n *\\n'), [norm])) AS u FROM doc),
word AS (SELECT r, regexp_split_to_array(trim(u, ' ' || chr(10)), '[ \\n]+') AS w FROM unit),
bigram AS (SELECT r, {pairs} AS b FROM word WHERE len(w) >= 2),
found AS (SELECT u.r, t.name, 2.0 * len(list_intersect(u.b, t.b)) / CAST(len(u.b) + len(t.b) AS DOUBLE) AS dice FROM bigram u, template t),
best AS (SELECT r, list_sort(list_distinct(list(name))) AS licences, max({{'dice': dice, 'name': name}}) AS m
    FROM found WHERE dice >= {THRESHOLD} GROUP BY r)
SELECT d.doc_id, array_to_string(coalesce(b.licences, []), ',') AS licences, b.m.name AS best_licence, CAST(b.m.dice AS DOUBLE) AS best_dice
FROM doc d LEFT JOIN best b ON b.r = d.r
"""


@named("op5_license_scan", licence_sql())
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from changelake.llm.licences import scan

    found = scan(table(spark, sf_dir, "documents"))
    return found.withColumn("licences", F.array_join("licences", ","))


@named("op5_license_windows")
def op5_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from changelake.llm.licences import scan_windows

    found = scan_windows(table(spark, sf_dir, "documents"))
    return found.withColumn("licences", F.array_join("licences", ","))


@named("op3_suffix_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from changelake.llm.suffixes import repeated_spans

    return repeated_spans(table(spark, sf_dir, "documents").select("doc_id", "text"), length=50)


@named("op9_transcripts")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from changelake.llm.transcripts import parsed

    return parsed(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


MIDDLE_SQL = """
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
hashed AS (SELECT r, doc_id, t, n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
    CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM doc),
cut AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM hashed),
part AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM cut)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
      ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(CASE form WHEN 'plain' THEN t ELSE p || m || s END) AS restored_sha256
FROM part
"""


@named("op13_fill_middle", MIDDLE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from changelake.llm.fill_middle import fill_in_middle, restored

    cut = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"), percent=90, spm_percent=20, seed=1)
    text = restored(F.col("output"), F.col("form"))
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"), F.sha2(text.cast("binary"), 256).alias("restored_sha256"),
    )


COPIES_SQL = """
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, CAST(count(*) OVER (PARTITION BY t) AS BIGINT) AS group_size,
    row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST, r) = 1 AS kept, sha256(t) AS text_sha256
FROM doc
"""


@named("op12_exact_dedup", COPIES_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from changelake.llm.cuckoo import copies

    found = copies(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", F.col("first").alias("kept"), F.lower(F.hex("key")).alias("text_sha256"))


RESAMPLING_SQL = """
WITH RECURSIVE lowered AS (SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
doc AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(t, ''), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM lowered),
aim AS (SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM benchmark),
own AS (SELECT r, unnest(words) AS word FROM doc),
known AS (SELECT DISTINCT word, hex(encode(word)) AS x FROM (SELECT word FROM own UNION ALL SELECT word FROM aim)),
bits AS (SELECT word, list_transform(range(0, 4 * len(x)), lambda i: (CAST('0x' || x[i // 8 * 2 + 1:i // 8 * 2 + 2] AS BIGINT) >> (i % 8)) & 1) AS b FROM known),
crc AS (SELECT word, xor(list_reduce(list_concat([4294967295], b),
    lambda c, bit: xor(c >> 1, CASE WHEN xor(c, bit) & 1 = 1 THEN 3988292384 ELSE 0 END)), 4294967295) % 10000 AS bucket FROM bits),
s AS (SELECT bucket, count(*) AS n FROM own JOIN crc USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM aim JOIN crc USING (word) GROUP BY bucket),
gain AS (SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * ((SELECT count(*) FROM own) + 10000)
    / (CAST(coalesce(s.n, 0) + 1 AS DOUBLE) * ((SELECT count(*) FROM aim) + 10000)))) AS BIGINT) AS g FROM s FULL JOIN t USING (bucket)),
weighed AS (SELECT r, CAST(sum(g) AS BIGINT) AS w FROM own JOIN crc USING (word) JOIN gain USING (bucket) GROUP BY r),
scored AS (SELECT r, doc_id, CAST(len(words) AS BIGINT) AS n_features, coalesce(w, 0) AS weight, coalesce(w, 0) + CAST(floor(-1000 * ln(-ln(
    (CAST('0x' || sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
    FROM doc LEFT JOIN weighed USING (r)),
ranked AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CAST(CASE WHEN rank <= n * 10 // 100 THEN rank END AS BIGINT) AS rank
FROM scored LEFT JOIN ranked USING (r)
"""


@named("op11_resampling", RESAMPLING_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from changelake.llm.importance import resampled

    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    drawn = resampled(docs, target, percent=10, min_words=20, sizes=(1, 1), n_buckets=10_000, seed=2024)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")
