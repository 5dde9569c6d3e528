"""Registered queries of the operators, each over its whole table, and their
DuckDB twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


LINES_SQL = """
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                  generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
t AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS p FROM l WHERE trim(line, ' ') <> ''),
w AS (SELECT doc_id, p, line || chr(10) || lead(line, 1) OVER d || chr(10) || lead(line, 2) OVER d AS k
      FROM t WINDOW d AS (PARTITION BY doc_id ORDER BY p)),
later AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS r
                                 FROM w WHERE k IS NOT NULL) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, p + o AS p FROM later CROSS JOIN (VALUES (0), (1), (2)) AS o(o)),
gone_i AS (SELECT doc_id, i FROM gone JOIN t USING (doc_id, p)),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS text
         FROM l ANTI JOIN gone_i USING (doc_id, i) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_lines FROM t GROUP BY doc_id),
g AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN g USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@register("op2_line_dedup", LINES_SQL)
def op2_line_dedup(spark, d):
    """Line dedup over all documents: counts and a digest of the kept text."""
    from .linededup import line_dedup
    return line_dedup(table(spark, d, "documents").select("doc_id", "text"), counts=True) \
        .select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@register("op6_ngram_jaccard_join")
def op6_ngram_jaccard_join(spark, d):
    """Five-word shingles, Jaccard 0.75: set size and component per document."""
    from .jaccard import jaccard_components
    return jaccard_components(table(spark, d, "documents"))


@register("op3_substring_dedup")
def op3_substring_dedup(spark, d):
    """Fifty-word repeats of earlier documents: counts and a digest of what is kept."""
    from .substring import substring_dedup
    return substring_dedup(table(spark, d, "documents")) \
        .select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@register("op5_html_extraction")
def op5_html_extraction(spark, d):
    """Main text of every page by its host's consensus paths."""
    from .html_text import extract_pages
    return extract_pages(table(spark, d, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@register("op9_quality_classifier")
def op9_quality_classifier(spark, d):
    """Quality score and decision for every document."""
    from .quality import classify, train
    documents = table(spark, d, "documents")
    return classify(documents, train(documents, table(spark, d, "labels")))


@register("op4_sentencepiece")
def op4_sentencepiece(spark, d):
    """Encode and decode every document: counts, digests and the round trip."""
    from .pieces import encode_decode
    coded = encode_decode(table(spark, d, "documents").select("doc_id", "text"))
    return coded.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"),
                        F.xxhash64("ids").alias("ids_hash"), F.sha2("decoded", 256).alias("decoded_sha256"),
                        F.col("decoded").eqNullSafe(F.translate("text", "▁", " ")).alias("exact"))


@register("op1_benchmark_decontamination")
def op1_benchmark_decontamination(spark, d):
    """Every (document, benchmark item) whose question and answer a passage holds."""
    from .decontam import contaminated
    return contaminated(table(spark, d, "documents"), table(spark, d, "benchmark"))


@register("op8_token_output")
def op8_token_output(spark, d):
    """Write every document's ids, read the files back: place, length, digest."""
    from . import tokenfile as t
    folder = t.output_folder(spark)
    t.write(table(spark, d, "documents"), folder)
    docs = t.read(spark, folder).withColumn("ids", F.crc32("ids"))
    return t.positions(docs, folder).select("doc_id", "start", "n_tokens", F.col("ids").alias("ids_crc32"))


@register("op7_secret_scan")
def op7_secret_scan(spark, d):
    """Base findings by kind, their digest, and all spans of every document."""
    from .secrets import scan, spans_text
    found = scan(table(spark, d, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex", "cnn")],
                        F.sha2(spans_text(F.col("spans"), True), 256).alias("base_sha256"), spans_text(F.col("spans")).alias("spans"))


@register("op10_embedding_near_dedup")
def op10_embedding_near_dedup(spark, d):
    """Cosine 0.98 within a label: links, component and representative per vector."""
    from .neardup import near_dedup
    return near_dedup(table(spark, d, "embeddings"))


def crc32_sql(codes: str) -> str:
    """CRC-32 of a list of byte values: each byte is followed by eight shifts (-1)."""
    steps = f"flatten(list_transform({codes}, lambda b: [b::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    return f"""xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {steps}),
        lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384 * (a & 1)) END))"""


TRIE_SQL = f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS base,
             {crc32_sql("list_transform(string_split(conv_id::VARCHAR, ''), lambda s: unicode(s))")} % 9 AS h
      FROM (SELECT DISTINCT conv_id FROM t)),
a AS (SELECT c.conv_id, 0 AS own, t.pos, r, x FROM c JOIN t ON t.conv_id = c.base AND t.pos < c.h
      UNION ALL SELECT c.conv_id, 1, t.pos, r, x FROM c JOIN t USING (conv_id) WHERE t.pos >= c.h),
s AS (SELECT conv_id, x, row_number() OVER w AS depth,
             md5(string_agg(sha256(length(r) || ':' || r || x), '') OVER w) AS pid
      FROM a WINDOW w AS (PARTITION BY conv_id ORDER BY own, pos)),
p AS (SELECT conv_id, x, depth, depth || pid AS pid FROM s UNION ALL SELECT conv_id, '', 0, '0' FROM c),
l AS (SELECT conv_id, max(depth) AS len FROM p GROUP BY conv_id),
n AS (SELECT pid, min(conv_id) AS conv_id, min(depth) AS depth, count(*) AS n_convs, min(strlen(x)) AS size,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = len), '')) AS ends_sha256
      FROM p JOIN l USING (conv_id) GROUP BY pid),
u AS (SELECT n.*, q.pid AS up FROM n LEFT JOIN p q ON q.conv_id = n.conv_id AND q.depth = n.depth - 1),
k AS (SELECT up AS pid, count(*) AS n_children FROM u WHERE up IS NOT NULL GROUP BY up),
f AS (SELECT u.*, coalesce(n_children, 0) AS n_children FROM u LEFT JOIN k USING (pid)),
g AS (SELECT q.pid, sum((n_children = 0)::INT) AS n_leaves, sum((n_convs - 1) * size) AS saved_tokens
      FROM f JOIN p q ON q.conv_id = f.conv_id AND q.depth <= f.depth GROUP BY q.pid)
SELECT f.conv_id, f.depth, m.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves::BIGINT AS n_leaves,
       saved_tokens::BIGINT AS saved_tokens, f.ends_sha256
FROM f JOIN g USING (pid) LEFT JOIN n m ON m.pid = f.up
"""


@register("op12_conversation_trie", TRIE_SQL)
def op12_conversation_trie(spark, d):
    """Nodes of the rebuilt conversations' prefix trie, with subtree totals."""
    from .convtrie import trie
    return trie(table(spark, d, "conversations"))


_CODES = "flatten(list_transform(string_split({}, ''), lambda s: CASE WHEN unicode(s) < 128 THEN [unicode(s)] ELSE [195, unicode(s) - 64] END))"
SPELLING_SQL = f"""
WITH RECURSIVE r AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
                                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
h AS (SELECT w, {crc32_sql(_CODES.format("coalesce(doc_id::VARCHAR, '') || ':' || w"))} AS h FROM r WHERE length(w) >= 6),
c AS (SELECT CASE WHEN h % 199 = 0 THEN left(w, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2) ELSE w END AS word FROM h),
words AS (SELECT word, count(*) AS n FROM c WHERE length(word) >= 6 GROUP BY word HAVING count(*) >= 5),
d AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest
      FROM (SELECT word, n, unnest(generate_series(1, length(word)))::INT AS i FROM words)),
near AS (SELECT a.word, b.word AS other, b.n AS m FROM d a JOIN d b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
         UNION SELECT d.word, w.word, w.n FROM d JOIN words w ON w.word = d.rest
         UNION SELECT w.word, d.word, d.n FROM d JOIN words w ON w.word = d.rest),
best AS (SELECT word, count(*) AS n_near, max(m) AS m FROM near GROUP BY word),
f AS (SELECT words.word, n, n_near, CASE WHEN m >= 5 * n THEN m END AS form_n,
             CASE WHEN m >= 5 * n THEN (SELECT min(other) FROM near x WHERE x.word = words.word AND x.m = best.m) END AS form
      FROM words LEFT JOIN best USING (word)),
up AS (SELECT word, word AS root FROM f UNION ALL SELECT up.word, f.form FROM up JOIN f ON f.word = up.root WHERE f.form IS NOT NULL),
last AS (SELECT up.word, up.root FROM up JOIN f ON f.word = up.root WHERE f.form IS NULL)
SELECT f.word, f.form, last.root, f.n, coalesce(f.n_near, 0) AS n_near, f.form_n FROM f JOIN last USING (word)
"""


@register("op13_spelling_variants", SPELLING_SQL)
def op13_spelling_variants(spark, d):
    """Counted words with their near words, form and root."""
    from .spelling import spelling_groups
    return spelling_groups(table(spark, d, "documents"))


@register("op11_token_counts")
def op11_token_counts(spark, d):
    """Bytes and tokens of every document, and whether it exceeds 4096 tokens."""
    from .tokencount import count_tokens
    return count_tokens(table(spark, d, "documents"))
