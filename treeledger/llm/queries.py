"""The queries of this subpackage, and SQL for those that SQL can express."""

from pyspark.sql import functions as F

from treeledger.llm import (
    alignment, attribution, descent, hyperdim, ledger, mixing, packing, pulearn, resampling, simhash, suffixes,
    urlfilter, voronoi,
)
from treeledger.llm.text import crc_fold

URL_RULES = [
    urlfilter.Rule("allow", "org", "/"),
    urlfilter.Rule("block", "example.org", "/es/"),
    urlfilter.Rule("block", "example.org", "/en/1"),
    urlfilter.Rule("allow", "com", "/fr/"),
    urlfilter.Rule("block", "com", "/de/"),
]


def _table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_voronoi_knn(spark, folder):
    """The 10 best vectors for every vector whose id is divisible by 100, of all vectors."""
    return voronoi.top_k(_table(spark, folder, "embeddings"), F.col("id") % 100 == 0, k=10)


def op2_packing(spark, folder):
    """All documents, packed into sequences of at most 4096 tokens."""
    packed = packing.pack(_table(spark, folder, "documents"))
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
        "sequence_length", "step_group",
    )


def op3_language_id(spark, folder):
    """The language of every document; those with remainder 2 are not learnt from."""
    docs = _table(spark, folder, "documents")
    names, prototypes = hyperdim.train(docs)
    held_out = F.coalesce(crc_fold("doc_id", hyperdim.FOLDS) == hyperdim.HELD_OUT, F.lit(False))
    return hyperdim.identify(docs, names, prototypes).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


def op4_suffix_dedup(spark, folder):
    """Spans of 50 words and more that two documents or more share, in all documents."""
    spans = suffixes.repeated_spans(_table(spark, folder, "documents"), least=50)
    return spans.select(F.col("doc").alias("doc_id"), "start_word", "n_words", "kept", F.col("first_doc").alias("first_doc_id"))


def op5_mixing(spark, folder):
    """All documents: how many words of each the mix takes."""
    return mixing.mix_counts(_table(spark, folder, "documents"))


def op6_token_counts(spark, folder):
    """Tokens of every line of all documents; a token that crosses lines goes to that with most of it."""
    return attribution.attribute(
        _table(spark, folder, "documents"), attribution.lines(F.col("text")), rule="most"
    )


def op6_block_tokens(spark, folder):
    """Tokens of every block of 200 characters of all documents. Tokens do cross from block to block; they
    are shared out by bytes."""
    return attribution.attribute(
        _table(spark, folder, "documents"), attribution.blocks(F.col("text"), 200), rule="share"
    )


def op7_quality_rules(spark, folder):
    """The ledger of all documents, and the verdict of the current policy."""
    rows = ledger.build_ledger(_table(spark, folder, "documents"))
    base_failed = ~ledger.passes(ledger.BASE)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"),
        (~base_failed & ledger.passes(ledger.CURRENT)).alias("kept"),
        "n_lines", "n_capitals", "failed",
    )


def op7_rule_ablation(spark, folder):
    """What each rule of each policy does to all documents, from the ledger's bits alone."""
    return ledger.ablate(ledger.build_ledger(_table(spark, folder, "documents")))


def op8_url_filter(spark, folder):
    """All pages. The given tables hold no block list; listed are the canonical URLs that more than
    one page has."""
    pages = _table(spark, folder, "pages").select("page_id", "url")
    return urlfilter.filter_urls(pages, urlfilter.shared_urls(pages), URL_RULES)


def op9_quality_classifier(spark, folder):
    """A score for every document; the labels of the held-out fold are not learnt from."""
    docs = _table(spark, folder, "documents")
    model = pulearn.train(docs, _table(spark, folder, "labels"))
    scored = docs.select("doc_id", crc_fold("doc_id", pulearn.FOLDS).alias("fold"), pulearn.score(model, F.col("text")).alias("score"))
    return scored.select(
        "doc_id", F.coalesce(F.col("fold") == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op10_simhash(spark, folder):
    """Fingerprint and group of every document: 3-word shingles, at most 3 differing bits."""
    rows = simhash.simhash_groups(_table(spark, folder, "documents"), shingle=3, max_bits=3)
    return rows.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op11_resampling(spark, folder):
    """All documents, and which tenth of those with 20 words and more is drawn towards the benchmark."""
    return resampling.resample(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"), percent=10)


def op12_alignment(spark, folder):
    """Groups and links of two tokenizers in all documents."""
    rows = alignment.align(_table(spark, folder, "documents"))
    # What stands for the groups is made from them before anything is stored.
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    rows = alignment.with_counts(rows.withColumn("groups_sha256", digest).drop("groups"))
    return rows.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256",
    )


def op13_descent(spark, folder):
    """The 5 nearest vectors by cosine for every vector whose id is divisible by 50, found in a graph of all."""
    return descent.nearest(_table(spark, folder, "embeddings"), F.col("id") % 50 == 0, k=5)


QUERIES = {
    "op1_voronoi_knn": op1_voronoi_knn,
    "op2_packing": op2_packing,
    "op3_language_id": op3_language_id,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_mixing": op5_mixing,
    "op6_token_counts": op6_token_counts,
    "op6_block_tokens": op6_block_tokens,
    "op7_quality_rules": op7_quality_rules,
    "op7_rule_ablation": op7_rule_ablation,
    "op8_url_filter": op8_url_filter,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_simhash": op10_simhash,
    "op11_resampling": op11_resampling,
    "op12_alignment": op12_alignment,
    "op13_descent": op13_descent,
}

OP4_SQL = r"""
WITH d AS (SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
p AS (SELECT r, doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50),
x AS (SELECT r, doc_id, i - 1 AS a, sha256(array_to_string(ws[i:i + 49], ' ')) AS g FROM p),
s AS (SELECT g, min(doc_id) AS first_doc FROM x GROUP BY g HAVING min(doc_id) <> max(doc_id)),
y AS (SELECT r, doc_id, a, first_doc, doc_id = first_doc AS kept FROM x JOIN s USING (g)),
z AS (SELECT *, CASE WHEN lag(a) OVER (PARTITION BY r, kept ORDER BY a) + 50 >= a THEN 0 ELSE 1 END AS n FROM y),
q AS (SELECT *, sum(n) OVER (PARTITION BY r, kept ORDER BY a ROWS UNBOUNDED PRECEDING) AS span FROM z)
SELECT doc_id, CAST(min(a) AS BIGINT) AS start_word, CAST(max(a) + 50 - min(a) AS BIGINT) AS n_words, kept,
       min(first_doc) AS first_doc_id
FROM q GROUP BY r, doc_id, kept, span
"""

OP7_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
p AS (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8),
x AS (SELECT r, i, array_to_string(ws[i:i + 7], ' ') AS g FROM p),
y AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM x) WHERE n > 1),
z AS (SELECT r, count(DISTINCT i + k) AS n FROM y, range(8) AS t(k) GROUP BY r),
l AS (SELECT r, count(*) AS n, count(DISTINCT line) AS m FROM
      (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(l.n - l.m, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(z.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(l.n, 0) AS BIGINT) AS n_lines,
         CAST(length(regexp_replace(text, '[^A-Z]', '', 'g')) AS BIGINT) AS n_capitals
  FROM d JOIN w USING (r) LEFT JOIN z USING (r) LEFT JOIN l USING (r)),
f AS (
  SELECT *, CAST(
    CASE WHEN n_words < 20 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 100 * n_symbols > 20 * n_words THEN 4 ELSE 0 END
    + CASE WHEN 100 * n_capitals > 50 * word_chars THEN 8 ELSE 0 END
    + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 16 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words OR word_chars > 20 * n_words THEN 32 ELSE 0 END
    AS BIGINT) AS failed FROM m)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, failed = 0 AS kept FROM f
"""

OP7_ABLATION_SQL = f"""
WITH book AS ({OP7_SQL}),
cases(policy, rule, bit, whole) AS (VALUES
  ('base', 'few_words', 1, 3), ('base', 'repeated_windows', 2, 3),
  ('2', 'few_words', 1, 63), ('2', 'repeated_windows', 2, 63), ('2', 'symbols', 4, 63), ('2', 'capitals', 8, 63),
  ('2', 'repeated_lines', 16, 63), ('2', 'word_length', 32, 63))
SELECT policy, rule, CAST(count(*) FILTER (WHERE failed & bit <> 0) AS BIGINT) AS failing,
       CAST(count(*) FILTER (WHERE failed & whole = bit) AS BIGINT) AS only_this,
       CAST(count(*) FILTER (WHERE failed & (whole - bit) = 0) AS BIGINT) AS kept_without,
       bit_or(failed) AS bits_seen
FROM book, cases GROUP BY policy, rule
"""

OP8_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS url,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
q AS (
  SELECT *, list_sort(list_filter(
      string_split(regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1), '&'),
      lambda x: x <> '' AND NOT starts_with(x, 'utm_') AND NOT starts_with(x, 'ref='))) AS kept,
    regexp_replace(host, '^www\.', '') || regexp_replace(path, '(\.html)?/*$', '') AS bare
  FROM p),
c AS (
  SELECT *, CASE WHEN NOT contains(url, '://') THEN NULL
                 WHEN len(kept) > 0 THEN bare || '?' || array_to_string(kept, '&') ELSE bare END AS canonical
  FROM q),
r(verdict, h, pre) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
s AS (SELECT canonical FROM c WHERE canonical IS NOT NULL GROUP BY canonical HAVING count(*) > 1),
b AS (
  SELECT c.page_id, arg_max(r.h || r.pre, length(r.h || r.pre)) AS rule,
         arg_max(r.verdict, length(r.h || r.pre)) AS verdict
  FROM c JOIN r ON (c.host = r.h OR ends_with(c.host, '.' || r.h)) AND starts_with(c.path, r.pre)
  GROUP BY c.page_id)
SELECT c.page_id, c.host, c.path, b.rule,
       coalesce(b.verdict, CASE WHEN s.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
       s.canonical IS NOT NULL AS listed
FROM c LEFT JOIN b USING (page_id) LEFT JOIN s ON s.canonical = c.canonical
"""

OP1_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id,
         CAST(list_sum(list_transform(range(1, 1 + least(len(q.v), len(d.v))), lambda i: q.v[i] * d.v[i])) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id % 100 = 0 AND q.vec_id <> d.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""

OP11_SQL = r"""
WITH tab AS (
  SELECT list(c ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(range(0, 8), lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i) AS c
    FROM range(256) AS r(i))),
d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
e AS (
  SELECT regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
dw AS (SELECT r, unnest(ws) AS w FROM d),
ew AS (SELECT unnest(ws) AS w FROM e),
hx AS (SELECT w, hex(w) AS x FROM (SELECT w FROM dw UNION SELECT w FROM ew)),
wb AS (
  SELECT w, xor(list_reduce(
      list_transform(range(0, CAST(length(x) // 2 AS BIGINT)), lambda i:
        CAST((strpos('0123456789ABCDEF', x[2 * i + 1]) - 1) * 16 + strpos('0123456789ABCDEF', x[2 * i + 2]) - 1 AS BIGINT)),
      lambda a, b: xor(a >> 8, tab[CAST(xor(a, b) & 255 AS BIGINT) + 1]), 4294967295), 4294967295) % 10000 AS b
  FROM hx, tab),
db AS (SELECT r, b FROM dw JOIN wb USING (w)),
s AS (SELECT b, count(*) AS s FROM db GROUP BY b),
t AS (SELECT b, count(*) AS t FROM ew JOIN wb USING (w) GROUP BY b),
n AS (SELECT (SELECT coalesce(sum(s), 0) FROM s) AS s_all, (SELECT coalesce(sum(t), 0) FROM t) AS t_all),
g AS (
  SELECT i AS b, CAST(floor(1000 * ln(
    CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST(s_all + 10000 AS DOUBLE)
    / (CAST(coalesce(s, 0) + 1 AS DOUBLE) * CAST(t_all + 10000 AS DOUBLE)))) AS BIGINT) AS gain
  FROM range(10000) AS k(i) LEFT JOIN s ON s.b = i LEFT JOIN t ON t.b = i, n),
m AS (SELECT r, CAST(count(*) AS BIGINT) AS nf, CAST(sum(gain) AS BIGINT) AS total FROM db JOIN g USING (b) GROUP BY r),
x AS (
  SELECT d.r, doc_id, coalesce(nf, 0) AS n_features,
         CASE WHEN nf IS NULL THEN 0 ELSE (total - ((total % nf) + nf) % nf) // nf END AS weight,
         CAST('0x' || substr(sha256('2024:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) AS h
  FROM d LEFT JOIN m USING (r)),
y AS (SELECT *, CAST(weight AS BIGINT) + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM x),
z AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id, r) AS p, count(*) OVER () AS n
  FROM y WHERE n_features >= 20 AND doc_id IS NOT NULL)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, score,
       CAST(CASE WHEN p <= 10 * n // 100 THEN p END AS BIGINT) AS rank
FROM y LEFT JOIN z USING (r)
"""

ORACLES = {
    "op1_voronoi_knn": OP1_SQL,
    "op4_suffix_dedup": OP4_SQL,
    "op7_quality_rules": OP7_SQL,
    "op7_rule_ablation": OP7_ABLATION_SQL,
    "op8_url_filter": OP8_SQL,
    "op11_resampling": OP11_SQL,
}
