"""Registered queries of the operators, over whole tables, and their checking SQL."""

import public_tokenizers
from pyspark.sql import functions as F

from stewardry.llm import collision_search, mixing, near_docs, near_vectors, pieces, prefix_trie, secret_scan, spelling, substrings, token_store, toxicity, url_filter, warc

QUERIES, ORACLES = {}, {}

# The most often a mix may repeat a source, with as many tokens drawn as the corpus has.
MAX_REPEATS, BUDGET = 4.0, 1.0
# Host, path and verdict of each rule.
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
TOXIC_SCORE = 0.3


def query(name, sql=None):
    def register(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return register


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _uniform(*parts):
    text = " || ':' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


@query(
    "op1_mix_sources",
    rf"""
WITH RECURSIVE counted AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN '0' ELSE '1' || source END AS s,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS n FROM documents),
grouped AS (SELECT s, sum(n)::BIGINT AS tokens FROM counted GROUP BY s),
total AS (SELECT sum(tokens)::DOUBLE AS t FROM grouped),
shares AS (SELECT s, tokens, tokens / t AS share FROM grouped, total),
bisect(i, low, high) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT i + 1, CASE WHEN ok THEN low ELSE mid END, CASE WHEN ok THEN mid ELSE high END FROM (
    SELECT i, low, high, (low + high) / 2 AS mid,
      (SELECT {BUDGET} * power(min(share), mid - 1) / sum(power(share, mid)) FROM shares WHERE share > 0) <= {MAX_REPEATS} AS ok,
    FROM (SELECT i, low, high, (low + high) / 2 AS mid FROM bisect WHERE i < 24))),
fitted AS (SELECT CASE WHEN (SELECT {BUDGET} * power(min(share), -1.0) / sum(power(share, 0.0)) FROM shares WHERE share > 0) <= {MAX_REPEATS}
    THEN 0.0 ELSE (SELECT high FROM bisect WHERE i = 24) END AS a),
weights AS (SELECT s, tokens, round(power(share, a) / (SELECT sum(power(share, a)) FROM shares, fitted WHERE share > 0), 9) AS weight
  FROM shares, fitted WHERE share > 0),
quotas AS (SELECT s, tokens, floor(t * weight)::BIGINT AS quota FROM weights, total),
sources AS (SELECT s, quota // tokens AS epochs, quota - (quota // tokens) * tokens AS rest,
    greatest(1, least({mixing.MAX_BLOCKS}, ceil(tokens / {mixing.BLOCK_TOKENS})))::INTEGER AS blocks FROM quotas WHERE quota > 0),
placed AS (SELECT c.*, x.epochs, x.rest, x.blocks, ({_uniform("'mix'", "doc_id")} % blocks)::INTEGER AS block FROM counted c JOIN sources x USING (s)),
drawn AS (SELECT *, {_uniform("'mix'", "epoch", "s", "block")} AS block_key, {_uniform("'mix'", "epoch", "doc_id")} AS doc_key
  FROM (SELECT *, unnest(generate_series(0, epochs)) AS epoch FROM placed)),
ordered AS (SELECT *, sum(n) OVER (PARTITION BY s, epoch ORDER BY block_key, doc_key RANGE UNBOUNDED PRECEDING) AS sofar FROM drawn)
SELECT doc_id, source, CAST(n AS BIGINT) AS n_tokens, CAST(epoch AS INTEGER) AS epoch, block, block_key, doc_key FROM ordered
WHERE epoch < epochs OR (rest > 0 AND sofar <= rest)
""".replace("AS ok,\n", "AS ok\n"),
)
def mix_sources(spark, folder):
    docs = table(spark, folder, "documents")
    drawn = mixing.mix(docs, budget=BUDGET, max_repeats=MAX_REPEATS)
    return drawn.select("doc_id", "source", mixing.tokens_of("text").alias("n_tokens"), "epoch", "block", "block_key", "doc_key")


_RULE_VALUES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)


@query(
    "op2_filter_urls",
    f"""
WITH rules AS (SELECT * FROM (VALUES {_RULE_VALUES}) AS r(rule_host, rule_path, rule_verdict)),
rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (SELECT page_id,
    translate(regexp_extract(r, '^[^/?#]*'), '{url_filter.UPPER}', '{url_filter.LOWER}') AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
fits AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host) DESC NULLS LAST, length(rule_path) DESC) AS n
  FROM parts LEFT JOIN rules ON ('.' || host) LIKE ('%.' || rule_host) AND starts_with(path, rule_path))
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule_host || rule_path AS rule,
  coalesce(rule_verdict, 'allow') AS verdict FROM fits WHERE n = 1
""",
)
def filter_urls(spark, folder):
    judged = url_filter.filter_urls(table(spark, folder, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op3_near_vectors")
def link_vectors(spark, folder):
    return near_vectors.near_vectors(table(spark, folder, "embeddings"))


@query(
    "op4_warc",
    f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS n, sha1(payload) AS digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY digest, n) AS last FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= {warc.REVISIT_BYTES} AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= {warc.REVISIT_BYTES} AND page_id < last THEN last END AS refers_to FROM m
""",
)
def archive(spark, folder):
    captures = warc.archive_pages(table(spark, folder, "pages"))
    # one row per record written
    captures = captures.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return captures.select(
        F.col("metadata.page_id").alias("page_id"),
        # of the payload that the capture holds; a revisit has that of the record it names
        F.coalesce(F.octet_length("response.payload").cast("long"), "refers_bytes").alias("payload_bytes"),
        F.coalesce(F.sha1("response.payload"), "response.payload_digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        F.when(F.col("response.type") == "revisit", F.col("refers_to")).alias("refers_to"),
    )


@query("op5_token_store")
def tokens(spark, folder):
    docs = table(spark, folder, "documents")
    return token_store.store_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))[2]


@query("op6_near_documents")
def link_documents(spark, folder):
    return near_docs.near_documents(table(spark, folder, "documents"))


@query("op7_nearest_vectors")
def search(spark, folder):
    vectors = table(spark, folder, "embeddings")
    return collision_search.nearest_vectors(vectors.where("vec_id % 100 = 0"), vectors, k=10)


_WINDOWS = substrings.WINDOW


@query(
    "op8_cut_repeats",
    rf"""
WITH words AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
grams AS (SELECT doc_id, i, sha256(array_to_string(w[i:i + {_WINDOWS - 1}], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - {_WINDOWS - 1})) AS i FROM words WHERE len(w) >= {_WINDOWS})),
firsts AS (SELECT g, min(doc_id) AS first FROM grams GROUP BY g),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + {_WINDOWS - 1})) AS k FROM grams JOIN firsts USING (g) WHERE doc_id > first),
marks AS (SELECT doc_id, list(k) AS ks, count(*) AS n FROM gone GROUP BY doc_id),
kept AS (SELECT w.doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed,
    CASE WHEN n IS NULL THEN w ELSE list_transform(list_filter(generate_series(1, len(w)), lambda x: NOT list_contains(ks, x)), lambda x: w[x]) END AS kw
  FROM words w LEFT JOIN marks USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed, sha256(coalesce(array_to_string(kw, ' '), '')) AS kept_sha256 FROM kept
""",
)
def cut_repeats(spark, folder):
    cut = substrings.cut_repeats(table(spark, folder, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op9_toxicity")
def score(spark, folder):
    docs = table(spark, folder, "documents")
    model = toxicity.fit_toxicity(docs, table(spark, folder, "labels"))
    scored = toxicity.score_toxicity(docs.select("doc_id", "lang", "text"), model)
    return scored.select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_SCORE).cast("int").alias("predicted"),
        toxicity.toxic_by_language(F.col("score"), F.col("lang"), model).alias("toxic_by_language"),
    )


@query("op10_pieces")
def encode(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    coded = pieces.encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", "n_pieces", "n_bytes", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


def _crc32_sql(text):
    """Unsigned CRC-32 of a string in SQL: its UTF-8 bytes, each with eight shifts."""
    size = f"octet_length(encode({text}))"
    byte = f"list_transform(generate_series(1, {size}), lambda i: CAST('0x' || substr(hex(encode({text})), 2 * i - 1, 2) AS BIGINT))"
    step = "xor(c, b)"
    for k in range(8):
        step = f"list_transform([{step}], lambda v{k}: xor(v{k} >> 1, (v{k} & 1) * 3988292384))[1]"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {byte}), lambda c, b: {step}), 4294967295)"


# The first 0 to 8 turns of a conversation come from the first of its five.
HEAD_TURNS = 9


@query(
    "op11_prefix_trie",
    f"""
WITH turns AS (SELECT conv_id, coalesce(text, '') AS text, coalesce(role, '') AS role, turn,
    md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
original AS (SELECT conv_id, list(k ORDER BY turn NULLS FIRST, k) AS ks,
    list(octet_length(encode(text))::BIGINT ORDER BY turn NULLS FIRST, k) AS bs FROM turns GROUP BY conv_id),
cut AS (SELECT *, conv_id - conv_id % 5 AS donor, {_crc32_sql("CAST(conv_id AS VARCHAR)")} % {HEAD_TURNS} AS h FROM original),
rebuilt AS (SELECT c.conv_id, list_concat(coalesce(d.ks[1:h], []), c.ks[h + 1:]) AS ks, list_concat(coalesce(d.bs[1:h], []), c.bs[h + 1:]) AS bs
  FROM cut c LEFT JOIN original d ON d.conv_id = c.donor),
prefixes AS (SELECT conv_id, d, len(ks) AS n, array_to_string(ks[1:d], ' ') AS node, array_to_string(ks[1:d - 1], ' ') AS parent,
    CASE WHEN d = 0 THEN 0 ELSE bs[d] END AS bytes FROM (SELECT *, unnest(generate_series(0, len(ks))) AS d FROM rebuilt)),
nodes AS (SELECT node, d, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256 FROM prefixes GROUP BY node, d),
kids AS (SELECT parent, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY parent),
marked AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k ON k.parent = n.node),
sums AS (SELECT p.node, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * m.bytes) AS saved_tokens
  FROM marked m JOIN prefixes p ON p.conv_id = m.conv_id AND p.d <= m.d GROUP BY p.node)
SELECT m.conv_id, CAST(m.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, CAST(m.n_convs AS BIGINT) AS n_convs,
  CAST(m.n_children AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, m.ends_sha256
FROM marked m JOIN sums s USING (node) LEFT JOIN nodes u ON m.d > 0 AND u.node = m.parent
""",
)
def trie(spark, folder):
    conv = F.col("conv_id")
    turns, lengths = prefix_trie.graft_heads(
        table(spark, folder, "conversations"),
        donor=conv - conv % 5,
        n_head=F.crc32(conv.cast("string").cast("binary")) % HEAD_TURNS,
        most=HEAD_TURNS - 1,
    )
    nodes = prefix_trie.prefix_trie(turns, lengths)
    return nodes.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


def _joined(spans):
    places = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(places, ",")


def _count_kind(kind):
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


@query("op12_secrets")
def secrets(spark, folder):
    docs = table(spark, folder, "documents")
    found = secret_scan.scan_secrets(docs, secret_scan.ranked_words(docs))
    base = F.filter("spans", lambda s: s["kind"] != "guess")
    return found.select(
        "doc_id",
        *[_count_kind(k).alias(f"n_{k}") for k in secret_scan.KINDS[:3]],
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


@query(
    "op13_spellings",
    rf"""
WITH runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')), '{url_filter.UPPER}', '{url_filter.LOWER}') AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS keyed FROM runs GROUP BY doc_id, run),
hashed AS (SELECT run, n, {_crc32_sql("keyed")} AS h FROM counted),
spelt AS (SELECT CASE WHEN h % {spelling.SHORTENED} = 0
    THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelt WHERE length(word) >= {spelling.MIN_LETTERS} GROUP BY word HAVING sum(n) >= {spelling.MIN_COUNT}),
holes AS (SELECT word, n, unnest(list_transform(generate_series(1, length(word)), lambda i: substr(word, 1, i - 1) || '*' || substr(word, i + 1))) AS hole FROM words),
shorter AS (SELECT DISTINCT word, n, replace(hole, '*', '') AS cut FROM holes),
near AS (SELECT a.word, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.hole = b.hole AND a.word <> b.word
  UNION ALL SELECT s.word, w.word, w.n FROM shorter s JOIN words w ON s.cut = w.word
  UNION ALL SELECT w.word, s.word, s.n FROM shorter s JOIN words w ON s.cut = w.word),
best AS (SELECT word, count(*) AS n_near, min((-other_n, other)) AS b FROM near GROUP BY word),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b[1] >= {spelling.RATIO} * w.n THEN b[2] END AS form,
    CASE WHEN -b[1] >= {spelling.RATIO} * w.n THEN -b[1] END AS form_n FROM words w LEFT JOIN best USING (word)),
roots AS (WITH RECURSIVE walk(word, here, form) AS (
  SELECT word, word, form FROM forms UNION ALL
  SELECT k.word, f.word, f.form FROM walk k JOIN forms f ON f.word = k.form) SELECT word, here AS root FROM walk WHERE form IS NULL)
SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n FROM forms JOIN roots USING (word)
""",
)
def spellings(spark, folder):
    return spelling.group_spellings(spelling.vocabulary(table(spark, folder, "documents")))
