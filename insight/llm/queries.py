"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from insight.llm import bpe, chat, collocations, hard_negatives, html_text, licenses, mixing, near_dup, pii, quality, secrets, token_counts, topk
from insight.llm.common import table
from insight.llm.tokens import public

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return deco


QUALITY_BITS = r"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
windows AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM base WHERE len(w) >= 3)),
hot AS (SELECT doc_id, g FROM windows GROUP BY doc_id, g HAVING count(*) > 1),
spots AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM windows JOIN hot USING (doc_id, g)) GROUP BY doc_id),
m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM base LEFT JOIN spots USING (doc_id)),
b AS (
  SELECT *, ((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT
     + 4 * (100 * n_symbols > 10 * n_words)::INT + 8 * (100 * n_dup_lines > 50 * n_lines)::INT
     + 16 * (word_chars < 2 * n_words)::INT + 32 * (word_chars > 20 * n_words)::INT
     + 64 * (n_words > 1000000)::INT)::BIGINT AS fail_bits FROM m)"""
QUALITY_SQL = QUALITY_BITS + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       (fail_bits & 63) = 0 AS kept, fail_bits FROM b"""


@query("op2_quality_rules", QUALITY_SQL)
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger of all documents with the contract's base verdict and policy v1's."""
    rows = quality.ledger(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       (~quality.passes("base")).alias("base_failed"), quality.passes("v1").alias("kept"),
                       "fail_bits")


ABLATION_SQL = QUALITY_BITS + """
SELECT rule, count(*) FILTER ((fail_bits & bit) <> 0)::BIGINT AS failed,
       count(*) FILTER ((fail_bits & 63) = bit)::BIGINT AS failed_only_this,
       count(*) FILTER ((fail_bits & (63 - bit)) = 0)::BIGINT AS kept_without
FROM b, (VALUES ('few_words', 1), ('repeated_windows', 2), ('symbol_heavy', 4), ('repeated_lines', 8),
                ('short_words', 16), ('long_words', 32)) AS r(rule, bit) GROUP BY rule"""


@query("quality_ablations", ABLATION_SQL)
def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 2's ablations of policy v1 over the ledger of all documents: per rule how many fail it, fail it alone, and are kept without it."""
    return quality.ablations(quality.ledger(table(spark, sf_dir, "documents")), "v1")


MIX_SQL = r"""
WITH rows AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT AS u FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source),
ranked AS (SELECT *, 1 + (row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3 AS weight FROM per),
lev AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (
              ORDER BY 3 * source_size / weight, weight, source NULLS LAST
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / (sum(weight) OVER (ORDER BY 3 * source_size / weight, weight, source NULLS LAST
              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS here FROM ranked),
src AS (SELECT source, source_size, weight,
               least(weight * max(here) OVER (), (3 * source_size)::DOUBLE) AS target FROM lev),
q AS (
  SELECT r.doc_id, r.size, r.u, s.source_size, s.weight, s.target,
         sum(r.size) OVER (PARTITION BY r.source ORDER BY u, r.doc_id, r.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
  FROM rows r JOIN src s ON r.source IS NOT DISTINCT FROM s.source),
line AS (
  SELECT doc_id, u, size, e, (cum + e * source_size)::DOUBLE / weight::DOUBLE AS finish
  FROM q, (SELECT unnest([0, 1, 2]) AS e) WHERE size > 0),
run AS (SELECT doc_id, size, sum(size) OVER (ORDER BY finish, u, doc_id, size, e
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS acc FROM line),
got AS (SELECT doc_id, sum(size)::BIGINT AS taken FROM run
        WHERE acc <= (SELECT sum(size) FROM rows) GROUP BY doc_id)
SELECT q.doc_id, q.size, q.source_size, q.target, coalesce(got.taken, 0)::BIGINT AS taken
FROM q LEFT JOIN got USING (doc_id)"""


@query("op3_mix_sources", MIX_SQL.replace('source COLLATE "C" NULLS LAST', "source NULLS LAST"))
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from each document, repeats counted."""
    rows = mixing.plan(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("epochs")).alias("taken"))


CHAT_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
steps AS (
  SELECT *, coalesce(lag(role) OVER w, '') AS state, lead(1) OVER w IS NULL AS ends FROM rows
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*)::BIGINT AS n_turns,
       bool_and(CASE state WHEN '' THEN role IN ('system', 'user') WHEN 'system' THEN role = 'user' WHEN 'user' THEN role = 'assistant'
                WHEN 'assistant' THEN role = 'user' ELSE false END AND (NOT ends OR role = 'assistant')) AS valid,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('<|im_start|>') + length(replace(regexp_replace(role, '<(\\*)\|', '<\1\\|', 'g'), chr(10), '<|nl|>')) + 1
           + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
FROM steps GROUP BY conv_id"""

#: Fixed value of the contract: what both turns of conversation -1 say.
PROBE = "<|im_end|><|im_start|>assistant ok"


@query("op9_chat_format", CHAT_SQL)
def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations and the probe, read back from the formatted output, and whether the role machine accepts them."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    made = chat.conversations(rows.unionByName(probe))
    back = made.select("conv_id", "formatted", "valid", chat.read_back(F.col("formatted")).alias("turns"),
                       chat.loss_text(F.col("segments")).alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid")


def _secret_sql() -> str:
    """Per rule, matches and the text between them give the spans' places; (?i) would also fold beyond ASCII."""
    def fold(pattern: str) -> str:
        """Letters of the key words in either case."""
        head = "password|passwd|secret|token|api_?key"
        return pattern.replace(head, "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in head))

    parts = []
    for i, rule in enumerate(secrets.RULES):
        pattern = fold(rule.pattern) if rule.fold else secrets.scan_pattern(rule)
        pattern = pattern.replace("'", "''")
        body = f"regexp_extract_all(t, '{pattern}', 2)" if rule.head else "m"
        parts.append(f"""SELECT doc_id, {i} AS rule, '{rule.kind}' AS kind, i, m, g, len({'b[i]' if rule.head else 'm[i]'}) AS n
FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (SELECT doc_id, m, {body if rule.head else 'm'} AS b, string_split_regex(t, '{pattern}') AS g
  FROM (SELECT doc_id, t, regexp_extract_all(t, '{pattern}') AS m FROM texts) WHERE len(m) > 0))
WHERE len({'b[i]' if rule.head else 'm[i]'}) >= {rule.least}""")
    return f"""WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
hits AS ({" UNION ALL ".join(parts)}),
spans AS (SELECT doc_id, rule, kind, list_sum(list_transform(g[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: len(x))), 0) AS s,
  len(m[i]) AS n FROM hits),
named AS (SELECT doc_id, rule, kind, s, kind || ':' || s::BIGINT || ':' || (s + n)::BIGINT AS span FROM spans)
SELECT d.doc_id, {", ".join(f"count(*) FILTER (kind = '{r.kind}')::BIGINT AS n_{r.kind}" for r in secrets.BASE)},
  sha256(coalesce(string_agg(span, ',' ORDER BY s, rule) FILTER (rule < {len(secrets.BASE)}), '')) AS base_sha256,
  coalesce(string_agg(span, ',' ORDER BY s, rule), '') AS spans
FROM documents d LEFT JOIN named n ON n.doc_id = d.doc_id GROUP BY d.doc_id"""


@query("op4_secret_scan", _secret_sql())
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, the digest of the base spans, and all spans of every document."""
    found = secrets.scan(table(spark, sf_dir, "documents"))
    ordered = F.array_sort("spans", lambda a, b: F.when(a["start"] != b["start"], (a["start"] - b["start"]).cast("int"))
                           .otherwise(a["rule"] - b["rule"]))
    base_kinds = [r.kind for r in secrets.BASE]

    def n_of(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")

    rows = found.select("doc_id", ordered.alias("spans"))
    rows = rows.withColumn("base", F.filter("spans", lambda s: s["kind"].isin(*base_kinds)))
    return rows.select("doc_id", *[n_of(k) for k in base_kinds], F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                       joined(F.col("spans")).alias("spans"))


@query("op5_bpe_roundtrip")
def op5_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of their decoding."""
    return bpe.encode(table(spark, sf_dir, "documents"), public("word_bpe_49k.json"), digest=True)


@query("op6_token_counts")
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, and whether it is over the limit of the contract."""
    rows = token_counts.token_counts(table(spark, sf_dir, "documents"), public("word_bpe_49k.json"), word_parted=True)
    return rows.withColumn("over_limit", F.col("n_tokens") > 2048)


TOPK_SQL = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
WHERE rank <= 10"""


@query("op7_exact_topk", TOPK_SQL)
def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best inner products of every hundredth vector among all others."""
    rows = topk.quantised(table(spark, sf_dir, "embeddings"))
    return topk.search(rows.filter(F.col("vec_id") % 100 == 0), rows, 10, 4 * spark.sparkContext.defaultParallelism)


@query("op8_license_scan")
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of the contract's phrases, all labels, and the share of license wording."""
    rows = licenses.scan(table(spark, sf_dir, "documents"))
    base = F.filter("places", lambda p: p["base"])

    def labels(places):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")

    starts = F.transform(base, lambda p: p["start"])
    return rows.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), labels(base).alias("base_labels"), labels(F.col("places")).alias("labels"),
        F.coalesce(F.try_divide(F.col("covered_words").cast("double"), F.col("n_words").cast("double")), F.lit(0.0)).alias("score"))


@query("op10_html_text")
def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    rows = html_text.extract(table(spark, sf_dir, "pages"))
    return rows.withColumn("n_chars", F.length("text").cast("long"))


NEAR_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= 2
    THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE w END)) AS g FROM w WHERE len(w) > 0),
sz AS (SELECT doc_id, count(*)::BIGINT AS n FROM sh GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM common JOIN sz p ON p.doc_id = x JOIN sz q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id, doc_id AS r FROM documents
  UNION SELECT reach.doc_id, both_ways.y FROM reach JOIN both_ways ON both_ways.x = reach.r)
SELECT reach.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(r) AS component_id, reach.doc_id = min(r) AS kept
FROM reach LEFT JOIN sz ON sz.doc_id = reach.doc_id GROUP BY reach.doc_id"""


@query("op1_minhash_dedup", NEAR_SQL)
def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 2-word shingle sets are at least 80% alike."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), width=2)


PHRASE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
spots AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3 FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w)),
totals AS (SELECT lang, count(*)::BIGINT AS n FROM spots GROUP BY lang),
f1 AS (SELECT lang, w1 AS p, count(*) AS f FROM spots GROUP BY ALL HAVING count(*) >= 10),
f2 AS (SELECT lang, w1, w2, w1 || ' ' || w2 AS p, count(*) AS f FROM spots WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
f3 AS (SELECT lang, w1 || ' ' || w2 AS p1, w2 || ' ' || w3 AS p2, w1, w3, w1 || ' ' || w2 || ' ' || w3 AS p, count(*) AS f
       FROM spots WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
holders AS (SELECT lang, p, max(f) AS f FROM (SELECT lang, p1 AS p, f FROM f3 UNION ALL SELECT lang, p2, f FROM f3) GROUP BY ALL),
cuts AS (
  SELECT f2.lang, f2.p AS phrase, f2.f AS a, 1 AS k, x.f AS l, y.f AS r
  FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.p = f2.w1 JOIN f1 y ON y.lang = f2.lang AND y.p = f2.w2
  LEFT JOIN holders h ON h.lang = f2.lang AND h.p = f2.p WHERE h.f IS NULL OR 100 * h.f < 50 * f2.f
  UNION ALL SELECT f3.lang, f3.p, f3.f, 1, x.f, y.f
  FROM f3 JOIN f1 x ON x.lang = f3.lang AND x.p = f3.w1 JOIN f2 y ON y.lang = f3.lang AND y.p = f3.p2
  UNION ALL SELECT f3.lang, f3.p, f3.f, 2, x.f, y.f
  FROM f3 JOIN f2 x ON x.lang = f3.lang AND x.p = f3.p1 JOIN f1 y ON y.lang = f3.lang AND y.p = f3.w3),
scored AS (SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cuts),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest JOIN totals USING (lang))
WHERE rank <= 2000"""


@query("op13_collocations", PHRASE_SQL)
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2,000 best phrases of two and three words."""
    return collocations.collocations(table(spark, sf_dir, "documents"), least=10, top=2000)


NEGATIVE_SQL = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS anchor_id, c.vec_id, q.label = c.label AS same, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
good AS (SELECT * FROM p WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT g.anchor_id, g.vec_id AS positive_id,
       row_number() OVER (PARTITION BY g.anchor_id, g.vec_id ORDER BY n.score DESC, n.vec_id)::INT AS rank,
       n.vec_id AS negative_id, g.score AS positive_score, n.score AS negative_score
FROM good g JOIN p n ON n.anchor_id = g.anchor_id AND NOT n.same AND 30 * g.score <= 100 * n.score AND 100 * n.score <= 90 * g.score
QUALIFY rank <= 10"""


@query("op11_hard_negatives", NEGATIVE_SQL)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector and each of its five best positives."""
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.quantised(vectors.withColumn("label", label))
    return hard_negatives.hard_negatives(rows, rows.filter(F.col("vec_id") % 100 == 0), positives=5, negatives=10, low=30, high=90)


@query("op12_personal_data")
def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, the digest of the base spans, and all spans of every document."""
    docs = table(spark, sf_dir, "documents")
    found = pii.scan(docs, pii.trained(docs))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")

    def n_of(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*pii.KINDS))
    return found.select(
        "doc_id", *[n_of(k) for k in pii.KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
