"""The contract queries of the operators, each over its whole table, and their DuckDB SQL."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bagdiff.llm import (
    bpe,
    collocations,
    conversation_repair,
    decontaminate,
    exact_dedup,
    html_text,
    language_id,
    license_scan,
    quality,
    secret_scan,
    simhash,
    token_counts,
    url_filter,
)
from bagdiff.llm.common import materialize

#: Vocabulary file of the tokenizer queries.
VOCABULARY = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096
SHINGLE, DISTANCE = 4, 4


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fold(id: str, n: int) -> Column:
    """crc32 of an id as text, modulo n; a null id reads as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id).cast("string"), F.lit("")).cast("binary")), F.lit(n))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the URL of every page, by rules and by the pages' redirect and canonical links."""
    return url_filter.judge(_table(spark, sf_dir, "pages"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document."""
    found = license_scan.scan(_table(spark, sf_dir, "documents"))
    starts = F.transform("places", lambda p: p["start"])
    base = F.array_distinct(F.transform("places", lambda p: p["label"]))
    more = F.transform("matches", lambda m: m["label"])
    best = F.array_max(F.transform("matches", lambda m: m["share"]))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, more)), ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"),
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    held_out = _fold("doc_id", 3) == 1
    model = language_id.fit(docs.filter(~held_out))
    found = language_id.with_language(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "language.lang_pred", "language.score")


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = html_text.with_main_text(_table(spark, sf_dir, "pages"))
    return found.select(
        "page_id", "url", F.col("main_text").alias("text"), F.char_length("main_text").cast("bigint").alias("n_chars")
    )


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: patterns, and what a network trained on their findings adds."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.with_spans(docs, secret_scan.fit(docs))
    spans = F.col("spans")
    return found.select(
        "doc_id",
        *[secret_scan.count_of(spans, k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secret_scan.listed(spans, ("assign", "access", "hex")), 256).alias("base_sha256"),
        secret_scan.listed(spans).alias("spans"),
    )


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=SHINGLE, distance=DISTANCE)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in spans shared with benchmark items."""
    found = decontaminate.find_hits(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Place of a public vocabulary file: in the folder $BAGDIFF_TOKENIZERS, else in the installed package of them."""
    if folder := os.environ.get("BAGDIFF_TOKENIZERS"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenized(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Digests of the ids and of the decoded text of every row of ``docs`` (doc_id, text)."""
    path = path or vocabulary_path()
    found = bpe.round_trip(docs.select("doc_id", "text"), path)
    return found.select(
        "doc_id",
        bpe.n_tokens(F.col("ids")).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by a public byte-level vocabulary, and decoded again."""
    return tokenized(_table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of equal texts of every document and whether it stays."""
    found = exact_dedup.group_copies(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from labels that are not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels")
    held_out = _fold("doc_id", 5) == 0
    train = labels.filter(~held_out)
    ranking = quality.fit(docs, train)
    if ranking is None:
        found = quality.with_score(docs, None)
    else:
        raw = materialize(quality.with_raw(docs, ranking).select("doc_id", "raw"), "quality-scores")
        ranking = quality.calibrated(ranking, raw, train)
        found = raw.withColumn("score", quality.score_of(F.col("raw"), ranking))
    return found.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted")
    )


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best phrases of two to four words of each language."""
    return collocations.mine(_table(spark, sf_dir, "documents"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut, repeated or given to the user, by a hash of conversation and turn."""

    def text_of(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), kind.alias("kind"))
    rows = rows.where(F.col("kind") != 0).select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 3, 2).otherwise(1).alias("times"),
    )
    return rows.select("*", F.explode(F.sequence(F.lit(1), "times"))).select("conv_id", "turn", "role", "text")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired text of every damaged conversation."""
    conversations = _table(spark, sf_dir, "conversations")
    fixed = conversation_repair.repair(damaged(conversations))
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    texts = conversation_repair.digests(fixed.messages).withColumnRenamed("conv", "c1")
    report = fixed.report.withColumnRenamed("conv", "c2")
    out = conversations.select("conv_id").distinct()
    out = out.join(report, F.col("conv_id").eqNullSafe(F.col("c2")), "left").join(texts, F.col("conv_id").eqNullSafe(F.col("c1")), "left")
    return out.select(
        "conv_id",
        *[F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def token_counts_of(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Bytes and tokens of every row of ``docs`` (doc_id, text)."""
    counted = token_counts.count_tokens(docs, path or vocabulary_path(PIECES), ["doc_id"])
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of tokens of every document."""
    return token_counts_of(_table(spark, sf_dir, "documents"))


_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_DUCK_WORDS = "regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: Components are reached by walking the links; there is a row per page. It reads links in their plain forms:
#: absolute or below the page's folder or host, in tags outside comments and raw text, with ``&amp;`` alone.
OP4_SQL = r"""
WITH RECURSIVE rules(host, path, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), tags AS (
  SELECT url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) AS tag FROM pages
), refs AS (
  SELECT url, trim(replace(CASE
    WHEN regexp_matches(tag, '(?is)\brel\s*=\s*["'']?\s*canonical\b')
      THEN regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?\s*([^\s"''>]+)', 1)
    WHEN regexp_matches(tag, '(?is)\bhttp-equiv\s*=\s*["'']?\s*refresh\b')
      THEN regexp_extract(tag, '(?is)\burl\s*=\s*[''"]?([^\s"''>]+)', 1) END, '&amp;', '&'), ' ') AS ref
  FROM tags
), targets AS (
  SELECT url, CASE
    WHEN regexp_matches(ref, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN ref
    WHEN starts_with(ref, '//') THEN regexp_extract(url, '(?s)^(.*?)://', 1) || ':' || ref
    WHEN starts_with(ref, '/') THEN regexp_extract(url, '(?s)^.*?://[^/?#]*', 0) || ref
    ELSE regexp_extract(url, '(?s)^.*?://[^/?#]*', 0) || coalesce(nullif(regexp_replace(
      regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '[^/]*$', ''), ''), '/') || ref END AS target
  FROM refs WHERE ref <> ''
), urls AS (
  SELECT url FROM pages UNION SELECT target FROM targets
), parsed AS (
  SELECT url,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
    translate(regexp_extract(coalesce(url, ''), '(?s)^(.*?)://', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS scheme,
    coalesce(nullif(regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^#]*)', 1), ''), '/') AS rest
  FROM urls
), ruled AS (
  SELECT p.*, CASE WHEN p.host <> '' THEN p.scheme || '://' || p.host || p.rest END AS node, r.rule, r.verdict
  FROM parsed p LEFT JOIN (
    SELECT q.url, max_by(r.host || r.path, length(r.host || r.path)) AS rule, max_by(r.verdict, length(r.host || r.path)) AS verdict
    FROM parsed q JOIN rules r
      ON (q.host = r.host OR suffix(q.host, '.' || r.host)) AND starts_with(q.path, r.path)
    GROUP BY q.url
  ) r ON p.url IS NOT DISTINCT FROM r.url
), links AS (
  SELECT DISTINCT a.node AS a, b.node AS b FROM targets t
  JOIN ruled a ON t.url = a.url JOIN ruled b ON t.target = b.url WHERE a.node IS NOT NULL AND b.node IS NOT NULL
), both_ways AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
), reach(node, other) AS (
  SELECT a, a FROM both_ways UNION SELECT reach.node, both_ways.b FROM reach JOIN both_ways ON reach.other = both_ways.a
), blocked AS (
  SELECT reach.node FROM reach JOIN ruled ON reach.other = ruled.node
  GROUP BY reach.node HAVING bool_or(ruled.verdict = 'block') AND NOT coalesce(bool_or(ruled.verdict = 'allow'), false)
)
SELECT page_id, host, path, rule,
  coalesce(verdict, CASE WHEN node IN (SELECT node FROM blocked) THEN 'block' END, 'allow') AS verdict
FROM pages JOIN ruled ON pages.url IS NOT DISTINCT FROM ruled.url
"""


def _op5_sql() -> str:
    """Every block against every template, without the filters."""
    templates = ", ".join(
        "({}, '{}', {}, {}, {}, {})".format(
            t,
            label,
            own,
            license_scan.least_shared(len(own), license_scan.THRESHOLD),
            *license_scan.block_of(n),
        )
        for t, ((label, text), n) in enumerate(
            zip(license_scan.TEMPLATES, license_scan.block_words(license_scan.TEMPLATES), strict=True)
        )
        for own in [license_scan.template_words(text)]
    )
    phrases = ", ".join(f"({p.split(' ')}, '{label}')" for p, label in license_scan.PHRASES)
    return f"""
WITH templates(t, label, own, least, size, step) AS (VALUES {templates}), phrases(parts, label) AS (VALUES {phrases}), docs AS (
  SELECT row_number() OVER () AS r, doc_id, {_DUCK_WORDS.format("text")} AS w FROM documents
), words AS (
  SELECT r, unnest(w) AS word, unnest(range(len(w))) AS i FROM docs
), parts AS (
  SELECT t, size, step, unnest(own) AS word FROM templates
), counted AS (
  SELECT r, t, s, list(DISTINCT word) AS shared FROM (
    SELECT r, t, word, unnest(generate_series(greatest((i - size + step) // step, 0), i // step)) AS s FROM words JOIN parts USING (word)
  ) GROUP BY r, t, s
), hits AS (
  SELECT r, size, s, t, label, shared, len(shared) / len(own) AS share FROM counted JOIN templates USING (t) WHERE len(shared) >= least
), yielding AS (
  SELECT DISTINCT p.r, p.s, p.t FROM hits p JOIN hits q ON p.r = q.r AND p.size = q.size AND p.s = q.s AND p.label <> q.label
  WHERE len(list_intersect(p.shared, q.shared)) = len(p.shared) AND (len(q.shared) > len(p.shared) OR q.share > p.share)
), matches AS (
  SELECT r, label, share FROM hits ANTI JOIN yielding USING (r, s, t)
), places AS (
  SELECT r, label, i - 1 AS start FROM (SELECT r, w, unnest(generate_series(1, len(w))) AS i FROM docs WHERE list_contains(w, 'license')), phrases
  WHERE list_slice(w, i, i + len(parts) - 1) = parts
), base AS (
  SELECT r, count(*) AS n, min(start) AS lo, max(start) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM places GROUP BY r
), found AS (
  SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT r, label FROM places UNION ALL SELECT r, label FROM matches) GROUP BY r
), best AS (
  SELECT r, max(share) AS share FROM matches GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, lo AS first_word, hi AS last_word,
  coalesce(base.labels, '') AS base_labels, coalesce(found.labels, '') AS labels,
  CASE WHEN n > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score
FROM docs LEFT JOIN base USING (r) LEFT JOIN found USING (r) LEFT JOIN best USING (r)
"""


OP7_SQL = r"""
WITH dw AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), bw AS (
  SELECT item_id, len(w) AS n, w FROM (
    SELECT DISTINCT item_id,
      regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
  ) WHERE len(w) > 0
), bwin AS (
  SELECT DISTINCT item_id, least(n, 10) AS k, array_to_string(list_slice(w, i, i + least(n, 10) - 1), ' ') AS win
  FROM (SELECT *, unnest(generate_series(1, n - least(n, 10) + 1)) AS i FROM bw)
), ks AS (
  SELECT DISTINCT k FROM bwin
), dwin AS (
  SELECT r, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS win
  FROM (SELECT r, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM dw, ks WHERE len(w) >= k)
), hits AS (
  SELECT d.r, d.i, d.k, b.item_id FROM dwin d JOIN bwin b ON d.k = b.k AND d.win = b.win
), words AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (
    SELECT r, unnest(generate_series(i, i + k - 1)) AS p FROM (SELECT DISTINCT r, i, k FROM hits)
  ) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

OP9_SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
), g AS (
  SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm
)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g ON t.norm = g.norm
"""


#: Every phrase counted by itself, without the graph.
OP11_SQL = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS p, lang, piece FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)
), words AS (
  SELECT p, lang, unnest(w) AS w1, generate_subscripts(w, 1) AS i
  FROM (SELECT p, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces)
), runs AS (
  SELECT lang, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3, lead(w1, 3) OVER o AS w4 FROM words WINDOW o AS (PARTITION BY p ORDER BY i)
), f AS (
  SELECT lang, k, phrase, count(*) AS f FROM (
    SELECT lang, 1 AS k, w1 AS phrase FROM runs UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM runs
    UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM runs UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM runs
  ) WHERE phrase IS NOT NULL GROUP BY ALL HAVING count(*) >= 30
), candidates AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1
), cuts AS (
  SELECT c.lang, c.phrase, c.a, j, l.f AS l, r.f AS r, (2000000::HUGEINT * c.a) // (l.f + r.f) AS score
  FROM (SELECT *, unnest(generate_series(1, k - 1)) AS j FROM candidates) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(ws[1:j], ' ') JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(ws[j + 1:], ' ')
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), inside AS (
  SELECT lang, array_to_string(ws[s:s + n - 1], ' ') AS phrase, max(a) AS cover
  FROM candidates, generate_series(2, 3) t(n), generate_series(1, 3) u(s) WHERE n < k AND s + n - 1 <= k GROUP BY ALL
), kept AS (
  SELECT best.* FROM best LEFT JOIN inside USING (lang, phrase) WHERE cover IS NULL OR 100::HUGEINT * cover < 80::HUGEINT * a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, (SELECT count(*) FROM words WHERE words.lang = ranked.lang) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
"""


def _op12_sql() -> str:
    """Row by row for all conversations together: per state the least (cost, audit) with its lines."""

    def best(*ways: str) -> str:
        return f"list_min([{', '.join(ways)}])"

    def way(state: str, cost: str, edit: str, line: str | None = None, when: str | None = None) -> str:
        lines = f"list_append({state}.t, {line})" if line else f"{state}.t"
        return f"CASE WHEN {state} IS NOT NULL{f' AND {when}' if when else ''} THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}', 't': {lines}}} END"

    stays = "fault NOT IN ('blank', 'duplicate')"
    more = "CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END"

    def kept(state: str, initial: str) -> str:
        return way(state, more, "K", "role || ':' || text", f"{stays} AND role[1] = '{initial}'")

    def given(state: str, role: str) -> str:
        return way(state, f"3 + {more}", "R", f"'{role}:' || text", stays)

    users = best("s2", *[way(s, "3", "I", "'user:'") for s in ("s0", "s1", "s3")])
    assistants = best("s3", way("u", "3", "I", "'assistant:'"))
    to_user = [x for s in ("s0", "s1", "a") for x in (kept(s, "u"), given(s, "user"))]
    white = r"[\x20\x09-\x0D]"
    return rf"""
WITH RECURSIVE crc AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(8), lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i) AS v FROM range(256) r(i))
), keyed AS (
  SELECT row_number() OVER () AS r, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations
), kinds AS (
  SELECT keyed.*, xor(list_reduce(list_transform(range(1, length(key) + 1), lambda k: ascii(key[k])::BIGINT),
    lambda a, b: xor(a >> 8, crc.t[(xor(a, b) & 255) + 1]), 4294967295), 4294967295) % 20 AS kind FROM keyed, crc
), damaged AS (
  SELECT conv_id, turn, r, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM kinds, range(2) c(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text), r) AS i FROM damaged
), faulty AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?]{white}*\z') THEN 'truncated' ELSE '' END AS fault,
    lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair
  FROM placed
), steps AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 't': []::VARCHAR[]}} AS s0,
    NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR[]) AS s1, NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR[]) AS s2, NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR[]) AS s3
  FROM faulty
  UNION ALL
  SELECT conv_id, i + 1, {way("s0", "4", "D")}, {best(way("s1", "4", "D"), kept("s0", "s"))},
    {best(way("u", "4", "D"), *to_user)}, {best(way("a", "4", "D"), kept("u", "a"), given("u", "assistant"))}
  FROM (SELECT *, {assistants} AS a FROM (
    SELECT steps.conv_id, steps.i, s0, s1, s2, s3, role, text, fault, {users} AS u
    FROM steps JOIN faulty ON steps.conv_id IS NOT DISTINCT FROM faulty.conv_id AND faulty.i = steps.i + 1))
), ends AS (
  SELECT conv_id, {best("s0", assistants)} AS e FROM (SELECT *, {users} AS u FROM steps
    WHERE (conv_id, i) IN (SELECT (conv_id, max(i)) FROM faulty GROUP BY conv_id))
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(e.c, 0) AS cost, coalesce(e.a, '') AS audit,
  sha256(coalesce(array_to_string(e.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counts n ON c.conv_id IS NOT DISTINCT FROM n.conv_id LEFT JOIN ends ON c.conv_id IS NOT DISTINCT FROM ends.conv_id
"""


def queries() -> dict:
    return {
        "op1_html_text": op1_html_text,
        "op2_secret_scan": op2_secret_scan,
        "op3_simhash_near_dedup": op3_simhash_near_dedup,
        "op4_url_filter": op4_url_filter,
        "op5_license_scan": op5_license_scan,
        "op6_language_id": op6_language_id,
        "op7_benchmark_decontamination": op7_benchmark_decontamination,
        "op8_bpe": op8_bpe,
        "op9_exact_dedup": op9_exact_dedup,
        "op10_quality": op10_quality,
        "op11_phrase_collocations": op11_phrase_collocations,
        "op12_conversation_repair": op12_conversation_repair,
        "op13_token_counts": op13_token_counts,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_url_filter": OP4_SQL,
        "op5_license_scan": _op5_sql(),
        "op7_benchmark_decontamination": OP7_SQL,
        "op9_exact_dedup": OP9_SQL,
        "op11_phrase_collocations": OP11_SQL,
        "op12_conversation_repair": _op12_sql(),
    }
