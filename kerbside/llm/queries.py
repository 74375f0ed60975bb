"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbside.llm import bpe, fingerprints, interpolation, jaccard, language_id, lexical_search, mixing, token_counts, topk, toxicity
from kerbside.llm import url_filters, warc, whitening
from kerbside.llm.common import read
from kerbside.llm.registry import query

URL_RULES = (
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"),
)


def _url_sql() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def fits(rule: str) -> str:
        host, _, path = rule.partition("/")
        return f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}'))"

    def hits(terms) -> str:
        each = (f"CAST(regexp_matches(low, '(?s)(^|[^a-z0-9]){t}([^a-z0-9]|$)') AS INT)" for t in terms)
        return f"CASE WHEN low IS NULL THEN 0 ELSE {' + '.join(each)} END"

    ordered = sorted(URL_RULES, key=lambda r: -len(r[1]))
    rule = "CASE " + " ".join(f"WHEN {fits(r)} THEN '{r}'" for _, r in ordered) + " END"
    verdict = "CASE rule " + " ".join(f"WHEN '{r}' THEN '{v}'" for v, r in ordered)
    return f"""
    WITH parts AS (
      SELECT page_id, translate(url, '{upper}', '{lower}') AS low,
        translate(coalesce(regexp_extract(url, '(?s)://([^/?#]*)', 1), ''), '{upper}', '{lower}') AS host,
        coalesce(regexp_extract(url, '(?s)://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
    hits AS (
      SELECT page_id, host, path, {rule} AS rule, {hits(url_filters.STRICT)} AS strict_hits, {hits(url_filters.SOFT)} AS soft_hits
      FROM parts)
    SELECT page_id, host, path, rule, CAST(strict_hits AS INT) AS strict_hits, CAST(soft_hits AS INT) AS soft_hits,
      {verdict} ELSE CASE WHEN strict_hits > 0 OR soft_hits >= {url_filters.SOFT_LIMIT} THEN 'block' ELSE 'allow' END END AS verdict
    FROM hits"""


@query("op1_url_filter", _url_sql())
def url_filter(spark, sf_dir):
    """Every page's url under the rules, else under the vocabulary."""
    judged = url_filters.judge_urls(read(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "strict_hits", "soft_hits", "verdict")


@query("op2_token_count")
def token_count(spark, sf_dir):
    """Tokens of every document under word_bpe_49k.json."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs).select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query("op5_bpe_round_trip")
def bpe_round_trip(spark, sf_dir):
    """Every document encoded with byte_bpe_50k.json and decoded again."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = bpe.decode(bpe.encode(docs).select("doc_id", "ids", "n_tokens"))
    return decoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def _warc_sql() -> str:
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    groups = (f"CAST('0x' || substr(hex_digest, {1 + 5 * g}, 5) AS BIGINT)" for g in range(8))
    digest = " || ".join(f"substr('{letters}', CAST(({v} >> {shift}) & 31 AS BIGINT) + 1, 1)" for v in groups for shift in (15, 10, 5, 0))
    return f"""
    WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex_digest FROM pages),
    kept AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS last_id FROM payloads)
    SELECT page_id, strlen(payload) AS payload_bytes, {digest} AS payload_digest,
      CASE WHEN page_id = last_id THEN 'response' ELSE 'revisit' END AS record_type,
      CASE WHEN page_id <> last_id THEN last_id END AS refers_to
    FROM kept"""


@query("op3_warc_round_trip", _warc_sql())
def warc_round_trip(spark, sf_dir):
    """Every page written to archives and read back; payloads of any length may be revisited."""
    manifest = warc.write_archives(warc.record_chunks(read(spark, sf_dir, "pages"), min_bytes=0))
    last = warc.read_archives(manifest).where("last")
    digest = F.when(F.col("record_type") == "response", F.col("digest_so_far")).otherwise(F.col("payload_digest"))
    return last.select(
        F.col("record_id").alias("page_id"), "payload_bytes", digest.alias("payload_digest"), "record_type", "refers_to"
    )


@query(
    "op7_exact_top_k",
    """
    WITH fine AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
      SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM fine q JOIN fine c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
    SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM ranked WHERE rank <= 5""",
)
def exact_top_k(spark, sf_dir):
    """The five best vectors by integer inner product for every fiftieth vector."""
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


@query("op8_fingerprints")
def document_fingerprints(spark, sf_dir):
    """Every document's fingerprint beside those of its edit and of the next document."""
    return fingerprints.compare_with_next(read(spark, sf_dir, "documents").select("doc_id", "text"))


def fold(parts: int):
    """The remainder that decides whether a document is held out."""
    return F.crc32(F.col("doc_id").cast("string")) % parts


def language_network(docs):
    """The network for documents outside the held-out fold."""
    return language_id.fit(docs.where(fold(4) != 2))


def toxicity_model(docs, labels):
    """The models for labels outside the held-out fold."""
    return toxicity.fit(docs, labels.where(fold(5) != 0))


@query("op4_language_id")
def identified_languages(spark, sf_dir):
    """The language of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    rows = language_id.identify(docs.select("doc_id", "text"), language_network(docs))
    return rows.select("doc_id", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query("op6_toxicity")
def toxicity_scores(spark, sf_dir):
    """The toxicity of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    rows = toxicity.score(docs, toxicity_model(docs, read(spark, sf_dir, "labels")))
    return rows.select("doc_id", F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


@query("op9_ngram_jaccard")
def ngram_jaccard(spark, sf_dir):
    """Every document's component of links at 0.85 over four-word shingles."""
    return jaccard.similar_classes(read(spark, sf_dir, "documents").select("doc_id", "text"))


# Production weights of tokens: twenty sources alike and a little for all others.
MIX_TARGETS = {
    "source": {f"src{i}": 0.0495 for i in range(20)} | {"other": 0.01},
    "lang": {"en": 0.55, "fr": 0.14, "de": 0.14, "es": 0.14, "other": 0.03},
    "topic": {"prose": 0.7, "tabular": 0.08, "contact": 0.08, "licensing": 0.06, "numeric": 0.08},
}
MIX_BUDGET = 0.5  # of all tokens


def _mix_sql(rounds: int) -> str:
    """Raking as a recursive query: every round scales the cells to one marginal after another."""
    quoted = lambda names: ", ".join(f"'{n}'" for n in sorted(names) if n != mixing.OTHER)
    category = lambda a: f"CASE WHEN {a} IN ({quoted(MIX_TARGETS[a])}) THEN {a} ELSE '{mixing.OTHER}' END AS {a}"
    whole = "coalesce(text, '')"
    tests = lambda needle, pattern: " AND ".join(
        [f"contains({whole}, '{needle}')"] * bool(needle) + [f"regexp_matches({whole}, '{pattern}')"] * bool(pattern)
    )
    topic = " ".join(f"WHEN {tests(needle, pattern)} THEN '{name}'" for name, needle, pattern in mixing.TOPICS)
    goals = " UNION ALL ".join(
        f"SELECT '{a}' AS axis, '{c}' AS category, CAST({g} AS DOUBLE) AS goal" for a in mixing.AXES for c, g in MIX_TARGETS[a].items()
    )
    wanted = ", ".join(
        f"""{a}_goals AS (SELECT {a}, coalesce(max(goal), 0) / sum(coalesce(max(goal), 0)) OVER () AS {a}_goal
          FROM cells LEFT JOIN goals ON axis = '{a}' AND category = {a} GROUP BY {a})"""
        for a in mixing.AXES
    )
    scaled = "SELECT step + 1 AS step, source, lang, topic, source_goal, lang_goal, topic_goal, share FROM raked WHERE step < " + str(rounds)
    for a in mixing.AXES:
        scaled = f"""SELECT step, source, lang, topic, source_goal, lang_goal, topic_goal,
          CASE WHEN sum(share) OVER (PARTITION BY {a}) > 0 THEN share * ({a}_goal / sum(share) OVER (PARTITION BY {a})) ELSE 0 END AS share
          FROM ({scaled})"""
    return f"""
    WITH RECURSIVE placed AS (
      SELECT doc_id, text, {category("source")}, {category("lang")}, CASE {topic} ELSE '{mixing.PROSE}' END AS topic,
        CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS tokens,
        CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || chr(31) || coalesce(text, '')), 1, 12) AS BIGINT)
          / CAST(281474976710656 AS DOUBLE) AS draw
      FROM documents),
    cells AS (SELECT source, lang, topic, CAST(sum(tokens) AS DOUBLE) AS n FROM placed GROUP BY 1, 2, 3 HAVING sum(tokens) > 0),
    goals AS ({goals}), {wanted},
    raked AS (
      SELECT 0 AS step, source, lang, topic, source_goal, lang_goal, topic_goal, n / sum(n) OVER () AS share
      FROM cells JOIN source_goals USING (source) JOIN lang_goals USING (lang) JOIN topic_goals USING (topic)
      UNION ALL {scaled}),
    fitted AS (
      SELECT source, lang, topic, n, share / sum(share) OVER () AS share, share / sum(share) OVER () / n AS density
      FROM raked JOIN cells USING (source, lang, topic) WHERE step = {rounds}),
    filled AS (
      SELECT density, ({MIX_BUDGET} * sum(n) OVER () - coalesce(sum(n) OVER before, 0)) / (1 - coalesce(sum(share) OVER before, 0)) AS scale
      FROM fitted WHERE share > 0
      WINDOW before AS (ORDER BY density DESC, source, lang, topic ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    chosen AS (SELECT coalesce(arg_max(scale, density) FILTER (WHERE scale * density <= 1), max(1 / density)) AS scale FROM filled),
    priced AS (
      SELECT source, lang, topic, share * sum(n) OVER () / n AS weight, greatest(0, least(1, scale * density)) AS probability
      FROM fitted CROSS JOIN chosen)
    SELECT doc_id, source, lang, topic, tokens, round(weight, 6) AS weight, round(probability, 6) AS probability, round(draw, 9) AS draw,
      draw < probability AS kept
    FROM placed JOIN priced USING (source, lang, topic)"""


@query("op10_source_mixing", _mix_sql(60))
def source_mixing(spark, sf_dir):
    """Every document's cell, weight and probability, and whether the mix keeps it."""
    mixed = mixing.mix(read(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"), MIX_TARGETS, MIX_BUDGET)
    names = ("source", "lang", "topic", "tokens", "weight", "probability", "draw", "kept")
    rows = mixed.select("doc_id", *[F.col(f"mix_{n}").alias(n) for n in names])
    return rows.withColumns({"weight": F.round("weight", 6), "probability": F.round("probability", 6), "draw": F.round("draw", 9)})


@query("op11_embedding_whitening")
def embedding_whitening(spark, sf_dir):
    """Every embedding on the eight leading components."""
    return whitening.whiten(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query(
    "op13_lexical_search",
    r"""
    WITH words AS (
      SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
    counts AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY 1, 2),
    lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM counts GROUP BY 1),
    totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lengths),
    weights AS (
      SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
      FROM counts, totals GROUP BY term, docs),
    wanted AS (
      SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
    scored AS (
      SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))))::BIGINT AS score
      FROM wanted JOIN counts USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), totals GROUP BY 1, 2),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
    SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM ranked WHERE rank <= 10""",
)
def ranked_search(spark, sf_dir):
    """The ten best documents for every benchmark item."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical_search.search(docs, read(spark, sf_dir, "benchmark").select("item_id", "text"), k=10)


@query("op12_lm_scoring")
def lm_scoring(spark, sf_dir):
    """The log-probability of every document under an interpolated model of the documents outside the held-out fold."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    rows = interpolation.score_texts(docs, fold(5) != 1)
    held_out = F.coalesce(fold(5) == 1, F.lit(False)).alias("held_out")
    return rows.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")
