"""The registered queries of the text operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfmark.llm import pii, quality, secrets_ledger, simhash, toxicity
from shelfmark.llm.alignment import align_documents
from shelfmark.llm.common import span_digest
from shelfmark.llm.exact_dedup import exact_duplicates, text_digest
from shelfmark.llm.line_dedup import MIN_CHARS, MIN_DOCS, dedup_lines
from shelfmark.llm.near_dup import Settings as NearSettings, near_duplicates
from shelfmark.llm.packing import pack_documents
from shelfmark.llm.pieces import encode_documents
from shelfmark.llm.prefix_trie import FAMILY, SHARED, prefix_trie
from shelfmark.llm.url_filter import RULES, SOFT_HITS, STRICT, VOCABULARY, filter_urls


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxic_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: the toxicity of every document, learned from the labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: the fingerprints of every document and its edited text."""
    return simhash.fingerprint_documents(table(spark, sf_dir, "documents"))


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: the personal data of every document."""
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    return span_digest(found, F.col("found"), pii.NAMES, pii.NAMES, F.col("base"))


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: a verdict on the url of every page."""
    return filter_urls(table(spark, sf_dir, "pages"))


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: every token of every document in one piece of a sequence."""
    return pack_documents(table(spark, sf_dir, "documents"))


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: the secrets of every document, by way of a ledger that starts empty."""
    docs = table(spark, sf_dir, "documents")
    found, _ = secrets_ledger.scan_documents(docs)
    kinds = [rule.kind for rule in secrets_ledger.RULES]
    return span_digest(
        found.withColumnRenamed("path", "doc_id"), F.col("findings"),
        list(secrets_ledger.BASE_KINDS), kinds,
    )


def piece_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: the SentencePiece ids of every document."""
    return encode_documents(table(spark, sf_dir, "documents"))


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: every document with the row that stays of its equals."""
    digest = text_digest(F.col("text"))
    return exact_duplicates(table(spark, sf_dir, "documents"), carry={"text_sha256": digest})


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: the quality of every document, learned from positives outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    return quality.score_documents(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: every document with its component of near duplicates, on three-word shingles."""
    return near_duplicates(
        table(spark, sf_dir, "documents"), settings=NearSettings(words=3, percent=85)
    )


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: every document without the lines that many documents share."""
    left = dedup_lines(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: the alignment of two tokenizers over every document."""
    return align_documents(table(spark, sf_dir, "documents"))


def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: every node of the trie of rebuilt conversations."""
    return prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": toxic_scores,
    "op2_simhash": fingerprints,
    "op3_pii": personal_data,
    "op4_url_filter": url_rules,
    "op5_packing": packing,
    "op6_secret_scan": secret_scan,
    "op7_sentencepiece": piece_ids,
    "op8_exact_dedup": exact_dedup,
    "op9_quality": quality_scores,
    "op10_near_dup": near_dup,
    "op11_line_dedup": line_dedup,
    "op12_alignment": alignment,
    "op13_prefix_trie": conversation_trie,
}


def _lower(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _url_sql() -> str:
    """Rules and terms, one condition each."""
    rules = sorted(RULES, key=lambda rule: len(rule.name), reverse=True)
    fits = [
        f"WHEN (host = '{rule.host}' OR ends_with(host, '.{rule.host}')) "
        f"AND starts_with(path, '{rule.path}') THEN " for rule in rules
    ]
    names = " ".join(fit + f"'{rule.name}'" for fit, rule in zip(fits, rules, strict=True))
    verdicts = " ".join(fit + f"'{rule.verdict}'" for fit, rule in zip(fits, rules, strict=True))

    def hits(strict: bool) -> str:
        terms = [term for term, weight in VOCABULARY.items() if (weight >= STRICT) == strict]
        return " + ".join(
            f"regexp_matches(address, '(^|[^a-z0-9]){term}([^a-z0-9]|$)')::int" for term in terms
        )

    return f"""
        WITH cut AS (
            SELECT page_id, regexp_extract(coalesce(url, ''), '^.*?://(.*)$', 1, 's') AS rest
            FROM pages),
        parts AS (
            SELECT page_id, {_lower("rest")} AS address,
                   {_lower("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM cut),
        counted AS (
            SELECT *, CASE {names} END AS rule, {hits(True)} AS strict_terms,
                   {hits(False)} AS soft_terms, CASE {verdicts} END AS rule_verdict
            FROM parts)
        SELECT page_id, host, path, rule, strict_terms, soft_terms,
               coalesce(rule_verdict, CASE WHEN strict_terms >= 1 OR soft_terms >= {SOFT_HITS}
                                           THEN 'block' ELSE 'allow' END) AS verdict
        FROM counted
    """


def _line_sql() -> str:
    """Lines by explode and join, the way the operator avoids."""
    key = _lower(r"regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')")
    return f"""
        WITH numbered AS (
            SELECT row_number() OVER () AS document, doc_id,
                   string_split(coalesce(text, ''), chr(10)) AS lines
            FROM documents),
        placed AS (
            SELECT document, doc_id, unnest(lines) AS line,
                   generate_subscripts(lines, 1) AS place
            FROM numbered),
        keyed AS (SELECT *, {key} AS key FROM placed),
        shared AS (
            SELECT key FROM keyed WHERE length(key) >= {MIN_CHARS}
            GROUP BY key HAVING count(DISTINCT document) >= {MIN_DOCS})
        SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines,
               count(shared.key) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY place)
                               FILTER (WHERE shared.key IS NULL), '')) AS kept_sha256
        FROM keyed LEFT JOIN shared ON keyed.key = shared.key
        GROUP BY document
    """


def _trie_sql() -> str:
    """Nodes as paths of turn digests; the checksum goes bit by bit."""
    steps = """list_reduce(
        list_concat([4294967295], flatten(list_transform(
            string_split(conv_id::varchar, ''), lambda s: list_concat([ord(s)::bigint], repeat([-1], 8))))),
        lambda sum, s: CASE WHEN s >= 0 THEN xor(sum, s)
                         WHEN sum % 2 = 1 THEN xor(sum // 2, 3988292384) ELSE sum // 2 END)"""
    return f"""
        WITH turns AS (
            SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place,
                   sha256(coalesce(role, '') || chr(0) || coalesce(text, '')) AS content,
                   len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
            FROM conversations WHERE conv_id IS NOT NULL),
        sizes AS (SELECT conv_id, count(*) AS own FROM turns GROUP BY conv_id),
        planned AS (
            SELECT s.conv_id, s.own, xor({steps.replace("conv_id", "s.conv_id")}, 4294967295) % {SHARED} AS shared,
                   s.conv_id - s.conv_id % {FAMILY} AS base, coalesce(b.own, 0) AS there
            FROM sizes s LEFT JOIN sizes b ON b.conv_id = s.conv_id - s.conv_id % {FAMILY}),
        convs AS (SELECT *, least(shared, there) AS taken FROM planned),
        rebuilt AS (
            SELECT c.conv_id, t.place - shared + taken AS place, content, words
            FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place > shared
            UNION ALL
            SELECT c.conv_id, t.place, content, words
            FROM convs c JOIN turns t ON t.conv_id = c.base AND t.place <= taken),
        steps AS (
            SELECT conv_id, place AS depth, words,
                   string_agg(content, '') OVER (PARTITION BY conv_id ORDER BY place) AS path
            FROM rebuilt
            UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
        lengths AS (SELECT conv_id, max(depth) AS depth FROM steps GROUP BY conv_id),
        nodes AS (
            SELECT path, s.depth, min(s.conv_id) AS conv_id, count(*) AS n_convs,
                   (count(*) - 1) * any_value(words) AS saved,
                   sha256(coalesce(string_agg(s.conv_id::varchar, ',' ORDER BY s.conv_id)
                                   FILTER (WHERE l.depth = s.depth), '')) AS ends_sha256
            FROM steps s JOIN lengths l USING (conv_id) GROUP BY path, s.depth),
        counted AS (
            SELECT n.*, p.conv_id AS parent_conv_id,
                   (SELECT count(*) FROM nodes c
                    WHERE c.depth = n.depth + 1 AND starts_with(c.path, n.path)) AS n_children
            FROM nodes n LEFT JOIN nodes p
              ON p.depth = n.depth - 1 AND p.path = left(n.path, length(n.path) - 64))
        SELECT n.conv_id, n.depth, n.parent_conv_id, n.n_convs, n.n_children, n.ends_sha256,
               count(*) FILTER (WHERE d.n_children = 0) AS n_leaves,
               sum(d.saved)::bigint AS saved_tokens
        FROM counted n JOIN counted d ON d.depth >= n.depth AND starts_with(d.path, n.path)
        GROUP BY n.path, n.conv_id, n.depth, n.parent_conv_id, n.n_convs, n.n_children, n.ends_sha256
    """


_NORMAL = _lower("coalesce(text, '')")

ORACLE_SQL = {
    "op11_line_dedup": _line_sql(),
    "op13_prefix_trie": _trie_sql(),
    "op4_url_filter": _url_sql(),
    "op8_exact_dedup": f"""
        WITH hashed AS (SELECT doc_id, sha256({_NORMAL}) AS text_sha256 FROM documents)
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               text_sha256
        FROM hashed WINDOW same AS (PARTITION BY text_sha256)
    """,
}
