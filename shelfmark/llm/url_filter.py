"""URL filter: site rules first, then a weighted vocabulary found by Aho-Corasick.

Defined results: a null url, or one without ``://``, has an empty host and path, meets no
rule and no term, and is allowed. Repeated rows are judged alike. Only the id and the url are
read, so other columns, whatever their names, have no effect.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.llm.common import lower_ascii, whole


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with its subdomains, below a path."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The site rules asked for, and the vocabulary with its weights. A strict
# term rejects alone; soft terms reject once enough distinct ones are met.
RULES = (
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
)
STRICT = 1.0
SOFT = 0.4
VOCABULARY = {
    **dict.fromkeys(
        ("porn", "porno", "pornhub", "xxx", "hentai", "camgirl", "camgirls", "escorts",
         "warez", "keygen", "sexcam", "sexcams", "milf", "casino-bonus", "viagra", "cialis"),
        STRICT,
    ),
    **dict.fromkeys(
        ("adult", "sex", "sexy", "nude", "naked", "hot", "girls", "dating", "escort", "casino",
         "poker", "bet", "betting", "slots", "jackpot", "crack", "torrent", "pills", "pharmacy",
         "replica", "loan", "loans", "payday", "bonus", "webcam", "webcams"),
        SOFT,
    ),
}
# Three soft terms reach a strict one's weight.
SOFT_HITS = 3


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    return F.regexp_extract(whole(url), r"(?s)^.*?://(.*)$", 1)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path."""
    after = after_scheme(url)
    host = lower_ascii(F.regexp_extract(after, r"^([^/?#]*)", 1))
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def site_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as a struct of name and verdict, or null."""
    best = F.lit(None)
    for rule in sorted(rules, key=lambda rule: (len(rule.name), rule.name)):
        on_host = (host == rule.host) | host.endswith("." + rule.host)
        best = F.when(
            on_host & path.startswith(rule.path),
            F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict")),
        ).otherwise(best)
    return best


def build_automaton(vocabulary: dict[str, float]) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for term, weight in vocabulary.items():
        automaton.add_word(term, (term, weight))
    automaton.make_automaton()
    return automaton


def in_word(sign: str) -> bool:
    return sign.isascii() and sign.isalnum()


def count_terms(address: str, automaton: ahocorasick.Automaton) -> tuple[int, int]:
    """Distinct strict and soft terms not next to an ASCII letter or digit."""
    strict, soft = set(), set()
    for end, (term, weight) in automaton.iter(address):
        start = end - len(term)
        if start >= 0 and in_word(address[start]):
            continue
        if end + 1 < len(address) and in_word(address[end + 1]):
            continue
        (strict if weight >= STRICT else soft).add(term)
    return len(strict), len(soft)


def filter_urls(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: Sequence[Rule] = RULES,
    vocabulary: dict[str, float] | None = None,
    soft_hits: int = SOFT_HITS,
) -> DataFrame:
    """One row per page: host, path, the rule met, hits of the vocabulary, the verdict.

    One pass without a shuffle. The vocabulary is a parameter and goes with the task.
    """
    terms = dict(VOCABULARY if vocabulary is None else vocabulary)

    @F.pandas_udf("strict int, soft int")
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = build_automaton(terms)
        for batch in batches:
            found = [count_terms(text, automaton) for text in batch]
            yield pd.DataFrame(found, columns=["strict", "soft"]).astype("int32")

    host, path = url_parts(F.col(url_col))
    judged = pages.select(
        F.col(id_col), host.alias("host"), path.alias("path"), hits(lower_ascii(after_scheme(F.col(url_col)))).alias("_hits")
    ).withColumn("_rule", site_rule(F.col("host"), F.col("path"), rules))
    rejected = (F.col("_hits.strict") >= 1) | (F.col("_hits.soft") >= soft_hits)
    return judged.select(
        id_col, "host", "path", F.col("_rule.name").alias("rule"),
        F.coalesce(
            F.col("_rule.verdict"), F.when(rejected, F.lit("block")).otherwise(F.lit("allow"))
        ).alias("verdict"),
        F.col("_hits.strict").alias("strict_terms"), F.col("_hits.soft").alias("soft_terms"),
    )
