"""Secret scan with an incremental ledger of content-addressed blobs.

Every version of every path is named by the SHA-256 of its text. A ledger holds which blob
was scanned with which rule version, and what was found. A run scans each blob and rule
version not in the ledger once, however many paths and versions hold the blob, adds to the
ledger, and joins the findings back to all paths.

``scan_into`` keeps the ledger as Parquet files in a given folder and adds to them.

Defined results: a null text is an empty blob without findings. An empty table has no findings
and adds nothing to the ledger; a text of any length is scanned whole. Repeated rows share a blob
and get its findings each. Offsets are code points, ends exclusive. Only id and text are
read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfmark.operators.joins import skew_join
from shelfmark.llm.common import staged, whole


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, what a match must pass, and what must be in the text.

    ``anchor`` is a Java pattern, cheap to look for, without which the rule can't match.
    """

    kind: str
    version: int
    pattern: str
    anchor: str
    accept: Callable[[re.Match[str]], bool] = lambda match: True


def entropy(text: str) -> float:
    """Bits per sign."""
    total = len(text)
    return -sum(n / total * math.log2(n / total) for n in Counter(text).values())


# The rules, base rules first.
BASE_KINDS = ("assign", "access", "hex")
RULES = (
    Rule(
        "assign", 1,
        r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]",
        lambda match: len(match[2]) >= 6,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", r"AKIA[A-Z0-9]{16}", lambda match: len(match[0]) >= 20),
    Rule("hex", 1, r"[0-9a-f]{24,}", r"[0-9a-f]{24}"),
    Rule(
        "private_key", 1, r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", "PRIVATE KEY-----",
    ),
    Rule(
        "web_token", 1,
        r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", r"eyJ.*\.eyJ",
    ),
    Rule("service_token", 1, r"\b(?:gh[pousr]_|xox[abprs]-|sk_live_|glpat-)[A-Za-z0-9_-]{16,}",
         r"(gh[pousr]_|xox[abprs]-|sk_live_|glpat-)"),
    Rule(
        "base64", 1, r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40,}={0,2}(?![A-Za-z0-9+/=])",
        r"[A-Za-z0-9+/]{40}",
        lambda match: entropy(match[0]) >= 4.5 and re.search(r"\d", match[0]) is not None,
    ),
)

LEDGER = "blob string, kind string, version int, spans array<struct<start:int,end:int>>"


def find_spans(text: str, rule: Rule) -> list[tuple[int, int]]:
    """Leftmost matches that the rule accepts; a match it does not accept is used up."""
    return [match.span() for match in re.finditer(rule.pattern, text) if rule.accept(match)]


def blob_id(text: Column) -> Column:
    return F.sha2(whole(text), 256)


def empty_ledger(docs: DataFrame) -> DataFrame:
    return docs.sparkSession.createDataFrame([], LEDGER)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger kept in a folder; an empty one where the folder has no files yet."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def versions_of(
    docs: DataFrame, id_col: str, text_col: str, rules: Sequence[Rule]
) -> DataFrame:
    """A row per path version: path, blob, and the rules whose anchor the text holds.

    Texts are read once here and stay where they are; naming a blob takes reading it all.
    """
    text = whole(F.col(text_col))
    due = F.filter(
        F.array(*(F.when(text.rlike(rule.anchor), F.lit(number)) for number, rule in enumerate(rules))),
        lambda number: number.isNotNull(),
    )
    return docs.select(F.col(id_col).alias("path"), blob_id(text).alias("blob"), due.alias("due"))


def scan_unseen(
    docs: DataFrame,
    versions: DataFrame,
    ledger: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: Sequence[Rule] = RULES,
) -> DataFrame:
    """New ledger rows: every blob and rule version that the ledger lacks, scanned once.

    A blob without a rule's anchor is entered without spans, as the rule can't match. Of
    the paths of any other blob one is picked, and only that text is fetched.
    """
    rule_names = F.array(*(
        F.struct(
            F.lit(number).alias("number"), F.lit(rule.kind).alias("kind"),
            F.lit(rule.version).alias("version"),
        ) for number, rule in enumerate(rules)
    ))
    blobs = versions.groupBy("blob").agg(F.min("path").alias("path"), F.first("due").alias("due"))
    pairs = blobs.select("blob", "path", "due", F.explode(rule_names).alias("rule")).select(
        "blob", "path", "rule.*", F.array_contains("due", F.col("rule.number")).alias("anchored")
    )
    seen = ledger.select("blob", "kind", "version")
    unseen = staged(pairs.join(seen, ["blob", "kind", "version"], "left_anti"), "secret-unseen")
    work = unseen.where("anchored").groupBy("blob", "path").agg(
        F.sort_array(F.collect_list("number")).alias("numbers")
    )

    @F.pandas_udf("array<struct<kind:string,version:int,spans:array<struct<start:int,end:int>>>>")
    def scan(texts: pd.Series, numbers: pd.Series) -> pd.Series:
        return pd.Series([
            [
                {
                    "kind": rules[number].kind, "version": rules[number].version,
                    "spans": [
                        {"start": start, "end": end} for start, end in find_spans(text, rules[number])
                    ],
                }
                for number in due
            ]
            for text, due in zip(texts, numbers, strict=True)
        ])

    work = staged(work, "secret-work")
    # Only texts with some anchor can be among the work, so no other leaves its scan.
    text = whole(F.col(text_col))
    anchored = reduce(lambda a, b: a | b, (text.rlike(rule.anchor) for rule in rules))
    texts = docs.where(anchored).select(F.col(id_col).alias("path"), text.alias("text"))
    fetched = texts.join(work, texts["path"].eqNullSafe(work["path"])).where(
        blob_id(F.col("text")) == F.col("blob")
    ).select("blob", "text", "numbers")
    scanned = fetched.select("blob", F.explode(scan("text", "numbers")).alias("found")).select(
        "blob", "found.*"
    ).distinct()
    nothing = F.array().cast("array<struct<start:int,end:int>>")
    return unseen.where("not anchored").select(
        "blob", "kind", "version", nothing.alias("spans")
    ).unionAll(scanned)


def scan_documents(
    docs: DataFrame,
    ledger: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: Sequence[Rule] = RULES,
) -> tuple[DataFrame, DataFrame]:
    """Findings of all paths, and the ledger with this run's rows added.

    The first has a row per path version: path, blob, and ``findings``, an array of
    ``(kind, start, end)``.
    """
    before = empty_ledger(docs) if ledger is None else ledger
    versions = staged(versions_of(docs, id_col, text_col, rules), "secret-versions")
    added = staged(scan_unseen(docs, versions, before, id_col, text_col, rules), "secret-ledger")
    after = before.select(*added.columns).unionAll(added)
    return findings_of(versions, after, rules), after


def scan_into(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: Sequence[Rule] = RULES,
) -> DataFrame:
    """Findings of all paths, by way of the ledger kept in the folder ``path``.

    What the run scanned is made first, in the scratch folder, and then appended, so a run that
    fails on the way leaves the ledger as it was. One run at a time may add to a folder; were two
    to add the same rows, findings would still count once.
    """
    before = read_ledger(docs.sparkSession, path)
    versions = staged(versions_of(docs, id_col, text_col, rules), "secret-versions")
    added = staged(scan_unseen(docs, versions, before, id_col, text_col, rules), "secret-ledger")
    added.write.mode("append").parquet(path)
    ledger = read_ledger(docs.sparkSession, path).dropDuplicates(["blob", "kind", "version"])
    return findings_of(versions, ledger, rules)


def findings_of(versions: DataFrame, ledger: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The ledger's findings by the given rules, joined to all paths.

    They meet by blob; blobs without findings need no join partner, and a blob of very many
    paths can be split.
    """
    current = F.create_map(*(F.lit(x) for rule in rules for x in (rule.kind, rule.version)))
    findings = (
        ledger.where((F.size("spans") > 0) & (current[F.col("kind")] == F.col("version")))
        .select("blob", "kind", F.explode("spans").alias("span"))
        .groupBy("blob").agg(F.collect_list(F.struct("kind", "span.start", "span.end")).alias("findings"))
    )
    nothing = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    joined = skew_join(versions.select("path", "blob"), findings, ["blob"], "left")
    return joined.withColumn("findings", F.coalesce("findings", nothing))
