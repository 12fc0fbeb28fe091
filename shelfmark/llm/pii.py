"""Personal data: base patterns, and identifiers found by bootstrapped contexts.

The base patterns give the seed entities. The words around a seed are its lexical patterns;
a graph of patterns and instances is scored in rounds: a pattern by the share of its
instances that are known, an instance by the patterns that hold it. Patterns of high score
then mark what the base patterns miss: identifier-like words, and numbers written in several
groups of digits. DataFrame functions only.

Defined results: a null text is empty. Rows with the same id and text are one document to the
graph and get the same spans each. Offsets are code points, ends exclusive. Work is linear in
the text however many matches it holds; a text or identifier may be of any length. An empty
table gives an empty result. Other columns than id and text are not read, or passed on as
they are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.operators.joins import skew_join
from shelfmark.llm.common import staged, whole

_SPACE = r"\x20\x09-\x0D"


@dataclass(frozen=True)
class Kind:
    """A kind of identifier: its pattern, a cheap sign of its presence, what a match must pass.

    The patterns take the same leftmost matches as their plain forms, in linear time: a run
    is entered only at its start or where the last match ended, and never given back.
    """

    name: str
    pattern: str
    present: str
    shape: str


# The base patterns.
KINDS = (
    Kind(
        "email",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@", "mail",
    ),
    Kind(
        "ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", "number"
    ),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9][\x20-]?[0-9]", "number"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", "number"),
)
NAMES = [kind.name for kind in KINDS]
#: A group of digits as identifiers are written in, ``(555)``, ``010-99``, ``4111``.
_GROUP = r"\(?[0-9]{1,6}+(?![0-9])\)?(?:[.-][0-9]{1,6}+(?![0-9]))*+"
#: Two or more such words with one space between them, else a word with a digit or an at sign.
CANDIDATE = (
    rf"(?<![^{_SPACE}])(?:\+?{_GROUP}(?:\x20{_GROUP}(?![^{_SPACE}.,;:!?'\")\]]))++"
    rf"|[^{_SPACE}0-9@]*+[0-9@][^{_SPACE}]*+)"
)
#: What is cut from a candidate's ends; the end's run is entered only where it begins.
_EDGES = r"^[^A-Za-z0-9+]++|(?<=[A-Za-z0-9])[^A-Za-z0-9]++\z"
MIN_DIGITS = 6
#: Characters on each side of a place that its context words are taken from.
CONTEXT = 64
#: Distinct known instances a pattern needs, and the scores that patterns and words need.
MIN_SUPPORT = 3.0
MIN_PATTERN = 0.6
MIN_WORD = 0.6
ROUNDS = 3
_BLOCK = 256


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    doubled = F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)))
    places = F.split(F.reverse(number), "")
    total = F.aggregate(
        F.transform(
            F.filter(places, lambda sign: sign != ""),
            lambda sign, at: F.when(at % 2 == 0, sign.cast("int")).otherwise(
                F.get(doubled, sign.cast("int"))
            ),
        ),
        F.lit(0), lambda a, b: a + b,
    )
    return total % 10 == 0


def accepted(kind: str, value: Column) -> Column:
    """Whether a match of the pattern is one of the kind."""
    if kind == "ip":
        short = F.regexp_replace(value, r"(?<![0-9])0+(?=[0-9])", "")
        byte = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
        return short.rlike(rf"^{byte}(?:\.{byte}){{3}}$")
    if kind == "card":
        number = digits(value)
        return F.when(F.length(number).between(14, 19), luhn(number)).otherwise(False)
    if kind == "phone":
        return F.length(digits(value)).between(10, 15)
    return F.lit(True)


def with_matches(df: DataFrame, text: str, pattern: str, present: Column, name: str) -> DataFrame:
    """Add ``<name>``: the matches of a pattern as ``(value, start, before, after)``.

    The matches and what lies between them are cut from the text by the same pattern; the
    offsets are sums of their lengths, taken by blocks so that many matches stay cheap.
    ``before`` and ``after`` are the text on both sides, up to the next match.
    """
    found, gaps, steps, blocks = (f"_{name}_{part}" for part in ("m", "g", "s", "b"))
    none = F.array().cast("array<string>")
    matched = F.when(present, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none)
    df = df.withColumn(found, F.coalesce(matched, none))
    df = df.withColumn(
        gaps, F.when(F.size(found) > 0, F.split(text, pattern, -1)).otherwise(none)
    )
    df = df.withColumn(steps, F.transform(
        F.col(found), lambda m, i: F.length(m) + F.length(F.get(F.col(gaps), i))
    ))
    count = F.expr(f"int(ceil(size({steps}) / {_BLOCK}))")
    df = df.withColumn(blocks, F.when(
        F.size(steps) > 0,
        F.transform(F.sequence(F.lit(0), count - 1), lambda block: F.aggregate(
            F.slice(F.col(steps), block * _BLOCK + 1, F.lit(_BLOCK)), F.lit(0), lambda a, b: a + b
        )),
    ))
    df = df.withColumn(blocks, F.transform(F.col(blocks), lambda _, block: F.aggregate(
        F.slice(F.col(blocks), F.lit(1), block), F.lit(0), lambda a, b: a + b
    )))
    start = lambda i: (
        F.get(F.col(blocks), F.floor(i / _BLOCK).cast("int"))
        + F.aggregate(
            F.slice(F.col(steps), (i - i % _BLOCK) + 1, i % _BLOCK), F.lit(0), lambda a, b: a + b
        )
        + F.length(F.get(F.col(gaps), i))
    )
    df = df.withColumn(name, F.transform(F.col(found), lambda m, i: F.struct(
        m.alias("value"), start(i).alias("start"),
        F.right(F.get(F.col(gaps), i), F.lit(CONTEXT)).alias("before"),
        F.left(F.get(F.col(gaps), i + 1), F.lit(CONTEXT)).alias("after"),
    )))
    return df.drop(steps, blocks)


def with_base(df: DataFrame, text: str) -> DataFrame:
    """Add ``_base``: the accepted base matches as ``(kind, value, start, end, before, after)``."""
    for kind in KINDS:
        df = with_matches(df, text, kind.pattern, F.col(text).rlike(kind.present), kind.name)
        df = df.drop(f"_{kind.name}_m", f"_{kind.name}_g")

    def of(kind: str) -> Column:
        return F.transform(
            F.filter(F.col(kind), lambda m: accepted(kind, m["value"])),
            lambda m: F.struct(
                F.lit(kind).alias("kind"), m["value"].alias("value"), m["start"].alias("start"),
                (m["start"] + F.length(m["value"])).alias("end"),
                m["before"].alias("before"), m["after"].alias("after"),
            ),
        )

    return df.withColumn("_base", F.concat(*map(of, NAMES))).drop(*NAMES)


def word(column: Column) -> Column:
    """A context word: lower case, without punctuation at its ends."""
    return F.regexp_replace(F.lower(column), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")


def contexts(before: Column, after: Column) -> Column:
    """The lexical patterns of a place: the two words before it, and a word on each side.

    A place without a word before it, in the same stretch of text, has none.
    """
    left = F.filter(F.split(before, rf"[{_SPACE}]+"), lambda w: w != "")
    near = F.transform(F.slice(left, F.greatest(F.lit(1), F.size(left) - 1), F.lit(2)), word)
    last = F.get(near, F.size(near) - 1)
    next_ = word(F.coalesce(F.get(F.filter(F.split(after, rf"[{_SPACE}]+"), lambda w: w != ""), F.lit(0)), F.lit("")))
    both = F.when((F.size(near) == 2) & (F.get(near, F.lit(0)) != ""), F.concat(F.lit("< "), F.concat_ws(" ", near)))
    sides = F.when(next_ != "", F.concat(F.lit("<> "), last, F.lit(" _ "), next_))
    usable = (F.size(near) > 0) & last.rlike(r"\p{L}")
    patterns = F.filter(F.array(both, sides), lambda p: p.isNotNull())
    return F.when(usable, patterns).otherwise(F.array().cast("array<string>"))


def shape_of(value: Column) -> Column:
    return F.when(value.contains("@"), F.lit("mail")).otherwise(F.lit("number"))


def places(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row per document with its key, base matches and candidate words; texts stay behind.

    The key is the id and a hash of the text, so equal rows share it.
    """
    text = whole(F.col(text_col))
    df = docs.select(
        F.col(id_col).alias("_id"), F.xxhash64(F.col(id_col), text).alias("_key"), text.alias("_text")
    )
    df = with_base(df, "_text")
    df = with_matches(df, "_text", CANDIDATE, F.col("_text").rlike("[0-9@]"), "_words")
    likely = F.filter(F.col("_words"), lambda m: (
        m["value"].contains("@") | (F.length(digits(m["value"])) >= MIN_DIGITS)
    ))
    trimmed = F.transform(likely, lambda m: F.struct(
        F.regexp_replace(m["value"], _EDGES, "").alias("value"),
        (m["start"] + F.length(F.regexp_extract(m["value"], r"^[^A-Za-z0-9+]*", 0))).alias("start"),
        m["before"].alias("before"), m["after"].alias("after"),
    ))
    return df.select("_id", "_key", "_base", trimmed.alias("_candidates"))


def extra_spans(found: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Identifiers beyond the base: ``(_key, kind, value, start, end, score)``.

    Patterns and instances are grouped with partial sums, and joined back by joins that can
    split a pattern with very many instances.
    """
    rows = found.select("_key", "_base", "_candidates").dropDuplicates(["_key"])
    seeds = rows.select("_key", F.explode("_base").alias("m")).select(
        "_key", "m.kind", "m.value", "m.start", "m.end",
        contexts(F.col("m.before"), F.col("m.after")).alias("patterns"),
    )
    hit = F.exists(F.col("_base"), lambda b: (
        (b["start"] < F.col("m.start") + F.length("m.value")) & (b["end"] > F.col("m.start"))
    ))
    others = rows.select("_key", "_base", F.explode("_candidates").alias("m")).where(
        (F.col("m.value") != "") & ~hit
    ).select(
        "_key", F.lit(None).cast("string").alias("kind"), "m.value", "m.start",
        (F.col("m.start") + F.length("m.value")).alias("end"),
        contexts(F.col("m.before"), F.col("m.after")).alias("patterns"),
    )
    occurrences = staged(
        seeds.unionAll(others).where(F.size("patterns") > 0)
        .withColumn("shape", shape_of(F.col("value")))
        .withColumn("instance", F.xxhash64("shape", "value")),
        "pii-occurrences",
    )
    edges = staged(
        occurrences.select(F.explode("patterns").alias("pattern"), "shape", "instance", "kind")
        .groupBy("pattern", "shape", "instance").agg(F.max("kind").alias("kind")),
        "pii-edges",
    )
    scores = None
    patterns = None
    for _ in range(rounds):
        if scores is None:
            scored = edges.withColumn("score", F.col("kind").isNotNull().cast("double"))
        else:
            scored = skew_join(edges, scores, ["instance"], "left").withColumn(
                "score", F.when(F.col("kind").isNotNull(), 1.0).otherwise(F.coalesce("score", F.lit(0.0)))
            )
        patterns = staged(
            scored.groupBy("pattern", "shape", "kind").agg(
                F.sum("score").alias("known"), F.count("*").alias("n")
            ).groupBy("pattern", "shape").agg(
                F.sum("known").alias("known"), F.sum("n").alias("n"),
                F.max_by("kind", F.when(F.col("kind").isNotNull(), F.col("known"))).alias("likely"),
                F.max(F.when(F.col("kind").isNotNull(), F.col("known"))).alias("of_kind"),
                F.sum(F.when(F.col("kind").isNotNull(), F.col("known"))).alias("seeds"),
            ).where((F.col("of_kind") >= MIN_SUPPORT) & (F.col("of_kind") >= 0.8 * F.col("seeds")))
            .select("pattern", "shape", "likely", (F.col("known") / (F.col("n") + 1)).alias("trust"))
            .where(F.col("trust") >= MIN_PATTERN),
            "pii-patterns",
        )
        doubt = F.exp(F.sum(F.log1p(-F.col("trust"))))
        scores = skew_join(edges, patterns, ["pattern", "shape"], "inner").groupBy("instance").agg(
            (1 - doubt).alias("score")
        )
    placed = occurrences.where("kind is null").select(
        "_key", "value", "start", "end", "shape", "instance", F.explode("patterns").alias("pattern")
    )
    return (
        skew_join(placed, patterns, ["pattern", "shape"], "inner")
        .join(scores.where(F.col("score") >= MIN_WORD), "instance")
        .groupBy("_key", "start", "end").agg(
            F.max_by("likely", F.struct("trust", "likely")).alias("kind"),
            F.first("value").alias("value"), F.max("score").alias("score"),
        )
    )


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the id, ``found``, an array of ``(kind, start, end)``, and ``base``,
    those of the base patterns alone."""
    found = staged(places(docs, id_col, text_col), "pii-places")
    extras = extra_spans(found).groupBy("_key").agg(
        F.collect_list(F.struct("kind", "start", "end")).alias("_extra")
    )
    base = F.transform("_base", lambda m: F.struct(
        m["kind"].alias("kind"), m["start"].alias("start"), m["end"].alias("end")
    ))
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return skew_join(found.select("_id", "_key", base.alias("_spans")), extras, ["_key"], "left").select(
        F.col("_id").alias(id_col), F.concat("_spans", F.coalesce("_extra", none)).alias("found"),
        F.col("_spans").alias("base"),
    )


def masks(kind: str, matches: Column) -> Column:
    """What stands in place of each match: the kind, or the match if it is not accepted."""
    return F.transform(matches, lambda m: F.when(
        accepted(kind, m["value"]), F.lit(f"[{kind.upper()}]")
    ).otherwise(m["value"]))


def mask_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with every identifier replaced by its kind in brackets.

    Base kinds are masked one after the other, in linear time, then what the contexts mark
    in the document, the longest first.
    """
    found = staged(places(docs, id_col, text_col), "pii-places")
    extras = staged(
        extra_spans(found).groupBy("_key").agg(
            F.sort_array(
                F.collect_set(F.struct(F.length("value").alias("size"), "value", "kind")), asc=False
            ).alias("_extra")
        ),
        "pii-extras",
    )
    text = whole(F.col(text_col))
    # The whole row goes along as one column, so that no name can clash.
    df = docs.select(
        F.struct("*").alias("_row"), F.xxhash64(F.col(id_col), text).alias("_key"),
        text.alias("_masked"),
    )
    for kind in KINDS:
        df = with_matches(df, "_masked", kind.pattern, F.col("_masked").rlike(kind.present), "_found")
        joined = F.array_join(F.zip_with(
            F.col("__found_g"), masks(kind.name, F.col("_found")),
            lambda gap, mask: F.concat(gap, F.coalesce(mask, F.lit(""))),
        ), "")
        df = df.withColumn(
            "_masked", F.when(F.size("_found") > 0, joined).otherwise(F.col("_masked"))
        ).drop("_found", "__found_m", "__found_g")
    masked = F.when(F.col("_extra").isNull(), F.col("_masked")).otherwise(F.aggregate(
        F.col("_extra"), F.col("_masked"), lambda text, extra: F.replace(
            text, extra["value"], F.concat(F.lit("["), F.upper(extra["kind"]), F.lit("]"))
        )
    ))
    df = df.join(extras, "_key", "left").withColumn("_masked", masked)
    row = {name: F.col("_row")[name] for name in docs.columns}
    there = row[text_col].isNotNull()
    shown = {text_col: F.when(there, F.col("_masked"))}
    if "n_chars" in row:
        size = F.char_length("_masked").cast(docs.schema["n_chars"].dataType)
        shown["n_chars"] = F.when(there, size).otherwise(row["n_chars"])
    return df.select(*(shown.get(name, column).alias(name) for name, column in row.items()))
