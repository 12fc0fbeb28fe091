"""Document fingerprints: SimHash over weighted word pairs, and all fingerprints within a
Hamming radius by permuted block tables. DataFrame functions only.

A term is a pair of words, or the last word; its weight grows with its length, as long words
are rare. Every occurrence votes with its weight on each bit.

Defined results: a null text is empty; a text without words has a fingerprint of zeros. Equal
texts have equal fingerprints. Rows are told apart, so repeated rows are fingerprinted each.
The next document is the next row by id, then by a hash of the text; a row without an id is
next to none and has no next. An empty table gives an empty result; a text of any length is
read whole, its terms summed where it is read. Only id and text are read, whatever other
columns are called.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfmark.operators.joins import skew_join
from shelfmark.llm.common import staged, whole

BITS = 128
#: Two counters to a long: the lower and the upper half hold one bit's votes each.
_LANES = 0x0000000100000001
RADIUS, BLOCKS = 3, 6
#: Rows between two cuts of the id order, cuts at most, and cuts to a step of the search.
ROWS_PER_RANGE, MAX_RANGES, SEARCH_STEP = 2_000, 16_384, 128


def terms(words: Column) -> Column:
    """The terms at each word, as ``(hash, weight)``; the empty word of a text without any
    weighs nothing."""
    return F.transform(words, lambda word, i: F.struct(
        F.xxhash64(word, F.get(words, i + 1)).alias("hash"),
        (F.length(word) + F.coalesce(F.length(F.get(words, i + 1)), F.lit(0)))
        .cast("long").alias("weight"),
    ))


def words_of(text: Column) -> Column:
    """What stands between ASCII white space; one empty word if there is nothing else."""
    return F.split(F.regexp_replace(text, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", ""), r"[\x20\x09-\x0D]+")


def fingerprints(df: DataFrame, texts: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """A row per row of ``df``: ``keep``, and ``<text>_fp``, 32 hex digits, for each text column.

    Terms are exploded in the scan's own stage and summed there row by row, so that only a
    row of counters per text is shuffled, however long the text.
    """
    numbered = df.select(F.monotonically_increasing_id().alias("_row"), *keep, *texts)
    versions = numbered.select("_row", *keep, F.explode(F.array(*(
        F.struct(F.lit(name).alias("version"), F.col(name).alias("text")) for name in texts
    ))).alias("_v")).select("_row", *keep, "_v.version", words_of(F.col("_v.text")).alias("_words"))
    voters = versions.select(
        "_row", *keep, "version", F.explode(terms(F.col("_words"))).alias("_t")
    ).select(
        "_row", *keep, "version", F.col("_t.weight").alias("_w"), F.col("_t.hash").alias("_h0")
    ).withColumn("_h1", F.xxhash64("_h0"))
    votes = [
        F.sum(F.shiftrightunsigned(f"_h{half}", bit).bitwiseAND(F.lit(_LANES)) * F.col("_w"))
        .alias(f"_{half}_{bit}")
        for half in range(BITS // 64) for bit in range(32)
    ]
    summed = voters.groupBy("_row", *keep, "version").agg(F.sum("_w").alias("_all"), *votes)

    def bits(half: int) -> Column:
        set_bits = []
        for bit in range(32):
            votes_of = F.col(f"_{half}_{bit}")
            for count, at in (
                (votes_of.bitwiseAND(F.lit(0xFFFFFFFF)), bit),
                (F.shiftrightunsigned(votes_of, 32), bit + 32),
            ):
                value = (1 << at) - (1 << 64 if at == 63 else 0)
                set_bits.append(F.when(count + count > F.col("_all"), F.lit(value)).otherwise(F.lit(0)))
        while len(set_bits) > 1:
            set_bits = [a.bitwiseOR(b) for a, b in zip(set_bits[::2], set_bits[1::2], strict=True)]
        return set_bits[0]

    made = summed.select("_row", *keep, "version", F.lower(F.concat(*(
        F.lpad(F.hex(bits(half)), 16, "0") for half in range(BITS // 64)
    ))).alias("_fp"))
    return made.groupBy("_row", *keep).agg(*(
        F.max(F.when(F.col("version") == name, F.col("_fp"))).alias(f"{name}_fp") for name in texts
    )).drop("_row")


def halves(fingerprint: Column) -> list[Column]:
    """The bits as two longs."""
    return [
        F.conv(F.substring(fingerprint, 1 + 16 * half, 16), 16, -10).cast("long")
        for half in range(BITS // 64)
    ]


def distance(a: Column, b: Column) -> Column:
    """Hamming distance of two fingerprints."""
    return reduce(lambda x, y: x + y, (
        F.bit_count(x.bitwiseXOR(y)) for x, y in zip(halves(a), halves(b), strict=True)
    ))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - distance(a, b) / F.lit(float(BITS))


def with_next(df: DataFrame, id_col: str, tie: Column, value: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Add ``_next``: the ``value`` of the next row by id and tie, after the last the first.

    The order is cut into ranges at ids of the data, found by quantiles, and each range is
    one window. A range's first rows are copied to the end of the one before, and the very
    first to the end of the last, so that rows are shuffled once and none is looked up.
    """
    ids = df.select(F.col(id_col).cast("long").alias("_id")).where("_id is not null")
    count, least = ids.agg(F.count("*"), F.min("_id")).first()
    ranges = max(1, min(MAX_RANGES, count // rows_per_range))
    cuts = {least or 0}
    if ranges > 1:
        shares = [number / ranges for number in range(1, ranges)]
        cuts.update(ids.agg(F.percentile_approx("_id", shares, 4 * MAX_RANGES)).first()[0])
    bounds = F.split(F.lit(",".join(map(str, sorted(cuts)))), ",").cast("array<bigint>")
    steps = F.split(F.lit(",".join(map(str, sorted(cuts)[::SEARCH_STEP]))), ",").cast("array<bigint>")
    last = len(cuts) - 1
    number = F.col(id_col).cast("long")
    step = F.size(F.filter(steps, lambda cut: cut <= number)) - 1
    near = F.slice(bounds, step * SEARCH_STEP + 1, F.lit(SEARCH_STEP))
    placed = df.withColumn("_tie", tie).withColumn("_range", F.when(
        number.isNotNull(), step * SEARCH_STEP + F.size(F.filter(near, lambda cut: cut <= number)) - 1
    ).otherwise(-1 - F.pmod(F.col("_tie"), F.lit(MAX_RANGES)).cast("int")))
    before = F.when(F.col("_range") > 0, F.col("_range") - 1).otherwise(F.lit(last))
    first = F.get(bounds, F.col("_range")) == number
    own = F.struct(F.col("_range").alias("range"), F.lit(False).alias("copy"))
    copies = placed.withColumn("_place", F.explode(F.when(
        first, F.array(own, F.struct(before.alias("range"), F.lit(True).alias("copy")))
    ).otherwise(F.array(own))))
    order = Window.partitionBy("_place.range").orderBy("_place.copy", id_col, "_tie")
    return (
        copies.withColumn("_next", F.when(F.col(id_col).isNotNull(), F.lead(value).over(order)))
        .where(~F.col("_place.copy")).drop("_tie", "_range", "_place")
    )


def edit(text: Column, other: Column) -> Column:
    """The text with its last quarter replaced by as much from the start of another."""
    size = F.char_length(text)
    quarter = F.floor(size / 4).cast("int")
    return F.concat(F.left(text, size - quarter), F.left(whole(other), quarter))


def fingerprint_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS
) -> DataFrame:
    """Fingerprints of each text and its edited text, their likeness, and that to the next.

    ``near_links`` is the number of other fingerprints among all documents within the
    radius of this one.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), whole(F.col(text_col)).alias("text"))
    edited = with_next(texts, "doc_id", F.xxhash64("text"), "text").select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), "text",
        edit(F.col("text"), F.col("_next")).alias("edited"),
        F.xxhash64("text").alias("_order"),
    ).withColumn("edited_sha256", F.sha2("edited", 256))
    prints = staged(
        fingerprints(edited, ["text", "edited"], ["doc_id", "n_chars", "edited_sha256", "_order"]),
        "simhash-printed",
    )
    links = within_radius(prints.select(F.col("text_fp").alias("fingerprint")), radius)
    known = with_next(prints, "doc_id", F.col("_order"), "text_fp")
    return skew_join(
        known, links.select(F.col("fingerprint").alias("text_fp"), "near_links"), ["text_fp"], "left"
    ).select(
        F.col("doc_id").alias(id_col), "n_chars", "edited_sha256",
        F.col("text_fp").alias("fingerprint"), F.col("edited_fp").alias("edited_fingerprint"),
        likeness(F.col("text_fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("text_fp"), F.coalesce("_next", F.lit("0" * (BITS // 4)))).alias("near_next"),
        F.coalesce("near_links", F.lit(0).cast("long")).alias("near_links"),
    )


def block_masks(blocks: int) -> list[list[int]]:
    """For each block of the bits, its part of either half."""
    cuts = [BITS * number // blocks for number in range(blocks + 1)]
    return [
        [
            sum(1 << 63 - (place - half) for place in range(max(start, half), min(stop, half + 64)))
            for half in range(0, BITS, 64)
        ]
        for start, stop in zip(cuts, cuts[1:], strict=False)
    ]


def signed(bits: int) -> Column:
    """64 bits as a long."""
    return F.lit(bits - (1 << 64) if bits >> 63 else bits).cast("long")


def met_within(prints: DataFrame, radius: int, blocks: int) -> DataFrame:
    """Each two distinct fingerprints within the radius, in both orders: ``(a, b, distance)``,
    a and b as structs of longs.

    The bits are cut into blocks. Fingerprints that differ in at most ``radius`` bits agree
    in all of at least ``blocks - radius`` blocks, so one table per choice of that many
    blocks, keyed by them, brings every such pair together. Keys met once are dropped
    before the join. Of the tables in which a pair meets the first counts, that of the first
    blocks they agree in, so pairs come once and need no shuffle to be told apart.
    """
    if not 0 < radius < blocks:
        raise ValueError("the radius must be positive and below the number of blocks")
    bits = F.struct(*(half.alias(f"h{n}") for n, half in enumerate(halves(F.col("fingerprint")))))
    distinct = staged(
        prints.where("fingerprint is not null").select(bits.alias("bits")).distinct(),
        "simhash-distinct",
    )
    masks = block_masks(blocks)
    tables = list(combinations(range(blocks), blocks - radius))

    def parts(block: int) -> list[Column]:
        return [F.col(f"bits.h{n}").bitwiseAND(signed(mask)) for n, mask in enumerate(masks[block])]

    keyed = distinct.select("bits", F.explode(F.array(*(
        F.struct(
            F.lit(number).alias("table"),
            F.xxhash64(F.lit(number), *(part for block in chosen for part in parts(block))).alias("key"),
        ) for number, chosen in enumerate(tables)
    ))).alias("at")).select("bits", "at.*")
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    met = staged(skew_join(keyed, shared, ["key"], "inner"), "simhash-met")
    a, b = met.alias("a"), met.alias("b")
    differ = [F.col(f"a.bits.h{n}").bitwiseXOR(F.col(f"b.bits.h{n}")) for n in range(BITS // 64)]
    apart = reduce(lambda x, y: x + y, map(F.bit_count, differ))
    agreed = reduce(lambda x, y: x.bitwiseOR(y), (
        F.when(
            reduce(lambda x, y: x.bitwiseOR(y), (
                bits.bitwiseAND(signed(part)) for bits, part in zip(differ, mask, strict=True)
            )) == 0, F.lit(1 << block)
        ).otherwise(F.lit(0))
        for block, mask in enumerate(masks)
    ))
    # By table: the blocks up to the last one chosen, and which of them are.
    up_to = F.array(*(F.lit((2 << max(chosen)) - 1) for chosen in tables))
    wanted = F.array(*(F.lit(sum(1 << block for block in chosen)) for chosen in tables))
    first = agreed.bitwiseAND(F.get(up_to, F.col("a.table"))) == F.get(wanted, F.col("a.table"))
    return a.join(
        b,
        (F.col("a.key") == F.col("b.key")) & (F.col("a.table") == F.col("b.table"))
        & (F.col("a.bits") != F.col("b.bits")) & (apart <= radius) & first,
    ).select(F.col("a.bits").alias("a"), F.col("b.bits").alias("b"), apart.alias("distance"))


def printed(bits: str) -> Column:
    """The struct of longs as a fingerprint."""
    return F.lower(F.concat(*(F.lpad(F.hex(F.col(f"{bits}.h{n}")), 16, "0") for n in range(BITS // 64))))


def pairs_within(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """All pairs ``(a, b, distance)``, a < b, of distinct fingerprints within the radius."""
    met = met_within(prints, radius, blocks)
    return met.select(printed("a").alias("a"), printed("b").alias("b"), "distance").where("a < b")


def within_radius(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """The number of other fingerprints near each, where there is any.

    Pairs are counted in the task that joins them; only counts are shuffled.
    """
    counts = met_within(prints, radius, blocks).groupBy("a").agg(F.count("*").alias("near_links"))
    return counts.select(printed("a").alias("fingerprint"), "near_links")
