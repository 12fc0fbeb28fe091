"""Toxicity by a weighted lexicon.

Texts are folded: lower case, look-alike letters and digits in place of letters become one
sign. Aho-Corasick then finds all lexicon terms at word starts, apart from those inside an
exception phrase. The weights found, as a total and for the text's length, give the score.

The lexicon holds a few fixed words and what labelled texts teach: words and word beginnings
met almost only in toxic texts, weighted by how much more often that is.

Defined results: a null or empty text meets no term and has the score of a text without
any. Repeated rows are scored alike. Labels other than 0 and 1 are not used; of two labels
for one id the larger counts. Without usable labels of both kinds only the fixed words and
default score weights are used. Only id and text are read.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from shelfmark.llm.common import whole
from shelfmark.llm.labels import Logistic, held_out, training_labels

FOLDS, FOLD = 4, 2
#: Labelled texts used for fitting, at most, and the share of them that may be toxic.
SAMPLE_ROWS = 12_000
#: Learned terms, at most, and the least toxic texts of the sample that hold one.
LEARNED_TERMS = 5_000
LEAST_TEXTS = 2
LEAST_RATIO = 4
SHORTEST_START, LONGEST_START = 4, 8
THRESHOLD = 0.3

# A starting lexicon with weights, and phrases in which a term is harmless.
LEXICON = {
    "idiot": 2.0, "moron": 2.0, "stupid": 1.5, "pathetic": 1.5, "worthless": 2.0, "loser": 2.0,
    "scum": 2.5, "disgusting": 1.5, "trash": 1.0, "clown": 1.0, "imbecile": 2.0,
}
EXCEPTIONS = (
    "trash can", "trash bin", "trash bag", "clown fish", "clownfish", "idiot proof",
    "sore loser rule", "class clown award",
)
# Signs that look like, or are written for, a Latin letter.
LOOKALIKES = {
    "a": "аαа@4", "b": "в8", "c": "сϲ", "e": "еεё3", "h": "һн", "i": "іιl1|!ӏ", "j": "ј",
    "k": "кκ", "m": "м", "n": "ո", "o": "оοօ0", "p": "рρ", "s": "ѕ5$", "t": "тτ7", "u": "υս",
    "v": "ν", "w": "ԝω", "x": "хχ", "y": "уγү",
}
#: Punctuation among them counts only inside a word.
INSIDE_ONLY = "@$!|"
_FULLWIDTH = {0xFF21 + n: chr(0x61 + n) for n in range(26)} | {
    0xFF41 + n: chr(0x61 + n) for n in range(26)
}
_WORD_SIGNS = "".join(s for s in "".join(LOOKALIKES.values()) if s not in INSIDE_ONLY)
_FOLD = str.maketrans(
    {s: letter for letter, signs in LOOKALIKES.items() for s in signs} | {
        chr(code): "i" if letter == "l" else letter for code, letter in _FULLWIDTH.items()
    }
)
_EDGE = re.compile(r"[@$!|]+(?!\w)|(?<!\w)[!|]+")
_WORD = re.compile(r"[^\W_]+")


def fold(text: str) -> str:
    """The text in lower case with look-alikes as the letters they stand for.

    ``l``, ``1`` and ``i`` become one sign, as a digit may stand for either letter. Signs of
    punctuation fold only inside a word; at its edge they become spaces.
    """
    text = text.lower()
    if any(sign in text for sign in INSIDE_ONLY):
        text = _EDGE.sub(lambda found: " " * len(found[0]), text)
    return text.translate(_FOLD)


@dataclass
class Lexicon:
    """Whole words and word beginnings with weights, and exception phrases, all folded."""

    words: dict[str, float] = field(default_factory=dict)
    starts: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()

    @classmethod
    def fixed(cls) -> Lexicon:
        return cls(
            {fold(word): weight for word, weight in LEXICON.items()}, {},
            tuple(fold(phrase) for phrase in EXCEPTIONS),
        )

    def automaton(self) -> ahocorasick.Automaton:
        automaton = ahocorasick.Automaton()
        kinds: dict[str, list[tuple[str, float]]] = {}
        for kind, terms in (("word", self.words), ("start", self.starts)):
            for term, weight in terms.items():
                kinds.setdefault(term, []).append((kind, weight))
        for phrase in self.exceptions:
            kinds.setdefault(phrase, []).append(("exception", 0.0))
        for term, uses in kinds.items():
            automaton.add_word(term, (len(term), uses))
        automaton.make_automaton()
        return automaton


def features(text: str, automaton: ahocorasick.Automaton) -> tuple[float, float, float]:
    """Logarithms of the weight found, of that per hundred words, and of the distinct terms.

    A term met again adds less each time.
    """
    folded = fold(text)
    found: list[tuple[int, int, float]] = []
    harmless: list[tuple[int, int]] = []
    if len(automaton):
        for last, (size, uses) in automaton.iter(folded):
            start, end = last - size + 1, last + 1
            if start and folded[start - 1].isalnum():
                continue
            closed = end == len(folded) or not folded[end].isalnum()
            for kind, weight in uses:
                if kind == "exception" and closed:
                    harmless.append((start, end))
                elif kind == "start" or kind == "word" and closed:
                    found.append((start, end, weight))
    if harmless:
        found = [
            (start, end, weight) for start, end, weight in found
            if not any(a <= start and end <= b for a, b in harmless)
        ]
    if not found:
        return 0.0, 0.0, 0.0
    by_start: dict[int, tuple[float, str]] = {}
    for start, end, weight in found:  # of terms that start together the heaviest counts
        by_start[start] = max((weight, folded[start:end]), by_start.get(start, (0.0, "")))
    times = Counter(by_start.values())
    total = sum(weight * (1 + math.log(count)) for (weight, _), count in times.items())
    words = folded.count(" ") + 1
    return math.log1p(total), math.log1p(100 * total / words), math.log1p(len(times))


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(fold(text)))


Term = tuple[str, str]


def terms_of(words: Iterable[str]) -> set[Term]:
    """Whole words, and their beginnings of four to eight letters."""
    found: set[Term] = set()
    for word in words:
        found.add(("word", word))
        for size in range(SHORTEST_START, min(LONGEST_START, len(word)) + 1):
            found.add(("start", word[:size]))
    return found


def candidates(toxic: list[set[str]]) -> dict[Term, set[int]]:
    """Terms of at least ``LEAST_TEXTS`` toxic texts, with the numbers of these texts."""
    holders: dict[Term, set[int]] = {}
    for number, words in enumerate(toxic):
        for term in terms_of(words):
            holders.setdefault(term, set()).add(number)
    return {term: texts for term, texts in holders.items() if len(texts) >= LEAST_TEXTS}


def learn_lexicon(
    holders: dict[Term, set[int]], toxic_texts: int, clean: dict[Term, int], clean_texts: int
) -> Lexicon:
    """Terms that mark toxic texts, found by greedy cover.

    ``holders`` has the toxic texts and ``clean`` the number of clean texts with each
    term. A term must be four times as common in toxic texts; its weight is the logarithm
    of that ratio, less for terms of few texts. The term that marks most texts not yet marked enough comes first; a
    text is marked enough by three terms.
    """
    lexicon = Lexicon.fixed()
    weights: dict[Term, float] = {}
    for term, texts in holders.items():
        often = (len(texts) + 0.5) / (toxic_texts + 1)
        ratio = often * (clean_texts + 1) / (clean.get(term, 0) + 0.5)
        if ratio >= LEAST_RATIO:
            weights[term] = math.log(ratio) * len(texts) / (len(texts) + 2)
    marks = [0] * toxic_texts
    explained: dict[str, set[int]] = {}  # texts with a picked term of this beginning

    def place(term: Term, gain: int) -> tuple[float, bool, int, Term]:
        """Of terms with the same gain whole words come first, then long beginnings."""
        return (-gain * weights[term], term[0] != "word", -len(term[1]), term)

    # A term's gain only shrinks, so a queue by last known gain needs few looks.
    queue = [place(term, len(holders[term])) for term in weights]
    heapq.heapify(queue)
    picked = 0
    while queue and picked < LEARNED_TERMS:
        last_known, _, _, term = heapq.heappop(queue)
        kind, letters = term
        texts = holders[term] - explained.get(letters, set())
        gain = sum(marks[text] < 3 for text in texts)
        if gain < LEAST_TEXTS:
            continue
        if gain * weights[term] < -last_known:
            heapq.heappush(queue, place(term, gain))
            continue
        if any(letters[:size] in lexicon.starts for size in range(SHORTEST_START, len(letters))):
            continue
        (lexicon.words if kind == "word" else lexicon.starts)[letters] = weights[term]
        picked += 1
        for size in range(SHORTEST_START, len(letters) + 1):
            explained.setdefault(letters[:size], set()).update(holders[term])
        for text in texts:
            marks[text] += 1
    return lexicon


@dataclass
class Model:
    lexicon: Lexicon
    score: Logistic


def default_score() -> Logistic:
    return Logistic(np.zeros(3), np.ones(3), np.array([-3.0, 1.0, 0.7, 0.7]))


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id",
    text_col: str = "text", sample_rows: int = SAMPLE_ROWS,
) -> Model:
    """Learn lexicon and score weights from at most ``sample_rows`` labelled texts.

    The sampled ids are broadcast to the scan. The driver gets the distinct words of the
    sampled toxic texts, counts of their terms in the clean ones, made in the tasks, and
    three numbers for each sampled text.
    """
    ids = training_labels(labels, label, FOLDS, FOLD, sample_rows).withColumnRenamed(
        "doc_id", "_id"
    )
    sample = docs.select(
        F.col(id_col).alias("_id"), whole(F.col(text_col)).alias("_text")
    ).join(ids, "_id")

    @F.pandas_udf("array<string>")
    def words(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: sorted(words_of(text)))

    spoken = sample.where("label = 1").select(words("_text").alias("words"))
    toxic = [set(row.words) for row in spoken.toLocalIterator()]
    holders = candidates(toxic)
    clean_texts, clean = clean_counts(sample.where("label = 0"), set(holders))
    lexicon = learn_lexicon(holders, len(toxic), clean, clean_texts)

    rows = sample.select("label", feature_column(lexicon)("_text").alias("x")).select(
        "label", "x.*"
    ).toPandas()
    if rows["label"].nunique() < 2:
        return Model(lexicon, default_score())
    columns = ["total", "dense", "distinct"]
    return Model(lexicon, Logistic.fit(rows[columns].to_numpy(), rows["label"].to_numpy()))


def clean_counts(sample: DataFrame, wanted: set[Term]) -> tuple[int, dict[Term, int]]:
    """The number of texts, and of those with each wanted term, counted in the tasks."""

    @F.pandas_udf("array<string>")
    def present(texts: pd.Series) -> pd.Series:
        return texts.map(
            lambda text: [f"{kind} {term}" for kind, term in terms_of(words_of(text)) & wanted]
        )

    counted = sample.select(F.explode(F.array_append(present("_text"), "")).alias("term"))
    counts = counted.groupBy("term").agg(F.count("*").alias("n")).toPandas()
    found = dict(zip(counts["term"], counts["n"], strict=True))
    texts = found.pop("", 0)
    return texts, {tuple(term.split(" ", 1)): n for term, n in found.items()}


def feature_column(lexicon: Lexicon):
    @F.pandas_udf("total double, dense double, distinct double")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = lexicon.automaton()
        for texts in batches:
            yield feature_frame(texts, automaton)

    return found


def feature_frame(texts: Iterable[str], automaton: ahocorasick.Automaton) -> pd.DataFrame:
    return pd.DataFrame(
        [features(text, automaton) for text in texts], columns=["total", "dense", "distinct"],
        dtype="float64",
    )


def score_column(model: Model):
    """A column function: the toxicity of a text, 0 to 1."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = model.lexicon.automaton()
        for texts in batches:
            yield pd.Series(model.score(feature_frame(texts, automaton).to_numpy()))

    return score


def score_documents(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The id, ``held_out``, ``score`` and ``predicted`` of each document; one pass."""
    score = score_column(model)(whole(F.col(text_col)))
    return docs.select(
        F.col(id_col), held_out(F.col(id_col), FOLDS, FOLD).alias("held_out"), score.alias("score")
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(
    docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The documents below the threshold, columns unchanged."""
    score = score_column(model)(whole(F.col(text_col)))
    return docs.where(score < threshold)
