import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import brute
from conftest import LONG, ROWS
from shelfmark.llm import quality, toxicity
from shelfmark.llm.labels import Logistic, held_out, training_labels
from shelfmark.llm.queries import QUERIES


def auc(rows, truth):
    scored = sorted((row.score, truth[row.doc_id]) for row in rows if row.doc_id in truth)
    above = below = 0.0
    good = [s for s, label in scored if label]
    bad = [s for s, label in scored if not label]
    for s in good:
        below += sum(b < s for b in bad)
        above += 0.5 * sum(b == s for b in bad)
    return (above + below) / (len(good) * len(bad))


@pytest.mark.parametrize("name, label, folds, fold, least", [
    ("op1_toxicity", "toxic", 4, 2, 0.9), ("op9_quality", "quality", 5, 0, 0.95),
])
def test_held_out_accuracy(spark, name, label, folds, fold, least):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = QUERIES[name](spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    for row in rows:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % folds == fold)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.3)
    unseen = [row for row in rows if row.held_out]
    assert auc(unseen, labels) > least
    known = [row for row in unseen if row.doc_id in labels]
    assert np.mean([row.predicted == labels[row.doc_id] for row in known]) > 0.95


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality, "quality")])
def test_edges(edge_docs, empty_docs, edge_labels, module, label):
    for labels in (edge_labels, edge_labels.limit(0)):
        model = module.fit(edge_docs, labels)
        rows = module.score_documents(edge_docs, model).collect()
        assert len(rows) == len(ROWS)
        scores = {}
        for row in rows:
            assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.3)
            scores.setdefault(row.doc_id, set()).add(row.score)
        assert len(scores[7]) == 1 and scores[1] == scores[2]
    model = module.fit(empty_docs, edge_labels)
    assert module.score_documents(empty_docs, model).count() == 0


def test_only_training_labels_are_used_and_bounded(spark):
    labels = spark.createDataFrame([(n, n % 2) for n in range(4000)], "doc_id long, toxic int")
    rows = training_labels(labels, "toxic", 4, 2, 500).collect()
    assert len(rows) == 500
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 != 2 for r in rows)
    flags = labels.select("doc_id", held_out(labels.doc_id, 4, 2).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in flags)


def test_folding_and_exceptions():
    plain = toxicity.Lexicon.fixed().automaton()
    hits = lambda text: toxicity.features(text, plain)[0]
    assert hits("such an IDIOT") > 0 and hits("such an 1d10t here") > 0
    assert hits("such an іdiоt") > 0 and hits("what a l0$er") > 0  # look-alikes
    assert hits("idiotic") == 0 and hits("an idiots' guide") == 0 and hits("") == 0
    assert hits("the trash can") == 0 and hits("the trash can is trash") > 0
    assert toxicity.features("idiot " + LONG, plain)[1] < toxicity.features("idiot here", plain)[1]


def test_lexicon_learns_word_beginnings():
    toxic = [{f"zorg{i}x{j}" for j in range(3)} | {"common"} for i in range(20)]
    holders = toxicity.candidates(toxic)
    lexicon = toxicity.learn_lexicon(holders, 20, {("word", "common"): 100}, 100)
    assert "zorg" in lexicon.starts and "common" not in lexicon.words


def test_logistic_separates():
    rng = np.random.default_rng(0)
    rows = rng.normal(size=(400, 3))
    labels = (rows[:, 0] + 0.1 * rng.normal(size=400) > 0).astype(float)
    model = Logistic.fit(rows, labels)
    assert ((model(rows) > 0.5) == labels).mean() > 0.95


def test_risk_gradient_against_differences():
    rng = np.random.default_rng(1)
    for shift in (0.0, 6.0):
        p, u = rng.normal(size=7) + shift, rng.normal(size=9) - shift
        risk, by_p, by_u = quality.risk_gradient(p, u, 0.6)
        negative = np.logaddexp(0, u).mean() - 0.6 * np.logaddexp(0, p).mean()
        for at in range(7):
            moved = p.copy()
            moved[at] += 1e-6
            if negative >= 0:
                slope = (quality.risk_gradient(moved, u, 0.6)[0] - risk) / 1e-6
                assert slope == pytest.approx(by_p[at], abs=1e-4)
            else:
                after = np.logaddexp(0, u).mean() - 0.6 * np.logaddexp(0, moved).mean()
                assert -(after - negative) / 1e-6 == pytest.approx(by_p[at], abs=1e-4)
        assert (negative < 0) == (shift > 0)
        assert len(by_u) == 9


def test_positive_unlabelled_learning_finds_the_bad():
    rng = np.random.default_rng(4)
    good = rng.normal(size=(600, 4))
    mixed = np.vstack([rng.normal(size=(420, 4)), rng.normal(size=(180, 4)) + [4, 0, 0, 0]])
    model = quality.fit_network(good, mixed, 0.7)
    assert (model(mixed[:420]) >= 0.3).mean() > 0.9 and (model(mixed[420:]) < 0.3).mean() > 0.85


@pytest.mark.parametrize("prior", [0.3, 0.6, 0.85])
def test_prior_of_unlabelled_rows(prior):
    """Estimated from positives and a mixture, with no negative marked."""
    rng = np.random.default_rng(int(prior * 100))
    width = len(quality.NAMES)
    centre = np.zeros(width)
    centre[:3] = 2.5

    def mixed(count, share):
        good = rng.random(count) < share
        return rng.normal(0, 1, (count, width)) + np.where(good[:, None], centre, -centre)

    assert abs(quality.estimate_prior(mixed(5000, 1.0), mixed(6000, prior)) - prior) < 0.05


def test_no_bad_label_is_read(spark, documents):
    """Labels of bad texts, right or wrong, change nothing."""
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    models = [
        quality.fit(documents, chosen).weights
        for chosen in (labels, labels.where("quality = 1"))
    ]
    assert all((a == b).all() for a, b in zip(*models, strict=True))


def plain_quality(text):
    """The features of a text, by counting bytes and words, in lower case, one by one."""
    data, words = text.encode(), brute.WORD.findall(brute.lower(text))
    count = len(words)
    kinds = [
        lambda b: chr(b).isupper() and b < 128, lambda b: chr(b).islower() and b < 128,
        lambda b: 48 <= b <= 57, lambda b: chr(b) in ".,;:?",
        lambda b: 32 < b < 127 and not chr(b).isalnum() and chr(b) not in ".,;:?",
        lambda b: b == 10, lambda b: b >= 128, lambda b: b == 32 or 9 <= b <= 13,
    ]
    shares = [sum(map(kind, data)) / max(len(data), 1) for kind in kinds]
    solid = sum(len(word.encode()) for word in words)
    row = [math.log1p(count), min(solid / max(count, 1), 100), *shares]
    if not count:
        return row + [0.0] * 6
    runs = [list(zip(*(words[i:] for i in range(size)), strict=False)) for size in (2, 3, 5)]
    same = [[len(set(part)) == 1 for part in run] for run in runs]
    return row + [
        len(set(words)) / count, max(Counter(words).values()) / count,
        sum(same[0]) / max(len(runs[0]), 1),
        len(set(runs[0])) / len(runs[0]) if runs[0] else 1.0,
        len(set(runs[2])) / len(runs[2]) if runs[2] else 1.0,
        sum(same[1]) / max(len(runs[1]), 1),
    ]


def test_quality_query_against_brute_force(spark, sf_small, documents, texts):
    model = quality.fit(documents, spark.read.parquet(f"{sf_small}/labels.parquet"))
    first, shift, last, level = model.weights
    for row in QUERIES["op9_quality"](spark, sf_small).collect():
        x = [
            max(-8, min(8, (value - mean) / scale)) for value, mean, scale
            in zip(plain_quality(texts[row.doc_id]), model.mean, model.scale, strict=True)
        ]
        total = level[0]
        for place in range(len(last)):
            total += last[place] * math.tanh(shift[place] + sum(a * w for a, w in zip(x, first[:, place], strict=True)))
        assert row.score == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-9)


def plain_toxicity(text, lexicon):
    """The features of a text, term by term without an automaton."""
    folded = toxicity.fold(text)

    def places(term):
        at = folded.find(term)
        while at >= 0:
            end = at + len(term)
            if not (at and folded[at - 1].isalnum()):
                yield at, end, end == len(folded) or not folded[end].isalnum()
            at = folded.find(term, at + 1)

    harmless = [(a, b) for phrase in lexicon.exceptions for a, b, closed in places(phrase) if closed]
    heaviest = {}
    for terms, whole_word in ((lexicon.words, True), (lexicon.starts, False)):
        for term, weight in terms.items():
            for a, b, closed in places(term):
                if (closed or not whole_word) and not any(x <= a and b <= y for x, y in harmless):
                    heaviest[a] = max(heaviest.get(a, (0.0, "")), (weight, term))
    times = Counter(heaviest.values())
    total = sum(weight * (1 + math.log(count)) for (weight, _), count in times.items())
    return [math.log1p(total), math.log1p(100 * total / len(re.split(" ", folded))), math.log1p(len(times))]


def test_toxicity_query_against_brute_force(spark, sf_small, documents, texts):
    model = toxicity.fit(documents, spark.read.parquet(f"{sf_small}/labels.parquet"))
    shift, *weights = model.score.weights
    for row in QUERIES["op1_toxicity"](spark, sf_small).collect():
        found = plain_toxicity(texts[row.doc_id], model.lexicon)
        total = shift + sum(
            weight * (value - mean) / scale for weight, value, mean, scale
            in zip(weights, found, model.score.mean, model.score.scale, strict=True)
        )
        assert row.score == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-9)
