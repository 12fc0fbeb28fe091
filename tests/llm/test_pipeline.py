import brute
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from shelfmark.llm import toxicity
from shelfmark.llm.common import staged
from test_tokens import check_packing

STAGES = dict(corpus_pipeline.STAGES)


def test_stages_are_in_order():
    assert list(STAGES) == ["toxicity", "exact_dedup", "near_dedup", "pii", "packing"]


def test_run_against_brute_force(spark, sf_small, documents, texts):
    labels = spark.read.parquet(f"{sf_small}/labels.parquet")
    model = toxicity.fit(documents, labels)
    automaton = model.lexicon.automaton()
    kept = {
        n: t for n, t in texts.items()
        if model.score(np.array([toxicity.features(t, automaton)]))[0] < toxicity.THRESHOLD
    }
    latest = {}
    for number, text in sorted(kept.items()):
        latest[brute.lower(text)] = number
    kept = {number: kept[number] for number in latest.values()}
    component = brute.near_components(kept, 5, 80)
    kept = {n: t for n, t in kept.items() if component[n] == n}
    assert 0 < len(kept) < len(texts)
    masked = {}
    for number, text in kept.items():
        for kind in brute.PII:
            for found, start, end in reversed(brute.spans(text, {kind: brute.PII[kind]})):
                text = text[:start] + f"[{found.upper()}]" + text[end:]
        masked[number] = text
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {n: tokenizer.encode(t, add_special_tokens=False).ids for n, t in masked.items()}
    check_packing(corpus_pipeline.run(spark, sf_small).collect(), ids)


def test_stages_on_edges(spark, sf_small, edge_docs, empty_docs):
    for docs in (edge_docs, empty_docs):
        for name, stage in corpus_pipeline.STAGES:
            result = stage(spark, docs, sf_small)
            if name != "packing":
                assert result.columns == docs.columns
            docs = staged(result, f"test-{name}")
        assert (docs.count() == 0) == (result.limit(1).count() == 0)
