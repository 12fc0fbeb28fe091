"""Patterns in the database's dialect, and the canonical text of JSON values."""

import json
import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from shelfmark.functions import Container, java_pattern, json_text, matches_regex, with_document_fields


def finds(spark, pattern, texts):
    rows = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, t string")
    found = {r.n for r in rows.where(matches_regex(F.col("t"), pattern)).collect()}
    return [n in found for n in range(len(texts))]


WORDS = ["a word here", "swordfish", "Word", "a_word", "word1", "müword", ""]


@pytest.mark.parametrize("pattern, texts, want", [
    (r"\mword", WORDS, [1, 0, 1, 0, 1, 0, 0]),
    (r"word\M", WORDS, [1, 0, 1, 1, 0, 1, 0]),
    (r"\yword\y", WORDS, [1, 0, 1, 0, 0, 0, 0]),
    (r"\Yword", WORDS, [0, 1, 0, 1, 0, 1, 0]),
    ("[[:<:]]word[[:>:]]", WORDS, [1, 0, 1, 0, 0, 0, 0]),
    ("[[:alpha:]]+ here$", WORDS, [1, 0, 0, 0, 0, 0, 0]),
    (r"^\w+$", ["ab_1", "a b", "é1"], [1, 0, 1]),
    ("a.c", ["a\nc", "abc", "ac"], [1, 1, 0]),
    ("(?n)a.c", ["a\nc", "abc"], [0, 1]),
    ("c$", ["abc", "abc\n", "c\nd"], [1, 0, 0]),
    ("(?n)c$", ["abc", "abc\n", "c\nd"], [1, 1, 1]),
    ("(?c)Ab", ["Ab", "ab"], [1, 0]),
    ("(?x)a b # note\nc", ["abc", "a b c"], [1, 0]),
    ("***=a.b", ["a.b", "axb"], [1, 0]),
    ("***:a.b", ["a.b", "axb"], [1, 1]),
    ("(?q)a+[", ["A+[", "aa["], [1, 0]),
    ("a{2}$", ["aa", "ba", "a{2}"], [1, 0, 0]),
    ("a{b}", ["a{b}", "ab"], [1, 0]),
    ("^[]a-c-]+$", ["]b-", "d"], [1, 0]),
    ("^[^]]$", ["a", "]"], [1, 0]),
    (r"^[\d[:punct:]]+$", ["1.2", "a"], [1, 0]),
    ("[[.a.][=b=]]", ["a", "B", "c"], [1, 1, 0]),
    ("^[&&a]+$", ["&a&", "b"], [1, 0]),
    (r"^a\x41\t$", ["aa\t", "aa"], [1, 0]),
    (r"(a|b)\1", ["aa", "ab"], [1, 0]),
    ("^(?:a|b)+?$", ["abab", "c"], [1, 0]),
    ("(?<=a)b(?!c)", ["ab", "abc", "b"], [1, 0, 0]),
    ("", ["", "x"], [1, 1]),
    ("a|", ["b"], [1]),
])
def test_patterns(spark, pattern, texts, want):
    assert finds(spark, pattern, texts) == [bool(w) for w in want]


@pytest.mark.parametrize("pattern", [
    "a**", "*a", "a*+", "a{2}{3}", "a{3,2}", "a{1,999}", "a{1;2}", "(a", "a)", "[a", "[[:nope:]]",
    "[[.space.]]", "(?#x)", "(?<name>a)", "(?b)a", r"\Q", r"\12", r"\u12", "a\\", "***x", "[a-[:digit:]]",
    r"\mword\M+", "^*",
])
def test_what_cannot_be_read(pattern):
    with pytest.raises(ValueError):
        java_pattern(pattern)


@settings(max_examples=150, deadline=None)
@given(st.text("ab.#-& é\n\"'~@", max_size=8), st.text("ab.#-& é\n\"'~@", max_size=12))
def test_plain_signs_stand_for_themselves(needle, text):
    """What is no sign of the language is quoted where Java gives it a meaning."""
    pattern = java_pattern("".join("\\" + c if c == "." else c for c in needle))
    plain = pattern.removeprefix("(?iu)").replace("\\#", "#").replace("\\-", "-").replace("\\&", "&").replace("\\~", "~")
    assert bool(re.search(plain, text)) == (needle in text)


def canonical(text):
    """The database's text by Python's parser, which keeps the last of repeated keys."""
    def write(value):
        if isinstance(value, dict):
            items = sorted(value.items(), key=lambda kv: (len(kv[0].encode()), kv[0].encode()))
            return "{" + ", ".join(f"{json.dumps(k, ensure_ascii=False)}: {write(v)}" for k, v in items) + "}"
        if isinstance(value, list):
            return "[" + ", ".join(map(write, value)) + "]"
        return value.text if isinstance(value, Number) else json.dumps(value, ensure_ascii=False)

    return write(json.loads(text, parse_int=Number, parse_float=Number))


class Number:
    def __init__(self, text):
        self.text = text


DOCUMENTS = [
    '[]', '{}', '["a","b"]', '[ "a" , 1.50, true,null ]', '{"bb":1,"a":2,"c":{"y":[1,{"z":0}],"x":"q"}}',
    '{"a":1,"a":{"b":2,"b":3}}', '["x\\u00e9\\"\\\\/","\\u001f\\n"]', '{"é":1,"zz":2,"z":3}',
    '["a,b:{c}","[1,2]"]', '[[[[]]],{"k":{}}]', '{"\\u0061":1,"a":2}',
]


def test_canonical_text(spark):
    rows = spark.createDataFrame([(n, t) for n, t in enumerate(DOCUMENTS)], "n int, t string")
    found = {r.n: r.text for r in rows.select("n", json_text(F.col("t")).alias("text")).collect()}
    assert found == {n: canonical(t) for n, t in enumerate(DOCUMENTS)}


def test_numbers_and_other_texts(spark):
    cases = {
        "[1e2]": "[100]", "[-0]": "[0]", "[-0.00]": "[0.00]", "[1.5E3,-2e-3]": "[1500, -0.002]",
        "[12.340e1]": "[123.40]", "[10]": "[10]", "plain, text": "plain, text", "7": "7", "": "", None: None,
    }
    rows = spark.createDataFrame([(n, t) for n, t in enumerate(cases)], "n int, t string")
    found = {r.n: r.text for r in rows.select("n", json_text(F.col("t")).alias("text")).collect()}
    assert found == dict(enumerate(cases.values()))


def test_container_fields(spark):
    docs = ['{"k":{"f":["a","b"]}}', '{"k":{"f":"a,b"}}', '{"k":{"f":{"bb":1,"a":2}}}', '{"k":{}}', "{"]
    rows = spark.createDataFrame([(n, t) for n, t in enumerate(docs)], "n int, d string")
    found = with_document_fields(rows, "d", {"f": Container("k.f")}, ["n"]).collect()
    assert {r.n: r.f for r in found} == {0: '["a", "b"]', 1: "a,b", 2: '{"a": 2, "bb": 1}', 3: None, 4: None}
