"""Licence scans against plain searches."""

import random
import re

import pytest
from pyspark.sql import functions as F

from attestal.llm import licences

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PLAIN = {("gnu", "general", "public", "license"): "gpl", ("apache", "license"): "apache", ("cc", "by"): "cc-by", ("mit", "license"): "mit"}


def plain_words(text):
    return WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))


def plain_base(text):
    told = plain_words(text)
    places = [(i, label) for words, label in PLAIN.items() for i in range(len(told)) if tuple(told[i : i + len(words)]) == words]
    starts = [i for i, _ in places]
    return len(told), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in places}))


def some_text(rnd):
    """Pieces of notices, phrases, and other words, with all kinds of separators."""
    parts = []
    for _ in range(rnd.randrange(1, 25)):
        kind = rnd.random()
        if kind < 0.4:
            told = rnd.choice(licences.TEMPLATES)[1].split()
            start = rnd.randrange(len(told))
            parts += told[start : start + rnd.randrange(1, 20)]
        elif kind < 0.6:
            parts += rnd.choice(list(PLAIN))
        else:
            parts.append(rnd.choice(["MIT", "License", "cc", "BY", "Éa", "ÀB", "x", "the", "gnu", "7", "K", "ſ"]))
    return "".join(p + rnd.choice([" ", "\n", "-", "_", " ", ", ", "\x7f", "`", "  "]) for p in parts)


def test_base_places(spark):
    rnd = random.Random(3)
    texts = [some_text(rnd) for _ in range(300)] + ["", None, " ", "mit license", "MIT-LICENSE mit license", "GNU general public licenses"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in licences.scan_licences(df).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        row = got[i]
        assert (row["n_words"], row["n_base"], row["first_word"], row["last_word"], row["base_labels"]) == plain_base(text or "")
        assert set(filter(None, row["base_labels"].split(","))) <= set(row["labels"].split(","))
        assert 0 <= row["score"] <= 1 and (row["score"] > 0) == (row["labels"] != "") and row["text"] == text


def test_matching_statistics(monkeypatch):
    """Fragments are the longest runs that cannot go on, with all their places in the templates."""
    rnd = random.Random(8)
    seen = []

    class Recorder(licences.Chains):
        def add(self, stop, length, ends):
            seen.append((stop, length, sorted(ends)))
            super().add(stop, length, ends)

    monkeypatch.setattr(licences, "Chains", Recorder)
    templates = [(f"l{i}", " ".join(rnd.choice("abcd") for _ in range(rnd.randrange(1, 25)))) for i in range(12)]
    scanner = licences.Scanner(templates, {"a b": "x"})
    lists = [t.split() for _, t in templates] + [["a", "b"]]

    def ends_of(run):
        return [(n, e) for n, t in enumerate(lists) for e in range(len(run), len(t) + 1) if t[e - len(run) : e] == run]

    for _ in range(40):
        told = [rnd.choice("aabbccdde") for _ in range(rnd.randrange(0, 60))]
        seen.clear()
        scanner.scan(" ".join(told).encode())
        want, longest = [], [0] * (len(told) + 1)
        for i in range(1, len(told) + 1):
            longest[i] = max((n for n in range(1, i + 1) if ends_of(told[i - n : i])), default=0)
        for i in range(1, len(told) + 1):
            if longest[i] >= licences.LEAST_RUN and (i == len(told) or longest[i + 1] <= longest[i]):
                want.append((i, longest[i], sorted(ends_of(told[i - longest[i] : i]))))
        assert seen == want


@pytest.mark.parametrize("number", range(len(licences.TEMPLATES)))
def test_templates_are_found(number):
    """Whole, and the long ones also with every twelfth word another and a line put in."""
    label, text = licences.TEMPLATES[number]
    scanner = licences.scanner()
    told = text.split()
    for changed in [told] + [["x" if i % 12 == 5 else w for i, w in enumerate(told)]] * (len(told) > 24):
        whole = f"Some words before. {' '.join(changed[:9])} {'Copyright Someone' if len(told) > 24 else ''} {' '.join(changed[9:])} and after"
        found = licences.verdict(whole.encode())
        assert label in found[5].split(",") and found[6] >= licences.SHARE
        size = scanner.sizes[number]
        span = max(found[7], key=lambda s: s["after_word"] - s["first_word"])
        assert span["first_word"] >= 3 and span["after_word"] - span["first_word"] <= size + 2


def test_other_texts_are_left_alone():
    assert licences.verdict(b"the software is provided to you by the license office, and the public may use it freely")[5] == ""
    assert licences.verdict(b"gnu general public, license. GNU-General-Public-License")[:6] == (8, 2, 0, 4, "gpl", "gpl")


def test_lesser_licence_is_not_the_general_one():
    lesser = dict((label, text) for label, text in licences.TEMPLATES if len(text) > 300)["lgpl"]
    assert licences.verdict(lesser.encode())[5] == "lgpl"


def test_long_text_and_chunks(monkeypatch):
    """A text in many chunks, words across their borders, repeated notices."""
    text = ("Ünder the MIT License, ABCDEFGHIJ " * 3000).encode()
    whole = licences.verdict(text)
    assert whole[:6] == (15000, 3000, 2, 14997, "mit", "mit")
    monkeypatch.setattr(licences, "CHUNK", 7)
    assert licences.verdict(text[:40_000] + b"x" * 100) == (lambda t: (monkeypatch.setattr(licences, "CHUNK", 1 << 20), licences.verdict(t))[1])(
        text[:40_000] + b"x" * 100
    )
    spans = licences.verdict(b"licensed under the mit license " * 5000)[7]
    assert len(spans) == 5000 and spans[-1]["after_word"] == 25_000


def test_clashing_names_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "mit license", "a", "b", "c", "d")], "doc_id long, text string, LABELS string, _text string, _0 string, `x.y` string")
    row = licences.scan_licences(df).first().asDict()
    assert row["labels"] == "mit" and (row["_text"], row["_0"], row["x.y"]) == ("b", "c", "d") and "LABELS" not in row
    assert licences.scan_licences(df.limit(0)).count() == 0
    assert licences.scan_licences(df.select("text"), keep_text=False).select("n_base").first()[0] == 1
    twice = df.unionByName(df).withColumn("text", F.col("text"))
    assert twice.count() == licences.scan_licences(twice).count() == 2
