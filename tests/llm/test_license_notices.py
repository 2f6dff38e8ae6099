"""The licence scan against brute force: all places of phrases, and bounded-error matching over whole texts."""

import random
import re

import pytest

from threadlens.llm import license_notices, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ODD = [
    None, "", " \n", "MIT License", "mit license mit license", "mit-license, the MIT\nLicence", "x" * 5000, "GNU  General\tPublic License", "gnu general public licenseİ",
    "CC BY cc by CC-BY-NC ccby", "Licensed under the Apache License, Version 2.0. Apache License", "İ MIT LİCENSE mit license", "日本語 apache license 日本語", "All rights reserved.", "apache apache license license",
]


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def base_of(text):
    words = WORD.findall(lowered(text))
    hits = [(i, label) for label, phrase in license_notices.PHRASES for p in [phrase.split()] for i in range(len(words)) if words[i : i + len(p)] == p]
    starts, labels = [i for i, _ in hits], sorted({label for _, label in hits})
    return len(words), len(hits), min(starts, default=None), max(starts, default=None), ",".join(labels)


def rows_of(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in df.collect()), key=str)


def test_base_columns(spark):
    texts = [(i, t) for i, t in enumerate(ODD)] + [(3, ODD[3]), (None, "mit license")] + [(99, "word " * 60_000 + "apache license " * 2000)]
    df = spark.createDataFrame([(i, t, "l", 1) for i, t in texts], "doc_id long, text string, labels string, score int")
    got = license_notices.scan_licenses(df)
    assert rows_of(got) == sorted(((i, *base_of(t)) for i, t in texts), key=str)
    assert all(set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1 for r in got.collect())
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert rows_of(queries.op13_license_notices(spark, SF)) == sorted(((r["doc_id"], *base_of(r["text"])) for r in docs.collect()), key=str)
    assert license_notices.scan_licenses(df.limit(0)).collect() == []


def edited(rng, text, edits):
    letters = list(text)
    for _ in range(edits):
        at = rng.randrange(len(letters))
        kind = rng.randrange(3)
        letters[at : at + (kind != 1)] = [] if kind == 0 else [rng.choice("abcdefgh xyz")]
    return "".join(letters)


@pytest.mark.parametrize("seed", range(8))
def test_seeds_lose_nothing(seed):
    """The parts around exact pieces give the same spans as matching the whole text."""
    rng = random.Random(seed)
    finder = license_notices.scanner(license_notices.NOTICES)
    for _ in range(25):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            notice = rng.choice(finder.notices)
            parts += [" ".join(rng.choice(["license", "under", "the", "all", "zebra", "public", "qqq"]) for _ in range(rng.randrange(6))), edited(rng, notice.text, rng.randrange(notice.edits + 2))]
        text = " ".join(parts)
        assert license_notices.scan_text(text, license_notices.PHRASES, finder) == license_notices.scan_text(text, license_notices.PHRASES, finder, whole=True)


@pytest.mark.parametrize("line, label, edits", [
    ("This work is licensed under the GNU Genral Public Licence, version 3.", "gpl", 2), ("Licenced under the Apache Lisense", "apache", 2), ("Released undr the MIT Licence", "mit", 2),
    ("All rigths reserved", None, 2), ("All right reserved", "reserved", 1), ("Released under the MPL License", None, 0), ("Redistribution and use in source and binary form, with or without modifications, are permited", "bsd", 3),
    ("public license of the general", None, 0),
])
def test_edited_notices(line, label, edits):
    text = f"Some words before. {line}. And some behind"
    *_, base, labels, score, spans = license_notices.scan_text(text, license_notices.PHRASES, license_notices.scanner(license_notices.NOTICES))
    assert base == "" and labels == (label or "") and (score > 0.85 if label else score == 0)
    if label:
        first, behind, found = map(int, spans.split(":")[1:])
        assert found == edits and first >= 3 and behind <= len(WORD.findall(lowered(text))) - 3


def test_clean_texts_stay_without_labels(spark):
    """No given document gets a label beyond its phrases but for reserved rights."""
    rows = queries.op13_license_notices(spark, SF).collect()
    assert all(set(r["labels"].split(",")) - set(r["base_labels"].split(",")) <= {"reserved"} for r in rows)


def test_long_text_of_seeds_ends(spark):
    text = "licensed under " * 8000 + "licensed undr the apache license"
    assert license_notices.scan_text(text, license_notices.PHRASES, license_notices.scanner(license_notices.NOTICES))[5] == "apache"
