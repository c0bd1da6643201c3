import re
import time

import pytest

from tests.llm.frames import awkward, none
from vacanta.llm import license_scan as scan
from vacanta.llm.queries import op8_license_scan

SCANNER = scan.Scanner()


def base(text):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    places, labels = [], set()
    for phrase, label in scan.PHRASES:
        want = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(want)] == want:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


CASES = [
    "", "cc by", "CC-BY cc by, cc BY-nc", "cc by cc by", "xcc by ccby", "All Rights\nReserved.", "all rights reservedly",
    "GNU General Public License, general public license", "Licensed under CC BY-NC 4.0.", "ccé by", "a1 2b ü",
]


@pytest.mark.parametrize("text", CASES)
def test_base_against_brute_force(text):
    got = SCANNER.scan(text)
    assert (got["n_words"], got["n_base"], got["first_word"], got["last_word"], got["base_labels"]) == base(text)


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("Released under the MIT License.", "mit"),
        ("Licensed under the Apache License, Version 2.0.", "apache-2.0"),
        ("Licenced undr the Apache Licence, Version 2.0.", "apache-2.0"),
        ("This work is licensed under the GNU General Public License, version 3.", "gpl,gpl-3.0"),
        ("is licensed under the GNU General Public Lisense version 2", "gpl-2.0"),
        ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc-4.0"),
        ("Permission is hereby granted, free of charges, to any persons obtaining a copy", "mit"),
        ("the license of the driver", ""), ("released under pressure", ""),
    ],
)
def test_notices_with_edits(text, labels):
    assert SCANNER.scan("some words first. " + text + " and more")["labels"] == labels


def test_every_notice_is_found_with_all_the_edits_it_may_have():
    for label, words in scan.NOTICES:
        edits = len(words) // scan.EDITS_PER
        step = len(words) // (edits + 1)
        spoiled = list(words)
        for k in range(edits):  # one edit in every piece but the last
            spoiled[k * step + step // 2] = "q"
        text = "".join(spoiled)
        assert any(f.edits <= edits for f in SCANNER.fuzzy(f"zz {text} zz")), (label, text)


def test_spans():
    found = SCANNER.scan("one two released under the mit license three")["notices"]
    assert found == [{"label": "mit", "first_word": 2, "last_word": 6, "edits": 0}]


def test_awkward_rows(spark):
    docs = awkward(spark).withColumnRenamed("shard", "labels")
    got = scan.scan_licenses(docs)
    assert got.columns == [c for c in docs.columns if c not in scan.COLUMNS] + scan.COLUMNS
    rows = got.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == base(r["text"])
        assert r["labels"] == "" and r["score"] == 0
    assert scan.scan_licenses(none(spark)).count() == 0


def test_query(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in op8_license_scan(spark, sf_dir).collect():
        want = base(texts[r["doc_id"]])
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == want
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("licensed under cc by 3 0", "cc-by,cc-by-3.0"), ("licensed under cc by sa 3 0", "cc-by,cc-by-sa-3.0"),
        ("licensed under cc by nd 2 0", "cc-by,cc-by-nd-2.0"), ("licenced under cc by 5 0", "cc-by"),
        ("licensed under the gnu general public license version 1", "gpl,gpl-1.0"),
        ("licensed under the apache license version 1 1", "apache-1.1"),
        ("licensed under the apache license version 3 0", ""), ("released under the bit license", ""),
        ("releasd under the mit licence", "mit"), ("licensed under the gnu lesser general public license", "gpl,lgpl"),
    ],
)
def test_versions_and_names_are_not_edited(text, labels):
    assert SCANNER.scan("some words " + text + " and more words")["labels"] == labels


def test_many_phrases_take_linear_time():
    started = time.perf_counter()
    got = SCANNER.scan("cc by " * 80_000)
    assert (got["n_base"], got["first_word"], got["last_word"]) == (80_000, 0, 159_998)
    assert time.perf_counter() - started < 5
