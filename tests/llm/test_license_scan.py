import random
import re

from texts import invented, lower

from txrisk.llm import license_scan

PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def brute(text):
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    places = [(i, label) for p, label in PHRASES.items() for i in range(len(ws)) if ws[i:i + len(p.split())] == p.split()]
    at = [i for i, _ in places]
    return len(ws), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def test_base_equals_brute_force(spark):
    rng = random.Random(4)
    bits = [*PHRASES, "Under The MIT License", "mit license", "apache license", "version 2", "cc", "by", "nc", "CC-BY-NC",
            "é", "under", "the", "license.", "under the mit", "x\x7fy", "2.0"]
    rows = [(i, rng.choice([" ", "-", ". "]).join(rng.choice(bits) for _ in range(rng.randrange(14)))) for i in range(300)]
    rows.append((300, " ".join(invented(rng, 3000)) + " cc by nc " * 700 + "under the mit license"))
    got = license_scan.license_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got} == \
        {i: brute(t) for i, t in rows}
    assert all(set(r.base_labels.split(",")) <= set(r.labels.split(",")) or not r.base_labels for r in got)
    assert all(0 <= r.score <= 1 for r in got)


def test_added_labels(spark):
    bsd = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
           "the following conditions are met:")
    gap = bsd.replace("source and binary", "source code and also binary")  # a neighbouring diagonal
    rows = [(1, bsd), (2, gap), (3, bsd[:60]), (4, "This work is licensed under the GNU General Public License, version 3."),
            (5, "licensed under the GNU Lesser General Public License version 3"), (6, "general public license")]
    got = {r.doc_id: (r.labels, r.base_labels) for r in license_scan.license_digest(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: ("bsd-3", ""), 2: ("bsd-3", ""), 3: ("", ""), 4: ("gpl-3", ""), 5: ("lgpl-3", ""), 6: ("", "")}


def test_short_statements_with_words_put_in(spark):
    rows = [(1, "licensed under the terms of the GNU General Public License version 3"),
            (2, "Licensed under the terms of the GNU Lesser General Public License, version 3."),
            (3, "licensed under the GNU Affero General Public License (AGPL) version 3"),
            (4, "Copyright, all rights are hereby reserved"), (5, "under the terms of the mit license"),
            (6, "licensed under the terms of the GNU General Public License")]
    got = {r.doc_id: (r.labels, r.base_labels) for r in license_scan.license_digest(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    # 3 and 4: an end that is parted has no run of three words left, but its fragments lie next to the rest
    assert got == {1: ("gpl-3", ""), 2: ("lgpl-3", ""), 3: ("agpl-3", ""), 4: ("all-rights-reserved", ""), 5: ("", ""), 6: ("", "")}


def test_words_put_in_anywhere_in_a_short_statement(spark):
    ws = "licensed under the gnu general public license version 3".split()
    texts = [" ".join([*ws[:i], "filler", *ws[i:]]) for i in range(1, len(ws))]
    texts += ["licensed under the gnu general public license version 2", "licensed under the gnu general public license version",
              "under the gnu general public license version 3", "licensed under the gnu general public license " + "word " * 9 + "version 3",
              "licensed gnu under the version general public 3 license"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = [r.labels for r in license_scan.license_digest(docs).orderBy("doc_id").collect()]
    assert got == ["gpl-3"] * (len(ws) - 1) + [""] * 5
