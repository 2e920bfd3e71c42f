import random
import re

import pytest
from pyspark.sql import functions as F

from prepkit.llm import licenses

LOWER = str.maketrans(licenses.UPPER, licenses.UPPER.lower())
TEXTS = [
    None, "", "no licence", "Licensed under CC BY-NC 4.0.", "cc by cc BY, cc\nby", "All rights\treserved. ALL RIGHTS RESERVED",
    "This work is licensed under the GNU General Public License, version 3.", "under the terms of the GNU Lesser General Public License",
    "General-Public-License general public licenses", "Released under the MIT License.", "the mit licence", "MIT License", "License, MIT",
    "Licensed under the Apache License, Version 2.0.", "apache license version 2 1", "cc byé cc by", "\u212acc by cc \u212aby cc by", "mit \u212a free and unencumbered software cc0 1 0 universal cc by s\u212a", "L\u0130CENSE all rights reserved",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "permission is hereby granted free of charge, to some person obtaining a copy", "_cc_by_ 1cc by cc by1 cc\x7fby", "all all rights rights reserved all rights reserved",
    "Redistribution and use in source and binary forms, with or without changes, are permitted provided that",
    "漢字 all rights reserved 漢字", "general public license " * 400, "x " * 3000 + "cc by",
]


def brute(text):
    words = re.findall(licenses.WORD, (text or "").translate(LOWER))
    found = []
    for t in licenses.TEMPLATES:
        for o in range(-len(t.words), len(words)):
            here = [0 <= o + k < len(words) and words[o + k] == w for k, w in enumerate(t.words)]
            if all(here[k] for k in t.demanded):
                found.append((o + min(t.demanded), t.label, t.base, sum(here) / len(t.words)))
    base = [m for m in found if m[2]]
    places = [m[0] for m in base]
    return (
        len(words), len(base), min(places, default=None), max(places, default=None), ",".join(sorted({m[1] for m in base})),
        ",".join(sorted({m[1] for m in found})), max((m[3] for m in found), default=0.0),
    )


def test_equals_a_search_for_every_template_at_every_word(docs):
    got = licenses.license_digests(docs([(i, t, "en", "a") for i, t in enumerate(TEXTS)])).collect()
    assert len(got) == len(TEXTS)
    for r in got:
        assert tuple(r)[1:] == brute(TEXTS[r.doc_id]), TEXTS[r.doc_id]


def test_shuffled_words_of_all_templates(docs):
    rng = random.Random(2)
    pool = [t.passage for t in licenses.TEMPLATES] + [" ".join(k) for t in licenses.TEMPLATES for k in [t.words[:3], t.words[2:]]]
    texts = [" ".join(rng.choices(pool, k=12)) for _ in range(60)]
    got = licenses.license_digests(docs([(i, t, "en", "a") for i, t in enumerate(texts)])).collect()
    assert [tuple(r)[1:] for r in sorted(got)] == [brute(t) for t in texts]


@pytest.mark.parametrize("anchors", [1, 2, 9])
def test_any_number_of_anchors_finds_the_same(docs, anchors):
    frame = docs([(i, t, "en", "a") for i, t in enumerate(TEXTS)])
    few = licenses.license_scan(frame, anchors=anchors).withColumn("found", F.coalesce("found", F.array()))
    assert sorted(few.collect()) == sorted(licenses.license_scan(frame).withColumn("found", F.coalesce("found", F.array())).collect())


def test_rarest_words_are_looked_up(docs):
    rows = [(i, "license version 2 0 " + ("apache" if i == 0 else ""), "en", "a") for i in range(20)]
    words = docs(rows).select(licenses.words_of(F.col("text")).alias("words"))
    weight = licenses.idf(words, ["0", "2", "apache", "license", "version"])
    apache = next(t for t in licenses.TEMPLATES if t.label == "apache-2.0")
    assert list(licenses.anchors_of(apache, weight)) == ["apache", "0", "2"] and weight["license"] == 0


def test_odd_rows(odd, odd_rows, empty):
    got = [tuple(r) for r in licenses.license_digests(odd).collect()]
    assert sorted(got, key=str) == sorted(((i, *brute(t)) for i, t, *_ in odd_rows), key=str)
    assert licenses.license_digests(empty).collect() == []


def test_a_key_phrase_must_be_in_its_passage():
    with pytest.raises(ValueError):
        licenses.Template("x", "a b c", ("b d",)).demanded
