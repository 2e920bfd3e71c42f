"""License scans by a positional index of rare words.

A template is a passage of a licence with the key phrases that must stand in it word for word. Of the words in its key
phrases, those with the highest IDF over all documents are posted with their positions. A document looks up only these
words: every place of one gives the offsets at which a template would lie, the offsets of a template's words are
intersected, and where they agree the key phrases are verified. A passage whose key phrases all stand is never missed,
for each of their words then stands at its own place. The share of the passage's words that stand at theirs is the score.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prepkit.llm.shared import text_of

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Runs of digits, a to z and characters beyond ASCII, once A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a template that are looked up.
ANCHORS = 3


@dataclass(frozen=True)
class Template:
    """A ``passage`` of lower-case words that stands for ``label`` where all its key phrases stand, at their distances.

    Without key phrases the whole passage is one.
    """

    label: str
    passage: str
    keys: tuple[str, ...] = ()
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.passage.split()

    @property
    def phrases(self) -> list[tuple[int, list[str]]]:
        """The key phrases, and their places in the passage."""
        words, out = self.words, []
        for key in self.keys or (self.passage,):
            phrase = key.split()
            at = next((i for i in range(len(words)) if words[i:i + len(phrase)] == phrase), None)
            if at is None or not phrase:
                raise ValueError(f"{key!r} is not part of the passage {self.passage!r}")
            out.append((at, phrase))
        return out

    @property
    def demanded(self) -> dict[int, str]:
        """The words of the key phrases by their place in the passage."""
        return {at + i: w for at, phrase in self.phrases for i, w in enumerate(phrase)}


#: The asked phrases.
BASE = (
    Template("cc-by", "cc by", base=True),
    Template("gpl", "general public license", base=True),
    Template("reserved", "all rights reserved", base=True),
)
#: Sentences of published licences and their usual notices, by SPDX-like labels.
MORE = (
    Template("agpl", "under the terms of the gnu affero general public license", ("affero general public license",)),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
             "conditions are met", ("redistribution and use in source and binary forms", "are permitted provided that")),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", ("creative commons attribution",)),
    Template("cc0", "cc0 1 0 universal public domain dedication", ("cc0 1 0 universal",)),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
             ("permission to use copy modify", "with or without fee is hereby granted")),
    Template("lgpl", "under the terms of the gnu lesser general public license", ("lesser general public license",)),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
             ("permission is hereby granted free of charge", "to any person obtaining a copy")),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2 0",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
)
TEMPLATES = BASE + MORE


def words_of(text: Column) -> Column:
    """The words of a text, A-Z lower-cased.

    Texts are lower-cased as a whole, which leaves words where they are. Only two characters beyond ASCII become
    ASCII by it, and texts with one of them are translated letter by letter.
    """
    odd = F.contains(text, F.lit("\u212a")) | F.contains(text, F.lit("\u0130"))
    return F.regexp_extract_all(F.when(odd, F.translate(text, UPPER, UPPER.lower())).otherwise(F.lower(text)), F.lit(WORD), F.lit(0))


def idf(words: DataFrame, asked: list[str]) -> dict[str, float]:
    """ln(documents / documents with the word), both plus 1, of the asked words, over all rows of ``words`` (words)."""
    held = words.select(F.explode(F.array_append(F.array_intersect("words", F.lit(asked)), F.lit(None))).alias("word"))
    n = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = n.pop(None, 0)  # each row has one null
    return {w: math.log((rows + 1) / (n.get(w, 0) + 1)) for w in asked}


def anchors_of(template: Template, weight: dict[str, float], anchors: int = ANCHORS) -> dict[str, list[int]]:
    """The template's posted words, of highest IDF, ties by code point, with their places in its key phrases."""
    places: dict[str, list[int]] = {}
    for at, word in template.demanded.items():
        places.setdefault(word, []).append(at)
    return {w: places[w] for w in sorted(places, key=lambda w: (-weight[w], w))[:anchors]}


def _matches(template: Template, postings: dict[str, list[int]]) -> Column:
    """array of (start, label, base, share): the template's places in ``words``, looked up by ``hits`` (at, word)."""
    def offsets(word: str, places: list[int]) -> Column:
        at = F.transform(F.filter("hits", lambda h: h["word"] == word), lambda h: h["at"])
        return F.flatten(F.transform(at, lambda p: F.array(*[p - k for k in places])))

    lists = [offsets(w, places) for w, places in postings.items()]
    agreed = F.array_distinct(lists[0])
    for more in lists[1:]:
        agreed = F.array_intersect(agreed, more)

    def stands(offset: Column) -> Column:
        every = F.lit(True)
        for at, phrase in template.phrases:
            first = offset + at
            every = every & F.when(first >= 0, F.slice("words", F.greatest(first, F.lit(0)) + 1, len(phrase)) == F.lit(phrase)).otherwise(False)
        return every

    def share(offset: Column) -> Column:
        there = F.filter(F.lit(template.words), lambda w, k: F.coalesce(F.get("words", offset + k) == w, F.lit(False)))
        return F.size(there) / len(template.words)

    return F.transform(F.filter(agreed, stands), lambda o: F.struct(
        (o + min(template.demanded)).alias("start"), F.lit(template.label).alias("label"), F.lit(template.base).alias("base"), share(o).alias("share")
    ))


def license_scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, anchors: int = ANCHORS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, found): every row of ``docs`` with its licence passages, an array of (start, label, base, share).

    ``start`` counts words from 0 to the first of the passage's key phrases; places are sorted, and all are listed,
    overlapping ones too. ``share`` of the passage's words stand at their distance from the key phrases. A null or empty
    text has no words. Each row is scanned by itself, whatever its id. Other columns are not read. All texts are read
    twice, first for the words' IDF; nothing but counts of the templates' words is shuffled.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), words_of(text_of(text_col)).alias("words"))
    asked = sorted({w for t in templates for w in t.demanded.values()})
    weight = idf(rows.select("words"), asked)
    postings = [anchors_of(t, weight, anchors) for t in templates]
    posted = sorted({w for p in postings for w in p})
    hits = F.array_compact(F.transform("words", lambda w, i: F.when(w.isin(posted), F.struct(i.alias("at"), w.alias("word")))))
    looked = rows.select("doc_id", "words", hits.alias("hits"))  # by itself, so that it is done once and not for each template
    found = F.array_sort(F.flatten(F.array(*[_matches(t, p) for t, p in zip(templates, postings)])))
    return looked.select("doc_id", F.size("words").cast("long").alias("n_words"), F.when(F.size("hits") > 0, found).alias("found"))


def license_digests(docs: DataFrame) -> DataFrame:
    """Counts, first and last places and labels of the asked phrases, all labels, and the best share, for each document."""
    base = F.filter("found", lambda m: m["base"])

    def labels(of: Column) -> Column:
        return F.coalesce(F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda m: m["label"]))), ","), F.lit(""))

    return license_scan(docs).select(
        "doc_id", "n_words", F.coalesce(F.size(base), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda m: m["start"])).cast("long").alias("first_word"),
        F.array_max(F.transform(base, lambda m: m["start"])).cast("long").alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("found")).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda m: m["share"])), F.lit(0.0)).alias("score"),
    )
