"""Licence scan by a positional index of rare licence words.

Every licence passage is a sequence of words with its mandatory key phrases.
How many documents hold each of its words is counted over the whole corpus; a
file looks up its rarest words of a passage first. Each place of such a word in
the file, less the word's place in the passage, says where the passage would
start; starts that enough words agree on are compared word by word, and stand
if the share of equal words reaches the threshold and each key phrase is in
its place.

Nothing is lost by looking only at rare words: a passage of ``L`` words that
reaches the threshold has at most ``m = L - ceil(threshold * L)`` wrong places,
so of any ``m + k`` of its words that the file holds at least ``k`` are right.

Array functions do all of it inside the row; only the word counts are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bind

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
THRESHOLD = 0.8
VOTES = 2


class Passage(NamedTuple):
    label: str
    text: str
    key_phrases: tuple[str, ...]


# The phrases of the contract and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Passages of public licences and common notices, as lower-case words.
PASSAGES = [
    Passage("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the software to deal in the software without restriction including "
            "without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies "
            "of the software and to permit persons to whom the software is furnished to do so",
            ("permission is hereby granted free of charge", "without restriction")),
    Passage("mit", "released under the mit license", ("mit license",)),
    Passage("apache", "licensed under the apache license version 2 0 the license you may not use this file except in "
            "compliance with the license you may obtain a copy of the license at", ("apache license version 2 0",)),
    Passage("apache-2.0", "licensed under the apache license version 2 0", ("apache license", "version 2 0")),
    Passage("gpl", "is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation either version",
            ("gnu general public license", "free software foundation")),
    Passage("gpl-3.0", "licensed under the gnu general public license version 3",
            ("general public license", "version 3")),
    Passage("lgpl", "is free software you can redistribute it and or modify it under the terms of the gnu lesser "
            "general public license as published by the free software foundation either version",
            ("gnu lesser general public license",)),
    Passage("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
            "provided that the following conditions are met redistributions of source code must retain the above "
            "copyright notice this list of conditions and the following disclaimer",
            ("redistribution and use in source and binary forms",)),
    Passage("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be used "
            "to endorse or promote products derived from this software without specific prior written permission",
            ("endorse or promote products",)),
    Passage("isc", "permission to use copy modify and or distribute this software for any purpose with or without "
            "fee is hereby granted provided that the above copyright notice and this permission notice appear in all "
            "copies", ("distribute this software for any purpose",)),
    Passage("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy "
            "of the mpl was not distributed with this file you can obtain one at", ("mozilla public license",)),
    Passage("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy of "
            "the software and accompanying documentation covered by this license the software to use reproduce "
            "display distribute execute and transmit the software", ("person or organization obtaining a copy",)),
    Passage("zlib", "this software is provided as is without any express or implied warranty in no event will the "
            "authors be held liable for any damages arising from the use of this software",
            ("in no event will the authors be held liable",)),
    Passage("unlicense", "this is free and unencumbered software released into the public domain anyone is free to "
            "copy modify publish use compile sell or distribute this software",
            ("unencumbered software", "public domain")),
    Passage("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Passage("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license",
            ("creative commons attribution noncommercial",)),
    Passage("cc-by", "licensed under cc by 4 0", ("cc by 4",)),
    Passage("cc-by", "licensed under a creative commons attribution 4 0 international license",
            ("creative commons attribution 4",)),
]


def words_of(text: Column) -> Column:
    """Words: runs of digits, letters a-z and characters beyond ASCII, A-Z lower-cased."""
    # lower() is the same on pure ASCII and much faster than translate().
    ascii_only = F.octet_length(text) == F.char_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.filter(F.split(lowered, NOT_WORD, -1), lambda w: w != "")


def _literal(words: Sequence[str]) -> Column:
    return F.split(F.lit(" ".join(words)), " ")


def key_places(words: Sequence[str], phrases: Sequence[str]) -> list[int]:
    """Places in a passage that its key phrases (first occurrence) take."""
    places: set[int] = set()
    for phrase in phrases:
        key = phrase.split()
        start = next(i for i in range(len(words)) if list(words[i:i + len(key)]) == key)
        places.update(range(start, start + len(key)))
    return sorted(places)


def least_hits(n: int, threshold: float = THRESHOLD) -> int:
    """Fewest equal words of ``n`` that reach the threshold."""
    return next(h for h in range(n + 1) if h >= threshold * n - 1e-9)


def word_counts(docs: DataFrame, vocabulary: Sequence[str]) -> dict[str, int]:
    """In how many rows of ``docs`` each word of the vocabulary stands. The
    driver gets at most one row per word of the vocabulary."""
    held = F.array_intersect(_literal(vocabulary), words_of(F.coalesce("text", F.lit(""))))
    counts = docs.select(F.explode(held).alias("word")).groupBy("word").count()
    return {r["word"]: r["count"] for r in counts.collect()}


def phrase_places(words: Column, phrases: dict[str, str]) -> Column:
    """Every place where the words of a phrase stand consecutively, as structs
    of ``start`` (from 0) and ``label``, in order of place."""
    def at(word: Column, i: Column, phrase: str) -> Column:
        first, *rest = phrase.split()
        same = word == first
        for k, w in enumerate(rest, 1):
            same = same & (F.get(words, i + k) == w)
        return same

    def found(word: Column, i: Column) -> Column:
        labels = [F.when(at(word, i, phrase), F.struct(i.alias("start"), F.lit(label).alias("label")))
                  for phrase, label in phrases.items()]
        return F.when(word.isin([phrase.split()[0] for phrase in phrases]), F.array_compact(F.array(*labels)))

    return F.flatten(F.array_compact(F.transform(words, found)))


def passage_index(passages: Sequence[Passage], rarity: dict[str, int], threshold: float = THRESHOLD) -> Column:
    """The passages as one constant array of structs: ``label``, ``words``, ``keys``
    (places of the key phrases), ``rarest`` (distinct words, rarest first) and
    ``hits`` (fewest equal words)."""
    def spaced(values: Sequence) -> Column:
        return F.split(F.lit(" ".join(map(str, values))), " ")

    def entry(passage: Passage) -> Column:
        own = passage.text.split()
        return F.struct(
            F.lit(passage.label).alias("label"), spaced(own).alias("words"),
            spaced(key_places(own, passage.key_phrases)).cast("array<int>").alias("keys"),
            spaced(sorted(set(own), key=lambda w: (rarity[w], w))).alias("rarest"),
            F.lit(least_hits(len(own), threshold)).alias("hits"))

    return F.array(*[entry(passage) for passage in passages])


def passage_places(words: Column, held: Column, passage: Column, votes: int = VOTES) -> Column:
    """Where the passage (an entry of the index) stands in ``words``, as structs
    of ``start, label, share``. ``held`` is the file's part of the vocabulary."""
    own, wrong = passage["words"], F.size(passage["words"]) - passage["hits"]

    def starts_of(probes: Column, needed: Column) -> Column:
        spots = F.array_compact(F.transform(words, lambda w, i: F.when(
            F.array_contains(probes, w), F.struct(i.alias("i"), w.alias("w")))))
        starts = F.flatten(F.transform(spots, lambda s: F.array_compact(F.transform(
            own, lambda w, place: F.when(w == s["w"], s["i"] - place)))))
        return bind(F.array_sort(starts), lambda ordered: F.array_distinct(F.filter(
            ordered, lambda start, i: F.get(ordered, i + needed - 1) == start)))

    def compared(start: Column) -> Column:
        keyed = F.forall(passage["keys"], lambda place: F.coalesce(
            F.get(words, start + place) == F.get(own, place), F.lit(False)))
        same = F.size(F.filter(own, lambda w, place: F.get(words, start + place) == w))
        return F.when(keyed, bind(same, lambda n: F.when(n >= passage["hits"], F.struct(
            start.alias("start"), passage["label"].alias("label"), (n / F.size(own)).alias("share")))))

    def search(present: Column) -> Column:
        # The words the file lacks are wrong places already.
        missing = F.size(passage["rarest"]) - F.size(present)
        probes = F.slice(present, F.lit(1), wrong + votes)
        return F.when(missing <= wrong, bind(probes, lambda looked_up: F.array_compact(F.transform(
            starts_of(looked_up, F.greatest(F.lit(1), F.size(looked_up) - wrong + missing)), compared))))

    return bind(F.array_intersect(passage["rarest"], held), search)


def scan_licenses(docs: DataFrame, phrases: dict[str, str] = PHRASES, passages: Sequence[Passage] = PASSAGES,
                  threshold: float = THRESHOLD) -> DataFrame:
    """For each row of ``docs`` (``doc_id, text``): ``doc_id, n_words``,
    ``phrases`` (every place of a phrase: ``start, label``) and ``passages`` (every
    place where a passage stands with at least ``threshold`` of its words and all
    of its key phrases: ``start, label, share``); words count from 0.

    The result depends on the row's text alone: corpus counts only order the
    look-ups. A null text counts as empty and holds nothing; repeated rows and
    ids are scanned each; places overlap freely. An empty table gives an empty
    result. Other columns are not read.
    """
    vocabulary = sorted({w for passage in passages for w in passage.text.split()})
    counts = word_counts(docs, vocabulary)
    ranked = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
    rarity = {w: i for i, w in enumerate(ranked)}

    index = passage_index(passages, rarity, threshold)

    def scanned(words: Column) -> Column:
        found = bind(F.array_intersect(_literal(vocabulary), words), lambda held: F.flatten(F.array_compact(
            F.transform(index, lambda passage: passage_places(words, held, passage)))))
        return F.struct(F.size(words).cast("bigint").alias("n_words"),
                        phrase_places(words, phrases).alias("phrases"), found.alias("passages"))

    scan = bind(words_of(F.coalesce("text", F.lit(""))), scanned)
    return docs.select("doc_id", scan.alias("scan")).select("doc_id", "scan.*")
