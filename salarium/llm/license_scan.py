"""Licence scan: a trained classifier of word windows, confirmed by templates (DataFrame
operations only).

A text is read as one sequence of words, so wrapped lines are joined and comment marks fall
away. It is classified in overlapping windows of ``WINDOW`` words, each starting half a
window after the last, so that every notice of up to half a window is whole in one of them.
The classifier is a multinomial logistic regression over word n-grams (single words and
pairs) into licence families or the class "unknown". It is trained on the templates of each
family, varied by leaving words out and by putting other words of the corpus around them,
and on a bounded sample of the corpus's own windows as unknown. L1 keeps few n-grams; only
those are looked up, by one broadcast join whose size the templates bound. A window without
any of them has the intercepts' class, unknown, and drops out before the only shuffle.

The probabilities are calibrated on a part of the training rows that the fit doesn't see
(one temperature, by least log loss). A window stands if its probability of not being
unknown is ``min_probability`` or more. The templates of every family are then compared with
it, so that a window with several notices gives each of them: around each place that holds a
template's key words, the share of the template's words that come in the same order (longest
common subsequence) must be ``similarity`` or more. Other words may stand in between.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salarium.llm.decontaminate import words_of
from salarium.llm.tables import column, configure, stored, text_of

UNKNOWN = "unknown"
WINDOW, STEP = 128, 64
LONGEST = 48  # words of a template; with 6 more on each side its bits fit one long

# Usual wordings of licence notices. Words in braces are a template's key words:
# each run of them must be in the text as it is, the others may change.
_TEXTS = {
    "agpl-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the {GNU Affero General Public License} as published by the Free Software Foundation, either {version 3} of the License",
    ],
    "apache-2.0": [
        "Licensed under the {Apache} License, Version {2.0}.",
        'Licensed under the {Apache} License, Version {2.0} (the "License"); you may not use this file except in compliance with the License.',
    ],
    "bsd": [
        "Released under the {BSD} License.",
        "{Redistribution and use in source and binary forms}, with or without modification, are permitted provided that the following conditions are met",
    ],
    "cc-by-4.0": [
        "Licensed under {CC BY 4.0}.",
        "This work is licensed under a {Creative Commons Attribution 4.0} International License.",
    ],
    "cc-by-nc-4.0": [
        "Licensed under {CC BY-NC 4.0}.",
        "This work is licensed under a {Creative Commons Attribution-NonCommercial 4.0} International License.",
    ],
    "cc0-1.0": [
        "To the extent possible under law, the author has {waived all copyright and related or neighboring rights} to this work",
    ],
    "gpl-2.0": [
        "This work is licensed under the {GNU General Public License}, {version 2}.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the {GNU General Public License} as published by the Free Software Foundation; either {version 2} of the License",
    ],
    "gpl-3.0": [
        "This work is licensed under the {GNU General Public License}, {version 3}.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the {GNU General Public License} as published by the Free Software Foundation, either {version 3} of the License",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or {distribute this software for any purpose} with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    ],
    "lgpl-2.1": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the {GNU Lesser General Public License} as published by the Free Software Foundation; either {version 2.1} of the License",
    ],
    "lgpl-3.0": [
        "This library is free software: you can redistribute it and/or modify it under the terms of the {GNU Lesser General Public License} as published by the Free Software Foundation, either {version 3} of the License",
    ],
    "mit": [
        "Released under the {MIT} License.",
        "Permission is {hereby granted, free of charge}, to any person obtaining a copy of this software and associated documentation files",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the {Mozilla Public License}, v. {2.0}.",
        "Licensed under the {Mozilla Public License}, Version {2.0}.",
    ],
    "unlicense": [
        "This is {free and unencumbered software} released into the public domain",
    ],
}
# names that are a notice wherever they stand
_NAMES = {
    "agpl-3.0": ["GNU Affero General Public License, version 3", "GNU Affero General Public License v3", "AGPL version 3"],
    "apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache License v2.0", "Apache 2.0 License", "Apache Software License 2.0"],
    "bsd": ["BSD License", "BSD 2-Clause", "BSD 3-Clause", "2-Clause BSD", "3-Clause BSD"],
    "cc0-1.0": ["CC0 1.0 Universal", "Creative Commons Zero"],
    "epl-1.0": ["Eclipse Public License 1.0", "Eclipse Public License v1.0", "Eclipse Public License, version 1.0"],
    "epl-2.0": ["Eclipse Public License 2.0", "Eclipse Public License v2.0", "Eclipse Public License, version 2.0", "Eclipse Public License v. 2.0"],
    "gpl-2.0": ["GNU General Public License, version 2", "GNU General Public License v2", "GPL version 2"],
    "gpl-3.0": ["GNU General Public License, version 3", "GNU General Public License v3", "GPL version 3"],
    "isc": ["ISC License"],
    "lgpl-2.1": ["GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1", "LGPL version 2.1"],
    "lgpl-3.0": ["GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3", "LGPL version 3"],
    "mit": ["MIT License"],
    "mpl-2.0": ["Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "Mozilla Public License, v. 2.0", "Mozilla Public License v2.0"],
}
# short names and SPDX identifiers: notices only with "licensed under", "license:" or the like
_SHORT = {
    "agpl-3.0": ["AGPL-3.0", "AGPLv3"],
    "apache-2.0": ["Apache-2.0"],
    "bsd": ["BSD-2-Clause", "BSD-3-Clause"],
    "cc0-1.0": ["CC0-1.0", "CC0"],
    "epl-1.0": ["EPL-1.0"],
    "epl-2.0": ["EPL-2.0"],
    "gpl-2.0": ["GPL-2.0", "GPLv2", "GPL v2"],
    "gpl-3.0": ["GPL-3.0", "GPLv3", "GPL v3"],
    "isc": ["ISC"],
    "lgpl-2.1": ["LGPL-2.1", "LGPLv2.1"],
    "lgpl-3.0": ["LGPL-3.0", "LGPLv3"],
    "mit": ["MIT"],
    "mpl-2.0": ["MPL-2.0"],
    "unlicense": ["Unlicense"],
}
for _code, _name in [("BY", ""), ("BY-NC", "-NonCommercial"), ("BY-ND", "-NoDerivatives"), ("BY-SA", "-ShareAlike"),
                     ("BY-NC-ND", "-NonCommercial-NoDerivatives"), ("BY-NC-SA", "-NonCommercial-ShareAlike")]:
    _NAMES[f"cc-{_code.lower()}-4.0"] = [f"Creative Commons Attribution{_name} 4.0", f"CC {_code} 4.0"]
    _SHORT[f"cc-{_code.lower()}-4.0"] = [f"CC-{_code}-4.0"]
_AROUND = ["Licensed under {%s}", "Released under {%s}", "under the terms of {%s}", "License: {%s}", "{SPDX-License-Identifier}: {%s}"]

TEMPLATES = {
    f: [*_TEXTS.get(f, []), *["{%s}" % n for n in _NAMES.get(f, [])], *[a % n for n in _SHORT.get(f, []) for a in _AROUND]]
    for f in sorted({*_TEXTS, *_NAMES, *_SHORT})
}
# Notices that grant no licence.
RESERVED = {"all-rights-reserved": ["{All rights reserved}.", "{All rights are reserved}."]}
# Licence words that are no licence.
NEAR_MISSES = [
    "The driver lost his license and the license plate was found under the bridge.",
    "Use of this work is subject to the permission of the author.",
    "Version 3 of the program was released under pressure.",
    "The general public may use the free software without charge.",
    "He was licensed to work in the state as a public accountant.",
    "All rooms are reserved and the rights of all guests are listed at the door.",
]


def notice_words(text: Column) -> Column:
    """Lower-cased words in order, in one spelling of license."""
    return words_of(F.replace(F.lower(text), F.lit("licence"), F.lit("license")))


def grams_of(words: str) -> Column:
    """Single words and pairs, each once."""
    firsts = F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0)))
    pairs = F.transform(firsts, lambda word, i: F.concat_ws(" ", word, F.get(words, i + 1)))
    return F.array_distinct(F.concat(F.col(words), pairs))


def texts(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """(id, doc_key, text) of each document."""
    read = docs.select(column(docs, id_col).alias("id"), text_of(docs, text_col).alias("text"))
    return read.select("id", F.xxhash64("text").alias("doc_key"), "text")


def paragraphs(docs: DataFrame, text_col: str, id_col: str, only: list[str] | None = None) -> DataFrame:
    """(id, doc_key, pos, word, next) of each word, or of each that is in ``only``; words are
    numbered from 0 over the text."""
    words = texts(docs, text_col, id_col).select("id", "doc_key", notice_words(F.col("text")).alias("words"))
    places = F.slice(F.sequence(F.lit(0), F.size("words")), 1, F.size("words"))
    if only is not None:  # before the explode, which costs far more than a look into a set
        places = F.filter(places, lambda i: F.get("words", i).isin(only))
    pairs = F.transform(places, lambda i: F.struct(i.alias("pos"), F.get("words", i).alias("word"), F.get("words", i + 1).alias("next")))
    # outer: for a plain explode Spark adds a filter on the array's size, with the words' pattern inside its loop
    return words.select("id", "doc_key", F.explode_outer(pairs).alias("pair")).select("id", "doc_key", "pair.*")


def _plain(text: str) -> list[str]:
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def _templates(spark: SparkSession, templates: dict[str, list[str]]) -> DataFrame:
    """(family, words, keys: padded runs of key words, key: words of the first run, at: its
    place in the template, slack: words that may come in on either side)."""
    rows = []
    for family, text in [(f, t) for f, ts in sorted(templates.items()) for t in ts]:
        words = _plain(text)
        if not words or len(words) > LONGEST:
            raise ValueError(f"a template needs 1 to {LONGEST} words: {text}")
        # without braces: the whole of a short template, the longest word of others
        keys = [_plain(k) for k in re.findall(r"\{([^}]*)\}", text)] or [words if len(words) < 5 else [max(words, key=len)]]
        at = next(i for i in range(len(words)) if words[i:i + len(keys[0])] == keys[0])
        rows.append((family, words, [f" {' '.join(k)} " for k in keys], keys[0], at, 6 if len(keys) > 1 else min(6, len(words) // 2)))
    return spark.createDataFrame(
        rows, "family string, words array<string>, keys array<string>, key array<string>, at int, slack int")


def _training_rows(sample: DataFrame, templates: DataFrame, misses: DataFrame) -> DataFrame:
    """(family, words, part): templates varied, near misses and the corpus's windows."""
    around = sample.select(F.slice("words", 1, 40).alias("other"), F.pmod("order", F.lit(40)).cast("int").alias("slot")).groupBy("slot").agg(
        F.min("other").alias("other"))
    # each word of a longer template left out once, every template in 13 of 40 surroundings, and as it is
    gone = templates.select("family", "words", F.explode(F.sequence(F.lit(0), F.when(F.size("words") > 3, F.size("words")).otherwise(0))).alias("gone"))
    gone = gone.select("family", F.concat(F.slice("words", 1, F.greatest(F.col("gone") - 1, F.lit(0))), F.expr(
        "slice(words, gone + 1, greatest(size(words) - gone, 0))")).alias("words"))
    slots = templates.select("family", "words", F.explode(F.sequence(F.lit(0), F.lit(39))).alias("slot")).where(
        F.pmod(F.xxhash64("words") + F.col("slot"), F.lit(3)) == 0).join(F.broadcast(around), "slot")
    first, last = F.concat("words", "other"), F.concat("other", "words")
    placed = slots.select("family", F.when(F.col("slot") % 3 == 0, first).when(F.col("slot") % 3 == 1, last).otherwise(
        F.concat("other", "words", "other")).alias("words"))
    known = gone.unionByName(placed)
    rows = known.unionByName(sample.select(F.lit(UNKNOWN).alias("family"), "words")).unionByName(
        misses.select(F.lit(UNKNOWN).alias("family"), "words"))
    return rows.where(F.size("words") > 0).withColumn("part", F.pmod(F.xxhash64("words", "family"), F.lit(4)))


def _sample(read: DataFrame, templates: DataFrame, sample_rows: int) -> DataFrame:
    """(words, order) of different windows of the corpus."""
    # the corpus's own windows, but none that holds a template
    # (of every m-th different text by hash, so that the tasks pass on a number of rows that
    # doesn't grow; copies go before the limit, so that they take no place of the sample)
    n_texts = read.agg(F.approx_count_distinct("doc_key")).first()[0]
    every = max(1, n_texts // (4 * sample_rows))
    some = read.where(F.pmod("doc_key", F.lit(every)) == 0).groupBy("doc_key").agg(F.first("text").alias("text"))
    some = some.select(notice_words(F.col("text")).alias("words"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)), F.lit(STEP))
    stream = some.select(F.explode_outer(F.transform(starts, lambda i: F.slice("words", i + 1, WINDOW))).alias("words"))
    stream = stream.where(F.size("words") > 0).select("words", F.xxhash64("words").alias("order"))
    sample = stored(stream.distinct().orderBy("order").limit(sample_rows), "license-windows")
    holding = _places(sample, templates.select(F.col("words").alias("wording")), "wording").select("words").distinct()
    return sample.join(holding, "words", "left_anti")


def _places(windows: DataFrame, wordings: DataFrame, wording: str) -> DataFrame:
    """The windows with each row of ``wordings`` that stands in their ``words``, and its
    ``place``, from 1. A wording is looked up by its first word, at the places of such words only."""
    first = F.element_at(wording, 1)
    firsts = sorted(r[0] for r in wordings.select(first).distinct().collect())  # bounded by the templates
    at = F.filter(F.sequence(F.lit(1), F.size("words")), lambda p: F.element_at("words", p).isin(firsts))
    begun = windows.where(F.size("words") > 0).select("*", F.explode(at).alias("place"))
    found = begun.join(F.broadcast(wordings), F.element_at("words", F.col("place")) == first)
    return found.where(F.slice("words", F.col("place"), F.size(wording)) == F.col(wording))


def train(read: DataFrame, templates: DataFrame, sample_rows: int = 3_000) -> tuple[list[str], list[tuple[str, list[float]]], list[float], float]:
    """(classes, weights (gram, one weight for each class), intercepts, temperature)."""
    spark = read.sparkSession
    misses = spark.createDataFrame([(t,) for t in NEAR_MISSES], "text string").select(words_of(F.col("text")).alias("words"))
    sample = stored(_sample(read, templates, sample_rows), "license-sample")
    rows = stored(_training_rows(sample, templates, misses).withColumn("grams", grams_of("words")), "license-rows")

    # n-grams of the templates and near misses, without words that are common in the corpus
    n_sample = max(1, sample.count())
    common = sample.select(F.explode(F.array_distinct("words")).alias("gram")).groupBy("gram").count().where(F.col("count") > 0.01 * n_sample)
    own = templates.select("words").unionByName(misses).select(F.explode(grams_of("words")).alias("gram")).distinct()
    vocabulary = sorted(r["gram"] for r in own.join(common, "gram", "left_anti").collect())  # bounded by the templates
    classes = sorted({r["family"] for r in templates.select("family").distinct().collect()} | {UNKNOWN})
    label = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("family")).cast("double") - 1
    # sparse vectors: each row's own n-grams are looked up in the vocabulary's index
    sparse = CountVectorizerModel.from_vocabulary(vocabulary, "grams", "features").setBinary(True)
    data = stored(sparse.transform(rows).select("part", label.alias("label"), "features"), "license-grams")
    fitted = LogisticRegression(family="multinomial", regParam=3e-4, elasticNetParam=0.5, maxIter=60, standardization=False).fit(data.where("part <> 0"))
    matrix, intercepts = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()

    tested = fitted.transform(data.where("part = 0")).select("label", vector_to_array(F.col("rawPrediction")).alias("m"))
    grid = [0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0]
    loss = lambda t: F.avg(F.log(F.aggregate("m", F.lit(0.0), lambda a, x: a + F.exp((x - F.array_max("m")) / t))) + (
        F.array_max("m") - F.element_at("m", (F.col("label") + 1).cast("int"))) / t)
    losses = tested.agg(*[loss(t).alias(f"t{i}") for i, t in enumerate(grid)]).first()
    temperature = min(zip([x if x is not None else 0.0 for x in losses], grid))[1]

    used = [(g, [float(x) for x in matrix[:, i]]) for i, g in enumerate(vocabulary) if matrix[:, i].any()]
    return classes, used, [float(x) for x in intercepts], temperature


def _first_words(trained: tuple) -> list[str]:
    return sorted({gram.split(" ")[0] for gram, _ in trained[1]})


def _standing(words: DataFrame, trained: tuple, min_probability: float) -> DataFrame:
    """(id, doc_key, window, probability) of the windows that are not unknown."""
    classes, weights, intercepts, temperature = trained
    by_first: dict[str, list] = {}
    for i, (gram, w) in enumerate(weights):
        by_first.setdefault(gram.split(" ")[0], []).append((i, gram.partition(" ")[2] or None, w))
    index = words.sparkSession.createDataFrame(
        sorted(by_first.items()), "first string, grams array<struct<gram: int, second: string, w: array<double>>>")
    found = words.join(F.broadcast(index), F.col("word") == F.col("first"))
    own = F.filter("grams", lambda g: g["second"].isNull() | g["second"].eqNullSafe(F.col("next")))
    found = found.select("id", "doc_key", "pos", F.explode(own).alias("gram"))
    last = F.floor(F.col("pos") / STEP).cast("int")
    found = found.select("id", "doc_key", F.explode(F.sequence(F.greatest(last - (WINDOW // STEP - 1), F.lit(0)), last)).alias("window"), F.struct(
        "gram.gram", "gram.w").alias("gram"))
    sums = found.groupBy("id", "doc_key", "window").agg(F.collect_set("gram").alias("grams"))
    margins = F.aggregate("grams", F.array(*[F.lit(b) for b in intercepts]), lambda a, g: F.zip_with(a, g["w"], lambda x, y: x + y))
    scored = sums.select("id", "doc_key", "window", margins.alias("m")).withColumn("top", F.array_max("m"))
    part = lambda x: F.exp((x - F.col("top")) / temperature)
    probability = 1 - part(F.element_at("m", classes.index(UNKNOWN) + 1)) / F.aggregate("m", F.lit(0.0), lambda a, x: a + part(x))
    return scored.select("id", "doc_key", "window", probability.alias("probability")).where(F.col("probability") >= min_probability)


def _confirmed(read: DataFrame, standing: DataFrame, templates: DataFrame, similarity: float) -> DataFrame:
    """(id, paragraph, family, probability, similarity) of the notices in the windows."""
    marks = standing.groupBy(F.col("id").alias("m_id"), F.col("doc_key").alias("m_key")).agg(
        F.collect_list(F.struct("window", "probability")).alias("marks"))
    again = read.join(marks, F.col("id").eqNullSafe(F.col("m_id")) & (F.col("doc_key") == F.col("m_key")))
    lined = F.flatten(F.transform(F.split("text", "\n"), lambda line, i: F.transform(
        notice_words(line), lambda word: F.struct(word.alias("word"), i.alias("line")))))
    again = again.select("id", "doc_key", "marks", lined.alias("words"))
    cut = F.transform("marks", lambda m: F.struct(
        m["window"].alias("window"), m["probability"].alias("probability"), F.slice("words", m["window"] * STEP + 1, WINDOW).alias("words")))
    windows = again.select("id", "doc_key", F.explode_outer(cut).alias("cut")).select(
        "id", "doc_key", "cut.window", "cut.probability", F.col("cut.words.word").alias("words"), F.col("cut.words.line").alias("lines"))
    padded = lambda words: F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))

    known = templates.select(
        "family", F.reverse("words").alias("t_words"), "keys", "key", "at", "slack")
    pairs = _places(windows, known, "key")
    # the words around the key words, read backwards
    low = F.greatest(F.lit(1), F.col("place") - F.col("at") - F.col("slack"))
    high = F.least(F.size("words"), F.col("place") - F.col("at") + F.size("t_words") - 1 + F.col("slack"))
    pairs = pairs.withColumn("low", low).withColumn("high", high)
    pairs = pairs.withColumn("span", F.slice("words", F.col("low"), F.col("high") - F.col("low") + 1))
    pairs = pairs.withColumn("span_text", padded("span")).where(F.forall("keys", lambda k: F.contains(F.col("span_text"), k)))
    pairs = pairs.withColumn("span", F.reverse("span"))
    # longest common subsequence, a bit for each word of the span: the zeros are its steps
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    full = F.call_function("shiftleft", one, F.size("span")) - 1

    def step(v: Column, word: Column) -> Column:
        same = F.aggregate(F.transform("span", lambda x, i: F.when(x == word, F.call_function("shiftleft", one, i)).otherwise(zero)), zero, lambda a, b: a + b)
        return (v + v.bitwiseAND(same)).bitwiseOR(v.bitwiseAND(F.bitwise_not(same))).bitwiseAND(full)

    pairs = pairs.withColumn("steps", full - F.aggregate("t_words", full, step)).withColumn("same", F.bit_count("steps"))
    pairs = pairs.withColumn("similarity", F.col("same") / F.size("t_words")).where(F.col("similarity") >= similarity)
    # the last step is the notice's first word
    start = F.col("high") + 1 - F.length(F.bin("steps"))
    found = pairs.select(
        "id", "doc_key", "family", (F.col("window") * STEP + F.col("place")).alias("place"), "probability", "similarity", "same",
        F.element_at("lines", start.cast("int")).alias("line"))
    best = found.groupBy("id", "doc_key", "family", "place").agg(
        F.max("probability").alias("probability"), F.max("similarity").alias("similarity"), F.max(F.struct("same", "similarity", "line")).alias("best"))
    return best.groupBy("id", F.col("best.line").alias("paragraph"), "family").agg(
        F.max("probability").alias("probability"), F.max("similarity").alias("similarity"))


def scan(
    docs: DataFrame,
    templates: dict[str, list[str]] | None = None,
    min_probability: float = 0.5,
    similarity: float = 0.8,
    sample_rows: int = 3_000,
    text_col: str = "text",
    id_col: str = "doc_id",
) -> DataFrame:
    """One row per notice found: id, ``paragraph`` (number, from 0, of the line that it begins
    in), ``family``, ``probability`` that its window is a notice, ``similarity`` to the
    family's closest template. A line with notices of several families has a row for each.

    ``templates`` has each family's wordings, of 48 words at most, with key words in braces;
    the default is all licences, without ``RESERVED``. Null and empty texts hold no notice.
    Rows that repeat an id and a line's number are one document; null ids are ids like any
    other. Other columns are not read. An empty table gives an empty result.
    """
    configure(docs.sparkSession)
    known = stored(_templates(docs.sparkSession, templates or TEMPLATES), "license-templates")
    read = texts(docs, text_col, id_col)
    trained = train(read, known, sample_rows)
    standing = stored(_standing(paragraphs(docs, text_col, id_col, _first_words(trained)), trained, min_probability), "license-predicted")
    best = _confirmed(read, standing, known, similarity)
    return best.select(F.col("id").alias(id_col), "paragraph", "family", "probability", "similarity")
