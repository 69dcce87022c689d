"""Licence families of paragraphs: a trained n-gram classifier in DataFrame operations.

The weights are trained once from the template texts and variations of them.
Scoring is a join of a paragraph's n-grams with the weights: no Python runs on
the executors.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gramlark.session import stage


# Well-known short notices and opening paragraphs by family.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction, including without limitation the rights to "
        "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "SPDX-License-Identifier: MIT",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "GPL-2.0": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License.",
        "SPDX-License-Identifier: GPL-2.0-only",
    ],
    "LGPL": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "BSD": [
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
}
UNKNOWN = "unknown"
# Sentences that use the words without naming a licence.
OTHER = [
    "The driver must carry a valid licence at all times.",
    "A fishing license is required and may be obtained at the office.",
    "Copyright of the photographs remains with the photographer.",
    "All rights reserved. No part may be reproduced without written permission.",
    "The software comes with a one year warranty on parts and labour.",
    "She asked permission to use the library after hours.",
    "The licence fee was paid under protest.",
    "Redistribution of wealth was the subject of the debate.",
    "Students at MIT published the results in May.",
    "The Apache helicopter flew over the valley.",
    "Mozilla held its public meeting in the spring.",
    "Er kam mit dem Zug und ging mit der Bahn nach Hause.",
    "Use of this service is subject to our terms; see the license agreement of your vendor.",
]
# The commonest function words, most frequent first; the gate spares them where it can.
COMMON = "the of and to in a is that it on be was as with by this at are or no our er der und dem an you for may not from".split()
# Fixed value: white space and comment signs around a line.
SIGNS = r"^[\s/*#;%>!|-]+|[\s/*#]+$"
WORD = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
FAMILIES = [*TEMPLATES, UNKNOWN]


def _grams(text: str) -> set[str]:
    words = re.findall(WORD, text.lower())
    return set(words) | {" ".join(p) for p in zip(words, words[1:])}


@lru_cache(maxsize=1)
def trained() -> tuple[dict[str, np.ndarray], np.ndarray, float]:
    """Weights per n-gram, the bias, and the temperature that calibrates probabilities.

    Softmax regression on n-gram presence with a ridge penalty, from variations
    of the templates (dropped words, windows, strange words around them) and the
    other sentences; a fifth of the variations is held out to fit the temperature.
    """
    rng = np.random.default_rng(23)
    rows: list[tuple[set[str], int]] = []
    own = [(t, k) for k, f in enumerate(TEMPLATES) for t in TEMPLATES[f]]
    for text, k in own + [(t, len(TEMPLATES)) for t in OTHER]:
        words = text.split()
        for turn in range(25):
            w = words
            if turn and len(w) > 8:
                at = int(rng.integers(0, len(w) // 3))
                w = w[at : at + max(6, int(len(w) * rng.uniform(0.6, 1.0)))]
            if turn:
                w = [x for x in w if rng.random() > 0.06]
            rows.append((_grams(" ".join(w)), k))
    rows += [(set(), len(TEMPLATES))] * 200
    # half the words of a notice without its name are no licence
    name = set("mit apache gnu bsd mozilla cc creative".split())
    for text, _ in own:
        grams = sorted(g for g in _grams(text) if not set(g.split()) & name)  # in an order that doesn't depend on the process
        rows += [({g for g in grams if rng.random() < 0.4}, len(TEMPLATES)) for _ in range(4)]
    # a name alone isn't one either
    rows += [({n}, len(TEMPLATES)) for n in ("mit", "apache", "gnu", "bsd", "mozilla", "cc", "creative", "license", "2.0") for _ in range(12)]
    grams = sorted(set().union(*(g for g, _ in rows)))
    index = {g: i for i, g in enumerate(grams)}
    x = np.zeros((len(rows), len(grams) + 1))
    for i, (g, _) in enumerate(rows):
        x[i, [index[a] for a in g]] = 1
    x[:, -1] = 1
    y = np.eye(len(FAMILIES))[[k for _, k in rows]]
    held = np.arange(len(rows)) % 5 == 4
    w = np.zeros((x.shape[1], len(FAMILIES)))
    v = np.ones(x.shape[1])
    for _ in range(12):  # largest curvature by power iteration
        v = x[~held].T @ (x[~held] @ v)
        v /= np.linalg.norm(v)
    look, step = w, 4.0 / (np.linalg.norm(x[~held] @ v) ** 2 / (~held).sum())
    for t in range(250):
        z = x[~held] @ look
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        g = x[~held].T @ (p - y[~held]) / (~held).sum()
        g[:-1] += 1e-4 * look[:-1]
        new = look - step * g / 2
        look, w = new + t / (t + 3) * (new - w), new
    z = x[held] @ w

    def loss(temperature: float) -> float:
        s = z / temperature
        s = s - s.max(1, keepdims=True)
        return float((np.log(np.exp(s).sum(1)) - (s * y[held]).sum(1)).mean())

    temperature = min((0.25 * 1.15**k for k in range(24)), key=loss)
    w = np.round(w / temperature, 6)
    return {g: w[i] for g, i in index.items()}, w[-1], temperature


@lru_cache(maxsize=1)
def gate() -> tuple[str, ...]:
    """Words of which every paragraph that can be found holds at least one.

    A family wins only if its n-grams outweigh the unknown class by the gap of
    the biases.  The words outside the gate are chosen, common ones first, so
    that all n-grams made of them alone stay below that gap for every family:
    the gate follows from the weights and loses nothing.
    """
    weights, bias, _ = trained()
    gap = bias[-1] - bias[:-1]
    lift = {g: np.maximum(w[:-1] - w[-1], 0) for g, w in weights.items()}
    words = {w for g in lift for w in g.split()}
    spared: set[str] = set()
    for word in [w for w in COMMON if w in words] + sorted(words - set(COMMON), key=lambda w: (len(w), w)):
        tried = spared | {word}
        reach = sum((v for g, v in lift.items() if tried.issuperset(g.split())), np.zeros(len(gap)))
        if (reach < gap - 1e-3).all():
            spared = tried
    return tuple(sorted(words - spared))


@lru_cache(maxsize=1)
def block_gate(overlap: float) -> tuple[str, ...]:
    """Words of which every run of lines that can be confirmed holds at least one.

    Of each template as many words are taken, those in most of its n-grams first
    and no common ones, that the n-grams without them are less than ``overlap``
    of it.
    """
    chosen: set[str] = set()
    for text in (t for texts in TEMPLATES.values() for t in texts):
        grams = _grams(text)
        rest = {g for g in grams if not chosen & set(g.split())}
        while len(rest) >= overlap * len(grams):
            words = sorted({w for g in rest for w in g.split()} - set(COMMON)) or sorted({w for g in rest for w in g.split()})
            chosen.add(max(words, key=lambda w: sum(w in g.split() for g in rest)))
            rest = {g for g in grams if not chosen & set(g.split())}
    return tuple(sorted(chosen))


def _literal_rows(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A small table as one literal: its scan needs no Python worker."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def model_tables(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """``(gram, weights)`` and ``(gram, template, family, size)``; bounded by the templates above."""
    weights, _, _ = trained()
    rows = [{"gram": g, "weights": [float(v) for v in w]} for g, w in weights.items()]
    first = _literal_rows(spark, rows, "gram: string, weights: array<double>")
    rows = [
        {"gram": g, "template": f"{f}/{k}", "family": f, "size": len(_grams(t))}
        for f in TEMPLATES
        for k, t in enumerate(TEMPLATES[f])
        for g in sorted(_grams(t))
    ]
    return first, _literal_rows(spark, rows, "gram: string, template: string, family: string, size: int")


def _holds(text: Column, words: tuple[str, ...]) -> Column:
    """Whether a lower-cased text holds one of ``words``; the pattern tries only those with the right first letter."""
    by_first: dict[str, list[str]] = {}
    for w in words:
        by_first.setdefault(w[0], []).append(re.sub(r"([.-])", r"\\\1", w[1:]))
    options = "|".join(f"{first}(?:{'|'.join(rest)})" for first, rest in by_first.items())
    return F.coalesce(text.rlike(f"(?<![a-z0-9])(?:{options})(?![a-z0-9])"), F.lit(False))


def _paragraphs(docs: DataFrame, column: str, overlap: float) -> DataFrame:
    """``(row, doc_id, paragraph, last, line)``: lower-cased lines (``last`` is -1) and runs of two or more lines
    that aren't blank with their first and last line number, as far as their words let them be found."""
    plain = F.split(F.lower(column), "\n")
    lines = F.transform(plain, lambda t, k: F.struct(k.alias("paragraph"), F.lit(-1).alias("last"), t.alias("line")))
    lines = F.filter(lines, lambda x: _holds(x["line"], gate()))
    text = F.lower(F.translate(column, "\x01\x02", ""))
    bare = F.transform(F.split(text, "\n"), lambda t: F.regexp_replace(t, SIGNS, ""))
    numbered = F.transform(bare, lambda t, k: F.when(t == "", "\x01").otherwise(F.concat(k.cast("string"), F.lit("\x02"), t)))
    # only runs of two numbered lines at least have a line break between them
    runs = F.filter(
        F.split(F.array_join(numbered, "\n"), "\x01"),
        lambda r: r.rlike("\x02[^\x02]*\n[0-9]+\x02") & _holds(r, block_gate(overlap)),
    )

    def block(run: Column) -> Column:
        numbers = F.regexp_extract_all(run, F.lit("([0-9]+)\x02"), F.lit(1))
        first, last = F.element_at(numbers, 1).cast("int"), F.element_at(numbers, -1).cast("int")
        return F.struct(first.alias("paragraph"), last.alias("last"), F.regexp_replace(run, "\\n?[0-9]+\x02", " ").alias("line"))

    none = F.array().cast("array<struct<paragraph:int,last:int,line:string>>")
    marks = F.col(column).contains("\x01") | F.col(column).contains("\x02")  # taken out of the text above
    wanted = _holds(F.lower(column), block_gate(overlap)) | F.coalesce(marks, F.lit(False))
    blocks = F.when(wanted, F.transform(runs, block)).otherwise(none)
    return docs.select("row", "doc_id", F.inline(F.concat(lines, blocks)))


def _one_row_a_notice(out: DataFrame) -> DataFrame:
    """Single lines and confirmed blocks, without what a block or a line says better.

    A block counts if it is confirmed and closer to its template than all its
    lines of the same family; then its lines of that family, and those that
    aren't confirmed, are parts of it.
    """
    out = stage(out, "candidates")
    lines, blocks = out.where("last < 0"), out.where("last >= 0 AND confirmed")
    inside = (F.col("l.row") == F.col("b.row")) & F.col("l.paragraph").between(F.col("b.paragraph"), F.col("b.last"))
    same = F.col("l.family") == F.col("b.family")
    better = same & (F.col("l.similarity") >= F.col("b.similarity"))
    blocks = stage(blocks.alias("b").join(lines.alias("l"), inside & better, "left_anti"), "blocks")
    lines = lines.alias("l").join(blocks.alias("b"), inside & (same | ~F.col("l.confirmed")), "left_anti")
    return lines.unionByName(blocks).drop("row", "last")


def scan(docs: DataFrame, least: float = 0.5, overlap: float = 0.6, column: str = "text") -> DataFrame:
    """``(doc_id, paragraph, family, probability, template, similarity, confirmed)``.

    One row per paragraph whose likeliest family is not unknown and has at least
    probability ``least``.  A paragraph is a line (from 0), or a run of lines
    between blank ones without their comment signs (its first line) if that is
    confirmed and its lines alone aren't as close: a wrapped notice is one row.  ``similarity`` is the share of the
    family's closest template whose n-grams the paragraph holds; ``confirmed``
    if it is at least ``overlap``.  Null and empty texts have no paragraphs;
    repeated rows are reported each.  Only lines with a word of ``gate`` and runs
    with one of ``block_gate`` are taken apart, since no other can be found; their
    known n-grams are written once and joined twice.
    """
    spark = docs.sparkSession
    weights, templates = model_tables(spark)
    bias = trained()[1]
    docs = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", column)
    lines = _paragraphs(docs, column, overlap)
    words = F.regexp_extract_all("line", F.lit(WORD), F.lit(0))
    more = F.greatest(F.size("w") - 1, F.lit(0))
    pairs = F.zip_with(F.slice("w", 1, more), F.slice("w", 2, more), lambda x, y: F.concat_ws(" ", x, y))
    keys = ["row", "doc_id", "paragraph", "last"]
    grams = lines.select(*keys, words.alias("w"))
    known = F.from_json(F.lit(json.dumps(sorted(set(trained()[0]).union(*(_grams(t) for ts in TEMPLATES.values() for t in ts))))), "array<string>")
    grams = grams.select(*keys, F.array_intersect(F.concat("w", pairs), known).alias("g"))
    grams = stage(grams.select(*keys, F.explode("g").alias("gram")), "grams")
    sums = [F.sum(F.col("weights")[k]).alias(f"s{k}") for k in range(len(FAMILIES))]
    scored = grams.join(F.broadcast(weights), "gram").groupBy(*keys).agg(*sums)
    z = [F.col(f"s{k}") + F.lit(float(b)) for k, b in enumerate(bias)]
    options = F.array(*[F.struct(v.alias("z"), F.lit(f).alias("family")) for v, f in zip(z, FAMILIES)])
    scored = scored.select(*keys, F.array_max(options).alias("top"), F.array(*z).alias("z"))
    share = 1 / F.aggregate("z", F.lit(0.0), lambda a, v: a + F.exp(v - F.col("top.z")))
    found = scored.select(*keys, F.col("top.family").alias("family"), share.alias("probability"))
    found = found.where((F.col("family") != UNKNOWN) & (F.col("probability") >= least))
    alike = grams.join(F.broadcast(templates), "gram").groupBy("row", "paragraph", "last", "template", "family")
    alike = alike.agg((F.count("*") / F.first("size")).alias("similarity")).groupBy("row", "paragraph", "last", "family")
    alike = alike.agg(F.max(F.struct("similarity", "template")).alias("best"))
    out = found.join(alike, ["row", "paragraph", "last", "family"], "left")
    similarity = F.coalesce("best.similarity", F.lit(0.0))
    out = out.select(
        "row",
        "last",
        "doc_id",
        "paragraph",
        "family",
        "probability",
        F.col("best.template").alias("template"),
        similarity.alias("similarity"),
        (similarity >= overlap).alias("confirmed"),
    )
    return _one_row_a_notice(out)
