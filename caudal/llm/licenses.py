"""Licence scans: a trained paragraph classifier, by DataFrame functions only.

Sparse logistic regression over word uni- and bigrams gives each licence family
and an unknown class a probability; the model is trained on the driver, in numpy,
on perturbed licence notices and on other text, and its temperature and threshold
are calibrated on a part of them that it has not seen. A prediction is confirmed
if the paragraph holds enough of the words of one of the family's templates.

Every line is classified, and so that wrapped notices are found, so is from each
line on the shortest run of lines that holds as many words as the longest template
or ends at a line without words. Of a family's lines and runs that overlap, those
are reported that confirm it by the most words of a template, then the most similar
ones; a line is reported rather than a run that shows no more than it.

Nothing is left out before the model. Its weights are a literal of the plan, in
SLOTS buckets by a hash of the n-gram, so that texts are neither exploded nor
shuffled. No Python runs on executors.

Nulls and edge cases: null and empty texts have no paragraphs. Documents with a
null id are reported with it, repeated rows each. Ties of probability go to the
family first by name. Extra columns are ignored.
"""

from __future__ import annotations

import json
import random
import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

UNKNOWN = "unknown"
#: What a line must have to be classified: a word, without which it has no n-gram.
HAS_WORD = r"(?i)[a-z0-9]"
TOKEN = r"[a-z0-9]+(?:[.\-][a-z0-9]+)*"
CONFIRM, MOST_FALSE, SLOTS = 0.6, 0.005, 1024

#: Notices by family (fixed values: customary wordings).
TEMPLATES = {
    "AGPL-3.0": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "BSD": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ],
    "CC0": [
        "Released under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0 1.0 Universal Public Domain Dedication.",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU GPL v2 or later.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "ISC": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "SPDX-License-Identifier: ISC",
    ],
    "LGPL": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        "SPDX-License-Identifier: MIT",
    ],
    "MPL-2.0": [
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain under the Unlicense.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "SPDX-License-Identifier: Unlicense",
    ],
}
#: Text that speaks of licences and rights without being a notice of a family (fixed values).
OTHERS = [
    "Copyright 2019 the authors. All rights reserved.",
    "He lost his driving licence after the accident and needs a new one.",
    "The restaurant applied for a licence to sell wine and beer.",
    "Please ask for permission before you copy any of these pictures.",
    "The warranty of the washing machine covers two years of use.",
    "This software may not be redistributed without written permission of the vendor.",
    "Commercial license required; contact sales for terms and conditions.",
    "The copyright notice of the original edition is missing in this copy.",
    "A search warrant was issued on the terms of the general public interest.",
    "The song has been in the public domain since the year 1953.",
    "Every licensed doctor must renew the license after five years.",
    "See the license file for details.",
    "The agency will redistribute the funds among the districts.",
    "Version 2.0 of the program was released in June with new conditions of use.",
    "The licensed version of the game includes source code and free updates.",
    "We were granted permission to use the building free of charge.",
]
#: Words of any text, in no order of a notice (fixed values); "mit" is a German one.
COMMON = "the of and to in a is that for it as was with be by on not this are or from at which but have an had you all can has if when will other its may no any one work use after see has been were new free name public general international open include including so do must copy person subject charge without law either into above following list can mit found should along".split()


def tokens(text: str) -> list[str]:
    return re.findall(TOKEN, text.lower())


def grams(text: str) -> set[str]:
    w = tokens(text)
    return set(w) | {f"{a} {b}" for a, b in zip(w, w[1:], strict=False)}


@dataclass
class Model:
    families: list[str]  # with UNKNOWN
    weights: dict[str, list[float]]  # by n-gram
    bias: list[float]
    temperature: float
    threshold: float


def _samples(rng: random.Random, n: int) -> list[tuple[str, str]]:
    noise = lambda k: " ".join("".join(rng.choice("abcdefghilmnoprstuvw") for _ in range(rng.randint(2, 9))) for _ in range(k))
    out = []
    families = sorted(TEMPLATES)
    for _ in range(n):
        x = rng.random()
        if x < 0.6:
            y = rng.choice(families)
            w = rng.choice(TEMPLATES[y]).split()
            if len(w) > 8:
                w = [v for v in w if rng.random() > 0.08]
                if rng.random() < 0.3:
                    at = rng.randrange(len(w) // 2)
                    w = w[at : at + max(8, len(w) // 2)]
            text = " ".join(w)
        else:
            y, text = UNKNOWN, rng.choice(OTHERS)
            if x < 0.75:
                text = " ".join(rng.choice(COMMON) for _ in range(rng.choice([1, 2, 4, 8, 16, 40])))
            if x > 0.85:
                text = " ".join(v for v in text.split() if rng.random() > 0.3) + " " + rng.choice(OTHERS)
        before, after = (noise(rng.choice([0, 0, 0, 2, 6])) for _ in range(2))
        out.append((f"{before} {text} {after}", y))
    return out


def train(seed: int = 1, n: int = 6000) -> Model:
    rng = random.Random(seed)
    data = _samples(rng, n)
    fit, held = data[: n * 3 // 4], data[n * 3 // 4 :]
    names = [*sorted(TEMPLATES), UNKNOWN]
    vocabulary = sorted({g for ts in TEMPLATES.values() for t in ts for g in grams(t)} | {g for t in OTHERS for g in grams(t)})
    at = {g: i for i, g in enumerate(vocabulary)}

    def matrix(rows):
        x = np.zeros((len(rows), len(at)), np.float32)
        for i, (t, _) in enumerate(rows):
            x[i, [at[g] for g in grams(t) if g in at]] = 1
        return x, np.array([names.index(y) for _, y in rows])

    x, y = matrix(fit)
    onehot = np.eye(len(names), dtype=np.float32)[y]
    w, b = np.zeros((len(at), len(names)), np.float32), np.zeros(len(names), np.float32)
    b[-1] = 2.0  # nothing known: unknown
    step, shrink = 0.5, 2e-4
    for _ in range(300):  # proximal gradient: small weights become zero
        z = x @ w + b
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        w -= step * (x.T @ (p - onehot)) / len(x) * 4
        w = np.sign(w) * np.maximum(np.abs(w) - step * shrink, 0)
    xh, yh = matrix(held)
    z = xh @ w + b

    def likelihood(t: float) -> float:
        q = z / t - (z / t).max(1, keepdims=True)
        return float((q[np.arange(len(yh)), yh] - np.log(np.exp(q).sum(1))).mean())

    temperature = max((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0), key=likelihood)
    q = np.exp(z / temperature - (z / temperature).max(1, keepdims=True))
    q /= q.sum(1, keepdims=True)
    wrong = (q.argmax(1) != yh) & (q.argmax(1) != len(names) - 1)
    best = q.max(1)
    threshold = next((float(c) for c in np.arange(0.3, 0.96, 0.05) if (wrong & (best >= c)).mean() <= MOST_FALSE), 0.95)
    return Model(names, {g: w[i].astype(float).tolist() for g, i in at.items() if w[i].any()}, b.astype(float).tolist(), float(temperature), threshold)


def _words(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(TOKEN), F.lit(0))


def _weights(m: Model):
    """The weights of an n-gram, or null."""
    slots = [{} for _ in range(SLOTS)]
    for g, w in sorted(m.weights.items()):
        slots[zlib.crc32(g.encode()) % SLOTS][g] = w
    table = F.from_json(F.lit(json.dumps(slots)), "array<map<string, array<double>>>")
    return lambda g: F.try_element_at(F.get(table, F.pmod(F.crc32(g), F.lit(SLOTS)).cast("int")), g)


def scan(docs: DataFrame, model: Model | None = None, *, confirm: float = CONFIRM) -> DataFrame:
    """doc_id, paragraph (its first line, from 0), family, probability, similarity (share of a template's words) and confirmed,
    for each paragraph of docs (doc_id, text) that the classifier gives to a family."""
    m = train() if model is None else model
    longest = max(len(tokens(t)) for ts in TEMPLATES.values() for t in ts)
    weight = _weights(m)
    once = lambda df, *keep, **made: df.select(*keep, F.inline(F.array(F.struct(*(c.alias(n) for n, c in made.items())))))  # noqa: E731  a generator's row, so that no lambda computes it again
    empty = F.array().cast("array<string>")
    rows = docs.select("doc_id", "text").where(F.col("text").rlike(HAS_WORD)).withColumn("row", F.xxhash64("text"))
    rows = once(rows, "row", "doc_id", lines=F.transform(F.split("text", "\n", -1), lambda x: F.when(x.rlike(HAS_WORD), _words(x)).otherwise(empty)))
    pairs = lambda w: F.zip_with(w, F.slice(w, 2, F.greatest(F.size(w), F.lit(1))), lambda a, b: F.concat_ws(" ", a, b))
    # zip_with pads the shorter array with null, so the last "pair" is the last word alone: array_distinct drops it.
    own = lambda w: F.filter(F.array_distinct(F.concat(w, pairs(w))), lambda g: weight(g).isNotNull())
    joint = lambda w, i: F.filter(F.array(F.concat_ws(" ", F.element_at(F.get("lines", i - 1), -1), w[0])), lambda g: weight(g).isNotNull())
    line = lambda w, i: F.struct(F.size(w).alias("n"), F.when(F.size(w) > 0, own(w)).otherwise(empty).alias("own"), F.when((i > 0) & (F.size(w) > 0) & (F.size(F.get("lines", i - 1)) > 0), joint(w, i)).otherwise(empty).alias("joint"))
    rows = once(rows, "row", "doc_id", "lines", marks=F.transform("lines", line))
    # A line of a run has a word at least, so a run of so many words has no more lines than words.
    more = lambda s, x: F.when(s["open"] & (x["n"] > 0) & (s["n"] < longest), F.struct((s["size"] + 1).alias("size"), (s["n"] + x["n"]).alias("n"), F.lit(True).alias("open"))).otherwise(F.struct(s["size"].alias("size"), s["n"].alias("n"), F.lit(False).alias("open")))
    run = lambda i: F.aggregate(F.slice("marks", i + 1, F.lit(longest)), F.struct(F.lit(0).alias("size"), F.lit(0).alias("n"), F.lit(True).alias("open")), more)["size"]
    places = F.filter(F.transform("marks", lambda x, i: F.struct(i.alias("first"), run(i).alias("size"), x["own"].alias("own"))), lambda u: u["size"] > 0)
    rows = once(rows, "row", "doc_id", "lines", "marks", places=places)
    whole = lambda u: F.array_distinct(F.concat(u["own"], F.flatten(F.transform(F.slice("marks", u["first"] + 2, F.greatest(u["size"] - 1, F.lit(0))), lambda x: F.concat(x["joint"], x["own"])))))
    score = lambda grams: F.aggregate(grams, F.array(*(F.lit(float(b)) for b in m.bias)), lambda z, g: F.zip_with(z, weight(g), lambda x, y: x + y), lambda z: F.transform(z, lambda x: x / F.lit(m.temperature)))
    single = F.transform("places", lambda u: F.struct(u["first"].alias("first"), F.lit(1).alias("size"), score(u["own"]).alias("z")))
    several = F.transform(F.filter("places", lambda u: u["size"] > 1), lambda u: F.struct(u["first"].alias("first"), u["size"].alias("size"), score(whole(u)).alias("z")))
    # Only what is more probable than unknown goes on.
    likely = F.filter(F.concat(single, several), lambda u: F.array_max(u["z"]) > u["z"][len(m.families) - 1])
    found = rows.select("row", "doc_id", "lines", F.inline(likely))
    top = F.array_max("z")
    found = found.select("row", "doc_id", "lines", "first", "size", F.element_at(F.array(*(F.lit(f) for f in m.families)), F.array_position("z", top).cast("int")).alias("family"), (F.lit(1.0) / F.aggregate("z", F.lit(0.0), lambda s, x: s + F.exp(x - top))).alias("probability"))
    found = found.where(F.col("probability") >= m.threshold)
    known = F.create_map(*(x for f in sorted(TEMPLATES) for x in (F.lit(f), F.array(*(F.array(*(F.lit(w) for w in sorted(set(tokens(t))))) for t in TEMPLATES[f])))))
    words = F.flatten(F.slice("lines", F.col("first") + 1, F.col("size")))
    met = F.transform(known[F.col("family")], lambda t: F.struct(F.size(F.array_intersect(t, words)).alias("words"), F.size(t).alias("of")))
    found = found.select("row", "doc_id", "first", "size", "family", "probability", met.alias("met"))
    found = found.withColumns({"similarity": F.array_max(F.transform("met", lambda t: t["words"] / t["of"])), "matched": F.array_max(F.transform("met", lambda t: F.when(t["words"] / t["of"] >= confirm, t["words"]).otherwise(0)))}).drop("met")
    # Rows are told apart by id and text, so that a task that runs again after a lost executor names them alike; of repeated
    # rows each unit is kept once with its number.
    unit = ("first", "size", "similarity", "matched", "probability")
    found = found.groupBy("doc_id", "row", "family", *unit).agg(F.count("*").cast("int").alias("copies"))
    # A run counts only where it shows more of a template, or a longer one, than its first line alone.
    shows = F.struct("matched", "similarity")
    line = F.max(F.when(F.col("size") == 1, shows)).over(W.partitionBy("doc_id", "row", "family", "first"))
    found = found.withColumn("line", line).where((F.col("size") == 1) | F.col("line").isNull() | (shows > F.col("line"))).drop("line")
    of = W.partitionBy("doc_id", "row", "family")
    before = F.max(F.col("first") + F.col("size")).over(of.orderBy("first", "size").rowsBetween(W.unboundedPreceding, -1))
    found = found.withColumn("opens", F.when(F.col("first") < before, 0).otherwise(1)).withColumn("island", F.sum("opens").over(of.orderBy("first", "size").rowsBetween(W.unboundedPreceding, 0)))
    # Of the units that overlap one another: those that confirm by the most words first, then the most similar, lines before runs, later starts first; each is taken if it overlaps none taken before.
    rank = (-F.col("matched"), -F.col("similarity"), F.col("size") > 1, -F.col("first"), -F.col("probability"))
    ranked = found.groupBy("doc_id", "row", "family", "island").agg(F.array_sort(F.collect_list(F.struct(*(r.alias(f"r{i}") for i, r in enumerate(rank)), *unit, "copies"))).alias("units"))
    apart = lambda taken, u: ~F.exists(taken, lambda t: (t["first"] < u["first"] + u["size"]) & (u["first"] < t["first"] + t["size"]))
    taken = F.aggregate("units", F.slice("units", 1, 0), lambda taken, u: F.when(apart(taken, u), F.concat(taken, F.array(u))).otherwise(taken))
    found = ranked.select("doc_id", "family", F.explode(taken).alias("u")).select("doc_id", "family", "u.*").withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("copies"))))
    return found.select("doc_id", F.col("first").alias("paragraph"), "family", "probability", "similarity").withColumn("confirmed", F.col("similarity") >= confirm)
