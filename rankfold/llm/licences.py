"""Licence notices found by the Dice coefficient over word bigrams.

Text and templates are normalised alike: lower case, runs of characters other
than letters and digits become one space.  The units compared are the whole
text, its paragraphs (split at blank lines) and its lines.  With ``a`` and
``b`` the numbers of distinct bigrams of unit and template, ``2 * shared /
(a + b) >= threshold`` is only possible when ``threshold / (2 - threshold) <=
a / b <= (2 - threshold) / threshold``.  Templates are laid out by every size
within these bounds, so an equality join on the size gives each unit just the
templates that can match, and a unit of another size costs nothing further.

A notice inside a longer line or paragraph is found by windows of the whole
text's words, which hold every window of its paragraphs and lines.  Only texts
with ``threshold / (2 - threshold)`` of a template's bigrams are looked at.  The
window goes from the start of one run of template bigrams to the end of the same
or a later one, over up to ``(2 - threshold) / threshold`` of the template's
places: a bigram of the template next to a window never lowers its score, and
any other at its end never raises it.  A window with the template's first and
last bigram (or that ends with the text on that side) is scored as a unit is.
Any other is a notice that breaks off and runs on in different words, which
count as they do in a unit of their own: its size is at least the template's.

Defined results: null and blank texts have no unit and no licence; a unit of
one word has no bigram and matches nothing; of equal scores a unit comes before
a window, of windows the one of the larger template, then the first licence by
name, and of equal units the first one; ``n_units`` counts the units that match
as a whole, and is 1 where only windows match; a repeated document row gives a
repeated result row, and rows that share a ``doc_id``, or have none, are judged by
their own texts; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankfold.llm.text import kept_table, let

# Production parameters.
THRESHOLD = 0.8

# Notices of widely used licences, by licence.
TEMPLATES = {
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the "
        "terms of the GNU Affero General Public License as published by the Free Software "
        "Foundation, either version 3 of the License, or (at your option) any later version."),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this"
        " file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed"
        " to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See "
        "the License for the specific language governing permissions and limitations under the "
        "License."),
    "BSD-2-Clause": (
        "Licensed under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: 1. Redistributions of source"
        " code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. 2. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: 1. Redistributions of source"
        " code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. 2. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. 3. Neither the "
        "name of the copyright holder nor the names of its contributors may be used to endorse "
        "or promote products derived from this software without specific prior written "
        "permission."),
    "BSL-1.0": (
        "Distributed under the Boost Software License, Version 1.0.",),
    "CC-BY-3.0": (
        "Licensed under CC BY 3.0.",
        "This work is licensed under a Creative Commons Attribution 3.0 Unported License."),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
        "International License."),
    "CC-BY-NC-ND-4.0": (
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives"
        " 4.0 International License."),
    "CC-BY-NC-SA-4.0": (
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike "
        "4.0 International License."),
    "CC-BY-ND-4.0": (
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 "
        "International License."),
    "CC-BY-SA-3.0": (
        "Licensed under CC BY-SA 3.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported "
        "License."),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
        "International License."),
    "CC0-1.0": (
        "This work is licensed under CC0 1.0 Universal.",
        "To the extent possible under law, the author(s) have dedicated all copyright and "
        "related and neighboring rights to this software to the public domain worldwide. This "
        "software is distributed without any warranty."),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License 2.0",),
    "GPL-1.0": (
        "This program is free software; you can redistribute it and/or modify it under the "
        "terms of the GNU General Public License as published by the Free Software Foundation; "
        "either version 1 of the License, or (at your option) any later version.",),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the "
        "terms of the GNU General Public License as published by the Free Software Foundation; "
        "either version 2 of the License, or (at your option) any later version.",
        "This program is free software; you can redistribute it and/or modify it under the "
        "terms of the GNU General Public License version 2 as published by the Free Software "
        "Foundation.",
        "This program is free software; you can redistribute it and/or modify it under the "
        "terms of the GNU General Public License as published by the Free Software Foundation; "
        "version 2 of the License."),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the "
        "terms of the GNU General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
        "This program is free software: you can redistribute it and/or modify it under the "
        "terms of the GNU General Public License as published by the Free Software Foundation, "
        "version 3."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",),
    "LGPL-2.0": (
        "This library is free software; you can redistribute it and/or modify it under the "
        "terms of the GNU Library General Public License as published by the Free Software "
        "Foundation; either version 2 of the License, or (at your option) any later version.",),
    "LGPL-2.1": (
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the "
        "terms of the GNU Lesser General Public License as published by the Free Software "
        "Foundation; either version 2.1 of the License, or (at your option) any later version."),
    "LGPL-3.0": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the "
        "terms of the GNU Lesser General Public License as published by the Free Software "
        "Foundation, either version 3 of the License, or (at your option) any later version."),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the "
        "Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
        "and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be "
        "included in all copies or substantial portions of the Software.",
        "Licensed under the MIT License."),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. "
        "If a copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/.",),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free"
        " to copy, modify, publish, use, compile, sell, or distribute this software, either in "
        "source code form or as a compiled binary, for any purpose, commercial or "
        "non-commercial, and by any means.",),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no "
        "event will the authors be held liable for any damages arising from the use of this "
        "software. Permission is granted to anyone to use this software for any purpose, "
        "including commercial applications, and to alter it and redistribute it freely",),
}


def _normal_words(text: Column) -> Column:
    plain = F.btrim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.split(plain, " ")


def _places(text: Column) -> Column:
    """The word bigrams of the normalised text in order, as 64-bit hashes."""
    return F.transform(F.array(_normal_words(text)), lambda w: F.when(
        F.size(w) >= 2, F.transform(
            F.sequence(F.lit(0), F.size(w) - 2), lambda i: F.xxhash64(w[i], w[i + 1])))
        .otherwise(F.array().cast("array<long>")))[0]


def bigrams(text: Column) -> Column:
    """Distinct word bigrams of the normalised text, as 64-bit hashes."""
    return F.array_distinct(_places(text))


def template_table(spark: SparkSession, templates: dict = TEMPLATES,
                   threshold: float = THRESHOLD) -> DataFrame:
    """(licence, template bigrams, size) for every unit size that can still match."""
    rows = [F.struct(F.lit(name).alias("licence"), F.lit(t).alias("t"))
            for name, ts in templates.items() for t in ts]
    base = spark.range(1, numPartitions=1).select(F.inline(F.array(*rows)))
    t = base.select("licence", bigrams(F.col("t")).alias("tb"))
    b = F.size("tb")
    low = F.ceil(b * threshold / (2 - threshold) - 1e-9).cast("int")
    high = F.floor(b * (2 - threshold) / threshold + 1e-9).cast("int")
    return t.filter(b > 0).select("licence", "tb", F.explode(
        F.sequence(F.greatest(low, F.lit(1)), high)).alias("size"))


def _units(text: Column) -> Column:
    t = F.coalesce(text, F.lit(""))
    return F.array_distinct(F.concat(F.array(t), F.split(t, r"\n[ \t\r]*\n\s*"),
                                     F.split(t, "\n")))


def scan(docs: DataFrame, templates: dict = TEMPLATES, threshold: float = THRESHOLD,
         key: tuple = ("doc_id",)) -> DataFrame:
    """One row per unit and licence with a Dice coefficient of ``threshold`` or more; ``key``
    has the columns that tell documents apart."""
    table = template_table(docs.sparkSession, templates, threshold)
    # the templates are a parameter, not data: a few rows per template
    units = (docs.select(*key, F.posexplode(_units(F.col("text"))).alias("unit", "u"))
             .select(*key, "unit", bigrams(F.col("u")).alias("ub"))
             .withColumn("size", F.size("ub")).filter("size > 0"))
    shared = F.size(F.array_intersect("ub", "tb"))
    return (units.join(F.broadcast(table), "size")
            .withColumn("dice", 2.0 * shared / (F.col("size") + F.size("tb")))
            .filter(F.col("dice") >= threshold)
            .groupBy(*key, "unit", "licence").agg(F.max("dice").alias("dice")))


def _windows(g: Column, hits: Column, t: Column, threshold: float) -> Column:
    """The best Dice coefficient of template ``t`` in any window of the bigrams ``g``; ``hits``
    are the places (``h``, ``i``) of the bigrams of all templates."""
    b = F.size(t["tb"])

    def score(first, last):
        def dice(x):
            shared = F.size(F.array_intersect(x, t["tb"]))
            opens = (first == 0) | F.array_contains(x, t["tb"][0])
            ends = (last == F.size(g) - 1) | F.array_contains(x, t["final"])
            size = F.when(opens & ends, F.size(x)).otherwise(F.greatest(F.size(x), b))
            return 2.0 * shared / (size + b)
        return let(F.array_distinct(F.slice(g, first + 1, last - first + 1)), dice)

    def best(own, starts, ends):
        runs = F.transform(starts, lambda s, r: F.struct(
            s["i"].alias("first"), ends[r]["i"].alias("last"), s["k"].alias("k0"),
            ends[r]["k"].alias("k1"), r.alias("r")))

        def from_run(rs, a):
            later = F.filter(F.slice(rs, a["r"] + 1, t["high"]), lambda z: (
                (z["k1"] - a["k0"] + 1 >= t["low"])
                & ((z["r"] == a["r"]) | (z["last"] - a["first"] < t["high"]))))
            return F.transform(later, lambda z: score(a["first"], z["last"]))

        def near(a):  # enough places of the template's bigrams where a window can reach
            k = a["k0"] + t["low"] - 1
            return F.coalesce((k <= a["k1"]) | (F.get(own, k)["i"] - a["first"] < t["high"]),
                              F.lit(False))
        return let(runs, lambda rs: F.array_max(F.flatten(F.transform(
            F.filter(rs, near), lambda a: from_run(rs, a)))))

    def edges(own):
        spots = F.transform(own, lambda x, k: F.struct(x["i"].alias("i"), k.alias("k")))

        def edge(step):
            return F.filter(spots, lambda x: F.coalesce(
                F.get(own, x["k"] + step)["i"] != x["i"] + step, F.lit(True)))
        return let(edge(-1), lambda s: let(edge(1), lambda e: best(own, s, e)))
    return let(F.filter(hits, lambda x: F.array_contains(t["tb"], x["h"])), edges)


def embedded(docs: DataFrame, templates: dict = TEMPLATES, threshold: float = THRESHOLD,
             key: tuple = ("doc_id",)) -> DataFrame:
    """One row per document row and template found in a window of its whole text."""
    most = (2 - threshold) / threshold
    rows = [F.struct(F.lit(name).alias("licence"), _places(F.lit(t)).alias("p"))
            for name, ts in templates.items() for t in ts]
    known = (docs.sparkSession.range(1, numPartitions=1).select(F.inline(F.array(*rows)))
             .filter(F.size("p") > 0)
             .select("licence", F.array_distinct("p").alias("tb"), F.element_at("p", -1)
                     .alias("final"), F.size("p").alias("n")).collect())  # the parameter itself
    if not known:
        return docs.select(*key, F.lit("").alias("licence"), F.lit(0).alias("b"),
                           F.lit(0.0).alias("dice")).limit(0)
    table = F.array(*[F.struct(
        F.lit(r.licence).alias("licence"), F.lit(r.tb).alias("tb"), F.lit(r.final).alias("final"),
        F.lit(max(1, math.ceil(len(r.tb) / most - 1e-9))).alias("low"),
        F.lit(math.floor(r.n * most + 1e-9)).alias("high")) for r in known])
    every = sorted({h for r in known for h in r.tb})
    least = min(math.ceil(len(r.tb) / most - 1e-9) for r in known)
    hits = F.filter(F.transform(F.col("g"), lambda h, i: F.struct(h.alias("h"), i.alias("i"))),
                    lambda x: x["h"].isin(every))
    found = (docs.select(*key, _places(F.coalesce("text", F.lit(""))).alias("g"))
             .select(*key, "g", hits.alias("hits")).filter(F.size("hits") >= least)
             .withColumn("seen", F.array_distinct(F.col("hits.h")))
             .withColumn("t", F.explode(F.filter(table, lambda t: F.size(F.array_intersect(
                 F.col("seen"), t["tb"])) >= t["low"]))))
    return (found.select(*key, F.col("t.licence").alias("licence"),
                         F.size("t.tb").alias("b"),
                         _windows(F.col("g"), F.col("hits"), F.col("t"), threshold).alias("dice"))
            .filter(F.col("dice") >= threshold))


def classify(docs: DataFrame, templates: dict = TEMPLATES,
             threshold: float = THRESHOLD) -> DataFrame:
    """One row per document row: its best licence (null without one), the Dice
    coefficient, and how many units match any licence."""
    own = docs.select("doc_id", F.xxhash64("text").alias("_tie"), "text")
    key = ("doc_id", "_tie")
    whole = scan(own, templates, threshold, key).select(
        *key, "unit", F.lit(0).alias("b"), "licence", "dice")
    inside = embedded(own, templates, threshold, key).select(
        *key, F.lit(None).cast("int").alias("unit"), "b", "licence", "dice")
    rows = kept_table(whole.unionByName(inside))
    best = rows.groupBy(F.col("doc_id").alias("_d"), F.col("_tie").alias("_t")).agg(
        F.greatest(F.countDistinct("unit"), F.lit(1)).alias("n_units"),
        F.min(F.struct((-F.col("dice")).alias("s"), F.col("unit").isNull().alias("w"),
                       (-F.col("b")).alias("b"), "licence", "unit")).alias("b"))
    return (own.drop("text")
            .join(best, F.col("doc_id").eqNullSafe(F.col("_d"))
                  & (F.col("_tie") == F.col("_t")), "left")
            .select("doc_id", F.coalesce("n_units", F.lit(0)).cast("long").alias("n_units"),
                    F.col("b.licence").alias("licence"), (-F.col("b.s")).alias("dice")))
