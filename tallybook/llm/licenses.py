"""License texts in documents: MinHash bands over overlapping windows, exact containment.

All in DataFrame functions. Words are runs of letters and digits in lower case; shingles are
five words. A template of up to S shingles is looked for in windows of 3S/2 shingles that
start every S/2, so each occurrence lies whole in one window, whose resemblance to the
template is then over 1/3. With 32 bands of one value, such a window shares a band with the
template with a probability of 1 - (2/3)^32, over 0.99999; at a containment of 0.8 the
resemblance is at least 1/4, and the probability over 0.9998.

A window that holds no shingle of any template shares no band with one, since a template's
minimum is the value of one of its shingles. Such windows are not banded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm import native
from tallybook.llm.scratch import keep

SHINGLE = 5
BANDS = 32
CONTAINMENT = 0.8

# Short notices and standard wordings of common licenses.
TEMPLATES = {
    "mit-line": "Released under the MIT License",
    "apache-line": "Licensed under the Apache License, Version 2.0",
    "gpl-line": "This work is licensed under the GNU General Public License, version 3",
    "cc-by-nc-line": "Licensed under CC BY-NC 4.0",
    "cc-by-line": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files, to deal in the Software without"
        " restriction, including without limitation the rights to use, copy, modify, merge,"
        " publish, distribute, sublicense, and/or sell copies of the Software, and to permit"
        " persons to whom the Software is furnished to do so, subject to the following"
        " conditions: The above copyright notice and this permission notice shall be included"
        " in all copies or substantial portions of the Software."
    ),
    "apache-2.0": (
        "you may not use this file except in compliance with the License. You may obtain a copy"
        " of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by"
        " applicable law or agreed to in writing, software distributed under the License is"
        " distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,"
        " either express or implied. See the License for the specific language governing"
        " permissions and limitations under the License."
    ),
    "gpl-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms"
        " of the GNU General Public License as published by the Free Software Foundation, either"
        " version 3 of the License, or (at your option) any later version. This program is"
        " distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even"
        " the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met: Redistributions of source"
        " code must retain the above copyright notice, this list of conditions and the following"
        " disclaimer."
    ),
}


def shingles(text: Column) -> Column:
    """Hashes of every five words; fewer words give none."""
    words = F.array_remove(
        F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+"), ""
    )
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return native.let(hashed, lambda h: native.grams(h, SHINGLE))


def minima(window: Column) -> Column:
    """The least value of a set of shingles under each hash function."""

    def least(band: int) -> Column:
        return F.array_min(F.transform(window, lambda x: F.xxhash64(x, F.lit(band))))

    return F.array(*[least(b) for b in range(BANDS)])


def index_templates(docs: DataFrame, templates: dict[str, str]) -> DataFrame:
    """One row per template: its shingles, size class and minima."""
    spark = docs.sparkSession
    rows = spark.createDataFrame(list(templates.items()), "license string, text string")
    made = keep(
        rows.select("license", F.array_distinct(shingles(F.col("text"))).alias("own"))
        .where(F.size("own") > 0)
        .withColumn("minima", minima(F.col("own"))),
        "templates",
    )
    size = F.pow(2, F.ceil(F.log2(F.size("own").cast("double")))).cast("int")
    return made.withColumn("class", size)


def _windows(size: int, known: list[int], text: Column) -> Column:
    """Windows of a size class that hold a shingle of a template."""
    step = max(1, size // 2)
    length = size + step - 1

    def around(hits: Column) -> Column:
        return F.array_distinct(
            F.flatten(
                F.transform(
                    hits,
                    lambda p: F.sequence(
                        F.greatest(F.lit(0), F.floor((p - length) / step) + 1).cast("int"),
                        F.floor(p / step).cast("int"),
                    ),
                )
            )
        )

    return native.let(
        text,
        lambda g: F.transform(
            around(
                F.filter(
                    F.transform(g, lambda x, i: F.when(x.isin(known), i).otherwise(-1)),
                    lambda p: p >= 0,
                )
            ),
            lambda w: F.struct(
                (w * step).alias("at"), F.slice(g, w * step + 1, length).alias("window")
            ),
        ),
    )


def find_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """Each document with each template it contains: doc_id, license, containment, place.

    docs needs ``doc_id`` and ``text``; other columns are ignored. Containment is the share of
    the template's distinct shingles that the best window holds, 0.8 or more; ``first_word``
    is where that window starts, the first of equals. A null or empty text contains nothing; a
    template of fewer than five words is left out. Rows with equal ids give one row per
    license; an empty table gives no rows. Templates are few: they are held in the plan.
    """
    index = index_templates(docs, templates)
    rows = index.select("class", "own").collect()
    known = sorted({x for r in rows for x in r["own"]})
    classes = sorted({r["class"] for r in rows})
    # Texts without any template shingle end here; the others are read once per size class.
    scanned = keep(
        docs.select(
            F.col("doc_id").cast("bigint"), shingles(F.col("text").cast("string")).alias("g")
        ).where(F.exists("g", lambda x: x.isin(known))),
        "licensed",
    )
    bands = index.select("class", "license", "own", F.posexplode("minima").alias("band", "value"))
    found = None
    for size in classes:
        windows = (
            scanned.select("doc_id", F.explode(_windows(size, known, F.col("g"))).alias("w"))
            .select("doc_id", "w.at", F.array_distinct("w.window").alias("window"))
            .select("*", F.posexplode(minima(F.col("window"))).alias("band", "value"))
        )
        # A handful of templates times the bands.
        of_class = F.broadcast(bands.where(F.col("class") == size).drop("class"))
        hits = (
            windows.join(of_class, ["band", "value"])
            .select(
                "doc_id",
                "license",
                "at",
                (F.size(F.array_intersect("own", "window")) / F.size("own")).alias("containment"),
            )
            .where(F.col("containment") >= CONTAINMENT)
        )
        found = hits if found is None else found.unionAll(hits)
    if found is None:
        return docs.sparkSession.createDataFrame(
            [], "doc_id bigint, license string, containment double, first_word bigint"
        )
    best = F.max(F.struct("containment", (-F.col("at")).alias("before"))).alias("hit")
    return found.groupBy("doc_id", "license").agg(best).select(
        "doc_id",
        "license",
        F.col("hit.containment").alias("containment"),
        (-F.col("hit.before")).cast("bigint").alias("first_word"),
    )
