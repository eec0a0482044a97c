"""License scans by MinHash bands over overlapping text windows, in DataFrame functions only.

Words are runs of letters a-z (A-Z lower-cased) and digits; shingles are five
words. Templates fall in size classes by powers of two of their shingles. A
notice counts where three quarters of its shingles lie in a span of twice the
class size, so words may be put in or left out. A best span can begin at a
template's shingle, so for each class a document is cut into one window of that
length from every shingle of the class's templates on: each span is a window,
wherever it stands. Window and template signatures hold 64 minima, each a band
of its own: an occurrence of three quarters of a template has a similarity of at
least 3/17 to its window, so all 64 bands miss it with probability below 4e-6. What a band retrieves is
verified on the shingles' words: 100 * shared >= 75 * (shingles of the template).

A document that shares no shingle hash with any template cannot verify and is left
out before it is cut; this loses nothing. A template of fewer
than five words is one shingle of all its words and found only as the whole of a
document's words; a template without words is ignored. Null and wordless texts
match nothing. Repeated rows are reported as one document. Texts of any length
are scanned whole, empty tables give no rows, and columns other than ``doc_id``
and ``text`` are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedwright.llm.common import doc_columns, stored

SHINGLE = 5
BANDS = 64
PERCENT = 75
#: Templates are held in every task; more shingles than these are refused.
MAX_TEMPLATE_SHINGLES = 5_000

# License names and the notices that announce them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "Apache-2.0 notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at"
    ),
    "GPL-3.0 notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "MIT notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction'
    ),
    "BSD notice": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"
    ),
    "MPL-2.0 notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
}


def template_table(spark: SparkSession, templates: dict[str, str] | None = None) -> DataFrame:
    rows = list((TEMPLATES if templates is None else templates).items())
    return spark.createDataFrame(rows, "license string, text string")


def words_column(text: Column) -> Column:
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(low, "[^a-z0-9]+"), lambda w: w != "")


def shingle_count(words: Column) -> Column:
    return F.when(F.size(words) == 0, 0).otherwise(F.greatest(F.size(words) - (SHINGLE - 1), F.lit(1)))


def shingle_hashes(words: Column) -> Column:
    """Hash of each shingle; an array without elements for no words."""
    each = F.transform(
        F.sequence(F.lit(1), shingle_count(words)),
        lambda i: F.xxhash64(*[F.try_element_at(words, (i + k).cast("int")) for k in range(SHINGLE)]),
    )
    return F.when(F.size(words) > 0, each).otherwise(F.array().cast("array<bigint>"))


def shingle_texts(words: Column) -> Column:
    """The distinct shingles as text; words hold no space."""
    each = F.transform(
        F.sequence(F.lit(1), shingle_count(words)), lambda i: F.array_join(F.slice(words, i, F.lit(SHINGLE)), " ")
    )
    return F.array_distinct(each)


def signature(hashes: Column) -> Column:
    """One minimum per band."""
    return F.transform(
        F.sequence(F.lit(1), F.lit(BANDS)), lambda b: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, b)))
    )


def band_rows(df: DataFrame) -> DataFrame:
    """One row per band: its number and value, from the column ``hashes``."""
    return df.select("*", F.posexplode(signature(F.col("hashes"))).alias("band", "value")).drop("hashes")


def scan(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """doc_id, license, n_shared and n_template: every license notice that a document holds.

    ``n_shared`` is the largest number of the notice's shingles in one span.
    """
    spark = docs.sparkSession
    known = templates.select("license", words_column(F.col("text")).alias("words")).where(F.size("words") > 0)
    known = known.select("license", "words", F.array_distinct(shingle_hashes(F.col("words"))).alias("hashes"))
    known = known.withColumn("size_class", F.expr("cast(pow(2, ceil(log2(size(hashes)))) as int)"))
    known = stored(known, "templates")
    totals = known.agg(F.coalesce(F.sum(F.size("hashes")), F.lit(0)).alias("n")).first()["n"]
    if totals > MAX_TEMPLATE_SHINGLES:
        raise ValueError(f"templates hold {totals} shingles, more than {MAX_TEMPLATE_SHINGLES}: scan them in parts")
    sizes = sorted(r["size_class"] for r in known.select("size_class").distinct().collect())
    result = "doc_id bigint, license string, n_shared int, n_template int"
    if not sizes:
        return spark.createDataFrame([], result)
    # The template hashes are bounded; they are constants of the plan.
    hashes_of: dict[int, set[int]] = {size: set() for size in sizes}
    for r in known.select("size_class", "hashes").collect():
        hashes_of[r["size_class"]].update(r["hashes"])

    def constants(hashes: set[int]) -> Column:
        return F.array(*[F.lit(h) for h in sorted(hashes)])

    of_templates = constants(set().union(*hashes_of.values()))
    # One-element arrays are exploded so that words and hashes are computed once a row:
    # a plain projection would be merged into the lambdas that read it and run again for each element.
    rows = doc_columns(docs).select("doc_id", F.explode(F.array(words_column(F.col("text")))).alias("words"))
    rows = rows.select("doc_id", "words", F.explode(F.array(shingle_hashes(F.col("words")))).alias("hashes"))
    rows = rows.where(F.arrays_overlap("hashes", of_templates))

    def windows_of(size: int) -> Column:
        own = constants(hashes_of[size])
        places = F.transform("hashes", lambda h, i: F.when(F.array_contains(own, h), i + 1))
        return F.transform(
            F.filter(places, lambda at: at.isNotNull()),
            lambda at: F.struct(
                F.lit(size).alias("size_class"), at.alias("at"), F.slice("hashes", at, F.lit(2 * size)).alias("hashes")
            ),
        )

    windows = rows.select("doc_id", "words", F.explode(F.concat(*map(windows_of, sizes))).alias("w"))
    windows = windows.select(
        "doc_id",
        F.col("w.size_class").alias("size_class"),
        F.slice("words", F.col("w.at"), 2 * F.col("w.size_class") + (SHINGLE - 1)).alias("words"),
        F.col("w.hashes").alias("hashes"),
    )
    wanted = F.broadcast(
        band_rows(known.select("license", "size_class", F.col("words").alias("template_words"), "hashes"))
    )
    met = band_rows(windows).join(wanted, ["size_class", "band", "value"])
    met = met.select("doc_id", "license", "words", "template_words").distinct()
    notice, here = shingle_texts(F.col("template_words")), shingle_texts(F.col("words"))
    checked = met.select(
        "doc_id",
        "license",
        F.size(F.array_intersect(notice, here)).alias("n_shared"),
        F.size(notice).alias("n_template"),
    )
    found = checked.where(100 * F.col("n_shared") >= PERCENT * F.col("n_template"))
    return found.groupBy("doc_id", "license").agg(
        F.max("n_shared").alias("n_shared"), F.max("n_template").alias("n_template")
    )
