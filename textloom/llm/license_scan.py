"""License scans: MinHash bands over overlapping windows retrieve templates, containment verifies.

Texts and templates become sequences of word-shingle hashes. Windows of several widths, each
overlapping the next by half, get MinHash signatures; a window that shares a band with a
window of a template retrieves the template. The exact share of the template's shingles in the
text around is then counted. All of it is built-in functions on rows; one document is one row
until a window has retrieved something.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.text import bind
from textloom.llm.license_texts import FAMILIES
from textloom.session import materialize

WORDS = 5  # of a shingle
SIMILARITY = 0.75  # of a template's shingles that the text must hold
BANDS = 12  # of one row each: windows alike by 0.5 meet with 1 - 0.5 ** 12 = 0.9998

# Notices by which texts state their license. Families whose notices differ in a version
# share most shingles: both may be found, and the containment of the one that is meant is higher.
TEMPLATES = FAMILIES | {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "mit": "Released under the MIT License.",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction"
    ),
    "bsd-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met"
    ),
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at"
    ),
}


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda word: word != "")


def shingles(found: Column) -> Column:
    """A hash for each run of five words, in order; with fewer words there is none."""

    def hashed(at: Column) -> Column:
        return F.xxhash64(*[F.get(found, at + k) for k in range(WORDS)])

    places = F.sequence(F.lit(0), F.size(found) - WORDS)
    return F.when(F.size(found) >= WORDS, F.transform(places, hashed)).otherwise(F.array().cast("array<bigint>"))


def signature(window: Column, bands: int) -> Column:
    """MinHash: the least value of the window's shingles under each of some hash functions."""

    def under(band: int) -> Column:
        # One parameter only: a second one would be the place of the shingle in the window.
        return F.array_min(F.transform(window, lambda h: F.xxhash64(h, F.lit(band))))

    return F.array(*map(under, range(bands)))


def widths(count: int) -> int:
    """The window, in shingles, for a template of so many: the largest power of two
    of which one that starts at a multiple of its half lies inside every copy."""
    width = 1
    while 2 * width + (2 * width) // 2 - 1 <= count:
        width *= 2
    return width


def window_bands(shingled: DataFrame, width: int, step: int, bands: int, *keep: str) -> DataFrame:
    """``(*keep, band, value)``: one row per window of ``width`` shingles and band."""
    last = F.greatest(F.size("hashes") - width, F.lit(0))
    starts = F.sequence(F.lit(0), last, F.lit(step))
    # The end of a text is covered by a window of its own.
    starts = F.array_union(starts, F.array(last))
    windows = F.transform(
        starts, lambda at: bind(F.slice("hashes", at + 1, F.lit(width)), lambda window: signature(window, bands))
    )
    return shingled.select(*keep, F.explode(windows).alias("_signature")).select(
        *keep, F.posexplode("_signature").alias("band", "value")
    )


def template_table(spark: SparkSession, templates: Mapping[str, str]) -> DataFrame:
    """``(license, hashes)`` of the templates."""
    rows = spark.createDataFrame(sorted(templates.items()), "license string, notice string")
    return rows.select("license", bind(words(F.col("notice")), shingles).alias("hashes"))


def scan(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
) -> DataFrame:
    """``(doc_id, license, first_word, matched, template_shingles, containment)``: the best place
    of each license in each document of ``docs(doc_id, text, ...)`` that holds at least
    ``similarity`` of a template's distinct shingles within a stretch as long as the template.

    Of equally good places the first is given. Texts that are null, empty or shorter than a shingle
    match nothing; null ids are left out; rows that repeat an id are one document; no rows
    give none; other columns are not looked at. Templates are an argument and broadcast: a
    few kilobytes each, and one of under five words raises an error.
    """
    spark = docs.sparkSession
    table = template_table(spark, templates)
    known = {row["license"]: row["hashes"] for row in table.collect()}
    if short := [name for name, hashes in known.items() if not hashes]:
        raise ValueError(f"templates of under {WORDS} words: {short}")
    every = sorted({h for hashes in known.values() for h in hashes})

    # A window can only share a band with a template if it shares a shingle with one.
    def near(hashes: Column) -> Column:
        return F.when(F.arrays_overlap(hashes, F.array(*map(F.lit, every))), F.array(hashes))

    hashes = bind(bind(words(F.col("text")), shingles), near)
    shingled = materialize(
        docs.where(F.col("doc_id").isNotNull()).select(
            F.col("doc_id").cast("long").alias("doc_id"), F.explode(hashes).alias("hashes")
        ),
        "near-licenses",
    )
    retrieved = None
    for width in sorted({widths(len(hashes)) for hashes in known.values()}):
        own = table.where(F.col("license").isin([n for n, h in known.items() if widths(len(h)) == width]))
        of_templates = window_bands(own, width, 1, bands, "license").distinct()
        of_texts = window_bands(shingled, width, max(1, width // 2), bands, "doc_id")
        met = of_texts.join(F.broadcast(of_templates), ["band", "value"]).select("doc_id", "license")
        retrieved = met if retrieved is None else retrieved.unionByName(met)
    candidates = retrieved.distinct()

    # Verification: how many different shingles of the template lie in a stretch of its length.
    places = shingled.select("doc_id", F.posexplode("hashes").alias("at", "hash"))
    of_template = table.select(
        "license",
        F.size(F.array_distinct("hashes")).alias("n"),
        F.size("hashes").alias("span"),
        F.explode(F.array_distinct("hashes")).alias("hash"),
    )
    hits = (
        places.join(F.broadcast(of_template), "hash")
        .join(candidates, ["doc_id", "license"])
        .groupBy("doc_id", "license", "n", "span")
        # One document's places, so no longer than its text.
        .agg(F.array_sort(F.collect_list(F.struct("at", "hash"))).alias("places"))
    )

    def stretch(place: Column, i: Column) -> Column:
        near = F.filter(
            F.slice("places", i + 1, F.col("span")), lambda other: other["at"] < place["at"] + F.col("span")
        )
        held = F.size(F.array_distinct(F.transform(near, lambda other: other["hash"])))
        return F.struct(held.alias("matched"), (-place["at"]).alias("minus"))

    best = F.array_max(F.transform("places", stretch))
    return (
        hits.select("doc_id", "license", "n", best.alias("best"))
        .where(F.col("best.matched") >= F.col("n") * similarity)
        .select(
            "doc_id",
            "license",
            (-F.col("best.minus")).alias("first_word"),
            F.col("best.matched").alias("matched"),
            F.col("n").alias("template_shingles"),
            (F.col("best.matched") / F.col("n")).alias("containment"),
        )
    )
