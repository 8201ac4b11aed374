"""License scans with built-in functions only: MinHash bands retrieve templates, shingle containment verifies them.

Texts become lower-case words of letters and digits, and hashes of their runs of SHINGLE words. Templates are sorted into
classes by their number of distinct shingles t: class L, a power of 2, takes L / 2 < t <= L. For class L the text is covered by
windows of 2 * L shingles, L apart, so a passage of up to L shingles lies whole in one of them. A window that holds the share c
of a template has a similarity of c * t / (2 * L + t - c * t) with it or more, which for c >= 0.8 is over 0.18. With BANDS bands
of one minhash each they meet with a probability of 1 - 0.82**BANDS or more: with 64, but for 3 in a million.

Texts and windows without any shingle of a template can't match one and are passed over before minhashes are taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 5
BANDS = 64
LEAST = 0.8

# The wording of public license notices.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
     "compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
     "that the following conditions are met"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
]


def templates(spark: SparkSession, notices: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """(template, license, text) of a list that is given as a parameter and is therefore small."""
    return spark.createDataFrame([(k, name, text) for k, (name, text) in enumerate(notices)], "template int, license string, text string")


def shingles(text: str) -> Column:
    """The hashes of a text's word shingles in order; texts of fewer than SHINGLE words have none.

    The words are bound as a lambda's variable: as a column, they would be worked out again for every shingle.
    """
    words = F.filter(F.split(F.regexp_replace(F.lower(F.col(f"`{text}`")), r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != "")

    def hashes(w: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(w) - SHINGLE)
        return F.when(F.size(w) >= SHINGLE, F.transform(places, lambda i: F.xxhash64(*[w[i + k] for k in range(SHINGLE)])))

    return F.coalesce(F.transform(F.array(words), hashes)[0], F.array().cast("array<bigint>"))


def bands(shingles: str) -> str:
    """SQL for the bands of an array of shingle hashes, as (band, value) structs."""
    return f"transform(sequence(1, {BANDS}), b -> struct(b AS band, array_min(transform({shingles}, x -> xxhash64(x, b))) AS value))"


def license_scan(docs: DataFrame, notices: DataFrame, id: str = "doc_id", text: str = "text", least: float = LEAST) -> DataFrame:
    """(id, license, template, containment): the templates of which some window of a document's text holds `least` or more.

    containment is the largest share of the template's distinct shingles in a window. Rows with the same id, null ids too,
    count as one document. Null, empty and short texts match nothing; a text in which a notice recurs gives one row for it.
    notices: (template, license, text), a parameter of bounded size; shorter templates than SHINGLE words are never found.
    """
    known = notices.select("template", "license", F.array_distinct(shingles("text")).alias("own")).where("size(own) > 0").withColumn("length", F.expr("cast(pow(2, ceil(log2(size(own)))) as int)")).cache()
    classes: dict[int, set[int]] = {}
    for r in known.select("length", "own").collect():  # the templates' shingles: bounded by the parameter
        classes.setdefault(r["length"], set()).update(r["own"])
    if not classes:
        return docs.select(F.col(f"`{id}`").alias(id), F.lit("").alias("license"), F.lit(0).alias("template"), F.lit(0.0).alias("containment")).limit(0)

    def any_of(values: set[int]):
        return F.array(*[F.lit(x) for x in sorted(values)])

    every = any_of(set().union(*classes.values()))
    # Through an explode of no or one array, shingles are worked out once for the test and for what follows.
    own = F.filter(F.array(shingles(text)), lambda s: F.arrays_overlap(s, every))
    hits = docs.select(F.col(f"`{id}`").alias("_id"), F.explode(own).alias("_shingles"))
    parts = [
        F.expr(f"transform(sequence(0, greatest(size(_shingles) - 1, 0), {n}), s -> struct({n} AS length, slice(_shingles, s + 1, {2 * n}) AS held))")
        for n in sorted(classes)
    ]
    windows = hits.select("_id", F.explode(F.concat(*parts)).alias("w")).select("_id", "w.length", "w.held")
    sharing = F.lit(False)
    for n, values in sorted(classes.items()):
        sharing = sharing | ((F.col("length") == n) & F.arrays_overlap("held", any_of(values)))
    retrieved = windows.where(sharing).withColumn("b", F.explode(F.expr(bands("held")))).select("*", "b.*").drop("b")
    keyed = known.withColumn("b", F.explode(F.expr(bands("own")))).select("*", "b.*").drop("b")
    share = F.size(F.array_intersect("held", "own")) / F.size("own")
    verified = retrieved.join(keyed, ["length", "band", "value"]).withColumn("containment", share).where(F.col("containment") >= least)
    return verified.groupBy("_id", "license", "template").agg(F.max("containment").alias("containment")).withColumnRenamed("_id", id)


def _oracle() -> str:
    """The same by exact containment in every window, without hashes or bands."""
    quoted = ", ".join("({}, '{}', '{}')".format(k, name, text.replace("'", "''")) for k, (name, text) in enumerate(TEMPLATES))
    words = "list_filter(string_split(regexp_replace(lower({}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' '), lambda w: w <> '')"
    grams = f"list_transform(range(0, greatest(len(w) - {SHINGLE - 1}, 0)), lambda i: array_to_string(w[i + 1:i + {SHINGLE}], ' '))"
    return f"""WITH t AS (SELECT template, license, list_distinct({grams}) AS own FROM (
    SELECT template, license, {words.format('text')} AS w FROM (VALUES {quoted}) v(template, license, text))),
  sized AS (SELECT *, CAST(pow(2, ceil(log2(len(own)))) AS INT) AS length FROM t WHERE len(own) > 0),
  d AS (SELECT doc_id, {grams} AS s FROM (SELECT doc_id, {words.format('text')} AS w FROM documents)),
  near AS (SELECT doc_id, s, license, template, own, length FROM d, sized WHERE list_has_any(s, own)),
  win AS (SELECT doc_id, license, template, own, s, length, unnest(range(0, len(s), length)) AS a FROM near),
  held AS (SELECT doc_id, license, template, CAST(len(list_intersect(s[a + 1:a + 2 * length], own)) AS DOUBLE) / len(own) AS c FROM win)
  SELECT doc_id, license, template, max(c) AS containment FROM held WHERE c >= {LEAST} GROUP BY 1, 2, 3"""


ORACLE = _oracle()
