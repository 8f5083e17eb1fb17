"""Licence scan of files: TF-IDF cosine to templates, then inheritance along directories.

Every line of a file, its leading comment and the whole file are blocks. A block is a sparse
vector over the terms of the templates: term frequency times inverse document frequency,
counted over all files; a term that no template has adds its frequency, with weight one, to the
block's length only. A file's own licence is that of the template with the highest cosine over its
blocks, if that is at least ``least``; of equals, the first by name.

Only blocks that can reach ``least`` are scored: the cosine is at most the length of the part
of the template's unit vector whose terms the block has. A block without any of a template's
required terms, its heaviest ones, cannot reach ``least``; of those that have one, the bound itself
is computed. So the filters drop no match.

A file without a licence of its own gets that of the nearest directory above it that declares
one. A directory declares the licence of its first licence file by path (``declares="named"``), or
of its first file with a licence of its own (``declares="first"``, for trees without such files).

Everything is built-in functions. Templates and their terms are a list the caller gives, of fixed
size, and are broadcast; nothing else is.

Nulls: a null text has no licence of its own, a null path is in the root directory. Rows of
one path are scored as one file, and each gets the result. An empty table gives an empty result.
Columns other than the path and the text are ignored.
"""

import math
import re

from pyspark.sql import functions as F

from tidegauge.llm.common import keep

TERM = r"[a-z0-9]+(?:\.[0-9]+)*"
LEAST = 0.75
# Names of licence files, and notices of common licences by SPDX identifier.
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|unlicense|notice)([-_.][^/]*)?$"
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use "
                   "this file except in compliance with the License."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the "
                "terms of the GNU General Public License as published by the Free Software "
                "Foundation, either version 3 of the License"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, "
                "v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without "
                     "modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International "
                  "License."),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated all copyright to the "
                "public domain under CC0 1.0."),
)
_COMMENT = r"^(?:[ \t]*(?:#|//|/\*|\*|;|--|<!--|%)[^\n]*(?:\n|$))+"


def terms_of(text):
    """Term counts of a template."""
    counts = {}
    for term in re.findall(TERM, text.lower()):
        counts[term] = counts.get(term, 0) + 1
    return counts


def _terms(text):
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def document_frequencies(files, vocabulary, text="text"):
    """({term: files that have it}, files) for the terms of the templates."""
    known = F.array(*[F.lit(t) for t in sorted(vocabulary)])
    found = files.select(F.explode(F.array_append(
        F.array_intersect(_terms(F.coalesce(F.col(text), F.lit(""))), known), F.lit(""))).alias(
        "term")).groupBy("term").count().collect()  # one row for each term, and one for the files
    df = {r["term"]: r["count"] for r in found}
    return df, df.pop("", 0)


def weights(templates, df, n_files):
    """idf of each term, and (licence, template number, {term: weight of a unit vector})."""
    idf, vectors = {}, []
    for number, (licence, text) in enumerate(templates):
        counts = terms_of(text)
        for term in counts:
            idf[term] = math.log((1 + n_files) / (1 + df.get(term, 0))) + 1
        size = math.sqrt(sum((n * idf[t]) ** 2 for t, n in counts.items()))
        vectors.append((licence, number, {t: n * idf[t] / size for t, n in counts.items()}))
    return idf, vectors


def required(vectors, least=LEAST):
    """Terms of which a block needs one to reach ``least`` with any template."""
    found = set()
    for _, _, vector in vectors:
        left = 1.0
        for term in sorted(vector, key=lambda t: (-vector[t], t)):
            if math.sqrt(max(0.0, left)) < least - 1e-9:
                break
            found.add(term)
            left -= vector[term] ** 2
    return found


def reach(body, vectors):
    """The largest bound of the square of a block's cosine to a template, from its terms."""
    bounds = [sum((F.when(F.contains(body, F.lit(t)), F.lit(w * w)).otherwise(F.lit(0.0))
                   for t, w in sorted(vector.items())), F.lit(0.0)) for _, _, vector in vectors]
    return F.greatest(F.lit(0.0), *bounds)


def own_licences(files, templates=TEMPLATES, least=LEAST, path="path", text="text"):
    """(path, licence, score) of the files with a licence of their own."""
    spark = files.sparkSession
    vocabulary = set().union(*(terms_of(t) for _, t in templates))
    df, n_files = document_frequencies(files, vocabulary, text)
    idf, vectors = weights(templates, df, n_files)
    # As whole terms: their letters are in many other words.
    needed = "(?<![a-z0-9])(?:" + "|".join(
        re.escape(t) for t in sorted(required(vectors, least))) + ")(?![a-z0-9])"
    possible = files.select(F.col(path).alias("path"), F.col(text).alias("text")).filter(
        F.lower(F.col("text")).rlike(needed))
    line = F.filter(F.split("text", "\n"), lambda x: F.lower(x).rlike(needed))
    comment = F.regexp_extract("text", _COMMENT, 0)
    blocks = possible.select("path", F.posexplode(F.array_distinct(F.concat(
        line, F.array(comment, F.col("text"))))).alias("block", "body")).filter(
        reach(F.lower("body"), vectors) >= least ** 2 - 1e-9)
    counted = blocks.select("path", "block", F.explode(_terms(F.col("body"))).alias("term")) \
        .groupBy("path", "block", "term").agg(F.count(F.lit(1)).alias("tf"))
    known = F.broadcast(spark.createDataFrame(
        [(t, w, [(licence, n, v[t]) for licence, n, v in vectors if t in v])
         for t, w in idf.items()],
        "term string, idf double, uses array<struct<licence:string,template:int,weight:double>>"))
    parts = counted.join(known, "term", "left").withColumn(
        "value", F.col("tf") * F.coalesce("idf", F.lit(1.0)))
    # The block's length is carried by a use of its own, under no template.
    square = F.struct(F.lit(None).cast("string").alias("licence"), F.lit(-1).alias("template"),
                      F.col("value").alias("weight"))
    uses = parts.select("path", "block", "value", F.explode(F.array_append(
        F.coalesce("uses", F.array().cast(
            "array<struct<licence:string,template:int,weight:double>>")), square)).alias("use"))
    sums = uses.groupBy("path", "block", "use.licence", "use.template").agg(
        F.sum(F.col("value") * F.col("use.weight")).alias("dot"))
    per_block = sums.groupBy("path", "block").agg(
        F.max(F.when(F.col("template") < 0, F.col("dot"))).alias("square"),
        F.min(F.when(F.col("template") >= 0, F.struct(
            (-F.col("dot")).alias("dot"), F.col("licence").alias("licence")))).alias("best"))
    scored = per_block.filter("best is not null").select(
        "path", F.round(-F.col("best.dot") / F.sqrt("square"), 9).alias("score"), "best.licence")
    return scored.filter(F.col("score") >= least).groupBy("path").agg(F.min(F.struct(
        (-F.col("score")).alias("score"), F.col("licence"))).alias("best")).select(
        "path", "best.licence", (-F.col("best.score")).alias("score"))


def _directory(path):
    """The directory of a path; the root is the empty string."""
    return F.coalesce(F.regexp_extract(path, "^(.*)/[^/]*$", 1), F.lit(""))


def inherited(directories, declared):
    """(dir, licence, from_path, distance) of directories with a declaration at or above them.

    Only directories are joined with the directories above them, not files.
    """
    parts = F.when(F.col("dir") == "", F.array().cast("array<string>")).otherwise(
        F.split("dir", "/"))
    depth = F.size("parts")
    above = directories.select("dir", parts.alias("parts")).select(
        "dir", F.explode(F.sequence(F.lit(0), depth)).alias("distance"), "parts").select(
        "dir", "distance", F.array_join(F.slice("parts", 1, depth - F.col("distance")),
                                        "/").alias("_above"))
    met = above.join(declared.withColumnRenamed("dir", "_above"), "_above")
    return met.groupBy("dir").agg(F.min(F.struct(
        "distance", "from_path", "licence")).alias("near")).select(
        "dir", "near.licence", "near.from_path", "near.distance")


def scan(files, templates=TEMPLATES, least=LEAST, path="path", text="text", declares="named"):
    """(path, licence, score, origin, from_path, distance) of each row of ``files``.

    ``origin`` is own, inherited or none; ``distance`` is the number of directories between
    the file's directory and the one that declares.
    """
    if declares not in ("named", "first"):
        raise ValueError("declares is 'named' or 'first'")
    own = keep(own_licences(files, templates, least, path, text), "licences-own")
    placed = own.withColumn("dir", _directory(F.col("path")))
    if declares == "named":
        placed = placed.filter(F.col("path").rlike(LICENCE_FILE))
    declared = keep(placed.groupBy("dir").agg(F.min(F.struct(
        F.col("path").alias("from_path"), "licence")).alias("d")).select(
        "dir", "d.from_path", "d.licence"), "licences-declared")
    paths = keep(files.select(F.col(path).alias("path"), _directory(F.col(path)).alias("dir")),
                 "licences-paths")
    near = keep(inherited(paths.select("dir").distinct(), declared), "licences-near").select(
        "dir", F.col("licence").alias("above"), "from_path", "distance")
    whole = paths.join(own, "path", "left").join(near, "dir", "left")
    has_own, has_above = F.col("licence").isNotNull(), F.col("above").isNotNull()
    return whole.select(
        F.col("path").alias(path), F.coalesce("licence", "above").alias("licence"), "score",
        F.when(has_own, "own").when(has_above, "inherited").otherwise("none").alias("origin"),
        F.when(has_own, F.col("path")).otherwise(F.col("from_path")).alias("from_path"),
        F.when(~has_own, F.col("distance")).alias("distance"))
