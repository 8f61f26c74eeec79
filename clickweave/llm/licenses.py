"""License scan: TF-IDF cosine of lines to templates, then inheritance along directories (DataFrame operations only).

Notices are wrapped, so what is compared are headers, all runs of up to
``HEADER_LINES`` neighbouring non-blank lines, and the whole text of a file
that is named like a license file.  Each is a term vector (lower-cased letter
and digit runs, weight tf * idf), with idf = ln((1 + N) / (1 + df)) + 1 over
all non-blank lines, for every term.  It states the license of the template
with the largest cosine, if that is at least ``THRESHOLD``.

Only headers that hold a deciding term are compared: for each template the
fewest rarest terms such that the rest of it is shorter than THRESHOLD times
the whole; a header without any of these cannot reach the threshold, so
nothing is lost.

A file's own license is that of its best header.  A license file is a file
named like one, or one in which lines that hold a deciding term, inside
stating headers, are at least half of the non-blank lines; it speaks for its
directory (most license files first, then the best cosine, then the name).  A
file without its own license inherits from its nearest ancestor directory
that has one.

Defined results: null texts have no lines; a null path is a file in the root;
rows repeated under one path are one file with the lines of all; ties go to
the license that sorts first; an empty table gives an empty result; other
columns are not read.

Scale: the texts stay where they are; the lines of every term are counted by
a grouped count (one row per term and task is shuffled), cut to the terms of
candidate headers (at most ten for each line with a deciding term); their
terms, directories and narrow file rows are shuffled.  Directories are expanded to ancestors once per directory, not per
file.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickweave.llm.common import prepare, text_or_empty, written

THRESHOLD = 0.6
#: Lines of a header at most.
HEADER_LINES = 4
LICENSE_FILE = r"(?i)^(un)?licen[sc]e|^copying|^notice"
#: Statements to compare with (license name, text); fixed values.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                     "following conditions are met:"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
            "that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, '
            "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
            "furnished to do so, subject to the following conditions:"),
    ("MPL-2.0", "This file is subject to the terms of the Mozilla Public License, version 2.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)
#: Rows of a directory table that are broadcast at most.
BROADCAST_DIRECTORIES = 100_000
#: Terms of candidate lines that are broadcast with their weights at most.
BROADCAST_TERMS = 100_000


def template_terms(text: str) -> list[str]:
    return [t for t in re.split(r"[^\w]|_", text.lower()) if t]


def _terms(line: Column) -> Column:
    return F.filter(F.split(F.lower(line), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def _headers(deciding: Column) -> Column:
    """Of the columns ``lines``, ``marked`` (numbers of lines with a deciding term) and ``path``: the headers that hold a
    marked line, and the whole text of a license file, as (terms, marked lines in it)."""
    n, most = F.size("lines"), F.lit(HEADER_LINES)

    def around(h: Column) -> Column:  # start and size as one number, which array_distinct hashes
        return F.flatten(F.transform(F.sequence(F.lit(1), F.least(most, n)), lambda size: F.transform(
            F.sequence(F.greatest(h - size + 1, F.lit(0)), F.least(h, n - size)),
            lambda at: at.cast("long") * (HEADER_LINES + 1) + size)))

    def header(at: Column, size: Column) -> Column:
        return F.struct(
            _terms(F.concat_ws(" ", F.slice("lines", at + 1, size))).alias("terms"),
            F.filter(F.sequence(at, at + size - 1), lambda i: F.arrays_overlap(_terms(F.get("lines", i)), deciding)).alias("marked"))

    runs = F.transform(F.array_distinct(F.flatten(F.transform("marked", around))), lambda c: header(
        F.call_function("div", c, F.lit(HEADER_LINES + 1)).cast("int"), (c % (HEADER_LINES + 1)).cast("int")))
    whole = F.transform(F.filter(F.array(n), lambda size: (size > most) & _file_name().rlike(LICENSE_FILE)), lambda size: header(F.lit(0), size))
    return F.concat(runs, whole)


def _file_name() -> Column:
    return F.element_at(F.split("path", "/"), -1)


def deciding_terms(vectors: list[dict[str, float]], threshold: float, rarity: dict[str, float] | None = None) -> set[str]:
    """For unit vectors: the rarest terms until the rest is shorter than the threshold.

    Without ``rarity`` the heaviest are taken for the rarest; a common word that a template repeats is heavy as well.
    """
    out: set[str] = set()
    for v in vectors:
        rest = 1.0
        for term, w in sorted(v.items(), key=lambda x: (-(rarity[x[0]] if rarity else x[1]), x[0])):
            if rest < threshold ** 2 - 1e-12:
                break
            out.add(term)
            rest -= w * w
    return out


def scan(files: DataFrame, path: Column, text_col: str = "text", id_col: str = "doc_id", templates=TEMPLATES,
         threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, path, license, basis, own_license, score, inherited_license, inherited_from``, one row per input row.

    ``basis`` is "text", "directory" or null."""
    spark = prepare(files.sparkSession)
    rows = files.select(F.col(id_col).alias("doc_id"), F.coalesce(path.cast("string"), F.lit("")).alias("path"), text_or_empty(text_col).alias("t"))
    lines = F.filter(F.split("t", "\n"), lambda x: F.length(F.trim(x)) > 0)

    counted = [Counter(template_terms(t)) for _, t in templates]
    vocabulary = sorted(set().union(*counted))
    each = rows.select(F.explode(lines).alias("line"))
    df = written(each.select(F.explode(F.array_distinct(F.concat(F.array(F.lit("")), _terms(F.col("line"))))).alias("term")).groupBy("term").agg(
        F.count("*").alias("df")), "license-df")
    seen = {r.term: r.df for r in df.filter(F.col("term").isin(["", *vocabulary])).collect()}  # one row per template term, and "" for all lines
    n = seen.get("", 0)
    idf = {t: math.log((1 + n) / (1 + seen.get(t, 0))) + 1 for t in vocabulary}
    raw = [{t: c * idf[t] for t, c in count.items()} for count in counted]
    unit = [{t: w / math.sqrt(sum(x * x for x in v.values())) for t, w in v.items()} for v in raw]

    deciding = F.array(*[F.lit(t) for t in sorted(deciding_terms(unit, threshold, idf))])
    marked = F.filter(F.transform(lines, lambda x, i: F.when(F.arrays_overlap(_terms(x), deciding), i)), lambda i: i.isNotNull())
    holding = rows.select("path", lines.alias("lines"), marked.alias("marked")).filter(F.size("marked") > 0)
    numbered = holding.select("path", F.monotonically_increasing_id().alias("row_id"), F.size("lines").alias("n_lines"), _headers(deciding).alias("headers"))
    headers = numbered.select("path", "row_id", "n_lines", F.explode("headers").alias("x"))
    candidates = written(headers.select("path", "row_id", "n_lines", "x.terms", "x.marked", F.monotonically_increasing_id().alias("line_id")), "license-headers")

    template = spark.createDataFrame([(name, i, t, w) for i, ((name, _), v) in enumerate(zip(templates, unit, strict=True)) for t, w in v.items()],
                                     "license string, template int, term string, w double")
    tf = written(candidates.select("line_id", F.explode("terms").alias("term")).groupBy("line_id", "term").agg(F.count("*").alias("tf")), "license-tf")
    weights = written(df.join(tf.select("term").distinct(), "term", "left_semi").select(
        "term", (F.log(F.lit(1.0 + n) / (F.col("df") + 1)) + 1).alias("idf")), "license-idf")
    tf = written(tf.join(F.broadcast(weights) if weights.count() <= BROADCAST_TERMS else weights, "term").select(
        "line_id", "term", (F.col("tf") * F.col("idf")).alias("x")), "license-terms")
    norm = tf.groupBy("line_id").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    dot = tf.join(F.broadcast(template), "term").groupBy("line_id", "license", "template").agg(F.sum(F.col("x") * F.col("w")).alias("dot"))
    cosine = dot.join(norm, "line_id").select("line_id", "license", F.round(F.col("dot") / F.col("norm"), 9).alias("score")).filter(F.col("score") >= threshold)
    # the largest cosine, then the license that sorts first
    best = cosine.groupBy("line_id").agg(F.max("score").alias("score"), F.min_by("license", F.struct(-F.col("score"), F.col("license"))).alias("license"))
    stated = written(candidates.select("line_id", "row_id", "path", "n_lines", "marked").join(best, "line_id"), "license-stated")
    hits = stated.select("path", "row_id", F.explode("marked").alias("line")).distinct().groupBy("path").agg(F.count("*").alias("hits"))

    own = written(stated.groupBy("path").agg(
        F.min_by(F.struct("license", "score"), F.struct(-F.col("score"), F.col("license"))).alias("own"),
        F.max("n_lines").alias("n_lines")).join(hits, "path").select("path", "own.license", "own.score", "hits", "n_lines"), "license-own")
    folder = F.regexp_replace("path", "/?[^/]*$", "")
    files_of_dirs = own.filter(_file_name().rlike(LICENSE_FILE) | (2 * F.col("hits") >= F.col("n_lines"))).select(folder.alias("dir"), "license", "score")
    votes = files_of_dirs.groupBy("dir", "license").agg(F.count("*").alias("files"), F.max("score").alias("score"))
    speaks = written(votes.groupBy("dir").agg(F.min_by("license", F.struct(-F.col("files"), -F.col("score"), F.col("license"))).alias("license")), "license-dirs")

    base = rows.select("doc_id", "path", folder.alias("dir"))
    parts = F.split("dir", "/")
    ancestors = base.select("dir").distinct().select("dir", F.explode(F.when(F.col("dir") == "", F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.size(parts)))).alias("depth"))
    ancestors = ancestors.withColumn("up", F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/"))
    inherited = ancestors.join(speaks.withColumnRenamed("dir", "up"), "up").groupBy("dir").agg(
        F.max_by(F.struct("license", "up"), "depth").alias("from"))
    inherited = written(inherited.select("dir", F.col("from.license").alias("inherited_license"), F.col("from.up").alias("inherited_from")), "license-inherited")
    few = inherited.count() <= BROADCAST_DIRECTORIES
    own = own.select("path", F.col("license").alias("own_license"), "score")
    out = base.join(F.broadcast(own) if own.count() <= BROADCAST_DIRECTORIES else own, "path", "left").join(
        F.broadcast(inherited) if few else inherited, "dir", "left")
    basis = F.when(F.col("own_license").isNotNull(), "text").when(F.col("inherited_license").isNotNull(), "directory")
    return out.select("doc_id", "path", F.coalesce("own_license", "inherited_license").alias("license"), basis.alias("basis"),
                      "own_license", "score", "inherited_license", "inherited_from")
