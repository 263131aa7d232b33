"""License scan with DataFrame operations only: TF-IDF cosine of lines and licence files
to templates, then inheritance from the nearest ancestor directory by path joins."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evallens.llm.common import stored

# Licence names and the usual wording of their notices.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at apache.org"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]

LICENSE_FILE = r"(?i)^(un)?licen[cs]e([.-].*)?$|^copying([.-].*)?$"


def terms(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def _segments(files: DataFrame) -> DataFrame:
    """(file_id, path, seg, words): every line of every file, and the whole text of licence files (seg -1)."""
    name = F.element_at(F.split("path", "/"), -1)
    lines = F.split("text", r"\n")
    part = lambda seg, s: F.struct(seg.cast("int").alias("seg"), s.alias("s"))
    whole = F.coalesce(name.rlike(LICENSE_FILE), F.lit(False)) & (F.size(lines) > 1)
    parts = F.concat(F.transform(lines, lambda s, i: part(i, s)),
                     F.when(whole, F.array(part(F.lit(-1), F.col("text")))).otherwise(F.array().cast("array<struct<seg:int,s:string>>")))
    rows = files.where(F.col("text").isNotNull()).select("file_id", "path", F.explode(parts).alias("p"))
    return rows.select("file_id", "path", "p.seg", terms(F.col("p.s")).alias("words")).where(F.size("words") > 0)


def scan(files: DataFrame, threshold: float = 0.6, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """License of each file, its own or its directory's.

    `files` (file_id, path, text).  Returns one row per row: file_id, path,
    own_license and own_score (best template of a line, or of the whole text of a
    licence file, with a TF-IDF cosine of at least `threshold`; ties: first name),
    license (own, else that of the licence file in the nearest directory upwards),
    license_dir (where an inherited one was found).  Document frequencies count
    every line of all files, for all terms.  Only lines that hold a term without
    which no template can reach the threshold are scored.  NULL text: no own
    licence; NULL path: no directory; rows that repeat an id and path are each
    returned; several licence files in a directory: the best score.  Empty input:
    no rows.  Other columns are not read.
    """
    spark = files.sparkSession
    files = files.select(F.col("file_id").cast("long").alias("file_id"), F.col("path").cast("string").alias("path"), F.col("text").cast("string").alias("text"))
    t = spark.createDataFrame([(i, n, x) for i, (n, x) in enumerate(templates or TEMPLATES)], "template int, license string, text string")
    t_terms = t.select("template", "license", F.explode(terms(F.col("text"))).alias("term")).groupBy("template", "license", "term").agg(F.count(F.lit(1)).alias("tf"))
    t_rows = sorted((r.template, r.license, r.term, r.tf) for r in t_terms.collect())
    vocabulary = sorted({r[2] for r in t_rows})

    segs = _segments(files)
    lit = lambda xs: F.array(*[F.lit(x) for x in xs])
    # Term "" counts the lines.  A term of one line only is left out: its frequency is known to be 1.
    seen = segs.select(F.explode(F.concat(F.array(F.lit("")), F.array_distinct("words"))).alias("term"))
    own_terms = F.col("term").isin(["", *vocabulary])
    counts = stored(seen.groupBy("term").agg(F.count(F.lit(1)).alias("df")).where((F.col("df") > 1) | own_terms), "license-terms")
    df = dict(counts.where(own_terms).collect())  # one row per template term
    n = df.get("", 0)
    idf = {w: math.log((n + 1) / (df.get(w, 0) + 1)) + 1 for w in vocabulary}
    weight = {(i, w): (1 + math.log(tf)) * idf[w] for i, _, w, tf in t_rows}
    # Per template, the fewest terms whose absence keeps every line below the threshold.
    needed, norm = set(), {}
    for i in {r[0] for r in t_rows}:
        own = sorted(((v * v, w) for (j, w), v in weight.items() if j == i), reverse=True)
        norm[i] = math.sqrt(sum(x for x, _ in own))
        rest = norm[i] ** 2
        for x, w in own:
            if math.sqrt(max(rest, 0)) < (threshold - 1e-9) * norm[i]:
                break
            needed.add(w)
            rest -= x
    lines = segs.where(F.arrays_overlap("words", lit(sorted(needed))))
    tf = lines.select("file_id", "path", "seg", F.explode("words").alias("term")).groupBy("file_id", "path", "seg", "term").agg(F.count(F.lit(1)).alias("tf"))
    names = dict(r[:2] for r in t_rows)
    known = spark.createDataFrame([(w, *[float(weight.get((i, w), 0) / norm[i]) for i in names]) for w in vocabulary],
                                  ", ".join(["term string", *[f"t{i} double" for i in names]]))
    w = (1 + F.log(F.col("tf").cast("double"))) * (F.log(F.lit(float(n + 1)) / (F.coalesce("df", F.lit(1)) + 1)) + 1)
    tf = tf.join(counts, "term", "left").join(F.broadcast(known), "term", "left").withColumn("w", w)  # known: one row per template term
    dots = tf.groupBy("file_id", "path", "seg").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("len"),
                                                    *[F.coalesce(F.sum(F.col("w") * F.col(f"t{i}")), F.lit(0.0)).alias(f"d{i}") for i in names])
    best = F.array_min(F.array(*[F.struct((-F.round(F.col(f"d{i}") / F.col("len"), 6)).alias("neg"), F.lit(n_).alias("license")) for i, n_ in names.items()]))
    scored = dots.select("file_id", "path", best.alias("b")).where(-F.col("b.neg") >= threshold)
    scored = scored.select("file_id", "path", "b.license", (-F.col("b.neg")).alias("score"))
    own = scored.groupBy("file_id", "path").agg(F.min(F.struct((-F.col("score")).alias("neg"), "license")).alias("b"))
    own = stored(own.select("file_id", "path", F.col("b.license").alias("own_license"), (-F.col("b.neg")).alias("own_score")), "license-own")

    same = lambda a, b, cols: [a[c].eqNullSafe(b[c]) for c in cols]
    folder = F.regexp_replace("path", r"/?[^/]*$", "")
    named = own.where(F.element_at(F.split("path", "/"), -1).rlike(LICENSE_FILE)).withColumn("dir", folder)
    dirs = named.groupBy("dir").agg(F.min(F.struct((-F.col("own_score")).alias("neg"), "own_license")).alias("b"))
    dirs = dirs.select(F.col("dir").alias("license_dir"), F.col("b.own_license").alias("dir_license"))
    parts = F.split("dir", "/")
    steps = F.concat(F.lit(""), F.array_join(F.slice(parts, 1, F.col("depth")), "/"))
    up = (files.where(F.col("path").isNotNull()).select(folder.alias("dir")).distinct()
          .select("dir", F.explode(F.sequence(F.lit(0), F.size(parts))).alias("depth")).select("dir", "depth", steps.alias("license_dir")))
    near = up.join(dirs, "license_dir").groupBy("dir").agg(F.max(F.struct("depth", "license_dir", "dir_license")).alias("b"))
    near = near.select("dir", "b.license_dir", "b.dir_license")
    f = files.select("file_id", "path", folder.alias("dir"))
    out = f.join(own, same(f, own, ["file_id", "path"]), "left").select(f["file_id"], f["path"], "dir", "own_license", "own_score").join(near, "dir", "left")
    mine = F.col("own_license").isNotNull()
    return out.select("file_id", "path", "own_license", "own_score", F.coalesce("own_license", "dir_license").alias("license"),
                      F.when(~mine, F.col("license_dir")).alias("license_dir"))
