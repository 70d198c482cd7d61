"""Licence scans by sparse TF-IDF cosine, and inheritance from directories.

Lines that mention licensing are compared with templates of licence notices: term
frequencies times inverse document frequencies, the cosine by a join on terms. Only
different lines are compared, each once; frequencies count every line of all documents.
A file without a licence of its own inherits that of the nearest directory above it that
holds a licence file, by a join on the paths of its ancestors.

Everything is DataFrame code. Only the templates are broadcast; their number is fixed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.llm import frames
from tapeworks.llm.line_runs import split_lines

MENTION = r"(?i)licen[cs]e|copyright|spdx|permission is hereby granted|redistribution and use"
LICENCE_NAME = r"(?i)^(?:licen[cs]es?|copying|unlicense)(?:[.-].*)?$"
TERM = "[a-z0-9]+(?:[.-][a-z0-9]+)*"
#: A line is under the licence of its nearest template from this cosine on.
LEAST_COSINE = 0.6
DIGITS = 6

# The usual notices of common licences.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Apache License Version 2.0 terms and conditions for use, reproduction, and distribution"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "Released into the public domain under CC0 1.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)


def terms(text: Column) -> Column:
    return F.regexp_extract_all(frames.ascii_lower(text), F.lit(TERM), F.lit(0))


def _counted(texts: DataFrame, keys: list[str]) -> DataFrame:
    return (
        texts.select(*keys, F.explode(terms(F.col("unit"))).alias("term"))
        .groupBy(*keys, "term")
        .agg(F.count("*").alias("tf"))
    )


def judged(units: DataFrame, templates: tuple = TEMPLATES) -> DataFrame:
    """(unit, licence, cosine) of each different ``unit``: its nearest template.

    Of equally near licences the first by name counts. A unit that shares no term with a
    template is left out.
    """
    spark = units.sparkSession
    weighted = frames.stored(units.groupBy("unit").agg(F.count("*").alias("times")), "units")
    counted = frames.stored(_counted(weighted, ["unit", "times"]), "unit-terms")
    every = weighted.agg(F.coalesce(F.sum("times"), F.lit(0)).alias("n"))
    spread = counted.groupBy("term").agg(F.sum("times").alias("df"))
    n = every.first()["n"]
    idf = F.ln((1 + F.lit(n)) / (1 + F.coalesce("df", F.lit(0)))) + 1
    known = _templates(spark, templates)
    template_terms = _counted(known, ["number", "licence"])
    # The templates' terms alone, whatever the size of the corpus.
    of_template = frames.stored(
        template_terms.join(
            spread.join(F.broadcast(template_terms.select("term").distinct()), "term"),
            "term",
            "left",
        ).select("number", "licence", "term", (F.col("tf") * idf).alias("template_weight")),
        "template-weights",
    )
    of_unit = counted.join(spread, "term").select("unit", "term", (F.col("tf") * idf).alias("weight"))
    squares = of_unit.groupBy("unit").agg(F.sum(F.col("weight") * F.col("weight")).alias("square"))
    template_squares = of_template.groupBy("number").agg(
        F.sum(F.col("template_weight") * F.col("template_weight")).alias("template_square")
    )
    products = (
        of_unit.join(F.broadcast(of_template), "term")
        .groupBy("unit", "number", "licence")
        .agg(F.sum(F.col("weight") * F.col("template_weight")).alias("product"))
    )
    cosine = F.round(F.col("product") / F.sqrt(F.col("square") * F.col("template_square")), DIGITS)
    nearest = F.min(F.struct((-F.col("cosine")).alias("cosine"), "licence"))
    return (
        products.join(squares, "unit")
        .join(F.broadcast(template_squares), "number")
        .withColumn("cosine", cosine)
        .groupBy("unit")
        .agg(nearest.alias("nearest"))
        .select("unit", "nearest.licence", (-F.col("nearest.cosine")).alias("cosine"))
    )


def _templates(spark: SparkSession, templates: tuple) -> DataFrame:
    rows = [(number, licence, text) for number, (licence, text) in enumerate(templates)]
    return spark.createDataFrame(rows, "number int, licence string, unit string")


def parent(path: Column) -> Column:
    return F.when(path.contains("/"), F.regexp_replace(path, "/[^/]*$", "")).otherwise(
        F.when(path.isNotNull(), F.lit(""))
    )


def ancestors(directory: Column) -> Column:
    """The directory and all above it with their depths; the root is the empty path."""
    parts = F.split(directory, "/", -1)
    return F.transform(
        F.sequence(F.lit(0), F.size(parts)),
        lambda k: F.struct(
            k.alias("depth"), F.array_join(F.slice(parts, F.lit(1), k), "/").alias("directory")
        ),
    )


def scanned(
    docs: DataFrame,
    path: Column,
    templates: tuple = TEMPLATES,
    least_cosine: float = LEAST_COSINE,
) -> DataFrame:
    """(row_key, doc_id, path, licence, cosine, origin, licence_dir) per row of ``docs``.

    The whole text is read. ``origin`` is "own" or "inherited", NULL where there is neither;
    ``licence_dir`` is the directory inherited from. A licence file is one of such a name,
    whose whole text is compared too, or one at least half of whose characters stand in
    lines that mention licensing; if a directory has several, the nearest to a template
    counts. NULL and empty texts have no licence of their own; a NULL path has no
    directory. Repeated rows have equal results. An empty table gives no rows.
    """
    text = frames.whole_text()
    none = F.array().cast("array<string>")
    mentions = F.when(
        text.rlike(MENTION), F.filter(split_lines(text), lambda line: line.rlike(MENTION))
    ).otherwise(none)
    named = F.coalesce(F.regexp_extract(path, "[^/]*$", 0).rlike(LICENCE_NAME), F.lit(False))
    mentioned = F.aggregate("mentions", F.lit(0), lambda n, line: n + F.length(line))
    rows = frames.stored(
        docs.select(
            frames.row_key().alias("row_key"),
            "doc_id",
            path.alias("path"),
            mentions.alias("mentions"),
            F.length(text).alias("chars"),
            named.alias("named"),
            F.when(named, text).alias("whole"),
        )
        .withColumn(
            "is_licence_file",
            F.col("named") | ((F.size("mentions") > 0) & (mentioned * 2 >= F.col("chars"))),
        )
        .select(
            "row_key", "doc_id", "path", parent(F.col("path")).alias("directory"), "is_licence_file",
            F.when(F.col("named"), F.concat("mentions", F.array("whole")))
            .otherwise(F.col("mentions")).alias("units"),
        ),
        "licence-rows",
    )
    units = rows.select("row_key", "directory", "is_licence_file", F.explode("units").alias("unit"))
    # Stored, so that the join with it may split the rows of a frequent line.
    nearest = frames.stored(
        judged(units, templates).filter(F.col("cosine") >= least_cosine), "judged"
    )
    best = F.min(F.struct((-F.col("cosine")).alias("cosine"), "licence"))
    found = units.join(nearest, "unit")
    own = frames.stored(found.groupBy("row_key").agg(best.alias("own")), "own-licences")
    of_directory = (
        found.filter("is_licence_file AND directory IS NOT NULL")
        .groupBy("directory")
        .agg(best.alias("given"))
    )
    without = rows.select("row_key", "doc_id", "path", "directory").join(own, "row_key", "left")
    asking = without.filter("own IS NULL AND directory IS NOT NULL").select("directory").distinct()
    above = asking.select(
        F.col("directory").alias("asking"), F.explode(ancestors(F.col("directory"))).alias("above")
    ).select("asking", "above.*")
    inherited = frames.stored(
        above.join(of_directory, "directory")
        .groupBy("asking")
        .agg(F.max_by(F.struct("given", "directory"), "depth").alias("from"))
        .select(
            F.col("asking").alias("directory"),
            F.col("from.given").alias("given"),
            F.col("from.directory").alias("licence_dir"),
        ),
        "inherited",
    )
    judged_rows = without.join(inherited, "directory", "left")
    is_own = F.col("own").isNotNull()
    taken = F.coalesce("own", "given")
    return judged_rows.select(
        "row_key",
        "doc_id",
        "path",
        taken["licence"].alias("licence"),
        (-taken["cosine"]).alias("cosine"),
        F.when(is_own, "own").when(F.col("given").isNotNull(), "inherited").alias("origin"),
        F.when(~is_own, F.col("licence_dir")).alias("licence_dir"),
    )
