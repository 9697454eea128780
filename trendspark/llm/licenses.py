"""License scan by sparse TF-IDF cosine, with inheritance along directories.

A file's own license comes from its header lines or, if it is a license file, from its
whole text: the cosine of TF-IDF vectors to templates decides. A file without one takes that of
the license file in the nearest directory above it. DataFrame functions only.

Only lines that hold an anchor term are compared. The anchors of a template are the terms
left when common words, then light ones, are taken out while their norm stays below the
threshold: a line without any anchor cannot reach the threshold, so nothing is lost.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendspark.llm.common import join_counted
from trendspark.staging import Scratch, stage

THRESHOLD = 0.7
# a file of which at least this share of words is license notices is a license file
FILE_SHARE = 0.5

# fixed values: customary notices of public licenses
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge"),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0"),
)
# fixed values: words that do not tell a notice from prose
COMMON_WORDS = frozenset("a an any and are by copy for from in is it of on or person that the this to under with work".split())
_TERM = re.compile(r"[a-z0-9]+")


def term_weights(templates: tuple[tuple[str, str], ...]) -> tuple[dict[str, float], float, list[dict[str, float]]]:
    """Inverse document frequencies of the templates' terms, that of any other term, and unit vectors."""
    counts = [Counter(_TERM.findall(text.lower())) for _, text in templates]
    seen = Counter(t for c in counts for t in c)
    idf = {t: math.log((1 + len(templates)) / (1 + n)) + 1 for t, n in seen.items()}
    vectors = []
    for c in counts:
        norm = math.sqrt(sum((n * idf[t]) ** 2 for t, n in c.items()))
        vectors.append({t: n * idf[t] / norm for t, n in c.items()})
    return idf, math.log(1 + len(templates)) + 1, vectors


def anchor_terms(vectors: list[dict[str, float]], threshold: float) -> list[str]:
    """Terms of which a text needs at least one to reach the threshold with any template.

    Any terms whose joint norm stays below the threshold may be left out; common words go
    first, as they would select most lines.
    """
    anchors: set[str] = set()
    for vector in vectors:
        left = 0.0
        for term, weight in sorted(vector.items(), key=lambda x: (x[0] not in COMMON_WORDS, x[1], x[0])):
            left += weight * weight
            if left >= threshold * threshold * (1 - 1e-9):
                anchors.add(term)
    return sorted(anchors)


def _with_best_template(lines: DataFrame, templates: tuple[tuple[str, str], ...]) -> DataFrame:
    """Add ``license`` and ``cosine`` of the best template to each row of ``lines``, by its ``line``.

    All arithmetic is in the row: terms are counted, weighted and compared by array functions, so no term leaves its row.
    """
    idf, other, vectors = term_weights(templates)
    entries = [
        {"rank": -i, "terms": [{"term": t, "weight": w} for t, w in sorted(v.items())]} for i, v in enumerate(vectors)
    ]
    shapes = "array<struct<rank:int,terms:array<struct<term:string,weight:double>>>>"
    known = F.from_json(F.lit(json.dumps(entries)), shapes)
    weights = F.from_json(F.lit(json.dumps(idf)), "map<string,double>")
    vocabulary = F.split(F.lit(" ".join(sorted(idf))), " ")
    terms = F.col("_terms")

    # the sum of squared counts, as 1 + 3 + 5 and so on along each run of the sorted terms
    start = F.struct(F.lit("").alias("term"), F.lit(0).cast("long").alias("run"), F.lit(0).cast("long").alias("total"))

    def count(state, term):
        run = F.when(state["term"] == term, state["run"] + 1).otherwise(F.lit(1).cast("long"))
        return F.struct(term.alias("term"), run.alias("run"), (state["total"] + 2 * run - 1).alias("total"))

    squares = F.when(F.size(F.array_distinct(terms)) == F.size(terms), F.size(terms).cast("long")).otherwise(
        F.aggregate(F.sort_array(terms), start, count, lambda state: state["total"])
    )
    counted = F.transform(
        F.array_intersect(terms, vocabulary),
        lambda t: F.struct(
            t.alias("term"),
            F.size(F.filter(terms, lambda x: x == t)).cast("long").alias("n"),
            F.try_element_at(weights, t).alias("idf"),
        ),
    )
    zero = F.lit(0.0)
    inside = F.aggregate("_counted", zero, lambda total, c: total + (c["n"] * c["idf"]) * (c["n"] * c["idf"]))
    rest = F.col("_squares") - F.aggregate("_counted", F.lit(0).cast("long"), lambda total, c: total + c["n"] * c["n"])
    values = F.map_from_entries(F.transform("_counted", lambda c: F.struct(c["term"], c["n"] * c["idf"])))

    def cosine(template):
        def add(total, entry):
            return total + F.coalesce(F.try_element_at(F.col("_values"), entry["term"]), zero) * entry["weight"]

        dot = F.aggregate(template["terms"], zero, add)
        return F.struct(F.round(dot / F.col("_norm"), 6).alias("cosine"), template["rank"].alias("rank"))

    names = F.array(*(F.lit(name) for name, _ in templates))
    return (
        lines.withColumn("_terms", F.filter(F.split(F.lower("line"), "[^a-z0-9]+"), lambda t: t != ""))
        .withColumns({"_squares": squares, "_counted": counted})
        .withColumns({"_norm": F.sqrt(inside + other * other * rest), "_values": values})
        .withColumn("_best", F.array_max(F.transform(known, cosine)))
        .withColumns({"license": F.element_at(names, 1 - F.col("_best.rank")), "cosine": F.col("_best.cosine")})
        .drop("_terms", "_squares", "_counted", "_norm", "_values", "_best")
    )


def scan_licenses(
    files: DataFrame,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    threshold: float = THRESHOLD,
    path_column: str = "path",
    text_column: str = "text",
) -> DataFrame:
    """``path, license, origin, cosine, from_path, levels`` of each distinct path.

    ``origin`` is ``header`` (a line of the file), ``file`` (a license file: at least half of its words
    are notices), ``inherited`` (of the best license file in the nearest directory above) or ``none``.
    ``cosine`` is that of the deciding text, ``levels`` the directories gone up from the file's own. Of several
    notices the most similar wins, then the earlier line; of several license files in a
    directory the most similar, then the first by path. Null and empty texts have no notice of their own but
    inherit; rows without a path are left out; repeated paths count as one file.
    """
    spark: SparkSession = files.sparkSession
    texts = files.select(F.col(path_column).cast("string").alias("path"), F.col(text_column).cast("string").alias("text")).where("path is not null")
    _, _, vectors = term_weights(templates)
    anchors = r"(?:^|[^a-z0-9])(?:" + "|".join(anchor_terms(vectors, threshold)) + r")(?:[^a-z0-9]|$)"
    with Scratch(spark, "licenses") as scratch:
        lines = texts.select("path", "text", F.posexplode(F.split("text", "\n")).alias("unit", "line")).where(F.lower("line").rlike(anchors))
        words = F.size(F.filter(F.split(F.lower("line"), "[^\\p{L}\\p{N}]+"), lambda w: w != ""))
        whole = F.size(F.filter(F.split("text", "[^\\p{L}\\p{N}]+"), lambda w: w != ""))
        compared = _with_best_template(lines.withColumns({"words": words, "whole": whole, "mark": F.xxhash64("line")}), templates)
        # written without texts: a filter on the cosine would be computed anew for each use of it
        compared = scratch.stage(compared.select("path", F.col("unit").alias("line"), "license", "cosine", "words", "whole", "mark"), "compared")
        notices = compared.where(F.col("cosine") >= threshold).distinct()
        own = scratch.stage(
            notices.groupBy("path").agg(
                F.max(F.struct("cosine", (-F.col("line")).alias("line"), "license")).alias("best"),
                (F.sum("words") >= FILE_SHARE * F.max("whole")).alias("is_file"),
            ).select("path", "best.license", "best.cosine", "is_file"),
            "own",
        )
        parent = F.regexp_replace("path", "/?[^/]*$", "")
        holders = (
            own.where("is_file")
            .select(parent.alias("directory"), "path", "license", "cosine")
            .groupBy("directory")
            .agg(F.max("cosine").alias("top"), F.min(F.struct((-F.col("cosine")).alias("low"), "path", "license")).alias("first"))
            .select("directory", F.col("first.path").alias("from_path"), F.col("first.license").alias("given"), F.col("top").alias("given_cosine"))
        )
        paths = texts.select("path").distinct().join(own, "path", "left")
        rest = scratch.stage(paths.where("license is null").select("path", parent.alias("directory")), "rest")
        # each directory above, from the nearest: looked up by directory, not by file
        parts = F.split("directory", "/")
        above = (
            rest.select("directory").distinct()
            .select("directory", F.posexplode(F.transform(F.sequence(F.size(parts), F.lit(0), F.lit(-1)), lambda n: F.concat_ws("/", F.slice(parts, F.lit(1), n)))).alias("levels", "ancestor"))
        )
        nearest = (
            above.join(holders.withColumnRenamed("directory", "ancestor"), "ancestor")
            .groupBy("directory")
            .agg(F.min(F.struct("levels", "from_path", "given", "given_cosine")).alias("near"))
        )
        directories = rest.groupBy("directory").agg(F.count("*").alias("n")).join(nearest, "directory", "left")
        inherited = join_counted(rest, scratch.stage(directories, "directories"), "directory", "n").select(
            "path",
            F.col("near.given").alias("license"),
            F.when(F.col("near").isNull(), "none").otherwise("inherited").alias("origin"),
            F.col("near.given_cosine").alias("cosine"),
            "near.from_path",
            "near.levels",
        )
        named = paths.where("license is not null").select(
            "path", "license", F.when(F.col("is_file"), "file").otherwise("header").alias("origin"), "cosine",
            F.col("path").alias("from_path"), F.lit(0).alias("levels"),
        )
        return stage(named.unionByName(inherited), "licenses")
