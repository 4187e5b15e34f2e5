"""Licence scans: texts compared with licence templates by the Dice coefficient of word bigrams.

Everything is built-in expressions. The whole text, its paragraphs and its lines are units; a unit
whose number of bigrams lies outside a template's bounds cannot reach the threshold and is pruned
before any bigram is compared. Bigrams of the rest meet the templates' in a broadcast join: the
templates are a fixed list, so its size is known.

`license_windows` finds notices that are no unit of their own: runs of consecutive words, wherever they
begin and end.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_and_text

# Notices and short licence texts as they are published.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0."],
    "Apache-2.0-notice": [
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License."
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        'and associated documentation files (the "Software"), to deal in the Software without '
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of "
        'the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR '
        "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE "
        "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies."
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version 3 "
        "of the License, or (at your option) any later version.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under the Creative Commons Attribution 4.0 International License.",
    ],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related rights to this work."],
}
THRESHOLD = 0.8


def normalised(text: Column) -> Column:
    """ASCII letters in lower case, digits and line ends; every other run is one space."""
    return F.regexp_replace(F.translate(text, ascii_uppercase, ascii_lowercase), "[^a-z0-9\n]+", " ")


def template_bigrams(text: str) -> Counter:
    words = re.sub("[^a-z0-9]+", " ", text.lower()).split()
    return Counter(f"{a} {b}" for a, b in zip(words, words[1:]))


def size_bounds(size: int, threshold: float) -> tuple[int, int]:
    """Numbers of bigrams that can reach the threshold with `size`: 2 min(a, b) / (a + b) >= t."""
    return (
        math.ceil(threshold * size / (2 - threshold) - 1e-9),
        math.floor(size * (2 - threshold) / threshold + 1e-9),
    )


def template_rows(spark: SparkSession, templates: dict[str, list[str]], threshold: float) -> DataFrame:
    """A row per distinct bigram of each template: how often it has it, its number of bigrams,
    and the bounds of a unit's."""
    rows, number = [], 0
    for name, texts in templates.items():
        for text in texts:
            grams = template_bigrams(text)
            bounds = size_bounds(grams.total(), threshold)
            rows += [(gram, n, name, number, grams.total(), *bounds) for gram, n in sorted(grams.items())]
            number += 1
    return spark.createDataFrame(
        rows, "gram string, times int, license string, template int, size int, low int, high int"
    )


def license_matches(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    templates: dict[str, list[str]] | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """`id, license, dice, n_matches, matches` for every row of `df`.

    `matches` has one entry per unit and licence at or above the threshold, in order of unit and
    licence; `license` and `dice` are the best of them: highest coefficient, then the name first
    in the alphabet. Units: the text (number 0), its paragraphs (parted by lines without letters or
    digits) and its lines; a text without such breaks is one unit only. Bigrams count as often as they occur.
    Units and templates of fewer than two words match nothing. A null text is empty; repeated rows and null ids stay; an empty table gives no rows.
    """
    templates = TEMPLATES if templates is None else templates
    known = template_rows(df.sparkSession, templates, threshold)
    sizes = [template_bigrams(text).total() for texts in templates.values() for text in texts]
    bounds = [size_bounds(size, threshold) for size in sizes]
    least, most = min((b[0] for b in bounds), default=1), max((b[1] for b in bounds), default=0)
    # The row number lives within one pass over the input: nothing is joined back by it.
    rows = id_and_text(df, id_col, text_col).select(
        F.monotonically_increasing_id().alias("row"), "id", normalised(F.col("text")).alias("body")
    )

    def units(kind: str, parts: Column) -> Column:
        return F.transform(
            parts,
            lambda body, k: F.struct(F.lit(kind).alias("unit"), k.alias("number"), one_line(body).alias("body")),
        )

    def one_line(body: Column) -> Column:
        return F.trim(F.regexp_replace(body, "[ \n]+", " "))

    def several(kind: str, parts: Column) -> Column:
        return F.when(F.size(parts) > 1, units(kind, parts)).otherwise(F.slice(units(kind, parts), 1, 0))

    cut = F.concat(
        units("text", F.array("body")),
        several("paragraph", F.split("body", "\n *\n")),
        several("line", F.split("body", "\n")),
    )
    spaces = F.length("u.body") - F.length(F.replace(F.col("u.body"), F.lit(" "), F.lit("")))
    sized = rows.select("row", "id", F.explode(cut).alias("u")).select(
        "row", "id", "u.unit", "u.number", "u.body", spaces.alias("held")
    )
    # The text as a unit stays whatever its size, so that rows without a match are kept.
    fits = F.col("held").between(max(least, 1), most)
    words = F.split("body", " ")
    grams = F.zip_with(
        F.slice(words, F.lit(1), F.col("held")),
        F.slice(words, F.lit(2), F.col("held")),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )
    exploded = sized.where(fits | (F.col("unit") == "text")).select(
        "row", "id", "unit", "number", "held", F.posexplode_outer(F.when(fits, grams)).alias("place", "gram")
    )
    # Only matches are shuffled, and one bigram of each text.
    met = exploded.join(F.broadcast(known), "gram", "left").where(
        "held BETWEEN low AND high OR (unit = 'text' AND coalesce(place, 0) = 0)"
    )
    unit = ["row", "id", "unit", "number", "held"]
    template = ["license", "template", "size", "low", "high"]
    common = (
        met.groupBy(*unit, *template, "gram", "times")
        .agg(F.count("license").alias("n"))
        .groupBy(*unit, *template)
        .agg(F.sum(F.least("n", "times")).alias("common"))
    )
    dice = F.when(
        F.col("held").between(F.col("low"), F.col("high")), 2.0 * F.col("common") / (F.col("held") + F.col("size"))
    )
    best = common.groupBy("row", "id", "unit", "number", "license").agg(F.max(dice).alias("dice"))
    hit = F.col("dice") >= threshold
    match = F.struct("unit", "number", "license", "dice")
    found = best.groupBy("row", "id").agg(
        F.sort_array(F.collect_list(F.when(hit, match))).alias("matches"),
        F.max(F.when(hit, F.col("dice"))).alias("dice"),
    )
    top = F.array_min(
        F.transform(F.filter("matches", lambda m: m["dice"] == F.col("dice")), lambda m: m["license"])
    )
    return found.select("id", top.alias("license"), "dice", F.size("matches").alias("n_matches"), "matches")


def license_windows(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    templates: dict[str, list[str]] | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """`id, license, dice, n_windows, windows` for every row of `df`.

    A window is a run of words of the text, over line ends, blank lines and marks alike. `windows` has
    `start` (words before it), `words`, `license` and `dice` of every window at or above the threshold that
    no better one of its licence overlaps: the highest coefficient is taken first, then the window that
    begins first, then the shorter one. `license` and `dice` are the best as in `license_matches`, and so are null
    and repeated rows.

    Bigrams that a template has are dealt into bands as long as the template's upper bound; each goes to
    its own band and the one before, so that a window lies whole in the band it begins in.
    """
    templates = TEMPLATES if templates is None else templates
    known = template_rows(df.sparkSession, templates, threshold)
    lower = F.translate(F.col("text"), ascii_uppercase, ascii_lowercase)
    rows = id_and_text(df, id_col, text_col).select(
        F.monotonically_increasing_id().alias("row"),
        "id",
        F.split(F.trim(F.regexp_replace(lower, "[^a-z0-9]+", " ")), " ").alias("words"),
    )
    held = F.size("words") - 1
    grams = F.zip_with(
        F.slice("words", F.lit(1), held), F.slice("words", F.lit(2), held), lambda a, b: F.concat(a, F.lit(" "), b)
    )
    met = (
        rows.select("row", "id", F.posexplode_outer(grams).alias("place", "gram"))
        .join(F.broadcast(known), "gram", "left")
        .where("license IS NOT NULL OR coalesce(place, 0) = 0")
    )
    # The band -1 keeps rows without a window.
    bands = F.expr(
        """concat(
            if(license IS NULL, slice(array(0), 1, 0), array(cast(place DIV high AS int))),
            if(license IS NULL OR place < high, slice(array(0), 1, 0), array(cast(place DIV high AS int) - 1)),
            if(coalesce(place, 0) = 0, array(-1), slice(array(0), 1, 0))
        )"""
    )
    template = ["row", "id", "license", "template", "size", "low", "high", "band"]
    places = met.select("*", F.explode(bands).alias("band")).groupBy(*template, "gram", "times").agg(
        F.sort_array(F.collect_list("place")).alias("places")
    )
    # A bigram counts in a window if the one `times` before it lies outside.
    counted = F.transform(
        "places",
        lambda p, k: F.struct(
            p.alias("place"),
            F.when(k >= F.col("times"), F.get("places", k - F.col("times"))).otherwise(-1).alias("before"),
        ),
    )
    hits = (
        places.groupBy(*template)
        .agg(
            F.sum(F.least(F.size("places"), F.col("times"))).alias("common"),
            F.sort_array(F.flatten(F.collect_list(counted))).alias("hits"),
        )
        .where("band = -1 OR common >= low")
    )

    def best_from(a: Column) -> Column:
        reached = F.filter(
            "hits",
            lambda e: (e["place"] >= a["place"]) & (e["place"] < a["place"] + F.col("high")) & (e["before"] < a["place"]),
        )
        return F.array_max(
            F.transform(
                reached,
                lambda e, k: F.struct(
                    (2.0 * (k + 1) / (e["place"] - a["place"] + 1 + F.col("size"))).alias("dice"),
                    (-a["place"]).alias("first"),
                    (-e["place"]).alias("last"),
                ),
            )
        )

    begins = F.filter("hits", lambda a: F.floor(a["place"] / F.col("high")) == F.col("band"))
    reaching = F.filter(F.transform(begins, best_from), lambda w: w["dice"] >= threshold)
    kind = "array<struct<dice:double,first:int,last:int>>"
    per_license = (
        hits.select("row", "id", "license", reaching.cast(kind).alias("found"))
        .groupBy("row", "id", "license")
        .agg(F.sort_array(F.flatten(F.collect_list("found")), asc=False).alias("found"))
    )
    apart = F.aggregate(
        "found",
        F.array().cast(kind),
        lambda kept, w: F.when(
            F.exists(kept, lambda x: (x["first"] >= w["last"]) & (x["last"] <= w["first"])), kept
        ).otherwise(F.concat(kept, F.array(w))),
    )
    windows = F.transform(
        apart,
        lambda w: F.struct(
            (-w["first"]).alias("start"),
            (w["first"] - w["last"] + 2).alias("words"),
            F.col("license"),
            w["dice"].alias("dice"),
        ),
    )
    out = (
        per_license.select("row", "id", windows.alias("windows"))
        .groupBy("row", "id")
        .agg(F.sort_array(F.flatten(F.collect_list("windows"))).alias("windows"))
    )
    dice = F.array_max(F.transform("windows", lambda w: w["dice"]))
    top = F.array_min(F.transform(F.filter("windows", lambda w: w["dice"] == F.col("dice")), lambda w: w["license"]))
    return out.withColumn("dice", dice).select(
        "id", top.alias("license"), "dice", F.size("windows").alias("n_windows"), "windows"
    )
