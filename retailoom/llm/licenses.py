"""License scan with built-in functions only.

Lines, sentences and paragraphs of a text that speak of licensing, and licence files as wholes, are compared with
templates by the cosine of sparse TF-IDF vectors. A file without a licence of its own takes that of the licence file in
the nearest directory above it.
"""

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailoom.llm.store import Scratch

LEAST_COSINE = 0.6
NOTICE_SHARE = 0.1

# --- fixed values: short forms and notices of common public licences ------------------------------------------------

TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "The MIT License (MIT)",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "SPDX-License-Identifier: GPL-3.0-only",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
        "SPDX-License-Identifier: GPL-2.0-only",
    ),
    "LGPL-3.0": (
        "Licensed under the GNU Lesser General Public License, version 3.",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "SPDX-License-Identifier: LGPL-3.0-only",
    ),
    "LGPL-2.1": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ),
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "BSD-2-Clause": (
        "Released under the BSD 2-Clause License.",
        "SPDX-License-Identifier: BSD-2-Clause",
    ),
    "ISC": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies.",
        "SPDX-License-Identifier: ISC",
    ),
    "EPL-2.0": (
        "Licensed under the Eclipse Public License, version 2.0.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
        "SPDX-License-Identifier: EPL-2.0",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC0-1.0": (
        "Released under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "This is free and unencumbered software released into the public domain.",
    ),
}
CUES = ("licens", "licenc", "spdx", "redistribut", "permission is hereby", "permission to use", "creative commons", "public domain", "cc0", "cc by", "waived all copyright")
LICENCE_FILE = r"(?i)(^|/)(licen[sc]e|copying|unlicense)([-._][^/]*)?$"
WORD = r"[a-z0-9]+(?:\.[0-9]+)*"
# a version that a text names after one of these words; ".0" at its end says nothing
VERSION = r"(?:version|\bv\.?|\b[al]?gpl|\bmpl|\bepl|apache|license|\bby|\bsa|\bnc|\bcc0)[-, ]{0,2}v?([0-9]+(?:\.[0-9]+)*)"
LINE = "\r\n|\r|\n"
# lines without a letter or digit (comment marks and the like) end a paragraph, too
PARAGRAPH = r"(?:\r\n|\r|\n)[^\p{L}\p{N}\r\n]*(?:\r\n|\r|\n)"
SENTENCE = r"(?<=[.!?])[ \t\r\n]+(?=[^\p{L}\p{N}\r\n]*[A-Z])|[ \t][|][ \t]"


def _plain_version(found: str) -> str:
    return re.sub(r"\.0$", "", found)


def version_of_license(name: str) -> str | None:
    """The version in a licence's name, as texts have it without ".0"; "3-Clause" is none."""
    found = re.search(r"-([0-9]+\.[0-9]+)$", name)
    return _plain_version(found[1]) if found else None


def _weights(templates: dict[str, tuple[str, ...]]) -> tuple[dict[str, float], list[tuple[str, bool, dict[str, float]]]]:
    """Inverse document frequencies, and (licence, whole, unit vector) of each sentence and of each licence as a whole."""
    units = [(name, False, text) for name, texts in templates.items() for text in texts]
    units += [(name, True, " ".join(texts)) for name, texts in templates.items()]
    counts = [(name, whole, Counter(re.findall(WORD, text.lower()))) for name, whole, text in units]
    frequency = Counter(word for _, whole, words in counts if not whole for word in words)
    many = sum(not whole for _, whole, _ in counts)
    idf = {word: math.log((1 + many) / (1 + n)) + 1 for word, n in frequency.items()}
    vectors = []
    for name, whole, words in counts:
        vector = {word: n * idf[word] for word, n in words.items()}
        norm = math.sqrt(sum(x * x for x in vector.values()))
        vectors.append((name, whole, {word: x / norm for word, x in vector.items()}))
    return idf, vectors


def _map(values: dict[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def _bound(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _counted(words: Column) -> Column:
    """array<struct<w, n>> of the distinct words: they are sorted and runs are cut, so a long text costs n log n."""

    def runs(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return _bound(
            starts,
            lambda at: F.transform(at, lambda i, j: F.struct(F.get(s, i).alias("w"), (F.coalesce(F.get(at, j + 1), F.size(s)) - i).alias("n"))),
        )

    return F.when(F.size(words) > 0, _bound(F.array_sort(words), runs))


def _best(text: Column, whole: Column, templates: dict[str, tuple[str, ...]]) -> Column:
    """struct(cosine, license) of the closest template of one text; ``whole`` compares with licences as wholes.

    Templates of another version than those that the text names are left out.
    """
    idf, vectors = _weights(templates)
    rare = math.log(1 + sum(map(len, templates.values()))) + 1  # words of no template
    versions = F.transform(F.regexp_extract_all(F.lower(text), F.lit(VERSION), 1), lambda v: F.regexp_replace(v, r"\.0$", ""))
    weigh = F.transform(
        _counted(F.regexp_extract_all(F.lower(text), F.lit(WORD), 0)),
        lambda t: F.struct(
            t["w"].alias("w"),
            (t["n"] * F.coalesce(F.element_at(_map(idf), t["w"]), F.lit(rare))).alias("x"),
            F.map_contains_key(_map(idf), t["w"]).alias("known"),
        ),
    )
    units = F.array(
        *[
            F.struct(
                F.lit(name).alias("license"), F.lit(kind).alias("whole"), F.lit(version_of_license(name)).cast("string").alias("version"), _map(vector).alias("v")
            )
            for name, kind, vector in vectors
        ]
    )

    def compare(part: Column) -> Column:
        norm = F.sqrt(F.aggregate(part["vector"], F.lit(0.0), lambda a, t: a + t["x"] * t["x"]))
        fits = F.filter(
            units,
            lambda u: (u["whole"] == whole) & (u["version"].isNull() | (F.size(part["versions"]) == 0) | F.array_contains(part["versions"], u["version"])),
        )
        found = _bound(
            F.struct(norm.alias("norm"), F.filter(part["vector"], lambda t: t["known"]).alias("known")),
            lambda k: F.transform(
                fits,
                lambda u: F.struct(
                    F.round(F.aggregate(k["known"], F.lit(0.0), lambda a, t: a + t["x"] * F.coalesce(F.element_at(u["v"], t["w"]), F.lit(0.0))) / k["norm"], 6).alias("cosine"),
                    u["license"].alias("license"),
                ),
            ),
        )
        return F.when(F.size(part["vector"]) > 0, F.get(F.sort_array(found, asc=False), F.lit(0)))

    return _bound(F.struct(weigh.alias("vector"), versions.alias("versions")), compare)


def _parts(text: Column) -> Column:
    """array<struct<kind, part>>: the lines, sentences and paragraphs of a text that speak of licensing; equal ones once.

    A paragraph is a run of lines that hold letters or digits, so a notice that is wrapped over the lines of a comment is
    read as one; sentences are those of paragraphs, and go on over line ends.
    """
    cue = "|".join(map(re.escape, CUES))
    speaking = lambda parts: F.filter(parts, lambda x: F.lower(x).rlike(cue))

    def of_paragraphs(paragraphs: Column) -> Column:
        sentences = speaking(F.flatten(F.transform(paragraphs, lambda p: F.split(p, SENTENCE))))
        lines = speaking(F.flatten(F.transform(paragraphs, lambda p: F.split(p, LINE))))
        named = lambda parts, kind: F.transform(parts, lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("part")))
        return _bound(
            F.struct(lines.alias("lines"), sentences.alias("sentences")),
            lambda b: F.concat(
                named(b["lines"], 0),
                named(F.array_except(b["sentences"], b["lines"]), 1),
                named(F.array_except(F.array_except(paragraphs, b["sentences"]), b["lines"]), 2),
            ),
        )

    return _bound(speaking(F.split(text, PARAGRAPH)), of_paragraphs)


def license_scan(
    files: DataFrame,
    path: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    templates: dict[str, tuple[str, ...]] = TEMPLATES,
    least: float = LEAST_COSINE,
    notice_share: float = NOTICE_SHARE,
) -> DataFrame:
    """(id, path, own_license, cosine, license, inherited_from) of every row.

    own_license: the closest template of the row's lines, sentences and paragraphs that speak of licensing (of the whole
    text, if the path names a licence file), if the cosine is at least ``least``; equal cosines go to the last name in the
    alphabet. A licence of another version than those that the part names is none of its templates. Licence
    files, and texts of which a notice makes up at least ``notice_share``, declare their directory; the highest cosine
    of a directory wins. license: the own one, else that of the nearest directory at or above the row's own that declares
    one; inherited_from is that directory ("" is the root).

    Null and empty texts, and such without a notice, have no own license; a null path inherits nothing and declares
    nothing. Rows are judged one by one: repeats come out repeated. An empty table gives an empty result.
    """
    scratch = Scratch(files.sparkSession, "licenses")
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = files.select(F.col(id_column).alias("id"), path.alias("path"), text.alias("text"))
    is_file = F.coalesce(F.col("path").rlike(LICENCE_FILE), F.lit(False))
    low = F.lower("text")
    speaking = is_file
    for cue in CUES:
        speaking = speaking | F.contains(low, F.lit(cue))
    rows = rows.withColumn("speaks", speaking).withColumn("file", is_file)
    itself = F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("part")))
    speaks = rows.where("speaks").select("id", "path", "file", F.length("text").alias("long"), F.when(F.col("file"), itself).otherwise(_parts(F.col("text"))).alias("parts"))
    found = F.transform(
        "parts", lambda p: F.struct(_best(p["part"], F.col("file"), templates).alias("best"), F.length(p["part"]).alias("long"), p["kind"].alias("kind"))
    )
    scored = speaks.withColumn("found", F.filter(found, lambda f: f["best"]["cosine"] >= least))
    top = F.get(F.sort_array("found", asc=False), F.lit(0))

    def held(kind: int) -> Column:
        return F.aggregate(F.filter("found", lambda f: f["kind"] == kind), F.lit(0), lambda a, f: a + f["long"])

    # a notice counts once, be it a line, a sentence or a paragraph
    share = F.greatest(held(0), held(1), held(2)) >= notice_share * F.col("long")
    scored = scored.select(
        "id", "path", top["best"]["license"].alias("own"), top["best"]["cosine"].alias("cosine"), (F.col("file") | share).alias("declares")
    )
    scored = scratch.settle(scored, "notices")
    silent = rows.where("not speaks").select("id", "path").unionByName(scored.where("own is null").select("id", "path"))
    scored = scored.where("own is not null")

    directory = F.when(F.col("path").contains("/"), F.regexp_replace("path", "/[^/]*$", "")).otherwise(F.when(F.col("path").isNotNull(), ""))
    declared = scored.where("declares").select(directory.alias("dir"), "cosine", "own").where("dir is not null")
    declared = declared.groupBy("dir").agg(F.max(F.struct("cosine", "own"))["own"].alias("license"))
    declared = scratch.settle(declared, "declared")
    bare = silent.withColumn("dir", directory)
    # nearest declaring directory, worked out once for each directory
    parts = F.split("dir", "/")
    up = F.when(F.col("dir") == "", F.array(F.lit(""))).otherwise(
        F.concat(F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.concat_ws("/", F.slice(parts, 1, n))))
    )
    places = bare.where("dir is not null").select("dir").distinct().select("dir", F.posexplode(up).alias("depth", "above"))
    nearest = places.join(declared.withColumnRenamed("dir", "above"), "above").groupBy("dir").agg(F.max(F.struct("depth", "license", "above")).alias("near"))
    inherited = bare.join(nearest, "dir", "left").select(
        "id", "path", F.lit(None).cast("string").alias("own_license"), F.lit(None).cast("double").alias("cosine"),
        F.col("near.license").alias("license"), F.col("near.above").alias("inherited_from"),
    )
    own = scored.select("id", "path", F.col("own").alias("own_license"), "cosine", F.col("own").alias("license"), F.lit(None).cast("string").alias("inherited_from"))
    return own.unionByName(inherited).withColumnRenamed("id", id_column)
