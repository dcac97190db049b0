"""License scans: MinHash bands over overlapping windows of words retrieve templates, exact containment verifies them.

Words are runs of a-z and 0-9 in lower case, shingles are k = 3 of them. A
template of m words belongs to the class c, the least power of two of at least
m (4 or more). Documents are cut into windows of 2c words, c words apart, so
that each run of c words lies whole in a window. A window that holds
``percent`` of a template's n distinct shingles lacks n * (100 - percent) / 100
of them at most, so it holds one of any set of one more: the template's
longest ones (most letters, the rarest as a rule) are its anchors, and only
windows with an anchor are looked at (see native). Each window and template
gets BANDS MinHash values (bands of one row); those that agree in a band,
within a class, are verified exactly: the share of the template's distinct
shingles that the window holds must reach ``percent``.

A template that a window holds to 80 percent has a Jaccard similarity with it of
0.19 or more, and meets it in one of 64 bands with probability 0.999998.

``templates`` are the short notices, one line ``SPDX-License-Identifier: ..`` for
each of SPDX_IDS (reported as SPDX-..) and the whole texts of license_texts/
(reported as ..-text). Licenses that share most of their words are reported
together, each with its own share: a text of BSD-3-Clause holds BSD-2-Clause
whole, one of AGPL-3.0 holds most of GPL-3.0.

Rows: null and empty documents hold nothing. A template without a shingle of
its own (fewer than three words) is one shingle of all its words; one without
words matches nothing. Rows with the same id and text are one document; ids
may be null. All work on documents is DataFrame expressions.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from period_etl.llm.common import stored
from period_etl.llm.native import anchors, bounded, shingle_array, word_array

BANDS, K, LEAST_CLASS = 64, 3, 4
_BETWEEN = "[^a-z0-9]+"

#: Short notices by which common licenses are declared (fixed values; a parameter of the scan).
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MIT": "Released under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "rights-reserved": "All rights reserved.",
}
#: Identifiers of the SPDX list that get a template line of their own (fixed values).
SPDX_IDS = ("0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0",
            "CC0-1.0", "EPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1-only", "LGPL-2.1-or-later",
            "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MPL-2.0", "Unlicense", "Zlib")
_TEXTS = Path(__file__).with_name("license_texts")


def known_texts() -> dict[str, str]:
    """All templates of the scan by name: notices, SPDX lines and whole license texts."""
    lines = {f"SPDX-{x}": f"SPDX-License-Identifier: {x}" for x in SPDX_IDS}
    whole = {f"{file.stem}-text": file.read_text() for file in _TEXTS.glob("*.txt")}
    return dict(sorted({**NOTICES, **lines, **whole}.items()))


def notices(spark: SparkSession) -> DataFrame:
    """The short notices alone."""
    return spark.createDataFrame(sorted(NOTICES.items()), "license string, text string")


def known_licenses(spark: SparkSession) -> DataFrame:
    """The templates of known_texts, about 60 rows and 140 KB."""
    return spark.createDataFrame(list(known_texts().items()), "license string, text string")


def _rarest(words: Column, percent: int) -> Column:
    """The hashes of the longest of a text's distinct shingles: so many that a window with ``percent`` of all has one."""
    n = F.size(words)
    at = F.when(n <= K, F.array(F.lit(1))).otherwise(F.sequence(F.lit(1), n - (K - 1)))
    each = F.array_distinct(F.transform(at, lambda i: F.struct(F.length(F.array_join(F.slice(words, i, K), "")).alias("length"),
                                                               F.xxhash64(F.slice(words, i, K)).alias("g"))))
    most = F.floor(F.size(each) * (100 - percent) / 100) + 1
    return F.slice(F.transform(F.sort_array(each, asc=False), lambda x: x["g"]), 1, most.cast("int"))


def _signature(shingles: Column) -> Column:
    """The least hash under each of BANDS hash functions, with the band's number mixed in."""
    return F.array(*[F.xxhash64(_least(shingles, b), F.lit(b)) for b in range(BANDS)])


def _least(shingles: Column, band: int) -> Column:
    return F.array_min(F.transform(shingles, lambda g: F.xxhash64(g, F.lit(band))))


def license_scan(docs: DataFrame, templates: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """(doc_id, text_hash, license, start, n_words, common, total): for each template found in a document the
    window that holds most of it, of equals the first; common of the template's total shingles are in it."""
    spelt = templates.select("license", word_array(F.col("text"), _BETWEEN).alias("w")).where("size(w) > 0")
    size = F.greatest(F.lit(LEAST_CLASS), F.pow(2, F.ceil(F.log2(F.size("w")))).cast("int"))
    known = spelt.select("license", size.alias("c"), F.array_distinct(shingle_array(F.col("w"), K)).alias("t"), _rarest(F.col("w"), percent).alias("rare"))
    known = stored(known.withColumn("bands", _signature(F.col("t"))), "license-templates")

    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    places = known.select("c", F.explode("rare").alias("g")).distinct()
    at = F.floor(F.col("pos") / F.col("c")) * F.col("c")
    found = anchors(keyed.withColumn("words", word_array(F.col("text"), _BETWEEN)).drop("text"), places, K)
    found = (found.select("doc_id", "text_hash", "c", "pos", F.explode(F.array(at, at - F.col("c"))).alias("start"))
             .where("start >= 0 and pos + %d <= start + 2 * c" % K).select("doc_id", "text_hash", F.struct("start", "c").alias("v")).distinct())
    windows = stored(found.groupBy("doc_id", "text_hash").agg(F.collect_list("v").alias("windows")), "license-windows")

    same = (keyed["text_hash"] == windows["text_hash"]) & keyed["doc_id"].eqNullSafe(windows["doc_id"])
    texts = keyed.join(windows, same).select(windows["doc_id"], windows["text_hash"], "text", "windows").dropDuplicates(["doc_id", "text_hash"])
    cut = (texts.select("doc_id", "text_hash", word_array(F.col("text"), _BETWEEN).alias("words"), F.explode("windows").alias("v"))
           .select("doc_id", "text_hash", "v.start", "v.c", F.slice("words", (F.col("v.start") + 1).cast("int"), F.col("v.c") * 2).alias("w"))
           .select("doc_id", "text_hash", "start", "c", F.size("w").alias("n_words"), shingle_array(F.col("w"), K).alias("shingles")))
    cut = stored(cut.withColumn("bands", _signature(F.col("shingles"))), "license-prints")

    index = known.select("license", "c", F.explode("bands").alias("band"))
    its = known.select("license", "t", F.col("bands").alias("its"))
    near = (cut.select("*", F.explode("bands").alias("band")).join(bounded(index), ["c", "band"])
            .join(bounded(its, weight=F.size("t") + BANDS), "license")
            # a pair that meets in several bands counts at the first of them
            .where(F.col("band") == F.element_at(F.array_intersect("bands", "its"), 1)))
    common = F.size(F.array_intersect("t", "shingles"))
    held = (near.select("doc_id", "text_hash", "license", "start", "n_words", common.alias("common"), F.size("t").alias("total"))
            .where(F.col("common").cast("long") * 100 >= F.col("total").cast("long") * percent))
    best = F.max_by(F.struct("start", "n_words", "common", "total"), F.struct("common", -F.col("start")))
    return held.groupBy("doc_id", "text_hash", "license").agg(best.alias("b")).select("doc_id", "text_hash", "license", "b.*")
