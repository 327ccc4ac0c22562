"""Licence scan in DataFrame operations only.

Each line, each paragraph and the whole of a text is normalised to its
lower-case words and compared with licence templates by the Dice coefficient of
their word-bigram sets. Only templates whose set size lies within the bounds
that the threshold allows are compared. A unit counts for its best template.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import lower_ascii

THRESHOLD = 0.8

_WARRANTY = (
    "the software is provided as is without warranty of any kind express or implied including but not limited to the "
    "warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or "
    "copyright holders be liable for any claim damages or other liability whether in an action of contract tort or "
    "otherwise arising from out of or in connection with the software or the use or other dealings in the software"
)
_BSD = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met 1 redistributions of source code must retain the above copyright notice this list of "
    "conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright notice "
    "this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"
)

#: The public wording of common licences and licence notices.
TEMPLATES: dict[str, list[str]] = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
        "persons to whom the software is furnished to do so subject to the following conditions the above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the software " + _WARRANTY,
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License 2.0.",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
        "the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by "
        "applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
        "without warranties or conditions of any kind either express or implied see the license for the specific "
        "language governing permissions and limitations under the license",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation either version 3 of the license or at your option any later version",
    ],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3."],
    "MPL-2.0": [
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
        "distributed with this file you can obtain one at http mozilla org mpl 2 0",
    ],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License.", _BSD],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        _BSD + " 3 neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission",
    ],
    "ISC": [
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "CC0-1.0": ["Released under CC0 1.0 Universal."],
    "Proprietary": ["All rights reserved."],
}


def template_bigrams() -> list[tuple[str, str, list[str]]]:
    """(licence, first words, sorted bigrams) of every template."""
    out = []
    for licence, texts in TEMPLATES.items():
        for text in texts:
            words = re.findall("[a-z0-9]+", text.lower())
            out.append((licence, " ".join(words), sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})))
    return out


def _templates() -> Column:
    """All templates as one constant (the optimiser folds it)."""
    rows = [{"licence": licence, "bigrams": bigrams, "n": len(bigrams)} for licence, _, bigrams in template_bigrams()]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<licence string, bigrams array<string>, n int>>")


def scan(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document and licence found: doc_id, licence, dice, units.

    ``dice`` is the best unit's, ``units`` the number of different units that
    match. Of templates that tie, the licence last in the alphabet wins. Null
    and empty texts, and units under two words, match nothing. Repeated rows
    count as one document's units each. An empty table gives no rows.
    """
    sizes = [len(b) for _, _, b in template_bigrams()]
    ratio = (2 - threshold) / threshold
    least, most = min(sizes) / ratio, max(sizes) * ratio
    text = lower_ascii(F.col("text").cast("string"))
    units = F.array_distinct(F.concat(F.split(text, "\n"), F.split(text, "\n[ \t\r]*\n"), F.array(text)))
    # n bigrams take n + 1 words and n gaps at least; a unit this short needs no word split
    long_enough = F.filter(units, lambda u: F.length(u) >= int(2 * least + 1))
    # each explode of a one-element array keeps the optimiser from repeating its expression further up
    split = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(long_enough).alias("unit")).select(
        "doc_id", F.explode(F.array(F.regexp_extract_all("unit", F.lit("[a-z0-9]+"), F.lit(0)))).alias("words")
    )
    pairs = F.zip_with(
        F.slice("words", F.lit(1), F.greatest(F.size("words") - 1, F.lit(0))),
        F.slice("words", F.lit(2), F.greatest(F.size("words") - 1, F.lit(0))),
        lambda a, b: F.concat_ws(" ", a, b),
    )
    sets = split.where(F.size("words") > least).select("doc_id", F.explode(F.array(F.array_distinct(pairs))).alias("bigrams"))
    n = F.size("bigrams")
    near = F.filter(_templates(), lambda t: (n * ratio >= t["n"]) & (t["n"] * ratio >= n))
    dice = F.transform(
        near, lambda t: F.struct((2.0 * F.size(F.array_intersect(F.col("bigrams"), t["bigrams"])) / (n + t["n"])).alias("dice"), t["licence"].alias("licence"))
    )
    best = sets.where((n > 0) & n.between(least, most)).select("doc_id", F.array_max(dice).alias("best"))
    found = best.where(F.col("best.dice") >= threshold)
    return found.groupBy("doc_id", F.col("best.licence").alias("licence")).agg(
        F.max("best.dice").alias("dice"), F.count("*").alias("units")
    )


def sql(threshold: float = THRESHOLD) -> str:
    values = ", ".join(f"('{licence}', '{words}')" for licence, words, _ in template_bigrams())
    ratio = (2 - threshold) / threshold
    split = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    return f"""
WITH t AS (
  SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x, row_number() OVER () AS r FROM documents
), u AS (
  SELECT DISTINCT r, doc_id, unit FROM (
    SELECT r, doc_id, unnest(string_split(x, chr(10))) AS unit FROM t
    UNION ALL SELECT r, doc_id, unnest(string_split_regex(x, '\\n[ \\t\\r]*\\n')) FROM t
    UNION ALL SELECT r, doc_id, x FROM t)
), b AS (
  SELECT r, doc_id, unit, {split} AS bigrams FROM (SELECT *, regexp_extract_all(unit, '[a-z0-9]+') AS w FROM u)
), l AS (
  SELECT licence, {split} AS bigrams FROM (SELECT licence, regexp_extract_all(words, '[a-z0-9]+') AS w FROM (VALUES {values}) v(licence, words))
), d AS (
  SELECT b.r, b.doc_id, b.unit, l.licence, 2.0::DOUBLE * len(list_intersect(b.bigrams, l.bigrams)) / (len(b.bigrams) + len(l.bigrams)) AS dice
  FROM b JOIN l ON len(b.bigrams) * {ratio} >= len(l.bigrams) AND len(l.bigrams) * {ratio} >= len(b.bigrams)
  WHERE len(b.bigrams) > 0
), best AS (
  SELECT * FROM d WHERE dice >= {threshold}
  QUALIFY row_number() OVER (PARTITION BY r, unit ORDER BY dice DESC, licence DESC) = 1
)
SELECT doc_id, licence, max(dice) AS dice, count(*) AS units FROM best GROUP BY doc_id, licence
"""
