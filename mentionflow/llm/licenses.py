"""License recognition by known sentences.

A text is cut into sentences, each is normalised and looked up among the sentences of known
licences. What remains of a document is a short sequence of sentence identifiers, in which
the ordered rules of the licences are looked for. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import BROADCAST_ROWS, lower_ascii

#: Marks of comments (#, //, /*, *, ;, --, %, <!--) at the start of a line; lines of nothing else are blank.
MARKS = r"(?m)^[ \t]*[#/*;%!<>|-][ \t#/*;%!<>|-]*"
#: Two ways of cutting: sentences wrapped over lines, and lines that are sentences.
CUTS = {"wrapped": r"[.!?]+(\s+|$)|\n[ \t\r]*\n", "lines": r"[.!?]+(\s+|$)|\n+"}

# Sentences of well-known licences and notices, and the order in which a licence has them.
SENTENCES = {
    1: "Licensed under CC BY-NC 4.0.",
    2: "This work is licensed under the GNU General Public License, version 3.",
    3: "Licensed under the Apache License, Version 2.0.",
    4: "Released under the MIT License.",
    5: "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
       "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
       "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
       "subject to the following conditions:",
    6: "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    7: "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
       "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    8: "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
       "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    9: "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    10: "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    11: "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    12: "See the License for the specific language governing permissions and limitations under the License.",
    13: "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    14: "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    15: "See the GNU General Public License for more details.",
    16: "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies.",
    17: "This is free and unencumbered software released into the public domain.",
    18: "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means.",
    # the published notice has the address in a paragraph of its own
    19: "You may obtain a copy of the License at",
    20: "http://www.apache.org/licenses/LICENSE-2.0",
    21: "https://www.apache.org/licenses/LICENSE-2.0",
    22: "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0",
    23: "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    # without a blank line the number of the first condition stands in the same sentence
    24: "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1",
    25: "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    26: "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.",
    27: "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission.",
    28: "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
        "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    # "v. 2.0" ends a sentence
    29: "This Source Code Form is subject to the terms of the Mozilla Public License, v",
    30: "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    31: "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    32: "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    33: "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    34: "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    35: "See the GNU Lesser General Public License for more details.",
    36: "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    37: "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    38: "See the GNU Affero General Public License for more details.",
    39: "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    40: "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the "
        "work worldwide under copyright law, including all related and neighboring rights, to the extent allowed by law.",
}
RULES = [
    ("AGPL-3.0-or-later", [37, 14, 38]), ("Apache-2.0", [3]), ("Apache-2.0", [9, 10, 11, 12]), ("Apache-2.0", [9, 19, 20, 11, 12]),
    ("Apache-2.0", [9, 19, 21, 11, 12]), ("Apache-2.0", [9, 22, 11, 12]), ("BSD-2-Clause", [23, 25, 26, 28]), ("BSD-2-Clause", [24, 25, 26, 28]),
    ("BSD-3-Clause", [23, 25, 26, 27, 28]), ("BSD-3-Clause", [24, 25, 26, 27, 28]), ("CC-BY-4.0", [39]), ("CC0-1.0", [40]),
    ("GPL-2.0-or-later", [32, 14, 15]), ("LGPL-2.1-or-later", [33, 34, 35]), ("LGPL-3.0-or-later", [36, 14, 35]), ("MPL-2.0", [29, 30]), ("MPL-2.0", [29, 31]), ("CC-BY-NC-4.0", [1]), ("GPL-3.0", [2]), ("GPL-3.0-or-later", [13, 14, 15]),
    ("ISC", [16]), ("MIT", [4]), ("MIT", [5, 6, 7, 8]), ("Unlicense", [17, 18]),
]


def normalised(sentence: Column) -> Column:
    """Letters and digits in lower case, single spaces between what anything else separates."""
    return F.trim(F.regexp_replace(lower_ascii(sentence), r"[^0-9a-z\x80-\x{10FFFF}]+", " "))


def known_sentences(spark: SparkSession, sentences: dict[int, str] = SENTENCES) -> DataFrame:
    """``sentence_id`` and ``known`` (normalised, without its closing full stop)."""
    return spark.createDataFrame(list(sentences.items()), "sentence_id int, sentence string").select(
        "sentence_id", normalised(F.col("sentence")).alias("known"))


def sentence_hits(docs: DataFrame, known: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``cut``, ``place`` and ``sentence_id`` of every known sentence; spread over all tasks, long texts too."""
    pieces = F.array(*[F.struct(F.lit(name).alias("cut"), F.split(F.regexp_replace(F.col(text), MARKS, ""), pattern).alias("sentences")) for name, pattern in CUTS.items()])
    cut = docs.select(F.col(doc_id).alias("doc_id"), F.explode(pieces).alias("piece"))
    sentences = cut.select("doc_id", "piece.cut", F.posexplode("piece.sentences").alias("place", "sentence"))
    return sentences.join(known, normalised(F.col("sentence")) == F.col("known")).select("doc_id", "cut", "place", "sentence_id")


def recognise(docs: DataFrame, rules: list[tuple[str, list[int]]] = RULES, sentences: dict[int, str] = SENTENCES,
              doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``sentence_ids`` (in order of the lines) and ``licenses`` (sorted) of every row.

    A rule holds where its identifiers follow one another among the known sentences of the
    document, whatever other text lies between. NULL and empty texts have none; rows with
    one id share what their texts have; rows without id have no hits; an empty table gives
    no rows. Other columns are not used.
    """
    known = known_sentences(docs.sparkSession, sentences)
    if len(sentences) <= BROADCAST_ROWS:  # Spark does not know how small a local list is
        known = F.broadcast(known)
    hits = sentence_hits(docs, known, doc_id, text)
    sequences = hits.groupBy("doc_id", "cut").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "sentence_id"))), lambda h: h.sentence_id).alias("ids"))
    as_text = F.concat(F.lit(","), F.array_join("ids", ","), F.lit(","))
    held = F.filter(F.array(*[F.when(F.contains(as_text, F.lit("," + ",".join(map(str, ids)) + ",")), F.lit(name)) for name, ids in rules]),
                    lambda name: name.isNotNull())
    found = sequences.select("doc_id", F.when(F.col("cut") == "lines", F.col("ids")).alias("ids"), held.alias("held"))
    found = found.groupBy(F.col("doc_id").alias("hit_id")).agg(
        F.max("ids").alias("ids"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("held")))).alias("held"))
    own = docs.select(F.col(doc_id).alias("own_id"))
    return own.join(found, F.col("own_id") == F.col("hit_id"), "left").select(
        F.col("own_id").alias(doc_id), F.coalesce("ids", F.array().cast("array<int>")).alias("sentence_ids"), F.coalesce("held", F.array().cast("array<string>")).alias("licenses"))
