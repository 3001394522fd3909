"""License scans over a positional index of rare words."""

import re
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Scratch

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """A wording of a license. All words of its key phrases must stand at their places, of the others enough; a label may have several wordings."""

    label: str
    text: str
    keys: tuple[str, ...]
    base: bool = False

    @property
    def words(self) -> list[str]:
        return re.findall(WORD, self.text.lower())

    @property
    def must(self) -> list[bool]:
        words = self.words
        out = [False] * len(words)
        for key in (re.findall(WORD, k.lower()) for k in self.keys):
            at = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
            out[at : at + len(key)] = [True] * len(key)
        return out


# fixed values: the base phrases with their labels, then wordings of published licenses and of their notices
TEMPLATES = (
    Template("cc-by", "cc by", ("cc by",), True),
    Template("gpl", "general public license", ("general public license",), True),
    Template("reserved", "all rights reserved", ("all rights reserved",), True),
    Template("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", ("gnu affero general public license",)),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", ("www apache org licenses license 2 0",)),
    Template("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.", ("unless required by applicable law or agreed to in writing", "governing permissions and limitations under the license")),
    Template("apache-2.0", "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form.", ("each contributor hereby grants to you a perpetual", "sublicense and distribute the work")),
    Template("artistic-2.0", "You are permitted to use the Standard Version and create and use Modified Versions for any purpose without restriction, provided that you do not Distribute the Modified Version.", ("use the standard version and create and use modified versions",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("redistribution and use in source and binary forms",)),
    Template("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.", ("redistributions of source code must retain the above copyright notice",)),
    Template("bsd", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.", ("redistributions in binary form must reproduce the above copyright notice",)),
    Template("bsd", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES", ("provided by the copyright holders and contributors as is",)),
    Template("bsd-3-clause", "may be used to endorse or promote products derived from this software without specific prior written permission", ("endorse or promote products derived from this software",)),
    Template("bsd-4-clause", "All advertising materials mentioning features or use of this software must display the following acknowledgement", ("advertising materials mentioning features or use of this software",)),
    Template("boost-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software", ("any person or organization obtaining a copy of the software and accompanying documentation",)),
    Template("cc-by-nc", "creative commons attribution noncommercial", ("commons attribution noncommercial",)),
    Template("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", ("creative commons attribution noncommercial 4 0 international license",)),
    Template("cc-by-sa", "creative commons attribution sharealike", ("commons attribution sharealike",)),
    Template("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License", ("creative commons attribution 4 0 international license",)),
    Template("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work", ("waived all copyright and related or neighboring rights",)),
    Template("epl-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at", ("terms of the eclipse public license",)),
    Template("gfdl", "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.3 or any later version published by the Free Software Foundation; with no Invariant Sections, no Front-Cover Texts, and no Back-Cover Texts.", ("gnu free documentation license",)),
    Template("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", ("free software you can redistribute it", "gnu general public license")),
    Template("gpl-2.0", "as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version", ("published by the free software foundation either version 2 of the license",)),
    Template("gpl-3.0", "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version", ("published by the free software foundation either version 3 of the license",)),
    Template("gpl-notice", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.", ("distributed in the hope that it will be useful", "gnu general public license for more details")),
    Template("gpl-work", "this work is licensed under the gnu general public license", ("licensed under the gnu general public license",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify and or distribute this software",)),
    Template("isc", "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES", ("the author disclaims all warranties with regard to this software",)),
    Template("lgpl", "gnu lesser general public license", ("lesser general public license",)),
    Template("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.", ("this library is free software", "gnu lesser general public license")),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ("permission is hereby granted free of charge",)),
    Template("mit", "and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.", ("deal in the software without restriction", "copies or substantial portions of the software")),
    Template("mit", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.", ("particular purpose and noninfringement", "dealings in the software")),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.", ("source code form is subject to the terms of the mozilla public license",)),
    Template("ofl-1.1", "This Font Software is licensed under the SIL Open Font License, Version 1.1.", ("sil open font license",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software released into the public domain",)),
    Template("unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.", ("anyone is free to copy modify publish use compile sell or distribute this software",)),
    Template("wtfpl", "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE", ("what the fuck you want to public license",)),
    Template("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions", ("authors be held liable for any damages arising from the use of this software", "alter it and redistribute it freely")),
)
#: Share of a notice's words that must stand at their places, in tenths.
TENTHS = 6


def _literal(templates: tuple[Template, ...], anchors: list[tuple[str, int]]):
    """The index as a literal: words, key flags, label and base of each template, with its rarest key word and that word's first place among the keys."""
    one = lambda x, a: F.struct(F.array(*map(F.lit, x.words)).alias("words"), F.array(*map(F.lit, x.must)).alias("must"), F.lit(x.label).alias("label"), F.lit(x.base).alias("base"), F.lit(a[0]).alias("anchor"), F.lit(a[1]).alias("offset"))
    return F.array(*[one(x, a) for x, a in zip(templates, anchors, strict=True)])


def scan_licenses(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, tenths: int = TENTHS) -> DataFrame:
    """The license notices of every whole text (null: empty), one row for each input row.

    The document frequency of the templates' key words over the whole table gives their IDF. A file is
    looked into if it has all key words of a template. There the positions of each template's
    highest-IDF key word are looked up; each of them fixes one place where the template could
    start, and the template's words are intersected with the file's by relative position from there: a place
    counts if the key phrases stand word for word and at least `tenths` tenths of the template's words
    do. Rows: doc_id, n_words, n_base (places
    of base templates), first_word and last_word (least and greatest start of those, else null),
    base_labels and labels (distinct, sorted, comma-joined), score (greatest share of a template's
    words at a place, 0 without any).

    Null and repeated doc_id and repeated rows are scanned one by one, other columns are ignored, an
    empty table gives no rows. All steps are DataFrame expressions inside a row; nothing is shuffled but the
    frequencies, which are bounded by the templates, as is the index.
    """
    spark = docs.sparkSession
    lower = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    keys = [sorted({w for w, must in zip(x.words, x.must, strict=True) if must}) for x in templates]
    words = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.regexp_extract_all(lower, F.lit(WORD), F.lit(0)).alias("words"))
    have = words.withColumn("have", F.array_distinct(F.filter("words", lambda w: w.isin(sorted({w for k in keys for w in k})))))
    sets = F.array(*[F.array(*map(F.lit, k)) for k in keys])
    possible = F.filter(F.transform(sets, lambda k, t: F.when(F.forall(k, lambda w: F.array_contains("have", w)), t)), lambda t: t.isNotNull())
    have = have.withColumn("possible", F.when(F.size("have") > 0, possible).otherwise(F.array().cast("array<int>")))
    found = have.select("doc_id", F.size("words").cast("long").alias("n_words"), "have", "possible", F.when(F.size("possible") > 0, F.col("words")).alias("words"))
    found = Scratch(spark, "licenses").put(found, "files")
    df = {r["word"]: r["n"] for r in found.select(F.explode("have").alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()}
    anchors = []
    for x, key in zip(templates, keys, strict=True):
        rarest = min(key, key=lambda w: (df.get(w, 0), w))
        anchors.append((rarest, next(i for i, (w, must) in enumerate(zip(x.words, x.must, strict=True)) if must and w == rarest)))
    index = _literal(templates, anchors)
    text = F.col("words")

    def places(t: Column) -> Column:
        one = F.element_at(index, t + 1)
        starts = F.transform(F.filter(F.transform(text, lambda w, i: F.when(w == one["anchor"], i)), lambda i: i.isNotNull()), lambda at: at - one["offset"])

        def at(start: Column) -> Column:
            hit = F.transform(one["words"], lambda w, i: F.coalesce(F.get(text, start + i) == w, F.lit(False)))
            held = F.forall(F.zip_with(hit, one["must"], lambda h, m: h | ~m), lambda x: x)
            return F.struct(start.cast("long").alias("start"), one["base"].alias("base"), one["label"].alias("label"), held.alias("held"), F.size(F.filter(hit, lambda h: h)).alias("n"), F.size(one["words"]).alias("size"))

        return F.filter(F.transform(starts, at), lambda p: p["held"] & (p["n"] * 10 >= tenths * p["size"]))

    looked = found.select("doc_id", "n_words", F.explode(F.array(F.coalesce(F.flatten(F.transform("possible", places)), F.array()))).alias("places"))
    base = F.transform(F.filter("places", lambda p: p["base"]), lambda p: p["start"])
    join = lambda some: F.array_join(F.array_sort(F.array_distinct(F.transform(some, lambda p: p["label"]))), ",")
    best = F.coalesce(F.array_max(F.transform("places", lambda p: p["n"] / p["size"])), F.lit(0.0))
    return looked.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(base).alias("first_word"), F.array_max(base).alias("last_word"),
        join(F.filter("places", lambda p: p["base"])).alias("base_labels"), join(F.col("places")).alias("labels"), best.alias("score"),
    )


def op1_licenses(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_ROWS = [(t, x.label, x.base, at, w, int(must), len(x.words), sum(x.must)) for t, x in enumerate(TEMPLATES) for at, (w, must) in enumerate(zip(x.words, x.must, strict=True))]
_VALUES = ", ".join(f"({t}, '{label}', {base}, {at}, '{w}', {must}, {size}, {musts})" for t, label, base, at, w, must, size, musts in _ROWS)
OP1_SQL = f"""
WITH post(t, label, base, place, word, must, size, musts) AS (VALUES {_VALUES}),
d AS (SELECT row_number() OVER () AS rid, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{WORD}') AS w FROM documents),
hit AS (SELECT rid, unnest(w) AS word, unnest(range(len(w))) AS i FROM d),
held AS (SELECT rid, t, i - place AS start FROM hit JOIN post USING (word) WHERE must = 1 GROUP BY rid, t, i - place HAVING count(*) = any_value(musts)),
place AS (SELECT held.rid, held.t, any_value(label) AS label, any_value(base) AS base, start, count(*) / any_value(size) AS share
          FROM held JOIN post USING (t) JOIN hit ON hit.rid = held.rid AND hit.i = start + place AND hit.word = post.word GROUP BY held.rid, held.t, start
          HAVING count(*) * 10 >= {TENTHS} * any_value(size)),
f AS (SELECT rid, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
      FROM place GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN f USING (rid)
"""
