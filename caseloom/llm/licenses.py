"""License scans by Dice coefficient over word bigrams, in DataFrame operations only.

A text, normalised to lower-case words, is a sequence of word bigrams, and so
is a template: a notice of one sentence or a whole licence. A window is as
long as the template it is compared with and may lie anywhere, inside a line
or across lines. Dice is twice the shared over the sum of the numbers of
distinct bigrams.

What is compared is pruned in three steps, of which the first two lose
nothing: a window that matches shares at least a / (2b - a) of the template's
bigrams (for a share a / b), so a template is dropped if the text holds fewer
bigrams of any template than that, then if it holds fewer of this one; then
windows start only where the positions of the text's and the template's equal
bigrams agree on a start, for long templates a sixteenth of them at least.
Everything happens inside a document's row: no shuffle, no Python.
"""

from __future__ import annotations

import json
import re
from pathlib import Path

import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.quality import bound
from caseloom.session import table

#: A window matches from this Dice coefficient on, as a fraction.
SHARE = (8, 10)
#: Of a template's distinct bigrams one in so many must agree on a window's start.
AGREE = 16

#: Notices and paragraphs of public licences. Those of one licence share its name.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("BSD", "Licensed under the BSD License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("Apache-2.0", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("All-rights-reserved", "All rights reserved."),
)




def texts_in(folder: Path) -> tuple[tuple[str, str], ...]:
    """(name, text) of every ``<name>.txt`` of a folder, by name."""
    return tuple((p.stem, p.read_text(encoding="utf-8")) for p in sorted(folder.glob("*.txt")))


#: Notices and the whole texts of public licences, each in a file of its name.
TEMPLATES = NOTICES + texts_in(Path(__file__).with_name("licence_texts"))


def _bigrams(text: str) -> list[tuple[str, str]]:
    """Word bigrams of a text in order, normalised as ``_words`` does."""
    words = re.sub(r"[\W_]+", " ", text.lower()).split()
    return list(zip(words, words[1:]))


def _hash(pair: tuple[str, str]) -> int:
    """Spark's ``xxhash64`` of two strings."""
    seed = 42
    for word in pair:
        seed = xxhash.xxh64_intdigest(word.encode(), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def _words(text: Column) -> Column:
    """Runs of letters and digits, in lower case."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _literal(value, kind: str) -> Column:
    """A nested constant, folded once when the plan is made."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, share: tuple[int, int] = SHARE) -> DataFrame:
    """(id, matches) of every row: array<struct<word, license, dice>>, by word.

    A template matches where its best window (of equal ones the first) has a
    Dice coefficient of ``share`` or more; ``word`` is the window's first word,
    counted from 0. Of matches that overlap, those stay that no other beats in
    shared bigrams times Dice, ties going to the larger name and start. Null
    and empty texts and texts of one word match nothing. Rows are judged one
    by one, so repeated rows agree, and an empty table gives no rows. Texts of
    any length are read whole; memory is in proportion to one text. Only the
    two columns are read. ``templates`` are (name, text), of two words or more.
    """
    a, b = share
    hashed = [(name, list(map(_hash, _bigrams(text)))) for name, text in templates]
    known = _literal([{"name": name, "n": len(set(seq)), "seq": seq} for name, seq in hashed], "array<struct<name string, n int, seq array<bigint>>>")
    vocabulary = _literal(sorted({g for _, seq in hashed for g in seq}), "array<bigint>")

    def matched(grams: Column, t: Column) -> Column:
        """The best window of one template, else null."""
        enough = F.greatest(F.lit(1), F.floor(t["n"] / AGREE).cast("int"))
        shifts = F.transform(grams, lambda g, i: bound(F.array_position(t["seq"], g), lambda at: F.when(at > 0, F.greatest(F.lit(0), i + 1 - at.cast("int")))))
        starts = bound(F.array_sort(F.array_compact(shifts)), lambda s: F.array_distinct(F.array_compact(F.transform(s, lambda x, j: F.when(F.get(s, j + enough - 1) == x, x)))))

        def scored(start: Column) -> Column:
            def of(window: Column) -> Column:
                n = F.size(F.array_distinct(window))
                shared = F.size(F.array_intersect(window, t["seq"]))
                fits = (n * (2 * b - a) >= t["n"] * a) & (t["n"] * (2 * b - a) >= n * a)
                return F.when(fits & (shared * 2 * b >= (n + t["n"]) * a), F.struct((shared * 2 / (n + t["n"])).alias("dice"), (-start).alias("first"), F.size(window).alias("long"), shared.alias("shared")))

            return bound(F.slice(grams, start + 1, F.size(t["seq"])), of)

        best = F.array_max(F.array_compact(F.transform(starts, scored)))
        return bound(best, lambda m: F.when(m.isNotNull(), F.struct((-m["first"]).alias("word"), t["name"].alias("license"), m["dice"].alias("dice"), m["long"].alias("long"), (m["shared"] * m["dice"]).alias("weight"))))

    def scan(grams: Column) -> Column:
        def near(hits: Column) -> Column:
            some = lambda t: (F.size(hits) * (2 * b - a) >= t["n"] * a) & (F.size(F.array_intersect(t["seq"], hits)) * (2 * b - a) >= t["n"] * a)
            return F.filter(known, some)

        found = F.array_compact(F.transform(bound(F.array_intersect(grams, vocabulary), near), lambda t: matched(grams, t)))
        rank = lambda m: F.struct(m["weight"], m["license"], m["word"])
        beaten = lambda all_, m: F.exists(all_, lambda o: (o["word"] < m["word"] + m["long"]) & (m["word"] < o["word"] + o["long"]) & (rank(o) > rank(m)))
        kept = bound(found, lambda all_: F.filter(all_, lambda m: ~beaten(all_, m)))
        return F.array_sort(F.transform(kept, lambda m: F.struct(m["word"], m["license"], m["dice"])))

    def grams(words: Column) -> Column:
        return F.when(F.size(words) >= 2, F.transform(F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1)))).otherwise(F.array().cast("array<bigint>"))

    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col), bound(bound(_words(text), grams), scan).alias("matches"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents"))
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"])))
    return found.select("doc_id", F.size("matches").cast("long").alias("n_matches"), F.array_join(names, ",").alias("licenses"), F.round(F.array_max(F.transform("matches", lambda m: m["dice"])), 6).alias("best_dice"), F.array_min(F.transform("matches", lambda m: m["word"])).cast("long").alias("first_word"))


QUERIES = {"op9_license_scan": op9_license_scan}
_QUOTED = ", ".join("({}, '{}', [{}])".format(k, name, ", ".join(f"'{x} {y}'" for x, y in _bigrams(text))) for k, (name, text) in enumerate(TEMPLATES))
ORACLE_SQL = {
    "op9_license_scan": f"""
WITH templates(t, license, seq) AS (VALUES {_QUOTED}),
sized AS (SELECT t, license, len(seq) AS long, len(list_distinct(seq)) AS n FROM templates),
offsets AS (SELECT t, g, min(o) AS o FROM (SELECT t, unnest(seq) AS g, generate_subscripts(seq, 1) - 1 AS o FROM templates) GROUP BY t, g),
norm AS (
  SELECT row_number() OVER () AS k, doc_id,
         list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w
  FROM documents
), grams AS (
  SELECT k, i - 1 AS i, w[i] || ' ' || w[i + 1] AS g FROM (SELECT k, w, unnest(range(1, len(w))) AS i FROM norm)
), hits AS (
  SELECT k, t, g, greatest(i - o, 0) AS s FROM grams JOIN offsets USING (g)
), near AS (
  SELECT k, t FROM hits JOIN sized USING (t) GROUP BY k, t, n HAVING count(DISTINCT g) * 12 >= n * 8
), starts AS (
  SELECT k, t, s FROM hits JOIN near USING (k, t) JOIN sized USING (t) GROUP BY k, t, s, n HAVING count(*) >= greatest(1, n // {AGREE})
), windows AS (
  SELECT k, t, s, count(*) AS wide, count(DISTINCT g) AS nw, count(DISTINCT CASE WHEN o IS NOT NULL THEN g END) AS shared
  FROM starts JOIN sized USING (t) JOIN grams USING (k) LEFT JOIN offsets USING (t, g)
  WHERE i >= s AND i < s + long GROUP BY k, t, s
), scored AS (
  SELECT k, t, license, s, wide, shared, shared * 2 / (nw + n) AS dice FROM windows JOIN sized USING (t)
  WHERE shared * 20 >= (nw + n) * 8 AND 12 * nw >= 8 * n AND 12 * n >= 8 * nw
), best AS (
  SELECT *, shared * dice AS weight FROM (SELECT *, row_number() OVER (PARTITION BY k, t ORDER BY dice DESC, s) AS nth FROM scored) WHERE nth = 1
), kept AS (
  SELECT * FROM best m WHERE NOT EXISTS (
    SELECT 1 FROM best o WHERE o.k = m.k AND o.s < m.s + m.wide AND m.s < o.s + o.wide AND (o.weight, o.license, o.s) > (m.weight, m.license, m.s))
)
SELECT doc_id, count(s) AS n_matches, coalesce(string_agg(DISTINCT license, ',' ORDER BY license), '') AS licenses,
       round(max(dice), 6) AS best_dice, min(s)::BIGINT AS first_word
FROM norm LEFT JOIN kept USING (k) GROUP BY k, doc_id
"""
}
