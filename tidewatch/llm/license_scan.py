"""License scan: MinHash bands over overlapping text windows, then exact containment.

Native: DataFrame functions only.

1. Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. A template of T
   five-word shingles (fewer words: all of them as one shingle) is sought in
   overlapping windows of T shingles.
2. Before that, texts drop out that hold none of the templates' ``anchors``, and
   texts with fewer shingles of a template than a match needs. Both are necessary
   conditions, so nothing is lost.
3. Windows start at every T // 8 shingles (at least every one) and at the last place.
   Each that holds enough shingles of the templates of its size gets MinHash bands
   of ``ROWS`` values over those shingles. The window next to a match starts at most
   half a step beside it; the number of bands makes it collide with probability of
   at least ``certainty``. Colliding bands retrieve the templates.
4. Retrieved templates are verified on the text: the share of the template's
   shingles is counted for every window of T shingles, at every place, and the best
   must reach ``least``.

One row per document id and license: the best containment and the first word
(from 0) of the first window that has it. Templates that share most of their text
(GPL and AGPL, BSD with two and three clauses) each have a row of their own.
Documents that match nothing, null, empty and shorter texts, have no row. Rows
with one id count together; rows with a null id match under the null id.
Templates without words match nothing. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import pkgutil
import re
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, whole_text

SHINGLE = 5
LEAST = 0.8
CERTAINTY = 0.999
ROWS = 2
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The sentences and notices by which texts state their licenses, cut so that
# another version or family leaves less than 0.8 of them.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "under the GNU General Public License, version 3",
    "mit": "Released under the MIT License.",
    "mit-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-licensed": "Licensed under the MIT License.",
    "bsd-licensed": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "isc-permission": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "gpl-2.0": "under the GNU General Public License, version 2",
    "gpl-notice": "you can redistribute it and/or modify it under the terms of the GNU General Public License",
    "lgpl-notice": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
    "lgpl-2.0-notice": "you can redistribute it and/or modify it under the terms of the GNU Library General Public License",
    "agpl-notice": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License",
    **{f"{name}-{version}-{form}": f"terms of the GNU {family} as published by the Free Software Foundation{before} version {version.removesuffix('.0')} of the License"
       for name, family, versions in (("gpl", "General Public License", ("2.0", "3.0")), ("lgpl", "Lesser General Public License", ("2.1", "3.0")), ("agpl", "Affero General Public License", ("3.0",)))
       for version in versions for form, before in (("or-later-notice", ", either"), ("only-notice", ";"))},
    "agpl-3.0-network": "Notwithstanding any other provision of this License, if you modify the Program, your modified version must prominently offer all users interacting with it remotely through a computer network (if your version supports such interaction) an opportunity to receive the Corresponding Source of your version by providing access to the Corresponding Source from a network server at no charge, through some standard or customary means of facilitating copying of software.",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    **{f"{code.lower().replace(' ', '-')}-4.0-{form}": text
       for code, name in (("CC BY", "Attribution"), ("CC BY SA", "Attribution-ShareAlike"), ("CC BY ND", "Attribution-NoDerivatives"), ("CC BY NC", "Attribution-NonCommercial"), ("CC BY NC SA", "Attribution-NonCommercial-ShareAlike"), ("CC BY NC ND", "Attribution-NonCommercial-NoDerivatives"))
       for form, text in (("licensed", f"Licensed under {code} 4.0."), ("notice", f"licensed under a Creative Commons {name} 4.0 International License")) if (code, form) != ("CC BY NC", "licensed")},
    **{f"spdx-{code.lower()}": f"SPDX-License-Identifier: {code}"
       for code in ("MIT", "ISC", "0BSD", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "MPL-2.0", "Unlicense", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0",
                    "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0")},
}
# Whole license texts, in ``licenses``.
TEXTS = {f"{name}-text": pkgutil.get_data(__package__, f"licenses/{name}.txt").decode()
         for name in ("mit", "isc", "bsd-2-clause", "bsd-3-clause", "apache-2.0", "gpl-2.0", "gpl-3.0", "lgpl-2.1", "lgpl-3.0", "mpl-2.0", "cc0-1.0")}


def bands_at(similarity: float, certainty: float, rows: int = ROWS) -> int:
    """Bands after which a set of that similarity has collided with that probability."""
    return math.ceil(math.log(1 - certainty) / math.log(1 - similarity ** rows)) if similarity < 1 else 1


def bands_for(least: float, certainty: float, rows: int = ROWS) -> int:
    """Bands after which a window of that containment has collided with that probability."""
    return bands_at(least / (2 - least), certainty, rows)


def template_words(text: str) -> list[str]:
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text))


def needed(shingles: int, least: float) -> int:
    """Fewest of a template's distinct shingles whose share reaches ``least`` (at least one)."""
    return next((c for c in range(max(1, int(least * shingles) - 1), shingles + 1) if c / shingles >= least), shingles + 1)


def anchors(known: dict[str, list[str]], least: float) -> list[str]:
    """Words such that a text that matches a template holds one of them: so many of the
    template's shingles have one that too few for a match are left. Long words that
    many shingles have come first."""
    found: list[str] = []
    for w in sorted(known.values(), key=lambda w: (-len(w), w)):
        k = min(SHINGLE, len(w))
        left = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}
        need = needed(len(left), least)
        left = {s for s in left if not any(a in x for a in found for x in s)}
        while len(left) >= need:
            gain = Counter(x for s in left for x in set(s))
            found.append(max(gain, key=lambda x: (len(x) > 5, gain[x], len(x), x)))
            left = {s for s in left if not any(found[-1] in x for x in s)}
    return found


def _shingles(words: str, k: int) -> Column:
    """Hashes of all runs of k words of an array column."""
    last = F.size(words) - k
    return F.when(last >= 0, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(0)) + 1), lambda i: F.xxhash64(F.slice(words, i, k)))).otherwise(F.array().cast("array<bigint>"))


def _band_keys(window: str, kind: str, bands: int) -> Column:
    """Keys of a window's MinHash bands; ``kind`` keeps window sizes apart."""
    def least_hash(seed: int) -> Column:
        return F.array_min(F.transform(window, lambda x: F.xxhash64(x, F.lit(seed))))

    least = [least_hash(s) for s in range(bands * ROWS)]
    return F.array(*[F.xxhash64(kind, F.lit(b), *least[b * ROWS:(b + 1) * ROWS]) for b in range(bands)])


def _windows() -> Column:
    """Windows (the hashes they hold of ``hits``) at every ``step`` and at the last place.

    Each is listed at the first hit that it holds."""
    last = F.greatest(F.lit(1), F.col("n") - F.col("size") + 1)

    def of(x: Column, i: Column) -> Column:
        low = F.greatest(F.lit(1), x.p - F.col("size") + 1, F.when(i > 0, F.get("hits", i - 1).p + 1).otherwise(1))
        high = F.least(x.p, last)
        first = (F.ceil((low - 1) / F.col("step")) * F.col("step") + 1).cast("int")
        starts = F.when(first <= high, F.sequence(first, F.greatest(first, high), F.col("step"))).otherwise(F.array().cast("array<int>"))
        starts = F.array_union(starts, F.when((low <= last) & (last <= high), F.array(last)).otherwise(F.array().cast("array<int>")))
        return F.transform(starts, lambda s: F.transform(F.filter(F.slice("hits", i + 1, F.col("size")), lambda y: y.p < s + F.col("size")), lambda y: y.h))

    return F.filter(F.flatten(F.transform("hits", of)), lambda w: F.size(w) >= F.col("floor"))


def _best(own: Column) -> Column:
    """(most distinct hashes of ``own`` in a window of ``size``, first place of such a window).

    ``own`` is sorted by hash and place. A hash counts from where its last place
    before has left the window up to its own place: one step up, one step down."""
    last = F.greatest(F.lit(1), F.col("n") - F.col("size") + 1)

    def steps(x: Column, i: Column) -> Column:
        before = F.get(own, i - 1)
        low = F.greatest(F.lit(1), x.p - F.col("size") + 1, F.when((i > 0) & (before.h == x.h), before.p + 1).otherwise(1))
        high = F.least(x.p, last)
        return F.when(low <= high, F.array(2 * low + 1, 2 * high + 2)).otherwise(F.array().cast("array<int>"))

    def add(a: Column, e: Column) -> Column:
        now = F.when(e % 2 == 1, a.now + 1).otherwise(a.now - 1)
        more = now > a.most
        return F.struct(now.alias("now"), F.when(more, now).otherwise(a.most).alias("most"), F.when(more, F.shiftright(e, 1)).otherwise(a.place).alias("place"))

    zero = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"), F.lit(0).alias("place"))
    return F.aggregate(F.sort_array(F.flatten(F.transform(own, steps))), zero, add)


def _in(what: str, hashes: set[int]) -> str:
    return f"{what} IN ({', '.join(f'{x}L' if x > -(1 << 63) else '-9223372036854775807L - 1L' for x in sorted(hashes))})"


def scan(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text", *, least: float = LEAST, certainty: float = CERTAINTY) -> DataFrame:
    """Matches: id, license, containment, first_word."""
    spark = docs.sparkSession
    known = {name: w for name, t in ({**TEMPLATES, **TEXTS} if templates is None else templates).items() if (w := template_words(t))}
    kinds: dict[tuple[int, int], list[str]] = {}
    for name, w in known.items():
        k = min(SHINGLE, len(w))
        kinds.setdefault((k, len(w) - k + 1), []).append(name)
    kind_names = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, license string, containment double, first_word long"
    if not known:
        return spark.createDataFrame([], kind_names)

    given = spark.createDataFrame([(name, kind, len(names) == 1, known[name]) for kind, names in enumerate(kinds.values()) for name in names], "license string, kind int, alone boolean, words array<string>")
    own = F.lit(None).cast("array<bigint>")
    for k in sorted({k for k, _ in kinds}):
        of = [kind for kind, (x, _) in enumerate(kinds) if x == k]
        own = F.when(F.col("kind").isin(of), _shingles("words", k)).otherwise(own)
    given = given.select("license", "kind", "alone", F.array_distinct(own).alias("shingles"))
    hashes: dict[int, list[set[int]]] = {}
    for r in given.collect():  # of the templates, a parameter
        hashes.setdefault(r.kind, []).append(set(r.shingles))

    shares, ways, by_k = [], [], {}
    for kind, (k, size) in enumerate(kinds):
        every = set().union(*hashes[kind])
        by_k.setdefault(k, set()).update(every)
        step = max(1, size // 8)
        floors = [max(1, needed(len(s), least) - step // 2) for s in hashes[kind]]
        shares += [f / min(len(s) + min(size, len(every)) - f, len(every)) for f, s in zip(floors, hashes[kind])]
        need = min(needed(len(s), least) for s in hashes[kind])
        hits = f"filter(hits{k}, x -> {_in('x.h', every)})"
        ways.append(F.expr(f"named_struct('kind', {kind}, 'size', {size}, 'step', {step}, 'floor', {min(floors)}, 'need', {need}, 'n', n{k}, 'hits', {hits})"))
    bands = bands_at(min(1.0, *shares), certainty)

    lowered = lower_ascii(whole_text(text_col))
    words = anchors(known, least)
    # Bound to a variable, the text is lower-cased once for all the conditions.
    src = docs.where(F.exists(F.array(lowered), lambda t: reduce(lambda x, y: x | y, [F.contains(t, F.lit(w)) for w in words], F.lit(False))))
    src = src.select(F.col(id_col).alias("id"), F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0)).alias("words"))
    src = src.select("id", *[_shingles("words", k).alias(f"h{k}") for k in by_k])
    found = [F.expr(f"filter(transform(h{k}, (h, i) -> named_struct('p', i + 1, 'h', h)), x -> {_in('x.h', every)})").alias(f"hits{k}") for k, every in by_k.items()]
    src = src.select("id", *[F.size(f"h{k}").alias(f"n{k}") for k in by_k], *found)
    near = src.select("id", F.explode(F.filter(F.array(*ways), lambda w: F.size(w.hits) >= w.need)).alias("w")).select("id", "w.*")
    near = near.withColumn("keys", F.flatten(F.transform(_windows(), lambda w: _band_keys(w, "kind", bands))))
    near = near.select("id", "size", "n", "hits", "keys", F.explode(F.array_distinct("keys")).alias("key"))

    given = given.withColumn("own_keys", _band_keys("shingles", "kind", bands))
    given = given.select("license", "alone", "shingles", "own_keys", F.explode(F.array_distinct("own_keys")).alias("key"))
    if len(known) * bands <= 100_000:  # beyond that Spark chooses the join
        given = F.broadcast(given)
    # A template is verified once, at the smallest of the keys that collide.
    pairs = near.join(given, "key").where(F.col("key") == F.array_min(F.array_intersect("keys", "own_keys")))
    own = F.when(F.col("alone"), F.col("hits")).otherwise(F.filter("hits", lambda x: F.array_contains("shingles", x.h)))
    own = F.sort_array(F.transform(own, lambda x: F.struct(x.h.alias("h"), x.p.alias("p"))))
    # Bound to a variable, the places are sorted once; a filter before the aggregate would do all of it twice.
    best = pairs.select("id", "license", F.size("shingles").alias("all"), F.transform(F.array(own), _best)[0].alias("b"))
    best = best.select("id", "license", (F.col("b.most") / F.col("all")).alias("containment"), (F.col("b.place") - 1).cast("long").alias("first_word"))
    best = best.groupBy("id", "license").agg(F.min(F.struct((-F.col("containment")).alias("less"), "first_word")).alias("m")).where(-F.col("m.less") >= least)
    return best.select(F.col("id").alias(id_col), "license", (-F.col("m.less")).alias("containment"), "m.first_word")
