"""Quality, toxicity, URL filter and license scan: held-out accuracy, rules by brute force, edge cases."""
import random
import re

import numpy as np
import pytest
from conftest import SF_CHECK
from pyspark.sql import functions as F

from tidewatch.llm import license_scan, quality, queries, toxicity, url_filter

from .conftest import EDGE

LABELS = "doc_id long, quality int, toxic int, p0 int, fold int"


# ---- quality

def test_em_recovers_accuracies():
    rng = np.random.default_rng(1)
    n, accuracy = 20000, [0.95, 0.9, 0.8, 0.7, 0.85, 0.9, 0.75]
    truth = rng.random(n) < 0.8
    votes = np.where(rng.random((n, 7)) < 0.1, 0, np.where((rng.random((n, 7)) < accuracy) == truth[:, None], quality.GOOD, quality.BAD))
    pattern, count = np.unique(votes, axis=0, return_counts=True)
    share, emits = quality.expectation_maximisation(pattern, count.astype(float))
    m = quality.Model(share, emits, np.zeros(quality.DIMS + 1))
    assert abs(share - 0.8) < 0.02
    assert all(abs(a - b) < 0.03 for a, b in zip(m.accuracy().values(), accuracy))
    assert ((m.posterior(votes) > 0.5) == truth).mean() > 0.95


def test_quality_held_out(spark):
    """Trained without any label; judged against the given ones."""
    docs, labels = (spark.read.parquet(f"{SF_CHECK}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.judge(docs, quality.train(docs)).join(labels, "doc_id").select("quality", "keep").collect()
    good = [r.keep for r in got if r.quality == 1]
    bad = [not r.keep for r in got if r.quality == 0]
    assert sum(good) / len(good) > 0.99 and sum(bad) / len(bad) > 0.9


def test_quality_edges(spark, docs_of):
    docs = docs_of(EDGE)
    model = quality.train(docs)
    rows = quality.judge(docs, model).collect()
    assert len(rows) == len(EDGE) and sorted((r.doc_id for r in rows), key=str) == sorted((i for i, _ in EDGE), key=str)
    by_id = {r.doc_id: r for r in rows}
    assert all(by_id[i].score == 0 and not by_id[i].keep for i in (1, 2, 3))
    kept = quality.kept(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.keep for r in rows)
    empty = docs_of([])
    assert quality.judge(empty, quality.train(empty)).collect() == []


# ---- toxicity

def test_chain_uses_out_of_fold_predictions():
    """A second category that follows from the first is learnt from its probability."""
    rng = np.random.default_rng(2)
    n = 600
    first = rng.random(n) < 0.4
    rows = toxicity.Rows.of([(np.unique(np.append(rng.integers(100, 400, 12), rng.integers(0, 10, 3) if a else rng.integers(400, 420, 2))), None) for a in first for _ in [0]][:0] or
                            [(i := np.unique(np.append(rng.integers(100, 400, 12), rng.integers(0, 10, 3) if a else rng.integers(400, 420, 2))), np.ones(len(i))) for a in first])
    chain = toxicity.fit_chain(rows, {"a": first.astype(int), "b": first.astype(int)}, np.arange(n) % 3)
    p = chain.predict(rows)
    assert ((p[:, 0] > 0.5) == first).mean() > 0.97 and ((p[:, 1] > 0.5) == first).mean() > 0.97
    assert chain.weights[1][toxicity.DIMS] > 0.5


def test_toxic_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF_CHECK.replace('0.01', '0.1')}/{t}.parquet") for t in ("documents", "labels"))
    train, held = labels.where("doc_id % 4 <> 0"), labels.where("doc_id % 4 = 0")
    chain = toxicity.train(docs, train, {"junk": F.col("quality") == 0, "toxic": F.col("toxic") == 1})
    got = toxicity.judge(docs, chain).withColumnRenamed("toxic", "said").join(held, "doc_id").select("said", "toxic").collect()
    toxic = [r.said for r in got if r.toxic == 1]
    clean = [r.said for r in got if r.toxic == 0]
    assert sum(toxic) / len(toxic) > 0.8 and sum(clean) / len(clean) < 0.01


def test_toxicity_edges(spark, docs_of):
    labels = spark.createDataFrame([(4, 1, 0, 1, 1), (5, 1, None, 1, 1), (6, 0, 1, 1, 1), (6, 0, 0, 1, 1), (None, 1, 1, 1, 1), (999, 1, 1, 1, 1)], LABELS)
    kinds = {"junk": F.col("quality") == 0, "toxic": F.col("toxic") == 1}
    chain = toxicity.train(docs_of(EDGE), labels, kinds)
    rows = toxicity.judge(docs_of(EDGE), chain).collect()
    assert len(rows) == len(EDGE) and all(0 <= r.p_toxic <= 1 for r in rows)
    assert toxicity.judge(docs_of([]), chain).collect() == []
    none = toxicity.train(docs_of(EDGE), labels.limit(0), kinds)
    assert toxicity.judge(docs_of(EDGE), none).count() == len(EDGE)


# ---- URL filter

def brute_url(url, rules):
    at = (url or "").find("://")
    rest = url[at + 3:] if at >= 0 else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for verdict, rule in rules:
        h, slash, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith(slash + p) and (best is None or len(rule) > len(best[1])):
            best = (verdict, rule)
    return host, path, best


URLS = [None, "", "no scheme", "http://", "https://EXAMPLE.org/es/1?x=1#y", "http://a.b.example.org/en/17", "http://example.org/en/2", "http://notexample.org/es/", "http://x.com/fr/?a=1&b=2",
        "http://com/fr/", "http://x.com/de/", "http://x.org", "http://x.org?q=/a", "http://x.org/#f", "ftp://Ü.org/ä b", "http://a://b/c", "http://user@x.com:80/de/", "x" * 5000, "http://x.net/" + "%20" * 900]


def test_urls(spark):
    rows = [(i, u, 1, 2) for i, u in enumerate(URLS)] + [(None, URLS[4], 1, 2), (4, URLS[4], 1, 2)] + [(100 + i, f"http://h{i % 7}.example.{s}/{p}/{i}", 1, 2) for i in range(60) for s, p in (("org", "es"), ("org", "fr"), ("com", "de"), ("com", "fr"), ("net", "en"))]
    df = spark.createDataFrame(rows, "page_id long, url string, host int, label int")
    got = url_filter.judge(df, queries.RULES).collect()
    assert len(got) == len(rows)
    want = sorted(((i, *brute_url(u, queries.RULES)[:2], (brute_url(u, queries.RULES)[2] or (None, None))[1]) for i, u, *_ in rows), key=str)
    assert sorted(((r.page_id, r.host, r.path, r.rule) for r in got), key=str) == want
    verdict = {rule: v for v, rule in queries.RULES}
    assert all(r.verdict == (verdict[r.rule] if r.rule else r.model) and r.verdict in ("allow", "block") for r in got)


def test_url_trees_held_out(spark):
    """The trees, fitted on the rules' verdicts of half the URLs, judge the other half."""
    pages = spark.read.parquet(f"{SF_CHECK.replace('0.01', '0.1')}/pages.parquet")
    host, path = url_filter.host_and_path(F.col("url"))
    known = F.when(F.col("page_id") % 2 == 0, url_filter.rule_of(host, path, queries.RULES)["verdict"])
    got = url_filter.judge(pages, queries.RULES, labels=F.when(known == "block", 1).when(known == "allow", 0)).where("rule IS NOT NULL AND page_id % 2 = 1").select("verdict", "model").collect()
    assert len(got) > 300 and sum(r.verdict == r.model for r in got) / len(got) > 0.9


def test_url_without_labels(spark):
    df = spark.createDataFrame([(1, "http://a.net/x"), (2, None)], "page_id long, url string")
    assert {r.verdict for r in url_filter.judge(df, queries.RULES).collect()} == {"allow"}
    one = spark.createDataFrame([(1, "http://x.com/de/1"), (2, "http://y.net/")], "page_id long, url string")
    assert {r.verdict for r in url_filter.judge(one, queries.RULES).collect()} == {"block"}
    assert url_filter.judge(df.limit(0), queries.RULES).collect() == []


# ---- license scan

def brute_licenses(rows, templates, least=0.8):
    out = {}
    for d, text in rows:
        w = license_scan.template_words(text or "")
        for name, t in templates.items():
            tw = license_scan.template_words(t)
            k = min(5, len(tw))
            if not k:
                continue
            own = {tuple(tw[i:i + k]) for i in range(len(tw) - k + 1)}
            size = len(tw) - k + 1
            sh = [tuple(w[i:i + k]) for i in range(len(w) - k + 1)]
            for s in range(max(1, len(sh) - size + 1) if sh else 0):
                c = len(own & set(sh[s:s + size])) / len(own)
                if c >= least and (-c, s) < out.get((d, name), (0, 0)):
                    out[d, name] = (-c, s)
    return sorted((d, n, -c, s) for (d, n), (c, s) in out.items())


def test_licenses(spark, docs_of):
    t = license_scan.TEMPLATES
    filler = "some words that stand around it and say nothing at all"
    rows = [(30, f"{filler} {t['apache-2.0'].upper()} {filler}"), (31, t["mit"]), (32, "released under the mit licence"), (33, f"{t['gpl-3.0']} {filler} {t['gpl-3.0']} {t['cc-by-nc-4.0']}"),
            (34, "all\nrights -- reserved"), (35, "this work is licensed under the gnu general public license"), (36, "work is licensed under the gnu general public license version 3"), (37, (filler + " ") * 500 + t["mit"]),
            (38, "licensed license released reserved"), (39, "Licensed under the Apache License, Version 2")] + [r for r in EDGE if r[0] is not None and r[0] != 6]
    got = license_scan.scan(docs_of(rows)).collect()
    assert sorted((r.doc_id, r.license, r.containment, r.first_word) for r in got) == brute_licenses(rows, t)


STATEMENTS = {
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.": {"gpl-notice", "gpl-2.0-or-later-notice"},
    "you can redistribute it and/or\n * modify it under the terms of the GNU Lesser General Public\n * License as published by the Free Software Foundation; either\n * version 2.1 of the License, or later": {"lgpl-notice", "lgpl-2.1-or-later-notice"},
    "it can be copied under the terms of the GNU Affero General Public License as published by the Free Software Foundation, version 3 of the License.": {"agpl-3.0-only-notice"},
    "This work is licensed under the GNU General Public License, version 2.": {"gpl-2.0"},
    "This work is licensed under the GNU General Public License, version 3.": {"gpl-3.0"},
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": {"cc-by-sa-4.0-notice"},
    "Licensed under CC BY 4.0.": {"cc-by-4.0-licensed"},
    "Licensed under CC BY-SA 4.0.": {"cc-by-sa-4.0-licensed"},
    "// SPDX-License-Identifier: LGPL-2.1-or-later": {"spdx-lgpl-2.1"},
    "# SPDX-License-Identifier: MIT": {"spdx-mit"},
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.": {"mpl-2.0-notice"},
}


def test_license_families(spark, docs_of):
    """Statements of the common families, as texts have them, each under its own version and family."""
    rows = [(i, f"some words before. {t} Some words after.") for i, t in enumerate(STATEMENTS)]
    got = {}
    for r in license_scan.scan(docs_of(rows)).collect():
        got.setdefault(r.doc_id, set()).add(r.license)
    assert got == dict(enumerate(STATEMENTS.values()))


def test_whole_license_texts(spark, docs_of):
    """Whole texts are found where they stand; shorter ones, edited, as brute force has them."""
    random.seed(4)
    rows = [(i, "one two three " * i + t) for i, t in enumerate(license_scan.TEXTS.values())]
    got = {(r.doc_id, r.license): (r.containment, r.first_word) for r in license_scan.scan(docs_of(rows)).collect()}
    for i, name in enumerate(license_scan.TEXTS):
        share, first = got[i, name]
        assert share == 1.0 and 3 * i - 4 <= first <= 3 * i  # earlier where the last shingles stand in the text before
    few = {n: t for n, t in {**license_scan.TEMPLATES, **license_scan.TEXTS}.items() if len(t) < 2000}
    rows = []
    for d, t in enumerate(list(few.values()) * 2):
        w = t.split()
        for _ in range(random.randrange(1 + len(w) // 30)):
            at = random.randrange(len(w))
            w[at:at + random.randrange(2)] = ["edited"]
        rows.append((d, " ".join(["before"] * random.randrange(30) + w + ["after"] * random.randrange(30) + w[:random.randrange(len(w))])))
    got = license_scan.scan(docs_of(rows), few).collect()
    assert sorted((r.doc_id, r.license, r.containment, r.first_word) for r in got) == brute_licenses(rows, few)
    assert {r.license for r in got} == set(few)


def test_long_templates(spark, docs_of):
    """Windows not at every shingle: every license within reach is found, words edited."""
    random.seed(9)
    words = license_scan.template_words(license_scan.TEMPLATES["mit-permission"]) * 3
    template = " ".join(f"{w}{i}" for i, w in enumerate(words))
    rows = []
    for d in range(40):
        own = template.split()
        for _ in range(d % 3):
            own[random.randrange(len(own))] = "edited"
        rows.append((d, "pre " * random.randrange(40) + " ".join(own) + " post" * random.randrange(40)))
    got = {r.doc_id: r.containment for r in license_scan.scan(docs_of(rows), {"long": template}).collect()}
    want = {d: c for d, _, c, _ in brute_licenses(rows, {"long": template}, 0.85)}
    assert want.keys() <= got.keys() and all(got[d] >= c for d, c in want.items())


def test_bands_guarantee():
    b, similarity = license_scan.bands_for(0.8, 0.999), 0.8 / 1.2
    assert 1 - (1 - similarity ** license_scan.ROWS) ** b >= 0.999 > 1 - (1 - similarity ** license_scan.ROWS) ** (b - 1)


def test_license_edges(spark, docs_of):
    assert license_scan.scan(docs_of([])).collect() == []
    assert license_scan.scan(docs_of(EDGE), {"none": "..."}).collect() == []
    twice = [(1, "All rights reserved."), (1, "x All rights reserved."), (None, "All rights reserved.")]
    assert sorted(map(tuple, license_scan.scan(docs_of(twice)).collect()), key=str) == [(1, "all-rights-reserved", 1.0, 0), (None, "all-rights-reserved", 1.0, 0)]


def test_native_plans(spark, docs_of):
    """The two native operators run no Python on the executors."""
    pages = spark.createDataFrame([(i, f"http://h{i % 5}.example.{s}/{p}/{i}") for i in range(20) for s, p in (("org", "es"), ("com", "fr"), ("net", "en"))], "page_id long, url string")
    for df in (license_scan.scan(docs_of(EDGE)), url_filter.judge(pages, queries.RULES)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
