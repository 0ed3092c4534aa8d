"""License labels, spans and scores by a plain rule runner; recall of near vectors with the registered settings."""

import math
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from usagelens.llm import language, licenses, nearest, quality

SAID = [
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
    "SPDX-License-Identifier: GPL-2.0-or-later", "Released under CC BY-SA 4.0. MIT License MIT LICENSE mit license", "All rights reserved. For internal use only", "BSD 3-Clause License\nRedistribution and use in source and binary forms", "KIT LİCENSE mit licenſe",
]


def _plain(text, found):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(licenses.NOT_WORD, low) if w]
    line = " " + " ".join(words) + " "
    raw = []
    for r in found:
        if r.keyword in line:
            for m in re.finditer(rf"(?<= )(?:{r.pattern})(?= )", line):
                start = line[: m.start()].count(" ") - 1
                raw.append((r.label, start, start + m[0].count(" ") + 1, r.weight, r.priority))
    inside = lambda a, b: b[1] <= a[1] and a[2] <= b[2] and (b[4] > a[4] or b[4] == a[4] and b[2] - b[1] > a[2] - a[1])
    kept = [a for a in raw if not any(inside(a, b) for b in raw)]
    base = {label for phrase, label in licenses.BASE.items() if f" {phrase} " in line}
    doubt = 0.2 if base else 1.0
    for a in kept:
        doubt *= 1 - a[3]
    return sorted(a[:4] for a in kept), ",".join(sorted(base | {a[0] for a in kept})), 1 - doubt


def test_licenses_by_a_plain_rule_runner(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    more = [(10**6 + i, a + " " + b) for i, (a, b) in enumerate((a, b) for a in SAID for b in SAID)] + [(10**7, None), (10**7 + 1, "")]
    rows = docs.union(spark.createDataFrame(more, "doc_id long, text string")).collect()
    found = licenses.rules()
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    labelled = 0
    for r in rows:
        spans, labels, score = _plain(r.text, found)
        mine = got[r.doc_id]
        assert sorted(tuple(d) for d in mine.detections) == spans and mine.labels == labels and abs(mine.score - score) < 1e-12, r.text
        labelled += bool(spans)
    assert labelled > 60


def test_recall_of_near_vectors_with_the_registered_window(spark):
    rng = np.random.default_rng(8)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    n, planted, c = 16_000, 400, 0.935
    x = unit(rng.standard_normal((n, 64)))
    away = rng.standard_normal((planted, 64))
    away = unit(away - (away * x[:planted]).sum(axis=1, keepdims=True) * x[:planted])
    x = np.concatenate([x, c * x[:planted] + (1 - c * c) ** 0.5 * away]).astype(np.float32)
    y = unit(x.astype(float))
    links = np.zeros(len(x), np.int64)
    for at in range(0, len(x), 2000):
        links[at : at + 2000] = (y[at : at + 2000] @ y.T >= 0.93).sum(axis=1) - 1
    assert links.sum() >= 2 * planted
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int").repartition(8)
    got = np.zeros(len(x), np.int64)
    for r in nearest.near(df).select("vec_id", "n_links").collect():
        got[r.vec_id] = r.n_links
    assert (got <= links).all() and got.sum() >= 0.97 * links.sum()


def test_language_by_plain_decoding(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    model = language.fit(d, F.col("doc_id") % 3 != 1)
    got = {r.doc_id: r for r in language.identify(d, model).collect()}
    for r in d.collect()[::7]:
        if not r.text or not any(c.isalpha() for c in r.text):
            assert (got[r.doc_id].lang_pred, got[r.doc_id].score) == ("und", 0.0)
            continue
        at = np.bincount(language.grams(r.text.lower().encode()), minlength=language.DIMS).astype(float) ** 0.5
        at /= math.sqrt((at * at).sum())
        said = [float(at @ model.weights[:-1, b] + model.weights[-1, b]) for b in range(model.weights.shape[1])]
        loss = [sum(float(model.trust[b]) * math.log1p(math.exp(-int(word[b]) * said[b])) for b in range(len(said))) for word in model.words]
        best = min(range(len(loss)), key=lambda k: (loss[k], k))
        second = sorted(loss)[1]
        if second - loss[best] > 1e-3:
            assert got[r.doc_id].lang_pred == model.names[best]
        assert abs(got[r.doc_id].score - 1 / sum(math.exp(loss[best] - x) for x in loss)) < 1e-3


def test_language_ties_and_one_row_a_language(spark):
    model = language.Codes(["b", "c", "a"][:2])
    assert model.predict("abc")[0] == "b"  # nothing learned: all are as far, the first by name
    rows = [(1, "the house is here", "en"), (2, "das haus ist hier", "de"), (2, "das haus ist hier", "de"), (4, None, None), (5, "", "en")]
    got = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    assert got.names == ["de", "en"] and got.predict("das haus")[0] == "de" and got.predict("the house")[0] == "en"


def test_quality_by_plain_rules(spark):
    d, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(d, labels, F.col("doc_id") % 4 != 2)
    assert model.rules
    rows = quality.with_statistics(d, ["doc_id"]).withColumn("score", model.column()).collect()
    assert len(rows) == d.count()
    for r in rows:
        z = model.base
        for rule, w in zip(model.rules, model.weights, strict=True):
            if all((r[quality.STATS[j]] > edge) == above for j, above, edge in rule):
                z += w
        assert abs(r.score - 1 / (1 + math.exp(-z))) < 1e-12
    got = {r.doc_id: r for r in quality.quality(d, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.7) for i, r in got.items())
