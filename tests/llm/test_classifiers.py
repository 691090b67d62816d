"""Toxicity, licences and languages: held-out accuracy and awkward input."""

import random
import zlib
from dataclasses import replace

import numpy as np
import pytest

from millrace.llm import language, licenses, toxicity
from tests.conftest import SF_DIR
from tests.llm import brute

LARGER = SF_DIR.replace("sf0.001", "sf0.01")


def toxic_corpus(spark, n=900):
    draw, texts = random.Random(7), brute.prose(900, 12)
    rows, labels = [], []
    for k, text in enumerate(texts[:n]):
        bad = k % 6 == 0
        words = text.split()
        for _ in range(draw.randint(1, 9) if bad else 0):
            words.insert(draw.randint(0, len(words)), draw.choice(["scum", "moronic", "vilex", "vileness"]))
        rows.append((k, " ".join(words)))
        labels.append((k, 1, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_is_found_in_held_out_documents(spark):
    docs, labels = toxic_corpus(spark)
    model = toxicity.learned(docs, labels.where("doc_id < 600"))
    assert list(model.thresholds) == sorted(model.thresholds) and len(model.thresholds) == 2
    rows = {r["doc_id"]: r for r in toxicity.scored(docs, model).collect()}
    for k, r in rows.items():
        assert 0 <= r["expected_severity"] <= 2 and r["toxic"] == (r["grade"] > 0)
    held = [k for k in rows if k >= 600]
    assert sum(rows[k]["toxic"] == (k % 6 == 0) for k in held) >= 0.97 * len(held)
    dose = np.array([[len([w for w in t.split() if w[:3] in ("scu", "mor", "vil")]) / len(t.split()), rows[k]["expected_severity"]] for k, t in docs.collect() if k % 6 == 0])
    assert np.corrcoef(dose.T)[0, 1] > 0.2


def test_toxicity_is_learned_from_one_row_of_an_id(spark, monkeypatch):
    docs, labels = toxic_corpus(spark, 300)
    sent, leaning = [], toxicity._leaning
    monkeypatch.setattr(toxicity, "_leaning", lambda table, toxic: sent.append(table.num_rows) or leaning(table, toxic))
    toxicity.learned(docs.unionAll(spark.range(500).selectExpr("1L", "concat('zz copy ', id)")), labels)
    toxicity.learned(docs, labels)
    assert sent == [300, 300]


def test_toxicity_of_awkward_input(spark):
    docs, labels = toxic_corpus(spark, 300)
    awkward = brute.awkward(spark, [*brute.prose(5), "", None, "scum " * 50_000, "SCUM! " * 20])
    found = {r["doc_id"]: r for r in toxicity.scored(awkward, toxicity.learned(docs, labels)).collect()}
    assert not found[5]["toxic"] and not found[6]["toxic"] and found[7]["toxic"] and found[8]["toxic"]
    none = toxicity.learned(docs, labels.where("toxic = 0"))
    assert none.weights == {} and toxicity.scored(awkward, none).where("toxic").count() == 0
    assert toxicity.learned(docs, labels.limit(0)).weights == {} == toxicity.learned(docs.limit(0), labels).weights
    assert toxicity.scored(awkward.limit(0), none).collect() == []


def test_licences(spark):
    texts = [
        f"{brute.prose(1, 5)[0]}\nReleased under the MIT License.\nmore text",
        "THIS WORK is licensed### under%%% the GNU General Public License, version 3.",
        "Licensed under CC BY-NC 4.0.\nAll rights reserved.",
        "He renewed his driving license in the general office of the state.",
        "license license license public version",
        "",
        None,
        "\n\n \n",
        "Licensed under the Apache License, Version 2.0.\n" + "word " * 60_000,
        *brute.prose(20, 6),
    ]
    frame = brute.awkward(spark, texts)
    found = {r["doc_id"]: r for r in licenses.scanned(frame, licenses.learned(frame)).collect() if r["doc_id"] is not None}
    assert [found[k]["licences"] for k in range(9)] == ["mit", "gpl", "cc-by-nc,proprietary", None, None, None, None, None, "apache"]
    assert [found[k]["n_paragraphs"] for k in (0, 2, 6, 7)] == [3, 2, 0, 0] and found[2]["n_licensed"] == 2
    assert all(found[k]["licences"] is None for k in range(9, 29))
    assert licenses.scanned(frame.limit(0), licenses.learned(frame.limit(0))).collect() == []


WRAPPED = {
    "mit": """MIT-style notice of the module

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software.""",
    "bsd": """# Redistribution and use in source and binary forms, with or without
# modification, are permitted provided that the following conditions are met:
#
# 1. Redistributions of source code must retain the above notice.""",
    "gpl": """/*
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 */""",
    "mpl": """REM This Source Code Form is subject to the terms of the Mozilla Public
REM License, v. 2.0. If a copy of the MPL was not distributed with this
REM file, You can obtain one at the site of the foundation.""",
}


def test_licences_wrapped_over_lines(spark):
    model = licenses.fit([t.encode() for t in brute.prose(40)])
    for family, text in WRAPPED.items():
        for ending in ("\n", "\r\n"):
            families, n_licensed, _ = model.scan(text.replace("\n", ending).encode().split(b"\n"))
            assert families == {family} and n_licensed >= 2
    apart = "Permission is hereby granted, free of charge, to any person\n\nobtaining a copy of this software and associated documentation files"
    assert model.scan(apart.encode().split(b"\n"))[0] == set()
    frame = spark.createDataFrame(list(enumerate(WRAPPED.values())), "doc_id long, text string")
    assert [r["licences"] for r in licenses.scanned(frame, model).orderBy("doc_id").collect()] == list(WRAPPED)


#: Statements that no template spells out, by family; none is for sentences that state no licence.
STATEMENTS = {
    "apache": ["Licensed under Apache License 2.0.", "The code is made available under the terms of Apache 2.0.", "Apache License\nVersion 2.0, January 2004", "This crate is distributed under the Apache-2.0 license."],
    "mit": ["Licensed under the MIT License.", "The MIT License (MIT)", "MIT License", "This project is MIT licensed.", "Code and examples are available under an MIT-style license.", "License: MIT"],
    "gpl": ["Licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License v3.0.", "SPDX-License-Identifier: GPL-2.0-only", "You may use this script under the terms of the GPLv2 or later.", "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007"],
    "lgpl": ["This work is licensed under the GNU Lesser General Public License, version 3.", "SPDX-License-Identifier: LGPL-3.0-only", "The bindings are released under the LGPL.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"],
    "bsd": ["SPDX-License-Identifier: BSD-2-Clause", "BSD 2-Clause License", "Use of this source code is governed by a BSD-style license that can be found in the file.", "Distributed under the New BSD License."],
    "mpl": ["Licensed under the Mozilla Public License 2.0.", "Mozilla Public License Version 2.0", "The plugin is published under MPL 2.0.", "This file is subject to the Mozilla Public License version 1.1."],
    "cc-by": ["SPDX-License-Identifier: CC-BY-4.0", "Photos are shared under a Creative Commons Attribution 4.0 license.", "License: https://creativecommons.org/licenses/by/4.0/"],
    "cc-by-sa": ["Text is available under the Creative Commons Attribution-ShareAlike License.", "Content on this wiki is CC BY-SA 3.0 licensed."],
    "cc-by-nc": ["This article is distributed under the Creative Commons Attribution-NonCommercial 3.0 License.", "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "public-domain": ["The author has released this file into the public domain.\nThis file is in the public domain.", "SPDX-License-Identifier: CC0-1.0"],
    "proprietary": ["Copyright 2019 by the authors, all rights reserved worldwide.", "Unauthorized copying of this file, via any medium or network, is strictly prohibited."],
    None: [
        "She studied at MIT before she joined the band.", "The Apache helicopter was licensed for flights over the general area.", "The talk compared the GNU General Public License with the licenses of other systems and their history.",
        "Released under the influence of a new director.", "He has a license to drive and a permission of the city.", "The general public has access to the library.", "Licensed under the GNU Affero General Public License, version 3.",
        "The public domain of the town was open to all.", "A BSD daemon is a small devil.", "All rights are reserved for members of the club.", "The band's third album was released under the Apache label in 1990.", "The creative commons of the village were a meadow.", "Licensed under CC BY-ND 4.0.",
    ],
}
#: Statements that were written after the rules; one of them led to reading *licence* as *license*.
HELD_OUT = {
    "apache": ["Kafka-tools is open source software released under the Apache 2.0 license", "This work is made available under the Apache License, version 2.", "* @license Apache-2.0", "Code licensed under an Apache style license, see NOTICE", "SPDX: Apache-2.0"],
    "mit": ["@license MIT", "MIT © Jane Roe", "Dual-licensed under MIT and another licence", "The script is free to use under the MIT license.", "see the file LICENSE (MIT)"],
    "gpl": ["This is free software distributed under the GPL v3 licence", "it is available under the GNU General Public Licence", "// GPL-2.0+", "Released under GPL version 2 by the authors", "This module is licensed under the same terms as the Linux kernel, GPLv2 only"],
    "lgpl": ["Licensed under the LGPL v3 or later", "This library may be used under the GNU Lesser General Public License, v3", "GNU LESSER GENERAL PUBLIC LICENSE"],
    "bsd": ["Released under a modified BSD licence", "Licensed under the BSD License <LICENSE.txt>", "two-clause BSD license", "This software is available under the terms of the 3-clause BSD license."],
    "mpl": ["This add-on is licensed under MPL 1.1", "Licensed under the terms of the Mozilla Public License v2", "License: MPL-2.0"],
    "cc-by": ["The text of this article is licensed under a Creative Commons Attribution 3.0 Unported License", "Image: J. Roe, CC BY 2.0", "This report is published under CC BY 4.0."],
    "cc-by-sa": ["Photo by J. Roe (CC BY-SA 3.0)", "Unless noted, this book is CC-BY-SA licensed."],
    "cc-by-nc": ["This course is offered under a CC BY-NC license.", "Licensed for use under Creative Commons Attribution-NonCommercial 4.0"],
    "public-domain": ["These scripts are placed in the public domain", "The metadata are released under CC0", "This image is in the public domain because its copyright has expired."],
    "proprietary": ["Copyright 1999 Roe & Sons. All rights reserved.", "No part of this book may be reproduced in any form without permission in writing from the publisher"],
    None: ["The creative team commons room was under repair.", "He took the bus to MIT and came back late.", "The Mozilla foundation published a report on public health.", "Apache tribes lived under the mountains of Arizona.", "BSD students licensed their car last year.", "The general terms of the lease are subject to change.", "A new version of the GNU tools was released to the public.", "Permission was granted to copy the key of the hall."],
}


def test_licences_that_no_template_spells_out():
    model = licenses.fit([t.encode() for t in brute.prose(40)])
    own = {tuple(licenses.words(t.encode())) for of in licenses.TEMPLATES.values() for t in of}
    for family, texts in STATEMENTS.items():
        for text in texts:
            assert tuple(licenses.words(text.encode())) not in own
            assert (text, model.scan(text.encode().split(b"\n"))[0]) == (text, {family} - {None})


def test_recall_of_licences_in_held_out_statements():
    model = licenses.fit([t.encode() for t in brute.prose(40)])
    judged = [(family, model.scan(text.encode().split(b"\n"))[0]) for family, texts in HELD_OUT.items() for text in texts]
    assert sum(found == {family} for family, found in judged) >= 28 and sum(family is not None for family, _ in judged) == 37
    assert not any(found for family, found in judged if family is None)


@pytest.fixture(scope="module")
def licence_model():
    return licenses.fit([t.encode() for t in brute.prose(40)])


@pytest.mark.parametrize(
    ("text", "families"),
    [
        ("Licensed under the Apache License, Version 2.0. All rights reserved.", {"apache", "proprietary"}),
        ("Licensed under either of Apache License, Version 2.0 or MIT license at your option.", {"apache", "mit"}),
        ("SPDX-License-Identifier: MIT OR Apache-2.0", {"apache", "mit"}),
        ("SPDX-License-Identifier: GPL-2.0-only OR BSD-3-Clause OR MPL-2.0", {"bsd", "gpl", "mpl"}),
        ("Code: released under the MIT License. Text: licensed under CC BY-SA 4.0.", {"cc-by-sa", "mit"}),
        (f"{'word ' * 300}Released under the MIT License. {'word ' * 300}All rights reserved. {'word ' * 300}", {"mit", "proprietary"}),
        ("This library is licensed under the GNU General Public License, version 2.1.", {"gpl"}),
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", {"cc-by-sa"}),
    ],
)
def test_licences_stated_side_by_side(text, families, licence_model):
    assert licence_model.scan(text.encode().split(b"\n"))[0] == families


def test_classifier_decides_on_licences(licence_model):
    """Without predictions nothing is confirmed, and a family that is predicted nowhere isn't either."""
    text = [b"The weather was fine.", b"Released under the MIT License."]
    assert licence_model.scan(text)[0] == {"mit"}
    without = replace(licence_model, weights=np.zeros_like(licence_model.weights), bias=np.zeros_like(licence_model.bias))
    assert without.scan(text)[0] == set()
    weights = licence_model.weights.copy()
    weights[:, licence_model.families.index("mit")] = -9
    assert replace(licence_model, weights=weights).scan(text)[0] == set()


def test_paragraphs_judged_together_are_judged_as_each_alone(licence_model):
    draw = random.Random(5)
    texts = [t for of in licenses.TEMPLATES.values() for t in of] + brute.prose(20)
    own = [w for _ in range(30) for w in licenses.words(draw.choice(texts).encode()) * draw.choice([1, 1, 3])]
    found = [range(k, min(k + draw.randrange(80), len(own))) for k in (draw.randrange(len(own)) for _ in range(5000))]
    p = licence_model.of_paragraphs(own, found)
    for at, row in zip(found, p, strict=True):
        z = licence_model.weights[sorted(licenses.grams(own[at.start : at.stop], licence_model.known))].sum(axis=0) + licence_model.bias
        expected = np.exp(z / licence_model.temperature)
        assert np.allclose(row, expected / expected.sum())


def test_paragraphs_cover_every_word_and_wrapped_lines():
    starts = [0, 5, 12, 12 + 3 * licenses.PARAGRAPH, 20 + 3 * licenses.PARAGRAPH]
    found = list(licenses.paragraphs(starts))
    assert {k for at in found for k in at} == set(range(starts[-1]))
    assert range(0, 12) in found and range(5, 12) in found and all(len(at) <= licenses.PARAGRAPH for at in found)


def test_licences_of_the_documents_table(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    found = licenses.scanned(docs, licenses.learned(docs))
    stated = docs.where("text RLIKE '(?i)licensed under|released under the|all rights reserved'").select("doc_id")
    assert found.where("licences IS NOT NULL").select("doc_id").exceptAll(stated).count() == 0
    assert stated.exceptAll(found.where("licences IS NOT NULL").select("doc_id")).count() == 0


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    rows = language.report(docs).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)
    assert sum(r["accepted"] for r in rows) >= 0.97 * len(rows) and all(0 <= r["score"] <= 1 for r in rows)


def test_languages_of_awkward_input(spark):
    frame = brute.awkward(spark, [*brute.prose(30), "", None, "123 !? ٣", "日本", "a" * 200_000])
    rows = language.report(frame).collect()
    found = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert [found[k]["lang_pred"] for k in (30, 31, 32, 33)] == ["und", "und", "und", "en"]
    assert [found[k]["score"] for k in (30, 31, 32)] == [0.0] * 3 and not found[30]["accepted"]
    assert all(r["held_out"] is False for r in rows if r["doc_id"] is None) and len(rows) == frame.count()
    assert language.accepted(frame).dtypes == frame.dtypes
    nothing = language.report(frame.withColumn("lang", frame["lang"].substr(99, 0)).where("lang IS NULL"))
    assert {r["lang_pred"] for r in nothing.collect()} == {"und"}
    assert language.report(frame.limit(0)).collect() == []


def test_too_many_languages_are_an_error(spark):
    frame = spark.createDataFrame([(k, "text", f"l{k}", None, None) for k in range(language.MAX_LANGUAGES + 1)], brute.DOCUMENT)
    with pytest.raises(ValueError, match="languages"):
        language.learned(frame)


def test_a_repeated_row_is_sampled_once(spark):
    some = spark.createDataFrame([(k, f"the {k} words of this text are english ones", "en") for k in range(300)], "doc_id long, text string, lang string")
    copies = spark.range(20_000).selectExpr("id AS doc_id", "'ein und derselbe satz' AS text", "'de' AS lang")
    found = language.learned(some.unionAll(copies))
    assert found["de"] == b"ein und derselbe satz" and found["en"].count(b"english") == 300
