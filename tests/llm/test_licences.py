"""Licence scans: planted notices, other legal text, ordinary text, awkward rows; the main path has no Python."""

import pytest
from common import AWKWARD, awkward, prose, same

from crawlprism.llm import licences as L

NOTICES = [
    (500, "apache", f"{prose(1, 30)}\nLicensed under the Apache License, Version 2.0.\n{prose(2, 30)}"),
    (501, "mit", "Released under the MIT License."),
    (502, "gpl", f"{prose(3, 12)} This work is licensed under the GNU General Public License, version 3. {prose(4, 12)}"),
    (503, "cc-by-nc", f"{prose(5, 30)}\n\n  licensed under cc by-nc 4.0"),
    (504, "bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    (505, "mpl", f"This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.\n{prose(6, 9)}"),
    (506, "apache,mit", "Licensed under the Apache License, Version 2.0.\nReleased under the MIT License."),
]
OTHER = [(600, "All rights reserved."), (601, "Distributed under a custom license of the Example Company, available on request.")]
ORDINARY = [
    (700, "The public library opened a version of the exhibition with free copies for all."), (701, prose(7, 200)),
    (702, "He lost his driving license on the way to work."),
]


@pytest.fixture(scope="module")
def classifier(spark):
    return L.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_families(spark, classifier):
    docs = [*[(i, t) for i, _, t in NOTICES], *OTHER, *ORDINARY, *AWKWARD]
    got = L.licences(awkward(spark, docs), classifier).collect()
    assert len(got) == len(docs)
    found = {r.doc_id: r for r in got}
    assert {i: found[i].licences for i, _, _ in NOTICES} == {i: f for i, f, _ in NOTICES}
    assert all(found[i].n_unknown == 1 and found[i].n_licensed == 0 for i, _ in OTHER)
    clean = [i for i, _ in [*ORDINARY, *AWKWARD]]
    assert all(r.n_licensed == r.n_unknown == 0 and r.probability is None for r in got if r.doc_id in clean or r.doc_id is None)
    assert found[10].n_paragraphs == found[11].n_paragraphs == 0 and found[503].n_paragraphs == 2


def test_supplied_notices(spark, classifier):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lines = {"Apache License": "apache", "MIT License": "mit", "GNU General Public": "gpl", "CC BY-NC": "cc-by-nc"}
    want = [(r.doc_id, ",".join(sorted(f for s, f in lines.items() if s in (r.text or "")))) for r in docs.select("doc_id", "text").collect()]
    same(L.licences(docs, classifier).select("doc_id", "licences").collect(), want)


def test_no_python_on_the_main_path(spark, classifier, plan):
    text = plan(L.licences(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), classifier))
    assert not any(word in text for word in ("Python", "Pandas", "InArrow"))
    assert "CartesianProduct" not in text


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer."""
GPL = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version."""
LGPL = """ * This library is free software; you can redistribute it and/or
 * modify it under the terms of the GNU Lesser General Public
 * License as published by the Free Software Foundation; either
 * version 2.1 of the License, or (at your option) any later version.
 *
 * You should have received a copy of the GNU Lesser General Public
 * License along with this library; if not, write to the Free Software"""
MPL = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at http://mozilla.org/MPL/2.0/. */"""


def test_wrapped_notices(spark, classifier):
    texts = {"mit": MIT, "bsd": BSD, "gpl": GPL, "lgpl": LGPL, "mpl": MPL}
    docs = [(800 + i, t) for i, t in enumerate(texts.values())] + [(810 + i, f"{prose(i, 40)}\n{t}\r\n{prose(i + 9, 40)}") for i, t in enumerate(texts.values())]
    got = {r.doc_id: r for r in L.licences(awkward(spark, docs), classifier).collect()}
    assert {i: r.licences for i, r in got.items()} == {j + i: f for i, f in enumerate(texts) for j in (800, 810)}
    assert got[801].n_licensed == 2 and got[801].n_paragraphs == 4 and got[802].n_licensed == 4


def test_a_blank_line_ends_a_passage(spark, classifier):
    docs = [(820, "This Source Code Form is subject\nto the terms of the Mozilla Public License, v. 2.0."), (821, "This Source Code Form is subject\n\nto the terms of the Mozilla Public License, v. 2.0.")]
    lines = {r.doc_key: r for r in L._found_terms(awkward(spark, docs), classifier, "doc_id", "text").groupBy("doc_key").agg({"at": "max"}).collect()}
    assert lines["821"][1] - lines["820"][1] == L.GAP
    crossing = L._found_terms(awkward(spark, docs), classifier, "doc_id", "text").where("i + n > own").select("doc_key").distinct().collect()
    assert [r.doc_key for r in crossing] == ["820"]


def test_several_notices_in_one_line(spark, classifier):
    mit, apache, gpl = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "This work is licensed under the GNU General Public License, version 3."
    docs = [
        (830, f"{mit} {apache}"),
        (831, f"Licensed under the MIT License. {apache}"),
        (832, f"{prose(1, 3000)} {mit} {prose(2, 3000)} {gpl} {prose(3, 3000)} {apache}"),
        (833, f"{prose(4, 3000)} All rights reserved. {prose(5, 3000)}"),
        (834, " ".join([mit, prose(6, 9)] * 300)),
    ]
    got = {r.doc_id: r for r in L.licences(awkward(spark, docs), classifier).collect()}
    assert {i: r.licences for i, r in got.items()} == {830: "apache,mit", 831: "apache,mit", 832: "apache,gpl,mit", 833: "", 834: "mit"}
    assert [got[i].n_unknown for i in range(830, 835)] == [0, 0, 0, 1, 0]


def test_gate_holds_every_term():
    vocab = L.default_vocabulary()
    gate = set(vocab.gate)
    assert all(gate & set(t.split()) for t in vocab.terms)
    assert all(len(g) for _, g in vocab.sentences)


def test_weights_are_sparse(classifier):
    used = sum(any(row[j] for row in classifier.weights) for j in range(len(classifier.vocab.terms)))
    assert 0 < used < 0.7 * len(classifier.vocab.terms)


def test_empty_table(spark):
    docs = awkward(spark, [])
    assert L.licences(docs, L.fit(docs)).collect() == []
