"""License scans against brute force over all (line, template) pairs."""

import re
import textwrap

from conftest import SF_DIR
from llm_cases import no_docs, odd_docs, texts  # noqa: F401
from profilelake.llm import licenses, queries

BREAK = re.compile(licenses.BREAK)


def brute(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in BREAK.split(lower) if w]
    places = []
    for phrase, label in licenses.PHRASES:
        parts = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    labels, best = {x for _, x in places}, 1.0 if places else 0.0
    for line in lower.split("\n"):
        tokens = set(BREAK.split(line)) - {""}
        for label, template in licenses.template_tokens():
            share = len(tokens & set(template)) / len(template)
            if share >= licenses.CONTAINMENT - 1e-9:
                labels.add(label)
                best = max(best, share)
    at = [i for i, _ in places]
    return (
        len(words), len(places), min(at, default=None), max(at, default=None),
        ",".join(sorted({x for _, x in places})), ",".join(sorted(labels)), round(best, 9),
    )


def check(rows, texts):
    for r in rows:
        got = (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9))
        assert got == brute(texts[r.doc_id]), r


def test_texts(spark):
    texts = dict(enumerate([
        "Released under the MIT License.", "mit-license; MIT\nLicense APACHE license", "cc by cc by", "CC-BY",
        "x\nLicensed under CC BY-NC 4.0 indeed\ny", "This Source Code Form is subject to terms of the Mozilla "
        "Public License, v. 2.0", "under the license", "gnu general public licenses", None, "", "É K mit license",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following are met", "license " * 5000,
    ]))
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    check(licenses.scan(df).collect(), texts)


def test_query(spark, texts):
    rows = queries.op10_license_scan(spark, SF_DIR).collect()
    assert {r.doc_id for r in rows} == set(texts)
    check(rows, texts)


def test_odd_rows(odd_docs, no_docs):
    assert licenses.scan(odd_docs).where("labels = '' and score = 0").count() == odd_docs.count()
    assert licenses.scan(no_docs).count() == 0


def test_no_python_in_the_plans(spark, capsys):
    for name in ("op9_quality_rules", "op10_license_scan"):
        queries.queries()[name](spark, SF_DIR).explain()
        text = capsys.readouterr().out
        assert not re.search("Python|Pandas|Arrow", text), text


NOTICES = {
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met:",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the Software), to deal in the Software without restriction",
    "apache": "Unless required by applicable law or agreed to in writing, software distributed under the License "
    'is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "mpl": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
    "MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
}


def test_wrapped_notices(spark):
    cases = []
    for label, notice in NOTICES.items():
        for width in (30, 60, 76):
            lines = textwrap.wrap(notice, width)
            for mark in ("", "# ", "// ", " * ", ";; "):
                head = [f"{mark}Copyright someone", mark.rstrip(), *(mark + x for x in lines), mark.rstrip(), "", "int x;"]
                cases.append((label, "\n".join(head)))
                cases.append((label, "\r\n".join(head)))
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(cases)], "doc_id bigint, text string")
    rows = {r.doc_id: r for r in licenses.scan(df).collect()}
    for i, (label, text) in enumerate(cases):
        assert rows[i].labels == label and rows[i].score >= licenses.CONTAINMENT, (text, rows[i])


def test_paragraphs_end_at_lines_without_words(spark):
    lines = textwrap.wrap(NOTICES["bsd"], 60)
    texts = [gap.join(lines) for gap in ("\n\n", "\n \t\n", "\n#\n", "\r\n\r\n")]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert [r.labels for r in licenses.scan(df).collect()] == [""] * len(texts)
