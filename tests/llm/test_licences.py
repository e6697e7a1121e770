"""Licence sentences, rules, spans and hard cases."""

from larder.llm.licences import SENTENCES, scan, scanned
from larder.llm.queries import QUERIES

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software").

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License."""


def names(text):
    return [s["licence"] for s in scan(text)[1]]


def test_sentences_and_rules():
    assert names("Intro.\nLicensed under the Apache License, Version 2.0.\nMore text.") == ["Apache-2.0"]
    assert names("x. Licensed under CC BY-NC 4.0.\nThis work is licensed under the GNU General Public License, version 3.") == ["CC-BY-NC-4.0", "GPL-3"]
    assert names("Released under the MIT License.\nAll rights reserved.") == ["MIT", "All-Rights-Reserved"]
    assert names(MIT) == ["MIT"] and names(APACHE) == ["Apache-2.0"]
    assert names("# " + APACHE.replace("\n", "\n# ")) == ["Apache-2.0"]
    assert names("// SPDX-License-Identifier: BSD-3-Clause") == ["BSD-3-Clause"]
    assert names("The license was lost. All rights reserved to no one. Unlicensed under the MIT licence, so be it.") == []
    # the parts of a rule in another order are no licence of that rule
    assert names("\n\n".join(reversed(MIT.split("\n\n")))) == []


def test_spans_point_at_the_sentences():
    text = "Ä before.\n\nReleased under the MIT License.\nAfter. " + MIT
    _, spans = scan(text)
    assert [text[s["start"] : s["end"]][:20] for s in spans] == ["Released under the M", "Permission is hereby"]


def test_every_rule_uses_known_sentences():
    from larder.llm.licences import RULES

    assert {n for _, rule in RULES for n in rule} <= set(SENTENCES)


def test_hard_cases(spark):
    rows = [(1, None), (2, ""), (None, "All rights reserved."), (3, "license " * 50_000), (1, None), (4, "licen\x00se\n" * 100)]
    df = spark.createDataFrame([(k, t, "clash") for k, t in rows], "doc_id long, text string, licences string")
    got = scanned(df)
    assert sorted((r.doc_id or 0, r.licences) for r in got.collect()) == [(0, ["All-Rights-Reserved"]), (1, []), (1, []), (2, []), (3, []), (4, [])]
    assert scanned(df.limit(0)).collect() == []


def test_query_against_planted_lines(spark, tiny):
    planted = {
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Released under the MIT License.": "MIT", "All rights reserved.": "All-Rights-Reserved",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3", "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    }
    want = {
        r.doc_id: sorted({name for line, name in planted.items() if line in r.text.split("\n")})
        for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()
    }
    assert {r.doc_id: r.licences for r in QUERIES["op5_licences"](spark, tiny).collect()} == want
