"""Licence scan by sentence rules.

A text is cut into sentences, each sentence is normalised and looked up among
known licence sentences, and the sequence of identifiers found, in order, is
matched against licence rules, the longest rule first. Rows are scanned one by
one; nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# Known licence sentences, normalised, by identifier. `V` stands for a version number.
SENTENCES = {
    "apache-ref": r"(?:SUBJECT )?(?:released|licensed|distributed) under (?:the )?(?:terms of the )?apache(?: software)?(?: licen[cs]e)?(?: version)? V(?: the licen[cs]e)?(?: you may not use this file except in compliance with the licen[cs]e)?",
    "apache-use": r"you may not use this file except in compliance with the licen[cs]e",
    "apache-copy": r"you may obtain a copy of the licen[cs]e at .*",
    "apache-as-is": r"unless required by applicable law or agreed to in writing software distributed under the licen[cs]e is distributed on an as is basis .*",
    "apache-see": r"see the licen[cs]e for the specific language governing permissions and limitations under the licen[cs]e",
    "mit-ref": r"(?:SUBJECT )?(?:released|licensed|distributed) under (?:the )?(?:terms of the )?mit licen[cs]e|(?:SUBJECT )?mit licensed|licen[cs]e mit|(?:the )?mit licen[cs]e(?: mit)?",
    "mit-grant": r"permission is hereby granted free of charge to any person obtaining a copy of this software .*",
    "mit-notice": r"the above copyright notice and this permission notice shall be included in all copies .*",
    "as-is": r"the software is provided as is without warranty of any kind .*",
    "as-is-holders": r"this software is provided by the (?:copyright holders and contributors|author|regents and contributors) as is and any express or implied warranties .*",
    "bsd-ref": r"(?:SUBJECT )?(?:released|licensed|distributed) under (?:the )?(?:terms of the )?(?:(?:2|3|new|simplified|modified) ?(?:clause)? )?bsd licen[cs]e",
    "bsd-grant": r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": r"(?:\d )?redistributions of source code must retain the above copyright notice .*",
    "bsd-binary": r"(?:\d )?redistributions in binary form must reproduce the above copyright notice .*",
    "bsd-endorse": r"(?:\d )?neither the name of .* may be used to endorse or promote products .*",
    "gpl-ref": r"(?:SUBJECT )?(?:released|licensed|distributed) under (?:the )?(?:terms of the )?gnu general public licen[cs]e(?: as published by the free software foundation)?(?: version)? V",
    "gpl-free": r"this (?:program|file|software) is free software you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e as published by the free software foundation either version V of the licen[cs]e or at your option any later version",
    "gpl-only": r"this (?:program|file|software) is free software you can redistribute it and or modify it under the terms of (?:version V of the gnu general public licen[cs]e|the gnu general public licen[cs]e version V) (?:only )?as published by the free software foundation",
    "gpl-only-after": r"this (?:program|file|software) is free software you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e as published by the free software foundation version V of the licen[cs]e(?: only)?",
    "lgpl-free": r"this (?:program|library|file|software) is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public licen[cs]e as published by the free software foundation either version V of the licen[cs]e or at your option any later version",
    "agpl-free": r"this (?:program|file|software) is free software you can redistribute it and or modify it under the terms of the gnu affero general public licen[cs]e as published by the free software foundation either version V of the licen[cs]e or at your option any later version",
    "gpl-hope": r"this (?:program|library|file|software) is distributed in the hope that it will be useful but without any warranty .*",
    "gpl-details": r"see the gnu (?:lesser |library |affero )?general public licen[cs]e for more details",
    "gpl-copy": r"you should have received a copy of the gnu (?:lesser |library |affero )?general public licen[cs]e along with this (?:program|library|file|software).*",
    "lgpl-ref": r"(?:SUBJECT )?(?:released|licensed|distributed) under (?:the )?(?:terms of the )?gnu lesser general public licen[cs]e(?: as published by the free software foundation)?(?: version)? V",
    "agpl-ref": r"(?:SUBJECT )?(?:released|licensed|distributed) under (?:the )?(?:terms of the )?gnu affero general public licen[cs]e(?: as published by the free software foundation)?(?: version)? V",
    "mpl-ref": r"this source code form is subject to the terms of the mozilla public licen[cs]e(?: v| version)? ?V",
    "cc-by-nc-nd": r"(?:this (?:work|page|text) is )?licensed under (?:a |the )?(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s) V(?: .*)?",
    "cc-by-nc-sa": r"(?:this (?:work|page|text) is )?licensed under (?:a |the )?(?:cc by nc sa|creative commons attribution non ?commercial share ?alike) V(?: .*)?",
    "cc-by-nd": r"(?:this (?:work|page|text) is )?licensed under (?:a |the )?(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s) V(?: .*)?",
    "cc-by-nc": r"(?:this (?:work|page|text) is )?licensed under (?:a )?(?:cc by nc|creative commons attribution non ?commercial) V(?: .*)?",
    "cc-by-sa": r"(?:this (?:work|page|text) is )?licensed under (?:a )?(?:cc by sa|creative commons attribution share ?alike) V(?: .*)?",
    "cc-by": r"(?:this (?:work|page|text) is )?licensed under (?:a )?(?:cc by|creative commons attribution) V(?: .*)?",
    "cc0": r"(?:to the extent possible under law .* waived all copyright .*|(?:released|licensed) under cc0 V(?: .*)?)",
    "mpl-copy": r"if a copy of the mpl was not distributed with this file you can obtain one at .*",
    "isc-grant": r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc-as-is": r"the software is provided as is and the author disclaims all warranties with regard to this software .*",
    "isc-ref": r"(?:SUBJECT )?(?:released|licensed|distributed) under (?:the )?(?:terms of the )?isc licen[cs]e",
    "unlicense-free": r"this is free and unencumbered software released into the public domain",
    "epl-ref": r"(?:SUBJECT |this program and the accompanying materials are )?(?:released|licensed|distributed|made available) under the terms of the eclipse public licen[cs]e(?: version)? ?V(?: .*)?",
    "apache-body": r"apache licen[cs]e version V january 2004.*",
    "gpl-body": r"gnu general public licen[cs]e version V (?:june|29 june) \d{4}.*",
    "lgpl-body": r"gnu lesser general public licen[cs]e version V (?:february|29 june) \d{4}.*",
    "agpl-body": r"gnu affero general public licen[cs]e version V 19 november 2007.*",
    "mpl-body": r"mozilla public licen[cs]e version V",
    "cc0-body": r"(?:creative commons legal code )?cc0 V universal",
    "bsd-style": r"use of this source code is governed by a bsd style licen[cs]e(?: that can be found in the licen[cs]e file.*)?",
    "boost-ref": r"(?:SUBJECT )?(?:released|licensed|distributed) under the boost software licen[cs]e(?: version)? V(?: .*)?",
    "boost-body": r"boost software licen[cs]e version V(?: .*)?",
    "zlib-as-is": r"this software is provided as is without any express or implied warranty",
    "zlib-grant": r"permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "zlib-ref": r"(?:SUBJECT )?(?:released|licensed|distributed) under (?:the )?(?:terms of the )?zlib licen[cs]e",
    "artistic-ref": r"(?:SUBJECT )?(?:released|licensed|distributed) under (?:the )?(?:terms of the )?artistic licen[cs]e(?: version)? V",
    "artistic-body": r"(?:the )?artistic licen[cs]e V",
    "gfdl-grant": r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[cs]e version V or any later version published by the free software foundation.*",
    "rights": r"all rights reserved",
    "spdx": r"spdx licen[cs]e identifier .+",
}
# Licences as sequences of identifiers; `{}` takes the version of the first sentence that has one.
RULES = [
    ("Apache-{}", ("apache-ref", "apache-use", "apache-copy", "apache-as-is", "apache-see")),
    ("Apache-{}", ("apache-ref", "apache-use")),
    ("Apache-{}", ("apache-ref",)),
    ("MIT", ("mit-grant", "mit-notice", "as-is")),
    ("MIT", ("mit-ref",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "as-is-holders")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "as-is-holders")),
    ("BSD", ("bsd-ref",)),
    *((f"{name}-{{}}-or-later", (free, *rest)) for name, free in (("GPL", "gpl-free"), ("LGPL", "lgpl-free"), ("AGPL", "agpl-free"))
      for rest in (("gpl-hope", "gpl-details", "gpl-copy"), ("gpl-hope", "gpl-copy"), ("gpl-hope", "gpl-details"), ("gpl-hope",), ())),
    *(("GPL-{}-only", (only, *rest)) for only in ("gpl-only", "gpl-only-after")
      for rest in (("gpl-hope", "gpl-details", "gpl-copy"), ("gpl-hope", "gpl-copy"), ("gpl-hope", "gpl-details"), ("gpl-hope",), ())),
    ("GPL-{}", ("gpl-ref",)),
    ("LGPL-{}", ("lgpl-ref",)),
    ("AGPL-{}", ("agpl-ref",)),
    ("MPL-{}", ("mpl-ref", "mpl-copy")),
    ("MPL-{}", ("mpl-ref",)),
    ("ISC", ("isc-grant", "isc-as-is")),
    ("ISC", ("isc-grant",)),
    ("ISC", ("isc-ref",)),
    ("Unlicense", ("unlicense-free",)),
    ("EPL-{}", ("epl-ref",)),
    ("Apache-{}", ("apache-body",)),
    ("GPL-{}", ("gpl-body",)),
    ("LGPL-{}", ("lgpl-body",)),
    ("AGPL-{}", ("agpl-body",)),
    ("MPL-{}", ("mpl-body",)),
    ("BSD", ("bsd-style",)),
    ("BSL-{}", ("boost-ref",)),
    ("BSL-{}", ("boost-body",)),
    ("Zlib", ("zlib-as-is", "zlib-grant")),
    ("Zlib", ("zlib-grant",)),
    ("Zlib", ("zlib-ref",)),
    ("Artistic-{}", ("artistic-ref",)),
    ("Artistic-{}", ("artistic-body",)),
    ("GFDL-{}-or-later", ("gfdl-grant",)),
    ("CC0-{}", ("cc0-body",)),
    ("CC-BY-NC-ND-{}", ("cc-by-nc-nd",)),
    ("CC-BY-NC-SA-{}", ("cc-by-nc-sa",)),
    ("CC-BY-ND-{}", ("cc-by-nd",)),
    ("CC-BY-NC-{}", ("cc-by-nc",)),
    ("CC-BY-SA-{}", ("cc-by-sa",)),
    ("CC-BY-{}", ("cc-by",)),
    ("CC0-1.0", ("cc0",)),
    ("All-Rights-Reserved", ("rights",)),
    ("{spdx}", ("spdx",)),
]

# a sentence ends at a line break that is not inside a sentence, or at a mark followed by white space,
# but not after the marks inside the GPL's and MPL's notices
_END = re.compile(r"(?<=[.!?;])(?<!\bv\.)(?<!\bV\.)(?<!software;)(?<!Foundation;)\s+|(?<=:)[ \t]*\n|\n\s*\n")
# what is licensed, in a few words
_SUBJECT = r"(?!no |none |nothing |neither |not )(?:(?:this|the|these) )?(?:\w+ ){0,3}(?:is|are)(?: (?:also|dual|hereby))?"
_COMMENT = re.compile(r"^[\s#*/;%>-]+", re.MULTILINE)
# every known sentence holds one of these
_MAYBE = re.compile(r"licen[cs]|cc0|permission|rights reserved|permission|redistribut|warrant|copyright|endorse|gnu general|unencumbered|mpl was not")
_VERSION = r"v?(\d+(?:\.\d+)*)"
_KNOWN = [(name, re.compile(p.replace("SUBJECT", _SUBJECT).replace("V", _VERSION))) for name, p in SENTENCES.items()]
_SPDX = re.compile(r"spdx-licen[cs]e-identifier:", re.IGNORECASE)
_SPDX_PART = re.compile(r"\s*(?:([()])|([A-Za-z0-9](?:[A-Za-z0-9.:+-]*[A-Za-z0-9+])?))")
_BY_LENGTH = sorted(RULES, key=lambda rule: -len(rule[1]))


def normalised(sentence: str) -> str:
    """Lower case, letters, digits and inner full stops of numbers only, single spaces."""
    kept = re.sub(r"(?<!\d)\.|\.(?!\d)|[^\w.]+|_", " ", sentence.lower())
    return " ".join(kept.split())


def recognised(sentence: str) -> tuple[str, str] | None:
    """Identifier of a known sentence, with its version or SPDX expression, or None."""
    plain = normalised(sentence)
    for name, pattern in _KNOWN:
        if match := pattern.fullmatch(plain):
            value = next((g for g in match.groups() if g), "")
            if name == "spdx" and not (value := spdx_expression(sentence.split(":", 1)[-1])):
                return None
            return name, value
    return None


def spdx_expression(text: str) -> str:
    """The longest licence expression that ``text`` begins with: identifiers, AND, OR, WITH and brackets; else empty."""
    parts, whole, depth, operand = [], 0, 0, True
    at = 0
    while match := _SPDX_PART.match(text, at):
        bracket, word = match.groups()
        if operand and bracket == "(":
            depth += 1
        elif operand and word and word not in ("AND", "OR", "WITH"):
            operand = False
        elif not operand and bracket == ")" and depth:
            depth -= 1
        elif not operand and word in ("AND", "OR", "WITH"):
            operand = True
        else:
            break
        parts.append(bracket or word)
        if not operand and not depth:
            whole = len(parts)
        at = match.end()
    return " ".join(parts[:whole]).replace("( ", "(").replace(" )", ")")


def _sentences(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of sentences; a line with an SPDX identifier is one of its own, up to its end."""
    at = 0
    for end, next_ in [*((m.start(), m.end()) for m in _END.finditer(text)), (len(text), len(text))]:
        while (tag := _SPDX.search(text, at, end)) is not None:
            line = text.find("\n", tag.end())
            stop = len(text) if line < 0 else line
            if tag.start() > at:
                yield at, tag.start()
            yield tag.start(), stop
            at = stop
        if end > at:
            yield at, end
        at = max(at, next_)


def scan(text: str) -> tuple[list[str], list[dict]]:
    """Identifiers of the known sentences in order, and the licences found with their place in the text."""
    found = []
    for start, end in _sentences(text) if _MAYBE.search(text.lower()) else []:
        piece = text[start:end]
        if not _MAYBE.search(piece.lower()):
            continue
        whole = recognised(_COMMENT.sub(" ", piece))
        if whole:
            found.append((*whole, start, end))
            continue
        place = start
        for line in piece.splitlines(keepends=True):
            if _MAYBE.search(line.lower()) and (known := recognised(line)):
                found.append((*known, place, place + len(line.rstrip())))
            place += len(line)
    names, licences, k = [f[0] for f in found], [], 0
    while k < len(found):
        title, rule = next((r for r in _BY_LENGTH if tuple(names[k : k + len(r[1])]) == r[1]), (None, ()))
        if title:
            taken = found[k : k + len(rule)]
            version = next((f[1] for f in taken if f[1]), "")
            licences.append({"licence": title.format(version, spdx=version), "start": taken[0][2], "end": taken[-1][3]})
        k += max(1, len(rule))
    return names, licences


_SPAN = pa.struct([("licence", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [scan(t.as_py() or "") for t in batch["text"]]
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch["doc_id"],
                "licences": pa.array([sorted({s["licence"] for s in spans}) for _, spans in found], pa.list_(pa.string())),
                "sentences": pa.array([names for names, _ in found], pa.list_(pa.string())),
                "spans": pa.array([spans for _, spans in found], pa.list_(_SPAN)),
            }
        )


def scanned(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, licences, sentences (identifiers in order), spans (licence, start, end).

    Places are characters of the text. Null and empty texts hold no licence.
    Repeated rows are scanned each; other columns are ignored.
    """
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, licences array<string>, sentences array<string>, spans array<struct<licence: string, start: bigint, end: bigint>>"
    return docs.select("doc_id", "text").mapInArrow(_scanned, schema)
