"""The standard notices of licences, as files carry them."""

import pytest

from larder.llm.licences import scan

FREE = """This {what} is free software; you can redistribute it and/or modify
it under the terms of the GNU {kind}General Public License as published by
the Free Software Foundation; either version {version} of the License, or
(at your option) any later version.

This {what} is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU {kind}General Public License for more details.
"""
NOTICES = {
    "GPL-2-or-later": FREE.format(what="program", kind="", version="2"),
    "GPL-3-or-later": FREE.format(what="program", kind="", version="3").replace(";", ":", 1).replace("Foundation;", "Foundation,"),
    "LGPL-2.1-or-later": FREE.format(what="library", kind="Lesser ", version="2.1"),
    "AGPL-3-or-later": FREE.format(what="program", kind="Affero ", version="3"),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "MIT": "This project is licensed under the MIT License.",
    "BSD-2-Clause": 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list.\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list.\n\nTHIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.',
    "BSD": "The code is distributed under the BSD license.",
    "Apache-2.0": "Licensed under the Apache License 2.0.",
    "GPL-3": "This tool is licensed under the GNU General Public License v3.",
    "LGPL-3": "Released under the GNU Lesser General Public License v3.",
    "AGPL-3": "Licensed under the GNU Affero General Public License, version 3.",
    "ISC": 'Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES.',
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0 which is available at https://www.eclipse.org/legal/epl-2.0.",
}
BODIES = {
    "Apache-2.0": "                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/\n\n   TERMS AND CONDITIONS",
    "GPL-3": "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007",
    "GPL-2": "                    GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n\n Copyright (C) 1989",
    "MPL-2.0": "Mozilla Public License Version 2.0\n==================================\n\n1. Definitions",
}


@pytest.mark.parametrize("licence, text", [*NOTICES.items(), *BODIES.items()])
@pytest.mark.parametrize("mark", ["", "# ", " * "])
def test_notice(licence, text, mark):
    marked = "\n".join(mark + line for line in f"Before.\n\n{text}\n\nAfter.".split("\n"))
    assert {s["licence"] for s in scan(marked)[1]} == {licence}


def test_others_are_not_taken():
    for text in ("It is not licensed under the MIT License, sadly.", "Nobody knows whether all of this is licensed under the MIT License.", "Nothing here is licensed under the MIT License.", "The GNU General Public License is long."):
        assert scan(text)[1] == []


@pytest.mark.parametrize(
    "text, expression",
    [
        ("# SPDX-License-Identifier: MIT\nimport os\nimport sys", "MIT"),
        ("/* SPDX-License-Identifier: GPL-2.0 */\nint x;", "GPL-2.0"),
        ("<!-- SPDX-License-Identifier: Apache-2.0 OR MIT -->", "Apache-2.0 OR MIT"),
        ("// SPDX-License-Identifier: (GPL-2.0+ WITH Classpath-exception-2.0) AND ( MIT OR LicenseRef-own )\r\nx", "(GPL-2.0+ WITH Classpath-exception-2.0) AND (MIT OR LicenseRef-own)"),
        ("SPDX-License-Identifier: MIT AND", "MIT"),
        ("SPDX-License-Identifier: MIT. See the file", "MIT"),
        ("x = 1  # SPDX-License-Identifier: BSD-2-Clause", "BSD-2-Clause"),
    ],
)
def test_spdx_lines(text, expression):
    assert [s["licence"] for s in scan(text)[1]] == [expression]


def test_no_spdx_expression():
    for text in ("SPDX-License-Identifier:", "SPDX-License-Identifier: */", "SPDX-License-Identifier: AND MIT"):
        assert scan(text)[1] == []


MORE = {
    "GPL-2-only": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
        "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation; version 2 of the License.",
    ],
    "LGPL-2-or-later": [FREE.format(what="library", kind="Library ", version="2")],
    "MIT": ["MIT licensed.", "License: MIT", "MIT License", "The MIT License (MIT)"],
    "Apache-2.0": ["Licensed under Apache 2.0.", "The code is licensed under the Apache 2.0."],
    "CC-BY-NC-ND-4.0": ["Licensed under CC BY-NC-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."],
    "CC-BY-NC-SA-4.0": ["Licensed under CC BY-NC-SA 4.0."],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0."],
    "CC0-1.0": ["CC0 1.0 Universal", "Creative Commons Legal Code\n\nCC0 1.0 Universal"],
    "BSD": ["Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0.", "Boost Software License - Version 1.0 - August 17th, 2003"],
    "Zlib": ["Released under the zlib license.", "This software is provided 'as-is', without any express or implied\nwarranty. In no event will the authors be held liable.\n\nPermission is granted to anyone to use this software for any purpose,\nincluding commercial applications, and to alter it and redistribute it\nfreely, subject to the following restrictions:\n\n1. The origin"],
    "Artistic-2.0": ["Distributed under the Artistic License 2.0.", "The Artistic License 2.0"],
    "GFDL-1.3-or-later": ["Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.3 or any later version published by the Free Software Foundation; with no Invariant Sections."],
}


@pytest.mark.parametrize("licence, text", [(k, t) for k, v in MORE.items() for t in v])
@pytest.mark.parametrize("mark", ["", "# "])
def test_more_notices(licence, text, mark):
    marked = "\n".join(mark + line for line in f"Before.\n\n{text}\n\nAfter.".split("\n"))
    assert {s["licence"] for s in scan(marked)[1]} == {licence}
