"""Standard licence notices, wrapped, commented and on one line."""

import pytest

from wardlake.llm import licenses

GNU_REST = """This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU {kind}General Public License for more details.

You should have received a copy of the GNU {kind}General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>."""


def gnu(kind, version, later=True, what="program", mark=";"):
    end = "either version {v} of the License, or\n(at your option) any later version." if later else "version {v} of the License."
    head = f"""Copyright (C) 2020 Jane Doe

This {what} is free software{mark} you can redistribute it and/or modify
it under the terms of the GNU {kind}General Public License as published by
the Free Software Foundation{mark.replace(':', ',')} {end.format(v=version)}"""
    return f"{head}\n\n{GNU_REST.format(kind=kind)}"


AS_IS = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
BSD = """Copyright (c) 2020, Jane Doe
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
{third}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY ARE DISCLAIMED."""
ENDORSE = """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
NOTICES = {
    "MIT": f"""MIT License

Copyright (c) 2020 Jane Doe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

{AS_IS}""",
    "BSD-2-Clause": BSD.format(third=""),
    "BSD-3-Clause": BSD.format(third=ENDORSE),
    "ISC": """Copyright (c) 2020 Jane Doe

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "EPL-2.0": """This program and the accompanying materials are made available under the
terms of the Eclipse Public License 2.0 which is available at
https://www.eclipse.org/legal/epl-2.0""",
    "EPL-1.0": """All rights reserved. This program and the accompanying materials
are made available under the terms of the Eclipse Public License v1.0
which accompanies this distribution""",
    "Zlib": """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not
   claim that you wrote the original software.""",
    "Unlicense": """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software.""",
    "CC0-1.0": """To the extent possible under law, Jane Doe has waived all copyright
and related or neighboring rights to this work.""",
    "BSL-1.0": """Distributed under the Boost Software License, Version 1.0.
(See accompanying file LICENSE_1_0.txt)""",
    "GPL-2.0-or-later": gnu("", "2"),
    "GPL-3.0-or-later": gnu("", "3", mark=":"),
    "GPL-2.0-only": gnu("", "2", later=False),
    "GPL-3.0-only": gnu("", "3", later=False),
    "LGPL-2.1-or-later": gnu("Lesser ", "2.1", what="library"),
    "LGPL-3.0-or-later": gnu("Lesser ", "3", what="library"),
    "AGPL-3.0-or-later": gnu("Affero ", "3"),
}


def forms(text):
    lines = text.split("\n")
    yield text
    for mark in ("#", "//", " *", ";;", "--"):
        yield "\n".join(f"{mark} {line}".rstrip() for line in lines)
    yield "/*\n" + "\n".join(f" * {line}".rstrip() for line in lines) + "\n */\nint main() { return 0; }"
    yield " ".join(line.strip() for line in lines if line.strip())
    yield "\r\n".join(lines)
    yield text.upper()


def test_every_notice_in_every_form(documents):
    texts = [(name, form) for name, text in NOTICES.items() for form in forms(text)]
    got = {r.doc_id: r for r in licenses.scan(documents(list(enumerate(t for _, t in texts)))).collect()}
    found = {i: (name, got[i].licenses, got[i].sentence_ids) for i, (name, _) in enumerate(texts)}
    assert [f for f in found.values() if f[1] != [f[0]]] == []


@pytest.mark.parametrize("mark", ["", "// ", "# ", " * "])
def test_tags(documents, mark):
    rows = [(i, f"{mark}{licenses.SPDX_TAG} {name}\n{mark}Copyright 2020 X\ncode") for i, name in enumerate(licenses.SPDX)]
    rows += [(100, f"{mark}{licenses.SPDX_TAG} (MIT OR Apache-2.0)\n\ncode"), (101, f"{mark}{licenses.SPDX_TAG} Unknown-1.0\nMIT")]
    rows += [(102, f"{mark}{licenses.SPDX_TAG} MIT\n{NOTICES['MIT']}")]
    got = {r.doc_id: r.licenses for r in licenses.scan(documents(rows)).collect()}
    assert [got[i] for i in range(len(licenses.SPDX))] == [[name] for name in licenses.SPDX]
    assert (got[100], got[101], got[102]) == (["MIT", "Apache-2.0"], [], ["MIT"])


def test_several_notices_and_other_texts(documents):
    both = f"{NOTICES['MIT']}\n\n{NOTICES['Apache-2.0']}\n\n{NOTICES['GPL-2.0-or-later']}"
    rows = [
        (1, both),
        (2, "The permission to redistribute is a licence question. It is free software; you know."),
        (3, "Redistribution and use in source and binary forms is common."),
        (4, None),
        (5, ""),
        (6, "\n \n#\n"),
        (7, "license " * 60_000),
        (8, "word " * 60_000 + ".\n" + NOTICES["ISC"]),
        (9, both),
        (9, both),
        (None, NOTICES["Zlib"]),
    ]
    got = licenses.scan(documents(rows)).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    assert sorted(by_id[1].licenses) == ["Apache-2.0", "GPL-2.0-or-later", "MIT"] == sorted(by_id[9].licenses)
    assert (by_id[2].licenses, by_id[3].licenses, by_id[3].unmatched) == ([], [], ["bsdRedistribution"])
    assert all(by_id[i].licenses == [] and by_id[i].n_sentences == 0 for i in (4, 5, 6))
    assert (by_id[7].licenses, by_id[8].licenses, by_id[None].licenses) == ([], ["ISC"], ["Zlib"])


def test_an_empty_table(documents):
    assert licenses.scan(documents([])).collect() == []
