"""Published license notices, plain and as source headers."""

import pytest

from mentionflow.llm import licenses

APACHE = """Copyright 2020 The Authors

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
{blank}1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
{blank}2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
{third}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER BE LIABLE
"""
THIRD = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""
GNU = """This {what} is free software{stop} you can redistribute it and/or modify
it under the terms of the GNU {kind}General Public License as published by
the Free Software Foundation{then} either version {version} of the License, or
(at your option) any later version.

This {what} is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU {kind}General Public License for more details.
"""
NOTICES = [
    (APACHE, "Apache-2.0"), (APACHE.replace("http:", "https:"), "Apache-2.0"), (MIT, "MIT"), (MPL, "MPL-2.0"),
    (BSD.format(blank="", third=""), "BSD-2-Clause"), (BSD.format(blank="\n", third=""), "BSD-2-Clause"),
    (BSD.format(blank="\n", third=THIRD), "BSD-3-Clause"), (BSD.format(blank="", third=THIRD), "BSD-3-Clause"),
    (GNU.format(what="program", stop=";", kind="", then=";", version="2"), "GPL-2.0-or-later"),
    (GNU.format(what="program", stop=":", kind="", then=",", version="3"), "GPL-3.0-or-later"),
    (GNU.format(what="library", stop=";", kind="Lesser ", then=";", version="2.1"), "LGPL-2.1-or-later"),
    (GNU.format(what="program", stop=":", kind="Lesser ", then=",", version="3"), "LGPL-3.0-or-later"),
    (GNU.format(what="program", stop=":", kind="Affero ", then=",", version="3"), "AGPL-3.0-or-later"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.\n", "CC-BY-4.0"),
    (licenses.SENTENCES[40] + "\n", "CC0-1.0"),
]


@pytest.fixture(scope="module")
def found(spark):
    marks = {"plain": "", "hash": "# ", "slash": "// ", "star": " * ", "dash": "-- ", "semicolon": ";; "}
    rows = {}
    for k, (notice, _) in enumerate(NOTICES):
        for kind, mark in marks.items():
            text = "\n".join((mark + line).rstrip() for line in notice.splitlines())
            rows[k, kind] = f"/*\n{text}\n */\nint x;" if kind == "star" else f"{text}\n\ncode"
    keys = list(rows)
    given = spark.createDataFrame([(i, rows[key]) for i, key in enumerate(keys)], "doc_id long, text string")
    return {keys[r.doc_id]: r.licenses for r in licenses.recognise(given).collect()}


@pytest.mark.parametrize("kind", ["plain", "hash", "slash", "star", "dash", "semicolon"])
def test_published_notices_are_recognised(found, kind):
    assert [found[k, kind] for k in range(len(NOTICES))] == [[name] for _, name in NOTICES]
