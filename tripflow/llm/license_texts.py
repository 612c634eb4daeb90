"""Known licence texts and notices. All strings here and the files in ``licenses`` are fixed values."""

from __future__ import annotations

from pathlib import Path

_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""

_BSD_AS_IS = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS
OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_BSD_TERMS = """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""

_ISC_TERMS = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted{}.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""

_MIT_TERMS = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
"""

#: Whole licences, without copyright lines.
TEXTS = {
    "MIT": "MIT License\n" + _MIT_TERMS + _AS_IS,
    "MIT (no title)": _MIT_TERMS + _AS_IS,
    "ISC": "ISC License\n" + _ISC_TERMS.format(", provided that the above copyright notice and this permission notice appear in all copies"),
    "0BSD": "Zero-Clause BSD\n" + _ISC_TERMS.format(""),
    "BSD-2-Clause": "BSD 2-Clause License\n" + _BSD_TERMS + "\n" + _BSD_AS_IS,
    "BSD-3-Clause": "BSD 3-Clause License\n" + _BSD_TERMS + """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.
""" + _BSD_AS_IS,
    "Apache-2.0 (header)": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License.""",
    "MPL-2.0 (header)": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy
of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
}

#: Lines of the title of the texts in ``licenses``, without blank lines, and the line after which the terms end.
FILES = {
    "Apache-2.0": (3, "END OF TERMS AND CONDITIONS"),
    "GPL-2.0": (2, "END OF TERMS AND CONDITIONS"),
    "GPL-3.0": (2, "END OF TERMS AND CONDITIONS"),
    "LGPL-3.0": (2, None),
    "MPL-2.0": (2, None),
    "CC0-1.0": (2, None),
}

#: Licence names as notices use them.
NAMES = {
    "MIT": ("the MIT License",),
    "Apache-2.0": ("the Apache License, Version 2.0", "Apache 2.0"),
    "GPL-2.0": ("the GNU General Public License, version 2", "GPL v2"),
    "GPL-3.0": ("the GNU General Public License, version 3", "GPL v3"),
    "LGPL-3.0": ("the GNU Lesser General Public License, version 3",),
    "AGPL-3.0": ("the GNU Affero General Public License, version 3",),
    "MPL-2.0": ("the Mozilla Public License, version 2.0",),
    "BSD-3-Clause": ("the BSD 3-Clause License",),
    "BSD-2-Clause": ("the BSD 2-Clause License",),
    "CC-BY-4.0": ("CC BY 4.0",),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0",),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0",),
    "CC0-1.0": ("CC0 1.0",),
}

#: How a notice begins.
OPENINGS = ("Licensed under", "Released under", "Distributed under", "This work is licensed under")

#: Words that count as the same, as canonical form.
SPELLINGS = {
    "licence": "license", "licences": "licenses", "licenced": "licensed", "sublicence": "sublicense",
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact",
    "authorisation": "authorization", "authorise": "authorize", "authorised": "authorized", "calibre": "caliber",
    "cancelled": "canceled", "capitalisation": "capitalization", "catalogue": "catalog", "categorise": "categorize",
    "centre": "center", "emphasised": "emphasized", "favour": "favor", "favourite": "favorite", "fulfil": "fulfill",
    "fulfilment": "fulfillment", "initialise": "initialize", "judgement": "judgment", "labelling": "labeling",
    "labour": "labor", "maximise": "maximize", "modelled": "modeled", "modelling": "modeling", "offence": "offense",
    "optimise": "optimize", "organisation": "organization", "organise": "organize", "practise": "practice",
    "programme": "program", "realise": "realize", "recognise": "recognize", "signalling": "signaling",
    "utilisation": "utilization", "whilst": "while", "wilful": "willful", "noncommercial": "non-commercial",
    "https": "http", "owner": "holder", "owners": "holders", "v2": "2", "v3": "3",
}


def known() -> list[tuple[str, str]]:
    """(licence, text) of whole licences and of notices."""
    whole = [(name.split(" ")[0], text) for name, text in TEXTS.items()]
    marks = [(name, f"SPDX-License-Identifier: {name}") for name in NAMES]
    lines = [(name, f"{o} {n}.") for name, own in NAMES.items() for n in own for o in OPENINGS]
    return whole + marks + lines


def whole_texts() -> list[tuple[str, str]]:
    """(licence, text) of whole licences with and without their title, and without what follows their terms."""
    out = []
    for name, text in TEXTS.items():
        if "(" not in name:
            out.append((name, text.split("\n", 1)[1]))
    for name, (title, end) in FILES.items():
        lines = [x for x in Path(__file__).with_name("licenses").joinpath(f"{name}.txt").read_text("utf-8").split("\n") if x.strip()]
        held = [lines]
        if end:
            last = next(k for k, x in enumerate(lines) if x.strip() == end)
            held += [lines[: last + 1], lines[:last]]
        out += [(name, "\n".join(x[k:])) for x in held for k in (0, title)]
    return out
