"""Known licence texts and notices. Public licence wordings."""

from __future__ import annotations

import re
from pathlib import Path

MIT = """MIT License

Copyright (c) <year> <copyright holders>

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""

_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""

BSD_2 = """Copyright (c) <year> <owner>

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

""" + _BSD_END

BSD_3 = """Copyright (c) <year> <owner>

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission.

""" + _BSD_END

_ISC_END = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.
"""

ISC = """ISC License

Copyright (c) <year> <owner>

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.

""" + _ISC_END

ZERO_BSD = """Copyright (c) <year> <owner>

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

""" + _ISC_END

ZLIB = """Copyright (c) <year> <owner>

This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter
it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software.

3. This notice may not be removed or altered from any source distribution.
"""

APACHE_NOTICE = """Copyright [yyyy] [name of copyright owner]

Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License.
"""

KNOWN = (
    ("MIT", MIT),
    ("MIT", MIT.removeprefix("MIT License\n")),
    ("BSD-2-Clause", BSD_2),
    ("BSD-3-Clause", BSD_3),
    ("ISC", ISC),
    ("ISC", ISC.removeprefix("ISC License\n")),
    ("0BSD", ZERO_BSD),
    ("Zlib", ZLIB),
    ("Apache-2.0", APACHE_NOTICE),
)

# One-line notices; each holds the letters "licen".
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
)

# What follows is looked up too, but stands outside the lists that the SQL is made of.

_ADDRESS = re.compile(r"51\s+Franklin\s+St(?:reet)?,\s+Fifth\s+Floor,\s+Boston,\s+MA\s+02110-1301,?\s+USA")
_ADDRESSES = ("51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA",
              "51 Franklin St, Fifth Floor, Boston, MA 02110-1301 USA",
              "59 Temple Place, Suite 330, Boston, MA 02111-1307 USA",
              "59 Temple Place - Suite 330, Boston, MA 02111-1307, USA",
              "675 Mass Ave, Cambridge, MA 02139, USA", "")
_TERMS_END = re.compile(r"(?m)^[ \t]*END OF TERMS AND CONDITIONS[ \t]*$")
_ADDENDUM = re.compile(r"(?m)^ADDENDUM: How to use this License")


def whole_texts() -> list[tuple[str, str]]:
    """(license_id, text) of the files in license_texts, as they are, without the appendix on how
    to apply them, and with the earlier postal addresses of their publisher."""
    out = []
    for file in sorted((Path(__file__).parent / "license_texts").glob("*.txt")):
        text = file.read_text("utf-8")
        forms = [text]
        if end := _TERMS_END.search(text):
            forms += [text[:end.end()], text[:end.start()]]
        if end := _ADDENDUM.search(text):
            forms.append(text[:end.start()])
        for form in forms:
            out += [(file.stem, x) for x in dict.fromkeys([form, *(_ADDRESS.sub(a, form) for a in _ADDRESSES)])]
    return out


# The names that notices use. An id is also announced by its SPDX line and by "License: <id>".
_GNU = {"GPL": ("GNU General Public License", "GNU GPL", "GPL"),
        "LGPL": ("GNU Lesser General Public License", "GNU LGPL", "LGPL"),
        "AGPL": ("GNU Affero General Public License", "GNU AGPL", "AGPL"),
        "GFDL": ("GNU Free Documentation License", "GNU FDL", "GFDL")}
_GNU_VERSIONS = (("GPL", "1.0"), ("GPL", "2.0"), ("GPL", "3.0"), ("LGPL", "2.0"), ("LGPL", "2.1"), ("LGPL", "3.0"),
                 ("AGPL", "3.0"), ("GFDL", "1.2"), ("GFDL", "1.3"))
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial",
       "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
       "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
_NAMES = {
    "MIT": ("MIT License", "MIT"),
    "ISC": ("ISC License", "ISC"),
    "0BSD": ("Zero-Clause BSD License", "BSD Zero Clause License", "0BSD License"),
    "Zlib": ("zlib License",),
    "Unlicense": ("Unlicense",),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License", "BSD-2-Clause License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License",
                     "BSD-3-Clause License"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache 2.0",
                   "Apache License v2.0", "Apache Software License 2.0"),
    "MPL-1.1": ("Mozilla Public License, Version 1.1", "Mozilla Public License 1.1", "MPL 1.1"),
    "MPL-2.0": ("Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "Mozilla Public License, v. 2.0",
                "MPL 2.0"),
    "EPL-2.0": ("Eclipse Public License, Version 2.0", "Eclipse Public License 2.0", "EPL 2.0"),
    "BSL-1.0": ("Boost Software License, Version 1.0", "Boost Software License 1.0"),
    "CC0-1.0": ("CC0 1.0", "CC0 1.0 Universal", "Creative Commons CC0 1.0 Universal License",
                "Creative Commons Zero v1.0 Universal"),
    "Artistic-1.0-Perl": (),
    "Artistic-2.0": ("Artistic License 2.0",),
} | {
    f"CC-{kind}-{version}": tuple(x for name in (f"CC {kind} {version}", f"CC-{kind}-{version}",
                                                 f"Creative Commons {long} {version}")
                                  for x in (name, f"{name} License", f"{name} International",
                                            f"{name} International License"))
    for kind, long in _CC.items() for version in ("4.0", "3.0")
}
_VERBS = ("Licensed under", "Released under", "Distributed under",
          *(f"This {thing} is {verb} under" for verb in ("licensed", "released")
            for thing in ("work", "project", "software", "program")))
_LATER = (" or later", " or any later version", " or (at your option) any later version")


def _gnu_names() -> dict[str, list[str]]:
    out = {}
    for family, version in _GNU_VERSIONS:
        plain = [name + sep + v for name in _GNU[family] for v in dict.fromkeys((version, version.removesuffix(".0")))
                 for sep in (", version ", " v", " ", "v") if sep != "v" or name == family]
        out |= {f"{family}-{version}": plain, f"{family}-{version}-or-later": [x + y for x in plain for y in _LATER],
                f"{family}-{version}-only": [f"{x} only" for x in plain]}
    return out


def notices() -> list[tuple[str, str]]:
    """(license_id, line) of the SPDX line and the common notice forms of each licence."""
    out = []
    for name, called in (_NAMES | _gnu_names()).items():
        out += [(name, f"SPDX-License-Identifier: {name}"), (name, f"License: {name}")]
        for x in called:
            out.append((name, f"License: {x}"))
            out += [(name, f"{verb} {the}{x}.") for verb in _VERBS for the in ("", "the ", "the terms of the ")]
    return out


def wordings() -> list[tuple[str, str]]:
    """Every (license_id, text) that is looked up by default."""
    return [*KNOWN, *NOTICES, *whole_texts(), *notices()]
