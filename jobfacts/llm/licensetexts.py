"""Licence wording: names, notices, headers and whole texts, as templates for ``licenses``.

In a template, square brackets hold words that decide which licence it is: these must stand in a
text exactly and together.  Other words may be edited.  Names are written once; the short
notices follow from them by rule.
"""

from __future__ import annotations

# Names by which licences are called, by identifier (versions and variants are
# licences of their own; a name without a version stands for any).
NAMES = {
    "0bsd": ["BSD Zero Clause License", "Zero-Clause BSD License", "0BSD License"],
    "afl-3.0": ["Academic Free License, version 3.0", "Academic Free License 3.0"],
    "agpl": ["GNU Affero General Public License", "Affero General Public License"],
    "agpl-3.0": ["GNU Affero General Public License, version 3", "GNU Affero General Public License version 3.0", "AGPLv3", "AGPL-3.0", "GNU AGPL v3"],
    "apache": ["Apache License"],
    "apache-1.1": ["Apache License, Version 1.1", "Apache Software License, Version 1.1"],
    "apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache Software License 2.0", "Apache-2.0 License"],
    "artistic-2.0": ["Artistic License 2.0", "Artistic License, Version 2.0"],
    "bsd": ["BSD License", "BSD-style License"],
    "bsd-2-clause": ["BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License", "FreeBSD License"],
    "bsd-3-clause": ["BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License", "Revised BSD License"],
    "bsd-4-clause": ["BSD 4-Clause License", "4-Clause BSD License", "Original BSD License"],
    "bsl-1.0": ["Boost Software License, Version 1.0", "Boost Software License 1.0", "Boost Software License"],
    "cc-by-2.0": ["Creative Commons Attribution 2.0", "CC BY 2.0"],
    "cc-by-2.5": ["Creative Commons Attribution 2.5", "CC BY 2.5"],
    "cc-by-3.0": ["Creative Commons Attribution 3.0", "CC BY 3.0"],
    "cc-by-4.0": ["Creative Commons Attribution 4.0", "CC BY 4.0"],
    "cc-by-nc-3.0": ["Creative Commons Attribution-NonCommercial 3.0", "CC BY-NC 3.0"],
    "cc-by-nc-4.0": ["Creative Commons Attribution-NonCommercial 4.0", "CC BY-NC 4.0"],
    "cc-by-nc-nd-4.0": ["Creative Commons Attribution-NonCommercial-NoDerivatives 4.0", "CC BY-NC-ND 4.0"],
    "cc-by-nc-sa-3.0": ["Creative Commons Attribution-NonCommercial-ShareAlike 3.0", "CC BY-NC-SA 3.0"],
    "cc-by-nc-sa-4.0": ["Creative Commons Attribution-NonCommercial-ShareAlike 4.0", "CC BY-NC-SA 4.0"],
    "cc-by-nd-4.0": ["Creative Commons Attribution-NoDerivatives 4.0", "CC BY-ND 4.0"],
    "cc-by-sa-3.0": ["Creative Commons Attribution-ShareAlike 3.0", "CC BY-SA 3.0"],
    "cc-by-sa-4.0": ["Creative Commons Attribution-ShareAlike 4.0", "CC BY-SA 4.0"],
    "cc0-1.0": ["CC0 1.0", "Creative Commons Zero 1.0", "CC0"],
    "cddl-1.0": ["Common Development and Distribution License 1.0", "CDDL 1.0"],
    "epl-1.0": ["Eclipse Public License, Version 1.0", "Eclipse Public License 1.0", "Eclipse Public License v1.0"],
    "epl-2.0": ["Eclipse Public License, Version 2.0", "Eclipse Public License 2.0", "Eclipse Public License v2.0"],
    "eupl-1.2": ["European Union Public Licence, Version 1.2", "EUPL 1.2", "EUPL v1.2"],
    "gfdl-1.3": ["GNU Free Documentation License, Version 1.3"],
    "gpl": ["GNU General Public License", "GNU GPL"],
    "gpl-2.0": ["GNU General Public License, version 2", "GNU General Public License version 2.0", "GNU General Public License v2", "GPLv2", "GPL-2.0", "GNU GPL v2"],
    "gpl-3.0": ["GNU General Public License, version 3", "GNU General Public License version 3.0", "GNU General Public License v3", "GPLv3", "GPL-3.0", "GNU GPL v3"],
    "isc": ["ISC License"],
    "lgpl": ["GNU Lesser General Public License", "GNU LGPL"],
    "lgpl-2.1": ["GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1", "LGPLv2.1", "LGPL-2.1"],
    "lgpl-3.0": ["GNU Lesser General Public License, version 3", "GNU Lesser General Public License version 3.0", "LGPLv3", "LGPL-3.0"],
    "mit": ["MIT License", "Expat License", "MIT/X11 License"],
    "mit-0": ["MIT No Attribution License", "MIT-0 License"],
    "mpl-1.1": ["Mozilla Public License, Version 1.1", "Mozilla Public License 1.1", "MPL 1.1"],
    "mpl-2.0": ["Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "Mozilla Public License, v. 2.0", "MPL 2.0"],
    "ms-pl": ["Microsoft Public License"],
    "odbl-1.0": ["Open Database License v1.0", "Open Database License 1.0"],
    "ofl-1.1": ["SIL Open Font License, Version 1.1", "SIL Open Font License 1.1", "Open Font License, Version 1.1"],
    "unlicense": ["Unlicense"],
    "wtfpl": ["Do What The Fuck You Want To Public License", "WTFPL"],
    "zlib": ["zlib License"],
    "zpl-2.1": ["Zope Public License, Version 2.1", "Zope Public License 2.1"],
}

#: a word that may stand for another, in templates and texts
SAME_WORDS = {"licence": "license", "licenced": "licensed", "released": "licensed", "distributed": "licensed", "available": "licensed",
              "published": "licensed", "provided": "licensed", "offered": "licensed",
              "software": "work", "program": "work", "project": "work", "file": "work", "document": "work", "library": "work",
              "repository": "work", "code": "work", "an": "a", "the": "a"}

_APACHE_HEADER = """Licensed under the [Apache License, Version 2.0] (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at"""
_GNU = """This {work} is free software{colon} you can redistribute it and/or modify it under the terms of the [GNU {kind}General Public License]
as published by the Free Software Foundation{either} [version {version}] of the License, or (at your option) any later version."""
_BSD_START = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_1 = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
_BSD_2 = """Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution."""
_BSD_AD = "[All advertising materials mentioning features or use of this software must display the following acknowledgement]:"
_BSD_3 = """[Neither the name of] the copyright holder nor the names of its contributors may be used to endorse or promote products derived from
this software without specific prior written permission."""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER
OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE,
EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the
"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"""
_MIT_NOTICE = """subject to the following conditions: [The above copyright notice and this permission notice] shall be included in all copies or
substantial portions of the Software."""
_MIT_END = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE
USE OR OTHER DEALINGS IN THE SOFTWARE."""


def _gnu(work: str, kind: str, version: str, colon: str = ":", either: str = ", either") -> str:
    return _GNU.format(work=work, kind=kind, version=version, colon=colon, either=either)


# Wording of headers and whole texts, by identifier and part.
TEXTS = {
    "all-rights-reserved": "[All rights reserved]",
    "agpl-3.0 header": _gnu("program", "Affero ", "3"),
    "apache-2.0 header": _APACHE_HEADER,
    "bsd opening": _BSD_START,
    "bsd-2-clause text": " ".join([_BSD_START, "1.", _BSD_1, "2.", _BSD_2, _BSD_END]),
    "bsd-3-clause text": " ".join([_BSD_START, "1.", _BSD_1, "2.", _BSD_2, "3.", _BSD_3, _BSD_END]),
    "bsd-4-clause text": " ".join([_BSD_START, "1.", _BSD_1, "2.", _BSD_2, "3.", _BSD_AD, "4.", _BSD_3, _BSD_END]),
    "bsl-1.0 text": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying
        documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to
        prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the
        following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the
        following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software,
        unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.""",
    "gpl-2.0 header": _gnu("program", "", "2", ";", "; either"),
    "gpl-3.0 header": _gnu("program", "", "3"),
    "isc text": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that
        the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL
        WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE
        LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
        WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
        SOFTWARE.""",
    "lgpl-2.1 header": _gnu("library", "Lesser ", "2.1", ";", "; either"),
    "lgpl-3.0 header": _gnu("program", "Lesser ", "3"),
    "mit opening": _MIT_GRANT,
    "mit text": " ".join([_MIT_GRANT + ",", _MIT_NOTICE, _MIT_END]),
    "mit-0 text": " ".join([_MIT_GRANT + ".", _MIT_END]),
    "mpl-1.1 header": """The contents of this file are subject to the [Mozilla Public License Version 1.1] (the "License"); you may not use this file
        except in compliance with the License. You may obtain a copy of the License at""",
    "mpl-2.0 header": """This Source Code Form is subject to the terms of the [Mozilla Public License, v. 2.0]. If a copy of the MPL was not distributed
        with this file, You can obtain one at""",
    "unlicense text": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile,
        sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by
        any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in
        the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and
        successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software
        under copyright law.""",
    "zlib text": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any
        damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial
        applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be
        misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the
        product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be
        misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.""",
}


def templates() -> dict[str, str]:
    """All templates, by "identifier part": the texts, and notices of two lengths for every name."""
    made = dict(TEXTS)
    for licence, names in NAMES.items():
        for i, name in enumerate(names):
            made[f"{licence} notice {i}"] = f"Licensed under the [{name}]"
            made[f"{licence} sentence {i}"] = f"This work is licensed under the [{name}]"
        made[f"{licence} tag"] = f"[SPDX-License-Identifier: {licence}]"
    return made
