"""Licence notices and short licence texts by SPDX id.

Fixed values: the wording is the licensors'.
"""

_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
    "and associated documentation files (the \"Software\"), to deal in the Software without "
    "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
    "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
    "Software is furnished to do so, subject to the following conditions:"
)
_MIT_REST = (
    "The above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF "
    "ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE "
    "OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met:"
)
_BSD_TWO = (
    "1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
    "above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution."
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to "
    "endorse or promote products derived from this software without specific prior written "
    "permission."
)
_BSD_REST = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS "
    "OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
    "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND "
    "ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
    "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF "
    "THE POSSIBILITY OF SUCH DAMAGE."
)
_ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
    "without fee is hereby granted, provided that the above copyright notice and this permission "
    "notice appear in all copies."
)
_ISC_REST = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS "
    "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE "
    "AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
    "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
    "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE."
)
_UNLICENSE = (
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
    "modify, publish, use, compile, sell, or distribute this software, either in source code form or "
    "as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
)
_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will "
    "the authors be held liable for any damages arising from the use of this software. Permission is "
    "granted to anyone to use this software for any purpose, including commercial applications, and "
    "to alter it and redistribute it freely, subject to the following restrictions:"
)
_BOOST = (
    "Distributed under the Boost Software License, Version 1.0. (See accompanying file "
    "LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)"
)
_APACHE = (
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
    "except in compliance with the License. You may obtain a copy of the License at"
)
_APACHE_REST = (
    "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
    "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
    "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
    "specific language governing permissions and limitations under the License."
)
_MPL = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy "
    "of the MPL was not distributed with this file, You can obtain one at "
    "https://mozilla.org/MPL/2.0/."
)
_CC0 = "This work is released into the public domain under CC0 1.0 Universal."


def _gnu(work: str, name: str, version: str, later: bool) -> str:
    """The notice that the GNU licences ask for."""
    mark = ":" if version.startswith("3") else ";"
    comma = "," if version.startswith("3") else ";"
    which = f"either version {version} of the License, or (at your option) any later version."
    return (
        f"This {work} is free software{mark} you can redistribute it and/or modify it under the terms "
        f"of the GNU {name} as published by the Free Software Foundation{comma} "
        + (which if later else f"version {version} of the License.")
    )


def _creative_commons(kind: str) -> str:
    return f"This work is licensed under a Creative Commons {kind} 4.0 International License."


_GPL, _LESSER, _AFFERO = (
    "General Public License", "Lesser General Public License", "Affero General Public License"
)
_GNU = [
    ("GPL-2.0", "program", _GPL, "2"),
    ("GPL-3.0", "program", _GPL, "3"),
    ("LGPL-2.1", "library", _LESSER, "2.1"),
    ("LGPL-3.0", "program", _LESSER, "3"),
    ("AGPL-3.0", "program", _AFFERO, "3"),
]
_CREATIVE_COMMONS = [
    ("BY", "Attribution"),
    ("BY-SA", "Attribution-ShareAlike"),
    ("BY-ND", "Attribution-NoDerivatives"),
    ("BY-NC", "Attribution-NonCommercial"),
    ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
]

TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", _MIT_GRANT),
    ("MIT", f"{_MIT_GRANT} {_MIT_REST}"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", _APACHE),
    ("Apache-2.0", f"{_APACHE} {_APACHE_REST}"),
    *[
        (f"{spdx}-only", f"This work is licensed under the GNU {name}, version {version}.")
        for spdx, _, name, version in _GNU
    ],
    *[
        (f"{spdx}-{'or-later' if later else 'only'}", _gnu(work, name, version, later))
        for spdx, work, name, version in _GNU
        for later in (True, False)
    ],
    ("BSD-2-Clause", f"{_BSD_GRANT} {_BSD_TWO} {_BSD_REST}"),
    ("BSD-3-Clause", f"{_BSD_GRANT} {_BSD_TWO} {_BSD_THIRD} {_BSD_REST}"),
    ("ISC", _ISC_GRANT),
    ("ISC", f"{_ISC_GRANT} {_ISC_REST}"),
    ("Unlicense", _UNLICENSE),
    ("Zlib", _ZLIB),
    ("BSL-1.0", _BOOST),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", _MPL),
    *[(f"CC-{spdx}-4.0", _creative_commons(kind)) for spdx, kind in _CREATIVE_COMMONS],
    *[(f"CC-{spdx}-4.0", f"Licensed under CC {spdx} 4.0.") for spdx, _ in _CREATIVE_COMMONS],
    ("CC0-1.0", _CC0),
)
