"""Templates of the license scan: whole texts, usual headers and short notices of common licenses.

``licenses/`` holds whole texts as Debian's base-files ships them; shorter ones are here. Names end in ``-header`` and
``-notice`` for the two shorter kinds. The list is made from the licenses' own texts and usual wording, not from any table.
"""

from __future__ import annotations

import pkgutil
import re

SHIPPED = ("Apache-2.0", "Artistic-1.0", "CC0-1.0", "GFDL-1.3", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-1.1", "MPL-2.0")


def _shipped(name: str) -> str:
    """ASCII words of a shipped text on one line, from the first letter on."""
    text = pkgutil.get_data(__package__, f"licenses/{name}.txt").decode("utf-8").encode("ascii", "ignore").decode()
    return re.sub(r"^[^A-Za-z0-9]+|[^A-Za-z0-9]+$", "", re.sub(r"\s+", " ", text))


def _affero(gpl: str) -> str:
    """The AGPL-3.0 as far as it is the GPL-3.0's text, with the name and section 13 of its own."""
    named = gpl.replace("GNU GENERAL PUBLIC", "GNU AFFERO GENERAL PUBLIC").replace("GNU General Public", "GNU Affero General Public")
    start, end = named.index("13. Use with the GNU"), named.index("14. Revised Versions")
    section = (
        "13. Remote Network Interaction; Use with the GNU General Public License. Notwithstanding any other provision of this License, if you modify the "
        "Program, your modified version must prominently offer all users interacting with it remotely through a computer network (if your version supports such "
        "interaction) an opportunity to receive the Corresponding Source of your version by providing access to the Corresponding Source from a network server at no "
        "charge, through some standard or customary means of facilitating copying of software. This Corresponding Source shall include the Corresponding Source for any "
        "work covered by version 3 of the GNU General Public License that is incorporated pursuant to the following paragraph. Notwithstanding any other provision of "
        "this License, you have permission to link or combine any covered work with a work licensed under version 3 of the GNU General Public License into a single "
        "combined work, and to convey the resulting work. The terms of this License will continue to apply to the part which is the covered work, but the work with which "
        "it is combined will remain governed by version 3 of the GNU General Public License. "
    )
    return named[:start] + section + named[end:]


_MIT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
    "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
    "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"
)
_MIT_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
    "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. '
    "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
    "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
    "in the documentation and/or other materials provided with the distribution. "
)
_BSD_THIRD = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
    "without specific prior written permission. "
)
_BSD_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES '
    "OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
    "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; "
    "OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING "
    "IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)


def _gnu_header(name: str, version: str, thing: str = "This program") -> str:
    return (
        f"{thing} is free software: you can redistribute it and/or modify it under the terms of the {name} as published by "
        f"the Free Software Foundation, either version {version} of the License, or (at your option) any later version. "
        f"{thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        f"MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details."
    )


_GPL, _LGPL, _AGPL = "GNU General Public License", "GNU Lesser General Public License", "GNU Affero General Public License"
#: One text for a name.
WHOLE = {name: _shipped(name) for name in SHIPPED}
WHOLE |= {
    "AGPL-3.0": _affero(WHOLE["GPL-3.0"]),
    "MIT": f"{_MIT}, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. {_MIT_WARRANTY}",
    "MIT-0": f"{_MIT}. {_MIT_WARRANTY}",
    "ISC": f"{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies. {_ISC_WARRANTY}",
    "0BSD": f"{_ISC_GRANT}. {_ISC_WARRANTY}",
    "BSD-2-Clause": _BSD + _BSD_WARRANTY,
    "BSD-3-Clause": _BSD + _BSD_THIRD + _BSD_WARRANTY,
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. "
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
        "restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an "
        "acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented "
        "as being the original software. 3. This notice may not be removed or altered from any source distribution."
    ),
    "BSL-1.0": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "
        '"Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the '
        "Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this "
        "restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or "
        "derivative works are solely in the form of machine-executable object code generated by a source language processor."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute "
        "this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. "
        "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. "
        "We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of "
        "relinquishment in perpetuity of all present and future rights to this software under copyright law."
    ),
}
HEADERS = {
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
        "See the License for the specific language governing permissions and limitations under the License."
    ),
    "GPL-2.0-header": _gnu_header(_GPL, "2"),
    "GPL-3.0-header": _gnu_header(_GPL, "3"),
    "LGPL-2.1-header": _gnu_header(_LGPL, "2.1", "This library"),
    "LGPL-3.0-header": _gnu_header(_LGPL, "3"),
    "AGPL-3.0-header": _gnu_header(_AGPL, "3"),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
        "You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "EPL-1.0-header": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, "
        "and is available at http://www.eclipse.org/legal/epl-v10.html"
    ),
    "EPL-2.0-header": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at "
        "https://www.eclipse.org/legal/epl-2.0/"
    ),
    "CC0-1.0-header": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. "
        "This software is distributed without any warranty. You should have received a copy of the CC0 Public Domain Dedication along with this software."
    ),
}
_LEADS = (
    "Licensed under {}", "Licensed under the {}", "Released under the {}", "This work is licensed under {}", "This work is licensed under a {}", "This work is licensed under the {}", "This software is released under the {}",
    "This project is licensed under the terms of the {}", "Distributed under the {}", "Made available under the {}", "This file is subject to the {}",
)


def _gnu(name: str, short: str, version: str) -> list[str]:
    return [f"{name}, version {version}", f"{name} v{version}", f"{name} {version}", f"GNU {short} version {version}", f"GNU {short} v{version}", f"{short}-{version}", f"{short} v{version}", f"{short}v{version}"]


#: How a license is called in notices. A notice must hold one of these names word for word; an SPDX id also counts.
NAMES = {
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0"],
    "MIT": ["MIT License", "MIT Licence"],
    "ISC": ["ISC License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License"],
    "GPL-2.0": _gnu(_GPL, "GPL", "2"),
    "GPL-3.0": _gnu(_GPL, "GPL", "3"),
    "LGPL-2.1": _gnu(_LGPL, "LGPL", "2.1"),
    "LGPL-3.0": _gnu(_LGPL, "LGPL", "3"),
    "AGPL-3.0": _gnu(_AGPL, "AGPL", "3"),
    "MPL-2.0": ["Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "Mozilla Public License v2.0"],
    "EPL-1.0": ["Eclipse Public License v1.0", "Eclipse Public License 1.0", "Eclipse Public License, Version 1.0"],
    "EPL-2.0": ["Eclipse Public License v2.0", "Eclipse Public License 2.0", "Eclipse Public License, Version 2.0"],
    "BSL-1.0": ["Boost Software License, Version 1.0", "Boost Software License 1.0"],
    "Zlib": ["zlib License"],
    "Unlicense": ["The Unlicense"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero v1.0"],
}
for _v in ("3.0", "4.0"):
    for _short, _long in {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
                          "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}.items():
        NAMES[f"CC-{_short}-{_v}"] = [f"CC {_short} {_v}", f"Creative Commons {_long} {_v}"]


def notices() -> list[tuple[str, str, str]]:
    """(name of the template, text, the license's name in it)."""
    out = [(f"{which}-notice", lead.format(name), name) for which, names in NAMES.items() for lead in _LEADS for name in names]
    out += [(f"{which}-notice", f"SPDX-License-Identifier: {which}", which) for which in NAMES]
    return [n for n in out if len(re.findall(r"[A-Za-z0-9]+", n[1])) >= 4]
