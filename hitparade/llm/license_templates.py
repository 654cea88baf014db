"""License notices and permission texts as they are published, the words that a match has to contain, and
the phrases that must not stand in it. A license can have a notice, an opening or file header, and its whole text."""

import pkgutil

TEMPLATES = {
    "MIT-notice": ("Released under the MIT License.", ("mit",)),
    "Apache-2.0-notice": ("Licensed under the Apache License, Version 2.0.", ("apache", "2")),
    "GPL-3.0-notice": ("This work is licensed under the GNU General Public License, version 3.", ("gnu", "3")),
    "CC-BY-NC-4.0-notice": ("Licensed under CC BY-NC 4.0.", ("cc", "by", "nc", "4", "0")),
    "MIT": (
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to
        permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright
        notice and this permission notice shall be included in all copies or substantial portions of the Software.""",
        (),
    ),
    "ISC": (
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
        (),
    ),
    "BSD-2-Clause": (
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution.""",
        (),
    ),
    "Apache-2.0": (
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required
        by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License.""",
        (),
    ),
    "GPL-3.0": (
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
        details.""",
        ("gnu", "3"),
    ),
}

GNU = """This {work} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU {kind} as published
by the Free Software Foundation{mark} either version {version} of the License, or (at your option) any later version. This
{work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} for more details."""
KINDS = {"GPL": "General Public License", "LGPL": "Lesser General Public License", "AGPL": "Affero General Public License"}

for _name, _needed in {
    "GPL-2.0": ("gnu", "2"),
    "LGPL-2.1": ("gnu", "lesser", "2", "1"),
    "LGPL-3.0": ("gnu", "lesser", "3"),
    "AGPL-3.0": ("gnu", "affero", "3"),
}.items():
    _family, _version = _name.split("-")
    _own = {"kind": KINDS[_family], "work": "library" if _family == "LGPL" else "program", "version": _version.removesuffix(".0")}
    TEMPLATES[_name] = (GNU.format(mark=";", **_own), _needed)
    TEMPLATES[f"{_name}-notice"] = (f"This work is licensed under the GNU {_own['kind']}, version {_own['version']}.", _needed)

TEMPLATES |= {
    "BSD-3-Clause": (
        TEMPLATES["BSD-2-Clause"][0]
        + """ Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
        products derived from this software without specific prior written permission.""",
        ("redistributions", "endorse"),
    ),
    "BSD-notice": (
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        ("bsd", "governed"),
    ),
    "MPL-2.0": (
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
        ("mozilla", "2", "0"),
    ),
    "MPL-2.0-notice": ("Licensed under the Mozilla Public License, version 2.0.", ("mozilla", "2", "0")),
    "CC0-1.0-notice": ("Licensed under CC0 1.0.", ("cc0", "1", "0")),
    "Unlicense-notice": ("Released under the Unlicense.", ("unlicense", "released")),
}

#: The Creative Commons family by its parts: the word of each part before and since version 4.0.
PARTS = {"NC": ("NonCommercial", "NonCommercial"), "ND": ("NoDerivs", "NoDerivatives"), "SA": ("ShareAlike", "ShareAlike")}
VERSIONS = {"1.0": "Generic", "2.0": "Generic", "2.5": "Generic", "3.0": "Unported", "4.0": "International"}
BARRED: dict[str, tuple[str, ...]] = {}
SENTENCES: dict[str, tuple[str, tuple[str, ...]]] = {}

for _parts in ((), ("NC",), ("ND",), ("SA",), ("NC", "ND"), ("NC", "SA")):
    for _version, _place in VERSIONS.items():
        _code, _digits = "-".join(("BY", *_parts)), tuple(_version.split("."))
        _name = f"CC-{_code}-{_version}-notice"
        _long = [PARTS[part][_version >= "4"] for part in _parts]
        TEMPLATES.setdefault(_name, (f"Licensed under CC {_code} {_version}.", ("cc", *_code.lower().split("-"), *_digits)))
        SENTENCES[_name] = (
            f"This work is licensed under a Creative Commons {'-'.join(('Attribution', *_long))} {_version} {_place} License.",
            ("commons", "attribution", *(word.lower() for word in _long), *_digits),
        )
        BARRED[_name] = tuple(
            phrase for part, words in PARTS.items() if part not in _parts for phrase in (part.lower(), *map(str.lower, words))
        )

for _name in [name for name in TEMPLATES if "GPL" in name and name.endswith("-notice")]:
    SENTENCES[_name] = (TEMPLATES[_name][0].replace("This work is licensed", "Licensed"), TEMPLATES[_name][1])

_OTHER_GNU = ("gnu lesser", "gnu library", "gnu affero", "gnu free")
BARRED |= {name: _OTHER_GNU for name in ("GPL-2.0", "GPL-2.0-notice", "GPL-3.0", "GPL-3.0-notice")}
BARRED["BSD-2-Clause"] = ("endorse", "advertising")
BARRED["BSD-3-Clause"] = ("advertising",)

#: Whole texts, in licenses/. Two words each that a match has to contain.
WHOLE = {
    name: (pkgutil.get_data(__package__, f"licenses/{name}.txt").decode(), needed)
    for name, needed in {
        "Apache-2.0": ("apache", "derivative"),
        "Artistic-1.0": ("artistic", "package"),
        "BSD-2-Clause": ("redistributions", "disclaimer"),
        "BSD-3-Clause": ("redistributions", "endorse"),
        "BSD-4-Clause": ("redistributions", "advertising"),
        "CC0-1.0": ("cc0", "affirmer"),
        "GFDL-1.2": ("gnu", "invariant"),
        "GFDL-1.3": ("gnu", "invariant"),
        "GPL-1.0": ("gnu", "program"),
        "GPL-2.0": ("gnu", "sublicense"),
        "GPL-3.0": ("gnu", "conveying"),
        "ISC": ("merchantability", "permission"),
        "LGPL-2.0": ("gnu", "library"),
        "LGPL-2.1": ("gnu", "lesser"),
        "LGPL-3.0": ("gnu", "lesser"),
        "MIT": ("noninfringement", "sublicense"),
        "MPL-1.1": ("mozilla", "initial"),
        "MPL-2.0": ("mozilla", "incompatible"),
        "Unlicense": ("unencumbered", "domain"),
    }.items()
}
#: The same for whole texts: the text of AGPL-3.0 is that of GPL-3.0 but for a section on remote use.
BARRED_WHOLE = {name: BARRED[name] for name in ("BSD-2-Clause", "BSD-3-Clause")} | {"GPL-3.0": ("remotely",)}

#: Not licenses: rights that are reserved.
RESERVED = (
    ("All rights reserved.", ("reserved", "all", "rights")),
    ("Alle Rechte vorbehalten.", ("vorbehalten", "alle", "rechte")),
    ("Tous droits réservés.", ("réservés", "tous", "droits")),
    ("Todos los derechos reservados.", ("reservados", "todos", "los", "derechos")),
)


def entries(reserved: bool = False):
    """Name, text, needed words and barred phrases of every template; reserved adds those that reserve rights."""
    for table in (TEMPLATES, SENTENCES):
        for name, (text, needed) in table.items():
            yield name, text, needed, BARRED.get(name, ())
    for name, (text, needed) in WHOLE.items():
        yield name, text, needed, BARRED_WHOLE.get(name, ())
    if reserved:
        for text, needed in RESERVED:
            yield "all-rights-reserved", text, needed, ("not", "nicht", "pas", "no")
