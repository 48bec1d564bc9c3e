"""The registered license templates: sentences, notices and whole texts of the usual licenses.

The first word of a name is the license (an SPDX identifier where there is one), the rest tells
the variants apart; names are unique. A phrase stands without its verb where it has five words by
itself. Whole texts are files in ``license_texts``.
"""

from __future__ import annotations

from importlib.resources import files

# One sentence of each of four licenses and opening words of notices.
OPENINGS = (
    ("MIT", "Released under the MIT License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT notice", "Permission is hereby granted, free of charge, to any person obtaining a copy "
                   "of this software"),
    ("BSD notice", "Redistribution and use in source and binary forms, with or without "
                   "modification, are permitted"),
    ("MPL-2.0 notice", "This Source Code Form is subject to the terms of the Mozilla Public "
                       "License"),
    ("GPL notice", "This program is free software: you can redistribute it and/or modify it under "
                   "the terms"),
)

# Names of licenses that are too short to stand without a verb.
_VERBS = ("licensed", "released", "distributed", "available", "published", "provided", "covered")
_AFTER_VERB = (
    ("MIT", "under the MIT License"),
    ("ISC", "under the ISC License"),
    ("BSD", "under the BSD License"),
    ("CC-BY-4.0", "under CC BY 4.0"),
    ("CC-BY-3.0", "under CC BY 3.0"),
    ("Apache-2.0", "under the Apache License, Version 2.0"),
    ("GPL-2.0", "under the GPL version 2"),
    ("GPL-3.0", "under the GPL version 3"),
    ("GPL", "under the GNU GPL"),
    ("LGPL", "under the GNU LGPL"),
    ("AGPL", "under the GNU AGPL"),
    ("Unlicense", "under the Unlicense license"),
)
# Sentences in which only the last word tells versions apart begin with their subject.
_SUBJECTS = ("program", "software", "project", "library", "code", "file", "package")

_PHRASES = (
    ("MIT terms", "the terms of the MIT License"),
    ("MIT heading", "The MIT License (MIT) Copyright (c)"),
    ("ISC terms", "the terms of the ISC License"),
    ("Apache-2.0 name", "the Apache License 2.0"),
    ("Apache-2.0 name 2", "the Apache 2.0 License"),
    ("Apache-2.0 name 3", "the Apache License v2.0"),
    ("Apache-2.0 name 4", "the Apache Software License 2.0"),
    ("BSD-2-Clause name", "the BSD 2-Clause License"),
    ("BSD-2-Clause name 2", "the 2-Clause BSD License"),
    ("BSD-3-Clause name", "the BSD 3-Clause License"),
    ("BSD-3-Clause name 2", "the 3-Clause BSD License"),
    ("BSD terms", "the terms of the BSD License"),
    ("MPL-2.0 name", "Mozilla Public License 2.0"),
    ("MPL-2.0 name 2", "Mozilla Public License, version 2.0"),
    ("MPL-2.0 name 3", "Mozilla Public License v2.0"),
    ("EPL-2.0 name", "Eclipse Public License 2.0"),
    ("EPL-2.0 name 2", "Eclipse Public License v2.0"),
    ("EPL-2.0 name 3", "Eclipse Public License, version 2.0"),
    ("BSL-1.0 name", "the Boost Software License, Version 1.0"),
    ("EUPL-1.2 name", "European Union Public Licence v1.2"),
    ("GPL-2.0 name", "GNU General Public License, version 2"),
    ("GPL-2.0 name 2", "GNU General Public License v2"),
    ("GPL-2.0 name 3", "GNU General Public License v2.0"),
    ("GPL-3.0 terms", "the terms of the GNU General Public License, version 3"),
    ("GPL-3.0 name 2", "GNU General Public License v3"),
    ("GPL-3.0 name 3", "GNU General Public License v3.0"),
    ("LGPL-2.1 name", "GNU Lesser General Public License, version 2.1"),
    ("LGPL-2.1 name 2", "GNU Lesser General Public License v2.1"),
    ("LGPL-3.0 name", "GNU Lesser General Public License, version 3"),
    ("LGPL-3.0 name 2", "GNU Lesser General Public License v3"),
    ("LGPL-3.0 name 3", "GNU Lesser General Public License v3.0"),
    ("AGPL-3.0 name", "GNU Affero General Public License, version 3"),
    ("AGPL-3.0 name 2", "GNU Affero General Public License v3"),
    ("AGPL-3.0 name 3", "GNU Affero General Public License v3.0"),
    ("GFDL name", "the GNU Free Documentation License"),
    ("CC-BY-4.0 name", "CC BY 4.0 license"),
    ("CC0-1.0 name", "CC0 1.0 Universal Public Domain Dedication"),
    ("CC0-1.0 name 2", "Creative Commons Zero v1.0 Universal"),
    ("CC0-1.0 name 3", "the CC0 1.0 Universal license"),
    ("Unlicense opening", "This is free and unencumbered software released into the public domain."),
)
_CC_PARTS = (("SA", "ShareAlike"), ("NC", "NonCommercial"), ("ND", "NoDerivatives"),
             ("NC-SA", "NonCommercial-ShareAlike"), ("NC-ND", "NonCommercial-NoDerivatives"))
# Identifiers of one or two words stay under five words with the tag.
_SPDX = ("Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "EPL-2.0", "BSL-1.0", "GPL-2.0",
         "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0",
         "CC-BY-NC-4.0", "CC-BY-ND-4.0", "CC-BY-NC-SA-4.0", "CC-BY-NC-ND-4.0")

# The sentence of a GNU notice that names license and version.
_GNU = (("GPL-2.0", "General", "2"), ("GPL-3.0", "General", "3"),
        ("LGPL-2.1", "Lesser General", "2.1"), ("LGPL-3.0", "Lesser General", "3"), ("AGPL-3.0", "Affero General", "3"))
_NOTICES = (
    ("Apache-2.0 notice", """
        Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
        except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to
        in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License
        for the specific language governing permissions and limitations under the License."""),
    ("MPL-2.0 full notice", """
        This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a
        copy of the MPL was not distributed with this file, You can obtain one at
        https://mozilla.org/MPL/2.0/."""),
    ("EPL-2.0 notice", """
        This program and the accompanying materials are made available under the terms of the
        Eclipse Public License 2.0 which is available at"""),
    ("GFDL notice", """
        Permission is granted to copy, distribute and/or modify this document under the terms of
        the GNU Free Documentation License"""),
    ("BSL-1.0 notice", """
        Distributed under the Boost Software License, Version 1.0. (See accompanying file
        LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)"""),
    ("BSD-3-Clause third clause", """
        Neither the name of the copyright holder nor the names of its contributors may be used to
        endorse or promote products derived from this software without specific prior written
        permission."""),
    ("AGPL-3.0 section 13", """
        Notwithstanding any other provision of this License, if you modify the Program, your
        modified version must prominently offer all users interacting with it remotely through a
        computer network (if your version supports such interaction) an opportunity to receive the
        Corresponding Source of your version by providing access to the Corresponding Source from a
        network server at no charge, through some standard or customary means of facilitating
        copying of software."""),
)

_TEXTS = ("0BSD", "Apache-2.0", "Artistic-1.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC0-1.0",
          "GFDL-1.3", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0",
          "Unlicense", "Zlib")


def _templates() -> tuple[tuple[str, str], ...]:
    found = list(OPENINGS)
    opening = {text.lower().rstrip(".") for _, text in OPENINGS}
    for name, phrase in _AFTER_VERB:
        found += [(f"{name} {verb}", f"{verb} {phrase}") for verb in _VERBS
                  if f"{verb} {phrase}".lower() not in opening]
    found += [(f"GPL-3.0 {subject}", f"This {subject} is licensed under the GNU General Public "
                                     "License, version 3.") for subject in _SUBJECTS]
    found += _PHRASES
    for part, words in _CC_PARTS:
        found += [(f"CC-BY-{part}-{version} name", f"CC BY-{part} {version}")
                  for version in ("4.0", "3.0")]
        found += [(f"CC-BY-{part}-4.0 sentence",
                   f"Creative Commons Attribution-{words} 4.0 International"),
                  (f"CC-BY-{part}-3.0 sentence",
                   f"Creative Commons Attribution-{words.replace('Derivatives', 'Derivs')} 3.0 "
                   "Unported")]
    found += [("CC-BY-4.0 sentence", "Creative Commons Attribution 4.0 International"),
              ("CC-BY-3.0 sentence", "Creative Commons Attribution 3.0 Unported")]
    found += [(f"{name} tag", f"SPDX-License-Identifier: {name}") for name in _SPDX]
    for name, words, version in _GNU:
        body = (f"terms of the GNU {words} Public License as published by the Free Software "
                "Foundation")
        found += [(f"{name} or-later notice",
                   f"{body}, either version {version} of the License, or"),
                  (f"{name} only notice", f"{body}, version {version} of the License")]
    found += _NOTICES
    texts = files("citeweave.llm") / "license_texts"
    found += [(f"{name} text", (texts / f"{name}.txt").read_text("utf-8")) for name in _TEXTS]
    return tuple((name, " ".join(text.split())) for name, text in found)


TEMPLATES = _templates()
