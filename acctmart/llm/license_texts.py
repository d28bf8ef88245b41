"""Public license texts and headers that the license scan looks for (fixed values): (license, name, text).

A text that names its version is cut so that the header of another version or of a sister license holds less than 0.8 of its shingles.
"""

from __future__ import annotations

_PERMISSIVE_DISCLAIMER = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE'
    " WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR"
    " COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR"
    " OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,'
    " INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE"
    " DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,"
    " SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR"
    " SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,"
    " WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE"
    " OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
    " following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of"
    " conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,"
    " this list of conditions and the following disclaimer in the documentation and/or other materials provided with the"
    " distribution."
)

FULL_TEXTS = (
    (
        "MIT",
        "mit text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        ' documentation files (the "Software"), to deal in the Software without restriction, including without limitation'
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and"
        " to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above"
        " copyright notice and this permission notice shall be included in all copies or substantial portions of the"
        " Software. " + _PERMISSIVE_DISCLAIMER,
    ),
    ("permissive-disclaimer", "software as is", _PERMISSIVE_DISCLAIMER),
    ("BSD", "bsd conditions", _BSD_CONDITIONS),
    ("BSD", "bsd disclaimer", _BSD_DISCLAIMER),
    ("BSD-2-Clause", "bsd 2 text", f"{_BSD_CONDITIONS} {_BSD_DISCLAIMER}"),
    (
        "BSD-3-Clause",
        "bsd 3 endorsement",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
        " products derived from this software without specific prior written permission.",
    ),
    (
        "BSD-4-Clause",
        "bsd 4 advertising",
        "All advertising materials mentioning features or use of this software must display the following acknowledgement",
    ),
    (
        "ISC",
        "isc text",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS"
        ' PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED'
        " WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,"
        " INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER"
        " IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR"
        " PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "ISC",
        "isc permission",
        "for any purpose with or without fee is hereby granted, provided that the above copyright notice and this"
        " permission notice appear in all copies",
    ),
    (
        "Zlib",
        "zlib text",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held"
        " liable for any damages arising from the use of this software. Permission is granted to anyone to use this software"
        " for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the"
        " following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you"
        " wrote the original software. If you use this software in a product, an acknowledgment in the product documentation"
        " would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not"
        " be misrepresented as being the original software. 3. This notice may not be removed or altered from any source"
        " distribution.",
    ),
    (
        "Unlicense",
        "unlicense dedication",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,"
        " use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any"
        " purpose, commercial or non-commercial, and by any means.",
    ),
    (
        "Unlicense",
        "unlicense interest",
        "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all"
        " copyright interest in the software to the public domain. We make this dedication for the benefit of the public at"
        " large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of"
        " relinquishment in perpetuity of all present and future rights to this software under copyright law.",
    ),
    (
        "BSL-1.0",
        "boost permission",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and"
        ' accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute,'
        " execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties"
        " to whom the Software is furnished to do so",
    ),
    ("BSL-1.0", "boost header", "Distributed under the Boost Software License, Version 1.0."),
    (
        "WTFPL",
        "wtfpl terms",
        "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it"
        " is allowed as long as the name is changed.",
    ),
    (
        "NCSA",
        "ncsa permission",
        'to deal with the Software without restriction, including without limitation the rights to use, copy, modify,'
        " merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the"
        " Software is furnished to do so, subject to the following conditions: Redistributions of source code must retain the"
        " above copyright notice, this list of conditions and the following disclaimers.",
    ),
    (
        "PostgreSQL",
        "postgresql permission",
        "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee,"
        " and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and"
        " the following two paragraphs appear in all copies.",
    ),
    (
        "OFL-1.1",
        "ofl header",
        "This Font Software is licensed under the SIL Open Font License, Version 1.1. This license is copied below, and is"
        " also available with a FAQ at",
    ),
    (
        "Python-2.0",
        "python grant",
        "hereby grants Licensee a nonexclusive, royalty-free, world-wide license to reproduce, analyze, test, perform and/or"
        " display publicly, prepare derivative works, distribute, and otherwise use Python alone or in any derivative version",
    ),
    (
        "CC0-1.0",
        "cc0 dedication",
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to"
        " this software to the public domain worldwide. This software is distributed without any warranty.",
    ),
    (
        "MPL-2.0",
        "mpl header",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not"
        " distributed with this file, You can obtain one at",
    ),
    (
        "EPL-2.0",
        "epl 2 header",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"
        " which is available at",
    ),
    (
        "EPL-1.0",
        "epl 1 header",
        "All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse"
        " Public License v1.0 which accompanies this distribution, and is available at",
    ),
    (
        "CDDL-1.0",
        "cddl header",
        "The contents of this file are subject to the terms of the Common Development and Distribution License (the"
        ' "License"). You may not use this file except in compliance with the License.',
    ),
    ("EUPL-1.2", "eupl header", "Licensed under the EUPL, Version 1.2 or – as soon they will be approved by the European Commission"),
    (
        "Artistic-2.0",
        "artistic header",
        "This is free software; you can redistribute it and/or modify it under the terms of the Artistic License 2.0",
    ),
    (
        "MS-PL",
        "ms-pl acceptance",
        "This license governs use of the accompanying software. If you use the software, you accept this license. If you do"
        " not accept the license, do not use the software.",
    ),
    (
        "GPL",
        "gpl warranty",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied"
        " warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    ),
    (
        "GPL-2.0-only",
        "gpl 2 only header",
        "it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation",
    ),
    *(
        (
            name,
            f"{name.lower()} header",
            f"it under the terms of the GNU {kind}General Public License as published by the Free Software Foundation, either"
            f" version {version} of the License" + (", or" if kind else ""),
        )
        for name, kind, version in (
            ("GPL-2.0-or-later", "", "2"),
            ("GPL-3.0-or-later", "", "3"),
            ("LGPL-2.1-or-later", "Lesser ", "2.1"),
            ("LGPL-3.0-or-later", "Lesser ", "3"),
            ("AGPL-3.0-or-later", "Affero ", "3"),
        )
    ),
    *(
        (
            f"CC-{code}-4.0",
            f"cc {code.lower()} license",
            f"licensed under the Creative Commons {words} 4.0 International License. To view a copy of this license, visit"
            f" http://creativecommons.org/licenses/{code.lower()}/4.0/",
        )
        for code, words in (
            ("BY-SA", "Attribution-ShareAlike"),
            ("BY-ND", "Attribution-NoDerivatives"),
            ("BY-NC", "Attribution-NonCommercial"),
            ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
            ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
        )
    ),
)
