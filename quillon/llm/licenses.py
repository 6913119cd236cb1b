"""License scans by sentence-rule recognition.

A text is cut into sentences, each is normalised and looked up among the sentences of known licences;
what is found is a sequence of identifiers with their places. Ordered rules then match identifier
sequences: a rule's identifiers must follow each other in its order, with no more than GAP sentences
between neighbours, and where rules overlap the one listed first wins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm._ship import ship

#: Sentences that may stand between two neighbours of a rule.
GAP = 2

# Sentences of public licences and notices, by identifier.
SENTENCES: dict[str, tuple[str, ...]] = {
    "mit-name": ("The MIT License", "MIT License", "The MIT License (MIT)"),
    "mit-notice": ("Released under the MIT License", "Licensed under the MIT License", "This software is licensed under the MIT License", "This project is licensed under the MIT License", "SPDX-License-Identifier: MIT"),
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    ),
    "mit-condition": ("The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",),
    "as-is": ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",),
    "apache-2-notice": ("Licensed under the Apache License, Version 2.0", "Licensed under the Apache License, Version 2.0 (the \"License\")", "Licensed under the Apache License 2.0", "Released under the Apache License, Version 2.0", "SPDX-License-Identifier: Apache-2.0"),
    "apache-2-comply": ("you may not use this file except in compliance with the License",),
    "apache-2-obtain": ("You may obtain a copy of the License at",),
    "apache-2-basis": ("Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",),
    "gpl-3-notice": ("This work is licensed under the GNU General Public License, version 3", "Licensed under the GNU General Public License, version 3", "Released under the GNU General Public License, version 3", "SPDX-License-Identifier: GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-or-later"),
    "gpl-2-notice": ("This work is licensed under the GNU General Public License, version 2", "Licensed under the GNU General Public License, version 2", "SPDX-License-Identifier: GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0-or-later"),
    "gpl-free": ("This program is free software",),
    "gpl-3-later": ("you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",),
    "gpl-2-later": ("you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",),
    "lgpl-notice": ("Licensed under the GNU Lesser General Public License, version 3", "SPDX-License-Identifier: LGPL-3.0-only"),
    "bsd-grant": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",),
    "bsd-source": ("Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",),
    "bsd-binary": ("Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",),
    "bsd-endorse": ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",),
    "bsd-3-notice": ("Licensed under the BSD 3-Clause License", "SPDX-License-Identifier: BSD-3-Clause"),
    "bsd-2-notice": ("Licensed under the BSD 2-Clause License", "SPDX-License-Identifier: BSD-2-Clause"),
    "mpl-2-notice": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "SPDX-License-Identifier: MPL-2.0"),
    "isc-grant": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",),
    "unlicense": ("This is free and unencumbered software released into the public domain",),
    "cc-by-nc-4": ("Licensed under CC BY-NC 4.0", "This work is licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    "cc-by-4": ("Licensed under CC BY 4.0", "This work is licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    "cc-by-sa-4": ("Licensed under CC BY-SA 4.0", "This work is licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    "cc0": ("Licensed under CC0 1.0", "Released under CC0 1.0 Universal"),
    "gpl-name": ("GNU General Public License",),
    "gpl-3-title": ("GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",),
    "gpl-2-title": ("GNU GENERAL PUBLIC LICENSE Version 2, June 1991",),
    "gpl-copying": ("Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed",),
    "gpl-warranty": ("This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",),
    "agpl-title": ("GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",),
    "agpl-notice": ("Licensed under the GNU Affero General Public License, version 3", "SPDX-License-Identifier: AGPL-3.0-only", "SPDX-License-Identifier: AGPL-3.0-or-later"),
    "agpl-later": ("it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    "lgpl-title": ("GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",),
    "apache-2-title": ("Apache License Version 2.0, January 2004",),
    "apache-2-terms": ("TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",),
    "epl-2-notice": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0", "SPDX-License-Identifier: EPL-2.0"),
    "bsl-1-title": ("Boost Software License - Version 1.0 - August 17th, 2003", "Distributed under the Boost Software License, Version 1.0", "SPDX-License-Identifier: BSL-1.0"),
    "zlib-as-is": ("This software is provided 'as-is', without any express or implied warranty",),
    "zlib-grant": ("Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions",),
    "wtfpl": ("DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE", "You just DO WHAT THE FUCK YOU WANT TO"),
    "mpl-2-copy": ("If a copy of the MPL was not distributed with this file, You can obtain one at",),
    "cc-by-nd-4": ("Licensed under CC BY-ND 4.0", "This work is licensed under CC BY-ND 4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"),
    "mit-liability": ("IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE",),
    "mit-0-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so",
    ),
    "x11-name": ("Except as contained in this notice, the name of the X Consortium shall not be used in advertising or otherwise to promote the sale, use or other dealings in this Software without prior written authorization from the X Consortium",),
    "bsd-as-is": (
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED",
        "THIS SOFTWARE IS PROVIDED BY THE REGENTS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED",
    ),
    "bsd-liability": (
        "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE",
    ),
    "bsd-advertising": ("All advertising materials mentioning features or use of this software must display the following acknowledgement",),
    "isc-as-is": ("THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS",),
    "isc-liability": (
        "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE",
    ),
    "0bsd-grant": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",),
    "apache-2-limits": ("See the License for the specific language governing permissions and limitations under the License",),
    "zlib-liability": ("In no event will the authors be held liable for any damages arising from the use of this software",),
    "zlib-origin": ("The origin of this software must not be misrepresented; you must not claim that you wrote the original software",),
    "zlib-altered": ("Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software",),
    "zlib-notice": ("This notice may not be removed or altered from any source distribution",),
    "unlicense-free": ("Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means",),
    "bsl-1-grant": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following",
    ),
    "gpl-merchantability": ("without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",),
    "gpl-details": ("See the GNU General Public License for more details",),
    "gpl-copy": ("You should have received a copy of the GNU General Public License along with this program",),
    "lgpl-free": ("This library is free software",),
    "lgpl-2.1-later": ("you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version",),
    "lgpl-3-later": ("you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",),
    "lgpl-2.1-notice": ("Licensed under the GNU Lesser General Public License, version 2.1", "SPDX-License-Identifier: LGPL-2.1-only", "SPDX-License-Identifier: LGPL-2.1-or-later"),
    "agpl-copy": ("You should have received a copy of the GNU Affero General Public License along with this program",),
    "ofl-notice": ("This Font Software is licensed under the SIL Open Font License, Version 1.1", "SPDX-License-Identifier: OFL-1.1"),
    "epl-1-notice": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0", "SPDX-License-Identifier: EPL-1.0"),
    "cddl-notice": ("The contents of this file are subject to the terms of the Common Development and Distribution License (the \"License\")", "SPDX-License-Identifier: CDDL-1.0"),
    "mpl-1.1-notice": ("The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\")", "SPDX-License-Identifier: MPL-1.1"),
    "mpl-1.1-basis": ("Software distributed under the License is distributed on an \"AS IS\" basis, WITHOUT WARRANTY OF ANY KIND, either express or implied",),
    "postgresql-grant": ("Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies",),
    "ms-pl-title": ("Microsoft Public License (Ms-PL)", "SPDX-License-Identifier: MS-PL"),
    "artistic-2-title": ("The Artistic License 2.0", "SPDX-License-Identifier: Artistic-2.0"),
    "eupl-notice": ("Licensed under the EUPL", "Licensed under the EUPL, Version 1.2", "SPDX-License-Identifier: EUPL-1.2"),
    "cc-by-nc-sa-4": ("Licensed under CC BY-NC-SA 4.0", "This work is licensed under CC BY-NC-SA 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    "cc-by-nc-nd-4": ("Licensed under CC BY-NC-ND 4.0", "This work is licensed under CC BY-NC-ND 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"),
}

#: Rules in order of precedence: licence and identifier sequence.
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("X11", ("mit-grant", "mit-condition", "as-is", "x11-name")),
    ("MIT", ("mit-grant", "mit-condition", "as-is", "mit-liability")),
    ("MIT", ("mit-grant", "mit-condition", "as-is")),
    ("MIT-0", ("mit-0-grant", "as-is", "mit-liability")),
    ("MIT-0", ("mit-0-grant", "as-is")),
    ("MIT", ("mit-name", "mit-grant")),
    ("MIT", ("mit-grant", "mit-condition")),
    ("Apache-2.0", ("apache-2-notice", "apache-2-comply", "apache-2-obtain", "apache-2-basis", "apache-2-limits")),
    ("Apache-2.0", ("apache-2-notice", "apache-2-comply", "apache-2-obtain", "apache-2-basis")),
    ("Apache-2.0", ("apache-2-notice",)),
    ("BSD-4-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-advertising", "bsd-endorse", "bsd-as-is", "bsd-liability")),
    ("BSD-4-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-advertising", "bsd-endorse")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-as-is", "bsd-liability")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is", "bsd-liability")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("ISC", ("isc-grant", "isc-as-is", "isc-liability")),
    ("0BSD", ("0bsd-grant", "isc-as-is", "isc-liability")),
    ("0BSD", ("0bsd-grant", "isc-as-is")),
    ("Zlib", ("zlib-as-is", "zlib-liability", "zlib-grant", "zlib-origin", "zlib-altered", "zlib-notice")),
    ("Zlib", ("zlib-as-is", "zlib-liability", "zlib-grant")),
    ("Zlib", ("zlib-as-is", "zlib-grant")),
    ("Unlicense", ("unlicense", "unlicense-free")),
    ("BSL-1.0", ("bsl-1-title", "bsl-1-grant")),
    ("MPL-1.1", ("mpl-1.1-notice", "apache-2-comply", "mpl-1.1-basis")),
    ("CDDL-1.0", ("cddl-notice", "apache-2-comply")),
    ("LGPL-2.1-or-later", ("lgpl-free", "lgpl-2.1-later")),
    ("LGPL-3.0-or-later", ("lgpl-free", "lgpl-3-later")),
    ("AGPL-3.0-or-later", ("gpl-free", "agpl-later", "gpl-warranty", "gpl-merchantability", "agpl-copy")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-3-later", "gpl-warranty", "gpl-merchantability", "gpl-details", "gpl-copy")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl-2-later", "gpl-warranty", "gpl-merchantability", "gpl-details", "gpl-copy")),
    ("AGPL-3.0-or-later", ("gpl-free", "agpl-later")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-3-later", "gpl-warranty")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-3-later")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl-2-later")),
    ("GPL-3.0", ("gpl-3-title", "gpl-copying")),
    ("GPL-2.0", ("gpl-2-title", "gpl-copying")),
    ("AGPL-3.0", ("agpl-title", "gpl-copying")),
    ("LGPL-3.0", ("lgpl-title", "gpl-copying")),
    ("Apache-2.0", ("apache-2-title", "apache-2-terms")),
    ("MPL-2.0", ("mpl-2-notice", "mpl-2-copy")),
    ("AGPL-3.0", ("agpl-notice",)),
    ("EPL-2.0", ("epl-2-notice",)),
    ("BSL-1.0", ("bsl-1-title",)),
    ("WTFPL", ("wtfpl",)),
    ("CC-BY-ND-4.0", ("cc-by-nd-4",)),
    ("GPL-3.0", ("gpl-3-notice",)),
    ("GPL-2.0", ("gpl-2-notice",)),
    ("LGPL-3.0", ("lgpl-notice",)),
    ("BSD-3-Clause", ("bsd-3-notice",)),
    ("BSD-2-Clause", ("bsd-2-notice",)),
    ("MPL-2.0", ("mpl-2-notice",)),
    ("ISC", ("isc-grant",)),
    ("Unlicense", ("unlicense",)),
    ("MIT", ("mit-grant",)),
    ("MIT", ("mit-notice",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4",)),
    ("CC-BY-4.0", ("cc-by-4",)),
    ("CC0-1.0", ("cc0",)),
    ("CC-BY-NC-SA-4.0", ("cc-by-nc-sa-4",)),
    ("CC-BY-NC-ND-4.0", ("cc-by-nc-nd-4",)),
    ("LGPL-2.1", ("lgpl-2.1-notice",)),
    ("OFL-1.1", ("ofl-notice",)),
    ("EPL-1.0", ("epl-1-notice",)),
    ("CDDL-1.0", ("cddl-notice",)),
    ("MPL-1.1", ("mpl-1.1-notice",)),
    ("PostgreSQL", ("postgresql-grant",)),
    ("MS-PL", ("ms-pl-title",)),
    ("Artistic-2.0", ("artistic-2-title",)),
    ("EUPL-1.2", ("eupl-notice",)),
    ("BSL-1.0", ("bsl-1-grant",)),
)

# A sentence ends before white space after . ; : ! ? or at a newline that ends a line with such a mark
# or is followed by a blank line or a comment sign; lines of one sentence are joined first.
_END = re.compile(r"(?<=[.;:!?])\s+|\n")
_NORMAL = re.compile(r"[^a-z0-9]+")


def normalise(sentence: str) -> str:
    return _NORMAL.sub(" ", sentence.lower()).strip()


def _known() -> dict[str, str]:
    """Normalised sentence -> identifier; a sentence of several parts is known by its parts' joining too."""
    return {normalise(s): name for name, forms in SENTENCES.items() for s in forms}


KNOWN = _known()
#: What known sentences begin with, word by word: pieces are joined as long as they are one of these.
BEGINNINGS = frozenset(" ".join(w[:i]) for w in map(str.split, KNOWN) for i in range(1, len(w) + 1))


class Found(NamedTuple):
    """A known sentence: the numbers of its first word-bearing piece and of the one after its last, its place, its identifier."""

    first: int
    after: int
    start: int
    end: int
    name: str


def recognise(text: str) -> list[Found]:
    """The known sentences of a text, in order; of those that begin at one place the longest.

    A sentence may be cut by line breaks or by its own marks: pieces are joined as long as a known
    sentence may still come of them. A piece without words, such as a blank line, ends a sentence.
    """
    pieces, at = [], 0
    for m in _END.finditer(text):
        pieces.append((at, m.start()))
        at = m.end()
    pieces.append((at, len(text)))
    pieces = [(a, b, w) for a, b in pieces for w in [normalise(text[a:b])]]
    number, n = [], 0  # of word-bearing pieces before each
    for *_, w in pieces:
        number.append(n)
        n += w != ""
    number.append(n)
    out, i = [], 0
    while i < len(pieces):
        joined, best, j = pieces[i][2], None, i
        while joined in BEGINNINGS:
            if joined in KNOWN:
                best = (j, KNOWN[joined])
            j += 1
            if j == len(pieces) or not pieces[j][2]:
                break
            joined = f"{joined} {pieces[j][2]}"
        if best:
            j, name = best
            out.append(Found(number[i], number[j] + 1, pieces[i][0], pieces[j][1], name))
            i = j
        i += 1
    return out


def _chain(found: list[Found], used: set[int], i: int, wanted: tuple[str, ...]) -> list[int] | None:
    """The places of wanted's identifiers from i on, each at most GAP sentences after the one before."""
    if i in used or found[i].name != wanted[0]:
        return None
    chain, j = [i], i + 1
    for name in wanted[1:]:
        near = lambda j: j < len(found) and found[j].first - found[chain[-1]].after <= GAP
        while near(j) and (j in used or found[j].name != name):
            j += 1
        if not near(j):
            return None
        chain.append(j)
        j += 1
    return chain


def match_rules(found: list[Found]) -> list[tuple[str, int, int]]:
    """(licence, start, end) of the rules that match, in order of place; each sentence serves one rule."""
    used: set[int] = set()
    out = []
    for licence, wanted in RULES:
        for i in range(len(found)):
            if chain := _chain(found, used, i, wanted):
                used.update(chain)
                out.append((licence, found[chain[0]].start, found[chain[-1]].end))
    return sorted(out, key=lambda x: (x[1], x[2], x[0]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        spans = [[{"license": n, "start": a, "end": b} for n, a, b in match_rules(recognise(t))] if t else [] for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, kind)], names=["doc_id", "spans"])


def scan_licenses(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text, ...) -> (doc_id, spans array<struct<license, start, end>>) of every whole text.

    Positions in code points, end exclusive. Null and empty texts have no spans. Repeated rows are
    scanned as often as they stand; other columns are ignored; an empty table gives no rows.
    """
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_scan, "doc_id long, spans array<struct<license:string,start:int,end:int>>")
