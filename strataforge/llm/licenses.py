"""Licence scan by canonical digests, in native expressions.

A text is put into canonical form: lower case; copyright lines, "all rights reserved" and comment marks go; equivalent
spellings become one (licence/license, sub-license, non-commercial, "copyright holder(s)" ...); punctuation becomes
space and runs of white space one space. The digest of the whole form is joined with the digests of known licences,
which are known with their usual titles and without. Licence notices that stand as a line of their own, of any length,
are found the same way, line by line; ways to begin one ("this work is licensed under the terms of the ...") are one
spelling.

The constant table of known texts does not depend on the data, so it is broadcast; a table of the caller's is joined as
Spark sees fit. Defined results: null, empty and wordless texts have the digest of the empty form and match nothing; of
several licences of one digest the least name counts; repeated rows are separate rows; an empty table gives an empty
one; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: pairs of equivalent spellings, after lower-casing
SPELLINGS = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sub-license", "sublicense"), ("sub license", "sublicense"),
    ("non-commercial", "noncommercial"), ("non commercial", "noncommercial"), ("merchantibility", "merchantability"),
    ("copyright holder", "copyright owner"), ("copyright holders", "copyright owner"), ("copyright owners", "copyright owner"),
    ("per cent", "percent"), ("organisation", "organization"), ("favour", "favor"), ("acknowledgement", "acknowledgment"),
    ("fulfil", "fulfill"), ("initialise", "initialize"), ("judgement", "judgment"), ("utilisation", "utilization"), ("wilful", "willful"),
)

# fixed values: short licences in full
TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSL-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "Unlicense": """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>""",
    "Apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "WTFPL": """DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE
Version 2, December 2004

Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed.

DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE
TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION

0. You just DO WHAT THE FUCK YOU WANT TO.""",
}

# fixed values: titles that may stand above the texts
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT/Expat License"), "ISC": ("ISC License", "The ISC License"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "0BSD"), "Zlib": ("zlib License", "The zlib License", "The zlib/libpng License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The 2-Clause BSD License", "Simplified BSD License", "FreeBSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The 3-Clause BSD License", "New BSD License", "Modified BSD License"),
    "BSL-1.0": ("Boost Software License - Version 1.0 - August 17th, 2003", "Boost Software License 1.0"), "Unlicense": ("The Unlicense", "Unlicense"),
    "WTFPL": ("WTFPL",),
}

# fixed values: names of licences in notices of one line; the first ones are long enough to stand alone as well
NOTICES = {
    "Apache-2.0": (("Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0 License"), ("Apache 2.0", "Apache 2")),
    "GPL-2.0": (("GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPL v2", "GPLv2", "GPL-2.0"), ("GPL version 2", "GPL 2")),
    "GPL-3.0": (("GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL v3", "GPLv3", "GPL-3.0"), ("GPL version 3", "GPL 3")),
    "LGPL-2.1": (("GNU Lesser General Public License, version 2.1", "GNU LGPL v2.1", "LGPLv2.1", "LGPL-2.1"), ()),
    "LGPL-3.0": (("GNU Lesser General Public License, version 3", "GNU LGPL v3", "LGPLv3", "LGPL-3.0"), ()),
    "AGPL-3.0": (("GNU Affero General Public License, version 3", "GNU AGPL v3", "AGPLv3", "AGPL-3.0"), ()),
    "MPL-2.0": (("Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL-2.0"), ("MPL 2.0",)),
    "MIT": (("MIT License", "MIT/Expat License"), ("MIT", "Expat License")),
    "ISC": (("ISC License",), ("ISC",)),
    "BSD-2-Clause": (("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"), ("BSD-2-Clause",)),
    "BSD-3-Clause": (("BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License"), ("BSD-3-Clause",)),
    "Zlib": (("zlib License",), ("zlib",)),
    "BSL-1.0": (("Boost Software License 1.0", "Boost Software License, version 1.0"), ("BSL-1.0",)),
    "Unlicense": (("The Unlicense",), ("Unlicense",)),
    "CC0-1.0": (("CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero 1.0", "Creative Commons CC0 1.0 Universal"), ("CC0",)),
    "CC-BY-4.0": (("CC BY 4.0", "Creative Commons Attribution 4.0", "Creative Commons Attribution 4.0 International"), ()),
    "CC-BY-SA-4.0": (("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0", "Creative Commons Attribution-ShareAlike 4.0 International"), ()),
    "CC-BY-NC-4.0": (("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0", "Creative Commons Attribution-NonCommercial 4.0 International"), ()),
    "CC-BY-NC-SA-4.0": (("CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International"), ()),
    "CC-BY-ND-4.0": (("CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International"), ()),
    "CC-BY-NC-ND-4.0": (("CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International"), ()),
    "CC-BY-SA-3.0": (("CC BY-SA 3.0", "Creative Commons Attribution-ShareAlike 3.0", "Creative Commons Attribution-ShareAlike 3.0 Unported"), ()),
    "CC-BY-3.0": (("CC BY 3.0", "Creative Commons Attribution 3.0", "Creative Commons Attribution 3.0 Unported"), ()),
}

#: A copyright line names a holder or a year; running text that only begins with the word stays.
_COPYRIGHT_LINE = r"(?m)^[\s/*#;%.-]*+(?:copyright\b(?!\s*(?:holders?|owners?|notices?|licen[cs]es?|laws?|statements?|interests?|permissions?|and|or|in)\b)|\(c\)\s|©)[^\n]*+$"
_RESERVED = r"all rights reserved\.?"
#: How a notice may begin, in canonical form.
_LEAD = (
    r"^(?:(?:spdx )?license(?: identifier)? |(?:(?:this|the|all|our|its|your) )?(?:(?:source |original )?(?:work|software|project|file|code|program|document|documentation|content|text|page|article|library|package|repository|material|dataset|data) )?"
    r"(?:(?:is|are|was) )?(?:also |hereby |made |being )*(?:licensed|released|distributed|published|available|provided|shared|offered|covered|redistributable)(?: to you)? (?:under|by|according to|subject to) )(?:the )?(?:terms (?:and conditions )?of )?(?:the |an? )?"
)
#: What a line must have to be looked at: every known name has one of these.
_TELLING = r"(?i)licen[cs]|\bcc0?\b|creative commons|gpl|apache|mozilla|\bmpl\b|\bmit\b|\bbsd|\bisc\b|\bbsl\b|boost|zlib|expat"


def canonical(text: Column) -> Column:
    """The canonical form of a licence text."""
    t = F.lower(F.coalesce(text, F.lit("")))
    t = F.regexp_replace(F.regexp_replace(t, _COPYRIGHT_LINE, ""), _RESERVED, "")
    # words have a space on either side, so that neighbours don't share one
    t = F.concat(F.lit(" "), F.replace(F.trim(F.regexp_replace(t, r"[^\p{L}\p{N}]++", " ")), F.lit(" "), F.lit("  ")), F.lit(" "))
    for a, b in SPELLINGS:
        a, b = (x.replace("-", " ").replace(" ", "  ") for x in (a, b))
        if a != b:
            t = F.replace(t, F.lit(f" {a} "), F.lit(f" {b} "))
    return F.trim(F.replace(t, F.lit("  "), F.lit(" ")))


def _sha(canon: Column) -> Column:
    return F.sha2(canon.cast("binary"), 256)


def digest(text: Column) -> Column:
    return _sha(canonical(text))


def notice_digest(line: Column) -> Column:
    """The digest of a line's canonical form, in which ways to begin a notice are one."""
    return _sha(F.concat(F.lit("notice "), F.regexp_replace(F.regexp_replace(canonical(line), _LEAD, "under "), " (?:license )?license$", " license")))


def known_licenses(spark: SparkSession, texts: dict[str, str] | None = None) -> DataFrame:
    """(digest, license) of whole texts and of notices; a constant table."""
    whole = [(n, t) for n, t in (texts or TEXTS).items()]
    whole += [(n, f"{title}\n\n{t}") for n, t in whole for title in TITLES.get(n, ())]
    alone = [(n, x) for n, (names, _) in NOTICES.items() for x in names]
    led = [(n, f"licensed under the {x}{tail}") for n, (names, more) in NOTICES.items() for x in (*names, *more) for tail in ("", " license")]
    of = lambda rows, to: F.array(*[F.struct(F.lit(n).alias("license"), F.lit(t).alias("t"), F.lit(to).alias("whole")) for n, t in rows])
    found = spark.range(1).select(F.explode(F.concat(of(whole, True), of(alone + led, False))).alias("x"))
    return found.select("x.license", F.when(F.col("x.whole"), digest(F.col("x.t"))).otherwise(notice_digest(F.col("x.t"))).alias("digest")).groupBy("digest").agg(F.min("license").alias("license"))


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text", known: DataFrame | None = None) -> DataFrame:
    """(key, digest, license, n_notices, notices) of every row: the licence that the whole text is, and notice lines in it.

    ``known`` is a table (digest, license), of unique ``digest`` and ``notice_digest`` values, in place of the constant one.
    """
    known = F.broadcast(known_licenses(docs.sparkSession)) if known is None else known
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key), F.col(text).alias("t"))
    lines = F.filter(F.split(F.coalesce("t", F.lit("")), "\n"), lambda x: x.rlike(_TELLING))
    parts = F.concat(F.array(F.struct(F.lit(True).alias("whole"), F.col("t").alias("x"))), F.transform(lines, lambda x: F.struct(F.lit(False).alias("whole"), x.alias("x"))))
    of_part = F.when(F.col("p.whole"), digest(F.col("p.x"))).otherwise(notice_digest(F.col("p.x")))
    dealt = rows.select("row", key, F.explode(parts).alias("p")).select("row", key, "p.whole", of_part.alias("digest"))
    joined = dealt.join(known, "digest", "left")
    notice = F.when(~F.col("whole"), F.col("license"))
    return joined.groupBy("row", key).agg(
        F.max(F.when(F.col("whole"), F.col("digest"))).alias("digest"), F.max(F.when(F.col("whole"), F.col("license"))).alias("license"),
        F.count(notice).alias("n_notices"), F.array_join(F.sort_array(F.collect_set(notice)), ",").alias("notices"),
    ).drop("row")
