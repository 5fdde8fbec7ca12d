"""Licence scan by canonical digests, in DataFrame code.

A text is brought to a canonical form: lower case, copyright lines dropped, equivalent
spellings made one ("licence", "sub-license", "non-commercial"), web addresses' scheme
dropped, all punctuation and white space made one space. Its SHA-256 is joined with the
digests of known licence texts. Besides the whole text, each of its lines is a text to
be looked up, among known notices and licence texts of one line; lines whose canonical
length no known one has are not hashed, which loses none.

The catalogue is given as rows (id, kind, text) and broadcast while it has at most
MAX_KNOWN entries; Spark chooses the join beyond that. The built-in one has the short
licences of TEXTS and the notices, and of the long ones in DIGESTS the digests alone, as
no more is needed to look a text up; ``catalogue(spark, folder)`` adds whole texts from a
folder of any store, one file each, named by its id (Apache-2.0, GPL-3.0.txt, ...).

Defined results: null, empty and unknown texts have null license_id and no notices;
repeated rows are looked up one by one; an empty table gives no rows; other columns are
not read. If entries share a canonical text, the least id counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.shared import materialise, whole_text

MAX_KNOWN = 100_000

# Known notices and short licence texts.
NOTICES = {
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.", "Released under the Apache License 2.0."),
    "MIT": ("Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the terms of the MIT license."),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License v3.0."),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.",),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License 2.0."),
    "BSD-3-Clause": ("Licensed under the BSD 3-Clause License.", "Released under the BSD License."),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.",),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",),
    "CC0-1.0": ("Released under CC0 1.0.", "Dedicated to the public domain under CC0."),
}
TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    "BSL-1.0": """Boost Software License - Version 1.0 - August 17th, 2003
Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:
The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "Unlicense": """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
For more information, please refer to <https://unlicense.org>""",
    "WTFPL": "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE Version 2, December 2004. Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed. TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION 0. You just DO WHAT THE FUCK YOU WANT TO.",
}
# Length and SHA-256 of the canonical form of whole licence texts that are too
# long to be kept here, as Linux distributions ship them (CC-BY-SA as its legal code).
DIGESTS = {
    "Apache-2.0": (9682, "d316e08195b8847cef2dd2f05620913cbc1dd83414251464eeb435374eadd245"),
    "Artistic-1.0-Perl": (5710, "de5e8896b763918701eb91e7bf8bf81f20a97c9f8dd1cacc44519e47d3462bf8"),
    "CC-BY-SA-4.0": (17343, "9eee7243d1af3273a74046cb66f0634f17c84d07486386c78362042b0e1251cf"),
    "CC0-1.0": (6692, "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    "GFDL-1.2": (19505, "30024246caef3c017b9497c2ef01a85b1af57f2b1ade5120b246bd1c5331aefe"),
    "GFDL-1.3": (21868, "2cdb3890252b5010c82d7172dadd2778bc53e39a621a0c873ab9cbc5bfeab7d1"),
    "GPL-1.0": (11765, "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    "GPL-2.0": (17053, "b866f5427b78991db8012466b32f51c907f5e974fde5129a47372d0d0552e3a1"),
    "GPL-3.0": (33247, "eed166fc9889c99c1d5b1517519d97fae7d8c2e0d1e40accda99cbdf983a48d8"),
    "LGPL-2.0": (23999, "e2c319279ddf282349927826fd110bdb5b471edc3a726a66fe333c8184a4b135"),
    "LGPL-2.1": (25086, "13cd11e9ccd3aae212d64d9b0f62b3a67f21019c6a65212e582b2cbbeb91cb70"),
    "LGPL-3.0": (7104, "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    "MPL-1.1": (22327, "9dfccff8eb978469e4f030a65a8f8c2c8aed4970878c37955fa82022c74f15de"),
    "MPL-2.0": (14266, "0a9e3d32a7f24bf01d16516a5abfba9b19d53f60aef0a720705e0580ea38d942"),
}
#: Equivalent spellings: pattern, replacement, what every match holds; on lower-case text.
SPELLINGS = (
    (r"\b(sub)?-?licen[cs](e[sd]?|ing)\b", "$1licens$2", "licen"),
    (r"\bnon-?\s?commercial", "noncommercial", "commercial"),
    (r"\bnon-?infringement", "noninfringement", "infringement"),
    (r"https?://(www\.)?", "", "://"),
)
COPYRIGHT = r"(?m)^[\x20\t*#/]*+(?:copyright\b|\(c\)|©)[^\n]*$"


def with_lines(df: DataFrame, text: Column, many: bool = True) -> DataFrame:
    """df with lines, the canonical form of a text, its lines kept apart.

    For many texts each step is a projection of its own, and runs a pattern only where the
    text holds what all of its matches hold. For few it is one expression, as the planner
    would put the steps into one and name each of them several times.
    """
    if not many:
        lines = F.regexp_replace(F.lower(text), COPYRIGHT, "")
        for pattern, to, _ in SPELLINGS:
            lines = F.regexp_replace(lines, pattern, to)
        return df.withColumn("lines", F.regexp_replace(lines, r"[^\p{L}\p{N}\n]+", " "))
    out, x = df.withColumn("lines", F.lower(text)), F.col("lines")
    marked = x.contains("copyright") | x.contains("(c)") | x.contains("©")
    out = out.withColumn("lines", F.when(marked, F.regexp_replace(x, COPYRIGHT, "")).otherwise(x))
    for pattern, to, held in SPELLINGS:
        out = out.withColumn("lines", F.when(x.contains(held), F.regexp_replace(x, pattern, to)).otherwise(x))
    return out.withColumn("lines", F.regexp_replace(x, r"[^\p{L}\p{N}\n]+", " "))


def canonical(lines: Column) -> Column:
    return F.trim(F.regexp_replace(lines, r"\s+", " "))


def catalogue(spark: SparkSession, folder: str | None = None) -> DataFrame:
    """(id, kind, text) of the built-in licences, and of a folder's files."""
    rows = [(i, "notice", t) for i, ts in NOTICES.items() for t in ts] + [(i, "text", t) for i, t in TEXTS.items()]
    known = spark.createDataFrame(rows, "id string, kind string, text string")
    if folder is None:
        return known
    name = F.regexp_replace(F.col("_metadata.file_name"), r"\.txt$", "")
    return known.unionByName(spark.read.text(folder, wholetext=True).select(name.alias("id"), F.lit("text").alias("kind"), F.col("value").alias("text")))


def scan(docs: DataFrame, known: DataFrame, digests: dict[str, tuple[int, str]] = DIGESTS) -> DataFrame:
    """One row per document: doc_id, text_digest, license_id, notice_ids (sorted), n_notices."""
    known = with_lines(known, F.col("text"), many=False).select("id", canonical(F.col("lines")).alias("t")).where("t <> ''")
    known = materialise(known, "known")  # else each use below would generate the whole chain again
    known = known.groupBy(F.sha2("t", 256).alias("digest")).agg(F.min("id").alias("id"), F.min(F.length("t")).alias("len"))
    if digests:
        more = known.sparkSession.createDataFrame([(d, i, n) for i, (n, d) in digests.items()], "digest string, id string, len int")
        known = known.unionByName(more).groupBy("digest").agg(F.min("id").alias("id"), F.min("len").alias("len"))
    lengths = known.agg(F.count("*").alias("n"), F.collect_set("len").alias("len")).first()
    keyed = with_lines(docs.select("doc_id", whole_text().alias("text")), F.col("text"))
    keyed = keyed.select("doc_id", canonical(F.col("lines")).alias("whole"), F.split("lines", "\n").alias("lines"))
    fits = lambda c: F.length(c).isin(lengths["len"] or [-1])
    lines = F.filter(F.transform("lines", lambda x: F.trim(x)), fits)
    keyed = keyed.select("doc_id", F.sha2("whole", 256).alias("text_digest"), F.array_sort(F.transform(F.array_distinct(lines), lambda x: F.sha2(x, 256))).alias("found"))
    keyed = materialise(keyed, "digests")  # texts are read once; both branches below start here
    side = F.broadcast(known) if lengths["n"] <= MAX_KNOWN else known
    keyed = keyed.join(side.select(F.col("digest").alias("text_digest"), F.col("id").alias("license_id")), "text_digest", "left")
    none = keyed.where(F.size("found") == 0).select("doc_id", "text_digest", "license_id", F.array().cast("array<string>").alias("notice_ids"))
    some = keyed.where(F.size("found") > 0).select("*", F.explode("found").alias("digest")).join(side, "digest", "left")
    some = some.groupBy("doc_id", "text_digest", "license_id", "found").agg(F.array_sort(F.collect_set("id")).alias("notice_ids"), F.count_if(F.col("digest") == F.col("found")[0]).alias("copies"))
    # Repeated rows fall into one group; as many come out again.
    some = some.select("doc_id", "text_digest", "license_id", "notice_ids", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("col")
    return none.unionByName(some).withColumn("n_notices", F.size("notice_ids"))
