"""Licence scan by canonical digests (native).

A text is brought to a canonical form: A-Z lower, copyright lines removed, equivalent
spellings made one, every run of ASCII characters other than letters, digits and
line ends made one blank.  The SHA-256 digest of the whole canonical text is looked up by a
hash join among the digests of known licences, and each canonical line among known
licence notices ("released under the MIT License").  The known licences are
fixed tables (``KNOWN``, ``DIGESTS``), so that side is broadcast; a caller's table of
further texts is joined as Spark chooses.

Defined cases: a null text has a null digest and no licence; an empty one or one of
copyright lines alone has the digest of the empty text, which is no licence;
repeated rows give a row each; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Published licence texts, without their copyright lines.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""
_0BSD = _ISC.replace(""" is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.""", " is hereby granted.")
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
_BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
_BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
KNOWN = {
    "MIT": ["MIT License\n\n" + _MIT, "The MIT License (MIT)\n\n" + _MIT, "The MIT License\n\n" + _MIT, _MIT],
    "ISC": ["ISC License\n\n" + _ISC, _ISC],
    "0BSD": ["BSD Zero Clause License\n\n" + _0BSD, "Zero-Clause BSD\n\n" + _0BSD, _0BSD],
    "BSD-2-Clause": ["BSD 2-Clause License\n\n" + _BSD_HEAD + _BSD_TAIL, _BSD_HEAD + _BSD_TAIL],
    "BSD-3-Clause": ["BSD 3-Clause License\n\n" + _BSD_HEAD + _BSD_THIRD + _BSD_TAIL, _BSD_HEAD + _BSD_THIRD + _BSD_TAIL],
    "Apache-2.0": [_APACHE_NOTICE],
}
# Digests of the canonical forms of longer texts, whole and up to their last terms.
DIGESTS = {
    "Apache-2.0": ["75acde0fb516a7ba4597dfc23680cf78281f7fae7f3b74a78e06ef83c1c375c6",
                   "f9138026e58bdb767e6c6e974637ff9aacbaedf2695e30fef144e5d7d84448ff"],
    "GPL-2.0": ["efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821",
                "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34"],
    "GPL-3.0": ["eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a",
                "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636"],
    "LGPL-2.1": ["4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891",
                 "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4"],
    "LGPL-3.0": ["aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"],
    "MPL-2.0": ["4e3ed3db421caff5beab12d8b5ed5c6f8edb888f5430801b1624448d4d7f04fe"],
    "CC0-1.0": ["96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"],
}
# How notices name licences (SPDX id: names).
NAMES = {
    "MIT": ["MIT License", "MIT"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache 2.0"],
    "GPL-2.0": ["GNU General Public License, version 2", "GPL v2", "GPL-2.0"],
    "GPL-3.0": ["GNU General Public License, version 3", "GPL v3", "GPL-3.0"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "LGPL v2.1", "LGPL-2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "LGPL v3", "LGPL-3.0"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "AGPL v3", "AGPL-3.0"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "MPL-2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License"],
    "BSD-3-Clause": ["BSD 3-Clause License"],
    "ISC": ["ISC License"],
    "0BSD": ["BSD Zero Clause License"],
    "CC0-1.0": ["CC0 1.0"],
    **{f"CC-{k}-4.0": [f"CC {k} 4.0"] for k in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")},
}
# The ids themselves, the GNU ones with their suffixes; a notice of either suffix counts for the id without.
for _id, _names in NAMES.items():
    _ids = [_id, *[_id + s for s in ("+", "-only", "-or-later") if "GPL" in _id]]
    _names += [n for n in _ids if n not in _names]
PHRASES = [f"{before}{verb} under {the}{{}}" for before in ("", "this work is ", "this software is ", "this file is ")
           for verb in ("licensed", "released", "distributed") for the in ("", "the ")] + ["SPDX-License-Identifier: {}"]
# Equivalent spellings, as in the SPDX matching guidelines.
SPELLINGS = {
    "©": "(c)", "&": " and ", "licence": "license", "sub-licens": "sublicens", "non-infring": "noninfring",
    "favour": "favor", "behaviour": "behavior", "organis": "organiz", "acknowledgement": "acknowledgment",
    "whilst": "while", "https:": "http:",
}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COPYRIGHT = (r"^[^a-z0-9\n]*(copyright[ \t]*(\(c\)|[0-9]|:|<|\[)|\(c\)[ \t]*(copyright)?[ \t]*[0-9]|all rights reserved)[^\n]*")
OTHER = r"[\x00-\x09\x0B-/:-`{-\x7F]+"


def canonical(text: Column) -> Column:
    """The canonical form; line ends are kept."""
    out = F.translate(text, UPPER, LOWER)
    for old, new in SPELLINGS.items():
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.regexp_replace(F.regexp_replace(out, "(?md)" + COPYRIGHT, ""), OTHER, " ")


def whole(form: Column) -> Column:
    return F.trim(F.regexp_replace(form, r"[ \n]+", " "))


def text_digests(texts: DataFrame) -> DataFrame:
    """``(digest, license_id)`` of ``(license_id, text)``."""
    return texts.select(F.sha2(whole(canonical(F.col("text"))), 256).alias("digest"), "license_id")


def known_digests(spark) -> DataFrame:
    """``(digest, license_id)`` of the known licences: a few rows, whatever the input."""
    def rows(table: dict[str, list[str]], name: str) -> DataFrame:
        return spark.range(1).select(F.inline(F.array(*[
            F.struct(F.lit(k).alias("license_id"), F.lit(t).alias(name)) for k, ts in table.items() for t in ts])))

    return text_digests(rows(KNOWN, "text")).union(rows(DIGESTS, "digest").select("digest", "license_id")).distinct()


def canonical_notices() -> dict[str, str]:
    """Canonical notice line: SPDX id, built from the phrases and names."""
    def plain(s: str) -> str:
        return " ".join("".join(c if c.isalnum() else " " for c in s.lower()).split())

    return {plain(p.format(n)): k for k, names in NAMES.items() for n in names for p in PHRASES}


def _notices(line_ids: Callable[[Column], Column], lines: Column) -> Column:
    return F.filter(F.transform(lines, lambda x: line_ids(F.trim(x))), lambda k: k.isNotNull())


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts: DataFrame | None = None) -> DataFrame:
    """``(id_col, digest, license_id, n_notices, notices)``, one row per input row.

    ``license_id``: the licence that the entire text is, or null; ``notices``: the licences
    that lines of it name, sorted, once each, with commas between them.  ``texts``:
    ``(license_id, text)`` of further licences; of ids with the same digest the smallest counts.
    """
    told = F.create_map(*[F.lit(x) for pair in sorted(canonical_notices().items()) for x in pair])
    # most lines are no notice: only lines that begin as one does are looked up
    starts = "^(" + "|".join(sorted({n.split(" ")[0] for n in canonical_notices()})) + ") "

    def line_id(line: Column) -> Column:
        return F.when(line.rlike(starts), F.try_element_at(told, line))

    forms = docs.select(F.col(id_col), canonical(F.col(text_col)).alias("_form"))
    rows = forms.select(id_col, F.sha2(whole(F.col("_form")), 256).alias("digest"),
                        _notices(line_id, F.split("_form", "\n", -1)).alias("_ids"))
    known = F.broadcast(known_digests(docs.sparkSession))
    if texts is not None:
        more = text_digests(texts).filter(F.col("digest") != F.sha2(F.lit(""), 256))
        known = known_digests(docs.sparkSession).union(more).groupBy("digest").agg(F.min("license_id").alias("license_id"))
    found = rows.join(known, "digest", "left")
    return found.select(id_col, "digest", "license_id", F.coalesce(F.size("_ids"), F.lit(0)).cast("bigint").alias("n_notices"),
                        F.coalesce(F.array_join(F.array_sort(F.array_distinct("_ids")), ","), F.lit("")).alias("notices"))
