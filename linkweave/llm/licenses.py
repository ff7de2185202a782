"""License scans: canonical digests of whole texts, hash-joined to the digests of known licences.

The canonical form is lower case without copyright lines, with one spelling for words that licences
spell in several ways, and with one space for each run of anything but letters and digits. A
document's units are its whole text and each of its lines; a unit is a licence if its digest is known.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The wording of public licences and of their usual notices.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
"""
DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n"
#: With a number for each clause or none, and as it is often wrapped: a line that begins with "copyright" is left out.
BSD_CLAUSES = [
    ("Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.", f"Redistributions in binary form must reproduce the above{gap}copyright notice, this list of conditions and the following disclaimer{gap}in the documentation and/or other materials provided with the distribution.", f"Neither the name of the {who} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.")
    for gap in (" ", "\n") for who in ("copyright holder", "copyright holders", "University", "<ORGANIZATION>", "[organization]")
]
BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE {0} AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE {1} OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
BSD_HOLDERS = [("COPYRIGHT HOLDERS", "COPYRIGHT HOLDER"), ("COPYRIGHT HOLDERS", "COPYRIGHT OWNER"), ("COPYRIGHT HOLDERS", "COPYRIGHT HOLDERS"), ("REGENTS", "REGENTS")]
GNU = """This {1} is free software{2} you can redistribute it and/or modify it under the terms of the GNU {0}General Public License as published by the Free Software Foundation{3} either version {4} of the License, or (at your option) any later version.
This {1} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0}General Public License for more details.
You should have received a copy of the GNU {0}General Public License along with this {1}"""
GNU_ENDS = [". If not, see <https://www.gnu.org/licenses/>.", "; if not, see <https://www.gnu.org/licenses/>.", "; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.", "; if not, write to the Free Software Foundation, Inc., 59 Temple Place, Suite 330, Boston, MA 02111-1307 USA"]
GNU_KINDS = [("GPL-2.0", "", 2), ("GPL-3.0", "", 3), ("LGPL-3.0", "Lesser ", 3), ("AGPL-3.0", "Affero ", 3)]
MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
CC = "This work is licensed under {0} Creative Commons {1} 4.0 International License."
CC_VISIT = " To view a copy of this license, visit https://creativecommons.org/licenses/{0}/4.0/"
CC_ENDS = [".", " or send a letter to Creative Commons, PO Box 1866, Mountain View, CA 94042, USA."]
CC_KINDS = [("CC-BY-4.0", "Attribution", "by"), ("CC-BY-SA-4.0", "Attribution-ShareAlike", "by-sa"), ("CC-BY-NC-4.0", "Attribution-NonCommercial", "by-nc"), ("CC-BY-ND-4.0", "Attribution-NoDerivatives", "by-nd")]
NAMES = {
    "MIT": ["MIT License", "MIT"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0"],
    "GPL-2.0": ["GNU General Public License, version 2", "GPL-2.0", "GPLv2"],
    "GPL-3.0": ["GNU General Public License, version 3", "GPL-3.0", "GPLv3"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "LGPL-3.0", "LGPLv3"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "AGPL-3.0", "AGPLv3"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL-2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License", "BSD-2-Clause"],
    "BSD-3-Clause": ["BSD 3-Clause License", "BSD-3-Clause"],
    "ISC": ["ISC License", "ISC"],
    "CC0-1.0": ["CC0 1.0", "CC0-1.0"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"],
}
NOTICES = ["Licensed under {}", "Licensed under the {}", "Released under {}", "Released under the {}", "This work is licensed under {}", "This work is licensed under the {}", "SPDX-License-Identifier: {}"]

#: Lines that name a holder or a year differ from copy to copy.
COPYRIGHT_LINE = r"(?m)^[^\p{L}\p{N}\n]*(copyright|\(c\)|©|all rights reserved)[^\n]*$"
SPELLINGS = [(r"\blicence(s|d|e|es)?\b", "license{}1"), (r"\bsub-licen[cs]e\b", "sublicense"), (r"\bnon-infringement\b", "noninfringement"), (r"https://", "http://"), (r"&", " and ")]
PUNCTUATION = r"[^\p{L}\p{N}\n]+"


def whole_texts() -> list[tuple[str, str]]:
    """(license, text) of entire licences and standard notices of several sentences, but for MIT, ISC and the short Apache notice."""
    out = [(p.stem, p.read_text("utf-8")) for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))]
    for clauses in BSD_CLAUSES:
        for holders in BSD_HOLDERS:
            for key, name, n in (("BSD-2-Clause", "BSD 2-Clause License", 2), ("BSD-3-Clause", "BSD 3-Clause License", 3)):
                for numbered in (True, False):
                    body = BSD_HEAD + "\n".join(f"{i}. {c}" if numbered else c for i, c in enumerate(clauses[:n], 1)) + "\n" + BSD_TAIL.format(*holders)
                    out += [(key, body), (key, f"{name}\n{body}")]
    out += [(k, GNU.format(kind, what, stop, comma, n) + end) for k, kind, n in GNU_KINDS for what in ("program", "library", "software") for stop, comma in ((":", ","), (";", ";")) for end in GNU_ENDS]
    for k, kind, short in CC_KINDS:
        for article in ("a", "the"):
            notice = CC.format(article, kind)
            out += [(k, notice), *((k, notice + CC_VISIT.format(short) + end) for end in CC_ENDS)]
    return list(dict.fromkeys([*out, ("MPL-2.0", MPL)]))


def known_licenses() -> list[tuple[str, str]]:
    """(license, text); a fixed list, whatever the data."""
    full = [("MIT", MIT), ("MIT", f"MIT License\n{MIT}"), ("MIT", f"The MIT License (MIT)\n{MIT}"), ("ISC", ISC + DISCLAIMER), ("ISC", f"ISC License\n{ISC}{DISCLAIMER}"), ("Apache-2.0", APACHE)]
    return full + whole_texts() + [(k, n.format(x)) for k, names in NAMES.items() for x in names for n in NOTICES]


def canonical_lines(text: Column) -> Column:
    """The canonical lines of a text, without the empty ones."""
    c = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "")
    for pattern, to in SPELLINGS:
        c = F.regexp_replace(c, pattern, to.format("$"))
    lines = F.split(F.regexp_replace(c, PUNCTUATION, " "), "\n")
    return F.filter(F.transform(lines, lambda x: F.trim(x)), lambda x: x != "")


def known_digests(spark: SparkSession) -> DataFrame:
    values = ", ".join("('{}', '{}')".format(k, t.replace("\\", "\\\\").replace("'", "\\'")) for k, t in known_licenses())
    known = spark.sql(f"SELECT * FROM VALUES {values} AS t(license, license_text)")
    return known.select("license", F.sha2(F.array_join(canonical_lines(F.col("license_text")), " "), 256).alias("digest")).groupBy("digest").agg(F.min("license").alias("license"))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, text_license, line_licenses, n_license_lines for each document that holds a licence.

    text_license is the licence that the whole text is, or null; line_licenses the sorted licences of
    single lines. Rows that share a doc_id count together. Null and empty texts hold none, nor do
    texts that are nothing but copyright lines. Other columns are ignored.
    """
    lines = docs.select("doc_id", canonical_lines(F.col("text").cast("string")).alias("lines"))
    units = lines.select("doc_id", F.explode(F.concat(
        F.array(F.struct(F.lit(True).alias("whole"), F.array_join("lines", " ").alias("unit"))),
        F.transform("lines", lambda x: F.struct(F.lit(False).alias("whole"), x.alias("unit"))),
    )).alias("u")).select("doc_id", "u.whole", F.sha2(F.col("u.unit"), 256).alias("digest"))
    hits = units.join(F.broadcast(known_digests(docs.sparkSession)), "digest")  # a fixed list of a few hundred rows
    return hits.groupBy("doc_id").agg(
        F.min(F.when(F.col("whole"), F.col("license"))).alias("text_license"),
        F.array_join(F.array_sort(F.collect_set(F.when(~F.col("whole"), F.col("license")))), ",").alias("line_licenses"),
        F.count_if(~F.col("whole")).alias("n_license_lines"),
    )
