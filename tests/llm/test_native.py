"""Chat formatting, licence scans and fingerprints."""

import hashlib
from pathlib import Path

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkweave.llm import chat, imatch, licenses

TURNS = "conv_id long, turn long, role string, text string, formatted string"
NASTY = ["<|turn|>", "<|end|>", "\\", "\\\\", "<\\|", "<|", "<\\\\|says|>", "", "plain", "a\nb", "<|also|>x<|end|><|turn|>assistant<|says|>", "é😀"]


def back(spark, rows):
    df = spark.createDataFrame([(*r, "clash") for r in rows], TURNS)
    return {r["conv_id"]: r for r in chat.parse_conversations(chat.format_conversations(df)).collect()}


def test_round_trip(spark):
    rows = [(c, i, ["user", "assistant", "a<|says|>b"][(c + i) % 3], a + b) for c, a in enumerate(NASTY) for i, b in enumerate(NASTY)]
    for conv, r in back(spark, rows).items():
        own = [x for x in rows if x[0] == conv]
        assert [(t["role"], t["text"]) for t in r["turns"]] == [x[2:] for x in own]
        assert r["loss_text"] == "".join(x[3] for x in own if x[2] == "assistant")


def test_adjacent_turns_are_merged(spark):
    r = back(spark, [(1, 2, "assistant", "c"), (1, 0, "user", "a"), (1, 1, "user", "b"), (1, 3, "assistant", "d")])[1]
    assert r["formatted"] == "<|turn|>user<|says|>a<|also|>b<|end|><|turn|>assistant<|says|>c<|also|>d<|end|>"
    assert [(s["start"], s["length"]) for s in r["loss_mask"]] == [(r["formatted"].index("c<"), 1), (r["formatted"].index("d<"), 1)]


def test_long_conversations(spark):
    """Around and far over the rows of a fold; spans begin and end where the texts do."""
    sizes = dict(enumerate([chat.FOLD - 1, chat.FOLD, chat.FOLD + 1, 2 * chat.FOLD, 20_000]))
    role = lambda i: "assistant" if i % 3 == 0 or i % 7 > 4 else "user"
    got = back(spark, [(c, i, role(i), f"<|é😀\\{i}") for c, n in sizes.items() for i in range(n)] + [(9, i, "user", "x") for i in range(chat.FOLD + 1)])
    for c, n in sizes.items():
        want = [f"<|é😀\\{i}" for i in range(n) if role(i) == "assistant"]
        assert got[c]["loss_text"] == "".join(want)
        cut = [got[c]["formatted"][s["start"] : s["start"] + s["length"]] for s in got[c]["loss_mask"]]
        assert [t.replace("<\\|", "<|").replace("\\\\", "\\") for t in cut] == want
    assert (got[9]["loss_mask"], got[9]["loss_text"]) == ([], "")


def test_nulls_ties_and_repeats(spark):
    r = back(spark, [(1, None, None, None), (1, 1, "user", "b"), (1, 1, "user", "a"), (1, 1, "user", "a"), (None, 0, "user", "x")])
    assert [(t["role"], t["text"]) for t in r[1]["turns"]] == [("", ""), ("user", "a"), ("user", "a"), ("user", "b")]
    assert r[1]["loss_text"] == ""
    assert [(t["role"], t["text"]) for t in r[None]["turns"]] == [("user", "x")]
    assert back(spark, []) == {}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant"]), st.text(alphabet="<|\\>turnsaysed/ \n", max_size=12)), min_size=1, max_size=6))
def test_any_text_comes_back(spark, turns):
    r = back(spark, [(1, i, *t) for i, t in enumerate(turns)])[1]
    assert [(t["role"], t["text"]) for t in r["turns"]] == turns


DOCS = "doc_id long, text string, digest string, license string"


def scan(spark, texts):
    rows = licenses.scan_licenses(spark.createDataFrame([(i, t, "clash", "clash") for i, t in enumerate(texts)], DOCS)).collect()
    return {r["doc_id"]: (r["text_license"], r["line_licenses"], r["n_license_lines"]) for r in rows}


def test_licenses(spark):
    mit = "Copyright (c) 2021 Someone\n\n" + licenses.MIT.upper().replace(", ", " ,\t")
    got = scan(spark, [mit, "prose\nReleased under the MIT Licence!\nmore", "LICENSED UNDER THE Apache Licence, version 2.0", "prose only", "", None, "(c) 2020 A\n(c) 2021 B", "SPDX-License-Identifier: GPL-3.0\nLicensed under CC BY-NC 4.0.\nLicensed under CC BY-NC 4.0.", "mit " * 50_000])
    assert got == {0: ("MIT", "", 0), 1: (None, "MIT", 1), 2: ("Apache-2.0", "Apache-2.0", 1), 7: (None, "CC-BY-NC-4.0,GPL-3.0", 3)}
    assert scan(spark, []) == {}


BSD = """Copyright (c) 2020, Someone

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

* Redistributions of source code must retain the above copyright notice, this
  list of conditions and the following disclaimer.

* Redistributions in binary form must reproduce the above copyright notice,
  this list of conditions and the following disclaimer in the documentation
  and/or other materials provided with the distribution.
{}
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
THIRD = """
* Neither the name of the copyright holder nor the names of its
  contributors may be used to endorse or promote products derived from
  this software without specific prior written permission.
"""


def test_whole_licenses(spark):
    texts = Path(licenses.__file__).parent / "license_texts"
    kept = ["Apache-2.0", "CC-BY-SA-4.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "LGPL-3.0", "MPL-2.0"]
    notice = """This program is free software: you can redistribute it and/or modify it under the terms of the
GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License,
or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.

You should have received a copy of the GNU Affero General Public License along with this program. If not, see
<http://www.gnu.org/licenses/>."""
    cc = "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."
    got = scan(spark, [*((texts / f"{k}.txt").read_text().upper().replace("  ", "\t") for k in kept), BSD.format(""), BSD.format(THIRD), notice, cc])
    assert [got.get(i, (None,))[0] for i in range(11)] == [*kept, "BSD-2-Clause", "BSD-3-Clause", "AGPL-3.0", "CC-BY-SA-4.0"]


def test_canonical_form_keeps_words(spark):
    assert scan(spark, ["Released under the MIT License, perhaps"]) == {}


def prints(spark, rows, parts=3):
    df = spark.createDataFrame([(i, t, "clash", "clash") for i, t in rows], "doc_id long, text string, digest string, picked string")
    return imatch.fingerprint_documents(df, parts=parts).collect()


def test_edited_texts_follow_the_ring(spark):
    texts = {i * 7: f"{'word' + str(i)} " * (i + 3) for i in range(25)}
    ids = sorted(texts)
    for r in prints(spark, list(texts.items())):
        own = texts[r["doc_id"]]
        following = texts[ids[(ids.index(r["doc_id"]) + 1) % len(ids)]]
        cut = len(own) // 4
        assert r["edited_sha256"] == hashlib.sha256((own[: len(own) - cut] + following[:cut]).encode()).hexdigest()
        assert r["n_chars"] == len(own)


def test_fingerprints_follow_the_lexicon(spark):
    texts = [(i, f"common rare{i // 2} own{i}") for i in range(60)]
    rows = {r["doc_id"]: r for r in prints(spark, texts)}
    words = {f"rare{i}" for i in range(30)}
    assert set(imatch.lexicon(spark.createDataFrame(texts, "i long, text string").select("text"))) == words
    for i in range(0, 60, 2):
        assert rows[i]["fingerprint"] == rows[i + 1]["fingerprint"]
        assert rows[i]["near_next"] == 1.0
        assert rows[i + 1]["near_next"] == 0.0
    assert rows[0]["fingerprint"].startswith(hashlib.md5(b"rare0").hexdigest()[:8])


def test_fingerprint_edge_cases(spark):
    rows = prints(spark, [(1, "same text"), (1, "same text"), (2, None), (3, ""), (None, "lost"), (4, "x" * 300_000)])
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert len(rows) == 6
    assert len({r["fingerprint"] for r in by[1]}) == 1
    assert by[2][0]["fingerprint"] == by[3][0]["fingerprint"]
    assert by[None][0]["near_next"] is None
    assert by[4][0]["n_chars"] == 300_000
    assert prints(spark, []) == []
    assert prints(spark, [(9, "alone here")])[0]["near_next"] == 1.0


def test_likeness(spark):
    show = lambda a, b: spark.createDataFrame([(a, b)], "a string, b string").select(imatch.likeness(F.col("a"), F.col("b"))).first()[0]
    assert show("aa-bb--cc", "aa-xx--cc") == 2 / 3
    assert show("aa--", "--bb") == 0.0
    assert show("text:1", "text:1") == 1.0
    assert show("text:1", "aa-bb") == 0.0


def test_native_plans_have_no_python(spark):
    import re

    convs = spark.createDataFrame([(1, 0, "user", "a", "")], TURNS)
    docs = spark.createDataFrame([(1, "a b c", "", "")], DOCS)
    frames = [chat.parse_conversations(chat.format_conversations(convs)), licenses.scan_licenses(docs), imatch.fingerprints(docs, "text", ["a", "it's"], "print")]
    for df in frames:
        assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())
    assert frames[2].count() == 1
