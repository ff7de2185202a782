import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from linkweave.functions import fuzzy
from linkweave.functions import text as T

CASES = [
    ("Apple & Co., Ltd.", "apple co ltd"),
    ("ＡＢＣ　１２３", "abc 123"),
    ("ﬁne №5 ½", "fine no5 1 2"),
    ("école", "école"),
    ("a_b-c/d", "a b c d"),
    (None, ""),
    ("", ""),
    ("  ", ""),
]


def one(spark, c, value="x"):
    return spark.createDataFrame([(value,)], "v string").select(c.alias("out")).first()[0]


def test_normalize(spark):
    rows = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(CASES)], "i int, v string").select("i", T.normalize(F.col("v")).alias("n")).collect()
    assert {r["i"]: r["n"] for r in rows} == {i: b for i, (_, b) in enumerate(CASES)}


def test_normalize_equals_the_character_rule(spark):
    texts = ["Ünïcode—dash", "tab\tand\nline", "x²y³", "Ⅷ roman", "हिन्दी शब्द", "日本語 テキスト", "a.b,c;d"]

    def plain(s):
        s = unicodedata.normalize("NFKC", s).lower()
        return " ".join("".join(c if c.isalnum() else " " for c in s).split())

    rows = spark.createDataFrame([(t,) for t in texts], "v string").select("v", T.normalize(F.col("v")).alias("n")).collect()
    assert {r["v"]: r["n"] for r in rows} == {t: plain(t) for t in texts}


@pytest.mark.parametrize(("text", "want"), [("b a c", ["a b", "a c", "b c"]), ("a", []), ("", [])])
def test_token_pairs(spark, text, want):
    assert one(spark, T.token_pairs(T.token_set(F.col("v"))), text) == want


def test_token_pairs_take_the_first_twelve(spark):
    assert len(one(spark, T.token_pairs(T.token_set(F.col("v"))), " ".join(f"t{i:02}" for i in range(13)))) == 66


@pytest.mark.parametrize(("text", "want"), [("abcd", ["abc", "bcd"]), ("ab", ["ab"]), ("", []), ("aaaa", ["aaa"])])
def test_char_ngrams(spark, text, want):
    assert one(spark, T.char_ngrams(F.col("v")), text) == want


def test_char_ngrams_of_long_and_wide_texts(spark):
    for text in ("𝔘nicode é\nword 𝔘n" * 3, "abcdefghij klm" * 9000):
        assert sorted(one(spark, T.char_ngrams(F.col("v")), text)) == sorted({text[i : i + 3] for i in range(len(text) - 2)})


def test_match_categories_and_coverage(spark):
    rows = spark.createDataFrame([(n,) for n in (0, 1, 2, 3, 4, 6, 7)], "n int").select(T.match_category(F.col("n"))).collect()
    assert [r[0] for r in rows] == ["singleton", "one_match", "small_multi", "small_multi", "medium_multi", "medium_multi", "high_multi"]
    for ids, want in (("", "singleton"), ("S2-1", "S2_only"), ("S3-1", "S3_only"), ("S2-1,S3-1", "both"), (" ,", "singleton")):
        assert one(spark, T.source_coverage(F.col("v")), ids) == want
    with pytest.raises(Exception, match="no known source"):
        one(spark, T.source_coverage(F.col("v")), "X-1")
    assert one(spark, T.match_count(F.col("v")), "S2-1,,S3-2,") == 2


def test_examples(spark):
    assert one(spark, T.examples(F.split("v", ",")), "c,a,b,a") == "3 total, e.g. a, b, c"


def test_fuzzy_scores():
    a, b = "apple technologies pvt ltd", "apple technology private limited"
    assert fuzzy.ratio(a, b) == pytest.approx(0.793103, abs=1e-6)
    assert fuzzy.token_sort(a, b) == pytest.approx(0.793103, abs=1e-6)
    assert fuzzy.ratio("12 4 mg road pune 411001", "mg rd 12 pune 411001") == pytest.approx(0.772727, abs=1e-6)
    assert fuzzy.lcs("abcbdab", "bdcaba") == 4
    assert fuzzy.token_set("a b c", "c b a d") == 1.0
    assert fuzzy.token_set("", "a") == 0.0
    assert fuzzy.partial("abc", "xxabcxx") == 1.0
    assert fuzzy.partial("", "") == 1.0
    assert fuzzy.weighted("abc", "") == 0.0
    assert fuzzy.guarded("", "") == (1.0,) * 5
    assert fuzzy.guarded("", "a") == (0.0,) * 5


def plain_ratio(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row
        row = [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
    return 2 * row[-1] / (len(a) + len(b)) if a or b else 1.0


def plain_partial(a, b):
    a, b = sorted((a, b), key=len)
    return max([plain_ratio(a, b[max(0, s) : s + len(a)]) for s in range(1 - len(a), len(b))], default=0.0)


def test_fuzzy_scores_equal_brute_force():
    rng = random.Random(7)
    for letters in ("ab ", "abcdefgh ", "abcdefghijklmnopqrstuvwxyz0123456789 é"):
        for _ in range(60):
            a, b = ("".join(rng.choice(letters) for _ in range(rng.randint(1, 30))) for _ in range(2))
            if rng.random() < 0.5:
                b = a[rng.randint(0, len(a)) :] + b + a[: rng.randint(0, len(a))]
            order = [" ".join(sorted(x.split())) for x in (a, b)]
            x, y = set(a.split()), set(b.split())
            both, left, right = (" ".join(sorted(z)) for z in (x & y, x - y, y - x))
            ends = [f"{both} {z}".strip() for z in (left, right)]
            as_sets = max([plain_ratio(*ends), *([plain_ratio(both, z) for z in ends] if both else [])])
            if not x or not y or (both and not (left and right)):
                as_sets = float(bool(x and y))
            found = (plain_ratio(a, b), plain_ratio(*order), as_sets, plain_partial(a, b))
            times = max(map(len, (a, b))) / min(map(len, (a, b)))
            apart = 1.0 if both else max(plain_partial(*order) if all(order) else float(order[0] == order[1]), plain_partial(left, right) if left and right else float(left == right))
            scale = 0.6 if times > 8 else 0.9
            weighted = max(found[0], 0.95 * max(found[1:3])) if times < 1.5 else max(found[0], scale * found[3], 0.95 * scale * apart)
            assert fuzzy.guarded(a, b) == pytest.approx((*found, weighted))


def test_fuzzy_function(spark):
    rows = spark.createDataFrame([("abc", "abd"), ("", ""), (None, "x")], "a string, b string").select(fuzzy.fuzzy_scores(F.col("a"), F.col("b")).alias("s")).select("s.*").collect()
    assert rows[0]["ratio"] == pytest.approx(2 / 3)
    assert [tuple(r) for r in rows[1:]] == [(1.0,) * 5, (0.0,) * 5]
