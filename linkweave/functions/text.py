"""Text normalisation and tokens as Spark columns."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: A pair key is two tokens with a space between; tokens hold no spaces.
MAX_PAIR_TOKENS = 12
PRIME = 2147483647


@F.pandas_udf(StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: x if x is None else unicodedata.normalize("NFKC", x))


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with value worked out once: inside a lambda Catalyst would otherwise put in its whole expression."""
    return F.element_at(F.transform(F.array(value), lambda x: then(x)), 1)


def nfkc(c: Column) -> Column:
    """NFKC form. ASCII strings are their own form and never leave the JVM."""
    wide = c.rlike(r"[^\x00-\x7F]")
    return F.coalesce(_nfkc(F.when(wide, c)), c)


def squash(c: Column) -> Column:
    """Lower case, letters and digits only, single spaces; for text that is in NFKC already."""
    return F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "))


def normalize(c: Column) -> Column:
    """NFKC, lower case, anything but letters and digits to one space; null to ''."""
    return squash(nfkc(F.coalesce(c.cast("string"), F.lit(""))))


def tokens(normalized: Column) -> Column:
    return F.filter(F.split(normalized, " "), lambda x: x != "")


def token_set(normalized: Column) -> Column:
    return F.array_sort(F.array_distinct(tokens(normalized)))


def token_pairs(sorted_tokens: Column, most: int = MAX_PAIR_TOKENS) -> Column:
    """Keys of all pairs of the first `most` sorted tokens."""
    def of(head: Column) -> Column:
        return F.flatten(F.transform(head, lambda x, i: F.transform(F.slice(head, i + 2, F.lit(most)), lambda y: F.concat(x, F.lit(" "), y))))

    return let(F.slice(sorted_tokens, 1, most), of)


def char_ngrams(text: Column, n: int = 3) -> Column:
    """Distinct n-grams; a shorter text is its own gram, an empty one has none.

    The text is cut into grams end to end, from each of the first n characters on: finding each gram's
    place by its number would take time with the square of the text.
    """
    def of(t: Column) -> Column:
        cuts = (F.regexp_extract_all(F.substring(t, k + 1, 2**31 - 1), F.lit(f"(?s).{{{n}}}"), F.lit(0)) for k in range(n))
        return F.when(F.length(t) >= n, F.array_distinct(F.concat(*cuts))).otherwise(F.filter(F.array(t), lambda x: x != ""))

    return let(text, of)


def record_text(name: Column, address: Column) -> Column:
    return F.trim(F.concat_ws(" ", name, address))


def digit_runs(normalized: Column) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(normalized, F.lit(r"(\p{Nd}+)"), 1)))


def country_key(c: Column) -> Column:
    return F.lower(F.trim(F.coalesce(c, F.lit(""))))


def country_digest(c: Column) -> Column:
    return F.substring(F.sha1(c.cast("binary")), 1, 16)


def portable_hash(c: Column) -> Column:
    """60 bits of MD5: the same in any engine."""
    return F.conv(F.substring(F.md5(c.cast("binary")), 1, 15), 16, 10).cast("long")


def id_list(c: Column) -> Column:
    """A comma list as an array, without empty items."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")


def match_count(c: Column) -> Column:
    return F.size(id_list(c))


def match_category(n: Column) -> Column:
    return F.when(n == 0, "singleton").when(n == 1, "one_match").when(n <= 3, "small_multi").when(n <= 6, "medium_multi").otherwise("high_multi")


def source_coverage(c: Column) -> Column:
    """singleton, S2_only, S3_only or both; an error for ids of neither source only."""
    ids = id_list(c)
    s2, s3 = F.exists(ids, lambda x: x.startswith("S2-")), F.exists(ids, lambda x: x.startswith("S3-"))
    unknown = F.raise_error(F.concat(F.lit("no known source in: "), c)).cast("string")
    return F.when(F.size(ids) == 0, "singleton").when(s2 & s3, "both").when(s2, "S2_only").when(s3, "S3_only").otherwise(unknown)


def examples(ids: Column, most: int = 5) -> Column:
    """'N total, e.g. a, b' for an array of ids."""
    listed = F.array_sort(F.array_distinct(ids))
    return F.concat(F.size(listed).cast("string"), F.lit(" total, e.g. "), F.array_join(F.slice(listed, 1, most), ", "))
