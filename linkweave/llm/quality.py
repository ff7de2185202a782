"""Quality classifier: a sparse ensemble of rules over text statistics.

Shallow boosted trees are grown on a bounded sample of labelled rows; the path to each of their nodes
is a conjunctive rule. Lasso logistic regression over the rules keeps few of them. The kept rules
become one Spark column expression, so that scoring has no Python at all.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that are learnt from at most (the ones with the smallest hash of doc_id).
SAMPLE_ROWS = 10_000
#: A leaf has MIN_LEAF rows at least, or a fortieth of fewer rows.
TREES, DEPTH, MIN_LEAF, SHRINK, LASSO = 24, 3, 20, 0.3, 0.002

NAMES = ["log_chars", "marks", "odd_marks", "capitals", "bars", "shouts", "word_chars", "distinct_words", "repeats", "repeats_apart", "line_words", "distinct_lines"]

Rule = tuple[tuple[str, bool, float], ...]  # (statistic, whether it is over the value, value)


def crc_mod(c: Column, n: int) -> Column:
    """crc32 of the decimal text of c, modulo n."""
    return F.crc32(c.cast("string").cast("binary")) % n


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a text, all whole-text and defined for empty texts. To be taken from a column of words."""
    n, words = F.greatest(F.length(text), F.lit(1)).cast("double"), F.col("__words")
    n_words = F.greatest(F.size(words), F.lit(1)).cast("double")
    lines = F.col("__lines")
    gone = lambda pattern: F.length(F.regexp_replace(text, pattern, ""))
    without = lambda s: F.length(text) - F.length(F.replace(text, F.lit(s), F.lit("")))
    return {
        "log_chars": F.log1p(F.length(text).cast("double")),
        "marks": gone(r"[\p{L}\p{M}\s]+") / n,
        "odd_marks": gone(r"[\p{L}\p{M}\p{N}\s.,;:?'\"()-]+") / n,
        "capitals": gone(r"[^\p{Lu}]+") / n,
        "bars": without("|") / n,
        "shouts": without("!") / n,
        "word_chars": F.length(text) / n_words,
        "distinct_words": F.size(F.array_distinct(words)) / n_words,
        "repeats": F.size(F.filter(words, lambda x, i: (i > 0) & (x == F.get("__words", i - 1)))) / n_words,
        "repeats_apart": F.size(F.filter(words, lambda x, i: (i > 1) & (x == F.get("__words", i - 2)))) / n_words,
        "line_words": n_words / F.greatest(F.size(lines), F.lit(1)),
        "distinct_lines": F.size(F.array_distinct(lines)) / F.greatest(F.size(lines), F.lit(1)).cast("double"),
    }


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with a column s_NAME for each statistic; null texts count as empty."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    wide = docs.withColumns({"__text": t, "__words": F.filter(F.split(t, r"\s+"), lambda x: x != ""), "__lines": F.split(t, "\n")})
    return wide.withColumns({f"s_{k}": c.cast("double") for k, c in statistics(F.col("__text")).items()}).drop("__text", "__words", "__lines")




@dataclass
class RuleModel:
    bias: float
    rules: list[tuple[Rule, float]] = field(default_factory=list)

    def score(self) -> Column:
        """The score as a column over the s_NAME columns."""
        terms = [F.lit(self.bias)]
        for rule, weight in self.rules:
            holds = F.lit(True)
            for name, over, value in rule:
                holds = holds & ((F.col(f"s_{name}") > value) if over else (F.col(f"s_{name}") <= value))
            terms.append(F.when(holds, F.lit(weight)).otherwise(F.lit(0.0)))
        while len(terms) > 1:  # a balanced sum keeps the expression shallow
            terms = [a + b for a, b in zip(terms[::2], terms[1::2], strict=False)] + ([terms[-1]] if len(terms) % 2 else [])
        return 1.0 / (1.0 + F.exp(-terms[0]))

    def predict(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.bias + sum((w * covers(x, r) for r, w in self.rules), np.zeros(len(x))))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))


def covers(x: np.ndarray, rule: Rule) -> np.ndarray:
    ok = np.ones(len(x), bool)
    for name, over, value in rule:
        c = x[:, NAMES.index(name)]
        ok &= (c > value) if over else (c <= value)
    return ok


def grow(x: np.ndarray, r: np.ndarray, rows: np.ndarray, path: Rule, depth: int, least: int, rules: list[Rule], fit: np.ndarray) -> None:
    """A regression tree on the residuals r: adds the path of each node to rules and each leaf's mean to fit."""
    if path:
        rules.append(path)
    best = (1e-9, None, None)
    if depth and len(rows) >= 2 * least:
        total = r[rows].sum()
        for k in range(x.shape[1]):
            order = rows[np.argsort(x[rows, k], kind="stable")]
            v, s = x[order, k], np.cumsum(r[order])
            cut = np.arange(least, len(rows) - least + 1)
            cut = cut[v[cut - 1] < v[np.minimum(cut, len(rows) - 1)]]
            if not len(cut):
                continue
            left = s[cut - 1]
            gain = left**2 / cut + (total - left) ** 2 / (len(rows) - cut) - total**2 / len(rows)
            at = int(np.argmax(gain))
            if gain[at] > best[0]:
                best = (float(gain[at]), k, float((v[cut[at] - 1] + v[cut[at]]) / 2))
    if best[1] is None:
        fit[rows] = r[rows].mean()
        return
    over = x[rows, best[1]] > best[2]
    for side, own in ((False, rows[~over]), (True, rows[over])):
        grow(x, r, own, (*path, (NAMES[best[1]], side, best[2])), depth - 1, least, rules, fit)


def fit_rules(x: np.ndarray, y: np.ndarray, seed: int = 0) -> RuleModel:
    """x: statistics in the order of NAMES; y: 0 or 1. One class or no rows: a constant score."""
    rate = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
    model = RuleModel(float(np.log(rate / (1 - rate))))
    least = max(3, min(MIN_LEAF, len(y) // 40))
    if len(y) < 2 * least or y.min() == y.max():
        return model
    rng, z, rules = np.random.default_rng(seed), np.full(len(y), model.bias), []
    for _ in range(TREES):
        fit = np.zeros(len(y))
        rows = np.flatnonzero(rng.random(len(y)) < 0.7)
        own: list[Rule] = []
        grow(x, y - sigmoid(z), rows, (), DEPTH, least, own, fit)
        rules += own
        z = z + SHRINK * 4 * fit
    rules = list(dict.fromkeys(rules))
    a = np.stack([covers(x, r) for r in rules], 1).astype(float)
    # accelerated proximal gradient; the bias isn't penalised
    a1 = np.c_[np.ones(len(y)), a]
    step = 4.0 * len(y) / np.linalg.norm(a1, 2) ** 2
    w = np.zeros(a1.shape[1])
    w[0] = model.bias
    v, t = w.copy(), 1.0
    for _ in range(600):
        g = v - step * (a1.T @ (sigmoid(a1 @ v) - y)) / len(y)
        new = np.sign(g) * np.maximum(np.abs(g) - step * LASSO, 0)
        new[0] = g[0]
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    return RuleModel(float(w[0]), [(r, float(c)) for r, c in zip(rules, w[1:], strict=True) if c])


def learn_quality(docs: DataFrame, labels: DataFrame, held_out_mod: int = 5, sample_rows: int = SAMPLE_ROWS) -> RuleModel:
    """Learns from labelled documents whose crc32(doc_id) modulo held_out_mod isn't 0.

    Of several labels of a document the highest counts; null labels and ids are passed over. At most
    sample_rows documents are learnt from.
    """
    own = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (crc_mod(F.col("doc_id"), held_out_mod) != 0))
    own = own.groupBy("doc_id").agg(F.max("quality").alias("__label"))
    sample = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # at most sample_rows rows
    got = with_statistics(rows).select("__label", *(f"s_{n}" for n in NAMES)).toPandas()
    return fit_rules(got[[f"s_{n}" for n in NAMES]].to_numpy(float), (got["__label"].to_numpy(float) > 0.5).astype(float))


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, held_out_mod: int = 5) -> DataFrame:
    """docs with held_out, score and predicted in place of any columns of these names.

    Scores come from the text alone. Null texts are scored as empty ones; a null doc_id is not held
    out; repeated rows each get the same score; without usable labels all scores are 0.5.
    """
    model = learn_quality(docs, labels, held_out_mod)
    kept = [c for c in docs.columns if c not in ("held_out", "score", "predicted")]
    return apply_model(set_aside(docs), model, threshold, held_out_mod).select(*(F.col(f"`in_{c}`").alias(c) for c in kept), "score", "held_out", "predicted")


def set_aside(docs: DataFrame) -> DataFrame:
    """docs' columns as in_NAME, so that none clashes, with doc_id and the statistics of text."""
    return with_statistics(docs.select(*(F.col(f"`{c}`").alias(f"in_{c}") for c in docs.columns), "doc_id", "text"))


def apply_model(wide: DataFrame, model: RuleModel, threshold: float, held_out_mod: int) -> DataFrame:
    scored = wide.withColumn("score", model.score()).withColumns({
        "held_out": F.coalesce(crc_mod(F.col("doc_id"), held_out_mod) == 0, F.lit(False)),
        "predicted": F.when(F.col("score") >= threshold, 1).otherwise(0),
    })
    return scored.drop(*(f"s_{n}" for n in NAMES))


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, held_out_mod: int = 5) -> DataFrame:
    """The rows of docs, as they are, that score_quality predicts to be good.

    The row number keeps the filter above the statistics: pushed below them, each rule would work out
    its statistics anew.
    """
    model = learn_quality(docs, labels, held_out_mod)
    wide = set_aside(docs).withColumn("__row", F.monotonically_increasing_id())
    kept = apply_model(wide, model, threshold, held_out_mod).where("predicted = 1 AND __row >= 0")
    return kept.select(*(F.col(f"`in_{c}`").alias(c) for c in docs.columns))
