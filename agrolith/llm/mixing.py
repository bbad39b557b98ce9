"""Soft-membership mixing to target weights, by DataFrame and SQL functions alone.

A naive Bayes classifier fitted on all labelled rows gives each document posteriors over domains. Its features are a
few binned statistics of the text and whether the text holds one of the words that tell a domain from the rest.
Document rates r >= 0 are then fitted so that the expected tokens by domain, sum of r * tokens * posterior, match the
targets: projected gradient on the least squares of the misses, whitened by the K x K Gram matrix of the documents
whose rate is not at its bound, in the metric that weighs a document by its tokens, so that the step size is one and a document's rate depends on its posteriors. A
pass is one aggregate of K sums over a table of (tokens, posteriors); nothing grows on the driver.

Defined results: a null text counts as empty and has no tokens; null labels and labels of absent documents are
ignored; domains without a labelled row are left out and the others' targets scaled; without any label all documents
have rate 1; repeated rows and labels count each; an empty table gives no rows; targets that nonnegative rates cannot
reach are met as closely as least squares allows; other columns are ignored, or kept by `thin`.
"""

from __future__ import annotations

import logging
import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpoint_dir, read, steady, unused

#: Domains by label, and the share of tokens that each is to have.
DOMAINS = {"good": "quality = 1 AND toxic = 0", "rough": "quality = 0 AND toxic = 0", "toxic": "toxic = 1"}
TARGETS = {"good": 0.90, "rough": 0.08, "toxic": 0.02}
PASSES, TOLERANCE, STEPS = 30, 1e-6, 14
#: Words that the classifier may look for, found among at most WORD_ROWS labelled rows.
TELLING_WORDS, WORD_ROWS = 16, 3000
BINS = 12
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def binned(share: Column) -> Column:
    """0 for none, then by powers of two up to BINS - 1."""
    return F.when(share <= 0, 0).otherwise(F.least(F.lit(BINS - 1), F.greatest(F.lit(1), F.lit(BINS) + F.floor(F.log2(share))))).cast("int")


def features(text: Column, words: list[str]) -> dict[str, Column]:
    """Token count first; the rest are small integers."""
    chars = F.greatest(F.char_length(text), F.lit(1))
    tokens = F.regexp_count(text, F.lit(WORD_PATTERN))
    found = {
        "upper": binned(F.regexp_count(text, F.lit("[A-Z]")) / chars),
        "marks": binned(F.regexp_count(text, F.lit("[!#$%&*|<>{}=_~^]")) / chars),
        "ends": binned((chars - F.char_length(F.replace(text, F.lit("."), F.lit("")))) / chars),
        "long": F.least(F.lit(BINS - 1), F.floor(chars / F.greatest(tokens, F.lit(1)))).cast("int"),
        "size": F.least(F.lit(BINS - 1), F.floor(F.log2(tokens + 1) * 0.75)).cast("int"),
    }
    if words:
        found["words"] = F.rlike(text, F.lit(rf"(?i)(?:^|[^\p{{L}}])(?:{'|'.join(words)})(?:$|[^\p{{L}}])")).cast("int")
    return {"tokens": tokens.cast("long")} | found


def labelled(labels: DataFrame) -> DataFrame:
    """(_doc, domain number) of usable rows."""
    domain = F.coalesce(*(F.when(F.expr(condition), number) for number, condition in enumerate(DOMAINS.values())))
    return labels.select(labels["doc_id"].cast("long").alias("_doc"), domain.alias("domain")).where("_doc IS NOT NULL AND domain IS NOT NULL")


def telling_words(docs: DataFrame, known: DataFrame) -> list[str]:
    """Words of letters that a domain's documents hold far more often than the others, from a bounded sample."""
    sample = known.orderBy(F.xxhash64("_doc"), "_doc").limit(WORD_ROWS)
    rows = docs.select(docs["doc_id"].cast("long").alias("_doc"), docs["text"].alias("_text")).join(F.broadcast(sample), "_doc")
    words = rows.select("_doc", "domain", F.explode(F.array_distinct(F.split(F.lower("_text"), r"[^\p{L}]+"))).alias("word")).where("length(word) between 4 and 24")
    counts = words.groupBy("word").agg(*(F.count_if(F.col("domain") == n).alias(f"c{n}") for n in range(len(DOMAINS))), F.count(F.lit(1)).alias("n"))
    last = len(DOMAINS) - 1
    best = counts.where(f"c{last} >= 8 AND c{last} >= 0.9 * n").orderBy(F.desc(f"c{last}"), "word").limit(TELLING_WORDS)
    return [row[0] for row in best.select("word").collect()]


def posteriors(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, list[str]]:
    """(row, doc_id, tokens, p array) of every row, and the domains that have labels."""
    checkpoint_dir(docs.sparkSession)
    known = labelled(labels)
    columns = features(F.coalesce(docs["text"], F.lit("")), telling_words(docs, known))
    table = docs.select(F.monotonically_increasing_id().alias("row"), docs["doc_id"].cast("long").alias("doc_id"), *(c.alias(f"f_{n}") for n, c in columns.items())).checkpoint()
    names = [f"f_{n}" for n in columns if n != "tokens"]
    seen = table.join(known, table["doc_id"] == known["_doc"])
    cells = F.explode(F.array(*(F.struct(F.lit(at).alias("feature"), F.col(name).alias("bin")) for at, name in enumerate(names)))).alias("cell")
    counted = seen.select("domain", cells).groupBy("domain", "cell.feature", "cell.bin").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = np.zeros((len(DOMAINS), len(names), BINS))
    for domain, feature, bin_, n in counted:
        counts[domain, feature, bin_] = n
    totals = counts[:, 0, :].sum(axis=1) if names else np.zeros(len(DOMAINS))
    present = [k for k in range(len(DOMAINS)) if totals[k]]
    if not present:
        return table.select("row", "doc_id", F.col("f_tokens").alias("tokens"), F.array().cast("array<double>").alias("p")), []
    logits = []
    for k in present:
        logit = F.lit(math.log(totals[k] / totals.sum()))
        for at, name in enumerate(names):
            cost = np.log((counts[k, at] + 0.5) / (totals[k] + 0.5 * BINS))
            logit = logit + F.element_at(F.lit(cost.tolist()), F.col(name) + 1)
        logits.append(logit)
    scored = table.select("row", "doc_id", F.col("f_tokens").alias("tokens"), F.array(*logits).alias("logits"))
    raised = scored.withColumn("raised", F.transform("logits", lambda x: F.exp(x - F.array_max("logits"))))
    total = F.aggregate("raised", F.lit(0.0), lambda a, x: a + x)
    return raised.withColumn("total", total).select("row", "doc_id", "tokens", F.transform("raised", lambda x: x / F.col("total")).alias("p")), [list(DOMAINS)[k] for k in present]


def fit_rates(table: DataFrame, domains: list[str], wanted: dict[str, float], relative: bool = False) -> tuple[Column, list[float], list[float]]:
    """The rate as an expression over p, the target tokens and the tokens reached.

    table: tokens and p. wanted: shares of all tokens, or with relative the part of each domain's own tokens.
    """
    k = len(domains)
    if not k:
        return F.lit(1.0), [], []
    p = [F.element_at("p", at + 1) for at in range(k)]
    n = F.col("tokens").cast("double")
    gram = table.agg(*(F.sum(n * p[i] * p[j]).alias(f"g{i}_{j}") for i in range(k) for j in range(i, k)), *(F.sum(n * p[i]).alias(f"t{i}") for i in range(k))).first()
    has = np.array([gram[f"t{i}"] or 0.0 for i in range(k)])
    g = np.array([[gram[f"g{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(k)] for i in range(k)])
    if has.sum() <= 0:
        return F.lit(1.0), [0.0] * k, [0.0] * k
    shares = np.array([wanted.get(name, 0.0) for name in domains])
    targets = has * shares if relative else has.sum() * shares / max(shares.sum(), 1e-12)
    whitened = np.linalg.pinv(g, rcond=1e-9)
    rate, reached = F.lit(1.0), has
    for _ in range(PASSES):
        miss = reached - targets
        if np.abs(miss).max() <= TOLERANCE * max(targets.sum(), 1.0):
            break
        step = whitened @ miss
        rate = F.greatest(F.lit(0.0), rate - sum((F.lit(float(step[i])) * p[i] for i in range(k)), F.lit(0.0)))
        at_work = n * (F.col("r") > 0).cast("double")
        moments = [F.sum(at_work * p[i] * p[j]).alias(f"g{i}_{j}") for i in range(k) for j in range(i, k)]
        sums = table.select("tokens", "p", rate.alias("r")).agg(*(F.sum(F.col("r") * n * p[i]).alias(f"m{i}") for i in range(k)), *moments).first()
        reached = np.array([sums[f"m{i}"] or 0.0 for i in range(k)])
        whitened = np.linalg.pinv(np.array([[sums[f"g{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(k)] for i in range(k)]), rcond=1e-9)
    else:
        logging.getLogger(__name__).warning("targets are missed by up to %.6g of %.6g tokens after %d passes", np.abs(reached - targets).max(), targets.sum(), PASSES)
    return rate, targets.tolist(), reached.tolist()


def rates(docs: DataFrame, labels: DataFrame, wanted: dict[str, float] | None = None, relative: bool = False) -> tuple[DataFrame, dict[str, tuple[float, float]]]:
    """(row, doc_id, tokens, p, rate) of every row; per domain its target and reached tokens."""
    table, domains = posteriors(docs, labels)
    table = table.checkpoint()
    rate, targets, reached = fit_rates(table, domains, wanted or TARGETS, relative)
    return table.withColumn("rate", rate), dict(zip(domains, zip(targets, reached, strict=True), strict=True))


def copies(rate: Column, *key: str) -> Column:
    """Whole copies that have the rate as their mean: the fraction is settled by a hash, the same at every run."""
    part = F.pmod(F.xxhash64(*key, F.lit(1)), F.lit(1 << 30)) / float(1 << 30)
    return F.floor(rate + part).cast("int")


def reachable(has: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Shares without repeats: a domain is asked for no more tokens than it has, the whole is scaled to one."""
    asked = np.minimum(has.sum() * shares / max(shares.sum(), 1e-12), has)
    return asked / asked.sum()


def box_rates(table: DataFrame, domains: list[str], wanted: dict[str, float]) -> tuple[Column, dict[str, tuple[float, float, float]]]:
    """Rates in [0, 1], nearest to one by tokens, whose tokens by domain have the reachable shares; and of each domain
    its share wanted, share reachable and share reached.

    The least squares of 1 - rate under these shares have the solution min(1, max(0, 1 + v p)) with v orthogonal to the
    shares, v being the least of a convex function: Newton's steps, the best of STEPS halvings, each from K sums.
    """
    k, n = len(domains), F.col("tokens").cast("double")
    p = [F.element_at("p", at + 1) for at in range(k)]
    has = np.array([x or 0.0 for x in table.agg(*(F.sum(n * x) for x in p)).first()]) if k else np.zeros(0)
    if has.sum() <= 0:
        return F.lit(1.0), {}
    shares = np.array([wanted.get(name, 0.0) for name in domains])
    targets = reachable(has, shares)
    free = np.linalg.svd(targets[None])[2][1:].T
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    raw = lambda v: F.lit(1.0) + sum((F.lit(float(v[i])) * p[i] for i in range(k)), F.lit(0.0))

    def sums(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = raw(v)
        inner = n * ((x > 0) & (x < 1)).cast("double")
        r = F.least(F.lit(1.0), F.greatest(F.lit(0.0), x))
        row = [y or 0.0 for y in table.agg(*(F.sum(r * n * y) for y in p), *(F.sum(w * p[i] * p[j]) for w in (inner, n) for i, j in pairs)).first()]
        grams = np.zeros((2, k, k))
        for which in range(2):
            for at, (i, j) in enumerate(pairs):
                grams[which, i, j] = grams[which, j, i] = row[k + which * len(pairs) + at]
        return np.array(row[:k]), grams[0], grams[1]

    def cost(v: np.ndarray) -> Column:
        x = raw(v)
        return F.sum(n * F.when(x > 1, x - 0.5).when(x > 0, x * x / 2).otherwise(0.0))

    y = np.zeros(k - 1)
    for _ in range(2 * PASSES):
        reached, inner, whole = sums(free @ y)
        if reached.sum() <= 1e-6 * has.sum():
            raise ValueError(f"no rates in [0, 1] give the shares {dict(zip(domains, targets.round(6).tolist(), strict=True))}")
        if np.abs(reached - reached.sum() * targets).max() <= TOLERANCE * reached.sum():
            break
        step = np.linalg.pinv(free.T @ (inner + 1e-3 * whole) @ free) @ (free.T @ reached)
        tried = [y - step * 0.5**half for half in range(STEPS)]
        costs = table.agg(*(cost(free @ z) for z in tried)).first()
        y = tried[int(np.argmin(costs))]
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), raw(free @ y))), dict(zip(domains, zip((shares / shares.sum()).tolist(), targets.tolist(), (reached / reached.sum()).tolist(), strict=True), strict=True))


def thin(docs: DataFrame, labels: DataFrame, wanted: dict[str, float] | None = None) -> DataFrame:
    """The documents that a mixture without repeats keeps, each by a hashed chance of its rate in [0, 1]. The shares
    wanted, reachable and reached of each domain are logged."""
    docs = steady(docs)
    table, domains = posteriors(docs, labels)
    table = table.checkpoint()
    rate, shares = box_rates(table, domains, wanted or TARGETS)
    for name, own in shares.items():
        logging.getLogger(__name__).info("%s: share wanted %.4f, reachable %.4f, reached %.4f", name, *own)
    number = unused("agrolith_row", docs)
    kept = table.where(copies(rate, "doc_id", "row") >= 1).select(F.col("row").alias(number))
    return docs.withColumn(number, F.monotonically_increasing_id()).join(kept, number, "left_semi").drop(number)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted, _ = rates(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return fitted.select("doc_id", "tokens", F.col("p").alias("posteriors"), "rate", copies(F.col("rate"), "doc_id", "row").alias("copies"))
