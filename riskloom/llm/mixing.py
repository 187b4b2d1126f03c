"""Mixing documents to target shares of domains with soft membership, in DataFrame and SQL functions only.

A naive Bayes classifier fitted on a labelled table gives every document a posterior over domains; a document counts
in each domain with its tokens times its posterior. Rates of documents, never negative, are fitted by projected
gradient descent so that the expected token totals of the domains come as near as possible, in least squares, to
the target shares of the corpus's own size. A step needs from the whole corpus only one total a domain at the
current rates, so an iteration is one aggregation over a narrow table; a document's rate follows from its own
posterior and the list of past steps.

Words go through the classifier as exploded rows joined to a table of hash buckets and summed up per document
before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.session import materialize

#: Hash buckets of words in the classifier: the rows of the table that goes to every task.
BUCKETS = 1 << 15
#: Labelled rows of a domain the classifier is fitted on at most; chosen by a hash of doc_id.
SAMPLE_ROWS = 4000
#: Words that count in full. Of n words more, the evidence counts by the square root of EVIDENCE_WORDS / n: the
#: words of a text depend on each other.
EVIDENCE_WORDS = 40.0
SMOOTHING = 0.5
#: Iterations at most, and the share of the corpus by which domains may miss their targets.
ITERATIONS, TOLERANCE = 60, 1e-5
#: Least share by which a step must lessen the error, and steps between two writes of the rates.
PROGRESS, STEPS_AT_ONCE = 1e-3, 8
#: Target shares of the registered query.
TARGETS = {"en": 0.55, "de": 0.16, "fr": 0.15, "es": 0.11, "toxic": 0.01, "low": 0.02}


def label_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The labelled table: __id and __domain. Bad quality is ``low``, else toxic is ``toxic``, else the language.

    Contradicting labels of one id count as the worse one; ids without a document or language have no row.
    """
    own = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("__id"))
    own = own.agg(F.min("quality").alias("__quality"), F.max("toxic").alias("__toxic"))
    language = docs.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("__id")).agg(F.min("lang").alias("__lang"))
    domain = F.when(F.col("__quality") == 0, "low").when(F.col("__toxic") == 1, "toxic").otherwise(F.col("__lang"))
    return own.join(language, "__id").select("__id", domain.alias("__domain")).where("__domain IS NOT NULL")


def word_buckets(docs: DataFrame, *carried: str) -> DataFrame:
    """One row per word: the carried columns and the word's ``__bucket``; words stand between ASCII white space.

    Doubled white space gives rows with a null bucket, so that a text without words has a row as well.
    """
    spaced = F.coalesce(F.col("text").cast("string"), F.lit(""))
    for code in range(9, 14):
        spaced = F.replace(spaced, F.lit(chr(code)), F.lit(" "))
    each = docs.select(*carried, F.explode(F.split(spaced, " ")).alias("__word"))
    return each.select(*carried, F.when(F.col("__word") != "", F.pmod(F.xxhash64("__word"), F.lit(BUCKETS))).alias("__bucket"))


def fitted(docs: DataFrame, labelled: DataFrame, domains: list[str], rows: int = SAMPLE_ROWS) -> tuple[DataFrame, list[float]]:
    """Log-likelihoods of a word by bucket (columns w0, w1, ...) and the priors of the domains.

    Priors come from all labelled rows, word counts from at most ``rows`` labelled rows a domain.
    """
    known = materialize(labelled.where(F.col("__domain").isin(domains)), "labelled")
    sizes = dict(known.groupBy("__domain").count().collect())  # a row per domain
    sample = known.where("false")
    for domain in domains:
        sample = sample.unionByName(known.where(F.col("__domain") == domain).orderBy(F.xxhash64("__id"), "__id").limit(rows))
    # at most rows * domains ids go to every task
    texts = docs.select(F.col("doc_id").cast("long").alias("__id"), "text").join(F.broadcast(sample), "__id")
    own = [F.count(F.when(F.col("__domain") == d, 1)).alias(f"c{k}") for k, d in enumerate(domains)]
    counts = materialize(word_buckets(texts, "__domain").where("__bucket IS NOT NULL").groupBy("__bucket").agg(*own), "bucket-counts")
    sums = counts.agg(*[F.coalesce(F.sum(f"c{k}"), F.lit(0)) for k in range(len(domains))]).first()
    weights = [F.log((F.col(f"c{k}") + SMOOTHING) / F.lit(float(s + SMOOTHING * BUCKETS))).alias(f"w{k}") for k, s in enumerate(sums)]
    every = docs.sparkSession.range(BUCKETS).withColumnRenamed("id", "__bucket").join(counts, "__bucket", "left").fillna(0)
    total = sum(sizes.values())
    return materialize(every.select("__bucket", *weights), "bucket-weights"), [(sizes.get(d, 0) + 1) / (total + len(domains)) for d in domains]


def posteriors(docs: DataFrame, weights: DataFrame, priors: list[float]) -> DataFrame:
    """__id, __hash, __tokens and __posterior for every distinct pair of a doc_id and a text.

    A text without words has no tokens and the priors as its posterior.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("__id"), F.xxhash64("text").alias("__hash"), "text")
    n = range(len(priors))
    # BUCKETS rows, whatever the size of the corpus
    each = word_buckets(keyed, "__id", "__hash").join(F.broadcast(weights), "__bucket", "left")
    sums = [F.coalesce(F.sum(f"w{k}"), F.lit(0.0)).alias(f"s{k}") for k in n]
    summed = each.groupBy("__id", "__hash").agg(F.count("__bucket").alias("__n"), *sums)
    scale = F.when(F.col("__n") > EVIDENCE_WORDS, F.sqrt(F.lit(EVIDENCE_WORDS) / F.col("__n"))).otherwise(1.0)
    scored = summed.select("__id", "__hash", F.col("__n").alias("__tokens"), *[(F.log(F.lit(p)) + scale * F.col(f"s{k}")).alias(f"s{k}") for k, p in enumerate(priors)])
    top = F.greatest(*[f"s{k}" for k in n])
    odds = scored.select("__id", "__hash", "__tokens", *[F.exp(F.col(f"s{k}") - top).alias(f"s{k}") for k in n])
    total = sum((F.col(f"s{k}") for k in n), F.lit(0.0))
    return odds.select("__id", "__hash", "__tokens", F.array(*[F.col(f"s{k}") / total for k in n]).alias("__posterior"))


def rate(steps: list[list[float]]) -> Column:
    """A document's rate after further steps; each step moves against the gradient, never below 0."""
    value = F.col("__rate")
    for step in steps:
        move = sum((F.lit(d) * F.col("__posterior")[k] for k, d in enumerate(step)), F.lit(0.0))
        value = F.greatest(F.lit(0.0), value - move)
    return value


def fitted_rates(members: DataFrame, targets: list[float]) -> DataFrame:
    """``members`` with ``__rate``, by projected gradient descent on sum((total - target)^2 / mass) over the domains.

    ``mass`` is a domain's total at rate 1. Scaled by a document's tokens the gradient of its rate is its posterior
    times (total - target) / mass, and a step of 1 never overshoots. A domain without mass cannot be moved. The
    descent ends when all targets are met, or when a step no longer brings them nearer (targets out of reach).
    """
    found = members.withColumn("__rate", F.lit(1.0))
    steps: list[list[float]] = []

    def totals() -> list[float]:
        own = [F.coalesce(F.sum(F.col("__now") * F.col("__tokens") * F.col("__posterior")[k]), F.lit(0.0)) for k in range(len(targets))]
        return list(found.withColumn("__now", rate(steps)).agg(*own).first())

    mass = reached = totals()
    whole, before = sum(mass), float("inf")
    for _ in range(ITERATIONS if whole else 0):
        missed = [r - whole * t for r, t in zip(reached, targets, strict=True)]
        error = sum(m * m / own for m, own in zip(missed, mass, strict=True) if own > 0) ** 0.5
        worst = max(abs(m) for m, own in zip(missed, mass, strict=True) if own > 0)
        if worst <= TOLERANCE * whole or error >= before * (1 - PROGRESS):
            break
        before = error
        if len(steps) == STEPS_AT_ONCE:  # written out, so that the expression stays short
            found, steps = materialize(found.withColumn("__rate", rate(steps)), "rates"), []
        steps.append([m / own if own > 0 else 0.0 for m, own in zip(missed, mass, strict=True)])
        reached = totals()
    return found.withColumn("__rate", rate(steps))


def mixture(docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float]) -> tuple[DataFrame, list[str]]:
    """__id, __hash, __tokens, __posterior and __rate for every distinct pair of a doc_id and a text; the domains."""
    domains = list(targets)
    shares = [targets[d] / sum(targets.values()) for d in domains]
    weights, priors = fitted(docs, labelled, domains)
    members = materialize(posteriors(docs, weights, priors), "memberships")
    return fitted_rates(members, shares), domains


def whole_copies() -> Column:
    """The rate rounded up or down by a hash of the document, so that copies sum up to the rates."""
    draw = F.pmod(F.xxhash64("__id", "__hash"), F.lit(1 << 30)) / float(1 << 30)
    return F.floor(F.col("__rate") + draw).cast("long")


def mix(docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float] = TARGETS) -> DataFrame:
    """One row per document row: doc_id, n_tokens, domain (the likeliest), p_<domain>, rate and copies.

    Rows that repeat a doc_id with the same text count once in the totals and all get the same rate. Null and empty
    texts have no tokens and the priors as posterior. A null doc_id is kept. Ties between domains go to the one named
    first. Without labelled rows the priors are uniform; an empty table gives an empty result.
    """
    members, domains = mixture(docs, labelled, targets)
    keys = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("__text"))
    found = keys.join(members, keys["doc_id"].eqNullSafe(members["__id"]) & (keys["__text"] == members["__hash"]))
    names = F.array(*[F.lit(d) for d in domains])
    likeliest = F.element_at(names, F.array_position("__posterior", F.array_max("__posterior")).cast("int"))
    shares = [F.col("__posterior")[k].alias(f"p_{d}") for k, d in enumerate(domains)]
    return found.select("doc_id", F.col("__tokens").alias("n_tokens"), likeliest.alias("domain"), *shares, F.col("__rate").alias("rate"), whole_copies().alias("copies"))


def weighted(docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float] = TARGETS) -> DataFrame:
    """The rows of ``docs`` whose rate is above 0, with all columns and ``mix_rate`` and ``mix_copies``."""
    members, _ = mixture(docs, labelled, targets)
    members = members.where("__rate > 0").select("__id", "__hash", F.col("__rate").alias("mix_rate"), whole_copies().alias("mix_copies"))
    own = [c for c in docs.columns if c not in ("mix_rate", "mix_copies")]
    rows = docs.select(*[F.col(f"`{c}`") for c in own], F.col("doc_id").cast("long").alias("__own"), F.xxhash64("text").alias("__text"))
    found = rows.join(members, rows["__own"].eqNullSafe(members["__id"]) & (rows["__text"] == members["__hash"]))
    return found.select(*[F.col(f"`{c}`") for c in own], "mix_rate", "mix_copies")
