"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier.

1. A lexicon is learned from a bounded sample of labelled training rows: words and word beginnings whose presence
   nearly always means a toxic text.
2. Voters read the lexicon: each lexicon voter fires where one of its entries occurs, pattern voters where entries are
   many or dense.
3. A generative model of two classes estimates how often each voter fires in either class (its accuracies) by
   expectation maximisation over the counts of vote patterns of all training rows; rows with a label keep it.
   Correlations of voters within the classes are estimated from the same counts, and correlated voters count less.
4. A logistic regression on votes, number and density of hits is trained on the posteriors, and shifted so that the
   threshold is the cut that errs least on labelled training rows.

Scores use the text alone.  Null and empty texts fire no voter and get the score of such texts.  Without labelled
toxic training rows there is no lexicon, and every score is 0.  Repeated rows are scored alike.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder import session
from larder.llm import chunks
from larder.llm.common import by_bytes, documents, drop_worker_cache, spans, text_array

#: The lexicon is learned from at most so many labelled training rows of either class, those of the lowest hashes.
SAMPLE_TOXIC, SAMPLE_CLEAN = 4_000, 8_000
PREFIXES = (3, 4, 5, 6, 7, 8)
#: An entry must be in so many sampled texts; of the entries that pass the test, about such a share may be false.
LEAST, FALSE = 4, 0.01
GROUPS = 4
ROUNDS = 8
THRESHOLD = 0.7
_EDGE = re.compile(r"^[\W\d_]+|[\W\d_]+$")


def entries_of(word: str) -> list[str]:
    """Lexicon entries that a chunk between white space can match: its word and the beginnings of that."""
    word = _EDGE.sub("", word.lower())
    return [f"word {word}", *(f"{n} {word[:n]}" for n in PREFIXES if len(word) > n)] if word else []


def _entry_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(entry, n_toxic, n_clean) of texts with labels: in how many texts an entry occurs."""
    for batch in by_bytes(batches, 0, 2 << 20):
        cut = chunks.by_white_space(text_array(batch.column(0)))
        known = [entries_of(v) for v in cut.values]
        counts = Counter(), Counter()
        for a, b, toxic in zip(cut.offsets[:-1], cut.offsets[1:], batch.column(1).to_pylist(), strict=True):
            counts[toxic].update({e for c in np.unique(cut.codes[a:b]) for e in known[c]})
        both = list(counts[0] | counts[1])
        numbers = [pa.array([c[e] for e in both], pa.int64()) for c in (counts[1], counts[0])]
        yield pa.RecordBatch.from_arrays([pa.array(both, pa.string()), *numbers], names=["entry", "n_toxic", "n_clean"])


def _log_chance(p: float) -> Column:
    """A bound of the log chance that of ``a + b`` texts so many are toxic, where a share ``p`` of all sampled ones is."""
    n = F.col("a") + F.col("b")
    part = lambda c, share: F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / (n * share))).otherwise(0.0)
    return F.when(F.col("a") > n * p, -(part("a", p) + part("b", 1 - p))).otherwise(0.0)


def _cut(counts: DataFrame, chance: Column) -> float:
    """The log chance up to which about ``FALSE`` of the entries are false (Benjamini and Hochberg)."""
    # chances that reach no more than one in e are never below the cut; a row per rounded chance of the bounded sample's entries
    by_chance = counts.groupBy(F.round(chance, 6).alias("c")).agg(F.count("*").alias("n"))
    found = by_chance.agg(F.sum("n").alias("all"), F.sort_array(F.collect_list(F.when(F.col("c") < -1, F.struct("c", "n")))).alias("rows")).first()
    upto, cut = 0, -math.inf
    for r in found["rows"]:
        upto += r.n
        if r.c <= math.log(FALSE * upto / found["all"]):
            cut = r.c
    return cut


def learn_lexicon(docs: DataFrame, labels: DataFrame) -> list[str]:
    """All entries that nearly only toxic texts have, more than chance explains, best first; labels are (doc_id, toxic).

    Their number is bounded by the sample alone.
    """
    of_class = lambda c, most: labels.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    # at most SAMPLE_TOXIC + SAMPLE_CLEAN rows may be broadcast
    sample = F.broadcast(of_class(1, SAMPLE_TOXIC).union(of_class(0, SAMPLE_CLEAN)))
    texts = docs.select("doc_id", "text").join(sample, "doc_id").select("text", F.col("toxic").cast("int"))
    counts = texts.mapInArrow(_entry_counts, "entry string, n_toxic long, n_clean long").groupBy("entry").agg(F.sum("n_toxic").alias("a"), F.sum("n_clean").alias("b"))
    n = sample.agg(F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("toxic") == 0).alias("clean")).first()
    if not n.toxic:
        return []
    counts = session.materialise(counts.filter(F.col("a") + F.col("b") >= LEAST), "toxicity-entries")
    share = (F.col("a") + 0.5) / (n.toxic + 1), (F.col("b") + 0.5) / (n.clean + 1)
    chance = _log_chance(n.toxic / (n.toxic + n.clean + 1))
    good = counts.filter((F.col("a") >= LEAST) & (share[0] > 20 * share[1]) & (F.round(chance, 6) <= _cut(counts, chance)))
    worth = F.log(share[0] / share[1]) * F.sqrt("a")
    # at most the entries of SAMPLE_TOXIC and SAMPLE_CLEAN texts
    ranked = good.agg(F.sort_array(F.collect_list(F.struct((-worth).alias("w"), "entry"))).alias("all")).first()
    return [r.entry for r in ranked["all"]]


def voters_of(lexicon: list[str]) -> dict[str, int]:
    """The lexicon voter of each entry: by kind of entry, and in turns by rank."""
    kinds = ("word", *map(str, PREFIXES))
    seen: Counter = Counter()
    out = {}
    for entry in lexicon:
        kind = kinds.index(entry.split(" ")[0])
        out[entry] = kind * GROUPS + seen[kind] % GROUPS
        seen[kind] += 1
    return out


LEXICON_VOTERS = (1 + len(PREFIXES)) * GROUPS
#: Pattern voters: at least so many chunks with an entry, at least such a share of all chunks.
MANY, DENSE = (2, 3, 5), (0.002, 0.01)
VOTERS = LEXICON_VOTERS + len(MANY) + len(DENSE)


def cast_votes(docs: DataFrame, lexicon: list[str], keep: str = "doc_id") -> DataFrame:
    """(kept column, votes, hits, n_words): a bit for each voter that fires, chunks with an entry, chunks.

    A kept column that is named like one of these comes back as ``kept_<name>``.
    """
    voter, out = voters_of(lexicon), f"kept_{keep}" if keep in ("votes", "hits", "n_words") else keep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_worker_cache()
        for batch in by_bytes(batches, 1, 2 << 20):
            cut = chunks.by_white_space(text_array(batch.column(1)))
            bits = np.zeros(len(cut.values), np.int64)
            empty = np.zeros(len(cut.values), bool)
            for n, value in enumerate(cut.values):
                empty[n] = not value
                for entry in entries_of(value):
                    if entry in voter:
                        bits[n] |= 1 << voter[entry]
            of_chunk = bits[cut.codes]
            upto = lambda x: spans(x)[cut.offsets]  # noqa: B023, E731
            hits, words = np.diff(upto(of_chunk != 0)), np.diff(upto(~empty[cut.codes]))
            votes = np.zeros(len(batch), np.int64)
            hit = np.flatnonzero(of_chunk)
            np.bitwise_or.at(votes, np.searchsorted(cut.offsets, hit, "right") - 1, of_chunk[hit])
            patterns = [hits >= m for m in MANY] + [hits >= np.maximum(1, d * words) for d in DENSE]
            for n, fired in enumerate(patterns):
                votes |= fired.astype(np.int64) << (LEXICON_VOTERS + n)
            columns = [batch.column(0), pa.array(votes), pa.array(hits.astype(np.int64)), pa.array(words.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=[out, "votes", "hits", "n_words"])

    schema = T.StructType([T.StructField(out, docs.schema[keep].dataType), *(T.StructField(c, T.LongType()) for c in ("votes", "hits", "n_words"))])
    return docs.select(keep, "text").mapInArrow(run, schema)


def _bit(voter: int) -> Column:
    return F.shiftright("votes", voter).bitwiseAND(F.lit(1).cast("long"))


def _logit(bias: float, weights: list[float]) -> Column:
    total = F.lit(bias)
    for voter, weight in enumerate(weights):
        total = total + F.lit(weight) * _bit(voter)
    return total


def _sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.least(x, F.lit(40.0)), F.lit(-40.0))))


@dataclass
class LabelModel:
    """Shares of fired voters in toxic and clean texts, the toxic share of all, and each voter's weight."""

    prior: float = 0.1
    toxic: list[float] = field(default_factory=lambda: [0.5] * VOTERS)
    clean: list[float] = field(default_factory=lambda: [0.01] * VOTERS)
    weight: list[float] = field(default_factory=lambda: [1.0] * VOTERS)

    def posterior(self) -> Column:
        bias, weights = math.log(self.prior / (1 - self.prior)), []
        for a, b, w in zip(self.toxic, self.clean, self.weight, strict=True):
            bias += w * math.log((1 - a) / (1 - b))
            weights.append(w * (math.log(a / b) - math.log((1 - a) / (1 - b))))
        return _sigmoid(_logit(bias, weights))


def fit_label_model(patterns: DataFrame, rounds: int = ROUNDS) -> LabelModel:
    """Expectation maximisation over (votes, toxic, n): every round is one aggregation to two numbers a voter."""
    model = LabelModel()
    clip = lambda x: min(max(x, 1e-4), 1 - 1e-4)

    def weighted() -> DataFrame:
        p = F.coalesce(F.col("toxic").cast("double"), model.posterior())
        return patterns.select("*", (p * F.col("n")).alias("t"), ((1 - p) * F.col("n")).alias("c"))

    for _ in range(rounds):
        t, c = _fired(weighted(), 1)
        if not t[-1] and not c[-1]:
            return model
        model.prior = clip((t[-1] + 1) / (t[-1] + c[-1] + 2))
        model.toxic = [clip((t[v] + 0.1) / (t[-1] + 0.2)) for v in range(VOTERS)]
        model.clean = [clip((c[v] + 0.01) / (c[-1] + 0.2)) for v in range(VOTERS)]
    model.weight = _independence(weighted(), model)
    return model


def _fired(weighted: DataFrame, together: int) -> tuple[Counter, Counter]:
    """Weights of either class by voter that fires, or by pair ``i * VOTERS + j`` of voters; at -1 the whole weight.

    At most a row for each voter, or pair of voters, leaves the tasks.
    """
    fired = F.filter(F.sequence(F.lit(0), F.lit(VOTERS - 1)), lambda v: F.call_function("shiftright", F.col("votes"), v).bitwiseAND(F.lit(1).cast("long")) == 1)
    if together == 2:
        fired = F.flatten(F.transform(fired, lambda i: F.transform(F.filter(fired, lambda j: j > i), lambda j: i * VOTERS + j)))
    rows = weighted.select(F.explode(F.concat(F.array(F.lit(-1)), fired)).alias("v"), "t", "c")
    sums = rows.groupBy("v").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    # one row per voter or pair of voters
    found = sums.agg(F.collect_list(F.struct("v", "t", "c")).alias("all")).first()["all"]
    return Counter({r.v: r.t for r in found}), Counter({r.v: r.c for r in found})


def _independence(weighted: DataFrame, model: LabelModel) -> list[float]:
    """One over the number of voters that each voter stands for: itself, and others as far as they correlate with it in a class."""
    sums = _fired(weighted, 2)
    whole = max(sums[0][-1] + sums[1][-1], 1e-9)
    shared = np.zeros((VOTERS, VOTERS))
    for both, share in zip(sums, (model.toxic, model.clean), strict=True):
        total = max(both[-1], 1e-9)
        for i in range(VOTERS):
            for j in range(i + 1, VOTERS):
                spread = math.sqrt(share[i] * (1 - share[i]) * share[j] * (1 - share[j]))
                shared[i, j] += both[-1] / whole * max(0.0, (both[i * VOTERS + j] / total - share[i] * share[j]) / spread)
    shared += shared.T
    return [float(1 / (1 + s)) for s in np.minimum(shared, 1).sum(axis=1)]


@dataclass
class Model:
    """A lexicon and a linear classifier over its votes, the number of hits and their density."""

    lexicon: list[str]
    labels: LabelModel
    bias: float = -40.0
    weights: list[float] = field(default_factory=list)

    def score(self) -> Column:
        """The score of a row of votes, 0 to 1."""
        if not self.lexicon:
            return F.lit(0.0)
        rest = F.lit(self.weights[VOTERS]) * _many() + F.lit(self.weights[VOTERS + 1]) * _density()
        return _sigmoid(_logit(self.bias, self.weights[:VOTERS]) + rest)


def _many() -> Column:
    return F.log1p(F.least(F.col("hits"), F.lit(20)).cast("double"))


def _density() -> Column:
    return F.least(F.lit(1.0), F.lit(20.0) * F.col("hits") / F.greatest("n_words", F.lit(1)))


def fit_classifier(rows: DataFrame, lexicon: list[str], labels: LabelModel) -> Model:
    """Logistic regression on posteriors: equal feature vectors are one row, weighted by how much of either class they are."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    features = F.array(*[_bit(v).cast("double") for v in range(VOTERS)], _many(), F.round(_density(), 3))
    p = labels.posterior()
    grouped = rows.groupBy(features.alias("x")).agg(F.sum(p).alias("t"), F.sum(1 - p).alias("c"))
    both = F.inline(F.array(F.struct(F.lit(1.0).alias("label"), F.col("t").alias("weight")), F.struct(F.lit(0.0).alias("label"), F.col("c").alias("weight"))))
    train = session.materialise(grouped.select("x", both), "toxicity-training").select(array_to_vector("x").alias("features"), "label", "weight")
    fitted = LogisticRegression(weightCol="weight", regParam=1e-4, maxIter=50, standardization=False).fit(train)
    return Model(lexicon, labels, float(fitted.intercept), [float(w) for w in fitted.coefficients])


def calibrated(model: Model, rows: DataFrame) -> Model:
    """The model shifted so that ``THRESHOLD`` is the cut that errs least on labelled rows; a clean text lost counts twice.

    The cut lies midway between two neighbouring scores; scores are read as at most 1,001 distinct values.
    """
    score = F.round(model.score(), 3)
    by_score = rows.filter("toxic is not null").groupBy(score.alias("s")).agg(F.sum("toxic").alias("t"), F.count("*").alias("n"))
    # one row per score, 1,001 at most
    counts = by_score.agg(F.sort_array(F.collect_list(F.struct("s", "t", "n"))).alias("all")).first()["all"]
    best, missed, lost = None, 0, sum(r.n - r.t for r in counts)
    for low, high in zip(counts[:-1], counts[1:], strict=True):
        missed, lost = missed + low.t, lost - (low.n - low.t)
        found = (missed + 2 * lost, low.s - high.s, (low.s + high.s) / 2)
        best = min(best or found, found)
    if best:
        cut = min(max(best[2], 0.001), 0.999)
        model.bias += math.log(THRESHOLD / (1 - THRESHOLD)) - math.log(cut / (1 - cut))
    return model


def held_out(key: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.crc32(key.cast("string").cast("binary")) % 3 == 1


def fit_and_vote(docs: DataFrame, labels: DataFrame) -> tuple[Model, DataFrame]:
    """A model learned from the training rows of ``docs``, and the votes of all its rows."""
    usable = labels.filter(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    lexicon = learn_lexicon(docs, usable)
    votes = session.materialise(cast_votes(docs, lexicon), "toxicity-votes")
    if not lexicon:
        return Model([], LabelModel()), votes
    # null ids have no label and no place in the split: they are scored only
    training = votes.filter(~held_out(F.col("doc_id"))).join(usable, "doc_id", "left")
    patterns = session.materialise(training.groupBy("votes", "toxic").agg(F.count("*").alias("n")), "toxicity-patterns")
    return calibrated(fit_classifier(training, lexicon, fit_label_model(patterns)), training), votes


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of all rows."""
    model, votes = fit_and_vote(docs, labels)
    rows = votes.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), model.score().alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def _query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {"op5_toxicity": _query}
