"""Toxicity by weak supervision (operator 7).

Voters: lexicons of words and word beginnings that mark toxic texts among the labelled rows, one for each
kind and step of precision, and patterns of writing. Each voter says toxic, clean or nothing. A generative label
model, fitted by expectation maximisation to the counts of all vote vectors, estimates the accuracy of
each voter, anchored by the labelled rows; voters that still agree beyond their accuracies, given the label, are correlated, and share
one voice. A linear classifier is then trained on the posterior labels and scores every text.

Labels are learned only from rows whose crc32(id as text) mod 4 is not 2, and no score depends on a
label, a language, a source or an id. Two bounded samples are used, both documented parameters: labelled
rows for the lexicons, rows with posterior labels for the classifier. Vote vectors are counted over all
texts outside the held-out part.

Defined results: a null, empty or wordless text has no votes but "clean" and gets a low score; without
any toxic label there is no lexicon and every score is 0; texts of any length are read whole; repeated
rows each get a row, null ids belong to no split (not held out, and never labelled); an empty table gives
no rows. Only the columns named as parameters are read; `clean_documents` returns all columns.
"""

from __future__ import annotations

import bisect
import functools
import itertools
import sys
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .pretokens import Lookup
from .support import keep, let, text_key, without, workers_find_package

_WORD = regex.compile(r"\p{L}+")


@dataclass(frozen=True)
class Supervision:
    labelled_rows: int = 40_000  # at most about so many labelled rows: four fifths make the lexicons, one anchors
    classifier_rows: int = 40_000  # at most so many rows train the classifier
    start_vectors: int = 20_000  # most frequent vote vectors that the label model starts from
    #: Lower bounds (95 %) of the toxic share among a term's texts: one lexicon per kind of term and step.
    precision: tuple[float, ...] = (0.55, 0.65, 0.8, 0.9)
    correlated: float = 0.3  # correlation given the label from which voters share a voice
    threshold: float = 0.3

    @property
    def lists(self) -> int:
        return len(self.precision)


KINDS = ("word", "start6", "start5", "start4")
PATTERNS = ("shouting", "exclaiming", "repeating", "nothing found")


@functools.lru_cache(maxsize=1)
def _kinds_of_characters() -> np.ndarray:
    """Per code point: 1 for a letter, 3 for a capital one."""
    return np.array([c.isalpha() + 2 * (c.isalpha() and c.isupper()) for c in map(chr, range(sys.maxunicode + 1))], dtype=np.uint8)


def letters(text: str) -> tuple[int, int]:
    """How many letters a text has, and how many of them are capital; by blocks, so in bounded memory."""
    if text.islower():
        return 1, 0  # has letters, none of them capital
    kinds, counts = _kinds_of_characters(), np.zeros(4, dtype=np.int64)
    for at in range(0, len(text), 1 << 16):
        block = np.frombuffer(text[at : at + (1 << 16)].encode("utf-32-le", "surrogatepass"), dtype="<u4")
        counts += np.bincount(kinds[block], minlength=4)
    return int(counts[1] + counts[3]), int(counts[3])


def terms_of(word: str) -> list[str]:
    """The terms a word can match: itself and its beginnings, by kind."""
    out = [f"0{word}"]
    return out + [f"{k}{word[:n]}" for k, n in ((1, 6), (2, 5), (3, 4)) if len(word) > n]


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def mined(labelled: DataFrame, rule: Supervision) -> dict[str, int]:
    """Terms that mark toxic texts and the list each belongs to; `labelled` has text and toxic.

    Whole words first, then beginnings of words that are not in the lexicon yet: a beginning has to earn
    its place by other words than those.
    """
    words = _mined(labelled, rule, {}, slice(0, 1))
    return {**words, **_mined(labelled, rule, words, slice(1, None))}


def _mined(labelled: DataFrame, rule: Supervision, known_terms: dict[str, int], kinds: slice) -> dict[str, int]:
    def of_chunk(chunk: str) -> tuple[str, ...]:
        words = (w for w in _WORD.findall(chunk) if f"0{w}" not in known_terms)
        return tuple(t for w in words for t in terms_of(w) if int(t[0]) in range(len(KINDS))[kinds])

    def count(batches):
        known = Lookup(of_chunk, 150_000)
        for batch in batches:
            texts, labels = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            seen = Counter()
            for text, toxic in zip(texts, labels):
                found = set(itertools.chain.from_iterable(map(known.__getitem__, (text or "").lower().split())))
                seen.update((t, bool(toxic)) for t in found)
            terms = list({t for t, _ in seen})
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.string()), pa.array([seen[t, True] for t in terms], pa.int64()),
                 pa.array([seen[t, False] for t in terms], pa.int64())], names=["term", "toxic", "clean"],
            )

    workers_find_package(labelled.sparkSession)
    counts = labelled.mapInArrow(count, "term string, toxic long, clean long")
    totals = labelled.agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")).first()
    if not totals.toxic or not totals.clean:
        return {}
    n, z = F.col("toxic") + F.col("clean"), 1.96
    share = F.col("toxic") / n
    spread = z * F.sqrt(share * (1 - share) / n + z * z / (4 * n * n))
    bound = (share + z * z / (2 * n) - spread) / (1 + z * z / n)
    best = (
        counts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .withColumn("bound", bound).where((F.col("toxic") > 0) & (F.col("bound") >= rule.precision[0]))
        .orderBy("term").collect()  # only terms of several toxic texts of the bounded sample get that far
    )
    return {r.term: int(r.term[0]) * rule.lists + bisect.bisect(rule.precision, r.bound) - 1 for r in best}


def features(docs: DataFrame, id_col: str, text_col: str, lexicon: dict[str, int], rule: Supervision) -> DataFrame:
    """Per row: id, text_key, the votes as text and the classifier's inputs."""
    n_lists = len(KINDS) * rule.lists
    broadcast = docs.sparkSession.sparkContext.broadcast(lexicon)  # terms of a bounded sample
    workers_find_package(docs.sparkSession)

    def lists_of(terms: dict[str, int]):
        def of_chunk(chunk: str) -> tuple[int, ...]:
            # One term a word: the word itself, else its longest beginning.
            found = (next((terms[t] for t in terms_of(w) if t in terms), None) for w in _WORD.findall(chunk))
            return tuple(k for k in found if k is not None)

        return Lookup(of_chunk, 200_000)

    def describe(batches):
        known = lists_of(broadcast.value)
        for batch in batches:
            votes, inputs = [], []
            for text in batch.column(1).to_pylist():
                text = text or ""
                chunks = text.lower().split()
                hits = Counter(itertools.chain.from_iterable(filter(None, map(known.__getitem__, chunks))))
                n = max(1, len(chunks))
                n_letters, n_capitals = letters(text)
                shouting = 2 * n_capitals > n_letters
                exclaiming = text.count("!") > 0.2 * n
                repeating = len(chunks) > 20 and len(set(chunks)) < 0.3 * n
                patterns = [shouting, exclaiming, repeating, not hits]
                said = ["+" if hits[k] else "0" for k in range(n_lists)]
                said += ["+" if p else "0" for p in patterns[:3]] + ["-" if patterns[3] and chunks else "0"]
                votes.append("".join(said))
                x = [float(np.log1p(hits[k])) for k in range(n_lists)]
                total = sum(hits.values())
                inputs.append([*x, *map(float, patterns), float(np.log1p(total)), min(1.0, 20 * total / n)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(votes), pa.array(inputs, pa.list_(pa.float64()))],
                names=["id", "text_key", "votes", "inputs"],
            )

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), text_key(text_col).alias("k"))
    schema = T.StructType([T.StructField("id", source.schema["id"].dataType)]).add("text_key", "string")
    return source.mapInArrow(describe, schema.add("votes", "string").add("inputs", T.ArrayType(T.DoubleType())))


@dataclass
class LabelModel:
    """Voters' behaviour given the label, and the weight of each voter's voice."""

    prior: float
    log_odds: np.ndarray  # voter, vote (-, 0, +): log of P(vote | toxic) / P(vote | clean)
    voice: np.ndarray
    accuracy: np.ndarray
    correlation: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        seen = self.log_odds[np.arange(votes.shape[1])[None, :], votes]
        z = (seen * self.voice).sum(axis=1) + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def coded(votes: list[str]) -> np.ndarray:
    return np.array([["-0+".index(v) for v in row] for row in votes], dtype=int).reshape(len(votes), -1)


def statistics(votes: np.ndarray, counts: np.ndarray, belief: np.ndarray) -> np.ndarray:
    """All that a step of the label model needs to know of vote vectors, as sums, so that parts add up:
    votes by voter of toxic and clean texts, products of two voters' votes, and sums of the belief."""
    one_hot = np.stack([votes == v for v in range(3)], axis=2).astype(float)
    value = votes - 1.0
    return np.concatenate([
        np.einsum("r,rjv->jv", counts * belief, one_hot).ravel(),
        np.einsum("r,rjv->jv", counts * (1 - belief), one_hot).ravel(),
        ((value * counts[:, None]).T @ value).ravel(),
        [counts.sum(), (counts * belief).sum(), (counts * belief * belief).sum()],
    ])


def estimated(sums: np.ndarray, n: int, prior: float, rule: Supervision, shared: bool) -> LabelModel:
    """The model that follows from the statistics; `shared` lets correlated voters share a voice."""
    toxic, clean = sums[: 3 * n].reshape(n, 3), sums[3 * n : 6 * n].reshape(n, 3)
    products, (total, b, bb) = sums[6 * n : -3].reshape(n, n), sums[-3:]
    tables = [t + 0.1 for t in (toxic, clean)]
    tables = [t / t.sum(axis=1, keepdims=True) for t in tables]
    log_odds = np.log(tables[0]) - np.log(tables[1])
    # Agreement that the label does not explain: the products of the votes less their means, given the label.
    sign = np.array([-1.0, 0.0, 1.0])
    of_toxic, of_clean = tables[0] @ sign, tables[1] @ sign
    apart, with_belief, all_votes = of_toxic - of_clean, toxic @ sign, (toxic + clean) @ sign

    def both(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.outer(x, y) + np.outer(y, x)

    spread = (
        products - both(all_votes, of_clean) + total * np.outer(of_clean, of_clean)
        - both(with_belief, apart) + b * both(of_clean, apart) + bb * np.outer(apart, apart)
    ) / max(total, 1.0)
    scale = np.sqrt(np.maximum(np.diag(spread), 1e-9))
    correlation = spread / np.outer(scale, scale)
    voice = np.ones(n)
    if shared:
        tied = np.where(correlation >= rule.correlated, correlation, 0)
        np.fill_diagonal(tied, 1)
        voice = 1 / tied.sum(axis=1)
    accuracy = prior * tables[0][:, 2] + (1 - prior) * tables[1][:, 0]
    return LabelModel(prior, log_odds, voice, accuracy, correlation)


def label_model(
    votes: np.ndarray, counts: np.ndarray, prior: float, rule: Supervision, truth: np.ndarray | None = None, steps: int = 60
) -> LabelModel:
    """Expectation maximisation over distinct vote vectors and how often each occurs.

    `truth` has the label of the vectors that come from labelled rows, and NaN for the others: known labels
    anchor the model, so that voters are not taken for right merely because they agree.
    """
    truth = np.full(len(votes), np.nan) if truth is None else truth
    known = ~np.isnan(truth)
    lists = len(KINDS) * rule.lists
    found = (votes[:, :lists] == 2).sum(axis=1)
    belief = np.where(found >= 2, 0.95, np.where(found == 1, 0.6, 0.02))
    belief[known] = truth[known]
    model = None
    for step in range(steps):
        model = estimated(statistics(votes, counts, belief), votes.shape[1], prior, rule, step >= 5)
        after = np.where(known, truth, model.posterior(votes))
        if step > 8 and np.max(np.abs(after - belief)) < 1e-6:
            break
        belief = after
    return model


def label_model_of(patterns: DataFrame, prior: float, rule: Supervision, steps: int = 60) -> LabelModel:
    """The label model of all rows of `patterns` (votes, toxic, count), however many there are.

    It starts from the vectors of labelled rows and the most frequent others, which saves steps; each
    further step sums the statistics over all vectors where they lie, until the model no longer changes.
    """
    frequent = patterns.where("toxic IS NULL").orderBy(F.desc("count"), "votes").limit(rule.start_vectors)
    some = patterns.where("toxic IS NOT NULL").unionByName(frequent).orderBy("votes", "toxic").collect()
    votes, counts = coded([r.votes for r in some]), np.array([r["count"] for r in some], dtype=float)
    model = label_model(votes, counts, prior, rule, np.array([r.toxic for r in some], dtype=float), steps)
    for _ in range(steps):
        sums = summed(patterns, model)
        following = estimated(sums, len(model.voice), prior, rule, shared=True)
        change = np.abs(following.log_odds - model.log_odds).max()
        model = following
        if change < 1e-4:
            break
    return model


def summed(patterns: DataFrame, model: LabelModel) -> np.ndarray:
    """The statistics of all vote vectors under a model; the driver gets one number per statistic."""

    def partial(batches):
        for batch in batches:
            votes = coded(batch.column(0).to_pylist())
            truth = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
            counts = batch.column(2).to_numpy(zero_copy_only=False).astype(float)
            if len(votes):
                belief = np.where(np.isnan(truth), model.posterior(votes), truth)
                sums = statistics(votes, counts, belief)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums))), pa.array(sums)], names=["place", "value"])

    workers_find_package(patterns.sparkSession)
    parts = patterns.select("votes", F.col("toxic").cast("double"), "count").mapInArrow(partial, "place long, value double")
    rows = parts.groupBy("place").agg(F.sum("value").alias("value")).orderBy("place").collect()
    return np.array([r.value for r in rows])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Weights of a linear classifier on soft labels, the last one its constant; Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + penalty * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        w = w - step
        if np.max(np.abs(step)) < 1e-8:
            break
    return w


def _some(df: DataFrame, rows: int, key: str) -> DataFrame:
    """About `rows` rows at most, chosen by the hash of a column."""
    there = df.count()
    share = max(1, -(-there // max(1, rows)))
    return df.where(F.pmod(F.xxhash64(key), F.lit(share)) == 0).limit(2 * rows)


def scored(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Supervision = Supervision()
) -> DataFrame:
    """Per row: id, text_key, held_out, score, predicted."""
    known = labels.where(F.col("toxic").isin(0, 1)).select(F.col(id_col).alias("id"), "toxic").where(~held_out("id"))
    known = _some(keep(known.distinct(), "known", "snappy"), rule.labelled_rows, "id")
    # What the lexicons were chosen on says too much good about them: other rows anchor the label model.
    fifth = F.pmod(F.xxhash64("id", F.lit("part")), F.lit(5)) == 4
    known, anchors = known.where(~fifth), known.where(fifth)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    # At most 2 * labelled_rows ids, so the join needs no shuffle of the texts. Near copies of one text
    # are one witness: mostly they share their least three-word shingle.
    triples = let(F.split(F.coalesce("text", F.lit("")), r"\s+"), lambda words: F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(words) - 3, F.lit(0))),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    ))
    labelled = texts.join(F.broadcast(known), "id").withColumn("least", F.array_min(triples))
    labelled = keep(labelled.dropDuplicates(["least", "toxic"]).select("text", "toxic"), "labelled")
    lexicon = mined(labelled, rule)
    rows = keep(features(docs, id_col, text_col, lexicon, rule), "features")
    result = ["id", "text_key", held_out("id").alias("held_out")]
    if not lexicon:
        score = F.lit(0.0)
    else:
        prior = labelled.agg(F.avg("toxic")).first()[0]
        learning = rows.where(~held_out("id")).join(F.broadcast(anchors), "id", "left")
        patterns = keep(learning.groupBy("votes", "toxic").count(), "patterns")
        model = label_model_of(patterns, min(0.9, max(0.01, prior)), rule)
        sample = _some(learning, rule.classifier_rows, "text_key").select("votes", "inputs", "toxic").collect()
        x, truth = np.array([r.inputs for r in sample]), np.array([r.toxic for r in sample], dtype=float)
        belief = np.where(np.isnan(truth), model.posterior(coded([r.votes for r in sample])), truth)
        weights = logistic(x, belief)
        z = F.lit(float(weights[-1]))
        for k, w in enumerate(weights[:-1]):
            z = z + F.lit(float(w)) * F.get("inputs", F.lit(k))
        score = 1 / (1 + F.exp(-z))
    return rows.select(*result, score.alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= rule.threshold, 1).otherwise(0)
    ).withColumnRenamed("id", id_col)


def clean_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows not predicted toxic."""
    toxic = scored(docs, labels, id_col, text_col).where("predicted = 1")
    return without(docs, toxic, id_col, text_col)


def op7(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(docs.select("doc_id", "text"), labels).drop("text_key")
