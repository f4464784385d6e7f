"""Toxicity by weak supervision (operator 4).

1. A bounded sample of labelled rows (``MAX_LABELLED``, in hash order; rows of
   the held-out fold never) is mined for terms, whole words and word beginnings,
   that go with toxic documents far beyond chance (Chernoff bound with a union
   bound over all terms). Mining goes on among the rows that no term hits yet,
   where the toxic share is lower and rarer terms stand out. The terms and a
   short fixed list make the lexicons.
2. *Voters*: each lexicon list, each list of beginnings by length, patterns on
   the hits (several, several different, dense); the annotator is one more.
3. *Label model*: a generative model of the votes given the hidden label. EM
   estimates each voter's rates under either label, the annotator's among them, and,
   as the largest spanning tree of conditional mutual information, which voters depend
   on each other (the annotator on none: it saw the text, not their votes);
   the tree's conditional tables stop correlated voters from counting twice.
4. A logistic regression on voters and terms learns the posterior labels and
   scores every whole text.

The model is fitted on the driver from the votes and term numbers of the sample
(at most ``MAX_LABELLED`` rows, ``MAX_TERMS`` terms); mining, voting and scoring
run on Spark.

Edge cases: null and empty texts have no hits and get the base score; without
labelled rows of both kinds the fixed list alone decides; several labels for an
id count once, toxic if any is; rows with equal ids or texts are scored alike;
labels with nulls are not used; other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import fold_of_id, slices, whole_text, written

MAX_LABELLED = 8000
MAX_TERMS = 600
MINING_ROUNDS = 3
FIRST_GUESS = 0.9       # of the annotator's accuracy, from which EM starts
HELD_OUT_FOLD = 2
THRESHOLD = 0.3
STEMS = (4, 5, 6, 7, 8)
WORD_LISTS, STEM_LISTS = 8, 4

#: A short public list of insults.
SEED_WORDS = ("idiot stupid moron loser scum trash pathetic worthless disgusting clown "
              "dumb fool jerk bastard bitch asshole shit fuck").split()


@dataclass(frozen=True)
class Term:
    text: str
    stem: bool      # matches the beginning of a word, else a whole word
    seed: bool = False

    @property
    def voter(self) -> int:
        if self.seed:
            return 0
        if not self.stem:
            return 1 + zlib.crc32(self.text.encode()) % WORD_LISTS
        return 1 + WORD_LISTS + STEMS.index(len(self.text)) * STEM_LISTS + zlib.crc32(self.text.encode()) % STEM_LISTS


LIST_VOTERS = 1 + WORD_LISTS + len(STEMS) * STEM_LISTS
PATTERN_VOTERS = 3      # several hits, several different terms, dense hits
VOTERS = LIST_VOTERS + PATTERN_VOTERS


class Matcher:
    """Finds the terms in texts and turns them into votes."""

    def __init__(self, terms: list[Term]):
        self.terms = terms
        self.automaton = ahocorasick.Automaton()
        by_text: dict[str, list[int]] = {}
        for i, term in enumerate(terms):
            by_text.setdefault(term.text, []).append(i)
        for text, numbers in by_text.items():
            self.automaton.add_word(text, (len(text), [(i, terms[i].stem) for i in numbers]))
        if by_text:
            self.automaton.make_automaton()
        self.empty = not by_text

    def hits(self, text: str) -> Counter:
        """Term number: occurrences, in a lower-cased text."""
        found: Counter = Counter()
        if self.empty or not text:
            return found
        last = len(text) - 1
        for end, (size, numbers) in self.automaton.iter(text):
            before = end - size
            if before >= 0 and text[before].isalpha():
                continue
            ends = end == last or not text[end + 1].isalpha()
            for i, stem in numbers:
                if stem or ends:
                    found[i] += 1
        return found

    def votes(self, text: str, found: Counter) -> list[int]:
        """Numbers of the voters that vote toxic."""
        if not found:
            return []
        out = {self.terms[i].voter for i in found}
        total = max(found.values()) if len(found) == 1 else sum(n for i, n in found.items() if not self.terms[i].stem) or max(found.values())
        if total >= 2:
            out.add(LIST_VOTERS)
        if len(found) >= 4:
            out.add(LIST_VOTERS + 1)
        if total * 300 >= len(text):
            out.add(LIST_VOTERS + 2)
        return sorted(out)


# --- mining ---------------------------------------------------------------

def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, text, toxic) of at most ``most`` labelled rows outside the held-out
    fold: one row for each id, that with the least text hash."""
    ids = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
           .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (fold_of_id() != HELD_OUT_FOLD))
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    # The broadcast side has ``most`` rows of two numbers at most.
    found = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
             .join(F.broadcast(ids), "doc_id").select("doc_id", "text", "toxic"))
    # An id may repeat over many rows with different texts.
    one = _one_of_copies(found).groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "toxic")).alias("r"))
    return one.select("doc_id", "r.text", "r.toxic")


def _one_of_copies(sample: DataFrame) -> DataFrame:
    """One row of those that share the smallest hash of their five-word shingles,
    by two hashes in turn: copies and near copies of one toxic document would
    make each of its words look like a toxic term."""
    words = sample.withColumn("w", F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    hashed = words.withColumn("w", F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("w") - 5, F.lit(0))), lambda i: F.xxhash64(F.slice("w", i + 1, 5))))
    rows = hashed.select("doc_id", "text", "toxic", F.array_min("w").alias("m1"),
                         F.array_min(F.transform("w", lambda x: F.xxhash64(x, F.lit(1)))).alias("m2"))
    for m in ("m1", "m2"):
        rows = rows.groupBy(m).agg(F.min(F.struct("doc_id", "toxic", "text", "m1", "m2")).alias("r")).select("r.*")
    return rows.select("doc_id", "text", "toxic")


def mined_terms(sample: DataFrame, most: int = MAX_TERMS) -> list[Term]:
    """Terms whose toxic share is at least a half and beyond chance."""
    totals = sample.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).first()
    n, toxic = totals["n"], totals["toxic"] or 0
    if not 0 < toxic < n:
        return []
    base = toxic / n
    words = sample.select("toxic", F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("w"))

    def stems(size: int) -> Column:
        longer = F.filter("w", lambda x: F.char_length(x) > size)
        return F.transform(longer, lambda x: F.concat(F.substring(x, 1, size), F.lit("*")))

    counts = (words.select("toxic", F.explode(F.array_distinct(F.concat("w", *[stems(k) for k in STEMS]))).alias("term"))
              .groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic"))
              .where((F.col("toxic") >= 3) & (F.col("toxic") >= 0.5 * F.col("n"))))
    share = F.col("toxic") / F.col("n")
    other = F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - base))).otherwise(F.lit(0.0))
    surprise = F.col("n") * (share * F.log(share / base) + other)
    # As many terms as a document of the sample has on average bound the union.
    chance = float(np.log(max(n, 2) * 100))
    rows = (counts.select("term", surprise.alias("surprise")).where(F.col("surprise") >= chance)
            .orderBy(F.desc("surprise"), "term").limit(most).collect())
    return [Term(r["term"].rstrip("*"), r["term"].endswith("*")) for r in rows]


def without_hits(sample: DataFrame, terms: list[Term]) -> DataFrame:
    """The rows of the sample in which no term occurs."""
    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(terms)
        for batch in batches:
            yield batch.filter(pa.array([not matcher.hits(t.lower()) for t in batch.column("text").to_pylist()], pa.bool_()))
    return sample.mapInArrow(drop, sample.schema)


def lexicon(sample: DataFrame) -> list[Term]:
    """The fixed list and the terms mined round by round."""
    terms = [Term(w, False, True) for w in SEED_WORDS]
    for _ in range(MINING_ROUNDS):
        left = MAX_TERMS + len(SEED_WORDS) - len(terms)
        new = mined_terms(without_hits(sample, terms), left) if left else []
        if not new:
            break
        terms += new
    return terms


def sample_votes(sample: DataFrame, terms: list[Term]) -> list:
    """(toxic, voters, terms) of each row of the sample, in a fixed order."""
    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(terms)
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                low = text.lower()
                found = matcher.hits(low)
                rows.append((matcher.votes(low, found), sorted(found)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), pa.array([r[0] for r in rows], pa.list_(pa.int32())),
                 pa.array([r[1] for r in rows], pa.list_(pa.int32()))], names=["doc_id", "toxic", "voters", "terms"])
    rows = sample.mapInArrow(vote, "doc_id long, toxic int, voters array<int>, terms array<int>").collect()
    return sorted(rows, key=lambda r: (r["doc_id"], r["toxic"], r["terms"]))


# --- label model -----------------------------------------------------------

class LabelModel:
    """Hidden label y and binary votes: p(y) times, along a tree, p(vote | parent's vote, y)."""

    def __init__(self, rounds: int = 25, least_information: float = 1e-3):
        self.rounds, self.least_information = rounds, least_information

    def _tables(self, votes: np.ndarray, q: np.ndarray) -> np.ndarray:
        """p(y, a's vote, b's vote) for all pairs of voters, smoothed: [y, u, v, a, b]."""
        out = np.empty((2, 2, 2, votes.shape[1], votes.shape[1]))
        for y, weight in enumerate((1 - q, q)):
            one = votes * weight[:, None]
            both, single, total = votes.T @ one, one.sum(0), weight.sum()
            out[y, 1, 1] = both
            out[y, 1, 0] = single[:, None] - both
            out[y, 0, 1] = single[None, :] - both
            out[y, 0, 0] = total - single[:, None] - single[None, :] + both
        out = np.maximum(out, 0) + 0.1
        return out / out.sum((0, 1, 2), keepdims=True)

    def _tree(self, joint: np.ndarray) -> list[tuple[int, int | None]]:
        """(voter, parent) in an order that has parents first."""
        py = joint.sum((1, 2))
        pa_, pb = joint.sum(2), joint.sum(1)
        info = (joint * np.log(joint * py[:, None, None] / (pa_[:, :, None] * pb[:, None]))).sum((0, 1, 2))
        np.fill_diagonal(info, -1)
        self.information = info
        m, order, best = len(info), [], np.full(len(info), -1.0)
        parent, left = np.full(m, -1), set(range(m))
        while left:
            v = max(left, key=lambda j: (best[j], -j))
            left.remove(v)
            order.append((v, int(parent[v]) if best[v] >= self.least_information else None))
            closer = info[v] > best
            best[closer], parent[closer] = info[v][closer], v
        return order

    def fit(self, votes: np.ndarray, annotated: np.ndarray) -> np.ndarray:
        """Posterior of label 1 for each row. EM starts from the annotator's votes,
        and estimates its rates as it does those of the other voters."""
        marked = (annotated > 0).astype(int)
        q = np.where(marked, FIRST_GUESS, 1 - FIRST_GUESS)
        for _ in range(self.rounds):
            joint = self._tables(votes, q)
            says = np.array([((w * marked).sum() + 0.1, (w * (1 - marked)).sum() + 0.1) for w in (1 - q, q)])
            self.annotator = says[:, 0] / says.sum(1)       # p(marked | y)
            annotator = np.log(np.where(marked, self.annotator[1] / self.annotator[0],
                                        (1 - self.annotator[1]) / (1 - self.annotator[0])))
            self.tree, self.prior = self._tree(joint), float(np.clip(q.mean(), 1e-4, 1 - 1e-4))
            log_odds = np.log(self.prior / (1 - self.prior)) + annotator
            for v, parent in self.tree:
                if parent is None:
                    one = joint[:, :, :, v, 0].sum(2) if v else joint[:, :, :, v, v].diagonal(axis1=1, axis2=2)
                    p = one / one.sum(1, keepdims=True)
                    step = np.log(p[1] / p[0])[votes[:, v].astype(int)]
                else:
                    pair = joint[:, :, :, parent, v]
                    p = pair / pair.sum(2, keepdims=True)
                    step = np.log(p[1] / p[0])[votes[:, parent].astype(int), votes[:, v].astype(int)]
                log_odds = log_odds + step
            new = 1 / (1 + np.exp(-np.clip(log_odds, -40, 40)))
            moved, q = float(np.abs(new - q).max()), new
            if moved < 1e-4:
                break
        agree = votes * q[:, None] + (1 - votes) * (1 - q[:, None])
        self.accuracy = agree.mean(0)
        centred = votes - (votes.T @ q / max(q.sum(), 1e-9)) * q[:, None] - (votes.T @ (1 - q) / max((1 - q).sum(), 1e-9)) * (1 - q[:, None])
        spread = np.sqrt((centred ** 2).sum(0)) + 1e-9
        self.correlation = centred.T @ centred / np.outer(spread, spread)
        return q


# --- classifier -------------------------------------------------------------

def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 400) -> np.ndarray:
    """Weights (the last is the intercept) by accelerated full-batch descent;
    ``y`` are probabilities."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    step = 1 / (0.25 * float((x ** 2).sum(1).mean()) + ridge)
    w = v = np.zeros(x.shape[1])
    keep = np.r_[np.full(x.shape[1] - 1, ridge), 0]
    for k in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -40, 40)))
        new = v - step * (x.T @ (p - y) / len(x) + keep * v)
        w, v = new, new + k / (k + 3) * (new - w)
    return w


@dataclass
class Model:
    terms: list[Term]
    voter_weights: np.ndarray
    term_weights: np.ndarray
    intercept: float
    labels: LabelModel | None = None


def fit(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> Model:
    sample = written(labelled_sample(docs, labels, most), "toxic-sample")
    terms = lexicon(sample)
    rows = sample_votes(sample, terms)
    if len({r["toxic"] for r in rows}) < 2:
        votes = np.zeros(VOTERS)
        votes[0] = 4.0
        return Model(terms, votes, np.zeros(len(terms)), -3.0)
    votes, hits = np.zeros((len(rows), VOTERS)), np.zeros((len(rows), len(terms)))
    for i, r in enumerate(rows):
        votes[i, r["voters"]] = 1
        hits[i, r["terms"]] = 1
    gold = np.array([float(r["toxic"]) for r in rows])
    model = LabelModel()
    posterior = model.fit(votes, gold)
    w = logistic(np.hstack([votes, hits]), posterior)
    return Model(terms, w[:VOTERS], w[VOTERS:-1], float(w[-1]), model)


def scored(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, score) for every row."""
    terms, by_voter, by_term, intercept = model.terms, model.voter_weights, model.term_weights, model.intercept

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(terms)
        for batch in batches:
            for part in slices(batch, "text"):
                out = []
                for text in part.column("text").to_pylist():
                    low = text.lower()
                    found = matcher.hits(low)
                    z = intercept + float(by_term[list(found)].sum()) + float(by_voter[matcher.votes(low, found)].sum()) if found else intercept
                    out.append(1 / (1 + np.exp(-min(max(z, -40.0), 40.0))))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(out, pa.float64())], names=["id", "score"])

    rows = docs.select(F.col(id_column).alias("id"), whole_text(text_column).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(score, f"id {kind}, score double").withColumnRenamed("id", id_column)


def toxicity_report(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row of ``docs``: doc_id, held_out, score, predicted."""
    return scored(docs, fit(docs, labels)).select(
        "doc_id", F.coalesce(fold_of_id() == HELD_OUT_FOLD, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def clean_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, that score below the threshold."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("id"), "text")
    held = scored(rows, fit(docs, labels), "id").where(F.col("score") < threshold)
    return held.select(*[F.col("id")[c].alias(c) for c in docs.columns])
