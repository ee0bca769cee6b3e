"""Toxicity scores from the nearest labelled examples.

Examples are a bounded sample of labelled texts, clean ones too. A text is the
TF-IDF vector of all its words, of unit length over the whole text; a word that
goes with the label (by the chi-square statistic) weighs more, none weighs less.
The exact nearest examples by cosine are found with a block-max inverted index, a
batch of texts at a time: the postings of the rarer words are added up; the words
of most examples have their largest weight per block of examples, and a block is
opened (one matrix product for all texts that need it) only while its bound
reaches the k-th cosine found. Neighbours vote by similarity, and the votes are
calibrated on the examples themselves, each without its own vote.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktide.llm.common import batches, fold_of, learning_sample, ready, text_of
from clicktide.session import settle

# Bound of what is learned from; scoring has none.
EXAMPLES = 20_000
NEIGHBOURS = 15
BLOCK = 64
# So many words, those of most examples, are searched by blocks.
COMMON = 512
# Blocks of the largest bounds, opened before the others are judged.
FIRST = 12
# Texts that are searched together: a row of numbers per example for each.
BATCH = 96

# Words that a counting task holds before it passes them on.
HELD = 50_000

# Deviations from chance up to which a word weighs by its rarity alone; few words come so far by chance.
CHANCE = 3.0
# Weight of the share of toxic examples in a vote, beside the cosines: far neighbours say little.
PRIOR = 1.0

WORD = re.compile(r"\w+")

Vector = tuple[np.ndarray, np.ndarray]


def words(text: str) -> Counter:
    """How often each word occurs."""
    return Counter(WORD.findall(text.lower()))


def term_numbers(found: Counter) -> np.ndarray:
    """Words as 64-bit hashes, by which a vocabulary is searched without holding its words."""
    return np.fromiter((xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in found), np.uint64, len(found))


class BlockMaxIndex:
    """Inverted index of unit vectors, with blocks of alike rows and the largest weight per common term and block.

    Weights are kept as 32-bit floats; cosines are added up from them in 64 bits.
    """

    def __init__(self, sizes: np.ndarray, term: np.ndarray, weight: np.ndarray, terms: int) -> None:
        rows = len(sizes)
        row = np.repeat(np.arange(rows, dtype=np.int32), sizes)
        seen = np.bincount(term, minlength=terms)
        common = np.sort(np.argsort(-seen, kind="stable")[: min(COMMON, terms)])
        common = common[seen[common] > 1]
        self.number = np.full(terms, -1, dtype=np.int16)
        self.number[common] = np.arange(len(common))
        often = np.flatnonzero(self.number[term] >= 0)
        often_row, often_number, often_weight = row[often], self.number[term[often]], weight[often]
        # Alike rows side by side make blocks with tight bounds: by the heaviest common term, then by the next.
        by = np.lexsort((often_number, -often_weight, often_row))
        known, first = np.unique(often_row[by], return_index=True)
        heaviest = np.full((2, rows), -1, dtype=np.int64)
        heaviest[0, known] = often_number[by][first]
        more = first[np.append(np.diff(first), len(by) - first[-1:]) > 1] + 1 if len(first) else first
        heaviest[1, often_row[by][more]] = often_number[by][more]
        self.row = np.lexsort((np.arange(rows), heaviest[1], heaviest[0]))
        self.place = np.argsort(self.row).astype(np.int32)
        self.blocks = -(-rows // BLOCK)
        rare = np.flatnonzero(self.number[term] < 0)
        by = rare[np.lexsort((self.place[row[rare]], term[rare]))]
        self.places = self.place[row[by]].astype(np.uint16 if rows <= 1 << 16 else np.int32)
        self.weights = weight[by].astype(np.float32)
        self.start = np.append(0, np.cumsum(np.where(self.number < 0, seen, 0))).astype(np.int32 if len(by) < 1 << 31 else np.int64)
        self.dense = np.zeros((self.blocks, BLOCK, len(common)), np.float32)
        at = self.place[often_row]
        self.dense[at // BLOCK, at % BLOCK, often_number] = often_weight
        self.most = self.dense.max(axis=1) if self.blocks else np.zeros((0, len(common)), np.float32)
        self.length = np.sqrt((self.dense**2).sum(axis=2)).max(axis=1) if self.blocks else np.zeros(0, np.float32)
        self.opened = 0  # blocks opened so far, of ``asked`` times all blocks

    def _rarer(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Sum of products by place over the postings of terms that are not common."""
        begin, end = self.start[terms], self.start[terms + 1]
        full = np.flatnonzero(end > begin)
        if not len(full):
            return np.zeros(self.blocks * BLOCK)
        spans = [slice(a, b) for a, b in zip(begin[full].tolist(), end[full].tolist(), strict=True)]
        by = np.repeat(weights[full], end[full] - begin[full])
        by *= np.concatenate([self.weights[s] for s in spans])
        return np.bincount(np.concatenate([self.places[s] for s in spans]), by, self.blocks * BLOCK)

    def nearest(self, vectors: Sequence[Vector], k: int, without: Sequence[int] = ()) -> list[Vector]:
        """Rows and cosines of the ``k`` nearest of each vector, nearest first, ties to the smaller row; zero cosines are left out.

        ``without`` names one row per vector that is not its neighbour.
        """
        if not self.blocks or not vectors:
            return [(np.zeros(0, np.int64), np.zeros(0)) for _ in vectors]
        shape = len(vectors), self.blocks, BLOCK
        rarer = np.empty((len(vectors), self.blocks * BLOCK))
        asked = np.zeros((len(vectors), self.dense.shape[2]))
        for i, (terms, weights) in enumerate(vectors):
            rarer[i] = self._rarer(terms, weights)
            numbers = self.number[terms]
            asked[i, numbers[numbers >= 0]] = weights[numbers >= 0]
        if len(without):
            rarer[np.arange(len(vectors)), self.place[np.asarray(without)]] = -np.inf
        single = asked.astype(np.float32)
        length = np.sqrt((asked**2).sum(axis=1))
        # What the common terms can add in a block: by their largest weights, and by lengths.
        most = np.minimum(single @ self.most.T, np.outer(length, self.length)) * (1 + 1e-4)
        bound = rarer.reshape(shape).max(axis=2) + most
        total = rarer.astype(np.float32)

        def opened(need: np.ndarray) -> None:
            for block in np.flatnonzero(need.any(axis=0)):
                here = np.flatnonzero(need[:, block])
                total[here, block * BLOCK : (block + 1) * BLOCK] += single[here] @ self.dense[block].T

        def least() -> np.ndarray:
            """No more than the k-th largest total: the k-th largest of the blocks' largest, which are of different rows."""
            if self.blocks < k:
                return np.zeros((len(vectors), 1))
            return np.maximum(np.partition(total.reshape(shape).max(axis=2), self.blocks - k, axis=1)[:, self.blocks - k, None], 0)

        first = np.zeros(shape[:2], bool)
        np.put_along_axis(first, np.argpartition(-bound, min(FIRST, self.blocks) - 1, axis=1)[:, :FIRST], True, axis=1)
        first &= most > 0
        opened(first)
        rest = (bound >= least() - 1e-4) & (most > 0) & ~first
        opened(rest)
        self.opened += int(first.sum() + rest.sum())
        enough = least()[:, 0]
        out = []
        for i in range(len(vectors)):
            # Matrix products are of single precision: what they let through is added up again.
            near = np.flatnonzero((total[i] >= enough[i] - 1e-4) & (total[i] > 0))
            if len(near) > 4 * k:
                near = near[np.argsort(-total[i, near], kind="stable")]
                near = np.sort(near[total[i, near] >= total[i, near[k - 1]] - 1e-5])
            cosines = rarer[i, near] + self.dense[near // BLOCK, near % BLOCK].astype(np.float64) @ asked[i]
            rows = self.row[near] if len(near) else np.zeros(0, np.int64)
            keep = np.lexsort((rows, -np.round(cosines, 10)))[:k]
            out.append((rows[keep], cosines[keep]))
        return out


@dataclass
class Model:
    """What scores texts, as flat arrays that a worker reads once."""

    terms: np.ndarray  # sorted hashes of the words of the examples
    rarity: np.ndarray  # their weights: inverse document frequency, times relevance
    rare: float  # the same for any other word
    index: BlockMaxIndex | None
    ids: np.ndarray
    toxic: np.ndarray
    base: float  # share of toxic texts among all examples
    bare: float  # the same among examples without any word
    line: tuple[float, float] = (1.0, 0.0)  # slope and offset of the calibrated logit
    shared: Broadcast | None = None

    def known(self, numbers: np.ndarray) -> np.ndarray:
        """Places of word hashes among the terms, -1 for others."""
        if not len(self.terms):
            return np.full(len(numbers), -1)
        by = np.argsort(numbers)  # a search in order finds its way in the cache
        at = np.empty(len(numbers), np.int64)
        at[by] = np.minimum(np.searchsorted(self.terms, numbers[by]), len(self.terms) - 1)
        return np.where(self.terms[at] == numbers, at, -1)

    def vector(self, text: str) -> Vector | None:
        """Known terms and their weights, of unit length together with the unknown words; None without any word."""
        found = words(text)
        if not found:
            return None
        at = self.known(term_numbers(found))
        times = 1 + np.log(np.fromiter(found.values(), np.float64, len(found)))
        hit = at >= 0
        weights = times[hit] * self.rarity[at[hit]]
        other = float((times[~hit] ** 2).sum()) * self.rare**2
        return at[hit], weights / math.sqrt(float((weights**2).sum()) + other)

    def logit(self, rows: np.ndarray, cosines: np.ndarray) -> float:
        """Logit of the similarity-weighted vote."""
        share = (float((cosines * self.toxic[rows]).sum()) + PRIOR * self.base) / (float(cosines.sum()) + PRIOR)
        share = min(max(share, 1e-6), 1 - 1e-6)
        return math.log(share / (1 - share))

    def scores(self, texts: Sequence[str], line: tuple[float, float]) -> tuple[list[float], list[Vector]]:
        """Score and neighbours of each text; equal texts of a batch are searched once."""
        distinct = list(dict.fromkeys(texts))
        known: dict[str, tuple[float, Vector]] = {}
        for at in range(0, len(distinct), BATCH):
            part = [(t, self.vector(t)) for t in distinct[at : at + BATCH]]
            full = [(t, v) for t, v in part if v is not None and self.index is not None]
            nothing = np.zeros(0, np.int64), np.zeros(0)
            known |= {t: (self.bare, nothing) for t, _ in part}
            for (t, _), near in zip(full, self.index.nearest([v for _, v in full], NEIGHBOURS) if full else [], strict=True):
                logit = line[0] * self.logit(*near) + line[1]
                known[t] = 1 / (1 + math.exp(-max(-30.0, min(30.0, logit)))), near
        return [known[t][0] for t in texts], [known[t][1] for t in texts]


def calibrated(votes: np.ndarray, truth: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the label on the vote, held near the vote itself, by halved Newton steps."""
    x = np.c_[votes, np.ones(len(votes))]
    start = np.array([1.0, 0.0])
    beta = start.copy()
    for _ in range(60 if len(votes) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (truth - p) - 3.0 * (beta - start)
        beta = beta + 0.5 * np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 3.0 * np.eye(2), slope)
    return float(beta[0]), float(beta[1])


def _counted(rows: DataFrame) -> DataFrame:
    """In how many texts of ``rows`` each word occurs, and in how many toxic ones: ``term, n, a``."""
    schema = pa.schema([("term", pa.int64()), ("n", pa.int64()), ("a", pa.int64())])

    def out(every: Counter, toxic: Counter) -> dict:
        return {"term": term_numbers(every).view(np.int64), "n": list(every.values()), "a": [toxic[w] for w in every]}

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        every: Counter = Counter()
        toxic: Counter = Counter()
        for part in parts:
            for text, y in zip(part.column("text").to_pylist(), part.column("y").to_pylist(), strict=True):
                found = words(text).keys()
                every.update(found)
                if y:
                    toxic.update(found)
                if len(every) > HELD:
                    yield out(every, toxic)
                    every.clear()
                    toxic.clear()
        yield out(every, toxic)

    counted = rows.select("text", "y").mapInArrow(lambda parts: batches(count(parts), schema), "term long, n long, a long")
    return counted.groupBy("term").agg(F.sum("n").alias("n"), F.sum("a").alias("a"))


def _vocabulary(sample: DataFrame, positive: int, negative: int) -> tuple[np.ndarray, np.ndarray]:
    """All words of the examples, as sorted hashes, and their weights: inverse document frequency times relevance.

    Relevance is 1, and more for words whose count among toxic texts is more than
    ``CHANCE`` standard deviations (the root of chi-square) off what chance gives.
    """
    total = positive + negative
    share = positive / total
    expected = F.col("n") * share
    spread = F.sqrt(F.greatest(expected * (1 - share) * (1 - F.col("n") / total), F.lit(1e-9)))
    apart = F.greatest(F.abs(F.col("a") - expected) - 0.5, F.lit(0.0)) / spread
    relevance = 1 + F.greatest(apart - CHANCE, F.lit(0.0))
    rarity = F.log((1 + total) / (1 + F.col("n"))) + 1
    found = _counted(sample).select("term", (rarity * relevance).alias("weight")).toArrow()
    terms = found.column("term").to_numpy().view(np.uint64)
    by = np.argsort(terms)
    return terms[by], found.column("weight").to_numpy()[by]


EXAMPLE = pa.schema([("at", pa.int64()), ("doc_id", pa.int64()), ("y", pa.int32()), ("terms", pa.binary()), ("times", pa.binary())])
EXAMPLE_DDL = "at long, doc_id long, y int, terms binary, times binary"


def _vectors(sample: DataFrame, model: Model) -> DataFrame:
    """The examples as term numbers and how often each occurs."""
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def counts(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for part in parts:
            found = [words(t) for t in part.column("text").to_pylist()]
            terms = [shared.value.known(term_numbers(f)).astype("<i4").tobytes() for f in found]
            times = [np.fromiter(f.values(), "<i4", len(f)).tobytes() for f in found]
            yield {"at": part.column("at"), "doc_id": part.column("doc_id"), "y": part.column("y"), "terms": terms, "times": times}

    return settle(sample.mapInArrow(lambda p: batches(counts(p), EXAMPLE), EXAMPLE_DDL), "toxicity-vectors")


def _unit(terms: np.ndarray, times: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    weights = (1 + np.log(times.astype(np.float64))) * rarity[terms]
    return weights / math.sqrt(float((weights**2).sum()))


def fit(docs: DataFrame, labels: DataFrame, rows: int = EXAMPLES) -> Model:
    """Learn from at most ``rows`` labelled texts outside fold 0.

    What reaches the driver is bounded by ``rows``: a number and a weight for each
    word of an example. With no labelled text, or none of one class, every text
    gets the share of toxic examples (0 without examples).
    """
    context = ready(docs.sparkSession).sparkContext
    chosen = learning_sample(labels, "toxic", rows)
    sample = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), "doc_id")
    sample = settle(sample.select("doc_id", "y", "text", F.monotonically_increasing_id().alias("at")), "toxicity-examples")
    sizes = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    positive, negative = sizes.get(1, 0), sizes.get(0, 0)
    base = positive / max(1, positive + negative)
    nothing = np.zeros(0, np.uint64), np.zeros(0)
    known, rarity = _vocabulary(sample, positive, negative) if positive and negative else nothing
    rare = math.log(1 + positive + negative) + 1
    model = Model(known, rarity, rare, None, np.zeros(0, np.int64), np.zeros(0), base, base)
    if not len(known):
        return model
    vectors = _vectors(sample, model)
    found = vectors.toArrow()
    at, ids, y = (found.column(c).to_numpy() for c in ("at", "doc_id", "y"))
    sizes = np.array([len(x) // 4 for x in found.column("terms").to_pylist()], np.int64)
    order = [i for i in np.lexsort((at, ids)).tolist() if sizes[i]]
    parts = [(np.frombuffer(found.column("terms")[i].as_py(), "<i4"), np.frombuffer(found.column("times")[i].as_py(), "<i4")) for i in order]
    del found
    terms = np.concatenate([t for t, _ in parts]) if parts else np.zeros(0, np.int32)
    weights = np.concatenate([_unit(t, n, rarity).astype(np.float32) for t, n in parts]) if parts else np.zeros(0, np.float32)
    del parts
    model.index = BlockMaxIndex(sizes[order], terms, weights, len(known))
    model.ids, model.toxic = ids[order], y[order].astype(np.float64)
    bare = y[sizes == 0]
    model.bare = (float(bare.sum()) + base) / (len(bare) + 1)
    model.shared = context.broadcast(model)
    model.line = calibrated(*_own_votes(vectors, model, at[order]))
    return model


def _own_votes(vectors: DataFrame, model: Model, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vote on each example by the others, in parallel; ``at`` are the examples' numbers in the order of the index."""
    shared, by = model.shared, np.argsort(at)
    numbers = at[by]
    schema = pa.schema([("row", pa.int64()), ("vote", pa.float64())])

    def votes(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        here = shared.value
        for part in parts:
            for low in range(0, part.num_rows, BATCH):
                piece = part.slice(low, BATCH)
                asked = [(np.frombuffer(t, "<i4"), np.frombuffer(n, "<i4")) for t, n in zip(piece.column("terms").to_pylist(), piece.column("times").to_pylist(), strict=True)]
                full = [i for i, (t, _) in enumerate(asked) if len(t)]
                rows = by[np.searchsorted(numbers, piece.column("at").to_numpy()[full])]
                found = here.index.nearest([(asked[i][0], _unit(*asked[i], here.rarity)) for i in full], NEIGHBOURS, rows)
                yield {"row": rows, "vote": [here.logit(*near) for near in found]}

    found = vectors.mapInArrow(lambda p: batches(votes(p), schema), "row long, vote double").toArrow()
    order = np.argsort(found.column("row").to_numpy())
    return found.column("vote").to_numpy()[order], model.toxic


EVIDENCE = pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.float64())])
SCORED = "score double, evidence array<struct<doc_id long, cosine double, toxic double>>"


def _told(model: Model, near: Sequence[Vector]) -> pa.Array:
    """Neighbours as an Arrow list of structs."""
    ends = np.append(0, np.cumsum([len(rows) for rows, _ in near]))
    rows, cosines = (np.concatenate([n[k] for n in near]) for k in (0, 1))
    values = pa.StructArray.from_arrays([pa.array(model.ids[rows], pa.int64()), pa.array(cosines), pa.array(model.toxic[rows])], fields=list(EVIDENCE))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def scorer(model: Model, evidence: bool = True):
    """A column function: score of a text, with the examples that voted if asked for."""
    # Each Python worker reads the model once, not once a task; what was learned after it was sent goes with the function.
    shared = model.shared or SparkSession.active().sparkContext.broadcast(model)
    line = model.line

    def found(texts: pa.Array) -> tuple[pa.Array, list[Vector]]:
        scores, near = shared.value.scores(texts.to_pylist(), line)
        return pa.array(scores, pa.float64()), near

    @F.arrow_udf("double")
    def score(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            yield found(part)[0]

    @F.arrow_udf(SCORED)
    def told(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            scores, near = found(part)
            lists = _told(shared.value, near) if near else pa.array([], pa.list_(EVIDENCE))
            yield pa.StructArray.from_arrays([scores, lists], names=["score", "evidence"])

    return told if evidence else score


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = EXAMPLES) -> DataFrame:
    """Score of every whole text: ``doc_id, held_out, score, predicted, evidence``.

    Every input row gives one row, repeated rows and NULL ids (held out) too; NULL
    texts count as empty, and texts without any word get the share of toxic
    examples among such texts. Scores depend on the text alone. Columns other than
    ``doc_id`` and ``text`` are not looked at.
    """
    model = fit(docs, labels, rows)
    found = docs.select("doc_id", (fold_of() == 0).alias("held_out"), scorer(model)(text_of()).alias("s"))
    predicted = (F.col("s.score") >= 0.5).cast("int")
    return found.select("doc_id", "held_out", F.col("s.score").alias("score"), predicted.alias("predicted"), F.col("s.evidence").alias("evidence"))


def keep_clean(docs: DataFrame, labels: DataFrame, rows: int = EXAMPLES) -> DataFrame:
    """The rows scored below 0.5, with all columns of ``docs``."""
    model = fit(docs, labels, rows)
    return docs.where(scorer(model, evidence=False)(text_of()) < 0.5)
