"""Operator 9: toxicity by a subsequence string-kernel support vector machine.

A word, with marks at both ends, is mapped to its subsequences of three
characters within a span of ``SPAN``, each gap character costing a factor of
``DECAY``; words with inserted or missing characters thus stay near.  Nyström
landmarks are training words, so a word's features are its kernel values to
the landmarks, whitened by the landmarks' own kernel matrix.  A linear
squared-hinge SVM over these is trained on labelled sentences: a toxic
document counts by its most toxic word's sentence, found anew in each round,
the others by the hardest words of their sentences.  A sentence scores as its
most toxic word; a logistic curve over the two most toxic distinct words of a
document, fitted on training documents, gives its probability.

Training sees at most ``MAX_DOCS`` documents of either label, of at most
``MAX_CHARS`` characters each, taken by a hash of their ids: the only bound
here.  Scoring reads every whole text and nothing but the text.

Defined results: null and empty texts, and texts without words, score as a
document of a neutral margin far below the threshold; ids labelled twice are
toxic if one label says so; null labels and labels of unknown ids are passed
over; with no toxic (or no clean) training document every score is 0;
repeated rows are scored as often as they occur.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estuary.llm.common import drop_kept, ship_package, slices, table, texts_of

MAX_DOCS = 1000
MAX_CHARS = 20_000
SPAN, DECAY = 6, 0.6
CANDIDATES, LANDMARKS, NEUTRAL = 256, 64, 32
THRESHOLD = 0.7
EMPTY_MARGIN = -3.0
_LETTERS = 64
_GAPS = [(a, b) for a in range(1, SPAN) for b in range(1, SPAN - a)]
#: Words whose margins a task keeps; beyond it they are worked out anew.
_MAX_WORDS = 150_000
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")


def codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letter codes of marked words, 0 beyond their ends, and their lengths."""
    lengths = np.array([len(w) + 2 for w in words], dtype=np.int64)
    flat = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le"), dtype="<u4").astype(np.int64)
    small = np.where((flat >= 97) & (flat <= 122), flat - 96, 29 + flat % (_LETTERS - 29))
    small = np.where(flat == 2, 27, np.where(flat == 3, 28, small))
    out = np.zeros((len(words), int(lengths.max(initial=0)) + SPAN), dtype=np.int64)
    row = np.repeat(np.arange(len(words)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = small
    return out, lengths


def norms(lengths: np.ndarray) -> np.ndarray:
    """Length of the feature vector, each occurrence counted by itself."""
    total = np.zeros(len(lengths))
    for a, b in _GAPS:
        total += np.maximum(lengths - a - b, 0) * DECAY ** (2 * (a + b - 2))
    return np.sqrt(np.maximum(total, 1e-9))


def triples(code: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    """Feature ids of one gap pattern at every place (0 where it runs off), and its weight."""
    n = code.shape[1] - SPAN
    for a, b in _GAPS:
        third = code[:, a + b:a + b + n]
        ids = (code[:, :n] * _LETTERS + code[:, a:a + n]) * _LETTERS + third
        yield np.where(third > 0, ids, 0), DECAY ** (a + b - 2)


def by_length(words: list[str], size: int = 4096) -> Iterator[np.ndarray]:
    """Indices of words in chunks of like length, so padding stays small."""
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    order = np.argsort(lengths, kind="stable")
    start = 0
    while start < len(order):
        n = max(1, min(size, size * 24 // (int(lengths[order[min(start + size, len(order)) - 1]]) + 1)))
        yield order[start:start + n]
        start += n


def kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Normalised kernel values of words against landmarks, in half precision: the matrix is the training task's largest."""
    code, lengths = codes(landmarks)
    place = np.zeros(_LETTERS ** 3, dtype=np.int32)
    used = np.unique(np.concatenate([ids.ravel() for ids, _ in triples(code)]))
    used = used[used > 0]
    place[used] = np.arange(1, len(used) + 1)
    weights = np.zeros((len(used) + 1, len(landmarks)), dtype=np.float32)
    for ids, w in triples(code):
        np.add.at(weights, (place[ids], np.arange(len(landmarks))[:, None]), w)
    weights[0] = 0
    weights /= norms(lengths).astype(np.float32)
    out = np.zeros((len(words), len(landmarks)), dtype=np.float16)
    for chunk in by_length(words):
        code, lengths = codes([words[k] for k in chunk])
        rows = np.zeros((len(chunk), len(landmarks)), dtype=np.float32)
        for ids, w in triples(code):
            at = place[ids]
            r, c = np.nonzero(at)
            if len(r):
                first = np.flatnonzero(np.append(True, r[1:] != r[:-1]))
                rows[r[first]] += np.float32(w) * np.add.reduceat(weights[at[r, c]], first, axis=0)
        out[chunk] = rows / norms(lengths).astype(np.float32)[:, None]
    return out


class Model:
    """The machine collapsed to one weight for each feature: margins are sums over a word's features."""

    def __init__(self, table: np.ndarray, bias: float, slopes: np.ndarray, shift: float):
        self.table, self.bias, self.slopes, self.shift = table, bias, slopes, shift

    def margins(self, words: list[str]) -> np.ndarray:
        out = np.zeros(len(words))
        for chunk in by_length(words):
            code, lengths = codes([words[k] for k in chunk])
            total = np.zeros(len(chunk), dtype=np.float32)
            for ids, w in triples(code):
                total += np.float32(w) * self.table[ids].sum(axis=1)
            out[chunk] = total / norms(lengths)
        return out + self.bias

    def probability(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(margins @ self.slopes + self.shift, -500, 500)))


def tokens(text: str) -> list[str]:
    """White-space tokens, and runs of three or more single letters joined."""
    words = text.split()
    run: list[str] = []
    joined = []
    if any(len(w) == 1 for w in words):
        for w in [*words, "  "]:
            if len(w) == 1:
                run.append(w)
            else:
                if len(run) > 2:
                    joined.append("".join(run))
                run = []
    return words + joined


def plain(word: str) -> str:
    """Lower case, without marks around it; a word of marks only stays."""
    return _EDGES.sub("", word.lower()) or word[:1]


def svm(x: np.ndarray, y: np.ndarray, c: float) -> tuple[np.ndarray, float]:
    """Primal squared-hinge SVM by Newton steps; classes weigh alike."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    cost = np.where(y > 0, c * len(y) / (2 * max(1, (y > 0).sum())), c * len(y) / (2 * max(1, (y < 0).sum()))) / len(y)
    ridge = np.eye(x1.shape[1]) * 1e-3
    ridge[-1, -1] = 1e-8
    w = np.zeros(x1.shape[1])
    for _ in range(30):
        active = y * (x1 @ w) < 1
        xa = x1[active] * cost[active][:, None]
        new = np.linalg.solve(ridge + xa.T @ x1[active], xa.T @ y[active])
        if np.abs(new - w).max() < 1e-9:
            break
        w = new
    return w[:-1], float(w[-1])


def logistic(margins: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, float]:
    """Non-negative slopes and the shift of the probability; labels weigh alike and are softened as Platt does."""
    n1, n0 = label.sum(), (1 - label).sum()
    target = np.where(label > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(label > 0, 0.5 / n1, 0.5 / n0) * len(label)
    x = np.hstack([margins, np.ones((len(margins), 1))])
    w = np.zeros(x.shape[1])
    ridge = 1e-2 * np.eye(len(w))
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (weight * (target - p)) - ridge @ w)
        w = w + np.clip(step, -2, 2)
        w[:-1] = np.maximum(w[:-1], 1e-3)
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def doc_max(values: np.ndarray, docs: list[np.ndarray]) -> np.ndarray:
    return np.stack([values[d].max(axis=0) for d in docs])


def evidence(toxic: np.ndarray, clean: np.ndarray, n1: float, n0: float) -> np.ndarray:
    """Log-likelihood gain of telling documents by a mark that so many of either label bear; 0 if it speaks for clean."""
    def part(k, n, p):
        return k * np.log(p) + (n - k) * np.log1p(-p)

    p1, p0, p = (np.clip(x, 1e-6, 1 - 1e-6) for x in (toxic / n1, clean / n0, (toxic + clean) / (n1 + n0)))
    gain = part(toxic, n1, p1) + part(clean, n0, p0) - part(toxic, n1, p) - part(clean, n0, p)
    return np.where(p1 > p0, gain, 0)


def choose_landmarks(words: list[str], docs: list[np.ndarray], label: np.ndarray) -> tuple[list[str], list[str], np.ndarray]:
    """Landmarks, the telling ones first; those; and the level of likeness to each that tells.

    Candidates stand out by document counts.  Each is judged by how well the
    likeness of a document's nearest word tells the labels, at a level that
    few clean documents pass.  Those beyond chance are taken while they find
    toxic documents that the ones taken miss, then by what they tell alone.
    The words of clean documents nearest to them, and common words, are
    landmarks for contrast.
    """
    n1, n0 = label.sum(), (1 - label).sum()
    hits = np.zeros((2, len(words)))
    for d, y in zip(docs, label):
        hits[int(y), d] += 1
    gain = evidence(hits[1], hits[0], n1, n0)
    candidates = [int(k) for k in np.argsort(-gain, kind="stable")[:CANDIDATES] if gain[k] > 0]
    names = [words[k] for k in candidates]
    likeness = kernel(words, names)
    near = doc_max(likeness, docs)
    clean = np.sort(near[label == 0], axis=0)
    cut = np.maximum(clean[int(0.99 * (len(clean) - 1))], 0.3) + 0.02
    found = near > cut
    told = evidence(found[label > 0].sum(axis=0), found[label == 0].sum(axis=0), n1, n0)
    able = told > np.log(max(2, len(words)))
    if not able.any():
        able = told >= np.sort(told)[-min(10, len(told))]
    missing, chosen = label > 0, []
    while len(chosen) < min(LANDMARKS, int(able.sum())):
        more = np.where(able, found[missing].sum(axis=0) + 1e-3 * told, -1)
        more[chosen] = -1
        chosen.append(int(np.argmax(more)))
        missing = missing & ~found[:, chosen[-1]]
    in_clean = hits[0] > 0
    contrast: list[int] = []
    for k in chosen:
        closest = np.argsort(-np.where(in_clean, likeness[:, k], 0), kind="stable")[:4]
        contrast += closest[likeness[closest, k] > 0.2].tolist()
    common = np.argsort(-hits[0], kind="stable")[:NEUTRAL].tolist()
    telling = [names[k] for k in chosen]
    others = [words[k] for k in dict.fromkeys(contrast[:2 * LANDMARKS] + common)]
    return list(dict.fromkeys(telling + others)), telling, cut[chosen]


def top_two(margins: np.ndarray) -> np.ndarray:
    """The two largest margins of a document's distinct words."""
    if len(margins) < 2:
        return np.array([margins[0] if len(margins) else EMPTY_MARGIN, EMPTY_MARGIN])
    return -np.partition(-margins, 1)[:2]


def fit(texts: list[str], labels: list[int]) -> Model | None:
    """Train on documents with labels; None where a label has no document.

    Toxic documents without any telling word have no sentence to learn from
    and are left out; a quarter of the clean ones only set the probability.
    """
    sets = [{plain(w) for w in tokens(t)} for t in texts]
    keep = [k for k, s in enumerate(sets) if s]
    label = np.array([labels[k] for k in keep], dtype=float)
    if not (label > 0).any() or not (label == 0).any():
        return None
    counts = Counter(w for k in keep for w in sets[k])
    words = sorted(counts)
    index = {w: k for k, w in enumerate(words)}
    docs = [np.array(sorted(index[w] for w in sets[k])) for k in keep]
    del sets, counts, index
    landmarks, telling, cut = choose_landmarks(words, docs, label)
    near = kernel(words, landmarks)
    values, vectors = np.linalg.eigh(kernel(landmarks, landmarks).astype(float))
    use = values > 1e-3
    white = vectors[:, use] / np.sqrt(values[use])
    features = np.empty((len(words), int(use.sum())), dtype=np.float32)
    for start in range(0, len(words), 8192):
        features[start:start + 8192] = near[start:start + 8192].astype(np.float32) @ white.astype(np.float32)
    score = (near[:, :len(telling)].astype(np.float32) - cut.astype(np.float32)).max(axis=1)
    del near
    toxic = [d for d, y in zip(docs, label) if y > 0 and score[d].max() > 0]
    clean = [d for d, y in zip(docs, label) if y == 0]
    if not toxic:
        return None
    mined = [d for k, d in enumerate(clean) if k % 4] or clean
    in_clean = np.zeros(len(words), dtype=bool)
    for d in mined:
        in_clean[d] = True
    hard = set(np.flatnonzero(in_clean)[::max(1, int(in_clean.sum()) // 3000)].tolist())
    positive: set[int] = set()
    for _ in range(6):
        for d in toxic:
            own = d[~in_clean[d]]
            positive.update(own[np.argsort(-score[own], kind="stable")[:1]].tolist())
        for d in mined:
            hard.update(d[np.argsort(-score[d], kind="stable")[:2]].tolist())
        yes, no = np.array(sorted(positive), dtype=np.int64), np.array(sorted(hard), dtype=np.int64)
        if not len(yes):
            return None
        x = np.concatenate([features[yes], features[no]]).astype(float)
        w, bias = svm(x, np.concatenate([np.ones(len(yes)), -np.ones(len(no))]), 1.0 * len(x))
        score = (features @ w + bias).astype(float)
    margins = np.array([top_two(score[d]) for d in toxic + clean])
    weights, shift = logistic(margins, np.repeat([1.0, 0.0], [len(toxic), len(clean)]))
    beta = white @ w
    code, lengths = codes(landmarks)
    table = np.zeros(_LETTERS ** 3, dtype=np.float32)
    scale = beta / norms(lengths)
    for ids, g in triples(code):
        np.add.at(table, ids, (scale * g)[:, None].astype(np.float32))
    table[0] = 0
    return Model(table, bias, weights, shift)


def fold(id_col):
    """crc32 of the id as text, modulo 3."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(3))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic") -> Model | None:
    """Fit on the bounded sample of labelled documents outside the held-out fold.

    A task holds the sample and the kernel matrices; the driver gets the model alone.
    """
    known = labels.where(F.col(label_col).isNotNull() & (fold(F.col("doc_id")) != 1)).groupBy("doc_id").agg(F.max(label_col).alias("y"))
    ranked = [known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_DOCS) for y in (0, 1)]
    sample = F.broadcast(ranked[0].union(ranked[1]))  # at most 2 * MAX_DOCS ids
    rows = docs.select("doc_id", "text").where(F.length("text") <= MAX_CHARS).join(sample, "doc_id").select("doc_id", "text", F.col("y").cast("int"))
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        known = sorted({tuple(r.values()) for batch in batches for r in batch.to_pylist()})
        model = fit([t for _, t, _ in known], [y for _, _, y in known])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], type=pa.binary())], names=["model"])

    found = rows.repartition(1).mapInArrow(run, "model binary").collect()  # one weight a feature: 1 MB
    return pickle.loads(found[0].model) if found else None


class Scorer:
    """Document scores with a cache of word margins."""

    def __init__(self, model: Model | None):
        self.model, self.known = model, {}

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.model is None:
            return np.zeros(len(texts))
        split = [tokens(t) for t in texts]
        new = list(set().union(*split).difference(self.known))
        if len(self.known) + len(new) > _MAX_WORDS:
            self.known.clear()
            new = list(set().union(*split))
        if new:
            self.known.update(zip(new, self.model.margins([plain(w) for w in new]).tolist()))
        look = self.known.__getitem__
        return self.model.probability(np.array([self.top(w, look) for w in split]))

    @staticmethod
    def top(words: list[str], look) -> tuple[float, float]:
        """The two largest margins among distinct words; spellings that differ in case or marks are one word."""
        best = second = EMPTY_MARGIN
        top = None
        for margin, w in sorted(((look(w), w) for w in set(words)), reverse=True):
            if top is None:
                top, best = plain(w), margin
            elif plain(w) != top:
                second = margin
                break
        return best, second


def score_documents(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one weight a feature: 1 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        scorer = Scorer(shared.value)
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scorer.scores(texts_of(batch)))], names=["doc_id", "score"])

    scored = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id bigint, score double")
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, whole, that score below the threshold."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        scorer = Scorer(shared.value)
        for batch in slices(batches, text_col):
            yield batch.filter(pa.array(scorer.scores(texts_of(batch, text_col)) < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, train(docs, table(spark, sf_dir, "labels")))
