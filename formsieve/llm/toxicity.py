"""Operator 2: toxicity by a subsequence string kernel, Nystroem landmarks and a linear SVM.

Units.  A text's units are its words as bytes: A-Z lowered, look-alike digits and signs
read as letters, other ASCII signs left out, and every byte of other letters one symbol, with a mark at either end; runs of three
or more single characters ("i d i o t") add their letters as one more unit.

Kernel.  A unit's features are its subsequences of three symbols within a span of six,
each weighing ``DECAY`` to the power of its span, so a gapped or inserted character lowers a match
without breaking it; the kernel of two units is the cosine of their features.

Training, on the driver over a bounded sample of labelled documents (about ``TOXIC_DOCS`` and ``CLEAN_DOCS``, each of at most ``SAMPLE_CHARS``):
sentences take their document's label.  Landmarks are the units that most mark toxic sentences, and
common units of clean ones; K(x, L) K(L, L)^(-1/2) are a unit's Nystroem features.  A linear SVM separates
the telling units of toxic sentences, and copies of them with one or two symbols put in, from units of clean
ones; each round adds the highest-scoring clean units as hard negatives.
A logistic curve maps a document's highest unit to a score.

Scoring.  K(x, L) is linear in x's features, so weights, whitening and landmarks multiply
into one vector over the features, exactly: a unit's value is one sparse product.  Each task keeps
values per word in a bounded memo; a document's value is its highest unit's.

Edge cases: a null or empty text has no unit and gets the lowest value any unit can have;
without labelled documents of both kinds, or units that tell them apart, every score is 0; repeated rows get equal scores; repeated or null labels of a
document: the highest, null is no label; an empty table gives an empty result; labels, language, source and id are never read for a score.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_texts, crc_rest, slices

TOXIC_DOCS = 1000
CLEAN_DOCS = 2000
#: Longer labelled documents are scored like any other, but not learned from: the sample passes the driver.
SAMPLE_CHARS = 100_000
LANDMARKS = 240
ROUNDS = 3
DECAY = 0.6
SPAN = 6
SYMBOLS = 29  # a-z, other letters, the beginning and the end of a unit
#: A telling unit stands this many times more often in toxic sentences than in clean ones.
MANY_TIMES = 10
#: ... and in this many different toxic sentences (copies count once); so many units are taken at most.
LEAST_SENTENCES = 4
COST = 100.0
MOST_WEIGHT = 100
TELLING = 400
LONGEST = 24
MEMO_ENTRIES = 250_000

#: Signs read as the letter they resemble.
ALIKE = {ord(a): ord(b) for a, b in zip("013457@$", "oieastas")}
TABLE = bytes(ALIKE.get(c, c + 32 if 65 <= c <= 90 else 0x7B if c >= 128 else c) for c in range(256))
DROP = bytes(c for c in range(128) if not (65 <= c <= 90 or 97 <= c <= 122 or c in ALIKE))
SPELLED = re.compile(rb"(?:^|(?<=[\x20\x09-\x0D]))(?:[^\x20\x09-\x0D][\x20\x09-\x0D]+){2,}[^\x20\x09-\x0D](?=[\x20\x09-\x0D]|$)")
SENTENCE = re.compile(rb"(?<=[.!?])[\x20\x09-\x0D]+|\n")
GAPS = [(a, b) for a in range(1, SPAN - 1) for b in range(1, SPAN - a)]


def plain(word: bytes) -> bytes:
    return word.translate(TABLE, DROP)


def spelled(text: bytes) -> list[bytes]:
    """Letters of runs of single characters."""
    return [b"".join(m.split()) for m in SPELLED.findall(text)]


def features(units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(index, value) arrays, a row per unit: its subsequences, equal ones summed, unit length.
    Symbols after ``LONGEST`` count in windows of their own (see ``pieces``)."""
    units = [b"|" + u + b"}" for u in units]  # the bytes after z and the symbol of other letters
    width = max(map(len, units))
    c = np.full((len(units), width), -1, np.int64)
    flat = np.frombuffer(b"".join(units), np.uint8).astype(np.int64) - 97
    sizes = np.array([len(u) for u in units])
    c[np.arange(width)[None, :] < sizes[:, None]] = flat
    index, value = [], []
    for a, b in GAPS:
        if a + b >= width:
            continue
        x, y, z = c[:, :width - a - b], c[:, a:width - b], c[:, a + b:]
        fine = z >= 0
        index.append(np.where(fine, (x * SYMBOLS + y) * SYMBOLS + z, -1))
        value.append(np.where(fine, DECAY ** (a + b - 2), 0.0))
    index, value = np.concatenate(index, 1), np.concatenate(value, 1)
    order = np.argsort(index, axis=1)
    index, value = np.take_along_axis(index, order, 1), np.take_along_axis(value, order, 1)
    # equal subsequences of a unit: their sum at the last of them
    total = np.cumsum(value, 1)
    last = np.concatenate([index[:, 1:] != index[:, :-1], np.ones((len(units), 1), bool)], 1) & (index >= 0)
    upto = np.where(last | (index < 0), total, 0)
    before = np.concatenate([np.zeros((len(units), 1)), np.maximum.accumulate(upto, 1)[:, :-1]], 1)
    value = np.where(last, total - before, 0.0)
    norm = np.sqrt((value ** 2).sum(1, keepdims=True))
    return np.where(last, index, 0), value / np.where(norm > 0, norm, 1)


def pieces(unit: bytes) -> list[bytes]:
    """A unit, or overlapping windows of a very long one."""
    if len(unit) <= LONGEST:
        return [unit]
    return [unit[i:i + LONGEST] for i in range(0, len(unit) - LONGEST // 2, LONGEST // 2)]


def values(units: list[bytes], weights: np.ndarray, bias: float) -> np.ndarray:
    """SVM value of each unit; the highest window of a very long one."""
    out = np.full(len(units), bias)
    parts = [(i, p) for i, u in enumerate(units) if len(u) > 2 for p in pieces(u)]
    # of similar length, so that no row is mostly padding
    parts.sort(key=lambda x: len(x[1]))
    owner = np.array([i for i, _ in parts], np.int64)
    for at in range(0, len(parts), 4096):
        index, value = features([p for _, p in parts[at:at + 4096]])
        np.maximum.at(out, owner[at:at + 4096], (weights[index] * value).sum(1) + bias)
    return out


# ------------------------------------------------------------------ training

def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Linear SVM (squared hinge, last column a bias) by Newton steps on the active rows."""
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    for _ in range(rounds):
        active = y * (x @ w) < 1
        xa, ca = x[active], cost[active]
        new = np.linalg.solve(ridge + xa.T @ (xa * ca[:, None]), xa.T @ (ca * y[active]))
        if np.allclose(new, w, atol=1e-8):
            break
        w = new
    return w


def _dense(units: list[bytes]) -> np.ndarray:
    index, value = features(units)
    out = np.zeros((len(units), SYMBOLS ** 3), np.float32)
    np.add.at(out, (np.arange(len(units))[:, None], index), value)
    return out


def _products(units: list[bytes], landmarks: np.ndarray) -> np.ndarray:
    """K(units, landmarks)."""
    out = []
    for at in range(0, len(units), 1024):
        index, value = features(units[at:at + 1024])
        out.append(np.stack([(row[index] * value).sum(1) for row in landmarks], 1))
    return np.concatenate(out)


def train(toxic: list[bytes], clean: list[bytes], landmarks: int = LANDMARKS) -> dict:
    """Weights over the subsequences, bias, and the logistic curve of documents' values."""
    def sentences(texts):
        return [[u for w in s.split() if len(u := plain(w)[:LONGEST]) > 2] + [u for r in spelled(s) if len(u := plain(r)[:LONGEST]) > 2]
                for s in sorted({s for t in texts for s in SENTENCE.split(t)})]

    bad, good = [s for s in sentences(toxic) if s], [s for s in sentences(clean) if s]
    in_bad, in_good = Counter(u for s in bad for u in set(s)), Counter(u for s in good for u in set(s))
    if not in_bad or not in_good:
        return {}
    n_bad, n_good = len(bad), len(good)

    def odds(u: bytes) -> float:
        """How many times more often toxic sentences hold it than clean ones, smoothed, as a logarithm."""
        return np.log((in_bad[u] + 0.5) / (n_bad + 1)) - np.log((in_good[u] + 0.5) / (n_good + 1))

    def tells(u: bytes) -> float:
        return in_bad[u] / n_bad * max(0.0, odds(u) - np.log(MANY_TIMES))

    ranked = sorted((u for u in in_bad if in_bad[u] >= LEAST_SENTENCES and tells(u) > 0), key=lambda u: (-tells(u), u))
    telling = ranked[:TELLING]
    if not telling:
        return {}
    common = [u for u, _ in sorted(in_good.items(), key=lambda x: (-x[1], x[0]))]
    marks = telling[:2 * landmarks // 3]
    marks += [u for u in common if u not in set(telling)][:landmarks - len(marks)]
    phi = _dense(marks)
    gram = (phi @ phi.T).astype(np.float64)
    size, turn = np.linalg.eigh(gram)
    root = turn @ np.diag(1 / np.sqrt(np.maximum(size, 1e-3))) @ turn.T  # K(L, L)^(-1/2), ridged

    rng = np.random.default_rng(2)
    pool = sorted(in_good)
    negative = set(common[:2000]) | {pool[i] for i in rng.choice(len(pool), min(len(pool), 6000), replace=False)}
    positive, known = set(telling), set(telling)
    for u in (u for u in telling if len(u) > 3):
        for n in (1, 1, 1, 2):
            longer = bytearray(u)
            for _ in range(n):
                longer.insert(int(rng.integers(1, len(longer))), int(rng.integers(97, 123)))
            if bytes(longer) not in in_good:
                positive.add(bytes(longer))
    model = {}
    for _ in range(ROUNDS):
        units = sorted(positive) + sorted(negative - positive)
        y = np.where(np.arange(len(units)) < len(positive), 1.0, -1.0)
        x = _products(units, phi) @ root
        # a unit weighs as often as sentences hold it; lengthened copies weigh once
        held = [(in_bad if u in known else in_good).get(u, 0) for u in units]
        cost = COST * np.clip(held, 1, MOST_WEIGHT)
        w = _svm(np.column_stack([x, np.ones(len(x))]), y, cost)
        # weights over landmarks times their features: one vector over the subsequences
        model = {"weights": ((root @ w[:-1]) @ phi).astype(np.float64), "bias": float(w[-1])}
        every = sorted({*in_bad, *in_good})
        value = dict(zip(every, values(every, model["weights"], model["bias"]).tolist()))
        hard = sorted(in_good, key=lambda u: (-value[u], u))[:3000]
        negative |= set(hard)

    lowest = min(value.values())
    def highest(texts):
        out = []
        for t in texts:
            held = {u for w in t.split() if len(u := plain(w)[:LONGEST]) > 2 and u in value}
            out.append(max((value[u] for u in held), default=lowest))
        return np.array(out)

    z = np.concatenate([highest(toxic), highest(clean)])
    y = np.concatenate([np.ones(len(toxic)), np.zeros(len(clean))])
    model["curve"], model["lowest"] = _logistic(z, y), lowest
    return model


def _logistic(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a ridged logistic regression (Newton)."""
    x, w = np.column_stack([z, np.ones(len(z))]), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (y - p) - 0.05 * w
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 0.05 * np.eye(2), grad)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def training_sample(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, toxic_docs: int = TOXIC_DOCS, clean_docs: int = CLEAN_DOCS,
                    id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> tuple[list[bytes], list[bytes]]:
    """Texts of a bounded, hash-chosen sample of labelled documents outside the held-out fold."""
    usable = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (crc_rest(F.col(id_col), folds) != held))
              .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label")))
    counts = {r["label"]: r["count"] for r in usable.where(F.col("label").isin(0, 1)).groupBy("label").count().collect()}
    draw = F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1_000_000))
    share = F.when(F.col("label") == 1, F.lit(1e6 * toxic_docs / max(1, counts.get(1, 0)))).otherwise(F.lit(1e6 * clean_docs / max(1, counts.get(0, 0))))
    # the ids drawn are at most about the bound, whatever the number of labels: a checked broadcast
    chosen = usable.where(F.col("label").isin(0, 1) & (draw < share))
    short = docs.where(F.length(text_col) <= SAMPLE_CHARS).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # equal texts teach once; an id that very many rows share cannot pass the bound either
    held = short.join(F.broadcast(chosen), "id").select("label", "text").distinct()
    rows = held.orderBy(F.xxhash64("text"), "label", "text").limit(2 * (toxic_docs + clean_docs)).collect()
    return ([r["text"].encode() for r in rows if r["label"] == 1 and r["text"]], [r["text"].encode() for r in rows if r["label"] == 0 and r["text"]])


# ------------------------------------------------------------------ scoring

class Scorer:
    def __init__(self, model: dict):
        self.model, self.memo = model, {}

    def batch(self, texts: list[bytes | None]) -> np.ndarray:
        model = self.model
        if not model:
            return np.zeros(len(texts))
        if len(self.memo) > MEMO_ENTRIES:
            self.memo.clear()
        memo = self.memo
        split = [(t or b"").translate(TABLE).split() for t in texts]
        for words, t in zip(split, texts):
            if t:
                words += [u.translate(TABLE) for u in spelled(t)]
        todo = list(set().union(*split).difference(memo))
        memo.update(zip(todo, values([w.translate(None, DROP) for w in todo], model["weights"], model["bias"]).tolist()))
        z = np.array([max([memo[w] for w in words], default=model["lowest"]) for words in split])
        slope, offset = model["curve"]
        return 1 / (1 + np.exp(-np.clip(slope * z + offset, -50, 50)))


_SCORERS: dict[int, Scorer] = {}


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = zlib.crc32(model["weights"].tobytes()) if model else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[key] = Scorer(shared.value)
        scorer = _SCORERS[key]
        for b in slices(batches):
            s = scorer.batch(byte_texts(b.column(1)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32), pa.int32())],
                                             names=[id_col, "score", "predicted"])

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return docs.select(id_col, text_col).mapInArrow(run, schema)
