"""Toxicity by compression distance: zstandard dictionaries of toxic and of ordinary text.

The ordinary dictionary is zstandard's own training over windows of ordinary documents. The toxic one
holds, in front of the same ordinary content, the pieces (starts of words) that toxic documents have
many times as often as ordinary ones; ordinary compression gets filler of the same length there, so that
both differ in nothing else. A window of ``WINDOW`` words is compressed with both; what the toxic
dictionary saves is the window's distance. A logistic curve over a document's distances is calibrated on
the labelled sample, and moved so that the score of the best F1 threshold there is ``THRESHOLD``.

Labels come from a bounded sample (``per_class`` documents of each label, in the order of a hash); near
copies in it count once. Everything else covers all rows and whole texts; scoring is one narrow pass, and
what tasks receive are two dictionaries of some 20 KB.

Null and empty texts have no windows and get the score of a document without distance. Without labels of
both kinds the score is 0 for all. Repeated rows are scored as given; empty tables give empty results;
input columns named as a result column are replaced. Labels that are null, or neither 0 nor 1, are not used.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField

from plaudit.llm.common import add_columns, lower_ascii, spaced_words, texts_of

WINDOW = 8
THRESHOLD = 0.7
ORDINARY_BYTES = 16384
#: Stands before every window, so that each compresses and only matches make the difference.
PRIMER = b" " * 64
#: Pieces: word starts of these lengths, with the blank before; whole words have the blank after, too.
SHORTEST, LONGEST = 5, 14
#: A piece is toxic if it is this many times as frequent, in this share of toxic documents, at least this often.
RATIO, SHARE, LEAST = 10.0, 0.025, 3
FIELDS = [StructField("score", DoubleType()), StructField("predicted", IntegerType())]


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]


def words_of(text: bytes | None) -> list[bytes]:
    return spaced_words(lower_ascii(text or b""))


def windows_of(words: list[bytes]) -> list[bytes]:
    return [b" " + b" ".join(words[i:i + WINDOW]) + b" " for i in range(0, len(words), WINDOW)]


def pieces_of(words: list[bytes]) -> set[bytes]:
    found = set()
    for word in set(words):
        padded = b" " + word + b" "
        found.update(padded[:n] for n in range(SHORTEST, min(len(padded), LONGEST) + 1))
        if len(padded) <= LONGEST + 4:
            found.add(padded)
    return found


def without_near_copies(texts: list[list[bytes]]) -> list[list[bytes]]:
    """The first text of each least hash of five words."""
    first: dict[int, list[bytes]] = {}
    for words in texts:
        key = min((zlib.crc32(b" ".join(words[i:i + 5])) for i in range(max(1, len(words) - 4))), default=0)
        first.setdefault(key, words)
    return list(first.values())


def toxic_pieces(toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> list[bytes]:
    """Short pieces that tell toxic documents, each as long as it keeps most of its documents; best last."""
    least = max(LEAST, SHARE * len(toxic))
    count: Counter = Counter()
    for words in toxic:
        count.update(pieces_of(words))
    frequent = {piece for piece, many in count.items() if many >= least}
    other: Counter = Counter()
    for words in ordinary:
        other.update(pieces_of(words) & frequent)
    rate = {
        piece: (count[piece] / len(toxic), (other[piece] + 0.5) / len(ordinary)) for piece in frequent}
    good = {piece: a / math.sqrt(b) for piece, (a, b) in rate.items() if a > RATIO * b}
    roots = [p for p in good if not any(p[:n] in good for n in range(SHORTEST, len(p)))]
    chosen = []
    for piece in roots:
        longer = [q for q in good if q.startswith(piece) and count[q] >= 0.7 * count[piece]]
        chosen.append(max(longer, key=lambda q: (len(q), q)))
    return sorted(chosen, key=lambda p: (good[p], p))


class Distance:
    """Compressed lengths of windows with both dictionaries. The fast strategy leaves literals alone."""

    def __init__(self, model: Model):
        self.ordinary, self.toxic = self._compressor(model.ordinary), self._compressor(model.toxic)

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        parameters = zstandard.ZstdCompressionParameters(
            window_log=17, chain_log=16, hash_log=17, search_log=4, min_match=5, target_length=1,
            strategy=zstandard.STRATEGY_FAST, write_content_size=0, write_checksum=0, write_dict_id=0)
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(compression_params=parameters)
        return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=parameters)

    def features(self, words: list[bytes]) -> tuple[float, float, float]:
        """Largest distance, logarithm of all distance beyond 1, logarithm of the number of windows."""
        plain, bad = self.ordinary.compress, self.toxic.compress
        most, total, many = 0, 0, 0
        for window in windows_of(words):
            primed = PRIMER + window
            saved = len(plain(primed)) - len(bad(primed))
            most = max(most, saved)
            total += max(0, saved - 1)
            many += 1
        return float(most), math.log1p(total), math.log1p(many)


def _curve(features: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(features @ weights[1:] + weights[0], -30, 30)))


def calibrate(features: np.ndarray, label: np.ndarray) -> tuple[float, ...]:
    """Logistic regression by Newton steps, then the shift that puts the best F1 at ``THRESHOLD``."""
    table = np.column_stack([np.ones(len(label)), features])
    weights = np.zeros(table.shape[1])
    for _ in range(30):
        guess = _curve(features, weights)
        slope = table.T @ (guess - label) + 0.01 * weights
        bend = (table * (guess * (1 - guess) + 1e-6)[:, None]).T @ table + 0.01 * np.eye(len(weights))
        weights = weights - np.linalg.solve(bend, slope)
    level = np.log(_curve(features, weights)) - np.log1p(-_curve(features, weights))
    order = np.argsort(-level, kind="stable")
    hits = np.cumsum(label[order])
    f1 = 2 * hits / (np.arange(1, len(label) + 1) + label.sum())
    f1[:-1][level[order][1:] == level[order][:-1]] = 0  # no cut between equal levels
    best = int(np.argmax(f1))
    below = level[order][best + 1] if best + 1 < len(label) else level[order][best] - 1
    cut = (level[order][best] + below) / 2
    weights[0] += math.log(THRESHOLD / (1 - THRESHOLD)) - cut
    return tuple(float(w) for w in weights)


def train(toxic: list[bytes | None], ordinary: list[bytes | None]) -> Model | None:
    bad = without_near_copies([words_of(t) for t in toxic])
    good = without_near_copies([words_of(t) for t in ordinary])
    if not bad or not good:
        return None
    samples = [w for words in good for w in windows_of(words)]
    try:
        base = zstandard.train_dictionary(ORDINARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too few windows to train on: they are the dictionary themselves
        base = b"".join(samples)[-ORDINARY_BYTES:]
    pieces = b"".join(toxic_pieces(bad, good))
    model = Model(bytes([1]) * len(pieces) + b" " * 8 + base, pieces + b" " * 8 + base, ())
    distance = Distance(model)
    features = np.array([distance.features(w) for w in [*bad, *good]])
    label = np.array([1.0] * len(bad) + [0.0] * len(good))
    return Model(model.ordinary, model.toxic, calibrate(features, label))


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, per_class: int) -> Model | None:
    """Trains on at most ``per_class`` rows of each label."""
    chosen = labels.select(F.col(key).alias("key"), F.col(label).alias("label"))
    found = {}
    for value in (1, 0):
        # Ids are limited first, so that texts of the sample alone reach the driver.
        ids = (
            chosen.filter(F.col("label") == value).select("key").distinct()
            .orderBy(F.xxhash64("key"), "key").limit(per_class))
        rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(ids, "key").collect()
        rows.sort(key=lambda r: (zlib.crc32(str(r[0]).encode()), str(r[0])))
        found[value] = [r[1].encode() if r[1] is not None else None for r in rows]
    return train(found[1], found[0])


def held_out(key, folds: int = 3, fold: int = 1):
    """Rows whose labels are never looked at."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % folds == fold, F.lit(False))


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    per_class: int = 2500,
) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 from ``THRESHOLD`` on); learns outside ``held_out``."""
    model = labelled_sample(docs, labels.filter(~held_out(key)), key, text, label, per_class)

    def make():
        distance = Distance(model) if model else None

        def step(batch: pa.RecordBatch):
            if distance is None:
                return [0.0] * batch.num_rows, [0] * batch.num_rows
            features = np.array([distance.features(words_of(t)) for t in texts_of(batch.column(0))])
            scores = _curve(features, np.array(model.weights)) if len(features) else np.zeros(0)
            return scores.tolist(), (scores >= THRESHOLD).astype(int).tolist()

        return step

    return add_columns(docs, [text], FIELDS, make)
