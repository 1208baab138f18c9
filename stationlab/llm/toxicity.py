"""Toxicity by multiple-instance learning: only documents are labelled, sentences are scored.

A sentence's probability is a logistic function of its words; a document is toxic if
at least one of its sentences is, so its score is their noisy-or,
1 - prod(1 - p).  The weights are those that make the document labels likely:
with z the sentence's score, log(1 - p) = -softplus(z), so a document's
S = sum softplus(z) gives score 1 - exp(-S), and the gradient of its log-likelihood
is -sigmoid(z) for label 0 and sigmoid(z) exp(-S) / (1 - exp(-S)) for label 1.

Features of a word: the word and its first 4, 5 and 6 letters, hashed to 2 ** 20
places; a feature counts if at least ``MIN_DOCS`` toxic documents of the sample hold it, and
more of them than chance explains (``MIN_LIFT`` standard deviations).

The fit uses a bounded sample of labelled rows: the first ``SAMPLE_DOCS`` training ids by
hash, texts of at most ``SAMPLE_WORDS`` words.  Scoring covers every whole text.
Labels, lang, source and doc_id are no inputs of a score.

Defined results: null and empty texts have no sentence and score 0; without labelled
rows, or with one label only, the weights stay at their start (scores near 0);
conflicting labels of one doc_id count as toxic; null labels are left out; equal
texts get equal scores; other columns are not read.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlab.llm.common import column_bytes, column_list, slices
from stationlab.llm.word_tokens import Memory

SAMPLE_DOCS = 8000
SAMPLE_WORDS = 3000
MIN_DOCS = 3
MIN_LIFT = 4.0
PLACES = 1 << 20
THRESHOLD = 0.7
STEPS, RATE, DECAY, START = 150, 0.2, 2e-5, -6.0
# Sentences end at . ! ? and line ends; other ASCII marks and digits become spaces.
SENTENCES = bytes(10 if b in b".!?\n" else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def sentences_of(data: bytes | None) -> list:
    """Lists of words."""
    if not data:
        return []
    low = data.decode().lower().encode().translate(SENTENCES)
    return [w for s in low.split(b"\n") if (w := s.split())]


def word_features(word: bytes) -> list:
    import xxhash
    letters = word.decode()
    parts = {letters, *(letters[:k] + "*" for k in (4, 5, 6) if len(letters) > k)}
    return [xxhash.xxh3_64_intdigest(p) % PLACES for p in sorted(parts)]


class ToxicModel:
    def __init__(self, places: np.ndarray, weights: np.ndarray, bias: float):
        self.weights = dict(zip(places.tolist(), weights.tolist(), strict=True))
        self.bias = bias

    def prepare(self) -> None:
        get = self.weights.get
        self.words = Memory(lambda w: sum(get(f, 0.0) for f in word_features(w)))

    def sentence(self, words: list) -> float:
        return self.bias + sum(map(self.words.__getitem__, words))

    def document(self, data: bytes | None) -> float:
        total = 0.0
        for words in sentences_of(data):
            z = self.sentence(words)
            total += math.log1p(math.exp(z)) if z < 30 else z
        return -math.expm1(-total)

    def offending(self, data: bytes) -> list:
        """(start, end, probability) of the sentences likelier toxic than not, in code points."""
        text, out = data.decode(), []
        for m in re.finditer(r"[^.!?\n]+", text):
            for words in sentences_of(m.group().encode()):
                z = self.sentence(words)
                if z > 0:
                    out.append((m.start(), m.end(), 1 / (1 + math.exp(-z))))
        return out


def in_training(id_column: Column) -> Column:
    """Rows whose labels may be learned; a row without id has no label and is not held out."""
    return F.coalesce(F.crc32(id_column.cast("string")) % 3 != 1, F.lit(True))


def training_sample(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_words: int = SAMPLE_WORDS,
                    text: str = "text", id_column: str = "doc_id", label: str = "toxic") -> list:
    """(label, sentences of words) of the bounded sample."""
    ids = (labels.select(F.col(id_column).alias("id"), F.col(label).cast("int").alias("y")).dropna()
           .filter(in_training(F.col("id"))).groupBy("id").agg(F.max("y").alias("y"))
           .orderBy(F.xxhash64("id"), "id").limit(sample_docs))
    words = F.regexp_count(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+"))
    rows = (docs.select(F.col(id_column).alias("id"), F.col(text).alias("text")).join(F.broadcast(ids), "id")
            .filter(F.col("text").isNotNull() & (words <= sample_words)).orderBy(F.xxhash64("id"), "id", "text").limit(sample_docs).collect())
    return [(int(r["y"] > 0), sentences_of(r["text"].encode())) for r in rows]


def fit(sample: list, steps: int = STEPS, rate: float = RATE, decay: float = DECAY, min_docs: int = MIN_DOCS) -> ToxicModel:
    """Full-batch Adam on the noisy-or likelihood of the document labels."""
    known: dict = {}
    word_ids, sentence_sizes, doc_sizes, labels = [], [], [], []
    doc_words = []
    for y, sentences in sample:
        if not sentences:
            continue
        labels.append(y)
        doc_sizes.append(len(sentences))
        ids = [[known.setdefault(w, len(known)) for w in s] for s in sentences]
        sentence_sizes += map(len, ids)
        flat = [i for s in ids for i in s]
        word_ids += flat
        doc_words.append(np.unique(np.array(flat)))
    if len(set(labels)) < 2:
        return ToxicModel(np.zeros(0, np.int64), np.zeros(0), START)
    per_word = [word_features(w) for w in known]
    word_of = np.repeat(np.arange(len(per_word)), [len(f) for f in per_word])
    places, feature_of = np.unique(np.concatenate(per_word), return_inverse=True)
    # documents that hold a feature
    y = np.array(labels)
    held = _holders(doc_words, per_word, places)
    n_docs = np.bincount(np.concatenate(held), minlength=len(places))
    n_toxic = np.bincount(np.concatenate([h for h, t in zip(held, labels, strict=True) if t]), minlength=len(places))
    # a score test of independence picks the features that toxic documents hold more often
    share = y.mean()
    lift = (n_toxic - share * n_docs) / np.sqrt(np.maximum(n_docs, 1) * share * (1 - share))
    active = ((n_toxic >= min_docs) & (lift >= MIN_LIFT))[feature_of]
    word_of, feature_of = word_of[active], feature_of[active]
    word_ids = np.array(word_ids)
    sentence_of = np.repeat(np.arange(len(sentence_sizes)), sentence_sizes)
    doc_of = np.repeat(np.arange(len(doc_sizes)), doc_sizes)
    first_sentence = np.concatenate(([0], np.cumsum(doc_sizes)[:-1]))
    first_word = np.concatenate(([0], np.cumsum(sentence_sizes)[:-1]))
    w, bias = np.zeros(len(places)), START
    boost = ((1 - share) / share) ** 0.25        # the rarer label counts somewhat more
    idle = np.ones(len(places), bool)
    idle[feature_of] = False
    m, v = np.zeros(len(places) + 1), np.zeros(len(places) + 1)
    for t in range(1, steps + 1):
        per = np.bincount(word_of, w[feature_of], len(per_word))
        z = bias + np.add.reduceat(per[word_ids], first_word)
        soft = np.logaddexp(0.0, z)
        total = np.maximum(np.add.reduceat(soft, first_sentence), 1e-12)
        pull = np.where(y == 1, -boost * np.exp(-total) / -np.expm1(-total), 1.0)
        gz = pull[doc_of] / (1.0 + np.exp(-np.clip(z, -500, 500))) / len(y)
        gw = np.bincount(word_ids, gz[sentence_of], len(per_word))
        grad = np.append(np.bincount(feature_of, gw[word_of], len(places)) + decay * w, gz.sum())
        grad[:-1][idle] = 0.0
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w -= step[:-1]
        bias -= step[-1]
    used = np.flatnonzero(w)
    return ToxicModel(places[used], w[used], float(bias))


def _holders(doc_words: list, per_word: list, places: np.ndarray) -> list:
    """Per document the distinct features (as indexes into ``places``) that it holds."""
    sizes = np.array([len(f) for f in per_word])
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    flat = np.searchsorted(places, np.concatenate(per_word))
    out = []
    for d in doc_words:
        own = np.repeat(starts[d], sizes[d]) + np.concatenate([np.arange(k) for k in sizes[d]]) if len(d) else d
        out.append(np.unique(flat[own]))
    return out


def toxicity_scores(docs: DataFrame, model: ToxicModel, text: str = "text", id_column: str = "doc_id",
                    threshold: float = THRESHOLD) -> DataFrame:
    """Per row: ``id_column``, score, predicted, and for predicted rows the offending sentences (start, end, p)."""
    kind = docs.schema[id_column].dataType.simpleString()
    source = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))

    def run(batches):
        m = shared.value
        m.prepare()
        for batch in batches:
            for part in slices(batch):
                texts = column_bytes(part, "text")
                scores = [m.document(t) for t in texts]
                found = [[{"start": a, "end": b, "p": p} for a, b, p in m.offending(t)] if s >= threshold else []
                         for t, s in zip(texts, scores, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32()),
                     pa.array(found, place)], [id_column, "score", "predicted", "sentences"])

    return source.mapInArrow(run, f"{id_column} {kind}, score double, predicted int, sentences array<struct<start:bigint,end:bigint,p:double>>")


def learn_and_score(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    return toxicity_scores(docs, fit(training_sample(docs, labels, sample_docs)))
