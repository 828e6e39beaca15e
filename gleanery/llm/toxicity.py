"""Toxicity scores by a convolutional text classifier trained in numpy.

A word's vector is the sum of hashed embeddings of the word, its beginnings and its end, so unseen forms of a known
word are known too. Filters of several widths slide over the word vectors; each filter's largest response over
the whole text (max pooling) goes into a logistic output. The first embedding dimension starts as the smoothed
log-odds of each hash bucket over all labelled rows, which the first filter reads; everything is then trained by gradient
descent, in shards of the labelled rows that start alike and whose movements are averaged.
The decision threshold is calibrated for each language on rows kept out of the training; the language is guessed from
the text's own function words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import discard, materialize, parts, pick

#: Bytes of labelled texts that one task trains on; more texts make more tasks.
SHARD_BYTES = 12 << 20
#: Parts of one in which summed parameters and logits are counted, so that sums do not depend on their order.
_UNIT = 1 << 30
_BINS = 1000
_WIDE = 16
#: Labels of so many neighbouring ids (as a power of two) are one row, and packed labels of so many bytes are broadcast.
_NEAR_BITS = 10
_BROADCAST = 64 << 20
BUCKETS = 1 << 16
WIDTHS = (1, 2, 3)
FILTERS = 8
DIMENSIONS = 16
EPOCHS = 4
#: Words whose filter responses a Python worker remembers.
REMEMBERED = 100_000
TOGETHER = 4 << 20

#: Frequent function words by language, which tell languages apart.
FUNCTION_WORDS = {
    "de": "aber als am an auch auf aus bei das dem den der des die ein eine einer einen er es für im in ist mit nicht "
    "sie sich und von war wie wird zu zum zur",
    "en": "a and are as at be by for from he in is it not of on or that the this to was were which with",
    "es": "al como con de del el en es la las lo los más no para por que se su un una y ya",
    "fr": "au aux avec ce dans de des du elle en est et il la le les mais ne pas pour que qui se sur un une",
}
_WORD = re.compile(r"\w+")
#: Of each character of one byte itself if words may hold it, else a space.
_SPACED = bytes(i if _WORD.match(chr(i)) else 32 for i in range(256))
#: Bytes of a word up to which hashes are computed for many words at once.
_LONG = 64


def words(text: str) -> list[str]:
    lower = text.lower()
    try:  # faster where all characters have one byte
        return lower.encode("latin-1").translate(_SPACED).decode("latin-1").split()
    except UnicodeEncodeError:
        return _WORD.findall(lower)


def buckets(word: str) -> tuple[int, int, int, int]:
    """Hash buckets of the word, its first four and five letters, and its last four."""
    return tuple(zlib.crc32(x.encode()) % BUCKETS for x in (word, "<" + word[:4], "<" + word[:5], word[-4:] + ">"))


def _crc(register: np.ndarray | np.uint32, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 registers moved on by the bytes from ``begin`` to ``end``, for many ranges at once."""
    order = np.argsort(begin - end, kind="stable")  # longest first
    out, at, sizes = np.broadcast_to(register, begin.shape)[order], begin[order], (end - begin)[order]
    for i, n in enumerate(np.searchsorted(-sizes, -np.arange(sizes[0])).tolist()):
        out[:n] = _CRC[(out[:n] ^ data[at[:n] + i]) & 255] ^ (out[:n] >> 8)
    back = np.empty_like(out)
    back[order] = out
    return back


def _quads(found: list[str]) -> np.ndarray:
    """The hash buckets of each word, as :func:`buckets` gives them, for many words at once."""
    if not found:
        return np.empty((0, 4), np.int32)
    data = np.frombuffer(("\0".join(found) + "\0").encode(), np.uint8)
    chars = np.flatnonzero((data & 0xC0) != 0x80)
    stop = np.flatnonzero(data[chars] == 0)
    first = np.r_[0, stop[:-1] + 1]
    begin, end, sizes = chars[first], chars[stop], stop - first
    four, five, tail = chars[first + np.minimum(sizes, 4)], chars[first + np.minimum(sizes, 5)], chars[stop - np.minimum(sizes, 4)]
    start = np.uint32(0xFFFFFFFF)
    long = np.flatnonzero(end - begin > _LONG)
    whole = _crc(start, data, begin, np.where(end - begin > _LONG, begin, end))
    whole[long] = [zlib.crc32(found[i].encode()) ^ 0xFFFFFFFF for i in long.tolist()]
    to_four = _crc(_CRC[(start ^ ord("<")) & 255] ^ (start >> 8), data, begin, four)
    to_five = _crc(to_four, data, four, five)
    last = _crc(start, data, tail, end)
    last = _CRC[(last ^ ord(">")) & 255] ^ (last >> 8)
    return (~np.stack([whole, to_four, to_five, last], axis=1) % BUCKETS).astype(np.int32)


_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, _CRC >> 1 ^ 0xEDB88320, _CRC >> 1).astype(np.uint32)


def language(found: list[str]) -> str:
    """The language with most function words among the words; "" if there are none."""
    counts = {k: 0 for k in FUNCTION_WORDS}
    for word, n in Counter(filter(_LANGUAGES.__contains__, found)).items():
        for k in _LANGUAGES[word]:
            counts[k] += n
    best = max(counts, key=counts.get)
    return best if counts[best] else ""


_LANGUAGES: dict[str, list[str]] = {}
for _k, _words in FUNCTION_WORDS.items():
    for _w in _words.split():
        _LANGUAGES.setdefault(_w, []).append(_k)
#: Of each function word, after a row for all other words, the languages that have it.
_HAS = np.array([[0] * len(FUNCTION_WORDS)] + [[int(k in v) for k in FUNCTION_WORDS] for v in _LANGUAGES.values()])


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


@dataclass
class Model:
    """Embeddings (bucket 0 of ``BUCKETS`` + 1 rows is the padding), filters by width, output, thresholds."""

    embeddings: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    output: np.ndarray
    offset: float
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.0

    def responses(self, quads: np.ndarray) -> np.ndarray:
        """The part of every filter's response that a word gives at each place of the filter."""
        vectors = _vectors(self.embeddings, quads)
        return np.concatenate([vectors @ w.reshape(k, DIMENSIONS, FILTERS)[j] for k, w in zip(WIDTHS, self.filters) for j in range(k)], axis=1)

    def logits(self, table: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Scores of texts whose words stand in ``ids`` (rows of ``table``), with padding behind each text."""
        pooled, at = [], 0
        ends = np.r_[starts[1:], len(ids)]
        for k, bias in zip(WIDTHS, self.biases):
            for j in range(k):
                part = np.take(np.ascontiguousarray(table[:, at : at + FILTERS]), ids, axis=0)
                if j:
                    total[:-j] += part[j:]
                else:
                    total = part
                at += FILTERS
            for back in range(1, k):
                total[ends - back] = -np.inf  # the filter would reach into the next text
            pooled.append(np.maximum(np.maximum.reduceat(total, starts, axis=0) + bias, 0))
        return np.concatenate(pooled, axis=1) @ self.output + self.offset

    def scores(self, logits: np.ndarray, languages: list[str]) -> np.ndarray:
        """Scores from 0 to 1 that cross 0.5 at the language's threshold."""
        return sigmoid(logits - np.array([self.thresholds.get(x, self.threshold) for x in languages]))


def _vectors(embeddings: np.ndarray, quads: np.ndarray) -> np.ndarray:
    """The sum of the embeddings of each word's buckets."""
    out = embeddings[quads[:, 0]]
    for i in range(1, quads.shape[1]):
        out += embeddings[quads[:, i]]
    return out


class _Rows(dict):
    """The row of each word in a table that begins with the padding; a word not met before gets the next one."""

    def __missing__(self, word: str) -> int:
        row = self[word] = len(self) + 1
        return row


class Scorer:
    """A model with the responses of the words it has met; function words stand first."""

    def __init__(self, model: Model):
        self.model = model
        self._reset()

    def _reset(self) -> None:
        self.rows = _Rows(zip(_LANGUAGES, range(1, len(_LANGUAGES) + 1)))
        quads = np.concatenate([np.full((1, 4), BUCKETS, np.int32), _quads(list(_LANGUAGES))])
        self.table = self.model.responses(quads).astype(np.float32)

    def texts(self, texts: list[str]) -> np.ndarray:
        logits, languages = self.logits(texts)
        return self.model.scores(logits, languages)

    def logits(self, texts: list[str]) -> tuple[np.ndarray, list[str]]:
        """The model's output for each text before any threshold, and the text's language."""
        if len(self.rows) > REMEMBERED:
            self._reset()
        met = len(self.rows)
        cut = [np.fromiter(map(self.rows.__getitem__, x), np.int32, len(x)) for x in map(words, texts)]
        sizes, found = np.array([len(x) for x in cut]), np.concatenate(cut)
        if new := list(islice(self.rows, met, None)):
            self.table = np.concatenate([self.table, self.model.responses(_quads(new)).astype(np.float32)])
        pad = max(WIDTHS) - 1
        text = np.repeat(np.arange(len(texts)), sizes)
        ids = np.zeros(len(found) + pad * len(texts), np.int32)
        ids[np.arange(len(found)) + pad * text] = found
        starts = np.cumsum(sizes + pad) - sizes - pad
        return self.model.logits(self.table, ids, starts), _languages(found, text, len(texts))


def _languages(found: np.ndarray, text: np.ndarray, n: int) -> list[str]:
    """:func:`language` of ``n`` texts, from the rows of their words and the text of each word."""
    at = np.flatnonzero(found < len(_HAS))
    met = np.bincount(text[at] * len(_HAS) + found[at], minlength=n * len(_HAS)).reshape(n, -1)
    counts, names = met @ _HAS, list(FUNCTION_WORDS)
    return [names[i] if most else "" for i, most in zip(counts.argmax(axis=1).tolist(), counts.max(axis=1).tolist())]


def _counts(quads: np.ndarray, texts: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """The number of clean and of toxic texts in which each bucket occurs."""
    counts, last = np.zeros((2, BUCKETS + 1), np.int64), np.empty(BUCKETS + 1, np.int64)
    for x, y in zip(texts, labels):
        found = quads[x].ravel()
        at = np.arange(len(found))
        last[found] = at
        counts[int(y), found[last[found] == at]] += 1
    return counts


def _log_odds(counts: np.ndarray, toxic: int, clean: int, smooth: float = 4.0) -> np.ndarray:
    """Of each bucket, from the number of toxic and clean texts in which it occurs."""
    scale = max(1, toxic) / max(1, clean)
    odds = np.log((counts[1] + smooth) / (counts[0] * scale + smooth))
    odds[BUCKETS] = 0
    return odds


def _start(odds: np.ndarray | None, seed: int = 11) -> tuple[Model, np.random.Generator]:
    """The model before any training, and the generator that made it; without odds there is nothing to learn from, and the
    model gives 0.5 less a little for every text."""
    rng = np.random.default_rng(seed)
    embeddings = rng.normal(0, 0.05, (BUCKETS + 1, DIMENSIONS))
    filters = [rng.normal(0, 0.1, (k * DIMENSIONS, FILTERS)) for k in WIDTHS]
    model = Model(
        embeddings, filters, [np.zeros(FILTERS) for _ in WIDTHS], rng.normal(0, 0.05, FILTERS * len(WIDTHS)), 0.0
    )
    embeddings[BUCKETS] = 0
    if odds is None:
        model.output[:] = 0
        model.threshold = 1e-3
        return model, rng
    embeddings[:, 0] = odds
    filters[0][:, 0] = 0
    filters[0][0, 0] = 1
    model.output[0] = 1
    return model, rng


def _read(texts: Iterable[list[str]]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The buckets of each distinct word, after those of the padding, and each text as rows of them, with padding behind."""
    known, pad = _Rows(), np.zeros(max(WIDTHS) - 1, np.int32)
    rows = [np.concatenate([np.fromiter(map(known.__getitem__, x), np.int32, len(x)), pad]) for x in texts]
    return np.concatenate([np.full((1, 4), BUCKETS, np.int32), _quads(list(known))]), rows


def _weights(y: np.ndarray, toxic: int, clean: int) -> np.ndarray:
    """Weights by which toxic and clean examples count alike, from their numbers in all shards."""
    return np.where(y > 0, 0.5 / max(1, toxic), 0.5 / max(1, clean)) * (toxic + clean)


def train(texts: list[str], labels: list[int], seed: int = 11, epochs: int = EPOCHS) -> Model:
    """Train on whole texts in one process; every fifth example is kept for the calibration of the thresholds.
    ``fit`` does the same with the examples of a table, in shards.

    Without examples of both kinds the model gives 0.5 less a little for every text.
    """
    y = np.array(labels, float)
    if len(set(labels)) < 2:
        return _start(None, seed)[0]
    found = [words(x) for x in texts]
    (quads, rows), languages = _read(found), [language(x) for x in found]
    kept = np.array([i % 5 == 4 for i in range(len(texts))]) if len(texts) >= 50 else np.zeros(len(texts), bool)
    learn = np.flatnonzero(~kept)
    toxic = int(y[learn].sum())
    model, rng = _start(_log_odds(_counts(quads, [rows[i] for i in learn], y[learn]), toxic, len(learn) - toxic), seed)
    _descend(model, quads, rows, y, _weights(y, int(y.sum()), int((1 - y).sum())), learn, rng, epochs)
    judged = kept if kept.any() else np.ones(len(y), bool)
    logits = np.array([_forward(model, [quads[x]])[0][0] for x in rows])
    _calibrate(model, logits[judged], y[judged], 1 - y[judged], np.array(languages)[judged])
    return model


def _forward(model: Model, texts: list[np.ndarray], quads: np.ndarray | None = None):
    """Logits of some texts, given as the buckets of their words or as rows of ``quads``, and what the gradients need: buckets
    and vectors of the words, the word at each place, pooled values and their places."""
    sizes = np.array([len(x) for x in texts])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    flat = np.concatenate(texts)
    if quads is None:
        quads, at = flat, np.arange(len(flat))
    else:  # each word of these texts once
        met = np.zeros(len(quads), bool)
        met[flat] = True
        met = np.flatnonzero(met)
        at = np.empty(len(quads), np.int32)
        at[met] = np.arange(len(met))
        quads, at = quads[met], at[flat]
    vectors = _vectors(model.embeddings, quads)
    pooled, places = [], []
    for k, w, bias in zip(WIDTHS, model.filters, model.biases):
        total = np.take(vectors @ w[:DIMENSIONS], at, axis=0)
        for j in range(1, k):
            ahead = np.take(vectors @ w[j * DIMENSIONS : (j + 1) * DIMENSIONS], at, axis=0)
            total[:-j] += ahead[j:]
            total[-j:] += ahead[:j]
        place = np.array([s + np.argmax(total[s : s + max(1, n - k + 1)], axis=0) for s, n in zip(starts, sizes)])
        pooled.append(np.maximum(np.take_along_axis(total, place, axis=0) + bias, 0))
        places.append(place)
    pooled_all = np.concatenate(pooled, axis=1)
    return pooled_all @ model.output + model.offset, quads, vectors, at, pooled_all, places


def _descend(model, quads, texts, y, weight, learn, rng, epochs, size=32, rate=0.05):
    """Adagrad over mini-batches; only the places that won the pooling have gradients."""
    memory = {}

    def step(name, value, gradient, rows=None):
        if name not in memory:
            memory[name] = np.full(np.shape(value), 1e-2)
        if rows is None:
            memory[name] += gradient**2
            return value - rate * gradient / np.sqrt(memory[name])
        memory[name][rows] += gradient**2
        value[rows] -= rate * gradient / np.sqrt(memory[name][rows])
        return value

    for _ in range(epochs):
        order = rng.permutation(learn)
        for at in range(0, len(order), size):
            some = order[at : at + size]
            logits, met, vectors, word, pooled, places = _forward(model, [texts[i] for i in some], quads)
            error = (sigmoid(logits) - y[some]) * weight[some] / len(some)
            back = error[:, None] * model.output * (pooled > 0)
            word_rows, word_gradients = [], []
            new_filters, new_biases = [], []
            for n, (k, w) in enumerate(zip(WIDTHS, model.filters)):
                g, p = back[:, n * FILTERS : (n + 1) * FILTERS], places[n]
                gradient = np.empty_like(w)
                for j in range(k):
                    rows = word[(p + j) % len(word)]
                    part = slice(j * DIMENSIONS, (j + 1) * DIMENSIONS)
                    gradient[part] = np.einsum("bfd,bf->df", vectors[rows], g)
                    word_rows.append(rows.ravel())
                    word_gradients.append((g[:, :, None] * w[part].T[None]).reshape(-1, DIMENSIONS))
                new_filters.append(step(("f", n), w, gradient))
                new_biases.append(step(("b", n), model.biases[n], g.sum(axis=0)))
            output = step("o", model.output, pooled.T @ error)
            model.offset = float(step("c", np.array(model.offset), error.sum()))
            rows = met[np.concatenate(word_rows)].ravel()
            sort = np.argsort(rows, kind="stable")
            rows = rows[sort]
            first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
            used, summed = rows[first], np.add.reduceat(np.concatenate(word_gradients)[sort // met.shape[1]], first, axis=0)
            summed[used == BUCKETS] = 0
            step("e", model.embeddings, summed, used)
            model.filters, model.biases, model.output = new_filters, new_biases, output


def _best_threshold(logits: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> float:
    """The middle of the widest range of thresholds with the fewest wrong decisions, from the numbers of toxic and clean
    examples at each logit."""
    order = np.argsort(logits, kind="stable")
    x, toxic, clean = logits[order], toxic[order], clean[order]
    # A threshold before position i calls i and everything after it toxic.
    wrong = np.concatenate([[0], np.cumsum(toxic)]) + np.concatenate([np.cumsum(clean[::-1])[::-1], [0]])
    edges = np.concatenate([[x[0] - 1], x, [x[-1] + 1]])
    widths = np.where(wrong == wrong.min(), edges[1:] - edges[:-1], -1)
    i = int(np.argmax(widths))
    return float((edges[i] + edges[i + 1]) / 2)


def _calibrate(model: Model, logits: np.ndarray, toxic: np.ndarray, clean: np.ndarray, languages: np.ndarray, least: int = 20) -> None:
    """Thresholds by language where it has enough examples of both kinds, else one for all."""
    model.threshold = _best_threshold(logits, toxic, clean) if toxic.sum() and clean.sum() else 0.0
    for name in sorted(set(languages.tolist())):
        own = languages == name
        if toxic[own].sum() >= least and clean[own].sum() >= least:
            model.thresholds[name] = _best_threshold(logits[own], toxic[own], clean[own])


def _flat(model: Model) -> np.ndarray:
    """All parameters as rows of ``_WIDE`` numbers."""
    arrays = [model.embeddings, *model.filters, *model.biases, model.output, np.array([model.offset])]
    flat = np.concatenate([a.ravel() for a in arrays])
    return np.concatenate([flat, np.zeros(-len(flat) % _WIDE)]).reshape(-1, _WIDE)


def _put(model: Model, rows: np.ndarray) -> None:
    """Set all parameters from such rows."""
    flat, at = rows.ravel(), 0

    def take(like: np.ndarray) -> np.ndarray:
        nonlocal at
        at += like.size
        return flat[at - like.size : at].reshape(like.shape).copy()

    model.embeddings = take(model.embeddings)
    model.filters = [take(w) for w in model.filters]
    model.biases = [take(b) for b in model.biases]
    model.output = take(model.output)
    model.offset = float(flat[at])


def _bucket_counts(learn: DataFrame) -> np.ndarray:
    """The number of clean and of toxic texts in which each bucket occurs, over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS + 1), np.int64)
        for batch in batches:
            for part in parts(batch, "text", TOGETHER):
                found = [list(set(words(x))) for x in part.column("text").to_pylist()]
                counts += _counts(*_read(found), part.column("toxic").to_numpy())
        met = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(met, pa.int64()), "clean": counts[0, met], "toxic": counts[1, met]})

    sums = learn.select("toxic", "text").mapInArrow(run, "bucket long, clean long, toxic long").groupBy("bucket")
    # A row for each bucket at most: of fixed size, whatever the number of texts.
    found = sums.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow()
    counts = np.zeros((2, BUCKETS + 1))
    counts[:, found["bucket"].to_numpy()] = found["clean"].to_numpy(), found["toxic"].to_numpy()
    return counts


def _dealt(learn: DataFrame, shards: int) -> DataFrame:
    """shard, doc_id, toxic, text: each shard in a partition of its own."""
    shard = F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(shards)).cast("int").alias("shard")
    return learn.select(shard, "doc_id", "toxic", "text").repartitionById(shards, F.col("shard"))


def _trained(learn: DataFrame, odds: np.ndarray, toxic: int, clean: int, shards: int, epochs: int) -> Model:
    """The model moved by the mean of what each shard's descent moves, by the shard's share of the rows."""
    names = [f"v{i}" for i in range(_WIDE)]

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        y = table["toxic"].to_numpy().astype(float)
        model, rng = _start(odds)
        before = _flat(model).copy()
        _descend(model, *_read(words(x) for x in table["text"].to_pylist()), y, _weights(y, toxic, clean), np.arange(len(y)), rng, epochs)
        moved = np.round((_flat(model) - before) * (len(y) * _UNIT)).astype(np.int64)
        rows = np.flatnonzero(moved.any(axis=1))
        columns = {n: pa.array(moved[rows, i]) for i, n in enumerate(names)}
        return pa.table({"row": pa.array(rows, pa.int64())} | columns)

    moves = _dealt(learn, shards).groupBy("shard").applyInArrow(run, "row long, " + ", ".join(f"{n} long" for n in names))
    # A row for each row of parameters: of fixed size, whatever the number of shards.
    found = moves.groupBy("row").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
    model, _ = _start(odds)
    rows = _flat(model)
    rows[found["row"].to_numpy()] += np.stack([found[n].to_numpy() for n in names], axis=1) / ((toxic + clean) * _UNIT)
    _put(model, rows)
    return model


def _set_thresholds(model: Model, kept: DataFrame) -> None:
    """Calibrate on all rows of a table, by the number of toxic and clean ones at each logit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            for part in parts(batch, "text", TOGETHER):
                logits, languages = scorer.logits(part.column("text").to_pylist())
                bins = np.round(np.clip(logits, -100, 100) * _BINS).astype(np.int64)
                yield pa.RecordBatch.from_pydict({"language": languages, "bin": bins, "toxic": part.column("toxic")})

    counted = kept.select("toxic", "text").mapInArrow(run, "language string, bin long, toxic int").groupBy("language", "bin")
    # A row for each bin and language at most.
    found = counted.agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n")).toArrow().sort_by([("language", "ascending"), ("bin", "ascending")])
    toxic = found["toxic"].to_numpy()
    _calibrate(model, found["bin"].to_numpy() / _BINS, toxic, found["n"].to_numpy() - toxic, np.array(found["language"].to_pylist()))


def _examples(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, toxic, text of the labelled rows, stored.

    Labels of neighbouring ids are packed into one row, a few bytes for each label, so that they can be broadcast to
    the texts; only where they are too many are the texts shuffled.
    """
    marks = pick(labels, "doc_id", "toxic").where("doc_id is not null and toxic is not null")
    near = F.shiftright("doc_id", _NEAR_BITS).alias("near")
    place = F.expr(f"cast(doc_id & {(1 << _NEAR_BITS) - 1} as smallint)")
    marks = marks.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("toxic") > 0).cast("tinyint").alias("toxic"))
    packed = marks.groupBy(near).agg(F.map_from_entries(F.collect_list(F.struct(place.alias("place"), "toxic"))).alias("marks"))
    packed = materialize(packed)
    size = packed.agg(F.coalesce(F.sum(F.size("marks") * 3 + 100), F.lit(0))).first()[0]
    texts = pick(docs, "doc_id", "text").where("doc_id is not null and text is not null")
    texts = texts.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    met = texts.join(F.broadcast(packed) if size <= _BROADCAST else packed, F.shiftright("doc_id", _NEAR_BITS) == F.col("near"))
    toxic = F.try_element_at("marks", place).cast("int").alias("toxic")
    examples = materialize(met.select("doc_id", toxic, "text").where("toxic is not null"))
    discard(packed)
    return examples


def fit(docs: DataFrame, labels: DataFrame, epochs: int = EPOCHS) -> Model:
    """Train on all labelled rows with their whole texts. A fifth of them, chosen by a hash of their ids, sets the thresholds
    (of fewer than 50 rows all do, and all are learned from).

    Log-odds are counted over all rows; the descent runs over shards of ``SHARD_BYTES`` of text, each in one task, from the same
    start, and the model is moved by their mean; thresholds come from counts. The driver gets rows for buckets, parameters and
    bins, whose number does not grow with the table. Runs jobs when called.

    Rows with a null id, text or label are no examples; of several labels of one id the largest counts.
    """
    examples = _examples(docs, labels)
    try:
        kept = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 4
        learned = F.when(~kept, 1).otherwise(0)
        seen = examples.agg(
            F.count("*").alias("rows"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"), F.sum(learned).alias("learned"),
            F.sum(learned * F.col("toxic")).alias("learned_toxic"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes"),
        ).first()
        few = seen["rows"] < 50
        n, toxic = (seen["rows"], seen["toxic"]) if few else (seen["learned"], seen["learned_toxic"])
        if not 0 < toxic < n:
            return _start(None)[0]
        learn, judged = (examples, examples) if few else (examples.where(~kept), examples.where(kept))
        odds = _log_odds(_bucket_counts(learn), toxic, n - toxic)
        model = _trained(learn, odds, toxic, n - toxic, 1 + int(seen["bytes"]) // SHARD_BYTES, epochs)
        _set_thresholds(model, judged)
        return model
    finally:
        discard(examples)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``score`` (0 to 1) and ``predicted`` (1 from 0.5 on) of whole texts, for each row of ``docs``: doc_id, score, predicted.

    Defined cases: a null or empty text is scored as a text without words; rows that repeat are scored alike; an
    empty table gives an empty result; other columns play no part. Narrow map work: the model has a fixed size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            for part in parts(batch, "text", TOGETHER):
                found = scorer.texts([x.as_py() or "" for x in part.column("text")])
                columns = [part.column("doc_id"), pa.array(found), pa.array((found >= 0.5).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "predicted"])

    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, "doc_id long, score double, predicted int")


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose whole text is not predicted to be toxic."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            for part in parts(batch, "text", TOGETHER):
                yield part.filter(pa.array(scorer.texts([x.as_py() or "" for x in part.column("text")]) < 0.5))

    return docs.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id"):
    """True for the fifth of the ids from which nothing is learned; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, with a model learned from rows that are not held out."""
    model = fit(docs, pick(labels, "doc_id", "toxic").where(~held_out()))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")
