"""Operator 3: language identification by mixture inference.

A language is a distribution of letter trigrams, learned from labelled texts. A text is a
mixture: each of its words comes from one of the languages, with unknown proportions.
Expectation-maximisation finds the proportions from the words' likelihoods; the set
of languages is the prefix of the most frequent ones with the best likelihood after a
penalty for each language. The prediction is the language with the largest share.

Letters fall into 64 classes (a-z, 32 of other letters by code point modulo 32, which keeps all
of Latin-1 apart, one of letters beyond the basic plane, and one for everything that
is no letter), so a model takes 1 MB per language, whatever the size of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import lean, slices

CLASSES = 64
GRAMS = CLASSES**3
#: Share of the uniform distribution in each language's.
SMOOTHING = 1e-3
ROUNDS = 8
#: Log-likelihood each further language of a set has to gain, as a multiple of log(words), and at least.
PENALTY = 2.0
LEAST_GAIN = 6.0
#: Letters times languages handled at a time.
CELLS = 4_000_000
UNKNOWN = "und"


@lru_cache(1)
def letter_classes() -> np.ndarray:
    """The class of every code point of the basic plane; 0 for what is no letter."""
    out = np.zeros(65_536, np.uint8)
    for i in range(65_536):
        c = chr(i)
        if c.isalpha():
            low = ord(c.lower()[0])
            out[i] = low - 96 if 97 <= low <= 122 else 27 + low % 32
    return out


def _classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = letter_classes()[np.minimum(points, 65_535)]
    for i in np.flatnonzero(points > 65_535):
        out[i] = (CLASSES - 1) * chr(points[i]).isalpha()
    return out


def _grams(classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigram around each letter, with 0 for its neighbours that aren't letters; where letters are; which begin a word."""
    c = np.zeros(len(classes) + 2, np.int32)
    c[1:-1] = classes
    at = np.flatnonzero(classes)
    return (c[at] << 12) | (c[at + 1] << 6) | c[at + 2], at, c[at] == 0


def _joined(batch: pa.RecordBatch) -> tuple[str, np.ndarray]:
    """Texts of a batch in one string, parted by a line feed, and where each begins."""
    texts = pc.fill_null(batch.column("text"), "")
    ends = np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    return "\n".join(texts.to_pylist()), np.concatenate([[0], ends[:-1]]).astype(np.int64)


def trigram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows of (text, lang)."""

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, "text"):
                text, starts = _joined(part)
                grams, at, _ = _grams(_classes(text))
                cuts = np.append(np.searchsorted(at, starts), len(at))
                for lang, a, b in zip(part.column("lang").to_pylist(), cuts, cuts[1:], strict=False):
                    sums.setdefault(lang, np.zeros(GRAMS, np.int64))
                    own = grams[a:b]
                    if len(own) < 50_000:
                        np.add.at(sums[lang], own, 1)
                    else:
                        sums[lang] += np.bincount(own, minlength=GRAMS)
        for lang, n in sums.items():
            found = np.flatnonzero(n)
            for i in range(0, len(found), 10_000):
                own = found[i : i + 10_000]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own), pa.string()), pa.array(own), pa.array(n[own])], ["lang", "gram", "n"])

    rows = docs.select("text", "lang").mapInArrow(count, "lang string, gram long, n long")
    return rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages, and log probabilities by trigram and language, from all rows with a language.

    What is collected are sums: at most 262,144 trigrams per language.
    """
    counts = trigram_counts(docs.filter("lang is not null")).toPandas()
    langs = sorted(counts["lang"].unique())
    table = np.zeros((GRAMS, len(langs)))
    table[counts["gram"].to_numpy(int), np.searchsorted(langs, counts["lang"])] = counts["n"]
    table = (1 - SMOOTHING) * table / np.maximum(1, table.sum(axis=0)) + SMOOTHING / GRAMS
    return langs, np.log(table).astype(np.float32)


def _mixture(words: np.ndarray, starts: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """EM from the given shares (texts x languages); words' log-likelihoods, rows of each text in a run. Also the log-likelihoods."""
    owner = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(words))))
    top = words.max(axis=1)
    likely = np.exp(words - top[:, None])
    n = np.diff(np.append(starts, len(words)))[:, None]
    base = np.add.reduceat(top, starts)
    for _ in range(ROUNDS):
        mass = likely * shares[owner]
        mass /= np.maximum(mass.sum(axis=1, keepdims=True), 1e-30)
        shares = np.add.reduceat(mass, starts) / n
    fit = np.log(np.maximum((likely * shares[owner]).sum(axis=1), 1e-30))
    return shares, base + np.add.reduceat(fit, starts)


def infer(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Shares of languages in each text after the choice of its set; 0 outside the set."""
    n_langs = words.shape[1]
    shares, full = _mixture(words, starts, np.full((len(starts), n_langs), 1 / n_langs, np.float32))
    n = np.diff(np.append(starts, len(words)))
    price = np.maximum(LEAST_GAIN, PENALTY * np.log(n + 1))
    order = np.argsort(-shares, axis=1, kind="stable")
    out = np.zeros_like(shares)
    rows = np.arange(len(starts))
    out[rows, order[:, 0]] = 1
    alone = np.add.reduceat(words, starts)
    fit = alone[rows, order[:, 0]]
    best = fit.copy()
    # the likelihood of all languages bounds what any set can gain
    todo, k = np.flatnonzero(full - best > price), 2
    while len(todo) and k <= n_langs:
        own = np.concatenate([np.arange(starts[i], starts[i] + n[i]) for i in todo])
        begin = np.concatenate([[0], np.cumsum(n[todo])[:-1]])
        allowed = np.zeros((len(todo), n_langs), np.float32)
        np.put_along_axis(allowed, order[todo, :k], 1, axis=1)
        found, fit = _mixture(words[own], begin, allowed / k)
        gain = fit - (k - 1) * price[todo]
        better = gain > best[todo]
        out[todo[better]], best[todo[better]] = found[better], gain[better]
        todo, k = todo[full[todo] - k * price[todo] > best[todo]], k + 1
    return out


def predict(docs: DataFrame, langs: list[str], table: np.ndarray) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (the share of that language in the text, 0 to 1) in place of the text.

    A text that is null or has no letter is ``und`` with score 0; so is any if
    nothing was learned. Ties of shares go to the language that is first in order.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast((langs, table))
    rest = [f for f in docs.schema if f.name != "text"]
    names = [f.name for f in rest]

    @lean
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, table = model.value
        for batch in batches:
            for part in slices(batch, "text", CELLS // max(1, len(langs))):
                best, share = _scored(part, table) if langs else (np.full(len(part), -1), np.zeros(len(part)))
                pred = pa.array([langs[i] if i >= 0 else UNKNOWN for i in best], pa.string())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pred, pa.array(share, pa.float64())], [*names, "lang_pred", "score"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest), "lang_pred string, score double"])
    return docs.mapInArrow(score, schema)


def _scored(batch: pa.RecordBatch, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    text, starts = _joined(batch)
    words, owners = [], []
    # a text beyond the limit is alone in its batch, and is read in parts that end with a word
    step, begin, classes = max(1, CELLS // table.shape[1]), 0, _classes(text)
    while begin < len(classes):
        end = begin + step
        if end < len(classes):
            gaps = np.flatnonzero(classes[end : end + step] == 0)
            end += int(gaps[0]) if len(gaps) else step
        grams, at, first = _grams(classes[begin:end])
        if len(at):
            first[0] = True
            heads = np.flatnonzero(first)
            words.append(np.add.reduceat(table[grams], heads))
            owners.append(np.searchsorted(starts, at[heads] + begin, "right") - 1)
        begin = end
    best, share = np.full(len(batch), -1), np.zeros(len(batch))
    if words:
        owner = np.concatenate(owners)
        heads = np.flatnonzero(np.diff(owner, prepend=-1))
        shares = infer(np.concatenate(words), heads)
        rows = owner[heads]
        best[rows] = shares.argmax(axis=1)
        share[rows] = np.clip(shares.max(axis=1), 0, 1)
    return best, share


def held_out(doc_id: str = "doc_id"):
    """The fold that nothing is learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): learn from the labelled rows that aren't held out, predict all."""
    docs = docs.select("doc_id", "text", "lang")
    langs, table = learn(docs.filter(~held_out() & F.col("doc_id").isNotNull()))
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return predict(rows, langs, table)
