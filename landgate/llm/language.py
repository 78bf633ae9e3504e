"""Language of texts by a linear-chain conditional random field over their words.

A word's features are its bytes' n-grams with marked ends (which gives its affixes) and the word itself (the
lexicon), hashed into one weight table. Transition weights between the languages of neighbouring words are
learned with them, from sequences in which pieces of different languages follow each other, so that
code-switched text is labelled word by word. Forward-backward gives every word's probabilities; a text's
language has the largest sum of them, and its score is its share.

The field is fitted on a bounded sample of labelled rows (SEGMENTS pieces of at most SEGMENT_WORDS words for
each language); labels are words of the table's own lang column. Whole texts are labelled, in blocks of
words whose transfer matrices are chained, so long texts cost no more per word than short ones.

Defined results: ``und`` with score 0 for null texts, texts without a letter, and all texts if nothing is
labelled; of equal sums the first label in order wins; equal texts get equal results; a null doc_id is not
held out and not learned from.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landgate.llm import words as W
from landgate.llm.batches import kept_rows, measured
from landgate.llm.tables import table

UNKNOWN = "und"
#: The sample's bounds.
SEGMENTS, SEGMENT_WORDS, SAMPLED_DOCS, WORD_CHARACTERS = 800, 40, 800, 64
#: Parts in which the sample's rows are ranked before the best of all parts are.
PARTS = 256
#: Words that make a line a full piece; shorter ones, such as lines of unspaced scripts, come after those.
FULL = 3
TABLE_BITS = 16
EPOCHS, BATCH, RATE, DECAY, SEED = 4, 256, 0.5, 1e-4, 7
#: Words of a block, and blocks whose words are labelled at a time.
BLOCK, GROUP = 64, 2048
MIN_SCORE = 0.3
SCHEMA = "lang_pred string, score double"

LETTERS = W.ALNUM.copy()
LETTERS[0x30:0x3A] = False


def word_features(data: np.ndarray, found: W.Spans) -> tuple[np.ndarray, np.ndarray]:
    """(features, first): the hashed features of each span lie from first[i] to first[i + 1]."""
    length = found.end - found.start + 2
    end = np.cumsum(length)
    start = end - length
    padded = np.zeros(int(end[-1]) if len(end) else 0, np.uint64)
    inner = np.arange(len(padded)) - np.repeat(start, length)
    body = (inner > 0) & (inner < np.repeat(length, length) - 1)
    padded[body] = data[np.repeat(found.start - 1, length)[body] + inner[body]]
    padded[start], padded[end - 1] = 1, 2
    word = np.repeat(np.arange(len(length)), length)
    code, owner, kinds = padded, [np.arange(len(length))], [W.span_hashes(data, found)]
    for n in (2, 3, 4):
        code = code[:-1] * np.uint64(256) + padded[n - 1 :]
        inside = word[: len(code)] == word[n - 1 :]
        kinds.append(W.mixed(code[inside] * np.uint64(8) + np.uint64(n)))
        owner.append(word[: len(code)][inside])
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    features = (np.concatenate(kinds)[order] >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
    return features, np.searchsorted(owner[order], np.arange(len(length) + 1))


def blocks_of(text: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of a text lie in blocks of BLOCK: (text of each block, block and place of each word)."""
    first = np.searchsorted(text, np.arange(n_texts + 1))
    count = -(-np.diff(first) // BLOCK)
    start = np.concatenate(([0], np.cumsum(count)))
    place = np.arange(len(text)) - first[text]
    return np.repeat(np.arange(n_texts), count), start[text] + place // BLOCK, place % BLOCK


def _laid(scores: np.ndarray, block: np.ndarray, place: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The scores of words at (place, block), ones elsewhere, and where words are."""
    e = np.ones((BLOCK, k, scores.shape[1]))
    e[place, block] = scores
    real = np.zeros((BLOCK, k), bool)
    real[place, block] = True
    return e, real


def _transfers(e: np.ndarray, real: np.ndarray, a: np.ndarray) -> np.ndarray:
    """What each block makes of any scores that come in, up to a factor."""
    k, n = e.shape[1:]
    transfer = np.broadcast_to(np.eye(n), (k, n, n)).copy()
    for s in range(BLOCK):
        on = np.flatnonzero(real[s])
        if not len(on):
            break
        step = (transfer[on] @ a) * e[s, on][:, None, :]
        transfer[on] = step / step.max(axis=(1, 2), keepdims=True)
    return transfer


def _borders(transfer: np.ndarray, of: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Forward scores before each block and backward scores behind it."""
    k, n = transfer.shape[:2]
    first = np.searchsorted(of, np.arange(n_texts + 1))
    count = np.diff(first)
    entry, leave = np.ones((k, n)), np.ones((k, n))
    for r in range(1, int(count.max(initial=0))):
        at = first[:-1][count > r] + r
        value = np.einsum("ki,kij->kj", entry[at - 1], transfer[at - 1])
        entry[at] = value / value.max(axis=1, keepdims=True)
        at = first[1:][count > r] - 1 - r
        value = np.einsum("kij,kj->ki", transfer[at + 1], leave[at + 1])
        leave[at] = value / value.max(axis=1, keepdims=True)
    return entry, leave


def _within(e, real, a, entry, leave) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward, backward and incoming forward scores at every place of every block."""
    forward, backward, before = np.ones(e.shape), np.ones(e.shape), np.empty(e.shape)
    current = entry
    for s in range(BLOCK):
        before[s] = current
        step = (current @ a) * e[s]
        current = np.where(real[s][:, None], step / step.max(axis=1, keepdims=True), current)
        forward[s] = current
    current = leave
    for s in range(BLOCK - 1, -1, -1):
        backward[s] = current
        step = (e[s] * current) @ a.T
        current = np.where(real[s][:, None], step / step.max(axis=1, keepdims=True), current)
    return forward, backward, before


def _scores(emission: np.ndarray) -> np.ndarray:
    return np.exp(emission - emission.max(axis=1, keepdims=True))


def marginals(emission: np.ndarray, transition: np.ndarray, text: np.ndarray, n_texts: int):
    """Each word's label probabilities, and the expected number of each transition, by forward-backward.

    ``emission`` is (words, labels); ``text`` is each word's text, in order. Before a text's first word
    stands a word of any label.
    """
    of, block, place = blocks_of(text, n_texts)
    a = np.exp(transition)
    e, real = _laid(_scores(emission), block, place, len(of))
    forward, backward, before = _within(e, real, a, *_borders(_transfers(e, real, a), of, n_texts))
    p = forward[place, block] * backward[place, block]
    p /= p.sum(axis=1, keepdims=True)
    left = before[place, block]
    right = e[place, block] * backward[place, block]
    pair_sum = np.einsum("wi,ij,wj->w", left, a, right)
    pairs = a * (left.T @ (right / pair_sum[:, None]))
    return p, pairs


def label_sums(
    emission: np.ndarray, word: np.ndarray, transition: np.ndarray, text: np.ndarray, n_texts: int, group: int = GROUP
) -> np.ndarray:
    """Per text the sums of its words' label probabilities, as of ``marginals``, in memory for ``group`` blocks.

    ``emission`` is that of different words, ``word`` the number of each word among them. One pass over the groups finds what
    each block does, from which the scores at all borders follow; a second one fills the blocks in.
    """
    of, block, place = blocks_of(text, n_texts)
    k, n, a, scores = len(of), emission.shape[1], np.exp(transition), _scores(emission)

    def groups():
        for start in range(0, k, group):
            stop = min(k, start + group)
            own = slice(*np.searchsorted(block, (start, stop)))
            at = block[own] - start, place[own]
            yield slice(start, stop), own, at, *_laid(scores[word[own]], *at, stop - start)

    transfer = np.empty((k, n, n))
    for blocks, _, _, e, real in groups():
        transfer[blocks] = _transfers(e, real, a)
    entry, leave = _borders(transfer, of, n_texts)
    sums = np.zeros((n_texts, n))
    for blocks, own, (at, within), e, real in groups():
        forward, backward, _ = _within(e, real, a, entry[blocks], leave[blocks])
        p = forward[within, at] * backward[within, at]
        p /= p.sum(axis=1, keepdims=True)
        low, high = int(text[own][0]), int(text[own][-1]) + 1
        for label in range(n):
            sums[low:high, label] += np.bincount(text[own] - low, weights=p[:, label], minlength=high - low)
    return sums


@dataclass
class Field:
    labels: list[str]
    weights: np.ndarray
    transition: np.ndarray

    def emissions(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        n = np.diff(first)
        sums = np.add.reduceat(self.weights[features], first[:-1]) if len(n) else np.zeros((0, len(self.labels)))
        return sums / np.sqrt(n)[:, None]

    def measure(self, column: pa.Array) -> dict:
        out = {"lang_pred": [], "score": []}
        for texts in W.slices(column):
            data = W.LOWER[texts.data]
            found = W.spans(texts, LETTERS[data])
            n = len(texts)
            sums = np.zeros((n, max(1, len(self.labels))))
            lettered = texts.per_text(LETTERS[data] & (data < 128)) > 0
            for i in np.flatnonzero(~lettered & (found.per_text(n) > 0)):
                own = texts.data[texts.offsets[i] : texts.offsets[i + 1]].tobytes().decode()
                lettered[i] = any(map(str.isalpha, own))
            if self.labels and len(found):
                _, some, again = np.unique(W.span_hashes(data, found), return_index=True, return_inverse=True)
                picked = W.Spans(found.start[some], found.end[some], found.text[some])
                emission = self.emissions(*word_features(data, picked))
                sums = label_sums(emission, again, self.transition, found.text, n)
            total, best = sums.sum(axis=1), sums.argmax(axis=1)
            known = lettered & (total > 0)
            share = sums[np.arange(n), best] / np.where(known, total, 1)
            out["lang_pred"] += [self.labels[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
            out["score"] += np.where(known, np.minimum(share, 1.0), 0.0).tolist()
        return out


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _first(rows: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first ``n`` rows of every language, ranked in hashed parts and then among the first of all parts."""
    part = F.pmod(F.xxhash64(*[c for c in rows.columns if c != "lang"]), F.lit(PARTS))
    for by in (("lang", part), ("lang",)):
        place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        rows = rows.withColumn("_n", place).filter(F.col("_n") <= n).drop("_n")
    return rows


def sample(docs: DataFrame) -> list[tuple[str, list[str]]]:
    """(lang, words) of the pieces to learn from: the rows and lines with the smallest hashes."""
    labelled = docs.filter("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
    labelled = labelled.filter(~held_out(F.col("doc_id")))
    chosen = _first(labelled.select("doc_id", "lang"), SAMPLED_DOCS, F.xxhash64("doc_id"), "doc_id")
    lines = labelled.select("doc_id", "lang", "text").join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id")
    lines = lines.select("lang", F.explode(F.split("text", "\n")).alias("line"))
    words = F.filter(F.split(F.col("line"), r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"), lambda w: w != "")
    words = F.transform(F.slice(words, 1, SEGMENT_WORDS), lambda w: F.substring(w, 1, WORD_CHARACTERS))
    pieces = lines.select("lang", words.alias("words")).filter(F.size("words") > 0)
    pieces = _first(pieces, SEGMENTS, F.size("words") < FULL, F.xxhash64("words"), "words")
    return sorted((r["lang"], r["words"]) for r in pieces.select("lang", "words").collect())


def fitted(pieces: list[tuple[str, list[str]]]) -> Field:
    """Weights and transitions by stochastic gradient on sequences of one to three pieces."""
    labels = sorted({lang for lang, _ in pieces})
    n, draw = len(labels), np.random.default_rng(SEED)
    field = Field(labels, np.zeros((1 << TABLE_BITS, n)), np.zeros((n, n)))
    if n < 2:
        return field
    number = {lang: k for k, lang in enumerate(labels)}
    rate = {"w": np.full((1 << TABLE_BITS, n), 1e-2), "t": np.full((n, n), 1e-2)}
    for _ in range(EPOCHS):
        order = draw.permutation(len(pieces))
        sequences, at = [], 0
        while at < len(order):
            step = int(draw.integers(1, 4))
            sequences.append(order[at : at + step])
            at += step
        for b in range(0, len(sequences), BATCH):
            some = sequences[b : b + BATCH]
            words = [(t, w, number[pieces[i][0]]) for t, s in enumerate(some) for i in s for w in pieces[i][1]]
            encoded = [w.encode() for _, w, _ in words]
            size = np.fromiter(map(len, encoded), np.int64, len(encoded))
            end = np.cumsum(size)
            text = np.array([t for t, _, _ in words])
            gold = np.array([g for _, _, g in words])
            data = W.LOWER[np.frombuffer(b"".join(encoded), np.uint8)]
            features, first = word_features(data, W.Spans(end - size, end, text))
            p, pairs = marginals(field.emissions(features, first), field.transition, text, len(some))
            error = np.eye(n)[gold] - p
            error /= np.sqrt(np.diff(first))[:, None]
            spread = np.repeat(error, np.diff(first), axis=0)
            slope = np.stack(
                [np.bincount(features, weights=spread[:, k], minlength=1 << TABLE_BITS) for k in range(n)], axis=1
            )
            seen = np.zeros((n, n))
            inside = text[1:] == text[:-1]
            np.add.at(seen, (gold[:-1][inside], gold[1:][inside]), 1)
            opening = gold[np.concatenate(([True], ~inside))]
            before = np.exp(field.transition) / np.exp(field.transition).sum(axis=0)
            seen += before * np.bincount(opening, minlength=n)
            change = seen - pairs
            for name, value, own in (("w", slope, field.weights), ("t", change, field.transition)):
                value = value / len(some) - DECAY * own
                rate[name] += value**2
                own += RATE * value / np.sqrt(rate[name])
    return field


def learned(docs: DataFrame) -> Field:
    return fitted(sample(docs))


def identified(docs: DataFrame, field: Field | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and (lang_pred, score) of every text, by a field learned from ``docs`` unless given."""
    field = field or learned(docs)
    return measured(docs, field.measure, SCHEMA, keep=keep)


def keep_identified(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """The rows of ``docs`` whose language can be told, as they are."""
    field = field or learned(docs)

    def verdict(column):
        found = field.measure(column)
        return [
            lang != UNKNOWN and score >= MIN_SCORE
            for lang, score in zip(found["lang_pred"], found["score"], strict=True)
        ]

    return kept_rows(docs, verdict)


def op5_crf_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = identified(docs)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


QUERIES = {"op5_crf_language": (op5_crf_language, None)}
