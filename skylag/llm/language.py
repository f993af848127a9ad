"""Language of documents by a linear-chain conditional random field over their words.

Each word of a text is labelled with a language. A word's features are its prefixes and
suffixes, its character n-grams, and itself if the lexicon has it (the words of at least
``LEXICON_DOCUMENTS`` training documents); they are hashed to ``DIMENSIONS`` places.
Weights of features and of transitions from one word's language to the next are learned
together from code-switched sequences, made of runs of words out of training documents of
different languages, by gradient steps on the exact likelihood. Forward-backward gives
the probability of each language at each word, with all other words of the text in view.
A document's language is the one with the largest mean probability over its words that have
a letter, and that mean is its score.

Training reads whole texts of a sample of at most ``per_label`` labelled documents of each
language (drawn by a hash of the key, about as many if there are more); the bound is what
the driver collects. Everything else runs in tasks on the whole of every text. The batches of
a task hold some 8 MB of text and the probabilities of its words, or one text if that is
longer.

Defined results: texts that are NULL or have no letter, and all texts where nothing is
labelled, are ``und`` with score 0; of equally likely languages the first in alphabetical
order is taken; a very long word counts as several; repeated rows are labelled each; an
empty table gives an empty table. Columns named like the results are replaced.
"""

from __future__ import annotations

import random
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import Memo, slices, texts
from .minhash import mixed

UNKNOWN = "und"
DIMENSIONS = 1 << 17
LEXICON_DOCUMENTS = 3
# Words of a long text whose probabilities are worked out in step with other parts.
PART = 256
# Characters of a word that are looked at together; longer words are cut.
_LONGEST = 40
_NO_LETTER = regex.compile(r"\P{L}+")


def words_of(text: str) -> list[str]:
    """The lower-case words of a text: what stands between white space."""
    words = text.lower().split()
    if words and max(map(len, words)) > _LONGEST:
        words = [w[i : i + _LONGEST] for w in words for i in range(0, len(w), _LONGEST)]
    return words


def _hashed(codes: np.ndarray, first: np.ndarray, size: int, kind: int) -> np.ndarray:
    """Places of the runs of ``size`` characters that begin at ``first``."""
    value = np.full(len(first), 64 * kind + size, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            value = mixed((value ^ codes[first + i]) * np.uint64(0x9E3779B97F4A7C15))
    return (value % np.uint64(DIMENSIONS)).astype(np.int64)


def features(cores: list[str], lexicon: frozenset[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of words of letters alone: their places, and which word each is of."""
    if not cores:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    joined = "".join(f"^{core}$" for core in cores)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    sizes = np.asarray([len(core) for core in cores])
    begins = np.concatenate([[0], np.cumsum(sizes + 2)[:-1]])
    owner = np.repeat(np.arange(len(cores)), sizes + 2)
    rest = (begins + sizes + 2)[owner] - np.arange(len(codes))
    places, owners = [], []

    def add(first: np.ndarray, own: np.ndarray, size: int, kind: int) -> None:
        places.append(_hashed(codes, first, size, kind))
        owners.append(own)

    for size in (2, 3):
        first = np.flatnonzero(rest >= size)
        add(first, owner[first], size, 0)
    for size in (1, 2, 3, 4):
        own = np.flatnonzero(sizes >= size)
        if size < 4:
            add(begins[own] + 1, own, size, 1)
        add(begins[own] + 1 + sizes[own] - size, own, size, 2)
    known = [i for i, core in enumerate(cores) if core in lexicon]
    names = [xxhash.xxh3_64_intdigest(cores[i]) % DIMENSIONS for i in known]
    places.append(np.asarray(names, np.int64))
    owners.append(np.asarray(known, np.int64))
    return np.concatenate(places), np.concatenate(owners)


@dataclass
class Chain:
    """A trained field: labels, weights (places, labels), transitions, and the lexicon."""

    labels: list[str]
    weights: np.ndarray
    transitions: np.ndarray
    lexicon: frozenset[str] = field(default_factory=frozenset)

    def scores(self, cores: list[str]) -> np.ndarray:
        """Each word's score for each label, and 1 in a last column, as single precision."""
        places, owners = features(cores, self.lexicon)
        rows = np.ones((len(cores), len(self.labels) + 1), "f4")
        for label in range(len(self.labels)):
            rows[:, label] = np.bincount(owners, self.weights[places, label], len(cores))
        return rows


class WordScores:
    """Scores of words, remembered; words without a letter have none."""

    def __init__(self, chain: Chain):
        self.chain = chain
        self.rows = Memo(lambda word: self._make([word])[0], 400_000)

    def _make(self, words: list[str]) -> list[bytes]:
        cores = [_NO_LETTER.sub("", word) for word in words]
        number = {core: i for i, core in enumerate(dict.fromkeys(filter(None, cores)))}
        rows = self.chain.scores(list(number))
        none = bytes(4 * (len(self.chain.labels) + 1))
        return [rows[at].tobytes() if at is not None else none for at in map(number.get, cores)]

    def of(self, texts_words: list[list[str]]) -> np.ndarray:
        """One row for each word of some texts."""
        new = list(self.rows.lacks(set().union(*texts_words)))
        for word, row in zip(new, self._make(new), strict=True):
            self.rows.put(word, row)
        get = self.rows.__getitem__
        raw = b"".join([b"".join(map(get, words)) for words in texts_words])
        return np.frombuffer(raw, "f4").reshape(-1, len(self.chain.labels) + 1)


def _messages(local: np.ndarray, step: np.ndarray, parts: np.ndarray, number: np.ndarray):
    """What reaches each part of the sequences from the parts before it and after it.

    A part's words together turn what comes in on one side into what goes out on the
    other by one matrix; the matrices of all parts are multiplied up word by word at once.
    """
    k = local.shape[1]
    before, after = np.ones((len(parts), k)), np.ones((len(parts), k))
    first = np.cumsum(number) - number
    long = np.flatnonzero(number > 1)
    if not len(long):
        return before, after
    begins = np.concatenate([[0], np.cumsum(parts)[:-1]])
    inside = np.concatenate([np.arange(first[i], first[i] + number[i]) for i in long])
    through = np.broadcast_to(np.eye(k), (len(inside), k, k)).copy()
    for t in range(PART):
        on = np.flatnonzero(parts[inside] > t)
        now = (through[on] @ step) * local[begins[inside[on]] + t][:, None, :]
        through[on] = now / now.sum(axis=(1, 2), keepdims=True)
    # The first word of a sequence has no transition before it.
    at = begins[first[long]]
    head = local[at] / local[at].sum(axis=1, keepdims=True)
    for t in range(1, PART):
        head = (head @ step) * local[at + t]
        head /= head.sum(axis=1, keepdims=True)
    heads = dict(zip(long.tolist(), head, strict=True))
    place = dict(zip(inside.tolist(), range(len(inside)), strict=True))
    for i in long.tolist():
        coming = heads[i]
        for part in range(first[i] + 1, first[i] + number[i]):
            before[part] = coming @ step
            coming = coming @ through[place[part]]
            coming /= coming.sum()
        going = np.ones(k)
        for part in range(first[i] + number[i] - 1, first[i], -1):
            going = through[place[part]] @ going
            going /= going.sum()
            after[part - 1] = going
    return before, after


def forward_backward(
    scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray, pairs: bool = False
) -> tuple[np.ndarray, np.ndarray | None, float]:
    """Probability of each label at each word of several sequences, one after the other.

    With ``pairs`` also the expected number of each transition and the sum of the
    logarithms of all sequences' weights (their partition functions).
    """
    heights = scores.max(axis=1, keepdims=True)
    local = np.exp(scores - heights)
    step = np.exp(transitions - transitions.max())
    lasts = np.cumsum(lengths) - 1
    # Long sequences are done in parts of equal length, all at the same time.
    number = -(-lengths // PART)
    parts = np.full(number.sum(), PART)
    ends = np.cumsum(number) - 1
    parts[ends] = lengths - PART * (number - 1)
    before, after = _messages(local, step, parts, number)
    begins = np.concatenate([[0], np.cumsum(parts)[:-1]])
    # The longest first: those still going on are always the first ones.
    order = np.argsort(-parts, kind="stable")
    begins, parts, before, after = begins[order], parts[order], before[order], after[order]
    going = np.searchsorted(-parts, -np.arange(parts[0] if len(parts) else 0), "left")
    ahead, back = np.empty_like(local), np.empty_like(local)
    scale = np.ones(len(local))
    for t, count in enumerate(going):
        at = begins[:count] + t
        now = (before if t == 0 else ahead[at - 1] @ step) * local[at]
        total = now.sum(axis=1, keepdims=True)
        ahead[at] = now / total
        scale[at] = total[:, 0]
    for t in range(len(going) - 1, -1, -1):
        count = going[t]
        later = going[t + 1] if t + 1 < len(going) else 0
        back[begins[later:count] + t] = after[later:count]
        at = begins[:later] + t
        now = (back[at + 1] * local[at + 1]) @ step.T
        back[at] = now / now.sum(axis=1, keepdims=True)
    share = ahead * back
    share /= share.sum(axis=1, keepdims=True)
    if not pairs:
        return share, None, 0.0
    inner = np.ones(len(local), bool)
    inner[lasts] = False
    at = np.flatnonzero(inner)
    joint = ahead[at][:, :, None] * step * (back[at + 1] * local[at + 1])[:, None, :]
    joint /= joint.sum(axis=(1, 2), keepdims=True)
    logs = np.log(scale).sum() + heights.sum() + transitions.max() * len(at)
    return share, joint.sum(axis=0), float(logs)


def _sequences(samples: dict[str, list[list[str]]], seed: int) -> tuple[list[str], np.ndarray, list[int]]:
    """Code-switched sequences: words, label of each, and the sequences' lengths."""
    draw = random.Random(seed)
    runs = []
    for label, documents in enumerate(samples.values()):
        for words in documents:
            at = 0
            while at < len(words):
                size = draw.randint(3, 30)
                runs.append((label, words[at : at + size]))
                at += size
    draw.shuffle(runs)
    words, labels, lengths = [], [], []
    for start in range(0, len(runs), 4):
        some = runs[start : start + 4]
        words += [w for _, run in some for w in run]
        labels += [label for label, run in some for _ in run]
        lengths.append(sum(len(run) for _, run in some))
    return words, np.asarray(labels), lengths


def fit(samples: dict[str, list[list[str]]], steps: int = 25, penalty: float = 1e-6) -> Chain:
    """Train a field on the words of labelled documents, by label."""
    names = sorted(samples)
    samples = {name: samples[name] for name in names}
    seen = Counter(w for docs in samples.values() for d in docs for w in {_NO_LETTER.sub("", x) for x in d})
    lexicon = frozenset(w for w, n in seen.items() if w and n >= LEXICON_DOCUMENTS)
    words, labels, lengths = _sequences(samples, seed=7)
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    of = np.asarray([number[w] for w in words], np.int64)
    cores = [_NO_LETTER.sub("", w) for w in number]
    lettered = np.asarray([i for i, core in enumerate(cores) if core], np.int64)
    flat, owner = features([core for core in cores if core], lexicon)
    owner = lettered[owner]
    k = len(names)
    weights, transitions = np.zeros((DIMENSIONS, k)), np.zeros((k, k))
    truth = np.zeros((len(words), k))
    truth[np.arange(len(words)), labels] = 1
    inside = np.ones(len(words), bool)
    inside[np.cumsum(lengths) - 1] = False
    at = np.flatnonzero(inside)
    moves = np.zeros((k, k))
    np.add.at(moves, (labels[at], labels[at + 1]), 1)

    def by_column(index: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
        return np.stack([np.bincount(index, values[:, c], size) for c in range(k)], axis=1)

    means = [np.zeros_like(weights), np.zeros_like(transitions)]
    squares = [np.zeros_like(weights), np.zeros_like(transitions)]
    for turn in range(1, steps + 1):
        scores = by_column(owner, weights[flat], len(number))[of]
        share, expected, _ = forward_backward(scores, np.asarray(lengths), transitions, pairs=True)
        of_words = by_column(of, truth - share, len(number))
        gradient = by_column(flat, of_words[owner], DIMENSIONS) / len(words)
        steps_up = [gradient - penalty * weights, (moves - expected) / len(words)]
        for target, up, mean, square in zip(
            (weights, transitions), steps_up, means, squares, strict=True
        ):
            mean *= 0.9
            mean += 0.1 * up
            square *= 0.99
            square += 0.01 * up * up
            target += 0.1 * (mean / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-9)
    return Chain(names, weights.astype("f4"), transitions, lexicon)


def train(
    labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", per_label: int = 120
) -> Chain | None:
    """Fit on a sample of the labelled rows; None if there is no label with words."""
    rows = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}
    if not counts:
        return None
    # Each label's share of hash values is such that about ``per_label`` rows fall into it.
    share = F.lit(0.0)
    for label, count in counts.items():
        share = F.when(F.col(lang) == label, min(1.0, per_label / count)).otherwise(share)
    draw = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1_000_000)) / 1_000_000
    sample = rows.filter(draw < share).select(lang, text, F.col(key).cast("string").alias("k"))
    samples: dict[str, list[list[str]]] = {label: [] for label in counts}
    for row in sorted(sample.collect(), key=lambda r: (r["k"] or "", r[1])):
        samples[row[0]].append(words_of(row[1]))
    samples = {label: docs for label, docs in samples.items() if any(docs)}
    return fit(samples) if samples else None


def labelled(
    df: DataFrame, chain: Chain | None, text: str = "text", with_runs: bool = False
) -> DataFrame:
    """Add lang_pred and score; ``with_runs`` adds the runs of words of one language each."""
    added = ["lang_pred", "score", *["runs"] * with_runs]
    kept = [c for c in df.columns if c.lower() not in added]
    shared = df.sparkSession.sparkContext.broadcast(chain)
    kinds = T.StructType.fromDDL(
        "lang_pred string, score double, runs array<struct<lang: string, words: int>>"
    )
    schema = T.StructType([*(df.schema[c] for c in kept), *kinds.fields[: len(added)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        memo = WordScores(own) if own else None
        try:
            yield from labelled_batches(own, memo, batches)
        finally:
            if memo:
                memo.rows.forget()

    def labelled_batches(own, memo, batches) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            names, scores, runs = _of_batch(own, memo, texts(batch[text]), with_runs)
            columns = [pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            if with_runs:
                kind = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int32())]))
                columns.append(pa.array(runs, kind))
            yield pa.record_batch([*(batch[c] for c in kept), *columns], [*kept, *added])

    return df.select(*kept, *([] if text in kept else [text])).mapInArrow(run, schema)


def _of_batch(chain: Chain | None, memo: WordScores | None, values: list[str], with_runs: bool):
    """Language and score of each text, and its runs if asked for."""
    names, scores = [UNKNOWN] * len(values), np.zeros(len(values))
    runs: list[list[dict]] = [[] for _ in values]
    if chain is None:
        return names, scores, runs
    parts = [words_of(v) for v in values]
    k = len(chain.labels)
    rows = memo.of(parts)
    lengths = np.asarray([len(p) for p in parts])
    full = np.flatnonzero(lengths)
    if not len(full):
        return names, scores, runs
    share, _, _ = forward_backward(rows[:, :k].astype("f8"), lengths[full], chain.transitions)
    begins = np.concatenate([[0], np.cumsum(lengths[full])[:-1]])
    letters = rows[:, k].astype("f8")
    weight = np.add.reduceat(letters, begins)
    total = np.add.reduceat(share * letters[:, None], begins, axis=0)
    means = total / np.maximum(weight, 1)[:, None]
    best = means.argmax(axis=1)
    for at, number in enumerate(full.tolist()):
        if weight[at]:
            names[number] = chain.labels[best[at]]
            scores[number] = min(1.0, float(means[at, best[at]]))
            if with_runs:
                labels = share[begins[at] : begins[at] + lengths[number]].argmax(axis=1)
                cuts = [0, *(np.flatnonzero(np.diff(labels)) + 1).tolist(), len(labels)]
                runs[number] = [
                    {"lang": chain.labels[labels[a]], "words": b - a}
                    for a, b in zip(cuts, cuts[1:])
                ]
    return names, scores, runs


def held_out(key: str = "doc_id") -> Column:
    """Whether a document is kept from training: the CRC of its key as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def predicted(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of each document (doc_id, text, lang).

    Only documents that are not held out, and have a key, are learned from.
    """
    chain = train(documents.filter(F.col("doc_id").isNotNull() & ~held_out()))
    rows = documents.select("doc_id", held_out().alias("held_out"), "text")
    return labelled(rows, chain).drop("text")
