"""Language identification by a linear-chain conditional random field over words (operator 1)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from caudal.llm.common import free_name, parts
from caudal.llm.rolling import mix

#: Bound of the training sample: documents of each language, characters of one of them, and documents in all.
SAMPLE_DOCS = 300
SAMPLE_CHARS = 20_000
SAMPLE_TOTAL = 64 * SAMPLE_DOCS
FEATURE_BITS = 17
UNKNOWN = "und"
#: Text labelled at once, divided among the labels beyond ``FEW_LABELS``: a word holds a row of numbers by label.
BATCH_BYTES = 2 << 20
FEW_LABELS = 4


def _kinds() -> np.ndarray:
    """1 for code points that are letters (or marks inside words, as the library classes them), else 0."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


_letters: list[np.ndarray] = []
_kept: list[np.ndarray] = []


def letters() -> np.ndarray:
    if not _letters:
        _letters.append(_kinds())
    return _letters[0]


def word_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(features, the distinct word of each feature in order, the distinct word of each word, the text of each word).

    Words are runs of letters, lower-cased.  Features of a word: n-grams of two and three letters, affixes (one to
    three letters at either end, with the end) and the word itself, all hashed to ``FEATURE_BITS`` bits.
    """
    joined = "\n".join(texts)
    lower = joined.lower()
    if len(lower) != len(joined):  # a letter whose lower case is longer stays as it is
        lower = "".join(x if len(x := c.lower()) == 1 else c for c in joined)
    codes = np.frombuffer(lower.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    is_letter = np.append(letters()[codes], False)
    change = np.flatnonzero(is_letter[1:] != is_letter[:-1]) + 1
    if is_letter[0]:
        change = np.r_[0, change]
    starts, ends = change[::2], change[1::2]
    if not len(starts):
        return (np.zeros(0, dtype=np.int64),) * 4
    text = np.searchsorted(np.cumsum([len(x) + 1 for x in texts]), starts, "right")
    whole = _word_hashes(codes, starts, ends)
    whole, first, which = np.unique(whole, return_index=True, return_inverse=True)
    # From here on each distinct word stands once.
    starts, sizes = starts[first], (ends - starts)[first]
    n = len(starts)
    word = np.repeat(np.arange(n), sizes)
    begin = np.cumsum(sizes) - sizes
    at = np.arange(len(word)) - begin[word] + starts[word]
    code = np.append(codes[at].astype(np.uint64), np.zeros(3, dtype=np.uint64))
    left = np.repeat(begin + sizes, sizes) - np.arange(len(word))  # letters from here to the end of the word
    mask = np.uint64((1 << FEATURE_BITS) - 1)
    found, owner = [], []

    def add(kind: int, value: np.ndarray, who: np.ndarray) -> None:
        found.append((mix(value * np.uint64(64) + np.uint64(kind)) >> np.uint64(20)) & mask)
        owner.append(who)

    two = code[:-3] << np.uint64(21) | code[1:-2]
    three = two << np.uint64(21) | code[2:-1]
    add(2, two[left > 1], word[left > 1])
    add(3, three[left > 2], word[left > 2])
    every = np.arange(n)
    head, tail = np.zeros(n, dtype=np.uint64), np.zeros(n, dtype=np.uint64)
    for size in (1, 2, 3):
        long = sizes >= size
        head[long] = head[long] << np.uint64(21) | code[begin[long] + size - 1]
        tail[long] = tail[long] | code[(begin + sizes)[long] - size] << np.uint64(21 * (size - 1))
        add(10 + size, head[long], every[long])
        add(20 + size, tail[long], every[long])
    add(30, whole, every)
    feature, who = np.concatenate(found).astype(np.int64), np.concatenate(owner)
    order = np.argsort(who, kind="stable")
    return feature[order], who[order], which, text


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _kept or len(_kept[0]) < n:
        base = 0x9E3779B97F4A7C15
        both = [np.full(max(n, 1 << 20), x, dtype=np.uint64) for x in (base, pow(base, -1, 1 << 64))]
        _kept[:] = [np.multiply.accumulate(np.r_[np.uint64(1), x[:-1]]) for x in both]
    return _kept[0], _kept[1]


def _word_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash per word, the same wherever it stands: prefix sums of hashed letters times powers of an odd number."""
    up, down = _powers(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(mix(codes.astype(np.uint64)) * up[: len(codes)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


@dataclass
class Model:
    """Weights of a chain: by hashed feature and label, between labels, and at the start of a text."""

    labels: list[str]
    weights: np.ndarray
    moves: np.ndarray
    start: np.ndarray

    def batch_bytes(self) -> int:
        return BATCH_BYTES * FEW_LABELS // max(FEW_LABELS, len(self.labels))

    def scores(self, feature: np.ndarray, word: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Emission scores (words x labels): the sum of the weights of a word's features."""
        if not len(which):
            return np.zeros((0, len(self.labels)))
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        return np.add.reduceat(self.weights[feature], first, axis=0)[which]

    def posteriors(self, scores: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Label probabilities of each word given its whole text and given the words up to it: forward-backward.

        All words stand in one row.  A word's step is the matrix moves x emission; the first word of a text forgets
        what stood before.  Steps are multiplied within blocks for all blocks at once, blocks are joined one after the
        other, and a second pass fills in the words.
        """
        n, k = scores.shape
        if not n:
            return scores, scores
        emit = np.exp(scores - scores.max(axis=1, keepdims=True)).astype(np.float64)
        fresh = np.r_[True, text[1:] != text[:-1]]
        size = max(8, k, int((n / 6) ** 0.5))  # words in a block; blocks are joined exactly
        pad = -n % size
        blocks = (n + pad) // size
        # Step i of all blocks lies together: emit[i, block, label].
        emit = np.concatenate([emit, np.ones((pad, k))]).reshape(blocks, size, k).transpose(1, 0, 2).copy()
        new = [np.flatnonzero(x) for x in np.concatenate([fresh, np.zeros(pad, dtype=bool)]).reshape(blocks, size).T]
        moves, start = np.exp(self.moves), np.exp(self.start)
        # Product of the steps of each block, as rows of where it starts.
        product = np.broadcast_to(np.eye(k), (blocks, k, k)).copy()
        for i in range(size):
            moved = (product.reshape(-1, k) @ moves).reshape(blocks, k, k)
            if len(new[i]):
                moved[new[i]] = product[new[i]].sum(axis=2, keepdims=True) * start
            product = moved * emit[i][:, None, :]
            if i % 4 == 3:
                product /= product.max(axis=(1, 2), keepdims=True)
        product /= product.max(axis=(1, 2), keepdims=True)
        into, back = np.empty((blocks, k)), np.empty((blocks, k))
        now = np.full(k, 1.0 / k)
        for b, step in enumerate(product):
            into[b] = now
            now = now @ step
            now /= now.sum()
        now = np.ones(k)
        for b in range(blocks - 1, -1, -1):
            back[b] = now
            now = product[b] @ now
            now /= now.sum()
        forward = np.empty((size, blocks, k))
        now = into
        for i in range(size):
            moved = now @ moves
            moved[new[i]] = start
            now = moved * emit[i]
            if i % 4 == 3:
                now /= now.max(axis=1, keepdims=True)
            forward[i] = now
        found = forward.copy()
        now = back
        for i in range(size - 1, -1, -1):
            found[i] *= now
            later = emit[i] * now
            now = later @ moves.T
            now[new[i]] = (later[new[i]] * start).sum(axis=1, keepdims=True)
            if i % 4 == 0:
                now /= now.max(axis=1, keepdims=True)
        out, so_far = (x.transpose(1, 0, 2).reshape(-1, k)[:n] for x in (found, forward))
        return out / out.sum(axis=1, keepdims=True), so_far

    def label(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """The label with most probability over a text's words, and its share of them."""
        feature, word, which, text = word_features(texts)
        found, _ = self.posteriors(self.scores(feature, word, which), text)
        mass = np.stack([np.bincount(text, found[:, j], len(texts)) for j in range(len(self.labels))], axis=1)
        total = mass.sum(axis=1)
        best = mass.argmax(axis=1)
        share = np.where(total > 0, mass[np.arange(len(texts)), best] / np.maximum(total, 1e-300), 0.0)
        return [self.labels[b] if t > 0 else UNKNOWN for b, t in zip(best.tolist(), total.tolist(), strict=True)], np.clip(share, 0.0, 1.0)


def _mixed(rows: list[tuple[str, str]], labels: list[str]) -> tuple[list[str], list[int]]:
    """Training text: lines of all languages dealt in runs, so that the chain learns both staying and switching."""
    spans = []
    for text, lang in rows:
        words = text.split()
        for i in range(0, len(words), 24):
            spans.append((" ".join(words[i : i + 24]), labels.index(lang)))
    order = np.random.default_rng(7).permutation(len(spans))
    return [spans[i][0] for i in order], [spans[i][1] for i in order]


def train(rows: list[tuple[str, str]], rounds: int = 4, batch: int = 150, rate: float = 0.3, decay: float = 1e-6) -> Model:
    """A chain fitted to (text, language) rows by adaptive gradient steps on the likelihood of the labels.

    Spans of up to 24 words of one language follow each other in mixed order as code-switched text.
    No rows: a model that knows no label, whose answers are all ``und``.
    """
    labels = sorted({lang for _, lang in rows})
    k = max(1, len(labels))
    model = Model(labels or [UNKNOWN], np.zeros((1 << FEATURE_BITS, k)), np.zeros((k, k)), np.zeros(k))
    texts, langs = _mixed(rows, labels)
    squares = [np.full(x.shape, 1e-8) for x in (model.weights, model.moves, model.start)]
    made = []
    for i in range(0, len(texts), batch):
        feature, word, which, text = word_features(texts[i : i + batch])
        if len(text):
            # Up to six spans make one text of several languages.
            made.append((feature, word, which, text // 6, np.array(langs[i : i + batch])[text]))
    for _ in range(rounds if k > 1 else 0):
        for feature, word, which, text, truth in made:
            found, so_far = model.posteriors(model.scores(feature, word, which), text)
            gap = -found
            gap[np.arange(len(truth)), truth] += 1
            by_word = np.stack([np.bincount(which, gap[:, j]) for j in range(k)], axis=1)
            used, where = np.unique(feature, return_inverse=True)
            gradient = np.stack([np.bincount(where, by_word[word, j], len(used)) for j in range(k)], axis=1) / len(truth) * batch
            inner = text[1:] == text[:-1]
            # Expected pairs of neighbours: forward probability x move x what the second word's posterior adds.
            step = np.exp(model.moves)
            before = so_far[:-1][inner]
            pairs = step * (before.T @ (found[1:][inner] / (before @ step)))
            real = np.zeros((k, k))
            np.add.at(real, (truth[:-1][inner], truth[1:][inner]), 1)
            moves = (real - pairs) / max(1, inner.sum())
            first = np.r_[True, ~inner]
            start = gap[first].mean(axis=0)
            gradient -= decay * model.weights[used]
            squares[0][used] += gradient**2
            model.weights[used] += rate * gradient / np.sqrt(squares[0][used])
            for value, grad, square in ((model.moves, moves, squares[1]), (model.start, start, squares[2])):
                square += grad**2
                value += rate * grad / np.sqrt(square)
    model.weights = model.weights.astype(np.float32)
    return model


def sample(docs: DataFrame, per_language: int = SAMPLE_DOCS, longest: int = SAMPLE_CHARS, total: int = SAMPLE_TOTAL) -> list[tuple[str, str]]:
    """A bounded sample of labelled rows: about ``per_language`` documents of each language, by a hash of id, text and place in the table.

    Every language is sampled.  Of so many that ``per_language`` of each are more than ``total``, each gives an equal share,
    at least one document.  A text over ``longest`` characters gives a span of that length, its place told by the
    hash.  Rows without a language or text are not sampled.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return []
    per_language = max(1, min(per_language, total // len(counts)))
    # Fine enough that the draw stays small however many rows a language has.
    scale = 1 << 40
    # So many are drawn that hardly any language comes out short, however small its share.
    drawn = max(3 * per_language // 2, per_language + 20)
    shares = docs.sparkSession.createDataFrame([(x, min(scale, 1 + drawn * scale // n)) for x, n in counts.items()], "lang string, share long")
    # Rows equal in id and text are drawn each by itself, so a text of very many copies is neither left out nor drawn whole.
    dealt = F.pmod(F.xxhash64("doc_id", "text", F.monotonically_increasing_id()), F.lit(scale))
    h, size = F.xxhash64("text", "doc_id"), F.length("text")
    span = F.when(size <= longest, F.col("text")).otherwise(F.col("text").substr((F.pmod(h, size - longest + 1) + 1).cast("int"), F.lit(longest)))
    rows = known.join(F.broadcast(shares), "lang").where(dealt < F.col("share")).select("lang", span.alias("text"), h.alias("h")).collect()
    held: dict[str, list[tuple[int, str]]] = {}
    for r in rows:
        held.setdefault(r["lang"], []).append((r["h"], r["text"]))
    return [(text, lang) for lang in sorted(held) for _, text in sorted(held[lang])[:per_language]]


def fit(docs: DataFrame, **bounds: int) -> Model:
    """A model from the rows with a language (columns ``doc_id``, ``text``, ``lang``)."""
    return train(sample(docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")), **bounds))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs``, with ``lang_pred`` and ``score`` (the language's share of all words' probability).

    Whole texts are labelled word by word; nothing is shuffled.  Text that is NULL, empty or without letters is
    ``und`` with score 0; ties go to the first language in order; repeated rows get the same result; a column that
    has the name of a result is kept and the result gets an underscore; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    pred, score = free_name(docs.columns, "lang_pred"), free_name(docs.columns, "score")
    names = [*docs.columns, pred, score]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, shared.value.batch_bytes()):
            found, share = shared.value.label([x or "" for x in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string()), pa.array(share, pa.float64())], names)

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(pred, StringType()), StructField(score, DoubleType())]))


def only_known(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """The documents, all columns as they are, whose language is told with a score of ``least`` or more.

    Text that is NULL, empty or without letters has no language and goes; repeated rows stay or go together; a label that the row
    has already says nothing; an empty table stays empty; columns of any name are kept.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, shared.value.batch_bytes()):
            found, share = shared.value.label([x or "" for x in batch.column("text").to_pylist()])
            yield batch.filter(pa.array([x != UNKNOWN and s >= least for x, s in zip(found, share, strict=True)]))

    return docs.mapInArrow(keep, docs.schema)
