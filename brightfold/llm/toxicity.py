"""Toxicity by a string-kernel support vector machine with Nystroem landmarks.

Kernel. Two words are alike as far as they share subsequences of three characters within
six, each weighted by DECAY to the power of the characters it spans (gap-weighted string
kernel of bounded span). Inserted characters and endings only lower the weights, so
"id-iot" stays close to "idiot". Three or more single characters in a row also count as one
word. A sentence is as similar to a landmark as its closest word.

Landmarks are words of the training sentences: those most tied to toxic documents by the
likelihood ratio, and the most frequent others. With the landmarks' own kernel matrix they
give Nystroem features; a linear SVM (squared hinge) on these is trained on sentences.
Only documents are labelled: a toxic one needs one toxic sentence, so training alternates
between fitting and choosing each toxic document's highest sentence and each clean one's
highest three (multiple-instance SVM). A logistic curve, fitted on documents kept out of
that, turns a document's highest sentence into its score.

The model is fitted on the driver from a bounded sample of labelled rows: SAMPLE documents
of each class, chosen by a hash of the id; those of texts over SAMPLE_BYTES bytes are left out of the fit. Scoring reads
every whole text, a batch at a time; what a task holds is bounded but for one text.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

SAMPLE = 3000
SAMPLE_BYTES = 20_000
SPAN, DECAY = 6, 0.7
TOXIC_LANDMARKS, PLAIN_LANDMARKS = 56, 8
RIDGE = 0.1
FOLDS = 5
#: Words a task remembers, reads at once, and their characters at once; none of these changes a score.
WORDS_KEPT, WORDS_AT_ONCE, CHARACTERS_AT_ONCE = 200_000, 50_000, 400_000
#: Words whose sums are built together, few enough for the cache; words of more hits are summed by themselves, in pieces.
WORDS_TOGETHER, HITS_TOGETHER, PIECE = 1_000, 129, 200_000


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, code, weight) of each three-character subsequence within SPAN."""
    text = "".join(words)
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(chars))
    parts = []
    for k in range(2, SPAN):
        at = np.flatnonzero(left > k)
        ends = (chars[at] << np.uint64(42)) | chars[at + k]
        for j in range(1, k):
            parts.append((owner[at], ends | (chars[at + j] << np.uint64(21)), np.full(len(at), DECAY ** (k + 1), np.float32)))
    return tuple(np.concatenate([p[i] for p in parts]) for i in range(3))


class Kernel:
    """Similarity of words to the landmarks."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        owner, code, weight = subsequences(landmarks)
        self.codes, at = np.unique(code, return_inverse=True)
        table = np.zeros((len(self.codes), len(landmarks)), np.float32)
        np.add.at(table, (at, owner), weight)
        self.table = table / np.maximum(np.sqrt((table**2).sum(axis=0)), 1e-9)
        self.sieve = np.zeros(1 << 18, bool)
        self.sieve[self._slot(self.codes)] = True

    @staticmethod
    def _slot(codes: np.ndarray) -> np.ndarray:
        return (codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(46)

    def _sums(self, first: np.ndarray, more: np.ndarray, at: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Weighted table rows summed over runs of hits, longest first; `more` are a run's hits beyond its first.

        All runs go on together, in the order in which the library's sums add: eight at a
        time into eight sums, then the rest, and the first row last.
        """

        def hit(runs, k):
            i = first[runs] + k
            part = self.table[at[i]]
            part *= weight[i, None]
            return part

        whole = more // 8 * 8
        total = np.zeros((len(first), self.table.shape[1]), np.float32)
        many = int((whole > 0).sum())
        if many:
            eight = [hit(slice(many), 1 + j) for j in range(8)]
            for k in range(8, int(whole[0]), 8):
                end = int((whole > k).sum())
                for j in range(8):
                    eight[j][:end] += hit(slice(end), 1 + k + j)
            r = eight
            total[:many] = ((r[0] + r[1]) + (r[2] + r[3])) + ((r[4] + r[5]) + (r[6] + r[7]))
        for k in range(7):
            runs = np.flatnonzero(more - whole > k)
            if not len(runs):
                break
            total[runs] += hit(runs, 1 + whole[runs] + k)
        return hit(slice(None), 0) + total

    def of(self, words: list[str]) -> np.ndarray:
        """One row for each word; the words' own norm counts each occurrence by itself."""
        out = np.zeros((len(words), len(self.landmarks)), np.float32)
        owner, code, weight = subsequences(words)
        norm = np.sqrt(np.bincount(owner, weight.astype(np.float64) ** 2, len(words)))
        near = np.flatnonzero(self.sieve[self._slot(code)])
        at = np.minimum(np.searchsorted(self.codes, code[near]), len(self.codes) - 1)
        hit = self.codes[at] == code[near]
        near, at = near[hit], at[hit]
        by = np.argsort(owner[near], kind="stable")
        near, at = near[by], at[by]
        who = owner[near]
        new = np.diff(who, prepend=-1) != 0
        cut = new.copy()
        cut[::PIECE] = True
        first = np.flatnonzero(cut)
        hits = np.diff(first, append=len(near))
        order = np.argsort(-hits, kind="stable")
        sums = np.empty((len(first), out.shape[1]), np.float32)
        long, light = int((hits > HITS_TOGETHER).sum()), weight[near]
        for i in order[:long]:
            some = slice(first[i], first[i] + hits[i])
            sums[i] = np.add.reduceat(self.table[at[some]] * light[some, None], [0])[0]
        for a in range(long, len(order), WORDS_TOGETHER):
            some = order[a : a + WORDS_TOGETHER]
            sums[some] = self._sums(first[some], hits[some] - 1, at, light)
        own = new[first]
        out[who[first[own]]] = sums[own]
        for i in np.flatnonzero(~own):
            out[who[first[i]]] += sums[i]
        return np.minimum(out / np.maximum(norm, 1e-9)[:, None], 1).astype(np.float32)


def batched(words: list[str], characters: int) -> Iterator[list[str]]:
    """Runs of whole words of about so many characters; a longer word is a run of its own."""
    part, held = [], 0
    for w in words:
        if part and held + len(w) > characters:
            yield part
            part, held = [], 0
        part.append(w)
        held += len(w)
    if part:
        yield part


def slices(words: list[bytes], size: int) -> Iterator[list[bytes]]:
    """A text's words, so many at once; a run of single characters, which is read as one word, stays together."""
    a = 0
    while a < len(words):
        b = min(len(words), a + size)
        while b < len(words) and len(words[b].decode("utf-8", "replace")) == 1:
            b += 1
        yield words[a:b]
        a = b


class Numbers(dict):
    """Numbers of words in order of first sight; `fresh` lists those not yet read."""

    def __init__(self):
        self.fresh: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        self.fresh.append(word)
        return number


class Reader:
    """Sentences of texts as rows of landmark similarities; remembers words."""

    def __init__(self, kernel: Kernel, kept: int = WORDS_KEPT):
        self.kernel, self.kept = kernel, kept
        self.clear()

    def clear(self):
        self.number = Numbers()
        self.rows = np.zeros((4096, len(self.kernel.landmarks)), np.float32)
        self.ends, self.single = np.zeros(4096, bool), np.zeros(4096, bool)

    def _numbers(self, words: list[bytes]) -> np.ndarray:
        at = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        fresh, self.number.fresh = self.number.fresh, []
        if fresh:
            size = len(self.number)
            known = size - len(fresh)
            if size > len(self.rows):
                more = max(size, 2 * len(self.rows)) - len(self.rows)
                self.rows = np.concatenate([self.rows, np.zeros((more, self.rows.shape[1]), np.float32)])
                self.ends, self.single = (np.append(x, np.zeros(more, bool)) for x in (self.ends, self.single))
            spelled = [w.decode("utf-8", "replace").lower() for w in fresh]
            rows = np.concatenate([self.kernel.of(part) for part in batched(spelled, CHARACTERS_AT_ONCE)])
            self.rows[known:size] = rows
            self.ends[known:size] = [w[-1:] in ".!?" for w in spelled]
            self.single[known:size] = [len(w) == 1 for w in spelled]
        return at

    def sentences(self, parts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Similarity rows of the sentences of some lists of words, and the first row of each list."""
        if len(self.number) > self.kept:
            self.clear()
        words = [w for part in parts for w in part]
        at = self._numbers(words)
        heads = np.zeros(len(at), bool)
        heads[np.cumsum([0, *map(len, parts[:-1])])] = True
        starts = heads.copy()
        starts[1:] |= self.ends[at[:-1]]
        single = self.single[at]
        if (single[:-2] & single[1:-1] & single[2:]).any():
            edges = np.flatnonzero(np.diff(np.concatenate([[0], single, [0]]).astype(int)))
            where, spelled = [], []
            for x, y in zip(edges[::2], edges[1::2]):
                cuts = [x, *(x + 1 + np.flatnonzero(heads[x + 1 : y])), y]
                for u, v in zip(cuts, cuts[1:]):
                    if v - u >= 3:
                        where.append(v - 1)
                        spelled.append(b"".join(words[u:v]))
            if where:
                at = np.insert(at, where, self._numbers(spelled))
                heads, starts = np.insert(heads, where, False), np.insert(starts, where, False)
        first = np.flatnonzero(starts)
        return np.maximum.reduceat(self.rows[at], first, axis=0), np.flatnonzero(heads[first])

    def highest(self, texts: list[bytes], weights: np.ndarray) -> np.ndarray:
        """Highest sentence of each text; 0 without words.

        Short texts are read together, long ones in slices. A sentence that a slice's end
        cuts goes on in the next one: its similarities so far are carried over.
        """
        out = np.zeros(len(texts), np.float64)
        parts, owners, held = [], [], 0

        def flush():
            rows, first = self.sentences(parts)
            out[owners] = np.maximum.reduceat(rows @ weights, first)

        for i, text in enumerate(texts):
            words = text.lower().split()
            if len(words) > WORDS_AT_ONCE:
                out[i] = self._highest_of_long(words, weights)
            elif words:
                parts.append(words)
                owners.append(i)
                held += len(words)
            if held >= WORDS_AT_ONCE:
                flush()
                parts, owners, held = [], [], 0
        if parts:
            flush()
        return out

    def _highest_of_long(self, words: list[bytes], weights: np.ndarray) -> float:
        best, open_ = -np.inf, None
        for part in slices(words, WORDS_AT_ONCE):
            rows, _ = self.sentences([part])
            if open_ is not None:
                rows[0] = np.maximum(rows[0], open_)
            ended = part[-1].decode("utf-8", "replace").lower()[-1:] in ".!?"
            done, open_ = (rows, None) if ended else (rows[:-1], rows[-1])
            if len(done):
                best = max(best, float((done @ weights).max()))
        return best if open_ is None else max(best, float(open_ @ weights))


@dataclass
class Model:
    kernel: Kernel
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def scores(self, reader: Reader, texts: list[bytes]) -> np.ndarray:
        margins = reader.highest(texts, self.weights) + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -30, 30)))


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1.0):
    """Linear SVM with squared hinge loss by Newton steps on the active rows."""
    x1 = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x1.shape[1])
    keep = penalty * np.eye(len(w))
    keep[-1, -1] = 1e-6
    for _ in range(30):
        active = y * (x1 @ w) < 1
        xa, wa = x1[active], weight[active]
        new = np.linalg.solve(keep + (xa * wa[:, None]).T @ xa, (xa * wa[:, None]).T @ y[active])
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w[:-1], w[-1]


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray):
    """Slope and shift of a logistic curve, with one soft row of each class for small samples."""
    x, y = np.append(x, [x.max(initial=1), x.min(initial=-1)]), np.append(y, [1.0, 0.0])
    weight = np.append(weight, [1.0, 1.0])
    x1, b = np.column_stack([x, np.ones(len(x))]), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x1 @ b, -30, 30)))
        h = (x1 * (weight * p * (1 - p))[:, None]).T @ x1 + 1e-3 * np.eye(2)
        b = b + np.linalg.solve(h, x1.T @ (weight * (y - p)) - 1e-3 * b)
    return max(b[0], 1e-3), b[1]


def _landmarks(texts: list[bytes], y: np.ndarray) -> list[str]:
    """Words most tied to toxic documents, then the most frequent others; near copies count once.

    Words of one text at a time are held, and for each word two numbers: near copies are
    brought together first.
    """
    groups: dict[tuple, list[int]] = defaultdict(list)
    for i, text in enumerate(texts):
        hashes = [xxhash.xxh64_intdigest(w) for w in set(text.lower().split())]
        groups[min(hashes, default=0), max(hashes, default=0)].append(i)
    counts: tuple[Counter, Counter] = Counter(), Counter()
    for copies in groups.values():
        for label in (0, 1):
            words = set()
            for i in copies:
                if y[i] == label:
                    words.update(texts[i].lower().split())
            counts[label].update(w for w in words if 3 <= len(w.decode("utf-8", "replace")) <= 40)
    has = {w: (counts[0][w], counts[1][w]) for w in counts[0].keys() | counts[1].keys()}
    total = np.array([max(1, (y == 0).sum()), max(1, (y == 1).sum())], float)
    rated = []
    for w, (c, t) in has.items():
        if t >= 3 and t / total[1] > c / total[0]:
            e = (c + t) * total[1] / total.sum()
            rated.append((t * np.log(t / e) + (c * np.log(c / ((c + t) * total[0] / total.sum())) if c else 0), w))
    rated.sort(reverse=True)
    chosen = [w.decode("utf-8", "replace").lower() for _, w in rated[:TOXIC_LANDMARKS]]
    often = sorted(has)
    often.sort(key=lambda w: -has[w][0])
    for w in often:
        if len(chosen) >= TOXIC_LANDMARKS + PLAIN_LANDMARKS:
            break
        if (name := w.decode("utf-8", "replace").lower()) not in chosen:
            chosen.append(name)
    return list(dict.fromkeys(chosen)) or ["none"]


def fit(texts: list[bytes], labels: list[int], shares: tuple[float, float]) -> Model:
    """Model of a bounded sample; shares: each class's part of all labelled documents."""
    y = np.array(labels, int)
    late = np.array([xxhash.xxh64_intdigest(t) % FOLDS == 0 for t in texts], bool)
    if not ((y == 1) & late).any() or not ((y == 0) & late).any() or not ((y == 1) & ~late).any():
        late[:] = False
    early = ~late
    kernel = Kernel(_landmarks([t for t, e in zip(texts, early) if e], y[early]))
    gram = kernel.of(kernel.landmarks).astype(float)
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    spread = vectors / np.sqrt(np.maximum(values, 0) + RIDGE)
    reader = Reader(kernel, WORDS_KEPT // 4)
    nothing = np.zeros((1, len(kernel.landmarks)), np.float32)
    bags = [reader.sentences([t.lower().split()])[0] if t.split() else nothing for t in texts]
    del reader
    first = np.array([1.0 if i < min(TOXIC_LANDMARKS, len(kernel.landmarks) - 1) else 0.0 for i in range(len(kernel.landmarks))])
    weights, bias = first, 0.0
    for turn in range(6):
        rows, sides = [], []
        for bag, label, e in zip(bags, y, early):
            if e:
                s = bag @ weights if turn else (bag**4) @ weights
                top = np.argsort(-s)[: 1 if label else 3]
                rows.append(bag[top])
                sides += [1 if label else -1] * len(top)
        x, side = np.concatenate(rows) @ spread, np.array(sides, float)
        each = np.where(side > 0, 0.5 / max(1, (side > 0).sum()), 0.5 / max(1, (side < 0).sum())) * len(side)
        beta, bias = _svm(x, side, each / 10)
        weights = spread @ beta
    margins = np.array([(bag @ weights).max() for bag in bags]) + bias
    use = late if late.any() else early
    n = np.array([max(1, ((y == c) & use).sum()) for c in (0, 1)])
    part = np.array(shares)[y[use]] / n[y[use]] * use.sum()
    slope, shift = _logistic(margins[use], y[use].astype(float), part)
    return Model(kernel, weights.astype(np.float32), float(bias), float(slope), float(shift))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on labelled rows whose crc32(id as text) mod 5 isn't 0; labels other than 0 and 1 are left out."""
    marked = labels.select(F.col(id_col).cast("long").alias("id"), F.col("toxic").alias("toxic")).where(
        "id IS NOT NULL AND toxic IN (0, 1)").where(F.crc32(F.col("id").cast("string").cast("binary")) % 5 != 0).distinct()
    counts = dict(marked.groupBy("toxic").count().collect())
    if not counts.get(0) or not counts.get(1):
        raise ValueError("labelled documents of both classes are needed")
    picks = None
    for label in (0, 1):
        one = marked.where(F.col("toxic") == label).orderBy(F.xxhash64("id"), "id").limit(sample)
        picks = one if picks is None else picks.unionByName(one)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where(
        (F.octet_length("text") <= SAMPLE_BYTES))
    rows = texts.join(F.broadcast(picks), "id").orderBy("id", "text").collect()
    seen: dict[bytes, int] = {}
    for r in rows:
        seen.setdefault(r["text"].encode(), int(r["toxic"]))
    del rows
    if len(set(seen.values())) < 2:
        raise ValueError("labelled documents of both classes are needed")
    total = counts[0] + counts[1]
    return fit(list(seen), list(seen.values()), (counts[0] / total, counts[1] / total))


def scorer(docs: DataFrame, model: Model):
    """Column function: score of a text column, 0 to 1; null and empty texts get the score of no words."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = sent.value
        reader = Reader(own.kernel)
        for part in parts:
            yield pd.Series(own.scores(reader, [(t or "").encode() for t in part]))

    of.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(of, "double")


def with_score(docs: DataFrame, labels: DataFrame, name: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns, and the score in a new column; neither ids nor labels enter a score."""
    return docs.withColumn(name, scorer(docs, train(docs, labels, id_col=id_col, text_col=text_col))(F.col(text_col)))


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    Repeated rows each get their score; equal texts get equal scores. Null ids aren't held
    out. Other columns are ignored. Labels of one class only raise ValueError.
    """
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    model = train(narrow, labels.select(F.col(id_col).alias("doc_id"), "toxic"))
    return narrow.select("doc_id", held_out().alias("held_out"), scorer(narrow, model)(F.col("text")).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))
