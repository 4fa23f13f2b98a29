"""Toxicity by a subsequence string kernel with Nyström landmarks and a linear
support vector machine, trained on labelled sentences.

The kernel compares two strings by the subsequences of three characters that
they share, gaps included: every character a subsequence skips costs a factor
``DECAY``, up to ``SPAN`` characters in all. So an insult with inserted or
exchanged characters stays close to itself. What is compared with a landmark is a window of a
sentence: a word (word ends count as characters), windows of the landmarks' lengths that slide
over a word's characters one by one, with and without word ends, so glued words show, and the
same across words (``^a$^b$``) in runs of short words and of words near half of a landmark of
two; marks inside a word split it and are also left out. Besides, a run of spelt-out single
characters read as one word, a piece of a very long word, and every second character of a word
(a fully gapped insult). Values below ``FLOOR`` count as 0.

Landmarks are words that set toxic training texts apart, and pairs of neighbouring words
that do so while neither word does, no two of them alike.
A text's vector holds, for each landmark, the sum of the values of its different
words (or its nearest window's, if that is more) in logarithms: one harmless relative
of an insult is less than several insults.
The vector is multiplied by the inverse root of the landmarks' own kernel matrix,
the machine is trained on the labelled texts, and its distances are calibrated.

The training sample is bounded: at most ``TRAIN_DOCS`` labelled texts of each
kind (smallest hashes), ``TRAIN_CHARS`` characters each. Scoring covers whole
texts.

Defined cases: a null or empty text scores as one without windows;
without labels of both kinds every score is the share of toxic labels (0.5 if
there are none); repeated rows repeat.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from payguard.llm.common import crc_mod_col, map_text
from payguard.llm.quality import logistic, training_rows

DECAY, SPAN, FLOOR = 0.6, 5, 0.5
LANDMARKS, CANDIDATES, ALIKE = 96, 400, 0.75
#: Hashes by which copies of a training text are told.
SKETCH = 16
#: What all clean texts weigh in the calibration, the toxic ones weighing 1.
CLEAN = 2.0
WINDOW = 24
TRAIN_DOCS, TRAIN_CHARS = 1500, 20_000
TRAIN_BATCH = 100
FOLDS, HELD = 5, 0
THRESHOLD = 0.5
#: The least log likelihood ratio by which a pair of words belongs to toxic texts, and the counters of the first look at pairs.
PAIR_EVIDENCE, PAIR_SLOTS = 14.0, 1 << 22
#: Characters of texts that windows slide over together and at a time, and the least letters of every second character of a word.
SLIDE_CHARS, SLIDE_ROWS, GAPPED = 200_000, 8_000, 4
#: Words, and windows, that a task remembers before it starts afresh.
MEMORY = 400_000
#: Letters of a word that may be part of an insult cut by spaces, and the longest run of words that is remembered.
SHORT, REMEMBERED = 4, 200
SCHEMA = T.StructType([T.StructField("score", T.DoubleType())])
SPELT = re.compile(r"(?<!\S)\S(?:\s\S){3,}(?!\S)")
EDGE = re.compile(r"^[\W_]+|[\W_]+$")
INNER = re.compile(r"[\W_]+")
#: Two open words and more, in a byte for each word.
OPEN_RUN = re.compile(b"\x01{2,}")
ENDS = re.compile(r"[.!?…。！？]\W*$")
#: Fixed look-alikes of letters inside words.
ALIKES = str.maketrans("013457@$!|€", "oieastasile")
CODES = 64


def read(token: str) -> str:
    """A lower-case token as the kernel reads it: marks around it fall away, marks
    inside too, after look-alikes have become letters."""
    t = token if token.isalpha() else EDGE.sub("", token)
    if t.isalpha() or not t:
        return t
    return INNER.sub("", t.translate(ALIKES)) if any(c.isalpha() for c in t) else ""


def pieces(token: str) -> list[str]:
    """The words of a lower-case token, split at its inner marks."""
    t = token if token.isalpha() else EDGE.sub("", token)
    if t.isalpha() or not t:
        return [t] if t else []
    out = [w for x in INNER.split(t) if any(c.isalpha() for c in x) and (w := read(x))]
    return out if len(out) > 1 else [w] if (w := read(t)) else []


def windows(word: str) -> list[str]:
    """The word with its ends marked; of a long one overlapping pieces."""
    w = f"^{word}$"
    return [w] if len(w) <= WINDOW else [w[i:i + WINDOW] for i in range(0, len(w) - WINDOW // 2, WINDOW // 2)]


def codes(strings: list[str]) -> np.ndarray:
    """Characters as numbers below CODES, 0 after the end."""
    sizes = np.array([len(s) for s in strings])
    out = np.zeros((len(strings), max(sizes.max(initial=0), SPAN)), dtype=np.int32)
    flat = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    code = np.where((flat >= 97) & (flat <= 122), flat - 96, np.where((flat >= 48) & (flat <= 57), flat - 48 + 27,
                    np.where(flat == 94, 38, np.where(flat == 36, 39, 40 + flat % 24))))
    row = np.repeat(np.arange(len(strings)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = code
    return out


def subsequences(c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, subsequence, weight) of all gapped triples."""
    rows, keys, weights = [], [], []
    for last in range(2, SPAN + 1):
        for mid in range(1, last):
            n = c.shape[1] - last
            a, b, d = c[:, :n], c[:, mid:mid + n], c[:, last:]
            r, i = np.nonzero(d)
            rows.append(r)
            keys.append((a[r, i] * CODES + b[r, i]) * CODES + d[r, i])
            weights.append(np.full(len(r), DECAY ** (last - 2)))
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(weights)


def vectors(strings: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same with equal subsequences of a string added up and every string of length 1."""
    row, key, weight = subsequences(codes(strings))
    both, at = np.unique(row * CODES ** 3 + key, return_inverse=True)
    w = np.bincount(at, weights=weight, minlength=len(both))
    r = both // CODES ** 3
    norm = np.sqrt(np.bincount(r, weights=w * w, minlength=len(strings)))
    return r, both % CODES ** 3, w / norm[r]


class Kernel:
    """The normalised kernel between any windows and the landmarks."""

    def __init__(self, landmarks: list[str]):
        self.landmarks, self.m = landmarks, len(landmarks)
        lm, key, w = vectors(landmarks)
        order = np.argsort(key, kind="stable")
        self.lm, self.w = lm[order], w[order]
        keys, start = np.unique(key[order], return_index=True)
        self.start = np.append(start, len(order))
        self.row = np.full(CODES ** 3, -1, dtype=np.int32)
        self.row[keys] = np.arange(len(keys))
        # The windows that slide have a landmark's length, with its word ends or without: (length, least norm of such a
        # window, which of the landmarks' lengths).
        sizes = np.array([len(m) for m in landmarks])
        by = np.argsort(sizes, kind="stable")
        least = lambda n: np.sqrt(sum(max(n - last, 0) * (last - 1) * DECAY ** (2 * (last - 2)) for last in range(2, SPAN + 1)))
        self.least = np.array([float(least(n)) for n in range(WINDOW + 1)])
        self.slides = [(n, float(least(n)), g) for g, size in enumerate(np.unique(sizes).tolist()) for n in (size - 2, size) if n > 2]
        # The most that a triple adds to any landmark of a length (none for triples of no landmark), by length.
        dense = np.zeros((len(keys), self.m), dtype=np.float32)
        dense[np.repeat(np.arange(len(keys)), np.diff(self.start)), np.argsort(by)[self.lm]] = self.w
        self.most = np.stack([dense[:, slice(*np.searchsorted(sizes[by], [size, size + 1]))].max(1) for size in np.unique(sizes)], axis=1)
        # The same by distance of the triple's ends, the last row for triples of no landmark.
        none = np.zeros((1, self.most.shape[1]), dtype=np.float32)
        self.by_last = {last: np.concatenate([np.float32(DECAY ** (last - 2)) * self.most, none]) for last in range(2, SPAN + 1)}
        self.spot = np.where(self.row >= 0, self.row, len(keys)).astype(np.intp)

    def slide(self, stream: str) -> list[tuple[int, str]]:
        """(start, window) of the sliding windows, and of the whole lines, of a text that can reach FLOOR; no window holds a line end.

        What a window's triples add at most to any landmark of its length bounds its value: a running
        sum for each length instead of each landmark."""
        every = np.concatenate([codes([stream])[0][:len(stream)], np.zeros(WINDOW + SPAN, dtype=np.int32)]).astype(np.intp)
        ends = np.append(np.flatnonzero(np.frombuffer(stream.encode("utf-32-le", "surrogatepass"), dtype="<u4") == 10), len(stream))
        starts = np.concatenate([[0], ends[:-1] + 1])
        short = (ends - starts >= 3) & (ends - starts <= WINDOW)
        starts, stops = starts[short], ends[short]
        out = []
        for a in range(0, len(stream), SLIDE_ROWS):
            n = min(SLIDE_ROWS + WINDOW, len(stream) - a)
            c = every[a:a + n + SPAN]
            bound = np.zeros((n + 1, self.most.shape[1]), dtype=np.float32)
            part, two = np.empty((n, self.most.shape[1]), dtype=np.float32), {mid: c[:n] * CODES ** 2 + c[mid:mid + n] * CODES for mid in range(1, SPAN)}
            for last in range(2, SPAN + 1):
                for mid in range(1, last):
                    np.take(self.by_last[last], self.spot.take(two[mid] + c[last:last + n]), axis=0, out=part, mode="clip")
                    bound[1:] += part
            sums = np.cumsum(bound.T, axis=1, dtype=np.float64)  # single precision drifts by more than the slack below
            for size, least, g in self.slides:
                stop = min(SLIDE_ROWS, n - size + 1)  # the starts from there on are the next part's
                if stop > 0:
                    s = np.flatnonzero(sums[g, size - 2:size - 2 + stop] - sums[g, :stop] >= FLOOR * least - 2e-3) + a
                    s = s[np.searchsorted(ends, s) == np.searchsorted(ends, s + size)] if len(s) else s
                    out += [(i, stream[i:i + size]) for i in s.tolist()]
            u, v = np.searchsorted(starts, [a, a + SLIDE_ROWS])
            b, e = starts[u:v], stops[u:v]
            near = (sums[:, e - a - 2] - sums[:, b - a]).max(axis=0, initial=0) >= FLOOR * self.least[e - b] - 2e-3
            out += [(i, stream[i:j]) for i, j in zip(b[near].tolist(), e[near].tolist())]
        return out

    def __call__(self, strings: list[str]):
        """(string, values) of the strings that are close to any landmark."""
        for i in range(0, len(strings), 5_000):
            part = strings[i:i + 5_000]
            row, key, weight = subsequences(codes(part))
            norm = np.bincount(row, weights=weight * weight, minlength=len(part))  # at most the true square
            k = self.row[key]
            hit = np.flatnonzero(k >= 0)
            k, r, w = k[hit], row[hit], weight[hit]
            n = self.start[k + 1] - self.start[k]
            pos = np.repeat(self.start[k] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            value = np.bincount(np.repeat(r, n) * self.m + self.lm[pos], weights=np.repeat(w, n) * self.w[pos],
                                minlength=len(part) * self.m).reshape(len(part), self.m)
            near = np.flatnonzero(value.max(1) >= FLOOR * np.sqrt(np.maximum(norm, 1e-9)))
            if not len(near):
                continue
            mine = np.zeros(len(part), dtype=bool)
            mine[near] = True
            mine = mine[row]
            both, at = np.unique(row[mine] * np.int64(CODES ** 3) + key[mine], return_inverse=True)
            w = np.bincount(at, weights=weight[mine], minlength=len(both))
            true = np.sqrt(np.bincount(both // CODES ** 3, weights=w * w, minlength=len(part)))[near]
            got = value[near] / np.maximum(true, 1e-9)[:, None]
            got = np.where(got >= FLOOR, got, 0)
            for j, v in zip(near.tolist(), got):
                if v.any():
                    yield part[j], v

    def matrix(self, strings: list[str]) -> np.ndarray:
        near, none = dict(self(strings)), np.zeros(self.m)
        return np.array([near.get(s, none) for s in strings])


class Reader:
    """From texts to what their windows near a landmark hold: kernel vectors, or
    with ``weights`` their scores. Remembered by word, by run of words and by window."""

    def __init__(self, kernel: Kernel, weights: np.ndarray | None = None):
        self.kernel, self.weights = kernel, weights
        # Of a word: the values of its windows, its pieces as a sentence shows them, and whether windows reach beyond it.
        self.known, self.said, self.open, self.runs, self.near = {}, {}, {}, {}, {}
        self.hot: set = set()  # words with any value
        halves = sorted({f"{h.strip('^$')}" for m in kernel.landmarks for h in m.split("$^") if "$^" in m})
        self.halves = Kernel([f"^{h}$" for h in halves]) if halves else None
        if halves:
            self.halves.slides = []  # whole words only

    def compare(self, strings: set) -> None:
        """Fill ``near``: the values of windows, None for those that are near no landmark."""
        if len(self.near) + len(strings) > MEMORY:
            self.near = {}
        fresh = sorted((w for w in strings if w not in self.near), key=len)
        self.near.update(dict.fromkeys(fresh))
        for w, v in self.kernel(fresh):
            self.near[w] = v.astype(np.float32) if self.weights is None else float(v @ self.weights)

    def values(self, ws: set) -> list:
        """The values of those of the windows that are near a landmark, in the windows' order."""
        near = [w for w in ws if self.near[w] is not None]
        return [self.near[w] for w in (sorted(near) if len(near) > 1 else near)]

    def slide(self, streams: list[str]) -> dict[int, set]:
        """The sliding windows that may be near a landmark, by the number of the text that holds any."""
        found: dict[int, set] = {}
        i = 0
        while i < len(streams):
            j, held = i, 0
            while j < len(streams) and (j == i or held + len(streams[j]) < SLIDE_CHARS):
                held += len(streams[j]) + 1
                j += 1
            hits = self.kernel.slide("\n".join(streams[i:j]))
            if hits:
                ends = np.cumsum(np.fromiter(map(len, streams[i:j]), dtype=np.int64, count=j - i) + 1)
                for k, (_, w) in zip(np.searchsorted(ends, [h for h, _ in hits], side="right").tolist(), hits):
                    found.setdefault(i + k, set()).add(w)
            i = j
        return found

    def learn(self, tokens: set) -> None:
        """Read new words: as a whole, by their pieces, and every second character of the long ones."""
        new = tokens.difference(self.known)
        if not new:
            return
        if len(self.known) + len(new) > MEMORY:
            self.known, self.said, self.open, self.hot = {}, {}, {}, set()
            new = tokens
        fresh, long, streams, whole = list(new), {}, [], {}
        for i, t in enumerate(fresh):
            if t.isalpha():
                w, lines = t, f"^{t}$"
                self.said[t] = lines
            else:
                w = EDGE.sub("", t)
                w, said = (w, [w]) if w.isalpha() else (read(t), pieces(t))
                lines = "".join([f"^{x}$" for x in said])
                self.said[t] = lines + "\n" if ENDS.search(t) else lines
                if w and lines != f"^{w}$":
                    lines = f"{lines}\n^{w}$"
            n = len(w)
            self.open[t] = 0 < n <= SHORT
            if self.halves is not None and SHORT < n <= WINDOW - 2:
                whole.setdefault(f"^{w}$", []).append(t)
            if n >= 2 * GAPPED - 1:
                lines = f"{lines}\n^{w[::2]}$\n^{w[1::2]}$"
                if n > WINDOW - 2:
                    long[i] = windows(w)
            streams.append(lines)
        own = self.slide(streams)
        for i, ws in long.items():
            own.setdefault(i, set()).update(ws)
        self.compare(set().union(*own.values()))
        self.known.update(dict.fromkeys(fresh, ()))
        for i, ws in own.items():
            if got := self.values(ws):
                self.known[fresh[i]] = got
                self.hot.add(fresh[i])
        if self.halves is not None:
            lines = list(whole)
            may = {w for i in range(0, len(lines), SLIDE_ROWS) for _, w in self.halves.slide("\n".join(lines[i:i + SLIDE_ROWS]))}
            for w, _ in self.halves(sorted(may, key=len)):
                for t in whole[w]:
                    self.open[t] = True

    def across(self, words: list[str]) -> set:
        """The runs of words that windows slide across: short words, which may be an insult's
        parts, and words near half of a landmark of two."""
        return {"".join(map(self.said.__getitem__, words[m.start():m.end()]))
                for m in OPEN_RUN.finditer(bytes(map(self.open.__getitem__, words)))}

    def places(self, texts: list) -> list[tuple[list, list]]:
        """Per text the values of the windows of each of its different words, and of those across words."""
        low = [(t or "").lower() for t in texts]
        split = [t.split() for t in low]
        tokens = [set(t) for t in split]
        for t, own in zip(low, tokens):
            own.update(INNER.sub("", m) for m in SPELT.findall(t))
        every = set().union(*tokens)
        self.learn(every)
        runs = [self.across(t) for t in split]
        if len(self.runs) > MEMORY:
            self.runs = {}
        fresh = list(set().union(*runs).difference(self.runs))
        found = self.slide(fresh)
        self.compare(set().union(*found.values()))
        new = dict.fromkeys(fresh, ())
        new.update((fresh[i], self.values(ws)) for i, ws in found.items())
        out = [([self.known[t] for t in sorted(own & self.hot)],
                [v for r in sorted(mine) for v in (new[r] if r in new else self.runs[r])]) for own, mine in zip(tokens, runs)]
        self.runs.update((r, v) for r, v in new.items() if len(r) <= REMEMBERED)
        return out

    def __call__(self, texts: list) -> list[list]:
        """Per text the values of all its words' and sentences' windows."""
        return [[v for word in words for v in word] + slid for words, slid in self.places(texts)]

    def pooled(self, texts: list) -> np.ndarray:
        """Per text and landmark how much of its words is near the landmark, or how near its nearest
        window is if that is more; in logarithms."""
        out = np.zeros((len(texts), self.kernel.m))
        for row, (words, slid) in zip(out, self.places(texts)):
            for word in words:
                row += word[0] if len(word) == 1 else np.max(word, axis=0)
            for v in slid:
                np.maximum(row, v, out=row)
        return np.log1p(out)


def svm(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[np.ndarray, float]:
    """Linear support vector machine (squared hinge, Newton steps over the rows
    inside the margin, classes weigh the same); y is 0 or 1."""
    x = np.hstack([x, np.ones((len(x), 1))])
    s = np.where(y > 0, 1.0, -1.0)
    c = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y == 0).sum(), 1))
    w, active = np.zeros(x.shape[1]), None
    for _ in range(50):
        now = s * (x @ w) < 1
        if active is not None and np.array_equal(now, active):
            break
        active = now
        a = x[active] * c[active, None]
        w = np.linalg.solve(a.T @ x[active] + ridge * np.eye(x.shape[1]), a.T @ s[active])
    return w[:-1], float(w[-1])


def pairs(text: str) -> set:
    """The pairs of neighbouring words of a text's sentences, as sliding windows show them."""
    out, before = set(), ""
    for token in text.lower().split():
        for w in pieces(token):
            if before and 3 <= len(before) + len(w) <= WINDOW - 4:
                out.add(f"{before}$^{w}")
            before = w
        if ENDS.search(token):
            before = ""
    return out


def firsts(texts: list[str]) -> list[int]:
    """The texts that aren't near copies of one before: of their smallest hashes of three
    neighbouring words at most three quarters were there together."""
    seen: dict[int, int] = {}
    out = []
    for i, t in enumerate(texts):
        words = t.lower().split()
        marks = sorted({zlib.crc32(" ".join(words[j:j + 3]).encode("utf-8", "surrogatepass")) for j in range(max(len(words) - 2, 1))})[:SKETCH]
        met = [seen[m] for m in marks if m in seen]
        if not met or 4 * max(map(met.count, set(met))) <= 3 * len(marks):
            out.append(i)
            seen.update(dict.fromkeys(marks, i))
    return out


def choose(texts: list[str], y: np.ndarray) -> list[str]:
    """Landmark windows: words far more frequent in toxic texts, and pairs of words
    that are so while neither word is, no two alike. Copies of a text count once:
    what they repeat is no evidence."""
    own = firsts(texts)
    texts, y = [texts[i] for i in own], y[own]
    df: dict = {}
    for t, v in zip(texts, y):
        for w in {w for x in set(t.lower().split()) for w in {read(x), *pieces(x)}}:
            if 3 <= len(w) <= WINDOW - 2:
                df.setdefault(w, [0, 0])[int(v)] += 1
    n0, n1 = max((y == 0).sum(), 1), max((y == 1).sum(), 1)
    rate = lambda a, b: b / n1 * np.log(((b + 0.5) / (n1 + 1)) / ((a + 0.5) / (n0 + 1)))
    share = n1 / (n0 + n1)
    proof = lambda a, b: b * np.log(b / (a + b) / share) + (a * np.log(a / (a + b) / (1 - share)) if a else 0)
    value = {w: rate(a, b) for w, (a, b) in df.items() if b >= 2 and b / n1 > 4 * a / n0}
    # Of the many words of a few toxic texts some are there by chance: the evidence for a word must outweigh their number.
    least = min(np.log(max(len(df), 2)) / 2, max((proof(*df[w]) for w in value), default=0) / 2)
    value = {w: v for w, v in value.items() if proof(*df[w]) >= least}
    slots = np.zeros(PAIR_SLOTS, dtype=np.int32)  # toxic texts by hash of their pairs, to remember only frequent ones
    spot = lambda p: zlib.crc32(p.encode("utf-8", "surrogatepass")) % PAIR_SLOTS
    floor = PAIR_EVIDENCE / np.log((n0 + n1) / n1)
    for t, v in zip(texts, y):
        if v:
            slots[list({spot(p) for p in pairs(t)})] += 1
    both: dict = {}
    if slots.max() >= floor:
        for t, v in zip(texts, y):
            for p in pairs(t):
                if slots[spot(p)] >= floor and not any(w in value for w in p.split("$^")):
                    both.setdefault(p, [0, 0])[int(v)] += 1
    for p, (a, b) in both.items():
        if b / n1 > 4 * a / n0 and proof(a, b) >= PAIR_EVIDENCE:
            value[p] = rate(a, b)
    words = [f"^{w}$" for w in sorted(value, key=lambda w: (-value[w], w))[:CANDIDATES]]
    if not words:
        return []
    close = Kernel(words).matrix(words)
    out: list[int] = []
    for i in range(len(words)):
        if len(out) < LANDMARKS and all(close[i, j] < ALIKE for j in out):
            out.append(i)
    return [words[i] for i in out]


def fit(labelled: list[tuple[str, int]]) -> dict:
    """The model from (text, label) rows."""
    y = np.array([v for _, v in labelled], dtype=float)
    texts = [t or "" for t, _ in labelled]
    marks = choose(texts, y) if 0 < y.sum() < len(y) else []
    if not marks:
        return {"share": float(y.mean()) if len(y) else 0.5}
    kernel = Kernel(marks)
    own = kernel.matrix(marks)
    values, vecs = np.linalg.eigh((own + own.T) / 2)
    root = vecs @ np.diag(1 / np.sqrt(np.maximum(values, 0.05))) @ vecs.T
    reader, seen = Reader(kernel), []
    for i in range(0, len(texts), TRAIN_BATCH):  # the driver holds the windows of a few texts at a time, and a row of each text
        seen.append(reader.pooled(texts[i:i + TRAIN_BATCH]))
        reader.near = {}
    x = np.vstack(seen)
    w, b = svm(x @ root, y)
    far = x @ (root @ w) + b
    prior = np.where(y > 0, 1 / y.sum(), CLEAN / (1 - y).sum()) * len(y) / (1 + CLEAN)
    (shift, slope), (_, mean), (_, dev) = logistic(np.column_stack([np.ones(len(far)), far]), y, prior)
    slope, shift = slope / dev, shift - slope * mean / dev
    return {"marks": marks, "u": root @ w, "b": b, "slope": slope, "shift": shift}


def score(df: DataFrame, model: dict, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and the column ``score``."""
    if "share" in model:
        return df.select(*keep, F.lit(model["share"]).alias("score"))
    shared = df.sparkSession.sparkContext.broadcast(model)  # at most LANDMARKS words and weights

    def make():
        m = shared.value
        reader = Reader(Kernel(m["marks"]))

        def run(texts):
            far = reader.pooled(texts) @ m["u"] + m["b"]
            return {"score": 1 / (1 + np.exp(-np.clip(m["slope"] * far + m["shift"], -30, 30)))}
        return run

    return map_text(df, text, keep, SCHEMA, make)


def train(docs: DataFrame, labels: DataFrame) -> dict:
    return fit(training_rows(docs, labels, "toxic", FOLDS, HELD, TRAIN_DOCS, TRAIN_CHARS)[0])


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``."""
    out = score(docs.select("doc_id", "text"), train(docs, labels), ["doc_id"])
    return out.select("doc_id", (crc_mod_col("doc_id", FOLDS) == HELD).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
