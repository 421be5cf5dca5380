"""Scoring documents for abusive, hateful and sexual content with class-conditional Kneser-Ney models.

A text is normalised (width, case and accents; invisible marks; spelled-out, masked and digit-for-letter
words), cut into sentences and tokens. For every class, ordinary language and each category, an
interpolated Kneser-Ney trigram model is estimated; all back off to one unigram distribution that the
classes share, so that an expression too rare for one class costs it a backoff and not a surprise, and
words that no class has seen count for none. A token's evidence for a category is the difference of its
log-likelihoods under the category and under ordinary language; a stretch's evidence is its sum, divided
by its length plus a constant. The score of a document is that of its best stretch.

Ratings are of documents, but mostly a single sentence offends. So the models are fitted in rounds: at
first the category takes the sentences whose words are typical of its documents, then those that the
last models give to it. Sentences are always
judged by what the other half of the documents taught. Thresholds are where held-out ratings turn from
mostly yes to mostly no.

Fitting uses at most ``SAMPLE`` rated documents of ``CHARACTERS`` in all, those with the smallest hash of
their id; a category without any rating is a word list, a model of its seed words only. Scoring covers
every document whole: it is a map over Arrow batches with the models' tables broadcast. Their size is
bounded by the sample: at most three n-grams for each of its tokens.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from math import log

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CATEGORIES = ("abusive", "hateful", "sexual")
#: Rated documents used for fitting at most, and their characters in all.
SAMPLE, CHARACTERS = 15_000, 100_000_000
ROUNDS = 2
DISCOUNT = 0.75
#: Evidence below which a sentence of a toxic document teaches its category nothing.
EVIDENCE = 0.5
#: Share of the greatest evidence from which another category is close.
CLOSE = 0.6
#: Evidence of a single token at most.
CLIP = 5.0
#: Sentences whose scores a worker remembers, words whose tokens it remembers, documents that it scores at a time.
MEMORY, WORDS_KEPT, AT_ONCE = 50_000, 200_000, 500
#: Sentences longer than this are scored one by one.
LONG = 400
#: Words that offend by themselves, as prior occurrences; ratings decide beside them.
LEXICON = {
    "abusive": "idiot moron imbecile cretin stupid dumb loser scumbag jerk clown fraud liar pathetic worthless disgusting halfwit numbskull bastard asshole bitch trash garbage filthy brainless kill yourself fuck idiota imbecil estupido estupida inutil mierda callate muere palhaco burro lixo otario cala idioten dummkopf schwachkopf arschloch maul dumm verreck <mask>",
    "hateful": "vermin subhuman subhumans animals foreigners immigrants migrants inferior deport cleansing parasites savages extranjeros inmigrantes imigrantes estrangeiros bichos animales auslander ungeziefer untermenschen abschaum migranten",
    "sexual": "sex sexy nude nudes naked horny breasts nipples thighs moaning undress orgasm porn sexo desnuda desnudo nua nuas transar gemendo tetas nackt nacktbilder geil brustwarzen",
}
LEXICON = {c: tuple(ws.split()) for c, ws in LEXICON.items()}
_SEEDS = {w for ws in LEXICON.values() for w in ws}
#: Cyrillic letters that look like Latin ones.
LOOKALIKES = str.maketrans("аеорсухіјѕ", "aeopcyxijs")
#: Added to the length that evidence is divided by.
PRIOR_LENGTH = 5.0
#: Digits and signs written for letters.
LEET = str.maketrans("013457@$", "oieastas")

_JOIN = str.maketrans("", "", "-_")
_INVISIBLE = re.compile(r"[­​-‏⁠-⁤﻿‪-‮]")
_SPELLED = re.compile(r"(?<![^\W\d_])(?:[^\W\d_][ .\-_*]){2,}[^\W\d_](?![^\W\d_])")
_TOKEN = re.compile(r"[^\W_](?:[\w'’*#@$-]*[\w*])?|[!?]+")
_SENTENCE = re.compile(r"(?<=[.!?…])\s+|\n+")
_MASK = re.compile(r"[^\W\d_][*#]+|[*#]+[^\W\d_]")


class _Marks(dict):
    """Translation table without combining marks, filled as characters occur."""

    def __missing__(self, code: int) -> int | None:
        self[code] = None if unicodedata.combining(chr(code)) else code
        return self[code]


_NO_MARKS = _Marks()


def normalise(text: str) -> str:
    if text.isascii():
        x = text.lower()
    else:
        x = _INVISIBLE.sub("", unicodedata.normalize("NFKC", text))
        x = unicodedata.normalize("NFKD", x.casefold()).translate(_NO_MARKS)
    return _SPELLED.sub(lambda m: re.sub(r"[ .\-_*]", "", m[0]), x)


def _forms(word: str) -> tuple[str, ...]:
    """The tokens of one word of a normalised sentence."""
    parts = [word]
    if "-" in word or "_" in word:
        joined = word.translate(_JOIN)
        parts = [joined] if joined in _SEEDS else re.split("[-_]+", word)
    out = []
    for w in parts:
        if re.search("[а-яіјѕ]", w) and re.search("[a-z]", w):
            w = w.translate(LOOKALIKES)
        if _MASK.search(w):
            w = "<mask>"
        elif any(c.isdigit() for c in w):
            if w.isdigit() or not re.search(r"[a-z]", w):
                w = "<num>"
            elif re.fullmatch(r"\d+(st|nd|rd|th|mm|cm|um|km|m|x|bp|kb)", w):
                w = "<num>"
            else:
                w = w.translate(LEET)
        elif "@" in w or "$" in w:
            w = w.translate(LEET)
        out.append(w)
    return tuple(out)


class _Forms(dict):
    """Tokens by word; forgets all when there are too many, so that memory is bounded."""

    def __missing__(self, word: str) -> tuple[str, ...]:
        got = _forms(word)
        if len(self) > WORDS_KEPT:
            self.clear()
        self[word] = got
        return got


_KNOWN = _Forms()


def tokens(sentence: str) -> list[str]:
    """Tokens of a normalised sentence; a number or several in a row become one sign, masked words another."""
    out: list[str] = []
    for word in _TOKEN.findall(sentence):
        for w in ("<num>",) if word.isdigit() else _KNOWN[word]:
            if w != "<num>" or out[-1:] != ["<num>"]:
                out.append(w)
    return out


def sentences(text: str | None) -> list[list[str]]:
    if not text or not text.strip():
        return []
    return [t for s in _SENTENCE.split(normalise(text)) if (t := tokens(s))]


class Model:
    """Interpolated Kneser-Ney trigrams of one class over a shared unigram base; words are numbers below ``size``."""

    def __init__(self, rows: dict[tuple[int, ...], float], base: np.ndarray):
        size = len(base)
        self.base, self.size = base.tolist(), size
        c3: dict[int, float] = {}
        for s, w in rows.items():
            a = b = 0
            for c in s:
                k = (a * size + b) * size + c
                c3[k] = c3.get(k, 0.0) + w
                a, b = b, c
        # lower orders count distinct continuations, weighted up to one occurrence
        square = size * size
        c2: dict[int, float] = {}
        for k, n in c3.items():
            c2[k % square] = c2.get(k % square, 0.0) + min(n, 1.0)
        c1: dict[int, float] = {}
        for k, n in c2.items():
            c1[k % size] = c1.get(k % size, 0.0) + min(n, 1.0)
        self.p3, self.b3 = self._level(c3, size)
        self.p2, self.b2 = self._level(c2, size)
        self.p1, b1 = self._level(c1, 0)
        self.b1 = b1.get(0, 1.0)
        # the same tables as arrays: dense by word, sorted by key
        first = np.zeros(size)
        first[list(self.p1)] = list(self.p1.values())
        self.low = first + self.b1 * np.asarray(base)
        self.back2 = np.full(size, np.nan)
        self.back2[list(self.b2)] = list(self.b2.values())
        self.key2, self.val2 = self._sorted(self.p2)
        self.key3, self.val3 = self._sorted(self.p3)
        self.head3, self.back3 = self._sorted(self.b3)

    @staticmethod
    def _level(counts: dict[int, float], size: int) -> tuple[dict[int, float], dict[int, float]]:
        """Discounted probabilities, and the share that each context leaves to the lower order."""
        total: dict[int, float] = {}
        kept: dict[int, float] = {}
        cut = lambda n: n - DISCOUNT if n > 1 else n * (1 - DISCOUNT)
        for k, n in counts.items():
            h = k // size if size else 0
            total[h] = total.get(h, 0.0) + n
            kept[h] = kept.get(h, 0.0) + cut(n)
        return {k: cut(n) / total[k // size if size else 0] for k, n in counts.items()}, {h: 1 - kept[h] / t for h, t in total.items()}

    @staticmethod
    def _sorted(table: dict[int, float]) -> tuple[np.ndarray, np.ndarray]:
        keys = np.fromiter(table, np.int64, len(table))
        order = np.argsort(keys)
        return keys[order], np.fromiter(table.values(), float, len(table))[order]

    @staticmethod
    def _at(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Values of the wanted keys, NaN where there is none."""
        if not len(keys):
            return np.full(len(wanted), np.nan)
        i = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[i] == wanted, values[i], np.nan)

    def logs_of(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        """``logs`` for many tokens ``c`` after the tokens ``a`` and ``b``."""
        p = self.low[c]
        m = self.back2[b]
        p = np.where(np.isnan(m), p, np.nan_to_num(self._at(self.key2, self.val2, b * self.size + c)) + m * p)
        h = a * self.size + b
        m = self._at(self.head3, self.back3, h)
        p = np.where(np.isnan(m), p, np.nan_to_num(self._at(self.key3, self.val3, h * self.size + c)) + m * p)
        return np.where(c > 1, np.log(np.maximum(p, 1e-300)), 0.0)

    def prob(self, a: int, b: int, c: int) -> float:
        size = self.size
        p = self.p1.get(c, 0.0) + self.b1 * self.base[c]
        if (m := self.b2.get(b)) is not None:
            p = self.p2.get(b * size + c, 0.0) + m * p
        h = a * size + b
        if (m := self.b3.get(h)) is not None:
            p = self.p3.get(h * size + c, 0.0) + m * p
        return p

    def logs(self, s: tuple[int, ...]) -> list[float]:
        """Log-likelihoods of the tokens; unknown words (1) have none."""
        out, prob, a, b = [], self.prob, 0, 0
        for c in s:
            out.append(log(prob(a, b, c)) if c > 1 else 0.0)
            a, b = b, c
        return out


def best_stretch(x: list[float], clip: float = CLIP) -> float:
    """The greatest sum over (length + constant) of a stretch of tokens, each clipped.

    Raises the ratio until no stretch beats it: what a ratio q leaves of a stretch is the sum of (x - q) less
    q times the constant, and the best stretch for a given q is a maximum subarray.
    """
    x = [min(max(v, -clip), clip) for v in x]
    q = max(x) / (1 + PRIOR_LENGTH)
    while True:
        top, total, n, run, length = -1e18, 0.0, 0, 0.0, 0
        for v in x:
            if run - q * length > 0:
                run, length = run + v, length + 1
            else:
                run, length = v, 1
            if run - q * length > top:
                top, total, n = run - q * length, run, length
        better = total / (n + PRIOR_LENGTH)
        if better <= q + 1e-9:
            return q
        q = better


def best_stretches(x: np.ndarray, clip: float = CLIP) -> np.ndarray:
    """``best_stretch`` of each row; rows are padded with NaN at their ends."""
    x = np.where(np.isnan(x), -1e12, np.clip(x, -clip, clip))
    q = x.max(axis=1) / (1 + PRIOR_LENGTH)
    todo = np.arange(len(x))
    while len(todo):
        y, r = x[todo], q[todo]
        run, length = np.zeros(len(todo)), np.zeros(len(todo))
        top, total, n = np.full(len(todo), -1e18), np.zeros(len(todo)), np.zeros(len(todo))
        for v in y.T:
            on = run - r * length > 0
            run, length = np.where(on, run, 0.0) + v, np.where(on, length, 0.0) + 1
            value = run - r * length
            more = value > top
            top, total, n = np.where(more, value, top), np.where(more, run, total), np.where(more, length, n)
        better = total / (n + PRIOR_LENGTH)
        grown = better > r + 1e-9
        q[todo[grown]] = better[grown]
        todo = todo[grown]
    return q


class Scorer:
    """0 is the sentence start, 1 any unknown word."""

    def __init__(self, words: dict[str, int], ordinary: Model, toxic: dict[str, Model]):
        self.words, self.ordinary, self.toxic = words, ordinary, toxic
        self.near: dict[str, int] = {}
        self.thresholds: dict[str, float] = {}
        self.held_out: dict[str, tuple[int, int, int]] = {}
        self._memo: dict[tuple, dict[str, float]] = {}

    def __getstate__(self):
        return self.__dict__ | {"_memo": {}}

    def numbers(self, s: list[str]) -> tuple[int, ...]:
        return tuple(n if (n := self.words.get(w)) is not None else self.near.get(w) or self._near(w) for w in s)

    def learn_near(self, typical: list[str]) -> None:
        """Unknown words one edit (or two letters swapped) from a typical word of a category count as that word."""
        self.near = {}
        for t in typical:
            for v in {t, *(t[:i] + t[i + 1 :] for i in range(1, len(t)))}:
                self.near.setdefault(v, self.words[t])

    def _near(self, w: str) -> int:
        if len(w) < 4:
            return 1
        for v in (re.sub(r"(.)\1+", r"\1", w), *(w[:i] + w[i + 1 :] for i in range(1, len(w)))):
            if (n := self.near.get(v)) is not None:
                return n
        return 1

    def sentence(self, s: tuple[int, ...]) -> dict[str, float]:
        """The evidence of the best stretch for each category; the leading one comes first. Alike sentences are scored once.

        Clipped evidence levels off, so that an expression of one category that was rated as another a few
        times would be a tie; what leads of those that are close is told by the evidence without the clip.
        """
        if s not in self._memo:
            self.learn([s])
        return self._memo[s]

    def learn(self, wanted: Iterable[tuple[int, ...]]) -> None:
        """Score the sentences that aren't remembered, those of about one length together."""
        new = sorted({s for s in wanted if s not in self._memo}, key=len)
        cats = list(self.toxic)
        if not cats:
            self._memo.update(dict.fromkeys(new, {}))
            return
        lo = 0
        while lo < len(new):
            hi = lo + 1
            longest = max(len(new[lo]) + 2, len(new[lo]) * 5 // 4)
            while hi < len(new) and len(new[hi]) <= longest and hi - lo < 4096 and len(new[hi]) <= LONG:
                hi += 1
            part, lo = new[lo:hi], hi
            over = self._over(part)
            if len(part[-1]) > LONG:
                got = [[best_stretch(x[k].tolist()) for x in over] for k in range(len(part))]
            else:
                got = np.stack([best_stretches(x) for x in over], axis=1).tolist()
            for k, (s, v) in enumerate(zip(part, got)):
                top = max(v)
                close = [i for i, y in enumerate(v) if y >= CLOSE * top] if top >= EVIDENCE else []
                if len(close) > 1:
                    lead = max(close, key=lambda i: best_stretch([y for y in over[i][k].tolist() if y == y], 1e9))
                else:
                    lead = max(range(len(v)), key=v.__getitem__)
                self._memo[s] = {cats[i]: v[i] for i in sorted(range(len(v)), key=lambda i: i != lead)}

    def _over(self, part: list[tuple[int, ...]]) -> list[np.ndarray]:
        """For each category the evidence of every token, a row a sentence; NaN beyond its end."""
        width = max(map(len, part))
        c = np.zeros((len(part), width + 2), np.int64)
        inside = np.zeros((len(part), width), bool)
        for k, s in enumerate(part):
            c[k, 2 : len(s) + 2] = s
            inside[k, : len(s)] = True
        a, b, w = c[:, :-2][inside], c[:, 1:-1][inside], c[:, 2:][inside]
        plain = self.ordinary.logs_of(a, b, w)
        out = []
        for m in self.toxic.values():
            x = np.full(inside.shape, np.nan)
            x[inside] = m.logs_of(a, b, w) - plain
            out.append(x)
        return out

    def of(self, ss: list[tuple[int, ...]]) -> dict[str, float]:
        """The best evidence over sentences. A sentence speaks only for the category that explains it best.

        What it says about the others is how far they lie behind, at most 0.
        """
        out = dict.fromkeys(self.toxic, -np.inf)
        for s in ss:
            got = self.sentence(s)
            lead = next(iter(got), None)
            for c, v in got.items():
                out[c] = max(out[c], v if c == lead else min(0.0, v - got[lead]))
        return out

    def documents(self, texts: Iterable[str | None]) -> Iterator[dict[str, float]]:
        """The evidence of each text; sentences of ``AT_ONCE`` texts are scored together."""
        texts = list(texts)
        for k in range(0, len(texts), AT_ONCE):
            read = [[self.numbers(s) for s in sentences(t)] for t in texts[k : k + AT_ONCE]]
            if len(self._memo) > MEMORY:
                self._memo.clear()
            self.learn(s for ss in read for s in ss)
            yield from map(self.of, read)


Rated = list[tuple[list[tuple[int, ...]], set[str]]]


def _odds(docs: Rated, words: dict[str, int]) -> dict[str, list[float]]:
    """Smoothed log-odds of each word to be in a document of the category rather than in an ordinary one."""
    size = len(words) + 2
    seen = {c: np.zeros(size) for c in ("", *CATEGORIES)}
    many = Counter()
    for ss, cats in docs:
        ws = list({w for s in ss for w in s})
        for c in cats or ("",):
            seen[c][ws] += 1
            many[c] += 1
    for c, ws in LEXICON.items():
        for w in ws:
            if w in words:
                seen[c][words[w]] += 2
        many[c] += 2
    # one document proves little
    for x in seen.values():
        np.maximum(x - 0.75, 0, out=x)
    rate = (sum(seen.values()) + 0.5) / (sum(many.values()) + 1)
    logs = {c: np.log((x + 2 * rate) / (many[c] + 2)) for c, x in seen.items()}
    return {c: (logs[c] - logs[""]).tolist() for c in CATEGORIES}


def _fitted(halves: list[Rated], judges: list, rows: list[dict[str, Counter]], words: dict[str, int], base: np.ndarray) -> Scorer:
    """Models of the selected sentences; ordinary sentences that clearly offend, as the other half judges, are left out."""
    plain: Counter = Counter()
    toxic: dict[str, Counter] = {c: Counter() for c in CATEGORIES}
    for docs, judge, row in zip(halves, judges, rows):
        own = Counter(s for ss, cats in docs if not cats for s in set(ss))
        for s, n in own.items():
            if judge is None or n > 2 or max(judge(s).values(), default=0.0) < 2 * EVIDENCE:
                plain[s] += n
        for c in CATEGORIES:
            toxic[c].update(row[c])
    for c, ws in LEXICON.items():
        toxic[c].update({(words[w],): 1 for w in ws if w in words})
    return Scorer(words, Model(plain, base), {c: Model(r, base) for c, r in toxic.items() if r})


def _models(docs: Rated, words: dict[str, int]) -> Scorer:
    """Fit on (sentences, categories) of rated documents.

    Which sentences of a document offend is judged by what the other half of the documents taught, so a
    wrong rating can't prove itself.
    """
    base = np.zeros(len(words) + 2)
    for ss, _ in docs:
        for s in ss:
            np.add.at(base, list(s), 1.0)
    base[:2] = 0
    base = np.maximum(base, 0.1) / np.maximum(base, 0.1).sum()
    halves = [docs[0::2], docs[1::2]]
    odds = [_odds(halves[1], words), _odds(halves[0], words)]
    judges: list = [None, None]
    for _ in range(ROUNDS + 1):
        for h, half in enumerate(halves):
            if judges[h]:
                judges[h].__self__.learn(s for ss, _ in half for s in ss)
        rows: list[dict[str, Counter]] = []
        for h, half in enumerate(halves):
            row: dict[str, Counter] = {c: Counter() for c in CATEGORIES}
            for ss, cats in half:
                for c in cats if ss else ():
                    v = [got.get(c, 0.0) if judges[h] and (got := judges[h](s)) else best_stretch([odds[h][c][w] if w > 1 else 0.0 for w in s]) for s in ss]
                    if judges[h]:
                        # what clearly belongs to another category doesn't teach this one, whatever the rating
                        v = [x if x >= CLOSE * max(judges[h](s).values(), default=0.0) else 0.0 for s, x in zip(ss, v)]
                    top = max(v)
                    for s, x in zip(ss, v):
                        # a rating without any evidence teaches nothing
                        if x >= EVIDENCE and x >= CLOSE * top:
                            row[c][s] += 1
            rows.append(row)
        if len(rows) == 2 and _ < ROUNDS:
            halfway = [_fitted([halves[h]], [judges[h]], [rows[h]], words, base) for h in (0, 1)]
            judges = [halfway[1].sentence, halfway[0].sentence]
    whole = _fitted(halves, judges, rows, words, base)
    both = _odds(docs, words)
    whole.learn_near([w for w, i in words.items() if len(w) >= 4 and w.isalpha() and (w in _SEEDS or max(both[c][i] for c in CATEGORIES) > 3)])
    return whole


def _threshold(scores: list[float], truth: list[bool]) -> float:
    """Where more of those above are rated so than not; wrong ratings spread over all scores and don't move it."""
    order = np.argsort(-np.array(scores), kind="stable")
    y = np.array(truth)[order]
    s = np.array(scores)[order]
    i = int(np.argmax(np.cumsum(np.where(y, 1, -1))))
    low = s[i + 1] if i + 1 < len(s) and np.isfinite(s[i + 1]) else s[i] - 0.2
    return float((s[i] + low) / 2)


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, folds: int = 2, characters: int = CHARACTERS) -> Scorer:
    """Models and thresholds from the ratings (doc_id, toxic, category) of documents (doc_id, text).

    A document is in a category if at least half of its raters say so. Without any toxic rating nothing
    is ever found. The first ``sample`` rated documents by the hash of their id are used, as far as their
    texts stay within ``characters``.
    """
    votes = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n"), *[F.count_if((F.col("toxic") == 1) & (F.lower(F.trim("category")) == c)).alias(c) for c in CATEGORIES])
    rated = votes.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # at most `sample` ratings go to the documents, so that only rated texts move
    rows = documents.select("doc_id", "text").join(F.broadcast(rated), "doc_id").dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id")
    read, taken = [], 0
    for r in rows.toLocalIterator():
        taken += len(r["text"] or "")
        if taken > characters:
            break
        read.append((sentences(r["text"]), {c for c in CATEGORIES if 2 * r[c] >= r["n"]}))
    freq = Counter(w for ss, _ in read for w in {w for s in ss for w in s})
    words = {w: i + 2 for i, w in enumerate(sorted(w for w, n in freq.items() if n > 1 or w in _SEEDS))}
    docs: Rated = [([tuple(words.get(w, 1) for w in s) for s in ss], cats) for ss, cats in read]
    del read
    held: dict[str, tuple[list, list]] = {c: ([], []) for c in CATEGORIES}
    for k in range(folds):
        part = _models([d for i, d in enumerate(docs) if i % folds != k], words)
        part.learn(s for ss, _ in docs[k::folds] for s in ss)
        for ss, cats in docs[k::folds]:
            got = part.of(ss)
            for c in CATEGORIES:
                held[c][0].append(got.get(c, -np.inf))
                held[c][1].append(c in cats)
        del part
    whole = _models(docs, words)
    for c in whole.toxic:
        s, y = held[c]
        whole.thresholds[c] = max(EVIDENCE, _threshold(s, y)) if any(y) else 2 * EVIDENCE
        found = [v >= whole.thresholds[c] for v in s]
        whole.held_out[c] = (sum(a and b for a, b in zip(found, y)), sum(found), sum(y))
    return whole


def score(documents: DataFrame, scorer: Scorer) -> DataFrame:
    """``(doc_id, category, score, found)`` for each document and category; a text without words scores null.

    Null, empty and blank texts are never found; very long ones are read whole; repeated rows count once;
    an empty table gives no rows.
    """
    shared = documents.sparkSession.sparkContext.broadcast(scorer)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sc = shared.value
        for b in batches:
            ids, cats, vals, found = [], [], [], []
            for i, got in zip(b["doc_id"], sc.documents(b["text"])):
                for c in CATEGORIES:
                    v = got.get(c, -np.inf)
                    ids.append(i)
                    cats.append(c)
                    vals.append(float(v) if np.isfinite(v) else None)
                    found.append(bool(v >= sc.thresholds.get(c, np.inf)))
            yield pd.DataFrame({"doc_id": pd.array(ids, "Int64"), "category": pd.Series(cats, dtype=object), "score": pd.array(vals, "Float64"), "found": pd.array(found, "boolean")})

    # repeated rows are dropped after scoring, when they are small
    return documents.select("doc_id", "text").mapInPandas(run, "doc_id long, category string, score double, found boolean").distinct()
