"""Repairing scanned text: furniture lines, broken words and misrecognised characters.

Two averaged perceptrons are trained here on a bounded sample of rows. One labels lines (body, header,
page number) from their form, their place on the page (distance to the next page-number line, whether the
sentence runs on across the line, length against the block's width) and their words; its first labels
come from plain cases, such as lines beside a page number that interrupt a sentence. The other edits
characters: for every character it weighs keep, replace, delete and insert, and for a line break inside
a word, joining it with or without its hyphen. It learns from words of the sample that are damaged
by the known confusions of scanners, and from undamaged ones.

Decisions rest on the whole corpus: every distinct word is counted over all rows. What a scanner confuses
has the same strokes: ``m`` and ``rn``, ``d`` and ``cl``, ``e`` and ``c``. Each letter stands for its strokes
whatever its neighbours, so that an equi-join on the strokes finds all existing words that a damaged one may
have been, however many of its characters are wrong, and no others reach the editor, which weighs the edits
that lead to each. A reading replaces a word if it is far more frequent than the word itself, or if the word
can't stand as it is (signs or digits inside letters, letters inside digits). Rows are read whole; nothing is cut.
"""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Stages

#: Rows that the perceptrons are trained on at most (those with the smallest hash of their key).
SAMPLE = 1500
#: Words that the editor is trained on at most, and passes over them.
WORDS, PASSES = 6000, 4
#: A reading must be this many times as frequent as the word that it replaces, and occur in so many rows.
RATIO, LEAST = 8, 3

BREAK, PARAGRAPH = "\n", "\n\n"
MARKS = "-­‐‑¬"
#: What a scanner makes of a letter or digit (true, seen).
CONFUSIONS = (
    ("i", "!"), ("i", "í"), ("i", "1"), ("i", "l"), ("l", "1"), ("l", "i"), ("l", "I"), ("o", "0"), ("e", "c"), ("c", "e"), ("s", "5"), ("t", "†"), ("t", "f"), ("g", "9"), ("g", "q"), ("a", "á"), ("b", "6"), ("z", "2"),
    ("h", "li"), ("h", "b"), ("d", "cl"), ("u", "ii"), ("u", "v"), ("m", "rn"), ("rn", "m"), ("w", "vv"), ("n", "ri"), ("n", "u"), ("a", "o"), ("li", "h"), ("cl", "d"), ("H", "II"), ("B", "8"), ("S", "5"), ("O", "0"), ("I", "l"),
)
#: The same for digits.
DIGITS = (("1", "l"), ("1", "I"), ("0", "O"), ("0", "o"), ("5", "S"), ("8", "B"), ("6", "b"), ("2", "Z"), ("9", "g"))

_EDGE = ".,;:()[]{}\"'?“”‘’«»"
_PAGE = re.compile(r"[\W_]*(?:p|pp|pg|page|s|seite)?[.\s]*\d{1,5}(?:\s*(?:of|/)\s*\d{1,5})?[\W_]*", re.I)
_SPACE = re.compile(r"\s+")


class Perceptron:
    """Averaged multiclass perceptron over string features."""

    def __init__(self):
        self.w: dict[str, dict[str, float]] = defaultdict(dict)
        self.sum: dict[tuple[str, str], float] = defaultdict(float)
        self.at: dict[tuple[str, str], int] = defaultdict(int)
        self.n = 0

    def scores(self, feats: list[str], classes) -> dict[str, float]:
        out = dict.fromkeys(classes, 0.0)
        for f in feats:
            if (d := self.w.get(f)) is not None:
                for c in out:
                    if c in d:
                        out[c] += d[c]
        return out

    def _add(self, f: str, c: str, v: float) -> None:
        k = (f, c)
        self.sum[k] += (self.n - self.at[k]) * self.w[f].get(c, 0.0)
        self.at[k] = self.n
        self.w[f][c] = self.w[f].get(c, 0.0) + v

    def learn(self, feats: list[str], classes, truth: str) -> None:
        self.n += 1
        s = self.scores(feats, classes)
        got = max(s, key=lambda c: (s[c], c != truth))
        if got != truth:
            for f in feats:
                self._add(f, truth, 1.0)
                self._add(f, got, -1.0)

    def finish(self) -> Perceptron:
        for f, d in self.w.items():
            for c in d:
                k = (f, c)
                d[c] = (self.sum[k] + (self.n - self.at[k]) * d[c]) / max(1, self.n)
        self.w = {f: {c: round(v, 4) for c, v in d.items() if abs(v) > 1e-3} for f, d in self.w.items()}
        self.sum = self.at = None
        return self


# ---- lines -------------------------------------------------------------------------------------------

LABELS = ("body", "header", "page_no")


def _shape(line: str) -> list[str]:
    x = line.strip()
    words = re.findall(r"[^\W\d_]+", x)
    caps = sum(w.isupper() and len(w) > 1 for w in words)
    title = sum(w[0].isupper() for w in words)
    f = [
        f"page={bool(_PAGE.fullmatch(x))}",
        f"start={'num' if re.match(r'[0-9]', x) else 'low' if x[:1].islower() else 'up' if x[:1].isupper() else 'sign'}",
        f"end={'stop' if x.endswith('.') else 'comma' if x[-1:] in ',;:' else 'hyph' if x[-1:] in MARKS else 'num' if x[-1:].isdigit() else 'other'}",
        f"caps={bool(words) and caps >= 0.7 * len(words)}",
        f"title={bool(words) and title >= 0.6 * len(words)}",
        f"gap={'  ' in x}",
        f"copy={'©' in x}",
        f"year={bool(re.search(r'[(]?[12][0-9]{3}[)]?', x))}",
        f"issue={bool(re.search(r'[a-zA-Z] [0-9]+ [(][12][0-9]{3}[)](  *[0-9]+)?$', x))}",
        f"vol={bool(re.search(r'vol[.]|no[.]', x, re.I))}",
        f"dash={bool(re.search(r' [—–] |:', x))}",
        f"etal={bool(re.search(r'et al[.]|et a1[.]', x, re.I))}",
        f"joint={bool(re.search(r'(?<=[a-z] )(AND|OF)(?= [A-Z])', x)) or bool(re.search(r'&.*:', x))}",
        f"cont={bool(re.search(r'contin|table', x, re.I))}",
        f"n={min(len(words), 7)}",
    ]
    return f + [f"w={w.lower()}" for w in words]


def line_features(lines: list[str], own: set[str] = frozenset(), asked: Callable[[str], bool] = str.strip) -> list[list[str]]:
    """Features of the lines of a block that are asked for, with those of their place; ``own`` are values known to belong to the row."""
    full = sorted((len(x) for x in lines if x.strip()), reverse=True)
    width = full[len(full) // 4] if full else 1
    page = [bool(_PAGE.fullmatch(x)) for x in lines]
    out = []
    for i, x in enumerate(lines):
        if not asked(x):
            out.append([])
            continue
        a, b = i - 1, i + 1
        while a >= 0 and page[a]:
            a -= 1
        while b < len(lines) and page[b]:
            b += 1
        prev, nxt = (lines[a].rstrip() if a >= 0 else ""), (lines[b].lstrip() if b < len(lines) else "")
        runs = bool(prev) and prev[-1] not in ".:!?" and (nxt[:1].islower() or prev[-1] in MARKS)
        place = [
            f"short={len(x) < 0.8 * width}",
            f"near={(i > 0 and page[i - 1]) or (i + 1 < len(lines) and page[i + 1])}",
            f"runs={runs}",
            f"first={i == 0}",
            f"last={i == len(lines) - 1}",
            f"cut={runs and not x[:1].islower()}",
            f"row={bool(own)}",
            f"own={x.strip().casefold() in own or bool(re.fullmatch(r'[A-Z]{1,2}[0-9A-Za-z]{6,9}', x.strip()))}",
        ]
        shape = _shape(x)
        out.append([*place, *shape, f"cutshort={place[0]}{place[5]}", f"up={shape[1]}{shape[2]}{place[0]}"])
    return out


def _seed(feats: list[str]) -> str | None:
    """The label of a plain case."""
    f = dict(x.split("=", 1) for x in feats if not x.startswith("w="))
    if f["page"] == "True":
        return "page_no"
    if f["own"] == "True" or (f["end"] == "stop" and "True" not in (f["etal"], f["cont"])):
        return "body"
    strong = "True" in (f["joint"], f["issue"], f["copy"], f["etal"], f["cont"], f["vol"]) or (f["caps"] == "True" and int(f["n"]) >= 2) or (f["gap"] == "True" and int(f["n"]) >= 3)
    if f["short"] == "True" and f["cut"] == "True" and f["start"] != "low" and f["end"] not in ("comma", "hyph") and (f["near"] == "True" or strong):
        return "header"
    if f["cont"] == "True" and f["start"] == "up" and int(f["n"]) <= 3 or strong and f["row"] == "True" and f["start"] != "low" and f["end"] != "hyph":
        return "header"
    if strong and f["near"] == "True" and f["start"] != "low" and f["end"] not in ("comma", "hyph"):
        return "header"
    if f["start"] == "low" or f["end"] in ("comma", "hyph") or (f["short"] == "False" and f["near"] == "False" and f["caps"] == "False" and f["copy"] == "False"):
        return "body"
    return None


def train_lines(blocks: list[tuple[list[str], set[str]]], rounds: int = 2) -> Perceptron:
    rows = [(f, _seed(f)) for b, own in blocks for f in line_features(b, own) if f]
    model = Perceptron()
    known = [(f, y) for f, y in rows if y]
    rnd = random.Random(5)
    heads = [x for x in known if x[1] == "header"]
    for k in range(rounds + 1):
        if k:
            # lines without a plain label take the model's, if it is sure
            known = [x for x in known if x[1]] if k > 1 else known
            more = []
            for f, y in rows:
                if y is None:
                    s = sorted(((v, c) for c, v in model.scores(f, LABELS).items()), reverse=True)
                    if s[0][0] - s[1][0] > 2:
                        more.append((f, s[0][1]))
            known = [(f, y) for f, y in rows if y] + more
        model = Perceptron()
        for _ in range(3):
            part = rnd.sample(known, min(len(known), 20_000)) + heads + heads
            rnd.shuffle(part)
            for f, y in part:
                model.learn(f, LABELS, y)
        model.finish()
    model.lean = {f: v for f, d in model.w.items() if (v := d.get("header", 0.0) - d.get("body", 0.0))}
    # how header-like form and words alone must be to outweigh an unusual place
    body = sorted(_margins(model, f)[1] for f, y in rows if y == "body")
    model.bar = max(0.0, body[int(0.999 * (len(body) - 1))]) if body else 0.0
    return model


PLACE = ("short=", "near=", "runs=", "first=", "last=", "cut=", "cutshort=", "row=", "up=")


def _margins(model: Perceptron, feats: list[str]) -> tuple[float, float]:
    """How much more the features speak for a header than for the body: all of them, and those of form and words alone."""
    lean = model.lean
    form = place = 0.0
    for f in feats:
        if (v := lean.get(f)) is not None:
            if f.startswith(PLACE):
                place += v
            else:
                form += v
    return form + place, form


def may_be_furniture(line: str) -> bool:
    """Lines that begin in lower case are text."""
    x = line.lstrip()
    return bool(x) and not x[0].islower() or bool(_PAGE.fullmatch(line) and x)


def line_kind(model: Perceptron, feats: list[str]) -> str:
    """What the model takes a line for; a header's form and words alone may outweigh its place."""
    s = model.scores(feats, LABELS)
    if s["page_no"] > max(s["header"], s["body"]):
        return "page_no"
    if "own=True" in feats:
        return "body"
    whole, form = _margins(model, feats)
    return "header" if whole > 0 or form > model.bar else "body"


# ---- characters --------------------------------------------------------------------------------------


def _ops() -> dict[str, dict[str, tuple[str, int]]]:
    """By first seen character: operation -> (text put instead, characters consumed)."""
    out: dict[str, dict[str, tuple[str, int]]] = defaultdict(dict)
    for true, seen in CONFUSIONS + DIGITS:
        out[seen[0]][f"{seen}>{true}"] = (true, len(seen))
    for c in [x for x in out if x.islower()]:
        for true, seen in CONFUSIONS:
            if seen[0] == c and len(seen) == 1 and len(true) == 1:
                out[c.upper()].setdefault(f"{seen.upper()}>{true.upper()}", (true.upper(), 1))
    out[BREAK] = {"join": ("", 1), "hyphen": ("-", 1)}
    return out


OPS = _ops()


def _class(c: str) -> str:
    return "#" if c.isdigit() else "a" if c.islower() else "A" if c.isupper() else c or "_"


def char_features(w: str, i: int) -> list[str]:
    p = "__" + w + "__"
    j = i + 2
    a, b, c, d, e = p[j - 2], p[j - 1], p[j], p[j + 1], p[j + 2]
    k = "".join(map(_class, p[j - 2 : j + 3]))
    digits = sum(x.isdigit() for x in w)
    return [f"0{c}", f"1{b}{c}", f"2{c}{d}", f"3{b}{c}{d}", f"4{a}{b}{c}", f"5{c}{d}{e}", f"6{a}{b}{c}{d}", f"7{b}{c}{d}{e}", f"8{a}{b}{c}{d}{e}", f"k{c}{k}", f"d{c}{'all' if digits + 1 >= len(w) else 'many' if digits >= 3 else 'some' if digits else 'none'}"]


def train_editor(words: Counter) -> Perceptron:
    """From words with counts: each is damaged in several ways, once a time, or left as it is."""
    rnd = random.Random(7)
    pool = [w for w, n in words.most_common() if n >= 2][:WORDS]
    # what codes and numbers look like doesn't depend on the sample
    letters = "ABCDEFGHJKLMNPQRSTUVWXYZ"
    pool += ["".join(rnd.choices(letters, k=2)) + "".join(rnd.choices("0123456789", k=rnd.choice((6, 8)))) for _ in range(500)]
    pool += ["".join(rnd.choices("0123456789", k=rnd.randrange(2, 5))) for _ in range(300)]
    by_true: dict[str, list[str]] = defaultdict(list)
    for true, seen in CONFUSIONS:
        by_true[true].append(seen)
    digit: dict[str, list[str]] = defaultdict(list)
    for true, seen in DIGITS:
        digit[true].append(seen)
    model = Perceptron()
    for _ in range(PASSES):
        rnd.shuffle(pool)
        for w in pool:
            spots = []
            table = digit if sum(c.isdigit() for c in w) >= 2 else by_true
            for i in range(len(w)):
                for true in (w[i], w[i : i + 2]):
                    for seen in table.get(true, ()):
                        spots.append((i, true, seen))
            seen_word, truth = w, {}
            how = rnd.random()
            if how < 0.5 and spots:
                i, true, seen = rnd.choice(spots)
                seen_word = w[:i] + seen + w[i + len(true) :]
                truth = {i: f"{seen}>{true}"}
            elif how < 0.7 and len(w) > 4:
                i = rnd.randrange(2, len(w) - 1)
                if "-" in w[1:-1]:
                    i = w.index("-", 1)
                    seen_word, truth = w[:i] + BREAK + w[i + 1 :], {i: "hyphen"}
                else:
                    seen_word, truth = w[:i] + BREAK + w[i:], {i: "join"}
            for i, c in enumerate(seen_word):
                ops = [o for o, (_, n) in OPS.get(c, {}).items() if seen_word.startswith(o.split(">")[0], i) or c == BREAK]
                if c == BREAK:
                    model.learn(char_features(seen_word, i), ops, truth.get(i, "join"))
                elif ops:
                    model.learn(char_features(seen_word, i), ["keep", *ops], truth.get(i, "keep"))
    return model.finish()


def weigh(model: Perceptron, seen: str, true: str) -> float | None:
    """The best score, against keeping every character, of edits that turn ``seen`` into ``true``, case aside; None if none do."""
    low, n, m = seen.lower(), len(seen), len(true)
    # best[i] = {j: score} of reading seen[:i] as true[:j]
    best: list[dict[int, float]] = [{} for _ in range(n + 1)]
    best[0][0] = 0.0
    for i in range(n):
        if not best[i]:
            continue
        c = seen[i]
        ops = {o: r for o, r in OPS.get(c, {}).items() if c == BREAK or seen.startswith(o.split(">")[0], i)}
        gain: dict[str, float] = {}
        for j, s in best[i].items():
            if c != BREAK and true.startswith(low[i], j) and s > best[i + 1].get(j + 1, -1e9):
                best[i + 1][j + 1] = s
            for o, (put, k) in ops.items():
                if true.startswith(put.lower(), j):
                    if not gain:
                        v = model.scores(char_features(seen, i), ops if c == BREAK else ["keep", *ops])
                        zero = v.get("keep", max(v.values()))
                        gain = {x: y - zero for x, y in v.items()}
                    t = s + gain[o]
                    if t > best[i + k].get(j + len(put), -1e9):
                        best[i + k][j + len(put)] = t
    return best[n].get(m)


#: Characters of one shape, by the letter that stands for them, and the strokes of those letters that have several.
SHAPES = {"i": "l1!í|", "o": "a0á", "c": "e", "s": "5", "t": "†f", "g": "9q", "z": "2", "u": "vnhb68"}
STROKES = (("u", "ii"), ("r", "i"), ("m", "iii"), ("w", "iiii"), ("d", "ci"))


def strokes(c: Column) -> Column:
    """The strokes of a word's characters, hyphens and case aside; equal for all that the known confusions turn into each other."""
    x = F.translate(F.lower(c), "".join(SHAPES.values()) + BREAK + "-", "".join(k * len(v) for k, v in SHAPES.items()))
    for k, v in STROKES:
        x = F.replace(x, F.lit(k), F.lit(v))
    return x


def as_code(t: str) -> str:
    """The reading of a code or number in which every letter among its digits is the digit that it looks like."""
    m = re.match(r"^([A-Za-z]{2})?(?=[0-9A-Za-z]{5,9}$)", t)
    head = m[1] or "" if m and not t[2:3].isalpha() else t[:2] if m and m[1] and m[1].isupper() else ""
    return head + t[len(head) :].translate(_DIGIT_OF)


_DIGIT_OF = str.maketrans({seen: true for true, seen in reversed(DIGITS)})


# ---- rows --------------------------------------------------------------------------------------------


def strip_edges(t: str) -> str:
    t = t.strip(_EDGE)
    return t[:-2] if t.endswith(("'s", "’s")) else t


def odd(t: str) -> bool:
    """Can't stand as it is: a sign or digit among letters, or a letter inside digits."""
    core = re.sub(r"[-‐–/.,'’&=]", "", t)
    if re.fullmatch(r"[A-Za-z]{1,2}[0-9A-Za-z]{5,9}", core) and sum(c.isdigit() for c in core) >= 4 and not core[2:].isdigit():
        return True
    if re.fullmatch(r"[lOIoSBb0-9]{2,6}", core) and any(c.isdigit() for c in core) and not core.isdigit():
        return True
    if re.search(r"[^\W\d_][!†0-9][^\W\d_]|^[!†015][^\W\d_]{2}|[^\W\d_]{3}[!†]$|[a-z]{3}[0159]$", core):
        return True
    return False


def odd_form(c: Column) -> Column:
    """``odd`` of a column."""
    core = F.regexp_replace(c, "[-‐–/.,'’&=]", "")
    digits = F.length(F.regexp_replace(core, "[^0-9]", ""))
    code = core.rlike("^[A-Za-z]{1,2}[0-9A-Za-z]{5,9}$") & (digits >= 4) & ~F.substring(core, 3, 100).rlike("^[0-9]+$")
    number = core.rlike("^[lOIoSBb0-9]{2,6}$") & (digits > 0) & (digits < F.length(core))
    return code | number | core.rlike(r"\p{L}[!†0-9]\p{L}|^[!†015]\p{L}{2}|\p{L}{3}[!†]$|[a-z]{3}[0159]$")


def parse_block(model: Perceptron, lines: list[str], own: set[str] = frozenset()) -> dict:
    """Lines of a row to furniture, and body tokens; a broken word is one token with BREAK inside."""
    kinds = [line_kind(model, f) if f else "body" if x.strip() else "blank" for x, f in zip(lines, line_features(lines, own, may_be_furniture))]
    tokens: list[str] = []
    tail, after_furniture = False, False
    for x, k in zip(lines, kinds):
        if k == "blank":
            if not after_furniture and not tail:
                tokens.append(PARAGRAPH)
            continue
        after_furniture = k != "body"
        if k != "body":
            continue
        ws = x.split()
        if tail and tokens and ws and re.match(r"[(\[“\"]?[^\W\d_]", ws[0]):
            if ws[0][:1].islower() or tokens[-1][:-1].isupper():
                t = tokens.pop()
                tokens.append(t[:-1] + BREAK + ws[0])
                ws = ws[1:]
        tokens += ws
        tail = bool(ws) and len(ws[-1]) > 2 and ws[-1][-1] in MARKS and ws[-1][-2].isalpha()
        if not ws and tokens:
            tail = tokens[-1][-1] in MARKS
    return {"furniture": [(k, x.strip()) for k, x in zip(kinds, lines) if k in ("header", "page_no")], "tokens": tokens}


def _rows(df: DataFrame, name: str, key: str, lines, own=()) -> DataFrame:
    values = F.array_compact(F.array(*[F.lower(F.trim(c)) for c in own])) if own else F.array().cast("array<string>")
    return df.select(F.lit(name).alias("field_name"), F.col(key).cast("string").alias("row_key"), lines.alias("lines"), values.alias("own")).filter("lines is not null and size(lines) > 0")


class Repair:
    """The operator's stages over rows (field_name, row_key, lines, own)."""

    def __init__(self, rows: DataFrame):
        spark = rows.sparkSession
        self.stages = Stages(spark, "scanfix")
        sample = rows.orderBy(F.xxhash64("field_name", "row_key"), "row_key").limit(SAMPLE).collect()
        blocks = [([x or "" for x in r["lines"]], set(r["own"])) for r in {(r["field_name"], r["row_key"]): r for r in sample}.values()]
        self.lines = train_lines(blocks)
        words: Counter = Counter()
        for b, own in blocks:
            for t in parse_block(self.lines, b, own)["tokens"]:
                if BREAK not in t:
                    t = strip_edges(t)
                    if len(t) >= 3 and not odd(t):
                        words[t] += 1
        # codes rarely repeat; they teach what digits look like
        for t in [t for t, n in words.items() if n == 1 and sum(c.isdigit() for c in t) >= 3][:2000]:
            words[t] = 2
        self.editor = train_editor(words)
        shared = spark.sparkContext.broadcast((self.lines, self.editor))

        def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            lm, _ = shared.value
            for b in batches:
                got = [parse_block(lm, [x or "" for x in ls], set(own)) for ls, own in zip(b["lines"], b["own"])]
                yield pd.DataFrame({"field_name": b["field_name"], "row_key": b["row_key"], "furniture": [[{"kind": k, "item": x} for k, x in g["furniture"]] for g in got], "tokens": [g["tokens"] for g in got], "bare": [sorted({t for t in map(strip_edges, g["tokens"]) if len(t) >= 2 and t != PARAGRAPH}) for g in got]})

        # Python work a row is heavy for its bytes: as many tasks as the session shuffles into
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.parsed = self.stages.cut(rows.repartition(tasks, "field_name", "row_key").distinct().mapInPandas(parse, "field_name string, row_key string, furniture array<struct<kind: string, item: string>>, tokens array<string>, bare array<string>"))
        each = self.parsed.select("field_name", "row_key", F.explode("bare").alias("t"))
        # forms first: there are far fewer of them to fold
        by_form = self.stages.cut(each.groupBy("t").agg(F.count("*").alias("n")))
        self.count = self.stages.cut(by_form.groupBy(F.lower("t").alias("low")).agg(F.sum("n").alias("n")))
        forms = by_form.select("t").join(self.count.select("low", "n"), F.lower("t") == F.col("low")).filter(F.col("t").contains(BREAK) | (F.length("t") >= 3)).drop("low")
        forms = forms.withColumn("odd", odd_form(F.col("t"))).filter(F.col("t").contains(BREAK) | F.col("odd") | F.col("t").rlike(r"\p{L}$|[^\x00-\x7f]"))
        forms = self.stages.cut(forms.withColumn("key", strokes(F.col("t"))))
        # words that may be what others were: those that occur often enough, and the most frequent one of their strokes
        words = self.count.filter(F.col("low").rlike(r"^[\p{L}-]{2,}$")).select(F.col("low").alias("to"), F.col("n").alias("m"), strokes(F.col("low")).alias("key"))
        words = words.join(words.groupBy("key").agg(F.max("m").alias("top")), "key").filter((F.col("m") >= LEAST) | (F.col("m") == F.col("top"))).drop("top")
        dashes = lambda c: F.length(F.regexp_replace(c, "[^-]", ""))
        more = dashes("to") - dashes("t")
        broken = F.col("t").contains(BREAK)
        alike = forms.join(words, "key").filter((F.col("to") != F.lower("t")) & F.when(broken, more.isin(0, 1)).otherwise(more == 0) & (broken | F.col("odd") | (F.col("m") >= RATIO * F.col("n"))))

        def written(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                out = [(t, n, o, r.lower()) for t, n, o in zip(b["t"], b["n"], b["odd"]) for r in ([t.replace(BREAK, ""), t.replace(BREAK, "-")] if BREAK in t else []) + ([as_code(t.replace(BREAK, ""))] if o else [])]
                yield pd.DataFrame(out, columns=["t", "n", "odd", "to"])

        # the pieces of a broken word put together, and codes whose letters are read as digits, need no example
        own = forms.filter(broken | F.col("odd")).select("t", "n", "odd").mapInPandas(written, "t string, n long, odd boolean, to string")
        own = own.join(self.count.select(F.col("low").alias("to"), F.col("n").alias("m")), "to", "left").select("t", "n", "odd", "to", F.coalesce("m", F.lit(0)).alias("m"))
        pairs = alike.select("t", "n", "odd", "to", "m").union(own.filter(F.col("to") != F.lower("t"))).distinct()

        def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            _, em = shared.value
            for b in batches:
                v = [weigh(em, t, w) for t, w in zip(b["t"], b["to"])]
                # codes may be read in ways that no edit says
                v = [0.0 if x is None and o and w[-1:].isdigit() else x for x, o, w in zip(v, b["odd"], b["to"])]
                yield b.assign(score=pd.array(v, "Float64")).dropna(subset=["score"])

        offers = pairs.repartition(tasks, "t", "to").mapInPandas(judge, "t string, n long, odd boolean, to string, m long, score double").withColumnRenamed("to", "low")
        broken = F.col("t").contains(BREAK)
        word = F.col("low").rlike(r"^[\p{L}-]+$")
        code = F.col("low").rlike(r"^[a-z]{0,2}\d+$")
        known = (F.col("m") >= LEAST) & (F.col("m") >= RATIO * F.col("n"))
        weight = F.log(1 + F.col("m")) + 0.15 * F.col("score")
        fixed = F.when(broken, F.struct((F.col("m") > 0).alias("a"), weight.alias("b"), "score", "low")).when(F.col("odd"), F.struct((word & (F.col("m") > 0) | code).alias("a"), weight.alias("b"), "score", "low")).when(known & word, F.struct(F.lit(True).alias("a"), weight.alias("b"), "score", "low"))
        best = offers.groupBy("t").agg(F.max(fixed).alias("f")).filter("f is not null")
        # an odd word without any existing reading stays as it is
        self.fixes = self.stages.cut(best.filter(F.col("f.a") | F.col("t").contains(BREAK)).select("t", F.col("f.low").alias("fixed")))
        self.each = each

    def found(self) -> DataFrame:
        """``(field_name, row_key, kind, item)``."""
        furniture = self.parsed.select("field_name", "row_key", F.explode("furniture").alias("f")).select("field_name", "row_key", "f.kind", "f.item")
        hit = self.each.join(self.fixes, "t")
        plain = F.lower(F.regexp_replace("t", BREAK, ""))
        dashed = F.lower(F.regexp_replace("t", BREAK, "-"))
        hyphen = hit.filter(F.col("t").contains(BREAK)).select("field_name", "row_key", F.lit("hyphen").alias("kind"), F.col("fixed").alias("item"))
        char = hit.filter((F.col("fixed") != plain) & (F.col("fixed") != dashed)).select("field_name", "row_key", F.lit("char").alias("kind"), F.col("fixed").alias("item"))
        return furniture.unionByName(hyphen).unionByName(char).distinct()

    def text(self) -> DataFrame:
        """``(field_name, row_key, text, repaired, removed)``: paragraphs, the number of words repaired and of lines removed."""
        hit = self.each.join(self.fixes, "t").groupBy("field_name", "row_key").agg(F.collect_list(F.struct("t", "fixed")).alias("fx"))

        def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                texts, counts = [], []
                for ts, fx in zip(b["tokens"], b["fx"]):
                    known = {x["t"]: x["fixed"] for x in fx} if fx is not None else {}
                    out, n = [], 0
                    for t in ts:
                        core = strip_edges(t)
                        if (f := known.get(core)) is not None:
                            n += 1
                            if core[:1].isupper():
                                f = f.upper() if core.isupper() and len(core) > 1 else f[:1].upper() + f[1:]
                            t = t.replace(core, f, 1)
                        out.append(t.replace(BREAK, "") if t != PARAGRAPH else t)
                    texts.append(re.sub(r" ?\n\n ?", "\n\n", " ".join(out)).strip())
                    counts.append(n)
                yield pd.DataFrame({"field_name": b["field_name"], "row_key": b["row_key"], "text": texts, "repaired": counts, "removed": b["removed"]})

        return self.parsed.select("*", F.size("furniture").alias("removed")).join(hit, ["field_name", "row_key"], "left").select("field_name", "row_key", "tokens", "removed", "fx").mapInPandas(build, "field_name string, row_key string, text string, repaired int, removed int")


def scanned_rows(sections: DataFrame, doc_rows: DataFrame) -> DataFrame:
    """The two scanned fields as rows of lines. Null texts and empty arrays have none; repeated rows count once."""
    lines = F.when(F.length(F.trim("text")) > 0, F.split("text", "\\r?\\n"))
    return _rows(sections, "section_block.text", "section_id", lines).unionByName(_rows(doc_rows, "doc_row.raw_row_lines", "row_id", F.col("raw_row_lines"), ("species", "voucher", "country", "accession")))
