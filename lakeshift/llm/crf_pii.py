"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes.

The patterns (email, ip, card, phone) give the base spans.  The field tags the
words around every word that holds a digit, an ``@`` or a bracketed *at* with
begin / inside labels of the four kinds and adds the spans that the patterns
miss: numbers glued into longer chains of digits, phones without a plus, masked
addresses.  Other words hold no evidence for a label and are outside by
definition.  Added spans must be valid for their kind (digits, Luhn, parts) and
may not touch a base span.

The field is trained on a small labelled table (``labelled_table`` or one's
own: text and spans) by maximising its penalised likelihood; decoding is
Viterbi over padded batches of whole word sequences, however long, in numpy.

Defined cases: a null text counts as empty; repeated rows are searched each;
an empty table gives an empty result; columns other than ``doc_id`` and
``text`` are not read.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.session import ship_package

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

# ---------------------------------------------------------------- fixed patterns
LOCAL = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# No match can begin inside a run of digits that gave none at its first digit.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    d = [int(c) for c in reversed(digits)]
    return (sum(d[0::2]) + sum(x * 2 - 9 * (x > 4) for x in d[1::2])) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local@domain: the local part is the run of its characters before an ``@``."""
    done, at = 0, text.find("@")
    while at >= 0:
        before = text[done:at]
        start = at - (len(before) - len(before.rstrip(LOCAL)))
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        done = found.end() if found else at + 1
        at = text.find("@", done)


def valid(kind: str, s: str) -> bool:
    digits = "".join(DIGIT.findall(s))
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in s.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 8 <= len(digits) <= 15
    return True


def base_spans(text: str) -> list[Span]:
    out: list[Span] = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for kind, pattern in (("ip", IP), ("card", CARD), ("phone", PHONE)):
            out += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if valid(kind, m[0])]
    return out


# ---------------------------------------------------------------- words and their shapes
WORD = re.compile(r"[^\x20\x09-\x0D]+")
CANDIDATE = re.compile(r"[0-9@]+|[\[({]\s?at\s?[\])}]", re.IGNORECASE)
AROUND = 3
#: Positions of a batch whose features are held at once, and padded words of a batch (a longer sequence is a batch of its own).
PIECE = 100
CELLS = 400_000
TAGS = ("O", *[f"{p}-{k}" for k in KINDS for p in "BI"])
WORDS_SEEN = {"at", "dot", "[at]", "[dot]", "(at)", "(dot)", "version", "tel", "phone", "call", "card", "ip", "email", "mail"}


class _Shapes(dict):
    def __missing__(self, c: int) -> str:
        x = chr(c)
        out = self[c] = "9" if x in "0123456789" else "A" if x.isupper() else "a" if x.isalpha() else x
        return out


_SHAPES = _Shapes()
LONG_RUN = re.compile(r"(.)\1{4,}", re.DOTALL)


def shape(word: str) -> str:
    """Digits as 9, letters as a or A, others as they are; runs end at four.  Shapes over 80 characters go by their digest."""
    out = LONG_RUN.sub(r"\1\1\1\1", word.translate(_SHAPES))
    return out if len(out) <= 80 else hashlib.sha256(out.encode("utf-8", "replace")).hexdigest()


def _collapsed(s: str) -> str:
    return re.sub(r"(.)\1+", r"\1", s)


def word_features(words: list[str], start: int = 0, end: int | None = None) -> list[list[str]]:
    """Features of words[start:end], the neighbours outside of them included."""
    end = len(words) if end is None else min(end, len(words))
    lo, hi = max(start - 1, 0), min(end + 1, len(words))
    s = [shape(w) for w in words[lo:hi]]
    c = [_collapsed(x) for x in s]
    n = [sum(x in "0123456789" for x in w) for w in words[lo:hi]]
    if lo == start:
        s, c, n = ["", *s], ["<", *c], [0, *n]
    if hi == end:
        s, c, n = [*s, ""], [*c, ">"], [*n, 0]
    return [
        [
            "1",
            f"s={s[i]}",
            f"c={c[i]}",
            f"n={min(n[i], 20)}",
            f"cn={c[i]}:{min(n[i], 20)}",
            f"-c={c[i - 1]}",
            f"+c={c[i + 1]}",
            f"-c,c={c[i - 1]}|{c[i]}",
            f"c,+c={c[i]}|{c[i + 1]}",
            f"-n,n,+n={min(n[i - 1], 9)},{min(n[i], 20)},{min(n[i + 1], 9)}",
            f"w={w}" if (w := words[start + i - 1].lower().strip(".,;:")) in WORDS_SEEN else "w",
        ]
        for i in range(1, end - start + 1)
    ]


def sequences(text: str) -> list[list[tuple[int, int]]]:
    """Runs of words (start, end) around every candidate word; all words outside are of no kind."""
    runs: list[list[tuple[int, int]]] = []
    until = 0
    for m in CANDIDATE.finditer(text):
        if m.start() < until:
            continue
        lo, hi = m.start(), m.end()
        # AROUND words to the left, found in a stretch that doubles until it holds them.
        step = 64
        while True:
            a = max(until, lo - step)
            left = list(WORD.finditer(text, a, lo))
            if a == until or len(left) > AROUND + 1:
                break
            step *= 2
        if a > until and left:
            left = left[1:]  # may begin before the stretch
        start = left[-min(len(left), AROUND + 1)].start() if left else lo
        words, after, p = [], 0, start
        while after <= AROUND and (w := WORD.search(text, p)):
            words.append((w.start(), w.end()))
            p = w.end()
            after = 0 if CANDIDATE.search(text, w.start(), w.end()) or w.start() < hi else after + 1
        runs.append(words)
        until = p
    return runs


# ---------------------------------------------------------------- the field
class Field:
    """Weights of a linear-chain conditional random field: emissions by feature, transitions, starts."""

    def __init__(self, names: dict[str, int]):
        self.names = names
        self.w = np.zeros((len(names) + 1, len(TAGS)))  # the last row stays zero: features never seen
        self.trans = np.zeros((len(TAGS), len(TAGS)))
        self.start = np.zeros(len(TAGS))

    def emissions(self, batch: list[list[list[str]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(emissions [sequence, position, tag], lengths, feature numbers [sequence, position, feature])."""
        lengths = np.array([len(x) for x in batch])
        width = len(batch[0][0])
        ids = np.full((len(batch), lengths.max(), width), len(self.names))
        for i, x in enumerate(batch):
            ids[i, : len(x)] = [[self.names.get(f, len(self.names)) for f in fs] for fs in x]
        return self.w[ids].sum(2), lengths, ids

    def viterbi(self, batch: list[list[str]]) -> list[list[int]]:
        """The best tags of whole word sequences; emissions are held for ``PIECE`` positions at a time, back pointers for all."""
        lengths = np.array([len(x) for x in batch])
        n, t_max, k = len(batch), int(lengths.max()), len(TAGS)
        back = np.zeros((t_max, n, k), np.int8)
        score = np.zeros((n, k))
        for a in range(0, t_max, PIECE):
            live = np.flatnonzero(lengths > a)
            e = self.emissions([word_features(batch[i], a, a + PIECE) for i in live])[0]
            for t in range(a, a + e.shape[1]):
                on = lengths[live] > t
                rows = live[on]
                if not t:
                    score[rows] = self.start + e[on, 0]
                    continue
                step = score[rows, :, None] + self.trans[None]
                back[t, rows] = step.argmax(1)
                score[rows] = step.max(1) + e[on, t - a]
        tag, every = score.argmax(1), np.arange(n)
        out = np.zeros((t_max, n), np.int8)
        for t in range(t_max - 1, -1, -1):
            out[t] = tag
            tag = np.where(lengths > t, back[t, every, tag], tag)
        return [out[:m, i].tolist() for i, m in enumerate(lengths)]

    def fit(self, batch: list[list[list[str]]], tags: list[list[int]], steps: int = 80, penalty: float = 0.02) -> Field:
        """Maximise the penalised likelihood of the tags (forward-backward, Adam)."""
        _, lengths, ids = self.emissions(batch)
        n, t_max, _ = ids.shape
        k = len(TAGS)
        mask = np.arange(t_max)[None] < lengths[:, None]
        y = np.zeros((n, t_max), int)
        for i, x in enumerate(tags):
            y[i, : len(x)] = x
        gold = np.eye(k)[y] * mask[..., None]
        params = [self.w, self.trans, self.start]
        m1, m2 = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        for step in range(1, steps + 1):
            e = self.w[ids].sum(2)
            alpha, beta = np.zeros((n, t_max, k)), np.zeros((n, t_max, k))
            alpha[:, 0] = self.start + e[:, 0]
            for t in range(1, t_max):
                new = np.logaddexp.reduce(alpha[:, t - 1][:, :, None] + self.trans, 1) + e[:, t]
                alpha[:, t] = np.where(mask[:, t, None], new, alpha[:, t - 1])
            for t in range(t_max - 2, -1, -1):
                new = np.logaddexp.reduce(self.trans[None] + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
                beta[:, t] = np.where(mask[:, t + 1, None], new, 0)
            z = np.logaddexp.reduce(alpha[:, -1], 1)
            p = np.exp(alpha + beta - z[:, None, None]) * mask[..., None]
            ge, gt = gold - p, np.zeros((k, k))
            for t in range(1, t_max):
                live = mask[:, t]
                pair = np.exp(alpha[live, t - 1][:, :, None] + self.trans + (e[live, t] + beta[live, t])[:, None, :] - z[live][:, None, None])
                gt += np.einsum("ni,nj->ij", gold[live, t - 1], gold[live, t]) - pair.sum(0)
            flat = ids.reshape(-1)
            gw = np.stack([np.bincount(flat, np.repeat(ge[..., j].reshape(-1), ids.shape[2]), len(self.w)) for j in range(k)], 1)
            gw[-1] = 0
            grads = [gw - penalty * self.w, gt - penalty * self.trans, ge[:, 0].sum(0) - penalty * self.start]
            for q, g, a, b in zip(params, grads, m1, m2, strict=True):
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                q += 0.1 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
        self.w[-1] = 0
        return self


# ---------------------------------------------------------------- the labelled table
_OTHER = (
    "Version 2.0. {v}", "on 2024-05-06 at 12:30", "12/05/2021", "for $45.99 or 1,234,567 in 2019", "page 12 of 300", "100% of 3.14",
    'token = "{h}"', "key: {h}", "id {u}", "order 20391 and 77", "10:15:30", "section 4.2.1", "v1.2.3-rc1", "chapter 7,", "{n} items",
    "ISBN 978-3-16-148410-0", "sha {h}", "8th of 31", "room B12, floor 3", "@home and @work", "x@ y", "#1234567890", "ref {n}-{n}",
)


def labelled_table(rows: int = 600, seed: int = 5) -> list[tuple[str, list[Span]]]:
    """A small labelled table: invented sentences with personal data of the four kinds, and with look-alikes."""
    r = random.Random(seed)
    digits = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    pick = r.choice

    def word() -> str:
        w = "".join(pick("aeiou" if i % 2 else "bcdfglmnrst") for i in range(r.randint(2, 9)))
        w = w.capitalize() if r.random() < 0.1 else w
        return w + pick(("", "", "", "", "", ",", ".", "!!", " |"))

    def card() -> str:
        n = pick((16, 16, 16, 17, 18, 19))
        d = pick("3456") + digits(n - 2)
        d += next(c for c in "0123456789" if luhn(d + c))
        sep = pick(("", "", " ", "-"))
        return sep.join(d[i : i + 4] for i in range(0, n, 4)) if n == 16 else d

    def phone() -> str:
        a, b, c = digits(3), digits(3), digits(4)
        return pick((f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+44 {digits(2)} {c} {digits(4)}", f"{a}.{b}.{c}", f"+{digits(2)}{a}{b}{c}", f"+1-{a}-{b}-{c}", f"+1 {a} {b} {c}"))

    def ip() -> str:
        return ".".join(str(r.randint(0, 255)) for _ in range(4))

    def email() -> str:
        n, d = word().strip(".,!| ").lower(), word().strip(".,!| ").lower()
        top = pick(("com", "org", "net", "example.com"))
        return pick((f"{n}@{d}.{top}", f"{n}.{digits(2)}@{d}.{top}", f"{n}@{d}.{top}", f"{n} [at] {d} [dot] com", f"{n}(at){d}.{top}", f"{n} (at) {d} (dot) org"))

    make = {"card": card, "phone": phone, "ip": ip, "email": email}
    out = []
    for _ in range(rows):
        text, spans = " ".join(word() for _ in range(r.randint(0, 5))), []
        for _ in range(r.randint(1, 2)):
            text += " " if text else ""
            if r.random() < 0.55:
                kind = pick(KINDS)
                for _ in range(pick((1, 1, 1, 2))):
                    s = make[kind]()
                    text += "" if not text or text.endswith(" ") else " "
                    text += pick(("", "", "", "", "(", '"'))
                    spans.append((kind, len(text), len(text) + len(s)))
                    text += s + pick(("", "", "", ".", ",", ")"))
            else:
                text += pick(_OTHER).format(v=word(), h="".join(pick("0123456789abcdef") for _ in range(pick((20, 32, 40)))), n=digits(r.randint(2, 6)), u=digits(r.randint(7, 13)))
            text += "".join(" " + word() for _ in range(r.randint(0, 4)))
        out.append((text, spans))
    return out


def train(table: list[tuple[str, list[Span]]]) -> Field:
    batch, tags = [], []
    for text, spans in table:
        for run in sequences(text):
            batch.append(word_features([text[a:b] for a, b in run]))
            y = []
            for a, b in run:
                hit = next(((k, s) for k, s, e in spans if s < b and a < e), None)
                y.append(0 if hit is None else TAGS.index(f"{'B' if a <= hit[1] else 'I'}-{hit[0]}"))
            tags.append(y)
    names: dict[str, int] = {}
    for x in batch:
        for fs in x:
            for f in fs:
                names.setdefault(f, len(names))
    return Field(names).fit(batch, tags)


_EXACT = {
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"),
    "card": re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){15,18}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9])(?:\+[0-9]|\([0-9]{1,5}\)|[0-9])[\x20().0-9-]+[0-9](?![0-9])"),
    "email": re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+\s?(?:@|[\[({]\s?at\s?[\])}])\s?[A-Za-z0-9-]+(?:(?:\.|\s?[\[({]\s?dot\s?[\])}]\s?)[A-Za-z0-9-]+)+", re.IGNORECASE),
}


PHONE_START = re.compile(r"(?<![0-9])(?:\+[0-9]|\([0-9]{1,5}\)|[0-9])")


def exact_spans(kind: str, text: str, words: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """All valid matches of the kind's expression in a run of words."""
    lo, hi = words[0][0], words[-1][1]
    if kind == "phone":
        yield from _phones(text, words)
    else:
        yield from (m.span() for m in _EXACT[kind].finditer(text, lo, hi) if valid(kind, m[0]))


def _phones(text: str, words: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Phones are written like their lists: of a match with too many digits, the longest valid part that ends with a word counts."""
    at, hi = words[0][0], words[-1][1]
    while begin := PHONE_START.search(text, at, hi):
        start = begin.start()
        first = last = bisect_right(words, (start, hi)) - 1
        digits = len(DIGIT.findall(text, start, words[first][1]))
        while digits <= 15 and last + 1 < len(words):
            last += 1
            digits += len(DIGIT.findall(text, *words[last]))
        m = _EXACT["phone"].match(text, start, words[last][1])
        if not m:
            at = start + 1
        elif valid("phone", m[0]):
            yield m.span()
            at = m.end()
        elif digits > 15 and m.end() > words[first][1]:
            parts = (_EXACT["phone"].fullmatch(text, start, words[w][1]) for w in range(last - 1, first - 1, -1))
            part = next((x for x in parts if x and valid("phone", x[0])), None)
            if part:
                yield part.span()
            at = part.end() if part else words[first][1]
        else:
            at = m.end()


def batches_of(lengths: list[int], most: int) -> Iterator[tuple[int, int]]:
    """(start, end) of batches of at most ``most`` sequences (by rising length) that take up to ``CELLS`` padded words."""
    a = 0
    for b in range(1, len(lengths) + 1):
        if b == len(lengths) or b - a == most or (b + 1 - a) * lengths[b] > CELLS:
            yield a, b
            a = b


def added_spans(field: Field, texts: list[str], base: list[list[Span]], batch: int = 2000) -> list[list[Span]]:
    """Spans the field finds beside the base spans, for each text."""
    where = [(i, run) for i, t in enumerate(texts) for run in sequences(t)]
    out: list[list[Span]] = [[] for _ in texts]
    where.sort(key=lambda x: len(x[1]))  # sequences of like length share a batch
    for a, b in batches_of([len(run) for _, run in where], batch):
        some = where[a:b]
        tagged = field.viterbi([[texts[i][s:e] for s, e in run] for i, run in some])
        for (i, run), tags in zip(some, tagged, strict=True):
            j = 0
            while j < len(run):
                name = TAGS[tags[j]]
                if name == "O":
                    j += 1
                    continue
                k = j + 1
                while k < len(run) and TAGS[tags[k]] == f"I-{name[2:]}":
                    k += 1
                for lo, hi in exact_spans(name[2:], texts[i], run[j:k]):
                    if not any(s < hi and lo < e for s_ in (base[i], out[i]) for _, s, e in s_):
                        out[i].append((name[2:], lo, hi))
                j = k
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, n_added long, base_sha256 string, spans string"


def _found(field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = field.value
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            base = [base_spans(t) for t in texts]
            more = added_spans(f, texts, base)
            count = [pa.array([sum(k == kind for k, _, _ in b) for b in base], pa.int64()) for kind in KINDS]
            digest = [hashlib.sha256(joined(b).encode()).hexdigest() for b in base]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), *count, pa.array([len(m) for m in more], pa.int64()), pa.array(digest, pa.string()),
                    pa.array([joined(b + m) for b, m in zip(base, more, strict=True)], pa.string()),
                ],
                [c.split()[0] for c in SCHEMA.split(", ")],
            )

    return run


def labelled_rows(spark: SparkSession) -> DataFrame:
    """The small labelled table as a DataFrame (text, spans)."""
    return spark.createDataFrame([(t, joined(s)) for t, s in labelled_table()], "text string, spans string")


def personal_data(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """(doc_id, base counts, n_added, base_sha256, spans) for every row of ``docs``.

    ``n_email`` to ``n_phone`` count base spans, ``n_added`` those of the
    field.  ``labelled`` (text, spans) is a small table of at most some
    thousand rows; it is trained on at the driver.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = (labelled or labelled_rows(spark)).collect()
    parse = lambda s: [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in (s or "").split(",") if x)]
    field = train([(r.text or "", parse(r.spans)) for r in rows])
    shared = spark.sparkContext.broadcast(field)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_found(shared), SCHEMA)
