"""Token counts with overlap resynchronisation.

Huge documents are cut into chunks.  Around each nominal cut the text is
encoded twice with offsets, once as the end of the chunk before and once as
the beginning of the chunk after it; the two overlap.  A position is a proven
stable boundary if white space ends or begins there, from it on both encodings
have the same tokens at the same offsets, and the texts cut there have these
tokens too; there the chunks are spliced, and the tokens on either side are
those of the whole text.  If the encodings do not align, the overlap is
doubled until they do or the chunks are one.

Between stable boundaries segments are encoded on their own.  Where no token
of the tokenizer spans white space (``word_ends=True``: the pre-tokenizer
drops it), the count of a segment is the sum over its words, and counts of
words seen before are kept in a table of bounded size.

Defined cases: a null text counts as empty and has no tokens; repeated rows
are counted each; an empty table gives an empty result; columns other than
``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshift.session import ship_package

CHUNK = 1 << 16
OVERLAP = 512
#: Tokens in a row on which both encodings must agree.
AGREE = 4
LIMIT = 2048
KEPT_WORDS = 400_000
KEPT_LENGTH = 64
#: New words encoded together.
JOINED = 1000
SPACES = frozenset(b" \t\n\x0b\x0c\r")


def _char_start(data: bytes, at: int) -> int:
    """The start of the code point that holds byte ``at``."""
    while 0 < at < len(data) and data[at] & 0xC0 == 0x80:
        at -= 1
    return at


class Counter:
    """Counts the tokens of UTF-8 texts as the tokenizer gives them for the whole text."""

    def __init__(self, tokenizer, word_ends: bool, chunk: int = CHUNK, overlap: int = OVERLAP):
        self.tokenizer, self.word_ends, self.chunk, self.overlap = tokenizer, word_ends, chunk, overlap
        self.kept: dict[bytes, int] = {}
        self.widened = 0

    def _starts(self, data: bytes, lo: int, hi: int) -> list[tuple[int, int, int]]:
        """(byte position, id, end in bytes) of the tokens of data[lo:hi] encoded on its own."""
        text = data[lo:hi].decode()
        at = [lo]
        for c in text:
            at.append(at[-1] + len(c.encode()))
        e = self.tokenizer.encode(text, add_special_tokens=False)
        return [(at[a], i, at[b]) for i, (a, b) in zip(e.ids, e.offsets, strict=True)]

    def splice(self, data: bytes, begin: int, at: int) -> int | None:
        """A proven stable boundary near ``at`` (after ``begin``), or None if the text has none up to its end."""
        overlap = self.overlap
        while True:
            lo, mid_lo = _char_start(data, max(begin, at - 2 * overlap)), _char_start(data, max(begin, at - overlap))
            mid_hi, hi = _char_start(data, min(len(data), at + overlap)), _char_start(data, min(len(data), at + 2 * overlap))
            left, right = self._starts(data, lo, mid_hi), self._starts(data, mid_lo, hi)
            place = {token: k for k, token in enumerate(right)}
            run = 0
            for k in range(len(left) - 1, -1, -1):
                # The last token of the left text may continue beyond it, the first of the right one may begin before it.
                same = place.get(left[k], -1)
                agrees = same > 0 and (run == 0 or same + 1 == after) and left[k][2] < mid_hi
                run, after = (run + 1, same) if agrees else (0, -1)
                p = left[k][0]
                if run >= AGREE and p > begin and (data[p - 1] in SPACES or data[p] in SPACES):
                    if self._starts(data, lo, p) == left[:k] and self._starts(data, p, hi) == right[same:]:
                        return p
            if mid_hi == len(data) and lo == begin:
                return None
            overlap *= 2
            self.widened += 1

    def segments(self, data: bytes) -> Iterator[bytes]:
        """``data`` cut at proven stable boundaries into pieces of about ``chunk`` bytes."""
        begin = 0
        while len(data) - begin > self.chunk + 2 * self.overlap:
            cut = self.splice(data, begin, begin + self.chunk)
            if cut is None:
                break
            yield data[begin:cut]
            begin = cut
        yield data[begin:] if begin else data

    def _encoded(self, texts: list[bytes]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]

    def _word_counts(self, words: list[bytes]) -> Iterator[int]:
        """Tokens of each word; many are encoded as one text, in which each token's offset names its word."""
        for a in range(0, len(words), JOINED):
            some = [w.decode() for w in words[a : a + JOINED]]
            begins = np.cumsum([0] + [len(w) + 1 for w in some])
            e = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            at = np.array([b for b, _ in e.offsets], np.int64)
            yield from np.bincount(np.searchsorted(begins, at, "right") - 1, minlength=len(some)).tolist()

    def counts(self, texts: list[bytes]) -> list[int]:
        """Tokens of each text: those of a long one are counted in its spliced segments, encoded as they are."""
        out = [0] * len(texts)
        for i, t in enumerate(texts):
            if len(t) > self.chunk:
                out[i] = sum(self._encoded([s])[0] for s in self.segments(t))
        short = [i for i, t in enumerate(texts) if len(t) <= self.chunk]
        if not self.word_ends:
            for i, n in zip(short, self._encoded([texts[i] for i in short]), strict=True):
                out[i] = n
            return out
        for i in short:
            words = texts[i].split()
            new = list({w for w in words if w not in self.kept and len(w) <= KEPT_LENGTH})
            if len(self.kept) + len(new) > KEPT_WORDS:
                self.kept.clear()
                new = list({w for w in words if len(w) <= KEPT_LENGTH})
            self.kept.update(zip(new, self._word_counts(new), strict=True))
            long = [w for w in words if len(w) > KEPT_LENGTH]
            out[i] += sum(map(self.kept.__getitem__, words if not long else [w for w in words if len(w) <= KEPT_LENGTH]))
            out[i] += sum(self._encoded(long)) if long else 0
        return out


@cache
def counter(path: str, word_ends: bool) -> Counter:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Counter(Tokenizer.from_file(path), word_ends)


def _counts(name: str, word_ends: bool, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        count = counter(str(public_tokenizers.path(name)), word_ends)
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.large_string()).cast(pa.large_binary()).to_pylist()]
            tokens = count.counts(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return run


def token_counts(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", word_ends: bool = True, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs``.

    ``tokenizer`` is a file name of the installed public tokenizers (library
    tokenizers).  ``word_ends`` may only be set for tokenizers without tokens
    across white space.
    """
    ship_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _counts(tokenizer, word_ends, limit), "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
