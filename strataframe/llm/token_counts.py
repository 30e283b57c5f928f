"""Exact token counts of texts of any length by overlap resynchronisation.

A short text goes to the tokenizer whole.  A huge one is cut into chunks that
overlap; each chunk is encoded with the offsets of its tokens.  In the overlap
of two chunks a common boundary is looked for: a place where both encodings
end a token, and which is proven stable, i.e. is a token boundary of the whole
text as well.  The proof is the vocabulary's: BPE merges join only neighbours
inside a piece, so a place between two characters that stand next to each other
in no piece is a boundary whatever the rest of the text is.  Between two such
places the encoding depends on nothing outside, so tokens of the left chunk
before the boundary and of the right chunk after it are those of the whole text.
If an overlap holds no such place, it is widened, twofold each time, in the end
over the rest of the text, so that the count is exact for texts of one endless
word too.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import pandas as pd
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

VOCABULARY = "piece_bpe_32k.model"
LIMIT = 4096
#: Characters of a chunk and of the first overlap.
CHUNK, OVERLAP = 1 << 14, 1 << 8
#: Characters up to which a text is encoded whole.
WHOLE = 1 << 15
#: Texts given to the tokenizer at once.
GROUP_CHARS = 1 << 20
#: The piece types of the model file that ordinary text can give.
NORMAL, USER_DEFINED, BYTE = 1, 4, 6
SPACE = "▁"


class PieceCounter:
    """Counts with one sentencepiece BPE model file."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP, whole: int = WHOLE):
        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        rules = spec.normalizer_spec
        # a chunk's text must mean the same alone as inside the whole
        self.splittable = (
            spec.trainer_spec.model_type == 2
            and not rules.precompiled_charsmap
            and not rules.remove_extra_whitespaces
            and rules.escape_whitespaces
            and not any(p.type == USER_DEFINED for p in spec.pieces)
        )
        pieces = [p.piece for p in spec.pieces if p.type == NORMAL]
        self.pairs = {x for p in pieces for x in zip(p, p[1:])}
        self.chunk, self.overlap, self.whole = chunk, overlap, whole
        self.prefixed = bool(rules.add_dummy_prefix)
        # put before a chunk: it stands in no piece, so nothing joins it
        self.guard = next(c for c in "\n\x00\x01\x02" if not any(c in p for p in pieces))
        self.guard_tokens = len(self.processor.encode(self.guard))

    def stable(self, text: str, at: int) -> bool:
        """Whether the place before character ``at`` is a proven boundary."""
        a, b = (SPACE if c == " " else c for c in (text[at - 1], text[at]))
        return (a, b) not in self.pairs

    def ends(self, text: str, start: int, stop: int) -> dict[int, int]:
        """Encodes text[start:stop] as a chunk: by offset in the whole text, the
        number of the chunk's tokens that end there or before."""
        guard = "" if start == 0 else self.guard
        part = guard + text[start:stop]
        # the library's offsets count bytes
        begins, at = {}, 0
        for k, c in enumerate(part):
            begins[at] = k
            at += 1 if c < "\x80" else len(c.encode())
        begins[at] = len(part)
        found, skipped = {}, self.guard_tokens if guard else 0
        pieces = self.processor.encode(part, return_type="proto").pieces
        for n, piece in enumerate(pieces[skipped:], 1):
            # of a character's byte pieces all but the last end where it begins
            found.setdefault(start + begins[piece.end] - len(guard), n)
        found[stop] = len(pieces) - skipped
        return found

    def count(self, text: str) -> int:
        """The number of tokens of the whole text."""
        if len(text) <= self.whole or not self.splittable:
            return len(self.processor.encode(text))
        total, start, spliced = 0, 0, 0
        while True:
            # invariant: tokens up to ``spliced`` are counted; a chunk begins there
            stop = min(len(text), start + self.chunk)
            if stop == len(text):
                return total + self.ends(text, start, stop)[stop]
            left = self.ends(text, start, stop)
            width, place = self.overlap, None
            while place is None:
                # the next chunk begins ``width`` before this one's end
                low = max(spliced + 1, stop - width)
                place, right_begin = self._common(text, left, low, stop)
                if place is None and low == spliced + 1:
                    # nothing stable in all of this chunk: it must grow
                    stop = min(len(text), start + 2 * (stop - start))
                    left, width = self.ends(text, start, stop), stop - start
                    if stop == len(text):
                        return total + left[stop]
                elif place is None:
                    width *= 2
            total += left[place]
            start = spliced = place

    def _common(self, text: str, left: dict[int, int], low: int, stop: int) -> tuple[int | None, int]:
        """The last stable place in [low, stop) at which the left chunk and one
        that begins at ``low`` both end a token."""
        right = None
        for at in range(stop - 1, low - 1, -1):
            if at in left and self.stable(text, at):
                right = self.ends(text, low, stop) if right is None else right
                if at in right or at == low:
                    return at, low
        return None, low


@functools.cache
def _loaded(path: str) -> PieceCounter:
    return PieceCounter(path)


def _path(vocabulary: str) -> str:
    """A file's place on the machine that asks: a path or a public name."""
    return vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)


def counts(texts: list[str], counter: PieceCounter) -> list[int]:
    """Token counts; texts short enough to be encoded whole go in groups."""
    out = [0] * len(texts)
    group: list[int] = []
    size = 0

    def flush():
        for k, ids in zip(group, counter.processor.encode([texts[k] for k in group], num_threads=1, return_type="numpy")):
            out[k] = len(ids)

    for k, t in enumerate(texts):
        if len(t) > counter.whole:
            out[k] = counter.count(t)
        else:
            group.append(k)
            size += len(t)
            if size > GROUP_CHARS:
                flush()
                group, size = [], 0
    if group:
        flush()
    return out


def token_counts(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    limit: int = LIMIT,
    id_column: str = "doc_id",
    text: str = "text",
    make: Callable[[str], PieceCounter] = _loaded,
) -> DataFrame:
    """One row per input row: id, ``n_bytes`` (UTF-8), ``n_tokens``, and
    ``over_limit`` (more tokens than ``limit``).

    A null text counts as empty, which has no bytes and no tokens.  Rows with
    equal ids or texts each give a row, no rows give none, further columns are
    not used."""

    @F.pandas_udf("long")
    def counted(texts: pd.Series) -> pd.Series:
        return pd.Series(counts([t or "" for t in texts], make(_path(vocabulary))), dtype="int64")

    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_column).alias("doc_id"), F.octet_length(body).cast("long").alias("n_bytes"), counted(body).alias("n_tokens"))
    return rows.select(F.col("doc_id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
