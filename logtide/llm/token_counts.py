"""Token counts with a whole-token shortcut.

Which strings of the vocabulary come out as one token when encoded alone is proved once per
worker by encoding all of them. A text is cut into pre-tokens; those strings count one at
once, and only the other pre-tokens go through the merges of the library.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from logtide.llm.common import ship

# The pre-token pattern of the byte-level vocabulary: contractions, letters, digits, other
# signs, white space. It holds for the characters below, on whose class Python and the
# library agree; a text with any other is cut by the library's own pre-tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\w\s]|_)+|\s+(?!\S)|\s+"""
OTHER = r"[^\t-\r\x20-\x7e\xa0-\xb1\xb4-\xb8\xba\xbb\xbf-\u0233\u0410-\u044f\u2010-\u2027\u20ac]"
MEMO = 800_000


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary, reversed."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    letters.update({chr(256 + k): b for k, b in enumerate(x for x in range(256) if x not in set(plain))})
    return letters


def whole_tokens(tokenizer) -> set[str]:
    """Strings of the vocabulary that encode alone as exactly one token."""
    letters, texts = byte_letters(), []
    for entry in tokenizer.get_vocab(with_added_tokens=False):
        try:
            texts.append(bytes(letters[c] for c in entry).decode("utf-8"))
        except (KeyError, UnicodeDecodeError):
            continue  # part of a character: never a pre-token of its own
    texts = [t for t in texts if t]
    encoded = tokenizer.encode_batch(texts, add_special_tokens=False)
    return {t for t, e in zip(texts, encoded, strict=True) if len(e.ids) == 1}


class Counter(dict):
    """Number of tokens by pre-token: the whole tokens, and a bounded memo of merged ones."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = whole_tokens(self.tokenizer)
        self.find, self.odd = re.compile(PATTERN).findall, re.compile(OTHER).search
        special = "|".join(re.escape(s) for s in self.specials)
        self.cut = re.compile(special) if special else None
        self.letters = byte_letters()
        self.written = {b: c for c, b in self.letters.items()}
        super().__init__(dict.fromkeys(self.whole, 1))

    def __missing__(self, piece: str) -> int:
        if len(self) > len(self.whole) + MEMO:
            self.clear()
            self.update(dict.fromkeys(self.whole, 1))
        n = self[piece] = len(self.tokenizer.model.tokenize(self.spelled(piece)))
        return n

    def spelled(self, piece: str) -> str:
        """A pre-token in the letters of the vocabulary."""
        return piece.encode("utf-8").decode("latin-1").translate(self.written)

    def pieces(self, text: str) -> list[str]:
        if not self.odd(text):
            return self.find(text)
        raw = self.tokenizer.pre_tokenizer.pre_tokenize_str(text)
        return [bytes(self.letters[c] for c in piece).decode("utf-8") for piece, _ in raw]

    def count(self, text: str) -> int:
        if self.cut is None or "<|" not in text:
            return sum(map(self.__getitem__, self.pieces(text)))
        parts = self.cut.split(text)
        return len(parts) - 1 + sum(sum(map(self.__getitem__, self.pieces(p))) for p in parts)


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, path: str | None = None, limit: int = 512) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): UTF-8 bytes, tokens, and whether they pass ``limit``.

    ``path`` is a byte-level vocabulary file present on every worker (default: the public one of 50k). Null text counts as empty:
    no bytes, no tokens. Null ids and repeated rows stay; other columns are not read.
    """

    ship(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(path or vocabulary_path("byte_bpe_50k.json"))
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            counts = [tokens.count(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(t.encode("utf-8")) for t in texts], pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array([n > limit for n in counts], pa.bool_()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        count, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean"
    )
