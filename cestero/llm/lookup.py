"""Token ids of texts by looking up pieces that a worker has met before.

The libraries' patterns never let a match run on over a space that follows
other text: a space that has a non-space before it or after it begins a match.
Texts are therefore cut at single spaces, and each piece, with the space that
leads it, is encoded once and then looked up. A slice in which a piece would
begin with further white space is encoded as a whole instead.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from tokenizers import Tokenizer

from cestero.llm.text import SLICE, Memo, of_worker, slices

#: A space at which a text can be cut whatever stands around it.
_CUT = re.compile(r"(?<=\S) (?=\S)")


def library(tokenizer_json: str, owner: str) -> Tokenizer:
    """The library with a vocabulary, once a worker; Spark alone decides how many threads run."""

    def load() -> Tokenizer:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        return Tokenizer.from_str(tokenizer_json)

    return of_worker(owner, f"library {hash(tokenizer_json)}", load)


def space_led(text: str, first: bool) -> list[str]:
    """Keys of the pieces. The first piece of a text has no space before it in
    the text; its key begins with one, which no other key does."""
    words = text.split(" ")
    if first:
        words[0] = " " + words[0]
        return words
    return words[1:]


def text_of(key: str) -> str | None:
    """The text of a piece; None where the slice has to be encoded as a whole."""
    if key[:1] == " ":
        return key[1:]
    return None if not key or key[0].isspace() else " " + key


def white_split(text: str, first: bool) -> list[bytes]:
    """Keys of pieces for a library that drops white space and writes all in lower case.

    ASCII is written so here already, where that cannot make a special token nor
    a letter that a combining mark would join.
    """
    raw = text.encode()
    return (raw if b"<|" in raw or b"\xcc" in raw else raw.lower()).split()


def small(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in short batches, so that what is made of them is short too."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def looked_up(
    texts: Iterable[str],
    memo: Memo,
    keys: Callable[[str, bool], list],
    encode: Callable[[list], list],
    whole: Callable[[str], list],
    size: int = SLICE,
) -> Iterator[tuple[int, list]]:
    """Number of a text with the values of its pieces; a long text comes in parts.

    ``encode`` gets all pieces of a block of texts that are not remembered, each
    once, and gives their values, None for a piece that cannot stand alone.
    ``whole`` gives the values of a slice that has such a piece.
    """
    block, chars = [], 0

    def values() -> Iterator[tuple[int, list]]:
        lists = [(k, s, keys(s, first)) for k, s, first in block]
        found = [list(map(memo.get, words)) for _, _, words in lists]
        missing = set()
        for (_, _, words), got in zip(lists, found):
            if None in got:
                missing.update([w for w, v in zip(words, got) if v is None])
        table = {key: memo.old.pop(key, None) for key in missing}
        new = [key for key, value in table.items() if value is None]
        table.update(zip(new, encode(new) if new else ()))
        for key, value in table.items():
            if value is not None:
                memo.keep(key, value)
        for (k, s, words), got in zip(lists, found):
            if None in got:
                got = [table[w] if v is None else v for w, v in zip(words, got)]
            yield k, whole(s) if None in got else got

    for k, text in enumerate(texts):
        first = True
        for piece in slices(text, size, _CUT):
            block.append((k, piece, first))
            first, chars = False, chars + len(piece)
            if chars >= size:
                yield from values()
                block, chars = [], 0
    yield from values()
