"""What the token operators share: the piece vocabulary and its safe cut points."""

from __future__ import annotations

import re
import string
from functools import lru_cache

import ahocorasick
import public_tokenizers
import sentencepiece

SPACE = "▁"
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"


def model_path(name: str = "piece_bpe_32k.model") -> str:
    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def processor(path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=4)
def vocabulary(path: str) -> dict[str, tuple[int, float]]:
    """Ordinary pieces: text to (id, score)."""
    sp = processor(path)
    ids = range(sp.vocab_size())
    return {sp.id_to_piece(i): (i, sp.get_score(i)) for i in ids if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}


@lru_cache(maxsize=4)
def automaton(path: str) -> ahocorasick.Automaton:
    """Finds every ordinary piece in a string, by its last character and the longer first, as (length, id, score)."""
    found = ahocorasick.Automaton()
    for piece, (i, score) in vocabulary(path).items():
        found.add_word(piece, (len(piece), i, score))
    found.make_automaton()
    return found


@lru_cache(maxsize=4)
def byte_ids(path: str) -> tuple[int, ...]:
    sp = processor(path)
    return tuple(sp.piece_to_id(f"<0x{b:02X}>") for b in range(256))


@lru_cache(maxsize=4)
def splitter(path: str) -> re.Pattern:
    """Pattern of the segments between which no piece of the vocabulary reaches.

    A segment ends before a space that follows another character, around each
    line feed, and between a Latin letter and a mark such as a full stop.
    All are proved on the vocabulary: no piece holds a space mark after another
    character or a line feed, and only marks that follow a letter in no
    piece are cut off. Segments so cut are encoded alone exactly as they are
    within the text.
    """
    joined = set()
    for piece in vocabulary(path):
        if SPACE in piece.lstrip(SPACE) or "\n" in piece:
            raise ValueError(f"the pieces of {path} cross spaces or line feeds: {piece!r}")
        joined |= {b for a, b in zip(piece, piece[1:], strict=False) if re.match(f"[{LETTERS}]", a)}
    cut = "".join(re.escape(c) for c in string.punctuation if c not in joined)
    more = f"(?:[^{SPACE}\n{cut}]|(?<![{LETTERS}])[{cut}])*" if cut else f"[^{SPACE}\n]*"
    return re.compile(f"\n|{SPACE}+{more}|[^{SPACE}\n]{more}")


def normalize(path: str, text: str) -> str:
    """The library's normalised text, spaces as marks; empty for an empty text."""
    return processor(path).normalize(text)
