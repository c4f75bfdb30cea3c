"""Words of whole texts as UTF-8 bytes, taken in bounded pieces.

A text of any length is split at its separators into pieces of about
``PIECE_BYTES``, so that a task never holds the word objects of a whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

from ticketflow.llm.common import ASCII_LOWER, ASCII_UPPER

PIECE_BYTES = 1 << 20

_ALNUM = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_LOWER = bytes.maketrans(ASCII_UPPER.encode(), ASCII_LOWER.encode())
# A-Z lower-cased; every ASCII character but letters and digits a space.
ALNUM_WORDS = _LOWER.translate(_ALNUM)
# ASCII white space as spaces, all else kept.
SPACED_WORDS = bytes(32 if 9 <= c <= 13 else c for c in range(256))


def word_pieces(text: bytes | None, table: bytes, size: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """Lists of consecutive words of ``text``; ``table`` maps separators to spaces."""
    if not text:
        return
    at = 0
    while at < len(text):
        end = at + size
        piece = text[at:end].translate(table)
        if end < len(text) and not piece.endswith(b" "):
            # go on to the end of the word that the cut would split
            rest = []
            while end < len(text):
                more = text[end:end + 4096].translate(table)
                cut = more.find(b" ")
                if cut >= 0:
                    rest.append(more[:cut])
                    end += cut
                    break
                rest.append(more)
                end += len(more)
            piece += b"".join(rest)
        at = end
        words = piece.split()
        if words:
            yield words
