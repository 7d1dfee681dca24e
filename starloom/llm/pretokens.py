"""Cutting a text where no piece of a SentencePiece vocabulary can reach across.

In the vocabularies meant here the white-space marker stands only at the start of a piece, so neither a merge nor a
lattice edge crosses the place before a run of markers.  A text is then the sum of its pre-tokens: runs of markers
(spaces) with the characters up to the next run.
"""

from __future__ import annotations

import re
from functools import lru_cache

MARKER = "▁"
#: Longest pre-token that caches remember.
LONGEST_CACHED = 64
_RUN = re.compile(r" +[^ ]*")


@lru_cache(maxsize=4)
def processor(model: str):
    """The library's processor for a model file, once per process; refuses vocabularies that can't be cut."""
    import sentencepiece

    loaded = sentencepiece.SentencePieceProcessor(model_file=model)
    for i in range(len(loaded)):
        if MARKER in loaded.id_to_piece(i).lstrip(MARKER):
            raise ValueError(f"{model}: a piece has a white-space marker inside, texts can't be cut at markers")
    if loaded.encode(" a ", out_type=str)[:1] not in (["▁▁a"], ["▁"]):
        raise ValueError(f"{model}: the normaliser drops or adds white space")
    return loaded


def pretokens(text: str) -> list[str]:
    """Pre-tokens without their first space (the marker that every one of them starts with)."""
    if not text:
        return []
    if MARKER in text:
        text = text.replace(MARKER, " ")
    words = text.split(" ")
    if "" not in words:
        return words
    return [run[1:] for run in _RUN.findall(" " + text)]
