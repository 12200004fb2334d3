"""Subword ids of whole texts, by the public tokenizers' files.

Texts part at single spaces between other characters, and Latin words part from a full stop
or comma after them and from a line's end: the pre-tokenizers used here start new pieces
there, so a text's ids are the ids of its pieces, one after another. A worker keeps the ids of
pieces it has seen, up to a bounded number. Texts where a space follows white space other than
a line feed are encoded whole: some pre-tokenizers keep such runs together, and some tokens
span them.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces whose ids a worker keeps.
MEMO = 1_000_000
_WORD = r"[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+"
_LETTERS = [chr(c) for c in (*range(65, 91), *range(97, 123), *range(0xC0, 0x100)) if c not in (0xD7, 0xF7)]
_PLAIN = re.compile(rf" ?{_WORD}")
_SPLIT = re.compile(rf"( ?{_WORD})([.,]?)(?:(\n)({_WORD})([.,]?))?")
_STOPS = (".", ",")
#: White space but the space and the line feed; where a space follows white space.
_ODD = [chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n"]
_RUN = re.compile(r"[^\S\n] ")


def _together(text: str) -> bool:
    """Whether a space in the text may share a token with what stands before it."""
    return "  " in text or any(c in text for c in _ODD) and _RUN.search(text) is not None


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.memo: dict[str, bytes] = {}
        # What the library makes of single letters and of a space before one. A Latin word is
        # one piece to the pre-tokenizers, so it goes to the model letter by letter.
        letters = {c: self._prepared(c) for c in _LETTERS}
        space = self._prepared(" a").removesuffix(letters["a"])
        self.table = str.maketrans({**letters, " ": space})

    def _prepared(self, text: str) -> str:
        normalizer = self.tokenizer.normalizer
        text = normalizer.normalize_str(text) if normalizer else text
        return "".join(piece for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text))

    def words(self, pieces: Sequence[str]) -> list[bytes]:
        """As ``raw``, for single words: Latin ones take the short way to the model."""
        plain = [_PLAIN.fullmatch(p) is not None for p in pieces]
        others = iter(self.raw([p for p, short in zip(pieces, plain, strict=True) if not short]))
        model, table = self.tokenizer.model, self.table
        return [
            array("I", [t.id for t in model.tokenize(p.translate(table))]).tobytes() if short else next(others)
            for p, short in zip(pieces, plain, strict=True)
        ]

    def greatest(self) -> int:
        """The greatest id of the vocabulary."""
        return max(self.tokenizer.get_vocab().values())

    def raw(self, pieces: Sequence[str]) -> list[bytes]:
        done = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in done]

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each text. The batch's pieces are numbered by Arrow, so a piece is looked up
        once a batch, and its ids are gathered by number; pieces not seen before are encoded in
        one call."""
        alone = [t[:1] == " " or t[-1:] == " " or "\0" in t or _together(t) for t in texts]
        whole = iter(self.raw([t for t, lone in zip(texts, alone, strict=True) if lone]))
        parted = pa.array([t for t, lone in zip(texts, alone, strict=True) if not lone], pa.large_string())
        lists = pc.split_pattern(pc.replace_substring(parted, " ", "\0 "), "\0")
        numbered = lists.flatten().dictionary_encode()
        ids = self._pieces(numbered.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        flat, first = np.frombuffer(b"".join(ids), dtype="<u4"), np.cumsum(sizes) - sizes
        which = numbered.indices.to_numpy()
        of_piece = sizes[which]
        upto = np.append(0, np.cumsum(of_piece))
        gathered = flat[np.repeat(first[which] - upto[:-1], of_piece) + np.arange(upto[-1])]
        ends = upto[lists.offsets.to_numpy()].tolist()
        parts = iter([gathered[a:b].tobytes() for a, b in zip(ends, ends[1:])])
        return [next(whole if lone else parts) for lone in alone]

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of distinct pieces: from the memo, or encoded now."""
        memo = self.memo
        ids = [memo.get(p) for p in pieces]
        unseen = [i for i, x in enumerate(ids) if x is None]
        single, split = {}, {}
        for i in unseen:
            p = pieces[i]
            # only a full stop, a comma or a line's end parts a piece
            found = _SPLIT.fullmatch(p) if p[-1:] in _STOPS or "\n" in p else None
            if found is None:
                single[p] = None
            else:
                split[p] = [g for g in found.groups() if g]
        within = {q: None for parts in split.values() for q in parts if q not in single}
        fresh = {q: x for q in within if (x := memo.get(q)) is not None}
        new = [*single, *[q for q in within if q not in fresh]]
        room = MEMO - len(memo)
        for at in range(0, len(new), 10_000):
            block = new[at : at + 10_000]
            fresh.update(zip(block, self.words(block), strict=True))
        joined = [p for p, parts in split.items() if len(parts) > 1]
        fresh.update([(p, b"".join([fresh[q] for q in split[p]])) for p in joined])
        for i in unseen:
            ids[i] = fresh[pieces[i]]
        memo.update([(p, fresh[p]) for p in [*new, *joined][: max(0, room)]])
        return ids


@cache
def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    return Encoder(path)


def public(name: str) -> str:
    """The place of a public tokenizer's file; resolved in the task that uses it."""
    import public_tokenizers

    return public_tokenizers.path(name)
