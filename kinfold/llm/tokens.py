"""Token ids of whole texts by a fixed public vocabulary."""

from __future__ import annotations

import re
import sys
import types
from array import array
from collections.abc import Callable
from itertools import chain, repeat

import numpy as np
import pyarrow as pa

from kinfold.llm.shared import flat_bytes

#: White space other than space and line feed, in UTF-8 (fixed values), and the null character.
_OTHER_SPACE = (
    b"[\x00\t\v\f\r\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80"
)
#: Signs that often end a word. The vocabulary's word pattern parts letters from them.
_SIGNS = ".,;:!?*#$%&|"
#: Words whose ids a Python worker remembers, before it begins anew: some 80 MB.
REMEMBERED = 500_000
#: Bytes of a word above which it is not remembered.
LONG_WORD = 256
#: Text bytes that are encoded in one step: a word is looked up once in each.
STEP_BYTES = 2 << 20


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary (fixed values).

    Printable bytes stand for themselves, the others for the characters from 256 on, in turn.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(rest)}


class _Memory:
    """Ids of the words that this process has met, one after another, also in earlier tasks."""

    def __init__(self) -> None:
        self.forget()

    def forget(self) -> None:
        self.number: dict[bytes, int] = {}  # word -> place in `begin`
        self.ids = np.zeros(1 << 16, np.uint32)
        self.begin = np.zeros(1 << 14, np.int64)  # and the end of the last
        self.words = 0

    def add(self, ids: list[bytes]) -> int:
        """Append the ids of some words; the place of the first."""
        flat, first = np.frombuffer(b"".join(ids), np.uint32), self.words
        used = int(self.begin[first])
        while used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while first + len(ids) + 1 > len(self.begin):
            self.begin = np.concatenate([self.begin, np.zeros_like(self.begin)])
        self.ids[used : used + len(flat)] = flat
        self.begin[first + 1 : first + len(ids) + 1] = used + np.cumsum([len(x) // 4 for x in ids])
        self.words += len(ids)
        return first

    def drop(self, first: int) -> None:
        self.words = first


def _memory(vocabulary: str) -> _Memory:
    held = sys.modules.setdefault("kinfold_task_memory", types.ModuleType("kinfold_task_memory")).__dict__
    return held.setdefault(f"words {vocabulary}", _Memory())


def _library(vocabulary: str):
    """The vocabulary as the tokenizers library holds it, read once as long as the words are remembered."""
    from tokenizers import Tokenizer

    held = sys.modules.setdefault("kinfold_task_memory", types.ModuleType("kinfold_task_memory")).__dict__
    if f"library {vocabulary}" not in held:
        held[f"library {vocabulary}"] = Tokenizer.from_file(vocabulary)
    return held[f"library {vocabulary}"]


def _places_of(odd: re.Pattern, leads: np.ndarray, raw: np.ndarray) -> list[int]:
    """Where `odd` matches; bytes that no match begins with are skipped in bulk, which is quicker where few others occur."""
    some = np.flatnonzero(leads[raw])
    if len(some) > len(raw) >> 6:
        return [m.start() for m in odd.finditer(raw)]
    return [k for k in some.tolist() if odd.match(raw, k)]


_IS_LETTER, _IS_SIGN = np.zeros(256, bool), np.zeros(256, bool)
_IS_LETTER[[*range(65, 91), *range(97, 123)]] = True
_IS_SIGN[list(_SIGNS.encode())] = True


def _pieces(raw: np.ndarray, at: np.ndarray, odd: re.Pattern, leads: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each piece of the texts begins, the first piece of each text (and the end), and the texts that are one piece.

    A piece is a word with at most one space before it, cut before a sign that follows an ASCII letter, or a line
    feed. A text that has any other white space, or an added token, is one piece.
    """
    n = len(raw)
    space, line = raw == 32, raw == 10
    blank = np.zeros(n + 1, bool)
    np.logical_or(space, line, out=blank[:-1])
    row_start = np.zeros(n + 1, bool)
    row_start[at] = True
    row_start[n] = True
    start = row_start[:-1] | blank[:-1]
    start[1:] |= line[:-1] | (_IS_LETTER[raw[:-1]] & _IS_SIGN[raw[1:]])
    # Blanks next to each other or at an end of a text.
    bad = np.flatnonzero(blank[:-1] & (row_start[:-1] | row_start[1:] | blank[1:]))
    found = _places_of(odd, leads, raw) if n else []
    whole = np.unique(np.searchsorted(at, np.concatenate([bad, np.array(found, np.int64)]), "right") - 1)
    for row in whole:
        start[at[row] + 1 : at[row + 1]] = False
    begin = np.flatnonzero(start)
    return begin, np.searchsorted(begin, at), whole


def encoder(vocabulary: str, end_id: int, remembered: int = REMEMBERED) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]:
    """A function from texts to all their ids one after another, and where each text's begin and the last end.

    Every id comes from the tokenizers library; `end_id` follows each text. A distinct word is encoded once
    as long as the process remembers it: the vocabulary splits a text before a lone space and around a lone
    line feed whatever follows, and between letters and the signs after them, so the ids of a text are
    those of its parts in turn. Texts with any other white space are encoded whole, and so are those that
    hold an added token such as the end of a text, which the library takes as one id before it looks for words.

    Words are handled in bulk: Arrow numbers the different ones of a step, each is looked up once, and
    the ids of all words are gathered by place.
    """
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    library = _library(vocabulary)
    model, letters = library.model, _byte_letters()
    added = [re.escape(t.content.encode()) for t in library.get_added_tokens_decoder().values() if t.content]
    odd = re.compile(b"|".join([_OTHER_SPACE, *added]))
    leads = np.zeros(256, bool)
    leads[[*range(14), *range(28, 32), 0xC2, 0xE1, 0xE2, 0xE3, *(t.content.encode()[0] for t in library.get_added_tokens_decoder().values() if t.content)]] = True
    leads[10] = False
    known = _memory(vocabulary)

    def whole(texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in library.encode_batch_fast(texts, add_special_tokens=False)]

    def ids_of_parts(new: set[str]) -> dict[str, bytes]:
        # Letters after at most one space are one word of the pattern: the model alone is enough.
        plain = [w for w in new if w.isalpha() or (w[:1] == " " and w[1:].isalpha())]
        shown = "\n".join(plain).encode().decode("latin-1").translate(letters).split(letters[10]) if plain else []
        found = [[t.id for t in tokens] for tokens in map(model.tokenize, shown)]
        flat = np.fromiter(chain.from_iterable(found), np.uint32).tobytes()
        ends = (4 * np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))).tolist()
        ids = {w: flat[a:b] for w, a, b in zip(plain, [0, *ends], ends)}
        rest = list(new.difference(plain))
        ids.update(zip(rest, whole(rest)))
        return ids

    def ids_of_words(new: list[str]) -> list[bytes]:
        # Most words end in a letter: only the others can have signs to part.
        heads = {w: w.rstrip(_SIGNS) for w in new if w[-1] in _SIGNS}
        heads = {w: h for w, h in heads.items() if h[-1:].isalpha()}
        if not heads:
            parts = ids_of_parts(set(new))
            return list(map(parts.__getitem__, new))
        tails = {w: w[len(h) :] for w, h in heads.items()}
        parts = ids_of_parts({w for w in new if w not in heads}.union(heads.values(), tails.values()))
        return [parts[heads[w]] + parts[tails[w]] if w in heads else parts[w] for w in new]

    def places(words: list[bytes], length: np.ndarray, is_text: np.ndarray) -> np.ndarray:
        """The place of each word in memory; long ones and whole texts are forgotten after the step."""
        place = np.array(list(map(known.number.get, words, repeat(-1))), np.int64)
        place[is_text] = -1
        missing = np.flatnonzero(place < 0)
        apart = is_text[missing] | (length[missing] > LONG_WORD)
        long, short = missing[apart].tolist(), missing[~apart].tolist()
        if short:
            new = [words[k] for k in short]
            first = known.add(ids_of_words([w.decode() for w in new]))
            place[short] = np.arange(first, first + len(short))
            known.number.update(zip(new, range(first, first + len(short))))
        if long:
            first = known.add(whole([words[k].decode() for k in long]))
            place[long] = np.arange(first, first + len(long))
            known.drop(first)
        return place

    def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if len(known.number) > remembered:
            known.forget()
        raw, at = flat_bytes(texts)
        begin, first, whole_texts = _pieces(raw, at, odd, leads)
        offsets = np.append(begin, len(raw))
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
        numbered = words.dictionary_encode()
        code = numbered.indices.to_numpy(zero_copy_only=False)
        is_text = np.zeros(len(numbered.dictionary), bool)
        is_text[code[first[:-1][whole_texts]]] = True
        bare, ends = flat_bytes(numbered.dictionary)
        flat, bounds = bare.tobytes(), ends.tolist()
        different = [flat[a:b] for a, b in zip(bounds, bounds[1:])]
        place = places(different, np.diff(ends), is_text)[code]
        size = known.begin[place + 1] - known.begin[place]
        # A text without pieces, and every other, still has its end.
        upto = np.concatenate([[0], np.cumsum(size)])
        total = upto[first] + np.arange(len(at))
        out = np.empty(int(total[-1]), np.uint32)
        is_end = np.zeros(len(out), bool)
        is_end[total[1:] - 1] = True
        out[is_end] = end_id
        source = np.repeat(known.begin[place] - upto[:-1], size)
        source += np.arange(len(source))
        out[~is_end] = known.ids[source]
        return out, total

    return encode
