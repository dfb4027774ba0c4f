"""Fast encoding with a word-level BPE file: a distinct word is encoded once per worker.

The file lower-cases, splits at a fixed pattern and encodes each piece by itself, so a
text's ids are those of its pieces in turn.  Texts of plain Latin characters are split here
with the same pattern and pieces are looked up; any other text goes to the tokenizer whole.
"""

from __future__ import annotations

import json
import re
from array import array
from itertools import chain

import numpy as np

# Characters for which splitting here and in the tokenizer agree: printable ASCII, tab and
# line ends, and Latin-1 from U+00A1 but the soft hyphen.
_OTHER = re.compile("[^\t\n\r\x20-\x7e\xa1-\xac\xae-\xff]|<\\|")
# The tokenizer's own split pattern, letters and numbers of Latin-1 spelled out.
_LETTER = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^\\s{_LETTER}{_NUMBER}]+")


def _byte_characters() -> dict[int, str]:
    """Byte-level BPE writes printable bytes as themselves, the others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class _Words(dict):
    """Word -> number; ids of all words stand in one array, at starts[number]."""

    def __init__(self, model):
        super().__init__()
        self.model, self.table = model, _byte_characters()
        self.ids, self.starts = array("I"), array("q", [0])

    def __missing__(self, word: str) -> int:
        piece = word.encode().decode("latin-1").translate(self.table)
        self.ids.extend(t.id for t in self.model.tokenize(piece))
        self.starts.append(len(self.ids))
        number = self[word] = len(self.starts) - 2
        return number


_LOADED: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """The worker's own, with the words that it has met in earlier tasks."""
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]


class WordTokenizer:
    """Ids as by `Tokenizer.from_file(path).encode(text, add_special_tokens=False)`."""

    def __init__(self, path: str, most_words: int = 500_000):
        from tokenizers import Tokenizer

        self.path, self.most_words = path, most_words
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.words = _Words(self.tokenizer.model)

    def sentence_ends(self) -> np.ndarray:
        """For each id, whether its piece is punctuation with a full stop, ! or ? in it."""
        with open(self.path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        ends = np.zeros(max(max(vocabulary.values()) + 1, self.tokenizer.get_vocab_size(), 2), bool)
        for piece, i in vocabulary.items():
            word = piece.removesuffix("</w>")
            ends[i] = piece != word and bool(re.search(r"[.!?]", word)) and not re.search(r"\w", word)
        return ends

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list = [None] * len(texts)
        plain = [i for i, t in enumerate(texts) if not _OTHER.search(t)]
        if plain:
            if len(self.words) > self.most_words:
                self.words = _Words(self.tokenizer.model)
            pieces = [_PIECE.findall(texts[i].lower()) for i in plain]
            number = np.fromiter(map(self.words.__getitem__, chain.from_iterable(pieces)), np.int64)
            starts = np.array(self.words.starts, np.int64)
            ids = np.array(self.words.ids, np.uint32)
            lengths = starts[number + 1] - starts[number]
            ends = np.cumsum(lengths)
            total = int(ends[-1]) if len(ends) else 0
            flat = ids[np.arange(total) + np.repeat(starts[number] - (ends - lengths), lengths)]
            words_end = np.cumsum([len(p) for p in pieces])
            cuts = np.concatenate(([0], ends))[words_end]
            for i, part in zip(plain, np.split(flat, cuts[:-1]), strict=True):
                out[i] = part
        rest = [i for i, o in enumerate(out) if o is None]
        if rest:
            encoded = self.tokenizer.encode_batch([texts[i] for i in rest], add_special_tokens=False)
            for i, e in zip(rest, encoded, strict=True):
                out[i] = np.array(e.ids, np.uint32)
        return out
